"""Spark-native telemetry tables for optical ground stations and quantum-key pools."""

__version__ = "0.1.0"
