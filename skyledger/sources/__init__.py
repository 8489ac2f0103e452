"""Readers: log lines, packages, file catalogues and stored tables."""
