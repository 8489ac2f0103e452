"""Display rules of the dashboard."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Lower bounds of the error-rate colours, and the gauge range.
QBER_BANDS = [(0.0, "green"), (0.02, "yellow"), (0.03, "red")]
QBER_GAUGE = (0.0, 0.05)

# Text and colour of the dome state.
DOME_STATES = {False: ("CLOSED", "red"), True: ("OPEN", "green")}

# Colour of an alert severity.
SEVERITY_COLOURS = {"warning": "yellow", "critical": "red"}

# Declaration order of the key-pool types, which is their sort order.
KEY_POOL_TYPES = ["PUBLIC", "PRIVATE", "SHARED"]


def qber_band(rate: Column) -> Column:
    """Colour of the highest band whose lower bound is reached; a NULL rate has none."""
    band = F.when(rate.isNull(), F.lit(None).cast("string"))
    for bound, colour in reversed(QBER_BANDS[1:]):
        band = band.when(rate >= bound, colour)
    return band.otherwise(QBER_BANDS[0][1])


def qber_gauge(rate: Column) -> Column:
    """The rate as a share of the gauge, held within its ends."""
    low, high = QBER_GAUGE
    held = F.least(F.greatest(rate, F.lit(low)), F.lit(high))
    return F.when(rate.isNotNull(), (held - low) / (high - low))


def _mapped(value: Column, table: dict) -> Column:
    chosen = F.lit(None).cast("string")
    for key, shown in table.items():
        chosen = F.when(value == F.lit(key), shown).otherwise(chosen)
    return chosen


def dome_text(is_open: Column) -> Column:
    return _mapped(is_open, {k: text for k, (text, _) in DOME_STATES.items()})


def dome_colour(is_open: Column) -> Column:
    return _mapped(is_open, {k: colour for k, (_, colour) in DOME_STATES.items()})


def severity_colour(severity: Column) -> Column:
    return _mapped(severity, SEVERITY_COLOURS)


def pool_type_rank(pool_type: Column) -> Column:
    """Sort key of a key-pool type."""
    return F.array_position(F.array(*map(F.lit, KEY_POOL_TYPES)), pool_type)
