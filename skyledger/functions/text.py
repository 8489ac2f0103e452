"""Text rules shared by the log parser."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character that counts as blank, Unicode separators included; a plain `\s`
# and `trim` know fewer.
BLANKS = r"[\s\x1c-\x1f\x85\p{Z}]+"


def strip(text: Column) -> Column:
    """Remove blanks at both ends."""
    return F.regexp_replace(text, rf"\A{BLANKS}|{BLANKS}\z", "")


def leading_tokens(stripped: Column, count: int) -> Column:
    """The first `count - 1` tokens and the rest; the size tells whether `count` exist."""
    return F.split(stripped, BLANKS, count)


def first_match(text: Column, pattern: str) -> Column:
    """Group 1 of the first match; empty without one (no pattern here matches empty)."""
    return F.regexp_extract(text, pattern, 1)


def contains_all(text: Column, *words: str) -> Column:
    """True when every word occurs, case-sensitively."""
    found = F.lit(True)
    for word in words:
        found = found & text.contains(word)
    return found
