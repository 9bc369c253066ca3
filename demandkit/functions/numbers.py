"""Rounding, order bands and number text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

#: Text between the two ends of an order range when written.
RANGE_SEPARATOR = " - "
#: Reads "72-94" and "72 - 94".
RANGE_PATTERN = r"(\d+)\s*-\s*(\d+)"


def half_even(value: Column) -> Column:
    """Whole units, ties to the even neighbour.

    Sums of doubles differ in the last bits with the order of addition, so noise
    beyond six digits is cut off before a tie is decided.
    """
    return F.bround(F.round(value, 6), 0).cast("long")


def range_text(low: Column, high: Column) -> Column:
    return F.concat_ws(RANGE_SEPARATOR, half_even(low).cast("string"), half_even(high).cast("string"))


def range_end(text: Column, which: int) -> Column:
    """Lower (1) or upper (2) end of a range text, 0 where the text has no range."""
    digits = F.regexp_extract(text, RANGE_PATTERN, which)
    return F.coalesce(F.when(digits != "", digits.cast("long")), F.lit(0))


def truncated_exp(value: Column) -> Column:
    return F.exp(value).cast("long")
