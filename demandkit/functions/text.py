"""Text columns: word counts and the table search predicate."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, functions as F


def num_words(text: Column) -> Column:
    """Runs of non-blank characters, without building a word array first."""
    return F.regexp_count(text, F.lit(r"\S+")).cast("long")


def num_characters(text: Column) -> Column:
    return F.length(text).cast("long")


def matches_search(query: str | None, columns: Sequence[Column]) -> Column:
    """Every blank-separated token occurs, in any case, in the joined columns."""
    haystack = F.lower(F.concat_ws(" ", *[c.cast("string") for c in columns]))
    tokens = (query or "").lower().split()
    return reduce(lambda found, token: found & haystack.contains(token), tokens, F.lit(True))
