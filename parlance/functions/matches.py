"""All matches of a pattern with their places, as column expressions.

Spark has no function that returns offsets. A text split at a pattern, and the matches taken out by
the same pattern, put together are the text; running lengths give the offsets. Offsets count code
points from 0, ends are exclusive. The pattern must not match the empty string.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

SPANS = "array<struct<s:int,e:int>>"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use` of a value that is computed once, however often `use` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def matches(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def spans(text: Column, pattern: str) -> Column:
    """Array of struct(s, e) of the matches, in order."""
    gaps, found = F.split(text, pattern, -1), matches(text, pattern)
    steps = F.arrays_zip(F.slice(gaps, F.lit(1), F.size(found)).alias("gap"), found.alias("hit"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(SPANS).alias("spans"))
    def step(x: Column, y: Column) -> Column:
        s = x["at"] + F.length(y["gap"])
        e = s + F.length(y["hit"])
        return F.struct(e.alias("at"), F.concat(x["spans"], F.array(F.struct(s.alias("s"), e.alias("e")))).alias("spans"))
    got = F.aggregate(steps, start, step, lambda x: x["spans"])
    return F.when(F.size(found) > 0, got).otherwise(F.array().cast(SPANS))


def map_matches(text: Column, pattern: str, change: Callable[[Column], Column]) -> Column:
    """The text with `change` applied to every match; gaps and matches are each made once, so the work is linear in their number."""
    gaps, found = F.split(text, pattern, -1), F.transform(matches(text, pattern), change)
    return F.array_join(F.zip_with(gaps, found, lambda g, m: F.concat(g, F.coalesce(m, F.lit("")))), "")


def count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern))
