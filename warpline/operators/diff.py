"""Differences between keyed tables, sequences and byte strings."""

from __future__ import annotations

import difflib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def keyed_diff(left: DataFrame, right: DataFrame, key: list[str], value: str, both: bool = False) -> DataFrame:
    """key, left_value, right_value where they differ; rows of one side too, unless
    ``both``."""
    a = left.select(*key, F.col(value).alias("left_value"))
    b = right.select(*key, F.col(value).alias("right_value"))
    return a.join(b, key, "inner" if both else "full_outer").where(~F.col("left_value").eqNullSafe(F.col("right_value")))


def first_difference(left: DataFrame, right: DataFrame, key: list[str], index: str, value: str) -> DataFrame:
    """The least index at which two sequences differ, over the shorter's length."""
    return keyed_diff(left, right, [*key, index], value, both=True).groupBy(*key).agg(F.min(index).alias("first_index"))


def pairs_within(df: DataFrame, group: list[str], order: str, value: str, least_distance: int = 0) -> DataFrame:
    """Unordered pairs of a group whose values differ, at positions at least so
    far apart.  Meant for small groups: the output is their pairs."""
    a = df.select(*group, F.col(order).alias("a"), F.col(value).alias("a_value"))
    b = df.select(*group, F.col(order).alias("b"), F.col(value).alias("b_value"))
    return a.join(b, group).where((F.col("a") < F.col("b")) & (F.col("a_value") != F.col("b_value")) & (F.col("b") - F.col("a") >= least_distance))


def range_distance(start: Column, stop: Column, at: Column) -> Column:
    """From a position to the nearer end of a range."""
    return F.least(F.abs(start - at), F.abs(stop - at))


def common_prefix(a: Column, b: Column) -> Column:
    """Leading equal characters of two strings."""
    n = F.least(F.length(a), F.length(b))
    places = F.sequence(F.lit(1), n)
    differ = F.filter(places, lambda i: F.substring(a, i, F.lit(1)) != F.substring(b, i, F.lit(1)))
    return F.when(n == 0, 0).otherwise(F.coalesce(F.try_element_at(differ, F.lit(1)) - 1, n))


def common_suffix(a: Column, b: Column) -> Column:
    """Trailing equal characters, not reaching into the common prefix."""
    rest = F.least(F.length(a), F.length(b)) - common_prefix(a, b)
    return F.least(common_prefix(F.reverse(a), F.reverse(b)), rest)


def _opcodes(pairs: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for a, b in pairs:
        yield pd.Series([[list(map(str, op)) for op in difflib.SequenceMatcher(None, x, y, autojunk=False).get_opcodes()] for x, y in zip(a, b, strict=True)])


def edit_opcodes(a: Column | str, b: Column | str) -> Column:
    """Edit script between two strings: arrays of (operation, a's start and stop,
    b's start and stop) as strings."""
    return F.pandas_udf(_opcodes, "array<array<string>>")(a, b)
