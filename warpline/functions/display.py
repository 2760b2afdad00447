"""How values are shown and compared: hex digits, sizes, contexts, tolerances."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Units of a file's size.
UNITS = ("байт", "КБ", "МБ")
#: Fixed value: the largest difference of two coordinates that count as equal.
TOLERANCE = 0.011


def hex_bytes(raw: Column) -> Column:
    """Two lower-case digits a byte, divided by blanks."""
    return F.trim(F.regexp_replace(F.lower(F.hex(raw)), "(..)", "$1 "))


def diff_marker(a: Column, b: Column) -> Column:
    """Below two rows of hex_bytes(): carets under each byte that differs, over the shorter's length."""
    n = F.least(F.length(a), F.length(b))
    mark = lambda i: F.when(F.substring(a, i, F.lit(1)) == F.substring(b, i, F.lit(1)), "  ").otherwise("^^")
    return F.when(n > 0, F.array_join(F.transform(F.sequence(F.lit(1), n), mark), " ")).otherwise(F.when(n == 0, ""))


def human_size(size: Column) -> Column:
    """A number of bytes in the largest fitting unit, two decimals, halves to even."""
    part = lambda unit: F.format_string("%.2f", F.bround(size / F.lit(float(unit)), 2))
    small = F.concat_ws(" ", size.cast("string"), F.lit(UNITS[0]))
    large = F.concat_ws(" ", part(1024**2), F.lit(UNITS[2]))
    return F.when(size < 1024, small).when(size < 1024**2, F.concat_ws(" ", part(1024), F.lit(UNITS[1]))).when(size.isNotNull(), large)


def context(data: Column, at: Column, length: Column, radius: int = 20, near: int = 8) -> Column:
    """struct<start, end, hex, before, after> around a hit at a 0-based place: the bytes
    within ``radius``, and the ``near`` bytes on either side of the hit."""
    cut = lambda a, b: hex_bytes(F.substring(data, a + 1, F.greatest(b - a, F.lit(0))))
    start, end = F.greatest(F.lit(0), at - radius), F.least(F.length(data), at + length + radius)
    behind = at + length
    return F.struct(
        start.alias("start"), end.alias("end"), cut(start, end).alias("hex"),
        cut(F.greatest(F.lit(0), at - near), at).alias("before"), cut(behind, F.least(F.length(data), behind + near)).alias("after"),
    )


def compared(a: Column, b: Column) -> Column:
    """struct<emb, dst, same>: two values and whether they are equal, nulls included."""
    return F.struct(a.alias("emb"), b.alias("dst"), a.eqNullSafe(b).alias("same"))


def whole_number(value: Column, kind: str) -> Column:
    """A number cut to its whole part; null for a truth value or a text.  kind: the column's type."""
    number = kind.startswith(("tinyint", "smallint", "int", "bigint", "float", "double", "decimal"))
    return value.try_cast("long") if number else F.lit(None).cast("long")


def menu_text(text: Column) -> Column:
    """A label without its shortcut (behind a tab), marks and dots, single blanks, lower-cased."""
    plain = F.substring_index(F.replace(text, F.lit("\xa0"), F.lit(" ")), "\t", 1)
    for mark in ("&", "...", "…"):
        plain = F.replace(plain, F.lit(mark), F.lit(""))
    return F.lower(F.btrim(F.regexp_replace(plain, r"\s+", " ")))


def menu_matches(text: Column, allowed: Sequence[str]) -> Column:
    """Does the label begin with an allowed one?"""
    return F.exists(F.array(*map(F.lit, allowed)), lambda a: F.startswith(menu_text(text), a))


def text_number(text: Column) -> Column:
    return F.replace(F.trim(text), F.lit(","), F.lit(".")).try_cast("double")


def within(actual: Column, expected: Column, tolerance: float = TOLERANCE) -> Column:
    """Are two coordinates, as texts, equal within the tolerance?"""
    return F.abs(text_number(actual) - text_number(expected)) <= tolerance
