"""Searching byte streams for coordinates: packed representations and their fragments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from warpline.functions.display import hex_bytes

#: How commands can be packed: (values in order, bits, byte order).
MODES = {
    "delta_i8_xy": (("dx", "dy"), 8, "le"),
    "delta_i8_yx": (("dy", "dx"), 8, "le"),
    "delta_i16_xy_le": (("dx", "dy"), 16, "le"),
    "delta_i16_yx_le": (("dy", "dx"), 16, "le"),
    "delta_i16_xy_be": (("dx", "dy"), 16, "be"),
    "absolute_i16_xy_le": (("x", "y"), 16, "le"),
    "absolute_i16_yx_le": (("y", "x"), 16, "le"),
    "absolute_i16_xy_be": (("x", "y"), 16, "be"),
    "delta_i32_xy_le": (("dx", "dy"), 32, "le"),
    "absolute_i32_xy_le": (("x", "y"), 32, "le"),
}
#: Where fragments begin (beside the first stitch) and how many commands they hold.
STARTS, COUNTS = (0, 10, 50, 100), (4, 8, 16, 32)


def stored(value: Column, bits: int, order: str, cut: bool = False) -> Column:
    """Hex digits of a signed number in so many bits; null where it doesn't fit, or its low
    bits if it is to be cut."""
    value = value.cast("long")
    digits = F.lpad(F.hex(value.bitwiseAND((1 << bits) - 1)), bits // 4, "0")
    if order == "le":
        digits = F.concat(*(F.substring(digits, i, 2) for i in range(bits // 4 - 1, 0, -2)))
    return F.when(value.isNotNull() if cut else value.between(-(1 << (bits - 1)), (1 << (bits - 1)) - 1), digits)


def packed(commands: DataFrame, key: list[str], order: str = "index", modes: tuple[str, ...] = tuple(MODES), cut: tuple[tuple[str, str], ...] = ()) -> DataFrame:
    """(key, mode, record_size, data): the coordinates of each sequence in every one of
    ``modes`` that can hold all of them.  Of a (mode, column) in ``cut`` the low bits are
    kept where a number doesn't fit, so it rules no mode out.  A sequence, as a file, fits
    in a task's memory."""
    digits = lambda mode, names, bits, side: F.concat(*(stored(F.col(c), bits, side, (mode, c) in cut) for c in names))
    each = F.explode(F.array(*(
        F.struct(F.lit(mode).alias("mode"), F.lit(bits // 4).alias("record_size"), digits(mode, names, bits, side).alias("digits"))
        for mode, (names, bits, side) in MODES.items() if mode in modes)))
    rows = commands.select(*key, F.col(order).alias("__i"), each.alias("m")).select(*key, "__i", "m.*")
    out = rows.groupBy(*key, "mode", "record_size").agg(F.array_sort(F.collect_list(F.struct("__i", "digits"))).alias("d"), F.count_if(F.col("digits").isNull()).alias("bad"))
    return out.where("bad = 0").select(*key, "mode", "record_size", F.unhex(F.array_join("d.digits", "")).alias("data"))


def fragments(packed_: DataFrame, key: list[str], first_stitch: Column | None = None) -> DataFrame:
    """(key, mode, start, count, fragment): runs of commands, of whole length only."""
    starts = F.array(*map(F.lit, STARTS))
    if first_stitch is not None:
        starts = F.array_distinct(F.array_append(starts, first_stitch.cast("int")))
    rows = packed_.select("*", F.explode(starts).alias("start")).select("*", F.explode(F.array(*map(F.lit, COUNTS))).alias("count"))
    size = F.col("record_size") * F.col("count")
    rows = rows.withColumn("fragment", F.substring("data", F.col("start") * F.col("record_size") + 1, size))
    return rows.where(F.length("fragment") == size).select(*key, "mode", "start", "count", "fragment")


def first_position(data: Column, part: Column) -> Column:
    """The first 0-based place of some bytes in others; null if there is none.  Bytes are
    compared as characters of a one-byte code."""
    text = lambda c: F.decode(c, "ISO-8859-1")
    at = F.instr(text(data), text(part))
    return F.when(at > 0, at - 1)


def fragment_hits(parts: DataFrame, streams: DataFrame, key: list[str]) -> DataFrame:
    """Fragments that occur in the streams of their own key, with the first offset and
    the fragment's first 32 bytes as hex digits."""
    rows = parts.join(streams, key).withColumn("offset", first_position(F.col("raw"), F.col("fragment"))).where(F.col("offset").isNotNull())
    return rows.withColumn("shown", hex_bytes(F.substring("fragment", 1, 32))).drop("raw", "fragment")


def first_index(df: DataFrame, key: list[str], test: Column, index: str, otherwise: int = 0) -> DataFrame:
    """(key, first): the least index at which the test holds, or ``otherwise``."""
    return df.groupBy(*key).agg(F.coalesce(F.min(F.when(test, F.col(index))), F.lit(otherwise)).alias("first"))


def by_priority() -> list[Column]:
    """Order of hits (pattern_length, value, stream, offset) to show: long patterns and large numbers meet by chance less often."""
    return [F.desc("pattern_length"), F.desc(F.abs("value")), F.col("stream"), F.col("offset")]


def distinct_files(hits: DataFrame, key: list[str], file: str, example: list[str], most: int = 20, salt: int = 64) -> DataFrame:
    """(key, file_count, examples): in how many files a key occurs, and its first
    ``most`` examples by file and the example's columns.  No key is sorted whole: the
    examples are the first of the first of ``salt`` parts."""
    counts = hits.select(*key, file).distinct().groupBy(*key).agg(F.count("*").alias("file_count"))
    order = [file, *example]
    rows = hits.select(*key, *order).withColumn("__s", F.pmod(F.xxhash64(*order), F.lit(salt)))
    for by in ([*key, "__s"], key):
        rows = rows.withColumn("__r", F.row_number().over(W.partitionBy(*by).orderBy(*order))).where(F.col("__r") <= most)
    shown = rows.groupBy(*key).agg(F.transform(F.array_sort(F.collect_list(F.struct("__r", *order))), lambda x: F.struct(*(x[c].alias(c) for c in order))).alias("examples"))
    return counts.join(shown, key)
