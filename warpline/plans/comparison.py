"""Reports on two files: what differs between their streams, properties, headers, commands
and contents.  Each section is a table of its own; sinks.write_markdown() puts them into one document."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from warpline.functions.display import hex_bytes, human_size
from warpline.operators import diff as D
from warpline.operators import sequence as Q
from warpline.operators import stats as A
from warpline.sources import container, records, stitches


def _two(df: DataFrame, left: str, right: str) -> tuple[DataFrame, DataFrame]:
    return tuple(df.where(F.col("path") == p).drop("path") for p in (left, right))


def stream_report(streams: DataFrame, left: str, right: str) -> DataFrame:
    """(stream, left, right): streams that differ or that one file lacks, with size and hash."""
    shown = streams.select("path", "stream", F.concat_ws(" ", human_size(F.length("raw")), F.left("sha256", F.lit(12))).alias("value"), "sha256")
    a, b = _two(shown, left, right)
    out = D.keyed_diff(a, b, ["stream"], "sha256").select("stream")
    values = lambda df, name: df.select("stream", F.col("value").alias(name))
    return out.join(values(a, "left"), "stream", "left").join(values(b, "right"), "stream", "left").orderBy("stream")


def property_report(streams: DataFrame, stream: str, left: str, right: str) -> DataFrame:
    """(id, property, left_value, right_value) of properties that differ."""
    rows = container.property_rows(streams, stream)
    value = F.coalesce("text", F.col("number").cast("string"), F.col("size").cast("string"))
    a, b = _two(rows.select("path", "id", "property", value.alias("value")), left, right)
    names = rows.groupBy("id").agg(F.max("property").alias("property"))
    return D.keyed_diff(a, b, ["id"], "value").join(names, "id").select("id", "property", "left_value", "right_value").orderBy("id")


def header_report(files: DataFrame, left: str, right: str) -> DataFrame:
    """(key, left_value, right_value) of stitch file headers that differ."""
    rows = stitches.headers(files).select("path", F.explode("header").alias("key", "value"))
    return D.keyed_diff(*_two(rows, left, right), ["key"], "value").orderBy("key")


def command_report(files: DataFrame, left: str, right: str) -> DataFrame:
    """(compared, differing, first, left_count, right_count): commands by place, over the shorter's length."""
    rows = stitches.commands(files).select("path", F.col("index").alias("i"), F.concat_ws(" ", "dx", "dy", "type").alias("value"))
    a, b = _two(rows, left, right)
    both = a.join(b.withColumnRenamed("value", "other"), "i")
    count = lambda df, name: df.agg(F.count("*").alias(name))
    differ = F.col("value") != F.col("other")
    out = both.agg(F.count("*").alias("compared"), F.count_if(differ).alias("differing"), F.min(F.when(differ, F.col("i"))).alias("first"))
    return out.join(count(a, "left_count")).join(count(b, "right_count"))


def contents_report(streams: DataFrame, stream: str, left: str, right: str) -> DataFrame:
    """(start, stop, n, left, right): ranges of changed bytes, the longer one's tail included."""
    rows = streams.where(container.named(stream)).select("path", "raw")
    a, b = _two(rows, left, right)
    both = a.withColumnRenamed("raw", "a").join(b.withColumnRenamed("raw", "b"))
    places = F.sequence(F.lit(0), F.greatest(F.length("a"), F.length("b")) - 1)
    at = lambda c, i: F.substring(c, i + 1, F.lit(1))
    changed = both.select(F.explode(F.filter(places, lambda i: at("a", i) != at("b", i))).alias("position"))
    part = lambda c: hex_bytes(F.substring(c, F.col("start").cast("int") + 1, F.least(F.col("n"), F.lit(32)).cast("int")))
    return Q.ranges(changed, [], "position").join(both).select("start", "stop", "n", part("a").alias("left"), part("b").alias("right")).orderBy("start")


def icon_report(streams: DataFrame, stream: str, left: str, right: str, reach: int = 40) -> DataFrame:
    """(dx, dy, iou): how well the pixels of two icons that aren't background meet, best shift first."""
    rows = streams.where(container.named(stream)).select("path", "raw")
    pixels = records.explode_bytes(rows, "raw", records.pixels, "x int, y int, value int").withColumn("place", F.col("y") * 100_000 + F.col("x"))
    ground = A.most_common(pixels, ["path"], "value", "place").select("path", F.col("value").alias("ground"))
    a, b = _two(pixels.join(ground, "path").where("value <> ground").select("path", "x", "y"), left, right)
    return A.iou_shifts(a, b, reach)
