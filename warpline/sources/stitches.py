"""Stitch files: a 512-byte header of labelled values, then three-byte commands.

All native: the commands of a file are exploded by a sequence of offsets, and
the running position is a window by file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from warpline.functions import stitch as S
from warpline.operators import sequence as Q

HEADER = 512


def split_short(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Files with a whole header, and error rows for those without."""
    short = F.length("content") < HEADER
    errors = files.where(short).select("path", F.lit("ValueError").alias("error_type"), F.lit("shorter than its header").alias("error"))
    return files.where(~short), errors


def headers(files: DataFrame, *more: Column) -> DataFrame:
    """(path, ``more``, header map<string, string>); of a repeated key the last value holds.
    Other than ASCII bytes are dropped, NUL and 0x1A stripped, and blanks inside
    values removed."""
    text = F.regexp_replace(F.decode(F.substring("content", 1, HEADER), "ISO-8859-1"), "[^\\x00-\\x7F]+", "")
    lines = F.transform(F.split(text, "\r"), lambda x: F.btrim(F.trim(x), F.lit("\x00\x1a \n\t")))
    bare = lambda x: F.translate(F.substring(x, F.instr(x, ":") + 1, F.length(x)), " \t\n\x0b\f\r", "")
    pairs = F.transform(F.filter(lines, lambda x: F.instr(x, ":") > 1), lambda x: F.struct(F.trim(F.substring_index(x, ":", 1)).alias("k"), bare(x).alias("v")))
    # a column each, else every pair would be held against pairs that are parsed anew for it
    rows = files.select("path", *more, pairs.alias("p")).withColumn("k", F.col("p.k"))
    # the last of equal keys
    last = F.filter("p", lambda p, i: ~F.array_contains(F.slice("k", i + 2, F.size("k")), p["k"]))
    return rows.withColumn("header", F.map_from_entries(last)).drop("p", "k")


def header_numbers(headers_: DataFrame) -> DataFrame:
    keys = {"ST": "st", "CO": "co", "+X": "plus_x", "-X": "minus_x", "+Y": "plus_y", "-Y": "minus_y", "AX": "ax", "AY": "ay"}
    return headers_.select(*(c for c in headers_.columns if c != "header"), *(F.try_element_at("header", F.lit(k)).try_cast("long").alias(v) for k, v in keys.items()))


def commands(files: DataFrame) -> DataFrame:
    """One row a command, up to and with the first end: path, index, offset, raw,
    dx, dy, type, x, y, x_mm, y_mm.  Trailing one or two bytes are ignored."""
    n = F.floor((F.length("content") - HEADER) / 3).cast("int")
    rows = files.where(n > 0).select("path", "content", F.explode(F.sequence(F.lit(0), n - 1)).alias("index"))
    rows = rows.select("path", "index", (F.col("index") * 3 + HEADER).cast("long").alias("offset"), F.hex(F.substring("content", F.col("index") * 3 + HEADER + 1, F.lit(3))).alias("raw"))
    b = [F.conv(F.substring("raw", i, 2), 16, 10).cast("int") for i in (1, 3, 5)]
    dx, dy = S.displacement(*b)
    rows = rows.withColumns({"dx": dx, "dy": dy, "kind": S.command_type(b[2])})
    rows = Q.until_first(rows, F.col("kind") == "end", ["path"], "index")
    ejects = (F.col("kind") == "jump") & Q.toggled(F.col("kind") == "sequin_mode", ["path"], ["index"])
    rows = rows.withColumn("type", F.when(ejects, "sequin_eject").otherwise(F.col("kind"))).drop("kind")
    rows = rows.withColumns({c: Q.running(F.col(f"d{c}"), ["path"], ["index"]) for c in "xy"})
    return rows.withColumns({"raw": F.lower("raw"), "x_mm": S.to_mm(F.col("x")), "y_mm": S.to_mm(F.col("y"))})


def summary(files: DataFrame) -> DataFrame:
    """One row a file: numbers of commands by type, bounds with the origin, end point."""
    return _with_measures(files.select("path"), files)


def _with_measures(rows: DataFrame, files: DataFrame) -> DataFrame:
    zero = {k: 0 for k in ("command_count", "stitch_count", "jump_count", "color_changes", "min_x", "max_x", "min_y", "max_y", "width", "height", "end_x", "end_y")}
    return rows.join(_measured(files), "path", "left").fillna(zero).fillna({"has_end": False})


def _measured(files: DataFrame) -> DataFrame:
    """summary() of the files with commands, by one aggregation."""
    inside = lambda c: F.coalesce(F.when(F.col("type") != "end", F.col(c)), F.lit(0))
    out = commands(files).groupBy("path").agg(
        F.count("*").alias("command_count"), F.count_if(F.col("type") == "stitch").alias("stitch_count"),
        F.count_if(F.col("type") == "jump").alias("jump_count"), F.count_if(F.col("type") == "color_change").alias("color_changes"),
        F.bool_or(F.col("type") == "end").alias("has_end"), F.max_by("x", "index").alias("end_x"), F.max_by("y", "index").alias("end_y"),
        *(F.least(F.lit(0), F.min(inside(c))).alias(f"min_{c}") for c in "xy"), *(F.greatest(F.lit(0), F.max(inside(c))).alias(f"max_{c}") for c in "xy"))
    out = out.select("path", "command_count", "stitch_count", "jump_count", "color_changes", "has_end", "end_x", "end_y", "min_x", "max_x", "min_y", "max_y")
    return out.withColumns({"width": F.col("max_x") - F.col("min_x"), "height": F.col("max_y") - F.col("min_y")})


def mismatches(files: DataFrame) -> DataFrame:
    """(path, finding): declared values that differ from the recomputed ones."""
    rest = ((F.length("content") - HEADER) % 3).alias("rest")
    both = _with_measures(header_numbers(headers(files, rest)), files)
    tests = {
        "ST": F.col("st") != F.col("command_count"),
        "CO": F.col("co") != F.col("color_changes"),
        "extents": (F.col("plus_x") != F.col("max_x")) | (F.col("minus_x") != -F.col("min_x")) | (F.col("plus_y") != F.col("max_y")) | (F.col("minus_y") != -F.col("min_y")),
        "no end": ~F.col("has_end"),
        "trailing bytes": F.col("rest") != 0,
    }
    found = F.filter(F.array(*(F.when(t, F.lit(name)) for name, t in tests.items())), lambda x: x.isNotNull())
    return both.select("path", F.explode(found).alias("finding"))
