"""Decimal coordinates, their spellings and file names made of them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DECIMAL = "decimal(18,6)"


def parse_coordinate(text: Column) -> Column:
    """Trimmed, comma or dot, finite; else null."""
    return F.replace(F.trim(text), F.lit(","), F.lit(".")).try_cast(DECIMAL)


def canonical_coordinate(text: Column) -> Column:
    """Plain digits without trailing zeros; zero of any sign and spelling is 0."""
    plain = F.regexp_replace(F.regexp_replace(parse_coordinate(text).cast("string"), r"(\.\d*?)0+$", "$1"), r"\.$", "")
    return F.when(plain.isin("-0", "0", ""), "0").otherwise(plain)


def two_decimals(value: Column) -> Column:
    """Rounded half up to 0.01 and written with two decimals; no negative zero."""
    rounded = F.round(value.cast("decimal(18,4)"), 2).cast("decimal(18,2)")
    return F.when(rounded == 0, "0.00").otherwise(rounded.cast("string"))


def file_part(value: Column) -> Column:
    """A coordinate as part of a file name: m for minus, _ for the dot."""
    return F.replace(F.replace(two_decimals(value), F.lit("-"), F.lit("m")), F.lit("."), F.lit("_"))


def variant_name(stem: Column, x: Column, y: Column) -> Column:
    return F.concat(stem, F.lit("_x"), file_part(x), F.lit("_y"), file_part(y), F.lit(".EMB"))


def safe_path(path: Column) -> Column:
    """Relative, without a parent step, with the right suffix."""
    p = F.replace(path, F.lit("\\"), F.lit("/"))
    return ~F.regexp_like(p, F.lit(r"^(/|[A-Za-z]:)")) & ~F.regexp_like(p, F.lit(r"(^|/)\.\.(/|$)")) & F.regexp_like(p, F.lit(r"(?i)\.emb$"))


def task_key(source: Column, x: Column, y: Column, output: Column) -> Column:
    folded = lambda c: F.lower(F.replace(c, F.lit("\\"), F.lit("/")))
    return F.concat_ws("|", folded(source), canonical_coordinate(x), canonical_coordinate(y), folded(output))


def output_path(folder: str, relative: Column, stem: Column, x: Column, y: Column) -> Column:
    """The variant's path below the output folder, beside where its source stood."""
    parent = F.regexp_replace(F.replace(relative, F.lit("\\"), F.lit("/")), r"[^/]*$", "")
    return F.concat(F.lit(folder.rstrip("/") + "/"), parent, variant_name(stem, x, y))


def inside(path: Column, root: str) -> Column:
    """Does a path, taken below the root unless it is absolute, stay below it?  Steps up
    are counted; links aren't followed."""
    p = F.replace(path, F.lit("\\"), F.lit("/"))
    base = root.replace("\\", "/").rstrip("/")
    absolute = F.regexp_like(p, F.lit(r"^(/|[A-Za-z]:)"))
    below = F.startswith(F.lower(p), F.lit(base.lower() + "/"))
    rest = F.when(absolute, F.substring(p, len(base) + 2, F.length(p))).otherwise(p)
    steps = F.filter(F.split(rest, "/"), lambda s: ~s.isin("", "."))
    zero = F.struct(F.lit(0).alias("depth"), F.lit(0).alias("least"))
    move = lambda a, s: a["depth"] + F.when(s == "..", -1).otherwise(1)
    least = F.aggregate(steps, zero, lambda a, s: F.struct(move(a, s).alias("depth"), F.least(a["least"], move(a, s)).alias("least")), lambda a: a["least"])
    return (~absolute | below) & (least >= 0)
