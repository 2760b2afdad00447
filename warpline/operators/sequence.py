"""Ordered folds over (key, order) sequences as window expressions.

Every operator partitions by the sequence key alone, so several in a row share
one shuffle and sort.  ``order`` has to be total within a key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def ordered(key: list[str], order: list[str]):
    return W.partitionBy(*key).orderBy(*order)


def running(value: Column, key: list[str], order: list[str]) -> Column:
    """Running sum up to and with the row itself."""
    return F.sum(value).over(ordered(key, order).rowsBetween(W.unboundedPreceding, 0))


def toggled(switch: Column, key: list[str], order: list[str]) -> Column:
    """True after an odd number of switches so far."""
    return running(F.when(switch, 1).otherwise(0), key, order) % 2 == 1


def until_first(df: DataFrame, stop: Column, key: list[str], order: str) -> DataFrame:
    """Rows up to and with the first that stops; all rows of a key without one."""
    end = F.min(F.when(stop, F.col(order))).over(W.partitionBy(*key))
    return df.withColumn("__end", end).where(F.col("__end").isNull() | (F.col(order) <= F.col("__end"))).drop("__end")


def ranges(df: DataFrame, key: list[str], position: str, cell: int = 1 << 20) -> DataFrame:
    """Half-open ranges [start, stop) of consecutive positions, and their lengths.

    Positions are distinct within a key.  They are dealt into cells, so that a
    frequent key is spread; only the ranges at a cell's edges, two a cell at most,
    meet again by key."""
    rows = df.select(*key, F.col(position).cast("long").alias("__p")).withColumn("__c", F.floor(F.col("__p") / cell))
    island = F.col("__p") - F.row_number().over(ordered([*key, "__c"], ["__p"]))
    parts = rows.withColumn("__g", island).groupBy(*key, "__c", "__g").agg(F.min("__p").alias("start"), (F.max("__p") + 1).alias("stop")).drop("__g")
    at_edge = (F.col("start") == F.col("__c") * cell) | (F.col("stop") == (F.col("__c") + 1) * cell)
    by_key = ordered(key, ["start"])
    edges = parts.where(at_edge).withColumn("__new", F.when(F.lag("stop").over(by_key) == F.col("start"), 0).otherwise(1))
    edges = edges.withColumn("__g", F.sum("__new").over(by_key.rowsBetween(W.unboundedPreceding, 0)))
    merged = edges.groupBy(*key, "__g").agg(F.min("start").alias("start"), F.max("stop").alias("stop")).drop("__g")
    return parts.where(~at_edge).drop("__c").unionByName(merged).withColumn("n", F.col("stop") - F.col("start"))


def segments(df: DataFrame, member: Column, key: list[str], order: list[str]) -> DataFrame:
    """Rows that are members, with ``segment``: the number of breaks so far."""
    return df.withColumn("segment", running(F.when(member, 0).otherwise(1), key, order)).where(member)


def polylines(df: DataFrame, member: Column, key: list[str], order: str, x: str, y: str) -> DataFrame:
    """(key, segment, first, points): each run of member rows as a line that begins at the
    point before its first one (the origin before any).  A line is one row."""
    at = ordered(key, [order])
    before = F.struct(F.lit(0).alias("i"), *(F.coalesce(F.lag(c).over(at), F.lit(0)).alias(n) for c, n in ((x, "x"), (y, "y"))))
    rows = segments(df.withColumn("__before", before), member, key, [order])
    lines = rows.groupBy(*key, "segment").agg(F.min_by("__before", order).alias("b"), F.min(order).alias("first"), F.array_sort(F.collect_list(F.struct(F.col(order).alias("i"), F.col(x).alias("x"), F.col(y).alias("y")))).alias("p"))
    bare = lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y"))
    return lines.select(*key, "segment", "first", F.concat(F.array(bare(F.col("b"))), F.transform("p", bare)).alias("points"))


def running_overall(df: DataFrame, value: str, order: str, cell: int = 1 << 16) -> DataFrame:
    """Adds ``upto`` and ``count``: the running sum and number of rows by a whole-number
    order over the whole table.  Rows are summed in cells of the order, the cells' sums are
    summed up, and each cell starts where the ones before it end, so no task takes all rows."""
    rows = df.withColumn("__c", F.floor(F.col(order) / cell))
    sums = rows.groupBy("__c").agg(F.sum(value).alias("__v"), F.count("*").alias("__n"))
    before = W.partitionBy(F.lit(1)).orderBy("__c").rowsBetween(W.unboundedPreceding, -1)
    starts = sums.select("__c", F.coalesce(F.sum("__v").over(before), F.lit(0)).alias("__v"), F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__n"))
    inner = ordered(["__c"], [order]).rowsBetween(W.unboundedPreceding, 0)
    rows = rows.withColumns({"upto": F.sum(value).over(inner), "count": F.count("*").over(inner)}).join(starts, "__c")
    return rows.withColumns({"upto": F.col("upto") + F.col("__v"), "count": F.col("count") + F.col("__n")}).drop("__c", "__v", "__n")


def bounds(df: DataFrame, key: list[str], x: str, y: str) -> DataFrame:
    """Least and largest x and y together with the origin, and the extents."""
    low = lambda c: F.least(F.lit(0), F.min(c))
    high = lambda c: F.greatest(F.lit(0), F.max(c))
    out = df.groupBy(*key).agg(low(x).alias("min_x"), high(x).alias("max_x"), low(y).alias("min_y"), high(y).alias("max_y"))
    return out.withColumns({"width": F.col("max_x") - F.col("min_x"), "height": F.col("max_y") - F.col("min_y")})


def touching(start: Column, size: Column, key: list[str], order: list[str]) -> Column:
    """Does the next row begin where this one ends?  Null for the last."""
    return F.lead(start).over(ordered(key, order)) == start + size
