"""Picking, deduplicating, upserting, resuming: keyed tables and task states."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def preferred(df: DataFrame, key: list[str], order: list) -> DataFrame:
    """The first row of each key by a total order."""
    return df.withColumn("__r", F.row_number().over(W.partitionBy(*key).orderBy(*order))).where(F.col("__r") == 1).drop("__r")


def preferred_path(path: Column, hidden: str = ".dst") -> list:
    """Order of preference among paths: outside a hidden folder, few steps, short, by name."""
    p = F.replace(path, F.lit("\\"), F.lit("/"))
    parents = F.slice(F.split(F.lower(p), "/"), F.lit(1), F.size(F.split(p, "/")) - 1)
    return [F.array_contains(parents, hidden), F.size(F.split(p, "/")), F.length(p), F.lower(p), p]


def upsert_latest(df: DataFrame, key: list[str], order: str) -> DataFrame:
    """The last row of each key, at the place of its first; rows with a null in the
    key pass as they are.  Adds ``place``."""
    usable = F.lit(True)
    for c in key:
        usable = usable & F.col(c).isNotNull()
    rest = [c for c in df.columns if c not in key]
    last = df.where(usable).groupBy(*key).agg(F.max_by(F.struct(*rest), order).alias("__s"), F.min(order).alias("place"))
    return last.select(*key, "__s.*", "place").select(*df.columns, "place").unionByName(df.where(~usable).withColumn("place", F.col(order)))


def duplicate_keys(df: DataFrame, key: list[str]) -> DataFrame:
    """Violations of a uniqueness constraint, with their counts."""
    return df.groupBy(*key).agg(F.count("*").alias("n")).where(F.col("n") > 1)


def subset(a: DataFrame, b: DataFrame) -> DataFrame:
    """(subset): is every row of a in b?"""
    return a.join(b.distinct(), a.columns, "left_anti").agg((F.count("*") == 0).alias("subset"))


def resume(tasks: DataFrame, results: DataFrame, key: list[str], mode: str) -> DataFrame:
    """Tasks to run: all ("fresh"), those without a success ("resume"), or those
    whose latest state is an error ("retry")."""
    if mode == "fresh":
        return tasks
    wanted = results.where(F.col("status") == ("success" if mode == "resume" else "error"))
    return tasks.join(wanted.select(*key).distinct(), key, "left_anti" if mode == "resume" else "left_semi")


def fallback_join(left: DataFrame, right: DataFrame, exact: str, relaxed: str) -> DataFrame:
    """Matches on the exact key; rows without one match on the relaxed key."""
    r = right.withColumnsRenamed({c: f"r_{c}" for c in right.columns})
    first = left.join(r, F.col(exact) == F.col(f"r_{exact}")).withColumn("match", F.lit("exact"))
    rest = left.join(right.select(exact).distinct(), exact, "left_anti")
    second = rest.join(r, F.col(relaxed) == F.col(f"r_{relaxed}")).withColumn("match", F.lit("relaxed"))
    return first.unionByName(second)


def same_sets(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows in one of two sets only, with the side."""
    return a.subtract(b).withColumn("side", F.lit("left")).unionByName(b.subtract(a).withColumn("side", F.lit("right")))


def grid(spark, x: tuple[float, float, float], y: tuple[float, float, float], centre: bool = True) -> DataFrame:
    """x and y in ticks of 0.01: the product of two inclusive ranges (low, high,
    step); the centre is added where it is missing."""
    tick = lambda v: round(v * 100)
    axis = lambda r: F.explode(F.sequence(F.lit(tick(r[0])), F.lit(tick(r[1])), F.lit(tick(r[2]))))
    out = spark.range(1).select(axis(x).alias("x")).select("x", axis(y).alias("y"))
    if centre:
        origin = spark.range(1).select(F.lit(0).alias("x"), F.lit(0).alias("y"))
        out = out.unionByName(origin.join(out, ["x", "y"], "left_anti"))
    return out


def sample_ticks(spark, x: tuple[int, int], y: tuple[int, int], n: int, seed: int) -> DataFrame:
    """n different (x, y) ticks from two inclusive ranges, the same for a seed."""
    width = x[1] - x[0] + 1
    ids = spark.range(width * (y[1] - y[0] + 1))
    ids = ids.orderBy(F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("id").cast("string")).cast("binary")), "id").limit(n)
    return ids.select((F.col("id") % width + x[0]).cast("int").alias("x"), (F.floor(F.col("id") / width) + y[0]).cast("int").alias("y"))


def contains_join(docs: DataFrame, patterns: DataFrame, text: str, pattern: str, max_short: int = 1_000) -> DataFrame:
    """(document, pattern) pairs where the text contains the pattern, with the
    first position from 0.

    A word that has a blank on either side in the pattern stands so in the text as
    well: the longest of them meets the texts' distinct words in an equi-join of
    words and text hashes, and the texts of its hits are fetched and verified.  A pattern without such a word is tried on every text;
    up to ``max_short`` of these are broadcast, of more Spark chooses the join."""
    inner = F.filter(F.split(pattern, " "), lambda w, i: (i > 0) & (i < F.size(F.split(pattern, " ")) - 1) & (w != ""))
    p = patterns.where(F.length(pattern) > 0).withColumn("__w", F.array_max(F.transform(inner, lambda w: F.struct(F.length(w).alias("n"), w.alias("w"))))["w"])
    short = p.where(F.col("__w").isNull()).drop("__w")
    n_short = short.limit(max_short + 1).count()
    keyed = docs.withColumn("__k", F.xxhash64(text))
    words = keyed.select("__k", F.explode(F.array_distinct(F.split(text, " "))).alias("__w"))
    hits = words.join(p.where(F.col("__w").isNotNull()), "__w").drop("__w").distinct()
    rows = keyed.join(hits, "__k").drop("__k")
    if n_short:
        rows = rows.unionByName(docs.join(F.broadcast(short) if n_short <= max_short else short, F.contains(F.col(text), F.col(pattern))))
    return rows.withColumn("position", F.instr(F.col(text), F.col(pattern)) - 1).where(F.col("position") >= 0)
