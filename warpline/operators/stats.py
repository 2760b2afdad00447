"""Statistics with the guards and tie rules of small-sample analysis."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def placed(df: DataFrame, key: list[str], value: str, places: dict[str, Callable[[Column], Column]], bins: int = 4096) -> DataFrame:
    """(key, one column a name): the value at a place (from 0) of each key's sorted values;
    places: of the number of values.

    No key is sorted whole: values are counted in equal bins between a key's least
    and largest, and only the bins with a wanted place are ranked."""
    rows = df.where(F.col(value).isNotNull()).select(*key, F.col(value).alias("__v"))
    span = rows.groupBy(*key).agg(F.min("__v").alias("__low"), F.max("__v").alias("__high"), F.count("*").alias("__n"))
    rows = rows.join(span, key) if key else rows.join(F.broadcast(span))
    place = F.floor((F.col("__v") - F.col("__low")) / (F.col("__high") - F.col("__low")) * (bins - 1))
    rows = rows.withColumn("__b", F.when(F.col("__high") > F.col("__low"), place).otherwise(F.lit(0)))
    counts = rows.groupBy(*key, "__b").agg(F.count("*").alias("__k"), F.max("__n").alias("__n"))
    upto = F.sum("__k").over(W.partitionBy(*key).orderBy("__b").rowsBetween(W.unboundedPreceding, 0))
    want = F.explode(F.array(*(F.struct(F.lit(name).alias("name"), at(F.col("__n")).cast("long").alias("i")) for name, at in places.items())))
    goals = counts.withColumn("__before", upto - F.col("__k")).withColumn("__want", want)
    goals = goals.where((F.col("__want.i") >= F.col("__before")) & (F.col("__want.i") < F.col("__before") + F.col("__k")))
    goals = goals.select(*key, "__b", F.col("__want.name").alias("__name"), (F.col("__want.i") - F.col("__before")).alias("__i"))
    found = rows.select(*key, "__b", "__v").join(goals, [*key, "__b"])
    found = found.withColumn("__r", F.row_number().over(W.partitionBy(*key, "__name").orderBy("__v")) - 1).where(F.col("__r") == F.col("__i"))
    return found.groupBy(*key).agg(*(F.max(F.when(F.col("__name") == name, F.col("__v"))).alias(name) for name in places))


def nearest_rank(df: DataFrame, key: list[str], value: str, shares: dict[str, float], bins: int = 4096) -> DataFrame:
    """Percentiles by nearest rank: place round((n - 1) * p), halves to even."""
    return placed(df, key, value, {name: lambda n, p=p: F.bround((n - 1) * F.lit(p), 0) for name, p in shares.items()}, bins)


def medians(df: DataFrame, key: list[str], value: str) -> DataFrame:
    """(key, median): the middle value, or the mean of the two middle ones."""
    middle = placed(df, key, value, {"__a": lambda n: F.floor((n - 1) / 2), "__z": lambda n: F.floor(n / 2)})
    return middle.select(*key, ((F.col("__a") + F.col("__z")) / 2).alias("median"))


def summary(df: DataFrame, key: list[str], value: str) -> DataFrame:
    """(key, n, median, mean, least, most, p05, p95) of the values that aren't null."""
    rows = df.where(F.col(value).isNotNull())
    plain = rows.groupBy(*key).agg(F.count("*").alias("n"), F.avg(value).alias("mean"), F.min(value).alias("least"), F.max(value).alias("most"))
    ranks = nearest_rank(rows, key, value, {"p05": 0.05, "p95": 0.95})
    out = plain.join(ranks, key).join(medians(rows, key, value), key) if key else plain.join(ranks).join(medians(rows, key, value))
    return out.select(*key, "n", "median", "mean", "least", "most", "p05", "p95")


def signature(df: DataFrame, without: list[str]) -> Column:
    """A hash of all columns but some, by name; nulls count."""
    columns = sorted(c for c in df.columns if c not in without)
    return F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}).cast("binary"), 256)


def duplicate_groups(df: DataFrame, without: list[str], value: str) -> DataFrame:
    """(signature, n, n_values, least, most, spread): rows alike in all columns but
    ``without``, of two rows or more, widest spread of the value first, then largest."""
    out = df.groupBy(signature(df, [*without, value]).alias("signature")).agg(F.count("*").alias("n"), F.countDistinct(value).alias("n_values"), F.min(value).alias("least"), F.max(value).alias("most"))
    return out.where("n >= 2").withColumn("spread", F.col("most") - F.col("least")).orderBy(F.desc("spread"), F.desc("n"), "signature")


def regression(df: DataFrame, key: list[str], y: str, x: str, support: int = 8) -> DataFrame:
    """n, slope, intercept, r2 and rmse of y on x; null where x or y hardly
    varies; keys of less support are dropped."""
    agg = df.groupBy(*key).agg(
        F.count("*").alias("n"),
        F.regr_sxx(y, x).alias("sxx"), F.regr_syy(y, x).alias("syy"), F.regr_sxy(y, x).alias("sxy"),
        F.regr_avgx(y, x).alias("ax"), F.regr_avgy(y, x).alias("ay"),
    ).where(F.col("n") >= support)
    fine = (F.col("sxx") / F.col("n") > 1e-12) & (F.col("syy") / F.col("n") > 1e-12)
    slope = F.try_divide("sxy", "sxx")
    return agg.select(
        *key, "n",
        F.when(fine, slope).alias("slope"),
        F.when(fine, F.col("ay") - slope * F.col("ax")).alias("intercept"),
        F.when(fine, F.try_divide(F.col("sxy") * F.col("sxy"), F.col("sxx") * F.col("syy"))).alias("r2"),
        F.when(fine, F.sqrt(F.greatest(F.lit(0.0), F.col("syy") - slope * F.col("sxy")) / F.col("n"))).alias("rmse"),
    )


def entropy(df: DataFrame, key: list[str], symbol: str) -> DataFrame:
    """Shannon entropy in bits of the symbols of each key."""
    counts = df.groupBy(*key, symbol).agg(F.count("*").alias("n"))
    total = counts.groupBy(*key).agg(F.sum("n").alias("n_symbols"), F.sum(F.col("n") * F.log2(F.col("n"))).alias("s"), F.count("*").alias("n_distinct"))
    return total.select(*key, "n_symbols", "n_distinct", (F.log2(F.col("n_symbols")) - F.col("s") / F.col("n_symbols")).alias("entropy"))


def most_common(df: DataFrame, key: list[str], value: str, order: str) -> DataFrame:
    """The most frequent value of each key, the first seen of equally frequent ones."""
    counts = df.groupBy(*key, value).agg(F.count("*").alias("n"), F.min(order).alias("first"))
    return counts.groupBy(*key).agg(F.max_by(value, F.struct("n", -F.col("first"))).alias(value), F.max("n").alias("n"))


def once_per_file(df: DataFrame, file: str, key: list[str]) -> DataFrame:
    """Rows whose key occurs exactly once in their file."""
    single = df.groupBy(file, *key).agg(F.count("*").alias("__n")).where(F.col("__n") == 1).drop("__n")
    return df.join(single, [file, *key], "left_semi")


def calibrated(df: DataFrame, ratio: Column, sure: Column, tolerance: float = 0.01) -> DataFrame:
    """Rows within ``tolerance`` of the median ratio of the sure rows: a first pass
    gives one row, which the second meets by a broadcast."""
    scale = medians(df.where(sure).select(ratio.alias("ratio")), [], "ratio").withColumnRenamed("median", "scale")
    return df.join(F.broadcast(scale)).where(F.abs(ratio / F.col("scale") - 1) <= tolerance)


def permuted(df: DataFrame, key: str, round_: Column, place: str = "place") -> DataFrame:
    """Adds each row's place (from 1) in a permutation of its round that is the same in
    every run.  ``round_`` is a column, so all rounds are made by one plan.

    Rows are ordered by a hash; its leading digits deal them into 4096 parts a round,
    which are ranked apart and start where the parts before them end."""
    hashed = F.md5(F.concat_ws(":", F.col("__round").cast("string"), F.col(key).cast("string")).cast("binary"))
    rows = df.withColumn("__round", round_).withColumn("__h", hashed).withColumn("__b", F.left("__h", F.lit(3)))
    sizes = rows.groupBy("__round", "__b").agg(F.count("*").alias("__n"))
    start = F.sum("__n").over(W.partitionBy("__round").orderBy("__b").rowsBetween(W.unboundedPreceding, 0)) - F.col("__n")
    starts = sizes.select("__round", "__b", start.alias("__s"))  # 4096 rows a round at most
    rank = F.row_number().over(W.partitionBy("__round", "__b").orderBy("__h", key))
    # not broadcast, which would pass 4096 rows a round through the driver; the rows are dealt and sorted by these keys
    rows = rows.withColumn("__r", rank).join(starts.hint("merge"), ["__round", "__b"]).withColumn(place, F.col("__r") + F.col("__s"))
    return rows.drop("__b", "__h", "__r", "__s", "__round")


def negative_control(df: DataFrame, key: str, matches: Callable[[Column, Column], Column], side: list[str], rounds: int = 200) -> DataFrame:
    """(rounds, mean, most, total, nonzero) of the matches of the rows with those of as
    many random permutations of their ``side`` columns.  matches(own, other) gets two
    functions from a column's name to a column."""
    whole = F.explode(F.sequence(F.lit(1), F.lit(rounds)))
    own = permuted(df, key, F.lit(0)).select("place", F.struct(*side).alias("own"))
    other = permuted(df.select(key, *side).withColumn("round", whole), key, F.col("round")).select("round", "place", F.struct(*side).alias("other"))
    hits = other.join(own.hint("shuffle_hash"), "place").groupBy("round").agg(F.count_if(matches(lambda c: F.col(f"own.{c}"), lambda c: F.col(f"other.{c}"))).alias("hits"))
    return hits.agg(F.count("*").alias("rounds"), F.avg("hits").alias("mean"), F.max("hits").alias("most"), F.sum("hits").alias("total"), F.count_if(F.col("hits") > 0).alias("nonzero"))


def iou_shifts(a: DataFrame, b: DataFrame, reach: int) -> DataFrame:
    """Overlap of two point sets (x, y) for every shift of b up to ``reach``, best
    first; small images only, as each point of b is moved by each shift."""
    span = F.sequence(F.lit(-reach), F.lit(reach))
    moved = b.select("x", "y", F.explode(span).alias("dx")).select("*", F.explode(span).alias("dy"))
    moved = moved.select((F.col("x") + F.col("dx")).alias("x"), (F.col("y") + F.col("dy")).alias("y"), "dx", "dy")
    hits = moved.join(a.select("x", "y", F.lit(1).alias("hit")), ["x", "y"], "left").groupBy("dx", "dy").agg(F.count("hit").alias("common"), F.count("*").alias("n"))
    union = F.lit(a.count()) + F.col("n") - F.col("common")
    return hits.select("dx", "dy", F.try_divide("common", union).alias("iou")).orderBy(F.desc("iou"), "dy", "dx")
