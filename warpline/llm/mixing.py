"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

A document's key is -ln(u) / w, with u in (0, 1) from a hash of its id and w
its quality weight: the keys of one source, in order, are a weighted sample
without replacement of any size.  Complete epochs come first; for the rest of a
source's target the keys are prefix-summed.  Keys are dealt into bins first, so
that no task sorts a whole source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from warpline.llm.storage import shared_table

#: bins of a source at least, and documents of a bin about (all sources taken together)
BINS, IN_BIN = 2_048, 100_000
#: sources that one task orders, at most; more are ranked by ranges
FEW = 1_000_000


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def sample_key(doc_id: Column, weight: Column) -> Column:
    """-ln(u) / weight; u has 52 bits of md5(doc_id), equal in every engine."""
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    u = (F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(2**52))
    return -F.ln(u) / weight


def targets(sizes: DataFrame, weights: tuple[float, ...] = (3.0, 1.0, 2.0), share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """(source, source_size, target) from one row (source, source_size) a source.

    Sources by code point, null last, weigh ``weights`` in turn and share ``share``
    times all sizes; a target stops at ``cap`` times its source's size and the
    excess is reshared: each target is the least of its cap and one level times
    its weight."""
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.col("place") % len(weights) + 1).cast("int"))
    rows = _placed(sizes).select("source", "source_size", weight.alias("w")).withColumn("cap", F.col("source_size") * F.lit(float(cap)))
    level = _level(rows, share)
    fits = F.when(F.col("cap") > level * F.col("w"), level * F.col("w")).otherwise(F.col("cap"))
    return rows.select("source", "source_size", fits.alias("target"))


def _placed(sizes: DataFrame) -> DataFrame:
    """Adds each source's place, from 0, by code point, null last."""
    order = F.col("source").asc_nulls_last()
    if sizes.limit(FEW + 1).count() <= FEW:
        return sizes.withColumn("place", F.row_number().over(W.partitionBy(F.lit(1)).orderBy(order)) - 1)
    # ranges of sources, each ranked apart; written down, as another reading could draw other ranges
    rows = shared_table(sizes.repartitionByRange(order).withColumn("part", F.spark_partition_id()))
    counts = rows.groupBy("part").agg(F.count("*").alias("n"))
    before = counts.select("part", (F.sum("n").over(W.partitionBy(F.lit(1)).orderBy("part")) - F.col("n")).alias("before"))
    rank = F.row_number().over(W.partitionBy("part").orderBy(order)) - 1
    return rows.withColumn("rank", rank).join(F.broadcast(before), "part").select("source", "source_size", (F.col("rank") + F.col("before")).alias("place"))


def _level(rows: DataFrame, share: float) -> Column:
    """What a unit of weight gets: the level at which all targets, the capped ones
    included, use up the shared words.  The sources capped at one level raise the next, so
    it rises until no further source is capped; each step is one sum over the sources."""
    everything = rows.agg(F.sum("source_size").alias("n")).first().n
    level = 0.0
    while everything:
        capped = F.col("cap") <= F.lit(level) * F.col("w")
        sums = rows.agg(F.sum(F.when(capped, F.col("cap"))).alias("used"), F.sum(F.when(~capped, F.col("w"))).alias("w")).first()
        if sums.w is None:
            return F.lit(float("inf"))
        higher = (everything * share - (sums.used or 0.0)) / sums.w
        if higher <= level:
            break
        level = higher
    return F.lit(level)


def mix(docs: DataFrame, quality: DataFrame | None = None, weights: tuple[float, ...] = (3.0, 1.0, 2.0), share: float = 1.5, cap: float = 2.0, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """One row for each row of docs: doc_id, source, size (words), source_size,
    target, copies, taken (copies times size) and text_hash.

    ``quality`` is (doc_id, weight), weight over 0; a document without one weighs
    1, several are averaged.  A document is taken whole or not: the fractional
    part of an epoch ends where it comes nearest to its target, so a source is
    off by half a document at most.  A null or empty text has size 0; a null source
    is a source; rows of one doc_id share a key; an empty table gives an empty
    table; other columns are ignored.
    """
    base = docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), word_count(F.col(text)).alias("size"), F.xxhash64(text).alias("text_hash"))
    if quality is not None:
        known = quality.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.avg("weight").alias("weight"))
        base = base.join(known, "doc_id", "left")
    else:
        base = base.withColumn("weight", F.lit(1.0))
    key = sample_key(F.col("doc_id"), F.coalesce("weight", F.lit(1.0)))
    base = shared_table(base.withColumn("key", key).drop("weight"))
    n_bins = max(BINS, base.count() // IN_BIN)
    base = base.withColumn("bin", F.least(F.floor((1 - F.exp(-F.col("key"))) * n_bins), F.lit(n_bins - 1)).cast("int"))
    bins = base.groupBy("source", "bin").agg(F.sum("size").alias("n"))
    sizes = shared_table(bins.groupBy("source").agg(F.sum("n").alias("source_size")))
    before = F.sum("n").over(W.partitionBy("source").orderBy("bin").rowsBetween(W.unboundedPreceding, 0)) - F.col("n")
    goal = targets(sizes, weights, share, cap).withColumnRenamed("source", "g")
    bins = bins.withColumn("before", before).join(goal, F.col("source").eqNullSafe(F.col("g"))).drop("g", "n").withColumnsRenamed({"source": "b", "bin": "b_bin"})
    in_bin = W.partitionBy("source", "bin").orderBy("key", "doc_id", "size").rowsBetween(W.unboundedPreceding, 0)
    rows = base.withColumn("upto", F.sum("size").over(in_bin)).join(bins, F.col("source").eqNullSafe(F.col("b")) & (F.col("bin") == F.col("b_bin")))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("int")
    left = F.col("target") - epochs * F.col("source_size")
    extra = F.when((F.col("before") + F.col("upto")) * 2 - F.col("size") <= left * 2, 1).otherwise(0)
    copies = F.least(epochs + extra, F.lit(int(cap)))
    return rows.select("doc_id", "source", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).cast("long").alias("taken"), "text_hash")


def mixture(docs: DataFrame, quality: DataFrame | None = None, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The documents that the mix takes, with all their columns and two more, copies
    and taken; columns of these names in docs are replaced.  Rows alike in id and text share their copies evenly, rounded
    up."""
    rows = mix(docs, quality, doc_id=doc_id, text=text, **options).groupBy(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"))
    rows = rows.agg(F.ceil(F.avg("copies")).cast("int").alias("copies"), F.max("size").alias("__size")).where(F.col("copies") > 0)
    own = [c for c in docs.columns if c not in ("copies", "taken")]
    out = docs.select(*own, F.xxhash64(text).alias("__h")).join(rows, F.col(doc_id).eqNullSafe(F.col("__id")) & (F.col("__h") == F.col("__hash")))
    return out.select(*own, "copies", (F.col("copies") * F.col("__size")).alias("taken"))
