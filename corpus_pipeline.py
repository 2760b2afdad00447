"""A corpus pipeline: toxic documents go, boilerplate lines go, one document of
each near-duplicate group stays, benchmark leaks go, and sources are mixed.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor
kept; its result is written as Parquet and read again.  All but the last
return the columns of documents, n_chars counted anew where a text changed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from warpline.llm import decontaminate, line_dedup, mixing, near_copies, toxicity
from warpline.llm.queries import quality_weights
from warpline.llm.storage import drop_shared, shared_table


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, _table(spark, sf_dir, "labels"))


def cut_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = line_dedup.line_dedup(docs)
    changed = F.col("n_removed") > 0
    return out.withColumn("n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_copies.drop_near_copies(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(docs, _table(spark, sf_dir, "benchmark"), action="documents")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixture(docs, quality_weights(spark, sf_dir))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", cut_boilerplate),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_leaks),
    ("mixing", mix_sources),
]

#: SQL can't express the first and third stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to documents, each written and read again."""
    docs = _table(spark, sf_dir, "documents")
    before = None
    for _, stage in STAGES:
        docs = shared_table(stage(spark, docs, sf_dir))
        if before is not None:
            drop_shared(before)
        before = docs
    return docs
