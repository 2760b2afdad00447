"""Cross-site line deduplication.

Each distinct line gets a HyperLogLog sketch of the sites that have it, merged
by aggregation, so a line of any frequency costs one small sketch a map task.
Lines whose estimate is near the threshold, by three standard errors and one
site at least, get an exact distinct count.  Lines of ``min_sites`` sites or
more are boilerplate.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from warpline.llm.storage import shared_table


BLANKS = " \t\n\x0b\x0c\r"


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _key(line: Column) -> tuple[Column, Column]:
    """Two 64-bit hashes of a line without the blanks at its ends."""
    line = F.btrim(line, F.lit(BLANKS))
    return F.when(line != "", F.xxhash64(line)).alias("h1"), F.xxhash64(F.lit(1), line).alias("h2")


def boilerplate(rows: DataFrame, min_sites: int = 10, lg_k: int = 12) -> DataFrame:
    """(h1, h2, first): keys of boilerplate lines among places(), and the first
    place of each, struct<doc_id, r1, r2, pos>."""
    stats = rows.groupBy("h1", "h2").agg(
        F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(lg_k))).alias("sites"),
        F.min(F.struct("doc_id", "r1", "r2", "pos")).alias("first"),
    )
    error = 1.04 / math.sqrt(2**lg_k)
    band = max(1, math.ceil(3 * error * min_sites))
    stats = stats.where(F.col("sites") >= min_sites - band)
    sure = stats.where(F.col("sites") > min_sites + band)
    near = stats.where(F.col("sites") <= min_sites + band)
    exact = rows.select("h1", "h2", "site").distinct().join(near.select("h1", "h2"), ["h1", "h2"], "left_semi").groupBy("h1", "h2").count()
    near = near.join(exact.where(F.col("count") >= min_sites), ["h1", "h2"], "left_semi")
    return sure.unionByName(near).drop("sites")


def _row(doc_id: str, text: str, site: str) -> tuple[Column, Column]:
    """Two hashes that stand for a row in every reading of the table."""
    return F.xxhash64(doc_id, text, site).alias("r1"), F.xxhash64(F.lit(1), doc_id, text, site).alias("r2")


def places(docs: DataFrame, doc_id: str, text: str, site: str) -> DataFrame:
    """A row for each line that isn't blank; a null site is a site of its own."""
    rows = docs.select(
        *_row(doc_id, text, site),
        F.col(doc_id).alias("doc_id"),
        F.coalesce(F.concat(F.lit("="), F.col(site).cast("string")), F.lit("")).alias("site"),
        F.posexplode(_lines(F.col(text))).alias("pos", "line"),
    )
    return rows.select("r1", "r2", "doc_id", "site", "pos", *_key(F.col("line"))).where(F.col("h1").isNotNull())


def line_dedup(docs: DataFrame, min_sites: int = 10, lg_k: int = 12, doc_id: str = "doc_id", text: str = "text", site: str = "source") -> DataFrame:
    """docs with all their columns; every boilerplate line is cut from the text
    but at its first place (least doc_id, then first line).  Two columns are
    added, n_lines and n_removed; columns of these names in docs are replaced.

    Lines are what newlines divide, compared without the blanks at their ends;
    blank lines are always kept.  A text whose lines all go becomes empty; a null
    text stays null and has one blank line.  A null site counts as one site.
    Null ids come first.  Rows of the same id, text and site are one place and
    fare alike.  An empty table gives an empty table.
    """
    own = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    rows = shared_table(places(docs, doc_id, text, site))
    # as a table of known size the keys are broadcast if small, and else joined
    # by two exchanges, of which a hot line's partition can be split
    keys = shared_table(boilerplate(rows, min_sites, lg_k))
    hits = rows.drop("site", "doc_id").join(keys, ["h1", "h2"])
    hits = hits.where(~F.struct("r1", "r2", "pos").eqNullSafe(F.struct("first.r1", "first.r2", "first.pos")))
    gone = hits.groupBy(F.col("r1").alias("__r1"), F.col("r2").alias("__r2")).agg(F.collect_set("pos").alias("__gone"))
    r1, r2 = _row(doc_id, text, site)
    out = docs.select(*(F.col(c) for c in own), r1.alias("__r1"), r2.alias("__r2")).join(gone, ["__r1", "__r2"], "left")
    kept = F.array_join(F.filter(_lines(F.col(text)), lambda line, i: ~F.array_contains(F.col("__gone"), i)), "\n")
    return out.select(
        *(F.when(F.col("__gone").isNull(), F.col(text)).otherwise(kept).alias(c) if c == text else F.col(c) for c in own),
        F.size(_lines(F.col(text))).cast("long").alias("n_lines"),
        F.coalesce(F.size(F.col("__gone")), F.lit(0)).cast("long").alias("n_removed"),
    )
