"""Ranking of design and stitch files: link by name, score, judge, export.

The stages are plain DataFrames: summaries of both kinds of files, one preferred
stitch file a name, an inner join, and one projection with all the scores.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from warpline.functions import linkage as L
from warpline.operators import tables as T

PAIR = ("name", "design_path", "stitch_path", "stitch_count", "st", "stitch_error", "width_units", "width", "width_error", "color_count", "color_change_count", "color_changes", "quality", "coverage", "machine")


def keyed(df: DataFrame, normalize=L.normalize_name) -> DataFrame:
    """Adds ``name``, the normalised stem of the path; rows without one go."""
    stem = F.regexp_extract(F.replace(F.col("path"), F.lit("\\"), F.lit("/")), r"([^/]*?)(?:\.[^./]*)?$", 1)
    return df.withColumn("name", normalize(stem)).where(F.col("name") != "")


def preferred_stitches(stitches: DataFrame) -> DataFrame:
    return T.preferred(keyed(stitches), ["name"], T.preferred_path(F.col("path")))


def distinct_stitches(stitches: DataFrame) -> DataFrame:
    """All stitch files of a name with different contents (column sha256)."""
    return T.preferred(keyed(stitches), ["name", "sha256"], ["path"])


def rank(designs: DataFrame, stitches: DataFrame) -> DataFrame:
    """designs: path and metadata columns; stitches: path, header numbers st and co
    and summary columns, one row a name.  One scored row a pair."""
    d = keyed(designs).withColumnRenamed("path", "design_path")
    s = stitches if "name" in stitches.columns else keyed(stitches)
    rows = d.join(s.withColumnRenamed("path", "stitch_path"), "name")
    width, height = (L.declared_extent(F.col(a), F.col(b), F.col(c)) / L.WIDTH_SCALE for a, b, c in (("design_width", "design_left", "design_right"), ("design_height", "design_up", "design_down")))
    used = F.coalesce("st", "stitch_commands")
    rows = rows.withColumns({"width_units": width, "height_units": height, "stitches_used": used})
    declared = F.coalesce("co", "color_changes")
    same_changes, same_colours = L.colour_flags(F.col("color_change_count"), F.col("color_count"), declared)
    rows = rows.withColumns({
        "stitch_error": L.relative_error(F.col("stitch_count"), F.col("stitches_used")),
        "width_error": L.relative_error(F.col("width_units"), F.col("width")),
        "height_error": L.relative_error(F.col("height_units"), F.col("height")),
        "same_changes": same_changes, "same_colours": same_colours,
        "end_distance": L.end_distance(F.col("end_x") / L.END_SCALE, F.col("end_y") / L.END_SCALE, F.col("stitch_end_x"), F.col("stitch_end_y")),
    })
    w = L.WEIGHTS
    scores = L.weighted_scores([
        (L.similarity(F.col("stitch_error"), L.LARGEST_ERROR), w["stitches"]), (L.similarity(F.col("width_error"), L.LARGEST_ERROR), w["width"]),
        (L.similarity(F.col("height_error"), L.LARGEST_ERROR), w["height"]), (L.mean_available([F.col("same_changes"), F.col("same_colours")]), w["colours"]),
    ])
    rows = rows.withColumns(scores).withColumn("strict", L.strict(F.col("stitch_error"), F.col("width_error"), [F.col("same_changes"), F.col("same_colours")]))
    return rows.withColumn("verdict", L.verdict(F.col("evidence"), F.col("strict"))).orderBy(F.desc("evidence"), "name", "design_path")


def pair_metrics(designs: DataFrame, stitches: DataFrame) -> DataFrame:
    """The compact form of rank() for audits: one row a pair of design and stitch files of
    a name, all of them; the header's numbers only, and null or 0 widths give no ratio."""
    d = keyed(designs).withColumnRenamed("path", "design_path")
    rows = d.join(distinct_stitches(stitches).withColumnRenamed("path", "stitch_path"), "name")
    raw = L.declared_extent(F.col("design_width"), F.col("design_left"), F.col("design_right"))
    changes, colours = L.colour_flags(F.col("color_change_count").cast("long"), F.col("color_count").cast("long"), F.col("co"))
    return rows.select(
        "name", "design_path", "stitch_path", "stitch_count", "st", "stitch_commands",
        L.relative_error(F.col("stitch_count"), F.col("st")).alias("stitch_error"),
        F.coalesce(changes & colours, F.lit(False)).alias("colours_exact"),
        F.try_divide(raw, F.col("width")).alias("width_ratio"),
    )


def best(ranking: DataFrame, least: float = 99.0, most: int = 30) -> DataFrame:
    """The first ``most`` pairs of a quality of ``least`` or more, in the ranking's order."""
    return ranking.where(F.col("quality") >= least).orderBy(F.desc("evidence"), "name", "design_path").limit(most)


def any_format(designs: DataFrame, references: DataFrame, normalize=L.normalize_name) -> DataFrame:
    """(name, path, formats, references): designs (path) with the reference files
    (path, format) of their name in any format; without a match under the exact name, those under the
    name without leading digits."""
    r = keyed(references.select("path", "format"), normalize).withColumn("relaxed", L.relaxed_name(F.col("name")))
    lists = lambda by: r.where(F.col(by) != "").groupBy(F.col(by).alias("k")).agg(F.array_sort(F.collect_set("format")).alias("formats"), F.array_sort(F.collect_list(F.struct("format", "path"))).alias("references"))
    d = keyed(designs.select("path"), normalize).withColumn("relaxed", L.relaxed_name(F.col("name")))
    exact = d.join(lists("name"), F.col("name") == F.col("k")).withColumn("match", F.lit("exact"))
    rest = d.join(r.select("name").distinct(), "name", "left_anti").join(lists("relaxed"), F.col("relaxed") == F.col("k")).withColumn("match", F.lit("relaxed"))
    return exact.unionByName(rest).select("name", "path", "match", "formats", "references")


def formats_of(files: DataFrame, most: int = 50, normalize=L.normalize_name) -> DataFrame:
    """(name, n_formats, files): names with files (path, format) in two formats or more,
    most formats first; of several files of a format the last path stands."""
    rows = keyed(files.select("path", "format"), normalize).groupBy("name", "format").agg(F.max("path").alias("path"))
    out = rows.groupBy("name").agg(F.count("*").alias("n_formats"), F.array_sort(F.collect_list(F.struct("format", "path"))).alias("files"))
    return out.where("n_formats >= 2").orderBy(F.desc("n_formats"), "name").limit(most)


def strict_pairs(ranking: DataFrame) -> DataFrame:
    """The strict rows in PAIR's columns, by name and paths; a repeated pair is an error."""
    out = ranking.where("strict").select(*PAIR)
    if not T.duplicate_keys(out, ["design_path", "stitch_path"]).isEmpty():
        raise ValueError("a pair is listed twice")
    return out.orderBy("name", "design_path", "stitch_path")
