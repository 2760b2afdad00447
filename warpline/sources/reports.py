"""Delimited report files: sniffed separators, checked headers, safe rewriting."""

from __future__ import annotations

import csv

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The columns of a batch report.
REPORT = ("row", "source_file", "relative_source_file", "output_file", "relative_output_file", "requested_x", "requested_y", "old_x", "old_y", "actual_x", "actual_y", "status", "error", "attempts")


def read_table(spark: SparkSession, path: str, required: tuple[str, ...] = ()) -> DataFrame:
    """A CSV file with ; or , (whichever its header has more of), with or without
    a byte order mark; headers are lower-cased.  All columns are strings; a repeated
    or missing column, or a row with more values than the header, is an error; short
    rows are filled with nulls, blank lines skipped."""
    head = (spark.read.text(path).where(F.trim("value") != "").limit(1).first() or ("",))[0].lstrip("\ufeff")
    sep = ";" if head.count(";") >= head.count(",") else ","
    names = [c.strip().lower() for c in next(csv.reader([head], delimiter=sep), [])]
    if len(set(names)) < len(names):
        raise ValueError(f"repeated columns: {sorted({c for c in names if names.count(c) > 1})}")
    if missing := set(required) - set(names):
        raise ValueError(f"missing columns: {sorted(missing)}")
    schema = ", ".join([*(f"`{c}` string" for c in names), "`__more` string"])
    df = spark.read.schema(schema).csv(path, sep=sep, header=True, multiLine=True)
    if not df.where(F.col("__more").isNotNull()).isEmpty():
        raise ValueError("a row has more values than the header")
    return df.drop("__more")


def relative_to(path: Column, folder: str) -> Column:
    """What stands below a folder, with forward slashes; null for a path that isn't below it."""
    plain = F.replace(path, F.lit("\\"), F.lit("/"))
    root = folder.replace("\\", "/").rstrip("/") + "/"
    return F.when(F.startswith(F.lower(plain), F.lit(root.lower())), F.substring(plain, len(root) + 1, F.length(plain)))


def completed(report: DataFrame, input_folder: str, output_folder: str) -> DataFrame:
    """A report in REPORT's columns: values trimmed, columns that older reports lack as
    empty ones, blank attempts as 1, and blank relative paths derived from the full ones."""
    have = {c.strip(): c for c in report.columns}
    rows = report.select(*((F.coalesce(F.trim(F.col(f"`{have[c]}`")), F.lit("")) if c in have else F.lit("")).alias(c) for c in REPORT))
    rows = rows.where(F.concat(*REPORT) != "").withColumn("attempts", F.when(F.col("attempts") == "", "1").otherwise(F.col("attempts")))
    for full, folder in (("source_file", input_folder), ("output_file", output_folder)):
        short = f"relative_{full}"
        plain = F.replace(F.col(short), F.lit("\\"), F.lit("/"))
        rows = rows.withColumn(short, F.when(plain != "", plain).otherwise(F.coalesce(relative_to(F.col(full), folder), F.lit(""))))
    return rows


def successful(report: DataFrame) -> DataFrame:
    """Rows whose status is success; blank attempts count as one."""
    attempts = F.coalesce(F.nullif(F.trim(F.col("attempts").cast("string")), F.lit("")), F.lit("1")).cast("int")
    return report.where(F.trim("status") == "success").withColumn("attempts", attempts)


def violations(report: DataFrame) -> DataFrame:
    """Rows that no valid report has: an unknown status or bad attempts."""
    attempts = F.trim(F.col("attempts")).try_cast("int")
    bad = ~F.coalesce(F.trim("status").isin("success", "error"), F.lit(False)) | F.coalesce(attempts < 0, F.trim("attempts") != "")
    return report.where(bad)
