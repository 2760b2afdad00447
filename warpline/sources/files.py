"""File scans: by suffix in any case, and a walk that also sees hidden folders."""

from __future__ import annotations

import os
from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


def scan_files(spark: SparkSession, folder: str, suffix: str, recursive: bool = True, any_case: bool = True) -> DataFrame:
    """(path, length, content) of files by suffix.  Folders whose names begin with
    a dot or underscore are skipped, as Spark's readers do."""
    glob = "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in suffix) if any_case else suffix
    reader = spark.read.format("binaryFile").option("pathGlobFilter", f"*{glob}")
    return reader.option("recursiveFileLookup", str(recursive).lower()).load(folder).select("path", "length", "content")


def exists(spark: SparkSession, path: str) -> bool:
    """Is there such a file or folder, in any file system that Spark reads?"""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(p)


def collect_files(spark: SparkSession, folder: str, suffix: str, **options) -> DataFrame:
    """scan_files(), but no rows where there is no such folder."""
    if exists(spark, folder):
        return scan_files(spark, folder, suffix, **options)
    return spark.createDataFrame([], "path string, length long, content binary")


def scan_formats(spark: SparkSession, folder: str, formats: Sequence[str]) -> DataFrame:
    """(path, format, length, content) of files of several formats, in any case, by one scan."""
    either = ",".join("".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in f) for f in formats)
    reader = spark.read.format("binaryFile").option("pathGlobFilter", f"*.{{{either}}}").option("recursiveFileLookup", "true")
    return reader.load(folder).select("path", F.lower(F.substring_index("path", ".", -1)).alias("format"), "length", "content")


def steps(path: Column) -> Column:
    """A path's parts in lower case, whichever slash divides them."""
    return F.split(F.lower(F.replace(path, F.lit("\\"), F.lit("/"))), "/")


def unfinished(path: Column, output_folder: str) -> Column:
    """Is the path a temporary file, or below the output folder?  Its parts have to
    follow each other as whole parts of the path, in any case."""
    parts = steps(path)
    wanted = [x for x in output_folder.replace("\\", "/").lower().split("/") if x]
    places = F.sequence(F.lit(1), F.greatest(F.size(parts) - len(wanted), F.lit(1)))
    below = F.exists(places, lambda i: F.slice(parts, i, F.lit(len(wanted))) == F.array(*map(F.lit, wanted))) if wanted else F.lit(False)
    return F.exists(parts, lambda x: F.startswith(x, F.lit("__processing_"))) | ((F.size(parts) > len(wanted)) & below)


def path_order() -> list[Column]:
    return [F.lower("path"), F.col("path")]


def documents(spark: SparkSession, path: str, name: str, fields: str) -> DataFrame:
    """The rows of a single JSON document's list ``name``; ``fields`` are their names and types
    as DDL.  A document without the list, or rows without one of the fields' names, are errors."""
    raw = spark.read.text(path, wholetext=True)
    kinds = [f.split()[0] for f in fields.split(", ")]
    rows = raw.select(F.explode_outer(F.from_json("value", f"`{name}` array<string>")[name]).alias("row"))
    rows = rows.select("row", F.json_object_keys("row").alias("keys"))
    bad = rows.where(F.col("keys").isNull() | (F.size(F.array_except(F.array(*map(F.lit, kinds)), "keys")) > 0))
    if not bad.isEmpty():
        raise ValueError(f"not a document with a list {name} of rows with {', '.join(kinds)}")
    return rows.select(F.from_json("row", fields).alias("r")).select("r.*")


class _File(InputPartition):
    def __init__(self, paths):
        self.paths = paths


class _Reader(DataSourceReader):
    def __init__(self, options):
        self.folder, self.suffix = options["path"], options.get("suffix", "").lower()

    def partitions(self):
        if not os.path.isdir(self.folder):
            raise FileNotFoundError(self.folder)
        found = sorted(os.path.join(d, f) for d, _, names in os.walk(self.folder) for f in names if f.lower().endswith(self.suffix))
        return [_File(found[i : i + 64]) for i in range(0, len(found), 64)] or [_File([])]

    def read(self, partition) -> Iterator[tuple]:
        for path in partition.paths:
            with open(path, "rb") as f:
                content = f.read()
            yield path, len(content), content


class DesignFiles(DataSource):
    """Files below ``path`` whose names end in ``suffix``, hidden folders included,
    from a folder that every executor mounts.  Planning only lists names."""

    @classmethod
    def name(cls) -> str:
        return "design_files"

    def schema(self) -> str:
        return "path string, length long, content binary"

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)
