"""Batches of tasks on files: variants, checks before the start, resumable runs."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from warpline.functions import coordinates as C
from warpline.operators import tables as T
from warpline.sources.files import exists


def folded(path: Column) -> Column:
    """A path as a key: any slash, any case."""
    return F.lower(F.replace(F.trim(path), F.lit("\\"), F.lit("/")))


def of_source(rows: DataFrame, source: str, limit: int | None = None) -> DataFrame:
    """The rows of one source file in their order, the first ``limit`` of them; an error
    if there are none, or if one of them has no output file."""
    if limit is not None and limit <= 0:
        raise ValueError("a limit is greater than zero")
    key = source.strip().replace("\\", "/").lower()
    chosen = rows.where(folded(F.col("file")) == key).orderBy("row")
    chosen = chosen if limit is None else chosen.limit(limit)
    state = chosen.agg(F.count("*").alias("n"), F.count_if(F.trim("output_file") == "").alias("blank")).first()
    if not state.n or state.blank:
        raise ValueError("no rows of this source" if not state.n else f"{state.blank} rows without an output file")
    return chosen


def clashes(rows: DataFrame, path: str, row: str = "row") -> DataFrame:
    """(path, first_row, row): rows that share an output path, in any case, each with the
    first that has it.  No path is sorted: the first is an aggregate that joins back."""
    keyed = rows.select(folded(F.col(path)).alias("path"), F.col(row).alias("row")).where(F.col("path") != "")
    first = keyed.groupBy("path").agg(F.min("row").alias("first_row"), F.count("*").alias("n")).where("n > 1").drop("n")
    return keyed.join(first, "path").where("row > first_row").select("path", "first_row", "row")


def variants(files: DataFrame, grid: DataFrame, folder: str) -> DataFrame:
    """(file, x, y, output_file): each file with each point of a grid in ticks of 0.01.
    The grid is the smaller side by far and is bounded by its own ranges."""
    unit = lambda c: (F.col(c) / F.lit(100)).cast("decimal(18,4)")
    stem = F.regexp_replace(F.substring_index(F.replace("file", F.lit("\\"), F.lit("/")), "/", -1), r"\.[^.]*$", "")
    rows = files.select("file").join(F.broadcast(grid.select("x", "y")))
    return rows.select("file", C.two_decimals(unit("x")).alias("x"), C.two_decimals(unit("y")).alias("y"), F.concat(F.lit(folder.rstrip("/") + "/"), C.variant_name(stem, unit("x"), unit("y"))).alias("output_file"))


def count_range(rows: DataFrame, key: list[str]) -> DataFrame:
    """(keys, least, most): number of keys, and of the rows of a key the least and the most."""
    return rows.groupBy(*key).agg(F.count("*").alias("n")).agg(F.count("*").alias("keys"), F.min("n").alias("least"), F.max("n").alias("most"))


def preflight(rows: DataFrame) -> DataFrame:
    """(row, finding) of tasks (row, file, x, y, output_file) that can't run: all are found before any work."""
    tests = {
        "source": ~F.coalesce(C.safe_path(F.col("file")), F.lit(False)),
        "x": C.parse_coordinate(F.col("x")).isNull(),
        "y": C.parse_coordinate(F.col("y")).isNull(),
        "output": ~F.coalesce(C.safe_path(F.col("output_file")), F.lit(False)),
    }
    found = F.filter(F.array(*(F.when(t, F.lit(n)) for n, t in tests.items())), lambda x: x.isNotNull())
    repeated = clashes(rows, "output_file").select("row", F.concat(F.lit("output of row "), F.col("first_row").cast("string")).alias("finding"))
    return rows.select("row", F.explode(found).alias("finding")).unionByName(repeated)


def missing_files(pairs: DataFrame, files: DataFrame, columns: list[str]) -> DataFrame:
    """(column, path): paths of pairs that no listed file (path) has; none may be left."""
    listed = files.select(folded(F.col("path")).alias("__k")).distinct()
    paths = pairs.unpivot([], columns, "column", "path").distinct()
    return paths.join(listed, folded(F.col("path")) == F.col("__k"), "left_anti")


def grouped(tasks: DataFrame, source: str, order: str) -> DataFrame:
    """(source key, tasks): the tasks of a source in order, so that it is opened once; a
    source has so many tasks as its grid has points."""
    rest = [order, *(c for c in tasks.columns if c not in (source, order))]
    return tasks.groupBy(folded(F.col(source)).alias(source)).agg(F.array_sort(F.collect_list(F.struct(*rest))).alias("tasks"))


def pending(tasks: DataFrame, results: DataFrame, key: list[str], mode: str, outputs: DataFrame | None = None) -> DataFrame:
    """tables.resume(), where with ``outputs`` (path) a success only counts if its
    output_file is still there."""
    if outputs is not None and mode == "resume":
        there = outputs.select(folded(F.col("path")).alias("__p")).distinct()
        gone = results.join(there, folded(F.col("output_file")) == F.col("__p"), "left_anti").where("status = 'success'")
        results = results.join(gone.select(*key).distinct(), key, "left_anti")
    return T.resume(tasks, results, key, mode)


def run_batch(tasks: DataFrame, act: Callable[[dict], dict], key: list[str], folder: str, mode: str = "resume", attempts: int = 3) -> DataFrame:
    """Runs act(task) for each pending task, up to ``attempts`` times, and returns the
    latest state of every task: key, status (success or error), error, attempts.

    Each wave of attempts is appended to the Parquet table ``folder``, so a run that
    breaks off goes on from its last wave; a task that fails is an error row, and fails
    alone.  Modes: "fresh" starts anew, "resume" leaves out what succeeded, "retry" takes
    only what last failed.  act runs on executors, once at least for every attempt."""
    spark, kinds = tasks.sparkSession, dict(tasks.dtypes)
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in key), "status string", "error string", "attempts int", "wave int"])

    def report() -> DataFrame:
        return spark.read.schema(schema).parquet(folder) if exists(spark, folder) else spark.createDataFrame([], schema)

    def latest() -> DataFrame:
        return report().groupBy(*key).agg(F.max_by(F.struct("status", "error", "attempts"), "wave").alias("__s")).select(*key, "__s.*")

    last = report().agg(F.max("wave").alias("w")).first().w
    wave = 0 if last is None else last + 1
    first, left = wave, attempts
    while left:
        if wave == first:
            todo = pending(tasks, latest(), key, mode)
        else:  # what failed in this run
            todo = tasks.join(report().where((F.col("wave") == wave - 1) & (F.col("status") == "error")).select(*key), key, "left_semi")
        tried, number = attempts - left + 1, wave

        def attempt(batches: Iterator[pd.DataFrame], tried=tried, number=number) -> Iterator[pd.DataFrame]:
            for batch in batches:
                rows = []
                for task in batch.to_dict("records"):
                    try:
                        act(task)
                        state = ("success", None)
                    except Exception as e:  # noqa: BLE001 - a failed task is a row
                        state = ("error", str(e) or type(e).__name__)
                    rows.append((*(task[c] for c in key), *state, tried, number))
                yield pd.DataFrame(rows, columns=[*key, "status", "error", "attempts", "wave"])

        if todo.isEmpty():
            break
        todo.mapInPandas(attempt, schema).write.mode("append").parquet(folder)
        wave, left = wave + 1, left - 1
    return latest()

