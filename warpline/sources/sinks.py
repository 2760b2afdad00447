"""Report sinks: single documents written by the driver, and appended event logs.

A single document needs its rows on the driver, so each of these checks their
number first; tables of any size are written by Spark's own writers.
"""

from __future__ import annotations

import csv
import hashlib
import json
import os
import re
import tempfile
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MOST_ROWS = 100_000


def _rows(df: DataFrame, most: int) -> list[dict]:
    rows = df.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"a single document holds {most} rows at most")
    return [r.asDict(recursive=True) for r in rows]


def replace_file(path: str, text: str, encoding: str = "utf-8", overwrite: bool = True) -> None:
    """Write beside the target, then rename: readers see the old file or the new."""
    if not overwrite and os.path.exists(path):
        raise FileExistsError(path)
    folder = os.path.dirname(os.path.abspath(path))
    os.makedirs(folder, exist_ok=True)
    handle, temporary = tempfile.mkstemp(dir=folder)
    try:
        with os.fdopen(handle, "w", encoding=encoding, newline="") as f:
            f.write(text)
        os.replace(temporary, path)
    except BaseException:
        os.unlink(temporary)
        raise


def write_json(df: DataFrame, path: str, name: str = "rows", most: int = MOST_ROWS, **head) -> int:
    """One indented document: the head's fields, the number of rows, and the rows."""
    rows = _rows(df, most)
    replace_file(path, json.dumps(head | {"count": len(rows), name: rows}, ensure_ascii=False, indent=2, default=str) + "\n")
    return len(rows)


def write_csv(df: DataFrame, path: str, columns: Sequence[str] | None = None, sep: str = ",", most: int = MOST_ROWS, keep_empty: bool = False) -> int:
    """One CSV file with a byte order mark; other columns are left out; no file for
    an empty table unless ``keep_empty``."""
    columns = list(columns or df.columns)
    rows = _rows(df.select(*columns), most)
    if rows or keep_empty:
        from io import StringIO

        out = StringIO()
        w = csv.DictWriter(out, columns, delimiter=sep, lineterminator="\r\n")
        w.writeheader()
        w.writerows(rows)
        replace_file(path, out.getvalue(), "utf-8-sig")
    return len(rows)


def write_errors(errors: DataFrame, path: str, most: int = MOST_ROWS) -> int:
    """The error rows as JSON; without any, an older file goes."""
    n = len(_rows(errors.limit(1), 1)) and write_json(errors, path, "errors", most)
    if not n and os.path.exists(path):
        os.unlink(path)
    return n


def write_markdown(sections: Sequence[tuple[str, DataFrame]], path: str, most: int = 1_000) -> None:
    """A table for each section."""
    lines: list[str] = []
    for title, df in sections:
        lines += [f"## {title}", "", "| " + " | ".join(df.columns) + " |", "|" + "---|" * len(df.columns)]
        lines += ["| " + " | ".join("" if v is None else str(v).replace("|", "\\|") for v in r.values()) + " |" for r in _rows(df, most)]
        lines.append("")
    replace_file(path, "\n".join(lines))


def safe_name(name: str) -> str:
    return re.sub(r"[^0-9A-Za-z._-]+", "_", name).strip("._") or "stream"


def dump_streams(streams: DataFrame, folder: str) -> None:
    """Each (path, stream, raw) row as a file in a folder that all executors mount."""

    def write(rows) -> None:
        for r in rows:
            to = os.path.join(folder, safe_name(os.path.splitext(os.path.basename(r.path))[0]))
            os.makedirs(to, exist_ok=True)
            with open(os.path.join(to, safe_name(r.stream) + ".bin"), "wb") as f:
                f.write(r.raw)

    streams.select("path", "stream", "raw").foreachPartition(write)


def export_streams(streams: DataFrame, folder: str, names: dict[str, str]) -> None:
    """One folder a file with some of its streams under file names of their own (as a
    preview or an icon), and contents.json that lists all of them with their sizes."""
    rows = streams.groupBy("path").agg(F.array_sort(F.collect_list(F.struct("stream", F.length("raw").alias("size")))).alias("all"), F.collect_list(F.when(F.col("stream").isin(*names), F.struct("stream", "raw"))).alias("some"))

    def write(part) -> None:
        for r in part:
            to = os.path.join(folder, own_folder(r.path))
            os.makedirs(to, exist_ok=True)
            replace_file(os.path.join(to, "contents.json"), json.dumps([x.asDict() for x in r.all], ensure_ascii=False, indent=2) + "\n")
            for x in r.some:
                with open(os.path.join(to, names[x.stream]), "wb") as f:
                    f.write(x.raw)

    rows.foreachPartition(write)


def own_folder(path: str) -> str:
    """A folder name for a path; files of one stem in two folders stay apart."""
    path = path.replace("\\", "/")
    stem = os.path.splitext(os.path.basename(path))[0].strip()
    return f"{safe_name(stem)}-{hashlib.sha256(path.encode()).hexdigest()[:8]}"


def metadata_documents(files: DataFrame, metadata: DataFrame) -> DataFrame:
    """(path, document): each file's metadata as a JSON text, or why there is none."""
    have = metadata.select(F.col("path").alias("__p"), F.struct(*(c for c in metadata.columns if c != "path")).alias("__m"))
    none = F.to_json(F.struct(F.col("path").alias("filename"), F.lit(False).alias("available"), F.lit("the stream is missing").alias("reason")))
    rows = files.select("path").join(have, F.col("path") == F.col("__p"), "left")
    return rows.select("path", F.when(F.col("__p").isNull(), none).otherwise(F.to_json(F.struct(F.col("path").alias("filename"), "__m.*"))).alias("document"))


def append_blobs(path: str, raw: str = "raw"):
    """A foreachBatch function: the batch's bytes as Parquet beside its other columns as
    JSON lines; a batch that is run again replaces its own part."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/bytes/batch={batch_id}")
        batch.withColumn("size", F.length(raw)).drop(raw).write.mode("overwrite").json(f"{path}/log/batch={batch_id}")

    return write


def append_log(path: str):
    """A foreachBatch function that appends each micro-batch as JSON lines, once:
    a batch that is run again replaces its own part."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("batch", F.lit(batch_id)).write.mode("overwrite").json(f"{path}/batch={batch_id}")

    return write
