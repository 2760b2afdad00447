"""Nested sessions over event streams keyed by thread.

A begin raises a thread's depth, an end lowers it (not below zero); the step from
0 to 1 opens a new session.  Writes inside a session are kept, others dropped.
``session_writes`` is the batch form; ``stream_session_writes`` keeps the same
state in a streaming query.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from warpline.operators.sequence import ordered, running, running_overall


def session_writes(events: DataFrame, thread: str, order: str) -> DataFrame:
    """Adds ``session`` (1, 2 ... by thread) to the writes inside sessions.  The
    depth is the running level less its own least value, zero included."""
    step = F.when(F.col("event") == "begin", 1).when(F.col("event") == "end", -1).otherwise(0)
    rows = events.withColumn("__level", running(step, [thread], [order]))
    least = F.least(F.lit(0), F.min("__level").over(ordered([thread], [order])))
    rows = rows.withColumn("__depth", F.col("__level") - least)
    opened = F.when((F.col("event") == "begin") & (F.col("__depth") == 1), 1).otherwise(0)
    rows = rows.withColumn("session", running(opened, [thread], [order]))
    kept = (F.col("event") == "write") & (F.col("__depth") > 0)
    if "size" in events.columns:  # writes without bytes go
        kept = kept & (F.coalesce(F.col("size"), F.lit(0)) > 0)
    return rows.where(kept).drop("__level", "__depth")


def write_offsets(writes: DataFrame, order: str, size: str = "size") -> DataFrame:
    """Adds ``offset`` and ``number`` (from 1) of each write in one file that all threads
    append to; writes without bytes go."""
    out = running_overall(writes.where(F.col(size) > 0), size, order)
    return out.withColumn("offset", F.col("upto") - F.col(size)).withColumnRenamed("count", "number").drop("upto")


def before_after(events: DataFrame, thread: str, order: str, kind: str, value: str) -> DataFrame:
    """(thread, order, before, after): each event of kind "after" with the last "before" of
    its thread since the one "after" it; those without one go."""
    w = ordered([thread], [order])
    rows = events.where(F.col(kind).isin("before", "after"))
    rows = rows.withColumns({"__k": F.lag(kind).over(w), "__v": F.lag(value).over(w)})
    return rows.where((F.col(kind) == "after") & (F.col("__k") == "before")).select(thread, order, F.col("__v").alias("before"), F.col(value).alias("after"))


def routed_writes(events: DataFrame, stream: str, order: str, name: str) -> DataFrame:
    """Writes to streams of one name, from events (event, name, result, ``stream``): a
    stream counts from its first creation under the name with result 0; others and
    repeated creations of it change nothing."""
    opened = events.where((F.col("event") == "create") & (F.col("name") == name) & (F.col("result") == 0))
    opened = opened.groupBy(F.col(stream).alias("__s")).agg(F.min(order).alias("opened"))
    return events.where("event = 'write'").join(opened, F.col(stream) == F.col("__s")).where(F.col(order) > F.col("opened")).drop("__s")


def listen(query_writer, seconds: float | None = None):
    """Starts a streaming query and waits: so many seconds, after which it is stopped, or
    with None until all that is there now has been read."""
    query = (query_writer if seconds is not None else query_writer.trigger(availableNow=True)).start()
    query.awaitTermination(seconds) if seconds is not None else query.awaitTermination()
    if query.isActive:
        query.stop()
    return query


def stream_session_writes(events: DataFrame) -> DataFrame:
    """(thread, seq, session, size) of the writes inside sessions, from a stream of
    (thread, seq, event, size).  Rows of a micro-batch are taken by seq; across
    batches the order of arrival holds."""

    def run(key, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        depth, session = state.get if state.exists else (0, 0)
        rows = pd.concat(list(batches)).sort_values("seq")
        out = []
        for seq, event, size in zip(rows["seq"], rows["event"], rows["size"], strict=True):
            if event == "begin":
                depth += 1
                session += depth == 1
            elif event == "end":
                depth = max(0, depth - 1)
            elif depth and event == "write" and size:
                out.append((key[0], seq, session, size))
        state.update((int(depth), int(session)))
        yield pd.DataFrame(out, columns=["thread", "seq", "session", "size"])

    return events.groupBy("thread").applyInPandasWithState(run, "thread long, seq long, session long, size long", "depth long, session long", "append", "NoTimeout")
