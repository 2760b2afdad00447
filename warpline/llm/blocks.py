"""Blocks and buckets: exact corpus-wide look-ups of hashed keys.

Documents are dealt into *blocks* by a hash of their id and text.  A block asks about
each of its distinct keys once, so a key that a third of all rows share costs
one entry a block.  Keys are ranged over *buckets* by their leading bits; a
bucket sees all blocks' requests for its keys and answers in the order asked.
Everything that moves is a packed array: one row for each block and bucket.

    packed --ask--> (block, bucket, tag, keys, load) --answer--> (block, bucket, tag, ans)
    packed + answers --apply--> rows

There are as many buckets as blocks, so packed rows number blocks times blocks.  A block
holds ``block_mb`` of text, or so much more that a row stands for ``ROW`` bytes of text:
rows then grow with the corpus, and blocks with its square root (8 MB up to 64 GB of text,
32 MB at 1 TB, 100 MB at 10 TB, 316 MB at 100 TB).

A block's *notes*, rows of a tag below 0, come back to it as they are, so that a later pass
need not find out again what an earlier one knew.

Keys are 64-bit hashes.  Where a match decides a result, the rest of a 127-bit hash
travels as load, and only keys that agree in both match.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from warpline.llm.kernels import U64, arrow_buffer

#: bytes of text that a packed row stands for, at least
ROW = 1_000
ASK = "block int, bucket int, tag int, keys binary, load binary"
ANSWER = "block int, bucket int, tag int, ans binary"
NOTE = pa.schema([("block", pa.int32()), ("bucket", pa.int32()), ("tag", pa.int32()), ("keys", pa.binary()), ("load", pa.binary())])


def block_count(docs: DataFrame, text: str = "text", block_mb: float = 8.0) -> int:
    """Blocks for this table, from the size of all its texts."""
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    return max(1, math.ceil(total / max(block_mb * 1e6, math.sqrt(total * ROW))))


def pack(docs: DataFrame, n_blocks: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(block, blob): the documents of a block, several rows of zstd-packed Arrow, dealt
    into a partition a block about."""
    rows = docs.select(
        F.pmod(F.xxhash64(F.col(doc_id), F.col(text)), F.lit(n_blocks)).cast("int").alias("block"),
        F.col(doc_id).cast("long").alias("doc_id"),
        F.col(text).cast("string").alias("text"),
    )

    def pack_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        options = pa.ipc.IpcWriteOptions(compression="zstd")
        for batch in batches:
            table = pa.Table.from_batches([batch])
            block = table["block"].to_numpy()
            order = np.argsort(block, kind="stable")
            table, block = table.select(["doc_id", "text"]).take(pa.array(order)), block[order]
            first = np.flatnonzero(np.r_[True, block[1:] != block[:-1]]) if len(block) else []
            blobs = []
            for a, b in zip(first, [*first[1:], len(block)], strict=True):
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, table.schema, options=options) as w:
                    w.write_table(table.slice(a, b - a).combine_chunks())
                blobs.append(sink.getvalue().to_pybytes())
            yield pa.RecordBatch.from_arrays([pa.array(block[first] if len(first) else [], pa.int32()), pa.array(blobs, pa.binary())], ["block", "blob"])

    return rows.mapInArrow(pack_batches, "block int, blob binary").repartition(n_blocks, "block")


def unpack(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(doc_id, null ids, text bytes, offsets) of a block, ordered by doc_id and
    text so that every reading numbers the documents alike."""
    parts = [pa.ipc.open_stream(x.as_buffer()).read_all() for x in table["blob"]]
    docs = pa.concat_tables(parts).sort_by([("doc_id", "ascending"), ("text", "ascending")])
    null = docs["doc_id"].is_null().to_numpy()
    ids = docs["doc_id"].fill_null(0).to_numpy()
    buf, off = arrow_buffer(docs["text"])
    return ids, null, buf, off


def crunch(x: np.ndarray) -> bytes:
    """An integer array as zstd-packed byte planes."""
    width = x.dtype.itemsize
    planes = np.ascontiguousarray(x.view(np.uint8).reshape(-1, width).T)
    return np.int64(len(x)).tobytes() + pa.compress(planes.tobytes(), codec="zstd", asbytes=True) if len(x) else b""


def uncrunch(raw: bytes, dtype) -> np.ndarray:
    dtype = np.dtype(dtype)
    if not raw:
        return np.zeros(0, dtype)
    n = int(np.frombuffer(raw[:8], np.int64)[0])
    planes = np.frombuffer(pa.decompress(raw[8:], decompressed_size=n * dtype.itemsize, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(dtype.itemsize, n).T).view(dtype).reshape(-1)


def bucket_edges(keys: np.ndarray, n_buckets: int) -> np.ndarray:
    """Where each bucket's range begins in sorted keys, with the end."""
    bounds = np.array([-(-(b << 64) // n_buckets) for b in range(1, n_buckets)], dtype=U64)
    return np.concatenate(([0], np.searchsorted(keys, bounds), [len(keys)]))


def steps(keys: np.ndarray) -> bytes:
    """Sorted keys as packed differences: a bucket's keys lie close, so their leading
    bytes cost nothing."""
    return crunch(np.diff(keys, prepend=U64(0)))


def unsteps(raw: bytes) -> np.ndarray:
    return np.cumsum(uncrunch(raw, np.uint64), dtype=np.uint64)


def requests(block: int, tag: int, keys: np.ndarray, load: np.ndarray, n_buckets: int) -> pa.Table:
    """One row a bucket for sorted keys with their load."""
    edges = bucket_edges(keys, n_buckets)
    rows = np.flatnonzero(edges[:-1] < edges[1:]).tolist()
    return pa.table({
        "block": pa.array([block] * len(rows), pa.int32()),
        "bucket": pa.array(rows, pa.int32()),
        "tag": pa.array([tag] * len(rows), pa.int32()),
        "keys": pa.array([steps(keys[edges[b] : edges[b + 1]]) for b in rows], pa.binary()),
        "load": pa.array([crunch(load[edges[b] : edges[b + 1]]) for b in rows], pa.binary()),
    })


def note(block: int, tag: int, values: np.ndarray) -> pa.Table:
    """One row that replies() gives back to the block; a tag below 0."""
    return pa.table([pa.array([x], t.type) for x, t in zip((block, block, tag, b"", crunch(values)), NOTE, strict=True)], schema=NOTE)


def replies(table: pa.Table, tag: int, dtype) -> np.ndarray:
    """The answers of one tag, aligned with the block's sorted distinct keys; or a note."""
    rows = table.filter(pa.compute.equal(table["tag"], tag)).sort_by("bucket")
    parts = [uncrunch(x.as_py(), dtype) for x in rows["ans"]]
    return np.concatenate(parts) if parts else np.zeros(0, dtype)


def ask(packed: DataFrame, fn: Callable[[int, pa.Table], pa.Table]) -> DataFrame:
    """fn(block, documents) makes a block's requests."""

    def run(key, table):
        return fn(key[0].as_py(), table)

    return packed.groupBy("block").applyInArrow(run, ASK)


def ask_again(packed: DataFrame, answers: DataFrame, fn: Callable[[int, pa.Table, pa.Table], pa.Table], schema: str = ASK) -> DataFrame:
    """fn(block, documents, answers so far); also makes the final rows."""

    def run(key, left, right):
        return fn(key[0].as_py(), left, right)

    return packed.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(run, schema)


def answer(asked: DataFrame, n_buckets: int, fn: Callable[[np.ndarray, np.ndarray, np.ndarray, int], np.ndarray], load_dtype) -> DataFrame:
    """fn(keys, load, block of each, tag) gives each request's answer, in order; a
    partition a bucket about."""

    def run(key, table):
        if key[1].as_py() < 0:
            return table.select(["block", "bucket", "tag", "load"]).rename_columns(["block", "bucket", "tag", "ans"])
        table = table.sort_by("block")
        keys = [unsteps(x.as_py()) for x in table["keys"]]
        load = [uncrunch(x.as_py(), load_dtype) for x in table["load"]]
        sizes = [len(k) for k in keys]
        block = np.repeat(table["block"].to_numpy(), sizes)
        out = fn(np.concatenate(keys), np.concatenate(load), block, key[1].as_py())
        parts = np.split(out, np.cumsum(sizes)[:-1])
        return pa.table({"block": table["block"], "bucket": table["bucket"], "tag": table["tag"], "ans": pa.array([crunch(p) for p in parts], pa.binary())})

    return asked.repartition(n_buckets, "bucket", "tag").groupBy("bucket", "tag").applyInArrow(run, ANSWER)


def grouped(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, starts, group of each in order): equal keys side by side, in order of arrival."""
    order = np.argsort(keys, kind="stable")
    s = keys[order]
    new = np.concatenate(([True], s[1:] != s[:-1])) if len(s) else np.zeros(0, bool)
    return order, np.flatnonzero(new), np.cumsum(new) - 1


def paired(keys: np.ndarray, checks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """grouped() by key and check."""
    order = np.lexsort((checks, keys))
    k, c = keys[order], checks[order]
    new = np.concatenate(([True], (k[1:] != k[:-1]) | (c[1:] != c[:-1]))) if len(k) else np.zeros(0, bool)
    return order, np.flatnonzero(new), np.cumsum(new) - 1


#: the bit of a load beside a check that isn't part of it
FLAG = U64(1)


def ask_whether(block: int, tag: int, keys: np.ndarray, checks: np.ndarray, several: np.ndarray, n_buckets: int) -> tuple[pa.Table, np.ndarray]:
    """(requests, where): asks once for each distinct key and check whether it is repeated,
    with a flag that it is so within the block; where: the request of each key given."""
    order, start, group = paired(keys, checks)
    flag = several(order, start, group).astype(U64)
    where = np.empty(len(keys), np.int64)
    where[order] = group
    return requests(block, tag, keys[order][start], (checks[order][start] & ~FLAG) | flag, n_buckets), where


def repeated(order: np.ndarray, start: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Which groups have two members or more."""
    return np.diff(np.append(start, len(order))) > 1


def answer_whether(keys: np.ndarray, load: np.ndarray, block: np.ndarray, tag: int) -> np.ndarray:
    """0: the key and check stand in one request without a flag; 1: repeated, and this is the
    first request of it; 2: repeated."""
    order, start, group = paired(keys, load & ~FLAG)
    found = np.add.reduceat((load[order] & FLAG).astype(np.int64) + 1, start) > 1
    verdict = np.where(found[group], 2, 0)
    verdict[start] = np.where(found, 1, 0)  # requests come by block: the first leads
    out = np.empty(len(keys), np.uint8)
    out[order] = verdict
    return out


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and how often each occurs."""
    s = np.sort(keys)
    first = np.flatnonzero(np.concatenate(([True], s[1:] != s[:-1]))) if len(s) else np.zeros(0, np.int64)
    return s[first], np.diff(np.append(first, len(s)))
