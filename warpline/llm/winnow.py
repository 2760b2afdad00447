"""Document fingerprints by winnowing.

Of every ``window`` consecutive k-byte gram hashes the least is kept, the
rightmost of equal ones, with its position.  Two texts that share ``window +
gram - 1`` bytes share a kept hash; no match shorter than ``gram`` is seen.  A
text with fewer grams than a window keeps its least one, and one shorter than a
gram keeps the hash of its bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from warpline.llm import blocks as B
from warpline.llm import kernels as K

GRAM, WINDOW = 12, 20
OUT = "doc_id long, n_chars long, edited binary, fingerprint string, positions array<int>, edited_fingerprint string, near_edited double, near_next double"
NULL_ID = np.iinfo(np.int64).min


def winnowed(buf: np.ndarray, off: np.ndarray, gram: int = GRAM, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, position in its bytes, 32-bit hash) of the kept grams of a chunk,
    by document and position.

    Hashes of 32 bits are compared, with the distance from the chunk's end below them, so
    that the rightmost of equal ones is least: what a document keeps depends on its own
    bytes only, not on its chunk."""
    low = K.U64(0xFFFFFFFF)
    pre = K.prefix(K.byte_values()[buf], "byte")
    size = np.diff(off)
    h = K.rolling(pre, gram, "byte") >> K.U64(32)
    packed = h << K.U64(32) | (low - np.arange(len(h), dtype=K.U64))
    packed[~K.inside(len(buf), off, gram)] = K.U64(0xFFFFFFFFFFFFFFFF)
    kept = []
    fits = K.inside(len(buf), off, gram + window - 1)
    if fits.any():
        kept.append(np.unique(K.sliding(packed, window)[fits]))
    short = np.flatnonzero((size >= gram) & (size < gram + window - 1))
    if len(short):
        edge = np.stack((off[:-1][short], off[1:][short] - gram + 1), 1).reshape(-1)
        kept.append(np.minimum.reduceat(np.append(packed, packed[-1]), edge)[::2])
    where = np.sort((low - (np.concatenate([*kept, np.zeros(0, K.U64)]) & low)).astype(np.int64))
    doc = np.searchsorted(off, where, side="right") - 1
    value = h[where].astype(np.uint32)
    tiny = np.flatnonzero((size > 0) & (size < gram))
    if len(tiny):
        whole = (K.spans_hash(pre, off[:-1][tiny], off[1:][tiny], "byte") >> K.U64(32)).astype(np.uint32)
        doc, where, value = np.concatenate((doc, tiny)), np.concatenate((where, off[:-1][tiny])), np.concatenate((value, whole))
        order = np.lexsort((where, doc))
        doc, where, value = doc[order], where[order], value[order]
    return doc, where - off[doc], value


def hex_lists(doc: np.ndarray, value: np.ndarray, n: int) -> pa.Array:
    """Eight hex digits for each hash, joined by document."""
    raw = value.astype(">u4").tobytes().hex().encode()
    off = np.concatenate(([0], np.cumsum(np.bincount(doc, minlength=n)))).astype(np.int64) * 8
    return pa.Array.from_buffers(pa.large_string(), n, [None, pa.py_buffer(off), pa.py_buffer(raw)]).cast(pa.string())


def likeness(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], n: int) -> np.ndarray:
    """Shared by all distinct hashes, of each of n pairs of documents; 1 for two
    empty fingerprints.  a, b: (pair, hash)."""
    x, y = (np.unique(d.astype(K.U64) << K.U64(32) | v.astype(K.U64)) for d, v in (a, b))
    both = np.bincount((np.intersect1d(x, y, assume_unique=True) >> K.U64(32)).astype(np.int64), minlength=n)
    each = sum(np.bincount((z >> K.U64(32)).astype(np.int64), minlength=n) for z in (x, y))
    return np.where(each > 0, both / np.maximum(each - both, 1), 1.0)


def fingerprints(docs: DataFrame, gram: int = GRAM, window: int = WINDOW, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each row of docs: doc_id, fingerprint (eight hex digits a kept
    hash, by position) and positions (byte offsets).  Null counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, off = K.arrow_buffer(batch["text"])
            for a, b in K.chunks(off):
                doc, where, value = winnowed(buf[off[a] : off[b]], off[a : b + 1] - off[a], gram, window)
                yield pa.RecordBatch.from_arrays([batch["doc_id"].slice(a, b - a), hex_lists(doc, value, b - a), _lists(doc, where, b - a)], ["doc_id", "fingerprint", "positions"])

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, f"doc_id {dict(rows.dtypes)['doc_id']}, fingerprint string, positions array<int>")


def _lists(doc: np.ndarray, where: np.ndarray, n: int) -> pa.Array:
    off = np.concatenate(([0], np.cumsum(np.bincount(doc, minlength=n)))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(off), pa.array(where.astype(np.int32)))


def revision_likeness(docs: DataFrame, gram: int = GRAM, window: int = WINDOW, doc_id: str = "doc_id", text: str = "text", block_mb: float = 8.0) -> DataFrame:
    """One row for each row of docs, in OUT's columns: its fingerprint, that of
    its edited text (the last half replaced by the first as many code points of the
    next document, by descending doc_id, after the last the first), and how alike
    the fingerprint is to the edited text's and to the next document's.

    A null or empty text is empty and has an empty fingerprint; two empty ones are
    alike (1).  Rows of one doc_id follow each other by text, null ids come last.  A
    table of one row is its own next document; an empty table gives an empty one.

    Documents are dealt by id ranges, so the next one is at hand; each range also
    gets a copy of the one document that follows it.  Ranges hold as much text as the
    blocks of ``blocks.py``, so their number, two numbers each of which come to the driver,
    grows with the square root of the corpus (316,000 at 100 TB).
    """
    rows = docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(NULL_ID)).alias("doc_id"), F.col(text).cast("string").alias("text"))
    parts = B.block_count(rows, "text", block_mb)
    cuts = rows.where(F.col("doc_id") != NULL_ID).approxQuantile("doc_id", [i / parts for i in range(1, parts)], 0.2 / parts) if parts > 1 else []
    bounds = np.unique(np.array(cuts, dtype=np.float64).astype(np.int64))

    def range_of(ids: np.ndarray) -> np.ndarray:
        return np.searchsorted(bounds, ids, side="right")

    def greatest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = np.sort(batch["doc_id"].to_numpy())
            part = range_of(ids)
            last = np.flatnonzero(np.append(part[1:] != part[:-1], True)) if len(ids) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(part[last]), pa.array(ids[last])], ["part", "doc_id"])

    heads = rows.select("doc_id").mapInArrow(greatest, "part long, doc_id long").groupBy("part").agg(F.max("doc_id").alias("doc_id")).orderBy("part").collect()
    used = [r.part for r in heads]
    before = {r.doc_id: used[(i + 1) % len(used)] for i, r in enumerate(heads)}  # whose range this document follows
    wanted = np.array(sorted(before), np.int64)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        options = pa.ipc.IpcWriteOptions(compression="zstd")
        for batch in batches:
            table = pa.Table.from_batches([batch])
            ids = table["doc_id"].to_numpy()
            copies = np.flatnonzero(np.isin(ids, wanted))
            part = np.concatenate((range_of(ids), [before[i] for i in ids[copies].tolist()])).astype(np.int64)
            rank = np.concatenate((np.zeros(len(ids), np.int8), np.ones(len(copies), np.int8)))
            take = np.concatenate((np.arange(len(ids)), copies))
            order = np.argsort(part, kind="stable")
            table, part, rank = table.take(pa.array(take[order])), part[order], rank[order]
            table = table.append_column("follows", pa.array(rank))
            first = np.flatnonzero(np.r_[True, part[1:] != part[:-1]]) if len(part) else []
            blobs = []
            for a, b in zip(first, [*first[1:], len(part)], strict=True):
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, table.schema, options=options) as w:
                    w.write_table(table.slice(a, b - a).combine_chunks())
                blobs.append(sink.getvalue().to_pybytes())
            yield pa.RecordBatch.from_arrays([pa.array(part[first] if len(first) else [], pa.int32()), pa.array(blobs, pa.binary())], ["block", "blob"])

    def finish(key, table):
        docs = pa.concat_tables([pa.ipc.open_stream(x.as_buffer()).read_all() for x in table["blob"]])
        docs = docs.set_column(1, "text", docs["text"].fill_null("")).sort_by([("follows", "ascending"), ("doc_id", "descending"), ("text", "ascending")])
        n = len(docs) - int(docs["follows"].to_numpy().sum())
        out = [chunk for chunk in _revisions(docs.slice(0, n + 1), n, gram, window)]
        return pa.concat_tables(out)

    return rows.mapInArrow(deal, "block int, blob binary").repartition(parts, "block").groupBy("block").applyInArrow(finish, OUT)


def _revisions(docs: pa.Table, n: int, gram: int, window: int) -> Iterator[pa.Table]:
    """Rows in order with the one that follows each; n of them are reported."""
    texts, ids = docs["text"], docs["doc_id"].to_numpy()
    size = np.cumsum(np.concatenate(([0], pa.compute.binary_length(texts).to_numpy())))
    for a, b in K.chunks(size[: n + 1]):
        part = texts.slice(a, b - a + 1).to_pylist()
        edited, chars = [], []
        for now, then in zip(part[:-1], part[1:], strict=True):
            half = len(now) // 2
            chars.append(len(now))
            edited.append((now[: len(now) - half] + then[:half]).encode())
        m = b - a
        prints = []
        for raw in ([x.encode() for x in part], edited):
            off = np.concatenate(([0], np.cumsum([len(x) for x in raw]))).astype(np.int64)
            prints.append(winnowed(np.frombuffer(b"".join(raw), np.uint8), off, gram, window))
        (doc, where, value), (e_doc, _, e_value) = prints
        own, then = doc < m, doc > 0
        yield pa.table({
            "doc_id": pa.array(ids[a:b], mask=ids[a:b] == NULL_ID),
            "n_chars": pa.array(chars, pa.int64()),
            "edited": pa.array(edited, pa.binary()),
            "fingerprint": hex_lists(doc[own], value[own], m),
            "positions": _lists(doc[own], where[own], m),
            "edited_fingerprint": hex_lists(e_doc, e_value, m),
            "near_edited": likeness((doc[own], value[own]), (e_doc, e_value), m),
            "near_next": likeness((doc[own], value[own]), (doc[then] - 1, value[then]), m),
        })
