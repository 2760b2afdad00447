"""Exact substring deduplication over words, with difference-cover anchors.

A difference cover D of period v has, for any two positions i and j, a shift
below v that brings both into D.  So two equal runs of ``length`` words share an
equal *anchor* of ``length - v + 1`` words that begins at cover positions in
both documents, and only |D| / v of all positions (6 of 31) are hashed.  The
steps, on the blocks of ``blocks.py``:

1. ask for each anchor, whether it occurs in two or more documents;
2. extend: each full window around such an anchor asks for the smallest
   doc_id that has it;
3. remove the words that a window of a smaller doc_id covers.

Anchors are compared by a 64-bit rolling hash, as they only choose the windows; windows by
a 128-bit one.  The second 64 bits and the least doc_id of a window travel as its load.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from warpline.llm import blocks as B
from warpline.llm import kernels as K
from warpline.llm.storage import shared_table

#: Perfect difference sets (each nonzero difference occurs once).
COVERS = {
    3: (0, 1),
    7: (0, 1, 3),
    13: (0, 1, 3, 9),
    21: (0, 1, 4, 14, 16),
    31: (0, 1, 3, 8, 12, 18),
}
LAST = np.iinfo(np.int64).max
#: what travels with a window's key
WINDOW = np.dtype([("check", np.uint64), ("least", np.int64)])
OUT = "doc_id long, n_words long, n_removed long, text string"


def cover_for(length: int) -> tuple[int, int]:
    """(period, anchor length) for windows of so many words; the period takes up
    to two thirds of the window."""
    period = max((v for v in COVERS if v <= max(2, length * 2 // 3)), default=1)
    return period, length - period + 1


class _Chunk:
    """Words of some documents of a block, with anchors and windows."""

    def __init__(self, buf, off, ids, length, period, anchor):
        self.buf, self.ids = buf, ids
        self.starts, self.ends, self.first = K.word_spans(buf, off)
        n = len(self.starts)
        self.pre = K.prefix(K.word_hashes(buf, self.starts, self.ends), "word")
        self.pre2 = K.prefix(K.word_hashes(buf, self.starts, self.ends, "byte check"), "word check")
        self.doc = np.repeat(np.arange(len(ids)), np.diff(self.first))
        at = np.arange(n) - self.first[:-1][self.doc]
        chosen = np.zeros(period, bool)
        chosen[list(COVERS.get(period, (0,)))] = True
        fits = K.inside(n, self.first, anchor)
        self.anchors = np.flatnonzero(fits & chosen[at[: len(fits)] % period])
        self.length, self.reach = length, length - anchor

    def anchor_keys(self, anchor):
        return K.rolling(self.pre, anchor, "word")[self.anchors] if len(self.anchors) else np.zeros(0, K.U64)

    def windows(self, repeated):
        """(positions, keys, checks) of windows that hold a repeated anchor."""
        n = len(self.starts)
        near = np.zeros(n + 1, dtype=np.int32)
        at = self.anchors[repeated]
        np.add.at(near, np.maximum(at - self.reach, 0), 1)
        np.add.at(near, at + 1, -1)
        fits = K.inside(n, self.first, self.length)
        p = np.flatnonzero(fits & (np.cumsum(near)[: len(fits)] > 0))
        return p, K.windows_hash(self.pre, p, self.length, "word"), K.windows_hash(self.pre2, p, self.length, "word check")

    def kept(self, gone):
        """Texts of the remaining words, one space between."""
        keep = np.flatnonzero(~gone)
        doc, starts, ends = self.doc[keep], self.starts[keep], self.ends[keep]
        size = ends - starts + 1
        if len(keep):
            size[np.append(doc[1:] != doc[:-1], True)] -= 1
        to = np.cumsum(size) - size
        total = int(size.sum())
        out = self.buf[np.minimum(np.arange(total) + np.repeat(starts - to, size), max(len(self.buf) - 1, 0))] if total else np.zeros(0, np.uint8)
        blank = (to + (ends - starts))[(ends - starts) < size]
        out[blank] = 0x20
        off = np.zeros(len(self.ids) + 1, np.int64)
        np.cumsum(np.bincount(doc, weights=size, minlength=len(self.ids)).astype(np.int64), out=off[1:])
        return pa.Array.from_buffers(pa.large_binary(), len(self.ids), [None, pa.py_buffer(off), pa.py_buffer(np.ascontiguousarray(out))]).cast(pa.large_string()).cast(pa.string())


def substring_dedup(docs: DataFrame, length: int = 50, doc_id: str = "doc_id", text: str = "text", block_mb: float = 8.0) -> DataFrame:
    """One row for each row of docs: doc_id, n_words, n_removed and text, the
    kept words joined by single spaces.

    A null or empty text has no words and an empty result.  A null doc_id
    counts as greater than all others.  Repeated rows with one doc_id don't
    remove each other's words, as neither has a smaller doc_id.  An empty table
    gives an empty table; other columns are ignored.
    """
    period, anchor = cover_for(length)
    n_blocks = B.block_count(docs, text, block_mb)
    packed = B.pack(docs, n_blocks, doc_id, text)

    def open_block(table: pa.Table):
        ids, null, buf, off = B.unpack(table)
        ids = np.where(null, LAST, ids)
        out = []
        for a, b in K.chunks(off):
            out.append(_Chunk(buf[off[a] : off[b]], off[a : b + 1] - off[a], ids[a:b], length, period, anchor))
        return out, null

    def ask_anchors(block: int, table: pa.Table) -> pa.Table:
        parts, _ = open_block(table)
        keys = np.concatenate([c.anchor_keys(anchor) for c in parts])
        ids = np.concatenate([c.ids[c.doc[c.anchors]] for c in parts])
        order, start, _ = B.grouped(keys)
        ids = ids[order]
        last = np.append(start[1:], len(keys)) - 1
        several = (ids[start] != ids[last]).astype(np.uint8) if len(start) else np.zeros(0, np.uint8)
        return B.requests(block, 1, keys[order][start], several, n_blocks)

    def answer_anchors(keys, several, block, tag):
        order, start, group = B.grouped(keys)
        found = np.add.reduceat(several[order].astype(np.int64) + 1, start) > 1
        out = np.empty(len(keys), np.uint8)
        out[order] = found[group]
        return out

    def candidates(parts, first):
        keys = [c.anchor_keys(anchor) for c in parts]
        known, _ = B.distinct(np.concatenate(keys))
        repeated = B.replies(first, 1, np.uint8)
        return [c.windows(repeated[np.searchsorted(known, k)] > 0 if len(k) else np.zeros(0, bool)) for c, k in zip(parts, keys, strict=True)]

    def smallest(parts, found):
        keys, checks = (np.concatenate([f[i] for f in found]) for i in (1, 2))
        ids = np.concatenate([c.ids[c.doc[f[0]]] for c, f in zip(parts, found, strict=True)])
        order, start, group = B.paired(keys, checks)
        least = np.minimum.reduceat(ids[order], start) if len(start) else ids
        return keys, checks, ids, order, start, group, least

    def ask_windows(block: int, table: pa.Table, first: pa.Table) -> pa.Table:
        parts, _ = open_block(table)
        keys, checks, _, order, start, _, least = smallest(parts, candidates(parts, first))
        load = np.empty(len(start), WINDOW)
        load["check"], load["least"] = checks[order][start], least
        return B.requests(block, 2, keys[order][start], load, n_blocks)

    def answer_windows(keys, load, block, tag):
        order, start, group = B.paired(keys, load["check"])
        least = np.minimum.reduceat(load["least"][order], start)
        out = np.empty(len(keys), np.uint8)
        out[order] = load["least"][order] > least[group]
        return out

    def finish(block: int, table: pa.Table, answers: pa.Table) -> pa.Table:
        parts, null = open_block(table)
        found = candidates(parts, answers)
        keys, _, ids, order, _, group, least = smallest(parts, found)
        smaller = B.replies(answers, 2, np.uint8) > 0
        hit = np.empty(len(keys), bool)
        hit[order] = smaller[group] | (ids[order] > least[group]) if len(keys) else False
        rows, at = [], 0
        for c, (p, _, _) in zip(parts, found, strict=True):
            starts = np.zeros(len(c.starts), bool)
            starts[p[hit[at : at + len(p)]]] = True
            at += len(p)
            gone = K.cover(starts, length, len(c.starts))
            rows.append(pa.table({"n_words": np.diff(c.first).astype(np.int64), "n_removed": np.bincount(c.doc[gone], minlength=len(c.ids)).astype(np.int64), "text": c.kept(gone)}))
        out = pa.concat_tables(rows)
        own = np.concatenate([c.ids for c in parts])
        return out.add_column(0, "doc_id", pa.array(own, mask=null))

    asked = B.ask(packed, ask_anchors)
    first = shared_table(B.answer(asked, n_blocks, answer_anchors, np.uint8))
    second = B.answer(B.ask_again(packed, first, ask_windows), n_blocks, answer_windows, WINDOW)
    return B.ask_again(packed, first.unionByName(second), finish, OUT)
