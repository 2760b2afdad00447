"""Exact substring deduplication over bytes by a depth-limited radix sort of suffixes.

Only the first ``length`` bytes of a suffix matter, so suffixes are told apart
by most-significant-digit passes, and a group of one leaves the sort as soon
as it stands alone.  A pass over every suffix would move eight times the corpus,
so the digits are taken coarse to fine, each pass on hashes of whole digits:

1. the *anchor digit*: winnowing picks, in any ``length`` bytes, a ``length / 2``
   byte gram by content alone; suffixes whose windows hold no repeated anchor
   stand alone and leave.  With it goes the *stretch digit*: all bytes of the
   windows that begin between two anchors.  If a stretch is repeated, then so are
   all its windows; one occurrence stays in the sort for all of them;
2. the *core digit*: a window's *lead* is the first of the least grams in it, an anchor by
   content alone.  Windows of one lead, ``length / 16`` next to each other, have a core of
   bytes in common; those whose core stands alone leave.  So do most windows that stayed
   for a stretch's other occurrences;
3. the *full digit*: the remaining suffixes are ordered by all ``length`` bytes;
   groups of two or more are the repeated windows.

Digits are compared by 127-bit rolling hashes, on the blocks of ``blocks.py``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from warpline.llm import blocks as B
from warpline.llm import kernels as K

OUT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"
NONE = K.U64(0xFFFFFFFFFFFFFFFF)
NOWHERE = np.iinfo(np.int64).max - 1
#: tags: of the digits, and of the notes of a block's anchors
COARSE, CORE, FULL, ANCHORS, RANKS = 1, 2, 3, -4, -5


class _Chunk:
    """Bytes of some documents of a block, with anchors and stretches; their hashes only
    where the anchors weren't given."""

    def __init__(self, buf, off, length, anchors=None, rank=None):
        self.buf, self.off, self.length, n = buf, off, length, len(buf)
        self.gram = max(1, length // 2)
        self.reach = length - self.gram
        self.step = max(1, length // 16)
        self.fits = K.inside(n, off, length)
        none = np.zeros(0, np.int64)
        if anchors is not None:
            self.anchors, self.rank = anchors, rank
            self.stretch = self._whole()
            return
        self.anchors, self.rank, self.stretch = none, none, none
        self.keys = self.checks = none.astype(K.U64)
        if not self.fits.any():
            return
        pre, pre2 = (K.prefix(K.byte_values(kind)[buf], kind) for kind in ("byte", "byte check"))
        gram = K.rolling(pre, self.gram, "byte")
        gram[~K.inside(n, off, self.gram)] = NONE
        width = self.reach + 1
        least = K.sliding(gram, width)
        least[~self.fits] = 0
        pad = np.zeros(self.reach, K.U64)
        top = K.sliding(np.concatenate((pad, least, pad)), width, np.maximum)
        self.anchors = np.flatnonzero((top == gram) & (gram != NONE))
        self.stretch = self._whole()
        a, ends = self.anchors[self.stretch], self.anchors[self.stretch + 1] + length - 1
        stretches = K.mix(K.spans_hash(pre, a, ends, "byte") ^ K.U64(0x5851F42D4C957F2D))
        # anchors are the least of many grams: as they are, nearly all would fall into the first buckets
        grams = gram[self.anchors]
        self.rank = np.unique(grams, return_inverse=True)[1]
        self.keys = np.concatenate((K.mix(grams ^ K.U64(0x2545F4914F6CDD1D)), stretches))
        self.checks = np.concatenate((K.windows_hash(pre2, self.anchors, self.gram, "byte check"), K.spans_hash(pre2, a, ends, "byte check")))

    def _whole(self):
        """The anchors at which a stretch begins: the next one is of the same document, with all
        bytes of the windows up to it."""
        doc = np.searchsorted(self.off, self.anchors, side="right") - 1
        end = self.off[1:][doc]
        return np.flatnonzero((doc[:-1] == doc[1:]) & (self.anchors[1:] + self.length - 1 <= end[:-1]))

    def hashes(self, starts, length):
        """(keys, checks) of the windows of so many bytes at some starts."""
        size, doc = np.diff(self.off), np.searchsorted(self.off, starts, side="right") - 1
        used = np.zeros(len(size), bool)
        used[doc] = True
        before = np.concatenate(([0], np.cumsum(np.where(used, 0, size))))
        buf, starts = self.buf[np.repeat(used, size)], starts - before[doc]
        return tuple(K.windows_hash(K.prefix(K.byte_values(kind)[buf], kind), starts, length, kind) for kind in ("byte", "byte check"))

    def sort_out(self, repeated, verdict, lead):
        """(known, positions, core of each, starts of cores): windows known to be repeated, and
        those that the next digits have to order.  repeated: of anchors; verdict and lead: of
        stretches."""
        n, m = len(self.buf), len(self.fits)
        a, b = self.anchors[self.stretch], self.anchors[self.stretch + 1] if len(self.stretch) else self.stretch
        known, led = (self._between(a[x], b[x], m) for x in (verdict > 0, (verdict == 1) & lead))
        # by gram, then by place: the least of a window tells its lead's place, and whether it is repeated
        lead_at = np.full(n, NOWHERE)
        lead_at[self.anchors] = (self.rank * n + self.anchors) * 2 + repeated
        lead_at = K.sliding(lead_at, self.reach + 1)[:m]
        p = np.flatnonzero(self.fits & (lead_at & 1 > 0) & (~known | led))
        at = (lead_at[p] >> 1) % n
        start = at - (at - p) // self.step * self.step
        new = np.diff(start, prepend=-1) != 0
        return known, p, np.cumsum(new) - 1, start[new]

    @staticmethod
    def _between(a, b, m):
        edge = np.zeros(m + 1, np.int32)
        np.add.at(edge, a, 1)
        np.add.at(edge, np.minimum(b, m), -1)
        return np.cumsum(edge[:m]) > 0


def suffix_dedup(docs: DataFrame, length: int = 400, doc_id: str = "doc_id", text: str = "text", block_mb: float = 8.0) -> DataFrame:
    """One row for each row of docs: doc_id, n_bytes, n_removed, n_spans (maximal
    removed runs) and kept (the remaining UTF-8 bytes, concatenated).

    A null or empty text, or one shorter than ``length``, keeps all it has.  Equal
    rows count as different places, so both lose what they share.  Null ids are
    kept as they are.  An empty table gives an empty table; other columns are
    ignored.
    """
    n_blocks = B.block_count(docs, text, block_mb)
    packed = B.pack(docs, n_blocks, doc_id, text)

    def open_block(table: pa.Table, answers: pa.Table | None = None):
        ids, null, buf, off = B.unpack(table)
        spans = list(K.chunks(off))
        given = [()] * len(spans)
        if answers is not None:
            anchors, ranks = np.cumsum(B.replies(answers, ANCHORS, np.int64)), B.replies(answers, RANKS, np.int64)
            edges = np.searchsorted(anchors, off[[a for a, _ in spans] + [len(off) - 1]])
            given = [(anchors[x:y] - off[a], ranks[x:y]) for x, y, (a, _) in zip(edges[:-1], edges[1:], spans, strict=True)]
        return [_Chunk(buf[off[a] : off[b]], off[a : b + 1] - off[a], length, *x) for (a, b), x in zip(spans, given, strict=True)], ids, null, off[[a for a, _ in spans]]

    def asked(block, tag, hashes):
        """Asks about the (keys, checks) of each part, and notes where each one's answer will stand."""
        keys, checks = (np.concatenate(x) for x in zip(*hashes, strict=True))
        requests, where = B.ask_whether(block, tag, keys, checks, B.repeated, n_blocks)
        return pa.concat_tables([requests.cast(B.NOTE), B.note(block, -tag, where)])

    def verdicts(answers, tag):
        return B.replies(answers, tag, np.uint8)[B.replies(answers, -tag, np.int64)]

    def ask_coarse(block: int, table: pa.Table) -> pa.Table:
        parts, *_, first = open_block(table)
        anchors = np.concatenate([c.anchors + x for c, x in zip(parts, first, strict=True)])
        ranks = np.concatenate([c.rank for c in parts])
        return pa.concat_tables([asked(block, COARSE, [(c.keys, c.checks) for c in parts]), B.note(block, ANCHORS, np.diff(anchors, prepend=0)), B.note(block, RANKS, ranks)])

    def sieved(parts, answers):
        where, verdict = B.replies(answers, -COARSE, np.int64), verdicts(answers, COARSE)
        lead = np.zeros(len(where), bool)
        lead[np.unique(where, return_index=True)[1]] = True
        found, at = [], 0
        for c in parts:
            mid, end = at + len(c.anchors), at + len(c.anchors) + len(c.stretch)
            found.append(c.sort_out(verdict[at:mid] > 0, verdict[mid:end], lead[mid:end]))
            at = end
        return found

    def ask_core(block: int, table: pa.Table, answers: pa.Table) -> pa.Table:
        parts = open_block(table, answers)[0]
        return asked(block, CORE, [c.hashes(cores, length - c.step + 1) for c, (*_, cores) in zip(parts, sieved(parts, answers), strict=True)])

    def left(parts, answers):
        """(known, positions that the full digit has to order) of each part."""
        stays, out, at = verdicts(answers, CORE) > 0, [], 0
        for known, p, core, cores in sieved(parts, answers):
            out.append((known, p[stays[at : at + len(cores)][core]]))
            at += len(cores)
        return out

    def ask_full(block: int, table: pa.Table, answers: pa.Table) -> pa.Table:
        parts = open_block(table, answers)[0]
        return asked(block, FULL, [c.hashes(p, length) for c, (_, p) in zip(parts, left(parts, answers), strict=True)])

    def finish(block: int, table: pa.Table, answers: pa.Table) -> pa.Table:
        parts, ids, null, _ = open_block(table, answers)
        hit = verdicts(answers, FULL) > 0
        rows, at = [], 0
        for c, (known, p) in zip(parts, left(parts, answers), strict=True):
            starts = known.copy()
            starts[p[hit[at : at + len(p)]]] = True
            at += len(p)
            n, n_docs = len(c.buf), len(c.off) - 1
            gone = K.cover(starts, length, n)
            total = np.concatenate(([0], np.cumsum(gone)))
            begun = gone.copy()
            begun[1:] &= ~gone[:-1]
            cut = c.off[:-1][c.off[:-1] < c.off[1:]]
            begun[cut] |= gone[cut]
            spans = np.concatenate(([0], np.cumsum(begun)))
            n_gone = total[c.off[1:]] - total[c.off[:-1]]
            size = np.diff(c.off)
            kept = np.ascontiguousarray(c.buf[~gone])
            off = np.concatenate(([0], np.cumsum(size - n_gone))).astype(np.int64)
            rows.append(pa.table({"n_bytes": size, "n_removed": n_gone.astype(np.int64), "n_spans": (spans[c.off[1:]] - spans[c.off[:-1]]).astype(np.int64), "kept": pa.Array.from_buffers(pa.large_binary(), n_docs, [None, pa.py_buffer(off), pa.py_buffer(kept)]).cast(pa.binary())}))
        return pa.concat_tables(rows).add_column(0, "doc_id", pa.array(ids, mask=null))

    def answered(asked):
        return B.answer(asked, n_blocks, B.answer_whether, np.uint64).repartition(n_blocks, "block")

    # one plan: a table written in between would have the packed texts shuffled once more
    answers = answered(B.ask(packed, ask_coarse))
    for ask in (ask_core, ask_full):
        answers = answers.unionByName(answered(B.ask_again(packed, answers, ask)))
    return B.ask_again(packed, answers, finish, OUT)
