"""Language-model scores by stupid backoff over corpus n-gram counts.

Each block lists its distinct n-grams with their counts; buckets of the hashed
n-grams hold the count table and add up; the counts return to the blocks, where
each document's exploded n-grams look them up and are summed.  The model has as
many entries as the corpus has distinct n-grams.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from warpline.llm import blocks as B
from warpline.llm import kernels as K

OUT = "doc_id long, n_words long, score_micros long"
TOTAL = np.zeros(1, K.U64)  # the key of the number of words


def _grams(pre: np.ndarray, order: int) -> np.ndarray:
    h = K.rolling(pre, order, "word")
    return np.maximum(K.mix(h ^ K.U64(order * 0x9E3779B9)), K.U64(1))


def lm_score(docs: DataFrame, order: int = 3, backoff: float = 0.4, min_count: int = 2, doc_id: str = "doc_id", text: str = "text", block_mb: float = 8.0) -> DataFrame:
    """One row for each row of docs: doc_id, n_words and score_micros, the sum
    over words of ln S in millionths, each term rounded.

    Words are runs of other than space and 0x09-0x0D, with A-Z lower-cased.
    S(w | context) is count(context w) / count(context) for the longest context of
    up to ``order - 1`` words of the document whose n-gram has ``min_count``
    occurrences or more, times ``backoff`` for each word of context given up; a
    single word has its share of all words.  A null or empty text has no words and
    a score of 0.  Repeated rows count as often as they stand there.  An empty
    table gives an empty table; other columns are ignored.
    """
    n_blocks = B.block_count(docs, text, block_mb)
    packed = B.pack(docs, n_blocks, doc_id, text)

    def open_block(table: pa.Table):
        """Chunks: (first word of each document, keys of each order)."""
        ids, null, buf, off = B.unpack(table)
        parts = []
        for a, b in K.chunks(off):
            part, cut = K.LOWER[buf[off[a] : off[b]]], off[a : b + 1] - off[a]
            starts, ends, first = K.word_spans(part, cut)
            pre = K.prefix(K.word_hashes(part, starts, ends), "word")
            parts.append((first, [(_grams(pre, n), K.inside(len(starts), first, n)) for n in range(1, order + 1)]))
        return ids, null, parts

    def counted(parts):
        return B.distinct(np.concatenate([k[ok] for _, orders in parts for k, ok in orders]))

    def ask(block: int, table: pa.Table) -> pa.Table:
        _, _, parts = open_block(table)
        keys, times = counted(parts)
        words = sum(int(first[-1]) for first, _ in parts)
        out = B.requests(block, 1, keys, times.astype(np.uint64), n_blocks)
        # the number of words, under the key 0 that no n-gram has: one row a block
        total = B.requests(block, 2, TOTAL, np.array([words], np.uint64), n_blocks)
        return pa.concat_tables([out, total])

    def add_up(keys, times, block, tag):
        order_, start, group = B.grouped(keys)
        total = np.add.reduceat(times[order_], start)
        out = np.empty(len(keys), np.uint64)
        out[order_] = total[group]
        return out

    def finish(block: int, table: pa.Table, answers: pa.Table) -> pa.Table:
        ids, null, parts = open_block(table)
        keys, _ = counted(parts)
        counts = B.replies(answers, 1, np.uint64).astype(np.float64)
        words = float(B.replies(answers, 2, np.uint64)[0])
        n_words, score = [], []
        for first, orders in parts:
            n = int(first[-1])
            doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
            at = np.arange(n) - first[:-1][doc]
            have = [np.where(ok, counts[np.minimum(np.searchsorted(keys, k), len(keys) - 1)], 0.0) if n >= i + 1 else np.zeros(0) for i, (k, ok) in enumerate(orders)]
            value = have[0] / words if n else np.zeros(0)
            used = np.ones(n, np.int64)
            for size in range(2, order + 1):
                c = np.zeros(n)
                c[size - 1 :] = have[size - 1][: max(0, n - size + 1)]
                found = np.flatnonzero(c >= min_count)
                value[found] = c[found] / have[size - 2][found - size + 1]
                used[found] = size
            lost = np.minimum(at + 1, order) - used
            factor = np.array([backoff**i for i in range(order + 1)])
            micros = np.rint(np.log(value * factor[lost]) * 1e6).astype(np.int64)
            total = np.concatenate(([0], np.cumsum(micros)))
            n_words.append(np.diff(first).astype(np.int64))
            score.append(total[first[1:]] - total[first[:-1]])
        return pa.table({"doc_id": pa.array(ids, mask=null), "n_words": np.concatenate(n_words), "score_micros": np.concatenate(score)})

    counted_up = B.answer(B.ask(packed, ask), n_blocks, add_up, np.uint64)
    return B.ask_again(packed, counted_up, finish, OUT)
