"""Toxicity by the nearest labelled examples under exact TF-IDF cosine.

Fit, on a bounded sample of labelled rows (``Settings.sample``):

* terms are words and their leading 4 to 8 bytes, so inflected forms share some;
  those far more frequent in toxic examples are kept (likelihood ratio);
* document frequencies of the kept terms are counted over all documents;
* the examples become a block-max inverted index, and leave-one-out votes are
  calibrated by isotonic regression.

Score: of each document, the k nearest examples by exact cosine.  An upper bound
for each block of examples, from the largest weight of each term in it, orders
the blocks, and the search ends where no block can change the k nearest.  Votes
weigh by cosine.  The model's size is bounded by the sample, so it travels with the
task; documents are read where they lie, without a shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from warpline.llm import kernels as K
from warpline.llm.storage import shared_table

#: words: digits, ASCII letters (lower-cased) and all that isn't ASCII
GAP = np.zeros(256, dtype=bool)
GAP[:0x80] = True
GAP[0x30:0x3A] = GAP[0x41:0x5B] = GAP[0x61:0x7B] = False
STEM = 4
HEADS = (4, 5, 6, 7, 8)
BLOCK = 64


@dataclass(frozen=True)
class Settings:
    """``sample``: labelled rows to fit on, at most; ``lift``: how many times the
    share of toxic examples a term's own share must be; ``evidence``: its least
    likelihood ratio (G squared); ``support``: its least number of toxic examples;
    ``k``: neighbours; ``prior``: weight of the examples' share in each vote."""

    sample: int = 20_000
    lift: float = 4.0
    evidence: float = 25.0
    support: int = 5
    k: int = 15
    prior: float = 0.25
    threshold: float = 0.7


def held_out(doc_id: Column) -> Column:
    """Rows that are never learned from: crc32 of the id's text is 1 modulo 3."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def terms_of(buf: np.ndarray, off: np.ndarray, roots: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, term hash, root hash) of each term occurrence in a chunk; with
    roots (sorted), only of words whose stem is among them."""
    buf = K.LOWER[buf]
    starts, ends, first = K.word_spans(buf, off, GAP)
    doc = np.repeat(np.arange(len(off) - 1), np.diff(first))
    pre = K.prefix(K.byte_values()[buf], "byte")
    root = K.spans_hash(pre, starts, np.minimum(starts + STEM, ends), "byte")
    if roots is not None:
        some = np.zeros(1 << 16, bool)
        some[(roots & K.U64(0xFFFF)).astype(np.int64)] = True
        at = np.flatnonzero(some[(root & K.U64(0xFFFF)).astype(np.int64)])
        at = at[np.isin(root[at], roots)]
        starts, ends, doc, root = starts[at], ends[at], doc[at], root[at]
    docs, terms, stems = [], [], []
    size = ends - starts
    for length in (*HEADS, 0):
        at = np.flatnonzero((size >= length) if length else (size < HEADS[0]) | (size > HEADS[-1]))
        docs.append(doc[at])
        terms.append(K.spans_hash(pre, starts[at], starts[at] + length if length else ends[at], "byte"))
        stems.append(root[at])
    return np.concatenate(docs), np.concatenate(terms), np.concatenate(stems)


@dataclass
class Model:
    """Terms with their weights, the block-max index and the calibration."""

    settings: Settings
    terms: np.ndarray  # sorted hashes
    roots: np.ndarray  # sorted hashes
    share: float  # of toxic among all examples
    empty: float  # the same among examples without a term
    idf: np.ndarray = field(default_factory=lambda: np.zeros(0))
    labels: np.ndarray = field(default_factory=lambda: np.zeros(0))
    ids: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    postings: list = field(default_factory=list)  # of each term: (examples, weights)
    top: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))  # largest weight by term and block
    steps: tuple = ((), ())

    def vectors(self, buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document, term number, frequency), sorted by document and term."""
        doc, term, _ = terms_of(buf, off, self.roots)
        at = np.searchsorted(self.terms, term)
        known = np.flatnonzero((at < len(self.terms)) & (self.terms[np.minimum(at, len(self.terms) - 1)] == term)) if len(self.terms) else np.zeros(0, np.int64)
        pair, n = np.unique(doc[known] * np.int64(max(1, len(self.terms))) + at[known], return_counts=True)
        return pair // max(1, len(self.terms)), pair % max(1, len(self.terms)), n

    def weigh(self, term: np.ndarray, n: np.ndarray) -> np.ndarray:
        w = (1 + np.log(n)) * self.idf[term]
        return w / math.sqrt(float((w * w).sum()))

    def index(self, examples: list[tuple[np.ndarray, np.ndarray, int, int]]) -> None:
        """examples: (terms, frequencies, label, id).  Alike ones stand together, so
        that blocks differ in their largest weights."""
        rows = [(t, self.weigh(t, n), y, i) for t, n, y, i in examples]
        rows.sort(key=lambda r: (int(r[0][int(np.argmax(r[1]))]), tuple(r[0].tolist()), tuple(r[1].tolist()), r[3]))
        self.labels = np.array([r[2] for r in rows], float)
        self.ids = np.array([r[3] for r in rows], np.int64)
        blocks = -(-len(rows) // BLOCK)
        self.top = np.zeros((len(self.terms), blocks))
        lists: list = [([], []) for _ in self.terms]
        for e, (t, w, _, _) in enumerate(rows):
            for x, v in zip(t.tolist(), w.tolist(), strict=True):
                lists[x][0].append(e)
                lists[x][1].append(v)
                self.top[x, e // BLOCK] = max(self.top[x, e // BLOCK], v)
        self.postings = [(np.array(a, np.int64), np.array(b)) for a, b in lists]
        votes = [self.vote(*self.nearest(t, w, skip=e)) for e, (t, w, _, _) in enumerate(rows)]
        self.steps = isotonic(np.array(votes), self.labels)

    def nearest(self, term: np.ndarray, weight: np.ndarray, skip: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """(examples, cosines) of the k nearest with a cosine over 0, by cosine, then place."""
        bound = weight @ self.top[term]
        best_e, best_c = np.zeros(0, np.int64), np.zeros(0)
        for b in np.argsort(-bound, kind="stable"):
            if bound[b] <= 0 or (len(best_c) == self.settings.k and bound[b] * (1 + 1e-9) < best_c[-1]):
                break
            score = np.zeros(BLOCK)
            for t, w in zip(term.tolist(), weight.tolist(), strict=True):
                e, v = self.postings[t]
                x, y = np.searchsorted(e, (b * BLOCK, (b + 1) * BLOCK))
                score[e[x:y] - b * BLOCK] += w * v[x:y]
            at = np.flatnonzero(score > 0)
            at = at[at + b * BLOCK != skip]
            best_e, best_c = np.concatenate((best_e, at + b * BLOCK)), np.concatenate((best_c, np.round(score[at], 12)))
            keep = np.lexsort((best_e, -best_c))[: self.settings.k]
            best_e, best_c = best_e[keep], best_c[keep]
        return best_e, best_c

    def vote(self, examples: np.ndarray, cosines: np.ndarray) -> float:
        p = self.settings.prior
        return float((cosines @ self.labels[examples] + p * self.share) / (cosines.sum() + p))

    def score(self, term: np.ndarray, n: np.ndarray) -> tuple[float, str]:
        """(score, evidence): evidence lists example ids with their cosines."""
        if not len(term) or not len(self.labels):
            return self.empty, ""
        e, c = self.nearest(term, self.weigh(term, n))
        raw = self.vote(e, c)
        return float(np.interp(raw, *self.steps)), ",".join(f"{i}:{x:.3f}" for i, x in zip(self.ids[e[:3]].tolist(), c[:3].tolist(), strict=True))


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[tuple, tuple]:
    """Points of the best rising step function of y on x, each level with one
    pseudo-observation of the mean so that few examples never give 0 or 1."""
    if not len(x):
        return (0.0, 1.0), (0.0, 1.0)
    mean = float(y.mean())
    pools: list[list[float]] = []  # sum, count, least x, largest x
    for a, b in sorted(zip(x.tolist(), y.tolist(), strict=True)):
        pools.append([b, 1, a, a])
        while len(pools) > 1 and (pools[-2][3] == pools[-1][2] or pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]):
            last = pools.pop()
            pools[-1] = [pools[-1][0] + last[0], pools[-1][1] + last[1], pools[-1][2], last[3]]
    xs, ys = [], []
    for s, n, a, b in pools:
        level = (s + mean) / (n + 1)
        xs += [a, b + 1e-12]
        ys += [level, level]
    return tuple(xs), tuple(np.maximum.accumulate(ys).tolist())


def _chunks(batch: pa.RecordBatch):
    buf, off = K.arrow_buffer(batch["text"])
    for a, b in K.chunks(off):
        yield a, b, buf[off[a] : off[b]], off[a : b + 1] - off[a]


def _likelihood_ratio(toxic: int, n: int, all_toxic: int, everything: int) -> float:
    cells = ((toxic, n, all_toxic), (n - toxic, n, everything - all_toxic), (all_toxic - toxic, everything - n, all_toxic), (everything - all_toxic - n + toxic, everything - n, everything - all_toxic))
    return 2 * sum(o * math.log(o * everything / (r * c)) for o, r, c in cells if o > 0)


def fit(docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), doc_id: str = "doc_id", text: str = "text", label: str = "toxic") -> Model:
    """Fit a model on labelled rows that aren't held out."""
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    usable = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    chosen = usable.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg((F.avg(label) >= 0.5).cast("int").alias("y"))
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(settings.sample)  # so many rows of two numbers
    sample = shared_table(docs.join(F.broadcast(chosen), "doc_id").withColumn("h", F.xxhash64("text")))
    one = sample.groupBy("h").agg(F.min("doc_id").alias("doc_id"))  # equal texts count once
    sample = sample.join(F.broadcast(one), ["h", "doc_id"]).drop("h")
    counts = {int(r.y): int(r["count"]) for r in sample.groupBy("y").count().collect()}
    everything, toxic = sum(counts.values()), counts.get(1, 0)
    share = (toxic + 0.5) / (everything + 1)

    def count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = batch["y"].to_numpy()
            for a, b, buf, off in _chunks(batch):
                doc, term, root = terms_of(buf, off)
                order = np.lexsort((doc, term))
                doc, term, root = doc[order], term[order], root[order]
                once = np.flatnonzero(np.r_[True, (term[1:] != term[:-1]) | (doc[1:] != doc[:-1])]) if len(term) else np.zeros(0, np.int64)
                doc, term, root = doc[once], term[once], root[once]
                start = np.flatnonzero(np.r_[True, term[1:] != term[:-1]]) if len(term) else np.zeros(0, np.int64)
                n = np.diff(np.append(start, len(term)))
                t = np.add.reduceat(y[a:b][doc].astype(np.int64), start) if len(start) else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(term[start].view(np.int64)), pa.array(root[start].view(np.int64)), pa.array(n), pa.array(t)], ["term", "root", "n", "t"])

    stats = sample.mapInArrow(K.tidy(count_terms), "term long, root long, n long, t long").groupBy("term", "root").agg(F.sum("n").alias("n"), F.sum("t").alias("t"))
    stats = stats.where((F.col("t") >= settings.support) & (F.col("t") * everything >= F.col("n") * toxic * settings.lift))
    kept = [r for r in stats.collect() if _likelihood_ratio(r.t, r.n, toxic, everything) >= settings.evidence]
    terms = np.unique(np.array([r.term for r in kept], np.int64).view(np.uint64))
    roots = np.unique(np.array([r.root for r in kept], np.int64).view(np.uint64))
    model = Model(settings, terms, roots, share, share)
    if not len(terms):
        return model

    def count_documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(len(terms) + 1, np.int64)
        for batch in batches:
            for a, b, buf, off in _chunks(batch):
                _, t, _ = model.vectors(buf, off)
                df[:-1] += np.bincount(t, minlength=len(terms))
                df[-1] += b - a
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(df[at])], ["at", "df"])

    df = np.zeros(len(terms) + 1, np.int64)
    for r in docs.select("text").mapInArrow(K.tidy(count_documents), "at long, df long").groupBy("at").agg(F.sum("df").alias("df")).collect():
        df[r["at"]] = r["df"]
    model.idf = np.log((df[-1] + 1) / (df[:-1] + 1)) + 1

    def example_vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y, ids = batch["y"].to_numpy(), batch["doc_id"].to_numpy()
            for a, b, buf, off in _chunks(batch):
                doc, t, n = model.vectors(buf, off)
                edge = np.searchsorted(doc, np.arange(b - a + 1))
                rows = [(int(ids[a + d]), int(y[a + d]), t[edge[d] : edge[d + 1]].tolist(), n[edge[d] : edge[d + 1]].tolist()) for d in range(b - a)]
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), (pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64())), strict=True)], ["doc_id", "y", "t", "n"])

    rows = sample.mapInArrow(K.tidy(example_vectors), "doc_id long, y int, t array<long>, n array<long>").collect()
    none = [r.y for r in rows if not r.t]
    model.empty = (sum(none) + share) / (len(none) + 1)
    model.index([(np.array(r.t, np.int64), np.array(r.n, np.int64), r.y, r.doc_id) for r in rows if r.t])
    return model


def toxicity(docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), doc_id: str = "doc_id", text: str = "text", label: str = "toxic") -> DataFrame:
    """One row for each row of docs: doc_id, held_out, score (0 to 1), predicted
    (1 from ``settings.threshold`` on) and evidence (the nearest examples' ids with
    their cosines).

    The label, language, source and id are no input of a score.  A null or empty
    text, and any without a known term, gets the share of toxic examples among
    those without a term.  Null labels and ids aren't learned from; several labels
    of an id are averaged; without labels every score is 0.5.  Repeated rows are
    scored each; an empty table gives an empty table; other columns are ignored.
    """
    model = fit(docs, labels, settings, doc_id, text, label)
    rows = docs.select(F.col(doc_id).alias("doc_id"), held_out(F.col(doc_id)).alias("held_out"), F.col(text).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict = {}
        for batch in batches:
            scores, why = [], []
            for a, b, buf, off in _chunks(batch):
                doc, t, n = model.vectors(buf, off)
                edge = np.searchsorted(doc, np.arange(b - a + 1))
                for x, y in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
                    key = (t[x:y].tobytes(), n[x:y].tobytes())
                    if key not in seen:
                        if len(seen) > 50_000:
                            seen.clear()
                        seen[key] = model.score(t[x:y], n[x:y])
                    scores.append(seen[key][0])
                    why.append(seen[key][1])
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["held_out"], pa.array(scores, pa.float64()), pa.array(why, pa.string())], ["doc_id", "held_out", "score", "evidence"])

    out = rows.mapInArrow(K.tidy(run), f"doc_id {dict(rows.dtypes)['doc_id']}, held_out boolean, score double, evidence string")
    return out.withColumn("predicted", (F.col("score") >= settings.threshold).cast("int")).select("doc_id", "held_out", "score", "predicted", "evidence")


def drop_toxic(docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), doc_id: str = "doc_id", text: str = "text", label: str = "toxic") -> DataFrame:
    """docs with all their columns, without the documents that toxicity() predicts
    to be toxic."""
    model = fit(docs, labels, settings, doc_id, text, label)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, off = K.arrow_buffer(batch[text])
            keep = []
            for a, b in K.chunks(off):
                doc, t, n = model.vectors(buf[off[a] : off[b]], off[a : b + 1] - off[a])
                edge = np.searchsorted(doc, np.arange(b - a + 1))
                keep += [model.score(t[x:y], n[x:y])[0] < settings.threshold for x, y in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True)]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(K.tidy(run), docs.schema)
