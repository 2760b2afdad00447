"""Near copies by the exact Jaccard similarity of word shingles.

A document is the set of its shingles' hashes, in one order that all documents
share: rare ones first.  Two sets of similarity 4/5 or more have a shingle in common
within each one's first n - ceil(4n/5) + 1, so a join on these meets every link;
sizes and positions bound what a pair can share, and the rest is counted exactly.
Which shingles count as frequent is read from a bounded sample: it decides the order,
and so the time, but no result.

A set's *parities* are bits that say how many of its shingles, modulo two, fall on each
place.  Where two sets differ in one, a shingle is in one of them only, so their distance
bounds the similarity: ``PLACES`` of them travel with the shingles, so that few pairs leave the
task that meets them, and those are held against parities of two places a shingle
before their sets are sent.

Sets are verified twice: first the candidates of simhash.near_dedup, by the SimHash of the
same shingles, and each set against the least of those it meets and a few more, which puts
dense groups into one component; then only pairs of different components, as sets of the
similarity can differ in more bits than SimHash's grid serves.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from warpline.llm import kernels as K
from warpline.llm import simhash
from warpline.llm.components import components
from warpline.llm.storage import drop_shared, shared_table

SHINGLE = 5
#: similarity as a fraction
LIKE = (4, 5)
#: documents whose shingles are counted for the order, occurrences that make one frequent, and most of these
SAMPLE, OFTEN, MOST = 10_000, 4, 100_000
#: rows of a batch to Spark
PART = 100_000
#: places of a set's parities at least, a power of two
PLACES = 512
#: documents whose ids are broadcast, at most; more are joined by a shuffle
FEW = 1_000_000
ROWS = "token long, fp long, n int, at int"
PAIRS = "u long, v long"


def need(n: np.ndarray) -> np.ndarray:
    """The least overlap of a set of n with any set that is like it."""
    return -(-LIKE[0] * n // LIKE[1])


def sets_of(buf: np.ndarray, off: np.ndarray, shingle: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each document in a chunk, sorted, and where each begins."""
    return distinct_of(*simhash.shingles_of(buf, off, shingle), len(off) - 1)


def distinct_of(h: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ones of each of n documents' hashes, sorted, and where each document's begin."""
    order = np.lexsort((h, owner))
    h, owner = h[order], owner[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
    return h[new], np.searchsorted(owner[new], np.arange(n + 1))


def _with_sets(rows: DataFrame, shingle: int, own: list[str], schema: str, make, fingerprints: bool = False) -> DataFrame:
    """Columns ``own`` of rows (with a column text), and what ``make`` makes of the sets of a
    chunk, and of its SimHash fingerprints if these are wanted."""
    names = [*own, *(c.split()[0] for c in schema.split(", "))]
    kinds = dict(rows.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, off = K.arrow_buffer(batch["text"])
            for a, b in K.chunks(off):
                h, owner = simhash.shingles_of(buf[off[a] : off[b]], off[a : b + 1] - off[a], shingle)
                near = simhash.majority(h, owner, b - a) if fingerprints else None
                flat, at = distinct_of(h, owner, b - a)
                del h, owner
                made = make(flat, at, near) if fingerprints else make(flat, at)
                yield pa.RecordBatch.from_arrays([*(batch[c][a:b] for c in own), *made], names)

    return rows.select("text", *own).mapInArrow(K.tidy(run), ", ".join([*(f"{c} {kinds[c]}" for c in own), schema]))


def _digests(flat: np.ndarray, at: np.ndarray) -> np.ndarray:
    raw = flat.tobytes()
    h = [xxhash.xxh64_intdigest(raw[8 * x : 8 * y], simhash.SEED) for x, y in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
    return np.array(h, K.U64).view(np.int64)


def parities(tokens: np.ndarray) -> np.ndarray:
    """How many of a set's shingles fall on each place, modulo two, as 64-bit words; two places
    a shingle or more, a power of two of them."""
    places = max(PLACES, 1 << (2 * len(tokens)).bit_length())
    odd = np.bincount((tokens & K.U64(places - 1)).astype(np.int64), minlength=places).astype(np.uint8) & 1
    return np.packbits(odd, bitorder="little").view(np.uint64)


def folded(words: np.ndarray, n: int) -> np.ndarray:
    """The same parities on n words of fewer places."""
    return np.bitwise_xor.reduce(words.reshape(-1, n))


def too_far(distance, size):
    """Whether sets of so many shingles together can't be alike if so many are in one only."""
    return distance * (LIKE[0] + LIKE[1]) > size * (LIKE[1] - LIKE[0])


def _parity_columns(flat: np.ndarray, at: np.ndarray) -> list[pa.Array]:
    wide = [parities(flat[a:b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
    few = [folded(w, PLACES // 64).view(np.int64) for w in wide]
    return [pa.array(few, pa.list_(pa.int64())), pa.array([w.tobytes() for w in wide], pa.binary())]


def _shingle_lists(flat: np.ndarray, at: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(flat.view(np.int64)))


def _frequent(docs: DataFrame, n_docs: int, shingle: int, text: str) -> np.ndarray:
    """Sorted hashes of shingles that many documents of the sample have."""
    share = max(1, n_docs // SAMPLE)
    some = docs.select(F.col(text).cast("string").alias("text")).where(F.pmod(simhash._text_hash("text"), F.lit(share)) == 0)

    def shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, off = K.arrow_buffer(batch["text"])
            for a, b in K.chunks(off):
                flat, _ = sets_of(buf[off[a] : off[b]], off[a : b + 1] - off[a], shingle)
                for k in range(0, len(flat), PART):
                    yield pa.RecordBatch.from_arrays([pa.array(flat[k : k + PART].view(np.int64))], ["token"])

    top = some.mapInArrow(K.tidy(shingles), "token long").groupBy("token").count().where(F.col("count") >= OFTEN)
    found = top.orderBy(F.desc("count"), "token").limit(MOST).select("token").collect()
    return np.sort(np.array([r.token for r in found], np.int64).view(K.U64))


def first_of(flat: np.ndarray, at: np.ndarray, frequent: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first shingles of each set that one like it must share, in order, and where each set's begin."""
    n = np.diff(at)
    owner = np.repeat(np.arange(len(n)), n)
    often = frequent[np.minimum(np.searchsorted(frequent, flat), len(frequent) - 1)] == flat if len(frequent) else np.zeros(len(flat), bool)
    ordered = flat[np.lexsort((flat, often, owner))]
    take = np.where(n > 0, n - need(n) + 1, 0)
    return ordered[np.arange(len(flat)) - at[:-1][owner] < take[owner]], np.concatenate(([0], np.cumsum(take)))


def _meeting(docs: DataFrame, frequent: np.ndarray, shingle: int, text: str) -> DataFrame:
    """(token, fp, n, at) of first shingles at which distinct sets meet that can be alike."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[int] = set()  # copies of a task's documents add nothing
        for batch in batches:
            buf, off = K.arrow_buffer(batch["text"])
            for a, b in K.chunks(off):
                flat, at = sets_of(buf[off[a] : off[b]], off[a : b + 1] - off[a], shingle)
                fp, n = _digests(flat, at), np.diff(at)
                new = np.zeros(len(fp), bool)
                for i, x in enumerate(fp.tolist()):
                    if x not in sent:
                        sent.add(x)
                        new[i] = True
                first, begins = first_of(flat, at, frequent)
                owner = np.repeat(np.arange(len(fp)), np.diff(begins))
                place = np.arange(len(first)) - begins[:-1][owner]
                keep = np.flatnonzero(new[owner])
                for k in range(0, len(keep), PART):
                    i = keep[k : k + PART]
                    yield pa.RecordBatch.from_arrays([pa.array(first[i].view(np.int64)), pa.array(fp[owner[i]]), pa.array(n[owner[i]].astype(np.int32)), pa.array(place[i].astype(np.int32))], ["token", "fp", "n", "at"])

    rows = docs.select(F.col(text).cast("string").alias("text"))
    return _by_token(rows.mapInArrow(K.tidy(spread), ROWS), ["token", "fp", "n", "at"], ROWS, partnered)


def _by_token(rows: DataFrame, columns: list[str], schema: str, make, order: str = "fp") -> DataFrame:
    """``make`` of the columns of whole tokens, sorted by token and ``order``; the column
    parity comes as a matrix."""
    names = [c.split()[0] for c in schema.split(", ")]

    def arrays(batch: pa.RecordBatch, c: str) -> np.ndarray:
        if c != "parity":
            return batch[c].to_numpy()
        return batch[c].flatten().to_numpy().view(np.uint64).reshape(-1, PLACES // 64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            new = [arrays(batch, c) for c in columns]
            held = new if held is None else [np.concatenate(x) for x in zip(held, new, strict=True)]
            cut = int(np.searchsorted(held[0], held[0][-1])) if len(held[0]) else 0
            if cut:
                for out in make([x[:cut] for x in held]):
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in out], names)
                held = [x[cut:] for x in held]
        if held is not None and len(held[0]):
            for out in make(held):
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in out], names)

    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.select(*dict.fromkeys([*columns, order])).repartition(n, "token").sortWithinPartitions("token", order).mapInArrow(K.tidy(run), schema)


def can_link(n, at, i, j) -> np.ndarray:
    """Whether sizes and places of the common shingle allow the similarity."""
    ni, nj = n[i].astype(np.int64), n[j].astype(np.int64)
    rest = 1 + np.minimum(ni - at[i] - 1, nj - at[j] - 1)
    top, all_ = LIKE[0], LIKE[0] + LIKE[1]
    return (np.minimum(ni, nj) >= need(np.maximum(ni, nj))) & (all_ * rest >= top * (ni + nj))


def partnered(held: list[np.ndarray]) -> Iterator[list[np.ndarray]]:
    """Rows that some other one of their token can be linked with, once each; of more than 16, all."""
    new = np.r_[True, (held[0][1:] != held[0][:-1]) | (held[1][1:] != held[1][:-1])]
    held = [x[new] for x in held]
    token, _, n, at = held
    edges = np.flatnonzero(np.r_[True, token[1:] != token[:-1], True])
    size = np.repeat(np.diff(edges), np.diff(edges))
    keep = size > 16
    for step in range(1, 16):
        i = np.flatnonzero((token[step:] == token[:-step]) & (size[step:] <= 16))
        if not len(i):
            break
        i = i[can_link(n, at, i, i + step)]
        keep[i] = keep[i + step] = True
    yield [x[keep] for x in held]


def may_be_alike(n: np.ndarray, at: np.ndarray, parity: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """can_link(), and whether the parities allow the similarity."""
    ok = np.flatnonzero(can_link(n, at, i, j))
    unlike = np.bitwise_count(parity[i[ok]] ^ parity[j[ok]]).sum(1, dtype=np.int64)
    out = np.zeros(len(i), bool)
    out[ok[~too_far(unlike, n[i[ok]].astype(np.int64) + n[j[ok]])]] = True
    return out


def _ordered_pairs(a: np.ndarray, b: np.ndarray) -> list[np.ndarray]:
    """The greater fingerprint first, each pair once."""
    both = np.unique(np.stack((np.maximum(a, b), np.minimum(a, b))), axis=1)
    return [both[0], both[1]]


def some(held: list[np.ndarray]) -> Iterator[list[np.ndarray]]:
    """Each set with the first of those that have the token, and with a few before it, if
    they aren't in one component."""
    token, fp, n, at, parity, group = held
    here = np.arange(len(token))
    begin = np.maximum.accumulate(np.where(np.r_[True, token[1:] != token[:-1]], here, 0))
    for other in (begin, *(here - back for back in (1, 2, 4, 8, 16))):
        i = here[(other >= begin) & (other < here)]
        i = i[group[i] != group[other[i]]]
        i = i[may_be_alike(n, at, parity, i, other[i])]
        yield _ordered_pairs(fp[i], fp[other[i]])


def across(held: list[np.ndarray], block: int = 1 << 17) -> Iterator[list[np.ndarray]]:
    """Pairs of sets of one token in different components that may be alike.  Sets of a token
    stand by size, so each meets only those that aren't too large for it."""
    token, fp, n, at, parity, group = held
    least = np.maximum(need(n.astype(np.int64)), 1)
    edges = np.flatnonzero(np.r_[True, token[1:] != token[:-1], True])
    begin = np.repeat(edges[:-1], np.diff(edges))
    here = np.arange(len(token))
    # the first of the token that is large enough: sizes rise within a token
    rank = np.repeat(np.arange(len(edges) - 1), np.diff(edges)).astype(np.int64) << 32
    low = np.maximum(begin, np.searchsorted(rank + n, rank + least))
    many = here - low
    done = np.concatenate(([0], np.cumsum(many)))
    a = 0
    while a < len(here):
        b = max(a + 1, int(np.searchsorted(done, done[a] + block, side="right")) - 1)
        j = np.repeat(here[a:b], many[a:b])
        i = np.repeat(low[a:b], many[a:b]) + np.arange(len(j)) - np.repeat(done[a:b] - done[a], many[a:b])
        ok = group[i] != group[j]
        i, j = i[ok], j[ok]
        ok = may_be_alike(n, at, parity, i, j)
        if ok.any():
            yield _ordered_pairs(fp[i[ok]], fp[j[ok]])
        a = b


def _alike(pairs: DataFrame, known: DataFrame, docs: DataFrame, shingle: int) -> DataFrame:
    """Those (u, v) whose sets are of the similarity; only documents of pairs that their
    parities leave send their sets.  known: doc_id, h, fp, n and wide of all rows of docs."""
    pairs, ends = shared_table(pairs.distinct()), lambda p: p.select(F.col("u").alias("fp")).union(p.select("v")).distinct()
    one = known.join(ends(pairs), "fp", "left_semi").groupBy("fp")
    one = shared_table(one.agg(F.min(F.struct("doc_id", "h")).alias("of"), F.first("n").alias("n"), F.first("wide").alias("wide")))

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for a, b, size in zip(batch["wide_u"], batch["wide_v"], batch["size"].to_pylist(), strict=True):
                a, b = (np.frombuffer(x.as_buffer(), np.uint64) for x in (a, b))
                n = min(len(a), len(b))
                keep.append(not too_far(int(np.bitwise_count(folded(a, n) ^ folded(b, n)).sum()), size))
            yield batch.select(["u", "v"]).filter(pa.array(keep, pa.bool_()))

    of = lambda c: one.select(F.col("fp").alias(c), F.col("n").alias(f"n_{c}"), F.col("wide").alias(f"wide_{c}"))
    near = pairs.join(of("u"), "u").join(of("v"), "v").select("u", "v", "wide_u", "wide_v", (F.col("n_u") + F.col("n_v")).alias("size"))
    near = shared_table(near.mapInArrow(K.tidy(close), PAIRS))
    chosen = shared_table(one.join(ends(near), "fp", "left_semi").select("fp", F.col("of.doc_id").alias("__id"), F.col("of.h").alias("__h")))
    some_ = F.broadcast(chosen) if chosen.count() <= FEW else chosen
    rows = docs.join(some_, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("h") == F.col("__h"))).select("fp", "text")
    sets = _with_sets(rows, shingle, ["fp"], "tokens array<long>", lambda flat, at: [_shingle_lists(flat, at)])
    sets = shared_table(sets.groupBy("fp").agg(F.first("tokens").alias("tokens")))
    both = near.join(sets.select(F.col("fp").alias("v"), F.col("tokens").alias("b")), "v").join(sets.select(F.col("fp").alias("u"), F.col("tokens").alias("a")), "u")
    common, size = F.size(F.array_intersect("a", "b")), F.size("a") + F.size("b")
    out = shared_table(both.where(common * (LIKE[0] + LIKE[1]) >= size * LIKE[0]).select("u", "v"))
    for table in (pairs, one, near, chosen, sets):
        drop_shared(table)
    return out


def alike_links(docs: DataFrame, known: DataFrame, candidates: DataFrame, n_docs: int, shingle: int = SHINGLE) -> DataFrame:
    """(u, v) links among digests of distinct sets that connect all of the similarity."""
    rows = _meeting(docs, _frequent(docs, n_docs, shingle, "text"), shingle, "text")
    parities = known.groupBy("fp").agg(F.first("parity").alias("parity"))
    rows = shared_table(shared_table(rows).join(parities, "fp"))
    meet = ["token", "fp", "n", "at", "parity", "group"]
    alone = rows.withColumn("group", F.col("fp"))
    near = _alike(candidates.unionByName(_by_token(alone, meet, PAIRS, some)), known, docs, shingle)
    named = components(near).select(F.col("node").alias("fp"), F.col("component").alias("group"))
    rest = rows.join(named, "fp", "left").withColumn("group", F.coalesce("group", "fp"))
    more = _alike(_by_token(rest, meet, PAIRS, across, "n"), known, docs, shingle)
    drop_shared(rows)
    return near.unionByName(more)


def similarity_check(rows: DataFrame, shingle: int) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """The check of simhash.near_dedup for a Jaccard similarity of 0.8 or more: rows with the
    digest of their set and its SimHash, and the links that hold, of the candidates and beyond."""

    def columns(flat, at, near):
        return [pa.array(_digests(flat, at)), pa.array(near.view(np.int64)), pa.array(np.diff(at).astype(np.int32)), *_parity_columns(flat, at)]

    known = shared_table(_with_sets(rows, shingle, ["doc_id", "h"], "fp long, simhash long, n int, parity array<long>, wide binary", columns, fingerprints=True))
    return known, lambda candidates: alike_links(rows, known, candidates, known.count(), shingle)


def drop_near_copies(docs: DataFrame, shingle: int = SHINGLE, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """docs with all their columns, one document of each component over links of a
    Jaccard similarity of 0.8 or more, by simhash.near_dedup with an exact check.

    Words are compared in ASCII lower case; texts without words are copies of each other.
    """
    return simhash.near_dedup(docs, shingle=shingle, doc_id=doc_id, text=text, check=similarity_check)
