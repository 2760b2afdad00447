"""SimHash near-duplicates by segment-popcount embedding.

A fingerprint's 64 bits are cut into segments of two bits; the number of ones
in each is its embedding, and the Manhattan distance of two embeddings never
exceeds the Hamming distance of the fingerprints.  Of ``bits`` differing bits
one half of the fingerprint holds ``bits // 2`` at most, so each half's embedding
(16 counts) is a cell of a grid, and a range join within that radius meets every
link.  The join is an equi-join: each fingerprint stands in its own cell and in
the cells one step down, and a pair at distance one meets where the step was
taken.  Candidates are verified by their whole embeddings, then exactly.  Only
distinct fingerprints take part; a cell links them by a spanning forest.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from warpline.llm import kernels as K
from warpline.llm.components import components
from warpline.llm.storage import shared_table

SEED = 42
BITS = 3
EVEN = K.U64(0x5555555555555555)
#: fingerprints of a cell that are compared all with all; larger cells are dealt out again
DENSE = 2048
#: fingerprints (of all) that one task about spreads, and from how many on cells are dealt out by blocks
IN_TASK, MANY = 100_000, 1 << 30


def shingles_of(buf: np.ndarray, off: np.ndarray, shingle: int, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """(hash, document) of each word shingle in a chunk, repeats included; a document
    of fewer words has one shingle of them all."""
    buf = K.LOWER[buf]
    starts, ends, first = K.word_spans(buf, off)
    n = np.diff(first)
    if not len(starts):
        return np.zeros(0, K.U64), np.zeros(0, np.int64)
    # one space between words: the text of a shingle is then one slice
    size = ends - starts + 1
    to = np.cumsum(size) - size
    at = np.minimum(np.arange(int(size.sum())) + np.repeat(starts - to, size), len(buf) - 1)
    flat = buf[at]
    flat[to + size - 1] = 0x20
    raw = flat.tobytes()
    # of each document: shingles from each word but the last ones, or all its words
    doc = np.repeat(np.arange(len(n)), n)
    word = np.arange(len(starts))
    begins = np.flatnonzero((word + shingle <= first[1:][doc]) | ((n[doc] < shingle) & (word == first[:-1][doc])))
    last = np.minimum(begins + shingle, first[1:][doc[begins]]) - 1
    digest = xxhash.xxh64_intdigest
    a, b = to[begins].tolist(), (to[last] + size[last] - 1).tolist()
    return np.fromiter((digest(raw[x:y], seed) for x, y in zip(a, b, strict=True)), K.U64, len(a)), doc[begins]


def fingerprints_of(buf: np.ndarray, off: np.ndarray, shingle: int = 3, seed: int = SEED) -> np.ndarray:
    """The SimHash of each document in a chunk: majority bits over the XXH64 of its
    word shingles, repeats included."""
    return majority(*shingles_of(buf, off, shingle, seed), len(off) - 1)


def majority(h: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """The bits that over half of each of n documents' hashes have; zero without any."""
    out = np.zeros(n, K.U64)
    if not len(h):
        return out
    counts = np.bincount(owner, minlength=len(out))
    have = np.flatnonzero(counts)
    edge = np.concatenate(([0], np.cumsum(counts[have])))[:-1]
    for bit in range(64):
        ones = np.add.reduceat((h >> K.U64(bit)) & K.U64(1), edge)
        out[have] |= (ones.astype(np.int64) * 2 > counts[have]).astype(K.U64) << K.U64(bit)
    return out


def fingerprints(docs: DataFrame, shingle: int = 3, seed: int = SEED, doc_id: str = "doc_id", text: str = "text", text_hash: bool = False) -> DataFrame:
    """(doc_id, fp): fp is the fingerprint's 64 bits as a long; with ``text_hash``
    also h, a hash of the text as it is."""
    extra = ["h"] if text_hash else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, off = K.arrow_buffer(batch["text"])
            parts = [fingerprints_of(buf[off[a] : off[b]], off[a : b + 1] - off[a], shingle, seed) for a, b in K.chunks(off)]
            fp = np.concatenate(parts) if parts else np.zeros(0, K.U64)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(fp.view(np.int64)), *(batch[c] for c in extra)], ["doc_id", "fp", *extra])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"), *(_text_hash(text).alias(c) for c in extra))
    return rows.mapInArrow(K.tidy(run), ", ".join(f"{c} long" for c in ["doc_id", "fp", *extra]))


def _text_hash(text: str) -> Column:
    """Null and the empty text differ."""
    return F.xxhash64(F.col(text).cast("string"), F.col(text).isNull())


def embedding(x: np.ndarray) -> np.ndarray:
    """Ones in each two-bit segment, packed two bits each."""
    return (x & EVEN) + ((x >> K.U64(1)) & EVEN)


def cells_of(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, row, own): each fingerprint's own cell and those one step down, for both halves."""
    e = embedding(fp)
    keys, rows, own = [], [], []
    everyone = np.arange(len(fp))
    for half in (0, 1):
        part = (e >> K.U64(32 * half)) & K.U64(0xFFFFFFFF)
        tag = K.U64(half << 32)
        keys.append(part | tag)
        rows.append(everyone)
        own.append(np.ones(len(fp), bool))
        for s in range(16):
            have = np.flatnonzero((part >> K.U64(2 * s)) & K.U64(3))
            keys.append((part[have] - K.U64(1 << (2 * s))) | tag)
            rows.append(have)
            own.append(np.zeros(len(have), bool))
    return np.concatenate(keys), np.concatenate(rows), np.concatenate(own)


def close(a: np.ndarray, b: np.ndarray, bits: int) -> np.ndarray:
    """Within the Manhattan bound, then within the Hamming distance."""
    ea, eb = embedding(a), embedding(b)
    bound = np.zeros(len(a), np.int64)
    for s in range(0, 64, 2):
        bound += np.abs(((ea >> K.U64(s)) & K.U64(3)).astype(np.int64) - ((eb >> K.U64(s)) & K.U64(3)).astype(np.int64))
    near = bound <= bits
    near[near] = np.bitwise_count(a[near] ^ b[near]) <= bits
    return near


def cell_links(fp: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links (positions) among distinct fingerprints of one cell."""
    n = len(fp)
    root = np.arange(n)

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    us, vs = [], []

    def link(xs, ys):
        for x, y in zip(xs.tolist(), ys.tolist(), strict=True):
            p, q = find(x), find(y)
            if p != q:
                root[max(p, q)] = min(p, q)
                us.append(x)
                vs.append(y)

    def compare(ids):
        for k in range(0, len(ids), 64):
            left = ids[k : k + 64]
            near = np.bitwise_count(fp[left][:, None] ^ fp[ids][None, :]) <= bits
            x, y = np.nonzero(near)
            keep = left[x] < ids[y]
            link(left[x[keep]], ids[y[keep]])

    if n <= DENSE:
        compare(np.arange(n))
    else:  # of bits + 1 blocks of bits, one is equal: deal out by each in turn
        width = 64 // (bits + 1)
        for k in range(bits + 1):
            block = (fp >> K.U64(k * width)) & K.U64((1 << width) - 1)
            order = np.argsort(block, kind="stable")
            edges = np.flatnonzero(np.r_[True, np.diff(block[order]) != 0, True])
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                if b - a > 1:
                    compare(np.sort(order[a:b]))
    return np.array(us, np.int64), np.array(vs, np.int64)


def _links(keys: np.ndarray, fp: np.ndarray, node: np.ndarray, own: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(u, v): nodes to link, from rows sorted by cell."""
    us, vs = [], []
    edges = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1], True]) if len(keys) else np.zeros(1, np.int64)
    size = np.diff(edges)
    small = np.repeat(size <= 16, size)
    for step in range(1, 16):  # small cells: all rows of a distance at once
        i = np.flatnonzero(small[:-step] & (keys[:-step] == keys[step:])) if len(keys) > step else np.zeros(0, np.int64)
        if not len(i):
            break
        i = i[(own[i] | own[i + step]) & (node[i] != node[i + step])]
        i = i[close(fp[i], fp[i + step], bits)]
        us.append(node[i])
        vs.append(node[i + step])
    for g in np.flatnonzero(size > 16):
        ids, at = np.unique(node[edges[g] : edges[g + 1]], return_index=True)
        x, y = cell_links(fp[edges[g] : edges[g + 1]][at], bits)
        us.append(ids[x])
        vs.append(ids[y])
    return np.concatenate([*us, np.zeros(0, np.int64)]), np.concatenate([*vs, np.zeros(0, np.int64)])


def near_links(distinct: DataFrame, bits: int = BITS) -> DataFrame:
    """(u, v) links among (fp, node) rows of distinct fingerprints that connect all
    whose fingerprints differ in ``bits`` bits or fewer (three at most).

    A cell is compared by one task.  Of more than ``MANY`` fingerprints the fullest cells
    would grow too large for that (a cell has up to one in 2^16 of them, and its
    neighbours'), so each cell is then dealt out by equal blocks of bits: of ``bits + 1``
    blocks two linked fingerprints have one in common."""
    if not 0 <= bits <= 3:
        raise ValueError("the grid's radius serves 0 to 3 differing bits")
    n = distinct.count()
    finer = n > MANY

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps, nodes = batch["fp"].to_numpy().view(np.uint64), batch["node"].to_numpy()
            for k in range(0, len(fps), 20_000):
                fp, node = fps[k : k + 20_000], nodes[k : k + 20_000]
                key, row, own = cells_of(fp)
                for block in range(bits + 1) if finer else (None,):
                    cell = key if block is None else dealt(key, fp[row], block, bits)
                    yield pa.RecordBatch.from_arrays([pa.array(cell.view(np.int64)), pa.array(fp[row].view(np.int64)), pa.array(node[row]), pa.array(own)], ["cell", "fp", "node", "own"])

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            new = [batch["cell"].to_numpy(), batch["fp"].to_numpy().view(np.uint64), batch["node"].to_numpy(), batch["own"].to_numpy(zero_copy_only=False)]
            held = new if held is None else [np.concatenate(x) for x in zip(held, new, strict=True)]
            cut = int(np.searchsorted(held[0], held[0][-1])) if len(held[0]) else 0
            if cut:
                yield _pairs(*_links(*(x[:cut] for x in held), bits))
                held = [x[cut:] for x in held]
        if held is not None:
            yield _pairs(*_links(*held, bits))

    def _pairs(u, v):
        return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

    cells = distinct.select("fp", "node").mapInArrow(K.tidy(spread), "cell long, fp long, node long, own boolean")
    parts = max(int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions")), n // IN_TASK)
    return cells.repartition(parts, "cell").sortWithinPartitions("cell", "node").mapInArrow(K.tidy(match), "u long, v long")


def dealt(cell: np.ndarray, fp: np.ndarray, block: int, bits: int) -> np.ndarray:
    """A cell's key together with one block of a fingerprint's bits.  Keys of different cells may
    meet by chance: fingerprints are compared as they are, so that links nothing wrong."""
    width = 64 // (bits + 1)
    part = (fp >> K.U64(block * width)) & K.U64((1 << width) - 1 if width < 64 else 0xFFFFFFFFFFFFFFFF)
    return K.mix(K.mix(cell + K.U64(block << 40)) ^ part)


def simhash_components(docs: DataFrame, bits: int = BITS, shingle: int = 3, seed: int = SEED, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each row of docs: doc_id, fingerprint (16 hex digits) and
    component_id, the smallest doc_id reachable over links of ``bits`` or fewer
    differing bits.

    A null or empty text has no words and the fingerprint zero, linked like any
    other.  A null doc_id links as all do, but names no component unless the whole
    component has none; then it is null.  Repeated rows share a component.  An empty
    table gives an empty table; other columns are ignored.
    """
    fps = shared_table(fingerprints(docs, shingle, seed, doc_id, text))
    return _named(fps, lambda distinct: near_links(distinct, bits)).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def _named(fps: DataFrame, links: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Adds group, the least fingerprint of the component that ``links`` makes of the
    distinct (fp, node) rows, and component_id to fps, a table with doc_id and fp.

    A fingerprint is its own node: ids can be missing or stand on several."""
    distinct = fps.groupBy("fp").agg(F.min("doc_id").alias("least")).withColumn("node", F.col("fp"))
    found = components(links(distinct))
    named = shared_table(distinct.join(found, "node", "left").select("fp", F.coalesce("component", "fp").alias("group"), "least"))
    ids = named.groupBy("group").agg(F.min("least").alias("component_id"))
    return fps.join(shared_table(named.drop("least").join(ids, "group")), "fp")


def near_dedup(docs: DataFrame, bits: int = BITS, shingle: int = 3, doc_id: str = "doc_id", text: str = "text", check: Callable | None = None) -> DataFrame:
    """docs with all their columns, one document of each component: that with the
    component's own doc_id.  Rows without an id stay.  Of several rows with that id
    in the component one stays: of different texts that of the least hash, of equal
    texts any.

    With ``check`` near fingerprints are candidates: check(rows, shingle) of rows (doc_id, h,
    text) gives a table of doc_id, h, fp and simhash, where rows of one fp are copies, and
    a function from candidates (u, v) among these fp to the links that hold.

    Only ids and hashes are grouped; texts pass by a join against the rows to drop.
    """
    if check is None:
        fps = shared_table(fingerprints(docs, shingle, doc_id=doc_id, text=text, text_hash=True))
        found = _named(fps, lambda distinct: near_links(distinct, bits))
    else:
        rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), _text_hash(text).alias("h"), F.col(text).cast("string").alias("text"))
        fps, holding = check(rows, shingle)
        found = _named(fps.select("doc_id", "h", "fp"), lambda _: holding(candidates(fps, bits)))
    return one_of_each(docs, found, doc_id, text)


def candidates(fps: DataFrame, bits: int = BITS) -> DataFrame:
    """(u, v), u the greater, of rows (fp, simhash): links that connect all fp whose SimHash
    fingerprints differ in ``bits`` bits or fewer, each to the least fp of its own fingerprint."""
    fps = fps.select("fp", "simhash").distinct()
    least = shared_table(fps.groupBy("simhash").agg(F.min("fp").alias("least")))
    near = near_links(least.select(F.col("simhash").alias("fp"), F.col("simhash").alias("node")), bits)
    for c in ("u", "v"):
        near = near.join(least.select(F.col("simhash").alias(c), F.col("least").alias(f"least_{c}")), c)
    near = near.select(F.greatest("least_u", "least_v").alias("u"), F.least("least_u", "least_v").alias("v"))
    same = fps.join(least, "simhash").select(F.col("fp").alias("u"), F.col("least").alias("v"))
    return near.unionByName(same).where("u != v").distinct()


def one_of_each(docs: DataFrame, found: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each component of found, rows of doc_id, h, group and component_id."""
    found = found.where(F.col("doc_id").isNotNull())
    rows = found.groupBy("doc_id", "h").agg(F.count("*").alias("n"), F.min("group").alias("group"), F.min("component_id").alias("component_id"))
    rows = shared_table(rows.withColumn("own", F.col("doc_id") == F.col("component_id")))
    best = rows.where("own").groupBy("doc_id", "group").agg(F.min("h").alias("best"))
    rows = rows.join(best, ["doc_id", "group"], "left").withColumn("stays", F.col("own") & (F.col("h") == F.col("best")))
    # a table of known size: broadcast if small
    other = shared_table(rows.where(~F.col("stays") | (F.col("n") > 1)).select(F.col("doc_id").alias("__id"), F.col("h").alias("__h"), "stays"))
    here = docs.select("*", _text_hash(text).alias("__text_hash"))
    same = (F.col(doc_id).cast("long") == F.col("__id")) & (F.col("__text_hash") == F.col("__h"))
    once = here.join(other, same, "left_anti")
    repeated = here.join(other.where("stays"), same, "left_semi").dropDuplicates([doc_id, "__text_hash"])
    return once.unionByName(repeated).select(docs.columns)
