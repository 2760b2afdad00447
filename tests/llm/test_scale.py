"""What a large corpus changes: blocks, dealing, hash matches; and results held to plain versions."""

import random
import re
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from tests.llm.conftest import frame
from tests.llm.test_operators import BY, pairs, toxic_rows
from warpline.llm import blocks, components, decontaminate, kernels, mixing, near_copies, simhash, storage, suffix_dedup, toxicity, winnow


def test_blocks_grow_with_the_root_of_the_corpus(spark):
    docs = spark.range(1).select(F.lit("x").alias("text"))
    for total, block in ((10**6, 8e6), (10**12, 31.6e6), (10**14, 316e6)):
        sized = docs.select(F.lit(None).cast("string").alias("text"))
        sized.agg = lambda *_, total=total: type("One", (), {"first": lambda self: [total]})()
        n = blocks.block_count(sized)
        assert abs(n - max(1, total / block)) <= 0.01 * n + 1
        assert n * n <= max(1, total / blocks.ROW) * 1.01 + 1


def test_rows_without_an_id_are_dealt_to_several_blocks(spark):
    df = frame(spark, [(None, f"text {i}", "s") for i in range(200)])
    assert blocks.pack(df, 10).select("block").distinct().count() == 10


def test_a_match_needs_key_and_check():
    keys = np.array([5, 5, 5, 9, 9, 9], np.uint64)
    checks = np.array([2, 2, 8, 4, 6, 4], np.uint64)
    flags = np.array([0, 0, 0, 0, 1, 0], np.uint64)
    assert blocks.answer_whether(keys, checks | flags, np.arange(6), 1).tolist() == [1, 2, 0, 1, 1, 2]
    asked, where = blocks.ask_whether(3, 1, keys, checks, blocks.repeated, 4)
    found = [x for r in asked.to_pylist() for x in zip(blocks.unsteps(r["keys"]).tolist(), blocks.uncrunch(r["load"], np.uint64).tolist())]
    assert found == [(5, 2 | 1), (5, 8), (9, 4 | 1), (9, 6)] and where.tolist() == [0, 0, 1, 2, 3, 2]


def test_check_hashes_are_others():
    buf = np.frombuffer(b"abcabcabd", np.uint8)
    one, two = (kernels.rolling(kernels.prefix(kernels.byte_values(kind)[buf], kind), 3, kind) for kind in ("byte", "byte check"))
    assert one[0] == one[3] and two[0] == two[3] and not set(one.tolist()) & set(two.tolist()) and len(set(two.tolist())) == 4
    assert kernels.windows_hash(kernels.prefix(kernels.byte_values()[buf], "byte"), np.array([0, 6]), 3, "byte").tolist() == one[[0, 6]].tolist()


def test_shared_folder_has_to_be_named_on_a_cluster():
    class Context:
        master = "spark://host:7077"
        _jsc = type("J", (), {"sc": lambda self: type("S", (), {"getCheckpointDir": lambda self: type("O", (), {"isDefined": lambda self: False})()})()})()

    session = type("Session", (), {"conf": type("C", (), {"get": lambda self, *_: None})(), "sparkContext": Context()})()
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        storage.shared_dir(session)


@pytest.mark.parametrize("bits", [0, 2, 3])
def test_cells_dealt_by_blocks_give_the_same_links(spark, monkeypatch, bits):
    r = np.random.default_rng(7)
    centre = r.integers(0, 2**63, 12, dtype=np.uint64).tolist()
    fp = sorted({c ^ sum(1 << int(b) for b in r.choice(64, n, replace=False)) for c in centre for n in (0, 1, 2, 3, 4) for _ in range(12)})
    df = spark.createDataFrame([(int(np.uint64(f).view(np.int64)), i) for i, f in enumerate(fp)], "fp long, node long")
    found = lambda: {(x.node, x.component) for x in components.components(simhash.near_links(df, bits)).collect()}
    plain = found()
    monkeypatch.setattr(simhash, "MANY", 10)
    assert found() == plain and (plain or not bits)


@pytest.mark.parametrize("sizes", [[("a", 10), ("b", 400), ("c", 30), (None, 7)], [("a", 0), ("b", 0)], [("a", 5)], [(f"s{i:03d}", 1 + 7 * i % 90) for i in range(300)], []])
def test_targets_of_many_sources(spark, monkeypatch, sizes):
    df = spark.createDataFrame(sizes, "source string, source_size long")
    order = sorted(sizes, key=lambda s: (s[0] is None, (s[0] or "").encode()))
    weight = {s: (3.0, 1.0, 2.0)[k % 3] for k, (s, _) in enumerate(order)}
    total, free, goal = 1.5 * sum(n for _, n in sizes), dict(sizes), {}
    while free:
        level = (total - sum(goal.values())) / sum(weight[s] for s in free)
        over = [s for s, n in free.items() if 2 * n <= level * weight[s]]
        if not over:
            goal |= {s: level * weight[s] for s in free}
            break
        goal |= {s: 2.0 * free.pop(s) for s in over}
    for few in (1_000_000, 2):
        monkeypatch.setattr(mixing, "FEW", few)
        got = {r.source: r.target for r in mixing.targets(df).collect()}
        assert set(got) == set(goal) and all(abs(got[s] - goal[s]) < 1e-9 * (1 + goal[s]) for s in got)


@pytest.mark.parametrize("most", [50_000, 0])
def test_decontamination_leaves_clashing_columns_alone(spark, most):
    kinds = "doc_id long, text string, hits int, found string, gaps string, k1 int, k2 int, words string, spans int, n_hit int, rid int, length int, key string"
    more = (1, "f", "g", 2, 3, "w", 4, 5, 6, 7, "k")
    docs = spark.createDataFrame([(1, "Keep this. A b c d e f g h i j! And that.", *more), (2, None, *more), (3, "clean  text", *more)], kinds)
    bench = spark.createDataFrame([(1, "a b c d e f g h i j")], "item_id long, text string")
    cut = decontaminate.decontaminate(docs, bench, action="spans", max_set=most)
    assert cut.columns == docs.columns and sorted(map(tuple, cut.collect())) == [(1, "Keep this. And that.", *more), (2, None, *more), (3, "clean  text", *more)]
    kept = decontaminate.decontaminate(docs, bench, max_set=most)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [2, 3]
    assert sorted((r.doc_id, r.n_hit, r.item_ids) for r in decontaminate.contamination(docs, bench, max_set=most).collect()) == [(1, 10, ["1"]), (2, 0, []), (3, 0, [])]


def test_bits_of_a_large_benchmark(spark, monkeypatch):
    """Also where so few bits stand for the windows that most of them are set."""
    r = np.random.default_rng(3)
    words = [f"w{i}" for i in range(30)]
    text = lambda n: " ".join(r.choice(words, n))
    bench = spark.createDataFrame([(i, text(14)) for i in range(3_000)], "item_id long, text string")
    some = [x.text for x in bench.limit(20).collect()]
    docs = frame(spark, [(i, f"{text(20)} {some[i]} {text(9)}" if i < 20 else text(40), "s") for i in range(60)])
    rows = lambda most: sorted(map(repr, decontaminate.contamination(docs, bench, max_set=most).collect()))
    plain = rows(50_000)
    assert rows(100) == plain
    monkeypatch.setattr(decontaminate, "MOST_BITS", decontaminate.BITMAP)
    assert rows(100) == plain


def plain_winnowing(raw, gram, window):
    """Kept (position, hash) of one text, from each window in turn."""
    buf = np.frombuffer(raw, np.uint8)
    h = (kernels.rolling(kernels.prefix(kernels.byte_values()[buf], "byte"), gram, "byte") >> np.uint64(32)).tolist()
    if not h:
        whole = kernels.spans_hash(kernels.prefix(kernels.byte_values()[buf], "byte"), np.array([0]), np.array([len(raw)]), "byte")
        return [(0, int(whole[0]) >> 32)] if raw else []
    kept = set()
    for i in range(max(1, len(h) - window + 1)):
        part = h[i : i + window]
        kept.add(i + max(k for k, x in enumerate(part) if x == min(part)))
    return [(i, h[i]) for i in sorted(kept)]


def test_revisions_equal_a_plain_version(spark, odd):
    _, rows = odd
    rows = [r for r in rows if len(r[1] or "") < 20_000]
    order = sorted(pairs(rows), key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    prints = lambda t: plain_winnowing(t.encode(), winnow.GRAM, winnow.WINDOW)
    digits = lambda p: "".join(f"{h:08x}" for _, h in p)

    def like(a, b):
        a, b = {h for _, h in a}, {h for _, h in b}
        return round(len(a & b) / len(a | b), 9) if a | b else 1.0

    want = []
    for k, (i, t) in enumerate(order):
        t, then = t or "", order[(k + 1) % len(order)][1] or ""
        half = len(t) // 2
        own, edited = prints(t), prints(t[: len(t) - half] + then[:half])
        want.append((i, digits(own), [p for p, _ in own], digits(edited), like(own, edited), like(own, prints(then))))
    for block_mb in (0.005, 8.0):
        got = [(r.doc_id, r.fingerprint, r.positions, r.edited_fingerprint, round(r.near_edited, 9), round(r.near_next, 9)) for r in winnow.revision_likeness(frame(spark, rows), block_mb=block_mb).collect()]
        assert sorted(got, **BY) == sorted(want, **BY)


def test_a_text_is_winnowed_alike_in_every_chunk():
    r = np.random.default_rng(9)
    text = r.integers(97, 99, 3_000).astype(np.uint8)  # two letters: many equal hashes
    alone = winnow.winnowed(text, np.array([0, 3_000]))
    for before in (1, 70_000, 1_100_000):
        part = np.concatenate((r.integers(97, 123, before).astype(np.uint8), text))
        doc, where, value = winnow.winnowed(part, np.array([0, before, before + 3_000]))
        assert where[doc == 1].tolist() == alone[1].tolist() and value[doc == 1].tolist() == alone[2].tolist()


def test_scores_equal_a_plain_version(spark):
    """Cosines of whole vectors, votes and calibration of every document, without an index."""
    rows, labels = toxic_rows()
    rows += [(3000 + i, t, "s") for i, t in enumerate(("vile nastyx", "nasty vile vile abc", "", "words nobody has"))]
    docs, known = frame(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.fit(docs, known)
    n_terms, n = len(model.terms), len(model.labels)
    dense = np.zeros((n, n_terms))
    for x, (e, w) in enumerate(model.postings):
        dense[e, x] = w
    assert np.allclose((dense**2).sum(1), 1)
    buf = [np.frombuffer((t or "").encode(), np.uint8) for _, t, _ in rows]
    off = np.concatenate(([0], np.cumsum([len(b) for b in buf])))
    doc, term, times = model.vectors(np.concatenate(buf), off)
    df = np.bincount(term, minlength=n_terms)
    assert np.allclose(model.idf, np.log((len(rows) + 1) / (df + 1)) + 1)
    got = {r.doc_id: r.score for r in toxicity.toxicity(docs, known).collect()}
    for k, (i, _, _) in enumerate(rows):
        own = np.zeros(n_terms)
        own[term[doc == k]] = (1 + np.log(times[doc == k])) * model.idf[term[doc == k]]
        if not own.any():
            assert got[i] == model.empty
            continue
        cos = np.round(dense @ (own / np.linalg.norm(own)), 9)
        best = sorted((x for x in range(n) if cos[x] > 0), key=lambda x: (-cos[x], x))[: model.settings.k]
        edge = cos[best[-1]]
        if sum(cos == edge) > sum(cos[best] == edge):  # a tie at the last place may fall either way
            continue
        vote = (sum(cos[x] * model.labels[x] for x in best) + model.settings.prior * model.share) / (sum(cos[best]) + model.settings.prior)
        assert got[i] == pytest.approx(float(np.interp(vote, *model.steps)), abs=1e-6) or abs(np.interp(vote - 1e-8, *model.steps) - np.interp(vote + 1e-8, *model.steps)) > 0


def test_parities_never_part_what_is_alike():
    r = np.random.default_rng(12)
    for _ in range(200):
        common = r.integers(0, 2**63, int(r.integers(1, 900)), dtype=np.uint64)
        more = r.integers(0, 2**63, len(common) // 4, dtype=np.uint64)
        cut = int(r.integers(0, len(more) + 1))
        sets = [np.unique(np.concatenate((common, x))) for x in (more[:cut], more[cut:])]
        wide, size = [near_copies.parities(x) for x in sets], sum(map(len, sets))
        both = len(np.intersect1d(*sets))
        if 5 * both >= 4 * (size - both):
            for n in (near_copies.PLACES // 64, min(map(len, wide))):
                a, b = (near_copies.folded(x, n) for x in wide)
                assert not near_copies.too_far(int(np.bitwise_count(a ^ b).sum()), size)


def test_near_copies_beyond_a_broadcast(spark, monkeypatch, odd):
    df, rows = odd
    plain = sorted(map(repr, near_copies.drop_near_copies(df).select("doc_id", "text").collect()))
    monkeypatch.setattr(near_copies, "FEW", 0)
    assert sorted(map(repr, near_copies.drop_near_copies(df).select("doc_id", "text").collect())) == plain


def test_simhash_of_rows_without_ids(spark):
    """Unrelated rows without an id join nothing, and no document is lost by them."""
    r = np.random.default_rng(4)
    text = lambda: [f"w{x}" for x in r.integers(0, 10**6, 400)]
    a, b = text(), text()
    near = lambda w: " ".join([*w[:-1], "other"])
    docs = frame(spark, [(None, " ".join(a), "s"), (7, near(a), "s"), (None, " ".join(b), "s"), (8, near(b), "s")])
    fps = [brute.simhash(x.text) for x in docs.collect()]
    assert bin(fps[0] ^ fps[1]).count("1") <= 3 and bin(fps[2] ^ fps[3]).count("1") <= 3
    assert {(x.doc_id, x.component_id) for x in simhash.simhash_components(docs).collect()} == {(None, 7), (7, 7), (None, 8), (8, 8)}
    assert sorted(x.doc_id for x in simhash.near_dedup(docs).collect() if x.doc_id) == [7, 8]


def test_few_links_are_joined_up_without_passes(spark, monkeypatch):
    r = random.Random(9)
    path, hub = [(i, i + 1) for i in range(-40, 30)], [(1000, i) for i in range(2000, 2100)]
    loose = [(r.randrange(-(2**63), 2**63), r.randrange(5000, 5200)) for _ in range(150)]
    links = [(a, b) if r.random() < 0.5 else (b, a) for a, b in [*path, *hub, *loose, (5, 5)]]
    df = spark.createDataFrame(links, "u long, v long")
    found = lambda: sorted((x.node, x.component) for x in components.components(df).collect())
    monkeypatch.setattr(components, "FEW", 0, raising=False)
    passes = found()
    assert {(i, -40) for i in range(-39, 31)} | {(i, 1000) for i in range(2000, 2100)} <= set(passes)
    monkeypatch.undo()
    monkeypatch.setattr(components, "_star", None)
    assert found() == passes and components.components(df.limit(0)).count() == 0


def test_workers_give_memory_back():
    def held():
        return int(re.search(r"Anonymous:\s+(\d+)", Path("/proc/self/smaps_rollup").read_text())[1]) / 1024

    def run(batches):
        for n in batches:
            made = [pa.array(np.arange(20_000)).cast(pa.float64()) for _ in range(n)]
            yield len(made)

    run = kernels.tidy(run)
    began = held()
    assert list(run(iter([600, 700]))) == [600, 700]
    assert held() - began < 40


def suffix_rows(parts):
    """Two long copies, passages that fall short of 400 bytes, and texts laid together from a few parts."""
    r = random.Random(5)
    text = lambda n: "".join(r.choice("abcdefgh é") for _ in range(n))
    long, passage, pool = text(30_000), text(320), [text(r.randint(90, 450)) for _ in range(12)]
    rows = [(1, long, "a"), (2, long, "b")] + [(10 + i, text(300) + passage + text(300), "a") for i in range(40)]
    return rows + [(100 + i, "".join(r.choice(pool) for _ in range(6)), "c") for i in range(parts)]


@pytest.mark.parametrize("block_mb", [0.02, 8.0])
def test_suffixes_that_stand_alone_leave_before_the_full_digit(spark, monkeypatch, block_mb):
    rows, moved, answer = suffix_rows(0), [], blocks.answer

    def weighed(asked, *rest):
        moved.append(asked.agg(F.sum(F.octet_length("keys") + F.octet_length("load"))).first()[0])
        return answer(asked, *rest)

    monkeypatch.setattr(blocks, "answer", weighed)
    got = [(*r[:4], bytes(r.kept)) for r in suffix_dedup.suffix_dedup(frame(spark, rows), block_mb=block_mb).collect()]
    assert sorted(got) == sorted(brute.suffix_dedup(pairs(rows), 400))
    # all windows of a long copy once, and those around the passage, would take 16 bytes each
    assert sum(moved) < sum(len(t.encode()) for _, t, _ in rows)


def test_anchors_spread_over_the_buckets():
    buf = np.random.default_rng(1).integers(97, 123, 400_000).astype(np.uint8)
    chunk = suffix_dedup._Chunk(buf, np.array([0, len(buf)]), 400)
    keys = np.sort(chunk.keys[: len(chunk.anchors)])
    sizes = np.diff(blocks.bucket_edges(keys, 20))
    assert sizes.max() < 2 * sizes.mean()


@pytest.mark.parametrize(("length", "block_mb"), [(400, 0.02), (400, 8.0), (100, 0.02), (17, 8.0)])
def test_suffix_dedup_of_parts(spark, length, block_mb):
    rows = [x for x in suffix_rows(60) if x[0] > 2]
    got = [(*r[:4], bytes(r.kept)) for r in suffix_dedup.suffix_dedup(frame(spark, rows), length, block_mb=block_mb).collect()]
    assert sorted(got) == sorted(brute.suffix_dedup(pairs(rows), length))
