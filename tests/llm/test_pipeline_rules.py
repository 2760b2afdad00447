import corpus_pipeline
from pyspark.sql import functions as F

from tests.llm import brute
from tests.llm.test_near_copies import near_copies_of
from warpline.llm.storage import shared_table


def test_every_stage_after_near_dedup_by_the_rule_for_shingles(spark, data):
    """near_dedup held to five words and a similarity of 0.8 over all pairs, the stages behind it
    to plain versions, and run() to the stages one by one."""
    read = lambda n: spark.read.parquet(f"{data}/{n}.parquet")
    tables, docs = {"": read("documents")}, read("documents")
    for name, stage in corpus_pipeline.STAGES:
        docs = tables[name] = shared_table(stage(spark, docs, data))
    rows = {name: {r.doc_id: r for r in df.collect()} for name, df in tables.items()}

    before = [(i, r.text) for i, r in rows["line_dedup"].items()]
    want = {i for (i, _), c in zip(before, near_copies_of(before), strict=True) if i == c}
    assert set(rows["near_dedup"]) == want and len(want) < len(before)
    assert all(r == rows["line_dedup"][i] for i, r in rows["near_dedup"].items())

    split = lambda t: brute.words((t or "").translate(brute.LOW), r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = lambda w: {tuple(w[p : p + 10]) for p in range(len(w) - 9)}
    items = [split(r.text) for r in read("benchmark").collect()]
    assert all(len(w) >= 10 for w in items)
    leaks = set().union(*map(windows, items))
    assert set(rows["decontamination"]) == {i for i, r in rows["near_dedup"].items() if not windows(split(r.text)) & leaks}

    mixed = rows["mixing"]
    assert mixed and set(mixed) <= set(rows["decontamination"])
    assert all(1 <= r.copies <= 2 and r.taken == r.copies * len(brute.words(r.text)) for r in mixed.values())
    total = corpus_pipeline.run(spark, data).agg(F.count("*"), F.sum("taken")).first()
    assert tuple(total) == (len(mixed), sum(r.taken for r in mixed.values()))
