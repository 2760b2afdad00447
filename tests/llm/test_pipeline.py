import corpus_pipeline
from pyspark.sql import functions as F

from tests.llm import brute
from warpline.llm.storage import shared_table
from warpline.llm.toxicity import toxicity


def test_stages(spark, data):
    """Each stage against a plain version of its decision on its own input."""
    read = lambda n: spark.read.parquet(f"{data}/{n}.parquet")
    docs = read("documents")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "near_dedup", "decontamination", "mixing"]
    before = docs
    for name, stage in corpus_pipeline.STAGES:
        after = shared_table(stage(spark, before, data))
        old, new = ({r.doc_id: r for r in x.collect()} for x in (before, after))
        if name != "mixing":
            assert after.columns == docs.columns
        if name == "toxicity":
            bad = {r.doc_id for r in toxicity(before, read("labels")).where("predicted = 1").collect()}
            assert set(new) == set(old) - bad and all(new[i] == old[i] for i in new)
        elif name == "line_dedup":
            want = {i: t for i, t, _ in brute.line_dedup([(r.doc_id, r.text, r.source) for r in old.values()], 10)}
            assert {i: r.text for i, r in new.items()} == want and all(r.n_chars == len(r.text) for r in new.values())
        elif name == "near_dedup":
            fps = [(i, brute.simhash(r.text)) for i, r in old.items()]
            assert set(new) == set(brute.components(fps))
        elif name == "decontamination":
            split = lambda t: brute.words(t.translate(brute.LOW), r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
            leaks = {tuple(w[p : p + 10]) for w in (split(r.text) for r in read("benchmark").collect()) for p in range(len(w) - 9)}
            assert set(new) == {i for i, r in old.items() if not any(tuple(w[p : p + 10]) in leaks for w in [split(r.text)] for p in range(len(w) - 9))}
        else:
            assert all(1 <= r.copies <= 2 and r.taken == r.copies * len(brute.words(r.text)) for r in new.values()) and set(new) <= set(old)
        before = after
    assert corpus_pipeline.run(spark, data).agg(F.sum("taken")).first() == before.agg(F.sum("taken")).first()
