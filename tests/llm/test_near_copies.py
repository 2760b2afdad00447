import random

import corpus_pipeline
import pytest

from tests.llm import brute
from tests.llm.conftest import frame
from warpline.llm import near_copies


def near_copies_of(rows):
    """The least doc_id of each row's component over five-word Jaccard similarity of 0.8 or more."""
    sets = [{tuple(w[p : p + 5]) for p in range(max(1, len(w) - 4))} if w else set() for _, t in rows for w in [brute.words((t or "").translate(brute.LOW))]]
    group = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if group[a] != group[b] and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                old, new = group[a], group[b]
                group = [new if g == old else g for g in group]
    return [min((i for (i, _), h in zip(rows, group, strict=True) if h == g and i is not None), default=None) for g in group]


def planted():
    """Copies at 0.8 to 0.95 and below, some in a cluster, beside a common passage."""
    r = random.Random(11)
    text = lambda n: [f"w{r.randrange(10**6)}" for _ in range(n)]
    passage, rows, expected = text(30), [], []
    for k in range(60):
        size = r.choice([4, 9, 30, 120, 400])
        w = text(size) + passage * (k % 2)
        rows.append((1000 + 10 * k, " ".join(w), "a"))
        for c in range(1, 3):
            copy = list(w)
            for _ in range(r.randrange(1, max(2, len(w) // 30))):
                copy[r.randrange(len(w))] = f"x{r.randrange(10**6)}"
            rows.append((1000 + 10 * k + c, " ".join(copy).upper(), "a"))
    base = text(150)
    for k in range(40):
        copy = list(base)
        for _ in range(k % 8):
            copy[r.randrange(150)] = f"y{k}"
        rows.append((5000 + k, " ".join(copy), "b"))
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("sample", [20_000, 20])
def test_drop_near_copies(spark, monkeypatch, sample):
    monkeypatch.setattr(near_copies, "SAMPLE", sample)
    rows = planted()
    want = {i for (i, *_), c in zip(rows, near_copies_of([x[:2] for x in rows]), strict=True) if i == c}
    assert 60 < len(want) < 180
    assert sorted(x.doc_id for x in corpus_pipeline.drop_near_copies(spark, frame(spark, rows), "").collect()) == sorted(want)


def test_odd_rows(spark, odd, nothing):
    df, rows = odd
    out = corpus_pipeline.drop_near_copies(spark, df, "")
    want = {i for (i, *_), c in zip(rows, near_copies_of([x[:2] for x in rows]), strict=True) if i is not None and i == c}
    kept = [x.doc_id for x in out.collect()]
    assert out.columns == df.columns and sorted(i for i in kept if i is not None) == sorted(want) and kept.count(None) == 2
    assert corpus_pipeline.drop_near_copies(spark, nothing, "").count() == 0
