import random

import corpus_pipeline
import pytest

from tests.llm.conftest import frame
from tests.llm.test_near_copies import planted
from warpline.llm import near_copies, simhash


def test_the_stage_holds_candidates_of_simhash_against_the_similarity(spark, monkeypatch):
    """With the prefix join silenced, what SimHash's grid meets goes, and only if it is alike."""
    nothing = lambda held: iter(())
    monkeypatch.setattr(near_copies, "some", nothing)
    monkeypatch.setattr(near_copies, "across", nothing)
    r = random.Random(5)
    words = [f"w{r.randrange(10**6)}" for _ in range(400)]
    rows = [(1, " ".join(words), "a"), (2, " ".join([*words[:-1], "x"]), "a"), (3, " ".join(words[::-1]), "a")]
    # one shingle far more often than all others: the same fingerprint, other sets
    often = " ".join(["b"] * 3000)
    rows += [(10 + k, f"{often} " + " ".join(f"w{r.randrange(10**6)}" for _ in range(60)), "a") for k in range(3)]
    bits = lambda a, b: (simhash_of(rows[a][1]) ^ simhash_of(rows[b][1])).bit_count()
    assert bits(0, 1) <= 3 and bits(0, 2) > 3 and bits(3, 4) <= 3 and bits(3, 5) <= 3
    assert sorted(x.doc_id for x in corpus_pipeline.drop_near_copies(spark, frame(spark, rows), "").collect()) == [1, 3, 10, 11, 12]


def simhash_of(text: str) -> int:
    import numpy as np

    raw = np.frombuffer(text.encode(), np.uint8)
    return int(simhash.fingerprints_of(raw, np.array([0, len(raw)]), near_copies.SHINGLE)[0])


@pytest.mark.parametrize("bits", [0, 3])
def test_candidates_connect_what_the_fingerprints_link(spark, bits):
    rows = [(k, simhash_of(t)) for k, (_, t, _) in enumerate(planted())]
    rows += [(1000 + k, v) for k, v in rows[::3]]  # other sets of equal fingerprints
    signed = lambda v: v - (1 << 64) if v >> 63 else v
    found = simhash.candidates(spark.createDataFrame([(i, signed(v)) for i, v in rows], "fp long, simhash long"), bits).collect()
    assert all(x.u > x.v for x in found) and len({(x.u, x.v) for x in found}) == len(found)

    def groups(links):
        root = {i: i for i, _ in rows}
        for a, b in links:
            old, new = root[a], root[b]
            root = {i: new if g == old else g for i, g in root.items()}
        return {frozenset(i for i in root if root[i] == g) for g in root.values()}

    want = [(i, j) for i, a in rows for j, b in rows if i < j and (a ^ b).bit_count() <= bits]
    assert groups((x.u, x.v) for x in found) == groups(want) and len(groups(want)) < len(rows)
