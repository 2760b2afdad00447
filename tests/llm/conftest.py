import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, rid string, words int, spans int, n_hit int, block int, fp int, h1 int, copies int, weight int"


def frame(spark, rows):
    """A documents table of (doc_id, text, source) rows, with clashing names beside."""
    return spark.createDataFrame([(i, t, None, s, len(t or ""), "x", 1, 2, 3, 4, 5, 6, 7, 8) for i, t, s in rows], SCHEMA)


def odd_rows():
    r = random.Random(3)
    word = lambda: "".join(r.choice("abcdeé") for _ in range(r.randint(1, 6)))
    text = lambda n: " ".join(word() + ("\n" if r.random() < 0.1 else "") for _ in range(n))
    shared, long = text(80), text(30_000)
    rows = [(1, shared, "a"), (2, shared, "b"), (3, text(20) + " " + shared + "  " + text(30), "c"), (4, None, None), (5, "", "a"), (None, shared, "b"), (None, text(60), "c")]
    rows += [(6, long, "a"), (7, long[500:] + text(50), "b"), (8, " \t\n ", "a"), (9, "one", None), (9, "one", None), (10, "A b\nA b\nA b c " * 60, "d"), (11, "𝄞é " * 300, "d"), (12, "𝄞é " * 150, "e"), (13, "\x00\x01", "e")]
    rows += [(20 + i, text(10) + "\nAll rights reserved.  \n" + text(5), f"s{i}") for i in range(12)]
    near = text(400)
    return rows + [(100 + i, near + " " + word(), f"s{i}") for i in range(30)]


@pytest.fixture(scope="session")
def odd(spark):
    return frame(spark, odd_rows()), odd_rows()


@pytest.fixture(scope="session")
def nothing(spark):
    return frame(spark, [])
