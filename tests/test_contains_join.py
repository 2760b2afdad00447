import pytest

from warpline.operators import tables


@pytest.mark.parametrize("broadcast", ["10m", "-1"])
def test_more_short_patterns_than_are_broadcast(spark, broadcast):
    docs = [(k, f"w{k} w{k + 1} x y") for k in range(20)]
    patterns = [(k, f"w{k} w{k + 1}" if k % 2 else f"{k}") for k in range(1_200)] + [(5_000, "3 w4 x")]
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        out = tables.contains_join(spark.createDataFrame(docs, "d int, t string"), spark.createDataFrame(patterns, "p int, s string"), "t", "s")
        got = sorted((r.d, r.p, r.position) for r in out.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert got == sorted((d, p, t.index(s)) for d, t in docs for p, s in patterns if s in t)
