import pytest
from pyspark.sql import functions as F

from warpline.functions import coordinates as C
from warpline.functions import linkage as L


def one(spark, *columns):
    return tuple(spark.range(1).select(*(c.alias(f"c{i}") for i, c in enumerate(columns))).first())


def test_numbers(spark):
    lit = lambda x: L.parse_signed_number(F.lit(x))
    assert one(spark, lit("+    7"), lit("-   15"), lit("4"), lit("none")) == (7, -15, 4, None)


def test_errors_and_scores(spark):
    null = F.lit(None).cast("double")
    assert one(spark, L.relative_error(F.lit(100), F.lit(110)), L.relative_error(F.lit(1), null)) == (pytest.approx(10 / 110), None)
    s = L.weighted_scores([(F.lit(1.0), 50), (F.lit(1.0), 15), (null, 15), (F.lit(1.0), 15)])
    assert one(spark, s["evidence"], s["quality"], s["coverage"]) == (84.21, 100.0, 84.21)


def test_strict_and_verdicts(spark):
    t, f, n = F.lit(True), F.lit(False), F.lit(None).cast("double")
    s = lambda e, w, c: L.strict(e, w, [t, c])
    assert one(spark, s(F.lit(0.001), F.lit(0.01), t), s(F.lit(0.002), F.lit(0.01), t), s(F.lit(0.001), n, t), s(F.lit(0.001), F.lit(0.01), f)) == (True, False, False, False)
    assert one(spark, *(L.verdict(F.lit(x), y) for x, y in ((40, t), (75, f), (55, f), (30, f)))) == ("strict", "possible", "weak", "different")


def test_names(spark):
    rows = spark.createDataFrame([("Мой Ёж",), ("é-1",), ("Straße",), (None,)], "n string")
    assert [r[0] for r in rows.select(L.normalize_name(F.col("n"))).collect()] == ["мойеж", "1", "strasse", None]
    assert [r[0] for r in rows.select(L.normalize_name(F.col("n"), "NFKD")).collect()] == ["моиеж", "e1", "strasse", None]


def test_coordinates(spark):
    c = lambda x: C.canonical_coordinate(F.lit(x))
    assert one(spark, c(" 1,50"), c("1.5"), c("-0.0"), c("100"), c("x"), c("nan")) == ("1.5", "1.5", "0", "100", None, None)
    d = lambda x: C.two_decimals(F.lit(x).cast("decimal(18,4)"))
    assert one(spark, d("1.005"), d("-0.001"), d("-2.5")) == ("1.01", "0.00", "-2.50")
    assert one(spark, C.file_part(F.lit("-2.5").cast("decimal(18,4)"))) == ("m2_50",)
    p = lambda x: C.safe_path(F.lit(x))
    assert one(spark, p("a/b.EMB"), p("../b.emb"), p("/b.emb"), p("C:\\b.emb"), p("b.dst")) == (True, False, False, False, False)
