import json

import pytest
from pyspark.sql import functions as F

from warpline.plans import ranking
from warpline.sources import sinks

DESIGN = "path string, stitch_count double, design_width double, design_left double, design_right double, design_height double, design_up double, design_down double, color_count double, color_change_count double, end_x double, end_y double, machine string"
STITCH = "path string, st long, co long, stitch_commands long, color_changes long, width long, height long, stitch_end_x long, stitch_end_y long"


@pytest.fixture
def ranked(spark):
    designs = spark.createDataFrame([
        ("raw\\1003.EMB", 5969.0, 19016.0, None, None, None, None, None, 6.0, 5.0, 0.0, 0.0, "Melco"),
        ("raw/Роза.emb", 100.0, None, -900.0, 900.0, 1800.0, None, None, 2.0, 1.0, None, None, None),
        ("raw/alone.emb", 1.0, *[None] * 11),
    ], DESIGN)
    stitches = spark.createDataFrame([
        ("dst\\.DST\\1003.DST", 1, 1, 1, 1, 1, 1, 0, 0),
        ("dst\\1003.DST", 5965, 5, 5900, 5, 1056, 900, 3, 4),
        ("dst/роза.dst", None, None, 100, 4, 100, 100, 0, 0),
    ], STITCH)
    return ranking.rank(designs, ranking.preferred_stitches(stitches))


def test_ranking(ranked):
    b, a = ranked.collect()  # 84.21 before 83.37
    assert (a.name, a.stitch_path, a.quality, a.coverage, a.evidence, a.verdict, a.end_distance) == ("1003", "dst\\1003.DST", 99.0, 84.21, 83.37, "strict", 5.0)
    assert a.stitch_error == pytest.approx(0.0006701289998324678) and a.height_error is None
    assert (b.name, b.coverage, b.quality, b.verdict) == ("роза", 100.0, 84.21, "possible")
    assert ranking.strict_pairs(ranked).select("name").collect() == [("1003",)]


def test_sinks(spark, ranked, tmp_path):
    pairs = ranking.strict_pairs(ranked)
    assert sinks.write_json(pairs, str(tmp_path / "p.json"), "pairs", schema_version=1) == 1
    doc = json.loads((tmp_path / "p.json").read_text())
    assert (doc["schema_version"], doc["count"], doc["pairs"][0]["machine"]) == (1, 1, "Melco")
    assert sinks.write_csv(pairs, str(tmp_path / "p.csv"), ["name", "st"], ";") == 1
    assert (tmp_path / "p.csv").read_bytes() == b"\xef\xbb\xbfname;st\r\n1003;5965\r\n"
    assert sinks.write_csv(pairs.limit(0), str(tmp_path / "none.csv")) == 0 and not (tmp_path / "none.csv").exists()
    with pytest.raises(ValueError):
        sinks.write_json(spark.range(5), str(tmp_path / "x.json"), most=4)
    errors = spark.createDataFrame([("a", "E", "m")], "path string, error_type string, error string")
    sinks.write_errors(errors, str(tmp_path / "e.json"))
    assert sinks.write_errors(errors.limit(0), str(tmp_path / "e.json")) == 0 and not (tmp_path / "e.json").exists()
    sinks.write_markdown([("Pairs", pairs.select("name", F.lit("a|b").alias("x")))], str(tmp_path / "r.md"))
    assert "| 1003 | a\\|b |" in (tmp_path / "r.md").read_text()
    with pytest.raises(FileExistsError):
        sinks.replace_file(str(tmp_path / "p.csv"), "", overwrite=False)
    raw = spark.createDataFrame([("x/d.emb", "\x05Info", bytearray(b"12"))], "path string, stream string, raw binary")
    sinks.dump_streams(raw, str(tmp_path / "dump"))
    assert (tmp_path / "dump/d/Info.bin").read_bytes() == b"12"
