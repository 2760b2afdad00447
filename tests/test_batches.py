import bz2
import json
import zlib

import pytest
from pyspark.sql import functions as F

from tests.test_sources import compound, property_set, rows
from warpline.operators import batches, sequence
from warpline.plans import ranking
from warpline.sources import container, files, records, reports, sinks
from warpline.streaming import sessions


def test_run_batch_goes_on_from_its_report(spark, tmp_path):
    tasks = spark.createDataFrame([(i, f"f{i}") for i in range(6)], "row int, file string")
    folder, broken = str(tmp_path / "report"), str(tmp_path / "broken")

    def act(task, broken=broken):
        import os

        if task["row"] % 2 and not os.path.exists(broken):
            raise OSError("not yet")

    state = lambda df: {r.row: (r.status, r.attempts) for r in df.collect()}
    first = state(batches.run_batch(tasks, act, ["row"], folder, attempts=2))
    assert first == {i: ("error", 2) if i % 2 else ("success", 1) for i in range(6)}
    (tmp_path / "broken").touch()
    assert state(batches.run_batch(tasks, act, ["row"], folder, mode="retry")) == {i: ("success", 1) for i in range(6)}
    before = spark.read.parquet(folder).count()
    assert len(state(batches.run_batch(tasks, act, ["row"], folder))) == 6 and spark.read.parquet(folder).count() == before
    batches.run_batch(tasks, act, ["row"], folder, mode="fresh")
    assert spark.read.parquet(folder).count() == before + 6


def test_source_rows_that_cannot_be(spark):
    df = spark.createDataFrame([(1, "a/b.emb", "o.emb"), (2, "A\\B.EMB", " ")], "row int, file string, output_file string")
    assert [r.row for r in batches.of_source(df, "a/b.EMB", 1).collect()] == [1]
    for source, limit in (("a/b.emb", None), ("none.emb", None), ("a/b.emb", 0)):
        with pytest.raises(ValueError):
            batches.of_source(df, source, limit)


@pytest.mark.parametrize("text, error", [("a;A;b\n1;2;3\n", "repeated"), ("a;b\n1;2;3\n", "more values"), ("a;c\n1;2\n", "missing")])
def test_bad_tables(spark, tmp_path, text, error):
    (tmp_path / "t.csv").write_text(text)
    with pytest.raises(ValueError, match=error):
        reports.read_table(spark, str(tmp_path / "t.csv"), ("a", "b"))


def test_table_with_mark_blank_lines_and_short_rows(spark, tmp_path):
    (tmp_path / "t.csv").write_text('﻿ File , X\n"a;1",2\n\nb\n', encoding="utf-8")
    df = reports.read_table(spark, str(tmp_path / "t.csv"), ("file",))
    assert df.columns == ["file", "x"] and sorted((r.file, r.x) for r in df.collect()) == [("a;1", "2"), ("b", None)]


def test_scans(spark, tmp_path):
    for name in ("a.EMB", "b.dst", "c.txt"):
        (tmp_path / name).write_bytes(b"1")
    assert files.collect_files(spark, str(tmp_path / "none"), ".emb").count() == 0
    assert files.collect_files(spark, str(tmp_path), ".emb").count() == 1
    assert {r.format for r in files.scan_formats(spark, str(tmp_path), ["emb", "DST"]).collect()} == {"emb", "dst"}


def test_single_documents(spark, tmp_path):
    path = tmp_path / "d.json"
    path.write_text(json.dumps({"pairs": [{"name": "a", "st": 1, "more": 2}, {"name": "b", "st": None}]}, indent=1))
    assert [tuple(r) for r in files.documents(spark, str(path), "pairs", "name string, st long").collect()] == [("a", 1), ("b", None)]
    for name, fields in (("rows", "name string"), ("pairs", "other string")):
        with pytest.raises(ValueError):
            files.documents(spark, str(path), name, fields)


def test_streams_in_every_variant(spark):
    body = b"x" * 40
    df = spark.createDataFrame([("p", "a", bytearray(zlib.compress(body))), ("p", "b", bytearray(b"1234" + zlib.compress(body))), ("p", "c", bytearray(bz2.compress(body))), ("p", "d", bytearray(b"-"))], "path string, stream string, raw binary")
    out = {(r.stream, r.variant): bytes(r.raw) for r in container.variants(df).collect()}
    assert {k for k in out if k[1] != "raw"} == {("a", "zlib"), ("b", "zlib+4"), ("c", "bz2")} and all(v == body for k, v in out.items() if k[1] != "raw")
    raw = (40).to_bytes(4, "little") + zlib.compress(body)
    assert container.inflate(raw, exact=True) == (body, 40, 40) and container.inflate(b"xx") == (None, None, None)
    for bad in ((41).to_bytes(4, "little") + zlib.compress(body), b"1234no", b""):
        with pytest.raises(ValueError):
            container.inflate(bad, exact=True)


def test_properties_by_type():
    data = property_set()
    found = {key: rest for key, *rest in container.properties(data)}
    assert found[2] == ["Number of Stitches", 567.0, None, None] and found[4] == ["Embroidery Machine Name", None, "Tajima", 7 - 1] and found[18] == [None, None, None, 3]
    assert container.property_set(data) == {"stitch_count": 567, "design_left": -5, "machine": "Tajima", "sequence_list_size": 3}
    for cut in (0, 20, 47, 55, 80, len(data) - 1):
        with pytest.raises(ValueError):
            container.property_set(data[:cut])
    assert container.decode_text(b"\xd0\xb0\0") == "а" and container.decode_text(b"\xe0") == "а" and container.decode_text(b"\x81\x98") == "81 98"


def test_metadata_of_good_and_bad_streams(spark):
    good, _ = container.streams(rows(spark, {"good": compound({"\x05Props": property_set()}), "bad": compound({"Props": b"no"})}))
    out = {r.path: r for r in container.metadata(good, "PROPS").collect()}
    assert out["good"].stitch_count == 567 and out["good"].design_left == -5 and out["good"].error is None
    assert out["bad"].stitch_count is None and out["bad"].error


def test_exports(spark, tmp_path):
    df = spark.createDataFrame([("x/d.emb", "Icon", bytearray(b"12")), ("x/d.emb", "More", bytearray(b"345")), ("y/d.emb", "Icon", bytearray(b"6"))], "path string, stream string, raw binary")
    sinks.export_streams(df, str(tmp_path), {"Icon": "icon.bmp"})
    to = tmp_path / sinks.own_folder("x/d.emb")
    assert (to / "icon.bmp").read_bytes() == b"12" and json.loads((to / "contents.json").read_text()) == [{"stream": "Icon", "size": 2}, {"stream": "More", "size": 3}]
    assert (tmp_path / sinks.own_folder("y/d.emb") / "icon.bmp").read_bytes() == b"6"


def test_appended_blobs_and_listening(spark, tmp_path):
    df = spark.createDataFrame([(1, bytearray(b"ab")), (2, bytearray(b"c"))], "seq int, raw binary")
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    write = stream.writeStream.foreachBatch(sinks.append_blobs(str(tmp_path / "out"))).option("checkpointLocation", str(tmp_path / "cp"))
    assert not sessions.listen(write).isActive
    log = spark.read.json(str(tmp_path / "out/log"))
    assert sorted((r.seq, r["size"]) for r in log.collect()) == [(1, 2), (2, 1)]
    assert spark.read.parquet(str(tmp_path / "out/bytes")).count() == 2
    rate = spark.readStream.format("rate").load().writeStream.format("noop")
    assert not sessions.listen(rate, 1).isActive


def test_pattern_hits_in_blocks_without_a_bound(spark):
    data = b"".join(n.to_bytes(2, "little") for n in range(300, 420)) + b"\x2c\x01" * 150
    df = spark.createDataFrame([(1, bytearray(data))], "k int, raw binary")
    targets = spark.createDataFrame([(str(n), float(n)) for n in range(290, 430)], "name string, value double")
    want = {(str(n), at) for n in range(290, 430) for at in records.find_all(data, n.to_bytes(2, "little"))}
    for block in (10_000, 7):
        out = records.pattern_hits(df, targets, block=block).where("encoding = 'u16_le'").collect()
        assert {(r.name, r.position) for r in out} == want and len(out) == len(want)


def test_polylines_begin_at_the_point_before(spark):
    df = spark.createDataFrame([("f", 0, "jump", 5, 5), ("f", 1, "stitch", 6, 5), ("f", 2, "stitch", 7, 5), ("f", 3, "end", 7, 7), ("g", 0, "stitch", 1, 1)], "path string, index int, type string, x int, y int")
    out = {(r.path, r.first): [(p.x, p.y) for p in r.points] for r in sequence.polylines(df, F.col("type") == "stitch", ["path"], "index", "x", "y").collect()}
    assert out == {("f", 1): [(5, 5), (6, 5), (7, 5)], ("g", 0): [(0, 0), (1, 1)]}


def test_pair_metrics_keep_every_content(spark):
    designs = spark.createDataFrame([("a/Rose.emb", 10.0, 180.0, None, None, 2.0, 1.0)], "path string, stitch_count double, design_width double, design_left double, design_right double, color_count double, color_change_count double")
    stitches = spark.createDataFrame([("b/rose.dst", "s1", 10, 1, 9, 10), ("c/rose.dst", "s1", 10, 1, 9, 10), ("d/ROSE.dst", "s2", None, None, 9, 0)], "path string, sha256 string, st long, co long, stitch_commands long, width long")
    out = {r.stitch_path: (r.stitch_error, r.colours_exact, r.width_ratio) for r in ranking.pair_metrics(designs, stitches).collect()}
    assert out == {"b/rose.dst": (0.0, True, 18.0), "d/ROSE.dst": (None, False, None)}


def test_comparison_of_two_files(spark, tmp_path):
    import struct

    from tests.test_sources import stitch_file
    from warpline.plans import comparison

    def icon(dx):
        cells = bytearray(8 * 8)
        for x, y in ((2, 2), (3, 2), (3, 3)):
            cells[(7 - y) * 8 + x + dx] = 9
        return b"BM" + b"\0" * 8 + struct.pack("<IIiiHHI", 54, 40, 8, 8, 1, 8, 0) + b"\0" * 20 + bytes(cells)

    def file(body, dx, more):
        return compound({"\x05Props": property_set(), "Contents": body, "Icon": icon(dx)} | more)

    df = rows(spark, {"a": file(b"abcdef", 0, {}), "b": file(b"abXYef", 1, {"New": b"1"})})
    streams, _ = container.streams(df)
    found = {r.stream: (r.left is None, r.right is None) for r in comparison.stream_report(streams, "a", "b").collect()}
    assert found == {"Contents": (False, False), "Icon": (False, False), "New": (True, False)}
    assert comparison.property_report(streams, "props", "a", "b").count() == 0
    assert [(r.start, r.stop, r.left, r.right) for r in comparison.contents_report(streams, "contents", "a", "b").collect()] == [(2, 4, "63 64", "58 59")]
    best = comparison.icon_report(streams, "icon", "a", "b", 3).first()
    assert (best.dx, best.dy, best.iou) == (-1, 0, 1.0)
    dst = rows(spark, {"a": stitch_file("810003 810003 0000F3"), "b": stitch_file("810003 000003 0000F3", "ST: 3\r")})
    assert {r.key for r in comparison.header_report(dst, "a", "b").collect()} >= {"ST", "LA"}
    assert tuple(comparison.command_report(dst, "a", "b").first()) == (3, 1, 1, 3, 3)
    sinks.write_markdown([("Streams", comparison.stream_report(streams, "a", "b"))], str(tmp_path / "r.md"))
    assert "## Streams" in (tmp_path / "r.md").read_text()


def test_coordinate_fields(spark):
    x = records.FIELD_PREFIX + (-300).to_bytes(2, "little", signed=True) + records.FIELD_SUFFIX
    data = bytearray(b"\x07" * 120)
    data[10 : 10 + len(x)] = x
    y = 12 + records.Y_DISTANCE
    data[y - 1 : y + 7] = b"\x01" + (-1200).to_bytes(3, "little", signed=True) + b"\x00\x00\xe0\x10"
    df = rows(spark, {"one": bytes(data), "two": bytes(data) + x, "short": x, "other": bytes(data[:y]) + b"\x05\x00\x00" + b"\x07" * 9}).withColumnRenamed("content", "raw")
    got = {r.path: tuple(r)[1:] for r in records.coordinate_fields(df).collect()}
    assert got == {"one": (12, y, -300, -1200, -5.0, -20.0, True), "other": (12, y, -300, 5, -5.0, 5 / 60.0, False)}
