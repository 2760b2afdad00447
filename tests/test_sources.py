import random
import struct
import zlib

import pytest
from pyspark.sql import functions as F

from warpline.functions import stitch as S
from warpline.operators import diff, stats, tables
from warpline.sources import container, files, records, reports, stitches


def stitch_file(commands, header="LA:rose\rST:      2\rCO:  0\r+X:    2\r-X:    0\r+Y:    2\r-Y:    0\rAX:+    0\rAY:-    3\r"):
    return (header.encode() + b"\x1a").ljust(512, b" ") + bytes.fromhex(commands)


def rows(spark, named):
    return spark.createDataFrame([(k, bytearray(v)) for k, v in named.items()], "path string, content binary")


def test_displacement_against_an_independent_decoder(spark):
    r = random.Random(5)
    triples = [tuple(r.randrange(256) for _ in range(3)) for _ in range(5000)]
    df = spark.createDataFrame(triples, "a int, b int, c int")
    dx, dy = S.displacement(F.col("a"), F.col("b"), F.col("c"))

    def expected(a, b, c):
        bit = lambda v, n: v >> n & 1
        x = (bit(a, 0) - bit(a, 1)) + 3 * (bit(b, 0) - bit(b, 1)) + 9 * (bit(a, 2) - bit(a, 3)) + 27 * (bit(b, 2) - bit(b, 3)) + 81 * (bit(c, 2) - bit(c, 3))
        y = (bit(a, 7) - bit(a, 6)) + 3 * (bit(b, 7) - bit(b, 6)) + 9 * (bit(a, 5) - bit(a, 4)) + 27 * (bit(b, 5) - bit(b, 4)) + 81 * (bit(c, 5) - bit(c, 4))
        return x, y

    assert [tuple(x) for x in df.select(dx, dy).collect()] == [expected(*t) for t in triples]


def test_commands_and_bounds(spark):
    df = rows(spark, {"a": stitch_file("810003 810003 0000F3 810003"), "s": stitch_file("000043 810083 0000F3"), "short": b"x"})
    good, bad = stitches.split_short(df)
    assert [r.path for r in bad.collect()] == ["short"]
    got = stitches.commands(good).orderBy("path", "index").collect()
    assert [(r.x, r.y, r.type) for r in got if r.path == "a"] == [(1, 1, "stitch"), (2, 2, "stitch"), (2, 2, "end")]
    assert [r.type for r in got if r.path == "s"] == ["sequin_mode", "sequin_eject", "end"]
    a = stitches.summary(good).where("path = 'a'").first()
    assert (a.min_x, a.max_x, a.min_y, a.max_y, a.width, a.height, a.command_count, a.has_end) == (0, 2, 0, 2, 2, 2, 3, True)
    h = stitches.header_numbers(stitches.headers(good)).where("path = 'a'").first()
    assert (h.st, h.co, h.ax, h.ay) == (2, 0, 0, -3)
    found = {r.finding for r in stitches.mismatches(good).where("path = 'a'").collect()}
    assert found == {"ST"}


def test_header_last_key_wins(spark):
    df = rows(spark, {"a": stitch_file("0000F3", "ST: 1\rST: 2 3\rLA:\xe9a\r")})
    assert stitches.headers(df).first().header == {"ST": "23", "LA": "a"}


def compound(streams):
    """A small compound file: one FAT sector, streams of 4096 bytes and more."""
    sectors, fat, placed = [], [], []

    def put(raw):
        first = len(sectors)
        parts = [raw[i : i + 512].ljust(512, b"\0") for i in range(0, len(raw), 512)]
        for i, p in enumerate(parts):
            sectors.append(p)
            fat.append(first + i + 1 if i + 1 < len(parts) else 0xFFFFFFFE)
        return first

    for name, raw in streams.items():
        placed.append((name, put(raw.ljust(4096, b"\0")), max(4096, len(raw))))

    def entry(name, kind, child=0xFFFFFFFF, right=0xFFFFFFFF, start=0xFFFFFFFE, size=0):
        n = name.encode("utf-16le") + b"\0\0"
        return n.ljust(64, b"\0") + struct.pack("<HBBIII", len(n), kind, 1, 0xFFFFFFFF, right, child) + b"\0" * 36 + struct.pack("<IQ", start, size)

    nodes = [entry("Root Entry", 5, child=1)]
    for i, (name, start, size) in enumerate(placed):
        nodes.append(entry(name, 2, right=i + 2 if i + 1 < len(placed) else 0xFFFFFFFF, start=start, size=size))
    directory = put(b"".join(nodes))
    fat_at = len(sectors)
    fat.append(0xFFFFFFFD)
    sectors.append(struct.pack("<128I", *(fat + [0xFFFFFFFF] * (128 - len(fat)))))
    head = container.MAGIC + b"\0" * 16 + struct.pack("<HHHHH6xIIIIIIIIII", 0x3E, 3, 0xFFFE, 9, 6, 0, 1, directory, 0, 4096, 0xFFFFFFFE, 0, 0xFFFFFFFE, 0, fat_at)
    return (head + b"\xff" * (512 - len(head))) + b"".join(sectors)


def property_set():
    names = {2: "Number of Stitches", 3: "Design Left", 4: "Embroidery Machine Name"}
    dictionary = struct.pack("<I", len(names)) + b"".join(struct.pack("<II", k, len(v) + 1) + v.encode() + b"\0" for k, v in names.items())
    values = {0: dictionary, 1: struct.pack("<HHI", 2, 0, 1252), 2: struct.pack("<HHI", 3, 0, 567), 3: struct.pack("<HHI", 19, 0, 2**32 - 5), 4: struct.pack("<HHI", 30, 0, 7) + b"Tajima\0", 18: struct.pack("<HHI", 65, 0, 3) + b"abc"}
    table, body, at = b"", b"", 8 + 8 * len(values)
    for k, v in values.items():
        table += struct.pack("<II", k, at + len(body))
        body += v
    section = struct.pack("<II", at + len(body), len(values)) + table + body
    return b"\xfe\xff" + b"\0" * 22 + struct.pack("<I", 1) + b"\0" * 16 + struct.pack("<I", 48) + section


def test_compound_file_and_metadata(spark):
    data = compound({"\x05Props": property_set(), "Contents": b"abc"})
    df = rows(spark, {"good": data, "bad": b"no"})
    good, bad = container.streams(df)
    assert {(r.path, r.stream) for r in good.collect()} == {("good", "\x05Props"), ("good", "Contents")}
    assert [(r.path, r.error_type) for r in bad.collect()] == [("bad", "ValueError")]
    m = container.metadata(good, "props").first()
    assert (m.stitch_count, m.design_left, m.machine, m.sequence_list_size, m.color_count) == (567, -5, "Tajima", 3, None)


def test_property_set_bounds():
    with pytest.raises(ValueError):
        container.property_set(property_set()[:60])
    with pytest.raises(ValueError):
        container.property_set(b"xx" + property_set()[2:])


def test_inflate_and_codecs():
    raw = struct.pack("<I", 3) + zlib.compress(b"abcd")
    assert container.inflate(raw) == (b"abcd", 3, 4)
    assert container.inflate(b"\0\0\0\0zz") == (None, 0, None)
    assert container.decodings(raw) == {"zlib+4": b"abcd"}


def test_records():
    good = struct.pack("<IHHIdd", 77, 0, 3, 2, 1.5, 0.0)
    assert [r for r in records.numeric_records(b"\xff" * 3 + good) if r[1] == 77] == [(3, 77, 3, [1.5, 0.0])]
    typed = struct.pack("<III", 1, 0x60000, 9) + struct.pack("<IIII", 2, 0x10000, 8, 7) + struct.pack("<III", 3, 5, 6) + b"\0" * 40
    assert [(r[1], r[4], r[5], r[6]) for r in records.typed_records(typed, 0, 9)] == [(1, 12, None, False), (2, 16, 7, False), (3, 12, None, True)]
    assert records.triples(struct.pack("<6I", 1, 2, 3, 16530, 0, 0), 0, 9, 16530) == [(1, 2, 3)]
    field = records.FIELD_PREFIX + struct.pack("<h", -12) + records.FIELD_SUFFIX
    assert records.position_fields(b"zz" + field) == [(4, -12)]
    assert records.find_all(b"aaaa", b"aa") == [0, 1, 2] and records.find_all(b"aaaa", b"aa", 2) == [0, 1]
    assert set(records.encodings(1.5)) == {"f32_le", "f32_be", "f64_le", "f64_be"} and "i16_le" in records.encodings(-2)


def test_pattern_hits_and_bitmap(spark):
    df = spark.createDataFrame([("s", bytearray(b"\0\0" + struct.pack("<H", 567)))], "stream string, raw binary")
    t = spark.createDataFrame([("stitches", 567.0), ("none", 1.0)], "name string, value double")
    assert {(r.name, r.encoding, r.position) for r in records.pattern_hits(df, t).collect()} == {("stitches", "u16_le", 2)}
    head = b"BM" + b"\0" * 8 + struct.pack("<III", 54, 40, 2) + struct.pack("<iHHI", 2, 1, 8, 0) + b"\0" * 20
    assert records.bitmap(head + bytes([1, 2, 0, 0, 3, 4, 0, 0])) == [(0, 0, 3), (1, 0, 4), (0, 1, 1), (1, 1, 2)]


def test_file_scans(spark, tmp_path):
    for name in ("a.EMB", "sub/b.emb", ".DST/c.emb", "d.txt"):
        p = tmp_path / name
        p.parent.mkdir(exist_ok=True)
        p.write_bytes(b"x")
    names = lambda df: sorted(r.path.rsplit("/", 1)[1] for r in df.select("path").collect())
    assert names(files.scan_files(spark, str(tmp_path), ".emb")) == ["a.EMB", "b.emb"]
    spark.dataSource.register(files.DesignFiles)
    assert names(spark.read.format("design_files").option("suffix", ".emb").load(str(tmp_path))) == ["a.EMB", "b.emb", "c.emb"]


def test_reports(spark, tmp_path):
    (tmp_path / "r.csv").write_text("﻿File;Status;attempts\na;success; \nb;error;2\n\nc;odd;-1\n", encoding="utf-8")
    df = reports.read_table(spark, str(tmp_path / "r.csv"), ("status",))
    assert df.columns == ["file", "status", "attempts"]
    assert [(r.file, r.attempts) for r in reports.successful(df).collect()] == [("a", 1)]
    assert [r.file for r in reports.violations(df).collect()] == ["c"]
    with pytest.raises(ValueError):
        reports.read_table(spark, str(tmp_path / "r.csv"), ("x",))


def test_preferred_paths(spark):
    df = spark.createDataFrame([("k", "dst/.DST/1.DST"), ("k", "dst/x/1.DST"), ("k", "dst\\2.DST")], "k string, p string")
    assert tables.preferred(df, ["k"], tables.preferred_path(F.col("p"))).first().p == "dst\\2.DST"


def test_upsert_keeps_null_keys(spark):
    df = spark.createDataFrame([("a", 1, "x"), (None, 2, "y"), ("a", 3, "z"), (None, 4, "w")], "k string, i int, v string")
    assert sorted((r.place, r.k, r.v) for r in tables.upsert_latest(df, ["k"], "i").collect()) == [(1, "a", "z"), (2, None, "y"), (4, None, "w")]


def test_shift_overlap_and_opcodes(spark):
    a = spark.createDataFrame([(0, 0), (1, 0)], "x int, y int")
    best = stats.iou_shifts(a, a.select((F.col("x") + 2).alias("x"), "y"), 3).first()
    assert (best.dx, best.dy, best.iou) == (-2, 0, 1.0)
    ops = spark.createDataFrame([("abc", "axc")], "a string, b string").select(diff.edit_opcodes("a", "b").alias("o")).first().o
    assert [o[0] for o in ops] == ["equal", "replace", "equal"]
