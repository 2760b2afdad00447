"""Records inside opaque byte streams: every-offset scans, typed records, patterns."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from warpline.functions.stitch import byte_at, signed24

#: Bytes before and after a signed 16-bit position field.
FIELD_PREFIX, FIELD_SUFFIX = b"\x01\x01", b"\x01\x00\x00\x00\x0e\x01"
#: From a position's x to its y, what stands before and behind the y, and units of a millimetre.
Y_DISTANCE, Y_NEIGHBOURS, UNITS_PER_MM = 67, b"\x01\x00\x00\xe0\x10", 60.0
#: Ids (both ends excluded) and types of properties.
PROPERTY_IDS, PROPERTY_TYPES = (16000, 20000), (65536, 131072, 393216)


def numeric_records(data: bytes) -> Iterator[tuple[int, int, int, list[float]]]:
    """(offset, id, type, values) at every offset that can be a record: id below
    2**24 and not 0, flags 0, type 2 (f32) or 3 (f64), 1 to 16 values, all finite and
    below 1e12, and some of them 0 or 1e-20 and more.  Candidates may overlap."""
    raw = np.frombuffer(data, np.uint8)
    n = max(0, len(raw) - 11)
    at = lambda i: raw[i : i + n]
    id_ = at(0) | at(1) | at(2)
    zero = at(3) | at(4) | at(5) | at(7) | at(9) | at(10) | at(11)
    for place in np.flatnonzero((zero == 0) & (id_ != 0) & ((at(6) == 2) | (at(6) == 3)) & (at(8) >= 1) & (at(8) <= 16)).tolist():
        kind, count = data[place + 6], data[place + 8]
        code = "<f4" if kind == 2 else "<f8"
        if place + 12 + count * int(code[-1]) > len(data):
            continue
        values = np.frombuffer(data, code, count, place + 12).astype(np.float64)
        size = np.abs(values)
        if bool(np.all(size < 1e12)) and bool(np.any((size == 0) | (size >= 1e-20))):
            yield place, int.from_bytes(data[place : place + 3], "little"), kind, values.tolist()


def typed_records(data: bytes, at: int, count: int) -> list[tuple[int, int, int, int, int, int | None, bool]]:
    """(offset, id, type, value, size, payload, unknown): records of 12 bytes, or 16
    with a payload for types 0x10000 and 0x20000; an unknown type ends the scan."""
    out = []
    for _ in range(count):
        if at + 12 > len(data):
            break
        key, kind, value = struct.unpack_from("<III", data, at)
        if kind in (0x10000, 0x20000):
            if at + 16 > len(data):
                break
            out.append((at, key, kind, value, 16, struct.unpack_from("<I", data, at + 12)[0], False))
            at += 16
            continue
        out.append((at, key, kind, value, 12, None, kind != 0x60000))
        at += 12
        if kind != 0x60000:
            break
    return out


def triples(data: bytes, at: int, count: int, stop_id: int | None = None) -> list[tuple[int, int, int]]:
    """Up to count u32 triples, ending before an id of stop_id or more."""
    out = []
    for i in range(count):
        if at + 12 * i + 12 > len(data):
            break
        row = struct.unpack_from("<III", data, at + 12 * i)
        if stop_id is not None and row[0] >= stop_id:
            break
        out.append(row)
    return out


def between(data: bytes, before: bytes, after: bytes, layout: str) -> list[tuple]:
    """(offset, values ...) of every field of a layout that stands between two byte patterns."""
    size, out = struct.calcsize(layout), []
    for at in find_all(data, before):
        at += len(before)
        if data[at + size : at + size + len(after)] == after and at + size <= len(data):
            out.append((at, *struct.unpack_from(layout, data, at)))
    return out


def position_fields(data: bytes) -> list[tuple[int, int]]:
    """(offset, value) of signed 16-bit fields between their fixed neighbours."""
    return between(data, FIELD_PREFIX, FIELD_SUFFIX, "<h")


def coordinate_fields(streams: DataFrame, key: str = "path", raw: str = "raw") -> DataFrame:
    """(key, x_offset, y_offset, x_raw, y_raw, x_mm, y_mm, signed) of streams with exactly one
    position field: its value, the 24-bit one Y_DISTANCE bytes behind it, and whether that
    stands between its own fixed neighbours.  Streams that end before it are left out."""
    fields = explode_bytes(streams.select(key, raw), raw, position_fields, "x_offset int, x_raw int")
    single = fields.groupBy(key).agg(F.count("*").alias("__n"), F.first("x_offset").alias("x_offset"), F.first("x_raw").alias("x_raw")).where("__n = 1").drop("__n")
    rows = streams.select(key, raw).join(single, key).withColumn("y_offset", F.col("x_offset") + Y_DISTANCE)
    rows = rows.where(F.col("y_offset") + 7 <= F.length(raw))
    b = [byte_at(F.col(raw), F.col("y_offset") + 1 + i) for i in range(3)]
    neighbours = F.concat(F.substring(raw, F.col("y_offset"), F.lit(1)), F.substring(raw, F.col("y_offset") + 4, F.lit(4)))
    rows = rows.withColumns({"y_raw": signed24(*b), "signed": neighbours == F.lit(Y_NEIGHBOURS)})
    return rows.select(key, "x_offset", "y_offset", "x_raw", "y_raw", (F.col("x_raw") / UNITS_PER_MM).alias("x_mm"), (F.col("y_raw") / UNITS_PER_MM).alias("y_mm"), "signed")


def find_all(data: bytes, pattern: bytes, most: int | None = None) -> list[int]:
    """Positions of a pattern, overlapping ones too."""
    out, at = [], data.find(pattern) if pattern else -1
    while at >= 0 and (most is None or len(out) < most):
        out.append(at)
        at = data.find(pattern, at + 1)
    return out


def encodings(value: float) -> dict[str, bytes]:
    """The ways to store a number: 16- and 32-bit integers, f32 and f64, both byte
    orders; equal bytes once, under their first name."""
    out: dict[bytes, str] = {}
    for name, code in (("u16", "H"), ("i16", "h"), ("u32", "I"), ("i32", "i"), ("f32", "f"), ("f64", "d")):
        for order, sign in (("le", "<"), ("be", ">")):
            try:
                raw = struct.pack(sign + code, value if code in "fd" else int(value))
            except (struct.error, OverflowError):
                continue
            if code in "fd" or value == int(value):
                out.setdefault(raw, f"{name}_{order}")
    return {name: raw for raw, name in out.items()}


def pixels(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """x, y and value of each pixel of an uncompressed 8-bit bitmap, the top row first."""
    if data[:2] != b"BM":
        raise ValueError("not a bitmap")
    (start,) = struct.unpack_from("<I", data, 10)
    width, height = struct.unpack_from("<ii", data, 18)
    bits, packing = struct.unpack_from("<HI", data, 28)
    if bits != 8 or packing:
        raise ValueError("only plain 8-bit bitmaps are read")
    rows, stride = abs(height), -(-width // 4) * 4
    cells = np.frombuffer(data, np.uint8, rows * stride, start).reshape(rows, stride)[:, :width]
    y, x = np.divmod(np.arange(rows * width), width)
    return x, y, (cells[::-1] if height > 0 else cells).reshape(-1)


def bitmap(data: bytes) -> list[tuple[int, int, int]]:
    """(x, y, value) of each of pixels()."""
    return list(zip(*(c.tolist() for c in pixels(data)), strict=True))


def explode_bytes(df: DataFrame, raw: str, parse, fields: str) -> DataFrame:
    """A row for each tuple that parse(bytes) yields, beside the other columns; parse may
    also return a tuple of equally long arrays, one a field.  fields: names and types as DDL."""
    names = [f.split()[0] for f in fields.split(", ")]
    keep = [c for c in df.columns if c != raw]
    kinds = to_arrow_schema(df.sparkSession.createDataFrame([], fields).schema)
    schema = ", ".join([*(f"`{c}` {t}" for c, t in df.dtypes if c != raw), fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, value in enumerate(batch[raw]):
                if not value.is_valid:
                    continue
                found = parse(value.as_py())
                columns = found if isinstance(found, tuple) else list(zip(*found, strict=True))
                n = len(columns[0]) if columns else 0
                if n:
                    own = batch.select(keep).take(pa.array(np.full(n, i)))
                    yield pa.RecordBatch.from_arrays([*own.columns, *(pa.array(c, f.type) for c, f in zip(columns, kinds, strict=True))], [*keep, *names])

    return df.mapInArrow(run, schema)


def triple_rows(df: DataFrame, raw: str, start: int, count: int, names: tuple[str, str, str], stop_id: int | None = None) -> DataFrame:
    """A row for each u32 triple from ``start`` on, up to ``count`` of them, under the
    names given, beside the other columns and ``place``; ends before an id of stop_id or
    more.  Properties, nested records, links, containers and child properties are such
    triples: (id, type, value), (a, b, c) or (source, target, type)."""
    whole = F.least(F.lit(count), F.floor((F.length(raw) - start) / 12).cast("int"))
    part = lambda i: F.substring(raw, F.lit(start + 1) + i * 12, F.lit(12))
    rows = df.withColumn("place", F.when(whole > 0, F.transform(F.sequence(F.lit(0), whole - 1), part)))
    if stop_id is not None:
        stop = F.array_position(F.transform("place", lambda x: u32(x, F.lit(1)) >= stop_id), True).cast("int")
        rows = rows.withColumn("place", F.when(stop > 0, F.slice("place", 1, stop - 1)).otherwise(F.col("place")))
    # outer: else the rows with triples are filtered first, by the whole expression once for each word
    rows = rows.select(*(c for c in df.columns if c != raw), F.posexplode_outer("place").alias("place", "__t")).where(F.col("__t").isNotNull())
    return rows.withColumns({n: u32(F.col("__t"), F.lit(1 + 4 * k)) for k, n in enumerate(names)}).drop("__t")


def words(df: DataFrame, raw: str, start: int = 0, count: int = 100) -> DataFrame:
    """(other columns, offset, value): a dump of u32 words."""
    rows = df.withColumn("offset", F.explode(F.sequence(F.lit(start), F.lit(start + 4 * (count - 1)), F.lit(4))))
    return rows.where(F.col("offset") + 4 <= F.length(raw)).withColumn("value", u32(F.col(raw), F.col("offset") + 1)).drop(raw)


def find_properties(df: DataFrame, raw: str, start: int = 0, stop: int | None = None) -> DataFrame:
    """(other columns, offset, id, type, value): triples at every fourth offset in
    [start, stop) whose id and type are those of a property."""
    end = F.least(F.length(raw) - 12, F.lit(stop - 1)) if stop is not None else F.length(raw) - 12
    rows = df.withColumn("offset", F.explode(F.when(end >= start, F.sequence(F.lit(start), end, F.lit(4)))))
    rows = rows.withColumns({n: u32(F.col(raw), F.col("offset") + 1 + 4 * k) for k, n in enumerate(("id", "type", "value"))}).drop(raw)
    return rows.where((F.col("id") > PROPERTY_IDS[0]) & (F.col("id") < PROPERTY_IDS[1]) & F.col("type").isin(*PROPERTY_TYPES))


def u32(raw: Column, at: Column) -> Column:
    """The little-endian unsigned word at a 1-based place of a binary column."""
    part = F.reverse(F.decode(F.substring(raw, at, F.lit(4)), "ISO-8859-1"))
    return F.conv(F.hex(F.encode(part, "ISO-8859-1")), 16, 10).cast("long")


def pattern_hits(streams: DataFrame, targets: DataFrame, most: int | None = None, block: int = 10_000, least_length: int = 0) -> DataFrame:
    """(stream columns, name, value, encoding, position): where a target's number
    stands in a stream; overlapping places count.  Numbers of 1 and less are noise.

    The targets (name, value) meet the streams in blocks of ``block``, so any number of
    them is tried; ``most`` bounds the places of one pattern in one stream, for display,
    and ``least_length`` drops short patterns."""
    rows = targets.select("name", F.col("value").cast("double").alias("value")).where(F.abs("value") > 1)
    n_blocks = max(1, -(-rows.count() // block))
    blocks = rows.groupBy(F.pmod(F.xxhash64("name", "value"), F.lit(n_blocks)).alias("__b")).agg(F.collect_list(F.struct("name", "value")).alias("__targets"))
    keep = [c for c in streams.columns if c != "raw"]
    schema = ", ".join([*(f"`{c}` {t}" for c, t in streams.dtypes if c != "raw"), "name string, value double, encoding string, position int"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, (value, chosen) in enumerate(zip(batch["raw"], batch["__targets"], strict=True)):
                data = value.as_py()
                if data is None:
                    continue
                found = [(t["name"], t["value"], code, at) for t in chosen.as_py() for code, raw in encodings(t["value"]).items() if len(raw) >= least_length for at in find_all(data, raw, most)]
                if found:
                    own = batch.select(keep).take(pa.array(np.full(len(found), i)))
                    names, values, codes, places = zip(*found, strict=True)
                    yield pa.RecordBatch.from_arrays([*own.columns, pa.array(names), pa.array(values, pa.float64()), pa.array(codes), pa.array(places, pa.int32())], [*keep, "name", "value", "encoding", "position"])

    return streams.join(blocks.drop("__b")).mapInArrow(run, schema)
