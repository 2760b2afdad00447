"""Compound files (MS-CFB), property sets (MS-OLEPS) and length-prefixed zlib.

Written from the public format specifications.  Parsers work on one file's bytes
and are applied by Arrow batches: each file is parsed once, and what follows
works on the resulting rows.
"""

from __future__ import annotations

import bz2
import codecs
import gzip
import lzma
import struct
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAGIC = b"\xd0\xcf\x11\xe0\xa1\xb1\x1a\xe1"
FREE = 0xFFFFFFFA  # sector numbers from here on end a chain
#: Property name -> column.
PROPERTY_MAP = {
    "number of colours": "color_count",
    "number of stops": "stop_count",
    "number of trims": "trim_count",
    "number of stitches": "stitch_count",
    "number of objects": "object_count",
    "thread length": "thread_length",
    "bobbin length": "bobbin_length",
    "design left": "design_left",
    "design right": "design_right",
    "design up": "design_up",
    "design down": "design_down",
    "end x": "end_x",
    "end y": "end_y",
    "design height": "design_height",
    "design width": "design_width",
    "embroidery machine name": "machine",
    "number of funtions in the file": "function_count",
    "shortest stitch in design": "shortest_stitch",
    "longest stitch in design": "longest_stitch",
    "number of jumps per trim": "jumps_per_trim",
    "number of colour changes": "color_change_count",
    "filetype": "filetype",
    "fabricthickness": "fabric_thickness",
    "adjustbobbin": "adjust_bobbin",
}
SIGNED = {"design_left", "design_right", "design_up", "design_down", "end_x", "end_y"}
SEQUENCE_PROPERTY = 18
#: Codecs tried on text values in turn, and the code page of names that have an unknown one.
TEXT_CODECS = ("utf-8", "cp1251", "cp1252")
FALLBACK_PAGE = 1251
#: From the format: reserved property identifiers, and code pages.
DICTIONARY, CODE_PAGE = 0, 1
DEFAULT_PAGE, UTF16_PAGE = 1252, 1200
#: Types with a payload of one number (16 and 32 bits are read as unsigned) and those with a count and payload of so many bytes each.
SCALARS = {0x02: "H", 0x12: "H", 0x03: "I", 0x13: "I", 0x16: "I", 0x17: "I", 0x04: "f", 0x05: "d", 0x0B: "?"}
COUNTED = {0x1E: (1, lambda raw: decode_text(raw)), 0x1F: (2, lambda raw: str(raw, "utf-16-le", "replace").rstrip("\0")), 0x41: (1, bytes)}


def compound_streams(data: bytes) -> dict[str, bytes]:
    """Streams of a compound file by their path, joined by a slash."""
    if data[:8] != MAGIC or len(data) < 512:
        raise ValueError("not a compound file")
    (shift, mini_shift), (n_fat,) = struct.unpack_from("<HH", data, 30), struct.unpack_from("<I", data, 44)
    first_dir, cutoff, first_mini, _, difat_at, n_difat = struct.unpack_from("<I4xIIIII", data, 48)
    size, mini = 1 << shift, 1 << mini_shift

    def sector(n: int) -> bytes:
        return data[(n + 1) * size : (n + 2) * size]

    def numbers(raw: bytes) -> tuple[int, ...]:
        return struct.unpack(f"<{len(raw) // 4}I", raw[: len(raw) // 4 * 4])

    places = list(struct.unpack_from("<109I", data, 76))
    for _ in range(n_difat):
        extra = numbers(sector(difat_at))
        places, difat_at = places + list(extra[:-1]), extra[-1]
    table = [x for n in places[:n_fat] if n < FREE for x in numbers(sector(n))]

    def chain(start: int, links: list[int]) -> Iterator[int]:
        for _ in range(len(links) + 1):
            if start >= FREE:
                return
            if start >= len(links):
                raise ValueError("a sector chain leaves the file")
            yield start
            start = links[start]
        raise ValueError("a sector chain has a loop")

    entries = b"".join(sector(n) for n in chain(first_dir, table))
    nodes = []
    for at in range(0, len(entries), 128):
        length, kind = struct.unpack_from("<HB", entries, at + 64)
        left, right, child = struct.unpack_from("<III", entries, at + 68)
        start, long_size = struct.unpack_from("<IQ", entries, at + 116)
        name = entries[at : at + max(0, length - 2)].decode("utf-16le", "replace")
        nodes.append((name, kind, left, right, child, start, long_size & 0xFFFFFFFF if shift == 9 else long_size))
    mini_links = [x for n in chain(first_mini, table) for x in numbers(sector(n))]
    pool = b"".join(sector(n) for n in chain(nodes[0][5], table))
    out: dict[str, bytes] = {}
    todo, seen = [(nodes[0][4], "")], set()
    while todo:
        i, parent = todo.pop()
        if i >= len(nodes) or i in seen:
            continue
        seen.add(i)
        name, kind, left, right, child, start, length = nodes[i]
        todo += [(left, parent), (right, parent)]
        if kind == 1:
            todo.append((child, f"{parent}{name}/"))
        elif kind == 2:
            if length < cutoff:
                raw = b"".join(pool[n * mini : (n + 1) * mini] for n in chain(start, mini_links))
            else:
                raw = b"".join(sector(n) for n in chain(start, table))
            out[parent + name] = raw[:length]
    return out


def decode_text(raw: bytes) -> str:
    """By the first of TEXT_CODECS that can read the bytes, closing NULs cut; else spaced hex digits."""

    def read(codec: str) -> str | None:
        try:
            return str(raw, codec)
        except UnicodeDecodeError:
            return None

    found = [t for t in map(read, TEXT_CODECS) if t is not None]
    return found[0].rstrip("\0") if found else raw.hex(" ")


class Section:
    """One section of a property set: the places of its values by property identifier,
    each a typed value (type, two bytes of padding, payload)."""

    def __init__(self, data: bytes, base: int):
        self.data, self.base = data, base
        _, count = self.read("II", 0)
        self.places = dict(struct.iter_unpack("<II", self.span(8, 8 * count)))

    def span(self, at: int, size: int) -> bytes:
        out = self.data[self.base + at : self.base + at + size]
        if len(out) < size:
            raise ValueError("a property set ends early")
        return out

    def read(self, layout: str, at: int) -> tuple:
        return struct.unpack(f"<{layout}", self.span(at, struct.calcsize(f"<{layout}")))

    def typed(self, key: int) -> tuple[int, object]:
        """(type, value) of a property; of other than the known types the value is null."""
        at = self.places[key]
        (kind,) = self.read("H", at)
        if kind in SCALARS:
            return kind, self.read(SCALARS[kind], at + 4)[0]
        if kind in COUNTED:
            width, make = COUNTED[kind]
            (n,) = self.read("I", at + 4)
            return kind, make(self.span(at + 8, n * width))
        return kind, None

    def text_codec(self) -> tuple[str, int, int]:
        """(codec, bytes of a character, alignment) of dictionary names, from the code page property."""
        kind, page = self.typed(CODE_PAGE) if CODE_PAGE in self.places else (0, None)
        if kind not in (0x02, 0x12):
            page = DEFAULT_PAGE
        if page == UTF16_PAGE:
            return "utf-16-le", 2, 4
        try:
            return codecs.lookup(f"cp{page}").name, 1, 1
        except LookupError:
            return f"cp{FALLBACK_PAGE}", 1, 1

    def names(self) -> dict[int, str]:
        """The dictionary property: names by property identifier."""
        if DICTIONARY not in self.places:
            return {}
        codec, width, align = self.text_codec()
        at, out = self.places[DICTIONARY], {}
        (left,) = self.read("I", at)
        at += 4
        while left:
            key, n = self.read("II", at)
            out[key] = str(self.span(at + 8, n * width), codec, "replace").rstrip("\0")
            at += 8 + -(-n * width // align) * align
            left -= 1
        return out


def section_of(data: bytes) -> Section:
    """The first section of a property set stream (byte order mark, header of 28 bytes, then format id and offset of each section)."""
    if len(data) < 48 or data[:2] != b"\xfe\xff" or not struct.unpack_from("<I", data, 24)[0]:
        raise ValueError("not a property set")
    return Section(data, struct.unpack_from("<I", data, 44)[0])


def properties(data: bytes) -> list[tuple[int, str | None, float | None, str | None, int | None]]:
    """(identifier, name, number, text, size) of each property but the dictionary; size: of a text or blob."""
    section = section_of(data)
    names, out = section.names(), []
    for key in sorted(section.places):
        if key != DICTIONARY:
            _, value = section.typed(key)
            sized = isinstance(value, (bytes, str))
            out.append((key, names.get(key), None if sized or value is None else float(value), value if isinstance(value, str) else None, len(value) if sized else None))
    return out


def property_set(data: bytes) -> dict[str, object]:
    """Mapped properties of the first section, under PROPERTY_MAP's columns, and sequence_list_size."""
    out: dict[str, object] = {}
    for key, name, number, text, size in properties(data):
        column = PROPERTY_MAP.get((name or "").strip().lower())
        if column:
            out[column] = number - 2**32 if column in SIGNED and number is not None and number >= 2**31 else number if text is None else text
        if key == SEQUENCE_PROPERTY:
            out["sequence_list_size"] = size
    return out


def inflate(data: bytes, exact: bool = False) -> tuple[bytes | None, int | None, int | None]:
    """(bytes, declared size, actual size) of a u32 size and a zlib body; ``exact``
    makes another size, or a body that can't be read, an error."""
    declared = struct.unpack_from("<I", data)[0] if len(data) >= 4 else None
    try:
        raw = zlib.decompress(data[4:]) if declared is not None else None
    except zlib.error:
        raw = None
    if exact and (raw is None or len(raw) != declared):
        raise ValueError("not a body of the declared size")
    return raw, declared, None if raw is None else len(raw)


CODECS = {
    "zlib": zlib.decompress,
    "zlib+4": lambda x: zlib.decompress(x[4:]),
    "gzip": gzip.decompress,
    "bz2": bz2.decompress,
    "lzma": lzma.decompress,
}


def decodings(data: bytes) -> dict[str, bytes]:
    """Every codec that reads the bytes, with what it gives."""
    out = {}
    for name, codec in CODECS.items():
        try:
            out[name] = codec(data)
        except (OSError, ValueError, EOFError, zlib.error, lzma.LZMAError):
            continue
    return out


def streams(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(path, stream, raw, sha256) and the error rows (path, error_type, error) of
    (path, content) files.  One task parses a file once for both."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for path, content in zip(batch["path"], batch["content"], strict=True):
                try:
                    rows += [(path, name, raw, None, None) for name, raw in sorted(compound_streams(bytes(content)).items())]
                except Exception as e:  # noqa: BLE001 - any bad file becomes an error row
                    rows.append((path, None, None, type(e).__name__, str(e)))
            yield pd.DataFrame(rows, columns=["path", "stream", "raw", "error_type", "error"])

    parsed = files.select("path", "content").mapInPandas(run, "path string, stream string, raw binary, error_type string, error string")
    good = parsed.where(F.col("error").isNull()).select("path", "stream", "raw", F.sha2("raw", 256).alias("sha256"))
    return good, parsed.where(F.col("error").isNotNull()).select("path", "error_type", "error")


def variants(streams_: DataFrame) -> DataFrame:
    """(path, stream, variant, raw): each stream as it is, and what every codec that reads it gives."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(path, stream, codec, out) for path, stream, raw in zip(batch["path"], batch["stream"], batch["raw"], strict=True) for codec, out in decodings(bytes(raw)).items()]
            yield pd.DataFrame(rows, columns=["path", "stream", "variant", "raw"])

    rows = streams_.select("path", "stream", "raw")
    return rows.withColumn("variant", F.lit("raw")).unionByName(rows.mapInPandas(run, "path string, stream string, variant string, raw binary"))


def named(stream: str) -> Column:
    """Is this the stream?  Its case and a leading 0x05 don't matter."""
    return F.lower(F.ltrim(F.col("stream"), F.lit("\x05"))) == stream.lower()


def property_rows(streams_: DataFrame, stream: str) -> DataFrame:
    """(path, id, property, number, text, size, error): a row for each property of one
    stream by name; a bad stream gives one row with its error."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for path, raw in zip(batch["path"], batch["raw"], strict=True):
                try:
                    rows += [(path, *p, None) for p in properties(bytes(raw))]
                except ValueError as e:
                    rows.append((path, None, None, None, None, None, str(e)))
            out = pd.DataFrame(rows, columns=["path", "id", "property", "number", "text", "size", "error"])
            yield out.astype({"id": "Int64", "number": "float64", "size": "Int64"})

    return streams_.where(named(stream)).select("path", "raw").mapInPandas(run, "path string, id long, property string, number double, text string, size long, error string")


NUMBERS = [c for c in PROPERTY_MAP.values() if c != "machine"]


def wide(rows: DataFrame) -> DataFrame:
    """One row a path of property_rows(): error, PROPERTY_MAP's columns and sequence_list_size."""
    columns = F.create_map(*(F.lit(x) for pair in PROPERTY_MAP.items() for x in pair))
    rows = rows.withColumn("column", F.try_element_at(columns, F.lower(F.trim("property"))))
    number = lambda c: F.max(F.when(F.col("column") == c, F.col("number")))
    signed = lambda c: F.when(number(c) >= 2**31, number(c) - 2**32).otherwise(number(c))
    return rows.groupBy("path").agg(
        F.max("error").alias("error"),
        *((signed(c) if c in SIGNED else number(c)).alias(c) for c in NUMBERS),
        F.max(F.when(F.col("column") == "machine", F.coalesce("text", F.col("number").cast("string")))).alias("machine"),
        F.max(F.when(F.col("id") == SEQUENCE_PROPERTY, F.col("size"))).alias("sequence_list_size"),
    )


def metadata(streams_: DataFrame, stream: str) -> DataFrame:
    """path, error and the mapped properties of one stream by name; a missing stream
    gives no row, a bad one all nulls and its error."""
    return wide(property_rows(streams_, stream))
