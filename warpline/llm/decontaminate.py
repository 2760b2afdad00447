"""Benchmark decontamination with DataFrame functions only.

The benchmark's word windows become a set that ships with the plan, so a document's
windows are scanned and merged into spans inside its own row: no text is shuffled.

Up to ``max_set`` windows the set holds their 64-bit hashes, and the joined words for
verification.  Of more windows it holds a bit for each hash, in ``MOST_BITS`` bits at most; windows
whose bit is set, and only they, are then joined to the benchmark's by hash, and
verified where the document lies.

Working columns stand in one struct under a name of their own, so no column of a table
clashes with them.
"""

from __future__ import annotations

import uuid
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from warpline.llm.storage import shared_table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: what separates words: ASCII other than digits and letters
GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: bits of the set for each window of a large benchmark, and bits in all, powers of two
BITS, MOST_BITS = 16, 1 << 27
#: bits of one of Spark's bitmaps
BITMAP = 1 << 15
SPAN = "array<struct<s:int,e:int>>"
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, other characters unchanged."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def words_of(text: Column) -> Column:
    return F.filter(F.split(ascii_lower(F.coalesce(text, F.lit(""))), GAP), lambda w: w != "")


def _slice(words: Column, start: Column, length) -> Column:
    return F.slice(words, start, F.lit(length) if isinstance(length, int) else length)


def _starts(words: Column, length: int) -> Column:
    """1, 2 ... for the windows of a words array; none if it is too short."""
    n = F.size(words) - F.lit(length - 1)
    return F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))


def benchmark_windows(benchmark: DataFrame, ngram: int = 10, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """Distinct (item_id, length, key): windows of ``ngram`` words, or all the
    words of an item that has fewer; key is the words joined by a space."""
    items = benchmark.select(F.col(item_id).alias("item_id"), words_of(F.col(text)).alias("words")).where(F.size("words") > 0)
    items = items.withColumn("length", F.least(F.size("words"), F.lit(ngram)))
    at = F.explode(F.sequence(F.lit(1), F.size("words") - F.col("length") + 1)).alias("at")
    rows = items.select("item_id", "length", "words", at)
    return rows.select("item_id", "length", F.array_join(F.slice("words", F.col("at"), F.col("length")), " ").alias("key")).distinct()


def _hash(words: Column) -> Column:
    return F.xxhash64(words)


def _scan_sets(words: Column, keys: list) -> Column:
    """array<struct<s, e>> of verified windows, by literal sets."""

    def found(n: int) -> Column:
        hashes = [k.hash for k in keys if k.length == n]
        exact = [k.key for k in keys if k.length == n]
        hit = F.filter(_starts(words, n), lambda i: _hash(_slice(words, i, n)).isin(hashes))
        hit = F.filter(hit, lambda i: F.array_join(_slice(words, i, n), " ").isin(exact))
        return F.transform(hit, lambda i: F.struct(i.alias("s"), (i + F.lit(n)).alias("e")))

    spans = [found(n) for n in sorted({k.length for k in keys})]
    return F.array_sort(F.concat(*spans)) if spans else F.array().cast(SPAN)


def _bit_set(keys: DataFrame, n: int):
    """A test of hashes that holds for all of keys' (hash), n of them, and for few others.
    The bits are gathered in bitmaps of 4 KB, so what comes to the driver is bounded."""
    size = min(MOST_BITS, max(BITMAP, 1 << (n * BITS - 1).bit_length()))
    at = F.pmod(F.col("hash"), F.lit(size)) + 1
    parts = keys.groupBy(F.bitmap_bucket_number(at).alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits")).collect()
    bits = np.zeros(size // 8, np.uint8)
    for p in parts:
        bits[(p.part - 1) * (BITMAP // 8) : p.part * (BITMAP // 8)] = np.frombuffer(p.bits, np.uint8)
    # one text literal, which the optimizer folds to an array
    longs = F.split(F.lit(",".join(map(str, bits.view("<i8").tolist()))), ",").cast("array<bigint>")

    def test(h: Column) -> Column:
        place = F.pmod(h, F.lit(size))
        word = F.get(longs, F.shiftright(place, 6).cast("int"))
        return F.getbit(word, place.bitwiseAND(63).cast("int")) == 1

    return test


def _scan_bits(docs: DataFrame, words: Column, windows: DataFrame, n: int, lengths: list[int], name: str) -> DataFrame:
    """docs with the column ``name``, _scan_sets() for any number of windows."""
    keys = windows.select("length", "key").distinct().withColumn("hash", _hash(F.split("key", " ")))
    in_set = _bit_set(keys, n)
    # equal texts have equal spans
    docs = docs.withColumn(name, F.struct(words.alias("words"), F.xxhash64(words).alias("k1"), F.xxhash64(F.lit(1), words).alias("k2")))
    words = F.col(f"{name}.words")

    def windows_of(m: int) -> DataFrame:
        window = F.transform(_starts(words, m), lambda i: F.struct(i.alias("s"), _hash(_slice(words, i, m)).alias("hash")))
        return docs.select(f"{name}.k1", f"{name}.k2", F.lit(m).alias("length"), F.explode(F.filter(window, lambda w: in_set(w["hash"]))).alias("w"))

    exploded = reduce(DataFrame.unionByName, map(windows_of, lengths)).select("k1", "k2", "length", "w.*").distinct()
    hits = exploded.join(keys, ["length", "hash"]).groupBy("k1", "k2").agg(F.collect_list(F.struct("s", "length", "key")).alias("hits"))
    hits = shared_table(hits.select(F.struct("k1", "k2").alias("__of"), F.col("hits").alias("__hits")))  # of known size: broadcast if small
    docs = docs.join(hits, (F.col(f"{name}.k1") == F.col("__of.k1")) & (F.col(f"{name}.k2") == F.col("__of.k2")), "left")
    sure = F.filter("__hits", lambda x: F.array_join(_slice(words, x["s"], x["length"]), " ") == x["key"])
    spans = F.array_sort(F.array_distinct(F.transform(sure, lambda x: F.struct(x["s"].alias("s"), (x["s"] + x["length"]).alias("e")))))
    return docs.withColumn(name, F.struct(words.alias("words"), F.coalesce(spans, F.array().cast(SPAN)).alias("spans"))).drop("__of", "__hits")


def scan(docs: DataFrame, benchmark: DataFrame, ngram: int = 10, text: str = "text", max_set: int = 50_000) -> tuple[DataFrame, DataFrame, str]:
    """(documents, windows, name): docs with one more column, struct<words, spans, n_hit>
    under that name (spans: 1-based word positions of verified windows, end exclusive);
    and the benchmark's windows.  ``max_set`` bounds the windows that ship as hashes."""
    name = f"__{uuid.uuid4().hex}"
    windows = benchmark_windows(benchmark, ngram)
    keys = windows.select("length", "key", _hash(F.split("key", " ")).alias("hash")).distinct().limit(max_set + 1).collect()
    # the condition always holds; as it isn't deterministic, no filter above is
    # pushed below the words, which would then be split anew for every window
    words = F.when(F.monotonically_increasing_id() >= 0, words_of(F.col(f"`{text}`")))
    if len(keys) <= max_set:
        docs = docs.withColumn(name, F.struct(words.alias("words")))
        docs = docs.withColumn(name, F.struct(f"{name}.words", _scan_sets(F.col(f"{name}.words"), keys).alias("spans")))
    else:  # of lengths there are ngram at most
        some = windows.groupBy("length").agg(F.countDistinct("key").alias("n")).collect()
        docs = _scan_bits(docs, words, windows, sum(r.n for r in some), sorted(r.length for r in some), name)
    zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
    total = F.aggregate(f"{name}.spans", zero, lambda acc, x: F.struct(
        (acc["n"] + F.greatest(F.lit(0), x["e"] - F.greatest(acc["end"], x["s"]))).alias("n"),
        F.greatest(acc["end"], x["e"]).alias("end")), lambda acc: acc["n"])
    return docs.withColumn(name, F.struct(f"{name}.words", f"{name}.spans", total.alias("n_hit"))), windows, name


def contamination(docs: DataFrame, benchmark: DataFrame, ngram: int = 10, doc_id: str = "doc_id", text: str = "text", max_set: int = 50_000) -> DataFrame:
    """One row for each row of docs: doc_id, n_words, n_hit (words inside a
    benchmark window), item_ids (sorted strings of the items whose windows occur)
    and contaminated.

    A null or empty text has no words and is clean; so is everything under an
    empty benchmark.  Null item texts have no windows; repeated rows are reported
    each; other columns, clashing names included, are ignored.
    """
    rows, windows, name = scan(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), benchmark, ngram, "text", max_set)
    words = F.col(f"{name}.words")
    keys = F.array_sort(F.array_distinct(F.transform(f"{name}.spans", lambda x: F.array_join(F.slice(words, x["s"], x["e"] - x["s"]), " "))))
    rows = rows.select("doc_id", F.size(words).cast("long").alias("n_words"), F.col(f"{name}.n_hit").cast("long").alias("n_hit"), keys.alias("keys"))
    rows = shared_table(rows.withColumns({"k1": F.xxhash64("keys"), "k2": F.xxhash64(F.lit(1), "keys")}))
    # the items of each distinct set of windows that documents have
    sets = rows.where("n_hit > 0").select("k1", "k2", "keys").distinct().select("k1", "k2", F.explode("keys").alias("key"))
    items = sets.join(windows.select("key", F.col("item_id").cast("string").alias("item")), "key")
    items = shared_table(items.groupBy("k1", "k2").agg(F.array_sort(F.collect_set("item")).alias("item_ids")))
    hit = rows.where("n_hit > 0").join(items, ["k1", "k2"], "left")
    clean = rows.where("n_hit = 0").withColumn("item_ids", F.array().cast("array<string>"))
    shown = ("doc_id", "n_words", "n_hit", F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"), (F.col("n_hit") > 0).alias("contaminated"))
    return hit.select(*shown).unionByName(clean.select(*shown))


def decontaminate(docs: DataFrame, benchmark: DataFrame, ngram: int = 10, action: str = "documents", text: str = "text", max_set: int = 50_000) -> DataFrame:
    """docs with all their columns, without contaminated documents (``action``
    "documents"), or with the words of benchmark windows cut from their texts, each
    with the gap behind it (``action`` "spans").  Texts without a hit stay as they
    are, null included; so do all other columns, whatever their names."""
    rows, _, name = scan(docs, benchmark, ngram, text, max_set)
    hit = F.col(f"{name}.n_hit") > 0
    if action == "documents":
        return rows.where(~hit).select(docs.columns)
    if action != "spans":
        raise ValueError(f"action is documents or spans, not {action!r}")
    own = F.col(f"`{text}`")
    found, gaps = F.regexp_extract_all(own, F.lit(WORD), F.lit(0)), F.split(own, WORD, -1)
    rows = rows.withColumn(name, F.struct(f"{name}.spans", f"{name}.n_hit", F.when(hit, found).alias("found"), F.when(hit, gaps).alias("gaps")))
    gone = lambda i: F.exists(f"{name}.spans", lambda x: (x["s"] <= i + 1) & (i + 1 < x["e"]))
    behind = lambda i: F.element_at(F.col(f"{name}.gaps"), i + 2)
    kept = F.transform(f"{name}.found", lambda w, i: F.when(gone(i), F.lit("")).otherwise(F.concat(w, behind(i))))
    cut = F.concat(F.element_at(f"{name}.gaps", 1), F.array_join(kept, ""))
    return rows.select(*(F.when(hit, cut).otherwise(own).alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns))
