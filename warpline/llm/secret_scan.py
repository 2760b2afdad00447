"""Secret scanning with DataFrame functions only.

Base patterns find key assignments, access key ids and long hex strings.  Beside
them, candidate strings without a blank are measured by the Shannon entropy of a
window that slides over them, with a threshold for each character class; the
window's character counts change by one letter in and one out a step.  An
allow-list suppresses what is known to be harmless.

Positions: the matches of a pattern and the gaps between them alternate, so each
start is a running sum of their lengths.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


NAMES = "|".join(either_case(w) for w in ("password", "passwd", "secret", "token")) + "|" + either_case("api") + "_?" + either_case("key")
#: kind -> (pattern, group whose length counts, least length)
BASE = {
    "assign": ("(" + NAMES + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    "access": ("AKIA[A-Z0-9]+", 0, 16),
    "hex": ("[0-9a-f]+", 0, 32),
}
#: In these the bound on the length can be part of the pattern: a match is a whole run.
BOUNDED = {"access": "AKIA[A-Z0-9]{12,}", "hex": "[0-9a-f]{32,}"}
KINDS = (*BASE, "entropy")
CANDIDATE = "[A-Za-z0-9+/=_-]{24,}"
WINDOW = 24
PART = 128
#: class -> (pattern of a whole candidate, alphabet, least entropy of some window in bits)
CLASSES = {
    "hex": ("^[0-9A-Fa-f]+$", "0123456789abcdefABCDEF", 3.0),
    "base64": ("", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/=_-", 3.9),
}
#: whole candidates that are harmless: prose and rules, numbers, identifiers, paths of words
ALLOWED = (
    "^[A-Za-z=_-]+$",
    "^[0-9=_+/-]+$",
    "^[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}$",
    "^[A-Za-z]+([/_-][A-Za-z]*|[/_-][0-9]{1,4})+$",
)
#: c * log2(c) in millionths
WEIGHTS = [0] + [round(c * math.log2(c) * 1e6) for c in range(1, WINDOW + 1)]


def weight_limit(bits: float) -> int:
    """A window has at least so many bits if its weights sum to this or less."""
    return math.floor((math.log2(WINDOW) - bits) * WINDOW * 1e6)


def _once(value: Column, then) -> Column:
    """then(value), with the value computed once: what a lambda refers to is else
    computed anew for each element."""
    return F.element_at(F.transform(F.array(value), then), 1)


def _parts(items: Column) -> Column:
    """An array in parts of ``PART``: arrays grow by copying, so what is gathered
    one by one is gathered within a part."""

    def cut(all_):
        last = F.floor((F.greatest(F.size(all_), F.lit(1)) - 1) / PART).cast("int")
        return F.transform(F.sequence(F.lit(0), last), lambda i: F.slice(all_, i * PART + 1, F.lit(PART)))

    return _once(items, cut)


def _places(text: Column, pattern: str) -> Column:
    """array<struct<s, e, m>>: matches with code point offsets, end exclusive."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pairs = F.zip_with(found, F.split(text, pattern, -1), lambda m, g: F.struct(m.alias("m"), F.length(g).alias("g"), F.length(m).alias("l")))
    pairs = F.filter(pairs, lambda x: x["m"].isNotNull())
    kind = "array<struct<s:int,e:int,m:string>>"
    zero = F.struct(F.lit(0).alias("at"), F.array().cast(kind).alias("out"))
    none = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<struct<o:int,x:{kind}>>").alias("out"))

    def step(acc, x):
        s, e = acc["at"] + x["g"], acc["at"] + x["g"] + x["l"]
        return F.struct(e.alias("at"), F.concat(acc["out"], F.array(F.struct(s.alias("s"), e.alias("e"), x["m"].alias("m")))).alias("out"))

    def chain(acc, part):
        return F.struct((acc["at"] + part["at"]).alias("at"), F.concat(acc["out"], F.array(F.struct(acc["at"].alias("o"), part["out"].alias("x")))).alias("out"))

    def shifted(part):
        return F.transform(part["x"], lambda x: F.struct((x["s"] + part["o"]).alias("s"), (x["e"] + part["o"]).alias("e"), x["m"].alias("m")))

    parts = F.transform(_parts(pairs), lambda part: F.aggregate(part, zero, step))
    places = F.flatten(F.transform(F.aggregate(parts, none, chain, lambda acc: acc["out"]), shifted))
    return F.when(F.regexp_like(text, F.lit(pattern)), places).otherwise(F.array().cast(kind))


def _untouched(spans: Column, base: Column) -> Column:
    """The spans, in order and without overlaps, that touch none of ``base``; each
    part of them is held against those that reach into the part only."""

    def part_of(part, base):
        lo, hi = F.element_at(part, 1)["s"], F.element_at(part, -1)["e"]
        near = F.filter(base, lambda b: (b["s"] < hi) & (lo < b["e"]))
        return _once(near, lambda n: F.filter(part, lambda x: ~F.exists(n, lambda b: (b["s"] < x["e"]) & (x["s"] < b["e"]))))

    return _once(spans, lambda all_: F.when(F.size(all_) > 0, _once(base, lambda b: F.flatten(F.transform(_parts(all_), lambda part: part_of(part, b))))).otherwise(all_))


def least_weight(token: Column, alphabet: str) -> Column:
    """The least sum of c * log2(c) over windows of the token, in millionths."""
    table = F.array(*map(F.lit, WEIGHTS))
    weight = lambda c: F.element_at(table, c + 1)
    letter = lambda i: F.instr(F.lit(alphabet), F.substring(token, i, F.lit(1)))
    zero = F.struct(F.array_repeat(F.lit(0), len(alphabet)).alias("n"), F.lit(0).alias("s"), F.lit(2**30).alias("best"))

    def step(acc, i):
        new, old = letter(i), F.when(i > WINDOW, letter(i - WINDOW)).otherwise(F.lit(0))
        n_new = F.element_at(acc["n"], new)
        n_old = F.when(old > 0, F.element_at(acc["n"], F.greatest(old, F.lit(1))))
        change = F.when(old == new, F.lit(0)).otherwise(weight(n_new + 1) - weight(n_new) + F.when(old > 0, weight(n_old - 1) - weight(n_old)).otherwise(F.lit(0)))
        s = acc["s"] + change
        counts = F.transform(acc["n"], lambda c, k: c + F.when(k + 1 == new, 1).otherwise(0) - F.when(k + 1 == old, 1).otherwise(0))
        best = F.when(i >= WINDOW, F.least(acc["best"], s)).otherwise(acc["best"])
        return F.struct(counts.alias("n"), s.alias("s"), best.alias("best"))

    return F.aggregate(F.sequence(F.lit(1), F.length(token)), zero, step, lambda acc: acc["best"])


def secret_scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", allowed: tuple[str, ...] = ALLOWED) -> DataFrame:
    """One row for each row of docs: doc_id and, for each kind, an array of
    struct<s, e, m> with code point offsets (end exclusive) and the match.

    Kinds assign, access and hex hold the leftmost non-overlapping matches of
    their patterns that are long enough.  Kind entropy holds candidates with a
    high-entropy window that touch no base match and that no ``allowed`` pattern
    covers.  A null or empty text has none.  Repeated rows are scanned each; an
    empty table gives an empty table; other columns are ignored.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    found = {kind: _places(F.col("text"), BOUNDED.get(kind, BASE[kind][0])) for kind in BASE}
    rows = rows.select("doc_id", *(c.alias(k) for k, c in found.items()), _places(F.col("text"), CANDIDATE).alias("entropy"))
    pattern, group, least = BASE["assign"]
    rows = rows.withColumn("assign", F.filter("assign", lambda x: F.length(F.regexp_extract(x["m"], pattern, group)) >= least))
    harmless = lambda m: F.regexp_like(m, F.lit("|".join(f"(?:{p})" for p in allowed)))
    rows = rows.withColumn("entropy", F.filter("entropy", lambda x: ~harmless(x["m"]))).withColumn("entropy", _untouched(F.col("entropy"), F.concat(*BASE)))

    def high(x):
        classes = list(CLASSES.values())
        test = lambda c: least_weight(x["m"], c[1]) <= weight_limit(c[2])
        return F.when(F.regexp_like(x["m"], F.lit(classes[0][0])), test(classes[0])).otherwise(test(classes[1]))

    return rows.withColumn("entropy", F.filter("entropy", high))


def joined(kinds: tuple[str, ...]) -> Column:
    """kind:start:end of all spans by start, then kind as listed, comma-joined."""

    def part(i: int, kind: str) -> Column:
        return F.transform(kind, lambda x: F.struct(x["s"].alias("s"), F.lit(i).alias("k"), F.concat_ws(":", F.lit(kind), x["s"], x["e"]).alias("t")))

    parts = [part(i, kind) for i, kind in enumerate(kinds)]
    return F.array_join(F.transform(F.array_sort(F.concat(*parts)), lambda x: x["t"]), ",")
