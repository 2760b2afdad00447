"""Plain versions of the operators, for small tables of (doc_id, text) rows."""

import hashlib
import math
import re
from collections import Counter

import xxhash

BLANK = r"[^\x20\x09-\x0D]+"
LOW = {c: c + 32 for c in range(65, 91)}


def words(text, pattern=BLANK):
    return re.findall(pattern, text or "")


def substring_dedup(rows, length):
    first = {}
    order = lambda i: math.inf if i is None else i
    for i, t in rows:
        w = words(t)
        for p in range(len(w) - length + 1):
            k = tuple(w[p : p + length])
            first[k] = min(first.get(k, math.inf), order(i))
    out = []
    for i, t in rows:
        w = words(t)
        gone = [False] * len(w)
        for p in range(len(w) - length + 1):
            if first[tuple(w[p : p + length])] < order(i):
                gone[p : p + length] = [True] * length
        out.append((i, len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    return out


def suffix_dedup(rows, length):
    n = Counter(b[p : p + length] for _, t in rows for b in [(t or "").encode()] for p in range(len(b) - length + 1))
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if n[b[p : p + length]] > 1:
                gone[p : p + length] = b"\1" * length
        out.append((i, len(b), sum(gone), len(re.findall(b"\1+", bytes(gone))), bytes(x for x, g in zip(b, gone) if not g)))
    return out


def simhash(text):
    w = re.findall(BLANK.encode(), (text or "").encode().lower())
    grams = [b" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [b" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def components(fps):
    """fps: (doc_id, fingerprint) rows -> the least doc_id of each row's component."""
    seen = list(range(len(fps)))

    def find(x):
        while seen[x] != x:
            x = seen[x]
        return x

    for a in range(len(fps)):
        for b in range(a):
            if bin(fps[a][1] ^ fps[b][1]).count("1") <= 3:
                p, q = find(a), find(b)
                seen[max(p, q)] = min(p, q)
    least = {}
    for a, (i, _) in enumerate(fps):
        if i is not None:
            least[find(a)] = min(least.get(find(a), math.inf), i)
    return [least.get(find(a)) for a in range(len(fps))]


def lm_score(rows, order=3, backoff=0.4, least=2):
    c = [Counter() for _ in range(order + 1)]
    docs = [(i, words((t or "").translate(LOW))) for i, t in rows]
    for _, w in docs:
        for n in range(1, order + 1):
            c[n].update(tuple(w[p : p + n]) for p in range(len(w) - n + 1))
    total = sum(c[1].values())
    out = []
    for i, w in docs:
        s = 0
        for j in range(len(w)):
            for lost, n in enumerate(range(min(order, j + 1), 0, -1)):
                g = tuple(w[j - n + 1 : j + 1])
                if n == 1 or c[n][g] >= least:
                    v = c[n][g] / (c[n - 1][g[:-1]] if n > 1 else total)
                    s += round(math.log(v * backoff**lost) * 1e6)
                    break
        out.append((i, len(w), s))
    return out


def revisions(rows):
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    out = []
    for k, (i, t) in enumerate(order):
        t, then = t or "", order[(k + 1) % len(order)][1] or ""
        half = len(t) // 2
        out.append((i, len(t), hashlib.sha256((t[: len(t) - half] + then[:half]).encode()).hexdigest()))
    return out


def line_dedup(rows, least):
    """rows: (doc_id, text, source)"""
    key = lambda x: x.strip(" \t\n\x0b\x0c\r")
    sites, first = {}, {}
    for r in sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0)):
        for p, line in enumerate((r[1] or "").split("\n")):
            if key(line):
                sites.setdefault(key(line), set()).add(r[2])
                first.setdefault(key(line), (r, p))
    out = []
    for r in rows:
        lines = (r[1] or "").split("\n")
        gone = [p for p, x in enumerate(lines) if key(x) and len(sites[key(x)]) >= least and first[key(x)] != (r, p)]
        out.append((r[0], None if r[1] is None and not gone else "\n".join(x for p, x in enumerate(lines) if p not in gone), len(gone)))
    return out
