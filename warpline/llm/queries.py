"""The registered queries of the training-data operators, and their SQL.

Each query applies an operator, with production parameters, to its whole table
and derives the digest columns of its contract.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from warpline.llm import secret_scan as secrets
from warpline.llm.decontaminate import contamination
from warpline.llm.line_dedup import line_dedup
from warpline.llm.lm_score import lm_score
from warpline.llm.mixing import mix
from warpline.llm.simhash import simhash_components
from warpline.llm.substring_dedup import substring_dedup
from warpline.llm.suffix_dedup import suffix_dedup
from warpline.llm.toxicity import toxicity
from warpline.llm.winnow import revision_likeness


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score(_table(spark, sf_dir, "documents"))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = secrets.secret_scan(_table(spark, sf_dir, "documents"))
    return out.select(
        "doc_id",
        *(F.size(kind).cast("long").alias(f"n_{kind}") for kind in secrets.KINDS),
        F.sha2(secrets.joined(tuple(secrets.BASE)).cast("binary"), 256).alias("base_sha256"),
        secrets.joined(secrets.KINDS).alias("spans"),
    )


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return out.select(
        "doc_id", "n_words", "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ",").cast("binary"), 256).alias("items_sha256"),
        "contaminated",
    )


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


def quality_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, weight): labelled good 2, labelled bad 0.5."""
    labels = _table(spark, sf_dir, "labels").where(F.col("quality").isNotNull())
    return labels.select("doc_id", F.when(F.col("quality") == 1, 2.0).otherwise(0.5).alias("weight"))


def op8_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mix(_table(spark, sf_dir, "documents"), quality_weights(spark, sf_dir))
    return out.select("doc_id", "size", "source_size", "target", "taken")


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(_table(spark, sf_dir, "documents"))


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = revision_likeness(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint", "near_edited", "near_next", "positions")


QUERIES = {
    "op1_lm_score": op1_lm_score,
    "op2_secret_scan": op2_secret_scan,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_benchmark_decontamination": op4_benchmark_decontamination,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_toxicity": op6_toxicity,
    "op7_line_dedup": op7_line_dedup,
    "op8_source_mix": op8_source_mix,
    "op9_simhash_near_dedup": op9_simhash_near_dedup,
    "op10_fingerprints": op10_fingerprints,
}

def _secret_sql() -> str:
    """Places from gaps and matches; entropy from the letters of every window."""
    parts = []
    for k, (pattern, group, least) in enumerate([*secrets.BASE.values(), (secrets.CANDIDATE, 0, secrets.WINDOW)]):
        pattern = pattern.replace("'", "''")
        parts.append(f"""
        SELECT r, {k} AS k, x.m AS m, regexp_extract(x.m, '{pattern}', {group}) AS part, {least} AS least,
            sum(x.g) OVER w + coalesce(sum(length(x.m)) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s
        FROM (SELECT r, i, {{'m': f[i], 'g': length(g[i])}} AS x FROM (
                SELECT r, regexp_extract_all(text, '{pattern}') AS f, string_split_regex(text, '{pattern}') AS g FROM d) AS a, unnest(range(1, len(f) + 1)) AS t(i)) AS b
        WINDOW w AS (PARTITION BY r ORDER BY i ROWS UNBOUNDED PRECEDING)""")
    allowed = "|".join(f"(?:{p})" for p in secrets.ALLOWED)
    hexes, base64 = secrets.CLASSES["hex"], secrets.CLASSES["base64"]
    return f"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
        p AS ({" UNION ALL ".join(parts)}),
        q AS (SELECT r, k, s::BIGINT AS s, (s + length(m))::BIGINT AS e, m FROM p WHERE length(part) >= least),
        b AS (SELECT * FROM q WHERE k < 3),
        c AS (
            SELECT row_number() OVER () AS c, * FROM q
            WHERE k = 3 AND NOT regexp_matches(m, '{allowed}') AND NOT EXISTS (SELECT 1 FROM b WHERE b.r = q.r AND b.s < q.e AND q.s < b.e)),
        n AS (
            SELECT c, p, substr(m, p + j, 1) AS ch, count(*) AS n
            FROM c, unnest(range(1, length(m) - {secrets.WINDOW - 2})) AS t(p), unnest(range(0, {secrets.WINDOW})) AS u(j) GROUP BY ALL),
        h AS (SELECT c, min(x) AS x FROM (SELECT c, p, sum({secrets.WEIGHTS}[n + 1]) AS x FROM n GROUP BY c, p) AS y GROUP BY c),
        a AS (
            SELECT r, k, s, e FROM b UNION ALL
            SELECT r, k, s, e FROM c JOIN h USING (c)
            WHERE x <= CASE WHEN regexp_matches(m, '{hexes[0]}') THEN {secrets.weight_limit(hexes[2])} ELSE {secrets.weight_limit(base64[2])} END),
        t AS (
            SELECT r, {", ".join(f"count(*) FILTER (WHERE k = {k}) AS n{k}" for k in range(4))},
                string_agg(x, ',' ORDER BY s, k) FILTER (WHERE k < 3) AS base, string_agg(x, ',' ORDER BY s, k) AS spans
            FROM (SELECT *, {list(secrets.KINDS)}[k + 1] || ':' || s || ':' || e AS x FROM a) AS z GROUP BY r)
        SELECT doc_id, {", ".join(f"coalesce(n{k}, 0)::BIGINT AS n_{kind}" for k, kind in enumerate(secrets.KINDS))},
            sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
        FROM d LEFT JOIN t USING (r)"""


_SECRETS = _secret_sql()

ORACLES = {
    "op1_lm_score": r"""
        WITH d AS (
            SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
            FROM documents),
        p AS (
            SELECT r, i, ws[i] AS w, CASE WHEN i > 1 THEN ws[i - 1] END AS b, CASE WHEN i > 2 THEN ws[i - 2] END AS a
            FROM d, unnest(range(1, len(ws) + 1)) AS t(i)),
        c1 AS (SELECT w, count(*) AS n FROM p GROUP BY w),
        c2 AS (SELECT b, w, count(*) AS n FROM p WHERE b IS NOT NULL GROUP BY b, w),
        c3 AS (SELECT a, b, w, count(*) AS n FROM p WHERE a IS NOT NULL GROUP BY a, b, w),
        total AS (SELECT count(*) AS n FROM p),
        s AS (
            SELECT p.r,
                CASE WHEN c3.n >= 2 THEN c3.n::DOUBLE / ab.n
                     WHEN c2.n >= 2 THEN c2.n::DOUBLE / cb.n * CASE WHEN p.a IS NULL THEN 1::DOUBLE ELSE 0.4::DOUBLE END
                     ELSE c1.n::DOUBLE / total.n * CASE WHEN p.b IS NULL THEN 1::DOUBLE WHEN p.a IS NULL THEN 0.4::DOUBLE ELSE 0.4::DOUBLE * 0.4::DOUBLE END
                END AS v
            FROM p CROSS JOIN total JOIN c1 USING (w)
            LEFT JOIN c2 ON c2.b = p.b AND c2.w = p.w
            LEFT JOIN c3 ON c3.a = p.a AND c3.b = p.b AND c3.w = p.w
            LEFT JOIN c2 AS ab ON ab.b = p.a AND ab.w = p.b
            LEFT JOIN c1 AS cb ON cb.w = p.b),
        m AS (SELECT r, sum(round(ln(v) * 1e6)::BIGINT)::BIGINT AS micros FROM s GROUP BY r)
        SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(micros, 0)::BIGINT AS score_micros
        FROM d LEFT JOIN m USING (r)""",
    "op3_suffix_dedup": r"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
        w AS (
            SELECT r, p, md5(substr(x, 2 * p - 1, 800)) AS k
            FROM d, unnest(range(1, length(x) // 2 - 398)) AS t(p)),
        m AS (SELECT k FROM w GROUP BY k HAVING count(*) > 1),
        h AS (SELECT r, p, lag(p) OVER (PARTITION BY r ORDER BY p) AS q FROM w SEMI JOIN m USING (k)),
        g AS (SELECT r, p, sum(CASE WHEN q IS NULL OR p > q + 400 THEN 1 ELSE 0 END) OVER (PARTITION BY r ORDER BY p) AS g FROM h),
        s AS (SELECT r, min(p) AS a, max(p) + 400 AS b FROM g GROUP BY r, g),
        k AS (
            SELECT r, a, b, lag(b, 1, 1) OVER (PARTITION BY r ORDER BY a) AS z FROM s),
        o AS (
            SELECT r, sum(b - a)::BIGINT AS n_removed, count(*)::BIGINT AS n_spans, max(b) AS z,
                string_agg(substr(x, 2 * z - 1, 2 * (a - z)), '' ORDER BY a) AS x
            FROM k JOIN d USING (r) GROUP BY r)
        SELECT doc_id, (length(d.x) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
            sha256(unhex(CASE WHEN o.r IS NULL THEN d.x ELSE o.x || substr(d.x, 2 * z - 1) END)) AS kept_sha256
        FROM d LEFT JOIN o USING (r)""",
    "op5_substring_dedup": r"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
        w AS (
            SELECT r, doc_id, p, md5(array_to_string(ws[p : p + 49], ' ')) AS k
            FROM d, unnest(range(1, len(ws) - 48)) AS t(p)),
        m AS (SELECT k, min(doc_id) AS least FROM w GROUP BY k),
        h AS (SELECT DISTINCT r, p + i AS q FROM w JOIN m USING (k), unnest(range(0, 50)) AS t(i) WHERE least < doc_id),
        g AS (SELECT r, list(q) AS gone FROM h GROUP BY r),
        o AS (
            SELECT r, string_agg(ws[i], ' ' ORDER BY i) AS kept, count(*) AS n
            FROM (SELECT r, ws, unnest(range(1, len(ws) + 1)) AS i FROM d) AS e ANTI JOIN h ON h.r = e.r AND h.q = e.i GROUP BY r)
        SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(len(gone), 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
        FROM d LEFT JOIN g USING (r) LEFT JOIN o USING (r)""",
    "op2_secret_scan": _SECRETS,
    "op4_benchmark_decontamination": r"""
        WITH d AS (
            SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
            FROM documents),
        b AS (
            SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
            FROM benchmark),
        k AS (
            SELECT DISTINCT item_id, least(len(ws), 10) AS m, array_to_string(ws[p : p + least(len(ws), 10) - 1], ' ') AS w
            FROM b, unnest(range(1, len(ws) - least(len(ws), 10) + 2)) AS t(p) WHERE len(ws) > 0),
        w AS (
            SELECT r, p, m, array_to_string(ws[p : p + m - 1], ' ') AS w
            FROM d, (SELECT DISTINCT m FROM k) AS l, unnest(range(1, len(ws) - m + 2)) AS t(p)),
        h AS (SELECT r, p, w.m, item_id FROM w JOIN k ON k.m = w.m AND k.w = w.w),
        n AS (SELECT r, count(DISTINCT p + i) AS n_hit FROM (SELECT DISTINCT r, p, m FROM h) AS q, unnest(range(0, m)) AS t(i) GROUP BY r),
        i AS (SELECT r, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS items FROM (SELECT DISTINCT r, item_id::VARCHAR AS x FROM h) AS q GROUP BY r)
        SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
            sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
        FROM d LEFT JOIN n USING (r) LEFT JOIN i USING (r)""",
    "op7_line_dedup": r"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, text, source, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
        l AS (
            SELECT r, doc_id, coalesce('=' || source, '') AS site, i, ls[i] AS line, regexp_replace(ls[i], '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g') AS k
            FROM d, unnest(range(1, len(ls) + 1)) AS t(i)),
        b AS (SELECT k FROM l WHERE k <> '' GROUP BY k HAVING count(DISTINCT site) >= 10),
        n AS (SELECT r, i, row_number() OVER (PARTITION BY k ORDER BY doc_id NULLS FIRST, i) AS n FROM l SEMI JOIN b USING (k)),
        o AS (
            SELECT l.r, string_agg(line, chr(10) ORDER BY l.i) FILTER (WHERE n IS NULL OR n = 1) AS kept, count(*) FILTER (WHERE n > 1) AS n_removed
            FROM l LEFT JOIN n ON n.r = l.r AND n.i = l.i GROUP BY l.r)
        SELECT doc_id, len(ls)::BIGINT AS n_lines, n_removed::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
        FROM d JOIN o USING (r)""",
    "op8_source_mix": r"""
        WITH q AS (SELECT doc_id, avg(CASE WHEN quality = 1 THEN 2.0::DOUBLE ELSE 0.5::DOUBLE END) AS w FROM labels WHERE quality IS NOT NULL AND doc_id IS NOT NULL GROUP BY doc_id),
        d AS (
            SELECT row_number() OVER () AS r, doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
                -ln((('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT::DOUBLE + 0.5::DOUBLE) / 4503599627370496::DOUBLE) / coalesce(w, 1::DOUBLE) AS key
            FROM documents LEFT JOIN q USING (doc_id)),
        s AS (
            SELECT source, sum(size)::BIGINT AS source_size, sum(size)::DOUBLE * 2 AS cap,
                [3, 1, 2][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS w
            FROM d GROUP BY source),
        l AS (
            SELECT *, row_number() OVER (ORDER BY cap / w, source NULLS LAST) AS rank,
                (sum(source_size) OVER ()::DOUBLE * 1.5::DOUBLE - (sum(cap) OVER (ORDER BY cap / w, source NULLS LAST ROWS UNBOUNDED PRECEDING) - cap))
                    / sum(w) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
            FROM s),
        g AS (SELECT source, source_size, cap, w, first_value(CASE WHEN cap > level * w THEN level END) OVER (ORDER BY CASE WHEN cap > level * w THEN rank END NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS level FROM l),
        t AS (SELECT source, source_size, CASE WHEN level IS NULL THEN cap ELSE least(cap, level * w) END AS target FROM g),
        o AS (
            SELECT d.*, source_size, target, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::INT AS epochs,
                sum(size) OVER (PARTITION BY d.source ORDER BY key, doc_id NULLS FIRST, size ROWS UNBOUNDED PRECEDING) AS upto
            FROM d JOIN t ON t.source IS NOT DISTINCT FROM d.source)
        SELECT doc_id, size, source_size, target,
            (least(epochs + CASE WHEN 2 * upto - size <= (target - epochs * source_size) * 2 THEN 1 ELSE 0 END, 2) * size)::BIGINT AS taken
        FROM o""",
}
