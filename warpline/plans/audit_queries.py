"""Registered queries of batches, audit statistics, report tables and event streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from warpline.functions import coordinates as C
from warpline.functions import display as V
from warpline.operators import batches as B
from warpline.operators import stats as A
from warpline.operators import tables as T
from warpline.plans.queries import _EV, _events, _t, cents, query
from warpline.sources import files, reports
from warpline.streaming import sessions


@query("""
    WITH o AS (SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM orders WHERE 'C' || o_custkey = 'C7'),
    r AS (SELECT *, row_number() OVER (ORDER BY o_orderkey) AS i FROM o)
    SELECT o_orderkey AS row, 'out/' || o_orderkey || '.EMB' AS output_file FROM r WHERE i <= 5""")
def q_source_rows(spark, sf_dir):
    k = F.col("o_orderkey")
    rows = _t(spark, sf_dir, "orders").select(k.alias("row"), F.concat(F.lit("In\\C"), F.col("o_custkey").cast("string"), F.lit(".emb")).alias("file"), F.concat(F.lit("out/"), k.cast("string"), F.lit(".EMB")).alias("output_file"))
    return B.of_source(rows, "in/c7.EMB", 5).select("row", "output_file")


@query("""
    WITH p AS (SELECT o_orderkey AS row, 'out/v' || o_orderkey % 500 || '.emb' AS path FROM orders),
    f AS (SELECT path, min(row) AS first_row FROM p GROUP BY path)
    SELECT path, first_row, row FROM p JOIN f USING (path) WHERE row > first_row""")
def q_output_clashes(spark, sf_dir):
    k = F.col("o_orderkey")
    path = F.concat(F.when(k % 2 == 0, "OUT\\v").otherwise("out/V"), (k % 500).cast("string"), F.lit(".EMB"))
    return B.clashes(_t(spark, sf_dir, "orders").select(k.alias("row"), path.alias("output_file")), "output_file")


_GRID = "SELECT x, y FROM range(-300, 301, 125) t(x), range(-200, 201, 150) u(y) UNION SELECT 0, 0"


@query(f"""
    SELECT s_suppkey AS k, printf('%.2f', x / 100.0::DOUBLE) AS x, printf('%.2f', y / 100.0::DOUBLE) AS y,
        'out/S' || s_suppkey || '_x' || replace(replace(printf('%.2f', x / 100.0::DOUBLE), '-', 'm'), '.', '_') || '_y' || replace(replace(printf('%.2f', y / 100.0::DOUBLE), '-', 'm'), '.', '_') || '.EMB' AS output_file
    FROM supplier, ({_GRID}) AS g""")
def q_variants(spark, sf_dir):
    file = F.concat(F.lit("raw\\S"), F.col("s_suppkey").cast("string"), F.lit(".EMB"))
    out = B.variants(_t(spark, sf_dir, "supplier").select(file.alias("file")), T.grid(spark, (-3.0, 3.0, 1.25), (-2.0, 2.0, 1.5)), "out/")
    return out.select(F.regexp_extract("file", r"S(\d+)", 1).cast("long").alias("k"), "x", "y", "output_file")


@query("SELECT count(*) AS keys, min(n) AS least, max(n) AS most FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey)")
def q_count_range(spark, sf_dir):
    return B.count_range(_t(spark, sf_dir, "lineitem"), ["l_orderkey"])


@query("""
    WITH r AS (SELECT c_custkey AS row, c_custkey % 11 = 0 AS bad_file, c_custkey % 13 = 0 AS bad_x, c_custkey % 17 = 0 AS bad_y, c_custkey % 19 = 0 AS bad_output, c_custkey // 2 AS o FROM customer),
    f AS (SELECT o, min(row) AS first, count(*) AS n FROM r WHERE NOT bad_output GROUP BY o)
    SELECT row, 'source' AS finding FROM r WHERE bad_file UNION ALL SELECT row, 'x' FROM r WHERE bad_x UNION ALL SELECT row, 'y' FROM r WHERE bad_y UNION ALL SELECT row, 'output' FROM r WHERE bad_output
    UNION ALL SELECT row, 'output of row ' || first FROM r JOIN f USING (o) WHERE NOT bad_output AND row > first""")
def q_preflight(spark, sf_dir):
    k = F.col("c_custkey")
    half = F.floor(k / 2).cast("string")
    return B.preflight(_t(spark, sf_dir, "customer").select(
        k.alias("row"), F.when(k % 11 == 0, "../x.EMB").otherwise("a/x.emb").alias("file"), F.when(k % 13 == 0, "NaN").otherwise(" 1,5").alias("x"), F.when(k % 17 == 0, "").otherwise("-2").alias("y"),
        F.when(k % 19 == 0, F.concat(F.lit("/abs/"), k.cast("string"), F.lit(".emb"))).otherwise(F.concat(F.lit("o"), half, F.lit(".EMB"))).alias("output_file")))


@query("""
    WITH p AS (SELECT 'emb_file' AS "column", 'a/' || c_custkey || '.emb' AS path, c_custkey AS k FROM customer UNION ALL SELECT 'dst_file', 'd/' || c_custkey % 200 || '.dst', c_custkey % 200 FROM customer)
    SELECT DISTINCT "column", path FROM p WHERE k NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')""")
def q_missing_files(spark, sf_dir):
    k = F.col("c_custkey")
    pairs = _t(spark, sf_dir, "customer").select(F.concat(F.lit("a/"), k.cast("string"), F.lit(".emb")).alias("emb_file"), F.concat(F.lit("d/"), (k % 200).cast("string"), F.lit(".dst")).alias("dst_file"))
    done = _t(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").cast("string").alias("c")).distinct()
    listed = done.select(F.concat(F.lit("A\\"), "c", F.lit(".EMB")).alias("path")).unionByName(done.select(F.concat(F.lit("D/"), "c", F.lit(".dst")).alias("path")))
    return B.missing_files(pairs, listed, ["emb_file", "dst_file"])


@query("SELECT 'c' || o_custkey || '.emb' AS file, count(*) AS n, string_agg(o_orderkey, ',' ORDER BY o_orderkey) AS rows FROM orders GROUP BY 1")
def q_grouped_tasks(spark, sf_dir):
    file = F.concat(F.when(F.col("o_orderkey") % 2 == 0, "C").otherwise("c"), F.col("o_custkey").cast("string"), F.lit(".EMB"))
    out = B.grouped(_t(spark, sf_dir, "orders").select(file.alias("file"), F.col("o_orderkey").alias("row"), "o_orderstatus"), "file", "row")
    return out.select("file", F.size("tasks").cast("long").alias("n"), F.array_join(F.col("tasks.row").cast("array<string>"), ",").alias("rows"))


@query("""
    SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')
    OR c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' AND o_orderkey % 3 = 0)""")
def q_pending_outputs(spark, sf_dir):
    out = lambda: F.concat(F.lit("Out/"), F.col("o_orderkey").cast("string"), F.lit(".emb"))
    o = _t(spark, sf_dir, "orders")
    results = o.select(F.col("o_custkey").alias("c_custkey"), F.when(F.col("o_orderstatus") == "F", "success").otherwise("error").alias("status"), out().alias("output_file"))
    there = o.where("o_orderkey % 3 <> 0").select(F.lower(out()).alias("path"))
    return B.pending(_t(spark, sf_dir, "customer").select("c_custkey"), results, ["c_custkey"], "resume", there)


@query("""
    SELECT c_custkey AS k, CASE WHEN c_custkey % 5 = 0 THEN 'C:/out/a.emb' ELSE 'sub/x' || c_custkey || '.emb' END AS path, c_custkey % 5 NOT IN (1, 2) AS inside,
        'out/sub/x' || c_custkey || '_x1_50_ym2_00.EMB' AS output FROM customer""")
def q_paths_inside(spark, sf_dir):
    k = F.col("c_custkey")
    p = F.when(k % 5 == 0, "C:\\out\\a.emb").when(k % 5 == 1, "sub/../../x").when(k % 5 == 2, "C:/outside/x").when(k % 5 == 3, "sub/./../x").otherwise("sub/x")
    number = k.cast("string")
    output = C.output_path("out/", F.concat(F.lit("sub\\x"), number, F.lit(".EMB")), F.concat(F.lit("x"), number), F.lit(1.5), F.lit(-2))
    shown = F.when(k % 5 == 0, F.replace(p, F.lit("\\"), F.lit("/"))).otherwise(F.concat(F.lit("sub/x"), number, F.lit(".emb")))
    return _t(spark, sf_dir, "customer").select(k.alias("k"), shown.alias("path"), C.inside(p, "c:/Out").alias("inside"), output.alias("output"))


@query("""
    WITH r AS (SELECT l_returnflag AS flag, round(l_extendedprice * 100)::BIGINT AS v, row_number() OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice) - 1 AS i, count(*) OVER (PARTITION BY l_returnflag) AS n FROM lineitem)
    SELECT flag, count(*) AS n, median(v) AS median, round(sum(v)::DOUBLE / count(*), 4) AS mean, min(v) AS least, max(v) AS most, min(v) FILTER (WHERE i = round_even((n - 1) * 0.05, 0)) AS p05, min(v) FILTER (WHERE i = round_even((n - 1) * 0.95, 0)) AS p95 FROM r GROUP BY flag""")
def q_summary(spark, sf_dir):
    rows = _t(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("flag"), cents("l_extendedprice").alias("v"))
    return A.summary(rows, ["flag"], "v").withColumn("mean", F.round("mean", 4))


@query("""
    WITH c AS (SELECT abs(l_partkey - l_suppkey * 3) AS changed, (l_partkey + l_suppkey) % 4 AS m FROM lineitem)
    SELECT m AS modulo, count(*) AS n, count(*) FILTER (WHERE changed > 100) AS large, median(changed)::DOUBLE AS median, min(changed) AS least, max(changed) AS most FROM c GROUP BY m""")
def q_changed_stats(spark, sf_dir):
    rows = _t(spark, sf_dir, "lineitem").select(((F.col("l_partkey") + F.col("l_suppkey")) % 4).alias("modulo"), F.abs(F.col("l_partkey") - F.col("l_suppkey") * 3).alias("changed"))
    counts = rows.groupBy("modulo").agg(F.count("*").alias("n"), F.count_if(F.col("changed") > 100).alias("large"), F.min("changed").alias("least"), F.max("changed").alias("most"))
    return counts.join(A.medians(rows, ["modulo"], "changed"), "modulo")


@query("""
    SELECT count(*) AS n, count(DISTINCT p_partkey % 7) AS n_values, min(p_partkey % 7) AS least, max(p_partkey % 7) AS most, max(p_partkey % 7) - min(p_partkey % 7) AS spread
    FROM part GROUP BY p_name, p_brand, p_type HAVING count(*) >= 2 ORDER BY spread DESC, n DESC""")
def q_metadata_groups(spark, sf_dir):
    rows = _t(spark, sf_dir, "part").select("p_name", "p_brand", "p_type", F.col("p_partkey").alias("filename"), (F.col("p_partkey") % 7).alias("position"))
    return A.duplicate_groups(rows, ["filename"], "position").drop("signature")


@query("""
    WITH g AS (SELECT l_partkey, count(*) AS n, regr_r2(l_extendedprice, l_quantity) AS r2 FROM lineitem GROUP BY 1 HAVING count(*) >= 8)
    SELECT l_partkey, n FROM g WHERE r2 IS NOT NULL AND r2 >= 0.02 ORDER BY round(r2, 6) DESC, n DESC, l_partkey LIMIT 40""")
def q_best_fits(spark, sf_dir):
    out = A.regression(_t(spark, sf_dir, "lineitem"), ["l_partkey"], "l_extendedprice", "l_quantity", 8)
    return out.where("r2 >= 0.02").orderBy(F.desc(F.round("r2", 6)), F.desc("n"), "l_partkey").limit(40).select("l_partkey", "n")


@query("""
    WITH t AS (SELECT o_orderkey AS k, unnest(['total', 'customer', 'lines']) AS name, unnest([round(o_totalprice)::BIGINT % 50, o_custkey % 50, o_orderkey % 50]) AS v FROM orders)
    SELECT k, v AS value, string_agg(name, ',' ORDER BY name) AS names FROM t GROUP BY ALL""")
def q_names_by_value(spark, sf_dir):
    rows = _t(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), (F.round("o_totalprice").cast("long") % 50).alias("total"), (F.col("o_custkey") % 50).alias("customer"), (F.col("o_orderkey") % 50).alias("lines"))
    long = rows.unpivot(["k"], ["total", "customer", "lines"], "name", "value")
    return long.groupBy("k", "value").agg(F.array_join(F.array_sort(F.collect_set("name")), ",").alias("names"))


@query("SELECT (SELECT count(*) FROM (SELECT o_custkey FROM orders WHERE o_custkey % 3 <> 0 EXCEPT SELECT c_custkey FROM customer)) = 0 AS subset")
def q_subset(spark, sf_dir):
    return T.subset(_t(spark, sf_dir, "orders").where("o_custkey % 3 <> 0").select(F.col("o_custkey").alias("c")), _t(spark, sf_dir, "customer").select(F.col("c_custkey").alias("c")))


@query("""
    SELECT o_orderkey AS k, CASE o_orderkey % 3 WHEN 0 THEN 'In/a.emb' WHEN 1 THEN 'b/c.emb' ELSE '' END AS source, CASE WHEN o_orderkey % 4 = 0 THEN '1' ELSE '2' END AS attempts, 'v.emb' AS output FROM orders""")
def q_completed_report(spark, sf_dir):
    k = F.col("o_orderkey")
    old = _t(spark, sf_dir, "orders").select(
        k.cast("string").alias("row"), F.when(k % 3 == 1, "C:\\Files\\b\\c.emb").otherwise("D:/x.emb").alias("source_file"), F.when(k % 3 == 0, "In\\a.emb").otherwise(" ").alias("relative_source_file"),
        F.lit("/o/V.EMB").alias("output_file"), F.lit("success").alias("status"), F.when(k % 4 == 0, " ").otherwise("2 ").alias("attempts"))
    out = reports.completed(old, "c:/files/", "/O")
    return out.select(F.col("row").cast("long").alias("k"), F.col("relative_source_file").alias("source"), "attempts", F.lower("relative_output_file").alias("output"))


@query("""
    SELECT event_id FROM (SELECT event_id, event_id % 6 AS m FROM events) WHERE m IN (1, 2, 4, 5)""")
def q_report_violations(spark, sf_dir):
    k = F.col("event_id") % 6
    rows = _t(spark, sf_dir, "events").select("event_id", F.when(k == 1, "done").when(k == 5, F.lit(None)).otherwise(" success ").alias("status"), F.when(k == 2, "-1").when(k == 3, " ").when(k == 4, "x").otherwise("2").alias("attempts"))
    return reports.violations(rows).select("event_id")


@query("""
    SELECT c_custkey AS k, c_custkey % 6 IN (0, 1, 2) AS unfinished FROM customer""")
def q_unfinished_paths(spark, sf_dir):
    k = F.col("c_custkey")
    path = F.element_at(F.array(*map(F.lit, ("/in/Out\\Ready/a.emb", "x/__processing_a.emb", "a/OUT/ready/b/c.emb", "/in/out/a.emb", "/in/myout/ready/a.emb", "/in/a__processing_b.emb"))), (k % 6 + 1).cast("int"))
    return _t(spark, sf_dir, "customer").select(k.alias("k"), files.unfinished(path, "out/ready").alias("unfinished"))


@query("SELECT unnest(['benchmark', 'conversations', 'customer', 'documents', 'embeddings', 'events', 'labels', 'lineitem', 'nation', 'orders', 'pages', 'part', 'region', 'supplier']) AS name, 'parquet' AS format")
def q_scan_formats(spark, sf_dir):
    found = files.scan_formats(spark, sf_dir, ["PARQUET", "emb"])
    return found.select(F.regexp_extract("path", r"([a-z]+)\.parquet", 1).alias("name"), "format").distinct()


@query("SELECT event_id, sum(v) OVER (ORDER BY event_id)::BIGINT - v AS \"offset\", row_number() OVER (ORDER BY event_id) AS number FROM (" + _EV + ") WHERE v > 0")
def q_write_offsets(spark, sf_dir):
    return sessions.write_offsets(_events(spark, sf_dir).select("event_id", "v"), "event_id", "v").select("event_id", "offset", "number")


@query("""
    WITH k AS (SELECT user_id, event_id, event_type, v, lag(event_type) OVER w AS p, lag(v) OVER w AS b FROM (""" + _EV + """) WHERE event_type IN ('view', 'purchase') WINDOW w AS (PARTITION BY user_id ORDER BY event_id))
    SELECT user_id, event_id, b AS before, v AS after FROM k WHERE event_type = 'purchase' AND p = 'view'""")
def q_last_before(spark, sf_dir):
    kind = F.when(F.col("event_type") == "view", "before").when(F.col("event_type") == "purchase", "after").otherwise("other")
    return sessions.before_after(_events(spark, sf_dir).withColumn("kind", kind), "user_id", "event_id", "kind", "v")


@query("""
    WITH e AS (SELECT event_id, user_id AS s, CASE event_type WHEN 'signup' THEN 'create' WHEN 'click' THEN 'write' ELSE 'x' END AS event, event_id % 3 AS result, CASE WHEN event_id % 2 = 0 THEN 'DesignDocument' ELSE 'Other' END AS name FROM events),
    o AS (SELECT s, min(event_id) AS opened FROM e WHERE event = 'create' AND name = 'DesignDocument' AND result = 0 GROUP BY s)
    SELECT e.s, event_id, opened FROM e JOIN o ON o.s = e.s WHERE event = 'write' AND event_id > opened""")
def q_routed_writes(spark, sf_dir):
    k = F.col("event_id")
    rows = _t(spark, sf_dir, "events").select(k, F.col("user_id").alias("s"), F.when(F.col("event_type") == "signup", "create").when(F.col("event_type") == "click", "write").otherwise("x").alias("event"), (k % 3).alias("result"), F.when(k % 2 == 0, "DesignDocument").otherwise("Other").alias("name"))
    return sessions.routed_writes(rows, "s", "event_id", "DesignDocument").select("s", "event_id", "opened")


@query("""
    SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, json_extract(props, '$.k') IS NOT NULL AS valid FROM events""")
def q_json_shape(spark, sf_dir):
    rows = _t(spark, sf_dir, "events").withColumn("keys", F.json_object_keys("props"))
    return rows.select("event_id", F.from_json("props", "k long")["k"].alias("k"), F.array_contains("keys", "k").alias("valid"))


@query("SELECT p_partkey AS k, CASE WHEN p_size > 25 THEN 'большой' ELSE NULL END AS emb, p_size > 25 AND p_size % 2 = 0 OR p_size <= 25 AS same FROM part")
def q_compare_pairs(spark, sf_dir):
    a = F.when(F.col("p_size") > 25, "большой")
    b = F.when((F.col("p_size") > 25) & (F.col("p_size") % 2 == 0), "большой")
    return _t(spark, sf_dir, "part").select(F.col("p_partkey").alias("k"), V.compared(a, b).alias("c")).select("k", F.col("c.emb").alias("emb"), F.col("c.same").alias("same"))
