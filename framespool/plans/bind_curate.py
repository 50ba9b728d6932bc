"""Curation and lookups on the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import curate as C
from ..operators import vocabulary as V
from .tables import Registry, table

R = Registry()
COUNTS = "c AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY ALL)"


def counts(spark, d):
    return table(spark, d, "events").groupBy("user_id", "event_type").agg(F.count("*").alias("n"))


R.sql["a6_count_parity"] = f"""WITH {COUNTS} SELECT user_id, event_type, n, max(n) OVER (PARTITION BY user_id) AS most, n < max(n) OVER (PARTITION BY user_id)
AND event_type <> 'signup' AS uneven FROM c"""


@R.query
def a6_count_parity(spark, d):
    return C.count_parity(counts(spark, d), "user_id", "n", exempt=F.col("event_type") == "signup")


R.sql["a7_trim_target"] = f"""WITH {COUNTS} SELECT user_id, min(n) FILTER (n > 0) AS target, min(n) FILTER (n > 0 AND event_type IN ('click', 'view')) AS stereo_target FROM c
GROUP BY user_id"""


@R.query
def a7_trim_target(spark, d):
    stereo = C.trim_target(counts(spark, d), "user_id", "n", F.col("event_type").isin("click", "view")).withColumnRenamed("target", "stereo_target")
    return C.trim_target(counts(spark, d), "user_id", "n").join(stereo, "user_id")


R.sql["a8_dominant"] = """WITH c AS (SELECT user_id, event_type, count(*) AS n FROM events WHERE event_type <> 'error' GROUP BY ALL), o AS (SELECT *,
row_number() OVER (PARTITION BY user_id ORDER BY n DESC, event_type) AS o FROM c)
SELECT u.user_id, event_type AS task FROM (SELECT DISTINCT user_id FROM events) u LEFT JOIN o ON o.user_id = u.user_id AND o = 1"""


@R.query
def a8_dominant(spark, d):
    return C.dominant(table(spark, d, "events"), "user_id", F.when(F.col("event_type") != "error", F.col("event_type")))


TRIM = """WITH n AS (SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS at_, count(*) OVER (PARTITION BY user_id) AS n
FROM events), t AS (SELECT *, n // 2 AS target FROM n)
SELECT event_id, 'first' AS policy FROM t WHERE at_ >= target UNION ALL SELECT event_id, 'last' FROM t WHERE at_ < n - target UNION ALL
SELECT event_id, 'skip' FROM t WHERE at_ < 3 OR at_ >= target + 3"""
R.sql["w9_trim"] = TRIM


@R.query
def w9_trim(spark, d):
    df = table(spark, d, "events").select("event_id", "user_id")
    half = df.groupBy("user_id").agg(F.expr("count(*) div 2").alias("target"))
    df = df.join(half, "user_id")
    out = None
    for mode, name in ((-1, "first"), (0, "last"), (3, "skip")):
        part = C.trimmed(df, "user_id", "event_id", "target", mode).select("event_id", F.lit(name).alias("policy"))
        out = part if out is None else out.unionByName(part)
    return out


R.sql["w11_label_backfill"] = """SELECT d.doc_id, coalesce(max(toxic), 0)::INTEGER AS toxic, max(quality) AS quality, CASE
WHEN count(quality) > 0 THEN max(quality)::VARCHAR END AS listed
FROM documents d LEFT JOIN labels USING (doc_id) GROUP BY d.doc_id"""


@R.query
def w11_label_backfill(spark, d):
    labels = table(spark, d, "labels").withColumn("each", F.col("quality").cast("string"))
    out = C.backfilled(table(spark, d, "documents").select("doc_id"), labels, "doc_id", {"toxic": 0}, ["quality"], listed="each")
    return out.select("doc_id", "toxic", "quality", F.when(F.size("each") > 0, F.array_join("each", ",")).alias("listed"))


R.sql["t1_natural_order"] = """WITH m AS (SELECT DISTINCT CASE WHEN p_partkey % 3 = 0 THEN p_name ELSE p_partkey::VARCHAR END AS name FROM part)
SELECT name, row_number() OVER (ORDER BY try_cast(name AS BIGINT) NULLS LAST, name) - 1 AS place FROM m"""


@R.query
def t1_natural_order(spark, d):
    from ..operators.segment import ranked

    name = F.when(F.col("p_partkey") % 3 == 0, F.col("p_name")).otherwise(F.col("p_partkey").cast("string"))
    return ranked(table(spark, d, "part").select(name.alias("name")).distinct(), C.natural_order(F.col("name")), "place")


R.sql["t3_bounded_sample"] = """WITH n AS (SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS at_, count(*) OVER (PARTITION BY user_id) AS n
FROM events),
k AS (SELECT DISTINCT user_id, i * n // 30 AS at_ FROM (SELECT DISTINCT user_id, n FROM n), range(30) r(i)) SELECT event_id FROM n
WHERE n <= 30 OR (user_id, at_) IN (SELECT (user_id, at_) FROM k)"""


@R.query
def t3_bounded_sample(spark, d):
    return C.bounded_sample(table(spark, d, "events"), "user_id", "event_id", 30).select("event_id")


R.sql["t4_repeatable_sample"] = "SELECT page_id, url FROM pages WHERE ('0x' || substr(md5(url), 1, 8))::BIGINT < (0.1 * 4294967296)::BIGINT"


@R.query
def t4_repeatable_sample(spark, d):
    return C.repeatable_sample(table(spark, d, "pages"), "url", 0.1).select("page_id", "url")


R.sql["t5_reference_camera"] = f"""WITH {COUNTS} SELECT user_id, arg_min(event_type, (n, CASE WHEN event_type = 'view' THEN -1 ELSE 0 END, event_type)) AS reference FROM c
GROUP BY user_id"""


@R.query
def t5_reference_camera(spark, d):
    return C.reference_camera(counts(spark, d), "user_id", "event_type", "n", {"view": -1})


R.sql["j10_remap"] = """WITH p AS (SELECT page_id, regexp_extract(url, '://([^?#]*)', 1) AS path FROM pages), m AS (SELECT path AS old, 'new/' || path AS new FROM p
WHERE page_id % 3 = 0),
e AS (SELECT old, min(new) AS new FROM m GROUP BY old), t AS (SELECT regexp_extract(old, '([^/]*/[^/]*)$', 1) AS tail, min(new) AS new FROM m
GROUP BY 1)
SELECT page_id, coalesce(e.new, t.new) AS new_path, CASE WHEN e.new IS NOT NULL THEN 'path' WHEN t.new IS NOT NULL THEN 'tail' END AS matched_by
FROM p LEFT JOIN e ON p.path = e.old LEFT JOIN t ON regexp_extract(p.path, '([^/]*/[^/]*)$', 1) = t.tail"""


@R.query
def j10_remap(spark, d):
    paths = table(spark, d, "pages").select("page_id", F.regexp_extract("url", "://([^?#]*)", 1).alias("path"))
    mapping = paths.filter("page_id % 3 = 0").select(F.col("path").alias("old"), F.concat(F.lit("new/"), "path").alias("new"))
    tail = lambda c: F.regexp_extract(c, "([^/]*/[^/]*)$", 1)
    return C.remapped(paths, "path", mapping, "old", "new", tail("path"), tail("old")).select("page_id", "new_path", "matched_by")


R.sql["j10_unmatched"] = """WITH p AS (SELECT page_id, regexp_extract(url, '://([^?#]*)', 1) AS path FROM pages), m AS (SELECT path AS old, 'new/' || path AS new FROM p
WHERE page_id % 10 = 0),
t AS (SELECT DISTINCT regexp_extract(old, '([^/]*/[^/]*)$', 1) AS tail FROM m), i AS (SELECT DISTINCT path FROM p WHERE page_id % 4 = 1)
SELECT DISTINCT path FROM p WHERE path NOT IN (SELECT old FROM m) AND regexp_extract(path, '([^/]*/[^/]*)$', 1) NOT IN (SELECT tail FROM t)
AND path NOT IN (SELECT path FROM i)"""


@R.query
def j10_unmatched(spark, d):
    """Paths with no target in the note, by their tail, or in the index."""
    paths = table(spark, d, "pages").select("page_id", F.regexp_extract("url", "://([^?#]*)", 1).alias("path"))
    mapping = paths.filter("page_id % 10 = 0").select(F.col("path").alias("old"), F.concat(F.lit("new/"), "path").alias("new"))
    index = paths.filter("page_id % 4 = 1").select("path", F.concat(F.lit("index/"), "path").alias("new_path"))
    tail = lambda c: F.regexp_extract(c, "([^/]*/[^/]*)$", 1)
    return C.unmatched(C.remapped(paths, "path", mapping, "old", "new", tail("path"), tail("old"), index), "path")


R.sql["j15_nearest_ancestor"] = """WITH p AS (SELECT DISTINCT regexp_extract(url, '://([^?#]*)', 1) AS path FROM pages), f AS (SELECT DISTINCT regexp_extract(url,
'://([^/?#]*/[^/?#]*)/', 1) AS folder FROM pages WHERE page_id % 2 = 0 UNION SELECT regexp_extract(url, '://([^/?#]*)', 1) FROM pages
WHERE page_id % 5 = 0),
u AS (SELECT path, unnest(range(1, 6)) AS k, string_split(path, '/') AS parts FROM p), a AS (SELECT path, len(parts) - k AS depth,
array_to_string(parts[1:len(parts) - k], '/') AS up FROM u WHERE len(parts) - k > 0)
SELECT p.path, max_by(up, depth) AS ancestor FROM p LEFT JOIN (SELECT * FROM a WHERE up IN (SELECT folder FROM f)) x ON p.path = x.path
GROUP BY p.path"""


@R.query
def j15_nearest_ancestor(spark, d):
    pages = table(spark, d, "pages")
    paths = pages.select(F.regexp_extract("url", "://([^?#]*)", 1).alias("path"))
    folders = pages.filter("page_id % 2 = 0").select(F.regexp_extract("url", "://([^/?#]*/[^/?#]*)/", 1).alias("folder"))
    hosts = pages.filter("page_id % 5 = 0").select(F.regexp_extract("url", "://([^/?#]*)", 1).alias("folder"))
    return C.nearest_ancestor(paths, "path", folders.union(hosts), "folder")


R.sql["j16_task"] = """SELECT c_custkey, coalesce(CASE WHEN c_custkey % 7 = 0 THEN 'override_' || c_custkey END, CASE WHEN c_acctbal > 0 THEN c_mktsegment END,
'default') AS task FROM customer"""


@R.query
def j16_task(spark, d):
    customers = table(spark, d, "customer").withColumn("inferred", F.when(F.col("c_acctbal") > 0, F.col("c_mktsegment")))
    overrides = customers.filter("c_custkey % 7 = 0").select("c_custkey", F.concat(F.lit("override_"), "c_custkey").alias("task"))
    return C.resolved_task(customers, "c_custkey", overrides, "inferred", "default").select("c_custkey", "task")


R.sql["u1_united"] = "SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' UNION SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT'"


@R.query
def u1_united(spark, d):
    orders = table(spark, d, "orders")
    return C.united(orders.filter("o_orderstatus = 'F'").select("o_custkey"), orders.filter("o_orderpriority = '1-URGENT'").select("o_custkey"))


R.sql["u3_replaced"] = """SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus <> 'P' UNION ALL SELECT o_orderkey + 1000000, o_orderstatus,
round(o_totalprice * 2, 2) FROM orders WHERE o_orderstatus = 'P' AND o_orderkey % 2 = 0"""


@R.query
def u3_replaced(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    new = orders.filter("o_orderstatus = 'P' AND o_orderkey % 2 = 0").select((F.col("o_orderkey") + 1000000).alias("o_orderkey"), "o_orderstatus", F.round(F.col("o_totalprice") * 2, 2).alias("o_totalprice"))
    return C.replaced(orders, new, "o_orderstatus")


R.sql["j5_routing"] = """SELECT n_name AS name, r_name AS target FROM nation LEFT JOIN region ON n_regionkey = r_regionkey AND n_nationkey % 4 > 0
UNION ALL SELECT r_name, (SELECT arg_min(n_name, n_nationkey) FROM nation WHERE n_regionkey = r_regionkey) FROM region"""


@R.query
def j5_routing(spark, d):
    nations, regions = table(spark, d, "nation"), table(spark, d, "region")
    known = nations.join(regions, nations["n_regionkey"] == regions["r_regionkey"]).select("n_name", "r_name", "n_nationkey")
    there = V.routed(nations, "n_name", known.filter("n_nationkey % 4 > 0"), "r_name").select(F.col("n_name").alias("name"), F.col("r_name").alias("target"))
    back = V.first_task(known, "n_name", "r_name", "n_nationkey").select(F.col("r_name").alias("name"), F.col("n_name").alias("target"))
    return there.unionByName(back)


VOC = """v AS (SELECT p_brand, p_type, 'text ' || min(p_partkey) AS text, min(p_partkey) AS ord FROM part WHERE p_size % 3 > 0 AND p_type <> 'SMALL'
AND p_brand <> 'Brand#7' AND p_partkey % 40 < 3 GROUP BY ALL)"""
R.sql["j6_label_text"] = f"""WITH {VOC}, f AS (SELECT p_type, arg_min(text, ord) AS text FROM v GROUP BY p_type)
SELECT p_partkey, coalesce(v.text, f.text, p.p_type) AS text FROM part p LEFT JOIN v ON p.p_brand = v.p_brand AND p.p_type = v.p_type LEFT
JOIN f ON p.p_type = f.p_type"""


@R.query
def j6_label_text(spark, d):
    parts = table(spark, d, "part")
    known = parts.filter("p_size % 3 > 0 AND p_type <> 'SMALL' AND p_brand <> 'Brand#7' AND p_partkey % 40 < 3").groupBy("p_brand", "p_type").agg(F.min("p_partkey").alias("ord"))
    known = known.withColumn("text", F.concat(F.lit("text "), "ord"))
    return V.verbalised(parts, "p_brand", "p_type", known, "ord").select("p_partkey", "text")


R.sql["j7_task_vocabulary"] = """SELECT r_name, array_to_string(list_sort(list(n_nationkey::VARCHAR || '=' || n_name)), ';') AS entries FROM region
JOIN nation ON n_regionkey = r_regionkey AND r_regionkey <> 2 GROUP BY r_name"""


@R.query
def j7_task_vocabulary(spark, d):
    nations = table(spark, d, "nation").filter("n_regionkey <> 2")
    out = V.task_vocabulary(table(spark, d, "region").withColumnRenamed("r_regionkey", "n_regionkey"), "r_name", "n_regionkey", nations, "n_nationkey", "n_name")
    entries = F.sort_array(F.transform(F.map_entries("entries"), lambda e: F.concat(e["key"].cast("string"), F.lit("="), e["value"])))
    return out.select("r_name", F.array_join(entries, ";").alias("entries"))


