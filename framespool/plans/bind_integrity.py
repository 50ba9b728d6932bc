"""Integrity, manifests and set differences on the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import integrity as I
from .tables import Registry, table

R = Registry()
R.sql["v1_required"] = """SELECT 'ERROR' AS severity, 'MISSING' AS code, u.user_id::VARCHAR AS key, 'missing ' || t AS message FROM (SELECT DISTINCT user_id FROM events) u,
(SELECT unnest(['click', 'view', 'signup', 'gesture']) AS t)
WHERE (u.user_id, t) NOT IN (SELECT (user_id, event_type) FROM events)"""


@R.query
def v1_required(spark, d):
    required = spark.createDataFrame([("click",), ("view",), ("signup",), ("gesture",)], "event_type string")
    return I.missing_required(table(spark, d, "events"), "user_id", "event_type", required)


V2 = """n AS (SELECT o_orderkey, o_orderstatus, o_totalprice, count(l_orderkey) AS lines FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey
GROUP BY ALL),
i AS (SELECT 'ERROR' AS severity, 'E-STATE' AS code, o_orderkey::VARCHAR AS key, 'state P' AS message FROM n WHERE o_orderstatus = 'P' UNION ALL
SELECT 'WARNING', 'E-PRICE', o_orderkey::VARCHAR, 'price over 400000' FROM n WHERE o_totalprice > 400000 UNION ALL SELECT 'ERROR', 'E-ROWS',
o_orderkey::VARCHAR, 'lines ' || lines FROM n WHERE lines = 0 OR lines > 9)"""
R.sql["v2_episode_rules"] = f"WITH {V2} SELECT * FROM i"


def issues(spark, d):
    lines = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("lines"))
    df = table(spark, d, "orders").join(lines, "o_orderkey", "left").withColumn("lines", F.coalesce("lines", F.lit(0)))
    rules = [
        I.rule(F.col("o_orderstatus") == "P", "ERROR", "E-STATE", "state P"), I.rule(F.col("o_totalprice") > 400000, "WARNING", "E-PRICE", "price over 400000"),
        I.rule((F.col("lines") == 0) | (F.col("lines") > 9), "ERROR", "E-ROWS", F.concat(F.lit("lines "), "lines")),
    ]
    return I.row_issues(df, "o_orderkey", rules)


@R.query
def v2_episode_rules(spark, d):
    return issues(spark, d)


R.sql["a21_roll_up"] = f"WITH {V2} SELECT severity, code, count(*) AS n, severity = 'ERROR' AS fails FROM i GROUP BY ALL"


@R.query
def a21_roll_up(spark, d):
    return I.roll_up(issues(spark, d))


R.sql["j8_reconciled"] = """WITH c AS (SELECT c_custkey AS k FROM customer WHERE c_custkey % 10 > 0), o AS (SELECT DISTINCT o_custkey AS k FROM orders)
SELECT 'ERROR' AS severity, 'I-1' AS code, k::VARCHAR AS key, 'only on the left' AS message FROM c WHERE k NOT IN (SELECT k FROM o) UNION ALL
SELECT 'ERROR', 'I-2', k::VARCHAR, 'only on the right' FROM o WHERE k NOT IN (SELECT k FROM c)"""


@R.query
def j8_reconciled(spark, d):
    left = table(spark, d, "customer").filter("c_custkey % 10 > 0").select(F.col("c_custkey").alias("k"))
    return I.reconciled(left, table(spark, d, "orders").select(F.col("o_custkey").alias("k")), "k", "I-1", "I-2")


R.sql["v3_dataset_rules"] = """WITH x AS (SELECT 'I-1' AS code, o_orderkey::VARCHAR AS key, 'only on the left' AS message FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey
FROM lineitem)
UNION ALL SELECT DISTINCT 'I-2', l_orderkey::VARCHAR, 'only on the right' FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)
UNION ALL SELECT 'I-6', p_brand, 'unknown ' || p_type FROM (SELECT DISTINCT p_brand, p_type FROM part WHERE p_brand IN ('Brand#1', 'Brand#2')
AND p_type NOT IN ('SMALL', 'ECONOMY'))) SELECT 'ERROR' AS severity, * FROM x"""


@R.query
def v3_dataset_rules(spark, d):
    orders, lines, parts = table(spark, d, "orders"), table(spark, d, "lineitem"), table(spark, d, "part")
    keys = I.reconciled(orders.select(F.col("o_orderkey").alias("k")), lines.select(F.col("l_orderkey").alias("k")), "k", "I-1", "I-2")
    words = spark.createDataFrame([(b, t) for b in ("Brand#1", "Brand#2") for t in ("SMALL", "ECONOMY")], "p_brand string, p_type string")
    unknown = I.unknown_values(parts, "p_brand", "p_type", words)
    return keys.unionByName(unknown.select(F.lit("ERROR").alias("severity"), F.lit("I-6").alias("code"), F.col("p_brand").alias("key"), F.concat(F.lit("unknown "), "p_type").alias("message")))


R.sql["v4_export_rules"] = """SELECT 'ERROR' AS severity, 'SIZE' AS code, p_partkey::VARCHAR AS key, 'size ' || p_size || ' is under 20' AS message FROM part WHERE p_size < 20
UNION ALL SELECT 'WARNING', 'PRICE', p_partkey::VARCHAR, 'price under 950' FROM part WHERE p_retailprice < 950 UNION ALL SELECT 'INFO', 'NAME',
p_partkey::VARCHAR, 'no colour' FROM part WHERE NOT regexp_matches(p_name, '^(red|blue|green|small|large) ')"""


@R.query
def v4_export_rules(spark, d):
    rules = [
        I.rule(F.col("p_size") < 20, "ERROR", "SIZE", F.concat(F.lit("size "), "p_size", F.lit(" is under 20"))), I.rule(F.col("p_retailprice") < 950, "WARNING", "PRICE", "price under 950"),
        I.rule(~F.col("p_name").rlike("^(red|blue|green|small|large) "), "INFO", "NAME", "no colour"),
    ]
    return I.row_issues(table(spark, d, "part"), "p_partkey", rules)


R.sql["v5_manifest"] = "SELECT 'doc/' || doc_id AS path, sha256(text) AS sha256, strlen(text) AS size FROM documents WHERE source <> 'src3'"


def files(spark, d, change=None):
    docs = table(spark, d, "documents").withColumn("path", F.concat(F.lit("doc/"), "doc_id"))
    return I.manifest(docs.withColumn("text", change) if change is not None else docs, "path", "text", F.col("source") != "src3")


@R.query
def v5_manifest(spark, d):
    return files(spark, d)


ALTER = "CASE WHEN doc_id % 11 = 0 THEN text || 'x' WHEN doc_id % 13 = 0 THEN replace(text, 'e', 'i') ELSE text END"


def altered():
    return F.when(F.col("doc_id") % 11 == 0, F.concat("text", F.lit("x"))).when(F.col("doc_id") % 13 == 0, F.replace(F.col("text"), F.lit("e"), F.lit("i"))).otherwise(F.col("text"))


R.sql["v6_verified"] = f"""WITH a AS (SELECT 'doc/' || doc_id AS path, text, doc_id % 17 > 0 AS there, {ALTER} AS other FROM documents WHERE source <> 'src3')
SELECT path, CASE WHEN NOT there THEN 'MISSING' WHEN strlen(text) <> strlen(other) THEN 'SIZE' WHEN text <> other THEN 'HASH' ELSE 'OK' END AS status
FROM a"""


@R.query
def v6_verified(spark, d):
    gone = F.substring("path", 5, 20).cast("long") % 17 == 0
    return I.verified(files(spark, d), files(spark, d, altered()).filter(~gone))


R.sql["j9_delta"] = f"""WITH a AS (SELECT 'doc/' || doc_id AS path, text, doc_id % 17 > 0 AS there, {ALTER} AS other FROM documents WHERE source <> 'src3')
SELECT path, CASE WHEN NOT there THEN 'new' WHEN text = other THEN 'unchanged' ELSE 'changed' END AS state FROM a"""


@R.query
def j9_delta(spark, d):
    gone = F.substring("path", 5, 20).cast("long") % 17 == 0
    return I.delta(files(spark, d), files(spark, d, altered()).filter(~gone))


R.sql["j14_round_trip"] = """WITH g AS (SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS doc, max(l_quantity) AS q, max(l_extendedprice) AS e,
max(l_linestatus) AS s, max(l_orderkey) AS k FROM lineitem GROUP BY 1)
SELECT doc, 'quantity' AS path, 'differs' AS kind FROM g WHERE k % 5 = 0 UNION ALL SELECT doc, 'status', 'missing' FROM g WHERE k % 7 = 0"""


@R.query
def j14_round_trip(spark, d):
    doc = F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    first = table(spark, d, "lineitem").groupBy(doc.alias("doc")).agg(F.max("l_quantity").alias("q"), F.max("l_extendedprice").alias("e"), F.max("l_linestatus").alias("s"), F.max("l_orderkey").alias("k"), F.max("l_tax").alias("x"))
    second = first.select(
        "doc", F.when(F.col("k") % 5 == 0, F.col("q") * 1.001 + 1).otherwise(F.col("q")).alias("q"), (F.col("e") * (1 + 1e-7)).alias("e"),
        F.when(F.col("k") % 7 > 0, F.col("s")).alias("s"), (F.col("x") + 1).alias("x"),
    )
    return I.round_trip(first, second, "doc", {"q": "quantity", "e": "price", "s": "status", "x": "stamp"}, known_lossy=["stamp"])


R.sql["u2_unknown_values"] = "SELECT DISTINCT p_brand, p_type FROM part WHERE p_brand IN ('Brand#1', 'Brand#2', 'Brand#3') AND p_type NOT IN ('SMALL', 'ECONOMY')"


@R.query
def u2_unknown_values(spark, d):
    words = spark.createDataFrame([(f"Brand#{b}", t) for b in (1, 2, 3) for t in ("SMALL", "ECONOMY")], "p_brand string, p_type string")
    return I.unknown_values(table(spark, d, "part"), "p_brand", "p_type", words)


R.sql["u4_duplicates"] = """SELECT user_id, event_type, count(*) AS n, array_to_string(list_sort(list_distinct(list(props))), ',') AS sources FROM events
GROUP BY ALL HAVING count(*) > 1"""


@R.query
def u4_duplicates(spark, d):
    return I.duplicates(table(spark, d, "events"), ["user_id", "event_type"], "props")


R.sql["u4_all_duplicates"] = """SELECT user_id, event_type, count(*) AS n, array_to_string(list_sort(list_distinct(list(props))), ',') AS sources FROM events
GROUP BY ALL HAVING count(*) > 1"""


@R.query
def u4_all_duplicates(spark, d):
    """As u4_duplicates, which looked at a part of events once; the name stays for those who use it."""
    return u4_duplicates(spark, d)


R.sql["u5_not_done"] = "SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem) OR o_orderstatus = 'P'"


@R.query
def u5_not_done(spark, d):
    orders = table(spark, d, "orders")
    done = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return I.not_done(orders.select("o_orderkey"), done, "o_orderkey", orders.filter("o_orderstatus = 'P'").select("o_orderkey"))

