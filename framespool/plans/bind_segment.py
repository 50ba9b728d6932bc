"""Segmentation, numbering, profiles and coverage on the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import profile as P
from ..operators import segment as G
from .tables import Registry, rounded, table

R = Registry()
SEG = """c AS (SELECT conv_id, turn, min(role) AS role, max(length(text)) AS chars FROM conversations GROUP BY ALL),
l AS (SELECT *, lag(role) OVER w AS was, lag(turn) OVER w AS at_, row_number() OVER w AS rn FROM c WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
s AS (SELECT conv_id, turn, role, chars, sum(CASE WHEN rn = 1 THEN 0 WHEN was IS DISTINCT
FROM role OR turn - at_ <> 1 THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn)::INTEGER AS segment FROM l)"""


def turns(spark, d):
    talk = table(spark, d, "conversations").groupBy("conv_id", "turn").agg(F.min("role").alias("role"), F.max(F.length("text")).alias("chars"))
    return G.segments(talk, "conv_id", "turn", "role")


R.sql["w4_segments"] = f"WITH {SEG} SELECT conv_id, turn, role, segment FROM s"


@R.query
def w4_segments(spark, d):
    return turns(spark, d).select("conv_id", "turn", "role", "segment")


R.sql["w6_segment_time"] = f"""WITH {SEG} SELECT conv_id, turn, (row_number() OVER w - 1)::INTEGER AS frame_index, turn - first_value(turn) OVER w AS since
FROM s WINDOW w AS (PARTITION BY conv_id, segment ORDER BY turn)"""


@R.query
def w6_segment_time(spark, d):
    return G.within_segment(turns(spark, d), ["conv_id", "segment"], "turn", "turn", relative="since").select("conv_id", "turn", "frame_index", "since")


def numbered(spark, d):
    parts = turns(spark, d).groupBy("conv_id", "segment").agg(F.count("*").alias("n_frames"), F.sum("chars").cast("long").alias("chars"))
    return G.number_episodes(parts, "conv_id", "segment", start=5)


EPI = f"""{SEG}, q AS (SELECT conv_id, segment, count(*) AS n_frames, sum(chars)::BIGINT AS chars FROM s GROUP BY ALL), k AS (SELECT conv_id,
(row_number() OVER (ORDER BY conv_id) + 4)::INTEGER AS case_index FROM (SELECT DISTINCT conv_id FROM q)),
e AS (SELECT conv_id, segment, case_index, (case_index * 100 + row_number() OVER (PARTITION BY conv_id ORDER BY segment) - 1)::INTEGER AS episode_id,
n_frames, chars FROM q JOIN k USING (conv_id))"""
R.sql["w7_episode_numbers"] = f"WITH {EPI} SELECT conv_id, segment, case_index, episode_id FROM e"


@R.query
def w7_episode_numbers(spark, d):
    return numbered(spark, d).select("conv_id", "segment", "case_index", "episode_id")


R.sql["w8_reindex"] = "SELECT o_orderkey, (row_number() OVER (ORDER BY o_orderdate, o_orderpriority, o_orderkey) + 999)::BIGINT AS new_index FROM orders"


@R.query
def w8_reindex(spark, d):
    out = G.ranked(table(spark, d, "orders").select("o_orderkey", "o_orderdate", "o_orderpriority"), ["o_orderdate", "o_orderpriority", "o_orderkey"], "at")
    return out.select("o_orderkey", (F.col("at") + 1000).alias("new_index"))


R.sql["s14_learning_export"] = f"WITH {EPI} SELECT case_index AS case_id, count(*) AS episodes, sum(n_frames)::BIGINT AS frames FROM e GROUP BY case_index"


@R.query
def s14_learning_export(spark, d):
    from ..sources.sinks import export_episodes

    keyed = turns(spark, d).join(numbered(spark, d).select("conv_id", "segment", "case_index", "episode_id"), ["conv_id", "segment"])
    back = export_episodes(keyed.withColumnRenamed("case_index", "case_id").select("case_id", "episode_id", "turn", "role", "chars"))
    return back.groupBy("case_id").agg(F.count_distinct("episode_id").alias("episodes"), F.count("*").alias("frames"))


R.sql["a12_duration_statistics"] = f"""WITH {EPI}, z AS (SELECT conv_id::VARCHAR AS name, 'case' AS kind, n_frames::DOUBLE AS v FROM e UNION ALL SELECT segment::VARCHAR, 'phase', n_frames
FROM e)
SELECT name, kind, min(v) AS min_value, max(v) AS max_value, round(avg(v), 6) AS mean_value, round(stddev_pop(v), 6) AS std_value, count(v) AS n
FROM z GROUP BY ALL"""


@R.query
def a12_duration_statistics(spark, d):
    df = numbered(spark, d).withColumn("v", F.col("n_frames").cast("double"))
    return rounded(G.duration_statistics(df, "conv_id", "v", "case").unionByName(G.duration_statistics(df, "segment", "v", "phase")))


R.sql["a13_time_totals"] = """WITH c AS (SELECT l_orderkey, arg_min(l_returnflag, (l_linenumber, l_partkey, l_suppkey, l_returnflag)) AS flag, count(*) AS n, sum(l_quantity) AS f,
sum(l_tax) AS s FROM lineitem GROUP BY l_orderkey)
SELECT flag AS l_returnflag, l_orderkey, sum(n)::BIGINT AS episodes, round(sum(f), 4) AS frames, round(sum(s), 4) AS seconds FROM c
GROUP BY ROLLUP (flag, l_orderkey)"""


@R.query
def a13_time_totals(spark, d):
    first = F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_returnflag")
    return rounded(G.time_totals(table(spark, d, "lineitem"), "l_returnflag", "l_orderkey", first, "l_quantity", "l_tax"), 4)


R.sql["a14_feature_statistics"] = """WITH p AS (SELECT label, unnest(range(0, len(embedding))) AS k, unnest(embedding)::DOUBLE AS v FROM embeddings)
SELECT label, 'embedding[' || k || ']' AS feature, round(min(v), 6) AS min_value, round(max(v), 6) AS max_value, round(avg(v), 6) AS mean_value,
round(stddev_pop(v), 6) AS std_value, count(v) AS n FROM p GROUP BY ALL"""


@R.query
def a14_feature_statistics(spark, d):
    return rounded(G.feature_statistics(table(spark, d, "embeddings"), "label", ["embedding"], ["vec_id"], exclude="_id$"))


R.sql["t2_worst"] = """SELECT o_custkey, o_orderkey, o_totalprice, rank::INTEGER AS rank FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey
ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM orders) WHERE rank <= 3
UNION ALL SELECT NULL, o_orderkey, o_totalprice, NULL FROM (SELECT * FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 3)"""


@R.query
def t2_worst(spark, d):
    orders, order = table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_totalprice"), [F.desc("o_totalprice"), F.col("o_orderkey")]
    over = G.worst(orders, order, 3).select(F.lit(None).cast("long").alias("o_custkey"), "o_orderkey", "o_totalprice", F.lit(None).cast("int").alias("rank"))
    return G.worst(orders, order, 3, by="o_custkey").unionByName(over)


NUMERIC = ("l_quantity", "l_extendedprice", "l_discount", "l_linenumber")
_PRO = """SELECT '{n}' AS column_name, count(v) AS n, count(*) FILTER (v IS NULL) AS null_count, 0::BIGINT AS nan_count, min(v) AS min_value,
max(v) AS max_value, round(avg(v), 6) AS mean_value, round(stddev_samp(v), 6) AS std_value, round(quantile_cont(v, 0.01), 6) AS q01,
round(quantile_cont(v, 0.99), 6) AS q99, NULL::BIGINT AS vocab_size FROM (SELECT {c}::DOUBLE AS v FROM {t})"""
R.sql["a5_column_profile"] = (
    " UNION ALL ".join(_PRO.format(n=c, c=c, t="lineitem") for c in NUMERIC)
    + " UNION ALL SELECT 'embedding[' || k || ']', count(v), count(*) FILTER (v IS NULL), 0, min(v), max(v), round(avg(v), 6), round(stddev_samp(v), 6), round(quantile_cont(v, 0.01), 6), round(quantile_cont(v, 0.99), 6), NULL"
    + " FROM (SELECT unnest(range(0, len(embedding))) AS k, unnest(embedding)::DOUBLE AS v FROM embeddings) GROUP BY k"
    + " UNION ALL " + " UNION ALL ".join(f"SELECT '{c}', count({c}), count(*) FILTER ({c} IS NULL), 0, NULL, NULL, NULL, NULL, NULL, NULL, count(DISTINCT {c}) FROM documents" for c in ("lang", "source"))
)


@R.query
def a5_column_profile(spark, d):
    lines = P.column_profile(table(spark, d, "lineitem"), list(NUMERIC))
    vectors = P.column_profile(table(spark, d, "embeddings"), ["embedding"])
    return lines.unionByName(vectors).unionByName(P.column_profile(table(spark, d, "documents"), ["lang", "source"]))


def covered(spark, d):
    df = table(spark, d, "documents").select("doc_id", "lang", "source").join(table(spark, d, "labels"), "doc_id", "left")
    return P.coverage(df, "lang", ["source", "quality", "toxic"], ["source", "quality", "toxic", "gesture"])


COV = """w AS (SELECT lang, count(*) AS n, count(source) AS source, count(quality) AS quality, count(toxic) AS toxic, 0::BIGINT AS gesture FROM documents LEFT
JOIN labels USING (doc_id) GROUP BY lang),
u AS (UNPIVOT w ON source, quality, toxic, gesture INTO NAME topic VALUE populated), v AS (SELECT lang, topic, populated > 0 AS present, populated,
CASE WHEN populated > 0 THEN round(populated / n, 4) END AS coverage FROM u)"""
R.sql["a9_coverage"] = f"WITH {COV} SELECT * FROM v"


@R.query
def a9_coverage(spark, d):
    return covered(spark, d)


R.sql["a10_release_coverage"] = f"""WITH {COV} SELECT topic, count(*) FILTER (present) AS n_present, count(*) AS n_total, sum(populated)::BIGINT AS populated FROM v GROUP BY topic"""


@R.query
def a10_release_coverage(spark, d):
    return P.release_coverage(covered(spark, d))


R.sql["a11_inventory"] = """SELECT o_orderstatus, count(*) AS episodes, sum(o_custkey)::BIGINT AS frames, array_to_string(list_sort(list_distinct(list(o_orderpriority))),
',') AS datasets FROM orders GROUP BY ROLLUP (o_orderstatus)"""


@R.query
def a11_inventory(spark, d):
    return P.inventory(table(spark, d, "orders"), "o_orderstatus", "o_orderpriority", "o_custkey")


R.sql["a17_size_breakdown"] = """SELECT l_returnflag, round(sum(l_extendedprice), 2) AS items, round(sum(l_quantity), 2) AS seconds, count(DISTINCT l_suppkey) AS clips, round(avg(CASE
WHEN l_tax > 0 THEN l_tax END), 6) AS mean_rate,
round(sum(l_extendedprice) / sum(sum(l_extendedprice)) OVER (), 6) AS share FROM lineitem GROUP BY l_returnflag"""


@R.query
def a17_size_breakdown(spark, d):
    rate = F.when(F.col("l_tax") > 0, F.col("l_tax"))
    return rounded(P.size_breakdown(table(spark, d, "lineitem"), "l_returnflag", "l_extendedprice", "l_quantity", rate, "l_suppkey"), items=2, seconds=2)


R.sql["a18_label_statistics"] = """SELECT toxic, count(*) AS n_labels, count(DISTINCT doc_id) AS n_frames, CASE
WHEN toxic IS NULL THEN round(100.0 * count(DISTINCT doc_id) / (SELECT count(*) FROM documents), 4) END::DOUBLE AS progress FROM labels
GROUP BY ROLLUP (toxic)"""


@R.query
def a18_label_statistics(spark, d):
    return P.label_statistics(table(spark, d, "labels"), table(spark, d, "documents"), "doc_id", "toxic")


TABLES = ("events", "documents", "lineitem", "orders", "pages")
R.sql["a20_totals"] = " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in TABLES)


@R.query
def a20_totals(spark, d):
    return P.totals({t: table(spark, d, t) for t in TABLES})


