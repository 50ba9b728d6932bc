"""Alignment, gaps and latency on the driver's tables. Episode = user, time = ts in µs, topic = event type, master = click."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.basic import micros
from ..operators import align as A
from ..operators import sync_stats as S
from .tables import Registry, rounded, table

R = Registry()
EV = "ev AS (SELECT *, epoch_us(ts) AS us FROM events)"
NUM = f"{EV}, num AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY us, event_id) - 1 AS frame FROM ev)"


def events(spark, d):
    return table(spark, d, "events").withColumn("us", micros("ts"))


def frames(spark, d):
    return A.number_frames(events(spark, d), "user_id", ["us", "event_id"], "frame")


def masters(spark, d):
    return events(spark, d).filter("event_type = 'click'")


R.sql["w2_frame_numbers"] = f"WITH {NUM} SELECT event_id, user_id, frame::INTEGER AS frame_index FROM num"


@R.query
def w2_frame_numbers(spark, d):
    return A.number_frames(events(spark, d), "user_id", ["us", "event_id"]).select("event_id", "user_id", "frame_index")


GAPS = f"""{EV}, g AS (SELECT user_id, event_id, us, us - lag(us) OVER (PARTITION BY user_id ORDER BY us, event_id) AS gap FROM ev),
p AS (SELECT *, trunc(quantile_cont(gap, 0.5) OVER (PARTITION BY user_id))::BIGINT AS period FROM g),
c AS (SELECT *, CASE WHEN gap IS NULL THEN false WHEN period <= 0 THEN true ELSE gap < 1.5 * period END AS contiguous,
CASE WHEN gap IS NULL OR period <= 0 THEN 0 ELSE greatest(0, least(127, round_even(gap / period, 0)::BIGINT - 1)) END::INTEGER AS drops FROM p)"""
R.sql["w1_contiguity"] = f"WITH {GAPS} SELECT event_id, contiguous, drops FROM c"


@R.query
def w1_contiguity(spark, d):
    return A.contiguity(events(spark, d), "user_id", ["us", "event_id"], "us").select("event_id", "contiguous", "drops")


R.sql["a4_episode_summary"] = f"""WITH {GAPS} SELECT user_id, count(*) AS n_frames, round((max(us) - min(us)) / 1e6, 6) AS duration_s, sum(drops)::BIGINT AS frames_dropped,
round(coalesce(avg(CASE WHEN gap IS NOT NULL THEN contiguous::INT END), 1.0), 6) AS contiguity_ratio FROM c GROUP BY user_id"""


@R.query
def a4_episode_summary(spark, d):
    return rounded(A.episode_summary(A.contiguity(events(spark, d), "user_id", ["us", "event_id"], "us"), "user_id", "us"))


R.sql["p13_null_master"] = f"""WITH {EV}, m AS (SELECT user_id, event_id, CASE WHEN value < 5 THEN NULL ELSE us END AS master FROM ev)
SELECT user_id, event_id, (row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1)::INTEGER AS frame_index FROM m WHERE master IS NOT NULL"""


@R.query
def p13_null_master(spark, d):
    df = events(spark, d).withColumn("master", F.when(F.col("value") >= 5, F.col("us")))
    return A.number_frames(A.drop_null_master(df, "master"), "user_id", "event_id").select("user_id", "event_id", "frame_index")


R.sql["p14_rebase"] = f"""WITH {EV}, f AS (SELECT *, first_value(us) OVER (PARTITION BY user_id ORDER BY us, event_id) AS t0 FROM ev) SELECT event_id, us - t0 AS rel_us,
t0 + (us - t0) AS back_us FROM f"""


@R.query
def p14_rebase(spark, d):
    df = A.rebase(events(spark, d), "user_id", ["us", "event_id"], "us")
    return df.select("event_id", F.col("rel").alias("rel_us"), (F.col("t0") + F.col("rel")).alias("back_us"))


R.sql["p15_episode_identity"] = "SELECT o_orderkey, 'set_' || o_custkey || '_' || o_orderkey AS episode_id, 'set' AS dataset, o_custkey::VARCHAR AS clip FROM orders"


@R.query
def p15_episode_identity(spark, d):
    ident = A.with_case_id([F.lit("set"), F.col("o_custkey").cast("string"), F.col("o_orderkey").cast("string")])
    df = table(spark, d, "orders").select("o_orderkey", ident).withColumn("parts", A.source_parts(F.col("episode_id")))
    return df.select("o_orderkey", "episode_id", F.col("parts")[0].alias("dataset"), F.col("parts")[1].alias("clip"))


R.sql["w3_gap_to_next"] = f"WITH {EV} SELECT event_id, round(coalesce((lead(us) OVER (PARTITION BY user_id ORDER BY us, event_id) - us) / 1e3, 0.0), 6) AS gap_ms FROM ev"


@R.query
def w3_gap_to_next(spark, d):
    return rounded(A.gap_to_next(events(spark, d), "user_id", ["us", "event_id"], "us").select("event_id", "gap_ms"))


R.sql["w5_display_time"] = f"""WITH {EV}, g AS (SELECT event_id, us - lag(us) OVER w AS back, lead(us) OVER w - us AS ahead, row_number() OVER w AS rn
FROM ev WINDOW w AS (PARTITION BY user_id ORDER BY us, event_id))
SELECT event_id, round(CASE WHEN rn > 1 THEN greatest(back / 1e6, 1e-6) WHEN ahead IS NULL THEN 1.0 / 30 ELSE greatest(ahead / 1e6, 1e-6) END,
6) AS shown_s FROM g"""


@R.query
def w5_display_time(spark, d):
    return rounded(A.display_time(events(spark, d), "user_id", ["us", "event_id"], "us").select("event_id", "shown_s"))


R.sql["w10_frame_pairs"] = f"""WITH {NUM} SELECT * FROM (SELECT user_id, frame::INTEGER AS frame, (lead(frame) OVER (PARTITION BY user_id ORDER BY frame))::INTEGER AS next_frame
FROM num) WHERE next_frame IS NOT NULL"""


@R.query
def w10_frame_pairs(spark, d):
    return A.frame_pairs(frames(spark, d), "user_id", "frame", "frame").select("user_id", "frame", "next_frame")


TOL = 3_600_000_000
NEAR = f"""{EV}, m AS (SELECT user_id, event_id, us FROM ev WHERE event_type = 'click'),
cb AS (SELECT user_id, us AS t, max(event_id) AS id FROM ev WHERE event_type = 'purchase' GROUP BY ALL), ca AS (SELECT user_id, us AS t,
min(event_id) AS id FROM ev WHERE event_type = 'purchase' GROUP BY ALL),
b AS (SELECT m.*, cb.t AS bt, cb.id AS bid FROM m ASOF LEFT JOIN cb ON m.user_id = cb.user_id AND m.us > cb.t),
a AS (SELECT b.*, ca.t AS at_, ca.id AS aid FROM b ASOF LEFT JOIN ca ON b.user_id = ca.user_id AND b.us <= ca.t),
n AS (SELECT user_id, event_id, us, CASE WHEN bt IS NULL OR at_ - us <= us - bt THEN aid ELSE bid END AS pick, CASE
WHEN bt IS NULL OR at_ - us <= us - bt THEN at_ - us ELSE bt - us END AS delta FROM a),
j AS (SELECT user_id, event_id, us, CASE WHEN abs(delta) <= {TOL} THEN pick END AS match, CASE WHEN abs(delta) <= {TOL} THEN delta END AS delta
FROM n)"""
R.sql["j2_nearest"] = f"WITH {NEAR} SELECT event_id, match, delta AS delta_us FROM j"


def nearest(spark, d):
    return A.nearest_match(masters(spark, d), events(spark, d).filter("event_type = 'purchase'"), "user_id", "us", "event_id", TOL)


@R.query
def j2_nearest(spark, d):
    return nearest(spark, d).select(F.col("ident").alias("event_id"), "match", F.col("delta").alias("delta_us"))


N_WIN = 5
R.sql["j3_window_match"] = f"""WITH {EV}, r AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY us, event_id) - 1 AS k, us AS t FROM ev WHERE event_type = 'click'),
s AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY us, event_id) - 1 AS f, us AS u FROM ev WHERE event_type = 'view'),
w AS (SELECT r.user_id, k, f, abs(t - u) AS dt, row_number() OVER (PARTITION BY r.user_id, k ORDER BY abs(t - u), abs(f - k), f) AS o FROM r
JOIN s ON r.user_id = s.user_id AND f BETWEEN k - {N_WIN} AND k + {N_WIN}),
b AS (SELECT user_id, k, f, dt FROM w WHERE o = 1), top AS (SELECT user_id, max(f) AS top FROM s GROUP BY user_id),
x AS (SELECT r.user_id, r.k, s.f, abs(t - u) AS dt FROM r JOIN top USING (user_id) JOIN s ON s.user_id = r.user_id AND s.f = least(r.k, top)
WHERE (r.user_id, r.k) NOT IN (SELECT (user_id, k) FROM b))
SELECT user_id, k::INTEGER AS frame, f::INTEGER AS match, round(dt / 1e3, 6) AS difference_ms FROM (SELECT * FROM b UNION ALL SELECT * FROM x)"""


@R.query
def j3_window_match(spark, d):
    of = lambda kind: A.number_frames(events(spark, d).filter(F.col("event_type") == kind), "user_id", ["us", "event_id"], "n")
    out = A.window_match(of("click"), of("view"), "user_id", "n", "us", N_WIN)
    return out.select("user_id", F.col("k").alias("frame"), "match", "difference_ms")


R.sql["j1_frame_alignment"] = """SELECT o_orderkey, l_quantity AS first_l_quantity, l_linestatus AS first_l_linestatus, c_mktsegment AS customer_c_mktsegment
FROM orders LEFT JOIN (SELECT * FROM lineitem WHERE l_linenumber = 1 AND l_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_linenumber = 1
GROUP BY 1 HAVING count(*) = 1)) ON l_orderkey = o_orderkey LEFT JOIN customer ON c_custkey = o_custkey"""


@R.query
def j1_frame_alignment(spark, d):
    from pyspark.sql import Window

    lines = table(spark, d, "lineitem").filter("l_linenumber = 1").withColumn("_n", F.count("*").over(Window.partitionBy("l_orderkey"))).filter("_n = 1")
    orders = A.aligned(table(spark, d, "orders"), {"first": lines.withColumnRenamed("l_orderkey", "o_orderkey")}, "o_orderkey", {"first": ["l_quantity", "l_linestatus"]})
    customers = table(spark, d, "customer").withColumnRenamed("c_custkey", "o_custkey")
    out = A.aligned(orders, {"customer": customers}, "o_custkey", {"customer": ["c_mktsegment"]})
    return out.select("o_orderkey", "first_l_quantity", "first_l_linestatus", "customer_c_mktsegment")


R.sql["j4_checked_join"] = """WITH d AS (SELECT doc_id, lang, n_chars FROM documents WHERE doc_id % 2 = 0 OR lang <> 'fr'), l AS (SELECT d.doc_id, quality FROM documents d LEFT
JOIN labels USING (doc_id) WHERE lang <> 'de' OR d.doc_id % 3 > 0),
b AS (SELECT coalesce(d.doc_id, l.doc_id) AS doc_id, d.doc_id IS NOT NULL AND l.doc_id IS NOT NULL AS ok, n_chars, quality FROM d FULL
JOIN l ON d.doc_id = l.doc_id),
g AS (SELECT lang FROM b JOIN documents USING (doc_id) GROUP BY lang HAVING bool_and(ok)) SELECT b.doc_id, lang, b.n_chars, quality FROM b
JOIN documents x USING (doc_id) WHERE lang IN (SELECT lang FROM g)"""


@R.query
def j4_checked_join(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "lang", "n_chars")
    left = docs.filter("doc_id % 2 = 0 OR lang <> 'fr'").drop("lang")
    right = docs.join(table(spark, d, "labels"), "doc_id", "left").filter("lang <> 'de' OR doc_id % 3 > 0").select("doc_id", "quality")
    tagged = lambda x: x.join(docs.select("doc_id", "lang"), "doc_id")
    return A.checked_join(tagged(left), tagged(right), ["doc_id", "lang"], "lang").select("doc_id", "lang", "n_chars", "quality")


R.sql["j11_on_master"] = """SELECT doc_id, quality, toxic, bool_or(quality IS NOT NULL OR toxic IS NOT NULL) OVER () AS any_set FROM documents LEFT JOIN labels USING (doc_id)"""


@R.query
def j11_on_master(spark, d):
    return A.on_master(table(spark, d, "documents").select("doc_id"), table(spark, d, "labels"), "doc_id", ["quality", "toxic"])


R.sql["j12_enrichment"] = """SELECT l_orderkey, l_linenumber, l_suppkey, l_quantity, o_custkey, s_nationkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey
JOIN supplier ON l_suppkey = s_suppkey"""


@R.query
def j12_enrichment(spark, d):
    orders = table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    suppliers = table(spark, d, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    out = A.enriched(table(spark, d, "lineitem"), orders, suppliers, "l_orderkey", "l_suppkey")
    return out.select("l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "o_custkey", "s_nationkey")


R.sql["j13_ranges_to_frames"] = f"""WITH {NUM}, r AS (SELECT o_orderkey, o_custkey AS user_id, o_orderkey % 50 AS first, o_orderkey % 50 + o_orderkey % 7 AS last FROM orders)
SELECT o_orderkey, num.user_id, frame::BIGINT AS frame, event_id FROM r JOIN num ON num.user_id = r.user_id AND frame BETWEEN first AND last"""


@R.query
def j13_ranges_to_frames(spark, d):
    start = F.col("o_orderkey") % 50
    ranges = table(spark, d, "orders").select("o_orderkey", F.col("o_custkey").alias("user_id"), start.alias("first"), (start + F.col("o_orderkey") % 7).alias("last"))
    numbered = frames(spark, d).select("user_id", F.col("frame").cast("long").alias("frame"), "event_id")
    return A.ranges_to_frames(ranges, "user_id", "first", "last", numbered, "frame").select("o_orderkey", "user_id", "frame", "event_id")


R.sql["j17_frame_spine"] = """WITH m AS (SELECT conv_id, max(turn) + 3 AS n FROM conversations GROUP BY conv_id), s AS (SELECT conv_id, unnest(range(0, n)) AS turn FROM m),
c AS (SELECT conv_id, turn, min(role) AS role FROM conversations GROUP BY ALL)
SELECT s.conv_id, s.turn, coalesce(c.role, 'filler') AS role, c.conv_id IS NOT NULL AS is_real FROM s LEFT JOIN c ON s.conv_id = c.conv_id
AND s.turn = c.turn"""


@R.query
def j17_frame_spine(spark, d):
    talk = table(spark, d, "conversations").groupBy("conv_id", "turn").agg(F.min("role").alias("role"))
    most = talk.groupBy("conv_id").agg((F.max("turn") + 3).alias("n"))
    return A.completed(most, "conv_id", F.col("n"), talk, "turn", {"role": F.lit("filler")})


DELTA = f"""{EV}, mm AS (SELECT user_id, min(us) AS t0 FROM ev WHERE event_type = 'click' GROUP BY user_id),
dl AS (SELECT ev.user_id, event_type, event_id, CASE WHEN value < 3 THEN NULL ELSE us - t0 END AS delta FROM ev JOIN mm USING (user_id))"""


def deltas(spark, d):
    start = masters(spark, d).groupBy("user_id").agg(F.min("us").alias("t0"))
    delta = F.when(F.col("value") >= 3, F.col("us") - F.col("t0"))
    return events(spark, d).join(start, "user_id").select("user_id", "event_type", "event_id", delta.alias("delta"))


R.sql["a1_topic_latency"] = f"""WITH {DELTA}, s AS (SELECT user_id, event_type, round(quantile_cont(abs(delta), 0.5) / 1e3, 6) AS median_ms, avg(abs(delta)) / 1e3 AS mean_ms,
round(stddev_pop(abs(delta)) / 1e3, 3) AS std_ms, round(max(abs(delta)) / 1e3, 6) AS max_ms, count(delta) AS n_present FROM dl GROUP BY ALL),
f AS (SELECT user_id, event_type, event_id, row_number() OVER (PARTITION BY user_id, event_type ORDER BY abs(delta) DESC, event_id) AS o FROM dl
WHERE delta IS NOT NULL),
t AS (SELECT unnest(['click', 'error', 'purchase', 'signup', 'view', 'absent']) AS event_type), u AS (SELECT DISTINCT user_id FROM dl)
SELECT u.user_id, t.event_type, median_ms, mean_ms, std_ms, max_ms, event_id AS max_frame, coalesce(n_present, 0) AS n_present FROM u CROSS JOIN t
LEFT JOIN s ON s.user_id = u.user_id AND s.event_type = t.event_type LEFT JOIN f ON f.user_id = u.user_id AND f.event_type = t.event_type AND o = 1"""


@R.query
def a1_topic_latency(spark, d):
    topics = spark.createDataFrame([(t,) for t in ("click", "error", "purchase", "signup", "view", "absent")], "event_type string")
    out = S.topic_latency(deltas(spark, d), "user_id", "event_type", "event_id", "delta", topics)
    return rounded(out, mean_ms=None, std_ms=3)


R.sql["a2_pooled_latency"] = f"""WITH {DELTA} SELECT user_id, round(quantile_cont(abs(delta), 0.5) FILTER (event_type IN ('view', 'purchase')) / 1e3, 6) AS some_median_ms,
round(max(abs(delta)) FILTER (event_type IN ('view', 'purchase')) / 1e3, 6) AS some_max_ms,
round(quantile_cont(abs(delta), 0.5) / 1e3, 6) AS all_median_ms, avg(abs(delta)) / 1e3 AS all_mean_ms, round(stddev_pop(abs(delta)) / 1e3,
3) AS all_std_ms, round(max(abs(delta)) / 1e3, 6) AS all_max_ms FROM dl GROUP BY user_id"""


@R.query
def a2_pooled_latency(spark, d):
    out = S.pooled_latency(deltas(spark, d), "user_id", "delta", F.col("event_type").isin("view", "purchase"))
    return rounded(out, all_mean_ms=None, all_std_ms=3)


R.sql["a3_out_of_tolerance"] = f"""WITH {DELTA}, t AS (SELECT * FROM (VALUES ('click', 1000000000::BIGINT), ('view', 500000000000), ('purchase', 100000000000), ('signup', 0), ('error',
2000000000000)) v(event_type, tolerance))
SELECT event_type, count(delta) AS n_present, count(*) FILTER (abs(delta) > tolerance) AS n_out FROM dl JOIN t USING (event_type) GROUP BY event_type"""


@R.query
def a3_out_of_tolerance(spark, d):
    tolerances = spark.createDataFrame([("click", 10**9), ("view", 5 * 10**11), ("purchase", 10**11), ("signup", 0), ("error", 2 * 10**12)], "event_type string, tolerance long")
    return S.out_of_tolerance(deltas(spark, d), "event_type", "delta", tolerances)


R.sql["a15_worst_gap"] = """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(greatest(abs(l_tax - l_discount), abs(l_quantity / 100 - l_discount)), 6) AS worst
FROM lineitem"""


@R.query
def a15_worst_gap(spark, d):
    worst = S.worst_gap([F.col("l_tax"), F.col("l_quantity") / 100, F.lit(None).cast("double")], F.col("l_discount"))
    return rounded(table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", worst.alias("worst")))


R.sql["a16_tolerance_summary"] = """SELECT round(min(value), 6) AS min_value, round(max(value), 6) AS max_value, round(avg(value), 6) AS mean_value, round(stddev_pop(value),
6) AS std_value, count(value) AS n FROM events"""


@R.query
def a16_tolerance_summary(spark, d):
    return S.summary(table(spark, d, "events"), "value")


R.sql["a19_inspect_times"] = f"""WITH {EV}, g AS (SELECT user_id, us / 1e6 AS t, (us - lag(us) OVER (PARTITION BY user_id ORDER BY us, event_id)) / 1e6 AS gap FROM ev)
SELECT user_id, round(min(t), 6) AS first_s, round(max(t), 6) AS last_s, round(max(t) - min(t), 4) AS span_s, round(avg(gap), 6) AS mean_gap_s,
round(min(gap), 6) AS min_gap_s, round(max(gap), 6) AS max_gap_s, round(stddev_pop(gap), 5) AS std_gap_s, round(CASE
WHEN avg(gap) <> 0 THEN 1.0 / avg(gap) END, 6) AS rate_hz, min(t) < 1 AS near_zero FROM g GROUP BY user_id"""


@R.query
def a19_inspect_times(spark, d):
    return rounded(S.inspect_times(events(spark, d), "user_id", ["us", "event_id"], "us"), span_s=4, std_gap_s=5)
