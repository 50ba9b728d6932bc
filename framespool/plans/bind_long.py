"""Episodes of any length on the driver's tables: user 0 has all events of the users with even ids, half of the table."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.basic import micros
from ..operators import long_runs as L
from .tables import Registry, table

R = Registry()
EV = "ev AS (SELECT event_id, event_type, epoch_us(ts) AS us, CASE WHEN user_id % 2 = 0 THEN 0 ELSE user_id END AS user_id FROM events)"
TOL = 600_000_000


def events(spark, d):
    user = F.when(F.col("user_id") % 2 == 0, 0).otherwise(F.col("user_id")).cast("bigint")
    return table(spark, d, "events").select("event_id", "event_type", micros("ts").alias("us"), user.alias("user_id"))


R.sql["w1_long_contiguity"] = f"""WITH {EV}, g AS (SELECT *, us - lag(us) OVER (PARTITION BY user_id ORDER BY us, event_id) AS gap FROM ev),
p AS (SELECT *, trunc(quantile_cont(gap, 0.5) OVER (PARTITION BY user_id))::BIGINT AS period FROM g)
SELECT user_id, event_id, CASE WHEN gap IS NULL THEN false WHEN period <= 0 THEN true ELSE gap < 1.5 * period END AS contiguous,
CASE WHEN gap IS NULL OR period <= 0 THEN 0 ELSE greatest(0, least(127, round_even(gap / period, 0)::BIGINT - 1)) END::INTEGER AS drops FROM p"""


@R.query
def w1_long_contiguity(spark, d):
    return L.contiguity(events(spark, d), "user_id", ["us", "event_id"], "us").select("user_id", "event_id", "contiguous", "drops")


R.sql["j2_long_nearest"] = f"""WITH {EV}, m AS (SELECT user_id, event_id, us FROM ev WHERE event_type = 'click'), p AS (SELECT user_id, event_id, us FROM ev WHERE event_type = 'purchase'),
pf AS (SELECT user_id, us, min(event_id) AS first, max(event_id) AS last FROM p GROUP BY ALL),
a AS (SELECT m.user_id, m.event_id, m.us, pf.us AS ahead, pf.first AS ahead_id FROM m ASOF LEFT JOIN pf ON m.user_id = pf.user_id AND m.us <= pf.us),
b AS (SELECT a.*, pf.us AS behind, pf.last AS behind_id FROM a ASOF LEFT JOIN pf ON a.user_id = pf.user_id AND a.us > pf.us),
c AS (SELECT user_id, event_id, CASE WHEN behind IS NULL OR ahead - us <= us - behind THEN ahead_id ELSE behind_id END AS pick,
CASE WHEN behind IS NULL OR ahead - us <= us - behind THEN ahead - us ELSE behind - us END AS delta FROM b)
SELECT user_id, event_id, CASE WHEN abs(delta) <= {TOL} THEN pick END AS match, CASE WHEN abs(delta) <= {TOL} THEN delta END AS delta_us FROM c"""


@R.query
def j2_long_nearest(spark, d):
    kind = lambda k: events(spark, d).filter(F.col("event_type") == k)
    found = L.nearest_match(kind("click"), kind("purchase"), "user_id", "us", "event_id", TOL)
    return found.select("user_id", F.col("ident").alias("event_id"), "match", F.col("delta").alias("delta_us"))


R.sql["w4_long_segments"] = f"""WITH {EV}, c AS (SELECT user_id, event_id, CASE WHEN lag(event_id) OVER w IS NULL THEN 0
WHEN lag(event_type) OVER w IS DISTINCT FROM event_type OR event_id - lag(event_id) OVER w > 1 THEN 1 ELSE 0 END AS change FROM ev WINDOW w AS (PARTITION BY user_id ORDER BY event_id))
SELECT user_id, event_id, sum(change) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING)::INTEGER AS segment FROM c"""


@R.query
def w4_long_segments(spark, d):
    return L.segments(events(spark, d), "user_id", "event_id", "event_type").select("user_id", "event_id", "segment")


R.sql["j13_long_ranges"] = f"""WITH {EV}, r AS (SELECT o_orderkey, CASE WHEN o_custkey % 2 = 0 THEN 0 ELSE o_custkey END AS user_id, o_orderkey * 3 % 90000 AS first,
o_orderkey * 3 % 90000 + o_orderkey % 211 AS last FROM orders)
SELECT o_orderkey, r.user_id, event_id FROM r JOIN ev ON ev.user_id = r.user_id AND event_id BETWEEN first AND last"""


@R.query
def j13_long_ranges(spark, d):
    start, user = F.col("o_orderkey") * 3 % 90000, F.when(F.col("o_custkey") % 2 == 0, 0).otherwise(F.col("o_custkey")).cast("bigint")
    ranges = table(spark, d, "orders").select("o_orderkey", user.alias("user_id"), start.alias("first"), (start + F.col("o_orderkey") % 211).alias("last"))
    frames = events(spark, d).select("user_id", "event_id")
    return L.ranges_to_frames(ranges, "user_id", "first", "last", frames, "event_id", width=256).select("o_orderkey", "user_id", "event_id")


SAMPLE = 40
R.sql["t3_long_sample"] = f"""WITH {EV}, n AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY us, event_id) - 1 AS place, count(*) OVER (PARTITION BY user_id) AS n FROM ev),
i AS (SELECT user_id, n, unnest(range(0, {SAMPLE})) * n // {SAMPLE} AS place FROM (SELECT DISTINCT user_id, n FROM n WHERE n > {SAMPLE}))
SELECT user_id, event_id FROM n WHERE n <= {SAMPLE} OR (user_id, place) IN (SELECT (user_id, place) FROM i)"""


@R.query
def t3_long_sample(spark, d):
    return L.bounded_sample(events(spark, d), "user_id", ["us", "event_id"], SAMPLE).select("user_id", "event_id")
