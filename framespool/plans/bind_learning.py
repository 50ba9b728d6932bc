"""A learning export on disk, made of the driver's events: a case for each tenth of the users, an episode for each event type."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..sources import learning as X
from ..sources import sinks as K
from .tables import Registry, rounded, table

R = Registry()
TYPES = "(SELECT event_type, row_number() OVER (ORDER BY event_type) - 1 AS type FROM (SELECT DISTINCT event_type FROM events))"
FRAMES = f"""f AS (SELECT user_id % 10 AS case_id, (user_id % 10) * 100 + type AS episode_id, event_id, epoch_us(ts) * 1000 AS ns FROM events JOIN {TYPES} t USING (event_type)),
x AS (SELECT *, first_value(CASE WHEN event_id % 13 > 0 THEN ns END) OVER w AS start FROM f WINDOW w AS (PARTITION BY case_id, episode_id ORDER BY event_id)),
y AS (SELECT case_id, episode_id, event_id, (ns - coalesce(start, 0)) / 1e9 AS seconds, row_number() OVER (PARTITION BY case_id, episode_id ORDER BY event_id) - 1 AS frame_index FROM x
WHERE event_id % 13 > 0)"""
R.sql["s14_export_on_disk"] = f"""WITH {FRAMES}, z AS (SELECT *, 'data/case-' || lpad(case_id::VARCHAR, 3, '0') || '/episode_' || lpad(episode_id::VARCHAR, 6, '0') || '.parquet' AS file FROM y)
SELECT file, count(*) AS length, max(frame_index)::INTEGER AS last, round(max(seconds), 3) AS span, sum(event_id)::BIGINT AS frames,
(SELECT count(DISTINCT file) FROM z)::BIGINT AS total_episodes FROM z GROUP BY file"""


def frames(spark, d):
    events = table(spark, d, "events")
    kinds = sorted(x[0] for x in events.select("event_type").distinct().collect())  # a fixed handful
    kind = F.array_position(F.array(*(F.lit(k) for k in kinds)), F.col("event_type")) - 1
    case = F.col("user_id") % 10
    stamp = F.when(F.col("event_id") % 13 > 0, F.unix_micros(F.col("ts").cast("timestamp")) * 1000)
    rows = events.select(case.alias("case_id"), (case * 100 + kind).alias("episode_id"), "event_id", stamp.alias("ns"), kind.cast("int").alias("task_index"), F.col("event_type").alias("task"))
    return X.learning_frames(rows, ["case_id", "episode_id"], "event_id", "ns")


def exported(spark, d):
    """All cases but one, then some of them again and the last, as a second run adds them."""
    root, rows = K.shared_path(spark, "export"), frames(spark, d)
    X.replace_cases(rows.filter("case_id < 9").withColumn("event_id", F.when(F.col("case_id") % 2 == 0, F.col("event_id")).otherwise(-1)), root, 30)
    X.replace_cases(rows.filter("case_id = 9 OR case_id % 2 = 1"), root, 30)
    return root


@R.query
def s14_export_on_disk(spark, d):
    """Frames without a stamp left out; files under their declared names; lists of what the export holds."""
    root = exported(spark, d)
    episodes, _ = X.read_lists(spark, root)
    found = X.read_export(spark, root).groupBy("file").agg(F.count("*").alias("n"), F.max("frame_index").alias("last"), F.max("timestamp").alias("span"), F.sum("event_id").alias("frames"))
    info = spark.read.json(f"{root}/meta/info.json").select("total_episodes")
    return rounded(episodes.join(found, "file").filter("length = n").crossJoin(F.broadcast(info)).select("file", "length", "last", "span", "frames", "total_episodes"), span=3)
