"""Trees of any shape on the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.basic import micros
from ..operators import trees
from .tables import Registry, rounded, table

R = Registry()

R.sql["j14_tree_round_trip"] = """WITH o AS (SELECT o_orderkey AS k FROM orders)
SELECT k AS doc, 'parts[1].id' AS path, 'differs' AS kind FROM o WHERE k % 5 = 0 AND k % 17 > 0
UNION ALL SELECT k, 'head.total.priority', 'missing' FROM o WHERE k % 7 = 0 AND k % 17 > 0
UNION ALL SELECT k, 'head.numbers', CASE WHEN k % 11 = 0 THEN 'length' ELSE 'differs' END FROM o WHERE (k % 11 = 0 OR k % 13 = 0) AND k % 17 > 0
UNION ALL SELECT k, '', 'missing' FROM o WHERE k % 17 = 0"""


@R.query
def j14_tree_round_trip(spark, d):
    """Nested documents with lists, once written and once as they come back: rounded, with fields and elements lost."""
    k, price = F.col("o_orderkey"), F.col("o_totalprice").cast("double")
    orders = table(spark, d, "orders")

    def documents(numbers, priority, second, total, extra):
        head = F.struct(F.col("o_orderstatus").alias("status"), F.struct(total.alias("price"), priority.alias("priority")).alias("total"), numbers.alias("numbers"), F.lit("lost").alias("stamp"))
        parts = F.array(F.struct(k.alias("id"), F.lit("a").alias("name")), F.struct(second.alias("id"), F.lit("b").alias("name")))
        return k.alias("doc"), F.to_json(F.struct(head.alias("head"), parts.alias("parts"), extra.alias("only_there"))).alias("value")

    numbers = F.array(price, F.lit(0.5), F.lit(-2.25))
    first = orders.select(*documents(numbers, F.col("o_orderpriority"), k + 1, price, F.lit(None).cast("int")))
    back = F.transform(numbers, lambda v: v + F.when(k % 13 == 0, 1.0).otherwise(5e-6))
    back = F.when(k % 11 == 0, F.slice(back, 1, 2)).otherwise(back)
    second = orders.filter(k % 17 > 0).select(
        *documents(back, F.when(k % 7 > 0, F.col("o_orderpriority")), F.when(k % 5 == 0, k).otherwise(k + 1), price * (1 + 1e-7), F.lit(1))
    )
    second = second.withColumn("value", F.regexp_replace("value", '"stamp":"lost"', '"stamp":"other"'))
    return trees.tree_differences(first, second, "doc", "value", known_lossy=["head.stamp"])


R.sql["a15_stamps_at_any_depth"] = """SELECT event_id, round(greatest(0, CASE WHEN event_id % 2 = 0 THEN 7 END, CASE WHEN event_id % 5 = 0 THEN 31 END,
CASE WHEN event_id % 3 > 0 THEN event_id % 100 END) / 1000.0, 6)::DOUBLE AS worst_gap_ms FROM events"""


@R.query
def a15_stamps_at_any_depth(spark, d):
    """Stamps on top, under one and under three objects, each missing on some frames."""
    us = micros("ts")
    stamp = lambda x: F.struct(F.floor(x / 1_000_000).alias("sec"), (F.pmod(x, F.lit(1_000_000)) * 1000).alias("nsec"))
    some = lambda when, by: F.when(when, stamp(us + by))
    arm = F.struct(F.struct(some(F.col("event_id") % 3 > 0, F.col("event_id") % 100).alias("measured_js_stamp")).alias("measured_data"))
    jaw = F.struct(some(F.col("event_id") % 5 == 0, -31).alias("setpoint_stamp"), F.lit(1.5).alias("gap"))
    doc = F.struct(stamp(us).alias("image_left_stamp"), some(F.col("event_id") % 2 == 0, 7).alias("image_right_stamp"), jaw.alias("jaw"), F.struct(arm.alias("ECM")).alias("Kinematics_set_1"))
    documents = table(spark, d, "events").select("event_id", F.to_json(doc).alias("value"))
    return rounded(trees.worst_stamp_gap(documents, ["event_id"], "value", "image_left_stamp"))
