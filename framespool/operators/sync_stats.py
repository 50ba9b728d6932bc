"""Latency and timing statistics, all as partial and final aggregation over a long table (episode, topic, frame, delta)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.basic import col, cols


def _middle(c: Column, approximate: bool) -> Column:
    return F.percentile_approx(c, 0.5, 10_000) if approximate else F.percentile(c, F.lit(0.5))


def topic_latency(deltas: DataFrame, by, topic: str, frame, delta, topics: DataFrame | None = None, per_ms: float = 1e3, approximate: bool = False) -> DataFrame:
    """median, mean, population std and max of |delta| in ms, the frame of the first maximum and the number present.
    topics: the catalogue; with it, topics without any sample show with a count of 0 and nulls."""
    size = F.abs(col(delta))
    out = deltas.groupBy(*cols(by), topic).agg(
        (_middle(size, approximate) / per_ms).alias("median_ms"), (F.avg(size) / per_ms).alias("mean_ms"), (F.stddev_pop(size) / per_ms).alias("std_ms"),
        (F.max(size) / per_ms).alias("max_ms"), F.min_by(col(frame), F.when(size.isNotNull(), F.struct(-size, col(frame)))).alias("max_frame"), F.count(size).alias("n_present"),
    )
    if topics is None:
        return out
    names = [by] if isinstance(by, str) else list(by)
    spine = deltas.select(*names).distinct().crossJoin(F.broadcast(topics.select(topic)))  # topics: a catalogue of fixed size
    return spine.join(out, [*names, topic], "left").withColumn("n_present", F.coalesce("n_present", F.lit(0).cast("long")))


def pooled_latency(deltas: DataFrame, by, delta, some: Column, per_ms: float = 1e3, approximate: bool = False) -> DataFrame:
    """Median and max of the pooled |delta| of some topics, and median, mean, std and max of all."""
    size = F.abs(col(delta))
    part = F.when(some, size)
    return deltas.groupBy(*cols(by)).agg(
        (_middle(part, approximate) / per_ms).alias("some_median_ms"), (F.max(part) / per_ms).alias("some_max_ms"), (_middle(size, approximate) / per_ms).alias("all_median_ms"),
        (F.avg(size) / per_ms).alias("all_mean_ms"), (F.stddev_pop(size) / per_ms).alias("all_std_ms"), (F.max(size) / per_ms).alias("all_max_ms"),
    )


def out_of_tolerance(deltas: DataFrame, topic: str, delta, tolerances: DataFrame) -> DataFrame:
    """Per topic the number of samples, and of those with |delta| over the topic's tolerance. Nothing is removed.
    tolerances: (topic, tolerance), a catalogue of fixed size."""
    return deltas.join(F.broadcast(tolerances), topic).groupBy(topic).agg(
        F.count(col(delta)).alias("n_present"), F.count_if(F.abs(col(delta)) > F.col("tolerance")).alias("n_out")
    )


def worst_gap(stamps: list[Column], base: Column, per_ms: float = 1.0) -> Column:
    """The largest |stamp - base| of a frame; null stamps don't count, none at all gives null."""
    return F.array_max(F.array(*(F.abs(s - base) for s in stamps))) / per_ms


def summary(df: DataFrame, value, places: int = 6) -> DataFrame:
    """min, max, mean, population std and number over all rows, in one aggregation."""
    v = col(value)
    return df.agg(
        F.round(F.min(v), places).alias("min_value"), F.round(F.max(v), places).alias("max_value"), F.round(F.avg(v), places).alias("mean_value"),
        F.round(F.stddev_pop(v), places).alias("std_value"), F.count(v).alias("n"),
    )


def inspect_times(df: DataFrame, by, order, time, per_second: float = 1e6, near_zero_s: float = 1.0) -> DataFrame:
    """First and last stamp, span, mean, min, max and std of the gaps, rate, and whether the stamps start near zero."""
    gap = (col(time) - F.lag(col(time)).over(Window.partitionBy(*cols(by)).orderBy(*cols(order)))) / per_second
    t = col(time) / per_second
    return df.withColumn("_gap", gap).groupBy(*cols(by)).agg(
        F.min(t).alias("first_s"), F.max(t).alias("last_s"), (F.max(t) - F.min(t)).alias("span_s"), F.avg("_gap").alias("mean_gap_s"), F.min("_gap").alias("min_gap_s"),
        F.max("_gap").alias("max_gap_s"), F.stddev_pop("_gap").alias("std_gap_s"), F.try_divide(F.lit(1.0), F.avg("_gap")).alias("rate_hz"), (F.min(t) < near_zero_s).alias("near_zero"),
    )
