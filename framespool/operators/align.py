"""Putting sensors on one clock: frame numbers, gaps, nearest samples, joins on frames.

All windows are partitioned by the episode's key columns, so an episode is a sort group and the shuffle is on its key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.basic import col, cols


def number_frames(df: DataFrame, by, order, out: str = "frame_index") -> DataFrame:
    """Frames of each episode numbered from 0 in the given order."""
    return df.withColumn(out, F.row_number().over(Window.partitionBy(*cols(by)).orderBy(*cols(order))) - 1)


def drop_null_master(df: DataFrame, master) -> DataFrame:
    """Frames without a master stamp go; order stays a matter of the windows."""
    return df.filter(col(master).isNotNull())


def rebase(df: DataFrame, by, order, time, start: str = "t0", out: str = "rel") -> DataFrame:
    """Time since the first stamp of the episode in frame order; start keeps that stamp, so start + rel is the inverse."""
    first = F.first(col(time)).over(Window.partitionBy(*cols(by)).orderBy(*cols(order)).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return df.withColumn(start, first).withColumn(out, col(time) - F.col(start))


def contiguity(df: DataFrame, by, order, time, multiplier: float = 1.5, most: int = 127) -> DataFrame:
    """contiguous and drops of each frame against the one before, by the episode's median gap.

    The first frame is not contiguous. A median gap of zero or less makes all others contiguous without drops."""
    w = Window.partitionBy(*cols(by)).orderBy(*cols(order))
    gap = df.withColumn("gap", col(time) - F.lag(col(time)).over(w))
    gap = gap.withColumn("period", F.expr("percentile(gap, 0.5)").over(Window.partitionBy(*cols(by))).cast("long"))
    flat = F.col("period") <= 0
    missed = F.greatest(F.lit(0), F.least(F.lit(most), F.rint(F.col("gap") / F.col("period")).cast("long") - 1))
    return gap.withColumn(
        "contiguous", F.when(F.col("gap").isNull(), False).when(flat, True).otherwise(F.col("gap") < multiplier * F.col("period"))
    ).withColumn("drops", F.when(F.col("gap").isNull() | flat, F.lit(0)).otherwise(missed).cast("int"))


def episode_summary(frames: DataFrame, by, time, per_second: float = 1e6) -> DataFrame:
    """Frames, seconds, dropped frames and share of contiguous frames (1.0 for a single frame) of each episode.
    frames: as contiguity() gives them."""
    later = F.col("gap").isNotNull()
    return frames.groupBy(*cols(by)).agg(
        F.count("*").alias("n_frames"), ((F.max(col(time)) - F.min(col(time))) / per_second).alias("duration_s"),
        F.sum(F.col("drops").cast("long")).alias("frames_dropped"),
        F.coalesce(F.avg(F.when(later, F.col("contiguous").cast("double"))), F.lit(1.0)).alias("contiguity_ratio"),
    )


def gap_to_next(df: DataFrame, by, order, time, out: str = "gap_ms", per_ms: float = 1e3) -> DataFrame:
    """Milliseconds to the next frame, 0.0 on the last."""
    ahead = F.lead(col(time)).over(Window.partitionBy(*cols(by)).orderBy(*cols(order)))
    return df.withColumn(out, F.coalesce((ahead - col(time)) / per_ms, F.lit(0.0)))


def display_time(df: DataFrame, by, order, time, fps: float = 30.0, per_second: float = 1e6, out: str = "shown_s") -> DataFrame:
    """Seconds that each frame is shown: the gap before it, 1 µs at least; the first takes the second's, an only frame 1/fps."""
    w = Window.partitionBy(*cols(by)).orderBy(*cols(order))
    before = F.greatest((col(time) - F.lag(col(time)).over(w)) / per_second, F.lit(1e-6))
    ahead = F.greatest((F.lead(col(time)).over(w) - col(time)) / per_second, F.lit(1e-6))
    return df.withColumn(out, F.when(F.row_number().over(w) > 1, before).otherwise(F.coalesce(ahead, F.lit(1.0 / fps))))


def frame_pairs(df: DataFrame, by, order, frame, out: str = "next_frame") -> DataFrame:
    """(frame, next frame) of each episode; a single frame gives none."""
    return df.withColumn(out, F.lead(col(frame)).over(Window.partitionBy(*cols(by)).orderBy(*cols(order)))).filter(F.col(out).isNotNull())


def nearest_match(master: DataFrame, other: DataFrame, by, time, ident, tolerance, keep=()) -> DataFrame:
    """Each master row with the nearest sample of the other stream at `tolerance` or less: match (its ident) and
    delta = sample - master, nulls where there is none. Of two as near, the later wins; of samples at one time, the
    lowest ident ahead and the highest behind.

    One union and two running windows over the episode: a sort for each direction, no join on inequalities."""
    by, keep = [by] if isinstance(by, str) else list(by), list(keep)
    none = F.lit(None)
    t, i = col(time).alias("_t"), col(ident)
    sides = master.select(*by, t, F.lit(0).alias("_side"), i.alias("_id"), *keep).unionByName(
        other.select(*by, t, F.lit(1).alias("_side"), i.alias("_id"), *(none.cast(master.schema[k].dataType).alias(k) for k in keep))
    )
    sample = F.when(F.col("_side") == 1, F.struct("_t", "_id"))
    behind = Window.partitionBy(*by).orderBy("_t", "_side", "_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ahead = Window.partitionBy(*by).orderBy(F.desc("_t"), F.desc("_side"), F.desc("_id")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    both = sides.withColumn("_b", F.last(sample, True).over(behind)).withColumn("_a", F.last(sample, True).over(ahead)).filter("_side = 0")
    down, up = F.col("_t") - F.col("_b._t"), F.col("_a._t") - F.col("_t")
    pick = F.when(F.col("_b").isNull() | (up <= down), F.col("_a")).otherwise(F.col("_b"))
    found = both.withColumn("_pick", pick).withColumn("_delta", F.col("_pick._t") - F.col("_t"))
    near = F.abs("_delta") <= tolerance
    return found.select(*by, F.col("_t").alias("time"), F.col("_id").alias("ident"), *keep, F.when(near, F.col("_pick._id")).alias("match"), F.when(near, F.col("_delta")).alias("delta"))


def window_match(reference: DataFrame, search: DataFrame, by, frame, time, radius: int, per_ms: float = 1e3) -> DataFrame:
    """For each reference frame k the frame of the other camera within k - radius .. k + radius with the least time
    difference, then the least frame distance, then the earlier; where the window is empty, the frame nearest to k
    clamped to the last one. difference_ms is rounded to 6 places.

    The window is exploded into frame numbers (2 * radius + 1 rows a frame) for an equi-join."""
    by = [by] if isinstance(by, str) else list(by)
    ref = reference.select(*by, col(frame).alias("k"), col(time).alias("t"))
    other = search.select(*by, col(frame).alias("f"), col(time).alias("u"))
    near = ref.withColumn("f", F.explode(F.sequence(F.greatest(F.col("k") - radius, F.lit(0)), F.col("k") + radius))).join(other, [*by, "f"])
    order = F.struct(F.abs(F.col("t") - F.col("u")), F.abs(F.col("f") - F.col("k")), F.col("f"))
    best = near.groupBy(*by, "k", "t").agg(F.min_by(F.struct("f", "u"), order).alias("best"))
    # frames whose window is empty: the nearest frame to the clamped one, by the same union and windows as nearest_match
    last = other.groupBy(*by).agg(F.max("f").alias("top"))
    missing = ref.join(best.select(*by, "k"), [*by, "k"], "left_anti").join(last, by)
    # (numbers negated, because of two as near the earlier counts here)
    back = nearest_match(
        missing.withColumn("_clamped", -F.least("k", "top")).withColumn("_key", F.col("k")), other.withColumn("_key", F.col("f")).withColumn("_clamped", -F.col("f")),
        by, "_clamped", "_key", 1 << 40, keep=("t",),
    )
    rest = back.select(*by, F.col("ident").alias("k"), "t", F.col("match").alias("f")).join(other, [*by, "f"]).select(*by, "k", "t", F.struct("f", "u").alias("best"))
    return best.unionByName(rest).select(
        *by, "k", F.col("best.f").alias("match"), F.round(F.abs(F.col("t") - F.col("best.u")) / per_ms, 6).alias("difference_ms")
    )


def aligned(master: DataFrame, others: dict[str, DataFrame], on, columns: dict[str, list[str]]) -> DataFrame:
    """Master frames with the columns of the other tables at the same key (prefixed by the table's name), nulls where
    there is none. All joins are on the same key, so the master shuffles once."""
    on = [on] if isinstance(on, str) else list(on)
    out = master
    for name, other in others.items():
        out = out.join(other.select(*on, *(F.col(c).alias(f"{name}_{c}") for c in columns[name])), on, "left")
    return out


def checked_join(left: DataFrame, right: DataFrame, key, group: str) -> DataFrame:
    """Rows of both tables by key, for groups where each key is on both sides; other groups are left out."""
    both = left.withColumn("_l", F.lit(1)).join(right.withColumn("_r", F.lit(1)), key, "full")
    good = both.groupBy(group).agg(F.bool_and(F.col("_l").isNotNull() & F.col("_r").isNotNull()).alias("ok")).filter("ok").select(group)
    return both.join(good, group, "left_semi").drop("_l", "_r")


def on_master(master: DataFrame, sparse: DataFrame, on, columns: list[str]) -> DataFrame:
    """Sparse rows laid on the master's; any_set says for each row of the result whether the table has any at all."""
    laid = master.join(sparse.select(on, *columns), on, "left")
    any_ = laid.agg(F.max(F.greatest(*(F.col(c).isNotNull() for c in columns)) if len(columns) > 1 else F.col(columns[0]).isNotNull()).alias("any_set"))
    return laid.crossJoin(F.broadcast(any_))  # one row


def enriched(frames: DataFrame, per_frame: DataFrame, constants: DataFrame, frame_key: str, constant_key: str) -> DataFrame:
    """Frames with the per-frame row of the same key and the constants of the same unit."""
    return frames.join(per_frame, frame_key).join(constants, constant_key)


def ranges_to_frames(ranges: DataFrame, by, start: str, end: str, frames: DataFrame, frame: str, most: int = 1 << 20) -> DataFrame:
    """Frames inside inclusive ranges, once for each range; a range that ends before it starts or is longer than `most`
    raises."""
    by = [by] if isinstance(by, str) else list(by)
    bad = (F.col(end) < F.col(start)) | (F.col(end) - F.col(start) >= most)
    checked = F.when(bad, F.raise_error(F.concat(F.lit("bad range "), F.col(start), F.lit("-"), F.col(end)))).otherwise(F.sequence(F.col(start), F.col(end)))
    return ranges.withColumn(frame, F.explode(checked)).join(frames, [*by, frame])


def completed(spine_of: DataFrame, by, length: Column, frames: DataFrame, frame: str, fill: dict[str, Column]) -> DataFrame:
    """Every episode's frames 0 .. length - 1; missing ones hold the fillers, and is_real says which are not missing."""
    by = [by] if isinstance(by, str) else list(by)
    spine = spine_of.select(*by, F.explode(F.sequence(F.lit(0).cast("long"), length - 1)).alias(frame))
    out = spine.join(frames.withColumn("_real", F.lit(True)), [*by, frame], "left").withColumn("is_real", F.coalesce("_real", F.lit(False))).drop("_real")
    return out.withColumns({c: F.coalesce(c, v) for c, v in fill.items()})


def with_case_id(parts: list[Column], out: str = "episode_id") -> Column:
    """<dataset>_<clip>_<t0>."""
    return F.concat_ws("_", *parts).alias(out)


def source_parts(episode_id: Column) -> Column:
    """(dataset, clip) of <dataset>_<clip>_<t0>; anything but three parts raises."""
    parts = F.split(episode_id, "_")
    return F.when(F.size(parts) != 3, F.raise_error(F.concat(F.lit("not an episode id: "), episode_id))).otherwise(F.slice(parts, 1, 2))
