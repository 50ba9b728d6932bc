"""Cutting clips into learning episodes, numbering them, and their statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.basic import col, cols
from ..sources.sinks import kept


def segments(df: DataFrame, by, frame, step, consecutive: bool = True, out: str = "segment") -> DataFrame:
    """Gaps and islands: within an episode a new segment starts where the step changes (null is a value) or frames are
    not consecutive. Numbered from 0."""
    w = Window.partitionBy(*cols(by)).orderBy(col(frame))
    change = ~F.lag(col(step)).over(w).eqNullSafe(col(step))
    if consecutive:
        change = change | (col(frame) - F.lag(col(frame)).over(w) != 1)
    first = F.row_number().over(w) == 1
    return df.withColumn(out, F.sum(F.when(first, 0).when(change, 1).otherwise(0)).over(w.rowsBetween(Window.unboundedPreceding, 0)).cast("int"))


def within_segment(df: DataFrame, by, order, time, index: str = "frame_index", relative: str = "timestamp") -> DataFrame:
    """Frame number in the segment and time since its first frame."""
    w = Window.partitionBy(*cols(by)).orderBy(*cols(order))
    return df.withColumn(index, F.row_number().over(w) - 1).withColumn(relative, col(time) - F.first(col(time)).over(w))


def number_episodes(segments_: DataFrame, case: str, order, existing: DataFrame | None = None, start: int = 0, per_case: int = 100) -> DataFrame:
    """case_index (start, or one more than the largest existing) and episode_id = per_case * case_index + local number.
    More than per_case segments in a case raise: their ids would run into the next case's.

    Cases are numbered without a window over all of them: counts per range partition give each its offset."""
    cases = ranked(segments_.select(case).distinct(), [case], "_n")
    if existing is not None:
        cases = cases.crossJoin(F.broadcast(existing.agg((F.coalesce(F.max("case_index"), F.lit(start - 1)) + 1).alias("_start"))))  # one row
    else:
        cases = cases.withColumn("_start", F.lit(start))
    cases = cases.select(case, (F.col("_n") + F.col("_start")).cast("int").alias("case_index"))
    local = F.row_number().over(Window.partitionBy(case).orderBy(*cols(order))) - 1
    numbered = segments_.withColumn("_local", local).join(cases, case)
    full = F.when(F.col("_local") >= per_case, F.raise_error(F.concat(F.lit("too many segments in case "), F.col(case).cast("string"))))
    return numbered.withColumn("episode_id", F.coalesce(full.cast("int"), F.col("case_index") * per_case + F.col("_local")).cast("int")).drop("_local")


def ranked(df: DataFrame, order, out: str = "rank", parts: int | None = None) -> DataFrame:
    """Rows numbered from 0 in a total order: a range repartition, each row's place in its partition, and the offset of the
    partition, instead of one window over all rows.

    Places are written once to the shared folder and read from there for both the rows and the offsets: planned twice, the
    ranges could come out differently."""
    keys = cols(order)
    spread = df.repartitionByRange(*([parts] if parts else []), *keys).sortWithinPartitions(*keys)
    placed = kept(spread.withColumn("_at", F.monotonically_increasing_id()), "ranked")  # partition << 33 | place in it
    placed = placed.withColumn("_part", F.shiftright("_at", 33))
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_size"))
    before = F.sum("_size").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))  # one row a partition
    offsets = sizes.select("_part", (F.coalesce(before, F.lit(0)) - F.col("_part") * (1 << 33)).alias("_offset"))
    return placed.join(F.broadcast(offsets), "_part").withColumn(out, F.col("_offset") + F.col("_at")).drop("_part", "_at", "_offset")


def duration_statistics(df: DataFrame, by: str, value, kind: str) -> DataFrame:
    """min, max, mean, population std and number per case or phase; kind names which."""
    v = col(value)
    return df.groupBy(col(by).cast("string").alias("name")).agg(
        F.lit(kind).alias("kind"), F.min(v).alias("min_value"), F.max(v).alias("max_value"), F.avg(v).alias("mean_value"), F.stddev_pop(v).alias("std_value"), F.count(v).alias("n")
    )


def time_totals(episodes: DataFrame, group: str, case: str, episode, frames, seconds) -> DataFrame:
    """Episodes, frames and seconds by case, by group and overall; the group of a case is that of its first episode."""
    own = episodes.groupBy(case).agg(F.min_by(group, col(episode)).alias("_group"), F.count("*").alias("_n"), F.sum(col(frames)).alias("_f"), F.sum(col(seconds)).alias("_s"))
    return own.rollup(F.col("_group").alias(group), case).agg(F.sum("_n").alias("episodes"), F.sum("_f").alias("frames"), F.sum("_s").alias("seconds"))


def feature_statistics(df: DataFrame, by, arrays: list[str] = (), scalars: list[str] = (), exclude: str | None = None) -> DataFrame:
    """min, max, mean, population std and count per feature and episode; arrays per position (name[k]); features whose
    name matches exclude are left out."""
    import re

    names = lambda xs: [c for c in xs if not (exclude and re.search(exclude, c))]
    by = [by] if isinstance(by, str) else list(by)
    parts = []
    for c in names(arrays):
        part = df.select(*by, F.posexplode(c).alias("_p", "_v"))
        parts.append(part.select(*by, F.concat(F.lit(f"{c}["), "_p", F.lit("]")).alias("feature"), F.col("_v").cast("double").alias("_v")))
    if names(scalars):
        stack = ", ".join(f"'{c}', cast(`{c}` as double)" for c in names(scalars))
        parts.append(df.select(*by, F.expr(f"stack({len(names(scalars))}, {stack}) as (feature, _v)")))
    long = parts[0]
    for p in parts[1:]:
        long = long.unionByName(p)
    return long.groupBy(*by, "feature").agg(
        F.min("_v").alias("min_value"), F.max("_v").alias("max_value"), F.avg("_v").alias("mean_value"), F.stddev_pop("_v").alias("std_value"), F.count("_v").alias("n")
    )


def worst(df: DataFrame, order, k: int, by=None) -> DataFrame:
    """The k first rows in the order, overall or of each group."""
    if by is None:
        return df.orderBy(*cols(order)).limit(k)
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*cols(by)).orderBy(*cols(order)))).filter(F.col("rank") <= k)
