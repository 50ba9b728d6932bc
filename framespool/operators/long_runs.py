"""The window operators for episodes of any length: no episode is one task.

align and segment sort an episode in one task, which is right for the many of ordinary length. Here rows go to ranges of
(episode, order), so a long episode takes many tasks and short ones share one; windows run over a range's part of an
episode, and what goes on from part to part (a last stamp, a nearest sample, a number) is carried over a table with one row
for each part of an episode. Results equal those of the plain operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.basic import cols
from ..sources.sinks import kept



def laid_out(df: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """df with _part (the range that a row lies in) and _at (its place); written once, so that all uses agree."""
    keys = cols([*by, *order])
    placed = df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_at", F.monotonically_increasing_id())
    return kept(placed, "ranges").withColumn("_part", F.shiftright("_at", 33).cast("int"))


def carried(rows: DataFrame, by: list[str], **values: tuple[str, Column]) -> DataFrame:
    """rows with what the other parts of their episode hand over: name=("before", v) is the last v that isn't null in earlier
    parts, ("after", v) the first in later ones, ("sum", v) the sum of v over earlier ones.

    rows are dealt out by episode and part here, as the windows that follow want them."""
    each, onward = [], []
    parts = Window.partitionBy(*by).orderBy("_part")
    earlier, later = parts.rowsBetween(Window.unboundedPreceding, -1), parts.rowsBetween(1, Window.unboundedFollowing)
    for name, (how, value) in values.items():
        there = F.when(value.isNotNull(), F.col("_at"))
        if how == "sum":
            each.append(F.sum(value).alias(name))
            onward.append(F.coalesce(F.sum(name).over(earlier), F.lit(0)).alias(name))
        elif how == "before":
            each.append(F.max_by(value, there).alias(name))
            onward.append(F.last(name, ignorenulls=True).over(earlier).alias(name))
        else:
            each.append(F.min_by(value, there).alias(name))
            onward.append(F.first(name, ignorenulls=True).over(later).alias(name))
    edges = rows.groupBy(*by, "_part").agg(*each).select(*by, "_part", *onward)
    return rows.join(edges, [*by, "_part"])


def numbered(rows: DataFrame, by: list[str]) -> DataFrame:
    """rows, as laid_out() gives them, with _n (rows of their group) and _place (theirs in its order, from 0)."""
    sizes = rows.groupBy(*by, "_part").agg(F.min("_at").alias("_first"), F.count("*").alias("_here"))
    parts = Window.partitionBy(*by)
    before = F.sum("_here").over(parts.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    sizes = sizes.select(*by, "_part", (F.col("_first") - F.coalesce(before, F.lit(0))).alias("_zero"), F.sum("_here").over(parts).alias("_n"))
    return rows.join(sizes, [*by, "_part"]).withColumn("_place", F.col("_at") - F.col("_zero")).drop("_zero")


def medians(df: DataFrame, by: list[str], value: str, out: str) -> DataFrame:
    """by and the exact median of value (nulls don't count) of each group: values are numbered over ranges, the one or two in
    the middle averaged."""
    rows = numbered(laid_out(df.filter(F.col(value).isNotNull()).select(*by, value), by, [value]), by)
    middle = F.col("_place").between(F.expr("(_n - 1) div 2"), F.expr("_n div 2"))
    return rows.filter(middle).groupBy(*by).agg(F.avg(value).alias(out))


def bounded_sample(df: DataFrame, by, order, k: int) -> DataFrame:
    """As curate.bounded_sample: all rows of groups with k or fewer, of others those at floor(i * n / k), i = 0 .. k - 1."""
    by = _list(by)
    rows = numbered(laid_out(df, by, _list(order)), by)
    i = f"((_place * {k} + _n - 1) div _n)"
    kept_ = (F.col("_n") <= k) | F.expr(f"{i} < {k} AND ({i} * _n) div {k} = _place")
    return rows.filter(kept_).drop("_n", "_place", "_at", "_part")


def contiguity(df: DataFrame, by, order, time: str, multiplier: float = 1.5, most: int = 127) -> DataFrame:
    """As align.contiguity."""
    by, order = _list(by), _list(order)
    rows = carried(laid_out(df, by, order), by, _before=("before", F.col(time)))
    w = Window.partitionBy(*by, "_part").orderBy("_at")
    rows = kept(rows.withColumn("gap", F.col(time) - F.coalesce(F.lag(time).over(w), F.col("_before"))).drop("_before", "_at", "_part"), "gaps")
    rows = rows.join(medians(rows, by, "gap", "_median"), by, "left").withColumn("period", F.col("_median").cast("long")).drop("_median")
    flat = F.col("period") <= 0
    missed = F.greatest(F.lit(0), F.least(F.lit(most), F.rint(F.col("gap") / F.col("period")).cast("long") - 1))
    ok = F.when(F.col("gap").isNull(), False).when(flat, True).otherwise(F.col("gap") < multiplier * F.col("period"))
    return rows.withColumn("contiguous", ok).withColumn("drops", F.when(F.col("gap").isNull() | flat, F.lit(0)).otherwise(missed).cast("int"))


def nearest_match(master: DataFrame, other: DataFrame, by, time: str, ident: str, tolerance) -> DataFrame:
    """As align.nearest_match."""
    by = _list(by)
    side = lambda df, k: df.select(*by, F.col(time).alias("_t"), F.lit(k).alias("_side"), F.col(ident).alias("_id"))
    rows = laid_out(side(master, 0).unionByName(side(other, 1)), by, ["_t", "_side", "_id"])
    sample = F.when(F.col("_side") == 1, F.struct("_t", "_id"))
    rows = carried(rows, by, _former=("before", sample), _later=("after", sample))
    part = Window.partitionBy(*by, "_part")
    behind = F.last(sample, True).over(part.orderBy("_at").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ahead = F.last(sample, True).over(part.orderBy(F.desc("_at")).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    rows = rows.withColumn("_b", F.coalesce(behind, "_former")).withColumn("_a", F.coalesce(ahead, "_later")).filter("_side = 0")
    down, up = F.col("_t") - F.col("_b._t"), F.col("_a._t") - F.col("_t")
    pick = F.when(F.col("_b").isNull() | (up <= down), F.col("_a")).otherwise(F.col("_b"))
    found = rows.withColumn("_pick", pick).withColumn("_delta", F.col("_pick._t") - F.col("_t"))
    near = F.abs("_delta") <= tolerance
    return found.select(*by, F.col("_t").alias("time"), F.col("_id").alias("ident"), F.when(near, F.col("_pick._id")).alias("match"), F.when(near, F.col("_delta")).alias("delta"))


def segments(df: DataFrame, by, frame: str, step: str, consecutive: bool = True, out: str = "segment") -> DataFrame:
    """As segment.segments: changes are found first, then numbered by the changes of earlier parts."""
    by = _list(by)
    now = F.struct(F.col(frame).alias("frame"), F.col(step).alias("step"))
    rows = carried(laid_out(df, by, [frame]), by, _before=("before", now))
    w = Window.partitionBy(*by, "_part").orderBy("_at")
    former = F.coalesce(F.lag(now).over(w), F.col("_before"))
    change = ~former["step"].eqNullSafe(F.col(step))
    if consecutive:
        change = change | (F.col(frame) - former["frame"] != 1)
    rows = rows.withColumn("_change", F.when(former.isNull(), 0).when(change, 1).otherwise(0)).drop("_before")
    rows = carried(rows, by, _earlier=("sum", F.col("_change")))
    running = F.sum("_change").over(w.rowsBetween(Window.unboundedPreceding, 0))
    return rows.withColumn(out, (F.col("_earlier") + running).cast("int")).drop("_change", "_earlier", "_at", "_part")


def ranges_to_frames(ranges: DataFrame, by, start: str, end: str, frames: DataFrame, frame: str, width: int = 4096) -> DataFrame:
    """As align.ranges_to_frames, for ranges of any length: ranges and frames meet in bins of `width` frames, so a range is a
    row for each bin that it touches instead of one for each frame. A range that ends before it starts raises."""
    by = _list(by)
    checked = F.when(F.col(end) < F.col(start), F.raise_error(F.concat(F.lit("bad range "), F.col(start), F.lit("-"), F.col(end)))).otherwise(
        F.sequence(F.floor(F.col(start) / width), F.floor(F.col(end) / width))
    )
    binned = ranges.withColumn("_bin", F.explode(checked))
    met = binned.join(frames.withColumn("_bin", F.floor(F.col(frame) / width)), [*by, "_bin"])
    return met.filter(F.col(frame).between(F.col(start), F.col(end))).drop("_bin")


def _list(names) -> list[str]:
    return [names] if isinstance(names, str) else list(names)
