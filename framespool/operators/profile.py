"""Profiles of columns and releases."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.basic import col


#: Of the approximate percentiles that bracket the exact ones: their accuracy, how far the bracket reaches to both sides,
#: and how many values a column needs for it (others are taken whole).
ACCURACY, REACH, FEW = 10_000, 5e-4, 20_000


def column_profile(df: DataFrame, columns: list[str], places: int = 6, approximate: bool = False) -> DataFrame:
    """One row per column (arrays: per position, c[k]): count, nulls, NaNs, min, max, mean, sample std (0 under two
    values), q01 and q99 of numbers and booleans; number of distinct values of strings.

    Numbers meet in one long table and one aggregation. Exact quantiles take a second pass: approximate ones bracket the
    ranks that are needed, what lies below the bracket is only counted, and the few values inside it are counted one by
    one, so no task holds a column."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    arrays = [c for c in columns if isinstance(kinds[c], T.ArrayType)]
    strings = [c for c in columns if isinstance(kinds[c], T.StringType)]
    scalars = [c for c in columns if c not in arrays and c not in strings]
    longs = [df.select(F.posexplode(c).alias("_p", "_v")).select(F.concat(F.lit(f"{c}["), "_p", F.lit("]")).alias("column_name"), F.col("_v").cast("double").alias("_v")) for c in arrays]
    if scalars:
        number = lambda c: f"cast({f'cast(`{c}` as int)' if isinstance(kinds[c], T.BooleanType) else f'`{c}`'} as double)"
        stack = ", ".join(f"'{c}', {number(c)}" for c in scalars)
        longs.append(df.select(F.expr(f"stack({len(scalars)}, {stack}) as (column_name, _v)")))
    parts = []
    if longs:
        long = reduce(DataFrame.unionByName, longs)
        real = F.when(~F.isnan("_v"), F.col("_v"))
        wanted = [x for q in (0.01, 0.99) for x in ((q,) if approximate else (q - REACH, q + REACH))]
        once = long.groupBy("column_name").agg(
            F.count(real).alias("n"), F.count_if(F.col("_v").isNull()).alias("null_count"), F.count_if(F.isnan("_v")).alias("nan_count"), F.min(real).alias("min_value"), F.max(real).alias("max_value"),
            F.round(F.avg(real), places).alias("mean_value"), F.round(F.when(F.count(real) < 2, 0.0).otherwise(F.stddev_samp(real)), places).alias("std_value"),
            F.percentile_approx(real, wanted, ACCURACY).alias("_near"),
        )
        if approximate:
            quantiles = once.withColumns({"q01": F.round(F.col("_near")[0], places), "q99": F.round(F.col("_near")[1], places)})
        else:
            quantiles = _exact_quantiles(long.withColumn("_v", real).filter("_v IS NOT NULL"), once, {"q01": 0.01, "q99": 0.99}, places)
        parts.append(quantiles.drop("_near").withColumn("vocab_size", F.lit(None).cast("long")))
    none = [F.lit(None).cast("double").alias(c) for c in ("min_value", "max_value", "mean_value", "std_value", "q01", "q99")]
    for c in strings:
        counted = df.agg(F.count(c).alias("n"), F.count_if(F.col(c).isNull()).alias("null_count"), F.count_distinct(c).alias("vocab_size"))
        parts.append(counted.select(F.lit(c).alias("column_name"), "n", "null_count", F.lit(0).cast("long").alias("nan_count"), *none, "vocab_size"))
    return reduce(DataFrame.unionByName, parts)


def _exact_quantiles(long: DataFrame, once: DataFrame, quantiles: dict[str, float], places: int) -> DataFrame:
    """once with the interpolated quantiles of long (column_name, _v); _near has the two ends of each one's bracket."""
    ends = []
    for k, (name, q) in enumerate(quantiles.items()):
        low = F.when(F.col("n") < FEW, F.col("min_value")).otherwise(F.col("_near")[2 * k])
        high = F.when(F.col("n") < FEW, F.col("max_value")).otherwise(F.col("_near")[2 * k + 1])
        ends.append(F.struct(F.lit(name).alias("name"), (q * (F.col("n") - 1)).alias("rank"), low.alias("low"), high.alias("high")))
    brackets = once.filter("n > 0").select("column_name", F.explode(F.array(*ends)).alias("b")).select("column_name", "b.*")  # two rows a column
    inside = long.join(F.broadcast(brackets), "column_name").filter("_v <= high")
    place = F.when(F.col("_v") >= F.col("low"), F.col("_v"))  # null: below the bracket
    counts = inside.groupBy("column_name", "name", "rank", place.alias("_v")).agg(F.count("*").alias("_n"))
    upto = F.sum("_n").over(Window.partitionBy("column_name", "name").orderBy(F.col("_v").asc_nulls_first()))
    counts = counts.withColumn("_upto", upto).filter("_v IS NOT NULL")
    at = lambda rank: F.min(F.when(F.col("_upto") > rank, F.col("_v")))
    picked = counts.groupBy("column_name", "name", "rank").agg(at(F.floor("rank")).alias("a"), at(F.ceil("rank")).alias("b"))
    value = F.round(F.col("a") + (F.col("b") - F.col("a")) * (F.col("rank") - F.floor("rank")), places)
    wide = picked.groupBy("column_name").agg(*(F.max(F.when(F.col("name") == name, value)).alias(name) for name in quantiles))
    return once.join(wide, "column_name", "left")


def coverage(df: DataFrame, by: str, columns: list[str], expected: list[str] | None = None) -> DataFrame:
    """Per group and expected column: present, populated rows, share at 4 places. A column that is null throughout or
    not there is absent. One pass counts all columns; stack() turns the counts into rows."""
    counted = df.groupBy(by).agg(F.count("*").alias("_rows"), *(F.count(c).alias(c) for c in columns))
    stack = ", ".join(f"'{c}', {f'`{c}`' if c in columns else '0L'}" for c in expected or columns)
    long = counted.select(by, "_rows", F.expr(f"stack({len(expected or columns)}, {stack}) as (topic, populated)"))
    return long.select(
        by, "topic", (F.col("populated") > 0).alias("present"), "populated", F.when(F.col("populated") > 0, F.round(F.col("populated") / F.col("_rows"), 4)).alias("coverage")
    )


def release_coverage(covered: DataFrame, topic: str = "topic") -> DataFrame:
    """How many groups have each topic, of how many."""
    return covered.groupBy(topic).agg(F.count_if("present").alias("n_present"), F.count("*").alias("n_total"), F.sum("populated").alias("populated"))


def inventory(episodes: DataFrame, task: str, dataset: str, frames) -> DataFrame:
    """Episodes, frames and sorted datasets per task, and of all (task null)."""
    return episodes.rollup(task).agg(
        F.count("*").alias("episodes"), F.sum(col(frames)).alias("frames"), F.array_join(F.sort_array(F.collect_set(col(dataset).cast("string"))), ",").alias("datasets")
    )


def size_breakdown(df: DataFrame, stream: str, items, seconds, rate, clip) -> DataFrame:
    """Per stream: items, seconds, clips, mean of the rates there are, and share of all items."""
    out = df.groupBy(stream).agg(F.sum(col(items)).alias("items"), F.sum(col(seconds)).alias("seconds"), F.count_distinct(col(clip)).alias("clips"), F.avg(col(rate)).alias("mean_rate"))
    total = F.sum("items").over(Window.partitionBy())  # one row a stream
    return out.withColumn("share", F.try_divide(F.col("items"), total))


def size_buckets(files: DataFrame, bucket: str, size) -> DataFrame:
    """Per bucket: files, bytes, and share of all bytes (null of nothing)."""
    out = files.groupBy(bucket).agg(F.count("*").alias("n_files"), F.coalesce(F.sum(col(size)), F.lit(0)).alias("bytes"))
    return out.withColumn("share", F.try_divide(F.col("bytes"), F.sum("bytes").over(Window.partitionBy())))  # one row a bucket


def size_ratio(packed: DataFrame, unpacked: DataFrame, size) -> DataFrame:
    """Bytes of both and unpacked / packed (null where nothing is packed)."""
    sums = packed.agg(F.coalesce(F.sum(col(size)), F.lit(0)).alias("packed")).crossJoin(F.broadcast(unpacked.agg(F.coalesce(F.sum(col(size)), F.lit(0)).alias("unpacked"))))  # one row each
    return sums.withColumn("ratio", F.try_divide(F.col("unpacked"), F.col("packed")))


def contacts_per_arm(labels: DataFrame, arms: dict[str, str]) -> DataFrame:
    """Per arm (a column of labels by the arm's name): labels that say contact (not null and not 0), and those that say
    anything. One pass; stack() turns the counts into rows."""
    counted = labels.agg(*(x for arm, c in arms.items() for x in (F.count_if(F.col(c).cast("int") != 0).alias(f"{arm}_on"), F.count(c).alias(f"{arm}_all"))))
    stack = ", ".join(f"'{arm}', `{arm}_on`, `{arm}_all`" for arm in arms)
    return counted.select(F.expr(f"stack({len(arms)}, {stack}) as (arm, n_contacts, n_labels)"))


def label_statistics(labels: DataFrame, frames: DataFrame, key: str, category) -> DataFrame:
    """Per category: labels and labelled frames; of all (category null): labels, labelled frames and progress in %."""
    total = frames.agg(F.count("*").alias("_frames"))  # one row
    out = labels.rollup(category).agg(F.count("*").alias("n_labels"), F.count_distinct(key).alias("n_frames"))
    return out.crossJoin(F.broadcast(total)).select(
        category, "n_labels", "n_frames", F.when(F.col(category).isNull(), F.round(F.try_divide(100.0 * F.col("n_frames"), F.col("_frames")), 4)).alias("progress")
    )


def totals(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows of each table, read from the file footers."""
    out = None
    for name, df in tables.items():
        part = df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        out = part if out is None else out.unionByName(part)
    return out
