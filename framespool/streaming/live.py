"""The batch operators on live streams: each takes a streaming DataFrame and gives one.

Late data: rows older than the watermark are dropped by Spark and counted in its query progress. Windows and outer
rows come out once the watermark has passed them, so the last ones need a later row to close them."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def ingest(spark: SparkSession, path: str, schema: T.StructType, done: DataFrame | None = None, on: str | None = None, files_per_batch: int = 1000) -> DataFrame:
    """New parquet files under path, each once (the query's checkpoint remembers them); with done, only finished clips."""
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)
    return stream if done is None else stream.join(done, on, "left_semi")


#: Clips share a row of state, so Python is called as often as there are buckets, not clips. A checkpoint keeps its number.
BUCKETS = 512


def monitored(
    stream: DataFrame, key: str, time: str, ident: str, period: int, multiplier: float = 1.5, most: int = 127, late: str = "10 minutes", forget: int = 400 * 86_400_000_000, buckets: int = BUCKETS
) -> DataFrame:
    """(key, ident, contiguous, drops) of each frame against the one before it, with a period known beforehand; time in
    microseconds; key: text or a whole number. Frames may come in any order within the watermark: the state holds those that
    the watermark hasn't passed, and gives them in order of time once it has, so it is as large as the frames of `late`.
    Frames behind the watermark are left out. A clip is forgotten `forget` microseconds after its last frame.

    The state of a bucket of clips (by hash of the key) is the last stamp of each and the frames it holds, two tables in
    Arrow's stream format: Spark moves state between its JVM and Python value by value, so a list costs by its length."""
    out = T.StructType([T.StructField("_key", T.StringType()), stream.schema[ident], T.StructField("contiguous", T.BooleanType()), T.StructField("drops", T.IntegerType())])

    def packed(df) -> bytes:
        import pyarrow as pa

        rows, sink = pa.Table.from_pandas(df, preserve_index=False), pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, rows.schema) as stored:
            stored.write_table(rows)
        return sink.getvalue().to_pybytes()

    def follow(_: tuple, frames: Iterator, state) -> Iterator:
        import numpy as np
        import pandas as pd
        import pyarrow as pa

        known, *old = [pa.ipc.open_stream(x).read_pandas() for x in state.get] if state.exists else [pd.DataFrame({"_key": pd.Series(dtype=object), "_last": np.array([], np.int64)})]
        clips, lasts = known["_key"].to_numpy(object), known["_last"].to_numpy(np.int64)
        new = [] if state.hasTimedOut else [f[["_key", time, ident]] for f in frames]
        rows = pd.concat([x for x in old + new if len(x)] or (old + new)[:1], ignore_index=True)
        passed = state.getCurrentWatermarkMs() * 1000
        # clips as numbers, those known before first; null is a clip of its own
        codes, clips = pd.factorize(np.concatenate([clips, rows["_key"].to_numpy(object)]), use_na_sentinel=False)
        clips = np.where(pd.isna(clips), None, clips)
        seen = np.arange(len(clips)) < len(lasts)
        lasts = np.concatenate([lasts, np.zeros(len(clips) - len(lasts), np.int64)])
        rows["_clip"] = codes[len(codes) - len(rows) :]
        done = rows[time] <= passed
        held, rows = rows[~done], rows[done].sort_values(["_clip", time, ident])
        if len(rows):
            at, stamps = rows["_clip"].to_numpy(), rows[time].to_numpy(dtype=np.int64)
            starts = np.concatenate([[True], at[1:] != at[:-1]])
            before = np.where(starts, lasts[at], np.concatenate([stamps[:1], stamps[:-1]]))
            first = starts & ~seen[at]
            gaps = stamps - before
            ok = ~first & (gaps < multiplier * period) if period > 0 else ~first
            drops = np.where(first | (period <= 0), 0, np.clip(np.rint(gaps / max(period, 1)) - 1, 0, most)).astype(np.int32)
            ends = np.concatenate([starts[1:], [True]])
            lasts[at[ends]], seen[at[ends]] = stamps[ends], True
            yield pd.DataFrame({"_key": rows["_key"].to_numpy(object), ident: rows[ident].to_numpy(), "contiguous": ok, "drops": drops})
        waits = np.isin(np.arange(len(clips)), held["_clip"])
        stay = seen & (waits | (lasts + forget > passed))
        if not len(held) and not stay.any():
            state.remove()
            return
        state.update((packed(pd.DataFrame({"_key": clips[stay], "_last": lasts[stay]})), packed(held[["_key", time, ident]])))
        due = [int(held[time].min())] if len(held) else []
        due += [int(lasts[stay & ~waits].min()) + forget] if (stay & ~waits).any() else []
        state.setTimeoutTimestamp(max(-(-min(due) // 1000), state.getCurrentWatermarkMs() + 1))

    bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).alias("_bucket")
    clock = stream.select(bucket, F.col(key).cast("string").alias("_key"), time, ident, F.timestamp_micros(time).alias("_clock")).withWatermark("_clock", late)
    found = clock.groupBy("_bucket").applyInPandasWithState(follow, out, "clips binary, held binary", "append", "EventTimeTimeout")
    return found.select(F.col("_key").cast(stream.schema[key].dataType).alias(key), ident, "contiguous", "drops")


def sync_health(stream: DataFrame, time: str, topic: str, delta: str, tolerance: float, every: str = "1 minute", late: str = "10 minutes") -> DataFrame:
    """Per topic and window: samples, samples out of tolerance, mean and max of |delta|."""
    size = F.abs(delta)
    return (
        stream.withWatermark(time, late).groupBy(F.window(time, every), topic)
        .agg(F.count(size).alias("n"), F.count_if(size > tolerance).alias("n_out"), F.avg(size).alias("mean_delta"), F.max(size).alias("max_delta"))
        .select(F.col("window.start").alias("start"), topic, "n", "n_out", "mean_delta", "max_delta")
    )


def nearest_live(master: DataFrame, other: DataFrame, key: str, time: str, ident: str, tolerance: str, late: str = "1 hour", clock: str = "10 minutes", how: str = "inner") -> DataFrame:
    """Each master row with the nearest sample of the other stream within the tolerance (of two as near, the later).
    how: inner, or leftOuter to give masters without one too, with nulls, once the watermark has passed all samples that
    could match. An interval join on both watermarks, then the nearest of each master."""
    a = master.select(F.col(key).alias("k"), F.col(time).alias("t"), F.col(ident).alias("i")).withWatermark("t", late)
    b = other.select(F.col(key).alias("k2"), F.col(time).alias("u"), F.col(ident).alias("j")).withWatermark("u", late)
    near = F.expr(f"k = k2 AND u >= t - INTERVAL {tolerance} AND u <= t + INTERVAL {tolerance}")
    gap = F.unix_micros("u") - F.unix_micros("t")
    return (
        a.join(b, near, how).withColumn("gap", gap).groupBy(F.window("t", clock), "k", "i")
        .agg(F.min_by(F.struct("j", "gap"), F.struct(F.abs("gap"), -F.col("gap"), F.col("j"))).alias("best"))
        .select(F.col("k").alias(key), F.col("i").alias(ident), F.col("best.j").alias("match"), F.col("best.gap").alias("delta"))
    )


def run_once(stream: DataFrame, path: str, checkpoint: str, output: str = "append") -> None:
    """Runs a stream over what is there now and writes it as parquet."""
    query = stream.writeStream.outputMode(output).format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    if query.exception():
        raise query.exception()
