"""Curation: parity and trimming of streams, majority choices, orderings, samples, path mappings, set updates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.basic import col, cols


def count_parity(counts: DataFrame, by, n, exempt: Column | None = None) -> DataFrame:
    """Each folder's count against the largest of its clip; exempt folders are always even."""
    most = F.max(col(n)).over(Window.partitionBy(*cols(by)))
    short = col(n) < most
    return counts.withColumn("most", most).withColumn("uneven", short & ~exempt if exempt is not None else short)


def trim_target(counts: DataFrame, by, n, only: Column | None = None) -> DataFrame:
    """The least count over the folders that aren't empty (of those that `only` names)."""
    used = col(n) > 0 if only is None else (col(n) > 0) & only
    return counts.groupBy(*cols(by)).agg(F.min(F.when(used, col(n))).alias("target"))


def trimmed(frames: DataFrame, by, index: str, target: str, mode: int) -> DataFrame:
    """The frames to remove so that `target` stay: mode -1 keeps the first indices below the target, 0 drops the
    lowest, k > 0 drops the first k and keeps the target that follow (more than there are raises). A dry run: nothing
    is deleted."""
    n = F.count("*").over(Window.partitionBy(*cols(by)))
    at = F.row_number().over(Window.partitionBy(*cols(by)).orderBy(index)) - 1
    df = frames.withColumn("_n", n).withColumn("_at", at)
    if mode == -1:
        gone = F.col("_at") >= F.col(target)
    elif mode == 0:
        gone = F.col("_at") < F.col("_n") - F.col(target)
    else:
        bad = F.raise_error(F.lit(f"cannot skip {mode} frames: too few are left"))
        gone = F.when(F.lit(mode) > F.col("_n") - F.col(target), bad.cast("boolean")).otherwise((F.col("_at") < mode) | (F.col("_at") >= F.col(target) + mode))
    return df.filter(gone).drop("_n", "_at")


def dominant(df: DataFrame, by, value, out: str = "task") -> DataFrame:
    """The most frequent non-null value of each group; of equally frequent ones the smallest; null where there is none."""
    counts = df.groupBy(*cols(by), col(value).alias("_v")).agg(F.count("*").alias("_n"))
    order = F.when(F.col("_v").isNotNull(), F.struct(-F.col("_n"), F.col("_v")))
    return counts.groupBy(*cols(by)).agg(F.min_by("_v", order).alias(out))


def natural_order(name: Column) -> list[Column]:
    """Whole-number names by value, others after them by text."""
    return [name.try_cast("bigint").asc_nulls_last(), name.asc()]


def bounded_sample(df: DataFrame, by, order, k: int) -> DataFrame:
    """All rows of groups with k or fewer; of others the rows at floor(i * n / k), i = 0 .. k - 1. No randomness."""
    w = Window.partitionBy(*cols(by))
    df = df.withColumn("_n", F.count("*").over(w)).withColumn("_at", (F.row_number().over(w.orderBy(*cols(order))) - 1).cast("long"))
    i = F.expr(f"(_at * {k} + _n - 1) div _n")
    kept = (F.col("_n") <= k) | ((i < k) & (F.expr(f"(((_at * {k} + _n - 1) div _n) * _n) div {k}") == F.col("_at")))
    return df.filter(kept).drop("_n", "_at")


def repeatable_sample(df: DataFrame, key, share: float = 0.01, salt: str = "") -> DataFrame:
    """About `share` of the rows, and the same ones every time: those whose hash of the key is low. Of rows with a key, that
    of least hash at least (all that have that key)."""
    key = col(key).cast("string")
    bucket = F.conv(F.substring(F.md5(F.concat(F.lit(salt), key)), 1, 8), 16, 10).cast("long")
    least = df.agg(F.min(F.struct(bucket.alias("bucket"), key.alias("key"))).alias("_least"))  # one row
    chosen = (bucket < int(share * (1 << 32))) | (F.struct(bucket.alias("bucket"), key.alias("key")) == F.col("_least"))
    return df.crossJoin(F.broadcast(least)).filter(chosen).drop("_least")


def reference_camera(counts: DataFrame, by, camera: str, n, preference: dict[str, int] | None = None) -> DataFrame:
    """The camera with the fewest frames; of equals the preferred, then the first by name."""
    rank = F.lit(0)
    for name, place in (preference or {}).items():
        rank = F.when(F.col(camera) == name, place).otherwise(rank)
    return counts.groupBy(*cols(by)).agg(F.min_by(camera, F.struct(col(n), rank, F.col(camera))).alias("reference"))


def remapped(paths: DataFrame, path: str, mapping: DataFrame, old: str, new: str, tail: Column, mapping_tail: Column, index: DataFrame | None = None) -> DataFrame:
    """Each path's new path: by the whole path, else by its tail, else by the index (path, new_path) if there is one, else
    null (matched_by says which). Of several targets the least counts."""
    exact = mapping.groupBy(F.col(old).alias(path)).agg(F.min(new).alias("_exact"))
    by_tail = mapping.groupBy(mapping_tail.alias("_tail")).agg(F.min(new).alias("_by_tail"))
    out = paths.withColumn("_tail", tail).join(exact, path, "left").join(by_tail, "_tail", "left")
    how = F.when(F.col("_exact").isNotNull(), "path").when(F.col("_by_tail").isNotNull(), "tail")
    found = F.coalesce("_exact", "_by_tail")
    if index is not None:
        out = out.join(index.groupBy(path).agg(F.min("new_path").alias("_indexed")), path, "left")
        how, found = how.when(F.col("_indexed").isNotNull(), "index"), F.coalesce("_exact", "_by_tail", "_indexed")
    return out.withColumn("new_path", found).withColumn("matched_by", how).drop("_tail", "_exact", "_by_tail", "_indexed")


def unmatched(mapped: DataFrame, path: str) -> DataFrame:
    """The paths that remapped() found no target for, once each."""
    return mapped.filter("new_path IS NULL").select(path).distinct()


def nearest_ancestor(paths: DataFrame, path: str, folders: DataFrame, folder: str, levels: int = 5) -> DataFrame:
    """The deepest of the path's ancestors, up to `levels` above it, that is among the folders; null where none is."""
    parts = F.split(F.col(path), "/")
    depths = F.filter(F.transform(F.sequence(F.lit(1), F.lit(levels)), lambda k: F.size(parts) - k), lambda n: n > 0)
    up = paths.select(path).distinct().select(path, F.explode_outer(depths).alias("_depth")).withColumn("_up", F.array_join(F.slice(parts, 1, F.col("_depth")), "/"))
    found = up.join(folders.select(F.col(folder).alias("_up"), F.lit(True).alias("_is")).distinct(), "_up", "left")
    return found.groupBy(path).agg(F.max_by("_up", F.when(F.col("_is"), F.col("_depth"))).alias("ancestor"))


def resolved_task(clips: DataFrame, key: str, overrides: DataFrame, inferred: str, default: str | None = None) -> DataFrame:
    """task: the operator's override, else the inferred, else the default; nothing at all raises."""
    out = clips.join(overrides.select(key, F.col("task").alias("_override")), key, "left")
    last = F.lit(default) if default is not None else F.raise_error(F.concat(F.lit("no task for "), F.col(key).cast("string"))).cast("string")
    return out.withColumn("task", F.coalesce("_override", inferred, last)).drop("_override")


def united(known: DataFrame, new: DataFrame) -> DataFrame:
    """What was known and what is new, once each; nothing known goes."""
    return known.unionByName(new).distinct()


def replaced(existing: DataFrame, new: DataFrame, case: str) -> DataFrame:
    """The rows of other cases and the new ones: new cases are added, cases that are in both are replaced."""
    return existing.join(new.select(case).distinct(), case, "left_anti").unionByName(new)


def backfilled(spine: DataFrame, labels: DataFrame, key: str, filled: dict[str, object], sparse: list[str], listed: str | None = None, order: str | None = None) -> DataFrame:
    """Every frame of the spine with its labels: `filled` columns default to their value, `sparse` stay null; of several
    labels on a frame the last by order counts, but those of `listed` become a sorted list."""
    last = lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), F.col(order or key))).alias(c)
    aggs = [last(c) for c in [*filled, *sparse]] + ([F.sort_array(F.collect_list(listed)).alias(listed)] if listed else [])
    out = spine.join(labels.groupBy(key).agg(*aggs), key, "left")
    return out.withColumns({c: F.coalesce(c, F.lit(v)) for c, v in filled.items()})
