"""Lookups in small vocabularies: routing, label texts, per-task projections. Vocabularies join by size as Spark sees it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def routed(df: DataFrame, task: str, routing: DataFrame, phase: str) -> DataFrame:
    """The phase of each task, null for unknown ones."""
    return df.join(routing.select(task, phase), task, "left")


def first_task(routing: DataFrame, task: str, phase: str, order: str) -> DataFrame:
    """The inverse: the first task of each phase."""
    return routing.groupBy(phase).agg(F.min_by(task, order).alias(task))


def verbalised(df: DataFrame, phase: str, ident: str, vocabulary: DataFrame, order: str, task_aware: bool = True, anywhere: bool = True) -> DataFrame:
    """text of a label id: that of the row's own phase, else of the first phase that holds the id (if `anywhere`), else
    the id itself. vocabulary: (phase, ident, text, order)."""
    first = vocabulary.groupBy(ident).agg(F.min_by("text", order).alias("_any"))
    own = vocabulary.groupBy(phase, ident).agg(F.min_by("text", order).alias("_own"))
    out = df.join(own, [phase, ident], "left") if task_aware else df.withColumn("_own", F.lit(None).cast("string"))
    out = out.join(first, ident, "left") if anywhere else out.withColumn("_any", F.lit(None).cast("string"))
    return out.withColumn("text", F.coalesce("_own", "_any", F.col(ident).cast("string"))).drop("_own", "_any")


def task_vocabulary(tasks: DataFrame, task: str, phase: str, vocabulary: DataFrame, ident: str, text: str) -> DataFrame:
    """One row per task with its phase's entries as a map; tasks whose phase has none are left out."""
    entries = vocabulary.groupBy(phase).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct(ident, text)))).alias("entries"))
    return tasks.join(entries, phase).select(task, phase, "entries")
