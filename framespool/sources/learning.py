"""Learning exports on disk: data/case-NNN/episode_NNNNNN.parquet with meta/{episodes,tasks}.jsonl and meta/info.json, and their
replacement case by case.

A commit stages whole case folders and the new lists under .staging/<id>, marks them READY, and only then puts them in
place. Before the mark a crash leaves the old export as it was; after it, recovered() finishes the work, and every reader and
writer calls it first. Each step may be done twice."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .release import export_metadata

STAGING, READY = ".staging", "READY"
LISTS = ("episodes.jsonl", "tasks.jsonl", "info.json")


def learning_frames(frames: DataFrame, by: list[str], order, stamp: str) -> DataFrame:
    """Frames with a stamp (ns), numbered anew from 0 as frame_index, and timestamp: seconds since the stamp of the episode's
    first frame; since 0 where that frame has none, as its document is missing."""
    w = Window.partitionBy(*by).orderBy(order)
    start = F.first(stamp).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    there = frames.withColumn("_start", F.coalesce(start, F.lit(0))).filter(F.col(stamp).isNotNull())
    return there.withColumn("frame_index", F.row_number().over(w) - 1).withColumn("timestamp", (F.col(stamp) - F.col("_start")) / 1e9).drop("_start", stamp)


class _Files:
    """The file system that holds a path, as Spark sees it."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm, self.root = spark.sparkContext._jvm, root
        top = self.path("")
        self.fs = top.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def names(self, name: str) -> list[str]:
        return sorted(x.getPath().getName() for x in self.fs.listStatus(self.path(name))) if self.exists(name) else []

    def exists(self, name: str) -> bool:
        return self.fs.exists(self.path(name))

    def move(self, old: str, new: str) -> None:
        self.fs.mkdirs(self.path(new).getParent())
        if not self.fs.rename(self.path(old), self.path(new)):
            raise OSError(f"can't move {old} to {new}")

    def delete(self, name: str) -> None:
        self.fs.delete(self.path(name), True)

    def mark(self, name: str) -> None:
        self.fs.create(self.path(name), False).close()


def recovered(spark: SparkSession, root: str) -> None:
    """Finishes commits that were marked READY, and deletes what was staged without a mark."""
    files = _Files(spark, root)
    for name in files.names(STAGING):
        at = f"{STAGING}/{name}"
        if files.exists(f"{at}/{READY}"):
            for case in files.names(f"{at}/data"):
                files.delete(f"data/{case}")
                files.move(f"{at}/data/{case}", f"data/{case}")
            for text in files.names(f"{at}/meta"):
                files.delete(f"meta/{text}")
                files.move(f"{at}/meta/{text}", f"meta/{text}")
        files.delete(at)


def read_lists(spark: SparkSession, root: str) -> tuple[DataFrame | None, DataFrame | None]:
    """episodes and tasks of an export; None where there are none yet."""
    recovered(spark, root)
    files = _Files(spark, root)
    kinds = {"episodes.jsonl": _EPISODES, "tasks.jsonl": "task_index int, task string"}
    return tuple(spark.read.schema(kind).json(f"{root}/meta/{name}") if files.exists(f"meta/{name}") else None for name, kind in kinds.items())


_EPISODES = "episode_chunk int, episode_index long, length long, tasks array<string>, file string, start double, end double"


def replace_cases(frames: DataFrame, root: str, fps: float) -> None:
    """Writes the cases of frames (case_id, episode_id, task_index, task, frame_index, timestamp and features): cases that the
    export has already are replaced whole, others are added and stay; a task is added if its index is new."""
    spark = frames.sparkSession
    episodes, tasks = read_lists(spark, root)
    files, at = _Files(spark, root), f"{STAGING}/{uuid.uuid4().hex}"
    # one task an episode, so one file
    frames.repartition("case_id", "episode_id").sortWithinPartitions("case_id", "episode_id", "frame_index").withColumns(
        {"_case": F.col("case_id"), "_episode": F.col("episode_id")}
    ).write.option("compression", "zstd").partitionBy("_case", "_episode").parquet(f"{root}/{at}/written")
    written = spark.read.parquet(f"{root}/{at}/written").drop("_case", "_episode")
    new, new_tasks, _ = export_metadata(written, fps)
    new = new.select(F.col("case_id").cast("int").alias("episode_chunk"), F.col("episode_id").cast("long").alias("episode_index"), "length", "tasks", "file", F.col("start").cast("double").alias("start"), F.col("end").cast("double").alias("end"))
    new_tasks = new_tasks.select(F.col("task_index").cast("int").alias("task_index"), "task")
    whole = new if episodes is None else episodes.join(new.select("episode_chunk").distinct(), "episode_chunk", "left_anti").select(*new.columns).unionByName(new)
    known = new_tasks if tasks is None else tasks.unionByName(new_tasks.join(tasks.select("task_index"), "task_index", "left_anti"))
    known = known.groupBy("task_index").agg(F.min("task").alias("task"))
    info = whole.agg(
        F.count("*").alias("total_episodes"), F.coalesce(F.sum("length"), F.lit(0)).alias("total_frames"), F.count_distinct("episode_chunk").alias("total_chunks"), F.lit(float(fps)).alias("fps")
    ).crossJoin(F.broadcast(known.agg(F.count("*").alias("total_tasks"))))  # one row each
    for name, df, order in (("episodes.jsonl", whole, ["episode_chunk", "episode_index"]), ("tasks.jsonl", known, ["task_index"]), ("info.json", info, ["total_episodes"])):
        # the format wants one file for each list, a line an episode
        df.select(*order, F.to_json(F.struct(*df.columns)).alias("value")).coalesce(1).sortWithinPartitions(*order).select("value").write.text(f"{root}/{at}/{name}")
        files.move(f"{at}/{name}/{next(x for x in files.names(f'{at}/{name}') if x.startswith('part-'))}", f"{at}/meta/{name}")
    for case in files.names(f"{at}/written"):
        for episode in files.names(f"{at}/written/{case}") if "=" in case else ():
            folder = f"{at}/written/{case}/{episode}"
            part = next(x for x in files.names(folder) if x.startswith("part-"))
            files.move(f"{folder}/{part}", f"{at}/data/{_named(case, episode)}")
    for name in ("written", *LISTS):
        files.delete(f"{at}/{name}")
    files.mark(f"{at}/{READY}")
    recovered(spark, root)


def _named(case: str, episode: str) -> str:
    """case-NNN/episode_NNNNNN.parquet."""
    return f"case-{int(case.partition('=')[2]):03d}/episode_{int(episode.partition('=')[2]):06d}.parquet"


def read_export(spark: SparkSession, root: str, cases: list[int] | None = None) -> DataFrame:
    """The frames of an export with the file that each is in; of these cases only, the others' folders aren't listed."""
    recovered(spark, root)
    some = "*" if cases is None else "{" + ",".join(f"case-{c:03d}" for c in cases) + "}"
    return spark.read.parquet(f"{root}/data/{some}/*.parquet").withColumn("file", _relative(F.col("_metadata.file_path")))


def _relative(path: Column) -> Column:
    return F.concat(F.lit("data/"), F.element_at(F.split(path, "/"), -2), F.lit("/"), F.element_at(F.split(path, "/"), -1))


