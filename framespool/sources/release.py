"""Packed releases: the five frame tables of completed episodes, opened lazily, and their sinks.

A release is a folder with one table per modality, partitioned by dataset and task and in order of episode and frame, and a
table `completed` of finished episodes. Files hold ranges of frames, so their number follows the frames, not the episodes.
open_release() also reads a tree of <dataset>/episodes/<task>/<clip>/<modality>.parquet, as other
packers leave it; both give the same frame tables."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.catalog import TOPICS
from ..functions.normalize import projected
from .sinks import write_ranges

KEYS = ("dataset", "task", "episode_id")
INT, LONG, BYTE, FLAG, TEXT, REAL = T.IntegerType(), T.LongType(), T.ByteType(), T.BooleanType(), T.StringType(), T.FloatType()
LIST = T.ArrayType(REAL)

#: Columns of the five frame tables, in their order.
_TIMESTAMP = [
    ("frame_index", INT),
    ("source_frame_index", INT),
    ("master_timestamp_ns", LONG),
    *((f"delta_to_master.{topic}_ns", INT) for topic in TOPICS),
    ("is_contiguous_to_prev", FLAG),
    ("drop_count_since_prev", BYTE),
]
_ECM = [
    ("frame_index", INT),
    ("master_timestamp_ns", LONG),
    ("local_measured_cp.position", LIST),
    ("local_measured_cp.orientation", LIST),
    ("measured_cp.position", LIST),
    ("measured_cp.orientation", LIST),
    ("measured_cp.velocity", LIST),
    ("measured_cv.linear", LIST),
    ("measured_cv.angular", LIST),
    ("measured_js.position", LIST),
    ("measured_js.velocity", LIST),
    ("measured_js.effort", LIST),
    ("setpoint_js.position", LIST),
    ("setpoint_js.velocity", LIST),
    ("setpoint_js.effort", LIST),
]
_PSM = [
    ("frame_index", INT),
    ("master_timestamp_ns", LONG),
    ("local_measured_cp.position", LIST),
    ("local_measured_cp.orientation", LIST),
    ("measured_cp.position", LIST),
    ("measured_cp.orientation", LIST),
    ("measured_cp.velocity", LIST),
    ("measured_cv.linear", LIST),
    ("measured_cv.angular", LIST),
    ("measured_cp_calibrated.position", LIST),
    ("measured_cp_calibrated.orientation", LIST),
    ("measured_js.position", LIST),
    ("measured_js.velocity", LIST),
    ("measured_js.effort", LIST),
    ("setpoint_js.position", LIST),
    ("setpoint_js.velocity", LIST),
    ("setpoint_js.effort", LIST),
    ("setpoint_cp.position", LIST),
    ("setpoint_cp.orientation", LIST),
    ("setpoint_cp_calibrated.position", LIST),
    ("setpoint_cp_calibrated.orientation", LIST),
    ("jaw.measured_position", REAL),
    ("jaw.setpoint_position", REAL),
    ("source_frequency_hz", REAL),
]
_ANNOTATION = [
    ("frame_index", INT),
    ("master_timestamp_ns", LONG),
    ("contact.PSM1", BYTE),
    ("contact.PSM2", BYTE),
    ("gesture.PSM1", TEXT),
    ("gesture.PSM2", TEXT),
    ("phase", TEXT),
    ("step", TEXT),
]
_COLUMNS = {"timestamp": _TIMESTAMP, "ECM": _ECM, "PSM1": _PSM, "PSM2": _PSM, "annotation": _ANNOTATION}
SCHEMAS = {name: T.StructType([T.StructField(c, kind) for c, kind in columns]) for name, columns in _COLUMNS.items()}


def uneven_episodes(tables: dict[str, DataFrame], keys=KEYS) -> DataFrame:
    """(keys, modality) where a table's frames aren't those of the timestamp table: each frame_index once, none more or
    less. One aggregation over all tables; the sum of hashes tells sets of frames apart."""
    parts = [df.select(*keys, F.lit(name).alias("modality"), "frame_index") for name, df in tables.items()]
    long = parts[0]
    for p in parts[1:]:
        long = long.unionByName(p)
    one = long.groupBy(*keys, "modality").agg(F.count("*").alias("n"), F.sum(F.xxhash64("frame_index").cast("decimal(38,0)")).alias("h"))
    by = one.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("modality", F.struct("n", "h").alias("v")))).alias("at"))
    names = F.array(*(F.lit(n) for n in tables))
    odd = F.filter(names, lambda m: ~F.col("at")[m].eqNullSafe(F.col("at")["timestamp"]))
    return by.select(*keys, F.explode(odd).alias("modality"))


def write_release(tables: dict[str, DataFrame], path: str, completed: DataFrame | None = None, keys=KEYS) -> None:
    """Writes the five tables with their declared columns (missing ones are null), zstd, in order of episode and frame, with
    a folder for each value of the keys but the last, and the table of completed episodes; completed None: all in the
    timestamp table. Keys are written as text. Episodes whose tables have other frames than their
    timestamp table raise before anything is written."""
    whole = {}
    for name, schema in SCHEMAS.items():
        whole[name] = projected(tables[name], T.StructType([T.StructField(k, TEXT) for k in keys] + schema.fields))
    odd = uneven_episodes(whole, keys).first()
    if odd:
        raise ValueError(f"frames of {odd['modality']} aren't those of its timestamp table: {tuple(odd[k] for k in keys)}")
    for name, df in whole.items():
        write_ranges(df, f"{path}/{name}", list(keys[:-1]), [keys[-1], "frame_index"])
    (whole["timestamp"] if completed is None else completed).select(*keys).distinct().write.parquet(f"{path}/completed")


@dataclass(frozen=True)
class Release:
    """Frame tables by modality (lazy) and the completed episodes (dataset, task, episode_id) that count."""

    tables: dict[str, DataFrame]
    episodes: DataFrame
    equal: tuple[tuple[str, object], ...] = ()

    def filter(self, predicate: Column | None = None, ids: DataFrame | None = None, **equal) -> Release:
        """Fewer episodes: equalities (they prune partitions), ids (episode_id) and a predicate on the keys, all together."""
        episodes = self.episodes
        for c, v in equal.items():
            episodes = episodes.filter(F.col(c) == v)
        if ids is not None:
            episodes = episodes.join(ids.select("episode_id").distinct(), "episode_id", "left_semi").select(*KEYS)
        if predicate is not None:
            episodes = episodes.filter(predicate)
        return replace(self, episodes=episodes, equal=self.equal + tuple(equal.items()))

    def frames(self, modality: str) -> DataFrame:
        """The frames of a modality of the episodes that count."""
        if modality not in self.tables:
            raise KeyError(f"no modality {modality}")
        df = self.tables[modality]
        for c, v in self.equal:
            df = df.filter(F.col(c) == v)
        return df.join(self.episodes, list(KEYS), "left_semi")

    def arm(self, name: str) -> DataFrame:
        if name not in ("ECM", "PSM1", "PSM2"):
            raise KeyError(f"no arm {name}")
        return self.frames(name)

    def column(self, modality: str, name: str) -> DataFrame:
        """(keys, frame_index, name): only that column is read."""
        return self.frames(modality).select(*KEYS, "frame_index", F.col(f"`{name}`"))

    def tasks(self) -> DataFrame:
        return self.episodes.select("task").distinct()


def open_release(spark: SparkSession, path: str, marker: str | None = None) -> Release:
    """A release that write_release() left at path. With marker, a tree <dataset>/episodes/<task>/<clip>/ whose completed
    clips hold a file of that name (a glob). Markers are listed by name, as Spark lists its input files: its readers don't
    see those with a leading dot."""
    if marker is None:
        # declared, not inferred: a dataset 01 stays 01
        own = [T.StructField(k, TEXT) for k in KEYS]
        tables = {name: spark.read.schema(T.StructType(own + schema.fields)).parquet(f"{path}/{name}") for name, schema in SCHEMAS.items()}
        return Release(tables, spark.read.schema(T.StructType(own)).parquet(f"{path}/completed"))
    glob = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/*/episodes/*/*/{marker}")
    found = glob.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(glob) or []
    markers = spark.createDataFrame([(x.getPath().toUri().getRawPath(),) for x in found], "path string")
    done = markers.select(*_tree_keys(F.col("path"))).distinct()
    tables = {name: spark.read.schema(schema).parquet(f"{path}/*/episodes/*/*/{name}.parquet").select(*_tree_keys(F.col("_metadata.file_path")), "*") for name, schema in SCHEMAS.items()}
    return Release(tables, done)


def _tree_keys(path: Column) -> list[Column]:
    parts = F.split(path, "/")
    at = lambda k: F.url_decode(F.get(parts, F.size(parts) - k))
    return [at(5).alias("dataset"), at(3).alias("task"), at(2).alias("episode_id")]


def vocabulary_lines(tasks: DataFrame, words: DataFrame) -> DataFrame:
    """One JSON text per task (task, instruction): its entries of words (task, family, id, text), by family and id."""
    entry = F.struct("family", "id", "text")
    by = words.groupBy("task").agg(F.sort_array(F.collect_list(entry)).alias("words"))
    df = tasks.join(by, "task", "left").select("task", "instruction", F.coalesce("words", F.array().cast("array<struct<family:string,id:string,text:string>>")).alias("words"))
    return df.select("task", F.to_json(F.struct("task", "instruction", "words")).alias("value"))


def export_names(case: Column, episode: Column) -> Column:
    """data/case-NNN/episode_NNNNNN of the learning format."""
    return F.format_string("data/case-%03d/episode_%06d", case.cast("int"), episode.cast("int"))


def export_metadata(frames: DataFrame, fps: float) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(episodes, tasks, info) of learning frames (case_id, episode_id, task_index, task, frame_index, timestamp): a row an
    episode with its length, its file and the span of time; a row a task; one row of totals."""
    episodes = frames.groupBy("case_id", "episode_id").agg(
        F.count("*").alias("length"), F.sort_array(F.collect_set("task")).alias("tasks"), F.min("timestamp").alias("start"), F.max("timestamp").alias("end")
    )
    episodes = episodes.withColumn("file", F.concat(export_names(F.col("case_id"), F.col("episode_id")), F.lit(".parquet")))
    tasks = frames.select("task_index", "task").distinct()
    info = episodes.agg(
        F.count("*").alias("total_episodes"), F.coalesce(F.sum("length"), F.lit(0)).alias("total_frames"), F.count_distinct("case_id").alias("total_chunks"), F.lit(float(fps)).alias("fps")
    )
    return episodes, tasks, info.crossJoin(F.broadcast(tasks.agg(F.count("*").alias("total_tasks"))))  # one row each
