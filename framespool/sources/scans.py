"""Reading frame documents and packed releases. A document is a row (path, value); the dataset, clip and frame come from
its path, the frame as a number."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.catalog import MASTER, TOPICS, stamp_columns, stamp_tree

CP = "struct<position:array<double>,orientation:array<double>,velocity:array<double>>"
JS = "struct<position:array<double>,velocity:array<double>,effort:array<double>>"
JAW = "struct<measured_data:struct<position:array<double>>,setpoint_data:struct<position:array<double>>>"
ARM = (
    f"struct<arm:struct<measured_data:struct<local_measured_cp:{CP},measured_cp:{CP},measured_cv:struct<linear:array<double>,angular:array<double>>,measured_js:{JS}>,"
    f"setpoint_data:struct<setpoint_js:{JS},setpoint_cp:{CP}>,jaw:{JAW},measured_frequency:double>,jaw:{JAW},measured_frequency:double>"
)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """(path, value) of each file under a glob."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")


def read_tree(spark: SparkSession, root: str, folder: str, datasets: list[str] | None = None, clips: list[str] | None = None, frames: tuple[int, int] | None = None) -> DataFrame:
    """(path, value) of <root>/<dataset>/<clip>/<folder>/<frame>.json, of these datasets and clips and of frames first..last
    only. Other datasets and clips aren't even listed, and files of other frames are left out before any is opened.

    Small files are packed by size; for thousands a task lower spark.sql.files.openCostInBytes, as each counts as that much."""
    some = lambda names: "*" if names is None else "{" + ",".join(names) + "}"
    docs = spark.read.text(f"{root}/{some(datasets)}/{some(clips)}/{folder}/*.json", wholetext=True)
    if frames is not None:
        number = F.regexp_extract(F.col("_metadata.file_name"), r"^([0-9]+)", 1).try_cast("int")
        docs = docs.filter(number.between(*frames))
    return docs.select(F.col("_metadata.file_path").alias("path"), "value")


def keys_of(path: Column, depth: int = 1) -> list[Column]:
    """dataset, clip and frame of .../<dataset>/<clip>/<depth folders>/<frame>.json."""
    parts = F.split(path, "/")
    at = lambda k: F.get(parts, F.size(parts) - k)
    return [at(depth + 3).alias("dataset"), at(depth + 2).alias("clip"), F.regexp_extract(at(1), r"^(\d+)", 1).try_cast("int").alias("frame")]


def stamp_documents(documents: DataFrame, topics: dict[str, str] = TOPICS, master: tuple[str, str] = MASTER) -> DataFrame:
    """One row per time-stamp document: the master's and every topic's stamp in ns, null where its path is missing. A document
    is parsed once for all topics."""
    topics = dict([master]) | topics
    parsed = documents.select(*keys_of(F.col("path")), F.from_json("value", stamp_tree(topics)).alias("_stamps"))
    return parsed.select("dataset", "clip", "frame", *stamp_columns(F.col("_stamps"), topics))


def kinematic_documents(documents: DataFrame, strict: bool = False) -> DataFrame:
    """One row per arm and frame: joint and Cartesian fields, jaw and frequency from either place; corrupt says what is
    wrong with a document (unreadable, or an orientation without four values). strict: such a document raises instead."""
    doc = F.from_json("value", f"array<{ARM}>")[0]
    rows = documents.select(*keys_of(F.col("path"), 2), F.element_at(F.split("path", "/"), -2).alias("arm_name"), doc.alias("d"))
    m, s, a = F.col("d.arm.measured_data"), F.col("d.arm.setpoint_data"), F.col("d")
    turns = (m["measured_cp"]["orientation"], m["local_measured_cp"]["orientation"], s["setpoint_cp"]["orientation"])
    bent = F.lit(False)
    for turn in turns:
        bent = bent | (turn.isNotNull() & (F.size(turn) != 4))
    fault = F.when(a.isNull(), "unreadable").when(bent, "orientation")
    if strict:
        fault = F.when(fault.isNotNull(), F.raise_error(F.concat(fault, F.lit(": "), "dataset", F.lit("/"), "clip", F.lit("/"), F.col("frame").cast("string"))).cast("string"))
    return rows.select(
        "dataset", "clip", "frame", "arm_name", m["measured_js"].alias("measured_js"), m["measured_cp"].alias("measured_cp"), m["local_measured_cp"].alias("local_measured_cp"),
        m["measured_cv"].alias("measured_cv"), s["setpoint_js"].alias("setpoint_js"), s["setpoint_cp"].alias("setpoint_cp"),
        F.coalesce(a["jaw"]["measured_data"]["position"], a["arm"]["jaw"]["measured_data"]["position"])[0].alias("jaw_position"),
        F.coalesce(a["jaw"]["setpoint_data"]["position"], a["arm"]["jaw"]["setpoint_data"]["position"])[0].alias("jaw_setpoint"),
        F.coalesce(a["measured_frequency"], a["arm"]["measured_frequency"]).alias("frequency"),
        fault.alias("corrupt"),
    )


def label_documents(contact: DataFrame, gesture: DataFrame, phase: DataFrame, step: DataFrame, on: list[str]) -> DataFrame:
    """Labels of four sources by frame; the frames are those of any, absent labels are null. gesture_partial: the clip
    has gestures, but fewer than its best covered source has frames."""
    out = contact
    for other in (gesture, phase, step):
        out = out.join(other, on, "full")
    clip = [c for c in on if c != "frame"]
    names = [c for df in (contact, gesture, phase, step) for c in df.columns if c not in on]
    gestures = F.count(next(c for c in gesture.columns if c not in on))
    partial = ((gestures > 0) & (gestures < F.greatest(*(F.count(c) for c in names)))).alias("gesture_partial")
    if clip:
        return out.join(out.groupBy(*clip).agg(partial), clip)
    return out.crossJoin(F.broadcast(out.agg(partial)))  # one row


def calibrated_documents(documents: DataFrame) -> DataFrame:
    """Measured and setpoint poses in the camera; a pose without position or orientation is null."""
    kind = "struct<position:array<double>,orientation:array<double>>"
    d = F.from_json("value", f"struct<arm_name:string,measured_cp_calibrated:{kind},setpoint_cp_calibrated:{kind}>")
    whole = lambda c: F.when(c["position"].isNotNull() & c["orientation"].isNotNull(), c)
    rows = documents.select(*keys_of(F.col("path"), 2), d.alias("d"))
    return rows.select("dataset", "clip", "frame", "d.arm_name", whole(F.col("d.measured_cp_calibrated")).alias("measured"), whole(F.col("d.setpoint_cp_calibrated")).alias("setpoint"))


def clip_metadata(documents: DataFrame, known: list[str], value: str = "value") -> DataFrame:
    """Known keys as columns, the others as the map `extra`."""
    entries = F.from_json(value, "map<string,string>")
    rest = F.map_filter("_m", lambda k, _: ~k.isin(*known))
    return documents.withColumn("_m", entries).select("*", *(F.col("_m")[k].alias(k) for k in known), rest.alias("extra")).drop("_m")


def calibrations(documents: DataFrame, stereo: DataFrame | None = None) -> DataFrame:
    """Width, height, fx and baseline per clip: the stereo file's baseline, else -P2[3] / P2[0] of the projection
    matrix; the file's text stays."""
    number = lambda key: F.regexp_extract("value", rf"(?m)^{key}:\s*(-?[\d.eE+-]+)", 1).try_cast("double")
    p2 = F.transform(F.split(F.regexp_extract("value", r"P2:[^\[]*\[([^\]]*)\]", 1), r"\s*,\s*"), lambda x: F.trim(x).try_cast("double"))
    derived = F.when(F.size(p2) == 12, F.try_divide(-p2[3], p2[0]))
    out = documents.select("clip", F.col("value").alias("text"), number("image_width").cast("int").alias("width"), number("image_height").cast("int").alias("height"), p2[0].alias("fx"), derived.alias("_derived"))
    out = out.join(stereo.select("clip", F.col("baseline").alias("_stereo")), "clip", "left") if stereo is not None else out.withColumn("_stereo", F.lit(None).cast("double"))
    return out.withColumn("baseline", F.coalesce("_stereo", "_derived")).drop("_derived", "_stereo")


def camera_timetables(documents: DataFrame, key: str, value: str = "value", order: str | None = None) -> DataFrame:
    """(key, frame, timestamp_ns) of arrays of {frame, timestamp_ns}; of a frame that occurs twice, the later entry. A
    long timetable may come in several documents: order says in which order they count."""
    part = F.col(order) if order else F.lit(0)
    rows = documents.select(key, part.alias("_part"), F.posexplode(F.from_json(value, "array<struct<frame:int,timestamp_ns:bigint>>")).alias("_at", "_e"))
    return rows.groupBy(key, F.col("_e.frame").alias("frame")).agg(F.max_by("_e.timestamp_ns", F.struct("_part", "_at")).alias("timestamp_ns"))


def clip_inventory(paths: DataFrame, dataset: Column, clip: Column, marks: dict[str, str], kinds: tuple[str, ...] = ("offline", "online"), path: str = "path") -> DataFrame:
    """One row per clip: number of files, recorder variant from the dataset's prefix (another prefix raises), and for
    each mark whether some path fits its regular expression."""
    rows = paths.select(dataset.alias("dataset"), clip.alias("clip"), path)
    kind = F.raise_error(F.concat(F.lit("unknown recorder: "), F.col("dataset"))).cast("string")
    for k in kinds:
        kind = F.when(F.col("dataset").startswith(k), k).otherwise(kind)
    out = rows.groupBy("dataset", "clip").agg(F.count("*").alias("n_files"), *(F.max(F.col(path).rlike(r)).alias(name) for name, r in marks.items()))
    return out.withColumn("variant", kind)


def completed_only(frames: DataFrame, done: DataFrame, on) -> DataFrame:
    """Frames of completed episodes."""
    return frames.join(done, on, "left_semi")


def episode_filter(df: DataFrame, equal: dict[str, object] | None = None, ids: DataFrame | None = None, on: str | None = None, predicate: Column | None = None) -> DataFrame:
    """All conditions together; equalities come first so that they prune partitions, then the ids, then the rest."""
    for c, v in (equal or {}).items():
        df = df.filter(F.col(c) == v)
    if ids is not None:
        df = df.join(ids, on, "left_semi")
    return df.filter(predicate) if predicate is not None else df
