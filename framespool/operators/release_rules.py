"""The rules of raw clips, packed episodes, releases and learning exports over tables of what is there.

Every rule set takes tables (an inventory, declared values, counts) and gives issues (severity, code, key, message), so a
whole release is judged in a few joins instead of a walk per clip. Fixed catalogues are the only hinted broadcasts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .curate import repeatable_sample
from .integrity import reconciled, row_issues, rule, unknown_values

#: Folders of a raw clip that must be there, those that may be, and those that have no frame files.
REQUIRED_FOLDERS = (
    "annotation/contact_detection", "annotation/phase", "annotation/step", "camera_calibration", "hand_eye_calibration", "image/left", "image/right", "kinematic/ECM",
    "kinematic/PSM1", "kinematic/PSM2", "time_syn",
)
OPTIONAL_FOLDERS = ("annotation/gesture", "image/side", "image/side1")
WITHOUT_FRAMES = ("camera_calibration", "hand_eye_calibration")
#: The frame tables of an episode, and what a learning export must have.
MODALITIES = ("timestamp", "ECM", "PSM1", "PSM2", "annotation")
EXPORT_FOLDERS = ("videos", "meta", "data")
EXPORT_FILES = ("meta/info.json", "meta/episodes_stats.jsonl", "meta/tasks.jsonl", "meta/episodes.jsonl", "meta/README.md")
EXPORT_FEATURES = ("action.psm1.joint_position", "observation.state.psm1.joint_position")
#: Parts of the names of clinical features.
CLINICAL = ("observation.meta.tool", "observation.meta.force", "observation.meta.probe", "instruction.text")
EXPORT_SPLITS = ("train", "val", "test")
LEAST_FPS, LEAST_SIDE, IMAGES = 20, 480, "observation.images."


def joined(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def raised(df: DataFrame, severity: str, code: str, key: str, *message) -> DataFrame:
    """Each row of df as an issue."""
    text = F.concat(*(m if isinstance(m, Column) else F.lit(m) for m in message))
    return df.select(F.lit(severity).alias("severity"), F.lit(code).alias("code"), F.col(key).cast("string").alias("key"), text.alias("message"))


def raw_clip_rules(clips: DataFrame, folders: DataFrame) -> DataFrame:
    """Issues of raw clips. clips: (clip, has_meta), all that are expected; folders: (clip, folder, frames), those there are.

    A clip without any folder is missing and has no other issue. Frame counts are held against the largest of the clip's
    required folders with frames."""
    have = folders.groupBy("clip").agg(F.map_from_entries(F.collect_list(F.struct("folder", F.col("frames").cast("long").alias("frames")))).alias("at"))
    df = clips.join(have, "clip", "left")
    counted = [f for f in REQUIRED_FOLDERS if f not in WITHOUT_FRAMES]
    n = {f: F.col("at")[f] for f in (*REQUIRED_FOLDERS, *OPTIONAL_FOLDERS)}
    most = F.greatest(*(n[f] for f in counted))
    there = F.col("at").isNotNull()
    rules = [rule(~there, "ERROR", "raw_clip_missing", "the clip has no folders"), rule(there & ~F.col("has_meta"), "ERROR", "raw_missing_meta", "no metadata")]
    rules += [rule(there & n[f].isNull(), "ERROR", "raw_missing_subdir", f"no folder {f}") for f in REQUIRED_FOLDERS]
    rules += [rule(there & (n[f] != most), "ERROR", "raw_frame_count_mismatch", F.concat(F.lit(f"{f} has "), n[f], F.lit(" frames of "), most)) for f in counted]
    rules += [rule(there & n[f].isNull(), "INFO", "raw_missing_optional", f"no folder {f}") for f in OPTIONAL_FOLDERS]
    return row_issues(df, "clip", rules)


def episode_rules(episodes: DataFrame, rows: DataFrame, version: str, floor: float | None = None) -> DataFrame:
    """Issues of packed episodes. episodes: (episode, state, has_meta, readable, schema_version, length, contiguity,
    has_raw_video), state complete, running, failed or null; rows: (episode, modality, n), of the tables there are.

    An incomplete episode has that issue only, one without readable metadata too."""
    have = rows.groupBy("episode").agg(F.map_from_entries(F.collect_list(F.struct("modality", "n"))).alias("at"))
    df = episodes.join(have, "episode", "left").withColumn("at", F.coalesce("at", F.create_map().cast("map<string,bigint>")))
    done = F.col("state").eqNullSafe("complete")
    why = F.when(F.col("state") == "running", "in flight").when(F.col("state") == "failed", "failed before").otherwise("never finished")
    known = done & F.col("has_meta") & F.col("readable")
    rules = [
        rule(~done, "ERROR", "ep_incomplete", F.concat(F.lit("not complete: "), why)),
        rule(done & ~F.col("has_meta"), "ERROR", "ep_missing_meta", "no metadata"),
        rule(done & F.col("has_meta") & ~F.col("readable"), "ERROR", "ep_schema_drift", "the metadata don't fit their schema"),
        rule(known & ~F.col("schema_version").eqNullSafe(version), "ERROR", "ep_schema_version_mismatch", F.concat(F.lit("schema version "), F.coalesce("schema_version", F.lit("none")))),
    ]
    for m in MODALITIES:
        n = F.col("at")[m]
        rules.append(rule(known & n.isNull(), "ERROR", "ep_missing_parquet", f"no table {m}"))
        rules.append(rule(known & (n != F.col("length")), "ERROR", "ep_length_mismatch", F.concat(F.lit(f"{m} has "), n, F.lit(" rows of "), "length")))
    if floor is not None:
        rules.append(rule(known & (F.col("contiguity") < floor), "ERROR", "ep_low_contiguity", f"contiguity under {floor}"))
    rules.append(rule(known & ~F.col("has_raw_video"), "WARNING", "ep_no_video_raw", "raw images can't be rebuilt"))
    return row_issues(df, "episode", rules)


def index_rules(disk: DataFrame, index: DataFrame, lines: DataFrame) -> DataFrame:
    """I-1 to I-3: episodes (episode) in storage, in the index and in its JSON lines are the same."""
    first = reconciled(disk, index, "episode", "I-1", "I-2")
    return first.unionByName(reconciled(lines, index, "episode", "I-3", "I-3"))


def length_rules(declared: DataFrame, rows: DataFrame) -> DataFrame:
    """I-4: every modality of each stored episode (episode, length) has that many rows. rows: (episode, modality, n)."""
    have = rows.groupBy("episode").agg(F.map_from_entries(F.collect_list(F.struct("modality", "n"))).alias("at"))
    df, rules = declared.join(have, "episode", "left"), []
    for m in MODALITIES:
        n = F.col("at")[m]
        rules.append(rule(n.isNull(), "ERROR", "I-4", f"no table {m}"))
        rules.append(rule(n != F.col("length"), "ERROR", "I-4", F.concat(F.lit(f"{m} has "), n, F.lit(" rows of "), "length")))
    return row_issues(df, "episode", rules)


def manifest_rules(files: DataFrame, manifest: DataFrame, share: float = 0.01, salt: str = "") -> DataFrame:
    """I-5: files (path, content) and manifest (path, sha256) name the same paths, and a repeatable sample of those in
    both, one at least, has the hash that is listed (share 1: all). Contents are hashed for the sample only."""
    paths = reconciled(files, manifest, "path", "I-5", "I-5")
    both = files.select("path").distinct().join(manifest.select("path", "sha256"), "path")
    sample = repeatable_sample(both, "path", share, salt) if share < 1 else both
    wrong = files.join(sample, "path").filter(F.sha2(F.col("content").cast("binary"), 256) != F.col("sha256"))
    return paths.unionByName(raised(wrong, "ERROR", "I-5", "path", "hash differs"))


def vocabulary_rules(labels: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """I-6: label texts (family, value) that the vocabulary (family, value) of their family lacks."""
    return raised(unknown_values(labels, "family", "value", vocabulary), "ERROR", "I-6", "family", "unknown: ", F.col("value"))


def task_rules(observed: DataFrame, declared: DataFrame) -> DataFrame:
    """I-7: tasks (task) with episodes that the release doesn't declare."""
    return raised(observed.select("task").distinct().join(declared.select("task"), "task", "left_anti"), "ERROR", "I-7", "task", "not declared")


def export_rules(exports: DataFrame, paths: DataFrame, features: DataFrame) -> DataFrame:
    """Issues of learning exports. exports: (export, fps, robot, splits, tasks, readme): splits and tasks are arrays, readme
    the text; paths: (export, path), all files; features: (export, feature, height, width), as declared."""
    files = paths.groupBy("export").agg(
        *(F.max(F.startswith("path", F.lit(f"{f}/"))).alias(f"in_{f}") for f in EXPORT_FOLDERS), F.collect_set(F.when(F.col("path").isin(*EXPORT_FILES), F.col("path"))).alias("files"),
        F.max(F.col("path").rlike(r"^data/case-[^/]+/")).alias("cases"), F.max(F.col("path").rlike(r"^data/case-[^/]+/episode_[^/]*\.parquet$")).alias("episodes"),
        F.max(F.col("path").rlike(r"^videos/.*\.mp4$")).alias("movies"),
    )
    images = F.startswith("feature", F.lit(IMAGES))
    has = features.groupBy("export").agg(
        F.collect_set(F.when(F.col("feature").isin(*EXPORT_FEATURES), F.col("feature"))).alias("required"), F.max(images).alias("images"),
        F.max(F.greatest(*(F.contains(F.col("feature"), F.lit(c)) for c in CLINICAL))).alias("clinical"),
    )
    df = exports.join(files, "export", "left").join(has, "export", "left")
    no = lambda c: ~F.coalesce(F.col(c), F.lit(False))
    lacks = lambda c, x: ~F.coalesce(F.array_contains(c, x), F.lit(False))
    rules = [rule(no(f"in_{f}"), "ERROR", "structure", f"no folder {f}") for f in EXPORT_FOLDERS]
    rules += [
        rule(F.col("in_data") & no("cases"), "ERROR", "structure", "no case folder under data"),
        rule(F.col("cases") & no("episodes"), "ERROR", "structure", "no episode in the case folders"),
        *(rule(lacks("files", f), "ERROR", "metadata", f"no {f}") for f in EXPORT_FILES),
        rule(F.col("fps") < LEAST_FPS, "WARNING", "info", F.concat(F.col("fps").cast("string"), F.lit(f" frames a second, under {LEAST_FPS}"))),
        rule(F.col("robot").isNull(), "WARNING", "info", "no robot type"), rule(F.col("splits").isNull(), "WARNING", "info", "no splits"),
        *(rule(F.col("splits").isNotNull() & lacks("splits", s), "WARNING", "splits", f"no split {s}") for s in EXPORT_SPLITS),
        rule(F.col("splits").isNotNull() & lacks("splits", "recovery"), "INFO", "splits", "no recovery examples"),
        *(rule(lacks("required", f), "ERROR", "features", f"no feature {f}") for f in EXPORT_FEATURES),
        rule(no("images"), "WARNING", "features", "no image feature"), rule(no("clinical"), "INFO", "features", "no tool, force, probe or instruction feature"),
        rule(F.col("in_videos") & no("movies"), "WARNING", "video", "no video"),
        rule(F.coalesce(F.size("tasks"), F.lit(0)) <= 0, "WARNING", "tasks", "no task"),
        rule(F.col("readme").isNotNull() & ~F.lower("readme").rlike("synchron|timestamp"), "WARNING", "synchronisation", "not documented"),
    ]
    small = features.filter(images & ((F.col("height") < LEAST_SIDE) | (F.col("width") < LEAST_SIDE)))
    low = raised(small, "WARNING", "image", "export", F.col("feature"), " is ", F.col("height").cast("string"), "x", F.col("width").cast("string"))
    return row_issues(df, "export", rules).unionByName(low)
