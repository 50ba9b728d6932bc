"""A hand-made release and hand-made faults for every rule."""

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from framespool.operators import integrity, release_rules
from framespool.sources import release


def codes(issues):
    return sorted((x["code"], x["key"]) for x in issues.collect())


def tables(spark, n=4, short=None):
    rows = [("set1", task, f"clip{k}", f, 100 * f, 0.5) for task, k in (("cut", 1), ("cut", 2), ("sew", 3)) for f in range(n)]
    df = spark.createDataFrame(rows, "dataset string, task string, episode_id string, frame_index int, master_timestamp_ns long, value double")
    out = {name: df for name in release_rules.MODALITIES}
    out["PSM1"] = df.withColumn("jaw.measured_position", F.col("value").cast("float"))
    if short:
        out[short] = out[short].filter("episode_id <> 'clip2' OR frame_index > 0")
    return out


def test_release_is_written_and_opened(spark, tmp_path):
    path, frames = str(tmp_path / "r"), tables(spark)
    release.write_release(frames, path, frames["timestamp"].filter("episode_id <> 'clip2'"))
    got = release.open_release(spark, path)
    assert sorted(x["episode_id"] for x in got.episodes.collect()) == ["clip1", "clip3"] and {x["task"] for x in got.tasks().collect()} == {"cut", "sew"}
    assert got.frames("PSM2").count() == 8 and got.frames("PSM2").schema["frame_index"].dataType.simpleString() == "int"
    jaw = got.filter(task="cut").column("PSM1", "jaw.measured_position")
    assert jaw.columns == ["dataset", "task", "episode_id", "frame_index", "jaw.measured_position"] and [x[4] for x in jaw.collect()] == [0.5] * 4
    assert "task" in jaw._jdf.queryExecution().toString() and got.filter(ids=spark.createDataFrame([("clip3",)], "episode_id string")).arm("ECM").count() == 4
    assert got.filter(predicate=F.col("dataset") == "none").frames("annotation").count() == 0
    with pytest.raises(KeyError):
        got.arm("PSM3")


def test_files_follow_the_frames_not_the_episodes(spark, tmp_path):
    """Hundreds of short episodes, and one that is most of a table, lie in few files in order of episode and frame."""
    path = str(tmp_path / "r")
    rows = spark.range(300).selectExpr("'set1' dataset", "if(id % 2 = 0, 'cut', 'sew') task", "concat('clip', id) episode_id", "0 frame_index", "id master_timestamp_ns")
    rows = rows.unionByName(spark.range(900).selectExpr("'set1' dataset", "'cut' task", "'long' episode_id", "cast(id as int) frame_index", "id master_timestamp_ns"))
    release.write_release({name: rows for name in release_rules.MODALITIES}, path)
    assert all(len(list((tmp_path / "r" / name).rglob("*.parquet"))) <= 10 for name in release_rules.MODALITIES)  # 8 ranges over 2 folders
    for file in (tmp_path / "r" / "ECM").rglob("*.parquet"):
        at = pq.ParquetFile(file).read(["episode_id", "frame_index"]).to_pylist()
        assert at == sorted(at, key=lambda x: (x["episode_id"], x["frame_index"]))
    got = release.open_release(spark, path)
    assert got.episodes.count() == 301 and got.frames("PSM2").count() == 1200 and got.filter(task="sew").frames("PSM1").count() == 150


def test_keys_stay_text_and_only_the_task_is_read(spark, tmp_path):
    """Names that look like numbers keep their zeros, and a task's frames come from its own files."""
    path = str(tmp_path / "r")
    rows = spark.createDataFrame([(d, t, e, f) for d in ("01", "1") for t in ("cut", "sew") for e in ("007", "7") for f in range(3)], "dataset string, task string, episode_id string, frame_index int")
    release.write_release({name: rows for name in release_rules.MODALITIES}, path)
    got = release.open_release(spark, path).filter(task="cut", predicate=F.col("dataset") == "01")
    frames = got.column("PSM1", "measured_cp.position")
    assert sorted((x["dataset"], x["episode_id"], x["frame_index"]) for x in frames.collect()) == [("01", e, f) for e in ("007", "7") for f in range(3)]
    plan = frames._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(task" in plan and "setpoint_cp" not in plan


def test_uneven_tables_are_refused(spark, tmp_path):
    with pytest.raises(ValueError, match="PSM2.*clip2"):
        release.write_release(tables(spark, short="PSM2"), str(tmp_path / "r"))
    assert not (tmp_path / "r").exists()


def test_trees_of_other_packers(spark, tmp_path):
    for task, clip, done in (("cut", "7", True), ("sew", "8", False)):
        at = tmp_path / "set a" / "episodes" / task / clip
        at.mkdir(parents=True)
        for name, schema in release.SCHEMAS.items():
            pq.write_table(pa.table({"frame_index": pa.array([0, 1], pa.int32()), "master_timestamp_ns": pa.array([5, 6], pa.int64())}), at / f"{name}.parquet")
        if done:
            (at / ".clip.complete.json").write_text("{}")
    got = release.open_release(spark, str(tmp_path), marker="*.complete.json")
    assert [tuple(x) for x in got.episodes.collect()] == [("set a", "cut", "7")]
    rows = got.frames("PSM1").collect()
    assert sorted((x["episode_id"], x["frame_index"], x["master_timestamp_ns"], x["jaw.setpoint_position"]) for x in rows) == [("7", 0, 5, None), ("7", 1, 6, None)]


def test_raw_clip_rules(spark):
    every = [*release_rules.REQUIRED_FOLDERS, *release_rules.OPTIONAL_FOLDERS]
    rows = [("good", f, 3) for f in every] + [("bad", f, 3) for f in every if f not in ("time_syn", "image/side")]
    rows = [("bad", f, 2) if (c, f) == ("bad", "kinematic/ECM") else (c, f, n) for c, f, n in rows] + [("good2", f, 1 if f in release_rules.WITHOUT_FRAMES else 3) for f in every]
    clips = spark.createDataFrame([("good", True), ("good2", True), ("bad", False), ("gone", False)], "clip string, has_meta boolean")
    got = codes(release_rules.raw_clip_rules(clips, spark.createDataFrame(rows, "clip string, folder string, frames int")))
    assert got == [("raw_clip_missing", "gone"), ("raw_frame_count_mismatch", "bad"), ("raw_missing_meta", "bad"), ("raw_missing_optional", "bad"), ("raw_missing_subdir", "bad")]


def test_episode_rules(spark):
    rows = [
        ("good", "complete", True, True, "1", 3, 1.0, True), ("run", "running", False, False, None, None, None, None), ("fail", "failed", True, True, "1", 3, 1.0, True),
        ("never", None, True, True, "1", 3, 1.0, True), ("meta", "complete", False, False, None, None, None, None), ("drift", "complete", True, False, None, None, None, None),
        ("old", "complete", True, True, "0", 3, 0.1, False), ("empty", "complete", True, True, "1", 3, 1.0, True),
    ]
    episodes = spark.createDataFrame(rows, "episode string, state string, has_meta boolean, readable boolean, schema_version string, length long, contiguity double, has_raw_video boolean")
    counts = [(e, m, 2 if (e, m) == ("old", "ECM") else 3) for e in ("good", "old", "run") for m in release_rules.MODALITIES]
    issues = release_rules.episode_rules(episodes, spark.createDataFrame(counts, "episode string, modality string, n long"), "1", 0.5)
    want = [("ep_incomplete", e) for e in ("fail", "never", "run")] + [("ep_length_mismatch", "old"), ("ep_low_contiguity", "old"), ("ep_missing_meta", "meta")]
    want += [("ep_missing_parquet", "empty")] * 5 + [("ep_no_video_raw", "old"), ("ep_schema_drift", "drift"), ("ep_schema_version_mismatch", "old")]
    assert codes(issues) == want
    why = {x["key"]: x["message"] for x in issues.filter("code = 'ep_incomplete'").collect()}
    assert why == {"run": "not complete: in flight", "fail": "not complete: failed before", "never": "not complete: never finished"}


def test_dataset_rules(spark):
    ids = lambda *x: spark.createDataFrame([(k,) for k in x], "episode string")
    assert codes(release_rules.index_rules(ids("a", "b"), ids("b", "c"), ids("b", "d"))) == [("I-1", "a"), ("I-2", "c"), ("I-3", "c"), ("I-3", "d")]
    counts = [("a", m, 3) for m in release_rules.MODALITIES if m != "ECM"] + [("b", m, 4 if m == "PSM1" else 3) for m in release_rules.MODALITIES]
    declared = spark.createDataFrame([("a", 3), ("b", 3)], "episode string, length int")
    assert codes(release_rules.length_rules(declared, spark.createDataFrame(counts, "episode string, modality string, n long"))) == [("I-4", "a"), ("I-4", "b")]
    files = spark.createDataFrame([("x", "1"), ("y", "2"), ("z", "3")], "path string, content string")
    listed = files.filter("path <> 'z'").select("path", F.sha2("content", 256).alias("sha256")).unionByName(spark.createDataFrame([("w", "h")], "path string, sha256 string"))
    assert codes(release_rules.manifest_rules(files, listed)) == [("I-5", "w"), ("I-5", "z")]
    changed = files.withColumn("content", F.lit("other"))
    assert codes(release_rules.manifest_rules(changed, listed, share=1)) == [("I-5", "w"), ("I-5", "x"), ("I-5", "y"), ("I-5", "z")]
    assert len(codes(release_rules.manifest_rules(changed, listed, share=0.0))) == 3  # one file is always hashed
    words = spark.createDataFrame([("phase", "p1")], "family string, value string")
    seen = spark.createDataFrame([("phase", "p1"), ("phase", "p9"), ("gesture", "g"), ("phase", None)], "family string, value string")
    assert codes(release_rules.vocabulary_rules(seen, words)) == [("I-6", "phase")]
    tasks = lambda *x: spark.createDataFrame([(k,) for k in x], "task string")
    assert codes(release_rules.task_rules(tasks("a", "b", "b"), tasks("a"))) == [("I-7", "b")]


def test_export_rules(spark):
    exports = spark.createDataFrame(
        [("good", 30, "arm", ["train", "val", "test", "recovery"], ["t"], "All timestamps agree."), ("bad", 10, None, None, [], "nothing"), ("void", 30, "arm", ["train"], None, None)],
        "export string, fps int, robot string, splits array<string>, tasks array<string>, readme string",
    )
    paths = [("good", p) for p in (*release_rules.EXPORT_FILES, "videos/a/x.mp4", "data/case-000/episode_000000.parquet")] + [("bad", "videos/x.txt"), ("bad", "data/y"), ("bad", "meta/info.json")]
    names = [*release_rules.EXPORT_FEATURES, "observation.images.left", "observation.meta.tool"]
    features = [("good", f, 480, 640) for f in names] + [("bad", "observation.images.left", 240, 640)]
    got = codes(release_rules.export_rules(exports, spark.createDataFrame(paths, "export string, path string"), spark.createDataFrame(features, "export string, feature string, height int, width int")))
    assert not [x for x in got if x[1] == "good"]
    of = lambda e: sorted(c for c, k in got if k == e)
    assert of("bad") == sorted(["structure"] + ["metadata"] * 4 + ["info"] * 3 + ["features"] * 3 + ["video", "tasks", "synchronisation", "image"])
    assert of("void") == sorted(["structure"] * 3 + ["metadata"] * 5 + ["splits"] * 3 + ["features"] * 4 + ["tasks"])


def test_manifest_leaves_out_what_is_not_shipped(spark):
    paths = ["a/1.parquet", ".logs/x", ".staging/y", ".tmp/z", "meta/manifest.json", "a/.clip.running.json", "a/.complete.json", "meta/complete.json", "b/.logs/x"]
    files = spark.createDataFrame([(p, "xy") for p in paths], "path string, content string")
    got = integrity.manifest(files, "path", "content")
    assert sorted(x["path"] for x in got.collect()) == ["a/1.parquet", "b/.logs/x", "meta/complete.json"] and integrity.manifest_totals(got).first() == (3, 6)


def test_vocabulary_lines_and_export_names(spark):
    tasks = spark.createDataFrame([("a", "do a"), ("b", None)], "task string, instruction string")
    words = spark.createDataFrame([("a", "step", "2", "two"), ("a", "phase", "1", None)], "task string, family string, id string, text string")
    got = {x["task"]: x["value"] for x in release.vocabulary_lines(tasks, words).collect()}
    assert got == {"a": '{"task":"a","instruction":"do a","words":[{"family":"phase","id":"1"},{"family":"step","id":"2","text":"two"}]}', "b": '{"task":"b","words":[]}'}
    frames = spark.createDataFrame([(1, 102, 0, "t", k, 0.5 * k) for k in range(3)], "case_id int, episode_id int, task_index int, task string, frame_index int, timestamp double")
    episodes, task_rows, info = release.export_metadata(frames, 30)
    assert episodes.first()["file"] == "data/case-001/episode_000102.parquet" and task_rows.count() == 1
    assert info.first().asDict() == {"total_episodes": 1, "total_frames": 3, "total_chunks": 1, "fps": 30.0, "total_tasks": 1}
