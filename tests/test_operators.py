"""Cases made by hand, seeded properties against plain restatements, readers over real files, errors."""

import datetime
import json
import math
import random

import pytest
from pyspark.sql import functions as F

from framespool.plans import bindings
from framespool.functions import normalize, pose
from framespool.functions.catalog import TOPICS
from framespool.operators import align, curate, integrity, profile, segment, sync_stats
from framespool.sources import scans, sinks
from framespool.streaming import live


def frames(spark, stamps, key=1):
    return spark.createDataFrame([(key, k, int(t)) for k, t in enumerate(stamps)], "clip long, frame long, t long")


def nearest(spark, masters, samples, tolerance):
    out = align.nearest_match(frames(spark, masters), frames(spark, samples), "clip", "t", "frame", tolerance)
    return {r["ident"]: (r["match"], r["delta"]) for r in out.collect()}


def test_nearest_by_hand(spark):
    exact = [k * 33_333_333 for k in range(10)]
    assert nearest(spark, exact, exact, 0) == {k: (k, 0) for k in range(10)}
    assert nearest(spark, [0, 10**9], [10**7, 10**9 + 10**7], 2 * 10**6) == {0: (None, None), 1: (None, None)}
    assert nearest(spark, [100], [90, 105], 50) == {0: (1, 5)}
    assert nearest(spark, [100], [90, 110], 50) == {0: (1, 10)}
    assert nearest(spark, [100, 200], [], 50) == {0: (None, None), 1: (None, None)}


def test_nearest_seeded(spark):
    r = random.Random(0)
    masters, samples = sorted(r.randrange(1000) for _ in range(200)), sorted(r.randrange(1000) for _ in range(60))
    got = nearest(spark, masters, samples, 12)
    for k, t in enumerate(masters):
        gap, u = min(((abs(s - t), -s) for s in samples))
        assert got[k][1] == (-u - t if gap <= 12 else None)


def contiguous(spark, stamps):
    out = align.contiguity(frames(spark, stamps), "clip", "frame", "t")
    return [(r["contiguous"], r["drops"]) for r in out.orderBy("frame").collect()]


def test_contiguity_by_hand(spark):
    assert contiguous(spark, range(0, 100, 10)) == [(False, 0)] + [(True, 0)] * 9
    doubled = [0, 10, 20, 30, 40, 60, 70, 80, 90]
    assert contiguous(spark, doubled)[5] == (False, 1)
    assert contiguous(spark, [5]) == [(False, 0)] and contiguous(spark, []) == []
    assert contiguous(spark, [5, 5, 5]) == [(False, 0), (True, 0), (True, 0)]
    assert contiguous(spark, [0, 1, 2, 3, 1000])[4] == (False, 127)


def test_summary_of_one_frame(spark):
    row = align.episode_summary(align.contiguity(frames(spark, [7]), "clip", "frame", "t"), "clip", "t").first()
    assert (row["n_frames"], row["duration_s"], row["frames_dropped"], row["contiguity_ratio"]) == (1, 0.0, 0, 1.0)


def test_window_match_seeded(spark):
    r = random.Random(3)
    ref, other = [r.randrange(500) for _ in range(40)], {f: r.randrange(500) for f in sorted(r.sample(range(25), 12))}
    search = spark.createDataFrame([(1, f, t) for f, t in other.items()], "clip long, frame long, t long")
    got = {x["k"]: x["match"] for x in align.window_match(frames(spark, ref), search, "clip", "frame", "t", 2).collect()}
    top = max(other)
    for k, t in enumerate(ref):
        near = [f for f in other if abs(f - k) <= 2]
        if near:
            assert got[k] == min(near, key=lambda f: (abs(other[f] - t), abs(f - k), f))
        else:
            assert got[k] == min(other, key=lambda f: (abs(f - min(k, top)), f))


def test_segments_by_hand(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, "a"), (1, 3, "b"), (1, 5, "b"), (1, 6, "b"), (2, 1, None), (2, 2, None)], "clip int, frame int, step string")
    got = [(r["clip"], r["segment"]) for r in segment.segments(df, "clip", "frame", "step").orderBy("clip", "frame").collect()]
    assert got == [(1, 0), (1, 0), (1, 1), (1, 2), (1, 2), (2, 0), (2, 0)]


def test_too_many_segments_raise(spark):
    df = spark.createDataFrame([("c", k) for k in range(101)], "case_id string, segment int")
    with pytest.raises(Exception, match="too many segments"):
        segment.number_episodes(df, "case_id", "segment").collect()


def test_ranked_is_total(spark):
    r = random.Random(5)
    values = r.sample(range(10_000), 800)
    df = spark.createDataFrame([(v,) for v in values], "v int").repartition(7)
    assert {x["v"]: x["rank"] for x in segment.ranked(df, ["v"]).collect()} == {v: k for k, v in enumerate(sorted(values))}


def test_ranked_keeps_every_row_when_partitions_are_coalesced(spark, tmp_path):
    """Wide rows, keys that are few of their columns, ties, and partitions that the planner joins as it likes."""
    forced = {
        "spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "200k", "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "10k",
    }
    before = {k: spark.conf.get(k, None) for k in forced}
    df = spark.range(20_000).select("id", F.expr("id * 7919 % 5000").alias("v"), *(F.sha2(F.concat("id", F.lit(str(k))), 256).alias(f"w{k}") for k in range(6)))
    try:
        for k, v in forced.items():
            spark.conf.set(k, v)
        segment.ranked(df, ["v"]).write.parquet(str(tmp_path / "out"))
        got = spark.read.parquet(str(tmp_path / "out"))
        assert got.count() == 20_000 and got.columns == [*df.columns, "rank"]
        assert got.agg(F.min("rank"), F.max("rank"), F.count_distinct("rank")).first() == (0, 19_999, 20_000)
        assert got.filter(F.col("v") != F.floor(F.col("rank") / 4)).count() == 0 and got.join(df, df.columns, "left_anti").count() == 0
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_exact_quantiles(spark):
    r = random.Random(2)
    columns = {
        "a": [r.gauss(0, 1) for _ in range(30_000)], "b": [float(r.randrange(3)) for _ in range(30_000)], "c": [None] * 29_999 + [4.0], "d": [float("nan")] * 30_000,
        "e": [r.random() if k % 400 == 0 else None for k in range(30_000)],
    }
    df = spark.createDataFrame(list(zip(*columns.values())), ", ".join(f"{c} double" for c in columns))
    got = {x["column_name"]: x for x in profile.column_profile(df, list(columns), 9).collect()}
    for c, values in columns.items():
        real = sorted(v for v in values if v is not None and v == v)
        for name, q in (("q01", 0.01), ("q99", 0.99)):
            if not real:
                assert got[c][name] is None
                continue
            at = q * (len(real) - 1)
            low = math.floor(at)
            want = real[low] + (real[math.ceil(at)] - real[low]) * (at - low)
            assert got[c][name] == pytest.approx(want, abs=1e-8), (c, name)
    assert got["d"]["nan_count"] == 30_000 and got["c"]["null_count"] == 29_999


def test_sample_has_a_row_at_least(spark):
    df = spark.createDataFrame([(f"p{k}",) for k in range(5)], "path string")
    one = curate.repeatable_sample(df, "path", 0.0).collect()
    assert len(one) == 1 and one == curate.repeatable_sample(df.repartition(3), "path", 0.0).collect() and curate.repeatable_sample(df.limit(0), "path").count() == 0


def test_mapping_takes_the_least_target_and_falls_back(spark):
    paths = spark.createDataFrame([("x/data/1",), ("y/data/2",), ("z/3",), ("w/4",)], "path string")
    note = spark.createDataFrame([("x/data/1", "b"), ("x/data/1", "a"), ("q/data/2", "c")], "old string, new string")
    index = spark.createDataFrame([("z/3", "i2"), ("z/3", "i1")], "path string, new_path string")
    tail = lambda c: F.regexp_extract(c, "(data/.*)$", 1)
    out = curate.remapped(paths, "path", note, "old", "new", tail("path"), F.nullif(tail("old"), F.lit("")), index)
    assert {x["path"]: (x["new_path"], x["matched_by"]) for x in out.collect()} == {"x/data/1": ("a", "path"), "y/data/2": ("c", "tail"), "z/3": ("i1", "index"), "w/4": (None, None)}
    assert [x["path"] for x in curate.unmatched(out, "path").collect()] == ["w/4"]


def test_log_lines(spark):
    lines = ["10:00 | a/b.c_d-1:  12 PNGs in 3.5s (0.25 fps)", "x | y | left:3 JSONs in 2s", "no bar: 3 PNGs in 1s", "| q: many PNGs in 1s", "| q: 3 files in 1s", "| r: 4 PNGs in 2s (7fps)", None, ""]
    got = normalize.log_lines(spark.createDataFrame([(x,) for x in lines], "value string")).collect()
    assert [tuple(x) for x in got] == [("a/b.c_d-1", 12, 3.5, 0.25), ("left", 3, 2.0, None), ("r", 4, 2.0, 7.0)]


def test_round_trip_compares_in_types(spark):
    first = spark.createDataFrame([(1, 1.0, "a", 5, None), (2, 2.0, "b", 6, 1.0), (3, float("nan"), None, 7, 1.0)], "doc int, x double, s string, k int, y double")
    second = spark.createDataFrame([(1, 1.0 + 5e-6, "a", 5, 3.0), (2, 2.1, None, 6, None)], "doc int, x double, s string, k long, y double")
    got = {tuple(x) for x in integrity.round_trip(first, second, "doc", {"x": "x", "s": "s", "k": "k", "y": "y"}, known_lossy=["y"]).collect()}
    assert got == {(2, "x", "differs"), (2, "s", "missing"), (3, "x", "missing"), (3, "k", "missing")}


def test_bad_documents_raise_when_strict(spark):
    doc = json.dumps([{"arm": {"setpoint_data": {"setpoint_cp": {"orientation": [1, 2]}}}}])
    rows = spark.createDataFrame([("/d/s/1/kinematic/PSM1/3.json", doc)], "path string, value string")
    assert scans.kinematic_documents(rows).first()["corrupt"] == "orientation"
    with pytest.raises(Exception, match="orientation: s/1/3"):
        scans.kinematic_documents(rows, strict=True).collect()


def test_trim_policies(spark):
    df = spark.createDataFrame([(1, k, 100) for k in range(200)], "clip int, index int, target int")
    kept = lambda mode: sorted(set(range(200)) - {r["index"] for r in curate.trimmed(df, "clip", "index", "target", mode).collect()})
    assert kept(-1) == list(range(100)) and kept(0) == list(range(100, 200)) and kept(50) == list(range(50, 150))
    with pytest.raises(Exception, match="too few"):
        kept(150)


def test_bounded_sample(spark):
    df = spark.createDataFrame([(1, k) for k in range(101)] + [(2, k) for k in range(7)], "clip int, k int")
    got = curate.bounded_sample(df, "clip", "k", 30).collect()
    assert sorted(r["k"] for r in got if r["clip"] == 1) == [i * 101 // 30 for i in range(30)] and sum(r["clip"] == 2 for r in got) == 7


def test_absent_topic(spark):
    deltas = spark.createDataFrame([(1, "a", 0, -5), (1, "a", 1, 5), (1, "b", 0, None)], "clip int, topic string, frame int, delta long")
    topics = spark.createDataFrame([("a",), ("b",), ("c",)], "topic string")
    got = {r["topic"]: (r["n_present"], r["max_frame"], r["max_ms"]) for r in sync_stats.topic_latency(deltas, "clip", "topic", "frame", "delta", topics).collect()}
    assert got == {"a": (2, 0, 0.005), "b": (0, None, None), "c": (0, None, None)}


def test_poses_by_hand(spark):
    eye, c, s = (1, 0, 0, 0, 1, 0, 0, 0, 1), math.cos(math.pi / 6), math.sin(math.pi / 6)
    turn = (c, -s, 0, s, c, 0, 0, 0, 1)
    m, v = pose.matrix, pose.vector
    r, t = pose.measured_pose(m(turn), v(0.1, 0, 0), *pose.chained(eye, (1, 0, 0), eye, (2, 0, 0)))
    both = [pose.base_in_camera(m(turn), v(1, 2, 3), m(turn), v(4, 5, 6)), pose.chained(turn, (1, 2, 3), turn, (4, 5, 6))]
    by_row, once = (spark.range(1).select(*(x.alias(f"x{j}") for j, x in enumerate(pair))).first() for pair in both)
    assert by_row[0] == pytest.approx(once[0]) and by_row[1] == pytest.approx(once[1])
    row = spark.range(1).select(r.alias("r"), t.alias("t"), pose.quaternion(m(turn)).alias("q"), pose.setpoint_pose(m(turn), v(0.1, 0, 0), m(eye), v(2, 0, 0))[1].alias("s")).first()
    assert row["t"] == pytest.approx([3.1, 0, 0]) and row["r"] == pytest.approx(turn) and row["q"] == pytest.approx([0, 0, math.sin(math.pi / 12), math.cos(math.pi / 12)])
    assert row["s"] == pytest.approx([2.1, 0, 0])
    depth = spark.range(1).select(pose.depth(F.array(*(F.lit(x) for x in (50.0, 12.5, 0.0, 1e-9, float("nan")))), 1175.93, 0.004183).alias("z")).first()["z"]
    assert depth[:2] == pytest.approx([0.004183 * 1175.93 / 50, 0.004183 * 1175.93 / 12.5], rel=1e-6) and all(math.isnan(x) for x in depth[2:])
    with pytest.raises(Exception, match="16 values"):
        spark.range(1).select(pose.offset_pose(m(eye), v(0, 0, 0), v(1, 2))[1]).collect()


def test_quaternion_of_every_branch(spark):
    r = random.Random(1)
    qs = [[r.uniform(-1, 1) for _ in range(4)] for _ in range(200)] + [[1, 0, 0, 0], [0, 1, 0, 0], [0, 0, 1, 0], [0, 0, 0, 1]]
    df = spark.createDataFrame([([float(x) for x in q],) for q in qs], "q array<double>").withColumn("r", pose.rotation(F.col("q")))
    for row in df.withColumn("b", pose.quaternion(F.col("r"))).collect():
        n = math.sqrt(sum(x * x for x in row["q"]))
        sign = -1 if row["q"][3] < 0 else 1
        same = [sign * x / n for x in row["q"]]
        assert row["b"] == pytest.approx(same, abs=1e-9) or row["b"] == pytest.approx([-x for x in same], abs=1e-9)


def test_stamps_before_1970(spark):
    sec, nsec = normalize.from_ns(F.lit(-1))
    assert tuple(spark.range(1).select(sec, nsec).first()) == (-1, 999_999_999)


def test_document_readers(spark, tmp_path):
    clip = tmp_path / "online_a" / "7"
    for folder in ("time_syn", "kinematic/PSM1", "calibrated/PSM1"):
        (clip / folder).mkdir(parents=True)
    stamp = lambda s, n: {"sec": s, "nsec": n}
    doc = {"image_left_stamp": stamp(1, 5), "Kinematics_set_1": {"PSM1": {"measured_data": {"measured_js_stamp": stamp(1, 9)}}}}
    for k in (2, 10):
        (clip / "time_syn" / f"{k}.json").write_text(json.dumps(doc))
    got = scans.stamp_documents(scans.read_documents(spark, f"{tmp_path}/*/*/time_syn/*.json")).orderBy("frame").collect()
    assert [r["frame"] for r in got] == [2, 10] and got[0]["image_left"] == 1_000_000_005 and got[0]["PSM1__measured_js"] == 1_000_000_009
    assert got[0]["image_right"] is None and got[0]["clip"] == "7" and len(TOPICS) == 24
    arm = {"arm": {"measured_data": {"measured_cp": {"position": [1, 2, 3], "orientation": [0, 0, 0, 1]}}, "jaw": {"measured_data": {"position": [0.3]}}}, "measured_frequency": 200.0}
    (clip / "kinematic/PSM1" / "2.json").write_text(json.dumps([arm]))
    (clip / "kinematic/PSM1" / "3.json").write_text("{broken")
    arms = {r["frame"]: r for r in scans.kinematic_documents(scans.read_documents(spark, f"{tmp_path}/*/*/kinematic/*/*.json")).collect()}
    assert arms[2]["jaw_position"] == 0.3 and arms[2]["frequency"] == 200.0 and arms[2]["corrupt"] is None and arms[3]["corrupt"] == "unreadable" and arms[2]["arm_name"] == "PSM1"
    (clip / "calibrated/PSM1" / "2.json").write_text(json.dumps({"arm_name": "PSM1", "measured_cp_calibrated": {"position": [1, 2, 3]}, "setpoint_cp_calibrated": {"position": [1, 2, 3], "orientation": [0, 0, 0, 1]}}))
    row = scans.calibrated_documents(scans.read_documents(spark, f"{tmp_path}/*/*/calibrated/*/*.json")).first()
    assert row["measured"] is None and row["setpoint"]["position"] == [1, 2, 3]


def test_errors(spark):
    dup = spark.createDataFrame([("d", 1, "t1"), ("d", 1, "t2")], "dataset string, clip int, task string")
    with pytest.raises(Exception, match="two targets"):
        integrity.refuse_duplicates(dup, ["dataset", "clip"], "task").collect()
    with pytest.raises(Exception, match="not an episode id"):
        spark.range(1).select(align.source_parts(F.lit("only_two"))).collect()
    with pytest.raises(Exception, match="no task"):
        curate.resolved_task(dup.withColumn("guess", F.lit(None).cast("string")), "clip", dup.select("clip", "task").limit(0), "guess").collect()
    with pytest.raises(Exception, match="bad range"):
        ranges = spark.createDataFrame([(1, 5, 3)], "clip long, a long, b long")
        align.ranges_to_frames(ranges, "clip", "a", "b", frames(spark, [0, 1]), "frame").collect()
    with pytest.raises(Exception, match="unknown recorder"):
        scans.clip_inventory(spark.createDataFrame([("x/1",)], "path string"), F.lit("x"), F.lit("1"), {}).collect()


def test_partition_overwrite(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "v int, task string")
    sinks.write_partitioned(df, str(tmp_path / "t"), ["task"])
    sinks.write_partitioned(df.filter("task = 'a'").withColumn("v", F.lit(9)), str(tmp_path / "t"), ["task"], mode="overwrite")
    assert sorted((r["v"], r["task"]) for r in spark.read.parquet(str(tmp_path / "t")).collect()) == [(2, "b"), (9, "a")]


def test_exported_episodes_share_files(spark, tmp_path):
    rows = [(c, 100 * c + e, f) for c in range(60) for e in range(5) for f in range(1 + e)]
    back = sinks.export_episodes(spark.createDataFrame(rows, "case_id int, episode_id int, turn int"), str(tmp_path / "e"))
    assert sorted(map(tuple, back.collect())) == sorted(rows)
    assert len(list((tmp_path / "e").rglob("*.parquet"))) <= 8  # was 300
    assert back.groupBy("episode_id").agg(F.count_distinct(F.col("_metadata.file_path")).alias("n")).filter("n > 1").count() == 0


MINUTE = 60_000_000


def streamed(spark, tmp_path, stream_of, batches, schema):
    """Each batch (rows) as files of its own, and what has come out after each."""
    source, sink, marks = (str(tmp_path / n) for n in ("in", "out", "marks"))
    out = []
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        live.run_once(stream_of(live.ingest(spark, source, spark.createDataFrame([], schema).schema)), sink, marks)
        out.append(spark.read.parquet(sink).collect())
    return out


def test_stream_resumes_and_reorders(spark, tmp_path):
    """Frames are held until the watermark (ten minutes behind) has passed them, over restarts, and given in order."""
    at = 10**12  # microseconds
    stamps = [at + k * MINUTE for k in (0, 1, 2, 3, 6, 7, 8, 9, 10, 11)]
    rows = [("c", k, t) for k, t in enumerate(stamps)]
    first, second = [rows[k] for k in (4, 0, 3)], [rows[k] for k in (2, 9, 1, 5, 8, 6, 7)]
    end, late = [("end", 99, at + 100 * MINUTE)], [("c", 50, at + 12 * MINUTE)]
    got = streamed(spark, tmp_path, lambda s: live.monitored(s, "clip", "t", "frame", MINUTE), (first, second, end, late), "clip string, frame long, t long")
    assert got[0] == [] and {x["frame"] for x in got[1]} == {0, 1}
    want = {k: (k != 0 and k != 4, 2 if k == 4 else 0) for k in range(10)}
    for result in got[2:]:  # 50 comes behind the watermark
        assert {x["frame"]: (x["contiguous"], x["drops"]) for x in result} == want


def test_live_state_follows_the_buckets_not_the_clips(spark, tmp_path):
    """Many clips, one without a name, in a state of as many rows as there are buckets; the frames come out once."""
    source, sink, marks = (str(tmp_path / n) for n in ("in", "out", "marks"))
    rows = [(k if k else None, 10 * k + f, (1 + f * (1 + k % 3)) * MINUTE + k) for k in range(700) for f in range(4)] + [(-1, 9999, 1000 * MINUTE)]
    whole = spark.createDataFrame(rows, "clip long, frame long, t long")
    sinks.write_in_order(whole, source, ["t", "frame"], 4)
    stream = live.monitored(live.ingest(spark, source, whole.schema, files_per_batch=1), "clip", "t", "frame", MINUTE)
    query = stream.writeStream.format("parquet").option("path", sink).option("checkpointLocation", marks).trigger(availableNow=True).start()
    query.awaitTermination()
    assert 0 < max(p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress) <= live.BUCKETS < 700
    got = sorted((x["frame"], x["clip"], x["contiguous"], x["drops"]) for x in spark.read.parquet(sink).filter("frame <> 9999").collect())
    assert got == sorted((10 * k + f, k if k else None, f > 0 and k % 3 == 0, k % 3 if f else 0) for k in range(700) for f in range(4))


def test_late_clips_of_one_bucket(spark, tmp_path):
    """Clips of one bucket whose frames come mixed up and late; a forgotten clip starts anew, the others don't."""
    rows = [(c, 100 * k + f, (1 + f + 40 * (k == 2 and f > 1)) * MINUTE + k) for k, c in enumerate("abc") for f in range(4)]
    mixed = [rows[k] for k in (5, 1, 8, 0, 9, 4, 2, 6)], [rows[k] for k in (7, 3, 10, 11)], [("a", 50, 60 * MINUTE)], [("b", 150, 61 * MINUTE)], [("end", 99, 500 * MINUTE)]
    follow = lambda s: live.monitored(s, "clip", "t", "frame", MINUTE, late="30 minutes", forget=20 * MINUTE, buckets=1)
    got = {x["frame"]: (x["contiguous"], x["drops"]) for x in streamed(spark, tmp_path, follow, mixed, "clip string, frame long, t long")[-1]}
    want = {100 * k + f: (f > 0 and (k, f) != (2, 2), 40 if (k, f) == (2, 2) else 0) for k in range(3) for f in range(4)}
    assert {k: v for k, v in got.items() if k in want} == want and set(got) == {*want, 50, 150}


def test_live_state_is_two_values_a_bucket(spark, tmp_path):
    """The frames that a bucket holds cross between the JVM and Python as one value; frames without a number are held too."""
    source, sink, marks = (str(tmp_path / n) for n in ("in", "out", "marks"))
    rows = [(k % 50, k if k % 100 else None, (1 + k) * 1000) for k in range(20_000)]
    whole = spark.createDataFrame(rows, "clip long, frame long, t long")
    whole.coalesce(1).write.parquet(source)
    stream = lambda: live.monitored(live.ingest(spark, source, whole.schema), "clip", "t", "frame", 50_000, buckets=4)
    live.run_once(stream(), sink, marks)
    state = spark.read.format("statestore").load(marks).select("value.groupState.*")
    assert {kind for _, kind in state.dtypes} == {"binary"}
    size = state.selectExpr("count(*) AS n", "sum(length(held)) AS held").first()
    assert size.n == 4 and 0 < size.held < 40 * len(rows)
    spark.createDataFrame([(-1, -1, 10**12)], whole.schema).write.mode("append").parquet(source)
    live.run_once(stream(), sink, marks)
    got = sorted((x["clip"], x["frame"] or 0, x["contiguous"], x["drops"]) for x in spark.read.parquet(sink).filter("clip >= 0").collect())
    assert got == sorted((c, f or 0, t > 50_000, 0) for c, f, t in rows)


def test_masters_without_a_match_come_out(spark, tmp_path):
    stamp = lambda minutes: datetime.datetime(2024, 1, 1) + datetime.timedelta(minutes=minutes)
    rows = [(1, "m", stamp(0)), (1, "o", stamp(4)), (2, "m", stamp(1)), (2, "o", stamp(40)), (3, "m", stamp(2))]
    end = [(-1, "m", stamp(9000)), (-1, "o", stamp(9000))]

    def both(s):
        return live.nearest_live(s.filter("kind = 'm'"), s.filter("kind = 'o'"), "user", "ts", "id", "5 minutes", how="leftOuter")

    rows = [(u, k, t, n) for n, (u, k, t) in enumerate(rows)]
    end = [(u, k, t, 90 + n) for n, (u, k, t) in enumerate(end)]
    source, sink, marks = (str(tmp_path / n) for n in ("in", "out", "marks"))
    whole = spark.createDataFrame(rows + end, "user long, kind string, ts timestamp, id long")
    sinks.write_in_order(whole, source, ["ts", "id"], 3)
    live.run_once(both(live.ingest(spark, source, whole.schema, files_per_batch=1)), sink, marks)
    got = {(x["user"], x["id"], x["match"], x["delta"]) for x in spark.read.parquet(sink).collect() if x["user"] > 0}
    assert got == {(1, 0, 1, 4 * MINUTE), (2, 2, None, None), (3, 4, None, None)}


def test_duplicates_of_all_events_are_reported(spark, tmp_path):
    rows = [(k, 1, "click", p) for k, p in ((1, "b"), (2, "a"), (3, "b"), (4, None))] + [(5, 2, "view", "a"), (20, 3, "view", "a"), (7, None, "view", "c"), (8, None, "view", "c")]
    spark.createDataFrame(rows, "event_id long, user_id long, event_type string, props string").write.parquet(f"{tmp_path}/events.parquet")
    got = {tuple(x) for x in bindings.QUERIES["u4_all_duplicates"](spark, str(tmp_path)).collect()}
    assert got == {(1, "click", 4, "a,b"), (None, "view", 2, "c")}
