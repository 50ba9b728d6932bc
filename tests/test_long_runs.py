"""Long episodes: the rows of the plain operators, over many parts of one episode."""

import random

import pytest
from pyspark.sql import functions as F

from framespool.operators import align, curate, long_runs, segment


@pytest.fixture(autouse=True)
def many_ranges(spark):
    """Ranges stay apart, however few rows they have, so that groups go over several."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.fixture(scope="module")
def frames(spark):
    """One episode with most rows, others of one row or two, equal stamps, nulls in the step."""
    r = random.Random(9)
    rows = [(0, k, r.randint(0, 3000), r.choice(["a", "a", "b", None])) for k in range(0, 2400, 1)]
    rows += [(k, k * 10 + j, r.randint(0, 50), r.choice(["a", None])) for k in range(1, 120) for j in range(r.randint(1, 4))]
    return spark.createDataFrame([x for x in rows if r.random() < 0.9], "clip long, frame long, us long, step string").cache()


def same(a, b, columns):
    assert sorted(map(tuple, a.select(*columns).collect()), key=str) == sorted(map(tuple, b.select(*columns).collect()), key=str)


def test_contiguity(spark, frames):
    columns = ("clip", "frame", "gap", "period", "contiguous", "drops")
    long = long_runs.contiguity(frames, "clip", ["us", "frame"], "us")
    same(long, align.contiguity(frames, "clip", ["us", "frame"], "us"), columns)


def test_nearest(spark, frames):
    master, other = frames.filter("frame % 3 = 0"), frames.filter("frame % 3 > 0")
    for tolerance in (0, 2, 10_000):
        same(*(m.nearest_match(master, other, "clip", "us", "frame", tolerance) for m in (long_runs, align)), ("clip", "time", "ident", "match", "delta"))
    same(*(m.nearest_match(master, other.limit(0), "clip", "us", "frame", 5) for m in (long_runs, align)), ("clip", "time", "ident", "match", "delta"))


def test_segments(spark, frames):
    for consecutive in (True, False):
        same(*(m.segments(frames, "clip", "frame", "step", consecutive) for m in (long_runs, segment)), ("clip", "frame", "segment"))


def test_one_episode_lies_in_many_parts(spark, frames):
    laid = long_runs.laid_out(frames, ["clip"], ["frame"])
    assert laid.filter("clip = 0").select("_part").distinct().count() >= 4
    assert laid.groupBy("_part").count().agg(F.max("count")).first()[0] < 0.4 * frames.count()


def test_ranges(spark, frames):
    r = random.Random(2)
    rows = [(k, r.choice([0, 0, 5]), s := r.randint(-5, 2400), s + r.choice([0, 3, 40, 5000])) for k in range(60)]
    ranges = spark.createDataFrame(rows, "n long, clip long, first long, last long")
    numbers = frames.select("clip", "frame")
    long = long_runs.ranges_to_frames(ranges, "clip", "first", "last", numbers, "frame", width=64)
    same(long, align.ranges_to_frames(ranges, "clip", "first", "last", numbers, "frame"), ("n", "clip", "frame"))
    with pytest.raises(Exception, match="bad range"):
        long_runs.ranges_to_frames(spark.createDataFrame([(1, 0, 5, 4)], ranges.schema), "clip", "first", "last", numbers, "frame").collect()


def test_medians(spark):
    r = random.Random(1)
    rows = [(k % 5 if k % 3 else 0, r.choice([None, r.randint(0, 99)])) for k in range(900)] + [(7, None)]
    df = spark.createDataFrame(rows, "g long, v long")
    got = {x["g"]: x["m"] for x in long_runs.medians(df, ["g"], "v", "m").collect()}
    assert got == {x["g"]: x["m"] for x in df.filter("v is not null").groupBy("g").agg(F.expr("percentile(v, 0.5)").alias("m")).collect()}


@pytest.mark.parametrize("k", [1, 3, 40, 5000])
def test_bounded_sample(spark, frames, k):
    same(*(m.bounded_sample(frames, "clip", ["us", "frame"], k) for m in (long_runs, curate)), ("clip", "frame"))
