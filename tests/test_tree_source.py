"""Frame trees on disk: what is pruned isn't listed or opened."""

import json
import os

import pytest

from framespool.sources import scans


@pytest.fixture(scope="module")
def root(tmp_path_factory):
    top = str(tmp_path_factory.mktemp("tree"))
    for dataset in ("online_a", "offline_b"):
        for clip in ("1", "2", "3"):
            os.makedirs(f"{top}/{dataset}/{clip}/time_syn")
            for frame in range(12):
                stamp = {"sec": frame, "nsec": int(clip)}
                doc = {"image_left_stamp": stamp, "Kinematics_set_1": {"ECM": {"measured_data": {"measured_js_stamp": stamp if frame % 2 else {"sec": 1}}}}}
                with open(f"{top}/{dataset}/{clip}/time_syn/{frame:06d}.json", "w") as f:
                    f.write(json.dumps(doc) if frame != 11 else "{not json")
    return top


def files_read(df):
    """How many files the scan opened."""
    df.write.format("noop").mode("overwrite").save()
    plan = df._jdf.queryExecution().executedPlan()
    df.collect()
    todo = [plan]
    while todo:
        node = todo.pop()
        if node.metrics().contains("numFiles"):
            return node.metrics().apply("numFiles").value()
        children = node.children()
        todo += [children.apply(k) for k in range(children.size())]
    raise AssertionError("no scan")


def test_only_wanted_files_are_opened(spark, root):
    whole = scans.read_tree(spark, root, "time_syn")
    assert whole.count() == 72 and len(whole.inputFiles()) == 72
    clip = scans.read_tree(spark, root, "time_syn", datasets=["online_a"], clips=["2", "3"])
    assert len(clip.inputFiles()) == 24
    few = scans.read_tree(spark, root, "time_syn", datasets=["online_a"], frames=(3, 6))
    assert files_read(few) == 12
    rows = scans.stamp_documents(few).select("dataset", "clip", "frame", "image_left", "ECM__measured_js").collect()
    assert sorted(map(tuple, rows)) == sorted(("online_a", c, k, k * 10**9 + int(c), k * 10**9 + int(c) if k % 2 else None) for c in "123" for k in range(3, 7))


def test_one_parse_a_document(spark, root):
    stamps = scans.stamp_documents(scans.read_tree(spark, root, "time_syn"))
    assert stamps.filter("frame = 11 AND image_left IS NULL").count() == 6
    assert stamps._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1
