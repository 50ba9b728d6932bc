"""Learning exports: layout, replacement of cases, and what a crash leaves."""

import json
import os

import pytest

from framespool.sources import learning


def frames(spark, cases, tag="a", n=3):
    rows = [(c, 10 * c + e, c % 2, f"task {c % 2}", k, k / 10, tag) for c in cases for e in range(2) for k in range(n)]
    return spark.createDataFrame(rows, "case_id int, episode_id long, task_index int, task string, frame_index int, timestamp double, tag string")


def tags(spark, root):
    return {(x["file"], x["tag"]) for x in learning.read_export(spark, root).select("file", "tag").distinct().collect()}


def lines(root, name):
    with open(f"{root}/meta/{name}") as f:
        return [json.loads(x) for x in f]


def test_layout_and_replacement(spark, tmp_path):
    root = str(tmp_path / "export")
    learning.replace_cases(frames(spark, [1, 2]), root, 30)
    assert sorted(os.listdir(f"{root}/data/case-001")) == ["episode_000010.parquet", "episode_000011.parquet"] or "episode_000010.parquet" in os.listdir(f"{root}/data/case-001")
    learning.replace_cases(frames(spark, [2, 3], "b", 5).filter("episode_id <> 21"), root, 30)
    assert tags(spark, root) == {(f"data/case-00{c}/episode_0000{e}.parquet", t) for c, e, t in ((1, 10, "a"), (1, 11, "a"), (2, 20, "b"), (3, 30, "b"), (3, 31, "b"))}
    assert [(x["episode_chunk"], x["episode_index"], x["length"]) for x in lines(root, "episodes.jsonl")] == [(1, 10, 3), (1, 11, 3), (2, 20, 5), (3, 30, 5), (3, 31, 5)]
    assert lines(root, "tasks.jsonl") == [{"task_index": 0, "task": "task 0"}, {"task_index": 1, "task": "task 1"}]
    assert lines(root, "info.json") == [{"total_episodes": 5, "total_frames": 21, "total_chunks": 3, "fps": 30.0, "total_tasks": 2}]
    assert len(learning.read_export(spark, root, cases=[2]).inputFiles()) == 1
    assert not [x for x in os.listdir(f"{root}/{learning.STAGING}") if not x.startswith(".")]


@pytest.mark.parametrize("at", ["written", "marked", "half"])
def test_a_crash_leaves_the_old_or_the_new(spark, tmp_path, monkeypatch, at):
    """Before the mark the old cases stay; after it, the next reader finishes, also where half of the moves were done."""
    root = str(tmp_path / "export")
    learning.replace_cases(frames(spark, [1, 2]), root, 30)
    plain, moved = learning._Files.move, []

    def crash(self, *names):
        if at == "written" or (at == "marked" and not names[0].endswith(learning.READY)):
            raise KeyboardInterrupt
        return None

    def move(self, old, new):
        if new.startswith("data/"):
            moved.append(new)
            if at == "marked" or len(moved) > 1:
                raise KeyboardInterrupt
        return plain(self, old, new)

    if at == "written":
        monkeypatch.setattr(learning._Files, "mark", crash)
    monkeypatch.setattr(learning._Files, "move", move)
    with pytest.raises(KeyboardInterrupt):
        learning.replace_cases(frames(spark, [1, 2], "b"), root, 30)
    monkeypatch.undo()
    assert {t for _, t in tags(spark, root)} == {"a" if at == "written" else "b"}
    assert len(lines(root, "episodes.jsonl")) == 4 and {x for x in os.listdir(f"{root}/data") if not x.startswith(".")} == {"case-001", "case-002"}


def test_frames_without_a_stamp_are_left_out(spark):
    rows = [(1, 5, 100), (1, 6, None), (1, 7, 300), (2, 5, None), (2, 6, 10**9)]
    got = learning.learning_frames(spark.createDataFrame(rows, "e int, k int, ns long"), ["e"], "k", "ns").collect()
    assert sorted((x["e"], x["k"], x["frame_index"], x["timestamp"]) for x in got) == [(1, 5, 0, 0.0), (1, 7, 1, 2e-7), (2, 6, 0, 1.0)]
