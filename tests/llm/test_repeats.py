"""Repeated words and bytes against brute force, crowded centres included."""

import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from framespool.llm import byte_dedup, repeats, word_dedup
from framespool.llm.common import keyed, split_join
from framespool.llm.repeats import Shape, covered, cut_spans


def brute(rows, length, of, join):
    """(n, removed, kept) of each row."""
    seqs = [of(t or "") for t in rows]
    seen = Counter(tuple(s[i : i + length]) for s in seqs for i in range(len(s) - length + 1))
    out = []
    for s in seqs:
        gone = [False] * len(s)
        for i in range(len(s) - length + 1):
            if seen[tuple(s[i : i + length])] > 1:
                gone[i : i + length] = [True] * length
        out.append((len(s), sum(gone), join(x for x, g in zip(s, gone) if not g)))
    return out


def texts(seed, n=60, words=("a", "bb", "ccc", "d", "é")):
    r = random.Random(seed)
    shared = [[r.choice(words) for _ in range(r.randint(5, 60))] for _ in range(4)]
    out = [None, "", " \t\n", "x", "a a a a a a a a a a a a a a a a a a a a a a a a a a a a a a"]
    for _ in range(n):
        parts = []
        for _ in range(r.randint(0, 4)):
            parts += r.choice(shared) if r.random() < 0.6 else [r.choice(words) + str(r.randint(0, 50)) for _ in range(r.randint(1, 30))]
        if parts and r.random() < 0.5:
            parts[r.randrange(len(parts))] = "edit" + str(r.randint(0, 9))
        out.append(r.choice([" ", "\n", "  "]).join(parts))
    return out + out[6:12]


@pytest.mark.parametrize("seed,crowd", [(1, 1000), (2, 2), (3, 1)])
def test_words(spark, seed, crowd):
    rows = texts(seed)
    length, gram = 12, 4
    docs = keyed(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string"))
    spans = covered(docs, word_dedup.words_of, lambda t, a, b: word_dedup.word_grams(t, a, b, gram), Shape(length, gram, length - gram + 1, 0, doubling=seed < 3), word_dedup.double_up, crowd)
    got = {}
    cut = lambda tokens, gone: (" ".join(w.decode() for w, g in zip(tokens[0].split(b" "), gone) if not g), len(gone), int(gone.sum()))
    for r in cut_spans(docs, spans, word_dedup.words_of, cut, lambda d: (b" ".join(d.split()), len(d.split()), 0), "doc_id long, text string, n long, removed long").collect():
        got[r[0]] = (r[2], r[3], r[1])
    assert got == dict(enumerate(brute(rows, length, lambda t: t.split(), " ".join)))


@pytest.mark.parametrize("seed,crowd", [(4, 1000), (5, 2), (6, 1)])
def test_bytes(spark, seed, crowd):
    rows = texts(seed, 40) + ["z" * 300, "z" * 90]
    length, span = 60, 20
    docs = keyed(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string"))
    shape = Shape(length, byte_dedup.GRAM, span, (length - span + 1 - byte_dedup.GRAM) // 2)
    spans = covered(docs, byte_dedup.bytes_of, byte_dedup.byte_grams, shape, byte_dedup.sweep, crowd)
    cut = lambda tokens, gone: (bytes(x for x, g in zip(tokens[0], gone) if not g), len(gone), int(gone.sum()))
    got = {r[0]: (r[2], r[3], bytes(r[1])) for r in cut_spans(docs, spans, byte_dedup.bytes_of, cut, lambda d: (d, len(d), 0), "doc_id long, data binary, n long, removed long").collect()}
    assert got == dict(enumerate(brute(rows, length, lambda t: t.encode(), bytes)))


@pytest.mark.parametrize("crowd", [1000, 1])
def test_bytes_of_texts_that_begin_or_end_with_nul(spark, crowd):
    """Rows are sorted filled up with zeros; a text's own zeros are no filling."""
    r = random.Random(8)
    passages = ["".join(map(r.choice, ["abc"] * 60)) for _ in range(6)]
    rows = ["\0" * r.randint(0, 12) + t + "\0" * r.randint(0, 12) for t in passages for _ in range(8)]
    length, span = 60, 20
    docs = keyed(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string"))
    shape = Shape(length, byte_dedup.GRAM, span, (length - span + 1 - byte_dedup.GRAM) // 2)
    spans = covered(docs, byte_dedup.bytes_of, byte_dedup.byte_grams, shape, byte_dedup.sweep, crowd)
    cut = lambda tokens, gone: (bytes(x for x, g in zip(tokens[0], gone) if not g), len(gone), int(gone.sum()))
    got = {r[0]: (r[2], r[3], bytes(r[1])) for r in cut_spans(docs, spans, byte_dedup.bytes_of, cut, lambda d: (d, len(d), 0), "doc_id long, data binary, n long, removed long").collect()}
    assert got == dict(enumerate(brute(rows, length, lambda t: t.encode(), bytes)))


def test_defaults_on_odd_tables(spark):
    passage = " ".join(f"word{k}" for k in range(80))
    rows = [(1, passage, 0), (2, "before " + passage, 0), (None, passage, 0), (3, None, 0), (3, None, 0), (4, "short", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _d int")
    words = {(r["doc_id"], r["n_words"]): (r["n_removed"], r["text"]) for r in word_dedup.remove_repeated_words(docs).collect()}
    assert words[1, 80] == (80, "") and words[2, 81] == (80, "before") and words[None, 80] == (80, "") and words[4, 1] == (0, "short") and words[3, 0] == (0, "")
    data = byte_dedup.remove_repeated_bytes(docs).collect()
    assert {(r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"]) for r in data if r["doc_id"] == 2} == {(2, len("before " + passage), len(passage), 1)}
    assert word_dedup.remove_repeated_words(docs.limit(0)).count() == 0 and byte_dedup.remove_repeated_bytes(docs.limit(0)).count() == 0


def test_multikey_sort():
    import numpy as np

    r = random.Random(7)
    rows = [bytes(r.choice(b"ab") for _ in range(16)) for _ in range(500)]
    order = byte_dedup.multikey_sort(np.frombuffer(b"".join(rows), ">u8").reshape(-1, 2).astype(np.uint64))
    assert [rows[k] for k in order] == sorted(rows)


def test_same_rows_twice_and_digest(spark):
    text = " ".join(f"w{k}" for k in range(40))
    docs = spark.createDataFrame([(1, text), (1, text)], "doc_id long, text string")
    assert [r["n_removed"] for r in word_dedup.remove_repeated_words(docs).collect()] == [40, 40]
    assert hashlib.sha256(b"").hexdigest() == hashlib.sha256("".encode()).hexdigest() and repeats.CROWD > 1


@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
def test_hot_keys_are_dealt_out_without_loss(spark, how):
    """One key has half of the rows, some have none on the other side; repeated rows stay repeated."""
    r = random.Random(4)
    rows = spark.createDataFrame([(0 if k % 2 else r.randrange(20), k % 50) for k in range(600)], "key int, v int")
    groups = rows.filter("key < 15").groupBy("key").count().withColumnRenamed("count", "n").withColumn("w", F.col("key") * 2)
    want = rows.join(groups, ["key"], how)
    got = split_join(rows, groups, ["key"], "n", how, most=10)
    assert got.columns == want.columns and sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    assert "_part" in got._jdf.queryExecution().toString()
