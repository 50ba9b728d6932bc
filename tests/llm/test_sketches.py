"""Document fingerprints: the whole query against a plain restatement, peeling, odd tables."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from framespool.llm import sketches
from framespool.llm.common import utf8

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
COLUMNS = ("doc_id", "n_chars", "edited_sha256", "near_edited", "near_next")


@pytest.fixture(autouse=True)
def many_ranges(spark):
    """Ranges stay apart, however few rows they have, so that groups go over several."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def sha(text):
    return hashlib.sha256(utf8(text)).hexdigest()


def likeness(a, b):
    a, b = (Counter(sketches.paragraphs(utf8(t))) for t in (a, b))
    return (a & b).total() / (a | b).total() if a or b else 1.0


def expected(rows):
    held = sorted(((d, t or "") for d, t, *_ in rows), key=lambda x: (x[0] is not None, x[0] or 0, hashlib.md5(utf8(x[1])).digest()))
    out = []
    for k, (doc_id, text) in enumerate(held):
        after = held[(k + 1) % len(held)][1]
        cut = len(text) // 4
        edited = text[: len(text) - cut] + after[:cut]
        out.append((doc_id, len(text), sha(edited), likeness(text, edited), likeness(text, after)))
    return out


def prose(r, n):
    return "".join("".join(r.choice("aeiouéßnrst") for _ in range(r.randint(2, 8))) + r.choice(["\n", ". ", " ", " ", " ", " "]) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    r = random.Random(4)
    texts = [prose(r, r.choice([1, 3, 12, 60, 400])) for _ in range(90)]
    texts += texts[:9] + [t + " more" for t in texts[:9]] + [None, "", "\n" * 50, "x" * 3000, "same line\n" * 200, "日本語テキスト" * 40, prose(r, 20_000), "é"]
    return [(k if k % 13 else None, t, "en", "s", 0) for k, t in enumerate(texts)] + [(7, texts[7], "en", "s", 0)] * 30 + [(-4, None, None, None, None)]


def same(df, columns, want):
    got = sorted((tuple(x[c] for c in columns) for x in df.collect()), key=str)
    assert got == sorted(want, key=str)


def test_sketches(spark, tmp_path, rows):
    spark.createDataFrame(rows, DOCUMENTS).repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    made = sketches.op12_sketches(spark, str(tmp_path))
    same(made, COLUMNS, expected(rows))
    prints = {}
    for x in made.join(spark.createDataFrame(rows, DOCUMENTS).selectExpr("doc_id", "coalesce(text, '') as text").distinct(), "doc_id").groupBy("doc_id").agg({"text": "count", "fingerprint": "collect_set"}).collect():
        prints[x["doc_id"]] = x["collect_set(fingerprint)"]
    assert all(len(p) == 1 for d, p in prints.items() if d is not None)
    assert prints[7 + 90] == prints[7] and prints[1] != prints[2]


@pytest.mark.parametrize("n", [1, 2])
def test_sketches_of_few_documents_among_other_columns(spark, n):
    rows = [(1, "one two three four five six\nseven eight"), (2, "word " * 2_000_000)][:n]
    clash = spark.createDataFrame([(*x, 0, "", 0, "") for x in rows], "doc_id long, text string, part int, edge string, salt long, successor string")
    same(sketches.with_successors(clash), COLUMNS, expected(rows))
    assert sketches.with_successors(clash.limit(0)).count() == 0


def test_peeling_recovers_what_differs():
    r = np.random.default_rng(2)
    shared, a, b = (r.integers(0, 1 << 63, k, dtype=np.uint64) for k in (500, 5, 3))
    keys, owner = np.concatenate([shared, a, shared, b]), np.repeat([0, 1], [505, 503])
    number, digest, check = sketches.sketched(keys, owner, 2, 24)
    found, _, done = sketches.peeled(number[:1] - number[1:], digest[:1] ^ digest[1:], check[:1] ^ check[1:])
    assert done.all() and sorted(np.concatenate(found).tolist()) == sorted([*a.tolist(), *b.tolist()])


def test_failed_peelings_are_retried_larger():
    r = np.random.default_rng(3)
    sizes = [0, 1, 40, 3000, 3000]
    keys, owner = r.integers(0, 1 << 63, sum(sizes), dtype=np.uint64), np.repeat(np.arange(5), sizes)
    keys[-1000:] = keys[-4000:-3000]
    apart = sketches.differing(keys, owner, np.array([0, 0, 1, 3, 3]), np.array([0, 2, 2, 4, 3]))
    assert apart.tolist() == [0, 40, 41, 4000, 0]
    twice = np.array([5, 5, 6], np.uint64)
    assert sketches.differing(twice, np.array([0, 0, 1]), np.array([0]), np.array([1])).tolist() == [3]


def test_paragraphs_join_to_the_text():
    r = random.Random(1)
    for text in ("", "\n", " a  b\n\n", prose(r, 500), "x" * 99):
        assert b"".join(sketches.paragraphs(utf8(text))) == utf8(text)
