"""Toxicity by multiple-instance learning: a document is a bag of sentences, and only documents carry labels.

A sentence's probability is a logistic function of its word features; the document's is their noisy-or,
1 - product(1 - p). Training fits the sentence model through the noisy-or to document labels, so no sentence needs a
label, and the fitted model then names the sentences that make a document toxic.

Training reads a bounded sample of labelled rows (MAX_TOXIC toxic, MAX_CLEAN others, the first in hash order; whole texts,
those over MAX_CHARS characters stay out); rows whose crc32(doc_id) mod 5 is 0 are held out. Scoring covers every sentence of every text. Features come from the text
alone: distinct words of a sentence, their first four and five and last four letters.

Cases: null and empty texts have no sentence and score 0. Rows are scored one by one, repeated or not; null labels and
labels without a document are left out of training; a doc_id with several labels is taken as toxic if any says so.
Without any label of either kind the model says 0 for all. Other columns are ignored. An empty table gives an empty
result.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_rows, table

MAX_TOXIC, MAX_CLEAN, MAX_CHARS = 1200, 2400, 50_000
ROUNDS, RATE, L2, KEEP, CERTAIN = 100, 0.1, 2e-4, 6000, 3.5
SENTENCE = re.compile(r"[^.!?\n]+[.!?]*")
WORD = re.compile(r"\w+")


def features(sentence: str) -> set[str]:
    words = set(WORD.findall(sentence.lower()))
    return words | {"<" + w[:4] for w in words if len(w) > 4} | {"<" + w[:5] for w in words if len(w) > 5} | {w[-4:] + ">" for w in words if len(w) > 4}


@dataclass
class Model:
    """Feature weights of the sentence model; bias is the log-odds of a sentence without known features."""

    weights: dict[str, float]
    bias: float

    def sentence(self, text: str) -> float:
        return 1 / (1 + np.exp(-self._logit(text)))

    def _logit(self, text: str) -> float:
        get, total = self.weights.get, self.bias
        for w in set(WORD.findall(text.lower())):
            total += get(w, 0.0)
            if len(w) > 4:
                total += get("<" + w[:4], 0.0) + get(w[-4:] + ">", 0.0)
                if len(w) > 5:
                    total += get("<" + w[:5], 0.0)
        return max(-30.0, min(30.0, total))

    def document(self, text: str | None) -> float:
        """Noisy-or of the sentences; 0 without any."""
        return self.judged(text)[0]

    def judged(self, text: str | None) -> tuple[float, str]:
        """The document's score and its offending sentences (even odds or more) as start:end, comma-joined."""
        logits, spans = [], []
        for m in SENTENCE.finditer(text or ""):
            if not m[0].isspace():
                logits.append(self._logit(m[0]))
                if logits[-1] >= 0:
                    spans.append(f"{m.start()}:{m.end()}")
        return float(-np.expm1(-np.logaddexp(0, np.array(logits)).sum())) if logits else 0.0, ",".join(spans)

    def sentences(self, text: str | None, least: float = 0.5) -> list[tuple[int, int, float]]:
        """(start, end, score) of the offending sentences."""
        spans = [(m.start(), m.end(), float(self.sentence(m[0]))) for m in SENTENCE.finditer(text or "") if not m[0].isspace()]
        return [s for s in spans if s[2] >= least]


def fit(rows: list[tuple[str, int]]) -> Model:
    """rows: (text, label)."""
    y = np.array([label for _, label in rows], dtype=float)
    if not len(y) or y.min() == y.max():
        return Model({}, -30.0)
    names = _informative(rows, y)
    index = {f: k for k, f in enumerate(names)}
    cols, starts, owner = [], [], []
    for d, (text, _) in enumerate(rows):
        for sentence in bag(text):
            starts.append(len(cols))
            owner.append(d)
            cols.extend(index[f] for f in sorted(sentence & index.keys()))
    cols, starts, owner = (np.array(x, dtype=np.int64) for x in (cols, starts, owner))
    row = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(cols))))
    w, bias = np.zeros(len(names)), -5.0
    moment, square = np.zeros(len(names) + 1), np.zeros(len(names) + 1)
    for step in range(1, ROUNDS + 1):
        z = np.clip(bias + np.bincount(row, w[cols], minlength=len(starts)), -30, 30)
        p = 1 / (1 + np.exp(-z))
        none = np.bincount(owner, np.logaddexp(0, z), minlength=len(y))  # -log(1 - P)
        clean = np.exp(-none)
        pull = np.where(y == 1, -clean / np.maximum(1 - clean, 1e-9), 1.0)  # d loss / d none
        g = np.clip(pull[owner], -1e4, 1e4) * p / len(y)
        grad = np.append(np.bincount(cols, g[row], minlength=len(names)) + L2 * w, g.sum())
        moment, square = 0.9 * moment + 0.1 * grad, 0.99 * square + 0.01 * grad**2
        move = RATE * (moment / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
        w, bias = w - move[:-1], bias - move[-1]
    return Model({f: float(x) for f, x in zip(names, w) if abs(x) > 1e-3}, float(bias))


def bag(text: str | None) -> Iterator[set[str]]:
    """The features of each sentence; made anew when needed, since those of all sentences would fill the memory."""
    return (features(m[0]) for m in SENTENCE.finditer(text or "") if not m[0].isspace())


def _informative(rows: list[tuple[str, int]], y: np.ndarray) -> list[str]:
    """The features whose share of toxic documents differs from their share of others by CERTAIN standard errors or
    more; the KEEP most different."""
    count = {1: Counter(), 0: Counter()}
    for text, label in rows:
        count[label].update(set().union(*bag(text)))
    n1, n0 = y.sum(), len(y) - y.sum()
    score = {}
    for f in count[1].keys() | count[0].keys():
        a, b = count[1][f], count[0][f]
        if a + b >= 4:
            share = (a + b) / (n1 + n0)
            z = abs(a / n1 - b / n0) / np.sqrt(share * (1 - share) * (1 / n1 + 1 / n0) + 1e-12)
            if z >= CERTAIN:
                score[f] = z
    return sorted(score, key=lambda f: (-score[f], f))[:KEEP]


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, max_toxic: int = MAX_TOXIC, max_clean: int = MAX_CLEAN, max_chars: int = MAX_CHARS) -> Model:
    """A model of a bounded sample of the labelled rows that aren't held out."""
    known = (
        labels.filter("toxic IS NOT NULL AND doc_id IS NOT NULL").filter(~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    )
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    picked = known.filter("toxic = 1").orderBy(*order).limit(max_toxic).unionByName(known.filter("toxic = 0").orderBy(*order).limit(max_clean))
    short = docs.select("doc_id", F.col("text").cast("string").alias("text")).filter(F.coalesce(F.length("text"), F.lit(0)) <= max_chars)
    rows = short.join(F.broadcast(picked), "doc_id").orderBy("doc_id", "text").limit(2 * (max_toxic + max_clean)).collect()  # rows and characters are bounded
    return fit([(r["text"] or "", int(r["toxic"] > 0)) for r in rows])


def scorer(spark: SparkSession, model: Model):
    """The document score as a function of a text column; other columns stay where they are."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series([shared.value.document(t) for t in texts], dtype=float)

    return score


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score and the offending sentences (offending: start:end in code points, comma-joined)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("score double, offending string")
    def judge(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([shared.value.judged(t) for t in texts], columns=["score", "offending"])

    return docs.select("doc_id", judge(F.col("text").cast("string")).alias("_x")).select("doc_id", "_x.score", "_x.offending")


def offending_sentences(docs: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """(doc_id, start, end, score) of every sentence that scores `least` or more; offsets are code points."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_rows(
        docs.select("doc_id", "text"), f"doc_id {kind}, start int, end int, score double", lambda row: [(row["doc_id"], *s) for s in shared.value.sentences(row["text"], least)]
    )


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = score_documents(docs, train(docs, table(spark, sf_dir, "labels")))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "offending")


QUERIES = {"op7_toxicity": op7_toxicity}
SQL: dict[str, str] = {}
