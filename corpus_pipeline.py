"""Corpus pipeline: toxicity, line dedup, SimHash near-dedup, benchmark decontamination, SentencePiece encoding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which run() writes as Parquet in the shared folder and
reads again as the next one's docs. All but the last return the columns of docs.

Cases, besides those of the operators: a stage keeps the order of no row and the columns of docs, whatever they are
called; n_chars follows the text where both are there. Stages judge rows, not ids: null, repeated and clashing doc_ids
never take other rows along. Near-dedup keeps one row of each group, that of least doc_id, null ones only where the group
has no other, and one of rows that are alike in everything.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framespool.llm import leaks, line_dedup, pieces, simhash, toxicity
from framespool.llm.common import free, scratch, shared_dir, stored, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score is under 0.5, unchanged."""
    model = toxicity.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    name = free(docs, "_score")
    return docs.withColumn(name, toxicity.scorer(spark, model)(F.col("text").cast("string"))).filter(F.col(name) < 0.5).drop(name)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without its repeated lines; one that has lost all of its lines has empty text."""
    others = tuple(c for c in docs.columns if c != "text")
    done = line_dedup.drop_repeated_lines(docs, carry=others)
    new = {"text": F.col("text"), "n_chars": F.length("text").cast("long")}
    return done.select(*((new[c] if c in new else F.col("rest")[c]).alias(c) for c in docs.columns))


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (shingles of five words, similarity 0.8 or more) the document of least doc_id."""
    name = free(docs, "_row")
    docs = stored(docs.withColumn(name, F.monotonically_increasing_id()))
    row, doc_id = F.col(name).alias("row"), F.col("doc_id").alias("id")
    groups = simhash.near_groups(docs.select(row, "text"))
    first = F.struct(F.col("id").isNull(), "id", "row")
    kept = groups.join(docs.select(row, doc_id), "row").groupBy("group").agg(F.min_by("row", first).alias(name))
    return docs.join(kept.select(name), name, "left_semi").drop(name)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no passage of the benchmark was found."""
    return leaks.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256."""
    return pieces.encoded_digests(docs, pieces.model_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", dedup_lines),
    ("SimHash near-dedup", dedup_near),
    ("benchmark decontamination", decontaminate),
    ("SentencePiece encoding", encode),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        with scratch():
            stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return docs
