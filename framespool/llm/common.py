"""Shared helpers: tables, stored intermediate results, documents as Arrow batches, text digests."""

from __future__ import annotations

import hashlib
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.sinks import left_over

#: ASCII white space, as the word and line rules of the contracts name it.
SPACE = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
ASCII_LOWER = str.maketrans(UPPER, LOWER)
#: How many characters of text one round of numpy work looks at.
ROUND_CHARS = 1 << 20


#: Texts go to Python in batches of so many bytes, unless the session says otherwise than Spark's own 64 MB.
BATCH = "spark.sql.execution.arrow.maxBytesPerBatch", 64 << 20, 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    key, usual, small = BATCH
    if spark.conf.get(key).removesuffix("b") == str(usual):
        spark.conf.set(key, f"{small}b")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors see: spark.checkpoint.dir. Where it is unset a local session (tests) gets a temporary
    one; a cluster raises, since no machine's own folder would do."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext._jsc.sc()
    if not folder:
        if context.getCheckpointDir().isDefined():
            folder = context.getCheckpointDir().get()
        elif spark.sparkContext.master.startswith("local") and not spark.sparkContext.master.startswith("local-cluster"):
            folder = tempfile.mkdtemp(prefix="framespool-")
        else:
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        spark.conf.set("spark.checkpoint.dir", folder)
    if not context.getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(folder)
    return folder


#: Spark removes the shuffle files of a query as soon as the query is done.
_TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def tidy(spark: SparkSession):
    """Queries run here leave no shuffle files behind; only for those whose result is written before they end."""
    before = spark.conf.get(_TIDY, None)
    spark.conf.set(_TIDY, "true")
    try:
        yield
    finally:
        spark.conf.unset(_TIDY) if before is None else spark.conf.set(_TIDY, before)


def checkpointed(df: DataFrame) -> DataFrame:
    """Cuts the lineage with a reliable checkpoint; for narrow rows."""
    shared_dir(df.sparkSession)
    with tidy(df.sparkSession):
        return df.checkpoint()


def stored(df: DataFrame) -> DataFrame:
    """Writes df as a compressed table in the shared folder and reads it again; for many or wide rows."""
    path = f"{shared_dir(df.sparkSession)}/stored-{uuid.uuid4().hex}"
    with tidy(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.stored_at = path
    left_over(df.sparkSession, path)
    if _SCRATCH:
        _SCRATCH[-1].append(out)
    return out


_SCRATCH: list[list[DataFrame]] = []


@contextmanager
def scratch():
    """Tables stored in it are deleted at its end, when their result has been written."""
    _SCRATCH.append([])
    try:
        yield
    finally:
        made = _SCRATCH.pop()
        if made:
            discard(*made)


def discard(*tables: DataFrame) -> None:
    """Deletes stored tables that all their users have been computed from; disk then follows the largest step, not the
    sum."""
    spark = tables[0].sparkSession
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for t in tables:
        path = jvm.org.apache.hadoop.fs.Path(t.stored_at)
        path.getFileSystem(conf).delete(path, True)


def keyed(docs: DataFrame, *keep: str) -> DataFrame:
    """doc_id, text (null: empty) and a 128-bit key (_d, _t) of the two; rows equal in doc_id and text share it, so
    whatever is found for one holds for the other. A null doc_id is a value of its own.

    Other columns of docs stay out unless named in keep, so their names can't clash."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    both = (F.col("text"), F.col("doc_id"), F.col("doc_id").isNull())
    return docs.select("doc_id", text.alias("text"), *keep).select(
        "doc_id", "text", *keep, F.xxhash64(*both).alias("_d"), F.xxhash64(F.lit(1), *both).alias("_t")
    )


def split_join(rows: DataFrame, groups: DataFrame, keys: list[str], n: str, how: str = "inner", most: int = 100_000) -> DataFrame:
    """rows joined with groups (one row a key, n: how many of rows have it), inner, left or left_semi, groups' columns with
    them. A key with over `most` rows and over a thousandth of them all is dealt out to several tasks: of those there are
    fewer than a thousand, which is what is broadcast. groups is read more than once, so stored."""
    total = groups.agg(F.sum(n)).first()[0] or 0
    limit = max(most, total // 1000)
    mark = F.xxhash64(*keys)
    hot = groups.filter(F.col(n) > limit).select(mark.alias("_mark"), F.ceil(F.col(n) / limit).cast("int").alias("_parts"))
    if not hot.limit(1).count():
        return rows.join(groups, keys, how)
    hot = hot.groupBy("_mark").agg(F.max("_parts").alias("_parts"))
    dealt = lambda df: df.withColumn("_mark", mark).join(F.broadcast(hot), "_mark", "left").withColumn("_parts", F.coalesce("_parts", F.lit(1)))
    left = dealt(rows).withColumn("_part", F.pmod(F.xxhash64(*rows.columns), F.col("_parts")).cast("int")).drop("_mark", "_parts")
    right = dealt(groups).withColumn("_part", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1))).drop("_mark", "_parts")
    return left.join(right, [*keys, "_part"], how).drop("_part")


def free(df: DataFrame, name: str) -> str:
    """The name, or with so many underscores behind it that df has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def map_rows(
    df: DataFrame, schema: str, rows: Callable[[dict], Iterator[tuple] | list[tuple]], flush: int = 20_000
) -> DataFrame:
    """mapInArrow for a function that turns one row (a dict) into any number of tuples."""
    out_schema = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                for row in batch.slice(start, 64).to_pylist():
                    out.extend(rows(row))
                if len(out) >= flush:
                    yield arrow_batch(out, out_schema)
                    out = []
        if out:
            yield arrow_batch(out, out_schema)

    return df.mapInArrow(run, schema)


def arrow_schema(ddl: str) -> pa.Schema:
    """On the driver; the schema itself travels to the tasks."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(ddl))


def arrow_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def utf8(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def sha256(data: str | bytes) -> str:
    return hashlib.sha256(utf8(data) if isinstance(data, str) else data).hexdigest()
