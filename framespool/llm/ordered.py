"""Work along the order of each group's rows, however long a group is.

Rows are dealt out by ranges of group and order, so a group may go over many tasks and small ones share a task. What
crosses from one range to the next (a number, a piece of text) is settled from one or two rows a range.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from .common import arrow_batch, arrow_schema, stored, utf8

#: Bytes of a piece of a group that goes on in another range.
PIECE = 1 << 20


def in_order(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.repartitionByRange(*keys).sortWithinPartitions(*keys)


def numbered(rows: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """rows with n (their number in their group's order, from 1) and n_rows (of the group); no null in group."""
    placed = stored(in_order(rows, [*group, *order]).withColumn("_at", F.monotonically_increasing_id()))
    placed = placed.withColumn("_part", F.shiftright("_at", 33))
    runs = placed.groupBy(*group, "_part").agg(F.min("_at").alias("_first"), F.count("*").alias("_rows"))
    whole = Window.partitionBy(*group)  # a row for each range that the group reaches into
    before = F.sum("_rows").over(whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.select(*group, "_part", (F.col("_first") - F.coalesce(before, F.lit(0)) - 1).alias("_zero"), F.sum("_rows").over(whole).alias("n_rows"))
    return placed.join(runs, [*group, "_part"]).withColumn("n", F.col("_at") - F.col("_zero")).drop("_part", "_at", "_zero")


def ordered_sha256(rows: DataFrame, group: list[str], order: list[str], piece: str, separator: str) -> DataFrame:
    """group and sha256: the digest of a group's pieces (strings) in order, joined by the separator. group may hold nulls.

    A group within one range is hashed there. Of others each range gives pieces of PIECE bytes, and one task runs over
    them: a digest needs all bytes in order, but that task holds one piece at a time."""
    glue = utf8(separator)
    keys = StructType([StructField(f.name, f.dataType) for f in rows.schema if f.name in group]).fields
    keys.sort(key=lambda f: group.index(f.name))
    names = [f.name for f in keys]
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in keys)
    first, second = f"{ddl}, at bigint, sha256 string, bytes binary", f"{ddl}, sha256 string"
    first_schema, second_schema = arrow_schema(first), arrow_schema(second)

    def batches_of(found: Iterator[tuple], schema: pa.Schema, size) -> Iterator[pa.RecordBatch]:
        out, weight = [], 0
        for row in found:
            out.append(row)
            weight += size(row)
            if weight > 1 << 22:
                yield arrow_batch(out, schema)
                out, weight = [], 0
        if out:
            yield arrow_batch(out, schema)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        part, seq = TaskContext.get().partitionId() << 33, 0
        at, held, weight, whole = None, [], 0, False
        for key, text in _rows(batches, names, piece):
            if key != at:
                if whole:
                    yield *at, None, hashlib.sha256(glue.join(held)).hexdigest(), None
                elif held:
                    yield *at, part | seq, None, glue.join(held)
                    seq += 1
                whole = at is not None  # the first group of a range may have begun in another
                at, held, weight = key, [], 0
            held.append(utf8(text))
            weight += len(held[-1]) + 1
            if weight > PIECE:
                yield *at, part | seq, None, glue.join(held)
                seq += 1
                held, weight, whole = [], 0, False
        if held:
            yield *at, part | seq, None, glue.join(held)

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        at, digest = None, None
        for key, data in _rows(batches, names, "bytes"):
            if key != at:
                if digest:
                    yield *at, digest.hexdigest()
                at, digest = key, hashlib.sha256(data)
            else:
                digest.update(glue)
                digest.update(data)
        if digest:
            yield *at, digest.hexdigest()

    dealt = in_order(rows, [*names, *order]).select(*names, piece)
    made = stored(dealt.mapInArrow(lambda b: batches_of(pieces(b), first_schema, lambda row: 200 + len(row[-1] or b"")), first))
    rest = made.filter("bytes is not null").select(*names, "at", "bytes").repartition(*names).sortWithinPartitions(*names, "at")
    rest = rest.mapInArrow(lambda b: batches_of(joined(b), second_schema, lambda row: 200), second)
    return made.filter("sha256 is not null").select(*names, "sha256").unionByName(rest)


def _rows(batches: Iterator[pa.RecordBatch], names: list[str], value: str) -> Iterator[tuple[tuple, object]]:
    for batch in batches:
        for start in range(0, batch.num_rows, 64):
            part = batch.slice(start, 64)
            yield from zip(zip(*(part.column(c).to_pylist() for c in names), strict=True), part.column(value).to_pylist(), strict=True)

