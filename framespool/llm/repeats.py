"""Which tokens of a text lie in a stretch of `length` tokens that also starts anywhere else, over all documents.

Shared by the word and the byte operator, which differ in their tokens and in how contested places are settled.

1. Anchors. Of any `span` neighbouring grams inside a stretch, the one with the least hash is an anchor, so equal
   stretches have equal anchors at equal offsets, and about two in `span` tokens are anchors. Only anchors shuffle.
2. An anchor's centre (the tokens that all stretches with that anchor share) must occur twice, or nothing repeats there.
   With `doubling`, centres that do are extended to twice their length, once to the left and once to the right, and go on
   only if one of the two occurs twice again: every stretch holds one of them.
3. An anchor's context holds all its stretches. Equal contexts are counted before anything is compared: where one
   occurs twice, all of its stretches repeat, and however many copies there are, one row stands for them.
4. Only centres with several contexts are contested. One context each goes to the task that holds its centre, or, for
   centres with more than `crowd` contexts, its stretches are hashed, by ranges first, and counted by aggregations.
5. Per document, the covered tokens are cut out.

Contents are told apart by 128 bits: the hashes of centre and context together, or that of a range or a stretch. Contested
contexts of centres that are not crowded are compared byte by byte.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_batch, arrow_schema, discard, split_join, stored

BLOCK = 1 << 18
CROWD = 1000
#: In place of a hash where there is none.
NONE = np.int64(0)


@dataclass(frozen=True)
class Shape:
    """length = margin + (span - 1) + gram + the right margin."""

    length: int
    gram: int
    span: int
    margin: int
    doubling: bool = False

    @property
    def centre(self) -> int:
        """Tokens of the centre."""
        return self.margin + self.after

    @property
    def left(self) -> int:
        """Most tokens before the anchor in a stretch."""
        return self.margin + self.span - 1

    @property
    def right(self) -> int:
        """Most tokens from the anchor on."""
        return self.length - self.margin

    @property
    def after(self) -> int:
        """Tokens of the centre from the anchor on."""
        return self.length - self.left


#: A text as tokens: the bytes, the start and end of each token in them, and a 32-bit hash of each gram.
Tokens = tuple[bytes, np.ndarray | None, np.ndarray | None]
Split = Callable[[bytes], Tokens]
Grams = Callable[[Tokens, int, int], np.ndarray]


def _slide(x: np.ndarray, width: int, pick) -> np.ndarray:
    """pick (np.minimum or np.maximum) over each `width` neighbours."""
    size, at = 1, x
    while size * 2 <= width:
        at = pick(at[:-size], at[size:])
        size *= 2
    return pick(at[: len(x) - width + 1], at[width - size :]) if width > size else at


def anchors(tokens: Tokens, n: int, grams: Grams, shape: Shape) -> np.ndarray:
    """Positions of the anchors of all stretches of a text of n tokens."""
    found = []
    for first in range(0, n - shape.length + 1, BLOCK):
        stretches = min(BLOCK, n - shape.length + 1 - first)
        h = grams(tokens, first + shape.margin, first + shape.margin + stretches + shape.span - 1)
        least = _slide(h, shape.span, np.minimum)
        around = np.zeros(len(least) + 2 * (shape.span - 1), least.dtype)
        around[shape.span - 1 : shape.span - 1 + len(least)] = least
        most = _slide(around, shape.span, np.maximum)
        found.append(np.flatnonzero(most == h) + first + shape.margin)
    return np.unique(np.concatenate(found)) if found else np.empty(0, np.int64)


def edges(tokens: Tokens) -> tuple[Callable[[int], int], Callable[[int], int]]:
    _, starts, ends = tokens
    if starts is None:
        return (lambda k: k), (lambda k: k)
    return (lambda k: int(starts[k])), (lambda k: int(ends[k - 1]))


def count(tokens: Tokens) -> int:
    return len(tokens[0]) if tokens[1] is None else len(tokens[1])


def anchor_table(docs: DataFrame, split: Split, grams: Grams, shape: Shape) -> DataFrame:
    """(centre, context, _d, _t, pos) of every anchor; with doubling also (before, behind), hashes of the centre with as many
    tokens again to the left or right, null where the text has fewer."""
    names = ["centre", "context", *(("before", "behind") if shape.doubling else ()), "_d", "_t", "pos"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                for row in batch.slice(at, 64).to_pylist():
                    tokens = split(row["text"])
                    n = count(tokens)
                    places = anchors(tokens, n, grams, shape) if n >= shape.length else ()
                    if len(places):
                        parts.append((*hashes(tokens, n, places), row["_d"], row["_t"], places))
                        size += len(places)
                if size >= 100_000:
                    yield batch_of(parts)
                    parts, size = [], 0
        if parts:
            yield batch_of(parts)

    def hashes(tokens: Tokens, n: int, places: np.ndarray) -> tuple[np.ndarray, ...]:
        data = tokens[0]
        if tokens[1] is None:
            at, end = (lambda x: x), (lambda x: x)
        else:
            at, end = (lambda x: tokens[1][x]), (lambda x: tokens[2][x - 1])
        digest = xxhash.xxh3_64_intdigest
        c0, c1 = at(places - shape.margin).tolist(), end(places + shape.after).tolist()
        lo, hi = np.maximum(places - shape.left, 0), np.minimum(places + shape.right, n)
        w0, w1, rel = at(lo).tolist(), end(hi).tolist(), (places - lo).tolist()
        centre = np.fromiter((digest(data[a:b]) for a, b in zip(c0, c1)), np.uint64, len(places))
        context = np.fromiter((digest(data[a:b], r) for a, b, r in zip(w0, w1, rel)), np.uint64, len(places))
        if not shape.doubling:
            return centre.view(np.int64), context.view(np.int64)
        wide = []
        for lo, hi in ((places - shape.margin - shape.centre, places + shape.after), (places - shape.margin, places + shape.after + shape.centre)):
            fits = (lo >= 0) & (hi <= n)
            name = np.zeros(len(places), np.uint64)
            a, b = at(lo[fits]).tolist(), end(hi[fits]).tolist()
            name[fits] = np.fromiter((digest(data[x:y]) for x, y in zip(a, b)), np.uint64, len(a))
            wide.append(np.where(fits, name.view(np.int64), NONE))
        return centre.view(np.int64), context.view(np.int64), *wide

    def batch_of(parts: list) -> pa.RecordBatch:
        sizes = [len(p[0]) for p in parts]
        columns = [np.concatenate([p[k] for p in parts]) for k in range(len(names) - 3)]
        columns += [np.repeat(np.array([p[k] for p in parts], np.int64), sizes) for k in (-3, -2)]
        columns.append(np.concatenate([p[-1] for p in parts]).astype(np.int32))
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)

    schema = ", ".join(f"{c} {'int' if c == 'pos' else 'bigint'}" for c in names)
    return docs.select(_raw(), "_d", "_t").mapInArrow(run, schema)


def doubled(table: DataFrame) -> DataFrame:
    """The anchors whose centre occurs twice at twice its length, to the left or to the right. Names are counted with the
    centre, so they have 128 bits."""
    sides = F.explode(F.array(F.struct(F.lit(False).alias("right"), F.col("before").alias("name")), F.struct(F.lit(True).alias("right"), F.col("behind").alias("name")))).alias("x")
    names = table.select("centre", sides).select("centre", "x.*").filter(F.col("name") != int(NONE))
    again = stored(names.groupBy("centre", "right", "name").agg(F.count("*").alias("n")).filter("n > 1"))
    out = table
    for right, name in ((False, "before"), (True, "behind")):
        known = again.filter(F.col("right") == right).select("centre", F.col("name").alias(name), "n", F.lit(True).alias(f"in_{name}"))
        out = split_join(out, known, ["centre", name], "n", "left").drop("n")
    out = stored(out.filter("in_before OR in_behind").select("centre", "context", "_d", "_t", "pos"))
    discard(again)
    return out


#: Contested contexts of whole centres: rows of (bytes, tokens before the anchor); gives (left, right) covered, or (0, 0).
Settle = Callable[[list[bytes], np.ndarray, Shape], tuple[np.ndarray, np.ndarray]]
ROUND = 8192


def covered(docs: DataFrame, split: Split, grams: Grams, shape: Shape, settle: Settle, crowd: int = CROWD) -> DataFrame:
    """(_d, _t, spans): per row of docs with anything to cut, spans of (pos, left, right): tokens [pos-left, pos+right).

    docs: as keyed() gives them."""
    first = stored(anchor_table(docs, split, grams, shape))
    twice = stored(first.groupBy("centre").agg(F.count("*").alias("n")).filter("n > 1"))
    table = stored(split_join(first, twice, ["centre"], "n", "left_semi"))
    discard(first, twice)
    if shape.doubling:
        short, table = table, doubled(table)
        discard(short)
    distinct = stored(table.groupBy("centre", "context").agg(F.count("*").alias("n"), F.min(F.struct("_d", "_t", "pos")).alias("at")))
    known = stored(distinct.filter("n > 1").select("centre", "context", "n"))
    whole = F.struct("pos", F.lit(shape.left).alias("left"), F.lit(shape.right).alias("right")).alias("span")
    settled = stored(split_join(table, known, ["centre", "context"], "n", "left_semi").select("_d", "_t", whole))
    discard(table, known)
    contested = stored(
        distinct.groupBy("centre").agg(F.count("*").alias("contexts"), F.min("n").alias("least")).filter("contexts > 1 AND least = 1").select("centre", "contexts")
    )
    chosen = split_join(distinct, contested, ["centre"], "contexts").select("at.*", "centre", "n", "contexts")
    wanted = chosen.groupBy("_d", "_t").agg(F.collect_list(F.struct("pos", "centre", "n", "contexts")).alias("wanted"))
    texts = stored(_contexts(docs.select(_raw(), "_d", "_t").join(wanted, ["_d", "_t"]), split, shape))
    discard(distinct, contested)
    few = stored(_settle_few(texts.filter(F.col("contexts") <= crowd), shape, settle))
    many = stored(_settle_many(texts.filter(F.col("contexts") > crowd), split, shape))
    discard(texts)
    return settled.unionByName(few).unionByName(many).groupBy("_d", "_t").agg(F.collect_set("span").alias("spans"))


_TEXTS = "_d bigint, _t bigint, pos int, centre bigint, contexts bigint, once boolean, before int, lead binary, data binary"


def _contexts(rows: DataFrame, split: Split, shape: Shape) -> DataFrame:
    """The bytes of the wanted contexts; lead: the first of the centre's."""

    schema = arrow_schema(_TEXTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for batch in batches:
            for k in range(0, batch.num_rows, 16):
                for row in batch.slice(k, 16).to_pylist():
                    tokens = split(row["text"])
                    n, (at, end) = count(tokens), edges(tokens)
                    for x in row["wanted"]:
                        p = x["pos"]
                        lo, hi, c = max(p - shape.left, 0), min(p + shape.right, n), at(p - shape.margin)
                        out.append((row["_d"], row["_t"], p, x["centre"], x["contexts"], x["n"] == 1, p - lo, tokens[0][c : c + 12], tokens[0][at(lo) : end(hi)]))
                if len(out) >= 10_000:
                    yield arrow_batch(out, schema)
                    out = []
        if out:
            yield arrow_batch(out, schema)

    return rows.mapInArrow(run, _TEXTS)


_SPAN = "_d bigint, _t bigint, span struct<pos:int,left:int,right:int>"


def _spans(rows: list[tuple]) -> pa.RecordBatch:
    kind = pa.struct([("pos", pa.int32()), ("left", pa.int32()), ("right", pa.int32())])
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()), pa.array([dict(zip(("pos", "left", "right"), r[2:])) for r in rows], kind)],
        names=["_d", "_t", "span"],
    )


def _settle_few(texts: DataFrame, shape: Shape, settle: Settle) -> DataFrame:
    """Sampled splitters deal the contexts out by leading bytes and centre; a bucket holds whole centres, which are
    all that its contexts can agree with, and takes them in rounds of about ROUND."""
    parts = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for batch in batches:
            for k in range(0, batch.num_rows, 1024):
                held += batch.slice(k, 1024).to_pylist()
                if len(held) >= ROUND:
                    last = held[-1]["centre"]
                    cut = len(held)
                    while cut and held[cut - 1]["centre"] == last:
                        cut -= 1
                    if cut:
                        yield from done(held[:cut])
                        held = held[cut:]
        if held:
            yield from done(held)

    def done(rows: list[dict]) -> Iterator[pa.RecordBatch]:
        left, right = settle([r["data"] for r in rows], np.array([r["before"] for r in rows]), shape)
        out = [(r["_d"], r["_t"], r["pos"], int(a), int(b)) for r, a, b in zip(rows, left, right) if r["once"] and b]
        if out:
            yield _spans(out)

    return texts.repartitionByRange(parts, "lead", "centre").sortWithinPartitions("lead", "centre").mapInArrow(run, _SPAN)


#: Ranges of offsets that a crowded centre's stretches are judged in first.
RANGES = 16


def _settle_many(texts: DataFrame, split: Split, shape: Shape) -> DataFrame:
    """For crowded centres, by plain aggregations over hashes. A stretch is named by how far before the anchor it
    starts, and stretches are judged by ranges of such offsets: where what a range's stretches have together occurs
    once, none of them repeats; where all that they cover occurs twice, each does. Only ranges between the two are
    judged stretch by stretch, together with one context for each range that is settled and may hold their twins."""
    step = -(-shape.span // RANGES)
    keys = ["_d", "_t", "pos"]

    def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 512):
                out = []
                for row in batch.slice(k, 512).to_pylist():
                    tokens, b = split(row["data"]), row["before"]
                    n, (at, end), data = count(tokens), edges(tokens), tokens[0]
                    for low in range(shape.margin, shape.left + 1, step):
                        high = min(low + step - 1, shape.left)
                        if max(low, b - (n - shape.length)) > min(high, b):
                            continue  # no stretch of this range fits in the text
                        inner = xxhash.xxh3_128_digest(data[at(b - low) : end(b + shape.length - high)], low)
                        whole = None
                        if b >= high and b + shape.length - low <= n:
                            whole = xxhash.xxh3_128_digest(data[at(b - high) : end(b + shape.length - low)], low)
                        out.append((row["_d"], row["_t"], row["pos"], low, high, inner, whole))
                if out:
                    yield arrow_batch(out, range_schema)

    def single(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 128):
                out = []
                for row in batch.slice(k, 128).to_pylist():
                    tokens, b = split(row["data"]), row["before"]
                    n, (at, end), data = count(tokens), edges(tokens), tokens[0]
                    for low in row["lows"]:
                        for o in range(max(low, b - (n - shape.length)), min(low + step - 1, shape.left, b) + 1):
                            out.append((xxhash.xxh3_128_digest(data[at(b - o) : end(b - o + shape.length)], o), row["_d"], row["_t"], row["pos"], o))
                if out:
                    yield arrow_batch(out, single_schema)

    range_ddl, single_ddl = "_d bigint, _t bigint, pos int, low int, high int, inner binary, whole binary", "stretch binary, _d bigint, _t bigint, pos int, before int"
    range_schema, single_schema = arrow_schema(range_ddl), arrow_schema(single_ddl)
    span = lambda a, b: F.struct("pos", F.col(a).alias("left"), (shape.length - F.col(b)).alias("right")).alias("span")
    rows = stored(texts.mapInArrow(ranges, range_ddl))
    whole = stored(rows.filter("whole IS NOT NULL").groupBy("whole").agg(F.count("*").alias("n")).filter("n > 1").select("whole", F.lit(True).alias("all_repeat")))
    inner = stored(rows.groupBy("inner").agg(F.count("*").alias("n")).filter("n > 1").select("inner"))
    judged = stored(rows.join(inner, "inner", "left_semi").join(whole, "whole", "left"))
    discard(rows, whole, inner)
    hit, left = judged.filter("all_repeat"), judged.filter("all_repeat IS NULL")
    open_ = stored(left.select("inner").distinct())
    twins = hit.join(open_, "inner", "left_semi").groupBy("whole", "low").agg(F.min(F.struct(*keys)).alias("at")).select("at.*", "low")
    lows = stored(left.select(*keys, "low").unionByName(twins).groupBy(*keys).agg(F.collect_set("low").alias("lows")))
    singles = stored(texts.select(*keys, "before", "data").join(lows, keys).mapInArrow(single, single_ddl))
    discard(open_, lows)
    twice = stored(singles.groupBy("stretch").agg(F.count("*").alias("n")).filter("n > 1").select("stretch"))
    return hit.select("_d", "_t", span("high", "low")).unionByName(singles.join(twice, "stretch", "left_semi").select("_d", "_t", span("before", "before")))


def cut_spans(docs: DataFrame, spans: DataFrame, split: Split, cut: Callable[[Tokens, np.ndarray], tuple], whole: Callable[[bytes], tuple], schema: str) -> DataFrame:
    """doc_id and what cut() gives for each row of docs with spans, and whole() for others; cut gets the text as tokens
    and which of them are covered, whole the text's bytes."""
    out_schema = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                rows = batch.slice(k, 256).to_pylist()
                if rows:
                    yield arrow_batch([(row["doc_id"], *(cut(*marked(row)) if row["spans"] else whole(row["text"]))) for row in rows], out_schema)

    def marked(row: dict) -> tuple[Tokens, np.ndarray]:
        tokens = split(row["text"])
        n = count(tokens)
        step = np.zeros(n + 1, np.int32)
        for s in row["spans"]:
            step[max(s["pos"] - s["left"], 0)] += 1
            step[min(s["pos"] + s["right"], n)] -= 1
        return tokens, np.cumsum(step[:n]) > 0

    return docs.join(spans, ["_d", "_t"], "left").select("doc_id", _raw(), "spans").mapInArrow(run, schema)


def _raw():
    return F.col("text").cast("binary").alias("text")
