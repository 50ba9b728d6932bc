"""Document fingerprints: invertible Bloom lookup sketches of a document's paragraphs.

A paragraph is a line, its newline included; long ones are cut behind words chosen by their last letters (about one in
eight), so an edit changes the pieces that it touches and no others. A sketch files each paragraph's digest (the k-th equal
one with its k) in one cell of each of three rows: a number, the digests' exclusive or, and that of their checks. Two
sketches subtract cell by cell; what both hold cancels out, and peeling cells that hold one digest recovers all in which
they differ. Where it fails, both sides are sketched again, GROWTH times as large, until it succeeds. Likeness is the share
of both documents' paragraphs (Jaccard, repeats counted) that they have in common, exact once the peeling is through.

The fingerprint is the number of paragraphs and the smallest sketch, as hex digits. Documents are dealt out by ranges of their
order, so a document's successor is in its task, or first in the next: one or two texts a range are joined afterwards.

Order: doc_id, nulls first, then MD5 of the text; equal rows follow each other.

Cases: a null text is empty. Two empty texts have likeness 1. The only document's successor is itself. An empty table gives
an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import ROUND_CHARS, arrow_batch, arrow_schema, sha256, stored, table, utf8
from .ordered import in_order

ROWS, CELLS, GROWTH = 3, 12, 4
CUT = 8
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_OUT = "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double"


def mixed(x: np.ndarray, seed: int) -> np.ndarray:
    x = (x ^ np.uint64(seed * int(_B) & (1 << 64) - 1)) * _A
    x = (x ^ x >> np.uint64(32)) * _B
    return x ^ x >> np.uint64(29)


def paragraphs(text: bytes) -> list[bytes]:
    """The text in pieces; joined they give it back."""
    codes = np.frombuffer(text, np.uint8)
    if not len(codes):
        return []
    ends = np.flatnonzero((codes == 32) | (codes == 10))
    letters = np.zeros(len(ends), np.uint64)
    for k in (1, 2, 3):
        letters = letters * np.uint64(257) + codes[np.maximum(ends - k, 0)]
    ends = ends[(codes[ends] == 10) | (mixed(letters, 1) % np.uint64(CUT) == 0)] + 1
    bounds = np.concatenate([[0], ends, [len(codes)]]).tolist()
    return [text[a:b] for a, b in zip(bounds, bounds[1:], strict=False) if b > a]


def digests(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Digests of all texts' paragraphs, the k-th equal one of a text with its k, and which text each is of."""
    parts = [paragraphs(t) for t in texts]
    owner = np.repeat(np.arange(len(texts)), [len(p) for p in parts])
    keys = np.fromiter((xxhash.xxh3_64_intdigest(x) for p in parts for x in p), np.uint64, len(owner))
    order = np.lexsort((keys, owner))
    new = np.concatenate([[True], (keys[order][1:] != keys[order][:-1]) | (owner[order][1:] != owner[order][:-1])]) if len(keys) else np.zeros(0, bool)
    starts = np.flatnonzero(new)
    nth = np.empty(len(keys), np.uint64)
    nth[order] = np.arange(len(keys)) - np.repeat(starts, np.diff(np.append(starts, len(keys))))
    return keys + nth * _A, owner


def places(keys: np.ndarray, cells: int) -> list[np.ndarray]:
    """A cell of each row for each key."""
    width = cells // ROWS
    return [(mixed(keys, cells + row) % np.uint64(width)).astype(np.int64) + row * width for row in range(ROWS)]


def sketched(keys: np.ndarray, owner: np.ndarray, texts: int, cells: int) -> list[np.ndarray]:
    """Numbers, digests and checks of each text's cells, as three (texts, cells) arrays."""
    number, digest, check = np.zeros(texts * cells, np.int64), np.zeros(texts * cells, np.uint64), np.zeros(texts * cells, np.uint64)
    checks = mixed(keys, 0)
    for at in places(keys, cells):
        at = at + owner * cells
        number += np.bincount(at, minlength=texts * cells)
        np.bitwise_xor.at(digest, at, keys)
        np.bitwise_xor.at(check, at, checks)
    return [x.reshape(texts, cells) for x in (number, digest, check)]


def peeled(number: np.ndarray, digest: np.ndarray, check: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
    """Of subtracted sketches, a row each: the recovered digests with their rows, and whether each row came to nothing."""
    n, cells = number.shape
    number, digest, check = (x.ravel().copy() for x in (number, digest, check))
    keys, rows = [], []
    todo = np.flatnonzero(np.abs(number) == 1)
    while len(todo):
        todo = todo[(np.abs(number[todo]) == 1) & (mixed(digest[todo], 0) == check[todo])]
        row = todo // cells
        order = np.lexsort((digest[todo], row))
        todo, row = todo[order], row[order]
        key, sign = digest[todo], number[todo]
        one = np.ones(len(todo), bool)
        one[1:] = (key[1:] != key[:-1]) | (row[1:] != row[:-1])
        key, row, sign = key[one], row[one], sign[one]
        keys.append(key)
        rows.append(row)
        touched = []
        for at in places(key, cells):
            at = at + row * cells
            np.subtract.at(number, at, sign)
            np.bitwise_xor.at(digest, at, key)
            np.bitwise_xor.at(check, at, mixed(key, 0))
            touched.append(at)
        todo = np.unique(np.concatenate(touched))
    rest = (number.reshape(n, cells) != 0) | (digest.reshape(n, cells) != 0)
    return keys, rows, ~rest.any(axis=1)


def differing(keys: np.ndarray, owner: np.ndarray, a: np.ndarray, b: np.ndarray, sketch: list[np.ndarray] | None = None) -> np.ndarray:
    """How many digests texts a[k] and b[k] don't share; sketch: of all texts, CELLS each."""
    out, open_, cells = np.zeros(len(a), np.int64), np.arange(len(a)), CELLS
    while len(open_):
        used, at = np.unique(np.concatenate([a[open_], b[open_]]), return_inverse=True)
        if cells != CELLS or sketch is None:
            mine = np.isin(owner, used)
            made = sketched(keys[mine], np.searchsorted(used, owner[mine]), len(used), cells)
        else:
            made = [x[used] for x in sketch]
        left, right = at[: len(open_)], at[len(open_) :]
        _, rows, done = peeled(made[0][left] - made[0][right], made[1][left] ^ made[1][right], made[2][left] ^ made[2][right])
        found = np.bincount(np.concatenate([*rows, np.zeros(0, np.int64)]).astype(np.int64), minlength=len(open_))
        out[open_[done]] = found[done]
        open_, cells = open_[~done], cells * GROWTH
        if cells > 64 * (len(keys) + CELLS):  # two paragraphs of one digest: they never come apart
            for k in open_:
                sides = [np.unique(keys[owner == x], return_counts=True) for x in (a[k], b[k])]
                count = dict(zip(*(x.tolist() for x in sides[0]), strict=True))
                for key, n in zip(*(x.tolist() for x in sides[1]), strict=True):
                    count[key] = count.get(key, 0) - n
                out[k] = sum(map(abs, count.values()))
            break
    return out


def printed(n: np.ndarray, sketch: list[np.ndarray]) -> list[bytes]:
    number, digest, check = sketch[0].astype("<u4"), sketch[1].astype("<u8"), (sketch[2] & np.uint64(0xFFFFFFFF)).astype("<u4")
    return [int(n[k]).to_bytes(4, "little") + number[k].tobytes() + digest[k].tobytes() + check[k].tobytes() for k in range(len(n))]


def compared(ids: list[int | None], texts: list[str]) -> list[tuple]:
    """A row for each text but the last; each one's successor is the next."""
    n = len(texts) - 1
    edited = [t[: len(t) - len(t) // 4] + texts[k + 1][: len(t) // 4] for k, t in enumerate(texts[:n])]
    keys, owner = digests([utf8(t) for t in texts + edited])
    size = np.bincount(owner, minlength=2 * n + 1)
    sketch = sketched(keys, owner, 2 * n + 1, CELLS)
    prints = printed(size, sketch)
    here = np.arange(n)
    a, b = np.concatenate([here, here]), np.concatenate([here + n + 1, here + 1])
    apart, both = differing(keys, owner, a, b, sketch), size[a] + size[b]
    near = np.where(both > 0, (both - apart) / np.maximum(both + apart, 1), 1.0).tolist()
    return [(ids[k], len(texts[k]), sha256(edited[k]), prints[k], prints[n + 1 + k], near[k], near[n + k]) for k in range(n)]


def with_successors(docs: DataFrame) -> DataFrame:
    """The columns of _OUT (fingerprints as hex digits): each document compared with its edited text and with its successor."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.unhex(F.md5(text)).alias("mark"), F.monotonically_increasing_id().alias("salt"), text.alias("text"))
    schema = f"{_OUT}, part int, edge string, text string"
    out_schema, pair_schema = arrow_schema(schema), arrow_schema(_OUT)
    nothing = (None,) * 6

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, ids, texts, chars = TaskContext.get().partitionId(), [], [], 0
        for batch in batches:
            for start in range(0, batch.num_rows, 16):
                few = batch.slice(start, 16)
                for doc_id, text in zip(few.column("doc_id").to_pylist(), few.column("text").to_pylist(), strict=True):
                    if not texts:
                        yield arrow_batch([(doc_id, *nothing, part, "first", text)], out_schema)
                    ids.append(doc_id)
                    texts.append(text)
                    chars += len(text)
                    if len(texts) > 1 and (chars > ROUND_CHARS or len(texts) > 2000):
                        yield arrow_batch([(*x, None, None, None) for x in compared(ids, texts)], out_schema)
                        ids, texts, chars = ids[-1:], texts[-1:], len(text)
        if len(texts) > 1:
            yield arrow_batch([(*x, None, None, None) for x in compared(ids, texts)], out_schema)
        if texts:
            yield arrow_batch([(ids[-1], *nothing, part, "last", texts[-1])], out_schema)

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 16):
                for x in batch.slice(start, 16).to_pylist():
                    yield arrow_batch(compared([x["doc_id"], None], [x["text"], x["successor"]]), pair_schema)

    made = stored(in_order(rows, ["doc_id", "mark", "salt"]).select("doc_id", "text").mapInArrow(run, schema))
    whole = Window.orderBy("part")  # a row for each range that isn't empty
    parts = made.filter("edge = 'first'").select("part")
    ring = parts.select("part", F.coalesce(F.lead("part").over(whole), F.first("part").over(whole.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("follow"))
    last = made.filter("edge = 'last'").select("part", "doc_id", "text").join(ring, "part")
    first = made.filter("edge = 'first'").select(F.col("part").alias("follow"), F.col("text").alias("successor"))
    names = [f.name for f in pair_schema]
    out = made.filter("edge is null").select(*names).unionByName(last.join(first, "follow").select("doc_id", "text", "successor").mapInArrow(pairs, _OUT))
    return out.withColumns({c: F.lower(F.hex(c)) for c in ("fingerprint", "edited_fingerprint")})


def op12_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_successors(table(spark, sf_dir, "documents"))


QUERIES = {"op12_sketches": op12_sketches}
SQL: dict[str, str] = {}
