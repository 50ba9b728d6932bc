"""Suffix-array dedup on UTF-8 bytes: remove every byte inside a repeated string of `length` bytes.

The suffix array is sparse: it holds the suffixes at content-defined anchors (repeats.py), of which every repeated
string has one at the same offset, and one suffix stands for all with equal contexts. Splitters sampled by Spark
range-partition the suffixes by their leading bytes; a bucket sorts its own by multikey quicksort, once forwards from
the centre's first byte and once backwards from the anchor, and compares neighbours. Since suffixes that agree on a
whole centre have the same leading bytes, splitters never part two that could match: what lies across a boundary
differs within the leading bytes.

With both sorted orders, a string that starts b bytes before an anchor repeats if another suffix shares length - b
bytes forwards (same run in the first order) and b bytes backwards (same run in the second).

Cases: null and empty texts have no bytes. Each row is a document, repeated rows too (so their bytes repeat); shorter
texts than `length` lose none. Cuts may fall inside a character; the text that stays is binary. A null doc_id stays
null. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import keyed, table
from .repeats import Shape, Tokens, covered, cut_spans

LENGTH, GRAM, SPAN = 400, 8, 256
_MIX = np.uint64(0xD6E8FEB86659FD93)


def bytes_of(data: bytes) -> Tokens:
    return data, None, None


def byte_grams(tokens: Tokens, first: int, last: int) -> np.ndarray:
    """32-bit hashes of the 8-byte grams that start at bytes [first, last)."""
    x = np.frombuffer(tokens[0], np.uint8)[first : last + GRAM - 1].astype(np.uint64)
    for size in (1, 2, 4):
        x = x[:-size] | (x[size:] << np.uint64(8 * size))
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(31))) * _MIX
        x = (x ^ (x >> np.uint64(29))) * _MIX
    return (x >> np.uint64(32)).astype(np.uint32)


def multikey_sort(rows: np.ndarray) -> np.ndarray:
    """Order of the rows (each a string as big-endian words) by multikey quicksort: three-way splits on one word at a
    time, the equal part going on with the next word."""
    order = np.arange(len(rows))
    todo = [(0, len(rows), 0)]
    while todo:
        lo, hi, depth = todo.pop()
        if hi - lo < 2 or depth == rows.shape[1]:
            continue
        part = order[lo:hi]
        key = rows[part, depth]
        if hi - lo <= 64:
            part = part[np.lexsort(rows[part, depth:].T[::-1])]
            order[lo:hi] = part
            continue
        pivot = np.partition(key, len(key) // 2)[len(key) // 2]
        less, more = key < pivot, key > pivot
        same = ~(less | more)
        a, b = lo + int(less.sum()), hi - int(more.sum())
        order[lo:hi] = np.concatenate([part[less], part[same], part[more]])
        todo += [(lo, a, depth), (a, b, depth + 1), (b, hi, depth)]
    return order


def _matrix(parts: list[bytes], width: int) -> np.ndarray:
    width += -width % 8
    return np.frombuffer(b"".join([p.ljust(width, b"\0") for p in parts]), np.uint8).reshape(len(parts), width)


def _neighbours(rows: np.ndarray, sizes: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Bytes that each row shares with the one before it in the order; 0 for the first."""
    out = np.zeros(len(order), np.int64)
    for k in range(1, len(order), 2048):
        a, b = order[k - 1 : k + 2047], order[k : k + 2048]
        a = a[: len(b)]
        differ = rows[a] != rows[b]
        same = np.where(differ.any(axis=1), differ.argmax(axis=1), rows.shape[1])
        out[k : k + len(b)] = np.minimum(same, np.minimum(sizes[a], sizes[b]))
    return out


def sweep(data: list[bytes], before: np.ndarray, shape: Shape) -> tuple[np.ndarray, np.ndarray]:
    """Most bytes to the left and right of the anchor that repeated strings of each context cover."""
    ahead = [d[b - shape.margin :] for d, b in zip(data, before)]
    behind = [d[:b][::-1] for d, b in zip(data, before)]
    n = len(data)
    left, right = np.zeros(n, np.int64), np.zeros(n, np.int64)
    shared, orders = [], []
    for parts, width in ((ahead, shape.margin + shape.right), (behind, shape.left)):
        rows, sizes = _matrix(parts, width), np.array([len(p) for p in parts])
        # rows are filled up with zeros, which texts may hold too: of rows equal so far, the shorter goes first
        order = multikey_sort(np.column_stack([rows.view(">u8").astype(np.uint64), sizes.astype(np.uint64)]))
        orders.append(order)
        shared.append(_neighbours(rows, sizes, order))
    size_ahead, size_behind = np.array([len(p) for p in ahead]) - shape.margin, np.array([len(p) for p in behind])
    run, group = np.empty(n, np.int64), np.empty(n, np.int64)
    for b in range(shape.margin, shape.left + 1):
        need = shape.length - b
        run[orders[0]] = np.cumsum(shared[0] < need + shape.margin)
        group[orders[1]] = np.cumsum(shared[1] < b)
        fit = np.flatnonzero((size_ahead >= need) & (size_behind >= b))
        if len(fit) < 2:
            continue
        key = run[fit] * (n + 1) + group[fit]
        by = np.argsort(key, kind="stable")
        sorted_ = key[by]
        twin = np.zeros(len(fit), bool)
        equal = sorted_[1:] == sorted_[:-1]
        twin[by[1:]] |= equal
        twin[by[:-1]] |= equal
        hit = fit[twin]
        left[hit] = b
        right[hit] = np.maximum(right[hit], need)
    return left, right


def remove_repeated_bytes(docs: DataFrame, length: int = LENGTH, span: int = SPAN) -> DataFrame:
    """doc_id, data (bytes that stay), n_bytes, n_removed, n_spans (maximal removed runs)."""
    docs = keyed(docs)
    shape = Shape(length, GRAM, span, (length - span + 1 - GRAM) // 2)
    spans = covered(docs, bytes_of, byte_grams, shape, sweep)

    def cut(tokens: Tokens, gone: np.ndarray) -> tuple:
        runs = int(np.count_nonzero(gone[1:] & ~gone[:-1]) + (len(gone) > 0 and gone[0]))
        return np.frombuffer(tokens[0], np.uint8)[~gone].tobytes(), len(gone), int(gone.sum()), runs

    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, data binary, n_bytes bigint, n_removed bigint, n_spans bigint"
    return cut_spans(docs, spans, bytes_of, cut, lambda data: (data, len(data), 0, 0), schema)


def op10_byte_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeated_bytes(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("data", 256).alias("kept_sha256"))


QUERIES = {"op10_byte_dedup": op10_byte_dedup}
SQL = {
    "op10_byte_dedup": f"""WITH d AS (SELECT doc_id, row_number() OVER () AS r, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT r, unnest(range(0, len(h) // 2 - {LENGTH - 1})) AS a, h FROM d WHERE len(h) >= {2 * LENGTH}),
k AS (SELECT r, a, md5(substr(h, 2 * a + 1, {2 * LENGTH})) AS m FROM w),
g AS (SELECT m FROM k GROUP BY m HAVING count(*) > 1),
i AS (SELECT r, a, CASE WHEN a <= lag(a) OVER (PARTITION BY r ORDER BY a) + {LENGTH} THEN 0 ELSE 1 END AS fresh FROM k SEMI JOIN g USING (m)),
s AS (SELECT r, a, sum(fresh) OVER (PARTITION BY r ORDER BY a) AS island FROM i),
runs AS (SELECT r, min(a) AS lo, max(a) + {LENGTH} AS hi FROM s GROUP BY r, island),
p AS (SELECT r, lo, hi, coalesce(lag(hi) OVER (PARTITION BY r ORDER BY lo), 0) AS since FROM runs),
c AS (SELECT p.r, string_agg(substr(h, 2 * since + 1, 2 * (lo - since)), '' ORDER BY lo) AS head, max(hi) AS last, count(*) AS n_spans, sum(hi - lo)::BIGINT AS removed FROM p JOIN d ON p.r = d.r GROUP BY p.r)
SELECT doc_id, len(h) // 2 AS n_bytes, coalesce(removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(head, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256 FROM d LEFT JOIN c ON d.r = c.r"""
}
