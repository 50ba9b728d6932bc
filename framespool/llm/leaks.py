"""Benchmark decontamination by the q-gram lemma.

Both sides are normalised: lower case, runs of anything but letters and digits as one space, offsets kept. A piece is any
WINDOW characters in a row of an item, wherever they start. A piece of m characters that occurs in a document with at
most e edits shares at least m - q + 1 - q * e of its q-grams with it, on diagonals no further than e apart. So the
shared q-grams of an item, each indexed once, are sorted by band of diagonals (bands of 2e overlap by half, so any e
neighbouring diagonals lie in one band) and place in the item; where as many as the bound lie within a piece's length,
all pieces that hold them are aligned in the band: a leak is a region at `edits` edits or fewer from a piece. Regions of
one item that touch are reported as one.

The items are a stated set of queries against all documents. They go to the tasks in blocks of at most BLOCK_CHARS
characters, one pass over the documents a block, so what is broadcast is bounded however large the benchmark is.

Cases: null and empty texts have no leaks, null and empty items match nothing; items shorter than WINDOW are one piece
with edits in proportion, items of fewer than `shortest` normalised characters must occur whole, between gaps and without
edits. Repeated rows on either side are reported one by one. Null ids stay null. Empty tables give an empty result.
Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_batch, arrow_schema, stored, table

Q, WINDOW, EDITS, SHORTEST = 10, 72, 4, 30
BLOCK_CHARS, ROUND_HITS = 4_000_000, 4_000_000
_BASE = np.uint64(0x9E3779B97F4A7C15)
FILTER_BITS = 24


def _characters() -> np.ndarray:
    """For each code point of the basic plane: its lower-case letter or digit, or 0. Others count as letters."""
    out = np.zeros(0x10000, np.uint32)
    for c in range(0x10000):
        x = chr(c)
        if x.isalnum():
            low = x.lower()
            out[c] = ord(low) if len(low) == 1 else c
    return out


_TABLE: list[np.ndarray] = []


def normalised(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Characters (code points, 32 for a gap) and the offset of each in the text."""
    if not _TABLE:
        _TABLE.append(_characters())
    raw = np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), np.uint32)
    low = _TABLE[0][np.minimum(raw, 0xFFFF)]
    if raw.size and raw.max() > 0xFFFF:
        low = np.where(raw > 0xFFFF, raw, low)
    word = low > 0
    keep = word.copy()
    keep[1:] |= word[:-1]  # the first gap character behind a word stands for the gap
    places = np.flatnonzero(keep)
    return np.where(low[places] > 0, low[places], np.uint32(32)), places


def grams(chars: np.ndarray, q: int = Q) -> np.ndarray:
    """A 64-bit hash of each q-gram."""
    n = len(chars) - q + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    wide = chars.astype(np.uint64)
    with np.errstate(over="ignore"):
        for k in range(q):
            out = (out + wide[k : k + n]) * _BASE
        return out ^ (out >> np.uint64(29))


@dataclass
class Index:
    """A block of items and the places of their q-grams, sorted by hash."""

    pieces: list[tuple[int, int, np.ndarray]]  # item's number, 0, characters
    ids: list
    hashes: np.ndarray
    piece: np.ndarray
    at: np.ndarray
    seen: np.ndarray
    need: np.ndarray
    edits: np.ndarray
    length: np.ndarray
    short: dict[int, tuple[np.ndarray, np.ndarray]]  # by length: hashes of whole items, sorted, and the items' numbers


def index(items: list[tuple], q: int = Q, window: int = WINDOW, edits: int = EDITS, shortest: int = SHORTEST) -> Index:
    pieces, need, allowed, whole = [], [], [], {}
    for number, (_, text) in enumerate(items):
        chars, _ = normalised(text)
        if len(chars) and chars[-1] == 32:
            chars = chars[:-1]
        if len(chars) and chars[0] == 32:
            chars = chars[1:]
        if len(chars) < shortest:
            if len(chars):
                whole.setdefault(len(chars), []).append((grams(chars, len(chars))[0], number))
            continue
        size = min(len(chars), window)
        e = edits * size // window
        pieces.append((number, 0, chars))
        allowed.append(e)
        need.append(max(1, size - q + 1 - q * e))
    hashes = [grams(p[2], q) for p in pieces]
    sizes = [len(h) for h in hashes]
    flat = np.concatenate(hashes) if hashes else np.empty(0, np.uint64)
    order = np.argsort(flat, kind="stable")
    seen = np.zeros(1 << FILTER_BITS >> 3, np.uint8)
    bit = (flat >> np.uint64(64 - FILTER_BITS)).astype(np.int64)
    np.bitwise_or.at(seen, bit >> 3, np.left_shift(1, bit & 7).astype(np.uint8))
    at = np.concatenate([np.arange(s) for s in sizes]) if sizes else np.empty(0, np.int64)
    short = {size: (np.array([h for h, _ in found], np.uint64), np.array([n for _, n in found])) for size, found in ((k, sorted(v)) for k, v in whole.items())}
    return Index(
        pieces, [i for i, _ in items], flat[order], np.repeat(np.arange(len(sizes)), sizes)[order], at[order], seen,
        np.array(need, np.int64), np.array(allowed, np.int64), np.array([len(p[2]) for p in pieces], np.int64), short,
    )


def hits(known: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index in hashes, index in the sorted known) of all equal pairs."""
    lo = np.searchsorted(known, hashes, "left")
    n = np.searchsorted(known, hashes, "right") - lo
    return np.repeat(np.arange(len(hashes)), n), np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())


_FAR = 1 << 36  # makes diagonals positive


def candidates(known: Index, hashes: np.ndarray, most: int = ROUND_HITS) -> list[tuple[int, int, int, int]]:
    """(item's index, first diagonal of the band, least and greatest start of a piece) where pieces share enough q-grams
    with the text. A text with more than `most` pairs of equal q-grams is taken in stretches of text that overlap by more
    than a piece, so that what a piece can match lies in one of them."""
    bit = (hashes >> np.uint64(64 - FILTER_BITS)).astype(np.int64)
    places = np.flatnonzero(known.seen[bit >> 3] >> (bit & 7).astype(np.uint8) & 1)
    if not len(places) or not len(known.hashes):
        return []
    found = hashes[places]
    pairs = np.cumsum(np.searchsorted(known.hashes, found, "right") - np.searchsorted(known.hashes, found, "left"))
    if pairs[-1] <= most:
        return _stretch(known, places, found) if pairs[-1] else []
    out, first, reach = set(), 0, WINDOW + 2 * int(known.edits.max(initial=0)) + 1
    while first < len(places):
        last = max(np.searchsorted(pairs, (pairs[first - 1] if first else 0) + most, "right"), np.searchsorted(places, places[first] + 2 * reach))
        out.update(_stretch(known, places[first:last], found[first:last]))
        if last >= len(places):
            break
        first = int(np.searchsorted(places, places[last - 1] - reach))
    return sorted(out)


def _stretch(known: Index, places: np.ndarray, found: np.ndarray) -> list[tuple[int, int, int, int]]:
    """candidates() of the q-grams `found` at some places of a text."""
    k, hit = hits(known.hashes, found)
    if not len(hit):
        return []
    piece, at = known.piece[hit], known.at[hit]
    band = (places[k] - at + _FAR) // np.maximum(known.edits[piece], 1)
    # a hit lies in its own band of 2e diagonals and in the one that starts e earlier
    key, at = np.concatenate([piece * (1 << 40) + band, piece * (1 << 40) + band - 1]), np.tile(at, 2)
    order = np.lexsort((at, key))
    key, at = key[order], at[order]
    fresh = np.append(True, (key[1:] != key[:-1]) | (at[1:] != at[:-1]))  # one q-gram of an item counts once in a band
    key, at = key[fresh], at[fresh]
    piece = key >> 40
    span = np.minimum(known.length[piece], WINDOW) - Q
    last = np.arange(len(key)) + known.need[piece] - 1
    inside = np.minimum(last, len(key) - 1)
    keep = (last < len(key)) & (key[inside] == key) & (at[inside] - at <= span)
    if not keep.any():
        return []
    key, piece, span, least, most = key[keep], piece[keep], span[keep], at[inside][keep], at[keep]
    least, most = np.maximum(least - span, 0), np.minimum(most, known.length[piece] - span - Q)
    first = np.append(True, (key[1:] != key[:-1]) | (least[1:] > most[:-1] + 1))
    ends = np.append(np.flatnonzero(first)[1:], len(key)) - 1
    width = np.maximum(known.edits[piece], 1)
    diagonal = (key - (piece << 40)) * width - _FAR
    return [(int(p), int(d), int(a), int(b)) for p, d, a, b in zip(piece[first], diagonal[first], least[first], most[ends])]


def align(item: np.ndarray, text: np.ndarray, starts: np.ndarray, size: int, first: int, width: int, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Edits, start and end in the text of the best match of the pieces of `size` characters from each start of the item
    along diagonals first .. first + width; edits over `most` are no match. The text may start and end anywhere in the band."""
    columns, n = width + 1, len(text)
    lo, hi = int(starts[0]), int(starts[-1]) + size
    best, at = np.full(len(starts), size + 1), np.zeros(len(starts), np.int64)
    for d in range(first, first + columns):  # on a single diagonal: no edit or one is the best that there is
        place = np.arange(lo, hi) + d
        differ = (place < 0) | (place >= n)
        differ[~differ] = text[place[~differ]] != item[lo:hi][~differ]
        total = np.append(0, np.cumsum(differ))
        count = total[starts - lo + size] - total[starts - lo]
        whole = (starts + d >= 0) & (starts + d + size <= n)
        better = whole & (count < best)
        best[better], at[better] = count[better], starts[better] + d
    edits, begins, ends = best, at, at + size
    slow = np.flatnonzero(best > 1)
    for k in range(0, len(slow) if most else 0, 2048):
        some = slow[k : k + 2048]
        edits[some], begins[some], ends[some] = _banded(item, text, starts[some], size, first, columns, most)
    return edits, begins, ends


def _banded(item: np.ndarray, text: np.ndarray, starts: np.ndarray, size: int, first: int, columns: int, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One row a piece, one column a diagonal."""
    n, far = len(text), most + 1
    base = (starts + first)[:, None] + np.arange(columns)
    cost = np.minimum(np.where(base < 0, -base, np.where(base > n, far, 0)), far)
    begin = np.maximum(base, 0)
    edge = np.full((len(starts), 1), far)
    for k in range(size):
        place = base + k
        inside = (place >= 0) & (place < n)
        differ = text[np.clip(place, 0, n - 1)] != item[starts + k][:, None]
        match = np.where(inside, cost + differ, far)
        drop = np.hstack([cost[:, 1:] + 1, edge])  # the piece's character is missing in the text
        take = drop < match
        new = np.where(take, drop, match)
        origin = np.where(take, np.hstack([begin[:, 1:], 0 * edge]), begin)
        for j in range(1, columns):  # a character of the text too many
            more = (new[:, j - 1] + 1 < new[:, j]) & inside[:, j]
            new[:, j] = np.where(more, new[:, j - 1] + 1, new[:, j])
            origin[:, j] = np.where(more, origin[:, j - 1], origin[:, j])
        cost, begin = np.minimum(new, far), origin
        if cost.min() > most:
            break
    j, rows = cost.argmin(axis=1), np.arange(len(starts))
    return cost[rows, j], begin[rows, j], np.minimum(starts + first + size + j, n)


def find_leaks(known: Index, text: str | None) -> list[tuple[int, int, int, int]]:
    """(item's number, start, end, edits): regions of the text, in code points, that match pieces of items."""
    chars, places = normalised(text)
    spans: dict[int, list[tuple[int, int, int]]] = {}
    for size, (hashes, numbers) in known.short.items():
        at = grams(chars, size)
        for k, n in zip(*hits(hashes, at)):
            if (k == 0 or chars[k - 1] == 32) and (k + size == len(chars) or chars[k + size] == 32):
                spans.setdefault(int(numbers[n]), []).append((int(places[k]), int(places[k + size - 1]) + 1, 0))
    for piece, first, least, most in candidates(known, grams(chars)) if len(chars) >= Q else ():
        number, _, item = known.pieces[piece]
        e = int(known.edits[piece])
        edits, begins, ends = align(item, chars, np.arange(least, most + 1), min(len(item), WINDOW), first, 2 * max(e, 1), e)
        good = (edits <= e) & (ends > begins)
        if good.any():
            spans.setdefault(number, []).extend(zip(places[begins[good]].tolist(), (places[ends[good] - 1] + 1).tolist(), edits[good].tolist()))
    out = []
    for number, regions in spans.items():
        regions.sort()
        start, end, edits = regions[0]
        for s, t, e in regions[1:]:
            if s <= end:
                end, edits = max(end, t), max(edits, e)
            else:
                out.append((number, start, end, edits))
                start, end, edits = s, t, e
        out.append((number, start, end, edits))
    return out


def item_blocks(benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> Iterator[list[tuple]]:
    """The items in blocks of bounded size, one block on the driver at a time."""
    held, size = [], 0
    for row in benchmark.select("item_id", "text").toLocalIterator():
        text = row["text"] or ""
        if held and size + len(text) > block_chars:
            yield held
            held, size = [], 0
        held.append((row["item_id"], text))
        size += len(text)
    if held:
        yield held


def leaks(docs: DataFrame, benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(doc_id, item_id, start, end, edits) of every region of a document that matches a piece of an item.

    Blocks are done one after the other and stored, so the driver and the tasks hold one index at a time."""
    spark = docs.sparkSession
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, item_id {benchmark.schema['item_id'].dataType.simpleString()}, start int, end int, edits int"
    out_schema, out = arrow_schema(schema), spark.createDataFrame([], schema)
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    for block in item_blocks(benchmark, block_chars):
        shared = spark.sparkContext.broadcast(index(block))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            known = shared.value
            for batch in batches:
                for k in range(0, batch.num_rows, 256):
                    found = [(row["doc_id"], known.ids[n], *x) for row in batch.slice(k, 256).to_pylist() for n, *x in find_leaks(known, row["text"])]
                    if found:
                        yield arrow_batch(found, out_schema)

        out = out.unionByName(stored(docs.mapInArrow(run, schema)))
        shared.unpersist()
    return out


def without_leaks(docs: DataFrame, benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The rows of docs in whose text no piece of any item is found, whole; rows are judged by their text alone. All blocks
    but the last write what they keep, so the driver and the tasks hold one index at a time."""
    spark, before = docs.sparkSession, None
    for block in item_blocks(benchmark, block_chars):
        if before is not None:
            docs = stored(docs)
            before.unpersist()
        before = shared = spark.sparkContext.broadcast(index(block))
        docs = docs.filter(_clean(shared)(F.col("text").cast("string")))
    return docs


def _clean(shared: Broadcast):
    """Whether a text has no leak, as a function of a text column."""

    @F.pandas_udf("boolean")
    def clean(texts: pd.Series) -> pd.Series:
        return pd.Series([not find_leaks(shared.value, text) for text in texts], dtype=bool)

    return clean


def op2_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per contaminated document and item: number and characters of its regions, most edits in one."""
    found = leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.groupBy("doc_id", "item_id").agg(
        F.count("*").alias("n_regions"), F.sum((F.col("end") - F.col("start")).cast("long")).alias("n_chars"), F.min("start").alias("first_start"), F.max("edits").alias("most_edits")
    )


QUERIES = {"op2_leaks": op2_leaks}
SQL: dict[str, str] = {}
