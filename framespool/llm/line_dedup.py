"""Line dedup: two Bloom filters pick suspected repeats, and only those shuffle to be confirmed.

1. Every task hashes the keys of its lines (once per document) and lists the filter bits that it sees once and those of
   keys that it sees twice. The lists meet by slice of the filter: a bit that two lists name is a twice-seen bit.
2. The twice-seen filter goes to all tasks. It has EACH bits for every line, counted beforehand, and MOST_BITS at most,
   which bounds the broadcast. A line whose bits are all twice-seen is suspected: its key may lie in two documents. A
   fuller filter only suspects more; results stay exact.
3. Suspected keys are counted exactly, as text, and the document that keeps each is chosen; keys in at least
   `min_docs` documents lose their lines elsewhere.

A key is the line without ASCII white space at both ends, A-Z lower-cased; shorter keys than `min_chars` never count.
Cases: null and empty texts are one empty line. Each row counts as a document, repeated rows too; rows that share the
largest doc_id (nulls come first) all keep their lines. An empty table gives an empty result. Other columns are
ignored, or carried along by `carry`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import LOWER, SPACE, UPPER, arrow_batch, arrow_schema, keyed, map_rows, split_join, stored, table

MIN_CHARS, MIN_DOCS = 20, 3
#: Bits of each filter, least and most (128 MB), in slices of SLICE bits; bits and hashes a line.
LEAST_BITS, MOST_BITS, SLICE, EACH, HASHES = 1 << 22, 1 << 30, 1 << 20, 8, 3
BLANK, TO_LOWER = SPACE.encode(), bytes.maketrans(UPPER.encode(), LOWER.encode())


def line_keys(data: bytes, min_chars: int) -> dict[bytes, None]:
    """Distinct keys of the lines, in order; all in UTF-8, where white space and A-Z are single bytes."""
    out: dict[bytes, None] = {}
    for line in data.translate(TO_LOWER).split(b"\n"):
        if len(line) >= min_chars:
            key = line.strip(BLANK)
            if len(key) >= min_chars and (key.isascii() or len(key) >= 4 * min_chars or len(key.decode()) >= min_chars):
                out[key] = None
    return out


def _hash(keys: list[bytes]) -> np.ndarray:
    import xxhash

    return np.fromiter(map(xxhash.xxh3_64_intdigest, keys), np.uint64, len(keys))


def _bits(hashes: np.ndarray, bits: int) -> np.ndarray:
    """(HASHES, n) bit numbers by double hashing."""
    step = (hashes >> np.uint64(32)) | np.uint64(1)
    return np.stack([(hashes + np.uint64(k) * step) % np.uint64(bits) for k in range(HASHES)]).astype(np.int64)


def twice_seen(docs: DataFrame, min_chars: int, bits: int, slice_bits: int) -> np.ndarray:
    """The twice-seen filter as packed bits."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[np.ndarray] = []
        size = 0
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                for text in batch.slice(at, 256).column(0).to_pylist():
                    found.append(_hash(list(line_keys(text, min_chars))))
                    size += len(found[-1])
                if size >= 500_000:
                    yield listed(found)
                    found, size = [], 0
        if size:
            yield listed(found)

    def listed(found: list[np.ndarray]) -> pa.RecordBatch:
        hashes, counts = np.unique(np.concatenate(found), return_counts=True)
        once = np.unique(_bits(hashes, bits))
        twice = np.unique(_bits(hashes[counts > 1], bits))
        slices = np.unique(once // slice_bits)
        cut = lambda x: [(x[a:b] % slice_bits).astype(np.uint32).tobytes() for a, b in zip(np.searchsorted(x, slices * slice_bits), np.searchsorted(x, (slices + 1) * slice_bits))]
        return pa.RecordBatch.from_arrays(
            [pa.array(slices, pa.int32()), pa.array(cut(once), pa.binary()), pa.array(cut(twice), pa.binary())], names=["slice", "once", "twice"]
        )

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once: dict[int, np.ndarray] = {}
        twice: dict[int, np.ndarray] = {}
        for batch in batches:
            for row in batch.to_pylist():
                k = row["slice"]
                if k not in once:
                    once[k], twice[k] = np.zeros(slice_bits, bool), np.zeros(slice_bits, bool)
                seen = np.frombuffer(row["once"], np.uint32)
                twice[k][seen[once[k][seen]]] = True
                once[k][seen] = True
                twice[k][np.frombuffer(row["twice"], np.uint32)] = True
        if twice:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(twice), pa.int32()), pa.array([np.packbits(x).tobytes() for x in twice.values()], pa.binary())], names=["slice", "twice"]
            )

    slices = docs.select(F.col("text").cast("binary")).mapInArrow(scan, "slice int, once binary, twice binary").repartition("slice")
    out = np.zeros(bits // 8, np.uint8)
    for row in slices.mapInArrow(merge, "slice int, twice binary").toLocalIterator():  # bits in all, whatever the input
        at = row["slice"] * slice_bits // 8
        out[at : at + slice_bits // 8] = np.frombuffer(row["twice"], np.uint8)
    return out


def suspects(docs: DataFrame, seen: np.ndarray, min_chars: int, bits: int) -> DataFrame:
    """(key, doc_id, _d, _t) of each distinct key of a row whose bits are all twice-seen."""
    shared = docs.sparkSession.sparkContext.broadcast(seen)

    schema = f"key binary, doc_id {docs.schema['doc_id'].dataType.simpleString()}, _d bigint, _t bigint"
    out_schema = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                rows = batch.slice(start, 512).to_pylist()
                keys = [(key, row["doc_id"], row["_d"], row["_t"]) for row in rows for key in line_keys(row["text"], min_chars)]
                if not keys:
                    continue
                at = _bits(_hash([k[0] for k in keys]), bits)
                hit = (shared.value[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).all(axis=0)
                if hit.any():
                    yield arrow_batch([keys[k] for k in np.flatnonzero(hit)], out_schema)

    return docs.select(F.col("text").cast("binary"), "doc_id", "_d", "_t").mapInArrow(run, schema)


def filter_bits(docs: DataFrame) -> int:
    """EACH bits a line that is long enough to count at all, as a power of two within the bounds."""
    lines = docs.agg(F.sum(F.length("text") - F.length(F.replace(F.col("text"), F.lit("\n"), F.lit(""))) + 1)).first()[0] or 0
    return min(max(1 << (EACH * lines).bit_length(), LEAST_BITS), MOST_BITS)


def repeated_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, bits: int | None = None, slice_bits: int = SLICE) -> DataFrame:
    """(_d, _t, keys): the keys whose lines a row loses. docs: as keyed() gives them."""
    bits = bits or filter_bits(docs)
    found = stored(suspects(docs, twice_seen(docs, min_chars, bits, slice_bits), min_chars, bits))
    known = stored(found.groupBy("key").agg(F.count("*").alias("n"), F.max("doc_id").alias("last")).filter(F.col("n") >= min_docs))
    lost = split_join(found, known, ["key"], "n").filter(~F.col("doc_id").eqNullSafe(F.col("last")))
    return lost.groupBy("_d", "_t").agg(F.collect_set("key").alias("keys"))


def drop_repeated_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, carry: tuple[str, ...] = (), bits: int | None = None, slice_bits: int = SLICE) -> DataFrame:
    """doc_id, text (the lines that stay), n_lines, n_dropped, and the columns named in carry as the struct `rest`."""
    rest = F.struct(*carry) if carry else F.struct(F.lit(0).alias("none"))
    docs = keyed(docs.select("doc_id", "text", rest.alias("rest")), "rest")
    lost = repeated_lines(docs, min_chars, min_docs, bits, slice_bits)

    def rows(row: dict) -> list[tuple]:
        lines, gone = row["text"].split(b"\n"), set(row["keys"] or ())
        if not gone:
            return [(row["doc_id"], row["text"], len(lines), 0, row["rest"])]
        plain = row["text"].translate(TO_LOWER).split(b"\n")
        kept = [x for x, y in zip(lines, plain, strict=True) if y.strip(BLANK) not in gone]
        return [(row["doc_id"], b"\n".join(kept), len(lines), len(lines) - len(kept), row["rest"])]

    both = docs.join(lost, ["_d", "_t"], "left").select("doc_id", F.col("text").cast("binary"), "keys", "rest")
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, text string, n_lines bigint, n_dropped bigint, rest {docs.schema['rest'].dataType.simpleString()}"
    return map_rows(both, schema, rows, flush=1000)


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = drop_repeated_lines(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


QUERIES = {"op6_line_dedup": op6_line_dedup}
SQL = {
    "op6_line_dedup": f"""WITH l AS (SELECT doc_id, row_number() OVER () AS r, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
e AS (SELECT doc_id, r, unnest(lines) AS line, generate_subscripts(lines, 1) AS ord FROM l),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM e),
g AS (SELECT key, max(doc_id) AS last FROM k WHERE length(key) >= {MIN_CHARS} GROUP BY key HAVING count(DISTINCT r) >= {MIN_DOCS}),
j AS (SELECT k.doc_id, r, ord, line, g.key IS NOT NULL AND k.doc_id IS DISTINCT FROM g.last AS gone FROM k LEFT JOIN g ON k.key = g.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped, sha256(coalesce(string_agg(line, chr(10) ORDER BY ord) FILTER (NOT gone), '')) AS kept_sha256 FROM j GROUP BY doc_id, r"""
}
