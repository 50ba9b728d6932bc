"""Embedding near-dedup by lattice hashing.

Vectors are scaled to length one. A table projects them at random into 8 dimensions and decodes the nearest point of
the E8 lattice; vectors of one label that decode to the same point, or whose point is among the PROBES nearest
neighbouring lattice points of the other's projection, meet and are compared by cosine in double precision. Several
tables with projections of their own catch what one cell boundary parts.

Vectors that are equal count as one node with a multiplicity, so a crowd of copies stays one row. A cell with more
than BLOCK vectors is dealt out as pairs of blocks, so no task holds a cell of unknown size. Every vector travels with its
cells in the tables so far, so a pair is counted in the first place where it meets and nowhere else; a cell then reports
the number of new links of each of its vectors and a forest of them, never the pairs.

Cases: null labels, and vectors that are null, empty, zero or hold null or non-finite components, link with nothing
but get their row. Vectors of different length never link. Repeated rows (equal vec_id too) are vectors of their own
for n_links. A null vec_id is counted as a link but never names a component unless all in it are null. An empty table
gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_schema, discard, split_join, stored, table
from .components import components

COSINE = 0.93
TABLES, PROBES, SCALE, SEED = 12, 6, 3.0, 7
BLOCK = 512


def decode_e8(x: np.ndarray) -> np.ndarray:
    """Nearest E8 points of the rows of x, doubled so that they are whole numbers."""
    return np.where((_cost(x, a := _decode_d8(x)) <= _cost(x, b := _decode_d8(x - 0.5) + 0.5))[:, None], a, b).astype(np.float64) * 2


def _cost(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return ((x - y) ** 2).sum(axis=1)


def _decode_d8(x: np.ndarray) -> np.ndarray:
    """Nearest whole points with an even sum: where the sum is odd, the coordinate nearest to a tie goes the other way."""
    near = np.rint(x)
    worst = np.abs(x - near).argmax(axis=1)
    rows = np.arange(len(x))
    odd = near.sum(axis=1) % 2 != 0
    turn = np.where(x[rows, worst] >= near[rows, worst], 1.0, -1.0)
    near[rows[odd], worst[odd]] += turn[odd]
    return near


def shortest_vectors() -> np.ndarray:
    """The 240 shortest vectors of E8, doubled."""
    out = []
    for i, j in itertools.combinations(range(8), 2):
        for a, b in itertools.product((2, -2), repeat=2):
            v = [0] * 8
            v[i], v[j] = a, b
            out.append(v)
    out += [v for v in itertools.product((1, -1), repeat=8) if v.count(-1) % 2 == 0]
    return np.array(out, dtype=np.float64)


def cells(unit: np.ndarray, number: int, probes: int, scale: float, seed: int) -> np.ndarray:
    """(n, 1 + probes, 8) doubled lattice points of one table: the nearest, then its neighbours by distance."""
    rng = np.random.default_rng((seed, number, unit.shape[1]))
    x = unit @ (rng.standard_normal((unit.shape[1], 8)) * (scale / np.sqrt(8))) + rng.uniform(0, 1, 8)
    home = decode_e8(x)
    if not probes:
        return home[:, None, :]
    around = shortest_vectors()
    off = 2 * x - home
    order = np.argpartition(-(off @ around.T), probes - 1, axis=1)[:, :probes]  # all are equally long
    return np.concatenate([home[:, None, :], home[:, None, :] + around[order]], axis=1)


def _keys(points: np.ndarray) -> np.ndarray:
    """A 64-bit number for each point; its coordinates are small whole numbers."""
    out = np.zeros(points.shape[:-1], np.int64)
    with np.errstate(over="ignore"):
        for k in range(8):
            out = out * 251 + points[..., k].astype(np.int64)
    return out


def doubled(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, vector as doubles, able: whether it can link); -0 counts as 0."""
    vector = F.transform("embedding", lambda x: F.when(x == 0, F.lit(0.0)).otherwise(x.cast("double")))
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    able = F.col("vector").isNotNull() & F.col("label").isNotNull() & ~bad & F.exists("vector", lambda x: x != 0)
    return vectors.select("vec_id", "label", vector.alias("vector")).withColumn("able", F.coalesce(able, F.lit(False)))


def usable(vectors: DataFrame) -> DataFrame:
    """(label, vector, first vec_id, copies) of the distinct vectors that can link."""
    return doubled(vectors).filter("able").groupBy("label", "vector").agg(F.min("vec_id").alias("first"), F.count("*").alias("copies"))


def unit_vectors(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; by their largest component first, so that no square is lost or infinite."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def hashed(nodes: DataFrame, tables: int, probes: int, scale: float, seed: int) -> DataFrame:
    """(label, node, first, copies, vector, cells, packed) of nodes (label, node, vector, first, copies): the vector at length one
    as the bytes of its doubles, and of each table the home cell and the probed ones, as an array and as bytes."""
    kinds = {f.name: f.dataType.simpleString() for f in nodes.schema.fields}
    schema = f"label {kinds['label']}, node bigint, first {kinds['first']}, copies bigint, vector binary, cells array<bigint>, packed binary"
    out_schema = arrow_schema(schema)
    each = 1 + probes

    def packed(x: np.ndarray) -> pa.Array:
        return pa.array([row.tobytes() for row in x], pa.binary())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 1000):
                part = batch.slice(k, 1000)
                sizes = np.array([len(v) for v in part.column("vector")])
                for size in np.unique(sizes):
                    chosen = part.take(pa.array(np.flatnonzero(sizes == size)))
                    unit = unit_vectors(chosen.column("vector").flatten().to_numpy().reshape(-1, size))
                    cell = np.empty((len(unit), tables * each), np.int64)
                    for number in range(tables):
                        cell[:, number * each : (number + 1) * each] = _keys(cells(unit, number, probes, scale, seed))
                    ends = pa.array(np.arange(len(cell) + 1, dtype=np.int32) * cell.shape[1])
                    columns = [chosen.column(c) for c in ("label", "node", "first", "copies")]
                    columns += [packed(unit), pa.ListArray.from_arrays(ends, pa.array(cell.ravel())), packed(cell)]
                    yield pa.RecordBatch.from_arrays(columns, schema=out_schema)

    return nodes.select("label", "node", "first", "copies", "vector").mapInArrow(run, schema)


def counted_links(nodes: DataFrame, cosine: float, each: int, block: int) -> DataFrame:
    """(node, others, root): for the vectors of each cell their new links, as a sum of copies, and the least of the nodes that
    these links join there. nodes: as hashed() gives them, `each` cells a table."""
    keys = ["label", "number", "cell"]
    at = nodes.select("label", "node", F.posexplode("cells").alias("at", "cell"))
    rows = stored(at.select("label", F.expr(f"at div {each}").cast("int").alias("number"), "cell", (F.col("at") % each == 0).alias("home"), "node"))
    sizes = stored(rows.groupBy(keys).agg(F.count("*").alias("n"), F.count_if("home").alias("homes")).filter("n > 1 AND homes > 0"))
    met = stored(rows.join(sizes, keys))
    discard(rows, sizes)
    before = F.substring("packed", F.lit(1), (F.col("number") + 1) * (8 * each)).alias("cells")
    met = met.join(nodes.select("node", "vector", "copies", "packed"), "node").withColumn("blocks", F.ceil(F.col("n") / block).cast("int"))
    own = F.pmod(F.xxhash64("node", "number"), F.col("blocks")).cast("int")
    # block i meets every block j: a row goes to the pairs that its own block is in
    pairs = F.explode(F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda j: F.struct(F.least("own", j).alias("i"), F.greatest("own", j).alias("j"))))
    dealt = met.withColumn("own", own).select(*keys, "home", "node", "vector", "copies", before, "own", pairs.alias("pair"))
    dealt = dealt.select(*keys, "pair.i", "pair.j", "own", "home", "node", "vector", "copies", "cells")
    by = [*keys, "i", "j"]
    schema = "node bigint, others bigint, root bigint"
    out_schema = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        at = None
        for batch in batches:
            for row in batch.to_pylist():
                key = tuple(row[c] for c in by)
                if key != at:
                    yield from compared(held)
                    held, at = [], key
                held.append(row)
        yield from compared(held)

    def compared(held: list[dict]) -> Iterator[pa.RecordBatch]:
        for size in {len(r["vector"]) for r in held} if len(held) > 1 else ():
            rows = list({r["node"]: r for r in sorted((r for r in held if len(r["vector"]) == size), key=lambda r: r["home"])}.values())
            node, home, own, copies = (np.array([r[c] for r in rows]) for c in ("node", "home", "own", "copies"))
            x = np.frombuffer(b"".join([r["vector"] for r in rows])).reshape(len(rows), -1)
            cell = np.frombuffer(b"".join([r["cells"] for r in rows]), np.int64).reshape(len(rows), -1)
            across, here, number = rows[0]["i"] != rows[0]["j"], rows[0]["cell"], rows[0]["number"]
            found = []
            for k in range(0, len(rows), 256):
                part = np.arange(k, min(k + 256, len(rows)))
                part = part[home[part]]
                hit = (x[part] @ x.T >= cosine) & (part[:, None] != np.arange(len(rows)))
                if across:  # rows of one block meet in the pair (i, i)
                    hit &= own[part][:, None] != own[None, :]
                a, b = np.nonzero(hit)
                found.append(np.sort(np.stack([part[a], b]), axis=0))
            a, b = np.unique(np.concatenate(found, axis=1), axis=1) if found else (np.empty(0, int),) * 2
            for table in range(number + 1):  # a pair that has met in an earlier table is counted there
                c = cell[:, table * each : (table + 1) * each]
                to_a, to_b = (c[b] == c[a, :1]).any(axis=1), (c[a] == c[b, :1]).any(axis=1)
                if table < number:
                    new = ~(to_a | to_b)
                else:  # and one that meets in the homes of both, in the lower of the two
                    new = ~(to_a & to_b) | (np.minimum(c[a, 0], c[b, 0]) == here)
                a, b = a[new], b[new]
            if len(a):
                others = np.zeros(len(rows), np.int64)
                np.add.at(others, a, copies[b])
                np.add.at(others, b, copies[a])
                linked = np.flatnonzero(others)
                columns = [node[linked], others[linked], node[_roots(len(rows), a, b)[linked]]]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=out_schema)

    return dealt.repartition(*by).sortWithinPartitions(*by).mapInArrow(run, schema)


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of n places the least that links (a, b) join it with."""
    root = np.arange(n)
    while True:
        low = root.copy()
        np.minimum.at(low, a, root[b])
        np.minimum.at(low, b, root[a])
        low = low[low]
        if (low == root).all():
            return root
        root = low


def near_vectors(
    vectors: DataFrame, cosine: float = COSINE, tables: int = TABLES, probes: int = PROBES, scale: float = SCALE, seed: int = SEED, block: int = BLOCK
) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of vectors."""
    # nodes are numbered once; rows find theirs again by 128 bits of label and vector
    key = F.xxhash64("label", "vector").alias("_k"), F.xxhash64(F.lit(1), "label", "vector").alias("_l")
    distinct = stored(usable(vectors).select("*", *key, F.monotonically_increasing_id().alias("node")))
    nodes = stored(hashed(distinct, tables, probes, scale, seed))
    links = stored(counted_links(nodes, cosine, 1 + probes, block))
    many = links.groupBy("node").agg(F.sum("others").alias("others"))
    joined = components(links.select(F.col("node").alias("a"), F.col("root").alias("b")))
    whole = (
        nodes.select("node", "first", "copies").join(many, "node", "left").join(joined, "node", "left")
        .select("node", "first", "copies", (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "node").alias("component"))
    )
    whole = stored(whole)
    least = whole.groupBy("component").agg(F.min("first").alias("component_id"))
    named = whole.join(least, "component").join(distinct.select("node", "_k", "_l"), "node")
    named = stored(named.select("_k", "_l", "n_links", "component_id", "copies"))
    rows = doubled(vectors)
    linked = split_join(rows.filter("able").select("vec_id", *key), named, ["_k", "_l"], "copies")
    alone = rows.filter("NOT able").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.select("vec_id", "n_links", "component_id").unionByName(alone).select(
        "vec_id", F.col("n_links").cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").cast("long").alias("component_id"),
        F.col("vec_id").eqNullSafe(F.coalesce("component_id", "vec_id")).alias("kept"),
    )


def op9_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))


QUERIES = {"op9_lattice": op9_lattice}
SQL = {
    "op9_lattice": f"""WITH RECURSIVE v AS MATERIALIZED (SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings),
u AS MATERIALIZED (SELECT vec_id, label, e, sqrt(list_sum(list_transform(e, lambda x: x * x))) AS size FROM v WHERE label IS NOT NULL AND e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND a.size > 0 AND b.size > 0 AND list_dot_product(a.e, b.e) / (a.size * b.size) >= {COSINE}),
r AS (SELECT vec_id, vec_id AS other FROM v UNION SELECT r.vec_id, p.b FROM r JOIN p ON r.other = p.a)
SELECT vec_id, coalesce((SELECT count(*) FROM p WHERE p.a = v.vec_id), 0)::BIGINT AS n_links, min(r.other) AS component_id, vec_id = min(r.other) AS kept FROM v JOIN r USING (vec_id) GROUP BY vec_id"""
}
