"""Conversation prefix trie: every distinct sequence of first turns with the conversations that begin with it.

A prefix's digest is the exclusive or of 128-bit hashes of its turns with their depths, so it can be summed up in pieces of
CHUNK turns, however long a conversation is. Shards are bounded batches of such pieces. In each shard the distinct digests
get slots by a minimal perfect hash; a slot stores its digest, and every lookup is compared with it. Counts are scattered
into flat arrays by slot; sums over subtrees run through the array of parents' slots, deepest level first. A node may lie
in several shards, so a shard's sums are parts, added up by digest in Spark, and its own weights (childless or not,
tokens saved) are scattered in one shard only, that of its smallest member, whose path holds all its ancestors. What
later pieces of a conversation sum up to is scattered at the end of each earlier one.

Order: turns go by turn, nulls first, then role, then MD5 of the text.

Cases: null role and text are empty. Rows without conv_id belong to no conversation. Repeated rows are turns of their own.
Negative ids take the remainder towards zero, as SQL does. An empty table gives an empty result. Other columns are
ignored. Two prefixes of one digest raise an error.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .checksums import CRC_TABLE, crc32_sql
from .common import arrow_schema, split_join, stored, table
from .ordered import numbered, ordered_sha256

CHUNK = 1024
#: Rows of a shard, whole pieces each.
SHARD = 1 << 17
#: Of the rebuilding: conversations of a block, and shared turns at most.
BLOCK, SHARED = 5, 8
_A, _B, _WORD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93), (1 << 64) - 1


class Slots:
    """A minimal perfect hash of distinct digests (n x 2 words): levels of bits, twice as many as keys are left; a key that
    is alone at its place of a level is filed there, the others go on to the next."""

    def __init__(self, digests: np.ndarray):
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        left, taken = digests, 0
        while len(left):
            if len(self.levels) == 64:
                raise ValueError("digests are not distinct")
            at = self._place(left, len(self.levels), 2 * len(left) + 1)
            alone = np.bincount(at, minlength=2 * len(left) + 1) == 1
            self.levels.append((alone, taken + np.cumsum(alone) - 1))
            taken += int(alone.sum())
            left = left[~alone[at]]
        self.digests = np.empty_like(digests)
        self.digests[self._find(digests)] = digests

    @staticmethod
    def _place(digests: np.ndarray, level: int, width: int) -> np.ndarray:
        x = (digests[:, 0] ^ np.uint64(level * int(_B) & _WORD)) * _A
        x = (x ^ x >> np.uint64(32) ^ digests[:, 1]) * _B
        return ((x ^ x >> np.uint64(29)) % np.uint64(width)).astype(np.int64)

    def _find(self, digests: np.ndarray) -> np.ndarray:
        out, open_ = np.full(len(digests), -1, np.int64), np.arange(len(digests))
        for level, (alone, rank) in enumerate(self.levels):
            at = self._place(digests[open_], level, len(alone))
            here = alone[at]
            out[open_[here]] = rank[at[here]]
            open_ = open_[~here]
            if not len(open_):
                break
        return out

    def of(self, digests: np.ndarray) -> np.ndarray:
        """Slots, -1 for digests that are not in the table."""
        slots = self._find(digests)
        slots[(slots >= 0) & (self.digests[slots] != digests).any(axis=1)] = -1
        return slots


def distinct(digests: np.ndarray) -> np.ndarray:
    digests = digests[np.lexsort((digests[:, 1], digests[:, 0]))]
    return digests[np.concatenate([[True], (digests[1:] != digests[:-1]).any(axis=1)])]


#: Rows of a path: 0 the digest that a piece starts from, 1 a turn (the root for depth 0), 2 weights of the turn before.
START, TURN, WEIGHT = 0, 1, 2
_PATH = "conv bigint, chunk bigint, depth bigint, kind int, a bigint, b bigint, size bigint, last boolean"


def rebuilt(conversations: DataFrame) -> DataFrame:
    """conv, depth, a, b (hash of the turn with its depth), size (bytes of the text), last; depth 0 is the root."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("bigint").alias("conv"), F.col("turn").isNotNull().alias("has_turn"), "turn", role.alias("role"),
        F.md5(text).alias("mark"), F.octet_length(text).cast("bigint").alias("size"), F.monotonically_increasing_id().alias("salt"),
    )
    own = stored(numbered(turns, ["conv"], ["has_turn", "turn", "role", "mark", "salt"]).select("conv", "n", "n_rows", "role", "mark", "size"))
    sizes = own.filter("n = 1").select("conv", "n_rows")
    h, base = F.crc32(F.col("conv").cast("string").cast("binary")) % (SHARED + 1), F.col("conv") - F.col("conv") % BLOCK
    plan = sizes.select("conv", "n_rows", h.alias("h"), base.alias("base")).join(sizes.select(F.col("conv").alias("base"), F.col("n_rows").alias("n_base")), "base", "left")
    plan = plan.withColumn("shared", F.least("h", F.coalesce("n_base", F.lit(0))))
    plan = stored(plan.select("conv", "base", "h", "shared", (F.col("shared") + F.greatest(F.col("n_rows") - F.col("h"), F.lit(0))).alias("length"), "n_rows"))
    rest = split_join(own.drop("n_rows"), plan, ["conv"], "n_rows").filter("n > h").withColumn("depth", F.col("shared") + F.col("n") - F.col("h"))
    lent = own.filter(F.col("n") <= SHARED).select(F.col("conv").alias("base"), "n", "role", "mark", "size").join(plan.select("conv", "base", "shared", "length"), "base")
    lent = lent.filter("n <= shared").withColumnRenamed("n", "depth")
    hashed = F.md5(F.concat_ws(":", F.col("depth").cast("string"), "mark", "role"))
    half = lambda k: F.conv(F.substring(hashed, 16 * k + 1, 16), 16, -10).cast("bigint")
    turn = lambda df: df.select("conv", "depth", half(0).alias("a"), half(1).alias("b"), "size", (F.col("depth") == F.col("length")).alias("last"))
    zero = F.lit(0).cast("bigint")
    root = plan.select("conv", zero.alias("depth"), zero.alias("a"), zero.alias("b"), zero.alias("size"), (F.col("length") == 0).alias("last"))
    return root.unionByName(turn(rest)).unionByName(turn(lent))


def paths(turns: DataFrame, chunk: int) -> DataFrame:
    """turns, and what each further piece of a conversation starts from, as rows of a path."""
    rows = stored(turns.select("conv", F.expr(f"depth div {chunk}").alias("chunk"), "depth", F.lit(TURN).alias("kind"), "a", "b", "size", "last"))
    sums = rows.groupBy("conv", "chunk").agg(F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"))
    former = Window.partitionBy("conv").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)  # a row a piece
    starts = sums.select("conv", "chunk", *(F.bit_xor(c).over(former).alias(c) for c in "ab")).filter("chunk > 0")
    start = starts.select("conv", "chunk", (F.col("chunk") * chunk - 1).alias("depth"), F.lit(START).alias("kind"), "a", "b", F.lit(0).cast("bigint").alias("size"), F.lit(False).alias("last"))
    return stored(rows.unionByName(start))


def _shards(rows: DataFrame, schema: str, shard) -> DataFrame:
    """shard(columns) -> columns, over batches of whole pieces of paths, each in order."""
    out_schema, names = arrow_schema(schema), rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n < SHARD:
                continue
            whole = pa.Table.from_batches(held).combine_chunks()
            piece = np.stack([whole.column(c).to_numpy() for c in ("conv", "chunk")])
            cut = int(np.flatnonzero((piece[:, -1:] != piece).any(axis=0))[-1]) + 1 if (piece[:, -1:] != piece).any() else 0
            if cut:
                yield from done(whole.slice(0, cut))
            held, n = whole.slice(cut).to_batches(), whole.num_rows - cut
        if n:
            yield from done(pa.Table.from_batches(held))

    def done(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        columns = shard({c: rows.column(c).to_numpy() for c in names})
        arrays = [pa.array(c, type=f.type, mask=m) for (c, m), f in zip(((c if isinstance(c, tuple) else (c, None)) for c in columns), out_schema, strict=True)]
        yield from pa.Table.from_arrays(arrays, schema=out_schema).to_batches(max_chunksize=20_000)

    keys = ["conv", "chunk"]
    return rows.repartition(*keys).sortWithinPartitions(*keys, "depth", "kind").mapInArrow(run, schema)


def _digests(c: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the turns among a shard's rows: their places, digests, and those of their parents."""
    new = np.concatenate([[True], (c["conv"][1:] != c["conv"][:-1]) | (c["chunk"][1:] != c["chunk"][:-1])])
    words = np.stack([c["a"], c["b"]], axis=1).view(np.uint64)
    words = np.where((c["kind"] == WEIGHT)[:, None], np.uint64(0), words)
    run = np.bitwise_xor.accumulate(words, axis=0)
    begin = np.flatnonzero(new)
    former = np.where(begin[:, None] > 0, run[begin - 1], np.uint64(0))
    own = run ^ np.repeat(former, np.diff(np.append(begin, len(new))), axis=0)
    turns = np.flatnonzero(c["kind"] == TURN)
    return turns, own[turns], own[turns] ^ words[turns]


_PARTS = "a bigint, b bigint, pa bigint, pb bigint, depth bigint, size bigint, n bigint, conv bigint, ends boolean"


def _counted(c: dict[str, np.ndarray]) -> list[np.ndarray]:
    """A shard's nodes with counts of rows and smallest members, and the ends of conversations."""
    turns, own, up = _digests(c)
    slots = Slots(distinct(own))
    at, n = slots.of(own), len(slots.digests)
    parents, depth, size = np.zeros((n, 2), np.uint64), np.zeros(n, np.int64), np.zeros(n, np.int64)
    parents[at], depth[at], size[at] = up, c["depth"][turns], c["size"][turns]
    if (at < 0).any() or (parents[at] != up).any() or (depth[at] != c["depth"][turns]).any():
        raise ValueError("two prefixes have one digest")
    members, least = np.bincount(at, minlength=n), np.full(n, np.iinfo(np.int64).max)
    np.minimum.at(least, at, c["conv"][turns])
    last = c["last"][turns].astype(bool)
    ends = own[last].view(np.int64)
    no = np.zeros(len(ends), np.int64)
    words = slots.digests.view(np.int64), parents.view(np.int64)
    columns = zip(
        (words[0][:, 0], words[0][:, 1], words[1][:, 0], words[1][:, 1], depth, size, members, least, np.zeros(n, bool)),
        (ends[:, 0], ends[:, 1], no, no, no, no, no, c["conv"][turns][last], np.ones(len(ends), bool)), strict=True,
    )
    return [np.concatenate(x) for x in columns]


def _summed(chunk: int):
    def shard(c: dict[str, np.ndarray]) -> list[np.ndarray]:
        """The parts of the sums over subtrees: digest, childless nodes, tokens saved."""
        turns, own, up = _digests(c)
        slots = Slots(distinct(own))
        at, n = slots.of(own), len(slots.digests)
        sums = np.zeros((n, 2), np.int64)
        weights = np.flatnonzero(c["kind"] == WEIGHT)
        # a weight stands behind the turn that it belongs to
        np.add.at(sums, at[np.searchsorted(turns, weights) - 1], np.stack([c["a"], c["b"]], axis=1)[weights])
        depth, parent = np.zeros(n, np.int64), np.full(n, -1)
        depth[at] = c["depth"][turns]
        inside = c["depth"][turns] % chunk != 0  # what a piece sums up to has been scattered in the one before
        parent[at[inside]] = slots.of(up[inside])
        order = np.argsort(-depth, kind="stable")
        for level in np.split(order, np.flatnonzero(np.diff(depth[order])) + 1):
            level = level[parent[level] >= 0]
            np.add.at(sums, parent[level], sums[level])
        words = slots.digests.view(np.int64)
        some = sums.any(axis=1)
        return [words[some, 0], words[some, 1], sums[some, 0], sums[some, 1]]

    return shard


def trie(conversations: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 of each node."""
    rows = paths(rebuilt(conversations), chunk)
    parts = stored(_shards(rows, _PARTS, _counted))
    found = parts.filter("not ends").groupBy("a", "b").agg(
        F.sum("n").alias("n_convs"), F.min("conv").alias("conv_id"), *(F.min(c).alias(c) for c in ("pa", "pb", "depth", "size")),
        F.max(F.struct("pa", "pb", "depth", "size")).alias("most"),
    )
    one = F.struct("pa", "pb", "depth", "size") == F.col("most")
    found = stored(found.withColumn("depth", F.when(one, F.col("depth")).otherwise(F.raise_error(F.lit("two prefixes have one digest")))).drop("most"))
    children = found.filter("depth > 0").groupBy(F.col("pa").alias("a"), F.col("pb").alias("b")).agg(F.count("*").alias("n_children"))
    nodes = stored(found.join(children, ["a", "b"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))))
    parents = stored(nodes.filter("n_children > 0").select(F.col("a").alias("pa"), F.col("b").alias("pb"), F.col("conv_id").alias("parent_conv_id"), F.col("n_children").alias("siblings")))
    sums = _shards(rows.unionByName(_weights(rows, nodes, chunk)), "a bigint, b bigint, leaves bigint, saved bigint", _summed(chunk))
    sums = sums.groupBy("a", "b").agg(F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))
    ends = parts.filter("ends").select("a", "b", "conv", F.col("conv").cast("string").alias("piece"))
    ends = ordered_sha256(ends, ["a", "b"], ["conv"], "piece", ",").withColumnRenamed("sha256", "ends_sha256")
    top = nodes.filter("depth = 0").withColumn("parent_conv_id", F.lit(None).cast("bigint"))
    below = split_join(nodes.filter("depth > 0"), parents, ["pa", "pb"], "siblings").select(*top.columns)
    out = top.unionByName(below).join(sums, ["a", "b"], "left").join(ends, ["a", "b"], "left")
    return out.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", F.coalesce("saved_tokens", F.lit(0)).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )


def _weights(rows: DataFrame, nodes: DataFrame, chunk: int) -> DataFrame:
    """Rows of kind WEIGHT: a (1 for a childless node) and b (tokens that a node saves), each on its smallest member's path;
    what a conversation's later pieces hold is put at the end of each earlier one."""
    no, piece = F.lit(0).cast("bigint"), F.expr(f"depth div {chunk}")
    row: list[Column] = [F.col("conv"), piece.alias("chunk"), F.col("depth"), F.lit(WEIGHT).alias("kind"), F.col("a"), F.col("b"), no.alias("size"), F.lit(False).alias("last")]
    leaf, saved = (F.col("n_children") == 0).cast("bigint"), (F.col("n_convs") - 1) * F.col("size")
    own = nodes.select(F.col("conv_id").alias("conv"), "depth", leaf.alias("a"), saved.alias("b")).filter("a + b > 0")
    later = rows.filter("kind = 0").select("conv", "chunk")
    held = own.select("conv", piece.alias("chunk"), "a", "b").filter("chunk > 0").groupBy("conv", "chunk").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    onward = Window.partitionBy("conv").orderBy(F.desc("chunk"))  # a row a piece
    held = later.join(held, ["conv", "chunk"], "left").select("conv", F.col("chunk"), *(F.sum(F.coalesce(c, no)).over(onward).alias(c) for c in "ab"))
    back = held.select("conv", (F.col("chunk") * chunk - 1).alias("depth"), "a", "b")
    return own.unionByName(back).select(*row)


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie(table(spark, sf_dir, "conversations"))


QUERIES = {"op13_prefix_trie": op13_prefix_trie}
#: A node's sums over its subtree are those of what each member's path holds from the node on, each node counted on the path
#: of its smallest member only.
SQL = {
    "op13_prefix_trie": f"""WITH {CRC_TABLE},
t AS MATERIALIZED (SELECT conv_id AS conv, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), md5(coalesce(text, ''))) AS n,
md5(coalesce(role, '') || ':' || md5(coalesce(text, ''))) AS k, strlen(coalesce(text, '')) AS size FROM conversations WHERE conv_id IS NOT NULL),
c AS MATERIALIZED (SELECT conv, total, base, {crc32_sql("conv::VARCHAR")} % {SHARED + 1} AS h FROM (SELECT conv, count(*) AS total, conv - conv % {BLOCK} AS base FROM t GROUP BY conv), crc_table),
p AS MATERIALIZED (SELECT c.conv, c.base, c.h, least(c.h, coalesce(b.total, 0)) AS shared FROM c LEFT JOIN c b ON c.base = b.conv),
r AS (SELECT p.conv, n AS depth, k, size FROM p JOIN t ON t.conv = p.base AND n <= shared UNION ALL SELECT p.conv, shared + n - h, k, size FROM p JOIN t ON t.conv = p.conv AND n > h
UNION ALL SELECT conv, 0, '', 0 FROM p),
x AS MATERIALIZED (SELECT conv, depth, size, string_agg(k, ',') OVER w AS path, lead(depth) OVER w IS NULL AS ends FROM r WINDOW w AS (PARTITION BY conv ORDER BY depth)),
y AS MATERIALIZED (SELECT *, lag(path) OVER (PARTITION BY conv ORDER BY depth) AS up FROM x),
m AS MATERIALIZED (SELECT path, any_value(up) AS up, any_value(depth) AS depth, any_value(size) AS size, count(*) AS n_convs, min(conv) AS conv_id,
sha256(coalesce(string_agg(conv::VARCHAR, ',' ORDER BY conv) FILTER (ends), '')) AS ends_sha256 FROM y GROUP BY path),
k AS (SELECT up AS path, count(*) AS n_children FROM m WHERE up IS NOT NULL GROUP BY up),
q AS MATERIALIZED (SELECT m.*, coalesce(n_children, 0) AS n_children FROM m LEFT JOIN k USING (path)),
s AS (SELECT y.path, sum(CASE WHEN q.conv_id = y.conv AND n_children = 0 THEN 1 ELSE 0 END) OVER w AS leaves, sum(CASE WHEN q.conv_id = y.conv THEN (n_convs - 1) * q.size ELSE 0 END) OVER w AS saved
FROM y JOIN q USING (path) WINDOW w AS (PARTITION BY y.conv ORDER BY y.depth DESC)),
g AS (SELECT path, sum(leaves)::BIGINT AS n_leaves, sum(saved)::BIGINT AS saved_tokens FROM s GROUP BY path)
SELECT q.conv_id, q.depth, u.conv_id AS parent_conv_id, q.n_convs, q.n_children, n_leaves, saved_tokens, q.ends_sha256 FROM q JOIN g USING (path) LEFT JOIN q u ON q.up = u.path"""
}
