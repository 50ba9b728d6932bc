"""SimHash near-duplicates: fingerprints, BK-trees over shards of them, and the components of their links.

Equal fingerprints are one node, however many documents have them. Two fingerprints at `radius` bits or less agree in
at least one of radius + 1 blocks of bits, so a shard holds the nodes that agree in one block, and no link crosses
shards only. In a shard, a BK-tree files each node under its parent by their Hamming distance, and a search follows
only the edges that can lead to a node within the radius. A shard with more than `crowd` nodes is cut again: its
nodes agree in one of radius + 1 blocks of the bits that are left, until a shard is small or so few bits are left that
it can't be large. Shards are dealt out by shuffle, not broadcast: no tree of all documents would have a size bound.
A shard reports a spanning forest of its links, not all pairs, so classes are exact and lose no link.

`near_groups` is the form for near copies by similarity: nodes are sets of five-word shingles, with WORDS x 64 counts each
instead of 64. Shards come from the strongest of these counts: a table names the place and sign of the largest in each of
GROUPS groups of rotated counts, and nodes with the same names share a shard. The strongest counts are the last ones that an
edit turns, so a pair of similarity 0.8 shares a group's name with probability AGREE, and unrelated ones with 1 in NAMES; the
TABLES, the same number for any input, are so many that a pair of similarity 0.8 misses all of them with probability e^-5. In
a shard, a BK-tree over the fingerprints of all counts finds pairs at LIMIT bits or less, and a pair becomes a link if the
Jaccard similarity of its two sets is LEAST (4 / 5) or more, counted exactly. The first FIRST tables join most of a large
group; the others compare only nodes of different components.

A shard with more than `crowd` nodes (pages of one template, whose counts the template makes, or many nodes in all) is cut by
what tells its nodes apart. The shingles of all nodes in crowded shards are counted, and a node is filed under the rarest of
its own, so many that two sets of similarity 0.8 or more have one of them in common (a fifth and one more). That loses no
pair, and pages of a template part by their own words. Shards by shingles hold BK-trees like others.

Cases: null and empty texts have no words and fingerprint zero, linked like any other. Repeated rows share their
fingerprint. A null doc_id gets its component, but never names one unless all of it are null. An empty table gives an
empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import LOWER, UPPER, arrow_batch, arrow_schema, checkpointed, discard, split_join, stored, table
from .components import components

RADIUS, SHINGLE, SEED = 2, 3, 42
CROWD = 400
#: Of the wide form. LIMIT: bits of WORDS * 64 by which texts of similarity 0.8 differ (77), and over five times their
#: deviation (8). FIRST: tables of the first round, ROUND: of each later one. TURNS: rotations of the counts.
WORDS, WIDE_SHINGLE, LIMIT, LEAST, FIRST, ROUND, TURNS = 8, 5, 120, (4, 5), 8, 33, 16
#: Counts in a group, groups of a table, and the chance (measured) that sets of similarity 0.8 agree in a group's name.
GROUP, GROUPS, AGREE = 128, 3, 0.41
NAMES, TABLES = 2 * GROUP, 73  # 5 / AGREE ** GROUPS
TO_LOWER = bytes.maketrans(UPPER.encode(), LOWER.encode())
_MIX = np.uint64(0xD6E8FEB86659FD93)


def shingle_hashes(text: bytes, shingle: int) -> np.ndarray:
    """XXH64 (seed 42) of the shingles of a text's words, A-Z lower-cased, repeats included."""
    words = text.translate(TO_LOWER).split()
    if not words:
        return np.empty(0, np.uint64)
    data = b" ".join(words)
    if len(words) <= shingle:
        return np.array([xxhash.xxh64_intdigest(data, SEED)], np.uint64)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(sizes) - 1
    starts = ends - sizes + 1
    hash_ = xxhash.xxh64_intdigest
    n = len(words) - shingle + 1
    return np.fromiter([hash_(data[a:b], SEED) for a, b in zip(starts[:n].tolist(), ends[shingle - 1 :].tolist())], np.uint64, n)


def majority(hashes: np.ndarray) -> int:
    """Bits set in over half of the hashes; 0 for none."""
    counts = np.zeros(64, np.int64)
    for k in range(0, len(hashes), 1 << 14):
        bits = np.unpackbits(hashes[k : k + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(((counts * 2 > len(hashes)).astype(np.uint64) << np.arange(64, dtype=np.uint64)).sum()) if len(hashes) else 0


def wide_counts(hashes: np.ndarray, words: int = WORDS) -> np.ndarray:
    """How many of the distinct hashes, mixed in `words` ways, have each bit set, less how many don't."""
    total = np.zeros(64 * words, np.int64)
    for k in range(0, len(hashes), 255 << 6):
        part = hashes[k : k + (255 << 6)]
        run = -(-len(part) // -(-len(part) // 255))  # at most 255 bits are added up in a byte
        mixed = np.zeros((-(-len(part) // run) * run, words), np.uint64)
        with np.errstate(over="ignore"):
            for w in range(words):
                part = (part ^ (part >> np.uint64(31))) * _MIX + np.uint64(1)
                mixed[: len(part), w] = part ^ (part >> np.uint64(29))
        bits = np.unpackbits(mixed.view(np.uint8).reshape(-1), bitorder="little").reshape(-1, run, 64 * words)
        total += np.add.reduce(bits, axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
    return 2 * total - len(hashes)


def shard_keys(counts: np.ndarray) -> np.ndarray:
    """(n, TABLES) shards of the rows of counts: table and names in one number."""
    rng, width = np.random.default_rng(SEED), counts.shape[1]
    low, high = (reduce(np.kron, [np.array([[1, 1], [1, -1]], np.float32)] * k) for k in (5, (width // 32).bit_length() - 1))
    at = counts / np.sqrt(np.maximum((counts.astype(np.float64) ** 2).sum(axis=1, keepdims=True), 1))
    at, found = at.astype(np.float32), []
    for _ in range(TURNS):  # signs turned at random and a Hadamard matrix as a product of two small ones
        at = at * rng.choice(np.array([-1, 1], np.float32), width)
        at = np.matmul(high, (at.reshape(-1, 32) @ low).reshape(len(at), -1, 32)).reshape(len(at), width) / np.float32(np.sqrt(width))
        parts = at.reshape(len(at), -1, GROUP)
        best = np.abs(parts).argmax(axis=2)
        found.append(2 * best + (np.take_along_axis(parts, best[:, :, None], 2)[:, :, 0] > 0))
    names = np.concatenate(found, axis=1).astype(np.int64)
    out = np.empty((len(at), TABLES), np.int64)
    for table in range(TABLES):
        out[:, table] = table
        for group in rng.choice(names.shape[1], GROUPS, replace=False):
            out[:, table] = out[:, table] * NAMES + names[:, group]
    return out


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id and print: the fingerprint's bytes, lowest first."""
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, print binary"
    return _printed(docs, schema, lambda doc_id, text: (doc_id, majority(shingle_hashes(text, shingle)).to_bytes(8, "little")))


def wide_prints(docs: DataFrame, shingle: int = WIDE_SHINGLE) -> DataFrame:
    """(row, content, print, shards) of docs (row, text): a 128-bit hash of the set of shingles, the fingerprint and the
    shard in each table."""
    schema = "row bigint, content binary, print binary, shards array<bigint>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 512):
                part = batch.slice(k, 512)
                sets = [np.unique(shingle_hashes(text or b"", shingle)) for text in part.column("text").to_pylist()]
                counts = np.stack([wide_counts(x) for x in sets])
                shards = shard_keys(counts)
                prints = np.packbits(counts > 0, axis=1, bitorder="little")
                columns = [
                    part.column("row"), pa.array([xxhash.xxh3_128_digest(x.tobytes()) for x in sets], pa.binary()), pa.array([x.tobytes() for x in prints], pa.binary()),
                    pa.ListArray.from_arrays(pa.array(np.arange(len(sets) + 1, dtype=np.int32) * TABLES), pa.array(shards.ravel())),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["row", "content", "print", "shards"])

    return docs.select("row", F.col("text").cast("string").cast("binary").alias("text")).mapInArrow(run, schema)


def _number(values: np.ndarray) -> int:
    """A signed 64-bit hash of an array."""
    return _signed(xxhash.xxh64_intdigest(values.tobytes(), SEED))


def _printed(docs: DataFrame, schema: str, one) -> DataFrame:
    out_schema = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                rows = batch.slice(k, 256).to_pylist()
                yield arrow_batch([one(row["doc_id"], row["text"] or b"") for row in rows], out_schema)

    return docs.select("doc_id", F.col("text").cast("string").cast("binary").alias("text")).mapInArrow(run, schema)


class BKTree:
    """Nodes under their parents by integer Hamming distance."""

    def __init__(self) -> None:
        self.prints: list[int] = []
        self.children: list[dict[int, int]] = []

    def near(self, fingerprint: int, radius: int) -> list[int]:
        """Nodes within the radius; follows only edges that can lead to one."""
        found, todo = [], [0] if self.prints else []
        while todo:
            k = todo.pop()
            d = (fingerprint ^ self.prints[k]).bit_count()
            if d <= radius:
                found.append(k)
            children = self.children[k]
            if children:
                todo += [child for edge, child in children.items() if d - radius <= edge <= d + radius]
        return found

    def add(self, fingerprint: int) -> int:
        new = len(self.prints)
        self.prints.append(fingerprint)
        self.children.append({})
        at = 0
        while new:
            edge = (fingerprint ^ self.prints[at]).bit_count()
            below = self.children[at].get(edge)
            if below is None:
                self.children[at][edge] = new
                break
            at = below
        return new


def forest(prints: list[int], radius: int) -> list[tuple[int, int]]:
    """Links (i, j) that join the same nodes as all links within the radius, one fewer than the nodes of each class."""
    if len(prints) == 2:
        return [(0, 1)] if (prints[0] ^ prints[1]).bit_count() <= radius else []
    tree, links, top = BKTree(), [], list(range(len(prints)))

    def root(k: int) -> int:
        while top[k] != k:
            top[k] = top[top[k]]
            k = top[k]
        return k

    for k, p in enumerate(prints):
        for j in tree.near(p, radius):
            a, b = root(j), root(k)
            if a != b:
                top[b] = a
                links.append((j, k))
        tree.add(p)
    return links


def _trees(shards: DataFrame, radius: int) -> DataFrame:
    """shards: (shard keys..., node, print). Links (a, b) of each shard."""
    keys = [c for c in shards.columns if c not in ("node", "print")]
    out_schema = arrow_schema("a bigint, b bigint")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        held: list[tuple[int, int]] = []
        at = None
        for batch in batches:
            for row in batch.to_pylist():
                key = [row[c] for c in keys]
                if key != at:
                    out += linked(held)
                    held, at = [], key
                held.append((row["node"], int.from_bytes(row["print"], "little")))
            if len(out) > 10_000:
                yield arrow_batch(out, out_schema)
                out = []
        out += linked(held)
        if out:
            yield arrow_batch(out, out_schema)

    def linked(held: list[tuple[int, int]]) -> list[tuple[int, int]]:
        links = forest([p for _, p in held], radius) if len(held) > 1 else []
        return [(held[i][0], held[j][0]) for i, j in links]

    return shards.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, "a bigint, b bigint")


def _blocks(mask: int, parts: int) -> list[int]:
    """The mask with one more block of bits: those not in it, in `parts` equal runs."""
    free = [k for k in range(64) if not mask >> k & 1]
    cuts = [len(free) * k // parts for k in range(parts + 1)]
    return [mask | sum(1 << k for k in free[a:b]) for a, b in zip(cuts, cuts[1:])]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def near_links(nodes: DataFrame, radius: int = RADIUS, crowd: int = CROWD, least_bits: int = 13) -> DataFrame:
    """(a, b): enough links between nodes at `radius` bits or less to give their components. nodes: (node, print), node
    the fingerprint as a number."""
    masks = _blocks(0, radius + 1)
    shards = nodes.select("node", "print", F.explode(F.array(*(F.lit(_signed(m)) for m in masks))).alias("mask"))
    out = None
    while True:
        shards = shards.withColumn("value", F.col("node").bitwiseAND(F.col("mask")))
        sizes = stored(shards.groupBy("mask", "value").agg(F.count("*").alias("n")).filter("n > 1"))
        shards = split_join(shards, sizes, ["mask", "value"], "n")
        last = min(64 - m.bit_count() for m in masks) <= least_bits
        small = shards if last else shards.filter(F.col("n") <= crowd)
        links = _trees(small.select("mask", "value", "node", "print"), radius)
        out = links if out is None else out.unionByName(links)
        if last or not sizes.filter(F.col("n") > crowd).limit(1).count():
            return out
        below = {m: _blocks(m, radius + 1) for m in masks}
        chosen = F.create_map(*(x for m in masks for x in (F.lit(_signed(m)), F.array(*(F.lit(_signed(c)) for c in below[m])))))
        shards = shards.filter(F.col("n") > crowd).select("node", "print", F.explode(chosen[F.col("mask")]).alias("mask"))
        masks = sorted({c for m in masks for c in below[m]})


def classes(prints: DataFrame, node: Column, radius: int, links) -> DataFrame:
    """doc_id, print, component_id (least doc_id) of every row of prints; links(nodes) gives the links of (node, print)."""
    prints = stored(prints.withColumn("node", node))
    nodes = stored(prints.groupBy("node", "print").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")))
    known = named(nodes, components(links(nodes.select("node", "print"))))
    return split_join(prints, known, ["node"], "n").select("doc_id", "print", "component_id")


def named(nodes: DataFrame, parts: DataFrame) -> DataFrame:
    """(node, component_id, n) of nodes (node, first, n): the least first of its component in parts."""
    whole = nodes.join(parts, "node", "left").select("node", "first", "n", F.coalesce("component", "node").alias("component"))
    least = whole.groupBy("component").agg(F.min("first").alias("component_id"))
    return stored(whole.join(least, "component").select("node", "component_id", "n"))


def near_classes(docs: DataFrame, radius: int = RADIUS, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id."""
    number = F.conv(_hex(), 16, -10).cast("bigint")
    out = classes(fingerprints(docs, shingle), number, radius, lambda nodes: near_links(nodes, radius))
    return out.select("doc_id", _hex().alias("fingerprint"), "component_id")


def _hex() -> Column:
    """The 8 bytes of print, lowest first, as 16 digits, highest first."""
    digits = F.lower(F.hex("print"))
    return F.concat(*(F.substring(digits, 2 * k + 1, 2) for k in reversed(range(8))))


def near_groups(docs: DataFrame, limit: int = LIMIT, crowd: int = CROWD) -> DataFrame:
    """(row, group): single linkage of near copies, five-word shingles of Jaccard similarity 0.8 or more, named by the least
    row in it. docs: (row, text), row a bigint of its own for each; read more than once, so stored."""
    prints = stored(wide_prints(docs))
    least = stored(prints.groupBy("content").agg(F.min("row").alias("node"), F.count("*").alias("n")))
    nodes = stored(prints.join(least.select(F.col("node").alias("row")), "row", "left_semi").select(F.col("row").alias("node"), "print", "shards"))
    rows = stored(prints.select("row", "content"))
    discard(prints)
    parts = wide_links(nodes, docs, limit, crowd)
    named_ = stored(least.join(parts, "node", "left").select("content", "n", F.coalesce("component", "node").alias("group")))
    out = stored(split_join(rows, named_, ["content"], "n").select("row", "group"))
    discard(rows, nodes, least, named_)
    return out


def wide_links(nodes: DataFrame, docs: DataFrame, limit: int = LIMIT, crowd: int = CROWD) -> DataFrame:
    """(node, component) of the nodes that have links. nodes: (node, print, shards); docs: (row, text) with the nodes among
    its rows.

    Tables are taken ROUND at a time, and what a round shuffles is gone before the next, so disk follows a round, not all."""
    rows, sizes = _mixed(nodes.select("node", F.col("node").alias("component"), F.explode(F.slice("shards", 1, FIRST)).alias("shard")))
    known = checkpointed(components(_links(rows, sizes, nodes, docs, limit, crowd, within=True)))
    # the shards of the first tables have been compared whole, but for the crowded ones
    large = split_join(rows, sizes.filter(F.col("n") > crowd), ["shard"], "n", "left_semi").select("node", "shard")
    again, mixed = _mixed(_placed(large, known).select("node", "component", "shard"))
    crowded = [_crowded(again, mixed, crowd)]
    discard(rows, sizes, again, mixed)
    for start in range(FIRST, TABLES, ROUND):
        at = _placed(nodes.select("node", F.slice("shards", start + 1, ROUND).alias("shards")), known)
        rows, sizes = _mixed(at.select("node", "component", F.explode("shards").alias("shard")))
        links = _links(rows, sizes.filter(F.col("n") <= crowd), nodes, docs, limit, crowd, within=False)
        crowded.append(_crowded(rows, sizes, crowd))
        discard(rows, sizes)
        known = _joined_by(known, links)
    rows, sizes = _mixed(by_rare_shingles(stored(_placed(reduce(DataFrame.unionByName, crowded).distinct(), known)), docs))
    known = _joined_by(known, _links(rows, sizes, nodes, docs, limit, crowd, within=False))
    discard(rows, sizes, *crowded)
    return known


def _placed(rows: DataFrame, known: DataFrame) -> DataFrame:
    """rows (node, ...) with the component of each node in known (node, component), else the node itself."""
    return rows.join(known, "node", "left").withColumn("component", F.coalesce("component", "node"))


def _joined_by(known: DataFrame, links: DataFrame) -> DataFrame:
    """The components known (node, component) once links (a, b) have joined some."""
    return checkpointed(components(links.unionByName(known.select(F.col("node").alias("a"), F.col("component").alias("b")))))


def _crowded(rows: DataFrame, sizes: DataFrame, crowd: int) -> DataFrame:
    """(node) of the nodes of shards of more than `crowd`, stored."""
    return stored(split_join(rows, sizes.filter(F.col("n") > crowd), ["shard"], "n", "left_semi").select("node").distinct())


def _mixed(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """rows (node, component, shard) stored, and the shards (shard, n) of nodes of several components."""
    rows = stored(rows)
    sizes = rows.groupBy("shard").agg(F.count("*").alias("n"), F.min("component").alias("lo"), F.max("component").alias("hi"))
    return rows, stored(sizes.filter("lo <> hi").select("shard", "n"))


def by_rare_shingles(crowded: DataFrame, docs: DataFrame) -> DataFrame:
    """(node, component, shard): each node of crowded (node, component) under the rarest of its shingles among these nodes, one
    more than it may lack of another set at similarity LEAST; under those only that another node has too."""
    sets = _sets(docs.join(crowded.select(F.col("node").alias("row")), "row", "left_semi"), "array<bigint>")
    grams = stored(sets.select("node", F.explode("hashes").alias("shard")))
    met = split_join(grams, stored(grams.groupBy("shard").agg(F.count("*").alias("n"))), ["shard"], "n")
    own = Window.partitionBy("node")  # a text's shingles
    over, under = LEAST
    size, place = F.count("*").over(own), F.row_number().over(own.orderBy("n", "shard"))
    rare = met.select("node", "shard", "n", size.alias("size"), place.alias("place")).filter(f"place <= size - ceil(size * {over} / {under}) + 1 AND n > 1")
    return crowded.join(rare.select("node", "shard"), "node").select("node", "component", "shard")


def _links(rows: DataFrame, sizes: DataFrame, nodes: DataFrame, docs: DataFrame, limit: int, crowd: int, within: bool) -> DataFrame:
    """(a, b): links between different components of rows (node, component, shard), by the shards of sizes (shard, n)."""
    mixed = stored(split_join(rows, sizes if hasattr(sizes, "stored_at") else stored(sizes), ["shard"], "n"))
    # a node is joined with its fingerprint once for all cells that it is in
    dealt = _dealt(mixed, crowd, within)
    cells = dealt.groupBy("node").agg(F.collect_list(F.struct(*(c for c in dealt.columns if c != "node"))).alias("cells"))
    dealt = cells.join(nodes.select("node", "print"), "node").select("node", "print", F.explode("cells").alias("cell")).select("node", "print", "cell.*")
    groups = stored(candidates(dealt, limit).dropDuplicates(["group", "node"]))
    discard(mixed)
    wanted = groups.select(F.col("node").alias("row")).distinct()
    sets = stored(_sets(docs.join(wanted, "row", "left_semi")))
    links = stored(verified(groups.join(sets, "node"), limit).distinct())
    discard(groups, sets)
    return links


def _dealt(rows: DataFrame, crowd: int, within: bool) -> DataFrame:
    """rows (shard, node, component, n) with i, j, resident and probe: in a cell (i, j) every probe is compared with every
    resident. A shard of `crowd` nodes or fewer is one cell, and all are both. Of a larger shard each node resides in one
    block i, and those outside the shard's largest component probe all of them, in blocks j of `crowd` too, so a cell has
    about 2 * crowd nodes at most; with `within`, nodes of one block i are compared with each other only."""
    one = F.lit(0).alias("j"), F.lit(True).alias("resident"), F.lit(True).alias("probe")
    few = rows.filter(F.col("n") <= crowd).select("shard", "node", "component", F.lit(0).alias("i"), *one)
    many = rows.filter(F.col("n") > crowd).withColumn("blocks", F.ceil(F.col("n") / crowd).cast("int"))
    many = many.withColumn("i", F.pmod(F.xxhash64("node", "shard"), F.col("blocks")).cast("int"))
    if within:
        return few.unionByName(many.select("shard", "node", "component", "i", *one))
    sizes = many.groupBy("shard", "component").agg(F.count("*").alias("size"))
    largest = sizes.groupBy("shard").agg(F.max(F.struct("size", "component")).alias("largest"), F.sum("size").alias("n"))
    largest = largest.select("shard", F.col("largest.component").alias("largest"), F.ceil((F.col("n") - F.col("largest.size")) / crowd).cast("int").alias("probing"))
    many = many.join(largest, "shard")
    residents = many.withColumn("j", F.explode(F.sequence(F.lit(0), F.col("probing") - 1))).withColumn("resident", F.lit(True)).withColumn("probe", F.lit(False))
    probes = many.filter("component <> largest").withColumn("j", F.pmod(F.xxhash64("shard", "node"), F.col("probing")).cast("int"))
    probes = probes.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumn("resident", F.lit(False)).withColumn("probe", F.lit(True))
    return reduce(DataFrame.unionByName, [few, residents.select(*few.columns), probes.select(*few.columns)])


def _sets(docs: DataFrame, kind: str = "binary") -> DataFrame:
    """(node, hashes): the distinct shingles of each of docs (row, text), as bytes or as numbers."""
    numbers = kind != "binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                part = batch.slice(k, 256)
                sets = [np.unique(shingle_hashes(text or b"", WIDE_SHINGLE)) for text in part.column("text").to_pylist()]
                if numbers:
                    ends = np.concatenate([[0], np.cumsum([len(x) for x in sets])]).astype(np.int32)
                    hashes = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(sets).view(np.int64)))
                else:
                    hashes = pa.array([x.tobytes() for x in sets], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column("row"), hashes], names=["node", "hashes"])

    return docs.select("row", F.col("text").cast("string").cast("binary").alias("text")).mapInArrow(run, f"node bigint, hashes {kind}")


def _joined(size: int):
    """root(k) and join(j, k) of a forest over range(size)."""
    top = list(range(size))

    def root(k: int) -> int:
        while top[k] != k:
            top[k] = top[top[k]]
            k = top[k]
        return k

    def join(j: int, k: int) -> None:
        top[root(k)] = root(j)

    return root, join


def _runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[list[dict]]:
    """The rows of each key, of sorted batches."""
    held, at = [], None
    for batch in batches:
        for row in batch.to_pylist():
            key = [row[c] for c in keys]
            if key != at and held:
                yield held
                held = []
            at = key
            held.append(row)
    if held:
        yield held


def _words(held: list[dict]) -> np.ndarray:
    return np.frombuffer(b"".join(row["print"] for row in held), np.uint64).reshape(len(held), -1)


def _collected(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    out: list[tuple] = []
    for row in rows:
        out.append(row)
        if len(out) >= 10_000:
            yield arrow_batch(out, schema)
            out = []
    if out:
        yield arrow_batch(out, schema)


def candidates(dealt: DataFrame, limit: int) -> DataFrame:
    """(group, node, component, print): the nodes of a cell that pairs of different components at `limit` bits or less hold
    together. Equal groups of different shards have equal numbers."""
    keys = ["shard", "i", "j"]
    schema = "group bigint, node bigint, component bigint, print binary"
    out_schema = arrow_schema(schema)

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for rows in _runs(batches, keys):
            if len(rows) == 1:
                continue
            nodes: dict[int, dict] = {}
            for row in rows:  # a node may reside and probe in a cell by two rows
                if row["node"] in nodes:
                    row["resident"], row["probe"] = True, True
                nodes[row["node"]] = row
            # residents that don't probe, then those that do, then the others: each pair meets once
            held = sorted(nodes.values(), key=lambda row: (row["probe"], not row["resident"], row["node"]))
            root, join = _joined(len(held))
            tree = BKTree()
            for k, row in enumerate(held):
                p = int.from_bytes(row["print"], "little")
                for j in tree.near(p, limit) if row["probe"] else ():
                    if held[j]["component"] != row["component"]:
                        join(j, k)
                if row["resident"]:
                    tree.add(p)
            groups: dict[int, list[dict]] = {}
            for k, row in enumerate(held):
                groups.setdefault(root(k), []).append(row)
            for group in groups.values():
                if len(group) > 1:
                    number = _number(np.array(sorted(row["node"] for row in group), np.int64))
                    for row in group:
                        yield number, row["node"], row["component"], row["print"]

    return dealt.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(lambda batches: _collected(found(batches), out_schema), schema)


def verified(groups: DataFrame, limit: int) -> DataFrame:
    """(a, b): links that join what all pairs of a group at `limit` bits or less and similarity LEAST or more join, besides
    those inside a component. groups: candidates with hashes."""
    schema = "a bigint, b bigint"
    out_schema = arrow_schema(schema)

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for held in _runs(batches, ["group"]):
            words, sets = _words(held), [np.frombuffer(row["hashes"], np.uint64) for row in held]
            root, join = _joined(len(held))
            first: dict[int, int] = {}
            for k, row in enumerate(held):
                join(first.setdefault(row["component"], k), k)
            for k in range(len(held) - 1):
                near = np.bitwise_count(words[k] ^ words[k + 1 :]).sum(axis=1) <= limit
                for j in (np.flatnonzero(near) + k + 1).tolist():
                    if root(j) != root(k) and similar(sets[k], sets[j]):
                        join(k, j)
                        yield held[k]["node"], held[j]["node"]

    return groups.repartition("group").sortWithinPartitions("group").mapInArrow(lambda batches: _collected(found(batches), out_schema), schema)


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sorted sets have Jaccard similarity LEAST or more."""
    over, under = LEAST
    if min(len(a), len(b)) * under < max(len(a), len(b)) * over:
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both * under >= (len(a) + len(b) - both) * over


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_classes(table(spark, sf_dir, "documents"))


QUERIES = {"op5_simhash": op5_simhash}
SQL: dict[str, str] = {}
