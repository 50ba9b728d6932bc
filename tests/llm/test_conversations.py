"""Conversation operators: whole queries, every column, against plain restatements; odd tables; small chunks."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest

from framespool.llm import ordered as ranges
from framespool.llm import prefix_trie, structure

CONVERSATIONS = "conv_id long, turn long, role string, text string"


@pytest.fixture(autouse=True)
def many_ranges(spark):
    """Ranges stay apart, however few rows they have, so that groups go over several."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def sha(text):
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def md5(text):
    return hashlib.md5(text.encode("utf-8", "surrogatepass")).digest()


def ordered(rows, mark):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), mark(r[2])))


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if fault == 0:
            continue
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        out += [(conv, turn, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
    return out


def cheapest(kinds):
    """(cost, edits, repaired roles) of rows (kind, initial, role, text), by plain dynamic programming over the rows."""
    legal = {"": "su", "s": "u", "u": "a", "a": "u"}
    best = {"": (0, "", ()), "a": (0, "", ())}
    for k in range(len(kinds), -1, -1):
        after, best = best, {} if k < len(kinds) else dict(best)
        if k < len(kinds):
            kind, initial, role, text = kinds[k]
            due = 3 if kind == "truncated" else 0
            for state in legal:
                ways = []
                if state in after:
                    cost, edits, out = after[state]
                    ways.append((cost + 4, "D" + edits, out))
                if kind not in ("blank", "duplicate"):
                    if initial and initial in legal[state] and initial in after:
                        cost, edits, out = after[initial]
                        ways.append((cost + due, "K" + edits, ((role, text), *out)))
                    for to, name in (("u", "user"), ("a", "assistant")):
                        if to in legal[state] and to in after:
                            cost, edits, out = after[to]
                            ways.append((cost + due + 3, "R" + edits, ((name, text), *out)))
                if ways:
                    best[state] = min(ways, key=lambda w: w[:2])
        for _ in range(4):
            for state in legal:
                for to, name in (("u", "user"), ("a", "assistant")):
                    if to in legal[state] and to in best:
                        cost, edits, out = best[to]
                        way = cost + 3, "I" + edits, ((name, ""), *out)
                        if state not in best or way[:2] < best[state][:2]:
                            best[state] = way
    return best[""]


def structures(rows):
    groups = defaultdict(list)
    for conv, turn, role, text in damage(rows):
        groups[conv].append((turn, role, text))
    out = []
    for conv in {r[0] for r in rows}:
        held, seen, kinds = ordered(groups[conv], md5), set(), []
        for _, role, text in held:
            bare = re.sub("[\x20\x09-\x0d]", "", text)
            kind = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""
            seen.add((role, text))
            kinds.append((kind, role[:1], role, text))
        turns = {t for t, _, _ in held if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        count = lambda name: sum(k[0] == name for k in kinds)  # noqa: B023, E731
        illegal = sum(a[1] + b[1] not in ("su", "ua", "au") for a, b in zip(kinds, kinds[1:], strict=False))
        cost, audit, repaired = cheapest(kinds)
        out.append((conv, gaps, count("blank"), count("duplicate"), count("truncated"), illegal, cost, audit, sha("\n".join(f"{r}:{t}" for r, t in repaired))))
    return out


def talk(r, conv, n, roles=("user", "assistant"), odd=0.2):
    rows = []
    for k in range(n):
        role = roles[k % len(roles)] if r.random() > odd else r.choice(["user", "assistant", "system", "", "tool", None, "Usher"])
        text = r.choice(["Yes.", "No!", "Why?", "and so", "", " \n", None, "é ü.", "x." + " " * 9, f"Word {r.randint(0, 99)}.", f"open {r.randint(0, 99)}"])
        rows.append((conv, None if r.random() < odd / 8 else k + r.choice([0, 0, 0, 1]), role, text))
    return rows


@pytest.fixture(scope="module")
def rows():
    r = random.Random(5)
    out = []
    for conv in range(60):
        out += talk(r, conv, r.randint(1, 9), odd=r.choice([0, 0.2, 0.6]))
    out += talk(r, 61, 300) + talk(r, 62, 120, ("user",), 0.02) + [(63, k, "user", f"Turn {k}.") for k in range(90)] + [(64, 3, "user", "Same.")] * 70
    out += talk(r, None, 9) + [(None, None, None, None)] * 40 + [(65, None, "assistant", "A.")] + [(66, k, "system", f"S {k}.") for k in range(30)] + out[:12]
    return out + talk(r, -7, 6) + [(67, k, "assistant" if k % 2 else "user", f"T {k}.") for k in range(200)]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory, rows):
    path = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(rows, CONVERSATIONS).repartition(5).write.parquet(f"{path}/conversations.parquet")
    return path


def same(df, columns, want):
    got = sorted((tuple(x[c] for c in columns) for x in df.collect()), key=str)
    assert got == sorted(want, key=str)


STRUCTURE = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def test_structure(spark, folder, rows):
    same(structure.op11_structure(spark, folder), STRUCTURE, structures(rows))


def by_sql(folder, sql, columns):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{folder}/conversations.parquet/*.parquet'")
    return con.execute(f"SELECT {', '.join(columns)} FROM ({sql})").fetchall()


def test_structure_by_sql(folder, rows):
    assert sorted(by_sql(folder, structure.SQL["op11_structure"], STRUCTURE), key=str) == sorted(structures(rows), key=str)


@pytest.mark.parametrize(("size", "passes"), [(1, 1), (7, 0), (16, 40)])
def test_structure_of_conversations_in_many_chunks(spark, folder, rows, size, passes):
    conversations = spark.read.parquet(f"{folder}/conversations.parquet")
    made = structure.repaired(structure.damaged(conversations), size, passes)
    same(structure.digests(conversations, *made), STRUCTURE, structures(rows))


def test_digests_over_ranges(spark, monkeypatch):
    """Groups within a range, over several, and longer than a piece; a null group."""
    monkeypatch.setattr(ranges, "PIECE", 300)
    r = random.Random(2)
    rows = [(r.choice([1, 1, 1, 1, 2, 3, None, *range(10, 30)]), k, r.choice(["", "é", "text " * 9])) for k in range(900)]
    got = ranges.ordered_sha256(spark.createDataFrame(rows, "g long, k long, t string").repartition(4), ["g"], ["k"], "t", "\n")
    groups = defaultdict(list)
    for g, _, t in rows:
        groups[g].append(t)
    same(got, ("g", "sha256"), [(g, sha("\n".join(t))) for g, t in groups.items()])


def test_structure_of_odd_tables(spark):
    odd = spark.createDataFrame([], CONVERSATIONS + ", id long, n long, kind string, at long")
    assert structure.digests(odd, *structure.repaired(structure.damaged(odd))).count() == 0
    text = "word " * 100_000 + "end."
    rows = [(1, 1, "user", text), (1, 2, "assistant", text[:-1])]
    clash = spark.createDataFrame([(*x, 0, 0, "", 0) for x in rows], odd.schema)
    same(structure.digests(clash, *structure.repaired(structure.damaged(clash))), STRUCTURE, structures(rows))


def test_runs_meet():
    """A fix-up ends where the vectors differ by a constant, with what a whole run gives."""
    r = random.Random(3)
    vectors = {structure.DONE}
    for _ in range(6):
        vectors |= {structure.before(v, c)[0] for v in vectors for c in range(8)}
    for _ in range(50):
        codes = bytes(r.choice(range(8)) for _ in range(30))
        old, new = r.choice(sorted(vectors)), r.choice(sorted(vectors))
        assert structure.mended(codes, old, new, *structure.swept(codes, old)) == structure.swept(codes, new)


TRIE = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def tries(rows):
    groups = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            groups[conv].append((turn, role or "", text or ""))
    own = {c: [(r, t) for _, r, t in ordered(held, lambda t: md5(t).hex())] for c, held in groups.items()}
    nodes, children, ends = defaultdict(list), defaultdict(set), defaultdict(list)
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        whole = tuple(own.get(c - (abs(c) % 5) * (1 if c > 0 else -1), [])[:h] + own[c][h:])
        for d in range(len(whole) + 1):
            nodes[whole[:d]].append(c)
            if d:
                children[whole[: d - 1]].add(whole[:d])
        ends[whole].append(c)
    leaves, saved = {}, {}
    for node in sorted(nodes, key=len, reverse=True):
        leaves[node] = sum(leaves[x] for x in children[node]) if children[node] else 1
        saved[node] = sum(saved[x] for x in children[node]) + (len(nodes[node]) - 1) * (len(node[-1][1].encode()) if node else 0)
    return [
        (min(m), len(x), min(nodes[x[:-1]]) if x else None, len(m), len(children[x]), leaves[x], saved[x], sha(",".join(map(str, sorted(ends[x])))))
        for x, m in nodes.items()
    ]


@pytest.fixture(scope="module")
def shared_turns():
    """Copies of whole conversations, shared first turns, long ones, absent bases, repeated and odd rows."""
    r = random.Random(8)
    few = [[("user", f"T {r.randint(0, 3)} é"), ("assistant", f"A {r.randint(0, 2)}")] * r.randint(0, 6) for _ in range(9)]
    out = []
    for conv in [*range(0, 160), *range(-23, 0), *range(1000, 1400, 7)]:
        held = r.choice(few) + [("user", f"own {r.randint(0, 40)}")] * r.randint(0, 3) if r.random() < 0.8 else few[0]
        out += [(conv, k, role if r.random() < 0.97 else None, text if r.random() < 0.97 else None) for k, (role, text) in enumerate(held)]
    out += [(2000, k, "user", f"L {k // 3}") for k in range(300)] + [(2003, k, "user", f"L {k // 3}") for k in range(290)] + [(2004, 1, "user", "x")] * 90
    return out + [(None, 1, "user", "x"), (2010, None, "user", "n"), (2010, 0, "user", "m"), (2010, None, None, None)]


@pytest.mark.parametrize("chunk", [prefix_trie.CHUNK, 3, 32])
def test_trie(spark, tmp_path, shared_turns, chunk):
    spark.createDataFrame(shared_turns, CONVERSATIONS).repartition(5).write.parquet(f"{tmp_path}/conversations.parquet")
    conversations = spark.read.parquet(f"{tmp_path}/conversations.parquet")
    made = prefix_trie.op13_prefix_trie(spark, str(tmp_path)) if chunk == prefix_trie.CHUNK else prefix_trie.trie(conversations, chunk)
    same(made, TRIE, tries(shared_turns))
    assert sorted(by_sql(tmp_path, prefix_trie.SQL["op13_prefix_trie"], TRIE), key=str) == sorted(tries(shared_turns), key=str)


def test_trie_in_small_shards(spark, shared_turns, monkeypatch):
    rows = [x for x in shared_turns if x[0] is not None]
    for limit in (1, 50):
        monkeypatch.setattr(prefix_trie, "SHARD", limit)
        columns = "conv bigint, chunk bigint, depth bigint, kind int, a bigint, b bigint, size bigint, last boolean"
        paths = spark.createDataFrame([(k // 10, 0, k % 10, 1, 0 if k % 10 == 0 else k % 10, 7 * (k % 10), 1, k % 10 == 9) for k in range(len(rows))], columns)
        parts = prefix_trie._shards(paths, prefix_trie._PARTS, prefix_trie._counted).filter("not ends").groupBy("depth").agg({"n": "sum"}).collect()
        assert sum(x[1] for x in parts) == len(rows)


def test_trie_of_odd_tables(spark):
    odd = spark.createDataFrame([], CONVERSATIONS + ", a long, b long, n long, depth long, chunk long")
    assert prefix_trie.trie(odd).count() == 0
    rows = [(1, 1, "user", "word " * 100_000), (2, None, None, None)]
    same(prefix_trie.trie(spark.createDataFrame([(*x, 0, 0, 0, 0, 0) for x in rows], odd.schema)), TRIE, tries(rows))


def test_slots_are_minimal_and_verified():
    r = np.random.default_rng(1)
    digests = prefix_trie.distinct(r.integers(0, 1 << 63, (5000, 2), dtype=np.uint64))
    digests[:100, 0] = 7
    slots = prefix_trie.Slots(digests)
    assert sorted(slots.of(digests)) == list(range(5000))
    assert (slots.of(r.integers(0, 1 << 63, (5000, 2), dtype=np.uint64)) == -1).all()
    with pytest.raises(ValueError):
        prefix_trie.Slots(np.zeros((2, 2), np.uint64))
