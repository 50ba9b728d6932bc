"""Conversation structure repair: the cheapest edits that make a conversation's roles run (system)? (user assistant)+.

Rank-convergence Viterbi. A conversation's rows in order are cut into chunks of at most CHUNK rows, which may lie in
different tasks. The costs of what is still to do, a vector over the four states of the role order, run from the last row
to the first. Each chunk starts from a speculative vector, as if the conversation ended with it. In a fix-up pass every
chunk whose right neighbour has come to another vector, a constant apart, is run again from that, beside its former run,
until the two differ by a constant only; from there the former costs hold, but for the constant. Passes go on until no
chunk is to be run again. Rows that must go change no difference between states, so they are left out of the runs.
A monologue keeps two vectors apart for as long as it lasts, whatever its length. What is still open after PASSES is
therefore settled by the chunks' cost matrices (a run from each state), multiplied along the conversation by doubling.
The stitched costs then drive the trace: every chunk is traced from each of the four states, most end in one state
whichever they began in, the others are composed by doubling, and each chunk writes its part of the audit.

Order: rows go by turn, nulls first, then role, then MD5 of the text; equal rows lie next to each other. Roles count by
their first letter; any other than u, a, s (none included) can't be kept.

Cases: null role and text are one space. A null conv_id is a conversation of its own. Equal rows of one turn are one row
with a number from the first shuffle on. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .checksums import CRC_TABLE, crc32_sql
from .common import SPACE, arrow_batch, arrow_schema, checkpointed, split_join, stored, table
from .ordered import in_order, ordered_sha256

CHUNK, PASSES = 4096, 4
#: States: nothing yet, after the system's turn, after a user's, after an assistant's.
START, SYSTEM, USER, ASSISTANT = range(4)
#: Costs once all rows are done, and the state that an inserted or re-roled turn leads to.
DONE, NEXT = (0, 6, 3, 0), (USER, USER, ASSISTANT, USER)
KEEP, REROLE, DELETE, INSERT, CUT = 0, 3, 4, 3, 3
#: Rows by what they are: 0 user, 1 assistant, 2 system, 3 other; 4 more for truncated ones; GONE for those that must go.
TRUNCATED, GONE = 4, 8
NAMES = {USER: "user", ASSISTANT: "assistant"}
FAR = 1 << 40

Vector = tuple[int, int, int, int]


def kept(state: int, kind: int) -> int | None:
    """The state after keeping a row of this kind, if that is legal."""
    if kind == 0:
        return None if state == USER else USER
    if kind == 1:
        return ASSISTANT if state == USER else None
    return SYSTEM if kind == 2 and state == START else None


@lru_cache(maxsize=None)
def before(after: Vector, code: int) -> tuple[Vector, int]:
    """Costs before a row from those after it: a vector with least entry 0, and the constant taken off."""
    kind, due, costs = code & 3, CUT if code & TRUNCATED else 0, []
    for state in range(4):
        to = kept(state, kind)
        costs.append(min(DELETE + after[state], REROLE + due + after[NEXT[state]], FAR if to is None else KEEP + due + after[to]))
    costs[USER], costs[ASSISTANT] = min(costs[USER], INSERT + costs[ASSISTANT]), min(costs[ASSISTANT], INSERT + costs[USER])
    for state in (START, SYSTEM):
        costs[state] = min(costs[state], INSERT + costs[USER])
    least = min(costs)
    return tuple(FAR if c >= FAR // 2 else c - least for c in costs), least


@lru_cache(maxsize=None)
def step(after: Vector, code: int, state: int) -> tuple[str, int]:
    """The ASCII-least of the cheapest edits up to and with a row, and the state after it."""
    costs, least = before(after, code)
    kind, due, edits = code & 3, CUT if code & TRUNCATED else 0, ""
    while True:
        now, to = costs[state] + least, kept(state, kind)
        if DELETE + after[state] == now:
            return edits + "D", state
        if INSERT + costs[NEXT[state]] + least == now:
            edits, state = edits + "I", NEXT[state]
        elif to is not None and KEEP + due + after[to] == now:
            return edits + "K", to
        else:
            return edits + "R", NEXT[state]


def plain(vector) -> Vector:
    """The vector less its least entry."""
    least = min(vector)
    return tuple(int(v - least) for v in vector)


def swept(codes: bytes, right: Vector) -> tuple[Vector, int]:
    """The vector left of a chunk and the constant that the chunk adds."""
    total = 0
    for code in reversed(codes):
        right, more = before(right, code)
        total += more
    return right, total


def mended(codes: bytes, old: Vector, new: Vector, left: Vector, total: int) -> tuple[Vector, int]:
    """swept(codes, new), of a chunk for which swept(codes, old) was (left, total): only until the two runs meet."""
    for code in reversed(codes):
        if old == new:
            return left, total
        (old, a), (new, b) = before(old, code), before(new, code)
        total += b - a
    return new, total


def matrix(codes: bytes) -> list[int]:
    """The chunk's costs from each state on its left to each on its right, by rows."""
    columns = []
    for state in range(4):
        # inserts behind the last row are paid for in the chunk on the right
        left, total = swept(codes, tuple(0 if k == state else FAR for k in range(4)))
        columns.append([min(v + total, FAR) for v in left])
    return [columns[to][at] for at in range(4) for to in range(4)]


def traced(codes: bytes, right: Vector, entry: int) -> tuple[list[str], int]:
    """Edits of each row (with the inserts before it) from a state on the chunk's left, and the state on its right."""
    vectors = [right]
    for code in reversed(codes[1:]):
        vectors.append(before(vectors[-1], code)[0])
    edits = []
    for code in codes:
        edit, entry = step(vectors.pop(), code, entry)
        edits.append(edit)
    return edits, entry


def closing(state: int) -> str:
    return "I" * (DONE[state] // INSERT)


def chunks(rows: DataFrame, size: int) -> DataFrame:
    """One row a chunk, by id in order. rows: conv and none (its key), has_turn, turn, role, mark, n (equal rows), code.
    next: the id of the conversation's next chunk."""
    fields = "has_turn boolean, turn bigint, role string, mark binary, n bigint, code int"
    schema = f"none boolean, conv bigint, id bigint, more boolean, edge boolean, rows array<struct<{fields}>>"
    out_schema, names = arrow_schema(schema), ["none", "conv", "has_turn", "turn", "role", "mark", "n", "code"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        part, seq, at, held = TaskContext.get().partitionId() << 33, 0, None, []
        for batch in batches:
            for row in batch.to_pylist():
                key = row.pop("none"), row.pop("conv")
                if held and (key != at or len(held) == size):
                    yield *at, part | seq, key == at, seq == 0, held
                    seq, held = seq + 1, []
                at = key
                held.append(row)
        if held:
            yield *at, part | seq, None, True, held

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for chunk in cut(batches):
            out.append(chunk)
            if len(out) * 8 + sum(len(c[-1]) for c in out[-8:]) > 4096:
                yield arrow_batch(out, out_schema)
                out = []
        if out:
            yield arrow_batch(out, out_schema)

    made = stored(in_order(rows, ["none", "conv", "has_turn", "turn", "role", "mark"]).select(*names).mapInArrow(run, schema))
    order = Window.orderBy("id")  # over the first and the last chunk of each range, so two rows a range at most
    edges = made.filter("edge").select("id", "none", "conv", "more")
    follow = F.when((F.lead("conv").over(order) == F.col("conv")) & (F.lead("none").over(order) == F.col("none")), F.lead("id").over(order))
    edges = edges.select("id", "more", follow.alias("follow")).filter("more is null and follow is not null").select("id", "follow")
    initials = F.transform("rows", lambda x: F.substring(x["role"], 1, 1))
    made = made.join(F.broadcast(edges), "id", "left").withColumn("next", F.coalesce("follow", F.when(F.col("more"), F.col("id") + 1)))
    live = F.transform(F.filter("rows", lambda x: x["code"] < GONE), lambda x: F.substring(F.hex(x["code"]), -1, 1))
    codes = F.unhex(F.concat_ws("", F.transform(live, lambda x: F.concat(F.lit("0"), x))))
    return stored(made.select("none", "conv", "id", "next", "rows", codes.alias("codes"), initials.alias("initials")))


def each(rows: DataFrame, schema: str, what) -> DataFrame:
    """what(dict) -> tuple, for each row."""
    out_schema = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                yield arrow_batch([what(row) for row in batch.slice(start, 256).to_pylist()], out_schema)

    return rows.mapInArrow(run, schema)


_STATE = "id bigint, next bigint, right array<int>, left array<int>, total bigint"


def settled(made: DataFrame, passes: int) -> DataFrame:
    """id, next, right (the true vector on a chunk's right), left, total."""
    narrow = made.select("id", "next", "codes")
    state = checkpointed(each(narrow, _STATE, lambda c: (c["id"], c["next"], DONE, *swept(c["codes"], DONE))))

    def stale() -> DataFrame:
        after = state.select(F.col("id").alias("next"), F.col("left").alias("now"))
        return state.join(after, "next").filter("now <> right").select("id", "now")

    def updated(fixed: DataFrame) -> DataFrame:
        fixed = fixed.select("id", *(F.col(c).alias(f"_{c}") for c in ("right", "left", "total")))
        new = state.join(fixed, "id", "left")
        return checkpointed(new.select("id", "next", *(F.coalesce(f"_{c}", c).alias(c) for c in ("right", "left", "total"))))

    def again(c: dict) -> tuple:
        now = tuple(c["now"])
        return c["id"], c["next"], now, *mended(c["codes"], tuple(c["right"]), now, tuple(c["left"]), c["total"])

    for _ in range(passes):
        todo = stale()
        if todo.isEmpty():
            return state
        state = updated(each(narrow.join(todo, "id").join(state.drop("next"), "id"), _STATE, again))
    if stale().isEmpty():
        return state
    # chains of chunks that keep their vectors apart: matrices from each chunk to the end of its conversation
    open_ = stale().join(made.select("id", "none", "conv"), "id").select("none", "conv").distinct()
    chains = made.join(open_, ["none", "conv"], "left_semi").select("id", "next", "codes")
    links = each(chains, "id bigint, next bigint, way array<bigint>", lambda c: (c["id"], c["next"], matrix(c["codes"])))
    product = lambda near, far: F.expr(f"transform(sequence(0, 15), k -> array_min(transform(sequence(0, 3), j -> {near}[(k div 4) * 4 + j] + {far}[j * 4 + k % 4])))")
    end = ", ".join(f"{v}L" for v in DONE)
    now = F.expr(f"transform(sequence(0, 3), k -> array_min(transform(sequence(0, 3), j -> way[k * 4 + j] + array({end})[j])))")
    lefts = composed(links, product).select(F.col("id").alias("next"), now.alias("now"))
    rerun = chains.join(lefts, "next")
    return updated(each(rerun, _STATE, lambda c: (c["id"], c["next"], plain(c["now"]), *swept(c["codes"], plain(c["now"])))))


def composed(links: DataFrame, product) -> DataFrame:
    """(id, way): the product of each link's way with those of all that follow it (id -> next), in as many rounds as the
    longest chain has binary digits."""
    links = checkpointed(links)
    while not links.filter("next is not null").isEmpty():
        far = links.select(F.col("id").alias("next"), F.col("next").alias("_next"), F.col("way").alias("_way"))
        both = links.join(far, "next", "left")
        way = F.when(F.col("_way").isNull(), F.col("way")).otherwise(product("way", "_way"))
        links = checkpointed(both.select("id", F.col("_next").alias("next"), way.alias("way")))
    return links.select("id", "way")


def entries(made: DataFrame, state: DataFrame) -> DataFrame:
    """(id, entry): the state in which each chunk that isn't its conversation's first is entered."""
    many = made.select("id", "next", "codes").join(state.select("id", "right"), "id")
    later = many.select(F.col("next").alias("id")).filter("id is not null")
    exits = each(many.filter("next is not null"), "id bigint, next bigint, way array<int>", lambda c: (c["id"], c["next"], [traced(c["codes"], tuple(c["right"]), s)[1] for s in range(4)]))
    # way: where a chunk is left, by the state in which its conversation's former chunk (or START) was entered
    back = exits.select(F.col("next").alias("id"), F.col("id").alias("next"), "way")
    first = back.join(later.withColumnRenamed("id", "next"), "next", "left_anti").select("id")
    known = F.size(F.array_distinct("way")) == 1
    back = back.join(first.withColumn("first", F.lit(True)), "id", "left").select("id", F.when(known | F.col("first"), None).otherwise(F.col("next")).alias("next"), "way")
    whole = composed(back, lambda near, far: F.expr(f"transform({far}, x -> {near}[x])"))
    return whole.select("id", F.col("way")[START].alias("entry"))


def repaired(conversations: DataFrame, size: int = CHUNK, passes: int = PASSES) -> tuple[DataFrame, DataFrame]:
    """Faults and edits of each conversation, and its rows once repaired.

    First: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit. Second: conv_id, at (their order), text, one
    "role:text" a row or several, newline-joined."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    rows = conversations.select(
        F.col("conv_id").isNull().alias("none"), F.coalesce("conv_id", F.lit(0)).cast("bigint").alias("conv"), F.col("turn").isNotNull().alias("has_turn"), F.coalesce("turn", F.lit(0)).cast("bigint").alias("turn"),
        role.alias("role"), text.alias("text"), F.unhex(F.md5(text)).alias("mark"),
    )
    conv, row = ["none", "conv"], ["none", "conv", "has_turn", "turn", "role", "mark"]
    bare = F.rtrim("text", F.lit(SPACE))
    kind = F.coalesce(F.element_at(F.create_map(*(F.lit(x) for x in ("u", 0, "a", 1, "s", 2))), F.substring("role", 1, 1)), F.lit(3))
    code = F.when(bare == "", GONE).otherwise(kind + F.when(F.substring(bare, -1, 1).isin(".", "!", "?"), 0).otherwise(TRUNCATED))
    # equal rows of one turn are one row; those of other turns are compared by their first turn
    rows_ = stored(rows.select(*row, code.cast("int").alias("code")).groupBy(*row, "code").agg(F.count("*").alias("n")))
    firsts = rows_.groupBy(*conv, "role", "mark").agg(F.min(F.struct("has_turn", "turn")).alias("first"), F.count("*").alias("turns")).filter("turns > 1")
    seen = split_join(rows_, stored(firsts), [*conv, "role", "mark"], "turns", "left")
    repeated = F.coalesce(F.struct("has_turn", "turn") > F.col("first"), F.lit(False)) & (F.col("code") < GONE)
    coded = seen.select(*row, "n", F.when(repeated, GONE + 1).otherwise(F.col("code")).alias("code"))
    made = chunks(coded, size)
    state = settled(made, passes)
    edited = _edited(made, state)
    times = rows_.groupBy(*conv).agg(F.min(F.when(F.col("has_turn"), F.col("turn"))).alias("lo"), F.max(F.when(F.col("has_turn"), F.col("turn"))).alias("hi"), F.count_distinct(F.when(F.col("has_turn"), F.col("turn"))).alias("turns"))
    times = times.select(*conv, F.coalesce(F.expr("hi - lo + 1 - turns"), F.lit(0)).alias("gaps"))
    pieces = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("id", "audit"))), lambda x: x["audit"]), "")
    sums = ("blank", "duplicate", "truncated", "illegal", "cost")
    faults = edited.groupBy(*conv).agg(*(F.sum(c).alias(c) for c in sums), pieces.alias("audit")).join(times, conv)
    conv_id = F.when(~F.col("none"), F.col("conv")).alias("conv_id")
    at = edited.select(*conv, "id", F.posexplode("edits").alias("k", "edit")).select(*conv, "id", "k", "edit.*")
    # the texts of rows that stay, one of equal ones each; what is inserted behind the last row comes without one
    texts = rows.select(*row, "text").groupBy(*row).agg(F.first("text").alias("text"))
    own = at.filter("mark is not null").join(texts, row).select(*conv, "id", "k", F.concat("inserted", "name", F.lit(":"), "text").alias("text"))
    end = at.filter("mark is null").select(*conv, "id", "k", F.col("inserted").alias("text"))
    return faults.select(conv_id, "gaps", *sums, "audit"), own.unionByName(end).select(conv_id, F.struct("id", "k").alias("at"), "text")


def _edited(made: DataFrame, state: DataFrame) -> DataFrame:
    """none, conv, id, blank, duplicate, truncated, illegal, cost, audit, edits of each chunk."""
    enter = F.coalesce("entry", F.lit(START))
    after = made.select(F.col("id").alias("next"), F.col("initials")[0].alias("follows"))
    rows = made.join(state.select("id", "right", "left", "total"), "id").join(entries(made, state), "id", "left").join(after, "next", "left")
    rows = rows.select("none", "conv", "id", "next", "rows", "codes", "right", "left", "total", enter.alias("entry"), "follows", F.col("entry").isNull().alias("first"))
    edit = "has_turn boolean, turn bigint, role string, mark binary, name string, inserted string"
    schema = f"none boolean, conv bigint, id bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, edits array<struct<{edit}>>"

    def written(c: dict) -> tuple:
        edits, _ = traced(c["codes"], tuple(c["right"]), c["entry"])
        todo, state = iter(edits), c["entry"]
        blank = duplicate = truncated = illegal = 0
        # the first chunk of a conversation pays for what its vector has above its least entry
        cost = c["total"] + (c["left"][START] if c["first"] else 0)
        audit, out, last = [], [], None
        for row in c["rows"]:
            n, code, initial = row["n"], row["code"], row["role"][:1]
            illegal += (last is not None and last + initial not in ("su", "ua", "au")) + (n - 1)
            last = initial
            blank += n if code == GONE else 0
            duplicate += n if code == GONE + 1 else n - 1 if code < GONE else 0
            truncated += TRUNCATED <= code < GONE
            if code >= GONE:
                audit.append("D" * n)
                cost += DELETE * n
                continue
            edit = next(todo)
            audit.append(edit + "D" * (n - 1))
            cost += DELETE * (n - 1)
            inserted = []
            for letter in edit:
                if letter == "I":
                    state = NEXT[state]
                    inserted.append(f"{NAMES[state]}:\n")
                elif letter != "D":
                    state = kept(state, code & 3) if letter == "K" else NEXT[state]
                    name = row["role"] if letter == "K" else NAMES[state]
                    out.append((row["has_turn"], row["turn"], row["role"], row["mark"], name, "".join(inserted)))
        if c["next"] is None:
            behind = closing(state)
            audit.append(behind)
            names = []
            for _ in behind:
                state = NEXT[state]
                names.append(f"{NAMES[state]}:")
            if names:
                out.append((None, None, None, None, None, "\n".join(names)))
        else:
            illegal += last + c["follows"] not in ("su", "ua", "au")
        return c["none"], c["conv"], c["id"], blank, duplicate, truncated, illegal, cost, "".join(audit), [dict(zip(_EDIT, e, strict=True)) for e in out]

    return stored(each(rows, schema, written))


_EDIT = ("has_turn", "turn", "role", "mark", "name", "inserted")


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text with the faults of the contract, by crc32 of "conv_id:turn"."""
    spaced = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn")).cast("binary")) % 20
    role, text = F.when(fault == 4, "user").otherwise(spaced("role")), spaced("text")
    text = F.when(fault == 1, "").when(fault == 2, F.translate(text, ".!?", "")).otherwise(text)
    rows = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), fault.alias("fault")).filter("fault <> 0")
    return rows.withColumn("copy", F.explode(F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))).drop("fault", "copy")


def op11_structure(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    return digests(conversations, *repaired(damaged(conversations)))


def digests(conversations: DataFrame, faults: DataFrame, rows: DataFrame) -> DataFrame:
    """Every conv_id, with zeros where nothing is left of it, and the digest of its repaired rows."""
    texts = ordered_sha256(rows.select("conv_id", "at", "text"), ["conv_id"], ["at"], "text", "\n").withColumnRenamed("sha256", "repaired_sha256")
    key = [F.col("conv_id").isNull().alias("none"), F.coalesce("conv_id", F.lit(0)).cast("bigint").alias("conv")]
    keyed = lambda df: df.select(*key, *(c for c in df.columns if c != "conv_id"))
    ids = conversations.select("conv_id").distinct().select("conv_id", *key)
    out = ids.join(keyed(faults), ["none", "conv"], "left").join(keyed(texts), ["none", "conv"], "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("bigint").alias(c)
    return out.select(
        "conv_id", *(zero(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"),
    )


QUERIES = {"op11_structure": op11_structure}


def _sql() -> str:
    """Plain dynamic programming in SQL: the cheapest (cost, edits, repaired rows) from each state, row by row from the last."""
    spaced, bare = "coalesce({}, ' ')", "rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"
    way = lambda cost, edit, line, at: f"{{'c': {at}.c + {cost}, 'a': '{edit}' || {at}.a, 'o': {line} || CASE WHEN {at}.o = '' THEN '' ELSE chr(10) || {at}.o END}}"
    gone = lambda at: f"{{'c': {at}.c + {DELETE}, 'a': 'D' || {at}.a, 'o': {at}.o}}"
    names, initials = ("s0", "s1", "s2", "s3"), {0: "u", 1: "a", 2: "s"}

    def taken(state: int) -> str:
        due = f"CASE WHEN code = {TRUNCATED} THEN {CUT} ELSE 0 END"
        keeps = [f"CASE WHEN initial = '{initial}' AND code < {GONE} THEN {way(due, 'K', 'role || chr(58) || text', names[kept(state, kind)])} END" for kind, initial in initials.items() if kept(state, kind) is not None]
        again = f"CASE WHEN code < {GONE} THEN {way(f'{REROLE} + {due}', 'R', f"'{NAMES[NEXT[state]]}:' || text", names[NEXT[state]])} END"
        return f"list_sort(list_filter([{', '.join([gone(names[state]), again, *keeps])}], lambda w: w IS NOT NULL))[1]"

    inserted = lambda state, at: way(INSERT, "I", f"'{NAMES[NEXT[state]]}:'", at)
    zero, two = "{'c': 0::BIGINT, 'a': '', 'o': ''}", f"{{'c': {2 * INSERT}::BIGINT, 'a': 'II', 'o': 'user:' || chr(10) || 'assistant:'}}"
    one = f"{{'c': {INSERT}::BIGINT, 'a': 'I', 'o': 'assistant:'}}"
    better = lambda state, at: f"list_sort([b{state}, {inserted(state, at)}])[1]"
    return f"""WITH RECURSIVE {CRC_TABLE},
f AS (SELECT conv_id, turn, {spaced.format("role")} AS role, {spaced.format("text")} AS text, {crc32_sql(f"{spaced.format('conv_id::VARCHAR')} || ':' || {spaced.format('turn::VARCHAR')}")} % 20 AS fault FROM conversations, crc_table),
d AS (SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role, CASE fault WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
unnest(CASE WHEN fault = 3 THEN [0, 1] ELSE [0] END) AS copy FROM f WHERE fault > 0),
n AS MATERIALIZED (SELECT *, {bare} AS bare, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text)) AS i FROM d),
r AS MATERIALIZED (SELECT conv_id, i, turn, role, text, left(role, 1) AS initial, CASE WHEN bare = '' THEN {GONE} WHEN row_number() OVER (PARTITION BY conv_id, role, md5(text) ORDER BY i) > 1 THEN {GONE + 1}
WHEN right(bare, 1) IN ('.', '!', '?') THEN 0 ELSE {TRUNCATED} END AS code, left(role, 1) || left(lead(role) OVER (PARTITION BY conv_id ORDER BY i), 1) AS pair FROM n),
g AS (SELECT conv_id, max(i) AS i, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count_if(code = {GONE}) AS blank, count_if(code = {GONE + 1}) AS duplicate,
count_if(code = {TRUNCATED}) AS truncated, count_if(pair NOT IN ('su', 'ua', 'au')) AS illegal FROM r GROUP BY conv_id),
v AS (SELECT conv_id, i, {zero} AS s0, {two} AS s1, {one} AS s2, {zero} AS s3 FROM g UNION ALL
SELECT conv_id, i, list_sort([b0, {inserted(START, "u2")}])[1], list_sort([b1, {inserted(SYSTEM, "u2")}])[1], u2, {better(ASSISTANT, "b2")} FROM (SELECT *, {better(USER, "b3")} AS u2 FROM
(SELECT v.conv_id, v.i - 1 AS i, {", ".join(f"{taken(state)} AS b{state}" for state in range(4))} FROM v JOIN r ON v.conv_id IS NOT DISTINCT FROM r.conv_id AND v.i = r.i))),
w AS (SELECT conv_id, s0 FROM v WHERE i = 0)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
coalesce(s0.c, 0) AS cost, coalesce(s0.a, '') AS audit, sha256(coalesce(s0.o, '')) AS repaired_sha256 FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN g ON o.conv_id IS NOT DISTINCT FROM g.conv_id LEFT JOIN w ON o.conv_id IS NOT DISTINCT FROM w.conv_id"""


SQL = {"op11_structure": _sql()}
