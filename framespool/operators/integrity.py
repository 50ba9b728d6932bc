"""Integrity: rule tables, reconciliation, manifests, round-trip comparison. Issues are rows (severity, code, key, message)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.basic import col

ISSUE = ("severity", "code", "key", "message")


def rule(condition: Column, severity: str, code: str, message) -> Column:
    """The issue as a struct where the condition holds, else null."""
    text = F.lit(message) if isinstance(message, str) else message
    return F.when(condition, F.struct(F.lit(severity).alias("severity"), F.lit(code).alias("code"), text.alias("message")))


def row_issues(df: DataFrame, key, rules: list[Column]) -> DataFrame:
    """All issues of all rows: one scan, one array a row, no join."""
    found = df.select(col(key).cast("string").alias("key"), F.explode(F.filter(F.array(*rules), lambda x: x.isNotNull())).alias("_x"))
    return found.select("_x.severity", "_x.code", "key", "_x.message")


def missing_required(have: DataFrame, by: str, item: str, required: DataFrame, severity: str = "ERROR", code: str = "MISSING") -> DataFrame:
    """Required items that a unit lacks. required: (item), a catalogue of fixed size."""
    want = have.select(by).distinct().crossJoin(F.broadcast(required.select(item)))
    gone = want.join(have.select(by, item).distinct(), [by, item], "left_anti")
    return gone.select(F.lit(severity).alias("severity"), F.lit(code).alias("code"), F.col(by).cast("string").alias("key"), F.concat(F.lit("missing "), F.col(item)).alias("message"))


def reconciled(left: DataFrame, right: DataFrame, key: str, left_code: str, right_code: str, severity: str = "ERROR") -> DataFrame:
    """Keys on one side only, as issues."""
    def only(a: DataFrame, b: DataFrame, code: str, text: str) -> DataFrame:
        lone = a.select(key).distinct().join(b.select(key).distinct(), key, "left_anti")
        return lone.select(F.lit(severity).alias("severity"), F.lit(code).alias("code"), F.col(key).cast("string").alias("key"), F.lit(text).alias("message"))

    return only(left, right, left_code, "only on the left").unionByName(only(right, left, right_code, "only on the right"))


def roll_up(issues: DataFrame) -> DataFrame:
    """Issues by severity and code, whether the run fails (any ERROR) with it."""
    return issues.groupBy("severity", "code").agg(F.count("*").alias("n")).withColumn("fails", F.col("severity") == "ERROR")


def shipped(path: Column, internal: tuple[str, ...] = (".staging", ".logs", ".tmp"), markers: tuple[str, ...] = (".running.json", ".failed.json", ".complete.json")) -> Column:
    """Whether a release ships a path (relative to its root): not what lies in internal folders, nor the markers of an
    episode's state (by the ends of their names), nor the manifest itself."""
    top, name = F.substring_index(path, "/", 1), F.substring_index(path, "/", -1)
    marker = F.lit(False)
    for end in markers:
        marker = marker | (F.startswith(name, F.lit(".")) & F.endswith(name, F.lit(end)))
    return ~top.isin(*internal) & ~marker & (path != "meta/manifest.json")


def manifest(files: DataFrame, path: str, content, keep: Column | None = None) -> DataFrame:
    """(path, sha256, size) of each file that is shipped (keep: another condition besides)."""
    data = col(content).cast("binary")
    files = files.filter(shipped(F.col(path)) if keep is None else shipped(F.col(path)) & keep)
    return files.select(F.col(path).alias("path"), F.sha2(data, 256).alias("sha256"), F.octet_length(data).cast("long").alias("size"))


def manifest_totals(manifest_: DataFrame) -> DataFrame:
    """total_files and total_bytes."""
    return manifest_.agg(F.count("*").alias("total_files"), F.coalesce(F.sum("size"), F.lit(0)).alias("total_bytes"))


def verified(manifest_: DataFrame, files: DataFrame) -> DataFrame:
    """status of each manifest entry against what is there: MISSING, then SIZE, then HASH, else OK."""
    there = files.select("path", F.col("sha256").alias("_sha"), F.col("size").alias("_size"))
    status = (
        F.when(F.col("_size").isNull(), "MISSING").when(F.col("size") != F.col("_size"), "SIZE").when(~F.col("sha256").eqNullSafe(F.col("_sha")), "HASH").otherwise("OK")
    )
    return manifest_.join(there, "path", "left").select("path", status.alias("status"))


def verdict(status: DataFrame) -> DataFrame:
    """verified() by status: how many, and whether the release fails with it."""
    return status.groupBy("status").agg(F.count("*").alias("n")).withColumn("fails", F.col("status") != "OK")


def delta(local: DataFrame, remote: DataFrame) -> DataFrame:
    """new, changed or unchanged for each local file; what is only remote doesn't count (one way)."""
    there = remote.select("path", F.col("sha256").alias("_sha"), F.lit(True).alias("_is"))
    state = F.when(F.col("_is").isNull(), "new").when(F.col("sha256").eqNullSafe(F.col("_sha")), "unchanged").otherwise("changed")
    return local.join(there, "path", "left").select("path", state.alias("state"))


def unknown_values(df: DataFrame, family: str, value: str, vocabulary: DataFrame) -> DataFrame:
    """Observed values that the vocabulary of their family lacks; families without a vocabulary are skipped. Null isn't
    a value. vocabulary: (family, value), checked by its size when it is joined."""
    seen = df.filter(F.col(value).isNotNull()).select(family, value).distinct()
    return seen.join(vocabulary.select(family).distinct(), family, "left_semi").join(vocabulary.select(family, value), [family, value], "left_anti")


def duplicates(df: DataFrame, keys: list[str], what: str) -> DataFrame:
    """Keys with several rows, and the sorted distinct values that they come from."""
    counts = df.groupBy(*keys, F.col(what).cast("string").alias("_what")).agg(F.count("*").alias("_n"))
    return counts.groupBy(*keys).agg(F.sum("_n").alias("n"), F.array_join(F.sort_array(F.collect_list("_what")), ",").alias("sources")).filter("n > 1")


def refuse_duplicates(df: DataFrame, keys: list[str], what: str) -> DataFrame:
    """df, or an error when it is run if a key has several rows of different origin."""
    clash = df.groupBy(*keys).agg(F.count_distinct(what).alias("_n"))
    checked = clash.withColumn("_ok", F.when(F.col("_n") > 1, F.raise_error(F.concat_ws(" ", F.lit("two targets for"), *keys)).cast("boolean")).otherwise(True))
    return df.join(checked.filter("_ok").drop("_n", "_ok"), keys, "left_semi")


def not_done(clips: DataFrame, done: DataFrame, key: str, forced: DataFrame | None = None) -> DataFrame:
    """Clips without a completion entry, and those to be done again."""
    todo = clips.join(done.select(key).distinct(), key, "left_anti")
    return todo if forced is None else todo.unionByName(clips.join(forced.select(key).distinct(), key, "left_semi")).distinct()


def round_trip(first: DataFrame, second: DataFrame, doc: str, scalars: dict[str, str], known_lossy: list[str] = (), tolerance: float = 1e-5) -> DataFrame:
    """(doc, path, kind) of leaves that the second document lacks or has otherwise. Numbers may differ by
    tolerance * max(1, |a|); null equals null; what only the second has doesn't count.

    Documents meet once, side by side, and leaves are compared in their own types (as text where the types differ); only
    those that differ become rows."""
    kinds, others = dict(first.dtypes), dict(second.dtypes)
    numeric = lambda kind: kind in ("tinyint", "smallint", "int", "bigint", "float", "double") or kind.startswith("decimal")
    leaves = [(c, path) for c, path in scalars.items() if path not in known_lossy]
    a = first.select(doc, *(F.col(c).alias(f"_a{k}") for k, (c, _) in enumerate(leaves)))
    b = second.select(doc, *(F.col(c).alias(f"_b{k}") for k, (c, _) in enumerate(leaves)))
    found = []
    for k, (c, path) in enumerate(leaves):
        x, y = F.col(f"_a{k}"), F.col(f"_b{k}")
        if numeric(kinds[c]) and numeric(others[c]):
            x, y = x.cast("double"), y.cast("double")
            same = F.coalesce(F.abs(x - y) <= tolerance * F.greatest(F.lit(1.0), F.abs(x)), F.lit(False)) | (x == y)
        else:
            same = x == y if kinds[c] == others[c] else x.cast("string") == y.cast("string")
        kind = F.when(x.isNotNull() & y.isNull(), "missing").when(x.isNotNull() & ~same, "differs")
        found.append(F.when(kind.isNotNull(), F.struct(F.lit(path).alias("path"), kind.alias("kind"))))
    both = a.join(b, doc, "left").select(doc, F.explode(F.filter(F.array(*found), lambda x: x.isNotNull())).alias("_x"))
    return both.select(doc, "_x.path", "_x.kind")
