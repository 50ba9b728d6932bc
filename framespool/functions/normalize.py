"""Stamps, legacy documents and labels as column expressions; all stay on the JVM."""

from __future__ import annotations

import fnmatch

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NANOS = 1_000_000_000
#: How absent labels are written.
ABSENT = ("none", "null", "nan", "")


def to_ns(sec: Column, nsec: Column) -> Column:
    """sec * 1e9 + nsec; null if either is."""
    return sec.cast("long") * NANOS + nsec.cast("long")


def from_ns(ns: Column) -> tuple[Column, Column]:
    """(sec, nsec) with 0 <= nsec < 1e9, before 1970 too."""
    nsec = F.pmod(ns, F.lit(NANOS))
    return ((ns - nsec) / NANOS).cast("long"), nsec


def parsed_stamp(text: Column) -> tuple[Column, Column]:
    """(sec, nsec) of 'sec_nsec'; anything else gives zeros."""
    parts = F.split(text, "_")
    sec, nsec = F.get(parts, F.lit(0)).try_cast("bigint"), F.get(parts, F.lit(1)).try_cast("bigint")
    good = (F.size(parts) == 2) & sec.isNotNull() & nsec.isNotNull()
    return F.when(good, sec).otherwise(F.lit(0).cast("long")), F.when(good, nsec).otherwise(F.lit(0).cast("long"))


def legacy_velocity(velocity: Column) -> tuple[Column, Column]:
    """(linear, angular) of a six-vector; a missing one counts as six zeros."""
    six = F.coalesce(velocity, F.array_repeat(F.lit(0.0), 6))
    return F.slice(six, 1, 3), F.slice(six, 4, 3)


def renamed(df: DataFrame, names: dict[str, str], drop: list[str] = ()) -> DataFrame:
    """Legacy columns under their new names, obsolete ones gone."""
    return df.withColumnsRenamed(names).drop(*drop)


def legacy_format(header: Column, marks: list[str], base: list[str]) -> Column:
    """B if any of the per-topic keys is in the header (a map), A if only the base keys are, else unknown."""
    has = lambda k: F.coalesce(F.map_contains_key(header, k), F.lit(False))
    whole, any_ = F.lit(True), F.lit(False)
    for k in base:
        whole = whole & has(k)
    for k in marks:
        any_ = any_ | has(k)
    return F.when(~whole, "unknown").when(any_, "B").otherwise("A")


def backfilled_stamps(topics: dict[str, Column], base: Column) -> list[Column]:
    """Every topic's own stamp, else the base stamp; with only the base (format A) that fills all."""
    return [F.coalesce(c, base).alias(name) for name, c in topics.items()]


def first_present(*places: Column) -> Column:
    """A value that may sit in several places: the first place that has it wins."""
    return F.coalesce(*places)


def clean_label(label: Column) -> Column:
    """Trimmed; the ways to write absence in any case become null."""
    text = F.trim(label)
    return F.when(~F.lower(text).isin(*ABSENT), text)


def projected(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of the schema in its order and types; missing ones are typed nulls."""
    return df.select(*((F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields))


def flattened(array: Column, names: list[str], least: int | None = None, default: float | None = None) -> list[Column]:
    """Array positions as scalars, null (or the default) where the array is shorter than `least` or the position."""
    fits = F.lit(True) if least is None else F.size(array) >= least
    out = []
    for k, name in enumerate(names):
        value = F.when(fits, F.get(array, F.lit(k)))
        out.append((value if default is None else F.coalesce(value, F.lit(default))).alias(name))
    return out


def renamed_key(entries: Column, old: str, new: str) -> Column:
    """The map with one key renamed, others kept."""
    return F.transform_keys(entries, lambda k, _: F.when(k == old, F.lit(new)).otherwise(k))


def path_filter(path: Column, allow: list[str] = ("*",), deny: list[str] = ()) -> Column:
    """Paths that some allow glob fits and no deny glob does; the globs become one regular expression on the driver."""
    def any_of(globs: list[str]) -> Column:
        return path.rlike("|".join(f"(?:{fnmatch.translate(g)})" for g in globs)) if globs else F.lit(False)

    return any_of(list(allow)) & ~any_of(list(deny))


def iso_to_ns(text: Column) -> Column:
    """ISO text to ns since 1970: no zone is UTC (the session's), what can't be read is 0."""
    return F.coalesce(F.unix_micros(F.try_to_timestamp(text)) * 1000, F.lit(0).cast("long"))


def log_lines(lines: DataFrame, line: str = "value") -> DataFrame:
    """(stream, count, elapsed_s, rate) of the log lines that report a stream, `... | stream: N PNGs in S s (R fps)`, the
    rate only on some and JSONs for PNGs on others; other lines are dropped."""
    report = F.substring_index(line, "|", -1)
    words = F.split(F.trim(F.substring_index(report, ":", -1)), r"\s+")
    word = lambda k: F.get(words, F.lit(k))
    rate = F.when(F.endswith(word(5), F.lit("fps)")), F.ltrim(word(4), F.lit("("))).when(F.startswith(word(4), F.lit("(")), F.regexp_replace(word(4), r"[()]|fps", ""))
    parsed = lines.filter(F.contains(line, F.lit("|"))).select(
        F.trim(F.substring_index(report, ":", 1)).alias("stream"), word(0).try_cast("int").alias("count"), F.rtrim(word(3), F.lit("s")).try_cast("double").alias("elapsed_s"),
        rate.try_cast("double").alias("rate"), word(1).isin("PNGs", "JSONs").alias("_kind"), (word(2) == "in").alias("_in"),
    )
    return parsed.filter("_kind AND _in AND count IS NOT NULL AND elapsed_s IS NOT NULL").drop("_kind", "_in")
