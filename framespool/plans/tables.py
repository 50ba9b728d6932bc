"""Reading the driver's tables and collecting queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rounded(df: DataFrame, places: int = 6, **of: int | None) -> DataFrame:
    """Doubles at 6 places, or as named (None: as they are), so that results compare by value."""
    return df.select(*(F.round(c, of.get(c, places)).alias(c) if kind == "double" and of.get(c, places) is not None else c for c, kind in df.dtypes))


class Registry:
    """Queries by name, and the SQL that gives the same rows."""

    def __init__(self) -> None:
        self.queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
        self.sql: dict[str, str] = {}

    def query(self, f):
        self.queries[f.__name__] = f
        return f
