"""Projections, filters and set operations of the observed jobs."""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodewatch.functions.keys import as_col, quoted


def filter_eq(df: DataFrame, column: str, value) -> DataFrame:
    return df.where(quoted(column) == F.lit(value))


def filter_le(df: DataFrame, column: str, value) -> DataFrame:
    """Rows at or below a bound; NULL and NaN compare false (Spark sorts NaN above every number)."""
    return df.where(quoted(column) <= F.lit(value))


def filter_conj(df: DataFrame, predicates: Sequence[Column]) -> DataFrame:
    return df.where(reduce(lambda a, b: a & b, predicates)) if predicates else df


def derive_diff(df: DataFrame, name: str, left: Column | str, right: Column | str) -> DataFrame:
    def side(c: Column | str) -> Column:
        return quoted(c) if isinstance(c, str) else c

    return df.withColumn(name, side(left) - side(right))


def project(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*[quoted(c) for c in columns])


def project_by_position(df: DataFrame, start: int, stop: int | None = None) -> DataFrame:
    return project(df, df.columns[start : start + 1 if stop is None else stop])


def cast_category(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Categories are text; dictionary coding is the file format's work."""
    return df.withColumns({c: quoted(c).cast("string") for c in columns})


def split_by_key(df: DataFrame, key: str, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """One report per key value, written in a single pass; returns them read back.

    A report of one key is `result.where(key == value)`, which reads that folder only.
    """
    kept = df if columns is None else project(df, [key, *[c for c in columns if c != key]])
    # brings a key's rows together, a few files each, and lets Spark split a key too big for one task
    kept.hint("rebalance", key).write.mode("overwrite").partitionBy(key).parquet(path)
    return df.sparkSession.read.parquet(path)


def concat(frames: Sequence[DataFrame]) -> DataFrame:
    """Union of all rows by column name; a column missing in a frame is null there."""
    for df in frames:
        twice = [c for c, n in Counter(df.columns).items() if n > 1]
        if twice:
            raise ValueError(f"duplicate column names in a concatenated frame: {twice}")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def merge_metrics(frames: Sequence[DataFrame], keys: Sequence[str], value: str = "value") -> DataFrame:
    """Union of metric frames; on an equal key the later frame wins."""
    tagged = [df.select(*keys, value, F.lit(i).alias("_ord")) for i, df in enumerate(frames)]
    return concat(tagged).groupBy(*keys).agg(F.max_by(value, "_ord").alias(value))


def first_type(types: Column | str) -> Column:
    """First entry of a JSON-schema type list."""
    return F.get(as_col(types), F.lit(0))


def first_match(image: Column | str, registry: Sequence[tuple[str, str]]) -> Column:
    """Name of the first registered (prefix, processor) that fits the image; null for none."""
    c = as_col(image)
    return F.coalesce(*[F.when(F.startswith(c, F.lit(prefix)), F.lit(name)) for prefix, name in registry])
