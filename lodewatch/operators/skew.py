"""Joins whose left side may hold very many rows of one key.

Spark splits a skewed join by itself only where both sides come straight from a shuffle. Here the
right side is often an aggregation on the join key, so the hot keys are looked up and salted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DoubleType, FloatType

from lodewatch.session import stored

# Rows of one key that a single task may be given.
HOT_ROWS = 1_000_000
# Groups of keys that are counted before single keys are.
KEY_GROUPS = 1 << 14


def common_types(left: DataFrame, right: DataFrame, on: Sequence[str]) -> dict[str, DataType]:
    """The type in which a plain join compares each key, as a union of both sides would have it."""
    sides = [df.select(*[F.col(f"`{c}`") for c in on]).limit(0) for df in (left, right)]
    return {f.name: f.dataType for f in sides[0].union(sides[1]).schema}


def _key_hash(types: dict[str, DataType]):
    """Hash of the keys in their common type; equal keys have equal hashes, also 0.0 and -0.0."""
    keys = [(F.col(f"`{c}`").cast(t), t) for c, t in types.items()]
    return F.xxhash64(*[k + F.lit(0.0).cast(t) if isinstance(t, (FloatType, DoubleType)) else k for k, t in keys])


def hot_keys(df: DataFrame, types: dict[str, DataType], hot_rows: int) -> DataFrame:
    """(hot_hash, salts) of every key with `hot_rows` rows or more; counts are partial before their shuffle.

    Each hot key has salts of its own, one per `hot_rows` rows and one more. There is at most one row
    per `hot_rows` rows of `df`, and no other limit. Two keys of one hash are salted together, which
    changes no result.

    Groups of keys are counted first, which moves a few rows only: a key can be hot only in a group of that many rows.
    Single keys are counted in such groups, and no key anywhere else.
    """
    key, group = _key_hash(types), F.pmod(_key_hash(types), F.lit(KEY_GROUPS))
    large = [r["g"] for r in df.groupBy(group.alias("g")).agg(F.count("*").alias("n")).where(F.col("n") >= hot_rows).select("g").collect()]
    counts = df.where(group.isin(large)).groupBy(key.alias("hot_hash")).agg(F.count("*").alias("n"))
    salts = (F.ceil(F.col("n") / hot_rows) + 1).cast("int").alias("salts")
    return counts.where(F.col("n") >= hot_rows).select("hot_hash", salts)


def _few_rows(df: DataFrame, most: int) -> bool:
    """Whether a stored table has fewer rows than `most`, from the row counts in its files; no for anything but a plain scan."""
    plan = df._jdf.queryExecution().optimizedPlan().treeString().splitlines()
    return all(node.strip(" :+-").startswith(("Project", "Relation")) for node in plan) and df.count() < most


def salted_join(
    left: DataFrame, right: DataFrame, on: Sequence[str] | str, how: str = "inner", counted: DataFrame | None = None,
    hot_rows: int | None = None,
) -> DataFrame:
    """`left.join(right, on, how)` for inner, left, left_semi and left_anti joins.

    The rows of a hot key are spread over several salts; the right side's rows of that key, and of
    no other, are repeated once per salt. The keys are counted on `counted`, if the left side is
    costly and a cheaper frame has at least as many rows per key. A stored table with fewer rows than make a key hot is
    not counted by key.
    """
    on = [on] if isinstance(on, str) else list(on)
    counted, hot_rows = left if counted is None else counted, hot_rows or HOT_ROWS
    if _few_rows(counted, hot_rows):
        return left.join(right, on, how)
    types = common_types(left, right, on)
    hot = hot_keys(counted, types, hot_rows)
    if not hot.count():
        return left.join(right, on, how)
    hot = stored(hot, "hot-keys")  # counted once more, for joins that have hot keys; both sides read it
    # By the row's content alone: a task that runs again gives every row the salt it had before.
    row = F.xxhash64(*[F.col(f"`{c}`") for c in left.columns])
    salted = left.withColumn("_hash", _key_hash(types)).join(hot, F.col("_hash") == F.col("hot_hash"), "left")
    salted = salted.withColumn("_salt", F.coalesce(F.pmod(row, F.col("salts")), F.lit(0)).cast("int"))
    every = F.sequence(F.lit(0), F.coalesce(F.col("salts"), F.lit(1)) - 1)
    repeated = right.withColumn("_hash", _key_hash(types)).join(hot, F.col("_hash") == F.col("hot_hash"), "left")
    repeated = repeated.withColumn("_salt", F.explode(every)).drop("_hash", "hot_hash", "salts")
    return salted.drop("_hash", "hot_hash", "salts").join(repeated, [*on, "_salt"], how).drop("_salt")
