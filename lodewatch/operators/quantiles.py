"""Exact quantiles of many columns at any size, in two reads.

1. The first read makes one KLL sketch per column, together with whatever else is aggregated. Up to the sketch's size it
   holds every value, and the quantiles are read off it. Beyond, its error bound gives each wanted quantile a bracket of
   values that almost surely holds it.
2. The second read counts: values inside a bracket by value, all others only by the gap they fall in.
3. The counts, sorted by gap and value, are summed up to the wanted ranks.

The result is exact: a rank that falls into a gap shows that its bracket missed, and the column is
counted again without brackets.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from lodewatch.functions.keys import quoted
from lodewatch.session import stored

# Size of a column's sketch, and of the sketches of all columns together, as they share one aggregation buffer.
SKETCH_K, SKETCH_LEAST, SKETCH_ITEMS = 4096, 200, 1 << 20
# Half width of a bracket in rank errors of the sketch.
BRACKET_ERRORS = 2
# The rank error that a KLL sketch of size k keeps in 99 of 100 cases is 2.296 / k ** 0.9021.
KLL_FACTOR, KLL_POWER = 2.296, 0.9021
# Up to this many rows a column's counted values are summed in one task per column.
ONE_TASK_ROWS = 1_000_000

Intervals = list[tuple[float, float]]


def as_number(df: DataFrame, column: str) -> Column:
    """The column as double with NaN turned to NULL, as both count as missing."""
    c = quoted(column)
    is_float = df.schema[column].dataType.simpleString() in ("float", "double")
    return F.when(~F.isnan(c), c.cast("double")) if is_float else c.cast("double")


def numbers_of(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The columns as doubles c0, c1, ..."""
    return df.select(*[as_number(df, c).alias(f"c{i}") for i, c in enumerate(columns)])


def sketch_size(columns: int) -> int:
    return max(SKETCH_LEAST, min(SKETCH_K, SKETCH_ITEMS // max(1, columns)))


def sketch_aggregates(numbers: DataFrame, probs: Sequence[float]) -> list[Column]:
    """For each column the number of values, least and greatest, and bracket edges or, if it has all values, the sketch itself.

    A sketch knows all of these, which keeps the number of aggregates small: with a sketch among them none is compiled.
    """
    k = sketch_size(len(numbers.columns))
    error = BRACKET_ERRORS * KLL_FACTOR / k**KLL_POWER
    edges = F.array(*[F.lit(min(1.0, max(0.0, p + side * error))) for p in probs for side in (-1, 1)])
    aggregates = []
    for c in numbers.columns:
        sketch = F.kll_sketch_agg_double(F.col(c) + 0.0, k)  # adding zero folds -0.0 into 0.0
        n = F.kll_sketch_get_n_double(sketch)
        aggregates += [
            n.alias(f"{c}_n"),
            F.when(n > 0, F.kll_sketch_get_quantile_double(sketch, F.array(F.lit(0.0), F.lit(1.0)))).alias(f"{c}_range"),
            F.when(n > k, F.kll_sketch_get_quantile_double(sketch, edges)).alias(f"{c}_edges"),
            F.when((n > 0) & (n <= k), sketch).alias(f"{c}_whole"),
        ]
    return aggregates


def sketched_brackets(row: Row, columns: Sequence[str]) -> dict[str, Intervals]:
    """Disjoint value intervals around the wanted quantiles, of the columns whose sketch has not all values."""
    return {c: _disjoint(row[f"{c}_edges"]) for c in columns if row[f"{c}_edges"] is not None}


def quantiles_of(numbers: DataFrame, row: Row, probs: Sequence[float], one_task_rows: int = ONE_TASK_ROWS) -> list[tuple[int, float, float]]:
    """(place of the column, prob, value) from the first read's `row` of `sketch_aggregates`; reads again where it must."""
    found = _whole(numbers, row, probs)
    brackets = sketched_brackets(row, numbers.columns)
    if not brackets:
        return found
    wide = numbers.select(*brackets)
    place = {f: numbers.columns.index(c) for f, c in enumerate(brackets)}
    by_field = dict(enumerate(brackets.values()))
    one_task = max(row[f"{c}_n"] for c in brackets) <= one_task_rows
    hits = _at_ranks(wide, by_field, probs, one_task)
    missed = {r["field"] for r in hits if r["missed"]}
    if missed:
        hits = _at_ranks(wide, {f: [] if f in missed else by_field[f] for f in by_field}, probs, one_task)
    return found + [(place[r["field"]], r["prob"], r["value"]) for r in hits]


def _whole(numbers: DataFrame, row: Row, probs: Sequence[float]) -> list[tuple[int, float, float]]:
    """The quantiles of the columns whose sketch has all values; a projection of constants, no read."""
    small = [c for c in numbers.columns if row[f"{c}_whole"] is not None]
    if not small:
        return []
    positions = {c: [(row[f"{c}_n"] - 1) * p for p in probs] for c in small}
    ends = [
        F.kll_sketch_get_quantile_double(
            F.lit(bytes(row[f"{c}_whole"])), F.array(*[F.lit((end(x) + 0.5) / row[f"{c}_n"]) for x in positions[c] for end in (math.floor, math.ceil)])
        ).alias(c)
        for c in small
    ]
    got = numbers.sparkSession.range(1).select(*ends).first()
    return [
        (numbers.columns.index(c), float(p), _between(x, *got[c][2 * k : 2 * k + 2]))
        for c in small for k, (p, x) in enumerate(zip(probs, positions[c]))
    ]


def _between(position: float, low: float, high: float) -> float:
    """As Spark's own percentile: equal ends, also infinite ones, are the result; others are weighed."""
    return low if low == high else (math.floor(position) + 1 - position) * low + (position - math.floor(position)) * high


def exact_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float], one_task_rows: int = ONE_TASK_ROWS) -> DataFrame:
    """(field, prob, value), interpolated linearly between neighbouring ranks.

    The result has one row per column and probability, so it is kept on the driver.
    """
    numbers = numbers_of(df, columns)
    row = numbers.agg(*sketch_aggregates(numbers, probs)).first()
    result = [(columns[i], p, v) for i, p, v in quantiles_of(numbers, row, probs, one_task_rows)]
    return df.sparkSession.createDataFrame(result, "field string, prob double, value double")


def _disjoint(edges: list[float] | None) -> Intervals:
    merged: Intervals = []
    for lo, hi in sorted(zip(edges[::2], edges[1::2])) if edges else []:
        if merged and lo <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(hi, merged[-1][1]))
        else:
            merged.append((lo, hi))
    return merged


def _region(value: Column, intervals: Intervals) -> Column:
    """Odd numbers for the intervals, even ones for the gaps, in the order of the values."""
    if not intervals:
        return F.lit(1)
    cases = F
    for k, (lo, hi) in enumerate(intervals):
        cases = cases.when(value < lo, 2 * k).when(value <= hi, 2 * k + 1)
    return cases.otherwise(2 * len(intervals))


def _counted(numbers: DataFrame, brackets: dict[int, Intervals]) -> DataFrame:
    """(field, region, value, n), counted on the map side first; `value` is null in gaps."""
    names = numbers.columns
    placed = numbers.select("*", *[_region(F.col(c), brackets[i]).alias(f"r{i}") for i, c in enumerate(names)])
    # Adding zero folds -0.0 into 0.0.
    parts = [
        x
        for i, c in enumerate(names)
        for x in (F.lit(i), F.when(F.col(c).isNotNull(), F.col(f"r{i}")), F.when(F.col(f"r{i}") % 2 == 1, F.col(c) + 0.0))
    ]
    long = placed.select(F.stack(F.lit(len(names)), *parts).alias("field", "region", "value"))
    return long.where("region is not null").groupBy("field", "region", "value").agg(F.count("*").alias("n"))


def _at_ranks(numbers: DataFrame, brackets: dict[int, Intervals], probs: Sequence[float], one_task: bool) -> list:
    """One row (field, prob, value, missed) per column that has values, and probability."""
    counted = _counted(numbers, brackets)
    if one_task:
        running = counted.selectExpr(
            "field", "value",
            "sum(n) over (partition by field order by region, value) - n as lo",
            "sum(n) over (partition by field order by region, value) as hi",
            "sum(n) over (partition by field) as total",
        )
        hits = running.select("*", _wanted(probs)).select("*", _positions()).select("*", _ranks()).where("rank >= lo and rank < hi")
    else:
        hits = _hits_by_range(counted, probs)
    # as Spark's own percentile: equal ends, also infinite ones, are the result; others are weighed
    position = F.max("position")
    low, high = F.min("value"), F.max("value")
    weighed = (F.floor(position) + 1 - position) * low + (position - F.floor(position)) * high
    return hits.groupBy("field", "prob").agg(
        F.when(low == high, low).otherwise(weighed).alias("value"), (F.count_if(F.col("value").isNull()) > 0).alias("missed")
    ).collect()


def _wanted(probs: Sequence[float]) -> Column:
    return F.explode(F.array(*[F.lit(float(p)) for p in probs])).alias("prob")


def _positions() -> Column:
    return ((F.col("total") - 1) * F.col("prob")).alias("position")


def _ranks() -> Column:
    return F.explode(F.array_distinct(F.array(F.floor("position"), F.ceil("position")))).alias("rank")


def _hits_by_range(counted: DataFrame, probs: Sequence[float]) -> DataFrame:
    """The counted values at the wanted ranks, summed over all tasks.

    The counts are range-partitioned and written once, each with the number of its range. The row
    count of each range (one row per column and range) tells which ranges hold a wanted rank; only
    those are read again and summed value by value.
    """
    ranges = stored(
        counted.repartitionByRange("field", "region", "value").select("*", F.spark_partition_id().alias("part")), "ranks"
    )
    placed = ranges.groupBy("field", "part").agg(F.sum("n").alias("size")).selectExpr(
        "field", "part",
        "sum(size) over (partition by field order by part) - size as first_rank",
        "sum(size) over (partition by field order by part) as end_rank",
        "sum(size) over (partition by field) as total",
    )
    wanted = placed.select("*", _wanted(probs)).select("*", _positions()).select("*", _ranks())
    wanted = wanted.where("rank >= first_rank and rank < end_rank")
    needed = wanted.select("field", "part", "first_rank").distinct()
    running = ranges.join(needed, ["field", "part"]).selectExpr(
        "field", "part", "value",
        "first_rank + sum(n) over (partition by field, part order by region, value) - n as lo",
        "first_rank + sum(n) over (partition by field, part order by region, value) as hi",
    )
    ranks = wanted.select("field", "part", "prob", "position", "rank")
    return running.join(ranks, ["field", "part"]).where("rank >= lo and rank < hi")
