"""Cells: the values of unlike tables in one typed long form, and profiles of them grouped by any keys.

A cell is (keys, field, kind, number, text): one row per row and field. Numbers, times (epoch milliseconds) and flags (0, 1)
are in `number`, texts in `text`, missing values are null in both. So tables, chart results or payloads of any
schemas are one frame, and one aggregation profiles all of them.

Aggregates combine on the map side, first by (keys, field, text): a field without texts is one row per task then.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodewatch.functions.keys import quoted
from lodewatch.functions.messages import json_kind
from lodewatch.operators.profile import BOOLEAN, NUMERIC, QUARTILES, STRING, TEMPORAL, countable, epoch_millis, family

NUMBER, TIME, FLAG, TEXT, ROWS, NOTHING = "number", "time", "flag", "text", "rows", "nothing"
KINDS = {NUMERIC: NUMBER, TEMPORAL: TIME, BOOLEAN: FLAG, STRING: TEXT}


def _cell(field: Column, kind: Column, number: Column, text: Column) -> Column:
    return F.struct(field.alias("field"), kind.alias("kind"), number.alias("number"), text.alias("text"))


def _table_cell(field: T.StructField) -> Column:
    kind, value = KINDS[family(field.dataType)], quoted(field.name)
    no_number, no_text = F.lit(None).cast("double"), F.lit(None).cast("string")
    if kind == TEXT:
        return _cell(F.lit(field.name), F.lit(kind), no_number, countable(value))
    number = epoch_millis(value, field.dataType) if kind == TIME else value
    if isinstance(field.dataType, T.FloatType | T.DoubleType):
        number = F.when(~F.isnan(value), value)
    return _cell(F.lit(field.name), F.lit(kind), number.cast("double"), no_text)


def table_cells(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, field, kind, number, text) of all tables; a row itself is a cell of kind `rows` without a field."""
    def cells(name: str, df: DataFrame) -> DataFrame:
        row = _cell(F.lit(""), F.lit(ROWS), F.lit(None).cast("double"), F.lit(None).cast("string"))
        known = [f for f in df.schema.fields if family(f.dataType) in KINDS]
        return df.select(F.lit(name).alias("table_name"), F.inline(F.array(row, *[_table_cell(f) for f in known])))

    return reduce(DataFrame.unionByName, [cells(name, df) for name, df in tables.items()])


def profile_tables(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, field, stat, value) of all tables in one aggregation: what `profile_table` says of each."""
    cells = table_cells(tables)
    by_text = cells.groupBy("table_name", "field", "kind", "text").agg(
        F.count(F.lit(1)).alias("n"), F.count("number").alias("held"), F.sum("number").alias("sum"), F.min("number").alias("min"), F.max("number").alias("max"))
    found = by_text.groupBy("table_name", "field", "kind").agg(
        F.sum("n").alias("n"), F.sum("held").alias("held"), F.sum("sum").alias("sum"), F.min("min").alias("min"), F.max("max").alias("max"),
        F.count("text").alias("levels"), F.sum(F.when(F.col("text").isNull(), F.col("n")).otherwise(0)).alias("textless"))
    # tables without rows have counts of zero: one row per field that there is
    every = [(name, "", ROWS) for name in tables] + [
        (name, f.name, KINDS[family(f.dataType)]) for name, df in tables.items() for f in df.schema.fields if family(f.dataType) in KINDS
    ]
    fields = cells.sparkSession.createDataFrame(every, "table_name string, field string, kind string")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("double")
    kind, missing = F.col("kind"), zero(F.when(F.col("kind") == TEXT, F.col("textless")).otherwise(F.col("n") - F.col("held")))
    stats = {
        "nrows": F.when(kind == ROWS, zero(F.col("n"))),
        "min": F.when(kind.isin(NUMBER, TIME), F.col("min")),
        "max": F.when(kind.isin(NUMBER, TIME), F.col("max")),
        "mean": F.when(kind == NUMBER, F.try_divide("sum", "held")),
        "true": F.when(kind == FLAG, zero(F.col("sum"))),
        "levels": F.when(kind == TEXT, zero(F.col("levels"))),
        "nullrows": F.when(kind != ROWS, missing),
    }
    listed = F.array(*[F.struct(F.lit(stat).alias("stat"), value.alias("value")) for stat, value in stats.items()])
    joined = fields.join(found, ["table_name", "field", "kind"], "left")
    return joined.select("table_name", "field", F.inline(listed)).where("value is not null")


def record_cells(records: DataFrame, keys: Sequence[str], record: str = "record") -> DataFrame:
    """(keys, field, kind, number, text) of variant objects; anything but numbers, flags and null counts as its text."""
    spark = records.sparkSession
    exploded = records.lateralJoin(spark.tvf.variant_explode(F.col(record).outer()).alias("_f")).where("_f.key is not null")
    value, kind = F.col("_f.value"), json_kind(F.col("_f.value"))
    flag = F.schema_of_variant(value) == "BOOLEAN"
    known = F.when(kind == "null", NOTHING).when(flag, FLAG).when(kind == "number", NUMBER).otherwise(TEXT)
    number = F.when(flag, F.try_variant_get(value, "$", "boolean").cast("double")).when(kind == "number", F.try_variant_get(value, "$", "double"))
    text = F.when(known == TEXT, F.coalesce(F.try_variant_get(value, "$", "string"), F.to_json(value)))
    return exploded.select(*keys, F.col("_f.key").alias("field"), known.alias("kind"), number.alias("number"), text.alias("text"))


def _kinds() -> Column:
    return F.collect_set(F.when(F.col("kind") != NOTHING, F.col("kind")))


def _dtype() -> Column:
    """The type of a field whose values are of the `kinds`."""
    return F.when(F.size("kinds") == 0, NOTHING).when(F.size("kinds") == 1, F.get("kinds", F.lit(0))).otherwise(TEXT)


def cell_types(cells: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, field, dtype): the kind of a field's values; texts where there are several, `nothing` where there are none."""
    return cells.groupBy(*keys, "field").agg(_kinds().alias("kinds")).select(*keys, "field", _dtype().alias("dtype"))


def described_lists(cells: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, field, stats): the rows of `describe_cells` as lists of (stat, value), up to two for a key and field.

    Types are told beside the values and not joined to them, so cells that were dealt by the keys (`session.gathered`) are not shuffled
    again. Moments have an aggregation of their own: next to the buffers of the quartiles Spark would sum up some fields in two
    parts, as the number of tasks has it, and a last digit with them.

    Quartiles keep the distinct values of one key and field in a buffer: for results that came as one payload.
    """
    group = [*keys, "field"]
    probs = F.array(*[F.lit(p) for p in QUARTILES.values()])
    number_only = F.count_if(~F.col("kind").isin(NUMBER, NOTHING)).alias("others")
    moments = cells.groupBy(*group).agg(
        number_only, F.count("number").alias("count"), F.avg("number").alias("mean"), F.stddev_samp("number").alias("std"),
        F.min("number").alias("min"), F.max("number").alias("max")).where("others = 0")
    ranked = cells.groupBy(*group).agg(number_only, F.percentile("number", probs).alias("q")).where("others = 0 and q is not null")
    quartiles = {stat: F.get("q", F.lit(i)) for i, stat in enumerate(QUARTILES)}
    typed = cells.withColumn("kinds", _kinds().over(Window.partitionBy(*group))).withColumn("dtype", _dtype())
    value = F.coalesce("text", F.when(F.col("kind") == FLAG, F.col("number").cast("boolean").cast("string")).otherwise(F.col("number").cast("string")))
    texts = typed.where(F.col("dtype").isin(TEXT, FLAG)).select(*group, countable(value).alias("text"))
    counted = texts.where("text is not null").groupBy(*group, "text").agg(F.count(F.lit(1)).alias("n"))
    others = counted.groupBy(*group).agg(F.sum("n").alias("count"), F.count(F.lit(1)).alias("unique"), F.max("n").alias("freq"))

    def listed(df: DataFrame, stats: dict[str, Column]) -> DataFrame:
        rows = F.array(*[F.struct(F.lit(s).alias("stat"), v.cast("double").alias("value")) for s, v in stats.items()])
        return df.select(*group, rows.alias("stats"))

    parts = [
        listed(moments, {s: F.col(s) for s in ("count", "mean", "std", "min", "max")}), listed(ranked, quartiles),
        listed(others, {s: F.col(s) for s in ("count", "unique", "freq")}),
    ]
    return reduce(DataFrame.unionByName, parts)


def describe_cells(cells: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, field, stat, value): count, mean, std, min, quartiles and max of fields of numbers; count, unique and freq of others."""
    return described_lists(cells, keys).select(*keys, "field", F.inline("stats")).where("value is not null")
