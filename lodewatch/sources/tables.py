"""Catalog tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodewatch.functions.keys import quoted
from lodewatch.session import stored

FIELD_SCHEMA = "pos int, name string, dtype string, nullable boolean, sensitive boolean"


def external_table(spark: SparkSession, name: str, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Registers stored Parquet as a table; without a schema the files' own is taken."""
    found = schema or spark.read.parquet(path).schema  # fails before the old table is dropped
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.catalog.createTable(name, path=path, source="parquet", schema=found)
    return spark.table(name)


def ctas_partitioned(
    src: DataFrame, name: str, ts: str, path: str | None = None, partition: str = "d"
) -> DataFrame:
    """Replaces table `name` by the rows of `src`, partitioned by DATE(ts).

    The rebalance hint brings the rows of a day together before the write, so a day
    is a few files and not one per task, and lets Spark split a day that is too big
    for one task. Where the table exists, the rows are written to the work folder
    first: `src` may read the table that is replaced, and a failed query leaves it.
    """
    spark = src.sparkSession
    if spark.catalog.tableExists(name):
        src = stored(src, "replacement")
        spark.sql(f"DROP TABLE {name}")
    dated = src.withColumn(partition, F.to_date(quoted(ts))).hint("rebalance", partition)
    writer = dated.write.mode("overwrite").format("parquet").partitionBy(partition)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return spark.table(name)


def on_dates(table: DataFrame, ts: str, start: str, end: str, partition: str = "d") -> DataFrame:
    """Rows with start <= ts < end; the predicate on the partition column prunes folders."""
    pruned = F.col(partition).between(F.lit(start).cast("date"), F.lit(end).cast("date"))
    t = quoted(ts)
    return table.where(pruned & (t >= F.lit(start).cast("timestamp_ntz")) & (t < F.lit(end).cast("timestamp_ntz")))


def seed_load(
    spark: SparkSession, csv_path: str, table: str, schema: T.StructType, path: str | None = None
) -> tuple[DataFrame, int]:
    """Inserts a seed CSV into a table; returns (table, rows of the seed).

    The count is observed by the insert itself. The observed frame is written without a
    shuffle, and Spark counts a result task once, so a retried task is not counted twice.
    """
    if not spark.catalog.tableExists(table):
        spark.catalog.createTable(table, path=path, source="parquet", schema=schema)
    seen = Observation()
    seed = spark.read.option("header", True).schema(schema).csv(csv_path).observe(seen, F.count(F.lit(1)).alias("nrows"))
    seed.write.insertInto(table)
    return spark.table(table), seen.get["nrows"]


def field_rows(df: DataFrame, hints: dict[str, str] | None = None, dtype_style: str = "spark") -> list[tuple]:
    """(pos, name, dtype, nullable, sensitive) of a frame; as many rows as it has columns."""
    hints = hints or {}
    return [
        (
            i,
            f.name,
            hints.get(f.name, type_name(f.dataType, dtype_style)),
            f.nullable,
            bool((f.metadata or {}).get("sensitive", False)),
        )
        for i, f in enumerate(df.schema.fields)
    ]


def type_name(dtype: T.DataType, style: str = "spark") -> str:
    if style == "spark":
        return dtype.simpleString() or "unknown"
    if style == "pandas":
        return PANDAS_TYPES.get(dtype.simpleString(), "object")
    raise ValueError(f"unknown dtype style: {style}")


# Spelling of the types in ids that must equal those of pandas frames.
PANDAS_TYPES = {
    "tinyint": "int64",
    "smallint": "int64",
    "int": "int64",
    "bigint": "int64",
    "float": "float64",
    "double": "float64",
    "boolean": "bool",
    "date": "datetime64[ns]",
    "timestamp": "datetime64[ns]",
    "timestamp_ntz": "datetime64[ns]",
    "string": "object",
}


def table_schema(spark: SparkSession, table: str) -> DataFrame:
    """Ordered fields of a catalog table."""
    return spark.createDataFrame(field_rows(spark.table(table)), FIELD_SCHEMA)


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table, nrows) of every table; one row each, the counts stay in Spark."""
    counts: Sequence[DataFrame] = [
        df.agg(F.count("*").alias("nrows")).select(F.lit(name).alias("table_name"), "nrows") for name, df in tables.items()
    ]
    total = counts[0]
    for c in counts[1:]:
        total = total.unionAll(c)
    return total


def sql_query_source(spark: SparkSession, query: str, tables: dict[str, DataFrame] | None = None) -> DataFrame:
    """Result of a query as a frame; `tables` are made visible to it under their names."""
    return spark.sql(query, **(tables or {}))
