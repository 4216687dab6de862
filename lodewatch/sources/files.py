"""File scans and sinks."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodewatch.functions.keys import as_col, md5_key, quoted, schema_key
from lodewatch.operators.lineage import lineages
from lodewatch.session import work_dir
from lodewatch.sources.tables import type_name

# Colour in the file path -> its date column.
TRIP_DATE_COLUMNS = {"yellow": "tpep_pickup_datetime", "green": "lpep_pickup_datetime"}

TIMESTAMP_TEXT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def scan_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | str,
    parse_dates: Sequence[str] = (),
    categories: Sequence[str] = (),
) -> DataFrame:
    """Header CSV with a declared schema, dates parsed and categories kept as text.

    The schema is declared, never inferred: inference would read the data twice.
    """
    declared = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    df = spark.read.option("header", True).schema(_as_text(declared, categories)).csv(path)
    return df.withColumns({c: F.to_date(quoted(c)) for c in parse_dates}) if parse_dates else df


def _as_text(schema: T.StructType, names: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(f.name, T.StringType() if f.name in names else f.dataType) for f in schema])


def scan_csv_by_period(
    spark: SparkSession,
    template: str,
    schema: T.StructType | str,
    year: str | int = "*",
    month: str | int = "*",
    **options,
) -> DataFrame:
    """CSV files whose path names year and month; both come back as columns.

    `template` holds `{year}` and `{month}`. A given year or month goes into the
    path itself, so only those folders are listed and read.
    """
    df = scan_csv(spark, template.format(year=year, month=month), schema, **options)
    parts = re.split(r"(\{year\}|\{month\})", template)
    groups = [p for p in parts if p in ("{year}", "{month}")]
    # A glob in the template matches within one path step.
    pattern = "".join(
        r"(\d+)" if p in ("{year}", "{month}") else re.escape(p).replace(r"\*", "[^/]*") for p in parts
    )
    # Only the part from the first placeholder on is compared: Spark may rewrite the root's scheme.
    tail = pattern[pattern.rindex("/", 0, pattern.index(r"(\d+)")):] if "/" in pattern else pattern
    source = F.col("_metadata.file_path")
    return df.select(
        "*",
        F.regexp_extract(source, tail, groups.index("{year}") + 1).cast("int").alias("year"),
        F.regexp_extract(source, tail, groups.index("{month}") + 1).cast("int").alias("month"),
    )


def csv_to_parquet(
    spark: SparkSession,
    src: str,
    dst: str,
    schema: T.StructType | str,
    date_columns: dict[str, str] = TRIP_DATE_COLUMNS,
) -> DataFrame:
    """CSV to Parquet; the date column is chosen by the tag found in the source path."""
    if not src.endswith(".csv"):
        raise ValueError(f"only CSV sources are accepted: {src}")
    dates = [column for tag, column in date_columns.items() if tag in src]
    df = spark.read.option("header", True).schema(schema).csv(src)
    df.withColumns({c: quoted(c).cast("timestamp_ntz") for c in dates}).write.mode("overwrite").parquet(dst)
    return spark.read.parquet(dst)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = ()) -> None:
    """Header CSV without an index column."""
    df = df.hint("rebalance", *partition_by) if partition_by else df
    writer = df.write.mode(mode).option("header", True).option("timestampNTZFormat", TIMESTAMP_TEXT)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.csv(path)


def with_row_index(df: DataFrame, order_by: Sequence[Column | str], name: str = "_c0") -> DataFrame:
    """Adds a 0-based index over the whole frame, in the given order.

    Rows are range-partitioned and numbered inside their partition, once, into the
    shared work folder; the sizes of the partitions (one row each) give every
    partition its offset. No task sees more than its own range, and a hash of the
    whole row splits a hot key over several ranges.
    """
    spark = df.sparkSession
    keys = [as_col(c) for c in order_by] + [F.xxhash64(*[quoted(c) for c in df.columns])]
    placed = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    # monotonically_increasing_id keeps the partition in its upper bits and the row in the lower 33.
    row_id = F.monotonically_increasing_id()
    path = work_dir(spark, "row-index")
    placed.select(
        F.shiftright(row_id, 33).alias("_part"), row_id.bitwiseAND(F.lit(2**33 - 1)).alias("_pos"), "*"
    ).write.parquet(path)
    stored = spark.read.parquet(path)
    sizes = stored.groupBy("_part").agg(F.count("*").alias("_n"))
    # One row per partition of the write above: its number is the shuffle's, not the data's.
    offsets = sizes.selectExpr(
        "_part", "sum(_n) over (order by _part rows between unbounded preceding and current row) - _n as _offset"
    )
    return stored.join(F.broadcast(offsets), "_part").select(
        (F.col("_offset") + F.col("_pos")).alias(name), *[quoted(c) for c in df.columns]
    )


def write_csv_indexed(df: DataFrame, path: str, order_by: Sequence[Column | str], name: str = "_c0") -> None:
    write_csv(with_row_index(df, order_by, name), path)


def load_from_uris(
    spark: SparkSession, uris: Sequence[str], dst: str, schema: T.StructType, source_format: str, **options
) -> tuple[DataFrame, DataFrame]:
    """Loads every URI into one table; returns (table, one row per URI).

    Each URI is its own data source and carries the destination's schema, since it is
    loaded as it is: `location, nrows, data_source_id, schema_id`.
    """
    table = spark.read.format(source_format).options(**options).schema(schema).load(list(uris))
    table.write.mode("overwrite").parquet(dst)
    # Counting reads no data columns; each file is matched to the URI it lies under.
    per_file = table.groupBy(_plain(F.col("_metadata.file_path")).alias("file")).agg(F.count("*").alias("n"))
    folders = [(i, u, re.sub("^file:(//)?", "", u).rstrip("/")) for i, u in enumerate(uris)]
    named = spark.createDataFrame(folders, "place int, location string, folder string")
    # a file's folders and itself, joined with the URIs; of nested URIs the one named first has it
    steps = F.split("file", "/")
    above = F.transform(F.sequence(F.lit(1), F.size(steps)), lambda n: F.array_join(F.slice(steps, 1, n), "/"))
    owned = per_file.select("file", "n", F.explode(above).alias("folder")).join(named, "folder")
    owner = owned.groupBy("file", "n").agg(F.min_by("location", "place").alias("location"))
    per_uri = owner.groupBy("location").agg(F.sum("n").alias("nrows"))
    every_uri = spark.createDataFrame([(u,) for u in uris], "location string")
    source_id = md5_key("location", F.lit(source_format))
    fields = F.array(*[F.struct(F.lit(f.name).alias("name"), F.lit(type_name(f.dataType)).alias("dtype")) for f in schema])
    sources = every_uri.join(per_uri, "location", "left").select(
        "location",
        F.coalesce("nrows", F.lit(0)).alias("nrows"),
        source_id.alias("data_source_id"),
        schema_key(fields, source_id).alias("schema_id"),
    )
    return spark.read.parquet(dst), sources


def load_edges(sources: DataFrame, schema: T.StructType, lineage_key: str) -> DataFrame:
    """Lineage edges of such a load: each field of each URI feeds the field of the same name."""
    names = F.array(*[F.lit(f.name) for f in schema])
    order = F.row_number().over(Window.orderBy("location")).cast("long") - 1  # as many rows as there are URIs
    return sources.withColumn("input_ord", order).select(
        F.lit(lineage_key).alias("lineage_key"), "input_ord", "location",
        F.col("schema_id").alias("input_schema_id"), F.posexplode(names).alias("edge_ord", "output_field"),
    ).withColumn("input_fields", F.array("output_field"))


def load_lineages(sources: DataFrame, schema: T.StructType, schema_id: str) -> DataFrame:
    """(id, lineage_key, schema_id, n_edges): a lineage of its own for each URI, into the table whose schema is `schema_id`."""
    names = F.array(*[F.lit(f.name) for f in schema])
    factors = sources.select(
        F.col("location").alias("lineage_key"), F.lit(0).alias("input_ord"), F.col("schema_id").alias("input_schema_id"),
        F.lit(True).alias("pairwise"), names.alias("outputs"), names.alias("inputs"))
    return lineages(factors, sources.select(F.col("location").alias("lineage_key"), F.lit(schema_id).alias("schema_id")))


def _plain(path: Column) -> Column:
    """Path without the local scheme, which Spark adds to local files."""
    decoded = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))  # Spark reports blanks and others percent-encoded
    return F.regexp_replace(decoded, "^file:(//)?", "")


def copy_dataset(spark: SparkSession, src: str, dst: str) -> DataFrame:
    """Copies a stored Parquet dataset to a new prefix; the source stays."""
    original = spark.read.parquet(src)
    original.write.mode("overwrite").parquet(dst)
    copied = spark.read.parquet(dst)
    # Both counts come from the files' footers.
    n_src, n_dst = original.count(), copied.count()
    if n_src != n_dst:
        raise RuntimeError(f"copy of {src} holds {n_dst} rows, source {n_src}")
    return copied
