"""Observation of charts: their input tables, results, metrics, lineage and runs.

`observe_charts` takes the stored payloads of any number of charts and observes all of them in the same few joins and one
grouped profile; `chart_observation` takes one chart whose table and result are frames.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodewatch.functions.keys import md5_key, schema_key
from lodewatch.operators.cells import NOTHING, cell_types, described_lists, record_cells
from lodewatch.operators.entities import frame_ids, schemas
from lodewatch.operators.lineage import full_factors, lineage_executions, lineage_full, lineages
from lodewatch.operators.profile import describe
from lodewatch.session import gathered_parts, stored
from lodewatch.sources.messages import first_query_only

# Format and names of charts as data sources.
CHART_FORMAT = "Superset:Chart"
CHART_NAME = "Superset:{dashboard}:{chart}"
CHART_LOCATION = '/superset/explore/?form_data={{"slice_id":{chart_id}}}'


@dataclass
class ChartObservation:
    sources: DataFrame
    metrics: DataFrame
    edges: DataFrame
    lineage: DataFrame


def chart_observation(
    table: DataFrame, table_name: str, table_format: str, result: DataFrame, chart_id: int, chart: str, dashboard: str
) -> ChartObservation:
    """Every column of the chart depends on every field of its table; metrics are those of the result."""
    spark = table.sparkSession
    name = CHART_NAME.format(dashboard=dashboard, chart=chart)
    location = CHART_LOCATION.format(chart_id=chart_id)
    in_source, in_schema, in_rows = frame_ids(table, table_name, table_format)
    out_source, out_schema, out_rows = frame_ids(result, location, CHART_FORMAT)

    def fields(key: str, value: str, rows: list[tuple]) -> DataFrame:
        return spark.createDataFrame([(value, r[0], r[1]) for r in rows], f"{key} string, pos int, name string")

    inputs = spark.createDataFrame([(name, 0, in_schema)], "lineage_key string, input_ord int, input_schema_id string")
    edges = lineage_full(fields("lineage_key", name, out_rows), inputs, fields("schema_id", in_schema, in_rows))
    outputs = spark.createDataFrame([(name, out_schema)], "lineage_key string, schema_id string")
    sources = spark.createDataFrame(
        [
            (in_source, table_name, table_name, table_format, f"logical::{table_name}", in_schema),
            (out_source, name, location, CHART_FORMAT, f"logical::{name}", out_schema),
        ],
        "id string, name string, location string, format string, category string, schema_id string",
    )
    metrics = describe(result).select(F.lit(out_schema).alias("schema_id"), "field", "stat", "value")
    return ChartObservation(sources, metrics, edges, lineages(edges, outputs))


@dataclass
class ChartsObservation:
    """Rows of many charts; `render` (chart and start time) is their key."""

    sources: DataFrame  # render (null for tables), id, name, location, format, category, schema_id
    factors: DataFrame
    lineage: DataFrame
    execution: DataFrame
    metrics: DataFrame  # render, metrics_id, schema_id, lineage_execution_id, field, stat, value
    skipped: DataFrame  # render, n_queries of the charts with further queries, which are not observed


def observe_charts(charts: DataFrame, table_fields: DataFrame) -> ChartsObservation:
    """Observation of stored charts from their payloads.

    `charts`: chart_id, chart, dashboard, table_name, table_format, payload, app_execution, start_time;
    `table_fields`: table_name, pos, name, dtype. Only the first query of a payload counts. Every column of a result depends on
    every field of its table; a column's type is that of its values. A chart whose table has no known fields has no edges.
    """
    prefix, suffix = CHART_LOCATION.format(chart_id="\0").split("\0")
    place = F.concat(F.lit(prefix), F.col("chart_id").cast("string"), F.lit(suffix))
    named = charts.select(
        F.concat_ws(":", "chart_id", "start_time").alias("render"), "table_name", "table_format", "app_execution", "start_time", "payload",
        F.format_string(CHART_NAME.format(dashboard="%s", chart="%s"), "dashboard", "chart").alias("name"), place.alias("location"),
    ).withColumn("data_source_id", md5_key("location", F.lit(CHART_FORMAT)))
    first = stored(first_query_only(named), "chart-queries")
    records = first.select("render", "colnames", F.explode(F.from_json("data", "array<variant>")).alias("record"))
    cells = record_cells(records, ["render", "colnames"])
    cells = stored(cells.where(F.array_contains("colnames", F.col("field"))).drop("colnames"), "chart-cells")

    columns = first.select("render", "data_source_id", F.posexplode("colnames").alias("pos", "name"))
    types = cell_types(cells, ["render"]).withColumnRenamed("field", "name")
    fields = columns.join(types, ["render", "name"], "left").withColumn("dtype", F.coalesce("dtype", F.lit(NOTHING)))
    by_render = fields.groupBy("render", "data_source_id").agg(F.collect_list(F.struct("name", "dtype")).alias("fields"))
    results = stored(by_render.select("render", "data_source_id", schema_key("fields", "data_source_id").alias("schema_id")), "chart-schemas")

    tables = first.select("table_name", "table_format").distinct().withColumn("data_source_id", md5_key("table_name", "table_format"))
    table_schema = schemas(tables.join(table_fields, "table_name").select("data_source_id", "name", "dtype"))
    tables = stored(tables.join(table_schema, "data_source_id", "left").select("table_name", "table_format", "data_source_id", "schema_id"), "chart-tables")

    inputs = first.join(tables.where("schema_id is not null").drop("data_source_id"), ["table_name", "table_format"]).select(
        F.col("render").alias("lineage_key"), F.lit(0).alias("input_ord"), F.col("schema_id").alias("input_schema_id"))
    in_fields = tables.join(table_fields, "table_name").select("schema_id", "pos", "name").distinct()
    factors = stored(full_factors(columns.select(F.col("render").alias("lineage_key"), "pos", "name"), inputs, in_fields), "chart-factors")
    lineage = stored(lineages(factors, results.select(F.col("render").alias("lineage_key"), "schema_id")), "chart-lineage")
    execution = stored(lineage_executions(lineage, first.select(F.col("render").alias("lineage_key"), "app_execution", "start_time")), "chart-runs")
    run_of = lineage.select(F.col("lineage_key").alias("render"), F.col("id").alias("lineage"), "schema_id").join(
        first.select("render", "app_execution", "start_time"), "render").withColumn("lineage_execution_id", md5_key("lineage", "app_execution", "start_time"))
    # cells and runs are dealt alike, by the number of cells, so that a task holds as many at any size
    parts = gathered_parts(cells)
    described = described_lists(cells.repartition(parts, "render"), ["render"]).join(run_of.repartition(parts, "render"), "render")
    metrics = described.select(
        "render", md5_key("schema_id", "lineage_execution_id").alias("metrics_id"), "schema_id", "lineage_execution_id", "field", F.inline("stats")
    ).where("value is not null")

    category = lambda c: F.concat(F.lit("logical::"), c).alias("category")
    chart_sources = first.join(results.select("render", "schema_id"), "render").select(
        "render", F.col("data_source_id").alias("id"), "name", "location", F.lit(CHART_FORMAT).alias("format"), category(F.col("name")), "schema_id")
    table_sources = tables.select(
        F.lit(None).cast("string").alias("render"), F.col("data_source_id").alias("id"), F.col("table_name").alias("name"),
        F.col("table_name").alias("location"), F.col("table_format").alias("format"), category(F.col("table_name")), "schema_id")
    skipped = first.where("n_queries > 1").select("render", "n_queries")
    return ChartsObservation(chart_sources.unionByName(table_sources), factors, lineage, execution, metrics, skipped)
