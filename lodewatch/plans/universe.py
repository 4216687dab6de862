"""Observation data derived from the given tables, for the registered queries.

Every derived frame grows with its tables and has the same definition in SQL next to it:

* each order is a stored file whose fields come from its line items;
* each customer is a report written from the files of its orders, in one run;
* each event is a message of a stream, each order a logged SQL text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodewatch.functions.keys import iso_time, md5_key
from lodewatch.operators.entities import app_run_rows, data_sources, schemas
from lodewatch.operators.lineage import field_lists
from lodewatch.session import GATHERED_ROWS, gathered, spread, stored

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def long_stats(*stats: str) -> Column:
    """Columns as rows (stat, value); unlike an unpivot, it leaves the rows where a grouping has put them."""
    return F.inline(F.array(*[F.struct(F.lit(s).alias("stat"), F.col(s).alias("value")) for s in stats]))


class Universe:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return table(self.spark, self.sf_dir, name)
        raise AttributeError(name)

    # --- files and reports -------------------------------------------------------------

    def order_fields(self) -> DataFrame:
        """(ok, pos, name, dtype): the fields of an order's file."""
        return self.order_columns().select("ok", "pos", "name", "dtype")

    def order_columns(self) -> DataFrame:
        """(ok, pos, name, dtype, count, sum): the fields of an order's file with their lines and quantity.

        The rows of an order are in one task. The types' names sort like the line numbers that they stand for.
        """
        lines = self.lineitem.select(
            F.col("l_orderkey").alias("ok"), (F.col("l_partkey") % 40).alias("pos"), F.col("l_linenumber").alias("line"), "l_quantity")
        grouped = gathered(lines, "ok").groupBy("ok", "pos").agg(
            F.min("line").alias("line"), F.count("*").cast("double").alias("count"), F.sum("l_quantity").alias("sum"))
        dtype = F.expr("CASE WHEN line <= 2 THEN 'bigint' WHEN line <= 4 THEN 'double' ELSE 'string' END")
        return grouped.select("ok", "pos", F.concat(F.lit("col_"), F.col("pos")).alias("name"), dtype.alias("dtype"), "count", "sum")

    def order_sources(self) -> DataFrame:
        """(ok, ck, location, data_source_id)."""
        location = F.concat(F.lit("warehouse/"), F.col("o_orderstatus"), F.lit("/orders_"), F.col("o_orderkey"), F.lit(".parquet"))
        rows = self.orders.select(
            F.col("o_orderkey").alias("ok"), F.col("o_custkey").alias("ck"),
            F.col("o_orderstatus").alias("status"), location.alias("location"),
        )
        return rows.withColumn("data_source_id", md5_key("location", F.lit("parquet")))

    def order_schemas(self, files: DataFrame | None = None) -> DataFrame:
        """(ok, ck, status, data_source_id, schema_id, n_fields, fields) of the orders that have line items.

        `files` are stored field lists by order, where several steps read them.
        """
        lists = field_lists(self.order_fields(), "ok") if files is None else files
        return schemas(lists.join(self.order_sources().drop("location").hint("merge"), "ok"))

    def report_fields(self) -> DataFrame:
        """(ck, pos, name, dtype): a customer's report has one field more than its nation's key."""
        positions = F.explode(F.sequence(F.lit(0), F.col("c_nationkey")))
        customers = gathered(self.customer.select(F.col("c_custkey").alias("ck"), "c_nationkey"), "ck", rows=GATHERED_ROWS // 10)
        rows = customers.select("ck", positions.alias("pos"))
        dtype = F.expr("CASE pos % 3 WHEN 0 THEN 'bigint' WHEN 1 THEN 'double' ELSE 'string' END")
        return rows.select("ck", "pos", F.concat(F.lit("col_"), F.col("pos")).alias("name"), dtype.alias("dtype"))

    def report_sources(self) -> DataFrame:
        location = F.concat(F.lit("reports/customer_"), F.col("c_custkey"), F.lit(".csv"))
        rows = self.customer.select(F.col("c_custkey").alias("ck"), location.alias("location"))
        return rows.withColumn("data_source_id", md5_key("location", F.lit("csv")))

    def report_schemas(self) -> DataFrame:
        """(ck, data_source_id, schema_id, n_fields, fields)."""
        lists = field_lists(self.report_fields(), "ck")
        return schemas(lists.join(self.report_sources().drop("location").hint("merge"), "ck"))

    def data_source_rows(self) -> DataFrame:
        """All data sources as entity rows (id, location, format)."""
        files = self.order_sources().select("location", F.lit("parquet").alias("format"))
        reports = self.report_sources().select("location", F.lit("csv").alias("format"))
        return data_sources(files.unionByName(reports))

    # --- lineage inputs ------------------------------------------------------------------

    def outputs(self) -> DataFrame:
        return self.report_schemas().select(F.col("ck").alias("lineage_key"), "schema_id")

    def out_fields(self) -> DataFrame:
        return self.report_fields().select(F.col("ck").alias("lineage_key"), "pos", "name")

    def inputs(self) -> DataFrame:
        """Each order is an input of its customer's report, in the order of its key."""
        return self.orders.select(
            F.col("o_custkey").alias("lineage_key"), F.col("o_orderkey").alias("input_ord"),
            F.col("o_orderkey").alias("input_schema_id"),
        )

    def in_fields(self) -> DataFrame:
        return self.order_fields().select(F.col("ok").alias("schema_id"), "pos", "name")

    def extra(self) -> DataFrame:
        """A given mapping for the inputs of pending orders."""
        pending = self.orders.where("o_orderstatus = 'P'")
        mapping = F.expr(
            "array(named_struct('o', 'col_1', 'i', array('col_2', 'col_3')), named_struct('o', 'delta', 'i', array('col_0')))"
        )
        return pending.select(
            F.col("o_custkey").alias("lineage_key"), F.col("o_orderkey").alias("input_ord"),
            F.col("o_orderkey").alias("input_schema_id"), F.posexplode(mapping).alias("edge_ord", "m"),
        ).select("lineage_key", "input_ord", "input_schema_id", "edge_ord",
                 F.col("m.o").alias("output_field"), F.col("m.i").alias("input_fields"))

    # --- runs and metrics ------------------------------------------------------------------

    def run_meta(self) -> DataFrame:
        """One run per customer with orders, started at its last order."""
        last = self.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max("o_orderdate").alias("last"))
        return self.customer.join(last, "c_custkey").select(
            F.col("c_custkey").alias("run_id"),
            F.concat(F.lit("job_"), F.col("c_mktsegment")).alias("app"),
            F.concat(F.lit("git/"), F.col("c_nationkey")).alias("repo"),
            F.concat(F.lit("v"), F.col("c_custkey") % 10).alias("version"),
            (F.col("c_acctbal") < 0).alias("is_dirty"),
            F.concat(F.lit("author_"), F.col("c_nationkey")).alias("author"),
            F.concat(F.lit("user_"), F.col("c_custkey") % 100).alias("user"),
            iso_time("last").alias("start"),
        )

    def run_entities(self) -> dict[str, DataFrame]:
        return app_run_rows(stored(self.run_meta(), "run-meta"))

    def order_metrics(self) -> DataFrame:
        """(ok, field, stat, value): line count and quantity of each field of an order's file."""
        return self.order_columns().select("ok", F.col("name").alias("field"), long_stats("count", "sum"))

    def report_metrics(self) -> DataFrame:
        """(ck, field, stat, value): orders in a customer's report, and their total."""
        per_report = self.orders.groupBy(F.col("o_custkey").alias("ck")).agg(
            F.count("*").cast("double").alias("nrows"), F.round(F.sum("o_totalprice"), 2).alias("total")
        )
        return per_report.select("ck", F.lit("").alias("field"), long_stats("nrows", "total"))

    # --- messages ----------------------------------------------------------------------------

    def messages(self, events: DataFrame | None = None) -> DataFrame:
        """(type, namespace, stream, offset, data) of all events; also of a streaming read of them."""
        return (spread(self.events) if events is None else events).selectExpr(*MESSAGE_COLUMNS)

    def chat_messages(self, conversations: DataFrame | None = None) -> DataFrame:
        """(stream, offset, data) of all conversation turns, the stream named by the role."""
        df = self.conversations if conversations is None else conversations
        return df.select(
            F.col("role").alias("stream"), (F.col("conv_id") * 1000 + F.col("turn")).alias("offset"),
            F.to_json(F.struct("turn", "text")).alias("data"),
        )

    def declared(self) -> DataFrame:
        """Catalog (stream, field, types) of the event streams."""
        streams = self.events.select(F.expr(STREAM_NAME).alias("stream")).distinct()
        types = F.expr(
            "map('k', array('number'), 'user', array('integer', 'null'), 'value', array('integer'), "
            "'note', array('string', 'null'), 'ghost', array('string'))"
        )
        return streams.select("stream", F.explode(types).alias("field", "types"))

    # --- SQL log --------------------------------------------------------------------------------

    def query_log(self) -> DataFrame:
        """(stmt_id, sql) of all orders."""
        return spread(self.orders).selectExpr("o_orderkey AS stmt_id", f"{LOG_SQL} AS sql")

    def table_fields(self) -> DataFrame:
        """(table_name, fields) of all tables named in the log: their rows of pos and name as one list each."""
        files = field_lists(self.order_fields().select("ok", "pos", "name"), "ok")
        reports = field_lists(self.report_fields().select("ck", F.col("pos").cast("long").alias("pos"), "name"), "ck")
        return files.select(F.concat(F.lit("wh.sales.orders_"), F.col("ok")).alias("table_name"), "fields").unionByName(
            reports.select(F.concat(F.lit("wh.rep.customer_"), F.col("ck")).alias("table_name"), "fields"))

    def logged_tables(self) -> DataFrame:
        """(table_name, fields) of the same tables: rows of pos, name, dtype, count and sum as one list each; reports have no metrics."""
        nothing = F.lit(None).cast("double")
        files = field_lists(self.order_columns(), "ok")
        reports = field_lists(self.report_fields().select(
            "ck", F.col("pos").cast("long").alias("pos"), "name", "dtype", nothing.alias("count"), nothing.alias("sum")), "ck")
        return files.select(F.concat(F.lit("wh.sales.orders_"), F.col("ok")).alias("table_name"), "fields").unionByName(
            reports.select(F.concat(F.lit("wh.rep.customer_"), F.col("ck")).alias("table_name"), "fields"))


# The expressions below are read by Spark and by the checking SQL alike.
STREAM_NAME = "CASE WHEN event_type IN ('click', 'view') THEN concat('web.', event_type) ELSE event_type END"
NOTE = (
    "CASE event_id % 7 WHEN 0 THEN 'null' WHEN 1 THEN concat('\"u', CAST(user_id AS STRING), '\"') "
    "WHEN 2 THEN concat('\"é', CAST(user_id AS STRING), '\"') WHEN 3 THEN '[1, 2]' "
    "WHEN 4 THEN CAST(user_id AS STRING) WHEN 5 THEN 'true' ELSE concat('\"😀', CAST(user_id AS STRING), '\"') END"
)
DATA = (
    "concat(substr(props, 1, length(props) - 1), ', \"user\": ', CAST(user_id AS STRING), ', \"value\": ', "
    f"CAST(value AS STRING), ', \"note\": ', {NOTE}, ', \"ghost\": null}}')"
)
MESSAGE_COLUMNS = [
    "CASE WHEN event_type = 'signup' THEN 'STATE' ELSE 'RECORD' END AS type",
    "CASE WHEN event_type IN ('click', 'view') THEN 'web.' END AS namespace",
    "event_type AS stream",
    "event_id AS offset",
    f"{DATA} AS data",
]
OK, CK, NEXT = "CAST(o_orderkey AS STRING)", "CAST(o_custkey AS STRING)", "CAST(o_orderkey + 1 AS STRING)"
LOG_SQL = f"""CASE o_orderpriority
  WHEN '1-URGENT' THEN concat('/* model; from wh.no.where */ create table "wh"."rep"."customer_', {CK}, '__dbt_tmp" as (select a.*, "from" from wh.sales.orders_', {OK}, ' a join "wh"."sales"."orders_', {NEXT}, '" b on a.k = b.k)')
  WHEN '2-HIGH' THEN concat('insert into wh.rep.customer_', {CK}, ' select * from wh.sales.orders_', {OK}, ' -- from wh.no.where')
  WHEN '3-MEDIUM' THEN concat('create or replace view wh.rep.customer_', {CK}, ' as with src as (select * from wh.sales.orders_', {OK}, ') select * from src; select * from wh.sales.orders_', {NEXT}, ';')
  WHEN '4-NOT SPECIFIED' THEN concat('select oid from pg_class where relname = %s and oid = ', {OK})
  ELSE concat('merge into wh.rep.customer_', {CK}, ' t using wh.sales.orders_', {OK}, ' s on t.k = %s when matched then update set v = %s') END"""

# --- the same frames in SQL -----------------------------------------------------------------------

FILES_SQL = """
order_fields AS (
  SELECT l_orderkey AS ok, l_partkey % 40 AS pos, 'col_' || (l_partkey % 40) AS name,
    min(CASE WHEN l_linenumber <= 2 THEN 'bigint' WHEN l_linenumber <= 4 THEN 'double' ELSE 'string' END) AS dtype
  FROM lineitem GROUP BY 1, 2, 3),
order_sources AS (
  SELECT o_orderkey AS ok, o_custkey AS ck, o_orderstatus AS status,
    'warehouse/' || o_orderstatus || '/orders_' || o_orderkey || '.parquet' AS location,
    md5('warehouse/' || o_orderstatus || '/orders_' || o_orderkey || '.parquet,parquet') AS data_source_id
  FROM orders),
order_schemas AS (
  SELECT s.ok, s.ck, s.status, s.data_source_id,
    md5(string_agg(f.name || '-' || f.dtype, ',' ORDER BY f.name, f.dtype) || ',' || s.data_source_id) AS schema_id,
    count(*) AS n_fields
  FROM order_sources s JOIN order_fields f ON s.ok = f.ok GROUP BY s.ok, s.ck, s.status, s.data_source_id),
report_fields AS (
  SELECT ck, pos, 'col_' || pos AS name,
    CASE pos % 3 WHEN 0 THEN 'bigint' WHEN 1 THEN 'double' ELSE 'string' END AS dtype
  FROM (SELECT c_custkey AS ck, unnest(range(0, c_nationkey + 1)) AS pos FROM customer)),
report_sources AS (
  SELECT c_custkey AS ck, 'reports/customer_' || c_custkey || '.csv' AS location,
    md5('reports/customer_' || c_custkey || '.csv,csv') AS data_source_id FROM customer),
report_schemas AS (
  SELECT s.ck, s.data_source_id,
    md5(string_agg(f.name || '-' || f.dtype, ',' ORDER BY f.name, f.dtype) || ',' || s.data_source_id) AS schema_id
  FROM report_sources s JOIN report_fields f ON s.ck = f.ck GROUP BY s.ck, s.data_source_id)"""

LINEAGE_SQL = FILES_SQL + """,
direct AS (
  SELECT o.ck, o.ok, f.pos, f.name AS output_field, f.name AS input_fields
  FROM order_sources o JOIN order_fields f ON o.ok = f.ok JOIN report_fields r ON r.ck = o.ck AND r.name = f.name),
in_lists AS (SELECT ok, string_agg(name, '-' ORDER BY pos) AS names FROM order_fields GROUP BY ok),
whole AS (
  SELECT o.ck, o.ok, r.pos, r.name AS output_field, l.names AS input_fields
  FROM order_sources o JOIN in_lists l ON o.ok = l.ok JOIN report_fields r ON r.ck = o.ck),
direct_or_whole AS (
  SELECT * FROM direct UNION ALL
  SELECT w.* FROM whole w WHERE NOT EXISTS (SELECT 1 FROM direct d WHERE d.ok = w.ok)),
lineage AS (
  SELECT s.ck, s.schema_id, md5(s.schema_id || coalesce(
    string_agg(d.output_field || ':' || d.input_fields, ',' ORDER BY d.ok, d.pos) FILTER (WHERE d.ok IS NOT NULL), '')) AS id,
    count(d.ok) AS n_edges
  FROM report_schemas s LEFT JOIN direct d ON s.ck = d.ck GROUP BY s.ck, s.schema_id)"""

RUNS_SQL = """
runs AS (
  SELECT *, md5(app) AS application, md5(username) AS user_id, md5(author) AS author_id FROM (
    SELECT c_custkey AS run_id, 'job_' || c_mktsegment AS app, 'git/' || c_nationkey AS repo,
      'v' || (c_custkey % 10) || CASE WHEN c_acctbal < 0 THEN ' (dirty)' ELSE '' END AS version,
      CASE WHEN c_acctbal < 0 THEN 'user_' || (c_custkey % 100) ELSE 'author_' || c_nationkey END AS author,
      'user_' || (c_custkey % 100) AS username,
      (SELECT strftime(max(o_orderdate), '%Y-%m-%dT%H:%M:%S') FROM orders WHERE o_custkey = c_custkey) AS start
    FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders))),
repos AS (SELECT *, md5(repo || ',' || application) AS repository FROM runs),
versions AS (SELECT *, md5(version || ',' || author_id || ',' || repository) AS app_version FROM repos),
executions AS (SELECT *, md5(app_version || ',' || user_id) AS app_execution FROM versions)"""

FACTS_SQL = LINEAGE_SQL + "," + RUNS_SQL + """,
lineage_execution AS (
  SELECT l.ck, l.id AS lineage, e.app_execution AS application_execution, e.start AS start_time,
    md5(l.id || ',' || e.app_execution || ',' || e.start) AS id
  FROM lineage l JOIN executions e ON l.ck = e.run_id),
order_metrics AS (
  SELECT ok, field, stat, value FROM (
    SELECT l_orderkey AS ok, 'col_' || (l_partkey % 40) AS field, CAST(count(*) AS DOUBLE) AS count, sum(l_quantity) AS sum
    FROM lineitem GROUP BY 1, 2) UNPIVOT (value FOR stat IN (count, sum))),
report_metrics AS (
  SELECT ck, '' AS field, stat, value FROM (SELECT o_custkey AS ck, CAST(count(*) AS DOUBLE) AS nrows, round(sum(o_totalprice), 2) AS total
    FROM orders GROUP BY 1) UNPIVOT (value FOR stat IN (nrows, total))),
facts AS (
  SELECT md5(s.schema_id || ',' || x.id) AS metrics_id, s.schema_id, x.id AS lineage_execution_id, m.field, m.stat, m.value, s.ck, o.location, 'parquet' AS format
  FROM order_metrics m JOIN order_schemas s ON m.ok = s.ok JOIN order_sources o ON m.ok = o.ok JOIN lineage_execution x ON x.ck = s.ck
  UNION ALL
  SELECT md5(s.schema_id || ',' || x.id), s.schema_id, x.id, m.field, m.stat, m.value, s.ck, r.location, 'csv'
  FROM report_metrics m JOIN report_schemas s ON m.ck = s.ck JOIN report_sources r ON r.ck = s.ck JOIN lineage_execution x ON x.ck = s.ck)"""


def duck(expression: str) -> str:
    """A shared expression in the checking engine's spelling."""
    return expression.replace("AS STRING", "AS VARCHAR")


MESSAGES_SQL = f"""
messages AS (SELECT {", ".join(duck(c) for c in MESSAGE_COLUMNS).replace("AS offset", 'AS "offset"')} FROM events),
keyed AS (SELECT coalesce(namespace, '') || stream AS stream, "offset", data FROM messages WHERE type = 'RECORD'),
keys AS (SELECT stream, "offset", data, unnest(json_keys(data)) AS field FROM keyed),
fields AS (
  SELECT stream, "offset", field, json_extract(data, '$.' || field) AS v,
    CASE json_type(json_extract(data, '$.' || field)) WHEN 'NULL' THEN 'null' WHEN 'VARCHAR' THEN 'string'
      WHEN 'UBIGINT' THEN 'number' WHEN 'BIGINT' THEN 'number' WHEN 'DOUBLE' THEN 'number' ELSE 'other' END AS kind
  FROM keys),
amounts AS (
  SELECT stream, "offset", field, kind, CASE kind WHEN 'number' THEN CAST(v AS DOUBLE)
    WHEN 'string' THEN length(v ->> '$') + length(regexp_replace(v ->> '$', '[^\\x{{10000}}-\\x{{10FFFF}}]', '', 'g')) END AS amount
  FROM fields WHERE kind IN ('number', 'string'))"""

LOG_TEXTS_SQL = f"""
log AS (SELECT o_orderkey AS stmt_id, {duck(LOG_SQL)} AS sql FROM orders)"""
