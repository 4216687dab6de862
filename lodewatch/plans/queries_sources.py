"""Registered queries: scans, sinks, messages, observation log."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from lodewatch.functions.keys import dict_fields
from lodewatch.operators import transform
from lodewatch.plans.registry import query
from lodewatch.plans.universe import FILES_SQL, MESSAGES_SQL, RUNS_SQL, TABLES
from lodewatch.session import work_dir
from lodewatch.sources import files, messages, observations, tables

ORDERS_CSV = (
    "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate string, o_orderpriority string"
)
ORDERS_SQL = (
    "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, "
    "strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderpriority{more} FROM orders"
)


def orders_by_day(u):
    return u.orders.withColumn("o_orderdate", F.to_date("o_orderdate"))


def temp_name(stem: str) -> str:
    return f"{stem}_{uuid.uuid4().hex}"


@query("a1_scan_csv", ORDERS_SQL.format(more=""))
def a1(u):
    path = work_dir(u.spark, "orders-csv")
    files.write_csv(orders_by_day(u), path)
    df = files.scan_csv(u.spark, path, ORDERS_CSV, parse_dates=["o_orderdate"], categories=["o_orderstatus"])
    return df.withColumn("o_orderdate", F.col("o_orderdate").cast("string"))


@query(
    "a2_scan_csv_by_period",
    ORDERS_SQL.format(more=", CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month"),
)
def a2(u):
    root = work_dir(u.spark, "orders-by-month")
    day = F.col("o_orderdate")
    dated = orders_by_day(u).withColumns({"y": F.year(day), "m": F.month(day)}).hint("rebalance", "y", "m")
    files.write_csv(dated, root, partition_by=["y", "m"])
    df = files.scan_csv_by_period(u.spark, root + "/y={year}/m={month}/*.csv", ORDERS_CSV)
    return df


@query(
    "a3_external_table",
    "SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders",
)
def a3(u):
    table = files_table(u, "orders")
    return table.select("o_orderkey", "o_totalprice", "o_orderpriority")


def files_table(u, name):
    return tables.external_table(u.spark, temp_name(name), f"{u.sf_dir}/{name}.parquet")


@query("a4_csv_to_parquet", "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, value, props FROM events")
def a4(u):
    src = work_dir(u.spark, "events") + ".csv"
    files.write_csv(u.events.select("event_id", "ts", "value", "props"), src)
    schema = "event_id bigint, ts string, value double, props string"
    df = files.csv_to_parquet(u.spark, src, src[:-4] + ".parquet", schema, {"events": "ts"})
    return df.withColumn("ts", F.date_format("ts", files.TIMESTAMP_TEXT))


@query("a5_write_csv", "SELECT * FROM part")
def a5(u):
    path = work_dir(u.spark, "part-csv")
    files.write_csv(u.part, path)
    return files.scan_csv(u.spark, path, u.part.schema)


@query(
    "a6_write_csv_indexed",
    "SELECT row_number() OVER (ORDER BY c_custkey) - 1 AS row_index, c_custkey, c_name, c_acctbal FROM customer",
)
def a6(u):
    path = work_dir(u.spark, "customer-csv")
    files.write_csv_indexed(u.customer.select("c_custkey", "c_name", "c_acctbal"), path, ["c_custkey"], "row_index")
    return files.scan_csv(u.spark, path, "row_index bigint, c_custkey bigint, c_name string, c_acctbal double")


@query(
    "a7_ctas_partitioned",
    "SELECT event_id, user_id, event_type, value, strftime(ts, '%Y-%m-%d') AS d, "
    "ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-20' AS in_range FROM events",
)
def a7(u):
    table = tables.ctas_partitioned(u.events, temp_name("events_by_day"), "ts", work_dir(u.spark, "events-by-day"))
    days = tables.on_dates(table, "ts", "2024-01-10", "2024-01-20").select("event_id", F.lit(True).alias("hit"))
    every = table.join(days, "event_id", "left")
    return every.select("event_id", "user_id", "event_type", "value", F.col("d").cast("string").alias("d"), F.coalesce("hit", F.lit(False)).alias("in_range"))


def _customer_drops(u):
    """Customers as eight drops of CSV files, and their URIs."""
    root = work_dir(u.spark, "customer-drops")
    files.write_csv(u.customer.withColumn("drop", F.col("c_custkey") % 8), root, partition_by=["drop"])
    return root, [f"{root}/drop={i}" for i in range(8)]


@query(
    "a8_load_from_uris",
    "SELECT 'drop=' || (c_custkey % 8) AS drop_name, count(*) AS nrows, 5 AS n_edges, "
    "(SELECT count(*) FROM customer) AS loaded FROM customer GROUP BY 1",
)
def a8(u):
    root, uris = _customer_drops(u)
    loaded, sources = files.load_from_uris(
        u.spark, uris, work_dir(u.spark, "customer-loaded"), u.customer.schema, "csv", header=True
    )
    edges = files.load_edges(sources, u.customer.schema, "customer").groupBy("location")
    name = F.substring_index("location", "/", -1).alias("drop_name")
    per_uri = sources.join(edges.agg(F.count("*").cast("int").alias("n_edges")), "location")
    return per_uri.select(name, "nrows", "n_edges").withColumn("loaded", F.lit(loaded.count()).cast("long"))


CUSTOMER_FIELDS = ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")


@query(
    "a8_uri_lineages",
    "SELECT DISTINCT 'drop=' || (c_custkey % 8) AS drop_name, md5('0123456789abcdef' || '" + ",".join(f"{c}:{c}" for c in CUSTOMER_FIELDS) + "') AS id, "
    "5 AS n_edges FROM customer",
)
def a8_lineages(u):
    """One lineage, with its id, per loaded URI."""
    _, uris = _customer_drops(u)
    _, sources = files.load_from_uris(u.spark, uris, work_dir(u.spark, "customer-loaded"), u.customer.schema, "csv", header=True)
    made = files.load_lineages(sources, u.customer.schema, "0123456789abcdef")
    return made.select(F.substring_index("lineage_key", "/", -1).alias("drop_name"), "id", F.col("n_edges").cast("int").alias("n_edges"))


@query("a9_copy_dataset", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def a9(u):
    return files.copy_dataset(u.spark, f"{u.sf_dir}/supplier.parquet", work_dir(u.spark, "supplier-copy"))


@query("a10_seed_load", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal, (SELECT count(*) FROM supplier) AS nrows FROM supplier")
def a10(u):
    src = work_dir(u.spark, "supplier-csv")
    files.write_csv(u.supplier, src)
    table, nrows = tables.seed_load(
        u.spark, src, temp_name("supplier_seed"), u.supplier.schema, work_dir(u.spark, "supplier-seed")
    )
    return table.withColumn("nrows", F.lit(nrows).cast("long"))


DUCK_TYPES = (
    "CASE data_type WHEN 'INTEGER' THEN 'int' WHEN 'BIGINT' THEN 'bigint' WHEN 'VARCHAR' THEN 'string' "
    "WHEN 'DOUBLE' THEN 'double' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' WHEN 'FLOAT[]' THEN 'array<float>' END"
)
COUNTS_SQL = " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS nrows FROM {t}" for t in TABLES)


@query(
    "a11_table_schema",
    "SELECT c.table_name, CAST(c.ordinal_position - 1 AS INTEGER) AS pos, c.column_name AS name, "
    f"{DUCK_TYPES} AS dtype, n.nrows FROM (SELECT DISTINCT table_name, ordinal_position, column_name, data_type "
    f"FROM information_schema.columns) c JOIN ({COUNTS_SQL}) n USING (table_name)",
)
def a11(u):
    schemas = []
    for name in TABLES:
        registered = temp_name(name)
        tables.external_table(u.spark, registered, f"{u.sf_dir}/{name}.parquet")
        fields = tables.table_schema(u.spark, registered)
        schemas.append(fields.select(F.lit(name).alias("table_name"), "pos", "name", "dtype"))
    counts = tables.row_counts({name: getattr(u, name) for name in TABLES})
    return transform.concat(schemas).join(counts, "table_name")


@query("d10_row_count", COUNTS_SQL)
def d10(u):
    return tables.row_counts({name: getattr(u, name) for name in TABLES})


def _chart_payloads(u):
    """A chart payload per customer: one query of two records, and a second query for BUILDING."""
    first = (
        "concat('{\"colnames\": [\"k\", \"v\"], \"data\": [{\"k\": ', c_custkey, ', \"v\": ', c_nationkey, "
        "'}, {\"k\": ', c_custkey + 1, ', \"v\": null}]}')"
    )
    second = "CASE WHEN c_mktsegment = 'BUILDING' THEN ', {\"colnames\": [\"x\"], \"data\": [{\"x\": 1}]}' ELSE '' END"
    return u.customer.selectExpr(
        "c_custkey AS chart_id", f"concat('{{\"queries\": [', {first}, {second}, ']}}') AS payload"
    )


@query(
    "a12_records_to_table",
    "SELECT c_custkey AS chart_id, c_custkey AS k, CAST(c_nationkey AS BIGINT) AS v FROM customer "
    "UNION ALL SELECT c_custkey, c_custkey + 1, CAST(NULL AS BIGINT) FROM customer",
)
def a12(u):
    first = messages.first_query_only(_chart_payloads(u)).select("chart_id", "data")
    return messages.records_to_table(first, "data", "k: bigint, v: bigint")


@query(
    "e2_first_query_only",
    "SELECT c_custkey AS chart_id, 'k,v' AS colnames, CASE WHEN c_mktsegment = 'BUILDING' THEN 2 ELSE 1 END AS n_queries FROM customer",
)
def e2(u):
    first = messages.first_query_only(_chart_payloads(u))
    return first.select("chart_id", F.array_join("colnames", ",").alias("colnames"), "n_queries")


@query(
    "a13_write_observations",
    f"WITH {FILES_SQL} SELECT '{{\"id\":\"' || data_source_id || '\",\"location\":\"' || location || "
    "'\",\"format\":\"parquet\"}' AS value FROM order_sources "
    "UNION ALL SELECT '{\"id\":\"' || data_source_id || '\",\"location\":\"' || location || '\",\"format\":\"csv\"}' FROM report_sources",
)
def a13(u):
    path = work_dir(u.spark, "observation-log")
    observations.write_observations(u.data_source_rows(), path)
    return u.spark.read.text(path)


@query(
    "a14_read_observations",
    f"WITH {FILES_SQL} SELECT 'data_source' AS entity, data_source_id AS id, location AS detail FROM order_sources "
    "UNION ALL SELECT 'data_source', data_source_id, location FROM report_sources "
    "UNION ALL SELECT 'schema', s.schema_id, f.name || ':' || f.dtype FROM order_schemas s JOIN order_fields f USING (ok)",
)
def a14(u):
    path = work_dir(u.spark, "observation-log")
    observations.write_observations(u.data_source_rows(), path)
    schema_rows = u.order_schemas().select(
        F.col("schema_id").alias("id"), dict_fields("fields").alias("fields"), F.col("data_source_id").alias("data_source")
    )
    observations.write_observations(schema_rows, path)
    back = observations.read_observations(u.spark, path)
    sources = back["data_source"].select(F.lit("data_source").alias("entity"), "id", F.col("location").alias("detail"))
    fields = back["schema"].select("id", F.explode("fields").alias("name", "dtype"))
    return sources.unionByName(
        fields.select(F.lit("schema").alias("entity"), "id", F.concat_ws(":", "name", "dtype").alias("detail"))
    )


@query(
    "a15_sql_query_source",
    "SELECT c_mktsegment, o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total "
    "FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2",
)
def a15(u):
    return tables.sql_query_source(
        u.spark,
        "SELECT c_mktsegment, o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total "
        "FROM {o} JOIN {c} ON o_custkey = c_custkey GROUP BY 1, 2",
        {"o": u.orders, "c": u.customer},
    )


@query(
    "a16_message_source",
    f'WITH {MESSAGES_SQL} SELECT stream, "offset", data FROM keyed',
)
def a16(u):
    return messages.keyed(u.messages())


# Every eleventh envelope is broken in one of five ways.
BROKEN = (
    "CASE event_id % 11 WHEN 0 THEN substr({text}, 3) WHEN 1 THEN concat('[', {text}, ']') WHEN 2 THEN replace({text}, '\"type\"', '\"kind\"') "
    "WHEN 3 THEN replace({text}, '\"stream\"', '\"channel\"') WHEN 4 THEN replace({text}, '\"data\"', '\"body\"') ELSE {text} END"
)
ENVELOPE_TEXT = "concat('{{\"type\": \"RECORD\", \"record\": {{\"stream\": \"', event_type, '\", \"data\": {{\"n\": ', CAST(event_id AS {text}), '}}}}}}')"


@query(
    "a16_refused_envelopes",
    "SELECT reason, event_type AS stream, count(*) AS n, sum(event_id)::BIGINT AS ids FROM (SELECT event_id, CASE WHEN event_id % 11 > 4 THEN event_type END AS event_type, "
    "CASE event_id % 11 WHEN 0 THEN 'no JSON' WHEN 1 THEN 'no object' WHEN 2 THEN 'no type' WHEN 3 THEN 'record without stream' WHEN 4 THEN 'record without data' END AS reason "
    "FROM events) GROUP BY 1, 2",
)
def a16_refused(u):
    """Envelopes that were taken, by stream, and refused ones, by reason: together all that were read."""
    raw = u.events.selectExpr("event_id AS offset", BROKEN.format(text=ENVELOPE_TEXT.format(text="STRING")) + " AS value")
    judged = messages.judged_envelopes(raw)
    kept = messages.kept_envelopes(judged).select(F.lit(None).cast("string").alias("reason"), "stream", "offset")
    refused = messages.refused_envelopes(judged).select("reason", F.lit(None).cast("string").alias("stream"), "offset")
    return kept.unionByName(refused).groupBy("reason", "stream").agg(F.count(F.lit(1)).alias("n"), F.sum("offset").alias("ids"))


PEOPLE_SQL = f"""WITH {RUNS_SQL}
SELECT DISTINCT 'application' AS entity, application AS id, app AS name FROM executions
UNION SELECT 'app_user', user_id, username FROM executions UNION SELECT 'app_user', author_id, author FROM executions"""


def _people(back):
    return transform.concat([back[name].select(F.lit(name).alias("entity"), "id", "name") for name in ("application", "app_user")])


@query("a14_tagged_log", PEOPLE_SQL)
def a14_tagged(u):
    """Users and applications from a tagged log, each read from its own folder."""
    path, entities = work_dir(u.spark, "tagged-log"), u.run_entities()
    observations.write_tagged({name: rows for name, rows in entities.items() if name != "run"}, path)
    return _people(observations.read_tagged(u.spark, path))


@query("a14_untagged_people", PEOPLE_SQL)
def a14_people(u):
    """The same from an untagged log: users are those that versions and runs name, applications those that repositories do."""
    path, entities = work_dir(u.spark, "untagged-log"), u.run_entities()
    for name, rows in entities.items():
        if name != "run":
            observations.write_observations(rows, path)
    return _people(observations.read_observations(u.spark, path))


@query("j9_stream_key", "SELECT event_id, coalesce(CASE WHEN event_type IN ('click', 'view') THEN 'web.' END, '') || event_type AS stream FROM events")
def j9(u):
    return u.messages().select(F.col("offset").alias("event_id"), messages.stream_key("namespace", "stream").alias("stream"))


@query(
    "h8_schema_fields",
    "SELECT table_name, string_agg(column_name || ':' || CASE column_name WHEN 'o_orderdate' THEN 'date' "
    "WHEN 'c_mktsegment' THEN 'category' ELSE CASE data_type WHEN 'VARCHAR' THEN 'object' WHEN 'DOUBLE' THEN 'float64' "
    "WHEN 'TIMESTAMP' THEN 'datetime64[ns]' ELSE 'int64' END END, ',' ORDER BY ordinal_position) AS fields, "
    "max(CASE table_name WHEN 'orders' THEN (SELECT count(*) FROM orders) ELSE (SELECT count(*) FROM customer) END) AS nrows "
    "FROM (SELECT DISTINCT table_name, column_name, data_type, ordinal_position FROM information_schema.columns "
    "WHERE table_name IN ('orders', 'customer')) GROUP BY table_name",
)
def h8(u):
    from lodewatch.operators.entities import schema_fields

    hints = {"o_orderdate": "date", "c_mktsegment": "category"}
    parts = []
    for name in ("orders", "customer"):
        rows = schema_fields(getattr(u, name), hints, dtype_style="pandas")
        listed = F.array_sort(F.collect_list(F.struct("pos", F.concat_ws(":", "name", "dtype").alias("text"))))
        parts.append(rows.agg(F.array_join(listed["text"], ",").alias("fields")).withColumn("table_name", F.lit(name)))
    counts = tables.row_counts({"orders": u.orders, "customer": u.customer})
    return transform.concat(parts).join(counts, "table_name")
