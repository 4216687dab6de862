"""Registered queries: projections, filters, unions, text and key functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodewatch.functions import keys, sqltext
from lodewatch.operators import entities, transform
from lodewatch.operators.skew import salted_join
from lodewatch.plans.registry import query
from lodewatch.plans.universe import FILES_SQL, LOG_SQL, RUNS_SQL
from lodewatch.session import work_dir

LINE = ["l_orderkey", "l_partkey", "l_linenumber", "l_returnflag", "l_extendedprice", "l_discount"]
LINES = ", ".join(LINE)
DELTA = "l_extendedprice * (1 - l_discount) - l_extendedprice"


def delta(df):
    discounted = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return transform.derive_diff(df, "delta", discounted, "l_extendedprice")


@query("b1_filter_eq", f"SELECT {LINES} FROM lineitem WHERE l_returnflag = 'A'")
def b1(u):
    return transform.project(transform.filter_eq(u.lineitem, "l_returnflag", "A"), LINE)


@query("b2_filter_le", f"SELECT {LINES} FROM lineitem WHERE nullif(l_tax, 0.0) <= 0.04")
def b2(u):
    df = u.lineitem.withColumn("tax", F.nullif("l_tax", F.lit(0.0)))
    return transform.project(transform.filter_le(df, "tax", 0.04), LINE)


@query("b3_filter_conj", f"SELECT {LINES} FROM lineitem WHERE l_quantity > 10 AND l_discount < 0.05 AND l_returnflag <> 'N'")
def b3(u):
    predicates = [F.col("l_quantity") > 10, F.col("l_discount") < 0.05, F.col("l_returnflag") != "N"]
    return transform.project(transform.filter_conj(u.lineitem, predicates), LINE)


@query("b4_derive_diff", f"SELECT l_orderkey, l_partkey, l_linenumber, round({DELTA}, 4) AS delta FROM lineitem")
def b4(u):
    return delta(u.lineitem).select("l_orderkey", "l_partkey", "l_linenumber", F.round("delta", 4).alias("delta"))


@query("b5_project", "SELECT l_shipmode_like, l_orderkey FROM (SELECT l_linestatus AS l_shipmode_like, l_orderkey FROM lineitem)")
def b5(u):
    return transform.project(u.lineitem.withColumnRenamed("l_linestatus", "l_shipmode_like"), ["l_shipmode_like", "l_orderkey"])


@query("b6_project_by_position", "SELECT l_orderkey, l_partkey, l_suppkey FROM lineitem")
def b6(u):
    return transform.project_by_position(u.lineitem, 0, 3)


@query("b7_cast_category", "SELECT o_orderkey, o_orderstatus, CAST(o_custkey AS VARCHAR) AS o_custkey FROM orders")
def b7(u):
    return transform.cast_category(u.orders, ["o_custkey"]).select("o_orderkey", "o_orderstatus", "o_custkey")


@query("b9_rename_tmp", "SELECT o_orderkey, 'wh.rep.customer_' || o_custkey AS table_name FROM orders")
def b9(u):
    tmp = F.concat(F.lit("wh.rep.customer_"), F.col("o_custkey"), F.when(F.col("o_orderstatus") == "P", "__dbt_tmp").otherwise(""))
    return u.orders.select("o_orderkey", keys.strip_tmp(tmp).alias("table_name"))


@query(
    "b10_split_by_key",
    f"SELECT l_returnflag, l_orderkey, l_extendedprice, round({DELTA}, 4) AS delta FROM lineitem",
)
def b10(u):
    reports = transform.split_by_key(
        delta(u.lineitem), "l_returnflag", work_dir(u.spark, "reports"), ["l_orderkey", "l_extendedprice", "delta"]
    )
    # Reading one report at a time and joining them again shows that none is lost.
    parts = [reports.where(F.col("l_returnflag") == flag) for flag in ("A", "N", "R")]
    return transform.concat(parts).withColumn("delta", F.round("delta", 4))


@query(
    "f1_concat",
    "SELECT l_orderkey, l_linenumber, l_quantity, CAST(NULL AS DOUBLE) AS l_tax FROM lineitem WHERE l_returnflag = 'A' "
    "UNION ALL SELECT l_orderkey, l_linenumber, NULL, l_tax FROM lineitem WHERE l_returnflag = 'R' "
    "UNION ALL SELECT l_orderkey, l_linenumber, l_quantity, l_tax FROM lineitem WHERE l_returnflag = 'N'",
)
def f1(u):
    a = transform.filter_eq(u.lineitem, "l_returnflag", "A").select("l_quantity", "l_orderkey", "l_linenumber")
    b = transform.filter_eq(u.lineitem, "l_returnflag", "R").select("l_orderkey", "l_linenumber", "l_tax")
    c = transform.filter_eq(u.lineitem, "l_returnflag", "N").select("l_orderkey", "l_tax", "l_linenumber", "l_quantity")
    return transform.concat([a, b, c])


@query(
    "f2_merge_inputs",
    "SELECT stmt_id, input FROM (SELECT o_orderkey AS stmt_id, unnest(CASE o_orderpriority "
    "WHEN '1-URGENT' THEN ['seed_' || o_custkey, 'wh.sales.orders_' || o_orderkey, 'wh.sales.orders_' || (o_orderkey + 1)] "
    "WHEN '3-MEDIUM' THEN ['seed_' || o_custkey, 'wh.sales.orders_' || o_orderkey, 'wh.sales.orders_' || (o_orderkey + 1)] "
    "WHEN '4-NOT SPECIFIED' THEN ['seed_' || o_custkey] "
    "ELSE ['seed_' || o_custkey, 'wh.sales.orders_' || o_orderkey] END) AS input FROM orders)",
)
def f2(u):
    from lodewatch.operators.sqllog import merge_inputs

    log = u.orders.selectExpr("o_orderkey AS stmt_id", "o_custkey", f"{LOG_SQL} AS sql")
    named = sqltext.qualified_only(sqltext.input_tables(sqltext.clean_sql("sql")))
    seeds = F.array(F.concat(F.lit("seed_"), F.col("o_custkey")))
    return log.select("stmt_id", F.explode(merge_inputs(seeds, named)).alias("input"))


@query(
    "f3_merge_metrics",
    "SELECT l_returnflag AS field, 'sum' AS stat, round(sum(l_quantity), 2) AS value FROM lineitem WHERE l_returnflag <> 'N' GROUP BY 1 "
    "UNION ALL SELECT 'N', 'sum', round(sum(l_extendedprice), 2) FROM lineitem WHERE l_returnflag = 'N'",
)
def f3(u):
    def metric(df, column):
        return df.groupBy(F.col("l_returnflag").alias("field")).agg(F.round(F.sum(column), 2).alias("value")).withColumn("stat", F.lit("sum"))

    first = metric(u.lineitem, "l_quantity")
    later = metric(u.lineitem.where("l_returnflag = 'N'"), "l_extendedprice")
    return transform.merge_metrics([first, later], ["field", "stat"])


@query("e3_first_type", "SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'number' ELSE 'string' END AS dtype FROM orders")
def e3(u):
    types = F.when(F.col("o_orderstatus") == "P", F.array(F.lit("number"), F.lit("null"))).otherwise(F.array(F.lit("string")))
    return u.orders.select("o_orderkey", transform.first_type(types).alias("dtype"))


@query(
    "e4_first_match",
    "SELECT p_partkey, CASE WHEN starts_with(p_name, 'small r') THEN 'ring' WHEN starts_with(p_name, 'small') THEN 'small' "
    "WHEN starts_with(p_name, 'red') THEN 'red' END AS processor FROM part",
)
def e4(u):
    registry = [("small r", "ring"), ("small", "small"), ("red", "red"), ("small ring", "never")]
    return u.part.select("p_partkey", transform.first_match("p_name", registry).alias("processor"))


# --- keys -------------------------------------------------------------------------------------


@query("g1_md5_key", f"WITH {FILES_SQL} SELECT ok, data_source_id FROM order_sources")
def g1(u):
    return u.order_sources().select("ok", "data_source_id")


@query(
    "g2_split_path",
    "SELECT o_orderkey, 'wh.v1/' || o_orderstatus || '/f_' || o_orderkey AS location, 'csv' AS format FROM orders",
)
def g2(u):
    path = F.concat(F.lit("wh.v1/"), F.col("o_orderstatus"), F.lit("/f_"), F.col("o_orderkey"), F.lit(".csv"))
    location, fmt = keys.split_path(path)
    return u.orders.select("o_orderkey", location.alias("location"), fmt.alias("format"))


@query("g3_base_name", "SELECT page_id, regexp_extract(url, '([^/]*)$', 1) AS base FROM pages")
def g3(u):
    return u.pages.select("page_id", keys.base_name("url").alias("base"))


@query(
    "g4_extract_server",
    "SELECT o_orderkey, CASE o_orderstatus WHEN 'P' THEN NULL ELSE 'local' END AS server FROM orders",
)
def g4(u):
    path = F.concat(
        F.when(F.col("o_orderstatus") == "P", "hdfs://n/").when(F.col("o_orderstatus") == "F", "/").otherwise("file:/"),
        F.col("o_orderkey"),
    )
    return u.orders.select("o_orderkey", keys.extract_server(path).alias("server"))


@query(
    "g5_qualified_name",
    "SELECT o_orderkey, CASE o_orderstatus WHEN 'P' THEN NULL WHEN 'F' THEN 'wh.' || o_orderkey "
    "ELSE 'wh.sales.' || o_orderkey END AS name FROM orders",
)
def g5(u):
    status = F.col("o_orderstatus")
    schema = F.when(status == "F", "").otherwise("sales")
    relation = F.when(status != "P", F.col("o_orderkey").cast("string"))
    return u.orders.select("o_orderkey", keys.qualified_name(F.lit(None).cast("string"), schema, relation, "wh").alias("name"))


@query(
    "g6_alnum_underscore",
    "SELECT page_id, '_airbyte_raw_' || regexp_replace(url, '[^A-Za-z0-9_]', '_', 'g') AS name FROM pages",
)
def g6(u):
    return u.pages.select("page_id", keys.raw_table_name("url").alias("name"))


@query(
    "g7_iso_time",
    "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS iso, epoch_us(ts) // 1000 AS ms FROM events WHERE extract(microseconds FROM ts) % 1000000 <> 0 "
    "UNION ALL SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S'), epoch_us(ts) // 1000 FROM events WHERE extract(microseconds FROM ts) % 1000000 = 0",
)
def g7(u):
    return u.events.select("event_id", keys.iso_time("ts").alias("iso"), _ms("ts").alias("ms"))


def _ms(ts):
    # Naive timestamps are read as UTC, whatever the session's zone.
    return keys.epoch_ms(F.convert_timezone(F.lit("UTC"), F.current_timezone(), ts))


@query(
    "g8_json_encode",
    f"WITH {FILES_SQL} SELECT '{{\"id\":\"' || data_source_id || '\",\"ck\":' || ck || '}}' AS json FROM order_sources",
)
def g8(u):
    return u.order_sources().select(keys.json_encode(F.col("data_source_id").alias("id"), "ck").alias("json"))


@query("g11_strlen", "SELECT doc_id, length(text) + length(regexp_replace(text, '[^\\x{10000}-\\x{10FFFF}]', '', 'g')) AS units FROM documents")
def g11(u):
    from lodewatch.functions.messages import text_units

    return u.documents.select("doc_id", text_units("text").alias("units"))


@query("g12_dirty_version", f"WITH {RUNS_SQL} SELECT run_id, version, author FROM runs")
def g12(u):
    meta = u.run_meta()
    return meta.select(
        "run_id",
        keys.dirty_version(F.col("version"), F.col("is_dirty")).alias("version"),
        keys.dirty_author(F.col("author"), F.col("user"), F.col("is_dirty")).alias("author"),
    )


@query("g13_dict_fields", f"WITH {FILES_SQL} SELECT s.schema_id, f.name, f.dtype FROM order_schemas s JOIN order_fields f USING (ok)")
def g13(u):
    maps = u.order_fields().groupBy("ok").agg(keys.dict_fields(F.collect_list(F.struct("name", "dtype"))).alias("fields"))
    return u.order_schemas().drop("fields").join(maps, "ok").select("schema_id", F.explode("fields").alias("name", "dtype"))


@query(
    "e1_sort_fields",
    f"WITH {FILES_SQL} SELECT ok, CAST(row_number() OVER (PARTITION BY ok ORDER BY name, dtype) - 1 AS INTEGER) AS ord, name, dtype FROM order_fields",
)
def e1(u):
    return entities.sort_fields(u.order_fields(), "ok")


@query(
    "c2_salted_join",
    "SELECT l_orderkey, l_linenumber, l_returnflag, n FROM lineitem JOIN (SELECT l_suppkey, l_returnflag, count(*) AS n FROM lineitem GROUP BY 1, 2) "
    "USING (l_suppkey, l_returnflag)",
)
def salted(u):
    """Line items with the number of their supplier and flag; every key above 20 rows is salted, and the keys' types differ."""
    counts = u.lineitem.groupBy(F.col("l_suppkey").cast("decimal(20,0)").alias("l_suppkey"), "l_returnflag").agg(F.count("*").alias("n"))
    joined = salted_join(u.lineitem, counts, ["l_suppkey", "l_returnflag"], hot_rows=20)
    return joined.select("l_orderkey", "l_linenumber", "l_returnflag", "n")


@query(
    "c4_salted_anti_join",
    "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 3 = 0)",
)
def salted_anti(u):
    """Orders of customers outside a list; customers with five orders or more are salted."""
    listed = u.customer.where("c_custkey % 3 = 0").select(F.col("c_custkey").cast("int").alias("o_custkey"))
    return salted_join(u.orders.select("o_orderkey", "o_custkey"), listed, "o_custkey", "left_anti", hot_rows=5)
