"""Registered queries: models and charts."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodewatch.functions.keys import iso_time
from lodewatch.operators import models
from lodewatch.operators.charts import CHART_FORMAT, chart_observation, observe_charts
from lodewatch.operators.transform import concat
from lodewatch.plans.registry import query
from lodewatch.session import stored, work_dir

LINES_SQL = (
    "SELECT l_returnflag, regr_slope(l_extendedprice, l_quantity) AS slope, regr_intercept(l_extendedprice, l_quantity) AS intercept "
    "FROM lineitem GROUP BY 1"
)


@query(
    "k1_split_train_test",
    "SELECT l_orderkey, l_partkey, l_linenumber, CASE WHEN l_orderkey % 100 < 67 THEN 'train' ELSE 'test' END AS part FROM lineitem",
)
def k1(u):
    rows = u.lineitem.select("l_orderkey", "l_partkey", "l_linenumber")
    return models.split_train_test(rows, F.col("l_orderkey") % 100)


@query("k2_fit_linear_by", f"SELECT l_returnflag, round(slope, 4) AS slope, round(intercept, 4) AS intercept FROM ({LINES_SQL})")
def k2(u):
    lines = models.fit_linear_by(u.lineitem, "l_quantity", "l_extendedprice", ["l_returnflag"])
    return lines.select("l_returnflag", F.round("slope", 4).alias("slope"), F.round("intercept", 4).alias("intercept"))


@query(
    "k2_fit_linear",
    "SELECT round(regr_slope(l_extendedprice, l_quantity), 3) AS slope, round(regr_intercept(l_extendedprice, l_quantity), 3) AS intercept FROM lineitem",
)
def k2_model(u):
    model = _model(u)
    return u.spark.createDataFrame([(float(model.coefficients[0]), float(model.intercept))], "slope double, intercept double").select(
        F.round("slope", 3).alias("slope"), F.round("intercept", 3).alias("intercept")
    )


def _model(u):
    return models.fit_linear(u.lineitem, ["l_quantity"], "l_extendedprice")


K3_SQL = (
    "SELECT l_orderkey, l_partkey, l_linenumber, l_quantity, round(slope * l_quantity + intercept, 3) AS prediction "
    f"FROM lineitem JOIN ({LINES_SQL}) USING (l_returnflag)"
)


@query("k3_predict_linear", K3_SQL)
def k3(u):
    lines = models.fit_linear_by(u.lineitem, "l_quantity", "l_extendedprice", ["l_returnflag"])
    scored = models.predict_linear_by(u.lineitem, lines, "l_quantity", ["l_returnflag"])
    return scored.select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity", F.round("prediction", 3).alias("prediction"))


@query(
    "b8_append_prediction",
    "SELECT l_orderkey, l_partkey, l_linenumber, l_quantity, round(slope * l_quantity + intercept, 2) AS prediction FROM lineitem, "
    "(SELECT regr_slope(l_extendedprice, l_quantity) AS slope, regr_intercept(l_extendedprice, l_quantity) AS intercept FROM lineitem)",
)
def b8(u):
    scored = models.predict_linear(u.lineitem, _model(u), ["l_quantity"])
    return scored.select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity", F.round("prediction", 2).alias("prediction"))


@query(
    "k4_model_persist",
    "SELECT l_orderkey, l_partkey, l_quantity, round(slope * l_quantity + intercept, 2) AS prediction FROM lineitem, "
    "(SELECT regr_slope(l_extendedprice, l_quantity) AS slope, regr_intercept(l_extendedprice, l_quantity) AS intercept FROM lineitem)",
)
def k4(u):
    path = work_dir(u.spark, "model")
    models.save_model(_model(u), path)
    scored = models.predict_linear(u.lineitem, models.load_model(path), ["l_quantity"])
    return scored.select("l_orderkey", "l_partkey", "l_quantity", F.round("prediction", 2).alias("prediction"))


@query(
    "k5_model_metrics",
    """WITH c AS (SELECT var_pop(l_quantity) AS c11, var_pop(l_discount) AS c22, covar_pop(l_quantity, l_discount) AS c12,
  covar_pop(l_quantity, l_extendedprice) AS c1y, covar_pop(l_discount, l_extendedprice) AS c2y FROM lineitem),
w AS (SELECT (c22 * c1y - c12 * c2y) / (c11 * c22 - c12 * c12) AS w1, (c11 * c2y - c12 * c1y) / (c11 * c22 - c12 * c12) AS w2 FROM c)
SELECT '' AS field, 'n_parameters' AS stat, CAST(3 AS DOUBLE) AS value
UNION ALL SELECT 'weight', 'min', round(least(w1, w2), 2) FROM w UNION ALL SELECT 'weight', 'max', round(greatest(w1, w2), 2) FROM w""",
)
def k5(u):
    model = models.fit_linear(u.lineitem, ["l_quantity", "l_discount"], "l_extendedprice")
    return models.model_metrics(u.spark, model).withColumn("value", F.round("value", 2))


@query(
    "k6_model_lineage",
    "SELECT lineage_key, input_ord, input_schema_id, edge_ord, output_field, input_fields, (SELECT count(*) FROM lineitem) AS training_rows "
    "FROM (VALUES ('fit:m', 0, 'X', 0, 'weights', 'l_quantity'), ('fit:m', 1, 'y', 0, 'weights', 'l_extendedprice'), "
    "('predict:m', 0, 'm', 0, 'prediction', 'weights'), ('predict:m', 1, 'X', 0, 'prediction', 'l_quantity')) "
    "AS t(lineage_key, input_ord, input_schema_id, edge_ord, output_field, input_fields)",
)
def k6(u):
    """Lineage of the one model of the whole table, each edge with the model's number of training rows."""
    fitted = models.fit_linear_groups(u.lineitem, ["l_quantity"], "l_extendedprice", [])
    edges = models.group_lineages(fitted, F.lit("m"), ["l_quantity"], "l_extendedprice", carry=["n"])
    return edges.withColumn("input_fields", F.array_join("input_fields", "-")).withColumnRenamed("n", "training_rows")


@query(
    "k7_hyper_params",
    "SELECT param, value, (SELECT count(*) FROM lineitem) AS training_rows FROM (VALUES ('elasticNetParam', '0.0'), "
    "('fitIntercept', 'True'), ('regParam', '0.0'), ('solver', 'normal'), ('standardization', 'False'), ('loss', 'squaredError')) AS t(param, value)",
)
def k7(u):
    model = _model(u)
    wanted = ["elasticNetParam", "fitIntercept", "regParam", "solver", "standardization", "loss"]
    rows = models.hyper_params(u.spark, model).where(F.col("param").isin(wanted))
    return rows.withColumn("training_rows", F.lit(model.summary.numInstances).cast("long"))


@query(
    "k6_model_lineages",
    "SELECT unnest(['fit:line_' || s, 'fit:line_' || s, 'predict:line_' || s, 'predict:line_' || s]) AS lineage_key, unnest([0, 1, 0, 1]) AS input_ord, "
    "unnest(['X', 'y', 'line_' || s, 'X']) AS input_schema_id, unnest(['weights', 'weights', 'prediction', 'prediction']) AS output_field, "
    "unnest(['l_quantity', 'l_extendedprice', 'weights', 'l_quantity']) AS input_fields FROM (SELECT DISTINCT l_suppkey AS s FROM lineitem)",
)
def k6_table(u):
    """Lineage of one line per supplier, made in one job from the table of fitted lines."""
    lines = models.fit_linear_by(u.lineitem, "l_quantity", "l_extendedprice", ["l_suppkey"])
    named = lines.select(F.concat(F.lit("line_"), F.col("l_suppkey")).alias("model"), F.lit("l_quantity").alias("feature"), F.lit("l_extendedprice").alias("label"))
    edges = models.model_lineages(named)
    return edges.withColumn("input_fields", F.array_join("input_fields", "-")).drop("edge_ord")


@query(
    "k7_line_params",
    "SELECT l_suppkey, unnest(['feature', 'label', 'fitIntercept', 'training_rows']) AS param, "
    "unnest(['l_quantity', 'l_extendedprice', 'true', regr_count(l_extendedprice, l_quantity)::BIGINT::VARCHAR]) AS value FROM lineitem GROUP BY l_suppkey",
)
def k7_table(u):
    """Parameters of one line per supplier; the slope's text is left to the tests."""
    return models.line_params(u.lineitem, "l_quantity", "l_extendedprice", ["l_suppkey"]).where("param <> 'slope'")


TWO = ["l_quantity", "l_discount"]
# Two features per supplier in closed form, from covariances.
MODELS_SQL = """c AS (SELECT l_suppkey, count(*) AS n, var_pop(l_quantity) AS c11, var_pop(l_discount) AS c22, covar_pop(l_quantity, l_discount) AS c12,
  covar_pop(l_quantity, l_extendedprice) AS c1y, covar_pop(l_discount, l_extendedprice) AS c2y, var_pop(l_extendedprice) AS cyy,
  avg(l_quantity) AS m1, avg(l_discount) AS m2, avg(l_extendedprice) AS my FROM lineitem GROUP BY l_suppkey),
w AS (SELECT *, (c22 * c1y - c12 * c2y) / (c11 * c22 - c12 * c12) AS w1, (c11 * c2y - c12 * c1y) / (c11 * c22 - c12 * c12) AS w2 FROM c),
models AS (SELECT *, my - w1 * m1 - w2 * m2 AS intercept, (w1 * c1y + w2 * c2y) / cyy AS r2 FROM w)"""


def supplier_models(u):
    """One model of two features per supplier; stored Gram matrices of two halves of the rows, added up."""
    halves = [models.gram(u.lineitem.where(F.col("l_linenumber") % 2 == i), TWO, "l_extendedprice", ["l_suppkey"]) for i in (0, 1)]
    parts = stored(halves[0].unionByName(halves[1]), "grams")
    return models.solve_grams(models.added_grams(parts, ["l_suppkey"]), ["l_suppkey"])


@query("k2_fit_linear_groups", f"WITH {MODELS_SQL} SELECT l_suppkey, n, round(intercept, 2) AS intercept, round(w1, 2) AS w1, round(w2, 2) AS w2, round(r2, 6) AS r2 FROM models")
def k2_groups(u):
    weights = [F.round(F.get("weights", F.lit(i)), 2).alias(f"w{i + 1}") for i in (0, 1)]
    return supplier_models(u).select("l_suppkey", "n", F.round("intercept", 2).alias("intercept"), *weights, F.round("r2", 6).alias("r2"))


@query(
    "k3_predict_groups",
    f"WITH {MODELS_SQL} SELECT l_orderkey, l_partkey, l_linenumber, round(intercept + w1 * l_quantity + w2 * l_discount, 2) AS prediction "
    "FROM lineitem JOIN models USING (l_suppkey)",
)
def k3_groups(u):
    fitted = models.fit_linear_groups(u.lineitem, TWO, "l_extendedprice", ["l_suppkey"])
    scored = models.predict_groups(u.lineitem, fitted, TWO, ["l_suppkey"])
    return scored.select("l_orderkey", "l_partkey", "l_linenumber", F.round("prediction", 2).alias("prediction"))


@query(
    "k5_group_metrics",
    f"WITH {MODELS_SQL} SELECT l_suppkey, '' AS field, 'n_parameters' AS stat, 3.0::DOUBLE AS value FROM models "
    "UNION ALL SELECT l_suppkey, '', 'training_rows', n FROM models UNION ALL SELECT l_suppkey, '', 'r2', round(r2, 4) FROM models "
    "UNION ALL SELECT l_suppkey, 'weight', 'min', round(least(w1, w2), 2) FROM models UNION ALL SELECT l_suppkey, 'weight', 'max', round(greatest(w1, w2), 2) FROM models",
)
def k5_groups(u):
    digits = F.when(F.col("stat") == "r2", F.round("value", 4)).otherwise(F.round("value", 2))
    return models.group_metrics(supplier_models(u), ["l_suppkey"]).withColumn("value", digits)


@query(
    "k6_group_lineages",
    "SELECT unnest(['fit:m_' || s, 'fit:m_' || s, 'predict:m_' || s, 'predict:m_' || s]) AS lineage_key, unnest([0, 1, 0, 1]) AS input_ord, "
    "unnest(['X', 'y', 'm_' || s, 'X']) AS input_schema_id, unnest(['weights', 'weights', 'prediction', 'prediction']) AS output_field, "
    "unnest(['l_quantity-l_discount', 'l_extendedprice', 'weights', 'l_quantity-l_discount']) AS input_fields FROM (SELECT DISTINCT l_suppkey AS s FROM lineitem)",
)
def k6_groups(u):
    edges = models.group_lineages(supplier_models(u), F.concat(F.lit("m_"), F.col("l_suppkey")), TWO, "l_extendedprice")
    return edges.withColumn("input_fields", F.array_join("input_fields", "-")).drop("edge_ord")


@query(
    "k7_group_params",
    "SELECT l_suppkey, unnest(['features', 'label', 'fitIntercept', 'solver', 'training_rows']) AS param, "
    "unnest(['l_quantity,l_discount', 'l_extendedprice', 'true', 'normal', count(*)::VARCHAR]) AS value FROM lineitem GROUP BY l_suppkey",
)
def k7_groups(u):
    return models.group_params(supplier_models(u), TWO, "l_extendedprice", ["l_suppkey"])


CHART_SQL = "SELECT c_mktsegment, count(*) AS customers, sum(c_acctbal) AS balance FROM customer GROUP BY 1"


@query(
    "k8_chart_observation",
    f"""WITH r AS ({CHART_SQL}),
edges AS (SELECT 'edge' AS kind, o AS field, 'c_custkey-c_name-c_nationkey-c_acctbal-c_mktsegment' AS detail, CAST(NULL AS DOUBLE) AS value
  FROM (SELECT unnest(['c_mktsegment', 'customers', 'balance']) AS o))
SELECT * FROM edges
UNION ALL SELECT 'metric', 'c_mktsegment', 'count', count(*) FROM r UNION ALL SELECT 'metric', 'c_mktsegment', 'unique', count(*) FROM r
UNION ALL SELECT 'metric', 'c_mktsegment', 'freq', 1 UNION ALL SELECT 'metric', c, s, round(v, 4) FROM (
  SELECT 'customers' AS c, unnest(['count', 'mean', 'std', 'min', '25%', '50%', '75%', 'max']) AS s,
    unnest([count(*), avg(customers), stddev_samp(customers), min(customers), quantile_cont(customers, 0.25), quantile_cont(customers, 0.5), quantile_cont(customers, 0.75), max(customers)]) AS v FROM r
  UNION ALL SELECT 'balance', unnest(['count', 'mean', 'std', 'min', '25%', '50%', '75%', 'max']),
    unnest([count(*), avg(balance), stddev_samp(balance), min(balance), quantile_cont(balance, 0.25), quantile_cont(balance, 0.5), quantile_cont(balance, 0.75), max(balance)]) FROM r)""",
)
def k8(u):
    result = u.customer.groupBy("c_mktsegment").agg(F.count("*").alias("customers"), F.sum("c_acctbal").alias("balance"))
    seen = chart_observation(u.customer, "db.customer", "parquet", result, 7, "Segments", "Sales")
    edges = seen.edges.select(
        F.lit("edge").alias("kind"), F.col("output_field").alias("field"), F.array_join("input_fields", "-").alias("detail"),
        F.lit(None).cast("double").alias("value"),
    )
    metrics = seen.metrics.select(
        F.lit("metric").alias("kind"), "field", F.col("stat").alias("detail"), F.round("value", 4).alias("value")
    )
    return edges.unionByName(metrics)


COLUMNS = ["o_orderkey", "o_orderstatus", "o_totalprice"]


def order_charts(u):
    """One chart per customer: a table of its orders, as a stored payload with a second query."""
    record = F.struct(*COLUMNS)
    grouped = u.orders.groupBy("o_custkey").agg(F.to_json(F.array_sort(F.collect_list(record))).alias("data"), F.max("o_orderdate").alias("last"))
    head = '{"queries": [{"colnames": ["' + '", "'.join(COLUMNS) + '"], "data": '
    return grouped.select(
        F.col("o_custkey").alias("chart_id"), F.lit("Orders").alias("chart"), F.concat(F.lit("d"), F.col("o_custkey") % 7).alias("dashboard"),
        F.lit("db.orders").alias("table_name"), F.lit("parquet").alias("table_format"),
        F.concat(F.lit(head), "data", F.lit('}, {"colnames": ["x"], "data": [{"x": 1}]}]}')).alias("payload"),
        F.md5(F.concat(F.lit("bi"), F.col("o_custkey") % 3)).alias("app_execution"), iso_time("last").alias("start_time"),
    )


def _described(field: str) -> str:
    stats = {"count": f"count({field})", "mean": f"avg({field})", "std": f"stddev_samp({field})", "min": f"min({field})", "max": f"max({field})",
             "25%": f"quantile_cont({field}, 0.25)", "50%": f"quantile_cont({field}, 0.5)", "75%": f"quantile_cont({field}, 0.75)"}
    return " UNION ALL ".join(f"SELECT o_custkey AS ck, '{field}' AS field, '{s}' AS detail, CAST({a} AS DOUBLE) AS value FROM orders GROUP BY 1" for s, a in stats.items())


@query(
    "k8_charts",
    f"""WITH c AS (SELECT o_custkey AS ck, o_custkey || ':' || strftime(max(o_orderdate), '%Y-%m-%dT%H:%M:%S') AS render,
    strftime(max(o_orderdate), '%Y-%m-%dT%H:%M:%S') AS start, md5('bi' || (o_custkey % 3)) AS app,
    md5('/superset/explore/?form_data={{"slice_id":' || o_custkey || '}},{CHART_FORMAT}') AS source FROM orders GROUP BY o_custkey),
s AS (SELECT *, md5('o_orderkey-number,o_orderstatus-text,o_totalprice-number,' || source) AS schema_id FROM c),
l AS (SELECT *, md5(schema_id || array_to_string(list_transform({COLUMNS}, lambda o: o || ':o_orderkey-o_custkey-o_orderstatus-o_totalprice-o_orderdate-o_orderpriority'), ',')) AS lineage FROM s),
x AS (SELECT *, md5(lineage || ',' || app || ',' || start) AS run FROM l),
m AS ({_described("o_orderkey")} UNION ALL {_described("o_totalprice")}
  UNION ALL SELECT o_custkey, 'o_orderstatus', 'count', count(*) FROM orders GROUP BY 1 UNION ALL SELECT o_custkey, 'o_orderstatus', 'unique', count(DISTINCT o_orderstatus) FROM orders GROUP BY 1
  UNION ALL SELECT ck, 'o_orderstatus', 'freq', max(n) FROM (SELECT o_custkey AS ck, count(*) AS n FROM orders GROUP BY o_custkey, o_orderstatus) GROUP BY 1)
SELECT 'source' AS kind, render, source AS field, schema_id AS detail, CAST(NULL AS DOUBLE) AS value FROM x
UNION ALL SELECT 'edge', render, '{"-".join(COLUMNS)}', 'o_orderkey-o_custkey-o_orderstatus-o_totalprice-o_orderdate-o_orderpriority', 3 FROM x
UNION ALL SELECT 'run', render, lineage, run, NULL FROM x UNION ALL SELECT 'skipped', render, '', '', 2 FROM x
UNION ALL SELECT 'metric', render, field, detail || ':' || md5(schema_id || ',' || run), round(value, 7) FROM m JOIN x USING (ck) WHERE value IS NOT NULL""",
)
def k8_charts(u):
    """All charts from their payloads at once: sources, factors of edges, runs, metrics, and queries left out."""
    fields = u.spark.createDataFrame(
        [("db.orders", i, f.name, f.dataType.simpleString()) for i, f in enumerate(u.orders.schema.fields)], "table_name string, pos int, name string, dtype string")
    seen = observe_charts(order_charts(u), fields)
    nothing = F.lit(None).cast("double")

    def rows(kind, df, field, detail, value=nothing, render="render"):
        return df.select(F.lit(kind).alias("kind"), F.col(render).alias("render"), field.alias("field"), detail.alias("detail"), value.alias("value"))

    runs = seen.lineage.select("lineage_key", F.col("id").alias("lineage")).join(seen.execution, "lineage")
    parts = [
        rows("source", seen.sources.where("render is not null"), F.col("id"), F.col("schema_id")),
        rows("edge", seen.factors, F.array_join("outputs", "-"), F.array_join("inputs", "-"), F.size("outputs").cast("double"), "lineage_key"),
        rows("run", runs, F.col("lineage"), F.col("id"), render="lineage_key"),
        rows("skipped", seen.skipped, F.lit(""), F.lit(""), F.col("n_queries").cast("double")),
        rows("metric", seen.metrics, F.col("field"), F.concat_ws(":", "stat", "metrics_id"), F.round(F.col("value") * 1e7) / 1e7),  # as SQL rounds: in binary
    ]
    return concat(parts)
