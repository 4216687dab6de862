"""Registered queries: profilers."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodewatch.functions import sqltext
from lodewatch.operators import profile, transform
from lodewatch.operators.cells import profile_tables
from lodewatch.operators.quantiles import exact_quantiles
from lodewatch.plans.queries_transform import DELTA, delta
from lodewatch.plans.registry import query
from lodewatch.plans.universe import TABLES

DIGITS = 4


def rounded(metrics, digits: int = DIGITS):
    return metrics.withColumn("value", F.round("value", digits))


# --- checking SQL --------------------------------------------------------------------------------


def stat_sql(source: str, fields: dict[str, dict[str, str]], digits: int = DIGITS) -> str:
    """One row per field and statistic: `fields` maps a field to {stat: aggregate}."""
    return " UNION ALL ".join(
        f"SELECT '{field}' AS field, '{stat}' AS stat, round(CAST({agg} AS DOUBLE), {digits}) AS value FROM {source}"
        for field, stats in fields.items()
        for stat, agg in stats.items()
    )


def numeric_sql(c: str) -> dict[str, str]:
    return {"min": f"min({c})", "max": f"max({c})", "mean": f"avg({c})", "nullrows": f"count(*) FILTER ({c} IS NULL)"}


def temporal_sql(c: str) -> dict[str, str]:
    return {
        "min": f"CAST(floor(epoch(min({c}))) AS BIGINT) * 1000",
        "max": f"CAST(floor(epoch(max({c}))) AS BIGINT) * 1000",
        "nullrows": f"count(*) FILTER ({c} IS NULL)",
    }


def text_sql(c: str) -> dict[str, str]:
    return {"levels": f"count(DISTINCT {c})", "nullrows": f"count(*) FILTER ({c} IS NULL)"}


def describe_sql(c: str) -> dict[str, str]:
    return {
        "count": f"count({c})", "mean": f"avg({c})", "std": f"stddev_samp({c})", "min": f"min({c})",
        "25%": f"quantile_cont({c}, 0.25)", "50%": f"quantile_cont({c}, 0.5)", "75%": f"quantile_cont({c}, 0.75)",
        "max": f"max({c})",
    }


def category_sql(c: str) -> dict[str, str]:
    return {"count": f"count({c})", "unique": f"count(DISTINCT {c})", "freq": f"max((SELECT max(n) FROM (SELECT count(*) AS n FROM {{t}} GROUP BY {c})))"}


LINE_NUMBERS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]
LINE_TEXTS = ["l_returnflag", "l_linestatus"]
NROWS = {"": {"nrows": "count(*)"}}


def line_profile_sql(source: str, numbers=tuple(LINE_NUMBERS)) -> str:
    fields = {c: numeric_sql(c) for c in numbers} | {"l_shipdate": temporal_sql("l_shipdate")}
    return stat_sql(source, fields | {c: text_sql(c) for c in LINE_TEXTS} | NROWS)


REPORT = (
    f"(SELECT *, {DELTA} AS delta FROM lineitem WHERE l_returnflag = 'A' "
    f"UNION ALL SELECT *, {DELTA} AS delta FROM lineitem WHERE l_returnflag = 'R')"
)


@query("entry_profile_union", line_profile_sql(REPORT, (*LINE_NUMBERS, "delta")))
def entry(u):
    """Union of two filtered parts, a derived column, and the profile of the result."""
    parts = [delta(transform.filter_eq(u.lineitem, "l_returnflag", flag)) for flag in ("A", "R")]
    return rounded(profile.profile_table(transform.concat(parts)))


@query("d1_describe_numeric", stat_sql("lineitem", {c: describe_sql(c) for c in LINE_NUMBERS}))
def d1(u):
    return rounded(profile.describe_numeric(u.lineitem))


@query(
    "d1_describe_numeric_ranked",
    stat_sql("orders", {c: {s: a for s, a in describe_sql(c).items() if "%" in s} for c in ("o_totalprice", "o_custkey", "o_orderkey")}),
)
def d1_ranked(u):
    """Quartiles summed over all tasks, the way taken for tables beyond one task per column."""
    columns = ["o_totalprice", "o_custkey", "o_orderkey"]
    ranked = exact_quantiles(u.orders, columns, [0.25, 0.5, 0.75], one_task_rows=0)
    percent = F.concat((F.col("prob") * 100).cast("int").cast("string"), F.lit("%"))
    return rounded(ranked.select("field", percent.alias("stat"), "value"))


def _categories(tables: dict[str, list[str]]) -> str:
    return " UNION ALL ".join(
        stat_sql(t, {c: {s: a.replace("{t}", t) for s, a in category_sql(c).items()} for c in cols}) for t, cols in tables.items()
    )


@query("d2_describe_categorical", _categories({"customer": ["c_mktsegment"], "part": ["p_brand", "p_type"], "documents": ["lang", "source"]}))
def d2(u):
    return transform.concat(
        [
            profile.describe_categorical(u.customer, ["c_mktsegment"]),
            profile.describe_categorical(u.part, ["p_brand", "p_type"]),
            profile.describe_categorical(u.documents, ["lang", "source"]),
        ]
    )


@query("d3_describe_datetime", stat_sql("orders", {"o_orderdate": {"count": "count(o_orderdate)"}}) + " UNION ALL " + stat_sql("events", {"ts": {"count": "count(ts)"}}))
def d3(u):
    return transform.concat([profile.describe_datetime(u.orders), profile.describe_datetime(u.events)])


@query(
    "d4_drop_nan_metrics",
    "SELECT l_orderkey AS field, 'ratio' AS stat, round(max(l_discount / l_tax), 4) AS value FROM lineitem WHERE l_tax > 0 GROUP BY 1",
)
def d4(u):
    ratio = F.try_divide("l_discount", "l_tax")
    nan = F.when(F.col("l_tax") == 0, F.lit(float("nan"))).otherwise(ratio)
    lowest = u.lineitem.withColumn("r", nan).groupBy(F.col("l_orderkey").alias("field")).agg(
        F.max(F.nullif("r", F.lit(float("nan")))).alias("value")
    )
    with_nan = lowest.withColumn("value", F.coalesce("value", F.lit(float("nan")))).withColumn("stat", F.lit("ratio"))
    return rounded(profile.drop_nan_metrics(with_nan)).select("field", "stat", "value")


@query("d5_profile_numeric", stat_sql("(SELECT *, nullif(l_tax, 0.0) AS tax FROM lineitem)", {c: numeric_sql(c) for c in ["l_quantity", "l_extendedprice", "tax"]}))
def d5(u):
    df = u.lineitem.withColumn("tax", F.nullif("l_tax", F.lit(0.0)))
    return rounded(profile.profile_numeric(df, ["l_quantity", "l_extendedprice", "tax"]))


@query(
    "d6_profile_temporal",
    stat_sql("orders", {"o_orderdate": temporal_sql("o_orderdate")}) + " UNION ALL "
    + stat_sql("events", {"ts": temporal_sql("ts")}) + " UNION ALL "
    + stat_sql("(SELECT CAST(l_shipdate AS DATE) AS ship_day FROM lineitem)", {"ship_day": temporal_sql("ship_day")}),
)
def d6(u):
    days = u.lineitem.select(F.to_date("l_shipdate").alias("ship_day"))
    return transform.concat([profile.profile_temporal(df) for df in (u.orders, u.events, days)])


FLAGS = "(SELECT toxic = 1 AS is_toxic, CASE WHEN quality = 1 THEN toxic = 0 END AS good FROM labels)"


@query(
    "d7_profile_boolean",
    stat_sql(FLAGS, {c: {"true": f"count(*) FILTER ({c})", "nullrows": f"count(*) FILTER ({c} IS NULL)"} for c in ("is_toxic", "good")}),
)
def d7(u):
    flags = u.labels.select((F.col("toxic") == 1).alias("is_toxic"), F.when(F.col("quality") == 1, F.col("toxic") == 0).alias("good"))
    return profile.profile_boolean(flags)


@query("d8_profile_string", stat_sql("documents", {c: text_sql(c) for c in ("text", "lang", "source")}) + " UNION ALL " + stat_sql("part", {"p_brand": text_sql("p_brand")}))
def d8(u):
    return transform.concat([profile.profile_string(u.documents), profile.profile_string(u.part, ["p_brand"])])


@query("d9_profile_table", line_profile_sql("lineitem"))
def d9(u):
    return rounded(profile.profile_table(u.lineitem))


@query(
    "d9_profile_table_where",
    stat_sql(
        "(SELECT * FROM orders WHERE o_totalprice > 1000 AND o_orderstatus = 'F')",
        {"o_totalprice": numeric_sql("o_totalprice"), "o_orderdate": temporal_sql("o_orderdate"), "o_orderkey": numeric_sql("o_orderkey"),
         "o_custkey": numeric_sql("o_custkey"), "o_orderstatus": text_sql("o_orderstatus"), "o_orderpriority": text_sql("o_orderpriority")} | NROWS,
    ),
)
def d9_where(u):
    return rounded(profile.profile_table(u.orders, where=[F.col("o_totalprice") > 1000, F.col("o_orderstatus") == "F"]))


ORDER_STATS = {
    "o_orderkey": numeric_sql("o_orderkey"), "o_custkey": numeric_sql("o_custkey"), "o_totalprice": numeric_sql("o_totalprice"),
    "o_orderdate": temporal_sql("o_orderdate"), "o_orderstatus": {"nullrows": "count(*) FILTER (o_orderstatus IS NULL)"},
    "o_orderpriority": {"nullrows": "count(*) FILTER (o_orderpriority IS NULL)"},
} | NROWS


@query("d14_default_frame_metrics", stat_sql("orders", {f: {s: a for s, a in stats.items() if s != "mean"} for f, stats in ORDER_STATS.items()}))
def d14(u):
    observed, seen, entries = profile.observe_frame_metrics(u.orders)
    observed.write.format("noop").mode("overwrite").save()
    return rounded(profile.observed_rows(u.orders, seen, entries))


CUSTOMER_STATS = {
    "c_custkey": numeric_sql("c_custkey"), "c_nationkey": numeric_sql("c_nationkey"), "c_acctbal": numeric_sql("c_acctbal"),
    "c_name": text_sql("c_name"), "c_mktsegment": text_sql("c_mktsegment"),
} | NROWS
ORDER_PROFILE = ORDER_STATS | {"o_orderstatus": text_sql("o_orderstatus"), "o_orderpriority": text_sql("o_orderpriority")}


SUPPLIER_STATS = {
    "s_suppkey": numeric_sql("s_suppkey"), "s_name": text_sql("s_name"), "s_nationkey": numeric_sql("s_nationkey"), "s_acctbal": numeric_sql("s_acctbal"),
} | NROWS
# The logged tables by the remainder of the statement's key.
LOGGED = ("orders", "customer", "supplier")
TABLE_STATS = {"orders": ORDER_PROFILE, "customer": CUSTOMER_STATS, "supplier": SUPPLIER_STATS}


def logged_tables(u) -> list[str]:
    """Tables of the catalog that statements of the log read; at most as many as the catalog has."""
    tables = F.get(F.array(*[F.lit(t) for t in LOGGED]), (F.col("o_orderkey") % 3).cast("int"))
    text = F.concat(F.lit("insert into wh.rep.r_"), F.col("o_orderkey"), F.lit(" select * from wh.main."), tables, F.lit(" t where k = 'from wh.main.part'"))
    log = u.orders.select(F.col("o_orderkey").alias("stmt_id"), text.alias("sql"))
    read = log.select(F.explode(sqltext.input_tables(sqltext.clean_sql(F.col("sql")))).alias("name")).distinct()
    short = F.substring_index("name", ".", -1)
    return sorted(r["name"] for r in read.select(short.alias("name")).where(F.col("name").isin(TABLES)).collect())


@query(
    "d15_sql_table_metrics",
    " UNION ALL ".join(f"SELECT '{t}' AS table_name, * FROM ({stat_sql(t, stats)})" for t, stats in TABLE_STATS.items()),
)
def d15(u):
    """Metrics of every table that a logged statement reads, all in one aggregation."""
    return rounded(profile_tables({name: getattr(u, name) for name in logged_tables(u)}))


@query(
    "d16_metrics_long_to_map",
    "SELECT ok, key, value FROM (SELECT l_orderkey AS ok, 'col_' || (l_partkey % 40) || '.count' AS key, CAST(count(*) AS DOUBLE) AS value "
    "FROM lineitem GROUP BY 1, 2 UNION ALL SELECT l_orderkey, 'col_' || (l_partkey % 40) || '.sum', sum(l_quantity) FROM lineitem GROUP BY 1, 2)",
)
def d16(u):
    maps = profile.metrics_long_to_map(u.order_metrics(), ["ok"])
    return maps.select("ok", F.explode("metrics").alias("key", "value"))


@query("e5_freq_top1", _categories({"orders": ["o_orderpriority"], "lineitem": ["l_returnflag"]}).replace("\n", " "))
def e5(u):
    rows = [profile.describe_categorical(u.orders, ["o_orderpriority"]), profile.describe_categorical(u.lineitem, ["l_returnflag"])]
    top = transform.concat([profile.freq_top1(u.orders, ["o_orderpriority"]), profile.freq_top1(u.lineitem, ["l_returnflag"])])
    return transform.concat([transform.concat(rows).where("stat <> 'freq'"), top])


L1_SQL = stat_sql(
    "lineitem",
    {c: {"min": f"min({c})", "max": f"max({c})", "mean": f"avg({c})", "nullrows": f"count(*) FILTER ({c} IS NULL)", "negatives": f"count(*) FILTER ({c} < 0)"}
     for c in LINE_NUMBERS}
    | {"l_shipdate": temporal_sql("l_shipdate")}
    | {c: text_sql(c) | {"longest": f"max(length({c}))"} for c in LINE_TEXTS} | NROWS,
)


@query("l1_metric_registry", L1_SQL)
def l1(u):
    registry = profile.default_registry().register("negatives", profile.NUMERIC, lambda c: F.count_if(c < 0))
    registry.register("longest", profile.STRING, lambda c: F.max(F.length(c)))
    return rounded(profile.profile_table(u.lineitem, registry=registry))
