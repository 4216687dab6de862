"""Findings of round 4."""

from __future__ import annotations

import datetime
import hashlib

import __spark_entry__ as driver
import pytest
from pyspark.sql import functions as F

from lodewatch.functions.keys import packed_id, unpacked_id
from lodewatch.operators import lineage, skew, sqllog
from lodewatch.session import stored


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def md5(*parts: str) -> str:
    return hashlib.md5(",".join(parts).encode()).hexdigest()


FIELDS = [("a.b.src", 0, "x", "int"), ("a.b.src", 1, "y", "int"), ("a.b.other", 0, "z", "int"), ("a.b.out", 0, "y", "string"), ("a.b.idle", 0, "q", "int")]
METRICS = [("a.b.src", "x", "max", 3.0), ("a.b.src", "", "nrows", None), ("a.b.out", "", "nrows", 2.0), ("a.b.idle", "", "nrows", 1.0)]
SCHEMAS = {name: md5(",".join(sorted(f"{n}-{t}" for o, _, n, t in FIELDS if o == name)), md5(f"postgres://h:1/{name},postgres"))
           for name in {f[0] for f in FIELDS}}


def observed(spark, listed: bool = False):
    log = spark.createDataFrame([
        (1, "insert into a.b.out select * from a.b.src join a.b.other"), (2, "insert into a.b.out select * from a.b.src join a.b.other"),
        (3, "create table a.b.out__dbt_tmp as select * from a.b.other"), (4, "insert into a.b.out select * from a.b.nowhere"),
        (5, "insert into a.b.out select * from a.b.out"),
    ], "stmt_id long, sql string")
    fields = spark.createDataFrame(FIELDS, "table_name string, pos long, name string, dtype string")
    metrics = spark.createDataFrame(METRICS, "table_name string, field string, stat string, value double")
    runs = spark.createDataFrame([(1, "app", "t1"), (2, "app", "t1"), (5, md5("app"), "t1"), (5, md5("app"), "t2"), (9, "app", "t1")],
                                 "stmt_id long, app_execution string, start_time string")
    if not listed:
        return sqllog.observe_log(log, fields, metrics, runs, "h", 1)
    own = fields.withColumn("max", F.when(F.col("name") == "x", 3.0))
    return sqllog.observe_log(log, stored(lineage.field_lists(own, "table_name"), "listed"), None, runs, "h", 1, stats=["max"])


TEXTS = {"1:0:a.b.out": "y:y,y:z", "2:0:a.b.out": "y:y,y:z", "3:0:a.b.out": "y:z", "5:0:a.b.out": "y:y"}
LINEAGES = {key: md5(SCHEMAS["a.b.out"] + text) for key, text in TEXTS.items()}
RUNS = sorted([(key, md5(LINEAGES[key], "app", "t1")) for key in ("1:0:a.b.out", "2:0:a.b.out")]
              + [("5:0:a.b.out", md5(LINEAGES["5:0:a.b.out"], md5("app"), at)) for at in ("t1", "t2")], key=repr)


@pytest.mark.parametrize("listed, hot", [(False, skew.HOT_ROWS), (True, skew.HOT_ROWS), (False, 2)])
def test_observed_log(spark, rows, monkeypatch, listed, hot):
    """all that a log says, told once per statement, also where two statements have one lineage and one run, or tables are hot."""
    monkeypatch.setattr(skew, "HOT_ROWS", hot)
    seen = observed(spark, listed)
    assert rows(seen.sources, "table_name", "schema_id") == sorted(SCHEMAS.items(), key=repr)
    assert rows(seen.lineage, "lineage_key", "id", "schema_id", "n_edges") == sorted(
        [(key, LINEAGES[key], SCHEMAS["a.b.out"], 1 + text.count(",")) for key, text in TEXTS.items()], key=repr)
    assert rows(seen.execution, "lineage_key", "id") == RUNS and len({run for _, run in RUNS}) == 3
    assert {r["application_execution"] for r in seen.execution.collect()} == {"app", md5("app")}
    want = []
    for key, run in RUNS:
        for name in {"5:0:a.b.out": ["a.b.out"]}.get(key, ["a.b.src", "a.b.other", "a.b.out"]):
            want += [(md5(SCHEMAS[name], run), run, field, stat, value) for t, field, stat, value in METRICS if t == name and (stat == "max" or not listed)]
    assert rows(seen.metrics, "metrics_id", "lineage_execution_id", "field", "stat", "value") == sorted(want, key=repr)
    edges = {(r["lineage_key"], r["input_ord"], r["input_schema_id"], r["output_field"]): r["input_fields"] for r in seen.edges.collect()}
    assert edges[("1:0:a.b.out", 0, "a.b.src", "y")] == ["y"] and edges[("3:0:a.b.out", 0, "a.b.other", "y")] == ["z"] and len(edges) == 6


def test_observed_log_is_shuffled_once(spark):
    """runs, edges and metrics follow from one table of statements; no list, id or metric is shuffled again."""
    seen = observed(spark, listed=True)
    assert not any("Exchange" in plan(df) for df in (seen.sources, seen.edges, seen.lineage, seen.execution, seen.metrics))


def test_log_without_metrics(spark):
    log = spark.createDataFrame([(1, "insert into a.b.out select * from a.b.src")], "stmt_id long, sql string")
    fields = lineage.field_lists(spark.createDataFrame(FIELDS, "table_name string, pos long, name string, dtype string"), "table_name")
    runs = spark.createDataFrame([(1, "app", "t1")], "stmt_id long, app_execution string, start_time string")
    seen = sqllog.observe_log(log, fields, None, runs, "h", 1)
    assert seen.execution.count() == 1 and seen.metrics.count() == 0
    assert [c for c, _ in seen.metrics.dtypes] == ["metrics_id", "schema_id", "lineage_execution_id", "field", "stat", "value"]


def test_runs_of_equal_statements(spark, tmp_path):
    """two orders of a customer and a day, with the same fields, are two runs of one id, not four."""
    day = datetime.datetime(2020, 1, 1)
    spark.createDataFrame([(1, 7, "O", 1.0, day, "2-HIGH"), (2, 7, "O", 1.0, day, "2-HIGH")],
                          "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"
                          ).write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(1, 3, 1, 5.0), (2, 3, 1, None)], "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(7, 3)], "c_custkey long, c_nationkey int").write.parquet(f"{tmp_path}/customer.parquet")
    got = driver.queries()["i10_log_observation"](spark, str(tmp_path)).collect()
    assert sorted(r["detail"] for r in got if r["kind"] == "run") == ["1:0:wh.rep.customer_7", "2:0:wh.rep.customer_7"]
    assert len({r["id"] for r in got if r["kind"] == "run"}) == 1
    assert sorted((r["detail"], r["value"]) for r in got if r["kind"] == "metric") == [("col_3.count", 1.0), ("col_3.count", 1.0), ("col_3.sum", 5.0)]


def test_packed_ids(spark):
    texts = [md5("a"), md5("a").upper(), md5("a") + "\n", "", "é" * 8, "0" * 16, "a,b", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string").withColumn("p", packed_id("t"))
    assert [r["u"] for r in df.select(unpacked_id("p").alias("u")).collect()] == texts
    assert len(df.first()["p"]) == 17


def test_hot_keys_are_counted_in_large_groups_only(spark, monkeypatch):
    """no row per key is shuffled to find the hot ones, and none is missed, also in groups of several keys."""
    df = spark.createDataFrame([(k % 50 if k < 500 else k,) for k in range(1000)] + [(7,)] * 30, "k long")
    types = skew.common_types(df, df, ["k"])
    for groups in (1, 3, skew.KEY_GROUPS):
        monkeypatch.setattr(skew, "KEY_GROUPS", groups)
        assert [r["salts"] for r in skew.hot_keys(df, types, 40).collect()] == [2]
        assert skew.hot_keys(df, types, 41).count() == 0
