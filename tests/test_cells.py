"""Profiles of unlike tables in one aggregation."""

from __future__ import annotations

import datetime
import glob
import math
import os
import random
import shutil

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
from check_queries import compare, connect
from lodewatch.operators import cells, charts, profile

SF_DIR = "/root/testdata/sf0.01"


def tables(spark):
    day = datetime.datetime(2024, 1, 2, 3, 4, 5)
    return {
        "a": spark.createDataFrame([(1, 2.5, "x", True, day), (2, float("nan"), None, None, None), (2, None, "y" * 100, False, day)],
                                   "n int, `d 1` double, s string, f boolean, t timestamp"),
        "b": spark.createDataFrame([("k", [1])], "s string, other array<int>"),
        "empty": spark.createDataFrame([], "n int, s string"),
    }


def test_one_aggregation_says_what_single_profiles_say(spark):
    got = {(r["table_name"], r["field"], r["stat"]): r["value"] for r in cells.profile_tables(tables(spark)).collect()}
    want = {}
    for name, df in tables(spark).items():
        want |= {(name, r["field"], r["stat"]): r["value"] for r in profile.profile_table(df).collect()}
    assert got == pytest.approx(want)


def test_described_cells_equal_described_frames(spark):
    df = spark.createDataFrame([(i, float(i * i) if i % 3 else None, "ab"[i % 2], i > 4) for i in range(10)], "n int, d double, s string, f boolean")
    records = df.selectExpr("'t' as k", "parse_json(to_json(struct(n, d, s, f), map('ignoreNullFields', 'false'))) as record")
    got = {(r["field"], r["stat"]): r["value"] for r in cells.describe_cells(cells.record_cells(records, ["k"]), ["k"]).collect()}
    assert got == pytest.approx({(r["field"], r["stat"]): r["value"] for r in profile.describe(df).collect()})


CELL = "k string, field string, kind string, number double, text string"


def test_fields_of_unlike_values_count_as_texts(spark):
    """Types told beside the values: texts among numbers, flags alone and among numbers, nothing at all."""
    values = {"n": [1.0, 2.0, None], "m": [1.0, "a", 1.0], "f": [True, False, True], "g": [True, 1.0, None], "o": [None, None]}

    def cell(field, v):
        kind = "nothing" if v is None else "flag" if isinstance(v, bool) else "text" if isinstance(v, str) else "number"
        return ("c", field, kind, None if v is None or kind == "text" else float(v), v if kind == "text" else None)

    df = spark.createDataFrame([cell(field, v) for field, vs in values.items() for v in vs], CELL)
    got = {(r["field"], r["stat"]): r["value"] for r in cells.describe_cells(df, ["k"]).collect()}
    numbers = {"count": 2, "mean": 1.5, "std": math.sqrt(0.5), "min": 1, "25%": 1.25, "50%": 1.5, "75%": 1.75, "max": 2}
    texts = {"m": (3, 2, 2), "f": (3, 2, 2), "g": (2, 2, 1)}
    want = {("n", s): v for s, v in numbers.items()} | {("o", "count"): 0.0}
    want |= {(field, s): v for field, counts in texts.items() for s, v in zip(("count", "unique", "freq"), counts)}
    assert got == pytest.approx(want)


def test_dealt_cells_are_described_where_they_lie(spark):
    """A task describes the cells that it was dealt; shuffled again, all of them may meet in a few tasks."""
    df = spark.range(3000).selectExpr("string(id % 300) as k", "if(id % 2 = 0, 'n', 's') as field", "if(id % 2 = 0, 'number', 'text') as kind",
                                      "if(id % 2 = 0, double(id), null) as number", "if(id % 2 = 0, null, string(id % 7)) as text")
    told = cells.describe_cells(df.repartition(37, "k"), ["k"])
    plan = told._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan and "ENSURE_REQUIREMENTS" not in plan and "Join" not in plan


def test_metrics_of_charts_are_made_in_as_many_tasks_as_their_cells_need(spark, monkeypatch):
    monkeypatch.setattr(charts, "gathered_parts", lambda scan: 37, raising=False)
    payload = F.concat(F.lit('{"queries": [{"colnames": ["a", "b"], "data": [{"a": 1, "b": "x"}, {"a": '), F.col("id").cast("string"), F.lit(', "b": "y"}]}]}'))
    made = spark.range(400).select(
        F.col("id").alias("chart_id"), F.lit("c").alias("chart"), F.lit("d").alias("dashboard"), F.lit("db.t").alias("table_name"), F.lit("parquet").alias("table_format"),
        payload.alias("payload"), F.lit("app").alias("app_execution"), F.lit("2024-01-01T00:00:00").alias("start_time"))
    fields = spark.createDataFrame([("db.t", 0, "x", "bigint")], "table_name string, pos int, name string, dtype string")
    metrics = charts.observe_charts(made, fields).metrics
    by_task = [r["n"] for r in metrics.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert sum(by_task) == 400 * (8 + 3)
    assert len(by_task) > 30 and max(by_task) < 0.2 * sum(by_task)


def test_deviation_does_not_depend_on_the_number_of_tasks(spark):
    random.seed(5)
    rows = [(str(k), "n", "number", round(random.uniform(1e3, 4e5), 2), None) for k in range(600) for _ in range(12)]
    df = spark.createDataFrame(rows, CELL).coalesce(1)

    def deviations(parts):
        return {r["k"]: r["value"] for r in cells.describe_cells(df.repartition(parts, "k", "field"), ["k"]).where("stat = 'std'").collect()}

    one = deviations(1)
    assert len(one) == 600 and deviations(2) == one and deviations(3) == one


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
def test_charts_round_as_their_sql(spark, tmp_path):
    """The prices of this chart deviate by 140335.16360585, in binary a little less than the half of a digit."""
    orders = spark.read.parquet(f"{SF_DIR}/orders.parquet").where("o_custkey = 896")
    assert orders.count() > 1
    orders.write.parquet(f"{tmp_path}/written")
    shutil.copy(glob.glob(f"{tmp_path}/written/part-*.parquet")[0], f"{tmp_path}/orders.parquet")
    shutil.rmtree(f"{tmp_path}/written")
    verdict, _ = compare(spark, connect(str(tmp_path)), driver.queries()["k8_charts"], driver.oracle_sql()["k8_charts"], str(tmp_path))
    assert verdict == "ok"
