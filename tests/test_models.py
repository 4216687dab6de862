from __future__ import annotations

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodewatch.operators import models
from lodewatch.operators.charts import chart_observation, observe_charts
from lodewatch.operators.transform import filter_le


def line(spark):
    """y = 2x - 1, with one bad row beyond x = 100 that has no y."""
    good = spark.range(100).select(F.col("id").cast("double").alias("x"), (F.col("id") * 2.0 - 1).alias("y"))
    return good.unionByName(spark.createDataFrame([(3530.157, None)], "x double, y double"))


def test_fit_score_persist(spark, tmp_path):
    train = filter_le(line(spark), "x", 100)
    assert train.count() == 100
    model = models.fit_linear(line(spark), ["x"], "y")
    assert (model.coefficients[0], model.intercept) == pytest.approx((2.0, -1.0))
    models.save_model(model, f"{tmp_path}/model")
    scored = models.predict_linear(train, models.load_model(f"{tmp_path}/model"), ["x"])
    assert scored.select(F.max(F.abs(F.col("prediction") - F.col("y")))).first()[0] < 1e-9
    by_column = models.fit_linear_by(train, "x", "y").first()
    assert (by_column["slope"], by_column["intercept"]) == pytest.approx((2.0, -1.0))
    metrics = {(r["field"], r["stat"]): r["value"] for r in models.model_metrics(spark, model).collect()}
    assert metrics == pytest.approx({("", "n_parameters"): 2.0, ("weight", "min"): 2.0, ("weight", "max"): 2.0})
    params = {r["param"]: r["value"] for r in models.hyper_params(spark, model).collect()}
    assert params["fitIntercept"] == "True" and params["solver"] == "normal"
    edges = models.group_lineages(spark.range(1), F.lit("m"), ["x"], "y")
    assert {(r["lineage_key"], r["output_field"]) for r in edges.collect()} == {("fit:m", "weights"), ("predict:m", "prediction")}


def test_split_is_stable(spark):
    df = spark.range(2000, numPartitions=7)
    first = models.split_train_test(df, "id")
    again = models.split_train_test(df.repartition(3), "id")
    assert first.exceptAll(again).count() == 0
    share = first.where("part = 'test'").count() / 2000
    assert 0.28 < share < 0.38
    assert first.exceptAll(models.split_train_test(df, "id", seed=1)).count() > 0


def test_chart(spark):
    table = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("b", 4.0)], "seg string, bal double")
    result = table.groupBy("seg").agg(F.sum("bal").alias("total"))
    seen = chart_observation(table, "db.t", "parquet", result, 7, "Segments", "Sales")
    edges = {r["output_field"]: r["input_fields"] for r in seen.edges.collect()}
    assert edges == {"seg": ["seg", "bal"], "total": ["seg", "bal"]}
    metrics = {(r["field"], r["stat"]): r["value"] for r in seen.metrics.collect()}
    assert (metrics[("total", "max")], metrics[("seg", "unique")]) == (4.0, 2.0)
    assert seen.lineage.first()["n_edges"] == 2
    assert [r["location"] for r in seen.sources.orderBy("location").collect()] == ['/superset/explore/?form_data={"slice_id":7}', "db.t"]


def test_models_of_groups_equal_numpy(spark):
    rng = np.random.default_rng(3)
    rows = [(f"g{i % 5}", float(a), float(b), float(3 * a - 2 * b + i % 5 + e)) for i, (a, b, e) in enumerate(zip(rng.normal(50, 9, 400), rng.normal(-3, 1, 400), rng.normal(0, 1, 400)))]
    same = [("same", 2.0, 2.0, 5.0), ("same", 2.0, 2.0, 7.0)]  # no spread: no weights, the mean remains
    holes = [("g0", None, 1.0, 1.0), ("none", 1.0, None, 2.0), (None, 1.0, 1.0, 1.0)]
    df = spark.createDataFrame(rows + same + holes, "g string, a double, b double, y double")
    got = {r["g"]: r for r in models.fit_linear_groups(df, ["a", "b"], "y", ["g"]).collect()}
    assert set(got) == {"g0", "g1", "g2", "g3", "g4", "same", None}
    for g in range(5):
        x = np.array([[1.0, a, b] for k, a, b, _ in rows if k == f"g{g}"])
        y = np.array([v for k, *_, v in rows if k == f"g{g}"])
        want, rss, *_ = np.linalg.lstsq(x, y)
        model = got[f"g{g}"]
        assert [model["intercept"], *model["weights"]] == pytest.approx(want, rel=1e-7)
        assert (model["n"], model["rss"]) == (len(y), pytest.approx(rss[0], rel=1e-6))
    assert (got["same"]["intercept"], got["same"]["weights"], got["same"]["n"]) == (6.0, [0.0, 0.0], 2)
    # Gram matrices of parts add up to that of the whole
    parts = [models.gram(df.where(f"pmod(hash(a, b), 3) = {i}"), ["a", "b"], "y", ["g"]) for i in range(3)]
    added = models.added_grams(parts[0].unionByName(parts[1]).unionByName(parts[2]), ["g"])
    whole = {r["g"]: r["gram"] for r in models.gram(df, ["a", "b"], "y", ["g"]).collect()}
    assert {r["g"] for r in added.collect()} == set(whole)
    assert all(r["gram"] == pytest.approx(whole[r["g"]]) for r in added.collect())
    scored = models.predict_groups(df, models.fit_linear_groups(df, ["a", "b"], "y", ["g"]), ["a", "b"], ["g"])
    assert scored.count() == df.count() and scored.where("g = 'none'").first()["prediction"] is None


def test_many_charts_at_once(spark):
    def payload(rows, columns=("seg", "total", "ok", "none")):
        return json.dumps({"queries": [{"colnames": list(columns), "data": rows}]})

    rows = [{"seg": "a", "total": 1, "ok": True, "none": None, "hidden": 5}, {"seg": "b", "total": 2.5, "ok": False}, {"seg": "a", "total": None, "ok": True}]
    charts = spark.createDataFrame(
        [(1, "C", "D", "db.t", "parquet", payload(rows), "app", "t1"), (1, "C", "D", "db.t", "parquet", payload(rows[:1]), "app", "t2"),
         (2, "E", "D", "db.unknown", "csv", payload([], ["x"]), "app", "t1"), (3, "M", "D", "db.t", "parquet", payload([{"x": 1}, {"x": "t"}, {"x": [1]}], ["x"]), "app", "t1")],
        "chart_id int, chart string, dashboard string, table_name string, table_format string, payload string, app_execution string, start_time string")
    fields = spark.createDataFrame([("db.t", 0, "p", "int"), ("db.t", 1, "q", "int")], "table_name string, pos int, name string, dtype string")
    seen = observe_charts(charts, fields)
    metrics = {(r["render"], r["field"], r["stat"]): r["value"] for r in seen.metrics.collect()}
    assert {k: metrics[("1:t1", *k)] for k in (("total", "mean"), ("total", "count"), ("seg", "freq"), ("ok", "unique"), ("none", "count"))} == {
        ("total", "mean"): 1.75, ("total", "count"): 2.0, ("seg", "freq"): 2.0, ("ok", "unique"): 2.0, ("none", "count"): 0.0}
    assert not any(field == "hidden" for _, field, _ in metrics)
    assert (metrics[("3:t1", "x", "unique")], metrics[("3:t1", "x", "count")]) == (3.0, 3.0)
    factors = {r["lineage_key"]: (r["outputs"], r["inputs"]) for r in seen.factors.collect()}
    assert factors == {"1:t1": (["seg", "total", "ok", "none"], ["p", "q"]), "1:t2": (["seg", "total", "ok", "none"], ["p", "q"]), "3:t1": (["x"], ["p", "q"])}
    assert {r["lineage_key"]: r["n_edges"] for r in seen.lineage.collect()} == {"1:t1": 4, "1:t2": 4, "2:t1": 0, "3:t1": 1}
    assert seen.execution.count() == 4 and seen.sources.count() == 4 + 2
    assert {r["category"] for r in seen.sources.collect()} >= {"logical::db.t", "logical::Superset:D:C"}
