"""Hot keys: a third of all rows or more share a key; results stay whole."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from lodewatch.operators import skew
from lodewatch.streaming import metrics


@pytest.fixture
def low_threshold(monkeypatch):
    monkeypatch.setattr(skew, "HOT_ROWS", 50)


def sides(spark):
    left = spark.range(900).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 97).alias("k"), F.col("id").alias("v"))
    right = spark.range(-1, 60).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    # Some rows of the right side repeat, also for the hot key.
    return left, right.unionByName(right.where("k < 3"))


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_plain_join(spark, low_threshold, how):
    left, right = sides(spark)
    hot = skew.hot_keys(left, skew.common_types(left, right, ["k"]), 50).collect()
    assert len(hot) == 1 and hot[0]["salts"] == 7
    got, plain = skew.salted_join(left, right, "k", how), left.join(right, ["k"], how)
    assert got.columns == plain.columns
    assert got.exceptAll(plain).count() == 0 and plain.exceptAll(got).count() == 0


TYPES = [("int", "bigint"), ("bigint", "int"), ("date", "timestamp"), ("float", "double"), ("string", "string")]


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("kinds", TYPES)
def test_keys_of_different_types(spark, how, kinds):
    def key(n, kind):
        days = {"date": "date_add(date'2024-01-01', cast({0} as int))", "timestamp": "timestamp_seconds(1704067200 + 86400 * {0})"}
        reals = {"float": "if({0} = 0, cast('-0.0' as float), cast({0} as float))", "double": "if({0} = 1, cast('NaN' as double), cast({0} as double))"}
        return F.expr({**days, **reals}.get(kind, f"cast({{0}} as {kind})").format(n)).alias("k")

    left = spark.range(400).select(key("if(id % 4 = 0, null, id % 4)", kinds[0]), F.col("id").alias("v"))
    left = left.unionByName(spark.range(80).select(key("0", kinds[0]), F.col("id").alias("v")))
    right = spark.range(6).select(key("if(id = 5, null, id)", kinds[1]), (F.col("id") * 2).alias("w"))
    got, plain = skew.salted_join(left, right, "k", how, hot_rows=20), left.join(right, ["k"], how)
    assert got.exceptAll(plain).count() == 0 and plain.exceptAll(got).count() == 0


def test_hot_key_is_spread_over_tasks(spark, low_threshold):
    left, right = sides(spark)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = skew.salted_join(left, right, "k").where("k = -1").select(F.spark_partition_id().alias("p"))
        assert joined.distinct().count() > 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_lineage_with_hot_lineage_and_hot_schema(spark, low_threshold):
    import test_lineage

    test_lineage.test_edges_and_ids_against_brute_force(spark, 5)


def test_facts_with_hot_keys(spark, monkeypatch):
    import test_lineage

    monkeypatch.setattr(skew, "HOT_ROWS", 1)
    test_lineage.test_facts_orphans_and_references(spark)


def test_violations_with_many_streams(spark, monkeypatch):
    messages = spark.range(300).select(
        F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id"))).alias("stream"),
        F.col("id").alias("offset"), F.lit('{"k": "x"}').alias("data"),
    )
    catalog = messages.select("stream", F.lit("k").alias("field"), F.array(F.lit("number")).alias("types")).distinct()
    declared = metrics.declared_types(catalog)
    small = metrics.schema_violations(messages, declared)
    monkeypatch.setattr(metrics, "small_enough", lambda table: False)
    large = metrics.schema_violations(messages, declared)
    assert large.exceptAll(small).count() == 0 and small.exceptAll(large).count() == 0
    assert large.where("stream = 'hot'").first()["records"] == 200
