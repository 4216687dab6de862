from __future__ import annotations

import datetime
import math
import numbers
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from lodewatch.operators import profile, quantiles, transform


def as_dict(metrics):
    return {(r["field"], r["stat"]): r["value"] for r in metrics.collect()}


TYPED = "n int, `d 1` double, `t.s` timestamp_ntz, day date, ok boolean, s string, a array<int>"


def typed_frame(spark):
    ts = datetime.datetime
    data = [
        (1, 1.5, ts(1970, 1, 1, 0, 0, 1, 999999), datetime.date(1970, 1, 2), True, "x", [1]),
        (None, float("nan"), ts(2024, 5, 6, 7, 8, 9), None, None, "y", None),
        (3, None, None, datetime.date(2000, 1, 1), False, None, [2]),
        (3, -2.0, ts(2020, 1, 1), None, True, "x", []),
    ]
    return spark.createDataFrame(data, TYPED)


EXPECTED = {
    ("", "nrows"): 4,
    ("n", "min"): 1, ("n", "max"): 3, ("n", "mean"): 7 / 3, ("n", "nullrows"): 1,
    ("d 1", "min"): -2.0, ("d 1", "max"): 1.5, ("d 1", "mean"): -0.25, ("d 1", "nullrows"): 2,
    ("t.s", "min"): 1000, ("t.s", "max"): 1714979289000, ("t.s", "nullrows"): 1,
    ("day", "min"): 86400000, ("day", "max"): 946684800000, ("day", "nullrows"): 2,
    ("ok", "true"): 2, ("ok", "nullrows"): 1,
    ("s", "levels"): 2, ("s", "nullrows"): 1,
}


@pytest.mark.parametrize("levels", ["exact", "approx"])
def test_profile_by_type(spark, levels):
    assert as_dict(profile.profile_table(typed_frame(spark), levels=levels)) == pytest.approx(EXPECTED)


def test_temporal_values_do_not_depend_on_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert as_dict(profile.profile_table(typed_frame(spark))) == pytest.approx(EXPECTED)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_profile_options(spark):
    df = typed_frame(spark)
    no_levels = as_dict(profile.profile_table(df, levels="none"))
    assert ("s", "levels") not in no_levels and no_levels[("s", "nullrows")] == 1
    assert ("n", "min") not in as_dict(profile.profile_table(df, skip_first=True))
    some = as_dict(profile.profile_table(df, where=[F.col("n") == 3, F.col("ok")]))
    assert some[("", "nrows")] == 1 and some[("d 1", "max")] == -2.0


def test_empty_table_and_all_null_column(spark):
    empty = spark.createDataFrame([], TYPED)
    got = as_dict(profile.profile_table(empty))
    assert got[("", "nrows")] == 0 and got[("s", "levels")] == 0 and ("n", "min") not in got
    zeros = as_dict(profile.profile_table(empty, null_as_zero=True))
    assert zeros[("n", "min")] == 0
    assert as_dict(profile.describe(empty)) == {
        ("n", "count"): 0, ("d 1", "count"): 0, ("s", "count"): 0, ("s", "unique"): 0, ("ok", "count"): 0,
        ("ok", "unique"): 0, ("t.s", "count"): 0, ("day", "count"): 0,
    }
    nulls = spark.range(3).select(F.lit(None).cast("double").alias("x"), F.lit(None).cast("string").alias("y"))
    assert as_dict(profile.profile_table(nulls)) == {
        ("", "nrows"): 3, ("x", "nullrows"): 3, ("y", "nullrows"): 3, ("y", "levels"): 0,
    }


def test_registry(spark):
    registry = profile.default_registry().register("zeros", profile.NUMERIC, lambda c: F.count_if(c == 0))
    registry.register("longest", profile.STRING, lambda c: F.max(F.length(c)))
    df = spark.createDataFrame([(0, "abc"), (1, None)], "n int, s string")
    got = as_dict(profile.profile_table(df, registry=registry))
    assert (got[("n", "zeros")], got[("s", "longest")], got[("s", "levels")]) == (1, 3, 1)
    assert all(m.stat != "zeros" for m in profile.default_registry().metrics)


def test_wide_texts_are_told_apart(spark):
    long_a, long_b = "a" * 70_000, "a" * 69_999 + "b"
    df = spark.createDataFrame([(long_a,), (long_b,), (long_a,), ("short",), (None,)], "s string")
    assert as_dict(profile.profile_string(df)) == {("s", "levels"): 3, ("s", "nullrows"): 1}
    assert as_dict(profile.describe_categorical(df))[("s", "freq")] == 2


def pandas_describe(pdf):
    d = pdf.describe(include="all")
    return {
        (c, stat): float(v)
        for c in d.columns
        for stat, v in d[c].items()
        if isinstance(v, numbers.Number) and not math.isnan(v)
    }


def asset_frame():
    rng = random.Random(7)
    n = 500
    return pd.DataFrame(
        {
            "Date": pd.date_range("2022-01-03", periods=n),
            "Symbol": [rng.choice(["APCX", "BZFD"]) for _ in range(n)],
            "Adj Close": [rng.choice([1.5, None, rng.random() * 10]) for _ in range(n)],
            "Volume": [rng.choice([100, 100, rng.randrange(10**6)]) for _ in range(n)],
        }
    )


def test_describe_equals_pandas(spark):
    pdf = asset_frame()
    df = spark.createDataFrame(pdf)
    assert as_dict(profile.describe(df)) == pytest.approx(pandas_describe(pdf))
    # The first column can be left out, and one row has no deviation.
    assert all(f != "Date" for f, _ in as_dict(profile.describe(df, skip_first=True)))
    single = spark.createDataFrame([(1.0,)], "x double")
    assert ("x", "std") not in as_dict(profile.describe(single))


@pytest.mark.parametrize("one_task_rows", [0, 10**9])
def test_quantiles_with_hot_value_equal_pandas(spark, monkeypatch, one_task_rows):
    """A third of the rows share one value; brackets are on, negative zero and NaN occur."""
    monkeypatch.setattr(quantiles, "SKETCH_K", 400)
    df = spark.range(30_000, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, 5.0).otherwise(F.pmod(F.xxhash64("id"), F.lit(10_000)) / 7).alias("hot"),
        F.when(F.col("id") % 10 == 0, F.lit(float("nan"))).when(F.col("id") % 10 == 1, F.lit(-0.0)).otherwise(F.lit(0.0)).alias("zero"),
        F.col("id").alias("id"),
        F.lit(None).cast("int").alias("none"),
    )
    columns, probs = ["hot", "zero", "id", "none"], [0.25, 0.5, 0.75]
    got = quantiles.exact_quantiles(df, columns, probs, one_task_rows)
    values = {(r["field"], r["prob"]): r["value"] for r in got.collect()}
    pdf = df.toPandas()
    expected = {(c, p): pdf[c].quantile(p) for c in ("hot", "zero", "id") for p in probs}
    assert values == pytest.approx(expected)


def test_missed_brackets_are_counted_again(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "sketched_brackets", lambda row, columns: {"c0": [(-5.0, -4.0), (990.0, 999.0)]})
    monkeypatch.setattr(quantiles, "SKETCH_K", 200)
    df = spark.range(1000).select(F.col("id").cast("double").alias("x"))
    got = quantiles.exact_quantiles(df, ["x"], [0.25, 0.5])
    assert {r["prob"]: r["value"] for r in got.collect()} == {0.25: 249.75, 0.5: 499.5}


def test_profile_of_union_combines(spark):
    a = spark.createDataFrame([(1, 2.0), (5, None)], "n int, x double")
    b = spark.createDataFrame([(3, -1.0)], "n int, x double")
    pa, pb, both = (as_dict(profile.profile_table(df)) for df in (a, b, transform.concat([a, b])))
    for key in both:
        if key[1] in ("nullrows", "nrows"):
            assert both[key] == pa[key] + pb[key]
        elif key[1] in ("min", "max"):
            assert both[key] == {"min": min, "max": max}[key[1]](pa[key], pb[key])


def test_metrics_in_flight(spark):
    df = typed_frame(spark)
    observed, seen, entries = profile.observe_frame_metrics(df)
    assert len(observed.collect()) == 4
    got = as_dict(profile.observed_rows(df, seen, entries))
    wanted = {k: v for k, v in EXPECTED.items() if k[1] not in ("mean", "levels")}
    assert got == pytest.approx(wanted)


def test_maps_and_deltas(spark):
    long = spark.createDataFrame([("a", "", "nrows", 2.0), ("a", "x", "min", 1.0)], "id string, field string, stat string, value double")
    assert profile.metrics_long_to_map(long, ["id"]).first()["metrics"] == {"nrows": 2.0, "x.min": 1.0}
    read = spark.createDataFrame([("x", 3.0), ("y", 1.0)], "field string, value double")
    copied = spark.createDataFrame([("x", 2.0), ("z", 4.0)], "field string, value double")
    got = {r["field"]: (r["read"], r["copied"], r["delta"]) for r in profile.read_vs_copied(read, copied, ["field"]).collect()}
    assert got == {"x": (3.0, 2.0, -1.0), "y": (1.0, None, -1.0), "z": (None, 4.0, 4.0)}
    later = transform.merge_metrics([read, copied], ["field"])
    assert {r["field"]: r["value"] for r in later.collect()} == {"x": 2.0, "y": 1.0, "z": 4.0}
