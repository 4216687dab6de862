"""Cases beyond the driver's tables: long texts, infinite values, repeated keys, rebuilt tables, many batches."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from lodewatch.functions import sqltext
from lodewatch.operators import lineage, profile
from lodewatch.operators.quantiles import exact_quantiles
from lodewatch.session import work_dir
from lodewatch.sources import files, tables
from lodewatch.streaming import run


@pytest.mark.parametrize("part", ["/* {} */", "'{}'", "\"{}\"", "-- {}\n"])
def test_long_comments_and_literals(spark, part):
    text = "select a from wh.s.t " + part.format("x * y " * 170_000) + " join wh.s.u on 1 = 1"
    df = spark.createDataFrame([(text,)], "sql string")
    assert df.select(sqltext.input_tables(sqltext.clean_sql("sql")).alias("t")).first()["t"] == ["wh.s.t", "wh.s.u"]


def test_edges_without_an_output_change_no_lineage(spark):
    columns = "lineage_key string, input_ord long, edge_ord int, output_field string, input_fields array<string>"
    own = [("b", 0, 0, "x", ["x"]), ("b", 1, 0, "x", ["y"])]
    heads = spark.createDataFrame([("b", "s" * 32)], "lineage_key string, schema_id string")
    alone = lineage.lineages(spark.createDataFrame(own, columns), heads).collect()
    stray = [("a", 0, 0, "q", ["q"]), ("c", 0, 0, "q", ["q"])]
    mixed = lineage.lineages(spark.createDataFrame(own + stray, columns).coalesce(1), heads).collect()
    assert mixed == alone and alone[0]["n_edges"] == 2
    with pytest.raises(Exception, match="input_ord"):
        lineage.lineages(spark.createDataFrame([("b", -1, 0, "x", ["x"])], columns), heads).collect()


def test_infinite_quartiles_are_the_same_at_every_size(spark):
    values = [1.0, 2.0, math.inf, math.inf, -math.inf, -math.inf, 5.0, math.inf]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    plain = df.select(F.percentile("v", F.array(*[F.lit(p) for p in (0.25, 0.5, 0.75)])).alias("p")).first()["p"]
    for one_task in (0, 1_000_000):
        got = exact_quantiles(df, ["v"], [0.25, 0.5, 0.75], one_task_rows=one_task)
        assert [r["value"] for r in got.orderBy("prob").collect()] == plain


def test_repeated_metrics_of_a_map(spark):
    rows = [("t", "f", "min", 1.0, 1), ("t", "f", "min", 3.0, 2), ("t", "f", "min", 2.0, 3), ("t", "", "nrows", 5.0, 1)]
    df = spark.createDataFrame(rows, "k string, field string, stat string, value double, at int")
    assert profile.metrics_long_to_map(df.drop("at"), ["k"]).first()["metrics"] == {"f.min": 3.0, "nrows": 5.0}
    assert profile.metrics_long_to_map(df, ["k"], order="at").first()["metrics"] == {"f.min": 2.0, "nrows": 5.0}


def test_load_from_uris_with_blanks(spark):
    root = work_dir(spark, "uris")
    uris = [f"{root}/a b", f"{root}/c+d", f"{root}/e%20f"]
    for i, uri in enumerate(uris):
        spark.range(i + 1).withColumn("n", F.lit("x")).write.parquet(uri)
    schema = spark.read.parquet(uris[0]).schema
    _, sources = files.load_from_uris(spark, uris, work_dir(spark, "loaded"), schema, "parquet")
    assert {r["location"]: r["nrows"] for r in sources.collect()} == dict(zip(uris, (1, 2, 3)))
    edges = files.load_edges(sources, schema, "load")
    assert {r["location"]: r["input_ord"] for r in edges.collect()} == {u: i for i, u in enumerate(sorted(uris))}
    made = lineage.lineages(edges.drop("location"), spark.createDataFrame([("load", "s" * 32)], "lineage_key string, schema_id string"))
    assert made.first()["n_edges"] == 6


def test_a_table_rebuilt_from_itself(spark):
    name = "rebuilt_from_itself"
    rows = spark.range(5).select("id", F.expr("timestamp_seconds(id * 86400)").alias("ts"))
    try:
        tables.ctas_partitioned(rows, name, "ts")
        again = tables.ctas_partitioned(spark.table(name).where("id > 0").drop("d"), name, "ts")
        assert again.count() == 4
        with pytest.raises(Exception):
            tables.ctas_partitioned(spark.table(name).withColumn("id", F.raise_error(F.lit("no"))), name, "ts").count()
        assert spark.table(name).count() == 4
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_progress_counts_every_batch(spark):
    source, n = work_dir(spark, "many-batches"), 110
    spark.range(n).select(F.lit("{}").alias("data"), "id").repartition(n, "id").write.option("maxRecordsPerFile", 1).parquet(source)
    progress = run.Progress("many-batches")
    stream = spark.readStream.schema("data string, id long").option("maxFilesPerTrigger", 1).parquet(source)
    out = work_dir(spark, "many-batches-out")
    run.run_with_progress(
        lambda: run.with_progress(stream, progress.name).writeStream.format("noop").option("checkpointLocation", out).trigger(availableNow=True).start(),
        spark, progress)
    assert progress.records == n and len(progress.lines) >= n  # a last batch may be empty
    assert progress.lines[-1] == f"Records read: {n} ({2 * n} bytes)"
