"""The log of upserted parts: merging, replays, cut-off merges."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from lodewatch.streaming import run
from lodewatch.streaming.state import BATCH, Part, PartLog

SCHEMA = f"k string, v bigint, {BATCH} bigint"


def batch_rows(spark, batch, n=3):
    """Batch b changes keys b, b+1, ... modulo 50."""
    rows = [(f"k{(batch + i) % 50}", batch * 10 + i, batch) for i in range(n)]
    return spark.createDataFrame(rows, SCHEMA).coalesce(1)


def expected(batches, n=3):
    now = {}
    for b in range(batches):
        now.update({f"k{(b + i) % 50}": b * 10 + i for i in range(n)})
    return now


def current(spark, path):
    schema = spark.createDataFrame([], "k string, v bigint").schema
    return {r["k"]: r["v"] for r in run.current_rows(spark, path, ["k"], schema).collect()}


def data_files(log):
    return sum(f.endswith(".parquet") for p in log.live() for f in os.listdir(f"{log.path}/{p.folder}"))


def test_many_batches_stay_few_files(spark, tmp_path):
    log = PartLog(spark, f"{tmp_path}/log")
    for b in range(90):
        log.merge(["k"], before=b, fanout=4)
        log.write(batch_rows(spark, b), Part(0, b, b))
    assert current(spark, log.path) == expected(90)
    assert len(log.live()) <= 4 * 4 and data_files(log) <= 20 and len(log.finished()) <= 24
    assert {p.level for p in log.live()} == {0, 1, 2, 3}


def test_replays_and_cut_off_merges_change_nothing(spark, tmp_path):
    log = PartLog(spark, f"{tmp_path}/log")
    for b in range(9):
        log.write(batch_rows(spark, b), Part(0, b, b))
    log.write(batch_rows(spark, 8), Part(0, 8, 8))  # the running batch comes again
    half = Part(1, 0, 7)
    batch_rows(spark, 3).write.parquet(f"{log.path}/{half.folder}")  # a merge that never finished
    assert half not in log.finished() and current(spark, log.path) == expected(9)
    assert log.merge(["k"], before=8) == 1 and log.merge(["k"], before=8) == 0
    assert log.live() == [Part(0, 8, 8), half] and current(spark, log.path) == expected(9)
    log.write(batch_rows(spark, 3), Part(0, 3, 3))  # all batches come again, without their checkpoint
    assert current(spark, log.path) == expected(9)


def test_the_running_batch_is_never_merged(spark, tmp_path):
    log = PartLog(spark, f"{tmp_path}/log")
    for b in range(4):
        log.write(batch_rows(spark, b), Part(0, b, b))
    assert log.merge(["k"], before=3, fanout=4) == 0
    assert log.merge(["k"], before=4, fanout=4) == 1


@pytest.mark.parametrize("fanout", [2, 3])
def test_a_stream_of_many_files(spark, tmp_path, fanout):
    spark.range(600).select((F.col("id") % 7).cast("string").alias("k"), F.col("id").alias("v")).repartition(10).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("k string, v bigint").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    sums = run.run_to_end(stream.groupBy("k").agg(F.sum("v").alias("v")), ["k"], fanout=fanout)
    assert {r["k"]: r["v"] for r in sums.collect()} == {str(i): sum(range(i, 600, 7)) for i in range(7)}
    assert any("part-1-" in f or "part-2-" in f or "part-3-" in f for f in sums.inputFiles())


def test_an_empty_log_has_no_rows(spark, tmp_path):
    assert current(spark, f"{tmp_path}/none") == {}
