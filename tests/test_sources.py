from __future__ import annotations

import datetime
import os

import pytest
from pyspark.sql import functions as F

from lodewatch.operators import transform
from lodewatch.plans.observe import ObservedFrame, ObservedSession
from lodewatch.session import work_dir
from lodewatch.sources import files, messages, observations, tables

ASSETS = "Date date, Symbol string, Open double, `Adj Close` double, Volume bigint"


def assets(spark, symbol, opens):
    day = datetime.date(2022, 1, 3)
    return spark.createDataFrame([(day, symbol, o, o + 0.5, 100) for o in opens], ASSETS)


def test_work_dir_is_below_the_checkpoint_folder(spark):
    root = spark.sparkContext._jsc.sc().getCheckpointDir()
    path = work_dir(spark, "x")
    root = spark.sparkContext._jsc.sc().getCheckpointDir()
    assert path.startswith(os.path.dirname(root.get().removeprefix("file:"))) and path != work_dir(spark, "x")


def test_csv_round_trip(spark, tmp_path, rows):
    df = assets(spark, "APCX", [14.725, 1.0 / 3]).withColumn("Date", F.col("Date").cast("string"))
    files.write_csv(df, f"{tmp_path}/a")
    back = files.scan_csv(spark, f"{tmp_path}/a", df.schema, parse_dates=["Date"], categories=["Symbol"])
    assert back.schema["Date"].dataType.simpleString() == "date"
    assert rows(back.withColumn("Date", F.col("Date").cast("string"))) == rows(df)


def test_csv_by_period_reads_only_the_named_folders(spark, tmp_path, rows):
    for year, month in ((2022, 1), (2022, 12), (2023, 1)):
        df = spark.createDataFrame([(year * 100 + month,)], "x int")
        files.write_csv(df, f"{tmp_path}/1999/77/{year}/{month}/Apple.csv")
    template = f"{tmp_path}/1999/77/{{year}}/{{month}}/Apple.csv"
    every = files.scan_csv_by_period(spark, template, "x int")
    assert rows(every) == [(202201, 2022, 1), (202212, 2022, 12), (202301, 2023, 1)]
    one = files.scan_csv_by_period(spark, template, "x int", year=2022, month=12)
    assert rows(one) == [(202212, 2022, 12)] and all("/2022/12/" in f for f in one.inputFiles())


def test_csv_to_parquet(spark, tmp_path):
    with pytest.raises(ValueError, match="only CSV"):
        files.csv_to_parquet(spark, f"{tmp_path}/yellow.json", f"{tmp_path}/out", "x int")
    df = spark.createDataFrame([("2021-01-01 10:00:00", 1)], "lpep_pickup_datetime string, n int")
    files.write_csv(df, f"{tmp_path}/green_ingestion.csv")
    out = files.csv_to_parquet(spark, f"{tmp_path}/green_ingestion.csv", f"{tmp_path}/green.parquet", df.schema)
    assert out.first()["lpep_pickup_datetime"] == datetime.datetime(2021, 1, 1, 10)


def test_row_index_with_hot_key(spark):
    """Two thirds of the rows share a key; the index has no gaps and follows the key."""
    df = spark.range(3000, numPartitions=5).select(F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("id")).alias("k"), "id")
    got = files.with_row_index(df, ["k"], "i").orderBy("i").collect()
    assert [r["i"] for r in got] == list(range(3000))
    assert [r["k"] for r in got] == sorted(r["k"] for r in got)
    assert len({r["id"] for r in got}) == 3000


def test_load_from_uris(spark, tmp_path):
    for name, n in (("part", 3), ("part2", 5), ("none", 0)):
        spark.range(n).write.parquet(f"{tmp_path}/{name}")
    uris = [f"{tmp_path}/{n}" for n in ("part", "part2", "none")]
    loaded, sources = files.load_from_uris(spark, uris, f"{tmp_path}/dst", spark.range(1).schema, "parquet")
    assert loaded.count() == 8 and loaded.columns == ["id"]
    assert {os.path.basename(r["location"]): r["nrows"] for r in sources.collect()} == {"part": 3, "part2": 5, "none": 0}
    edges = files.load_edges(sources, loaded.schema, "dst").collect()
    assert [(r["output_field"], r["input_fields"]) for r in edges] == [("id", ["id"])] * 3
    assert len({r["input_schema_id"] for r in edges}) == 3


def test_envelopes(spark, rows):
    raw = spark.createDataFrame(
        [('{"type": "RECORD", "record": {"stream": "s", "namespace": "n.", "data": {"k": 1, "x": null}}}', 1), ('{"type": "STATE"}', 2)],
        "value string, offset bigint",
    )
    kept = messages.keyed(messages.from_envelopes(raw))
    assert rows(kept) == [("n.s", 1, '{"k":1,"x":null}')]


def test_refused_envelopes_are_counted(spark, rows):
    texts = [
        '{"type": "RECORD", "record": {"stream": "s", "data": {"k": 1}}}', '{"type": "LOG"}', "no json", None, "[1, 2]", '"text"',
        '{"record": {"stream": "s", "data": {}}}', '{"type": "RECORD"}', '{"type": "RECORD", "record": {"data": {}}}', '{"type": "RECORD", "record": {"stream": "s"}}',
    ]
    raw = spark.createDataFrame([(t, i) for i, t in enumerate(texts)], "value string, offset bigint")
    judged = messages.judged_envelopes(raw)
    counts = {r["reason"]: r["n"] for r in messages.envelope_counts(judged).collect()}
    assert counts == {None: 2, messages.NO_JSON: 2, messages.NO_OBJECT: 2, messages.NO_TYPE: 1, messages.NO_STREAM: 2, messages.NO_DATA: 1}
    assert messages.kept_envelopes(judged).count() + messages.refused_envelopes(judged).count() == len(texts)
    assert {(r["offset"], r["value"]) for r in messages.refused_envelopes(judged).where("reason = 'no object'").collect()} == {(4, "[1, 2]"), (5, '"text"')}


def test_tagged_log_reads_each_entity_alone(spark, tmp_path):
    people = spark.createDataFrame([("u", "ann")], "id string, name string")
    apps = spark.createDataFrame([("a", "job")], "id string, name string")
    observations.write_tagged({"app_user": people, "application": apps}, f"{tmp_path}/log")
    observations.write_tagged({"app_user": people.selectExpr("'v' as id", "'bob' as name")}, f"{tmp_path}/log")
    back = observations.read_tagged(spark, f"{tmp_path}/log")
    assert {tuple(r) for r in back["app_user"].collect()} == {("u", "ann"), ("v", "bob")} and back["application"].first()["name"] == "job"
    assert all("entity=app_user" in f for f in back["app_user"].inputFiles()) and back["schema"].count() == 0
    with pytest.raises(ValueError, match="stray"):
        observations.write_tagged({"stray": people}, f"{tmp_path}/log")


def test_partitioned_table_is_pruned(spark, tmp_path):
    df = spark.range(100).select("id", (F.expr("timestamp_ntz'2024-01-01'") + F.expr("make_dt_interval(cast(id % 5 as int))")).alias("ts"))
    table = tables.ctas_partitioned(df, "pruned_test", "ts", f"{tmp_path}/t")
    days = tables.on_dates(table, "ts", "2024-01-02", "2024-01-04")
    assert days.count() == 40
    plan = days._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(d" in plan
    again = tables.ctas_partitioned(df.limit(1), "pruned_test", "ts", f"{tmp_path}/t2")
    assert again.count() == 1


def test_seed_load_and_schema(spark, tmp_path, rows):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "x int, y string")
    files.write_csv(df, f"{tmp_path}/seed")
    for expected in (2, 4):
        table, nrows = tables.seed_load(spark, f"{tmp_path}/seed", "seed_test", df.schema, f"{tmp_path}/tbl")
        assert (table.count(), nrows) == (expected, 2)
    assert rows(tables.table_schema(spark, "seed_test"), "pos", "name", "dtype") == [(0, "x", "int"), (1, "y", "string")]


def test_copy(spark, tmp_path):
    spark.range(10).write.parquet(f"{tmp_path}/a")
    assert files.copy_dataset(spark, f"{tmp_path}/a", f"{tmp_path}/b").count() == 10
    assert spark.read.parquet(f"{tmp_path}/a").count() == 10


def test_transform(spark, rows):
    a = spark.createDataFrame([(1, float("nan")), (2, None), (3, 5.0)], "n int, `x.y` double")
    assert rows(transform.filter_le(a, "x.y", 100), "n") == [(3,)]
    assert rows(transform.filter_conj(a, []), "n") == [(1,), (2,), (3,)]
    assert transform.project_by_position(a, 1).columns == ["x.y"]
    b = spark.createDataFrame([("z", 9)], "s string, n int")
    assert rows(transform.concat([a.where("n = 3"), b])) == [(3, 5.0, None), (9, None, "z")]
    with pytest.raises(ValueError, match="duplicate"):
        transform.concat([a, a.select("n", F.col("n"))])
    types = spark.range(1).select(transform.first_type(F.array(F.lit("string"), F.lit("null"))).alias("t"), transform.first_type(F.array().cast("array<string>")).alias("u"))
    assert tuple(types.first()) == ("string", None)


def test_first_query(spark, rows):
    payload = '{"queries": [{"colnames": ["a"], "data": [{"a": 1}, {"a": null}]}, {"colnames": ["b"], "data": []}]}'
    charts = spark.createDataFrame([(1, payload)], "chart_id int, payload string")
    first = messages.first_query_only(charts)
    assert first.first()["n_queries"] == 2
    assert rows(messages.records_to_table(first.select("chart_id", "data"), "data", "a: bigint")) == [(1, 1), (1, None)]


def session(spark, log, **options):
    return ObservedSession(spark, log, "assets.py", "git/assets", "v1", "ann", "bob", start=datetime.datetime(2022, 2, 1), **options)


def test_observed_job(spark, tmp_path, rows):
    """Two inputs, a union and two reports: everything is logged and reads back."""
    for symbol, opens in (("APCX", [14.725, 13.8, 2.0]), ("BZFD", [5.28, 1.5])):
        assets(spark, symbol, opens).write.parquet(f"{tmp_path}/{symbol}.parquet")
    run = session(spark, f"{tmp_path}/log")
    parts = [run.read(f"{tmp_path}/{s}.parquet") for s in ("APCX", "BZFD")]
    both = ObservedFrame.concat(parts)
    run.write(both, f"{tmp_path}/monthly.parquet")
    monthly = run.read(f"{tmp_path}/monthly.parquet")
    for symbol in ("APCX", "BZFD"):
        report = monthly.transform(lambda df: transform.derive_diff(transform.filter_eq(df, "Symbol", symbol), "Intraday_Delta", "Adj Close", "Open"))
        kept = report.transform(lambda df: transform.project(df, ["Open", "Adj Close", "Intraday_Delta"]))
        extra = {f"{tmp_path}/monthly.parquet": {"Intraday_Delta": ["Adj Close", "Open"]}}
        run.write(kept, f"{tmp_path}/report_{symbol}.csv", extra=extra, header=True)
    run.export_metrics()

    back = observations.read_observations(spark, f"{tmp_path}/log/entities")
    assert {r["name"] for r in back["application"].collect()} == {"assets.py"}
    assert {r["name"] for r in back["app_user"].collect()} == {"ann", "bob"}
    assert back["lineage_execution"].count() == 3 and back["app_execution"].count() == 1
    # The union read both inputs, each report the monthly table only, with the derived field.
    mappings = [r["input_schemas_mapping"] for r in back["lineage"].collect()]
    assert sorted(len(m) for m in mappings) == [1, 1, 2]
    report = next(m for m in mappings if "Intraday_Delta" in m[0]["mapping"])
    assert report[0]["mapping"] == {"Open": ["Open"], "Adj Close": ["Adj Close"], "Intraday_Delta": ["Adj Close", "Open"]}
    # Metrics: 2 inputs + 1 output, then 2 x (1 input + 1 output).
    assert back["metrics"].count() == 7
    counts = sorted(r["metrics"]["nrows"] for r in back["metrics"].select("metrics").collect())
    assert counts == [2, 2, 3, 3, 5, 5, 5]
    # Observed fields are those of the written frame.
    fields = {tuple(sorted(r["fields"])) for r in back["schema"].collect()}
    assert ("Adj Close", "Intraday_Delta", "Open") in fields


def test_written_frame_may_be_its_own_input(spark, tmp_path):
    assets(spark, "APCX", [1.0]).write.parquet(f"{tmp_path}/a.parquet")
    run = session(spark, f"{tmp_path}/log", is_dirty=True, profile_inputs=False)
    run.write(run.read(f"{tmp_path}/a.parquet"), f"{tmp_path}/b.parquet")
    back = observations.read_observations(spark, f"{tmp_path}/log/entities")
    assert back["app_version"].first()["version"] == "v1 (dirty)"
    assert len(back["lineage"].first()["input_schemas_mapping"][0]["mapping"]) == 5
    assert run.metrics().select("schema_id").distinct().count() == 1
