from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from lodewatch.operators import entities, lineage

FIELD = "pos int, name string"


def frames(spark, outputs, inputs, schemas):
    """outputs: {lineage: [names]}, inputs: [(lineage, ord, schema)], schemas: {schema: [names]}."""
    out = [(k, i, n) for k, names in outputs.items() for i, n in enumerate(names)]
    fields = [(k, i, n) for k, names in schemas.items() for i, n in enumerate(names)]
    return (
        spark.createDataFrame(out, f"lineage_key string, {FIELD}"),
        spark.createDataFrame(inputs, "lineage_key string, input_ord int, input_schema_id string"),
        spark.createDataFrame(fields, f"schema_id string, {FIELD}"),
    )


def mapping(edges):
    """{(lineage, input): {output: [inputs]}} with outputs in their order."""
    found = {}
    for r in sorted(edges.collect(), key=lambda r: (r["lineage_key"], r["input_ord"], r["edge_ord"])):
        found.setdefault((r["lineage_key"], r["input_ord"]), {})[r["output_field"]] = list(r["input_fields"])
    return found


CASE = (
    {"report": ["Open", "Adj Close", "Intraday_Delta"]},
    [("report", 0, "assets"), ("report", 1, "other"), ("report", 2, "empty")],
    {"assets": ["Date", "Adj Close", "Open"], "other": ["a", "b"]},
)


def test_direct(spark):
    edges = mapping(lineage.lineage_direct(*frames(spark, *CASE)))
    assert edges == {("report", 0): {"Adj Close": ["Adj Close"], "Open": ["Open"]}}
    assert list(edges[("report", 0)]) == ["Adj Close", "Open"]


def test_full_and_direct_or_full(spark):
    full = mapping(lineage.lineage_full(*frames(spark, *CASE)))
    assert full[("report", 1)] == {o: ["a", "b"] for o in CASE[0]["report"]}
    either = mapping(lineage.lineage_direct_or_full(*frames(spark, *CASE)))
    assert either[("report", 0)] == {"Adj Close": ["Adj Close"], "Open": ["Open"]}
    assert either[("report", 1)] == full[("report", 1)]
    assert ("report", 2) not in either


def test_extra_overrides_in_place_and_appends(spark):
    direct = lineage.lineage_direct(*frames(spark, *CASE))
    extra = spark.createDataFrame(
        [
            ("report", 0, "assets", 0, "new 1", ["x"]),
            ("report", 0, "assets", 1, "Adj Close", ["Open", "Date"]),
            ("report", 0, "assets", 2, "new 2", ["y"]),
            ("report", 1, "other", 0, "only", ["a"]),
        ],
        "lineage_key string, input_ord int, input_schema_id string, edge_ord int, output_field string, input_fields array<string>",
    )
    edges = mapping(lineage.lineage_extra(direct, extra))
    assert list(edges[("report", 0)].items()) == [
        ("Adj Close", ["Open", "Date"]), ("Open", ["Open"]), ("new 1", ["x"]), ("new 2", ["y"]),
    ]
    assert edges[("report", 1)] == {"only": ["a"]}


def random_case(seed):
    rng = random.Random(seed)
    names = [f"f{i}" for i in range(12)]
    schemas = {f"s{i}": rng.sample(names, rng.randint(1, 6)) for i in range(60)}
    outputs = {f"l{i}": rng.sample(names, rng.randint(1, 6)) for i in range(6)}
    # One lineage holds most of the inputs, and one schema is read by all lineages.
    inputs = [("l0", i, f"s{i}") for i in range(50)] + [(f"l{i}", 0, "s7") for i in range(1, 5)]
    return outputs, inputs, schemas


@pytest.mark.parametrize("seed", [1, 2])
def test_edges_and_ids_against_brute_force(spark, seed):
    outputs, inputs, schemas = random_case(seed)
    parts = frames(spark, outputs, inputs, schemas)
    direct = lineage.lineage_direct(*parts)
    expected = {}
    for key, order, schema in inputs:
        same = {n: [n] for n in schemas[schema] if n in outputs[key]}
        if same:
            expected[(key, order)] = same
    assert mapping(direct) == expected

    pairs = {(r["lineage_key"], r["input_ord"], r["field"]) for r in lineage.field_match_join(*parts).collect()}
    assert pairs == {(k, o, n) for (k, o), m in expected.items() for n in m}
    assert pairs <= {(r["lineage_key"], r["input_ord"], r["output_field"]) for r in lineage.lineage_full(*parts).collect()}

    counts = {(r["lineage_key"], r["input_ord"]): r["n_pairs"] for r in lineage.field_cross_counts(*parts).collect()}
    assert counts == {(k, o): len(outputs[k]) * len(schemas[s]) for k, o, s in inputs}

    heads = spark.createDataFrame([(k, f"id of {k}") for k in outputs], "lineage_key string, schema_id string")
    got = {r["lineage_key"]: (r["id"], r["n_edges"]) for r in lineage.lineages(direct, heads).collect()}
    for key in outputs:
        texts = [f"{o}:{'-'.join(i)}" for (k, _), m in sorted(expected.items()) if k == key for o, i in m.items()]
        assert got[key] == (hashlib.md5((f"id of {key}" + ",".join(texts)).encode()).hexdigest(), len(texts))

    # factors give the same ids as their edges, and a full mapping has one row per input
    for kind in (lineage.direct_factors, lineage.full_factors, lineage.direct_or_full_factors):
        factors = kind(*parts)
        ids = lambda mapping: {r["lineage_key"]: (r["id"], r["n_edges"]) for r in lineage.lineages(mapping, heads).collect()}
        assert ids(factors) == ids(lineage.expand(factors))
    full = lineage.full_factors(*parts).collect()
    assert sorted((r["lineage_key"], r["input_ord"], tuple(r["outputs"]), tuple(r["inputs"])) for r in full) == sorted(
        (k, o, tuple(outputs[k]), tuple(schemas[s])) for k, o, s in inputs if outputs[k] and schemas[s])


def test_digest_needs_small_batches_only(spark):
    """The running digest goes on over Arrow batches, whatever their size."""
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        test_edges_and_ids_against_brute_force(spark, 3)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def run_meta(spark):
    return spark.createDataFrame(
        [("r1", "app", "git", "v1", False, "ann", "bob", "t1"), ("r2", "app", "git", "v1", True, "ann", "bob", "t2")],
        "run_id string, app string, repo string, version string, is_dirty boolean, author string, user string, start string",
    )


def md5(text):
    return hashlib.md5(text.encode()).hexdigest()


def test_run_entities(spark, rows):
    tables = entities.app_run_rows(run_meta(spark))
    app, ann, bob = md5("app"), md5("ann"), md5("bob")
    repo = md5(f"git,{app}")
    clean, dirty = md5(f"v1,{ann},{repo}"), md5(f"v1 (dirty),{bob},{repo}")
    assert rows(tables["application"]) == [(app, "app")]
    assert rows(tables["app_user"]) == sorted([(ann, "ann"), (bob, "bob")], key=repr)
    assert rows(tables["repository"]) == [(repo, "git", app)]
    assert rows(tables["app_version"]) == sorted([(clean, "v1", ann, repo), (dirty, "v1 (dirty)", bob, repo)], key=repr)
    execution = {r["run_id"]: r["app_execution"] for r in tables["run"].collect()}
    assert execution == {"r1": md5(f"{clean},{bob}"), "r2": md5(f"{dirty},{bob}")}


def test_facts_orphans_and_references(spark):
    tables = entities.app_run_rows(run_meta(spark))
    lineage_rows = spark.createDataFrame([("L1", "r1"), ("L2", "r2")], "id string, lineage_key string")
    runs = tables["run"].select(F.col("run_id").alias("lineage_key"), "app_execution", F.col("start").alias("start_time"))
    executions = lineage.lineage_executions(lineage_rows, runs)
    inputs = spark.createDataFrame([("L1", "in"), ("L2", "in")], "lineage_id string, input_schema_id string")
    outputs = spark.createDataFrame([("L1", "out1"), ("L2", "out2")], "lineage_id string, schema_id string")
    metrics = spark.createDataFrame([("in", "x", "min", 1.0), ("out1", "y", "max", 2.0)], "schema_id string, field string, stat string, value double")
    facts = entities.metrics_rows(metrics, entities.metric_uses(executions, inputs, outputs))
    # The input was profiled once and is attached to both runs.
    assert facts.where("schema_id = 'in'").count() == 2 and facts.count() == 3
    for r in facts.collect():
        assert r["metrics_id"] == md5(f"{r['schema_id']},{r['lineage_execution_id']}")

    assert entities.orphan_metrics(facts, executions).count() == 0
    only_one = executions.where("start_time = 't1'")
    assert [r["schema_id"] for r in entities.orphan_metrics(facts, only_one).collect()] == ["in"]

    schema = spark.createDataFrame([("in", "d1"), ("out1", "d2")], "schema_id string, data_source_id string")
    sources = spark.createDataFrame([("d1", "a", "csv"), ("d2", "b", "csv")], "id string, location string, format string")
    wide = entities.resolve_refs(facts, schema, sources, entities.resolve_executions(executions, tables))
    assert wide.count() == 3
    row = wide.where("location = 'b'").first()
    assert (row["version"], row["author_name"], row["user_name"], row["application_name"]) == ("v1", "ann", "bob", "app")


def test_schemas_and_fields(spark, rows):
    fields = spark.createDataFrame([("d", "b", "int"), ("d", "a", "string"), ("e", "a", "string")], "data_source_id string, name string, dtype string")
    got = {r["data_source_id"]: r["schema_id"] for r in entities.schemas(fields).collect()}
    assert got == {"d": md5("a-string,b-int,d"), "e": md5("a-string,e")}
    df = spark.createDataFrame([], "Symbol string, Open double, n int")
    named = entities.schema_fields(df, {"Symbol": "category"}, "pandas")
    assert rows(named, "pos", "name", "dtype") == [(0, "Symbol", "category"), (1, "Open", "float64"), (2, "n", "int64")]
    _, schema_id, _ = entities.frame_ids(df, "loc", "csv", dtype_style="pandas")
    assert schema_id == md5("Open-float64,Symbol-object,n-int64," + md5("loc,csv"))
    located = spark.createDataFrame([("data/a.csv", "10.0.0.1")], "path string, server string")
    assert entities.data_sources_on_servers(located, F.col("path"), F.col("server")).first()["id"] == md5("data/a.csv," + md5("10.0.0.1"))
    meta = spark.createDataFrame([("a", '{"sensitive": true}'), ("b", "{}"), ("c", None)], "name string, meta string")
    assert rows(entities.sensitive_fields(meta)) == [("a",)]
    versions = spark.createDataFrame([("d", "1"), ("d", "2"), ("d", "2"), ("e", "1")], "data_source_id string, schema_id string")
    assert rows(entities.schema_changes(versions)) == [("d", 2), ("e", 1)]
    names = spark.createDataFrame([("a.b.c",), ("a.b.c__dbt_tmp",)], "name string")
    assert rows(entities.unify_sources(names)) == [("a.b.c",)]
