from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from lodewatch.sources import messages
from lodewatch.streaming import metrics, run

PAYLOADS = [
    {"k": 1, "name": "ann", "x": None},
    {"k": 2.5, "name": "😀é", "x": None, "flag": True},
    {"k": "three", "name": None, "list": [1], "obj": {"a": 1}},
    {"k": 123456789012345678901, "late": "z"},
    {},
]


def raw_messages(spark):
    rows = [("RECORD", "ns." if i % 2 else None, "s", i, json.dumps(p, ensure_ascii=False)) for i, p in enumerate(PAYLOADS * 3)]
    rows += [("STATE", None, "s", 99, '{"k": 7}'), ("RECORD", None, "s", 100, "[1, 2]"), ("RECORD", None, "s", 101, "not json")]
    return spark.createDataFrame(rows, messages.MESSAGE_SCHEMA)


@pytest.fixture(scope="module")
def stored_messages(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("messages") / "in")
    raw_messages(spark).repartition(6).write.parquet(path)
    return path


def batch(spark, path):
    return messages.keyed(spark.read.parquet(path))


def stream(spark, path):
    raw = messages.read_file_stream(spark, path, spark.read.parquet(path).schema, files_per_trigger=2)
    return messages.keyed(raw)


def declared(spark):
    catalog = [("s", "k", ["number"]), ("s", "name", ["string"]), ("ns.s", "k", ["integer", "null"]), ("ns.s", "late", ["string"])]
    return metrics.declared_types(spark.createDataFrame(catalog, "stream string, field string, types array<string>"))


OPERATORS = {
    "running": (metrics.field_running_metrics, ["stream", "field"]),
    "growth": (metrics.schema_growth, ["stream", "field"]),
    "kinds": (metrics.field_kinds, ["stream", "field"]),
    "count": (metrics.record_count, ["stream"]),
    "sync": (metrics.sync_stats, ["stream"]),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_stream_equals_batch(spark, stored_messages, rows, name):
    """Several micro-batches give what one batch over all messages gives."""
    operator, keys = OPERATORS[name]
    by_batch = operator(batch(spark, stored_messages))
    by_stream = run.run_to_end(operator(stream(spark, stored_messages)), keys)
    assert rows(by_stream) == rows(by_batch.select(*by_stream.columns))


def brute_force():
    counts, sums, first, kinds = {}, {}, {}, {}
    for i, p in enumerate(PAYLOADS * 3):
        key = ("ns." if i % 2 else "") + "s"
        for field, value in p.items():
            is_number = isinstance(value, (int, float)) and not isinstance(value, bool)
            if is_number or isinstance(value, str):
                at = (key, field)
                counts[at] = counts.get(at, 0) + 1
                sums[at] = sums.get(at, 0) + (float(value) if is_number else len(value.encode("utf-16-be")) // 2)
                kind = "number" if is_number else "string"
                first.setdefault(at, (kind, i))
                kinds.setdefault(at, set()).add(kind)
    return counts, sums, first, kinds


def test_metrics_against_brute_force(spark, stored_messages):
    counts, sums, first, kinds = brute_force()
    got = {(r["stream"], r["field"]): r for r in metrics.field_running_metrics(batch(spark, stored_messages)).collect()}
    assert {k: r["count"] for k, r in got.items()} == counts
    assert {k: r["sum"] for k, r in got.items()} == pytest.approx(sums)
    grown = {(r["stream"], r["field"]): r for r in metrics.schema_growth(batch(spark, stored_messages)).collect()}
    assert {k: (r["dtype"], r["since"]) for k, r in grown.items()} == first
    assert {k for k, r in grown.items() if r["mixed"]} == {k for k, v in kinds.items() if len(v) > 1}
    null_only = metrics.all_null_fields(metrics.field_kinds(batch(spark, stored_messages)))
    assert {(r["stream"], r["field"], r["dtype"]) for r in null_only.collect()} == {("s", "x", "unknown"), ("ns.s", "x", "unknown")}


def test_first_kind_over_partitions_out_of_order(spark):
    """Offsets of three partitions overlap; the earliest time decides, then partition and offset."""
    rows = [("s", 5, 0, 0, '{"k": "late"}'), ("s", 2, 2, 9, '{"k": 1}'), ("s", 2, 1, 10, '{"k": "first"}'), ("s", 3, 0, 1, '{"k": 2}')]
    columns = "stream string, time bigint, partition int, offset bigint, data string"
    for sent in (rows, rows[::-1]):
        got = metrics.schema_growth(spark.createDataFrame(sent, columns), ["time", "partition", "offset"]).first()
        assert tuple(got) == ("s", "k", "string", 2, 1, 10, True)


def test_states_of_parts_unite_to_the_state_of_all(spark):
    sent = spark.range(3000).selectExpr("'s' as stream", "concat('{\"k\": \"v', id % 1000, '\"}') as data")
    halves = [metrics.field_sketches(sent.where(f"hash(data) % 2 {test} 0")) for test in ("=", "<>")]
    united = metrics.united_sketches(halves[0].unionByName(halves[1]))
    assert metrics.sketch_levels(united).first()["levels"] == metrics.sketch_levels(metrics.united_sketches(metrics.field_sketches(sent))).first()["levels"]
    assert abs(metrics.field_distinct(sent).first()["levels"] - 1000) < 70


def test_violations(spark, stored_messages, rows):
    found = {r["stream"]: (r["records"], r["messages"]) for r in metrics.schema_violations(batch(spark, stored_messages), declared(spark)).collect()}
    texts = {
        "s": {"$.k: string found, number expected", "$.name: null found, string expected", "$: object expected"},
        "ns.s": {"$.k: number found, integer or null expected", "$.k: string found, integer or null expected"},
    }
    broken = {"s": 2, "ns.s": 0}
    for i, p in enumerate(PAYLOADS * 3):
        key = ("ns." if i % 2 else "") + "s"
        bad = isinstance(p.get("k"), str) or ("name" in p and p["name"] is None and key == "s") or (isinstance(p.get("k"), float) and key == "ns.s")
        broken[key] += bad
    assert found == {k: (broken[k], sorted(texts[k])) for k in texts}
    streamed = run.run_to_end(metrics.schema_violations(stream(spark, stored_messages), declared(spark)), ["stream"])
    assert {r["stream"]: (r["records"], r["messages"]) for r in streamed.collect()} == found


def test_batches_run_again_are_not_counted_twice(spark, stored_messages, tmp_path, rows):
    """Without its checkpoint a run repeats all batches; the result table stays the same."""
    operator, keys = OPERATORS["running"]
    for attempt in ("first", "again"):
        query = run.start_upsert(operator(stream(spark, stored_messages)), f"{tmp_path}/changes", f"{tmp_path}/{attempt}")
        query.awaitTermination()
    current = run.current_rows(spark, f"{tmp_path}/changes", keys, operator(batch(spark, stored_messages)).schema)
    assert rows(current) == rows(operator(batch(spark, stored_messages)).select(*current.columns))


def test_sync_totals_and_progress(spark, stored_messages, tmp_path):
    stats = metrics.sync_stats(batch(spark, stored_messages))
    total = metrics.sync_totals(stats).first()
    size = sum(len(json.dumps(p, ensure_ascii=False).encode()) for p in PAYLOADS * 3) + len("[1, 2]") + len("not json")
    assert tuple(total) == (17, size, 17)
    assert metrics.sync_totals(metrics.sync_stats(batch(spark, stored_messages), completed=False)).first()["records_committed"] is None

    listener = run.Progress("seen")
    spark.streams.addListener(listener)
    try:
        query = run.start_upsert(run.with_progress(stream(spark, stored_messages), "seen"), f"{tmp_path}/c", f"{tmp_path}/k")
        query.awaitTermination()
        spark._jsc.sc().listenerBus().waitUntilEmpty()
        for _ in range(50):
            if listener.records == 17:
                break
            import time

            time.sleep(0.1)
    finally:
        spark.streams.removeListener(listener)
    assert (listener.records, listener.size) == (17, size)
    assert listener.lines[-1] == f"Records read: 17 ({size} bytes)"


def test_finish(spark, stored_messages):
    read = metrics.field_running_metrics(batch(spark, stored_messages))
    grown = metrics.schema_growth(batch(spark, stored_messages)).selectExpr("stream", "field as name", "dtype")
    source = spark.createDataFrame([("s", "k", "number"), ("s", "gone", "string"), ("ns.s", "nothing", "string")], "stream string, name string, dtype string")
    done = run.finish_sync(source, grown, read, read, "exec", "2024-01-01T00:00:00")
    assert {(r["lineage_key"], r["output_field"]) for r in done.edges.collect()} == {("s", "k")}
    assert {r["lineage_key"]: r["n_edges"] for r in done.lineage.collect()} == {"s": 1, "ns.s": 0}
    assert done.execution.count() == 2 and done.schemas.count() == 4
    assert done.metrics.count() == 2 * 2 * read.count()


def test_finish_of_one_state(spark):
    """Copied and read sides differ; payloads without fields are records as well."""
    sent = [("s", 1, '{"k": 1, "t": "ab"}', True), ("s", 2, '{"k": 2.5, "x": null}', False), ("s", 3, "[1]", True), ("s", 4, "no json", None), ("s", 5, '{"k": "late"}', True), ("r", 6, "{}", True)]
    df = spark.createDataFrame(sent, "stream string, offset bigint, data string, took boolean")
    state = metrics.sync_state(df, F.col("took"))
    got = {(r["stream"], r["field"]): r for r in state.collect()}
    assert tuple(got[("s", "k")])[2:] == (3, 7.5, 2, 5.0, "number", 3, 2)
    assert (got[("s", "t")]["count"], got[("s", "t")]["records"], got[("s", "x")]["count"]) == (1, 0, 0)
    declared = spark.createDataFrame([("s", "k", "number"), ("s", "x", "string")], "stream string, name string, dtype string")
    done = run.finish_state(state, declared, "exec", "2024-01-01T00:00:00")
    sides = {r["schema_id"]: r["side"] for r in done.schemas.collect()}
    found = {(sides[r["schema_id"]], r["field"], r["stat"]): r["value"] for r in done.metrics.collect()}
    assert found[("source", "", "records")] == 5.0 and found[("destination", "", "records")] == 3.0
    assert (found[("source", "k", "count")], found[("destination", "k", "count")], found[("destination", "k", "sum")]) == (3.0, 2.0, 5.0)
    assert {r["output_field"] for r in done.edges.collect()} == {"k"}
