"""Registered queries: message streams, in batch and as streaming runs."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodewatch.functions.messages import explode_fields
from lodewatch.operators.profile import read_vs_copied
from lodewatch.plans.registry import query
from lodewatch.plans.universe import MESSAGE_COLUMNS, MESSAGES_SQL
from lodewatch.session import stored, work_dir
from lodewatch.sources import messages
from lodewatch.streaming import metrics, run

KEYS = ["stream", "field"]


def event_stream(u):
    events = messages.read_file_stream(u.spark, f"{u.sf_dir}/events.parquet", u.events.schema)
    return messages.keyed(u.messages(events))


def rounded(df):
    return df.withColumn("sum", F.round("sum", 2))


D11_SQL = f"WITH {MESSAGES_SQL} SELECT stream, field, count(*) AS count, round(sum(amount), 2) AS sum FROM amounts GROUP BY 1, 2"


@query("d11_field_running_metrics", D11_SQL)
def d11(u):
    return rounded(metrics.field_running_metrics(messages.keyed(u.messages())))


@query(
    "d11_field_running_metrics_texts",
    "SELECT role AS stream, 'turn' AS field, count(*) AS count, CAST(sum(turn) AS DOUBLE) AS sum FROM conversations GROUP BY 1 "
    "UNION ALL SELECT role, 'text', count(*), CAST(sum(length(text) + length(regexp_replace(text, '[^\\x{10000}-\\x{10FFFF}]', '', 'g'))) AS DOUBLE) "
    "FROM conversations GROUP BY 1",
)
def d11_texts(u):
    return rounded(metrics.field_running_metrics(u.chat_messages()))


@query(
    "d12_field_distinct",
    "SELECT role AS stream, 'text' AS field, count(DISTINCT text) AS exact, true AS near FROM conversations GROUP BY 1",
)
def d12(u):
    """Distinct texts by a sketch; `near` tells that it lies within four standard errors of the exact count."""
    turns, rsd = u.chat_messages(), 0.02
    sketch = metrics.field_distinct(turns)
    exact = u.conversations.groupBy(F.col("role").alias("stream")).agg(F.count_distinct("text").alias("exact"))
    near = F.abs(F.col("levels") - F.col("exact")) <= F.greatest(F.lit(2), 4 * rsd * F.col("exact"))
    return sketch.join(exact, "stream").select("stream", "field", "exact", near.alias("near"))


@query(
    "d12_distinct_states",
    "SELECT role AS stream, 'text' AS field, count(DISTINCT text) AS exact, true AS near, true AS as_whole FROM conversations GROUP BY 1",
)
def d12_states(u):
    """Stored states of four runs united: near the exact count, and the same as one state of everything."""
    runs = [metrics.field_sketches(u.chat_messages(u.conversations.where(F.col("conv_id") % 4 == i))) for i in range(4)]
    parts = stored(reduce(DataFrame.unionByName, runs), "distinct-states")
    united = metrics.sketch_levels(metrics.united_sketches(parts))
    whole = metrics.sketch_levels(metrics.united_sketches(metrics.field_sketches(u.chat_messages()))).withColumnRenamed("levels", "at_once")
    exact = u.conversations.groupBy(F.col("role").alias("stream")).agg(F.count_distinct("text").alias("exact"))
    near = F.abs(F.col("levels") - F.col("exact")) <= F.greatest(F.lit(2), 0.08 * F.col("exact"))
    joined = united.join(whole, KEYS).join(exact, "stream")
    return joined.select(*KEYS, "exact", near.alias("near"), (F.col("levels") == F.col("at_once")).alias("as_whole"))


@query(
    "d13_read_vs_copied",
    f"""WITH {MESSAGES_SQL},
kept AS (SELECT "offset" FROM keyed JOIN events ON "offset" = event_id WHERE value >= 50),
r AS (SELECT stream, field, CAST(count(*) AS DOUBLE) AS count, sum(amount) AS sum FROM amounts GROUP BY 1, 2),
c AS (SELECT stream, field, CAST(count(*) AS DOUBLE) AS count, sum(amount) AS sum FROM amounts WHERE "offset" IN (SELECT "offset" FROM kept) GROUP BY 1, 2),
rl AS (SELECT stream, field, stat, value AS read FROM r UNPIVOT (value FOR stat IN (count, sum))),
cl AS (SELECT stream, field, stat, value AS copied FROM c UNPIVOT (value FOR stat IN (count, sum)))
SELECT stream, field, stat, round(read, 2) AS read, round(copied, 2) AS copied, round(coalesce(copied, 0) - coalesce(read, 0), 2) AS delta
FROM rl FULL JOIN cl USING (stream, field, stat)""",
)
def d13(u):
    def long(df):
        wide = metrics.field_running_metrics(df).withColumn("count", F.col("count").cast("double"))
        return wide.unpivot(KEYS, ["count", "sum"], "stat", "value")

    read = messages.keyed(u.messages())
    copied = messages.keyed(u.messages(u.events.where("value >= 50")))
    both = read_vs_copied(long(read), long(copied), [*KEYS, "stat"])
    return both.select(*KEYS, "stat", *[F.round(c, 2).alias(c) for c in ("read", "copied", "delta")])


@query("g9_json_fields", f'WITH {MESSAGES_SQL} SELECT stream, "offset", field FROM fields')
def g9(u):
    return explode_fields(messages.keyed(u.messages())).select("stream", "offset", "field")


@query("g10_json_kind", f"WITH {MESSAGES_SQL} SELECT stream, field, kind, count(*) AS n FROM fields GROUP BY 1, 2, 3")
def g10(u):
    return explode_fields(messages.keyed(u.messages())).groupBy("stream", "field", "kind").agg(F.count("*").alias("n"))


@query("j1_stream_field_metrics", D11_SQL)
def j1(u):
    return rounded(run.run_to_end(metrics.field_running_metrics(event_stream(u)), KEYS))


@query("j1_stream_generations", D11_SQL)
def j1_generations(u):
    """The same from twelve files, one a micro-batch, whose changed rows are merged as they come."""
    events = stored(u.events.repartition(12), "event-files")
    files = messages.read_file_stream(u.spark, events.inputFiles()[0].rsplit("/", 1)[0], u.events.schema, files_per_trigger=1)
    return rounded(run.run_to_end(metrics.field_running_metrics(messages.keyed(u.messages(files))), KEYS, fanout=3))


SCHEMA_SQL = f"""WITH {MESSAGES_SQL}
SELECT stream, field, arg_min(kind, "offset") AS dtype, min("offset") AS since,
  count(*) FILTER (kind = 'number') > 0 AND count(*) FILTER (kind = 'string') > 0 AS mixed
FROM amounts GROUP BY 1, 2"""


@query("j2_stream_schema_growth", SCHEMA_SQL)
def j2(u):
    return run.run_to_end(metrics.schema_growth(event_stream(u)), KEYS)


@query("j2_schema_growth_batch", SCHEMA_SQL)
def j2_batch(u):
    return metrics.schema_growth(messages.keyed(u.messages()))


PARTITIONS_SQL = f"""WITH {MESSAGES_SQL},
placed AS (SELECT a.stream, a.field, a.kind, {{'time': epoch_ms(e.ts) // 3600000, 'part': "offset" % 3, 'off': "offset" // 3}} AS place
  FROM amounts a JOIN events e ON "offset" = event_id)
SELECT stream, field, arg_min(kind, place) AS dtype, min(place).time AS since_time, min(place).part AS since_partition, min(place).off AS since_offset,
  count(*) FILTER (kind = 'number') > 0 AND count(*) FILTER (kind = 'string') > 0 AS mixed
FROM placed GROUP BY 1, 2"""
PLACE = ["time", "partition", "offset"]


def partitioned_messages(u, events=None):
    """Messages of a topic of three partitions, each with its own offsets; `time` is that of their hour."""
    rows = u.events if events is None else events
    sent = messages.records_only(rows.selectExpr(*MESSAGE_COLUMNS, "unix_date(CAST(ts AS DATE)) * 24L + hour(ts) AS time"))
    return sent.select(
        messages.stream_key("namespace", "stream").alias("stream"), "time", (F.col("offset") % 3).alias("partition"),
        F.floor(F.col("offset") / 3).alias("offset"), "data",
    )


@query("j2_schema_growth_partitions", PARTITIONS_SQL)
def j2_partitions(u):
    """First kinds over three partitions whose messages come in any order."""
    files = messages.read_file_stream(u.spark, f"{u.sf_dir}/events.parquet", u.events.schema)
    return run.run_to_end(metrics.schema_growth(partitioned_messages(u, files), PLACE), KEYS)


@query("j3_stream_record_count", f"WITH {MESSAGES_SQL} SELECT stream, count(*) AS count FROM keyed GROUP BY 1")
def j3(u):
    return run.run_to_end(metrics.record_count(event_stream(u)), ["stream"])


@query(
    "j4_stream_all_null_fields",
    f"WITH {MESSAGES_SQL} SELECT stream, field, 'unknown' AS dtype FROM fields GROUP BY 1, 2 HAVING count(*) FILTER (kind <> 'null') = 0",
)
def j4(u):
    return metrics.all_null_fields(run.run_to_end(metrics.field_kinds(event_stream(u)), KEYS))


# The declared types are k: number, user: integer|null, value: integer, note: string|null, ghost: string.
VIOLATIONS_SQL = f"""WITH {MESSAGES_SQL},
typed AS (
  SELECT stream, "offset", field, CASE json_type(v) WHEN 'VARCHAR' THEN 'string' WHEN 'UBIGINT' THEN 'integer' WHEN 'BIGINT' THEN 'integer'
    WHEN 'DOUBLE' THEN CASE WHEN CAST(v AS DOUBLE) = floor(CAST(v AS DOUBLE)) THEN 'integer' ELSE 'number' END
    WHEN 'BOOLEAN' THEN 'boolean' WHEN 'NULL' THEN 'null' WHEN 'ARRAY' THEN 'array' ELSE 'object' END AS t
  FROM fields),
broken AS (
  SELECT stream, "offset", '$.' || field || ': ' || t || ' found, ' || CASE field WHEN 'value' THEN 'integer' WHEN 'note' THEN 'string or null'
    WHEN 'ghost' THEN 'string' WHEN 'user' THEN 'integer or null' ELSE 'number' END || ' expected' AS text
  FROM typed WHERE (field = 'k' AND t NOT IN ('number', 'integer')) OR (field = 'user' AND t NOT IN ('integer', 'null'))
    OR (field = 'value' AND t <> 'integer') OR (field = 'note' AND t NOT IN ('string', 'null')) OR (field = 'ghost' AND t <> 'string'))
SELECT stream, count(DISTINCT "offset") AS records, string_agg(DISTINCT text, '; ' ORDER BY text) AS messages FROM broken GROUP BY 1"""


def _declared(u):
    return metrics.declared_types(u.declared())


@query("j5_stream_schema_violations", VIOLATIONS_SQL)
def j5(u):
    found = run.run_to_end(metrics.schema_violations(event_stream(u), _declared(u)), ["stream"])
    return found.withColumn("messages", F.array_join("messages", "; "))


@query("j5_schema_violations_batch", VIOLATIONS_SQL)
def j5_batch(u):
    found = metrics.schema_violations(messages.keyed(u.messages()), _declared(u))
    return found.withColumn("messages", F.array_join("messages", "; "))


STATS_SQL = (
    f"WITH {MESSAGES_SQL}, s AS (SELECT stream, count(*) AS records_emitted, CAST(sum(octet_length(encode(data))) AS BIGINT) AS bytes_emitted, "
    "count(*) AS records_committed FROM keyed GROUP BY 1) SELECT * FROM s UNION ALL "
    "SELECT '', CAST(sum(records_emitted) AS BIGINT), CAST(sum(bytes_emitted) AS BIGINT), CAST(sum(records_committed) AS BIGINT) FROM s"
)


@query("j6_stream_sync_stats", STATS_SQL)
def j6(u):
    stats = run.run_to_end(metrics.sync_stats(event_stream(u)), ["stream"])
    return stats.unionByName(metrics.sync_totals(stats).withColumn("stream", F.lit("")))


@query(
    "j7_stream_progress",
    f"WITH {MESSAGES_SQL} SELECT 'Records read: ' || count(*) || ' (' || CAST(sum(octet_length(encode(data))) AS BIGINT) || ' bytes)' AS line FROM keyed",
)
def j7(u):
    """Last progress line of a streaming run: records and bytes observed with every micro-batch."""
    out, progress = work_dir(u.spark, "progress"), run.Progress(f"progress-{uuid.uuid4().hex}")
    stream = run.with_progress(event_stream(u), progress.name)
    run.run_with_progress(lambda: run.start_upsert(stream, f"{out}/rows", f"{out}/checkpoint"), u.spark, progress)
    return u.spark.createDataFrame([(progress.lines[-1],)], "line string")


@query(
    "j8_stream_finish",
    f"""WITH {MESSAGES_SQL},
kept AS (SELECT "offset" FROM keyed JOIN events ON "offset" = event_id WHERE value >= 50),
r AS (SELECT stream, field, CAST(count(*) AS DOUBLE) AS count, sum(amount) AS sum FROM amounts GROUP BY 1, 2),
c AS (SELECT stream, field, CAST(count(*) AS DOUBLE) AS count, sum(amount) AS sum FROM amounts WHERE "offset" IN (SELECT "offset" FROM kept) GROUP BY 1, 2),
n AS (SELECT stream, count(*) AS n_edges FROM c GROUP BY 1),
sides AS (SELECT 'source' AS side, * FROM r UNPIVOT (value FOR stat IN (count, sum)) UNION ALL SELECT 'destination', * FROM c UNPIVOT (value FOR stat IN (count, sum))
  UNION ALL SELECT 'source', stream, '', 'records', count(*) FROM keyed GROUP BY stream
  UNION ALL SELECT 'destination', stream, '', 'records', count(*) FROM keyed WHERE "offset" IN (SELECT "offset" FROM kept) GROUP BY stream)
SELECT side, stream, field, stat, round(value, 2) AS value, n_edges FROM sides JOIN n USING (stream)""",
)
def j8(u):
    """A sync run to its end in one streaming run: the destination took a part of the records, which is measured apart."""
    took = F.get_json_object("data", "$.value").cast("double") >= 50
    state = run.run_to_end(metrics.sync_state(event_stream(u), took), KEYS)
    source = u.declared().select("stream", F.col("field").alias("name"), F.get("types", F.lit(0)).alias("dtype"))
    done = run.finish_state(state, source, "0" * 32, "2024-01-01T00:00:00")
    sides = done.schemas.select("schema_id", "side")
    edges = done.lineage.select(F.col("lineage_key").alias("stream"), "n_edges")
    rows = done.metrics.join(sides, "schema_id").join(edges, "stream")
    return rows.select("side", "stream", "field", "stat", F.round("value", 2).alias("value"), "n_edges")
