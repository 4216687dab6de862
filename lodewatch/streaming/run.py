"""Running stream aggregations to the end of what is available, and their result tables."""

from __future__ import annotations

import threading
import time
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from lodewatch.functions.keys import md5_key
from lodewatch.operators.entities import schemas
from lodewatch.operators.lineage import lineage_direct, lineage_executions, lineages
from lodewatch.session import stored, work_dir
from lodewatch.streaming.state import BATCH, FANOUT, Part, PartLog, latest


def start_upsert(
    stream: DataFrame, path: str, checkpoint: str, trigger: dict | None = None, keys: Sequence[str] = (), fanout: int = FANOUT
) -> StreamingQuery:
    """Writes the changed rows of each micro-batch to a part of their own, and merges parts by `keys` as they get many.

    A batch that is run again after a failure replaces its part, so nothing is counted twice. Without keys
    there is nothing to merge by, and the parts stay.
    """
    log = PartLog(stream.sparkSession, path)

    def write(batch: DataFrame, batch_id: int) -> None:
        if keys:
            log.merge(keys, before=batch_id, fanout=fanout)
        log.write(batch.withColumn(BATCH, F.lit(batch_id).cast("bigint")), Part(0, batch_id, batch_id))

    writer = stream.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(write)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def current_rows(spark: SparkSession, path: str, keys: Sequence[str], schema) -> DataFrame:
    """Latest row of each key of an upserted table."""
    log = PartLog(spark, path)
    changes = log.read(log.live(), f"{_ddl(schema)}, {BATCH} bigint")
    return latest(changes, keys).select(*schema.fieldNames())


def _ddl(schema) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def run_to_end(stream: DataFrame, keys: Sequence[str], fanout: int = FANOUT) -> DataFrame:
    """Runs a streaming aggregation over all that is available and returns its current rows."""
    spark = stream.sparkSession
    out = work_dir(spark, "stream")
    query = start_upsert(stream, f"{out}/changes", f"{out}/checkpoint", keys=keys, fanout=fanout)
    query.awaitTermination()
    return current_rows(spark, f"{out}/changes", keys, stream.schema)


@dataclass
class Progress(StreamingQueryListener):
    """Keeps a log line per micro-batch: records and bytes read so far."""

    name: str = "progress"
    lines: list[str] = field(default_factory=list)
    records: int = 0
    size: int = 0
    finished: list[str] = field(default_factory=list)
    done: threading.Event = field(default_factory=threading.Event)

    def __hash__(self):
        return id(self)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.finished.append(str(event.runId))  # comes after the progress of every batch
        self.done.set()

    def ended(self, run_id: str, seconds: float) -> bool:
        """Waits for the report that a run has ended."""
        deadline = time.monotonic() + seconds
        while run_id not in self.finished and (left := deadline - time.monotonic()) > 0:
            self.done.wait(left)
            self.done.clear()
        return run_id in self.finished

    def onQueryProgress(self, event) -> None:
        self.add(event.progress)

    def add(self, progress) -> None:
        seen = progress.observedMetrics.get(self.name)
        if seen is not None:
            self.records += seen["records"] or 0
            self.size += seen["bytes"] or 0
            self.lines.append(f"Records read: {self.records} ({self.size} bytes)")


def run_with_progress(start, spark: SparkSession, progress: Progress, seconds: float = 60) -> None:
    """Runs the query that `start()` starts to its end, with every batch's progress counted.

    A query itself keeps the progress of its last batches only; the listener is told of all.
    """
    spark.streams.addListener(progress)
    try:
        query = start()
        query.awaitTermination()
        if not progress.ended(str(query.runId), seconds):
            raise TimeoutError("the end of the query was not reported")
    finally:
        spark.streams.removeListener(progress)


def with_progress(messages: DataFrame, name: str = "progress") -> DataFrame:
    """The stream with its record and byte counts observed, for a `Progress` listener of that name."""
    return messages.observe(
        name, F.count(F.lit(1)).alias("records"), F.sum(F.octet_length("data")).alias("bytes")
    )


@dataclass
class SyncObservation:
    """Rows reported at the end of a sync."""

    schemas: DataFrame
    edges: DataFrame
    lineage: DataFrame
    execution: DataFrame
    metrics: DataFrame


def finish_sync(
    source_fields: DataFrame,
    destination_fields: DataFrame,
    read: DataFrame,
    copied: DataFrame,
    app_execution: str,
    start_time: str,
    records: DataFrame | None = None,
) -> SyncObservation:
    """Schemas, lineage, run and statistics of a finished sync.

    `records` (stream, read, copied) adds the numbers of records of both sides, without a field.

    Fields are `stream, name, dtype`; metrics are `stream, field, count, sum`. Fields of equal name
    are linked; a stream without any keeps a lineage with no edges.
    """
    def side(fields: DataFrame, fmt: str) -> DataFrame:
        with_source = fields.withColumn("data_source_id", md5_key("stream", F.lit(fmt)))
        rows = schemas(with_source)
        return rows.join(with_source.select("data_source_id", "stream").distinct(), "data_source_id").select(
            "stream", "schema_id", "data_source_id", "n_fields"
        )

    src, dst = side(source_fields, "source"), side(destination_fields, "destination")
    out_fields = destination_fields.select(F.col("stream").alias("lineage_key"), F.lit(0).alias("pos"), "name")
    inputs = src.select(F.col("stream").alias("lineage_key"), F.lit(0).alias("input_ord"), F.col("schema_id").alias("input_schema_id"))
    in_fields = source_fields.join(src.select("stream", "schema_id"), "stream").select("schema_id", F.lit(0).alias("pos"), "name")
    edges = lineage_direct(out_fields, inputs, in_fields)
    outputs = dst.select(F.col("stream").alias("lineage_key"), "schema_id")
    lineage = lineages(edges, outputs)
    runs = outputs.select("lineage_key", F.lit(app_execution).alias("app_execution"), F.lit(start_time).alias("start_time"))
    execution = lineage_executions(lineage, runs)

    def stats(metrics: DataFrame, schema: DataFrame) -> DataFrame:
        long = metrics.unpivot(["stream", "field"], [F.col("count").cast("double").alias("count"), "sum"], "stat", "value")
        return long.join(schema.select("stream", "schema_id"), "stream").select("stream", "schema_id", "field", "stat", "value")

    by_stream = lineage.select(F.col("lineage_key").alias("stream"), F.col("id").alias("lineage")).join(
        execution.select("lineage", F.col("id").alias("lineage_execution_id")), "lineage"
    )
    def counted(side: str, schema: DataFrame) -> list[DataFrame]:
        if records is None:
            return []
        rows = records.select("stream", F.lit("").alias("field"), F.lit("records").alias("stat"), F.col(side).cast("double").alias("value"))
        return [rows.join(schema.select("stream", "schema_id"), "stream").select("stream", "schema_id", "field", "stat", "value")]

    sides = [stats(read, src), stats(copied, dst), *counted("read", src), *counted("copied", dst)]
    metrics = (
        reduce(DataFrame.unionByName, sides).join(by_stream.drop("lineage"), "stream")
        .select(md5_key("schema_id", "lineage_execution_id").alias("metrics_id"), "stream", "schema_id", "lineage_execution_id", "field", "stat", "value")
    )
    both = src.withColumn("side", F.lit("source")).unionByName(dst.withColumn("side", F.lit("destination")))
    return SyncObservation(both, edges, lineage, execution, metrics)


def finish_state(state: DataFrame, declared: DataFrame, app_execution: str, start_time: str) -> SyncObservation:
    """The end of a sync from its one state (`metrics.sync_state`), written once.

    `declared` (stream, name, dtype) are the source's fields; the destination's are those of which a value was copied.
    """
    state = stored(state, "sync-state")
    fields = state.where("field is not null")
    read = fields.where("count > 0").select("stream", "field", "count", "sum")
    copied = fields.where("copied_count > 0").select("stream", "field", F.col("copied_count").alias("count"), F.col("copied_sum").alias("sum"))
    landed = fields.where("copied_count > 0").select("stream", F.col("field").alias("name"), "dtype")
    records = state.groupBy("stream").agg(F.sum("records").alias("read"), F.sum("copied_records").alias("copied"))
    return finish_sync(declared, landed, read, copied, app_execution, start_time, records)
