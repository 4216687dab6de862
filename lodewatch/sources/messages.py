"""Streams of JSON record messages and stored chart payloads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodewatch.functions.keys import as_col

MESSAGE_SCHEMA = "type string, namespace string, stream string, offset bigint, data string"
RECORD = "RECORD"


def read_file_stream(
    spark: SparkSession, path: str, schema: T.StructType, source_format: str = "parquet", files_per_trigger: int | None = None
) -> DataFrame:
    """Streaming read of a dataset kept as one file or as a folder of files."""
    reader = spark.readStream.schema(schema).format(source_format)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    path = path.rstrip("/")
    # As a pattern the path may be a plain file too; a literal one must be a folder.
    return reader.load(f"{path[:-1]}[{path[-1]}]")


ENVELOPE = "struct<type: string, record: struct<namespace: string, stream: string, data: variant>>"
#: Why an envelope is refused; the first that applies.
NO_JSON, NO_OBJECT, NO_TYPE, NO_STREAM, NO_DATA = "no JSON", "no object", "no type", "record without stream", "record without data"


def judged_envelopes(raw: DataFrame, value: str = "value", offset: str = "offset") -> DataFrame:
    """Messages kept whole as JSON text, parsed once: `offset`, the message columns, `reason` and `value`.

    `reason` is null where the envelope is taken; otherwise it says why not, and `value` has the text. Every row that is
    read is a row here, so what is kept and what is refused add up. Works on streams.
    """
    text = F.col(value).cast("string")
    parsed = raw.select(F.col(offset).alias("offset"), text.alias("value"), F.try_parse_json(text).alias("v"))
    shaped = parsed.select("offset", "value", F.schema_of_variant("v").alias("kind"), F.try_variant_get("v", "$", ENVELOPE).alias("m"))
    kind, record = F.col("kind"), F.col("m.type") == RECORD
    reason = (
        F.when(kind.isNull(), NO_JSON)
        .when(~kind.startswith("OBJECT"), NO_OBJECT)
        .when(F.col("m.type").isNull(), NO_TYPE)
        .when(record & F.col("m.record.stream").isNull(), NO_STREAM)
        .when(record & F.col("m.record.data").isNull(), NO_DATA)
    )
    return shaped.select(
        "offset", "m.type", "m.record.namespace", "m.record.stream", F.to_json("m.record.data").alias("data"),
        reason.alias("reason"), F.when(reason.isNotNull(), F.col("value")).alias("value"),
    )


def kept_envelopes(judged: DataFrame) -> DataFrame:
    """The message columns of the envelopes that are taken."""
    return judged.where("reason is null").select("type", "namespace", "stream", "offset", "data")


def refused_envelopes(judged: DataFrame) -> DataFrame:
    """(offset, reason, value) of the others: the side output, to be written beside the messages."""
    return judged.where("reason is not null").select("offset", "reason", "value")


def envelope_counts(judged: DataFrame) -> DataFrame:
    """(reason, n): how many envelopes were taken (null) and refused for each reason."""
    return judged.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def from_envelopes(raw: DataFrame, value: str = "value", offset: str = "offset") -> DataFrame:
    """Messages kept whole as JSON text (`type`, `record.stream`, `record.data`) -> message columns, refused ones left out."""
    return kept_envelopes(judged_envelopes(raw, value, offset))


def kafka_envelopes(spark: SparkSession, servers: str, topic: str, **options: str) -> DataFrame:
    """Judged envelopes of a Kafka topic (needs Spark's Kafka package on the cluster)."""
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
    return judged_envelopes(reader.options(**options).load())


def records_only(messages: DataFrame) -> DataFrame:
    """Keeps the record messages; state, log and other messages carry no data."""
    return messages.where(F.col("type") == RECORD)


def stream_key(namespace: Column | str, stream: Column | str) -> Column:
    """Name of a stream with its namespace in front."""
    return F.concat(F.coalesce(as_col(namespace), F.lit("")), as_col(stream))


def keyed(messages: DataFrame) -> DataFrame:
    """Record messages as (stream, offset, data), the stream named with its namespace."""
    return records_only(messages).select(stream_key("namespace", "stream").alias("stream"), "offset", "data")


def first_query_only(charts: DataFrame, payload: str = "payload") -> DataFrame:
    """First query of each chart payload: adds `colnames`, `data` and `n_queries`.

    `n_queries > 1` marks the charts of which only the first query is observed.
    """
    parsed = charts.withColumn(
        "_p", F.from_json(payload, "queries array<struct<colnames array<string>, data variant>>")
    )
    first = F.get("_p.queries", F.lit(0))
    return parsed.select(
        *[c for c in charts.columns if c != payload],
        first["colnames"].alias("colnames"),
        F.to_json(first["data"]).alias("data"),
        F.size("_p.queries").alias("n_queries"),
    )


def records_to_table(df: DataFrame, data: str, record_schema: str) -> DataFrame:
    """One row per record of a JSON array column, typed by the given schema."""
    rest = [c for c in df.columns if c != data]
    return df.select(*rest, F.inline(F.from_json(data, f"array<struct<{record_schema}>>")))
