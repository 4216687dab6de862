"""Metrics of message streams. Every function takes a batch or a streaming frame
`(stream, offset, data)`; state is one row per stream and field, so no watermark is needed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodewatch.functions.messages import explode_fields, field_amount, json_kind, json_type_of
from lodewatch.session import small_enough, stored

METRIC_KINDS = ("number", "string")
UNKNOWN = "unknown"
STREAM_SALTS = 32
# Registers of a distinct sketch, as a power of two: a standard error of 1.04 / 2 ** (log_size / 2), 1.6 % here.
SKETCH_LOG_SIZE = 12


def field_running_metrics(messages: DataFrame) -> DataFrame:
    """(stream, field, count, sum): numbers add their value, texts their length, the rest nothing."""
    measured = explode_fields(messages.select("stream", "data")).where(F.col("kind").isin(*METRIC_KINDS))
    return (
        measured.select("stream", "field", field_amount(F.col("kind"), F.col("value")).alias("amount"))
        .groupBy("stream", "field")
        .agg(F.count("amount").alias("count"), F.sum("amount").alias("sum"))
    )


def field_sketches(messages: DataFrame, log_size: int = SKETCH_LOG_SIZE) -> DataFrame:
    """(stream, field, sketch): HLL states of the texts of each field, of fixed size (2 ** log_size registers).

    States may be stored and united with those of other batches and runs (`united_sketches`).
    """
    texts = explode_fields(messages.select("stream", "data")).where("kind = 'string'")
    value = F.try_variant_get("value", "$", "string")
    return texts.groupBy("stream", "field").agg(F.hll_sketch_agg(value, log_size).alias("sketch"))


def united_sketches(sketches: DataFrame) -> DataFrame:
    """(stream, field, sketch) of any number of stored states: the state of all their messages together."""
    return sketches.groupBy("stream", "field").agg(F.hll_union_agg("sketch").alias("sketch"))


def sketch_levels(sketches: DataFrame) -> DataFrame:
    """(stream, field, levels): distinct texts that states stand for.

    A state that was never united estimates from the history of its changes, others from their registers. United
    with itself any state does the latter, so that the same registers give the same number however they came about.
    """
    return sketches.select("stream", "field", F.hll_sketch_estimate(F.hll_union("sketch", "sketch")).alias("levels"))


def field_distinct(messages: DataFrame, log_size: int = SKETCH_LOG_SIZE) -> DataFrame:
    """(stream, field, levels): distinct texts, by a sketch of fixed size."""
    return sketch_levels(field_sketches(messages, log_size))


def record_count(messages: DataFrame) -> DataFrame:
    return messages.groupBy("stream").agg(F.count("*").alias("count"))


def schema_growth(messages: DataFrame, order: Sequence[str] = ("offset",)) -> DataFrame:
    """(stream, field, dtype, since, mixed): a field joins at its first number or text.

    `since` is the offset at which it joined, `dtype` the kind it had there; `mixed` tells that
    the other kind came later. Offsets count within one partition of a topic only: where there are several, name the columns
    that order messages, such as ("time", "partition", "offset"); they take the place of `since` as `since_time` and so on.
    The first place, and the kind there, are minima and so the same in whichever order messages come.
    """
    typed = explode_fields(messages.select("stream", *order, "data")).where(F.col("kind").isin(*METRIC_KINDS))
    kind, place = F.col("kind"), F.struct(*order)
    since = [F.col("_first")[c].alias("since" if len(order) == 1 else f"since_{c}") for c in order]
    return (
        typed.groupBy("stream", "field")
        .agg(
            F.min_by("kind", place).alias("dtype"),
            F.min(place).alias("_first"),
            F.count_if(kind == "number").alias("_numbers"),
            F.count_if(kind == "string").alias("_texts"),
        )
        .select("stream", "field", "dtype", *since, ((F.col("_numbers") > 0) & (F.col("_texts") > 0)).alias("mixed"))
    )


def field_kinds(messages: DataFrame) -> DataFrame:
    """(stream, field, values, nulls): how often a field had a value and how often it was null."""
    kinds = explode_fields(messages.select("stream", "data"))
    is_null = F.col("kind") == "null"
    return kinds.groupBy("stream", "field").agg(
        F.count_if(~is_null).alias("values"), F.count_if(is_null).alias("nulls")
    )


def all_null_fields(kinds: DataFrame) -> DataFrame:
    """Fields that were null in all messages; they enter a schema as `unknown`."""
    return kinds.where("values = 0").select("stream", "field", F.lit(UNKNOWN).alias("dtype"))


def sync_state(messages: DataFrame, copied: Column) -> DataFrame:
    """Everything that the end of a sync reports, as one aggregation and so one streaming run: per stream and field

    `count`, `sum` of what was read and `copied_count`, `copied_sum` of what the destination took (`copied`, a condition on the
    messages); `dtype`, the first kind of a copied value; `records` and `copied_records`, the messages whose first
    field this is, so that they add up to those of the stream. A payload without fields counts under a null field.
    """
    spark = messages.sparkSession
    parsed = messages.select("stream", "offset", F.coalesce(copied, F.lit(False)).alias("copied"), F.try_parse_json("data").alias("_p"))
    exploded = parsed.lateralJoin(spark.tvf.variant_explode_outer(F.col("_p").outer()).alias("_f"))
    kind, value = json_kind(F.col("_f.value")), F.col("_f.value")
    rows = exploded.select("stream", "offset", "copied", F.col("_f.key").alias("field"), kind.alias("kind"), (F.coalesce(F.col("_f.pos"), F.lit(0)) == 0).alias("first"), value.alias("value"))
    measured = F.col("kind").isin(*METRIC_KINDS) & F.col("field").isNotNull()
    amount = F.when(measured, field_amount(F.col("kind"), F.col("value")))
    taken = F.col("copied")
    return rows.select("stream", "field", "offset", "copied", "kind", "first", amount.alias("amount")).groupBy("stream", "field").agg(
        F.count("amount").alias("count"), F.sum("amount").alias("sum"),
        F.count(F.when(taken, F.col("amount"))).alias("copied_count"), F.sum(F.when(taken, F.col("amount"))).alias("copied_sum"),
        F.min_by(F.when(taken & F.col("kind").isin(*METRIC_KINDS), F.col("kind")), F.when(taken & F.col("kind").isin(*METRIC_KINDS), F.col("offset"))).alias("dtype"),
        F.count_if("first").alias("records"), F.count_if(F.col("first") & taken).alias("copied_records"),
    )


def declared_types(catalog: DataFrame) -> DataFrame:
    """Catalog (stream, field, types) -> one map field -> types per stream, as long as a stream is wide."""
    entry = F.struct("field", "types")
    return catalog.groupBy("stream").agg(F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("declared"))


def record_violations(messages: DataFrame, declared: DataFrame, salts: int = STREAM_SALTS) -> DataFrame:
    """Messages with `violations`, the texts of all rules a record breaks.

    A field whose JSON type is not among its declared types breaks the rule; an undeclared field
    breaks none; a payload that is no JSON object is a violation itself.
    """
    parsed = messages.select("*", F.try_parse_json("data").alias("_v"))
    # The type of each field is taken once, as text, before the rules look at it.
    found = F.transform(
        F.map_entries(F.try_variant_get("_v", "$", "map<string,variant>")),
        lambda e: F.struct(e["key"].alias("field"), F.schema_of_variant(e["value"]).alias("schema")),
    )
    checked = _with_declared(parsed.select(*messages.columns, found.alias("_found")), declared, salts)
    entries = F.transform(
        "_found",
        lambda f: F.struct(
            f["field"].alias("field"),
            json_type_of(f["schema"]).alias("type"),
            F.try_element_at(F.col("declared"), f["field"]).alias("types"),
        ),
    )
    broken = F.filter(entries, lambda e: ~_allowed(e["types"], e["type"]))
    texts = F.transform(
        broken,
        lambda e: F.concat(
            F.lit("$."), e["field"], F.lit(": "), e["type"], F.lit(" found, "),
            F.array_join(e["types"], " or "), F.lit(" expected"),
        ),
    )
    # Only a JSON object can be taken as a map.
    violations = F.when(F.col("_found").isNotNull(), texts).otherwise(F.array(F.lit("$: object expected")))
    return checked.select(*messages.columns, violations.alias("violations"))


def _with_declared(messages: DataFrame, declared: DataFrame, salts: int) -> DataFrame:
    """Joins the declared types; a stream may hold a third of all messages.

    The declared side, one row per stream, is written once, so that no micro-batch makes it again and
    Spark knows its size in bytes. If that is below the session's threshold Spark broadcasts it;
    otherwise the messages are salted and its rows repeated, which works for streaming frames too.
    """
    declared = stored(declared, "declared")
    if small_enough(declared):
        return messages.join(declared, "stream", "left")
    salted = messages.withColumn("_salt", F.pmod(F.xxhash64("offset"), F.lit(salts)).cast("int"))
    repeated = declared.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(repeated, ["stream", "_salt"], "left").drop("_salt")


def _allowed(types, found):
    """Null, and so neither allowed nor broken, for an undeclared field."""
    return F.array_contains(types, found) | ((found == "integer") & F.array_contains(types, "number"))


def schema_violations(messages: DataFrame, declared: DataFrame, salts: int = STREAM_SALTS) -> DataFrame:
    """(stream, records, messages): number of records that break a rule, and the distinct texts.

    Both are exact; the texts name fields and types, not values, so they are few.
    """
    broken = record_violations(messages, declared, salts).select("stream", F.posexplode("violations").alias("nth", "text"))
    return broken.groupBy("stream").agg(
        F.count_if(F.col("nth") == 0).alias("records"), F.array_sort(F.collect_set("text")).alias("messages")
    )


def sync_stats(messages: DataFrame, completed: bool = True) -> DataFrame:
    """(stream, records_emitted, bytes_emitted, records_committed); all emitted records of a
    completed sync are committed, of any other the number is not known."""
    stats = messages.groupBy("stream").agg(
        F.count("*").alias("records_emitted"), F.sum(F.octet_length("data")).alias("bytes_emitted")
    )
    committed = F.col("records_emitted") if completed else F.lit(None).cast("long")
    return stats.withColumn("records_committed", committed)


def sync_totals(stats: DataFrame) -> DataFrame:
    """Totals over the streams of `sync_stats`."""
    return stats.agg(*[F.sum(c).alias(c) for c in ("records_emitted", "bytes_emitted", "records_committed")])
