"""Functions over the JSON payload of messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodewatch.functions.keys import as_col


# Spark's names of variant types and the JSON types they stand for.
JSON_TYPES = {
    "STRING": "string",
    "BIGINT": "integer",
    "DECIMAL": "number",
    "DOUBLE": "number",
    "FLOAT": "number",
    "BOOLEAN": "boolean",
    "VOID": "null",
    "ARRAY": "array",
    "OBJECT": "object",
}


def json_type(value: Column | str) -> Column:
    """JSON type of a variant: integer, number, string, boolean, null, array or object."""
    return json_type_of(F.schema_of_variant(as_col(value)))


def json_type_of(schema: Column) -> Column:
    """JSON type from the text of a variant's schema; whole decimals are integers."""
    word = F.substring_index(F.substring_index(schema, "<", 1), "(", 1)
    names = F.create_map(*[F.lit(x) for pair in JSON_TYPES.items() for x in pair])
    whole = schema.startswith("DECIMAL") & schema.endswith(",0)")
    return F.when(whole, "integer").otherwise(F.try_element_at(names, word))


def json_kind(value: Column | str) -> Column:
    """The kinds that metrics and schemas tell apart: number, string, null, other."""
    word = F.regexp_extract(F.schema_of_variant(as_col(value)), "^[A-Z]+", 0)
    kinds = {"integer": "number", "number": "number", "string": "string", "null": "null"}
    known = {variant: kinds[t] for variant, t in JSON_TYPES.items() if t in kinds}
    names = F.create_map(*[F.lit(x) for pair in known.items() for x in pair])
    return F.coalesce(F.try_element_at(names, word), F.lit("other"))


def text_units(text: Column | str) -> Column:
    """Text length in UTF-16 units, so that characters beyond the basic plane count twice."""
    return (F.length(F.encode(as_col(text), "UTF-16BE")) / 2).cast("long")


def explode_fields(messages: DataFrame, data: str = "data") -> DataFrame:
    """One row per top-level JSON field: the other columns plus `field`, `kind`, `value`.

    A payload that is not a JSON object yields no rows here; `stream_schema_violations`
    reports it.
    """
    spark = messages.sparkSession
    rest = [c for c in messages.columns if c != data]
    parsed = messages.select(*rest, F.try_parse_json(F.col(data)).alias("_payload"))
    exploded = parsed.lateralJoin(spark.tvf.variant_explode(F.col("_payload").outer()).alias("_f"))
    # The elements of an array have no key.
    return exploded.where("_f.key is not null").select(
        *rest,
        F.col("_f.key").alias("field"),
        json_kind(F.col("_f.value")).alias("kind"),
        F.col("_f.value").alias("value"),
    )


def field_amount(kind: Column, value: Column) -> Column:
    """What a field adds to its running sum: the number, or the length of the text."""
    return (
        F.when(kind == "number", F.try_variant_get(value, "$", "double"))
        .when(kind == "string", text_units(F.try_variant_get(value, "$", "string")).cast("double"))
    )
