"""Column lineage.

Inputs of these operators:

* `outputs`: one row per lineage, `lineage_key, schema_id`, with its fields in
  `out_fields(lineage_key, pos, name)`;
* `inputs`: `lineage_key, input_ord, input_schema_id`;
* `fields`: `schema_id, pos, name` of the input schemas.

Field rows may also come as `field_lists`, one row per schema, except where fields are matched by a join.

Edges are rows `lineage_key, input_ord, input_schema_id, edge_ord, output_field,
input_fields`: one row per output field and input, the inputs' fields as an array. This is
the shape of the mapping itself; a full mapping of m output and n input fields is m rows
and not m x n.

A mapping may also stay in factors: rows `lineage_key, input_ord, input_schema_id, pairwise, outputs, inputs`, one per
input. `pairwise` links the n-th output field to the n-th input field; otherwise every output field depends on
all input fields, and m + n names stand for m x n links. `expand` makes edges of factors, `lineages` takes either.

Where the inputs of a lineage are few, as those that one statement names, its mapping may be gathered: one row per lineage,
`lineage_key, schema_id, parts` and others, `parts` being the list of its factors in the order of the inputs. Ids and
executions of gathered mappings need no shuffle and keep the other columns.

Field lists are packed into one array per schema first (as long as a table is wide), so the
joins move one row per input, whatever the number of fields.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodewatch.functions.keys import md5_key
from lodewatch.operators.skew import salted_join

EDGE_COLUMNS = ["lineage_key", "input_ord", "input_schema_id", "edge_ord", "output_field", "input_fields"]
FACTOR_COLUMNS = ["lineage_key", "input_ord", "input_schema_id", "pairwise", "outputs", "inputs"]
# Added edges come after all positions a field of a schema can have.
APPENDED = 1_000_000_000


def field_lists(fields: DataFrame, key: str) -> DataFrame:
    """(key, fields): the field rows of a schema, with all their columns, as one list in the order of `pos`."""
    rest = [c for c in fields.columns if c not in (key, "pos")]
    return fields.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("pos", *rest))).alias("fields"))


def packed(fields: DataFrame, key: str) -> DataFrame:
    """(key, names): the field names of a schema in their order; `fields` may be field rows or their `field_lists`."""
    listed = fields if "fields" in fields.columns else field_lists(fields.select(key, "pos", "name"), key)
    return listed.select(key, F.col("fields.name").alias("names"))


def paired(out_fields: DataFrame, inputs: DataFrame, fields: DataFrame) -> DataFrame:
    """Each input of a lineage with its own field names and those of the output."""
    ins = packed(fields, "schema_id").select(F.col("schema_id").alias("input_schema_id"), F.col("names").alias("in_names"))
    outs = packed(out_fields, "lineage_key").withColumnRenamed("names", "out_names")
    # Every join keeps at most the rows of `inputs`, on which the hot keys are counted.
    with_fields = salted_join(inputs, ins, "input_schema_id")
    return salted_join(with_fields, outs, "lineage_key", counted=inputs)


def _factors(pairs: DataFrame, pairwise: Column) -> DataFrame:
    """Factors of paired field lists: equal names where `pairwise`, in the order of the input's fields, else both lists whole."""
    common = F.filter("in_names", lambda n: F.array_contains(F.col("out_names"), n))
    made = pairs.withColumn("pairwise", pairwise).withColumn("inputs", F.when(F.col("pairwise"), common).otherwise(F.col("in_names")))
    made = made.withColumn("outputs", F.when(F.col("pairwise"), F.col("inputs")).otherwise(F.col("out_names")))
    return made.where(F.size("outputs") > 0).select(*FACTOR_COLUMNS)


def direct_or_full_links(out_names: Column, in_names: Column) -> tuple[Column, Column, Column]:
    """(pairwise, outputs, inputs) of one input, as `direct_or_full_factors` has them: for gathered mappings."""
    common = F.filter(in_names, lambda n: F.array_contains(out_names, n))
    direct = F.size(common) > 0
    return direct, F.when(direct, common).otherwise(out_names), F.when(direct, common).otherwise(in_names)


def direct_factors(out_fields: DataFrame, inputs: DataFrame, fields: DataFrame) -> DataFrame:
    """Factors of the mapping between fields of equal name; an input without any gives none."""
    return _factors(paired(out_fields, inputs, fields), F.lit(True))


def full_factors(out_fields: DataFrame, inputs: DataFrame, fields: DataFrame) -> DataFrame:
    """Factors of the mapping in which every output field depends on all fields of every input."""
    return _factors(paired(out_fields, inputs, fields), F.lit(False))


def direct_or_full_factors(out_fields: DataFrame, inputs: DataFrame, fields: DataFrame) -> DataFrame:
    """Direct where an input shares any name with the output, full where not."""
    return _factors(paired(out_fields, inputs, fields), F.arrays_overlap("in_names", "out_names"))


def expand(factors: DataFrame) -> DataFrame:
    """The edges of factors: one row per output field and input."""
    one = F.transform("outputs", lambda o, i: F.struct(
        o.alias("output_field"), F.when(F.col("pairwise"), F.array(F.get("inputs", i))).otherwise(F.col("inputs")).alias("input_fields")))
    return factors.select("lineage_key", "input_ord", "input_schema_id", F.posexplode(one).alias("edge_ord", "e")).select(
        "lineage_key", "input_ord", "input_schema_id", "edge_ord", "e.output_field", "e.input_fields")


def lineage_direct(out_fields: DataFrame, inputs: DataFrame, fields: DataFrame) -> DataFrame:
    """Edges between fields of equal name; an input without any gives no edge."""
    return expand(direct_factors(out_fields, inputs, fields))


def lineage_full(out_fields: DataFrame, inputs: DataFrame, fields: DataFrame) -> DataFrame:
    """Every output field depends on all fields of every input; as edges (`full_factors` is the small form)."""
    return expand(full_factors(out_fields, inputs, fields))


def lineage_direct_or_full(out_fields: DataFrame, inputs: DataFrame, fields: DataFrame) -> DataFrame:
    """Direct edges where an input shares any name with the output, full edges where not."""
    return expand(direct_or_full_factors(out_fields, inputs, fields))


def lineage_extra(direct: DataFrame, extra: DataFrame) -> DataFrame:
    """Direct edges overridden per output field by a given mapping.

    `extra` has the edge columns (edge_ord: order of the given mapping). An overridden
    field keeps its place, a new one comes after all others. Both sides hold a field of an
    input once, so the join key is unique however large a lineage is.
    """
    key = ["lineage_key", "input_ord", "input_schema_id", "output_field"]
    d = direct.select(*key, F.col("edge_ord").alias("d_ord"), F.col("input_fields").alias("d_in"))
    e = extra.select(*key, F.col("edge_ord").alias("e_ord"), F.col("input_fields").alias("e_in"))
    return d.join(e, key, "full_outer").select(
        "lineage_key",
        "input_ord",
        "input_schema_id",
        F.coalesce("d_ord", F.lit(APPENDED) + F.col("e_ord")).alias("edge_ord"),
        "output_field",
        F.coalesce("e_in", "d_in").alias("input_fields"),
    )


def field_match_join(out_fields: DataFrame, inputs: DataFrame, fields: DataFrame) -> DataFrame:
    """The same direct edges as one row per matching pair of fields, by an equi-join on the name.

    Field rows often come from exploded lists, whose size Spark takes for that of the lists, so neither side may be broadcast.
    """
    ins = salted_join(inputs, fields.withColumnRenamed("schema_id", "input_schema_id"), "input_schema_id")
    return ins.join(out_fields.select("lineage_key", "name").hint("merge"), ["lineage_key", "name"]).select(
        "lineage_key", "input_ord", "input_schema_id", F.col("pos").alias("edge_ord"), F.col("name").alias("field")
    )


def field_cross_counts(out_fields: DataFrame, inputs: DataFrame, fields: DataFrame) -> DataFrame:
    """Number of field pairs of a full mapping per input, without building the pairs."""
    widths = fields.groupBy(F.col("schema_id").alias("input_schema_id")).agg(F.count("*").alias("n_in"))
    outs = out_fields.groupBy("lineage_key").agg(F.count("*").alias("n_out"))
    with_widths = salted_join(inputs, widths, "input_schema_id")
    return salted_join(with_widths, outs, "lineage_key", counted=inputs).select(
        "lineage_key", "input_ord", "input_schema_id", (F.col("n_in") * F.col("n_out")).alias("n_pairs")
    )


def input_texts(edges: DataFrame) -> DataFrame:
    """(lineage_key, input_ord, n_edges, text): the linearized edges of each input.

    Grouped per input, whose edges are as many as the output has fields, so one lineage with
    very many inputs is spread over all tasks.
    """
    entry = F.struct(
        "edge_ord",
        F.concat(F.col("output_field"), F.lit(":"), F.array_join("input_fields", "-")).alias("text"),
    )
    grouped = edges.groupBy("lineage_key", "input_ord").agg(F.array_sort(F.collect_list(entry)).alias("e"))
    return grouped.select(
        "lineage_key", "input_ord", F.size("e").cast("long").alias("n_edges"), F.array_join("e.text", ",").alias("text")
    )


def _factor_pieces():
    """The text of an input's factors, piece by piece.

    Functions that run in tasks are made by functions like this one, so that Spark ships their code and the executors need
    not have this package installed.
    """

    def pieces(pairwise, outputs, inputs):
        if pairwise:
            yield ",".join(f"{name}:{own}" for name, own in zip(outputs, inputs))
            return
        behind = ":" + "-".join(inputs)
        for place, name in enumerate(outputs):
            yield ("," if place else "") + name + behind

    return pieces


def _chain_digest():
    """md5 over the sorted rows of each lineage, holding one digest at a time.

    A row is an input's text or its factors, whose text is fed to the digest piece by piece.
    """
    columns, factor_pieces = ["id", "lineage_key", "schema_id", "n_edges"], _factor_pieces()

    def digest_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, schema_id, digest, edges, first = None, None, None, 0, True
        for batch in batches:
            done = []
            parts = zip(batch["pairwise"], batch["outputs"], batch["inputs"]) if "outputs" in batch else iter(lambda: None, 0)
            columns_read = [batch[c].tolist() for c in ("lineage_key", "input_ord", "n_edges", "text")]
            for k, order, n, text, part in zip(*columns_read, parts):
                if order < 0:  # a head; edges of a key without one belong to no output and are left out
                    if digest is not None:
                        done.append((digest.hexdigest(), key, schema_id, edges))
                    key, schema_id, edges, first = k, text, 0, True
                    digest = hashlib.md5(text.encode("utf-8"))
                    continue
                if digest is None or k != key:
                    continue
                if not first:
                    digest.update(b",")
                for piece in [text] if part is None else factor_pieces(*part):
                    digest.update(piece.encode("utf-8"))
                first, edges = False, edges + n
            yield pd.DataFrame(done, columns=columns)
        if digest is not None:
            yield pd.DataFrame([(digest.hexdigest(), key, schema_id, edges)], columns=columns)

    return digest_rows


def _parts_digest():
    """The same md5 of gathered mappings: of the schema ids and, by factor, of the lists of all parts."""
    factor_pieces = _factor_pieces()

    def digests(schema_ids: pa.Array, pairwise: pa.Array, outputs: pa.Array, inputs: pa.Array) -> pa.Array:
        done = []
        for schema_id, *parts in zip(*[column.to_pylist() for column in (schema_ids, pairwise, outputs, inputs)]):
            digest = hashlib.md5(schema_id.encode("utf-8"))
            for place, part in enumerate(zip(*parts)):
                if place:
                    digest.update(b",")
                for piece in factor_pieces(*part):
                    digest.update(piece.encode("utf-8"))
            done.append(digest.hexdigest())
        return pa.array(done, pa.string())

    return F.arrow_udf(digests, "string")


def lineages(edges: DataFrame, outputs: DataFrame | None = None) -> DataFrame:
    """(id, lineage_key, schema_id, n_edges): md5 of the output schema's id followed by the edges.

    `edges` are rows of edges or of factors; the id is the same. An md5 depends on all bytes before, so one lineage must be
    hashed in order. Texts are built in parallel (those of factors piece by piece, as they are hashed) and streamed,
    sorted, through a running digest: nothing is collected, memory does not grow with the lineage. The row of the output
    schema comes first (order -1), so a lineage without edges has an id as well. Edges of a `lineage_key` that no output has
    are left out. A gathered mapping needs no `outputs`; each row gets its id where it lies.
    """
    if "parts" in edges.columns:
        n_edges = F.aggregate("parts", F.lit(0).cast("long"), lambda n, p: n + F.size(p["outputs"]))
        return edges.withColumn("id", _parts_digest()("schema_id", "parts.pairwise", "parts.outputs", "parts.inputs")).withColumn("n_edges", n_edges)
    heads = outputs.select(
        "lineage_key", F.lit(-1).cast("long").alias("input_ord"), F.lit(0).cast("long").alias("n_edges"),
        F.col("schema_id").alias("text"),
    )
    order = F.col("input_ord").cast("long")
    refused = F.raise_error(F.lit("input_ord must not be negative or null")).cast("long")
    factored = "outputs" in edges.columns
    chunks = input_texts(edges) if not factored else edges.select(
        "lineage_key", "input_ord", F.size("outputs").cast("long").alias("n_edges"), F.lit(None).cast("string").alias("text"), "pairwise", "outputs", "inputs")
    chunks = chunks.withColumn("input_ord", F.when(order >= 0, order).otherwise(refused))
    key_type = outputs.schema["lineage_key"].dataType.simpleString()
    ordered = heads.unionByName(chunks, allowMissingColumns=factored).repartition("lineage_key").sortWithinPartitions("lineage_key", "input_ord")
    return ordered.mapInPandas(_chain_digest(), f"id string, lineage_key {key_type}, schema_id string, n_edges long")


def lineage_executions(lineage_rows: DataFrame, runs: DataFrame | None = None) -> DataFrame:
    """Execution rows of lineages; `runs`: lineage_key, app_execution, start_time (ISO text).

    Lineages that come with these columns of their runs need no join and keep their other columns.
    """
    if runs is None:
        joined = lineage_rows.withColumnRenamed("id", "lineage")
    else:
        joined = salted_join(runs, lineage_rows.select("lineage_key", F.col("id").alias("lineage")), "lineage_key")
    rest = [] if runs is not None else [c for c in joined.columns if c not in ("lineage", "app_execution", "start_time")]
    return joined.select(
        md5_key("lineage", "app_execution", "start_time").alias("id"),
        "lineage",
        F.col("app_execution").alias("application_execution"),
        "start_time",
        *rest,
    )
