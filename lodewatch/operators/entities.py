"""Observation entities: rows keyed by the md5 of their natural key.

Natural keys are made distinct before they are hashed, so repeated rows are dropped
on the map side and never reach the hash or the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodewatch.functions.keys import dirty_author, dirty_version, md5_key, md5_of, schema_key, sorted_fields, strip_tmp
from lodewatch.operators.profile import metrics_long_to_map
from lodewatch.operators.skew import salted_join
from lodewatch.session import stored
from lodewatch.sources.tables import FIELD_SCHEMA, field_rows


def entity(df: DataFrame, key: dict[str, Column | str], id_name: str = "id") -> DataFrame:
    """Distinct rows of the key columns with their id in front."""
    parts = df.select(*[(F.col(c) if isinstance(c, str) else c).alias(n) for n, c in key.items()]).distinct()
    return parts.select(md5_key(*key).alias(id_name), *key)


def app_run_rows(run_meta: DataFrame) -> dict[str, DataFrame]:
    """Entity tables of application runs, and `run`, the ids of each run.

    `run_meta`: run_id, app, repo, version, is_dirty, author, user, start. An
    uncommitted version is marked and attributed to the user who runs it.
    """
    author = dirty_author(F.col("author"), F.col("user"), F.col("is_dirty"))
    version = dirty_version(F.col("version"), F.col("is_dirty"))
    run = (
        run_meta.select("run_id", "app", "repo", "user", "start", version.alias("version"), author.alias("author"))
        .withColumn("application", md5_key("app"))
        .withColumn("user_id", md5_key("user"))
        .withColumn("author_id", md5_key("author"))
        .withColumn("repository", md5_key("repo", "application"))
        .withColumn("app_version", md5_key("version", "author_id", "repository"))
        .withColumn("app_execution", md5_key("app_version", "user_id"))
    )

    def table(**columns: str) -> DataFrame:
        return run.select(*[F.col(source).alias(name) for name, source in columns.items()]).distinct()

    people = run.select(F.explode(F.array("user", "author")).alias("name")).distinct()
    return {
        "application": table(id="application", name="app"),
        "app_user": people.select(md5_key("name").alias("id"), "name"),
        "repository": table(id="repository", location="repo", application="application"),
        "app_version": table(id="app_version", version="version", user="author_id", application_repository="repository"),
        "app_execution": table(id="app_execution", application_version="app_version", user="user_id"),
        "run": run.select("run_id", "app_execution", "start"),
    }


def data_sources(df: DataFrame, location: Column | str = "location", source_format: Column | str = "format") -> DataFrame:
    return entity(df, {"location": location, "format": source_format})


def data_sources_on_servers(df: DataFrame, location: Column, server: Column) -> DataFrame:
    """Variant of the key with the server's id in place of the format."""
    return entity(df, {"location": location, "server_id": md5_key(server)})


def schemas(fields: DataFrame, source_key: str = "data_source_id") -> DataFrame:
    """(schema_id, source_key, n_fields) from field rows (source_key, name, dtype).

    A list of fields is as long as a table is wide. Sources may also come with such a list each, `fields`; they need no
    grouping then, and keep their other columns.
    """
    if "fields" in fields.columns:
        named = F.transform("fields", lambda f: F.struct(f["name"], f["dtype"]))
        made = fields.withColumn("schema_id", schema_key(named, source_key)).withColumn("n_fields", F.size("fields"))
        return made.select("schema_id", source_key, "n_fields", *[c for c in fields.columns if c != source_key])
    grouped = fields.groupBy(source_key).agg(F.collect_list(F.struct("name", "dtype")).alias("fields"))
    return grouped.select(
        schema_key("fields", source_key).alias("schema_id"), source_key, F.size("fields").alias("n_fields")
    )


def sort_fields(fields: DataFrame, source_key: str) -> DataFrame:
    """Field rows numbered in the order in which they enter the schema id."""
    grouped = fields.groupBy(source_key).agg(sorted_fields(F.collect_list(F.struct("name", "dtype"))).alias("fields"))
    return grouped.select(source_key, F.posexplode("fields").alias("ord", "f")).select(
        source_key, "ord", F.col("f.name").alias("name"), F.col("f.dtype").alias("dtype")
    )


def schema_fields(df: DataFrame, hints: dict[str, str] | None = None, dtype_style: str = "spark") -> DataFrame:
    """Field rows of a frame; hints override the physical types."""
    return df.sparkSession.createDataFrame(field_rows(df, hints, dtype_style), FIELD_SCHEMA)


def frame_ids(
    df: DataFrame, location: str, source_format: str, hints: dict[str, str] | None = None, dtype_style: str = "spark"
) -> tuple[str, str, list[tuple]]:
    """(data source id, schema id, field rows) of one frame."""
    rows = field_rows(df, hints, dtype_style)
    source_id = md5_of(location, source_format)
    listed = ",".join(f"{name}-{dtype}" for name, dtype in sorted((r[1], r[2]) for r in rows))
    return source_id, md5_of(listed, source_id), rows


def sensitive_fields(fields: DataFrame, meta: str = "meta") -> DataFrame:
    """Fields whose JSON metadata says `sensitive: true`."""
    return fields.where(F.get_json_object(meta, "$.sensitive") == "true").drop(meta)


def schema_changes(schema_rows: DataFrame) -> DataFrame:
    """(data_source_id, n_schemas): how many schemas a source has had."""
    return schema_rows.groupBy("data_source_id").agg(F.count_distinct("schema_id").alias("n_schemas"))


def unify_sources(names: DataFrame, name: str = "name") -> DataFrame:
    """Temporary and final names are one source: distinct final names."""
    return names.select(strip_tmp(name).alias(name)).distinct()


def resolve_executions(lineage_execution: DataFrame, entities: dict[str, DataFrame]) -> DataFrame:
    """Every lineage execution with its application, repository, version, author and user.

    The descriptive tables are joined with each other first; they grow with code and
    people, not with data. Spark broadcasts each of them as long as its measured size
    is below the broadcast threshold.
    """
    user = entities["app_user"].select(F.col("id").alias("user"), F.col("name").alias("user_name"))
    author = entities["app_user"].select(F.col("id").alias("author"), F.col("name").alias("author_name"))
    repo = entities["repository"].join(
        entities["application"].select(F.col("id").alias("application"), F.col("name").alias("application_name")),
        "application", "left",
    ).select(F.col("id").alias("application_repository"), F.col("location").alias("repository_location"), "application_name")
    version = (
        entities["app_version"].withColumnRenamed("user", "author")
        .join(repo, "application_repository", "left").join(author, "author", "left")
        .select(F.col("id").alias("application_version"), "version", "author_name", "repository_location", "application_name")
    )
    execution = (
        entities["app_execution"].join(version, "application_version", "left").join(user, "user", "left")
        .select(
            F.col("id").alias("application_execution"),
            "version", "author_name", "repository_location", "application_name", "user_name",
        )
    )
    return salted_join(lineage_execution, execution, "application_execution", "left")


def resolve_refs(
    metrics: DataFrame, schema: DataFrame, data_source: DataFrame, executions: DataFrame
) -> DataFrame:
    """One wide fact row per metric.

    `metrics`: metrics_id, schema_id, lineage_execution_id, field, stat, value;
    `executions`: result of `resolve_executions`. The facts are shuffled twice at most: on the
    schema and on the execution. They are read once more to find hot keys, so they had better be a
    stored table.
    """
    located = schema.select("schema_id", "data_source_id").join(
        data_source.select(F.col("id").alias("data_source_id"), "location", "format"), "data_source_id", "left"
    )
    runs = executions.withColumnRenamed("id", "lineage_execution_id")
    with_location = salted_join(metrics, located, "schema_id", "left")
    return salted_join(with_location, runs, "lineage_execution_id", "left", counted=metrics)


def metric_uses(
    lineage_execution: DataFrame, inputs: DataFrame, outputs: DataFrame
) -> DataFrame:
    """(schema_id, lineage_execution_id) for every schema an execution read or wrote."""
    runs = lineage_execution.select(F.col("id").alias("lineage_execution_id"), F.col("lineage").alias("lineage_id"))
    read = inputs.select("lineage_id", F.col("input_schema_id").alias("schema_id"))
    written = outputs.select("lineage_id", "schema_id")
    uses = salted_join(runs, read.unionByName(written).distinct(), "lineage_id")
    return uses.select("schema_id", "lineage_execution_id")


def keyed_uses(uses: DataFrame, *rest: str) -> DataFrame:
    """Uses, with columns `rest`, and the id of the metrics of that schema in that execution, made before metrics multiply the rows."""
    return uses.select(md5_key("schema_id", "lineage_execution_id").alias("metrics_id"), "schema_id", "lineage_execution_id", *rest)


def metric_lists(metrics: DataFrame, key: str) -> DataFrame:
    """(key, metrics): the metrics of a schema as one list of (field, stat, value), as long as a table has metrics."""
    return metrics.groupBy(key).agg(F.collect_list(F.struct("field", "stat", "value")).alias("metrics"))


def listed_stats(fields: Column | str, stats: Sequence[str]) -> Column:
    """The statistics `stats` that a field list holds, as a list of (field, stat, value)."""
    def of(f: Column) -> Column:
        return F.array(*[F.struct(f["name"].alias("field"), F.lit(s).alias("stat"), f[s].alias("value")) for s in stats])

    return F.flatten(F.transform(fields, of))


def metrics_rows(metrics: DataFrame, uses: DataFrame, listed: bool = False) -> DataFrame:
    """Attaches the metrics of a schema, taken once, to every execution that used it.

    `metrics` are rows (schema_id, field, stat, value) or `metric_lists`, of which the join moves one row per use; with
    `listed` they stay lists in the result. `uses` is read once more to find the schemas that very many executions use.
    """
    facts = salted_join(keyed_uses(uses), metrics, "schema_id", counted=uses)
    value = ["metrics"] if listed else [F.inline("metrics")] if "metrics" in metrics.columns else ["field", "stat", "value"]
    return facts.select("metrics_id", "schema_id", "lineage_execution_id", *value)


def resolved_metrics(metrics: DataFrame, uses: DataFrame, schema: DataFrame, data_source: DataFrame, executions: DataFrame) -> DataFrame:
    """`resolve_refs` of `metrics_rows`: sources and runs are resolved once per use, and only then joined by its many metrics.

    `uses` had better be a stored table; `executions` is the result of `resolve_executions`.
    """
    wide = stored(resolve_refs(keyed_uses(uses), schema, data_source, executions), "resolved-uses")
    joined = salted_join(wide, metrics, "schema_id")
    return joined.select(*[c for c in joined.columns if c != "metrics"], F.inline("metrics")) if "metrics" in metrics.columns else joined


def orphan_metrics(metrics: DataFrame, lineage_execution: DataFrame) -> DataFrame:
    """Metrics that no known lineage execution explains.

    Also of uses, before their metrics multiply them: the metrics of what is left are the same.
    """
    known = lineage_execution.select(F.col("id").alias("lineage_execution_id"))
    return salted_join(metrics, known, "lineage_execution_id", "left_anti")


def execution_summary(metrics: DataFrame) -> DataFrame:
    """All input and output metrics of an execution, rows or listed: one map per schema it touched."""
    return metrics_long_to_map(metrics, ["lineage_execution_id", "schema_id"])


