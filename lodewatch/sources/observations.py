"""The observation log: one JSON object per line, one shape per entity.

A tagged log has a folder per entity (`entity=schema/...`), each read alone with its own shape. An untagged one mixes all
lines; reading it routes them once, by the keys they hold, into a tagged log.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodewatch.session import work_dir

# The keys of each entity in the log. `fields` and `metrics` are maps,
# `input_schemas_mapping` a list of (schema, {output: [inputs]}).
SHAPES = {
    "application": "id string, name string",
    "app_user": "id string, name string",
    "repository": "id string, location string, application string",
    "app_version": "id string, version string, user string, application_repository string",
    "app_execution": "id string, application_version string, user string",
    "data_source": "id string, location string, format string",
    "schema": "id string, fields map<string,string>, data_source string",
    "lineage": (
        "id string, schema string, "
        "input_schemas_mapping array<struct<schema:string,mapping:map<string,array<string>>>>"
    ),
    "lineage_execution": "id string, lineage string, application_execution string, start_time string",
    "metrics": "id string, metrics map<string,double>, schema string, lineage_execution string",
}

# A record belongs to the first entity whose telling key it holds.
TELLING_KEYS = [
    ("metrics", "metrics"),
    ("lineage_execution", "start_time"),
    ("lineage", "input_schemas_mapping"),
    ("schema", "fields"),
    ("data_source", "format"),
    ("app_execution", "application_version"),
    ("app_version", "application_repository"),
    ("repository", "application"),
    ("named", "name"),
]


def to_log_lines(entities: DataFrame) -> DataFrame:
    return entities.select(F.to_json(F.struct("*")).alias("value"))


def write_observations(entities: DataFrame, path: str) -> None:
    """Appends the rows of an entity frame to the log as JSON lines."""
    to_log_lines(entities).write.mode("append").text(path)


def write_tagged(entities: dict[str, DataFrame], path: str) -> None:
    """Appends the rows of several entities to a tagged log, in one job."""
    unknown = set(entities) - set(SHAPES)
    if unknown:
        raise ValueError(f"no entities of the log: {sorted(unknown)}")
    lines = [to_log_lines(rows).withColumn("entity", F.lit(name)) for name, rows in entities.items()]
    reduce(DataFrame.unionByName, lines).write.partitionBy("entity").mode("append").text(path)


def read_tagged(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """One frame per entity of a tagged log; each reads its own folder only."""
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def rows(name: str, shape: str) -> DataFrame:
        folder = f"{path.rstrip('/')}/entity={name}"
        if not files.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)):
            return spark.createDataFrame([], shape)
        return spark.read.schema(shape).json(folder)

    return {name: rows(name, shape) for name, shape in [*SHAPES.items(), ("named", SHAPES["app_user"])]}


def route_log(lines: DataFrame, path: str) -> None:
    """Writes untagged lines to a tagged log in one pass; rows of id and name, which may be either, to `named`."""
    keys = F.json_object_keys("value")
    entity = F.coalesce(*[F.when(F.array_contains(keys, key), F.lit(name)) for name, key in TELLING_KEYS])
    lines.select("value", entity.alias("entity")).where("entity is not null").write.partitionBy("entity").text(path)


def read_observations(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """Reads an untagged log back: one frame per entity.

    Users and applications have the same shape; those that versions and runs name as a user come back under `app_user`,
    those that a repository names, and those that nothing names, under `application`.
    """
    routed = work_dir(spark, "routed-log")
    route_log(spark.read.text(path), routed)
    found = read_tagged(spark, routed)
    named = found.pop("named")
    users = found["app_version"].select("user").union(found["app_execution"].select("user")).distinct()
    owners = found["repository"].select("application").distinct()
    is_user, is_owner = named["id"] == users["user"], named["id"] == owners["application"]
    found["app_user"] = named.join(users, is_user, "left_semi")
    told = named.join(users, is_user, "left_anti").join(owners, is_owner, "left_anti")
    found["application"] = named.join(owners, is_owner, "left_semi").unionByName(told)
    return found
