"""Observed reads and writes: a job's own frames, with everything about them logged."""

from __future__ import annotations

import datetime
import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodewatch.functions.keys import DIRTY_SUFFIX, md5_of
from lodewatch.operators import transform
from lodewatch.operators.entities import frame_ids
from lodewatch.operators.profile import (
    default_registry,
    describe,
    metrics_long_to_map,
    observe_frame_metrics,
    observed_rows,
    profile_table,
)
from lodewatch.sources.observations import write_observations
from lodewatch.sources.tables import FIELD_SCHEMA


@dataclass(frozen=True)
class FrameObservation:
    data_source_id: str
    schema_id: str
    metrics_id: str
    fields: DataFrame
    metrics: DataFrame


def observe_frame(
    df: DataFrame, location: str, fmt: str, hints: dict[str, str] | None = None, dtype_style: str = "spark", skip_first: bool = False
) -> FrameObservation:
    """Source, schema and descriptive metrics of one frame, outside of any run.

    Without a lineage execution the metrics are keyed by their schema alone.
    """
    source_id, schema_id, rows = frame_ids(df, location, fmt, hints, dtype_style)
    fields = df.sparkSession.createDataFrame(rows, FIELD_SCHEMA)
    return FrameObservation(source_id, schema_id, md5_of(schema_id), fields, describe(df, skip_first=skip_first))


@dataclass(frozen=True)
class Source:
    """An observed input: where it lies, its ids, its fields in order."""

    location: str
    format: str
    data_source_id: str
    schema_id: str
    fields: tuple[tuple[str, str], ...]
    frame: DataFrame


@dataclass(frozen=True)
class ObservedFrame:
    """A frame and the inputs it was made from."""

    df: DataFrame
    inputs: tuple[Source, ...]

    def transform(self, step: Callable[[DataFrame], DataFrame]) -> ObservedFrame:
        return replace(self, df=step(self.df))

    @staticmethod
    def concat(frames: Sequence[ObservedFrame]) -> ObservedFrame:
        return ObservedFrame(transform.concat([f.df for f in frames]), _once(frames))

    def join(self, other: ObservedFrame, *args, **kwargs) -> ObservedFrame:
        return ObservedFrame(self.df.join(other.df, *args, **kwargs), _once([self, other]))


def _once(frames: Sequence[ObservedFrame]) -> tuple[Source, ...]:
    """Inputs of several frames, each frame once, in order; one location may be read as several frames."""
    return tuple({(s.schema_id, id(s.frame)): s for f in frames for s in f.inputs}.values())


class ObservedSession:
    """One application run. Reads and writes through it append to the observation log.

    The log holds `entities` (JSON lines) and `metrics` (long rows, Parquet). Inputs are profiled
    once per run and schema, whatever the number of outputs; an output is profiled while it is written.
    """

    def __init__(
        self,
        spark: SparkSession,
        log: str,
        app: str,
        repo: str,
        version: str,
        author: str,
        user: str,
        is_dirty: bool = False,
        start: datetime.datetime | None = None,
        profile_inputs: bool = True,
        dtype_style: str = "spark",
    ):
        self.spark, self.log, self.dtype_style = spark, log, dtype_style
        self.profile_inputs = profile_inputs
        self._unexported: set[str] = set()  # runs whose metrics are not in the entity log yet
        self.start = (start or datetime.datetime.now()).isoformat()
        if is_dirty:
            version, author = version + DIRTY_SUFFIX, user
        app_id, author_id, user_id = md5_of(app), md5_of(author), md5_of(user)
        repo_id = md5_of(repo, app_id)
        version_id = md5_of(version, author_id, repo_id)
        self.execution_id = md5_of(version_id, user_id)
        self._pending: list[tuple[str]] = []
        self._emit(id=app_id, name=app)
        for person, name in {author_id: author, user_id: user}.items():
            self._emit(id=person, name=name)
        self._emit(id=repo_id, location=repo, application=app_id)
        self._emit(id=version_id, version=version, user=author_id, application_repository=repo_id)
        self._emit(id=self.execution_id, application_version=version_id, user=user_id)
        self._profiled: dict[str, DataFrame] = {}

    def _emit(self, **columns) -> None:
        """Takes one entity row; the rows of a read or write go to the log together."""
        self._pending.append((json.dumps(columns, separators=(",", ":"), ensure_ascii=False),))

    def flush(self) -> None:
        """Appends the entities taken so far, a few rows per observed write, to the log."""
        if self._pending:
            lines = self.spark.createDataFrame(self._pending, "value string").coalesce(1)
            lines.write.mode("append").text(f"{self.log}/entities")
            self._pending = []

    def _emit_source(self, df: DataFrame, location: str, fmt: str, hints: dict[str, str] | None) -> Source:
        source_id, schema_id, rows = frame_ids(df, location, fmt, hints, self.dtype_style)
        fields = tuple((r[1], r[2]) for r in rows)
        self._emit(id=source_id, location=location, format=fmt)
        self._emit(id=schema_id, fields=dict(fields), data_source=source_id)
        return Source(location, fmt, source_id, schema_id, fields, df)

    def read(
        self, path: str, fmt: str | None = None, schema=None, hints: dict[str, str] | None = None, **options
    ) -> ObservedFrame:
        """Reads a dataset; its format is the text after the last dot when none is given."""
        fmt = fmt or path[path.rfind(".") + 1 :]
        reader = self.spark.read.format(fmt).options(**options)
        df = (reader.schema(schema) if schema is not None else reader).load(path)
        return self.observe(df, path, fmt, hints)

    def observe(self, df: DataFrame, location: str, fmt: str, hints: dict[str, str] | None = None) -> ObservedFrame:
        """Takes a frame as an input of the run: its source and schema are logged."""
        return ObservedFrame(df, (self._emit_source(df, location, fmt, hints),))

    def write(
        self,
        frame: ObservedFrame,
        path: str,
        fmt: str | None = None,
        extra: dict[str, dict[str, list[str]]] | None = None,
        mode: str = "overwrite",
        **options,
    ) -> str:
        """Writes the frame and logs source, schema, lineage, run and metrics; returns the run's id.

        `extra` maps an input location to {output field: [input fields]}, on top of equal names.
        """
        fmt = fmt or path[path.rfind(".") + 1 :]
        observed, seen, entries = observe_frame_metrics(frame.df)
        observed.write.format(fmt).mode(mode).options(**options).save(path)
        target = self._emit_source(frame.df, path, fmt, None)

        mapping = self._mapping(frame, target, extra or {})
        lineage_id = md5_of(
            target.schema_id + ",".join(f"{o}:{'-'.join(i)}" for _, m in mapping for o, i in m.items())
        )
        inputs = [{"schema": s.schema_id, "mapping": m} for s, m in mapping]
        self._emit(id=lineage_id, schema=target.schema_id, input_schemas_mapping=inputs)
        run_id = md5_of(lineage_id, self.execution_id, self.start)
        self._emit(id=run_id, lineage=lineage_id, application_execution=self.execution_id, start_time=self.start)
        self.flush()
        if self.profile_inputs:
            for source in frame.inputs:
                self._emit_metrics(self._input_profile(source), source.schema_id, run_id)
        self._emit_metrics(observed_rows(frame.df, seen, entries), target.schema_id, run_id)
        return run_id

    @staticmethod
    def _mapping(frame: ObservedFrame, target: Source, extra: dict[str, dict[str, list[str]]]):
        """(source, {output: [inputs]}) of the inputs that feed any output field; a frame's width at most."""
        written = {name for name, _ in target.fields}
        found = []
        for source in frame.inputs:
            same = {name: [name] for name, _ in source.fields if name in written}
            same.update(extra.get(source.location, {}))
            if same:
                found.append((source, same))
        return found

    def _input_profile(self, source: Source) -> DataFrame:
        """Profile of an input, computed once and kept as a written table."""
        key = source.schema_id, id(source.frame)
        if key not in self._profiled:
            path = f"{self.log}/profiles/{source.schema_id}-{self.execution_id}-{len(self._profiled)}"
            profile_table(source.frame, registry=default_registry()).write.mode("overwrite").parquet(path)
            self._profiled[key] = self.spark.read.parquet(path)
        return self._profiled[key]

    def _emit_metrics(self, metrics: DataFrame, schema_id: str, run_id: str) -> None:
        rows = metrics.select(
            F.lit(md5_of(schema_id, run_id)).alias("metrics_id"),
            F.lit(schema_id).alias("schema_id"),
            F.lit(run_id).alias("lineage_execution_id"),
            "field", "stat", "value",
        )
        rows.write.mode("append").parquet(f"{self.log}/metrics")
        self._unexported.add(run_id)

    def metrics(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.log}/metrics")

    def export_metrics(self) -> None:
        """Appends this session's metrics to the entity log as JSON lines, one object per schema and run, each once."""
        keys = ["metrics_id", "schema_id", "lineage_execution_id"]
        runs, self._unexported = sorted(self._unexported), set()
        if not runs:
            return
        maps = metrics_long_to_map(self.metrics().where(F.col("lineage_execution_id").isin(runs)), keys)
        lines = maps.select(
            F.col("metrics_id").alias("id"), "metrics", F.col("schema_id").alias("schema"),
            F.col("lineage_execution_id").alias("lineage_execution"),
        )
        write_observations(lines, f"{self.log}/entities")
