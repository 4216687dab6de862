"""Profilers: the metrics of a table, as one long frame (field, stat, value)."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodewatch.functions.keys import quoted
from lodewatch.operators.quantiles import numbers_of, quantiles_of, sketch_aggregates

NUMERIC, TEMPORAL, BOOLEAN, STRING, OTHER = "numeric", "temporal", "boolean", "string", "other"

QUARTILES = {"25%": 0.25, "50%": 0.5, "75%": 0.75}
APPROX_ACCURACY = 10_000
# Longer texts are told apart by their SHA-256 when they are counted; the prefix keeps a
# digest apart from any short text.
WIDE_TEXT_BYTES = 64


def family(dtype: T.DataType) -> str:
    if isinstance(dtype, T.NumericType):
        return NUMERIC
    if isinstance(dtype, T.DateType | T.TimestampType | T.TimestampNTZType) or dtype.typeName().startswith("time("):
        return TEMPORAL
    if isinstance(dtype, T.BooleanType):
        return BOOLEAN
    if isinstance(dtype, T.StringType):
        return STRING
    return OTHER


def columns_of(df: DataFrame, kind: str, skip_first: bool = False) -> list[str]:
    fields = df.schema.fields[1:] if skip_first else df.schema.fields
    return [f.name for f in fields if family(f.dataType) == kind]


def epoch_millis(value: Column, dtype: T.DataType) -> Column:
    """Epoch milliseconds at second precision, the same in every session time zone."""
    if isinstance(dtype, T.DateType):
        return F.unix_date(value).cast("long") * 86_400_000
    if isinstance(dtype, T.TimestampNTZType):
        seconds = F.hour(value) * 3600 + F.minute(value) * 60 + F.second(value)
        return (F.unix_date(value.cast("date")).cast("long") * 86_400 + seconds) * 1000
    if isinstance(dtype, T.TimestampType):
        return F.unix_seconds(value) * 1000
    return (F.hour(value) * 3600 + F.minute(value) * 60 + F.second(value)).cast("long") * 1000


# --- the registry of single-scan metrics ---------------------------------------------------


@dataclass(frozen=True)
class Metric:
    """An aggregate offered for every column whose type the predicate accepts.

    `aggregate` takes (column, dtype) and returns an aggregate expression; `finish`
    turns its one-row result into the reported number.
    """

    stat: str
    accepts: Callable[[T.DataType], bool]
    aggregate: Callable[[Column], Column]
    finish: Callable[[Column, T.DataType], Column] = field(default=lambda value, dtype: value.cast("double"))


def _is(*kinds: str) -> Callable[[T.DataType], bool]:
    return lambda dtype: family(dtype) in kinds


def _millis(value: Column, dtype: T.DataType) -> Column:
    result = epoch_millis(value, dtype) if family(dtype) == TEMPORAL else value
    return result.cast("double")


class MetricRegistry:
    """Metrics of a profile; users add their own with `register`."""

    def __init__(self, metrics: Sequence[Metric] = ()):
        self.metrics = list(metrics)

    def register(
        self, stat: str, accepts: Callable[[T.DataType], bool] | str, aggregate: Callable[[Column], Column]
    ) -> MetricRegistry:
        """Adds `field.stat`; `accepts` is a type predicate or the name of a type family."""
        predicate = _is(accepts) if isinstance(accepts, str) else accepts
        self.metrics.append(Metric(stat, predicate, aggregate))
        return self

    def copy(self) -> MetricRegistry:
        return MetricRegistry(self.metrics)


def default_registry() -> MetricRegistry:
    nullrows = Metric("nullrows", _is(NUMERIC, TEMPORAL, BOOLEAN, STRING), lambda c: F.count_if(c.isNull()))
    return MetricRegistry(
        [
            Metric("min", _is(NUMERIC, TEMPORAL), F.min, _millis),
            Metric("max", _is(NUMERIC, TEMPORAL), F.max, _millis),
            Metric("mean", _is(NUMERIC), F.avg),
            Metric("true", _is(BOOLEAN), F.count_if),
            nullrows,
        ]
    )


def long_form(wide: DataFrame, entries: Sequence[tuple[str, str, Column]]) -> DataFrame:
    """A one-row (or one row per group) frame of aggregates -> rows (field, stat, value)."""
    rows = [
        F.struct(F.lit(f).alias("field"), F.lit(s).alias("stat"), v.cast("double").alias("value")) for f, s, v in entries
    ]
    keys = [c for c in wide.columns if not c.startswith("_m")]
    return wide.select(*keys, F.inline(F.array(*rows)))


def profile_aggregates(
    df: DataFrame, registry: MetricRegistry, columns: Sequence[str], leave_out: Sequence[tuple[str, str]] = ()
):
    """(aggregate expressions, long-form entries) of one scan; `leave_out` lists (field, stat) pairs."""
    aggs: list[Column] = [F.count(F.lit(1)).alias("_m_nrows")]
    entries: list[tuple[str, str, Column]] = [("", "nrows", F.col("_m_nrows"))]
    for name in columns:
        dtype = df.schema[name].dataType
        is_float = isinstance(dtype, T.FloatType | T.DoubleType)
        source = F.when(~F.isnan(quoted(name)), quoted(name)) if is_float else quoted(name)
        for m in registry.metrics:
            if m.accepts(dtype) and (name, m.stat) not in leave_out:
                alias = f"_m{len(aggs)}"
                aggs.append(m.aggregate(source).alias(alias))
                entries.append((name, m.stat, m.finish(F.col(alias), dtype)))
    return aggs, entries


def profile_table(
    df: DataFrame,
    where: Sequence[Column] = (),
    registry: MetricRegistry | None = None,
    levels: str = "exact",
    null_as_zero: bool = False,
    skip_first: bool = False,
) -> DataFrame:
    """Type-driven metrics of a table: (field, stat, value), `nrows` with an empty field.

    All single-scan metrics are one aggregate without Expand. Text columns are read by
    the distinct count instead, which also yields their null count: every column is
    read once. `levels="approx"` moves them into the single scan with a sketch;
    `levels="none"` leaves the distinct count out.
    """
    for p in where:
        df = df.where(p)
    registry = registry or default_registry()
    names = [c.name for c in (df.schema.fields[1:] if skip_first else df.schema.fields)]
    texts = [c for c in names if family(df.schema[c].dataType) == STRING] if levels == "exact" else []
    if levels == "approx":
        registry = registry.copy().register("levels", STRING, F.approx_count_distinct)
    aggs, entries = profile_aggregates(df, registry, names, leave_out=[(c, "nullrows") for c in texts])
    result = long_form(df.agg(*aggs), entries)
    if texts:
        result = result.unionByName(text_levels(df, texts))
    if null_as_zero:
        return result.withColumn("value", F.coalesce("value", F.lit(0.0)))
    return drop_nan_metrics(result)


def drop_nan_metrics(metrics: DataFrame) -> DataFrame:
    """Keeps the metrics that hold a number."""
    return metrics.where(F.col("value").isNotNull() & ~F.isnan("value"))


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(field, value, n) of text-like columns, NULL included; wide texts by their digest.

    Counting is partial before the shuffle, so a value held by a third of the rows
    travels as one row per task.
    """
    texts = df.select(*[countable(quoted(c).cast("string")).alias(c) for c in columns])
    long = texts.unpivot([], [quoted(c) for c in columns], "field", "value")
    return long.groupBy("field", "value").agg(F.count("*").alias("n"))


def countable(text: Column) -> Column:
    wide = F.concat(F.lit("sha256:"), F.sha2(text, 256))
    return F.when(F.octet_length(text) > WIDE_TEXT_BYTES, wide).otherwise(text)


def text_levels(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exact distinct count (`levels`) and null count of text columns."""
    per_field = value_counts(df, columns).groupBy("field").agg(
        F.count("value").alias("_m_levels"),
        F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0)).alias("_m_nullrows"),
    )
    return _spread(df, per_field, columns, {"levels": F.col("_m_levels"), "nullrows": F.col("_m_nullrows")})


def _spread(df: DataFrame, per_field: DataFrame, columns: Sequence[str], stats: dict[str, Column]) -> DataFrame:
    """(field, stat, value) of per-field aggregates; an empty table has zeros, not missing rows."""
    every = df.sparkSession.createDataFrame([(c,) for c in columns], "field string")
    rows = F.array(
        *[F.struct(F.lit(s).alias("stat"), F.coalesce(v.cast("double"), F.lit(0.0)).alias("value")) for s, v in stats.items()]
    )
    return every.join(per_field, "field", "left").select("field", F.inline(rows))


# --- profiles of one type family -------------------------------------------------------------


def _family_profile(df: DataFrame, kind: str, stats: Sequence[str], columns: Sequence[str] | None) -> DataFrame:
    wanted = MetricRegistry([m for m in default_registry().metrics if m.stat in stats])
    names = columns_of(df, kind) if columns is None else list(columns)
    aggs, entries = profile_aggregates(df, wanted, names)
    return drop_nan_metrics(long_form(df.agg(*aggs[1:]), entries[1:]))


def profile_numeric(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return _family_profile(df, NUMERIC, ["min", "max", "mean", "nullrows"], columns)


def profile_temporal(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return _family_profile(df, TEMPORAL, ["min", "max", "nullrows"], columns)


def profile_boolean(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return _family_profile(df, BOOLEAN, ["true", "nullrows"], columns)


def profile_string(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return text_levels(df, columns_of(df, STRING) if columns is None else list(columns))


# --- descriptive statistics --------------------------------------------------------------------


def describe_numeric(df: DataFrame, columns: Sequence[str] | None = None, quantiles: str = "exact") -> DataFrame:
    """count, mean, std, min, 25%, 50%, 75%, max of numeric columns, NaN counted as missing.

    Moments and a KLL sketch of each column come from one read. The sketch holds all values of a small column; of a larger
    one it brackets the quartiles, which a second read finds exactly (`operators.quantiles`).
    `quantiles="approx"` takes a sketch's word for them. The rows, a few per column, are kept on the driver.
    """
    names = columns_of(df, NUMERIC) if columns is None else list(columns)
    schema = "field string, stat string, value double"
    if not names:
        return df.sparkSession.createDataFrame([], schema)
    probs, numbers = list(QUARTILES.values()), numbers_of(df, names)
    plain = {"mean": F.avg, "std": F.stddev_samp}
    if quantiles != "exact":
        plain |= {"count": F.count, "min": F.min, "max": F.max}
    aggs = [agg(c).alias(f"{c}_{stat}") for c in numbers.columns for stat, agg in plain.items()]
    if quantiles == "exact":
        aggs += sketch_aggregates(numbers, probs)
    else:
        aggs += [F.percentile_approx(c, probs, APPROX_ACCURACY).alias(f"{c}_q") for c in numbers.columns]
    row = numbers.agg(*aggs).first()
    rows = [(name, stat, row[f"{c}_{stat}"]) for name, c in zip(names, numbers.columns) for stat in plain]
    if quantiles == "exact":
        for name, c in zip(names, numbers.columns):
            low, high = row[f"{c}_range"] or (None, None)
            rows += [(name, "count", row[f"{c}_n"]), (name, "min", low), (name, "max", high)]
        found = quantiles_of(numbers, row, probs)
    else:
        found = [(i, p, v) for i, c in enumerate(numbers.columns) for p, v in zip(probs, row[f"{c}_q"] or ())]
    label = {p: stat for stat, p in QUARTILES.items()}
    rows += [(names[i], label[p], v) for i, p, v in found]
    numbered = [(field, stat, float(value)) for field, stat, value in rows if value is not None]
    return drop_nan_metrics(df.sparkSession.createDataFrame(numbered, schema))


def describe_categorical(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """count, unique and freq (rows of the most frequent value) of text and boolean columns."""
    names = columns_of(df, STRING) + columns_of(df, BOOLEAN) if columns is None else list(columns)
    per_field = value_counts(df, names).where("value is not null").groupBy("field").agg(
        F.sum("n").alias("_m_count"), F.count("*").alias("_m_unique"), F.max("n").alias("_m_freq")
    )
    stats = {"count": F.col("_m_count"), "unique": F.col("_m_unique"), "freq": F.col("_m_freq")}
    spread = _spread(df, per_field, names, stats)
    # An all-null column has no most frequent value.
    return spread.where(~((F.col("stat") == "freq") & (F.col("value") == 0)))


def freq_top1(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return describe_categorical(df, columns).where("stat = 'freq'")


def describe_datetime(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Only the count is a number; the dates themselves are not reported here."""
    names = columns_of(df, TEMPORAL) if columns is None else list(columns)
    aggs = [F.count(quoted(c)).alias(f"_m{i}") for i, c in enumerate(names)]
    return long_form(df.agg(*aggs), [(c, "count", F.col(f"_m{i}")) for i, c in enumerate(names)])


def describe(df: DataFrame, skip_first: bool = False, quantiles: str = "exact") -> DataFrame:
    """Descriptive statistics of all columns; `skip_first` leaves the first column out."""
    kept = df.select(*[quoted(c) for c in df.columns[1:]]) if skip_first else df
    parts = []
    if columns_of(kept, NUMERIC):
        parts.append(describe_numeric(kept, quantiles=quantiles))
    if columns_of(kept, STRING) or columns_of(kept, BOOLEAN):
        parts.append(describe_categorical(kept))
    if columns_of(kept, TEMPORAL):
        parts.append(describe_datetime(kept))
    if not parts:
        return df.sparkSession.createDataFrame([], "field string, stat string, value double")
    return reduce(DataFrame.unionByName, parts)


# --- metrics taken while a frame is read or written ------------------------------------------


def observe_frame_metrics(df: DataFrame, name: str | None = None) -> tuple[DataFrame, Observation, list]:
    """The frame with default metrics observed in flight: count, nulls, min and max.

    Returns (frame, observation, entries) for `observed_rows`. Take it on the frame that
    is written, with no shuffle after it: Spark counts a result task once, but may run a
    map task again when an executor is lost and would then count its rows twice.
    """
    registry = MetricRegistry([m for m in default_registry().metrics if m.stat in ("min", "max", "nullrows", "true")])
    aggs, entries = profile_aggregates(df, registry, df.columns)
    seen = Observation(name) if name else Observation()
    return df.observe(seen, *aggs), seen, entries


def observed_rows(df: DataFrame, seen: Observation, entries: list) -> DataFrame:
    """(field, stat, value) of an observation, once its action has run."""
    values = seen.get
    schema = T.StructType(
        [T.StructField("_m_nrows", T.LongType())]
        + [T.StructField(f"_m{i}", _observed_type(df, f, s)) for i, (f, s, _v) in enumerate(entries) if i > 0]
    )
    wide = df.sparkSession.createDataFrame([tuple(values[f.name] for f in schema)], schema)
    return drop_nan_metrics(long_form(wide, entries))


def _observed_type(df: DataFrame, name: str, stat: str) -> T.DataType:
    return df.schema[name].dataType if stat in ("min", "max") else T.LongType()


# --- long metrics to a map -----------------------------------------------------------------------


def metrics_long_to_map(metrics: DataFrame, keys: Sequence[str], name: str = "metrics", order: str | None = None) -> DataFrame:
    """One map `field.stat -> value` per key; as many entries as a table has metrics.

    Of repeated metrics the later one holds: by the column `order` if there is one, else the larger value. `metrics` may also
    hold them in a list of (field, stat, value) named `metrics`, without an order.
    """
    def labelled(field: Column, stat: Column) -> Column:
        return F.when(field == "", stat).otherwise(F.concat_ws(".", field, stat))

    if "metrics" in metrics.columns:
        if order:
            raise ValueError("lists of metrics have no order")
        entries = F.transform(F.flatten(F.collect_list("metrics")), lambda m: F.struct(labelled(m["field"], m["stat"]).alias("key"), m["value"].alias("value")))
        rows = metrics.groupBy(*keys).agg(entries.alias("_e")).withColumn("_e", F.array_sort("_e"))
        last = F.filter("_e", lambda e, i: (i == F.size("_e") - 1) | (F.get("_e", i + 1)["key"] != e["key"]))
        return rows.select(*keys, F.map_from_entries(last).alias(name))
    label = labelled(F.col("field"), F.col("stat"))
    later = F.max_by("value", order) if order else F.max("value")
    once = metrics.groupBy(*keys, label.alias("key")).agg(later.alias("value"))
    entry = F.struct("key", "value")
    return once.groupBy(*keys).agg(F.map_from_entries(F.array_sort(F.collect_list(entry))).alias(name))


def read_vs_copied(read: DataFrame, copied: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Both metric sets side by side: read, copied, and copied - read (missing counts as 0)."""
    r = read.select(*keys, F.col("value").alias("read"))
    c = copied.select(*keys, F.col("value").alias("copied"))
    delta = F.coalesce("copied", F.lit(0.0)) - F.coalesce("read", F.lit(0.0))
    return r.join(c, list(keys), "full_outer").withColumn("delta", delta)
