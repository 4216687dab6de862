"""Linear models as observed steps: split, fit, score, persist, metrics, lineage.

Models of groups are rows. Their Gram matrices (sums of products of the features, a constant and the label) come from one partial
aggregation, may be stored and added to those of other batches, and are solved per row in tasks.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodewatch.functions.keys import quoted
from lodewatch.operators.profile import long_form
from lodewatch.operators.skew import salted_join
from lodewatch.session import small_enough, stored

TEST_PERCENT = 33


def split_train_test(df: DataFrame, key: Column | str | None = None, test_percent: int = TEST_PERCENT, seed: int = 0) -> DataFrame:
    """Adds `part`, 'train' or 'test'.

    The part of a row depends on its key alone (the whole row when no key is given), so it
    is the same when a lost task runs again. A Column key is taken as a number of 0 to 99.
    """
    if isinstance(key, Column):
        bucket = key
    else:
        columns = [quoted(key)] if key else [quoted(c) for c in df.columns]
        bucket = F.pmod(F.xxhash64(F.lit(seed), *columns), F.lit(100))
    return df.withColumn("part", F.when(bucket < 100 - test_percent, "train").otherwise("test"))


def assemble(df: DataFrame, features: Sequence[str], output: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(features), outputCol=output, handleInvalid="skip").transform(df)


def fit_linear(df: DataFrame, features: Sequence[str], label: str) -> LinearRegressionModel:
    """Ordinary least squares with intercept, from one pass of normal equations."""
    solver = LinearRegression(featuresCol="features", labelCol=label, regParam=0.0, solver="normal", standardization=False)
    return solver.fit(assemble(df.dropna(subset=[label, *features]), features).select("features", label))


def _products(features: Sequence[str], label: str) -> list[Column]:
    """Products of all pairs of (1, features, label), the upper triangle row by row."""
    parts = [F.lit(1.0), *[quoted(c).cast("double") for c in (*features, label)]]
    return [a * b for i, a in enumerate(parts) for b in parts[i:]]


def gram(df: DataFrame, features: Sequence[str], label: str, groups: Sequence[str] = ()) -> DataFrame:
    """(groups, gram): the upper triangle of each group's Gram matrix of (1, features, label); rows with a null are left out."""
    whole = df.dropna(subset=[label, *features])
    sums = whole.groupBy(*groups).agg(*[F.sum(p).alias(f"_g{i}") for i, p in enumerate(_products(features, label))])
    entries = [c for c in sums.columns if c.startswith("_g")]
    return sums.where(F.col(entries[0]).isNotNull()).select(*groups, F.array(*entries).alias("gram"))


def added_grams(grams: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    """Sums of stored Gram matrices: those of all their rows together."""
    entries = grams.select(*groups, F.posexplode("gram").alias("_i", "_v"))
    summed = entries.groupBy(*groups, "_i").agg(F.sum("_v").alias("_v"))
    rows = summed.groupBy(*groups).agg(F.array_sort(F.collect_list(F.struct("_i", "_v"))).alias("_g"))
    return rows.select(*groups, F.col("_g._v").alias("gram"))


def solve_grams(grams: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    """(groups, n, intercept, weights, rss, r2): least squares of each Gram matrix, the shortest solution if it is singular."""
    kept = list(groups)

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for flat in batch["gram"]:
                size = int((np.sqrt(8 * len(flat) + 1) - 1) / 2)
                full = np.zeros((size, size))
                full[np.triu_indices(size)] = flat
                full = full + np.triu(full, 1).T
                n, mean = full[0, 0], full[0] / full[0, 0]
                centred = full - n * np.outer(mean, mean)  # sums about the means: better conditioned
                scale = np.sqrt(np.maximum(np.diag(centred)[1:-1], 0))
                scale[scale == 0] = 1.0
                weights = np.linalg.pinv(centred[1:-1, 1:-1] / np.outer(scale, scale), hermitian=True) @ (centred[1:-1, -1] / scale) / scale
                total = centred[-1, -1]
                rss = max(0.0, total - weights @ centred[1:-1, -1])
                rows.append((int(n), float(mean[-1] - weights @ mean[1:-1]), weights.tolist(), float(rss), float(1 - rss / total) if total > 0 else None))
            made = pd.DataFrame(rows, columns=["n", "intercept", "weights", "rss", "r2"])
            yield pd.concat([batch[kept].reset_index(drop=True), made], axis=1)

    keys = "".join(f"`{c}` {grams.schema[c].dataType.simpleString()}, " for c in groups)
    return grams.mapInPandas(solve, f"{keys}n bigint, intercept double, weights array<double>, rss double, r2 double")


def fit_linear_groups(df: DataFrame, features: Sequence[str], label: str, groups: Sequence[str] = ()) -> DataFrame:
    """(groups, n, intercept, weights, rss, r2): one linear model of several features per group."""
    return solve_grams(gram(df, features, label, groups), groups)


def _with_models(df: DataFrame, models: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Rows with the model of their group.

    The models are written first, so that their size is known before the rows would be shuffled by a few groups: small ones are
    broadcast and the rows stay where they are, others are joined with hot groups salted.
    """
    known = stored(models, "models")
    return df.join(known, list(groups), "left") if small_enough(known) else salted_join(df, known, groups, "left")


def predict_groups(df: DataFrame, fitted: DataFrame, features: Sequence[str], groups: Sequence[str], name: str = "prediction") -> DataFrame:
    """Scores rows with the model of their group; null where it has none."""
    total = F.col("intercept")
    for i, f in enumerate(features):
        total = total + F.get("weights", F.lit(i)) * quoted(f)
    scored = _with_models(df, fitted.select(*groups, "intercept", "weights"), groups)
    return scored.withColumn(name, total).drop("intercept", "weights")


def group_metrics(fitted: DataFrame, groups: Sequence[str]) -> DataFrame:
    """(groups, field, stat, value) of models: parameters, training rows, fit, and smallest and largest weight."""
    stats = [
        ("", "n_parameters", F.size("weights") + 1), ("", "training_rows", F.col("n")), ("", "r2", F.col("r2")),
        ("weight", "min", F.array_min("weights")), ("weight", "max", F.array_max("weights")),
    ]
    rows = F.array(*[F.struct(F.lit(f).alias("field"), F.lit(s).alias("stat"), v.cast("double").alias("value")) for f, s, v in stats])
    return fitted.select(*groups, F.inline(rows)).where("value is not null")


def group_lineages(
    fitted: DataFrame, name: Column, features: Sequence[str], label: str, prediction: str = "prediction", carry: Sequence[str] = ()
) -> DataFrame:
    """Edges (X, y) -> weights and (model, X) -> predictions of each fitted model, in the shape of lineage edges.

    `carry` are columns of the models that come along.
    """
    named = fitted.select(name.alias("_name"), *carry)
    xs, ws = F.array(*[F.lit(f) for f in features]), F.array(F.lit("weights"))

    def edge(kind: str, order: int, schema: Column, output: str, inputs: Column) -> Column:
        return F.struct(
            F.concat(F.lit(kind), F.col("_name")).alias("lineage_key"), F.lit(order).alias("input_ord"), schema.alias("input_schema_id"),
            F.lit(0).alias("edge_ord"), F.lit(output).alias("output_field"), inputs.alias("input_fields"))

    edges = F.array(
        edge("fit:", 0, F.lit("X"), "weights", xs), edge("fit:", 1, F.lit("y"), "weights", F.array(F.lit(label))),
        edge("predict:", 0, F.col("_name"), prediction, ws), edge("predict:", 1, F.lit("X"), prediction, xs))
    return named.select(*carry, F.inline(edges))


def group_params(fitted: DataFrame, features: Sequence[str], label: str, groups: Sequence[str]) -> DataFrame:
    """(groups, param, value): what each group's model was fitted with and on."""
    params = F.create_map(
        F.lit("features"), F.lit(",".join(features)), F.lit("label"), F.lit(label), F.lit("fitIntercept"), F.lit("true"),
        F.lit("solver"), F.lit("normal"), F.lit("training_rows"), F.col("n").cast("string"))
    return fitted.select(*groups, F.explode(params).alias("param", "value"))


def fit_linear_by(df: DataFrame, feature: str, label: str, groups: Sequence[str] = ()) -> DataFrame:
    """(groups, slope, intercept): one line per group, as a plain partial aggregation."""
    return df.groupBy(*groups).agg(
        F.regr_slope(label, feature).alias("slope"), F.regr_intercept(label, feature).alias("intercept")
    )


def predict_linear(df: DataFrame, model: LinearRegressionModel, features: Sequence[str], name: str = "prediction") -> DataFrame:
    """Scores rows with the model's weights as a column expression."""
    terms = [F.lit(float(w)) * quoted(f) for w, f in zip(model.coefficients, features)]
    total = F.lit(float(model.intercept))
    for t in terms:
        total = total + t
    return df.withColumn(name, total)


def predict_linear_by(
    df: DataFrame, lines: DataFrame, feature: str, groups: Sequence[str], name: str = "prediction"
) -> DataFrame:
    """Scores rows with the line of their group."""
    scored = _with_models(df, lines, groups)
    return scored.withColumn(name, F.col("slope") * quoted(feature) + F.col("intercept")).drop("slope", "intercept")


def save_model(model: LinearRegressionModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> LinearRegressionModel:
    return LinearRegressionModel.load(path)


def model_metrics(spark: SparkSession, model: LinearRegressionModel) -> DataFrame:
    """Number of parameters (weights and intercept), smallest and largest weight."""
    weights = spark.createDataFrame([(float(w),) for w in model.coefficients], "weight double")
    wide = weights.agg(
        (F.count("*") + 1).alias("_m_n"), F.min("weight").alias("_m_min"), F.max("weight").alias("_m_max")
    )
    return long_form(
        wide, [("", "n_parameters", F.col("_m_n")), ("weight", "min", F.col("_m_min")), ("weight", "max", F.col("_m_max"))]
    )


def hyper_params(spark: SparkSession, model: LinearRegressionModel) -> DataFrame:
    """Hyper-parameters as rows (param, value)."""
    rows = sorted((p.name, str(v)) for p, v in model.extractParamMap().items())
    return spark.createDataFrame(rows, "param string, value string")


def model_lineages(models: DataFrame, name: str = "model", feature: str = "feature", label: str = "label", prediction: str = "prediction") -> DataFrame:
    """The same edges for a table of fitted lines, one row (name, feature, label) per model, in one job."""
    key = lambda kind: F.concat(F.lit(kind), F.col(name))

    def edge(kind: str, order: int, schema: Column, output: Column, inputs: Column) -> Column:
        return F.struct(
            key(kind).alias("lineage_key"), F.lit(order).alias("input_ord"), schema.alias("input_schema_id"), F.lit(0).alias("edge_ord"),
            output.alias("output_field"), F.array(inputs).alias("input_fields"),
        )

    weights, predicted = F.lit("weights"), F.lit(prediction)
    edges = F.array(
        edge("fit:", 0, F.lit("X"), weights, F.col(feature)), edge("fit:", 1, F.lit("y"), weights, F.col(label)),
        edge("predict:", 0, F.col(name), predicted, weights), edge("predict:", 1, F.lit("X"), predicted, F.col(feature)),
    )
    return models.select(F.explode(edges).alias("e")).select("e.*")


def line_params(df: DataFrame, feature: str, label: str, groups: Sequence[str]) -> DataFrame:
    """(groups, param, value): what each group's line was fitted with and on, and its weights."""
    fitted = df.groupBy(*groups).agg(
        F.regr_count(label, feature).alias("n"), F.regr_slope(label, feature).alias("slope"), F.regr_intercept(label, feature).alias("intercept")
    )
    params = F.create_map(
        F.lit("feature"), F.lit(feature), F.lit("label"), F.lit(label), F.lit("fitIntercept"), F.lit("true"),
        F.lit("training_rows"), F.col("n").cast("string"), F.lit("slope"), F.round("slope", 3).cast("decimal(20,3)").cast("string"),
    )
    return fitted.select(*groups, F.explode(params).alias("param", "value"))
