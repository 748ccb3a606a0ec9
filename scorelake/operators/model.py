"""Logistic regression by distributed Newton steps, with reject inference; only k x k matrices reach the driver.

Levels, assembly and standardisation are Spark ML's.  Each step is one aggregate of the rows: the
loss, its gradient X'W(y - p) and the information X'W p(1 - p) X.  The optimum is found to
TOLERANCE, so rounded coefficients and metrics don't depend on partitions.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.ml import Model, Pipeline, PipelineModel
from pyspark.ml.feature import StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GATE = 0.55
TOLERANCE, MOST_STEPS = 1e-10, 100


class LogitModel(Model):
    """Adds ``_p``, the probability of label 1, by columns of ``_features``; nothing runs in Python."""

    def __init__(self, intercept: float, coefficients: list[float], steps: int):
        super().__init__()
        self.intercept, self.coefficients, self.steps = intercept, coefficients, steps

    def _transform(self, dataset: DataFrame) -> DataFrame:
        x = dataset.withColumn("_x", vector_to_array("_features"))
        return x.withColumn("_p", sigmoid(margin(F.col("_x"), [self.intercept, *self.coefficients]))).drop("_x")


def margin(x: Column, beta: list[float]) -> Column:
    """Intercept (first of ``beta``) and weighted components of an array."""
    return sum((F.lit(float(b)) * x[i] for i, b in enumerate(beta[1:])), F.lit(float(beta[0])))


def sigmoid(m: Column) -> Column:
    return 1 / (1 + F.exp(-m))


def feature_pipeline(numeric: list[str], categorical: list[str]) -> Pipeline:
    """One fitted indexer (codes in level order, unseen levels last), assembled and standardised."""
    coded = [f"_code_{c}" for c in categorical]
    stages = [StringIndexer(inputCols=categorical, outputCols=coded, stringOrderType="alphabetAsc", handleInvalid="keep")] if categorical else []
    return Pipeline(stages=[*stages, VectorAssembler(inputCols=[*numeric, *coded], outputCol="_raw"), StandardScaler(inputCol="_raw", outputCol="_features", withMean=True, withStd=True)])


def prepare(df: DataFrame, numeric: list[str], categorical: list[str], fill: bool = False) -> DataFrame:
    """Rows without null features; with ``fill``, null numbers become 0 and null levels a level of their own."""
    df = df.withColumns({c: F.col(c).cast("double") for c in numeric})
    return df.fillna(0.0, numeric).fillna("", categorical) if fill else df.dropna(subset=[*numeric, *categorical])


def fit_logit(df: DataFrame, numeric: list[str], categorical: list[str], label: str, weight: str | None = None, c: float = 1.0, features: PipelineModel | None = None) -> PipelineModel:
    """L2-regularised fit with inverse strength ``c`` on standardised features; the intercept isn't penalised."""
    df = df.withColumn("_weight", F.col(weight).cast("double") if weight else F.lit(1.0)).withColumn("_label", F.col(label).cast("double"))
    features = features or feature_pipeline(numeric, categorical).fit(df)
    rows = features.transform(df).select(vector_to_array("_features").alias("x"), F.col("_label").alias("y"), F.col("_weight").alias("w")).persist()
    try:
        beta, steps = newton(rows, len(numeric) + len(categorical), 1 / c)
    finally:
        rows.unpersist()
    return PipelineModel([*features.stages, LogitModel(float(beta[0]), [float(b) for b in beta[1:]], steps)])


def newton(rows: DataFrame, k: int, penalty: float) -> tuple[np.ndarray, int]:
    """(intercept and k coefficients, steps) at the least weighted loss of ``rows`` (x, y, w) plus penalty / 2 times the squared coefficients.

    A step that doesn't lower the loss is halved; the loss is convex, so that ends at the optimum.
    """
    ridge = np.array([0.0, *[penalty] * k])
    pairs = [(i, j) for i in range(k + 1) for j in range(i, k + 1)]

    def sums(beta: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        x = rows.select(F.concat(F.array(F.lit(1.0)), "x").alias("x"), "y", "w", margin(F.col("x"), list(beta)).alias("m")).withColumn("p", sigmoid(F.col("m")))
        # log(1 + exp(m)) - y m, in the form that doesn't overflow.
        loss = F.col("w") * (F.greatest("m", F.lit(0.0)) + F.log1p(F.exp(-F.abs("m"))) - F.col("y") * F.col("m"))
        x = x.withColumns({"loss": loss, "r": F.col("w") * (F.col("y") - F.col("p")), "v": F.col("w") * F.col("p") * (1 - F.col("p"))})
        total = lambda c: F.coalesce(F.sum(c), F.lit(0.0))
        row = x.agg(total("loss"), *[total(F.col("r") * F.col("x")[i]) for i in range(k + 1)], *[total(F.col("v") * F.col("x")[i] * F.col("x")[j]) for i, j in pairs]).first()
        matrix = np.diag(ridge)
        for (i, j), value in zip(pairs, row[k + 2 :]):
            matrix[i, j] += value
            if i != j:
                matrix[j, i] += value
        return row[0] + (ridge * beta**2).sum() / 2, np.array(row[1 : k + 2]) - ridge * beta, matrix

    beta = np.zeros(k + 1)
    loss, gradient, matrix = sums(beta)
    for step in range(1, MOST_STEPS + 1):
        move = np.linalg.lstsq(matrix, gradient, rcond=None)[0]
        if np.abs(move).max() <= TOLERANCE * (1 + np.abs(beta).max()):
            return beta + move, step
        new = sums(beta + move)
        while new[0] > loss + 1e-12 * abs(loss) and np.abs(move).max() > TOLERANCE:
            move /= 2
            new = sums(beta + move)
        beta, (loss, gradient, matrix) = beta + move, new
    return beta, MOST_STEPS


def probability(df: DataFrame, model: PipelineModel, name: str = "p_bad") -> DataFrame:
    """``name``: probability of label 1; helper columns are dropped."""
    scored = model.transform(df).withColumn(name, F.col("_p"))
    return scored.select(*df.columns, name)


def parcel_rejects(rejected: DataFrame, p_bad: str, label: str, weight: str = "weight") -> DataFrame:
    """Each rejected row twice: good with weight 1 - p, bad with weight p."""
    parts = F.array(F.struct(F.lit(0).alias(label), (1 - F.col(p_bad)).alias(weight)), F.struct(F.lit(1).alias(label), F.col(p_bad).alias(weight)))
    return rejected.drop(label).select("*", F.inline(parts))


def reject_inference(funded: DataFrame, rejected: DataFrame, numeric: list[str], categorical: list[str], label: str) -> tuple[PipelineModel, PipelineModel]:
    """(first model on funded rows, final model on funded rows and parcelled rejects)."""
    first = fit_logit(funded, numeric, categorical, label)
    parcels = parcel_rejects(probability(rejected, first, "_p"), "_p", label).drop("_p")
    both = funded.withColumn("weight", F.lit(1.0)).unionByName(parcels.withColumn(label, F.col(label).cast(funded.schema[label].dataType)), allowMissingColumns=True)
    return first, fit_logit(both, numeric, categorical, label, "weight", features=PipelineModel(first.stages[:-1]))


def wald_table(df: DataFrame, model: PipelineModel, names: list[str], weight: str | None = None) -> DataFrame:
    """Coefficient, standard error, z, two-sided normal p and odds ratio, per standardised feature and intercept.

    The information matrix is summed in one distributed pass of k * (k + 1) / 2 sums and inverted here.
    """
    logit = model.stages[-1]
    k = len(names) + 1
    w = F.col(weight) if weight else F.lit(1.0)
    rows = model.transform(df).select(vector_to_array("_features").alias("x"), F.col("_p").alias("p"), w.alias("w"))
    rows = rows.select(F.concat(F.array(F.lit(1.0)), "x").alias("x"), (F.col("w") * F.col("p") * (1 - F.col("p"))).alias("v"))
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    sums = rows.agg(*[F.sum(F.col("v") * F.col("x")[i] * F.col("x")[j]).alias(f"s{i}_{j}") for i, j in pairs]).first()
    matrix = np.zeros((k, k))
    for i, j in pairs:
        matrix[i, j] = matrix[j, i] = sums[f"s{i}_{j}"] or 0.0
    errors = np.sqrt(np.maximum(np.diag(np.linalg.pinv(matrix)), 0))
    values = [float(logit.intercept), *map(float, logit.coefficients)]
    out = []
    for name, value, error in zip(["intercept", *names], values, errors):
        z = float(value / error) if error else None
        p = math.erfc(abs(z) / math.sqrt(2)) if z is not None else None
        out.append((name, value, float(error), z, p, math.exp(value) if name != "intercept" else None))
    return df.sparkSession.createDataFrame(out, "feature string, coefficient double, std_err double, z double, p_value double, odds_ratio double")


def passes_gate(metrics: DataFrame, least: float = GATE) -> DataFrame:
    return metrics.withColumn("passes", F.coalesce(F.col("auc") >= least, F.lit(False)))
