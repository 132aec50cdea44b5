"""Linear models solved from one pass of sufficient statistics.

Counts, sums and sums of products of all columns are plain aggregates with map-side partials, so the
rows are read once whatever the number of coefficients, folds, penalties or gradient steps. Only a matrix with one row and column per feature reaches the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabularium.functions import distributions as dist
from tabularium.functions.columns import bucket_of
from tabularium.session import stored

@dataclass
class Moments:
    """Row count, column means and centred cross products of (features..., target)."""

    n: float
    mean: np.ndarray
    cross: np.ndarray

    def __add__(self, other: "Moments") -> "Moments":
        n = self.n + other.n
        gap = other.mean - self.mean
        return Moments(
            n,
            self.mean + gap * (other.n / n),
            self.cross + other.cross + np.outer(gap, gap) * (self.n * other.n / n),
        )


def _complete(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*[F.col(c).cast("double").alias(c) for c in columns]).na.drop()


def _moment_columns(columns: list[str]) -> list[Column]:
    """Central moments: Spark merges them without cancellation, so one pass and no shift will do."""
    d = len(columns)
    out = [F.count(F.lit(1)).cast("double").alias("n")]
    out += [F.avg(c).alias(f"m{i}") for i, c in enumerate(columns)]
    out += [F.var_pop(c).alias(f"c{i}_{i}") for i, c in enumerate(columns)]
    out += [F.covar_pop(columns[i], columns[j]).alias(f"c{i}_{j}") for i in range(d) for j in range(i + 1, d)]
    return out


def _moments_of(row, d: int) -> Moments:
    n = float(row["n"])
    if n == 0:
        raise ValueError("no complete rows")
    cross = np.zeros((d, d))
    for i in range(d):
        for j in range(i, d):
            cross[i, j] = cross[j, i] = n * row[f"c{i}_{j}"]
    return Moments(n, np.array([row[f"m{i}"] for i in range(d)]), cross)


def moments(df: DataFrame, features: list[str], target: str) -> Moments:
    columns = [*features, target]
    return _moments_of(_complete(df, columns).agg(*_moment_columns(columns)).first(), len(columns))


def fold_moments(
    df: DataFrame, features: list[str], target: str, key: str, folds: int
) -> list[Moments]:
    """Moments of every fold in one aggregation; folds come from a hash of ``key``."""
    columns = [*features, target]
    clean = df.select(
        bucket_of(key, folds, "fold").alias("_fold"),
        *[F.col(c).cast("double").alias(c) for c in columns],
    ).na.drop(subset=columns)
    rows = clean.groupBy("_fold").agg(*_moment_columns(columns)).collect()  # one per fold
    return [_moments_of(r, len(columns)) for r in sorted(rows, key=lambda r: r["_fold"])]


@dataclass
class LinearFit:
    terms: list[str]
    coefficients: np.ndarray  # intercept first
    errors: np.ndarray
    dof: float
    r2: float


def least_squares(df: DataFrame, features: list[str], target: str) -> LinearFit:
    """Ordinary least squares with an intercept (normal equations in centred form)."""
    return solve(moments(df, features, target), features)


def solve(m: Moments, features: list[str]) -> LinearFit:
    d = len(features)
    sxx, sxy, syy = m.cross[:d, :d], m.cross[:d, d], m.cross[d, d]
    inverse = np.linalg.inv(sxx)
    beta = inverse @ sxy
    intercept = m.mean[d] - beta @ m.mean[:d]
    rss = max(syy - beta @ sxy, 0.0)
    dof = m.n - d - 1
    sigma2 = rss / dof if dof > 0 else float("nan")
    variance = np.concatenate(
        [[1.0 / m.n + m.mean[:d] @ inverse @ m.mean[:d]], np.diag(inverse)]
    )
    return LinearFit(
        ["(intercept)", *features],
        np.concatenate([[intercept], beta]),
        np.sqrt(sigma2 * variance),
        dof,
        1.0 - rss / syy if syy > 0 else float("nan"),
    )


def coefficient_table(spark: SparkSession, fit: LinearFit, level: float = 0.95) -> DataFrame:
    """``(term, estimate, std_error, t, p, low, high, r2)``."""
    rows = [
        (t, float(c), float(e), float(fit.dof), float(fit.r2))
        for t, c, e in zip(fit.terms, fit.coefficients, fit.errors)
    ]
    return _judged(spark.createDataFrame(rows, ESTIMATES), level)


ESTIMATES = "term string, estimate double, std_error double, dof double, r2 double"


def _judged(base: DataFrame, level: float) -> DataFrame:
    """Adds t, p and the interval to estimates with errors."""
    width = dist.t_width(F.lit(level), "dof") * F.col("std_error")
    t = F.try_divide("estimate", "std_error")
    return (
        base.withColumn("t", t)
        .withColumn("p", dist.t_p_value("t", "dof"))
        .withColumn("width", width)
        .select(
            "term",
            "estimate",
            "std_error",
            "t",
            "p",
            (F.col("estimate") - F.col("width")).alias("low"),
            (F.col("estimate") + F.col("width")).alias("high"),
            "r2",
        )
    )


def factor_regression(
    df: DataFrame, features: list[str], factor: str, target: str, level: float = 0.95
) -> DataFrame:
    """Least squares with a dummy-coded factor: the table of ``coefficient_table``.

    The dummies are eliminated: slopes come from the pooled cross products within levels, and each
    level's coefficient from its own means. Levels stay a table (any number of them); the driver sees one
    row and column per feature. The smallest level is the reference of the intercept.
    """
    spark, columns, d = df.sparkSession, [*features, target], len(features)
    clean = df.select(
        F.col(factor).cast("string").alias("_level"), *[F.col(c).cast("double").alias(c) for c in columns]
    ).na.drop()
    levels = stored(clean.groupBy("_level").agg(*_moment_columns(columns)))
    pairs = [(i, j) for i in range(d + 1) for j in range(i, d + 1)]
    total = levels.agg(
        F.sum("n").alias("n"),
        F.count(F.lit(1)).alias("k"),
        F.min_by(F.struct("*"), "_level").alias("reference"),
        (F.sum(F.col("n") * F.col(f"m{d}")) / F.sum("n")).alias("mean"),
        *[F.sum(F.col("n") * F.col(f"c{i}_{j}")).alias(f"w{i}_{j}") for i, j in pairs],
    ).first()
    if not total["n"]:
        raise ValueError("no complete rows")
    within = np.zeros((d + 1, d + 1))
    for i, j in pairs:
        within[i, j] = within[j, i] = total[f"w{i}_{j}"]
    inverse = np.linalg.inv(within[:d, :d])
    slope = inverse @ within[:d, d]
    rss = max(within[d, d] - slope @ within[:d, d], 0.0)
    dof = total["n"] - total["k"] - d
    sigma2 = rss / dof if dof > 0 else float("nan")
    between = levels.agg(
        F.sum(F.col("n") * F.pow(F.col(f"m{d}") - F.lit(total["mean"]), F.lit(2.0))).alias("b")
    ).first()["b"]
    r2 = 1.0 - rss / (within[d, d] + between)
    reference = total["reference"]
    x0 = np.array([reference[f"m{i}"] for i in range(d)])
    start = reference[f"m{d}"] - slope @ x0
    named = [("(intercept)", start, sigma2 * (1.0 / reference["n"] + x0 @ inverse @ x0))]
    named += [(f, slope[i], sigma2 * inverse[i, i]) for i, f in enumerate(features)]
    head = spark.createDataFrame(
        [(t, float(c), float(np.sqrt(v)), float(dof), float(r2)) for t, c, v in named], ESTIMATES
    )
    gap = [F.col(f"m{i}") - F.lit(float(x0[i])) for i in range(d)]
    own = F.col(f"m{d}") - sum((F.lit(float(slope[i])) * F.col(f"m{i}") for i in range(d)), F.lit(0.0))
    square = sum(
        (F.lit(float(inverse[i, j])) * gap[i] * gap[j] for i in range(d) for j in range(d)), F.lit(0.0)
    )
    variance = F.lit(float(sigma2)) * (1.0 / F.col("n") + F.lit(1.0 / reference["n"]) + square)
    rest = levels.filter(F.col("_level") != reference["_level"]).select(
        F.concat(F.lit(f"{factor}="), "_level").alias("term"),
        (own - F.lit(float(start))).alias("estimate"),
        F.sqrt(variance).alias("std_error"),
        F.lit(float(dof)).alias("dof"),
        F.lit(float(r2)).alias("r2"),
    )
    return _judged(head.unionByName(rest), level)


def linear_value(coefficients, features: list[str]) -> Column:
    """Intercept plus weighted features as one column expression."""
    value = F.lit(float(coefficients[0]))
    for b, c in zip(coefficients[1:], features):
        value = value + F.lit(float(b)) * F.col(c)
    return value


def with_residuals(df: DataFrame, fit: LinearFit, target: str) -> DataFrame:
    fitted = linear_value(fit.coefficients, fit.terms[1:])
    return df.withColumn("fitted", fitted).withColumn("residual", F.col(target) - F.col("fitted"))


def fitted_line(df: DataFrame, fit: LinearFit, feature: str, points: int = 1000) -> DataFrame:
    """The fitted line of a one-feature model on an even grid over the feature's range."""
    limits = df.agg(
        F.min(feature).cast("double").alias("low"), F.max(feature).cast("double").alias("high")
    )
    x = F.col("low") + F.col("i") * (F.col("high") - F.col("low")) / (points - 1)
    return (
        limits.select("*", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("i"))
        .select("i", x.alias(feature))
        .withColumn("fitted", linear_value(fit.coefficients, [feature]))
    )


def gradient_descent(
    df: DataFrame,
    features: list[str],
    target: str,
    eta: float,
    iterations: int,
    start: list[float] | None = None,
    standardise: bool = True,
) -> DataFrame:
    """Batch gradient descent on half the squared error: ``(iteration, w, loss)``.

    The gradient X'(Xw - y) and the loss only involve X'X, X'y and y'y, which one aggregation
    delivers; the steps then cost nothing per row. Features are standardised with the sample
    standard deviation unless told otherwise, and a constant column comes first.
    """
    d = len(features)
    m = moments(df, features, target)
    mean, scale = np.zeros(d), np.ones(d)
    if standardise:
        mean = m.mean[:d]
        scale = np.sqrt(np.diag(m.cross)[:d] / (m.n - 1))
    shifted = (m.mean[:d] - mean) / scale
    a = np.zeros((d + 1, d + 1))
    a[0, 0] = m.n
    a[0, 1:] = a[1:, 0] = m.n * shifted
    a[1:, 1:] = m.cross[:d, :d] / np.outer(scale, scale) + m.n * np.outer(shifted, shifted)
    y_mean = m.mean[d]
    b = np.concatenate(
        [[m.n * y_mean], m.cross[:d, d] / scale + m.n * shifted * y_mean]
    )
    yy = m.cross[d, d] + m.n * y_mean * y_mean
    w = np.zeros(d + 1) if start is None else np.asarray(start, dtype=float)
    history = []
    for i in range(iterations + 1):
        loss = 0.5 * (yy - 2.0 * (w @ b) + w @ a @ w)
        history.append((i, [float(v) for v in w], float(loss)))
        w = w - eta * (a @ w - b)
    return df.sparkSession.createDataFrame(history, "iteration int, w array<double>, loss double")


def lasso_weights(
    sxx: np.ndarray, sxy: np.ndarray, n: float, alpha: float, start: np.ndarray | None = None
) -> np.ndarray:
    """Coordinate descent on (1/2n)|y - Xw|^2 + alpha |w|_1 from centred cross products."""
    d = len(sxy)
    w = np.zeros(d) if start is None else start.copy()
    diagonal = np.diag(sxx)
    for _ in range(10_000):
        largest = 0.0
        for j in range(d):
            if diagonal[j] <= 0:
                continue
            rest = sxy[j] - sxx[j] @ w + diagonal[j] * w[j]
            new = np.sign(rest) * max(abs(rest) - n * alpha, 0.0) / diagonal[j]
            largest = max(largest, abs(new - w[j]) * np.sqrt(diagonal[j]))
            w[j] = new
        if largest < 1e-10 * np.sqrt(max(diagonal.max(), 1e-300)):
            break
    return w


@dataclass
class LassoFit:
    features: list[str]
    alpha: float
    weights: np.ndarray  # for standardised features
    intercept: float
    mean: np.ndarray
    scale: np.ndarray

    def raw_coefficients(self) -> np.ndarray:
        """Intercept and weights for features in their own units."""
        b = self.weights / self.scale
        return np.concatenate([[self.intercept - b @ self.mean], b])


def _standardised(m: Moments, d: int, mean: np.ndarray, scale: np.ndarray) -> Moments:
    s = np.concatenate([scale, [1.0]])
    shift = np.concatenate([mean, [0.0]])
    return Moments(m.n, (m.mean - shift) / s, m.cross / np.outer(s, s))


def fit_lasso(m: Moments, features: list[str], alpha: float) -> LassoFit:
    """Lasso on features standardised with the population standard deviation."""
    d = len(features)
    mean = m.mean[:d]
    scale = np.sqrt(np.diag(m.cross)[:d] / m.n)
    scale[scale == 0] = 1.0
    z = _standardised(m, d, mean, scale)
    w = lasso_weights(z.cross[:d, :d], z.cross[:d, d], m.n, alpha)
    return LassoFit(features, alpha, w, float(m.mean[d]), mean, scale)


def lasso_cv(
    df: DataFrame,
    features: list[str],
    target: str,
    key: str,
    alphas: list[float],
    folds: int = 10,
) -> tuple[list[tuple[float, float]], Moments]:
    """Mean held-out squared error per penalty, and the moments of all rows.

    The whole grid times all folds needs a single aggregation: training moments are sums of fold
    moments, and the held-out error is a quadratic form of the held-out moments.
    """
    d = len(features)
    parts = fold_moments(df, features, target, key, folds)
    whole = sum(parts[1:], parts[0])
    mean = whole.mean[:d]
    scale = np.sqrt(np.diag(whole.cross)[:d] / whole.n)
    scale[scale == 0] = 1.0
    errors = {a: [] for a in alphas}
    for i, held in enumerate(parts):
        others = [p for j, p in enumerate(parts) if j != i]
        train = _standardised(sum(others[1:], others[0]), d, mean, scale)
        test = _standardised(held, d, mean, scale)
        w = None
        for a in sorted(alphas, reverse=True):  # warm start from the sparser neighbour
            w = lasso_weights(train.cross[:d, :d], train.cross[:d, d], train.n, a, w)
            offset = (
                train.mean[d] + w @ (test.mean[:d] - train.mean[:d]) - test.mean[d]
            )
            squared = (
                test.cross[d, d]
                - 2.0 * w @ test.cross[:d, d]
                + w @ test.cross[:d, :d] @ w
                + test.n * offset * offset
            )
            errors[a].append(squared / test.n)
    return [(a, float(np.mean(errors[a]))) for a in alphas], whole


def error_metrics(df: DataFrame, actual: str, predicted: str, by: list[str] | None = None):
    """SSE, MSE, RMSE and R2 in one aggregation."""
    gap = F.col(actual) - F.col(predicted)
    present = F.when(F.col(predicted).isNotNull(), F.col(actual))
    return df.groupBy(*(by or [])).agg(
        F.sum(gap * gap).alias("sse"),
        F.avg(gap * gap).alias("mse"),
        F.sqrt(F.avg(gap * gap)).alias("rmse"),
        (1.0 - F.try_divide(F.avg(gap * gap), F.var_pop(present))).alias("r2"),
    )
