"""Imputation, encoding, scaling and feature scores. Fit on one frame, apply to any."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabularium.operators.groups import melt, modes
from tabularium.operators.order_stats import quantiles
from tabularium.session import stored


@dataclass
class Imputer:
    """Fill values learned on the training rows (one value per column)."""

    values: dict[str, object]

    def apply(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: F.coalesce(c, F.lit(v)) for c, v in self.values.items()})


def fit_imputer(train: DataFrame, means: list[str], most_frequent: list[str]) -> Imputer:
    values: dict[str, object] = {}
    if means:
        values |= train.agg(*[F.avg(c).alias(c) for c in means]).first().asDict()
    for c in most_frequent:
        values[c] = modes(train, [], c).first()["mode"]
    return Imputer(values)


def fill_from_prediction(df: DataFrame, column: str, prediction: Column | str) -> DataFrame:
    """Keep known values, take the model's value for the others."""
    p = F.col(prediction) if isinstance(prediction, str) else prediction
    return df.withColumn(column, F.coalesce(F.col(column), p))


@dataclass
class TargetEncoder:
    """Stored mapping ``(column, value, encoded)`` and the overall mean for unseen values."""

    table: DataFrame
    default: float

    def mapping(self, column: str, name: str = "encoded") -> DataFrame:
        return self.table.filter(F.col("column") == column).select(
            F.col("value").alias(column), F.col("encoded").alias(name)
        )

    def apply(self, df: DataFrame, names: dict[str, str]) -> DataFrame:
        """Adds ``names[column]`` for each column by a left join.

        The mapping has one row per category; its measured size decides whether it is broadcast.
        """
        for column, name in names.items():
            df = df.join(self.mapping(column, name), column, "left").withColumn(
                name, F.coalesce(F.col(name), F.lit(self.default))
            )
        return df


def fit_target_encoder(train: DataFrame, columns: list[str], target: str) -> TargetEncoder:
    """Target means of the categories of all columns, and over all rows, in one aggregation."""
    cells = [F.struct(F.lit(None).cast("string").alias("column"), F.lit("").alias("value"))]
    cells += [
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns
    ]
    table = stored(
        train.select(target, F.inline(F.array(*cells)))
        .filter(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.avg(target).alias("encoded"))
    )
    default = table.filter(F.col("column").isNull()).first()
    return TargetEncoder(table, default["encoded"] if default else None)


@dataclass
class Scaler:
    mean: dict[str, float]
    scale: dict[str, float]

    def apply(self, df: DataFrame, suffix: str = "_z") -> DataFrame:
        return df.withColumns(
            {f"{c}{suffix}": (F.col(c) - self.mean[c]) / self.scale[c] for c in self.mean}
        )


def fit_scaler(train: DataFrame, columns: list[str], population: bool = True) -> Scaler:
    deviation = F.stddev_pop if population else F.stddev_samp
    row = train.agg(
        *[F.avg(c).alias(f"m_{c}") for c in columns],
        *[deviation(c).alias(f"s_{c}") for c in columns],
    ).first()
    return Scaler(
        {c: row[f"m_{c}"] for c in columns}, {c: row[f"s_{c}"] or 1.0 for c in columns}
    )


def f_scores(df: DataFrame, features: list[str], target: str) -> DataFrame:
    """Univariate F statistic per feature from its correlation: r2 / (1 - r2) * (n - 2)."""
    clean = df.select(*[F.col(c).cast("double").alias(c) for c in [*features, target]]).na.drop()
    row = clean.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.corr(c, target).alias(f"r{i}") for i, c in enumerate(features)],
    )
    cells = [
        F.struct(F.lit(c).alias("feature"), F.col(f"r{i}").alias("r"))
        for i, c in enumerate(features)
    ]
    r2 = F.col("r") * F.col("r")
    return row.select("n", F.inline(F.array(*cells))).select(
        "feature", F.try_divide(r2 * (F.col("n") - 2), 1.0 - r2).alias("f")
    )


def mutual_information(
    df: DataFrame, features: list[str], target: str, bins: int = 10
) -> DataFrame:
    """Mutual information of each feature with the target over quantile bins (natural log)."""
    columns = [*features, target]
    clean = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).na.drop()
    shares = [i / bins for i in range(1, bins)]
    edges = {  # one short array per column
        r["column"]: r["q"]
        for r in quantiles(melt(clean, columns), ["column"], "value", shares).collect()
    }

    def bin_of(c: str) -> Column:
        below = [F.when(F.col(c) > F.lit(float(e)), 1).otherwise(0) for e in edges[c]]
        total = below[0]
        for b in below[1:]:
            total = total + b
        return total

    cells = F.array(
        *[F.struct(F.lit(c).alias("feature"), bin_of(c).alias("x")) for c in features]
    )
    # At most features * bins * bins rows remain after this aggregation.
    joint = (
        clean.select(bin_of(target).alias("y"), F.inline(cells))
        .groupBy("feature", "x", "y")
        .agg(F.count(F.lit(1)).cast("double").alias("nxy"))
    )
    nx = joint.groupBy("feature", "x").agg(F.sum("nxy").alias("nx"))
    ny = joint.groupBy("feature", "y").agg(F.sum("nxy").alias("ny"))
    n = joint.groupBy("feature").agg(F.sum("nxy").alias("n"))
    part = F.col("nxy") / F.col("n") * F.ln(
        F.col("nxy") * F.col("n") / (F.col("nx") * F.col("ny"))
    )
    return (
        joint.join(nx, ["feature", "x"])
        .join(ny, ["feature", "y"])
        .join(n, "feature")
        .groupBy("feature")
        .agg(F.sum(part).alias("mi"))
    )


def feature_scores(
    df: DataFrame, features: list[str], target: str, bins: int = 10, keep_above: float = 0.30
) -> DataFrame:
    """F and mutual information, each divided by its maximum; ``keep`` marks a high MI."""
    scores = f_scores(df, features, target).join(
        mutual_information(df, features, target, bins), "feature"
    )
    every = Window.partitionBy(F.lit(0))  # one row per feature
    return scores.select(
        "feature",
        (F.col("f") / F.max("f").over(every)).alias("f"),
        (F.col("mi") / F.max("mi").over(every)).alias("mi"),
    ).withColumn("keep", F.col("mi") > keep_above)
