"""Forests, principal components, low-rank approximation and group clusters."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import BisectingKMeans
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import RandomForestRegressor
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabularium.functions.columns import bucket_of
from tabularium.operators import forests
from tabularium.operators.groups import cumulative_share
from tabularium.session import stored


def assemble(df: DataFrame, features: list[str], name: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=features, outputCol=name, handleInvalid="skip").transform(df)


def _training_table(train: DataFrame, columns: list[str]) -> DataFrame:
    """The columns a forest needs, written once: every fit makes several passes over them.

    Rows are dealt by a hash of their values, so the cores share the work of narrow rows.
    """
    return stored(train.select(*columns).repartition(*columns))


def forest_cv(
    train: DataFrame,
    features: list[str],
    target: str,
    key: str,
    depths: list[int] = tuple(range(1, 15)),
    trees: int = 200,
    folds: int = 5,
    seed: int = 0,
) -> CrossValidatorModel:
    """Cross-validated forest over tree depths, square root of the features per split."""
    forest = RandomForestRegressor(
        featuresCol="features",
        labelCol=target,
        numTrees=trees,
        featureSubsetStrategy="sqrt",
        seed=seed,
    )
    data = assemble(_training_table(train, [*features, target, key]), features).select(
        "features", F.col(target).cast("double"), bucket_of(key, folds, "fold").cast("int").alias("fold")
    )
    search = CrossValidator(
        estimator=forest,
        estimatorParamMaps=ParamGridBuilder().addGrid(forest.maxDepth, list(depths)).build(),
        evaluator=RegressionEvaluator(labelCol=target, metricName="r2"),
        numFolds=folds,
        foldCol="fold",
        parallelism=4,
        seed=seed,
    )
    return search.fit(data)


def fit_forest(
    train: DataFrame, features: list[str], target: str, depth: int = 9, trees: int = 200, seed: int = 0
) -> forests.Forest:
    """A forest of ``trees`` trees to one depth, square root of the features per split."""
    return forests.fit(train, features, target, depth, trees, seed)


def importances(spark, model, features: list[str]) -> DataFrame:
    """Features by importance relative to the largest one."""
    values = model.featureImportances.toArray()
    top = values.max() or 1.0
    rows = [(f, float(v / top)) for f, v in zip(features, values)]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(
        F.col("importance").desc(), "feature"
    )


def fit_pca(df: DataFrame, column: str, k: int) -> PipelineModel:
    """Centred and scaled principal components of an array column."""
    vectors = df.select(array_to_vector(column).alias("vec"))
    return Pipeline(
        stages=[
            StandardScaler(withMean=True, withStd=True, inputCol="vec", outputCol="scaled"),
            PCA(k=k, inputCol="scaled", outputCol="pc"),
        ]
    ).fit(vectors)


def pca_scores(model: PipelineModel, df: DataFrame, column: str, name: str = "scores") -> DataFrame:
    return (
        model.transform(df.withColumn("vec", array_to_vector(column)))
        .withColumn(name, vector_to_array("pc"))
        .drop("vec", "scaled", "pc")
    )


def pca_shares(spark, model: PipelineModel, dimensions: int) -> DataFrame:
    """Eigenvalue, share and running share per component of a full decomposition."""
    shares = model.stages[-1].explainedVariance.toArray()
    rows = [(i + 1, float(s * dimensions)) for i, s in enumerate(shares)]
    return cumulative_share(
        spark.createDataFrame(rows, "component int, eigenvalue double"), "component", "eigenvalue"
    )


def pca_loadings(spark, model: PipelineModel) -> DataFrame:
    matrix = model.stages[-1].pc.toArray()
    rows = [
        (v + 1, c + 1, float(matrix[v, c]))
        for v in range(matrix.shape[0])
        for c in range(matrix.shape[1])
    ]
    return spark.createDataFrame(rows, "variable int, component int, loading double")


def gram_matrix(df: DataFrame, column: str, dimensions: int) -> np.ndarray:
    """X'X of an array column: one partial matrix per task, added up cell by cell."""

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((dimensions, dimensions))
        for batch in batches:
            if len(batch):
                x = np.stack(batch[column].to_numpy()).astype(float)
                total += x.T @ x
        i, j = np.indices(total.shape)
        yield pd.DataFrame({"i": i.ravel(), "j": j.ravel(), "v": total.ravel()})

    cells = (
        df.select(F.col(column).cast("array<double>").alias(column))
        .mapInPandas(partial, "i int, j int, v double")
        .groupBy("i", "j")
        .agg(F.sum("v").alias("v"))
        .collect()  # dimensions * dimensions rows
    )
    out = np.zeros((dimensions, dimensions))
    for c in cells:
        out[c["i"], c["j"]] = c["v"]
    return out


def truncated_svd(df: DataFrame, column: str, dimensions: int, k: int):
    """The ``k`` largest singular values and right vectors (columns) of the row matrix."""
    values, vectors = np.linalg.eigh(gram_matrix(df, column, dimensions))
    order = np.argsort(values)[::-1][:k]
    return np.sqrt(np.clip(values[order], 0.0, None)), vectors[:, order]


def low_rank(df: DataFrame, column: str, right: np.ndarray, name: str = "approx") -> DataFrame:
    """Each row projected on the right singular vectors and mapped back."""

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def project(rows: pd.Series) -> pd.Series:
        if not len(rows):
            return rows
        x = np.stack(rows.to_numpy()).astype(float)
        return pd.Series(list((x @ right) @ right.T))

    return df.withColumn(name, project(column))


def reconstruction_error(df: DataFrame, column: str, approx: str) -> DataFrame:
    gap = F.aggregate(
        F.zip_with(column, approx, lambda a, b: (a - b) * (a - b)),
        F.lit(0.0),
        lambda acc, v: acc + v,
    )
    return df.agg(F.count(F.lit(1)).alias("rows"), F.sum(gap).alias("sse"))


def compression_ratio(rows: int, columns: int, k: int) -> float:
    """Numbers kept by a rank-k factorisation relative to the full matrix."""
    return (rows * k + k + k * columns) / (rows * columns)


def cluster_groups(
    df: DataFrame, group: str, value: str, k: int = 3, seed: int = 0
) -> DataFrame:
    """Groups clustered on their mean; ``(group, cluster)``, clusters numbered by their centre."""
    stats = df.filter(F.col(value).isNotNull()).groupBy(group).agg(F.avg(value).alias("mean"))
    table = assemble(stored(stats), ["mean"])
    model = BisectingKMeans(k=k, seed=seed, maxIter=30).fit(table)
    assigned = model.transform(table).select(group, "mean", F.col("prediction").alias("found"))
    order = (
        assigned.groupBy("found")
        .agg(F.avg("mean").alias("centre"))
        .agg(F.sort_array(F.collect_list(F.struct("centre", "found"))).alias("o"))
    )
    ranked = order.select(F.posexplode(F.transform("o", lambda s: s["found"])).alias("i", "found"))
    return stored(assigned.join(ranked, "found").select(group, (F.col("i") + 1).alias("cluster")))


def attach_clusters(df: DataFrame, clusters: DataFrame, group: str) -> DataFrame:
    return df.join(clusters, group)
