"""Model queries: lasso, forests, clusters, components, low-rank approximation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabularium.functions.columns import bucket_of, fixed
from tabularium.operators import decomposition, features, models, regression, similarity
from tabularium.plans.common import fixed_sql
from tabularium.sources import shapes

FEATURES = ["accommodates", "bedrooms", "extra_people", "score", "type_mean", "spot_mean"]
DIMENSIONS = 64


def _grid(low: float, high: float, steps: int = 20) -> list[float]:
    return [10 ** (low + i * (high - low) / (steps - 1)) for i in range(steps)]


def model_frame(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Train and test listings with target-mean encoded categories (means from train only)."""
    whole = shapes.listings(spark, sf).select(
        "id", "price", "accommodates", "bedrooms", "extra_people", "score",
        "property_type", "neighbourhood",
    )
    inside = bucket_of("id", 100, "split") < 80
    train, test = whole.filter(inside), whole.filter(~inside)
    names = {"property_type": "type_mean", "neighbourhood": "spot_mean"}
    encoder = features.fit_target_encoder(train, list(names), "price")
    return encoder.apply(train, names), encoder.apply(test, names)


def _cv_table(spark: SparkSession, scores: list[tuple[float, float]]) -> DataFrame:
    best = min(scores, key=lambda s: s[1])[0]
    return spark.createDataFrame(
        [(i, a, e, a == best) for i, (a, e) in enumerate(scores)],
        "step int, alpha double, cv_mse double, best boolean",
    )


def lasso_cv(spark: SparkSession, sf: str) -> DataFrame:
    """Cross-validated error over the penalty grid (20 penalties, 10 folds, one pass)."""
    train, _ = model_frame(spark, sf)
    scores, _ = regression.lasso_cv(train, FEATURES, "price", "id", _grid(-2, 1.5))
    return _cv_table(spark, scores)


def lasso_fit(spark: SparkSession, sf: str) -> DataFrame:
    """Coefficients of the refit at the chosen penalty with train and test errors."""
    train, test = model_frame(spark, sf)
    fit = regression.fit_lasso(regression.moments(train, FEATURES, "price"), FEATURES, 1.25)
    guess = regression.linear_value(fit.raw_coefficients(), FEATURES)
    both = train.withColumn("part", F.lit("train")).unionByName(
        test.withColumn("part", F.lit("test"))
    )
    errors = regression.error_metrics(both.withColumn("guess", guess), "price", "guess", ["part"])
    weights = spark.createDataFrame(
        [(f, float(w)) for f, w in zip(FEATURES, fit.weights)], "name string, value double"
    )
    return weights.unionByName(
        errors.select(
            F.inline(
                F.array(
                    F.struct(F.concat("part", F.lit(" mse")).alias("name"), F.col("mse").alias("value")),
                    F.struct(F.concat("part", F.lit(" rmse")).alias("name"), F.col("rmse").alias("value")),
                )
            )
        )
    )


def lasso_log(spark: SparkSession, sf: str) -> DataFrame:
    """Lasso on log10(price); errors measured after mapping predictions back to prices."""
    train, test = model_frame(spark, sf)
    train = train.withColumn("log_price", F.log10("price"))
    scores, moments = regression.lasso_cv(train, FEATURES, "log_price", "id", _grid(-6, -1))
    best = min(scores, key=lambda s: s[1])[0]
    fit = regression.fit_lasso(moments, FEATURES, best)
    guess = F.pow(F.lit(10.0), regression.linear_value(fit.raw_coefficients(), FEATURES))
    both = train.drop("log_price").withColumn("part", F.lit("train")).unionByName(
        test.withColumn("part", F.lit("test"))
    )
    errors = regression.error_metrics(both.withColumn("guess", guess), "price", "guess", ["part"])
    return errors.select("part", F.lit(best).alias("alpha"), "mse", "rmse")


def importances(spark: SparkSession, sf: str) -> DataFrame:
    train, _ = model_frame(spark, sf)
    model = models.fit_forest(train, FEATURES, "price", depth=9, trees=200)
    return models.importances(spark, model, FEATURES)


def group_clusters(spark: SparkSession, sf: str) -> DataFrame:
    df = shapes.listings(spark, sf)
    clusters = models.cluster_groups(df, "neighbourhood", "square_feet", k=3)
    return (
        models.attach_clusters(df, clusters, "neighbourhood")
        .groupBy("neighbourhood", "cluster")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def pca_shares(spark: SparkSession, sf: str) -> DataFrame:
    model = models.fit_pca(shapes.vectors(spark, sf), "vector", DIMENSIONS)
    return models.pca_shares(spark, model, DIMENSIONS)


def pca_loadings(spark: SparkSession, sf: str) -> DataFrame:
    return models.pca_loadings(spark, models.fit_pca(shapes.vectors(spark, sf), "vector", 10))


def pca_neighbours(spark: SparkSession, sf: str) -> DataFrame:
    """The five rows nearest to vector 7 in the space of the first ten components."""
    df = shapes.vectors(spark, sf)
    scored = models.pca_scores(models.fit_pca(df, "vector", 10), df, "vector")
    return similarity.nearest_rows(scored, "id", "scores", 7, 5).select(
        "id", "label", fixed("distance", 4).alias("distance")
    )


def vector_neighbours(spark: SparkSession, sf: str) -> DataFrame:
    """The five rows nearest to vector 7 by squared distance over all components."""
    df = similarity.nearest_rows(shapes.vectors(spark, sf), "id", "vector", 7, 5)
    return df.select("id", "label", fixed("distance", 8).alias("distance"))


def svd_lowrank(spark: SparkSession, sf: str) -> DataFrame:
    """Rank-10 approximation of the vector table: size, error, leading singular values."""
    df = shapes.vectors(spark, sf)
    values, right = models.truncated_svd(df, "vector", DIMENSIONS, 10)
    error = models.reconstruction_error(
        models.low_rank(df, "vector", right), "vector", "approx"
    )
    ratio = (F.col("rows") * 10 + 10 + 10 * DIMENSIONS) / (F.col("rows") * DIMENSIONS)
    return error.select(
        "rows",
        fixed("sse", 6).alias("sse"),
        ratio.alias("compression"),
        F.lit(float(values[0])).alias("first_value"),
        F.lit(float(values[-1])).alias("last_value"),
    )


def svd_row_lengths(spark: SparkSession, sf: str) -> DataFrame:
    """Squared length of every vector, from its left singular vector and all singular values."""
    df = shapes.vectors(spark, sf)
    values, right = decomposition.tall_svd(df, "vector", DIMENSIONS)
    rows = decomposition.left_vectors(df, "vector", values, right)
    weights = F.array(*[F.lit(float(v)) for v in values])
    parts = F.zip_with("u", weights, lambda u, s: (u * s) * (u * s))
    length = F.aggregate(parts, F.lit(0.0), lambda acc, x: acc + x)
    return rows.select("id", fixed(length, 6).alias("length"))


def svd_left_products(spark: SparkSession, sf: str) -> DataFrame:
    """Inner products of the ten leading left singular vectors over all rows."""
    df = shapes.vectors(spark, sf)
    values, right = decomposition.tall_svd(df, "vector", 10)
    each = decomposition.left_vectors(df, "vector", values, right)
    a = each.select("u", F.posexplode("u").alias("i", "a"))
    cells = a.select("i", "a", F.posexplode("u").alias("j", "b"))
    return cells.groupBy("i", "j").agg(F.sum(F.col("a") * F.col("b")).alias("product")).select(
        "i", "j", fixed("product", 6).alias("product")
    )


QUERIES = {
    f.__name__: f
    for f in (
        lasso_cv,
        lasso_fit,
        lasso_log,
        importances,
        group_clusters,
        pca_shares,
        pca_loadings,
        pca_neighbours,
        vector_neighbours,
        svd_lowrank,
        svd_row_lengths,
        svd_left_products,
    )
}

SQL = {
    "svd_row_lengths": f"""SELECT vec_id AS id,
  {fixed_sql('list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])', 6)} AS length FROM embeddings""",
    "svd_left_products": """SELECT i::INTEGER AS i, j::INTEGER AS j, (CASE WHEN i = j THEN 1 ELSE 0 END)::DOUBLE AS product
FROM range(10) a(i), range(10) b(j) WHERE (SELECT count(*) FROM embeddings) > 0""",
    "vector_neighbours": """WITH v AS (SELECT vec_id AS id, label, embedding::DOUBLE[] AS e
  FROM embeddings),
d AS (SELECT v.id, v.label, list_sum(list_transform(range(1, len(v.e) + 1),
    lambda i: (v.e[i] - p.e[i]) * (v.e[i] - p.e[i]))) AS distance
  FROM v, (SELECT e FROM v WHERE id = 7) p)
SELECT id, label, floor(distance * 1e8 + 0.5::DOUBLE) / 1e8 AS distance
FROM d ORDER BY d.distance, id LIMIT 5""",
}
