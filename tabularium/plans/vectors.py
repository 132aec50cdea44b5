"""Vector queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tabularium.functions.columns import fixed
from tabularium.operators import similarity
from tabularium.sources import shapes


def vector_cosine(spark: SparkSession, sf: str) -> DataFrame:
    """Cosine of every vector with vector 7."""
    df = similarity.cosine_to(shapes.vectors(spark, sf), "id", "vector", 7)
    return df.select("id", "label", fixed("cosine", 8).alias("cosine"))


QUERIES = {"vector_cosine": vector_cosine}

SQL = {
    "vector_cosine": """WITH v AS (SELECT vec_id AS id, label, embedding::DOUBLE[] AS e
  FROM embeddings)
SELECT v.id, v.label, floor(list_dot_product(v.e, p.e) / (sqrt(list_dot_product(v.e, v.e))
  * sqrt(list_dot_product(p.e, p.e))) * 1e8 + 0.5::DOUBLE) / 1e8 AS cosine
FROM v, (SELECT e FROM v WHERE id = 7) p""",
}
