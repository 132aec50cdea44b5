"""Queries of word pairs and learnt word vectors over all cleaned texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabularium.functions.columns import fixed
from tabularium.operators import text as ops
from tabularium.operators import word_factors
from tabularium.plans.common import fixed_sql, with_ctes
from tabularium.plans.text import _CLEANED, _VOCAB
from tabularium.sources import shapes

WINDOW, MIN_COUNT, SIZE = 7, 10, 300


def _texts(spark: SparkSession, sf: str) -> DataFrame:
    return word_factors.tidy_stored(ops.clean_comments(shapes.comments(spark, sf)).select("doc_id", "text"))


def word_affinity(spark: SparkSession, sf: str) -> DataFrame:
    """Pairs of words that stand near each other more often than by chance: counts and mutual information."""
    df = _texts(spark, sf)
    vocab = word_factors.tidy_stored(ops.vocabulary(df))
    pairs = word_factors.word_pairs(df, window=WINDOW, known=vocab.where(F.col("n") >= MIN_COUNT), packed=True)
    cells = word_factors.affinity(pairs, vocab, MIN_COUNT, upper=True)
    return cells.where("i <= j").select("i", "j", "n", fixed("v", 6).alias("affinity"))


def word_factors_learnt(spark: SparkSession, sf: str) -> DataFrame:
    """A learnt vector of up to ``SIZE`` components for every word seen ``MIN_COUNT`` times."""
    df = _texts(spark, sf)
    table = word_factors.fit_word_vectors(df, ops.vocabulary(df), size=SIZE, window=WINDOW, min_count=MIN_COUNT)
    return table.select("word", "index", F.col("n"), "vector")


QUERIES = {f.__name__: f for f in (word_affinity, word_factors_learnt)}

SQL = {
    "word_affinity": with_ctes(
        _CLEANED,
        _VOCAB,
        f"""kept AS (SELECT doc_id, word, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS spot
  FROM words WHERE word <> ''),
pairs AS (SELECT least(x.word, y.word) AS a, greatest(x.word, y.word) AS b, count(*) AS n
  FROM (SELECT doc_id, word, spot, unnest(range(1, {WINDOW + 1})) AS gap FROM kept) x
  JOIN kept y ON x.doc_id = y.doc_id AND y.spot = x.spot + x.gap GROUP BY ALL),
coded AS (SELECT f.index AS i, g.index AS j, p.n FROM pairs p JOIN vocab f ON p.a = f.word AND f.n >= {MIN_COUNT}
  JOIN vocab g ON p.b = g.word AND g.n >= {MIN_COUNT}),
cells AS (SELECT i, j, CAST(CASE WHEN i = j THEN 2 * n ELSE n END AS BIGINT) AS n FROM coded
  UNION ALL SELECT j, i, n FROM coded WHERE i <> j),
sums AS (SELECT i, CAST(sum(n) AS BIGINT) AS s FROM cells GROUP BY 1),
total AS (SELECT CAST(sum(s) AS DOUBLE) AS t FROM sums),
valued AS (SELECT c.i, c.j, c.n, ln(CAST(c.n AS DOUBLE) * t / (CAST(p.s AS DOUBLE) * CAST(q.s AS DOUBLE))) AS v
  FROM cells c JOIN sums p ON c.i = p.i JOIN sums q ON c.j = q.i, total)""",
    )
    + f"SELECT i, j, n, {fixed_sql('v', 6)} AS affinity FROM valued WHERE v > 0 AND i <= j",
}
