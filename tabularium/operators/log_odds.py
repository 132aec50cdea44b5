"""A linear text model with weights in closed form: hashed words, each with the log-odds of the two classes.

The weights are a table (``bucket``, ``weight``) of at most ``features`` + 2 rows, made by one aggregation. Scoring
looks the weights up in an array of that size, so it needs no shuffle and works on batch and streaming frames.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabularium.functions import text as tx

FEATURES = 1 << 18
INTERCEPT, UNSEEN = -1, -2


def _buckets(text: str, features: int) -> Column:
    """Bucket of each word, from its md5."""
    bucket = lambda w: F.conv(F.substring(F.md5(w), 1, 8), 16, 10).cast("long") % features
    return F.transform(F.filter(F.split(text, " +"), lambda w: w != ""), bucket)


def fit_log_odds(train: DataFrame, label: str = "label", text: str = "text", features: int = FEATURES) -> DataFrame:
    """(bucket, weight): log-odds of class TROLL with one more occurrence of every bucket in either class.

    Bucket -1 is the intercept (classes of the texts), -2 the weight of buckets no training text has.
    """
    troll = F.when(F.col(label) == tx.TROLL, 1).otherwise(0)
    rows = train.select(troll.alias("troll"), _buckets(text, features).alias("buckets"))
    texts = rows.agg(F.sum("troll").alias("t"), F.sum(1 - F.col("troll")).alias("n")).first()
    counts = (
        rows.select("troll", F.explode("buckets").alias("bucket"))
        .groupBy("bucket")
        .agg(F.sum("troll").alias("t"), F.sum(1 - F.col("troll")).alias("n"))
    )
    totals = counts.agg(F.sum("t").alias("t"), F.sum("n").alias("n")).first()
    t_all, n_all = (float((x or 0) + features) for x in totals)

    def odds(t: Column, n: Column) -> Column:
        return F.log((t + 1.0) / t_all) - F.log((n + 1.0) / n_all)

    fixed = train.sparkSession.createDataFrame([(INTERCEPT,), (UNSEEN,)], "bucket long")
    intercept = F.log(F.lit((texts["t"] or 0) + 1.0)) - F.log(F.lit((texts["n"] or 0) + 1.0))
    none = F.lit(0.0)
    return counts.select("bucket", odds(F.col("t"), F.col("n")).alias("weight")).unionByName(
        fixed.select("bucket", F.when(F.col("bucket") == INTERCEPT, intercept).otherwise(odds(none, none)).alias("weight"))
    )


def score_log_odds(weights: DataFrame, df: DataFrame, text: str = "text", features: int = FEATURES) -> DataFrame:
    """``df`` with ``label`` and ``score`` (probability of TROLL); texts without a word are ``undefined`` with score 0."""
    spark = df.sparkSession
    rows = weights.select("bucket", "weight").toArrow()  # features + 2 rows at most
    bucket, weight = (np.asarray(rows.column(c)) for c in ("bucket", "weight"))
    special = dict(zip(bucket[bucket < 0].tolist(), weight[bucket < 0].tolist()))
    dense = np.full(features, special[UNSEEN])
    dense[bucket[bucket >= 0]] = weight[bucket >= 0]
    shared = spark.sparkContext.broadcast((dense, special[INTERCEPT]))
    keys = [c for c in df.columns if c not in ("label", "score")]
    coded = df.select(*keys, F.coalesce(_buckets(text, features), F.array().cast("array<long>")).alias("__buckets"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dense, intercept = shared.value
        for batch in batches:
            column = batch.column(batch.num_columns - 1)
            ends = np.cumsum(np.diff(np.asarray(column.offsets)))
            total = np.r_[0.0, np.cumsum(dense[np.asarray(column.flatten())])]
            size = np.diff(ends, prepend=0)
            z = total[ends] - total[ends - size] + intercept
            score = np.where(size > 0, 1 / (1 + np.exp(-np.clip(z, -700, 700))), 0.0)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(size > 0), pa.array(score)], [*batch.schema.names[:-1], "__usable", "score"]
            )

    types = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in coded.schema.fields[:-1])
    scored = coded.mapInArrow(run, f"{types}__usable boolean, score double")
    label = F.when(F.col("__usable"), tx.label_of_score("score")).otherwise(F.lit(tx.UNDEFINED))
    return scored.select(*keys, label.alias("label"), "score")
