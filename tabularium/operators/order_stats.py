"""Exact ranks and quantiles per group without gathering a group in one task.

Rows are first counted per (group, value); that table is stored and everything else reads it. The
distinct values then fall into buckets cut at their approximate quantiles, about one bucket per shuffle
partition, so that one bucket holds a small share of the values even when a
single group holds most of them. A running count needs only the bucket totals of a group plus an
ordering inside one bucket. The cut points decide how evenly work is spread, never the result.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabularium.session import stored


def cut_points(df: DataFrame, value: str) -> list[float]:
    """Inner cut points, as many as there are shuffle partitions; one aggregation."""
    cuts = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 15)
    shares = ", ".join(f"{(i + 1) / (cuts + 1)!r}D" for i in range(cuts))
    found = df.select(F.col(value).cast("double").alias("_v")).agg(
        F.expr(f"percentile_approx(_v, array({shares}), {max(10_000, 10 * cuts)})").alias("q")
    )
    return sorted({float(v) for v in (found.first()["q"] or [])})


def bucketed(df: DataFrame, value: str, points: list[float], name: str = "_bucket") -> DataFrame:
    """Adds the index of the half-open interval between cut points that holds the value."""
    splits = [-float("inf"), *(points or [0.0]), float("inf")]
    exact = df.withColumn("_as_double", F.col(value).cast("double"))
    tagged = Bucketizer(
        splits=splits, inputCol="_as_double", outputCol=name, handleInvalid="keep"
    ).transform(exact)
    # Never NULL, so that joins on it add no NULL test that would keep scans from being shared.
    return tagged.withColumn(name, F.coalesce(F.col(name).cast("int"), F.lit(0))).drop("_as_double")


def join_groups(left: DataFrame, right: DataFrame, groups: list[str], exact: list[str] = ()):
    """Inner join that also matches NULL groups; ``exact`` columns are known to hold no NULL."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in [*groups, *exact]})
    match = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in groups]
    match += [F.col(k) == F.col(f"_r_{k}") for k in exact]
    return left.join(renamed, match).drop(*[f"_r_{k}" for k in [*groups, *exact]])


def value_counts_bucketed(df: DataFrame, groups: list[str], value: str) -> DataFrame:
    """``(groups, value, n, _bucket)`` with one row per distinct value of a group, NULL left out."""
    present = df.select(*groups, F.col(value).alias("value")).filter(F.col("value").isNotNull())
    counted = stored(present.groupBy(*groups, "value").agg(F.count("*").alias("n")))
    return bucketed(counted, "value", cut_points(counted, "value"))


def _offsets(counted: DataFrame, groups: list[str]) -> DataFrame:
    """Rows of a group in earlier buckets, and in the whole group; one row per group and bucket."""
    totals = counted.groupBy(*groups, "_bucket").agg(F.sum("n").alias("_in_bucket"))
    ordered = Window.partitionBy(*groups).orderBy("_bucket")
    return totals.select(
        *groups,
        "_bucket",
        "_in_bucket",
        (F.sum("_in_bucket").over(ordered) - F.col("_in_bucket")).alias("_earlier"),
        F.sum("_in_bucket").over(Window.partitionBy(*groups)).alias("group_n"),
    )


def running_counts(df: DataFrame, groups: list[str], value: str) -> DataFrame:
    """``(groups, value, n, before, group_n)``: how many rows of the group come before a value."""
    counted = value_counts_bucketed(df, groups, value)
    inside = Window.partitionBy(*groups, "_bucket").orderBy("value")
    return (
        counted.withColumn("_here", F.sum("n").over(inside) - F.col("n"))
        .transform(lambda d: join_groups(d, _offsets(counted, groups), groups, ["_bucket"]))
        .select(
            *groups,
            "value",
            "n",
            (F.col("_here") + F.col("_earlier")).alias("before"),
            "group_n",
        )
    )


def mid_ranks(df: DataFrame, value: str, carry: list[str] | None = None) -> DataFrame:
    """Average rank of every distinct value over all rows: ``(value, n, rank[, carry...])``.

    With ``carry`` the rows are distinct ``(carry, value)`` pairs ranked over the pooled values,
    and ``n`` counts the rows of that pair; ``ties`` counts the pooled rows of the value.
    """
    carry = carry or []
    counted = value_counts_bucketed(df, carry, value)
    pooled = counted.groupBy("_bucket", "value").agg(F.sum("n").alias("ties"))
    totals = pooled.groupBy("_bucket").agg(F.sum("ties").alias("_in_bucket"))
    # One row per bucket, about as many as shuffle partitions, so one ordered task for them is fine.
    earlier = totals.select(
        "_bucket",
        (
            F.sum("_in_bucket").over(Window.partitionBy(F.lit(0)).orderBy("_bucket"))
            - F.col("_in_bucket")
        ).alias("_earlier"),
    )
    inside = Window.partitionBy("_bucket").orderBy("value")
    ranked = (
        pooled.withColumn("_here", F.sum("ties").over(inside) - F.col("ties"))
        .join(F.broadcast(earlier), "_bucket")
        .select(
            "_bucket",
            "value",
            "ties",
            (F.col("_here") + F.col("_earlier") + (F.col("ties") + 1) / 2.0).alias("rank"),
        )
    )
    if not carry:
        return ranked.select("value", F.col("ties").alias("n"), "rank", "ties")
    return counted.join(ranked, ["_bucket", "value"]).select(*carry, "value", "n", "rank", "ties")


def quantiles(
    df: DataFrame, groups: list[str], value: str, shares: list[float]
) -> DataFrame:
    """Linear-interpolation quantiles: one row per group, an array ``q`` in the order of ``shares``.

    The bucket totals tell which buckets hold a wanted position; only their rows are ordered and
    matched, and the final aggregation sees at most two rows per group and share.
    """
    counted = value_counts_bucketed(df, groups, value)
    keys = [*groups, "_bucket"]

    def covered(at, first, last):
        return F.floor(at).between(first, last) | F.ceil(at).between(first, last)

    positions = F.array(
        *[
            F.struct(F.lit(i).alias("i"), (F.lit(s) * (F.col("group_n") - 1)).alias("at"))
            for i, s in enumerate(shares)
        ]
    )
    wanted = (
        _offsets(counted, groups)
        .select(
            *keys,
            "_earlier",
            F.filter(
                positions,
                lambda w: covered(
                    w["at"], F.col("_earlier"), F.col("_earlier") + F.col("_in_bucket") - 1
                ),
            ).alias("_wanted"),
        )
        .filter(F.size("_wanted") > 0)
    )
    inside = Window.partitionBy(*keys).orderBy("value")
    first = F.col("_earlier") + F.col("_here")
    last = first + F.col("n") - 1
    low, high = F.floor("w.at"), F.ceil("w.at")
    # The join comes first: it drops all other buckets before anything is sorted.
    picked = (
        join_groups(counted, wanted, groups, ["_bucket"])
        .withColumn("_here", F.sum("n").over(inside) - F.col("n"))
        .select(
            *groups,
            "value",
            first.alias("_first"),
            last.alias("_last"),
            F.explode(F.filter("_wanted", lambda w: covered(w["at"], first, last))).alias("w"),
        )
        .select(
            *groups,
            F.col("w.i").alias("i"),
            (F.col("w.at") - low).alias("part"),
            F.when(low.between(F.col("_first"), F.col("_last")), F.col("value").cast("double"))
            .alias("low"),
            F.when(high.between(F.col("_first"), F.col("_last")), F.col("value").cast("double"))
            .alias("high"),
        )
    )
    per_share = picked.groupBy(*groups, "i").agg(
        F.max("low").alias("low"), F.max("high").alias("high"), F.max("part").alias("part")
    )
    value_at = F.col("low") + (F.col("high") - F.col("low")) * F.col("part")
    return per_share.groupBy(*groups).agg(
        F.transform(
            F.sort_array(F.collect_list(F.struct("i", value_at.alias("v")))), lambda s: s["v"]
        ).alias("q")
    )


def global_row_number(df: DataFrame, order: list, name: str, start: int = 1) -> DataFrame:
    """Consecutive numbers in a total order, without one task seeing all rows.

    A range-partitioned sort gives every row a partition and a position in it; the sorted rows
    are stored so that both stay fixed, and the sizes of the partitions (one row each) give
    the offsets.
    """
    placed = stored(df.orderBy(*order).withColumn("_id", F.monotonically_increasing_id()))
    placed = placed.select(
        "*",
        F.shiftright("_id", 33).alias("_part"),
        F.col("_id").bitwiseAND(F.lit((1 << 33) - 1)).alias("_pos"),
    ).drop("_id")
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    earlier = sizes.select(
        "_part",
        (
            F.sum("_size").over(Window.partitionBy(F.lit(0)).orderBy("_part")) - F.col("_size")
        ).alias("_earlier"),
    )
    return (
        placed.join(F.broadcast(earlier), "_part")
        .withColumn(name, F.col("_earlier") + F.col("_pos") + F.lit(start))
        .drop("_part", "_pos", "_earlier")
    )
