"""Repeatable splits and samples based on a hash of a stable key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabularium.functions.columns import bucket_of
from tabularium.operators.order_stats import join_groups
from tabularium.session import stored


def with_split(
    df: DataFrame, key: str, shares: dict[str, int], salt: str = "", name: str = "split"
) -> DataFrame:
    """Label every row with one of the splits; ``shares`` are percentages that add up to 100."""
    if sum(shares.values()) != 100 or min(shares.values()) <= 0:
        raise ValueError("shares must be positive and add up to 100")
    bucket = bucket_of(key, 100, salt)
    edge, label = 0, None
    for split, share in shares.items():
        edge += share
        label = (F if label is None else label).when(bucket < edge, F.lit(split))
    return df.withColumn(name, label)


def comment_splits(df: DataFrame, key: str) -> DataFrame:
    """25 % test; the rest is divided 80/20 into train and eval with an independent bucket."""
    test = bucket_of(key, 100, "test") < 25
    evaluation = bucket_of(key, 100, "eval") < 20
    return df.withColumn(
        "split", F.when(test, "test").when(evaluation, "eval").otherwise("train")
    )


def sample_and_rest(df: DataFrame, key: str, percent: int, salt: str = ""):
    """A sample without replacement and its complement; no join is needed for the complement."""
    inside = bucket_of(key, 100, salt) < percent
    return df.filter(inside), df.filter(~inside)


def fixed_group_sample(
    df: DataFrame, group: str, key: str, size: int, hex_digits: int = 4
) -> DataFrame:
    """Exactly ``size`` rows per group (all of a smaller group): the lowest md5 of the key.

    A histogram of the first digits of the md5 tells up to which prefix the wanted rows of a
    group reach. Only rows up to that prefix are ordered, about ``size`` plus 1 / 16^hex_digits of
    the group, so the size of a group does not decide the size of a task.
    """
    tagged = df.withColumn("_order", F.md5(F.col(key).cast("string"))).withColumn(
        "_prefix", F.substring("_order", 1, hex_digits)
    )
    histogram = tagged.groupBy(group, "_prefix").agg(F.count(F.lit(1)).alias("_n"))
    running = Window.partitionBy(group).orderBy("_prefix")
    reach = stored(
        histogram.withColumn("_before", F.sum("_n").over(running) - F.col("_n"))
        .filter(F.col("_before") < size)
        .groupBy(group)
        .agg(F.max("_prefix").alias("_last"))
    )
    whole = Window.partitionBy(group).orderBy("_order", key)
    return (
        join_groups(tagged, reach, [group])
        .filter(F.col("_prefix") <= F.col("_last"))
        .withColumn("_rank", F.row_number().over(whole))
        .filter(F.col("_rank") <= size)
        .drop("_rank", "_prefix", "_order", "_last")
    )
