"""Mergeable sketches per archived hour: distinct counts and quantiles of any range without its rows.

An hour keeps a HyperLogLog sketch of a key and a quantile sketch of a value, a few kilobytes whatever the
rows. Sketches of any set of hours merge into the sketch of their union. NULL keys and values are
left out; an hour without any value has no quantiles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabularium.sources.telemetry import ARCHIVE_KEYS, with_archive_parts

LG_K = 12  # 4,096 registers: relative standard error of a distinct count 1.6 %
RANKS = 400  # size of the quantile sketch: rank error below 0.7 % with a probability of 99 %
DISTINCT_ERROR = 1.04 / 2 ** (LG_K / 2)
RANK_ERROR = 0.015  # twice that, so the bound holds for all days of a report


def hourly_sketches(df: DataFrame, key: str, value: str, by: tuple[str, ...] = (), ts: str = "timestamp") -> DataFrame:
    """(year, month, day, hour, ``by``, n, keys, quantiles): one row per hour and group."""
    return with_archive_parts(df, ts).groupBy(*ARCHIVE_KEYS, *by).agg(
        F.count(F.lit(1)).alias("n"),
        F.hll_sketch_agg(key, F.lit(LG_K)).alias("keys"),
        F.kll_sketch_agg_bigint(F.col(value).cast("long"), F.lit(RANKS)).alias("quantiles"),
    )


def write_sketches(sketches: DataFrame, path: str) -> DataFrame:
    """Written beside the archive, a folder per day; a rerun replaces only the days it holds."""
    days = [k for k in ARCHIVE_KEYS if k != "hour"]
    writer = sketches.hint("rebalance", *days).write.partitionBy(*days).mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").parquet(path)
    return sketches.sparkSession.read.parquet(path)


def merge_sketches(sketches: DataFrame, by: list[str]) -> DataFrame:
    """``by`` with n and the merged sketches."""
    return sketches.groupBy(*by).agg(
        F.sum("n").alias("n"),
        F.hll_union_agg("keys").alias("keys"),
        F.kll_merge_agg_bigint("quantiles").alias("quantiles"),
    )


def read_sketches(merged: DataFrame, shares: tuple[float, ...] = (0.25, 0.5, 0.75)) -> DataFrame:
    """The sketches as figures: ``distinct`` and one ``q<percent>`` column per share."""
    some = F.kll_sketch_get_n_bigint("quantiles") > 0
    quantiles = [
        F.when(some, F.kll_sketch_get_quantile_bigint("quantiles", F.lit(float(s)))).alias(f"q{round(100 * s)}") for s in shares
    ]
    return merged.select("*", F.hll_sketch_estimate("keys").alias("distinct"), *quantiles).drop("keys", "quantiles")
