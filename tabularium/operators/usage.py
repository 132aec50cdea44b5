"""Device usage: enrichment, windowed byte totals, metric fan-out, quota excess."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The metric written for each grouping column.
METRICS = {
    "id": "id_bytes_total",
    "antenna_id": "antenna_bytes_total",
    "app": "app_bytes_total",
}


def enrich(devices: DataFrame, users: DataFrame) -> DataFrame:
    """Inner join with the user dimension; tags rows with the placeholder type ``a``.

    No broadcast is forced: Spark broadcasts the dimension only below its size threshold and
    otherwise shuffles both sides, where adaptive execution splits skewed ids.
    """
    dimension = users.withColumn("id", F.col("id").cast("string"))
    return devices.withColumn("type", F.lit("a")).join(dimension, "id")


def condense(
    df: DataFrame, keys: list[str], window: str, watermark: str | None = None
) -> DataFrame:
    """Bytes summed per ``keys`` and window start, in the shape of a device frame; batch or stream.

    Totals are sums, so summing before a join gives the same result and the join then moves
    one row per key and window instead of one per message.
    """
    source = df.withWatermark("timestamp", watermark) if watermark else df
    return (
        source.groupBy(*keys, F.window("timestamp", window).alias("w"))
        .agg(F.sum("bytes").alias("bytes"))
        .select(*keys, F.col("w.start").alias("timestamp"), "bytes")
    )


def totals(
    df: DataFrame, keys: list[str], metric: str, window: str = "1 minute", watermark: str | None = None
) -> DataFrame:
    """Bytes per window as ``(timestamp, id, value, type)``; the first key is the id, more keys travel along."""
    summed = condense(df.select("timestamp", "bytes", *keys), keys, window, watermark)
    named = F.col(keys[0]).alias("id"), F.col("bytes").alias("value"), F.lit(metric).alias("type")
    return summed.select("timestamp", *named, *keys[1:])


def _hourly(devices: DataFrame, users: DataFrame, own: list[str], keys: list[str], metric: str) -> DataFrame:
    """Hourly totals of enriched messages, summed per id before the users are joined."""
    return totals(enrich(condense(devices, own, "1 hour"), users), keys, metric, "1 hour")


def hourly_user_usage(devices: DataFrame, users: DataFrame) -> DataFrame:
    """Hourly totals keyed by email, with the quota."""
    return _hourly(devices, users, ["id"], ["email", "quota"], METRICS["id"])


def hourly_antenna_usage(devices: DataFrame, users: DataFrame) -> DataFrame:
    return _hourly(devices, users, ["id", "antenna_id"], ["antenna_id"], METRICS["antenna_id"])


def hourly_app_usage(devices: DataFrame, users: DataFrame) -> DataFrame:
    return _hourly(devices, users, ["id", "app"], ["app"], METRICS["app"])


def hourly_report(enriched: DataFrame) -> DataFrame:
    """The three hourly totals of enriched rows (such as an archived hour) and the quota report, in long form.

    ``report`` is the metric, or ``quota_excess`` for users beyond their quota.
    """
    by_user = totals(enriched, ["email", "quota"], METRICS["id"], "1 hour")
    parts = [by_user.drop("quota")]
    parts += [totals(enriched, [key], METRICS[key], "1 hour") for key in ("antenna_id", "app")]
    over = by_user.filter(F.col("value") > F.col("quota")).drop("quota")
    parts.append(over.withColumn("type", F.lit("quota_excess")))
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole.withColumnRenamed("type", "report")


def quota_excess(user_totals: DataFrame) -> DataFrame:
    return user_totals.filter(F.col("value") > F.col("quota")).select(
        F.col("id").alias("email"), F.col("value").alias("usage"), "quota", "timestamp"
    )


def fan_out(df: DataFrame, metrics: dict[str, str] | None = None) -> DataFrame:
    """One row per message and metric: ``(timestamp, bytes, id, type)``."""
    metrics = metrics or METRICS
    tags = F.array(
        *[
            F.struct(F.lit(metric).alias("type"), F.col(key).cast("string").alias("id"))
            for key, metric in metrics.items()
        ]
    )
    return df.select("timestamp", "bytes", F.inline(tags))


def fanout_totals(
    df: DataFrame,
    metrics: dict[str, str] | None = None,
    window: str = "1 minute",
    watermark: str | None = None,
) -> DataFrame:
    """All metrics in one pass and one shuffle; works on batch and streaming frames."""
    source = fan_out(df, metrics)
    if watermark:
        source = source.withWatermark("timestamp", watermark)
    return (
        source.groupBy("id", "type", F.window("timestamp", window).alias("w"))
        .agg(F.sum("bytes").alias("value"))
        .select(F.col("w.start").alias("timestamp"), "id", "value", "type")
    )


def batch_fanout(devices: DataFrame, users: DataFrame, window: str = "1 minute") -> DataFrame:
    return fanout_totals(enrich(condense(devices, list(METRICS), window), users), window=window)
