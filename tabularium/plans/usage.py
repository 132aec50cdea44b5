"""Telemetry queries."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabularium.functions.columns import as_wall_clock
from tabularium.operators import sketches, usage
from tabularium.plans.common import DEVICES, USERS, with_ctes
from tabularium.session import new_folder
from tabularium.sources import shapes, telemetry
from tabularium.streaming import usage as streams

ARRIVALS = 4
ARCHIVED_HOUR = datetime(2024, 1, 15, 12, tzinfo=timezone.utc)


def _wall(df: DataFrame) -> DataFrame:
    return df.withColumn("timestamp", as_wall_clock("timestamp"))


def usage_enriched(spark: SparkSession, sf: str) -> DataFrame:
    messages = shapes.device_messages_from(shapes.table(spark, sf, "events"))
    parsed = telemetry.parse_device_json(messages)
    return _wall(usage.enrich(parsed, shapes.users(spark, sf)))


def usage_by_user_hour(spark: SparkSession, sf: str) -> DataFrame:
    return _wall(usage.hourly_user_usage(shapes.devices(spark, sf), shapes.users(spark, sf)))


def usage_by_antenna_hour(spark: SparkSession, sf: str) -> DataFrame:
    return _wall(usage.hourly_antenna_usage(shapes.devices(spark, sf), shapes.users(spark, sf)))


def usage_by_app_hour(spark: SparkSession, sf: str) -> DataFrame:
    return _wall(usage.hourly_app_usage(shapes.devices(spark, sf), shapes.users(spark, sf)))


def usage_quota_excess(spark: SparkSession, sf: str) -> DataFrame:
    totals = usage.hourly_user_usage(shapes.devices(spark, sf), shapes.users(spark, sf))
    return _wall(usage.quota_excess(totals))


def usage_fanout_minute(spark: SparkSession, sf: str) -> DataFrame:
    return _wall(usage.batch_fanout(shapes.devices(spark, sf), shapes.users(spark, sf)))


def usage_archive_hour(spark: SparkSession, sf: str) -> DataFrame:
    enriched = usage.enrich(shapes.devices(spark, sf), shapes.users(spark, sf))
    path = telemetry.write_archive(enriched, new_folder(spark, "archive"))
    return _wall(telemetry.read_archive(spark, path, ARCHIVED_HOUR))


def usage_archive_report(spark: SparkSession, sf: str) -> DataFrame:
    """The batch job: one archived hour read back, its three totals and the quota report."""
    enriched = usage.enrich(shapes.devices(spark, sf), shapes.users(spark, sf))
    path = telemetry.write_archive(enriched, new_folder(spark, "archive"))
    return _wall(usage.hourly_report(telemetry.read_archive(spark, path, ARCHIVED_HOUR)))


def _event_stream(spark: SparkSession, sf: str) -> DataFrame:
    stream = shapes.table_stream(spark, sf, "events")
    return shapes.devices_from(stream)


def usage_sketch_daily(spark: SparkSession, sf: str) -> DataFrame:
    """Daily users and median bytes from merged hourly sketches, beside the exact count and the bounds they keep."""
    devices = shapes.devices(spark, sf)
    hourly = sketches.hourly_sketches(devices, "id", "bytes")
    archive = sketches.write_sketches(hourly, new_folder(spark, "sketches"))
    day = ["year", "month", "day"]
    daily = sketches.read_sketches(sketches.merge_sketches(archive, day), (0.5,)).drop("n")
    rows = telemetry.with_archive_parts(devices).select(*day, "id", "bytes")
    both = rows.join(daily, day)  # a row per day
    exact = both.groupBy(*day).agg(
        F.count("*").alias("n"),
        F.countDistinct("id").alias("users"),
        F.first("distinct").alias("found"),
        F.avg((F.col("bytes") < F.col("q50")).cast("double")).alias("below"),
        F.avg((F.col("bytes") <= F.col("q50")).cast("double")).alias("upto"),
    )
    close = F.abs(F.col("found") - F.col("users")) <= 4 * sketches.DISTINCT_ERROR * F.col("users") + 1
    half = (F.col("below") <= 0.5 + sketches.RANK_ERROR) & (F.col("upto") >= 0.5 - sketches.RANK_ERROR)
    return exact.select(*day, "n", "users", close.alias("users_close"), half.alias("median_close"))


def _arrivals(devices: DataFrame) -> list[DataFrame]:
    """The rows in the order in which they come: by time, but some a quarter or two of the span too late."""
    at = F.unix_timestamp("timestamp")
    span = devices.agg(F.min(at).alias("lo"), F.max(at).alias("hi")).first()
    lo, hi = span["lo"] or 0, span["hi"] or 0
    quarter = F.floor((at - lo) * ARRIVALS / F.lit(hi - lo + 1))
    behind = F.when(F.col("bytes") % 25 == 0, 2).when(F.col("bytes") % 5 == 0, 1).otherwise(0)
    place = F.least(quarter + behind, F.lit(ARRIVALS - 1))
    return [devices.where(place == i) for i in range(ARRIVALS)]


def stream_late_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Hourly totals of a stream that is restarted at every arrival and leaves out rows behind its watermark."""
    root = new_folder(spark, "late")
    devices, users = shapes.devices(spark, sf), shapes.users(spark, sf)

    def start():
        stream = spark.readStream.schema(devices.schema).parquet(f"{root}/arrived")
        totals = streams.stream_minute_totals(usage.enrich(stream, users), "1 hour")
        return streams.write_stream_batches(totals, streams.batch_folder_writer(f"{root}/data"), f"{root}/state")

    streams.replay_arrivals(_arrivals(devices), f"{root}/arrived", start)
    return _wall(spark.read.parquet(f"{root}/data").select("timestamp", "id", "value", "type"))


def stream_usage_minute(spark: SparkSession, sf: str) -> DataFrame:
    root = new_folder(spark, "minute")
    enriched = usage.enrich(_event_stream(spark, sf), shapes.users(spark, sf))
    totals = streams.stream_minute_totals(enriched)
    writer = streams.batch_folder_writer(f"{root}/data")
    streams.write_stream_batches(totals, writer, f"{root}/state").awaitTermination()
    return _wall(spark.read.parquet(f"{root}/data").select("timestamp", "id", "value", "type"))


def stream_device_job(spark: SparkSession, sf: str) -> DataFrame:
    """Both sinks of the streaming job; rows and bytes per archived hour beside closed totals."""
    root = new_folder(spark, "device-job")
    streams.run_device_job(
        _event_stream(spark, sf),
        shapes.users(spark, sf),
        f"{root}/archive",
        f"{root}/totals",
        f"{root}/state",
    )
    hours = (
        spark.read.parquet(f"{root}/archive")
        .groupBy("year", "month", "day", "hour")
        .agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes"))
        .withColumn("sink", F.lit("archive"))
    )
    totals = (
        telemetry.with_archive_parts(spark.read.parquet(f"{root}/totals"))
        .groupBy("year", "month", "day", "hour")
        .agg(F.count("*").alias("n"), F.sum("value").alias("bytes"))
        .withColumn("sink", F.lit("totals"))
    )
    return hours.unionByName(totals)


QUERIES = {
    "usage_enriched": usage_enriched,
    "usage_by_user_hour": usage_by_user_hour,
    "usage_by_antenna_hour": usage_by_antenna_hour,
    "usage_by_app_hour": usage_by_app_hour,
    "usage_quota_excess": usage_quota_excess,
    "usage_fanout_minute": usage_fanout_minute,
    "usage_archive_hour": usage_archive_hour,
    "usage_archive_report": usage_archive_report,
    "usage_sketch_daily": usage_sketch_daily,
    "stream_late_rows": stream_late_rows,
    "stream_usage_minute": stream_usage_minute,
    "stream_device_job": stream_device_job,
}

_WITH = with_ctes(
    DEVICES,
    USERS,
    """enriched AS (
  SELECT d."timestamp", d.bytes, d.app, d.id, d.antenna_id, 'a' AS type, u.name, u.email, u.quota
  FROM devices d JOIN users u ON d.id = u.id)""",
)

_HOUR = """SELECT date_trunc('hour', "timestamp") AS "timestamp", {key} AS id,
  CAST(sum(bytes) AS BIGINT) AS value, '{metric}' AS type{more} FROM enriched GROUP BY ALL"""

_FANOUT = """fan AS (
  SELECT date_trunc('minute', "timestamp") AS "timestamp", id, 'id_bytes_total' AS type, bytes
    FROM enriched
  UNION ALL SELECT date_trunc('minute', "timestamp"), antenna_id, 'antenna_bytes_total', bytes
    FROM enriched
  UNION ALL SELECT date_trunc('minute', "timestamp"), app, 'app_bytes_total', bytes FROM enriched),
totals AS (
  SELECT "timestamp", id, type, CAST(sum(bytes) AS BIGINT) AS value FROM fan GROUP BY ALL),
closed AS (
  SELECT * FROM totals WHERE "timestamp" + INTERVAL 1 MINUTE
    <= (SELECT max("timestamp") - INTERVAL 30 SECOND FROM enriched))"""

SQL = {
    "usage_enriched": _WITH + "SELECT * FROM enriched",
    "usage_by_user_hour": _WITH
    + _HOUR.format(key="email", metric="id_bytes_total", more=", quota"),
    "usage_by_antenna_hour": _WITH
    + _HOUR.format(key="antenna_id", metric="antenna_bytes_total", more=""),
    "usage_by_app_hour": _WITH + _HOUR.format(key="app", metric="app_bytes_total", more=""),
    "usage_quota_excess": _WITH
    + """SELECT email, CAST(sum(bytes) AS BIGINT) AS usage, quota,
  date_trunc('hour', "timestamp") AS "timestamp"
FROM enriched GROUP BY email, quota, date_trunc('hour', "timestamp") HAVING sum(bytes) > quota""",
    "usage_fanout_minute": _WITH.rstrip()
    + ",\n"
    + _FANOUT
    + '\nSELECT "timestamp", id, value, type FROM totals',
    "usage_archive_hour": _WITH
    + """SELECT *, 2024::INTEGER AS year, 1::INTEGER AS month, 15::INTEGER AS day,
  12::INTEGER AS hour
FROM enriched WHERE date_trunc('hour', "timestamp") = TIMESTAMP '2024-01-15 12:00:00'""",
    "usage_archive_report": _WITH.rstrip()
    + """,
one AS (SELECT *, date_trunc('hour', "timestamp") AS h FROM enriched
  WHERE date_trunc('hour', "timestamp") = TIMESTAMP '2024-01-15 12:00:00'),
users_hour AS (SELECT h, email AS id, quota, CAST(sum(bytes) AS BIGINT) AS value FROM one GROUP BY ALL)
SELECT h AS "timestamp", id, value, 'id_bytes_total' AS report FROM users_hour
UNION ALL SELECT h, antenna_id, CAST(sum(bytes) AS BIGINT), 'antenna_bytes_total' FROM one GROUP BY ALL
UNION ALL SELECT h, app, CAST(sum(bytes) AS BIGINT), 'app_bytes_total' FROM one GROUP BY ALL
UNION ALL SELECT h, id, value, 'quota_excess' FROM users_hour WHERE value > quota""",
    "usage_sketch_daily": with_ctes(DEVICES)
    + """SELECT CAST(year("timestamp") AS INTEGER) AS year, CAST(month("timestamp") AS INTEGER) AS month,
  CAST(day("timestamp") AS INTEGER) AS day, count(*) AS n, count(DISTINCT id) AS users,
  true AS users_close, true AS median_close FROM devices GROUP BY ALL""",
    "stream_late_rows": _WITH.rstrip()
    + f""",
span AS (SELECT min(epoch("timestamp"))::BIGINT AS lo, max(epoch("timestamp"))::BIGINT AS hi FROM devices),
arrived AS (
  SELECT e.*, least(CAST(floor((epoch("timestamp")::BIGINT - lo) * {ARRIVALS} / (hi - lo + 1)::DOUBLE) AS INTEGER)
      + CASE WHEN bytes % 25 = 0 THEN 2 WHEN bytes % 5 = 0 THEN 1 ELSE 0 END, {ARRIVALS - 1}) AS arrival
  FROM enriched e, span),
marks AS (
  SELECT n.arrival, (SELECT max("timestamp") FROM arrived a WHERE a.arrival < n.arrival) - INTERVAL 30 SECOND AS mark
  FROM range({ARRIVALS + 1}) n(arrival)),
kept AS (
  SELECT a.* FROM arrived a JOIN marks m ON a.arrival = m.arrival
  WHERE m.mark IS NULL OR date_trunc('hour', a."timestamp") + INTERVAL 1 HOUR > m.mark),
fan AS (
  SELECT date_trunc('hour', "timestamp") AS "timestamp", id, 'id_bytes_total' AS type, bytes FROM kept
  UNION ALL SELECT date_trunc('hour', "timestamp"), antenna_id, 'antenna_bytes_total', bytes FROM kept
  UNION ALL SELECT date_trunc('hour', "timestamp"), app, 'app_bytes_total', bytes FROM kept),
totals AS (SELECT "timestamp", id, type, CAST(sum(bytes) AS BIGINT) AS value FROM fan GROUP BY ALL)
SELECT "timestamp", id, value, type FROM totals
WHERE "timestamp" + INTERVAL 1 HOUR <= (SELECT mark FROM marks WHERE arrival = {ARRIVALS})""",
    "stream_usage_minute": _WITH.rstrip()
    + ",\n"
    + _FANOUT
    + '\nSELECT "timestamp", id, value, type FROM closed',
    "stream_device_job": _WITH.rstrip()
    + ",\n"
    + _FANOUT
    + """
SELECT CAST(year("timestamp") AS INTEGER) AS year, CAST(month("timestamp") AS INTEGER) AS month,
  CAST(day("timestamp") AS INTEGER) AS day, CAST(hour("timestamp") AS INTEGER) AS hour,
  count(*) AS n, CAST(sum(bytes) AS BIGINT) AS bytes, 'archive' AS sink
FROM enriched GROUP BY ALL
UNION ALL
SELECT CAST(year("timestamp") AS INTEGER), CAST(month("timestamp") AS INTEGER),
  CAST(day("timestamp") AS INTEGER), CAST(hour("timestamp") AS INTEGER),
  count(*), CAST(sum(value) AS BIGINT), 'totals'
FROM closed GROUP BY ALL""",
}
