"""Device telemetry: stream readers, message parsing, JDBC dimension, hourly archive."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabularium.functions.columns import archive_parts

# Field names and types of a device message and of the user dimension.
DEVICE_MESSAGE = T.StructType(
    [
        T.StructField("bytes", T.LongType()),
        T.StructField("timestamp", T.LongType()),
        T.StructField("app", T.StringType()),
        T.StructField("id", T.StringType()),
        T.StructField("antenna_id", T.StringType()),
    ]
)
USER_DIMENSION = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("email", T.StringType()),
        T.StructField("quota", T.LongType()),
    ]
)
ARCHIVE_KEYS = ("year", "month", "day", "hour")


def read_stream(spark: SparkSession, source: str, **options: str) -> DataFrame:
    """Any streaming source whose payload sits in a binary ``value`` column."""
    return spark.readStream.format(source).options(**options).load()


def read_stream_kafka(spark: SparkSession, servers: str, topic: str, **options: str) -> DataFrame:
    return read_stream(
        spark, "kafka", **{"kafka.bootstrap.servers": servers, "subscribe": topic, **options}
    )


def read_stream_text(stream: DataFrame, value: str = "value") -> DataFrame:
    """Bytes of a message stream -> one UTF-8 ``text`` column; other columns are kept."""
    rest = [c for c in stream.columns if c != value]
    return stream.select(*rest, F.decode(F.col(value), "UTF-8").alias("text"))


def write_stream_text(stream: DataFrame, column: str = "value") -> DataFrame:
    """All columns -> one JSON document in a binary ``value`` column, ready for a topic sink."""
    return stream.select(
        F.encode(F.to_json(F.struct(*stream.columns)), "UTF-8").alias(column)
    )


def parse_device_json(messages: DataFrame) -> DataFrame:
    """Binary or text ``value`` -> typed message columns, epoch seconds as a timestamp."""
    parsed = messages.select(
        F.from_json(F.col("value").cast("string"), DEVICE_MESSAGE).alias("json")
    ).select("json.*")
    return parsed.withColumn("timestamp", F.timestamp_seconds("timestamp"))


def jdbc_options(url: str, table: str, user: str, password: str, **extra: str) -> dict[str, str]:
    return {"url": url, "dbtable": table, "user": user, "password": password, **extra}


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    user: str,
    password: str,
    partition_column: str | None = None,
    lower: int | None = None,
    upper: int | None = None,
    partitions: int | None = None,
    **extra: str,
) -> DataFrame:
    """Full-table read; with a partition column the table is fetched in parallel ranges."""
    options = jdbc_options(url, table, user, password, **extra)
    if partition_column is not None:
        options |= {
            "partitionColumn": partition_column,
            "lowerBound": str(lower),
            "upperBound": str(upper),
            "numPartitions": str(partitions),
        }
    return spark.read.format("jdbc").options(**options).load()


def write_jdbc(
    df: DataFrame, url: str, table: str, user: str, password: str, **extra: str
) -> None:
    (
        df.write.format("jdbc")
        .options(**jdbc_options(url, table, user, password, **extra))
        .mode("append")
        .save()
    )


def new_dimension_rows(rows: DataFrame, existing: DataFrame | None, key: str = "id") -> DataFrame:
    """The rows of a seed that the dimension lacks, one per key, so that a rerun adds nothing."""
    unique = rows.dropDuplicates([key])
    if existing is None:
        return unique
    return unique.join(existing.select(key), key, "left_anti")


def seed_dimension(rows: DataFrame, existing: DataFrame | None, write, key: str = "id") -> None:
    """Append the missing seed rows with ``write(df)`` (for example a bound ``write_jdbc``)."""
    write(new_dimension_rows(rows, existing, key))


def with_archive_parts(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    return df.select("*", *archive_parts(ts))


def write_archive(df: DataFrame, root: str, ts: str = "timestamp") -> str:
    """Parquet partitioned by year/month/day/hour below ``root``/historical.

    The rebalance hint gathers an hour into few files and lets adaptive execution split an hour
    that holds a large share of the rows.
    """
    path = f"{root}/historical"
    (
        with_archive_parts(df, ts)
        .hint("rebalance", *ARCHIVE_KEYS)
        .write.partitionBy(*ARCHIVE_KEYS)
        .mode("overwrite")
        .parquet(path)
    )
    return path


def read_archive(spark: SparkSession, path: str, at: datetime) -> DataFrame:
    """The rows of one archived hour; the equality on the four keys prunes partitions."""
    moment = at.astimezone(timezone.utc) if at.tzinfo else at
    return spark.read.parquet(path).filter(
        (F.col("year") == moment.year)
        & (F.col("month") == moment.month)
        & (F.col("day") == moment.day)
        & (F.col("hour") == moment.hour)
    )
