from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from tabularium.operators import usage
from tabularium.sources import telemetry
from tabularium.streaming import usage as streams

ROWS = [
    (10, "2024-01-01 10:00:05", "web", "u1", "a1"),
    (20, "2024-01-01 10:00:55", "web", "u1", "a2"),
    (30, "2024-01-01 10:01:10", "mail", "u2", "a1"),
    (40, "2024-01-01 11:30:00", "web", "u1", "a1"),
    (99, "2024-01-01 11:31:00", "web", "ghost", "a1"),
]
USERS = [("u1", "one", "one@x", 35), ("u2", "two", "two@x", 100)]


@pytest.fixture(scope="module")
def devices(spark):
    df = spark.createDataFrame(ROWS, "bytes long, ts string, app string, id string, antenna_id string")
    return df.withColumn("timestamp", F.to_timestamp("ts")).drop("ts")


@pytest.fixture(scope="module")
def users(spark):
    return spark.createDataFrame(USERS, telemetry.USER_DIMENSION)


def as_set(df):
    return {tuple(r) for r in df.collect()}


def test_enrich_is_inner_and_keeps_one_id(devices, users):
    out = usage.enrich(devices, users)
    assert out.count() == 4
    assert out.columns.count("id") == 1
    assert {r["type"] for r in out.collect()} == {"a"}


def test_condensing_before_the_join_changes_nothing(devices, users):
    enriched = usage.enrich(devices, users)
    assert as_set(usage.hourly_user_usage(devices, users)) == as_set(usage.totals(enriched, ["email", "quota"], "id_bytes_total", "1 hour"))
    assert as_set(usage.hourly_antenna_usage(devices, users)) == as_set(
        usage.totals(enriched, ["antenna_id"], "antenna_bytes_total", "1 hour")
    )
    assert as_set(usage.hourly_app_usage(devices, users)) == as_set(
        usage.totals(enriched, ["app"], "app_bytes_total", "1 hour")
    )


def test_quota_excess_keeps_users_above_their_quota(devices, users):
    out = usage.quota_excess(usage.hourly_user_usage(devices, users))
    assert out.columns == ["email", "usage", "quota", "timestamp"]
    found = {(r["email"], r["usage"], r["timestamp"].hour) for r in out.collect()}
    assert found == {("one@x", 40, 11)}


def test_fan_out_equals_three_separate_aggregates(devices, users):
    enriched = usage.enrich(devices, users)
    separate = [
        usage.totals(enriched, [key], metric).select("timestamp", "id", "value", "type")
        for key, metric in usage.METRICS.items()
    ]
    united = separate[0].unionByName(separate[1]).unionByName(separate[2])
    assert as_set(usage.fanout_totals(enriched)) == as_set(united)
    assert as_set(usage.batch_fanout(devices, users)) == as_set(united)


def test_parse_device_json(spark):
    text = '{"bytes": 5, "timestamp": 1704103200, "app": "web", "id": "u1", "antenna_id": "a1"}'
    raw = spark.createDataFrame([(bytearray(text, "utf-8"),)], "value binary")
    row = telemetry.parse_device_json(raw).first()
    assert row["bytes"] == 5
    assert row["timestamp"].timestamp() == 1704103200


def test_archive_round_trip_prunes_partitions(spark, devices, users, tmp_path):
    path = telemetry.write_archive(usage.enrich(devices, users), str(tmp_path))
    assert path.endswith("/historical")
    hour = telemetry.read_archive(spark, path, datetime(2024, 1, 1, 10, tzinfo=timezone.utc))
    assert hour.count() == 3
    plan = hour._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan


def test_archive_hour_uses_the_instant_of_the_argument(spark, devices, users, tmp_path):
    path = telemetry.write_archive(usage.enrich(devices, users), str(tmp_path))
    same = datetime.fromisoformat("2024-01-01T12:00:00+02:00")
    assert telemetry.read_archive(spark, path, same).count() == 3


def test_seed_rows_are_added_once(spark, users):
    first = telemetry.new_dimension_rows(users.unionByName(users), None)
    assert first.count() == 2
    written = []
    telemetry.seed_dimension(users, first, lambda df: written.append(df.count()))
    assert written == [0]


def test_jdbc_settings_come_from_arguments():
    options = telemetry.jdbc_options("jdbc:x", "t", "u", "p", driver="d")
    assert options == {"url": "jdbc:x", "dbtable": "t", "user": "u", "password": "p", "driver": "d"}


def stream_of(spark, tmp_path, batches):
    schema = "bytes long, timestamp timestamp, app string, id string, antenna_id string"
    for i, rows in enumerate(batches):
        df = spark.createDataFrame(
            [(b, datetime.fromisoformat(t + "+00:00"), a, u, n) for b, t, a, u, n in rows], schema
        )
        df.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    return (
        spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    )


def test_stream_totals_equal_batch_for_closed_windows(spark, users, devices, tmp_path):
    stream = stream_of(spark, tmp_path, [ROWS])
    totals = streams.stream_minute_totals(usage.enrich(stream, users))
    streams.write_stream_batches(
        totals, streams.batch_folder_writer(f"{tmp_path}/out"), f"{tmp_path}/state"
    ).awaitTermination()
    found = as_set(spark.read.parquet(f"{tmp_path}/out").select("timestamp", "id", "value", "type"))
    batch = usage.fanout_totals(usage.enrich(devices, users))
    closed = batch.filter(F.col("timestamp") < F.lit("2024-01-01 11:00:00").cast("timestamp"))
    assert found == as_set(closed)


def test_rows_behind_the_watermark_are_dropped(spark, users, tmp_path):
    early = [(1, "2024-01-01 10:00:05", "web", "u1", "a1")]
    ahead = [(2, "2024-01-01 10:10:00", "web", "u1", "a1")]
    further = [(3, "2024-01-01 10:12:00", "web", "u1", "a1")]
    late = [(100, "2024-01-01 10:00:06", "web", "u1", "a1")]
    end = [(4, "2024-01-01 10:30:00", "web", "u1", "a1")]
    stream = stream_of(spark, tmp_path, [early, ahead, further, late, end])
    totals = usage.totals(stream, ["app"], "app_bytes_total", watermark="30 seconds")
    streams.write_stream_batches(
        totals, streams.batch_folder_writer(f"{tmp_path}/out"), f"{tmp_path}/state"
    ).awaitTermination()
    values = {r["value"] for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    assert values == {1, 2, 3}


def test_device_job_writes_archive_and_totals(spark, users, tmp_path):
    stream = stream_of(spark, tmp_path, [ROWS])
    streams.run_device_job(
        stream, users, f"{tmp_path}/archive", f"{tmp_path}/totals", f"{tmp_path}/cp"
    )
    assert spark.read.parquet(f"{tmp_path}/archive").count() == 4
    assert spark.read.parquet(f"{tmp_path}/totals").count() > 0


def test_replayed_batches_leave_no_duplicates(spark, users, tmp_path):
    write = streams.batch_folder_writer(f"{tmp_path}/out")
    write(users, 0)
    write(users, 0)
    assert spark.read.parquet(f"{tmp_path}/out").count() == 2


def test_a_half_written_batch_is_replayed_whole(spark, users):
    table, broken = [], [True]

    def append(df):
        rows = [tuple(r) for r in df.collect()]
        if broken:
            table.extend(rows[:1])  # one partition has committed
            broken.clear()
            raise ValueError("connection lost")
        table.extend(rows)

    def remove(batch_id):
        table[:] = [r for r in table if r[-1] != batch_id]

    write = streams.jdbc_batch_writer(append, remove)
    with pytest.raises(ValueError):
        write(users, 7)
    assert len(table) == 1
    write(users, 7)
    write(users, 7)
    write(users, 8)
    assert len(table) == len(set(table)) == 4


def test_message_bytes_round_trip(spark):
    df = spark.createDataFrame([("Grüße", 1)], "text string, n int")
    packed = telemetry.write_stream_text(df)
    assert packed.schema["value"].dataType.typeName() == "binary"
    assert telemetry.read_stream_text(packed).first()["text"] == '{"text":"Grüße","n":1}'


def test_a_failing_query_stops_the_others(spark, users, tmp_path):
    def fail(batch, batch_id):
        raise ValueError("sink is down")

    stream = stream_of(spark, tmp_path, [ROWS])
    forever = streams.write_stream_batches(
        stream, lambda b, i: b.count(), f"{tmp_path}/a", continuous=True
    )
    broken = streams.write_stream_batches(stream, fail, f"{tmp_path}/b")
    with pytest.raises(Exception, match="sink is down"):
        streams.await_all([forever, broken])
    assert not forever.isActive
