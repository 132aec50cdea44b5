from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from tabularium import session


def test_shared_folder_follows_the_session_setting(spark, tmp_path):
    default = session.shared_folder(spark)
    assert session.shared_folder(spark) == default
    context = SimpleNamespace(applicationId="x", master="local-cluster[2,1,1024]")
    named = SimpleNamespace(conf=SimpleNamespace(get=lambda key, other: f"{tmp_path}/"), sparkContext=context)
    assert session.new_folder(named, "x").startswith(f"{tmp_path}/x-")


def test_a_cluster_without_a_shared_folder_is_an_error():
    for master in ("yarn", "spark://h:1", "local-cluster[2,1,1024]"):
        context = SimpleNamespace(applicationId="y", master=master)
        bare = SimpleNamespace(conf=SimpleNamespace(get=lambda key, other: other), sparkContext=context)
        with pytest.raises(ValueError):
            session.shared_folder(bare)


def test_release_deletes_what_the_session_stored(spark):
    kept = dict(session._made)
    session._made.clear()
    path = session.new_folder(spark, "gone")
    spark.range(3).write.parquet(path)
    assert session.release(spark) == 1 and session.release(spark) == 0
    with pytest.raises(Exception):
        spark.read.parquet(path).count()
    session._made.update(kept)


def test_stored_tables_keep_rows_and_allow_measured_broadcasts(spark):
    small = session.stored(spark.range(10).withColumn("v", F.lit(None).cast("int")))
    assert small.count() == 10 and small.filter("v IS NULL").count() == 10
    big = spark.range(1000)
    plan = big.join(small, "id")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
