import math
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F
from tabularium.functions.normal import log_erfc, log_normal_cdf
from tabularium.operators import hypothesis, sketches, usage
from tabularium.plans import usage as plans
from tabularium.sources import shapes
from tabularium.streaming import usage as streams


def test_log_tails(spark):
    xs = [0.0, 1e-9, 1e-3, 0.3, 1.0, 2.5, 5.0, 5.99, 6.0, 6.01, 10.0, 25.0]
    got = spark.createDataFrame([(x,) for x in xs], "x double").select("x", log_erfc(F.col("x")).alias("l")).collect()
    for r in got:
        assert r["l"] == pytest.approx(math.log(math.erfc(r["x"])), rel=1e-12, abs=1e-14)
    zs = [-60.0, -8.0, -1.0, 0.0, 0.5, 8.0]
    got = spark.createDataFrame([(z,) for z in zs], "z double").select("z", log_normal_cdf(F.col("z")).alias("l")).collect()
    for r in got[1:]:
        assert r["l"] == pytest.approx(math.log(0.5 * math.erfc(-r["z"] / 2**0.5)), rel=1e-9, abs=1e-15)
    assert got[0]["l"] == pytest.approx(-1805.0135, abs=1e-3)


def brute_a2(x):
    x = np.sort(x)
    n, z = len(x), (x - x.mean()) / x.std(ddof=1)
    below = np.array([0.5 * math.erfc(-v / 2**0.5) for v in z])
    above = np.array([0.5 * math.erfc(v / 2**0.5) for v in z])
    i = np.arange(1, n + 1)
    return -n - np.mean((2 * i - 1) * (np.log(below) + np.log(above[::-1])))


def test_anderson_darling_by_brute_force(spark):
    rng = np.random.default_rng(4)
    groups = {"normal": rng.normal(5, 2, 400), "ties": rng.integers(0, 6, 300).astype(float), "skewed": rng.exponential(1, 200)}
    rows = [(g, float(v)) for g, values in groups.items() for v in values]
    rows += [("one", 1.0), ("same", 2.0), ("same", 2.0), (None, 1.0), (None, 2.0), (None, 4.0), ("normal", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(3)
    got = {r["g"]: r for r in hypothesis.anderson_darling(df, "g", "v").collect()}
    for g, values in groups.items():
        assert got[g]["n"] == len(values) and got[g]["a2"] == pytest.approx(brute_a2(values), rel=1e-9)
    assert got[None]["a2"] == pytest.approx(brute_a2(np.array([1.0, 2.0, 4.0])))
    assert got["one"]["a2"] is None and got["same"]["a2"] is None and got["same"]["p"] is None
    assert got["normal"]["p"] > 0.01 and got["skewed"]["p"] < 1e-6 and got["ties"]["p"] < 1e-3
    assert hypothesis.anderson_darling(df.where("g = 'x'"), "g", "v").count() == 0


def test_sketches_merge(spark, tmp_path):
    start = datetime(2024, 5, 1)
    rows = [(start + timedelta(minutes=i % 2880), str(i % 3000), i % 997) for i in range(20_000)]
    rows += [(start + timedelta(days=4), None, None)]
    df = spark.createDataFrame(rows, "timestamp timestamp, id string, bytes long")
    hourly = sketches.hourly_sketches(df, "id", "bytes")
    archive = sketches.write_sketches(hourly, str(tmp_path / "s"))
    archive = sketches.write_sketches(hourly.where("day = 2"), str(tmp_path / "s"))  # a rerun of one day
    assert archive.count() == 49
    whole = sketches.read_sketches(sketches.merge_sketches(archive, ["month"])).first()
    assert whole["n"] == 20_001
    assert abs(whole["distinct"] - 3000) <= 4 * sketches.DISTINCT_ERROR * 3000
    values = sorted(r[2] for r in rows[:-1])
    for name, share in (("q25", 0.25), ("q50", 0.5), ("q75", 0.75)):
        below = np.searchsorted(values, whole[name], "left") / len(values)
        upto = np.searchsorted(values, whole[name], "right") / len(values)
        assert below <= share + sketches.RANK_ERROR and upto >= share - sketches.RANK_ERROR
    last = sketches.read_sketches(sketches.merge_sketches(archive.where("day = 5"), ["day"])).first()
    assert last["n"] == 1 and last["distinct"] == 0 and last["q50"] is None


def test_late_rows_are_dropped_across_restarts(spark, small, tmp_path):
    devices, users = shapes.devices(spark, small), shapes.users(spark, small)

    def start():
        stream = spark.readStream.schema(devices.schema).parquet(str(tmp_path / "in"))
        totals = streams.stream_minute_totals(usage.enrich(stream, users), "1 hour")
        return streams.write_stream_batches(totals, streams.batch_folder_writer(str(tmp_path / "out")), str(tmp_path / "state"))

    dropped = streams.replay_arrivals(plans._arrivals(devices), str(tmp_path / "in"), start)
    assert dropped[0] == 0 and all(n > 0 for n in dropped[1:])
    out = spark.read.parquet(str(tmp_path / "out"))
    assert out.groupBy("timestamp", "id", "type").count().where("count > 1").count() == 0
