import math
import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tabularium.operators import groups, order_stats

QUIET = settings(
    max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


@QUIET
@given(st.lists(st.tuples(st.sampled_from(["hot", "hot", "b", None]), st.one_of(st.none(), st.integers(-20, 20))), min_size=1, max_size=60))
def test_quantiles_equal_linear_interpolation(spark, rows):
    df = spark.createDataFrame(rows, "g string, v int")
    shares = [0.0, 0.25, 0.5, 0.9, 1.0]
    got = {r["g"]: r["q"] for r in order_stats.quantiles(df, ["g"], "v", shares).collect()}
    values = {}
    for g, v in rows:
        if v is not None:
            values.setdefault(g, []).append(v)
    assert set(got) == set(values)
    for g, v in values.items():
        assert np.allclose(got[g], np.quantile(v, shares))


@QUIET
@given(st.lists(st.integers(-5, 5), min_size=1, max_size=60))
def test_mid_ranks_average_ties(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v int")
    got = {r["value"]: r["rank"] for r in order_stats.mid_ranks(df, "v").collect()}
    ordered = sorted(values)
    for v in set(values):
        positions = [i + 1 for i, x in enumerate(ordered) if x == v]
        assert got[v] == sum(positions) / len(positions)


def test_running_counts(spark):
    df = spark.createDataFrame([("a", 3), ("a", 1), ("a", 3), ("b", 9)], "g string, v int")
    got = {(r["g"], r["value"]): (r["n"], r["before"], r["group_n"]) for r in order_stats.running_counts(df, ["g"], "v").collect()}
    assert got == {("a", 1): (1, 0, 3), ("a", 3): (2, 1, 3), ("b", 9): (1, 0, 1)}


def test_global_row_number_is_consecutive(spark):
    random.seed(3)
    rows = [(random.randrange(40), f"w{i}") for i in range(500)]
    df = spark.createDataFrame(rows, "n int, w string").repartition(6)
    got = order_stats.global_row_number(df, [F.col("n").desc(), F.col("w")], "i").collect()
    want = sorted(rows, key=lambda r: (-r[0], r[1]))
    assert [(r["n"], r["w"]) for r in sorted(got, key=lambda r: r["i"])] == want
    assert sorted(r["i"] for r in got) == list(range(1, 501))


@pytest.fixture(scope="module")
def rooms(spark):
    rows = [("a", 1.0, "x"), ("a", 3.0, "y"), ("a", None, "y"), ("b", None, "z"), ("c", 5.0, None), (None, 2.0, "x")]
    return spark.createDataFrame(rows, "g string, v double, s string")


def test_counts_and_means(spark, rooms):
    assert {(r["g"], r["n"]) for r in groups.value_counts(rooms, "g").collect()} == {("a", 3), ("b", 1), ("c", 1), (None, 1)}
    assert groups.value_counts(rooms, "g", with_nulls=False).count() == 3
    assert {r["g"]: r["mean"] for r in groups.group_means(rooms, "g", "v").collect()}["a"] == 2.0
    assert groups.distinct_count(rooms, ["g", "s"]).first().asDict() == {"g": 3, "s": 3}


def test_group_removal(rooms):
    assert {r["g"] for r in groups.drop_allnull_groups(rooms, "g", "v").collect()} == {"a", "c", None}
    assert {r["g"] for r in groups.drop_rare_groups(rooms, "g", 2).collect()} == {"a"}
    twice = rooms.union(rooms.filter("g IS NULL"))
    assert {r["g"] for r in groups.drop_rare_groups(twice, "g", 2).collect()} == {"a", None}
    silent = rooms.withColumn("v", F.when(F.col("g").isNotNull(), F.col("v")))
    assert None not in {r["g"] for r in groups.drop_allnull_groups(silent, "g", "v").collect()}
    sizes = {r["g"]: r["group_n"] for r in groups.with_group_count(rooms, "g").collect()}
    assert sizes["a"] == 3


def test_mode_takes_the_smallest_on_ties(spark):
    df = spark.createDataFrame([("a", 2), ("a", 1), ("a", 2), ("a", 1), ("b", 7), ("b", None)], "g string, v int")
    assert {r["g"]: r["mode"] for r in groups.modes(df, ["g"], "v").collect()} == {"a": 1, "b": 7}
    assert groups.modes(df, [], "v").first()["mode"] == 1
    assert [r["v"] for r in groups.fill_group_mode(df, "g", "v").filter("g = 'b'").collect()] == [7, 7]


def test_top_groups_break_ties_by_name(spark):
    df = spark.createDataFrame([("b", 2), ("a", 2), ("c", 1)], "g string, n int")
    assert [r["g"] for r in groups.top_groups(df, "n", "g", 2).collect()] == ["a", "b"]
    assert [r["g"] for r in groups.top_groups(df, "n", "g", 1, lowest=True).collect()] == ["c"]


def test_describe(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (None,)], "v double")
    r = groups.describe(df, ["v"]).first()
    assert (r["count"], r["mean"], r["sd"], r["min"], r["q1"], r["median"], r["q3"], r["max"]) == (3, 2.0, 1.0, 1.0, 1.5, 2.0, 2.5, 3.0)


def test_histogram_keeps_empty_bins_and_closes_the_last(spark):
    df = spark.createDataFrame([(0.0,), (0.1,), (10.0,)], "v double")
    assert [r["n"] for r in groups.histogram(df, "v", 4).orderBy("bin").collect()] == [2, 0, 0, 1]
    flat = spark.createDataFrame([(5.0,), (5.0,)], "v double")
    assert sum(r["n"] for r in groups.histogram(flat, "v", 3).collect()) == 2


def test_break_points(spark):
    df = spark.createDataFrame([(10.0,), (20.0,)], "v double")
    assert [r["at"] for r in groups.break_points(df, "v").orderBy("i").collect()] == [10.0 + i for i in range(11)]


def test_box_stats(spark):
    df = spark.createDataFrame([("a", float(v)) for v in [1, 2, 3, 4, 100]], "g string, v double")
    r = groups.box_stats(df, "g", "v").first()
    assert (r["q1"], r["median"], r["q3"], r["whisker_lo"], r["whisker_hi"], r["outliers"]) == (2.0, 3.0, 4.0, 1.0, 4.0, 1)


def test_density_keeps_constant_groups(spark):
    rows = [("c", 5.0)] * 4 + [("one", -3.0), ("zero", 0.0), ("zero", 0.0), (None, 2.0), ("none", None)]
    out = groups.density_grid(spark.createDataFrame(rows, "g string, v double"), "g", "v", 64).collect()
    by_group = {}
    for r in out:
        by_group.setdefault(r["g"], []).append((r["at"], r["density"]))
    assert set(by_group) == {"c", "one", "zero", None}
    for g, (size, n, centre) in {"c": (5, 4, 5), "one": (3, 1, -3), "zero": (1, 2, 0), None: (2, 1, 2)}.items():
        bw = 0.9 * size * n**-0.2
        at, density = max(by_group[g], key=lambda p: p[1])
        assert abs(at - centre) < 0.1 * bw and abs(density * bw * math.sqrt(2 * math.pi) - 1) < 0.01


def test_density_integrates_to_one(spark):
    random.seed(1)
    df = spark.createDataFrame([("a", random.gauss(0, 1)) for _ in range(400)], "g string, v double")
    rows = groups.density_grid(df, "g", "v", 128).orderBy("i").collect()
    step = rows[1]["at"] - rows[0]["at"]
    assert abs(sum(r["density"] for r in rows) * step - 1.0) < 1e-2
    assert abs(max(r["density"] for r in rows) - 1 / math.sqrt(2 * math.pi)) < 0.06


def test_correlation_matrix(spark):
    rows = [(1.0, 2.0, None), (2.0, 4.1, 1.0), (3.0, 5.9, 0.0), (4.0, 8.2, 2.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    whole = {(r["a"], r["b"]): r["r"] for r in groups.correlation_matrix(df, ["a", "b", "c"]).collect()}
    pairwise = {(r["a"], r["b"]): r["r"] for r in groups.correlation_matrix(df, ["a", "b", "c"], True).collect()}
    x = np.array([[r[0], r[1]] for r in rows])
    assert np.isclose(pairwise["a", "b"], np.corrcoef(x.T)[0, 1])
    assert np.isclose(whole["a", "b"], np.corrcoef(x[1:].T)[0, 1])
    signed = df.select((F.col("a") - 2.5).alias("a"), "b")
    plain = {(r["a"], r["b"]): r["r"] for r in groups.correlation_matrix(signed, ["a", "b"], absolute=True).collect()}
    assert np.isclose(plain["a", "b"], np.corrcoef(np.abs(x[:, 0] - 2.5), x[:, 1])[0, 1])
    assert whole["a", "b"] == whole["b", "a"] and whole["c", "c"] == 1.0


def test_feature_rollup_and_colours(spark):
    df = spark.createDataFrame(
        [("n1", 80.0, [(1, 4), (2, 6)]), ("n2", None, [(0, 3)]), ("n3", 120.0, [(1, 1), (2, 2), (3, 3)])],
        "name string, avgprice double, avgbedrooms array<struct<bedrooms:int,total:bigint>>",
    )
    rolled = {r["name"]: r for r in groups.feature_rollup(df).collect()}
    assert (rolled["n1"]["most"], rolled["n1"]["least"], rolled["n1"]["flats"], rolled["n1"]["mean_bedrooms"]) == (6, 4, 10, 1.6)
    priced = {r["name"]: r for r in groups.price_colours(df).collect()}
    assert priced["n2"]["fill"] == "red" and priced["n2"]["caption"] == "Sin datos"
    assert priced["n1"]["position"] == 0.0 and priced["n3"]["caption"] == "120 Eur"
    bars = {(r["name"], r["bedrooms"]): r["colour"] for r in groups.bar_colours(groups.feature_rollup(df)).collect()}
    assert bars["n3", 3] == "red" and bars["n3", 1] == "blue" and bars["n3", 2] == "#93CAAE"


def test_quantile_table_of_a_normal_sample_is_near_its_line(spark):
    from statistics import NormalDist

    inv = NormalDist(5, 2).inv_cdf
    df = spark.createDataFrame([("a", inv((i + 0.5) / 500)) for i in range(500)], "g string, v double")
    for r in groups.quantile_table(df, "g", "v", 19).collect():
        assert abs(r["sample"] - r["line"]) < 0.05


def test_cumulative_share(spark):
    df = spark.createDataFrame([(1, 6.0), (2, 3.0), (3, 1.0)], "k int, v double")
    got = [r["running_share"] for r in groups.cumulative_share(df, "k", "v").orderBy("k").collect()]
    assert np.allclose(got, [0.6, 0.9, 1.0])
