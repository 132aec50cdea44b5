from datetime import date

import pytest
from pyspark.sql import functions as F

from tabularium.functions import columns as c
from tabularium.operators import cleaning, splits


def test_postal_codes(spark):
    cases = {
        "": None, "-": None, "28": None, "27004": None, "Madrid 28004": None,
        "28002\n28002": "28002", "2804": "28004", "2805": "28005", "2815": "28015",
        "28045": "28045", " 28010": "28010",
    }
    df = spark.createDataFrame([(i, k) for i, k in enumerate(cases)], "id int, code string")
    out = {r["id"]: r["code"] for r in cleaning.repair_codes(df, "code").collect()}
    assert [out[i] for i in range(len(cases))] == list(cases.values())


def test_single_corrections_win(spark):
    df = spark.createDataFrame([(1, "28001"), (2, "-"), (3, None)], "id int, code string")
    patch = spark.createDataFrame([(2, "28044")], "id int, code string")
    out = {r["id"]: r["code"] for r in cleaning.repair_codes(df, "code", patch).collect()}
    assert out == {1: "28001", 2: "28044", 3: None}


@pytest.mark.parametrize("inclusive, kept", [(False, [2]), (True, [1, 2, 3])])
def test_range_cutoffs(spark, inclusive, kept):
    df = spark.createDataFrame([(1,), (2,), (3,), (None,)], "v int")
    out = cleaning.range_cutoffs(df, [("v", 1, 3)], inclusive)
    assert [r["v"] for r in out.collect()] == kept


def test_filters(spark):
    df = spark.createDataFrame(
        [("a", "x", "x"), ("b", "", "y"), ("a", "z", None)], "k string, p string, q string"
    )
    assert cleaning.non_empty(df, "p").count() == 2
    assert cleaning.members(df, "k", ["b", "c"]).count() == 1
    assert cleaning.all_equal(df, {"k": "a", "p": "x"}).count() == 1
    assert cleaning.differing(df, "p", "q").count() == 1
    assert cleaning.differing(df, "p", "q", nulls_differ=True).count() == 2
    assert cleaning.complete_rows(df).count() == 2


def test_nullify_and_recode(spark):
    df = spark.createDataFrame([(0.0, 0), (10.0, 2), (400.0, 1), (None, 3)], "m double, b int")
    out = cleaning.nullify(df, {"m": (F.col("m") == 0) | (F.col("m") > 300)})
    assert [r["m"] for r in out.collect()] == [None, 10.0, None, None]
    assert [r["b"] for r in cleaning.recode(df, "b", {0: 1}).collect()] == [1, 2, 1, 3]


def test_scalar_helpers(spark):
    df = spark.createDataFrame([("6u", "2020-02-30", 1000.0), ("x", "2011-05-01", 0.0)], "q string, d string, f double")
    rows = df.select(
        c.unit_number("q").alias("q"), c.parse_day("d").alias("d"),
        c.square_metres("f").alias("m"), c.year_offset(c.parse_day("d")).alias("y"),
    ).collect()
    assert rows[0]["q"] == 6.0 and rows[1]["q"] is None
    assert rows[0]["d"] is None and rows[1]["d"] == date(2011, 5, 1)
    assert rows[0]["m"] == 92.9 and rows[1]["y"] == 4


def test_profiles(spark):
    df = spark.createDataFrame([(0, "a"), (1, None), (None, "b"), (4, "c")], "n int, s string")
    shape = {r["column"]: r for r in cleaning.shape_profile(df).collect()}
    assert shape["n"]["rows"] == 4 and shape["n"]["non_null"] == 3 and shape["s"]["type"] == "string"
    row = cleaning.null_profile(df, ["n"]).first()
    assert row["nulls"] == 1 and row["null_percent"] == 25.0
    assert abs(row["zero_percent"] - 100 / 3) < 1e-9


def test_interactions(spark):
    df = spark.createDataFrame([(2, 3.0, 4.0, 5.0)], "b int, t double, la double, lo double")
    row = cleaning.interactions(df, "b", "t", "la", "lo").first()
    assert (row["bedrooms_squared"], row["bed_bath_rooms"], row["lat_times_lon"]) == (4, 6.0, 20.0)


def test_splits_are_disjoint_repeatable_and_complete(spark):
    df = spark.range(5000).withColumnRenamed("id", "k")
    first = splits.comment_splits(df, "k")
    again = splits.comment_splits(df.repartition(7), "k")
    assert first.exceptAll(again).count() == 0
    shares = {r["split"]: r["count"] / 5000 for r in first.groupBy("split").count().collect()}
    assert abs(shares["test"] - 0.25) < 0.03 and abs(shares["eval"] - 0.15) < 0.03
    sample, rest = splits.sample_and_rest(df, "k", 70)
    assert sample.count() + rest.count() == 5000
    assert sample.join(rest, "k").count() == 0
    with pytest.raises(ValueError):
        splits.with_split(df, "k", {"a": 60, "b": 30})


def test_group_sample_matches_brute_force(spark):
    df = spark.range(6000).select(
        F.col("id").alias("k"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 40)).alias("g"),
    )
    out = splits.fixed_group_sample(df, "g", "k", 50, hex_digits=2)
    import hashlib

    groups = {}
    for r in df.collect():
        groups.setdefault(r["g"], []).append((hashlib.md5(str(r["k"]).encode()).hexdigest(), r["k"]))
    want = {(g, k) for g, rows in groups.items() for _, k in sorted(rows)[:50]}
    assert {(r["g"], r["k"]) for r in out.collect()} == want
