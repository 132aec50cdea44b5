import numpy as np
import pytest
from tabularium.operators import decomposition


def table(spark, x, parts=5):
    rows = [(i, [float(v) for v in row]) for i, row in enumerate(x)]
    return spark.createDataFrame([*rows, (-1, None), (-2, [None] * x.shape[1])], "id long, v array<double>").repartition(parts)


def test_tall_vectors_against_numpy(spark):
    x = np.random.default_rng(1).normal(size=(300, 12)) * np.arange(1, 13)
    df = table(spark, x, 40)  # more parts than one merge takes
    values, right = decomposition.tall_svd(df, "v", 12)
    u0, s0, vt0 = np.linalg.svd(x, full_matrices=False)
    assert values == pytest.approx(s0)
    assert np.abs(np.sum(right * vt0.T, axis=0)) == pytest.approx(np.ones(12))
    left = decomposition.left_vectors(df, "v", values, right)
    got = {r["id"]: r["u"] for r in left.collect()}
    assert sorted(got) == list(range(300))
    u = np.array([got[i] for i in range(300)])
    assert u.T @ u == pytest.approx(np.eye(12), abs=1e-10)
    back = {r["id"]: r["approx"] for r in decomposition.rebuilt(left, "u", values, right).collect()}
    assert np.array([back[i] for i in range(300)]) == pytest.approx(x)


def test_wide_table_by_a_random_range(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(200, 5)) @ rng.normal(size=(5, 400)) + 0.01 * rng.normal(size=(200, 400))
    df = table(spark, x)
    values, right = decomposition.wide_svd(df, "v", 400, 5)
    s0 = np.linalg.svd(x, compute_uv=False)
    assert values == pytest.approx(s0[:5], rel=1e-6)
    left = decomposition.left_vectors(df, "v", values, right)
    approx = decomposition.rebuilt(left, "u", values, right).collect()
    sse = sum(float(np.sum((np.array(r["approx"]) - x[r["id"]]) ** 2)) for r in approx)
    assert sse == pytest.approx(float(np.sum(s0[5:] ** 2)), rel=1e-4)


def test_fewer_rows_than_columns_low_rank_and_no_rows(spark):
    x = np.outer([1.0, 2.0, 3.0], np.arange(6.0))
    df = table(spark, x, 2)
    values, right = decomposition.tall_svd(df, "v", 4)
    assert values[0] == pytest.approx(np.linalg.norm(x)) and values[1:] == pytest.approx(0, abs=1e-12)
    u = np.array([r["u"] for r in decomposition.left_vectors(df, "v", values, right).orderBy("id").collect()])
    assert (u[:, 1:] == 0).all() and np.abs(u[:, 0]) == pytest.approx(np.array([1, 2, 3]) / 14**0.5)
    empty = df.where("id > 99")
    values, right = decomposition.tall_svd(empty, "v", 4)
    assert len(values) == 0
    assert len(decomposition.wide_svd(empty, "v", 6, 2)[0]) <= 2
