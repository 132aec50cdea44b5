import random
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabularium.functions import distributions as dist
from tabularium.operators import features, hypothesis, models, regression, similarity


def test_tails_match_tables():
    assert math.isclose(dist.f_tail(4.964603, 1, 10), 0.05, rel_tol=1e-4)
    assert math.isclose(dist.f_tail(2.866081, 4, 20), 0.05, rel_tol=1e-4)
    assert math.isclose(dist.chi2_tail(3.841459, 1), 0.05, rel_tol=1e-5)
    assert math.isclose(dist.chi2_tail(18.307038, 10), 0.05, rel_tol=1e-5)
    assert math.isclose(dist.t_two_sided(2.228139, 10), 0.05, rel_tol=1e-5)
    assert math.isclose(dist.t_quantile(0.95, 10), 2.228139, rel_tol=1e-5)
    assert math.isclose(dist.studentised_range_quantile(0.95, 3, 10), 3.877, rel_tol=1e-3)
    assert math.isclose(dist.studentised_range_quantile(0.95, 5, 20), 4.232, rel_tol=1e-3)
    assert math.isclose(dist.studentised_range_quantile(0.95, 4, 1e9), 3.633, rel_tol=1e-3)
    low, high = dist.binomial_interval(0, 10, 0.95)
    assert low == 0.0 and math.isclose(high, 1 - 0.025 ** 0.1, rel_tol=1e-9)


@pytest.fixture(scope="module")
def three(spark):
    data = {"a": [6, 8, 4, 5, 3, 4], "b": [8, 12, 9, 11, 6, 8], "c": [13, 9, 11, 8, 7, 12]}
    rows = [(g, float(v)) for g, vs in data.items() for v in vs] + [("a", None)]
    return data, spark.createDataFrame(rows, "g string, v double")


def test_anova(three):
    row = hypothesis.anova(three[1], "g", "v").first()
    assert (row["df_between"], row["df_within"]) == (2, 15)
    assert math.isclose(row["f"], 9.264706, rel_tol=1e-6)
    assert math.isclose(row["p"], 0.0023988, rel_tol=1e-3)


def test_kruskal_wallis(three):
    data, df = three
    pooled = sorted(v for vs in data.values() for v in vs)
    rank = {v: np.mean([i + 1 for i, x in enumerate(pooled) if x == v]) for v in set(pooled)}
    n = len(pooled)
    h = 12 / (n * (n + 1)) * sum(sum(rank[v] for v in vs) ** 2 / len(vs) for vs in data.values()) - 3 * (n + 1)
    ties = sum(pooled.count(v) ** 3 - pooled.count(v) for v in set(pooled))
    h /= 1 - ties / (n ** 3 - n)
    row = hypothesis.kruskal_wallis(df, "g", "v").first()
    assert math.isclose(row["h"], h, rel_tol=1e-9)
    assert math.isclose(row["p"], math.exp(-h / 2), rel_tol=1e-9)


def test_tukey_and_similarity(three):
    data, df = three
    rows = {(r["group_a"], r["group_b"]): r for r in hypothesis.tukey_pairs(df, "g", "v").collect()}
    assert set(rows) == {("a", "b"), ("a", "c"), ("b", "c")}
    ab = rows["a", "b"]
    assert math.isclose(ab["diff"], 4.0) and ab["low"] < 4.0 < ab["high"]
    mse = sum(np.var(v) * 6 for v in data.values()) / 15
    width = dist.studentised_range_quantile(0.95, 3, 15) * math.sqrt(mse / 6)
    assert math.isclose(ab["high"] - ab["diff"], width, rel_tol=1e-6)
    cells = {(r["group_a"], r["group_b"]): r["value"] for r in hypothesis.group_similarity(df, "g", "v").collect()}
    assert len(cells) == 9 and cells["a", "a"] == 1.0 and cells["a", "c"] == cells["c", "a"]


def test_normality(spark):
    rng = np.random.default_rng(1)
    rows = [("n", float(v)) for v in rng.normal(size=500)] + [("e", float(v)) for v in rng.exponential(size=500)]
    got = {r["g"]: r["p"] for r in hypothesis.normality(spark.createDataFrame(rows, "g string, v double"), "g", "v").collect()}
    assert got["n"] > 0.01 and got["e"] < 1e-6


HOUSES = [
    (1710, 2003, 208500), (1262, 1976, 181500), (1786, 2001, 223500), (1717, 1915, 140000),
    (2198, 2000, 250000), (1362, 1993, 143000), (1694, 2004, 307000), (2090, 1973, 200000),
    (1774, 1931, 129900), (1077, 1939, 118000),
]


def test_least_squares_example(spark):
    df = spark.createDataFrame([tuple(map(float, r)) for r in HOUSES], "area double, year double, price double")
    fit = regression.least_squares(df, ["area", "year"], "price")
    assert np.allclose(fit.coefficients, [-2.29223802e6, 59.2536529, 1207.80450], rtol=1e-7)
    x = np.column_stack([np.ones(10), np.array(HOUSES)[:, :2]])
    y = np.array(HOUSES)[:, 2]
    beta = np.linalg.solve(x.T @ x, x.T @ y)
    s2 = ((y - x @ beta) ** 2).sum() / 7
    assert np.allclose(fit.errors, np.sqrt(np.diag(np.linalg.inv(x.T @ x)) * s2), rtol=1e-5)
    table = {r["term"]: r for r in regression.coefficient_table(spark, fit).collect()}
    area = table["area"]
    assert math.isclose((area["high"] - area["low"]) / 2, dist.t_quantile(0.95, 7) * area["std_error"], rel_tol=1e-6)
    assert math.isclose(area["p"], dist.t_two_sided(area["t"], 7), rel_tol=1e-9)
    residuals = regression.with_residuals(df, fit, "price").agg(F.sum("residual")).first()[0]
    assert abs(residuals) < 1e-3


def test_gradient_descent_example(spark):
    y = [208500.0, 181500.0, 223500.0, 140000.0, 250000.0]
    x = [0.37020659, -0.48234664, 0.51483616, 0.38352774, 1.29888065]
    df = spark.createDataFrame(list(zip(x, y)), "x double, y double")
    out = regression.gradient_descent(df, ["x"], "y", 0.01, 2000, [0.69646919, 0.28613933], standardise=False)
    last = out.filter("iteration = 2000").first()
    assert np.allclose(last["w"], [183845.82320222, 40415.66453324], rtol=1e-6)
    losses = [r["loss"] for r in out.orderBy("iteration").limit(50).collect()]
    assert all(a > b for a, b in zip(losses, losses[1:]))


def test_sum_of_squared_errors_example(spark):
    df = spark.createDataFrame([(1.0, 1.01), (2.0, 1.75), (3.0, 2.81), (4.0, 3.99)], "y double, f double")
    assert math.isclose(regression.error_metrics(df, "y", "f").first()["sse"], 0.0988, rel_tol=1e-9)


def random_frame(spark, n=300, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 4)) * [1, 5, 0.1, 2] + [0, 3, 1, -2]
    y = 3 * x[:, 0] + 0.5 * x[:, 1] + rng.normal(size=n)
    rows = [(str(i), *map(float, x[i]), float(y[i])) for i in range(n)]
    return x, y, spark.createDataFrame(rows, "id string, a double, b double, c double, d double, y double")


def test_lasso_satisfies_its_optimality_conditions(spark):
    x, y, df = random_frame(spark)
    names, alpha = ["a", "b", "c", "d"], 0.3
    fit = regression.fit_lasso(regression.moments(df, names, "y"), names, alpha)
    z = (x - x.mean(0)) / x.std(0)
    grad = z.T @ (y - y.mean() - z @ fit.weights) / len(y)
    for g, w in zip(grad, fit.weights):
        assert abs(g) <= alpha + 1e-8
        if w != 0:
            assert math.isclose(g, alpha * np.sign(w), abs_tol=1e-8)
    assert fit.weights[2] == 0.0 and fit.weights[0] > 1
    guess = regression.linear_value(fit.raw_coefficients(), names)
    direct = fit.intercept + z @ fit.weights
    got = [r["g"] for r in df.orderBy(F.col("id").cast("int")).select(guess.alias("g")).collect()]
    assert np.allclose(got, direct)


def test_lasso_cv_errors_equal_refits_on_the_rows(spark):
    x, y, df = random_frame(spark, 120)
    names = ["a", "b", "c", "d"]
    scores, _ = regression.lasso_cv(df, names, "y", "id", [0.01, 0.5], folds=4)
    from tabularium.functions.columns import bucket_of

    fold = np.array([r["f"] for r in df.orderBy(F.col("id").cast("int")).select(bucket_of("id", 4, "fold").alias("f")).collect()])
    z = (x - x.mean(0)) / x.std(0)
    for alpha, got in scores:
        errors = []
        for f in range(4):
            tr, te = fold != f, fold == f
            m, ym = z[tr].mean(0), y[tr].mean()
            w = regression.lasso_weights((z[tr] - m).T @ (z[tr] - m), (z[tr] - m).T @ (y[tr] - ym), tr.sum(), alpha)
            errors.append(((y[te] - ym - (z[te] - m) @ w) ** 2).mean())
        assert math.isclose(got, np.mean(errors), rel_tol=1e-7)


def test_features(spark):
    df = spark.createDataFrame([(1.0, "x", 10.0), (3.0, "x", 20.0), (None, "y", 60.0), (2.0, None, 30.0)], "v double, s string, t double")
    filled = features.fit_imputer(df, ["v"], ["s"]).apply(df)
    assert filled.filter("v IS NULL OR s IS NULL").count() == 0
    assert filled.filter("t = 60").first()["v"] == 2.0
    encoder = features.fit_target_encoder(df, ["s"], "t")
    unseen = spark.createDataFrame([("x",), ("new",), (None,)], "s string")
    got = {r["s"]: r["e"] for r in encoder.apply(unseen, {"s": "e"}).collect()}
    assert got == {"x": 15.0, "new": 30.0, None: 30.0}
    z = features.fit_scaler(df, ["t"]).apply(df).agg(F.avg("t_z"), F.stddev_pop("t_z")).first()
    assert abs(z[0]) < 1e-12 and math.isclose(z[1], 1.0)


def test_feature_scores_rank_the_informative_feature_first(spark):
    _, _, df = random_frame(spark, 400)
    rows = {r["feature"]: r for r in features.feature_scores(df, ["a", "c"], "y").collect()}
    assert rows["a"]["f"] == 1.0 and rows["a"]["mi"] == 1.0 and rows["c"]["f"] < 0.1
    assert rows["a"]["keep"]


def test_svd_example(spark):
    df = spark.createDataFrame([([1.0, 2.0],), ([3.0, 4.0],)], "v array<double>")
    values, right = models.truncated_svd(df, "v", 2, 2)
    assert np.allclose(values, [5.4649857, 0.36596619], rtol=1e-6)
    back = models.low_rank(df, "v", right)
    assert models.reconstruction_error(back, "v", "approx").first()["sse"] < 1e-12
    one = models.low_rank(df, "v", right[:, :1])
    assert math.isclose(models.reconstruction_error(one, "v", "approx").first()["sse"], values[1] ** 2, rel_tol=1e-9)
    assert math.isclose(models.compression_ratio(100, 50, 10), 1510 / 5000)


def test_pca_and_neighbours(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(80, 3)) @ np.array([[3, 1, 0], [0, 1, 0], [0, 0, 0.2]])
    df = spark.createDataFrame([(i, [float(v) for v in x[i]]) for i in range(80)], "id int, vector array<double>")
    model = models.fit_pca(df, "vector", 3)
    shares = models.pca_shares(spark, model, 3).orderBy("component").collect()
    want = np.sort(np.linalg.eigvalsh(np.corrcoef(x.T)))[::-1]
    assert np.allclose([r["eigenvalue"] for r in shares], want)
    assert math.isclose(shares[-1]["running_share"], 1.0)
    scored = models.pca_scores(model, df, "vector")
    near = similarity.nearest_rows(scored, "id", "scores", 7, 3).collect()
    assert near[0]["id"] == 7 and near[0]["distance"] < 1e-12


def test_group_clusters(spark):
    rows = [(f"g{i}", float(base + j)) for i, base in enumerate([0, 1, 100, 101, 500]) for j in range(5)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r["g"]: r["cluster"] for r in models.cluster_groups(df, "g", "v", 3).collect()}
    assert got["g0"] == got["g1"] == 1 and got["g4"] == 3


def test_forest_learns_and_ranks(spark):
    _, _, df = random_frame(spark, 200)
    names = ["a", "b", "c", "d"]
    found = models.forest_cv(df, names, "y", "id", [1, 4], trees=5, folds=2)
    assert found.avgMetrics[1] > found.avgMetrics[0]
    ranked = models.importances(spark, models.fit_forest(df, names, "y", 4, 10), names).collect()
    assert ranked[0]["feature"] in ("a", "b") and ranked[0]["importance"] == 1.0


def test_control_comparisons_are_rows_of_the_pair_table(three):
    _, df = three
    pairs = {}
    for r in hypothesis.tukey_pairs(df, "g", "v").collect():
        pairs[r["group_a"], r["group_b"]] = (r["diff"], r["low"], r["high"], r["p_adj"])
        pairs[r["group_b"], r["group_a"]] = (-r["diff"], -r["high"], -r["low"], r["p_adj"])
    control = min(a for a, _ in pairs)
    got = hypothesis.tukey_to_control(df, "g", "v", control).collect()
    assert len(got) == len({b for _, b in pairs}) - 1
    for r in got:
        want = pairs[control, r["g"]]
        assert all(abs(a - b) < 1e-6 for a, b in zip((r["diff"], r["low"], r["high"], r["p_adj"]), want))


def test_factor_regression_equals_least_squares_on_dummies(spark):
    rng = random.Random(4)
    rows = []
    for i in range(600):
        level = f"l{i % 250:03d}" if i % 3 else "base"
        x, z = rng.gauss(0, 1), rng.gauss(2, 3)
        rows.append((level, x, z, 1.5 * x - 0.5 * z + len(level) + (i % 7) + rng.gauss(0, 1)))
    df = spark.createDataFrame(rows, "f string, x double, z double, y double")
    levels = sorted({r[0] for r in rows})
    design = np.array([[1.0, x, z, *[float(level == v) for v in levels[1:]]] for level, x, z, _ in rows])
    y = np.array([r[3] for r in rows])
    inverse = np.linalg.inv(design.T @ design)
    beta = inverse @ design.T @ y
    residual = y - design @ beta
    error = np.sqrt(residual @ residual / (len(y) - design.shape[1]) * np.diag(inverse))
    names = ["(intercept)", "x", "z", *[f"f={v}" for v in levels[1:]]]
    got = {r["term"]: r for r in regression.factor_regression(df, ["x", "z"], "f", "y").collect()}
    assert set(got) == set(names) and len(names) > 200
    for name, b, e in zip(names, beta, error):
        assert abs(got[name]["estimate"] - b) < 1e-6 and abs(got[name]["std_error"] - e) < 1e-6
    assert abs(got["x"]["r2"] - (1 - residual @ residual / ((y - y.mean()) @ (y - y.mean())))) < 1e-9


def test_kolmogorov_smirnov_takes_the_law_as_given(spark):
    rng = random.Random(2)
    df = spark.createDataFrame([(rng.gauss(10, 2),) for _ in range(500)], "v double")
    assert hypothesis.ks_normal(df, "v", 10.0, 2.0).first()["p"] > 0.01
    assert hypothesis.ks_normal(df, "v", 12.0, 2.0).first()["p"] < 1e-6
