import random

import numpy as np
import pytest

from tabularium.operators import forests


def table(spark, rows, names):
    return spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names)).coalesce(1)


def walked(nodes, tree, row):
    n = nodes[tree]
    path = [n]
    while n["feature"] is not None:
        n = nodes[n["left"] if row[n["feature"]] <= n["threshold"] else n["right"]]
        path.append(n)
    return path


def best_gain(x, y, w):
    """The largest fall of the squared error over all splits of all columns, from the rows themselves."""

    def error(m):
        return 0.0 if not w[m].sum() else (w[m] * (y[m] - np.average(y[m], weights=w[m])) ** 2).sum()

    every = np.ones(len(y), bool)
    found = [0.0]
    for i in range(x.shape[1]):
        for v in np.unique(x[:, i]):
            m = x[:, i] <= v
            found.append(error(every) - error(m) - error(~m))
    return max(found)


def test_every_split_is_the_best_one_of_the_bootstrapped_rows(spark):
    rng = random.Random(3)
    rows = [(float(rng.randrange(9)), float(rng.randrange(14)), rng.gauss(50, 9)) for _ in range(300)]
    model = forests.fit(table(spark, rows, "aby"), ["a", "b"], "y", 4, 5, seed=7)
    nodes = {r["node"]: r.asDict() for r in model.nodes(spark).collect()}
    x, y = np.array([r[:2] for r in rows]), np.array([r[2] for r in rows])
    gains = np.zeros((5, 2))
    for t in range(5):
        w = forests.bootstrap(len(rows), 7, 0, t).astype(float)
        inside = {}
        for i, r in enumerate(rows):
            for n in walked(nodes, t, {"a": r[0], "b": r[1]}):
                inside.setdefault(n["node"], []).append(i)
        for node, at in inside.items():
            n = nodes[node]
            assert n["tree"] == t and n["weight"] == w[at].sum()
            if n["weight"]:
                assert abs(n["value"] - np.average(y[at], weights=w[at])) < 1e-9
            if n["feature"] is not None:
                assert abs(n["gain"] - best_gain(x[at], y[at], w[at])) < 1e-6
                gains[t, "ab".index(n["feature"])] += n["gain"]
    shares = (gains / gains.sum(axis=1, keepdims=True)).mean(axis=0)
    assert np.allclose(model.featureImportances.toArray(), shares)
    seen = model.transform(table(spark, rows, "aby")).collect()
    for r in seen[:40]:
        want = np.mean([walked(nodes, t, r.asDict())[-1]["value"] for t in range(5)])
        assert abs(r["prediction"] - want) < 1e-9


def test_many_blocks_and_node_groups_give_the_rows_of_one_tree_level(spark, monkeypatch):
    rng = random.Random(5)
    rows = [(float(rng.randrange(40)), rng.random(), float(i % 3), rng.gauss(0, 1)) for i in range(6000)]
    frame = table(spark, rows, "abcy")
    whole = forests.fit(frame, ["a", "b", "c"], "y", 5, 6)
    monkeypatch.setattr(forests, "SUMS", 1 << 13)  # few nodes at once
    parts = forests.fit(frame, ["a", "b", "c"], "y", 5, 6)
    assert len(whole.left) > 100
    assert (whole.left == parts.left).all() and (whole.cut == parts.cut).all() and np.allclose(whole.gain, parts.gain)
    level = whole.tree[: whole.trees]
    assert abs(whole.weight[level].sum() / (6 * len(rows)) - 1) < 0.03  # all blocks take part in every tree
    assert len(whole.cuts[1]) == 31 and len(whole.cuts[2]) == 2


def test_weights_are_poisson_and_repeat_by_key():
    w = forests.bootstrap(400_000, 1, 2, 3)
    assert (w == forests.bootstrap(400_000, 1, 2, 3)).all() and (w != forests.bootstrap(400_000, 1, 2, 4)).any()
    share = np.bincount(w, minlength=6) / w.size
    assert np.allclose(share[:5], [0.36788, 0.36788, 0.18394, 0.06131, 0.01533], atol=0.004)
    assert abs(w.var() - 1) < 0.02 and w.max() < 19


def test_a_rare_value_is_cut_off(spark):
    """Cut points come from all rows; a sample of 10,000 would mostly not hold both rare rows' value."""
    frame = spark.range(0, 60_000, 1, 3).selectExpr("if(id = 41234, 9D, id % 3) AS a", "if(id = 41234, 1e6D, 0D) AS y")
    model = forests.fit(frame, ["a"], "y", 2, 8)
    assert 5.5 in model.cuts[0].tolist()


def test_odd_tables(spark):
    nan = float("nan")
    rows = [(1.0, None, 1.0), (None, 2.0, 5.0), (nan, 2.0, 5.0), (3.0, 4.0, 2.0)]
    model = forests.fit(table(spark, rows, "aby"), ["a", "b"], "y", 3, 4)
    assert model.featureImportances.toArray().tolist() == [0.0, 0.0]
    got = [r["prediction"] for r in model.transform(table(spark, rows, "aby")).collect()]
    assert got == [None, None, None, 2.0]
    same = forests.fit(table(spark, [(float(i), 0.1) for i in range(50)], "ay"), ["a"], "y", 3, 4)
    assert len(same.left) == 4
    with pytest.raises(ValueError):
        forests.fit(table(spark, rows[:3], "aby"), ["a", "b"], "y", 3, 4)
    with pytest.raises(Exception, match="labels must not"):
        forests.fit(table(spark, [(1.0, None), (2.0, 1.0)], "ay"), ["a"], "y", 3, 4)
