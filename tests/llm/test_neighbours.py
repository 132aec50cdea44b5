"""Nearest neighbours by NN-descent against all inner products."""

import math

import numpy as np
import pytest
from tabularium.llm import nndescent

COLUMNS = "vec_id long, embedding array<float>, label int, score string, node string, rank string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "s", "n", "r") for i, v in rows], COLUMNS).repartition(3)


def brute_force(rows):
    """{query: [(vec_id, score)]} by the contract."""
    good = {
        (i, tuple(v))
        for i, v in rows
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)
    }
    good = [(i, np.array(v, np.float32).astype(float)) for i, v in good]
    found = {}
    for i, v in good:
        if i % 20 == 0:
            others = [(j, float(v @ w)) for j, w in good if not (j == i and (w == v).all())]
            found[i] = sorted(others, key=lambda x: (-round(x[1], 12), x[0]))[:20]
    return found


def answers(df):
    found = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        found.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(found[r["query_id"]])
    return found


def recall(got, expected):
    assert set(got) == {q for q, x in expected.items() if x}
    hit = total = 0
    for q, mine in got.items():
        best = expected[q]
        assert len(mine) == len(best) == len({i for i, _ in mine})
        hit += len({i for i, _ in mine} & {i for i, _ in best})
        total += len(best)
    return hit / total


def test_documents_recall(spark, small):
    rows = [tuple(r) for r in spark.read.parquet(f"{small}/embeddings.parquet").select("vec_id", "embedding").collect()]
    got, expected = answers(nndescent.op11_nearest_neighbours(spark, small)), brute_force(rows)
    assert recall(got, expected) >= 0.9
    exact = dict(rows)
    for q, mine in got.items():
        for i, score in mine:
            assert abs(score - np.dot(np.array(exact[q], float), np.array(exact[i], float))) < 1e-12
        assert mine == sorted(mine, key=lambda x: (-x[1], x[0]))


def test_odd_vectors(spark):
    """Copies, long vectors, ties, and vectors that take no part."""
    rng = np.random.default_rng(2)
    rows = [(i, rng.standard_normal(8).tolist()) for i in range(90)]
    rows += [(100 + i, rows[3][1]) for i in range(200)]  # most rows are one vector
    rows += [(400 + i, (np.array(rows[i][1]) * 3).tolist()) for i in range(30)]
    rows += rows[:5] + [(20, rng.standard_normal(8).tolist())]  # a repeated id
    bad = [None, [], [0.0] * 8, [1.0, None] + [1.0] * 6, [math.nan] + [1.0] * 7, [math.inf] * 8, [1.0] * 7]
    odd = [(500 + 20 * i, v) for i, v in enumerate(bad)] + [(None, rows[0][1])]
    got = answers_with_repeats(nndescent.nearest(spark, frame(spark, rows + odd)))
    expected = brute_force(rows)
    assert set(got) == set(expected)
    hit = total = 0
    for q, best in expected.items():
        if q != 20:  # listed once for each of its two vectors
            assert len(got[q]) == 20
            hit += len(set(got[q]) & {i for i, _ in best})
            total += 20
    assert hit / total >= 0.95
    assert got[100] == [i for i, _ in expected[100]]  # ties go to the smaller id


def answers_with_repeats(df):
    found = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        found.setdefault(r["query_id"], []).append(r["vec_id"])
    return found


@pytest.mark.parametrize("n", [0, 1, 2, 19])
def test_few_rows(spark, n):
    """All candidates are listed where there are fewer than 20."""
    rng = np.random.default_rng(n)
    rows = [(20 * i, rng.standard_normal(4).tolist()) for i in range(n)]
    got = nndescent.nearest(spark, frame(spark, rows))
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert recall(answers(got), brute_force(rows)) == 1 if n > 1 else got.count() == 0
