from collections import Counter

import numpy as np
import pytest
from tabularium.operators import text as ops
from tabularium.operators import word_factors as wf

TEXT = ["a b a c", "c  b", "", None, "a", "b a b a"]


def frame(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, text string").repartition(3)


def brute_pairs(texts, window):
    out = Counter()
    for t in texts:
        w = [x for x in (t or "").split(" ") if x]
        for i, x in enumerate(w):
            for y in w[i + 1 : i + 1 + window]:
                out[min(x, y), max(x, y)] += 1
    return out


@pytest.mark.parametrize("window", [1, 2, 7])
def test_pairs_by_hand(spark, window):
    got = wf.word_pairs(frame(spark, TEXT), window=window).collect()
    assert {(r["a"], r["b"]): r["n"] for r in got} == brute_pairs(TEXT, window)


def talks(rng, topics=6, per=30, texts=400):
    """Texts about one topic each, with some words of all topics."""
    out = []
    for _ in range(texts):
        t = rng.integers(topics)
        own = [f"w{t}x{rng.integers(per)}" for _ in range(20)]
        out.append(" ".join(rng.permutation(own + [f"all{rng.integers(20)}" for _ in range(8)])))
    return out


def exact(texts, vocab, min_count, window):
    index = {r["word"]: r["index"] for r in vocab.collect() if r["n"] >= min_count}
    x = np.zeros((max(index.values()) + 1,) * 2)
    for (a, b), n in brute_pairs(texts, window).items():
        if a in index and b in index:
            x[index[a], index[b]] += n
            x[index[b], index[a]] += n
    with np.errstate(divide="ignore", invalid="ignore"):
        v = np.log(x * x.sum() / np.outer(x.sum(1), x.sum(1)))
    return np.where(np.isfinite(v) & (v > 0), v, 0.0)


def test_vectors_against_an_exact_factorisation(spark, monkeypatch):
    monkeypatch.setattr(wf, "BLOCK", 64)  # several blocks,
    monkeypatch.setattr(wf, "FAN", 2)  # several levels of sums
    texts = talks(np.random.default_rng(3))
    df = frame(spark, texts)
    vocab = ops.vocabulary(df)
    whole = exact(texts, vocab, 5, 7)
    cells = wf.affinity(wf.word_pairs(df), vocab, 5)
    got = np.zeros_like(whole)
    for r in cells.collect():
        got[r["i"], r["j"]] = r["v"]
    assert got == pytest.approx(whole)
    size = 6
    values, vectors = wf.factorise(cells, size, more=10, passes=5)
    true, own = np.linalg.eigh(whole)
    top = np.argsort(true)[::-1][:size]
    assert values == pytest.approx(true[top], rel=1e-3)
    found = {r["index"]: r["vec"] for r in vectors.collect()}
    assert sorted(found) == sorted(np.flatnonzero(whole.any(axis=1)))
    ids = sorted(found)
    mine = np.array([found[i] for i in ids])
    assert (np.sum(mine**3, axis=0) > 0).all()
    theirs = own[ids][:, top] * np.sqrt(true[top])

    def neighbours(x, k=10):
        x = x / np.linalg.norm(x, axis=1, keepdims=True)
        near = x @ x.T - 2 * np.eye(len(x))
        return [set(row) for row in np.argsort(-near, axis=1)[:, :k]]

    met = [len(a & b) / 10 for a, b in zip(neighbours(mine), neighbours(theirs))]
    assert np.mean(met) >= 0.9
    words = {r["index"]: r["word"] for r in vocab.collect()}
    topical = [n for n, i in enumerate(ids) if words[i].startswith("w")]
    same = [np.mean([words[ids[m]][:2] == words[ids[n]][:2] for m in neighbours(mine)[n]]) for n in topical]
    assert np.mean(same) > 0.95  # neighbours are words of the same topic


def test_fewer_words_than_components_and_none(spark):
    df = frame(spark, TEXT)
    vocab = ops.vocabulary(df)
    table = wf.fit_word_vectors(df, vocab, size=50, window=2, min_count=2)
    rows = {r["word"]: r["vector"] for r in table.collect()}
    assert sorted(rows) == ["a", "b", "c"] and all(v is None or 1 <= len(v) <= 3 for v in rows.values())
    whole = exact(TEXT, vocab, 2, 2)
    values, _ = wf.factorise(wf.affinity(wf.word_pairs(df, window=2), vocab, 2), 50)
    true = np.linalg.eigvalsh(whole)[::-1]
    assert values == pytest.approx(true[true > 1e-9])
    none = wf.fit_word_vectors(df.where("id > 99"), vocab, size=4)
    assert [r["vector"] for r in none.collect()] == [None, None, None]


def test_context_counts_by_hand(spark):
    import hashlib

    df = frame(spark, TEXT + ["x a y b z"])
    got = ops.context_counts(df, ops.vocabulary(df), size=5, window=2, min_count=2).collect()
    wanted, often = Counter(), Counter(x for t in TEXT + ["x a y b z"] for x in (t or "").split())
    for t in TEXT + ["x a y b z"]:
        w = (t or "").split()
        for i, x in enumerate(w):
            for y in w[max(i - 2, 0) : i] + w[i + 1 : i + 3]:
                digest = hashlib.md5(y.encode()).hexdigest()
                if often[x] >= 2:
                    wanted[x, int(digest[:8], 16) % 5 + 1] += -1 if int(digest[8], 16) % 2 else 1
    assert {(r["word"], r["dim"]): r["value"] for r in got if r["value"]} == {k: v for k, v in wanted.items() if v}


def test_words_are_counted_before_the_shuffle(spark):
    df = frame(spark, ["a b"] * 50)
    for made in (wf.word_pairs(df), ops.context_counts(df, ops.vocabulary(df))):
        plan = made._jdf.queryExecution().executedPlan().toString()
        assert "MapInArrow" in plan and "explode" not in plan.split("MapInArrow")[0]


def test_pairs_of_known_words(spark):
    df = frame(spark, TEXT)
    known = spark.createDataFrame([("a",), ("b",)], "word string")
    got = {(r["a"], r["b"]): r["n"] for r in wf.word_pairs(df, window=2, known=known).collect()}
    assert got == {k: n for k, n in brute_pairs(TEXT, 2).items() if set(k) <= {"a", "b"}}


def numbered(texts, vocab, min_count, window):
    index = {r["word"]: r["index"] for r in vocab.collect() if r["n"] >= min_count}
    wanted = Counter()
    for (a, b), n in brute_pairs(texts, window).items():
        if a in index and b in index:
            wanted[tuple(sorted((index[a], index[b])))] += n
    return wanted


def unpacked(blocks):
    out = Counter()
    for r in (r.asDict() for r in blocks.collect()):
        key, n = wf._places(bytes(r["gaps"]), r["many"]), wf._spread(bytes(r["ns"]), r["many"])
        for k, m in zip(key.tolist(), n.tolist()):
            i, j = (k // r["wide"]) * r["parts"] + r["bi"], (k % r["wide"]) * r["parts"] + r["bj"]
            assert (i, j) not in out
            out[i, j] = m
    return out


@pytest.mark.parametrize("group", [1, 50, 1 << 20])
def test_pairs_of_numbers_travel_in_few_rows(spark, monkeypatch, group):
    monkeypatch.setattr(wf, "BLOCK", 64)
    monkeypatch.setattr(wf, "LEAST", 3)
    monkeypatch.setattr(wf, "PIECES", 7)  # several parts in a strip
    monkeypatch.setattr(wf, "WORDS", group)
    texts = TEXT + talks(np.random.default_rng(5), texts=60) + ["w0x1 all1"] * 300 + ["é  ü all1 "]
    df = frame(spark, texts)
    vocab = ops.vocabulary(df)
    known = vocab.where("n >= 2")
    blocks = wf.word_pairs(df, window=3, known=known, packed=True)
    assert unpacked(blocks) == numbered(texts, vocab, 2, 3)
    parts = {(r["bi"], r["bj"]) for r in blocks.collect()}
    assert len(parts) == blocks.count() <= blocks.first()["parts"] ** 2  # not a row per pair
    for least in (2, 5):  # blocks may hold words that are too rare
        rows = {(r["i"], r["j"]): (r["n"], r["v"]) for r in wf.affinity(wf.word_pairs(df, window=3), vocab, least).collect()}
        got = {(r["i"], r["j"]): (r["n"], r["v"]) for r in wf.affinity(blocks, vocab, least).collect()}
        half = {(r["i"], r["j"]): (r["n"], r["v"]) for r in wf.affinity(blocks, vocab, least, upper=True).collect()}
        assert got == rows and half == {k: v for k, v in rows.items() if k[0] <= k[1]}
        table = exact(texts, vocab, least, 3)
        assert {k: v for k, (_, v) in got.items()} == pytest.approx({k: table[k] for k in zip(*map(np.ndarray.tolist, np.nonzero(table)))})


def test_words_counted_in_groups(spark, monkeypatch):
    monkeypatch.setattr(ops, "WORDS", 3)
    df = frame(spark, TEXT + ["é  ü a ", " "])
    got = {r["word"]: (r["n"], r["index"]) for r in ops.vocabulary(df).collect()}
    assert got == {"a": (6, 1), "b": (4, 2), "c": (2, 3), "é": (1, 4), "ü": (1, 5)}


def test_products_keep_no_vectors_on_disk(spark, monkeypatch):
    import os

    from tabularium import session

    monkeypatch.setattr(wf, "BLOCK", 64)
    monkeypatch.setattr(wf, "HAND", 10)
    texts = talks(np.random.default_rng(7), texts=200)
    df = frame(spark, texts)
    vocab = ops.vocabulary(df)
    blocks = wf.affinity(wf.word_pairs(df, known=vocab, packed=True), vocab, 2, packed=True)
    before = set(session._made[spark.sparkContext.applicationId])
    values, vectors = wf.factorise(blocks, 40)
    made = set(session._made[spark.sparkContext.applicationId]) - before
    sizes = sorted(sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(p) for f in fs) for p in made)
    assert sum(sizes) < 1.5 * sizes[-1]  # the result, once; a table per pass and product before
    true = np.linalg.eigvalsh(exact(texts, vocab, 2, 7))[::-1][:5]
    assert values[:5] == pytest.approx(true, rel=1e-3) and vectors.count() == vocab.where("n >= 2").count()
    rows, _ = wf.factorise(wf.affinity(wf.word_pairs(df), vocab, 2), 40)
    assert rows == pytest.approx(values)


def test_cells_of_a_part_in_several_tasks(spark, monkeypatch):
    monkeypatch.setattr(wf, "BLOCK", 64)
    rng = np.random.default_rng(1)
    table = np.triu(rng.random((150, 150)) * (rng.random((150, 150)) < 0.2))
    table += table.T
    cells = spark.createDataFrame([(int(i), int(j), float(table[i, j])) for i, j in zip(*np.nonzero(table))], "i long, j long, v double")
    parts, wide = wf._deal(149)
    blocks = wf._blocks_of(cells, "v", parts, wide)
    blocks = blocks.selectExpr("*", "cast(null as binary) s", "cast(null as binary) t", "cast(null as double) total", "cast(null as long) last")
    start = rng.standard_normal((parts * wide, 4))
    monkeypatch.setattr(wf, "HAND", 10)  # several pieces of vectors
    whole = [(p, np.ascontiguousarray(start[p::parts][:wide])) for p in range(parts)]
    sent = [(p, k // 10, b"", x[k : k + 10].tobytes()) for p, x in whole for k in range(0, wide, 10)]
    got = wf.product(blocks.repartition(5), spark.createDataFrame(sent, wf.PARTS), wide, 4, np.eye(4))
    out = np.zeros_like(start)
    for r in got.collect():
        out[r["part"] :: parts][:wide][r["piece"] * 10 :][:10] = np.frombuffer(bytes(r["vec"])).reshape(-1, 4)
    assert out[:150] == pytest.approx(table @ start[:150])
    got.unpersist()
