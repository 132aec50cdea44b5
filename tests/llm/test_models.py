"""Language ID, language model and quality trees: brute-force values and held-out accuracy."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from tabularium.llm import langid, maxent, quality
from pyspark.sql import functions as F
from tabularium.llm.common import Words, smallest_hashes, space_words, text_blocks
from tabularium.llm.queries import QUERIES

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
MEDIUM = "/root/testdata/sf0.01"


def held(doc_id, n):
    return zlib.crc32(str(doc_id).encode()) % n


def test_words_match_a_regular_expression():
    texts = ["A b\tC\x0bd", "", None, "x", " lead Trail ", "é Ü z", "\n\n", "a b"]
    words = Words(space_words)
    for limit in (1, 8, 1000):
        seen, got = {}, []
        for _, _, data, offsets in text_blocks(pa.array(texts), limit):
            start, end, row = words.spans(data, offsets)
            h = words.hashes(data, start, end)
            for r in range(len(offsets) - 1):
                got.append(h[row == r].tolist())
        want = [WORDS.findall((t or "").translate(LOWER)) for t in texts]
        assert [len(g) for g in got] == [len(w) for w in want]
        for g, w in zip(got, want):
            for a, b in zip(g, w):
                assert seen.setdefault(b, a) == a
        assert len(set(seen.values())) == len(seen)


def test_language_id_on_held_out_documents(spark):
    docs = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{MEDIUM}/documents.parquet").collect()}
    rows = QUERIES["op2_language_id"](spark, MEDIUM).collect()
    assert len(rows) == len(docs)
    assert all(r["held_out"] == (held(r["doc_id"], 3) == 1) for r in rows)
    out = [r for r in rows if r["held_out"]]
    assert np.mean([r["lang_pred"] == docs[r["doc_id"]] for r in out]) > 0.97


def test_long_texts_are_cut_without_loss():
    model = langid.LangModel(["a", "b"], np.random.default_rng(0).normal(size=(2, langid.BUCKETS + 1)), np.zeros(2))
    model.log_prob[:, -1] = 0
    piece = langid.PIECE
    for size in (piece - 1, piece, piece + 1, piece + 2, 2 * piece, 2 * piece + 1, 5 * piece // 2):
        text = "".join(chr(97 + (i * i + i // 7) % 26) for i in range(size))
        for order in langid.ORDERS:
            whole = np.bincount(langid._grams([text], order, langid.BUCKETS, size)[0], minlength=langid.BUCKETS + 1)
            cut = np.zeros_like(whole)
            for _, parts in langid._pieces([text], piece):
                cut += np.bincount(langid._grams(parts, order, langid.BUCKETS)[0], minlength=langid.BUCKETS + 1)
            assert (whole[:-1] == cut[:-1]).all() and whole[:-1].sum() == size - order + 1
    names, scores = langid.score_texts([text, text[:100]], model)
    sums = [sum(row[langid._grams([text], o, langid.BUCKETS, size)[0]].sum() for o in langid.ORDERS) for row in model.log_prob]
    assert names[0] == model.labels[int(np.argmax(sums))]
    n_grams = sum(size - o + 1 for o in langid.ORDERS)
    assert scores[0] == pytest.approx(1 / (1 + np.exp(-abs(sums[0] - sums[1]) * langid.EVIDENCE / n_grams)))


def test_language_model_counts_by_brute_force(spark):
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet").select("doc_id", "text").collect()
    tokens = {r["doc_id"]: [*WORDS.findall((r["text"] or "").translate(LOWER)), None] for r in docs}
    counts = Counter(w for i, ws in tokens.items() if held(i, 7) != 2 for w in ws)
    total = sum(counts.values())
    base = math.log10(total + len(counts) + 1)
    rows = QUERIES["op3_lm_scores"](spark, MEDIUM).collect()
    for r in rows:
        ws = tokens[r["doc_id"]]
        assert r["held_out"] == (held(r["doc_id"], 7) == 2)
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(ws), sum(w in counts for w in ws), total)
        assert math.isclose(r["base_score"], sum(math.log10(counts[w] + 1) - base for w in ws), rel_tol=1e-9)
    for part in (True, False):
        assert sum(r["score"] - r["base_score"] for r in rows if r["held_out"] == part) > 0


def test_language_model_is_trained_until_rounds_gain_little(spark):
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet").select("doc_id", "text")

    def reached(rounds):
        model, counts = maxent.fit(docs, rounds) if rounds else maxent.fit(docs)
        total = maxent.score(docs, model, counts).agg({"score": "sum"}).first()[0]
        observed, _ = maxent._sums(docs.select("text"), model, expected=False)
        (*want, _), log10 = maxent._sums(docs.select("text"), model, expected=True)
        weights = maxent._moved((model.class_weight, model.slot_weight), observed, want, maxent.STEP)
        model.class_weight, model.slot_weight = weights
        return total / model.total, (maxent._sums(docs.select("text"), model, expected=True)[1] - log10) / model.total

    few, left_by_few = reached(2)
    score, left = reached(None)
    assert score - few > maxent.TOLERANCE
    assert left < maxent.TOLERANCE < left_by_few


def test_language_model_is_a_distribution():
    rng = np.random.default_rng(1)
    top = rng.integers(0, 1 << 63, 20, dtype=np.uint64)
    model = maxent.LanguageModel(
        100, 30, np.sort(top), np.ones(20), top, np.zeros(256), rng.normal(size=(16, 17)).astype(np.float32),
        rng.normal(size=(1 << 13, 16)).astype(np.float32), rng.normal(size=(1 << 14, 16)).astype(np.float32),
    )
    model.bias -= 0.5
    history = rng.integers(0, 1 << 63, 3, dtype=np.uint64)
    outcomes = {}
    while len(outcomes) < 20 + maxent.TAIL:  # a token of every outcome
        for h in [*top, *rng.integers(0, 1 << 64, 4000, dtype=np.uint64)]:
            outcomes.setdefault(int(model.outcome(np.array([h]))[0]), h)
    total = 0.0
    for h in outcomes.values():
        text = np.array([*history, h], dtype=np.uint64)
        with_h = maxent._context(model, text, np.array([0, 4]))[0]
        without = maxent._context(model, history, np.array([0, 3]))[0]
        total += 10 ** (with_h - without)
    # the outcomes of missing frequent tokens hold the rest
    assert 0.3 < total <= 1 + 1e-6


def test_flat_trees_match_a_walk_one_by_one():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(3000, 5))
    y = ((x[:, 0] > 0.3) ^ (x[:, 2] * x[:, 3] > 0)).astype(float)
    trees = quality.boost(x, y, trees=25)
    score = trees.score(x)
    for i in range(0, 3000, 211):
        total = trees.base
        for t in range(25):
            at = 0
            for _ in range(trees.depth):
                side = trees.left if x[i, trees.feature[t, at]] <= trees.threshold[t, at] else trees.right
                at = side[t, at]
            total += trees.value[t, at]
        assert math.isclose(score[i], 1 / (1 + math.exp(-total)), rel_tol=1e-9)
    assert np.mean((score > 0.5) == y) > 0.9


def test_quality_on_held_out_documents(spark):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{MEDIUM}/labels.parquet").collect()}
    rows = QUERIES["op7_quality"](spark, MEDIUM).collect()
    out = [r for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert all(r["held_out"] == (held(r["doc_id"], 5) == 0) for r in rows)
    assert np.mean([r["predicted"] == labels[r["doc_id"]] for r in out]) > 0.95


def test_statistics_by_brute_force():
    texts = ["One two, two\nONE!! a|b", "", "same same same\nsame same same\nother é"]
    got = dict(zip(quality.FEATURES, quality.Statistics()(pa.array(texts)).T))
    for i, t in enumerate(texts):
        words = WORDS.findall(t.translate(LOWER))
        raw = t.encode()
        assert math.isclose(got["log_bytes"][i], math.log1p(len(raw)))
        assert math.isclose(got["distinct_words"][i], len(set(words)) / max(len(words), 1))
        assert math.isclose(got["equal_neighbours"][i], sum(a == b for a, b in zip(words, words[1:])) / max(len(words), 1))
        assert math.isclose(got["bars"][i], t.count("|") / max(len(raw), 1))
        lines = [x for x in t.split("\n") if x]
        assert math.isclose(got["repeated_lines"][i], 1 - len(set(lines)) / max(len(lines), 1) if lines else 1.0)


def test_prediction_is_plain_naive_bayes():
    """The prior weighs against all n-grams of a long text: evidence that is tempered alone would lose to it."""
    rng = np.random.default_rng(4)
    log_prob = np.log(rng.dirichlet(np.ones(64), 2))
    log_prob[1] = log_prob[0] + 0.05  # each n-gram is a little likelier in the rare language
    model = langid.LangModel(["common", "rare"], np.concatenate([log_prob, np.zeros((2, 1))], axis=1), np.log([0.99, 0.01]))
    texts = ["a", "ab" * 5, "abc de " * 300, "x" * 2000]
    names, scores = langid.score_texts(texts, model)
    for text, name in zip(texts, names):
        n_grams = sum(max(len(text) - order + 1, 0) for order in langid.ORDERS)
        assert name == ("rare" if np.log(0.01) + 0.05 * n_grams > np.log(0.99) else "common")
    assert ((scores >= 0.5) & (scores < 1)).all()


def test_most_frequent_tokens_by_brute_force(spark):
    rng = np.random.default_rng(3)
    rows = [(int(h), int(c)) for h, c in zip(rng.integers(-(2**63), 2**63, 3000), rng.zipf(1.6, 3000).clip(max=10**9))]
    counts = spark.createDataFrame(rows, "h long, c long").repartition(7)
    for k in (1, 10, 500, 2999, 3000, 5000):
        h, c = maxent.most_frequent(counts, k)
        want = sorted(rows, key=lambda r: (-r[1], r[0]))[:k]
        assert list(zip(h.view(np.int64).tolist(), c.tolist())) == want
    assert len(maxent.most_frequent(counts.limit(0), 5)[0]) == 0


def test_quality_sample_is_the_smallest_hashes(spark, monkeypatch):
    docs = spark.range(500).select(F.col("id").alias("doc_id"), F.concat(F.lit("word "), F.col("id").cast("string")).alias("text"))
    labels = spark.range(0, 500, 2).select(F.col("id").alias("doc_id"), (F.col("id") % 3).cast("int").alias("quality"))
    seen = {}
    monkeypatch.setattr(quality, "boost", lambda x, y: seen.update(n=len(y), y=sorted(y)))
    quality.fit(docs, labels, sample=40)
    order = labels.select(F.xxhash64("doc_id").alias("h"), "quality").orderBy("h").limit(40).collect()
    assert seen["n"] == 40 and seen["y"] == sorted(float(r["quality"]) for r in order)
    quality.fit(docs.unionByName(docs), labels.unionByName(labels), sample=10_000)
    assert seen["n"] == 250
    plan = spark.range(3).select("id")  # the helper keeps whole ranges
    assert smallest_hashes(plan.withColumn("h", F.xxhash64("id")), "h", 2).count() >= 2



def test_too_many_languages_are_an_error(spark):
    docs = spark.range(langid.MOST_LABELS + 1).select(F.lit("some text").alias("text"), F.col("id").cast("string").alias("lang"))
    with pytest.raises(ValueError, match="more than"):
        langid.fit(docs)
