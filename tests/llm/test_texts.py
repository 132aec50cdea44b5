"""Fingerprints, licenses, near duplicates, decontamination, mixing and token counts against brute force."""

import hashlib
import math
import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F
from tabularium.llm import decontam, editprint, licenses, mixing, setsketch, unigram

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SYLLABLES = "an be ci do er fi go hu in ja ke lo mi nu or pa qui ro su ti ul va we xi yo zu".split()


def words(rng, n):
    return ["".join(rng.choices(SYLLABLES, k=rng.randint(1, 3))) for _ in range(n)]


def changed(rng, ws, share):
    return [rng.choice(SYLLABLES) + "x" if rng.random() < share else w for w in ws]


def test_fingerprints_by_brute_force(spark):
    rng = random.Random(5)
    texts = [" ".join(words(rng, rng.randint(0, 400))) for _ in range(150)] + ["", "é" * 50]
    texts += [texts[3], texts[4]]
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r["doc_id"]: r for r in editprint.fingerprint(docs).collect()}
    assert sorted(got) == list(range(len(texts)))
    walk = editprint.Walk()
    for i, text in rows:
        following = texts[i - 1] if i else texts[-1]
        changed_text = editprint.edited(text, following)
        k = len(text) // 3
        assert changed_text == text[: len(text) - k] + following[:k]
        r = got[i]
        assert r["n_chars"] == len(text)
        assert r["edited_sha256"] == hashlib.sha256(changed_text.encode()).hexdigest()
        assert r["fingerprint"] == editprint.Prints(walk, [text]).strings()[0]
        assert r["edited_fingerprint"] == editprint.Prints(walk, [changed_text]).strings()[0]
        near = editprint.likeness_of_strings([r["fingerprint"]], [r["edited_fingerprint"]])[0]
        assert math.isclose(near, r["near_edited"])
    long = [r for i, r in got.items() if len(texts[i]) > 200 and i < 150]
    assert np.mean([r["near_edited"] for r in long]) > 0.5 > 0.3 > np.mean([r["near_next"] for r in long])
    assert got[152]["fingerprint"] == got[3]["fingerprint"]


def test_walks_agree_alone_and_in_a_crowd():
    rng, walk = random.Random(2), editprint.Walk()
    texts = [" ".join(words(rng, rng.randint(1, 60))) for _ in range(80)]
    together = editprint.Prints(walk, texts)
    for i in range(0, 80, 9):
        text, j, places = texts[i], 0, []
        symbol, _, _ = editprint._codes([text])
        for c in symbol.tolist():
            places.append(j)
            j += walk.rows[j % editprint.PERIOD][c]
        own = together.place[together.start[i] : together.start[i] + together.length[i]]
        assert own.tolist() == places and together.end[i] == j


def test_fingerprint_search_recall(spark):
    rng = random.Random(9)
    bases = [" ".join(words(rng, 200)) for _ in range(60)]
    near = [b[:300] + "zz" + b[302:600] + "q" + b[600:] for b in bases]
    walk = editprint.Walk()
    prints = editprint.Prints(walk, bases + near).strings()
    frame = spark.createDataFrame([(p,) for p in prints], "fingerprint string")
    asked = frame.limit(60)
    found = {(r["fingerprint"], r["found"]) for r in editprint.search(frame, asked, 0.8).collect()}
    every = [(a, b) for a in prints[:60] for b in prints]
    likeness = editprint.likeness_of_strings(*map(list, zip(*every)))
    wanted = {p for p, x in zip(every, likeness) if x >= 0.8}
    assert len(wanted & found) >= 0.9 * len(wanted) and found <= wanted


def test_alignment_is_a_common_subsequence():
    rng = random.Random(1)
    for _ in range(200):
        a, b = (rng.choices("abcdefghij", k=rng.randint(0, 14)) for _ in range(2))
        pairs = licenses.align(a, b)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(i < k and j < m for (i, j), (k, m) in zip(pairs, pairs[1:]))
    assert len(licenses.align(list("xabcy"), list("abc"))) == 3


def test_increasing_runs_are_longest():
    rng = random.Random(4)
    for _ in range(100):
        seconds = rng.sample(range(9), 7)
        got = licenses.increasing(list(enumerate(seconds)))
        best = 0
        for mask in range(1 << 7):
            run = [s for i, s in enumerate(seconds) if mask >> i & 1]
            best = max(best, len(run)) if run == sorted(run) else best
        assert len(got) == best and [s for _, s in got] == sorted(s for _, s in got)


def test_planted_licenses(spark):
    rng = random.Random(8)
    rows, want = [], set()
    for i, (name, text, *_) in enumerate(licenses.TEMPLATES):
        body = words(rng, 40)
        rows.append((i, " ".join(body[:20] + [text] + body[20:])))
        want.add((i, name))
    full = licenses.words_of(licenses.TEMPLATES[2][1])
    rows.append((50, " ".join(changed(random.Random(3), full, 0.08))))
    want.add((50, "MIT"))
    rows += [(60, "licensed under the rules of this house"), (61, "license " * 500), (62, "Licensed under the BSD License.")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = licenses.scan(docs).collect()
    assert {(r["doc_id"], r["license"]) for r in got} == want
    twice = licenses.scan_text("Released under the MIT License. x y Released under the MIT License.", licenses.templates())
    assert [f[3] for f in twice] == [0, 7]


def brute_components(texts, n):
    sets = {}
    for i, t in texts.items():
        ws = t.lower().split()
        sets[i] = {tuple(ws[k : k + n]) for k in range(max(len(ws) - n + 1, 1))} if ws else set()
    label = {i: i for i in sets}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    ids = sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[x + 1 :]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= 80 * (len(sets[a]) + len(sets[b]) - common):
                ra, rb = root(a), root(b)
                label[max(ra, rb)] = min(ra, rb)
    return {i: root(i) for i in ids}, {i: len(s) for i, s in sets.items()}


@pytest.mark.parametrize("n", [4, 5])
def test_near_duplicates_by_brute_force(spark, n):
    rng = random.Random(n)
    texts, at = {}, 0
    for family in range(12):  # chains, loose families, and one large family of near and exact copies
        base = words(rng, rng.randint(3, 120))
        for k in range(150 if family == 0 else rng.randint(1, 12)):
            base_now = changed(rng, base, rng.choice([0.0, 0.01, 0.03, 0.06]))
            base = base_now if family % 3 == 1 else base
            texts[at] = " ".join(base_now)
            at += 1
    texts[at] = ""
    component, size = brute_components(texts, n)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: r for r in setsketch.near_duplicates(docs, n).collect()}
    assert {i: r["component_id"] for i, r in got.items()} == component
    assert {i: r["n_shingles"] for i, r in got.items()} == size
    assert all(r["kept"] == (component[i] == i) for i, r in got.items())
    kept = {r["doc_id"] for r in setsketch.deduplicate(docs, n).collect()}
    assert kept == set(component.values())


def test_sketches_merge_and_estimate():
    rng = np.random.default_rng(6)
    pool = rng.integers(0, 1 << 63, 6000, dtype=np.uint64)
    for common in (500, 1500, 1900):
        a, b = pool[:2000], np.concatenate([pool[2000 - common : 2000], pool[2000 : 4000 - common]])
        both = np.concatenate([a, b])
        sketch = setsketch.registers(both, np.array([0, 2000, 4000]))
        union = setsketch.registers(np.unique(both), np.array([0, len(np.unique(both))]))
        assert (setsketch.merge(sketch[0], sketch[1]) == union[0]).all()
        estimate = setsketch.likelihood_jaccard(sketch[:1], sketch[1:], np.array([2000.0]), np.array([2000.0]))[0]
        assert abs(estimate - common / (4000 - common)) < 0.15


def test_components_of_long_chains(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 130), (130, 110)]
    got = setsketch.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {(r["node"], r["label"]) for r in got} == {(i, 0) for i in range(1, 61)} | {(130, 100), (110, 100)}


def brute_hits(doc, items):
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    ws, hit, found = pattern.findall(doc.translate(LOWER)), set(), set()
    for item_id, text in items:
        it = pattern.findall(text.translate(LOWER))
        k = min(len(it), 13)
        wins = {tuple(it[i : i + k]) for i in range(len(it) - k + 1)} if it else set()
        for i in range(len(ws) - k + 1 if k else 0):
            if tuple(ws[i : i + k]) in wins:
                hit |= set(range(i, i + k))
                found.add(item_id)
    return len(ws), len(hit), sorted(map(str, found))


@pytest.mark.parametrize("threshold", ["10m", "-1"])
def test_decontamination_by_brute_force(spark, threshold):
    """With hashes broadcast, and with every join shuffled."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, threshold)
    try:
        decontamination_by_brute_force(spark)
    finally:
        spark.conf.set(name, before)


def test_decontamination_is_linear_in_the_text(spark):
    """Four times the words take less than six times as long."""
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi"
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    took = {}
    for n in (1000, 40_000, 160_000):  # the first one warms up
        text = " ".join(f"w{i % 9973}" for i in range(n))
        docs = spark.createDataFrame([(1, f"{text} {item}")], "doc_id long, text string")
        start = time.perf_counter()
        row = decontam.measured(decontam.hits(docs, items)).first()
        took[n] = time.perf_counter() - start
        assert (row["n_words"], row["n_hit"]) == (n + 14, 14)
    assert took[160_000] < 6 * took[40_000]


def decontamination_by_brute_force(spark):
    rng = random.Random(7)
    items = [(i, " ".join(rng.choices(SYLLABLES[:4 + i], k=k))) for i, k in enumerate([1, 2, 3, 5, 7, 8, 9, 12, 13, 14, 20, 40])]
    items += [(50, items[-1][1]), (51, "Únïcode Wörds, 123")]
    docs = []
    for i in range(80):
        ws = words(rng, rng.randint(0, 80))
        if i % 2:
            it = rng.choice(items)[1].upper().split()
            ws[len(ws) // 2 : len(ws) // 2] = it[rng.randint(0, 2) :]
        docs.append((i, rng.choice([" ", ", ", "\n"]).join(ws)))
    docs += [(100, "únïcode wörds 123"), (101, " ".join(items[-3][1].split() * 6))]
    frames = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = {r["doc_id"]: r for r in decontam.measured(decontam.hits(*frames)).collect()}
    for i, text in docs:
        n, k, found = brute_hits(text, items)
        r = got[i]
        assert (r["n_words"], r["n_hit"], sorted(map(str, r["items"]))) == (n, k, found), i
        assert r["contaminated"] == (k > 0 and 20 * k >= n)
    bad = {i for i, r in got.items() if r["contaminated"]}
    left = decontam.remove_documents(*frames)
    assert {r["doc_id"] for r in left.collect()} == {i for i, _ in docs} - bad
    cut = {r["doc_id"]: r["text"] for r in decontam.remove_spans(*frames).collect()}
    assert len(cut) == len(docs)
    for i in bad:
        assert len(cut[i].split()) == got[i]["n_words"] - got[i]["n_hit"]
    assert all(cut[i] == t for i, t in docs if i not in bad)


def poisson(u, rate):
    k, p = 0, math.exp(-rate)
    cdf = p
    while cdf <= u and k < 64:
        k += 1
        p *= rate / k
        cdf += p
    return k


def test_mixing_by_brute_force(spark):
    rows = [(i, f"text {i}", "big" if i % 3 else ("small" if i % 2 else None)) for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    targets = spark.createDataFrame([("big", 1.0), ("small", 30.0), (None, 0.0)], "source string, weight double")
    got = {}
    for r in mixing.mix(docs, targets, "seed").collect():
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + 1
    rate = {"big": 1 / 31 * 900 / 600, "small": 30 / 31 * 900 / 150, None: 0.0}
    for i, text, source in rows:
        key = hashlib.md5(f"seed|{i}|{text}".encode()).hexdigest()
        parts = max(math.ceil(rate[source] / mixing.PART_RATE), 1)
        us = [int(hashlib.md5(f"{key}|{j}".encode()).hexdigest()[:13], 16) / 2**52 for j in range(1, parts + 1)]
        assert got.get(i, 0) == sum(poisson(u, rate[source] / parts) for u in us)
    assert abs(sum(got.get(i, 0) for i, _, s in rows if s == "small") / sum(got.values()) - 30 / 31) < 0.02


def test_large_rates_and_the_global_order(spark):
    docs = spark.range(40).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"), F.lit("s").alias("source"))
    counts = mixing.copies("x", F.lit(40), mixing.distribution(F.lit(7.5)))
    rate = docs.select(counts.alias("n")).agg(F.avg("n")).head()[0]
    assert 285 < rate < 315
    marked = mixing.mix(docs.withColumn("copy", F.lit("clash")), marks=True).collect()
    keys = [r["shuffle_key"] for r in marked]
    assert keys == sorted(keys)


def test_token_counts_match_the_tokenizer():
    from tokenizers import Tokenizer, models

    vocabulary = unigram.read_vocabulary()
    rng = random.Random(11)
    texts = words(rng, 3000) + ["日本語", "naïve", "€uro", "a😀b😀😀", "x" * 400, "éàü", "2024", "don't"]
    for bytes_too in (False, True):
        known = unigram.Vocabulary(vocabulary.pieces, bytes_too)
        entries = [("<unk>", 0.0), *known.pieces.items()]
        if bytes_too:
            entries += [(f"<0x{b:02X}>", -99.0) for b in range(256)]
        tokenizer = Tokenizer(models.Unigram(entries, 0, bytes_too))
        counter = unigram.Counter(known)
        if bytes_too:
            counter.unknown = -99.0 - unigram.UNKNOWN_PENALTY
        for w in texts:
            assert counter.word(unigram.MARK + w)[0] == len(tokenizer.model.tokenize(unigram.MARK + w)), w


def test_token_ties_and_memory():
    counter = unigram.Counter(unigram.Vocabulary({"a": -1.0, "b": -1.0, "ab": -2.0, unigram.MARK: 0.0}, False))
    assert counter.word(unigram.MARK + "ab") == (2, -2.0)  # the longer last piece wins a tie
    assert counter.text(" ab\tab \n") == (2, 4, -4.0) and len(counter.known) == 1
    assert unigram.Counter(unigram.Vocabulary({}, False)).word("abc")[0] == 1
