import hashlib
import json
import random
import re
import time

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tabularium.functions import columns, text as tx
from tabularium.operators import similarity
from tabularium.operators import text as ops
from tabularium.sources import text as io
from tabularium.streaming import scoring


def one(spark, value, f):
    return spark.createDataFrame([(value,)], "v string").select(f("v").alias("o")).first()["o"]


def test_comment_cleaning(spark):
    raw = "Hello @bob the LINK https://x.y/z?a=1 is http:q not-good!!  café"
    assert one(spark, raw, tx.clean_text) == "hello bob link good caf"
    assert one(spark, "@bob\tstays http:x", tx.clean_text) == "stays"
    assert one(spark, "the is", tx.clean_text) == ""


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="aB9 @:/.-é\u00a0htps\n", max_size=30), min_size=20, max_size=40))
def test_comment_cleaning_follows_python_regex_rules(spark, texts):
    pattern = r"@\S+|https?:\S+|http?:\S|[^A-Za-z0-9]+"
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = {r["i"]: r["c"] for r in df.select("i", tx.clean_text("t").alias("c")).collect()}
    for i, t in enumerate(texts):
        words = re.sub(pattern, " ", t.lower()).split()
        assert got[i] == " ".join(w for w in words if w not in tx.STOP_WORDS)


def test_labels_and_lines(spark):
    df = spark.createDataFrame([("1",), ("0",), ("x",), (None,)], "f string")
    assert [r[0] for r in df.select(tx.label_name("f")).collect()] == ["TROLL"] + ["NO_TROLL"] * 3
    df = spark.createDataFrame([(0.49,), (0.5,)], "s double")
    assert [r[0] for r in df.select(tx.label_of_score("s")).collect()] == ["NO_TROLL", "TROLL"]
    df = spark.createDataFrame([("a b", "TROLL")], "t string, l string")
    assert tuple(df.select(tx.training_line("t", "l"), tx.quoted_line("t")).first()) == ("a b, TROLL", '"a b"')


def test_page_text(spark):
    html = (
        "<!DOCTYPE html><html><head><style>p{}</style><script>var t='</p>';</script></head>"
        "<body><!-- note --><p title=\"a>b\">Tom &amp; J&eacute;r&#233;my\n\n &#x1F600; &lt;3 &nope;</p>"
        "<script>unclosed"
    )
    assert one(spark, html, tx.html_text) == "Tom & Jérémy 😀 <3 &nope;"
    assert one(spark, "1 < 2 &amp;lt; x", tx.html_text) == "1 < 2 &lt; x"


def test_tokens(spark):
    assert one(spark, "Hola, que que", tx.tokens) == ["hola,", "que", "que"]
    assert one(spark, "Hola, que que", tx.token_set) == ["hola,", "que"]
    assert one(spark, "Hola, (que) que", lambda c: tx.token_set(c, True)) == ["hola", "que"]


def test_pages_to_content_keeps_the_latest(spark):
    df = spark.createDataFrame([(1, "u", "<p>old</p>"), (2, "u", "<p>new</p>"), (3, "w", "<b>x</b>")], "page_id int, url string, html string")
    assert {tuple(r) for r in io.pages_to_content(df).collect()} == {("u", "new"), ("w", "x")}


def test_latin1_json_lines(spark, tmp_path):
    lines = [{"content": "Señor", "annotation": {"label": ["1", "0"]}}, {"content": "x", "annotation": {"label": []}}]
    (tmp_path / "c.json").write_bytes("\n".join(json.dumps(l, ensure_ascii=False) for l in lines).encode("latin-1"))
    got = io.parse_comments(io.read_text_latin1(spark, str(tmp_path / "c.json"))).collect()
    assert [tuple(r) for r in got] == [("Señor", "1"), ("x", None)]


def test_labelled_parts_drop_empty_texts(spark, tmp_path):
    (tmp_path / "part-0").write_text("good text, TROLL\n, NO_TROLL\n")
    (tmp_path / "part-1").write_text("other, NO_TROLL\n")
    got = io.read_labelled_parts(spark, f"{tmp_path}/part-*").collect()
    assert {tuple(r) for r in got} == {("good text", "TROLL"), ("other", "NO_TROLL")}


def test_csv_and_features(spark, tmp_path):
    df = spark.createDataFrame([(1, "a;b"), (2, None)], "n int, s string")
    io.write_csv(df, f"{tmp_path}/c")
    assert {tuple(r) for r in io.read_csv(spark, f"{tmp_path}/c").collect()} == {(1, "a;b"), (2, None)}
    assert io.read_csv(spark, f"{tmp_path}/c", schema="n long, s string").schema["n"].dataType.typeName() == "long"
    doc = {"features": [{"properties": {"cartodb_id": 1, "name": "A", "avgbedrooms": [{"bedrooms": 1, "total": 2}]}}]}
    (tmp_path / "f.json").write_text(json.dumps(doc, indent=2))
    row = io.read_features(spark, f"{tmp_path}/f.json").first()
    assert row["name"] == "A" and row["avgprice"] is None and row["avgbedrooms"][0]["total"] == 2


@pytest.fixture(scope="module")
def talks(spark):
    return spark.createDataFrame([(1, "b a a"), (2, "c a"), (3, "")], "k int, text string")


def test_vocabulary_and_sequences(spark, talks):
    vocab = ops.vocabulary(talks)
    assert {r["word"]: (r["n"], r["index"]) for r in vocab.collect()} == {"a": (3, 1), "b": (1, 2), "c": (1, 3)}
    got = {r["k"]: r["sequence"] for r in ops.padded_sequences(talks, vocab, "k", length=4).collect()}
    assert got == {1: [0, 2, 1, 1], 2: [0, 0, 3, 1], 3: [0, 0, 0, 0]}
    cut = {r["k"]: r["sequence"] for r in ops.padded_sequences(talks, vocab, "k", length=2).collect()}
    assert cut[1] == [1, 1]
    known = vocab.filter("word != 'b'")
    skipped = {r["k"]: r["sequence"] for r in ops.padded_sequences(talks, known, "k", length=3).collect()}
    assert skipped[1] == [0, 1, 1]


def test_word_lookup_does_not_depend_on_the_broadcast_part(spark, talks):
    vocab, words = ops.vocabulary(talks), ops.words_of(talks)
    for frequent in (0, 1, 10):
        got = {(r["k"], r["pos"], r["index"]) for r in ops.lookup_words(words, vocab, frequent).collect()}
        assert got == {(1, 0, 2), (1, 1, 1), (1, 2, 1), (2, 0, 3), (2, 1, 1)}


def test_label_index_is_alphabetical(spark):
    df = spark.createDataFrame([("TROLL",), ("NO_TROLL",), ("NO_TROLL",)], "l string")
    assert {r["l"]: r["label_index"] for r in ops.label_index(df, "l").collect()} == {"NO_TROLL": 0, "TROLL": 1}


def test_embeddings_align_with_the_vocabulary(spark, talks):
    vocab = ops.vocabulary(talks)
    counts = ops.context_counts(talks, vocab, size=4, min_count=2)
    table = {r["word"]: r["vector"] for r in ops.embedding_table(vocab, counts, 4).collect()}
    assert any(table["a"]) and table["b"] == [0.0] * 4


def test_context_counts_by_hand(spark):
    text = "p q r s p q p"
    df = spark.createDataFrame([(1, text), (2, " ".join("p q".split() * 9))], "k int, text string")
    got = {
        (r["word"], r["dim"]): r["value"]
        for r in ops.context_counts(df, ops.vocabulary(df), size=5, window=2, min_count=1).collect()
    }
    want = {}
    for line in (text, "p q " * 9):
        words = line.split()
        for i, w in enumerate(words):
            for j in range(max(i - 2, 0), min(i + 3, len(words))):
                if i != j:
                    digest = hashlib.md5(words[j].encode()).hexdigest()
                    key = w, int(digest[:8], 16) % 5 + 1
                    want[key] = want.get(key, 0) + (-1 if int(digest[8], 16) % 2 else 1)
    assert got == want


def test_feature_lines(spark, tmp_path):
    df = spark.createDataFrame([(1, "A", None, [(2, 3)])], "cartodb_id long, name string, avgprice double, avgbedrooms array<struct<bedrooms:int,total:bigint>>")
    io.write_feature_lines(df, f"{tmp_path}/lines")
    row = io.read_feature_lines(spark, f"{tmp_path}/lines").first()
    assert row["name"] == "A" and row["avgprice"] is None and row["avgbedrooms"][0]["total"] == 3


@pytest.fixture(scope="module")
def model(spark):
    rows = [("bad ugly nasty" if i % 2 else "nice kind good", "TROLL" if i % 2 else "NO_TROLL") for i in range(40)]
    return ops.fit_classifier(spark.createDataFrame(rows, "text string, label string"), features=256)


def test_classifier_scores_and_falls_back(spark, model, tmp_path):
    df = spark.createDataFrame([(1, "nasty ugly"), (2, "kind"), (3, "")], "k int, text string")
    got = {r["k"]: (r["label"], r["score"]) for r in ops.score(model, df).collect()}
    assert got[1][0] == "TROLL" and got[2][0] == "NO_TROLL" and got[3] == ("undefined", 0.0)
    hold = spark.createDataFrame([("ugly", "TROLL"), ("good", "NO_TROLL")], "text string, label string")
    assert {r["metric"]: r["value"] for r in ops.evaluate_classifier(model, hold).collect()}["accuracy"] == 1.0
    model.write().overwrite().save(f"{tmp_path}/m")
    lines = [json.loads(r["value"]) for r in ops.prediction_json(ops.score(model, df)).collect()]
    assert set(lines[0]) == {"text", "label", "score"}


def test_stream_scoring_equals_batch(spark, model, tmp_path):
    rows = [(1704067200 + 20 * i, t) for i, t in enumerate(["Nasty @x ugly", "kind!", "???"])]
    df = spark.createDataFrame(rows, "s long, t string").select(
        F.timestamp_seconds("s").alias("timestamp"), F.encode("t", "UTF-8").alias("value")
    )
    df.write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(df.schema).parquet(f"{tmp_path}/in")
    query = (
        scoring.to_topic(scoring.score_messages(stream, model))
        .writeStream.format("parquet")
        .option("path", f"{tmp_path}/out")
        .option("checkpointLocation", f"{tmp_path}/cp")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    got = sorted(bytes(r["value"]).decode() for r in spark.read.parquet(f"{tmp_path}/out").collect())
    want = sorted(bytes(r["value"]).decode() for r in scoring.to_topic(scoring.score_messages(df, model)).collect())
    assert got == want and json.loads(want[0])["label"] == "undefined"
    assert {json.loads(w)["window_start"][14:19] for w in want} == {"00:00", "00:15", "00:30"}


def test_keyed_dot_example(spark):
    cost = spark.createDataFrame([("lupulo", 2.5), ("malta", 1.5), ("agua", 0.006), ("levadura", 0.45), ("extra", 9.0)], "item string, cost double")
    amount = spark.createDataFrame([("lupulo", "6u"), ("malta", "14u"), ("agua", "7u"), ("levadura", "11u")], "item string, q string")
    amount = amount.withColumn("q", columns.unit_number("q"))
    got = similarity.keyed_dot(amount, cost, "item", "q", "cost").first()["dot"]
    assert abs(got - 40.9920) < 1e-9


def test_cosine_examples(spark):
    df = spark.createDataFrame([([1.0, 2.0, 3.0], [3.0, 2.0, 1.0])], "u array<double>, v array<double>")
    assert abs(df.select(columns.cosine("u", "v")).first()[0] - 0.71428) < 1e-5
    pair = spark.createDataFrame([(["que", "hola"], ["que", "es", "guay"])], "a array<string>, b array<string>")
    row = similarity.set_pair_vectors(pair, "a", "b").first()
    assert set(row["union"]) == {"es", "que", "hola", "guay"} and sum(row["vector_a"]) == 2
    assert row["cosine"] == round(1 / 6 ** 0.5, 3)


def test_cosine_pairs_shuffle_few_candidates(spark, monkeypatch):
    """Sets with many common words, few of them alike: pairs that cannot reach the bound are left out where they meet."""
    rng = random.Random(5)
    words = [f"w{i}" for i in range(300)]
    bags = [rng.sample(words, 60) for _ in range(400)]
    bags += [bag[:-4] + [f"x{i}"] for i, bag in enumerate(bags[:20])]
    sets = similarity.distinct_sets(spark.createDataFrame(list(enumerate(bags)), "id int, tokens array<string>"), "id", "tokens")
    seen = []
    frame, distinct = type(sets), type(sets).distinct
    monkeypatch.setattr(frame, "distinct", lambda df: seen.append(distinct(df)) or seen[-1])
    pairs = similarity.cosine_pairs(sets, 0.8).collect()
    assert sorted((r["set_a"], r["set_b"]) for r in pairs) == [(i, 400 + i) for i in range(20)]
    assert seen and seen[-1].count() < 100  # of 88,000 pairs, most with a token in both prefixes


def test_cosine_pairs_of_repeated_sets(spark):
    """A set in two rows gives its pairs twice."""
    rows = [(1, list("abcde"), 5, 1), (2, list("abcdf"), 5, 2), (2, list("abcdf"), 5, 2), (3, list("xyz"), 3, 1)]
    sets = spark.createDataFrame(rows, "set_id long, tokens array<string>, size int, copies long").repartition(3)
    got = similarity.cosine_pairs(sets, 0.7).select("set_a", "set_b", "shared", "united").collect()
    assert [tuple(r) for r in got] == [(1, 2, 4, 6)] * 2


def test_set_vectors_look_each_token_up_once(spark):
    """Repeats, nulls and empty sets as by ``indicator``; long sets in linear time."""
    sets = [["b", "a", "b"], ["a", "c", None], [None], [], None, ["c", "b", "c", "d"]]
    df = spark.createDataFrame([(a, b) for a in sets for b in sets], "a array<string>, b array<string>")
    union = F.array_union("a", "b")
    want = df.withColumn("union", union).withColumns({v: columns.indicator("union", s) for v, s in (("vector_a", "a"), ("vector_b", "b"))})
    want = want.withColumn("cosine", F.round(columns.cosine("vector_a", "vector_b"), 3))
    key = lambda r: str(r)
    got = similarity.set_pair_vectors(df, "a", "b")
    assert got.columns == want.columns
    assert sorted(got.collect(), key=key) == sorted(want.collect(), key=key)
    words = F.transform(F.sequence(F.lit(1), F.lit(60_000)), lambda i: F.concat(F.lit("w"), i.cast("string")))
    long = spark.range(1).select(words.alias("a"), F.reverse(words).alias("b"))
    start = time.monotonic()
    assert similarity.set_pair_vectors(long, "a", "b").select("cosine").first()[0] == 1.0
    assert time.monotonic() - start < 20  # 7.2 billion comparisons before


TOKENS = st.lists(st.sampled_from(list("abcdefgh")), min_size=1, max_size=6)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(TOKENS, min_size=2, max_size=14), st.sampled_from([0.3, 0.5, 0.8, 1.0]), st.sampled_from([0, 3, 100]))
def test_cosine_pairs_equal_brute_force(spark, bags, bound, frequent):
    df = spark.createDataFrame(list(enumerate(bags)), "id int, tokens array<string>")
    sets = similarity.distinct_sets(df, "id", "tokens")
    got = {(r["set_a"], r["set_b"], r["copies_a"], r["copies_b"], round(r["cosine"], 9)) for r in similarity.cosine_pairs(sets, bound, frequent).collect()}
    first, copies = {}, {}
    for i, bag in enumerate(bags):
        key = frozenset(bag)
        first.setdefault(key, i)
        copies[key] = copies.get(key, 0) + 1
    want = set()
    for a in first:
        for b in first:
            cosine = len(a & b) / (len(a) * len(b)) ** 0.5
            if first[a] < first[b] and cosine >= bound:
                want.add((first[a], first[b], copies[a], copies[b], round(cosine, 9)))
    assert got == want
    members = {r["id"]: r["set_id"] for r in similarity.set_members(df, "id", "tokens").collect()}
    assert members == {i: first[frozenset(bag)] for i, bag in enumerate(bags)}
