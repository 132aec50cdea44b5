"""Published models: versions, loading in batch and stream, and the closed-form word weights."""

import hashlib
import math
import os
from collections import Counter

import pytest
from pyspark.sql import functions as F
from tabularium.operators import log_odds, model_store
from tabularium.operators import text as ops
from tabularium.streaming import scoring

ROWS = [("bad ugly bad", "TROLL"), ("nice day", "NO_TROLL"), ("ugly words", "TROLL"), ("kind nice words", "NO_TROLL")]
TEXTS = ["bad day", "nice kind", "", "unseen", "ugly ugly nice", "bad day", None]


@pytest.fixture(scope="module")
def train(spark):
    return spark.createDataFrame(ROWS, "text string, label string")


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "id long, text string").repartition(3)


def test_versions_count_when_they_are_complete(spark, tmp_path):
    root = f"{tmp_path}/store"
    assert model_store.versions(spark, root) == []
    with pytest.raises(FileNotFoundError):
        model_store.version_folder(spark, root)
    for n in (1, 2):
        assert model_store.publish_table(spark.range(n), root) == n

    def dies(folder):
        spark.range(9).write.parquet(f"{folder}/table")
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        model_store.publish(spark, root, dies)
    assert model_store.versions(spark, root) == [1, 2]
    assert model_store.load_table(spark, root).count() == 2
    assert model_store.load_table(spark, root, 1).count() == 1
    with pytest.raises(FileNotFoundError):
        model_store.load_table(spark, root, 3)
    assert model_store.publish_table(spark.range(5), root) == 4  # the number of the lost one is not used again
    assert model_store.load_table(spark, root).count() == 5


def test_loaded_pipeline_scores_like_the_fitted_one(spark, train, texts, tmp_path):
    model = ops.fit_classifier(train, features=256)
    model_store.publish_pipeline(model, spark, f"{tmp_path}/store")
    loaded = model_store.load_pipeline(spark, f"{tmp_path}/store")
    filled = texts.fillna("")
    mine, theirs = (sorted(map(tuple, ops.score(m, filled).collect())) for m in (model, loaded))
    assert mine == theirs and len(mine) == len(TEXTS)


def test_word_weights_against_counts(spark, train, texts, tmp_path):
    model_store.publish_table(log_odds.fit_log_odds(train, features=64), f"{tmp_path}/weights")
    weights = model_store.load_table(spark, f"{tmp_path}/weights")
    scored = {r["id"]: (r["label"], r["score"]) for r in log_odds.score_log_odds(weights, texts, features=64).collect()}

    def bucket(word):
        return int(hashlib.md5(word.encode()).hexdigest()[:8], 16) % 64

    count = {label: Counter(bucket(w) for t, x in ROWS if x == label for w in t.split()) for label in ("TROLL", "NO_TROLL")}
    total = {label: sum(c.values()) + 64 for label, c in count.items()}
    for i, text in enumerate(TEXTS):
        words = (text or "").split()
        if not words:
            assert scored[i] == ("undefined", 0.0)
            continue
        z = sum(
            math.log((count["TROLL"][bucket(w)] + 1) / total["TROLL"]) - math.log((count["NO_TROLL"][bucket(w)] + 1) / total["NO_TROLL"])
            for w in words
        )
        p = 1 / (1 + math.exp(-z))
        assert scored[i][1] == pytest.approx(p, abs=1e-12)
        assert scored[i][0] == ("TROLL" if p >= 0.5 else "NO_TROLL")


def test_no_training_texts(spark, train, texts):
    weights = log_odds.fit_log_odds(train.where("text is null"), features=16)
    scored = log_odds.score_log_odds(weights, texts, features=16).collect()
    assert {r["score"] for r in scored} == {0.0, 0.5} and len(scored) == len(TEXTS)


def test_stream_with_loaded_weights_equals_batch(spark, train, tmp_path):
    model_store.publish_table(log_odds.fit_log_odds(train, features=64), f"{tmp_path}/weights")
    weights = model_store.load_table(spark, f"{tmp_path}/weights")
    rows = [(i, t) for i, t in enumerate(TEXTS) if t is not None]
    messages = spark.createDataFrame(rows, "s long, text string").select(
        F.timestamp_seconds(1704067200 + 10 * F.col("s")).alias("timestamp"), F.encode("text", "UTF-8").alias("value")
    )
    os.makedirs(f"{tmp_path}/in")
    for part in range(3):  # three files make three micro-batches
        messages.where(F.second("timestamp") % 3 == part).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(messages.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    scorer = lambda df: log_odds.score_log_odds(weights, df, features=64)
    query = (
        scoring.in_windows(stream, scorer).writeStream.format("parquet").option("path", f"{tmp_path}/out")
        .option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    columns = ["message", "label", "score", "window_start"]
    got = sorted(map(tuple, spark.read.parquet(f"{tmp_path}/out").select(*columns).collect()))
    assert got == sorted(map(tuple, scoring.in_windows(messages, scorer).select(*columns).collect()))
    assert len(got) == len(rows)
