"""Vocabularies, padded sequences, word vectors, classifiers and scoring."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import IDF, HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabularium.functions import text as tx
from tabularium.operators.order_stats import global_row_number
from tabularium.session import stored

SEQUENCE_LENGTH = 300
FREQUENT_WORDS = 10_000
#: Levels of the sums of classifier gradients, which have a number per feature.
DEPTH = 12
#: Words of texts whose neighbours a task adds up before it hands them on.
COMBINE = 1 << 18
#: Words of texts that a task counts, or numbers, at a time.
WORDS = 1 << 20
#: Bits that tell which words are frequent (16 MB), and how many of them a task sets at a time.
KNOWN_BITS, PIECE = 1 << 27, 1 << 22


def clean_comments(comments: DataFrame) -> DataFrame:
    """``content`` and nested ``annotation`` -> cleaned ``text`` and ``label``; keys are kept.

    Comments nobody has labelled are ``undefined``.
    """
    keys = [c for c in comments.columns if c not in ("content", "annotation")]
    flag = F.try_element_at(F.col("annotation.label"), F.lit(1))
    return comments.select(
        *keys,
        tx.clean_text("content").alias("text"),
        F.when(flag.isNull(), tx.UNDEFINED).otherwise(tx.label_name(flag)).alias("label"),
    )


def words_of(df: DataFrame, text: str = "text") -> DataFrame:
    """One row per word with its position; texts are split at white space."""
    keys = [c for c in df.columns if c != text]
    return df.select(*keys, F.posexplode(F.split(text, " +")).alias("pos", "word")).filter(
        F.col("word") != ""
    )


def vocabulary(df: DataFrame, text: str = "text") -> DataFrame:
    """``(word, n, index)``: index 1 for the most frequent word, ties in word order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for names, code, _ in word_groups(batches, WORDS):
            n = pa.array(np.bincount(code, minlength=len(names)).astype(np.int64))
            for lo in range(0, len(names), 1 << 16):
                yield pa.RecordBatch.from_arrays([x.slice(lo, 1 << 16) for x in (names, n)], ["word", "n"])

    parts = df.select(F.col(text).cast("string")).mapInArrow(run, "word string, n long")  # a task counts, only counts are shuffled
    counts = parts.groupBy("word").agg(F.sum("n").alias("n"))
    return global_row_number(counts, [F.col("n").desc(), F.col("word").asc()], "index")


def lookup_words(words: DataFrame, vocab: DataFrame, frequent: int = FREQUENT_WORDS) -> DataFrame:
    """Inner join of words with their index that does not suffer from very common words.

    The first ``frequent`` words of the vocabulary (a fixed number) are broadcast, so their many
    occurrences are matched where they are; only the rarer words are shuffled.
    """
    head = vocab.filter(F.col("index") <= frequent).select("word", "index")
    tail = vocab.filter(F.col("index") > frequent).select("word", "index")
    common = words.join(F.broadcast(head), "word")
    rare = words.join(F.broadcast(head.select("word")), "word", "left_anti").join(tail, "word")
    return common.unionByName(rare)


def padded_sequences(
    df: DataFrame,
    vocab: DataFrame,
    key: str,
    text: str = "text",
    length: int = SEQUENCE_LENGTH,
    all_known: bool = False,
) -> DataFrame:
    """Word indices per text, unknown words skipped, the last ``length`` kept, zeros in front.

    ``all_known`` says that the vocabulary holds every word of these texts: then the last words
    of a text are the kept ones, and only they are looked up.
    """
    words = F.filter(F.split(text, " +"), lambda w: w != "")
    last = F.when(F.size(words) > length, F.slice(words, -length, length)).otherwise(words)
    wanted = last if all_known else words
    found = lookup_words(df.select(key, F.posexplode(wanted).alias("pos", "word")), vocab)
    ordered = found.groupBy(key).agg(
        F.sort_array(F.collect_list(F.struct("pos", F.col("index").cast("int").alias("i")))).alias("s")
    )
    indices = F.transform(F.coalesce("s", F.array()), lambda w: w["i"])
    joined = df.select(key).join(ordered, key, "left").select(key, indices.alias("s"))
    kept = F.when(F.size("s") > length, F.slice("s", -length, length)).otherwise(F.col("s"))
    zeros = F.array_repeat(F.lit(0), F.greatest(F.lit(length) - F.size("s"), F.lit(0)))
    return joined.select(key, F.concat(zeros, kept).alias("sequence"))


def label_index(df: DataFrame, label: str, name: str = "label_index") -> DataFrame:
    """Labels in alphabetical order -> 0..n-1; a NULL label keeps a NULL index."""
    labels = df.select(F.col(label).alias("_label")).filter("_label IS NOT NULL").distinct()
    numbered = stored(global_row_number(labels, [F.col("_label").asc()], name, 0))
    found = df.join(numbered, F.col(label) == F.col("_label"), "left").drop("_label")
    return found.withColumn(name, F.col(name).cast("int"))


def _bits(column: Column) -> Column:
    return F.conv(F.substring(F.md5(column), 10, 7), 16, 10).cast("long") % KNOWN_BITS


def known_words(vocab: DataFrame):
    """A broadcast of ``KNOWN_BITS`` bits: those of the words of ``vocab`` are set, so a word without its bit is not one of them."""

    def merged(rows: pd.DataFrame) -> pd.DataFrame:
        bits = np.zeros(PIECE, dtype=bool)
        bits[rows["bit"].to_numpy() % PIECE] = True
        return pd.DataFrame({"part": [rows["bit"].iloc[0] // PIECE], "bits": [np.packbits(bits).tobytes()]})

    places = vocab.select(_bits(F.col("word")).alias("bit")).distinct()
    pieces = places.groupBy(F.floor(F.col("bit") / PIECE)).applyInPandas(merged, "part long, bits binary").toArrow()
    found = np.zeros(KNOWN_BITS // 8, dtype=np.uint8)
    for part, bits in zip(pieces.column("part").to_pylist(), pieces.column("bits").to_pylist()):
        found[part * PIECE // 8 : (part + 1) * PIECE // 8] = np.frombuffer(bits, np.uint8)
    return vocab.sparkSession.sparkContext.broadcast(found)


def maybe_known(shared, names: list[str]) -> np.ndarray:
    """Which words have their bit in a broadcast of ``known_words``."""
    digests = (hashlib.md5(w.encode("utf-8")).hexdigest() for w in names)
    at = np.fromiter((int(x[9:16], 16) % KNOWN_BITS for x in digests), np.int64, len(names))
    return (shared.value[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1


def word_groups(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """Texts in groups of about ``most`` words: the distinct words, the word number of every place, the words of every text."""
    held, sizes, many = [], [], 0

    def group():
        found = pa.concat_arrays(held).dictionary_encode()
        return found.dictionary, found.indices.to_numpy(), np.concatenate(sizes)

    for batch in batches:
        column = batch.column(0).cast(pa.large_string())
        long = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy())
        ends = np.searchsorted(long, np.arange(1, (long[-1] if len(long) else 0) // (8 * most) + 1) * (8 * most), "right")
        bounds = np.unique(np.r_[0, ends, len(column)])  # long texts are split a few at a time
        for lo, hi in zip(bounds[:-1], bounds[1:]):
            lists = pc.split_pattern(column.slice(lo, hi - lo), " ")
            words, length = lists.flatten(), pc.fill_null(pc.list_value_length(lists), 0).to_numpy()
            real = pc.not_equal(words, "").to_numpy(zero_copy_only=False)
            if not real.all():
                length = np.bincount(np.repeat(np.arange(len(length)), length)[real], minlength=len(length))
                words = words.filter(pa.array(real))
            held.append(words)
            sizes.append(length)
            many += len(words)
            if many >= most:
                yield group()
                held, sizes, many = [], [], 0
    if many:
        yield group()


def word_batches(batches: Iterator[pa.RecordBatch], most: int = COMBINE) -> Iterator[tuple[list[str], np.ndarray, np.ndarray]]:
    """Texts in groups of about ``most`` words: the distinct words, the word number of every place, the text of every place."""
    for names, code, sizes in word_groups(batches, most):
        yield names.to_pylist(), code.astype(np.int64), np.repeat(np.arange(len(sizes)), sizes)


def _context_task(shared, size: int, window: int):
    """(word, dim, value) of groups of texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for names, code, text in word_batches(batches):
            digests = [hashlib.md5(w.encode("utf-8")).hexdigest() for w in names]
            place = np.array([int(x[:8], 16) % size for x in digests])
            sign = np.array([-1 if int(x[8], 16) % 2 else 1 for x in digests])
            dim, signed, known = place[code], sign[code], maybe_known(shared, names)[code]
            keys, values = [], []
            for gap in range(1, window + 1):
                same = np.flatnonzero(text[gap:] == text[:-gap])
                for at, beside in ((same, same + gap), (same + gap, same)):
                    at, beside = at[known[at]], beside[known[at]]
                    keys.append(code[at] * size + dim[beside])
                    values.append(signed[beside])
            key, value = np.concatenate(keys), np.concatenate(values)
            order = np.argsort(key, kind="stable")
            key, value = key[order], value[order]
            first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, int)
            total = np.add.reduceat(value, first) if len(key) else value
            word = pa.array(names, pa.string()).take(pa.array(key[first] // size))
            cells = [word, pa.array((key[first] % size + 1).astype(np.int32)), pa.array(total.astype(np.int64))]
            for lo in range(0, len(first), 1 << 16):
                yield pa.RecordBatch.from_arrays([c.slice(lo, 1 << 16) for c in cells], ["word", "dim", "value"])

    return run


def context_counts(
    df: DataFrame,
    vocab: DataFrame,
    text: str = "text",
    size: int = 300,
    window: int = 7,
    min_count: int = 10,
) -> DataFrame:
    """``(word, dim, value)``: words seen around each frequent enough word, hashed into ``size`` dimensions.

    Each context word adds its sign at its dimension, so vectors of a fixed size keep (on average)
    the inner products of the full context counts. A task adds up groups of texts, whose sums are all that is
    shuffled; nothing is trained, nothing passes the driver, and the result does not depend on partitions.
    """
    known = vocab.filter(F.col("n") >= min_count).select("word", "index")
    task = _context_task(known_words(known), size, window)
    parts = df.select(text).mapInArrow(task, "word string, dim int, value long")
    sums = parts.groupBy("word", "dim").agg(F.sum("value").alias("value"))
    return sums.join(known.select("word"), "word", "left_semi")  # a bit may belong to several words


def embedding_table(vocab: DataFrame, counts: DataFrame, size: int) -> DataFrame:
    """Vector per vocabulary word; words without one get zeros."""

    @F.pandas_udf("array<double>")
    def dense(dims: pd.Series, values: pd.Series) -> pd.Series:
        rows = np.zeros((len(dims), size))
        for row, at, value in zip(rows, dims, values):
            row[at - 1] = value
        return pd.Series(list(rows))

    cells = counts.groupBy("word").agg(F.collect_list(F.struct("dim", "value")).alias("at"))
    entries = cells.select("word", dense("at.dim", "at.value").alias("at"))
    zeros = F.array_repeat(F.lit(0.0), size)
    joined = vocab.join(entries, "word", "left")
    return joined.withColumn("vector", F.coalesce("at", zeros)).drop("at")


def with_words(df: DataFrame, text: str = "text") -> DataFrame:
    return df.withColumn("words", F.filter(F.split(text, " +"), lambda t: t != ""))


def fit_classifier(
    train: DataFrame, label: str = "label", text: str = "text", features: int = 1 << 20
) -> PipelineModel:
    """Hashed term weights and logistic regression; class 1 is TROLL."""
    data = with_words(train, text).withColumn(
        "target", F.when(F.col(label) == tx.TROLL, 1.0).otherwise(0.0)
    )
    return Pipeline(
        stages=[
            HashingTF(inputCol="words", outputCol="tf", numFeatures=features),
            IDF(inputCol="tf", outputCol="features"),
            # deep trees: the driver gets sums of two or three partitions, however many there are
            LogisticRegression(labelCol="target", regParam=0.01, maxIter=20, aggregationDepth=DEPTH),
        ]
    ).fit(data)


def score(model: PipelineModel, df: DataFrame, text: str = "text") -> DataFrame:
    """``label`` and ``score`` for cleaned texts; works on batch and streaming frames.

    Texts without a word get the fallback label ``undefined`` and score 0.
    """
    keys = [c for c in df.columns if c not in ("label", "score")]
    scored = model.transform(with_words(df, text))
    p = vector_to_array("probability")[1]
    usable = F.size("words") > 0
    return scored.select(
        *keys,
        F.when(usable, tx.label_of_score(p)).otherwise(F.lit(tx.UNDEFINED)).alias("label"),
        F.when(usable, p).otherwise(F.lit(0.0)).alias("score"),
    )


def evaluate_classifier(model: PipelineModel, holdout: DataFrame, text: str = "text") -> DataFrame:
    """Accuracy and log loss on held-out texts."""
    scored = model.transform(
        with_words(holdout, text).withColumn(
            "target", F.when(F.col("label") == tx.TROLL, 1.0).otherwise(0.0)
        )
    )
    values = {
        metric: MulticlassClassificationEvaluator(
            labelCol="target", predictionCol="prediction", metricName=metric
        ).evaluate(scored)
        for metric in ("accuracy", "logLoss")
    }
    return holdout.sparkSession.createDataFrame(
        [(k, float(v)) for k, v in values.items()], "metric string, value double"
    )


def prediction_json(scored: DataFrame) -> DataFrame:
    return scored.select(F.to_json(F.struct("text", "label", "score")).alias("value"))
