"""Language identification: multinomial naive Bayes over hashed character n-grams.

Counts of hashed 1- to 3-grams are gathered per language in every task and summed by Spark; the
log-probability matrix (buckets x languages, a fixed number of buckets) is broadcast and texts are
scored in sparse numpy batches. Whole texts count; a text longer than a block is cut into pieces
whose sums are added, every n-gram in the piece where it starts.

Defined results: a null text, or one without any letter, is ``und`` with score 0; so is every text
when nothing was learned. Rows with a null label or a null text teach nothing. Ties between languages
go to the alphabetically first. Repeated rows count as often as they occur. Extra columns of the
input never reach the model, and names that clash with result columns are not carried along. More
than ``MOST_LABELS`` distinct labels raise a ValueError before anything is learned.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabularium.llm.common import remainder, row_sums, share, shared_model, table, unused

UNKNOWN = "und"
BUCKETS = 1 << 16
ORDERS = (1, 2, 3)
ALPHA = 0.5
#: Overlapping n-grams are not independent: evidence counts as that of so many n-grams at most.
EVIDENCE = 64
PIECE = 1 << 17
#: More labels than this are an error: the matrix that is broadcast takes half a megabyte a label.
MOST_LABELS = 512


@dataclass
class LangModel:
    labels: list[str]
    log_prob: np.ndarray  # languages x (buckets + 1); the last bucket counts nothing
    prior: np.ndarray


def _pieces(texts: list, limit: int) -> Iterator[tuple[np.ndarray, list[str]]]:
    """Blocks of lower-cased texts, long ones cut; n-grams start in the first ``limit`` characters of a piece."""
    owners, parts, size = [], [], 0
    for i, text in enumerate(texts):
        text = (text or "").lower()
        for at in range(0, len(text), limit):
            part = text[at : at + limit + ORDERS[-1] - 1]
            owners.append(i)
            parts.append(part)
            size += len(part)
            if size >= limit:
                yield np.array(owners), parts
                owners, parts, size = [], [], 0
    if parts:
        yield np.array(owners), parts


def _grams(parts: list[str], order: int, buckets: int, limit: int = PIECE) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of the n-gram at each code point (``buckets`` where none starts in this piece), offsets."""
    codes = np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    offsets = np.concatenate(([0], np.cumsum([len(p) for p in parts])))
    mixed = codes * np.uint32(0x9E3779B1)
    h = mixed.copy()
    for k in range(1, order):
        h[:-k] = h[:-k] * np.uint32(0x01000193) + mixed[k:]
    h = (h ^ (h >> np.uint32(15))) * np.uint32(0x85EBCA6B + 2 * order)
    bucket = (h >> np.uint32(8)).astype(np.int64) % buckets
    for k in range(1, order):
        at = offsets[1:] - k
        bucket[at[at >= offsets[:-1]]] = buckets
    for i in np.flatnonzero(np.diff(offsets) > limit):  # what follows is the next piece's
        bucket[offsets[i] + limit : offsets[i + 1]] = buckets
    return bucket, offsets


def _count_task(buckets: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            labels = batch.column(0).to_pylist()
            for owners, parts in _pieces(batch.column(1).to_pylist(), PIECE):
                spoken = np.array([labels[i] for i in owners], dtype=object)
                for label in dict.fromkeys(spoken):
                    own = [p for p, s in zip(parts, spoken) if s == label]
                    total = sums.setdefault(label, np.zeros(buckets + 1, dtype=np.int64))
                    for order in ORDERS:
                        grams, _ = _grams(own, order, buckets)
                        total += np.bincount(grams, minlength=buckets + 1)
        for label, total in sums.items():
            at = np.flatnonzero(total[:buckets])
            yield pa.RecordBatch.from_arrays(
                [pa.array([label] * len(at), pa.string()), pa.array(at), pa.array(total[at])],
                ["label", "bucket", "n"],
            )

    return count


def fit(train: DataFrame, text: str = "text", label: str = "lang", buckets: int = BUCKETS) -> LangModel:
    """Learn from all rows with a label. The driver gets one number per (label, bucket)."""
    rows = train.select(F.col(label).alias("label"), F.col(text).alias("text")).where("label IS NOT NULL")
    counted = rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).limit(MOST_LABELS + 1).collect()
    if len(counted) > MOST_LABELS:
        raise ValueError(f"column {label} holds more than {MOST_LABELS} languages")
    docs = {r["label"]: r["n"] for r in counted}
    sums = (
        rows.where("text IS NOT NULL")
        .mapInArrow(_count_task(buckets), "label string, bucket long, n long")
        .groupBy("label", "bucket")
        .agg(F.sum("n").alias("n"))
        .toArrow()
    )
    labels = sorted(docs)
    counts = np.zeros((len(labels), buckets), dtype=np.float64)
    if labels and sums.num_rows:
        place = {name: i for i, name in enumerate(labels)}
        which = np.array([place[x] for x in sums.column("label").to_pylist()])
        counts[which, sums.column("bucket").to_numpy()] = sums.column("n").to_numpy()
    smooth = counts + ALPHA
    log_prob = np.log(smooth) - np.log(smooth.sum(axis=1, keepdims=True)) if labels else counts
    log_prob = np.concatenate([log_prob, np.zeros((len(labels), 1))], axis=1)
    n = np.array([docs[x] for x in labels], dtype=np.float64)
    return LangModel(labels, log_prob, np.log(n / n.sum()) if labels else n)


def score_texts(texts: list, model: LangModel) -> tuple[list[str], np.ndarray]:
    """Language and confidence of each text of a batch."""
    n, k = len(texts), len(model.labels)
    if not k or not n:
        return [UNKNOWN] * n, np.zeros(n)
    buckets = model.log_prob.shape[1] - 1
    sums, grams = np.zeros((n, k)), np.zeros(n)
    for owners, parts in _pieces(texts, PIECE):
        for order in ORDERS:
            bucket, offsets = _grams(parts, order, buckets)
            np.add.at(grams, owners, np.clip(np.diff(offsets) - order + 1, 0, PIECE))
            for j in range(k):
                np.add.at(sums[:, j], owners, row_sums(model.log_prob[j][bucket], offsets))
    weight = np.minimum(1.0, EVIDENCE / np.maximum(grams, 1))
    logit = (model.prior + sums) * weight[:, None]  # tempered as a whole: the best language is that of the plain sums
    logit -= logit.max(axis=1, keepdims=True)
    prob = np.exp(logit)
    prob /= prob.sum(axis=1, keepdims=True)
    best = logit.argmax(axis=1)
    letter = re.compile(r"[^\W\d_]")
    known = np.array([bool(t and letter.search(t)) for t in texts], dtype=bool)
    names = [model.labels[b] if ok else UNKNOWN for b, ok in zip(best, known)]
    return names, np.where(known, prob[np.arange(n), best], 0.0)


def predict(
    docs: DataFrame,
    model: LangModel,
    text: str = "text",
    keep: tuple[str, ...] = ("doc_id",),
    names: tuple[str, str] = ("lang_pred", "score"),
) -> DataFrame:
    """``keep`` columns with language and score, called ``names``; one row per input row."""
    shared = share(docs.sparkSession, model)
    picked = docs.select(*keep, F.col(text).alias(*unused(docs, "__text")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared_model(shared)
        for batch in batches:
            langs, scores = score_texts(batch.column(batch.num_columns - 1).to_pylist(), model)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                [*batch.schema.names[:-1], *names],
            )

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in picked.schema.fields[:-1])
    return picked.mapInArrow(run, f"{schema}, `{names[0]}` string, `{names[1]}` double")


def op2_language_id(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("_held", remainder("doc_id", 3) == 1)
    model = fit(docs.where("NOT _held"))
    found = predict(docs, model, keep=("doc_id", "_held"))
    return found.select("doc_id", F.col("_held").alias("held_out"), "lang_pred", "score")
