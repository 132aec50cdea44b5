"""Quality classifier: histogram gradient-boosted trees over document statistics.

Every task turns whole texts into a fixed row of statistics in numpy. The trees are fitted on a
bounded sample of labelled rows (at most ``SAMPLE``: those with the smallest hash of their id, so the
choice does not depend on partitions), whose statistics alone reach the driver. Fitted trees are flattened
into arrays (feature, threshold, children, value) and all rows of a batch walk them together.

Defined results: a null text is an empty text, and both get an ordinary score from their (zero)
statistics. Without labelled rows, or with one class only, every score is the share of label 1
(0.5 without any row). A document with several labels counts once per distinct label; null labels and
rows without a document teach nothing, and of several texts under one id the one with the smallest statistics
teaches. Repeated rows each get the same score. Columns besides the
text never reach the model.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabularium.llm.common import (
    Words,
    kept_table,
    line_words,
    remainder,
    row_starts,
    row_sums,
    share,
    shared_model,
    smallest_hashes,
    space_words,
    table,
    text_blocks,
    unused,
)

SAMPLE = 20_000
THRESHOLD = 0.3
TREES, DEPTH, BINS, RATE, LEAF_WEIGHT, PENALTY = 60, 4, 64, 0.15, 8.0, 1.0
FEATURES = (
    "log_bytes", "log_words", "word_bytes", "upper", "digits", "punctuation", "bars", "marks", "symbols",
    "ends", "breaks", "beyond_ascii", "distinct_words", "equal_neighbours", "top_word", "short_words",
    "letter_ends", "capital_starts", "log_lines", "repeated_lines", "distinct_triples",
)


def _distinct(keys: np.ndarray, row: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys of each row, and the count of its most frequent key."""
    if not len(keys):
        return np.zeros(n), np.zeros(n)
    order = np.argsort(keys, kind="stable")
    order = order[np.argsort(row[order].astype(np.uint16 if n < 65536 else np.int64), kind="stable")]
    k, r = keys[order], row[order]
    new = np.flatnonzero(np.concatenate(([True], (k[1:] != k[:-1]) | (r[1:] != r[:-1]))))
    runs = np.diff(np.concatenate((new, [len(k)])))
    top = np.zeros(n)
    np.maximum.at(top, r[new], runs)
    return np.bincount(r[new], minlength=n).astype(float), top


class Statistics:
    """Document statistics of text batches; made once per task."""

    def __init__(self):
        self.words, self.lines = Words(space_words), Words(line_words)
        classes = np.zeros((8, 256), dtype=bool)
        for i, chars in enumerate(
            (bytes(range(65, 91)), bytes(range(48, 58)), None, b"|", b"!?", b"#$%&*@~^=<>{}[]\\/_+", b".,;:", b"\n")
        ):
            members = chars if chars is not None else bytes(c for c in range(33, 127) if not chr(c).isalnum())
            classes[i, list(members)] = True
        self.classes = classes

    def __call__(self, column: pa.Array) -> np.ndarray:
        parts = [self.block(data, offsets) for _, _, data, offsets in text_blocks(column)]
        return np.concatenate(parts) if parts else np.zeros((0, len(FEATURES)))

    def block(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        n = len(offsets) - 1
        size = np.diff(offsets).astype(float)
        start, end, row = self.words.spans(data, offsets)
        first = row_starts(row, n)
        count = np.diff(first).astype(float)
        per_byte, per_word = 1 / np.maximum(size, 1), 1 / np.maximum(count, 1)
        share = [row_sums(c[data].astype(np.uint32), offsets) * per_byte for c in self.classes]
        beyond = row_sums((data >= 128).astype(np.uint32), offsets) * per_byte
        h = self.words.hashes(data, start, end)
        distinct, top = _distinct(h, row, n)
        same = np.zeros(len(h), dtype=np.uint32)
        same[1:] = (h[1:] == h[:-1]) & (row[1:] == row[:-1])
        letters = self.classes[0] | np.roll(self.classes[0], 32) | (np.arange(256) >= 128)
        three = np.flatnonzero(row[2:] == row[:-2])
        triples = (h[three] * np.uint64(3) + h[three + 1]) * np.uint64(5) + h[three + 2]
        lines_start, lines_end, line_row = self.lines.spans(data, offsets)
        lines = np.bincount(line_row, minlength=n).astype(float)
        own_lines, _ = _distinct(self.lines.hashes(data, lines_start, lines_end), line_row, n)
        own_triples, _ = _distinct(triples, row[three], n)
        width = end - start

        def words_share(flags: np.ndarray) -> np.ndarray:
            return row_sums(flags.astype(np.uint32), first) * per_word

        return np.column_stack([
            np.log1p(size), np.log1p(count), row_sums(width.astype(np.float64), first) * per_word,
            *share[:7], share[7], beyond, distinct * per_word, words_share(same), top * per_word,
            words_share(width <= 3), words_share(letters[data[end - 1]] if len(end) else width),
            words_share(self.classes[0][data[start]] if len(start) else width), np.log1p(lines),
            1 - own_lines / np.maximum(lines, 1), own_triples / np.maximum(count - 2, 1),
        ])


@dataclass
class Trees:
    """Flattened trees: node i of tree t goes left when feature <= threshold; leaves point to themselves."""

    base: float
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    depth: int

    def score(self, x: np.ndarray) -> np.ndarray:
        total, rows = np.full(len(x), self.base), np.arange(len(x))
        for t in range(len(self.feature)):
            at = np.zeros(len(x), dtype=np.int64)
            for _ in range(self.depth):
                goes_left = x[rows, self.feature[t, at]] <= self.threshold[t, at]
                at = np.where(goes_left, self.left[t, at], self.right[t, at])
            total += self.value[t, at]
        return 1 / (1 + np.exp(-total))


def _histogram(bins: np.ndarray, node: np.ndarray, n_nodes: int, weights: np.ndarray) -> np.ndarray:
    features = bins.shape[1]
    cell = (node[:, None] * features + np.arange(features)) * BINS + bins
    flat = np.bincount(cell.ravel(), np.repeat(weights, features), n_nodes * features * BINS)
    return flat.reshape(n_nodes, features, BINS)


def boost(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH) -> Trees:
    """Logistic boosting with second-order histogram splits, level by level."""
    nodes = 2 ** (depth + 1) - 1
    mean = float(np.clip(y.mean(), 1e-6, 1 - 1e-6)) if len(y) else 0.5
    base = float(np.log(mean / (1 - mean)))
    shape = (trees, nodes)
    feature, threshold = np.zeros(shape, dtype=np.int64), np.full(shape, np.inf)
    left = np.tile(np.arange(nodes), (trees, 1))
    right, value = left.copy(), np.zeros(shape)
    model = Trees(base, feature, threshold, left, right, value, depth)
    if len(y) == 0 or y.min() == y.max():
        return model
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(x.shape[1])]
    bins = np.column_stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)])
    margin = np.full(len(y), base)
    for t in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = y - p, p * (1 - p)
        node = np.zeros(len(y), dtype=np.int64)
        for level in range(depth):
            low, wide = 2**level - 1, 2**level
            gs = np.cumsum(_histogram(bins, node - low, wide, g), axis=2)
            hs = np.cumsum(_histogram(bins, node - low, wide, h), axis=2)
            gt, ht = gs[:, :, -1:], hs[:, :, -1:]
            gain = gs**2 / (hs + PENALTY) + (gt - gs) ** 2 / (ht - hs + PENALTY) - gt**2 / (ht + PENALTY)
            gain[(hs < LEAF_WEIGHT / 4) | (ht - hs < LEAF_WEIGHT / 4)] = -1.0
            flat = gain.reshape(wide, -1)
            best = flat.argmax(axis=1)
            f, b = best // BINS, best % BINS
            for k in range(wide):
                here = low + k
                if flat[k, best[k]] > 1e-9 and b[k] < len(cuts[f[k]]):
                    feature[t, here], threshold[t, here] = f[k], cuts[f[k]][b[k]]
                    left[t, here], right[t, here] = 2 * here + 1, 2 * here + 2
                else:  # pass on unsplit, so that every row stands on the same level
                    left[t, here] = right[t, here] = 2 * here + 1
            goes_left = x[np.arange(len(y)), feature[t, node]] <= threshold[t, node]
            node = np.where(goes_left, left[t, node], right[t, node])
        sums_g, sums_h = np.bincount(node, g, nodes), np.bincount(node, h, nodes)
        value[t] = RATE * sums_g / (sums_h + PENALTY)
        margin += value[t, node]
    return model


def _statistics_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    statistics = Statistics()
    for batch in batches:
        x = statistics(batch.column(2))
        values = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), len(FEATURES))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).cast(pa.int64()), batch.column(1), values.cast(pa.list_(pa.float64()))], ["_id", "y", "x"]
        )


def fit(docs: DataFrame, labels: DataFrame, target: str = "quality", sample: int = SAMPLE) -> Trees:
    """Trees fitted on at most ``sample`` labelled rows."""
    marks = labels.select(F.col("doc_id").alias("_id"), F.col(target).cast("double").alias("y"))
    known = docs.select(F.col("doc_id").alias("_id"))
    marked = marks.where("y IS NOT NULL").distinct().join(known, "_id", "left_semi").withColumn("_h", F.xxhash64("_id"))
    chosen = kept_table(smallest_hashes(marked, "_h", sample), "sample")  # its known size makes the join a broadcast
    rows = docs.select(F.col("doc_id").alias("_id"), "text").join(chosen.select("_id", "y"), "_id")
    statistics = rows.select("_id", "y", "text").mapInArrow(_statistics_task, "_id long, y double, x array<double>")
    each = statistics.groupBy("_id", "y").agg(F.min("x").alias("x")).withColumn("_h", F.xxhash64("_id"))
    got = each.toArrow().sort_by([("_h", "ascending"), ("_id", "ascending"), ("y", "ascending")]).slice(0, sample)
    if not got.num_rows:
        return boost(np.zeros((0, len(FEATURES))), np.zeros(0))
    x = got.column("x").combine_chunks().flatten().to_numpy().reshape(-1, len(FEATURES))
    y = got.column("y").to_numpy()
    place = np.lexsort([*x.T[::-1], y])  # equal ids may arrive in any order
    return boost(x[place], y[place])


def predict(docs: DataFrame, model: Trees, keep: tuple[str, ...] = ("doc_id",), score: str = "score") -> DataFrame:
    """``keep`` columns and the score; one row per input row."""
    shared = share(docs.sparkSession, model)
    picked = docs.select(*keep, F.col("text").alias(*unused(docs, "__text")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, statistics = shared_model(shared), Statistics()
        for batch in batches:
            scores = model.score(statistics(batch.column(batch.num_columns - 1)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(scores, pa.float64())], [*batch.schema.names[:-1], score]
            )

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in picked.schema.fields[:-1])
    return picked.mapInArrow(run, f"{schema}, `{score}` double")


def op7_quality(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("_held", remainder("doc_id", 5) == 0)
    model = fit(docs.where("NOT _held"), table(spark, sf_dir, "labels"))
    scored = predict(docs, model, keep=("doc_id", "_held"))
    return scored.select(
        "doc_id", F.col("_held").alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )
