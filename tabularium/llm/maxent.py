"""Language-model scores from a hashed maximum-entropy model with a class-factored softmax.

Tokens are lower-cased (A-Z) words between white space and one end per text. Training gathers the exact count of
every token (a Spark aggregation that grows with the corpus). The ``TOP`` most frequent tokens are outcomes of their own,
all others share ``TAIL`` hashed outcomes; outcomes form classes by frequency. A token's probability is

    p(class | history) * p(outcome | class, history) * (count + 1) / (count of the outcome + its words + 1)

so unseen words have the weight of one count, as in the base score. Both softmax layers add weights of hashed features: the
previous word, the pair of previous words, and two skips. The weights come from full-batch gradient updates: in
every round all tasks sum expected feature counts and the log-likelihood over all training texts, Spark adds them up,
and each weight moves by ``log(observed / expected) / STEP`` less its share of ``DECAY``, a step of generalised iterative
scaling with a penalty on weights few tokens support. In the first round expectations follow from the outcome shares
and need no forward pass. Training ends when a round gains less than ``TOLERANCE`` a token (log10), after ``ROUNDS``
at the latest. A round that loses more than that is taken back and repeated with the step that cannot overshoot.

Scoring runs in sparse numpy batches. Counts of the ``HEAD`` most frequent tokens are broadcast (12 bytes each); the rarer tokens
of each text are joined with the count table by shuffle. Nothing is left out.

Defined results: a null text is an empty text with one token, its end. Without training rows every count is 0, the base
score 0 and the model uniform over its outcomes. Repeated rows count as often as they occur and each get a row. Other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabularium.llm.common import (
    Words,
    kept_table,
    remainder,
    row_starts,
    row_sums,
    share,
    shared_model,
    space_words,
    table,
    text_blocks,
)

CLASSES, SLOTS = 16, 16
TOP, TAIL = 128, 128
HEAD = 1 << 18
FEATURES = 4
WIDTH = max(CLASSES, SLOTS)
SUMS = [f"v{k}" for k in range(WIDTH)]
CLASS_BITS, SLOT_BITS = 13, 14
ROUNDS = 30  # a bound; convergence ends the training
TOLERANCE = 1e-3  # log10 a token
STEP = 2.0  # at FEATURES scaling is sure not to overshoot, below it is faster
SMOOTHING, DECAY = 20.0, 50.0
END, START = 0x51A7_E0D5_9C3B_4F21, 0x1B56_C4E9_8D2F_A073
CHUNK = 1 << 12  # tokens whose logits fit the cache
WIDE = 1 << 16
MOST = 10.0
COMBINE = 1 << 22


@dataclass
class LanguageModel:
    total: int  # N, all training tokens
    distinct: int  # V
    head: np.ndarray  # hashes of frequent tokens, sorted
    head_count: np.ndarray
    top: np.ndarray  # hash of each outcome below TOP
    log_norm: np.ndarray  # log10 of the divisor within each outcome
    bias: np.ndarray  # classes x (1 + slots): log shares
    class_weight: np.ndarray
    slot_weight: np.ndarray

    def __post_init__(self):
        self.shift, self.place = 48, np.full(1 << 16, -1, dtype=np.int16)
        for shift in range(48, 0, -1):  # a shift at which the frequent tokens do not collide
            at = (self.top >> np.uint64(shift)) & np.uint64(0xFFFF)
            if len(np.unique(at)) == len(at):
                self.shift = shift
                self.place[at.astype(np.int64)] = np.arange(len(at))
                return
        raise ValueError("frequent tokens collide")

    def outcome(self, h: np.ndarray) -> np.ndarray:
        found = self.place[((h >> np.uint64(self.shift)) & np.uint64(0xFFFF)).astype(np.int64)]
        tail = (TOP + (h >> np.uint64(57)).astype(np.int64)) if TAIL == 128 else TOP + (h % np.uint64(TAIL)).astype(np.int64)
        if not len(self.top):
            return tail
        return np.where((found >= 0) & (self.top[np.maximum(found, 0)] == h), found, tail)


class Tokens:
    """Token hashes of byte blocks, the end of each text included; made once per task."""

    def __init__(self):
        self.words = Words(space_words)

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all tokens in order, and where each text begins."""
        n = len(offsets) - 1
        start, end, row = self.words.spans(data, offsets)
        first = row_starts(row, n)
        h = np.full(len(row) + n, END, dtype=np.uint64)
        h[np.arange(len(row)) + row] = self.words.hashes(data, start, end)
        return h, first + np.arange(n + 1)


def _features(h: np.ndarray, starts: np.ndarray) -> list[np.ndarray]:
    """Hashed histories of every token: previous word, the one before, their pair, the third back."""
    before = []
    for k in (1, 2, 3):
        w = np.full(len(h), START + k, dtype=np.uint64)
        w[k:] = h[:-k]
        for j in range(k):
            at = starts[:-1] + j
            w[at[at < starts[1:]]] = START + k
        before.append(w)
    one, two, three = before
    mix = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)
    pair = (one * np.uint64(mix[2])) ^ (two * np.uint64(mix[3]) >> np.uint64(7))
    return [one * np.uint64(mix[0]), two * np.uint64(mix[1]), pair * np.uint64(mix[1]), three * np.uint64(mix[3])]


def _rows(features: list[np.ndarray], kind: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Rows of the class weights, and of the slot weights given the class ``kind``."""
    own = (kind.astype(np.uint64) + np.uint64(1)) * np.uint64(0xA0761D6478BD642F)
    classes = [(g >> np.uint64(64 - CLASS_BITS)).astype(np.uint16) for g in features]
    slots = [(((g ^ own) * np.uint64(0xE7037ED1A0B428DB)) >> np.uint64(64 - SLOT_BITS)).astype(np.uint16) for g in features]
    return classes, slots


def _softmax(bias: np.ndarray, weight: np.ndarray, rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Logits and their exponentials; weights are clipped in training, so nothing overflows."""
    logit = np.take(weight, rows[0], axis=0)
    logit += bias
    for r in rows[1:]:
        logit += np.take(weight, r, axis=0)
    return logit, np.exp(logit)


def _norms(e: np.ndarray) -> np.ndarray:
    return e @ np.ones(e.shape[1], dtype=e.dtype)


def _count_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(h, c): counts of token hashes, combined over a few million tokens before they leave the task."""
    tokens, waiting, size = Tokens(), [], 0

    def combined() -> pa.RecordBatch:
        h, c = np.unique(np.concatenate(waiting), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(c.astype(np.int64))], ["h", "c"])

    for batch in batches:
        for _, _, data, offsets in text_blocks(batch.column(0)):
            h, _ = tokens(data, offsets)
            waiting.append(h)
            size += len(h)
            if size >= COMBINE:
                yield combined()
                waiting, size = [], 0
    if waiting:
        yield combined()


def _add_expected(total: np.ndarray, rows: list[np.ndarray], y: np.ndarray, kind: np.ndarray | None, weight, model) -> float:
    """Add each token's probabilities to the rows of its features: classes, or slots within ``kind``; log10 of all ``y``."""
    n, width = len(rows[0]), len(total)
    p, reached = np.empty((width, n)), 0.0
    for at in range(0, n, CHUNK):
        here = slice(at, at + CHUNK)
        bias = model.bias[:, 0] if kind is None else model.bias[kind[here], 1:]
        _, e = _softmax(bias, weight, [r[here] for r in rows])
        e /= _norms(e)[:, None]
        reached += np.log10(e[np.arange(len(e)), y[here]], dtype=np.float64).sum()
        p[:, here] = e.T
    for r in rows:
        place = r.astype(np.int64)
        for k in range(width):
            total[k] += np.bincount(place, p[k], total.shape[1])
    return reached


def _sums_task(shared, expected: bool):
    """(place, v0, v1, ...): observed, or expected, feature counts of both layers by feature row, and the log-likelihood."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, tokens = shared_model(shared), Tokens()
        classes = np.zeros((CLASSES, 1 << CLASS_BITS))
        slots = np.zeros((SLOTS, 1 << SLOT_BITS))
        kinds = np.zeros((CLASSES, 1 << SLOT_BITS))  # classes of the tokens behind each slot row
        reached = 0.0
        for batch in batches:
            for _, _, data, offsets in text_blocks(batch.column(0)):
                h, starts = tokens(data, offsets)
                features = _features(h, starts)
                outcome = model.outcome(h)
                for at in range(0, len(h), WIDE):
                    o = outcome[at : at + WIDE]
                    kind, slot = o // SLOTS, o % SLOTS
                    c_rows, s_rows = _rows([g[at : at + WIDE] for g in features], kind)
                    if expected:
                        reached += _add_expected(classes, c_rows, kind, None, model.class_weight, model)
                        reached += _add_expected(slots, s_rows, slot, kind, model.slot_weight, model)
                    else:
                        for total, rows, y in ((classes, c_rows, kind), (slots, s_rows, slot), (kinds, s_rows, kind)):
                            for r in rows:
                                cell = y * total.shape[1] + r
                                total += np.bincount(cell, minlength=total.size).reshape(total.shape)
        last = np.zeros((WIDTH, 1))
        last[0] = reached
        values = np.concatenate([classes, slots, kinds, last], axis=1)
        place = np.flatnonzero(values.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(place), *(pa.array(v[place]) for v in values)], ["place", *SUMS])

    return run


def _sums(train: DataFrame, model: LanguageModel, expected: bool) -> tuple[list[np.ndarray], float]:
    """Feature counts summed by Spark, and the log10 probability of all texts; the driver gets one number per weight."""
    shared = share(train.sparkSession, model)
    parts = train.mapInArrow(_sums_task(shared, expected), "place long, " + ", ".join(f"{v} double" for v in SUMS))
    got = parts.groupBy("place").agg(*(F.sum(v).alias(v) for v in SUMS)).toArrow()
    ends = np.cumsum([1 << CLASS_BITS, 1 << SLOT_BITS, 1 << SLOT_BITS])
    flat = np.zeros((ends[-1] + 1, WIDTH))
    flat[got.column("place").to_numpy()] = np.column_stack([got.column(v).to_numpy() for v in SUMS])
    *layers, last = np.split(flat, ends)
    return layers, float(last[0, 0])


def token_counts(train: DataFrame) -> DataFrame:
    """(h, c): the exact count of every training token, as a stored table."""
    parts = train.select("text").mapInArrow(_count_task, "h long, c long")
    return kept_table(parts.groupBy("h").agg(F.sum("c").alias("c")), "token-counts")


def _reached(sizes: DataFrame, k: int) -> tuple[int | None, int]:
    """The first ``at`` (ascending) where the summed ``n`` reaches ``k``, and the sum before it."""
    got = sizes.toArrow()
    at, n = got.column("at").to_numpy(), got.column("n").to_numpy()
    order = np.argsort(at)
    total = np.cumsum(n[order])
    i = int(np.searchsorted(total, k))
    return (None, int(total[-1]) if len(total) else 0) if i == len(total) else (int(at[order[i]]), int(total[i] - n[order[i]]))


def most_frequent(counts: DataFrame, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and counts of the ``k`` most frequent tokens, highest first, ties to the smaller hash.

    Histograms give the lowest count that belongs and, among tokens with that count, the highest hash range, so
    only about ``k`` rows leave their tasks. Histograms are small: 64 levels for each power of two, the distinct
    counts of one level, 65,536 hash ranges.
    """

    def sizes(rows: DataFrame, at) -> DataFrame:
        return rows.groupBy(at.cast("long").alias("at")).agg(F.count(F.lit(1)).alias("n"))

    level = -F.floor(F.log2("c") * 64)
    edge, before = _reached(sizes(counts, level), k)
    rows = counts
    if edge is not None:
        inside = counts.where(level == edge)
        least, inner = _reached(sizes(inside, -F.col("c")), k - before)
        ties = counts.where(F.col("c") == -least)
        place = F.shiftright("h", 48)
        to, _ = _reached(sizes(ties, place), k - before - inner)
        rows = counts.where((F.col("c") > -least) | ((F.col("c") == -least) & (place <= to)))
    head = rows.select("h", "c").toArrow()
    h, c = head.column("h").to_numpy(), head.column("c").to_numpy()
    order = np.lexsort((h, -c))[:k]
    return h[order].view(np.uint64), c[order]


def fit(train: DataFrame, rounds: int = ROUNDS) -> tuple[LanguageModel, DataFrame]:
    """The model, and the stored table of token counts that scoring joins with."""
    texts = train.select("text")
    counts = token_counts(texts)
    size = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).head()
    h, c = most_frequent(counts, HEAD)
    top, top_count = h[:TOP], c[:TOP]
    tail_of = F.shiftrightunsigned("h", 57).cast("int")
    tail = counts.groupBy(tail_of.alias("b")).agg(F.sum("c").alias("t"), F.count(F.lit(1)).alias("v")).toArrow()
    sums, words = np.zeros(TOP + TAIL), np.zeros(TOP + TAIL)
    sums[TOP + tail.column("b").to_numpy()] = tail.column("t").to_numpy()
    words[TOP + tail.column("b").to_numpy()] = tail.column("v").to_numpy()
    own = TOP + (top >> np.uint64(57)).astype(np.int64)  # frequent tokens leave their hashed outcome
    np.subtract.at(sums, own, top_count)
    np.subtract.at(words, own, 1)
    norm = sums + words + 1
    norm[: len(top)] = top_count + 1
    share = sums.copy()
    share[: len(top)] = top_count
    share = (share + 1).reshape(CLASSES, SLOTS)
    classes = share.sum(axis=1)
    bias = np.column_stack([np.log(classes / classes.sum()), np.log(share / classes[:, None])]).astype(np.float32)
    place = np.argsort(h)
    model = LanguageModel(
        int(size["n"]), int(size["v"]), h[place], c[place], top, np.log10(norm), bias,
        np.zeros((1 << CLASS_BITS, CLASSES), np.float32), np.zeros((1 << SLOT_BITS, SLOTS), np.float32),
    )
    if not model.total:
        return model, counts
    observed, _ = _sums(texts, model, expected=False)
    # with all weights 0 every token expects the shares of the outcomes
    want = [observed[0].sum(axis=1, keepdims=True) * np.exp(bias[:, 0]), observed[2] @ np.exp(bias[:, 1:])]
    here, step = (model.class_weight, model.slot_weight), STEP
    before = float(((share - 1) * (bias[:, :1] + bias[:, 1:])).sum() / np.log(10.0))
    for turn in range(rounds):
        if turn:
            (*now, _), reached = _sums(texts, model, expected=True)
            gain = (reached - before) / model.total
            if abs(gain) < TOLERANCE:
                break
            if gain > 0:
                here, want, before = (model.class_weight, model.slot_weight), now, reached
            elif step < FEATURES:
                step = FEATURES
            else:
                model.class_weight, model.slot_weight = here
                break
        model.class_weight, model.slot_weight = _moved(here, observed, want, step)
    return model, counts


def _moved(weights, observed: list[np.ndarray], want: list[np.ndarray], step: float) -> list[np.ndarray]:
    """Both layers' weights after one update."""
    moved = []
    for w, o, e in zip(weights, observed, want):
        prior = SMOOTHING * e / np.maximum(e.sum(axis=1, keepdims=True), 1e-9)
        move = np.log((o + prior + 1e-9) / (e + prior + 1e-9)) - w * DECAY / (e + prior + DECAY)
        moved.append(np.clip(w + move / step, -MOST, MOST).astype(np.float32))
    return moved


def score_rows(docs: DataFrame, model: LanguageModel, keep: tuple[str, ...]) -> DataFrame:
    """Per row: what the head and the model give, and the rarer tokens (``tail``, ``times``) still to be joined."""
    shared = share(docs.sparkSession, model)
    picked = docs.select(*keep, F.col("text").alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, tokens = shared_model(shared), Tokens()
        uid = TaskContext.get().partitionId() << 40
        log_count = np.log10(model.head_count + 1.0)
        for batch in batches:
            for lo, hi, data, offsets in text_blocks(batch.column(batch.num_columns - 1)):
                h, starts = tokens(data, offsets)
                context = _context(model, h, starts)
                place = np.minimum(np.searchsorted(model.head, h), max(len(model.head) - 1, 0))
                in_head = model.head[place] == h if len(model.head) else np.zeros(len(h), dtype=bool)
                logs = np.where(in_head, log_count[place], 0.0) if len(model.head) else np.zeros(len(h))
                row = np.repeat(np.arange(hi - lo), np.diff(starts))
                rare, owner = h[~in_head].view(np.int64), row[~in_head]
                order = np.lexsort((rare, owner))
                rare, owner = rare[order], owner[order]
                new = np.flatnonzero(np.concatenate(([True], (rare[1:] != rare[:-1]) | (owner[1:] != owner[:-1])))[: len(rare)])
                times = np.diff(np.concatenate((new, [len(rare)]))).astype(np.int32)
                cut = pa.array(row_starts(owner[new], hi - lo).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        *[c.slice(lo, hi - lo) for c in batch.columns[:-1]],
                        pa.array(uid + np.arange(hi - lo)),
                        pa.array(np.diff(starts)),
                        pa.array(row_sums(in_head.astype(np.int64), starts).astype(np.int64)),
                        pa.array(row_sums(logs, starts)),
                        pa.array(context),
                        pa.ListArray.from_arrays(cut, pa.array(rare[new])),
                        pa.ListArray.from_arrays(cut, pa.array(times)),
                    ],
                    [*batch.schema.names[:-1], "_uid", "n_tokens", "_known", "_logs", "_context", "tail", "times"],
                )
                uid += hi - lo

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in picked.schema.fields[:-1])
    more = "_uid long, n_tokens long, _known long, _logs double, _context double, tail array<long>, times array<int>"
    return picked.mapInArrow(run, f"{schema}, {more}")


def _context(model: LanguageModel, h: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Per text: log10 of both softmax layers, less the divisors within the outcomes."""
    features = _features(h, starts)
    outcome = model.outcome(h)
    each = np.empty(len(h))
    for at in range(0, len(h), CHUNK):
        o = outcome[at : at + CHUNK]
        kind, slot, rows = o // SLOTS, o % SLOTS, np.arange(len(o))
        c_rows, s_rows = _rows([g[at : at + CHUNK] for g in features], kind)
        logit, e = _softmax(model.bias[:, 0], model.class_weight, c_rows)
        got = logit[rows, kind] - np.log(_norms(e))
        logit, e = _softmax(model.bias[kind, 1:], model.slot_weight, s_rows)
        got = (got + logit[rows, slot] - np.log(_norms(e))) / np.log(10.0)
        each[at : at + CHUNK] = got - model.log_norm[o]
    return row_sums(each, starts)


def score(docs: DataFrame, model: LanguageModel, counts: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns with ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score``."""
    rows = kept_table(score_rows(docs, model, keep), "lm-rows")
    rare = rows.select("_uid", F.explode(F.arrays_zip("tail", "times")).alias("t")).select(
        "_uid", F.col("t.tail").alias("h"), F.col("t.times").alias("k")
    )
    joined = rare.join(counts, "h").groupBy("_uid").agg(
        F.sum("k").alias("_k"), F.sum(F.col("k") * F.log10(F.col("c") + 1.0)).alias("_l")
    )
    both = rows.drop("tail", "times").join(joined, "_uid", "left")
    logs = F.col("_logs") + F.coalesce("_l", F.lit(0.0))
    base = F.lit(float(np.log10(model.total + model.distinct + 1)))
    return both.select(
        *keep,
        "n_tokens",
        (F.col("_known") + F.coalesce("_k", F.lit(0))).alias("n_known"),
        F.lit(model.total).cast("long").alias("train_tokens"),
        (logs - F.col("n_tokens") * base).alias("base_score"),
        (logs + F.col("_context")).alias("score"),
    )


def op3_lm_scores(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("_held", remainder("doc_id", 7) == 2)
    model, counts = fit(docs.where("NOT _held"))
    scored = score(docs, model, counts, keep=("doc_id", "_held"))
    return scored.withColumnRenamed("_held", "held_out")
