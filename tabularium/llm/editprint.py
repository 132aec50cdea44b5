"""Document fingerprints: a randomised embedding of edit distance into Hamming distance.

One shared random walk reads every text: at output step j the walk stands on a character and moves on when the shared bit for
(j, character) is 1. Insertions and deletions shift the walks of two texts only until they meet again, so alike
texts have alike outputs. The fingerprint samples fixed output positions and keeps one bit of the characters found there,
at two scales: the power of two above the length of the text and the one below, so that texts of similar length share a
scale. Likeness is ``2 * equal bits - 1`` over the sampled positions that either text reaches (0 for chance, 1 for equal).

Texts are walked whole, many at once in numpy; the few longest of a batch are finished one by one. Neighbouring
documents in descending id order meet in range partitions; the last row of each partition finds its neighbour among
the first rows of the partitions (two rows per partition leave the scan).

Search: bands of sampled bits propose candidates for a query set, which are then verified by their likeness. Equal fingerprints
are searched once.

Defined results: a null text is empty; all empty texts share a fingerprint (likeness 1). Equal ids are ordered by a hash of the
text, null ids come last. A single document is its own neighbour. Repeated rows each get their row. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabularium.llm.common import kept_table, table

PERIOD, SYMBOLS = 64, 256
BITS = 192
GRAM = 4
STEPS_PER_CHAR = 2
BATCH_CHARS = 3_000_000
ALONE = 24  # so few texts left in a batch are walked one by one
LEVELS = 48
BANDS, BAND_BITS = 40, 20
SEED = 7_301


class Walk:
    """The shared randomness: steps, sampled positions and bit choices; made once per task."""

    def __init__(self):
        rng = np.random.default_rng(SEED)
        moves = rng.random((PERIOD, SYMBOLS)) < 1 / STEPS_PER_CHAR
        moves[rng.integers(0, PERIOD, SYMBOLS), np.arange(SYMBOLS)] = True
        self.steps = np.empty((PERIOD, SYMBOLS), dtype=np.int64)
        ahead = np.zeros(SYMBOLS, dtype=np.int64)
        for j in range(2 * PERIOD - 1, -1, -1):  # steps until the next move, around the period
            ahead = np.where(moves[j % PERIOD], 1, ahead + 1)
            self.steps[j % PERIOD] = ahead
        self.flat = self.steps.ravel()
        self.rows = self.steps.tolist()
        share = np.sort(rng.random((LEVELS, BITS)), axis=1)
        self.positions = [(share[s] * STEPS_PER_CHAR * 2.0**s).astype(np.int64) for s in range(LEVELS)]
        self.factors = rng.integers(0, 1 << 62, BITS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def places(self, symbol: np.ndarray, start: np.ndarray, length: np.ndarray, begin: np.ndarray, out: np.ndarray) -> np.ndarray:
        """Fill ``out`` with the output position of each character; returns the end of each walk."""
        order = np.argsort(-length, kind="stable")
        at, size, j = start[order], length[order], begin[order].astype(np.int64)
        longest = int(size[0]) if len(size) else 0
        active = np.searchsorted(-size, -np.arange(longest), side="left")
        alone = int(np.searchsorted(-active, -ALONE, side="left")) if longest else 0
        m_of = active[:alone].tolist()
        for t, m in enumerate(m_of):
            here = at[:m] + t
            now = j[:m]
            out[here] = now
            now += self.flat[((now & (PERIOD - 1)) << 8) + symbol[here]]
        for i in range(int(active[alone]) if alone < longest else 0):
            now, steps, first = int(j[i]), self.rows, int(at[i]) + alone
            last = int(at[i]) + int(size[i])
            found = []
            for c in symbol[first:last].tolist():
                found.append(now)
                now += steps[now & (PERIOD - 1)][c]
            out[first:last] = found
            j[i] = now
        end = np.empty_like(j)
        end[order] = j
        return end

    def bits(
        self, gram: np.ndarray, place: np.ndarray, start: np.ndarray, length: np.ndarray, end: np.ndarray, level: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """Sampled bits of each text at its ``level``, and how many samples lie within the text."""
        n = len(start)
        found, inside = np.zeros((n, BITS), dtype=bool), np.zeros(n, dtype=np.int64)
        for s in np.unique(level):
            rows = np.flatnonzero(level == s)
            wanted = self.positions[s]
            inside[rows] = np.searchsorted(wanted, end[rows], side="left")
            for r in rows:
                m = inside[r]
                if m:
                    own = place[start[r] : start[r] + length[r]]
                    at = np.searchsorted(own, wanted[:m], side="right") - 1
                    found[r, :m] = (gram[start[r] + at] * self.factors[:m]) >> np.uint64(63)
        return found, inside


def _levels(length: np.ndarray) -> np.ndarray:
    return np.ceil(np.log2(length + 1.0)).astype(np.int64)


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbol and hashed gram at each code point of the joined texts, and their offsets."""
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    offsets = np.concatenate(([0], np.cumsum([len(t) for t in texts], dtype=np.int64)))
    symbol = ((codes * np.uint32(0x9E3779B1)) >> np.uint32(24)).astype(np.int64)
    gram = codes.astype(np.uint64)
    for k in range(1, GRAM):
        gram[:-k or None] = gram[:-k or None] * np.uint64(0x9E3779B97F4A7C15) + codes[k:]
        gram[len(codes) - k :] *= np.uint64(0x9E3779B97F4A7C15)
    for k in range(1, GRAM):  # grams that would reach into the next text know only their own character
        at = offsets[1:] - k
        at = at[at >= offsets[:-1]]
        gram[at] = codes[at]
    gram ^= gram >> np.uint64(32)
    return symbol, gram * np.uint64(0xD6E8FEB86659FD93), offsets


class Prints:
    """Fingerprints of a list of texts."""

    def __init__(self, walk: Walk, texts: list[str], before: "Prints | None" = None, same: np.ndarray | None = None):
        """``same``: so many first characters of each text are those of ``before`` and need no new walk."""
        symbol, gram, offsets = _codes(texts)
        start, length = offsets[:-1], np.diff(offsets)
        place = np.empty(len(symbol), dtype=np.int64)
        if before is None:
            begin, rest = np.zeros(len(texts), dtype=np.int64), np.zeros(len(texts), dtype=np.int64)
        else:
            rest = same
            taken = before.start[: len(texts)]
            begin = before.end[: len(texts)].copy()
            cut = rest < before.length[: len(texts)]
            begin[cut] = before.place[(taken + rest)[cut]]
            shift = np.repeat(taken - start, rest)
            own = np.arange(int(rest.sum())) - np.repeat(np.cumsum(rest) - rest, rest) + np.repeat(start, rest)
            place[own] = before.place[own + shift]
        self.end = walk.places(symbol, start + rest, length - rest, begin, place)
        self.place, self.start, self.length = place, start, length
        self.level = _levels(length)
        self.own, self.n_own = walk.bits(gram, place, start, length, self.end, self.level)
        lower = np.maximum(self.level - 1, 0)
        self.lower, self.n_lower = walk.bits(gram, place, start, length, self.end, lower)

    def strings(self) -> list[str]:
        own, lower = np.packbits(self.own, axis=1), np.packbits(self.lower, axis=1)
        return [
            f"{s:02x}{a:02x}{x.tobytes().hex()}{b:02x}{y.tobytes().hex()}"
            for s, a, x, b, y in zip(self.level, self.n_own, own, self.n_lower, lower)
        ]


def _likeness(la, oa, na, wa, ma, lb, ob, nb, wb, mb) -> np.ndarray:
    """From levels, own bits and counts, lower bits and counts of both sides."""
    out = np.zeros(len(la))
    for case, x, nx, y, ny in (
        (la == lb, oa, na, ob, nb),
        (la == lb + 1, wa, ma, ob, nb),
        (lb == la + 1, oa, na, wb, mb),
    ):
        i = np.flatnonzero(case)
        if len(i):
            m = np.maximum(nx[i], ny[i])
            counted = np.arange(BITS) < m[:, None]
            equal = ((x[i] == y[i]) & counted).sum(axis=1)
            out[i] = np.where(m > 0, np.clip(2 * equal / np.maximum(m, 1) - 1, 0, 1), 1.0)
    return out


def likeness(a: Prints, b: Prints, rows_a: np.ndarray, rows_b: np.ndarray) -> np.ndarray:
    parts = [
        (p.level[r], p.own[r], p.n_own[r], p.lower[r], p.n_lower[r]) for p, r in ((a, rows_a), (b, rows_b))
    ]
    return _likeness(*parts[0], *parts[1])


def _parsed(prints: list[str]) -> tuple:
    """Levels, own bits and counts, lower bits and counts of fingerprint strings."""
    raw = np.frombuffer(bytes.fromhex("".join(prints)), dtype=np.uint8).reshape(len(prints), -1)
    width = BITS // 8
    own = np.unpackbits(raw[:, 2 : 2 + width], axis=1).astype(bool)
    lower = np.unpackbits(raw[:, 3 + width :], axis=1).astype(bool)
    return raw[:, 0].astype(int), own, raw[:, 1].astype(int), lower, raw[:, 2 + width].astype(int)


def likeness_of_strings(a: list[str], b: list[str]) -> np.ndarray:
    return _likeness(*_parsed(a), *_parsed(b)) if a else np.zeros(0)


def edited(text: str, following: str) -> str:
    """``text`` with its last third replaced by the first as many characters of ``following``."""
    k = len(text) // 3
    return text[: len(text) - k] + following[:k]


def _results(walk: Walk, ids: list, texts: list[str]) -> dict[str, list]:
    """Result columns of all texts but the last, each followed by its neighbour."""
    n = len(texts) - 1
    plain = Prints(walk, texts)
    changed = [edited(texts[i], texts[i + 1]) for i in range(n)]
    same = plain.length[:n] - plain.length[:n] // 3
    after = Prints(walk, changed, plain, same)
    rows = np.arange(n)
    return {
        "doc_id": ids[:n],
        "n_chars": plain.length[:n].tolist(),
        "edited_sha256": [hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in changed],
        "fingerprint": plain.strings()[:n],
        "edited_fingerprint": after.strings(),
        "near_edited": likeness(plain, after, rows, rows).tolist(),
        "near_next": likeness(plain, plain, rows, rows + 1).tolist(),
    }


RESULT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)
ARROW = pa.schema(
    [("doc_id", pa.int64()), ("n_chars", pa.int64())]
    + [(c, pa.string()) for c in ("edited_sha256", "fingerprint", "edited_fingerprint")]
    + [("near_edited", pa.float64()), ("near_next", pa.float64())]
)
EDGE = [("role", pa.int32()), ("part", pa.int64()), ("text", pa.string())]
INNER, FIRST, LAST = 0, 1, 2


def _walk_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order; all but the last of the partition get their results, first and last are handed on."""
    walk, part = Walk(), TaskContext.get().partitionId()
    ids, texts, size = [], [], 0
    schema = pa.schema(list(ARROW) + [pa.field(*f) for f in EDGE])

    def edge(doc_id, text, role: int) -> pa.RecordBatch:
        row = {name: None for name in schema.names} | {"doc_id": doc_id, "role": role, "part": part, "text": text}
        return pa.RecordBatch.from_pylist([row], schema)

    def done() -> pa.RecordBatch:
        found = _results(walk, ids, texts)
        n = len(ids) - 1
        extra = {"role": [INNER] * n, "part": [part] * n, "text": [None] * n}
        return pa.RecordBatch.from_pydict(found | extra, schema)

    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            text = text.as_py() or ""
            if not ids:
                yield edge(doc_id, text, FIRST)
            ids.append(doc_id)
            texts.append(text)
            size += len(text)
            if size >= BATCH_CHARS and len(ids) > 1:
                yield done()
                ids, texts, size = ids[-1:], texts[-1:], len(text)
    if len(ids) > 1:
        yield done()
    if ids:
        yield edge(ids[-1], texts[-1], LAST)


def _edge_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    walk = Walk()
    for batch in batches:
        for row in batch.to_pylist():
            found = _results(walk, [row["doc_id"], None], [row["text"], row["following"]])
            yield pa.RecordBatch.from_pydict(found, ARROW)


def fingerprint(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited form, with likeness to that and to the next document."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("_h"))
    order = F.col("doc_id").desc_nulls_last(), F.col("_h").desc()
    ranged = picked.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("doc_id", "text")
    walked = ranged.mapInArrow(_walk_task, f"{RESULT}, role int, part long, text string")
    rows = kept_table(walked, "fingerprints")
    edges = rows.where(F.col("role") != INNER).select("doc_id", "text", "role", "part")
    # one narrow row per partition is put in order; the texts follow by joins
    along = Window.orderBy("part")
    parts_used = edges.where(F.col("role") == FIRST).select("part")
    after = parts_used.select("part", F.coalesce(F.lead("part").over(along), F.first("part").over(along)).alias("next"))
    first = edges.where(F.col("role") == FIRST).select(F.col("part").alias("next"), F.col("text").alias("following"))
    last = edges.where(F.col("role") == LAST).join(after, "part").join(first, "next")
    closed = last.select("doc_id", "text", "following").mapInArrow(_edge_task, RESULT)
    return rows.where(F.col("role") == INNER).drop("role", "part", "text").unionByName(closed)


def band_keys(prints: DataFrame) -> DataFrame:
    """(fingerprint, key): sampled-bit bands of both scales of each distinct fingerprint."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        picks = np.random.default_rng(SEED + 1).integers(0, BITS, (BANDS, BAND_BITS))
        for batch in batches:
            names = batch.column(0).to_pylist()
            if not names:
                continue
            level, own, _, lower, _ = _parsed(names)
            keys = []
            for scale, bits in ((level, own), (np.maximum(level - 1, 0), lower)):
                packed = bits[:, picks] @ (1 << np.arange(BAND_BITS))
                keys.append((scale[:, None] << 40) + (np.arange(BANDS) << 32) + packed)
            flat = np.concatenate(keys, axis=1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(np.array(names, dtype=object), flat.shape[1]), pa.string()), pa.array(flat.ravel())],
                ["fingerprint", "key"],
            )

    return prints.select("fingerprint").distinct().mapInArrow(run, "fingerprint string, key long")


def search(prints: DataFrame, queries: DataFrame, bound: float = 0.8) -> DataFrame:
    """(fingerprint, found, likeness): fingerprints that share a band with a query and reach ``bound``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = likeness_of_strings(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            good = near >= bound
            kept = batch.filter(pa.array(good))
            yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(near[good])], ["fingerprint", "found", "likeness"])

    asked = band_keys(queries)
    all_ = band_keys(prints).withColumnRenamed("fingerprint", "found")
    pairs = asked.join(all_, "key").select("fingerprint", "found").distinct()
    return pairs.mapInArrow(run, "fingerprint string, found string, likeness double")


def op4_fingerprints(spark, sf_dir: str) -> DataFrame:
    return fingerprint(table(spark, sf_dir, "documents"))
