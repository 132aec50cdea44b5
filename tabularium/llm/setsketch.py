"""Near-duplicate detection with SetSketch registers, likelihood estimates and exact verification.

A document's set is its distinct word shingles (lower-cased A-Z, words between white space). Register i of
its sketch is ``floor(1 - log_b(min h_i))`` over the set, with exponential h_i: minima spaced
exponentially and truncated, mergeable by maximum and equal more often the more alike two sets are. Bands of register
values propose pairs, the joint likelihood of the two sketches (with the known set sizes) drops
pairs far below the bound, and every remaining pair is verified on the full sets.

Groups of copies never become all pairs. Equal sets collapse to one node first. In each bucket nodes are
compared with one pivot per round, first with the node that shares most buckets with others; linked nodes take one label, and a
bucket whose nodes share a label is done. Nodes of the other buckets then meet by an exact prefix filter: shingles in
the order of their counts (hashed into a table of fixed size), only the rare ones at the front of a set are joined,
and a pair of different labels is drawn only if the places of the common shingle still allow the bound. So no linked pair between
components is left out. Labels are joined by large-star and small-star steps on stored edge tables.

With 32 bands of 4 registers a pair of similarity 0.8 is missed with probability 5e-8.

Defined results: fewer words than a shingle make one shingle of all words; no word or null text has the empty
set and no link. A document without id has no component (null) and is kept. Rows that share an id
are one document that has the links of all of them. Repeated rows each get a row. Other columns are
ignored and may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabularium.llm.common import Words, kept_table, row_starts, share, shared_model, space_words, table, text_blocks, unused

REGISTERS, BAND = 128, 4
BASE, RATE, LIMIT = 1.001, 20.0, (1 << 16) - 2
NUMERATOR, DENOMINATOR = 80, 100  # linked when DENOMINATOR * intersection >= NUMERATOR * union
#: Pairs whose estimate is below the bound by this much are not verified (more than 6 standard deviations).
SLACK = 0.25
ROUNDS = 2
COUNT_BITS = 20
#: Ids and buckets (8 bytes, pivots 24) are broadcast up to this count and joined by shuffle beyond, where
#: adaptive execution splits hot keys. A broadcast leaves the rows of a hot bucket where they are.
BROADCAST_IDS = 500_000


def shingle_sets(
    words: Words, data: np.ndarray, offsets: np.ndarray, n: int
) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each row of a block, sorted by row, and where each row begins."""
    rows = len(offsets) - 1
    start, end, row = words.spans(data, offsets)
    h = words.hashes(data, start, end)
    first = row_starts(row, rows)
    count = np.diff(first)
    long = np.flatnonzero(row[n - 1 :] == row[: len(row) - n + 1]) if len(row) >= n else np.zeros(0, np.int64)
    folded = np.zeros(len(long), dtype=np.uint64)
    for k in range(n):
        folded = (folded + h[long + k]) * np.uint64(0xD6E8FEB86659FD93) + np.uint64(n)
        folded ^= folded >> np.uint64(32)
    short_rows = np.flatnonzero((count > 0) & (count < n))
    short = np.zeros(len(short_rows), dtype=np.uint64)
    for j, r in enumerate(short_rows):
        value = int(count[r])
        for x in h[first[r] : first[r + 1]].tolist():
            value = (value * 0x2545F4914F6CDD1D + x) % (1 << 64)
        short[j] = value
    shingle = np.concatenate([folded, short])
    owner = np.concatenate([row[long], short_rows])
    order = np.argsort(shingle)
    order = order[np.argsort(owner[order].astype(np.uint16 if rows < 65536 else np.int64), kind="stable")]
    shingle, owner = shingle[order], owner[order]
    if len(shingle):
        new = np.concatenate(([True], (shingle[1:] != shingle[:-1]) | (owner[1:] != owner[:-1])))
        shingle, owner = shingle[new], owner[new]
    return shingle, row_starts(owner, rows)


def registers(shingle: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sketches of the rows that have shingles (rows x REGISTERS, uint16)."""
    odd = np.random.default_rng(20_240_601).integers(0, 1 << 63, (2, REGISTERS), dtype=np.uint64)
    full = starts[:-1][starts[:-1] < starts[1:]]
    minima = np.empty((REGISTERS, len(full)), dtype=np.uint64)
    for i in range(REGISTERS):
        spread = (shingle ^ odd[1, i]) * (odd[0, i] * np.uint64(2) + np.uint64(1))
        minima[i] = np.minimum.reduceat(spread, full) if len(full) else minima[i]
    h = -np.log1p(-np.minimum(minima.T.astype(np.float64) / 2.0**64, 1 - 2.0**-53)) / RATE
    return np.clip(np.floor(1 - np.log(np.maximum(h, 1e-300)) / np.log(BASE)), 0, LIMIT).astype(np.uint16)


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sketch of the union of two sets."""
    return np.maximum(a, b)


def likelihood_jaccard(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> np.ndarray:
    """Maximum-likelihood similarity of sketch rows, given both set sizes."""
    larger, smaller = (a > b).sum(axis=1), (a < b).sum(axis=1)
    equal = a.shape[1] - larger - smaller
    u = size_a / (size_a + size_b)
    v = 1 - u
    low, high = np.zeros(len(u)), np.minimum(u / v, v / u)

    def p(x: np.ndarray) -> np.ndarray:
        return -np.log1p(-np.maximum(x, 0) * (BASE - 1) / BASE) / np.log(BASE)

    def fit(j: np.ndarray) -> np.ndarray:
        p_a, p_b = p(u - v * j), p(v - u * j)
        tiny = 1e-12
        return (larger * np.log(p_a + tiny) + smaller * np.log(p_b + tiny)
                + equal * np.log(np.maximum(1 - p_a - p_b, tiny)))

    golden = (np.sqrt(5) - 1) / 2
    for _ in range(40):
        left, right = high - golden * (high - low), low + golden * (high - low)
        up = fit(left) < fit(right)
        low, high = np.where(up, left, low), np.where(up, high, right)
    return (low + high) / 2


def sketches(docs: DataFrame, n: int) -> DataFrame:
    """(doc_id, k1, k2, n_shingles, reg): two hashes that name the set, its size and its sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words(space_words)
        for batch in batches:
            for lo, hi, data, offsets in text_blocks(batch.column(1)):
                shingle, starts = shingle_sets(words, data, offsets, n)
                size = np.diff(starts)
                full = size > 0
                keys = np.zeros((2, hi - lo), dtype=np.uint64)
                for k, factor in enumerate((0x9FB21C651E98DF25, 0xA0761D6478BD642F)):
                    spread = shingle * np.uint64(factor)
                    spread ^= spread >> np.uint64(33)
                    if full.any():
                        keys[k, full] = np.add.reduceat(spread * np.uint64(0xE7037ED1A0B428DB), starts[:-1][full])
                regs = registers(shingle, starts)
                reg = np.full(hi - lo, None, dtype=object)
                reg[full] = [r.tobytes() for r in regs]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(lo, hi - lo),
                        *[pa.array(k.view(np.int64)) for k in keys],
                        pa.array(size.astype(np.int64)),
                        pa.array(reg, pa.binary()),
                    ],
                    ["doc_id", "k1", "k2", "n_shingles", "reg"],
                )

    schema = "doc_id long, k1 long, k2 long, n_shingles long, reg binary"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text")).mapInArrow(run, schema)


def _promising(pairs: DataFrame, nodes: DataFrame, bound: float) -> DataFrame:
    """Pairs whose likelihood estimate is not far below the bound."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (
                np.frombuffer(b"".join(batch.column(c).to_pylist()), dtype=np.uint16).reshape(-1, REGISTERS)
                for c in ("reg_a", "reg_b")
            )
            sizes = (batch.column(c).to_numpy().astype(float) for c in ("n_a", "n_b"))
            good = pa.array(likelihood_jaccard(a, b, *sizes) >= bound - SLACK)
            yield batch.select(["a", "b"]).filter(good)

    side = lambda s: nodes.select(F.col("node").alias(s), F.col("n_shingles").alias(f"n_{s}"), F.col("reg").alias(f"reg_{s}"))  # noqa: E731,E501
    # a set cannot be that much larger than one it is linked with
    near = (DENOMINATOR * F.least("n_a", "n_b")) >= (NUMERATOR * F.greatest("n_a", "n_b"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").where(near)
    return both.mapInArrow(run, "a long, b long")


def _verified(pairs: DataFrame, texts: DataFrame, n: int) -> DataFrame:
    """Pairs that are linked on their full shingle sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words(space_words)
        for batch in batches:
            keep = np.zeros(batch.num_rows, dtype=bool)
            sets: list[list[np.ndarray]] = [[], []]
            done = 0
            for c in (0, 1):
                for _, _, data, offsets in text_blocks(batch.column(2 + c)):
                    shingle, starts = shingle_sets(words, data, offsets, n)
                    sets[c] += [shingle[i:j] for i, j in zip(starts[:-1], starts[1:])]
            for x, y in zip(*sets):
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep[done] = common > 0 and DENOMINATOR * common >= NUMERATOR * (len(x) + len(y) - common)
                done += 1
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    side = lambda s: texts.select(F.col("node").alias(s), F.col("text").alias(f"text_{s}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "text_a", "text_b")
    return both.mapInArrow(run, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node reachable, for every node of the edges (a, b)."""

    def signature(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).head())

    now = kept_table(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    while (state := signature(now)) != before:
        before = state
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        # large star: larger neighbours of a node go to the smallest node around it
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = kept_table(large.where("a <> b").distinct(), "edges")
        # small star: the node and its smaller neighbours go to the smallest of them
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b"))
        now = kept_table(small.where("a <> b").distinct(), "edges")
    return now.select(F.col("a").alias("node"), F.col("b").alias("label"))


def _relabelled(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` (node, label) joined along the links (a, b) between labels."""
    found = components(links).select(F.col("node").alias("label"), F.col("label").alias("_to"))
    moved = labels.join(found, "label", "left")
    return kept_table(moved.select("node", F.coalesce("_to", "label").alias("label")), "labels")


def _sized(df: DataFrame, name: str) -> DataFrame:
    """A stored table, marked for broadcast if it is small enough."""
    stored = kept_table(df, name)
    return F.broadcast(stored) if stored.count() <= BROADCAST_IDS else stored


def _still_open(members: DataFrame, labels: DataFrame) -> DataFrame:
    """(bucket, node, label) of the buckets whose nodes have different labels."""
    named = members.select("bucket", "node").join(labels, "node")
    span = named.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high"))
    buckets = _sized(span.where("low <> high").select("bucket"), "buckets")
    return kept_table(named.join(buckets, "bucket"), "members")


def _round_pairs(members: DataFrame, turn: int) -> DataFrame:
    """Distinct pairs between each bucket's pivot and its nodes of another label."""
    if turn == 0:
        shares = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("_n"))
        weight = members.join(shares, "bucket").groupBy("node").agg(F.sum("_n").alias("_w"))
        members, order = members.join(weight, "node"), F.struct("_w", F.xxhash64("node"))
    else:
        order = F.xxhash64("node", F.lit(turn))
    pivots = members.groupBy("bucket").agg(F.max_by(F.struct("node", "label"), order).alias("pivot"))
    pairs = members.join(_sized(pivots, "pivots"), "bucket").where("label <> pivot.label")
    pairs = pairs.withColumn("_p", F.col("pivot.node"))
    return pairs.select(F.least("node", "_p").alias("a"), F.greatest("node", "_p").alias("b"))


def _shingle_counts(texts: DataFrame, n: int) -> np.ndarray:
    """Counts of shingles, hashed into a table of fixed size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, total = Words(space_words), np.zeros(1 << COUNT_BITS, dtype=np.int64)
        for batch in batches:
            for _, _, data, offsets in text_blocks(batch.column(0)):
                shingle, _ = shingle_sets(words, data, offsets, n)
                total += np.bincount((shingle >> np.uint64(64 - COUNT_BITS)).astype(np.int64), minlength=len(total))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["cell", "k"])

    parts = texts.select("text").mapInArrow(run, "cell long, k long").groupBy("cell").agg(F.sum("k").alias("k")).toArrow()
    total = np.zeros(1 << COUNT_BITS, dtype=np.int64)
    total[parts.column("cell").to_numpy()] = parts.column("k").to_numpy()
    return total


def _rest_pairs(members: DataFrame, texts: DataFrame, n: int) -> DataFrame:
    """Pairs of different labels from open buckets that a prefix filter with places can not rule out."""
    open_ = members.select("node", "label").distinct()
    held = kept_table(texts.join(open_, "node").select("node", "label", "text"), "open-texts")
    shared = share(members.sparkSession, _shingle_counts(held, n))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, counts = Words(space_words), shared_model(shared)
        for batch in batches:
            for lo, hi, data, offsets in text_blocks(batch.column(2)):
                shingle, starts = shingle_sets(words, data, offsets, n)
                size = np.diff(starts)
                row = np.repeat(np.arange(hi - lo), size)
                order = np.lexsort((shingle, counts[(shingle >> np.uint64(64 - COUNT_BITS)).astype(np.int64)], row))
                place = np.arange(len(row)) - starts[row]
                length = size - (NUMERATOR * size + DENOMINATOR - 1) // DENOMINATOR + 1
                front = place < length[row]
                owner = pa.array(row[front])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(shingle[order][front].view(np.int64)),
                        *[batch.column(c).slice(lo, hi - lo).take(owner) for c in (0, 1)],
                        pa.array(size[row[front]].astype(np.int32)),
                        pa.array(place[front].astype(np.int32)),
                    ],
                    ["h", "node", "label", "n", "place"],
                )

    fronts = kept_table(held.mapInArrow(run, "h long, node long, label long, n int, place int"), "fronts")
    more = fronts.groupBy("h").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high")
    fronts = fronts.join(more.select("h"), "h", "left_semi")
    left, right = fronts.alias("x"), fronts.alias("y")
    total = F.col("x.n") + F.col("y.n")
    # if this is the first common shingle, what follows (itself included) bounds the intersection
    most = F.least(F.col("x.n") - F.col("x.place"), F.col("y.n") - F.col("y.place"))
    pairs = left.join(
        right,
        (F.col("x.h") == F.col("y.h"))
        & (F.col("x.label") < F.col("y.label"))
        & ((NUMERATOR + DENOMINATOR) * most >= NUMERATOR * total),
    )
    return pairs.select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b"))


def near_duplicates(docs: DataFrame, n: int = 5) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept, k1, k2): one row per input row."""
    sketched = kept_table(sketches(docs, n), "sketches")
    sets = sketched.where("n_shingles > 0 AND doc_id IS NOT NULL")
    first = sets.groupBy("k1", "k2", "n_shingles").agg(F.min("doc_id").alias("node"))
    copies = kept_table(first, "copies")
    same = (F.col("doc_id") == F.col("node")) & (F.col("_1") == F.col("k1")) & (F.col("_2") == F.col("k2"))
    narrow = sets.select("doc_id", F.col("k1").alias("_1"), F.col("k2").alias("_2"), "reg")
    own = narrow.join(copies, same).select("node", "n_shingles", "reg").distinct()
    nodes = kept_table(own, "nodes")
    width = 2 * BAND
    band = F.transform(
        F.sequence(F.lit(0), F.lit(REGISTERS // BAND - 1)),
        lambda i: F.xxhash64(i, F.substring("reg", i * width + 1, F.lit(width))),
    )
    banded = nodes.select("node", F.explode(band).alias("bucket")).distinct()
    shared = banded.groupBy("bucket").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("bucket")
    members = banded.join(_sized(shared, "buckets"), "bucket").select("bucket", "node", F.col("node").alias("label"))
    members = kept_table(members, "members")
    ids = kept_table(members.select("node").distinct(), "candidates")
    known = docs.select(F.col("doc_id").cast("long").alias("node"), "text")
    side = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
    texts = kept_table(known.join(side, "node"), "texts")
    labels = kept_table(ids.select("node", F.col("node").alias("label")), "labels")
    tested = None
    for turn in range(ROUNDS + 1):
        if turn:
            members = _still_open(members, labels)
            if members.isEmpty():
                break
        drawn = (_round_pairs(members, turn) if turn < ROUNDS else _rest_pairs(members, texts, n)).distinct()
        if tested is not None:
            drawn = drawn.join(tested, ["a", "b"], "left_anti")
        drawn = kept_table(drawn, "pairs")
        tested = drawn if tested is None else tested.union(drawn)
        hopeful = kept_table(_promising(drawn, nodes, NUMERATOR / DENOMINATOR), "promising")
        links = kept_table(_verified(hopeful, texts, n), "links")
        end = lambda s: labels.select(F.col("node").alias(s), F.col("label").alias(f"_{s}"))
        between = links.join(end("a"), "a").join(end("b"), "b").where("_a <> _b")
        labels = _relabelled(labels, between.select(F.col("_a").alias("a"), F.col("_b").alias("b")))
    final = labels.where("node <> label")
    named = copies.join(final, "node", "left").select(
        "k1", "k2", F.col("n_shingles"), F.coalesce("label", "node").alias("_c")
    )
    named = kept_table(named, "components")
    joined = sketched.drop("reg").join(named, ["k1", "k2", "n_shingles"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("_c", "doc_id"))
    out = joined.select("doc_id", "n_shingles", component.alias("component_id"), "k1", "k2")
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def deduplicate(docs: DataFrame, n: int = 5) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id. Columns unchanged.

    Of several rows with the chosen id the one whose text has the smallest SHA-256 stays (a null text comes last),
    among equal texts the one whose other columns come first as JSON.
    """
    rows = near_duplicates(docs, n).where("doc_id IS NOT NULL")
    ids = kept_table(rows.groupBy("doc_id").agg(F.max("kept").alias("kept"), F.count(F.lit(1)).alias("n")), "kept")
    own, whole = unused(docs, "__id", "__row")
    same = docs["doc_id"].cast("long") == F.col(own)

    def listed(condition: str) -> DataFrame:
        chosen = ids.where(condition).select(F.col("doc_id").alias(own))
        return F.broadcast(chosen) if chosen.count() <= BROADCAST_IDS else chosen

    # ids that go, or that occur again, are fewer than those that stay
    single = docs.join(listed("NOT kept OR n > 1"), same, "left_anti")
    repeated = docs.join(listed("kept AND n > 1"), same, "left_semi")
    others = [c for c in docs.columns if c != "text"]
    order = F.struct(F.coalesce(F.sha2("text", 256), F.lit("~")), F.to_json(F.struct(*others)))
    row = F.struct(*docs.columns)
    one = repeated.groupBy(F.col("doc_id").alias(own)).agg(F.min_by(row, order).alias(whole)).select(f"{whole}.*")
    return single.unionByName(one)


def op6_near_duplicates(spark, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"), 4)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


OP6_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x20\x09-\x0D]+') AS w
  FROM documents),
s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN []
           WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
           ELSE [array_to_string(w[i:i + 3], ' ') FOR i IN range(1, len(w) - 2)] END) AS g
  FROM d),
e AS (SELECT doc_id, len(g) AS n, unnest(g) AS g FROM s),
rep AS (  -- one document for each distinct set
  SELECT min(doc_id) AS r, list(doc_id) AS ids, any_value(len(g)) AS n, any_value(g) AS g
  FROM s WHERE len(g) > 0 GROUP BY list_sort(g)),
re AS (SELECT r, n, unnest(g) AS g FROM rep),
link AS (
  SELECT a.r AS a, b.r AS b FROM re a JOIN re b ON a.g = b.g AND a.r < b.r
  GROUP BY a.r, b.r, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
both_ways AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach AS (
  SELECT r AS v, r AS c FROM rep
  UNION
  SELECT b, reach.c FROM reach JOIN both_ways ON reach.v = both_ways.a WHERE reach.c < b),
comp AS (SELECT v, min(c) AS c FROM reach GROUP BY v),
named AS (SELECT unnest(ids) AS doc_id, c FROM rep JOIN comp ON r = v)
SELECT s.doc_id, len(g)::BIGINT AS n_shingles, coalesce(c, s.doc_id) AS component_id,
       coalesce(c, s.doc_id) = s.doc_id AS kept
FROM s LEFT JOIN named USING (doc_id)
"""
