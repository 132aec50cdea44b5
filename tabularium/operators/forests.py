"""A regression forest for tables of any length, grown level by level.

Every feature is cut into at most ``BINS`` bins. The rows are packed once into blocks of bin numbers; each level is then
one job over all blocks: tasks add up weights and labels per (node, feature, bin) for the nodes of all trees, a shuffle
by node adds the tasks' sums and picks the splits, and the driver appends the new nodes to the trees. Bootstrap weights
are drawn anew in each level from the block's and the tree's number, so no list of weights per row is kept.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.linalg import DenseVector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabularium.session import stored

BINS = 32
#: Rows of a block, and block rows that one file holds.
BLOCK, FILE = 1 << 16, 1 << 22
#: Distinct values up to which a feature's values are counted; above, its cut points are quantiles.
FEW = 1_000
#: Nodes whose sums travel in one row, and bytes of sums a task holds at once.
SHARE, SUMS = 32, 1 << 27
LEAF = 255
#: Bin numbers of a block, and the bits for a place among them.
CELLS, OFFSETS = 1 << 22, (1 << 24) - 1

#: Poisson(1) weights by 16 random bits; where the bits hold a step of the distribution, more bits decide.
_STEPS = np.cumsum([math.exp(-1) / math.factorial(i) for i in range(19)])
_LOW = np.searchsorted(_STEPS, np.arange(65536) / 65536, side="right")
_HIGH = np.searchsorted(_STEPS, np.arange(1, 65537) / 65536, side="left")
_WEIGHTS = np.where(_LOW == _HIGH, _LOW, 255).astype(np.uint8)


def bootstrap(size: int, *key: int) -> np.ndarray:
    """How often each of ``size`` rows is drawn: Poisson(1), the same for the same key."""
    draw = np.random.Generator(np.random.SFC64(list(key)))
    bits = draw.bit_generator.random_raw((size + 3) // 4).view(np.uint16)[:size]
    weights = _WEIGHTS.take(bits)
    open_ = np.flatnonzero(weights == 255)
    weights[open_] = np.searchsorted(_STEPS, (bits[open_] + draw.random(open_.size)) / 65536, side="right")
    return weights


def _strided(counts: list[tuple[float, float]], bins: int) -> list[float]:
    """Cut points between neighbouring values: all of them if they fit, else about equally many rows apart."""
    values, sizes = [v for v, _ in counts], [n for _, n in counts]
    between = [a / 2 + b / 2 for a, b in zip(values, values[1:])]
    if len(values) <= bins:
        return between
    stride = sum(sizes) / bins
    seen, aim, cuts = sizes[0], stride, []
    for cut, n in zip(between, sizes[1:]):
        if abs(seen - aim) < abs(seen + n - aim):
            cuts.append(cut)
            aim += stride
        seen += n
    return cuts


def cut_points(rows: DataFrame, columns: list[str], bins: int = BINS) -> list[np.ndarray]:
    """Per column at most ``bins - 1`` ascending cut points; a value up to and including a cut is left of it."""
    guess = rows.agg(*[F.approx_count_distinct(c).alias(c) for c in columns]).first()
    few = [c for c in columns if guess[c] <= FEW]
    many = [c for c in columns if guess[c] > FEW]
    found: dict[str, list] = {c: [] for c in columns}
    if few:
        cells = F.inline(F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).alias("v")) for c in few]))
        for r in rows.select(cells).groupBy("c", "v").count().orderBy("c", "v").collect():
            found[r["c"]].append((r["v"], r["count"]))
        found = {c: _strided(found[c], bins) for c in columns}
    if many:
        parts = [i / bins for i in range(1, bins)]
        found |= rows.agg(*[F.percentile_approx(c, parts, 10_000).alias(c) for c in many]).first().asDict()
    return [np.array(sorted({v for v in found[c] if math.isfinite(v)}), float) for c in columns]


def _binned(values: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    return np.searchsorted(cuts, values, side="left").astype(np.uint8)


def _packed(
    rows: DataFrame, columns: list[str], cuts: list[np.ndarray], mean: float, size: int, files: int
) -> DataFrame:
    """Blocks of up to ``size`` rows: bin numbers column by column, labels less their mean."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, bins, labels, waiting = TaskContext.get().partitionId() << 32, [], [], 0

        def blocks(least: int) -> Iterator[pa.RecordBatch]:
            nonlocal number, bins, labels, waiting
            b, y = np.concatenate(bins, axis=1), np.concatenate(labels)
            start = 0
            while waiting >= least:
                n = min(size, waiting)
                part = np.ascontiguousarray(b[:, start : start + n])
                raw = y[start : start + n].tobytes()
                yield pa.RecordBatch.from_pydict(
                    {"block": [number], "size": pa.array([n], pa.int32()), "bins": [part.tobytes()], "labels": [raw]}
                )
                number, start, waiting = number + 1, start + n, waiting - n
            bins, labels = [b[:, start:]], [y[start:]]

        for batch in batches:
            values = [batch.column(c).to_numpy(zero_copy_only=False) for c in columns]
            bins.append(np.stack([_binned(v, c) for v, c in zip(values, cuts)]))
            labels.append(batch.column("y").to_numpy(zero_copy_only=False) - mean)
            waiting += batch.num_rows
            if waiting >= size:
                yield from blocks(size)
        if waiting:
            yield from blocks(1)

    return stored(rows.mapInArrow(pack, "block long, size int, bins binary, labels binary").repartition(files))


@dataclass
class Forest:
    """Nodes of all trees as arrays; the first ones are the roots, the right child follows the left one.

    ``left`` of a leaf is the leaf itself. ``gain`` is what a split takes from the sum of squared errors.
    """

    features: list[str]
    cuts: list[np.ndarray]
    mean: float
    trees: int
    tree: np.ndarray
    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    gain: np.ndarray
    weight: np.ndarray
    total: np.ndarray
    depth: int = 0

    @classmethod
    def of_roots(cls, features: list[str], cuts: list[np.ndarray], mean: float, trees: int) -> Forest:
        none = np.zeros(trees)
        at = np.arange(trees, dtype=np.int32)
        return cls(
            features, cuts, mean, trees, at, np.zeros(trees, np.int32), np.full(trees, LEAF, np.uint8),
            at.copy(), none, none.copy(), none.copy(),
        )

    def split(self, nodes: np.ndarray, found: dict[str, np.ndarray]) -> np.ndarray:
        """Give ``nodes`` (by tree) the splits found for them; the new nodes, by tree."""
        self.weight[nodes], self.total[nodes] = found["weight"], found["total"]
        cut = found["feature"] >= 0
        parents, start = nodes[cut], len(self.left)
        fresh = np.arange(start, start + 2 * parents.size, dtype=np.int32)
        if parents.size:
            self.feature[parents], self.cut[parents] = found["feature"][cut], found["cut"][cut]
            self.gain[parents], self.left[parents] = found["gain"][cut], fresh[::2]
            lw, lt = found["left_weight"][cut], found["left_total"][cut]
            w = np.stack([lw, self.weight[parents] - lw], 1).ravel()
            t = np.stack([lt, self.total[parents] - lt], 1).ravel()
            self.tree = np.concatenate([self.tree, np.repeat(self.tree[parents], 2)])
            self.feature = np.concatenate([self.feature, np.zeros(fresh.size, np.int32)])
            self.cut = np.concatenate([self.cut, np.full(fresh.size, LEAF, np.uint8)])
            self.left = np.concatenate([self.left, fresh])
            self.gain = np.concatenate([self.gain, np.zeros(fresh.size)])
            self.weight, self.total = np.concatenate([self.weight, w]), np.concatenate([self.total, t])
            self.depth += 1
        return fresh

    @property
    def featureImportances(self) -> DenseVector:
        """Share of each feature in the gain of its tree, averaged over the trees."""
        p = len(self.features)
        inner = self.left != np.arange(self.left.size)
        gains = np.bincount(self.tree[inner] * p + self.feature[inner], self.gain[inner], self.trees * p)
        gains = gains.reshape(self.trees, p).astype(float)
        sums = gains.sum(axis=1, keepdims=True)
        shares = np.divide(gains, sums, out=np.zeros_like(gains), where=sums > 0).sum(axis=0)
        return DenseVector(shares / (shares.sum() or 1.0))

    def values(self) -> np.ndarray:
        """Mean label per node."""
        return self.mean + np.divide(self.total, self.weight, out=np.zeros_like(self.total), where=self.weight > 0)

    def transform(self, df: DataFrame, name: str = "prediction") -> DataFrame:
        """The mean over all trees; null where a feature is null or not a number."""
        cuts, trees, depth, values = self.cuts, self.trees, self.depth, self.values()
        nodes, most = (self.feature, self.cut, self.left), max(1, CELLS // len(cuts))

        @F.pandas_udf("double")
        def predict(rows: pd.DataFrame) -> pd.Series:
            whole, out = rows.to_numpy(float), np.zeros(len(rows))
            for start in range(0, len(rows), most):
                x = whole[start : start + most]
                flat = np.concatenate([_binned(x[:, i], c) for i, c in enumerate(cuts)])
                steps, index = _steps(*nodes, len(x)), np.arange(len(x))
                for t in range(trees):
                    out[start : start + most] += values.take(_walk(flat, steps, t, index, depth))
            return pd.Series(np.where(np.isnan(whole).any(axis=1), np.nan, out / trees))

        return df.withColumn(
            name, predict(F.struct(*[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(self.features)]))
        )

    def nodes(self, spark: SparkSession) -> DataFrame:
        """The node table: a leaf has no feature; rows up to and including the threshold go left."""
        inner = self.left != np.arange(self.left.size)
        columns = (self.tree, inner, self.feature, self.cut, self.left, self.gain, self.weight, self.values())
        rows = []
        for n, (t, split, f, c, to, g, w, v) in enumerate(zip(*[c.tolist() for c in columns])):
            test = (self.features[f], float(self.cuts[f][c]), to, to + 1) if split else (None,) * 4
            rows.append((t, n, *test, g, w, v))
        return spark.createDataFrame(
            rows,
            "tree int, node int, feature string, threshold double, left int, right int, gain double, weight double, "
            "value double",
        )


def _steps(feature: np.ndarray, cut: np.ndarray, left: np.ndarray, size: int) -> np.ndarray:
    """What a step reads of a node, in one number: left child, start of the feature's ``size`` bins, cut."""
    return (left.astype(np.int64) << 32) | (feature.astype(np.int64) * size << 8) | cut


def _walk(flat: np.ndarray, steps: np.ndarray, tree: int, index: np.ndarray, levels: int) -> np.ndarray:
    """The node that each row of ``index`` reaches from the root of the tree."""
    at = np.full(index.size, tree, np.int64)
    for _ in range(levels):
        step = steps.take(at)
        at = (step >> 32) + (flat.take((step >> 8 & OFFSETS) + index) > step.astype(np.uint8))
    return at


def _best_splits(
    blocks: DataFrame, forest: Forest, nodes: np.ndarray, picks: np.ndarray, level: int, bins: int, seed: int
) -> dict[str, np.ndarray]:
    """The best split of each of ``nodes`` among its picked features, from the sums of all blocks."""
    tables, k = (forest.feature, forest.cut, forest.left), picks.shape[1]
    place = np.full(forest.left.size, -1, np.int32)
    place[nodes] = np.arange(nodes.size, dtype=np.int32)
    trees, firsts = np.unique(forest.tree[nodes], return_index=True)
    ends = np.append(firsts[1:], nodes.size)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, places, slots = np.zeros((nodes.size, k, 2, bins)), place.astype(np.int64), picks.T.astype(np.int64)
        for batch in batches:
            for block, n, packed, raw in zip(*[batch.column(c) for c in ("block", "size", "bins", "labels")]):
                n = n.as_py()
                flat = np.frombuffer(packed.as_buffer(), np.uint8)
                labels = np.frombuffer(raw.as_buffer(), float)
                steps, picked = _steps(*tables, n), np.ascontiguousarray(slots * n)
                for t, first, end in zip(trees.tolist(), firsts.tolist(), ends.tolist()):
                    weights = bootstrap(n, seed, block.as_py(), t)
                    index = np.flatnonzero(weights > 0)
                    to = places.take(_walk(flat, steps, t, index, level))
                    if (to < 0).any():
                        index, to = index[to >= 0], to[to >= 0]
                    w = weights.take(index).astype(float)
                    y = w * labels.take(index)
                    base, cells = (to - first) * bins, (end - first) * bins
                    for j in range(k):
                        key = base + flat.take(picked[j].take(to) + index)
                        held[first:end, j, 0] += np.bincount(key, w, cells).reshape(-1, bins)
                        held[first:end, j, 1] += np.bincount(key, y, cells).reshape(-1, bins)
        source = TaskContext.get().partitionId()
        for start in range(0, nodes.size, SHARE):
            part = held[start : start + SHARE]
            if part.any():
                ids = [pa.array([i], pa.int32()) for i in (start // SHARE, source)]
                yield pa.RecordBatch.from_arrays([*ids, pa.array([part.tobytes()])], ["part", "source", "sums"])

    def best(frame: pd.DataFrame) -> pd.DataFrame:
        start = int(frame["part"].iloc[0]) * SHARE
        total = np.zeros((min(SHARE, nodes.size - start), k, 2, bins))
        for part in frame.sort_values("source")["sums"]:
            total += np.frombuffer(part, float).reshape(total.shape)
        w, y = total[:, :, 0], total[:, :, 1]
        lw, ly = w.cumsum(axis=2)[:, :, :-1], y.cumsum(axis=2)[:, :, :-1]
        aw, ay = w.sum(axis=2, keepdims=True), y.sum(axis=2, keepdims=True)
        rw, ry = aw - lw, ay - ly
        with np.errstate(divide="ignore", invalid="ignore"):
            parts = ly * ly / lw + ry * ry / rw
            gain = parts - ay * ay / aw
        # less than the rounding of the sums is no gain
        gain[~((lw > 0) & (rw > 0) & (gain > 1e-12 * parts))] = 0.0
        flat = gain.reshape(len(gain), -1)
        top, row = flat.argmax(axis=1), np.arange(len(gain))
        slot, at = top // gain.shape[2], top % gain.shape[2]
        gained = flat[row, top]
        return pd.DataFrame(
            {
                "place": start + row,
                "feature": np.where(gained > 0, picks[start + row, slot], -1),
                "cut": at,
                "gain": gained,
                "left_weight": lw[row, slot, at],
                "left_total": ly[row, slot, at],
                "weight": aw[row, slot, 0],
                "total": ay[row, slot, 0],
            }
        )

    schema = "place int, feature int, cut int, gain double, left_weight double, left_total double, weight double, total double"
    rows = (
        blocks.mapInArrow(sums, "part int, source int, sums binary")
        .groupBy("part")
        .applyInPandas(best, schema)
        .toArrow()  # a row per node
    )
    at = rows["place"].to_numpy()
    out = {}
    for c in rows.column_names[1:]:
        out[c] = np.full(nodes.size, -1) if c == "feature" else np.zeros(nodes.size, rows[c].to_numpy().dtype)
        out[c][at] = rows[c].to_numpy()
    return out


def fit(
    train: DataFrame, features: list[str], target: str, depth: int, trees: int, seed: int = 0, bins: int = BINS
) -> Forest:
    """``trees`` trees on bootstrap samples of all rows, square root of the features (rounded up) per split.

    Rows with a null or NaN feature are left out; a label that is null, NaN or infinite is an error, and so is a
    table without rows. Splits lower the squared error most; of equal ones the smaller feature and cut win. Trees
    repeat with the seed as long as the rows come in the same order.
    """
    columns = [f"x{i}" for i in range(len(features))]
    label = F.col(target).cast("double")
    bad = label.isNull() | F.isnan(label) | (F.abs(label) == float("inf"))
    whole = F.lit(True)
    for c in features:
        whole = whole & F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double"))
    rows = stored(
        train.filter(whole).select(
            *[F.col(f).cast("double").alias(c) for f, c in zip(features, columns)],
            F.when(bad, F.raise_error(F.lit("labels must not be null, NaN or infinite"))).otherwise(label).alias("y"),
        )
    )
    count, mean = rows.agg(F.count(F.lit(1)), F.avg("y")).first()
    if not count:
        raise ValueError("a forest needs at least one row")
    bins = max(2, min(bins, LEAF + 1, count))
    cuts = cut_points(rows, columns, bins)
    cores = train.sparkSession.sparkContext.defaultParallelism
    size = max(1, min(BLOCK, CELLS // len(features), max(1024, count // (4 * cores))))
    blocks = _packed(rows, columns, cuts, mean, size, max(cores, count // FILE))

    seed &= (1 << 63) - 1
    forest = Forest.of_roots(list(features), cuts, mean, trees)
    nodes, k = np.arange(trees, dtype=np.int32), math.ceil(math.sqrt(len(features)))
    each = max(1, SUMS // (k * 2 * bins * 8))
    draw = np.random.default_rng([seed, trees])
    for level in range(depth):
        found = []
        for i in range(0, nodes.size, each):
            part = nodes[i : i + each]
            picks = np.sort(draw.random((part.size, len(features))).argsort(axis=1)[:, :k], axis=1).astype(np.int32)
            found.append(_best_splits(blocks, forest, part, picks, level, bins, seed))
        nodes = forest.split(nodes, {c: np.concatenate([f[c] for f in found]) for c in found[0]})
        if not nodes.size:
            break
    return forest
