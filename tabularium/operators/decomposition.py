"""Singular value decomposition with left vectors, for tall tables and for wide ones.

A tall table (few columns) is reduced by tall-skinny QR: every task keeps one triangular factor, factors
are merged in groups of ``FAN`` until a few are left. A wide table is first projected on a few
random directions; the decomposition of that range, refined by passes over the rows, stands for the table.
The driver sees matrices of ``columns * directions`` numbers; rows and left vectors stay tables.

Rows without an array, or with a NULL in it, take no part. Signs are those that make the largest
component of each right vector positive.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabularium.session import discard, stored

FAN = 16


def _complete(df: DataFrame, column: str) -> DataFrame:
    values = F.col(column).cast("array<double>")
    return df.withColumn(column, values).where(F.col(column).isNotNull() & F.forall(column, lambda x: x.isNotNull()))


def _matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten(), dtype=float).reshape(len(column), -1)


def _unpacked(column: pa.Array, width: int) -> list[np.ndarray]:
    return [np.frombuffer(value.as_buffer()).reshape(-1, width) for value in column]


def triangular_factor(df: DataFrame, column: str, right: np.ndarray | None = None, packed: int | None = None) -> np.ndarray:
    """R of the QR decomposition of the rows (times ``right``, if given), by tree reduction.

    ``packed``: every value of ``column`` is a binary with the doubles of many rows of that width.
    """

    def factor(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = None
        for batch in batches:
            values = batch.column(0)
            for x in [_matrix(values)] if packed is None and batch.num_rows else [] if packed is None else _unpacked(values, packed):
                x = x if right is None else x @ right
                r = np.linalg.qr(x if r is None else np.vstack([r, x]), mode="r")
        if r is not None:
            part = pa.array([TaskContext.get().partitionId()], pa.int64())
            yield pa.RecordBatch.from_arrays([part, pa.array([r.tobytes()], pa.binary())], ["part", "r"])

    picked = _complete(df, column).select(column) if packed is None else df.select(column)
    first = picked.first() if packed is None else [range(packed)]
    width = right.shape[1] if right is not None else len(first[0]) if first else 0

    def joined(parts) -> np.ndarray:
        return np.linalg.qr(np.vstack([np.frombuffer(raw).reshape(-1, width) for raw in parts]), mode="r")

    def merged(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"part": [int(pdf["part"].iloc[0]) // FAN], "r": [joined(pdf["r"]).tobytes()]})

    level = stored(picked.mapInArrow(factor, "part long, r binary"))
    while level.count() > FAN:
        groups = level.groupBy(F.floor(F.col("part") / FAN).alias("to"))
        level = stored(groups.applyInPandas(merged, "part long, r binary"))
    found = [row["r"] for row in level.orderBy("part").collect()]
    discard(level)
    return joined(found) if found else np.zeros((0, width))


def _signed(right: np.ndarray) -> np.ndarray:
    largest = right[np.abs(right).argmax(axis=0), np.arange(right.shape[1])]
    return right * np.where(largest < 0, -1.0, 1.0)


def tall_svd(df: DataFrame, column: str, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest singular values and right vectors (as columns) of a table with few columns."""
    r = triangular_factor(df, column)
    if not r.size:
        return np.zeros(0), np.zeros((r.shape[1], 0))
    _, values, right = np.linalg.svd(r)
    k = min(k, len(values))
    return values[:k], _signed(right[:k].T)


def _products(df: DataFrame, column: str, left: np.ndarray, width: int) -> np.ndarray:
    """Sum over rows of ``(row @ left)' row``: one partial matrix per task, added up cell by cell."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((left.shape[1], width))
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column(0))
                total += (x @ left).T @ x
        i, j = np.indices(total.shape)
        cells = [pa.array(v.ravel()) for v in (i, j, total)]
        yield pa.RecordBatch.from_arrays(cells, ["i", "j", "v"])

    cells = _complete(df, column).select(column).mapInArrow(partial, "i long, j long, v double")
    got = cells.groupBy("i", "j").agg(F.sum("v").alias("v")).toArrow()
    out = np.zeros((left.shape[1], width))
    out[got.column("i").to_numpy(), got.column("j").to_numpy()] = got.column("v").to_numpy()
    return out


def wide_svd(
    df: DataFrame, column: str, width: int, k: int, more: int = 8, passes: int = 2, seed: int = 0
) -> tuple[np.ndarray, np.ndarray]:
    """Approximate ``tall_svd`` for many columns: a randomised range of ``k + more`` directions, refined ``passes`` times."""
    directions = min(k + more, width)
    tested = np.random.default_rng(seed).standard_normal((width, directions))
    for turn in range(passes + 1):
        r = triangular_factor(df, column, tested)
        _, size, turned = np.linalg.svd(r)
        good = size > 1e-12 * max(size.max(initial=0.0), 1e-300)
        basis = tested @ (turned[: len(size)].T[:, good] / size[good])  # rows @ basis has orthonormal columns
        small = _products(df, column, basis, width)
        _, values, right = np.linalg.svd(small, full_matrices=False)
        if turn < passes:
            tested = right.T
    k = min(k, len(values))
    return values[:k], _signed(right[:k].T)


def left_vectors(df: DataFrame, column: str, values: np.ndarray, right: np.ndarray, name: str = "u") -> DataFrame:
    """The row's component along each singular direction, divided by its singular value; 0 where that is 0."""
    scale = np.divide(1.0, values, out=np.zeros_like(values), where=values > 1e-12 * max(values.max(initial=0.0), 1e-300))
    turned = right * scale

    @F.pandas_udf("array<double>")
    def project(rows: pd.Series) -> pd.Series:
        return pd.Series(list(np.stack(rows.to_numpy()).astype(float) @ turned)) if len(rows) else rows

    return _complete(df, column).withColumn(name, project(column))


def rebuilt(df: DataFrame, u: str, values: np.ndarray, right: np.ndarray, name: str = "approx") -> DataFrame:
    """Each row from its left vector: the best approximation of that rank."""
    back = (right * values).T

    @F.pandas_udf("array<double>")
    def expand(rows: pd.Series) -> pd.Series:
        return pd.Series(list(np.stack(rows.to_numpy()) @ back)) if len(rows) else rows

    return df.withColumn(name, expand(u))
