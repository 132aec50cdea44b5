"""Shared helpers: byte blocks of texts, word spans and hashes, splits by hash, shared tables."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabularium.session import new_folder

BLOCK_BYTES = 1 << 18
HASH_BITS = 1 << 27
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def remainder(column: str, n: int) -> Column:
    """crc32 of the column as text, modulo ``n``; a null counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))) % n


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, with underscores in front until ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        out.append(name)
    return out


def kept_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared folder and read it back: cut lineage, known size."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _short_hash(h: str) -> Column:
    return F.pmod(F.xxhash64(h), F.lit(HASH_BITS))


def hash_bitmap(df: DataFrame, h: str) -> DataFrame:
    """(bucket, bits): the values of ``h`` as a bitmap of ``HASH_BITS`` bits, that is 16 MB at most at any size."""
    place = _short_hash(h)
    each = df.select(F.bitmap_bucket_number(place).alias("bucket"), F.bitmap_bit_position(place).alias("place"))
    return kept_table(each.groupBy("bucket").agg(F.bitmap_construct_agg("place").alias("bits")), "hashes")


def through_bitmap(df: DataFrame, h: str, bitmap: DataFrame) -> DataFrame:
    """Rows of ``df`` whose ``h`` is in the (broadcast) bitmap; a few others may pass, none is missed."""
    at = F.bitmap_bit_position(_short_hash(h))
    byte = F.conv(F.hex(F.substring("bits", (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("long")
    joined = df.join(F.broadcast(bitmap), F.bitmap_bucket_number(_short_hash(h)) == F.col("bucket"))
    return joined.where(F.getbit(byte, (at % 8).cast("int")) == 1).drop("bucket", "bits")


def smallest_hashes(df: DataFrame, h: str, k: int) -> DataFrame:
    """At least the ``k`` rows with the smallest ``h``, and at most one of 65,536 hash ranges more.

    The range comes from a histogram, so nothing is sorted in one task.
    """
    place = F.shiftright(h, 48)
    counted = df.groupBy(place.alias("at")).agg(F.count(F.lit(1)).alias("n")).toArrow().sort_by("at")
    total = np.cumsum(counted.column("n").to_numpy())
    i = int(np.searchsorted(total, k))
    return df if i >= len(total) else df.where(place <= int(counted.column("at")[i].as_py()))


def share(spark: SparkSession, model: object) -> Broadcast:
    """Broadcast a model with its class, so that executors need no installed copy of this package."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(model))


def shared_model(shared: Broadcast):
    """The model in a task; called once per task."""
    return pickle.loads(shared.value)


def space_words(data: np.ndarray) -> np.ndarray:
    """True for bytes of words between space and \\x09-\\x0D."""
    return ~((data == 32) | ((data - np.uint8(9)) < np.uint8(5)))


def line_words(data: np.ndarray) -> np.ndarray:
    """True for bytes of lines."""
    return (data != 10) & (data != 13)


def lowered(data: np.ndarray) -> np.ndarray:
    """Bytes with A-Z lower-cased, all others as they are."""
    return data + (((data - np.uint8(65)) < np.uint8(26)).view(np.uint8) << np.uint8(5))


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and offsets of a string column; nulls are empty texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    filled = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = filled.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[filled.offset : filled.offset + len(filled) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw, at


def text_blocks(
    column: pa.Array, limit: int = BLOCK_BYTES
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows with about ``limit`` bytes of text: (first, end, bytes, offsets from 0)."""
    raw, at = text_buffers(column)
    n, first = len(at) - 1, 0
    while first < n:
        end = int(np.searchsorted(at, at[first] + limit, side="right")) - 1
        end = min(max(end, first + 1), n)
        yield first, end, raw[at[first] : at[end]], at[first : end + 1] - at[first]
        first = end


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


class Words:
    """Finds and hashes the (lower-cased) words of byte blocks; made once per task."""

    def __init__(self, inside: Callable[[np.ndarray], np.ndarray]):
        self.inside = inside
        self.factor = 0x5851F42D4C957F2D
        self.inverse = pow(self.factor, -1, 1 << 64)
        self.powers = self.inverses = np.ones(1, dtype=np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.powers) < n:
            for name, base in (("powers", self.factor), ("inverses", self.inverse)):
                steps = np.full(n, base, dtype=np.uint64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))

    def spans(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start and end of every word and the row it stands in; rows are never joined."""
        if not len(data):
            none = np.zeros(0, dtype=np.int64)
            return none, none, none
        word = self.inside(data)
        begins, ends = word.copy(), word.copy()
        begins[1:] &= ~word[:-1]
        ends[:-1] &= ~word[1:]
        full = offsets[:-1] < offsets[1:]
        first, last = offsets[:-1][full], offsets[1:][full] - 1
        begins[first] = word[first]
        ends[last] = word[last]
        start = np.flatnonzero(begins)
        row = np.searchsorted(offsets, start, side="right") - 1
        return start, np.flatnonzero(ends) + 1, row

    def hashes(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """A 64-bit hash of each span, equal for equal (lower-cased) words."""
        self._grow(len(data) + 1)
        total = np.zeros(len(data) + 1, dtype=np.uint64)
        values = lowered(data).astype(np.uint64)
        values += np.uint64(1)
        values *= self.powers[: len(data)]
        np.cumsum(values, out=total[1:])
        return mixed((total[end] - total[start]) * self.inverses[start])


def row_starts(row: np.ndarray, n_rows: int) -> np.ndarray:
    """Where the items of each row begin in ``row`` (sorted), with the end as the last entry."""
    return np.searchsorted(row, np.arange(n_rows + 1))


def row_sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sum of the values of each row; rows without values get 0."""
    out = np.zeros(len(starts) - 1, dtype=np.float64)
    full = starts[:-1] < starts[1:]
    if full.any():
        out[full] = np.add.reduceat(values, starts[:-1][full])
    return out
