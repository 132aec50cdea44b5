"""Word vectors learnt from how often words occur near each other.

``word_pairs`` counts neighbours in one aggregation, ``affinity`` turns the counts into positive pointwise mutual
information, and ``factorise`` finds the leading eigenvectors of that symmetric table by subspace iteration.

Words are dealt to about ``1 / BLOCK`` as many parts by their number, so that frequent ones are spread evenly, and the table of
pairs is cut into blocks of one part by another. A block is one row of a DataFrame, its cells are packed (gaps between
the sorted places, and counts); between operators only packed blocks are shuffled and stored. A product gives a task the
cells of one part and, one by one, the vectors of every part: it holds the vectors of three parts
whatever the vocabulary, and nothing is shuffled. The vectors themselves stay with the executors, in memory or on their disk
where that is too small; the driver sees square matrices of ``size + more`` columns.

Texts that are NULL or empty have no words. Equal texts count as often as they occur. An empty table gives empty results.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabularium.operators.decomposition import triangular_factor
from tabularium.operators.text import WORDS, known_words, lookup_words, maybe_known, word_batches, word_groups
from tabularium.session import discard, stored

#: Words of a part, and the fewest parts if there are that many times 64 words.
BLOCK, LEAST = 4096, 12
#: Partial matrices added up at a time.
FAN = 32
#: Words whose vectors travel together.
HAND = 1024
#: Rows into which the pairs of a group of texts fall, at most about.
PIECES = 2048
#: Rows of a block multiplied together, and how many of them a column needs to be multiplied densely.
TILE, OFTEN = 256, 16
#: (bi, bj) of parts; places are row * wide + column inside a block, where word i has row i // parts and bi = i % parts.
PLACED = "bi int, bj int, parts int, wide long, many long, gaps binary, ns binary"
#: The same with sums of rows and columns, or without them and then with values instead of counts. With ``last`` the counts are
#: those of pairs as they were found, among them pairs with words beyond that number (``_kept``).
WEIGHED = PLACED + ", s binary, t binary, total double, last long"
VECTORS = "index long, vec array<double>"
_SPLIT = "spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"


@contextmanager
def _settings(spark: SparkSession, **conf: str):
    """Session settings (dots as ``__``) for as long as it takes."""
    names = {k.replace("__", "."): v for k, v in conf.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def tidy_stored(df: DataFrame) -> DataFrame:
    """``stored``; the shuffle files of the job are deleted at its end."""
    with _settings(df.sparkSession, spark__sql__classic__shuffleDependency__fileCleanup__enabled="true"):
        return stored(df)


def _squeeze(values: np.ndarray) -> bytes:
    """Whole numbers from 0 on, byte by byte of their own width, compressed."""
    width = max(1, (int(values.max(initial=0)).bit_length() + 7) // 8)
    planes = np.ascontiguousarray(values.astype("<i8").view(np.uint8).reshape(-1, 8)[:, :width].T)
    return bytes([width]) + pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def _spread(raw: bytes, many: int) -> np.ndarray:
    data = pa.decompress(raw[1:], decompressed_size=many * raw[0], codec="zstd", asbytes=True)
    planes = np.frombuffer(data, np.uint8).reshape(raw[0], many)
    out = planes[0].astype(np.int64)
    for k in range(1, raw[0]):
        out |= planes[k].astype(np.int64) << (8 * k)
    return out


def _places(raw: bytes, many: int) -> np.ndarray:
    return np.cumsum(_spread(raw, many))


def _packed(places: np.ndarray) -> bytes:
    return _squeeze(np.diff(places, prepend=0))


def _added(keys: np.ndarray, ns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the sum of the counts of each."""
    if not len(keys):
        return keys, ns
    shift = max(int(ns.max()).bit_length(), 1)
    if int(keys.max()).bit_length() + shift <= 62:  # one sort of numbers is faster than that of an order
        both = (keys << shift) | ns
        both.sort()
        keys, ns = both >> shift, both & ((1 << shift) - 1)
    else:
        order = np.argsort(keys, kind="stable")
        keys, ns = keys[order], ns[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return keys[first], np.add.reduceat(ns, first)


def _deal(known: int) -> tuple[int, int]:
    """Into how many parts the words 0 to ``known`` fall, and how many words a part has room for."""
    parts = max(1, min(max(-(-(known + 1) // BLOCK), LEAST), (known + 1) // 64))
    return parts, known // parts + 1


def _table(rows: list, names: list[str], schema: pa.Schema) -> pa.Table:
    return pa.Table.from_pydict({n: [r[k] for r in rows] for k, n in enumerate(names)}, schema=schema)


_KINDS = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "double": pa.float64()}


def _arrow(shape: str) -> pa.Schema:
    return pa.schema([(name, _KINDS[kind]) for name, kind in (x.split(" ") for x in shape.split(", "))])


def _frame(shape: str, rows: list) -> pa.Table:
    schema = _arrow(shape)
    return _table(rows, schema.names, schema)


def _batches(shape: str, rows: list) -> Iterator[pa.RecordBatch]:
    if rows:
        yield from _frame(shape, rows).to_batches()


def word_pairs(
    df: DataFrame, text: str = "text", window: int = 7, known: DataFrame | None = None, packed: bool = False
) -> DataFrame:
    """``(a, b, n)``: how often two words (``a <= b``) stand at most ``window`` words apart in a text.

    A task counts the pairs of groups of texts, one distance at a time; only these counts are shuffled.
    With ``known`` (a table of words), pairs with other words may be missing. With ``packed``, the pairs are those of
    known words, by their ``index`` (from 0 on) in ``known``, in blocks (``PLACED``) that ``affinity`` takes.
    """
    if packed:
        return _pair_blocks(df, text, window, known)
    shared = None if known is None else known_words(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for names, code, place in word_batches(batches):
            order = np.array(sorted(range(len(names)), key=lambda i: names[i].encode("utf-8")))
            rank = np.empty(len(names), np.int64)
            rank[order] = np.arange(len(names))
            held = np.ones(len(code), dtype=bool) if shared is None else maybe_known(shared, names)[code]
            code, many = rank[code], len(names)
            keys = []
            for gap in range(1, window + 1):
                same = np.flatnonzero((place[gap:] == place[:-gap]) & held[gap:] & held[:-gap])
                x, y = code[same], code[same + gap]
                keys.append(np.minimum(x, y) * many + np.maximum(x, y))
            key, n = np.unique(np.concatenate(keys), return_counts=True)
            word = pa.array([names[i] for i in order], pa.string())
            cells = [word.take(pa.array(key // many)), word.take(pa.array(key % many)), pa.array(n.astype(np.int64))]
            for lo in range(0, len(key), 1 << 16):
                yield pa.RecordBatch.from_arrays([c.slice(lo, 1 << 16) for c in cells], ["a", "b", "n"])

    parts = df.select(text).mapInArrow(run, "a string, b string, n long")
    return parts.groupBy("a", "b").agg(F.sum("n").alias("n"))


def _pair_blocks(df: DataFrame, text: str, window: int, known: DataFrame) -> DataFrame:
    parts, wide = _deal(int(known.agg(F.max("index")).first()[0] or 0))
    strips = max(1, min(parts, PIECES // parts))
    cut = [-(-k * parts // strips) for k in range(strips + 1)]  # columns of parts whose pairs travel together
    area = wide * wide
    shape = "bi int, strip int, many long, gaps binary, ns binary"

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId() << 32
        for k, (names, code, sizes) in enumerate(word_groups(batches, WORDS)):
            row = [pa.array([task + k]), pa.array([names], pa.list_(names.type)).cast(pa.list_(pa.string()))]
            row += [pa.array([x], pa.binary()) for x in (_squeeze(code), _squeeze(sizes))]
            many = [pa.array([len(x)], pa.int64()) for x in (code, sizes)]
            yield pa.RecordBatch.from_arrays([*row, *many], ["group", "words", "codes", "sizes", "places", "texts"])

    def counted(texts: pa.Table, found: pa.Table) -> pa.Table:
        if not texts.num_rows or not found.num_rows:
            return _frame(shape, [])
        row = {c: texts.column(c)[0].as_py() for c in texts.column_names}
        code, sizes = _spread(row["codes"], row["places"]), _spread(row["sizes"], row["texts"])
        pos, index = found.column("pos").to_numpy(), found.column("index").to_numpy()
        number = np.full(max(int(code.max()), int(pos.max())) + 1, -1)
        number[pos] = index
        number = number[code]
        place = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
        as_row = (number % parts) * (parts * area) + (number // parts) * wide  # a key is block * area + place
        as_column = (number % parts) * area + number // parts
        keys = []
        for gap in range(1, window + 1):
            x, y = number[:-gap], number[gap:]
            held = (place[gap:] == place[:-gap]) & (x >= 0) & (y >= 0)
            up = x <= y
            key = np.where(up, as_row[:-gap], as_row[gap:])
            key += np.where(up, as_column[gap:], as_column[:-gap])
            keys.append(key[held])
        key = np.concatenate(keys)
        del keys
        key.sort()
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, int)
        n, key = np.diff(np.r_[first, len(key)]), key[first]
        begin = np.array([bi * parts + c for bi in range(parts) for c in cut[:-1]]) * area
        bounds = np.r_[np.searchsorted(key, begin), len(key)]
        rows = []
        for k in np.flatnonzero(np.diff(bounds)).tolist():
            lo, hi = bounds[k], bounds[k + 1]
            rows.append((k // strips, k % strips, int(hi - lo), _packed(key[lo:hi] - begin[k]), _squeeze(n[lo:hi])))
        return _frame(shape, rows)

    def merged(pieces: pa.Table) -> pa.Table:
        bi, strip = (pieces.column(c)[0].as_py() for c in ("bi", "strip"))
        many = pieces.column("many").to_pylist()
        key = np.concatenate([_places(x.as_py(), m) for x, m in zip(pieces.column("gaps"), many)])
        key, n = _added(key, np.concatenate([_spread(x.as_py(), m) for x, m in zip(pieces.column("ns"), many)]))
        steps = np.arange(cut[strip + 1] - cut[strip] + 1)
        bounds = np.searchsorted(key, steps * area)
        rows = []
        for k in np.flatnonzero(np.diff(bounds)).tolist():
            lo, hi = bounds[k], bounds[k + 1]
            rows.append((bi, cut[strip] + k, parts, wide, int(hi - lo), _packed(key[lo:hi] - k * area), _squeeze(n[lo:hi])))
        return _frame(PLACED, rows)

    row = "group long, words array<string>, codes binary, sizes binary, places long, texts long"
    groups = tidy_stored(df.select(F.col(text).cast("string")).mapInArrow(numbered, row))
    found = lookup_words(groups.select(F.col("group").alias("of"), F.posexplode("words").alias("pos", "word")), known.select("word", "index"))
    texts = groups.select("group", "codes", "sizes", "places", "texts").groupBy("group")
    pieces = texts.cogroup(found.select("of", "pos", "index").groupBy("of")).applyInArrow(counted, shape)
    pairs = tidy_stored(pieces.groupBy("bi", "strip").applyInArrow(merged, PLACED))
    discard(groups)
    return pairs


def _blocks_of(cells: DataFrame, value: str, parts: int, wide: int) -> DataFrame:
    """Blocks of rows ``(i, j, value)``: whole numbers are counts, others values."""
    whole = dict(cells.dtypes)[value] == "bigint"

    def packed(rows: pa.Table) -> pa.Table:
        i, j, v = (rows.column(c).to_numpy() for c in ("i", "j", "v"))
        key = (i // parts) * wide + j // parts
        order = np.argsort(key, kind="stable")
        values = _squeeze(v[order]) if whole else v[order].tobytes()
        return _frame(PLACED, [(int(i[0] % parts), int(j[0] % parts), parts, wide, len(key), _packed(key[order]), values)])

    at = [(F.col(c) % parts).cast("int").alias(b) for c, b in (("i", "bi"), ("j", "bj"))]
    rows = cells.select("i", "j", F.col(value).alias("v"), *at)
    return rows.groupBy("bi", "bj").applyInArrow(packed, PLACED)


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    for k in range(batch.num_rows):
        yield {name: batch.column(c)[k].as_py() for c, name in enumerate(batch.schema.names)}


def affinity(
    pairs: DataFrame, vocab: DataFrame, min_count: int = 10, packed: bool = False, upper: bool = False
) -> DataFrame:
    """``(i, j, n, v)`` for words seen ``min_count`` times: both directions of every pair with a positive value.

    ``i`` and ``j`` are numbers of the vocabulary; ``v = ln(n * total / (n of i * n of j))``, where the sums
    run over the kept words. A word beside itself counts in both directions. ``pairs`` are rows or blocks of ``word_pairs``;
    blocks hold the numbers of ``vocab``, whose most frequent words come first. With ``upper`` only the direction ``i <= j``
    is given, with ``packed`` blocks (``WEIGHED``) of that direction, not yet without the others, which ``factorise`` takes.
    """
    known = vocab.where(F.col("n") >= min_count).select("word", "index")
    if "a" in pairs.columns:
        pairs, known = stored(pairs), stored(known)  # looked up twice, counted once
        left = lookup_words(pairs.withColumnRenamed("a", "word"), known).select("b", "n", F.col("index").alias("i"))
        both = lookup_words(left.withColumnRenamed("b", "word"), known)
        both = both.select(F.least("i", "index").alias("i"), F.greatest("i", "index").alias("j"), "n")
        last = int(known.agg(F.max("index")).first()[0] or 0)
        pairs = tidy_stored(_blocks_of(both.groupBy("i", "j").agg(F.sum("n").alias("n")), "n", *_deal(last)))
    else:
        last = int(known.agg(F.max("index")).first()[0] or 0)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _rows(batch):
                i, j, n = _kept(row | {"last": last})
                same = (i == j) & (row["bi"] == row["bj"])
                sums = [(row["bi"], i, n), (row["bj"], j, np.where(same, 0, n))]
                rows = []
                for part, at, m in sums:
                    s = np.zeros(row["wide"], np.int64)
                    np.add.at(s, at, m)
                    rows.append((part, row["wide"], _squeeze(s), int(s.sum())))
                yield from _batches(sides, rows)

    def together(pieces: pa.Table) -> pa.Table:
        wide = pieces.column("wide")[0].as_py()
        s = sum(_spread(x.as_py(), wide) for x in pieces.column("sums"))
        return _frame(sides, [(pieces.column("part")[0].as_py(), wide, _squeeze(s), int(s.sum()))])

    sides = "part int, wide long, sums binary, whole long"
    sums = tidy_stored(pairs.mapInArrow(summed, sides).groupBy("part").applyInArrow(together, sides))
    total = float(sums.agg(F.sum("whole")).first()[0] or 0)
    rows, columns = (sums.select(F.col("part").alias(b), F.col("sums").alias(s)) for b, s in (("bi", "s"), ("bj", "t")))
    names = [x.split(" ")[0] for x in WEIGHED.split(", ")]
    blocks = pairs.join(rows, "bi").join(columns, "bj")
    blocks = blocks.withColumn("total", F.lit(total)).withColumn("last", F.lit(last).cast("long")).select(*names)

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _rows(batch):
                i, j, n = _kept(row)
                v = _values(row, i, j, n)
                good = v > 0
                i, j = i[good] * row["parts"] + row["bi"], j[good] * row["parts"] + row["bj"]
                n, v = n[good], v[good]
                if upper:
                    cells = [np.minimum(i, j), np.maximum(i, j), n, v]
                else:
                    off = i != j
                    cells = [np.r_[i, j[off]], np.r_[j, i[off]], np.r_[n, n[off]], np.r_[v, v[off]]]
                for lo in range(0, len(cells[0]), 1 << 16):
                    yield pa.RecordBatch.from_arrays([pa.array(c[lo : lo + (1 << 16)]) for c in cells], ["i", "j", "n", "v"])

    return blocks if packed else blocks.mapInArrow(listed, "i long, j long, n long, v double")


def _kept(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows and columns inside a block, in order, and counts; with ``last`` a word beside itself counts twice, rarer words do not."""
    i, j = np.divmod(_places(row["gaps"], row["many"]), row["wide"])
    n = _spread(row["ns"], row["many"])
    if row["last"] is None:
        return i, j, n
    some = (i * row["parts"] + row["bi"] <= row["last"]) & (j * row["parts"] + row["bj"] <= row["last"])
    if not some.all():
        i, j, n = i[some], j[some], n[some]
    return i, j, np.where(i == j, 2 * n, n) if row["bi"] == row["bj"] else n


def _weighed(row: dict, key: np.ndarray, n: np.ndarray) -> tuple:
    same = [row[c] for c in ("s", "t", "total")]
    return (row["bi"], row["bj"], row["parts"], row["wide"], len(key), _packed(key), _squeeze(n), *same, None)


def _values(row: dict, i: np.ndarray, j: np.ndarray, n: np.ndarray) -> np.ndarray:
    """``v`` of counts in a block."""
    s, t = (_spread(row[c], row["wide"]).astype(float) for c in ("s", "t"))
    return np.log(n.astype(float) * row["total"] / (s[i] * t[j]))


def _cells(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows and columns inside the block, in order, and values of a row of ``WEIGHED``."""
    i, j = np.divmod(_places(row["gaps"], row["many"]), row["wide"])
    if row["total"] is None:
        return i, j, np.frombuffer(row["ns"])
    return i, j, _values(row, i, j, _spread(row["ns"], row["many"]))


def _both_sides(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of the direction ``i <= j`` -> those of both, without cells that are not positive."""
    for batch in batches:
        for row in _rows(batch):
            i, j, n = _kept(row)
            good = _values(row, i, j, n) > 0
            i, j, n = i[good], j[good], n[good]
            yield from _batches(WEIGHED, [_weighed(row, i * row["wide"] + j, n)])
            off = slice(None) if row["bi"] != row["bj"] else i != j
            i, j, n = j[off], i[off], n[off]
            key = i * row["wide"] + j
            order = np.argsort(key, kind="stable")
            turned = row | {"bi": row["bj"], "bj": row["bi"], "s": row["t"], "t": row["s"]}
            yield from _batches(WEIGHED, [_weighed(turned, key[order], n[order])])


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All rows of a block -> one, block by block; a task gets all blocks of its parts."""
    held: dict[tuple[int, int], list[dict]] = {}
    for batch in batches:
        for row in _rows(batch):
            if row["many"]:
                held.setdefault((row["bi"], row["bj"]), []).append(row)
    for at in sorted(held):
        rows = held.pop(at)
        if len(rows) == 1:
            yield from _batches(WEIGHED, [tuple(rows[0].values())])
        else:  # counts: the two directions of a block
            key = np.concatenate([_places(r["gaps"], r["many"]) for r in rows])
            yield from _batches(WEIGHED, [_weighed(rows[0], *_added(key, np.concatenate([_spread(r["ns"], r["many"]) for r in rows])))])


def _add_product(out: np.ndarray, i: np.ndarray, j: np.ndarray, v: np.ndarray, rows: np.ndarray) -> None:
    """Adds the table of cells (in the order of ``i``) times ``rows``: columns that are frequent in a tile as a dense matrix."""
    for start in range(0, len(out), TILE):
        lo, hi = np.searchsorted(i, [start, start + TILE])
        if lo == hi:
            continue
        ii, jj, vv = i[lo:hi] - start, j[lo:hi], v[lo:hi]
        often = np.bincount(jj, minlength=len(rows)) >= OFTEN
        columns = np.flatnonzero(often)
        if len(columns):
            dense = often[jj]
            tile = np.zeros((min(TILE, len(out) - start), len(columns)))
            tile[ii[dense], (np.cumsum(often) - 1)[jj[dense]]] = vv[dense]
            out[start : start + TILE] += tile @ rows[columns]
            ii, jj, vv = ii[~dense], jj[~dense], vv[~dense]
        first = np.flatnonzero(np.r_[True, ii[1:] != ii[:-1]]).tolist() if len(ii) else []
        for a, b in zip(first, [*first[1:], len(ii)]):
            out[start + ii[a]] += vv[a:b] @ rows[jj[a:b]]


#: Vectors of ``HAND`` words of a part, and which of them (by their row in the part) have cells.
PARTS = "part int, piece int, ids binary, vec binary"


def _pieces(part: int, ids: np.ndarray, rows: np.ndarray, hand: int) -> Iterator[pa.RecordBatch]:
    """The rows of ``PARTS`` for a part, without copies of its vectors."""
    for piece, first in enumerate(range(0, len(rows), hand)):
        data = np.ascontiguousarray(rows[first : first + hand])
        own = ids[(ids >= first) & (ids < first + hand)].astype(np.int64).tobytes()
        vec = pa.Array.from_buffers(pa.binary(), 1, [None, pa.py_buffer(np.array([0, data.nbytes], np.int32)), pa.py_buffer(data)])
        row = [pa.array([part], pa.int32()), pa.array([piece], pa.int32()), pa.array([own], pa.binary()), vec]
        yield pa.RecordBatch.from_arrays(row, ["part", "piece", "ids", "vec"])


def product(cells: DataFrame, vectors: DataFrame, wide: int, width: int, right: np.ndarray) -> DataFrame:
    """``PARTS``, kept by the executors: the table of ``cells`` times ``vectors`` (``PARTS`` of ``width`` columns) times ``right``.

    ``ids`` are the rows of a part that have cells. A task goes through all vectors with the cells of a part; where Spark
    gives the cells of a part to several tasks, their sums are added up.
    """

    hand = HAND

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, seen, held = {}, {}, {}
        for batch in batches:
            vec = batch.column(batch.schema.get_field_index("vec"))
            for k, row in enumerate(_rows(batch.drop_columns(["vec"]))):
                at = row["bi"], row["bj"]
                if at not in held:
                    held[at] = [np.empty((wide, width)), -(-wide // hand)]
                first = row["piece"] * hand
                held[at][0][first : first + hand] = np.frombuffer(vec[k].as_buffer()).reshape(-1, width)
                held[at][1] -= 1
                if not held[at][1]:  # all vectors of the part are here
                    if row["bi"] not in sums:
                        sums[row["bi"]], seen[row["bi"]] = np.zeros((wide, width)), np.zeros(wide, bool)
                    i, j, v = _cells(row)
                    seen[row["bi"]][i] = True
                    _add_product(sums[row["bi"]], i, j, v, held.pop(at)[0])
            del vec, batch
        for part in sorted(sums):
            yield from _pieces(part, np.flatnonzero(seen[part]), sums.pop(part) @ right, hand)

    def merged(pieces: pa.Table) -> pa.Table:
        ids = np.unique(np.concatenate([np.frombuffer(x.as_buffer(), np.int64) for x in pieces.column("ids")]))
        order = sorted(x.as_py() for x in pieces.column("vec"))  # the order of arrival does not show in the result
        vec = sum(np.frombuffer(x) for x in order)
        at = (pieces.column(c)[0].as_py() for c in ("part", "piece"))
        return _frame(PARTS, [(*at, ids.tobytes(), vec.tobytes())])

    # all vectors pass through each task one by one, what a task holds are the cells of its part
    sent = vectors.select(F.col("part").alias("at"), "piece", "vec").coalesce(1).hint("shuffle_replicate_nl")
    met = sent.join(cells, (F.col("bj") >= F.col("at")) & (F.col("bj") <= F.col("at"))).drop("at")
    out = met.mapInArrow(run, PARTS).persist(StorageLevel.MEMORY_AND_DISK_DESER)
    tasks = [tuple(r) for r in out.select("part", "piece").collect()]
    if len(tasks) == len(set(tasks)):
        return out
    return out.groupBy("part", "piece").applyInArrow(merged, PARTS).persist(StorageLevel.MEMORY_AND_DISK_DESER)


def _orthonormal(vectors: DataFrame, width: int) -> np.ndarray:
    """What ``vectors`` have to be multiplied with for orthonormal columns of the same span; directions without length are left out."""
    r = triangular_factor(vectors, "vec", packed=width)
    _, size, turned = np.linalg.svd(r)
    good = size > 1e-10 * max(size.max(initial=0.0), 1e-300)
    return turned[: len(size)].T[:, good] / size[good]


def _inner(left: DataFrame, right: DataFrame, width: int, other: int) -> np.ndarray:
    """Sum over words of the outer products of their two vectors: one partial matrix per task, added up ``FAN`` at a time."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, other))
        for batch in batches:
            for row in _rows(batch):
                a, b = np.frombuffer(row["vec"]).reshape(-1, width), np.frombuffer(row["other"]).reshape(-1, other)
                total += a.T @ b
        yield from _batches("part int, sum binary", [(TaskContext.get().partitionId(), total.tobytes())])

    def merged(pieces: pa.Table) -> pa.Table:
        found = sorted(zip(pieces.column("part").to_pylist(), pieces.column("sum").to_pylist()))
        return _frame("part int, sum binary", [(found[0][0] // FAN, sum(np.frombuffer(x) for _, x in found).tobytes())])

    sent = left.select(F.col("part").alias("at"), F.col("piece").alias("of"), "vec").coalesce(1).hint("shuffle_replicate_nl")
    there = right.select("part", "piece", F.col("vec").alias("other"))
    same = [(F.col(a) >= F.col(b)) & (F.col(a) <= F.col(b)) for a, b in (("part", "at"), ("piece", "of"))]
    both = sent.join(there, same[0] & same[1]).select("vec", "other")
    level = tidy_stored(both.mapInArrow(partial, "part int, sum binary"))
    while level.count() > FAN:
        groups = level.groupBy(F.floor(F.col("part") / FAN).alias("to"))
        level = tidy_stored(groups.applyInArrow(merged, "part int, sum binary"))
    found = sorted((row["part"], bytes(row["sum"])) for row in level.collect())
    discard(level)
    return sum((np.frombuffer(x).reshape(width, other) for _, x in found), np.zeros((width, other)))


def factorise(
    cells: DataFrame, size: int = 300, more: int = 20, passes: int = 6, seed: int = 0
) -> tuple[np.ndarray, DataFrame]:
    """Leading eigenvalues of the symmetric table ``cells`` and ``(index, vec)`` per word.

    ``cells`` are rows ``(i, j, v)`` or packed blocks of ``affinity``.
    Component ``c`` of a vector is the word's part of eigenvector ``c`` times the root of its
    eigenvalue, largest first, so inner products of vectors approximate the cells. At most ``size`` components, only
    those with a positive eigenvalue; signs make the largest sum of cubes positive. Words without a cell
    have no vector. ``passes`` products refine the random start.
    """
    spark = cells.sparkSession
    if "i" in cells.columns:
        cells = stored(cells.select("i", "j", "v"))
        nothing = [F.lit(None).cast(k).alias(c) for c, k in (("s", "binary"), ("t", "binary"), ("total", "double"), ("last", "long"))]
        blocks = _blocks_of(cells, "v", *_deal(int(cells.agg(F.max("i")).first()[0] or 0))).select("*", *nothing)
    else:
        blocks = cells.mapInArrow(_both_sides, WEIGHED)
    # a file, and so a partition, holds the blocks of a part; a batch is one block; what products are made of stays until the end
    single = {k.replace(".", "__"): v for k, v in zip(_SPLIT, ("1t", "1t"))} | {"spark__sql__execution__arrow__maxRecordsPerBatch": "1"}
    with _settings(spark, **single):
        return _factorised(blocks, size, more, passes, seed)


def _factorised(blocks: DataFrame, size: int, more: int, passes: int, seed: int) -> tuple[np.ndarray, DataFrame]:
    spark, made = blocks.sparkSession, tidy_stored(blocks)
    shape = made.agg(F.max("parts"), F.max("wide")).first()
    parts, wide = int(shape[0] or 1), int(shape[1] or 1)
    keys = spark.range(64 * parts).select("id", F.expr(f"pmod(hash(cast(id as int)), {parts})").alias("to"))
    keys = {r["to"]: r["id"] for r in keys.groupBy("to").agg(F.min("id").alias("id")).collect()}  # a partition of its own for each part
    chosen = F.array(*[F.lit(int(keys.get(p, p))) for p in range(parts)])[F.col("bi")].cast("int")
    placed = tidy_stored(made.withColumn("to", chosen).repartition(parts, "to").drop("to").mapInArrow(_joined, WEIGHED))
    discard(made)

    def present(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _rows(batch):
                ids = np.unique(_places(row["gaps"], row["many"]) // row["wide"]).astype(np.int64)
                yield from _batches("part int, ids binary, many long", [(row["bi"], ids.tobytes(), len(ids))])

    def united(pieces: pa.Table) -> pa.Table:
        ids = np.unique(np.concatenate([np.frombuffer(x.as_buffer(), np.int64) for x in pieces.column("ids")]))
        return _frame("part int, ids binary, many long", [(pieces.column("part")[0].as_py(), ids.tobytes(), len(ids))])

    found = placed.select("bi", "wide", "many", "gaps").mapInArrow(present, "part int, ids binary, many long")
    words = tidy_stored(found.groupBy("part").applyInArrow(united, "part int, ids binary, many long"))
    width = min(size + more, int(words.agg(F.sum("many")).first()[0] or 0))
    if not width:
        return np.zeros(0), spark.createDataFrame([], VECTORS)

    hand = HAND

    def start(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _rows(batch):
                vec, ids = np.zeros((wide, width)), np.frombuffer(row["ids"], np.int64)
                for i in ids.tolist():
                    vec[i] = np.random.default_rng([seed, i * parts + row["part"]]).standard_normal(width)
                yield from _pieces(row["part"], ids, vec, hand)

    basis = words.repartition(parts).mapInArrow(start, PARTS).persist(StorageLevel.MEMORY_AND_DISK_DESER)
    basis.select("part").collect()  # before its first use, so that a task of that needs one Python process
    right = np.eye(width)  # the basis is what is kept times this
    for _ in range(passes):
        last, basis = basis, product(placed, basis, wide, width, right)
        last.unpersist()
        width = right.shape[1]
        right = _orthonormal(basis, width)
    image = product(placed, basis, wide, width, right)
    small = right.T @ _inner(basis, image, width, right.shape[1])
    image.unpersist()
    values, turned = np.linalg.eigh((small + small.T) / 2)
    kept = np.argsort(values)[::-1][:size]
    kept = kept[values[kept] > 1e-10 * max(values.max(initial=0.0), 1e-300)]
    final = right @ (turned[:, kept] * np.sqrt(values[kept]))

    def cubes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _rows(batch):
                cube = ((np.frombuffer(row["vec"]).reshape(-1, width) @ final) ** 3).sum(axis=0)
                yield from _batches("part int, piece int, sum binary", [(row["part"], row["piece"], cube.tobytes())])

    found = basis.mapInArrow(cubes, "part int, piece int, sum binary").collect()
    sums = sorted((r["part"], r["piece"], bytes(r["sum"])) for r in found)
    signs = np.where(sum((np.frombuffer(x) for _, _, x in sums), np.zeros(len(kept))) < 0, -1.0, 1.0)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _rows(batch):
                ids = np.frombuffer(row["ids"], np.int64)
                vec = (np.frombuffer(row["vec"]).reshape(-1, width) @ (final * signs))[ids - row["piece"] * hand]
                for lo in range(0, len(ids), 1024):
                    some = vec[lo : lo + 1024]
                    rows = pa.ListArray.from_arrays(np.arange(0, some.size + 1, len(kept), dtype=np.int32), pa.array(some.ravel()))
                    index = pa.array(ids[lo : lo + 1024] * parts + row["part"])
                    yield pa.RecordBatch.from_arrays([index, rows], ["index", "vec"])

    if len(kept):
        vectors = stored(basis.mapInArrow(each, VECTORS))
    else:
        vectors = spark.createDataFrame([], VECTORS)
    basis.unpersist()
    discard(placed)
    discard(words)
    return values[kept], vectors


def fit_word_vectors(
    df: DataFrame, vocab: DataFrame, text: str = "text", size: int = 300, window: int = 7, min_count: int = 10, seed: int = 0
) -> DataFrame:
    """The vocabulary with a learnt ``vector`` per word; NULL for words below ``min_count`` or without a positive pair."""
    vocab = tidy_stored(vocab)
    pairs = word_pairs(df, text, window, vocab.where(F.col("n") >= min_count), packed=True)
    _, vectors = factorise(affinity(pairs, vocab, min_count, packed=True), size, seed=seed)
    discard(pairs)
    return vocab.join(vectors.withColumnRenamed("vec", "vector"), "index", "left")
