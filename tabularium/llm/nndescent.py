"""Nearest neighbours by inner product: NN-descent builds a neighbour graph, queries walk it greedily.

**Nodes** are the distinct vectors. A node keeps its smallest ids, one more than are asked for, so that any
number of equal vectors costs one node and ties among them still come out exactly. For building, vectors
are scaled by the largest norm and get one more component that brings them to norm 1: nearness by inner
product then is nearness on a sphere, without hubs made by long vectors.

**Graph**: every node starts with its nearest among the rows next to it in two sorted orders of random
projections. A round joins the lists of all nodes (their neighbours and a sample of the nodes that list
them) with the vectors in them, compares the neighbours of a node with each other where one of the two is
new, and merges what is nearer into the lists, until few edges change (``CHANGED``). Lists are joined
block by block (256 nodes), so a vector travels once to each block that needs it and a task holds one
block. Reverse lists are samples by hash and merges take the best by windows that Spark limits before the
shuffle: no node's list grows with the table.

**Search** is best-first: each round takes the best unexpanded nodes of every query's beam, joins their lists,
drops pairs scored before and scores the rest on the original vectors in double precision, next to the
block that holds them. All queries move together, one join a round; it ends when every beam is expanded,
at ``STEPS`` rounds at the latest.

Defined results: vectors that are null, empty, zero, hold null or non-finite components or have another length
than most (the smaller length if two are as frequent) take no part. Rows that agree in id and vector are
one row; rows with a null id take no part. No vectors, no rows. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabularium.llm.common import kept_table, table

TOP = 20
QUERY_SHARE = 20  # every 20th id is a query
NEIGHBOURS = 40  # of a node in the graph; as many more that list it
ORDERS = 2
CHUNK = 512  # rows that are compared with each other at the start
OFFERS = 8  # of a node's list to each of its members, a round
CHANGED = 0.1  # share of new edges below which the graph is done
ROUNDS = 12
BLOCK = 2048
LIST_BLOCK = 256  # a vector has 80 lists at most, so from some 100 blocks on it goes to nearly as many at any table size
BEAM, EXPANDED, STEPS = 128, 32, 8
SEED = 11


def matrix(column: pa.ChunkedArray | pa.Array, dtype=np.float64) -> np.ndarray:
    """A list column of one length as rows."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return np.zeros((0, 0), dtype)
    return np.asarray(column.flatten()).astype(dtype).reshape(len(column), -1)


def valid(vectors: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """(id, vec) of the rows that take part, without repetitions."""
    rows = vectors.select(F.col(vec_id).cast("long").alias("id"), F.col(vector).alias("vec")).where(
        F.col("id").isNotNull() & (F.size("vec") > 0)
    )
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) != F.lit(float("inf")))
    rows = rows.where(F.forall("vec", finite) & F.exists("vec", lambda x: x != 0))
    length = rows.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    return rows.where(F.size("vec") == (length[0]["n"] if length else 0)).distinct()


def block_of(node: Column, size: int = BLOCK) -> Column:
    return F.floor(node / size).cast("long")


def make_nodes(rows: DataFrame, top: int) -> DataFrame:
    """(node, block, vec, members): distinct vectors with their smallest ids, numbered without gaps along a random projection."""
    smallest = Window.partitionBy("vec").orderBy("id")
    members = (
        rows.withColumn("__r", F.row_number().over(smallest))
        .where(F.col("__r") <= top + 1)
        .groupBy("vec")
        .agg(F.sort_array(F.collect_list("id")).alias("members"))
    )
    kept = kept_table(members, "vectors")
    dealt = dealt_along(kept, kept.count(), 0, "vec", "members").select("vec", "members", F.monotonically_increasing_id().alias("at"))
    placed = kept_table(dealt, "placed")
    part, place = F.shiftright("at", 33), F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    counts = placed.groupBy(part.alias("part")).agg(F.count("*").alias("n"))  # a row per partition
    before = counts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    node = F.col("before") + place
    numbered = placed.join(F.broadcast(before), part == F.col("part"))
    return kept_table(numbered.select(node.alias("node"), block_of(node).alias("block"), "vec", "members"), "nodes")


def dealt_along(df: DataFrame, n: int, order: int, *columns: str) -> DataFrame:
    """Rows sorted by the signs of random projections, then one projection, over enough partitions."""

    def key(batches):
        for batch in batches:
            x = matrix(batch.column("vec"), np.float32)
            y = x @ np.random.default_rng([SEED, order]).standard_normal((x.shape[1], 17), np.float32)
            signs = ((y[:, :16] > 0) << np.arange(16)).sum(axis=1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(signs, pa.int64()), pa.array(y[:, 16].astype(np.float64))],
                [*batch.schema.names, "__signs", "__place"],
            )

    picked = df.select(*columns)
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in picked.schema.fields)
    keyed = picked.mapInArrow(key, f"{types}, __signs long, __place double")
    parts = max(1, n // (4 * CHUNK))
    return keyed.repartitionByRange(parts, "__signs", "__place").sortWithinPartitions("__signs", "__place")


def on_sphere(nodes: DataFrame) -> DataFrame:
    """(node, block, vec) with vectors of norm 1 in half precision."""
    square = F.aggregate("vec", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    longest = nodes.agg(F.sqrt(F.max(square))).first()[0]

    def run(batches):
        for batch in batches:
            x = matrix(batch.column("vec")) / longest
            rest = np.sqrt(np.maximum(0, 1 - (x * x).sum(axis=1)))
            rows = np.column_stack([x, rest]).astype(np.float16)
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), batch.column("block"), pa.array([r.tobytes() for r in rows], pa.binary())],
                ["node", "block", "vec"],
            )

    return kept_table(nodes.select("node", "block", "vec").mapInArrow(run, "node long, block long, vec binary"), "sphere")


def halves(column: pa.ChunkedArray) -> np.ndarray:
    """Half-precision vectors as rows of single precision."""
    raw = b"".join(column.to_pylist())
    return np.frombuffer(raw, np.float16).reshape(len(column), -1).astype(np.float32)


def best(rows: DataFrame, of: str, by: list, k: int) -> DataFrame:
    """The first ``k`` rows of each ``of``."""
    return rows.withColumn("__r", F.row_number().over(Window.partitionBy(of).orderBy(*by))).where(F.col("__r") <= k).drop("__r")


def first_edges(nodes: DataFrame, sphere: DataFrame, n: int, k: int) -> DataFrame:
    """(u, w, sim): nearest among the rows next to each node in random orders."""

    def run(batches):
        ids, vecs, held = [], [], 0

        def compared(ids: np.ndarray, x: np.ndarray):
            for lo, hi in chunks(len(ids)):
                near = x[lo:hi] @ x[lo:hi].T
                m = min(k // ORDERS, hi - lo - 1)
                if m < 1:
                    continue
                np.fill_diagonal(near, -9)
                at = np.argpartition(-near, m - 1, axis=1)[:, :m]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.repeat(ids[lo:hi], m)),
                        pa.array(ids[lo:hi][at].ravel()),
                        pa.array(np.take_along_axis(near, at, 1).ravel().astype(np.float32)),
                    ],
                    ["u", "w", "sim"],
                )

        for batch in batches:
            ids.append(np.asarray(batch.column("node")))
            vecs.append(halves(batch.column("sphere")))
            held += batch.num_rows
            if held >= 16 * CHUNK:  # the last rows wait for those that follow them
                all_ids, x = np.concatenate(ids), np.concatenate(vecs)
                cut = held - 2 * CHUNK
                yield from compared(all_ids[:cut], x[:cut])
                ids, vecs, held = [all_ids[cut:]], [x[cut:]], 2 * CHUNK
        if held:
            yield from compared(np.concatenate(ids), np.concatenate(vecs))

    both = nodes.select("node", "vec").join(sphere.select("node", F.col("vec").alias("sphere")), "node")
    found = [
        dealt_along(both, n, i + 1, "node", "vec", "sphere").mapInArrow(run, "u long, w long, sim float") for i in range(ORDERS)
    ]
    edges = found[0]
    for more in found[1:]:
        edges = edges.unionByName(more)
    merged = edges.groupBy("u", "w").agg(F.max("sim").alias("sim")).withColumn("fresh", F.lit(True))
    return kept_table(best(merged, "u", [F.desc("sim"), "w"], k), "edges")


def chunks(n: int) -> list[tuple[int, int]]:
    """Ranges of about ``CHUNK`` rows; none is smaller than half of that unless all is."""
    parts = max(1, round(n / CHUNK))
    cuts = np.linspace(0, n, parts + 1).astype(int).tolist()
    return list(zip(cuts, cuts[1:]))


def compare_lists(lists: pa.Table, vectors: pa.Table) -> pa.Table:
    """One block: the members of each node's list against each other; (u, w, sim) that beat u's last neighbour."""
    empty = pa.table([pa.array([], pa.int64()), pa.array([], pa.int64()), pa.array([], pa.float32())], names=["u", "w", "sim"])
    if not lists.num_rows:
        return empty
    node, last = np.asarray(vectors.column("node")), np.asarray(vectors.column("last"))
    order = np.argsort(node)
    node, last, x = node[order], last[order], halves(vectors.column("vec"))[order]
    v, w, fresh = (np.asarray(lists.column(c)) for c in ("v", "x", "fresh"))
    order = np.argsort(v, kind="stable")
    v, w, fresh = v[order], np.searchsorted(node, w[order]), fresh[order]
    start = np.flatnonzero(np.r_[True, v[1:] != v[:-1]])
    size = np.diff(np.r_[start, len(v)])
    width = int(size.max())
    found: list[np.ndarray] = []
    for lo in range(0, len(start), 256):
        s, m = start[lo : lo + 256], size[lo : lo + 256]
        at = s[:, None] + np.arange(width)
        real = np.arange(width) < m[:, None]
        at = np.where(real, at, 0)
        member, new = w[at], fresh[at] & real
        near = np.matmul(x[member], x[member].transpose(0, 2, 1))
        use = real[:, :, None] & real[:, None, :] & (new[:, :, None] | new[:, None, :])
        use &= near > last[member][:, :, None]
        use[:, np.arange(width), np.arange(width)] = False
        near = np.where(use, near, -9)
        k = min(OFFERS, width)
        top = np.argpartition(-near, k - 1, axis=2)[:, :, :k]
        sim = np.take_along_axis(near, top, 2)
        keep = sim > -9
        to = np.take_along_axis(np.broadcast_to(member[:, None, :], near.shape), top, 2)
        of = np.broadcast_to(member[:, :, None], to.shape)
        found.append(np.column_stack([of[keep], to[keep], sim[keep].view(np.int32)]).astype(np.int64))
    rows = np.concatenate(found)
    if not len(rows):
        return empty
    key = rows[:, 0] * len(node) + rows[:, 1]
    _, first = np.unique(key, return_index=True)
    rows = rows[first]
    sims = rows[:, 2].astype(np.int32).view(np.float32)
    return pa.table([pa.array(node[rows[:, 0]]), pa.array(node[rows[:, 1]]), pa.array(sims)], names=["u", "w", "sim"])


def descend(sphere: DataFrame, edges: DataFrame, k: int, round_no: int) -> DataFrame:
    """One round: neighbours of neighbours are compared, and the nearest ``k`` of each node stay."""
    reverse = best(
        edges.select(F.col("w").alias("v"), F.col("u").alias("x"), "fresh"), "v", [F.xxhash64("v", "x", F.lit(round_no)), "x"], k
    )
    lists = edges.select(F.col("u").alias("v"), F.col("w").alias("x"), "fresh").unionByName(reverse)
    lists = lists.groupBy("v", "x").agg(F.max("fresh").alias("fresh")).withColumn("block", block_of(F.col("v"), LIST_BLOCK))
    lists = kept_table(lists, "lists")
    last = edges.groupBy(F.col("u").alias("node")).agg(F.min("sim").alias("low"), F.count("*").alias("n"))
    last = last.select("node", F.when(F.col("n") >= k, F.col("low")).alias("last"))
    ends = sphere.join(last, "node", "left").select("node", "vec", F.coalesce("last", F.lit(-9.0)).cast("float").alias("last"))
    sent = lists.select(F.col("block").alias("home"), F.col("x").alias("node")).distinct().join(ends, "node")
    offers = (
        lists.groupBy("block").cogroup(sent.groupBy("home")).applyInArrow(compare_lists, "u long, w long, sim float")
    )
    merged = (
        edges.select("u", "w", "sim", F.lit(False).alias("fresh"))
        .unionByName(offers.withColumn("fresh", F.lit(True)))
        .groupBy("u", "w")
        .agg(F.max("sim").alias("sim"), F.min("fresh").alias("fresh"))
    )
    return kept_table(best(merged, "u", [F.desc("sim"), "w"], k), "edges")


def build(nodes: DataFrame, k: int = NEIGHBOURS) -> DataFrame:
    """(u, w, sim): the neighbour graph of the nodes."""
    sphere = on_sphere(nodes)
    edges = first_edges(nodes, sphere, nodes.count(), k)
    for round_no in range(ROUNDS):
        edges = descend(sphere, edges, k, round_no)
        count = edges.agg(F.count("*"), F.count_if("fresh")).first()
        if count[1] <= CHANGED * count[0]:
            break
    return edges


def score_block(asked: pa.Table, block: pa.Table) -> pa.Table:
    """One block: the inner products of queries with the nodes they ask for."""
    names = ["q", "x", "score"]
    if not asked.num_rows:
        return pa.table([pa.array([], pa.int64()), pa.array([], pa.int64()), pa.array([], pa.float64())], names=names)
    node = np.asarray(block.column("node"))
    order = np.argsort(node)
    node, vec, q = node[order], matrix(block.column("vec"))[order], matrix(asked.column("vec"))
    xs = asked.column("xs").combine_chunks()
    size = np.diff(np.asarray(xs.offsets))
    x, row = np.asarray(xs.flatten()), np.repeat(np.arange(len(size)), size)
    score = np.empty(len(x))
    for lo in range(0, len(x), 1 << 14):
        some = slice(lo, lo + (1 << 14))
        score[some] = np.einsum("ij,ij->i", q[row[some]], vec[np.searchsorted(node, x[some])])
    return pa.table([pa.array(np.asarray(asked.column("q"))[row]), pa.array(x), pa.array(score)], names=names)


def scored(nodes: DataFrame, queries: DataFrame, pairs: DataFrame) -> DataFrame:
    """(q, x, score) of distinct pairs of query and node."""
    asked = (
        pairs.withColumn("block", block_of(F.col("x")))
        .groupBy("block", "q")
        .agg(F.collect_list("x").alias("xs"))  # of one block: 2,048 at most
        .join(queries.select("q", "vec"), "q")
    )
    return (
        asked.groupBy("block")
        .cogroup(nodes.select("block", "node", "vec").groupBy("block"))
        .applyInArrow(score_block, "q long, x long, score double")
    )


def search(nodes: DataFrame, edges: DataFrame, queries: DataFrame, k: int = NEIGHBOURS) -> DataFrame:
    """(q, x, score): the beams of ``queries`` (q, vec, start: the node where the walk begins)."""
    forward = edges.select(F.col("u").alias("from"), F.col("w").alias("x"))
    backward = best(edges.select(F.col("w").alias("from"), F.col("u").alias("x"), "sim"), "from", [F.desc("sim"), "x"], k)
    links = kept_table(forward.unionByName(backward.drop("sim")).distinct(), "links")
    order = [F.desc("score"), "x"]
    seen = kept_table(scored(nodes, queries, queries.select("q", F.col("start").alias("x"))), "scored")
    beam = seen.withColumn("open", F.lit(True))
    for _ in range(STEPS):
        front = best(beam.where("open").select("q", "x", "score"), "q", order, EXPANDED)
        front = kept_table(front.select("q", F.col("x").alias("from")), "front")
        if front.isEmpty():
            break
        pairs = front.join(links, "from").select("q", "x").distinct().join(seen.select("q", "x"), ["q", "x"], "left_anti")
        new = kept_table(scored(nodes, queries, pairs), "scored")
        seen = seen.unionByName(new)
        done = front.select("q", F.col("from").alias("x"), F.lit(True).alias("done"))
        still = beam.join(done, ["q", "x"], "left").select("q", "x", "score", (F.col("open") & F.col("done").isNull()).alias("open"))
        beam = kept_table(best(still.unionByName(new.withColumn("open", F.lit(True))), "q", order, BEAM), "beam")
    return beam.select("q", "x", "score")


def nearest(spark: SparkSession, vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", top: int = TOP) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``top`` nearest rows found for every ``QUERY_SHARE``-th id."""
    rows = kept_table(valid(vectors, vec_id, vector), "valid")
    if rows.isEmpty():
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    nodes = make_nodes(rows, top)
    edges = build(nodes)
    asked = rows.where(F.col("id") % QUERY_SHARE == 0).join(nodes.select("node", "vec"), "vec").select("id", "node")
    asked = kept_table(asked, "asked")
    starts = asked.select("node").distinct().join(nodes.select("node", "vec"), "node")
    queries = kept_table(starts.select(F.col("node").alias("q"), "vec", F.col("node").alias("start")), "queries")
    found = search(nodes, edges, queries)
    members = nodes.select(F.col("node").alias("x"), "members")
    # each node has a member of its own, so one node more than rows are asked for is enough
    first = best(
        found.join(members, "x").withColumn("least", F.col("members")[0]), "q", [F.desc("score"), "least", "x"], top + 1
    )
    each = kept_table(first.select("q", "x", "score", F.explode("members").alias("id")), "found")
    own = asked.withColumnRenamed("id", "query_id").withColumnRenamed("node", "q").join(each, "q")
    own = own.where((F.col("id") != F.col("query_id")) | (F.col("x") != F.col("q")))
    ranked = own.withColumn("rank", F.row_number().over(Window.partitionBy("query_id", "q").orderBy(F.desc("score"), "id")))
    return ranked.where(F.col("rank") <= top).select("query_id", "rank", F.col("id").alias("vec_id"), "score")


def op11_nearest_neighbours(spark, sf_dir: str) -> DataFrame:
    return nearest(spark, table(spark, sf_dir, "embeddings"))
