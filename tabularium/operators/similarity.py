"""Dot products, vector neighbours and token-set similarity."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabularium.functions.columns import cosine, squared_distance
from tabularium.operators.order_stats import global_row_number
from tabularium.session import stored

FREQUENT_TOKENS = 10_000
SKETCH_WORDS = 16  # of 64 bits


def keyed_dot(
    left: DataFrame,
    right: DataFrame,
    key: str,
    left_value: str,
    right_value: str,
    by: list[str] | None = None,
) -> DataFrame:
    """Sum of products over the shared keys, overall or per ``by`` columns of ``left``.

    Left amounts of one key are added up first, so a frequent key costs one joined row.
    """
    by = by or []
    amounts = left.groupBy(*by, key).agg(F.sum(left_value).alias("_amount"))
    return (
        amounts.join(right.select(key, F.col(right_value).alias("_price")), key)
        .groupBy(*by)
        .agg(F.sum(F.col("_amount") * F.col("_price")).alias("dot"))
    )


def nearest_rows(df: DataFrame, key: str, vector: str, probe, k: int = 5) -> DataFrame:
    """The ``k`` rows with the smallest squared distance to the row whose key is ``probe``.

    The probe (one row) becomes a literal, so the search is a scan with a bounded top-k.
    """
    row = df.filter(F.col(key) == probe).select(vector).first()
    if row is None:
        raise ValueError(f"no row with {key} = {probe}")
    return nearest_to(df, vector, list(row[0]), key, k)


def nearest_to(df: DataFrame, vector: str, point: list[float], key: str, k: int = 5) -> DataFrame:
    target = F.array(*[F.lit(float(x)) for x in point])
    return (
        df.withColumn("distance", squared_distance(vector, target))
        .orderBy("distance", key)
        .limit(k)
    )


def cosine_to(df: DataFrame, key: str, vector: str, probe) -> DataFrame:
    """Cosine of every row's vector with the vector of the row whose key is ``probe``."""
    row = df.filter(F.col(key) == probe).select(vector).first()
    if row is None:
        raise ValueError(f"no row with {key} = {probe}")
    target = F.array(*[F.lit(float(x)) for x in row[0]])
    return df.withColumn("cosine", cosine(vector, target))


def distinct_sets(df: DataFrame, key: str, tokens: str) -> DataFrame:
    """Rows with equal token sets collapsed: ``(set_id, tokens, size, copies)``.

    ``set_id`` is the smallest key of the copies. However many copies there are, each task sends
    one row per set.
    """
    ordered = df.select(key, F.array_sort(F.array_distinct(tokens)).alias("tokens"))
    signed = stored(ordered.withColumn("_sig", F.sha2(F.array_join("tokens", "\u001f"), 256)))
    # Only narrow columns are aggregated; the tokens of the first copy are joined afterwards.
    first = signed.groupBy("_sig").agg(F.min(key).alias("set_id"), F.count(F.lit(1)).alias("copies"))
    own = signed.select(F.col(key).alias("set_id"), "_sig", "tokens", F.size("tokens").alias("size"))
    return first.join(own, ["_sig", "set_id"]).select("set_id", "tokens", "size", "copies")


def set_members(df: DataFrame, key: str, tokens: str) -> DataFrame:
    """Which set every row belongs to: ``(key, set_id)``."""
    signed = df.select(
        key,
        F.sha2(F.array_join(F.array_sort(F.array_distinct(tokens)), "\u001f"), 256).alias("_sig"),
    )
    first = signed.groupBy("_sig").agg(F.min(key).alias("set_id"))
    return signed.join(first, "_sig").select(key, "set_id")


def cosine_pairs(
    sets: DataFrame, min_cosine: float, frequent: int = FREQUENT_TOKENS
) -> DataFrame:
    """Every pair of distinct token sets whose cosine |A & B| / sqrt(|A| |B|) reaches the bound.

    Prefix filtering, exact for any positive bound: two sets that reach it share at least ``w`` = bound * sqrt(|A| |B|)
    tokens, so the first |A| - w + 1 tokens of A and the first |B| - w + 1 of B in any common order share one. With
    bound^2 |B| <= |A| <= |B|, ``w`` is at least bound * |A| and bound^2 * |B|, which gives each side its prefix. Rare tokens
    come first in that order: tokens are numbered by frequency, and the numbers stand for them from there on. Sizes are
    checked in size bands by the join key.

    Where two prefixes meet, a pair goes on only if the tokens left behind the place can still make up ``w``, and if
    sketches allow it: bit k of a set's sketch is the parity of its tokens with hash k, so the sketches of two sets differ
    in no more bits than the sets in tokens. Both are checked where the rows meet, before anything is shuffled.
    """
    if not 0.0 < min_cosine <= 1.0:
        raise ValueError("the bound must be in (0, 1]")
    share = min_cosine * min_cosine
    # A set listed in several rows stays several rows, each with a sketch of its own.
    sets = stored(sets.withColumn("_row", F.monotonically_increasing_id()))
    exploded = sets.select("_row", "set_id", "size", "copies", F.explode("tokens").alias("token"))
    counts = exploded.groupBy("token").agg(F.count(F.lit(1)).alias("df"))
    numbered = stored(global_row_number(counts, ["df", "token"], "id"))
    every, lonely = numbered.agg(F.count(F.lit(1)), F.count_if(F.col("df") == 1)).first()
    head = F.broadcast(numbered.orderBy(F.col("id").desc()).limit(frequent).select("token", "id"))
    # The ``frequent`` commonest tokens (a fixed number) are matched where they are; the rarer ones are shuffled.
    rare = exploded.join(head.select("token"), "token", "left_anti").join(numbered.select("token", "id"), "token")
    numbers = exploded.join(head, "token").unionByName(rare).withColumn("id", F.col("id").cast("int" if every < 1 << 31 else "long"))
    h = F.xxhash64("id")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), h.bitwiseAND(F.lit(63)).cast("int"))
    word = F.pmod(F.shiftright(h, 6), F.lit(SKETCH_WORDS))
    sketch = [f"sketch{i}" for i in range(SKETCH_WORDS)]
    ranked = stored(
        numbers.groupBy("_row", "set_id", "size", "copies").agg(
            F.sort_array(F.collect_list("id")).alias("ids"),
            *(F.bit_xor(F.when(word == i, bit).otherwise(F.lit(0).cast("long"))).alias(c) for i, c in enumerate(sketch)),
        )
    )
    # The tiny slack keeps rounding from shortening a prefix.
    length = lambda least: (F.col("size") - F.ceil(F.col("size") * least - 1e-9) + 1).cast("int")
    step = -math.log(share) if share < 1.0 else 1.0
    band = F.floor(F.ln("size") / F.lit(step)).cast("int") if share < 1.0 else F.col("size")
    keyed = ranked.select(
        "set_id", "size", band.alias("band"), length(min_cosine).alias("short"), *sketch,
        F.posexplode(F.slice("ids", 1, length(share))).alias("place", "token"),
    ).filter(F.col("token") > lonely)  # what only one set has meets nothing
    reach = [0, 1] if share < 1.0 else [0]
    small = keyed.filter(F.col("place") < F.col("short")).select(
        F.col("set_id").alias("a"),
        F.col("size").alias("size_a"),
        F.col("place").alias("place_a"),
        *(F.col(c).alias(f"{c}_a") for c in sketch),
        "token",
        F.explode(F.array(*[F.col("band") + F.lit(r) for r in reach])).alias("band"),
    )
    large = keyed.select(
        F.col("set_id").alias("b"),
        F.col("size").alias("size_b"),
        F.col("place").alias("place_b"),
        *(F.col(c).alias(f"{c}_b") for c in sketch),
        "token",
        "band",
    )
    later = (F.col("size_a") < F.col("size_b")) | (
        (F.col("size_a") == F.col("size_b")) & (F.col("a") < F.col("b"))
    )
    wanted = F.sqrt(F.col("size_a").cast("double") * F.col("size_b")) * min_cosine - 1e-9
    # For the first token a pair shares, no shared token stands before it.
    behind = F.least(F.col("size_a") - F.col("place_a"), F.col("size_b") - F.col("place_b"))
    apart = sum((F.bit_count(F.col(f"{c}_a").bitwiseXOR(F.col(f"{c}_b"))) for c in sketch), F.lit(0))
    candidates = (
        small.join(large, ["token", "band"])
        .filter(later & (F.col("size_a") >= F.col("size_b") * share - 1e-9))
        .filter(behind >= wanted)
        .filter(F.col("size_a") + F.col("size_b") - apart >= 2 * wanted)
        .select("a", "b")
        .distinct()
    )
    sides = [
        ranked.select(F.col("set_id").alias(x), *(F.col(c).alias(f"{c}_{x}") for c in ("ids", "size", "copies")))
        for x in ("a", "b")
    ]
    shared = F.size(F.array_intersect("ids_a", "ids_b"))
    matched = (
        candidates.join(sides[0], "a")
        .join(sides[1], "b")
        .select(
            "a",
            "b",
            F.col("copies_a").alias("ca"),
            F.col("copies_b").alias("cb"),
            shared.alias("shared"),
            (F.col("size_a") + F.col("size_b") - shared).alias("united"),
            (shared / F.sqrt(F.col("size_a").cast("double") * F.col("size_b"))).alias("cosine"),
        )
        .filter(F.col("cosine") >= min_cosine)
    )
    swap = F.col("a") > F.col("b")
    return matched.select(
        F.least("a", "b").alias("set_a"),
        F.greatest("a", "b").alias("set_b"),
        F.when(swap, F.col("cb")).otherwise(F.col("ca")).alias("copies_a"),
        F.when(swap, F.col("ca")).otherwise(F.col("cb")).alias("copies_b"),
        "shared",
        "united",
        "cosine",
    )


def cosine_with_set(df: DataFrame, key: str, tokens: str, probe) -> DataFrame:
    """Every row's token set beside that of the row whose key is ``probe``, without any bound.

    The probe's tokens (one row) become a literal, so this is one scan: union, 0/1 vectors, cosine.
    """
    row = df.filter(F.col(key) == probe).select(tokens).first()
    if row is None:
        raise ValueError(f"no row with {key} = {probe}")
    target = F.lit(list(row[0])) if row[0] else F.array().cast("array<string>")
    others = df.filter(F.col(key) != probe).withColumn("_probe", F.array_distinct(target))
    return set_pair_vectors(others, "_probe", tokens).drop("_probe")


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def _members(left: pd.Series, right: pd.Series) -> pd.Series:
    """1.0/0.0 per element of ``left`` for membership in ``right``: one lookup each."""

    def marks(some, other):
        if some is None or other is None:
            return None
        known = set(other) - {None}
        return [float(x in known) for x in some]

    return pd.Series([marks(a, b) for a, b in zip(left, right)], dtype=object)


def set_pair_vectors(pairs: DataFrame, left: str, right: str) -> DataFrame:
    """Union of two token sets and their 0/1 vectors over it, with the cosine of the vectors.

    The union lists the left tokens first, so only these are looked up (in Arrow batches), each once; what follows
    them is in the right set alone. The work is linear in the tokens. The products of 0/1 vectors are counts.
    """
    found = lambda x: F.when(x.isNull(), 0.0).otherwise(1.0)  # noqa: E731  a null is no member of any set
    own, more = F.size("_left"), F.size("union") - F.size("_left")
    only_right = F.slice("union", own + 1, more)
    whole = pairs.withColumn("_left", F.array_distinct(left)).withColumn("union", F.array_union(left, right))
    marked = whole.withColumn("_in", _members("_left", F.when(F.col("union").isNotNull(), F.col(right))))
    vectors = marked.withColumns({
        "vector_a": F.when(F.col("union").isNotNull(), F.concat(F.transform("_left", found), F.array_repeat(F.lit(0.0), more))),
        "vector_b": F.concat("_in", F.transform(only_right, found)),
    })
    ones = lambda v: F.aggregate(v, F.lit(0.0), lambda acc, x: acc + x)
    cosine_of_sets = F.try_divide(ones("_in"), F.sqrt(ones("vector_a")) * F.sqrt(ones("vector_b")))
    return vectors.withColumn("cosine", F.round(cosine_of_sets, 3)).drop("_left", "_in")
