"""Mixing sources to target weights by Poisson replication.

Every source gets a mean repetition rate (target share x all rows / its rows). Each document's count
is the inverse of the Poisson distribution with that rate at a number hashed from (seed, id, text),
so a rerun gives the same rows. Documents are exploded by their count and put into a global random order
(range partitions of a hash of id, text and copy).

Defined results: a null source is a source of its own, null ids and texts hash as empty text, a
source with weight 0 vanishes, an empty table gives an empty table. Repeated rows share the hashed
number and so the count. Columns are kept; ``copy`` (from 0) and ``shuffle_key`` are added on request and
replace columns of that name.

The counts per source are aggregated before they are joined back (sources with millions of names are
joined by size, none is forced into a broadcast), and one source may hold any share of the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabularium.llm.common import kept_table, table, unused

SEED = "mix-1"
POWER = 0.5
#: A larger mean is split into equal parts with one hashed number each, so exp(-mean) stays exact.
PART_RATE = 8.0


def tempered_targets(docs: DataFrame, power: float = POWER) -> DataFrame:
    """Weight of each source: its number of rows to ``power``, from 1 (as is) to 0 (all alike)."""
    n = docs.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    return n.select("source", F.pow("n", F.lit(power)).alias("weight"))


def rates(docs: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, rate): mean repetitions that bring the sources to the target weights at equal total size."""
    n = docs.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    t = targets.select(F.col("source").alias("_s"), F.col("weight").cast("double").alias("weight"))
    both = kept_table(n.join(t, F.col("source").eqNullSafe(F.col("_s"))).select("source", "n", "weight"), "rates")
    total = both.agg(F.sum("n").alias("n"), F.sum("weight").alias("weight")).head()
    if not total["weight"]:
        return both.select("source", F.lit(0.0).alias("rate"))
    return both.select("source", (F.col("weight") / total["weight"] * total["n"] / F.col("n")).alias("rate"))


def _unit(*parts: Column) -> Column:
    """A number in [0, 1) from the first 52 bits of md5."""
    text = F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / float(1 << 52)


def distribution(rate: Column) -> Column:
    """P(X <= k) for k = 0..63 of the Poisson law; with a rate up to PART_RATE that reaches 1 - 2^-53."""
    first = F.struct(F.exp(-rate).alias("p"), F.array(F.exp(-rate)).alias("cdf"))

    def step(acc: Column, k: Column) -> Column:
        p = acc["p"] * rate / k
        total = F.element_at(acc["cdf"], -1) + p
        return F.struct(p.alias("p"), F.concat(acc["cdf"], F.array(total)).alias("cdf"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(63)), first, step, lambda acc: acc["cdf"])


def copies(seed: str, parts: Column, cdf: Column) -> Column:
    """Poisson count of a document: numbers hashed from ``seed``, doc_id and text, inverted one by one."""
    key = F.md5(F.concat_ws("|", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")),
                            F.coalesce(F.col("text"), F.lit(""))))
    numbers = F.transform(F.sequence(F.lit(1), parts), lambda i: _unit(key, i))
    counts = F.transform(numbers, lambda u: F.size(F.filter(cdf, lambda c: c <= u)))
    return F.aggregate(counts, F.lit(0), lambda a, k: a + k)


def mix(docs: DataFrame, targets: DataFrame | None = None, seed: str = SEED, marks: bool = False) -> DataFrame:
    """Replicated documents in a global random order; sources without a target vanish."""
    wanted = targets if targets is not None else tempered_targets(docs)
    parts = F.greatest(F.ceil(F.col("rate") / PART_RATE), F.lit(1)).cast("int")
    source, pieces, cdf, times, nth, key = unused(docs, "__source", "__parts", "__cdf", "__n", "__copy", "__key")
    by_source = rates(docs, wanted).where("rate > 0").select(
        F.col("source").alias(source), parts.alias(pieces), distribution(F.col("rate") / parts).alias(cdf)
    )
    by_source = kept_table(by_source, "poisson")
    joined = docs.join(by_source, docs["source"].eqNullSafe(F.col(source)))
    out = [c for c in docs.columns if not (marks and c in ("copy", "shuffle_key"))]
    counted = joined.withColumn(times, copies(seed, F.col(pieces), F.col(cdf))).where(F.col(times) > 0)
    each = counted.select(*out, F.explode(F.sequence(F.lit(0), F.col(times) - 1)).alias(nth))
    keyed = each.withColumn(key, F.xxhash64(F.lit(seed), "doc_id", "text", nth))
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # hashes are even over their range, so the range partition of a key needs no sample
    share = (F.col(key).cast("double") + 2.0**63) / 2.0**64
    place = F.least(F.floor(share * n), F.lit(n - 1)).cast("int")
    ordered = keyed.repartitionById(n, place).sortWithinPartitions(key)
    extra = [F.col(nth).alias("copy"), F.col(key).alias("shuffle_key")] if marks else []
    return ordered.select(*out, *extra)


def op9_mixture(spark, sf_dir: str) -> DataFrame:
    """All copies of all documents, with whole texts, sources tempered to the square root of their size."""
    return mix(table(spark, sf_dir, "documents"), marks=True).drop("shuffle_key")


OP9_SQL = r"""
WITH RECURSIVE s AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
r AS (SELECT source, pow(n, 0.5) / sum(pow(n, 0.5)) OVER () * sum(n) OVER () / n AS rate FROM s),
d AS (
  SELECT documents.*, rate, greatest(ceil(rate / 8.0), 1)::INT AS parts,
         md5('mix-1|' || coalesce(CAST(doc_id AS VARCHAR), '') || '|' || coalesce(text, '')) AS key,
         row_number() OVER () AS row
  FROM documents JOIN r ON documents.source IS NOT DISTINCT FROM r.source),
u AS (
  SELECT row, rate / parts AS m,
         ('0x' || md5(key || '|' || CAST(i AS VARCHAR))[1:13])::BIGINT::DOUBLE / 4503599627370496.0 AS u, i
  FROM (SELECT row, key, rate, parts, unnest(range(1, parts + 1)) AS i FROM d)),
p AS (
  SELECT row, i, u, m, 0 AS k, exp(-m) AS p, exp(-m) AS cdf FROM u
  UNION ALL
  SELECT row, i, u, m, k + 1, p * m / (k + 1), cdf + p * m / (k + 1) FROM p WHERE cdf <= u AND k < 64),
c AS (SELECT row, sum(k) AS n FROM (SELECT row, i, max(k) AS k FROM p GROUP BY row, i) GROUP BY row)
SELECT doc_id, text, lang, source, n_chars, unnest(range(0, c.n::BIGINT))::INT AS copy
FROM d JOIN c USING (row) WHERE c.n > 0
"""
