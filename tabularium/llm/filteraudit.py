"""Filter interaction audit: what five filters remove in every order, and what each of them adds.

A document fails a filter by these conditions on its whole text (words: maximal runs without space and
\\x09-\\x0D, case-sensitive):

* A: fewer than 50 words
* B: 100 * distinct words < 65 * words
* C: 100 * capitals A-Z > 5 * code points
* D: any of ``#$%&*|``
* E: the text of some document with a smaller id, wherever that one stands, removed or not

A to D come from one pass over the texts. E is an existential self-join: a bitmap of the hashes that occur
under more than one id (of fixed size, so it may only let too many through) picks the texts to compare, each
of these texts keeps its smallest id, and a left-semi join on hash, exact text and smaller id marks the rest.
So a group of any number of copies costs a row a copy, never a pair. The marked ids are united with the other failures and aggregated to bit combinations: after that
everything is arithmetic on at most 32 counts a part.

Defined results: a null text is the empty text, a null source the empty part. Rows with a null id never
fail E and make no other row fail it. Rows that agree in id count one by one and do not make each other
fail E. Labels of an id that is listed more than once hold if any of its rows says so; a null label says
nothing. No documents give no rows. Other columns are ignored.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabularium.llm.common import hash_bitmap, kept_table, table, through_bitmap

LETTERS = "ABCDE"
MIN_WORDS = 50
DISTINCT_SHARE = 65  # percent of the words
CAPITAL_SHARE = 5  # percent of the code points
SYMBOLS = "[#$%&*|]"
COPY = 1 << LETTERS.index("E")
N_ORDERS = 120


def text_failures(text: Column) -> Column:
    """Bits of the conditions A to D."""
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))

    def bits(w: Column) -> Column:
        n = F.size(w)
        failed = (
            n < MIN_WORDS,
            100 * F.size(F.array_distinct(w)) < DISTINCT_SHARE * n,
            100 * capitals > CAPITAL_SHARE * F.length(text),
            text.rlike(SYMBOLS),
        )
        return sum((F.when(f, 1 << i).otherwise(0) for i, f in enumerate(failed)), F.lit(0))

    return F.element_at(F.transform(F.array(words), bits), 1)  # the words are split once


def several_ids(base: DataFrame) -> DataFrame:
    """Hashes that stand under several ids."""
    ids = base.groupBy("h").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
    return ids.where("low < high").select("h")


def failures(docs: DataFrame) -> DataFrame:
    """(doc_id, part, mask, n): the failed filters of every document; equal rows are counted in ``n``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    part = F.coalesce(F.col("source").cast("string"), F.lit(""))
    hashed = docs.select("doc_id", part.alias("part"), text.alias("text")).withColumn(
        "h", F.unhex(F.sha2("text", 256))
    )
    base = kept_table(hashed.select("doc_id", "part", "h", text_failures(F.col("text")).alias("mask")), "failures")
    texts = through_bitmap(hashed, "h", hash_bitmap(several_ids(base), "h"))
    texts = kept_table(texts, "texts")  # else the semi-join would be planned below the bitmap, with all texts
    ids = texts.groupBy(F.col("h").alias("h_of"), F.col("text").alias("text_of")).agg(
        F.min("doc_id").alias("first"), F.max("doc_id").alias("last")
    )
    smallest = kept_table(ids.where("first < last").drop("last"), "smallest")
    same = (F.col("h") == F.col("h_of")) & (F.col("text") == F.col("text_of")) & (F.col("first") < F.col("doc_id"))
    copies = texts.join(smallest, same, "left_semi").select("doc_id", "part", "h").distinct()
    rows = base.withColumn("n", F.lit(1)).unionByName(
        copies.select("doc_id", "part", "h", F.lit(COPY).alias("mask"), F.lit(0).alias("n"))
    )
    return rows.groupBy("doc_id", "part", "h").agg(F.bit_or("mask").alias("mask"), F.sum("n").alias("n")).drop("h")


def combinations(found: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents of each combination of failed filters."""
    marks = labels.groupBy(F.col("doc_id")).agg(
        F.max(F.when(F.col("quality") == 1, 1)).alias("good"), F.max(F.when(F.col("toxic") == 1, 1)).alias("toxic")
    )
    zero = F.lit(0)
    return (
        found.join(marks, "doc_id", "left")
        .groupBy("part", "mask")
        .agg(
            F.sum("n").alias("n"),
            F.sum(F.col("n") * F.coalesce("good", zero)).alias("good"),
            F.sum(F.col("n") * F.coalesce("toxic", zero)).alias("toxic"),
        )
    )


def steps(spark: SparkSession) -> DataFrame:
    """Every step of every order: its filter's bit and the bits of the filters before it (600 rows)."""
    rows = []
    for order in permutations(LETTERS):
        before = 0
        for step, letter in enumerate(order, 1):
            bit = 1 << LETTERS.index(letter)
            rows.append(("".join(order), step, before, bit))
            before |= bit
    return spark.createDataFrame(rows, "filter_order string, step int, before int, bit int")


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order and step; see the module for the filters."""
    counts = combinations(failures(docs), labels)
    bits = [1 << i for i in range(len(LETTERS))]
    places = [(before, bit) for bit in bits for before in range(1 << len(LETTERS)) if not before & bit]
    each = F.explode(F.array(*[F.struct(F.lit(a).alias("before"), F.lit(b).alias("bit")) for a, b in places]))
    mask, n = F.col("mask"), F.col("n")
    fails, gone = mask.bitwiseAND(F.col("bit")) != 0, mask.bitwiseAND(F.col("before")) != 0
    only = mask == F.col("bit")
    total = lambda value, when: F.sum(F.when(when, value).otherwise(0))
    by_place = (
        counts.withColumn("place", each)
        .select("part", "mask", "n", "good", "toxic", "place.before", "place.bit")
        .groupBy("part", "before", "bit")
        .agg(
            total(n, ~fails & ~gone).alias("kept"),
            total(n, fails & ~gone).alias("removed"),
            total(n, fails & gone).alias("redundant"),
            total(n, only).alias("unique_fails"),
            total(F.col("good"), fails & ~gone).alias("good_lost"),
            total(F.col("toxic"), fails & ~gone).alias("toxic_lost"),
            # of the orders of a combination's k filters, every k-th has this one first
            total(n * (F.lit(N_ORDERS) / F.greatest(F.bit_count(mask), F.lit(1))).cast("long"), fails).alias("shapley"),
        )
    )
    return by_place.join(F.broadcast(steps(docs.sparkSession)), ["before", "bit"]).select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"
    )


def op12_filter_audit(spark, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


OP12_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(CAST(source AS VARCHAR), '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
first AS (SELECT t, min(doc_id) AS id FROM d GROUP BY t),
f AS (
  SELECT doc_id, part,
         (len(w) < 50)::INT AS a, (100 * len(list_distinct(w)) < 65 * len(w))::INT AS b,
         (100 * length(regexp_replace(t, '[^A-Z]+', '', 'g')) > 5 * length(t))::INT AS c,
         regexp_matches(t, '[#$%&*|]')::INT AS d, coalesce(first.id < doc_id, false)::INT AS e
  FROM d JOIN first USING (t)),
m AS (
  SELECT part, [a, b, c, d, e] AS bits, count(*) AS n, sum(coalesce(l.good, 0)) AS good, sum(coalesce(l.toxic, 0)) AS toxic
  FROM f LEFT JOIN (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic
                    FROM labels GROUP BY doc_id) l USING (doc_id)
  GROUP BY ALL),
x AS (SELECT unnest([1, 2, 3, 4, 5]) AS i),
orders AS (
  SELECT [p.i, q.i, r.i, s.i, t.i] AS o FROM x p, x q, x r, x s, x t
  WHERE len(list_distinct([p.i, q.i, r.i, s.i, t.i])) = 5),
steps AS (
  SELECT array_to_string([substr('ABCDE', i, 1) for i in o], '') AS filter_order, i AS step, o[i] AS this,
         o[1:i - 1] AS before
  FROM orders, x),
hit AS (
  SELECT part, filter_order, step, n, good, toxic, bits[this] AS fails, list_sum(bits) AS k,
         coalesce(list_max([bits[j] for j in before]), 0) AS gone
  FROM m, steps)
SELECT part, filter_order, step::INT AS step,
       sum(n * (1 - fails) * (1 - gone))::BIGINT AS kept, sum(n * fails * (1 - gone))::BIGINT AS removed,
       sum(n * fails * gone)::BIGINT AS redundant, sum(n * fails * (k = 1)::INT)::BIGINT AS unique_fails,
       sum(good * fails * (1 - gone))::BIGINT AS good_lost, sum(toxic * fails * (1 - gone))::BIGINT AS toxic_lost,
       sum(n * fails * (120 // greatest(k, 1)))::BIGINT AS shapley
FROM hit GROUP BY ALL
"""
