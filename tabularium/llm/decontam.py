"""Benchmark decontamination: a hash set of normalised test n-grams against every training window.

Words are lower-cased (A-Z) runs of letters, digits and characters beyond ASCII. A window is 13
consecutive words of an item; an item with fewer words is one window. Every document window becomes a narrow
row (document, hash, place) that is looked up among the hashes of the test windows by a left-semi join;
only documents with a hash in common get their words back, each place is verified on its words, and what
is left joins the list of documents. Words never travel with the rows of other windows, so the cost is
linear in the length of a text, and the plan is the same at any size: a bitmap of fixed size picks the
documents to read again, Spark broadcasts hashes and hits by their measured size and splits skewed keys. DataFrame functions
only; no Python in the tasks.

Short items are looked up by the hash of their first 1, 2, 4 or 8 words, so at most five window
lengths are hashed, and only those that the items need.

Defined results: null and wordless texts have no words, no hits and are not contaminated; items
without words are skipped. Repeated documents each get their own row; rows that agree in id and text
are worked on once. Items with equal words all count. Extra columns of either table are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabularium.llm.common import UPPER, hash_bitmap, kept_table, table, through_bitmap

N = 13
SHARE = 20  # contaminated when SHARE * n_hit >= n_words
KEY_LENGTHS = (1, 2, 4, 8)
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def word_array(text: Column) -> Column:
    lower = F.translate(F.coalesce(text, F.lit("")), UPPER, UPPER.lower())
    return F.filter(F.split(lower, SEPARATORS), lambda w: w != "")


def windows(items: DataFrame, n: int = N) -> DataFrame:
    """Distinct windows of the items: ``key_len`` words are hashed to ``h``; all words in ``words``."""
    words = items.select("item_id", word_array(F.col("text")).alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - n + 1, F.lit(1)))
    each = words.select("item_id", "w", F.explode(starts).alias("at")).select(
        "item_id", F.slice("w", F.col("at"), n).alias("words")
    )
    size = F.size("words")
    length = F.when(size == n, n)
    for k in reversed(KEY_LENGTHS):
        length = length.when(size >= k, k)
    keyed = each.groupBy("words").agg(F.collect_set("item_id").alias("items")).withColumn("key_len", length)
    return keyed.select(
        "key_len", F.xxhash64(F.slice("words", 1, F.col("key_len"))).alias("h"), "words", "items"
    )


def keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, _s, w): the hash of the text tells rows that share an id apart."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select("doc_id", F.unhex(F.sha2(text, 256)).alias("_s"), word_array(text).alias("w"))


def same_document(a: DataFrame, b: DataFrame) -> Column:
    return a["doc_id"].eqNullSafe(b["_d"]) & (a["_s"] == b["_of"])


def places(docs: DataFrame, lengths: list[int]) -> DataFrame:
    """(doc_id, _s, key_len, h, at): a narrow row per document, key length and start, without the words."""
    kind = "array<struct<key_len:int,h:bigint,at:int>>"

    def keys(w: Column, k: int) -> Column:
        each = F.transform(
            F.sequence(F.lit(1), F.size(w) - k + 1),
            lambda i: F.struct(F.lit(k).alias("key_len"), F.xxhash64(F.slice(w, i, k)).alias("h"), i.alias("at")),
        )
        return F.when(F.size(w) >= k, each).otherwise(F.array().cast(kind))

    # a bound variable holds the words: as a column, the optimiser would split the text again for every window
    every = F.transform(F.array("w"), lambda w: F.concat(F.array().cast(kind), *[keys(w, k) for k in lengths]))
    return keyed(docs).select("doc_id", "_s", F.inline(F.element_at(every, 1)))


def hits(docs: DataFrame, items: DataFrame, n: int = N) -> DataFrame:
    """One row per distinct (doc_id, text) with ``n_words``, ``n_hit``, hit ``spans`` and ``items``.

    ``spans`` are ascending structs (first word, end) counted from 1, one for each place and length of a hit;
    ``copies`` is the number of equal rows.
    """
    tests = kept_table(windows(items, n), "windows")
    lengths = [r[0] for r in tests.select("key_len").distinct().orderBy("key_len").collect()]
    hashes = tests.select("key_len", "h").distinct()
    found = places(docs, lengths).join(hashes, ["key_len", "h"], "left_semi")
    # the few documents with a hash in common get their words back, and with them the words of each place
    starts = found.groupBy(F.col("doc_id").alias("_d"), F.col("_s").alias("_of")).agg(
        F.collect_set(F.struct("key_len", "h", "at")).alias("starts")
    )
    starts = kept_table(starts, "starts")
    text = F.coalesce(F.col("text"), F.lit(""))
    some = docs.select("doc_id", text.alias("text"), F.unhex(F.sha2(text, 256)).alias("_s"))
    some = through_bitmap(some, "_s", hash_bitmap(starts, "_of"))
    own = some.select("doc_id", "_s", word_array(F.col("text")).alias("w"))
    read = own.join(starts, same_document(own, starts)).select(
        "doc_id",
        "_s",
        F.inline(
            F.transform(
                "starts",
                lambda p: F.struct(
                    p["key_len"].alias("key_len"), p["h"].alias("h"), p["at"].alias("at"), F.slice("w", p["at"], n).alias("here")
                ),
            )
        ),
    )
    verified = read.join(tests, ["key_len", "h"]).where(F.slice("here", 1, F.size("words")) == F.col("words"))
    span = F.struct(F.col("at").alias("first"), (F.col("at") + F.size("words")).alias("end"))
    merged = (
        verified.select(F.col("doc_id").alias("_d"), F.col("_s").alias("_of"), span.alias("span"), "items")
        .groupBy("_d", "_of")
        .agg(
            F.sort_array(F.collect_set("span")).alias("spans"),
            F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"),
        )
    )
    merged = kept_table(merged, "hits")
    each = keyed(docs).select("doc_id", "_s", F.size("w").alias("n_words"))
    all_docs = each.groupBy("doc_id", "_s", "n_words").agg(F.count("*").alias("copies"))
    none = lambda c: F.coalesce(c, F.array().cast(merged.schema[c].dataType))
    return all_docs.join(merged, same_document(all_docs, merged), "left").select(
        "doc_id", "_s", "n_words", "copies", none("items").alias("items"), none("spans").alias("spans")
    )


def measured(found: DataFrame) -> DataFrame:
    # spans ascend, so one walk that knows how far the words are counted is enough
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("upto"))
    walk = F.aggregate(
        "spans",
        start,
        lambda acc, s: F.struct(
            (acc["n"] + F.greatest(s["end"] - F.greatest(s["first"], acc["upto"]), F.lit(0))).cast("long").alias("n"),
            F.greatest(acc["upto"], s["end"]).alias("upto"),
        ),
    )
    n_hit = walk["n"]
    return found.withColumn("n_hit", n_hit).withColumn(
        "contaminated", (F.col("n_hit") > 0) & (SHARE * F.col("n_hit") >= F.col("n_words"))
    )


def _contaminated(docs: DataFrame, items: DataFrame, *more: Column) -> DataFrame:
    """Ids and text hashes of contaminated documents, to be joined with the texts."""
    bad = measured(hits(docs, items)).where("contaminated")
    return kept_table(bad.select(F.col("doc_id").alias("__id"), F.col("_s").alias("__key"), *more), "contaminated")


def _is_one_of(docs: DataFrame, stored: DataFrame) -> Column:
    key = F.unhex(F.sha2(F.coalesce(docs["text"], F.lit("")), 256))
    return docs["doc_id"].eqNullSafe(stored["__id"]) & (key == stored["__key"])


def remove_documents(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``docs`` without contaminated rows, columns unchanged. Clean documents all stay."""
    stored = _contaminated(docs, items)
    return docs.join(stored, _is_one_of(docs, stored), "left_anti")


def remove_spans(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``docs`` with hit words cut out of contaminated texts (the rest joined by single spaces, lower-cased)."""
    stored = _contaminated(docs, items, F.col("spans").alias("__spans"))
    words = word_array(docs["text"])
    hit = F.flatten(F.transform(stored["__spans"], lambda s: F.sequence(s["first"], s["end"] - 1)))
    left = F.array_except(F.sequence(F.lit(0), F.size(words)), F.concat(F.array(F.lit(0)), hit))
    rest = F.array_join(F.transform(left, lambda i: F.element_at(words, i)), " ")
    text = F.when(stored["__spans"].isNull(), docs["text"]).otherwise(rest).alias("text")
    joined = docs.join(stored, _is_one_of(docs, stored), "left")
    return joined.select(*[text if c == "text" else docs[c] for c in docs.columns])


def op8_decontamination(spark, sf_dir: str) -> DataFrame:
    found = measured(hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))
    names = F.sort_array(F.transform("items", lambda i: i.cast("string")))
    rows = found.withColumn("_copy", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int"))))
    return rows.select(
        "doc_id",
        F.col("n_words").cast("long").alias("n_words"),
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"),
        "contaminated",
    )


OP8_SQL = r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS r,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (
  SELECT item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
win AS (
  SELECT DISTINCT item_id, array_to_string(w[i:i + 12], ' ') AS g, least(len(w), 13) AS k
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
lens AS (SELECT DISTINCT k FROM win),
grams AS (
  SELECT r, i, k, array_to_string(w[i:i + k - 1], ' ') AS g
  FROM (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, lens WHERE len(w) >= k)),
hit AS (SELECT r, i, k, item_id FROM grams JOIN win USING (g, k)),
words AS (SELECT r, count(DISTINCT p) AS n_hit
          FROM (SELECT r, unnest(range(i, i + k)) AS p FROM (SELECT DISTINCT r, i, k FROM hit)) GROUP BY r),
found AS (SELECT r, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
          FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS id FROM hit) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN words USING (r) LEFT JOIN found USING (r)
"""
