"""Comment, vocabulary, classifier and page queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabularium.functions import text as tx
from tabularium.functions.columns import as_wall_clock, fixed
from tabularium.operators import log_odds, model_store, similarity, splits
from tabularium.operators import text as ops
from tabularium.plans.common import fixed_sql, with_ctes
from tabularium.session import new_folder, stored
from tabularium.sources import shapes
from tabularium.sources import text as io
from tabularium.streaming import scoring
from tabularium.streaming.usage import batch_folder_writer, write_stream_batches

MIN_COSINE = 0.8
VECTOR_SIZE = 300
PROBE_PAGE = 7


def _cleaned(spark: SparkSession, sf: str) -> DataFrame:
    return ops.clean_comments(shapes.comments(spark, sf))


def _labelled(spark: SparkSession, sf: str) -> DataFrame:
    """The cleaned comments somebody has labelled."""
    return _cleaned(spark, sf).filter(F.col("label") != tx.UNDEFINED)


def clean_comments(spark: SparkSession, sf: str) -> DataFrame:
    df = _cleaned(spark, sf)
    return df.select("doc_id", "text", "label", tx.training_line("text", "label").alias("line"))


def bucket_split(spark: SparkSession, sf: str) -> DataFrame:
    df = splits.comment_splits(shapes.table(spark, sf, "documents"), "doc_id")
    return splits.with_split(
        df, "doc_id", {"first": 70, "second": 30}, "pair", "half"
    ).select("doc_id", "split", "half")


def text_shards(spark: SparkSession, sf: str) -> DataFrame:
    """Cleaned lines written per split as text shards, read back as labelled parts, counted."""
    root = new_folder(spark, "shards")
    split = splits.comment_splits(_labelled(spark, sf), "doc_id")
    lines = split.select(tx.training_line("text", "label").alias("value"), "split")
    lines.write.partitionBy("split").text(root)
    parts = [
        io.read_labelled_parts(spark, f"{root}/split={name}").withColumn("split", F.lit(name))
        for name in ("train", "eval", "test")
    ]
    whole = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return whole.groupBy("split", "label").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("chars")
    )


def token_vocab(spark: SparkSession, sf: str) -> DataFrame:
    return ops.vocabulary(_cleaned(spark, sf))


def padded_sequences(spark: SparkSession, sf: str) -> DataFrame:
    df = stored(_cleaned(spark, sf))
    out = ops.padded_sequences(df, ops.vocabulary(df), "doc_id", all_known=True)
    return out.select("doc_id", F.array_join("sequence", " ").alias("sequence"))


def label_index(spark: SparkSession, sf: str) -> DataFrame:
    return ops.label_index(_labelled(spark, sf).select("doc_id", "label"), "label")


def word_vectors(spark: SparkSession, sf: str) -> DataFrame:
    """Vectors aligned to the vocabulary, zeros for words below the minimum count."""
    df = stored(_cleaned(spark, sf))
    vocab = stored(ops.vocabulary(df))
    table = ops.embedding_table(vocab, ops.context_counts(df, vocab, size=VECTOR_SIZE), VECTOR_SIZE)
    values = F.transform("vector", lambda v: v.cast("int"))
    return table.select("word", "index", F.array_join(values, " ").alias("vector"))


def _train_and_rest(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    df = splits.comment_splits(stored(_labelled(spark, sf)), "doc_id")
    inside = F.col("split") == "train"
    return df.filter(inside), df.filter(~inside)


#: Folders of the models that this session has published, by application, tables and kind.
_published: dict[tuple[str, str, str], str] = {}


def _store(spark: SparkSession, sf: str, kind: str, publish) -> str:
    """The model store of ``kind``; where nobody has published a model yet, ``publish(root)`` does."""
    key = spark.sparkContext.applicationId, sf, kind
    if key not in _published:
        _published[key] = new_folder(spark, kind)
    if not model_store.versions(spark, _published[key]):
        publish(_published[key])
    return _published[key]


def _classifier(spark: SparkSession, sf: str):
    """The published classifier, loaded from its store."""

    def publish(root: str) -> None:
        model_store.publish_pipeline(ops.fit_classifier(_train_and_rest(spark, sf)[0]), spark, root)

    return model_store.load_pipeline(spark, _store(spark, sf, "classifier", publish))


def _weights(spark: SparkSession, sf: str) -> DataFrame:
    """The published word weights, loaded from their store."""

    def publish(root: str) -> None:
        model_store.publish_table(log_odds.fit_log_odds(_train_and_rest(spark, sf)[0]), root)

    return model_store.load_table(spark, _store(spark, sf, "weights", publish))


def text_classifier(spark: SparkSession, sf: str) -> DataFrame:
    _, rest = _train_and_rest(spark, sf)
    return ops.evaluate_classifier(_classifier(spark, sf), rest.filter(F.col("split") == "eval"))


def batch_scoring(spark: SparkSession, sf: str) -> DataFrame:
    """All documents cleaned, scored with the loaded model and written as JSON lines, then read back."""
    documents = shapes.documents(spark, sf).select(tx.clean_text("text").alias("text"))
    root = new_folder(spark, "predictions")
    io.write_json_lines(ops.score(_classifier(spark, sf), documents), root)
    return spark.read.schema("text string, label string, score double").json(root)


def loaded_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Label and score of every document from loaded word weights."""
    documents = shapes.documents(spark, sf).select("doc_id", tx.clean_text("text").alias("text"))
    scored = log_odds.score_log_odds(_weights(spark, sf), documents)
    return scored.select("doc_id", "label", fixed("score", 6).alias("score"))


def _message_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as a message stream, one per second of event time."""
    stream = shapes.table_stream(spark, sf, "documents")
    return stream.select(
        F.timestamp_seconds(F.lit(1704067200) + F.col("doc_id")).alias("timestamp"),
        F.encode("text", "UTF-8").alias("value"),
    )


def stream_scored_windows(spark: SparkSession, sf: str) -> DataFrame:
    """Messages per 15 second window: how many had no usable text, how many a label that fits their score.

    Not checked: which of the two labels a message gets.
    """
    return (
        _scored_messages(spark, sf)
        .groupBy(as_wall_clock("m.window_start").alias("window_start"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if(F.col("m.label") == tx.UNDEFINED).alias("undefined"),
            F.count_if(F.col("m.label") == tx.label_of_score(F.col("m.score"))).alias("labelled"),
            F.sum(F.length("m.text")).alias("chars"),
        )
    )


def stream_label_windows(spark: SparkSession, sf: str) -> DataFrame:
    """Messages per 15 second window and label."""
    window = as_wall_clock("m.window_start").alias("window_start")
    return _scored_messages(spark, sf).groupBy(window, F.col("m.label").alias("label")).agg(
        F.count(F.lit(1)).alias("n")
    )


def _scored_messages(spark: SparkSession, sf: str) -> DataFrame:
    """The message stream scored, written to its sink and read back."""
    return _through_sink(spark, scoring.score_messages(_message_stream(spark, sf), _classifier(spark, sf)))


def stream_loaded_windows(spark: SparkSession, sf: str) -> DataFrame:
    """Messages of a stream per 15 second window and label, scored with loaded word weights."""
    weights = _weights(spark, sf)
    scored = scoring.in_windows(
        _message_stream(spark, sf), lambda messages: log_odds.score_log_odds(weights, messages)
    )
    window = as_wall_clock("m.window_start").alias("window_start")
    return _through_sink(spark, scored).groupBy(window, F.col("m.label").alias("label")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(fixed("m.score", 6)).alias("total")
    ).withColumn("total", fixed("total", 4))


def _through_sink(spark: SparkSession, scored: DataFrame) -> DataFrame:
    """Scored messages written to their sink and read back."""
    root = new_folder(spark, "scored")
    topic = scoring.to_topic(scored)
    write_stream_batches(
        topic, batch_folder_writer(f"{root}/data"), f"{root}/state"
    ).awaitTermination()
    fields = "text string, label string, score double, window_start timestamp"
    return spark.read.parquet(f"{root}/data").select(
        F.from_json(F.decode("value", "UTF-8"), fields).alias("m")
    )


def page_text(spark: SparkSession, sf: str) -> DataFrame:
    return shapes.pages(spark, sf).select(
        "page_id", "url", tx.html_text("html").alias("text")
    )


def page_content(spark: SparkSession, sf: str) -> DataFrame:
    """Text per site page address without its query and fragment, the latest page wins."""
    pages = shapes.pages(spark, sf).withColumn(
        "url", F.regexp_replace("url", "[?#].*$", "")
    )
    return io.pages_to_content(pages)


def _page_sets(spark: SparkSession, sf: str) -> DataFrame:
    return page_text(spark, sf).select("page_id", tx.token_set("text").alias("tokens"))


def page_tokens(spark: SparkSession, sf: str) -> DataFrame:
    return page_text(spark, sf).select(
        "page_id",
        F.size(tx.tokens("text")).alias("n_tokens"),
        F.size(tx.token_set("text")).alias("n_distinct"),
        F.size(tx.token_set("text", strip_punct=True)).alias("n_stripped"),
    )


def page_cosine_pairs(spark: SparkSession, sf: str) -> DataFrame:
    sets = similarity.distinct_sets(_page_sets(spark, sf), "page_id", "tokens")
    pairs = similarity.cosine_pairs(sets, MIN_COSINE)
    return pairs.select(
        "set_a", "set_b", "copies_a", "copies_b", "shared", "united",
        F.round("cosine", 3).alias("cosine"),
    )


def page_cosine_to(spark: SparkSession, sf: str) -> DataFrame:
    """One page against all others: size of the token union, 0/1 vectors and cosine, no bound."""
    sets = _page_sets(spark, sf).withColumn("tokens", F.array_sort(F.array_distinct("tokens")))
    found = similarity.cosine_with_set(sets, "page_id", "tokens", PROBE_PAGE)
    ones = lambda v: F.array_join(F.transform(v, lambda x: x.cast("int")), "")
    return found.select(
        "page_id",
        F.size("union").alias("united"),
        ones("vector_a").alias("probe_vector"),
        ones("vector_b").alias("page_vector"),
        "cosine",
    )


def comment_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Comments written as ISO-8859-1 JSON lines and read back through the annotation parser."""
    root = new_folder(spark, "latin1")
    comments = shapes.comments(spark, sf)
    line = F.to_json(F.struct("doc_id", "content", "annotation"))
    # what the character set lacks becomes "?", as any writer of it does
    narrow = F.regexp_replace(line, "[^\\u0000-\\u00ff]", "?")
    narrow_lines = comments.select(narrow.alias("value"))
    io.write_lines_latin1(narrow_lines, "value", root)
    lines = io.read_text_latin1(spark, root)
    keys = F.get_json_object("value", "$.doc_id").cast("long").alias("doc_id")
    return io.parse_comments(lines, keys).select(
        "doc_id", F.length("content").alias("chars"), F.md5("content").alias("digest"), "label"
    )


def page_copies(spark: SparkSession, sf: str) -> DataFrame:
    return similarity.set_members(_page_sets(spark, sf), "page_id", "tokens")


QUERIES = {
    f.__name__: f
    for f in (
        clean_comments,
        bucket_split,
        text_shards,
        token_vocab,
        padded_sequences,
        label_index,
        word_vectors,
        text_classifier,
        batch_scoring,
        loaded_scores,
        stream_loaded_windows,
        stream_scored_windows,
        stream_label_windows,
        page_text,
        page_content,
        page_tokens,
        page_cosine_pairs,
        page_copies,
        page_cosine_to,
        comment_lines,
    )
}


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _tokens_sql(column: str) -> str:
    words = ", ".join(_quoted(w) for w in tx.STOP_WORDS)
    plain = f"regexp_replace(lower({column}), {_quoted(tx.COMMENT_NOISE)}, ' ', 'g')"
    return (
        f"list_filter(string_split({plain}, ' '), lambda t: t <> '' AND t NOT IN ({words}))"
    )


_CLEANED = f"""cleaned AS (SELECT doc_id, array_to_string({_tokens_sql('text')}, ' ') AS text,
    CASE WHEN toxic = 1 THEN 'TROLL' WHEN toxic = 0 THEN 'NO_TROLL' ELSE 'undefined' END AS label
  FROM documents LEFT JOIN labels USING (doc_id))"""

_LABELLED = _CLEANED.replace("LEFT JOIN", "JOIN")


def _bucket(salt: str) -> str:
    return f"CAST('0x' || substr(md5('{salt}' || doc_id), 1, 8) AS BIGINT) % 100"


_SPLIT = f"""CASE WHEN {_bucket('test')} < 25 THEN 'test' WHEN {_bucket('eval')} < 20 THEN 'eval'
  ELSE 'train' END"""

_VOCAB = """words AS (SELECT doc_id, unnest(string_split(text, ' ')) AS word,
    generate_subscripts(string_split(text, ' '), 1) AS pos FROM cleaned),
counts AS (SELECT word, count(*) AS n FROM words WHERE word <> '' GROUP BY 1),
vocab AS (SELECT word, n, row_number() OVER (ORDER BY n DESC, word) AS index FROM counts)"""

_LOADED = f"""marked AS (SELECT doc_id, text, label, {_SPLIT} AS split FROM cleaned),
train AS (SELECT doc_id, text, (label = 'TROLL')::INT AS troll FROM marked
  WHERE label <> 'undefined' AND split = 'train'),
terms AS (SELECT doc_id, CAST('0x' || substr(md5(word), 1, 8) AS BIGINT) % {log_odds.FEATURES} AS bucket
  FROM (SELECT doc_id, unnest(string_split(text, ' ')) AS word FROM cleaned) WHERE word <> ''),
seen AS (SELECT bucket, sum(troll) + 1.0 AS t, sum(1 - troll) + 1.0 AS n
  FROM train JOIN terms USING (doc_id) GROUP BY 1),
totals AS (SELECT sum(t - 1) + {log_odds.FEATURES} AS t, sum(n - 1) + {log_odds.FEATURES} AS n FROM seen),
base AS (SELECT ln(CAST(sum(troll) + 1 AS DOUBLE)) - ln(CAST(sum(1 - troll) + 1 AS DOUBLE)) AS b FROM train),
sums AS (SELECT doc_id, sum(ln(CAST(coalesce(seen.t, 1) AS DOUBLE) / totals.t)
    - ln(CAST(coalesce(seen.n, 1) AS DOUBLE) / totals.n)) AS z
  FROM terms LEFT JOIN seen USING (bucket), totals GROUP BY 1),
scored AS (SELECT doc_id, coalesce(1.0::DOUBLE / (1 + exp(-(z + b))), 0) AS p, z IS NULL AS empty
  FROM cleaned LEFT JOIN sums USING (doc_id), base),
labelled AS (SELECT doc_id, p, CASE WHEN empty THEN 'undefined' WHEN p < 0.5 THEN 'NO_TROLL' ELSE 'TROLL' END
  AS label FROM scored)"""

_PAGES = f"""plain AS (SELECT page_id, url, regexp_replace(regexp_replace(html,
    {_quoted(tx.HIDDEN)}, '', 'g'), {_quoted(tx.TAGS)}, '', 'g') AS t FROM pages),
texts AS (SELECT page_id, url, regexp_replace(replace(replace(replace(replace(replace(replace(t,
    '&copy;', chr(169)), '&middot;', chr(183)), '&quot;', '"'), '&lt;', '<'), '&gt;', '>'),
    '&amp;', '&'), {_quoted(tx.SPACES)}, ' ', 'g') AS text FROM plain)"""

_SETS = """bags AS (SELECT page_id, list_sort(list_distinct(string_split(lower(text), ' '))) AS tokens
  FROM texts),
sets AS (SELECT min(page_id) AS set_id, tokens, count(*) AS copies FROM bags GROUP BY tokens)"""

SQL = {
    "loaded_scores": with_ctes(_CLEANED, _LOADED)
    + f"SELECT doc_id, label, {fixed_sql('p', 6)} AS score FROM labelled",
    "stream_loaded_windows": with_ctes(_CLEANED, _LOADED)
    + f"""SELECT time_bucket(INTERVAL 15 SECOND, TIMESTAMP '2024-01-01' + to_seconds(doc_id)) AS window_start,
  label, count(*) AS n, {fixed_sql(f"sum({fixed_sql('p', 6)})", 4)} AS total FROM labelled GROUP BY 1, 2""",
    "clean_comments": with_ctes(_CLEANED)
    + "SELECT doc_id, text, label, text || ', ' || label AS line FROM cleaned",
    "bucket_split": f"""SELECT doc_id, {_SPLIT} AS split,
  CASE WHEN {_bucket('pair')} < 70 THEN 'first' ELSE 'second' END AS half FROM documents""",
    "text_shards": with_ctes(_LABELLED)
    + f"""SELECT {_SPLIT} AS split, label, count(*) AS n, CAST(sum(length(text)) AS BIGINT) AS chars
FROM cleaned WHERE text <> '' GROUP BY ALL""",
    "token_vocab": with_ctes(_CLEANED, _VOCAB) + "SELECT word, n, index FROM vocab",
    "padded_sequences": with_ctes(
        _CLEANED,
        _VOCAB,
        """seqs AS (SELECT doc_id, list(index ORDER BY pos) AS s FROM words
  JOIN vocab USING (word) GROUP BY 1),
padded AS (SELECT c.doc_id, list_concat(list_transform(range(300), lambda x: 0::BIGINT),
    coalesce(s, [])) AS s FROM cleaned c LEFT JOIN seqs USING (doc_id))""",
    )
    + "SELECT doc_id, array_to_string(s[len(s) - 299:], ' ') AS sequence FROM padded",
    "word_vectors": with_ctes(
        _CLEANED,
        _VOCAB,
        """kept AS (SELECT doc_id, word, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS spot,
    CAST('0x' || substr(md5(word), 1, 8) AS BIGINT) % 300 + 1 AS dim,
    CASE WHEN CAST('0x' || substr(md5(word), 9, 1) AS INTEGER) % 2 = 1 THEN -1 ELSE 1 END AS sign
  FROM words WHERE word <> ''),
near AS (SELECT a.word, b.dim, CAST(sum(b.sign) AS BIGINT) AS value FROM kept a
  JOIN (SELECT word FROM vocab WHERE n >= 10) f USING (word)
  JOIN (SELECT doc_id, dim, sign, spot, unnest(range(-7, 8)) AS gap FROM kept) b
    ON a.doc_id = b.doc_id AND b.spot = a.spot + b.gap AND b.gap <> 0
  GROUP BY ALL),
cells AS (SELECT word, index, d.dim FROM vocab, (SELECT unnest(range(1, 301)) AS dim) d)""",
    )
    + """SELECT word, index, string_agg(CAST(coalesce(value, 0) AS VARCHAR), ' ' ORDER BY c.dim) AS vector
FROM cells c LEFT JOIN near USING (word, dim) GROUP BY ALL""",
    "label_index": with_ctes(_LABELLED)
    + """SELECT doc_id, label, CAST(dense_rank() OVER (ORDER BY label) - 1 AS INTEGER) AS label_index
FROM cleaned""",
    "stream_scored_windows": f"""SELECT
  time_bucket(INTERVAL 15 SECOND, make_timestamp((1704067200 + doc_id) * 1000000)) AS window_start,
  count(*) AS n, count(*) FILTER (len({_tokens_sql('text')}) = 0) AS undefined,
  count(*) FILTER (len({_tokens_sql('text')}) > 0) AS labelled,
  CAST(sum(length(text)) AS BIGINT) AS chars FROM documents GROUP BY 1""",
    "page_text": with_ctes(_PAGES) + "SELECT page_id, url, text FROM texts",
    "page_content": with_ctes(_PAGES)
    + """SELECT url, arg_max(text, page_id) AS text
FROM (SELECT page_id, regexp_replace(url, '[?#].*$', '') AS url, text FROM texts) GROUP BY 1""",
    "page_tokens": with_ctes(_PAGES)
    + f"""SELECT page_id, CAST(len(string_split(lower(text), ' ')) AS INTEGER) AS n_tokens,
  CAST(len(list_distinct(string_split(lower(text), ' '))) AS INTEGER) AS n_distinct,
  CAST(len(list_distinct(string_split(translate(lower(text), {_quoted(tx.PUNCTUATION)}, ''), ' ')))
    AS INTEGER) AS n_stripped FROM texts""",
    "page_cosine_pairs": with_ctes(_PAGES, _SETS)
    + f"""SELECT a.set_id AS set_a, b.set_id AS set_b, a.copies AS copies_a, b.copies AS copies_b,
  CAST(len(list_intersect(a.tokens, b.tokens)) AS INTEGER) AS shared,
  CAST(len(a.tokens) + len(b.tokens) - len(list_intersect(a.tokens, b.tokens)) AS INTEGER) AS united,
  round(len(list_intersect(a.tokens, b.tokens)) / sqrt(len(a.tokens)::DOUBLE * len(b.tokens)), 3)
    AS cosine
FROM sets a JOIN sets b ON a.set_id < b.set_id
WHERE len(list_intersect(a.tokens, b.tokens)) / sqrt(len(a.tokens)::DOUBLE * len(b.tokens))
  >= {MIN_COSINE}::DOUBLE""",
    "page_cosine_to": with_ctes(_PAGES, _SETS.split("\nsets AS")[0].rstrip().rstrip(","))
    + f"""SELECT b.page_id, CAST(len(u) AS INTEGER) AS united,
  array_to_string(list_transform(u, lambda x: CASE WHEN list_contains(p.tokens, x) THEN 1 ELSE 0 END), '')
    AS probe_vector,
  array_to_string(list_transform(u, lambda x: CASE WHEN list_contains(b.tokens, x) THEN 1 ELSE 0 END), '')
    AS page_vector,
  round(len(list_intersect(p.tokens, b.tokens)) / sqrt(len(p.tokens)::DOUBLE * len(b.tokens)), 3) AS cosine
FROM (SELECT b.*, list_concat(p.tokens, list_filter(b.tokens, lambda x: NOT list_contains(p.tokens, x))) AS u,
        p AS p FROM bags b, (SELECT tokens FROM bags WHERE page_id = {PROBE_PAGE}) p
      WHERE b.page_id <> {PROBE_PAGE}) b""",
    "comment_lines": """SELECT doc_id, CAST(length(t) AS INTEGER) AS chars, md5(t) AS digest,
  CAST(toxic AS VARCHAR) AS label
FROM (SELECT doc_id, regexp_replace(text, '[^\\x{00}-\\x{ff}]', '?', 'g') AS t, toxic
      FROM documents LEFT JOIN labels USING (doc_id))""",
    "page_copies": with_ctes(_PAGES, _SETS)
    + "SELECT page_id, set_id FROM bags JOIN sets ON bags.tokens = sets.tokens",
}
