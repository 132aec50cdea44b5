"""Nulls, empty and long texts, repeated rows, empty tables and clashing column names, for every query."""

import hashlib

import corpus_pipeline
import pytest
from pyspark.sql import functions as F
from tabularium.llm import setsketch
from tabularium.llm.queries import QUERIES

OTHER_ROWS = ("op1_main_text", "op5_license_scan", "op9_mixture", "op11_nearest_neighbours", "op12_filter_audit")
ONE_PER_DOCUMENT = [q for q in QUERIES if q not in OTHER_ROWS]


@pytest.fixture(scope="module")
def results(spark, odd_tables):
    cache = {}

    def get(name):
        if name not in cache:
            cache[name] = QUERIES[name](spark, odd_tables).collect()
        return cache[name]

    return get


@pytest.mark.parametrize("name", ONE_PER_DOCUMENT)
def test_one_row_per_document(results, name):
    rows = results(name)
    ids = sorted((r["doc_id"] for r in rows), key=lambda x: (x is None, x))
    assert ids == [1, 2, 3, 4, 4, 5, 6, 8, 9, 10, 11, 12, None, None]


@pytest.mark.parametrize("name", list(QUERIES))
def test_empty_tables_give_empty_results(spark, empty_tables, odd_tables, name):
    got = QUERIES[name](spark, empty_tables)
    assert got.count() == 0
    assert got.columns == QUERIES[name](spark, odd_tables).columns


def of(rows, doc_id):
    return [r for r in rows if r["doc_id"] == doc_id]


def test_pages(results):
    rows = {(r["page_id"], r["text"], r["n_chars"]) for r in results("op1_main_text")}
    assert rows == {(1, "", 0), (2, "", 0), (None, "a\n\nb", 4), (3, "x" * 300_000, 300_000)}
    assert len(results("op1_main_text")) == 5


def test_language(results):
    rows = results("op2_language_id")
    assert all(of(rows, i)[0]["lang_pred"] == "und" and of(rows, i)[0]["score"] == 0 for i in (1, 2, 3, 10))
    assert of(rows, 4)[0] == of(rows, 4)[1]
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_lm(results):
    rows = results("op3_lm_scores")
    assert [of(rows, i)[0]["n_tokens"] for i in (1, 2, 3, 4, 11)] == [1, 1, 1, 18, 2]
    assert of(rows, 4)[0] == of(rows, 4)[1]
    assert all(r["score"] < 0 and r["n_known"] <= r["n_tokens"] for r in rows)


def test_fingerprints(results):
    rows = results("op4_fingerprints")
    assert of(rows, 1)[0]["fingerprint"] == of(rows, 2)[0]["fingerprint"]
    assert of(rows, 4)[0]["fingerprint"] == of(rows, 5)[0]["fingerprint"]
    assert of(rows, 5)[0]["near_next"] == 1.0 and of(rows, 2)[0]["near_next"] == 1.0
    assert all(0 <= r["near_edited"] <= 1 for r in rows)


def test_near_duplicates(results):
    rows = results("op6_near_duplicates")
    assert [of(rows, i)[0]["component_id"] for i in (1, 2, 3, 4, 5, 6)] == [1, 2, 3, 4, 4, 4]
    assert [of(rows, i)[0]["n_shingles"] for i in (1, 2, 3, 11, 4)] == [0, 0, 0, 1, 14]
    assert all(r["component_id"] is None and r["kept"] for r in rows if r["doc_id"] is None)


def test_quality(results):
    rows = results("op7_quality")
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in rows)


def test_decontamination(results):
    rows = results("op8_decontamination")
    assert of(rows, 1)[0]["n_words"] == 0 and not of(rows, 1)[0]["contaminated"]
    four = of(rows, 4)[0]
    assert (four["n_words"], four["n_hit"], four["n_items"], four["contaminated"]) == (17, 17, 2, True)


def test_mixture(results):
    rows = results("op9_mixture")
    assert all(r["copy"] >= 0 for r in rows)
    by_id = {}
    for r in rows:
        by_id.setdefault((r["doc_id"], r["text"]), []).append(r["copy"])
    assert all(sorted(set(c)) == list(range(max(c) + 1)) for c in by_id.values())
    assert by_id.get((4, rows and next((r["text"] for r in rows if r["doc_id"] == 4), "")), [0, 0]).count(0) == 2


def test_tokens(results):
    rows = results("op10_token_counts")
    assert [of(rows, i)[0]["n_tokens"] for i in (1, 2, 3)] == [0, 0, 0]
    assert all(r["n_tokens"] >= r["n_words"] for r in rows)


def test_neighbours(results):
    """Copies tie and the smaller id leads; vectors without a direction take no part."""
    rows = [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in results("op11_nearest_neighbours")]
    expected = [(0, 1, 6, 1.0), (0, 2, 20, 1.0), (0, 3, 1, 0.0), (20, 1, 0, 1.0), (20, 2, 1, 1.0), (20, 3, 6, 1.0)]
    assert sorted(rows) == expected


def test_filter_audit(results):
    rows = [r for r in results("op12_filter_audit") if r["filter_order"] == "EABCD"]
    assert sorted({r["part"] for r in rows}) == ["", "a", "b"]
    first = {r["part"]: (r["kept"], r["removed"]) for r in rows if r["step"] == 1}
    assert first == {"a": (7, 2), "b": (2, 0), "": (3, 0)}


def test_alignment(results):
    rows = results("op13_token_alignment")
    assert all(of(rows, i)[0]["n_links"] == 0 and of(rows, i)[0]["groups_sha256"] == "" for i in (1, 2))
    assert of(rows, 4)[0] == of(rows, 4)[1]
    assert all(r["n_links"] == r["n_a"] + r["n_b"] - r["n_groups"] for r in rows)


def test_pipeline(spark, odd_tables, empty_tables):
    got = corpus_pipeline.run(spark, odd_tables)
    assert got.columns == spark.read.parquet(f"{odd_tables}/documents.parquet").columns
    assert not {4, 5} & {r["doc_id"] for r in got.collect()}  # contaminated
    assert corpus_pipeline.run(spark, empty_tables).count() == 0


def test_one_of_several_texts_with_the_same_id_stays(spark):
    rows = [(1, "one two three four five six", "b"), (1, "other words that say something else", "a"), (2, None, "x"),
            (2, "a text of its own for the second id", "y"), (3, "same", "q"), (3, "same", "p")]
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = {(1, min((t for i, t, _ in rows if i == 1), key=digest)), (2, rows[3][1]), (3, "same")}
    for parts in (1, 4):
        for given in (rows, rows[::-1]):
            docs = spark.createDataFrame(given, "doc_id long, text string, source string").repartition(parts)
            got = setsketch.deduplicate(docs).collect()
            assert {(r["doc_id"], r["text"]) for r in got} == want and len(got) == 3
            assert [r["source"] for r in got if r["doc_id"] == 3] == ["p"]


CLASHING = "__text __score __lang __id __kept __n __key __parts __h __row _id _h y x n_words kept label".split()


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_carry_columns_with_names_of_their_own(spark, small, name, stage):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    more = docs.select("*", *[F.concat(F.lit(c), F.col("doc_id").cast("string")).alias(c) for c in CLASHING])
    got = stage(spark, more, small)
    assert got.columns == more.columns
    plain = sorted(r["doc_id"] for r in stage(spark, docs, small).collect())
    rows = got.collect()
    assert sorted(r["doc_id"] for r in rows) == plain
    assert all(r[c] == f"{c}{r['doc_id']}" for r in rows for c in CLASHING)
