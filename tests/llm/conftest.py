import pytest

DOCUMENTS = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "score string, copy string, lang_pred string, n_words string, component_id string, _text string, items string"
)
LABELS = "doc_id long, quality int, toxic int, text string, score string"
PAGES = "page_id long, url string, html string, text string, n_chars string"
BENCHMARK = "item_id long, text string, doc_id string"
EMBEDDINGS = "vec_id long, embedding array<float>, label int, score string, rank string"

ENGLISH = "the cat sat on the mat and looked at the rain over the long river near town"
GERMAN = "der Hund lag auf der Decke und sah in den Regen über dem breiten Fluss"
LONG = " ".join(f"word{i % 977} und {i}" for i in range(30_000))


def document(doc_id, text, lang="en", source="a"):
    return (doc_id, text, lang, source, len(text or ""), "s", "c", "x", "w", "k", "t", "i")


ODD = [
    document(1, None),
    document(2, ""),
    document(3, " \n\t "),
    document(4, ENGLISH),
    document(4, ENGLISH),
    document(5, ENGLISH),
    document(6, ENGLISH + " again", None, None),
    document(None, GERMAN, "de", "b"),
    document(8, GERMAN, "de", None),
    document(9, LONG, "en", "b"),
    document(10, "12345 !!! ###"),
    document(11, "word"),
    document(12, "日本語のテキスト 😀"),
    document(None, None, None, None),
]


def write(spark, folder, documents, labels, pages, benchmark, embeddings):
    for name, rows, schema in (
        ("documents", documents, DOCUMENTS),
        ("labels", labels, LABELS),
        ("pages", pages, PAGES),
        ("benchmark", benchmark, BENCHMARK),
        ("embeddings", embeddings, EMBEDDINGS),
    ):
        spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


@pytest.fixture(scope="session")
def odd_tables(spark, tmp_path_factory):
    labels = [(4, 1, 0, "x", "s"), (4, 1, 0, "x", "s"), (10, 0, 0, None, None), (9, None, 1, "", ""), (None, 1, 1, "", ""), (99, 0, 0, "", "")]
    pages = [(1, "u", None, "t", "n"), (2, "u", "", "t", "n"), (None, None, "<p>a<p>b", None, None), (3, "u", "x" * 300_000, "t", "n")]
    pages += pages[2:3]
    benchmark = [(1, ENGLISH, "d"), (1, ENGLISH, "d"), (2, "long river near town", "d"), (3, None, None), (4, "!!!", "d"), (None, GERMAN, "d")]
    embeddings = [(i, v, 1, "s", "r") for i, v in enumerate([[1.0, 0.0], [0.0, 1.0], None, [], [0.0, 0.0], [1.0, None], [1.0, 0.0]])]
    embeddings += [(20, [1.0, 1.0], None, None, None)] * 2 + [(None, [1.0, 1.0], None, None, None)]
    return write(spark, tmp_path_factory.mktemp("odd"), ODD, labels, pages, benchmark, embeddings)


@pytest.fixture(scope="session")
def empty_tables(spark, tmp_path_factory):
    return write(spark, tmp_path_factory.mktemp("empty"), [], [], [], [], [])
