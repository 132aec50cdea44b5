"""The pipeline against its stages redone by hand on the smallest tables."""

import corpus_pipeline as pipeline
from tabularium.llm import langid, quality
from tabularium.llm.common import table
from .test_texts import brute_components, brute_hits


def test_stages_by_brute_force(spark, small):
    docs = table(spark, small, "documents")
    columns = docs.columns
    names = [n for n, _ in pipeline.STAGES]
    assert names == ["quality", "language", "near_dedup", "decontaminate", "mix"]
    kept = []
    for _, stage in pipeline.STAGES:
        docs = pipeline.kept_table(stage(spark, docs, small), "test-stage")
        assert docs.columns == columns
        kept.append({r["doc_id"]: r["text"] for r in docs.collect()})
    first = table(spark, small, "documents")
    scores = quality.predict(first, quality.fit(first, table(spark, small, "labels"))).collect()
    assert set(kept[0]) == {r["doc_id"] for r in scores if r["score"] >= 0.3}
    second = first.where(first["doc_id"].isin(list(kept[0])))
    langs = langid.predict(second, langid.fit(second)).collect()
    assert set(kept[1]) == {r["doc_id"] for r in langs if r["lang_pred"] != "und" and r["score"] >= 0.5}
    component, _ = brute_components(kept[1], 5)
    assert set(kept[2]) == set(component.values())
    items = [(r["item_id"], r["text"]) for r in table(spark, small, "benchmark").collect()]
    clean = set()
    for i, text in kept[2].items():
        n, k, _ = brute_hits(text, items)
        if not (k > 0 and 20 * k >= n):
            clean.add(i)
    assert set(kept[3]) == clean
    assert set(kept[4]) <= clean and len(kept[4]) > 0


def test_run_applies_all_stages(spark, small):
    got = pipeline.run(spark, small)
    assert got.columns == table(spark, small, "documents").columns
    again = pipeline.run(spark, small)
    rows = lambda df: sorted(map(str, df.collect()))
    assert rows(got) == rows(again)
