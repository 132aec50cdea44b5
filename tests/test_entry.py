import __spark_entry__ as entry
import pytest

FAST = [
    "usage_by_user_hour", "usage_fanout_minute", "listing_clean", "top5_groups", "corr_matrix",
    "histogram_bins", "keyed_dot", "box_stats", "page_text", "clean_comments",
]

# Results of fitted models and of the studentised range, which SQL has no means to repeat.
UNCHECKED = {
    "group_similarity", "ks_prices", "lasso_cv", "lasso_fit", "lasso_log", "importances", "group_clusters",
    "pca_shares", "pca_loadings", "pca_neighbours", "svd_lowrank", "text_classifier", "batch_scoring",
    "stream_label_windows", "word_factors_learnt",
}


def test_every_sql_twin_belongs_to_a_query():
    queries, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(queries)
    assert all(callable(q) for q in queries.values())
    assert all(isinstance(text, str) for text in sql.values())
    rest = {q for q in queries if q != "pipeline" and not q.startswith("op")} - set(sql)
    assert rest <= UNCHECKED


def test_flagship_query(spark, small):
    rows = entry.entry(spark)
    assert rows.columns == ["email", "usage", "quota", "timestamp"]
    assert rows.count() > 0


@pytest.mark.parametrize("name", FAST)
def test_plans_have_no_cross_join(spark, small, name):
    plan = entry.queries()[name](spark, small)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_scans_read_only_needed_columns(spark, small, capsys):
    entry.queries()["usage_by_app_hour"](spark, small).explain("formatted")
    plan = capsys.readouterr().out
    assert "ReadSchema" in plan and "event_id" not in plan
    entry.queries()["range_cutoffs"](spark, small).explain("formatted")
    plan = capsys.readouterr().out
    assert "GreaterThan(l_extendedprice,5000.0)" in plan and "l_tax" not in plan
