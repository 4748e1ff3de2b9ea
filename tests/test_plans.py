"""Plan guards: no query of the catalogue plans a Cartesian product or nested-loop join,
filters reach the parquet scan, and top-1 / top-k windows run a partial group limit."""

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
FITS = {"fit_logistic", "prediction_fitted", "fit_forest", "fit_gbt", "feature_importance", "feature_sets", "model_registry_scan",
        "latest_quote_stream", "scan_history_csv", "latest_quote_keyed", "select_k_20", "forest_windows", "boosting_losses", "model_choice",
        "window_models", "prediction_models", "window_tree"}


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(E.queries()) - FITS))
def test_no_cartesian_or_nested_loop(spark, name):
    plan = _plan(E.queries()[name](spark, SF))
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def test_completed_rule_pushed_to_scan(spark):
    df = E.queries()["completed_matches"](spark, SF)
    text = df._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "PushedFilters: [IsNotNull(o_orderdate), LessThan(o_orderdate" in text


def test_latest_row_number_uses_partial_group_limit(spark):
    df = E.queries()["latest_quote"](spark, SF)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert "WindowGroupLimit" in _plan(df)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_bucketed_quotes_need_no_shuffle(spark):
    import tempfile

    from oddsframe.operators.matches import match_frame
    from oddsframe.operators.quotes import latest_per_key
    from oddsframe.sources.tables import QUOTE_PAYLOAD, fixture_tables, load_tables, save_bucketed
    root = tempfile.mkdtemp(prefix="bucketed-")
    save_bucketed(spark, fixture_tables(spark, SF), "oddsframe_test_db", root, 8)
    t = load_tables(spark, "oddsframe_test_db", fmt="table")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "8k")  # dimensions only
    try:
        latest = _plan(latest_per_key(t.ou, QUOTE_PAYLOAD["ou"]))
        assert "Exchange" not in latest
        frame = _plan(match_frame(t))
        # only the dimension broadcasts remain; matches and quote aggregates are co-bucketed
        assert "Exchange hashpartitioning" not in frame
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    base = fixture_tables(spark, SF)
    a, b = match_frame(base), match_frame(t)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
