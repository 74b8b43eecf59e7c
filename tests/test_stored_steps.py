"""Steps that a query needs more than once are computed once: their readers read what was stored."""

import pytest
from kestrel.operators import ml as ML
from kestrel.plans import catalog
from tests.conftest import SF_SMALL


def reads_driver_tables(df):
    return [f for f in df.inputFiles() if SF_SMALL in f]


@pytest.mark.parametrize("query", ["rf_metrics", "rf_predictions", "model_round_trip", "stream_predict"])
def test_forest_reads_stored_gold(spark, monkeypatch, query):
    """Gold is computed once; training, test and scored rows come from the stored copy."""
    gold, fit, calls, trained = catalog.gold_sales, ML.fit_classifier, [], []

    def counted(spark, sf_dir):
        calls.append(1)
        return gold(spark, sf_dir)

    def small_forest(train, **kw):
        trained.append(reads_driver_tables(train))
        return fit(train, trees=3, depth=2)

    monkeypatch.setattr(catalog, "gold_sales", counted)
    monkeypatch.setattr(ML, "fit_classifier", small_forest)
    out = catalog.REGISTRY[query](spark, SF_SMALL)
    assert calls == [1] and trained == [[]] and not reads_driver_tables(out)
    assert out.count() > 0


@pytest.mark.parametrize("query", ["baseline_classifier_metrics", "baseline_regression_metrics"])
def test_baselines_read_stored_gold(spark, query):
    assert not reads_driver_tables(catalog.REGISTRY[query](spark, SF_SMALL))


@pytest.mark.parametrize("query", ["suggested_rules", "parse_rules", "evaluate_rules", "rules_end_to_end"])
def test_rules_read_stored_silver(spark, monkeypatch, query):
    """Each silver table is computed once, for its profile, its value sets and the rules evaluated on it."""
    silver, calls = catalog.silver, []

    def counted(spark, sf_dir, feed):
        calls.append(feed)
        return silver(spark, sf_dir, feed)

    monkeypatch.setattr(catalog, "silver", counted)
    out = catalog.REGISTRY[query](spark, SF_SMALL)
    assert sorted(calls) == sorted(catalog.FEEDS) and not reads_driver_tables(out)
