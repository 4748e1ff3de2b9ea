"""Fitted predictions: one record per request, errors and fallbacks as values."""

import math

import pytest

from oddsframe import config
from oddsframe.operators import score as S


@pytest.fixture(scope="module")
def records(spark):
    frame = spark.createDataFrame(
        [(1, 1, 2000, 1, 1.9, 1.9, {"a": 2.0, "b": 1.0}), (2, 1, 2000, 2, 1.9, 1.9, {"a": 2.0, "b": None}),
         (3, 1, 1999, 4, 1.9, 1.9, {"a": 2.0, "b": 1.0}), (4, 1, 2000, 1, None, 1.9, {"a": 2.0}),
         (5, 9, 2000, 1, 1.9, 1.9, {"a": 2.0}), (6, 2, 2000, 1, 1.9, 1.9, {}), (7, 1, None, None, 1.9, 1.9, {"a": 1.0})],
        "event_id long, event_type_id int, season_start int, window_no int, over_odd double, under_odd double, "
        "features map<string,double>").selectExpr(
        "*", "'h' AS home_team", "'a' AS away_team", "timestamp_ntz'2000-01-01' AS start_time", "2.5D AS over_under_cap",
        "'w' AS window_label")
    registry = spark.createDataFrame(
        [(1, 2000, 1, "W1", "m", ["a", "b"], [1.0, 0.0], [0.5, 0.0], [1.0, 9.0], 0.25, 0.9),
         (2, 1990, 1, "W0", "m", ["a", "b"], [0.0, 0.0], [1.0, 2.0], [1.0, 1.0], 0.5, None)],
        "event_type_id int, season_start int, window_no int, window_label string, model_name string, "
        "feature_cols array<string>, mean array<double>, scale array<double>, coef array<double>, intercept double, threshold double")
    policies = spark.createDataFrame([(1, "previous_then_last"), (2, "last")], "event_type_id int, policy string")
    asked = spark.createDataFrame([(i,) for i in (1, 2, 3, 4, 5, 6, 7, 99)], "event_id long")
    return {r.event_id: r for r in S.predict(asked, frame, registry, policies, [1, 2], [2]).collect()}


def p(eta):
    return math.floor(1 / (1 + math.exp(-eta)) * 1e4 + 0.5) / 1e4


def test_exact_window_and_feature_without_spread(records):
    r = records[1]
    assert (r.fallback, r.probability, r.prediction, r.error) == ("exact", p(0.25 + 2.0), "OVER", None)


def test_fallbacks_and_missing_features(records):
    assert (records[2].fallback, records[2].model_window) == ("previous", "W1")
    assert records[3].fallback == "last"
    r = records[6]  # both features missing: 0.0 each; no threshold: the default one
    assert (r.fallback, r.probability, r.threshold) == ("last", p(0.5), config.DEFAULT_THRESHOLD)


def test_every_request_has_a_row_with_its_error(records):
    assert len(records) == 8
    assert {i: records[i].error for i in (4, 5, 7, 99)} == {
        4: "no over/under odds", 5: "unsupported league", 7: "no model", 99: "event not found"}
    assert all(records[i].prediction is None and records[i].probability is None for i in (4, 5, 7, 99))
