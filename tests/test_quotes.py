"""Latest / as-of quote semantics on a hand-made quote history (ties, late quotes)."""

import datetime as dt

from oddsframe.operators.quotes import asof_latest, latest_per_key, latest_with_ties

D = dt.datetime
PAYLOAD = ["over_odd", "over_under_cap", "under_odd"]
QSCHEMA = "event_id long, created_at timestamp_ntz, quote_id long, over_odd double, over_under_cap double, under_odd double"
QUOTES_TIES = [
    (1, D(2000, 1, 1), 10, 1.9, 2.5, 1.9),
    (1, D(2000, 1, 2), 11, 1.8, 2.5, 2.0),   # latest, tied on created_at
    (1, D(2000, 1, 2), 12, 1.7, 2.75, 2.1),  # tie broken by quote_id DESC -> this one
    (2, D(2000, 1, 5), 20, 2.0, 3.0, 1.8),   # after kick-off
    (2, D(2000, 1, 3), 21, 2.1, 3.0, 1.7),
    (3, D(2000, 1, 1), 30, None, 2.5, 1.9),  # NULL odd
]
EVENTS = [(1, D(2000, 1, 3)), (2, D(2000, 1, 4)), (3, D(2000, 1, 1)), (4, D(2000, 1, 1))]


def test_latest_methods_agree_and_break_ties(spark):
    q = spark.createDataFrame(QUOTES_TIES, QSCHEMA)
    results = []
    for method in ("agg", "window", "max_by"):
        got = {r.event_id: r.quote_id for r in latest_per_key(q, PAYLOAD, method=method).collect()}
        results.append(got)
    assert results[0] == results[1] == results[2] == {1: 12, 2: 20, 3: 30}


def test_ties_kept_by_max_join(spark):
    q = spark.createDataFrame(QUOTES_TIES, QSCHEMA)
    got = sorted(r.quote_id for r in latest_with_ties(q, PAYLOAD).filter("event_id = 1").collect())
    assert got == [11, 12]


def test_asof_excludes_quotes_at_or_after_kickoff(spark):
    q = spark.createDataFrame(QUOTES_TIES, QSCHEMA)
    ev = spark.createDataFrame(EVENTS, "event_id long, start_time timestamp_ntz")
    got = {r.event_id: r.quote_id for r in asof_latest(q, ev, PAYLOAD).collect()}
    assert got == {1: 12, 2: 21}   # event 3's only quote is at kick-off: none; event 4 has none
