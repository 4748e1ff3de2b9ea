"""Prefix sums, positions and last-N against brute force (ties included)."""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from oddsframe.operators.prefix import positions, time_prefix

SCHEMA = "k int, t timestamp_ntz, id int, x int"


def _rows(draw_rows):
    base = dt.datetime(2000, 1, 1)
    return [(k, base + dt.timedelta(days=d), i, x) for i, (k, d, x) in enumerate(draw_rows)]


rows_strategy = st.lists(st.tuples(st.integers(0, 2), st.integers(0, 70), st.integers(0, 5)),
                         min_size=1, max_size=40)


@settings(max_examples=12, deadline=None)
@given(rows_strategy)
def test_time_prefix_matches_brute_force(spark, raw):
    rows = _rows(raw)
    df = spark.createDataFrame(rows, SCHEMA)
    got = {(r.k, r.t): (r.n_before, r.x_before)
           for r in time_prefix(df, ["k"], "t", {"n": F.lit(1), "x": F.col("x")}).collect()}
    for k, t, _i, _x in rows:
        earlier = [r for r in rows if r[0] == k and r[1] < t]
        assert got[(k, t)] == (len(earlier), sum(r[3] for r in earlier))


@settings(max_examples=12, deadline=None)
@given(rows_strategy)
def test_positions_match_sorted_order(spark, raw):
    rows = _rows(raw)
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r.id: (r.pos, r.x_cum) for r in positions(df, ["k"], "t", ["id"], {"x": F.col("x")}).collect()}
    for k in {r[0] for r in rows}:
        ordered = sorted([r for r in rows if r[0] == k], key=lambda r: (r[1], r[2]))
        run = 0
        for p, r in enumerate(ordered, start=1):
            run += r[3]
            assert got[r[2]] == (p, run)


def test_prefix_crosses_month_buckets(spark):
    rows = [(1, dt.datetime(2000, m, 28), m, m) for m in range(1, 13)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r.t.month: r.x_before for r in time_prefix(df, ["k"], "t", {"x": F.col("x")}).collect()}
    assert got[12] == sum(range(1, 12))
    assert got[1] == 0


@settings(max_examples=8, deadline=None)
@given(rows_strategy)
def test_positions_split_instant_matches_window(spark, raw):
    rows = _rows(raw)
    df = spark.createDataFrame(rows, SCHEMA)
    a = {r.id: (r.pos, r.x_cum) for r in positions(df, ["k"], "t", ["id"], {"x": F.col("x")}).collect()}
    b = {r.id: (r.pos, r.x_cum) for r in
         positions(df, ["k"], "t", ["id"], {"x": F.col("x")}, split_instant=4).collect()}
    assert a == b
