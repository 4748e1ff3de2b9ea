"""Hand-made edge frames: bad odds, a 12-month calendar per league, unseen teams."""

import datetime as dt

from pyspark.sql import functions as F

from oddsframe import config
from oddsframe.functions import market
from oddsframe.functions.calendar import with_season_window
from oddsframe.operators.score import encode_teams

ODDS_SCHEMA = ("event_id int, over_odd double, under_odd double, over_under_cap double, home_odd double, "
               "draw_odd double, away_odd double, home_cap double, away_cap double, "
               "home_handicap_odd double, away_handicap_odd double")
ODDS_BAD = [
    (1, None, 1.9, 2.5, 2.0, 3.2, 3.5, -0.5, 0.5, 1.9, 1.9),     # NULL over odd
    (2, 0.0, 1.9, 2.5, 2.0, 3.2, 3.5, -0.5, 0.5, 1.9, 1.9),      # zero over odd
    (3, 1.9, 1.9, 2.5, None, None, None, -0.5, 0.5, 1.9, 1.9),   # missing 1X2
    (4, 1.8, 2.0, 3.0, 2.0, 3.2, 3.5, None, None, None, None),   # no handicap quote
    (5, 1.9, 1.9, None, 2.0, 3.2, 3.5, 0.0, 0.0, 1.9, 1.9),      # NULL cap
]


def test_bad_odds_never_fail_and_follow_the_null_policy(spark):
    df = spark.createDataFrame(ODDS_BAD, ODDS_SCHEMA)
    cols = [c for group in market.GROUPS.values() for c in group()]
    rows = {r.event_id: r for r in df.select("event_id", *cols).collect()}   # no ANSI error anywhere
    assert rows[1].p_over is None and rows[1].p_over_guarded == 0.5
    assert rows[2].p_over is None and rows[2].p_over_guarded == 0.5          # 1 / 0 -> NULL, guard -> 0.5
    assert rows[3].p_home_fair is None and rows[3].p_home_fair_or_half == 0.5
    assert rows[3].p_home_guarded == 0.33
    assert rows[4].home_cap_filled == 0.0 and rows[4].abs_home_cap is None
    assert rows[5].cap_bin is None and rows[5].cap_low is None
    assert abs(rows[4].p_over_fair - (1 / 1.8) / (1 / 1.8 + 1 / 2.0)) < 1e-15


# Expected (season offset, window) per month, written out by hand per calendar shape.
EXPECTED = {
    # month: 1  2  3  4  5  6  7  8  9 10 11 12
    "aug_quarters": [2, 3, 3, 3, 4, 4, 4, 1, 1, 1, 2, 2],
    "aug_three": [2, 3, 3, 3, 3, None, None, 1, 1, 1, 2, 2],
    "jul_quarters": [3, 3, 3, 4, 4, 4, 1, 1, 1, 2, 2, 2],
    "sep_quarters": [2, 2, 3, 3, 3, 4, 4, 4, 1, 1, 1, 2],
    "mar_three": [3, 3, 1, 1, 1, 2, 2, 2, 3, 3, 3, 3],
}


def test_calendar_twelve_months_per_league(spark):
    rows = [(lg, m, dt.datetime(2000, m, 15)) for lg in config.LEAGUES for m in range(1, 13)]
    df = spark.createDataFrame(rows, "event_type_id int, m int, start_time timestamp_ntz")
    got = {(r.event_type_id, r.m): (r.season_start, r.window_no, r.window_label)
           for r in with_season_window(df, spark).collect()}
    for lg, (cal, _p, _d, _s) in config.LEAGUES.items():
        start = config.CALENDARS[cal][0]
        for m in range(1, 13):
            season, window, label = got[(lg, m)]
            assert window == EXPECTED[cal][m - 1], (cal, m)
            if window is None:
                assert season is None and label is None
            else:
                assert season == (2000 if m >= start else 1999)
                assert label == f"{season}-{season + 1}-W{window}"


def test_unseen_team_gets_keep_index(spark):
    ev = spark.createDataFrame([(1, 5, 7, True), (2, 7, 9, True), (3, 5, 42, False)],
                               "event_id int, home_id int, away_id int, played boolean")
    got = {r.event_id: (r.home_idx, r.away_idx) for r in encode_teams(ev, F.col("played")).collect()}
    assert got == {1: (0, 1), 2: (1, 2), 3: (0, 3)}   # 42 never played: keep index = 3 seen teams


def test_team_names_are_encoded_like_ids(spark):
    ev = spark.createDataFrame([(1, "ab12x", "ab12y", True), (2, "zz", "ab12y", True), (3, "zz", "q", False), (4, None, "zz", True)],
                               "event_id int, home_id string, away_id string, played boolean")
    got = {r.event_id: (r.home_idx, r.away_idx) for r in encode_teams(ev, F.col("played")).collect()}
    assert got == {1: (0, 1), 2: (2, 1), 3: (2, 3), 4: (None, 2)}


def test_calendar_shapes_and_labels(spark):
    from oddsframe.functions.calendar import all_windows
    df = spark.createDataFrame([(m, dt.datetime(2025, m, 15)) for m in (1, 6, 11)], "event_id int, start_time timestamp_ntz")
    got = {(r.event_id, r.calendar): r for r in all_windows(df, spark).collect()}
    assert (got[1, "aug_quarters"].label_s, got[1, "aug_quarters"].label_months) == ("S2024-2025-W2", "2024-11 to 2025-01")
    assert (got[6, "aug_long_ends"].label_underscore, got[6, "aug_long_ends"].label_months) == ("2024-2025_W3", "2025-03 to 2025-07")
    assert got[11, "mar_three"].label_space == "2025-2026 W3"  # November stays in the season that began in March
    assert (got[11, "calendar_year"].season_start, got[11, "calendar_year"].window_no) == (2025, 4)
    assert (1, "calendar_year") not in got and (6, "aug_cup") not in got
    assert got[6, "sep_short_spring"].window_no == 4


def test_registry_gaps_follow_each_policy(spark):
    from oddsframe.operators.score import resolve_model_windows
    models = spark.createDataFrame([(1, 20001), (1, 20003), (2, 20002)], "event_type_id int, o int")
    reqs = spark.createDataFrame(
        [(10, 1, 20003), (11, 1, 20002), (12, 1, 20000), (20, 2, 20004), (21, 2, 20001), (30, 3, 20001)],
        "event_id int, event_type_id int, o int")
    pol = spark.createDataFrame([(1, "previous_then_last"), (2, "first"), (3, "error")],
                                "event_type_id int, policy string")
    got = {r.event_id: (r.model_key, r.fallback) for r in resolve_model_windows(models, reqs, pol).collect()}
    assert got == {10: (20003, "exact"), 11: (20001, "previous"), 12: (20003, "last"),
                   20: (20002, "first"), 21: (20002, "first"), 30: (None, "error: no model")}
    pol_last = spark.createDataFrame([(1, "last")], "event_type_id int, policy string")
    got = {r.event_id: (r.model_key, r.fallback)
           for r in resolve_model_windows(models, reqs.filter("event_type_id = 1"), pol_last).collect()}
    assert got == {10: (20003, "exact"), 11: (20003, "last"), 12: (20003, "last")}
