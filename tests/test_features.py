"""Feature graph: resolution, closure, and vectors against a per-match computation in plain Python."""

import datetime as dt
import math

import pytest

from oddsframe.operators import features as FT
from oddsframe.plans.q_features import RESOLVED
from oddsframe.vectors import FILL, LEAGUE_VECTORS, VECTORS

COUNTS = {"germany": 31, "austria": 33, "england": 26, "fa_cup": 34, "japan": 20, "mexico": 38, "qatar": 22, "serbia": 34,
          "south_korea": 21, "turkey": 34, "u21": 21, "nwsl": 24, "vietnam": 16, "africa": 19}
FRAME = ("event_id long, event_type_id int, league_name string, start_time timestamp_ntz, home_id int, away_id int, home_team string, "
         "away_team string, home_ft_score int, away_ft_score int, over_odd double, over_under_cap double, under_odd double, "
         "home_odd double, draw_odd double, away_odd double, home_cap double, away_cap double, home_handicap_odd double, "
         "away_handicap_odd double")


def test_documented_lengths_and_every_vector_is_dealt():
    assert {v.name: len(v.features) for v in RESOLVED} == COUNTS
    assert sorted(n for names in LEAGUE_VECTORS.values() for n in names) == sorted(VECTORS)


def test_resolution_follows_names_and_refuses_circles_and_results():
    v = FT.resolve("v", "b = $a * 2\na = p_over + 1\n: hidden = over_odd\nc = $hidden / 2")
    assert v.features == ("b", "a", "c") and v.expressions == ("(p_over + 1) * 2", "p_over + 1", "(over_odd) / 2")
    for bad in ("a = $b\nb = $a", "a = $missing", "a = 1\na = 2", "total_goals = p_over", "x = home_ft_score"):
        with pytest.raises(ValueError):
            FT.resolve("bad", bad)


def test_closure_names_only_the_tables_that_are_reached():
    by = {v.name: v for v in RESOLVED}
    assert FT.history_needed([by["africa"], by["u21"]]) == {}
    assert FT.history_needed([by["vietnam"], by["england"]]) == {"all": {"scored", "conceded"}}
    assert set(FT.history_needed([by["turkey"]])) == {"athome10", "ataway10", "athome5", "ataway5"}
    assert set(FT.history_needed([by["japan"]])) == {"joint", "team"}


def _matches(n=60):
    rows = []
    for i in range(n):
        home, away = i % 5, (i * 3 + 1) % 5
        away = (away + 1) % 5 if away == home else away
        played = i < n - 8 and i % 11 != 5
        quote = [None] * 3 if i % 13 == 4 else [1.6 + (i % 7) / 10, 2.0 + (i % 6) / 4, 1.7 + (i % 5) / 10]
        win = [None] * 3 if i % 9 == 2 else [1.5 + (i % 8) / 5, 3.1 + (i % 4) / 10, 1.9 + (i % 6) / 3]
        cap = None if i % 10 == 7 else (i % 9 - 4) / 4
        rows.append((i, 1, "L", dt.datetime(2000, 1, 1) + dt.timedelta(days=i // 2), home, away, f"t{home}", f"t{away}",
                     (i * 7) % 5 if played else None, (i * 3) % 4 if played else None, *quote, *win, cap,
                     None if cap is None else -cap, 1.8 + (i % 3) / 10, 2.1))
    return rows


def _history(rows, row, team, n=None, home=None):
    """Played matches of a team before the row's kick-off: (scored, conceded, over or None), oldest first."""
    out = []
    for r in rows:
        if r[8] is None or r[3] >= row[3] or team not in (r[4], r[5]) or (home is not None and (r[4] == team) != home):
            continue
        gf, ga = (r[8], r[9]) if r[4] == team else (r[9], r[8])
        out.append((r[3], r[0], gf, ga, None if r[11] is None else int(gf + ga > r[11])))
    out = [h[2:] for h in sorted(out)]
    return out if n is None else out[-n:]


def _avg(values, default):
    values = [v for v in values if v is not None]
    return sum(values) / len(values) if values else default


def _close(got, want):
    return (got is None and want is None) or (got is not None and want is not None and math.isclose(got, want, abs_tol=1e-9))


def test_vectors_by_hand(spark):
    rows = _matches()
    by = {v.name: v for v in RESOLVED}
    names = ("vietnam", "turkey", "serbia", "nwsl", "u21")
    vectors = [by[n] for n in names]
    frame = FT.feature_frame(spark, spark.createDataFrame(rows, FRAME), vectors)
    got = {(r.event_id, r.vector): dict(zip(by[r.vector].features, r["values"])) for r in FT.assemble(frame, vectors, {1: names}).collect()}
    assert len(got) == len(rows) * len(names)
    inv = lambda x: None if x is None else 1 / x
    for r in rows:
        oo, cap, uo, ho, do, ao, hc = r[10], r[11], r[12], r[13], r[14], r[15], r[16]
        h, a = _history(rows, r, r[4]), _history(rows, r, r[5])
        v = got[r[0], "vietnam"]
        hs, hcn, as_, ac = (_avg([x[i] for x in s], 1.25) for s in (h, a) for i in (0, 1))
        assert _close(v["expected_goals"], (hs + ac + as_ + hcn) / 2) and _close(v["attack_vs_defense"], (hs - ac) - (as_ - hcn))
        assert _close(v["implied_prob_over"], inv(oo)) and _close(v["handicap_spread"], abs(hc or 0))
        assert _close(v["book_margin"], None if ho is None else 1 - (1 / ho + 1 / do + 1 / ao))
        t = got[r[0], "turkey"]
        h10, a10 = _history(rows, r, r[4], 10, True), _history(rows, r, r[5], 10, False)
        total = ((_avg([x[0] for x in h10], 2.0) + _avg([x[1] for x in a10], 2.0))
                 + (_avg([x[0] for x in a10], 2.0) + _avg([x[1] for x in h10], 2.0))) / 2
        form = sum(_avg([x[0] + x[1] for x in s], 2.5) for s in (_history(rows, r, r[4], 5, True), _history(rows, r, r[5], 5, False)))
        assert _close(t["expected_total_vs_cap"], total) and _close(t["combined_form"], form)
        s = got[r[0], "serbia"]
        both = _history(rows, r, r[4], 10, True) + _history(rows, r, r[4], 10, False)
        assert _close(s["home_avg_scored"], _avg([x[0] for x in both], 0) if len(both) >= 3 else 1.5)
        assert _close(s["home_over_rate"], _avg([x[2] for x in both], 0.0) if len(both) >= 3 else 0.45)
        w = got[r[0], "nwsl"]
        last = _history(rows, r, r[5], 5)
        assert _close(w["a_avg_conceded"], _avg([x[1] for x in last], 0) if len(last) >= 2 else 2.5) and w["a_games"] == len(a)
        assert _close(w["norm_over_prob"], FILL["nwsl"] if oo is None else (1 / oo) / (1 / oo + 1 / uo))
        u = got[r[0], "u21"]
        assert _close(u["odds_ratio"], (oo or 1.8) / (uo or 1.8)) and _close(u["cap_norm"], ((cap or 2.75) - 2.5) / 1.5)


def test_driver_plans_no_more_than_one_history_table_at_a_time(spark):
    """The joined columns are written: what is assembled from them has no join or shuffle left, and a feature's text is in it once."""
    by = {v.name: v for v in RESOLVED}
    frame = FT.feature_frame(spark, spark.createDataFrame(_matches(), FRAME), RESOLVED)
    rows = FT.assemble(frame, RESOLVED, {1: ("turkey", "mexico")})
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Aggregate" not in plan and "Window" not in plan
    cells = FT.values(by["vietnam"])
    assert str(cells).count("over_under_cap") == sum(e.count("over_under_cap") for e in by["vietnam"].expressions)


def test_values_without_a_number_are_missing(spark):
    odd = FT.resolve("odd", "a = cast('inf' as double)\nb = -cast('inf' as double)\nc = cast('nan' as double)\nd = cast(null as double)\ne = 1")
    filled = FT.Vector("filled", odd.features, odd.expressions, 0.5)
    got = spark.range(1).select(FT.values(odd).alias("a"), FT.values(filled).alias("b")).first()
    assert list(got.a) == [None, None, None, None, 1.0] and list(got.b) == [0.5, 0.5, 0.5, 0.5, 1.0]
