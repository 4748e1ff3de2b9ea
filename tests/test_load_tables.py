"""The documented tables (string keys, own key columns, audit columns) load and run."""

import datetime as dt

from pyspark.sql import functions as F

from oddsframe.operators import matches as M
from oddsframe.operators.prefix import positions
from oddsframe.sources.tables import load_tables

T0 = dt.datetime(2000, 5, 1, 12)


def test_documented_schema(spark, tmp_path):
    h = lambda n: dt.timedelta(hours=n)
    put = lambda name, rows, schema: spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    audit = "created_at timestamp_ntz, updated_at timestamp_ntz"
    put("fb_event", [(f"e{i}", "lg-a", T0 + h(24 * (i // 2)), "t1", "t2", 0, 0, 0, i, 1, T0, T0) for i in range(4)],
        "event_id string, event_type_id string, start_time timestamp_ntz, home_id string, away_id string, has_bet_in_run int, "
        "home_ht_score int, away_ht_score int, home_ft_score int, away_ft_score int, " + audit)
    put("fb_team", [("t1", "One", T0, T0), ("t2", "Two", T0, T0)], "team_id string, name string, " + audit)
    put("fb_event_type", [("lg-a", "League", T0, T0)], "event_type_id string, name string, " + audit)
    put("fb_over_under_odd", [(f"q{i}{k}", f"e{i}", 1.5 + k, 2.5, 2.0, T0 - h(5 - k), T0) for i in range(3) for k in range(3)],
        "over_under_odd_id string, event_id string, over_odd float, over_under_cap float, under_odd float, " + audit)
    put("fb_win_odd", [("w1", "e0", 1.5, 3.0, 2.0, T0, T0)],
        "win_odd_id string, event_id string, home_odd float, draw_odd float, away_odd float, " + audit)
    put("fb_handicap_odd", [("h1", "e0", 1.5, -0.5, 2.0, 0.5, T0, T0)],
        "handicap_odd_id string, event_id string, home_odd float, home_cap float, away_odd float, away_cap float, " + audit)
    t = load_tables(spark, str(tmp_path))
    assert dict(t.ou.dtypes)["quote_id"] == dict(t.event.dtypes)["event_id"] == "string"
    rows = {r.event_id: r for r in M.match_frame(t).collect()}
    assert len(rows) == 4 and rows["e0"].over_odd == 3.5 and rows["e0"].home_cap == -0.5 and rows["e3"].over_odd is None
    assert rows["e1"].league_name == "League" and rows["e1"].home_team == "One"
    pos = positions(M.match_asof(t).filter("over_odd is not null"), ["event_type_id"], "start_time", ["event_id"],
                    {"_one": F.lit(1)}).collect()
    assert {r.event_id: r.pos for r in pos} == {"e0": 1, "e1": 2, "e2": 3}
