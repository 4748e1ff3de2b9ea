"""The history oracles' window texts against self-joins of every match with all earlier rows (DuckDB alone)."""

import os

import duckdb
import pytest

from oddsframe import config
from oddsframe.plans import q_history as Q
from oddsframe.plans.oracle_base import sql
from oddsframe.plans.registry import ORACLES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in os.listdir(SF):
        c.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM read_parquet('{SF}/{f}')")
    return c


def brute(team_col, venue, n):
    at = "" if venue is None else f"AND h.is_home = {venue}"
    limit = "" if n is None else f"WHERE rn <= {n}"
    return f"""SELECT event_id, count(*) AS n, sum(gf) AS gf, sum(ga) AS ga, sum(total) AS tot, sum(win) AS win,
  sum(over) AS over, count(over) AS over_n
FROM (SELECT m.event_id, h.gf, h.ga, h.total, h.win, h.over,
        row_number() OVER (PARTITION BY m.event_id ORDER BY h.start_time DESC, h.event_id DESC) AS rn
      FROM mf m JOIN tlv h ON h.played = 1 AND h.start_time < m.start_time AND h.team_id = m.{team_col}
        AND h.event_type_id = m.event_type_id {at}) {limit}
GROUP BY event_id ORDER BY event_id"""


@pytest.mark.parametrize("team_col", ["home_id", "away_id"])
@pytest.mark.parametrize("venue", [None, 0, 1])
@pytest.mark.parametrize("n", [None, 1, 5, 10])
def test_totals_before_kick_off(con, team_col, venue, n):
    got = con.execute(sql("SELECT event_id, n, gf, ga, tot, win, over, over_n FROM x WHERE n > 0 ORDER BY event_id",
                          *Q.TL_CTES, Q.hist_cte("x", team_col, venue, n))).fetchall()
    assert got == con.execute(sql(brute(team_col, venue, n), *Q.TL_CTES)).fetchall()
    assert got


def test_joint_recent_form(con):
    got = con.execute(f"SELECT event_id, n_joint, home_n, away_n FROM ({ORACLES['joint_recent_form']}) ORDER BY event_id").fetchall()
    want = con.execute(sql(f"""SELECT m.event_id, count(j.event_id), count(CASE WHEN j.ch = m.home_id THEN 1 END),
  count(CASE WHEN j.ca = m.away_id THEN 1 END)
FROM mf m LEFT JOIN (SELECT m.event_id, h.home_id AS ch, h.away_id AS ca,
    row_number() OVER (PARTITION BY m.event_id ORDER BY h.start_time DESC, h.event_id DESC) AS rn
  FROM mf m JOIN mfp h ON h.played = 1 AND h.start_time < m.start_time
    AND (h.home_id = m.home_id OR h.away_id = m.away_id)) j ON j.event_id = m.event_id AND j.rn <= {config.RECENT_LIMIT}
GROUP BY m.event_id ORDER BY m.event_id""", *Q.TL_CTES)).fetchall()
    assert got == want


def test_league_history(con):
    got = con.execute(f"SELECT event_id, league_n_before FROM ({ORACLES['history_before_event']}) ORDER BY event_id").fetchall()
    want = con.execute(sql("""SELECT r.event_id, count(h.event_id) FROM mfp r
LEFT JOIN mfp h ON h.played = 1 AND h.event_type_id = r.event_type_id AND h.start_time < r.start_time
WHERE r.played = 0 GROUP BY r.event_id ORDER BY r.event_id""", *Q.TL_CTES)).fetchall()
    assert got == want
