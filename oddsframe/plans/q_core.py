"""Queries: scans, lookups, filters, joins, latest-quote resolution, routing."""

from __future__ import annotations

from pyspark.sql import functions as F

from oddsframe import config
from oddsframe.operators import matches as M
from oddsframe.operators import quotes as Q
from oddsframe.plans.oracle_base import PLAYED
from oddsframe.plans.registry import register
from oddsframe.sources.tables import QUOTE_PAYLOAD, fixture_tables

OU = QUOTE_PAYLOAD["ou"]
MF_COLS = ", ".join(M.MATCH_COLUMNS)


@register("match_frame", f"SELECT {MF_COLS} FROM mf")
def match_frame(spark, d):
    """Matches + league + both teams (inner) + latest O/U, 1X2, handicap quotes (left)."""
    return M.match_frame(fixture_tables(spark, d))


@register("latest_quote", "SELECT * FROM lq_ou")
def latest_quote(spark, d):
    """Latest O/U quote per match, row_number form (partial WindowGroupLimit)."""
    return Q.latest_per_key(fixture_tables(spark, d).ou, OU, method="window")


@register("latest_quote_max_by", "SELECT * FROM lq_ou")
def latest_quote_max_by(spark, d):
    """Latest O/U quote per match, aggregate form (max_by over the ordering struct)."""
    return Q.latest_per_key(fixture_tables(spark, d).ou, OU, method="max_by")




def _mf_sql(team_join: str = "JOIN", ou_join: str = "LEFT JOIN") -> str:
    return f"""SELECT e.event_id, e.event_type_id, et.name AS league_name, e.start_time, e.home_id, e.away_id,
       th.name AS home_team, ta.name AS away_team, e.home_ft_score, e.away_ft_score,
       ou.over_odd, ou.over_under_cap, ou.under_odd, w.home_odd, w.draw_odd, w.away_odd,
       h.home_cap, h.away_cap, h.home_odd AS home_handicap_odd, h.away_odd AS away_handicap_odd
FROM fx_event e
JOIN fx_event_type et ON e.event_type_id = et.event_type_id
{team_join} fx_team th ON e.home_id = th.team_id
{team_join} fx_team ta ON e.away_id = ta.team_id
{ou_join} lq_ou ou ON e.event_id = ou.event_id
LEFT JOIN lq_win w ON e.event_id = w.event_id
LEFT JOIN lq_hcp h ON e.event_id = h.event_id"""


@register("match_frame_left", _mf_sql(team_join="LEFT JOIN"))
def match_frame_left(spark, d):
    """Team joins LEFT: a match with an unknown team keeps NULL names."""
    return M.match_frame(fixture_tables(spark, d), team_join="left")


@register("match_frame_quoted", _mf_sql(ou_join="JOIN"))
def match_frame_quoted(spark, d):
    """O/U quote required (INNER) as in the strict predictors."""
    return M.match_frame(fixture_tables(spark, d), ou_join="inner")


_NOT_PLAYED = f"NOT {PLAYED}"


@register("match_lookup", f"SELECT {MF_COLS} FROM mf WHERE event_id IN "
          f"(SELECT event_id FROM fx_event WHERE {_NOT_PLAYED})")
def match_lookup(spark, d):
    """Lookup of a request set (every match not yet played) by semi join."""
    t = fixture_tables(spark, d)
    requests = t.event.filter(~M.is_played()).select("event_id")
    return M.match_frame(t).join(requests, "event_id", "left_semi")


_GATE_SQL = (f"SELECT event_type_id FROM mf WHERE {PLAYED} AND over_odd IS NOT NULL "
             f"GROUP BY event_type_id HAVING count(*) >= {config.LEAGUE_MIN_MATCHES}")


def league_gate_frame(mf):
    return (mf.filter(M.is_played() & F.col("over_odd").isNotNull())
              .groupBy("event_type_id").agg(F.count(F.lit(1)).alias("n_completed")))


_ROUTED = [lg for lg, (_c, pred, _p, _s) in sorted(config.LEAGUES.items()) if pred]


@register("league_filter", f"""SELECT {MF_COLS} FROM mf
WHERE event_type_id IN ({", ".join(str(x) for x in _ROUTED)}) AND event_type_id IN ({_GATE_SQL})""")
def league_filter(spark, d):
    """Matches of the leagues served by a predictor (an IN filter on the league id, which
    prunes partitions when matches are stored by league) that also pass the >= 100
    completed-with-odds gate."""
    t = fixture_tables(spark, d)
    mf = M.match_frame(t).filter(F.col("event_type_id").isin(_ROUTED))
    ok = league_gate_frame(mf).filter(F.col("n_completed") >= config.LEAGUE_MIN_MATCHES)
    return mf.join(ok.select("event_type_id"), "event_type_id", "left_semi")


@register("completed_matches",
          f"""SELECT event_id, event_type_id, start_time, home_id, away_id, home_ft_score, away_ft_score,
       CAST(home_ft_score + away_ft_score AS INT) AS total_goals FROM fx_event WHERE {PLAYED}""")
def completed_matches(spark, d):
    """Completed-match rule: as_of - 3 h > start_time (strict), both scores known."""
    ev = fixture_tables(spark, d).event
    return ev.filter(M.is_played()).select(
        "event_id", "event_type_id", "start_time", "home_id", "away_id", "home_ft_score", "away_ft_score",
        (F.col("home_ft_score") + F.col("away_ft_score")).cast("int").alias("total_goals"))


@register("latest_quote_with_ties",
          """SELECT q.event_id, q.created_at, q.quote_id, q.over_odd, q.over_under_cap, q.under_odd
FROM fx_over_under_odd q JOIN (SELECT event_id, max(created_at) AS mx FROM fx_over_under_odd GROUP BY event_id) m
  ON q.event_id = m.event_id AND q.created_at = m.mx""")
def latest_quote_with_ties(spark, d):
    """All quotes at the per-match maximum created_at (ties kept)."""
    return Q.latest_with_ties(fixture_tables(spark, d).ou, OU).select(
        "event_id", "created_at", "quote_id", *OU)


@register("asof_quote",
          """SELECT q.event_id, q.created_at, q.quote_id, q.over_odd, q.over_under_cap, q.under_odd
FROM fx_over_under_odd q JOIN fx_event e ON q.event_id = e.event_id
WHERE q.created_at < e.start_time
QUALIFY row_number() OVER (PARTITION BY q.event_id ORDER BY q.created_at DESC, q.quote_id DESC,
  q.over_odd DESC NULLS LAST, q.over_under_cap DESC NULLS LAST, q.under_odd DESC NULLS LAST) = 1""")
def asof_quote(spark, d):
    """Latest O/U quote strictly before kick-off (leak-free as-of join)."""
    t = fixture_tables(spark, d)
    return Q.asof_latest(t.ou, t.event, OU)


@register("quote_coverage", """SELECT 'fb_over_under_odd' AS quote_table, count(*) AS n_quotes,
       count(DISTINCT event_id) AS n_events FROM fx_over_under_odd
UNION ALL SELECT 'fb_win_odd', count(*), count(DISTINCT event_id) FROM fx_win_odd
UNION ALL SELECT 'fb_handicap_odd', count(*), count(DISTINCT event_id) FROM fx_handicap_odd""")
def quote_coverage(spark, d):
    """Quote rows vs distinct quoted matches per quote table."""
    return Q.quote_coverage(fixture_tables(spark, d))


@register("unquoted_events", """SELECT event_id, event_type_id, start_time FROM fx_event e
WHERE NOT EXISTS (SELECT 1 FROM fx_over_under_odd q WHERE q.event_id = e.event_id)""")
def unquoted_events(spark, d):
    """Matches without any O/U quote (left anti join against distinct quoted ids)."""
    t = fixture_tables(spark, d)
    return (t.event.select("event_id", "event_type_id", "start_time")
                   .join(t.ou.select("event_id").distinct(), "event_id", "left_anti"))


_ROUTES = ", ".join(f"({lg}, '{pred}')" for lg, (_c, pred, _p, _s) in sorted(config.LEAGUES.items()) if pred)


@register("route_events", f"""SELECT e.event_id, e.event_type_id, e.start_time, r.predictor,
  CASE WHEN r.predictor IS NULL THEN 'unsupported league'
       WHEN NOT EXISTS (SELECT 1 FROM fx_over_under_odd q WHERE q.event_id = e.event_id) THEN 'no over/under odds'
  END AS error
FROM fx_event e LEFT JOIN (VALUES {_ROUTES}) AS r(event_type_id, predictor) ON e.event_type_id = r.event_type_id""")
def route_events(spark, d):
    """Every match routed to its league predictor; errors as values, never dropped rows."""
    t = fixture_tables(spark, d)
    return M.route_events(spark, t, t.ou.select("event_id").distinct())


@register("recent_matches", f"""SELECT event_id, start_time, home_team, away_team, home_ft_score, away_ft_score,
  CAST(home_ft_score + away_ft_score AS INT) AS total_goals FROM mf WHERE {PLAYED}
ORDER BY start_time DESC, event_id DESC""")
def recent_matches(spark, d):
    """Played matches, most recent first (sort only at the sink)."""
    mf = M.match_frame(fixture_tables(spark, d))
    return (mf.filter(M.is_played())
              .select("event_id", "start_time", "home_team", "away_team", "home_ft_score", "away_ft_score",
                      (F.col("home_ft_score") + F.col("away_ft_score")).cast("int").alias("total_goals"))
              .orderBy(F.col("start_time").desc(), F.col("event_id").desc()))


@register("latest_quote_stream", "SELECT * FROM lq_ou")
def latest_quote_stream(spark, d):
    """Latest O/U quote kept incrementally by a Structured Streaming job (foreachBatch
    candidates in the shared folder); equals the batch operator."""
    from oddsframe.streaming.latest_quote import latest_quote_stream as run
    return run(spark, d)


@register("latest_quote_keyed", "SELECT * FROM lq_ou")
def latest_quote_keyed(spark, d):
    """Latest O/U quote from a stream with one state row per match (update mode) and compacted updates."""
    from oddsframe.streaming.latest_quote import latest_quote_keyed as run
    return run(spark, d)


@register("league_pruned_frame", f"""SELECT event_id, event_type_id, start_time, home_id, away_id, over_odd, over_under_cap, under_odd
FROM mf WHERE event_type_id IN (SELECT event_type_id FROM fx_event_type WHERE name < 'ASIA')""")
def league_pruned_frame(spark, d):
    """Matches and latest quotes of some leagues from a layout in folders by league and year: the leagues come from a
    filtered dimension, and only their folders are read."""
    import uuid

    from oddsframe.session import checkpoint_dir
    from oddsframe.sources.tables import load_partitioned, save_partitioned
    t = fixture_tables(spark, d)
    root = f"{checkpoint_dir(spark)}/by-league-{uuid.uuid4().hex}"
    save_partitioned(t, root)
    wanted = spark.read.parquet(f"{root}/fb_event_type.parquet").filter("name < 'ASIA'")
    return M.match_core(load_partitioned(spark, root, wanted)).select(
        "event_id", "event_type_id", "start_time", "home_id", "away_id", "over_odd", "over_under_cap", "under_odd")


@register("scan_history_csv", f"""SELECT event_id, start_time, home_id, away_id, home_ft_score, away_ft_score,
  over_under_cap FROM mf WHERE {PLAYED}""")
def scan_history_csv(spark, d):
    """History extract written as CSV (ISO timestamps with 'Z') into the shared folder by
    Spark, then scanned back with an explicit schema and timestamp parsing."""
    import uuid

    from oddsframe.session import checkpoint_dir
    from oddsframe.sources.tables import read_history_csv
    path = f"{checkpoint_dir(spark)}/history-csv-{uuid.uuid4().hex}"
    mf = M.match_core(fixture_tables(spark, d)).filter(M.is_played())
    iso = F.concat(F.regexp_replace(F.col("start_time").cast("string"), " ", "T"), F.lit("Z"))  # zone-free
    (mf.select("event_id", iso.alias("start_time"),
               "home_id", "away_id", "home_ft_score", "away_ft_score", "over_under_cap")
       .write.option("header", "true").csv(path))
    return read_history_csv(spark, path)
