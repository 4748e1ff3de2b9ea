"""Queries: team-long table and leak-free team-history features.

Oracles use SQL window frames over all earlier rows, and row positions where a last-N limit
applies; a test holds them against self-joins of every match with all earlier rows. They
share no code path with the prefix-sum operators they check.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from oddsframe import config
from oddsframe.functions.helpers import div
from oddsframe.operators import history as H
from oddsframe.operators import matches as M
from oddsframe.operators.prefix import positions, time_prefix
from oddsframe.plans.oracle_base import PLAYED
from oddsframe.plans.registry import register
from oddsframe.plans.sqlx import r6
from oddsframe.sources.tables import fixture_tables

# ---------------------------------------------------------------------------
# Spark side
# ---------------------------------------------------------------------------


def _ctx(spark, d):
    mf = M.match_core(fixture_tables(spark, d))
    return mf, M.team_long(mf)


def _base(mf):
    return mf.select("event_id", "event_type_id", "start_time", "home_id", "away_id", "over_under_cap")


def cold_start_frame(spark, d):
    mf, tl = _ctx(spark, d)
    tab = H.expanding_table(tl, H.LEAGUE_TEAM)
    out = H.two_sided(_base(mf), tab, carry=["event_type_id", "over_under_cap"]).select(
        "event_id", "event_type_id", "over_under_cap", *H.rates("home"), *H.rates("away"))
    return H.with_cold_start(out, spark)


# ---------------------------------------------------------------------------
# SQL side
# ---------------------------------------------------------------------------

TL_CTES = (
    ("mfp", f"SELECT *, CAST({PLAYED} AS INT) AS played FROM mf"),
    ("tl0", """SELECT event_type_id, home_id AS team_id, away_id AS opponent_id, event_id, start_time, 1 AS is_home,
       CASE WHEN played = 1 THEN home_ft_score END AS gf, CASE WHEN played = 1 THEN away_ft_score END AS ga,
       over_under_cap AS cap, played FROM mfp
UNION ALL
SELECT event_type_id, away_id, home_id, event_id, start_time, 0,
       CASE WHEN played = 1 THEN away_ft_score END, CASE WHEN played = 1 THEN home_ft_score END,
       over_under_cap, played FROM mfp"""),
    ("tlv", """SELECT *, gf + ga AS total, CAST(gf + ga > cap AS INT) AS over, CAST(gf > ga AS INT) AS win
FROM tl0"""),
)


BEFORE = "ORDER BY start_time RANGE BETWEEN UNBOUNDED PRECEDING AND INTERVAL 1 MICROSECOND PRECEDING"
_SUMS = """sum(gf) {f} AS gf, sum(ga) {f} AS ga, sum(total) {f} AS tot, sum(win) {f} AS win, sum(over) {f} AS over,
       count(over) {f} AS over_n"""


def hist_cte(name: str, team_col: str, venue: int | None = None, n: int | None = None) -> tuple[str, str]:
    """Per match: totals over the team's played rows in the league strictly before kick-off
    (optionally one venue, optionally only the n most recent).

    One window pass and, for the n most recent, an equality join on row positions; no match meets all earlier
    rows, so the cost is linear. A test holds the texts against a self-join with all earlier rows."""
    side = 1 if team_col == "home_id" else 0
    at = "" if venue is None else f" AND is_home = {venue}"
    if n is None:
        f = f"FILTER (WHERE played = 1{at}) OVER w"
        return (name, f"""SELECT * FROM (SELECT event_id, is_home, count(*) {f} AS n, {_SUMS.format(f=f)}
  FROM tlv WINDOW w AS (PARTITION BY event_type_id, team_id {BEFORE})) WHERE is_home = {side}""")
    return (name, f"""SELECT k.event_id, count(*) AS n, {_SUMS.format(f='')}
FROM (SELECT event_id, event_type_id, team_id, unnest(range(greatest(k - {n}, 0) + 1, k + 1)) AS pos
      FROM (SELECT event_id, event_type_id, team_id, is_home,
                   count(*) FILTER (WHERE played = 1{at}) OVER (PARTITION BY event_type_id, team_id {BEFORE}) AS k FROM tlv)
      WHERE is_home = {side}) k
JOIN (SELECT *, row_number() OVER (PARTITION BY event_type_id, team_id ORDER BY start_time, event_id) AS pos
      FROM tlv WHERE played = 1{at}) h
  ON h.event_type_id = k.event_type_id AND h.team_id = k.team_id AND h.pos = k.pos
GROUP BY k.event_id""")


def sql_rates(a: str, p: str, default: float | None = None,
              stats=("n", "scored", "conceded", "total", "win_rate", "over_rate", "goal_diff")) -> list[str]:
    n = f"coalesce({a}.n, 0)"

    def d(x):
        return x if default is None else f"coalesce({x}, {default}E0)"
    exprs = {
        "n": f"CAST({n} AS BIGINT)",
        "scored": r6(d(f"(CAST({a}.gf AS DOUBLE) / NULLIF({n}, 0))")),
        "conceded": r6(d(f"(CAST({a}.ga AS DOUBLE) / NULLIF({n}, 0))")),
        "total": r6(f"(CAST({a}.tot AS DOUBLE) / NULLIF({n}, 0))"),
        "win_rate": r6(f"(CAST({a}.win AS DOUBLE) / NULLIF({n}, 0))"),
        "over_rate": r6(f"(CAST({a}.over AS DOUBLE) / NULLIF({a}.over_n, 0))"),
        "goal_diff": r6(f"(CAST({a}.gf - {a}.ga AS DOUBLE) / NULLIF({n}, 0))"),
    }
    return [f"{exprs[s]} AS {p}_{s}" for s in stats]


def two_side_sql(ctes, sides, extra_cols=()):
    """SELECT event_id + rates of each (cte alias, prefix, default, stats)."""
    sel = ["m.event_id", *extra_cols]
    joins = []
    for alias, prefix, default, stats in sides:
        sel += sql_rates(alias, prefix, default, stats)
        joins.append(f"LEFT JOIN {alias} ON {alias}.event_id = m.event_id")
    return "SELECT " + ",\n  ".join(sel) + "\nFROM mf m\n" + "\n".join(joins), TL_CTES + tuple(ctes)


ALL = ("n", "scored", "conceded", "total", "win_rate", "over_rate", "goal_diff")


def _reg(name, ctes, sides, extra_cols=()):
    body, all_ctes = two_side_sql(ctes, sides, extra_cols)
    return register(name, body, all_ctes)


# ---------------------------------------------------------------------------
# Queries
# ---------------------------------------------------------------------------


@register("team_long", "SELECT event_type_id, team_id, opponent_id, event_id, start_time, is_home, gf, ga, "
          "total, cap, over, win, played FROM tlv", TL_CTES)
def team_long(spark, d):
    """Home rows UNION ALL away rows: the OR-free base of every team feature."""
    return _ctx(spark, d)[1]


@register("team_matches", """SELECT t.team_id, tn.name AS team_name, t.opponent_id, o.name AS opponent_name,
  t.event_id, t.start_time, t.is_home, t.gf, t.ga
FROM tlv t JOIN fx_team tn ON tn.team_id = t.team_id JOIN fx_team o ON o.team_id = t.opponent_id""", TL_CTES)
def team_matches(spark, d):
    """Every match of every team in either role, with team and opponent names."""
    t = fixture_tables(spark, d)
    tl = M.team_long(M.match_core(t))
    me = t.team.select(F.col("team_id"), F.col("name").alias("team_name"))
    opp = t.team.select(F.col("team_id").alias("opponent_id"), F.col("name").alias("opponent_name"))
    return (tl.join(me, "team_id").join(opp, "opponent_id")
              .select("team_id", "team_name", "opponent_id", "opponent_name", "event_id", "start_time",
                      "is_home", "gf", "ga"))


@_reg("expanding_form", [hist_cte("eh", "home_id"), hist_cte("ea", "away_id")],
      [("eh", "home", None, ALL), ("ea", "away", None, ALL)])
def expanding_form(spark, d):
    """Expanding averages over all earlier played matches of the team in the league."""
    mf, tl = _ctx(spark, d)
    tab = H.expanding_table(tl, H.LEAGUE_TEAM)
    return H.two_sided(_base(mf), tab).select("event_id", *H.rates("home"), *H.rates("away"))


@_reg("over_rate", [hist_cte("eh", "home_id"), hist_cte("ea", "away_id")],
      [("eh", "home", None, ("n", "over_rate")), ("ea", "away", None, ("n", "over_rate"))])
def over_rate(spark, d):
    """Team over rate against each earlier match's own cap (total goals > cap)."""
    mf, tl = _ctx(spark, d)
    tab = H.expanding_table(tl, H.LEAGUE_TEAM)
    out = H.two_sided(_base(mf), tab)
    return out.select("event_id", *H.rates("home", stats=("n", "over_rate")),
                      *H.rates("away", stats=("n", "over_rate")))


@_reg("venue_expanding", [hist_cte("hh", "home_id", venue=1), hist_cte("aa", "away_id", venue=0)],
      [("hh", "hh", 1.8, ("n", "scored", "conceded")), ("aa", "aa", 1.8, ("n", "scored", "conceded"))])
def venue_expanding(spark, d):
    """Home team's earlier home matches, away team's earlier away matches; default 1.8."""
    mf, tl = _ctx(spark, d)
    tab = H.expanding_table(tl, H.LEAGUE_TEAM_VENUE)
    out = H.two_sided(_base(mf), tab, pfx=("hh", "aa"), venue=True)
    keep = ("n", "scored", "conceded")
    return out.select("event_id", *H.rates("hh", 1.8, stats=keep), *H.rates("aa", 1.8, stats=keep))


def _v(alias: str, x: str, default: float) -> str:
    return f"coalesce(CAST({alias}.{x} AS DOUBLE) / NULLIF({alias}.n, 0), {default}E0)"


_VD, _VN = config.VENUE_DEFAULT, config.VENUE_LAST_N_DEFAULT
_CROSS = f"((({_v('l1', 'gf', _VN)} + {_v('l0', 'ga', _VN)}) + ({_v('l0', 'gf', _VN)} + {_v('l1', 'ga', _VN)})) / 2)"


@register("venue_expected_total", f"""SELECT m.event_id,
  {_v('h1', 'gf', _VD)} + {_v('h1', 'ga', _VD)} AS home_venue_total, {_v('a0', 'gf', _VD)} + {_v('a0', 'ga', _VD)} AS away_venue_total,
  over_under_cap - ({_v('h1', 'gf', _VD)} + {_v('a0', 'gf', _VD)}) AS cap_minus_venue_scored,
  {_CROSS} AS exp_total_venue_cross, {_CROSS} - over_under_cap AS venue_cross_minus_cap
FROM mf m LEFT JOIN h1 ON h1.event_id = m.event_id LEFT JOIN a0 ON a0.event_id = m.event_id
LEFT JOIN l1 ON l1.event_id = m.event_id LEFT JOIN l0 ON l0.event_id = m.event_id""", TL_CTES + (
    hist_cte("h1", "home_id", venue=1), hist_cte("a0", "away_id", venue=0),
    hist_cte("l1", "home_id", venue=1, n=config.LAST_N_FORM), hist_cte("l0", "away_id", venue=0, n=config.LAST_N_FORM)))
def venue_expected_total(spark, d):
    """Totals expected from venue averages: sums over all earlier home (away) matches, and the cross
    form over the last 10 of them, each with its own default."""
    mf, tl = _ctx(spark, d)
    every = H.two_sided(_base(mf), H.expanding_table(tl, H.LEAGUE_TEAM_VENUE), pfx=("h1", "a0"), venue=True,
                        carry=["over_under_cap"])
    last = H.two_sided(_base(mf), H.last_n_table(tl, H.LEAGUE_TEAM_VENUE, config.LAST_N_FORM), pfx=("l1", "l0"), venue=True)

    def avg(p, x, default):
        return F.coalesce(div(F.col(f"{p}_{x}"), F.col(f"{p}_n")), F.lit(default))
    cap = F.col("over_under_cap")
    cross = ((avg("l1", "gf", _VN) + avg("l0", "ga", _VN)) + (avg("l0", "gf", _VN) + avg("l1", "ga", _VN))) / 2
    return every.join(last, "event_id").select(
        "event_id", (avg("h1", "gf", _VD) + avg("h1", "ga", _VD)).alias("home_venue_total"),
        (avg("a0", "gf", _VD) + avg("a0", "ga", _VD)).alias("away_venue_total"),
        (cap - (avg("h1", "gf", _VD) + avg("a0", "gf", _VD))).alias("cap_minus_venue_scored"),
        cross.alias("exp_total_venue_cross"), (cross - cap).alias("venue_cross_minus_cap"))


@_reg("last_n_form", [hist_cte("lh", "home_id", n=config.LAST_N_FORM),
                      hist_cte("la", "away_id", n=config.LAST_N_FORM)],
      [("lh", "home_l10", None, ALL), ("la", "away_l10", None, ALL)])
def last_n_form(spark, d):
    """Last-10 form (any venue): scored, conceded, total, win rate, over rate, goal diff."""
    mf, tl = _ctx(spark, d)
    tab = H.last_n_table(tl, H.LEAGUE_TEAM, config.LAST_N_FORM)
    out = H.two_sided(_base(mf), tab, pfx=("home_l10", "away_l10"))
    return out.select("event_id", *H.rates("home_l10"), *H.rates("away_l10"))


_V3 = ("n", "scored", "conceded", "over_rate")
_VENUE_CTES = [hist_cte("hh", "home_id", venue=1, n=config.LAST_N_FORM),
               hist_cte("ha", "home_id", venue=0, n=config.LAST_N_FORM),
               hist_cte("aa", "away_id", venue=0, n=config.LAST_N_FORM),
               hist_cte("ah", "away_id", venue=1, n=config.LAST_N_FORM)]


def _v20_sql(p, a, b):
    n = f"(coalesce({a}.n, 0) + coalesce({b}.n, 0))"
    on = f"(coalesce({a}.over_n, 0) + coalesce({b}.over_n, 0))"
    return [
        r6(f"(CAST(coalesce({a}.gf, 0) + coalesce({b}.gf, 0) AS DOUBLE) / NULLIF({n}, 0))") + f" AS {p}_v20_scored",
        r6(f"(CAST(coalesce({a}.ga, 0) + coalesce({b}.ga, 0) AS DOUBLE) / NULLIF({n}, 0))") + f" AS {p}_v20_conceded",
        r6(f"(CAST(coalesce({a}.over, 0) + coalesce({b}.over, 0) AS DOUBLE) / NULLIF({on}, 0))")
        + f" AS {p}_v20_over_rate",
    ]


@_reg("venue_last_n", _VENUE_CTES,
      [("hh", "hh10", None, _V3), ("aa", "aa10", None, _V3), ("ha", "ha10", None, ("n",)),
       ("ah", "ah10", None, ("n",))],
      extra_cols=_v20_sql("home", "hh", "ha") + _v20_sql("away", "aa", "ah"))
def venue_last_n(spark, d):
    """Last 10 at the matching venue (home at home, away away) and the 10 + 10 union
    of both venues per team."""
    mf = M.match_core(fixture_tables(spark, d))
    tab = H.last_n_table(M.team_long(mf, with_flipped_venues=True), H.LEAGUE_TEAM_VENUE, config.LAST_N_FORM)
    out = H.lookup_sides(_base(mf), tab, [("hh10", "home_id", 1), ("aa10", "away_id", 0),
                                          ("ha10", "home_id", 0), ("ah10", "away_id", 1)])

    def v20(p, a, b):
        n = F.col(f"{a}_n") + F.col(f"{b}_n")
        on = F.col(f"{a}_over_n") + F.col(f"{b}_over_n")
        return [div(F.col(f"{a}_gf") + F.col(f"{b}_gf"), n).alias(f"{p}_v20_scored"),
                div(F.col(f"{a}_ga") + F.col(f"{b}_ga"), n).alias(f"{p}_v20_conceded"),
                div(F.col(f"{a}_over") + F.col(f"{b}_over"), on).alias(f"{p}_v20_over_rate")]

    def pick(p, keep):
        return H.rates(p, stats=keep)
    return out.select("event_id", *pick("hh10", _V3), *pick("aa10", _V3), *pick("ha10", ("n",)),
                      *pick("ah10", ("n",)), *v20("home", "hh10", "ha10"), *v20("away", "aa10", "ah10"))


@_reg("recent_total_form", [hist_cte("hh", "home_id", venue=1, n=config.LAST_N_SHORT),
                            hist_cte("aa", "away_id", venue=0, n=config.LAST_N_SHORT)],
      [("hh", "hh5", None, ("n", "total")), ("aa", "aa5", None, ("n", "total"))],
      extra_cols=[r6("(coalesce(CAST(hh.tot AS DOUBLE) / NULLIF(hh.n, 0), 2.5E0) + "
                     "coalesce(CAST(aa.tot AS DOUBLE) / NULLIF(aa.n, 0), 2.5E0))") + " AS combined_form"])
def recent_total_form(spark, d):
    """Last-5 average total goals: home team at home, away team away; form sum (default 2.5)."""
    mf, tl = _ctx(spark, d)
    tab = H.last_n_table(tl, H.LEAGUE_TEAM_VENUE, config.LAST_N_SHORT)
    out = H.two_sided(_base(mf), tab, pfx=("hh5", "aa5"), venue=True)
    form = (F.coalesce(div(F.col("hh5_tot"), F.col("hh5_n")), F.lit(2.5))
            + F.coalesce(div(F.col("aa5_tot"), F.col("aa5_n")), F.lit(2.5)))
    return out.select("event_id", F.col("hh5_n"), div(F.col("hh5_tot"), F.col("hh5_n")).alias("hh5_total"),
                      F.col("aa5_n"), div(F.col("aa5_tot"), F.col("aa5_n")).alias("aa5_total"),
                      form.alias("combined_form"))


@_reg("recent_over_rate", [hist_cte("lh", "home_id", n=config.LAST_N_SHORT),
                           hist_cte("la", "away_id", n=config.LAST_N_SHORT)],
      [("lh", "home_l5", None, ("n",)), ("la", "away_l5", None, ("n",))],
      extra_cols=[r6("coalesce(CAST(lh.over AS DOUBLE) / NULLIF(lh.over_n, 0), 0.5E0)") + " AS home_l5_over_rate",
                  r6("coalesce(CAST(la.over AS DOUBLE) / NULLIF(la.over_n, 0), 0.5E0)") + " AS away_l5_over_rate"])
def recent_over_rate(spark, d):
    """Last-5 over rate (any venue), default 0.5."""
    mf, tl = _ctx(spark, d)
    tab = H.last_n_table(tl, H.LEAGUE_TEAM, config.LAST_N_SHORT)
    out = H.two_sided(_base(mf), tab, pfx=("home_l5", "away_l5"))
    return out.select("event_id", "home_l5_n", "away_l5_n",
                      F.coalesce(div(F.col("home_l5_over"), F.col("home_l5_over_n")), F.lit(0.5)).alias("home_l5_over_rate"),
                      F.coalesce(div(F.col("away_l5_over"), F.col("away_l5_over_n")), F.lit(0.5)).alias("away_l5_over_rate"))


def _min_games_sql(a, p):
    ok = f"coalesce({a}.n, 0) >= {config.ROLLING_MIN_GAMES}"
    return [f"CAST(coalesce({a}.n, 0) AS BIGINT) AS {p}_games",
            r6(f"CASE WHEN {ok} THEN CAST({a}.gf AS DOUBLE) / {a}.n ELSE 2.5E0 END") + f" AS {p}_scored",
            r6(f"CASE WHEN {ok} THEN CAST({a}.ga AS DOUBLE) / {a}.n ELSE 2.5E0 END") + f" AS {p}_conceded",
            r6(f"CASE WHEN {ok} THEN coalesce(CAST({a}.over AS DOUBLE) / NULLIF({a}.over_n, 0), 0.5E0) ELSE 0.5E0 END")
            + f" AS {p}_over_rate"]


@register("rolling_with_min", "SELECT m.event_id, " + ", ".join(_min_games_sql("lh", "home_r5") + _min_games_sql("la", "away_r5"))
          + "\nFROM mf m LEFT JOIN lh ON lh.event_id = m.event_id LEFT JOIN la ON la.event_id = m.event_id",
          TL_CTES + (hist_cte("lh", "home_id", n=config.LAST_N_SHORT), hist_cte("la", "away_id", n=config.LAST_N_SHORT)))
def rolling_with_min(spark, d):
    """Rolling-5 scored / conceded / over rate with a 2-game minimum (defaults 2.5 / 2.5 / 0.5)."""
    mf, tl = _ctx(spark, d)
    tab = H.last_n_table(tl, H.LEAGUE_TEAM, config.LAST_N_SHORT)
    out = H.two_sided(_base(mf), tab, pfx=("home_r5", "away_r5"))
    cols = []
    for p in ("home_r5", "away_r5"):
        ok = F.col(f"{p}_n") >= config.ROLLING_MIN_GAMES
        cols += [F.col(f"{p}_n").alias(f"{p}_games"),
                 F.when(ok, div(F.col(f"{p}_gf"), F.col(f"{p}_n"))).otherwise(F.lit(2.5)).alias(f"{p}_scored"),
                 F.when(ok, div(F.col(f"{p}_ga"), F.col(f"{p}_n"))).otherwise(F.lit(2.5)).alias(f"{p}_conceded"),
                 F.when(ok, F.coalesce(div(F.col(f"{p}_over"), F.col(f"{p}_over_n")), F.lit(0.5)))
                  .otherwise(F.lit(0.5)).alias(f"{p}_over_rate")]
    return out.select("event_id", *cols)


# --- cold start and derived pair features --------------------------------------

def _defaults_values():
    rows = []
    for lg, (_c, _p, prof, _s) in sorted(config.LEAGUES.items()):
        s, c, o, w, m = config.DEFAULT_PROFILES[prof]
        rows.append(f"({lg}, {s}E0, {c}E0, {o}E0, {w}E0, {m})")
    return ("SELECT * FROM (VALUES " + ", ".join(rows)
            + ") AS t(event_type_id, d_scored, d_conceded, d_over_rate, d_win_rate, d_min_games)")


def _cs_cols(a, p):
    ok = f"coalesce({a}.n, 0) >= dft.d_min_games"
    n = f"coalesce({a}.n, 0)"
    return [
        f"CAST({n} AS BIGINT) AS {p}_n",
        f"coalesce(CASE WHEN {ok} THEN CAST({a}.gf AS DOUBLE) / NULLIF({n}, 0) END, dft.d_scored) AS {p}_scored",
        f"coalesce(CASE WHEN {ok} THEN CAST({a}.ga AS DOUBLE) / NULLIF({n}, 0) END, dft.d_conceded) AS {p}_conceded",
        f"coalesce(CASE WHEN {ok} THEN CAST({a}.over AS DOUBLE) / NULLIF({a}.over_n, 0) END, dft.d_over_rate) AS {p}_over_rate",
        f"coalesce(CASE WHEN {ok} THEN CAST({a}.win AS DOUBLE) / NULLIF({n}, 0) END, dft.d_win_rate) AS {p}_win_rate",
    ]


CS_CTES = TL_CTES + (
    hist_cte("eh", "home_id"), hist_cte("ea", "away_id"), ("dft", _defaults_values()),
    ("cs", "SELECT m.event_id, m.over_under_cap, " + ", ".join(_cs_cols("eh", "home") + _cs_cols("ea", "away"))
     + "\nFROM mf m LEFT JOIN eh ON eh.event_id = m.event_id LEFT JOIN ea ON ea.event_id = m.event_id"
       "\nLEFT JOIN dft ON dft.event_type_id = m.event_type_id"),
)
_CS_OUT = ["home_n", "home_scored", "home_conceded", "home_over_rate", "home_win_rate",
           "away_n", "away_scored", "away_conceded", "away_over_rate", "away_win_rate"]


@register("cold_start_defaults", "SELECT event_id, " + ", ".join(
    c for c in _CS_OUT) + " FROM cs", CS_CTES)
def cold_start_defaults(spark, d):
    """Expanding form with the league's cold-start defaults below its minimum games."""
    return cold_start_frame(spark, d).select("event_id", *_CS_OUT)


_PROFILE_VALUES = ", ".join(f"('{p}', " + ", ".join(f"{x}E0" for x in v[:6]) + f", {v[6]})" for p, v in config.SIDE_PROFILES.items())


def _profile_sql(a: str, side: str) -> list[str]:
    ok, n = f"coalesce({a}.n, 0) >= p.min_games", f"{a}.n"
    return [f"coalesce(CASE WHEN {ok} THEN CAST({a}.{x} AS DOUBLE) / NULLIF({by}, 0) END, p.{side}_{stat}) AS {side}_{stat}"
            for x, by, stat in (("gf", n, "scored"), ("ga", n, "conceded"), ("over", f"{a}.over_n", "over_rate"))]


@register("cold_start_profiles", "SELECT m.event_id, p.profile, " + ", ".join(_profile_sql("eh", "home") + _profile_sql("ea", "away"))
          + " FROM mf m LEFT JOIN eh ON eh.event_id = m.event_id LEFT JOIN ea ON ea.event_id = m.event_id "
            f"CROSS JOIN (VALUES {_PROFILE_VALUES}) AS p(profile, home_scored, home_conceded, home_over_rate, away_scored, "
            "away_conceded, away_over_rate, min_games)", TL_CTES + (hist_cte("eh", "home_id"), hist_cte("ea", "away_id")))
def cold_start_profiles(spark, d):
    """Expanding form of every match filled by each profile whose sides have their own defaults."""
    mf, tl = _ctx(spark, d)
    out = H.two_sided(_base(mf), H.expanding_table(tl, H.LEAGUE_TEAM)).select("event_id", *H.rates("home"), *H.rates("away"))
    return H.with_side_profiles(out, config.SIDE_PROFILES)


_HS, _HC, _AS, _AC = "home_scored", "home_conceded", "away_scored", "away_conceded"


def _pair_sql(exprs):
    return "SELECT event_id, " + ", ".join(f"{e} AS {a}" for e, a in exprs) + " FROM cs"


_STRENGTH = [(f"({_HS} - {_HC})", "home_strength"), (f"({_AS} - {_AC})", "away_strength"),
             (f"(({_HS} - {_HC}) - ({_AS} - {_AC}))", "strength_diff")]


@register("strength_diff", _pair_sql(_STRENGTH), CS_CTES)
def strength_diff(spark, d):
    """Strength = avg scored - avg conceded per side, and their difference."""
    cs = cold_start_frame(spark, d)
    hs, hc, as_, ac = (F.col(c) for c in (_HS, _HC, _AS, _AC))
    return cs.select("event_id", (hs - hc).alias("home_strength"), (as_ - ac).alias("away_strength"),
                     ((hs - hc) - (as_ - ac)).alias("strength_diff"))


_EXPECTED = [
    (f"(({_HS} + {_AS} + {_HC} + {_AC}) / 2)", "exp_total_half"),
    (f"(({_HS} + {_AS} + {_HC} + {_AC}) / 4)", "exp_total_quarter"),
    (f"({_HS} + {_AS})", "exp_scored_sum"),
    (f"((({_HS} + {_AC}) + ({_AS} + {_HC})) / 2)", "exp_total_cross"),
    (f"(over_under_cap - ({_HS} + {_AS} + {_HC} + {_AC}) / 2)", "cap_minus_expected"),
    (f"(({_HS} + {_AS} + {_HC} + {_AC}) / 2 - over_under_cap)", "expected_minus_cap"),
]


@register("expected_total", _pair_sql(_EXPECTED), CS_CTES)
def expected_total(spark, d):
    """Expected total goals in its documented forms, and cap vs expected in both signs."""
    cs = cold_start_frame(spark, d)
    hs, hc, as_, ac, cap = (F.col(c) for c in (_HS, _HC, _AS, _AC, "over_under_cap"))
    half = (hs + as_ + hc + ac) / 2
    return cs.select("event_id", half.alias("exp_total_half"),
                     ((hs + as_ + hc + ac) / 4).alias("exp_total_quarter"),
                     (hs + as_).alias("exp_scored_sum"),
                     (((hs + ac) + (as_ + hc)) / 2).alias("exp_total_cross"),
                     (cap - (hs + as_ + hc + ac) / 2).alias("cap_minus_expected"),
                     ((hs + as_ + hc + ac) / 2 - cap).alias("expected_minus_cap"))


@register("attack_vs_defense", _pair_sql([(f"(({_HS} - {_AC}) - ({_AS} - {_HC}))", "attack_vs_defense")]),
          CS_CTES)
def attack_vs_defense(spark, d):
    """(home scored - away conceded) - (away scored - home conceded)."""
    cs = cold_start_frame(spark, d)
    hs, hc, as_, ac = (F.col(c) for c in (_HS, _HC, _AS, _AC))
    return cs.select("event_id", ((hs - ac) - (as_ - hc)).alias("attack_vs_defense"))


_PAIRS = [(f"({_HS} + {_AS})", "scored_sum"), (f"({_HC} + {_AC})", "conceded_sum"),
          (f"({_HS} - {_AS})", "scored_diff"), ("((home_over_rate + away_over_rate) / 2)", "avg_over_rate"),
          ("(home_over_rate - away_over_rate)", "over_rate_diff"), ("(home_win_rate - away_win_rate)", "win_rate_diff")]


@register("pair_combos", _pair_sql(_PAIRS), CS_CTES)
def pair_combos(spark, d):
    """Sums, differences and averages of the two sides' rates and goals."""
    cs = cold_start_frame(spark, d)
    c = F.col
    return cs.select("event_id", (c(_HS) + c(_AS)).alias("scored_sum"), (c(_HC) + c(_AC)).alias("conceded_sum"),
                     (c(_HS) - c(_AS)).alias("scored_diff"),
                     ((c("home_over_rate") + c("away_over_rate")) / 2).alias("avg_over_rate"),
                     (c("home_over_rate") - c("away_over_rate")).alias("over_rate_diff"),
                     (c("home_win_rate") - c("away_win_rate")).alias("win_rate_diff"))


# --- positional, joint, league-level and top-k history -------------------------

@register("expanding_rows", """SELECT pm.event_id, CAST(li.league_idx AS BIGINT) AS league_idx,
  CASE WHEN li.league_idx >= 3 THEN CAST(h.sgf AS DOUBLE) / NULLIF(h.n, 0) END AS home_avg_scored,
  CASE WHEN li.league_idx >= 3 THEN CAST(h.sga AS DOUBLE) / NULLIF(h.n, 0) END AS home_avg_conceded,
  CASE WHEN li.league_idx >= 3 THEN CAST(a.sgf AS DOUBLE) / NULLIF(a.n, 0) END AS away_avg_scored,
  CASE WHEN li.league_idx >= 3 THEN CAST(a.sga AS DOUBLE) / NULLIF(a.n, 0) END AS away_avg_conceded
FROM pm JOIN li ON li.event_id = pm.event_id
JOIN tp h ON h.event_id = pm.event_id AND h.is_home = 1
JOIN tp a ON a.event_id = pm.event_id AND a.is_home = 0""", TL_CTES + (
    ("pm", "SELECT * FROM mfp WHERE played = 1"),
    ("li", "SELECT event_id, row_number() OVER (PARTITION BY event_type_id ORDER BY start_time, event_id) - 1 "
           "AS league_idx FROM pm"),
    ("tp", """SELECT event_id, is_home, sum(gf) OVER w AS sgf, sum(ga) OVER w AS sga, count(*) OVER w AS n
FROM tlv WHERE played = 1
WINDOW w AS (PARTITION BY event_type_id, team_id ORDER BY start_time, event_id
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"""),
))
def expanding_rows(spark, d):
    """Row-position expanding form: rows before this one in the league frame ordered by
    (start_time, event_id), NULL until the league frame has 3 earlier matches."""
    mf, tl = _ctx(spark, d)
    pm = mf.filter(M.is_played())
    idx = H.league_position(pm)
    hist = tl.filter(F.col("played") == 1)
    pos = positions(hist, H.LEAGUE_TEAM, "start_time", ["event_id"], {"gf": F.col("gf"), "ga": F.col("ga")},
                    carry=["is_home"])
    tp = pos.select("event_id", "is_home", (F.col("pos") - 1).alias("n"),
                    (F.col("gf_cum") - F.col("gf")).alias("sgf"), (F.col("ga_cum") - F.col("ga")).alias("sga"))
    h = tp.filter(F.col("is_home") == 1).select("event_id", *[F.col(c).alias(f"h_{c}") for c in ("n", "sgf", "sga")])
    a = tp.filter(F.col("is_home") == 0).select("event_id", *[F.col(c).alias(f"a_{c}") for c in ("n", "sgf", "sga")])
    out = pm.select("event_id").join(idx, "event_id").join(h, "event_id").join(a, "event_id")
    gate = F.col("league_idx") >= 3
    return out.select("event_id", "league_idx",
                      F.when(gate, div(F.col("h_sgf"), F.col("h_n"))).alias("home_avg_scored"),
                      F.when(gate, div(F.col("h_sga"), F.col("h_n"))).alias("home_avg_conceded"),
                      F.when(gate, div(F.col("a_sgf"), F.col("a_n"))).alias("away_avg_scored"),
                      F.when(gate, div(F.col("a_sga"), F.col("a_n"))).alias("away_avg_conceded"))


_JOINT_DEFAULT = 2.3


@register("joint_recent_form", f"""SELECT m.event_id, CAST(count(j.c_event_id) AS BIGINT) AS n_joint,
  CAST(count(CASE WHEN j.ch = m.home_id THEN 1 END) AS BIGINT) AS home_n,
  coalesce(avg(CASE WHEN j.ch = m.home_id THEN CAST(j.hs AS DOUBLE) END), {_JOINT_DEFAULT}E0) AS home_avg_scored,
  coalesce(avg(CASE WHEN j.ch = m.home_id THEN CAST(j.as_ AS DOUBLE) END), {_JOINT_DEFAULT}E0) AS home_avg_conceded,
  CAST(count(CASE WHEN j.ca = m.away_id THEN 1 END) AS BIGINT) AS away_n,
  coalesce(avg(CASE WHEN j.ca = m.away_id THEN CAST(j.as_ AS DOUBLE) END), {_JOINT_DEFAULT}E0) AS away_avg_scored,
  coalesce(avg(CASE WHEN j.ca = m.away_id THEN CAST(j.hs AS DOUBLE) END), {_JOINT_DEFAULT}E0) AS away_avg_conceded
FROM mf m LEFT JOIN (SELECT * FROM jc WHERE rn <= {config.RECENT_LIMIT}) j ON j.event_id = m.event_id
GROUP BY m.event_id, m.home_id, m.away_id""", TL_CTES + (
    ("jk", f"""SELECT event_id, team_id, is_home, count(*) FILTER (WHERE played = 1) OVER
       (PARTITION BY team_id, is_home {BEFORE}) AS k FROM tlv"""),
    ("jp", """SELECT event_id, team_id, is_home, row_number() OVER (PARTITION BY team_id, is_home
       ORDER BY start_time, event_id) AS pos FROM tlv WHERE played = 1"""),
    ("jd", f"""SELECT DISTINCT k.event_id, jp.event_id AS c_event_id
FROM (SELECT *, unnest(range(greatest(k - {config.RECENT_LIMIT}, 0) + 1, k + 1)) AS pos FROM jk) k
JOIN jp ON jp.team_id = k.team_id AND jp.is_home = k.is_home AND jp.pos = k.pos"""),
    ("jc", """SELECT jd.event_id, jd.c_event_id, h.home_id AS ch, h.away_id AS ca, h.home_ft_score AS hs,
       h.away_ft_score AS as_,
       row_number() OVER (PARTITION BY jd.event_id ORDER BY h.start_time DESC, h.event_id DESC) AS rn
FROM jd JOIN mfp h ON h.event_id = jd.c_event_id"""),
))
def joint_recent_form(spark, d):
    """30 most recent earlier matches with the home team at home or the away team away
    (any league); per-side averages from that joint list, default 2.3."""
    mf, tl = _ctx(spark, d)
    agg = H.joint_recent(tl, mf)
    out = mf.select("event_id").join(agg, "event_id", "left")
    dft = F.lit(_JOINT_DEFAULT)
    return out.select(
        "event_id", F.coalesce("n_joint", F.lit(0)).cast("bigint").alias("n_joint"),
        F.coalesce("home_n", F.lit(0)).cast("bigint").alias("home_n"),
        F.coalesce(div(F.col("_hgf"), F.col("home_n")), dft).alias("home_avg_scored"),
        F.coalesce(div(F.col("_hga"), F.col("home_n")), dft).alias("home_avg_conceded"),
        F.coalesce("away_n", F.lit(0)).cast("bigint").alias("away_n"),
        F.coalesce(div(F.col("_agf"), F.col("away_n")), dft).alias("away_avg_scored"),
        F.coalesce(div(F.col("_aga"), F.col("away_n")), dft).alias("away_avg_conceded"))


@register("history_before_event", f"""SELECT event_id, event_type_id, start_time, league_n_before,
  CAST(tot AS DOUBLE) / NULLIF(league_n_before, 0) AS league_avg_total_before
FROM (SELECT event_id, event_type_id, start_time, played, count(*) FILTER (WHERE played = 1) OVER w AS league_n_before,
        sum(home_ft_score + away_ft_score) FILTER (WHERE played = 1) OVER w AS tot
      FROM mfp WINDOW w AS (PARTITION BY event_type_id {BEFORE}))
WHERE played = 0""", TL_CTES)
def history_before_event(spark, d):
    """For every request (unplayed match): league matches played strictly before it."""
    mf = M.match_core(fixture_tables(spark, d))
    played = M.is_played()
    m = mf.select("event_id", "event_type_id", "start_time", played.cast("int").alias("played"),
                  F.when(played, F.col("home_ft_score") + F.col("away_ft_score")).alias("total"))
    pre = time_prefix(m, ["event_type_id"], "start_time", {"n": F.col("played"), "tot": F.col("total")})
    req = m.filter(F.col("played") == 0).join(pre, ["event_type_id", "start_time"], "left")
    return req.select("event_id", "event_type_id", "start_time", F.col("n_before").alias("league_n_before"),
                      div(F.col("tot_before"), F.col("n_before")).alias("league_avg_total_before"))


@register("topk_recent_per_team", f"""SELECT team_id, event_id, start_time,
  CAST(row_number() OVER (PARTITION BY team_id ORDER BY start_time DESC, event_id DESC) AS INT) AS rn
FROM tlv WHERE played = 1
QUALIFY rn <= {config.RECENT_LIMIT}""", TL_CTES)
def topk_recent_per_team(spark, d):
    """Each team's 30 most recent played matches (top-k per group; partial limit before
    the shuffle keeps a hot team from landing whole in one task)."""
    _mf, tl = _ctx(spark, d)
    w = Window.partitionBy("team_id").orderBy(F.col("start_time").desc(), F.col("event_id").desc())
    return (tl.filter(F.col("played") == 1).select("team_id", "event_id", "start_time")
              .withColumn("rn", F.row_number().over(w)).filter(F.col("rn") <= config.RECENT_LIMIT))


@register("match_features", """SELECT q.event_id, q.p_over_fair, q.ou_overround, q.cap_minus_25, q.ou_odds_ratio,
  c.home_n, c.home_scored, c.home_conceded, c.home_over_rate, c.away_n, c.away_scored, c.away_conceded,
  c.away_over_rate, (c.home_scored + c.away_scored + c.home_conceded + c.away_conceded) / 2 AS exp_total_half,
  (c.home_over_rate + c.away_over_rate) / 2 AS avg_over_rate
FROM qm q JOIN cs c ON c.event_id = q.event_id""", CS_CTES + (
    ("qm", """SELECT m.event_id,
       (1.0E0 / NULLIF(over_odd, 0)) / NULLIF((1.0E0 / NULLIF(over_odd, 0)) + (1.0E0 / NULLIF(under_odd, 0)), 0) AS p_over_fair,
       ((1.0E0 / NULLIF(over_odd, 0)) + (1.0E0 / NULLIF(under_odd, 0))) AS ou_overround,
       (over_under_cap - 2.5E0) AS cap_minus_25, (over_odd / NULLIF(under_odd, 0)) AS ou_odds_ratio
FROM mf m WHERE over_odd IS NOT NULL"""),))
def match_features(spark, d):
    """The per-match feature vector: market features plus both teams' leak-free history
    (cold-start filled), joined on event_id - no per-row history filtering."""
    from oddsframe.operators import learn as L
    cs = cold_start_frame(spark, d)
    mf = M.match_core(fixture_tables(spark, d)).filter(F.col("over_odd").isNotNull())
    q = mf.select("event_id", *L.market_columns())
    hs, hc, as_, ac = (F.col(c) for c in ("home_scored", "home_conceded", "away_scored", "away_conceded"))
    return q.join(cs, "event_id").select(
        "event_id", "p_over_fair", "ou_overround", "cap_minus_25", "ou_odds_ratio",
        "home_n", "home_scored", "home_conceded", "home_over_rate",
        "away_n", "away_scored", "away_conceded", "away_over_rate",
        ((hs + as_ + hc + ac) / 2).alias("exp_total_half"),
        ((F.col("home_over_rate") + F.col("away_over_rate")) / 2).alias("avg_over_rate"))
