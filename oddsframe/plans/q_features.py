"""Query: the ordered feature vectors of every match."""

from __future__ import annotations

from pyspark.sql import functions as F

from oddsframe import config
from oddsframe.operators import features as FT
from oddsframe.operators import matches as M
from oddsframe.plans.oracle_base import PLAYED
from oddsframe.plans.q_history import BEFORE, TL_CTES, hist_cte
from oddsframe.plans.registry import register
from oddsframe.plans.sqlx import P_AWAY_FAIR, P_HOME_FAIR, P_OVER, P_OVER_FAIR, P_UNDER, P_UNDER_FAIR, X12_SUM, div, inv, rr6
from oddsframe.sources.tables import fixture_tables
from oddsframe.vectors import FILL, LEAGUE_VECTORS, VECTORS

RESOLVED = [FT.resolve(name, text, FILL.get(name)) for name, text in VECTORS.items()]
WIDTH = max(len(v.features) for v in RESOLVED)
PLACES = [f"f{i + 1:02d}" for i in range(WIDTH)]

# ---------------------------------------------------------------------------
# SQL side: market features and history statistics written out, then the vectors' own lines
# ---------------------------------------------------------------------------
_CAP = "over_under_cap"
_FAIR_HOME_HCP = div(inv("home_handicap_odd"), f"({inv('home_handicap_odd')} + {inv('away_handicap_odd')})")


def _logit(p: str) -> str:
    return f"ln(({p} + 1e-6) / NULLIF(1 - {p} + 1e-6, 0))"


def _guarded(odd: str, missing: str) -> str:
    return f"CASE WHEN {odd} > 0 THEN 1.0E0 / {odd} ELSE {missing}E0 END"


MARKET_SQL = {
    "p_over": P_OVER, "p_under": P_UNDER, "p_home": inv("home_odd"), "p_draw": inv("draw_odd"), "p_away": inv("away_odd"),
    "p_over_guarded": _guarded("over_odd", "0.5"), "p_under_guarded": _guarded("under_odd", "0.5"),
    "p_home_guarded": _guarded("home_odd", "0.33"), "p_draw_guarded": _guarded("draw_odd", "0.33"),
    "p_away_guarded": _guarded("away_odd", "0.33"),
    "ou_overround": f"{P_OVER} + {P_UNDER}", "ou_vig": f"{P_OVER} + {P_UNDER} - 1", "ou_odds_sum_minus_2": "over_odd + under_odd - 2",
    "x12_overround": X12_SUM, "x12_vig": f"{X12_SUM} - 1", "x12_margin_neg": f"1 - {X12_SUM}",
    "p_over_fair": P_OVER_FAIR, "p_under_fair": P_UNDER_FAIR, "p_home_fair": P_HOME_FAIR, "p_away_fair": P_AWAY_FAIR,
    "p_draw_fair": div(inv("draw_odd"), X12_SUM), "p_home_hcp_fair": _FAIR_HOME_HCP,
    "ou_odds_ratio": div("over_odd", "under_odd"), "ha_odds_ratio": div("home_odd", "away_odd"),
    "ou_odds_gap": "over_odd - under_odd", "uo_odds_gap": "under_odd - over_odd", "ha_odds_gap": "home_odd - away_odd",
    "ah_odds_gap": "away_odd - home_odd", "ou_prob_gap": f"{P_OVER} - {P_UNDER}",
    "ha_prob_gap": f"{inv('home_odd')} - {inv('away_odd')}",
    "market_over_lean": f"{P_OVER_FAIR} - 0.5", "market_abs_lean": f"abs({P_OVER_FAIR} - 0.5)",
    "market_over_lean_x2": f"({P_OVER_FAIR} - 0.5) * 2",
    "cap_minus_3": f"{_CAP} - 3", "cap_minus_25": f"{_CAP} - 2.5", "cap_half_units": f"({_CAP} - 2.5) / 0.5",
    "cap_abs_dev": f"abs({_CAP} - 2.5)",
    **{f"cap_is_{c}": f"CAST(abs({_CAP} - {c / 100}) < 0.01 AS INT)" for c in (200, 225, 250, 275, 300, 325, 350)},
    "cap_low": f"CAST({_CAP} <= 2.5 AS INT)", "cap_above_25": f"CAST({_CAP} > 2.5 AS INT)",
    "cap_above_275": f"CAST({_CAP} > 2.75 AS INT)",
    "cap_bin": f"""CASE WHEN {_CAP} IS NULL THEN NULL WHEN {_CAP} = 2 THEN 0 WHEN {_CAP} = 2.25 THEN 1 WHEN {_CAP} = 2.75 THEN 3
                   WHEN {_CAP} = 3 THEN 4 ELSE 2 END""",
    "home_favoured": "CAST(home_odd < away_odd AS INT)", "handicap_home_favoured": "CAST(home_cap < 0 AS INT)",
    "market_bias_over": f"CAST({P_OVER} > 0.5 AS INT)", "market_home_likelier": f"CAST({inv('home_odd')} > {inv('away_odd')} AS INT)",
    "x12_favourite_strength": f"greatest({P_HOME_FAIR}, {P_AWAY_FAIR})",
    "abs_home_cap": "abs(home_cap)", "cap_home_minus_away": "home_cap - away_cap", "home_cap_filled": "coalesce(home_cap, 0)",
    "handicap_odd_x_cap": "home_handicap_odd * home_cap",
    "log_ou_ratio": f"ln({div('over_odd', 'under_odd')} + 0.001)", "log_over_odd": "ln(over_odd)", "log_under_odd": "ln(under_odd)",
    "logit_over": _logit(P_OVER), "logit_home": _logit(inv("home_odd")),
    "over_juice": f"over_odd * {P_OVER_FAIR}", "under_juice": f"under_odd * (1 - {P_OVER_FAIR})",
    "over_odd_x_implied": f"over_odd * {P_OVER}", "under_odd_x_implied": f"under_odd * {P_UNDER}",
    "over_net_odd": "over_odd - 1", "under_net_odd": "under_odd - 1",
    "cap_plus_prob_gap": f"{_CAP} + 5 * ({P_OVER} - {P_UNDER})", "cap_per_over_odd": div(_CAP, "over_odd"),
    "cap_per_under_odd": div(_CAP, "under_odd"), "cap_x_fair_over": f"{_CAP} * {P_OVER_FAIR}",
    "cap_x_fair_home": f"{_CAP} * {P_HOME_FAIR}", "over_edge": f"{P_OVER} - (1 - {P_OVER_FAIR})",
    "expected_over_prob": f"1 - {P_UNDER_FAIR}", "market_vs_expected": f"(1 - {P_UNDER_FAIR}) - {P_OVER_FAIR}",
}


def _totals(a: str, b: str | None = None):
    """SQL of each statistic from the totals of one history table, or of two together."""
    def t(x: str) -> str:
        one = f"coalesce({a}.{x}, 0)"
        return one if b is None else f"({one} + coalesce({b}.{x}, 0))"

    def per(x: str, n: str) -> str:
        return f"CAST({x} AS DOUBLE) / NULLIF({n}, 0)"
    return {"n": t("n"), "scored": per(t("gf"), t("n")), "conceded": per(t("ga"), t("n")), "total": per(t("tot"), t("n")),
            "win_rate": per(t("win"), t("n")), "over_rate": per(t("over"), t("over_n")), "goal_diff": per(f"({t('gf')} - {t('ga')})", t("n"))}


def _history_sql() -> tuple[list[str], list[tuple[str, str]], list[str]]:
    """Columns, CTEs and joins of the history statistics that the vectors reach."""
    cols, ctes, joins = [], {}, []

    def table(side: str, venue: int | None, n: int | None) -> str:
        name = f"h_{side}_{'any' if venue is None else venue}_{n or 'all'}"
        if name not in ctes:
            ctes[name] = hist_cte(name, f"{side}_id", venue=venue, n=n)[1]
            joins.append(f"LEFT JOIN {name} ON {name}.event_id = m.event_id")
        return name

    for t, stats in sorted(FT.history_needed(RESOLVED).items()):
        kind, n = FT.TABLES[t]
        for side in ("home", "away"):
            if kind == "team":
                found = _totals(table(side, None, n))
            elif kind == "venue":
                found = (_totals(table(side, 1, n), table(side, 0, n)) if t.startswith("both")
                         else _totals(table(side, int(t.startswith("athome")), n)))
            elif kind == "joint":
                found = {"scored": f"jt.{side}_scored", "conceded": f"jt.{side}_conceded"}
            else:
                found = {"code": f"coalesce(code_{side}.idx, sz.n)"}
            cols += [f"{found[s]} AS {side}_{t}_{s}" for s in sorted(stats)]
    ctes = {"vocab": f"""SELECT team_id, dense_rank() OVER (ORDER BY team_id) - 1 AS idx
FROM (SELECT home_id AS team_id FROM fx_event WHERE {PLAYED} UNION SELECT away_id FROM fx_event WHERE {PLAYED})""",
            "sz": "SELECT count(*) AS n FROM vocab",
            "jk": f"""SELECT event_id, team_id, is_home, count(*) FILTER (WHERE played = 1) OVER
  (PARTITION BY team_id, is_home {BEFORE}) AS k FROM tlv""",
            "jp": """SELECT *, row_number() OVER (PARTITION BY team_id, is_home ORDER BY start_time, event_id) AS pos
FROM tlv WHERE played = 1""",
            "jr": f"""SELECT k.event_id, jp.is_home, jp.gf, jp.ga,
  dense_rank() OVER (PARTITION BY k.event_id ORDER BY jp.start_time DESC, jp.event_id DESC) AS rn
FROM (SELECT *, unnest(range(greatest(k - {config.RECENT_LIMIT}, 0) + 1, k + 1)) AS pos FROM jk) k
JOIN jp ON jp.team_id = k.team_id AND jp.is_home = k.is_home AND jp.pos = k.pos""",
            "jt": f"""SELECT event_id, avg(gf) FILTER (WHERE is_home = 1) AS home_scored, avg(ga) FILTER (WHERE is_home = 1) AS home_conceded,
  avg(gf) FILTER (WHERE is_home = 0) AS away_scored, avg(ga) FILTER (WHERE is_home = 0) AS away_conceded
FROM jr WHERE rn <= {config.RECENT_LIMIT} GROUP BY event_id""", **ctes}
    joins += ["LEFT JOIN jt ON jt.event_id = m.event_id", "LEFT JOIN vocab code_home ON code_home.team_id = m.home_id",
              "LEFT JOIN vocab code_away ON code_away.team_id = m.away_id", "CROSS JOIN sz"]
    return cols, list(ctes.items()), joins


def _vector_sql(v: FT.Vector, league: int) -> str:
    filled = [f"CAST({e} AS DOUBLE)" if v.fill is None else f"coalesce({e}, {v.fill}E0)" for e in v.expressions]
    cells = [rr6(e) for e in filled] + ["CAST(NULL AS DOUBLE)"] * (WIDTH - len(filled))
    return (f"SELECT event_id, '{v.name}' AS vector, CAST({len(filled)} AS INT) AS n_features, "
            + ", ".join(f"{c} AS {p}" for c, p in zip(cells, PLACES)) + f" FROM known WHERE event_type_id = {league}")


_COLS, _CTES, _JOINS = _history_sql()
_REACHED = set().union(*(v.columns() for v in RESOLVED))
_KNOWN = "SELECT m.*, " + ", ".join([f"{e} AS {k}" for k, e in MARKET_SQL.items() if k in _REACHED] + _COLS) + "\nFROM mf m " + "\n".join(_JOINS)
_BY_NAME = {v.name: v for v in RESOLVED}


@register("feature_vectors", "\nUNION ALL\n".join(_vector_sql(_BY_NAME[n], league) for league, names in LEAGUE_VECTORS.items() for n in names),
          TL_CTES + (*_CTES, ("known", _KNOWN)), rounded=True)
def feature_vectors(spark, d):
    """All fourteen documented vectors, each over the matches of a league it is dealt to: its features in their order."""
    t = fixture_tables(spark, d)
    known = FT.feature_frame(spark, M.match_frame(t), RESOLVED)
    rows = FT.assemble(known, RESOLVED, LEAGUE_VECTORS)
    return rows.select("event_id", "vector", F.size("values").alias("n_features"),
                       *[F.get("values", F.lit(i)).alias(p) for i, p in enumerate(PLACES)])
