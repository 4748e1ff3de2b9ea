"""Queries: market (odds) features, one query per feature group (all over the match frame)."""

from __future__ import annotations

from oddsframe.functions import market
from oddsframe.operators import matches as M
from oddsframe.plans.registry import register
from oddsframe.plans.sqlx import (OU_SUM, P_AWAY_FAIR, P_HOME_FAIR, P_OVER, P_OVER_FAIR, P_UNDER,
                                  P_UNDER_FAIR, X12_SUM, cols, div, inv, r6, rr6)
from oddsframe.sources.tables import fixture_tables


def _market_query(group: str, sql_cols: list[tuple[str, str]], rounded: bool = False):
    body = "SELECT event_id,\n  " + cols(*sql_cols) + "\nFROM mf"

    def q(spark, d):
        mf = M.match_frame(fixture_tables(spark, d))
        return mf.select("event_id", *market.GROUPS[group]())
    q.__name__ = group
    q.__doc__ = f"Market features '{group}' for every match (column expressions over the match frame)."
    return register(group, body, rounded=rounded)(q)


def _g(x: str, missing: str) -> str:
    return f"CASE WHEN {x} > 0 THEN {inv(x)} ELSE {missing} END"


_market_query("implied_probs", [
    (r6(P_OVER), "p_over"), (r6(P_UNDER), "p_under"),
    (r6(inv("home_odd")), "p_home"), (r6(inv("draw_odd")), "p_draw"), (r6(inv("away_odd")), "p_away"),
    (r6(_g("over_odd", "0.5E0")), "p_over_guarded"), (r6(_g("under_odd", "0.5E0")), "p_under_guarded"),
    (r6(_g("home_odd", "0.33E0")), "p_home_guarded"), (r6(_g("draw_odd", "0.33E0")), "p_draw_guarded"),
    (r6(_g("away_odd", "0.33E0")), "p_away_guarded"),
])

_market_query("overround", [
    (r6(OU_SUM), "ou_overround"), (r6(f"({OU_SUM} - 1)"), "ou_vig"),
    (r6("(over_odd + under_odd - 2)"), "ou_odds_sum_minus_2"),
    (r6(X12_SUM), "x12_overround"), (r6(f"({X12_SUM} - 1)"), "x12_vig"),
    (r6(f"(1.0E0 - {X12_SUM})"), "x12_margin_neg"),
])

_HP, _AP = inv("home_handicap_odd"), inv("away_handicap_odd")
_market_query("vig_free", [
    (r6(P_OVER_FAIR), "p_over_fair"), (r6(P_UNDER_FAIR), "p_under_fair"),
    (r6(P_HOME_FAIR), "p_home_fair"), (r6(div(inv("draw_odd"), X12_SUM)), "p_draw_fair"),
    (r6(P_AWAY_FAIR), "p_away_fair"),
    (r6(div(inv("home_odd"), f"({X12_SUM} + 1.0E-6)")), "p_home_fair_eps"),
    (r6(f"coalesce({P_HOME_FAIR}, 0.5E0)"), "p_home_fair_or_half"),
    (r6(div(_HP, f"({_HP} + {_AP})")), "p_home_hcp_fair"),
    (r6(div(_AP, f"({_HP} + {_AP})")), "p_away_hcp_fair"),
])

_OUS, _XS = "(over_odd + under_odd)", "(home_odd + draw_odd + away_odd)"
_market_query("odds_share", [
    (r6(div("over_odd", _OUS)), "over_share"), (r6(div("under_odd", _OUS)), "under_share"),
    (r6(div("home_odd", _XS)), "home_share"), (r6(div("draw_odd", _XS)), "draw_share"),
    (r6(div("away_odd", _XS)), "away_share"),
])

_market_query("odds_ratios", [
    (r6(div("over_odd", "under_odd")), "ou_odds_ratio"), (r6(div("home_odd", "away_odd")), "ha_odds_ratio"),
])

_market_query("odds_gaps", [
    (r6("(over_odd - under_odd)"), "ou_odds_gap"), (r6("(under_odd - over_odd)"), "uo_odds_gap"),
    (r6("(home_odd - away_odd)"), "ha_odds_gap"), (r6("(away_odd - home_odd)"), "ah_odds_gap"),
    (r6(f"({P_OVER} - {P_UNDER})"), "ou_prob_gap"),
    (r6(f"({inv('home_odd')} - {inv('away_odd')})"), "ha_prob_gap"),
])

_LEAN = f"({P_OVER_FAIR} - 0.5)"
_market_query("market_lean", [
    (r6(_LEAN), "market_over_lean"), (r6(f"abs({_LEAN})"), "market_abs_lean"),
    (r6(f"({_LEAN} * 2)"), "market_over_lean_x2"),
])

_market_query("cap_features", [
    (r6("(over_under_cap - 3.0E0)"), "cap_minus_3"),
    (r6("(over_under_cap - 2.5E0)"), "cap_minus_25"),
    (r6("((over_under_cap - 2.5E0) / 0.5E0)"), "cap_half_units"),
    (r6("((over_under_cap - 2.5E0) / 1.5E0)"), "cap_norm_15"),
    (r6("abs(over_under_cap - 2.5E0)"), "cap_abs_dev"),
] + [(f"CAST(abs(over_under_cap - {v}E0) < 0.01E0 AS INT)", f"cap_is_{int(round(v * 100))}")
     for v in market.CAP_ONE_HOT])

_market_query("cap_buckets", [
    ("CAST(over_under_cap <= 2.5E0 AS INT)", "cap_low"),
    ("CAST(over_under_cap > 2.5E0 AND over_under_cap <= 2.75E0 AS INT)", "cap_25_275"),
    ("CAST(over_under_cap > 2.75E0 AND over_under_cap <= 3.0E0 AS INT)", "cap_275_30"),
    ("CAST(over_under_cap > 3.0E0 AND over_under_cap <= 3.5E0 AS INT)", "cap_30_35"),
    ("CAST(over_under_cap > 3.5E0 AS INT)", "cap_high"),
    ("CAST(over_under_cap > 2.5E0 AS INT)", "cap_above_25"),
    ("CAST(over_under_cap > 2.75E0 AS INT)", "cap_above_275"),
    ("CAST(CASE WHEN over_under_cap IS NULL THEN NULL " + " ".join(
        f"WHEN over_under_cap = {k}E0 THEN {v}" for k, v in market.CAP_BIN.items())
     + f" ELSE {market.CAP_BIN_DEFAULT} END AS INT)", "cap_bin"),
])

_market_query("favourite_flags", [
    ("CAST(over_odd < under_odd AS INT)", "over_favoured"),
    ("CAST(home_odd < away_odd AS INT)", "home_favoured"),
    ("CAST(home_cap < 0 AS INT)", "handicap_home_favoured"),
    (f"CAST(abs(over_odd - under_odd) < {market.MARKET_EVEN_TOL}E0 AS INT)", "market_even"),
    (f"CAST({P_OVER} > 0.5E0 AS INT)", "market_bias_over"),
    (f"CAST({inv('home_odd')} > {inv('away_odd')} AS INT)", "market_home_likelier"),
    (r6(f"greatest({P_OVER_FAIR}, 1.0E0 - {P_OVER_FAIR})"), "ou_favourite_strength"),
    (r6(f"greatest({P_HOME_FAIR}, {P_AWAY_FAIR})"), "x12_favourite_strength"),
])

_market_query("handicap_features", [
    (r6("abs(home_cap)"), "abs_home_cap"),
    (r6("(home_cap - away_cap)"), "cap_home_minus_away"),
    (r6("coalesce(home_cap, 0.0E0)"), "home_cap_filled"),
    (r6("(home_handicap_odd * home_cap)"), "handicap_odd_x_cap"),
])

_market_query("log_features", [
    (rr6(f"ln({div('over_odd', 'under_odd')} + 0.001E0)"), "log_ou_ratio"),
    (rr6("ln(over_odd)"), "log_over_odd"),
    (rr6("ln(under_odd)"), "log_under_odd"),
    *[(rr6(f"ln({div(f'{p} + 1.0E-6', f'1.0E0 - {p} + 1.0E-6')})"), name)
      for name, p in (("logit_over_fair", P_OVER_FAIR), ("logit_over", P_OVER), ("logit_home", inv("home_odd")))],
], rounded=True)

_market_query("juice", [
    (r6(f"(over_odd * {P_OVER_FAIR})"), "over_juice"),
    (r6(f"(under_odd * (1.0E0 - {P_OVER_FAIR}))"), "under_juice"),
    (r6(f"(over_odd * {P_OVER})"), "over_odd_x_implied"),
    (r6(f"(under_odd * {P_UNDER})"), "under_odd_x_implied"),
    (r6("(over_odd - 1)"), "over_net_odd"),
    (r6("(under_odd - 1)"), "under_net_odd"),
])

_market_query("interactions", [
    (r6(f"(over_under_cap + 5.0E0 * ({P_OVER} - {P_UNDER}))"), "cap_plus_prob_gap"),
    (r6(div("over_under_cap", "over_odd")), "cap_per_over_odd"),
    (r6(div("over_under_cap", "under_odd")), "cap_per_under_odd"),
    (r6(f"(over_under_cap * {P_OVER_FAIR})"), "cap_x_fair_over"),
    (r6(f"(over_under_cap * {P_HOME_FAIR})"), "cap_x_fair_home"),
    (r6(f"({P_OVER} - (1.0E0 - {P_OVER_FAIR}))"), "over_edge"),
    (r6(f"(1.0E0 - {P_UNDER_FAIR})"), "expected_over_prob"),
    (r6(f"((1.0E0 - {P_UNDER_FAIR}) - {P_OVER_FAIR})"), "market_vs_expected"),
])
