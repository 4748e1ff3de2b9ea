"""Market (odds) features as pure column expressions over a match frame.

Input columns: over_odd, under_odd, over_under_cap, home_odd, draw_odd, away_odd,
home_cap, away_cap, home_handicap_odd, away_handicap_odd. Every function returns a
list of named columns; all of it stays inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from oddsframe.functions.helpers import c, div, flag, inv

# ---------------------------------------------------------------------------
# Fixed values (documented feature constants)
# ---------------------------------------------------------------------------
P_OVER_MISSING = 0.5          # guarded implied O/U probability when odd <= 0
P_1X2_MISSING = 0.33          # guarded implied 1X2 probability when odd <= 0
VIG_EPS = 1e-6                # denominator guard of the vig-free 1X2 variant
LOGIT_EPS = 1e-6              # logit guard
MARKET_EVEN_TOL = 0.05        # O/U odds this close are an even market
LOG_RATIO_EPS = 0.001         # ln(ratio + 0.001)
CAP_CENTRES = (3.0, 2.5)      # cap - 3.0, cap - 2.5
CAP_HALF_UNIT = 0.5           # (cap - 2.5) / 0.5
CAP_U21_SCALE = 1.5           # (cap - 2.5) / 1.5
CAP_ONE_HOT = (2.0, 2.25, 2.5, 2.75, 3.0, 3.25, 3.5)
CAP_ONE_HOT_TOL = 0.01
CAP_BIN = {2.0: 0, 2.25: 1, 2.5: 2, 2.75: 3, 3.0: 4}   # other caps -> 2
CAP_BIN_DEFAULT = 2
CAP_DIFF_WEIGHT = 5.0         # cap + 5 * (p_over - p_under)


def p_over() -> Column:
    return inv("over_odd")


def p_under() -> Column:
    return inv("under_odd")


def p_over_fair() -> Column:
    return div(p_over(), p_over() + p_under())


def p_under_fair() -> Column:
    return div(p_under(), p_over() + p_under())


def _x12_sum() -> Column:
    return inv("home_odd") + inv("draw_odd") + inv("away_odd")


def implied_probs() -> list[Column]:
    def guarded(col, missing):
        return F.when(c(col) > 0, inv(col)).otherwise(F.lit(missing))
    return [
        p_over().alias("p_over"), p_under().alias("p_under"),
        inv("home_odd").alias("p_home"), inv("draw_odd").alias("p_draw"), inv("away_odd").alias("p_away"),
        guarded("over_odd", P_OVER_MISSING).alias("p_over_guarded"),
        guarded("under_odd", P_OVER_MISSING).alias("p_under_guarded"),
        guarded("home_odd", P_1X2_MISSING).alias("p_home_guarded"),
        guarded("draw_odd", P_1X2_MISSING).alias("p_draw_guarded"),
        guarded("away_odd", P_1X2_MISSING).alias("p_away_guarded"),
    ]


def overround() -> list[Column]:
    ou = p_over() + p_under()
    x12 = _x12_sum()
    return [
        ou.alias("ou_overround"), (ou - 1).alias("ou_vig"),
        (c("over_odd") + c("under_odd") - 2).alias("ou_odds_sum_minus_2"),
        x12.alias("x12_overround"), (x12 - 1).alias("x12_vig"), (F.lit(1.0) - x12).alias("x12_margin_neg"),
    ]


def vig_free() -> list[Column]:
    x12 = _x12_sum()
    hp, ap = inv("home_handicap_odd"), inv("away_handicap_odd")
    return [
        p_over_fair().alias("p_over_fair"), p_under_fair().alias("p_under_fair"),
        div(inv("home_odd"), x12).alias("p_home_fair"),
        div(inv("draw_odd"), x12).alias("p_draw_fair"),
        div(inv("away_odd"), x12).alias("p_away_fair"),
        div(inv("home_odd"), x12 + VIG_EPS).alias("p_home_fair_eps"),
        F.coalesce(div(inv("home_odd"), x12), F.lit(0.5)).alias("p_home_fair_or_half"),
        div(hp, hp + ap).alias("p_home_hcp_fair"),
        div(ap, hp + ap).alias("p_away_hcp_fair"),
    ]


def odds_share() -> list[Column]:
    ou = c("over_odd") + c("under_odd")
    x12 = c("home_odd") + c("draw_odd") + c("away_odd")
    return [
        div("over_odd", ou).alias("over_share"), div("under_odd", ou).alias("under_share"),
        div("home_odd", x12).alias("home_share"), div("draw_odd", x12).alias("draw_share"),
        div("away_odd", x12).alias("away_share"),
    ]


def odds_ratios() -> list[Column]:
    return [div("over_odd", "under_odd").alias("ou_odds_ratio"),
            div("home_odd", "away_odd").alias("ha_odds_ratio")]


def odds_gaps() -> list[Column]:
    return [
        (c("over_odd") - c("under_odd")).alias("ou_odds_gap"),
        (c("under_odd") - c("over_odd")).alias("uo_odds_gap"),
        (c("home_odd") - c("away_odd")).alias("ha_odds_gap"),
        (c("away_odd") - c("home_odd")).alias("ah_odds_gap"),
        (p_over() - p_under()).alias("ou_prob_gap"),
        (inv("home_odd") - inv("away_odd")).alias("ha_prob_gap"),
    ]


def market_lean() -> list[Column]:
    lean = p_over_fair() - 0.5
    return [lean.alias("market_over_lean"), F.abs(lean).alias("market_abs_lean"),
            (lean * 2).alias("market_over_lean_x2")]


def cap_features() -> list[Column]:
    cap = c("over_under_cap")
    out = [
        (cap - CAP_CENTRES[0]).alias("cap_minus_3"),
        (cap - CAP_CENTRES[1]).alias("cap_minus_25"),
        ((cap - CAP_CENTRES[1]) / CAP_HALF_UNIT).alias("cap_half_units"),
        ((cap - CAP_CENTRES[1]) / CAP_U21_SCALE).alias("cap_norm_15"),
        F.abs(cap - CAP_CENTRES[1]).alias("cap_abs_dev"),
    ]
    for v in CAP_ONE_HOT:
        out.append(flag(F.abs(cap - v) < CAP_ONE_HOT_TOL).alias(f"cap_is_{int(round(v * 100))}"))
    return out


def cap_buckets() -> list[Column]:
    cap = c("over_under_cap")
    m = F.create_map(*[x for k, v in CAP_BIN.items() for x in (F.lit(k), F.lit(v))])
    return [
        flag(cap <= 2.5).alias("cap_low"),
        flag((cap > 2.5) & (cap <= 2.75)).alias("cap_25_275"),
        flag((cap > 2.75) & (cap <= 3.0)).alias("cap_275_30"),
        flag((cap > 3.0) & (cap <= 3.5)).alias("cap_30_35"),
        flag(cap > 3.5).alias("cap_high"),
        flag(cap > 2.5).alias("cap_above_25"),
        flag(cap > 2.75).alias("cap_above_275"),
        F.when(cap.isNull(), F.lit(None)).otherwise(
            F.coalesce(m[cap], F.lit(CAP_BIN_DEFAULT))).cast("int").alias("cap_bin"),
    ]


def favourite_flags() -> list[Column]:
    pf = p_over_fair()
    x12 = _x12_sum()
    return [
        flag(c("over_odd") < c("under_odd")).alias("over_favoured"),
        flag(c("home_odd") < c("away_odd")).alias("home_favoured"),
        flag(c("home_cap") < 0).alias("handicap_home_favoured"),
        flag(F.abs(c("over_odd") - c("under_odd")) < MARKET_EVEN_TOL).alias("market_even"),
        flag(p_over() > 0.5).alias("market_bias_over"),
        flag(inv("home_odd") > inv("away_odd")).alias("market_home_likelier"),
        F.greatest(pf, F.lit(1.0) - pf).alias("ou_favourite_strength"),
        F.greatest(div(inv("home_odd"), x12), div(inv("away_odd"), x12)).alias("x12_favourite_strength"),
    ]


def handicap_features() -> list[Column]:
    return [
        F.abs(c("home_cap")).alias("abs_home_cap"),
        (c("home_cap") - c("away_cap")).alias("cap_home_minus_away"),
        F.coalesce(c("home_cap"), F.lit(0.0)).alias("home_cap_filled"),
        (c("home_handicap_odd") * c("home_cap")).alias("handicap_odd_x_cap"),
    ]


def log_features() -> list[Column]:
    pf = p_over_fair()
    return [
        F.log(div("over_odd", "under_odd") + LOG_RATIO_EPS).alias("log_ou_ratio"),
        F.log(c("over_odd")).alias("log_over_odd"),
        F.log(c("under_odd")).alias("log_under_odd"),
        *[F.log(div(p + LOGIT_EPS, F.lit(1.0) - p + LOGIT_EPS)).alias(name)
          for name, p in (("logit_over_fair", pf), ("logit_over", p_over()), ("logit_home", inv("home_odd")))],
    ]


def juice() -> list[Column]:
    pf = p_over_fair()
    return [
        (c("over_odd") * pf).alias("over_juice"),
        (c("under_odd") * (F.lit(1.0) - pf)).alias("under_juice"),
        (c("over_odd") * p_over()).alias("over_odd_x_implied"),   # identically 1.0 by construction
        (c("under_odd") * p_under()).alias("under_odd_x_implied"),
        (c("over_odd") - 1).alias("over_net_odd"),
        (c("under_odd") - 1).alias("under_net_odd"),
    ]


def interactions() -> list[Column]:
    cap = c("over_under_cap")
    pf = p_over_fair()
    x12 = _x12_sum()
    return [
        (cap + CAP_DIFF_WEIGHT * (p_over() - p_under())).alias("cap_plus_prob_gap"),
        div(cap, "over_odd").alias("cap_per_over_odd"),
        div(cap, "under_odd").alias("cap_per_under_odd"),
        (cap * pf).alias("cap_x_fair_over"),
        (cap * div(inv("home_odd"), x12)).alias("cap_x_fair_home"),
        (p_over() - (F.lit(1.0) - pf)).alias("over_edge"),
        (F.lit(1.0) - p_under_fair()).alias("expected_over_prob"),
        ((F.lit(1.0) - p_under_fair()) - pf).alias("market_vs_expected"),
    ]


GROUPS = {
    "implied_probs": implied_probs,
    "overround": overround,
    "vig_free": vig_free,
    "odds_share": odds_share,
    "odds_ratios": odds_ratios,
    "odds_gaps": odds_gaps,
    "market_lean": market_lean,
    "cap_features": cap_features,
    "cap_buckets": cap_buckets,
    "favourite_flags": favourite_flags,
    "handicap_features": handicap_features,
    "log_features": log_features,
    "juice": juice,
    "interactions": interactions,
}
