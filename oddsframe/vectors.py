"""Ordered feature vectors of the documented predictors.

Each line is ``feature = expression`` in the order in which the predictor's scaler and model take them. An
expression is Spark SQL over columns of the match frame, market features (``functions.market``) and history columns
``<home|away>_<table>_<statistic>`` (``operators.features.TABLES``); ``$name`` is an earlier or later feature of the same vector. A
line without an expression is the column of that name.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# Fixed values (documented features, their order, and the values that stand for a missing history)
# ---------------------------------------------------------------------------
GERMANY = """
over_odd
under_odd
over_under_cap
home_odd
draw_odd
away_odd
home_handicap_odd = coalesce(home_handicap_odd, 2.0)
away_handicap_odd = coalesce(away_handicap_odd, 2.0)
home_avg_goals_for = coalesce(home_all_scored, 1.5)
home_avg_goals_against = coalesce(home_all_conceded, 1.5)
away_avg_goals_for = coalesce(away_all_scored, 1.5)
away_avg_goals_against = coalesce(away_all_conceded, 1.5)
home_recent_win_rate = coalesce(home_last10_win_rate, 0.45)
away_recent_win_rate = coalesce(away_last10_win_rate, 0.45)
combined_avg_goals = $home_avg_goals_for + $away_avg_goals_for
combined_avg_defense = $home_avg_goals_against + $away_avg_goals_against
goal_diff_avg = $home_team_gd - $away_team_gd
form_diff = $home_recent_win_rate - $away_recent_win_rate
implied_prob_over = p_over
implied_prob_under = p_under
juice = ou_odds_sum_minus_2
cap_normalized = cap_minus_3
home_team_ou_rate = coalesce(home_all_over_rate, 0.5)
away_team_ou_rate = coalesce(away_all_over_rate, 0.5)
home_team_gd = coalesce(home_all_goal_diff, 0.0)
away_team_gd = coalesce(away_all_goal_diff, 0.0)
combined_ou_rate = ($home_team_ou_rate + $away_team_ou_rate) / 2
vig_free_over = p_over_fair
vig_free_under = p_under_fair
cap_deviation = cap_minus_3
odds_ratio = ou_odds_ratio
"""

AUSTRIA = """
away_cap
away_handicap_odd
away_odd
cap_2_0 = cap_is_200
cap_2_25 = cap_is_225
cap_2_5 = cap_is_250
cap_2_75 = cap_is_275
cap_3_0 = cap_is_300
cap_3_25 = cap_is_325
cap_centered = cap_minus_25
draw_odd
handicap_spread = cap_home_minus_away
hist_expected_diff = $hist_expected_total - over_under_cap
hist_expected_total = (coalesce(home_all_scored, 1.5) + coalesce(away_all_scored, 1.5) + coalesce(home_all_conceded, 1.5) + coalesce(away_all_conceded, 1.5)) / 2
home_cap
home_handicap_odd
home_odd
implied_away_prob_norm = p_away_fair
implied_home_prob_norm = p_home_fair
implied_over_prob = p_over
implied_over_prob_norm = p_over_fair
implied_under_prob = p_under
implied_under_prob_norm = p_under_fair
market_3way_vig = x12_vig
market_ou_vig = ou_vig
market_over_lean
n_hist_away = coalesce(away_all_n, 0)
n_hist_home = coalesce(home_all_n, 0)
odds_ratio = ou_odds_ratio
over_odd
over_under_cap
over_under_diff = uo_odds_gap
under_odd
"""

ENGLAND = """
implied_prob_over = p_over
implied_prob_under = p_under
over_under_ratio = ou_odds_ratio
over_under_diff = ou_prob_gap
over_juice = over_odd_x_implied
under_juice = under_odd_x_implied
norm_home_win = p_home_fair
norm_draw = p_draw_fair
norm_away_win = p_away_fair
home_away_prob_diff = p_home_fair - p_away_fair
home_cap
home_cap_abs = abs_home_cap
handicap_favoured_home = handicap_home_favoured
over_under_cap
cap_2.25 = cap_is_225
cap_2.5 = cap_is_250
cap_2.75 = cap_is_275
cap_3.0 = cap_is_300
cap_3.25 = cap_is_325
cap_3.5 = cap_is_350
prob_over_minus_50 = p_over - 0.5
cap_adjusted = cap_plus_prob_gap
home_avg_scored = coalesce(home_all_scored, 1.5)
home_avg_conceded = coalesce(home_all_conceded, 1.5)
away_avg_scored = coalesce(away_all_scored, 1.5)
away_avg_conceded = coalesce(away_all_conceded, 1.5)
"""

FA_CUP = """
over_odd
under_odd
over_under_cap
win_home = home_odd
win_draw = draw_odd
win_away = away_odd
over_prob_norm = p_over_fair
under_prob_norm = 1 - p_over_fair
over_prob_raw = p_over_guarded
under_prob_raw = p_under_guarded
over_juice = over_net_odd
under_juice = under_net_odd
home_prob = p_home_guarded / (p_home_guarded + p_draw_guarded + p_away_guarded + 1e-6)
away_prob = p_away_guarded / (p_home_guarded + p_draw_guarded + p_away_guarded + 1e-6)
cap_200 = cap_is_200
cap_225 = cap_is_225
cap_250 = cap_is_250
cap_275 = cap_is_275
cap_300 = cap_is_300
cap_325 = cap_is_325
cap_350 = cap_is_350
cap_dev = cap_minus_25
home_avg_scored = coalesce(home_all_scored, 2.0)
home_avg_conceded = coalesce(home_all_conceded, 2.0)
away_avg_scored = coalesce(away_all_scored, 2.0)
away_avg_conceded = coalesce(away_all_conceded, 2.0)
expected_total = $home_avg_scored + $away_avg_scored
market_vs_expectation = p_over_fair - 0.5
cap_vs_exp = over_under_cap - $expected_total
home_attack_rel = $home_avg_scored / 2.5
away_attack_rel = $away_avg_scored / 2.5
hcap = home_cap_filled
hcap_home_odd = coalesce(home_handicap_odd, 1.95)
hcap_away_odd = coalesce(away_handicap_odd, 1.95)
"""

JAPAN = """
over_under_cap
over_odd
under_odd
market_over_prob = p_over_fair
implied_prob_home = p_home
home_cap = home_cap_filled
odds_imbalance = ou_odds_gap
odds_ratio = ou_odds_ratio
prob_deviation = market_abs_lean
home_strength = $home_avg_scored - $home_avg_conceded
away_strength = $away_avg_scored - $away_avg_conceded
strength_diff = $home_strength - $away_strength
expected_total = ($home_avg_scored + $away_avg_scored + $home_avg_conceded + $away_avg_conceded) / 2
cap_vs_expected = over_under_cap - $expected_total
home_id_enc = home_team_code
away_id_enc = away_team_code
home_avg_scored = coalesce(home_joint_scored, 2.3)
home_avg_conceded = coalesce(home_joint_conceded, 2.3)
away_avg_scored = coalesce(away_joint_scored, 2.3)
away_avg_conceded = coalesce(away_joint_conceded, 2.3)
"""

MEXICO = """
fair_over_prob = p_over_fair
fair_home_prob = p_home_fair
fair_away_prob = p_away_fair
fair_draw_prob = p_draw_fair
odds_ratio = ou_odds_ratio
log_odds_ratio = log_ou_ratio
home_away_ratio = ha_odds_ratio
over_under_cap
cap_2.0 = cap_is_200
cap_2.5 = cap_is_250
cap_2.75 = cap_is_275
cap_3.0 = cap_is_300
cap_3.5 = cap_is_350
cap_distance = cap_abs_dev
cap_above_2_5 = cap_above_25
home_handicap_odd
away_handicap_odd
handicap_cap = home_cap
home_handicap_odd_adj = handicap_odd_x_cap
handicap_home_fav = handicap_home_favoured
home_avg_goals = coalesce(home_all_scored, 1.8)
away_avg_goals = coalesce(away_all_scored, 1.3)
home_avg_conceded = coalesce(home_all_conceded, 1.3)
away_avg_conceded = coalesce(away_all_conceded, 1.8)
home_over_rate = coalesce(home_all_over_rate, 0.5)
away_over_rate = coalesce(away_all_over_rate, 0.5)
avg_over_rate = ($home_over_rate + $away_over_rate) / 2
over_rate_diff = $home_over_rate - $away_over_rate
expected_total = $home_avg_goals + $away_avg_goals
expected_diff = $home_avg_goals - $away_avg_goals
over_expectation = $expected_total - over_under_cap
goals_sum_avg = $home_avg_goals + $away_avg_goals
goals_diff_avg = $home_avg_goals - $away_avg_goals
total_defense_avg = $home_avg_conceded + $away_avg_conceded
cap_x_fair_over
cap_x_home = cap_x_fair_home
over_juice
under_juice
"""

QATAR = """
over_odd
under_odd
over_under_cap
win_home_odd = home_odd
win_draw_odd = draw_odd
win_away_odd = away_odd
handicap_cap = home_cap
handicap_home_odd = home_handicap_odd
handicap_away_odd = away_handicap_odd
implied_over_prob = p_over_guarded
implied_under_prob = p_under_guarded
over_juice = p_over_guarded + p_under_guarded - 1
is_home_favorite = home_favoured
handicap_home_favorite = CAST(home_handicap_odd < away_handicap_odd AS INT)
home_avg_goals = coalesce(home_all_scored, 2.0)
away_avg_goals = coalesce(away_all_scored, 2.0)
home_avg_concede = coalesce(home_all_conceded, 2.0)
away_avg_concede = coalesce(away_all_conceded, 2.0)
home_over_rate = coalesce(home_all_over_rate, 0.5)
away_over_rate = coalesce(away_all_over_rate, 0.5)
expected_total_goals = ($home_avg_goals + $away_avg_goals + $home_avg_concede + $away_avg_concede) / 2
goals_diff_from_cap = $expected_total_goals - over_under_cap
"""

SERBIA = """
over_odd
under_odd
over_under_cap
home_odd
draw_odd
away_odd
implied_over_prob = p_over
implied_under_prob = p_under
implied_home_prob = p_home
implied_draw_prob = p_draw
implied_away_prob = p_away
over_under_ratio = ou_odds_ratio
home_away_ratio = ha_odds_ratio
ou_odds_gap
ha_odds_gap
cap_level = cap_minus_25
cap_floor = cap_low
home_cap
home_handicap_odd
away_handicap_odd
market_bias_over
market_favorite_home = market_home_likelier
overround_ou = ou_overround
overround_ha = x12_overround
logit_over
logit_home
home_avg_scored = CASE WHEN home_both10_n >= 3 THEN home_both10_scored ELSE 1.5 END
home_avg_conceded = CASE WHEN home_both10_n >= 3 THEN home_both10_conceded ELSE 1.3 END
away_avg_scored = CASE WHEN away_both10_n >= 3 THEN away_both10_scored ELSE 1.2 END
away_avg_conceded = CASE WHEN away_both10_n >= 3 THEN away_both10_conceded ELSE 1.4 END
home_over_rate = CASE WHEN home_both10_n >= 3 THEN coalesce(home_both10_over_rate, 0.0) ELSE 0.45 END
away_over_rate = CASE WHEN away_both10_n >= 3 THEN coalesce(away_both10_over_rate, 0.0) ELSE 0.40 END
combined_avg_total = ($home_avg_scored + $away_avg_conceded + $away_avg_scored + $home_avg_conceded) / 4
avg_over_rate = ($home_over_rate + $away_over_rate) / 2
"""

SOUTH_KOREA = """
f_cap = over_under_cap
f_over_odd = over_odd
f_under_odd = under_odd
f_home_odd = home_odd
f_draw_odd = draw_odd
f_away_odd = away_odd
f_ou_ratio = ou_odds_ratio
f_ha_ratio = ha_odds_ratio
f_imp_over = p_over
f_imp_home = p_home
f_ht_h_sc = coalesce(home_athome_scored, 1.8)
f_ht_a_sc = coalesce(home_ataway_scored, 1.8)
f_at_h_sc = coalesce(away_athome_scored, 1.8)
f_at_a_sc = coalesce(away_ataway_scored, 1.8)
f_ht_h_co = coalesce(home_athome_conceded, 1.8)
f_at_a_co = coalesce(away_ataway_conceded, 1.8)
f_ht_ovr = coalesce(home_last5_over_rate, 0.5)
f_at_ovr = coalesce(away_last5_over_rate, 0.5)
f_cap_rel = over_under_cap - ($f_ht_h_sc + $f_at_a_sc)
f_ht_total = $f_ht_h_sc + $f_ht_h_co
f_at_total = $f_at_a_sc + $f_at_a_co
"""

TURKEY = """
over_odd
over_under_cap
under_odd
implied_over_prob_norm = p_over_fair
over_odd_under_odd_ratio = ou_odds_ratio
implied_home_prob_norm = coalesce(p_home_fair, 0.5)
implied_draw_prob_norm = coalesce(p_draw_fair, 0.5)
implied_away_prob_norm = coalesce(p_away_fair, 0.5)
handicap_spread = home_cap_filled
home_avg_goals = coalesce(home_athome10_scored, 2.0)
home_avg_conceded = coalesce(home_athome10_conceded, 2.0)
away_avg_goals = coalesce(away_ataway10_scored, 2.0)
away_avg_conceded = coalesce(away_ataway10_conceded, 2.0)
home_avg_total = $home_avg_goals + $away_avg_conceded
away_avg_total = $away_avg_goals + $home_avg_conceded
expected_total_vs_cap = ($home_avg_total + $away_avg_total) / 2
expected_vs_cap_diff = $expected_total_vs_cap - over_under_cap
cap_normalized = cap_half_units
home_form = coalesce(home_athome5_total, 2.5)
away_form = coalesce(away_ataway5_total, 2.5)
combined_form = $home_form + $away_form
cap_is_2.5 = cap_is_250
cap_is_2.75 = cap_is_275
cap_is_3.0 = cap_is_300
cap_above_2.75 = cap_above_275
over_odds_vig = over_odd_x_implied
under_odds_vig = under_odd_x_implied
total_implied = ou_overround
over_edge
fav_home = coalesce(home_favoured, 0)
odds_spread = coalesce(ah_odds_gap, 0.0)
home_advantage = $implied_home_prob_norm - $implied_away_prob_norm
expected_over_prob
market_vs_expected
"""

U21 = """
over_odd = coalesce(over_odd, 1.8)
under_odd = coalesce(under_odd, 1.8)
over_under_cap = $cap
implied_over = 1 / $over_odd
implied_under = 1 / $under_odd
odds_ratio = $over_odd / $under_odd
cap_2_5_2_75 = CAST($cap > 2.5 AND $cap <= 2.75 AS INT)
cap_2_75_3_0 = CAST($cap > 2.75 AND $cap <= 3.0 AS INT)
cap_3_0_3_5 = CAST($cap > 3.0 AND $cap <= 3.5 AS INT)
cap_high = CAST($cap > 3.5 AS INT)
cap_low = CAST($cap <= 2.5 AS INT)
cap_norm = ($cap - 2.5) / 1.5
home_odd = coalesce(home_odd, 1.8)
away_odd = coalesce(away_odd, 3.5)
draw_odd = coalesce(draw_odd, 3.5)
home_prob = $home_odd / ($home_odd + $draw_odd + $away_odd)
away_prob = $away_odd / ($home_odd + $draw_odd + $away_odd)
favor_over = CAST($over_odd < $under_odd AS INT)
market_even = CAST(abs($over_odd - $under_odd) < 0.05 AS INT)
home_cap = home_cap_filled
home_cap_abs = abs(home_cap_filled)
: cap = coalesce(over_under_cap, 2.75)
"""

NWSL = """
norm_over_prob = p_over_fair
norm_under_prob = p_under_fair
over_under_cap
odds_ratio = ou_odds_ratio
over_odd_log = log_over_odd
under_odd_log = log_under_odd
home_favorite = home_favoured
favorite_prob = x12_favourite_strength
norm_home_prob = p_home_fair
norm_handicap_home_prob = p_home_hcp_fair
market_over_lean = market_over_lean_x2
cap_bin
cap_per_over_odd
cap_per_under_odd
h_avg_scored = CASE WHEN home_last5_n >= 2 THEN home_last5_scored ELSE 2.5 END
h_avg_conceded = CASE WHEN home_last5_n >= 2 THEN home_last5_conceded ELSE 2.5 END
a_avg_scored = CASE WHEN away_last5_n >= 2 THEN away_last5_scored ELSE 2.5 END
a_avg_conceded = CASE WHEN away_last5_n >= 2 THEN away_last5_conceded ELSE 2.5 END
h_over_rate = CASE WHEN home_last5_n >= 2 THEN coalesce(home_last5_over_rate, 0.5) ELSE 0.5 END
a_over_rate = CASE WHEN away_last5_n >= 2 THEN coalesce(away_last5_over_rate, 0.5) ELSE 0.5 END
expected_total = ($h_avg_scored + $a_avg_conceded + $a_avg_scored + $h_avg_conceded) / 2
expected_vs_cap = $expected_total - over_under_cap
h_games = coalesce(home_all_n, 0)
a_games = coalesce(away_all_n, 0)
"""

VIETNAM = """
implied_prob_over = p_over
norm_prob_over = p_over_fair
market_bias = ou_prob_gap
over_under_cap
handicap_spread = coalesce(abs_home_cap, 0.0)
implied_prob_home = p_home
implied_prob_draw = p_draw
implied_prob_away = p_away
home_avg_scored = coalesce(home_all_scored, 1.25)
home_avg_conceded = coalesce(home_all_conceded, 1.25)
away_avg_scored = coalesce(away_all_scored, 1.25)
away_avg_conceded = coalesce(away_all_conceded, 1.25)
expected_goals = ($home_avg_scored + $away_avg_conceded + $away_avg_scored + $home_avg_conceded) / 2
attack_vs_defense = ($home_avg_scored - $away_avg_conceded) - ($away_avg_scored - $home_avg_conceded)
book_margin = x12_margin_neg
cap_minus_expected = over_under_cap - $expected_goals
"""

AFRICA = """
over_odd
under_odd
over_under_cap
cap_centered = cap_minus_25
implied_over_prob = p_over
implied_under_prob = p_under
odds_spread = ou_odds_gap
over_under_ratio = ou_odds_ratio
home_odd
draw_odd
away_odd
home_win_prob = p_home
draw_prob = p_draw
away_win_prob = p_away
home_away_diff = ha_prob_gap
home_cap
home_cap_abs = abs_home_cap
home_handicap_odd
away_handicap_odd
"""

VECTORS: dict[str, str] = {
    "germany": GERMANY, "austria": AUSTRIA, "england": ENGLAND, "fa_cup": FA_CUP, "japan": JAPAN, "mexico": MEXICO, "qatar": QATAR,
    "serbia": SERBIA, "south_korea": SOUTH_KOREA, "turkey": TURKEY, "u21": U21, "nwsl": NWSL, "vietnam": VIETNAM, "africa": AFRICA,
}

# What stands for a feature that is still missing (others stay null)
FILL: dict[str, float] = {"england": 1.5, "mexico": 0.0, "u21": 0.0, "nwsl": 0.5}

# ---------------------------------------------------------------------------
# Fixture league mapping (repository choice): the vectors are dealt to the five test leagues in order
# ---------------------------------------------------------------------------
LEAGUE_VECTORS: dict[int, tuple[str, ...]] = {
    league: tuple(v for i, v in enumerate(VECTORS) if i % 5 == league - 1) for league in range(1, 6)}
