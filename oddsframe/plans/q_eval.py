"""Queries: scoring, decisions, predictions, evaluation, routing fallback, encodings,
and the model fits (rows-only: no SQL form)."""

from __future__ import annotations

from pyspark.sql import functions as F

from oddsframe import config
from oddsframe.functions.calendar import with_season_window
from oddsframe.functions.helpers import div, finite_or
from oddsframe.operators import evaluate as EV
from oddsframe.operators import learn as L
from oddsframe.operators import matches as M
from oddsframe.operators import score as S
from oddsframe.plans.oracle_base import PLAYED
from oddsframe.plans.q_learn import GATE, LEARN_CTES, WK, _pooled, _test_predictions, _window_scores
from oddsframe.plans.registry import register
from oddsframe.plans.sqlx import P_OVER_FAIR, rr6
from oddsframe.sources.tables import fixture_tables

# ---------------------------------------------------------------------------
# evaluation of the leak-free market pipeline (threshold searched on train only)
# ---------------------------------------------------------------------------


@register("window_score", f"SELECT * FROM ws", LEARN_CTES)
def window_score(spark, d):
    """Test accuracy and flat-stake ROI per gated (league, season, window)."""
    return _window_scores(spark, d)


@register("betting_roi", """SELECT event_type_id, count(*) AS n_bets, CAST(sum(correct) AS BIGINT) AS n_won,
  CAST(sum(pnl) AS BIGINT) AS pnl, CAST(sum(correct) AS DOUBLE) / count(*) AS accuracy,
  CAST(sum(pnl) AS DOUBLE) / count(*) AS roi_pct FROM st GROUP BY event_type_id""", LEARN_CTES)
def betting_roi(spark, d):
    """Flat stake 100 on every test-row decision: P&L in stake cents and ROI % per league."""
    return EV.betting_roi(_test_predictions(spark, d), ["event_type_id"])


@register("confusion_matrix", """SELECT event_type_id,
  CAST(sum(CASE WHEN pred_over = 0 AND label_over = 0 THEN 1 ELSE 0 END) AS BIGINT) AS tn,
  CAST(sum(CASE WHEN pred_over = 1 AND label_over = 0 THEN 1 ELSE 0 END) AS BIGINT) AS fp,
  CAST(sum(CASE WHEN pred_over = 0 AND label_over = 1 THEN 1 ELSE 0 END) AS BIGINT) AS fn,
  CAST(sum(CASE WHEN pred_over = 1 AND label_over = 1 THEN 1 ELSE 0 END) AS BIGINT) AS tp
FROM st GROUP BY event_type_id""", LEARN_CTES)
def confusion_matrix(spark, d):
    """TN / FP / FN / TP of the test decisions per league."""
    return EV.confusion(_test_predictions(spark, d), ["event_type_id"])


@register("league_score_macro", f"""SELECT event_type_id, count(*) AS n_windows,
  {rr6('avg(accuracy)')} AS macro_accuracy, {rr6('avg(roi_pct)')} AS macro_roi_pct,
  CAST(sum(CASE WHEN accuracy >= {config.WINDOW_TARGET_ACCURACY}E0 THEN 1 ELSE 0 END) AS BIGINT) AS windows_meeting_target,
  {rr6(f"CAST(sum(CASE WHEN accuracy >= {config.WINDOW_TARGET_ACCURACY}E0 THEN 1 ELSE 0 END) AS DOUBLE) / count(*)")}
    AS share_meeting_target
FROM ws GROUP BY event_type_id""", LEARN_CTES, rounded=True)
def league_score_macro(spark, d):
    """Mean over windows of accuracy and ROI, and windows meeting the 70 % target."""
    return EV.league_macro(_window_scores(spark, d))


@register("league_score_pooled", "SELECT * FROM pooled", LEARN_CTES)
def league_score_pooled(spark, d):
    """Sum(correct) / sum(n) and test-size-weighted ROI per league."""
    return _pooled(spark, d)


@register("acceptance_gate", f"""SELECT p.event_type_id, p.n_test, CAST(coalesce(c.n_completed, 0) AS BIGINT) AS n_completed,
  p.pooled_accuracy, p.pooled_roi_pct,
  CASE WHEN p.pooled_accuracy >= {config.ACCEPT_MIN_ACCURACY}E0 AND p.pooled_roi_pct >= {config.ACCEPT_MIN_ROI}E0
        AND coalesce(c.n_completed, 0) >= {config.ACCEPT_MIN_MATCHES} THEN 'accepted' ELSE 'rejected' END AS status,
  CASE WHEN coalesce(c.n_completed, 0) < {config.ACCEPT_MIN_MATCHES} THEN 'too few matches'
       WHEN p.pooled_accuracy < {config.ACCEPT_MIN_ACCURACY}E0 THEN 'accuracy below target'
       WHEN p.pooled_roi_pct < {config.ACCEPT_MIN_ROI}E0 THEN 'negative roi' END AS reason
FROM pooled p LEFT JOIN completed c ON c.event_type_id = p.event_type_id""", LEARN_CTES)
def acceptance_gate(spark, d):
    """accepted iff pooled accuracy >= 70 %, ROI >= 0 and >= 100 completed matches."""
    t = fixture_tables(spark, d)
    mf = M.match_asof(t)
    completed = (mf.filter(M.is_played() & F.col("over_odd").isNotNull())
                   .groupBy("event_type_id").agg(F.count(F.lit(1)).alias("n_completed")))
    return EV.acceptance(_pooled(spark, d), completed)


@register("league_ranking", """SELECT p.event_type_id, et.name AS league_name, p.pooled_accuracy, p.pooled_roi_pct,
  CAST(rank() OVER (ORDER BY p.pooled_accuracy DESC) AS INT) AS rank
FROM pooled p LEFT JOIN fx_event_type et ON et.event_type_id = p.event_type_id""", LEARN_CTES)
def league_ranking(spark, d):
    """Leagues ranked by pooled test accuracy."""
    t = fixture_tables(spark, d)
    names = t.event_type.select("event_type_id", F.col("name").alias("league_name"))
    return EV.ranking(_pooled(spark, d), names)


# ---------------------------------------------------------------------------
# scoring with the fixture registry
# ---------------------------------------------------------------------------

def _registry_sql():
    rows = []
    for lg, name, b, thr, means, stds, coefs in S.LITERAL_REGISTRY:
        strict = "true" if config.LEAGUES[lg][3] else "false"
        vals = [str(lg), f"'{name}'", f"{b}E0", f"{thr}E0", strict]
        for m, s, w in zip(means, stds, coefs):
            vals += [f"{m}E0", f"{s}E0", f"{w}E0"]
        rows.append("(" + ", ".join(vals) + ")")
    cols = ["event_type_id", "model_name", "intercept", "threshold", "strict"]
    for f in S.LITERAL_FEATURES:
        cols += [f"{f}__mean", f"{f}__std", f"{f}__coef"]
    return f"SELECT * FROM (VALUES {', '.join(rows)}) AS t({', '.join(cols)})"


def _eta_sql():
    e = "r.intercept"
    for f in S.LITERAL_FEATURES:
        e = f"({e} + r.{f}__coef * ((q.{f} - r.{f}__mean) / r.{f}__std))"
    return e


SCORE_CTES = (  # a prediction takes the latest quote
    ("reg", _registry_sql()),
    ("qm", f"""SELECT m.*, {P_OVER_FAIR} AS p_over_fair,
       ((1.0E0 / NULLIF(over_odd, 0)) + (1.0E0 / NULLIF(under_odd, 0))) AS ou_overround,
       (over_under_cap - 2.5E0) AS cap_minus_25, (over_odd / NULLIF(under_odd, 0)) AS ou_odds_ratio
FROM mf m WHERE over_odd IS NOT NULL"""),
    ("sc", f"""SELECT q.event_id, q.event_type_id, r.model_name, r.threshold, r.strict,
       1.0E0 / (1.0E0 + exp(-{_eta_sql()})) AS probability
FROM qm q JOIN reg r ON r.event_type_id = q.event_type_id"""),
    ("dc", """SELECT *, CASE WHEN probability IS NULL THEN NULL
       WHEN (CASE WHEN strict THEN probability > threshold ELSE probability >= threshold END) THEN 'OVER'
       ELSE 'UNDER' END AS prediction FROM sc"""),
)


def _scored(spark, d):
    t = fixture_tables(spark, d)
    mf = M.match_frame(t).filter(F.col("over_odd").isNotNull())
    q = mf.select("event_id", "event_type_id", *L.market_columns())
    return S.score_logistic(q, S.literal_registry(spark), S.LITERAL_FEATURES)


@register("score_logistic", f"SELECT event_id, event_type_id, model_name, {rr6('probability')} AS probability FROM sc",
          SCORE_CTES, rounded=True)
def score_logistic(spark, d):
    """Logistic probability of OVER for every quoted match from the league's registry row."""
    return _scored(spark, d).select("event_id", "event_type_id", "model_name", "probability")


@register("decide", f"SELECT event_id, {rr6('probability')} AS probability, threshold, prediction FROM dc",
          SCORE_CTES, rounded=True)
def decide(spark, d):
    """OVER / UNDER against the registry threshold ('>' for strict predictors, '>=' otherwise)."""
    sc = _scored(spark, d)
    return sc.select("event_id", "probability", "threshold",
                     S.decide(F.col("probability"), F.col("threshold"), F.col("strict")).alias("prediction"))


@register("recommended_bet", f"""SELECT event_id, {rr6('probability')} AS probability,
  {rr6('abs(probability - 0.5E0) * 2')} AS confidence,
  CASE WHEN probability IS NULL THEN NULL WHEN abs(probability - 0.5E0) * 2 > {config.BET_MIN_CONFIDENCE}E0
       THEN prediction ELSE 'SKIP' END AS bet FROM dc""", SCORE_CTES, rounded=True)
def recommended_bet(spark, d):
    """Bet the predicted side only when confidence abs(p - 0.5) * 2 exceeds 0.3, else SKIP."""
    sc = _scored(spark, d)
    pred = S.decide(F.col("probability"), F.col("threshold"), F.col("strict"))
    conf, bet = S.recommended_bet(F.col("probability"), pred)
    return sc.select("event_id", "probability", conf.alias("confidence"), bet.alias("bet"))


_PRED_SQL = f"""SELECT m.event_id, m.home_team, m.away_team, m.start_time, d.prediction,
  floor(d.probability * 10000.0E0 + 0.5E0) / 10000.0E0 AS probability, d.threshold,
  m.over_odd, m.under_odd, m.over_under_cap, d.model_name,
  CASE WHEN c.window_no IS NOT NULL THEN concat(CAST(year(m.start_time) - c.season_offset AS VARCHAR), '-',
       CAST(year(m.start_time) - c.season_offset + 1 AS VARCHAR), '-W', CAST(c.window_no AS VARCHAR)) END AS window_label
FROM mf m JOIN dc d ON d.event_id = m.event_id
LEFT JOIN calendar c ON c.event_type_id = m.event_type_id AND c.cal_month = month(m.start_time)
WHERE NOT {PLAYED.replace('start_time', 'm.start_time').replace('home_ft_score', 'm.home_ft_score').replace('away_ft_score', 'm.away_ft_score')}"""


def _predictions(spark, d):
    t = fixture_tables(spark, d)
    mf = M.match_frame(t).filter(F.col("over_odd").isNotNull() & ~M.is_played())
    q = mf.select("event_id", "event_type_id", "start_time", "home_team", "away_team", "over_odd", "under_odd",
                  "over_under_cap", *L.market_columns())
    sc = S.score_logistic(q, S.literal_registry(spark), S.LITERAL_FEATURES)
    sc = with_season_window(sc, spark)
    return sc.select("event_id", "home_team", "away_team", "start_time",
                     S.decide(F.col("probability"), F.col("threshold"), F.col("strict")).alias("prediction"),
                     S.round_to(F.col("probability"), config.ROUND_OUTPUT).alias("probability"), "threshold",
                     "over_odd", "under_odd", "over_under_cap", "model_name", "window_label")


@register("prediction_output", _PRED_SQL, SCORE_CTES)
def prediction_output(spark, d):
    """The prediction record for every request (unplayed match with O/U odds)."""
    return _predictions(spark, d)


@register("prediction_json", """SELECT event_id, to_json(struct_pack(event_id := event_id, home_team := home_team,
  away_team := away_team, prediction := prediction, probability := probability, threshold := threshold,
  over_odd := over_odd, under_odd := under_odd, over_under_cap := over_under_cap)) AS json
FROM (""" + _PRED_SQL + ")", SCORE_CTES)
def prediction_json(spark, d):
    """Prediction records as JSON text (one document per request)."""
    p = _predictions(spark, d)
    keys = ["event_id", "home_team", "away_team", "prediction", "probability", "threshold",
            "over_odd", "under_odd", "over_under_cap"]
    return p.select("event_id", F.to_json(F.struct(*keys)).alias("json"))


@register("feature_long", """SELECT event_id, feature, value FROM (
  SELECT event_id, 'p_over_fair' AS feature, p_over_fair AS value FROM qm
  UNION ALL SELECT event_id, 'ou_overround', ou_overround FROM qm
  UNION ALL SELECT event_id, 'cap_minus_25', cap_minus_25 FROM qm
  UNION ALL SELECT event_id, 'ou_odds_ratio', ou_odds_ratio FROM qm)""", SCORE_CTES)
def feature_long(spark, d):
    """Feature vectors in long form (event_id, feature, value), in registry feature order."""
    t = fixture_tables(spark, d)
    mf = M.match_frame(t).filter(F.col("over_odd").isNotNull())
    q = mf.select("event_id", *L.market_columns())
    return S.feature_long(q, ["event_id"], S.LITERAL_FEATURES)


# ---------------------------------------------------------------------------
# registry fallback, encodings, null policy
# ---------------------------------------------------------------------------

_PLAYED_M = PLAYED.replace('start_time', 'm.start_time').replace('home_ft_score', 'm.home_ft_score').replace(
    'away_ft_score', 'm.away_ft_score')
_POLICY_VALUES = "SELECT * FROM (VALUES " + ", ".join(
    f"({lg}, '{pol}')" for lg, pol in sorted(config.LEAGUE_FALLBACK.items())) + ") AS t(event_type_id, policy)"
_FALLBACK_CTES = LEARN_CTES + (
    ("reg_w", f"""SELECT {WK}, season_start * 10 + window_no AS o FROM sp2
    GROUP BY {WK} HAVING count(*) >= {GATE}"""),
    ("rq", f"""SELECT m.event_id, m.event_type_id, CAST(year(m.start_time) - c.season_offset AS INT) AS season_start,
       c.window_no FROM mf m JOIN calendar c ON c.event_type_id = m.event_type_id AND c.cal_month = month(m.start_time)
       WHERE NOT ({_PLAYED_M}) AND m.over_odd IS NOT NULL"""),
    ("pol", _POLICY_VALUES),
    ("rr", """SELECT rq.*, ex.o AS exact_o, pv.o AS prev_o, ls.last_o, ls.first_o, pol.policy
FROM rq
LEFT JOIN reg_w ex ON ex.event_type_id = rq.event_type_id AND ex.o = rq.season_start * 10 + rq.window_no
LEFT JOIN (SELECT rq2.event_id, max(r.o) AS o FROM rq rq2 JOIN reg_w r ON r.event_type_id = rq2.event_type_id
           AND r.o < rq2.season_start * 10 + rq2.window_no GROUP BY rq2.event_id) pv ON pv.event_id = rq.event_id
LEFT JOIN (SELECT event_type_id, max(o) AS last_o, min(o) AS first_o FROM reg_w GROUP BY event_type_id) ls
  ON ls.event_type_id = rq.event_type_id
LEFT JOIN pol ON pol.event_type_id = rq.event_type_id"""),
)


@register("registry_fallback", """SELECT event_id, event_type_id, season_start, window_no,
  CAST(CASE WHEN exact_o IS NOT NULL THEN exact_o
            WHEN policy = 'previous_then_last' THEN coalesce(prev_o, last_o)
            WHEN policy = 'last' THEN last_o WHEN policy = 'first' THEN first_o END AS INT) AS model_key,
  CASE WHEN exact_o IS NOT NULL THEN 'exact'
       WHEN policy = 'previous_then_last' AND prev_o IS NOT NULL THEN 'previous'
       WHEN policy IN ('previous_then_last', 'last') AND last_o IS NOT NULL THEN 'last'
       WHEN policy = 'first' AND first_o IS NOT NULL THEN 'first'
       ELSE 'error: no model' END AS fallback
FROM rr""", _FALLBACK_CTES)
def registry_fallback(spark, d):
    """Model window for every request under its league's fallback policy: exact window,
    else previous-then-last / last / first, or an error value.

    As-of without pairs: request windows and model windows are unioned per league and a
    running ``last(model, ignorenulls)`` over the window order finds the previous model;
    the resolution table has one row per distinct request window, so it is broadcast."""
    t = fixture_tables(spark, d)
    sp = L.chrono_split(L.train_frame(spark, t))
    order = (F.col("season_start") * 10 + F.col("window_no")).cast("int")
    models = (sp.groupBy(*L.WKEYS).agg(F.count(F.lit(1)).alias("n"))
                .filter(F.col("n") >= L.window_min())
                .select("event_type_id", order.alias("o")))
    mf = M.match_asof(t).filter(F.col("over_odd").isNotNull() & ~M.is_played())
    req = (with_season_window(mf.select("event_id", "event_type_id", "start_time"), spark)
           .filter(F.col("window_no").isNotNull())
           .select("event_id", "event_type_id", "season_start", "window_no", order.alias("o")))
    policies = spark.createDataFrame(sorted(config.LEAGUE_FALLBACK.items()), "event_type_id int, policy string")
    out = S.resolve_model_windows(models, req, policies)
    return out.select("event_id", "event_type_id", "season_start", "window_no", "model_key", "fallback")


@register("team_encoding", """SELECT e.event_id, coalesce(h.idx, sz.n) AS home_idx, coalesce(a.idx, sz.n) AS away_idx
FROM fx_event e CROSS JOIN sz LEFT JOIN vocab h ON h.team_id = e.home_id LEFT JOIN vocab a ON a.team_id = e.away_id""",
          (("vocab", f"""SELECT team_id, CAST(dense_rank() OVER (ORDER BY team_id) - 1 AS INT) AS idx
    FROM (SELECT home_id AS team_id FROM fx_event WHERE {PLAYED} UNION SELECT away_id FROM fx_event WHERE {PLAYED})"""),
           ("sz", "SELECT CAST(count(*) AS INT) AS n FROM vocab")))
def team_encoding(spark, d):
    """Team id -> index learned on played matches (sorted ids); unseen teams get the
    extra 'keep' index."""
    ev = fixture_tables(spark, d).event
    return S.encode_teams(ev, M.is_played())


@register("null_policy", """SELECT event_id,
  coalesce(home_odd, 0.0E0) AS home_odd_filled, coalesce(draw_odd, 0.0E0) AS draw_odd_filled,
  coalesce(away_odd, 0.0E0) AS away_odd_filled, coalesce(home_cap, 0.0E0) AS home_cap_filled,
  coalesce(over_under_cap, 2.5E0) AS cap_filled,
  coalesce(home_handicap_odd, 2.0E0) AS home_handicap_odd_filled,
  CASE WHEN isnan(r) OR isinf(r) THEN 0.0E0 ELSE r END AS home_cap_per_away_cap_finite
FROM (SELECT *, CASE WHEN away_cap = 0 THEN (CASE WHEN home_cap > 0 THEN 'Infinity'::DOUBLE
        WHEN home_cap < 0 THEN '-Infinity'::DOUBLE ELSE 'NaN'::DOUBLE END) ELSE home_cap / away_cap END AS r FROM mf)""")
def null_policy(spark, d):
    """Fill rules: constant fill, per-column defaults and +-inf / NaN -> 0."""
    mf = M.match_frame(fixture_tables(spark, d))
    hc, ac = F.col("home_cap"), F.col("away_cap")
    # numpy semantics of x / 0: +-inf or NaN, then replaced by 0
    ratio = (F.when(ac == 0, F.when(hc > 0, F.lit(float("inf"))).when(hc < 0, F.lit(float("-inf")))
                                .otherwise(F.lit(float("nan"))))
              .otherwise(div(hc, ac)))
    return mf.select("event_id",
                     F.coalesce("home_odd", F.lit(0.0)).alias("home_odd_filled"),
                     F.coalesce("draw_odd", F.lit(0.0)).alias("draw_odd_filled"),
                     F.coalesce("away_odd", F.lit(0.0)).alias("away_odd_filled"),
                     F.coalesce("home_cap", F.lit(0.0)).alias("home_cap_filled"),
                     F.coalesce("over_under_cap", F.lit(2.5)).alias("cap_filled"),
                     F.coalesce("home_handicap_odd", F.lit(2.0)).alias("home_handicap_odd_filled"),
                     finite_or(ratio, 0.0).alias("home_cap_per_away_cap_finite"))
