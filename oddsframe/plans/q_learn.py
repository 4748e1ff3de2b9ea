"""Queries: season windows, labels, gates, chronological split, standardisation, feature
scores, folds, threshold search, model fits, scoring, decisions and evaluation."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from oddsframe import config
from oddsframe.functions import market
from oddsframe.functions.calendar import all_windows, played_windows, trimmed_windows, with_played_window, with_season_window
from oddsframe.functions.helpers import div
from oddsframe.operators import evaluate as EV
from oddsframe.operators import learn as L
from oddsframe.operators import matches as M
from oddsframe.plans.oracle_base import ASOF_QUOTES, PLAYED
from oddsframe.plans.q_history import CS_CTES
from oddsframe.plans.registry import register
from oddsframe.plans.sqlx import OU_SUM, P_OVER, P_OVER_FAIR, rr6
from oddsframe.sources.tables import fixture_tables

WK = "event_type_id, season_start, window_no"
STRICT = [lg for lg, (_c, _p, _d, strict) in config.LEAGUES.items() if strict]
STRICT_SQL = "(" + ", ".join(str(x) for x in STRICT) + ")" if STRICT else "(NULL)"
LO, HI, DEN = config.THRESHOLD_GRID_LO, config.THRESHOLD_GRID_HI, config.THRESHOLD_GRID_DEN
GATE = ("(CASE event_type_id " + " ".join(f"WHEN {lg} THEN {n}" for lg, n in sorted(config.LEAGUE_WINDOW_MIN.items()))
        + f" ELSE {config.WINDOW_MIN_MATCHES} END)")

# ---------------------------------------------------------------------------
# shared oracle CTEs
# ---------------------------------------------------------------------------
TF_CTES = (
    ("tf0", f"""SELECT m.event_id, m.event_type_id, m.start_time, m.home_ft_score, m.away_ft_score,
       m.over_odd, m.under_odd, m.over_under_cap,
       {P_OVER_FAIR} AS p_over_fair, {OU_SUM} AS ou_overround, (over_under_cap - 2.5E0) AS cap_minus_25,
       (over_odd / NULLIF(under_odd, 0)) AS ou_odds_ratio, {P_OVER} AS p_over,
       CAST(home_ft_score + away_ft_score AS INT) AS total_goals,
       CAST(home_ft_score + away_ft_score > over_under_cap AS INT) AS label_over
FROM mf m WHERE {PLAYED} AND over_odd IS NOT NULL"""),
    ("tf", """SELECT tf0.*, CAST(year(tf0.start_time) - c.season_offset AS INT) AS season_start,
       c.window_no, concat(CAST(year(tf0.start_time) - c.season_offset AS VARCHAR), '-',
       CAST(year(tf0.start_time) - c.season_offset + 1 AS VARCHAR), '-W', CAST(c.window_no AS VARCHAR)) AS window_label
FROM tf0 JOIN calendar c ON c.event_type_id = tf0.event_type_id AND c.cal_month = month(tf0.start_time)"""),
    ("sp", f"""SELECT tf.*, row_number() OVER (PARTITION BY {WK} ORDER BY start_time, event_id) AS pos,
       count(*) OVER (PARTITION BY {WK}) AS n_window FROM tf"""),
    ("sp2", "SELECT *, CAST(pos * 10 <= n_window * 7 AS INT) AS is_train FROM sp"),
    ("grid", f"SELECT CAST(range AS DOUBLE) / {DEN}.0E0 AS threshold FROM range({LO}, {HI + 1})"),
    ("tsr", f"""SELECT s.event_type_id, s.season_start, s.window_no, g.threshold, count(*) AS n_train,
       sum(CASE WHEN coalesce(s.p_over_fair >= g.threshold, false) = (s.label_over = 1) THEN 1 ELSE 0 END) AS n_correct
FROM sp2 s CROSS JOIN grid g WHERE s.is_train = 1 AND s.n_window >= {GATE}
GROUP BY s.event_type_id, s.season_start, s.window_no, g.threshold"""),
    ("best", f"""SELECT * FROM tsr QUALIFY row_number() OVER (PARTITION BY {WK}
       ORDER BY n_correct DESC, threshold ASC) = 1"""),
    ("tp", f"""SELECT s.*, b.threshold,
       CAST(CASE WHEN s.event_type_id IN {STRICT_SQL} THEN coalesce(s.p_over_fair > b.threshold, false)
            ELSE coalesce(s.p_over_fair >= b.threshold, false) END AS INT) AS pred_over
FROM sp2 s JOIN best b ON s.event_type_id = b.event_type_id AND s.season_start = b.season_start
  AND s.window_no = b.window_no
WHERE s.is_train = 0"""),
    ("st", """SELECT *, CAST(pred_over = label_over AS INT) AS correct,
       CASE WHEN pred_over = label_over
            THEN CAST(round(CASE WHEN pred_over = 1 THEN over_odd ELSE under_odd END * 100) AS INT) - 100
            ELSE -100 END AS pnl FROM tp"""),
    ("ws", f"""SELECT {WK}, count(*) AS n_test, CAST(sum(correct) AS BIGINT) AS n_correct,
       CAST(sum(correct) AS DOUBLE) / count(*) AS accuracy, CAST(sum(pnl) AS BIGINT) AS pnl,
       CAST(sum(pnl) AS DOUBLE) / count(*) AS roi_pct FROM st GROUP BY {WK}"""),
    ("pooled", """SELECT event_type_id, CAST(sum(n_test) AS BIGINT) AS n_test, CAST(sum(n_correct) AS BIGINT) AS n_correct,
       CAST(sum(n_correct) AS DOUBLE) / sum(n_test) AS pooled_accuracy,
       CAST(sum(pnl) AS DOUBLE) / sum(n_test) AS pooled_roi_pct FROM ws GROUP BY event_type_id"""),
    ("completed", "SELECT event_type_id, count(*) AS n_completed FROM tf0 GROUP BY event_type_id"),
)
LEARN_CTES = (ASOF_QUOTES,) + TF_CTES


# ---------------------------------------------------------------------------
# Spark pipeline pieces
# ---------------------------------------------------------------------------

def _split(spark, d, with_history=False):
    t = fixture_tables(spark, d)
    return L.chrono_split(L.train_frame(spark, t, with_history=with_history))


def _strict() -> F.Column:
    return F.col("event_type_id").isin(STRICT) if STRICT else F.lit(False)


def _test_predictions(spark, d):
    """Test rows of gated windows decided with the threshold searched on train rows."""
    sp = L.gated(_split(spark, d))
    best = L.threshold_search(sp.filter(F.col("is_train") == 1), L.WKEYS)
    test = sp.filter(F.col("is_train") == 0).join(F.broadcast(best.select(*L.WKEYS, "threshold")),
                                                  L.WKEYS, "inner")
    p, t = F.col("p_over_fair"), F.col("threshold")
    pred = F.coalesce(F.when(_strict(), p > t).otherwise(p >= t), F.lit(False)).cast("int")
    return EV.settle(test.withColumn("pred_over", pred))


def _window_scores(spark, d):
    return EV.window_score(_test_predictions(spark, d), L.WKEYS)


def _pooled(spark, d):
    return EV.league_pooled(_window_scores(spark, d))


# ---------------------------------------------------------------------------
# calendar, labels, gates, split
# ---------------------------------------------------------------------------

@register("season_window", """SELECT e.event_id, e.event_type_id, e.start_time,
  CASE WHEN c.window_no IS NOT NULL THEN CAST(year(e.start_time) - c.season_offset AS INT) END AS season_start,
  c.window_no,
  CASE WHEN c.window_no IS NOT NULL THEN concat(CAST(year(e.start_time) - c.season_offset AS VARCHAR), '-',
       CAST(year(e.start_time) - c.season_offset + 1 AS VARCHAR), '-W', CAST(c.window_no AS VARCHAR)) END AS window_label
FROM fx_event e LEFT JOIN calendar c ON c.event_type_id = e.event_type_id AND c.cal_month = month(e.start_time)""")
def season_window(spark, d):
    """Season start and window of every match under its league's calendar (NULL outside)."""
    ev = fixture_tables(spark, d).event.select("event_id", "event_type_id", "start_time")
    return with_season_window(ev, spark).select("event_id", "event_type_id", "start_time", "season_start",
                                                "window_no", "window_label")


@register("season_window_calendars", """SELECT e.event_id, k.calendar, CAST(y0 AS INT) AS season_start, k.window_no,
  concat('S', y0, '-', y0 + 1, '-W', k.window_no) AS label_s, concat(y0, '-', y0 + 1, '_W', k.window_no) AS label_underscore,
  concat(y0, '-', y0 + 1, ' W', k.window_no) AS label_space,
  concat(y0 + first_offset, '-', lpad(CAST(first_month AS VARCHAR), 2, '0'), ' to ', y0 + last_offset, '-',
         lpad(CAST(last_month AS VARCHAR), 2, '0')) AS label_months
FROM fx_event e JOIN shapes k ON k.cal_month = month(e.start_time), LATERAL (SELECT year(e.start_time) - k.season_offset AS y0)""",
          (("shapes", "SELECT * FROM (VALUES " + ", ".join(str(r) for r in config.calendar_shape_rows())
            + ") AS t(calendar, cal_month, season_offset, window_no, first_month, first_offset, last_month, last_offset)"),))
def season_window_calendars(spark, d):
    """Season, window and label forms of every match under each documented calendar shape."""
    ev = fixture_tables(spark, d).event.select("event_id", "start_time")
    return all_windows(ev, spark).drop("start_time")


TRIMMED = ("sep_short_spring", "calendar_year")
_HOST = "event_type_id, home_id"
_SPAN = """concat(min(mi) // 12, '-', lpad(CAST(min(mi) % 12 + 1 AS VARCHAR), 2, '0'), ' to ', max(mi) // 12, '-',
         lpad(CAST(max(mi) % 12 + 1 AS VARCHAR), 2, '0'))"""
_MONTHS = ("months", f"""SELECT {_HOST}, CAST(year(start_time) * 12 + month(start_time) - 1 AS INT) AS mi, count(*) AS n
FROM fx_event GROUP BY ALL""")
_PLAYED = (_MONTHS, ("played", f"""SELECT *, sum(fresh) OVER (PARTITION BY {_HOST}, y ORDER BY mi) AS no
FROM (SELECT *, CASE WHEN mi - lag(mi) OVER (PARTITION BY {_HOST}, y ORDER BY mi) <= 1 THEN 0 ELSE 1 END AS fresh
      FROM (SELECT *, (mi - 8) // 12 AS y FROM months))"""))


@register("played_windows", f"""SELECT {_HOST}, 'months played' AS rule, CAST(y AS INT) AS season_start, CAST(no AS INT) AS window_no,
  {_SPAN} AS window_label, CAST(sum(n) AS BIGINT) AS n_matches FROM played GROUP BY {_HOST}, y, no
UNION ALL
SELECT {_HOST}, k.calendar, CAST(mi // 12 - k.season_offset AS INT), CAST(k.window_no AS INT), {_SPAN}, CAST(sum(n) AS BIGINT)
FROM months JOIN shapes k ON k.cal_month = mi % 12 + 1 GROUP BY {_HOST}, k.calendar, mi // 12 - k.season_offset, k.window_no""",
          (*_PLAYED, ("shapes", "SELECT * FROM (VALUES " + ", ".join(
              f"('{c}', {m}, {off}, {no})" for c in TRIMMED for m, off, no, _f, _l in config.calendar_months(c))
              + ") AS t(calendar, cal_month, season_offset, window_no)")))
def played_windows_query(spark, d):
    """Windows drawn from the data, by league and host: runs of months played in a season from September, and two calendar shapes
    cut to the months played."""
    ev = fixture_tables(spark, d).event.select("event_id", "event_type_id", "home_id", "start_time")
    keys = ["event_type_id", "home_id"]
    parts = [played_windows(ev, keys).withColumn("rule", F.lit("months played"))]
    parts += [trimmed_windows(ev, keys, c).withColumn("rule", F.lit(c)) for c in TRIMMED]
    out = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return out.select(*keys, "rule", "season_start", "window_no", "window_label", "n_matches")


@register("played_window_of_match", f"""SELECT e.event_id, CAST(p.y AS INT) AS season_start, CAST(p.no AS INT) AS window_no, s.window_label
FROM fx_event e JOIN played p ON p.event_type_id = e.event_type_id AND p.home_id = e.home_id
  AND p.mi = year(e.start_time) * 12 + month(e.start_time) - 1
JOIN (SELECT {_HOST}, y, no, {_SPAN} AS window_label FROM played GROUP BY {_HOST}, y, no) s
  ON s.event_type_id = p.event_type_id AND s.home_id = p.home_id AND s.y = p.y AND s.no = p.no""", _PLAYED)
def played_window_of_match(spark, d):
    """Every match with the window of months played that it falls in."""
    ev = fixture_tables(spark, d).event.select("event_id", "event_type_id", "home_id", "start_time")
    keys = ["event_type_id", "home_id"]
    return with_played_window(ev, played_windows(ev, keys), keys).select("event_id", "season_start", "window_no", "window_label")


@register("ou_label", "SELECT event_id, total_goals, over_under_cap, label_over FROM tf0", LEARN_CTES)
def ou_label(spark, d):
    """OVER iff total goals > cap (total == cap is UNDER)."""
    mf = M.match_asof(fixture_tables(spark, d))
    return (mf.filter(M.is_played() & F.col("over_odd").isNotNull())
              .select("event_id", (F.col("home_ft_score") + F.col("away_ft_score")).cast("int").alias("total_goals"),
                      "over_under_cap", L.label_over().alias("label_over")))


@register("league_gate", f"""SELECT e.event_type_id, CAST(coalesce(c.n_completed, 0) AS BIGINT) AS n_completed,
  CASE WHEN coalesce(c.n_completed, 0) >= {config.LEAGUE_MIN_MATCHES} THEN 'ok' ELSE 'failed' END AS status
FROM fx_event_type e LEFT JOIN completed c ON c.event_type_id = e.event_type_id""", LEARN_CTES)
def league_gate(spark, d):
    """>= 100 completed matches with odds per league, else 'failed'."""
    t = fixture_tables(spark, d)
    mf = M.match_asof(t)
    n = (mf.filter(M.is_played() & F.col("over_odd").isNotNull())
           .groupBy("event_type_id").agg(F.count(F.lit(1)).alias("n_completed")))
    out = t.event_type.select("event_type_id").join(n, "event_type_id", "left")
    nc = F.coalesce(F.col("n_completed"), F.lit(0)).cast("bigint")
    return out.select("event_type_id", nc.alias("n_completed"),
                      F.when(nc >= config.LEAGUE_MIN_MATCHES, F.lit("ok")).otherwise(F.lit("failed")).alias("status"))


@register("window_gate", f"""SELECT {WK}, count(*) AS n_window,
  CASE WHEN count(*) >= {GATE} THEN 'train' ELSE 'skip' END AS status FROM tf GROUP BY {WK}""", LEARN_CTES)
def window_gate(spark, d):
    """Windows under the minimum size are skipped."""
    tf = L.train_frame(spark, fixture_tables(spark, d))
    w = L.window_sizes(tf)
    return w.select(*L.WKEYS, "n_window",
                    F.when(F.col("n_window") >= L.window_min(), F.lit("train")).otherwise(F.lit("skip")).alias("status"))


@register("chrono_split", f"SELECT event_id, {WK}, CAST(pos AS BIGINT) AS pos, n_window, is_train FROM sp2", LEARN_CTES)
def chrono_split(spark, d):
    """70/30 chronological split inside every (league, season, window)."""
    return _split(spark, d).select("event_id", *L.WKEYS, "pos", "n_window", "is_train")


@register("window_over_rate", f"""SELECT {WK}, count(*) AS n, CAST(sum(label_over) AS BIGINT) AS n_over,
  CAST(sum(label_over) AS DOUBLE) / count(*) AS over_rate FROM tf GROUP BY {WK}""", LEARN_CTES)
def window_over_rate(spark, d):
    """Over count and rate per (league, season, window)."""
    tf = L.train_frame(spark, fixture_tables(spark, d))
    g = tf.groupBy(*L.WKEYS).agg(F.count(F.lit(1)).alias("n"), F.sum("label_over").cast("bigint").alias("n_over"))
    return g.select(*L.WKEYS, "n", "n_over", div(F.col("n_over"), F.col("n")).alias("over_rate"))


@register("league_summary", """SELECT event_type_id, count(*) AS n_matches, min(start_time) AS first_match,
  max(start_time) AS last_match, count(DISTINCT season_start * 10 + window_no) AS n_windows
FROM tf GROUP BY event_type_id""", LEARN_CTES)
def league_summary(spark, d):
    """Match count, date range and window count per league."""
    tf = L.train_frame(spark, fixture_tables(spark, d))
    return tf.groupBy("event_type_id").agg(
        F.count(F.lit(1)).alias("n_matches"), F.min("start_time").alias("first_match"),
        F.max("start_time").alias("last_match"),
        F.countDistinct(F.col("season_start") * 10 + F.col("window_no")).alias("n_windows"))


@register("score_rollup", f"""SELECT {WK}, count(*) AS n, CAST(sum(label_over) AS BIGINT) AS n_over,
  CAST(sum(label_over) AS DOUBLE) / count(*) AS over_rate
FROM tf GROUP BY ROLLUP (event_type_id, season_start, window_no)""", LEARN_CTES)
def score_rollup(spark, d):
    """Counts and over rate at window, season, league and overall level in one rollup."""
    tf = L.train_frame(spark, fixture_tables(spark, d))
    g = tf.rollup(*L.WKEYS).agg(F.count(F.lit(1)).alias("n"), F.sum("label_over").cast("bigint").alias("n_over"))
    return g.select(*L.WKEYS, "n", "n_over", div(F.col("n_over"), F.col("n")).alias("over_rate"))


# ---------------------------------------------------------------------------
# standardisation, feature scores, folds, thresholds
# ---------------------------------------------------------------------------

_MF = L.MARKET_FEATURES
_TRAIN_ROWS = f"(SELECT * FROM sp2 WHERE is_train = 1 AND n_window >= {GATE})"


@register("standardize", " UNION ALL ".join(
    f"SELECT {WK}, count(*) AS n_train, '{f}' AS feature, {rr6(f'avg({f})')} AS mean, "
    f"{rr6(f'stddev_pop({f})')} AS std FROM {_TRAIN_ROWS} GROUP BY {WK}" for f in _MF), LEARN_CTES, rounded=True)
def standardize(spark, d):
    """Mean and population std of each feature on the train rows of every gated window."""
    sp = L.gated(_split(spark, d)).filter(F.col("is_train") == 1)
    return L.standardize_stats(sp, L.WKEYS, _MF)


_K_BEST = 2


def _anova_sql():
    parts = []
    for f in _MF:
        parts.append(f"""SELECT {WK}, '{f}' AS feature, sum(n) AS N, sum(s) AS S, sum(q) AS Q, count(*) AS C,
  sum(s * s / n) AS SS FROM (SELECT {WK}, label_over, count(*) AS n, sum({f}) AS s, sum({f} * {f}) AS q
  FROM {_TRAIN_ROWS} GROUP BY {WK}, label_over) GROUP BY {WK}""")
    return " UNION ALL ".join(parts)


@register("select_k_best", f"""SELECT {WK}, feature, CAST(N AS BIGINT) AS n_train, {rr6('f_score')} AS f_score,
  CAST(rnk AS INT) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY {WK} ORDER BY f_score DESC NULLS LAST, feature) AS rnk FROM (
    SELECT *, ((SS - S * S / N) / NULLIF(C - 1, 0)) / NULLIF((Q - SS) / NULLIF(N - C, 0), 0) AS f_score FROM anova))
WHERE rnk <= {_K_BEST}""", LEARN_CTES + (("anova", _anova_sql()),), rounded=True)
def select_k_best(spark, d):
    """Top-k features by one-way ANOVA F on the train rows of each gated window."""
    sp = L.gated(_split(spark, d)).filter(F.col("is_train") == 1)
    f = L.anova_f(sp, L.WKEYS, _MF)
    w = Window.partitionBy(*L.WKEYS).orderBy(F.col("f_score").desc_nulls_last(), F.col("feature"))
    return (f.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= _K_BEST)
             .select(*L.WKEYS, "feature", F.col("n_train").cast("bigint").alias("n_train"), "f_score", "rank"))


@register("cv_folds", f"""SELECT {WK}, label_over, event_id,
  CAST((row_number() OVER (PARTITION BY {WK}, label_over ORDER BY start_time, event_id) - 1) % 5 AS INT) AS fold
FROM {_TRAIN_ROWS}""", LEARN_CTES)
def cv_folds(spark, d):
    """Stratified 5-fold assignment of the train rows of each gated window."""
    sp = L.gated(_split(spark, d)).filter(F.col("is_train") == 1)
    return L.cv_folds(sp)


@register("threshold_search", f"""SELECT {WK}, threshold, CAST(n_train AS BIGINT) AS n_train,
  CAST(n_correct AS BIGINT) AS n_correct_train, CAST(n_correct AS DOUBLE) / n_train AS train_accuracy FROM best""",
          LEARN_CTES)
def threshold_search(spark, d):
    """Best grid threshold (0.30 .. 0.70) on train rows per gated window, tie -> lowest."""
    sp = L.gated(_split(spark, d)).filter(F.col("is_train") == 1)
    return L.threshold_search(sp, L.WKEYS)


_GRID_ROWS = ", ".join(f"('{g}', {(lo + i * step)}.0E0 / {den}.0E0)" for g, (lo, hi, step, den) in config.THRESHOLD_GRIDS.items()
                       for i in range((hi - lo) // step + 1))


@register("threshold_grids", f"""SELECT {WK}, grid, threshold, n_train, n_correct AS n_correct_train,
  CAST(n_correct AS DOUBLE) / n_train AS train_accuracy
FROM (SELECT s.event_type_id, s.season_start, s.window_no, g.grid, g.threshold, count(*) AS n_train,
        count(*) FILTER (WHERE coalesce(s.p_over_fair >= g.threshold, false) = (s.label_over = 1)) AS n_correct
      FROM {_TRAIN_ROWS} s CROSS JOIN (VALUES {_GRID_ROWS}) AS g(grid, threshold) GROUP BY ALL)
QUALIFY row_number() OVER (PARTITION BY {WK}, grid ORDER BY n_correct DESC, threshold ASC) = 1""", LEARN_CTES)
def threshold_grids(spark, d):
    """Best threshold per gated window on every documented grid, in one pass."""
    sp = L.gated(_split(spark, d)).filter(F.col("is_train") == 1)
    return L.threshold_search_grids(sp, L.WKEYS, config.THRESHOLD_GRIDS)


_CANDIDATES = {"fair_over": "p_over_fair", "implied_over": "p_over", "form_over": "avg_over_rate"}


@register("best_model", f"""SELECT {WK}, model_name, threshold, CAST(n_correct AS DOUBLE) / n_train AS train_accuracy
FROM (SELECT s.event_type_id, s.season_start, s.window_no, s.model_name, g.threshold, count(*) AS n_train,
        sum(CASE WHEN coalesce(s.score >= g.threshold, false) = (s.label_over = 1) THEN 1 ELSE 0 END) AS n_correct
      FROM cand s CROSS JOIN grid g GROUP BY ALL)
QUALIFY row_number() OVER (PARTITION BY {WK} ORDER BY n_correct DESC, model_name ASC, threshold ASC) = 1""",
          LEARN_CTES + CS_CTES + (("cand", " UNION ALL ".join(
              f"SELECT r.event_type_id, r.season_start, r.window_no, r.label_over, '{name}' AS model_name, "
              f"{'(c.home_over_rate + c.away_over_rate) / 2' if col == 'avg_over_rate' else 'r.' + col} AS score "
              f"FROM {_TRAIN_ROWS} r JOIN cs c ON c.event_id = r.event_id"
              for name, col in _CANDIDATES.items())),))
def best_model(spark, d):
    """Per gated window, the candidate scorer (fair O/U probability, raw implied
    probability, team over-rate form) with the best searched-threshold train accuracy."""
    t = fixture_tables(spark, d)
    sp = L.gated(L.chrono_split(L.train_frame(spark, t))).filter(F.col("is_train") == 1)
    hist = L.history_columns(spark, M.match_asof(t)).select("event_id", "avg_over_rate")
    rows = sp.withColumn("p_over", market.p_over()).join(hist, "event_id", "inner")
    stack = ", ".join(f"'{n}', `{c}`" for n, c in _CANDIDATES.items())
    long = rows.selectExpr(*L.WKEYS, "label_over", f"stack({len(_CANDIDATES)}, {stack}) AS (model_name, score)")
    ts = L.threshold_search(long, L.WKEYS + ["model_name"], score="score")
    w = Window.partitionBy(*L.WKEYS).orderBy(F.col("n_correct_train").desc(), F.col("model_name"))
    return (ts.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1)
              .select(*L.WKEYS, "model_name", "threshold", "train_accuracy"))
