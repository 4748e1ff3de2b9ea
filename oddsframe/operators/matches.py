"""Match frame: matches joined with leagues, teams and latest quotes.

Join strategy: the latest-quote frames are aggregates keyed by event_id, so they
leave their exchange hash-partitioned on event_id; the match side is shuffled once
on event_id and the three quote joins reuse that partitioning. League and team
dimensions are left to the optimizer: they are broadcast when their measured size is
under ``spark.sql.autoBroadcastJoinThreshold`` and sort-merge joined otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from oddsframe import config
from oddsframe.operators.quotes import latest_quotes
from oddsframe.sources.tables import Tables

MATCH_COLUMNS = [
    "event_id", "event_type_id", "league_name", "start_time", "home_id", "away_id",
    "home_team", "away_team", "home_ft_score", "away_ft_score",
    "over_odd", "over_under_cap", "under_odd", "home_odd", "draw_odd", "away_odd",
    "home_cap", "away_cap", "home_handicap_odd", "away_handicap_odd",
]


def as_of_literal(as_of_sql: str = config.AS_OF_SQL) -> Column:
    return F.expr(f"TIMESTAMP_NTZ '{as_of_sql}'")


def completed_cutoff(as_of_sql: str = config.AS_OF_SQL) -> Column:
    return F.expr(f"TIMESTAMP_NTZ '{as_of_sql}' - INTERVAL {config.COMPLETED_LAG_HOURS} HOURS")


def is_played(as_of_sql: str = config.AS_OF_SQL) -> Column:
    """Completed-match rule (strict) plus both scores known."""
    return ((F.col("start_time") < completed_cutoff(as_of_sql))
            & F.col("home_ft_score").isNotNull() & F.col("away_ft_score").isNotNull())


def match_frame(t: Tables, team_join: str = "inner", ou_join: str = "left",
                quotes: dict[str, DataFrame] | None = None, quote_policy: str = "latest") -> DataFrame:
    """One row per match: league, both teams, and the latest quote of each market
    (``quote_policy="asof"``: the latest quote strictly before kick-off, leak-free)."""
    if quotes is None and quote_policy == "asof":
        from oddsframe.operators.quotes import asof_latest
        from oddsframe.sources.tables import QUOTE_PAYLOAD
        quotes = {n: asof_latest(getattr(t, n), t.event, QUOTE_PAYLOAD[n]) for n in ("ou", "win", "hcp")}
    elif quote_policy not in ("latest", "asof"):
        raise ValueError(f"unknown quote_policy {quote_policy}")
    q = quotes or latest_quotes(t)
    home = t.team.select(F.col("team_id").alias("home_id"), F.col("name").alias("home_team"))
    away = t.team.select(F.col("team_id").alias("away_id"), F.col("name").alias("away_team"))
    league = t.event_type.select("event_type_id", F.col("name").alias("league_name"))
    ou = q["ou"].select("event_id", "over_odd", "over_under_cap", "under_odd")
    win = q["win"].select("event_id", "home_odd", "draw_odd", "away_odd")
    hcp = q["hcp"].select("event_id", "home_cap", "away_cap",
                          F.col("home_odd").alias("home_handicap_odd"),
                          F.col("away_odd").alias("away_handicap_odd"))
    df = (t.event.join(league, "event_type_id", "inner")
                 .join(home, "home_id", team_join)
                 .join(away, "away_id", team_join)
                 .join(ou, "event_id", ou_join)
                 .join(win, "event_id", "left")
                 .join(hcp, "event_id", "left"))
    return df.select(*MATCH_COLUMNS)


def match_core(t: Tables, ou_latest: DataFrame | None = None) -> DataFrame:
    """The match columns history and training need: ids, kick-off, scores and the
    latest O/U quote. Same row set as ``match_frame`` (league and both teams INNER,
    quote LEFT) without the 1X2 / handicap aggregations and joins it does not use."""
    from oddsframe.operators.quotes import latest_per_key
    from oddsframe.sources.tables import QUOTE_PAYLOAD
    ou = ou_latest if ou_latest is not None else latest_per_key(t.ou, QUOTE_PAYLOAD["ou"])
    league = t.event_type.select("event_type_id")
    home = t.team.select(F.col("team_id").alias("home_id"))
    away = t.team.select(F.col("team_id").alias("away_id"))
    return (t.event.join(league, "event_type_id", "inner").join(home, "home_id", "inner")
                   .join(away, "away_id", "inner")
                   .join(ou.select("event_id", "over_odd", "over_under_cap", "under_odd"), "event_id", "left"))


def match_asof(t: Tables) -> DataFrame:
    """``match_core`` with the latest O/U quote strictly before each kick-off: what training and
    its history may see."""
    from oddsframe.operators.quotes import asof_latest
    from oddsframe.sources.tables import QUOTE_PAYLOAD
    return match_core(t, asof_latest(t.ou, t.event, QUOTE_PAYLOAD["ou"]))


def _side_struct(is_home: bool, flipped: bool = False) -> Column:
    """One team's view of a match as a struct (home or away; ``flipped`` = a zero-weight
    marker row at the other venue, used by venue tables)."""
    me, opp = ("home", "away") if is_home else ("away", "home")
    keep = is_played() if not flipped else F.lit(False)
    gf = F.when(keep, F.col(f"{me}_ft_score"))
    ga = F.when(keep, F.col(f"{opp}_ft_score"))
    total = gf + ga
    venue = (1 if is_home else 0) if not flipped else (0 if is_home else 1)
    return F.struct(
        F.col("event_type_id").alias("event_type_id"), F.col(f"{me}_id").alias("team_id"),
        F.col(f"{opp}_id").alias("opponent_id"), F.col("event_id").alias("event_id"),
        F.col("start_time").alias("start_time"), F.lit(venue).alias("is_home"),
        gf.cast("int").alias("gf"), ga.cast("int").alias("ga"), total.cast("int").alias("total"),
        F.col("over_under_cap").alias("cap"),
        (total > F.col("over_under_cap")).cast("int").alias("over"),
        (gf > ga).cast("int").alias("win"),
        keep.cast("int").alias("played"))


def team_long(matches: DataFrame, with_flipped_venues: bool = False) -> DataFrame:
    """Two rows per match (home and away view): removes every ``home = x OR away = x``.

    Built with one generator over the match rows (``inline(array(home, away))``), so
    the match plan appears once, not once per side. Columns: event_type_id, team_id,
    opponent_id, event_id, start_time, is_home, gf, ga, total, cap, over, win,
    played (0/1). Scores are NULL for unplayed matches. ``with_flipped_venues`` adds a
    zero-weight row per team at the other venue, so venue tables hold an entry at every
    kick-off of the team."""
    views = [_side_struct(True), _side_struct(False)]
    if with_flipped_venues:
        views += [_side_struct(True, flipped=True), _side_struct(False, flipped=True)]
    return matches.select(F.inline(F.array(*views)))


def route_events(spark: SparkSession, t: Tables, ou_latest: DataFrame) -> DataFrame:
    """Route every match to its league predictor; unmatched league or missing O/U odds
    become an ``error`` value instead of a dropped row."""
    routes = spark.createDataFrame(
        [(lg, pred) for lg, (_c, pred, _p, _s) in sorted(config.LEAGUES.items()) if pred],
        "event_type_id int, predictor string")
    has_ou = ou_latest.select("event_id", F.lit(True).alias("_has_ou"))
    df = (t.event.select("event_id", "event_type_id", "start_time")
                 .join(F.broadcast(routes), "event_type_id", "left")
                 .join(has_ou, "event_id", "left"))
    err = (F.when(F.col("predictor").isNull(), F.lit("unsupported league"))
            .when(F.col("_has_ou").isNull(), F.lit("no over/under odds")))
    return df.select("event_id", "event_type_id", "start_time", "predictor", err.alias("error"))
