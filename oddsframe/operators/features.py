"""Feature graph: named features, what they are made of, and their ordered assembly.

A vector names its features in order, each an expression over other features of the vector, columns of the match frame,
market features and history columns. ``resolve`` follows the names down to columns and says which history tables
a set of vectors needs; ``feature_frame`` builds each of these once, however many vectors and features use it, and joins them to
the matches; ``assemble`` evaluates the vectors of each match's league in their order.

The matches are written to the shared checkpoint folder once: the history tables start from there, those of one kind (team, venue)
from one prefix of totals, and their statistics per match are written too, as are the joined columns. So no plan holds more than one kind, and the driver plans,
replans and keeps metrics of a few stages at a time. History tables are keyed by team and kick-off and joined on these, so a team with a third of all
matches is no hot key.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from oddsframe import config
from oddsframe.functions import market
from oddsframe.functions.helpers import div
from oddsframe.operators import history as H
from oddsframe.operators import matches as M
from oddsframe.operators.learn import assert_no_leakage
from oddsframe.operators.score import encode_teams
from oddsframe.session import stored

NAME = re.compile(r"(\$?)([A-Za-z_][A-Za-z_0-9]*)")
LOCAL = re.compile(r"\$([A-Za-z_][A-Za-z_0-9.]*)")
# history table -> (keys, how many most recent matches or None for all)
TABLES: dict[str, tuple[str, int | None]] = {
    "all": ("team", None), "last10": ("team", config.LAST_N_FORM), "last5": ("team", config.LAST_N_SHORT),
    "athome": ("venue", None), "ataway": ("venue", None),
    "athome10": ("venue", config.LAST_N_FORM), "ataway10": ("venue", config.LAST_N_FORM), "both10": ("venue", config.LAST_N_FORM),
    "athome5": ("venue", config.LAST_N_SHORT), "ataway5": ("venue", config.LAST_N_SHORT),
    "joint": ("joint", config.RECENT_LIMIT), "team": ("code", None),
}
HISTORY = re.compile(r"^(home|away)_(" + "|".join(sorted(TABLES, key=len, reverse=True)) + r")_(" + "|".join(H.RATE_STATS) + r"|code)$")


@dataclass(frozen=True)
class Vector:
    """Features in order, and every feature's expression down to columns."""

    name: str
    features: tuple[str, ...]
    expressions: tuple[str, ...]
    fill: float | None = None

    def columns(self) -> set[str]:
        return {m.group(2) for e in self.expressions for m in NAME.finditer(e)}


def resolve(name: str, text: str, fill: float | None = None) -> Vector:
    """A vector from its lines; features that refer to each other in a circle or to nothing are an error.
    A line that begins with a colon names a helper that is not part of the vector."""
    given, order = {}, []
    for line in filter(None, map(str.strip, text.splitlines())):
        feature, _, expression = (p.strip() for p in line.lstrip(": ").partition("="))
        if feature in given:
            raise ValueError(f"{name}: {feature} is given twice")
        given[feature] = expression or feature
        if not line.startswith(":"):
            order.append(feature)
    done: dict[str, str] = {}

    def follow(feature: str, path: tuple[str, ...]) -> str:
        if feature in path or feature not in given:
            raise ValueError(f"{name}: {' -> '.join((*path, feature))} is a circle or unknown")
        if feature not in done:
            done[feature] = LOCAL.sub(lambda m: f"({follow(m.group(1), (*path, feature))})", given[feature])
        return done[feature]

    assert_no_leakage(order)
    vector = Vector(name, tuple(order), tuple(follow(f, ()) for f in order), fill)
    assert_no_leakage(sorted(vector.columns()))
    return vector


def history_needed(vectors: list[Vector]) -> dict[str, set[str]]:
    """History table -> statistics that the vectors reach."""
    need: dict[str, set[str]] = {}
    for v in vectors:
        for c in v.columns():
            m = HISTORY.match(c)
            if m:
                need.setdefault(m.group(2), set()).add(m.group(3))
    return need


def _suffix(n: int | None) -> str:
    return "" if n is None else str(n)


def _team_tables(m: DataFrame, base: DataFrame, need: dict[str, set[str]]) -> DataFrame:
    """Statistics of both sides from all tables of a team's matches."""
    names = {t: TABLES[t][1] for t in TABLES if t in need}
    looked = H.two_sided(base, H.history_tables(M.team_long(m), H.LEAGUE_TEAM, names, H.written))
    return looked.select("event_id", *[c for s in ("home", "away") for t in names for c in H.rates(f"{s}_{t}", stats=_in_order(need[t]))])


def _venue_tables(m: DataFrame, base: DataFrame, need: dict[str, set[str]]) -> DataFrame:
    """Statistics of both sides from all tables of a team's matches at a venue, or at both venues together from their totals."""
    limits = {f"last{_suffix(n)}": n for n in dict.fromkeys(TABLES[t][1] for t in TABLES if t in need)}
    both = any(t.startswith("both") for t in need)
    sides = [(f"{side}_{at}", f"{side}_id", venue) for side in ("home", "away") for at, venue in (("athome", 1), ("ataway", 0))
             if both or any(t.startswith(at) for t in need)]
    out = H.lookup_sides(base, H.history_tables(M.team_long(m, with_flipped_venues=True), H.LEAGUE_TEAM_VENUE, limits, H.written), sides)
    values = list(H.history_values())
    cols = []
    for n in limits.values():
        for p, _id, _venue in sides:
            cols += [F.col(f"{p}_last{_suffix(n)}_{v}").alias(f"{p}{_suffix(n)}_{v}") for v in values]
        if f"both{_suffix(n)}" in need:
            cols += [sum((F.coalesce(f"{s}_{at}_last{_suffix(n)}_{v}", F.lit(0)) for at in ("athome", "ataway")), F.lit(0)).alias(
                f"{s}_both{_suffix(n)}_{v}") for s in ("home", "away") for v in values]
    return out.select("event_id", *cols).select("event_id", *[
        c for s in ("home", "away") for t in sorted(need) for c in H.rates(f"{s}_{t}", stats=_in_order(need[t]))])


def _in_order(stats: set[str]) -> tuple[str, ...]:
    return tuple(s for s in H.RATE_STATS if s in stats)


def feature_frame(spark: SparkSession, frame: DataFrame, vectors: list[Vector], seen: Column | None = None) -> DataFrame:
    """``frame`` (a match frame; its names only where a vector uses them) with all market features and the history columns that
    ``vectors`` reach.

    ``seen`` says from which matches team codes are learnt (played ones unless given)."""
    return feature_columns(spark, frame.transform(stored, "features"), vectors, seen)


def feature_columns(spark: SparkSession, m: DataFrame, vectors: list[Vector], seen: Column | None = None) -> DataFrame:
    """``feature_frame`` of a match frame that is written already."""
    need = history_needed(vectors)
    base = m.select("event_id", "event_type_id", "start_time", "home_id", "away_id")
    out = m
    for kind in dict.fromkeys(TABLES[t][0] for t in TABLES if t in need):
        mine = {t: need[t] for t in need if TABLES[t][0] == kind}
        if kind == "team":
            side = _team_tables(m, base, mine)
        elif kind == "venue":
            side = _venue_tables(m, base, mine)
        elif kind == "joint":
            joint = H.joint_recent(M.team_long(m), m)
            side = joint.select("event_id", *[div(F.col(f"_{s[0]}{v}"), F.col(f"{s}_n")).alias(f"{s}_joint_{stat}")
                                              for s in ("home", "away") for v, stat in (("gf", "scored"), ("ga", "conceded"))])
        else:
            codes = encode_teams(m, M.is_played() if seen is None else seen)
            side = codes.select("event_id", F.col("home_idx").alias("home_team_code"), F.col("away_idx").alias("away_team_code"))
        out = out.join(side.transform(stored, "history"), "event_id", "left")
    # names are no features: they are not carried through the joins
    used = set().union(*(v.columns() for v in vectors)) if vectors else set()
    known = out if out is m else out.drop(*[c for c, t in m.dtypes if t == "string" and c not in used]).transform(stored, "features")
    # market features are sums and quotients of the row's own columns: they are computed where they are read and never shuffled
    return known.select("*", *[c for group in market.GROUPS.values() for c in group()])


def values(vector: Vector) -> Column:
    """The vector's features as doubles, in order; infinite and undefined values count as missing."""
    cells = F.array(*[F.expr(e).cast("double") for e in vector.expressions])
    # one check over the array: a check per feature would hold the text of each feature several times
    finite = lambda x: F.when(F.abs(x) < F.lit(float("inf")), x)
    return F.transform(cells, finite if vector.fill is None else lambda x: F.coalesce(finite(x), F.lit(vector.fill)))


def assemble(frame: DataFrame, vectors: list[Vector], of_league: dict[int, tuple[str, ...]], carry: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """``(event_id, *carry, vector, values)``: one row per match and vector of its league, values in the vector's order."""
    by_name = {v.name: v for v in vectors}
    rows = F.lit(None)
    for league, names in sorted(of_league.items()):
        rows = F.when(F.col("event_type_id") == league, F.array(*[
            F.struct(F.lit(n).alias("vector"), values(by_name[n]).alias("values")) for n in names])).otherwise(rows)
    return frame.select("event_id", *carry, F.inline(rows))
