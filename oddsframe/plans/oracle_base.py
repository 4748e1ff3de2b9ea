"""Shared SQL for the DuckDB oracle texts.

The six fixture views are the FIXTURES.md definitions, used as CTEs; ``lq_*`` pick the
latest quote per event with the same deterministic tie-break as the Spark operators.
"""

from __future__ import annotations

import re
from collections import Counter

from oddsframe import config

VIEWS = {
    "fx_event_type": "SELECT CAST(r_regionkey + 1 AS INT) AS event_type_id, r_name AS name FROM region",
    "fx_team": "SELECT CAST(n_nationkey AS INT) AS team_id, n_name AS name FROM nation",
    "fx_event": """SELECT o_orderkey AS event_id,
       CAST(substr(o_orderpriority, 1, 1) AS INT) AS event_type_id,
       o_orderdate AS start_time,
       CAST(o_custkey % 25 AS INT) AS home_id,
       CAST((o_custkey % 25 + 1 + o_orderkey % 24) % 25 AS INT) AS away_id,
       CASE WHEN o_orderstatus = 'O' THEN NULL ELSE CAST((o_orderkey * 7 + o_custkey) % 5 AS INT) END AS home_ft_score,
       CASE WHEN o_orderstatus = 'O' THEN NULL ELSE CAST((o_orderkey * 3 + o_custkey) % 4 AS INT) END AS away_ft_score
FROM orders""",
    "fx_over_under_odd": """SELECT l_orderkey AS event_id, l_shipdate AS created_at,
       CAST(l_linenumber AS BIGINT) * 10000000000 + l_partkey * 10000 + l_suppkey AS quote_id,
       round(1.5E0 + l_discount * 10, 2) AS over_odd,
       2.0E0 + (CAST(l_quantity AS INT) % 7) * 0.25E0 AS over_under_cap,
       round(1.5E0 + l_tax * 10, 2) AS under_odd
FROM lineitem""",
    "fx_win_odd": """SELECT l_orderkey AS event_id, l_shipdate AS created_at,
       CAST(l_linenumber AS BIGINT) * 10000000000 + l_partkey * 10000 + l_suppkey AS quote_id,
       round(1.3E0 + (l_partkey % 20) * 0.1E0, 2) AS home_odd,
       round(2.8E0 + (l_suppkey % 10) * 0.1E0, 2) AS draw_odd,
       round(1.3E0 + (CAST(l_quantity AS INT) % 20) * 0.1E0, 2) AS away_odd
FROM lineitem WHERE l_returnflag <> 'N'""",
    "fx_handicap_odd": """SELECT l_orderkey AS event_id, l_shipdate AS created_at,
       CAST(l_linenumber AS BIGINT) * 10000000000 + l_partkey * 10000 + l_suppkey AS quote_id,
       round(1.7E0 + l_discount * 4, 2) AS home_odd,
       (CAST(l_partkey % 13 AS INT) - 6) * 0.25E0 AS home_cap,
       round(1.7E0 + l_tax * 4, 2) AS away_odd,
       (6 - CAST(l_partkey % 13 AS INT)) * 0.25E0 AS away_cap
FROM lineitem WHERE l_linestatus = 'O'""",
}


def _latest(table: str, payload: list[str]) -> str:
    order = ", ".join(["created_at DESC", "quote_id DESC"] + [f"{p} DESC NULLS LAST" for p in payload])
    cols = ", ".join(["event_id", "created_at", "quote_id"] + payload)
    return (f"SELECT {cols} FROM {table} "
            f"QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY {order}) = 1")


AS_OF = f"TIMESTAMP '{config.AS_OF_SQL}'"
CUTOFF = f"(TIMESTAMP '{config.AS_OF_SQL}' - INTERVAL {config.COMPLETED_LAG_HOURS} HOUR)"
PLAYED = f"(start_time < {CUTOFF} AND home_ft_score IS NOT NULL AND away_ft_score IS NOT NULL)"

# Overrides ``lq_ou`` where a query trains: only quotes from before the kick-off.
ASOF_QUOTES = ("lq_ou", """SELECT q.event_id, q.created_at, q.quote_id, q.over_odd, q.over_under_cap, q.under_odd
FROM fx_over_under_odd q JOIN fx_event e ON q.event_id = e.event_id WHERE q.created_at < e.start_time
QUALIFY row_number() OVER (PARTITION BY q.event_id ORDER BY q.created_at DESC, q.quote_id DESC,
  q.over_odd DESC NULLS LAST, q.over_under_cap DESC NULLS LAST, q.under_odd DESC NULLS LAST) = 1""")

DERIVED = {
    "lq_ou": _latest("fx_over_under_odd", ["over_odd", "over_under_cap", "under_odd"]),
    "lq_win": _latest("fx_win_odd", ["home_odd", "draw_odd", "away_odd"]),
    "lq_hcp": _latest("fx_handicap_odd", ["home_odd", "home_cap", "away_odd", "away_cap"]),
    "mf": """SELECT e.event_id, e.event_type_id, et.name AS league_name, e.start_time, e.home_id, e.away_id,
       th.name AS home_team, ta.name AS away_team, e.home_ft_score, e.away_ft_score,
       ou.over_odd, ou.over_under_cap, ou.under_odd, w.home_odd, w.draw_odd, w.away_odd,
       h.home_cap, h.away_cap, h.home_odd AS home_handicap_odd, h.away_odd AS away_handicap_odd
FROM fx_event e
JOIN fx_event_type et ON e.event_type_id = et.event_type_id
JOIN fx_team th ON e.home_id = th.team_id
JOIN fx_team ta ON e.away_id = ta.team_id
LEFT JOIN lq_ou ou ON e.event_id = ou.event_id
LEFT JOIN lq_win w ON e.event_id = w.event_id
LEFT JOIN lq_hcp h ON e.event_id = h.event_id""",
    "calendar": "SELECT * FROM (VALUES " + ", ".join(
        f"({a}, {b}, {c}, {d})" for a, b, c, d in config.calendar_rows())
        + ") AS t(event_type_id, cal_month, season_offset, window_no)",
}


def _names(text: str, known: dict[str, str]) -> list[str]:
    return [w for w in re.findall(r"[A-Za-z_][A-Za-z_0-9]*", text) if w in known]


def sql(body: str, *ctes: tuple[str, str]) -> str:
    """WITH <the CTEs that the body reaches> <body>; a CTE named like a fixture or derived one replaces it. One that
    is used more than once is materialised, so that no input is scanned again for each use."""
    known = {**VIEWS, **DERIVED, **dict(ctes)}
    order = [*VIEWS, *DERIVED, *(k for k, _ in ctes if k not in DERIVED and k not in VIEWS)]
    reached, todo = set(), [body]
    while todo:
        for name in _names(todo.pop(), known):
            if name not in reached:
                reached.add(name)
                todo.append(known[name])
    uses = Counter(w for text in [body, *(known[k] for k in reached)] for w in _names(text, known))
    recursive = {k for k in reached if k in _names(known[k], known)}
    parts = [f"{k} AS {'MATERIALIZED ' if uses[k] > 1 and k not in recursive else ''}({known[k]})" for k in order if k in reached]
    return ("WITH " + ("RECURSIVE " if recursive else "") + ",\n".join(parts) + "\n" if parts else "") + body
