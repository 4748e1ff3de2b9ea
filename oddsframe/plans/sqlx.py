"""String helpers for oracle texts (NULL-safe division, rounding)."""

from __future__ import annotations


def inv(x: str) -> str:
    return f"(1.0E0 / NULLIF({x}, 0))"


def div(a: str, b: str) -> str:
    return f"(({a}) / NULLIF({b}, 0))"


def r6(x: str) -> str:
    """No rounding: integer sums divided once and IEEE arithmetic in the same order
    give identical doubles in both engines."""
    return x


def rr6(x: str) -> str:
    """Engine-neutral rounding to 6 decimals (matches ``helpers.round6``)."""
    return f"(floor(({x}) * 1000000.0E0 + 0.5E0) / 1000000.0E0)"


def cols(*items: tuple[str, str]) -> str:
    """Render (expr, alias) pairs; doubles are wrapped by the caller with r6."""
    return ",\n  ".join(f"{e} AS {a}" for e, a in items)


P_OVER = inv("over_odd")
P_UNDER = inv("under_odd")
OU_SUM = f"({P_OVER} + {P_UNDER})"
P_OVER_FAIR = div(P_OVER, OU_SUM)
P_UNDER_FAIR = div(P_UNDER, OU_SUM)
X12_SUM = f"({inv('home_odd')} + {inv('draw_odd')} + {inv('away_odd')})"
P_HOME_FAIR = div(inv("home_odd"), X12_SUM)
P_AWAY_FAIR = div(inv("away_odd"), X12_SUM)
