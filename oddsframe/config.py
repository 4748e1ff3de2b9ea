"""Configuration values.

Two kinds of values live here:

* fixed values that must equal the documented rules of the predictor suite being
  re-implemented (completed-match lag, gates, split share, acceptance target, bet
  confidence, calendars, cold-start defaults, threshold grid);
* the mapping of the five fixture leagues of the test data onto those calendars,
  predictors and default profiles (a choice of this repository, not a fixed value).
"""

from __future__ import annotations

import datetime as _dt

# ---------------------------------------------------------------------------
# Fixed values (documented rules; keep as written)
# ---------------------------------------------------------------------------
COMPLETED_LAG_HOURS = 3            # completed match: as_of - 3 hours > start_time
LEAGUE_MIN_MATCHES = 100           # league gate: >= 100 completed matches with odds
WINDOW_MIN_MATCHES = 8             # window gate where a league names none: the smallest window the reports score
TRAIN_NUM, TRAIN_DEN = 7, 10       # chronological 70 / 30 split, train = floor(0.7 n)
ACCEPT_MIN_ACCURACY = 0.70         # acceptance: accuracy >= 70 %
ACCEPT_MIN_ROI = 0.0               # acceptance: ROI >= 0 %
ACCEPT_MIN_MATCHES = 100           # acceptance: >= 100 matches
BET_MIN_CONFIDENCE = 0.3           # recommended bet only when abs(p - 0.5) * 2 > 0.3
DEFAULT_THRESHOLD = 0.5            # fixed decision threshold when none was searched
WINDOW_TARGET_ACCURACY = 0.7       # windows counted as meeting target
RECENT_LIMIT = 30                  # joint recent-form window (30 most recent matches)
LAST_N_FORM = 10                   # last-10 form
LAST_N_SHORT = 5                   # last-5 total-goals / over-rate form
ROLLING_MIN_GAMES = 2              # rolling-5 form needs at least 2 games
ROUND_OUTPUT = 4                   # probabilities are printed with 4 decimals

# Threshold grid 0.30 .. 0.70 step 0.01, held as integers (hundredths) so that
# every engine builds the same doubles: t = double(k) / 100.
THRESHOLD_GRID_LO = 30
THRESHOLD_GRID_HI = 70
THRESHOLD_GRID_DEN = 100
# Every documented grid: name -> (lowest, highest, step, denominator), as integers
THRESHOLD_GRIDS: dict[str, tuple[int, int, int, int]] = {
    "0.30-0.70/0.01": (THRESHOLD_GRID_LO, THRESHOLD_GRID_HI, 1, THRESHOLD_GRID_DEN),
    "0.20-0.80/0.01": (20, 80, 1, 100),
    "0.25-0.75/0.02": (25, 75, 2, 100),
    "0.30-0.70/0.02": (30, 70, 2, 100),
    "0.30-0.70/0.05": (30, 70, 5, 100),
    "0.30-0.71/0.01": (30, 71, 1, 100),
    "0.30-0.70/0.025": (300, 700, 25, 1000),
}

# Season calendars. Each entry: (season start month,
#   list of (window number, first month, last month)); months not listed belong to
#   no window. A month before the season start month belongs to the season that
#   started in the previous calendar year.
CALENDARS: dict[str, tuple[int, list[tuple[int, int, int]]]] = {
    # Aug start, 4 x 3 months: Aug-Oct, Nov-Jan, Feb-Apr, May-Jul
    "aug_quarters": (8, [(1, 8, 10), (2, 11, 1), (3, 2, 4), (4, 5, 7)]),
    # Aug start, Aug-Oct, Nov-Jan, Feb-May; Jun-Jul in no window
    "aug_three": (8, [(1, 8, 10), (2, 11, 1), (3, 2, 5)]),
    # Jul start, 4 x 3 months: Jul-Sep, Oct-Dec, Jan-Mar, Apr-Jun
    "jul_quarters": (7, [(1, 7, 9), (2, 10, 12), (3, 1, 3), (4, 4, 6)]),
    # Sep start, 4 x 3 months: Sep-Nov, Dec-Feb, Mar-May, Jun-Aug
    "sep_quarters": (9, [(1, 9, 11), (2, 12, 2), (3, 3, 5), (4, 6, 8)]),
    # Mar start: Mar-May, Jun-Aug, Sep-Feb
    "mar_three": (3, [(1, 3, 5), (2, 6, 8), (3, 9, 2)]),
    # Aug start, Aug-Nov, Dec-Feb, Mar-Jul
    "aug_long_ends": (8, [(1, 8, 11), (2, 12, 2), (3, 3, 7)]),
    # Sep start, Sep-Nov, Dec-Feb, Mar-Apr, May-Aug
    "sep_short_spring": (9, [(1, 9, 11), (2, 12, 2), (3, 3, 4), (4, 5, 8)]),
    # calendar year: Feb-Apr, May-Jul, Aug-Oct, Nov-Dec; Jan in no window
    "calendar_year": (1, [(1, 2, 4), (2, 5, 7), (3, 8, 10), (4, 11, 12)]),
    # cup: Aug start, Nov-Jan and Feb-Apr only
    "aug_cup": (8, [(1, 11, 1), (2, 2, 4)]),
}

# Cold-start default profiles: (scored, conceded, over_rate, win_rate, min_games)
DEFAULT_PROFILES: dict[str, tuple[float, float, float, float, int]] = {
    "profile_15": (1.5, 1.5, 0.5, 0.45, 1),
    "profile_18": (1.8, 1.3, 0.5, 0.45, 1),
    "profile_23": (2.3, 2.3, 0.5, 0.45, 1),
    "profile_25": (2.5, 2.5, 0.5, 0.45, 2),
    "profile_125": (1.25, 1.25, 0.5, 0.45, 1),
}

# Profiles whose sides differ or whose minimum is another:
# (home scored, conceded, over_rate, away scored, conceded, over_rate, min_games)
SIDE_PROFILES: dict[str, tuple[float, float, float, float, float, float, int]] = {
    "home_18_away_13": (1.8, 1.3, 0.5, 1.3, 1.8, 0.5, 1),
    "home_15_away_12_min3": (1.5, 1.3, 0.45, 1.2, 1.4, 0.40, 3),
    "both_20": (2.0, 2.0, 0.5, 2.0, 2.0, 0.5, 1),
    "both_18": (1.8, 1.8, 0.5, 1.8, 1.8, 0.5, 1),
    "both_23": (2.3, 2.3, 0.5, 2.3, 2.3, 0.5, 1),
}
VENUE_LAST_N_DEFAULT = 2.0         # venue last-10 averages without a match
VENUE_DEFAULT = 1.8                # venue expanding averages without a match

# ---------------------------------------------------------------------------
# Fixture league mapping (repository choice for the five test-data leagues)
# ---------------------------------------------------------------------------
# league id -> (calendar, predictor name or None, default profile, strict '>' decision)
LEAGUES: dict[int, tuple[str, str | None, str, bool]] = {
    1: ("aug_quarters", "aug_quarters_predictor", "profile_15", False),
    2: ("aug_three", "aug_three_predictor", "profile_15", True),
    3: ("jul_quarters", "jul_quarters_predictor", "profile_18", False),
    4: ("sep_quarters", "sep_quarters_predictor", "profile_125", False),
    5: ("mar_three", None, "profile_25", False),
}

# Window gate by league: some reports skip windows under 30 or 20 matches, others keep theirs of 8
LEAGUE_WINDOW_MIN: dict[int, int] = {1: 30, 3: 20}

# Model-fallback policy when a request's window has no model (exact window always wins):
#   previous_then_last: latest earlier window with a model, else the league's last one
#   last: the league's last model window;  first: its first;  error: no model (error value)
FALLBACK_POLICIES = ("previous_then_last", "last", "first", "error")
LEAGUE_FALLBACK: dict[int, str] = {1: "previous_then_last", 2: "previous_then_last", 3: "error", 4: "first", 5: "last"}

# As-of instant used by the completed-match rule (a parameter, never now()).
AS_OF = _dt.datetime(2001, 1, 1, 0, 0, 0)
AS_OF_SQL = "2001-01-01 00:00:00"


def calendar_months(cal: str) -> list[tuple[int, int, int, int, int]]:
    """(month, season_offset, window_no, first month, last month) for every month in a window."""
    start, windows = CALENDARS[cal]
    rows = []
    for wno, first, last in windows:
        for i in range((last - first) % 12 + 1):
            m = (first - 1 + i) % 12 + 1
            rows.append((m, int(m < start), wno, first, last))
    return rows


def calendar_rows() -> list[tuple[int, int, int, int]]:
    """(league, month, season_offset, window_no) for every league and month in a window."""
    return [(league, *month[:3]) for league, (cal, *_rest) in sorted(LEAGUES.items()) for month in calendar_months(cal)]


def calendar_shape_rows() -> list[tuple[str, int, int, int, int, int, int, int]]:
    """(calendar, month, season_offset, window_no, first month, its offset, last month, its offset)."""
    return [(cal, m, off, wno, first, int(first < CALENDARS[cal][0]), last, int(last < CALENDARS[cal][0]))
            for cal in CALENDARS for m, off, wno, first, last in calendar_months(cal)]


def threshold_grid() -> list[int]:
    return list(range(THRESHOLD_GRID_LO, THRESHOLD_GRID_HI + 1))
