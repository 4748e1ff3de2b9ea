"""Tables that are built once: vectors of the split's rows only, and one prefix of totals for all history tables of a kind."""

from oddsframe import config
from oddsframe.operators import features as FT
from oddsframe.operators import history as H
from oddsframe.operators import matches as M
from oddsframe.operators import models as MD
from oddsframe.plans.q_features import RESOLVED
from oddsframe.plans.q_models import OF_LEAGUE
from oddsframe.session import stored
from oddsframe.sources.tables import fixture_tables

SF = "/root/testdata/sf0.001"


def _recorded(monkeypatch, *modules):
    seen = []

    def record(df, label):
        seen.append((label, df.columns))
        return stored(df, label)
    for module in modules:
        monkeypatch.setattr(module, "stored", record)
    return seen


def test_vectors_are_made_of_the_rows_of_the_split_only(spark, monkeypatch):
    """Before, the vectors of all matches, unplayed and ungated ones too, were written and shuffled."""
    seen = _recorded(monkeypatch, MD)
    rows = MD.vector_rows(spark, fixture_tables(spark, SF), RESOLVED, OF_LEAGUE)
    assert [label for label, _ in seen] == ["asof-matches", "models"]
    width = {league: len(next(v for v in RESOLVED if v.name == name).features) for league, name in OF_LEAGUE.items()}
    found = rows.select("event_id", "event_type_id", "x", "y", "label_over").collect()
    assert found and len({r.event_id for r in found}) == len(found)
    assert all(len(r.x) == width[r.event_type_id] and None not in r.x and r.y == r.label_over for r in found)


def test_history_is_written_once_per_kind(spark, monkeypatch):
    """Before, each of the nine tables was joined to the matches and written by itself."""
    m = stored(M.match_frame(fixture_tables(spark, SF)), "test")
    seen = _recorded(monkeypatch, FT)
    FT.feature_columns(spark, m, RESOLVED)
    assert [label for label, _ in seen] == ["history"] * len({kind for kind, _n in FT.TABLES.values()}) + ["features"]
    assert not {"home_team", "away_team", "league_name"} & set(seen[-1][1])


def test_tables_of_a_kind_equal_each_by_itself(spark):
    m = M.match_core(fixture_tables(spark, SF))
    limits = {"all": None, "ten": config.LAST_N_FORM, "five": config.LAST_N_SHORT}
    for keys, flipped in ((H.LEAGUE_TEAM, False), (H.LEAGUE_TEAM_VENUE, True)):
        tl = M.team_long(m, with_flipped_venues=flipped)
        every = H.history_tables(tl, keys, limits, H.written)
        for name, n in limits.items():
            mine = every.select(*keys, "start_time", *[f"{name}_{v}" for v in H.history_values()])
            alone = H.expanding_table(tl, keys) if n is None else H.last_n_table(tl, keys, n)
            assert sorted(map(tuple, mine.collect())) == sorted(map(tuple, alone.collect()))
