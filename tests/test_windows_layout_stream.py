"""Windows drawn from the data, the layout by league, and the keyed stream."""

import datetime as dt
import tempfile

from pyspark.sql import functions as F

from oddsframe.functions.calendar import played_windows, trimmed_windows, with_played_window
from oddsframe.operators.quotes import latest_per_key
from oddsframe.sources.tables import QUOTE_PAYLOAD, fixture_tables, load_partitioned, save_partitioned

SF = "/root/testdata/sf0.001"


def _events(spark, days):
    return spark.createDataFrame([(i, 1, d and dt.datetime.fromisoformat(d)) for i, d in enumerate(days)],
                                 "event_id long, event_type_id int, start_time timestamp_ntz")


def test_months_played_become_windows(spark):
    ev = _events(spark, ["2025-03-20", "2025-03-25", "2025-05-01", "2025-04-02", "2025-09-04", "2025-11-18", "2025-10-01", "2026-03-01", None,
                         "2024-08-31", "2024-12-31", "2025-01-01"])
    got = sorted(tuple(r)[1:] for r in played_windows(ev, ["event_type_id"]).select(
        "event_type_id", "season_start", "window_no", "window_label", "n_matches").collect())
    assert got == [(2023, 1, "2024-08 to 2024-08", 1), (2024, 1, "2024-12 to 2025-01", 2), (2024, 2, "2025-03 to 2025-05", 4),
                   (2025, 1, "2025-09 to 2025-11", 3), (2025, 2, "2026-03 to 2026-03", 1)]
    of = {r.event_id: r.window_label for r in with_played_window(ev, played_windows(ev, ["event_type_id"]), ["event_type_id"]).collect()}
    assert of[3] == "2025-03 to 2025-05" and of[8] is None and len(of) == 12


def test_calendar_windows_are_cut_to_the_months_played(spark):
    ev = _events(spark, ["2024-10-18", "2024-11-30", "2024-12-01", "2025-02-03", "2025-03-09", "2025-01-05", "2026-03-08"])
    qatar = sorted((r.season_start, r.window_no, r.window_label) for r in trimmed_windows(ev, ["event_type_id"], "sep_short_spring").collect())
    assert qatar == [(2024, 1, "2024-10 to 2024-11"), (2024, 2, "2024-12 to 2025-02"), (2024, 3, "2025-03 to 2025-03"),
                     (2025, 3, "2026-03 to 2026-03")]
    japan = sorted((r.season_start, r.window_no, r.window_label) for r in trimmed_windows(ev, ["event_type_id"], "calendar_year").collect())
    assert japan == [(2024, 3, "2024-10 to 2024-10"), (2024, 4, "2024-11 to 2024-12"), (2025, 1, "2025-02 to 2025-03"), (2026, 1, "2026-03 to 2026-03")]


def test_layout_by_league_prunes_folders(spark, tmp_path):
    t = fixture_tables(spark, SF)
    root = str(tmp_path / "layout")
    save_partitioned(t, root)
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    for name in ("event", "ou", "win", "hcp"):
        all_, some = getattr(load_partitioned(spark, root), name), getattr(load_partitioned(spark, root, [1, 3]), name)
        assert all_.exceptAll(getattr(t, name)).count() == 0 and getattr(t, name).join(t.event, "event_id", "left_semi").count() == all_.count()
        assert "PartitionFilters: [event_type_id" in plan(some)
        files = [r[0] for r in some.select(F.input_file_name()).distinct().collect()]
        assert files and all("event_type_id=1" in f or "event_type_id=3" in f for f in files)
        wanted = spark.read.parquet(f"{root}/fb_event_type.parquet").filter("name < 'ASIA'")
        pruned = getattr(load_partitioned(spark, root, wanted), name)
        assert "dynamicpruning" in plan(pruned)
        leagues = [r[0] for r in wanted.select("event_type_id").collect()]
        assert pruned.exceptAll(getattr(load_partitioned(spark, root, leagues), name)).count() == 0 and leagues


def test_keyed_stream_restarts_and_keeps_one_row_per_match(spark):
    from oddsframe.streaming.latest_quote import _generations, run_keyed_latest_quotes
    work = tempfile.mkdtemp(prefix="keyed-stream-")
    quotes = fixture_tables(spark, SF).ou
    schema = quotes.schema
    parts = [quotes.filter(F.pmod(F.xxhash64("quote_id"), F.lit(6)) == i).coalesce(1) for i in range(6)]
    for p in parts[:4]:
        p.write.mode("append").parquet(f"{work}/in")

    def stream():
        return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{work}/in")

    def batch():
        return latest_per_key(spark.read.schema(schema).parquet(f"{work}/in"), QUOTE_PAYLOAD["ou"])

    def same(a, b):
        return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0

    first = run_keyed_latest_quotes(spark, stream(), f"{work}/out", f"{work}/ckpt", compact_every=2)
    assert same(first, batch()) and _generations(spark, f"{work}/out/snapshot") == [1, 3]
    for p in parts[4:]:
        p.write.mode("append").parquet(f"{work}/in")
    # a new query on the same checkpoint goes on where the first one stopped
    again = run_keyed_latest_quotes(spark, stream(), f"{work}/out", f"{work}/ckpt", compact_every=2)
    assert same(again, batch()) and _generations(spark, f"{work}/out/update") == list(range(6))
    # an update passes on changed matches only, and the state holds one row per match
    state = spark.read.format("statestore").load(f"{work}/ckpt")
    assert state.count() == batch().count()
    assert spark.read.parquet(f"{work}/out/update/5").count() < batch().count()
    # nothing new to read: nothing changes
    assert same(run_keyed_latest_quotes(spark, stream(), f"{work}/out", f"{work}/ckpt", compact_every=2), batch())
