"""CSV history scan, registry round trip and streaming latest quote."""

import os
import tempfile

from pyspark.sql import functions as F

from oddsframe.operators.quotes import latest_per_key
from oddsframe.sources.tables import QUOTE_PAYLOAD, fixture_tables, read_history_csv
from oddsframe.streaming.latest_quote import latest_quote_stream

SF = "/root/testdata/sf0.001"


def test_history_csv_roundtrip(spark):
    ev = fixture_tables(spark, SF).event.filter(F.col("home_ft_score").isNotNull())
    out = os.path.join(tempfile.mkdtemp(prefix="hist-csv-"), "hist")
    (ev.select("event_id", F.concat(F.regexp_replace(F.col("start_time").cast("string"), " ", "T"),
                                    F.lit("Z")).alias("start_time"),
               "home_id", "away_id", "home_ft_score", "away_ft_score", F.lit(2.5).alias("over_under_cap"))
       .write.option("header", "true").csv(out))
    back = read_history_csv(spark, out)
    assert back.count() == ev.count()
    assert back.filter(F.col("start_time").isNull()).count() == 0
    assert dict(back.dtypes)["start_time"] == "timestamp_ntz"


def test_stream_equals_batch(spark):
    batch = latest_per_key(fixture_tables(spark, SF).ou, QUOTE_PAYLOAD["ou"])
    stream = latest_quote_stream(spark, SF)
    assert batch.exceptAll(stream).count() == 0 and stream.exceptAll(batch).count() == 0


def test_iso_parsing_is_zone_independent(spark):
    from oddsframe.sources.tables import parse_iso_ntz
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        rows = [("1996-10-06T00:00:00Z",), ("1996-10-06",), ("2001-02-30T00:00:00",), ("junk",),
                ("1998-01-02 13:45:10.5",)]
        got = [r[0] for r in spark.createDataFrame(rows, "s string").select(parse_iso_ntz("s")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    import datetime as dt
    assert got == [dt.datetime(1996, 10, 6), dt.datetime(1996, 10, 6), None, None,
                   dt.datetime(1998, 1, 2, 13, 45, 10, 500000)]


def test_load_tables_canonical_parquet_roundtrip(spark):
    from oddsframe.operators.matches import match_frame
    from oddsframe.sources.tables import load_tables
    t = fixture_tables(spark, SF)
    root = tempfile.mkdtemp(prefix="canonical-")
    for name, df in (("fb_event", t.event), ("fb_team", t.team), ("fb_event_type", t.event_type),
                     ("fb_over_under_odd", t.ou), ("fb_win_odd", t.win), ("fb_handicap_odd", t.hcp)):
        df.write.parquet(f"{root}/{name}.parquet")
    back = load_tables(spark, root, fmt="parquet")
    a, b = match_frame(t), match_frame(back)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_asof_policy_never_uses_late_quotes(spark):
    from oddsframe.operators.matches import match_frame
    t = fixture_tables(spark, SF)
    asof = match_frame(t, quote_policy="asof").select("event_id", "over_odd")
    latest = match_frame(t).select("event_id", "over_odd")
    n_asof = asof.filter(F.col("over_odd").isNotNull()).count()
    assert 0 < n_asof < latest.filter(F.col("over_odd").isNotNull()).count()


def test_stream_over_several_micro_batches_equals_batch(spark):
    import pyarrow.parquet as pq

    from oddsframe.sources.tables import ou_from_lineitem
    from oddsframe.streaming.latest_quote import LINEITEM_SCHEMA, run_latest_quote_stream
    src = tempfile.mkdtemp(prefix="quote-files-")
    table = pq.read_table(f"{SF}/lineitem.parquet")
    step = (table.num_rows + 2) // 3
    for i in range(3):  # three files -> three micro-batches (one file per trigger)
        pq.write_table(table.slice(i * step, step), f"{src}/lineitem_{i}.parquet")
    stream = ou_from_lineitem(spark.readStream.schema(LINEITEM_SCHEMA).option("maxFilesPerTrigger", 1)
                              .parquet(src))
    work = tempfile.mkdtemp(prefix="quote-stream-")
    got = run_latest_quote_stream(spark, stream, f"{work}/candidates", f"{work}/_ckpt")
    batch = latest_per_key(fixture_tables(spark, SF).ou, QUOTE_PAYLOAD["ou"])
    assert got.exceptAll(batch).count() == 0 and batch.exceptAll(got).count() == 0
    # a replayed micro-batch only re-appends candidates: the result does not change
    again = run_latest_quote_stream(spark, stream, f"{work}/candidates", f"{tempfile.mkdtemp()}/_ckpt2")
    assert again.exceptAll(batch).count() == 0 and batch.exceptAll(again).count() == 0


def test_prediction_sinks_round_trip(spark):
    import json

    import __spark_entry__ as E
    from oddsframe.sources.sinks import write_predictions
    preds = E.queries()["prediction_output"](spark, SF)
    root = tempfile.mkdtemp(prefix="sink-")
    write_predictions(preds, f"{root}/pq")
    back = spark.read.parquet(f"{root}/pq")
    assert back.count() == preds.count()
    assert set(back.columns) == set(preds.columns)
    write_predictions(preds.drop("start_time"), f"{root}/json", fmt="json")
    lines = spark.read.text(f"{root}/json").collect()
    assert len(lines) == preds.count() and json.loads(lines[0].value)["prediction"] in ("OVER", "UNDER")
