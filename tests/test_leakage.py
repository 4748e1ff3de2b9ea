"""Training sees only quotes from before the kick-off, and keeps every window its league's gate admits."""

from dataclasses import replace

from pyspark.sql import functions as F

from oddsframe import config
from oddsframe.operators import learn as L
from oddsframe.sources.tables import fixture_tables
from tests.conftest import SF_SMALL


def test_late_quotes_change_nothing(spark):
    t = fixture_tables(spark, SF_SMALL)
    late = (t.event.select("event_id", "start_time").join(t.ou.select("event_id").distinct(), "event_id")
            .select("event_id", (F.col("start_time") + F.expr("INTERVAL 1 HOUR")).alias("created_at"),
                    F.lit(9 * 10 ** 15).alias("quote_id"), F.lit(9.9).alias("over_odd"),
                    F.lit(0.25).alias("over_under_cap"), F.lit(9.9).alias("under_odd")))
    at = late.withColumn("created_at", F.col("created_at") - F.expr("INTERVAL 1 HOUR"))
    more = replace(t, ou=t.ou.select(*late.columns).unionByName(late).unionByName(at))
    a, b = (L.train_frame(spark, x, with_history=True) for x in (t, more))
    assert a.count() > 0 and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_window_gate_is_the_leagues_own(spark):
    rows = [(lg, n) for lg in (1, 2, 3) for n in (7, 8, 15, 20, 29, 30)]
    kept = L.gated(spark.createDataFrame(rows, "event_type_id int, n_window int")).collect()
    least = {lg: config.LEAGUE_WINDOW_MIN.get(lg, config.WINDOW_MIN_MATCHES) for lg in (1, 2, 3)}
    assert {(r.event_type_id, r.n_window) for r in kept} == {(lg, n) for lg, n in rows if n >= least[lg]}
    assert least[2] == 8


def test_constant_feature_is_scored(spark):
    from oddsframe.operators import score as S
    f = S.LITERAL_FEATURES
    reg = S.literal_registry(spark).withColumn("std", F.lit(0.0))
    df = spark.createDataFrame([(1, 1, 0.5, 1.1, 0.0, 1.0)], "event_id int, event_type_id int, " + ", ".join(f"{x} double" for x in f))
    assert S.score_logistic(df, reg, f).first().probability is not None
