"""Season-window bucketing: month -> (season offset, window number) per league.

The calendar is a small config table (12 rows per league at most) joined by
broadcast; its size is bounded by the league configuration, not by the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from oddsframe import config


def calendar_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        config.calendar_rows(),
        "event_type_id int, cal_month int, season_offset int, window_no int")


def all_windows(events: DataFrame, spark: SparkSession) -> DataFrame:
    """Season, window and the documented label forms of every event under every calendar shape (no row
    where the month belongs to no window). The calendars are configuration: at most 12 rows each."""
    cal = F.broadcast(spark.createDataFrame(
        config.calendar_shape_rows(),
        "calendar string, cal_month int, season_offset int, window_no int, first_month int, first_offset int, "
        "last_month int, last_offset int"))
    j = events.withColumn("cal_month", F.month("start_time")).join(cal, "cal_month")
    season = (F.year("start_time") - F.col("season_offset")).cast("int")

    def month_of(offset: str, month: str) -> F.Column:
        return F.format_string("%d-%02d", season + F.col(offset), F.col(month))

    years = F.concat(season.cast("string"), F.lit("-"), (season + 1).cast("string"))
    no = F.col("window_no").cast("string")
    span = F.concat(month_of("first_offset", "first_month"), F.lit(" to "), month_of("last_offset", "last_month"))
    return j.select(*events.columns, "calendar", season.alias("season_start"), "window_no",
                    F.concat(F.lit("S"), years, F.lit("-W"), no).alias("label_s"),
                    F.concat(years, F.lit("_W"), no).alias("label_underscore"),
                    F.concat(years, F.lit(" W"), no).alias("label_space"), span.alias("label_months"))


def with_season_window(df: DataFrame, spark: SparkSession) -> DataFrame:
    """Adds season_start (int), window_no (int), window_label (string); NULL when the
    month belongs to no window of the league's calendar."""
    cal = F.broadcast(calendar_table(spark))
    out = (df.withColumn("cal_month", F.month("start_time"))
             .join(cal, ["event_type_id", "cal_month"], "left"))
    season = (F.year("start_time") - F.col("season_offset")).cast("int")
    return (out.withColumn("season_start", F.when(F.col("window_no").isNotNull(), season))
               .withColumn("window_label", F.concat(
                   F.col("season_start").cast("string"), F.lit("-"),
                   (F.col("season_start") + 1).cast("string"), F.lit("-W"),
                   F.col("window_no").cast("string")))
               .drop("cal_month", "season_offset"))


def _month_label(index: Column) -> Column:
    """Months since year 0 as yyyy-mm."""
    return F.format_string("%d-%02d", F.floor(index / 12).cast("int"), (index % 12 + 1).cast("int"))


def _season_months(events: DataFrame, keys: list[str], start_month: int) -> DataFrame:
    """``(*keys, season_start, month_index, n)``: the months with matches, at most twelve per group and season."""
    index = F.year("start_time") * 12 + F.month("start_time") - 1
    season = F.floor((index - (start_month - 1)) / 12).cast("int")
    return (events.filter(F.col("start_time").isNotNull()).groupBy(*keys, season.alias("season_start"), index.cast("int").alias("month_index"))
            .agg(F.count(F.lit(1)).alias("n")))


def played_windows(events: DataFrame, keys: list[str], start_month: int = 9) -> DataFrame:
    """Windows drawn from the months played: in every group and season (from ``start_month``) each run of
    months with matches is a window, in order. ``(*keys, season_start, window_no, first_month, last_month, n_matches, window_label)``.

    Matches are counted per month first, so a window partition holds at most twelve rows whatever the group's size."""
    months = _season_months(events, keys, start_month)
    w = Window.partitionBy(*keys, "season_start").orderBy("month_index")
    new = F.coalesce((F.col("month_index") - F.lag("month_index").over(w) > 1).cast("int"), F.lit(1))
    numbered = months.withColumn("new", new).withColumn("window_no", F.sum("new").over(w).cast("int"))
    return _spans(numbered, keys)


def trimmed_windows(events: DataFrame, keys: list[str], calendar: str) -> DataFrame:
    """The windows of a calendar shape, each cut to the months in which the group played (a season that
    begins late or ends early has shorter ones). Same columns as ``played_windows``."""
    start = config.CALENDARS[calendar][0]
    month_of = F.create_map(*[F.lit(x) for m in config.calendar_months(calendar) for x in (m[0], m[2])])
    months = _season_months(events, keys, start).withColumn("window_no", F.try_element_at(month_of, (F.col("month_index") % 12 + 1).cast("int")))
    return _spans(months.filter(F.col("window_no").isNotNull()), keys)


def _spans(months: DataFrame, keys: list[str]) -> DataFrame:
    return (months.groupBy(*keys, "season_start", "window_no")
            .agg(F.min("month_index").alias("a"), F.max("month_index").alias("b"), F.sum("n").alias("n_matches"))
            .select(*keys, "season_start", "window_no", _month_label(F.col("a")).alias("first_month"), _month_label(F.col("b")).alias("last_month"),
                    "n_matches", F.concat(_month_label(F.col("a")), F.lit(" to "), _month_label(F.col("b"))).alias("window_label")))


def with_played_window(events: DataFrame, windows: DataFrame, keys: list[str]) -> DataFrame:
    """Every match with its window of ``played_windows`` or ``trimmed_windows`` (null outside): joined on the month, one
    row per month of a window."""
    def index(c: str) -> Column:
        return (F.substring_index(c, "-", 1).cast("int") * 12 + F.substring_index(c, "-", -1).cast("int") - 1)
    by_month = windows.select(*keys, F.explode(F.sequence(index("first_month"), index("last_month"))).alias("_month"), "season_start", "window_no",
                              "window_label")
    month = (F.year("start_time") * 12 + F.month("start_time") - 1).cast("int")
    return events.withColumn("_month", month).join(by_month, [*keys, "_month"], "left").drop("_month")
