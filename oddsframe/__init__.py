"""oddsframe: match-odds analytics as Spark DataFrame jobs.

Layout:
  sources/    table loading (parquet / jdbc / catalog), fixture views, registry and CSV history
  functions/  column-expression libraries (market features, calendars, null policy)
  operators/  DataFrame -> DataFrame operators (quotes, matches, history, learning, scoring, evaluation)
  plans/      the query catalogue used by ``__spark_entry__`` and its DuckDB oracle texts
  streaming/  Structured Streaming form of the latest-quote operator
"""

__version__ = "0.1.0"
