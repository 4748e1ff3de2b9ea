"""Structured Streaming form of the latest-quote operator.

Odds tables are append-only histories, so the latest quote per match can be kept
incrementally: every micro-batch reduces its rows to one candidate per match and
appends those candidates to a table in the shared folder; the latest quote is the
same reduction over the candidates. The reduction (max over the full ordering) is
idempotent, so a micro-batch replayed after an executor or driver failure only
re-appends candidates that change nothing. Nothing is collected on the driver and
the state is the candidate table, not executor memory.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from oddsframe.operators.quotes import latest_per_key
from oddsframe.session import checkpoint_dir
from oddsframe.sources.tables import QUOTE_PAYLOAD, ou_from_lineitem

LINEITEM_SCHEMA = T.StructType([
    T.StructField("l_orderkey", T.LongType()), T.StructField("l_partkey", T.LongType()),
    T.StructField("l_suppkey", T.LongType()), T.StructField("l_linenumber", T.IntegerType()),
    T.StructField("l_quantity", T.DoubleType()), T.StructField("l_extendedprice", T.DoubleType()),
    T.StructField("l_discount", T.DoubleType()), T.StructField("l_tax", T.DoubleType()),
    T.StructField("l_returnflag", T.StringType()), T.StructField("l_linestatus", T.StringType()),
    T.StructField("l_shipdate", T.TimestampNTZType()),
])


def ou_quote_stream(spark: SparkSession, sf_dir: str, files_per_trigger: int = 1) -> DataFrame:
    """O/U quotes as a stream over the test data's lineitem file(s)."""
    raw = (spark.readStream.schema(LINEITEM_SCHEMA)
                .option("pathGlobFilter", "lineitem*.parquet")
                .option("maxFilesPerTrigger", files_per_trigger)
                .parquet(sf_dir))
    return ou_from_lineitem(raw)


def run_latest_quote_stream(spark: SparkSession, quotes: DataFrame, out_path: str, ckpt_path: str,
                            payload: list[str] = QUOTE_PAYLOAD["ou"]) -> DataFrame:
    """Drain the stream (availableNow) into the candidate table; return the latest quotes."""
    def merge(batch: DataFrame, _epoch: int) -> None:
        latest_per_key(batch, payload).write.mode("append").parquet(out_path)

    q = (quotes.writeStream.foreachBatch(merge)
               .option("checkpointLocation", ckpt_path)
               .trigger(availableNow=True).start())
    q.awaitTermination()
    return latest_quotes_from(spark, out_path, payload)


def latest_quotes_from(spark: SparkSession, out_path: str, payload: list[str] = QUOTE_PAYLOAD["ou"]) -> DataFrame:
    return latest_per_key(spark.read.parquet(out_path), payload)


def latest_quote_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    import uuid
    base = f"{checkpoint_dir(spark)}/latest-quote-stream-{uuid.uuid4().hex}"
    return run_latest_quote_stream(spark, ou_quote_stream(spark, sf_dir), f"{base}/candidates", f"{base}/_ckpt")


# ---------------------------------------------------------------------------
# Keyed state
# ---------------------------------------------------------------------------

COMPACT_EVERY = 8


def _generations(spark: SparkSession, folder: str) -> list[int]:
    """Numbers of the complete sub-folders ``<number>`` of a folder on any file system, rising."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    found = [s.getPath() for s in fs.listStatus(path)]
    return sorted(int(p.getName()) for p in found if p.getName().isdigit() and fs.exists(jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS")))


def keyed_latest(spark: SparkSession, out_path: str, payload: list[str] = QUOTE_PAYLOAD["ou"]) -> DataFrame:
    """The latest quotes now: the last snapshot and the updates after it."""
    snapshots, updates = _generations(spark, f"{out_path}/snapshot"), _generations(spark, f"{out_path}/update")
    base = snapshots[-1] if snapshots else -1
    paths = [f"{out_path}/snapshot/{base}"] * bool(snapshots) + [f"{out_path}/update/{b}" for b in updates if b > base]
    return latest_per_key(spark.read.parquet(*paths), payload)


def run_keyed_latest_quotes(spark: SparkSession, quotes: DataFrame, out_path: str, ckpt_path: str,
                            payload: list[str] = QUOTE_PAYLOAD["ou"], compact_every: int = COMPACT_EVERY) -> DataFrame:
    """Drain the stream (availableNow) through a streaming aggregation in update mode; return the latest quotes.

    The state store holds one row per match, so state is bounded by matches and not by quotes, and a batch passes on only
    the matches that it changed. Each batch writes these to a folder of its own number (a batch that is replayed after a
    failure writes the same folder again); every ``compact_every`` batches the last snapshot and the updates since become
    the next snapshot, so a reader meets one snapshot and a bounded number of updates, however long the stream has run."""
    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out_path}/update/{number}")
        if number % compact_every == compact_every - 1:
            keyed_latest(spark, out_path, payload).write.mode("overwrite").parquet(f"{out_path}/snapshot/{number}")

    q = (latest_per_key(quotes, payload).writeStream.outputMode("update").foreachBatch(write)
         .option("checkpointLocation", ckpt_path).trigger(availableNow=True).start())
    q.awaitTermination()
    return keyed_latest(spark, out_path, payload)


def latest_quote_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    import uuid
    base = f"{checkpoint_dir(spark)}/latest-quote-keyed-{uuid.uuid4().hex}"
    return run_keyed_latest_quotes(spark, ou_quote_stream(spark, sf_dir), base, f"{base}/_ckpt")
