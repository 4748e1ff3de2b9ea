"""Sinks: prediction records as parquet (partitioned by league for pruning) or JSON lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_predictions(df: DataFrame, path: str, fmt: str = "parquet",
                      partition_by: str | None = "window_label") -> None:
    """Write prediction records. ``fmt='json'`` writes one JSON document per line
    (``to_json(struct(*))`` semantics); parquet is partitioned by ``partition_by``."""
    if fmt == "json":
        df.select(F.to_json(F.struct(*df.columns)).alias("value")).write.mode("overwrite").text(path)
        return
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(partition_by)
    w.parquet(path)
