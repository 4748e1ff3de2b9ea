"""Helpers shared by the corpus operators: table reading, shared scratch tables, null-safe text."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TOKENIZER_DIR = "/opt/tokenizers"


def read_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The named columns of one input table; extra columns never reach an operator."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def text_col(name: str = "text") -> F.Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``. Only where the session names
    none (local tests) is a folder of our own registered."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        import tempfile
        named = tempfile.mkdtemp(prefix="oddsframe-llm-")
        spark.sparkContext.setCheckpointDir(named)
    return named


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/oddsframe-{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage, so a lost
    executor costs a re-read, and later passes see the same rows."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    schema = df.schema
    df.write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def ship_package(spark: SparkSession) -> None:
    """Hand this package to the Python workers once per session, so that they find it wherever
    they start (the same as ``--py-files`` at submission)."""
    sc = spark.sparkContext
    if getattr(sc, "_oddsframe_shipped", False):
        return
    import shutil
    import tempfile
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    to = os.path.join(tempfile.mkdtemp(prefix="oddsframe-py-"), "oddsframe")
    sc.addPyFile(shutil.make_archive(to, "zip", root, "oddsframe"))
    sc._oddsframe_shipped = True


def tokenizer_file(name: str, folder: str | None = None) -> str:
    """Place of a public vocabulary file: ``folder`` if given, else that of the installed
    ``public_tokenizers`` package, else the default folder."""
    if folder:
        return os.path.join(folder, name)
    try:
        import public_tokenizers
    except ImportError:
        return os.path.join(TOKENIZER_DIR, name)
    return public_tokenizers.path(name)
