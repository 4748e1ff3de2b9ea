"""Model registry table: one row per (league, window, model) in a fixed schema.

Written as parquet into a shared folder (the cluster's checkpoint folder by default)
and read back with the explicit schema; replaces per-league pickled artefacts."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from oddsframe.session import checkpoint_dir

REGISTRY_SCHEMA = T.StructType([
    T.StructField("event_type_id", T.IntegerType()),
    T.StructField("season_start", T.IntegerType()),
    T.StructField("window_no", T.IntegerType()),
    T.StructField("window_label", T.StringType()),
    T.StructField("model_name", T.StringType()),
    T.StructField("feature_cols", T.ArrayType(T.StringType())),
    T.StructField("mean", T.ArrayType(T.DoubleType())),
    T.StructField("scale", T.ArrayType(T.DoubleType())),
    T.StructField("coef", T.ArrayType(T.DoubleType())),
    T.StructField("intercept", T.DoubleType()),
    T.StructField("threshold", T.DoubleType()),
    T.StructField("trained_n", T.LongType()),
])

_TREE = T.StructType([T.StructField("feature", T.ArrayType(T.IntegerType())), T.StructField("threshold", T.ArrayType(T.DoubleType())),
                      T.StructField("value", T.ArrayType(T.DoubleType()))])
# one row per window for a model of any family: linear ones fill coef and intercept, tree ones trees (boosted ones base and rate too)
MODEL_SCHEMA = T.StructType([
    *REGISTRY_SCHEMA.fields,
    T.StructField("parameters", T.StringType()),
    T.StructField("cv_accuracy", T.DoubleType()),
    T.StructField("trees", T.ArrayType(_TREE)),
    T.StructField("base", T.DoubleType()),
    T.StructField("rate", T.DoubleType()),
])


def write_registry(df: DataFrame, path: str, schema: T.StructType = REGISTRY_SCHEMA) -> str:
    df.select(*[f.name for f in schema.fields]).write.mode("overwrite").parquet(path)
    return path


def read_registry(spark: SparkSession, path: str, schema: T.StructType = REGISTRY_SCHEMA) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def shared_registry_path(spark: SparkSession) -> str:
    return f"{checkpoint_dir(spark)}/registry-{uuid.uuid4().hex}"
