"""Corpus pipeline over ``documents``: toxicity filter, quality filter, near-duplicate removal, packing.

Each stage is ``(spark, docs, sf_dir) -> DataFrame`` over whole texts and all that the stage before kept; its result
is written as Parquet and read again as the next stage's documents. All but the last return the columns of
``documents``. The filters learn only from label rows that their operators' queries may learn from
(crc32 of the id). Null texts and ids, repeated rows and empty tables are handled as the operators say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oddsframe.llm import packing, quality_pu, simhash_bktree, toxicity_knn
from oddsframe.llm.common import materialise, read_table, ship_package, tokenizer_file
from oddsframe.llm.queries import remainder

TOXIC, GOOD = 0.7, 0.3  # scores from which a document is toxic, and of quality


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the nearest labelled examples do not call toxic."""
    ship_package(spark)
    labels = read_table(spark, sf_dir, "labels", "doc_id", "toxic").filter(remainder(3) != 1)
    scored = toxicity_knn.score(docs, toxicity_knn.fit(docs, labels))
    return scored.filter(F.col("_toxicity.score") < TOXIC).select(*docs.columns)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the positive-unlabelled classifier calls good."""
    ship_package(spark)
    labels = read_table(spark, sf_dir, "labels", "doc_id", "quality").filter(remainder(5) != 0)
    scored = quality_pu.score(docs, quality_pu.fit(docs, labels))
    return scored.filter(F.col("_quality") >= GOOD).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (3-word shingles, at most 3 bits)."""
    ship_package(spark)
    return simhash_bktree.representatives(docs, 3, 3)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the kept documents in sequences of at most 4096 tokens."""
    ship_package(spark)
    return packing.pack(docs, tokenizer_file("word_bpe_49k.json"), end_id=2, width=4096, with_ids=False).drop("ids")


STAGES = [("toxicity", toxicity), ("quality", quality), ("near_dedup", near_dedup), ("packing", pack)]

# Learned filters and fingerprints have no SQL form; tests hold the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
