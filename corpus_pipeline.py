"""A training corpus from raw documents, in five stages.

Each stage is a function of (spark, docs, sf_dir) that works on all documents
its predecessor kept; between stages the documents are written as Parquet, so
a lost executor costs at most part of a stage.

quality       rejects documents by rules and a calibrated classifier (7)
near_dup      keeps the smallest id of each near-duplicate component (10)
pii           replaces personal data by its kind (6)
mixing        takes whole documents of each source towards its target (3)
packing       packs the token ids into sequences (1); its rows are the result

No stage can be said in SQL as a whole (trained models, tokenizers, hashing),
so the pipeline has no oracle; ``tests/llm/test_pipeline.py`` holds each stage
against a plain version.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from inkwell.llm import common, mixing, near_dup, packing, pii, quality

ORACLE_SQL = None
#: Similarity in percent from which documents are near copies; 85 is op10's own threshold.
NEAR_PERCENT = 80


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.kept_documents(docs, quality.quality_model(docs, common.labels(spark, sf_dir)))


def near_dup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dup.unique_documents(docs, percent=NEAR_PERCENT)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redact(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality_stage),
    ("near_dup", near_dup_stage),
    ("pii", pii_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for the documents of ``sf_dir``.

    Stages are written to the cluster's shared checkpoint folder.
    """
    docs = common.documents(spark, sf_dir)
    folder = f"{common.shared_folder(spark)}/corpus-pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
