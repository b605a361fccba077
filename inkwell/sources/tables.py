"""Parquet tables by name, and the schemas of the engine's own tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# As DDL, which readers take as it is; importing this needs no session.
JOBS = "seq BIGINT, reference_id BIGINT, reference_curie STRING, topic_id STRING, mod_id BIGINT, reference_workflow_tag_id BIGINT"
REF_FILES = "curie STRING, seq BIGINT, referencefile_id BIGINT, file_class STRING, file_extension STRING, file_publication_status STRING, referencefile_mods ARRAY<STRUCT<mod_abbreviation: STRING>>, profile_name STRING, version INT, source STRUCT<file_class: STRING>"
SECTIONS = "curie STRING, ord INT, section STRING, text STRING, is_supplement BOOLEAN"
CHUNKS = "curie STRING, seq INT, embedding ARRAY<FLOAT>, is_document_level BOOLEAN, content STRING"
WORD_VECTORS = "word STRING, idx INT, vec ARRAY<FLOAT>"
CURATED = "mod STRING, entity_type STRING, name STRING, curie STRING, taxon STRING"
TAGS = "reference_curie STRING, topic STRING, species STRING, entity STRING, entity_type STRING, negated BOOLEAN, data_novelty STRING, confidence_score DOUBLE, confidence_level STRING, note STRING"
JOB_EVENTS = "job_id BIGINT, seq BIGINT, status STRING"
MODELS = "mod_id BIGINT, topic_id STRING, ml_model_id BIGINT, negated BOOLEAN, species STRING, data_novelty STRING, embedding_profile STRING, embedding_version INT"
