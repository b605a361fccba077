"""Fitted models as folders: the model itself beside a JSON record of its statistics."""

from __future__ import annotations

import json
from typing import Any

from pyspark.ml import PipelineModel, Transformer
from pyspark.sql import SparkSession


def save_model(model: Transformer, path: str, stats: dict[str, Any]) -> None:
    """Write ``model`` and ``stats`` below ``path``, in place of what is there."""
    spark = SparkSession.getActiveSession()
    whole = model if isinstance(model, PipelineModel) else PipelineModel([model])
    whole.write().overwrite().save(f"{path}/model")
    spark.createDataFrame([(json.dumps(stats),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/stats")


def load_model(spark: SparkSession, path: str) -> tuple[PipelineModel, dict[str, Any]]:
    """The model and statistics that ``save_model`` wrote; a folder without them is an error."""
    return PipelineModel.load(f"{path}/model"), json.loads(spark.read.text(f"{path}/stats").first()[0])
