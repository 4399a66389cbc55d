"""Stored models and scaler bounds."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def save_scaler(scaler: DataFrame, path: str) -> None:
    scaler.coalesce(1).write.mode("overwrite").parquet(path)


def load_scaler(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("col string, lo double, hi double").parquet(path)
