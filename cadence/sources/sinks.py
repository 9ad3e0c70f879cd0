"""Result sink and load (S-4, S-5): Parquet tables and MLlib model folders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.errors import AnalysisException


def save_result(df: DataFrame, path: str, partition_by: list[str] | None = None) -> str:
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def load_result(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.parquet(path)
    except AnalysisException as exc:
        raise FileNotFoundError(
            f"result table not found at {path!r}; run the pipeline first") from exc


def save_model(model, path: str) -> str:
    model.write().overwrite().save(path)
    return path
