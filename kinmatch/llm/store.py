"""Tables kept between jobs, in the folder that all executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..sources.staging import drop, shared_dir, staged, tidy

__all__ = ["drop", "materialize", "shared_dir", "table", "tidy"]


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Writes df as Parquet to the shared folder and reads it back: cuts the lineage, and survives lost executors."""
    return staged(df, name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
