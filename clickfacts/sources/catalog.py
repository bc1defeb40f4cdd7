"""Product and user catalogs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from clickfacts import schemas


def write_catalog(df: DataFrame, path: str) -> None:
    """JSON lines, uncompressed, replaced on every run."""
    df.write.mode("overwrite").option("compression", "none").json(path)


def read_products(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.PRODUCT_CATALOG).json(path)


def read_users(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.USER_CATALOG).json(path)
