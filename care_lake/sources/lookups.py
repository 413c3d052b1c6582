"""Lookup tables: small CSV files that are replaced, never appended to."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from care_lake.fixed import LOOKUP_ROOT, LOOKUPS


def read_lookup(spark: SparkSession, path: str) -> DataFrame:
    """All columns as text, so that codes keep leading zeros."""
    return spark.read.csv(path, header=True, inferSchema=False, escape='"').withColumn(
        "_source_file", F.col("_metadata.file_path")
    )


def read_lookups(spark: SparkSession, landing_root: str) -> dict[str, DataFrame]:
    return {
        name: read_lookup(spark, f"{landing_root}/{LOOKUP_ROOT}/{folder}") for name, folder in LOOKUPS.items()
    }
