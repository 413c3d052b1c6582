"""What lies in the landing folders: lineage columns, scope and file profile."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from care_lake.fixed import UNLANDED_RESOURCES
from care_lake.functions.clean import path_key

RESCUED = "_rescued_data"


def csv_lineage() -> dict[str, Column]:
    """Run, file, file time and load time of a CSV row."""
    path = F.col("_metadata.file_path")
    return {
        "_run_id": path_key(path, "run_id", empty_as_null=False),
        "_source_file": path,
        "_source_file_modified_at": F.col("_metadata.file_modification_time"),
        "_ingested_at": F.current_timestamp(),
    }


def resource_lineage(source_system: str) -> dict[str, Column]:
    path = F.col("_metadata.file_path")
    return {
        "source_system": F.lit(source_system),
        "run_id": path_key(path, "run_id"),
        "extract_date": path_key(path, "extract_date", "date"),
        "source_file": path,
        "source_file_modified_at": F.col("_metadata.file_modification_time"),
        "ingested_at": F.current_timestamp(),
    }


def csv_columns(spark: SparkSession, path: str, glob: str = "*.csv") -> list[str]:
    """Column names of the header; only the first line of a file is read."""
    return spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", glob).option("header", True).csv(path).columns


def in_scope(resources: DataFrame, skip: Sequence[str] = UNLANDED_RESOURCES) -> DataFrame:
    """Resources that take part in the analysis; rows without a type are kept for the checks."""
    return resources.filter(F.col("resource_type").isNull() | ~F.col("resource_type").isin(*skip))


def not_landed(spark: SparkSession, expected: Sequence[str], landed: DataFrame, name: str) -> DataFrame:
    """Expected names that no landed row carries."""
    wanted = spark.createDataFrame([(e,) for e in expected], f"{name} string")
    return wanted.join(landed.select(name).distinct(), name, "left_anti")


def profile_landing(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """Lines and bytes of every file below a folder."""
    lines = (
        spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", glob).text(path)
        .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes"))
    )
    return lines.groupBy("file").agg(F.count("*").alias("lines"), F.max("bytes").alias("bytes"))


def class_mix(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), column)
