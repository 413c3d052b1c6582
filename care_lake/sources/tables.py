"""Tables of the lake: parquet folders, replaced as a whole by each build."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def table_path(root: str, layer: str, name: str) -> str:
    return f"{root}/{layer}/{name}"


def write_table(
    df: DataFrame, root: str, layer: str, name: str, cluster_by: Sequence[str] = (), partition_by: Sequence[str] = (),
    find_by: Sequence[str] = (),
) -> DataFrame:
    """Replace a table and return it as read back from its files.

    ``cluster_by`` sorts each file by columns that queries filter on, so that row groups can be
    skipped; it adds no shuffle. ``partition_by`` makes one folder per value and is meant for
    columns with few values. ``find_by`` adds bloom filters for columns that reports look up by value.
    """
    out = df.sortWithinPartitions(*cluster_by) if cluster_by else df
    path = table_path(root, layer, name)
    blooms = {f"parquet.bloom.filter.enabled#{c}": "true" for c in find_by}
    out.write.mode("overwrite").options(**blooms).partitionBy(*partition_by).parquet(path)
    return read_table(df.sparkSession, root, layer, name)


def read_table(spark: SparkSession, root: str, layer: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(root, layer, name))
