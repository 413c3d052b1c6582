"""Spark session settings and the shared folder for data that cuts lineage."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(app: str = "care_lake", **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def _configured_folder(spark: SparkSession) -> str | None:
    return spark.conf.get("spark.checkpoint.dir", None)


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; where that is unset, a folder in the warehouse.

    Both are reached by every executor of a cluster, so a lost one never takes results along.
    """
    folder = _configured_folder(spark) or spark.conf.get("spark.sql.warehouse.dir") + "/_shared"
    return folder.rstrip("/")


SPLIT = "spark.sql.files.maxPartitionBytes"
DEFAULT_SPLIT, SORTED_SPLIT = "134217728b", "16m"


@contextmanager
def sorted_splits(spark: SparkSession) -> Iterator[None]:
    """Read files in splits whose rows a task can sort in memory; a session's own setting is kept.

    A split of the default size holds ten million rows of a dense table. Choosing the newest copies sorts them where they are
    read, as wide text, which spills once the input is large enough for such splits.
    """
    if spark.conf.get(SPLIT) != DEFAULT_SPLIT:
        yield
        return
    spark.conf.set(SPLIT, SORTED_SPLIT)
    try:
        yield
    finally:
        spark.conf.unset(SPLIT)


def staged(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write an intermediate result once and read it back.

    Use for results with several readers: the work is not repeated, a lost executor only repeats a
    file read, and the file sizes let Spark choose broadcast or shuffle joins from a known size.
    ``compression`` names another codec than the session's.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/stages/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)
