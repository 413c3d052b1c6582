"""Choosing one row per key, and uniting sources.

All pickers filter ``row_number() == 1``. Spark turns that into a group limit that runs before the
shuffle, so each map task sends at most one row per key: a key with many copies stays cheap.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RANK = "_rank"


def pick_best(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int = 1) -> DataFrame:
    """The first n rows per key in the given order (nulls of a key form a group of their own)."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(RANK, F.row_number().over(window)).filter(F.col(RANK) <= n).drop(RANK)


LOAD_COLUMNS = (
    "_ingested_at", "ingested_at", "_source_file_modified_at", "source_file_modified_at", "_source_file", "source_file",
)
OTHER_LINEAGE = ("_run_id", "run_id", "extract_date")


def load_order(df: DataFrame) -> list[Column]:
    """Newest load first. Copies from one load are told apart by file and, last, by content.

    The content hash leaves lineage out, so loading the same file again picks the same copy.
    """
    content = [c for c in df.columns if c not in (*LOAD_COLUMNS, *OTHER_LINEAGE)]
    return [F.col(c).desc() for c in LOAD_COLUMNS if c in df.columns] + [F.xxhash64(*content)]


def latest_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column] | None = None) -> DataFrame:
    """Newest copy of each business key."""
    return pick_best(df, keys, order or load_order(df))


def union_sources(*sources: DataFrame) -> DataFrame:
    """Union by name. Columns a source does not have become NULL of the type the others use."""
    out = sources[0]
    for s in sources[1:]:
        out = out.unionByName(s, allowMissingColumns=True)
    return out


def asof_interval(
    df: DataFrame, key: str, start: str, end: str, as_of: Column, tie: Sequence[str] = ()
) -> DataFrame:
    """Per key the interval that holds a day; when none does, the one that started last before it."""
    covers = F.col(end).isNull() | (F.col(end) >= as_of)
    order = [covers.desc(), F.col(start).desc(), *[F.col(c).asc_nulls_last() for c in tie]]
    return pick_best(df.filter(F.col(start) <= as_of), [key], order)


def dedup_resources(df: DataFrame, order: Sequence[Column] | None = None) -> DataFrame:
    """One resource per type and id, the last one wins."""
    return latest_by(df, ["resource_type", "resource_id"], order)


def count_by_type(df: DataFrame) -> DataFrame:
    return df.groupBy("resource_type").agg(F.count("*").alias("resources"))
