"""Distinct counts that can be added up: bitmaps of dense numbers, kept per cell of a cube.

A cell holds one bitmap of 4 KB for each 32,768 numbers that occur in it. Cells are united bit by bit, so the distinct count of
any set of cells is exact and needs no look at the rows they were made from. A bitmap with few bits compresses to a few bytes
in a file. Rows whose key is NULL are counted nowhere, as in ``count(distinct key)``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from care_lake.operators.score import global_rank


def numbered(df: DataFrame, key: str, out: str) -> DataFrame:
    """Each distinct key with a number from 1, without gaps, so that bitmaps of all keys are as small as they can be."""
    return global_rank(df.select(key).where(F.col(key).isNotNull()).distinct(), [F.col(key).asc()], out)


def presence(df: DataFrame, cell: Sequence[str], key: str) -> DataFrame:
    """The keys seen in each cell: ``cell``, ``bucket`` and ``present``.

    Repeated keys of a cell go before the join, so a key that owns a third of all rows meets its number once for each cell.
    """
    seen = df.where(F.col(key).isNotNull()).select(*cell, key).distinct()
    placed = seen.join(numbered(df, key, "_number"), key).withColumn("bucket", F.bitmap_bucket_number("_number"))
    return placed.groupBy(*cell, "bucket").agg(F.bitmap_construct_agg(F.bitmap_bit_position("_number")).alias("present"))


def united(cells: DataFrame, by: Sequence[str]) -> DataFrame:
    """Cells of a coarser cube."""
    return cells.groupBy(*by, "bucket").agg(F.bitmap_or_agg("present").alias("present"))


def distinct_keys(cells: DataFrame, by: Sequence[str], out: str) -> DataFrame:
    """The number of distinct keys per group; without groups and cells it is NULL."""
    return united(cells, by).groupBy(*by).agg(F.sum(F.bitmap_count("present")).alias(out))
