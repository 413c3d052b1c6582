"""Sharding by proportional stratified interleaving.

Within a source, rows get a rank by a seeded hash. The rank as a share of the source's rows orders all rows
together, so any stretch of that order holds the sources in their overall mixture; equal cuts make the shards.
Ranks come from range-partitioned, sorted rows plus the sizes of the partitions before, so a source that holds
a third of all rows is ranked by as many tasks as its size asks for.

Defined cases: a null source is a source of its own; a null text counts as empty; repeated rows get a place
each; with fewer rows than shards some shards stay empty; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from care_lake.llm.common import numbered
from care_lake.session import staged


def _ranked(df: DataFrame) -> DataFrame:
    """``rank`` of a row within its source, from 0, and ``total``, the rows of that source."""
    rows = staged(numbered(df, "source", "dealt", "tie"), "shard-ranks")
    runs = rows.groupBy("part", "source").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    before = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        F.col("part").alias("run_part"), F.col("source").alias("run_source"), "first",
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"),
        F.sum("n").over(Window.partitionBy("source")).alias("total"),
    )
    both = rows.join(runs, (F.col("part") == F.col("run_part")) & F.col("source").eqNullSafe(F.col("run_source")))
    return both.withColumn("rank", F.expr("before + at - first")).drop("run_part", "run_source", "first", "before", "part", "at")


def interleaved_shards(docs: DataFrame, n_shards: int = 40, seed: int = 7, id_col: str = "doc_id",
                       text_col: str = "text", source_col: str = "source", carry: tuple[str, ...] = ()) -> DataFrame:
    """Place every row: ``doc_id, source, size, text_crc32, fraction, shard, slot`` and the columns in ``carry``.

    Shards differ by one row at most. ``carry`` takes further columns, such as the text, along to the shards.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    df = docs.select(
        F.struct(*[F.col(c) for c in carry]).alias("carried") if carry else F.lit(None).cast("string").alias("carried"),
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
        (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    df = df.withColumn("dealt", F.xxhash64(F.lit(seed), "doc_id", "text_crc32", "size"))
    df = df.withColumn("tie", F.struct("doc_id", "text_crc32", "size"))
    ranked = _ranked(df).withColumn("fraction", F.expr("(2 * rank + 1) / (2 * total)"))
    rows = staged(numbered(ranked.drop("tie", "dealt", "total"), "fraction", "source", "rank"), "shard-order")
    order = Window.orderBy("part")  # a row for each partition
    parts = rows.groupBy("part").agg(F.count("*").alias("n")).select(
        F.col("part").alias("p"), (F.sum("n").over(order) - F.col("n")).alias("before"), F.sum("n").over(Window.partitionBy()).alias("total"),
    )
    placed = rows.join(parts, F.col("part") == F.col("p")).withColumn("place", F.expr("before + at"))
    placed = placed.withColumn("shard", F.expr(f"place * {n_shards} div total").cast("int"))
    placed = placed.withColumn("slot", F.expr(f"place - (shard * total + {n_shards - 1}) div {n_shards}"))
    own = ["doc_id", "source", "size", "text_crc32", "fraction", "shard", "slot"]
    return placed.select(*own, *[F.col("carried")[c].alias(c) for c in carry if c not in own])


def write_shards(docs: DataFrame, path: str, n_shards: int = 40, seed: int = 7, **columns: str) -> None:
    """Write the rows of ``docs`` to a folder per shard, each in the order of its slots."""
    carry = tuple(c for c in docs.columns if c not in columns.values())
    placed = interleaved_shards(docs, n_shards, seed, carry=carry, **columns)
    placed.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
