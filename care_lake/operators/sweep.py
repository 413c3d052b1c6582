"""One pass over many kinds of events in the order of their time.

Two ways to split the pass. ``counted_before`` sorts everything by range, so the busiest key or instant is no more than its
share of the rows; it answers how many rows come before. ``spread`` puts events into chunks of time per key, together with
what an anchor of the chunk can look back or ahead at; then any number of windows over (key, chunk) share one shuffle and
one sort.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from care_lake.session import staged


def counted_before(rows: DataFrame, order: Sequence[str], counted: str, out: str) -> DataFrame:
    """Add the sum of ``counted`` over all rows before, in the order of ``order``; equal rows follow each other in any order.

    Windows hold one range of the sort each, or one row per range.
    """
    ranged = rows.withColumn("_row", F.monotonically_increasing_id()).repartitionByRange(*order, "_row")
    ranged = ranged.sortWithinPartitions(*order, "_row").withColumns({"_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id()})
    kept = staged(ranged.drop("_row"), "sweep")
    before = Window.partitionBy("_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    parts_before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = kept.groupBy("_part").agg(F.sum(counted).alias("_n")).select("_part", F.coalesce(F.sum("_n").over(parts_before), F.lit(0)).alias("_earlier"))
    within = kept.withColumn("_within", F.coalesce(F.sum(counted).over(before), F.lit(0)))
    return within.join(parts, "_part").withColumn(out, F.col("_within") + F.col("_earlier")).drop("_part", "_at", "_within", "_earlier")


def chunk_of(at: Column, width: int) -> Column:
    """Start of the chunk that holds a time."""
    return at - F.pmod(at, F.lit(width))


def spread(events: DataFrame, at: str, width: int, back: int = 0, ahead: int = 0) -> DataFrame:
    """A row for every chunk whose anchors can reach the event: they look ``back`` to it, or ``ahead``; ``chunk`` is added."""
    x = F.col(at)
    return events.withColumn("chunk", F.explode(F.sequence(chunk_of(x - ahead, width), chunk_of(x + back, width), F.lit(width))))
