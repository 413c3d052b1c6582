"""Rank-based tiers, global ranks and plain-language reasons."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from care_lake.session import staged


def score_ranks(df: DataFrame, score: str) -> DataFrame:
    """Percent rank of every distinct score, highest first, NULL last.

    The rank of a row is (rows with a higher score) / (rows - 1). Rows are counted per score, the scores sorted in
    ranges and written; the rows above a score are those above it in its range plus those of the ranges before.
    So a score that is different in nearly every row is ranked by as many tasks as any sort.
    """
    highest = F.col(score).desc_nulls_last()
    counts = df.groupBy(score).agg(F.count("*").alias("rows"))
    ranges = counts.repartitionByRange(highest).withColumn("_range", F.spark_partition_id())
    ordered = staged(ranges, "score_ranges")
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    sizes = ordered.groupBy("_range").agg(F.sum("rows").alias("_n")).select(
        F.col("_range"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"), F.sum("_n").over(Window.partitionBy()).alias("_total")
    )
    inside = Window.partitionBy("_range").orderBy(highest).rowsBetween(Window.unboundedPreceding, -1)
    above = F.col("_before") + F.coalesce(F.sum("rows").over(inside), F.lit(0))
    return ordered.join(sizes, "_range").select(
        score, "rows", F.when(F.col("_total") > 1, above / (F.col("_total") - 1)).otherwise(F.lit(0.0)).alias("percentile_from_top")
    )


def values_at(counts: DataFrame, value: str, rows: str, places: Sequence[int], bins: int = 1024) -> list:
    """The value at each place from the top (0 is the highest), from the number of ``rows`` per ``value``; None where there is none.

    Nothing is sorted. Each round counts the rows in equal bins of the range that a place is known to lie in and goes on with
    the values of one bin, until that bin holds a single value. A round brings back at most ``bins`` + 3 rows a place. NaN
    counts as the highest value, NULL is left out.
    """
    type_name, kind = dict(counts.dtypes)[value], counts.schema[value].dataType
    floating = type_name in ("double", "float")
    exact = f"decimal(38,{type_name[8:-1].split(',')[1]})" if type_name.startswith("decimal") else "decimal(38,0)"
    number, weight = F.col(value), F.col(rows)

    def distance(high: Column, low: Column, wide: bool) -> Column:
        """Halved where the range is wide, so that it does not overflow; never 0 for values that differ."""
        if floating:
            return high / 2 - low / 2 if wide else high - low
        return (high.cast(exact) - low.cast(exact)).cast("double")

    def bin_in(low, high) -> Column:
        least, most = F.lit(low), F.lit(high)
        wide = floating and max(abs(low), abs(high)) > 1e300
        share = F.lit(0.0) if low == high else distance(number.cast("double") if floating else number, least, wide) / distance(most, least, wide)
        inner = F.when(number.between(least, most), F.least(F.floor(share * bins), F.lit(bins - 1)).cast("int"))
        if not floating:
            return inner
        return F.when(F.isnan(number), bins + 1).when(number == float("inf"), bins).when(number == float("-inf"), -1).otherwise(inner)

    plain = number if not floating else F.when(~F.isnan(number) & (F.abs(number) != float("inf")), number)
    low, high = counts.agg(F.min(plain), F.max(plain)).first()
    found, above = {}, {i: 0 for i, _ in enumerate(places)}
    ranges = {i: (low, high) for i in above}
    first = True
    while ranges:
        parts = []
        for i, (least, most) in ranges.items():
            place = bin_in(least, most) if least is not None else bin_in(0.0, 0.0) if floating else F.lit(None).cast("int")
            own = place if first else F.when(number.between(F.lit(least).cast(kind), F.lit(most).cast(kind)), place)
            parts.append(F.struct(F.lit(i).alias("i"), own.alias("bin")))
        dealt = counts.select(value, rows, F.explode(F.array(*parts)).alias("_part")).where("_part.bin is not null")
        sums = dealt.groupBy("_part").agg(F.sum(weight).alias("n"), F.min(value).alias("low"), F.max(value).alias("high")).collect()
        for i in list(ranges):
            del ranges[i]
            for r in sorted((r for r in sums if r["_part"]["i"] == i), key=lambda r: -r["_part"]["bin"]):
                if above[i] + r["n"] <= places[i]:
                    above[i] += r["n"]
                    continue
                if r["low"] == r["high"] or r["_part"]["bin"] > bins:
                    found[i] = r["high"]
                else:
                    ranges[i] = (r["low"], r["high"])
                break
        first = False
    return [found.get(i) for i in range(len(places))]


def percentile_tier(
    df: DataFrame, score: str, cuts: Sequence[tuple[str, float]], lowest: str, out: str
) -> DataFrame:
    """Tier by percent rank from the top; equal scores share a tier.

    The rank falls as the score rises, so each cut is the lowest score still inside it: a single
    value per tier, found without a sort and applied to the rows without joining them.
    """
    counts = staged(df.groupBy(score).agg(F.count("*").alias("_rows")), "score_counts")
    scored, total = counts.agg(F.sum(F.when(F.col(score).isNotNull(), F.col("_rows"))), F.sum("_rows")).first()
    scored, total = scored or 0, total or 0

    def rank(above: int) -> float:
        return above / (total - 1) if total > 1 else 0.0

    def inside(cut: float) -> int:
        """How many numbers of rows above, from 0, have a rank below the cut."""
        n = min(max(int(cut * (total - 1)), 0), total)
        while n < total and rank(n) < cut:
            n += 1
        while n > 0 and rank(n - 1) >= cut:
            n -= 1
        return n

    sizes = [min(inside(cut), scored) for _, cut in cuts]
    floors = values_at(counts, score, "_rows", [n - 1 for n in sizes if n])
    kind = df.schema[score].dataType
    value, tier, missing = F.col(score), F.lit(lowest), lowest
    held = iter(floors)
    least = [next(held) if n else None for n in sizes]
    for (label, cut), floor in reversed(list(zip(cuts, least))):
        if floor is not None:
            tier = F.when(value >= F.lit(floor).cast(kind), label).otherwise(tier)
        missing = label if rank(scored) < cut else missing
    return df.withColumn(out, F.when(value.isNull(), F.lit(missing)).otherwise(tier))


def global_rank(df: DataFrame, order: Sequence[Column], out: str) -> DataFrame:
    """Number the rows 1..n over the whole table without pulling them into one task.

    ``order`` must be total. The rows are sorted in ranges and written with their place; a row's number is its place in its range plus the size
    of the ranges before it.
    """
    # monotonically_increasing_id puts the partition above bit 33 and the row number below it
    place = staged(df.orderBy(*order).withColumn("_place", F.monotonically_increasing_id()), "global_rank")
    place = place.withColumn("_range", F.shiftright("_place", 33)).withColumn(
        "_row", F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    )
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = (
        place.groupBy("_range")
        .agg(F.count("*").alias("_n"))
        .select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    )
    return (
        place.join(sizes, "_range")  # sizes has a row per partition of the sort
        .withColumn(out, (F.col("_before") + F.col("_row") + 1).cast("long"))
        .drop("_place", "_range", "_row", "_before")
    )


def top_reasons(reasons: Sequence[tuple[Column, Column]], n: int = 3) -> Column:
    """Text of the n largest (points, reason) pairs; pairs without points are left out.

    Equal points keep the order in which they were given.
    """
    pairs = F.array(*[
        F.struct((-points).alias("rank"), F.lit(i).alias("place"), points.alias("points"), reason.alias("reason"))
        for i, (points, reason) in enumerate(reasons)
    ])
    scored = F.array_sort(F.filter(pairs, lambda x: x["points"] > 0))
    texts = F.transform(scored, lambda x: F.concat(x["reason"], F.lit(" (+"), x["points"], F.lit(")")))
    return F.array_join(F.slice(texts, 1, n), "; ")
