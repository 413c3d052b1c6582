"""Intervals spread over calendar months."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from care_lake.functions.calendar import month_of
from care_lake.settings import Period


def explode_months(df: DataFrame, start: str, end: str, period: Period, out: str = "month_start") -> DataFrame:
    """One row per month an interval touches inside the period; an open end runs to the as-of day.

    The interval is clipped first, so the number of rows made is limited by the period. Intervals
    that end before they start give no rows.
    """
    last = F.coalesce(F.col(end), period.as_of_col)
    first_month = F.greatest(month_of(start), month_of(period.start_col))
    last_month = F.least(month_of(last), month_of(period.as_of_col))
    return (
        df.filter(F.col(start).isNotNull())
        .withColumns({"_from": first_month, "_to": last_month})
        .filter((F.col("_from") <= F.col("_to")) & (month_of(F.col(start)) <= month_of(last)))
        .withColumn(out, F.explode(F.sequence("_from", "_to", F.expr("interval 1 month"))))
        .drop("_from", "_to")
    )


def active_per_month(
    visits: DataFrame, people: DataFrame, *, key: str, day: str, alive_from: str, alive_to: str, lookback: int,
    period: Period, out: str,
) -> DataFrame:
    """People per month who were born, alive and seen in that month or the ``lookback`` months before.

    A visit keeps its person active for ``lookback`` more months or until the next visit takes over.
    Those stretches do not overlap, so +1 at their first and -1 after their last month, summed over
    all people, give the monthly counts: no person is copied into every month.
    """
    months = visits.select(key, month_of(day).alias("_month")).dropna().distinct()
    following = Window.partitionBy(key).orderBy("_month")
    stretch = months.withColumn("_next", F.lead("_month").over(following)).withColumn(
        "_until", F.least(F.add_months("_month", lookback + 1), F.col("_next"))
    )
    born = F.col(alive_from)
    first_full_month = F.when(F.dayofmonth(born) == 1, born).otherwise(F.add_months(month_of(born), 1))
    alive = people.filter(F.col(alive_from).isNotNull()).select(
        key, first_full_month.alias("_born"), F.add_months(month_of(alive_to), 1).alias("_gone")
    )
    month_after = F.add_months(month_of(period.as_of_col), 1)
    changes = (
        stretch.join(alive, key)
        .select(
            F.greatest("_month", "_born", period.start_col).alias("_from"),
            F.least("_until", "_gone", month_after).alias("_until"),
        )
        .filter("_from < _until")
        .select(F.inline(F.array(
            F.struct(F.col("_from").alias("month_start"), F.lit(1).alias("_step")),
            F.struct(F.col("_until").alias("month_start"), F.lit(-1).alias("_step")),
        )))
        .groupBy("month_start")
        .agg(F.sum("_step").alias("_step"))
    )
    # at most one row per month of the period from here on
    running = Window.orderBy("month_start")
    spine = visits.sparkSession.range(1).select(
        F.explode(F.sequence(period.start_col, period.as_of_col, F.expr("interval 1 month"))).alias("month_start")
    )
    return (
        spine.join(changes, "month_start", "left")
        .select("month_start", F.sum(F.coalesce("_step", F.lit(0))).over(running).alias(out))
        .filter(F.col(out) > 0)
    )
