"""Dates: keys, ages, bands and calendar tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from care_lake.functions.clean import ColumnOrName, as_col
from care_lake.settings import Period

AGE_BANDS = ((18, "0-17"), (45, "18-44"), (65, "45-64"), (75, "65-74"))
OLDEST_BAND = "75+"


def date_key(c: ColumnOrName) -> Column:
    """yyyymmdd as INT, the join key between every fact and the calendar."""
    return F.date_format(as_col(c), "yyyyMMdd").cast("int")


def month_of(c: ColumnOrName) -> Column:
    return F.trunc(as_col(c), "MM")


def age_at(birth: ColumnOrName, on: ColumnOrName) -> Column:
    """Completed years between birth and a day."""
    return F.floor(F.months_between(as_col(on), as_col(birth)) / 12)


def age_as_of(birth: ColumnOrName, death: ColumnOrName, period: Period) -> Column:
    """Age on the as-of day, or at death when that came first."""
    return age_at(birth, F.least(period.as_of_col, as_col(death)))


def age_band(age: ColumnOrName) -> Column:
    years = as_col(age)
    out = None
    for upper, label in AGE_BANDS:
        out = F.when(years < upper, label) if out is None else out.when(years < upper, label)
    return out.otherwise(OLDEST_BAND)


def month_spine(spark: SparkSession, period: Period) -> DataFrame:
    """One row per month of the analysis period."""
    months = F.sequence(period.start_col, period.as_of_col, F.expr("interval 1 month"))
    return spark.range(1).select(F.explode(months).alias("month_start"))


def date_dim(spark: SparkSession, period: Period, first: date = date(1900, 1, 1), last: date = date(2027, 12, 31)):
    """One row per calendar day."""
    days = spark.range(1).select(F.explode(F.sequence(F.lit(first), F.lit(last))).alias("date"))
    return describe_days(days, period)


def describe_days(days: DataFrame, period: Period) -> DataFrame:
    d = F.col("date")
    return days.select(
        date_key(d).alias("date_key"),
        d,
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.concat(F.year(d), F.lit("-Q"), F.quarter(d)).alias("year_quarter"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        month_of(d).alias("month_start"),
        F.date_format(d, "yyyy-MM").alias("year_month"),
        F.dayofweek(d).alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        period.contains(d).alias("is_in_analysis_period"),
    )


def auto_calendar(df: DataFrame, column: str) -> DataFrame:
    """Calendar that spans the full years touched by a date column."""
    span = df.agg(F.min(column).cast("date").alias("lo"), F.max(column).cast("date").alias("hi"))
    days = span.filter("lo is not null").select(
        F.explode(
            F.sequence(F.trunc("lo", "YEAR"), F.date_sub(F.add_months(F.trunc("hi", "YEAR"), 12), 1))
        ).alias("date")
    )
    d = F.col("date")
    return days.select(
        d,
        F.year(d).alias("year"),
        F.month(d).alias("month_no"),
        F.date_format(d, "MMMM").alias("month"),
        F.quarter(d).alias("quarter_no"),
        F.concat(F.lit("Qtr "), F.quarter(d)).alias("quarter"),
        F.dayofmonth(d).alias("day"),
    )
