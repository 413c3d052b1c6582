"""Reporting period and the cut-offs the clinical definitions use."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Period:
    """The two clocks of every report: first day of the analysis period and the as-of day."""

    start: date = date(2021, 9, 1)
    as_of: date = date(2026, 8, 31)

    def __post_init__(self):
        if self.start.day != 1:
            raise ValueError("the analysis period must start on the first day of a month")
        if self.as_of < self.start:
            raise ValueError("as_of lies before the start of the analysis period")

    @property
    def start_col(self) -> Column:
        return F.lit(self.start)

    @property
    def as_of_col(self) -> Column:
        return F.lit(self.as_of)

    def contains(self, day: Column) -> Column:
        return day.between(self.start_col, self.as_of_col)

    def last_days(self, day: Column, n: int) -> Column:
        """True for the n days up to and including as_of."""
        return (day > F.date_sub(self.as_of_col, n)) & (day <= self.as_of_col)


HOUR = 3600
DAY = 24 * HOUR

FOLLOW_UP_DAYS = (1, 30)
ED_BEFORE_ADMISSION = (-12 * HOUR, 1 * HOUR)
ADMISSION_AFTER_ED = (-1 * HOUR, 12 * HOUR)
ED_LOOKBACK = (-180 * DAY, -12 * HOUR)
ADULT_AGE = 18
UTILIZATION_DAYS = 365
ABNORMAL_LAB_DAYS = 90
WORKLIST_DAYS = 14
ACTIVE_MONTHS = 24
HIGH_UTILIZER = {"inpatient": 2, "emergency": 4}
TIER_CUTS = (("High", 0.10), ("Medium", 0.30))
LOWEST_TIER = "Low"
