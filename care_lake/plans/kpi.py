"""KPI cubes: counts and sums per month, never rates."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from care_lake.functions.calendar import date_key, month_of
from care_lake.operators.distinct import presence
from care_lake.operators.intervals import active_per_month
from care_lake.operators.lookups import map_code
from care_lake.settings import ACTIVE_MONTHS, Period

Tables = Mapping[str, DataFrame]

KEYS = ("month_start", "facility_id", "payer_category", "condition_group")
COUNTS = (
    "admissions", "discharges", "inpatient_days", "ed_visits", "index_admissions", "readmissions",
    "post_discharge_ed_visits",
)
AMOUNTS = ("readmission_cost", "medical_cost", "payer_paid", "patient_responsibility")


def _measures(month: Column, values: Mapping[str, Column]) -> Column:
    """One record of the cube; measures that are not given are zero."""
    counts = [values.get(c, F.lit(0)).cast("long").alias(c) for c in COUNTS]
    amounts = [F.coalesce(values.get(c, F.lit(0)), F.lit(0)).cast("decimal(14,2)").alias(c) for c in AMOUNTS]
    return F.struct(month.alias("month_start"), *counts, *amounts)


def _flag(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(0)


def encounter_records(encounters: DataFrame, payers: DataFrame) -> DataFrame:
    """Visits count in the month they start, discharges in the month they end: both from one scan."""
    inpatient = F.col("is_inpatient")
    started = _measures(month_of(F.to_date("start_ts")), {
        "admissions": _flag(inpatient),
        "ed_visits": _flag(F.col("is_emergency")),
        "medical_cost": F.col("medical_cost"),
        "payer_paid": F.col("payer_paid"),
        "patient_responsibility": F.col("patient_responsibility"),
    })
    ended = _measures(month_of(F.to_date("end_ts")), {
        "discharges": F.lit(1), "inpatient_days": F.col("length_of_stay_days"),
    })
    records = F.when(inpatient, F.array(started, ended)).otherwise(F.array(started))
    return with_payer_category(encounters, payers).select(
        "facility_id", "payer_category", "condition_group", F.inline(records)
    )


def index_records(index: DataFrame, payers: DataFrame) -> DataFrame:
    record = _measures(month_of("discharge_date"), {
        "index_admissions": F.lit(1),
        "readmissions": _flag(F.col("is_readmitted_30_days")),
        "post_discharge_ed_visits": F.col("post_discharge_ed_visits"),
        "readmission_cost": F.col("readmission_cost"),
    })
    return with_payer_category(index.filter("follow_up_complete"), payers).select(
        "facility_id", "payer_category", "condition_group", F.inline(F.array(record))
    )


def with_payer_category(df: DataFrame, payers: DataFrame) -> DataFrame:
    named = map_code(df, payers, "payer_id", "payer_id", {"payer_category": "_category"})
    return named.withColumn("payer_category", F.coalesce("_category", F.lit("Unknown")))


def build_kpi_monthly(t: Tables, period: Period) -> DataFrame:
    records = encounter_records(t["fact_encounter"], t["dim_payer"]).unionByName(
        index_records(t["fact_index_admission"], t["dim_payer"])
    )
    cube = records.filter(period.contains(F.col("month_start"))).groupBy(*KEYS).agg(
        *[F.sum(c).alias(c) for c in COUNTS], *[F.sum(c).cast("decimal(14,2)").alias(c) for c in AMOUNTS]
    )
    return cube.select("month_start", date_key("month_start").alias("month_date_key"), *KEYS[1:], *COUNTS, *AMOUNTS)


def build_kpi_active_patients_monthly(t: Tables, period: Period) -> DataFrame:
    monthly = active_per_month(
        t["fact_encounter"].select("patient_id", F.to_date("start_ts").alias("visit_date")),
        t["dim_patient"],
        key="patient_id", day="visit_date", alive_from="birth_date", alive_to="death_date",
        lookback=ACTIVE_MONTHS, period=period, out="active_patients",
    )
    return monthly.select("month_start", date_key("month_start").alias("month_date_key"), "active_patients")


def build_patients_seen_monthly(t: Tables, period: Period) -> DataFrame:
    """Who was seen per visit month, facility and payer, of all visits. Numbers of patients hold within one build."""
    visits = t["fact_encounter"].withColumn("month_date_key", date_key(month_of(F.to_date("start_ts"))))
    return presence(visits, ["month_date_key", "facility_id", "payer_id"], "patient_id")
