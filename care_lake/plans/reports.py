"""The questions the report pages ask. ``filters`` carries the slicers, for example
``{"dim_date.year": 2024, "kpi_monthly.payer_category": "Medicare"}``."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from care_lake.plans.measures import RELATIONSHIPS, measure

Tables = Mapping[str, DataFrame]
Filters = Mapping[str, object] | None

IN_PERIOD = {"dim_date.is_in_analysis_period": True}

EXECUTIVE_CARDS = (
    "admissions", "readmission_rate", "average_length_of_stay", "ed_visits_per_1000", "post_discharge_ed_rate",
    "payer_paid", "pmpm_paid", "high_risk_patients",
)
COST_CARDS = (
    "medical_cost", "payer_paid", "patient_responsibility", "cost_per_patient", "high_utilizers",
    "high_utilizer_share_of_cost", "readmission_cost",
)
CARE_CARDS = ("worklist_patients", "high_risk_patients", "scored_discharges", "readmission_rate_scored")


def _in_period(filters: Filters) -> dict[str, object]:
    """The two overview pages always look at the analysis period only."""
    return {**IN_PERIOD, **(filters or {})}


def executive_cards(t: Tables, filters: Filters = None) -> DataFrame:
    return measure(EXECUTIVE_CARDS, t, filters=_in_period(filters))


def cost_cards(t: Tables, filters: Filters = None) -> DataFrame:
    return measure(COST_CARDS, t, filters=_in_period(filters))


def care_cards(t: Tables, filters: Filters = None) -> DataFrame:
    return measure(CARE_CARDS, t, filters=filters)


def _breakdown(
    t: Tables, names: Sequence[str], field: str, filters: Filters, sort: str | None = None
) -> DataFrame:
    out = measure(names, t, [field], _in_period(filters))
    column = field.split(".")[1]
    order = [F.desc_nulls_last(sort), F.col(column)] if sort else [F.col(column)]
    return out.orderBy(*order)


def readmission_by_quarter(t: Tables, filters: Filters = None) -> DataFrame:
    return _breakdown(t, ["readmission_rate", "readmission_rate_benchmark"], "dim_date.year_quarter", filters)


def admissions_by_condition(t: Tables, filters: Filters = None) -> DataFrame:
    return _breakdown(t, ["admissions", "readmissions"], "kpi_monthly.condition_group", filters, "admissions")


def admissions_by_facility(t: Tables, filters: Filters = None) -> DataFrame:
    return _breakdown(t, ["admissions"], "dim_facility.facility_name", filters, "admissions")


def paid_share_by_category(t: Tables, filters: Filters = None) -> DataFrame:
    """Payer paid per category with its share; the window runs over the few categories only."""
    paid = measure(["payer_paid"], t, ["kpi_monthly.payer_category"], _in_period(filters))
    total = F.sum("payer_paid").over(Window.partitionBy())
    share = F.try_divide(F.col("payer_paid").cast("double"), total.cast("double"))
    return paid.withColumn("share", share)


def visits_by_month(t: Tables, filters: Filters = None) -> DataFrame:
    return _breakdown(t, ["admissions", "ed_visits"], "dim_date.year_month", filters)


def cost_by_condition(t: Tables, filters: Filters = None) -> DataFrame:
    return _breakdown(t, ["medical_cost"], "kpi_monthly.condition_group", filters, "medical_cost")


def cost_by_facility(t: Tables, filters: Filters = None) -> DataFrame:
    return _breakdown(t, ["medical_cost"], "dim_facility.facility_name", filters, "medical_cost")


def paid_by_category(t: Tables, filters: Filters = None) -> DataFrame:
    return _breakdown(
        t, ["payer_paid", "patient_responsibility"], "kpi_monthly.payer_category", filters, "payer_paid"
    )


def paid_by_provider(t: Tables, filters: Filters = None) -> DataFrame:
    return _breakdown(
        t, ["encounter_payer_paid"], "dim_provider.provider_name", filters, "encounter_payer_paid"
    )


def readmission_by_tier(t: Tables, filters: Filters = None) -> DataFrame:
    return measure(["readmission_rate_scored"], t, ["fact_index_admission.risk_tier"], filters).orderBy("risk_tier")


def _one_patient(df: DataFrame, patient_id: str | None) -> DataFrame:
    return df if patient_id is None else df.filter(F.col("patient_id") == patient_id)


def patient_summary(t: Tables, patient_id: str | None = None) -> DataFrame:
    return _one_patient(t["patient_360"], patient_id).select(
        "patient_id", "age", "sex", "current_payer_name", "latest_risk_tier", "latest_lace_score",
        "visits_12_months", "inpatient_admissions_12_months", "ed_visits_12_months", "medical_cost_12_months",
        "active_medication_count", "is_high_utilizer", "chronic_conditions",
    )


def patient_events(t: Tables, patient_id: str | None = None) -> DataFrame:
    return _one_patient(t["patient_timeline"], patient_id).select(
        "patient_id", "event_ts", "event_category", "event_type", "description", "code", "amount"
    ).orderBy("patient_id", F.desc("event_ts"))


def patient_diagnoses(t: Tables, patient_id: str | None = None) -> DataFrame:
    return _one_patient(t["fact_condition"], patient_id).select(
        "patient_id", "start_date", "description", "icd10cm_code", "is_active"
    ).orderBy("patient_id", F.desc("start_date"))


def patient_labs(t: Tables, patient_id: str | None = None) -> DataFrame:
    return _one_patient(t["fact_lab_result"], patient_id).select(
        "patient_id", "result_ts", "test_name", "value_numeric", "units", "abnormal_flag"
    ).orderBy("patient_id", F.desc("result_ts"))


def patient_medications(t: Tables, patient_id: str | None = None) -> DataFrame:
    return _one_patient(t["fact_medication"], patient_id).select(
        "patient_id", "start_ts", "description", "is_active"
    ).orderBy("patient_id", F.desc("start_ts"))


def worklist(t: Tables, tier: str | None = None, condition: str | None = None) -> DataFrame:
    rows = t["care_management_worklist"]
    if tier is not None:
        rows = rows.filter(F.col("risk_tier") == tier)
    if condition is not None:
        rows = rows.filter(F.col("condition_group") == condition)
    return rows.select(
        "worklist_rank", "patient_name", "age", "facility_name", "discharge_date", "days_since_discharge",
        "reason_description", "lace_score", "risk_tier", "top_risk_drivers", "follow_up_status",
    ).orderBy("worklist_rank")


def index_stays_with_outcome(t: Tables) -> DataFrame:
    names = t["dim_patient"].select("patient_id", "patient_name")
    return t["fact_index_admission"].join(names, "patient_id").select(
        "encounter_id", "discharge_date", "patient_name", "reason_description", "lace_score", "risk_tier",
        "is_readmitted_30_days",
    ).orderBy(F.desc("discharge_date"), "encounter_id")


def slicer(t: Tables, table: str, column: str, used_in: str | None = None) -> DataFrame:
    """Values a reader can choose from; with ``used_in`` only those that rows of a related table have."""
    rows = t[table]
    if used_in is not None:
        fact_key, dim_key = RELATIONSHIPS[used_in][table]
        rows = rows.join(t[used_in].select(F.col(fact_key).alias("_used")), F.col(dim_key) == F.col("_used"), "left_semi")
    return rows.select(column).dropna().distinct().orderBy(column)
