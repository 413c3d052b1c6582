"""Patient summary, timeline and the discharge worklist."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from care_lake.operators.score import global_rank, top_reasons
from care_lake.settings import ABNORMAL_LAB_DAYS, HIGH_UTILIZER, UTILIZATION_DAYS, WORKLIST_DAYS, Period

Tables = Mapping[str, DataFrame]


def utilization(encounters: DataFrame, period: Period) -> DataFrame:
    day = F.to_date("start_ts")
    recent = period.last_days(day, UTILIZATION_DAYS)
    return encounters.groupBy("patient_id").agg(
        F.max(F.when(day <= period.as_of_col, day)).alias("last_visit_date"),
        F.count_if(recent).alias("visits_12_months"),
        F.count_if(recent & F.col("is_inpatient")).alias("inpatient_admissions_12_months"),
        F.count_if(recent & F.col("is_emergency")).alias("ed_visits_12_months"),
        F.sum(F.when(recent, F.col("medical_cost"))).alias("medical_cost_12_months"),
        F.sum(F.when(recent, F.col("payer_paid"))).alias("payer_paid_12_months"),
    )


def active_chronic(conditions: DataFrame, period: Period) -> DataFrame:
    as_of = period.as_of_col
    active = (
        F.col("is_chronic") & (F.col("condition_class") == "diagnosis") & (F.col("start_date") <= as_of)
        & (F.col("stop_date").isNull() | (F.col("stop_date") > as_of))
    )
    return conditions.filter(active).groupBy("patient_id").agg(
        F.count_distinct("icd10cm_code").alias("chronic_condition_count"),
        F.array_join(F.array_sort(F.collect_set("description")), "; ").alias("chronic_conditions"),
    )


def active_medications(medications: DataFrame, period: Period) -> DataFrame:
    as_of = period.as_of_col
    active = (F.to_date("start_ts") <= as_of) & (
        F.col("stop_ts").isNull() | (F.to_date("stop_ts") > as_of)
    )
    return medications.filter(active).groupBy("patient_id").agg(
        F.count_distinct("rxnorm_code").alias("active_medication_count")
    )


def lab_text() -> Column:
    """Test, value and units; NULL when there is no value at all."""
    value = F.coalesce(F.col("value_numeric").cast("string"), F.col("value_text"))
    return F.concat("test_name", F.lit(" "), value, F.lit(" "), F.coalesce("units", F.lit("")))


def abnormal_labs(labs: DataFrame, period: Period) -> DataFrame:
    recent = period.last_days(F.to_date("result_ts"), ABNORMAL_LAB_DAYS)
    text = F.concat(lab_text(), F.lit(" ("), F.col("abnormal_flag"), F.lit(")"))
    return labs.filter(F.col("is_abnormal") & recent).groupBy("patient_id").agg(
        F.count("*").alias("abnormal_labs_90_days"),
        F.max_by(text, F.struct("result_ts", "lab_result_id")).alias("latest_abnormal_lab"),
    )


def latest_stay(index: DataFrame, period: Period) -> DataFrame:
    newest = F.max_by(
        F.struct("lace_score", "risk_tier"), F.struct("discharge_date", "encounter_id")
    )
    recent = F.col("discharge_date") > F.date_sub(period.as_of_col, UTILIZATION_DAYS)
    return index.groupBy("patient_id").agg(
        F.max("discharge_date").alias("last_discharge_date"),
        newest["lace_score"].alias("latest_lace_score"),
        newest["risk_tier"].alias("latest_risk_tier"),
        F.count_if(F.col("is_readmitted_30_days") & recent).alias("readmissions_12_months"),
    )


def is_high_utilizer(inpatient: Column, emergency: Column) -> Column:
    return (inpatient >= HIGH_UTILIZER["inpatient"]) | (emergency >= HIGH_UTILIZER["emergency"])


def build_patient_360(t: Tables, period: Period) -> DataFrame:
    """Each part is reduced to one row per patient before the parts are joined on the same key."""
    parts = [
        utilization(t["fact_encounter"], period),
        active_chronic(t["fact_condition"], period),
        active_medications(t["fact_medication"], period),
        abnormal_labs(t["fact_lab_result"], period),
        latest_stay(t["fact_index_admission"], period),
    ]
    joined = t["dim_patient"]
    for part in parts:
        joined = joined.join(part, "patient_id", "left")

    def zero(c: str) -> Column:
        return F.coalesce(F.col(c), F.lit(0))

    def amount(c: str) -> Column:
        return zero(c).cast("decimal(14,2)").alias(c)

    inpatient, emergency = zero("inpatient_admissions_12_months"), zero("ed_visits_12_months")
    return joined.select(
        "patient_id",
        "source_system",
        "patient_name",
        "age",
        "age_band",
        "sex",
        "race",
        "ethnicity",
        "city",
        "is_deceased",
        "death_date",
        "current_payer_name",
        "current_payer_category",
        "last_visit_date",
        zero("visits_12_months").alias("visits_12_months"),
        inpatient.alias("inpatient_admissions_12_months"),
        emergency.alias("ed_visits_12_months"),
        zero("readmissions_12_months").alias("readmissions_12_months"),
        amount("medical_cost_12_months"),
        amount("payer_paid_12_months"),
        is_high_utilizer(inpatient, emergency).alias("is_high_utilizer"),
        zero("chronic_condition_count").alias("chronic_condition_count"),
        "chronic_conditions",
        zero("active_medication_count").alias("active_medication_count"),
        zero("abnormal_labs_90_days").alias("abnormal_labs_90_days"),
        "latest_abnormal_lab",
        "last_discharge_date",
        "latest_lace_score",
        "latest_risk_tier",
    )


def _events(
    df: DataFrame, category: str, at: str, kind: Column, text: Column, code: str, amount: str | None = None
) -> DataFrame:
    value = F.col(amount) if amount else F.lit(None)
    return df.select(
        "patient_id",
        F.col(at).cast("timestamp").alias("event_ts"),
        F.lit(category).alias("event_category"),
        kind.alias("event_type"),
        text.alias("description"),
        F.col(code).alias("code"),
        "encounter_id",
        value.cast("decimal(12,2)").alias("amount"),
    )


def build_patient_timeline(t: Tables, period: Period) -> DataFrame:
    text = F.col("description")
    parts = [
        _events(
            t["fact_encounter"], "Visit", "start_ts", F.col("care_setting"),
            F.concat_ws(" - ", "encounter_type", "reason_description"), "reason_icd10cm_code", "medical_cost",
        ),
        _events(
            t["fact_condition"].filter(F.col("condition_class") == "diagnosis"), "Diagnosis", "start_date",
            F.col("condition_group"), text, "icd10cm_code",
        ),
        _events(
            t["fact_procedure"], "Procedure", "start_ts", F.col("service_category"), text, "billing_code",
            "base_cost",
        ),
        _events(
            t["fact_medication"], "Medication", "start_ts",
            F.when(F.col("is_active"), "Active").otherwise("Stopped"), text, "rxnorm_code", "pharmacy_cost",
        ),
        _events(
            t["fact_lab_result"].filter("is_abnormal"), "Abnormal lab", "result_ts", F.col("abnormal_flag"),
            lab_text(), "loinc_code",
        ),
        _events(
            t["immunization"], "Vaccine", "administered_ts", F.lit("Immunization"), text, "cpt_code", "base_cost"
        ),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def score_reasons() -> Column:
    return top_reasons([
        (F.col("lace_l"), F.concat(F.lit("Length of stay "), "length_of_stay_days", F.lit(" days"))),
        (F.col("lace_a"), F.lit("Admitted through the ED")),
        (F.col("lace_c"), F.concat(F.lit("Charlson score "), "charlson_score")),
        (F.col("lace_e"), F.concat("ed_visits_6_months", F.lit(" ED visits in the 6 months before"))),
    ])


def build_care_management_worklist(t: Tables, period: Period) -> DataFrame:
    """Recent discharges of living patients, highest score first."""
    recent = t["fact_index_admission"].filter(period.last_days(F.col("discharge_date"), WORKLIST_DAYS))
    living = t["dim_patient"].filter(~F.col("is_deceased")).select(
        "patient_id", "patient_name", "age", "sex", "current_payer_category"
    )
    summary = t["patient_360"].select(
        "patient_id", "chronic_conditions", "active_medication_count", "is_high_utilizer"
    )
    rows = (
        recent.join(living, "patient_id")
        .join(t["dim_facility"].select("facility_id", "facility_name"), "facility_id", "left")
        .join(summary, "patient_id", "left")
        .select(
            "encounter_id",
            "patient_id",
            "patient_name",
            "age",
            "sex",
            "current_payer_category",
            "facility_name",
            "discharge_date",
            F.datediff(period.as_of_col, "discharge_date").alias("days_since_discharge"),
            "reason_description",
            "condition_group",
            "length_of_stay_days",
            "lace_score",
            "risk_tier",
            score_reasons().alias("top_risk_drivers"),
            "chronic_conditions",
            "active_medication_count",
            "is_high_utilizer",
            F.lit("Not yet contacted").alias("follow_up_status"),
        )
    )
    return global_rank(
        rows,
        [F.col("lace_score").desc(), F.col("discharge_date").desc(), F.col("encounter_id")],
        "worklist_rank",
    )
