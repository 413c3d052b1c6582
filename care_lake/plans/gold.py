"""Gold: dimensions and facts of the star schema."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from care_lake import fixed
from care_lake.functions.calendar import age_as_of, age_band, date_dim, date_key
from care_lake.functions.clean import balance, null_safe_sum
from care_lake.operators.dedup import asof_interval, pick_best
from care_lake.operators.intervals import explode_months
from care_lake.operators.lookups import map_code
from care_lake.settings import Period

Tables = Mapping[str, DataFrame]


def or_other(group: str) -> Column:
    return F.coalesce(F.col(group), F.lit("Other"))


def is_hrrp(group: Column) -> Column:
    """Condition groups of the readmission reduction programme; a missing group is not one of them."""
    return F.coalesce(group.isin(*fixed.HRRP_GROUPS), F.lit(False))


def build_dim_date(t: Tables, period: Period) -> DataFrame:
    return date_dim(next(iter(t.values())).sparkSession, period)


def build_dim_patient(t: Tables, period: Period) -> DataFrame:
    current = asof_interval(
        t["coverage"].select("patient_id", "payer_id", "member_id", "start_date", "end_date"),
        "patient_id", "start_date", "end_date", period.as_of_col, tie=["payer_id"],
    )
    insured = map_code(current, t["payer"], "payer_id", "payer_id", {
        "payer_name": "_payer_name", "payer_category": "_payer_category",
    }).drop("start_date", "end_date")
    age = age_as_of("birth_date", "death_date", period)
    return t["patient"].join(insured, "patient_id", "left").select(
        "patient_id",
        "source_system",
        F.concat_ws(" ", "first_name", "last_name").alias("patient_name"),
        "first_name",
        "last_name",
        "birth_date",
        "death_date",
        "is_deceased",
        age.alias("age"),
        age_band(age).alias("age_band"),
        "sex",
        "race",
        "ethnicity",
        "marital_status",
        "city",
        "county",
        "state",
        "zip",
        "latitude",
        "longitude",
        F.col("payer_id").alias("current_payer_id"),
        F.coalesce("_payer_name", F.lit("Unknown")).alias("current_payer_name"),
        F.coalesce("_payer_category", F.lit("Unknown")).alias("current_payer_category"),
        F.col("member_id").alias("current_member_id"),
    )


def build_dim_provider(t: Tables, period: Period) -> DataFrame:
    return t["provider"].select(
        "provider_id", "source_system", "provider_name", "sex", "specialty",
        F.col("organization_id").alias("facility_id"), "npi", "city", "state",
    )


def build_dim_facility(t: Tables, period: Period) -> DataFrame:
    return t["organization"].select(
        F.col("organization_id").alias("facility_id"), "source_system",
        F.col("organization_name").alias("facility_name"), "address", "city", "state", "zip", "npi",
        "latitude", "longitude",
    )


def build_dim_payer(t: Tables, period: Period) -> DataFrame:
    return t["payer"].select("payer_id", "payer_name", "payer_type", "payer_category", "ownership")


def build_dim_diagnosis(t: Tables, period: Period) -> DataFrame:
    """One description per diagnosis code: the map before the source, grouped before ungrouped codes."""
    mapped = t["condition_map"].filter("icd10cm_code is not null").select(
        "icd10cm_code", F.col("snomed_description").alias("description"), "condition_class",
        F.col("cohort").alias("condition_group"), (F.col("chronic_yn") == "Y").alias("is_chronic"),
        "charlson_category", F.lit(1).alias("_source"),
    )
    sourced = t["condition"].filter(F.col("icd10_source") == "source").select(
        "icd10cm_code", "description", "condition_class", "condition_group", "is_chronic",
        "charlson_category", F.lit(2).alias("_source"),
    ).distinct()
    best = pick_best(mapped.unionByName(sourced), ["icd10cm_code"], [
        F.col("_source"), F.col("condition_group").isNull(), F.col("description"),
        F.col("condition_class"), F.col("condition_group"), F.col("is_chronic"), F.col("charlson_category"),
    ])
    return best.select(
        "icd10cm_code",
        F.left("icd10cm_code", F.lit(3)).alias("icd10cm_category"),
        "description",
        "condition_class",
        or_other("condition_group").alias("condition_group"),
        is_hrrp(F.col("condition_group")).alias("is_hrrp_condition"),
        F.coalesce("is_chronic", F.lit(False)).alias("is_chronic"),
        "charlson_category",
    )


def stay_days(start: str, end: str) -> Column:
    """Length of stay; a stay within one day, and a stay without an end, count as one day."""
    return F.greatest(F.datediff(end, start), F.lit(1))


def build_fact_encounter(t: Tables, period: Period) -> DataFrame:
    inpatient = F.col("care_setting") == "Inpatient"
    return t["encounter"].filter(~F.col("is_administrative")).select(
        "encounter_id",
        "source_system",
        "patient_id",
        "provider_id",
        F.col("organization_id").alias("facility_id"),
        "payer_id",
        date_key("start_date").alias("start_date_key"),
        date_key("end_date").alias("end_date_key"),
        "start_ts",
        "end_ts",
        "care_setting",
        "encounter_class",
        "encounter_type",
        inpatient.alias("is_inpatient"),
        (F.col("care_setting") == "Emergency").alias("is_emergency"),
        F.when(inpatient, stay_days("start_date", "end_date")).alias("length_of_stay_days"),
        "reason_icd10cm_code",
        "reason_description",
        or_other("reason_condition_group").alias("condition_group"),
        F.col("total_claim_cost").alias("medical_cost"),
        F.col("payer_coverage").alias("payer_paid"),
        balance("total_claim_cost", "payer_coverage").alias("patient_responsibility"),
    )


def build_fact_condition(t: Tables, period: Period) -> DataFrame:
    return t["condition"].filter(F.col("condition_class").isin(*fixed.CLINICAL_CLASSES)).select(
        "condition_id",
        "patient_id",
        "encounter_id",
        date_key("start_date").alias("start_date_key"),
        "start_date",
        "stop_date",
        "is_active",
        "icd10cm_code",
        "snomed_code",
        "description",
        "condition_class",
        or_other("condition_group").alias("condition_group"),
        F.coalesce("is_chronic", F.lit(False)).alias("is_chronic"),
        "charlson_category",
    )


def build_fact_procedure(t: Tables, period: Period) -> DataFrame:
    return t["procedure"].select(
        "procedure_id", "patient_id", "encounter_id", date_key("procedure_date").alias("procedure_date_key"),
        "start_ts", "snomed_code", "description", "billing_code", "billing_code_system", "service_category",
        "is_billable", "base_cost",
    )


def build_fact_lab_result(t: Tables, period: Period) -> DataFrame:
    return t["observation"].filter(F.col("category") == "laboratory").select(
        F.col("observation_id").alias("lab_result_id"),
        "patient_id",
        "encounter_id",
        date_key("observation_date").alias("result_date_key"),
        F.col("observation_ts").alias("result_ts"),
        "loinc_code",
        F.coalesce("lab_component", "description").alias("test_name"),
        "lab_panel",
        "value_numeric",
        "value_text",
        "units",
        "reference_low",
        "reference_high",
        "abnormal_flag",
        F.col("abnormal_flag").isin(*fixed.ABNORMAL_FLAGS).alias("is_abnormal"),
    )


def build_fact_medication(t: Tables, period: Period) -> DataFrame:
    return t["medication"].select(
        "medication_order_id",
        "patient_id",
        "encounter_id",
        "payer_id",
        date_key(F.to_date("start_ts")).alias("start_date_key"),
        "start_ts",
        "stop_ts",
        "is_active",
        "rxnorm_code",
        "description",
        "dispenses",
        F.col("total_cost").alias("pharmacy_cost"),
        F.col("payer_coverage").alias("payer_paid"),
        balance("total_cost", "payer_coverage").alias("patient_responsibility"),
        "reason_icd10cm_code",
        or_other("reason_condition_group").alias("condition_group"),
    )


def claim_money(transactions: DataFrame) -> DataFrame:
    return transactions.groupBy("claim_id").agg(
        F.sum("charge_amount").alias("total_charges"),
        F.sum("payment_amount").alias("total_payments"),
        F.count_if(F.col("transaction_type") == "CHARGE").alias("charge_lines"),
    )


def build_fact_claim(t: Tables, period: Period) -> DataFrame:
    """Transactions are totalled per claim before they meet the claims."""
    money = claim_money(t["claim_transaction"])
    zero = F.lit(0)
    return t["claim"].join(money, "claim_id", "left").select(
        "claim_id",
        "patient_id",
        "encounter_id",
        "provider_id",
        F.col("primary_payer_id").alias("payer_id"),
        date_key("service_date").alias("service_date_key"),
        "service_date",
        F.col("primary_claim_type").alias("claim_type"),
        "principal_diagnosis_icd10cm_code",
        "principal_diagnosis_description",
        F.coalesce("charge_lines", zero).alias("charge_lines"),
        F.coalesce("total_charges", zero).alias("total_charges"),
        F.coalesce("total_payments", zero).alias("total_payments"),
        null_safe_sum("primary_outstanding", "secondary_outstanding", "patient_outstanding").alias(
            "total_outstanding"
        ),
        "primary_status",
        "patient_status",
    )


def build_fact_member_month(t: Tables, period: Period) -> DataFrame:
    """Months of paid-for coverage; when two periods share a month the one that started last counts.

    Self-pay and payers of unknown type are left out before any month is made.
    """
    insured = t["coverage"].select("patient_id", "payer_id", "member_id", "start_date", "end_date").join(
        t["payer"].filter(F.col("payer_type") != fixed.SELF_PAY).select("payer_id", "payer_category"), "payer_id"
    )
    months = explode_months(insured, "start_date", "end_date", period)
    one_each = pick_best(months, ["patient_id", "month_start"], [F.col("start_date").desc(), F.col("payer_id")])
    alive = F.col("death_date").isNull() | (F.col("death_date") >= F.col("month_start"))
    return (
        one_each.join(t["patient"].select("patient_id", "death_date"), "patient_id")
        .filter(alive)
        .select(
            "patient_id", "month_start", date_key("month_start").alias("month_date_key"), "payer_id",
            "payer_category", "member_id",
        )
    )
