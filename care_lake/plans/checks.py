"""Expectations of every table, and the gates that stop a run after the build."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from care_lake import fixed
from care_lake.operators import quality as q

Tables = Mapping[str, DataFrame]

_TRANSACTION_TYPES = ", ".join(f"'{x}'" for x in fixed.TRANSACTION_TYPES)

BRONZE: dict[str, dict[str, str]] = {
    "fhir_resources": {
        "valid_json_with_type": "resource_type is not null", "has_resource_id": "resource_id is not null",
    },
    "patients": {"has_patient_id": "Id is not null"},
    "organizations": {"has_organization_id": "Id is not null"},
    "providers": {"has_provider_id": "Id is not null"},
    "payers": {"has_payer_id": "Id is not null"},
    "payer_transitions": {"has_patient": "PATIENT is not null"},
    "encounters": {"has_encounter_id": "Id is not null"},
    "conditions": {"has_patient": "PATIENT is not null"},
    "procedures": {"has_patient": "PATIENT is not null"},
    "observations": {"has_patient": "PATIENT is not null"},
    "medications": {"has_patient": "PATIENT is not null"},
    "immunizations": {"has_patient": "PATIENT is not null"},
    "allergies": {"has_patient": "PATIENT is not null"},
    "claims": {"has_claim_id": "Id is not null"},
    "claims_transactions": {"has_claim_id": "CLAIMID is not null"},
}

_HAS_PATIENT = {"has_patient": "patient_id is not null"}

SILVER: dict[str, dict[str, str]] = {
    "patient": {
        "valid_birth_date": "birth_date is not null and birth_date <= current_date()",
        "death_not_before_birth": "death_date is null or death_date >= birth_date",
        "known_sex": "sex in ('Female', 'Male')",
    },
    "encounter": {
        **_HAS_PATIENT,
        "end_not_before_start": "end_ts is null or end_ts >= start_ts",
        "known_encounter_class": "care_setting is not null",
        "reason_code_mapped": "reason_snomed_code is null or reason_icd10cm_code is not null"
                              " or reason_condition_class <> 'diagnosis'",
    },
    "condition": {
        **_HAS_PATIENT,
        "has_code": "condition_class is not null",
        "diagnosis_has_icd10": "condition_class <> 'diagnosis' or icd10cm_code is not null",
        "stop_not_before_start": "stop_date is null or stop_date >= start_date",
    },
    "procedure": {
        **_HAS_PATIENT,
        "end_not_before_start": "end_ts is null or end_ts >= start_ts",
        "has_billing_category": "service_category is not null",
    },
    "observation": {
        **_HAS_PATIENT,
        "known_category": "category is not null",
        "numeric_value_parsed": "value_type <> 'numeric' or value_numeric is not null",
    },
    "medication": {
        **_HAS_PATIENT,
        "stop_not_before_start": "stop_ts is null or stop_ts >= start_ts",
        "cost_not_negative": "total_cost is null or total_cost >= 0",
    },
    "immunization": {**_HAS_PATIENT, "has_cpt_code": "cpt_code is not null"},
    "allergy": {
        **_HAS_PATIENT,
        "known_severity": "highest_severity is null or highest_severity in ('Mild', 'Moderate', 'Severe')",
    },
    "provider": {"has_name": "provider_name is not null"},
    "organization": {"has_name": "organization_name is not null"},
    "payer": {"has_payer_type": "payer_type is not null"},
    "coverage": {
        **_HAS_PATIENT,
        "has_payer": "payer_id is not null",
        "end_not_before_start": "end_date is null or end_date >= start_date",
    },
    "claim": {
        **_HAS_PATIENT,
        "has_encounter": "encounter_id is not null",
        "has_principal_diagnosis": "principal_diagnosis_icd10cm_code is not null",
    },
    "claim_transaction": {
        "has_claim": "claim_id is not null",
        "known_transaction_type": f"transaction_type in ({_TRANSACTION_TYPES})",
        "amounts_not_negative": "coalesce(charge_amount, 0) >= 0 and coalesce(payment_amount, 0) >= 0",
    },
}

GOLD: dict[str, dict[str, str]] = {
    "fact_index_admission": {
        "lace_score_in_range": "lace_score between 0 and 19",
        "readmission_after_discharge": "days_to_readmission is null or days_to_readmission between 1 and 30",
    },
}

LAYERS = {"bronze": BRONZE, "silver": SILVER, "gold": GOLD}
MUST_HAVE_ROWS = (
    "dim_patient", "fact_encounter", "fact_claim", "fact_index_admission", "kpi_monthly", "patient_360",
)
CONSERVED = {"patient": ("patients", "Id"), "encounter": ("encounters", "Id"), "claim": ("claims", "Id")}


def expectation_results(t: Tables, layers: Sequence[str] = ("bronze", "silver", "gold")) -> DataFrame:
    """Passed and failed rows of all 54 expectations."""
    return q.union_all(
        q.expect(t[table], checks, f"{layer}.{table}")
        for layer in layers
        for table, checks in LAYERS[layer].items()
    )


def data_quality_results(ledger: DataFrame, run: str | None = None) -> DataFrame:
    """Results of one run of the ledger, by default the newest, worst first."""
    newest = ledger.agg(F.max("run_started_at").alias("run_started_at"))
    rows = ledger.join(newest, "run_started_at") if run is None else ledger.filter(F.col("run_id") == run)
    return rows.groupBy("table_name", "expectation").agg(
        F.sum("passed_rows").alias("passed_rows"), F.sum("failed_rows").alias("failed_rows")
    ).orderBy(F.desc("failed_rows"), "table_name", "expectation")


def conserved_counts(t: Tables) -> DataFrame:
    """Rows of the CSV source in cleaned tables against distinct raw keys."""
    return q.conserved({
        name: (t[name].filter(F.col("source_system") == fixed.CSV_SYSTEM), t[raw], key)
        for name, (raw, key) in CONSERVED.items()
    })


def gate_nonempty(t: Tables) -> None:
    empty = q.row_counts({n: t[n] for n in MUST_HAVE_ROWS}).filter("row_count = 0")
    q.raise_if(empty, F.col("table_name"), "empty tables")


def gate_conserved(t: Tables) -> None:
    lost = conserved_counts(t).filter("silver_rows <> bronze_keys")
    text = F.concat_ws(" ", "table_name", "silver_rows", F.lit("vs"), "bronze_keys")
    q.raise_if(lost, text, "cleaned rows differ from raw keys")


def unexpected_failures(results: DataFrame, allowed: Sequence[str] = fixed.KNOWN_FAILURES) -> DataFrame:
    name = F.concat_ws(".", "table_name", "expectation")
    return results.withColumn("name", name).filter((F.col("failed_rows") > 0) & ~name.isin(*allowed))


def gate_expectations(results: DataFrame, allowed: Sequence[str] = fixed.KNOWN_FAILURES) -> None:
    text = F.concat("name", F.lit(" ("), "failed_rows", F.lit(" rows)"))
    q.raise_if(unexpected_failures(results, allowed), text, "unexpected data quality failures")


def gate_measure(t: Tables) -> None:
    followed = t["fact_index_admission"].agg(F.count_if("follow_up_complete").alias("n")).filter("n = 0")
    q.raise_if(followed, F.lit("readmission measure"), "no index admission with complete follow-up")


def lookup_problems(t: Tables) -> DataFrame:
    """Faults of the lookups against each other and against the codes in use; empty when all is well."""
    conditions, procedures = t["condition_map"], t["procedure_map"]
    need_icd10 = conditions.filter(
        F.col("condition_class").isin("diagnosis", "symptom", "history") & F.col("icd10cm_code").isNull()
    )
    unresolved = (
        t["procedure"].filter(F.col("service_category").isNull() & F.col("code_mapping").isNull())
        .select(F.col("snomed_code").alias("code")).dropna().distinct()
    )
    found = {
        "condition code not mapped": q.missing_codes(t["conditions"], "CODE", conditions, "snomed_code"),
        "condition code twice": q.duplicate_keys(conditions, "snomed_code"),
        "diagnosis without icd10": need_icd10.select(F.col("snomed_code").alias("code")),
        "unknown charlson category": q.missing_codes(
            conditions, "charlson_category", t["charlson_weights"], "charlson_category"
        ),
        "procedure without billing code": unresolved,
        "procedure code twice": q.duplicate_keys(procedures, "snomed_code"),
        "vaccine not mapped": q.missing_codes(t["immunizations"], "CODE", t["vaccine_map"], "cvx_code"),
        "band gap": q.band_gaps(t["lace_points"]).select(
            F.concat_ws(" ", "component", "lower_bound").alias("code")
        ),
        "payer without profile": q.missing_codes(t["payers"], "NAME", t["payer_profile"], "payer_name"),
        "lab range without panel": q.missing_codes(t["lab_ranges"], "loinc_code", t["lab_panels"], "loinc_code"),
    }
    return q.union_all(df.select(F.lit(name).alias("problem"), "code") for name, df in found.items())
