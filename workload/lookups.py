"""Small lookup tables for the driver tables, as SQL VALUES that Spark and the check engine both read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

NA = None

LOOKUPS: dict[str, tuple[tuple[str, ...], list[tuple]]] = {
    "condition_map": (
        ("snomed_code", "snomed_description", "icd10cm_code", "condition_class", "cohort", "charlson_category",
         "chronic_yn", "sdoh_domain", "map_quality"),
        [
            ("c0", "Heart attack", "I21.9", "diagnosis", "AMI", "myocardial_infarction", "Y", NA, "exact"),
            ("c1", "Heart failure", "I50.9", "diagnosis", "HF", "chf", "Y", NA, "exact"),
            ("c2", "Diabetes", "E11.9", "diagnosis", "DIABETES", "diabetes_uncomplicated", "Y", NA, "close"),
            ("c3", "Diabetic nephropathy", "E11.21", "diagnosis", "DIABETES", "diabetes_complicated", "Y", NA,
             "close"),
            ("c4", "Pneumonia", "J18.9", "diagnosis", "PNEUMONIA", NA, "N", NA, "exact"),
            ("c5", "Obstructive lung disease", "J44.9", "diagnosis", "COPD", "chronic_pulmonary", "Y", NA, "exact"),
            ("c6", "Depression", "F32.9", "diagnosis", NA, NA, "Y", NA, "close"),
            ("c7", "Works full time", NA, "sdoh", NA, NA, "N", "employment", "none"),
            ("c8", "Chest pain", "R07.9", "symptom", NA, NA, "N", NA, "exact"),
            ("c9", "Old heart attack", "I25.2", "history", NA, "myocardial_infarction", "N", NA, "close"),
            ("c10", "Chronic heart failure", "I50.9", "diagnosis", "HF", "chf", "Y", NA, "close"),
            ("c11", "Overweight", "E66.3", "diagnosis", NA, NA, "Y", NA, "exact"),
        ],
    ),
    "procedure_map": (
        ("snomed_code", "cpt_hcpcs", "code_system", "service_category", "revenue_code", "billable_yn",
         "map_quality"),
        [
            ("p0", "B0001", "CPT", "gauging", "R1", "Y", "close"),
            ("p1", "B0002", "CPT", "pumping", "R2", "Y", "exact"),
            ("p2", "B0003", "CPT_II", "counting", "R1", "N", "close"),
            ("p3", "B0004", "HCPCS", "gauging", "R1", "Y", "close"),
        ],
    ),
    "procedure_rules": (
        ("priority", "description_regex", "cpt_hcpcs", "code_system", "service_category", "revenue_code",
         "billable_yn"),
        [
            ("20", "(?i)WIDGET|gear", "B0010", "CPT", "radiology", "R3", "Y"),
            ("3", "ring|bolt", NA, "NONE", "nonbillable", NA, "N"),
            ("100", "^small", "B0011", "CPT", "lab", "R4", "Y"),
        ],
    ),
    "vaccine_map": (
        ("cvx_code", "cpt_code", "short_name"),
        [("v0", "V0001", "First"), ("v1", "V0002", "Second"), ("v2", "V0003", "Third"), ("p9", "V0004", "Ninth")],
    ),
    "payer_profile": (
        ("payer_name", "payer_type"),
        [("AFRICA", "medicare"), ("AMERICA", "medicaid"), ("ASIA", "commercial"), ("NO_INSURANCE", "self_pay")],
    ),
    "lab_panels": (
        ("loinc_code", "panel_code", "panel_name", "panel_cpt", "component_short_name"),
        [("view", "B", "BASIC PANEL", "L0001", "VIEW RATE"), ("click", "B", "BASIC PANEL", "L0001", "CLICK RATE"),
         ("signup", "S", "SIGNUP PANEL", "L0002", "SIGNUP RATE")],
    ),
    "lab_ranges": (
        ("loinc_code", "reference_low", "reference_high", "critical_low", "critical_high", "units"),
        [("view", "10", "60", "2", "120", "u"), ("click", NA, "50", NA, NA, "u"),
         ("signup", "5", "90", "1", "200", "u")],
    ),
    "charlson_weights": (
        ("charlson_category", "weight"),
        [("myocardial_infarction", "1"), ("chf", "1"), ("diabetes_uncomplicated", "1"),
         ("diabetes_complicated", "2"), ("chronic_pulmonary", "1")],
    ),
    # LACE scale as published, points per band.
    "lace_points": (
        ("component", "lower_bound", "upper_bound", "points"),
        [("L", "0", "0", "0"), ("L", "1", "1", "1"), ("L", "2", "2", "2"), ("L", "3", "3", "3"),
         ("L", "4", "6", "4"), ("L", "7", "13", "5"), ("L", "14", "9999", "7"),
         ("A", "0", "0", "0"), ("A", "1", "1", "3"),
         ("C", "0", "0", "0"), ("C", "1", "1", "1"), ("C", "2", "2", "2"), ("C", "3", "3", "3"),
         ("C", "4", "9999", "5"),
         ("E", "0", "0", "0"), ("E", "1", "1", "1"), ("E", "2", "2", "2"), ("E", "3", "3", "3"),
         ("E", "4", "9999", "4")],
    ),
    "planned_rules": (
        ("rule_id", "match_on", "code", "description", "category"),
        [("R1", "encounter_code", "E5", "Elective admission", "elective_surgery"),
         ("R2", "reason_code", "c9", "Recovery", "post_surgical_care"),
         ("R3", "procedure_code", "p7", "Chemotherapy", "cancer_treatment"),
         ("R4", "procedure_code", "p8", "Rehabilitation", "rehabilitation"),
         ("R5", "procedure_code", "p8", "Delivery", "obstetric_delivery"),
         ("R6", "reason_code", "c8", "Requested", "elective_surgery")],
    ),
}


def _literal(value: str | None) -> str:
    return "CAST(NULL AS VARCHAR(1))" if value is None else f"'{value}'"


def values_sql(name: str) -> str:
    columns, rows = LOOKUPS[name]
    body = ", ".join("(" + ", ".join(_literal(v) for v in row) + ")" for row in rows)
    return f"SELECT * FROM (VALUES {body}) AS t({', '.join(columns)})"


def lookup_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.sql(values_sql(name))
