"""One query per built table: typed entities, dimensions, facts, cubes and summaries."""

from __future__ import annotations

from pyspark.sql import functions as F

import workload.oracle_tables  # noqa: F401  registers the named subqueries
from workload.registry import query
from workload.standin import lake


def typed(source: str, dates: str = "", amounts: str = "") -> str:
    casts = [f"CAST({c} AS VARCHAR) AS {c}" for c in dates.split()]
    casts += [f"CAST({c} AS DOUBLE) AS {c}" for c in amounts.split()]
    return f"SELECT * {'REPLACE (' + ', '.join(casts) + ')' if casts else ''} FROM {source}"


def table_query(name: str, built: str, source: str, dates: str = "", amounts: str = "") -> None:
    query(name, typed(source, dates, amounts))(lambda spark, sf_dir: lake(spark, sf_dir).build(built))


STAY_DATES = "admit_date discharge_date"
STAY_AMOUNTS = "medical_cost payer_paid readmission_cost readmission_payer_paid"

table_query("silver_patient", "patient", "x_patient", "birth_date death_date")
table_query(
    "silver_encounter", "encounter", "x_encounter", "start_ts end_ts start_date end_date",
    "base_encounter_cost total_claim_cost payer_coverage",
)
table_query("silver_condition", "condition", "x_condition", "start_date stop_date")
table_query("silver_procedure", "procedure", "x_procedure", "start_ts end_ts procedure_date", "base_cost")
table_query("silver_observation", "observation", "x_observation", "observation_ts observation_date")
table_query(
    "silver_medication", "medication", "x_medication", "start_ts stop_ts",
    "base_cost_per_dispense payer_coverage total_cost",
)
table_query("silver_immunization", "immunization", "x_immunization", "administered_ts administered_date", "base_cost")
table_query("silver_allergy", "allergy", "x_allergy", "start_date stop_date")
table_query("silver_provider", "provider", "x_provider")
table_query("silver_organization", "organization", "x_organization")
table_query("silver_payer", "payer", "x_payer")
table_query("silver_coverage", "coverage", "x_coverage", "start_date end_date")
table_query(
    "silver_claim", "claim", "x_claim", "service_date current_illness_date",
    "primary_outstanding secondary_outstanding patient_outstanding",
)
table_query(
    "silver_claim_transaction", "claim_transaction", "x_claim_transaction", "from_date to_date",
    "unit_amount charge_amount payment_amount adjustment_amount transfer_amount outstanding_amount",
)



@query("d01_date_dim", typed("""(
SELECT d.*, v.visits FROM x_dim_date d
LEFT JOIN (SELECT CAST(start_ts AS DATE) AS day, count(*) AS visits FROM x_fact_encounter GROUP BY ALL) v ON v.day = d.date)""", "date month_start"))
def d01(spark, sf_dir):
    """The calendar beside the visits of each day."""
    t = lake(spark, sf_dir)
    visits = t["fact_encounter"].groupBy(F.col("start_date_key").alias("date_key")).agg(F.count("*").alias("visits"))
    return t["dim_date"].join(visits, "date_key", "left")


table_query("d02_dim_patient", "dim_patient", "x_dim_patient", "birth_date death_date")
query("d05_dim_provider", """
SELECT provider_id, source_system, provider_name, sex, specialty, organization_id AS facility_id, npi, city, state
FROM x_provider""")(lambda spark, sf_dir: lake(spark, sf_dir).build("dim_provider"))
table_query("d06_dim_facility", "dim_facility", "x_dim_facility")
query("d07_dim_payer", "SELECT payer_id, payer_name, payer_type, payer_category, ownership FROM x_payer")(
    lambda spark, sf_dir: lake(spark, sf_dir).build("dim_payer")
)
table_query("d08_dim_diagnosis", "dim_diagnosis", "x_dim_diagnosis")
table_query(
    "f01_fact_encounter", "fact_encounter", "x_fact_encounter", "start_ts end_ts",
    "medical_cost payer_paid patient_responsibility",
)
table_query("f02_fact_condition", "fact_condition", "x_fact_condition", "start_date stop_date")
table_query("f03_fact_procedure", "fact_procedure", "x_fact_procedure", "start_ts", "base_cost")
table_query("f04_fact_lab_result", "fact_lab_result", "x_fact_lab_result", "result_ts")
table_query(
    "f05_fact_medication", "fact_medication", "x_fact_medication", "start_ts stop_ts",
    "pharmacy_cost payer_paid patient_responsibility",
)
table_query(
    "f06_fact_claim", "fact_claim", "x_fact_claim", "service_date", "total_charges total_payments total_outstanding"
)
table_query("f07_member_month", "fact_member_month", "x_fact_member_month", "month_start")
table_query("r13_index_admissions", "fact_index_admission", "x_fact_index_admission", STAY_DATES, STAY_AMOUNTS)
table_query("k02_kpi_monthly", "kpi_monthly", "x_kpi_monthly", "month_start")
table_query("k03_active_monthly", "kpi_active_patients_monthly", "x_active", "month_start")
table_query(
    "a06_patient_360", "patient_360", "x_patient_360", "death_date last_visit_date last_discharge_date"
)
table_query("a08_timeline", "patient_timeline", "x_timeline", "event_ts")
table_query("a09_worklist", "care_management_worklist", "x_worklist", "discharge_date")
