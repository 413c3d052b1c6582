"""Measures (M) and report questions (V) over the built tables."""

from __future__ import annotations

from care_lake.plans import reports
from care_lake.plans.measures import measure
from workload.registry import query, table
from workload.standin import lake

YEAR, QUARTER, MONTH = "dim_date.year", "dim_date.year_quarter", "dim_date.year_month"
CONDITION, CATEGORY = "kpi_monthly.condition_group", "kpi_monthly.payer_category"
FACILITY = "dim_facility.facility_name"

PER_YEAR = "year(month_start) AS year"
DOUBLE = "CAST({} AS DOUBLE)"


def ratio(top: str, bottom: str) -> str:
    return f"{DOUBLE.format(top)} / nullif({DOUBLE.format(bottom)}, 0)"


def measure_query(name: str, by: list[str], sql: str, filters: dict | None = None, key: str | None = None) -> None:
    query(key or f"m_{name}", sql)(
        lambda spark, sf_dir: measure([name], lake(spark, sf_dir), by, filters)
    )


def kpi_sql(name: str, value: str, group: str = PER_YEAR) -> str:
    return f"SELECT * FROM (SELECT {group}, {value} AS {name} FROM x_kpi_monthly GROUP BY ALL) WHERE {name} IS NOT NULL"


for _name in ("admissions", "discharges", "inpatient_days", "ed_visits", "index_admissions", "readmissions",
              "post_discharge_ed_visits"):
    measure_query(_name, [YEAR], kpi_sql(_name, f"CAST(sum({_name}) AS BIGINT)"))
for _name in ("readmission_cost", "medical_cost", "payer_paid", "patient_responsibility"):
    measure_query(_name, [YEAR], kpi_sql(_name, f"CAST(CAST(sum(CAST({_name} AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS DOUBLE)"))
for _name, _top, _bottom in (
    ("average_length_of_stay", "inpatient_days", "discharges"),
    ("readmission_rate", "readmissions", "index_admissions"),
    ("post_discharge_ed_rate", "post_discharge_ed_visits", "index_admissions"),
):
    measure_query(_name, [YEAR], kpi_sql(_name, ratio(f"sum({_top})", f"sum({_bottom})")))
measure_query("readmission_rate_benchmark", [YEAR], kpi_sql("readmission_rate_benchmark", "CAST(0.14 AS DOUBLE)"))

table("x_active_year", "SELECT year(month_start) AS year, sum(active_patients) AS months FROM x_active GROUP BY ALL")
table("x_member_year", "SELECT year(month_start) AS year, count(*) AS months FROM x_fact_member_month GROUP BY ALL")
table("x_kpi_year", """
SELECT year(month_start) AS year, sum(ed_visits) AS ed_visits, sum(CAST(payer_paid AS DECIMAL(18,2))) AS payer_paid
FROM x_kpi_monthly GROUP BY ALL""")
table("x_encounter_year", """
SELECT year(start_ts) AS year, count(DISTINCT patient_id) AS patients, sum(payer_paid) AS paid,
  sum(payer_paid) FILTER (WHERE patient_id IN (SELECT patient_id FROM x_patient_360 WHERE is_high_utilizer)) AS high_paid
FROM x_fact_encounter GROUP BY ALL""")

measure_query(
    "active_patient_months", [YEAR], "SELECT year, CAST(months AS BIGINT) AS active_patient_months FROM x_active_year"
)
measure_query("ed_visits_per_1000", [YEAR], f"""
SELECT k.year, {ratio('k.ed_visits * 12000', 'a.months')} AS ed_visits_per_1000 FROM x_kpi_year k
JOIN x_active_year a ON a.year = k.year""")
measure_query("ed_visits_per_1000", [CATEGORY], f"""
SELECT payer_category, {ratio('sum(ed_visits) * 12000', '(SELECT sum(months) FROM x_active_year)')} AS ed_visits_per_1000
FROM x_kpi_monthly GROUP BY ALL""", key="m_ed_visits_per_1000_by_payer")
measure_query("ed_visits_per_1000", [YEAR, CATEGORY], f"""
SELECT k.year, k.payer_category, {ratio('k.n * 12000', 'a.months')} AS ed_visits_per_1000
FROM (SELECT year(month_start) AS year, payer_category, sum(ed_visits) AS n FROM x_kpi_monthly GROUP BY ALL) k
JOIN x_active_year a ON a.year = k.year""", key="m_ed_visits_per_1000_by_year_and_payer")
measure_query(
    "patients_seen", [YEAR],
    "SELECT year, patients AS patients_seen FROM x_encounter_year",
)
measure_query("patients_seen", [FACILITY, QUARTER], """
SELECT facility_name, year(start_ts) || '-Q' || quarter(start_ts) AS year_quarter, count(DISTINCT patient_id) AS patients_seen
FROM x_fact_encounter LEFT JOIN x_dim_facility USING (facility_id) GROUP BY ALL""", key="m_patients_seen_by_facility_and_quarter")
measure_query("patients_seen", ["dim_payer.payer_category"], """
SELECT payer_category, count(DISTINCT patient_id) AS patients_seen
FROM x_fact_encounter LEFT JOIN x_payer USING (payer_id) WHERE year(start_ts) IN (1997, 1998) GROUP BY ALL""",
              filters={YEAR: [1997, 1998]}, key="m_patients_seen_of_two_years_by_payer")
measure_query("high_utilizers", [], """
SELECT nullif(count(*), 0) AS high_utilizers FROM x_patient_360 WHERE is_high_utilizer AND NOT is_deceased""")
measure_query("high_utilizers", [], """
SELECT nullif(count(*), 0) AS high_utilizers FROM x_patient_360 WHERE is_high_utilizer AND NOT is_deceased""",
              filters={YEAR: 1998}, key="m_high_utilizers_ignores_year")
measure_query("member_months", [YEAR], "SELECT year, months AS member_months FROM x_member_year")
measure_query("pmpm_paid", [YEAR], f"""
SELECT k.year, {ratio('k.payer_paid', 'm.months')} AS pmpm_paid FROM x_kpi_year k JOIN x_member_year m ON m.year = k.year""")
measure_query("encounter_payer_paid", [YEAR], """
SELECT year, CAST(paid AS DOUBLE) AS encounter_payer_paid FROM x_encounter_year WHERE paid IS NOT NULL""")
measure_query("cost_per_patient", [YEAR], f"""
SELECT year, {ratio('paid', 'patients')} AS cost_per_patient FROM x_encounter_year WHERE paid IS NOT NULL""")
measure_query("high_utilizer_share_of_cost", [YEAR], f"""
SELECT year, {ratio('high_paid', 'paid')} AS high_utilizer_share_of_cost FROM x_encounter_year WHERE high_paid IS NOT NULL""")
measure_query("high_risk_patients", [], """
SELECT nullif(count(*), 0) AS high_risk_patients FROM x_patient_360 WHERE latest_risk_tier = 'High' AND NOT is_deceased""")
measure_query("worklist_patients", [], "SELECT nullif(count(*), 0) AS worklist_patients FROM x_worklist")
measure_query("scored_discharges", [YEAR], """
SELECT year(discharge_date) AS year, count(*) AS scored_discharges FROM x_fact_index_admission WHERE follow_up_complete
GROUP BY ALL""")
measure_query("readmission_rate_scored", ["fact_index_admission.risk_tier"], f"""
SELECT * FROM (SELECT risk_tier,
  {ratio('nullif(count(*) FILTER (WHERE is_readmitted_30_days), 0)', 'count(*)')} AS readmission_rate_scored
FROM x_fact_index_admission WHERE follow_up_complete GROUP BY ALL) WHERE readmission_rate_scored IS NOT NULL""")

# ---- report pages ---------------------------------------------------------------------------------

KPI_TOTALS = f"""
  CAST(sum(admissions) AS BIGINT) AS admissions, {ratio('sum(readmissions)', 'sum(index_admissions)')} AS readmission_rate,
  {ratio('sum(inpatient_days)', 'sum(discharges)')} AS average_length_of_stay,
  {ratio('sum(ed_visits) * 12000', '(SELECT sum(months) FROM x_active_year)')} AS ed_visits_per_1000,
  {ratio('sum(post_discharge_ed_visits)', 'sum(index_admissions)')} AS post_discharge_ed_rate,
  CAST(sum(CAST(payer_paid AS DECIMAL(18,2))) AS DOUBLE) AS payer_paid,
  {ratio('sum(CAST(payer_paid AS DECIMAL(18,2)))', '(SELECT sum(months) FROM x_member_year)')} AS pmpm_paid,
  (SELECT nullif(count(*), 0) FROM x_patient_360 WHERE latest_risk_tier = 'High' AND NOT is_deceased) AS high_risk_patients"""


def report_query(name: str, sql: str):
    def add(fn):
        query(name, sql)(lambda spark, sf_dir: fn(lake(spark, sf_dir)))
        return fn
    return add


report_query("v01_executive_cards", f"SELECT {KPI_TOTALS} FROM x_kpi_monthly")(reports.executive_cards)

report_query("v02_readmission_by_quarter", f"""
SELECT year(month_start) || '-Q' || quarter(month_start) AS year_quarter,
  {ratio('sum(readmissions)', 'sum(index_admissions)')} AS readmission_rate,
  CAST(0.14 AS DOUBLE) AS readmission_rate_benchmark FROM x_kpi_monthly GROUP BY ALL""")(reports.readmission_by_quarter)

report_query("v03_admissions_by_condition", """
SELECT condition_group, CAST(sum(admissions) AS BIGINT) AS admissions, CAST(sum(readmissions) AS BIGINT) AS readmissions
FROM x_kpi_monthly GROUP BY ALL""")(reports.admissions_by_condition)

report_query("v04_admissions_by_facility", """
SELECT f.facility_name, CAST(sum(admissions) AS BIGINT) AS admissions FROM x_kpi_monthly k
LEFT JOIN x_dim_facility f ON f.facility_id = k.facility_id GROUP BY ALL""")(reports.admissions_by_facility)

PAID = "sum(CAST(payer_paid AS DECIMAL(18,2)))"
report_query("v05_paid_share", f"""
SELECT payer_category, CAST({PAID} AS DOUBLE) AS payer_paid,
  CAST({PAID} AS DOUBLE) / CAST((SELECT {PAID} FROM x_kpi_monthly) AS DOUBLE) AS share
FROM x_kpi_monthly GROUP BY ALL""")(reports.paid_share_by_category)

report_query("v06_cost_cards", f"""
SELECT k.*, e.*, h.* FROM (
  SELECT CAST(sum(CAST(medical_cost AS DECIMAL(18,2))) AS DOUBLE) AS medical_cost, CAST({PAID} AS DOUBLE) AS payer_paid,
    CAST(sum(CAST(patient_responsibility AS DECIMAL(18,2))) AS DOUBLE) AS patient_responsibility,
    CAST(sum(CAST(readmission_cost AS DECIMAL(18,2))) AS DOUBLE) AS readmission_cost FROM x_kpi_monthly) k, (
  SELECT {ratio('sum(payer_paid)', 'count(DISTINCT patient_id)')} AS cost_per_patient,
    {ratio('sum(payer_paid) FILTER (WHERE patient_id IN (SELECT patient_id FROM x_patient_360 WHERE is_high_utilizer))',
           'sum(payer_paid)')} AS high_utilizer_share_of_cost
  FROM x_fact_encounter WHERE CAST(start_ts AS DATE) BETWEEN DATE '1996-01-01' AND DATE '2000-12-31') e, (
  SELECT nullif(count(*), 0) AS high_utilizers FROM x_patient_360 WHERE is_high_utilizer AND NOT is_deceased) h""")(reports.cost_cards)

report_query("v07_visits_by_month", """
SELECT strftime(month_start, '%Y-%m') AS year_month, CAST(sum(admissions) AS BIGINT) AS admissions,
  CAST(sum(ed_visits) AS BIGINT) AS ed_visits FROM x_kpi_monthly GROUP BY ALL""")(reports.visits_by_month)

COST = "CAST(sum(CAST(medical_cost AS DECIMAL(18,2))) AS DOUBLE) AS medical_cost"
report_query("v08_cost_by_condition", f"SELECT condition_group, {COST} FROM x_kpi_monthly GROUP BY ALL")(
    reports.cost_by_condition)
report_query("v08_cost_by_facility", f"""
SELECT f.facility_name, {COST} FROM x_kpi_monthly k LEFT JOIN x_dim_facility f ON f.facility_id = k.facility_id
GROUP BY ALL""")(reports.cost_by_facility)

report_query("v09_paid_by_category", f"""
SELECT payer_category, CAST({PAID} AS DOUBLE) AS payer_paid,
  CAST(sum(CAST(patient_responsibility AS DECIMAL(18,2))) AS DOUBLE) AS patient_responsibility
FROM x_kpi_monthly GROUP BY ALL""")(reports.paid_by_category)

report_query("v10_paid_by_provider", """
SELECT p.provider_name, CAST(sum(e.payer_paid) AS DOUBLE) AS encounter_payer_paid FROM x_fact_encounter e
LEFT JOIN x_provider p ON p.provider_id = e.provider_id
WHERE CAST(e.start_ts AS DATE) BETWEEN DATE '1996-01-01' AND DATE '2000-12-31'
GROUP BY ALL HAVING sum(e.payer_paid) IS NOT NULL""")(reports.paid_by_provider)

report_query("v11_patient_summary", """
SELECT patient_id, age, sex, current_payer_name, latest_risk_tier, latest_lace_score, visits_12_months,
  inpatient_admissions_12_months, ed_visits_12_months, medical_cost_12_months, active_medication_count, is_high_utilizer,
  chronic_conditions FROM x_patient_360""")(reports.patient_summary)

report_query("v12_timeline", """
SELECT patient_id, CAST(event_ts AS VARCHAR) AS event_ts, event_category, event_type, description, code, amount
FROM x_timeline""")(reports.patient_events)
report_query("v12_diagnoses", """
SELECT patient_id, CAST(start_date AS VARCHAR) AS start_date, description, icd10cm_code, is_active
FROM x_fact_condition""")(reports.patient_diagnoses)
report_query("v12_labs", """
SELECT patient_id, CAST(result_ts AS VARCHAR) AS result_ts, test_name, value_numeric, units, abnormal_flag
FROM x_fact_lab_result""")(reports.patient_labs)
report_query("v12_medications", """
SELECT patient_id, CAST(start_ts AS VARCHAR) AS start_ts, description, is_active FROM x_medication""")(
    reports.patient_medications)

report_query("v13_worklist", """
SELECT worklist_rank, patient_name, age, facility_name, CAST(discharge_date AS VARCHAR) AS discharge_date,
  days_since_discharge, reason_description, lace_score, risk_tier, top_risk_drivers, follow_up_status
FROM x_worklist""")(reports.worklist)

report_query("v14_readmission_by_tier", f"""
SELECT risk_tier, {ratio('count(*) FILTER (WHERE is_readmitted_30_days)', 'count(*)')} AS readmission_rate_scored
FROM x_fact_index_admission WHERE follow_up_complete GROUP BY ALL
HAVING count(*) FILTER (WHERE is_readmitted_30_days) > 0""")(reports.readmission_by_tier)

report_query("v15_index_stays", """
SELECT i.encounter_id, CAST(i.discharge_date AS VARCHAR) AS discharge_date, p.patient_name, i.reason_description,
  i.lace_score, i.risk_tier, i.is_readmitted_30_days FROM x_fact_index_admission i
JOIN x_dim_patient p ON p.patient_id = i.patient_id""")(reports.index_stays_with_outcome)

report_query("v16_care_cards", f"""
SELECT (SELECT nullif(count(*), 0) FROM x_worklist) AS worklist_patients,
  (SELECT nullif(count(*), 0) FROM x_patient_360 WHERE latest_risk_tier = 'High' AND NOT is_deceased) AS high_risk_patients,
  count(*) AS scored_discharges,
  {ratio('count(*) FILTER (WHERE is_readmitted_30_days)', 'count(*)')} AS readmission_rate_scored
FROM x_fact_index_admission WHERE follow_up_complete""")(reports.care_cards)

for _key, _table, _column, _source in (
    ("payer", "kpi_monthly", "payer_category", "x_kpi_monthly"),
    ("condition", "kpi_monthly", "condition_group", "x_kpi_monthly"),
    ("patient", "dim_patient", "patient_name", "x_dim_patient"),
    ("tier", "care_management_worklist", "risk_tier", "x_worklist"),
):
    report_query(f"v17_slicer_{_key}", f"SELECT DISTINCT {_column} FROM {_source} WHERE {_column} IS NOT NULL")(
        lambda t, table=_table, column=_column: reports.slicer(t, table, column)
    )

report_query("v17_slicer_year", """
SELECT DISTINCT year FROM x_dim_date WHERE date IN (SELECT CAST(start_ts AS DATE) FROM x_fact_encounter)""")(
    lambda t: reports.slicer(t, "dim_date", "year", used_in="fact_encounter")
)

# The questions with their filter: one patient, and a worklist cut by tier or condition.
ONE = "7"  # a customer with orders at every scale
_WORKLIST = """
SELECT worklist_rank, patient_name, age, facility_name, CAST(discharge_date AS VARCHAR) AS discharge_date,
  days_since_discharge, reason_description, lace_score, risk_tier, top_risk_drivers, follow_up_status FROM x_worklist"""
report_query("v11_one_patient", f"""
SELECT patient_id, age, sex, current_payer_name, latest_risk_tier, latest_lace_score, visits_12_months,
  inpatient_admissions_12_months, ed_visits_12_months, medical_cost_12_months, active_medication_count, is_high_utilizer,
  chronic_conditions FROM x_patient_360 WHERE patient_id = '{ONE}'""")(lambda t: reports.patient_summary(t, ONE))
report_query("v12_one_timeline", f"""
SELECT patient_id, CAST(event_ts AS VARCHAR) AS event_ts, event_category, event_type, description, code, amount
FROM x_timeline WHERE patient_id = '{ONE}'""")(lambda t: reports.patient_events(t, ONE))
report_query("v12_one_diagnoses", f"""
SELECT patient_id, CAST(start_date AS VARCHAR) AS start_date, description, icd10cm_code, is_active
FROM x_fact_condition WHERE patient_id = '{ONE}'""")(lambda t: reports.patient_diagnoses(t, ONE))
report_query("v12_one_labs", f"""
SELECT patient_id, CAST(result_ts AS VARCHAR) AS result_ts, test_name, value_numeric, units, abnormal_flag
FROM x_fact_lab_result WHERE patient_id = '{ONE}'""")(lambda t: reports.patient_labs(t, ONE))
report_query("v12_one_medications", f"""
SELECT patient_id, CAST(start_ts AS VARCHAR) AS start_ts, description, is_active FROM x_medication
WHERE patient_id = '{ONE}'""")(lambda t: reports.patient_medications(t, ONE))
report_query("v13_worklist_of_a_tier", f"{_WORKLIST} WHERE risk_tier = 'Medium'")(lambda t: reports.worklist(t, tier="Medium"))
report_query("v13_worklist_of_a_condition", f"{_WORKLIST} WHERE condition_group = 'HF'")(lambda t: reports.worklist(t, condition="HF"))

# A blank group in a ratio, and two fields of one name.
report_query("m_cost_by_specialty_and_class", f"""
SELECT p.specialty, e.encounter_class, {ratio('sum(e.payer_paid)', 'count(DISTINCT e.patient_id)')} AS cost_per_patient
FROM x_fact_encounter e LEFT JOIN x_provider p ON p.provider_id = e.provider_id GROUP BY ALL
HAVING sum(e.payer_paid) IS NOT NULL""")(
    lambda t: measure(["cost_per_patient"], t, ["dim_provider.specialty", "fact_encounter.encounter_class"])
)
report_query("m_patients_seen_by_two_states", """
SELECT p.state AS dim_patient_state, f.state AS dim_facility_state, count(DISTINCT e.patient_id) AS patients_seen
FROM x_fact_encounter e LEFT JOIN x_dim_patient p ON p.patient_id = e.patient_id
LEFT JOIN x_dim_facility f ON f.facility_id = e.facility_id GROUP BY ALL""")(
    lambda t: measure(["patients_seen"], t, ["dim_patient.state", "dim_facility.state"])
)

report_query("v17_sliced_report", """
SELECT f.facility_name, CAST(sum(admissions) AS BIGINT) AS admissions FROM x_kpi_monthly k
LEFT JOIN x_dim_facility f ON f.facility_id = k.facility_id
WHERE year(month_start) IN (1998, 1999) AND payer_category = 'Medicare' GROUP BY ALL""")(
    lambda t: reports.admissions_by_facility(t, {YEAR: [1998, 1999], CATEGORY: "Medicare"})
)

report_query("v18_in_period", """
SELECT year(start_ts) AS year, count(DISTINCT patient_id) AS patients_seen FROM x_fact_encounter
WHERE CAST(start_ts AS DATE) BETWEEN DATE '1996-01-01' AND DATE '2000-12-31' GROUP BY ALL""")(
    lambda t: measure(["patients_seen"], t, [YEAR], reports.IN_PERIOD)
)
