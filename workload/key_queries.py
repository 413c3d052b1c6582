"""Picking rows and keys (U), code mapping (J) and calendar columns (D03, D04, F08, K04)."""

from __future__ import annotations

from pyspark.sql import functions as F

from care_lake.functions.calendar import age_at, age_as_of, age_band, auto_calendar, date_key, month_spine
from care_lake.functions.clean import strip_suffix, surrogate_key
from care_lake.operators import dedup, lookups
from care_lake.operators.episodes import not_followed_by
from care_lake.plans import admissions
from care_lake.settings import ADMISSION_AFTER_ED
from workload.lookups import lookup_table
from workload.oracle_tables import AS_OF, age
from workload.registry import query
from workload.standin import PERIOD, lake, read

LATEST_LINE = ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"]


@query("u01_latest_by", """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey, l_quantity, CAST(l_shipdate AS VARCHAR) AS l_shipdate FROM x_line""")
def u01(spark, sf_dir):
    lines = read(spark, sf_dir, "lineitem")
    newest = dedup.latest_by(lines, ["l_orderkey", "l_linenumber"], [F.col(c).desc() for c in LATEST_LINE])
    return newest.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_shipdate")


@query("u02_surrogate_key", """
SELECT o_orderkey, sha256(concat_ws('|', CAST(o_custkey AS VARCHAR), CASE WHEN o_orderstatus <> 'O' THEN o_orderpriority
  END, o_orderstatus)) AS id FROM orders""")
def u02(spark, sf_dir):
    optional = F.when(F.col("o_orderstatus") != "O", F.col("o_orderpriority"))
    return read(spark, sf_dir, "orders").withColumn("optional", optional).select(
        "o_orderkey", surrogate_key("o_custkey", "optional", "o_orderstatus").alias("id")
    )


@query("u03_null_safe_key", """
SELECT o_orderkey, sha256(concat_ws('|', CAST(o_custkey AS VARCHAR),
  CASE WHEN o_orderstatus <> 'O' THEN o_orderpriority ELSE '' END, o_orderstatus)) AS id FROM orders""")
def u03(spark, sf_dir):
    optional = F.when(F.col("o_orderstatus") != "O", F.col("o_orderpriority"))
    return read(spark, sf_dir, "orders").withColumn("optional", optional).select(
        "o_orderkey",
        surrogate_key("o_custkey", "optional", "o_orderstatus", null_as={"optional": ""}).alias("id"),
    )


@query("u04_exact_duplicates", """
SELECT l_returnflag, l_linestatus, count(*) AS distinct_values FROM (
  SELECT DISTINCT l_returnflag, l_linestatus, l_orderkey, l_linenumber, l_quantity FROM lineitem) GROUP BY ALL""")
def u04(spark, sf_dir):
    value = ["l_returnflag", "l_linestatus", "l_orderkey", "l_linenumber", "l_quantity"]
    lines = read(spark, sf_dir, "lineitem").select(*value)
    return dedup.latest_by(lines, value).groupBy("l_returnflag", "l_linestatus").agg(
        F.count("*").alias("distinct_values")
    )


@query("u05_union_sources", """
SELECT 'customer' AS source_system, CAST(c_custkey AS VARCHAR) AS id, c_name AS name, c_mktsegment AS segment FROM customer
UNION ALL SELECT 'supplier', CAST(s_suppkey AS VARCHAR), s_name, NULL FROM supplier""")
def u05(spark, sf_dir):
    customers = read(spark, sf_dir, "customer").selectExpr(
        "'customer' as source_system", "cast(c_custkey as string) as id", "c_name as name", "c_mktsegment as segment"
    )
    suppliers = read(spark, sf_dir, "supplier").selectExpr(
        "s_name as name", "'supplier' as source_system", "cast(s_suppkey as string) as id"
    )
    return dedup.union_sources(customers, suppliers)


@query("u06_pick_best", """
SELECT p_type, p_brand, p_name, CAST(p_size AS BIGINT) AS p_size FROM part QUALIFY row_number() OVER (PARTITION BY p_type
  ORDER BY part.p_size DESC, p_brand = 'Brand#5', p_name, p_partkey) = 1""")
def u06(spark, sf_dir):
    order = [F.col("p_size").desc(), F.col("p_brand") == "Brand#5", F.col("p_name"), F.col("p_partkey")]
    return dedup.pick_best(read(spark, sf_dir, "part"), ["p_type"], order).select(
        "p_type", "p_brand", "p_name", "p_size"
    )


@query("u07_asof_interval", f"""
SELECT patient_id, payer_id, member_id FROM x_coverage WHERE start_date <= {AS_OF}
QUALIFY row_number() OVER (PARTITION BY patient_id ORDER BY
  CASE WHEN coalesce(end_date, DATE '9999-12-31') >= {AS_OF} THEN 0 ELSE 1 END, start_date DESC, payer_id) = 1""")
def u07(spark, sf_dir):
    return dedup.asof_interval(
        lake(spark, sf_dir)["coverage"], "patient_id", "start_date", "end_date", PERIOD.as_of_col, ["payer_id"]
    ).select("patient_id", "payer_id", "member_id")


@query("u08_distinct_pairs", "SELECT DISTINCT code, words AS description FROM x_procedure_text")
def u08(spark, sf_dir):
    procedures = lake(spark, sf_dir)["procedures"]
    return procedures.select(F.col("CODE").alias("code"), strip_suffix("DESCRIPTION").alias("description")).distinct()


@query("j01_map_code", """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, p_name, p_type FROM lineitem LEFT JOIN part ON p_partkey = l_partkey""")
def j01(spark, sf_dir):
    lines = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return lookups.map_code(
        lines, read(spark, sf_dir, "part"), "l_partkey", "p_partkey", {"p_name": "p_name", "p_type": "p_type"}
    )


@query("j02_reason_code", """
SELECT reason_icd10cm_code, reason_condition_group, count(*) AS encounters FROM x_encounter GROUP BY ALL""")
def j02(spark, sf_dir):
    return lake(spark, sf_dir)["encounter"].groupBy("reason_icd10cm_code", "reason_condition_group").agg(
        F.count("*").alias("encounters")
    )


@query("j03_provenance_tag", """
SELECT source_system, icd10_source, map_quality, count(*) AS conditions FROM x_condition GROUP BY ALL""")
def j03(spark, sf_dir):
    return lake(spark, sf_dir)["condition"].groupBy("source_system", "icd10_source", "map_quality").agg(
        F.count("*").alias("conditions")
    )


@query("j04_map_with_rules", """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, p.code, c.billing_code, c.service_category, c.code_mapping
FROM x_procedure_text p LEFT JOIN x_procedure_code c ON c.code = p.code""")
def j04(spark, sf_dir):
    text = (
        "case l_partkey % 12 when 4 then 'red ring (procedure)' when 5 then 'blue widget (procedure)' when 6 then"
        " case when l_linenumber > 3 then 'small gear' else 'tiny gear' end when 7 then 'small thing' when 8 then"
        " 'plain thing' when 9 then 'Big Widget and bolt' else 'thing' end"
    )
    lines = read(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "l_partkey", "concat('p', l_partkey % 12) as code", f"{text} as text"
    )
    return lookups.map_with_rules(
        lines, "code", "text", lookup_table(spark, "procedure_map"), "snomed_code",
        lookup_table(spark, "procedure_rules"), {"cpt_hcpcs": "billing_code", "service_category": "service_category"},
    ).drop("text")


@query("j05_first_matching_rule", """
SELECT p_name, CASE WHEN p_name LIKE '%ring%' OR p_name LIKE '%bolt%' THEN 'nonbillable'
  WHEN lower(p_name) LIKE '%widget%' OR p_name LIKE '%gear%' THEN 'radiology' ELSE 'lab' END AS service_category
FROM (SELECT DISTINCT p_name FROM part) WHERE p_name LIKE '%ring%' OR p_name LIKE '%bolt%'
  OR lower(p_name) LIKE '%widget%' OR p_name LIKE '%gear%' OR p_name LIKE 'small%'""")
def j05(spark, sf_dir):
    parts = read(spark, sf_dir, "part").withColumn("text", F.col("p_name"))
    return lookups.first_matching_rule(
        parts, "p_name", "text", lookup_table(spark, "procedure_rules"), "description_regex", "priority",
        ["service_category"],
    )


@query("j06_vaccine_code", "SELECT cvx_code, cpt_code, count(*) AS doses FROM x_immunization GROUP BY ALL")
def j06(spark, sf_dir):
    return lake(spark, sf_dir)["immunization"].groupBy("cvx_code", "cpt_code").agg(F.count("*").alias("doses"))


@query("j07_two_maps", """
SELECT service_code, billing_code, count(*) AS lines FROM x_claim_transaction GROUP BY ALL""")
def j07(spark, sf_dir):
    return lake(spark, sf_dir)["claim_transaction"].groupBy("service_code", "billing_code").agg(
        F.count("*").alias("lines")
    )


@query("j08_payer_type", "SELECT payer_id, payer_type, count(*) AS periods FROM x_coverage GROUP BY ALL")
def j08(spark, sf_dir):
    return lake(spark, sf_dir)["coverage"].groupBy("payer_id", "payer_type").agg(F.count("*").alias("periods"))


@query("j09_conditional_lookup", """
SELECT event_id, CASE event_type WHEN 'view' THEN 'BASIC PANEL' WHEN 'click' THEN 'BASIC PANEL' END AS panel
FROM events""")
def j09(spark, sf_dir):
    is_lab = F.col("event_type").isin("view", "click", "purchase")
    return lookups.map_code(
        read(spark, sf_dir, "events").select("event_id", "event_type"), lookup_table(spark, "lab_panels"),
        "event_type", "loinc_code", {"panel_name": "panel"}, when=is_lab,
    ).select("event_id", "panel")


@query("j10_abnormal_flag", """
SELECT event_type, CASE event_type
    WHEN 'view' THEN CASE WHEN value < 2 THEN 'critical_low' WHEN value > 120 THEN 'critical_high' WHEN value < 10 THEN 'low'
      WHEN value > 60 THEN 'high' ELSE 'normal' END
    WHEN 'click' THEN CASE WHEN value > 50 THEN 'high' ELSE 'normal' END
    WHEN 'signup' THEN CASE WHEN value < 1 THEN 'critical_low' WHEN value > 200 THEN 'critical_high'
      WHEN value < 5 THEN 'low' WHEN value > 90 THEN 'high' ELSE 'normal' END END AS flag,
  count(*) AS results FROM events GROUP BY ALL""")
def j10(spark, sf_dir):
    bounds = ["reference_low", "reference_high", "critical_low", "critical_high"]
    ranged = lookups.map_code(
        read(spark, sf_dir, "events"), lookup_table(spark, "lab_ranges"), "event_type", "loinc_code",
        {"loinc_code": "known", **{b: b for b in bounds}},
    )
    flag = lookups.abnormal_flag(
        F.col("value"), *[F.col(b).try_cast("double") for b in bounds], F.col("known").isNotNull()
    )
    return ranged.withColumn("flag", flag).groupBy("event_type", "flag").agg(F.count("*").alias("results"))


@query("j11_unpivot_codes", "SELECT 'cl' || o_orderkey AS claim_id, CAST(position AS BIGINT) AS position, code FROM x_claim_dx")
def j11(spark, sf_dir):
    return lookups.unpivot_codes(_claims(spark, sf_dir), "claim_id", [f"DIAGNOSIS{i}" for i in range(1, 9)])


def _claims(spark, sf_dir):
    return dedup.latest_by(lake(spark, sf_dir)["claims"], ["Id"]).withColumnRenamed("Id", "claim_id")


def _coded_claims(spark, sf_dir):
    codes = lookups.unpivot_codes(_claims(spark, sf_dir), "claim_id", [f"DIAGNOSIS{i}" for i in range(1, 9)])
    return lookups.map_code(
        codes, lookup_table(spark, "condition_map"), "code", "snomed_code", {"icd10cm_code": "icd10cm_code"}
    )


@query("j12_first_mapped", """
SELECT claim_id, principal_diagnosis_snomed_code AS code, principal_diagnosis_icd10cm_code AS icd10cm_code FROM x_claim
WHERE diagnosis_snomed_codes IS NOT NULL""")
def j12(spark, sf_dir):
    return lookups.first_mapped(
        _coded_claims(spark, sf_dir), "claim_id", "position", "icd10cm_code", ["code", "icd10cm_code"]
    )


@query("j13_ordered_lists", """
SELECT claim_id, diagnosis_snomed_codes AS codes FROM x_claim WHERE diagnosis_snomed_codes IS NOT NULL""")
def j13(spark, sf_dir):
    return lookups.ordered_distinct_list(_coded_claims(spark, sf_dir), "claim_id", "position", "code", "codes")


@query("j14_band_lookup", """
SELECT CAST(l_linenumber AS BIGINT) AS l_linenumber, count(*) AS lines, CAST(sum(CASE WHEN l_quantity > 13 THEN 7 WHEN l_quantity > 6 THEN 5
  WHEN l_quantity > 3 THEN 4 ELSE l_quantity END) AS BIGINT) AS points FROM lineitem GROUP BY ALL""")
def j14(spark, sf_dir):
    days = read(spark, sf_dir, "lineitem").selectExpr("l_linenumber", "cast(l_quantity as int) as days")
    scored = lookups.band_lookup(days, lookup_table(spark, "lace_points"), "L", "days", "points")
    return scored.groupBy("l_linenumber").agg(F.count("*").alias("lines"), F.sum("points").alias("points"))


@query("j15_match_rules", "SELECT encounter_id, planned_category AS category FROM x_planned")
def j15(spark, sf_dir):
    t = lake(spark, sf_dir)
    return lookups.match_rules(
        admissions.stays(t), t["procedure"], t["planned_rules"], "encounter_id",
        {"encounter_code": "encounter_type_code", "reason_code": "reason_snomed_code"}, "procedure_code", "snomed_code",
    )


@query("j16_not_followed_by", "SELECT encounter_id, patient_id, CAST(start_ts AS VARCHAR) AS start_ts FROM x_ed_alone")
def j16(spark, sf_dir):
    t = lake(spark, sf_dir)
    return not_followed_by(
        admissions.ed_visits(t), admissions.stays(t), key="patient_id", ts="start_ts", other_ts="start_ts",
        seconds=ADMISSION_AFTER_ED,
    ).select("encounter_id", "patient_id", "start_ts")


@query("j17_dim_enrichment", """
SELECT f.facility_name, coalesce(y.payer_category, 'Unknown') AS payer_category, count(*) AS encounters
FROM x_fact_encounter e LEFT JOIN x_dim_facility f ON f.facility_id = e.facility_id
LEFT JOIN x_payer y ON y.payer_id = e.payer_id GROUP BY ALL""")
def j17(spark, sf_dir):
    t = lake(spark, sf_dir)
    named = lookups.map_code(
        t["fact_encounter"], t["dim_facility"], "facility_id", "facility_id", {"facility_name": "facility_name"}
    )
    paid = lookups.map_code(named, t["dim_payer"], "payer_id", "payer_id", {"payer_category": "category"})
    return paid.groupBy(
        "facility_name", F.coalesce("category", F.lit("Unknown")).alias("payer_category")
    ).agg(F.count("*").alias("encounters"))


@query("d03_age_at", f"""
SELECT c_custkey, {age("CAST(o AS DATE)", "born")} AS age FROM (
  SELECT c_custkey, DATE '1925-01-01' + CAST(floor(c_acctbal * 3) AS INTEGER) AS born, o_orderdate AS o
  FROM customer JOIN orders ON o_custkey = c_custkey)""")
def d03(spark, sf_dir):
    people = read(spark, sf_dir, "customer").selectExpr(
        "c_custkey", "date_add(date'1925-01-01', cast(floor(c_acctbal * 3) as int)) as born"
    )
    visits = read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderdate")
    return visits.join(people, "c_custkey").select(
        "c_custkey", age_at("born", F.col("o_orderdate").cast("date")).alias("age")
    )


@query("d04_age_band", "SELECT age_band, min(age) AS youngest, max(age) AS oldest, count(*) AS people FROM x_dim_patient GROUP BY ALL")
def d04(spark, sf_dir):
    aged = lake(spark, sf_dir)["patient"].withColumn("age", age_as_of("birth_date", "death_date", PERIOD))
    return aged.groupBy(age_band("age").alias("age_band")).agg(
        F.min("age").alias("youngest"), F.max("age").alias("oldest"), F.count("*").alias("people")
    )


@query("f08_date_key", """
SELECT CAST(strftime(o_orderdate, '%Y%m%d') AS BIGINT) AS date_key, count(*) AS orders FROM orders GROUP BY ALL""")
def f08(spark, sf_dir):
    return read(spark, sf_dir, "orders").groupBy(date_key("o_orderdate").alias("date_key")).agg(
        F.count("*").alias("orders")
    )


@query("k04_month_spine", """
SELECT CAST(month_start AS VARCHAR) AS month_start, count(o_orderkey) AS orders
FROM (SELECT DISTINCT month_start FROM x_dim_date WHERE is_in_analysis_period) m
LEFT JOIN orders ON CAST(date_trunc('month', o_orderdate) AS DATE) = m.month_start GROUP BY ALL""")
def k04(spark, sf_dir):
    monthly = read(spark, sf_dir, "orders").groupBy(
        F.trunc("o_orderdate", "MM").alias("month_start")
    ).agg(F.count("*").alias("n"))
    return month_spine(spark, PERIOD).join(monthly, "month_start", "left").select(
        "month_start", F.coalesce("n", F.lit(0)).alias("orders")
    )


@query("v19_auto_calendar", """
SELECT CAST(d AS VARCHAR) AS date, year(d) AS year, month(d) AS month_no, strftime(d, '%B') AS month,
  quarter(d) AS quarter_no, 'Qtr ' || quarter(d) AS quarter, day(d) AS day
FROM (SELECT CAST(unnest(generate_series(
  (SELECT CAST(date_trunc('year', min(o_orderdate)) AS DATE) FROM orders),
  (SELECT CAST(date_trunc('year', max(o_orderdate)) + INTERVAL 1 YEAR - INTERVAL 1 DAY AS DATE) FROM orders),
  INTERVAL 1 DAY)) AS DATE) AS d)""")
def v19(spark, sf_dir):
    return auto_calendar(read(spark, sf_dir, "orders"), "o_orderdate")
