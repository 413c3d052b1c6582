"""Typing, cleaning and decoding (P) and reading of nested text (S02, S07)."""

from __future__ import annotations

from pyspark.sql import functions as F

from care_lake import fixed
from care_lake.functions import clean as c
from care_lake.functions.fhir import coding_code, extension_text, fhir_references, jpath, json_envelope, with_doc
from care_lake.operators.dedup import dedup_resources
from care_lake.plans.silver import build_patient
from workload.oracle_tables import word
from workload.registry import query
from workload.standin import FHIR_CONDITION, FHIR_ENCOUNTER, FHIR_PATIENT, lake, read


@query("p01_safe_cast", """
SELECT o_orderkey, TRY_CAST(left(o_orderpriority, 1) AS BIGINT) AS whole, TRY_CAST(o_orderpriority AS DOUBLE) AS bad,
  CAST(TRY_CAST(strftime(o_orderdate, '%Y-%m-%d') AS DATE) AS VARCHAR) AS day,
  CAST(TRY_CAST(o_orderstatus || '1' AS DATE) AS VARCHAR) AS no_day, CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DOUBLE) AS price,
  CAST(o_orderdate AS VARCHAR) AS at
FROM orders""")
def p01(spark, sf_dir):
    return read(spark, sf_dir, "orders").select(
        "o_orderkey",
        c.safe_cast(F.substring("o_orderpriority", 1, 1), "int").alias("whole"),
        c.safe_cast("o_orderpriority", "double").alias("bad"),
        c.safe_cast(F.date_format("o_orderdate", "yyyy-MM-dd"), "date").alias("day"),
        c.safe_cast(F.concat("o_orderstatus", F.lit("1")), "date").alias("no_day"),
        c.money(F.col("o_totalprice").cast("string")).alias("price"),
        c.safe_cast(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'"), "timestamp").alias("at"),
    )


@query("p02_ts_to_date", "SELECT event_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS day FROM events")
def p02(spark, sf_dir):
    return read(spark, sf_dir, "events").select("event_id", c.ts_to_date(F.col("ts").cast("string")).alias("day"))


@query("p03_strip_digits", """
SELECT c_custkey, regexp_replace(c_name, '[0-9]', '', 'g') AS name FROM customer""")
def p03(spark, sf_dir):
    return read(spark, sf_dir, "customer").select("c_custkey", c.strip_digits("c_name").alias("name"))


@query("p04_strip_suffix", """
SELECT p_partkey, p_name || ' (old) x' AS kept, p_name || CASE WHEN p_size > 25 THEN ' (big)' ELSE '' END AS cut
FROM part""")
def p04(spark, sf_dir):
    size = F.when(F.col("p_size") > 25, " (big)").otherwise("")
    return read(spark, sf_dir, "part").select(
        "p_partkey",
        c.strip_suffix(F.concat("p_name", F.lit(" (old) x"))).alias("kept"),
        c.strip_suffix(F.concat("p_name", size, F.lit("  ("), "p_type", F.lit(")"))).alias("cut"),
    )


@query("p05_squeeze_ws", "SELECT p_partkey, p_name || ' ' || p_brand || ' ' || p_type AS text FROM part")
def p05(spark, sf_dir):
    text = F.concat("p_name", F.lit("  \t "), "p_brand", F.lit("\n\n"), "p_type")
    return read(spark, sf_dir, "part").select("p_partkey", c.squeeze_ws(text).alias("text"))


@query("p06_title", f"SELECT c_custkey, {word('c_mktsegment')} AS segment FROM customer")
def p06(spark, sf_dir):
    return read(spark, sf_dir, "customer").select(
        "c_custkey", c.title(F.trim(F.concat(F.lit("  "), F.lower("c_mktsegment"), F.lit(" ")))).alias("segment")
    )


@query("p07_decode", """
SELECT o_orderkey, CASE o_orderstatus WHEN 'P' THEN 'Inpatient' WHEN 'F' THEN 'Emergency' END AS setting
FROM orders""")
def p07(spark, sf_dir):
    status = c.decode("o_orderstatus", {"P": "inpatient", "F": "emergency", "O": "unheard of"})
    return read(spark, sf_dir, "orders").select(
        "o_orderkey", c.decode(status, fixed.CARE_SETTING).alias("setting")
    )


@query("p08_decode_default", """
SELECT o_orderkey, CASE o_orderstatus WHEN 'P' THEN 'Married' WHEN 'F' THEN 'Single' ELSE 'Unknown' END AS marital
FROM orders""")
def p08(spark, sf_dir):
    code = c.decode("o_orderstatus", {"P": "M", "F": "S"})
    return read(spark, sf_dir, "orders").select(
        "o_orderkey", c.decode(code, fixed.MARITAL_STATUS, F.lit("Unknown")).alias("marital")
    )


@query("p09_null_if", """
SELECT o_orderkey, CASE WHEN o_orderstatus <> 'O' THEN o_orderstatus END AS status FROM orders""")
def p09(spark, sf_dir):
    return read(spark, sf_dir, "orders").select("o_orderkey", c.null_if("o_orderstatus", "O").alias("status"))


@query("p10_is_open", "SELECT o_orderkey, o_orderstatus = 'O' AS is_active FROM orders")
def p10(spark, sf_dir):
    stop = F.when(F.col("o_orderstatus") != "O", F.col("o_orderdate"))
    return read(spark, sf_dir, "orders").withColumn("stop", stop).select(
        "o_orderkey", c.is_open("stop").alias("is_active")
    )


@query("p11_max_severity", """
SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' OR o_orderstatus = 'P' THEN 'Severe'
  WHEN o_orderpriority = '2-HIGH' THEN 'Moderate' WHEN o_orderstatus = 'F' THEN 'Mild' END AS severity FROM orders""")
def p11(spark, sf_dir):
    first = c.decode("o_orderpriority", {"1-URGENT": "SEVERE", "2-HIGH": "MODERATE"})
    second = c.decode("o_orderstatus", {"P": "SEVERE", "F": "MILD"})
    return read(spark, sf_dir, "orders").select(
        "o_orderkey", c.max_severity(fixed.SEVERITY, first, second).alias("severity")
    )


@query("p12_conditional_amount", """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey,
  CASE l_returnflag WHEN 'A' THEN CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS DOUBLE) END AS charge FROM lineitem""")
def p12(spark, sf_dir):
    return read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.when(F.col("l_returnflag") == "A", c.money(F.col("l_extendedprice").cast("string"))).alias("charge"),
    )


@query("p13_drop_sensitive", """
SELECT patient_id, first_name, last_name, city, state, zip FROM x_patient WHERE source_system = 'synthea'""")
def p13(spark, sf_dir):
    """The typed table has no column for identity papers, whatever the raw table holds."""
    raw = lake(spark, sf_dir)
    landed = raw["patients"].withColumns({"SSN": F.lit("999-00-0000"), "PASSPORT": F.lit("X1")})
    typed = build_patient({"patients": landed, "fhir_resources": raw["fhir_resources"]})
    shown = [f for f in typed.columns if f in ("ssn", "passport", "first_name", "last_name", "city", "state", "zip")]
    return typed.filter(F.col("source_system") == fixed.CSV_SYSTEM).select("patient_id", *shown)


@query("p14_not_in", """
SELECT event_type, count(*) AS events FROM events WHERE event_type IN ('purchase', 'signup') GROUP BY ALL""")
def p14(spark, sf_dir):
    """A missing code is dropped as well: it is not known to be outside the list."""
    code = c.null_if("event_type", "error")
    kept = read(spark, sf_dir, "events").withColumn("event_type", code).filter(
        ~F.col("event_type").isin("view", "click")
    )
    return kept.groupBy("event_type").agg(F.count("*").alias("events"))


@query("p15_administrative", """
SELECT o_orderpriority, count(*) FILTER (WHERE o_orderstatus = 'O' AND o_totalprice > 400000) AS administrative,
  count(*) AS encounters FROM orders GROUP BY ALL""")
def p15(spark, sf_dir):
    code = F.when((F.col("o_orderstatus") == "O") & (F.col("o_totalprice") > 400000), fixed.ADMINISTRATIVE_CODE)
    flagged = read(spark, sf_dir, "orders").withColumn("admin", F.coalesce(code, F.lit("1")) == fixed.ADMINISTRATIVE_CODE)
    return flagged.groupBy("o_orderpriority").agg(
        F.count_if("admin").alias("administrative"), F.count("*").alias("encounters")
    )


@query("p16_jpath", """
SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, json_extract_string(props, '$.k') AS k_text,
  CAST(NULL AS VARCHAR) AS missing, event_type AS second FROM events""")
def p16(spark, sf_dir):
    nested = F.to_json(F.struct(F.array(F.struct(F.lit("a").alias("x")), F.struct(F.col("event_type").alias("x"))).alias("n")))
    docs = with_doc(read(spark, sf_dir, "events").withColumn("nested", nested), "props")
    return docs.withColumn("_nested", F.try_parse_json("nested")).select(
        "event_id",
        jpath("k", "bigint").alias("k"),
        jpath("k").alias("k_text"),
        jpath("k[0].z").alias("missing"),
        jpath("n[1].x", doc="_nested").alias("second"),
    )


@query("p17_extension_text", """
SELECT s_suppkey, CASE WHEN s_nationkey % 4 <> 0 THEN 'Race ' || s_nationkey END AS race,
  CASE WHEN s_nationkey % 4 <> 0 THEN 'Not Hispanic' END AS ethnicity, CAST(NULL AS VARCHAR) AS other FROM supplier""")
def p17(spark, sf_dir):
    docs = with_doc(read(spark, sf_dir, "supplier").selectExpr("s_suppkey", f"to_json({FHIR_PATIENT}) as raw"))
    return docs.select(
        "s_suppkey",
        extension_text(fixed.RACE_EXTENSION).alias("race"),
        extension_text(fixed.ETHNICITY_EXTENSION).alias("ethnicity"),
        extension_text("us-core-birthsex").alias("other"),
    )


@query("p18_coding_code", """
SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'c' || event_id % 13 WHEN 2 THEN 'c2' END AS snomed,
  CASE event_id % 4 WHEN 1 THEN 'Z99.9' WHEN 2 THEN 'E11.9' END AS icd10 FROM events""")
def p18(spark, sf_dir):
    docs = with_doc(read(spark, sf_dir, "events").selectExpr("event_id", f"to_json({FHIR_CONDITION}) as raw"))
    return docs.select(
        "event_id",
        coding_code(fixed.SNOMED_SYSTEM).alias("snomed"),
        coding_code(fixed.ICD10CM_SYSTEM).alias("icd10"),
    )


@query("p19_ref_id", """
SELECT event_id, 'fp' || user_id % 10 AS patient_id, split_part(event_type, '/', 2) AS no_id FROM events""")
def p19(spark, sf_dir):
    docs = with_doc(read(spark, sf_dir, "events").selectExpr("event_id", "event_type", f"to_json({FHIR_ENCOUNTER}) as raw"))
    return docs.select(
        "event_id", c.ref_id(jpath("subject.reference")).alias("patient_id"), c.ref_id("event_type").alias("no_id")
    )


@query("p20_fallback", """
SELECT s_suppkey, CASE WHEN s_nationkey < 12 THEN s_name ELSE 'NATION ' || s_nationkey END AS shown,
  coalesce(CASE WHEN s_nationkey = 8 THEN true END, s_nationkey = 7) AS deceased FROM supplier""")
def p20(spark, sf_dir):
    docs = with_doc(read(spark, sf_dir, "supplier").selectExpr("*", f"to_json({FHIR_PATIENT}) as raw"))
    name = F.when(F.col("s_nationkey") < 12, F.col("s_name"))
    return docs.select(
        "s_suppkey",
        F.coalesce(name, F.concat_ws(" ", F.lit("NATION"), F.lit(None), "s_nationkey")).alias("shown"),
        F.coalesce(jpath("deceasedBoolean", "boolean"), jpath("deceasedDateTime").isNotNull()).alias("deceased"),
    )


@query("p21_ilike_case", """
SELECT event_id, CASE event_type WHEN 'click' THEN 'Inpatient' WHEN 'purchase' THEN 'Emergency' ELSE 'Outpatient' END
  AS setting FROM events""")
def p21(spark, sf_dir):
    docs = with_doc(read(spark, sf_dir, "events").selectExpr("event_id", f"to_json({FHIR_ENCOUNTER}) as raw"))
    return docs.select(
        "event_id",
        c.ilike_case(jpath("class.display"), fixed.FHIR_CARE_SETTING, fixed.FHIR_DEFAULT_SETTING).alias("setting"),
    )


@query("p22_balance", """
SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(12,2)) - CASE WHEN o_orderstatus <> 'O' THEN
  CAST(100.5 AS DECIMAL(12,2)) END AS DOUBLE) AS balance FROM orders""")
def p22(spark, sf_dir):
    paid = F.when(F.col("o_orderstatus") != "O", F.lit("100.5").cast(c.MONEY))
    priced = read(spark, sf_dir, "orders").withColumns({"cost": F.col("o_totalprice").cast(c.MONEY), "paid": paid})
    return priced.select("o_orderkey", c.balance("cost", "paid").alias("balance"))


@query("p23_null_safe_sum", """
SELECT o_orderkey, CAST(coalesce(CASE WHEN o_orderstatus = 'P' THEN CAST(o_totalprice AS DECIMAL(12,2)) END, 0)
  + CASE WHEN o_orderstatus = 'F' THEN 2 ELSE 0 END AS DOUBLE) AS outstanding FROM orders""")
def p23(spark, sf_dir):
    first = F.when(F.col("o_orderstatus") == "P", F.col("o_totalprice").cast(c.MONEY))
    second = F.when(F.col("o_orderstatus") == "F", F.lit(2).cast(c.MONEY))
    return read(spark, sf_dir, "orders").select("o_orderkey", c.null_safe_sum(first, second).alias("outstanding"))


@query("p24_text_parts", """
SELECT event_id, concat_ws(' - ', event_type, CASE WHEN value > 50 THEN 'large' END) AS optional,
  event_type || CASE WHEN value > 50 THEN ' large' END AS strict FROM events""")
def p24(spark, sf_dir):
    size = F.when(F.col("value") > 50, "large")
    return read(spark, sf_dir, "events").select(
        "event_id",
        F.concat_ws(" - ", "event_type", size).alias("optional"),
        F.concat("event_type", F.lit(" "), size).alias("strict"),
    )


@query("s02_json_envelope", """
SELECT 'fe' || event_id AS resource_id, 'Encounter' AS resource_type, CAST(NULL AS VARCHAR) AS source_last_updated
FROM events
UNION ALL SELECT NULL, NULL, NULL FROM events WHERE json_extract_string(props, '$.k') IS NOT NULL""")
def s02(spark, sf_dir):
    events = read(spark, sf_dir, "events")
    lines = events.selectExpr(f"to_json({FHIR_ENCOUNTER}) as value").unionByName(
        events.filter("get_json_object(props, '$.k') is not null").selectExpr("concat(props, ' cut') as value")
    )
    return json_envelope(lines).select("resource_id", "resource_type", "source_last_updated")


@query("s07_path_key", r"""
SELECT page_id, regexp_extract(url, 'page=([^/]+)', 1) AS raw_page,
  nullif(regexp_extract(url, 'page=([^/]+)', 1), '') AS page,
  CAST(DATE '2024-01-01' + CAST(page_id % 300 AS INTEGER) AS VARCHAR) AS extract_date, CAST(NULL AS VARCHAR) AS no_date
FROM pages""")
def s07(spark, sf_dir):
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("page_id") % 300).cast("int"))
    path = F.concat(F.lit("/x/extract_date="), day.cast("string"), F.lit("/run_id=r1/a.ndjson"))
    return read(spark, sf_dir, "pages").select(
        "page_id",
        c.path_key("url", "page", empty_as_null=False).alias("raw_page"),
        c.path_key("url", "page").alias("page"),
        c.path_key(path, "extract_date", "date").alias("extract_date"),
        c.path_key("url", "extract_date", "date").alias("no_date"),
    )


@query("s11_references", """
SELECT DISTINCT unnest(['Practitioner/fd' || user_id % 10, 'Location/fl' || event_id % 7, 'Organization/fo' || event_id % 5])
  AS reference FROM events""")
def s11(spark, sf_dir):
    encounters = lake(spark, sf_dir)["fhir_resources"].filter("resource_type = 'Encounter'")
    return fhir_references(encounters)


@query("s12_dedup_resources", """
SELECT r.resource_type, count(*) AS resources, CAST(min(r.event_id) AS BIGINT) AS lowest_event,
  CAST(sum(r.event_id) AS BIGINT) AS event_sum
FROM (SELECT event_type AS resource_type, user_id, max(event_id) AS event_id FROM events GROUP BY ALL) r
GROUP BY ALL""")
def s12(spark, sf_dir):
    """Every event is a later copy of the resource its user and type stand for."""
    rows = read(spark, sf_dir, "events").select(
        F.col("event_type").alias("resource_type"), F.col("user_id").cast("string").alias("resource_id"), "event_id"
    )
    return dedup_resources(rows, [F.col("event_id").desc()]).groupBy("resource_type").agg(
        F.count("*").alias("resources"),
        F.min("event_id").alias("lowest_event"),
        F.sum("event_id").alias("event_sum"),
    )
