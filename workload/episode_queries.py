"""Follow-ups, scores, cube records and summaries (R, K01, A)."""

from __future__ import annotations

from pyspark.sql import functions as F

from care_lake.operators import episodes, score
from care_lake.plans import admissions, kpi, patient
from care_lake.settings import FOLLOW_UP_DAYS, LOWEST_TIER, TIER_CUTS
from workload.oracle_tables import AS_OF, START
from workload.registry import query
from workload.standin import PERIOD, lake, read

DAY = 86_400


def _orders(spark, sf_dir):
    return read(spark, sf_dir, "orders").withColumn("day", F.col("o_orderdate").cast("date"))


@query("r01_stays", """
SELECT encounter_id, patient_id, CAST(admit_date AS VARCHAR) AS admit_date,
  CAST(discharge_date AS VARCHAR) AS discharge_date, length_of_stay_days, condition_group FROM x_stay""")
def r01(spark, sf_dir):
    return admissions.stays(lake(spark, sf_dir)).select(
        "encounter_id", "patient_id", "admit_date", "discharge_date", "length_of_stay_days", "condition_group"
    )


@query("r02_planned", "SELECT encounter_id, is_planned, planned_category, age_at_admission FROM x_flagged")
def r02(spark, sf_dir):
    t = lake(spark, sf_dir)
    return admissions.flag_planned(admissions.stays(t), t).select(
        "encounter_id", "is_planned", "planned_category", "age_at_admission"
    )


@query("r03_index_events", "SELECT encounter_id, patient_id, age_at_admission FROM x_index")
def r03(spark, sf_dir):
    t = lake(spark, sf_dir)
    return admissions.index_stays(admissions.flag_planned(admissions.stays(t), t), PERIOD).select(
        "encounter_id", "patient_id", "age_at_admission"
    )


@query("r04_first_followup", """
SELECT o_orderpriority, count(*) AS index_orders, count(days) AS followed, CAST(sum(days) AS BIGINT) AS days_sum
FROM (SELECT i.o_orderkey, i.o_orderpriority,
    min(datediff('day', i.o_orderdate, n.o_orderdate)) AS days
  FROM orders i LEFT JOIN orders n ON n.o_custkey = i.o_custkey AND n.o_orderstatus <> 'O'
    AND n.o_orderkey <> i.o_orderkey AND datediff('day', i.o_orderdate, n.o_orderdate) BETWEEN 1 AND 30
  WHERE i.o_orderstatus = 'P' GROUP BY ALL)
GROUP BY ALL""")
def r04(spark, sf_dir):
    """Orders as stays: the first order of the same customer 1 to 30 days later, by priority."""
    orders = _orders(spark, sf_dir).select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "day")
    followed = episodes.first_followup(
        orders.filter("o_orderstatus = 'P'"), orders.filter("o_orderstatus <> 'O'"),
        key="o_custkey", anchor_id="o_orderkey", anchor_day="day", event_id="o_orderkey", event_day="day",
        event_order="day", payload=[], days=FOLLOW_UP_DAYS, out="next_order",
    )
    days = F.datediff("next_order._on", "day")
    return followed.groupBy("o_orderpriority").agg(
        F.count("*").alias("index_orders"), F.count(days).alias("followed"), F.sum(days).alias("days_sum")
    )


HOT = "CASE WHEN o_orderkey % 3 = 0 THEN -1 ELSE o_custkey END"


def _hot_orders(spark, sf_dir):
    """Orders of which one customer owns a third."""
    return _orders(spark, sf_dir).withColumn("owner", F.expr(HOT)).select(
        "o_orderkey", "owner", "o_orderstatus", "day",
        (F.col("o_orderdate") + F.expr("make_dt_interval(0, cast(o_orderkey % 24 as int))")).alias("at"),
    )


@query("r04_hot_key", f"""
SELECT i.o_orderkey, n.o_orderkey AS next_order FROM (SELECT *, {HOT} AS owner FROM orders WHERE o_orderstatus = 'P') i
LEFT JOIN (SELECT *, {HOT} AS owner FROM orders WHERE o_orderstatus <> 'O') n ON n.owner = i.owner
  AND n.o_orderkey <> i.o_orderkey AND n.o_orderdate BETWEEN i.o_orderdate + INTERVAL 1 DAY AND i.o_orderdate + INTERVAL 30 DAY
QUALIFY row_number() OVER (PARTITION BY i.o_orderkey ORDER BY n.o_orderdate, n.o_orderkey) = 1""")
def r04_hot(spark, sf_dir):
    orders = _hot_orders(spark, sf_dir)
    return episodes.first_followup(
        orders.filter("o_orderstatus = 'P'"), orders.filter("o_orderstatus <> 'O'"),
        key="owner", anchor_id="o_orderkey", anchor_day="day", event_id="o_orderkey", event_day="day",
        event_order="day", payload=[], days=FOLLOW_UP_DAYS, out="next",
    ).select("o_orderkey", F.col("next._id").alias("next_order"))


@query("r07_hot_key", f"""
SELECT i.o_orderkey, count(n.o_orderkey) > 0 AS preceded
FROM (SELECT o_orderkey, {HOT} AS owner, o_orderdate + to_hours(o_orderkey % 24) AS at FROM orders WHERE o_orderstatus = 'P') i
LEFT JOIN (SELECT o_orderkey, {HOT} AS owner, o_orderdate + to_hours(o_orderkey % 24) AS at FROM orders
    WHERE o_orderstatus = 'F') n
  ON n.owner = i.owner AND n.at BETWEEN i.at - INTERVAL 12 HOUR AND i.at + INTERVAL 1 HOUR
GROUP BY ALL""")
def r07_hot(spark, sf_dir):
    orders = _hot_orders(spark, sf_dir)
    return episodes.has_event_within(
        orders.filter("o_orderstatus = 'P'"), orders.filter("o_orderstatus = 'F'"), key="owner", anchor_ts="at",
        event_ts="at", seconds=(-12 * 3600, 3600), out="preceded",
    ).select("o_orderkey", "preceded")


@query("r08_hot_key", f"""
SELECT i.o_orderkey, count(n.o_orderkey) AS earlier
FROM (SELECT o_orderkey, {HOT} AS owner, o_orderdate + to_hours(o_orderkey % 24) AS at FROM orders WHERE o_orderstatus = 'P') i
LEFT JOIN (SELECT o_orderkey, {HOT} AS owner, o_orderdate + to_hours(o_orderkey % 24) AS at FROM orders
    WHERE o_orderstatus = 'F') n
  ON n.owner = i.owner AND n.at >= i.at - INTERVAL 180 DAY AND n.at < i.at - INTERVAL 12 HOUR
GROUP BY ALL""")
def r08_hot(spark, sf_dir):
    orders = _hot_orders(spark, sf_dir)
    return episodes.count_between(
        orders.filter("o_orderstatus = 'P'"), orders.filter("o_orderstatus = 'F'"), key="owner", anchor_ts="at",
        event_ts="at", seconds=(-180 * DAY, -DAY // 2), out="earlier",
    ).select("o_orderkey", "earlier")


@query("r04_readmission", """
SELECT i.encounter_id, r.readmission_encounter_id, r.days_to_readmission,
  CAST(r.readmission_cost AS DOUBLE) AS readmission_cost
FROM x_index i LEFT JOIN x_readmission r ON r.encounter_id = i.encounter_id""")
def r04b(spark, sf_dir):
    t = lake(spark, sf_dir)
    flagged = admissions.flag_planned(admissions.stays(t), t)
    return admissions.with_readmission(admissions.index_stays(flagged, PERIOD), flagged).select(
        "encounter_id", "readmission_encounter_id", "days_to_readmission", "readmission_cost"
    )


@query("r05_ed_not_admitted", """
SELECT event_id FROM events e WHERE event_type = 'error' AND NOT EXISTS (SELECT 1 FROM events p
  WHERE p.user_id = e.user_id AND p.event_type = 'purchase' AND p.ts >= e.ts - INTERVAL 1 HOUR
  AND p.ts <= e.ts + INTERVAL 12 HOUR)""")
def r05(spark, sf_dir):
    """Errors of a user that no purchase accompanies."""
    events = read(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts")
    return episodes.not_followed_by(
        events.filter("event_type = 'error'"), events.filter("event_type = 'purchase'"),
        key="user_id", ts="ts", other_ts="ts", seconds=(-3600, 12 * 3600),
    ).select("event_id")


@query("r06_count_followup", """
SELECT i.o_orderkey, count(n.o_orderkey) AS later_orders FROM orders i
LEFT JOIN orders n ON n.o_custkey = i.o_custkey AND datediff('day', i.o_orderdate, n.o_orderdate) BETWEEN 1 AND 30
GROUP BY ALL""")
def r06(spark, sf_dir):
    orders = _orders(spark, sf_dir).select("o_orderkey", "o_custkey", "day")
    return episodes.count_followup(
        orders, orders, key="o_custkey", anchor_day="day", event_day="day", days=FOLLOW_UP_DAYS, out="later_orders"
    ).select("o_orderkey", "later_orders")


@query("r07_has_prior", """
SELECT event_id, EXISTS (SELECT 1 FROM events v WHERE v.user_id = e.user_id AND v.event_type = 'view'
  AND v.ts >= e.ts - INTERVAL 12 HOUR AND v.ts <= e.ts + INTERVAL 1 HOUR) AS viewed
FROM events e WHERE event_type = 'purchase'""")
def r07(spark, sf_dir):
    events = read(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts")
    return episodes.has_event_within(
        events.filter("event_type = 'purchase'"), events.filter("event_type = 'view'"),
        key="user_id", anchor_ts="ts", event_ts="ts", seconds=(-12 * 3600, 3600), out="viewed",
    ).select("event_id", "viewed")


@query("r08_count_lookback", """
SELECT e.event_id, count(v.event_id) AS earlier_views FROM events e
LEFT JOIN events v ON v.user_id = e.user_id AND v.event_type = 'view' AND v.ts >= e.ts - INTERVAL 7 DAY
  AND v.ts < e.ts - INTERVAL 12 HOUR
GROUP BY ALL""")
def r08(spark, sf_dir):
    events = read(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts")
    return episodes.count_between(
        events, events.filter("event_type = 'view'"), key="user_id", anchor_ts="ts", event_ts="ts",
        seconds=(-7 * DAY, -DAY // 2), out="earlier_views",
    ).select("event_id", "earlier_views")


@query("r08_prior_ed", """
SELECT i.encounter_id, coalesce(p.n, 0) AS ed_visits_6_months FROM x_index i
LEFT JOIN x_prior_ed p ON p.encounter_id = i.encounter_id""")
def r08b(spark, sf_dir):
    t = lake(spark, sf_dir)
    index = admissions.index_stays(admissions.flag_planned(admissions.stays(t), t), PERIOD)
    return admissions.with_prior_ed(index, admissions.ed_visits(t)).select("encounter_id", "ed_visits_6_months")


@query("r09_charlson", """
SELECT i.encounter_id, coalesce(c.score, 0) AS charlson_score FROM x_index i
LEFT JOIN x_charlson c ON c.encounter_id = i.encounter_id""")
def r09(spark, sf_dir):
    t = lake(spark, sf_dir)
    index = admissions.index_stays(admissions.flag_planned(admissions.stays(t), t), PERIOD)
    return admissions.with_charlson(index, t).select("encounter_id", "charlson_score")


@query("r10_lace", "SELECT encounter_id, lace_l, lace_a, lace_c, lace_e, lace_score FROM x_lace")
def r10(spark, sf_dir):
    t = lake(spark, sf_dir)
    inputs = t["fact_index_admission"].drop("lace_l", "lace_a", "lace_c", "lace_e", "lace_score")
    return admissions.with_lace(inputs, t["lace_points"]).select(
        "encounter_id", "lace_l", "lace_a", "lace_c", "lace_e", "lace_score"
    )


@query("r11_percentile_tier", """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, CASE WHEN r < 0.10 THEN 'High' WHEN r < 0.30 THEN 'Medium' ELSE 'Low' END AS tier
FROM (SELECT l_orderkey, l_linenumber, l_partkey, percent_rank() OVER (ORDER BY
  CASE WHEN l_quantity < 49 THEN CAST(l_quantity AS INTEGER) END DESC NULLS LAST) AS r FROM lineitem)""")
def r11(spark, sf_dir):
    lines = read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.when(F.col("l_quantity") < 49, F.col("l_quantity").cast("int")).alias("points"),
    )
    return score.percentile_tier(lines, "points", TIER_CUTS, LOWEST_TIER, "tier").drop("points")


@query("r11_score_ranks", """
SELECT DISTINCT CAST(l_quantity AS BIGINT) AS points, count(*) OVER (PARTITION BY l_quantity) AS rows,
  percent_rank() OVER (ORDER BY l_quantity DESC) AS percentile_from_top FROM lineitem""")
def r11b(spark, sf_dir):
    lines = read(spark, sf_dir, "lineitem").select(F.col("l_quantity").cast("int").alias("points"))
    return score.score_ranks(lines, "points")


@query("r11_fine_score", """
SELECT o_orderkey, CASE WHEN r < 0.10 THEN 'High' WHEN r < 0.30 THEN 'Medium' ELSE 'Low' END AS tier
FROM (SELECT o_orderkey, percent_rank() OVER (ORDER BY o_totalprice DESC NULLS LAST) AS r FROM orders)""")
def r11c(spark, sf_dir):
    """A score that differs in nearly every row."""
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return score.percentile_tier(orders, "o_totalprice", TIER_CUTS, LOWEST_TIER, "tier").drop("o_totalprice")


@query("r12_followup_complete", f"""
SELECT discharge_date <= {AS_OF} - 30 AS follow_up_complete, count(*) AS stays FROM x_index GROUP BY ALL""")
def r12(spark, sf_dir):
    index = lake(spark, sf_dir)["fact_index_admission"]
    return index.groupBy("follow_up_complete").agg(F.count("*").alias("stays"))


@query("k01_cube_records", f"""
SELECT CAST(month_start AS VARCHAR) AS month_start, count(*) FILTER (what = 'start' AND care_setting = 'Inpatient') AS admissions,
  count(*) FILTER (what = 'end') AS discharges, count(*) FILTER (what = 'index') AS index_admissions, count(*) AS records
FROM x_kpi_record WHERE month_start BETWEEN {START} AND {AS_OF} GROUP BY month_start""")
def k01(spark, sf_dir):
    t = lake(spark, sf_dir)
    records = kpi.encounter_records(t["fact_encounter"], t["dim_payer"]).unionByName(
        kpi.index_records(t["fact_index_admission"], t["dim_payer"])
    )
    return records.filter(PERIOD.contains(F.col("month_start"))).groupBy("month_start").agg(
        F.sum("admissions").alias("admissions"), F.sum("discharges").alias("discharges"),
        F.sum("index_admissions").alias("index_admissions"), F.count("*").alias("records"),
    )


@query("a01_utilization", """
SELECT patient_id, CAST(last_visit_date AS VARCHAR) AS last_visit_date, visits_12_months, inpatient_admissions_12_months,
  ed_visits_12_months, CAST(medical_cost_12_months AS DOUBLE) AS medical_cost_12_months,
  CAST(payer_paid_12_months AS DOUBLE) AS payer_paid_12_months FROM x_utilization""")
def a01(spark, sf_dir):
    return patient.utilization(lake(spark, sf_dir)["fact_encounter"], PERIOD)


@query("a02_active_chronic", "SELECT patient_id, chronic_condition_count, chronic_conditions FROM x_chronic")
def a02(spark, sf_dir):
    return patient.active_chronic(lake(spark, sf_dir)["fact_condition"], PERIOD)


@query("a03_active_medications", "SELECT patient_id, active_medication_count FROM x_active_medication")
def a03(spark, sf_dir):
    return patient.active_medications(lake(spark, sf_dir)["fact_medication"], PERIOD)


@query("a04_latest_abnormal", "SELECT patient_id, abnormal_labs_90_days, latest_abnormal_lab FROM x_labs")
def a04(spark, sf_dir):
    return patient.abnormal_labs(lake(spark, sf_dir)["fact_lab_result"], PERIOD)


@query("a05_latest_stay", """
SELECT patient_id, CAST(last_discharge_date AS VARCHAR) AS last_discharge_date, latest_lace_score, latest_risk_tier,
  readmissions_12_months FROM x_latest_stay""")
def a05(spark, sf_dir):
    return patient.latest_stay(lake(spark, sf_dir)["fact_index_admission"], PERIOD)


@query("a07_high_utilizers", """
SELECT o_custkey, o_inpatient >= 2 OR o_emergency >= 4 AS is_high_utilizer FROM (
  SELECT o_custkey, count(*) FILTER (WHERE o_orderstatus = 'P') AS o_inpatient,
    count(*) FILTER (WHERE o_orderstatus = 'F') AS o_emergency FROM orders GROUP BY ALL)""")
def a07(spark, sf_dir):
    counts = read(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        F.count_if(F.col("o_orderstatus") == "P").alias("inpatient"),
        F.count_if(F.col("o_orderstatus") == "F").alias("emergency"),
    )
    return counts.select(
        "o_custkey", patient.is_high_utilizer(F.col("inpatient"), F.col("emergency")).alias("is_high_utilizer")
    )


@query("a09_global_rank", """
SELECT o_orderkey, row_number() OVER (ORDER BY o_orderpriority DESC, o_orderdate DESC, o_orderkey) AS place FROM orders""")
def a09(spark, sf_dir):
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_orderdate")
    order = [F.col("o_orderpriority").desc(), F.col("o_orderdate").desc(), F.col("o_orderkey")]
    return score.global_rank(orders, order, "place").select("o_orderkey", "place")


@query("a10_top_reasons", "SELECT encounter_id, coalesce(top_risk_drivers, '') AS top_risk_drivers FROM x_index LEFT JOIN x_reasons USING (encounter_id)")
def a10(spark, sf_dir):
    return lake(spark, sf_dir)["fact_index_admission"].select(
        "encounter_id", patient.score_reasons().alias("top_risk_drivers")
    )
