"""Expectations, reconciliation and gates (X), ingestion (S)."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import functions as F

from care_lake.operators import quality as q
from care_lake.plans import checks
from care_lake.session import shared_folder
from care_lake.sources import landing, lookups, tables
from care_lake.streaming import ingest
from workload.registry import query
from workload.standin import lake, read


def _counts(table: str, source: str, tests: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{name}' AS expectation,"
        f" count(*) FILTER (WHERE {test}) AS passed_rows, count(*) FILTER (WHERE NOT coalesce({test}, false)) AS failed_rows"
        f" FROM {source}"
        for name, test in tests.items()
    )


@query("x01_expectations", _counts("orders", "orders", {
    "is_priced": "o_totalprice > 1000", "is_open": "nullif(o_orderstatus, 'F') = 'O'",
    "has_customer": "o_custkey IS NOT NULL",
}))
def x01(spark, sf_dir):
    """An outcome that is not known, as for status F, counts as failed."""
    return q.expect(read(spark, sf_dir, "orders"), {
        "is_priced": "o_totalprice > 1000", "is_open": "nullif(o_orderstatus, 'F') = 'O'",
        "has_customer": "o_custkey is not null",
    }, "orders")


@query("x01_bronze_expectations", " UNION ALL ".join(
    f"SELECT 'bronze.{t}' AS table_name, '{name}' AS expectation, {count} AS passed_rows, CAST(0 AS BIGINT) AS failed_rows FROM {source}"
    for t, name, count, source in [
        ("patients", "has_patient_id", "count(*) + count(*) FILTER (WHERE c_mktsegment = 'BUILDING')", "customer"),
        ("organizations", "has_organization_id", "count(*)", "nation"),
        ("providers", "has_provider_id", "count(*) + count(*) FILTER (WHERE s_nationkey < 5)", "supplier"),
        ("payers", "has_payer_id", "2 * count(*)", "region"),
        ("payer_transitions", "has_patient", "count(*) + count(*) FILTER (WHERE o_orderpriority = '2-HIGH')", "orders"),
        ("encounters", "has_encounter_id", "count(*) + count(*) FILTER (WHERE o_orderpriority = '1-URGENT')", "orders"),
        ("conditions", "has_patient", "count(*) + count(*) FILTER (WHERE o_orderpriority = '3-MEDIUM')", "orders"),
        ("procedures", "has_patient", "count(*) + count(*) FILTER (WHERE l_returnflag = 'R')", "lineitem"),
        ("observations", "has_patient", "count(*) + count(*) FILTER (WHERE event_type = 'view')", "events"),
        ("medications", "has_patient", "count(*) + count(*) FILTER (WHERE o_orderpriority = '5-LOW')", "orders"),
        ("immunizations", "has_patient", "count(*) + count(*) FILTER (WHERE c_mktsegment = 'FURNITURE')", "customer"),
        ("allergies", "has_patient", "count(*)", "customer"),
        ("claims", "has_claim_id", "count(*) + count(*) FILTER (WHERE o_orderpriority = '4-NOT SPECIFIED')", "orders"),
        ("claims_transactions", "has_claim_id", "count(*)", "lineitem"),
    ]
) + "".join(
    f" UNION ALL SELECT 'bronze.fhir_resources', '{name}',"
    " (SELECT 2 * count(*) FROM supplier) + (SELECT 2 * count(*) FROM events) + (SELECT count(*) FROM region), 0"
    for name in ("valid_json_with_type", "has_resource_id")
))
def x01b(spark, sf_dir):
    return checks.expectation_results(lake(spark, sf_dir), ["bronze"])


def _layer_sql(layer: str, sources: dict[str, str]) -> str:
    return " UNION ALL ".join(
        _counts(f"{layer}.{t}", sources.get(t, f"x_{t}"), tests) for t, tests in checks.LAYERS[layer].items()
    )


@query("x02_silver_expectations", _layer_sql("silver", {}).replace("current_date()", "current_date"))
def x02(spark, sf_dir):
    return checks.expectation_results(lake(spark, sf_dir), ["silver"])


@query("x03_gold_expectations", _layer_sql("gold", {}))
def x03(spark, sf_dir):
    return checks.expectation_results(lake(spark, sf_dir), ["gold"])


@query("x04_reconcile", """
SELECT table_name, expected_rows, actual_rows, actual_rows - expected_rows AS difference FROM (
  SELECT 'customer' AS table_name, 10 * count(DISTINCT c_nationkey) AS expected_rows, count(*) AS actual_rows FROM customer
  UNION ALL SELECT 'orders', 10 * count(DISTINCT o_custkey), count(*) FROM orders
  UNION ALL SELECT 'nowhere', count(*), NULL FROM region)""")
def x04(spark, sf_dir):
    """The expected counts are themselves counted: distinct customers times ten orders, and so on."""
    customer, orders = read(spark, sf_dir, "customer"), read(spark, sf_dir, "orders")
    expected = q.union_all([
        customer.agg((10 * F.count_distinct("c_nationkey")).alias("expected_rows")).select(
            F.lit("customer").alias("table_name"), "expected_rows"),
        orders.agg((10 * F.count_distinct("o_custkey")).alias("expected_rows")).select(
            F.lit("orders").alias("table_name"), "expected_rows"),
        read(spark, sf_dir, "region").agg(F.count("*").alias("expected_rows")).select(
            F.lit("nowhere").alias("table_name"), "expected_rows"),
    ])
    return q.reconcile(expected, q.row_counts({"customer": customer, "orders": orders}))


@query("x05_rescued", """
SELECT 'events' AS table_name, count(*) FILTER (WHERE event_type = 'error') AS rescued_rows FROM events
UNION ALL SELECT 'encounters', 0""")
def x05(spark, sf_dir):
    events = read(spark, sf_dir, "events").withColumn(
        "_rescued_data", F.when(F.col("event_type") == "error", F.col("props"))
    )
    return q.rescued_counts({"events": events, "encounters": lake(spark, sf_dir)["encounters"]})


@query("x06_resource_summary", """
SELECT event_type, count(*) AS row_count, count(DISTINCT user_id) AS distinct_ids,
  count(DISTINCT CAST(ts AS DATE)) AS files, CAST(max(ts) AS VARCHAR) AS last_ingested_at FROM events GROUP BY ALL""")
def x06(spark, sf_dir):
    events = read(spark, sf_dir, "events").withColumn("file", F.col("ts").cast("date"))
    return q.resource_summary(events, ["event_type"], "user_id", "file", "ts")


@query("x07_null_counts", """
SELECT count(*) AS total_rows, count(*) - count(CASE WHEN o_orderstatus <> 'O' THEN 1 END) AS null_status,
  CAST(0 AS BIGINT) AS null_o_custkey FROM orders""")
def x07(spark, sf_dir):
    orders = read(spark, sf_dir, "orders").withColumn("status", F.nullif("o_orderstatus", F.lit("O")))
    return q.null_counts(orders, ["status", "o_custkey"])


@query("x08_multi_file_ids", """
SELECT user_id, event_type, count(DISTINCT CAST(ts AS DATE)) AS files FROM events GROUP BY ALL
HAVING count(DISTINCT CAST(ts AS DATE)) > 1""")
def x08(spark, sf_dir):
    events = read(spark, sf_dir, "events").withColumn("file", F.col("ts").cast("date"))
    return q.multi_file_ids(events, ["user_id", "event_type"], "file")


def _ledger(spark, sf_dir):
    """Two runs of the order checks, per priority, in one ledger."""
    orders = read(spark, sf_dir, "orders")
    runs = []
    for day, kept in ((1, orders.filter("o_orderstatus = 'P'")), (2, orders)):
        results = q.expect(kept, {"cheap": "o_totalprice < 200000", "known": "o_orderstatus <> 'F'"}, "orders")
        runs.append(results.withColumns({
            "run_id": F.lit(f"run{day}"), "run_started_at": F.lit(datetime(2024, 1, day)),
        }))
    return q.union_all(runs)


@query("x09_dq_results", _counts("orders", "orders", {
    "cheap": "o_totalprice < 200000", "known": "o_orderstatus <> 'F'",
}))
def x09(spark, sf_dir):
    return checks.data_quality_results(_ledger(spark, sf_dir))


@query("x10_nonempty", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {s}" for t, s in [
        ("dim_patient", "x_dim_patient"), ("fact_encounter", "x_fact_encounter"), ("fact_claim", "x_claim"),
        ("fact_index_admission", "x_index"), ("kpi_monthly", "x_kpi_monthly"), ("patient_360", "x_patient"),
    ]
))
def x10(spark, sf_dir):
    t = lake(spark, sf_dir)
    checks.gate_nonempty(t)
    return q.row_counts({n: t[n] for n in checks.MUST_HAVE_ROWS})


@query("x11_conserved", """
SELECT 'patient' AS table_name, count(*) AS silver_rows, count(*) AS bronze_keys FROM customer
UNION ALL SELECT 'encounter', count(*), count(*) FROM orders UNION ALL SELECT 'claim', count(*), count(*) FROM orders""")
def x11(spark, sf_dir):
    t = lake(spark, sf_dir)
    checks.gate_conserved(t)
    return checks.conserved_counts(t)


@query("x12_unexpected_failures", """
SELECT table_name, expectation, failed_rows FROM (""" + _counts("orders", "orders", {
    "cheap": "o_totalprice < 200000", "known": "o_orderstatus <> 'F'"}) + """) WHERE expectation <> 'cheap'""")
def x12(spark, sf_dir):
    results = checks.data_quality_results(_ledger(spark, sf_dir))
    return checks.unexpected_failures(results, ["orders.cheap"]).select("table_name", "expectation", "failed_rows")


@query("x13_measure_gate", """
SELECT count(*) AS followed FROM x_index WHERE discharge_date <= DATE '2000-12-31' - 30""")
def x13(spark, sf_dir):
    t = lake(spark, sf_dir)
    checks.gate_measure(t)
    return t["fact_index_admission"].agg(F.count_if("follow_up_complete").alias("followed"))


@query("x14_lookup_problems", """
SELECT DISTINCT 'condition code not mapped' AS problem, 'c' || o_orderkey % 13 AS code FROM orders
  WHERE o_orderkey % 13 = 12
UNION ALL SELECT 'payer without profile', r_name FROM region WHERE r_name = 'MIDDLE EAST'
UNION ALL SELECT DISTINCT 'procedure without billing code', code FROM x_procedure_text
  WHERE code IN ('p8', 'p10', 'p11')
UNION ALL SELECT DISTINCT 'vaccine not mapped', 'v3' FROM customer WHERE c_nationkey % 4 = 3""")
def x14(spark, sf_dir):
    return checks.lookup_problems(lake(spark, sf_dir))


@query("x15_validate_codes", """
SELECT DISTINCT p_brand AS code, replace(p_brand, '.', '') AS plain_code FROM (
  SELECT left(p_brand, 6) || '.' || substr(p_brand, 7) AS p_brand FROM part)
WHERE replace(p_brand, '.', '') NOT IN (SELECT left(p_brand, 7) FROM part WHERE p_size > 25)""")
def x15(spark, sf_dir):
    """Brands of larger parts serve as the official list, cut to its seven-character code field."""
    parts = read(spark, sf_dir, "part")
    lines = parts.filter("p_size > 25").select(F.concat(F.rpad("p_brand", 8, " "), "p_name").alias("value"))
    used = parts.select(F.expr("concat(left(p_brand, 6), '.', substr(p_brand, 7))").alias("code"))
    return q.validate_codes(used, "code", q.parse_official_codes(lines)).select("code", "plain_code")


# ---- ingestion ------------------------------------------------------------------------------------


def _folder(spark) -> str:
    return f"{shared_folder(spark)}/landing/{uuid.uuid4().hex}"


def _land_events(spark, sf_dir, folder):
    """Events as NDJSON, one run of files per event type."""
    lines = read(spark, sf_dir, "events").selectExpr(
        "event_type as run_id",
        "to_json(named_struct('resourceType', 'Event', 'id', cast(event_id as string), 'value', value)) as value",
    )
    lines.write.partitionBy("run_id").option("compression", "none").text(f"{folder}/events")
    return f"{folder}/events"


@query("s01_ingest_ndjson", """
SELECT event_type AS run, 'Event' AS resource_type, count(*) AS rows, count(DISTINCT event_id) AS ids FROM events
GROUP BY ALL""")
def s01(spark, sf_dir):
    folder = _folder(spark)
    path = _land_events(spark, sf_dir, folder)
    # Spark names text files *.txt, so the glob of the flow is widened to them here
    flow = ingest.read_ndjson_stream(spark, path, "driver", glob="*.txt").drop("source_system")
    for _ in range(2):  # the second run finds nothing new
        ingest.finish([ingest.start_flow(flow, f"{folder}/ckpt", f"{folder}/out", ["resource_type"])])
    return ingest.read_ingested(spark, f"{folder}/out").groupBy(F.col("run_id").alias("run"), "resource_type").agg(
        F.count("*").alias("rows"), F.count_distinct("resource_id").alias("ids")
    )


@query("s03_append_flows", """
SELECT 'customer' AS source_system, count(*) AS rows FROM customer UNION ALL SELECT 'supplier', count(*) FROM supplier""")
def s03(spark, sf_dir):
    folder, flows = _folder(spark), []
    for name in ("customer", "supplier"):
        rows = read(spark, sf_dir, name)
        rows.select(F.to_json(F.struct("*")).alias("value")).write.option("compression", "none").text(f"{folder}/{name}")
        stream = ingest.read_ndjson_stream(spark, f"{folder}/{name}", name, glob="*.txt").drop("source_system")
        flows.append(ingest.start_flow(stream, f"{folder}/ckpt/{name}", f"{folder}/out/source_system={name}"))
    ingest.finish(flows)
    return ingest.read_ingested(spark, f"{folder}/out").groupBy("source_system").agg(F.count("*").alias("rows"))


def _ingest_csv(spark, df, name):
    folder = _folder(spark)
    df.write.option("header", True).option("escape", '"').csv(f"{folder}/{name}/run_id=r1")
    ingest.finish([ingest.ingest_csv_text(spark, f"{folder}/{name}", f"{folder}/ckpt", f"{folder}/out")])
    return ingest.read_ingested(spark, f"{folder}/out")


@query("s04_ingest_csv_text", """
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_totalprice AS VARCHAR) AS o_totalprice, o_orderpriority FROM orders""")
def s04(spark, sf_dir):
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority")
    return _ingest_csv(spark, orders, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority")


@query("s05_rescued_rows", """
SELECT count(*) AS rows, count(*) FILTER (WHERE value > 50) AS rescued FROM events""")
def s05(spark, sf_dir):
    """Rows with a large value carry one field too many."""
    folder = _folder(spark)
    extra = F.when(F.col("value") > 50, ",surplus").otherwise("")
    lines = read(spark, sf_dir, "events").select(
        F.concat(F.col("event_id").cast("string"), F.lit(","), "event_type", extra).alias("value")
    )
    lines.write.option("compression", "none").text(f"{folder}/events")
    ingest.finish([ingest.ingest_csv_text(
        spark, f"{folder}/events", f"{folder}/ckpt", f"{folder}/out", ["event_id", "event_type"], glob="*.txt", header=False)])
    return ingest.read_ingested(spark, f"{folder}/out").agg(
        F.count("*").alias("rows"), F.count("_rescued_data").alias("rescued")
    )


@query("s05_added_and_missing_columns", """
SELECT count(*) AS rows, count(*) FILTER (WHERE o_custkey % 3 = 1) AS rescued,
  count(*) FILTER (WHERE o_custkey % 3 <> 2) AS prices FROM orders""")
def s05b(spark, sf_dir):
    """A first load, a later one with one more column and another order, and one without a column."""
    folder = _folder(spark)
    orders = read(spark, sf_dir, "orders").withColumn("load", F.col("o_custkey") % 3)
    for load, columns in ((0, ["o_orderkey", "o_totalprice"]), (1, ["o_orderstatus", "o_totalprice", "o_orderkey"]), (2, ["o_orderkey"])):
        rows = orders.filter(F.col("load") == load).select(*columns)
        rows.write.option("header", True).csv(f"{folder}/orders/run_id={load}")
        ingest.finish([ingest.ingest_csv_text(spark, f"{folder}/orders", f"{folder}/ckpt", f"{folder}/out")])
    return ingest.read_ingested(spark, f"{folder}/out").agg(
        F.count("o_orderkey").alias("rows"), F.count(F.get_json_object("_rescued_data", "$.o_orderstatus")).alias("rescued"),
        F.count("o_totalprice").alias("prices"),
    )


@query("s06_lineage", """
SELECT 'r1' AS _run_id, count(*) AS rows, true AS has_file, true AS has_times FROM customer""")
def s06(spark, sf_dir):
    loaded = _ingest_csv(spark, read(spark, sf_dir, "customer"), "customer")
    return loaded.groupBy("_run_id").agg(
        F.count("*").alias("rows"),
        F.bool_and(F.col("_source_file").contains("run_id=r1")).alias("has_file"),
        F.bool_and(F.col("_source_file_modified_at") <= F.col("_ingested_at")).alias("has_times"),
    )


@query("s08_no_partition_column", "SELECT count(*) AS rows, false AS has_run_id FROM supplier")
def s08(spark, sf_dir):
    loaded = _ingest_csv(spark, read(spark, sf_dir, "supplier"), "supplier")
    return loaded.agg(F.count("*").alias("rows")).withColumn("has_run_id", F.lit("run_id" in loaded.columns))


@query("s09_lookup_load", "SELECT p_type, count(*) AS parts, lpad(CAST(min(p_partkey) AS VARCHAR), 6, '0') AS first_code FROM part GROUP BY ALL")
def s09(spark, sf_dir):
    """Codes keep their leading zeros."""
    folder = _folder(spark)
    codes = read(spark, sf_dir, "part").select(F.lpad(F.col("p_partkey").cast("string"), 6, "0").alias("code"), "p_type")
    codes.write.option("header", True).csv(f"{folder}/part_codes")
    return lookups.read_lookup(spark, f"{folder}/part_codes").groupBy("p_type").agg(
        F.count("*").alias("parts"), F.min("code").alias("first_code")
    )


@query("s10_table_sink", "SELECT o_orderpriority, count(*) AS orders FROM orders GROUP BY ALL")
def s10(spark, sf_dir):
    root = _folder(spark)
    for _ in range(2):  # a second write replaces the first
        kept = tables.write_table(
            read(spark, sf_dir, "orders"), root, "silver", "orders", cluster_by=["o_orderdate"],
            partition_by=["o_orderpriority"],
        )
    return kept.groupBy("o_orderpriority").agg(F.count("*").alias("orders"))


@query("s13_landing_scope", """
SELECT 'row' AS kind, event_type AS name, count(*) AS rows FROM events WHERE event_type NOT IN ('error', 'signup') GROUP BY ALL
UNION ALL SELECT 'missing', 'refund', 0""")
def s13(spark, sf_dir):
    rows = read(spark, sf_dir, "events").withColumnRenamed("event_type", "resource_type")
    kept = landing.in_scope(rows, ["error", "signup"]).groupBy(F.col("resource_type").alias("name")).agg(
        F.count("*").alias("rows")
    ).select(F.lit("row").alias("kind"), "name", "rows")
    missing = landing.not_landed(spark, ["view", "click", "refund"], rows, "resource_type").select(
        F.lit("missing").alias("kind"), F.col("resource_type").alias("name"), F.lit(0).cast("long").alias("rows")
    )
    return kept.unionByName(missing)


@query("s14_profile_landing", "SELECT count(*) AS lines, true AS has_bytes FROM events")
def s14(spark, sf_dir):
    path = _land_events(spark, sf_dir, _folder(spark))
    return landing.profile_landing(spark, path, "*.txt").agg(
        F.sum("lines").alias("lines"), (F.min("bytes") > 0).alias("has_bytes")
    )


@query("s14_class_mix", "SELECT event_type, count(*) AS rows FROM events GROUP BY ALL")
def s14b(spark, sf_dir):
    return landing.class_mix(read(spark, sf_dir, "events"), "event_type")
