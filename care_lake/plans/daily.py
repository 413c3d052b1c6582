"""The daily run: load new files, rebuild the tables, check them."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from datetime import datetime, timezone
from functools import partial

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from care_lake import fixed
from care_lake.operators.quality import GateError, watch, watched
from care_lake.plans import checks
from care_lake.plans.tables import GOLD, SILVER, Lake
from care_lake.session import sorted_splits
from care_lake.settings import Period
from care_lake.sources.lookups import read_lookups
from care_lake.sources.layout import read_bucketed, write_bucketed
from care_lake.sources.tables import read_table, table_path, write_table
from care_lake.streaming.ingest import append_flows, finish, ingest_csv_text, read_ingested, start_all

# sort columns inside the files, for row group skipping, of tables that are aggregated
CLUSTER_BY = {
    "encounter": ["care_setting", "start_date"],
    "fact_encounter": ["start_date_key"],
}
# tables that a report reads one patient from are in buckets of the patient, sorted further by these columns
PATIENT_BUCKETS = {
    "fact_condition": ["start_date"],
    "fact_lab_result": ["result_ts"],
    "fact_medication": ["start_ts"],
    "patient_timeline": ["event_ts"],
    "patient_360": [],
}


def load_bronze(spark: SparkSession, landing: str, lake: str, csv_tables=fixed.CSV_TABLES) -> None:
    """Load what is new in the landing folders. All flows run side by side; tables that did not land are named."""
    missing = []

    def starts() -> Iterator[Callable[[], StreamingQuery]]:
        for name in csv_tables:
            folder = f"{landing}/{fixed.CSV_ROOT}/{name}"
            try:
                spark.read.text(folder)
            except AnalysisException as e:
                if e.getCondition() != "PATH_NOT_FOUND":
                    raise
                missing.append(name)
            else:
                yield partial(ingest_csv_text, spark, folder, f"{lake}/_checkpoints/{name}", table_path(lake, "bronze", name))

    finish(start_all(starts()))
    if missing:
        raise GateError(f"tables that did not land: {', '.join(missing)}")
    append_flows(
        spark, {s: f"{landing}/{folder}" for s, folder in fixed.FHIR_SOURCES.items()},
        f"{lake}/_checkpoints/fhir_resources", table_path(lake, "bronze", "fhir_resources"),
    )


def bronze_tables(spark: SparkSession, landing: str, lake: str) -> dict[str, DataFrame]:
    names = (*fixed.CSV_TABLES, "fhir_resources")
    raw = {n: read_ingested(spark, table_path(lake, "bronze", n)) for n in names}
    return {**raw, **read_lookups(spark, landing)}


def build_tables(tables: Lake, spark: SparkSession, root: str, buckets: int = 32) -> tuple[Lake, list[tuple[str, str, int, int]]]:
    """Write every silver and gold table; each one is read back, so later tables start from files.

    The expectations of a table are counted by the job that writes it. ``buckets`` is the number of buckets of a table that is
    read by patient; a bucket should fill a file of some 100 MB.
    """
    built, counts = {name: tables[name] for name in tables}, []
    with sorted_splits(spark):
        for layer, names in (("silver", SILVER), ("gold", GOLD)):
            for name in names:
                current = Lake(built, tables.period)
                expected = checks.LAYERS[layer].get(name, {})
                rows, seen = watch(current[name], expected) if expected else (current[name], None)
                if name in PATIENT_BUCKETS:
                    built[name] = write_bucketed(rows, root, layer, name, "patient_id", buckets, PATIENT_BUCKETS[name])
                else:
                    built[name] = write_table(rows, root, layer, name, CLUSTER_BY.get(name, []))
                if seen:
                    counts += watched(seen, expected, f"{layer}.{name}")
    return Lake(built, tables.period), counts


def record_expectations(t: Lake, counts: list[tuple[str, str, int, int]], lake: str, run_id: str) -> DataFrame:
    """Append the expectation counts of this run to the ledger; the landed tables are counted here."""
    spark = t["dim_patient"].sparkSession
    started = datetime.now(timezone.utc).replace(tzinfo=None)
    built = spark.createDataFrame(counts, "table_name string, expectation string, passed_rows long, failed_rows long")
    rows = checks.expectation_results(t, ("bronze",)).unionByName(built).withColumns({
        "run_id": F.lit(run_id), "run_started_at": F.lit(started),
    })
    rows.coalesce(1).write.mode("append").parquet(table_path(lake, "quality", "expectations"))
    return read_table(spark, lake, "quality", "expectations")


def published(spark: SparkSession, lake: str) -> str:
    """Folder of the newest run that passed all checks; readers start here."""
    runs = spark.read.parquet(table_path(lake, "quality", "published"))
    return f"{lake}/runs/{runs.agg(F.max_by('run_id', 'published_at')).first()[0]}"


def open_published(spark: SparkSession, lake: str, period: Period) -> Lake:
    """The tables of the newest run that passed all checks, for reports; those read by patient come with their buckets."""
    root = published(spark, lake)
    layers = {name: layer for layer, names in (("silver", SILVER), ("gold", GOLD)) for name in names}
    return Lake({n: (read_bucketed if n in PATIENT_BUCKETS else read_table)(spark, root, layer, n) for n, layer in layers.items()}, period)


def run(spark: SparkSession, landing: str, lake: str, period: Period, allowed=fixed.KNOWN_FAILURES) -> Lake:
    """One daily run, in a folder of its own that is published after the checks.

    Raises ``GateError`` when a check finds something that must be looked at; readers then keep the run before.
    """
    load_bronze(spark, landing, lake)
    run_id = uuid.uuid4().hex
    tables, counts = build_tables(Lake(bronze_tables(spark, landing, lake), period), spark, f"{lake}/runs/{run_id}")
    ledger = record_expectations(tables, counts, lake, run_id)
    checks.gate_nonempty(tables)
    checks.gate_conserved(tables)
    checks.gate_expectations(checks.data_quality_results(ledger), allowed)
    checks.gate_measure(tables)
    now = datetime.now(timezone.utc).replace(tzinfo=None)
    row = spark.createDataFrame([(run_id, now)], "run_id string, published_at timestamp_ntz")
    row.coalesce(1).write.mode("append").parquet(table_path(lake, "quality", "published"))
    return tables
