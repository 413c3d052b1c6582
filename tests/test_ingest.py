"""Landing files: each file once, restarts, broken lines, and two daily runs end to end."""

import json

import pytest
from pyspark.errors import AnalysisException, StreamingQueryException
from pyspark.sql import functions as F

from care_lake import fixed
from care_lake.operators.quality import GateError
from care_lake.plans import checks, daily
from care_lake.plans.tables import GOLD, SILVER
from care_lake.sources.landing import profile_landing
from care_lake.streaming import ingest
from workload.lookups import LOOKUPS, lookup_table
from workload.standin import PERIOD, SOURCES, RawTables, lake

SF = "/root/testdata/sf0.001"


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


def load_csv(spark, root):
    ingest.finish([ingest.ingest_csv_text(spark, str(root / "in"), str(root / "ckpt"), str(root / "out"))])
    return ingest.read_ingested(spark, str(root / "out"))


def test_csv_files_are_loaded_once(spark, tmp_path):
    put(tmp_path / "in/run_id=r1/a.csv", 'Id,NAME\n001,"Ann, ""A"""\n002,\n')
    first = load_csv(spark, tmp_path)
    assert sorted(map(tuple, first.select("Id", "NAME", "_run_id").collect())) == [
        ("001", 'Ann, "A"', "r1"), ("002", None, "r1"),
    ]
    assert "run_id" not in first.columns
    put(tmp_path / "in/run_id=r2/b.csv", "Id,NAME\n003,Cy\n")
    put(tmp_path / "in/run_id=r2/notes.txt", "not,a,table\n")
    assert load_csv(spark, tmp_path).count() == 3
    assert load_csv(spark, tmp_path).count() == 3
    row = load_csv(spark, tmp_path).filter("Id = '003'").first()
    assert row._run_id == "r2" and row._source_file.endswith("/run_id=r2/b.csv")
    assert row._source_file_modified_at <= row._ingested_at


def test_lines_that_do_not_fit_are_kept(spark, tmp_path):
    put(tmp_path / "in/a.csv", "Id,NAME\n1,a\n2,b,c\n3\n4,\n")
    got = {r.Id: r._rescued_data for r in load_csv(spark, tmp_path).collect()}
    assert got == {"1": None, "2": "2,b,c", "3": "3", "4": None}


def test_other_headers_lose_nothing(spark, tmp_path):
    put(tmp_path / "in/a.csv", "Id,NAME\n1,a\n")
    put(tmp_path / "in/0notes.txt", "a note, not a table\n")
    load_csv(spark, tmp_path)
    put(tmp_path / "in/0.csv", '"NAME",Id,EXTRA\nb,2,x\nc,3,\n')
    put(tmp_path / "in/b.csv", "Id\n4\n")
    put(tmp_path / "in/c.csv", "Id,NAME\n5,e\n6,f,g\n")
    got = load_csv(spark, tmp_path)
    assert got.columns[:3] == ["Id", "NAME", "_rescued_data"]
    assert sorted(map(tuple, got.select("Id", "NAME", "_rescued_data").collect())) == [
        ("1", "a", None), ("2", "b", '{"EXTRA":"x"}'), ("3", "c", None), ("4", None, None), ("5", "e", None), ("6", "f", "6,f,g"),
    ]


def test_a_file_without_header_stops_the_load(spark, tmp_path):
    put(tmp_path / "in/a.csv", "Id,NAME\n1,a\n")
    load_csv(spark, tmp_path)
    put(tmp_path / "in/b.csv", "2,b\n3,c\n")
    with pytest.raises(StreamingQueryException, match="no header"):
        load_csv(spark, tmp_path)


def test_all_flows_end_before_a_failure_is_raised(spark, tmp_path):
    put(tmp_path / "bad/a.csv", "x\n")
    put(tmp_path / "in/a.csv", "Id,NAME\n1,a\n")
    bad = ingest.ingest_csv_text(spark, str(tmp_path / "bad"), str(tmp_path / "c1"), str(tmp_path / "o1"), ["Id", "NAME"])
    good = ingest.ingest_csv_text(spark, str(tmp_path / "in"), str(tmp_path / "c2"), str(tmp_path / "o2"))
    with pytest.raises(StreamingQueryException):
        ingest.finish([bad, good])
    assert not good.isActive and ingest.read_ingested(spark, str(tmp_path / "o2")).count() == 1


def test_a_repeated_batch_replaces_its_output(spark, tmp_path):
    put(tmp_path / "in/a.csv", "Id\n1\n2\n")
    load_csv(spark, tmp_path)
    # a run that wrote its batch but failed before the commit was recorded writes the batch again
    for f in (tmp_path / "ckpt/commits").glob("*0*"):
        f.unlink()
    assert load_csv(spark, tmp_path).count() == 2


def test_two_flows_feed_one_table(spark, tmp_path):
    line = json.dumps({"resourceType": "Patient", "id": "1", "meta": {"lastUpdated": "2024-01-01T00:00:00Z"}})
    put(tmp_path / "a/extract_date=2024-01-02/run_id=x/Patient.ndjson", line + "\n{broken\n")
    put(tmp_path / "b/run_id=y/Patient.ndjson", line + "\n")
    put(tmp_path / "b/run_id=y/manifest.json", "{}\n")
    for _ in range(2):
        ingest.append_flows(
            spark, {"sys_a": str(tmp_path / "a"), "sys_b": str(tmp_path / "b")}, str(tmp_path / "c"), str(tmp_path / "out")
        )
    got = ingest.read_ingested(spark, str(tmp_path / "out"))
    assert sorted(map(tuple, got.select(
        "source_system", "resource_type", "resource_id", "run_id", F.col("extract_date").cast("string")
    ).collect()), key=str) == sorted([
        ("sys_a", "Patient", "1", "x", "2024-01-02"), ("sys_a", None, None, "x", "2024-01-02"),
        ("sys_b", "Patient", "1", "y", None),
    ], key=str)
    assert got.filter("resource_type = 'Patient'").first().raw == line


def test_flows_stop_when_one_of_them_cannot_start(spark, tmp_path):
    put(tmp_path / "a/run_id=y/Patient.ndjson", "{}\n")
    sources = {"sys_a": str(tmp_path / "a"), "sys_b": str(tmp_path / "nowhere")}
    with pytest.raises(AnalysisException):
        ingest.append_flows(spark, sources, str(tmp_path / "c"), str(tmp_path / "out"))
    assert not spark.streams.active
    (tmp_path / "nowhere").mkdir()
    ingest.append_flows(spark, sources, str(tmp_path / "c"), str(tmp_path / "out"))
    assert ingest.read_ingested(spark, str(tmp_path / "out")).count() == 1


def test_profile(spark, tmp_path):
    put(tmp_path / "p/x.csv", "a\nb\n")
    put(tmp_path / "p/sub/y.csv", "abc\n")
    got = sorted((r.file.rsplit("/", 1)[1], r.lines, r.bytes) for r in profile_landing(spark, str(tmp_path / "p"), "*.csv").collect())
    assert got == [("x.csv", 2, 4), ("y.csv", 1, 4)]


def land(spark, root, run):
    """Write one load of the stand-in tables as landing files."""
    raw = RawTables(spark, SF)
    for name in fixed.CSV_TABLES:
        df = raw[name].filter(F.col("_run_id") == run)
        df = df.drop(*[c for c in df.columns if c.startswith("_")])
        df.write.option("header", True).option("escape", '"').csv(f"{root}/{fixed.CSV_ROOT}/{name}/run_id={run}")
    if run == "run1":
        rows = raw["fhir_resources"].select("resource_type", "raw").collect()
        for kind in {r.resource_type for r in rows}:
            path = root / fixed.FHIR_SOURCES[fixed.FHIR_SYSTEM] / "extract_date=2024-01-01" / "run_id=1" / f"{kind}.ndjson"
            put(path, "\n".join(r.raw for r in rows if r.resource_type == kind) + "\n")
        put(root / fixed.FHIR_SOURCES["synthea"] / "run_id=1" / "Patient.ndjson", '{"resourceType":"Patient","id":"s1"}\n')
        for name in LOOKUPS:
            lookup_table(spark, name).write.option("header", True).csv(f"{root}/{fixed.LOOKUP_ROOT}/{fixed.LOOKUPS[name]}")


FAULTS = [
    "silver.patient.known_sex", "silver.patient.death_not_before_birth", "silver.patient.valid_birth_date",
    "silver.encounter.reason_code_mapped", "silver.encounter.end_not_before_start", "silver.condition.has_code",
    "silver.condition.diagnosis_has_icd10", "silver.condition.stop_not_before_start",
    "silver.procedure.has_billing_category", "silver.observation.known_category", "silver.immunization.has_cpt_code",
    "silver.payer.has_payer_type", "silver.coverage.end_not_before_start", *fixed.KNOWN_FAILURES,
]


def test_tables_that_did_not_land_are_named(spark, tmp_path):
    put(tmp_path / fixed.CSV_ROOT / "patients/a.csv", "Id\n1\n")
    with pytest.raises(GateError, match="did not land: encounters"):
        daily.load_bronze(spark, str(tmp_path), str(tmp_path / "lake"), csv_tables=("patients", "encounters"))


def test_daily_run_over_two_loads(spark, tmp_path):
    landing, out = tmp_path / "landing", str(tmp_path / "lake")
    land(spark, landing, "run1")
    daily.load_bronze(spark, str(landing), out)
    land(spark, landing, "run2")
    tables = daily.run(spark, str(landing), out, PERIOD, allowed=FAULTS)
    again = daily.bronze_tables(spark, str(landing), out)
    expected = lake(spark, SF)
    assert again["encounters"].count() == expected["encounters"].count()
    # one patient may have two periods of one payer from the same day; the stand-in tells them apart by file,
    # landed files by content, so the months these periods cover may differ
    for name in sorted({*SILVER, *GOLD} - {"fact_member_month"}):
        assert tables[name].count() == expected[name].count(), name
    # files of the second load were loaded later, so its copies replaced those of the first
    for name in ("patient", "encounter", "claim", "fact_encounter", "fact_index_admission", "kpi_monthly"):
        cols = [c for c in tables[name].columns if c not in ("run_id", "bronze_ingested_at")]
        assert tables[name].select(cols).exceptAll(expected[name].select(cols)).count() == 0, name
    assert spark.read.parquet(f"{daily.published(spark, out)}/gold/patient_360").count() == tables["patient_360"].count()
    opened = daily.open_published(spark, out, PERIOD)
    assert set(opened) == {*SILVER, *GOLD} and opened["patient_360"].count() == tables["patient_360"].count()
    one = tables["patient_timeline"].first().patient_id
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")
    found = opened["patient_timeline"].where(F.col("patient_id") == one)
    assert "SelectedBucketsCount: 1 out of 32" in found._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")
    results = spark.read.parquet(f"{out}/quality/expectations")
    recounted = {(r.table_name, r.expectation): (r.passed_rows, r.failed_rows) for r in checks.expectation_results(tables).collect()}
    assert {(r.table_name, r.expectation): (r.passed_rows, r.failed_rows) for r in results.collect()} == recounted
    assert results.count() == 54
    with pytest.raises(GateError, match="known_sex"):
        checks.gate_expectations(checks.data_quality_results(results))
    assert checks.data_quality_results(results).count() == 54
    assert set(SOURCES) == {*fixed.CSV_TABLES, "fhir_resources"}
