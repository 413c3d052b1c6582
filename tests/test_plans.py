"""Shape of the physical plans: what is pushed down, shuffled and broadcast."""

import re

import pytest

from care_lake.operators.dedup import latest_by
from care_lake.operators.lookups import map_code
from care_lake.plans import admissions, gold, patient, reports, silver
from care_lake.plans.measures import measure
from care_lake.plans.tables import VIEWS, StagedLake
from workload.standin import PERIOD, RawTables, lake, read

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def t(spark):
    return lake(spark, SF)


def test_facts_need_no_shuffle(t):
    for build in (gold.build_fact_encounter, gold.build_fact_condition, gold.build_fact_procedure,
                  gold.build_fact_lab_result, gold.build_fact_medication):
        assert "Exchange" not in plan(build(t, PERIOD))


def test_tables_that_only_rename_columns_are_not_written_again(spark):
    own = StagedLake(RawTables(spark, SF), PERIOD)
    read_from = {name: {f.split("/")[-2].rsplit("-", 1)[0] for f in own[name].inputFiles()} for name in sorted(VIEWS)}
    assert not any(v in folders for folders in read_from.values() for v in VIEWS)
    assert all(f.endswith(".zstd.parquet") for f in own["encounter"].inputFiles())


def test_rows_are_not_shuffled_by_the_few_codes_of_rules(t):
    assert "hashpartitioning(CODE" not in plan(t.build("procedure"))


def test_copies_of_wide_keys_are_sorted_by_visit_first(t):
    for raw, key in (("procedures", ["PATIENT", "ENCOUNTER", "CODE", "START"]), ("conditions", ["PATIENT", "ENCOUNTER", "CODE", "START"])):
        assert re.search(r"Sort \[ENCOUNTER#\d+ ASC NULLS FIRST, PATIENT#", plan(silver._newest(t[raw], key)))


def test_procedures_are_written_without_what_only_the_choice_of_copies_needs(t, monkeypatch):
    written = {}
    monkeypatch.setattr(silver, "staged", lambda df, name, *a: written.update({name: df.columns}) or df)
    silver.build_procedure(t)
    assert not {"_source_file", "_source_file_modified_at", "_rescued_data"} & set(written["procedures"])


def test_timeline_is_a_plain_union(t):
    assert "Exchange" not in plan(patient.build_patient_timeline(t, PERIOD))


def test_stays_push_their_filter_and_read_few_columns(t):
    text = plan(admissions.stays(t).select("encounter_id", "admit_date"))
    assert "EqualTo(care_setting,Inpatient)" in text
    assert re.search(r"ReadSchema: struct<encounter_id:string,care_setting:string,start_date:date>", text)


def test_claims_are_not_shuffled_for_their_diagnoses(t):
    from care_lake.plans.silver import build_claim

    text = plan(build_claim(t))
    assert text.count("Exchange hashpartitioning(Id") == 1
    assert "Exchange hashpartitioning(DIAGNOSIS" not in text


def test_lookup_beyond_the_threshold_is_shuffled(spark):
    lines, part = read(spark, SF, "lineitem"), read(spark, SF, "part")
    df = map_code(lines, part, "l_partkey", "p_partkey", {"p_type": "p_type"})
    assert "BroadcastHashJoin" in plan(df)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = map_code(lines, part, "l_partkey", "p_partkey", {"p_type": "p_type"})
        assert "SortMergeJoin" in plan(df) and "Broadcast" not in plan(df)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_only_scales_and_patterns_are_joined_without_an_equality(t):
    index = admissions.index_stays(admissions.flag_planned(admissions.stays(t), t), PERIOD)
    ed = admissions.ed_visits(t)
    flagged = admissions.flag_planned(admissions.stays(t), t)
    for df in (
        flagged, admissions.with_readmission(index, flagged),
        admissions.with_post_discharge_ed(index, ed, admissions.stays(t)), admissions.with_came_through_ed(index, ed),
        admissions.with_prior_ed(index, ed), admissions.with_charlson(index, t),
    ):
        assert "NestedLoop" not in plan(df) and "Cartesian" not in plan(df)


def test_bands_are_met_by_equality(t):
    inputs = t["fact_index_admission"].select("encounter_id", "length_of_stay_days", "charlson_score", "ed_visits_6_months", "came_through_ed")
    text = plan(admissions.with_lace(inputs, t["lace_points"]))
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_index_stays_are_swept_once(spark, t):
    for name in ("encounter", "procedure", "condition", "patient"):
        t[name]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(admissions.lace_inputs(t, PERIOD))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.count("Exchange hashpartitioning") <= 12
    # all windows of the sweep share one shuffle and one sort
    assert len(re.findall(r"Exchange hashpartitioning\(patient_id#\d+, chunk#", text)) == 1
    assert len(re.findall(r"Sort \[patient_id#\d+ ASC NULLS FIRST, chunk#", text)) == 1


def test_one_patient_is_found_by_filter(t):
    assert "EqualTo(patient_id,12)" in plan(reports.patient_summary(t, "12"))
    assert "EqualTo(patient_id,12)" in plan(reports.patient_labs(t, "12"))


def test_measures_shrink_before_they_meet_a_dimension(spark, t):
    """Only sums per key are shuffled, even when the dimension is too large to broadcast."""
    t["fact_encounter"], t["dim_provider"]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(measure(["encounter_payer_paid"], t, ["dim_provider.provider_name"]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    scan = text.index("FileScan parquet [provider_id")
    assert "partial_sum" in text[:scan] and "SortMergeJoin" in text
    assert text[:scan].rindex("partial_sum") > text[:scan].rindex("Exchange")


def test_filters_reach_the_fact_before_it_is_added_up(t):
    text = plan(measure(["encounter_payer_paid"], t, filters={"dim_date.year": 1998}))
    assert "LeftSemi" in text and text.index("partial_sum") < text.index("LeftSemi") < text.index("start_date_key", text.index("FileScan"))


def test_tiers_do_not_sort_or_join_the_rows(t):
    from care_lake.operators.score import percentile_tier

    index = t["fact_index_admission"]
    text = plan(percentile_tier(index, "lace_score", (("High", 0.1),), "Low", "x"))
    main = text.split("Subquery")[0]
    assert "Window" not in main and "Join" not in main


def test_copies_are_dropped_before_the_shuffle(t):
    text = plan(latest_by(t["encounters"], ["Id"]))
    assert text.index("Final") < text.index("Exchange hashpartitioning(Id") < text.index("Partial")


def test_summary_joins_reuse_the_patient_partitioning(spark, t):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(patient.build_patient_360(t, PERIOD))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # one shuffle per part to aggregate it and one for the patients, none to join
    exchanges = re.findall(r"Exchange hashpartitioning\(([^,]*)", text)
    assert {e.split("#")[0] for e in exchanges} == {"patient_id"}


def test_stays_compare_only_copies_of_procedures_that_rules_name(spark):
    """Other codes are left out of the raw rows, and the procedures are not written for the stays."""
    own = StagedLake(RawTables(spark, SF), PERIOD)
    source = own.source("fact_index_admission")
    text = plan(admissions.planned_stays(admissions.stays(source), source))
    below = text[text.index("WindowGroupLimit [ENCOUNTER"):]
    assert re.search(r"BroadcastHashJoin \[concat\(p, .*LeftSemi", below)
    assert not own.is_written("procedure")


def test_tables_with_one_reader_are_planned_and_read_where_they_were_written(spark):
    own = StagedLake(RawTables(spark, SF), PERIOD)
    own["fact_claim"], own["claim"]
    assert own.is_written("fact_claim") and not own.is_written("claim_transaction")
    assert {f.split("/")[-2].rsplit("-", 1)[0] for f in own.source("fact_claim")["claim"].inputFiles()} == {"claim"}
    labs = own.source("patient_360")["fact_lab_result"].select("patient_id", "is_abnormal")
    assert "UNITS" not in re.search(r"Exchange hashpartitioning\(ENCOUNTER.*", plan(labs)).group(0)
    assert not own.is_written("observation")


def test_cubes_of_months_have_no_table_written_that_nothing_else_reads(spark):
    own = StagedLake(RawTables(spark, SF), PERIOD)
    planned = own["kpi_monthly"], own["kpi_active_patients_monthly"]
    assert own.is_written("encounter") and own.is_written("fact_index_admission") and own.is_written("dim_patient")
    assert not [n for n in ("condition", "procedure", "fact_encounter", "coverage") if own.is_written(n)]
    other = StagedLake(RawTables(spark, SF), PERIOD)
    for name in ("condition", "procedure", "fact_encounter", "coverage"):
        other[name]
    for got, name in zip(planned, ("kpi_monthly", "kpi_active_patients_monthly")):
        assert sorted(map(str, got.collect())) == sorted(map(str, other[name].collect()))
    assert sorted(map(str, own["fact_index_admission"].collect())) == sorted(map(str, other["fact_index_admission"].collect()))
    assert sorted(map(str, own["dim_patient"].collect())) == sorted(map(str, other["dim_patient"].collect()))


def test_readers_of_few_columns_drop_copies_with_these_alone(spark):
    own = StagedLake(RawTables(spark, SF), PERIOD)
    diagnoses = own.source("fact_index_admission")["condition"].select("patient_id", "charlson_category", "start_date", "stop_date")
    assert "DESCRIPTION" not in re.search(r"Exchange hashpartitioning\(ENCOUNTER.*", plan(diagnoses)).group(0) and "sha2" not in plan(diagnoses)
    periods = own.source("dim_patient")["coverage"].select("patient_id", "payer_id", "member_id", "start_date", "end_date")
    assert "sha2" not in plan(periods) and not own.is_written("coverage") and not own.is_written("condition")
    own["fact_encounter"]
    visits = own.source("kpi_monthly")["fact_encounter"]
    assert {f.split("/")[-2].rsplit("-", 1)[0] for f in visits.inputFiles()} == {"fact_encounter"}


def test_only_texts_of_newest_copies_ask_the_rules(spark):
    """A code that had two texts asks with those of its newest copies; a code without copies of another text needs no comparison."""
    from datetime import datetime

    rows = [  # the older copy of visit 1 says gear
        ("a", "1", "x", "s", "gear", 1), ("a", "1", "x", "s", "plain", 2), ("a", "2", "y", "s", "gear", 1), ("a", "2", "y", "s", "gear", 2),
        ("a", "3", "z", "s", None, 1), ("a", "4", "z", "s", "bolt", 1), ("a", "5", None, "s", "bolt", 1), (None, None, "x", None, "thing", 1),
    ]
    df = spark.createDataFrame([(*r[:5], f"file-{r[5]}", datetime(2024, r[5], 1)) for r in rows],
                               "PATIENT string, ENCOUNTER string, CODE string, START string, DESCRIPTION string, _source_file string, _ingested_at timestamp")
    key = ["PATIENT", "ENCOUNTER", "CODE", "START"]
    got = {tuple(r) for r in silver._texts_of_newest(df, key, "CODE", "DESCRIPTION").collect()}
    want = {tuple(r) for r in silver._newest(df, key).select("CODE", "DESCRIPTION").distinct().collect()}
    assert got == want and ("x", "gear") not in got
