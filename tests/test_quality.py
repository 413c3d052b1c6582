"""Expectations, reconciliation, gates and lookup checks."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from care_lake import fixed
from care_lake.operators import quality as q
from care_lake.plans import checks


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)


def test_unknown_outcome_counts_as_failed(spark):
    df = spark.createDataFrame([(1,), (5,), (None,)], "a int")
    got = rows(q.expect(df, {"big": "a > 3", "any": F.lit(True)}, "t"), "table_name", "expectation", "passed_rows", "failed_rows")
    assert got == [("t", "any", 3, 0), ("t", "big", 1, 2)]


def test_all_expectations_are_listed():
    counts = {layer: sum(map(len, tables.values())) for layer, tables in checks.LAYERS.items()}
    assert counts == {"bronze": 16, "silver": 36, "gold": 2}


def test_reconcile_sorts_by_difference(spark):
    expected = spark.createDataFrame([("a", 5), ("b", 5), ("c", 5)], "table_name string, expected_rows long")
    actual = q.row_counts({"a": spark.range(5), "b": spark.range(9)})
    got = [tuple(r) for r in q.reconcile(expected, actual).collect()]
    assert got == [("c", 5, None, None), ("b", 5, 9, 4), ("a", 5, 5, 0)]


def test_multi_file_ids_and_limit(spark):
    df = spark.createDataFrame([("x", "f1"), ("x", "f2"), ("y", "f1"), ("y", "f1"), ("z", "f1"), ("z", "f3")], "id string, f string")
    assert rows(q.multi_file_ids(df, ["id"], "f", None), "id", "files") == [("x", 2), ("z", 2)]
    assert [r.id for r in q.multi_file_ids(df, ["id"], "f", 1).collect()] == ["x"]


def test_ledger_uses_the_newest_run(spark):
    data = [("t", "a", 1, 9, "r1", datetime(2024, 1, 1)), ("t", "a", 8, 2, "r2", datetime(2024, 1, 2)), ("s", "b", 10, 0, "r2", datetime(2024, 1, 2))]
    ledger = spark.createDataFrame(data, "table_name string, expectation string, passed_rows long, failed_rows long, run_id string, run_started_at timestamp")
    assert [tuple(r) for r in checks.data_quality_results(ledger).collect()] == [("t", "a", 8, 2), ("s", "b", 10, 0)]
    assert [tuple(r) for r in checks.data_quality_results(ledger, "r1").collect()] == [("t", "a", 1, 9)]


def test_gate_on_expectations(spark):
    schema = "table_name string, expectation string, passed_rows long, failed_rows long"
    known = [(*name.rsplit(".", 1), 1, 5) for name in fixed.KNOWN_FAILURES]
    checks.gate_expectations(spark.createDataFrame([*known, ("silver.patient", "known_sex", 3, 0)], schema))
    with pytest.raises(q.GateError, match=r"silver.patient.known_sex \(2 rows\)"):
        checks.gate_expectations(spark.createDataFrame([*known, ("silver.patient", "known_sex", 3, 2)], schema))


def test_gate_on_empty_tables(spark):
    full = {n: spark.range(1) for n in checks.MUST_HAVE_ROWS}
    checks.gate_nonempty(full)
    with pytest.raises(q.GateError, match="fact_claim; patient_360|patient_360; fact_claim"):
        checks.gate_nonempty({**full, "fact_claim": spark.range(0), "patient_360": spark.range(0)})


def test_gate_on_lost_rows(spark):
    tag = F.lit(fixed.CSV_SYSTEM).alias("source_system")
    t = {name: spark.range(3).select(tag) for name in checks.CONSERVED}
    t |= {raw: spark.range(6).select((F.col("id") % 3).alias(key)) for raw, key in checks.CONSERVED.values()}
    checks.gate_conserved(t)
    with pytest.raises(q.GateError, match="claim 3 vs 6"):
        checks.gate_conserved({**t, "claims": spark.range(6).select(F.col("id").alias("Id"))})


def test_gate_on_measure(spark):
    checks.gate_measure({"fact_index_admission": spark.sql("select true as follow_up_complete")})
    with pytest.raises(q.GateError):
        checks.gate_measure({"fact_index_admission": spark.sql("select false as follow_up_complete")})


def test_band_gaps(spark):
    bands = spark.sql("select * from values ('L','0','0'),('L','1','3'),('L','5','9'),('C','0','4'),('C','4','9') as t(component, lower_bound, upper_bound)")
    assert rows(q.band_gaps(bands), "component", "lower_bound") == [("C", 4), ("L", 5)]


def test_official_code_list(spark):
    lines = spark.createDataFrame([("A00     Cholera",), ("I214    NSTEMI infarction",), ("  ",)], "value string")
    official = q.parse_official_codes(lines)
    assert rows(official, "code", "description") == [("A00", "Cholera"), ("I214", "NSTEMI infarction")]
    used = spark.createDataFrame([("A00",), ("I21.4",), ("X9",), ("X9",), (None,)], "c string")
    assert rows(q.validate_codes(used, "c", official), "code") == [("X9",)]
