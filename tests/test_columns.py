"""Column functions: casts, cleaning, decoding, dates and JSON paths."""

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from care_lake import fixed
from care_lake.functions import calendar as cal
from care_lake.functions import clean as c
from care_lake.functions.fhir import coding_code, extension_text, fhir_references, jpath, json_envelope, with_doc
from care_lake.settings import Period


@pytest.mark.parametrize("text, to, value", [
    ("2020-02-29", "date", date(2020, 2, 29)),
    ("2020-02-30", "date", None),
    ("12.345", c.MONEY, Decimal("12.35")),
    ("99999999999.00", c.MONEY, None),
    ("x", "int", None),
    ("1e3", "double", 1000.0),
    (None, "double", None),
])
def test_safe_cast_gives_null_instead_of_an_error(one, text, to, value):
    assert one(c.safe_cast("a", to), a=text) == value


def test_timestamp_text_is_utc(one):
    assert one(c.safe_cast("a", "timestamp").cast("string"), a="2020-01-01T23:30:00Z") == "2020-01-01 23:30:00"
    assert one(c.ts_to_date("a"), a="2020-01-01T23:30:00Z") == date(2020, 1, 1)
    assert one(c.ts_to_date("a"), a="nonsense") is None


@pytest.mark.parametrize("text, value", [
    ("Asthma (disorder)", "Asthma"),
    ("Asthma (mild) (disorder)", "Asthma (mild)"),
    ("Asthma (disorder) x", "Asthma (disorder) x"),
    ("(disorder)", ""),
    (None, None),
])
def test_only_the_last_bracket_is_stripped(one, text, value):
    assert one(c.strip_suffix("a"), a=text) == value


def test_cleaning(one):
    assert one(c.strip_digits("a"), a="Abe604 O1") == "Abe O"
    assert one(c.squeeze_ws("a"), a="a  b\t\nc") == "a b c"
    assert one(c.title(F.trim("a")), a=" MASS GENERAL ") == "Mass General"
    assert one(c.null_if("a", "0"), a="0") is None
    assert one(c.ref_id("a"), a="Patient/p1") == "p1"
    assert one(c.ref_id("a"), a="p1") == ""
    assert one(c.ilike_case("a", fixed.FHIR_CARE_SETTING, "Outpatient"), a="xINPATIENTx") == "Inpatient"
    assert one(c.ilike_case("a", fixed.FHIR_CARE_SETTING, "Outpatient"), a=None) == "Outpatient"


def test_unknown_codes(one):
    assert one(c.decode("a", fixed.SEX), a="X") is None
    assert one(c.decode("a", fixed.SEX), a=None) is None
    assert one(c.decode("a", fixed.MARITAL_STATUS, F.lit("Unknown")), a=None) == "Unknown"
    assert one(c.decode("a", fixed.PAYMENT_METHOD, c.title("a")), a="CASH") == "Cash"


@pytest.mark.parametrize("a, b, worst", [
    ("MILD", "SEVERE", "Severe"), (None, "MODERATE", "Moderate"), ("MILD", None, "Mild"), (None, None, None),
    ("odd", "MILD", "Mild"),
])
def test_max_severity(one, a, b, worst):
    assert one(c.max_severity(fixed.SEVERITY, "a", "b"), a=a, b=b) == worst


def test_surrogate_key_skips_null_unless_told(one):
    skipped = one(c.surrogate_key("a", "b", "d"), a="1", b=None, d="2")
    assert skipped == one(c.surrogate_key("a", "d"), a="1", d="2")
    assert skipped != one(c.surrogate_key("a", "b", "d", null_as={"b": ""}), a="1", b=None, d="2")


def test_path_keys(one):
    path = "file:/landing/epic/extract_date=2024-05-06/run_id=r 1/Patient.ndjson"
    assert one(c.path_key("a", "run_id"), a=path) == "r 1"
    assert one(c.path_key("a", "extract_date", "date"), a=path) == date(2024, 5, 6)
    assert one(c.path_key("a", "run_id"), a="file:/x") is None
    assert one(c.path_key("a", "run_id", empty_as_null=False), a="file:/x") == ""


def test_null_safe_sum_and_balance(one):
    a, b = F.col("a").cast("int"), F.col("b").cast("int")
    assert one(c.null_safe_sum(a, b), a="1", b=None) == 1
    assert one(c.balance(a, b), a="1", b=None) is None


@pytest.mark.parametrize("born, on, age", [
    ("1980-08-31", "2026-08-31", 46),
    ("1980-09-01", "2026-08-31", 45),
    ("2000-02-29", "2023-02-28", 23),  # both days end their month
    ("2000-02-29", "2024-02-28", 23),
    ("2027-01-01", "2026-08-31", -1),
    (None, "2026-08-31", None),
])
def test_age(one, born, on, age):
    assert one(cal.age_at(c.safe_cast("a", "date"), c.safe_cast("b", "date")), a=born, b=on) == age


def test_age_stops_at_death(one):
    age = cal.age_as_of(c.safe_cast("a", "date"), c.safe_cast("b", "date"), Period())
    assert one(age, a="1950-01-01", b="2000-06-01") == 50
    assert one(age, a="1950-01-01", b=None) == 76
    assert one(age, a="1950-01-01", b="2030-01-01") == 76


@pytest.mark.parametrize("age, band", [
    ("17", "0-17"), ("18", "18-44"), ("44", "18-44"), ("45", "45-64"), ("64", "45-64"), ("65", "65-74"),
    ("74", "65-74"), ("75", "75+"), (None, "75+"),
])
def test_age_band(one, age, band):
    assert one(cal.age_band(F.col("a").cast("int")), a=age) == band


def test_date_dim(spark):
    days = cal.date_dim(spark, Period())
    assert days.count() == 46751
    row = days.filter("date_key = 20260831").first()
    assert (row.year_quarter, row.month_name, row.day_of_week, row.day_name) == ("2026-Q3", "August", 2, "Monday")
    assert row.is_in_analysis_period and not days.filter("date_key = 20260901").first().is_in_analysis_period


def test_auto_calendar_spans_full_years(spark):
    df = spark.createDataFrame([(date(2020, 5, 1),), (date(2021, 2, 1),), (None,)], "d date")
    span = cal.auto_calendar(df, "d").agg(F.min("date"), F.max("date"), F.count("*")).first()
    assert tuple(span) == (date(2020, 1, 1), date(2021, 12, 31), 366 + 365)


def test_period_must_start_a_month():
    with pytest.raises(ValueError):
        Period(date(2021, 9, 2), date(2022, 1, 1))


FULL = """{"name":[{"given":["Ann","B"],"family":"Lee"}],"birthDate":"1980-02-03","deceasedBoolean":false,
"extension":[{"url":"http://x/us-core-race","extension":[{"url":"ombCategory"},{"url":"text","valueString":"White"}]}],
"code":{"coding":[{"system":"http://hl7.org/fhir/sid/icd-10-cm","code":"I10"},{"system":"http://snomed.info/sct","code":"38341003"}]}}"""


@pytest.mark.parametrize("raw, given, race, snomed, icd10", [
    (FULL, "B", "White", "38341003", "I10"),
    ('{"code":{"coding":[]}}', None, None, None, None),
    ('{"code":{"coding":[{"system":"http://snomed.info/sct","code":"1"}]},"extension":[]}', None, None, "1", None),
    ("{}", None, None, None, None),
    ("not json", None, None, None, None),
    (None, None, None, None, None),
])
def test_fhir_paths(spark, raw, given, race, snomed, icd10):
    row = with_doc(spark.createDataFrame([(raw,)], "raw string")).select(
        jpath("name[0].given[1]"), extension_text("us-core-race"), coding_code(fixed.SNOMED_SYSTEM),
        coding_code(fixed.ICD10CM_SYSTEM),
    ).first()
    assert tuple(row) == (given, race, snomed, icd10)


def test_fhir_types_that_do_not_fit(spark):
    raw = '{"birthDate":"someday","flag":"maybe","at":"2020-01-01T10:00:00Z"}'
    row = with_doc(spark.createDataFrame([(raw,)], "raw string")).select(
        jpath("birthDate", "date"), jpath("flag", "boolean"), jpath("at", "timestamp").cast("string")
    ).first()
    assert tuple(row) == (None, None, "2020-01-01 10:00:00")


def test_envelope_keeps_broken_lines(spark):
    lines = spark.createDataFrame([('{"resourceType":"Patient","id":"1"}',), ("{broken",)], "value string")
    rows = {r.raw: (r.resource_type, r.resource_id) for r in json_envelope(lines).collect()}
    assert rows == {'{"resourceType":"Patient","id":"1"}': ("Patient", "1"), "{broken": (None, None)}


def test_references(spark):
    raw = [
        ('{"participant":[{"individual":{"reference":"P/1"}},{"individual":{}}],"serviceProvider":{"reference":"O/1"}}',),
        ('{"location":[{"location":{"reference":"L/1"}}],"serviceProvider":{"reference":"O/1"}}',),
        ("{}",),
    ]
    found = fhir_references(spark.createDataFrame(raw, "raw string")).collect()
    assert sorted(r.reference for r in found) == ["L/1", "O/1", "P/1"]


def test_timeline_text_needs_a_value(spark):
    from care_lake.plans.patient import lab_text

    df = spark.createDataFrame(
        [("Na", 1.5, None, None), ("K", None, None, "u"), ("X", None, "pos", "u")],
        "test_name string, value_numeric double, value_text string, units string",
    )
    assert [r[0] for r in df.select(lab_text()).collect()] == ["Na 1.5 ", None, "X pos u"]
