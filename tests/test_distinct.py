"""Distinct counts from bitmaps against counts over the rows."""

import random
from datetime import date, datetime

import pytest

from care_lake.operators.distinct import distinct_keys, numbered, presence, united
from care_lake.plans.kpi import build_patients_seen_monthly
from care_lake.plans.measures import measure
from care_lake.session import staged
from care_lake.settings import Period


@pytest.fixture(scope="module")
def visits(spark):
    """One patient owns a third of the visits; ids lie far apart; some patients and cells are NULL."""
    rng = random.Random(5)
    rows = [
        (None if rng.random() < 0.02 else "p0" if rng.random() < 0.33 else f"p{rng.randrange(1, 90_000) ** 2}",
         rng.choice(["f1", "f2", "f9", None]), rng.choice(["y1", "y2"]), datetime(rng.choice([2019, 2020]), rng.randint(1, 12), rng.randint(1, 28)))
        for _ in range(80_000)
    ]
    return spark.createDataFrame(rows, "patient_id string, facility_id string, payer_id string, start_ts timestamp_ntz")


@pytest.fixture(scope="module")
def t(spark, visits):
    visits = visits.selectExpr("*", "cast(date_format(start_ts, 'yyyyMMdd') as bigint) as start_date_key", "cast(1 as decimal(12,2)) as payer_paid", "'d1' as provider_id")
    dates = spark.sql("select cast(date_format(d, 'yyyyMMdd') as bigint) as date_key, d as date, year(d) as year, concat(year(d), '-Q', quarter(d)) as year_quarter"
                      " from (select explode(sequence(date'2019-01-01', date'2020-12-31')) as d)")
    return {
        "fact_encounter": visits, "dim_date": dates,
        "dim_facility": spark.sql("select * from values ('f1','One'),('f2','Two') as t(facility_id, facility_name)"),
        "dim_payer": spark.sql("select * from values ('y1','Medicare'),('y2','Commercial') as t(payer_id, payer_category)"),
        "dim_provider": spark.sql("select 'd1' as provider_id, 'Doc' as provider_name"),
    }


@pytest.fixture(scope="module")
def cube(t):
    return staged(build_patients_seen_monthly(t, Period(date(2019, 1, 1), date(2020, 12, 31))), "seen")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_numbers_have_no_gaps_and_miss_null(visits):
    got = [tuple(r) for r in numbered(visits, "patient_id", "n").collect()]
    keys = {r.patient_id for r in visits.select("patient_id").distinct().collect()} - {None}
    assert sorted(n for _, n in got) == list(range(1, len(keys) + 1)) and {k for k, _ in got} == keys
    assert len(keys) > 32_768  # more than one bitmap


@pytest.mark.parametrize("by", [[], ["facility_id"], ["payer_id", "facility_id"]])
def test_any_coarser_group_is_exact(visits, by):
    cells = presence(visits, ["facility_id", "payer_id"], "patient_id")
    expected = rows(visits.selectExpr(*by, "patient_id").distinct().groupBy(*by).agg({"patient_id": "count"}))
    assert rows(distinct_keys(cells, by, "n")) == expected
    assert rows(distinct_keys(united(cells, by), by, "n")) == expected


def test_empty_table(visits):
    assert rows(distinct_keys(presence(visits.limit(0), ["facility_id"], "patient_id"), [], "n")) == [(None,)]


SLICES = [
    ([], {}), (["dim_date.year"], {}), (["dim_facility.facility_name", "dim_date.year_quarter"], {}),
    (["dim_payer.payer_category"], {"dim_date.year": 2020}), ([], {"dim_facility.facility_name": ["One"], "dim_payer.payer_category": "Medicare"}),
    (["dim_date.year"], {"dim_facility.facility_name": "Nowhere"}), ([], {"dim_date.year": 1990}),
]


@pytest.mark.parametrize("by, filters", SLICES)
def test_slices_of_the_cube_equal_the_fact(t, cube, by, filters):
    from_fact = measure(["patients_seen"], t, by, filters)
    without_fact = {**{k: v for k, v in t.items() if k != "fact_encounter"}, "patients_seen_monthly": cube}
    assert rows(measure(["patients_seen"], without_fact, by, filters)) == rows(from_fact)


@pytest.mark.parametrize("by, filters", [(["dim_date.date"], {}), (["dim_provider.provider_name"], {}), ([], {"dim_date.date": date(2020, 5, 5)})])
def test_slices_the_cube_does_not_know_come_from_the_fact(t, cube, by, filters):
    assert rows(measure(["patients_seen"], {**t, "patients_seen_monthly": cube}, by, filters)) == rows(measure(["patients_seen"], t, by, filters))


def test_ratio_takes_its_parts_from_cube_and_fact(t, cube):
    got = measure(["cost_per_patient"], {**t, "patients_seen_monthly": cube}, ["dim_date.year"])
    assert rows(got) == rows(measure(["cost_per_patient"], t, ["dim_date.year"]))
