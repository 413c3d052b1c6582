"""Which filters reach which table, blanks and ratios."""

import pytest

from care_lake.plans.measures import MEASURES, RELATIONSHIPS, measure


@pytest.fixture(scope="module")
def t(spark):
    return {
        "dim_date": spark.sql("select * from values (20200101, 2020, '2020-Q1'), (20210101, 2021, '2021-Q1'), (20220101, 2022, '2022-Q1')"
                              " as t(date_key, year, year_quarter)"),
        "dim_facility": spark.sql("select * from values ('f1','One'),('f2','Two') as t(facility_id, facility_name)"),
        "dim_patient": spark.sql("select * from values ('p1','Female'),('p2','Male') as t(patient_id, sex)"),
        "dim_payer": spark.sql("select * from values ('y1','Medicare'),('y2','Commercial') as t(payer_id, payer_category)"),
        "kpi_monthly": spark.sql(
            "select * from values (20200101,'f1','Medicare',10L,4L,2L,1L,cast(100 as decimal(14,2))),"
            " (20200101,'f2','Commercial',6L,6L,0L,0L,cast(50 as decimal(14,2))),"
            " (20210101,'f1','Medicare',0L,2L,4L,0L,cast(7 as decimal(14,2)))"
            " as t(month_date_key, facility_id, payer_category, ed_visits, admissions, index_admissions, readmissions, payer_paid)"),
        "kpi_active_patients_monthly": spark.sql("select * from values (20200101, 100L), (20210101, 60L), (20220101, 5L) as t(month_date_key, active_patients)"),
        "fact_member_month": spark.sql("select * from values ('p1','y1',20200101),('p2','y2',20200101),('p1','y1',20210101) as t(patient_id, payer_id, month_date_key)"),
        "fact_encounter": spark.sql("select * from values ('p1','f1','d1','y1',20200101,cast(30 as decimal(12,2))),('p2','f1','d1','y1',20200101,cast(10 as decimal(12,2)))"
                                    " as t(patient_id, facility_id, provider_id, payer_id, start_date_key, payer_paid)"),
        "patient_360": spark.sql("select * from values ('p1', true, false, 'High'), ('p2', false, false, 'Low') as t(patient_id, is_high_utilizer, is_deceased, latest_risk_tier)"),
    }


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_year_reaches_both_parts_of_a_ratio(t):
    got = rows(measure(["ed_visits_per_1000"], t, ["dim_date.year"]))
    assert got == [(2020, 16 * 12000 / 100), (2021, 0.0)]


def test_payer_reaches_the_numerator_only(t):
    by = rows(measure(["ed_visits_per_1000"], t, ["kpi_monthly.payer_category"]))
    assert by == [("Commercial", 6 * 12000 / 165), ("Medicare", 10 * 12000 / 165)]
    one = measure(["ed_visits_per_1000"], t, filters={"kpi_monthly.payer_category": "Medicare"}).first()
    assert one[0] == 10 * 12000 / 165


def test_snapshot_ignores_the_year(t):
    assert measure(["high_utilizers"], t, filters={"dim_date.year": 1999}).first()[0] == 1
    assert measure(["high_utilizers"], t, filters={"dim_patient.sex": "Male"}).first()[0] is None


def test_dimension_of_another_fact_does_not_filter_the_cube(t):
    assert measure(["admissions"], t, filters={"dim_payer.payer_category": "Medicare"}).first()[0] == 12
    got = rows(measure(["pmpm_paid"], t, filters={"dim_payer.payer_category": "Medicare"}))
    assert got == [(157 / 2,)]


def test_blank_rows_are_dropped_and_zero_divisors_are_blank(t):
    got = rows(measure(["readmission_rate", "readmission_rate_benchmark"], t, ["dim_facility.facility_name"]))
    assert got == [("One", 1 / 6, 0.14), ("Two", None, 0.14)]
    assert rows(measure(["admissions"], t, ["dim_date.year"], {"dim_date.year": 1990})) == []


def test_measures_of_two_tables_meet_on_the_group(t):
    got = rows(measure(["admissions", "active_patient_months", "member_months"], t, ["dim_date.year"]))
    assert got == [(2020, 10, 100, 2), (2021, 2, 60, 1), (2022, None, 5, None)]


def test_high_utilizer_share(t):
    assert measure(["high_utilizer_share_of_cost"], t).first()[0] == 0.75


def test_grouping_that_reaches_nothing_is_refused(t):
    with pytest.raises(ValueError):
        measure(["worklist_patients"], {**t, "care_management_worklist": t["patient_360"]}, ["dim_payer.payer_category"])


def test_all_measures_and_relationships_are_there():
    helpers = {"high_utilizer_paid", "scored_readmissions"}
    assert len(set(MEASURES) - helpers) == 28
    assert sum(map(len, RELATIONSHIPS.values())) == 31


def test_a_blank_group_keeps_its_ratio(spark, t):
    visits = spark.sql("select * from values (19990101,'f1','Medicare',5L,0L,0L,0L,cast(0 as decimal(14,2)))"
                       " as t(month_date_key, facility_id, payer_category, ed_visits, admissions, index_admissions, readmissions, payer_paid)")
    active = spark.sql("select * from values (19990101, 10L) as t(month_date_key, active_patients)")
    more = {**t, "kpi_monthly": t["kpi_monthly"].union(visits), "kpi_active_patients_monthly": t["kpi_active_patients_monthly"].union(active)}
    got = rows(measure(["ed_visits_per_1000"], more, ["dim_date.year", "kpi_monthly.payer_category"]))
    assert (None, "Medicare", 5 * 12000 / 10) in got


def test_fields_of_one_name_keep_their_table(spark, t):
    facilities = spark.sql("select * from values ('f1','One','Mixed') as t(facility_id, facility_name, sex)")
    got = measure(["patients_seen"], {**t, "dim_facility": facilities}, ["dim_patient.sex", "dim_facility.sex"])
    assert got.columns == ["dim_patient_sex", "dim_facility_sex", "patients_seen"]
    assert rows(got) == [("Female", "Mixed", 1), ("Male", "Mixed", 1)]
