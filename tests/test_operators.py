"""Picking rows, lookups, scores and intervals on small hand-made cases."""

import random
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from care_lake.operators import dedup, intervals, lookups, score
from care_lake.plans import gold
from care_lake.settings import LOWEST_TIER, TIER_CUTS, Period

PERIOD = Period(date(2020, 1, 1), date(2020, 12, 31))


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


# ---- one row per key ------------------------------------------------------------------------------


def test_latest_copy_wins_and_ties_are_settled(spark):
    at = datetime(2024, 1, 1)
    data = [
        ("a", at, at, "f1", "old"), ("a", datetime(2024, 2, 1), at, "f1", "new"),
        ("b", at, at, "f1", "first file"), ("b", at, at, "f2", "last file"),
        ("c", at, at, "f1", "x"), ("c", at, at, "f1", "y"), ("c", at, at, "f1", "z"),
        (None, at, at, "f1", "no key"),
    ]
    df = spark.createDataFrame(data, "id string, _ingested_at timestamp, _source_file_modified_at timestamp,"
                                     " _source_file string, v string")
    first = rows(dedup.latest_by(df, ["id"]).filter("id in ('a', 'b')"), "id", "v")
    assert first == [("a", "new"), ("b", "last file")]
    picks = {rows(dedup.latest_by(df.repartition(n), ["id"]).filter("id = 'c'"), "v")[0] for n in (1, 2, 5)}
    assert len(picks) == 1
    assert dedup.latest_by(df, ["id"]).count() == 4


def test_latest_by_limits_before_the_shuffle(spark):
    plan = dedup.latest_by(spark.range(10).withColumn("k", F.col("id") % 2), ["k"])._jdf.queryExecution().toString()
    assert plan.count("WindowGroupLimit") >= 2


def test_union_fills_missing_columns_with_the_other_type(spark):
    a = spark.sql("select 'x' as id, cast(1.5 as double) as lat")
    out = dedup.union_sources(a, spark.sql("select 'y' as id"))
    assert dict(out.dtypes) == {"id": "string", "lat": "double"}
    assert rows(out, "id", F.col("lat").isNull()) == [("x", False), ("y", True)]


def test_asof_interval(spark):
    data = [
        ("covers", "p1", date(2020, 1, 1), None), ("covers", "p2", date(2020, 11, 1), date(2020, 11, 30)),
        ("last", "p1", date(2019, 1, 1), date(2019, 2, 1)), ("last", "p2", date(2019, 6, 1), date(2019, 7, 1)),
        ("later", "p1", date(2021, 1, 1), None),
    ]
    df = spark.createDataFrame(data, "id string, payer string, s date, e date")
    got = rows(dedup.asof_interval(df, "id", "s", "e", PERIOD.as_of_col), "id", "payer")
    assert got == [("covers", "p1"), ("last", "p2")]


def test_best_description_prefers_map_then_group(spark):
    t = {
        "condition_map": spark.sql(
            "select * from values ('1','Zeta','I10','diagnosis',cast(null as string),cast(null as string),'N'),"
            " ('2','Beta','I10','diagnosis','HF',null,'Y'), ('3','Alpha','E11','diagnosis',null,null,'Y')"
            " as t(snomed_code, snomed_description, icd10cm_code, condition_class, cohort, charlson_category, chronic_yn)"
        ),
        "condition": spark.sql(
            "select 'E11' as icd10cm_code, 'Aaa' as description, 'diagnosis' as condition_class,"
            " cast(null as string) as condition_group, true as is_chronic, cast(null as string) as charlson_category,"
            " 'source' as icd10_source"
        ),
    }
    got = rows(gold.build_dim_diagnosis(t, PERIOD), "icd10cm_code", "description", "condition_group", "is_hrrp_condition")
    assert got == [("E11", "Alpha", "Other", False), ("I10", "Beta", "HF", True)]


# ---- lookups --------------------------------------------------------------------------------------

RULES = (
    "select * from values ('20', '(?i)x-ray', 'R', 'radiology', 'Y'), ('3', 'dental', 'D', 'dental', 'Y'),"
    " ('100', '.*', 'M', 'medicine', 'N') as t(priority, description_regex, cpt_hcpcs, service_category, billable_yn)"
)


def test_rules_apply_by_number_and_only_to_unmapped_codes(spark):
    explicit = spark.sql("select 'm' as snomed_code, 'E' as cpt_hcpcs, 'mapped' as service_category")
    data = [("m", "dental x-ray"), ("a", "X-RAY"), ("b", "x-ray dental"), ("c", "hello"), ("c", "dental"), ("d", None)]
    df = spark.createDataFrame(data, "code string, text string")
    out = lookups.map_with_rules(
        df, "code", "text", explicit, "snomed_code", spark.sql(RULES),
        {"cpt_hcpcs": "billing", "service_category": "category"},
    )
    # both texts of code c share the rule that one of them matches; a missing text matches nothing
    assert sorted(out.select("code", "billing", "code_mapping").collect(), key=str) == sorted([
        ("m", "E", "explicit_map"), ("a", "R", "category_rule"), ("b", "D", "category_rule"),
        ("c", "D", "category_rule"), ("c", "D", "category_rule"), ("d", None, None),
    ], key=str)


@pytest.mark.parametrize("value, flag", [
    (1.0, "critical_low"), (2.0, "low"), (5.0, "low"), (10.0, "normal"), (60.0, "normal"), (60.5, "high"),
    (120.0, "high"), (121.0, "critical_high"), (None, None),
])
def test_abnormal_flag_bounds(spark, value, flag):
    df = spark.createDataFrame([(value,)], "v double")
    out = lookups.abnormal_flag(F.col("v"), F.lit(10.0), F.lit(60.0), F.lit(2.0), F.lit(120.0), F.lit(True))
    assert df.select(out).first()[0] == flag


def test_missing_bounds_raise_no_flag(spark):
    none = F.lit(None).cast("double")
    df = spark.createDataFrame([(0.0,), (99.0,)], "v double")
    only_high = lookups.abnormal_flag(F.col("v"), none, F.lit(50.0), none, none, F.lit(True))
    assert [r[0] for r in df.select(only_high).collect()] == ["normal", "high"]
    no_range = lookups.abnormal_flag(F.col("v"), none, none, none, none, F.lit(None).cast("boolean"))
    assert [r[0] for r in df.select(no_range).collect()] == [None, None]


def test_codes_keep_position_and_order(spark):
    df = spark.createDataFrame([("c1", "x", None, "y", "x"), ("c2", None, None, None, None)], "id string, a string, b string, c string, d string")
    long = lookups.unpivot_codes(df, "id", ["a", "b", "c", "d"])
    assert rows(long, "id", "position", "code") == [("c1", 1, "x"), ("c1", 3, "y"), ("c1", 4, "x")]
    mapped = long.withColumn("icd", F.when(F.col("code") == "y", "Y"))
    assert rows(lookups.first_mapped(mapped, "id", "position", "icd", ["code", "icd"]), "id", "code", "icd") == [("c1", "y", "Y")]
    assert lookups.ordered_distinct_list(mapped, "id", "position", "code", "l").first().l == ["x", "y"]
    assert lookups.ordered_distinct_list(mapped, "id", "position", "icd", "l").first().l == ["Y"]


def test_bands_include_both_bounds_and_end(spark):
    bands = spark.sql("select * from values ('L','0','0','0'),('L','4','6','4'),('C','0','9','9') as t(component, lower_bound, upper_bound, points)")
    df = spark.createDataFrame([(0,), (4,), (6,), (7,), (10000,)], "v int")
    got = {r.v: r.p for r in lookups.band_lookup(df, bands, "L", "v", "p").collect()}
    assert got == {0: 0, 4: 4, 6: 4, 7: None, 10000: None}


def test_long_scales_and_rule_lists(spark):
    bands = spark.sql("select 'L' as component, cast(id * 10 as string) as lower_bound, cast(id * 10 + 9 as string) as upper_bound, cast(id % 7 as string) as points from range(20000)")
    df = spark.sql("select id * 997 as v from range(300)")
    assert {r.v: r.p for r in lookups.band_lookup(df, bands, "L", "v", "p").collect()} == {i * 997: i * 997 // 10 % 7 if i * 997 < 200000 else None for i in range(300)}
    rules = spark.sql("select cast(id as string) as priority, concat('^t', id, '$') as pattern, id as c from range(20000)")
    texts = spark.createDataFrame([("a", "t19999"), ("a", "t17"), ("b", "t5000"), ("c", "x")], "code string, text string")
    assert rows(lookups.first_matching_rule(texts, "code", "text", rules, "pattern", "priority", ["c"]), "code", "c") == [("a", 17), ("b", 5000)]


def test_patterns_are_looked_up_by_what_they_need(spark):
    import re as regex

    patterns = ["^Total", "knee|hip joint", "ab|knee", "colou?rs", "x{3}", "a.cde*f", "(?i)KNEE", "[kx]nee", "\\\\bhip", "hip.*joint$", "", "knee +left", "nee", "ee", "zzz top", "a{2}bcd", "Total|"]
    texts = ["Total knee", "colors and hip joint", "colour", "abcdf", "a-cdf", "aabcd", "KNEE", "xxx", "xnee", "hip", "", "knee  left", None, "aXcdeeef"]
    rules = spark.createDataFrame(list(enumerate(patterns)), "id int, pattern string")
    pairs = lookups.matching_pairs(spark.createDataFrame([(t,) for t in texts], "text string"), "text", rules, "pattern")
    want = sorted((t, i) for t in texts if t is not None for i, p in enumerate(patterns) if regex.search(p, t))
    assert sorted((r.text, r.id) for r in pairs.collect()) == want
    needs = {r.pattern: r.n for r in rules.select("pattern", lookups.needed_literals(F.col("pattern")).alias("n")).collect()}
    assert needs["knee|hip joint"] == ["knee", "hip joint"] and needs["ab|knee"] == [] and needs["Total|"] == [] and needs["colou?rs"] == ["colo"]
    assert all(needs[p] == [] for p in ("(?i)KNEE", "[kx]nee", "\\\\bhip", "", "ee", "x{3}"))


def test_many_rules_and_texts_need_no_loop(spark):
    rules = spark.sql("select cast(id as string) as priority, concat('code ', lpad(id * 7919 % 20000, 5, '0'), '.*end') as pattern, id as c from range(20000)")
    texts = spark.sql("select id as code, concat('some code ', lpad(id % 20000, 5, '0'), if(id % 2 = 0, ' at the end', ' stop')) as text from range(100000)")
    pairs = lookups.matching_pairs(texts, "text", rules, "pattern")
    plain = {r.code: r.pattern for r in pairs.select("code", "pattern").collect()}
    assert len(plain) == 50_000 and all(plain[i] == f"code {i % 20000:05d}.*end" for i in (0, 2, 19998, 99998))


def test_rules_match_by_kind_and_pick_first_category(spark):
    stays = spark.sql("select * from values ('s1','E1','r1'),('s2','r1','E1'),('s3','E9','r9') as t(id, ec, rc)")
    items = spark.sql("select * from values ('s3','p1'),('s1','p1'),('zz','p1') as t(id, code)")
    rules = spark.sql(
        "select * from values ('encounter_code','E1','surgery'),('reason_code','r1','cancer'),('procedure_code','p1','transplant')"
        " as t(match_on, code, category)"
    )
    got = lookups.match_rules(stays, items, rules, "id", {"encounter_code": "ec", "reason_code": "rc"}, "procedure_code", "code")
    assert rows(got, "id", "category") == [("s1", "cancer"), ("s3", "transplant")]


# ---- scores ---------------------------------------------------------------------------------------


def naive_tiers(scores):
    n, out = len(scores), []
    known = [s for s in scores if s is not None]
    for s in scores:
        above = len(known) if s is None else sum(1 for o in known if o > s)
        rank = above / (n - 1) if n > 1 else 0.0
        out.append("High" if rank < 0.1 else "Medium" if rank < 0.3 else "Low")
    return out


@pytest.mark.parametrize("scores", [
    [5], [None], [3] * 20, [9] * 8 + list(range(8)), list(range(20)) + [19, 19, 18], [None] * 30 + [1, 2],
    [None, None, 4, 4, 2, 1, 0], [7, None],
])
def test_tiers_equal_percent_rank(spark, scores):
    df = spark.createDataFrame(list(enumerate(scores)), "id int, s int")
    got = score.percentile_tier(df, "s", TIER_CUTS, LOWEST_TIER, "tier").orderBy("id").collect()
    assert [r.tier for r in got] == naive_tiers(scores)


def test_tier_of_no_rows(spark):
    df = spark.createDataFrame([], "id int, s int")
    assert score.percentile_tier(df, "s", TIER_CUTS, LOWEST_TIER, "tier").count() == 0


def test_global_rank_is_gapless_over_many_partitions(spark):
    df = spark.range(5000).select("id", (F.col("id") % 3).alias("score")).repartition(16)
    order = [F.col("score").desc(), F.col("id")]
    got = [r.id for r in score.global_rank(df, order, "n").orderBy("n").collect()]
    assert got == sorted(range(5000), key=lambda i: (-(i % 3), i))
    assert [r.n for r in score.global_rank(df, order, "n").orderBy("n").collect()] == list(range(1, 5001))
    assert score.global_rank(df.filter("id < 0"), order, "n").count() == 0


@pytest.mark.parametrize("points, text", [
    ((4, 0, 5, 1), "C (+5); L (+4); E (+1)"), ((2, 3, 2, 2), "A (+3); L (+2); C (+2)"), ((0, 0, 0, 0), ""),
    ((None, 3, None, 0), "A (+3)"),
])
def test_top_reasons(spark, points, text):
    df = spark.createDataFrame([points], "l int, a int, c int, e int")
    reasons = [(F.col(x), F.lit(x.upper())) for x in "lace"]
    assert df.select(score.top_reasons(reasons)).first()[0] == text


# ---- months ---------------------------------------------------------------------------------------


def test_months_of_an_interval(spark):
    data = [
        ("open", date(2020, 11, 15), None), ("clipped", date(2019, 3, 1), date(2020, 2, 1)),
        ("one", date(2020, 5, 3), date(2020, 5, 20)), ("reversed", date(2020, 6, 1), date(2020, 4, 1)),
        ("same month reversed", date(2020, 6, 20), date(2020, 6, 1)), ("future", date(2021, 3, 1), None),
        ("before", date(2018, 1, 1), date(2018, 5, 1)), ("no start", None, date(2020, 1, 1)),
    ]
    df = spark.createDataFrame(data, "id string, s date, e date")
    got = {}
    for r in intervals.explode_months(df, "s", "e", PERIOD).collect():
        got.setdefault(r.id, []).append(r.month_start.month)
    assert {k: sorted(v) for k, v in got.items()} == {
        "open": [11, 12], "clipped": [1, 2], "one": [5], "same month reversed": [6],
    }


def test_active_months_equal_the_range_join(spark):
    import random

    random.seed(7)
    people = [(i, random.choice([None, date(1950, 1, 1), date(2020, 3, 1), date(2020, 3, 2)]),
               random.choice([None, None, date(2020, 6, 15), date(2020, 7, 1), date(2019, 12, 31)])) for i in range(40)]
    visits = [(random.randrange(45), date(random.randint(2017, 2021), random.randint(1, 12), random.randint(1, 28)))
              for _ in range(120)]
    p = spark.createDataFrame(people, "id int, born date, died date")
    v = spark.createDataFrame(visits, "id int, day date")
    got = {
        r.month_start: r.n for r in intervals.active_per_month(
            v, p, key="id", day="day", alive_from="born", alive_to="died", lookback=24, period=PERIOD, out="n"
        ).collect()
    }
    expected = {}
    for m in range(1, 13):
        start = date(2020, m, 1)
        first = date(2018, m, 1)
        seen = {i for i, d in visits if first <= d.replace(day=1) <= start}
        n = sum(1 for i, b, d in people if i in seen and b and b <= start and (d is None or d >= start))
        if n:
            expected[start] = n
    assert got == expected


def test_member_month_rules(spark):
    cover = [
        ("two", "med", "m1", date(2020, 1, 1), date(2020, 2, 10)), ("two", "com", "m2", date(2020, 2, 5), date(2020, 3, 1)),
        ("self", "self", "m3", date(2020, 1, 1), None), ("odd", "odd", "m4", date(2020, 1, 1), None),
        ("dead", "med", "m5", date(2020, 1, 1), None), ("stranger", "med", "m6", date(2020, 1, 1), None),
    ]
    t = {
        "coverage": spark.createDataFrame(cover, "patient_id string, payer_id string, member_id string, start_date date, end_date date"),
        "payer": spark.sql("select * from values ('med','medicare','Medicare'),('com','commercial','Commercial'),"
                           "('self','self_pay','Self-Pay'),('odd',cast(null as string),cast(null as string)) as t(payer_id, payer_type, payer_category)"),
        "patient": spark.sql("select * from values ('two',cast(null as date)),('self',null),('odd',null),('dead',date'2020-02-15')"
                             " as t(patient_id, death_date)"),
    }
    got = rows(gold.build_fact_member_month(t, PERIOD), "patient_id", "month_date_key", "payer_id")
    assert got == [
        ("dead", 20200101, "med"), ("dead", 20200201, "med"),
        ("two", 20200101, "med"), ("two", 20200201, "com"), ("two", 20200301, "com"),
    ]


def brute_tiers(values, cuts, lowest):
    """Percent rank by counting the higher values of each; NaN is the highest, NULL the lowest."""
    def place(v):
        return (0, 0.0) if v is None else (2, 0.0) if v != v else (1, v)

    tiers = []
    for v in values:
        above = sum(place(w) > place(v) for w in values)
        rank = above / (len(values) - 1) if len(values) > 1 else 0.0
        tiers.append(next((label for label, cut in cuts if rank < cut), lowest))
    return tiers


NAN, INF = float("nan"), float("inf")
SCORES = {
    "ties": ("int", [1, 2, 2, 2, 3, 3, 9, 9, None, None]),
    "one": ("int", [7]), "one missing": ("int", [None]), "all missing": ("double", [None] * 7), "all alike": ("bigint", [5] * 50),
    "far apart": ("double", [10.0 ** k for k in range(-300, 308, 4)] + [-(10.0 ** k) for k in range(-300, 308, 5)]),
    "not finite": ("double", [NAN, NAN, INF, INF, -INF, 1.0, 2.0, None, -INF, 0.0, -0.0] * 4), "never finite": ("double", [NAN, INF, -INF, None] * 5),
    "tiny": ("double", [5e-324 * k for k in range(40)]), "huge integers": ("bigint", [2**63 - 1 - k for k in range(30)] + [-(2**63) + k for k in range(30)]),
    "decimals": ("decimal(20,6)", [Decimal(k * k) / 1000 for k in range(300)]), "single": ("float", [0.1 * k for k in range(200)]),
}


@pytest.mark.parametrize("name", SCORES)
def test_tiers_match_percent_rank_by_counting(spark, name):
    cuts = (("None", 0.0), ("High", 0.1), ("Medium", 0.3), ("Most", 0.95))
    kind, values = SCORES[name]
    df = spark.createDataFrame([(i, None if v is None else str(v) if kind.startswith("decimal") else v) for i, v in enumerate(values)],
                               f"id int, s {'string' if kind.startswith('decimal') else kind}").withColumn("s", F.col("s").cast(kind))
    exact = [r.s for r in df.orderBy("id").collect()]
    tiered = score.percentile_tier(df, "s", cuts, "Low", "tier")
    assert [r.tier for r in tiered.orderBy("id").collect()] == brute_tiers(exact, cuts, "Low")


def test_values_at_places_take_no_sort(spark):
    rng = random.Random(3)
    values = [rng.lognormvariate(0, 9) for _ in range(20_000)]
    df = spark.createDataFrame([(v,) for v in values], "s double")
    counts = df.groupBy("s").agg(F.count("*").alias("n"))
    places = [0, 1, 17, 1999, 10_000, 19_999, 20_000]
    ordered = sorted(values, reverse=True)
    assert score.values_at(counts, "s", "n", places, bins=16) == [ordered[p] if p < len(ordered) else None for p in places]
    text = score.percentile_tier(df, "s", (("High", 0.1),), "Low", "t")._jdf.queryExecution().toString()
    assert "Sort" not in text and "Exchange" not in text and "Window" not in text
