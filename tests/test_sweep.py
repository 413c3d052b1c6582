"""Sweeps over events: places among all rows, chunks with what lies beyond them, and all outcomes of a stay at once."""

import random
from datetime import date, datetime, timedelta
from statistics import median

import pytest
from pyspark.sql import functions as F

from care_lake import fixed
from care_lake.operators import episodes, lookups, sweep
from care_lake.plans import admissions


def test_places_among_all_rows(spark):
    rng = random.Random(2)
    rows = [(0 if rng.random() < 0.6 else rng.randrange(9), 5 if rng.random() < 0.5 else rng.randrange(50), rng.randrange(2)) for _ in range(3000)]
    df = spark.createDataFrame(rows, "k int, x int, e int").repartition(7)
    got = sorted((r.k, r.x, r.e, r.n) for r in sweep.counted_before(df, ["k", "x", "e"], "e", "n").collect())
    before, want = 0, []
    for k, x, e in sorted(rows):
        want.append((k, x, e, before))
        before += e
    assert got == want
    assert sweep.counted_before(df.where("k > 99"), ["k", "x", "e"], "e", "n").count() == 0


def test_a_day_with_a_third_of_all_rows_is_split(spark):
    """The busiest key owns one day, and half of that at one instant; no range of the sort is much larger than the others."""
    day = datetime(2020, 5, 5)
    events = spark.range(60_000).selectExpr(
        "if(id % 3 = 0, 'hot', cast(id % 500 as string)) as who",
        "if(id % 3 = 0, timestamp'2020-05-05 12:00:00' + make_dt_interval(0, 0, 0, if(id % 2 = 0, 0, id % 7000)), timestamp'2020-01-01' + make_dt_interval(id % 300)) as at")
    anchors = spark.createDataFrame([("hot", day + timedelta(hours=h)) for h in (11, 12, 13, 14, 30)] + [("7", day)], "who string, at timestamp")
    got = episodes.count_between(anchors, events, key="who", anchor_ts="at", event_ts="at", seconds=(-3600, 0), out="n")
    ticks = [0 if i % 2 == 0 else i % 7000 for i in range(0, 60_000, 3)]
    want = {h: sum(3600 * (h - 13) <= s < 3600 * (h - 12) for s in ticks) for h in (11, 12, 13, 14, 30)}
    assert {int((r.at - day).total_seconds() // 3600): r.n for r in got.collect() if r.who == "hot"} == want
    assert {r.n for r in got.collect() if r.who == "7"} == {0}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        placed = events.select("who", F.unix_micros("at").alias("x"), F.monotonically_increasing_id().alias("r")).repartitionByRange("who", "x", "r")
        sizes = [r["count"] for r in placed.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(sizes) == 8 and max(sizes) <= 2 * median(sizes)


def test_events_reach_the_chunks_that_look_for_them(spark):
    df = spark.createDataFrame([(x,) for x in (-1, 0, 99, 100, 105, 250)], "at long")
    got = {r.at: r.chunks for r in sweep.spread(df, "at", 100, back=100, ahead=10).groupBy("at").agg(F.sort_array(F.collect_list("chunk")).alias("chunks")).collect()}
    for x, chunks in got.items():
        assert chunks == [c for c in range(-500, 500, 100) if c - 100 <= x < c + 100 + 10]


def made(spark, seed, n, hot):
    """Stays, visits and conditions of few patients around borders of chunks; stays may end before they begin."""
    rng = random.Random(seed)
    width = 180
    border = date(1970, 1, 1) + timedelta(days=width * 55)
    moments = [datetime(border.year, border.month, border.day) + timedelta(days=d, hours=h) for d in (-200, -181, -180, -31, -30, -1, 0, 1, 29, 30, 31, 179, 180, 181)
               for h in (0, 1, 11, 12, 13, 23)]
    def at():
        return rng.choice(moments) + timedelta(hours=rng.choice([0, 0, -12, -1, 1]), microseconds=rng.choice([0, 0, 1]))
    def who():
        return "hot" if rng.random() < hot else f"p{rng.randrange(5)}"
    stays = []
    for i in range(n):
        start = at()
        end = start.date() + timedelta(days=rng.choice([0, 1, 3, 29, -40, -2]))
        stays.append((f"s{i:04d}", who(), start, start.date(), end, float(i), float(i) / 2, rng.random() < 0.2))
    stays = spark.createDataFrame(stays, "encounter_id string, patient_id string, start_ts timestamp, admit_date date, discharge_date date, medical_cost double, payer_paid double, is_planned boolean")
    visits = [(f"v{i}", who(), a, a.date()) for i, a in ((i, at()) for i in range(2 * n))]
    visits = spark.createDataFrame(visits + [("v-", "p1", None, None), ("v--", None, moments[0], moments[0].date())], "encounter_id string, patient_id string, start_ts timestamp, start_date date")
    categories = [c for over in fixed.CHARLSON_OVERLAPS for c in over[:2]] + ["other"]
    conditions = []
    for _ in range(n):
        first = at().date() - timedelta(days=rng.choice([0, 400, 1000]))
        conditions.append((who(), rng.choice(categories), first, rng.choice([None, first + timedelta(days=rng.choice([0, 5, 300, -3]))])))
    conditions = spark.createDataFrame(conditions, "patient_id string, charlson_category string, start_date date, stop_date date")
    weights = spark.createDataFrame([(c, str(i + 1)) for i, c in enumerate(categories)], "charlson_category string, weight string")
    return stays, visits, {"condition": conditions, "charlson_weights": weights}


@pytest.mark.parametrize("seed, n, hot", [(1, 60, 0.2), (2, 150, 0.7)])
def test_a_sweep_gives_what_each_operator_gives(spark, seed, n, hot):
    stays, visits, t = made(spark, seed, n, hot)
    got = admissions.outcomes(stays, stays, visits, t)
    one = admissions.with_readmission(stays, stays.filter(~F.col("is_planned")))
    one = admissions.with_post_discharge_ed(one, visits, stays)
    one = admissions.with_prior_ed(admissions.with_came_through_ed(one, visits), visits)
    one = admissions.with_charlson(one, t)
    assert sorted(map(str, got.collect())) == sorted(map(str, one.select(got.columns).collect()))
    assert got.filter("is_readmitted_30_days").count() and got.filter("post_discharge_ed_visits > 0").count() and got.filter("charlson_score > 0").count()


def test_no_stays_no_outcomes(spark):
    stays, visits, t = made(spark, 1, 5, 0.5)
    assert admissions.outcomes(stays.filter("false"), stays, visits, t).count() == 0


def test_ranges_meet_values_by_cells(spark):
    rng = random.Random(8)
    ranges = [(i, *sorted((rng.randrange(-70, 70), rng.randrange(-70, 70)))) for i in range(60)] + [(99, 5, 4), (98, None, 3), (97, -(10 ** 9), 10 ** 9)]
    values = [*range(-80, 80), None, 10 ** 9]
    df = spark.createDataFrame([(v,) for v in values], "v long")
    table = spark.createDataFrame(ranges, "r int, lo long, hi long")
    pairs = lookups.range_pairs(df, table, "v", "lo", "hi")
    got = sorted((r.v, r.r) for r in pairs.collect())
    assert got == sorted((v, i) for v in values if v is not None for i, lo, hi in ranges if lo is not None and lo <= v <= hi)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "SortMergeJoin" in pairs._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in lookups.range_pairs(df, table, "v", "lo", "hi")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_scale_of_100_000_bands(spark):
    bands = spark.sql("select 'L' as component, cast(id * 10 as string) as lower_bound, cast(id * 10 + 8 as string) as upper_bound, cast(id % 7 as string) as points from range(100000)")
    df = spark.sql("select cast(id * 499 as int) as v from range(2100)")
    got = {r.v: r.p for r in lookups.band_lookup(df, bands, "L", "v", "p").collect()}
    assert got == {v: v // 10 % 7 if v < 1_000_000 and v % 10 < 9 else None for v in range(0, 2100 * 499, 499)}
