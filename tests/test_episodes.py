"""Follow-up operators against brute force, on edges and on a person who owns most rows."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from care_lake.operators import episodes

HOUR = 3600
T0 = datetime(2020, 3, 1, 8, 0, 0)


def make(seed, n, people):
    """n events; person 0 has about half of them, many at equal times."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        who = 0 if rng.random() < 0.5 else rng.randrange(people)
        at = T0 + timedelta(hours=rng.choice([0, 1, 12, 24, 36, 500]) * rng.randint(0, 8), seconds=rng.choice([0, 0, 1]))
        out.append((f"e{i}", who, at, at.date() + timedelta(days=rng.randint(-2, 3))))
    return out


def frame(spark, events):
    return spark.createDataFrame(events, "id string, who int, at timestamp, out_day date").withColumn(
        "day", F.to_date("at")
    )


@pytest.mark.parametrize("seed", range(4))
def test_first_followup(spark, seed):
    events = make(seed, 120, 6)
    df = frame(spark, events)
    got = episodes.first_followup(
        df, df, key="who", anchor_id="id", anchor_day="out_day", event_id="id", event_day="day", event_order="at",
        payload=[], days=(1, 30),
    )
    expected = {}
    for i, who, _, out_day in events:
        later = [(at, j) for j, w, at, _ in events if w == who and j != i and 1 <= (at.date() - out_day).days <= 30]
        expected[i] = min(later)[1] if later else None
    assert {r.id: r.followup and r.followup._id for r in got.collect()} == expected


@pytest.mark.parametrize("gap, found", [(0, None), (1, "b"), (30, "b"), (31, None)])
def test_followup_gap(spark, gap, found):
    day = date(2020, 1, 1)
    df = spark.createDataFrame(
        [("a", 1, day, day), ("b", 1, day + timedelta(gap), day + timedelta(gap)), ("c", 2, day + timedelta(5), day)],
        "id string, who int, day date, out_day date",
    )
    row = episodes.first_followup(
        df, df, key="who", anchor_id="id", anchor_day="out_day", event_id="id", event_day="day", event_order="day",
        payload=[], days=(1, 30),
    ).filter("id = 'a'").first()
    assert (row.followup and row.followup._id) == found


def test_an_event_does_not_follow_itself(spark):
    """A stay whose end lies before its start would otherwise find itself."""
    df = spark.createDataFrame(
        [("a", 1, date(2020, 1, 5), date(2020, 1, 1)), ("b", 1, date(2020, 1, 9), date(2020, 1, 9))],
        "id string, who int, day date, out_day date",
    )
    got = episodes.first_followup(
        df, df, key="who", anchor_id="id", anchor_day="out_day", event_id="id", event_day="day", event_order="day",
        payload=[], days=(1, 30),
    )
    assert {r.id: r.followup and r.followup._id for r in got.collect()} == {"a": "b", "b": None}


@pytest.mark.parametrize("seed", range(3))
def test_count_followup(spark, seed):
    events = make(seed, 120, 6)
    df = frame(spark, events)
    got = episodes.count_followup(df, df, key="who", anchor_day="out_day", event_day="day", days=(1, 30), out="n")
    expected = {
        i: sum(1 for _, w, at, _ in events if w == who and 1 <= (at.date() - out_day).days <= 30)
        for i, who, _, out_day in events
    }
    assert {r.id: r.n for r in got.collect()} == expected


@pytest.mark.parametrize("seed, seconds", [(0, (-12 * HOUR, HOUR)), (1, (-HOUR, 12 * HOUR)), (2, (-7, 5)), (3, (0, HOUR))])
def test_has_event_within(spark, seed, seconds):
    left, right = make(seed, 80, 5), make(seed + 100, 60, 5)
    got = episodes.has_event_within(
        frame(spark, left), frame(spark, right), key="who", anchor_ts="at", event_ts="at", seconds=seconds, out="hit"
    )
    lo, hi = (timedelta(seconds=s) for s in seconds)
    expected = {i: any(w == who and at + lo <= t <= at + hi for _, w, t, _ in right) for i, who, at, _ in left}
    assert {r.id: r.hit for r in got.collect()} == expected


@pytest.mark.parametrize("offset, hit", [
    (-12 * HOUR, True), (-12 * HOUR - 1, False), (HOUR, True), (HOUR + 1, False), (0, True),
])
def test_range_bounds_are_included(spark, offset, hit):
    for base in (T0, datetime(1960, 1, 1), datetime(1970, 1, 1)):
        left = frame(spark, [("a", 1, base, base.date())])
        right = frame(spark, [("b", 1, base + timedelta(seconds=offset), base.date())])
        got = episodes.has_event_within(
            left, right, key="who", anchor_ts="at", event_ts="at", seconds=(-12 * HOUR, HOUR), out="hit"
        ).first()
        assert got.hit is hit


def test_missing_keys_and_times(spark):
    left = frame(spark, [("a", None, T0, None), ("b", 1, None, None)])
    right = frame(spark, [("c", None, T0, None), ("d", 1, None, None)])
    kwargs = dict(key="who", anchor_ts="at", event_ts="at", seconds=(-HOUR, HOUR))
    assert not any(r.hit for r in episodes.has_event_within(left, right, out="hit", **kwargs).collect())
    assert {r.n for r in episodes.count_between(left, right, out="n", **kwargs).collect()} == {0}
    alone = episodes.not_followed_by(left, right, key="who", ts="at", other_ts="at", seconds=(-HOUR, HOUR))
    assert alone.count() == 2


@pytest.mark.parametrize("seed, seconds", [(0, (-180 * 24 * HOUR, -12 * HOUR)), (1, (-24 * HOUR, 0)), (2, (-HOUR, HOUR))])
def test_count_between(spark, seed, seconds):
    left, right = make(seed, 80, 5), make(seed + 50, 90, 5)
    got = episodes.count_between(
        frame(spark, left), frame(spark, right), key="who", anchor_ts="at", event_ts="at", seconds=seconds, out="n"
    )
    lo, hi = (timedelta(seconds=s) for s in seconds)
    expected = {i: sum(1 for _, w, t, _ in right if w == who and at + lo <= t < at + hi) for i, who, at, _ in left}
    assert {r.id: r.n for r in got.collect()} == expected


WEIGHTS = {"dm": 1, "dmc": 2, "chf": 1, "ca": 2}


def active(spark, anchors, periods):
    w = spark.createDataFrame([(c, str(v)) for c, v in WEIGHTS.items()], "cat string, weight string")
    a = spark.createDataFrame(anchors, "id string, who int, day date")
    p = spark.createDataFrame(periods, "who int, cat string, s date, e date")
    out = episodes.active_weight(
        a, p, w, key="who", anchor_day="day", category="cat", start="s", stop="e", weight="weight",
        overlaps=[("dm", "dmc", 1)], out="score",
    )
    return {r.id: r.score for r in out.collect()}


def test_active_weight_edges(spark):
    d = date(2020, 6, 1)
    day = timedelta(1)
    cases = {
        "none": [], "same twice": [("chf", d, None), ("chf", d - day, None)],
        "stops that day": [("chf", d - 9 * day, d)], "stopped before": [("chf", d - 9 * day, d - day)],
        "starts that day": [("ca", d, None)], "starts later": [("ca", d + day, None)],
        "both diabetes": [("dm", d, None), ("dmc", d, None)], "unknown": [("zzz", d, None)],
        "reversed": [("ca", d, d - 5 * day)], "no start": [("ca", None, None)],
        "gap": [("chf", d - 90 * day, d - 60 * day), ("chf", d - 10 * day, d + 10 * day)],
    }
    anchors = [(name, i, d) for i, name in enumerate(cases)]
    periods = [(i, *p) for i, ps in enumerate(cases.values()) for p in ps]
    assert active(spark, anchors, periods) == {
        "none": 0, "same twice": 1, "stops that day": 1, "stopped before": 0, "starts that day": 2, "starts later": 0,
        "both diabetes": 2, "unknown": 0, "reversed": 0, "no start": 0, "gap": 1,
    }


@pytest.mark.parametrize("seed", range(3))
def test_active_weight(spark, seed):
    rng = random.Random(seed)

    def some_day():
        return date(2020, 1, 1) + timedelta(rng.randrange(60))

    anchors = [(f"a{i}", rng.randrange(4), some_day()) for i in range(60)]
    periods = [
        (rng.randrange(4), rng.choice([*WEIGHTS, None]), some_day(), rng.choice([None, some_day()])) for _ in range(40)
    ]
    expected = {}
    for i, who, d in anchors:
        cats = {c for w, c, s, e in periods if w == who and c and s <= d and (e is None or e >= d)}
        expected[i] = sum(WEIGHTS[c] for c in cats) - (1 if {"dm", "dmc"} <= cats else 0)
    assert active(spark, anchors, periods) == expected


def test_no_operator_joins_events_pairwise(spark):
    """Every join of the follow-up operators is an equality join."""
    df = frame(spark, make(1, 50, 4))
    kwargs = dict(key="who", anchor_ts="at", event_ts="at", seconds=(-HOUR, HOUR), out="x")
    plans = [
        episodes.has_event_within(df, df, **kwargs), episodes.count_between(df, df, **kwargs),
        episodes.count_followup(df, df, key="who", anchor_day="day", event_day="day", days=(1, 30), out="x"),
    ]
    for plan in plans:
        text = plan._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in text and "Cartesian" not in text
