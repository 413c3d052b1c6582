"""Events around an anchor: follow-ups, look-backs and conditions active on a day.

None of these operators joins every anchor with every event of the same person. They reduce both
sides to a grid first - one row per person and day, or per person and time bucket - and then use a
window or a join whose groups are limited by the calendar, not by the number of events. A person
who owns a third of all rows therefore costs one row per day like everybody else. Counts between two
instants, which no day can hold, come from a range-sorted stream instead.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from care_lake.operators.dedup import pick_best
from care_lake.operators.sweep import counted_before

MICROS = 1_000_000


def _micros(ts: str) -> Column:
    return F.unix_micros(F.col(ts).cast("timestamp"))


def _bucket(x: Column, width: int) -> Column:
    """Start of the bucket that holds x; whole numbers only, so bounds are exact."""
    return x - F.pmod(x, F.lit(width))


def _day_marks(anchors: DataFrame, key: str, day: str) -> DataFrame:
    return (
        anchors.select(F.col(key).alias("_key"), F.unix_date(day).alias("_day"))
        .dropna()
        .distinct()
        .withColumn("_mark", F.lit(True))
    )


def _join_day(anchors: DataFrame, found: DataFrame, key: str, day: str) -> DataFrame:
    same = (F.col(key) == F.col("_key")) & (F.unix_date(day) == F.col("_day"))
    return anchors.join(found, same, "left").drop("_key", "_day")


def first_followup(
    anchors: DataFrame,
    events: DataFrame,
    *,
    key: str,
    anchor_id: str,
    anchor_day: str,
    event_id: str,
    event_day: str,
    event_order: str,
    payload: Sequence[str],
    days: tuple[int, int],
    out: str = "followup",
) -> DataFrame:
    """Add the earliest other event of the same key that falls ``days`` after the anchor day.

    ``out`` is a struct of order, id, day and payload, NULL when nothing followed. Two events
    per day are kept because the first one may be the anchor itself.
    """
    event = F.struct(
        F.col(event_order).alias("_at"), F.col(event_id).alias("_id"), F.col(event_day).alias("_on"), *payload
    )
    rows = events.select(F.col(key).alias("_key"), F.unix_date(event_day).alias("_day"), event.alias("_event"))
    daily = (
        pick_best(rows.filter("_key is not null and _day is not null"), ["_key", "_day"], [F.col("_event")], n=2)
        .groupBy("_key", "_day")
        .agg(F.collect_list("_event").alias("_events"))
    )
    grid = daily.unionByName(_day_marks(anchors, key, anchor_day), allowMissingColumns=True)
    ahead = Window.partitionBy("_key").orderBy("_day").rangeBetween(*days)
    found = (
        grid.withColumn("_candidates", F.flatten(F.collect_list("_events").over(ahead)))
        .filter("_mark")
        .select("_key", "_day", F.slice(F.array_sort("_candidates"), 1, 2).alias("_candidates"))
    )
    joined = _join_day(anchors, found, key, anchor_day)
    others = F.filter("_candidates", lambda e: e["_id"] != F.col(anchor_id))
    return joined.withColumn(out, F.get(others, F.lit(0))).drop("_candidates")


def count_followup(
    anchors: DataFrame, events: DataFrame, *, key: str, anchor_day: str, event_day: str, days: tuple[int, int],
    out: str,
) -> DataFrame:
    """Add the number of events of the same key that fall ``days`` after the anchor day."""
    daily = (
        events.select(F.col(key).alias("_key"), F.unix_date(event_day).alias("_day"))
        .dropna()
        .groupBy("_key", "_day")
        .agg(F.count("*").alias("_n"))
    )
    grid = daily.unionByName(_day_marks(anchors, key, anchor_day), allowMissingColumns=True)
    ahead = Window.partitionBy("_key").orderBy("_day").rangeBetween(*days)
    found = (
        grid.withColumn("_sum", F.sum("_n").over(ahead)).filter("_mark").select("_key", "_day", "_sum")
    )
    joined = _join_day(anchors, found, key, anchor_day)
    return joined.withColumn(out, F.coalesce("_sum", F.lit(0))).drop("_sum")


def has_event_within(
    anchors: DataFrame, events: DataFrame, *, key: str, anchor_ts: str, event_ts: str, seconds: tuple[int, int],
    out: str,
) -> DataFrame:
    """Add whether an event of the same key lies in [anchor + lo, anchor + hi], bounds included.

    Time is cut into buckets as wide as the range. The range then covers the end of one bucket and
    the start of the next, so the last event of the first and the first event of the second decide.
    """
    width = (seconds[1] - seconds[0]) * MICROS
    ts = _micros(event_ts)
    here = _bucket(ts, width)
    none = F.lit(None).cast("long")
    sides = F.array(
        F.struct(here.alias("_bucket"), ts.alias("_last"), none.alias("_first")),
        F.struct((here - width).alias("_bucket"), none.alias("_last"), ts.alias("_first")),
    )
    edges = (
        events.filter(F.col(key).isNotNull() & F.col(event_ts).isNotNull())
        .select(F.col(key).alias("_key"), F.inline(sides))
        .groupBy("_key", "_bucket")
        .agg(F.max("_last").alias("_last"), F.min("_first").alias("_first"))
    )
    lo = _micros(anchor_ts) + seconds[0] * MICROS
    return (
        anchors.withColumn("_lo", lo)
        .join(
            edges,
            (F.col(key) == F.col("_key")) & (_bucket(F.col("_lo"), width) == F.col("_bucket")),
            "left",
        )
        .withColumn(out, F.coalesce(F.col("_last") >= F.col("_lo"), F.lit(False))
                    | F.coalesce(F.col("_first") <= F.col("_lo") + width, F.lit(False)))
        .drop("_lo", "_key", "_bucket", "_last", "_first")
    )


def not_followed_by(
    events: DataFrame, others: DataFrame, *, key: str, ts: str, other_ts: str, seconds: tuple[int, int]
) -> DataFrame:
    """Events without an event of ``others`` in the range around them."""
    flagged = has_event_within(
        events, others, key=key, anchor_ts=ts, event_ts=other_ts, seconds=seconds, out="_followed"
    )
    return flagged.filter(~F.col("_followed")).drop("_followed")


def count_between(
    anchors: DataFrame, events: DataFrame, *, key: str, anchor_ts: str, event_ts: str, seconds: tuple[int, int],
    out: str,
) -> DataFrame:
    """Add the number of events of the same key in [anchor + lo, anchor + hi).

    Events and the two bounds of every anchor form one stream, range-sorted by key and time and written. A bound's place
    among all events, whatever their key, is its place in its range plus the events of the ranges before; the difference of an
    anchor's two places is its count, since only events of its key lie between. A key that owns most rows, or one day or
    instant of it, fills as many ranges as its rows need.
    """
    seen = events.filter(F.col(key).isNotNull() & F.col(event_ts).isNotNull())
    points = seen.select(F.col(key).alias("_key"), _micros(event_ts).alias("_x"), F.lit(1).alias("_event"))
    times = anchors.select(F.col(key).alias("_key"), _micros(anchor_ts).alias("_t")).dropna()
    bounds = F.array(*[
        F.struct((F.col("_t") + s * MICROS).alias("_x"), F.lit(0).alias("_event"), F.lit(upper).alias("_upper"))
        for s, upper in zip(seconds, (False, True))
    ])
    marks = times.select("_key", "_t", F.inline(bounds))
    placed = counted_before(points.unionByName(marks, allowMissingColumns=True), ["_key", "_x", "_event"], "_event", "_place")
    counted = placed.filter("_t is not null").groupBy("_key", "_t").agg(
        (F.max(F.when(F.col("_upper"), F.col("_place"))) - F.max(F.when(~F.col("_upper"), F.col("_place")))).alias("_count")
    )
    same = (F.col(key) == F.col("_key")) & (_micros(anchor_ts) == F.col("_t"))
    return (
        anchors.join(counted, same, "left")
        .withColumn(out, F.coalesce("_count", F.lit(0)))
        .drop("_key", "_t", "_count")
    )


def _weight_changes(
    periods: DataFrame, weights: DataFrame, key: str, category: str, start: str, stop: str, weight: str,
    overlaps: Sequence[tuple[str, str, int]],
) -> tuple[DataFrame, list[str], Column]:
    """Changes per key and day (``_key, _day`` and the named columns), and the score over their running sums."""
    first, last = F.unix_date(start), F.unix_date(stop)
    valid = periods.filter(
        F.col(key).isNotNull() & F.col(category).isNotNull() & F.col(start).isNotNull()
        & (F.col(stop).isNull() | (F.col(stop) >= F.col(start)))
    )
    steps = F.array(
        F.struct(first.alias("_day"), F.lit(1).alias("_step")),
        F.struct((last + 1).alias("_day"), F.lit(-1).alias("_step")),
    )
    opened = (
        valid.select(F.col(key).alias("_key"), F.col(category).alias("_category"), F.inline(steps))
        .filter("_day is not null")
        .groupBy("_key", "_category", "_day")
        .agg(F.sum("_step").alias("_step"))
    )
    by_category = Window.partitionBy("_key", "_category").orderBy("_day")
    switched = (
        opened.withColumn("_open", F.sum("_step").over(by_category))
        .withColumn("_was", F.col("_open") - F.col("_step"))
        .withColumn(
            "_change", F.when((F.col("_open") > 0) & (F.col("_was") <= 0), 1)
            .when((F.col("_open") <= 0) & (F.col("_was") > 0), -1)
        )
        .filter("_change is not null")
    )
    table = weights.select(F.col(category).alias("_category"), F.col(weight).cast("int").alias("_weight"))
    tracked = sorted({c for dropped, kept, _ in overlaps for c in (dropped, kept)})
    changes = {"_score": F.sum(F.col("_change") * F.col("_weight"))}
    changes |= {
        f"_active_{i}": F.sum(F.when(F.col("_category") == c, F.col("_change")).otherwise(0))
        for i, c in enumerate(tracked)
    }
    daily = (
        switched.join(table, "_category")
        .groupBy("_key", "_day")
        .agg(*[expr.alias(name) for name, expr in changes.items()])
    )
    score = F.col("_score")
    for dropped, kept, points in overlaps:
        both = (F.col(f"_active_{tracked.index(dropped)}") > 0) & (F.col(f"_active_{tracked.index(kept)}") > 0)
        score = score - F.when(both, points).otherwise(0)
    return daily, list(changes), score


def weight_by_day(
    periods: DataFrame, weights: DataFrame, *, key: str, category: str, start: str, stop: str, weight: str,
    overlaps: Sequence[tuple[str, str, int]], out: str,
) -> DataFrame:
    """The summed weight of the active categories as a step function: ``key, day, next_day, out`` from one change to the next.

    Rows of a key meet once, reduced to one per day and category before.
    """
    daily, names, score = _weight_changes(periods, weights, key, category, start, stop, weight, overlaps)
    by_day = Window.partitionBy("_key").orderBy("_day")
    so_far = by_day.rowsBetween(Window.unboundedPreceding, 0)
    found = daily.withColumns({name: F.sum(name).over(so_far) for name in names} | {"_next": F.lead("_day").over(by_day)})
    return found.select(F.col("_key").alias(key), F.col("_day").alias("day"), F.col("_next").alias("next_day"), score.cast("int").alias(out))


def active_weight(
    anchors: DataFrame,
    periods: DataFrame,
    weights: DataFrame,
    *,
    key: str,
    anchor_day: str,
    category: str,
    start: str,
    stop: str,
    weight: str,
    overlaps: Sequence[tuple[str, str, int]],
    out: str,
) -> DataFrame:
    """Add the summed weight of the distinct categories active on the anchor day.

    A period counts from its start to its stop, both included; without a stop it is still running.
    Each (dropped, kept, points) in ``overlaps`` takes points off when both categories are active.
    Days on which a category becomes active or inactive carry its weight as a change; the score of
    a day is the running sum of the changes.
    """
    daily, names, score = _weight_changes(periods, weights, key, category, start, stop, weight, overlaps)
    grid = daily.unionByName(_day_marks(anchors, key, anchor_day), allowMissingColumns=True)
    so_far = Window.partitionBy("_key").orderBy("_day").rangeBetween(Window.unboundedPreceding, 0)
    running = {name: F.coalesce(F.sum(name).over(so_far), F.lit(0)) for name in names}
    found = grid.withColumns(running).filter("_mark").select("_key", "_day", score.alias("_total"))
    joined = _join_day(anchors, found, key, anchor_day)
    return joined.withColumn(out, F.coalesce("_total", F.lit(0)).cast("int")).drop("_total")
