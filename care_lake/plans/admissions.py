"""Index admissions: inpatient stays followed for 30 days, with LACE score and risk tier."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from care_lake import fixed
from care_lake.functions.calendar import age_at, date_key
from care_lake.operators.episodes import (
    active_weight,
    count_between,
    count_followup,
    first_followup,
    has_event_within,
    not_followed_by,
    weight_by_day,
)
from care_lake.operators.lookups import band_lookup, match_rules
from care_lake.operators.score import percentile_tier
from care_lake.operators.sweep import chunk_of, spread
from care_lake.plans.gold import is_hrrp, or_other, stay_days
from care_lake.session import staged
from care_lake.settings import (
    ADMISSION_AFTER_ED,
    ADULT_AGE,
    ED_BEFORE_ADMISSION,
    ED_LOOKBACK,
    FOLLOW_UP_DAYS,
    LOWEST_TIER,
    TIER_CUTS,
    Period,
)

Tables = Mapping[str, DataFrame]

SECOND = 1_000_000  # in microseconds
DAY = 86_400 * SECOND
CHUNK = -ED_LOOKBACK[0] * SECOND  # as long as anchors look back


def stays(t: Tables) -> DataFrame:
    return t["encounter"].filter(F.col("care_setting") == "Inpatient").select(
        "encounter_id",
        "patient_id",
        F.col("organization_id").alias("facility_id"),
        "payer_id",
        "start_ts",
        "end_ts",
        F.col("start_date").alias("admit_date"),
        F.col("end_date").alias("discharge_date"),
        stay_days("start_date", "end_date").alias("length_of_stay_days"),
        "encounter_type_code",
        "reason_snomed_code",
        "reason_icd10cm_code",
        "reason_description",
        or_other("reason_condition_group").alias("condition_group"),
        F.col("total_claim_cost").alias("medical_cost"),
        F.col("payer_coverage").alias("payer_paid"),
    )


def planned_stays(inpatient: DataFrame, t: Tables) -> DataFrame:
    """Stays that match a planned-admission rule, with the alphabetically first category."""
    return match_rules(
        inpatient,
        t["procedure"],
        t["planned_rules"],
        "encounter_id",
        {"encounter_code": "encounter_type_code", "reason_code": "reason_snomed_code"},
        "procedure_code",
        "snomed_code",
    ).withColumnRenamed("category", "planned_category")


def flag_planned(inpatient: DataFrame, t: Tables) -> DataFrame:
    """Stays of known patients with planned flag, age at admission and date of death."""
    known = inpatient.join(t["patient"].select("patient_id", "birth_date", "death_date"), "patient_id")
    return known.join(planned_stays(inpatient, t), "encounter_id", "left").withColumns({
        "is_planned": F.col("planned_category").isNotNull(),
        "age_at_admission": age_at("birth_date", "admit_date"),
    }).drop("birth_date")


def index_stays(flagged: DataFrame, period: Period) -> DataFrame:
    """Adults discharged alive in the period, for reasons the measure covers."""
    category = F.coalesce("planned_category", F.lit(""))
    reason = F.coalesce("reason_icd10cm_code", F.lit(""))
    return flagged.filter(
        (F.col("age_at_admission") >= ADULT_AGE)
        & (F.col("death_date").isNull() | (F.col("death_date") > F.col("discharge_date")))
        & period.contains(F.col("discharge_date"))
        & ~category.isin(*fixed.EXCLUDED_STAY_CATEGORIES)
        & ~reason.startswith(fixed.EXCLUDED_REASON_PREFIX)
    )


def ed_visits(t: Tables) -> DataFrame:
    return t["encounter"].filter(F.col("care_setting") == "Emergency").select(
        "encounter_id", "patient_id", "start_ts", "start_date"
    )


def with_readmission(index: DataFrame, flagged: DataFrame) -> DataFrame:
    """First unplanned stay that starts 1 to 30 days after the discharge."""
    found = first_followup(
        index, flagged.filter(~F.col("is_planned")),
        key="patient_id", anchor_id="encounter_id", anchor_day="discharge_date", event_id="encounter_id",
        event_day="admit_date", event_order="start_ts", payload=["medical_cost", "payer_paid"],
        days=FOLLOW_UP_DAYS, out="_next",
    )
    return found.withColumns({
        "is_readmitted_30_days": F.col("_next").isNotNull(),
        "readmission_encounter_id": F.col("_next._id"),
        "days_to_readmission": F.datediff("_next._on", "discharge_date"),
        "readmission_cost": F.col("_next.medical_cost"),
        "readmission_payer_paid": F.col("_next.payer_paid"),
    }).drop("_next")


def ed_not_admitted(ed: DataFrame, inpatient: DataFrame) -> DataFrame:
    return not_followed_by(
        ed, inpatient, key="patient_id", ts="start_ts", other_ts="start_ts", seconds=ADMISSION_AFTER_ED
    )


def with_post_discharge_ed(index: DataFrame, ed: DataFrame, inpatient: DataFrame) -> DataFrame:
    return count_followup(
        index, ed_not_admitted(ed, inpatient), key="patient_id", anchor_day="discharge_date",
        event_day="start_date", days=FOLLOW_UP_DAYS, out="post_discharge_ed_visits",
    )


def with_came_through_ed(index: DataFrame, ed: DataFrame) -> DataFrame:
    return has_event_within(
        index, ed, key="patient_id", anchor_ts="start_ts", event_ts="start_ts", seconds=ED_BEFORE_ADMISSION,
        out="came_through_ed",
    )


def with_prior_ed(index: DataFrame, ed: DataFrame) -> DataFrame:
    return count_between(
        index, ed, key="patient_id", anchor_ts="start_ts", event_ts="start_ts", seconds=ED_LOOKBACK,
        out="ed_visits_6_months",
    )


def with_charlson(index: DataFrame, t: Tables) -> DataFrame:
    return active_weight(
        index, t["condition"], t["charlson_weights"], key="patient_id", anchor_day="admit_date",
        category="charlson_category", start="start_date", stop="stop_date", weight="weight",
        overlaps=fixed.CHARLSON_OVERLAPS, out="charlson_score",
    )


def with_lace(inputs: DataFrame, bands: DataFrame) -> DataFrame:
    scored = inputs
    for component, value in (
        ("L", "length_of_stay_days"), ("C", "charlson_score"), ("E", "ed_visits_6_months"),
    ):
        scored = band_lookup(scored, bands, component, value, f"lace_{component.lower()}")
    scored = scored.withColumn(
        "lace_a", F.when(F.col("came_through_ed"), fixed.ED_ADMISSION_POINTS).otherwise(0)
    )
    return scored.withColumn("lace_score", F.expr("lace_l + lace_a + lace_c + lace_e"))


def _midnight(day: Column) -> Column:
    return F.unix_micros(day.cast("timestamp"))


def _marks(index: DataFrame) -> DataFrame:
    """The instants at which the sweep is read for each index stay; ``turn`` puts them before (0) or behind (3) what happens then."""
    at, after = F.unix_micros("start_ts"), F.date_add("discharge_date", FOLLOW_UP_DAYS[0])
    home, followed = chunk_of(at, CHUNK), chunk_of(_midnight(after), CHUNK)
    marks = {
        "back_to": (home, at + ED_LOOKBACK[0] * SECOND, 0), "back_from": (home, at + ED_LOOKBACK[1] * SECOND, 0),
        "ed_from": (home, at + ED_BEFORE_ADMISSION[0] * SECOND, 0), "admitted": (home, at, 3),
        "ed_to": (home, at + ED_BEFORE_ADMISSION[1] * SECOND, 3), "after": (followed, _midnight(after), 0),
        "until": (followed, _midnight(F.date_add("discharge_date", FOLLOW_UP_DAYS[1] + 1)), 0),
    }
    points = [F.struct(F.lit(name).alias("mark"), chunk.alias("chunk"), x.alias("at"), F.lit(turn).alias("turn")) for name, (chunk, x, turn) in marks.items()]
    return index.select("patient_id", F.col("encounter_id").alias("anchor"), "discharge_date", F.inline(F.array(*points)))


def _scores(t: Tables, last: int | None) -> DataFrame:
    """Steps of the comorbidity score, once when they begin and again at the start of every chunk they reach into."""
    steps = weight_by_day(
        t["condition"], t["charlson_weights"], key="patient_id", category="charlson_category", start="start_date",
        stop="stop_date", weight="weight", overlaps=fixed.CHARLSON_OVERLAPS, out="score",
    )
    day = lambda c: _midnight(F.date_from_unix_date(c))
    steps = steps.withColumns({"at": day("day"), "home": chunk_of(day("day"), CHUNK), "end": F.coalesce(chunk_of(day("next_day"), CHUNK), F.lit(last))})
    later = F.when(F.col("end") > F.col("home"), F.sequence(F.col("home") + CHUNK, F.col("end"), F.lit(CHUNK))).otherwise(F.array())
    chunks = F.concat(F.array(F.struct(F.col("home").alias("chunk"), "at")), F.transform(later, lambda c: F.struct(c.alias("chunk"), c.alias("at"))))
    return steps.select("patient_id", "score", F.inline(chunks), F.lit(1).alias("turn"))


def outcomes(index: DataFrame, flagged: DataFrame, ed: DataFrame, t: Tables) -> DataFrame:
    """What follows and precedes each index stay, by ``encounter_id``, in one sweep over all kinds of events.

    Stays, emergency visits, steps of the comorbidity score and the instants asked about go to chunks of 180 days per patient, with
    what anchors of the chunk can reach beyond it. All windows share that one shuffle and sort, and a patient with many events
    is split by time. A stay's instants then meet once, by its id.
    """
    at = F.unix_micros("start_ts")
    next_stay = F.struct("start_ts", F.col("encounter_id").alias("id"), "admit_date", "medical_cost", "payer_paid")
    days_ahead = (FOLLOW_UP_DAYS[1] + 2) * DAY
    stay_rows = flagged.filter("start_ts is not null").select(
        "patient_id", at.alias("at"), F.lit(2).alias("turn"), F.col("encounter_id").alias("tie"), at.alias("stay_at"),
        F.when(~F.col("is_planned"), next_stay).alias("unplanned"))
    ed_rows = ed.filter("start_ts is not null").select("patient_id", at.alias("at"), F.lit(2).alias("turn"), F.col("encounter_id").alias("tie"), F.lit(1).alias("ed"))
    last = index.agg(F.max(chunk_of(at, CHUNK))).first()[0]
    parts = [spread(stay_rows, "at", CHUNK, back=DAY, ahead=days_ahead), spread(ed_rows, "at", CHUNK, back=-ED_LOOKBACK[0] * SECOND, ahead=days_ahead),
             _scores(t, last), _marks(index)]
    stream = parts[0]
    for part in parts[1:]:
        stream = stream.unionByName(part, allowMissingColumns=True)
    by_time = Window.partitionBy("patient_id", "chunk").orderBy("at", "turn", "tie")
    so_far = by_time.rowsBetween(Window.unboundedPreceding, 0)
    ahead = "ignore nulls over (partition by patient_id, chunk order by at, turn, tie)"
    seen = stream.filter("patient_id is not null").withColumns({
        "n_ed": F.sum("ed").over(so_far), "last_stay": F.max("stay_at").over(so_far), "next_stay": F.expr(f"lead(stay_at) {ahead}"),
        "score": F.last("score", ignorenulls=True).over(so_far),
        "next_1": F.expr(f"lead(unplanned) {ahead}"), "next_2": F.expr(f"lead(unplanned, 2) {ahead}"),
    })
    admitted = (F.coalesce(F.col("last_stay") >= F.col("at") + ADMISSION_AFTER_ED[0] * SECOND, F.lit(False))
                | F.coalesce(F.col("next_stay") <= F.col("at") + ADMISSION_AFTER_ED[1] * SECOND, F.lit(False)))
    seen = seen.withColumn("alone", F.when(F.col("ed").isNotNull() & ~admitted, 1)).withColumn("n_alone", F.sum("alone").over(so_far))
    zero = F.lit(0)
    read = lambda mark, c: F.max(F.when(F.col("mark") == mark, F.coalesce(F.col(c), zero)))
    other = F.when(F.col("next_1.id") != F.col("anchor"), F.col("next_1")).otherwise(F.col("next_2"))
    days = F.datediff(other["admit_date"], "discharge_date")
    found = F.when((F.col("mark") == "after") & days.between(*FOLLOW_UP_DAYS), F.struct(days.alias("days"), other.alias("stay")))
    marked = seen.filter("anchor is not null").groupBy("anchor").agg(
        F.max(found).alias("found"),
        (read("until", "n_alone") - read("after", "n_alone")).alias("post_discharge_ed_visits"),
        (read("ed_to", "n_ed") > read("ed_from", "n_ed")).alias("came_through_ed"),
        read("admitted", "score").alias("charlson_score"),
        (read("back_from", "n_ed") - read("back_to", "n_ed")).alias("ed_visits_6_months"),
    )
    return marked.select(
        F.col("anchor").alias("encounter_id"), F.col("found").isNotNull().alias("is_readmitted_30_days"),
        F.col("found.stay.id").alias("readmission_encounter_id"), F.col("found.days").alias("days_to_readmission"),
        F.col("found.stay.medical_cost").alias("readmission_cost"), F.col("found.stay.payer_paid").alias("readmission_payer_paid"),
        "post_discharge_ed_visits", "came_through_ed", "charlson_score", "ed_visits_6_months",
    )


def lace_inputs(t: Tables, period: Period) -> DataFrame:
    """Index stays with outcomes and all score inputs."""
    inpatient = stays(t)
    flagged = staged(flag_planned(inpatient, t), "stays")
    index = index_stays(flagged, period)
    ed = ed_visits(t)
    return index.join(outcomes(index, flagged, ed, t), "encounter_id")


def build_fact_index_admission(t: Tables, period: Period) -> DataFrame:
    inputs = staged(lace_inputs(t, period), "lace_inputs")  # the bands read it again and again
    scored = staged(with_lace(inputs, t["lace_points"]), "scored_stays")
    tiered = percentile_tier(scored, "lace_score", TIER_CUTS, LOWEST_TIER, "risk_tier")
    return tiered.select(
        "encounter_id",
        "patient_id",
        "facility_id",
        "payer_id",
        date_key("admit_date").alias("admit_date_key"),
        date_key("discharge_date").alias("discharge_date_key"),
        "admit_date",
        "discharge_date",
        "age_at_admission",
        "length_of_stay_days",
        "reason_icd10cm_code",
        "reason_description",
        "condition_group",
        is_hrrp(F.col("condition_group")).alias("is_hrrp_condition"),
        "is_planned",
        "planned_category",
        "medical_cost",
        "payer_paid",
        (F.col("discharge_date") <= F.date_sub(period.as_of_col, FOLLOW_UP_DAYS[1])).alias("follow_up_complete"),
        "is_readmitted_30_days",
        "readmission_encounter_id",
        "days_to_readmission",
        "readmission_cost",
        "readmission_payer_paid",
        "post_discharge_ed_visits",
        "came_through_ed",
        "charlson_score",
        "ed_visits_6_months",
        "lace_l",
        "lace_a",
        "lace_c",
        "lace_e",
        "lace_score",
        "risk_tier",
    )
