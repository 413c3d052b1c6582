"""Report measures over a filter context.

A measure names the table it counts in. A filter or grouping on a dimension reaches a table only
through the relationships listed here; a measure whose table is not reached keeps its total. That is
how, for example, a payer filter changes emergency visits but not the patient months they are divided by.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from care_lake.fixed import READMISSION_BENCHMARK
from care_lake.operators.distinct import distinct_keys, united

Tables = Mapping[str, DataFrame]

# fact -> dimension -> (column of the fact, key of the dimension)
PATIENT, FACILITY, PROVIDER = ("patient_id",) * 2, ("facility_id",) * 2, ("provider_id",) * 2
PAYER, DIAGNOSIS = ("payer_id",) * 2, ("icd10cm_code",) * 2


def _date(column: str) -> tuple[str, str]:
    return column, "date_key"


RELATIONSHIPS: dict[str, dict[str, tuple[str, str]]] = {
    "fact_encounter": {
        "dim_patient": PATIENT, "dim_facility": FACILITY, "dim_provider": PROVIDER, "dim_payer": PAYER,
        "dim_date": _date("start_date_key"),
    },
    "fact_index_admission": {
        "dim_patient": PATIENT, "dim_facility": FACILITY, "dim_payer": PAYER,
        "dim_date": _date("discharge_date_key"),
    },
    "fact_claim": {
        "dim_patient": PATIENT, "dim_provider": PROVIDER, "dim_payer": PAYER, "dim_date": _date("service_date_key"),
    },
    "fact_condition": {"dim_patient": PATIENT, "dim_diagnosis": DIAGNOSIS},
    "fact_procedure": {"dim_patient": PATIENT, "dim_date": _date("procedure_date_key")},
    "fact_lab_result": {"dim_patient": PATIENT, "dim_date": _date("result_date_key")},
    "fact_medication": {"dim_patient": PATIENT, "dim_payer": PAYER, "dim_date": _date("start_date_key")},
    "fact_member_month": {"dim_patient": PATIENT, "dim_payer": PAYER, "dim_date": _date("month_date_key")},
    "kpi_monthly": {"dim_facility": FACILITY, "dim_date": _date("month_date_key")},
    "kpi_active_patients_monthly": {"dim_date": _date("month_date_key")},
    "patient_360": {"dim_patient": PATIENT},
    "patient_timeline": {"dim_patient": PATIENT},
    "care_management_worklist": {"dim_patient": PATIENT},
}

# distinct column of a table -> cube that holds its bitmaps; of dates it knows months and what is made of them
DISTINCT_CUBES = {("fact_encounter", "patient_id"): "patients_seen_monthly"}
MONTH_FIELDS = {"year", "quarter", "year_quarter", "month", "month_name", "month_start", "year_month"}
JOINS = RELATIONSHIPS | {
    "patients_seen_monthly": {"dim_facility": FACILITY, "dim_payer": PAYER, "dim_date": _date("month_date_key")},
}


@dataclass(frozen=True)
class Base:
    """An aggregate of one table: ``sum`` or ``distinct`` of a column, or the number of ``rows``.

    ``condition`` restricts the rows; ``only_in`` keeps rows whose key occurs in another filtered table.
    """

    table: str
    kind: str
    column: str = ""
    condition: str = "true"
    only_in: tuple[str, str, str] | None = None

    def partial(self) -> Column:
        """The part that is added up per combination of keys, before dimensions are joined."""
        return F.expr(f"count_if({self.condition})" if self.kind == "rows" else f"sum({self.column})")

    def total(self, name: str) -> Column:
        """The value of a group. A count of no rows is a blank, not a zero."""
        if self.kind == "distinct":
            return F.nullif(F.count_distinct(self.column), F.lit(0))
        return F.nullif(F.sum(name), F.lit(0)) if self.kind == "rows" else F.sum(name)


@dataclass(frozen=True)
class Ratio:
    """Quotient of two measures, NULL when the divisor is missing or zero."""

    top: str
    bottom: str
    factor: int = 1


@dataclass(frozen=True)
class Constant:
    """A fixed value shown wherever another measure has one."""

    value: float
    beside: str


Measure = Base | Ratio | Constant


def _sum(table: str, column: str, only_in: tuple[str, str, str] | None = None) -> Base:
    return Base(table, "sum", column, only_in=only_in)


def _rows(table: str, condition: str = "true") -> Base:
    return Base(table, "rows", condition=condition)


FOLLOWED = "follow_up_complete"

MEASURES: dict[str, Measure] = {
    "admissions": _sum("kpi_monthly", "admissions"),
    "discharges": _sum("kpi_monthly", "discharges"),
    "inpatient_days": _sum("kpi_monthly", "inpatient_days"),
    "average_length_of_stay": Ratio("inpatient_days", "discharges"),
    "ed_visits": _sum("kpi_monthly", "ed_visits"),
    "active_patient_months": _sum("kpi_active_patients_monthly", "active_patients"),
    "ed_visits_per_1000": Ratio("ed_visits", "active_patient_months", 12000),
    "patients_seen": Base("fact_encounter", "distinct", "patient_id"),
    "high_utilizers": _rows("patient_360", "is_high_utilizer and not is_deceased"),
    "index_admissions": _sum("kpi_monthly", "index_admissions"),
    "readmissions": _sum("kpi_monthly", "readmissions"),
    "readmission_rate": Ratio("readmissions", "index_admissions"),
    "readmission_rate_benchmark": Constant(READMISSION_BENCHMARK, "index_admissions"),
    "post_discharge_ed_visits": _sum("kpi_monthly", "post_discharge_ed_visits"),
    "post_discharge_ed_rate": Ratio("post_discharge_ed_visits", "index_admissions"),
    "readmission_cost": _sum("kpi_monthly", "readmission_cost"),
    "medical_cost": _sum("kpi_monthly", "medical_cost"),
    "payer_paid": _sum("kpi_monthly", "payer_paid"),
    "patient_responsibility": _sum("kpi_monthly", "patient_responsibility"),
    "member_months": _rows("fact_member_month"),
    "pmpm_paid": Ratio("payer_paid", "member_months"),
    "encounter_payer_paid": _sum("fact_encounter", "payer_paid"),
    "cost_per_patient": Ratio("encounter_payer_paid", "patients_seen"),
    "high_utilizer_paid": _sum(
        "fact_encounter", "payer_paid", only_in=("patient_360", "patient_id", "is_high_utilizer")
    ),
    "high_utilizer_share_of_cost": Ratio("high_utilizer_paid", "encounter_payer_paid"),
    "high_risk_patients": _rows("patient_360", "latest_risk_tier = 'High' and not is_deceased"),
    "worklist_patients": _rows("care_management_worklist"),
    "scored_discharges": _rows("fact_index_admission", FOLLOWED),
    "scored_readmissions": _rows("fact_index_admission", f"{FOLLOWED} and is_readmitted_30_days"),
    "readmission_rate_scored": Ratio("scored_readmissions", "scored_discharges"),
}


def _needed(names: Sequence[str]) -> list[str]:
    out: dict[str, None] = {}
    for name in names:
        m = MEASURES[name]
        if isinstance(m, Ratio):
            out |= dict.fromkeys(_needed([m.top, m.bottom]))
        elif isinstance(m, Constant):
            out |= dict.fromkeys(_needed([m.beside]))
        else:
            out[name] = None
    return list(out)


def _split(field: str) -> tuple[str, str]:
    table, column = field.split(".")
    return table, column


def _reaches(field: str, table: str) -> bool:
    owner, _ = _split(field)
    return owner == table or owner in JOINS.get(table, {})


def _key_name(field: str) -> str:
    return "_" + field.replace(".", "_")


def column_names(by: Sequence[str]) -> list[str]:
    """Name of each grouping column in a result: the column's own where that is unique, else with its table."""
    short = [_split(f)[1] for f in by]
    return [s if short.count(s) == 1 else f.replace(".", "_") for f, s in zip(by, short)]


def _add_fields(rows: DataFrame, t: Tables, table: str, fields: Sequence[str]) -> DataFrame:
    """Add columns of related dimensions under their key names."""
    out = rows
    for dim in sorted({_split(f)[0] for f in fields}):
        fact_key, dim_key = JOINS[table][dim]
        cols = [F.col(_split(f)[1]).alias(_key_name(f)) for f in fields if _split(f)[0] == dim]
        right = t[dim].select(F.col(dim_key).alias("_dim_key"), *cols)
        out = out.join(right, F.col(fact_key) == F.col("_dim_key"), "left").drop("_dim_key")
    return out


def _matches(column: Column, value: object) -> Column:
    return column.isin(list(value) if isinstance(value, (list, tuple, set)) else [value])


def _filtered(t: Tables, table: str, filters: Mapping[str, object], only_in: tuple[str, str, str] | None = None) -> DataFrame:
    """Rows of a table that the filters leave; a filtered dimension is cut to its matching keys first."""
    applied = {f: v for f, v in filters.items() if _reaches(f, table)}
    rows = t[table]
    for field, value in applied.items():
        if _split(field)[0] == table:
            rows = rows.filter(_matches(F.col(_split(field)[1]), value))
    if only_in:
        other, key, condition = only_in
        rows = rows.join(t[other].filter(condition).select(key), key, "left_semi")
    for dim in dict.fromkeys(_split(f)[0] for f in applied if _split(f)[0] != table):
        fact_key, dim_key = JOINS[table][dim]
        members_of = t[dim]
        for field, value in applied.items():
            if _split(field)[0] == dim:
                members_of = members_of.filter(_matches(F.col(_split(field)[1]), value))
        rows = rows.join(members_of.select(F.col(dim_key).alias("_dim_key")), F.col(fact_key) == F.col("_dim_key"), "left_semi")
    return rows


def _cube_of(base: Base, t: Tables, fields: Sequence[str]) -> str | None:
    """The cube that answers a distinct count for all fields that reach its table, if there is one."""
    cube = DISTINCT_CUBES.get((base.table, base.column)) if base.kind == "distinct" and not base.only_in else None
    if cube is None:
        return None
    reached = [_split(f) for f in fields if _reaches(f, base.table)]
    known = all(owner in JOINS[cube] and (owner != "dim_date" or column in MONTH_FIELDS) for owner, column in reached)
    return cube if known and cube in t else None


def _from_cube(t: Tables, cube: str, name: str, by: Sequence[str], filters: Mapping[str, object]) -> DataFrame:
    """A distinct count from the bitmaps of a cube: cells are united per key before dimensions name them."""
    keys = list(dict.fromkeys(JOINS[cube][_split(f)[0]][0] for f in by))
    named = _add_fields(united(_filtered(t, cube, filters), keys), t, cube, by)
    return distinct_keys(named, [_key_name(f) for f in by], name)


def _aggregate(
    t: Tables, table: str, members: Sequence[str], by: Sequence[str], filters: Mapping[str, object],
    only_in: tuple[str, str, str] | None,
) -> DataFrame:
    """Measures of one table per group, under the key names of their fields.

    Filters come first: a filtered dimension is cut to its matching keys, and rows without such a key are left
    out as the table is read. The other rows are added up per combination of their own keys; only those few
    combinations meet the dimensions that groups are named by.
    """
    bases = {n: MEASURES[n] for n in members}
    rows = _filtered(t, table, filters, only_in)
    own = [f for f in by if _split(f)[0] == table]
    foreign = [f for f in by if _split(f)[0] != table]
    keys = dict.fromkeys([JOINS[table][_split(f)[0]][0] for f in foreign])
    counted = dict.fromkeys(b.column for b in bases.values() if b.kind == "distinct")
    keys |= counted
    own_keys = [F.col(_split(f)[1]).alias(_key_name(f)) for f in own]
    sums = [b.partial().alias(n) for n, b in bases.items() if b.kind != "distinct"]
    grouped = rows.groupBy(*own_keys, *[F.col(k) for k in keys])
    reduced = grouped.agg(*sums) if sums else grouped.agg(F.lit(1).alias("_one"))
    joined = _add_fields(reduced, t, table, foreign)
    return joined.groupBy(*[_key_name(f) for f in by]).agg(*[b.total(n).alias(n) for n, b in bases.items()])


def _base_frames(
    names: Sequence[str], t: Tables, by: Sequence[str], filters: Mapping[str, object]
) -> list[tuple[list[str], DataFrame]]:
    """One aggregate per table, with the grouping columns that reach it."""
    groups: dict[tuple, list[str]] = {}
    for name in names:
        base = MEASURES[name]
        groups.setdefault((base.table, base.only_in, base.kind == "distinct"), []).append(name)
    out = []
    for (table, only_in, _), members in groups.items():
        fields = [f for f in by if _reaches(f, table)]
        cube = _cube_of(MEASURES[members[0]], t, [*by, *filters]) if len(members) == 1 else None
        rows = _from_cube(t, cube, members[0], fields, filters) if cube else _aggregate(t, table, members, fields, filters, only_in)
        out.append(([_key_name(f) for f in fields], rows))
    return out


def measure(
    names: Sequence[str], t: Tables, by: Sequence[str] = (), filters: Mapping[str, object] | None = None
) -> DataFrame:
    """Evaluate measures, grouped by ``table.column`` fields and restricted by ``{field: value(s)}``.

    Rows that a dimension does not know form a blank group, in each measure of a ratio.
    """
    by = list(dict.fromkeys(by))
    keys = [_key_name(f) for f in by]
    frames = _base_frames(_needed(names), t, by, filters or {})
    full = [df for reach, df in frames if reach == keys]
    if not full:
        raise ValueError(f"none of the measures can be grouped by {list(by)}")
    out = full[0]
    for df in full[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    if len(full) > 1:
        values = [c for c in out.columns if c not in keys]
        out = out.groupBy(*keys).agg(*[F.max(v).alias(v) for v in values])
    for reach, df in frames:
        if reach == keys:
            continue
        if reach:
            right = df.withColumnsRenamed({k: f"{k}_right" for k in reach})
            same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"{k}_right")) for k in reach])
            out = out.join(right, same, "left").drop(*[f"{k}_right" for k in reach])
        else:
            out = out.withColumns({c: df.select(c).scalar() for c in df.columns})
    computed = {n: _evaluate(n) for n in names}
    groups = [F.col(k).alias(n) for k, n in zip(keys, column_names(by))]
    shown = out.select(*groups, *[c.alias(n) for n, c in computed.items()])
    if not keys:
        return shown
    anything = F.coalesce(*[F.col(n).cast("string") for n in names]).isNotNull()
    return shown.filter(anything)


def _evaluate(name: str) -> Column:
    m = MEASURES[name]
    if isinstance(m, Ratio):
        return F.try_divide(
            (_evaluate(m.top) * m.factor).cast("double"), _evaluate(m.bottom).cast("double")
        )
    if isinstance(m, Constant):
        return F.when(_evaluate(m.beside).isNotNull(), F.lit(m.value))
    return F.col(name)
