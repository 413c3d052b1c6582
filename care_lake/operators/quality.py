"""Expectations, reconciliation and gates. Rows are never dropped; failures are counted."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F


class GateError(RuntimeError):
    """A check after the build found something that must stop the run."""


def failed(condition: str | Column) -> Column:
    """True when an expectation does not hold; an unknown (NULL) outcome counts as failed."""
    expr = F.expr(condition) if isinstance(condition, str) else condition
    return ~F.coalesce(expr, F.lit(False))


def expect(df: DataFrame, checks: Mapping[str, str | Column], table: str) -> DataFrame:
    """Passed and failed rows of every named check, counted in a single pass."""
    rows = F.count("*").alias("_rows")
    fails = [F.count_if(failed(c)).alias(f"_failed_{i}") for i, c in enumerate(checks.values())]
    counted = df.agg(rows, *fails)
    results = F.array(*[
        F.struct(
            F.lit(name).alias("expectation"),
            (F.col("_rows") - F.col(f"_failed_{i}")).alias("passed_rows"),
            F.col(f"_failed_{i}").alias("failed_rows"),
        )
        for i, name in enumerate(checks)
    ])
    return counted.select(F.lit(table).alias("table_name"), F.inline(results))


def watch(df: DataFrame, checks: Mapping[str, str | Column]) -> tuple[DataFrame, Observation]:
    """The same rows, whose next action also counts the outcome of every check."""
    seen = Observation()
    fails = [F.count_if(failed(c)).alias(f"failed_{i}") for i, c in enumerate(checks.values())]
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *fails), seen


def watched(seen: Observation, checks: Mapping[str, str | Column], table: str) -> list[tuple[str, str, int, int]]:
    """Table, expectation, passed and failed rows, once the action is over."""
    got = seen.get
    return [(table, name, got.get("rows", 0) - got.get(f"failed_{i}", 0), got.get(f"failed_{i}", 0)) for i, name in enumerate(checks)]


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    return union_all(
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    )


def reconcile(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Expected against counted rows per table, largest difference first."""
    joined = expected.join(actual, "table_name", "left").select(
        "table_name",
        "expected_rows",
        F.col("row_count").alias("actual_rows"),
        (F.col("row_count") - F.col("expected_rows")).alias("difference"),
    )
    gap = F.abs(F.coalesce("actual_rows", F.lit(0)) - F.col("expected_rows"))
    return joined.orderBy(gap.desc(), "table_name")


def rescued_counts(tables: Mapping[str, DataFrame], column: str = "_rescued_data") -> DataFrame:
    return union_all(
        df.agg(F.count_if(F.col(column).isNotNull()).alias("rescued_rows")).select(
            F.lit(name).alias("table_name"), "rescued_rows"
        )
        for name, df in tables.items()
    )


def resource_summary(
    df: DataFrame, by: Sequence[str], resource_id: str, file: str, loaded_at: str
) -> DataFrame:
    """Rows, distinct ids, files and last load per group."""
    return df.groupBy(*by).agg(
        F.count("*").alias("row_count"),
        F.count_distinct(resource_id).alias("distinct_ids"),
        F.count_distinct(file).alias("files"),
        F.max(loaded_at).alias("last_ingested_at"),
    ).orderBy(by[0], F.desc("row_count"), *by[1:])


def null_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.agg(
        F.count("*").alias("total_rows"), *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in cols]
    )


def multi_file_ids(df: DataFrame, by: Sequence[str], file: str, limit: int | None = None) -> DataFrame:
    """Ids that occur in more than one file; a caller that wants a short report sets ``limit``."""
    found = df.groupBy(*by).agg(F.count_distinct(file).alias("files")).filter("files > 1")
    return found if limit is None else found.orderBy(*by).limit(limit)


def conserved(pairs: Mapping[str, tuple[DataFrame, DataFrame, str]]) -> DataFrame:
    """Rows of a cleaned table against the distinct keys of its raw table."""
    return union_all(
        union_all([
            clean.agg(F.count("*").alias("silver_rows"), F.lit(None).cast("long").alias("bronze_keys")),
            raw.agg(F.lit(None).cast("long").alias("silver_rows"), F.count_distinct(key).alias("bronze_keys")),
        ])
        .agg(F.max("silver_rows").alias("silver_rows"), F.max("bronze_keys").alias("bronze_keys"))
        .select(F.lit(name).alias("table_name"), "silver_rows", "bronze_keys")
        for name, (clean, raw, key) in pairs.items()
    )


def missing_codes(used: DataFrame, code: str, known: DataFrame, known_code: str) -> DataFrame:
    """Distinct codes in use that a lookup does not hold."""
    return (
        used.select(F.col(code).alias("code")).dropna().distinct()
        .join(known.select(F.col(known_code).alias("code")), "code", "left_anti")
    )


def duplicate_keys(lookup: DataFrame, key: str) -> DataFrame:
    return (
        lookup.groupBy(F.col(key).alias("code")).agg(F.count("*").alias("copies")).filter("copies > 1")
    )


def band_gaps(bands: DataFrame) -> DataFrame:
    """Bands that do not start right after the band below them."""
    lo, hi = F.col("lower_bound").cast("int"), F.col("upper_bound").cast("int")
    below = F.lag(hi).over(Window.partitionBy("component").orderBy(lo, hi))
    return (
        bands.select("component", lo.alias("lower_bound"), hi.alias("upper_bound"), below.alias("below"))
        .filter("below is not null and lower_bound <> below + 1")
    )


def parse_official_codes(lines: DataFrame, text: str = "value") -> DataFrame:
    """Fixed-width list: code in the first seven characters, description from the ninth on."""
    return lines.filter(F.trim(text) != "").select(
        F.trim(F.substring(text, 1, 7)).alias("code"), F.trim(F.expr(f"substring({text}, 9)")).alias("description")
    )


def validate_codes(used: DataFrame, code: str, official: DataFrame) -> DataFrame:
    """Distinct codes (dots removed) that an official list does not hold."""
    plain = used.select(F.col(code).alias("code")).dropna().distinct().withColumn(
        "plain_code", F.regexp_replace("code", r"\.", "")
    )
    return plain.join(
        official.select(F.col("code").alias("plain_code")), "plain_code", "left_anti"
    )


def raise_if(problems: DataFrame, text: Column, message: str, named: int = 100) -> None:
    """Stop with a message that counts all problems and names the first ``named`` of them."""
    total = problems.count()
    if total:
        found = [r[0] for r in problems.select(text.alias("problem")).orderBy("problem").limit(named).collect()]
        more = f"; and {total - len(found)} more" if total > len(found) else ""
        raise GateError(f"{message} ({total}): {'; '.join(found)}{more}")
