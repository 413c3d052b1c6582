"""Queries over the driver tables, each beside the SQL that checks it."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}
TABLES: dict[str, str] = {}

LINEAGE = ("run_id", "bronze_ingested_at")


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; without ``sql`` it has no counterpart and is tested on small fixtures instead."""

    def add(fn: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: plain(fn(spark, sf_dir))
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return add


def plain(df: DataFrame) -> DataFrame:
    """Types both engines print alike: text for dates, times and lists, double for decimals, bigint for counts."""
    out = []
    for f in df.schema.fields:
        if f.name in LINEAGE:
            continue
        c, t = F.col(f.name), f.dataType
        if isinstance(t, T.DecimalType):
            c = c.cast("double")
        elif isinstance(t, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        elif isinstance(t, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            c = c.cast("string")
        elif isinstance(t, T.ArrayType):
            c = F.array_join(c, "|")
        out.append(c.alias(f.name))
    return df.select(*out)


def table(name: str, sql: str) -> None:
    """A named subquery other check queries may use."""
    TABLES[name] = sql.strip()


_NAME = re.compile(r"\bx_[a-z0-9_]+\b")


def compose(sql: str) -> str:
    """Put the named subqueries a query uses in front of it."""
    order: list[str] = []

    def visit(text: str) -> None:
        for name in dict.fromkeys(_NAME.findall(text)):
            if name not in order:
                visit(TABLES[name])
                if name not in order:
                    order.append(name)

    visit(sql)
    if not order:
        return sql.strip()
    body = ",\n".join(f"{n} AS ({TABLES[n]})" for n in order)
    return f"WITH {body}\n{sql.strip()}"


def oracle() -> dict[str, str]:
    return {name: compose(sql) for name, sql in ORACLE.items()}
