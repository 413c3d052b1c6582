"""Column functions for typing, cleaning and decoding. All of them stay inside JVM code generation."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

MONEY = "decimal(12,2)"


def as_col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_cast(c: ColumnOrName, to: str) -> Column:
    """Cast text; a value that does not fit becomes NULL instead of an error."""
    return as_col(c).try_cast(to)


def money(c: ColumnOrName) -> Column:
    return safe_cast(c, MONEY)


def ts_to_date(c: ColumnOrName) -> Column:
    return F.to_date(safe_cast(c, "timestamp"))


def strip_digits(c: ColumnOrName) -> Column:
    return F.regexp_replace(as_col(c), "[0-9]+", "")


def strip_suffix(c: ColumnOrName) -> Column:
    """Drop one bracketed remark at the end of the text."""
    return F.regexp_replace(as_col(c), r"\s*\([^)]*\)$", "")


def squeeze_ws(c: ColumnOrName) -> Column:
    return F.regexp_replace(as_col(c), r"\s+", " ")


def title(c: ColumnOrName) -> Column:
    return F.initcap(as_col(c))


def decode(c: ColumnOrName, values: Mapping[str, str], default: Column | None = None) -> Column:
    """Code -> text. Unknown codes and NULL give ``default`` (NULL when not given)."""
    source = as_col(c)
    out = None
    for code, text in values.items():
        hit = source == F.lit(code)
        out = F.when(hit, text) if out is None else out.when(hit, text)
    return out if default is None else out.otherwise(default)


def null_if(c: ColumnOrName, sentinel: str) -> Column:
    return F.nullif(as_col(c), F.lit(sentinel))


def is_open(c: ColumnOrName) -> Column:
    """An interval without an end is still running."""
    return as_col(c).isNull()


def max_severity(ranks: Iterable[tuple[str, str]], *cols: ColumnOrName) -> Column:
    """Text of the first (most severe) rank found in any of the columns."""
    levels = F.array(*[as_col(c) for c in cols])
    return F.coalesce(*[F.when(F.array_contains(levels, code), text) for code, text in ranks])


def ilike_case(c: ColumnOrName, patterns: Iterable[tuple[str, str]], default: str) -> Column:
    source = as_col(c)
    return F.coalesce(*[F.when(source.ilike(p), text) for p, text in patterns], F.lit(default))


def ref_id(c: ColumnOrName) -> Column:
    """Id part of a ``Type/id`` reference."""
    return F.split_part(as_col(c), F.lit("/"), F.lit(2))


def null_safe_sum(*cols: ColumnOrName) -> Column:
    total = F.lit(0)
    for c in cols:
        total = total + F.coalesce(as_col(c), F.lit(0))
    return total


def balance(cost: ColumnOrName, paid: ColumnOrName) -> Column:
    """What is left to pay; unknown when either part is unknown."""
    return as_col(cost) - as_col(paid)


def surrogate_key(*cols: ColumnOrName, null_as: Mapping[str, str] | None = None) -> Column:
    """Content hash over the key columns.

    A NULL part is skipped unless ``null_as`` gives a text for that column.
    """
    fill = null_as or {}
    parts = [
        F.coalesce(as_col(c), F.lit(fill[c])) if isinstance(c, str) and c in fill else as_col(c) for c in cols
    ]
    return F.sha2(F.concat_ws("|", *parts), 256)


def path_key(path: ColumnOrName, name: str, to: str | None = None, empty_as_null: bool = True) -> Column:
    """Value of a ``name=value`` folder in a file path."""
    if to == "date":
        found = F.nullif(F.regexp_extract(as_col(path), f"{name}=([0-9-]+)", 1), F.lit(""))
        return found.try_cast("date")
    found = F.regexp_extract(as_col(path), f"{name}=([^/]+)", 1)
    return F.nullif(found, F.lit("")) if empty_as_null else found
