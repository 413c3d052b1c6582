"""Helpers that several operators share."""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ROW = "_row"
BATCH_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def row_key(doc_id: Column, text: Column) -> Column:
    """16 bytes that name a row by id and text: repeated rows share a key, a null text counts as empty."""
    parts = F.concat(F.coalesce(doc_id.cast("string"), F.lit("null")), F.lit("\n"), F.coalesce(text, F.lit("")))
    return F.unhex(F.md5(parts))


def boxed(df: DataFrame, **columns: Column) -> DataFrame:
    """All columns of a table inside one struct, beside working columns that cannot clash with them."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(ROW), *[c.alias(k) for k, c in columns.items()])


def unboxed(df: DataFrame, **columns: Column) -> DataFrame:
    """The boxed columns again; a working column of the same name takes the place of an old one."""
    old = [f.name for f in df.schema[ROW].dataType.fields]
    order = old + [c for c in columns if c not in old]
    return df.select(*[(columns[c] if c in columns else F.col(ROW)[c]).alias(c) for c in order])


def numbered(df: DataFrame, *keys: str) -> DataFrame:
    """Range-partition and sort by keys; ``part`` and ``at`` give a row's partition and place in it.

    The result has to be written before it is used, since partition borders come from a sample.
    """
    return (
        df.repartitionByRange(*keys).sortWithinPartitions(*keys)
        .withColumn("part", F.spark_partition_id())
        .withColumn("at", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
    )


def process_cache(name: str, version: object = None) -> dict:
    """A dict that lives as long as the Python worker, so that later tasks find what earlier ones made.

    A worker holds one such dict at a time: another name or ``version`` takes the place of the last.
    """
    held = vars(sys).setdefault("_care_lake_llm", {})
    if held.get("name") != (name, version):
        held.clear()
        held.update(name=(name, version), entries={})
        give_back()
    return held["entries"]


def give_back() -> None:
    """Return memory that Arrow and the C library keep for reuse; workers live through many stages."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that a piece holds at most so many bytes of text, or one row."""
    for batch in batches:
        start, held = 0, 0
        sizes = pa.compute.binary_length(batch.column(column)).fill_null(0).to_pylist()
        for i, size in enumerate(sizes):
            if held and held + size > most:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        if start < batch.num_rows:
            yield batch.slice(start)


def with_vocabulary(cache: dict, words: set, fill: Callable[[list], list], most: int = 120_000) -> dict:
    """Make sure that ``cache`` has every word; once it is full, only the words asked for now stay."""
    if len(cache) > most:
        held = {w: cache[w] for w in words if w in cache}
        cache.clear()
        cache.update(held)
    if missing := [w for w in words if w not in cache]:
        cache.update(zip(missing, fill(missing), strict=True))
    return cache


def int_lists(parts: list[bytes]) -> pa.ListArray:
    """Lists of 32-bit integers from their little-endian bytes."""
    ends = np.zeros(len(parts) + 1, np.int32)
    np.cumsum([len(p) // 4 for p in parts], out=ends[1:])
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(parts), "<i4"), pa.int32()))
