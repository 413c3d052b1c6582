"""Layouts that let a reader open few files: rows clustered along several columns, and rows in buckets of a key.

Clustered tables. Every column is cut into equal shares of the rows (its quantiles); the bits of the shares' numbers, dealt
in turn, are a row's place on a Z-shaped curve through all columns, and files are ranges of that curve. So the rows of a
file lie close together in every column, not in the first one only. The least and largest value of each file stand in a table
beside the rows; a reader picks files by it before Spark lists or opens any.

Bucketed tables. Spark's own buckets: all rows of a key are in the files of one bucket, a filter on the key reads that
bucket only, and joins on the key need no shuffle. The table is registered again wherever it is read.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Mapping, Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from care_lake.sources.tables import table_path

BITS = 6  # shares of a column: 2 to this power
LEADING = 7  # bytes of a text that stand for it
FILES, ABOUT = "_files", "_about"  # beside the rows; readers of the folder pass them over


def place_of(df: DataFrame, name: str) -> Column:
    """A number that orders rows as the column does, but for texts that agree in their leading bytes."""
    kind, c = df.schema[name].dataType, F.col(name)
    if isinstance(kind, T.StringType):
        leading = F.rpad(F.hex(F.substring(c.cast("binary"), 1, LEADING)), 2 * LEADING, "0")
        return F.conv(leading, 16, 10).cast("long")
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("long")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(c)
    if isinstance(kind, T.TimestampNTZType):
        return F.unix_micros(c.cast("timestamp"))
    if isinstance(kind, T.BooleanType):
        return c.cast("int")
    return c


def cuts_of(df: DataFrame, columns: Sequence[str], bits: int = BITS) -> list[list]:
    """For each column the values that cut its rows into 2^bits shares of about one size; one pass, a bounded result."""
    shares = F.array(*[F.lit(i / (1 << bits)) for i in range(1, 1 << bits)])
    row = df.agg(*[F.percentile_approx(place_of(df, c), shares, 10_000).alias(f"c{i}") for i, c in enumerate(columns)]).first()
    return [sorted(set(cuts or ()), key=lambda cut: (cut != cut, cut)) for cuts in row]


def share_of(place: Column, cuts: Sequence) -> Column:
    """How many of the sorted cuts lie at or below a value; nulls are in share 0.

    Found by halving, six comparisons for 63 cuts. The value rides along with the count, so it is worked out once a row.
    """
    if not cuts:
        return F.lit(0)
    ordered = F.array(*[F.lit(c) for c in cuts])
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(len(cuts).bit_length()))])

    def further(found: Column, step: Column) -> Column:
        below = F.get(ordered, found["n"] + step - 1) <= found["place"]  # NULL past the last cut
        return F.struct((found["n"] + F.when(below, step).otherwise(0)).alias("n"), found["place"].alias("place"))

    return F.reduce(steps, F.struct(F.lit(0).alias("n"), place.alias("place")), further, lambda found: found["n"])


def curve_place(shares: Sequence[Column], bits: int = BITS) -> Column:
    """The bits of all shares dealt in turn, highest first."""
    out = F.lit(0).cast("long")
    for bit in range(bits):
        for i, share in enumerate(shares):
            at = bit * len(shares) + len(shares) - 1 - i
            out = out.bitwiseOR(F.shiftleft(F.shiftright(share.cast("long"), bit).bitwiseAND(F.lit(1)), at))
    return out


def placed(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with their place on the curve and a hash of the row. The curve reads each share once per bit, so shares are columns first."""
    shares = {f"_share_{i}": share_of(place_of(df, c), cuts) for i, (c, cuts) in enumerate(zip(columns, cuts_of(df, columns)))}
    dealt = df.withColumn("_row", F.xxhash64(*df.columns)).withColumns(shares)
    return dealt.withColumn("_place", curve_place([F.col(c) for c in shares])).drop(*shares)


def file_bounds(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows, least and most value and nulls of each file.

    With a set among the aggregates Spark hashes the few files; least and most of texts alone would sort all rows by file.
    """
    ends = [f(c).alias(f"{kind}_{i}") for i, c in enumerate(columns) for kind, f in (("least", F.min), ("most", F.max))]
    nulls = [F.count_if(F.col(c).isNull()).alias(f"nulls_{i}") for i, c in enumerate(columns)]
    named = rows.select("*", F.col("_metadata.file_name").alias("_name"))
    file = F.element_at(F.collect_set("_name"), 1).alias("file")
    return named.groupBy("_name").agg(file, F.count("*").alias("n_rows"), *ends, *nulls).drop("_name")


def write_clustered(df: DataFrame, root: str, layer: str, name: str, cluster_by: Sequence[str], files: int | None = None,
                    comment: str = "", properties: Mapping[str, str] | None = None) -> DataFrame:
    """Replace a table by rows clustered along the columns, and return it as read back.

    ``files`` is the number of files; without it Spark chooses by size. A value that a third of all rows share fills several
    files: the other columns and, last, a hash of the row split it. ``comment`` and ``properties`` are kept with the table.
    """
    spark, path = df.sparkSession, table_path(root, layer, name)
    marked = placed(df, cluster_by)
    order = ["_place", *cluster_by, "_row"]
    laid = marked.repartitionByRange(*([files] if files else []), *order).sortWithinPartitions(*order).drop("_place", "_row")
    laid.write.mode("overwrite").parquet(path)
    rows = spark.read.schema(df.schema).parquet(path)
    file_bounds(rows, cluster_by).coalesce(1).write.mode("overwrite").parquet(f"{path}/{FILES}")
    about = {"comment": comment, "properties": dict(properties or {}), "clustered_by": list(cluster_by), "schema": df.schema.json()}
    _write_about(spark, path, about)
    return rows


def _write_about(spark: SparkSession, path: str, about: dict) -> None:
    now = datetime.now(timezone.utc).isoformat()
    spark.createDataFrame([(json.dumps({**about, "written_at": now}),)], "about string").coalesce(1).write.mode("overwrite").text(f"{path}/{ABOUT}")


def describe(spark: SparkSession, root: str, layer: str, name: str) -> dict:
    """Comment, properties, layout and schema of a table written here."""
    return json.loads(spark.read.text(f"{table_path(root, layer, name)}/{ABOUT}").first()[0])


Range = tuple[object, object]


def files_of(spark: SparkSession, root: str, layer: str, name: str, where: Mapping[str, object]) -> list[str]:
    """Paths of the files that can hold matching rows; ``where`` maps a column to a value or to a (first, last) range."""
    path, clustered = table_path(root, layer, name), describe(spark, root, layer, name)["clustered_by"]
    files = spark.read.parquet(f"{path}/{FILES}")
    for column, wanted in where.items():
        if column in clustered:
            i = clustered.index(column)
            first, last = wanted if isinstance(wanted, tuple) else (wanted, wanted)
            if first is not None:
                files = files.where(F.col(f"most_{i}") >= F.lit(first))
            if last is not None:
                files = files.where(F.col(f"least_{i}") <= F.lit(last))
    return sorted(f"{path}/{r.file}" for r in files.select("file").toLocalIterator())


def read_clustered(spark: SparkSession, root: str, layer: str, name: str, where: Mapping[str, object] | None = None) -> DataFrame:
    """Rows that meet all conditions, read from the files that can hold them. A bound of None is open."""
    where = where or {}
    schema = T.StructType.fromJson(json.loads(describe(spark, root, layer, name)["schema"]))
    paths = files_of(spark, root, layer, name, where)
    rows = spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)
    for column, wanted in where.items():
        first, last = wanted if isinstance(wanted, tuple) else (wanted, wanted)
        if first is not None:
            rows = rows.where(F.col(column) >= F.lit(first))
        if last is not None:
            rows = rows.where(F.col(column) <= F.lit(last))
    return rows


def bucketed_name(root: str, layer: str, name: str) -> str:
    """A name for the session's catalog that no other folder shares."""
    return re.sub(r"[^a-z0-9_]", "_", f"{layer}_{name}_{hashlib.sha256(root.encode()).hexdigest()[:16]}".lower())


def write_bucketed(df: DataFrame, root: str, layer: str, name: str, key: str, buckets: int, sort_by: Sequence[str] = ()) -> DataFrame:
    """Replace a table by one in buckets of ``key`` and return it as read back.

    Rows are rebalanced by key first, so a bucket is a file or few: Spark splits a key that holds a large share of the
    rows over several tasks, and each writes its own file of the bucket.
    """
    spark, path = df.sparkSession, table_path(root, layer, name)
    table = bucketed_name(root, layer, name)
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    writer = df.hint("rebalance", key).write.mode("overwrite").format("parquet").bucketBy(buckets, key)
    writer.sortBy(key, *sort_by).option("path", path).saveAsTable(table)
    _write_about(spark, path, {"bucketed_by": key, "buckets": buckets, "sorted_by": [key, *sort_by], "schema": df.schema.json()})
    return spark.table(table)


def read_bucketed(spark: SparkSession, root: str, layer: str, name: str) -> DataFrame:
    """A bucketed table, registered in this session if it is not yet known there."""
    table, path = bucketed_name(root, layer, name), table_path(root, layer, name)
    if not spark.catalog.tableExists(table):
        about = describe(spark, root, layer, name)
        columns = ", ".join(f"`{f['name']}` {T.StructField.fromJson(f).dataType.simpleString()}" for f in json.loads(about["schema"])["fields"])
        order = ", ".join(about["sorted_by"])
        spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet CLUSTERED BY ({about['bucketed_by']}) SORTED BY ({order}) "
                  f"INTO {about['buckets']} BUCKETS LOCATION '{path}'")
    return spark.table(table)
