"""Incremental loading of landing files: every file once, each run picks up what is new.

Each flow is a file stream that runs until nothing is left (``availableNow``). A batch is written to
a folder named by its batch id, so repeating a batch after a failure replaces its own output and
never doubles rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from functools import partial, reduce

from pyspark.errors import AnalysisException, StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from care_lake.functions.fhir import json_envelope
from care_lake.sources.landing import RESCUED, csv_columns, csv_lineage, in_scope, resource_lineage

LINE = T.StructType([T.StructField("value", T.StringType())])
BATCH = "batch"
#: A first load of many files runs as several batches, so a failure repeats one of them and not the whole load.
FILES_PER_BATCH = 10_000


def start_flow(
    rows: DataFrame, checkpoint: str, out: str, partition_by: Sequence[str] = (),
    parse: Callable[[DataFrame], DataFrame] | None = None,
) -> StreamingQuery:
    """Write every batch, after ``parse`` where it is given, to a folder of its own."""

    def write(batch: DataFrame, batch_id: int) -> None:
        table = parse(batch) if parse else batch
        table.write.mode("overwrite").partitionBy(*partition_by).parquet(f"{out}/{BATCH}={batch_id}")

    return (
        rows.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def finish(queries: Sequence[StreamingQuery]) -> None:
    """Wait for all flows, then raise the first failure."""
    failures = []
    for q in queries:
        try:
            q.awaitTermination()
        except StreamingQueryException as e:
            failures.append(e)
    if failures:
        raise failures[0]


def start_all(starts: Iterable[Callable[[], StreamingQuery]]) -> list[StreamingQuery]:
    """Start flows one after the other. If one cannot start, those that run are stopped before its error is raised.

    A stopped flow repeats its open batch at the next run, so nothing is lost or doubled.
    """
    running: list[StreamingQuery] = []
    try:
        for start in starts:
            running.append(start())
    except Exception:
        for q in running:
            q.stop()
        raise
    return running


def read_lines(spark: SparkSession, path: str, glob: str, files_per_batch: int) -> DataFrame:
    return (
        spark.readStream.schema(LINE)
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", files_per_batch)
        .text(path)
    )


def read_ndjson_stream(
    spark: SparkSession, path: str, system: str, glob: str = "*.ndjson", files_per_batch: int = FILES_PER_BATCH
) -> DataFrame:
    """One row per NDJSON line: envelope fields, the untouched text and where it came from."""
    return json_envelope(read_lines(spark, path, glob, files_per_batch).withColumns(resource_lineage(system)))


def ingest_ndjson(spark: SparkSession, path: str, system: str, checkpoint: str, out: str) -> StreamingQuery:
    return start_flow(
        in_scope(read_ndjson_stream(spark, path, system).drop("source_system")),
        checkpoint,
        f"{out}/source_system={system}",
        partition_by=["resource_type"],
    )


def append_flows(spark: SparkSession, sources: Mapping[str, str], checkpoint_root: str, out: str) -> None:
    """Several sources into one table; each flow has a checkpoint of its own and all run side by side."""
    finish(start_all(
        partial(ingest_ndjson, spark, path, system, f"{checkpoint_root}/{system}", out) for system, path in sources.items()
    ))


def header_names(line: Column) -> Column:
    """Fields of a line taken as a header."""
    return F.transform(F.split(line, ","), lambda x: F.btrim(x, F.lit('" \ufeff\r')))


def parse_csv_lines(lines: DataFrame, columns: Sequence[str], header: bool = True) -> DataFrame:
    """Text lines of CSV files to the table's columns, all as text, found by the names in each file's header.

    A column the file does not have is NULL. A column the table does not have goes into ``_rescued_data`` as JSON; a
    line with too many or too few fields is kept there whole. The header is the line that names at least half of the
    table's columns; a file without one stops the load.
    """
    lines = lines.filter(F.length("value") > 0)
    lineage = [c for c in lines.columns if c != "value"]
    if not header:
        return _parsed(lines, list(columns), columns, lineage)
    names = header_names(F.col("value"))
    is_header = 2 * F.size(F.array_intersect(names, F.array(*[F.lit(c) for c in columns]))) >= len(columns)
    headers = lines.filter(is_header).select(F.col("_source_file").alias("_file"), names.alias("_names")).distinct()
    bare = lines.select("_source_file").join(headers, F.col("_source_file") == F.col("_file"), "left_anti").first()
    if bare:
        raise ValueError(f"{bare[0]} has no header with the columns {', '.join(columns)}")
    kinds = [r[0] for r in headers.select("_names").distinct().collect()]  # one row per way to write the header
    rows = lines.filter(~is_header)
    out = []
    for kind in kinds:
        of_kind = headers.filter(F.col("_names") == F.array(*[F.lit(c) for c in kind]))
        own = rows if len(kinds) == 1 else rows.join(of_kind, F.col("_source_file") == F.col("_file"), "left_semi")
        out.append(_parsed(own, kind, columns, lineage))
    return reduce(DataFrame.unionByName, out)


def _parsed(lines: DataFrame, names: Sequence[str], columns: Sequence[str], lineage: Sequence[str]) -> DataFrame:
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*names, RESCUED]])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": RESCUED, "escape": '"'}
    rows = lines.withColumn("_row", F.from_csv("value", schema.simpleString()[7:-1].replace(":", " "), options))
    field = F.col("_row").getField
    extra = [c for c in names if c not in columns]
    rescued = field(RESCUED)
    if extra:
        present = F.coalesce(*[field(c) for c in extra]).isNotNull()
        rescued = F.coalesce(rescued, F.when(present, F.to_json(F.struct(*[field(c).alias(c) for c in extra]))))
    kept = [(field(c) if c in names else F.lit(None).cast("string")).alias(c) for c in columns]
    return rows.select(*kept, rescued.alias(RESCUED), *lineage)


def table_columns(spark: SparkSession, path: str, checkpoint: str, glob: str) -> list[str]:
    """The columns a table got at its first load; they are kept beside its checkpoint."""
    kept = f"{checkpoint}_columns"
    try:
        return [r.name for r in spark.read.parquet(kept).orderBy("place").collect()]
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
    names = csv_columns(spark, path, glob)
    spark.createDataFrame(list(enumerate(names)), "place int, name string").coalesce(1).write.parquet(kept)
    return names


def ingest_csv_text(
    spark: SparkSession, path: str, checkpoint: str, out: str, columns: Sequence[str] | None = None, glob: str = "*.csv",
    header: bool = True, files_per_batch: int = FILES_PER_BATCH,
) -> StreamingQuery:
    """Load new CSV files into a table whose columns stay those of its first load."""
    known = list(columns or table_columns(spark, path, checkpoint, glob))
    lines = read_lines(spark, path, glob, files_per_batch).withColumns(csv_lineage())
    return start_flow(lines, checkpoint, out, parse=lambda batch: parse_csv_lines(batch, known, header))


def read_ingested(spark: SparkSession, out: str) -> DataFrame:
    """All batches of an ingested table. File footers are not merged; every batch has the same columns."""
    return spark.read.parquet(out).drop(BATCH)
