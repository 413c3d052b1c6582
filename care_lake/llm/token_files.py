"""Token ids of documents as flat binary files that are read by memory mapping.

A folder holds, for every partition of the documents in ascending order of their ids, three files of little-endian
numbers: ``<part>.ids`` (all token ids in a row, 16 bits where the vocabulary allows it, else 32), ``<part>.offsets``
(64 bits, where each document begins among the part's ids, and the end of the last) and ``<part>.docs`` (64 bits, the
documents' ids). ``manifest`` is a table with a row per part: its counts, and as prefix sums of these the number of
documents (``first_doc``) and of ids (``base``) in all parts before. So every part is written without knowing the
others, and a document's place among all ids is ``base`` plus its offset.

Texts are range-partitioned by id, then encoded and written in one pass, so ids are never shuffled (they pack worse than
their texts). A part is written under the name of the task attempt and then renamed; a repeated task writes the same
bytes again.

Defined cases: a null or empty text is the end id alone; null ids come first (their number stands in the manifest,
their places in ``.docs`` hold 0); rows that share an id are ordered by the CRC-32 of their texts; an empty table gives
an empty manifest and no files.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import tokenizers
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from care_lake.llm.common import process_cache, slices
from care_lake.llm.units import WordIds
from care_lake.session import staged

PART = pa.schema([("part", pa.int32()), ("docs", pa.int64()), ("ids", pa.int64()), ("null_ids", pa.int64())])
TEXT_BYTES = 4 << 20
IDS_READ = 1 << 20


def opened(folder: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder and the folder's path there; local files are memory-mapped when read."""
    if "://" in folder and not folder.startswith("file:"):
        return fs.FileSystem.from_uri(folder)
    return fs.LocalFileSystem(use_mmap=True), "/" + folder.removeprefix("file:").lstrip("/")


def _write(tokenizer: str, folder: str, end_id: int, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = process_cache("token files", tokenizer)
        ids_of = held.get("ids") or held.setdefault("ids", WordIds(tokenizer))
        task = TaskContext.get()
        files, root = opened(folder)
        part, docs, ids, nulls = task.partitionId(), 0, 0, 0
        names = {kind: f"{root}/{part:06d}.{kind}" for kind in ("ids", "offsets", "docs")}
        out = {}
        for batch in slices(batches, "text", TEXT_BYTES):
            if not out:
                out = {kind: files.open_output_stream(f"{name}.{task.taskAttemptId()}") for kind, name in names.items()}
                out["offsets"].write(bytes(8))
            found, ends = ids_of(batch.column("text"))
            with_ends = np.insert(found.astype(f"<u{width}"), ends, end_id)  # behind each document
            out["ids"].write(with_ends.tobytes())
            ends = ids + ends + np.arange(1, len(ends) + 1)
            out["offsets"].write(ends.astype("<u8").tobytes())
            out["docs"].write(batch.column("doc_id").fill_null(0).to_numpy().astype("<i8").tobytes())
            docs, ids, nulls = docs + batch.num_rows, int(ends[-1]), nulls + batch.column("doc_id").null_count
        for kind, stream in out.items():
            stream.close()
            files.move(f"{names[kind]}.{task.taskAttemptId()}", names[kind])
        if docs:
            yield pa.RecordBatch.from_pylist([{"part": part, "docs": docs, "ids": ids, "null_ids": nulls}], schema=PART)

    return run


def write_tokens(docs: DataFrame, tokenizer: str, folder: str, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text",
                 n_parts: int | None = None) -> DataFrame:
    """Write the ids of all texts to a new folder that every executor reaches, and return the manifest.

    ``tokenizer`` is the JSON of a tokenizer that drops white space and lower-cases; special tokens are not added.
    ``n_parts`` is the number of parts; without it Spark chooses by the size of the ids.
    """
    width = 2 if max(tokenizers.Tokenizer.from_str(tokenizer).get_vocab_size(), end_id + 1) <= 1 << 16 else 4
    files, root = opened(folder)
    files.create_dir(root)
    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"),
                       F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("tie"), F.monotonically_increasing_id().alias("row"))
    order = ["doc_id", "tie", "row"]
    ordered = rows.repartitionByRange(*([n_parts] if n_parts else []), *order).sortWithinPartitions(*order).select("doc_id", "text")
    parts = staged(ordered.mapInArrow(_write(tokenizer, folder, end_id, width), "part int, docs long, ids long, null_ids long"), "token-parts")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each part
    manifest = parts.select(
        "*", F.lit(width).alias("width"), F.coalesce(F.sum("docs").over(before), F.lit(0)).alias("first_doc"),
        F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("base"),
    )
    manifest.write.parquet(f"{folder}/manifest")
    return read_manifest(docs.sparkSession, folder)


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema("part int, docs long, ids long, null_ids long, width int, first_doc long, base long").parquet(f"{folder}/manifest")


class Part:
    """The files of one part, memory-mapped where the file system is local."""

    def __init__(self, folder: str, part: int, width: int):
        files, root = opened(folder)
        self.width = width
        self.files = {kind: files.open_input_file(f"{root}/{part:06d}.{kind}") for kind in ("ids", "offsets", "docs")}

    def _numbers(self, kind: str, dtype: str, first: int, last: int) -> np.ndarray:
        size, source = np.dtype(dtype).itemsize, self.files[kind]
        source.seek(first * size)
        return np.frombuffer(source.read_buffer((last - first) * size), dtype)

    def offsets(self, first: int, last: int) -> np.ndarray:
        """Where the documents from ``first`` begin, and the end of the one before ``last``."""
        return self._numbers("offsets", "<u8", first, last + 1).astype(np.int64)

    def doc_ids(self, first: int, last: int) -> np.ndarray:
        return self._numbers("docs", "<i8", first, last)

    def ids(self, first: int, last: int) -> np.ndarray:
        return self._numbers("ids", f"<u{self.width}", first, last)

    def close(self) -> None:
        for source in self.files.values():
            source.close()


class TokenFiles:
    """Random access to documents by their number, for a reader that reaches the folder; ``manifest`` is its rows."""

    def __init__(self, folder: str, manifest: list):
        self.folder, self.rows, self.parts = folder, sorted(manifest, key=lambda r: r.part), {}
        self.firsts = np.array([r.first_doc for r in self.rows], np.int64)

    def __len__(self) -> int:
        return self.rows[-1].first_doc + self.rows[-1].docs if self.rows else 0

    def __getitem__(self, number: int) -> np.ndarray:
        if not 0 <= number < len(self):
            raise IndexError(number)
        row = self.rows[int(np.searchsorted(self.firsts, number, side="right")) - 1]
        part = self.parts.get(row.part) or self.parts.setdefault(row.part, Part(self.folder, row.part, row.width))
        first, last = part.offsets(number - row.first_doc, number - row.first_doc + 1)
        return part.ids(first, last)


def _read(folder: str, schema: pa.Schema, value: Callable[[list[np.ndarray]], pa.Array]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (r for b in batches for r in b.to_pylist()):
            part = Part(folder, row["part"], row["width"])
            first, last = row["first"], min(row["first"] + row["step"], row["docs"])
            ends = part.offsets(first, last)
            docs = part.doc_ids(first, last)
            nulls = np.arange(first, last) < row["null_ids"]
            at = 0
            while at < len(docs):  # documents of many ids one at a time
                to = max(at + 1, int(np.searchsorted(ends, ends[at] + IDS_READ, side="right")) - 1)
                ids, places = part.ids(ends[at], ends[to]), (ends[at:to + 1] - ends[at]).tolist()
                values = value([ids[a:b] for a, b in zip(places, places[1:])])
                n = ends[at + 1:to + 1] - ends[at:to]
                yield pa.RecordBatch.from_arrays([
                    pa.array(docs[at:to], mask=nulls[at:to]), pa.array(row["base"] + ends[at:to]), pa.array(n), values], schema=schema)
                at = to
            part.close()

    return run


def _documents(spark: SparkSession, folder: str, name: str, kind: pa.DataType, ddl: str, value) -> DataFrame:
    step = F.greatest(F.lit(1), F.expr(f"{IDS_READ} * docs div greatest(ids, 1)"))
    reads = read_manifest(spark, folder).withColumn("step", step.cast("long"))
    reads = reads.withColumn("first", F.explode(F.expr("sequence(0L, docs - 1, step)"))).repartition("part", "first")
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), (name, kind)])
    return reads.mapInArrow(_read(folder, schema, value), f"doc_id long, start long, n_tokens long, {name} {ddl}")


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """Every document as the files hold it: ``doc_id, start, n_tokens, ids``; ``start`` counts the ids of all before."""

    def lists(documents: list[np.ndarray]) -> pa.Array:
        ends = np.zeros(len(documents) + 1, np.int32)
        np.cumsum([len(d) for d in documents], out=ends[1:])
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(documents).astype(np.int32)))

    return _documents(spark, folder, "ids", pa.list_(pa.int32()), "array<int>", lists)


def token_digests(spark: SparkSession, folder: str) -> DataFrame:
    """The same with the CRC-32 of the ids, as 32-bit little-endian numbers, in place of the ids."""

    def digests(documents: list[np.ndarray]) -> pa.Array:
        return pa.array([zlib.crc32(d.astype("<u4").tobytes()) for d in documents], pa.int64())

    return _documents(spark, folder, "ids_crc32", pa.int64(), "long", digests)
