"""Line dedup: lines that many documents share are dropped.

Lines become hashes. They are range-partitioned by (hash, document), sorted by hash, document and place, and
read as a stream: within a partition all rows of a hash follow each other. A hash found in enough documents
inside a partition is settled at once. Only a hash at a border of a partition may go on in the next one; such
rows carry their hash along, and their documents are added up over the partitions. A line that a third of all
documents contain thus spreads over as many partitions as it needs. The result is a compressed keep bitmap
for each document, never text.

Defined cases: a null or empty text is one empty line; lines whose key is empty are always kept; rows repeated
with the same id and text count as one document and get the same bitmap; a null id is an id like any other;
an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from care_lake.llm.common import boxed, row_key, unboxed
from care_lake.session import staged

BLANKS = " \t\n\x0b\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FOUND = pa.schema([("hash", pa.binary()), ("key", pa.binary()), ("pos", pa.int32()), ("settled", pa.bool_()),
                   ("starts", pa.bool_())])


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(BLANKS)), UPPER, LOWER)


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def hashed_lines(docs: DataFrame, id_col: str, text_col: str, min_length: int) -> DataFrame:
    """One row per line with a key of ``min_length`` code points or more: hash, key of the document, place."""
    rows = docs.select(row_key(F.col(id_col), F.col(text_col)).alias("key"), F.posexplode(_lines(F.col(text_col))).alias("pos", "line"))
    rows = rows.select("key", "pos", line_key(F.col("line")).alias("line")).where(F.length("line") >= max(1, min_length))
    return rows.select(F.unhex(F.md5("line")).alias("hash"), "key", "pos")


def _stream(min_docs: int):
    """Rows of hashes in ``min_docs`` documents or more, and of hashes at the borders of a partition."""

    def rows(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            yield from zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True)

    def found(batches: Iterator[pa.RecordBatch]):
        first, waiting = True, []
        for value, run in groupby(rows(batches), itemgetter(0)):
            documents, seen, held, at = 0, None, [], None
            for _, key, pos in run:
                if (key, pos) == at:  # the line of a repeated row
                    continue
                starts, at = key != seen, (key, pos)
                documents, seen = documents + starts, key
                row = (value, key, pos, documents >= min_docs, starts)
                if documents < min_docs:
                    held.append(row)
                    continue
                for early in held:
                    yield (*early[:3], True, *early[4:])
                held = []
                yield row
            if first:
                yield from held  # this hash may have begun in the partition before
                held = []
            first, waiting = False, held
        yield from waiting  # and the last one may go on in the next

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for row in found(batches):
            held.append(row)
            if len(held) == 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), FOUND)], schema=FOUND)
                held = []
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), FOUND)], schema=FOUND)

    return blocks


def _bitmap(places: pa.Array) -> pa.Array:
    def one(found) -> bytes:
        keep = np.ones(max(found) // 8 * 8 + 8, bool)  # whole bytes
        keep[found] = False
        return zlib.compress(np.packbits(keep).tobytes())

    return pa.array([one(p) for p in places.to_pylist()], pa.binary())


def _kept(text: pa.Array, bitmap: pa.Array) -> pa.Array:
    def one(t: str | None, packed: bytes | None) -> str | None:
        if packed is None:
            return None
        keep = np.unpackbits(np.frombuffer(zlib.decompress(packed), np.uint8))
        return "\n".join(x for i, x in enumerate(t.split("\n")) if i >= len(keep) or keep[i])

    return pa.array(map(one, text.to_pylist(), bitmap.to_pylist()), pa.string())


def line_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = 10,
                 min_length: int = 1, keep_first: bool = False) -> DataFrame:
    """Keep bitmaps of the documents that lose lines: ``key``, ``n_dropped``, ``keep``.

    ``keep`` is a zlib-compressed bit per line, first line first; lines past its end are kept. A key found in
    ``min_docs`` documents loses all its lines, or with ``keep_first`` all but those of one document. That is the
    one which would keep the fewest lines, then lose the most, then the first by key: one order over all documents, so
    a text of nothing but shared lines stays whole in one place.
    """
    lines = staged(hashed_lines(docs, id_col, text_col, min_length), "lines")
    ordered = lines.repartitionByRange("hash", "key").sortWithinPartitions("hash", "key", "pos")
    found = staged(ordered.mapInArrow(_stream(min_docs), "hash binary, key binary, pos int, settled boolean, starts boolean"), "line-runs")
    enough = found.where("starts").groupBy("hash").agg(F.count("*").alias("n")).where(F.col("n") >= min_docs)
    dropped = found.where("settled").unionByName(found.where(~F.col("settled")).join(enough.select("hash"), "hash", "left_semi"))
    if keep_first:
        dropped = staged(dropped.select("hash", "key", "pos"), "line-drops")
        lost = dropped.distinct().groupBy("key").agg(F.count("*").alias("lost"))
        total = lines.select("key", "pos").distinct().groupBy("key").agg(F.count("*").alias("total"))
        rank = F.struct((F.col("total") - F.col("lost")).alias("own"), (-F.col("lost")).alias("lost"), "key")
        ranked = dropped.join(lost.join(total, "key"), "key").select("hash", "key", "pos", rank.alias("rank"))
        leader = ranked.groupBy("hash").agg(F.min("rank")["key"].alias("leader"))
        dropped = ranked.join(leader, "hash").where(F.col("key") != F.col("leader"))
    places = dropped.groupBy("key").agg(F.collect_list("pos").alias("places"))
    return places.select("key", F.size("places").cast("long").alias("n_dropped"), F.arrow_udf(_bitmap, "binary")("places").alias("keep"))


def drop_lines(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with their remaining lines, and ``n_lines`` (before) and ``n_dropped``."""
    own = boxed(docs, text=F.coalesce(F.col(text_col), F.lit("")), key=row_key(F.col(id_col), F.col(text_col)))
    both = own.join(bitmaps, "key", "left")
    changed = F.arrow_udf(_kept, "string")(F.when(F.col("keep").isNotNull(), F.col("text")), F.col("keep"))
    return unboxed(both, **{
        text_col: F.coalesce(changed, F.col("text")),
        "n_lines": F.size(_lines(F.col("text"))).cast("long"),
        "n_dropped": F.coalesce("n_dropped", F.lit(0)).cast("long"),
    })
