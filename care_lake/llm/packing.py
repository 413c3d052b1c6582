"""Packing documents into sequences of fixed length with a bounded number of open windows.

Every partition tokenizes its documents and keeps a fixed number of open windows. A piece goes into the window
that it fills best. When it fits nowhere, the fullest window is emitted: a piece much larger than the room left
there is cut to fill it, else the room stays as padding. What is open at the end of a partition is merged
afterwards: the windows left by a bounded number of partitions meet in one task, which repacks their sizes only,
and the rest of those tasks meets again, until one group is left.

The tokens of a partition are written once before the merge, so a repeated task cannot mix two packings.

Defined cases: a null or empty text is the end id alone; repeated rows are packed each; a document longer than a
window is cut into whole windows and a rest; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from care_lake.llm.common import int_lists, process_cache, slices
from care_lake.llm.units import WordIds, read_tokenizer  # noqa: F401  (readers of packing find it here)
from care_lake.session import staged

TEXT_BYTES = 4 << 20
PIECE = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.list_(pa.int32())),
                   ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("window", pa.int64()), ("offset", pa.int64()), ("open", pa.bool_())])
PIECE_DDL = "doc_id long, start long, length long, ids array<int>, ids_crc32 long, doc_tokens long, window long, offset long, open boolean"


class Open:
    """Open windows, ordered by the room that is left in them."""

    def __init__(self, size: int, most: int):
        self.size, self.most, self.rooms, self.next = size, most, [], 0  # rooms: (room, window)

    def fits(self, length: int) -> bool:
        return bool(self.rooms) and self.rooms[-1][0] >= length

    def place(self, length: int) -> tuple[int, int]:
        """Window and offset for a piece: the fullest that takes it, or a new one."""
        i = bisect_left(self.rooms, (length, -1))
        if i < len(self.rooms):
            room, window = self.rooms.pop(i)
        else:
            room, window, self.next = self.size, self.next, self.next + 1
        if room > length:
            insort(self.rooms, (room - length, window))
        return window, self.size - room


def packed(docs: Iterator[tuple[object, int]], size: int, most: int, least_cut: int) -> Iterator[tuple[int, list, bool]]:
    """Stream (document, length) to windows as they leave: number, pieces (document, start, length, offset), open.

    The windows that are open at the end come last.
    """
    windows, held = Open(size, most), {}
    for doc, length in docs:
        start = 0
        while length - start >= size:
            window, windows.next = windows.next, windows.next + 1
            yield window, [(doc, start, size, 0)], False
            start += size
        while start < length:
            rest = length - start
            if not windows.fits(rest) and len(windows.rooms) == most:
                room, fullest = windows.rooms[0]
                if room < least_cut:
                    windows.rooms.pop(0)
                    yield fullest, held.pop(fullest), False
                else:
                    rest = room  # the fullest window is filled and leaves
            window, offset = windows.place(rest)
            held.setdefault(window, []).append((doc, start, rest, offset))
            start += rest
            if offset + rest == size:
                yield window, held.pop(window), False
    for window, pieces in held.items():
        yield window, pieces, True


def _first_pass(tokenizer: str, size: int, most: int, least_cut: int, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = process_cache("packing", tokenizer)
        encode = held.get("encode") or held.setdefault("encode", WordIds(tokenizer))
        base = TaskContext.get().partitionId() << 32
        end = end_id.to_bytes(4, "little")

        def documents():
            for batch in slices(batches, "text", TEXT_BYTES):
                ids, ends = encode(batch.column("text"))
                raw, first = ids.astype("<i4").tobytes(), 0
                for doc_id, last in zip(batch.column("doc_id").to_pylist(), ends.tolist(), strict=True):
                    yield (doc_id, raw[4 * first:4 * last] + end), last - first + 1
                    first = last

        def block(rows: list) -> pa.RecordBatch:
            columns = list(zip(*rows))
            columns[3] = int_lists(columns[3])
            return pa.RecordBatch.from_arrays([c if i == 3 else pa.array(c, f.type) for i, (c, f) in enumerate(zip(columns, PIECE))], schema=PIECE)

        rows, size_held = [], 0
        for window, pieces, is_open in packed(documents(), size, most, least_cut):
            for (doc_id, t), start, length, offset in pieces:
                ids = t[4 * start:4 * (start + length)]
                rows.append((doc_id, start, length, ids, zlib.crc32(ids), len(t) // 4, base + window, offset, is_open))
                size_held += length
            if size_held > 1 << 20:
                yield block(rows)
                rows, size_held = [], 0
        if rows:
            yield block(rows)

    return run


def _merge_level(left: DataFrame, size: int, most: int, level: int, last: bool) -> DataFrame:
    """Repack windows of one group of partitions: ``window, filled, group`` to ``window, target, shift, target_open``."""

    def merge(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["filled", "window"], ascending=[False, True])
        windows, out = Open(size, len(rows) + 1), []
        base = (level << 56) + (int(rows["group"].iloc[0]) << 32)
        for window, filled in zip(rows["window"], rows["filled"], strict=True):
            target, shift = windows.place(int(filled))
            out.append((window, base + target, shift))
        still = {base + w for _, w in windows.rooms[-most:]} if not last else set()
        return pd.DataFrame([(*o, o[1] in still) for o in out], columns=["window", "target", "shift", "target_open"])

    return left.groupBy("group").applyInPandas(merge, "window long, target long, shift long, target_open boolean")


def pack(docs: DataFrame, tokenizer: str, size: int = 4096, open_windows: int = 64, least_cut: int = 64,
         end_id: int = 2, fan_in: int = 64, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of documents in sequences: ``doc_id, start, length, ids, ids_crc32, doc_tokens, sequence_id, offset``.

    ``ids_crc32`` is that of the ids as 32-bit little-endian numbers.

    ``tokenizer`` is the JSON of a tokenizer that drops white space. ``open_windows`` bounds the windows open in a
    partition; a cut leaves at least ``least_cut`` ids in the window it fills. ``fan_in`` partitions are merged in
    one task.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    first = staged(rows.mapInArrow(_first_pass(tokenizer, size, open_windows, least_cut, end_id), PIECE_DDL), "pieces")
    sizes = first.where("open").groupBy("window").agg(F.sum("length").alias("filled"))
    sizes = staged(sizes.withColumn("group", F.expr("window >> 32")), "open-windows")
    groups, level, moved = (sizes.agg(F.max("group")).first()[0] or 0) + 1, 0, None
    while moved is None or groups > 1:
        groups, level = -(-groups // fan_in), level + 1
        sizes = sizes.withColumn("group", F.expr(f"group div {fan_in}"))
        step = staged(_merge_level(sizes, size, open_windows, level, groups == 1), "merged-windows")
        if moved is None:
            moved = step.select("window", "target", "shift")
        else:
            later = step.select(F.col("window").alias("target"), F.col("target").alias("next"), F.col("shift").alias("more"))
            moved = moved.join(later, "target", "left").select(
                "window", F.coalesce("next", "target").alias("target"), (F.col("shift") + F.coalesce("more", F.lit(0))).alias("shift"))
        sizes = step.where("target_open").join(sizes, "window").groupBy(F.col("target").alias("window"))
        sizes = sizes.agg(F.sum("filled").alias("filled"), F.min("group").alias("group"))
    out = ["doc_id", "start", "length", "ids", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    settled = first.where("not open").withColumnRenamed("window", "sequence_id")
    merged = first.where("open").join(moved, "window").withColumnsRenamed({"target": "sequence_id"})
    return settled.select(*out).unionByName(merged.withColumn("offset", F.col("offset") + F.col("shift")).select(*out))


def _crc(ids: pa.Array) -> pa.Array:
    values = ids.values.to_numpy()
    ends = ids.offsets.to_pylist()
    return pa.array([zlib.crc32(values[a:b].astype("<u4").tobytes()) for a, b in zip(ends, ends[1:])], pa.int64())


def piece_digests(pieces: DataFrame) -> DataFrame:
    """The pieces without their ids, which are read only where their length and CRC-32 are not known."""
    if "ids_crc32" not in pieces.columns:
        pieces = pieces.withColumns({"length": F.size("ids").cast("long"), "ids_crc32": F.arrow_udf(_crc, "long")("ids")})
    return pieces.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
