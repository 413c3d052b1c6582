"""SentencePiece encoding and decoding for vocabularies of merges.

Encoding starts from single characters. An agenda holds the adjacent pairs that form a piece; the pair with the
highest score, or the leftmost of equals, is joined first and its new neighbours enter the agenda. Characters
without a piece become byte pieces. No piece of a merge vocabulary joins a word to the blank after it, and no
piece holds a line feed, which ``Vocabulary`` proves for the given model; so a text is cut there and every
distinct part is encoded once per worker. Within each Arrow batch the new parts are encoded by the library as
well, and a difference ends the job.

Defined cases: null and empty texts give only the end id; their decoded text is empty.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from pathlib import Path
from struct import pack

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from care_lake.llm.common import process_cache, slices
from care_lake.llm.units import Kept, as_units, gathered, joined, lists_of

BLANK = "▁"
TEXT_BYTES = 4 << 20


def read_model(path: str) -> bytes:
    return Path(path).read_bytes()


class Vocabulary:
    """Pieces, scores and byte pieces of a model, and encoding by the agenda."""

    def __init__(self, model: bytes):
        self.library = lib = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.ids, self.names, self.bytes_of, scores = {}, [], {}, {}
        self.byte_ids = [lib.unk_id()] * 256
        for i in range(lib.get_piece_size()):
            name = lib.id_to_piece(i)
            self.names.append("" if lib.is_control(i) else name)
            if lib.is_byte(i):
                value = int(name[3:5], 16)
                self.byte_ids[value], self.bytes_of[i] = i, value
            elif not (lib.is_control(i) or lib.is_unknown(i)):
                self.ids[name], scores[name] = i, lib.get_score(i)
        order = {score: rank for rank, score in enumerate(sorted(set(scores.values()), reverse=True))}
        self.ranks = {name: order[score] for name, score in scores.items()}
        self.end = lib.eos_id()
        self.raw = [bytes([self.bytes_of[i]]) if i in self.bytes_of else n.replace(BLANK, " ").encode() for i, n in enumerate(self.names)]
        self.raw_array = pa.array(self.raw, pa.large_binary())
        self.cuts = not any(re.search(f"[^{BLANK}]{BLANK}|\n", p) for p in self.ids)

    def merge(self, text: str) -> list[int]:
        """Ids of a text whose blanks are already marked."""
        rank_of, symbols = self.ranks.get, list(text)
        after = [*range(1, len(symbols)), -1]
        before = [*range(-1, len(symbols) - 1)]
        offered = [rank_of(a + b, -1) for a, b in zip(symbols, symbols[1:])] + [-1]  # of the pair that begins here
        agenda = [(rank << 32) + left for left, rank in enumerate(offered) if rank >= 0]
        heapify(agenda)
        while agenda:
            entry = heappop(agenda)
            left = entry & 0xFFFFFFFF
            if offered[left] != entry >> 32:
                continue  # one of the two has been joined to another since
            right = after[left]
            symbols[left] += symbols[right]
            symbols[right], offered[right] = "", -1
            after[left] = follower = after[right]
            offered[left] = -1
            if follower >= 0:
                before[follower] = left
                offered[left] = rank = rank_of(symbols[left] + symbols[follower], -1)
                if rank >= 0:
                    heappush(agenda, (rank << 32) + left)
            leader = before[left]
            if leader >= 0:
                offered[leader] = rank = rank_of(symbols[leader] + symbols[left], -1)
                if rank >= 0:
                    heappush(agenda, (rank << 32) + leader)
        ids = [self.ids.get(s, -1) for s in symbols if s]
        if -1 not in ids:
            return ids
        return [i for s in symbols if s for i in ([self.ids[s]] if s in self.ids else [self.byte_ids[b] for b in s.encode()])]

    def ids_of(self, texts: pa.Array, kept: Kept) -> tuple[np.ndarray, np.ndarray]:
        """All ids without end ids, and how many there are up to the end of each text.

        Texts are cut before a run of blanks and around line feeds, where no piece can reach across.
        """
        texts = pc.replace_substring(pc.fill_null(texts, ""), BLANK, " ")
        raw, ends = joined(texts)
        filled = np.diff(ends, prepend=0) > 1  # the blank before a text is put before none that is empty
        if not filled.all():
            ids, some = self.ids_of(texts.filter(pa.array(filled)), kept) if filled.any() else (np.zeros(0, np.int32), np.zeros(0, np.int64))
            return ids, np.append(0, some)[np.cumsum(filled)]
        cut = np.zeros(len(raw), bool)
        if self.cuts:
            blank, feed = raw == 32, raw == 10
            cut[1:] = blank[1:] & ~blank[:-1] | feed[1:] | feed[:-1]
        cut[np.append(0, ends[:-1])] = True
        units = as_units(raw, cut).dictionary_encode()
        return gathered(lists_of(kept(units.dictionary.to_pylist())), units.indices, np.cumsum(cut)[ends - 1])

    def encode_units(self, units: list[bytes]) -> list[bytes]:
        return self.encode_new([u.decode().replace(" ", BLANK) for u in units])

    def encode_new(self, parts: list[str]) -> list[bytes]:
        """Ids of distinct parts as bytes, each checked against the library."""
        own = [self.merge(p) for p in parts]
        # The library puts a blank before every text. Behind a line feed the parts without one can be compared.
        library = self.library.encode([p[1:] if p[:1] == BLANK else "\n" + p for p in parts], num_threads=1)
        lead = len(self.library.encode("\n"))
        for part, ids, check in zip(parts, own, library, strict=True):
            if ids != (check if part[:1] == BLANK and len(part) > 1 else check[lead:] if part[:1] != BLANK else ids):
                raise ValueError(f"the library encodes {part!r} as {check}, the agenda as {ids}")
        return [pack(f"<{len(ids)}i", *ids) for ids in own]

    def decode(self, ids: list[int]) -> str:
        """The text of ids, as the library's decode gives it."""
        raw = b"".join(map(self.raw.__getitem__, ids))
        first = next((i for i in ids if self.raw[i]), None)
        if first is not None and first not in self.bytes_of and self.names[first][0] == BLANK:
            raw = raw[1:]
        try:
            return raw.decode()
        except UnicodeDecodeError:  # byte pieces that do not make up characters; the library replaces each byte
            return self.library.decode(ids)

    def texts_of(self, lists: pa.ListArray) -> list[str]:
        """The texts of many lists of ids; null ids and null lists give nothing."""
        ids = lists.flatten()
        ends = np.append(0, np.cumsum(pc.list_value_length(lists).fill_null(0).to_numpy())).tolist()
        if ids.null_count:
            return [self.decode([i for i in ids[a:b].to_pylist() if i is not None]) for a, b in zip(ends, ends[1:])]
        taken = self.raw_array.take(ids)
        places = np.frombuffer(taken.buffers()[1], np.int64)[np.array(ends)].tolist()
        raw, firsts = memoryview(taken.buffers()[2] or b""), ids.to_numpy()
        out = []
        for a, b, start, end in zip(ends, ends[1:], places, places[1:]):
            first = firsts[a] if a < b else -1
            if first < 0 or not self.raw[first]:  # nothing, or a control id first
                out.append(self.decode(ids[a:b].to_pylist()))
                continue
            start += first not in self.bytes_of and self.names[first][0] == BLANK
            try:
                out.append(str(raw[start:end], "utf-8"))
            except UnicodeDecodeError:
                out.append(self.library.decode(ids[a:b].to_pylist()))
        return out


def _vocabulary(model: bytes) -> Vocabulary:
    held = process_cache("pieces", model)
    if not held:
        vocabulary = Vocabulary(model)
        held.update(vocabulary=vocabulary, kept=Kept(vocabulary.encode_units, 250_000))
    return held["vocabulary"]


def _appended(batch: pa.RecordBatch, name: str, column: pa.Array) -> pa.RecordBatch:
    names = batch.schema.names
    if name in names:
        return batch.set_column(names.index(name), name, column)
    return batch.append_column(name, column)


def with_schema(df: DataFrame, name: str, kind: T.DataType) -> T.StructType:
    fields = [T.StructField(f.name, kind if f.name == name else f.dataType, True) for f in df.schema.fields]
    return T.StructType(fields + [T.StructField(name, kind, True)] * (name not in df.columns))


def encode(docs: DataFrame, model: bytes, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """Add the ids of every text, with the end id last. A column named ``ids_col`` is replaced."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, kept = _vocabulary(model), process_cache("pieces", model)["kept"]
        for batch in slices(batches, text_col, TEXT_BYTES):
            ids, ends = vocabulary.ids_of(batch.column(text_col), kept)
            offsets = np.append(0, ends + np.arange(1, len(ends) + 1)).astype(np.int32)
            values = np.insert(ids, ends, vocabulary.end).astype(np.int32)  # the end id behind each text
            yield _appended(batch, ids_col, pa.ListArray.from_arrays(pa.array(offsets), pa.array(values)))

    return docs.mapInArrow(run, with_schema(docs, ids_col, T.ArrayType(T.IntegerType())))


def decode(docs: DataFrame, model: bytes, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """Add the text of a list of ids; null ids give an empty text. A column named ``text_col`` is replaced."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(model)
        for batch in batches:
            for start in range(0, batch.num_rows, 1000):
                piece = batch.slice(start, 1000)
                yield _appended(piece, text_col, pa.array(vocabulary.texts_of(piece.column(ids_col)), pa.string()))

    return docs.mapInArrow(run, with_schema(docs, text_col, T.StringType()))
