"""Alignment of two tokenizers over the same text, and how often their ids meet.

Both tokenizations of a text cut the same bytes. Where they cut at the same byte, a group of tokens ends. Each document's
two lists of token ends are walked on a diagonal: as long as the ends at the current shift of indices agree, tokens
correspond one to one, and stretches of doubling length are compared at once to jump over them (then halving
ones, to find where they stop). Where they differ, the two lists are walked by smaller end until they meet again; that is
one irregular group, and the shift becomes that of the place behind it.

Links are the pairs of tokens whose bytes overlap. How many documents hold a pair of ids linked is counted over the
whole corpus: every block of documents gives its distinct pairs with their numbers of documents, and Spark adds them up. The
counts are written as sorted flat files, split by range; their size is bounded by the two vocabularies, not by the corpus. A
block keeps its links as numbers of its own pairs in a file, finds the counts of its pairs by binary search in the
(memory-mapped) files, and adds them up per document, so no link is shuffled and no frequent pair meets in one task.

Tokens come from the libraries. Texts are cut into units that the tokenizers treat apart, and each distinct unit is encoded once
per worker; a text with a unit that does not give its bytes back is encoded whole.

Defined cases: null and empty texts, and texts whose tokens do not give back the blank before them and all their bytes, have
no tokens: zeros, and '' as digest; repeated rows are documents each; a null id is an id like any other; an empty table
gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Iterator
from struct import pack

import numpy as np
import pyarrow as pa
import sentencepiece
import tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from care_lake.llm.common import process_cache, slices
from care_lake.llm.token_files import opened
from care_lake.llm.units import Kept, as_units, gathered, joined, lists_of, word_cuts
from care_lake.session import shared_folder, staged

BLANK = "▁"
TEXT_BYTES = 4 << 20
WINDOW = 1 << 16
DOC = pa.schema([("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()),
                 ("n_best", pa.int64()), ("count_sum", pa.int64()), ("groups_sha256", pa.string())])
DOC_DDL = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


class ByteTokens:
    """Ids and bytes of a byte-level tokenizer; names of special tokens are plain text."""

    def __init__(self, tokenizer: str, most: int = 200_000):
        self.library = tokenizers.Tokenizer.from_str(tokenizer)
        self.library.encode_special_tokens = True
        visible = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that byte-level vocabularies show as they are
        hidden = [b for b in range(256) if b not in set(visible)]
        self.shown = {**{b: chr(b) for b in visible}, **{b: chr(256 + i) for i, b in enumerate(hidden)}}
        byte_of = {c: b for b, c in self.shown.items()}
        size = self.library.get_vocab_size()
        special = {t.content for t in self.library.get_added_tokens_decoder().values()}
        entries = [self.library.id_to_token(i) or "" for i in range(size)]
        self.raw = [e.encode() if e in special else bytes(byte_of[c] for c in e) for e in entries]
        self.merge, self.kept = self.library.model.tokenize, Kept(self._new, most)

    def whole(self, text: str) -> list[int]:
        return self.library.encode(" " + text, add_special_tokens=False).ids

    def cuts(self, raw: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return word_cuts(raw, ends)

    def _new(self, units: list[bytes]) -> list[bytes]:
        found, others = {}, []
        for i, unit in enumerate(units):
            word = unit.decode()
            letters = word[1:] if word[0] == " " else word
            if letters.isalpha() and max(letters) < "ɐ":  # a run of letters is what the tokenizer splits there
                found[i] = [t.id for t in self.merge("".join(map(self.shown.__getitem__, unit)))]
            else:
                others.append(i)
        for i, e in zip(others, self.library.encode_batch_fast([units[i].decode() for i in others], add_special_tokens=False), strict=True):
            found[i] = e.ids
        return [checked(self.raw, found[i], u) for i, u in enumerate(units)]


class PieceTokens:
    """Ids and bytes of a SentencePiece model that puts a blank before a text."""

    def __init__(self, model: bytes, most: int = 200_000):
        self.library = lib = sentencepiece.SentencePieceProcessor(model_proto=model)
        names = [lib.id_to_piece(i) for i in range(lib.get_piece_size())]
        self.raw = [bytes([int(n[3:5], 16)]) if lib.is_byte(i) else b"" if lib.is_control(i) else n.replace(BLANK, " ").encode() for i, n in enumerate(names)]
        # no piece of most models joins something to the blank after it or holds a line feed: texts are cut there
        self.apart = not any(re.search(f"[^{BLANK}]{BLANK}|\n", n) for n in names)
        self.lead = len(lib.encode("\n"))
        self.kept = Kept(self._new, most)

    def whole(self, text: str) -> list[int]:
        return self.library.encode(text, num_threads=1)

    def cuts(self, raw: np.ndarray, ends: np.ndarray) -> np.ndarray:
        cut = np.zeros(len(raw), bool)
        if self.apart:
            blank, feed = raw == 32, raw == 10
            cut[1:] = blank[1:] & ~blank[:-1] | feed[1:] | feed[:-1]
        starts = np.append(0, ends[:-1])
        cut[starts[starts < len(raw)]] = True
        return cut

    def _new(self, units: list[bytes]) -> list[bytes]:
        # the library puts a blank before every text; behind a line feed a unit without one can be read
        texts = [u.decode() for u in units]
        found = self.library.encode([t[1:] if t[0] == " " else "\n" + t for t in texts], num_threads=1)
        return [checked(self.raw, ids if t[0] == " " else ids[self.lead:], u) for t, ids, u in zip(texts, found, units, strict=True)]


def checked(raw: list[bytes], ids: list[int], unit: bytes) -> bytes:
    """The ids as bytes, or none if they do not give the unit back."""
    return pack(f"<{len(ids)}i", *ids) if b"".join(map(raw.__getitem__, ids)) == unit else b""


def tokens_of(tokens: ByteTokens | PieceTokens, texts: pa.Array, raw: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All ids, how many there are up to the end of each text, and which texts hold a unit without ids."""
    cut = tokens.cuts(raw, ends)
    unit_ends = np.cumsum(cut)[ends - 1] if len(ends) else np.zeros(0, np.int64)
    units = as_units(raw, cut).dictionary_encode()
    lists = lists_of(tokens.kept(units.dictionary.to_pylist()))
    none = np.flatnonzero(np.diff(np.frombuffer(lists.buffers()[1], np.int64)) == 0)
    bad = np.zeros(len(ends), bool)
    if len(none):
        places = np.flatnonzero(np.isin(units.indices.to_numpy(), none))
        bad[np.searchsorted(unit_ends, places, side="right")] = True
    ids, id_ends = gathered(lists, units.indices, unit_ends)
    return ids, id_ends, bad


def diagonal_groups(a: list[int], b: list[int]) -> list[tuple[int, int, int]]:
    """Groups of two ascending lists of token ends with the same last end.

    Stretches ``(i, j, n)``: n groups, the first of which ends before tokens i and j, each other one token of both later.
    """
    out, i, j, n = [], 0, 0, len(a)
    while i < n:
        x, y = a[i], b[j]
        if x == y:
            first, step = i, 1
            i, j = i + 1, j + 1
            while (ahead := a[i:i + step]) and ahead == b[j:j + step]:  # the shift j - i stays
                i, j, step = i + len(ahead), j + len(ahead), 2 * step
            while step > 1:
                step //= 2
                if (ahead := a[i:i + step]) and ahead == b[j:j + step]:
                    i, j = i + len(ahead), j + len(ahead)
            out.append((first + 1, j - i + first + 1, i - first))
        else:
            while x != y:
                if x < y:
                    i += 1
                    x = a[i]
                else:
                    j += 1
                    y = b[j]
            i, j = i + 1, j + 1
            out.append((i, j, 1))
    return out


def group_ends(a: np.ndarray, b: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """How many tokens of each side there are up to the end of every group; long documents go by windows."""
    i = j = 0
    found = []
    while i < len(a):
        size = window
        while True:
            to = min(len(a), i + size)
            to_b = int(np.searchsorted(b, a[to - 1], side="right"))
            common = np.flatnonzero(np.isin(a[i:to], b[j:to_b], assume_unique=True)) if to < len(a) else [to - i - 1]
            if len(common):
                break
            size *= 2
        to = i + int(common[-1]) + 1
        to_b = int(np.searchsorted(b, a[to - 1], side="right"))
        runs = np.array(diagonal_groups(a[i:to].tolist(), b[j:to_b].tolist()), np.int64).reshape(-1, 3)
        found.append(runs + [i, j, 0])
        i, j = to, to_b
    runs = np.concatenate(found) if found else np.zeros((0, 3), np.int64)
    n = runs[:, 2]
    within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    return np.repeat(runs[:, 0], n) + within, np.repeat(runs[:, 1], n) + within


class Aligned:
    """A block of documents under both tokenizers. ``*_ends`` count what there is up to the end of each document."""

    def __init__(self, texts: pa.Array, a: ByteTokens, b: PieceTokens):
        raw, ends = joined(texts)
        (self.a, self.a_ends, bad_a), (self.b, self.b_ends, bad_b) = (tokens_of(t, texts, raw, ends) for t in (a, b))
        empty = np.diff(ends, prepend=0) == 1
        if (again := bad_a | bad_b | empty).any():
            self._apart(texts, a, b, raw, ends, again, empty)
        self.a_bytes = np.cumsum(a.lengths[self.a])
        self.b_bytes = np.cumsum(b.lengths[self.b])
        groups_a, groups_b, group_counts, a0, b0 = [], [], [], 0, 0
        for a1, b1 in zip(self.a_ends.tolist(), self.b_ends.tolist()):
            ga, gb = group_ends(self.a_bytes[a0:a1], self.b_bytes[b0:b1])
            groups_a.append(ga + a0)
            groups_b.append(gb + b0)
            group_counts.append(len(ga))
            a0, b0 = a1, b1
        none = np.zeros(0, np.int64)
        self.groups_a, self.groups_b = np.concatenate([none, *groups_a]), np.concatenate([none, *groups_b])
        self.group_ends = np.cumsum(group_counts, dtype=np.int64)

    def _apart(self, texts, a, b, raw, ends, again, empty) -> None:
        """Documents that cannot be put together from units: tokens of the whole text, or none."""
        sides = []
        for ids, id_ends in ((self.a, self.a_ends), (self.b, self.b_ends)):
            starts = np.append(0, id_ends[:-1])
            sides.append([ids[s:e] for s, e in zip(starts, id_ends)])
        for i in np.flatnonzero(again).tolist():
            own = raw[ends[i - 1] if i else 0:ends[i]].tobytes()
            found = [t.whole(own[1:].decode()) for t in (a, b)]
            fits = not empty[i] and all(b"".join(map(t.raw.__getitem__, ids)) == own for t, ids in zip((a, b), found))
            for side, ids in zip(sides, found):
                side[i] = np.array(ids if fits else [], np.int32)
        self.a, self.b = (np.concatenate(s) if s else np.zeros(0, np.int32) for s in sides)
        self.a_ends, self.b_ends = (np.cumsum([len(x) for x in s], dtype=np.int64) for s in sides)

    def links(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Tokens of both sides whose bytes overlap, by place, and how many links there are up to the end of each document.

        Within a group the two sides' ends interlock, so each end of either side closes one link.
        """
        size = int(self.a_bytes[-1]) if len(self.a_bytes) else 0
        at_a, at_b = np.zeros(size + 1, bool), np.zeros(size + 1, bool)
        at_a[self.a_bytes], at_b[self.b_bytes] = True, True
        close = np.flatnonzero(at_a | at_b)
        of_a, of_b = (np.cumsum(at, dtype=np.int32)[close - 1] for at in (at_a, at_b))
        doc_bytes = np.append(0, self.a_bytes)[self.a_ends]
        return of_a, of_b, np.searchsorted(close, doc_bytes, side="right")

    def digests(self, names: pa.Array, n_a: int, n_b: int) -> list[str]:
        """SHA-256 of all groups of a document as text; ``names`` are those of ``named``."""
        sizes_a, sizes_b = np.diff(self.groups_a, prepend=0), np.diff(self.groups_b, prepend=0)
        last_a, last_b = np.zeros(len(self.a), np.int64), np.zeros(len(self.b), np.int64)
        last_a[self.groups_a - 1], last_b[self.groups_b - 1] = 1, 1
        order = np.empty(len(self.a) + len(self.b), np.int64)
        order[np.arange(len(self.a)) + np.repeat(self.groups_b - sizes_b, sizes_a)] = self.a + n_a * last_a
        order[np.arange(len(self.b)) + np.repeat(self.groups_a, sizes_b)] = 2 * n_a + self.b + n_b * last_b
        text = names.take(pa.array(order))
        places = np.frombuffer(text.buffers()[1], np.int64)[np.append(0, self.a_ends + self.b_ends)].tolist()
        raw = memoryview(text.buffers()[2] or b"")
        return [hashlib.sha256(raw[s:e - 1]).hexdigest() if e > s else "" for s, e in zip(places, places[1:])]


def named(n_a: int, n_b: int) -> pa.Array:
    """Decimal ids with the sign that follows them: A inside and at the end of its part, then B likewise."""
    return pa.array([f"{i}{sign}".encode() for n, signs in ((n_a, ",|"), (n_b, ",;")) for sign in signs for i in range(n)], pa.large_binary())


def _tokens(byte_tokenizer: str, piece_model: bytes) -> tuple[ByteTokens, PieceTokens, pa.Array]:
    held = process_cache("alignment", (byte_tokenizer, piece_model))
    if not held:
        a, b = ByteTokens(byte_tokenizer), PieceTokens(piece_model)
        for t in (a, b):
            t.lengths = np.array([len(r) for r in t.raw], np.int64)
        held.update(a=a, b=b, names=named(len(a.raw), len(b.raw)))
    return held["a"], held["b"], held["names"]


def _lists(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), pa.array(values, pa.int32()))


def align(docs: DataFrame, byte_tokenizer: str, piece_model: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Tokens and groups of every document: ``doc_id, a_ids, b_ids, group_a, group_b``; the last two are groups' sizes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b, _ = _tokens(byte_tokenizer, piece_model)
        for batch in slices(batches, "text", TEXT_BYTES):
            x = Aligned(batch.column("text"), a, b)
            sizes = [_lists(np.diff(g, prepend=0), x.group_ends) for g in (x.groups_a, x.groups_b)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), _lists(x.a, x.a_ends), _lists(x.b, x.b_ends), *sizes],
                                             names=["doc_id", "a_ids", "b_ids", "group_a", "group_b"])

    return _rows(docs, id_col, text_col).mapInArrow(run, "doc_id long, a_ids array<int>, b_ids array<int>, group_a array<int>, group_b array<int>")


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def _planes(values: np.ndarray) -> pa.Buffer:
    """32-bit numbers, compressed byte by byte of their width."""
    return pa.compress(np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes(), "zstd")


def _numbers(packed: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(packed, 4 * n, "zstd"), np.uint8).reshape(4, n)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def _blocks(byte_tokenizer: str, piece_model: bytes, folder: str):
    """Write a file for each block of documents; give its name, and its pairs of ids with their numbers of documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b, names = _tokens(byte_tokenizer, piece_model)
        files, root = opened(folder)
        task, n_b = TaskContext.get(), len(b.raw)
        for number, batch in enumerate(slices(batches, "text", TEXT_BYTES)):
            x = Aligned(batch.column("text"), a, b)
            of_a, of_b, link_ends = x.links()
            per_doc = np.diff(link_ends, prepend=0)
            pairs = pa.array(x.a[of_a].astype(np.int64) * n_b + x.b[of_b]).dictionary_encode()
            keys = pairs.dictionary.to_numpy()
            order = np.argsort(keys)
            rank = np.empty(len(keys), np.int64)
            rank[order] = np.arange(len(keys))
            width = max(1, len(keys))
            held = pa.array(np.repeat(np.arange(len(per_doc)), per_doc) * width + rank[pairs.indices.to_numpy()]).dictionary_encode()
            cells = held.dictionary.to_numpy()  # (document, pair), document by document
            times = np.bincount(held.indices.to_numpy(), minlength=len(cells))
            docs_of = np.bincount(cells % width, minlength=len(keys))
            cell_ends = np.searchsorted(cells // width, np.arange(len(per_doc)), side="right")
            table = pa.table({
                "doc_id": batch.column("doc_id"), "n_a": np.diff(x.a_ends, prepend=0), "n_b": np.diff(x.b_ends, prepend=0),
                "n_groups": np.diff(x.group_ends, prepend=0), "n_links": per_doc, "cells": cell_ends,
                "groups_sha256": pa.array(x.digests(names, len(a.raw), n_b), pa.string())})
            name = f"{task.partitionId():06d}-{number:06d}"
            with files.open_output_stream(f"{root}/{name}.{task.taskAttemptId()}") as out:
                with pa.ipc.new_file(out, table.schema.with_metadata({"pairs": str(len(keys)), "cells": str(len(cells))})) as writer:
                    writer.write_table(table.combine_chunks())
            sizes = []
            with files.open_output_stream(f"{root}/{name}.links.{task.taskAttemptId()}") as out:
                for part in (pa.compress(keys[order].astype("<i8").tobytes(), "zstd"), _planes(cells % width), _planes(times)):
                    out.write(part)
                    sizes.append(part.size if isinstance(part, pa.Buffer) else len(part))
            for kind in ("", ".links"):
                files.move(f"{root}/{name}{kind}.{task.taskAttemptId()}", f"{root}/{name}{kind}")
            none = [None] * len(keys)
            yield pa.RecordBatch.from_arrays([pa.array(keys[order]), pa.array(docs_of), pa.array(none, pa.string()), *[pa.array(none, pa.int64())] * 3],
                                             names=["pair", "n_docs", "block", "size_1", "size_2", "size_3"])
            yield pa.RecordBatch.from_arrays([pa.array([None], pa.int64())] * 2 + [pa.array([name])] + [pa.array([s], pa.int64()) for s in sizes],
                                             names=["pair", "n_docs", "block", "size_1", "size_2", "size_3"])

    return run


def _write_counts(folder: str):
    """Sorted pairs and their counts (twice the count, and 1 for the best of its A id) as flat files by range."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = opened(folder)
        task = TaskContext.get()
        name, n, first = f"{root}/counts-{task.partitionId():06d}", 0, None
        out = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            out = out or {kind: files.open_output_stream(f"{name}.{kind}.{task.taskAttemptId()}") for kind in ("pairs", "values")}
            first = batch.column("pair")[0].as_py() if first is None else first
            out["pairs"].write(batch.column("pair").to_numpy().astype("<i8").tobytes())
            out["values"].write(batch.column("value").to_numpy().astype("<i8").tobytes())
            n += batch.num_rows
        for kind, stream in out.items():
            stream.close()
            files.move(f"{name}.{kind}.{task.taskAttemptId()}", f"{name}.{kind}")
        if n:
            yield pa.RecordBatch.from_pylist([{"name": f"counts-{task.partitionId():06d}", "first": first, "n": n}])

    return run


def _looked_up(folder: str, parts: list[tuple[str, int, int]], keys: np.ndarray) -> np.ndarray:
    """Values of ascending keys, all of which stand in the count files."""
    files, root = opened(folder)
    places = np.append(np.searchsorted(keys, [p[1] for p in parts]), len(keys))
    out = np.zeros(len(keys), np.int64)
    for (name, _, n), start, end in zip(parts, places, places[1:]):
        if end > start:
            with files.open_input_file(f"{root}/{name}.pairs") as pairs, files.open_input_file(f"{root}/{name}.values") as values:
                known = np.frombuffer(pairs.read_buffer(8 * n), "<i8")
                out[start:end] = np.frombuffer(values.read_buffer(8 * n), "<i8")[np.searchsorted(known, keys[start:end])]
    return out


def _statistics(folder: str, parts: list[tuple[str, int, int]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = opened(folder)
        for row in (r for batch in batches for r in batch.to_pylist()):
            with files.open_input_file(f"{root}/{row['block']}") as source:
                reader = pa.ipc.open_file(source)
                table = reader.read_all()
                n_pairs, n_cells = (int(reader.schema.metadata[k]) for k in (b"pairs", b"cells"))
            with files.open_input_file(f"{root}/{row['block']}.links") as source:
                packed = [source.read(row[f"size_{k}"]) for k in (1, 2, 3)]
            keys = np.frombuffer(pa.decompress(packed[0], 8 * n_pairs, "zstd"), "<i8")
            cells, times = (_numbers(p, n_cells) for p in packed[1:])
            values = _looked_up(folder, parts, keys)[cells]
            ends = np.append(0, table["cells"].to_numpy())
            best, total = (np.append(0, np.cumsum(v * times))[ends] for v in (values & 1, values >> 1))
            columns = {"n_best": np.diff(best), "count_sum": np.diff(total)}
            table = table.combine_chunks()
            for start in range(0, table.num_rows, 5000):
                piece = table.slice(start, 5000)
                yield from pa.table([columns[f.name][start:start + 5000] if f.name in columns else piece[f.name] for f in DOC], schema=DOC).to_batches()

    return run


def alignment_statistics(docs: DataFrame, byte_tokenizer: str, piece_model: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``.

    ``byte_tokenizer`` (A) is the JSON of a byte-level tokenizer, ``piece_model`` (B) a SentencePiece model. The count of a pair of ids is the
    number of documents that hold it linked; ``n_best`` counts the links whose pair has the highest count of its A id, ``count_sum`` adds
    the counts of all links. The driver sees one row for each file of counts.
    """
    spark = docs.sparkSession
    folder = f"{shared_folder(spark)}/alignment/{uuid.uuid4().hex}"
    files, root = opened(folder)
    files.create_dir(root)
    ddl = "pair long, n_docs long, block string, size_1 long, size_2 long, size_3 long"
    found = staged(_rows(docs, id_col, text_col).mapInArrow(_blocks(byte_tokenizer, piece_model, folder), ddl), "pairs")
    counts = found.where("pair is not null").groupBy("pair").agg(F.sum("n_docs").alias("n"))
    n_b = sentencepiece.SentencePieceProcessor(model_proto=piece_model).get_piece_size()
    counts = staged(counts.withColumn("a", F.expr(f"pair div {n_b}")), "pair-counts")
    best = counts.groupBy("a").agg(F.max("n").alias("most"))  # at most a row for each id of A
    valued = counts.join(best, "a").select("pair", (F.col("n") * 2 + (F.col("n") == F.col("most")).cast("long")).alias("value"))
    ordered = staged(valued, "pair-values").repartitionByRange("pair").sortWithinPartitions("pair")
    parts = staged(ordered.mapInArrow(_write_counts(folder), "name string, first long, n long"), "count-files")
    parts = sorted(((r.name, r.first, r.n) for r in parts.toLocalIterator()), key=lambda p: p[1])
    blocks = found.where("block is not null").drop("pair", "n_docs")
    return blocks.repartition("block").mapInArrow(_statistics(folder, parts), DOC_DDL)
