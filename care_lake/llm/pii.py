"""Personal data: fixed patterns, and terms that give it away (information-theoretic sanitisation).

Emails, IP addresses, card and phone numbers are the protected entities. The words near their occurrences are
candidate terms. Over the whole corpus, n(e), n(t) and n(e, t) count the documents with the entity, with the term,
and with the term near the entity. The term reveals PMI = log2(n(e,t) N / (n(e) n(t))) bits about an entity of
IC = log2(N / n(e)) bits. It discloses the entity when PMI >= IC / alpha, at least ``support`` documents show the
pair, and chance would not: for a term spread over the documents without regard to the entity, a share of
n(e, t) / n(t) or more near it has a probability of at most ``chance`` (Chernoff's bound). In the documents that hold
the entity, such a term is removed if it reveals all of IC, else generalised to its initial.

n(t) is needed for candidate terms only. A bitmap of fixed size lets each task count the words that may be
candidates, a join with the candidates then removes chance hits; nothing the size of the corpus' vocabulary moves.

Defined cases: null and empty texts have no spans; repeated rows count as documents each and get equal spans; a
null id is an id like any other; documents without entity are never changed; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from care_lake.llm.common import boxed, process_cache, row_key, slices, unboxed, with_vocabulary
from care_lake.session import staged

KINDS = ("email", "ip", "card", "phone", "term")

# Parts of the patterns of the contract. Each is walked so that long runs cost linear time.
LOCAL_SET = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
WORD = re.compile(r"[^\W\d_]{3,}")
DIGIT = re.compile(r"[0-9]")

BITS = 1 << 23


def emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL_SET:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
            done = found.end()
        at = text.find("@", max(at + 1, done))


def ips(text: str) -> Iterator[tuple[int, int]]:
    for run in DOTTED.finditer(text):
        parts = run[0].split(".")
        start = run.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i:i + 4]
            end = start + sum(map(len, four)) + 3
            if all(len(x) < 4 and int(x) <= 255 or len(x.lstrip("0")) < 4 and int(x.lstrip("0") or 0) <= 255 for x in four):
                yield start, end
            start = end + 1


def luhn(digits: str) -> bool:
    own = [int(d) for d in reversed(digits)]
    return sum(own[::2] + [2 * d - 9 * (d > 4) for d in own[1::2]]) % 10 == 0


def cards(text: str) -> Iterator[tuple[int, int]]:
    for run in CARD.finditer(text):
        if 14 <= run.end() - run.start() <= 37 and 14 <= len(digits := "".join(DIGIT.findall(run[0]))) <= 19 and luhn(digits):
            yield run.span()


def phones(text: str) -> Iterator[tuple[int, int]]:
    for run in PHONE.finditer(text):
        if 10 <= len(DIGIT.findall(run[0])) <= 15:
            yield run.span()


def entities(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end), sorted."""
    out = []
    if "@" in text:
        out += [(a, 0, b) for a, b in emails(text)]
    if DIGIT.search(text):
        out += [(a, 1, b) for a, b in ips(text)] + [(a, 2, b) for a, b in cards(text)]
    if "+" in text:
        out += [(a, 3, b) for a, b in phones(text)]
    return sorted(out)


def entity_name(text: str, span: tuple[int, int, int]) -> str:
    value = text[span[0]:span[2]].lower()
    return f"{span[1]}:" + ("".join(DIGIT.findall(value)) if span[1] > 1 else value)


def free_words(text: str, spans: list[tuple[int, int, int]]) -> tuple[list[int], list[int], list[str]]:
    """Starts, ends and lower case of the words outside all spans."""
    taken: list[list[int]] = []
    for start, _, end in spans:
        if taken and start <= taken[-1][1]:
            taken[-1][1] = max(taken[-1][1], end)
        else:
            taken.append([start, end])
    starts, ends, words, at = [], [], [], 0
    for m in WORD.finditer(text):
        while at < len(taken) and taken[at][1] <= m.start():
            at += 1
        if at == len(taken) or taken[at][0] >= m.end():
            starts.append(m.start())
            ends.append(m.end())
            words.append(m[0].lower())
    return starts, ends, words


def near_terms(text: str, spans: list[tuple[int, int, int]], i: int, window: int, free: tuple | None = None) -> set[str]:
    """The ``window`` words before and after a span that are outside all spans, however far; ``free`` as of free_words."""
    starts, ends, words = free or free_words(text, spans)
    before, after = bisect_right(ends, spans[i][0]), bisect_left(starts, spans[i][2])
    return {*words[max(0, before - window):before], *words[after:after + window]}


def _found(window: int):
    """Spans of each row, and its entities with the terms near them."""
    spans_type = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())]))
    near_type = pa.list_(pa.struct([("entity", pa.string()), ("terms", pa.list_(pa.string()))]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            spans, near = [], []
            for text in batch.column("text").to_pylist():
                own = entities(text or "")
                terms: dict[str, set] = {}
                free = free_words(text, own) if own else None
                for i, s in enumerate(own):
                    terms.setdefault(entity_name(text, s), set()).update(near_terms(text, own, i, window, free))
                spans.append([{"start": a, "kind": k, "end": b} for a, k, b in own])
                near.append([{"entity": e, "terms": sorted(t)} for e, t in terms.items()])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("key"), pa.array(spans, spans_type), pa.array(near, near_type)],
                                             names=["doc_id", "key", "spans", "near"])

    return run


def _bitmap(terms: DataFrame) -> bytes:
    """A bit for each hash of a term; the size is fixed, whatever the number of terms."""
    bit = terms.select((F.crc32(F.encode("term", "utf-8")) % BITS).alias("bit"))
    words = bit.groupBy(F.expr("bit div 32").alias("word")).agg(F.expr("bit_or(shiftleft(1L, cast(bit % 32 as int)))").alias("bits")).toPandas()
    out = np.zeros(BITS // 32, np.uint32)
    out[words["word"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64).astype(np.uint32)
    return out.tobytes()


def _counted(bitmap: bytes):
    """Documents of a task that hold each word that may be a candidate."""
    bits = np.frombuffer(bitmap, np.uint32)

    def maybe(words: list[str]) -> list[bool]:
        h = np.array([crc32(w.encode()) for w in words], np.int64) % BITS
        return ((bits[h // 32] >> (h % 32).astype(np.uint32)) & 1).astype(bool).tolist()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = process_cache("pii", bitmap)
        counts: Counter = Counter()
        for batch in slices(batches, "text"):
            words = [set(WORD.findall((t or "").lower())) for t in batch.column("text").to_pylist()]
            of = with_vocabulary(cache, set().union(*words), maybe)
            for own in words:
                counts.update([w for w in own if of[w]])
            if len(counts) > 100_000:
                yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["term", "n"])
                counts.clear()
        if counts:
            yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["term", "n"])

    return run


def disclosing(found: DataFrame, texts: DataFrame, alpha: float, support: int, chance: float) -> DataFrame:
    """``entity, term, total`` of the terms that disclose an entity; ``total`` says whether they reveal all of it."""
    near = found.where(F.size("near") > 0).select(F.explode("near").alias("near")).select("near.entity", "near.terms")
    n = found.count()
    entity = near.groupBy("entity").agg(F.count("*").alias("n_entity")).where(F.col("n_entity") >= support)
    pairs = near.select("entity", F.explode("terms").alias("term")).groupBy("entity", "term").agg(F.count("*").alias("n_both"))
    pairs = staged(pairs.where(F.col("n_both") >= support).join(entity, "entity"), "term-pairs")
    terms = pairs.select("term").distinct()
    counted = texts.mapInArrow(_counted(_bitmap(terms)), "term string, n long").groupBy("term").agg(F.sum("n").alias("n_term"))
    known = F.log2(F.lit(float(n)) / F.col("n_entity"))
    share, expected = F.least(F.lit(1.0), F.col("n_both") / F.col("n_term")), F.col("n_entity") / F.lit(float(n))
    revealed = known + F.log2(share)
    elsewhere = F.when(share < 1, (1 - share) * F.log2((1 - share) / F.greatest(1 - expected, F.lit(1e-12)))).otherwise(0.0)
    evidence = F.col("n_term") * (share * revealed + elsewhere)  # bits against chance
    both = pairs.join(counted, "term").where((revealed >= known / alpha) & (evidence >= -math.log2(chance)))
    return both.select("entity", "term", (revealed >= known).alias("total"))


def _term_spans(text: pa.Array, spans: pa.Array, terms: pa.Array) -> pa.Array:
    kind = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())]))
    out = []
    for t, own, wanted in zip(text.to_pylist(), spans.to_pylist(), terms.to_pylist(), strict=True):
        if not wanted:
            out.append([])
            continue
        wanted, taken, at, found = set(wanted), [(s["start"], s["end"]) for s in own], 0, []
        for m in WORD.finditer(t):
            if m[0].lower() in wanted:
                while at < len(taken) and taken[at][1] <= m.start():
                    at += 1
                if at == len(taken) or taken[at][0] >= m.end():
                    found.append({"start": m.start(), "kind": 4, "end": m.end()})
        out.append(found)
    return pa.array(out, kind)


def personal_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 8, alpha: float = 1.1,
                   support: int = 2, chance: float = 0.01) -> DataFrame:
    """``doc_id, key, spans, removed`` of every row: spans of (start, kind, end), sorted; ``removed`` lists the terms to
    remove whole, the other terms are to be generalised. Spans of a term never meet those of an entity.
    """
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), row_key(F.col(id_col), F.col(text_col)).alias("key"))
    kind = source.schema["doc_id"].dataType.simpleString()
    span = "array<struct<start: int, kind: int, end: int>>"
    found = staged(source.mapInArrow(_found(window), f"doc_id {kind}, key binary, spans {span}, near array<struct<entity: string, terms: array<string>>>"), "entities")
    told = staged(disclosing(found, source.select("text"), alpha, support, chance), "disclosing")
    holders = found.where(F.size("near") > 0).dropDuplicates(["key"]).select("key", "spans", F.explode("near.entity").alias("entity"))
    holders = holders.join(told, "entity").groupBy("key").agg(
        F.collect_set("term").alias("terms"), F.collect_set(F.when(F.col("total"), F.col("term"))).alias("removed"), F.first("spans").alias("spans"))
    texts = source.select("key", "text").join(holders, "key").dropDuplicates(["key"])
    more = texts.select("key", F.arrow_udf(_term_spans, span)("text", "spans", "terms").alias("more"), "removed")
    both = found.select("doc_id", "key", "spans").join(more, "key", "left")
    spans = F.when(F.col("more").isNull(), F.col("spans")).otherwise(F.array_sort(F.concat("spans", "more")))
    return both.select("doc_id", "key", spans.alias("spans"), "removed")


def _sanitised(text: pa.Array, spans: pa.Array, removed: pa.Array) -> pa.Array:
    out = []
    for t, own, gone in zip(text.to_pylist(), spans.to_pylist(), removed.to_pylist(), strict=True):
        if t is None:
            out.append(None)
            continue
        gone, pieces, done = set(gone or ()), [], 0
        for s in own:
            if s["start"] < done:
                if s["end"] > done:  # two entities that overlap: the second one's rest goes as well
                    done = s["end"]
                continue
            value = t[s["start"]:s["end"]]
            as_term = "" if value.lower() in gone else value[0] + "*"
            pieces += [t[done:s["start"]], as_term if s["kind"] == 4 else f"[{KINDS[s['kind']].upper()}]"]
            done = s["end"]
        out.append("".join(pieces) + t[done:])
    return pa.array(out, pa.string())


def sanitise(docs: DataFrame, spans: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with entities replaced by their kind and disclosing terms generalised or removed."""
    changes = spans.where(F.size("spans") > 0).select("key", "spans", "removed").dropDuplicates(["key"])
    own = boxed(docs, text=F.col(text_col), key=row_key(F.col(id_col), F.col(text_col))).join(changes, "key", "left")
    changed: Column = F.arrow_udf(_sanitised, "string")(F.when(F.col("spans").isNotNull(), F.col("text")), F.col("spans"), F.col("removed"))
    return unboxed(own, **{text_col: F.coalesce(changed, F.col("text"))})
