"""Secret scan with a randomness test battery, in DataFrame functions only.

Fixed patterns find assignments, access keys and long hex strings. Further stretches of 20 or more characters that
mix letters and digits are candidates: the encoding is inferred (hex, base 32, 36, 62 or 64), the characters become
numbers in its alphabet, and three tests ask whether they look uniformly random:

* chi-squared test of the counts against equal use of the alphabet (Wilson-Hilferty),
* runs above and below the middle of the alphabet,
* serial correlation of neighbours.

Fisher's method combines them into one p-value. Random strings have p-values spread evenly over 0 to 1, text has
small ones, and how small depends on the length. So, for each encoding and length class over the whole table, the
even part is estimated from the p-values above one half; the class accepts the lowest p-value at which the
estimated share of others among the accepted stays within ``fdr``. The estimate leans to the high side, by one
standard error and a few strings if the neighbouring length classes are random, so that a few random strings are not
lost beside many others. The histogram has ``BINS`` equal bins, the first of them halved ``HALVINGS`` times towards 0,
and so at most ``5 * 8 * (BINS + HALVINGS)`` rows, whatever the size of the table.

Defined cases: a null text is empty and has no spans; rows are never joined, so repeated rows and null ids simply
repeat; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from care_lake.session import staged

# The patterns of the contract.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"  # a run of fewer characters holds no longer one
HEX = r"[0-9a-f]{32,}"

CANDIDATE = r"[A-Za-z0-9+/_-]{20,}"
DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ALPHABETS = {
    "hex": ("^([0-9a-f]+|[0-9A-F]+)$", DIGITS + "abcdef"),
    "base32": ("^[A-Z2-7]+$", UPPER + "234567"),
    "base36": ("^([0-9a-z]+|[0-9A-Z]+)$", DIGITS + LOWER),
    "base62": ("^[0-9A-Za-z]+$", DIGITS + UPPER + LOWER),
    "base64": (".", UPPER + LOWER + DIGITS + "+/"),
}
KINDS = ("assign", "access", "hex", "random")
BINS = 20
SCAN_BLOCK = 256  # items of a block of running results
HALVINGS = 40  # bins below 0.5 / BINS, numbered -1, -2, ... towards 0


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with the value computed once however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def scan(items: Column, zero: int, combine: Callable[[Column, Column], Column]) -> Column:
    """Running result of an associative ``combine`` after each item.

    A fold copies what it holds at every step, so blocks are folded on their own and then meet the result of the blocks before them.
    """
    def running(block: Column) -> Column:
        first = F.array(F.lit(zero))
        return F.aggregate(block, first, lambda held, x: F.array_append(held, combine(F.element_at(held, -1), x)))

    def joined(inner: Column) -> Column:
        before = F.slice(running(F.transform(inner, lambda block: F.element_at(block, -1))), F.lit(1), F.size(inner))
        return F.flatten(F.zip_with(inner, before, lambda block, held: F.transform(F.slice(block, F.lit(2), F.size(block) - 1), lambda x: combine(held, x))))

    def blocks(all_items: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size(all_items), F.lit(1)), F.lit(SCAN_BLOCK))
        return F.transform(starts, lambda i: running(F.slice(all_items, i, F.lit(SCAN_BLOCK))))

    return bound(items, lambda own: bound(blocks(own), joined))


def located(found: Column, parts: Column) -> Column:
    """``start`` and ``end`` in code points of every match, from the matches and the text between them."""
    steps = F.zip_with(found, F.slice(parts, F.lit(1), F.size(found)), lambda value, gap: F.length(gap) + F.length(value))
    ends = scan(steps, 0, lambda a, b: a + b)

    def one(end: Column, value: Column) -> Column:
        return F.struct((end - F.length(value)).alias("start"), end.alias("end"), value.alias("value"))

    return F.zip_with(ends, found, one)


def outside(spans: Column, known: Column) -> Column:
    """The spans that meet none of the known ones, in order: both lists are merged and read once in each direction."""
    def event(of: Column, is_known: bool) -> Column:
        return F.transform(of, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lit(is_known).alias("known"), s["value"].alias("value")))

    def kept(events: Column) -> Column:
        ended = scan(F.transform(events, lambda e: F.when(e["known"], e["end"]).otherwise(0)), 0, F.greatest)
        started = F.transform(F.reverse(events), lambda e: F.when(e["known"], e["start"]).otherwise(2**31 - 1))
        begins = F.reverse(scan(started, 2**31 - 1, F.least))
        free = F.zip_with(ended, begins, lambda a, b: F.struct(a.alias("from"), b.alias("to")))
        both = F.zip_with(events, free, lambda e, f: F.struct(e.alias("e"), (~e["known"] & (f["from"] <= e["start"]) & (e["end"] <= f["to"])).alias("free")))
        return F.transform(F.filter(both, lambda x: x["free"]), lambda x: F.struct(*[x["e"][c].alias(c) for c in ("start", "end", "value")]))

    merged = F.array_sort(F.concat(event(spans, False), event(known, True)))
    return F.when((F.size(spans) == 0) | (F.size(known) == 0), spans).otherwise(bound(merged, kept))


def _matches(df: DataFrame, name: str, pattern: str) -> DataFrame:
    df = df.withColumn("found", F.regexp_extract_all("text", F.lit(pattern), F.lit(0)))
    df = df.withColumn("parts", F.when(F.size("found") > 0, F.split("text", pattern, -1)))
    spans = F.when(F.size("found") > 0, located(F.col("found"), F.col("parts")))
    empty = F.expr("cast(array() as array<struct<start: int, end: int, value: string>>)")
    return df.withColumn(name, F.coalesce(spans, empty)).drop("found", "parts")


def two_sided(z: Column) -> Column:
    """Chance of a standard normal value at least as far from 0 (polynomial of Abramowitz and Stegun 7.1.26)."""

    def poly(t: Column) -> Column:
        return t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429))))

    tail = bound(F.abs(z) / math.sqrt(2), lambda x: bound(1 / (1 + 0.3275911 * x), poly) * F.exp(-x * x))
    return F.greatest(tail, F.lit(1e-12))


def upper_tail(z: Column) -> Column:
    return bound(z, lambda x: F.when(x >= 0, two_sided(x) / 2).otherwise(1 - two_sided(x) / 2))


def _encoding(value: Column) -> Column:
    out = F.lit("base64")
    for name in ("base62", "base36", "base32", "hex"):
        out = F.when(value.rlike(ALPHABETS[name][0]), F.lit(name)).otherwise(out)
    return out


def _numbers(value: Column, encoding: Column) -> Column:
    """Characters as numbers in the alphabet, from 0."""
    folded = F.when(encoding.isin("hex", "base36"), F.lower(value)).otherwise(F.translate(value, "-_", "+/"))
    alphabet = F.lit(ALPHABETS["base64"][1])
    for name, (_, letters) in ALPHABETS.items():
        alphabet = F.when(encoding == name, F.lit(letters)).otherwise(alphabet)
    return F.transform(F.split(folded, ""), lambda c: F.instr(alphabet, c) - 1)


def chi_squared_p(numbers: Column, k: Column) -> Column:
    n = F.size(numbers)
    squares = F.aggregate(F.array_distinct(numbers), F.lit(0.0), lambda a, v: a + F.pow(F.size(F.filter(numbers, lambda x: x == v)), F.lit(2)))
    ratio = (k / n * squares - n) / (k - 1)
    width = 2 / (9 * (k - 1))
    return upper_tail((F.pow(F.greatest(ratio, F.lit(0.0)), F.lit(1 / 3)) - (1 - width)) / F.sqrt(width))


def runs_p(numbers: Column, k: Column) -> Column:
    n = F.size(numbers)

    def changes(high: Column) -> Column:
        differ = F.zip_with(F.slice(high, F.lit(1), n - 1), F.slice(high, F.lit(2), n - 1), lambda a, b: (a != b).cast("int"))
        return F.aggregate(differ, F.lit(0), lambda a, x: a + x)

    return two_sided((2 * bound(F.transform(numbers, lambda v: (2 * v >= k).cast("int")), changes) - (n - 1)) / F.sqrt(n - 1))


def serial_p(numbers: Column, k: Column) -> Column:
    n = F.size(numbers)

    def products(unit: Column) -> Column:
        pairs = F.zip_with(F.slice(unit, F.lit(1), n - 1), F.slice(unit, F.lit(2), n - 1), lambda a, b: a * b)
        return F.aggregate(pairs, F.lit(0.0), lambda a, x: a + x)

    unit = F.transform(numbers, lambda v: (v - (k - 1) / 2) / F.sqrt((k * k - 1) / 12))
    return two_sided(bound(unit, products) / F.sqrt(n - 1))


def battery_p(numbers: Column, k: Column) -> Column:
    """Fisher's combination of the three tests."""
    h = -(F.log(F.greatest(chi_squared_p(numbers, k), F.lit(1e-12))) + F.log(runs_p(numbers, k)) + F.log(serial_p(numbers, k)))
    return bound(h, lambda x: F.exp(-x) * (1 + x + x * x / 2))


def _tested(span: Column) -> Column:
    value = span["value"]
    sizes = F.create_map(*[F.lit(x) for name, (_, letters) in ALPHABETS.items() for x in (name, float(len(letters)))])
    length_class = F.least(F.floor(F.log2(F.length(value))), F.lit(11))

    def row(encoding: Column) -> Column:
        p = bound(_numbers(value, encoding), lambda numbers: battery_p(numbers, F.element_at(sizes, encoding)))
        name = F.concat_ws("-", encoding, length_class.cast("string"))
        return F.struct(span["start"].alias("start"), span["end"].alias("end"), name.alias("class"), p.alias("p"))

    return bound(_encoding(value), row)


def _without_values(spans: Column) -> Column:
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))


def bin_of(p: Column) -> Column:
    """Number of the bin of a p-value."""
    halved = F.floor(F.log2(F.lit(1 / BINS) / F.greatest(p, F.lit(1e-300))))
    return F.when(p < 1 / BINS, -F.least(halved, F.lit(HALVINGS))).otherwise(F.least(F.floor(p * BINS), F.lit(BINS - 1))).cast("int")


def lower_edge(i: int) -> float:
    """Least p-value of a bin."""
    return i / BINS if i > 0 else 0.0 if i == -HALVINGS else 2.0 ** (i - 1) / BINS


def accepted_from(histogram: list[tuple[str, int, int]], fdr: float) -> dict[str, float]:
    """Lowest accepted p-value of each class, from (class, bin, count)."""
    counts: dict[str, Counter] = defaultdict(Counter)
    for name, i, n in histogram:
        counts[name][i] += n
    high = {name: sum(n for i, n in own.items() if i >= BINS // 2) for name, own in counts.items()}
    out = {}
    for name, own in counts.items():
        encoding, _, length = name.rpartition("-")
        beside = [f"{encoding}-{int(length) + d}" for d in (-1, 1)] if length.isdigit() else []
        beside = [x for x in beside if x in counts]
        pooled = sum(counts[x].total() for x in beside)
        random = min(1.0, 2 * sum(high[x] for x in beside) / pooled) if pooled else 0.0
        even = 2 * high[name] + max(1.0, 4 * random)
        even = min(own.total(), even + math.sqrt(even))
        taken = own.total()
        for i in range(-HALVINGS, BINS // 2 + 1):
            if taken and 1 - min(1.0, even * (1 - lower_edge(i)) / taken) <= fdr:
                out[name] = lower_edge(i)
                break
            taken -= own[i]
    return out


def find_secrets(docs: DataFrame, text_col: str = "text", carry: tuple[str, ...] = ("doc_id",), fdr: float = 0.05) -> DataFrame:
    """The columns in ``carry`` and ``spans``: an array of (start, kind, end), sorted, without the secrets themselves.

    ``kind`` numbers :data:`KINDS`. Random stretches that meet a span of a fixed pattern are left out.
    """
    df = docs.select(F.struct(*[F.col(c) for c in carry]).alias("carried"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    for name, pattern in (("assign", ASSIGN), ("access", ACCESS), ("hex", HEX), ("random", CANDIDATE)):
        df = _matches(df, name, pattern)
    long_enough = F.filter("assign", lambda s: F.length(F.regexp_extract(s["value"], ASSIGN, 1)) >= 8)
    df = df.withColumn("assign", long_enough).drop("text")
    known = F.concat("assign", "access", "hex")
    mixed = F.filter("random", lambda s: s["value"].rlike("[0-9]") & s["value"].rlike("[A-Za-z]"))
    df = df.withColumn("mixed", mixed).withColumn("known", known).withColumn("random", outside(F.col("mixed"), F.col("known")))
    df = df.select("carried", *[_without_values(F.col(c)).alias(c) for c in KINDS[:3]], F.transform("random", _tested).alias("random"))
    found = staged(df, "secrets")
    bins = found.select(F.explode("random").alias("r")).select("r.class", bin_of(F.col("r.p")).alias("bin"))
    accepted = accepted_from([tuple(r) for r in bins.groupBy("class", "bin").count().collect()], fdr)
    least = F.create_map(*[F.lit(x) for pair in (accepted or {"": 2.0}).items() for x in pair])
    random = F.filter("random", lambda s: s["p"] >= F.coalesce(F.element_at(least, s["class"]), F.lit(2.0)))

    def of(spans: Column, kind: int) -> Column:
        return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(kind).alias("kind"), s["end"].alias("end")))

    spans = F.array_sort(F.concat(*[of(F.col(c), i) for i, c in enumerate(KINDS[:3])], of(random, 3)))
    return found.select(*[F.col("carried")[c].alias(c) for c in carry], spans.alias("spans"))


def span_text(spans: Column, kinds: tuple[str, ...]) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    names = F.array(*[F.lit(k) for k in kinds])
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))))


def span_digest(found: DataFrame, kinds: tuple[str, ...], base: int) -> DataFrame:
    """Counts and text of spans; the first ``base`` kinds make the digest."""
    own = F.filter("spans", lambda s: s["kind"] < base)

    def count(kind: int) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kinds[kind]}")

    counts = [count(i) for i in range(len(kinds))]
    return found.select("doc_id", *counts, F.sha2(span_text(own, kinds), 256).alias("base_sha256"), span_text(F.col("spans"), kinds).alias("spans"))
