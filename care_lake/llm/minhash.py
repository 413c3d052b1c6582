"""Near-duplicate documents by ProbMinHash over five-word shingles.

* Exact copies (equal words) collapse first; everything below sees one row per distinct text.
* Every shingle sends the arrivals of a Poisson process whose rate is its weight to random components of the
  signature. A component keeps its earliest arrival, so two texts agree in it with their probability Jaccard
  similarity. A shingle stops as soon as its next arrival is later than all components hold.
* Signatures are cut into bands. The members of a band bucket are compared with one of them (its hub); pairs that
  reach the similarity join their classes. Where a bucket still holds several classes, its members are compared in
  blocks, each pair of blocks in a task of its own, and only pairs of different classes that reach it come out.
  So a bucket of thousands of mutual copies costs a comparison per member, and no link between classes is lost:
  pairs of one class and pairs of sets too unlike in size are passed over, all others are counted exactly.
* Verification is exact: Jaccard similarity of the sets of distinct shingles.

Words are what white space separates, in lower case. Every distinct shingle has weight 1, so the similarity that
signatures estimate is the one that is verified, however often a text repeats a passage. Texts of one to four words
are one shingle.

Defined cases: null, empty and blank texts have no shingle; they are copies of each other and link with no other
text; repeated rows are copies of each other; a class's id is its smallest non-null doc_id; an empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_digest

from care_lake.llm.common import boxed, process_cache, row_key, slices, unboxed, with_vocabulary
from care_lake.llm.components import components
from care_lake.session import staged

GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers (the finalizer of SplitMix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _word_hashes(words: list[str]) -> list[bytes]:
    return [xxh64_digest(w.encode()) for w in words]


def shingles(words: list[str], of, width: int) -> np.ndarray:
    """64-bit hashes of all runs of ``width`` words, or of the whole text if it is shorter."""
    if not words:
        return np.empty(0, np.uint64)
    h = np.frombuffer(b"".join(map(of, words)), "<u8")
    width = min(width, len(h))
    out = np.zeros(len(h) - width + 1, np.uint64)
    for i in range(width):
        out = _mix(out ^ h[i:len(h) - width + 1 + i]) + GOLDEN
    return out


def signatures(owner: np.ndarray, element: np.ndarray, weight: np.ndarray, n: int, m: int) -> np.ndarray:
    """ProbMinHash signatures (n, m) of n weighted sets, given as rows (owner, element, weight), sorted by owner.

    All elements advance together, an arrival a round. An element leaves once its next arrival comes later than
    the latest of its owner's components; owners whose elements have all left cost nothing more.
    """
    time = np.full(n * m, np.inf)
    value = np.zeros(n * m, np.uint64)
    arrival = np.zeros(len(element))
    state = element.copy()
    live = np.arange(len(element))
    while len(live):
        state[live] = s = _mix(state[live] + GOLDEN)
        arrival[live] += -np.log(((s >> np.uint64(11)).astype(np.float64) + 0.5) / (1 << 53)) / weight[live]
        slot = owner[live] * m + (_mix(s ^ np.uint64(0xD6E8FEB86659FD93)) % np.uint64(m)).astype(np.int64)
        np.minimum.at(time, slot, arrival[live])
        first = arrival[live] == time[slot]
        value[slot[first]] = element[live[first]]
        owners = np.unique(owner[live])
        latest = np.zeros(n)
        latest[owners] = time.reshape(n, m)[owners].max(1)
        live = live[arrival[live] < latest[owner[live]]]
    return value.reshape(n, m)


def _words(text: str | None) -> list[str]:
    return (text or "").lower().split()


def _hash_of(texts: list[list[str]]):
    return with_vocabulary(process_cache("words"), set().union(*texts), _word_hashes).__getitem__


def _digest(words: list[str]) -> bytes:
    return blake2b(" ".join(words).encode(), digest_size=16).digest()


def _sketched(width: int, bands: int, rows: int):
    """Content key and band hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = bands * rows
        for batch in slices(batches, "text"):
            texts = [_words(t) for t in batch.column("text").to_pylist()]
            of, n = _hash_of(texts), len(texts)
            sets = [np.unique(shingles(w, of, width)) for w in texts]
            owner = np.repeat(np.arange(n), [len(e) for e in sets])
            signature = signatures(owner, np.concatenate(sets), np.ones(len(owner)), n, m)
            band = np.zeros((n, bands), np.uint64)
            for i in range(rows):
                band = _mix(band ^ signature.reshape(n, bands, rows)[:, :, i]) + GOLDEN
            lists = pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * bands, pa.int32()), pa.array(band.view(np.int64).ravel()))
            contents = pa.array(map(_digest, texts), pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("key"), contents, lists],
                                             names=["doc_id", "key", "content", "bands"])

    return run


def _shingle_sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            texts = [_words(t) for t in batch.column("text").to_pylist()]
            of = _hash_of(texts)
            sets = [np.unique(shingles(w, of, width)).astype("<u8").tobytes() for w in texts]
            yield pa.RecordBatch.from_arrays([batch.column("content"), pa.array(sets, pa.binary())], names=["content", "shingles"])

    return run


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Of two sorted sets without repeats."""
    if not len(a) or not len(b):
        return 0.0
    at = np.searchsorted(a, b)
    both = int((a[np.minimum(at, len(a) - 1)] == b).sum())
    return both / (len(a) + len(b) - both)


def _similar(threshold: float):
    def run(a: pa.Array, b: pa.Array) -> pa.Array:
        sets = [[np.frombuffer(x, "<u8") for x in c.to_pylist()] for c in (a, b)]
        return pa.array([jaccard(x, y) >= threshold for x, y in zip(*sets, strict=True)], pa.bool_())

    return F.arrow_udf(run, "boolean")


def _verified(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Those pairs (u, v) of content keys whose shingle sets are similar enough."""
    left = sets.select(F.col("content").alias("u"), F.col("shingles").alias("left_set"))
    right = sets.select(F.col("content").alias("v"), F.col("shingles").alias("right_set"))
    return pairs.join(left, "u").join(right, "v").where(_similar(threshold)("left_set", "right_set")).select("u", "v")


def _chunks(sets: list[np.ndarray], rows: np.ndarray, most: int = 1 << 20) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Rows in chunks of about ``most`` elements: the rows, their elements sorted, and each element's place in the rows."""
    ends = np.cumsum([len(sets[j]) for j in rows])
    for part in np.split(rows, np.flatnonzero(np.diff(ends // most)) + 1):
        if len(part):
            element = np.concatenate([sets[j] for j in part])
            order = np.argsort(element)
            yield part, element[order], np.repeat(np.arange(len(part), dtype=np.int32), [len(sets[j]) for j in part])[order]


def _between_blocks(threshold: float):
    """Links that join different classes among the members of two blocks of a bucket, or of one block.

    Exact: the elements that a set shares with all others are counted at once, by their places in sorted chunks.
    """

    def run(rows: pa.Table) -> pa.Table:
        content = rows.column("content").to_pylist()
        label = np.unique(np.array(rows.column("label").to_pylist(), object), return_inverse=True)[1]
        block, low, high = rows.column("block").to_numpy(), rows.column("low")[0].as_py(), rows.column("high")[0].as_py()
        sets = [np.frombuffer(x, "<u8") for x in rows.column("shingles").to_pylist()]
        size = np.array([len(x) for x in sets])
        first, found = np.flatnonzero(block == low), []
        for part, element, place in _chunks(sets, np.flatnonzero(block == high)):
            for i in first:
                # a smaller set than the threshold's share of the other one cannot reach it
                able = (label[part] != label[i]) & (np.minimum(size[part], size[i]) >= threshold * np.maximum(size[part], size[i]) - 1e-6)
                if low == high:
                    able &= part > i
                if not able.any():
                    continue
                start, end = np.searchsorted(element, sets[i]), np.searchsorted(element, sets[i], "right")
                n = end - start
                at = np.repeat(start - (np.cumsum(n) - n), n) + np.arange(n.sum())
                both = np.bincount(place[at], minlength=len(part))
                for j in part[able & (both > 0) & (both / np.maximum(size[part] + size[i] - both, 1) >= threshold)]:
                    if label[i] != label[j]:
                        label[label == label[j]] = label[i]
                        found.append((content[i], content[j]))
        return pa.table({"u": pa.array([p[0] for p in found], pa.binary()), "v": pa.array([p[1] for p in found], pa.binary())})

    return run


def _blocked(members: DataFrame, labels: DataFrame, block: int) -> DataFrame:
    """Members of buckets that still hold several classes, once for each pair of blocks they belong to."""
    rows = members.join(labels.withColumnRenamed("node", "content"), "content", "left").withColumn("label", F.coalesce("label", "content"))
    bucket = rows.groupBy("band", "value").agg(
        F.count("*").alias("n"), F.min("label").alias("least"), F.max("label").alias("most"),
        F.bit_xor(F.xxhash64("content")).alias("x"), F.bit_xor(F.xxhash64(F.lit(1), "content")).alias("y"))
    open_ = bucket.where("n > 2 and least < most")  # in a bucket of two, the hub has met the other
    open_ = open_.groupBy("n", "x", "y").agg(F.min(F.struct("band", "value")).alias("b"))  # buckets of the same members count once
    open_ = open_.select("b.band", "b.value", F.expr(f"(n + {block - 1}) div {block}").alias("blocks"))
    rows = rows.join(open_, ["band", "value"]).withColumn("block", F.expr("pmod(xxhash64(2, content), blocks)"))
    rows = rows.select("band", "value", "content", "label", "block", F.explode(F.expr("sequence(0L, blocks - 1)")).alias("other"))
    return rows.select("band", "value", "content", "label", "block", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, threshold: float = 0.8,
                    bands: int = 20, rows: int = 4, block: int = 512) -> DataFrame:
    """Class of every document: ``doc_id, key, class_id, class_size, kept``.

    ``key`` is the row's key (:func:`care_lake.llm.common.row_key`); ``kept`` marks the row with the smallest id of
    its class. Rows repeated with the same id and text have the same key. With 20 bands of 4 rows a pair at 0.8
    shares no bucket with a probability of 3e-5, at 0.9 of 9e-10.
    """
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), row_key(F.col(id_col), F.col(text_col)).alias("key"))
    base = staged(source.mapInArrow(_sketched(width, bands, rows), "doc_id long, key binary, content binary, bands array<long>"), "sketches")
    texts = staged(base.groupBy("content").agg(F.min("key").alias("key"), F.min("bands").alias("bands")), "distinct")
    banded = texts.select("content", F.posexplode("bands").alias("band", "value"))
    hubs = banded.groupBy("band", "value").agg(F.count("*").alias("n"), F.min("content").alias("hub")).where("n > 1").drop("n")
    members = staged(banded.join(hubs, ["band", "value"]), "bucket-members")
    pairs = members.where("content != hub").select(F.col("content").alias("u"), F.col("hub").alias("v")).distinct()
    involved = texts.drop("bands").join(members.select("content").distinct(), "content", "left_semi")
    found = source.select("key", "text").join(involved, "key").dropDuplicates(["content"])
    sets = staged(found.select("content", "text").mapInArrow(_shingle_sets(width), "content binary, shingles binary"), "shingles")
    links = staged(_verified(pairs, sets, threshold), "links")
    labels = components(links)
    blocks = _blocked(members, labels, block).join(sets, "content")
    more = staged(blocks.groupBy("band", "value", "low", "high").applyInArrow(_between_blocks(threshold), "u binary, v binary"), "links-between")
    if not more.isEmpty():
        labels = components(links.unionByName(more))
    nodes = base.select("doc_id", "key", F.col("content").alias("node"))
    nodes = nodes.join(labels, "node", "left").withColumn("class", F.coalesce("label", "node"))
    least = nodes.groupBy("class").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")).alias("first"), F.count("*").alias("class_size"))
    both = nodes.join(staged(least, "classes"), "class")  # written, so that a large class can be split in this join
    return both.select("doc_id", "key", F.col("first.doc_id").alias("class_id"), "class_size", (F.col("key") == F.col("first.key")).alias("kept"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One document of each class, all columns unchanged; of repeated rows one stays."""
    kept = near_duplicates(docs, id_col, text_col, **options).where("kept").select("key").distinct()
    own = boxed(docs, key=row_key(F.col(id_col), F.col(text_col)))
    return unboxed(own.join(kept, "key").dropDuplicates(["key"]))
