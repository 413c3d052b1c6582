"""Toxicity classifier with a counterfactual penalty.

Features are the words of a text and their beginnings. A logistic model is fitted on a bounded sample of labelled
rows; the features are those whose share differs most between the labels. In the sentences of the sample, every
identity term is swapped for the other terms of its group. The score of a sentence and of its swapped twin should
not differ, so the squared difference of their scores is part of the loss, weighted by how often the swap occurs.
That pulls the weights of a group's terms together, whatever the labels of the texts that mention them.

Defined cases: null and empty texts have no feature and get the score of the intercept; without labelled rows every
score is 0; with one label only the score is that label's; labelled ids that occur more than once are fitted once a
row; labels that are null or belong to no document are ignored; rows with a null id are scored and never held out.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from care_lake.llm.common import ROW, boxed, process_cache, slices, unboxed, with_vocabulary
from care_lake.session import staged

# Identity terms by group, in the languages of the corpus.
IDENTITY = (
    ("woman", "man", "girl", "boy", "frau", "mann", "femme", "homme", "mujer", "hombre"),
    ("women", "men", "girls", "boys", "frauen", "männer", "femmes", "hommes", "mujeres", "hombres"),
    ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist", "sikh"),
    ("christians", "muslims", "jews", "hindus", "buddhists", "atheists", "sikhs"),
    ("black", "white", "asian", "african", "european", "latino", "arab", "native"),
    ("gay", "straight", "lesbian", "bisexual", "transgender", "queer"),
    ("young", "old", "elderly", "teenage"),
    ("blind", "deaf", "disabled", "autistic"),
    ("immigrant", "refugee", "foreigner", "citizen", "local"),
)
WORD = re.compile(r"[^\W_]+")
SENTENCE = re.compile(r"[.!?\n]+")
BEGINNINGS = (4, 5, 6)


def held_out(doc_id: Column) -> Column:
    """Rows that labels must not be learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def features(word: str) -> list[int]:
    """The word and its beginnings, as 32-bit hashes."""
    return [crc32(word.encode())] + [crc32(f"{word[:n]}*".encode()) for n in BEGINNINGS if len(word) >= n]


def swaps(text: str, groups: tuple[tuple[str, ...], ...]) -> dict[tuple[str, str], int]:
    """How often each identity term is swapped for each other term of its group, once a sentence."""
    group_of = {t: g for g in groups for t in g}
    out: dict[tuple[str, str], int] = {}
    for sentence in SENTENCE.split(text.lower()):
        for term in set(WORD.findall(sentence)) & group_of.keys():
            for other in group_of[term]:
                if other != term:
                    out[term, other] = out.get((term, other), 0) + 1
    return out


@dataclass
class Model:
    """Weights by feature. Scores need nothing else."""

    weights: dict[int, float] = field(default_factory=dict)
    intercept: float = -np.inf

    def score(self, hits: set[int]) -> float:
        z = self.intercept + sum(self.weights[h] for h in hits)
        return float(z > 0) if np.isinf(z) else float(1 / (1 + np.exp(-np.clip(z, -700, 700))))


def fitted(rows: list[list[int]], y: np.ndarray, pairs: list[tuple[list[int], list[int], float]], n: int,
           l2: float = 1e-5, fairness: float = 10.0, rounds: int = 300, rate: float = 0.1) -> tuple[np.ndarray, float]:
    """Weights and intercept of a logistic model over ``n`` binary features (Adam on all rows).

    ``pairs`` are swaps: features that go, features that come, and how often per row.
    """
    at = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    feature = np.fromiter((f for r in rows for f in r), np.int64, len(at))
    swap = np.zeros((len(pairs), n))
    for i, (go, come, _) in enumerate(pairs):
        swap[i, go] += 1
        swap[i, come] -= 1
    often = np.array([p[2] for p in pairs])
    w = np.zeros(n + 1)
    share = y.mean()
    w[n] = np.log(share / (1 - share))
    mean, square = np.zeros(n + 1), np.zeros(n + 1)
    for step in range(1, rounds + 1):
        z = np.bincount(at, w[feature], len(rows)) + w[n]
        error = (1 / (1 + np.exp(-np.clip(z, -60, 60))) - y) / len(rows)
        gradient = np.append(np.bincount(feature, error[at], n) + l2 * w[:n], error.sum())
        if len(pairs):
            gradient[:n] += 2 * fairness * (often * (swap @ w[:n])) @ swap
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.999 * square + 0.001 * gradient**2
        w -= rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    return w[:n], float(w[n])


def _sample_features(groups: tuple[tuple[str, ...], ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            found = [sorted({f for w in set(WORD.findall(t.lower())) for f in features(w)}) for t in texts]
            swapped = [[f"{a} {b} {n}" for (a, b), n in sorted(swaps(t, groups).items())] for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array(found, pa.list_(pa.int64())), pa.array(swapped, pa.list_(pa.string()))],
                                             names=["toxic", "found", "swapped"])

    return run


def _restricted(chosen: dict[int, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hits = [[chosen[f] for f in found if f in chosen] for found in batch.column("found").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array(hits, pa.list_(pa.int32()))], names=["toxic", "hits"])

    return run


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          sample: int = 20_000, most_features: int = 8_192, least_z: float = 2.0, groups: tuple[tuple[str, ...], ...] = IDENTITY, **fit) -> Model:
    """Fit on at most ``sample`` labelled rows, the first by a hash of the id, none of them held out.

    A feature takes part if its log odds between the labels are ``least_z`` standard errors from 0 or more.

    The driver sees the counts of at most ``most_features`` features and, per sampled row, which of them occur.
    """
    known = labels.select(F.col(id_col).alias("label_id"), F.col(label_col).cast("int").alias("toxic"))
    known = known.where(F.col("label_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("label_id")))
    known = known.dropDuplicates(["label_id"]).orderBy(F.xxhash64("label_id"), "label_id").limit(sample)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).join(F.broadcast(known), F.col("doc_id") == F.col("label_id"))
    held = staged(rows.select("text", "toxic").mapInArrow(_sample_features(groups), "toxic int, found array<long>, swapped array<string>"), "toxicity-sample")
    sums = held.agg(F.count("*").alias("n"), F.sum("toxic").alias("toxic")).first()
    if not sums["n"] or sums["toxic"] in (0, sums["n"]):
        return Model({}, np.inf if sums["n"] and sums["toxic"] else -np.inf)
    toxic, clean = sums["toxic"], sums["n"] - sums["toxic"]
    counts = held.select("toxic", F.explode("found").alias("f")).groupBy("f").agg(F.count("*").alias("n"), F.sum("toxic").alias("t"))
    a, b = (F.col("t") + 0.5) / (toxic + 1), (F.col("n") - F.col("t") + 0.5) / (clean + 1)
    spread = F.sqrt(1 / (F.col("t") + 0.5) + 1 / (F.col("n") - F.col("t") + 0.5))
    best = counts.where("n > 2").select("f", F.abs(F.log(a / b) / spread).alias("z")).where(F.col("z") >= least_z).orderBy(F.desc("z"), "f").limit(most_features)
    names = [r.f for r in best.collect()]
    chosen = {f: i for i, f in enumerate(names)}
    data = held.mapInArrow(_restricted(chosen), "toxic int, hits array<int>").toArrow()
    swapped = held.select(F.explode("swapped").alias("s")).select(F.split("s", " ").alias("s"))
    swapped = swapped.groupBy(F.col("s")[0].alias("a"), F.col("s")[1].alias("b")).agg(F.sum(F.col("s")[2].cast("long")).alias("n")).collect()
    pairs = []
    for r in swapped:
        go, come = ([chosen[f] for f in features(w) if f in chosen] for w in (r.a, r.b))
        if go != come:
            pairs.append((go, come, r.n / sums["n"]))
    w, intercept = fitted(data.column("hits").to_pylist(), data.column("toxic").to_numpy().astype(float), pairs, len(names), **fit)
    return Model({f: float(x) for f, x in zip(names, w, strict=True)}, intercept)


def _score(model: Model):
    def run(texts: pa.Array) -> pa.Array:
        cache = process_cache("toxicity", hash(frozenset(model.weights)))

        def hits(words: list[str]) -> list[tuple]:
            return [tuple(f for f in features(w) if f in model.weights) for w in words]

        out = []
        for start in range(0, len(texts), 500):
            words = [set(WORD.findall((t or "").lower())) for t in texts.slice(start, 500).to_pylist()]
            of = with_vocabulary(cache, set().union(*words), hits).__getitem__
            out += [model.score({f for h in map(of, own) if h for f in h}) for own in words]
        return pa.array(out, pa.float64())

    return F.arrow_udf(run, "double")


def with_scores(docs: DataFrame, model: Model, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """Add the score, 0 to 1; a column of that name is replaced."""
    return unboxed(boxed(docs, score=_score(model)(F.col(text_col))), **{score_col: F.col("score")})


def drop_toxic(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """The documents whose score is below the threshold."""
    own = boxed(docs, score=_score(model)(F.col(text_col))).where(F.col("score") < threshold)
    return own.select(f"{ROW}.*")
