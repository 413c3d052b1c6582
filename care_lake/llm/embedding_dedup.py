"""Embedding near-dedup: spherical k-means cells and blocked cosine products within cells.

Equal vectors of a label collapse first and count by their number. Centroids come from a bounded sample; they
decide only where vectors are compared, never whether. A vector belongs to the cell of its nearest centroid. Two
unit vectors at the threshold are at most a chord apart, so the one of the higher cell can only link into a lower
cell if it lies within a chord of the plane between the two centroids; there it is copied to. Thus every link is
found in exactly one cell. Cells are cut into blocks, and a pair of blocks is one matrix product. It returns link
counts and a spanning forest, so a group of thousands of near copies never becomes thousands of squared rows.

Defined cases: vectors that are null, zero or hold null or non-finite components, and rows without label, link
with nothing and are their own component; vectors of different length never link; rows repeated with the same id
link with each other; a component's id is its smallest non-null id; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from care_lake.llm.common import numbered
from care_lake.llm.components import components
from care_lake.llm.vectors import by_length, few_rows, matrix, sampled, unit, usable
from care_lake.session import staged

#: Room for rounding when cells are chosen.
SLACK = 1e-6


def spherical_k_means(x: np.ndarray, k: int, rounds: int = 8, seed: int = 5) -> np.ndarray:
    """Unit centroids of unit vectors; cells that run empty are dropped."""
    k = min(k, len(x))
    centroids = x[np.random.default_rng(seed).choice(len(x), k, replace=False)]
    for _ in range(rounds):
        cell = (x @ centroids.T).argmax(1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, cell, x)
        norms = np.linalg.norm(sums, axis=1)
        centroids = sums[norms > 0] / norms[norms > 0, None]
    return centroids


def _cells(centroids: dict[int, np.ndarray], chord: float):
    """A row for the cell of each vector and for the lower cells it may link into."""

    apart_of = {d: np.sqrt(np.maximum(2 - 2 * (c @ c.T), 0)) for d, c in centroids.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in few_rows(batches):
            for d, at in by_length(batch.column("vector")):
                rows = batch.take(pa.array(at))
                x, c = unit(matrix(rows.column("vector"))), centroids.get(d)
                if c is None or len(c) < 2:
                    own = np.zeros((len(x), 1), bool)
                    cell = np.zeros(len(x), np.int64)
                else:
                    score = x @ c.T
                    cell = score.argmax(1)
                    margin = score[np.arange(len(x)), cell][:, None] - score
                    own = (margin <= chord * apart_of[d][cell] + SLACK) & (np.arange(len(c)) < cell[:, None])
                own[np.arange(len(x)), cell] = True
                row, where = np.nonzero(own)
                out = rows.take(pa.array(row))
                yield pa.RecordBatch.from_arrays(
                    [out.column("node"), out.column("label"), out.column("vector"), out.column("n"), pa.array(np.full(len(row), d), pa.int32()),
                     pa.array(where, pa.int32()), pa.array(where == cell[row], pa.bool_())],
                    names=["node", "label", "vector", "n", "length", "cell", "home"])

    return run


def _products(threshold: float):
    """Link counts (node, null, count) and a spanning forest (node, other, 0) of one pair of blocks."""

    def run(rows: pa.Table) -> pa.Table:
        block, low, high = rows.column("block").to_numpy(), rows.column("low")[0].as_py(), rows.column("high")[0].as_py()
        node, n = rows.column("node").to_numpy(), rows.column("n").to_numpy()
        x = matrix(rows.column("vector"))
        norm = np.linalg.norm(x, axis=1)
        a, b = np.flatnonzero(block == low), np.flatnonzero(block == high)
        links = np.zeros((len(x), len(x)), bool)
        if len(a) and len(b):
            cosine = x[a] @ x[b].T / (norm[a][:, None] * norm[b][None])
            links[np.ix_(a, b)] = cosine >= threshold
        np.fill_diagonal(links, False)
        links |= links.T
        count = links @ n
        lead, u, v = np.full(len(x), -1), [], []
        for i in np.flatnonzero(count):
            if lead[i] >= 0:
                continue
            members = np.zeros(len(x), bool)
            front = np.array([i])
            while len(front):
                members[front] = True
                front = np.flatnonzero(links[front].any(0) & ~members)
            lead[members] = i
            others = np.flatnonzero(members)
            u += node[others[others != i]].tolist()
            v += [node[i]] * (len(others) - 1)
        at = np.flatnonzero(count)
        return pa.table({
            "u": pa.array([*node[at].tolist(), *u], pa.int64()),
            "v": pa.array([None] * len(at) + v, pa.int64()),
            "links": pa.array([*count[at].tolist(), *[0] * len(u)], pa.int64()),
        })

    return run


def _dealt(cells: DataFrame, key: list[str], block: int) -> DataFrame:
    """Rows of each cell, once for each pair of blocks they belong to: vectors at home there with each other, and with
    the copies from higher cells (blocks below 0). Copies never meet copies."""
    counts = cells.groupBy(*key).agg(F.count_if("home").alias("own"), F.count_if(~F.col("home")).alias("copies"))
    counts = counts.where("own > 0 and own + copies > 1").select(
        *key, F.expr(f"(own + {block - 1}) div {block}").alias("own_blocks"), F.expr(f"(copies + {block - 1}) div {block}").alias("copy_blocks"))
    rows = cells.join(counts, key)
    others = F.expr("concat(sequence(0L, own_blocks - 1), if(copy_blocks > 0, sequence(-copy_blocks, -1L), cast(array() as array<bigint>)))")
    own = rows.where("home").withColumn("block", F.expr("pmod(xxhash64(node), own_blocks)")).withColumn("other", F.explode(others))
    own = own.withColumn("low", F.expr("if(other < 0, block, least(block, other))")).withColumn("high", F.expr("if(other < 0, other, greatest(block, other))"))
    copies = rows.where("not home").withColumn("block", F.expr("-1 - pmod(xxhash64(node), copy_blocks)"))
    copies = copies.withColumn("low", F.explode(F.expr("sequence(0L, own_blocks - 1)"))).withColumn("high", F.col("block"))
    columns = [*key, "node", "vector", "n", "block", "low", "high"]
    return own.select(*columns).unionByName(copies.select(*columns))


def embedding_components(vectors: DataFrame, threshold: float = 0.98, id_col: str = "vec_id", vector_col: str = "embedding",
                         label_col: str = "label", block: int = 256, sample: int = 20_000, most_cells: int = 4096) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row; ``kept`` marks the representative of a component.

    ``sample`` bounds the vectors that centroids are fitted on, ``most_cells`` the number of centroids, ``block`` the
    rows of a block.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"), F.col(vector_col).alias("vector"))
    rows = rows.withColumn("vector", F.when(usable(F.col("vector")) & F.col("label").isNotNull(), F.col("vector")))
    distinct = rows.where("vector is not null").groupBy("label", "vector").agg(F.count("*").alias("n"), F.min("vec_id").alias("least"))
    distinct = staged(numbered(distinct, "label", "least", "vector").withColumn("node", F.expr("shiftleft(cast(part as long), 33) + at")).drop("part", "at"), "vectors")
    n = distinct.count()
    centroids = {d: spherical_k_means(unit(x), min(most_cells, math.ceil(math.sqrt(n) / 4))) for d, x in sampled(distinct, "vector", sample).items()}
    chord = math.sqrt(max(0.0, 2 - 2 * threshold))
    kind = distinct.schema["label"].dataType.simpleString()
    item = distinct.schema["vector"].dataType.simpleString()
    cells = distinct.select("node", "label", "vector", "n").mapInArrow(
        _cells(centroids, chord), f"node long, label {kind}, vector {item}, n long, length int, cell int, home boolean")
    cells = staged(cells, "cells")
    key = ["label", "length", "cell"]
    dealt = _dealt(cells, key, block)
    found = staged(dealt.groupBy(*key, "low", "high").applyInArrow(_products(threshold), "u long, v long, links long"), "cosines")
    labels = components(found.where("v is not null")).withColumnsRenamed({"label": "component"})
    counts = found.where("v is null").groupBy(F.col("u").alias("node")).agg(F.sum("links").alias("links"))
    named = distinct.select("node", "label", "vector", "n", "least").join(labels, "node", "left").join(counts, "node", "left")
    named = named.withColumn("component", F.coalesce("component", "node"))
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    named = named.join(least, "component").select(F.col("label").alias("own_label"), F.col("vector").alias("own_vector"), "n", "links", "component_id")
    both = rows.join(named, (F.col("label") == F.col("own_label")) & (F.col("vector") == F.col("own_vector")), "left")
    component = F.when(F.col("own_vector").isNotNull(), F.col("component_id")).otherwise(F.col("vec_id"))
    return both.select(
        "vec_id", (F.coalesce("links", F.lit(0)) + F.coalesce(F.col("n") - 1, F.lit(0))).cast("long").alias("n_links"),
        component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))
