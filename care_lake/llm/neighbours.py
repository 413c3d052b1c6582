"""Approximate nearest neighbours with balanced posting lists.

Centroids come from a bounded sample that is halved until no part is larger than a list should be, so lists are
about equally long. Every vector is indexed: in the list of its nearest centroid and, near a boundary, in up to
``copies`` lists whose centroids are at most ``spread`` times as far. A query walks an in-memory graph of the
centroids and selects the lists within ``ratio`` times the distance of the nearest one, and more until they hold
enough vectors for a full answer. Lists and their queries are cut into blocks, each pair of which is one task's
group and returns the nearest of that block for each of its queries; scores are exact.

Defined cases: vectors that are null, zero or hold null or non-finite components, and rows without id, take no
part; only vectors of the query's length are candidates; of rows repeated with the same id the nearest counts;
with few candidates a query gets all of them; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from care_lake.llm.vectors import by_length, few_rows, matrix, sampled, usable
from care_lake.session import staged


def balanced_centroids(x: np.ndarray, largest: int, seed: int = 3) -> np.ndarray:
    """Means of parts of at most ``largest`` rows; a part is halved at the median between two centres."""
    rng, parts, done = np.random.default_rng(seed), [x], []
    while parts:
        part = parts.pop()
        if len(part) <= largest or (part == part[0]).all():
            done.append(part.mean(0))
            continue
        a, b = part[rng.choice(len(part), 2, replace=False)]
        for _ in range(4):
            side = part @ (a - b)
            order = np.argsort(side, kind="stable")
            low, high = part[order[:len(part) // 2]], part[order[len(part) // 2:]]
            a, b = high.mean(0), low.mean(0)
        parts += [low, high]
    return np.stack(done)


def _distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum((x * x).sum(1)[:, None] + (c * c).sum(1) - 2 * (x @ c.T), 0))


class Graph:
    """A neighbourhood graph of centroids for best-first search."""

    def __init__(self, centroids: np.ndarray, degree: int = 16):
        self.centroids, n = centroids, len(centroids)
        near = np.argsort(_distances(centroids, centroids), axis=1, kind="stable")[:, 1:degree + 1]
        links = [set(r.tolist()) for r in near]
        for i in range(n):  # both ways, and a ring so that every centroid can be reached
            for j in near[i]:
                links[j].add(i)
            links[i] |= {(i + 1) % n, (i - 1) % n}
        self.links = [np.array(sorted(s - {i}), np.int64) for i, s in enumerate(links)]

    def within(self, query: np.ndarray, ratio: float, enough) -> list[tuple[float, int]]:
        """(distance, centroid), nearest first: those within ``ratio`` of the nearest, more while ``enough`` is false."""
        start = np.unique(np.linspace(0, len(self.centroids) - 1, 8).astype(np.int64))
        seen = np.zeros(len(self.centroids), bool)
        front: list = []

        def visit(nodes: np.ndarray) -> None:
            nodes = nodes[~seen[nodes]]
            seen[nodes] = True
            for d, i in zip(np.linalg.norm(self.centroids[nodes] - query, axis=1).tolist(), nodes.tolist()):
                heapq.heappush(front, (d, i))

        visit(start)
        taken: list[tuple[float, int]] = []
        nearest = front[0][0]
        while front:
            d, i = heapq.heappop(front)
            nearest = min(nearest, d)
            if d > ratio * nearest and enough([c for e, c in taken if e <= ratio * nearest] + [c for e, c in taken if e > ratio * nearest]):
                break
            taken.append((d, i))
            visit(self.links[i])
        taken.sort()
        inside = [t for t in taken if t[0] <= ratio * nearest]
        for t in taken[len(inside):]:
            if enough([c for _, c in inside]):
                break
            inside.append(t)
        return inside


def _postings(centroids: dict[int, np.ndarray], spread: float, copies: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in few_rows(batches):
            for d, at in by_length(batch.column("vector")):
                rows, c = batch.take(pa.array(at)), centroids.get(d, np.zeros((1, d)))
                away = _distances(matrix(rows.column("vector")), c)
                home = away.argmin(1)
                near = away <= spread * away.min(1, keepdims=True)
                near &= away <= np.partition(away, min(copies, away.shape[1]) - 1, axis=1)[:, [min(copies, away.shape[1]) - 1]]
                near[np.arange(len(home)), home] = True
                row, where = np.nonzero(near)
                out = rows.take(pa.array(row))
                yield pa.RecordBatch.from_arrays(
                    [out.column("vec_id"), out.column("vector"), pa.array(np.full(len(row), d), pa.int32()), pa.array(where, pa.int32()),
                     pa.array(where == home[row], pa.bool_())], names=["vec_id", "vector", "length", "list", "home"])

    return run


def _selected(centroids: dict[int, np.ndarray], homes: dict[tuple[int, int], int], ratio: float, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        graphs: dict[int, Graph] = {}
        for batch in batches:
            for d, at in by_length(batch.column("vector")):
                rows = batch.take(pa.array(at))
                if d not in graphs:
                    graphs[d] = Graph(centroids.get(d, np.zeros((1, d))))

                def enough(lists: list[int], d=d) -> bool:
                    return sum(homes.get((d, i), 0) for i in lists) > k

                found = [graphs[d].within(q, ratio, enough) for q in matrix(rows.column("vector"))]
                row = np.repeat(np.arange(len(found)), [len(f) for f in found])
                out = rows.take(pa.array(row))
                yield pa.RecordBatch.from_arrays(
                    [out.column("vec_id"), out.column("vector"), pa.array(np.full(len(row), d), pa.int32()),
                     pa.array([i for f in found for _, i in f], pa.int32())], names=["vec_id", "vector", "length", "list"])

    return run


def _scan(k: int):
    """The nearest of a block of a list for each query of a block: one row a query."""

    def run(rows: pa.Table) -> pa.Table:
        asks = rows.column("asks").to_numpy()
        ids, x = rows.column("vec_id").to_numpy(), matrix(rows.column("vector"))
        queries, members = np.flatnonzero(asks), np.flatnonzero(~asks)
        out = []
        for q in queries if len(members) else []:
            other = members[ids[members] != ids[q]]
            score = np.sqrt(((x[other] - x[q]) ** 2).sum(1))
            best = np.lexsort((ids[other], score))[:k]
            out.append((int(ids[q]), ids[other][best].tolist(), score[best].tolist()))
        return pa.table({"query_id": pa.array([o[0] for o in out], pa.int64()), "ids": pa.array([o[1] for o in out], pa.list_(pa.int64())),
                         "scores": pa.array([o[2] for o in out], pa.list_(pa.float64()))})

    return run


def _merged(k: int):
    """The nearest over all blocks that a query has met: ``k`` rows of each."""

    def run(rows: pa.Table) -> pa.Table:
        ids = rows.column("ids").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        scores = rows.column("scores").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        order = np.lexsort((ids, scores))
        best = order[np.sort(np.unique(ids[order], return_index=True)[1])[:k]]
        return pa.table({"query_id": pa.array([rows.column("query_id")[0].as_py()] * len(best), pa.int64()), "rank": pa.array(range(1, len(best) + 1), pa.int32()),
                         "vec_id": pa.array(ids[best], pa.int64()), "score": pa.array(scores[best], pa.float64())})

    return run


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding",
            ratio: float = 1.25, spread: float = 1.1, copies: int = 3, list_rows: int = 256, block: int = 256,
            sample: int = 50_000) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``k`` vectors nearest to each query by Euclidean distance.

    A query is not its own neighbour (by id). ``sample`` bounds the vectors that centroids are fitted on, so there
    are at most ``16 * sample / list_rows`` lists; ``ratio`` trades recall for work.
    """

    def rows(df: DataFrame) -> DataFrame:
        df = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("vector"))
        return df.where(F.col("vec_id").isNotNull() & usable(F.col("vector")))

    data, asked = rows(vectors), rows(queries)
    item = data.schema["vector"].dataType.simpleString()
    n, base = data.count(), sampled(data, "vector", sample)
    held = sum(len(x) for x in base.values())
    share = max(16, round(list_rows * held / max(1, n)))  # sample rows that stand for one list
    centroids = {d: balanced_centroids(x, share) for d, x in base.items()}
    postings = staged(data.mapInArrow(_postings(centroids, spread, copies), f"vec_id long, vector {item}, length int, list int, home boolean"), "postings")
    sizes = staged(postings.groupBy("length", "list").agg(F.count("*").alias("size"), F.sum(F.col("home").cast("int")).alias("homes")), "lists")
    homes = {(r.length, r.list): r.homes for r in sizes.collect()}  # a row a centroid
    chosen = staged(asked.mapInArrow(_selected(centroids, homes, ratio, k), f"vec_id long, vector {item}, length int, list int"), "asked-lists")
    grid = sizes.join(chosen.groupBy("length", "list").agg(F.count("*").alias("asking")), ["length", "list"])
    grid = grid.select("length", "list", F.expr(f"(size + {block - 1}) div {block}").alias("parts"), F.expr(f"(asking + {block - 1}) div {block}").alias("asks_parts"))
    members = postings.drop("home").join(grid, ["length", "list"]).select(
        "length", "list", "vec_id", "vector", F.lit(False).alias("asks"), F.expr("pmod(xxhash64(vec_id), parts)").alias("part"), F.explode(F.expr("sequence(0L, asks_parts - 1)")).alias("asks_part"))
    asking = chosen.join(grid, ["length", "list"]).select(
        "length", "list", "vec_id", "vector", F.lit(True).alias("asks"), F.explode(F.expr("sequence(0L, parts - 1)")).alias("part"), F.expr("pmod(xxhash64(vec_id), asks_parts)").alias("asks_part"))
    scanned = members.unionByName(asking).groupBy("length", "list", "part", "asks_part").applyInArrow(_scan(k), "query_id long, ids array<long>, scores array<double>")
    return scanned.groupBy("query_id").applyInArrow(_merged(k), "query_id long, rank int, vec_id long, score double")
