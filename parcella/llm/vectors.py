"""Nearest neighbours by inner product with an inverted multi-index.

Vectors are cut in two halves, each quantised by its own small codebook, so K centroids
a half make K * K cells. A query sums, for a cell, one value of either half: the inner
product with the centroid plus the most that any member of the centroid can add to it.
The sum bounds the score of everything in the cell. A heap over the two sorted halves
hands out the cells in falling order of the sum, as in the multi-sequence algorithm.

Two walks: the first visits cells until they hold ``first`` vectors and reranks them with
exact scores; the score of the k-th found is a floor. The second goes on from there until
the bound falls below the floor and reranks with it. What is never visited cannot be among
the k nearest, so nothing is lost, however little structure the data has.

Codebooks are fitted on at most ``sample`` vectors (smallest hash first); every vector is
indexed. Cells are dealt out in blocks of bounded size, so a cell that holds a third of
all vectors is many tasks.

Defined cases: vectors that are null, zero, of another length than most of the sample, or
hold a null or non-finite component take no part, nor do rows with a null id; a repeated
query id is one query with its smallest vector, and its rows are no candidates of its own;
other repeated rows are all candidates; equal scores rank by id; no valid vectors give an
empty result; other columns, whatever their names, are not read.
"""

from __future__ import annotations

import heapq
from collections import Counter

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcella.sources.staging import staged

CENTROIDS = 16
SAMPLE = 4096
FIRST = 600
ROUNDS = 15
#: Most vectors and most queries of a cell that meet in one group, on average.
VECTOR_BLOCK, QUERY_BLOCK = 1024, 1024
#: Above the rounding of a double inner product.
SLACK = 1e-9


def valid(v: Column, width: int) -> Column:
    limit = F.lit(float("inf"))
    return (
        (F.size(v) == width)
        & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < limit))
        & F.exists(v, lambda x: x != 0)
    )


def codebooks(rows: DataFrame, centroids: int, sample: int) -> tuple[int, list[np.ndarray]]:
    """(vector length, centroids of either half) from a bounded sample."""
    picked = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).collect()
    lengths = Counter(len(r["v"]) for r in picked if r["v"])
    if not lengths:
        return 0, []
    width = max(lengths, key=lambda n: (lengths[n], n))
    x = np.array(
        [r["v"] for r in picked if r["v"] and len(r["v"]) == width and None not in r["v"]], float
    ).reshape(-1, width)
    x = x[np.isfinite(x).all(axis=1) & (x != 0).any(axis=1)]
    if not len(x):
        return 0, []
    return width, [k_means(h, centroids) for h in (x[:, : width // 2], x[:, width // 2 :])]


def k_means(x: np.ndarray, k: int) -> np.ndarray:
    rng = np.random.default_rng(7)
    c = x[np.sort(rng.permutation(len(x))[:k])]
    for _ in range(ROUNDS):
        near = distances(x, c).argmin(axis=1)
        c = np.array([x[near == i].mean(axis=0) if (near == i).any() else c[i] for i in range(len(c))])
    return c


def distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    d = (x * x).sum(axis=1)[:, None] - 2 * x @ c.T + (c * c).sum(axis=1)[None, :]
    return np.sqrt(np.maximum(d, 0))


def matrix(column, width: int) -> np.ndarray:
    """An Arrow list column without nulls as rows of doubles."""
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), float).reshape(-1, width)


def cells_in_order(left: np.ndarray, right: np.ndarray):
    """(sum, i, j) of all pairs, largest sum first, by a heap over the sorted halves."""
    a, b = np.argsort(-left, kind="stable"), np.argsort(-right, kind="stable")
    heap = [(-(left[a[0]] + right[b[0]]), 0, 0)]
    while heap:
        value, i, j = heapq.heappop(heap)
        yield -value, int(a[i]), int(b[j])
        if j + 1 < len(b):
            heapq.heappush(heap, (-(left[a[i]] + right[b[j + 1]]), i, j + 1))
        if j == 0 and i + 1 < len(a):
            heapq.heappush(heap, (-(left[a[i + 1]] + right[b[0]]), i + 1, 0))


class Index:
    """A fitted index: all valid vectors with their cell, codebooks, loads and radii."""

    def __init__(self, rows: DataFrame, centroids: int = CENTROIDS, sample: int = SAMPLE):
        """``rows``: ``vec_id`` and ``v``, an array of numbers."""
        rows = rows.where("vec_id is not null and v is not null")
        self.width, self.books = codebooks(rows, centroids, sample)
        if not self.width:
            self.entries = None
            return
        books, half, width = self.books, self.width // 2, self.width

        def place(batches):
            import pyarrow as pa

            for batch in batches:
                x = matrix(batch.column(1), width)
                d = [distances(x[:, :half], books[0]), distances(x[:, half:], books[1])]
                near = [e.argmin(axis=1) for e in d]
                yield pa.RecordBatch.from_arrays(
                    [
                        *batch.columns,
                        *(pa.array(n.astype(np.int32)) for n in near),
                        *(pa.array(e[np.arange(len(x)), n]) for e, n in zip(d, near)),
                    ],
                    names=["vec_id", "v", "c1", "c2", "r1", "r2"],
                )

        kept = rows.where(valid(F.col("v"), width)).select("vec_id", "v")
        vector = kept.schema["v"].dataType.simpleString()
        self.entries = staged(
            kept.mapInArrow(
                place, f"vec_id long, v {vector}, c1 int, c2 int, r1 double, r2 double"
            ),
            "entries",
        )
        self.loads = np.zeros((len(books[0]), len(books[1])), np.int64)
        self.radii = [np.zeros(len(b)) for b in books]
        found = self.entries.groupBy("c1", "c2").agg(
            F.count(F.lit(1)).alias("n"), F.max("r1").alias("r1"), F.max("r2").alias("r2")
        )
        for r in found.collect():  # at most one row for each cell
            self.loads[r["c1"], r["c2"]] = r["n"]
            for k, c in ((0, r["c1"]), (1, r["c2"])):
                self.radii[k][c] = max(self.radii[k][c], r[f"r{k + 1}"])

    def walk(self, queries: DataFrame, first: int) -> DataFrame:
        """``query_id, q, floor, c1, c2``: the cells each query visits.

        Without a ``floor`` column: until the cells hold ``first`` vectors. With it: the
        cells after those, until the bound is below the floor.
        """
        books, radii, loads, half, width = self.books, self.radii, self.loads, self.width // 2, self.width
        again = "floor" in queries.columns

        def run(batches):
            import pyarrow as pa

            for batch in batches:
                x = matrix(batch.column(1), width)
                floors = batch.column(2).to_numpy() if again else np.zeros(len(x))
                tops = [
                    h @ b.T + np.sqrt((h * h).sum(axis=1))[:, None] * r[None, :]
                    for h, b, r in zip((x[:, :half], x[:, half:]), books, radii)
                ]
                rows, one, two = [], [], []
                for k in range(len(x)):
                    seen = 0
                    for bound, i, j in cells_in_order(tops[0][k], tops[1][k]):
                        if not again and seen >= first:
                            break
                        if again and bound < floors[k] - SLACK:
                            break
                        done = again and seen < first
                        seen += loads[i, j]
                        if loads[i, j] and not done:
                            rows.append(k)
                            one.append(i)
                            two.append(j)
                at = pa.array(rows, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(at),
                        batch.column(1).take(at),
                        pa.array(floors[rows] if again else np.full(len(rows), -np.inf)),
                        pa.array(one, pa.int32()),
                        pa.array(two, pa.int32()),
                    ],
                    names=["query_id", "q", "floor", "c1", "c2"],
                )

        vector = queries.schema["q"].dataType.simpleString()
        return queries.mapInArrow(
            run, f"query_id long, q {vector}, floor double, c1 int, c2 int"
        )

    def rerank(self, probes: DataFrame, k: int) -> DataFrame:
        """``query_id, vec_id, score``: of each visited block the k best that reach the floor."""
        probes = staged(probes, "probes")
        asked = {(r["c1"], r["c2"]): r["n"] for r in probes.groupBy("c1", "c2").agg(F.count(F.lit(1)).alias("n")).collect()}
        spark, width = probes.sparkSession, self.width
        blocks = spark.createDataFrame(
            [
                (i, j, int(-(-self.loads[i, j] // VECTOR_BLOCK)), int(-(-n // QUERY_BLOCK)))
                for (i, j), n in sorted(asked.items())
            ],
            "c1 int, c2 int, vectors int, queries int",
        )
        blocks = F.broadcast(blocks)  # one row for each cell of the codebooks
        left = (
            self.entries.join(blocks, ["c1", "c2"])
            .withColumn("vb", F.pmod(F.xxhash64("vec_id", "v"), F.col("vectors")).cast("int"))
            .withColumn("qb", F.explode(F.sequence(F.lit(0), F.col("queries") - 1)))
            .select("c1", "c2", "vb", "qb", "vec_id", "v")
        )
        right = (
            probes.join(blocks, ["c1", "c2"])
            .withColumn("qb", F.pmod(F.xxhash64("query_id"), F.col("queries")).cast("int"))
            .withColumn("vb", F.explode(F.sequence(F.lit(0), F.col("vectors") - 1)))
            .select("c1", "c2", "vb", "qb", "query_id", "q", "floor")
        )

        def best(vectors, queries):
            import pyarrow as pa

            out = [[], [], []]
            if vectors.num_rows and queries.num_rows:
                vectors, queries = vectors.combine_chunks(), queries.combine_chunks()
                x = matrix(vectors["v"].combine_chunks(), width)
                q = matrix(queries["q"].combine_chunks(), width)
                ids, own = vectors["vec_id"].to_numpy(), queries["query_id"].to_numpy()
                floors = queries["floor"].to_numpy()
                for start in range(0, len(q), 256):
                    part = q[start : start + 256]
                    s = part @ x.T
                    s[own[start : start + 256, None] == ids[None, :]] = -np.inf
                    floor = np.maximum(floors[start : start + 256], -1e308)
                    if len(ids) > k:
                        floor = np.maximum(floor, -np.partition(-s, k - 1, axis=1)[:, k - 1])
                    row, col = np.nonzero((s >= (floor - SLACK)[:, None]) & (s > -np.inf))
                    exact = (part[row] * x[col]).sum(axis=1)
                    order = np.lexsort((ids[col], -exact, row))
                    row, col, exact = row[order], col[order], exact[order]
                    rank = np.arange(len(row)) - np.searchsorted(row, row)
                    keep = rank < k
                    out[0].append(own[start + row[keep]])
                    out[1].append(ids[col[keep]])
                    out[2].append(exact[keep])
            arrays = [np.concatenate(o) if o else np.zeros(0) for o in out]
            return pa.table(
                {
                    "query_id": pa.array(arrays[0].astype(np.int64)),
                    "vec_id": pa.array(arrays[1].astype(np.int64)),
                    "score": pa.array(arrays[2].astype(float)),
                }
            )

        keys = ["c1", "c2", "vb", "qb"]
        return (
            left.groupBy(*keys)
            .cogroup(right.groupBy(*keys))
            .applyInArrow(best, "query_id long, vec_id long, score double")
        )


def top(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(index: Index, queries: DataFrame, k: int = 20, first: int = FIRST) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k nearest of each query (``query_id, q``)."""
    spark = queries.sparkSession
    if index.entries is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    asked = staged(
        queries.where("query_id is not null and q is not null")
        .where(valid(F.col("q"), index.width))
        .groupBy("query_id")
        .agg(F.min("q").alias("q")),
        "queries",
    )
    near = staged(top(index.rerank(index.walk(asked, first), k), k), "near")
    floors = near.groupBy("query_id").agg(
        F.when(F.count(F.lit(1)) == k, F.min("score")).otherwise(float("-inf")).alias("floor")
    )
    rest = asked.join(floors, "query_id", "left").select(
        "query_id", "q", F.coalesce("floor", F.lit(float("-inf"))).alias("floor")
    )
    further = index.rerank(index.walk(rest, first), k)
    both = near.select("query_id", "vec_id", "score").unionByName(further)
    return top(both, k).select("query_id", "rank", "vec_id", "score")
