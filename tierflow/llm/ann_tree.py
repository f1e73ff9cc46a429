"""Approximate nearest neighbours with a hierarchical k-means tree.

The tree is fitted with numpy on a bounded sample and sent to the tasks. All
distinct vectors are dealt to its leaves. A query walks the tree best bin
first: a priority queue holds the branches not taken, ordered by the distance
of their centres, and leaves are visited from its head. How many leaves is
calibrated in each run: the exact neighbours of some fixed queries among all rows
are found by a partial top-k in each task, and visits are widened until the share
of them that lies in visited leaves reaches the target. That share is handed out
as ``recall``. Visits and leaves meet in one join of packed rows of bounded
size, where products are exact in double precision.
"""

from __future__ import annotations

import heapq
import math
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tierflow.llm.common import share
from tierflow.staging import stage

NEIGHBOURS = 20
BLOCK = 256


@dataclass
class Tree:
    """Nodes with a centre each; ``children`` is empty for a leaf, which has a number."""

    centres: np.ndarray
    children: list[list[int]]
    leaf: list[int]
    n_leaves: int
    key: str = field(default_factory=lambda: uuid.uuid4().hex)

    def nearest_child(self, node: int, x: np.ndarray) -> np.ndarray:
        kids = self.children[node]
        centres = self.centres[kids]
        gaps = (centres**2).sum(axis=1) - 2 * x @ centres.T
        return np.asarray(kids)[gaps.argmin(axis=1)]

    def assign(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each vector, going to the nearest centre at each level."""
        at = np.zeros(len(x), np.int64)
        while True:
            open_ = np.array([bool(self.children[n]) for n in at], bool) if len(at) else np.zeros(0, bool)
            if not open_.any():
                return np.array([self.leaf[n] for n in at], np.int64)
            for node in np.unique(at[open_]):
                own = at == node
                at[own] = self.nearest_child(node, x[own])

    def walk(self, q: np.ndarray, visits: int) -> list[int]:
        """The first ``visits`` leaves, best bin first.

        Bins are ranked by the product of query and centre, the measure searched for.
        """
        products = self.centres @ q
        queue, found = [(-products[0], 0)], []
        while queue and len(found) < visits:
            _, node = heapq.heappop(queue)
            while self.children[node]:
                kids = sorted(self.children[node], key=lambda k: (-products[k], k))
                for k in kids[1:]:
                    heapq.heappush(queue, (-products[k], k))
                node = kids[0]
            found.append(self.leaf[node])
        return found


def _kmeans(x: np.ndarray, k: int, random: np.random.Generator, rounds: int = 8) -> np.ndarray:
    centres = x[random.choice(len(x), k, replace=False)]
    for _ in range(rounds):
        own = ((centres**2).sum(axis=1) - 2 * x @ centres.T).argmin(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, x)
        counts = np.bincount(own, minlength=k)
        filled = counts > 0
        centres[filled] = sums[filled] / counts[filled, None]
    return own


def build_tree(x: np.ndarray, leaves: int, branches: int = 8, seed: int = 11) -> Tree:
    """Split the sample by k-means, largest node first, until there are ``leaves``."""
    random = np.random.default_rng(seed)
    centres, children = [x.mean(axis=0) if len(x) else np.zeros(x.shape[1])], [[]]
    heap, done = [(-len(x), 0, np.arange(len(x)))], 1
    while heap and done < leaves:
        size, node, rows = heapq.heappop(heap)
        k = min(branches, leaves - done + 1)
        distinct = np.unique(x[rows], axis=0) if -size <= 4 * branches else None
        if -size < 2 or (distinct is not None and len(distinct) < 2):
            continue
        own = _kmeans(x[rows], min(k, -size), random)
        groups = [rows[own == g] for g in np.unique(own)]
        if len(groups) < 2:
            continue
        for group in groups:
            centres.append(x[group].mean(axis=0))
            children.append([])
            children[node].append(len(centres) - 1)
            heapq.heappush(heap, (-len(group), len(centres) - 1, group))
        done += len(groups) - 1
    leaf, number = [-1] * len(centres), 0
    for node, kids in enumerate(children):
        if not kids:
            leaf[node], number = number, number + 1
    return Tree(np.array(centres), children, leaf, number)


def _matrix(column) -> np.ndarray:
    """Packed doubles, one vector per row."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    rows = [np.frombuffer(v.as_buffer(), "<f8") for v in column]
    return np.stack(rows) if rows else np.zeros((0, 0))


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors as little-endian doubles; what is null, zero or not finite is left out."""
    for batch in batches:
        ids, packed = [], []
        for i, v in zip(batch.column("vec_id").to_pylist(), batch.column("embedding")):
            if i is None or not v.is_valid or not len(v.values) or v.values.null_count:
                continue
            x = v.values.to_numpy(zero_copy_only=False).astype("<f8") + 0.0
            if np.isfinite(x).all() and x.any():
                ids.append(i)
                packed.append(x.tobytes())
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(packed, pa.binary())], names=["vec_id", "packed"]
        )


def lower_bounds(q: np.ndarray, x: np.ndarray, kth: int) -> np.ndarray:
    """A product that each query's ``kth`` best vector of all reaches: its ``kth`` of some."""
    if len(x) < kth:
        return np.full(len(q), -np.inf)
    scores = q @ x.T
    return np.partition(scores, len(x) - kth, axis=1)[:, -kth]


def nearest_pairs(
    q: np.ndarray, x: np.ndarray, kth: int, least: np.ndarray
) -> tuple[np.ndarray, ...]:
    """Pairs among each query's ``kth`` best in a block, and not below its ``least``.

    A matrix product picks the pairs, with a margin for its rounding; each pair's
    product is then summed by itself, so it does not depend on the block.
    """
    scores = q @ x.T
    if scores.shape[1] > kth:
        least = np.maximum(least, np.partition(scores, scores.shape[1] - kth, axis=1)[:, -kth])
    sizes = np.sqrt((q**2).sum(axis=1)) * math.sqrt((x**2).sum(axis=1).max())
    i, j = np.nonzero(scores >= (least - 1e-12 * sizes)[:, None])
    return i, j, np.einsum("ij,ij->i", q[i], x[j])


def true_neighbours(dealt: DataFrame, queries: np.ndarray, k: int) -> list[list[tuple[int, int]]]:
    """For each query its nearest vectors of all, itself left out, as (leaf, rows that count).

    ``dealt`` has ``packed``, ``ids`` and ``leaf``. Each task keeps the ``k`` best that it
    met for each query, so what is shuffled grows with tasks and what comes back with
    queries alone. The rows of a vector count until there are ``k``.
    """
    asked = dealt.sparkSession.sparkContext.broadcast(queries)

    def best_of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, kept = asked.value, None
        number = {q.tobytes(): i for i, q in enumerate(queries)}
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column("packed"))
            scores = queries @ x.T
            for j, packed in enumerate(batch.column("packed").to_pylist()):
                if packed in number:
                    scores[number[packed], j] = -np.inf
            leaves = np.broadcast_to(batch.column("leaf").to_numpy(), scores.shape)
            rows = np.broadcast_to(batch.column("ids").value_lengths().to_numpy(), scores.shape)
            met = (scores, leaves, rows)
            if kept is not None:
                met = tuple(np.concatenate(both, axis=1) for both in zip(kept, met))
            best = np.argsort(-met[0], axis=1, kind="stable")[:, :k]
            kept = tuple(np.take_along_axis(m, best, axis=1) for m in met)
        if kept is not None:
            query = np.repeat(np.arange(len(queries)), kept[0].shape[1])
            columns = [query, *(m.ravel() for m in kept)]
            names = ["query", "score", "leaf", "rows"]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)

    found = dealt.mapInArrow(best_of_task, "query long, score double, leaf long, rows int")
    nearest = Window.partitionBy("query").orderBy(F.desc("score"), "leaf", "rows")
    top = found.where(F.col("score") > float("-inf")).withColumn("nth", F.row_number().over(nearest))
    out: list[list[tuple[int, int]]] = [[] for _ in queries]
    for r in top.where(F.col("nth") <= k).orderBy("query", "nth").collect():
        of = out[r["query"]]
        left = k - sum(n for _, n in of)
        if left > 0:
            of.append((r["leaf"], min(left, r["rows"])))
    asked.unpersist()
    return out


def calibrate(
    tree: Tree, queries: np.ndarray, truth: list[list[tuple[int, int]]], target: float = 0.95
) -> tuple[int, float]:
    """Leaves to visit, and the share of the true neighbours that lie in them.

    Visits are widened, leaf by leaf in the order of the walk, until ``target`` is reached.
    """
    hits = np.zeros(tree.n_leaves)
    for q, near in zip(queries, truth):
        place = {leaf: n for n, leaf in enumerate(tree.walk(q, tree.n_leaves))}
        for leaf, rows in near:
            hits[place[leaf]] += rows
    if not hits.sum():
        return tree.n_leaves, 1.0
    reached = np.cumsum(hits) / hits.sum()
    visits = int(np.argmax(reached >= min(target, reached[-1]))) + 1
    return visits, float(reached[visits - 1])


def nearest_neighbours(
    vectors: DataFrame,
    every: int = 20,
    k: int = NEIGHBOURS,
    sample_rows: int = 8000,
    max_leaves: int = 128,
    target: float = 0.95,
    calibration_queries: int = 128,
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score`` of the ``k`` nearest found, and ``recall``.

    Takes ``vec_id`` and ``embedding``; queries are the rows whose id is divisible
    by ``every``, candidates all rows but the query's own. Nearest is the largest
    inner product, ties go to the smaller id. Rows with a null id take no part,
    nor vectors that are null, empty, zero or hold null or non-finite numbers.
    Vectors of different lengths are searched apart from each other. Repeated ids
    are rows like others; a query id that repeats is searched once for each of its
    different vectors, and never finds its own id. An empty table gives no rows.

    Equal vectors are one vector with its k + 1 smallest ids, which is all that k
    nearest can need, so a vector that a third of the rows share costs no more
    than others. The tree has one leaf per 64 distinct vectors, ``max_leaves`` at
    most, and is fitted on about ``sample_rows`` of them. ``calibration_queries`` of the
    sample are compared with all rows; ``recall`` is the share of their true neighbours
    that the leaves visited hold, ``target`` or more, the same in each row of one width.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    packed, _ = stage(rows.mapInArrow(_pack, "vec_id long, packed binary"), "vectors")
    widths = [r[0] for r in packed.select(F.octet_length("packed")).distinct().collect()]
    found = None
    for width in sorted(widths):
        part = _search(
            packed.where(F.octet_length("packed") == width),
            every, k, sample_rows, max_leaves, target, calibration_queries,
        )
        found = part if found is None else found.unionByName(part)
    if found is None:
        schema = "query_id long, rank int, vec_id long, score double, recall double"
        return vectors.sparkSession.createDataFrame([], schema)
    return found


def _search(packed, every, k, sample_rows, max_leaves, target, calibration_queries) -> DataFrame:
    spark = packed.sparkSession
    # Row numbers are limited before the exchange, so a common vector stays small.
    order = Window.partitionBy("packed").orderBy("vec_id")
    smallest = packed.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= k + 1)
    distinct, _ = stage(
        smallest.groupBy("packed")
        .agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
        .withColumn("vec", F.xxhash64("packed")),
        "distinct-vectors",
    )
    total = distinct.count()
    drawn = share(distinct.select("vec", "packed", "ids"), "vec", sample_rows).toArrow().combine_chunks()
    drawn = drawn.sort_by("packed")
    sample, sample_ids = _matrix(drawn.column("packed")), drawn.column("ids").combine_chunks()
    leaves = max(1, min(max_leaves, total // 64, len(sample) // 4))
    tree = build_tree(sample, leaves)
    # The sample's own best rows are candidates, so that none of the k can be missing,
    # and bound from below what the neighbours of a query score; the query itself may
    # be among them, so one more is asked for than k + 1.
    shared, known = spark.sparkContext.broadcast(tree), spark.sparkContext.broadcast((sample, sample_ids))

    def to_leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            leaf = shared.value.assign(_matrix(batch.column("packed")))
            yield pa.RecordBatch.from_arrays(
                [batch.column("packed"), batch.column("ids"), pa.array(leaf)],
                names=["packed", "ids", "leaf"],
            )

    def to_visits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            asking = _matrix(batch.column("packed"))
            walks = [shared.value.walk(q, visits) for q in asking]
            counts = [len(w) for w in walks]
            bounds = np.concatenate(
                [lower_bounds(asking[a : a + 64], known.value[0], k + 2) for a in range(0, len(asking), 64)]
            )
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("packed").take(pa.array(np.repeat(np.arange(len(walks)), counts))),
                    pa.array([x for w in walks for x in w], pa.int64()),
                    pa.array(np.repeat(bounds, counts)),
                ],
                names=["packed", "leaf", "bound"],
            )

    def near_in_sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors, ids = known.value
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.column("packed").slice(at, 64)
                asking = _matrix(part)
                every = np.full(len(asking), -np.inf)
                i, j, scores = nearest_pairs(asking, vectors, k + 2, every)
                yield pa.RecordBatch.from_arrays(
                    [part.take(pa.array(i)), ids.take(pa.array(j)), pa.array(scores)],
                    names=["packed", "ids", "score"],
                )

    def blocks(df: DataFrame, *columns: str) -> DataFrame:
        """Rows of a leaf in packed rows of about BLOCK; counts come first."""
        # One row per leaf, of which there are max_leaves at most.
        sizes = F.broadcast(df.groupBy("leaf").agg(F.ceil(F.count("*") / BLOCK).alias("n")))
        salt = F.pmod(F.xxhash64("packed", F.lit(3)), F.col("n"))
        dealt = df.join(sizes, "leaf").withColumn("block", salt)
        return dealt.groupBy("leaf", "block").agg(F.collect_list(F.struct(*columns)).alias("rows"))

    dealt, _ = stage(distinct.mapInArrow(to_leaves, "packed binary, ids array<long>, leaf long"), "leaves")
    chosen = sample[np.unique(np.linspace(0, len(sample) - 1, calibration_queries).astype(int))]
    visits, recall = calibrate(tree, chosen, true_neighbours(dealt, chosen, k), target)
    asked = packed.where(F.pmod("vec_id", F.lit(every)) == 0)
    queries = asked.select("packed").distinct()
    walked, _ = stage(queries.mapInArrow(to_visits, "packed binary, leaf long, bound double"), "visits")
    left = blocks(walked, "packed", "bound").select(
        "leaf", F.col("rows.packed").alias("queries"), F.col("rows.bound").alias("bounds")
    )
    right = blocks(dealt, "packed", "ids").select(
        "leaf", F.col("rows.packed").alias("vectors"), F.col("rows.ids").alias("ids")
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                packed_q = batch.column("queries")[r].values
                ids = batch.column("ids")[r].values
                x = _matrix(batch.column("vectors")[r].values)
                bounds = batch.column("bounds")[r].values.to_numpy()
                i, j, scores = nearest_pairs(_matrix(packed_q), x, k + 1, bounds)
                yield pa.RecordBatch.from_arrays(
                    [packed_q.take(pa.array(i)), ids.take(pa.array(j)), pa.array(scores)],
                    names=["packed", "ids", "score"],
                )

    schema = "packed binary, ids array<long>, score double"
    met = left.join(right, "leaf").select("queries", "bounds", "vectors", "ids")
    pairs = (
        met.mapInArrow(compare, schema)
        .union(queries.mapInArrow(near_in_sample, schema))
        .groupBy("packed", "ids")
        .agg(F.max("score").alias("score"))
    )
    # A vector's smallest id stands for it: k + 1 vectors hold the k + 1 best rows.
    nearest = Window.partitionBy("packed").orderBy(F.desc("score"), F.col("ids")[0])
    best = pairs.withColumn("nth", F.row_number().over(nearest)).where(F.col("nth") <= k + 1)
    answers = best.groupBy("packed").agg(
        F.slice(
            F.array_sort(
                F.flatten(
                    F.collect_list(
                        F.transform("ids", lambda i: F.struct((-F.col("score")).alias("s"), i.alias("i")))
                    )
                )
            ),
            1,
            k + 1,
        ).alias("found")
    )
    return (
        asked.distinct()
        .join(answers, "packed")
        .select(
            F.col("vec_id").alias("query_id"),
            F.posexplode(
                F.slice(F.filter("found", lambda x: x["i"] != F.col("vec_id")), 1, k)
            ).alias("at", "one"),
        )
        .select(
            "query_id",
            (F.col("at") + 1).cast("int").alias("rank"),
            F.col("one.i").alias("vec_id"),
            (-F.col("one.s")).alias("score"),
            F.lit(recall).alias("recall"),
        )
    )
