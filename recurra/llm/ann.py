"""Nearest neighbours by inner product: an adaptive dimension scan within probed lists.

One more coordinate turns the largest inner product into the smallest Euclidean distance.
Vectors are dealt to lists by their nearest centroid; a query probes the lists nearest to it.
Within a list the vectors are rotated at random, so a few coordinates estimate the whole
distance. They are read in blocks of columns; after each block a candidate is abandoned when
its partial distance shows, at a chosen confidence, that it cannot be among the nearest. What
that is compared with is known from the start: the k-th distance to some vectors of the sample.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from recurra.llm.common import map_batches
from recurra.session import stage

#: Vectors that centroids and the number of probes are fitted on, at most about.
FIT_ROWS = 20_000
#: Candidates and queries that meet in one task, at most about.
BLOCK, QUERY_BLOCK = 4096, 512
#: Vectors of the sample, each of another id, that bound each query's k-th distance: one of so many
#: rows, so that about as many rows a query lie within the bound whatever the size, up to SEEN.
SEEN_SHARE, SEEN = 8, 8192
#: Share of pairs still near from which a block of columns is read for all pairs at once.
MANY = 0.05


@dataclass(frozen=True)
class Index:
    """What the sample gave: centroids in the rotated space, the rotation, and the probes."""

    centroids: np.ndarray
    rotation: np.ndarray
    largest: float
    probes: int
    recall: float
    seen_ids: np.ndarray
    seen: np.ndarray
    seen_lists: np.ndarray

    def rotated(self, vectors: np.ndarray, queries: bool = False) -> np.ndarray:
        rest = self.largest**2 - np.einsum("ij,ij->i", vectors, vectors)
        last = np.zeros(len(vectors)) if queries else np.sqrt(np.maximum(0.0, rest))
        return np.column_stack([vectors, last]) @ self.rotation

    def lists(self, rotated: np.ndarray, count: int) -> np.ndarray:
        """The nearest lists of each row, nearest first."""
        far = _distances(rotated, self.centroids)
        if count == 1:
            return far.argmin(axis=1)[:, None]
        return np.argsort(far, axis=1, kind="stable")[:, :count]

    def bounds(
        self, rotated: np.ndarray, ids: np.ndarray, lists: np.ndarray, k: int
    ) -> np.ndarray:
        """A distance within which each query has ``k`` candidates in the ``lists`` it probes;
        infinite if it is not known."""
        if len(self.seen) < k:
            return np.full(len(rotated), np.inf)
        probed = np.zeros((len(rotated), len(self.centroids)), bool)
        np.put_along_axis(probed, lists, True, axis=1)
        far = _distances(rotated, self.seen)
        far[(ids[:, None] == self.seen_ids[None, :]) | ~probed[:, self.seen_lists]] = np.inf
        return np.partition(far, k - 1, axis=1)[:, k - 1]


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    own = np.einsum("ij,ij->i", a, a)[:, None] + np.einsum("ij,ij->i", b, b)[None, :]
    return np.maximum(0.0, own - 2 * a @ b.T)


def usable(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Key and vector (doubles) of the rows that take part.

    Rows with a null key, and vectors null, empty, zero, with a null or non-finite component, or
    of another length than most, are left out.
    """
    finite = F.forall(
        "v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    )
    rows = (
        vectors.select(F.col(key).alias("id"), F.col(vector).cast("array<double>").alias("v"))
        .where(F.col("id").isNotNull() & F.col("v").isNotNull())
        .where(F.coalesce(finite, F.lit(False)) & F.exists("v", lambda x: x != 0))
    )
    sizes = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.where(F.size("v") == (sizes["n"] if sizes else 0))


def fit_index(
    rows: DataFrame, k: int = 20, fit_rows: int = FIT_ROWS, target: float = 0.97, seed: int = 11
) -> Index | None:
    """Centroids by k-means on a sample, and as many probes as give ``target`` recall there."""
    square = F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)
    total, largest = rows.agg(F.count(F.lit(1)), F.max(square)).first()
    if not total:
        return None
    chosen = F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(10**6)) < 10**6 * fit_rows / total
    fitted = (rows.where(chosen) if total > fit_rows else rows).select("id", "v").toArrow()
    if not fitted.num_rows:
        return None
    sample, ids = _matrix(fitted.column("v").combine_chunks()), fitted.column("id").to_numpy()
    rng = np.random.default_rng(seed)
    width = sample.shape[1] + 1
    rotation = np.linalg.qr(rng.standard_normal((width, width)))[0]
    none = np.zeros(0, np.int64), np.zeros((0, width)), np.zeros(0, np.int64)
    index = Index(np.zeros((1, width)), rotation, math.sqrt(largest), 1, 1.0, *none)
    points = index.rotated(sample)
    # A repeated id counts once, with its best score, so it bounds once.
    seen = np.random.default_rng(seed).permutation(np.unique(ids, return_index=True)[1])
    seen = seen[: min(SEEN, math.ceil(total / SEEN_SHARE))]
    count = int(min(1024, max(1, math.sqrt(total) / 2), max(1, len(points) / 16)))
    centroids = points[rng.choice(len(points), count, replace=False)]
    for _ in range(8):
        nearest = _distances(points, centroids).argmin(axis=1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, points)
        sizes = np.bincount(nearest, minlength=count)
        centroids = np.where(sizes[:, None] > 0, sums / np.maximum(1, sizes)[:, None], centroids)
    index = Index(centroids, rotation, index.largest, 1, 1.0, *none)
    homes = index.lists(points, 1)[:, 0]
    seen = ids[seen], points[seen], homes[seen]
    asked = rng.choice(len(points), min(400, len(points)), replace=False)
    turned = index.rotated(sample[asked], queries=True)
    far = _distances(turned, points)
    far[np.arange(len(asked)), asked] = np.inf
    nearest = np.argsort(far, axis=1)[:, : min(k, max(1, len(points) - 1))]
    order = index.lists(turned, count)
    place = np.empty_like(order)
    np.put_along_axis(place, order, np.arange(count)[None, :].repeat(len(asked), 0), axis=1)
    rank = np.sort(np.take_along_axis(place, homes[nearest], axis=1).ravel())
    probes = int(rank[min(len(rank) - 1, math.ceil(target * len(rank)) - 1)]) + 1
    return Index(centroids, rotation, index.largest, probes, float((rank < probes).mean()), *seen)


def _matrix(vectors: pa.Array) -> np.ndarray:
    """The rows of an array of lists of one length."""
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(vectors), -1)


def scan(
    index: Index, ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray,
    queries: np.ndarray, limit: np.ndarray, k: int, columns: int = 16, confidence: float = 2.1,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query numbers, candidate numbers and scores of the ``k`` nearest found of each query within
    its ``limit``."""
    points, turned = index.rotated(vectors), index.rotated(queries, queries=True)
    width = points.shape[1]
    own = query_ids[:, None] == ids[None, :]
    # What rounding may add to a distance that comes from products.
    rounding = 1e-12 + 1e-14 * width * (index.largest**2 + (turned**2).sum(axis=1))

    def near(partial, limits, error, read):  # the partial distance, scaled up, with its slack
        slack = (1 + confidence / math.sqrt(read)) ** 2 if read < width else 1 + 1e-9
        return partial * (width / read) <= limits * slack + error

    partial, alive, read = np.zeros(own.shape), ~own, 0
    while read < width and (not read or alive.mean() > MANY):
        block = slice(read, min(read + columns, width))
        partial += _distances(turned[:, block], points[:, block])
        read = block.stop
        alive &= near(partial, limit[:, None], rounding[:, None], read)
    q, x = np.nonzero(alive)
    partial = partial[q, x]
    while read < width and len(q):
        block = slice(read, min(read + columns, width))
        partial = partial + ((turned[q, block] - points[x, block]) ** 2).sum(axis=1)
        read = block.stop
        kept = near(partial, limit[q], rounding[q], read)
        q, x, partial = q[kept], x[kept], partial[kept]
    score = (queries[q] * vectors[x]).sum(axis=1)
    order = np.lexsort((ids[x], -score, q))
    q, x, score = q[order], x[order], score[order]
    place = np.arange(len(q)) - np.searchsorted(q, q)
    return q[place < k], x[place < k], score[place < k]


def _salted(counts: DataFrame, size: int) -> dict[int, int]:
    """Parts per list, of about ``size`` rows; there are at most 1,024 lists."""
    return {r["list"]: math.ceil(r["count"] / size) for r in counts.collect()}


def search(
    vectors: DataFrame, is_query, k: int = 20, key: str = "vec_id", vector: str = "embedding",
    **fit,
) -> DataFrame:
    """Per query: query_id, rank (from 1), the key as vec_id, and the inner product as score.

    ``is_query`` is a condition on the column ``id``. All other rows are candidates, nearest
    first, ties to the smaller id; fewer than ``k`` rows where there are fewer candidates.
    Rows that cannot take part are left out (see ``usable``), a repeated key counts once with
    its best score, an empty table gives no row, and other columns are left out. Hot lists
    (thousands of equal vectors) are dealt to parts of ``BLOCK`` vectors and ``QUERY_BLOCK``
    queries, and each pair of parts is one task's group.
    """
    spark = vectors.sparkSession
    rows = usable(vectors, key, vector)
    schema = "query_id long, `rank` int, vec_id long, score double"
    index = fit_index(rows, k, **fit)
    if index is None:
        return spark.createDataFrame([], schema)

    def deal(count: int, queries: bool):
        def run(batch):
            points = _matrix(batch.column("v"))
            turned = index.rotated(points, queries)
            lists = index.lists(turned, count)
            at = np.repeat(np.arange(len(points)), lists.shape[1])
            made = {
                "list": lists.ravel(), "id": batch.column("id").take(at),
                "v": batch.column("v").take(at),
            }
            if queries:
                ids = batch.column("id").to_numpy()
                # Of twice as many, so that some may be abandoned by mistake.
                made["within"] = index.bounds(turned, ids, lists, 2 * k)[at]
            return made

        return run

    dealt = "`list` int, id long, v array<double>"
    rows = rows.withColumn("id", F.col("id").cast("long"))
    homes = stage(map_batches(rows, dealt, deal(1, False)), "ann-lists")
    bounded = f"{dealt}, within double"
    asked = stage(map_batches(rows.where(is_query), bounded, deal(index.probes, True)), "ann-probes")
    parts = _salted(homes.groupBy("list").count(), BLOCK)
    query_parts = _salted(asked.groupBy("list").count(), QUERY_BLOCK)

    def of(table: dict[int, int]):
        filled = [table.get(i, 1) for i in range(len(index.centroids))]
        return F.element_at(F.array(*map(F.lit, filled)), F.col("list") + 1)

    def spread(n):  # all parts of the other side
        return F.explode(F.sequence(F.lit(0), n - 1))

    left = homes.withColumn("part", F.pmod(F.xxhash64("id"), of(parts)).cast("int"))
    left = left.withColumn("query_part", spread(of(query_parts)))
    right = asked.withColumn(
        "query_part", F.pmod(F.xxhash64("id"), of(query_parts)).cast("int")
    ).withColumn("part", spread(of(parts)))

    def meet(candidates: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if not len(candidates) or not len(queries):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        ids, query_ids = candidates["id"].to_numpy(), queries["id"].to_numpy()
        q, x, score = scan(
            index, ids, np.stack(candidates["v"]), query_ids, np.stack(queries["v"]),
            queries["within"].to_numpy(), k,
        )
        return pd.DataFrame({"query_id": query_ids[q], "vec_id": ids[x], "score": score})

    keys = ["list", "part", "query_part"]
    found = (
        left.groupBy(*keys).cogroup(right.groupBy(*keys))
        .applyInPandas(meet, "query_id long, vec_id long, score double")
        .groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    )
    nearest = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(nearest)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
