"""Centroid clustering by n-simplex projection: apex coordinates filter centroids, integers decide.

Distances to some pivots fix where a vector stands over the simplex that the
pivots span: all apex coordinates but the last are its place in the base, the
last is its height over it.  The Euclidean distance of two apexes is at most that
of the vectors; with the height of one of them turned below the base it is at
least that.  Apexes are computed once and written with the vectors.  A round
takes the least upper bound of a vector over all centroids, leaves out centroids
whose lower bound is above it, and compares the rest in integers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowvec.llm.common import write_table

CLUSTERS = 40
ROUNDS = 5
SCALE = 256
PIVOTS = 32
# Components beyond this could carry a squared distance out of a long.
LARGEST = 1 << 27
# Pairs of a vector and a centroid that are compared at once.
PAIRS_AT_ONCE = 65_536


@dataclass(frozen=True)
class Simplex:
    """Pivots and the corners they have in their own space, a lower triangle."""

    pivots: np.ndarray
    corners: np.ndarray

    @staticmethod
    def over(points: np.ndarray, most: int = PIVOTS) -> Simplex:
        """Pivots among ``points``: each next one stands highest over those before; flat ones are left out."""
        points = np.asarray(points, np.float64)
        chosen, corners = [0], np.zeros((1, 0))
        while len(chosen) < min(most, len(points)):
            apexes = Simplex(points[chosen], corners).apexes(points)
            heights = apexes[:, -1]
            best = int(np.argmax(heights))
            if heights[best] <= 1e-6 * (1 + np.abs(points).max()):
                break
            corners = np.vstack([np.pad(corners, ((0, 0), (0, 1))), apexes[best]])
            chosen.append(best)
        return Simplex(points[chosen], corners)

    def apexes(self, vectors: np.ndarray) -> np.ndarray:
        """Apex coordinates of each vector from its distances to the pivots, the height last."""
        vectors = np.asarray(vectors, np.float64)
        squares = np.stack([((vectors - p) ** 2).sum(1) for p in self.pivots], 1)
        n = len(self.pivots)
        apex = np.zeros((len(vectors), n))
        # The first corner is the origin; corner i has i coordinates, the last of them its height.
        for i in range(1, n):
            corner = self.corners[i, :i]
            inner = (squares[:, 0] + (corner**2).sum() - squares[:, i]) / 2
            apex[:, i - 1] = (inner - apex[:, : i - 1] @ corner[:-1]) / corner[-1]
        apex[:, -1] = np.sqrt(np.maximum(squares[:, 0] - (apex[:, :-1] ** 2).sum(1), 0))
        return apex


def bounds(apexes: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Squared lower and upper bounds of all distances between two sets of apexes."""
    lower = (apexes**2).sum(1)[:, None] + (centres**2).sum(1) - 2 * (apexes @ centres.T)
    return lower, lower + 4 * np.outer(apexes[:, -1], centres[:, -1])


def nearest(vectors: np.ndarray, apexes: np.ndarray, centroids: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Number and squared distance of the nearest centroid of each vector, and the pairs compared.

    Of equally near centroids the one with the smaller number is taken.
    """
    lower, upper = bounds(apexes, centres)
    # Bounds are floating point: the slack is far above their rounding, so no centroid is lost to it.
    slack = 1e-6 * (1 + (apexes**2).sum(1).max(initial=0) + (centres**2).sum(1).max(initial=0))
    row, number = np.nonzero(lower <= upper.min(1, keepdims=True) + slack)
    distance = np.empty(len(row), np.int64)
    for i in range(0, len(row), PAIRS_AT_ONCE):
        some = slice(i, i + PAIRS_AT_ONCE)
        apart = vectors[row[some]] - centroids[number[some]]
        distance[some] = np.einsum("ij,ij->i", apart, apart)
    starts = np.searchsorted(row, np.arange(len(vectors)))
    best = np.minimum.reduceat(distance, starts) if len(row) else distance
    # Pairs are in order of row and number: the first that reaches the best has the smallest number.
    hit = np.flatnonzero(distance == best[row])
    first = hit[np.unique(row[hit], return_index=True)[1]]
    return number[first], best, len(row)


def _kept(vec: Column, width: int) -> Column:
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    return F.coalesce((F.size(vec) == width) & F.forall(vec, fine), F.lit(False))


def integers(cells: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """``floor(scale * x)`` of each component as a long."""
    found = np.floor(np.asarray(cells, np.float64) * scale)
    if len(found) and np.abs(found).max() > LARGEST:
        raise OverflowError(f"a component times {scale} is beyond {LARGEST}: squared distances would not fit a long")
    return found.astype(np.int64)


def _matrix(column: pa.Array, width: int, kind) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width).astype(kind, copy=False)


def _lists(cells: np.ndarray) -> pa.Array:
    return pa.FixedSizeListArray.from_arrays(pa.array(np.ascontiguousarray(cells).ravel()), cells.shape[1]).cast(pa.list_(pa.from_numpy_dtype(cells.dtype)))


@dataclass(frozen=True)
class Clusters:
    """Vectors with their apexes, the final centroids, and how many pairs the filter let through."""

    rows: DataFrame
    centroids: np.ndarray
    compared: int
    all_pairs: int


def _assigning(simplex: Simplex, centroids: np.ndarray, width: int) -> Callable:
    centres = simplex.apexes(centroids)

    def assigned(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        vectors = _matrix(batch.column("cells"), width, np.int64)
        apexes = _matrix(batch.column("apex"), len(simplex.pivots), np.float64)
        return vectors, *nearest(vectors, apexes, centroids, centres)

    return assigned


def _sums(rows: DataFrame, simplex: Simplex, centroids: np.ndarray, width: int) -> list:
    """Per centroid: vectors, componentwise sums, summed distance, pairs compared; one row a task and centroid is shuffled."""
    assigned = _assigning(simplex, centroids, width)
    k = len(centroids)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total, pairs = np.zeros(k, np.int64), np.zeros((k, width), np.int64), 0
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors, number, _, compared = assigned(batch)
            n += np.bincount(number, minlength=k)
            np.add.at(total, number, vectors)
            pairs += compared
        if n.any():
            shares = np.zeros(k, np.int64)
            shares[0] = pairs
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(k, dtype=np.int32)), pa.array(n), pa.array(shares), *(pa.array(total[:, i]) for i in range(width))], names)

    columns = [f"s{i}" for i in range(width)]
    names = ["number", "n", "pairs", *columns]
    schema = "number int, n long, pairs long, " + ", ".join(f"{c} long" for c in columns)
    parts = rows.select("cells", "apex").mapInArrow(work, schema)
    return parts.groupBy("number").agg(*(F.sum(c).alias(c) for c in names[1:])).collect()


def cluster(
    vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, scale: int = SCALE, width: int = 64, pivots: int = PIVOTS, salt: str = "2:",
    id_col: str = "vec_id", vec_col: str = "embedding",
) -> Clusters:
    """Lloyd rounds in integers over all vectors of ``width`` finite components.

    Other rows (null vectors, another width, null or non-finite components) are
    left out.  Repeated rows and ids are vectors of their own; a null id seeds
    last, equal seeds are ordered by their components.  Fewer vectors than
    ``clusters`` give that many centroids; an empty table gives none and no rows.
    Other columns are not read.  Components whose squares would not fit a long raise.
    """
    vec = F.col(vec_col).cast("array<double>")
    kept = vectors.select(F.col(id_col).cast("long").alias("vec_id"), vec.alias("_v")).where(_kept(F.col("_v"), width))
    # Written and read again: the limit is then taken by a shuffle, task by task, and only its rows travel.
    by_hash = F.sha2(F.concat(F.lit(salt), F.col("vec_id").cast("string")).cast("binary"), 256)
    seeds = write_table(kept.select(by_hash.alias("hash"), "_v").orderBy(F.col("hash").asc_nulls_last(), "_v").limit(clusters), "seeds")
    first = sorted(seeds.collect(), key=lambda r: (r["hash"] is None, r["hash"] or "", r["_v"]))
    centroids = integers(np.array([r["_v"] for r in first], np.float64).reshape(-1, width), scale)
    if not len(centroids):
        return Clusters(_empty(kept), centroids, 0, 0)
    simplex = Simplex.over(centroids, pivots)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = integers(_matrix(batch.column("_v"), width, np.float64), scale)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), _lists(cells.astype(np.int32)), _lists(simplex.apexes(cells))], ["vec_id", "cells", "apex"])

    rows = write_table(kept.mapInArrow(project, "vec_id long, cells array<int>, apex array<double>"), "apexes")
    compared = met = 0
    for _ in range(rounds):
        moved = centroids.copy()
        for found in _sums(rows, simplex, centroids, width):
            if found["n"]:
                moved[found["number"]] = [found[f"s{i}"] // found["n"] for i in range(width)]
            compared += found["pairs"]
            met += found["n"] * len(centroids)
        if (moved == centroids).all():
            # Nothing moved, so nothing would in the rounds left.
            break
        centroids = moved
    assigned = _assigning(simplex, centroids, width)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, number, distance, _ = assigned(batch)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(number.astype(np.int32)), pa.array(distance)], ["vec_id", "cluster", "distance"])

    final = write_table(rows.mapInArrow(assign, "vec_id long, cluster int, distance long"), "assigned")
    return Clusters(final, centroids, compared, met)


def _empty(kept: DataFrame) -> DataFrame:
    return kept.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")).limit(0)


def cluster_report(vectors: DataFrame, **how) -> DataFrame:
    """One row per clustered vector: cluster, squared distance, inertia of its cluster and of all, digest of its centroid.

    Rows and awkward values are as in ``cluster``.
    """
    found = cluster(vectors, **how)
    per = {r["cluster"]: r["inertia"] for r in found.rows.groupBy("cluster").agg(F.sum("distance").alias("inertia")).collect()}
    about = [
        (i, int(per.get(i, 0)), int(sum(per.values())), hashlib.sha256(",".join(map(str, c)).encode()).hexdigest())
        for i, c in enumerate(found.centroids.tolist())
    ]
    spark = vectors.sparkSession
    table = spark.createDataFrame(about, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    # One row per centroid: as many as the ``clusters`` parameter says.
    return found.rows.join(F.broadcast(table), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
