"""Centroid clustering with an incremental matrix of exact integer products.

Every vector carries its dot product with each centroid. When a centroid moves, the products are corrected by the
components that changed, never computed anew, and the nearest centroid follows from them. Only the centroids,
``clusters`` times ``SIZE`` integers, pass through the driver.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockline.llm.common import list_column, slices

SIZE, CLUSTERS, ROUNDS, SCALE, SEED = 64, 8, 10, 1024, 3
# 64 squares of differences below 2**28 stay below 2**62, so every distance is an exact long.
LARGEST = 1 << 27
POINTS = "vec_id bigint, point array<int>"
STATE = "vec_id bigint, point array<int>, dots array<bigint>, cluster int, distance bigint"
SUMS = "cluster int, place int, total bigint"


def integer_vectors(vectors: DataFrame, size: int = SIZE, scale: int = SCALE) -> DataFrame:
    """(vec_id, point): floor(scale * x) of each component of the vectors that count.

    * A vector that is null, has another number of components, or a null or non-finite one, is left out.
    * Repeated rows come out each; a null vec_id stays; extra columns are not read; empty in, empty out.
    * A component of ``LARGEST`` or more after scaling raises an error, as a long could not hold its distances.
    """
    x = F.col("embedding")
    sound = F.forall(x, lambda v: F.coalesce(~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))), F.lit(False)))
    scaled = F.transform(x, lambda v: v.cast("double") * scale)
    small = F.forall(scaled, lambda v: F.abs(v) < LARGEST)
    point = F.when(small, F.transform(scaled, lambda v: F.floor(v).cast("int"))) \
        .otherwise(F.raise_error(F.lit("a component is too large for exact distances")))
    return vectors.where((F.size(x) == size) & sound).select(F.col("vec_id").cast("bigint").alias("vec_id"), point.alias("point"))


def first_centroids(points: DataFrame, clusters: int = CLUSTERS, seed: int = SEED) -> np.ndarray:
    """The points with the smallest SHA-256 of ``seed:vec_id``; among rows with one id, the smallest points."""
    rank = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = points.orderBy(rank.asc_nulls_last(), "point").limit(clusters).collect()  # one row per centroid
    return np.array([r["point"] for r in rows], np.int64)


def _columns(batch) -> np.ndarray:
    """The points of a batch as a matrix."""
    points = batch.column(1)
    return points.flatten().to_numpy().astype(np.int64).reshape(len(points), -1)


def _nearest(points: np.ndarray, dots: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    far = (points * points).sum(1)[:, None] - 2 * dots + (centroids * centroids).sum(1)
    cluster = far.argmin(1)  # the first of equals
    return cluster, far[np.arange(len(far)), cluster]


def corrected(state: DataFrame, before: np.ndarray, after: np.ndarray) -> DataFrame:
    """The state with its products moved from the centroids ``before`` to ``after``, and the clusters that follow.

    A frame without products starts from centroids of zeros.
    """
    moves = [(j, np.flatnonzero(after[j] != before[j])) for j in range(len(after))]
    moves = [(j, places, (after[j] - before[j])[places]) for j, places in moves if len(places)]

    def run(batches):
        for batch in slices(batches, 8192):
            points = _columns(batch)
            if batch.num_columns > 2:
                dots = batch.column(2).flatten().to_numpy().reshape(len(points), -1).copy()
            else:
                dots = np.zeros((len(points), len(after)), np.int64)
            for j, places, change in moves:
                dots[:, j] += points[:, places] @ change
            cluster, distance = _nearest(points, dots, after)
            width = [len(after)] * len(points)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), list_column(width, dots.ravel(), pa.int64()),
                pa.array(cluster.astype(np.int32)), pa.array(distance)], ["vec_id", "point", "dots", "cluster", "distance"])

    kept = ["vec_id", "point"] + (["dots"] if "dots" in state.columns else [])
    return state.select(*kept).mapInArrow(run, STATE)


def cluster_sums(state: DataFrame) -> dict[int, tuple[int, int, list[int]]]:
    """Of every cluster: its vectors, their summed distance and summed components.

    A task sends one row per cluster and place, however many vectors it reads; so much, added up, reaches the driver.
    """
    def run(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in slices(batches, 8192):
            points, cluster = _columns(batch), batch.column(2).to_numpy()
            wide = np.column_stack([np.ones(len(points), np.int64), batch.column(3).to_numpy(), points])
            for j in np.unique(cluster):
                part = wide[cluster == j].sum(0)
                sums[int(j)] = sums[int(j)] + part if int(j) in sums else part
        for j, total in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(total), j, np.int32)), pa.array(np.arange(len(total), dtype=np.int32)),
                                              pa.array(total)], ["cluster", "place", "total"])

    rows = state.select("vec_id", "point", "cluster", "distance").mapInArrow(run, SUMS) \
        .groupBy("cluster", "place").agg(F.sum("total").alias("total")).collect()
    out: dict[int, dict[int, int]] = {}
    for r in rows:
        out.setdefault(r["cluster"], {})[r["place"]] = r["total"]
    return {j: (s[0], s[1], [s[i] for i in range(2, len(s))]) for j, s in out.items()}


def clusters_of(vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, size: int = SIZE,
                scale: int = SCALE, seed: int = SEED) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of every vector that counts.

    The products of a round are kept on the executors while the next round is built from them; what a lost executor
    held is computed again from the vectors. Rounds end early where no centroid moves, as the rest would change nothing.

    * See ``integer_vectors`` for rows that are left out. With fewer vectors than ``clusters`` there are so many
      centroids. Equal distances go to the smaller number; repeated rows are clustered each. Empty in, empty out.
    """
    spark = vectors.sparkSession
    points = integer_vectors(vectors, size, scale)
    centroids = first_centroids(points, clusters, seed)
    schema = "vec_id bigint, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
    if not len(centroids):
        return spark.createDataFrame([], schema)
    state = corrected(points, np.zeros_like(centroids), centroids).persist(StorageLevel.MEMORY_AND_DISK)
    sums = cluster_sums(state)
    for _ in range(rounds):
        moved = centroids.copy()
        for j, (n, _, total) in sums.items():
            moved[j] = [t // n for t in total]
        if (moved == centroids).all():
            break
        following = corrected(state, centroids, moved).persist(StorageLevel.MEMORY_AND_DISK)
        sums = cluster_sums(following)
        state.unpersist()
        state, centroids = following, moved
    inertia = sum(s[1] for s in sums.values())
    facts = [(j, s[1], inertia, hashlib.sha256(",".join(map(str, centroids[j].tolist())).encode()).hexdigest()) for j, s in sums.items()]
    known = spark.createDataFrame(facts, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return state.join(known, "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
