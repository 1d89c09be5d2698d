"""Clustering around centroids; the nearest one is found by walking sorted lists outward.

For every dimension the centroids are listed by their value. A vector starts at its own value
in each list and walks outward, so that the next centroid in a list is the nearest one left in
that dimension. A centroid met for the first time is measured exactly. The squared distances
to the frontiers add up to what any centroid not met yet has at least; once that is more than
the best exact distance, nothing nearer is left, and nothing as near.
"""

from __future__ import annotations

import hashlib
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import done_with, stored

DIMENSIONS = 64
CLUSTERS = 8
ROUNDS = 10
SCALE = 1024
SEED = "3"
# Components beyond this count as this: squared distances then fit 64 bits whatever comes.
LARGEST = 1 << 27
# Vectors measured side by side.
BLOCK = 4096


def as_integers(vectors: DataFrame, dimensions=DIMENSIONS, scale=SCALE) -> DataFrame:
    """``vec_id, at``: vectors of finite components as whole numbers, others left out."""
    x = F.col("embedding")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))

    def whole(v):
        bounded = F.greatest(F.lit(float(-LARGEST)), F.least(F.lit(float(LARGEST)), F.lit(float(scale)) * v))
        return F.floor(bounded).cast("int")

    kept = vectors.where(F.size(x) == dimensions).select("vec_id", x.cast("array<double>").alias("embedding"))
    return kept.where(finite).select("vec_id", F.transform("embedding", whole).alias("at"))


class Lists:
    """The centroids, listed by their value in each dimension."""

    def __init__(self, centroids):
        self.centroids = np.array(centroids, np.int64)
        self.order = np.argsort(self.centroids, axis=0, kind="stable").T
        self.values = np.take_along_axis(self.centroids.T, self.order, axis=1)

    def nearest(self, vectors):
        """For each vector the nearest centroid, the smaller number in a tie, and the squared distance."""
        best = np.full(len(vectors), np.iinfo(np.int64).max)
        found = np.full(len(vectors), -1, np.int64)
        k, dimensions = self.centroids.shape
        met = np.zeros((len(vectors), k), bool)
        # Places of the next value below and the next one from there up, per vector and dimension.
        up = np.empty(vectors.shape, np.int64)
        for d in range(dimensions):
            up[:, d] = np.searchsorted(self.values[d], vectors[:, d])
        down = up - 1
        rows, all_dimensions = np.arange(len(vectors)), np.arange(dimensions)
        for _ in range(k):
            here = vectors[rows]
            below = here - self.values[all_dimensions, np.maximum(down, 0)]
            above = self.values[all_dimensions, np.minimum(up, k - 1)] - here
            go_up = (down < 0) | ((up < k) & (above <= below))
            frontier = np.where(go_up, above, below)
            reached = self.order[all_dimensions, np.where(go_up, up, down)]
            up += go_up
            down -= ~go_up
            fresh = np.zeros((len(rows), k), bool)
            fresh[np.arange(len(rows))[:, None], reached] = True
            fresh &= ~met[rows]
            met[rows] |= fresh
            for c in range(k):
                new = np.flatnonzero(fresh[:, c])
                apart = here[new] - self.centroids[c]
                exact, at = np.einsum("ij,ij->i", apart, apart), rows[new]
                better = (exact < best[at]) | ((exact == best[at]) & (c < found[at]))
                best[at[better]], found[at[better]] = exact[better], c
            left = np.einsum("ij,ij->i", frontier, frontier) <= best[rows]
            if not left.any():
                break
            rows, up, down = rows[left], up[left], down[left]
        return found, best


def _vectors(batch, dimensions):
    """The vectors of a batch, some at a time, as rows of an array."""
    for start in range(0, batch.num_rows, BLOCK):
        part = batch.slice(start, BLOCK)
        flat = part.column("at").flatten().to_numpy(zero_copy_only=False)
        yield part, flat.astype(np.int64).reshape(-1, dimensions)


def _sum_clusters(centroids):
    """Per task and cluster: how many vectors are nearest, and the sum in each dimension."""
    k, dimensions = centroids.shape

    def run(batches):
        lists = Lists(centroids)
        count, sums = np.zeros(k, np.int64), [[0] * dimensions for _ in range(k)]
        for batch in batches:
            for _, vectors in _vectors(batch, dimensions):
                found, _ = lists.nearest(vectors)
                count += np.bincount(found, minlength=k)
                for c in np.unique(found):
                    of_block = vectors[found == c].sum(axis=0).tolist()
                    sums[c] = [a + b for a, b in zip(sums[c], of_block)]
        rows = [(c, d, int(count[c]), sums[c][d]) for c in range(k) if count[c] for d in range(dimensions)]
        columns = list(zip(*rows)) or [(), (), (), ()]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int32()),
                pa.array(columns[2], pa.int64()),
                pa.array(map(Decimal, columns[3]), pa.decimal128(38, 0)),
            ],
            names=["cluster", "dimension", "vectors", "total"],
        )

    return run


def _assign(centroids):
    k, dimensions = centroids.shape

    def run(batches):
        lists = Lists(centroids)
        for batch in batches:
            for part, vectors in _vectors(batch, dimensions):
                found, apart = lists.nearest(vectors)
                yield pa.RecordBatch.from_arrays(
                    [part.column("vec_id"), pa.array(found, pa.int32()), pa.array(apart, pa.int64())],
                    names=["vec_id", "cluster", "distance"],
                )

    return run


def _moved(vectors: DataFrame, centroids):
    """Each centroid in the middle of its vectors, rounded down; one without vectors stays.

    What comes to the driver is one row per cluster and dimension.
    """
    sums = vectors.mapInArrow(
        _sum_clusters(centroids), "cluster int, dimension int, vectors long, total decimal(38,0)"
    )
    moved = centroids.copy()
    for row in sums.groupBy("cluster", "dimension").agg(
        F.sum("vectors").alias("vectors"), F.sum("total").alias("total")
    ).collect():
        moved[row.cluster, row.dimension] = int(row.total) // row.vectors
    return moved


def cluster(
    vectors: DataFrame, clusters=CLUSTERS, rounds=ROUNDS, dimensions=DIMENSIONS, seed=SEED,
) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` of every kept vector.

    Kept are vectors of exactly ``dimensions`` finite components. The first centroids are those with
    the least SHA-256 of ``seed:vec_id`` (a null ``vec_id`` is empty there), among rows of one
    ``vec_id`` those with the least components; fewer vectors make fewer centroids, none make no
    rows. Repeated rows count each; other columns are not read. A component beyond ``LARGEST`` after
    scaling counts as that.
    """
    kept = stored(as_integers(vectors, dimensions), "vectors")
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    first = kept.select(name.alias("name"), "at").orderBy("name", "at").limit(clusters).collect()
    places = np.array([row["at"] for row in first], np.int64).reshape(len(first), dimensions)
    schema = T.StructType([
        vectors.schema["vec_id"], T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType()),
    ])
    if first:
        for _ in range(rounds):
            places = _moved(kept, places)
        assigned = stored(kept.mapInArrow(_assign(places), schema), "assigned-vectors")
    else:
        assigned = vectors.sparkSession.createDataFrame([], schema)
    done_with(kept)
    return _with_sums(assigned, places)


def _with_sums(assigned, places):
    """Add each cluster's figures, which are one row per cluster, to its vectors."""
    sums = {row.cluster: int(row.total) for row in assigned.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")
    ).collect()}
    figures = assigned.sparkSession.createDataFrame(
        [
            (c, sums[c], sum(sums.values()), hashlib.sha256(",".join(map(str, place)).encode()).hexdigest())
            for c, place in enumerate(places.tolist()) if c in sums
        ],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string",
    )
    return assigned.join(F.broadcast(figures), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
