"""Centroid clustering of integer vectors, with Orchard's search for the nearest centroid."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverlode.llm.common import stored

DIMENSIONS = 64
SCALE = 256
CLUSTERS = 40
ROUNDS = 5
SEED = "2"
# Scaled components stay below this, so that squared distances, and four times them, fit 64 bits.
LARGEST = 1 << 26
ROWS_PER_STEP = 8192


class Orchard:
    """Centroids, each with a list of all by distance from it."""

    def __init__(self, centroids: np.ndarray) -> None:
        self.centroids = centroids
        self._apart = np.stack([_squared(centroids - c) for c in centroids])
        self._lists = np.argsort(self._apart, axis=1, kind="stable")

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number and squared distance of the nearest centroid (the least number of equals) of each vector.

        All vectors go side by side, one look at a list at a time. A vector follows the list of its best centroid;
        a closer one (or an equal one of smaller number) is jumped to, and its list begun. A centroid that lies
        strictly beyond twice the distance from the best one is farther from the vector than that, and so are those
        behind it in the list. No centroid's distance is computed twice.
        """
        n, k = len(vectors), len(self.centroids)
        best = np.zeros(n, np.int64)
        distance = _squared(vectors - self.centroids[0])
        seen = np.zeros((n, k), bool)
        seen[:, 0] = True
        place = np.zeros(n, np.int64)
        going = np.arange(n)
        while len(going):
            candidate = self._lists[best[going], place[going]]
            near = self._apart[best[going], candidate] <= 4 * distance[going]
            going, candidate = going[near], candidate[near]
            place[going] += 1
            new = ~seen[going, candidate]
            row, candidate = going[new], candidate[new]
            seen[row, candidate] = True
            found = _squared(vectors[row] - self.centroids[candidate])
            closer = (found < distance[row]) | ((found == distance[row]) & (candidate < best[row]))
            row = row[closer]
            best[row], distance[row], place[row] = candidate[closer], found[closer], 0
            going = going[place[going] < k]
        return best, distance


def _squared(differences: np.ndarray) -> np.ndarray:
    return np.einsum("ij,ij->i", differences, differences)


def cluster(
    vectors: DataFrame,
    keep: list[str] | None = None,
    key: str = "vec_id",
    vector: str = "embedding",
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    dimensions: int = DIMENSIONS,
    scale: int = SCALE,
    seed: str = SEED,
    out: str = "centroid",
) -> DataFrame:
    """The columns ``keep`` (all by default) of every vector, and a struct ``out`` with what it is assigned to.

    ``out`` holds ``cluster`` and ``distance`` (squared), ``cluster_inertia`` and ``inertia`` (distances summed over the
    cluster and over all), and the final ``components``. A component x counts as floor(scale * x). The first
    centroids are the vectors of least SHA-256 of seed, colon and key; a round assigns all vectors and puts the floor
    of its vectors' mean in the place of each centroid that has any; after the last round all are assigned once more.

    A round is one pass over the vectors without an exchange of them: a task returns one row of sums per cluster,
    however many vectors it has, so a cluster that holds most rows is nothing special. The driver holds the centroids
    alone. Assignments are written once, at the end.

    Vectors that are null, of another length, hold null or non-finite components, or such that do not fit below 2^26
    when scaled, are left out. Null keys hash like the empty text, and vectors of equal hash are ordered by their
    components; repeated rows are assigned alike, each counted; fewer vectors than ``clusters`` make as many
    centroids; no vectors give no rows. A sum of distances beyond 64 bits is null. Other columns are carried, but for one
    named ``out``, which is replaced. No cell is longer than ``dimensions``, so no row is large by itself.
    """
    columns = [c for c in (vectors.columns if keep is None else keep) if c != out]
    rows = vectors.where(_fits(F.col(vector), dimensions, scale)).select(
        F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"),
        F.col(vector).alias("vector"),
        F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))), 256).alias("hash"),
    )
    first = rows.select("hash", "vector").orderBy("hash", "vector").limit(clusters).collect()
    schema = T.StructType([rows.schema["row"], T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType())])
    if not first:
        centroids = np.zeros((0, dimensions), np.int64)
        assigned = rows.sparkSession.createDataFrame([], schema)
    else:
        centroids = _scaled(np.array([r.vector for r in first], float), scale)
        for _ in range(rounds):
            centroids = _moved(rows.select("vector"), centroids, scale)
        assigned = stored(_assigned(rows.select("row", "vector"), centroids, scale, schema), "assigned")
    own = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("own")).collect()
    total = sum(r.own for r in own)
    table = [(r.cluster, _long(r.own), _long(total), centroids[r.cluster].tolist()) for r in own]
    known = rows.sparkSession.createDataFrame(
        table, "cluster int, cluster_inertia long, inertia long, components array<bigint>"
    )
    return assigned.join(F.broadcast(known), "cluster").select(  # a row per cluster
        "row.*",
        F.struct("cluster", "distance", "cluster_inertia", "inertia", "components").alias(out),
    )


def _fits(vector: Column, dimensions: int, scale: int) -> Column:
    small = F.forall(vector, lambda x: F.abs(x.cast("double")) < LARGEST / scale)  # NaN is above all numbers
    return (F.size(vector) == dimensions) & small


def _scaled(components: np.ndarray, scale: int) -> np.ndarray:
    return np.floor(scale * components.astype(np.float64)).astype(np.int64)


def _long(number: int) -> int | None:
    return int(number) if number < 1 << 63 else None


def _steps(batch: pa.RecordBatch, orchard: Orchard, scale: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
    for begin in range(0, batch.num_rows, ROWS_PER_STEP):
        piece = batch.slice(begin, ROWS_PER_STEP)
        column = piece.column(piece.schema.get_field_index("vector"))
        vectors = _scaled(column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1), scale)
        yield piece, vectors, *orchard.nearest(vectors)


def _moved(vectors: DataFrame, centroids: np.ndarray, scale: int) -> np.ndarray:
    """The centroids after one round."""
    k, dimensions = centroids.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        orchard = Orchard(centroids)
        total, size = np.zeros((k, dimensions), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            for _, rows, best, _ in _steps(batch, orchard, scale):
                np.add.at(total, best, rows)
                size += np.bincount(best, minlength=k)
        any_ = np.flatnonzero(size)
        yield pa.RecordBatch.from_arrays(
            [pa.array(any_.astype(np.int32)), pa.array(size[any_]), pa.array(total[any_].tolist(), pa.list_(pa.int64()))],
            ["cluster", "size", "total"],
        )

    parts = vectors.mapInArrow(sums, "cluster int, size long, total array<bigint>")
    exact = "decimal(38,0)"
    sizes = parts.select("cluster", "size", F.posexplode("total").alias("at", "total"))
    moved = centroids.copy()
    for r in sizes.groupBy("cluster", "at").agg(F.sum("size").alias("size"), F.sum(F.col("total").cast(exact)).alias("total")).collect():
        moved[r.cluster, r["at"]] = int(r.total) // r["size"]
    return moved


def _assigned(rows: DataFrame, centroids: np.ndarray, scale: int, schema: T.StructType) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        orchard = Orchard(centroids)
        for batch in batches:
            for piece, _, best, distance in _steps(batch, orchard, scale):
                row = piece.column(piece.schema.get_field_index("row"))
                yield pa.RecordBatch.from_arrays(
                    [row, pa.array(best.astype(np.int32)), pa.array(distance)], ["row", "cluster", "distance"]
                )

    return rows.mapInArrow(run, schema)
