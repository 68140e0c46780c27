"""Centroid clustering by bisector tournaments, in exact integer arithmetic.

The points nearer to centroid a than to b lie on one side of the plane between them, so a
pair is decided by the sign of one linear form: normal 2(b - a), threshold |b|^2 - |a|^2.
k - 1 such tests, winner against the next centroid, leave the nearest one; a zero favours
the smaller number.  Only the winner's distance is computed.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from tidemark.llm.ranks import stored

#: Components up to this size keep all sums of a vector's test and distance inside 64 bits.
_LARGEST = 1 << 26
_TOTALS = "cluster int, place int, total decimal(38,0), n long"


def integer_vectors(vectors: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) of every component, ``x`` as double."""
    scaled = np.floor(vectors.astype(np.float64) * scale)
    if scaled.size and np.abs(scaled).max() > _LARGEST:
        raise OverflowError(f"a component is larger than {_LARGEST} / {scale}")
    return scaled.astype(np.int64)


class Bisectors:
    """Normals and thresholds of all pairs of centroids."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids
        self.normals = 2 * (centroids[None, :, :] - centroids[:, None, :])
        squares = (centroids * centroids).sum(axis=1)
        self.thresholds = squares[None, :] - squares[:, None]

    def nearest(self, points: np.ndarray) -> np.ndarray:
        """Number of each point's nearest centroid; the smaller one of those equally near."""
        best = np.zeros(len(points), dtype=np.int64)
        for rival in range(1, len(self.centroids)):
            side = np.einsum("ij,ij->i", points, self.normals[best, rival]) - self.thresholds[best, rival]
            best[side > 0] = rival
        return best

    def distances(self, points: np.ndarray, best: np.ndarray) -> np.ndarray:
        apart = points - self.centroids[best]
        return np.einsum("ij,ij->i", apart, apart)


def _points(batch: pa.RecordBatch, column: int, dims: int, scale: int, rows: int = 4096) -> Iterator[np.ndarray]:
    """Integer vectors of a batch whose vectors all have ``dims`` components, some rows at a time."""
    lists = batch.column(column)
    values = lists.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
    for at in range(0, len(values), rows):
        yield integer_vectors(values[at : at + rows], scale)


def kept_vectors(vectors: DataFrame, id_column: str, vector_column: str, dims: int) -> DataFrame:
    """(vec_id, vec) of the vectors with exactly ``dims`` components, none null, NaN or infinite."""
    vec = F.col(vector_column)
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.where((F.size(vec) == dims) & finite).select(F.col(id_column).alias("vec_id"), vec.alias("vec"))


def starts(kept: DataFrame, k: int, scale: int, salt: str = "1:") -> np.ndarray:
    """The k vectors whose ``salt`` and id have the smallest sha256, in that order; k rows reach the driver."""
    key = F.sha2(F.concat(F.lit(salt), F.col("vec_id").cast("string")), 256)
    rows = kept.orderBy(key.asc_nulls_last(), "vec").limit(k).select("vec").collect()
    return integer_vectors(np.array([r.vec for r in rows], dtype=np.float64), scale)


def _moved(kept: DataFrame, centroids: np.ndarray, scale: int) -> np.ndarray:
    """One round: every non-empty centroid becomes the floored mean of its vectors.

    A task sends one row per centroid and component, so a centroid that takes most
    vectors is no hot key; k times dims sums reach the driver.
    """
    k, dims = centroids.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes, totals, counts = Bisectors(centroids), [[0] * dims for _ in range(k)], [0] * k
        for batch in batches:
            for points in _points(batch, 0, dims, scale):
                best = planes.nearest(points)
                for c in np.unique(best).tolist():
                    own = points[best == c]
                    counts[c] += len(own)
                    totals[c] = [a + b for a, b in zip(totals[c], own.sum(axis=0).tolist())]
        rows = [(c, i, Decimal(totals[c][i]), counts[c]) for c in range(k) if counts[c] for i in range(dims)]
        names = ("cluster", "place", "total", "n")
        types = (pa.int32(), pa.int32(), pa.decimal128(38, 0), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=names)

    partial = kept.select("vec").mapInArrow(sums, _TOTALS)
    means = partial.groupBy("cluster", "place").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
    moved = centroids.copy()
    for r in means.collect():
        moved[r.cluster, r.place] = int(r.total) // r.n
    return moved


def centroids_of(
    vectors: DataFrame, *, id_column: str = "vec_id", vector_column: str = "embedding", dims: int = 64, k: int = 16,
    rounds: int = 3, scale: int = 64,
) -> np.ndarray:
    """The integer centroids after ``rounds`` rounds; fewer than k where fewer vectors are kept."""
    kept = kept_vectors(vectors, id_column, vector_column, dims)
    centroids = starts(kept, k, scale)
    for _ in range(rounds if len(centroids) else 0):
        centroids = _moved(kept, centroids, scale)
    return centroids


def assign(
    vectors: DataFrame, centroids: np.ndarray, *, id_column: str = "vec_id", vector_column: str = "embedding",
    scale: int = 64,
) -> DataFrame:
    """(vec_id, cluster, distance) of every kept vector; ``distance`` is squared and exact."""
    schema = T.StructType(
        [
            T.StructField("vec_id", vectors.schema[id_column].dataType),
            T.StructField("cluster", T.IntegerType()),
            T.StructField("distance", T.LongType()),
        ]
    )
    if not len(centroids):
        return vectors.sparkSession.createDataFrame([], schema)
    dims = centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes = Bisectors(centroids)
        for batch in batches:
            clusters, apart = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for points in _points(batch, 1, dims, scale):
                clusters.append(planes.nearest(points))
                apart.append(planes.distances(points, clusters[-1]))
            arrays = [batch.column(0), pa.array(np.concatenate(clusters), pa.int32()), pa.array(np.concatenate(apart))]
            yield pa.RecordBatch.from_arrays(arrays, names=["vec_id", "cluster", "distance"])

    return kept_vectors(vectors, id_column, vector_column, dims).mapInArrow(run, schema)


def cluster(vectors: DataFrame, *, id_column: str = "vec_id", vector_column: str = "embedding", **options) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid) of every kept vector.

    Null vectors, those of another length and those with a null, NaN or infinite component
    give no row.  Null ids are clustered as all others and never start a centroid before a
    known id; repeated rows count each; vectors equally near to several centroids go to the
    smallest number.  Fewer vectors than centroids make fewer centroids, an empty table
    none and no rows.  A finite component beyond 2^26 / scale, whose distances would not fit
    64 bits, fails with a message.  Other columns, whatever their names, have no part.  Vectors
    are read once per round and never shuffled.
    """
    names = {"id_column": id_column, "vector_column": vector_column}
    centroids = centroids_of(vectors, **names, **options)
    scale = {"scale": options["scale"]} if "scale" in options else {}
    spark, rows = vectors.sparkSession, stored(assign(vectors, centroids, **names, **scale), "clusters")
    # k rows: their sums and the centroids go back as one small table.
    sums = rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("part")).collect()
    parts = {r.cluster: int(r.part) for r in sums}
    final = spark.createDataFrame(
        [(c, part, sum(parts.values()), [int(x) for x in centroids[c]]) for c, part in parts.items()],
        "cluster int, cluster_inertia long, inertia long, centroid array<long>",
    )
    return rows.join(F.broadcast(final), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid"
    )
