"""Centroid clustering in integers, with bounds that spare most vectors the scan of all centroids.

Every vector keeps its cluster, an upper bound of the distance to its centroid and a lower bound of the distance to every other one. When
centroids move, the upper bound grows by the drift of its own. The lower bound need not shrink by the largest drift of the others: a
cluster lies in a sphere around its centroid, and how much nearer a moved centroid can come to any point of the sphere is a matter of the
plane through the sphere's centre and the two places of the moved centroid (``loosening``). Vectors whose bounds still tell their cluster
stay; the ambiguous ones are compared with all centroids, exactly, in integers.

Each round is one pass that writes vectors with their state; centroids come from sums per task and cluster. The driver holds ``k`` centroids.

Defined cases: a vector of another size, with a null or a non-finite component, or null itself, is left out; components beyond 2**26 in
size after scaling count as that, since their squared distances would not fit 64 bits; of equal distances the smaller cluster number wins;
repeated rows are vectors of their own, and seeds of equal hash come in the order of their components; null ids are clustered
and are seeds last; with fewer vectors than seeds all are seeds; an empty table gives no rows; extra columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.llm.common import q, ready
from tidemill.session import settled

DIMENSIONS, SCALE, SEEDS, ROUNDS = 64, 64, 16, 3
LARGEST = 1 << 26
SLACK = 1e-9  # relative, far above the rounding of the bounds
STATE = "cluster int, distance long, upper double, lower double"


def points(vectors: DataFrame, dimensions: int = DIMENSIONS, scale: int = SCALE, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, point): the vectors that count, as integers."""
    vector = q(vector_col).cast("array<double>")
    fine = (F.size(vector) == dimensions) & F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    bounded = lambda x: F.greatest(F.least(F.floor(F.greatest(F.least(x, F.lit(2.0 ** 40)), F.lit(-2.0 ** 40)) * scale), F.lit(LARGEST)), F.lit(-LARGEST))
    return vectors.where(fine).select(q(id_col).alias("id"), F.transform(vector, bounded).cast("array<int>").alias("point"))


def seeds(kept: DataFrame, k: int, prefix: str = "1:") -> np.ndarray:
    """The ``k`` points with the smallest hash of their id."""
    mark = F.sha2(F.concat(F.lit(prefix), F.col("id").cast("string")), 256)
    return np.array([r.point for r in kept.orderBy(mark.asc_nulls_last(), "point").select("point").limit(k).collect()], np.int64)


def loosening(old: np.ndarray, new: np.ndarray, radius: np.ndarray) -> np.ndarray:
    """By how much, at most, centroid j can have come nearer to a point of cluster i: entry (i, j).

    With m the middle of its way, d its drift and t the angle at m between its direction and a point x, the distances of x to both ends differ
    by 2 d |x - m| cos(t) over their sum, and that sum is at least 2 |x - m|: the gain is at most d cos(t), and at most 0 behind m. Seen
    from m, a sphere of radius r at distance D > r spans asin(r / D) to each side of its centre, so the least t is known."""
    way = new - old
    drift = np.sqrt((way ** 2).sum(1))
    to_centre = old[:, None, :] - (old + new)[None, :, :] / 2
    far = np.sqrt((to_centre ** 2).sum(2))
    along = (to_centre * way[None, :, :]).sum(2)
    with np.errstate(divide="ignore", invalid="ignore"):
        angle = np.arccos(np.clip(along / (far * drift[None, :]), -1, 1)) - np.arcsin(np.clip(radius[:, None] / far, 0, 1))
        gain = drift[None, :] * np.cos(np.clip(angle, 0, np.pi / 2))
    return np.where(drift[None, :] == 0, 0.0, np.where(far <= radius[:, None] * (1 + SLACK), drift[None, :], gain)) * (1 + SLACK)


class _Assign:
    """Batches of points with their state, under new centroids."""

    def __init__(self, centroids: np.ndarray, old: np.ndarray | None = None, radius: np.ndarray | None = None):
        self.centroids, self.first = centroids, old is None
        k = len(centroids)
        apart = np.sqrt(((centroids[:, None, :] - centroids[None, :, :]) ** 2).sum(2).astype(float))
        np.fill_diagonal(apart, np.inf)
        self.half = apart.min(1) / 2  # nearer to the own centroid than this means nearest
        self.drift = self.loose = np.zeros(k)
        if not self.first:
            self.drift = np.sqrt(((centroids - old) ** 2).sum(1).astype(float))
            table = loosening(old.astype(float), centroids.astype(float), radius)
            np.fill_diagonal(table, 0.0)
            self.loose = table.max(1)

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            point = batch.column("point").flatten().to_numpy(zero_copy_only=False).reshape(n, -1).astype(np.int64)
            if self.first:
                cluster, upper, lower = np.zeros(n, np.int64), np.full(n, np.inf), np.zeros(n)
                ambiguous = np.arange(n)
            else:
                cluster, upper, lower = (batch.column(name).to_numpy() for name in ("cluster", "upper", "lower"))
                cluster = cluster.astype(np.int64)
                slack = SLACK * (upper + lower + self.drift[cluster])
                upper = upper + self.drift[cluster] + slack
                lower = np.maximum(lower - self.loose[cluster] - slack, 0)
                ambiguous = np.flatnonzero(upper >= np.maximum(lower, self.half[cluster] * (1 - SLACK)))
                upper[ambiguous] = self._own(point[ambiguous], cluster[ambiguous])
                ambiguous = ambiguous[upper[ambiguous] >= np.maximum(lower[ambiguous], self.half[cluster[ambiguous]] * (1 - SLACK))]
            if len(ambiguous):
                some = point[ambiguous]
                square = (some ** 2).sum(1)[:, None] - 2 * (some @ self.centroids.T) + (self.centroids ** 2).sum(1)
                best = square.argmin(1)  # of equal distances the first
                cluster[ambiguous], upper[ambiguous] = best, np.sqrt(square[np.arange(len(best)), best]) * (1 + SLACK)
                square[np.arange(len(best)), best] = np.iinfo(np.int64).max
                lower[ambiguous] = np.sqrt(square.min(1)) * (1 - SLACK)
            distance = ((point - self.centroids[cluster]) ** 2).sum(1)
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("point"), pa.array(cluster, pa.int32()), pa.array(distance), pa.array(upper), pa.array(lower)],
                                             names=["id", "point", "cluster", "distance", "upper", "lower"])

    def _own(self, point: np.ndarray, cluster: np.ndarray) -> np.ndarray:
        return np.sqrt(((point - self.centroids[cluster]) ** 2).sum(1)) * (1 + SLACK)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per cluster of the task: component sums, rows and the largest upper bound."""
    sums, count, radius = {}, {}, {}
    for batch in batches:
        cluster, upper = batch.column("cluster").to_numpy(), batch.column("upper").to_numpy()
        point = batch.column("point").flatten().to_numpy(zero_copy_only=False).reshape(len(cluster), -1)
        for c in np.unique(cluster).tolist():
            of = cluster == c
            sums[c] = sums.get(c, 0) + point[of].sum(0, dtype=np.int64)
            count[c], radius[c] = count.get(c, 0) + int(of.sum()), max(radius.get(c, 0.0), float(upper[of].max()))
    if sums:
        yield pa.RecordBatch.from_pydict({"cluster": pa.array(list(sums), pa.int32()), "sums": pa.array([s.tolist() for s in sums.values()], pa.list_(pa.int64())),
                                          "n": pa.array(list(count.values()), pa.int64()), "radius": pa.array(list(radius.values()), pa.float64())})


def moved(state: DataFrame, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The floored means of the clusters (those of no vector stay), and the radius of every cluster around its centroid so far."""
    parts = state.select("cluster", "point", "upper").mapInArrow(_sums, "cluster int, sums array<long>, n long, radius double")
    each = parts.select("cluster", "n", "radius", F.posexplode("sums").alias("at", "part")).groupBy("cluster", "at")
    new, radius = centroids.copy(), np.zeros(len(centroids))
    for r in each.agg(F.sum("part").alias("total"), F.sum("n").alias("n"), F.max("radius").alias("radius")).collect():  # k times dimensions rows
        new[r.cluster, r.at], radius[r.cluster] = r.total // r.n, r.radius
    return new, radius


def clusters(vectors: DataFrame, k: int = SEEDS, rounds: int = ROUNDS, dimensions: int = DIMENSIONS, scale: int = SCALE, id_col: str = "vec_id",
             vector_col: str = "embedding") -> DataFrame:
    """(id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every vector that counts."""
    ready(vectors.sparkSession)
    kept = settled(points(vectors, dimensions, scale, id_col, vector_col), "points")
    centroids = seeds(kept, k)
    if not len(centroids):
        centroids = np.zeros((1, dimensions), np.int64)
    schema = f"id {kept.schema['id'].dataType.simpleString()}, point array<int>, {STATE}"
    state = settled(kept.mapInArrow(_Assign(centroids), schema), "assigned")
    for _ in range(rounds):
        new, radius = moved(state, centroids)
        state = settled(state.mapInArrow(_Assign(new, centroids, radius), schema), "assigned")
        centroids = new
    inertia = {r.cluster: r.total for r in state.groupBy("cluster").agg(F.sum("distance").alias("total")).collect()}  # k rows

    def each(values: list, kind: str) -> Column:
        return F.get(F.array(*[F.lit(v).cast(kind) for v in values]), F.col("cluster"))

    digests = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]
    return state.select("id", "cluster", "distance", each([inertia.get(c, 0) for c in range(len(centroids))], "long").alias("cluster_inertia"),
                        F.lit(sum(inertia.values())).cast("long").alias("inertia"), each(digests, "string").alias("centroid_sha256"))
