"""Centroid clustering on a pivot table: stored distances to fixed vectors bound the distance to every centroid."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenura.llm.texts import released
from tenura.session import checkpointed

# Integer components beyond this count as this: no long could hold the square of their distance.
LARGEST = 1 << 53
# Up to here sums of squares of differences fit 64 bits; beyond, Python's integers are used.
SAFE = 1 << 26
LONGEST = (1 << 63) - 1


@dataclass(frozen=True)
class PivotClustering:
    """``pivots`` are chosen far apart among the ``pivot_sample`` rows of the least hashes.

    They decide how many exact distances are saved, never a result, so the sample's bound loses nothing.
    """

    clusters: int = 8
    rounds: int = 10
    components: int = 64
    scale: int = 1024
    seed: int = 3
    pivots: int = 8
    pivot_sample: int = 512


def kept_vectors(vectors: DataFrame, how: PivotClustering, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, v): vectors of the right length, all components finite, as floors of their scaled components."""
    x = F.col(vector).cast("array<double>")
    finite = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) != float("inf")))
    limit = F.lit(float(LARGEST))
    whole = F.transform(x, lambda e: F.floor(F.greatest(F.least(e * F.lit(float(how.scale)), limit), -limit)).cast("bigint"))
    return vectors.where((F.size(x) == how.components) & finite).select(F.col(key).cast("bigint").alias("vec_id"), whole.alias("v"))


def _exact(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared distances of paired rows, exact: 64 bits where all values are small, else Python's integers."""
    if max(np.abs(x).max(initial=0), np.abs(y).max(initial=0)) > SAFE:
        x, y = x.astype(object), y.astype(object)
    gap = x - y
    return (gap * gap).sum(axis=1)


def pivot_distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distances of all rows of ``x`` to all pivots, one column a pivot."""
    columns = [np.sqrt(_exact(x, np.broadcast_to(p, x.shape)).astype(float)) for p in pivots]
    return np.stack(columns, axis=1) if columns else np.zeros((len(x), 0))


def far_apart(sample: np.ndarray, count: int) -> np.ndarray:
    """Rows of a sample, each the farthest from those before it; the first is the sample's first. No row twice."""
    chosen = [0]
    away = pivot_distances(sample, sample[:1])[:, 0]
    while len(chosen) < count and away.max() > 0:
        chosen.append(int(away.argmax()))
        away = np.minimum(away, pivot_distances(sample, sample[chosen[-1:]])[:, 0])
    return sample[chosen]


def nearest(x: np.ndarray, near: np.ndarray, centroids: np.ndarray, centre_near: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest centroid of each row, its exact squared distance, and how many exact distances were computed.

    ``near`` and ``centre_near`` hold distances to the pivots. By the triangle inequality no centroid is nearer than the
    largest difference of those. Centroids are visited by that bound, a row leaves when it exceeds the best distance
    so far; slack far above rounding keeps ties. Equal distances go to the smaller number.
    """
    if near.shape[1]:
        total = near[:, None, :] + centre_near[None]
        low = (np.abs(near[:, None, :] - centre_near[None]) - 1e-9 * total).max(axis=2)
    else:
        low = np.zeros((len(x), len(centroids)))
    order = np.argsort(low, axis=1, kind="stable")
    cluster = order[:, 0].copy() if len(x) else np.zeros(0, int)
    best = _exact(x, centroids[cluster])
    asked, computed = np.arange(len(x)), len(x)
    for rank in range(1, len(centroids)):
        other = order[asked, rank]
        reach = np.sqrt(best[asked].astype(float)) * (1 + 1e-9) + 1e-9
        asked, other = asked[(alive := low[asked, other] <= reach)], other[alive]
        if not len(asked):
            break
        computed += len(asked)
        distance = _exact(x[asked], centroids[other])
        if distance.dtype != best.dtype:
            best, distance = best.astype(object), distance.astype(object)
        better = (distance < best[asked]) | ((distance == best[asked]) & (other < cluster[asked]))
        best[asked[better]], cluster[asked[better]] = distance[better], other[better]
    return cluster, best, computed


def _matrix(batch: pa.RecordBatch, name: str, width: int) -> np.ndarray:
    return batch.column(name).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, width)


def _pieces(batches: Iterator[pa.RecordBatch], rows: int = 4096) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


SUMS = pa.schema([("cluster", pa.int32()), ("sums", pa.list_(pa.decimal128(38, 0)))])
ASSIGNED = pa.schema([("vec_id", pa.int64()), ("cluster", pa.int32()), ("distance", pa.int64())])


def _scored(batches: Iterator[pa.RecordBatch], centroids: np.ndarray, pivots: np.ndarray):
    """(rows, their components, nearest centroids, exact distances) of small batches of a pivot table."""
    centre_near = pivot_distances(centroids, pivots)
    for piece in _pieces(batches):
        x = _matrix(piece, "v", centroids.shape[1])
        yield piece, x, *nearest(x, _matrix(piece, "near", len(pivots)), centroids, centre_near)[:2]


class PivotTable:
    """Kept vectors with their distances to fixed pivots, computed and stored once, and the first centroids."""

    def __init__(self, vectors: DataFrame, how: PivotClustering):
        self.how = how
        rows = checkpointed(kept_vectors(vectors, how))
        order = F.sha2(F.concat(F.lit(f"{how.seed}:"), F.col("vec_id").cast("string")), 256)
        sample = rows.orderBy(order.asc_nulls_last(), "v").limit(max(how.clusters, how.pivot_sample)).select("v").collect()
        values = np.array([r["v"] for r in sample], np.int64).reshape(-1, how.components)
        self.first = values[: how.clusters]
        self.pivots = pivots = far_apart(values, how.pivots) if len(values) else values

        def measured(batches):
            for piece in _pieces(batches):
                near = pivot_distances(_matrix(piece, "v", how.components), pivots)
                offsets = np.arange(piece.num_rows + 1, dtype=np.int32) * len(pivots)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(near.ravel()))
                yield pa.RecordBatch.from_arrays([*piece.columns, lists], names=["vec_id", "v", "near"])
            released()

        self.rows = checkpointed(rows.mapInArrow(measured, "vec_id bigint, v array<bigint>, near array<double>"))

    def moved(self, centroids: np.ndarray) -> np.ndarray:
        """Floors of the exact means of the vectors nearest to each centroid; one without any stays.

        A task returns one row of sums per centroid, which Spark adds up, so the driver gets as many rows as there are
        centroids and components, whatever the input.
        """
        width, pivots = self.how.components, self.pivots

        def run(batches):
            sums = np.zeros((len(centroids), width + 1), object)
            for _, x, cluster, _ in _scored(batches, centroids, pivots):
                for k in np.unique(cluster):
                    mine = x[cluster == k]
                    mine = mine.astype(object) if np.abs(mine).max() > SAFE else mine
                    sums[k, :width] += mine.sum(axis=0).astype(object)
                    sums[k, width] += len(mine)
            used = np.flatnonzero(sums[:, width])
            values = [[Decimal(int(v)) for v in sums[k]] for k in used]
            yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(values, SUMS.field("sums").type)], schema=SUMS)
            released()

        parts = self.rows.mapInArrow(run, "cluster int, sums array<decimal(38,0)>")
        slots = parts.select("cluster", F.posexplode("sums").alias("slot", "value"))
        found = slots.groupBy("cluster", "slot").agg(F.sum("value").cast("decimal(38,0)").alias("value")).collect()
        total = {(r["cluster"], r["slot"]): int(r["value"]) for r in found}
        after = centroids.copy()
        for k in {cluster for cluster, _ in total}:
            after[k] = [total[k, i] // total[k, width] for i in range(width)]
        return after

    def assigned(self, centroids: np.ndarray) -> DataFrame:
        """(vec_id, cluster, distance) of all kept vectors."""
        pivots = self.pivots

        def run(batches):
            for piece, _, cluster, best in _scored(batches, centroids, pivots):
                distance = np.minimum(best, LONGEST).astype(np.int64)
                yield pa.RecordBatch.from_arrays([piece.column("vec_id"), pa.array(cluster, pa.int32()), pa.array(distance)], schema=ASSIGNED)
            released()

        return self.rows.mapInArrow(run, "vec_id bigint, cluster int, distance bigint")


def clusters(vectors: DataFrame, how: PivotClustering | None = None) -> DataFrame:
    """One row per kept vector: vec_id, cluster, distance, cluster_inertia, inertia and centroid_sha256.

    Vectors of another length, with a NULL, NaN or infinite component or NULL itself are left out. A NULL vec_id is
    clustered, but is the last to found a centroid; equal hashes resolve by components. With fewer kept vectors than
    centroids each founds one; of equal centroids the smaller number takes all. Repeated rows are counted each; an empty
    table gives no rows; other columns are ignored. Components count as at most ±2^53 after scaling, and distances and
    sums that no long holds as the largest long. Rounds end early only where centroids no longer move, which is what
    all further rounds would give.
    """
    how = how or PivotClustering()
    table = PivotTable(vectors, how)
    centroids = table.first
    for _ in range(how.rounds if len(centroids) else 0):
        before, centroids = centroids, table.moved(centroids)
        if (before == centroids).all():
            break
    if not len(centroids):
        return table.rows.select("vec_id", *[F.lit(None).cast(t).alias(n) for n, t in (
            ("cluster", "int"), ("distance", "bigint"), ("cluster_inertia", "bigint"), ("inertia", "bigint"), ("centroid_sha256", "string"))])
    found = checkpointed(table.assigned(centroids))
    spark = vectors.sparkSession
    digests = [(k, hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest()) for k, c in enumerate(centroids)]
    named = spark.createDataFrame(digests, "cluster int, centroid_sha256 string")

    def held(total):
        return F.least(total, F.lit(LONGEST).cast("decimal(38,0)")).cast("bigint")

    exact = F.sum(F.col("distance").cast("decimal(28,0)"))
    sums = checkpointed(found.groupBy("cluster").agg(exact.alias("_sum")))  # one row a centroid
    whole = sums.agg(held(F.sum("_sum"))).first()[0]
    sums = sums.select("cluster", held(F.col("_sum")).alias("cluster_inertia")).join(F.broadcast(named), "cluster")
    return found.join(F.broadcast(sums), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", F.lit(whole).cast("bigint").alias("inertia"), "centroid_sha256"
    )
