"""Centroid clustering of integer vectors, with lower bounds loosened by geometry instead of by the full drift.

Each vector carries its cluster, an upper bound on its distance to that centroid and a lower bound on its distance to all others.
When centroids move, the vectors of one cluster lie in a sphere around its old centroid. How much nearer another centroid can
come to any point of that sphere is bounded in the plane of the old, the moved and the cluster's centroid (``loosening``); it is
at most the drift, and less when the centroid moves sideways or away. A vector whose upper bound stays below its
lower bound keeps its cluster; the others are ambiguous, and are scanned exactly, in integers. So the result is
that of comparing every vector with every centroid.

Vectors are written once, bucketed by row; each round reads them beside the state of the round before, bucketed alike, so neither is
shuffled, and writes the new state. A state is a few bytes a vector and holds what its tasks add to the centroids' sums.
"""

from __future__ import annotations

import hashlib
import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelane.llm.frames import field, unused, written
from tidelane.session import new_folder
from tidelane.sources.files import delete_folder

#: Larger components could give squared distances of more than 64 bits.
LARGEST = 1 << 26
STATE = "row long, cluster int, upper double, lower double, change array<long>, scanned long"


def quantised(embedding: Column, dims: int, scale: int) -> Column:
    """A vector as integers ``floor(scale * x)``, null unless it has ``dims`` components, all finite."""
    number = lambda x: x.cast("double")
    whole = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(number(x)) & (F.abs(number(x)) != F.lit(math.inf)))
    small = lambda v: F.when(F.abs(v) <= LARGEST, v).otherwise(F.raise_error(F.lit(f"a component times {scale} is beyond {LARGEST}")).cast("double"))
    return F.when((F.size(embedding) == dims) & whole, F.transform(embedding, lambda x: small(F.lit(float(scale)) * number(x))).cast("array<double>"))


def _integers(doubles: Column) -> Column:
    return F.transform(doubles, lambda x: F.floor(x).cast("int"))


def squared_distances(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances of integer vectors to integer centroids."""
    most = max(np.abs(x).max(initial=0), np.abs(centroids).max(initial=0))
    if x.shape[1] * int(most) ** 2 < 1 << 52:  # floating-point products and sums are exact
        cross = (x.astype(np.float64) @ centroids.T.astype(np.float64)).astype(np.int64)
        return (x * x).sum(1)[:, None] - 2 * cross + (centroids * centroids).sum(1)
    return np.stack([((x - c) ** 2).sum(1) for c in centroids], 1)


def loosening(center: np.ndarray, radius: float, old: np.ndarray, new: np.ndarray) -> float:
    """At most how much nearer ``new`` can be than ``old`` to a point within ``radius`` of ``center``.

    Points for which it is nearer by v lie on a branch of a hyperbola with both as foci, inside the cone of its
    asymptotes: seen from the midpoint they stand at an angle of at most arccos(v / drift) to the move. So v is at most the drift times
    the cosine of the smallest angle at which the midpoint sees the sphere.
    """
    move = new - old
    drift = math.sqrt(move @ move)
    if drift == 0:
        return 0.0
    away = center - (old + new) / 2
    distance = math.sqrt(away @ away)
    if distance <= radius * (1 + 1e-9):
        return drift
    cos = float(np.clip((away @ move) / (distance * drift), -1.0, 1.0))
    sin_half = radius / distance
    cos_half = math.sqrt(1 - sin_half**2)
    if cos >= cos_half:
        return drift
    nearest = cos * cos_half + math.sqrt(1 - cos**2) * sin_half
    return min(drift, drift * (max(0.0, nearest) + 1e-6))


def loosenings(old: np.ndarray, new: np.ndarray, radii: np.ndarray) -> np.ndarray:
    """For each cluster, the largest loosening over all other centroids; 0 for a cluster without vectors (radius below 0)."""
    old, new = old.astype(np.float64), new.astype(np.float64)
    out = np.zeros(len(old))
    for i, radius in enumerate(radii):
        if radius >= 0:
            out[i] = max((loosening(old[i], float(radius), old[j], new[j]) for j in range(len(old)) if j != i), default=0.0)
    return out


class State:
    """Clusters and bounds of some vectors."""

    def __init__(self, x: np.ndarray, centroids: np.ndarray):
        self.x, self.centroids = x, centroids
        self.cluster = np.zeros(len(x), np.int64)
        self.upper, self.lower = np.zeros(len(x)), np.zeros(len(x))
        self.scanned = 0

    def scan(self, which: np.ndarray) -> None:
        """Compare the chosen vectors with every centroid; of equally near ones the smaller number counts."""
        distances = squared_distances(self.x[which], self.centroids)
        best = distances.argmin(1)
        rows = np.arange(len(which))
        self.cluster[which], self.upper[which] = best, np.sqrt(distances[rows, best])
        distances = distances.astype(np.float64)
        distances[rows, best] = np.inf
        self.lower[which] = np.sqrt(distances.min(1))
        self.scanned += len(which)

    def _ambiguous(self, which: np.ndarray) -> np.ndarray:
        upper, lower = self.upper[which], self.lower[which]
        sure = upper + 1e-9 * upper + 1e-6 < lower  # bounds are rounded; this is far more than their error
        return which[~sure]

    def move(self, centroids: np.ndarray) -> None:
        """Follow the centroids to new places."""
        old, self.centroids = self.centroids, centroids
        radii = np.full(len(old), -1.0)
        np.maximum.at(radii, self.cluster, self.upper)
        drift = np.sqrt(((centroids - old).astype(np.float64) ** 2).sum(1))
        self.upper += drift[self.cluster]
        self.lower -= loosenings(old, centroids, radii)[self.cluster]
        which = self._ambiguous(np.arange(len(self.x)))
        own = self.x[which] - centroids[self.cluster[which]]
        self.upper[which] = np.sqrt((own * own).sum(1))
        which = self._ambiguous(which)
        if len(which):
            self.scan(which)


def _sums(x: np.ndarray, cluster: np.ndarray, k: int) -> np.ndarray:
    """Count and component sums of each cluster, in one row each."""
    out = np.zeros((k, x.shape[1] + 1), np.int64)
    np.add.at(out[:, 0], cluster, 1)
    for i in np.unique(cluster):
        out[i, 1:] = x[cluster == i].sum(0)
    return out


def _vectors(batch: pa.RecordBatch, dims: int) -> np.ndarray:
    return batch["vector"].flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dims)


def _state_of(batch: pa.RecordBatch, x: np.ndarray, centroids: np.ndarray) -> State:
    state = State(x, centroids)
    state.cluster = batch["cluster"].to_numpy().astype(np.int64)
    state.upper, state.lower = batch["upper"].to_numpy().copy(), batch["lower"].to_numpy().copy()
    return state


def _round(dims: int, old: np.ndarray | None, new: np.ndarray):
    """Assign vectors to the centroids ``new``; the first row of each batch carries the change of all sums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _vectors(batch, dims)
            if old is None:
                state = State(x, new)
                state.scan(np.arange(len(x)))
                change = _sums(x, state.cluster, len(new))
            else:
                state = _state_of(batch, x, old)
                before = state.cluster.copy()
                state.move(new)
                moved = before != state.cluster
                change = _sums(x[moved], state.cluster[moved], len(new)) - _sums(x[moved], before[moved], len(new))
            none = [None] * (len(x) - 1)
            columns = [batch["row"], pa.array(state.cluster, pa.int32()), pa.array(state.upper), pa.array(state.lower)]
            columns += [pa.array([change.ravel().tolist(), *none], pa.list_(pa.int64())), pa.array([state.scanned, *none], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["row", "cluster", "upper", "lower", "change", "scanned"])

    return run


def _last(dims: int, old: np.ndarray, new: np.ndarray, keep: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _vectors(batch, dims)
            state = _state_of(batch, x, old)
            state.move(new)
            own = x - new[state.cluster]
            yield pa.RecordBatch.from_arrays([batch[keep], pa.array(state.cluster, pa.int32()), pa.array((own * own).sum(1))], [keep, "cluster", "distance"])

    return run


class _Bucketed:
    """A table bucketed by row, in the shared folder, until it is dropped."""

    def __init__(self, frame: DataFrame, buckets: int):
        self.spark, self.name, self.path = frame.sparkSession, f"tidelane_{uuid.uuid4().hex}", new_folder(frame.sparkSession, "clusters")
        frame.write.bucketBy(buckets, "row").option("path", self.path).saveAsTable(self.name)

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        delete_folder(self.spark, self.path)


def _buckets(spark: SparkSession, n: int, per_bucket: int) -> int:
    """Enough for tasks of ``per_bucket`` vectors, and for every core if there are a thousand for each."""
    wanted = max(-(-n // per_bucket), min(spark.sparkContext.defaultParallelism, -(-n // 1000)))
    return max(1, min(wanted, int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets"))))


def _moved(centroids: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """Floor of each cluster's mean; a cluster without vectors stays. ``sums`` holds Python integers of any size."""
    return np.array([[int(s) // int(row[0]) for s in row[1:]] if row[0] else c for row, c in zip(sums, centroids.tolist(), strict=True)], np.int64).reshape(centroids.shape)


def cluster_vectors(
    vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", k: int = 8, dims: int = 64, scale: int = 1024, rounds: int = 10, key: str = "3", per_bucket: int = 100_000
) -> DataFrame:
    """``vec_id``, ``cluster``, ``distance`` (squared), ``cluster_inertia``, ``inertia`` and ``centroid_sha256`` of each kept vector.

    Vectors that are null, have another number of components than ``dims``, or a null or non-finite one are left out; components
    become ``floor(scale * x)``, and one beyond 2^26 ends the job with an error. Centroids begin as the ``k`` vectors whose ids have the smallest SHA-256 of
    ``<key>:<vec_id>`` (a null id counts as ''; among equal ids the smaller vector first), or as all of them if there are
    fewer. Each of ``rounds`` rounds assigns every vector to its nearest centroid, the smaller number of equally near ones, and moves every centroid to
    the floor of its vectors' mean; then vectors are assigned once more. Rounds end early when no centroid moves, since
    later ones would change nothing. Equal rows are vectors each. Without vectors there are no rows. Other columns are ignored.
    """
    spark = vectors.sparkSession
    own = unused(vectors, "vector")
    schema = f"{field(vectors, vec_id)}, cluster int, distance long"
    kept = vectors.select(F.col(vec_id), quantised(F.col(embedding), dims, scale).alias(own)).where(F.col(own).isNotNull())
    kept = kept.select(F.monotonically_increasing_id().alias("row"), F.struct(F.col(vec_id)).alias("id"), _integers(F.col(own)).alias("vector"))
    buckets = _buckets(spark, kept.count(), per_bucket)
    table = _Bucketed(kept.repartition(buckets, "row"), buckets)
    digest = F.sha2(F.concat(F.lit(f"{key}:"), F.coalesce(F.col(f"id.`{vec_id}`").cast("string"), F.lit(""))), 256)
    first = table.read().select(digest.alias("digest"), "vector").orderBy("digest", "vector").limit(k).collect()
    centroids = np.array([r.vector for r in first], np.int64).reshape(-1, dims)
    sums = np.zeros((len(centroids), dims + 1), object)
    old: np.ndarray | None = None
    state: _Bucketed | None = None
    for _ in range(rounds):
        if not len(centroids):
            break
        rows = table.read().select("row", "vector")
        if state is not None:
            rows = rows.join(state.read().select("row", "cluster", "upper", "lower").hint("shuffle_hash"), "row")
        after = _Bucketed(rows.mapInArrow(_round(dims, old, centroids), STATE), buckets)
        if state is not None:
            state.drop()
        state = after
        changes = state.read().where("change IS NOT NULL").select(F.posexplode("change")).groupBy("pos").agg(F.sum(F.col("col").cast("decimal(38,0)")).alias("n"))
        for row in changes.collect():  # one for each centroid and component
            sums[row.pos // (dims + 1), row.pos % (dims + 1)] += int(row.n)
        old, centroids = centroids, _moved(centroids, sums)
        if (old == centroids).all():
            break
    if state is None:
        table.drop()
        return spark.createDataFrame([], f"{schema}, cluster_inertia long, inertia long, centroid_sha256 string")
    rows = table.read().select("row", F.col(f"id.`{vec_id}`").alias(vec_id), "vector").join(state.read().select("row", F.col("cluster"), "upper", "lower").hint("shuffle_hash"), "row")
    placed = written(rows.mapInArrow(_last(dims, old, centroids, vec_id), schema), "clustered")
    state.drop()
    table.drop()
    totals = {r.cluster: int(r.n) for r in placed.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("n")).collect()}
    number = lambda values: F.element_at(F.array(*map(F.lit, values)), F.col("cluster") + 1)
    return placed.withColumns({
        "cluster_inertia": number([totals.get(i, 0) for i in range(len(centroids))]).cast("long"),
        "inertia": F.lit(sum(totals.values())).cast("long"),
        "centroid_sha256": number([hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]),
    })
