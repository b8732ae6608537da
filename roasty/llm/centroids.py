"""Exact centroid clustering of integer vectors, centroids found by the
threshold algorithm.

For each dimension the centroids' values are sorted once a round. A vector
walks each of these lists outward from its own value, all dimensions in step.
A centroid met in any list is measured exactly. The squared distances of the
lists' frontiers add up to a bound below every centroid not met yet, so the
walk stops when that sum strictly exceeds the best exact distance (on equality
a centroid of a smaller number could still be out there).

All numbers are integers, so sums do not depend on how the rows are spread:
lost executors, other partitions and other orders give the same centroids.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roasty.llm.common import stored

SIZE = 64
CENTROIDS = 8
ROUNDS = 10
SCALE = 1024

#: The largest whole component: squared distances of SIZE of them fit a long.
LARGEST = 1 << 27
#: Vectors that are walked at once.
BLOCK = 4096


def whole_vectors(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", size: int = SIZE,
                  scale: int = SCALE) -> DataFrame:
    """``id, v``: the vectors with exactly ``size`` components, none null or
    not finite, as whole numbers ``floor(scale * x)``. A component beyond
    +-LARGEST would not fit a long when squared and summed: it fails the job."""
    v = F.col(f"`{vector_col}`")
    good = v.isNotNull() & (F.size(v) == size) & F.forall(
        v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf")))
    )

    def whole(x):
        y = F.floor(x.cast("double") * float(scale))
        too_far = F.raise_error(F.concat(F.lit("component too large to cluster exactly: "), x.cast("string"))).cast("int")
        return F.when(F.abs(x.cast("double") * float(scale)) <= float(LARGEST - 1), y.cast("int")).otherwise(too_far)

    return table.filter(F.coalesce(good, F.lit(False))).select(
        F.col(f"`{id_col}`").cast("long").alias("id"), F.transform(v, whole).alias("v")
    )


def first_centroids(vectors: DataFrame, k: int = CENTROIDS) -> np.ndarray:
    """The ``k`` vectors with the smallest ``sha256("3:" + id)``, in that
    order (fewer if there are fewer); a top-k, so ``k`` rows reach the driver.
    Equal ids go by their components, null ids last."""
    key = F.sha2(F.concat(F.lit("3:"), F.col("id").cast("string")).cast("binary"), 256)
    rows = vectors.orderBy(key.asc_nulls_last(), "v").limit(k).select("v").collect()
    return np.array([r["v"] for r in rows], np.int64)


class Lists:
    """A set of centroids as one sorted list a dimension."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids
        self.k, self.size = centroids.shape
        self.order = np.argsort(centroids, axis=0, kind="stable").T.copy()
        self.values = np.take_along_axis(centroids.T, self.order, axis=1)
        #: Exact distances measured so far, out of all vectors by centroids.
        self.measured = 0

    def nearest(self, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest centroid of each row, the smaller number on ties, and
        the squared distance."""
        n = len(v)
        best, of = np.full(n, np.iinfo(np.int64).max), np.full(n, -1, np.int64)
        high = np.empty((n, self.size), np.int64)
        for d in range(self.size):
            high[:, d] = np.searchsorted(self.values[d], v[:, d])
        low = high - 1
        met = np.zeros((n, self.k), bool)
        rows, dims = np.arange(n), np.arange(self.size)
        far = 4 * LARGEST
        while len(rows):
            x = v[rows]
            below = np.where(low >= 0, x - self.values[dims, np.maximum(low, 0)], far)
            above = np.where(high < self.k, self.values[dims, np.minimum(high, self.k - 1)] - x, far)
            # The frontier: what the next step meets, list by list.
            step = np.minimum(below, above)
            open_ = ~met.all(axis=1)
            bound = (np.where(step < far, step, 0) ** 2).sum(axis=1)
            go = open_ & (bound <= best[rows])
            if not go.all():
                rows, x, met, low, high = rows[go], x[go], met[go], low[go], high[go]
                below, above = below[go], above[go]
                if not len(rows):
                    break
            down = below <= above
            place = np.where(down, low, high)
            new = np.zeros_like(met)
            new[np.arange(len(rows))[:, None], self.order[dims, np.clip(place, 0, self.k - 1)]] = True
            new &= ~met
            met |= new
            low, high = low - down, high + ~down
            for c in np.flatnonzero(new.any(axis=0)):
                some = np.flatnonzero(new[:, c])
                gap = x[some] - self.centroids[c]
                distance = np.einsum("ij,ij->i", gap, gap)
                self.measured += len(some)
                at = rows[some]
                nearer = (distance < best[at]) | ((distance == best[at]) & (c < of[at]))
                best[at[nearer]], of[at[nearer]] = distance[nearer], c
        return of, best


def _matrix(column: pa.ListArray, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, size)


def cluster_sums(vectors: DataFrame, centroids: np.ndarray) -> dict[int, tuple[int, list[int]]]:
    """Per non-empty cluster its count and componentwise sums. Each task adds
    up its own rows; the driver gets one row per cluster and dimension."""
    size = centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = Lists(centroids)
        count, total = np.zeros(len(centroids), np.int64), np.zeros_like(centroids)
        for b in batches:
            v = _matrix(b.column(0), size)
            for i in range(0, len(v), BLOCK):
                part = v[i : i + BLOCK]
                of, _ = lists.nearest(part)
                for c in np.unique(of):
                    mine = part[of == c]
                    count[c] += len(mine)
                    total[c] += mine.sum(axis=0)
        used = np.flatnonzero(count)
        yield pa.RecordBatch.from_pydict(
            {"c": pa.array(used, pa.int32()), "n": pa.array(count[used]), "s": pa.array(list(total[used]), pa.list_(pa.int64()))}
        )

    made = vectors.select("v").mapInArrow(run, "c int, n long, s array<long>")
    rows = made.select("c", "n", F.posexplode("s").alias("d", "x")).groupBy("c", "d").agg(F.sum("n").alias("n"), F.sum("x").alias("x")).collect()
    out: dict[int, tuple[int, list[int]]] = {}
    for r in rows:
        out.setdefault(r["c"], (r["n"], [0] * size))[1][r["d"]] = r["x"]
    return out


def assign(vectors: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``id, cluster, distance`` (squared) of every vector."""
    size = centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = Lists(centroids)
        for b in batches:
            v = _matrix(b.column(1), size)
            parts = [lists.nearest(v[i : i + BLOCK]) for i in range(0, len(v), BLOCK)]
            of, distance = (np.concatenate([p[i] for p in parts]) if parts else np.zeros(0, np.int64) for i in (0, 1))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(of.astype(np.int32)), pa.array(distance)], ["id", "cluster", "distance"])

    return vectors.select("id", "v").mapInArrow(run, "id long, cluster int, distance long")


def fit(vectors: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS) -> np.ndarray:
    """Centroids after ``rounds`` rounds over all of ``vectors``: each moves
    to the componentwise floor of its vectors' mean, an empty one stays."""
    centroids = first_centroids(vectors, k)
    for _ in range(rounds if len(centroids) else 0):
        moved = centroids.copy()
        for c, (n, sums) in cluster_sums(vectors, centroids).items():
            moved[c] = [s // n for s in sums]
        if (moved == centroids).all():
            break  # the rounds left would change nothing
        centroids = moved
    return centroids


def clusters(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", size: int = SIZE,
             k: int = CENTROIDS, rounds: int = ROUNDS) -> DataFrame:
    """Per vector kept: ``id_col, cluster, distance``, its cluster's
    ``cluster_inertia, centroid_sha256, centroid``, and ``inertia`` over all.

    Null vectors, those of another length and those with a null or non-finite
    component are left out. Repeated ids and rows are vectors like any other.
    Fewer vectors than ``k`` make as many centroids; a table without vectors
    gives an empty result. Other columns are ignored, whatever their names."""
    vectors = stored(whole_vectors(table, id_col, vector_col, size), "centroid-vectors")
    centroids = fit(vectors, k, rounds)
    spark = table.sparkSession
    schema = "_c int, _i decimal(38,0), _all decimal(38,0), _sha string, _v array<int>"
    if not len(centroids):
        named, met = spark.createDataFrame([], schema), vectors.select("id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance"))
    else:
        met = stored(assign(vectors, centroids), "centroid-assigned")
        # One row per cluster, k at most.
        sums = {r["cluster"]: r["s"] for r in met.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(28,0)")).alias("s")).collect()}
        total = sum(sums.values())
        digest = [hashlib.sha256(",".join(map(str, row)).encode()).hexdigest() for row in centroids.tolist()]
        named = spark.createDataFrame([(c, s, total, digest[c], centroids[c].tolist()) for c, s in sums.items()], schema)
    return met.join(F.broadcast(named), F.col("cluster") == F.col("_c")).select(
        F.col("id").alias(id_col), "cluster", "distance", F.col("_i").cast("long").alias("cluster_inertia"),
        F.col("_all").cast("long").alias("inertia"), F.col("_sha").alias("centroid_sha256"), F.col("_v").alias("centroid"),
    )
