"""Centroid clustering of integer vectors with Elkan's bounds; every assignment is exact.

Each vector carries its cluster, an upper bound of the distance to that centroid and a lower bound of the
distance to each centroid.  When centroids move, the bounds are widened by the moves; a distance is
calculated only where neither the lower bound nor half the distance between the two centroids rules the
other centroid out.  Bounds are doubles rounded away from the claim (upper up, lower down) and a centroid is
ruled out only where it is *strictly* farther, so that ties still come to the exact comparison: squared
distances are integers, and of equal ones the smaller number wins.

The vectors and their bounds are written after each round to the shared folder, so that a lost executor costs
one round at most; a round is one pass over them plus one for the sums.  Sums are combined in two steps and
``FAN_IN * k`` rows reach the driver, whatever the table's size.  Centroids are ``k`` rows.

Defined results: null vectors, vectors of another length and those with a null, NaN or infinite component
are left out; repeated rows are clustered each, and where repeated ids compete for the first centroids the
least components come first; a null id counts as the empty text in the hash that chooses the first
centroids; with fewer than ``k`` vectors there are as many centroids; an empty table gives no rows; other columns
are not read.  Components beyond ``SMALL`` are worked on as Python integers; distances and inertias
that a long cannot hold are null.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm.workers import give_back
from weftline.scratch import Scratch

K, ROUNDS, DIMENSIONS, SCALE, SEED = 8, 10, 64, 1024, 3
#: Groups that partial sums are combined in before they reach the driver.
FAN_IN = 32
#: Components up to this size have squared distances that fit 64 bits, for up to 128 of them.
SMALL = 1 << 26
#: One part in 2^40: far more than the rounding of a square root or of a sum of two doubles.
SLACK = 2.0**-40

STATE = "vec_id long, components array<double>, cluster int, distance string, upper double, lower array<double>"


def integers(x: float) -> int:
    """floor(SCALE * x) of any finite double."""
    return int(x) * SCALE if abs(x) >= 2.0**53 else math.floor(SCALE * x)


def _exact(rows: np.ndarray) -> np.ndarray:
    """Components as integers: 64-bit where all are small, Python integers where not."""
    if not rows.size or np.abs(rows).max() < SMALL / SCALE:
        return np.floor(SCALE * rows).astype(np.int64)
    return np.array([[integers(float(x)) for x in row] for row in rows], object)


def _root(squares: np.ndarray) -> np.ndarray:
    """Square roots as doubles, to within SLACK; integers beyond a double's range are infinite."""
    if squares.dtype == object:
        return np.array([math.sqrt(s) if s < 1 << 1000 else math.inf for s in squares], float)
    return np.sqrt(squares.astype(float))


def _up(x: np.ndarray | float) -> np.ndarray | float:
    return x * (1 + SLACK)


def _down(x: np.ndarray | float) -> np.ndarray | float:
    return np.maximum(x, 0) * (1 - SLACK)


def distances(vectors: np.ndarray, centroid: list[int]) -> np.ndarray:
    """Exact squared distances of vectors to one centroid."""
    small = vectors.dtype != object and len(centroid) <= 128 and max(map(abs, centroid), default=0) < SMALL
    off = (vectors if small else vectors.astype(object)) - np.array(centroid, np.int64 if small else object)
    return (off * off).sum(axis=1)


class Bounds:
    """Assignment of batches of vectors to ``centroids``; ``before`` are the centroids that the bounds were made for."""

    def __init__(self, centroids: list[list[int]], before: list[list[int]] | None = None):
        self.centroids, self.calculated = centroids, 0
        rows = np.array(centroids, object).reshape(len(centroids), -1)
        between = [distances(rows, c) for c in centroids]
        self.half = _down(np.array([_root(b) for b in between]) / 2)
        self.moved = np.array([_up(_root(distances(np.array([old], object), new))[0]) for old, new in zip(before or centroids, centroids, strict=True)])

    def _to(self, vectors: np.ndarray, which: np.ndarray, j: int) -> np.ndarray:
        self.calculated += len(which)
        return distances(vectors[which], self.centroids[j])

    def assign(self, vectors: np.ndarray, cluster: np.ndarray, upper: np.ndarray, lower: np.ndarray) -> tuple:
        """(cluster, exact squared distance, upper, lower) after the centroids have moved."""
        upper, lower = _up(upper + self.moved[cluster]), _down(lower - self.moved)
        cluster, k = cluster.copy(), len(self.centroids)
        best = np.zeros(len(cluster), object)
        known = np.zeros(len(cluster), bool)

        def tighten(which: np.ndarray) -> None:
            """The exact distance to the own centroid, where a bound does not settle it."""
            for j in np.unique(cluster[which]):
                own = which[cluster[which] == j]
                best[own] = self._to(vectors, own, j)
                near = _root(best[own])
                upper[own], lower[own, j], known[own] = _up(near), _down(near), True

        for j in range(k):
            def open_(rows: np.ndarray) -> np.ndarray:
                return rows[(cluster[rows] != j) & (lower[rows, j] <= upper[rows]) & (self.half[cluster[rows], j] <= upper[rows])]

            left = open_(np.arange(len(cluster)))
            tighten(left[~known[left]])
            left = open_(left)
            if not len(left):
                continue
            to = self._to(vectors, left, j).astype(object)
            far = _root(to)
            lower[left, j] = _down(far)
            wins = (to < best[left]) | ((to == best[left]) & (j < cluster[left]))
            won = left[wins]
            best[won], cluster[won], upper[won] = to[wins], j, _up(far[wins])
        return cluster, best, known, upper, lower


def moved(centroids: list[list[int]], sums: dict[int, tuple[int, list[int]]]) -> list[list[int]]:
    """Centroids after a round: floors of the means, empty clusters stay."""
    return [[s // sums[j][0] for s in sums[j][1]] if j in sums else c for j, c in enumerate(centroids)]


def _over(batches: Iterator[pa.RecordBatch], f: Callable[[np.ndarray, dict], pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    try:
        for batch in batches:
            if batch.num_rows:
                column = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
                yield f(column["components"].flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1), column)
    finally:
        give_back()


def _arrow(values: np.ndarray) -> pa.Array:
    """A matrix as an array of lists."""
    return pa.ListArray.from_arrays(np.arange(0, values.size + 1, values.shape[1], dtype=np.int32), pa.array(values.ravel()))


def _round(bounds_of: Callable[[], Bounds], exact: bool) -> Callable:
    """One round over (vec_id, components, cluster, upper, lower); ``exact`` adds the final distances."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds = bounds_of()

        def one(rows: np.ndarray, column: dict) -> pa.RecordBatch:
            vectors = _exact(rows)
            lower = column["lower"].flatten().to_numpy(zero_copy_only=False).reshape(len(rows), -1)
            cluster, best, known, upper, lower = bounds.assign(vectors, column["cluster"].to_numpy(), column["upper"].to_numpy(), lower)
            if exact:
                for j in np.unique(cluster[~known]):
                    own = np.flatnonzero(~known & (cluster == j))
                    best[own] = distances(vectors[own], bounds.centroids[j])
            text = pa.array([str(d) for d in best] if exact else [None] * len(rows), pa.string())
            return pa.RecordBatch.from_arrays([column["vec_id"], column["components"], pa.array(cluster, pa.int32()), text, pa.array(upper), _arrow(lower)], names=["vec_id", "components", "cluster", "distance", "upper", "lower"])

        yield from _over(batches, one)

    return run


def _partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(part, cluster, n, sums) of a task's vectors; sums are decimal texts."""
    from pyspark import TaskContext

    total: dict[int, tuple[int, list[int]]] = {}
    for batch in batches:
        vectors = _exact(batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1))
        cluster = batch.column(0).to_numpy()
        for j in np.unique(cluster).tolist():
            own = vectors[cluster == j]
            n, sums = total.get(j, (0, [0] * own.shape[1]))
            total[j] = n + len(own), [a + int(b) for a, b in zip(sums, own.sum(axis=0), strict=True)]
    yield _sums(total, TaskContext.get().partitionId() % FAN_IN)


def _sums(total: dict, part: int) -> pa.RecordBatch:
    rows = [(part, j, n, [str(s) for s in sums]) for j, (n, sums) in total.items()]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.string())))], names=["part", "cluster", "n", "sums"])


def _combined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, tuple[int, list[int]]] = {}
    for batch in batches:
        for row in batch.to_pylist():
            n, sums = total.get(row["cluster"], (0, [0] * len(row["sums"])))
            total[row["cluster"]] = n + row["n"], [a + int(b) for a, b in zip(sums, row["sums"], strict=True)]
    yield _sums(total, 0)


def cluster_sums(state: DataFrame) -> dict[int, tuple[int, list[int]]]:
    """Count and component sums of each cluster."""
    schema = "part int, cluster int, n long, sums array<string>"
    parts = state.select("cluster", "components").mapInArrow(_partial, schema)
    total: dict[int, tuple[int, list[int]]] = {}
    for row in parts.repartition(FAN_IN, "part").mapInArrow(_combined, schema).collect():
        n, sums = total.get(row.cluster, (0, [0] * len(row.sums)))
        total[row.cluster] = n + row.n, [a + int(b) for a, b in zip(sums, row.sums, strict=True)]
    return total


def whole_vectors(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", dimensions: int = DIMENSIONS) -> DataFrame:
    """(vec_id, components) of vectors of the right length whose components are all numbers."""
    x = F.col("components")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("components"))
    return rows.filter(x.isNotNull() & (F.size(x) == dimensions) & finite)


def cluster(vectors: DataFrame, k: int = K, rounds: int = ROUNDS, seed: int = SEED, scratch: Scratch | None = None) -> tuple[DataFrame, list[list[int]]]:
    """State (see ``STATE``, with exact distances) of each vector (vec_id, components), and the final centroids."""
    scratch = scratch or Scratch(vectors.sparkSession, "centroids")
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    first = vectors.select(order.alias("by"), "components").orderBy("by", "components").limit(k).collect()
    centroids = [[integers(x) for x in row.components] for row in first]
    k = max(1, len(centroids))
    # Bounds that say nothing yet: the first round calculates what they leave open.
    state = vectors.select("vec_id", "components", F.lit(0).alias("cluster"), F.lit(None).cast("string").alias("distance"), F.lit(float("inf")).alias("upper"), F.array_repeat(F.lit(0.0), k).alias("lower"))
    if not centroids:
        return state, []
    before, written = centroids, None
    for done in range(rounds + 1):
        now, old = centroids, before
        state = scratch.write(state.mapInArrow(_round(lambda now=now, old=old: Bounds(now, old), done == rounds), STATE), "round")
        if written is not None:
            scratch.drop(written)
        before, written = centroids, state
        if done < rounds:
            centroids = moved(centroids, cluster_sums(state))
    return state, centroids


def op13(df: DataFrame) -> DataFrame:
    """The contract's columns for every kept vector."""
    state, centroids = cluster(whole_vectors(df))
    spark = df.sparkSession
    digests = [(j, hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for j, c in enumerate(centroids)]
    digest = spark.createDataFrame(digests, "cluster int, centroid_sha256 string")
    exact = state.withColumn("d", F.expr("try_cast(distance AS decimal(38, 0))"))
    sums = exact.groupBy("cluster").agg(F.expr("CASE WHEN count(d) = count(*) THEN try_sum(d) END").alias("s"))
    whole = F.expr("CASE WHEN count(s) OVER () = count(*) OVER () THEN try_sum(s) OVER () END")
    sums = sums.withColumn("cluster_inertia", F.expr("try_cast(s AS long)")).withColumn("inertia", whole).withColumn("inertia", F.expr("try_cast(inertia AS long)"))
    return (
        exact.join(F.broadcast(sums.drop("s")), "cluster").join(F.broadcast(digest), "cluster")
        .select("vec_id", "cluster", F.expr("try_cast(d AS long)").alias("distance"), "cluster_inertia", "inertia", "centroid_sha256")
    )
