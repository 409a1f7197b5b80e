"""Centroid clustering (Lloyd's rounds) with Ptolemaic pivots.

Ptolemy's inequality bounds the distance of a vector ``x`` and a centroid ``c`` by their
distances to two pivots ``p`` and ``q``:

    d(x, c) >= |d(x, p) d(c, q) - d(x, q) d(c, p)| / d(p, q)

The pivots are fixed, so the distances of all vectors to them are worked out once and
written beside the vectors. In a round a vector is measured exactly against its nearest
centroid by the bound, and then against those whose bound does not lie above that
distance. Bounds are rounded down by more than their own rounding error, and distances
are sums of squared integers, so the result is the same as without bounds.

Vectors stay where they lie: a round reads them in place and sends one sum per task and
cluster. Components are whole numbers after scaling. Where one is beyond ``EXACT``, its
vector is handled with Python's unbounded integers.
"""

from __future__ import annotations

import hashlib
import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from penprint.session import staged

CLUSTERS = 8
ROUNDS = 10
DIMS = 64
SCALE = 1024
PIVOTS = 6
# vectors, smallest hashes first, among which pivots are looked for
PIVOT_CHOICE = 64
# components up to this size have squared distances that fit 64 bits
EXACT = 1 << 27
_LONGEST = (1 << 63) - 1
# rows of partial sums that are added per group before the rest reaches the driver
_LANES = 64
_BLOCK = 4096


def scaled(x: float, scale: int = SCALE) -> int:
    """floor(scale * x), exactly."""
    top, bottom = float(x).as_integer_ratio()
    return scale * top // bottom


def whole_numbers(rows: np.ndarray, scale: int = SCALE) -> tuple[np.ndarray, dict[int, list[int]]]:
    """Scaled rows as 64-bit integers, and the rows by number that need unbounded ones (zero in the first)."""
    with np.errstate(over="ignore"):
        floored = np.floor(rows * scale)
    wide = np.flatnonzero(~(np.abs(floored) <= EXACT).all(axis=1))
    exact = {int(i): [scaled(x, scale) for x in rows[i]] for i in wide}
    floored[wide] = 0
    return floored.astype(np.int64), exact


def squared(a: list[int], b: list[int]) -> int:
    return sum((x - y) ** 2 for x, y in zip(a, b))


def distances_to(values: np.ndarray, wide: dict[int, list[int]], points: list[list[int]]) -> np.ndarray:
    """Distances of rows to points within ``EXACT`` as doubles; infinite for the rows beyond it."""
    out = np.empty((len(values), len(points)))
    for j, point in enumerate(points):
        gap = values - np.array(point, np.int64)
        out[:, j] = np.sqrt(np.einsum("ij,ij->i", gap, gap))
    out[list(wide)] = np.inf
    return out


def lower_bounds(to_pivots: np.ndarray, centroid_to_pivots: np.ndarray, pivot_gaps: np.ndarray) -> np.ndarray:
    """Bounds, rounded down, of the distances of rows (first axis) to centroids (second)."""
    out = np.zeros((len(to_pivots), len(centroid_to_pivots)))
    with np.errstate(invalid="ignore", over="ignore"):
        for p, q in itertools.combinations(range(to_pivots.shape[1]), 2):
            gap = pivot_gaps[p, q]
            one = np.outer(to_pivots[:, p], centroid_to_pivots[:, q])
            two = np.outer(to_pivots[:, q], centroid_to_pivots[:, p])
            bound = (np.abs(one - two) - 1e-12 * (one + two)) / gap * (1 - 1e-12)
            np.fmax(out, bound, out=out)
    out[~np.isfinite(out)] = 0
    return out


def nearest(
    values: np.ndarray, to_pivots: np.ndarray, centroids: np.ndarray, centroid_to_pivots: np.ndarray, pivot_gaps: np.ndarray
) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest centroid (the smaller number of a tie) and squared distance of each row, and how many were measured."""
    bounds = lower_bounds(to_pivots, centroid_to_pivots, pivot_gaps)

    def exact(rows, numbers):
        gap = values[rows] - centroids[numbers]
        return np.einsum("ij,ij->i", gap, gap)

    every = np.arange(len(values))
    first = bounds.argmin(axis=1)
    best, at = exact(every, first), first.copy()
    measured = len(values)
    for c in range(len(centroids)):
        rows = np.flatnonzero((first != c) & (bounds[:, c] * bounds[:, c] <= best * (1 + 1e-12)))
        found = exact(rows, c)
        measured += len(rows)
        better = (found < best[rows]) | ((found == best[rows]) & (c < at[rows]))
        best[rows[better]] = found[better]
        at[rows[better]] = c
    return at, best, measured


class Rounds:
    """What a task needs to place its vectors: centroids, pivots and their distances."""

    def __init__(self, centroids: list[list[int]], pivots: list[list[int]], scale: int = SCALE):
        self.centroids, self.pivots, self.scale = centroids, pivots, scale
        self.narrow = all(abs(x) <= EXACT for c in centroids for x in c)
        self.gaps = np.array([[math.sqrt(squared(p, q)) for q in pivots] for p in pivots])
        if self.narrow:
            self.points = np.array(centroids, np.int64)
            self.to_pivots = distances_to(self.points, {}, pivots)

    def place(self, batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, np.ndarray, dict, np.ndarray, list]]:
        """For blocks of rows: the rows, their whole numbers, clusters and squared distances."""
        for start in range(0, batch.num_rows, _BLOCK):
            part = batch.slice(start, _BLOCK)
            rows = np.frombuffer(b"".join(part.column("_x").to_pylist())).reshape(part.num_rows, -1)
            values, wide = whole_numbers(rows, self.scale)
            if self.narrow:
                stored = np.zeros((len(values), 0))
                if self.pivots:
                    stored = np.frombuffer(b"".join(part.column("_pivots").to_pylist())).reshape(len(values), -1)
                at, best, _ = nearest(values, stored, self.points, self.to_pivots, self.gaps)
                best = best.tolist()
                slow = list(wide)
            else:
                at, best, slow = np.zeros(len(values), np.int64), [0] * len(values), range(len(values))
            for i in slow:
                own = wide.get(i) or values[i].tolist()
                best[i], at[i] = min((squared(own, c), k) for k, c in enumerate(self.centroids))
            yield part, values, wide, at, best


def _with_pivots(kept: DataFrame, pivots: list[list[int]], scale: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("_x").cast(pa.list_(pa.float64()))
            rows = column.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            values, wide = whole_numbers(rows, scale)
            far = distances_to(values, wide, pivots)
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), pa.array([r.tobytes() for r in rows]), pa.array([r.tobytes() for r in far])],
                ["_id", "_x", "_pivots"],
            )

    kind = dict(kept.dtypes)["_id"]
    return kept.mapInArrow(run, f"_id {kind}, _x binary, _pivots binary")


def _sums(table: DataFrame, rounds: Rounds) -> dict[int, tuple[int, list[int]]]:
    """Count and component sums of each cluster that has vectors."""

    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[int, int] = {}
        sums: dict[int, list[int]] = {}
        for batch in batches:
            for _, values, wide, at, _ in rounds.place(batch):
                for k in np.unique(at).tolist():
                    own = at == k
                    add = values[own].sum(axis=0).tolist()
                    for i in wide:
                        if own[i]:
                            add = [a + b for a, b in zip(add, wide[i])]
                    counts[k] = counts.get(k, 0) + int(own.sum())
                    sums[k] = [a + b for a, b in zip(sums[k], add)] if k in sums else add
        keys = sorted(counts)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(keys, pa.int64()),
                pa.array([counts[k] for k in keys], pa.int64()),
                pa.array([[str(x) for x in sums[k]] for k in keys], pa.list_(pa.string())),
            ],
            ["cluster", "n", "sums"],
        )

    def added(rows: pa.Table) -> pa.Table:
        totals = [sum(map(int, column)) for column in zip(*rows.column("sums").to_pylist())]
        n = sum(rows.column("n").to_pylist())
        return pa.table(
            {
                "cluster": rows.column("cluster").slice(0, 1),
                "n": pa.array([n], pa.int64()),
                "sums": pa.array([[str(x) for x in totals]], pa.list_(pa.string())),
            }
        )

    schema = "cluster bigint, n bigint, sums array<string>"
    parts = table.mapInArrow(of_task, schema).withColumn("lane", F.spark_partition_id() % _LANES)
    found: dict[int, tuple[int, list[int]]] = {}
    # at most _LANES rows per cluster
    for cluster, n, sums in parts.groupBy("cluster", "lane").applyInArrow(added, schema).collect():
        before = found.get(cluster, (0, [0] * len(sums)))
        found[cluster] = (before[0] + n, [a + int(b) for a, b in zip(before[1], sums)])
    return found


def _placed(table: DataFrame, rounds: Rounds) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, _, _, at, best in rounds.place(batch):
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("_id"),
                        pa.array(at.astype(np.int32)),
                        pa.array([min(d, _LONGEST) for d in best], pa.int64()),
                    ],
                    ["id", "cluster", "distance"],
                )

    kind = dict(table.dtypes)["_id"]
    return table.mapInArrow(run, f"id {kind}, cluster int, distance bigint")


def spread_points(points: list[list[int]], count: int) -> list[list[int]]:
    """Distinct points far from each other: the first one, then each time the farthest from those taken."""
    taken: list[list[int]] = []
    gaps = [math.inf] * len(points)
    while points and len(taken) < count:
        i = max(range(len(points)), key=lambda i: (gaps[i], -i))
        if gaps[i] == 0:
            break
        taken.append(points[i])
        gaps = [min(g, squared(p, points[i])) for g, p in zip(gaps, points)]
    return taken


def kept_vectors(vectors: DataFrame, vec_id: str, embedding: str, dims: int) -> DataFrame:
    """``_id`` and ``_x`` of the vectors with ``dims`` components, none of them null, NaN or infinite."""
    x = F.col(embedding)

    def usable(v: Column) -> Column:
        v = v.cast("double")
        return v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))

    whole = F.coalesce((F.size(x) == dims) & F.forall(x, usable), F.lit(False))
    return vectors.where(whole).select(F.col(vec_id).alias("_id"), x.alias("_x"))


def clustered(
    vectors: DataFrame,
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    dims: int = DIMS,
    pivots: int = PIVOTS,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    scale: int = SCALE,
) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia and centroid_sha256 of every kept vector.

    Vectors with another number of components than ``dims``, or with one that is null,
    NaN or infinite, are left out. Components become ``floor(scale * x)``. The first
    centroids are the vectors with the smallest SHA-256 of ``3:<vec_id>`` (a null id
    counts as the empty text; equal hashes go by their components); with fewer vectors than
    ``clusters`` there are as many centroids as vectors. Repeated rows each count and each
    give a row; other columns are not read. Without any vector the result is empty.
    Distances and inertias beyond 64 bits are given as the largest long.
    """
    spark = vectors.sparkSession
    kept = kept_vectors(vectors, vec_id, embedding, dims)
    key = F.sha2(F.concat(F.lit("3:"), F.coalesce(F.col("_id").cast("string"), F.lit(""))).cast("binary"), 256)
    # a bounded number of vectors
    first = kept.orderBy(key, "_x").limit(max(clusters, PIVOT_CHOICE)).collect()
    start = [[scaled(x, scale) for x in r["_x"]] for r in first]
    chosen = spread_points([x for x in start if max(map(abs, x)) <= EXACT], pivots)
    centroids = start[:clusters]
    kind = dict(kept.dtypes)["_id"]
    if not centroids:
        names = "cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
        return spark.createDataFrame([], f"`{vec_id}` {kind}, {names}")

    table = staged(_with_pivots(kept, chosen, scale), "pivot-distances")
    for _ in range(rounds):
        found = _sums(table, Rounds(centroids, chosen, scale))
        moved = [
            [s // found[k][0] for s in found[k][1]] if k in found else centroid for k, centroid in enumerate(centroids)
        ]
        if moved == centroids:
            break
        centroids = moved
    placed = staged(_placed(table, Rounds(centroids, chosen, scale)), "placed")
    per_cluster = placed.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")).collect()
    inertia = {r["cluster"]: int(r["d"]) for r in per_cluster}
    total = min(sum(inertia.values()), _LONGEST)
    rows = [
        (k, min(inertia[k], _LONGEST), total, hashlib.sha256(",".join(map(str, c)).encode()).hexdigest())
        for k, c in enumerate(centroids)
        if k in inertia
    ]
    # one row per cluster
    figures = spark.createDataFrame(rows, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return placed.join(F.broadcast(figures), "cluster").select(
        F.col("id").alias(vec_id), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
