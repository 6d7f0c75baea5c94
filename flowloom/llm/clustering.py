"""Centroid clustering: k-means by Shallot search over integer vectors.

A vector keeps its centroid, the second-nearest one it met last, an upper bound on its distance to the first and a lower
bound on that to all others; both bounds move with the centroids. Only if they overlap is a vector looked at again:

1. Its distances to the two remembered centroids are computed; if the first is below the lower bound, it stays.
2. Otherwise the search starts from the closer one. Its neighbours are visited in the order of their distance s from it.
   A centroid with s beyond r + d2 (r: the vector's distance to the start, d2: that to the second-best so far) is
   farther away than both, and so are all after it; d2 falls as the scan goes on, and the ball with it.
3. Survivors are compared by squared distance in 64-bit integers, equal ones by number. Bounds are floating-point numbers
   kept on the safe side, so they never decide between equals.

Each round is one job that reads the vectors with their state from the shared folder and writes them with the new one, and
one that adds up each cluster (a row for each task, cluster and component before the shuffle). The driver holds the centroids.
The state before is removed when the next is written. If no centroid moves, further rounds would change nothing: they end.

Defined cases: vectors that are null, have another number of components, or a null or non-finite one, are left out. Repeated
rows count one by one. Ties: the smaller centroid number; among first centroids of one vec_id, the smaller vector in bytes.
A null vec_id counts as empty text in the choice of the first centroids. With fewer vectors than centroids there are as
many centroids as vectors; an empty table gives no rows. Components beyond 2**27 after scaling raise an error, as their
squared distances would not fit 64 bits. Other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowloom.llm.common import discarded
from flowloom.session import shared_dir

CLUSTERS, ROUNDS, SIZE, SCALE, SEED = 8, 10, 64, 1024, 3
LIMIT = 1 << 27
STATE = "vec_id long, vector binary, cluster int, second int, upper double, lower double, distance long"
#: Relative room for rounding in the bounds.
ROOM = 1e-12


def usable(vector: Column, size: int) -> Column:
    """Whether a vector has ``size`` finite components."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(vector) == size) & finite, F.lit(False))


def to_bytes(rows: np.ndarray) -> list[bytes]:
    """Integer rows in the narrowest type that holds them."""
    most = int(np.abs(rows).max(initial=0))
    kind = np.dtype("<i2" if most < 1 << 15 else "<i4")
    flat = rows.astype(kind).tobytes()
    step = rows.shape[1] * kind.itemsize
    return [flat[k : k + step] for k in range(0, len(flat), step)]


def from_bytes(column: list[bytes], size: int) -> np.ndarray:
    """The inverse of ``to_bytes`` for rows of mixed types."""
    out = np.empty((len(column), size), np.int64)
    for width in {len(x) for x in column}:
        own = [k for k, x in enumerate(column) if len(x) == width]
        out[own] = np.frombuffer(b"".join(column[k] for k in own), f"<i{width // size}").reshape(-1, size)
    return out


class Centroids:
    """Integer centroids, each with its neighbours by distance."""

    def __init__(self, rows: np.ndarray):
        self.rows = rows
        apart = np.sqrt(((rows[:, None] - rows[None]) ** 2).sum(2).astype(float))
        order = np.argsort(apart, axis=1, kind="stable")
        # Without the centroid itself, which may not come first where centroids coincide.
        self.near = np.array([[c for c in own if c != k] for k, own in enumerate(order)], np.int64).reshape(len(rows), len(rows) - 1)
        self.apart = np.take_along_axis(apart, self.near, 1)

    def squared(self, vectors: np.ndarray, which: np.ndarray) -> np.ndarray:
        gap = vectors - self.rows[which]
        return np.einsum("ij,ij->i", gap, gap)


def search(vectors: np.ndarray, first: np.ndarray, second: np.ndarray, centroids: Centroids):
    """The nearest and second-nearest centroid of each vector and the squared distances, from two known centroids."""
    d1, d2 = centroids.squared(vectors, first), centroids.squared(vectors, second)
    swap = (d2 < d1) | ((d2 == d1) & (second < first))
    c1, c2 = np.where(swap, second, first), np.where(swap, first, second)
    d1, d2 = np.where(swap, d2, d1), np.where(swap, d1, d2)
    start, other, radius = c1.copy(), c2.copy(), np.sqrt(d1.astype(float))
    open_rows = np.arange(len(vectors))
    for k in range(centroids.near.shape[1]):
        ball = (radius[open_rows] + np.sqrt(d2[open_rows].astype(float))) * (1 + ROOM)
        open_rows = open_rows[centroids.apart[start[open_rows], k] <= ball]
        if not len(open_rows):
            break
        c = centroids.near[start[open_rows], k]
        own, c = open_rows[c != other[open_rows]], c[c != other[open_rows]]
        d = centroids.squared(vectors[own], c)
        best = (d < d1[own]) | ((d == d1[own]) & (c < c1[own]))
        next_best = ~best & ((d < d2[own]) | ((d == d2[own]) & (c < c2[own])))
        moved = own[best]
        c2[moved], d2[moved] = c1[moved], d1[moved]
        c1[moved], d1[moved] = c[best], d[best]
        c2[own[next_best]], d2[own[next_best]] = c[next_best], d[next_best]
    return c1, c2, d1, d2


def assigned(vectors: np.ndarray, state: tuple, centroids: Centroids, shift: np.ndarray):
    """The new state (cluster, second, upper, lower) of vectors whose centroids have moved by ``shift``, and how many were searched."""
    cluster, second, upper, lower = (x.copy() for x in state)
    k = len(shift)
    if k == 1:
        return (cluster, second, np.sqrt(centroids.squared(vectors, cluster).astype(float)), lower), 0
    upper = (upper + shift[cluster]) * (1 + ROOM)
    most = np.argmax(shift)
    rest = np.delete(shift, most).max()
    lower = lower - np.where(cluster == most, rest, shift[most]) * (1 + ROOM)
    rows = np.flatnonzero(upper >= lower)
    exact = np.sqrt(centroids.squared(vectors[rows], cluster[rows]).astype(float)) * (1 + ROOM)
    upper[rows] = exact
    rows = rows[exact >= lower[rows]]
    c1, c2, d1, d2 = search(vectors[rows], cluster[rows], second[rows], centroids)
    cluster[rows], second[rows] = c1, c2
    upper[rows], lower[rows] = np.sqrt(d1.astype(float)) * (1 + ROOM), np.sqrt(d2.astype(float)) * (1 - ROOM)
    return (cluster, second, upper, lower), len(rows)


def _first_state(df: DataFrame, id_col: str, vector_col: str, size: int, scale: int) -> DataFrame:
    vector = F.col(vector_col).cast("array<double>")
    kept = df.select(F.col(id_col).cast("long").alias("vec_id"), vector.alias("vector")).where(usable(F.col("vector"), size))

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            scaled = np.floor(scale * batch.column("vector").flatten().to_numpy(zero_copy_only=False).reshape(-1, size))
            if np.abs(scaled).max() > LIMIT:
                raise OverflowError(f"components beyond {LIMIT} after scaling: squared distances would not fit 64 bits")
            n = len(scaled)
            rest = [pa.array(np.zeros(n, np.int32)), pa.array(np.ones(n, np.int32)), pa.array(np.full(n, np.inf)), pa.array(np.full(n, -np.inf)), pa.array(np.zeros(n, np.int64))]
            vectors = pa.array(to_bytes(scaled.astype(np.int64)), pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), vectors, *rest], ["vec_id", "vector", "cluster", "second", "upper", "lower", "distance"])

    return kept.mapInArrow(run, STATE)


def _round(state: DataFrame, rows: np.ndarray, shift: np.ndarray) -> DataFrame:
    """The state of all vectors after an assignment to the centroids ``rows``, which moved by ``shift``."""

    def run(batches):
        centroids = Centroids(rows)
        for batch in batches:
            vectors = from_bytes(batch.column("vector").to_pylist(), rows.shape[1])
            held = tuple(batch.column(c).to_numpy() for c in ("cluster", "second", "upper", "lower"))
            new, _ = assigned(vectors, held, centroids, shift)
            cluster, second = (x.astype(np.int32) for x in new[:2])
            arrays = [batch.column("vec_id"), batch.column("vector"), *(pa.array(x) for x in (cluster, second, *new[2:], centroids.squared(vectors, cluster)))]
            yield pa.RecordBatch.from_arrays(arrays, ["vec_id", "vector", "cluster", "second", "upper", "lower", "distance"])

    return state.mapInArrow(run, STATE)


def _means(state: DataFrame, rows: np.ndarray) -> np.ndarray:
    """The exact floor of each cluster's mean; a cluster without vectors keeps its centroid."""
    k, size = rows.shape

    def run(batches):
        sums, counts = np.zeros((k, size), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            cluster = batch.column("cluster").to_numpy()
            vectors = from_bytes(batch.column("vector").to_pylist(), size)
            for c in np.unique(cluster):
                own = cluster == c
                sums[c] += vectors[own].sum(0)
                counts[c] += own.sum()
        used = np.repeat(np.flatnonzero(counts), size)
        place = np.tile(np.arange(size), len(used) // size)
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (used, place, counts[used], sums[used, place])], ["cluster", "place", "n", "s"])

    parts = state.select("cluster", "vector").mapInArrow(run, "cluster long, place long, n long, s long")
    new = rows.copy()
    # Sums as decimals: of 2**40 vectors they need not fit 64 bits.
    totals = F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(20,0)")).alias("s")
    for r in parts.groupBy("cluster", "place").agg(*totals).collect():
        new[r.cluster, r.place] = int(r.s) // r.n
    return new


def clustered(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", clusters: int = CLUSTERS, rounds: int = ROUNDS, size: int = SIZE, scale: int = SCALE, seed: int = SEED) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256): each vector after ``rounds`` rounds."""
    spark = df.sparkSession

    def written(state: DataFrame) -> tuple[DataFrame, str]:
        path = shared_dir(spark, "vectors")
        state.write.parquet(path)
        return spark.read.schema(STATE).parquet(path), path

    state, path = written(_first_state(df, id_col, vector_col, size, scale))
    place = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    chosen = state.select("vector", place.alias("place")).orderBy("place", "vector").limit(clusters).collect()
    if not chosen:
        return state.selectExpr("vec_id", "cluster", "distance", "distance AS cluster_inertia", "distance AS inertia", "'' AS centroid_sha256")
    rows = from_bytes([bytes(r.vector) for r in chosen], size)
    shift = np.zeros(len(rows))
    for turn in range(rounds + 1):
        before = path
        state, path = written(_round(state, rows, shift))
        discarded(spark, before)
        new = _means(state, rows) if turn < rounds else rows
        if (new == rows).all():
            break
        shift = np.sqrt(((new - rows) ** 2).sum(1).astype(float))
        rows = new
    sums = {r.cluster: r.s for r in state.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    of = lambda values: F.array(*map(F.lit, values))[F.col("cluster")]
    inertia = of([sums.get(c, 0) for c in range(len(rows))]).cast("long")
    hashes = [hashlib.sha256(",".join(map(str, r)).encode()).hexdigest() for r in rows.tolist()]
    return state.select("vec_id", "cluster", "distance", inertia.alias("cluster_inertia"), F.lit(sum(sums.values())).cast("long").alias("inertia"), of(hashes).alias("centroid_sha256"))
