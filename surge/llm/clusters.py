"""Centroid clustering with ns-bounds, exact in integers.

Lloyd rounds keep, for every vector, an upper bound of the distance to its own
centroid and a lower bound for every other one, each with the round in which it
was last evaluated.  The history of all centroids is retained, so a stored bound is
loosened by the norm of the centroid's total displacement since that round (ns),
which is never more than the sum of its per-round drifts (sn).  A lower bound that
still exceeds the upper bound rules its centroid out; where it fails, the own distance
is evaluated first, then, if the bound fails again, the pair itself, both exactly.

The vectors and their bounds are a table that every round writes to the shared folder
and the next one reads; a round moves one row of sums per cluster and task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surge.llm.staging import release, staged

#: Largest absolute value of an integer component: squared distances of up to 2**8 components fit 63 bits.
LARGEST = 1 << 26
#: Below this, products of up to 2**8 components are exact in doubles.
EXACT = 1 << 21
#: Rounding errors of a square root and two additions, as a share of the distance.
SLACK = 1e-9
STATE = "id long, x binary, cluster int, upper double, upper_round int, lower binary, lower_round binary, evaluated long"


def squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows of x from all rows of y."""
    if max(np.abs(x).max(initial=0), np.abs(y).max(initial=0)) < EXACT:
        a, b = x.astype(np.float64), y.astype(np.float64)
        return ((a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2.0 * (a @ b.T)).astype(np.int64)
    return np.stack([((x - row) ** 2).sum(1) for row in y], axis=1)


def paired(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows of x from the same rows of y."""
    d = x - y
    return (d * d).sum(1)


class Bounds:
    """Bounds of a batch: ``cluster``, ``upper`` and ``lower`` with the rounds in which they were evaluated."""

    def __init__(self, cluster: np.ndarray, upper: np.ndarray, upper_round: np.ndarray, lower: np.ndarray, lower_round: np.ndarray):
        self.cluster, self.upper, self.upper_round = cluster, upper, upper_round
        self.lower, self.lower_round = lower, lower_round
        self.evaluated = np.zeros(len(cluster), dtype=np.int64)

    @classmethod
    def first(cls, x: np.ndarray, centroids: np.ndarray) -> "Bounds":
        d = squared(x, centroids)
        root = np.sqrt(d.astype(np.float64))
        best = d.argmin(1)  # the smaller number of equals
        zero = np.zeros(len(x), dtype=np.int64)
        new = cls(best, root[np.arange(len(x)), best], zero, _below(root), np.zeros(d.shape, dtype=np.uint16))
        new.evaluated[:] = d.shape[1]
        return new

    def next(self, x: np.ndarray, history: np.ndarray) -> None:
        """Assign to the last centroids of ``history`` (round, centroid, component)."""
        now, n, k = len(history) - 1, len(x), history.shape[1]
        moved = np.sqrt(((history - history[-1]).astype(np.float64) ** 2).sum(2)) * (1 + SLACK)  # by round and centroid
        rows = np.arange(n)
        upper = self.upper + moved[self.upper_round, self.cluster]
        lower = self.lower - moved[self.lower_round, np.arange(k)[None, :]]
        fails = lower <= (upper * (1 + SLACK))[:, None]
        fails[rows, self.cluster] = False
        loose = np.flatnonzero(fails.any(1) & (self.upper_round < now))
        own = np.full(n, -1, dtype=np.int64)
        if len(loose):
            own[loose] = paired(x[loose], history[-1][self.cluster[loose]])
            self.evaluated[loose] += 1
            self._evaluated(loose, self.cluster[loose], own[loose], now)
            self.upper[loose], self.upper_round[loose] = np.sqrt(own[loose].astype(np.float64)), now
            fails[loose] &= lower[loose] <= (self.upper[loose] * (1 + SLACK))[:, None]
        row, centroid = np.nonzero(fails)
        if not len(row):
            return
        d = np.concatenate([paired(x[row[at:at + 65536]], history[-1][centroid[at:at + 65536]]) for at in range(0, len(row), 65536)])
        self._evaluated(row, centroid, d, now)
        np.add.at(self.evaluated, row, 1)
        touched = np.unique(row)
        row, centroid, d = np.concatenate([touched, row]), np.concatenate([self.cluster[touched], centroid]), np.concatenate([own[touched], d])
        order = np.lexsort((centroid, d, row))
        row, centroid, d = row[order], centroid[order], d[order]
        lead = np.concatenate([[True], row[1:] != row[:-1]])
        row, centroid, d = row[lead], centroid[lead], d[lead]
        self.cluster[row], self.upper[row], self.upper_round[row] = centroid, np.sqrt(d.astype(np.float64)), now

    def _evaluated(self, row: np.ndarray, centroid: np.ndarray, d: np.ndarray, now: int) -> None:
        self.lower[row, centroid] = _below(np.sqrt(d.astype(np.float64)))
        self.lower_round[row, centroid] = now


def _below(x: np.ndarray) -> np.ndarray:
    """The nearest smaller value in single precision."""
    return np.nextafter(x.astype(np.float32), np.float32(-1))


def _fixed(column: pa.Array, kind: type, width: int) -> np.ndarray:
    """Rows of ``width`` numbers from a binary column without nulls (one copy-free view)."""
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int32)[column.offset:column.offset + len(column) + 1]
    return np.frombuffer(data, dtype=np.uint8)[at[0]:at[-1]].view(kind).reshape(len(column), width)


def _bytes(rows: np.ndarray) -> pa.Array:
    rows = np.ascontiguousarray(rows)
    ends = np.arange(len(rows) + 1, dtype=np.int32) * (rows.nbytes // max(len(rows), 1))
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(ends), pa.py_buffer(rows)])


def _state(ids: pa.Array, x: pa.Array, b: Bounds) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [ids.cast(pa.int64()), x, pa.array(b.cluster.astype(np.int32)), pa.array(b.upper), pa.array(b.upper_round.astype(np.int32)),
         _bytes(b.lower), _bytes(b.lower_round), pa.array(b.evaluated)],
        names=["id", "x", "cluster", "upper", "upper_round", "lower", "lower_round", "evaluated"])


def _first_pass(rows: DataFrame, centroids: np.ndarray) -> DataFrame:
    dim = centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = _fixed(batch.column("x"), np.int32, dim).astype(np.int64)
                yield _state(batch.column("id"), batch.column("x"), Bounds.first(x, centroids))

    return rows.mapInArrow(run, STATE)


def _next_pass(state: DataFrame, history: np.ndarray) -> DataFrame:
    _, k, dim = history.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            number = [batch.column(c).to_numpy(zero_copy_only=False).copy() for c in ("cluster", "upper", "upper_round")]
            b = Bounds(*number, _fixed(batch.column("lower"), np.float32, k).copy(), _fixed(batch.column("lower_round"), np.uint16, k).copy())
            b.next(_fixed(batch.column("x"), np.int32, dim).astype(np.int64), history)
            yield _state(batch.column("id"), batch.column("x"), b)

    return state.mapInArrow(run, STATE)


def _integers(df: DataFrame, dim: int, scale: int, id_col: str, vector_col: str) -> DataFrame:
    """(id, x): kept vectors as packed 32-bit integers."""
    vector = F.col(f"`{vector_col}`")
    bad = F.exists(vector, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    kept = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.transform(vector, lambda v: v.cast("double")).alias("v")) \
        .where((F.size("v") == dim) & ~bad)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                flat = batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
                whole = np.floor(scale * flat)
                if np.abs(whole).max() > LARGEST:
                    raise ValueError(f"a component exceeds {LARGEST / scale}: squared distances would not fit 64 bits")
                yield pa.RecordBatch.from_arrays([batch.column("id"), _bytes(whole.astype(np.int32))], names=["id", "x"])

    return kept.mapInArrow(run, "id long, x binary")


def _sums(state: DataFrame, k: int, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Sizes and exact componentwise sums of the clusters: k rows reach the driver."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros((k, dim), dtype=np.int64), np.zeros(k, dtype=np.int64)
        for batch in batches:
            if batch.num_rows:
                cluster = batch.column("cluster").to_numpy(zero_copy_only=False)
                x = _fixed(batch.column("x"), np.int32, dim).astype(np.int64)
                order = np.argsort(cluster, kind="stable")
                at = np.flatnonzero(np.diff(cluster[order], prepend=-1))
                total[cluster[order][at]] += np.add.reduceat(x[order], at, axis=0)
                count += np.bincount(cluster, minlength=k)
        seen = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(count[seen]), pa.array(total[seen].tolist(), pa.list_(pa.int64()))],
                                         names=["cluster", "n", "total"])

    part = state.select("cluster", "x").mapInArrow(run, "cluster int, n long, total array<long>")
    rows = part.groupBy("cluster").agg(F.sum("n").alias("n"), *[F.sum(F.col("total")[i]).alias(f"s{i}") for i in range(dim)]).collect()
    total, count = np.zeros((k, dim), dtype=np.int64), np.zeros(k, dtype=np.int64)
    for r in rows:
        count[r[0]], total[r[0]] = r[1], r[2:]
    return count, total


def ns_kmeans(df: DataFrame, k: int = 40, rounds: int = 5, dim: int = 64, scale: int = 256, seed: int = 2,
              id_col: str = "vec_id", vector_col: str = "embedding") -> tuple[DataFrame, np.ndarray]:
    """Assignment of every vector and the final centroids (k x dim, bounded by the parameters).

    The table has (id, x, cluster, distance, evaluated): the 32-bit little-endian components, the number of the nearest
    centroid, the squared distance and the number of distances evaluated in the last pass.

    Kept are vectors with exactly ``dim`` components, none null, NaN or infinite; a component x becomes floor(scale * x).
    The first centroids are the k vectors with the least SHA-256 of ``seed:id`` (fewer, if there are fewer vectors; rows
    that share an id follow their components, a null id counts as empty text).  Ties of distance go to the smaller number;
    repeated rows count each; an empty table gives an empty result and no centroids; other columns are not read.
    Components beyond ``LARGEST / scale`` raise ValueError.
    """
    if rounds >= 1 << 16 or dim > 1 << 8:
        raise ValueError("at most 65535 rounds and 256 components")
    vectors = staged(_integers(df, dim, scale, id_col, vector_col), "cluster-vectors")
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    start = vectors.select(name.alias("name"), "x").orderBy("name", "x").limit(k).collect()
    centroids = np.array([np.frombuffer(r["x"], dtype=np.int32) for r in start], dtype=np.int64).reshape(-1, dim)
    if not len(centroids):
        return vectors.select("id", "x", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance"), F.lit(0).cast("long").alias("evaluated")), centroids
    history = centroids[None]
    state = staged(_first_pass(vectors, centroids), "cluster-state")
    release(vectors)
    for _ in range(rounds):
        count, total = _sums(state, len(centroids), dim)
        centroids = np.where(count[:, None] > 0, total // np.maximum(count, 1)[:, None], centroids)
        history = np.concatenate([history, centroids[None]])
        before, state = state, staged(_next_pass(state, history), "cluster-state")
        release(before)  # two rounds at most are on disk

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cluster = batch.column("cluster").to_numpy(zero_copy_only=False)
            d = paired(_fixed(batch.column("x"), np.int32, dim).astype(np.int64), centroids[cluster])
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("x"), batch.column("cluster"), pa.array(d), batch.column("evaluated")],
                                             names=["id", "x", "cluster", "distance", "evaluated"])

    return state.select("id", "x", "cluster", "evaluated").mapInArrow(run, "id long, x binary, cluster int, distance long, evaluated long"), centroids


def cluster_report(df: DataFrame, k: int = 40, rounds: int = 5, **names: str) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every kept vector; rules as in ``ns_kmeans``."""
    rows, centroids = ns_kmeans(df, k, rounds, **names)
    spark = df.sparkSession
    digest = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]
    about = spark.createDataFrame(list(enumerate(digest)), "cluster int, centroid_sha256 string")  # k rows
    sums = rows.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    about = sums.join(F.broadcast(about), "cluster").withColumn("inertia", sums.agg(F.sum("cluster_inertia")).scalar())
    return rows.join(F.broadcast(about), "cluster").select(F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
