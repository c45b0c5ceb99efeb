"""Exact integer k-means whose distances are screened in PCA-rotated coordinates.

1. Vectors of the wanted length without null or non-finite components become
   integers, ``floor(scale * x)``.
2. A rotation (the principal axes of at most ``FIT_ROWS`` vectors with the
   smallest hashes) turns every vector; its ``LEAD`` leading coordinates and the
   norm of the rest are stored beside the integers, once. Any rotation gives the
   same result: it only decides how well the screen works.
3. In a round each task screens its vectors: the projected squared distance plus
   the squared difference of the residual norms never exceeds the true squared
   distance. The centroid with the smallest bound is verified in integers, then
   every other one whose bound (less a margin for rounding) is not above the
   distance found. Ties go to the smaller number.
4. A task returns one row per cluster with integer sums, Spark adds them, and
   ``k`` rows of means come to the driver (``k`` and the length bound them).

The vectors never move: a round is a scan of the stored table and a sum, so one
vector that a third of all rows repeat is no hot key.

Defined results: vectors that are null, of another length or with a null or
non-finite component are left out; repeated rows are vectors of their own, and
those with one ``vec_id`` are ordered by their components at the start; a null
``vec_id`` hashes like the empty id; with fewer vectors than ``k`` there are
that many centroids; an empty table gives an empty result. A component of which
the integer has more than 27 bits raises, as its squared distances would not
fit in a long. Texts play no part, and only ``vec_id`` and ``embedding`` are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import store

LENGTH, K, ROUNDS, SCALE, SEED = 64, 8, 10, 1024, 3
#: rotated coordinates that are stored; the others are known by their norm
LEAD = 16
#: vectors that the rotation is fitted on
FIT_ROWS = 4096
#: integers beyond this make squared distances that overflow
MOST = 1 << 27


def integer_vectors(vectors: DataFrame, length: int = LENGTH, scale: int = SCALE) -> DataFrame:
    """``vec_id, v`` (array of long) of the vectors that are kept."""
    x = F.col("embedding").cast("array<double>")
    rows = vectors.select("vec_id", x.alias("x")).where(F.size("x") == length)
    rows = rows.where(F.forall("x", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf")))))
    scaled = F.transform("x", lambda e: F.floor(F.when(F.abs(e) * scale < MOST, e * scale).otherwise(
        F.raise_error(F.lit("a component has more than 27 bits")).cast("double"))))
    return rows.select("vec_id", scaled.alias("v"))


def hash_order(vectors: DataFrame, seed: int = SEED) -> list:
    """Columns by which vectors are picked: the hash of the id, then the components."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    return [F.sha2(name.cast("binary"), 256), F.col("v")]


def principal_axes(rows: np.ndarray) -> np.ndarray:
    """Orthonormal axes (columns), those of the largest variance first."""
    if len(rows) < 2:
        return np.eye(rows.shape[1])
    _, axes = np.linalg.eigh(np.cov(rows.astype(float), rowvar=False))
    return axes[:, ::-1]


def with_projection(vectors: DataFrame, axes: np.ndarray, lead: int = LEAD) -> DataFrame:
    """Stored ``vec_id, v`` (32-bit integers), ``lead`` (doubles) and ``rest`` (norm of the other coordinates)."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for b in batches:
            v = b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
            turned = v.astype(float) @ axes
            first = np.ascontiguousarray(turned[:, :lead])
            rest = np.sqrt(np.square(turned[:, lead:]).sum(axis=1))
            small = np.ascontiguousarray(v.astype("<i4"))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([x.tobytes() for x in small], pa.binary()),
                                              pa.array([x.astype("<f8").tobytes() for x in first], pa.binary()), pa.array(rest, pa.float64())],
                                             names=["vec_id", "v", "lead", "rest"])

    schema = T.StructType([vectors.schema["vec_id"], T.StructField("v", T.BinaryType()), T.StructField("lead", T.BinaryType()), T.StructField("rest", T.DoubleType())])
    return store(vectors.select("vec_id", "v").mapInArrow(run, schema), "rotated-vectors")


@dataclass(frozen=True)
class Centroids:
    """Integer centroids with their projection."""

    v: np.ndarray
    lead: np.ndarray
    rest: np.ndarray

    @classmethod
    def of(cls, v: np.ndarray, axes: np.ndarray, lead: int) -> Centroids:
        turned = v.astype(float) @ axes
        return cls(v, turned[:, :lead], np.sqrt(np.square(turned[:, lead:]).sum(axis=1)))


def nearest(v: np.ndarray, lead: np.ndarray, rest: np.ndarray, to: Centroids) -> tuple[np.ndarray, np.ndarray, int]:
    """Number of and squared distance to the nearest centroid of each vector, and how many distances were verified."""
    bound = np.square(rest[:, None] - to.rest[None, :])
    for j in range(len(to.v)):
        bound[:, j] += np.square(lead - to.lead[j]).sum(axis=1)
    # rounding of the turned coordinates: relative to the squared norms of both vectors
    margin = 1e-10 * (np.square(lead).sum(axis=1) + np.square(rest))[:, None] + 1e-10 * (np.square(to.lead).sum(axis=1) + np.square(to.rest))[None, :] + 1e-3
    bound -= margin

    def exact(i: np.ndarray, j: np.ndarray) -> np.ndarray:
        return np.square(v[i].astype(np.int64) - to.v[j]).sum(axis=1)

    number = bound.argmin(axis=1)
    rows = np.arange(len(v))
    distance = exact(rows, number)
    checked = len(v)
    for j in range(len(to.v)):
        # a float above 2^53 is rounded: the margin covers that too
        i = np.flatnonzero((bound[:, j] <= distance) & (number != j))
        if not len(i):
            continue
        checked += len(i)
        d = exact(i, np.full(len(i), j))
        better = (d < distance[i]) | ((d == distance[i]) & (j < number[i]))
        number[i[better]], distance[i[better]] = j, d[better]
    return number, distance, checked


def _batch(b) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n = b.num_rows
    v = np.frombuffer(b"".join(b.column(1).to_pylist()), "<i4").reshape(n, -1)
    lead = np.frombuffer(b"".join(b.column(2).to_pylist()), "<f8").reshape(n, -1)
    return v, lead, b.column(3).to_numpy(zero_copy_only=False)


def cluster_sums(stored: DataFrame, to: Centroids, with_means: bool = True) -> dict[int, dict]:
    """Per cluster: ``n`` vectors, their summed ``distance`` and, for a new mean, their sum ``v`` - exact integers."""
    k, length = to.v.shape

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        n, total, sums, checked = np.zeros(k, np.int64), np.zeros(k, np.int64), np.zeros((k, length), np.int64), 0
        for b in batches:
            if not b.num_rows:
                continue
            v, lead, rest = _batch(b)
            number, distance, more = nearest(v, lead, rest, to)
            checked += more
            for j in np.unique(number):
                rows = number == j
                n[j] += int(rows.sum())
                total[j] += int(distance[rows].sum())
                if with_means:
                    sums[j] += v[rows].sum(axis=0, dtype=np.int64)
        if n.any():
            at = np.flatnonzero(n)
            columns = [pa.array(at, pa.int32()), pa.array(n[at]), pa.array(total[at]), pa.array([checked] + [0] * (len(at) - 1), pa.int64())]
            columns += [pa.array(sums[at, i]) for i in range(length)] if with_means else []
            yield pa.RecordBatch.from_arrays(columns, names=names)

    names = ["cluster", "n", "distance", "checked"] + ([f"s{i}" for i in range(length)] if with_means else [])
    schema = "cluster int, " + ", ".join(f"{c} long" for c in names[1:])
    parts = stored.mapInArrow(run, schema)
    # k rows
    rows = parts.groupBy("cluster").agg(*[F.sum(c).alias(c) for c in names[1:]]).collect()
    return {r["cluster"]: {"n": r["n"], "distance": r["distance"], "checked": r["checked"],
                           "v": [r[f"s{i}"] for i in range(length)] if with_means else None} for r in rows}


def clustered(vectors: DataFrame, k: int = K, rounds: int = ROUNDS, length: int = LENGTH, scale: int = SCALE,
              seed: int = SEED, lead: int = LEAD) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` of every vector that is kept."""
    ints = integer_vectors(vectors, length, scale)
    first = ints.orderBy(*hash_order(ints, seed)).limit(max(FIT_ROWS, k)).select("v").collect()  # bounded by parameter
    schema = T.StructType([vectors.schema["vec_id"], T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType()),
                           T.StructField("cluster_inertia", T.LongType()), T.StructField("inertia", T.LongType()), T.StructField("centroid_sha256", T.StringType())])
    if not first:
        return vectors.sparkSession.createDataFrame([], schema)
    sample = np.array([r["v"] for r in first], np.int64)
    axes = principal_axes(sample)
    stored = with_projection(ints, axes, lead)
    centroids = sample[:k]
    for _ in range(rounds):
        sums = cluster_sums(stored, Centroids.of(centroids, axes, lead))
        new = np.array([[s // sums[j]["n"] for s in sums[j]["v"]] if j in sums else c.tolist() for j, c in enumerate(centroids)], np.int64)
        if np.array_equal(new, centroids):
            break  # further rounds change nothing
        centroids = new
    to = Centroids.of(centroids, axes, lead)
    sums = cluster_sums(stored, to, with_means=False)
    each = [sums[j]["distance"] if j in sums else 0 for j in range(len(centroids))]
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for b in batches:
            if b.num_rows:
                number, distance, _ = nearest(*_batch(b), to)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.array(number, pa.int32()), pa.array(distance, pa.int64()), pa.array([each[j] for j in number], pa.int64()),
                     pa.array([sum(each)] * b.num_rows, pa.int64()), pa.array([digests[j] for j in number], pa.string())], names=schema.fieldNames())

    return stored.mapInArrow(run, schema)
