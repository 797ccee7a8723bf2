"""Centroid clustering of whole-number vectors; the nearest centroid is found by progressive search over Walsh-Hadamard coefficients.

A vector of 64 components becomes 64 integers floor(64 * x). Their Walsh-Hadamard transform is exact in integers, and the squared differences of all
64 coefficients add up to 64 times the squared Euclidean distance. Differences are added coarse to fine (by sequency): after the first coefficients the
leading centroid is measured in full; every centroid whose sum so far is already larger than that is strictly worse and drops out; what is left is
measured with the next coefficients, down to all 64. So the nearest centroid, and ties for the smaller number, are exact.

A round reads the table once, in tasks that send one row of sums for each centroid; Spark adds them up, and the driver sees one row a centroid. Centroids (at most
``k`` times 64 integers) travel with the tasks.

Defined cases: vectors that are null, have another number of components, or hold a null, NaN or infinite component are not kept. Repeated rows count each. Where ids
are null or repeated, the hash order of the first centroids goes on with the vector itself. With fewer vectors than ``k`` there are as many centroids as vectors;
an empty table gives no rows. Components of any finite size are exact (Python integers beyond 2**24); a distance or sum that does not fit 64 bits is null.
Other columns stay out of the way, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.sources.session import cut_lineage

DIMS = 64
#: How many coefficients are in the sums when centroids are eliminated.
STEPS = (2, 8, 24, 64)
#: Up to this size of a component all sums fit 64 bits: 64 coefficients, 64 * (2 * 2**24)**2 * 64 < 2**63.
SMALL = 2**24
ROWS = 4096
LIMB = 2**40
LONG_MAX = 2**63 - 1


def transform(x: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard transform of every row, coefficients ordered by their number of sign changes."""
    half = 1
    while half < DIMS:
        pairs = x.reshape(len(x), DIMS // (2 * half), 2, half)
        x = np.stack((pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]), 2).reshape(len(x), DIMS)
        half *= 2
    return x[:, SEQUENCY]


SEQUENCY = np.arange(DIMS)
SEQUENCY = np.argsort((np.diff(np.sign(transform(np.eye(DIMS, dtype=np.int64))), axis=0) != 0).sum(axis=0))


def whole(values: np.ndarray) -> np.ndarray:
    """floor(64 * x): 64-bit integers, or Python integers where a component is large."""
    if not values.size or np.abs(values).max() <= SMALL / DIMS - 1:
        return np.floor(values * 64).astype(np.int64)
    exact = [int(x) * 64 if abs(x) >= 2**53 else math.floor(64 * x) for x in values.ravel().tolist()]
    return np.array(exact, dtype=object).reshape(values.shape)


def nearest(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid and squared distance of every vector."""
    if vectors.dtype != centroids.dtype:
        vectors, centroids = vectors.astype(object), centroids.astype(object)
    x, y = transform(vectors), transform(centroids)
    first = STEPS[0]
    sums = ((x[:, None, :first] - y[None, :, :first]) ** 2).sum(axis=2)
    leader = sums.argmin(axis=1)
    bound = ((x - y[leader]) ** 2).sum(axis=1)
    row, number = np.nonzero(sums <= bound[:, None])
    sums = sums[row, number]
    for start, stop in zip(STEPS, STEPS[1:]):
        sums = sums + ((x[row, start:stop] - y[number, start:stop]) ** 2).sum(axis=1)
        left = np.nonzero(sums <= bound[row])[0]
        row, number, sums = row[left], number[left], sums[left]
    order = np.argsort(sums, kind="stable")
    order = order[np.argsort(row[order], kind="stable")]  # by row, then sum, then number
    row, number, sums = row[order], number[order], sums[order]
    best = np.flatnonzero(np.r_[True, row[1:] != row[:-1]]) if len(row) else row
    return number[best], sums[best] // DIMS


def as_matrix(numbers: list[list[int]]) -> np.ndarray:
    small = all(abs(x) <= SMALL for row in numbers for x in row)
    return np.array(numbers, dtype=np.int64 if small else object).reshape(len(numbers), DIMS)


def slices(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            part = batch.slice(at, ROWS)
            yield part, whole(part.column(column).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(part.num_rows, DIMS))


def digits(total: int) -> list[int]:
    """Signed digits of base LIMB, smallest first: sums of any size add up in 64-bit columns."""
    sign, total, out = (-1 if total < 0 else 1), abs(total), []
    while total:
        out.append(sign * (total % LIMB))
        total //= LIMB
    return out


def cluster_sums(kept: DataFrame, column: str, centroids: list[list[int]]) -> dict[int, tuple[int, list[int]]]:
    """Count and componentwise sum of the vectors nearest to each centroid."""
    matrix = as_matrix(centroids)
    names = [f"s{i}" for i in range(DIMS)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = [0] * len(matrix), [[0] * DIMS for _ in matrix]
        for _, vectors in slices(batches, column):
            number, _ = nearest(vectors, matrix)
            for c in np.unique(number).tolist():
                mine = vectors[number == c]
                counts[c] += len(mine)
                sums[c] = [a + b for a, b in zip(sums[c], mine.sum(axis=0).tolist(), strict=True)]
        rows = []
        for c, n in enumerate(counts):
            parts = [digits(s) for s in sums[c]]
            for limb in range(max(1, *map(len, parts)) if n else 0):
                rows.append((c, limb, n if limb == 0 else 0, *(p[limb] if limb < len(p) else 0 for p in parts)))
        if rows:
            types = [pa.int32(), pa.int32(), *[pa.int64()] * (DIMS + 1)]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*rows, strict=True), types, strict=True)], names=["cluster", "limb", "n", *names])

    schema = "cluster int, limb int, n bigint, " + ", ".join(f"{x} bigint" for x in names)
    partial = kept.select(column).mapInArrow(run, schema)
    out: dict[int, tuple[int, list[int]]] = {}
    for r in partial.groupBy("cluster", "limb").agg(F.sum("n").alias("n"), *[F.sum(x).alias(x) for x in names]).collect():
        n, sums = out.get(r.cluster, (0, [0] * DIMS))
        out[r.cluster] = n + r.n, [s + r[x] * LIMB**r.limb for s, x in zip(sums, names, strict=True)]
    return out


def assigned(kept: DataFrame, id_col: str, column: str, centroids: list[list[int]]) -> DataFrame:
    matrix = as_matrix(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, vectors in slices(batches, column):
            number, distance = nearest(vectors, matrix)
            fits = [d if d <= LONG_MAX else None for d in distance.tolist()]
            yield pa.RecordBatch.from_arrays([part.column(id_col), pa.array(number, pa.int32()), pa.array(fits, pa.int64())], names=[id_col, "cluster", "distance"])

    source = kept.select(id_col, column)
    return source.mapInArrow(run, f"`{id_col}` {source.dtypes[0][1]}, cluster int, distance bigint")


def seed_order(id_col: str, seed: int) -> Column:
    return F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)


def usable(column: str) -> Column:
    fine = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce((F.size(column) == DIMS) & fine, F.lit(False))


def cluster(vectors: DataFrame, k: int = 16, rounds: int = 3, id_col: str = "vec_id", column: str = "embedding", seed: int = 1) -> DataFrame:
    """id, ``cluster``, ``distance`` (squared), ``cluster_inertia``, ``inertia`` and ``centroid`` (64 integers as decimal text joined by commas) of every kept vector."""
    kept = vectors.select(id_col, column).where(usable(column))
    first = kept.orderBy(seed_order(id_col, seed), F.col(column)).limit(k)
    centroids = [row.tolist() for r in first.collect() for row in whole(np.array([r[1]], dtype=np.float64))]
    for _ in range(rounds if centroids else 0):
        found = cluster_sums(kept, column, centroids)
        centroids = [[s // found[c][0] for s in found[c][1]] if c in found else old for c, old in enumerate(centroids)]
    rows = cut_lineage(assigned(kept, id_col, column, centroids) if centroids else kept.select(id_col, F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")).limit(0), "assigned")
    total = F.when(F.count("distance") == F.count(F.lit(1)), F.sum(F.col("distance").cast("decimal(38,0)")))
    sums = {r["cluster"]: r["total"] for r in rows.groupBy("cluster").agg(total.alias("total")).collect()}
    everything = None if None in sums.values() else sum(sums.values())
    facts = [(c, fitting(sums[c]), fitting(everything), ",".join(map(str, centroids[c]))) for c in sorted(sums)]
    facts = vectors.sparkSession.createDataFrame(facts, "cluster int, cluster_inertia bigint, inertia bigint, centroid string")
    return rows.join(F.broadcast(facts), "cluster").select(id_col, "cluster", "distance", "cluster_inertia", "inertia", "centroid")


def fitting(total) -> int | None:
    return int(total) if total is not None and total <= LONG_MAX else None

