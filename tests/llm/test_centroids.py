import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import types as T

from millrace.llm import centroids as C
from millrace.llm.queries import QUERIES, SQL
from tests.llm.cases import CLASHING, SF
from tests.oracle import connect

KIND = {"float": T.FloatType(), "double": T.DoubleType()}


def vectors(spark, rows, kind="double"):
    schema = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(KIND[kind])), *[T.StructField(n, T.StringType()) for n in (*CLASHING, "cluster", "distance")]])
    return spark.createDataFrame([(i, v, *["x"] * (len(CLASHING) + 2)) for i, v in rows], schema)


def brute(rows, k=16, rounds=3):
    """Plain Python over whole numbers of any size."""
    kept = [(i, [int(x) * 64 if abs(x) >= 2**53 else math.floor(64 * x) for x in v], v) for i, v in rows if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    name = lambda i: hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
    centres = [v for _, v, _ in sorted(kept, key=lambda r: (name(r[0]), r[2]))[:k]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centres))
    for _ in range(rounds):
        groups = {}
        for _, v, _ in kept:
            groups.setdefault(near(v)[1], []).append(v)
        centres = [[sum(x) // len(x) for x in zip(*groups[n])] if n in groups else c for n, c in enumerate(centres)]
    rows = [(i, *near(v)[::-1]) for i, v, _ in kept]
    inertia = {n: sum(d for _, m, d in rows if m == n) for n in range(len(centres))}
    fit = lambda x: x if x < 2**63 else None
    every = sum(inertia.values())
    return sorted(((i, n, fit(d), fit(inertia[n]) if fit(d) is not None else None, fit(every), ",".join(map(str, centres[n]))) for i, n, d in rows), key=str)


def got(df, **options):
    return sorted((tuple(r) for r in C.cluster(df, **options).collect()), key=str)


def cloud(n, seed, scale=1.0):
    rng = random.Random(seed)
    middles = [[rng.gauss(0, scale) for _ in range(64)] for _ in range(7)]
    return [(i, [x + rng.gauss(0, scale / 5) for x in rng.choice(middles)]) for i in range(n)]


def test_transform_keeps_distances():
    x = np.random.default_rng(1).integers(-999, 999, (20, 64))
    t = C.transform(x)
    assert ((t[0] - t[1:]) ** 2).sum(axis=1).tolist() == (64 * ((x[0] - x[1:]) ** 2).sum(axis=1)).tolist()
    changes = (np.diff(np.sign(C.transform(np.eye(64, dtype=int))), axis=0) != 0).sum(axis=0)
    assert changes.tolist() == list(range(64))


@pytest.mark.parametrize("scale", [1, 5])
def test_nearest_is_exact(scale):
    rng = np.random.default_rng(scale)
    v, c = rng.integers(-3 * scale, 3 * scale, (3000, 64)), rng.integers(-scale, scale, (16, 64))
    c[5], c[9] = c[2], c[2]
    number, distance = C.nearest(v, c)
    full = ((v[:, None] - c[None]) ** 2).sum(axis=2)
    assert number.tolist() == full.argmin(axis=1).tolist() and distance.tolist() == full.min(axis=1).tolist()


def test_awkward_rows_equal_brute_force(spark):
    rows = cloud(300, 1)
    odd = [(1000, None), (1001, []), (1002, [0.5] * 63), (1003, [0.5] * 65), (1004, [None] + [0.1] * 63), (1005, [float("nan")] * 64), (1006, [float("inf")] * 64),
           (None, [0.25] * 64), (None, [-0.25] * 64), (7, rows[7][1]), (7, rows[9][1]), (1007, [0.0] * 64), (1008, [-0.0] * 64)]
    assert got(vectors(spark, rows + odd)) == brute(rows + odd)


def test_ties_few_and_no_vectors(spark):
    rows = [(i, [float(i % 2)] * 64) for i in range(12)]
    assert got(vectors(spark, rows)) == brute(rows)
    same = [(i, [0.5] * 64) for i in range(40)]
    assert got(vectors(spark, same)) == brute(same) and {r[1] for r in got(vectors(spark, same))} == {0}
    assert got(vectors(spark, [])) == [] and got(vectors(spark, [(1, None)])) == []


def test_large_components_are_exact(spark):
    rows = cloud(60, 2, 3e4) + [(100 + i, [s * 10.0**i] * 64) for i in range(4, 19, 2) for s in (-1, 1)]
    assert got(vectors(spark, rows)) == brute(rows)
    huge = [(1, [1e300] * 64), (2, [-1e300] * 64), (3, [2e300] * 64)]
    assert [r[:3] for r in got(vectors(spark, huge), k=2, rounds=1)] == [r[:3] for r in brute(huge, 2, 1)]


def test_query_equals_brute_force_and_sql(spark):
    rows = [(r.vec_id, [float(x) for x in r.embedding]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    want = [(*r[:5], hashlib.sha256(r[5].encode()).hexdigest()) for r in brute(rows)]
    found = sorted((tuple(r) for r in QUERIES["op13_hadamard_clustering"](spark, SF).collect()), key=str)
    assert found == sorted(want, key=str)
    assert sorted(connect(SF).execute(SQL["op13_hadamard_clustering"]).fetchall(), key=str) == found
