"""Centroid clustering against brute force: ties, huge components, odd rows."""

import hashlib
import math

import numpy as np
import pytest
from oracle import differences
from pyspark.sql import functions as F

from threadline.llm import kmeans
from threadline.llm.queries import ORACLE_SQL, op12_kmeans


def nearest(x, centroids):
    """Brute force over Python ints."""
    d = [sum((int(a) - int(b)) ** 2 for a, b in zip(x, c, strict=True)) for c in centroids]
    return d.index(min(d)), min(d)


@pytest.mark.parametrize(("k", "dimension", "most"), [(1, 3, 5), (2, 2, 3), (8, 64, 300), (40, 2, 4), (100, 3, 6), (60, 4, 10**9), (9, 2, 10**20)])
def test_tree_equals_brute_force(k, dimension, most):
    """Small grids are full of ties and equal centroids."""
    rng = np.random.default_rng(k)
    whole = (lambda n: np.array([[int(v * 4) * (most // 4) for v in r] for r in rng.uniform(-1, 1, (n, dimension))], dtype=object)) if most > 2**53 else (lambda n: rng.integers(-most, most, (n, dimension)).astype(float))
    c, x = whole(k), whole(300)
    number, d = kmeans.Tree(c).nearest(x)
    assert list(zip(number.tolist(), map(int, d), strict=True)) == [nearest(r, c) for r in x]


def reference(rows, k=8, rounds=10, scale=1024, dimension=64):
    kept = [(i, [math.floor(scale * v) for v in x]) for i, x in rows if i is not None and x is not None and len(x) == dimension and all(v is not None and math.isfinite(v) for v in x)]
    seeds = sorted(kept, key=lambda r: (hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[1]))[:k]
    centroids = [x for _, x in seeds]
    for _ in range(rounds):
        groups = {}
        for _, x in kept:
            groups.setdefault(nearest(x, centroids)[0], []).append(x)
        centroids = [[sum(v) // len(groups[c]) for v in zip(*groups[c], strict=True)] if c in groups else old for c, old in enumerate(centroids)]
    final = [(i, *nearest(x, centroids)) for i, x in kept]
    inertia = [sum(d for _, c, d in final if c == n) for n in range(len(centroids))]
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]

    def long(v):
        return v if v < 2**63 else None

    return sorted((i, c, long(d), long(inertia[c]), long(sum(inertia)), digests[c]) for i, c, d in final)


def got(df, **options):
    return sorted(tuple(r[c] for c in ("id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")) for r in kmeans.clusters(df, **options).collect())


def test_odd_rows(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(v) for v in rng.normal(size=64)]) for i in range(60)]
    rows += [rows[3], (7, rows[4][1]), (None, rows[5][1]), (61, None), (62, [1.0] * 63), (63, [None] + [1.0] * 63), (64, [float("nan")] * 64), (65, [float("inf")] * 64), (66, []), (67, [0.0] * 64), (68, [-1e-9] * 64)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({c: F.lit("x") for c in ("id", "v", "cluster", "distance")})
    assert got(df) == reference(rows)
    few = rows[:3]
    assert got(spark.createDataFrame(few, "vec_id long, embedding array<double>")) == reference(few)
    assert kmeans.clusters(df.where("false")).count() == 0


def test_huge_components(spark):
    rows = [(i, [float(10**12) * i, -5.0 * i]) for i in range(9)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert got(df, dimension=2, k=3) == reference(rows, k=3, dimension=2)
    rows = [(i, [3e38 * (-1) ** i, 1.0 * i]) for i in range(9)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert got(df, dimension=2, k=3) == reference(rows, k=3, dimension=2)


def test_against_sql(spark, tiny):
    assert differences(spark, op12_kmeans, ORACLE_SQL["op12_kmeans"], tiny) == ([], [])
