"""Hard negatives against brute force: ties, clusters, labels of a third of the rows, odd rows, huge components."""

import math

import numpy as np
import pytest
from oracle import differences
from pyspark.sql import functions as F

from threadline.llm import gnat
from threadline.llm.queries import ORACLE_SQL, op13_hard_negatives


def test_reached_leaves_hold_every_score_of_the_window():
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(12, 8)) * 400
    x = np.floor(np.vstack([c + rng.normal(size=(200, 8)) * 30 for c in centres]))
    tree = gnat.Tree(x[::3], 20)
    leaf = tree.leaves_of(x)
    tree.measure(x, leaf)
    q = x[::40]
    s = x @ q.T
    low = np.column_stack([np.quantile(s, 0.9, axis=0), np.quantile(s, 0.2, axis=0)])
    high = np.column_stack([np.quantile(s, 0.91, axis=0), np.quantile(s, 0.2, axis=0) - 1])  # the second window is empty
    reached = tree.reached(q, low, high)
    inside = (s >= low[:, 0]) & (s <= high[:, 0])
    for k in range(len(q)):
        assert reached[k, leaf[inside[:, k]]].all()
    assert reached.mean() < 0.6  # siblings are left out


def reference(rows, positives=5, negatives=10, low=30, high=90):
    kept = {}
    for i, g, x in rows:
        if i is None or g is None or x is None or any(v is None or not math.isfinite(v) for v in x):
            continue
        g = (g + 1) % 10 if i % 7 == 0 else g
        if i not in kept or (g, x) < kept[i]:
            kept[i] = (g, x)
    whole = {i: (g, [math.floor(256 * v) for v in x]) for i, (g, x) in kept.items()}
    out = []
    for a, (g, q) in whole.items():
        if a % 100:
            continue
        s = {i: sum(u * v for u, v in zip(q, x, strict=False)) for i, (_, x) in whole.items()}
        near = sorted((i for i in s if i != a and whole[i][0] == g), key=lambda i: (-s[i], i))[:positives]
        for p in near:
            inside = sorted((i for i in s if whole[i][0] != g and low * s[p] <= 100 * s[i] <= high * s[p]), key=lambda i: (-s[i], i))[:negatives]
            out += [(a, p, r + 1, i, s[p], s[i]) for r, i in enumerate(inside)]
    return sorted(out)


def got(df, **options):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return sorted(tuple(r) for r in gnat.mine(df, lambda i: i % 100 == 0, label, **options).collect())


DDL = "vec_id long, label int, embedding array<double>"


@pytest.mark.parametrize(("blocks", "chunks"), [(50_000, 20_000), (64, 3)])
def test_clustered_vectors_with_a_hot_label(spark, blocks, chunks):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(9, 6))
    rows = [(i * 5, 3 if i % 3 == 0 else int(rng.integers(0, 10)), [float(v) for v in centres[i % 9] + rng.normal(size=6) * 0.2]) for i in range(700)]
    rows += [(5 * i + 1, 3, rows[9][2]) for i in range(100)]  # equal vectors
    df = spark.createDataFrame(rows, DDL)
    want = reference(rows)
    assert len(want) > 500
    assert got(df, block_rows=blocks, chunk_rows=chunks, fit_rows=256) == want


def test_odd_rows(spark):
    rng = np.random.default_rng(3)
    rows = [(i, i % 3, [float(v) for v in rng.integers(-2, 3, 4)]) for i in range(120)]
    rows += [rows[3], (5, 1, rows[4][2]), (None, 1, rows[5][2]), (200, None, rows[5][2]), (300, 1, None), (400, 1, [None, 1.0]), (500, 1, [float("nan")] * 4), (600, 1, [1.0]), (700, 1, []), (800, 77, [1.0] * 4), (901, 1, [1.0] * 7)]
    df = spark.createDataFrame(rows, DDL).withColumns({c: F.lit("x") for c in ("id", "v", "leaf", "block", "chunk", "rank")})
    assert got(df) == reference(rows)
    assert gnat.mine(df.where("false"), lambda i: i % 100 == 0).count() == 0
    assert gnat.mine(df.where("vec_id = 3"), lambda i: i % 100 == 0).count() == 0
    assert got(df.where("vec_id = 100")) == []


def test_huge_components(spark):
    rows = [(i, i % 2, [3e4 * i, -3e3, 1e4 + i]) for i in range(210)]
    assert got(spark.createDataFrame(rows, DDL)) == reference(rows)


def test_against_sql(spark, tiny):
    assert differences(spark, op13_hard_negatives, ORACLE_SQL["op13_hard_negatives"], tiny) == ([], [])
