"""The auction against the exact assignment of a dense table, and against the ceiling that its prices prove."""

import numpy as np
import pytest

from threadline.operators import matching as mt
from threadline.operators.auction import _bidding, arcs_of, auction, ceiling

SCHEMA = "part string, a string, b string, score double, spot long"


def pairs_of(seed, n, deg, near):
    rng = np.random.default_rng(seed)
    rows = {}
    for g in range(n):
        for _ in range(deg):
            m = g + int(rng.integers(-3, 4)) if near else int(rng.integers(0, n))
            rows[g, m] = int(rng.integers(1, 20))
    return rows


def best(rows):
    gs, ms = sorted({g for g, _ in rows}), sorted({m for _, m in rows})
    grid = np.zeros((len(gs), len(ms)))
    for (g, m), v in rows.items():
        grid[gs.index(g), ms.index(m)] = v
    return sum(grid[at] for at in mt.assign(grid))


def test_whole_scores_are_exact_over_several_blocks(spark):
    graphs = {"x": pairs_of(1, 50, 3, True), "y": pairs_of(2, 20, 2, False)}
    data = [(p, f"{p}g{g}", f"{p}m{m}", float(v), g) for p, rows in graphs.items() for (g, m), v in rows.items()]
    won, arcs, places = auction(spark.createDataFrame(data + data[:5], SCHEMA), 1, 200)
    got = won.collect()
    assert len({r.a for r in got}) == len({r.b for r in got}) == len(got)
    score = {(a, b): v for _, a, b, v, _ in data}
    for p, rows in graphs.items():
        assert sum(score[r.a, r.b] for r in got if r.part == p) == best(rows)
    assert 0 <= ceiling(arcs, places) - sum(score[r.a, r.b] for r in got) < 1


def test_a_bidder_with_more_arcs_than_a_block(spark):
    rows = {(0, m): 5 + m % 7 for m in range(30)} | {(g, m): 9 for g in range(1, 5) for m in (6, 13)}
    data = [("x", f"g{g}", f"m{m}", float(v), g) for (g, m), v in rows.items()]
    got = auction(spark.createDataFrame(data, SCHEMA), 1, 12)[0].collect()
    assert sum(rows[int(r.a[1:]), int(r.b[1:])] for r in got) == best(rows)


def test_empty_and_zero_scores(spark):
    assert auction(spark.createDataFrame([], SCHEMA))[0].collect() == []
    data = [("x", "g1", "m1", 0.0, 1), ("x", "g2", "m1", 0.5, 2)]
    assert [(r.a, r.b) for r in auction(spark.createDataFrame(data, SCHEMA))[0].collect()] == [("g2", "m1")]


def test_a_block_leaves_strangers_to_a_later_round(spark):
    import pandas as pd

    f = pd.DataFrame({"bidder": ["p", "p"], "place": ["p", "q"], "value": [0, 40], "price": [0, 10], "holder": [None, "z"]})
    assert _bidding(f, 1).to_dict("records") == [{"place": "q", "price": 41, "holder": "p"}]


@pytest.mark.parametrize("scale", [256])
def test_optimal_hands_large_components_over(spark, scale):
    rng = np.random.default_rng(3)
    rows = {(g, g + d): float(rng.uniform(0.3, 1)) for g in range(40) for d in (0, 1, 2)}
    data = [(1, 7, g, m, v) for (g, m), v in rows.items()]
    df = spark.createDataFrame(data, "run_id int, user_id long, gt_id long, model_id long, score double")
    plain, dealt = ({(r.gt_id, r.model_id) for r in mt.optimal(df, most=most, scale=scale).collect()} for most in (20_000, 90))
    total = lambda chosen: sum(rows[c] for c in chosen)
    assert len({g for g, _ in dealt}) == len({m for _, m in dealt}) == len(dealt)
    assert total(plain) - 40 / scale <= total(dealt) <= total(plain) + 1e-9


def test_arcs(spark):
    got = arcs_of(spark.createDataFrame([("x", "g", "m", 0.5, 3)], SCHEMA), 4).collect()
    assert {(r.bidder, r.place, r.value) for r in got} == {("g", "m", 2), ("m", "g", 2), ("g", "g", 0), ("m", "m", 0)}
