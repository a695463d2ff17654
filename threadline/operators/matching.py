"""Matching two segmentations of the same messages."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from threadline.work import kept

from .auction import auction
from .components import components

#: Weight of message overlap in the combined score (the rest: overlap in time), and the least score.
ALPHA, LEAST = 0.7, 0.3


def overlaps(truth_rows: DataFrame, model_rows: DataFrame, truth: DataFrame, model: DataFrame) -> DataFrame:
    """Pairs of a true and a model segment (per run_id) that share a message, with their scores.

    An inner join of the two bridges on the message: pairs without a shared message never arise.
    """
    shared = truth_rows.select("msg_id", F.col("segment_id").alias("gt_id")).join(model_rows.select("run_id", "msg_id", F.col("segment_id").alias("model_id")), "msg_id")
    shared = shared.groupBy("run_id", "gt_id", "model_id").agg(F.count("*").alias("n"))
    a = truth.select(F.col("segment_id").alias("gt_id"), "user_id", F.col("n_messages").alias("n_a"), F.col("started_at").alias("s_a"), F.col("ended_at").alias("e_a"))
    b = model.select("run_id", F.col("segment_id").alias("model_id"), F.col("n_messages").alias("n_b"), F.col("started_at").alias("s_b"), F.col("ended_at").alias("e_b"))
    both = shared.join(a, "gt_id").join(b, ["run_id", "model_id"])
    inter = F.greatest(F.least("e_a", "e_b") - F.greatest("s_a", "s_b"), F.lit(0))
    union = F.greatest("e_a", "e_b") - F.least("s_a", "s_b")
    jaccard = F.col("n") / (F.col("n_a") + F.col("n_b") - F.col("n"))
    time = F.coalesce(F.when(union > 0, inter / union), F.lit(0.0))
    rows = both.select("run_id", "user_id", "gt_id", "model_id", "n", jaccard.alias("jaccard"), time.alias("time_iou"))
    return rows.withColumn("score", ALPHA * F.col("jaccard") + (1 - ALPHA) * F.col("time_iou"))


def mutual_best(pairs: DataFrame, least: float = LEAST) -> DataFrame:
    """Pairs that are each other's best; ties go to the smaller id."""
    of_gt = Window.partitionBy("run_id", "gt_id").orderBy(F.desc("score"), "model_id")
    of_model = Window.partitionBy("run_id", "model_id").orderBy(F.desc("score"), "gt_id")
    ranked = pairs.where(F.col("score") >= least).withColumn("_a", F.row_number().over(of_gt)).withColumn("_b", F.row_number().over(of_model))
    return ranked.where("_a = 1 AND _b = 1").drop("_a", "_b")


def assign(score: np.ndarray) -> list[tuple[int, int]]:
    """One-to-one pairs of greatest total score (shortest augmenting paths on negated scores)."""
    flip = score.shape[0] > score.shape[1]
    cost = -(score.T if flip else score)
    n, m = cost.shape
    u, v, match = np.zeros(n + 1), np.zeros(m + 1), np.zeros(m + 1, dtype=int)
    for row in range(1, n + 1):
        match[0], col = row, 0
        least, back, done = np.full(m + 1, np.inf), np.zeros(m + 1, dtype=int), np.zeros(m + 1, dtype=bool)
        while match[col]:
            done[col] = True
            i = match[col]
            slack = cost[i - 1] - u[i] - v[1:]
            better = ~done[1:] & (slack < least[1:])
            least[1:][better], back[1:][better] = slack[better], col
            open_cost = np.where(done[1:], np.inf, least[1:])
            col = int(np.argmin(open_cost)) + 1
            delta = open_cost[col - 1]
            u[match[done]] += delta
            v[done] -= delta
            least[~done] -= delta
        while col:
            match[col] = match[back[col]]
            col = back[col]
    pairs = [(int(match[j]) - 1, j - 1) for j in range(1, m + 1) if match[j]]
    return [(b, a) if flip else (a, b) for a, b in pairs]


def optimal(pairs: DataFrame, least: float = LEAST, most: int = 20_000, scale: int = 1 << 20) -> DataFrame:
    """One-to-one pairs of greatest total score per run and user.

    Where all partners of a segment have no other partner, the best of them is taken by a
    window; only what is entangled beyond such stars is assigned exactly.  Entangled pairs
    of a user are solved in one task when there are at most ``most``, else each connected
    component by itself.  A component of more than ``most`` pairs goes to an auction over
    all tasks: its total falls short of the greatest by at most the smaller number of its
    segments divided by ``scale``, the fineness of its scores.
    """
    edges = pairs.where(F.col("score") >= least)
    by_gt, by_model = Window.partitionBy("run_id", "gt_id"), Window.partitionBy("run_id", "model_id")
    edges = edges.withColumn("_dg", F.count("*").over(by_gt)).withColumn("_dm", F.count("*").over(by_model))
    edges = edges.withColumn("_gt_star", F.max("_dm").over(by_gt) == 1).withColumn("_model_star", F.max("_dg").over(by_model) == 1)
    edges = kept(edges)
    gt_star = edges.where("_gt_star").withColumn("_r", F.row_number().over(by_gt.orderBy(F.desc("score"), "model_id"))).where("_r = 1")
    model_star = edges.where("NOT _gt_star AND _model_star").withColumn("_r", F.row_number().over(by_model.orderBy(F.desc("score"), "gt_id"))).where("_r = 1")
    rest = edges.where("NOT _gt_star AND NOT _model_star").select(*pairs.columns)
    of_user = rest.groupBy("run_id", "user_id").agg(F.count("*").alias("n"))
    large = kept(of_user.where(F.col("n") > most).select("run_id", "user_id"))
    small = rest.join(large, ["run_id", "user_id"], "left_anti").groupBy("run_id", "user_id")
    solved = small.applyInPandas(lambda key, f: _solved(f), rest.schema)
    if not large.isEmpty():
        node = lambda kind: F.concat(F.col("run_id").cast("string"), F.lit(kind), F.col(f"{kind}_id").cast("string"))
        more = rest.join(large, ["run_id", "user_id"], "left_semi").withColumn("a", node("gt"))
        more = more.withColumn("b", node("model"))
        parts = components(more.select("a", "b"), kept)
        named = kept(more.join(parts.withColumnRenamed("node", "a"), "a"))
        huge = kept(named.groupBy("component").count().where(F.col("count") > most).select("component"))
        fits = named.drop("a", "b").join(huge, "component", "left_anti")
        solved = solved.unionByName(fits.groupBy("component").applyInPandas(lambda key, f: _solved(f.drop(columns="component")), rest.schema))
        if not huge.isEmpty():
            beyond = named.join(huge, "component", "left_semi")
            won = auction(beyond.select(F.col("component").alias("part"), "a", "b", "score", F.col("gt_id").alias("spot")), scale, most)[0]
            solved = solved.unionByName(beyond.join(won, ["a", "b"], "left_semi").select(*pairs.columns))
    return gt_star.select(*pairs.columns).unionByName(model_star.select(*pairs.columns)).unionByName(solved)


def _solved(f):
    """The chosen rows of a frame of pairs: each connected component is assigned exactly."""
    parent: dict = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    f = f.sort_values(["run_id", "gt_id", "model_id"]).reset_index(drop=True)
    for r, g, m in zip(f["run_id"], f["gt_id"], f["model_id"], strict=True):
        parent[root((r, "g", g))] = root((r, "m", m))
    part_of = [root((r, "g", g)) for r, g in zip(f["run_id"], f["gt_id"], strict=True)]
    rows: dict = {}
    for i, c in enumerate(part_of):
        rows.setdefault(c, []).append(i)
    keep = []
    for some in rows.values():
        part = f.loc[some]
        gs, ms = sorted(part["gt_id"].unique()), sorted(part["model_id"].unique())
        grid, place = np.zeros((len(gs), len(ms))), {}
        for i, g, m, score in zip(some, part["gt_id"], part["model_id"], part["score"], strict=True):
            at = gs.index(g), ms.index(m)
            grid[at], place[at] = score, i
        keep += [place[at] for at in assign(grid) if at in place and grid[at] > 0]
    return f.loc[sorted(keep)]


def records(truth: DataFrame, model: DataFrame, pairs: DataFrame, chosen: DataFrame) -> DataFrame:
    """One row per run and true segment: its match if any, else its best overlap over all candidates."""
    runs = model.agg(F.collect_set("run_id").alias("runs"))  # one row: the runs compared
    gt = truth.select(F.col("segment_id").alias("gt_id"), F.col("topic").alias("gt_topic"), F.col("sub_topic").alias("gt_sub"), F.col("has_user").alias("engaged"))
    of_model = model.select("run_id", F.col("segment_id").alias("model_id"), F.col("topic").alias("model_topic"), F.col("sub_topic").alias("model_sub"), F.col("confidence").alias("confidence"))
    best = pairs.groupBy("run_id", "gt_id").agg(F.max("jaccard").alias("_best"))
    rows = gt.crossJoin(F.broadcast(runs)).withColumn("run_id", F.explode("runs")).drop("runs")
    rows = rows.join(chosen.select("run_id", "gt_id", "model_id", "jaccard"), ["run_id", "gt_id"], "left").join(of_model, ["run_id", "model_id"], "left").join(best, ["run_id", "gt_id"], "left")
    return rows.select(
        "run_id", "gt_id", "gt_topic", "gt_sub", "engaged", "model_id", "model_topic", "model_sub", "confidence", F.coalesce("jaccard", "_best", F.lit(0.0)).alias("iou"), F.col("model_id").isNotNull().alias("matched")
    )
