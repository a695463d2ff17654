"""Hard-negative mining over a multiway hyperplane tree with distance ranges (GNAT).

Components count as integers floor(scale * x); a score is the inner product with an
anchor, exact.  A node of the tree has split points; a vector belongs to the nearest
one (ties: the first).  Each split point stores, for every sibling subtree, the smallest and the
largest distance from itself to a vector in there, and each subtree the range of its
squared norms.  A window of scores is a ring of distances around the anchor (wider
by the range of norms); a subtree whose distances to any split point miss what the
ring allows is left out.  What is left are leaves, whose vectors are scored exactly.

The tree is built on at most ``fit_rows`` vectors, and stays that small; the ranges are
taken over all vectors, by Spark, and the index holds every vector.  The scores in the
sample bound the windows from below: the n-th best of some rows is never above that of all.
Leaves are grouped or split into blocks of bounded size, and anchors into chunks, so
that a pair of a block and a chunk fits a task however many vectors, anchors or
equal labels there are.  Two searches follow one another: positives, in blocks of their
label, and negatives, in the windows which the positives give.

Defined results: rows with a null id, label or vector, or with a null component or one
that is not finite (or of 2^52 / scale and more) take no part; of rows with one id the
smallest (label, vector) stays; shorter vectors count as if zeros followed; an anchor
without positives, or a positive without negatives in its window, gives no rows; an
empty table gives no rows; extra columns are ignored; a score that does not fit a long
is null.
"""

from __future__ import annotations

from decimal import Decimal

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import batch_rows, stored
from .kmeans import EXACT, exact_integers, integers

FANOUT, LEAST_LEAF = 8, 16
#: Relative margin of distances against rounding.
SLACK = 1e-9


def gaps(x: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Squared distances, rows by points."""
    return np.column_stack([((x - p) ** 2).sum(axis=1) for p in points])


def scores(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Exact inner products, rows by queries."""
    if x.size and q.size and x.shape[1] * float(np.abs(x).max()) * float(np.abs(q).max()) >= EXACT:
        x, q = exact_integers(x), exact_integers(q)
    return x @ q.T


class Tree:
    """Split points from a sample; ``measure`` and ``fill`` take the ranges over all vectors."""

    def __init__(self, sample: np.ndarray, leaf_rows: int, fanout: int = FANOUT):
        self.points, self.children = [], []  # a child is a node (its number) or a leaf (-1 - its number)
        self.paths = []  # for each leaf the (node, subtree) on the way
        rng = np.random.default_rng(13)
        self._grow(sample, max(leaf_rows, LEAST_LEAF), fanout, (), rng)
        self.low = [np.full((len(p), len(p)), np.inf) for p in self.points]  # squared, split point by subtree
        self.high = [np.full((len(p), len(p)), -np.inf) for p in self.points]
        self.norms = [(np.full(len(p), np.inf), np.full(len(p), -np.inf)) for p in self.points]

    def _grow(self, x, leaf_rows, fanout, path, rng) -> int:
        picked = self._split_points(x, fanout, rng)
        at = len(self.points)
        self.points.append(picked)
        self.children.append([])
        near = gaps(x, picked).argmin(axis=1) if len(x) else np.zeros(0, dtype=int)
        kids = []
        for j in range(len(picked)):
            some = x[near == j]
            if len(some) <= leaf_rows or len(some) == len(x):
                self.paths.append((*path, (at, j)))
                kids.append(-len(self.paths))
            else:
                kids.append(self._grow(some, leaf_rows, fanout, (*path, (at, j)), rng))
        self.children[at] = kids
        return at

    @staticmethod
    def _split_points(x, fanout, rng):
        """Points far from one another, out of three times as many drawn ones; at least one."""
        if not len(x):
            return np.zeros((1, x.shape[1]))
        drawn = x[rng.permutation(len(x))[: 3 * fanout]]
        picked, away = [0], gaps(drawn, drawn[:1])[:, 0]
        while len(picked) < fanout and away.max() > 0:
            picked.append(int(away.argmax()))
            away = np.minimum(away, gaps(drawn, drawn[picked[-1:]])[:, 0])
        return drawn[picked]

    def leaves_of(self, x: np.ndarray) -> np.ndarray:
        out, open_ = np.zeros(len(x), dtype=np.int64), [(0, np.arange(len(x)))]
        while open_:
            node, rows = open_.pop()
            near = gaps(x[rows], self.points[node]).argmin(axis=1)
            for j, kid in enumerate(self.children[node]):
                some = rows[near == j]
                if kid < 0:
                    out[some] = -1 - kid
                elif len(some):
                    open_.append((kid, some))
        return out

    def measure(self, x: np.ndarray, leaf: np.ndarray) -> None:
        """Widen the ranges by vectors that lie in these leaves."""
        norm = (x * x).sum(axis=1)
        for v in np.unique(leaf):
            some, n = x[leaf == v], norm[leaf == v]
            for node, j in self.paths[v]:
                d = gaps(some, self.points[node])
                self.low[node][:, j] = np.minimum(self.low[node][:, j], d.min(axis=0))
                self.high[node][:, j] = np.maximum(self.high[node][:, j], d.max(axis=0))
                least, most = self.norms[node]
                least[j], most[j] = min(least[j], n.min()), max(most[j], n.max())

    def ranges(self):
        """(node, split point, subtree, low, high, least norm, most norm) of the subtrees met."""
        for node, (low, high, (least, most)) in enumerate(zip(self.low, self.high, self.norms, strict=True)):
            for i, j in zip(*np.nonzero(high >= 0), strict=True):
                yield node, int(i), int(j), low[i, j], high[i, j], least[j], most[j]

    def fill(self, rows) -> None:
        for node, i, j, low, high, least, most in rows:
            self.low[node][i, j], self.high[node][i, j] = low, high
            self.norms[node][0][j], self.norms[node][1][j] = least, most

    def reached(self, q: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Queries by leaves: whether a leaf may hold a score in one of the query's windows [low, high]."""
        out = np.zeros((len(q), len(self.paths)), dtype=bool)
        norm, open_ = (q * q).sum(axis=1), [(0, np.arange(len(q)))]
        while open_:
            node, rows = open_.pop()
            to = np.sqrt(gaps(q[rows], self.points[node]))
            least, most = self.norms[node]
            met = most >= 0
            with np.errstate(invalid="ignore"):
                size = norm[rows, None, None]
                slack = SLACK * (size + np.where(met, most, 0)) + 1
                near = np.sqrt(np.maximum(0, size + least - 2 * high[rows, :, None] - slack))
                far = size + most - 2 * low[rows, :, None] + slack
                alive = (far >= 0) & (low <= high)[rows, :, None] & met  # queries, windows, subtrees
                far = np.sqrt(np.maximum(far, 0))
                for i in range(len(self.points[node])):
                    d = to[:, i, None, None]
                    room = SLACK * (1 + d + far)
                    alive &= (np.maximum(d - far, near - d) - room <= np.sqrt(np.maximum(self.high[node][i], 0))) & (d + far + room >= np.sqrt(self.low[node][i]))
            alive = alive.any(axis=1)
            for j, kid in enumerate(self.children[node]):
                some = rows[alive[:, j]]
                if kid < 0:
                    out[some, -1 - kid] = True
                elif len(some):
                    open_.append((kid, some))
        return out


def best(score: np.ndarray, ids: np.ndarray, count: int) -> np.ndarray:
    """Places of the first ``count`` by falling score, ties by smaller id."""
    at = np.arange(len(score))
    if len(score) > count:
        at = np.flatnonzero(score >= (np.partition(score, -count)[-count] if score.dtype != object else sorted(score)[-count]))
    return at[np.lexsort((ids[at], -score[at]))][:count]


def _clean(vectors: DataFrame, label, id_col: str, column: str, scale: int) -> DataFrame:
    """id, label, v: one row per id."""
    v = F.col(column).cast("array<double>")
    fit = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < 2.0**52 / scale))
    rows = vectors.where(F.coalesce(fit, F.lit(False))).select(F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"), v.alias("v"))
    return rows.where("id is not null and label is not null").groupBy("id").agg(F.min(F.struct("label", "v")).alias("r")).select("id", "r.label", "r.v")


def _matrix(vectors, dimension: int, scale: int) -> np.ndarray:
    """Integers of vectors, zeros behind the shorter ones."""
    out = np.zeros((len(vectors), dimension))
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return integers(out, scale)


def mine(vectors: DataFrame, is_anchor, label=None, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, scale: int = 256, id_col: str = "vec_id", column: str = "embedding", fit_rows: int = 8192, block_rows: int = 50_000, chunk_rows: int = 20_000) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    For each anchor (is_anchor(id)) its first ``positives`` rows of the same label, and for each of
    these the first ``negatives`` rows of other labels whose score is ``low`` to ``high`` percent of the positive's.
    """
    spark = vectors.sparkSession
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    rows = stored(_clean(vectors, F.col("label") if label is None else label, id_col, column, scale), "vectors")
    stats = rows.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("d"), F.count_if(is_anchor(F.col("id"))).alias("asked")).first()
    n, dimension = stats["n"], max(1, stats["d"] or 1)
    if not n or not stats["asked"]:
        return spark.createDataFrame([], schema)
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(fit_rows).collect()
    ids, labels = np.array([r["id"] for r in sample]), np.array([r["label"] for r in sample])
    known = _matrix([r["v"] for r in sample], dimension, scale)
    block = int(min(block_rows, max(256, n // 32)))
    tree = Tree(known, block * len(sample) // n)

    def place(frames):
        for f in frames:
            if len(f):
                f["leaf"] = tree.leaves_of(_matrix(f["v"], dimension, scale))
                yield f

    index = stored(rows.mapInPandas(place, "id long, label long, v array<double>, leaf long"), "index")

    def measure(frames):
        import pandas as pd

        for f in frames:
            if len(f):
                tree.measure(_matrix(f["v"], dimension, scale), f["leaf"].to_numpy())
        yield pd.DataFrame(tree.ranges(), columns=["node", "i", "j", "low", "high", "least", "most"])

    met = index.select("v", "leaf").mapInPandas(measure, "node int, i int, j int, low double, high double, least double, most double")
    tree.fill(met.groupBy("node", "i", "j").agg(F.min("low"), F.max("high"), F.min("least"), F.max("most")).collect())  # bounded by the tree
    sizes = dict(index.groupBy("leaf").count().collect())
    # leaves are joined to blocks of bounded size, or split into several
    first, splits, at, room = np.zeros(len(tree.paths), dtype=np.int64), np.ones(len(tree.paths), dtype=np.int64), 0, 0
    for leaf in range(len(tree.paths)):
        size = sizes.get(leaf, 0)
        if room < size:
            at, room = at + 1, block
        first[leaf], splits[leaf] = at, max(1, -(-size // block))
        if splits[leaf] > 1:
            at, room = at + int(splits[leaf]) - 1, 0
        room -= min(size, room)
    chunks = -(-stats["asked"] // chunk_rows)

    def in_block(frames):
        for f in frames:
            leaf = f["leaf"].to_numpy()
            f["block"] = first[leaf] + f["salt"].to_numpy() % splits[leaf]
            yield f[["block", "id", "label", "v"]]

    salted = index.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(1 << 30)))
    in_blocks = stored(salted.mapInPandas(in_block, "block long, id long, label long, v array<double>"), "blocks")
    replicated = in_blocks.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1)))) if chunks > 1 else in_blocks.withColumn("chunk", F.lit(0))
    asks = rows.where(is_anchor(F.col("id"))).withColumn("chunk", F.pmod(F.xxhash64("id"), F.lit(chunks)).cast("int"))

    def visits(f, q, low_, high_):
        """f once per block that one of its windows reaches."""
        import pandas as pd

        reached = tree.reached(q, low_, high_)
        at, blocks = [], []
        for i, row in enumerate(reached):
            leaves = np.flatnonzero(row)
            found = np.unique(np.concatenate([np.arange(a, a + s) for a, s in zip(first[leaves], splits[leaves], strict=True)])) if len(leaves) else leaves
            at += [i] * len(found)
            blocks += found.tolist()
        out = f.iloc[at].reset_index(drop=True)
        return pd.concat([pd.Series(blocks, name="block", dtype="int64"), out], axis=1)

    def ask_positives(frames):
        for f in frames:
            if len(f):
                q = _matrix(f["v"], dimension, scale)
                s = scores(known, q)
                least = np.full((len(q), 1), -np.inf)
                for k, (i, g) in enumerate(zip(f["id"], f["label"], strict=True)):
                    same = s[(labels == g) & (ids != i), k]
                    if len(same) >= positives:
                        least[k] = float(np.sort(same)[-positives])
                yield visits(f, q, least, np.full((len(q), 1), np.inf))

    def find_positives(left, right):
        import pandas as pd

        out = []
        if len(left) and len(right):
            left = left.sort_values("label", kind="stable")
            has, i, x = left["label"].to_numpy(), left["id"].to_numpy(), _matrix(left["v"], dimension, scale)
            for g, asked in right.groupby("label"):
                a, b = np.searchsorted(has, g), np.searchsorted(has, g, side="right")
                if a == b:
                    continue
                for lo in range(0, len(asked), 256):
                    tile = asked.iloc[lo : lo + 256]
                    s = scores(x[a:b], _matrix(tile["v"], dimension, scale))
                    for k, anchor in enumerate(tile["id"]):
                        other = np.flatnonzero(i[a:b] != anchor)
                        top = other[best(s[other, k], i[a:b][other], positives)]
                        out += [(anchor, i[a + t], Decimal(int(s[t, k]))) for t in top]
        return pd.DataFrame(out, columns=["anchor", "id", "score"])

    def ask_negatives(frames):
        for f in frames:
            if len(f):
                q = _matrix(f["v"], dimension, scale)
                s = scores(known, q)
                lows, highs = np.full((len(q), positives), 1.0), np.zeros((len(q), positives))
                for k, (g, found) in enumerate(zip(f["label"], f["positives"], strict=True)):
                    other = s[labels != g, k]
                    for p, r in enumerate(found):
                        lo, hi = window(int(r["score"]))
                        inside = other[(other >= lo) & (other <= hi)]
                        lows[k, p], highs[k, p] = (float(np.sort(inside)[-negatives]) if len(inside) >= negatives else lo), hi
                yield visits(f, q, lows, highs)

    def window(score: int) -> tuple[int, int]:
        return -(-low * score // 100), high * score // 100

    def find_negatives(left, right):
        import pandas as pd

        out = []
        if len(left) and len(right):
            has, i, x = left["label"].to_numpy(), left["id"].to_numpy(), _matrix(left["v"], dimension, scale)
            for start in range(0, len(right), 256):
                tile = right.iloc[start : start + 256]
                s = scores(x, _matrix(tile["v"], dimension, scale))
                for k, (anchor, g, found) in enumerate(zip(tile["id"], tile["label"], tile["positives"], strict=True)):
                    mine_, differs = s[:, k], has != g
                    for r in found:
                        lo, hi = window(int(r["score"]))
                        inside = np.flatnonzero(differs & (mine_ >= lo) & (mine_ <= hi))
                        for t in inside[best(mine_[inside], i[inside], negatives)]:
                            out.append((anchor, r["id"], i[t], r["score"], Decimal(int(mine_[t]))))
        return pd.DataFrame(out, columns=["anchor_id", "positive_id", "negative_id", "positive_score", "negative_score"])

    def labelled(df):
        """Blocks for positives hold some labels only."""
        return df.withColumn("part", F.pmod(F.xxhash64("label"), F.lit(16)))

    with batch_rows(spark, 2000):
        asked = asks.select("id", "label", "v", "chunk").mapInPandas(ask_positives, "block long, id long, label long, v array<double>, chunk int")
        pairs = labelled(replicated).groupBy("block", "chunk", "part").cogroup(labelled(asked).groupBy("block", "chunk", "part"))
        near = pairs.applyInPandas(lambda a, b: find_positives(a, b), "anchor long, id long, score decimal(38,0)")
        order = Window.partitionBy("anchor").orderBy(F.desc("score"), "id")
        near = near.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= positives)
        listed = near.groupBy("anchor").agg(F.collect_list(F.struct("id", "score")).alias("positives"))
        with_them = stored(asks.join(listed, F.col("id") == F.col("anchor")).select("id", "label", "v", "chunk", "positives"), "asks")
        asked = with_them.mapInPandas(ask_negatives, "block long, id long, label long, v array<double>, chunk int, positives array<struct<id: long, score: decimal(38,0)>>")
        pairs = replicated.groupBy("block", "chunk").cogroup(asked.groupBy("block", "chunk"))
        found = pairs.applyInPandas(lambda a, b: find_negatives(a, b), "anchor_id long, positive_id long, negative_id long, positive_score decimal(38,0), negative_score decimal(38,0)")
        found = stored(found, "negatives")
    order = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", F.col("positive_score").try_cast("long").alias("positive_score"), F.col("negative_score").try_cast("long").alias("negative_score"))
