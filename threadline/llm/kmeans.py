"""Centroid clustering on integer vectors: a vantage-point tree over the centroids in each round.

Each component x counts as floor(scale * x).  In every round the driver builds a
vantage-point tree over the k centroids (k is a parameter, so its size is bounded)
and sends it to the tasks; each vector walks it best first, by branch and bound.
Distances at leaves are exact integers, bounds are taken inclusively, with a margin
for rounding, so that an equally near centroid of a smaller number is always met.
The walks of one batch go on side by side: each vector opens its own best node, and
vectors at the same node are measured together.

Tasks hand back sums and counts per centroid and component, which Spark adds up; only
k * dimension sums reach the driver.  Vectors are written once, with what is needed.

Defined results: rows with a null id, a null vector, another number of components, a
null or a component that is not finite (or of 1e45 and more) take no part; repeated rows count each; of rows
with equal ids the smaller vector comes first as a seed; fewer than k vectors give
fewer centroids; an empty table gives no rows.  Integers too large for exact doubles are
counted by Python; what does not fit a long in the end is null.
"""

from __future__ import annotations

import hashlib
from decimal import Decimal

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import stored

LEAF = 2
#: Up to here sums of squared differences of integers are exact in doubles.
EXACT = 2.0**53
#: Components from here on take no part: sums of them would not fit two decimals.
HUGE = 1e45
SPLIT = 10**30


def integers(vectors, scale: int):
    """floor(scale * x) as a matrix: doubles where all are whole numbers below 2^53, else Python ints."""
    x = np.vstack(vectors).astype(np.float64)
    out = np.floor(x * scale)
    return out if x.size == 0 or np.abs(out).max() < EXACT else exact_integers(out)


def integers_of(m):
    """A matrix of Python ints as doubles, where these are exact."""
    return m.astype(np.float64) if m.size == 0 or max(map(abs, m.ravel().tolist())) < EXACT else m


def safe(*matrices) -> bool:
    """Whether squared distances between rows of these are exact in doubles."""
    if any(m.dtype == object for m in matrices):
        return False
    most = sum(float(np.abs(m).max()) if m.size else 0.0 for m in matrices)
    return matrices[0].shape[1] * most * most < EXACT


def exact_integers(m):
    """The matrix with Python ints in place of doubles."""
    return m if m.dtype == object else np.array([[int(v) for v in r] for r in m.tolist()], dtype=object).reshape(m.shape)


class Tree:
    """Vantage points of centroids: a node's subtrees hold the centroids inside and outside its radius."""

    def __init__(self, centroids):
        self.centroids = centroids
        self.point, self.leaf, self.children, self.bounds = [], [], [], []
        self._grow(list(range(len(centroids))))

    def _grow(self, members: list[int]) -> int:
        at = len(self.point)
        self.point.append(members[0])
        self.leaf.append(None)
        self.children.append(())
        self.bounds.append(())
        if len(members) <= LEAF:
            self.leaf[at] = members
            return at
        first, rest = members[0], members[1:]
        d = [sum((int(a) - int(b)) ** 2 for a, b in zip(self.centroids[first], self.centroids[m], strict=True)) for m in rest]
        radius = sorted(d)[(len(d) - 1) // 2]  # inclusive: members at the radius are inside
        sides = [[(x, m) for x, m in zip(d, rest, strict=True) if (x <= radius) == inside] for inside in (True, False)]
        sides = [s for s in sides if s]
        bounds = tuple((float(min(s)[0]) ** 0.5, float(max(s)[0]) ** 0.5) for s in sides)
        kids = tuple(self._grow([m for _, m in s]) for s in sides)
        self.children[at], self.bounds[at] = kids, bounds
        return at

    def nearest(self, x):
        """The number of the nearest centroid of each row (ties: the smallest) and the squared distance."""
        c = self.centroids
        if not safe(x, c):
            x, c = exact_integers(x), exact_integers(c)
        n = len(x)
        best = np.full(n, np.inf).astype(x.dtype)
        number = np.full(n, len(c), dtype=np.int64)
        low = np.full((n, len(self.point)), np.inf)  # lower bounds of the open nodes
        low[:, 0] = 0
        active = np.arange(n)

        def take(rows, m, d):
            better = (d < best[rows]) | ((d == best[rows]) & (m < number[rows]))
            rows = rows[better.astype(bool)]
            best[rows], number[rows] = d[better.astype(bool)], m

        while len(active):
            node = low[active].argmin(axis=1)
            bound = low[active, node]
            reach = np.sqrt(best[active].astype(np.float64)) * (1 + 1e-9) + 1e-6
            go = bound <= reach  # inclusive: an equal distance may have a smaller number
            go &= np.isfinite(bound)
            active, node = active[go], node[go]
            low[active, node] = np.inf
            for v in np.unique(node):
                rows = active[node == v]
                for m in self.leaf[v] or [self.point[v]]:
                    gap = x[rows] - c[m]
                    d = (gap * gap).sum(axis=1)
                    take(rows, m, d)
                if self.leaf[v] is None:
                    away = np.sqrt(d.astype(np.float64))
                    for kid, (near, far) in zip(self.children[v], self.bounds[v], strict=True):
                        floor = np.maximum(np.maximum(away - far, near - away), 0)
                        low[rows, kid] = floor * (1 - 1e-9) - 1e-6
        return number, best


def _usable(vectors: DataFrame, id_col: str, column: str, dimension: int) -> DataFrame:
    v = F.col(column).cast("array<double>")
    fit = (F.size(v) == dimension) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < HUGE))
    return vectors.where(F.col(id_col).isNotNull() & F.coalesce(fit, F.lit(False))).select(F.col(id_col).cast("long").alias("id"), v.alias("v"))


def cluster(vectors: DataFrame, k: int = 8, rounds: int = 10, scale: int = 1024, seed: str = "3:", dimension: int = 64, id_col: str = "vec_id", column: str = "embedding") -> tuple[DataFrame, np.ndarray]:
    """(id, cluster, distance) of every vector after ``rounds`` rounds, and the centroids.

    Seeds are the k vectors whose sha256 of seed + id is smallest.
    """
    spark = vectors.sparkSession
    rows = stored(_usable(vectors, id_col, column, dimension), "vectors")
    seeds = rows.orderBy(F.sha2(F.concat(F.lit(seed), F.col("id").cast("string")), 256), "v").limit(k).collect()
    schema = "id long, cluster int, distance long"
    if not seeds:
        return spark.createDataFrame([], schema), np.empty((0, dimension))
    now = integers([r["v"] for r in seeds], scale)
    for _ in range(rounds):
        after = _moved(rows, now, scale)
        same = bool((after == now).all())
        now = after
        if same:  # all further rounds give the same
            break
    tree = Tree(now)

    def assign(frames):
        import pandas as pd

        for f in frames:
            if len(f):
                number, distance = tree.nearest(integers(f["v"].to_numpy(), scale))
                fits = [int(d) if d < 2**63 else None for d in distance.tolist()]
                yield pd.DataFrame({"id": f["id"], "cluster": number, "distance": pd.array(fits, dtype="Int64")})

    return rows.mapInPandas(assign, schema), now


def _moved(rows: DataFrame, now, scale: int):
    """Centroids after one round: the floor of the mean of each one's vectors; empty ones stay."""
    tree = Tree(now)
    k, dimension = now.shape

    def sums(frames):
        import pandas as pd

        total, count = np.zeros((k, dimension), dtype=object), np.zeros(k, dtype=np.int64)
        for f in frames:
            if not len(f):
                continue
            x = integers(f["v"].to_numpy(), scale)
            number, _ = tree.nearest(x)
            count += np.bincount(number, minlength=k)
            exact = x.dtype != object and len(x) * float(np.abs(x).max()) < EXACT
            for c in np.unique(number):
                some = x[number == c]
                added = some.sum(axis=0) if exact else exact_integers(some).sum(axis=0)
                total[c] += np.array([int(v) for v in added], dtype=object)
        # in two numbers, as a decimal has 38 digits
        out = [(c, j, *map(Decimal, divmod(total[c, j], SPLIT)), int(count[c])) for c in range(k) if count[c] for j in range(dimension)]
        yield pd.DataFrame(out, columns=["c", "j", "high", "low", "n"])

    parts = rows.mapInPandas(sums, "c int, j int, high decimal(38,0), low decimal(38,0), n long")
    added = parts.groupBy("c", "j").agg(F.sum("high").alias("high"), F.sum("low").alias("low"), F.sum("n").alias("n"))
    after = exact_integers(now).copy()
    for r in added.collect():  # k * dimension sums
        after[r["c"], r["j"]] = (int(r["high"]) * SPLIT + int(r["low"])) // r["n"]
    return integers_of(after)


def inertias(assigned: DataFrame) -> DataFrame:
    """Per cluster its summed distance, and that of all; null where one does not fit a long."""

    def total():
        one = F.sum(F.col("distance").cast("decimal(38,0)"))
        lost = F.count_if(F.col("distance").isNull())
        return F.when(lost == 0, one).try_cast("long")

    each = assigned.groupBy("cluster").agg(total().alias("cluster_inertia"))
    whole = F.sum(F.col("cluster_inertia").cast("decimal(38,0)")).over(Window.partitionBy())
    lost = F.count_if(F.col("cluster_inertia").isNull()).over(Window.partitionBy())
    return each.select("cluster", "cluster_inertia", F.when(lost == 0, whole).try_cast("long").alias("inertia"))  # k rows


def digest(centroid) -> str:
    return hashlib.sha256(",".join(str(int(v)) for v in centroid).encode()).hexdigest()


def clusters(vectors: DataFrame, **options) -> DataFrame:
    """id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of every vector that takes part."""
    spark = vectors.sparkSession
    found, centroids = cluster(vectors, **options)
    assigned = stored(found, "assigned")
    names = spark.createDataFrame([(i, digest(c)) for i, c in enumerate(centroids)], "cluster int, centroid_sha256 string")
    return assigned.join(F.broadcast(inertias(assigned).join(names, "cluster")), "cluster")  # one row for each of k centroids
