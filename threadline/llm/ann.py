"""Approximate nearest neighbours: multi-probe p-stable hashing, exact reranking.

Nearness is the inner product.  Vectors are scaled by the largest norm and given
one more component so that all have norm 1; then the nearest by distance is the
largest inner product.  Each table hashes a vector to cells of random projections, of
more functions the more vectors there are.  A query visits its own bucket and
perturbed ones in the order of estimated success: its cell borders are ranked by
distance, and one order of border sets, by their expected sums of squared distances,
serves all queries.  Candidates of all tables are merged and ranked by the inner
product of the original vectors in double precision.  A task holds buckets of one
table and all queries that visit some of them: where candidates are a good part of
the pairs there, scores come from one matrix product, and others are masked.

Cell width and the number of probes are fitted on at most ``fit_rows`` vectors
and ``fit_queries`` queries, so that the recall there reaches ``target``; the index
holds every vector.  Equal vectors are one class, named by its smallest id: of each
class only the k + 1 smallest ids can be among a query's k nearest, so more are never
needed; equal scores are told apart by the id.

Defined results: vectors that are null, zero, or hold nulls or non-finite numbers
take no part, nor do rows with a null id; only vectors of the most common length
are searched; with fewer than k candidates all that were found are returned;
repeated rows are one row; an empty table gives no rows.
"""

from __future__ import annotations

import heapq

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import batch_rows, stored

TABLES = 4
PAIRS = 1 << 21  # a task scores so many pairs at a time
DENSE = 16  # a matrix product, where more than one pair in so many is a candidate
PROBES = (16, 32, 64, 128, 256, 512, 1024, 2048, 4096, 8192)


def functions_for(n: int) -> int:
    """Functions per table: one more for each doubling, 10 at ten thousand vectors."""
    return int(min(20, max(8, round(np.log2(max(n, 1)) - 3.3))))


def border_sets(functions: int, count: int) -> np.ndarray:
    """The count likeliest sets of borders to cross (rows), by rank of their distance (columns): the first is empty.

    Of uniform places in a cell the j-th nearest of 2k borders has an expected squared distance
    of j (j + 1) / (4 (k + 1) (k + 2)), and so from the far side; a cell has one near and one far border.
    """
    k = functions
    j = np.arange(1, k + 1)
    near = j * (j + 1) / (4 * (k + 1) * (k + 2))
    back = j[::-1]
    cost = np.concatenate([near, 1 - back / (k + 1) + back * (back + 1) / (4 * (k + 1) * (k + 2))])
    out = np.zeros((count, 2 * k), dtype=np.int64)
    found, heap = 1, [(cost[0], (0,))]
    while heap and found < count:
        total, chosen = heapq.heappop(heap)
        if not any(2 * k - 1 - c in chosen for c in chosen):
            out[found, list(chosen)] = 1
            found += 1
        last = chosen[-1]
        if last + 1 < 2 * k:  # the next border too, or instead
            heapq.heappush(heap, (total + cost[last + 1], (*chosen, last + 1)))
            heapq.heappush(heap, (total - cost[last] + cost[last + 1], (*chosen[:-1], last + 1)))
    return out[:found]


def augmented(x: np.ndarray, largest: float) -> np.ndarray:
    x = x / largest
    return np.hstack([x, np.sqrt(np.maximum(0, 1 - (x * x).sum(axis=1, keepdims=True)))])


class Hashes:
    """Cells of random projections, and the probing sequence of a query."""

    def __init__(self, dim: int, largest: float, width: float, functions: int, tables: int = TABLES):
        rng = np.random.default_rng(7)
        self.largest, self.width, self.tables, self.functions = largest, width, tables, functions
        # at right angles as far as the space allows: no function repeats what another one says
        count = tables * functions
        turned = [np.linalg.qr(rng.normal(size=(dim + 1, dim + 1)))[0] for _ in range(-(-count // (dim + 1)))]
        self.directions = np.hstack(turned)[:, :count] * np.sqrt(dim + 1)
        self.shift = rng.random(tables * functions)
        self.mix = rng.integers(0, 1 << 62, functions, dtype=np.int64) * 2 + 1

    def project(self, x: np.ndarray) -> np.ndarray:
        """Vectors x tables x functions, in cell widths."""
        return (augmented(x, self.largest) @ self.directions / self.width + self.shift).reshape(len(x), self.tables, self.functions)

    def key(self, cells: np.ndarray, table: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            return self._scrambled((cells * self.mix).sum(axis=-1), table)

    @staticmethod
    def _scrambled(h, table: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            h = (h + np.int64(table)) * np.int64(-7046029254386353131)
            return h ^ (h >> np.int64(29))

    def keys(self, x: np.ndarray) -> np.ndarray:
        cells = np.floor(self.project(x)).astype(np.int64)
        return np.column_stack([self.key(cells[:, t], t) for t in range(self.tables)])

    def probes(self, query: np.ndarray, sets: np.ndarray) -> np.ndarray:
        """The keys that a query visits, table by table, the likeliest first."""
        at = self.project(query[None])[0]
        out, k = [], self.functions
        for t in range(self.tables):
            cells = np.floor(at[t])
            part = at[t] - cells
            order = np.argsort(np.concatenate([part, 1 - part]), kind="stable")  # one cell down, one cell up
            with np.errstate(over="ignore"):
                moved = np.where(order < k, -1, 1) * self.mix[order % k]
                base = (cells.astype(np.int64) * self.mix).sum()
                out.append(self._scrambled(base + (sets * moved).sum(axis=1), t))
        return np.concatenate(out)


class Buckets:
    """Vectors of one table by bucket, and the best candidates of many queries among them."""

    def __init__(self, key: np.ndarray, cid: np.ndarray, v: np.ndarray):
        order = np.argsort(key, kind="stable")
        self.cid, self.v = cid[order], v[order]
        self.keys, self.first, self.size = np.unique(key[order], return_index=True, return_counts=True)
        self.longest = float(np.sqrt((v * v).sum(axis=1).max()))

    def nearest(self, x: np.ndarray, keys: list | None, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Query (its place in x), id and score of each query's k best of the buckets named by its keys (None: of all)."""
        if keys is not None:
            of = np.repeat(np.arange(len(x)), [len(a) for a in keys])
            wanted = np.concatenate(keys)
            at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
            hit = np.flatnonzero(self.keys[at] == wanted)
            of, at = of[hit], at[hit]
            size = self.size[at]
        if keys is None or size.sum() * DENSE > len(x) * len(self.v):
            score = x @ self.v.T
            if keys is not None:
                inside = np.zeros((len(x), len(self.keys)), dtype=bool)
                inside[of, at] = True
                score[~np.repeat(inside, self.size, axis=1)] = -np.inf
            least = np.full(len(x), -np.inf)
            if score.shape[1] > k:
                # sums in another order may differ in the last digits
                least = np.partition(score, -k, axis=1)[:, -k] - 1e-12 * self.longest * np.sqrt((x * x).sum(axis=1))
            of, row = np.nonzero(score >= np.maximum(least, np.finfo(float).min)[:, None])
        else:
            row = np.arange(int(size.sum())) + np.repeat(self.first[at] - (np.cumsum(size) - size), size)
            of = np.repeat(of, size)
        score = np.empty(len(of))
        for a in range(0, len(of), 1 << 15):  # every pair by itself, so always with the same sum
            score[a : a + (1 << 15)] = (x[of[a : a + (1 << 15)]] * self.v[row[a : a + (1 << 15)]]).sum(axis=1)
        cid = self.cid[row]
        order = np.lexsort((cid, -score, of))  # of equal scores the smallest ids
        of = of[order]
        best = np.flatnonzero(np.arange(len(of)) - np.searchsorted(of, of) < k)
        return of[best], cid[order[best]], score[order[best]]


def fit(x: np.ndarray, largest: float, k: int, queries: int, target: float, functions: int) -> tuple[Hashes, np.ndarray, float]:
    """Hashes, the fewest border sets with which the recall on the sample x reaches target (else all), and that recall."""
    spread = float((augmented(x, largest) @ np.random.default_rng(7).normal(size=(x.shape[1] + 1, 64))).std(axis=0).mean())
    hashes = Hashes(x.shape[1], largest, max(2.8 * spread, 1e-6), functions)
    sets = border_sets(functions, PROBES[-1])
    keys = hashes.keys(x)
    where = [{} for _ in range(hashes.tables)]
    for t in range(hashes.tables):
        for i, key in enumerate(keys[:, t].tolist()):
            where[t].setdefault(key, []).append(i)
    asked = np.arange(min(queries, len(x)))
    scores = x[asked] @ x.T
    scores[asked, asked] = -np.inf
    near = min(k, len(x) - 1)
    if near < 1:
        return hashes, sets[: PROBES[0]], 1.0
    true = np.argpartition(-scores, near - 1, axis=1)[:, :near]
    for count in PROBES:
        hit = 0
        for q in asked:
            found = set()
            each = hashes.probes(x[q], sets[:count])
            size = len(each) // hashes.tables
            for t in range(hashes.tables):
                for key in each[t * size : (t + 1) * size].tolist():
                    found.update(where[t].get(key, ()))
            hit += len(found.intersection(true[q].tolist()))
        if hit >= target * true.size:
            break
    return hashes, sets[:count], hit / true.size


def clean(vectors: DataFrame, id_col: str, column: str) -> DataFrame:
    """id and v (doubles) of the vectors that take part."""
    v = F.col(column).cast("array<double>")
    usable = (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = vectors.where(F.col(id_col).isNotNull() & F.coalesce(usable, F.lit(False))).select(F.col(id_col).cast("long").alias("id"), v.alias("v")).distinct()
    dim = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return rows.where(F.size("v") == (dim["d"] if dim else 0))


def search(vectors: DataFrame, is_query, k: int = 20, id_col: str = "vec_id", column: str = "embedding", target: float = 0.96, fit_rows: int = 8192, fit_queries: int = 64, least: float = 0.9) -> DataFrame:
    """query_id, rank, the found id and score for every row with is_query(id column).

    Where the fitted recall stays below ``least`` every vector is compared, group by group.
    """
    spark = vectors.sparkSession
    rows = stored(clean(vectors, id_col, column).withColumn("digest", F.sha2(F.to_json(F.col("v")), 256)), "vectors")
    smallest = Window.partitionBy("digest").orderBy("id")
    members = rows.select("digest", "id").withColumn("_r", F.row_number().over(smallest)).where(F.col("_r") <= k + 1)
    members = members.groupBy("digest").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    ask = rows.where(is_query(F.col("id"))).select("digest", "id")
    classes = rows.groupBy("digest").agg(F.first("v").alias("v")).join(members, "digest").join(ask.select("digest").distinct().withColumn("asked", F.lit(True)), "digest", "left")
    # a class goes by its smallest id, so that equal scores are cut by id
    classes = stored(classes.withColumn("cid", F.element_at("ids", 1)), "classes")
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    stats = classes.agg(F.count("*").alias("n"), F.max(norm).alias("largest")).first()
    n = stats["n"]
    schema = "query_id long, rank int, id long, score double"
    if not n:
        return spark.createDataFrame([], schema)
    sample = np.array([r["v"] for r in classes.orderBy(F.xxhash64("digest"), "digest").limit(fit_rows).select("v").collect()])
    hashes, probes, recall = fit(sample, stats["largest"], k, fit_queries, target, functions_for(n))
    exact = recall < least
    parts, salts = max(4, n // 50_000), max(1, n // 2_000_000)

    def index(frames):
        import pandas as pd

        for f in frames:
            keys = hashes.keys(np.vstack(f["v"].to_numpy()))
            for t in range(1 if exact else hashes.tables):
                yield pd.DataFrame({"g": keys[:, t] % parts + t * parts, "salt": f["cid"] % salts, "key": keys[:, t], "cid": f["cid"], "v": f["v"]})

    def visit(frames):
        import pandas as pd

        for f in frames:
            out = []
            for cid, v in zip(f["cid"], f["v"], strict=True):
                if exact:
                    out += [(g, s, cid, v, []) for g in range(parts) for s in range(salts)]
                    continue
                for t, keys in enumerate(hashes.probes(np.asarray(v), probes).reshape(hashes.tables, -1)):
                    part = keys % parts
                    order = np.argsort(part.astype(np.int32), kind="stable")
                    bounds = np.searchsorted(part[order], np.arange(parts + 1))
                    for x in np.flatnonzero(np.diff(bounds)):
                        some = keys[order[bounds[x] : bounds[x + 1]]]
                        out += [(t * parts + x, s, cid, v, some) for s in range(salts)]
            yield pd.DataFrame(out, columns=["g", "salt", "query", "v", "keys"])

    def rank(left, right):
        import pandas as pd

        out = []
        if len(left) and len(right):
            found = Buckets(left["key"].to_numpy(), left["cid"].to_numpy(), np.vstack(left["v"].to_numpy()))
            queries, step = right["query"].to_numpy(), max(1, PAIRS // len(left))
            for a in range(0, len(right), step):
                x = np.vstack(right["v"].iloc[a : a + step].to_numpy())
                of, cid, score = found.nearest(x, None if exact else right["keys"].iloc[a : a + step].to_list(), k + 1)
                out.append(pd.DataFrame({"query": queries[a : a + step][of], "cid": cid, "score": score}))
        return pd.concat(out) if out else pd.DataFrame({"query": [], "cid": [], "score": []}).astype({"query": "int64", "cid": "int64", "score": "float64"})

    with batch_rows(spark, 1000):
        indexed = classes.select("cid", "v").mapInPandas(index, "g long, salt long, key long, cid long, v array<double>")
        visits = classes.where("asked").select("cid", "v").mapInPandas(visit, "g long, salt long, query long, v array<double>, keys array<long>")
        found = indexed.groupBy("g", "salt").cogroup(visits.groupBy("g", "salt")).applyInPandas(lambda a, b: rank(a, b), "query long, cid long, score double")
        found = stored(found.groupBy("query", "cid").agg(F.max("score").alias("score")), "found")
    near = found.withColumn("_r", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "cid"))).where(F.col("_r") <= k + 1).drop("_r")
    listed = near.join(classes.select("cid", "ids"), "cid").select("query", "score", F.explode("ids").alias("found"))
    asked = ask.join(classes.where("asked").select("digest", F.col("cid").alias("query")), "digest").select("query", F.col("id").alias("query_id"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "found")
    ranked = asked.join(listed, "query").where("query_id <> found").withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.col("found").alias("id"), "score")
