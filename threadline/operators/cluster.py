"""Clusters of embeddings: centroids, cohesion, majority labels, purity, density."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from threadline.work import kept

from .components import components
from .hierarchy import at_most, blocks_for, first_of_each, of_pairs, parts


def sums(vectors: DataFrame, group: str) -> DataFrame:
    """Component sums per group, in long form: linear in the vectors, no self-join."""
    each = vectors.select(group, F.posexplode("embedding").alias("i", "x"))
    return each.groupBy(group, "i").agg(F.sum(F.col("x").cast("double")).alias("s"))


def cohesion(vectors: DataFrame, group: str) -> DataFrame:
    """Mean pairwise cosine of unit vectors per group, from the norm of their sum."""
    size = vectors.groupBy(group).agg(F.count("*").alias("n"))
    norm = sums(vectors, group).groupBy(group).agg(F.sum(F.col("s") * F.col("s")).alias("q"))
    rows = size.join(norm, group)
    return rows.select(group, "n", F.round(F.when(F.col("n") > 1, (F.col("q") - F.col("n")) / (F.col("n") * (F.col("n") - 1))), 6).alias("cohesion"))


def separation(vectors: DataFrame, group: str) -> DataFrame:
    """Cosine of each pair of group centroids (groups are few)."""
    s = sums(vectors, group)
    norm = s.groupBy(group).agg(F.sqrt(F.sum(F.col("s") * F.col("s"))).alias("norm"))
    a, b = (s.select("i", F.col(group).alias(x), F.col("s").alias(f"s_{x}")) for x in "ab")
    dots = a.join(b, "i").where("a < b").groupBy("a", "b").agg(F.sum(F.col("s_a") * F.col("s_b")).alias("dot"))
    rows = dots.join(norm.toDF("a", "n_a"), "a").join(norm.toDF("b", "n_b"), "b")
    return rows.select("a", "b", F.round(F.col("dot") / (F.col("n_a") * F.col("n_b")), 6).alias("cosine"))


def majority(rows: DataFrame) -> DataFrame:
    """The commonest (topic, sub_topic) of each cluster and its share; noise (cluster null) has none."""
    counted = rows.where("cluster IS NOT NULL").groupBy("cluster", "topic", "sub_topic").agg(F.count("*").alias("n"))
    of = Window.partitionBy("cluster")
    best = of.orderBy(F.desc("n"), "topic", "sub_topic")
    ranked = counted.withColumn("size", F.sum("n").over(of)).withColumn("_r", F.row_number().over(best))
    return ranked.where("_r = 1").select("cluster", "topic", "sub_topic", "size", (F.col("n") / F.col("size")).alias("purity"))


def agreement(rows: DataFrame, labels: DataFrame) -> DataFrame:
    joined = rows.where("cluster IS NOT NULL").join(labels.select("cluster", F.col("topic").alias("_t")), "cluster")
    return joined.agg(F.count("*").alias("n"), F.avg((F.col("topic") == F.col("_t")).cast("double")).alias("agreement"))


def written_back(rows: DataFrame, clustered: DataFrame) -> DataFrame:
    """rows (vec_id, topic, sub_topic) with their cluster object: id (-1 for noise), confidence, and its majority labels with their purity."""
    joined = rows.join(clustered, "vec_id").withColumn("cluster", F.when(F.col("cluster") != -1, F.col("cluster")))
    best = majority(joined).select("cluster", F.col("topic").alias("_t"), F.col("sub_topic").alias("_s"), "purity")
    whole = joined.join(best, "cluster", "left")
    cluster = F.struct(
        F.coalesce("cluster", F.lit(-1)).alias("id"), F.col("membership").alias("confidence"), F.col("_t").alias("topic"), F.col("_s").alias("sub_topic"), F.round(F.coalesce("purity", F.lit(0.0)), 4).alias("purity")
    )
    return whole.select("vec_id", "topic", "sub_topic", cluster.alias("cluster"))


def neighbours(vectors: DataFrame, k: int, blocks: int) -> DataFrame:
    """The k nearest of each unit vector by cosine, ties to the smaller id: an exact search in blocks.

    A task holds one block of vectors and one of asked ones and keeps k per asked vector,
    so its memory is bounded; every vector meets every block once.
    """
    every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    rows = vectors.select("vec_id", "embedding").withColumn("own", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")).withColumn("other", every)
    held = rows.select(F.col("own").alias("block"), F.col("other").alias("part"), "vec_id", "embedding")
    asked = rows.select(F.col("other").alias("block"), F.col("own").alias("part"), F.col("vec_id").alias("query"), F.col("embedding").alias("q"))

    def nearest(left, right):
        out = []
        if len(left) and len(right):
            ids, x = left["vec_id"].to_numpy(), np.vstack(left["embedding"].to_numpy()).astype(np.float64)
            size = np.sqrt((x * x).sum(axis=1).max())
            # single precision foretells which pairs matter, unless it could overflow
            held = x.astype(np.float32) if size < 1e15 else x
            for part in parts(left, right):
                asked, y = part["query"].to_numpy(), np.vstack(part["q"].to_numpy()).astype(np.float64)
                sizes = np.sqrt((y * y).sum(axis=1))
                single = held.dtype == np.float32 and sizes.max() < 1e15
                far = (-y).astype(np.float32) @ held.T if single else -y @ x.T
                off = (2.5e-7 if single else 1e-13) * (len(x[0]) + 4) * size * sizes + 1e-37
                bound = (at_most(far, k + 1) + off).astype(far.dtype)  # with itself
                row, at = np.nonzero(far <= bound[:, None])
                other = ids[at] != asked[row]
                row, at = row[other], at[other]
                # the same from either side and in any block
                cosine = of_pairs(lambda r, c, x=x, y=y: (x[c] * y[r]).sum(axis=1), row, at)
                some = first_of_each(row, np.lexsort((ids[at], -cosine, row)), k)
                out.append(pd.DataFrame({"query": asked[row[some]], "vec_id": ids[at[some]], "cosine": cosine[some]}))
        return pd.concat(out) if out else pd.DataFrame({"query": pd.array([], "int64"), "vec_id": pd.array([], "int64"), "cosine": pd.array([], "float64")})

    found = held.groupBy("block", "part").cogroup(asked.groupBy("block", "part")).applyInPandas(lambda a, b: nearest(a, b), "query long, vec_id long, cosine double")
    order = Window.partitionBy("query").orderBy(F.desc("cosine"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def density(vectors: DataFrame, k: int = 10, eps: float = 0.35, least: int = 5, blocks: int | None = None) -> DataFrame:
    """vec_id, cluster (its smallest vec_id, -1 for noise) and membership of each unit vector.

    The core distance is the cosine distance to the k-th neighbour.  Neighbours whose mutual
    reachability (the largest of both core distances and their distance) is at most eps are
    linked; the connected components of at least ``least`` vectors are the clusters.
    Membership is one minus the core distance over the cluster's largest.
    """
    if blocks is None:
        blocks = blocks_for(vectors, 20_000)
    near = kept(neighbours(vectors, k, blocks).withColumn("d", 1 - F.col("cosine")))
    core = near.groupBy("query").agg(F.max("d").alias("core"))
    edges = near.join(core.toDF("query", "core_a"), "query").join(core.toDF("vec_id", "core_b"), "vec_id").where(F.greatest("d", "core_a", "core_b") <= eps).select(F.col("query").alias("a"), F.col("vec_id").alias("b"))
    found = components(edges, kept).toDF("a", "label")
    labels = vectors.select(F.col("vec_id").alias("a")).join(found, "a", "left").withColumn("label", F.coalesce("label", "a"))
    of = Window.partitionBy("label")
    rows = labels.join(core.withColumnRenamed("query", "a"), "a", "left").withColumn("size", F.count("*").over(of)).withColumn("_max", F.max("core").over(of))
    member = F.when(F.col("size") >= least, F.coalesce(F.when(F.col("_max") > 0, 1 - F.col("core") / F.col("_max")), F.lit(1.0))).otherwise(F.lit(0.0))
    return rows.select(F.col("a").alias("vec_id"), F.when(F.col("size") >= least, F.col("label")).otherwise(F.lit(-1)).alias("cluster"), member.alias("membership"))


def own_distance(vectors: DataFrame, group: str) -> DataFrame:
    """Mean cosine distance of unit vectors to their own group's centroid."""
    s = sums(vectors, group)
    norm = s.groupBy(group).agg(F.sqrt(F.sum(F.col("s") * F.col("s"))).alias("norm"))
    n = vectors.groupBy(group).agg(F.count("*").alias("n"))
    # the sum of the cosines is the norm of the sum
    return n.join(norm, group).select(group, "n", (1 - F.col("norm") / F.col("n")).alias("distance"))


def silhouette(vectors: DataFrame, group: str) -> DataFrame:
    """Mean silhouette of unit vectors by cosine distance, from the groups' sums: linear in vectors times groups.

    A vector's mean distance to a group is one less its product with the group's mean; groups are few,
    so their sums go to every task while they are at most a thousand, else they are joined.
    """
    n = vectors.groupBy(group).agg(F.count("*").alias("n"))
    each = sums(vectors, group).groupBy(group).agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "s"))), lambda x: x["s"]).alias("sum")).join(n, group)
    table = each.select(F.col(group).alias("_g"), "sum", "n")
    if table.limit(1001).count() <= 1000:
        table = F.broadcast(table)
    dot = F.aggregate(F.zip_with(F.col("embedding").cast("array<double>"), "sum", lambda a, b: a * b), F.lit(0.0), lambda t, x: t + x)
    rows = vectors.select("vec_id", group, "embedding").crossJoin(table).withColumn("dot", dot)
    own = F.col("_g") == F.col(group)
    # a vector is no neighbour of itself
    far = F.when(own, F.when(F.col("n") > 1, 1 - (F.col("dot") - 1) / (F.col("n") - 1))).otherwise(1 - F.col("dot") / F.col("n"))
    per = rows.withColumn("far", far).groupBy("vec_id", group).agg(F.max(F.when(own, F.col("far"))).alias("a"), F.min(F.when(~own, F.col("far"))).alias("b"))
    value = F.when(F.col("a").isNull() | F.col("b").isNull(), F.lit(0.0)).otherwise((F.col("b") - F.col("a")) / F.greatest("a", "b"))
    return per.agg(F.count("*").alias("n"), F.avg(value).alias("silhouette"))


def noise_summary(clustered: DataFrame) -> DataFrame:
    """Share of noise (cluster -1), number of clusters, mean membership of what is in one."""
    noise = F.col("cluster") == -1
    return clustered.agg(F.count("*").alias("n"), F.avg(noise.cast("double")).alias("noise"), F.count_distinct(F.when(~noise, F.col("cluster"))).alias("clusters"), F.avg(F.when(~noise, F.col("membership"))).alias("membership"))


def reduced(vectors: DataFrame, k: int = 10) -> DataFrame:
    """vec_id and the first k principal components (the sign of each such that its largest weight is positive)."""
    from pyspark.ml.feature import PCA
    from pyspark.ml.functions import array_to_vector, vector_to_array

    rows = vectors.select("vec_id", array_to_vector(F.col("embedding").cast("array<double>")).alias("_v"))
    model = PCA(k=k, inputCol="_v", outputCol="_p").fit(rows)
    weights = model.pc.toArray()
    signs = [1.0 if w[abs(w).argmax()] > 0 else -1.0 for w in weights.T]
    values = F.zip_with(vector_to_array("_p"), F.array(*map(F.lit, signs)), lambda a, b: a * b)
    return model.transform(rows).select("vec_id", values.alias("components"))
