"""One-to-one assignment of greatest total score on graphs larger than a task, by auction with epsilon scaling.

Every node bids for a place and every node is one: it may take its own place for nothing, or that of a neighbour
for the score of their pair.  So all can be seated, whatever the graph, and the seats taken in one direction (or in
the other) are the pairs wanted.  Blocks of nodes bid side by side on the prices of the last round; of the bids for
a place the highest stands.  Prices only rise, so a bid made on older ones is still within epsilon of its bidder's best.
"""

from __future__ import annotations

from collections import deque

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from threadline.work import kept

BIDS = "place string, price long, holder string"


def _bidding(f: pd.DataFrame, step: int) -> pd.DataFrame:
    """The places that changed hands once every bidder of f (bidder, place, value, price, holder) has one or lost it for good.

    f has all arcs of its bidders.  A holder from elsewhere who is outbid is left to a later round.
    """
    f = f.sort_values(["bidder", "place"])
    bidders, who = np.unique(f["bidder"].to_numpy(dtype=str), return_inverse=True)
    places, first_row, where = np.unique(f["place"].to_numpy(dtype=str), return_index=True, return_inverse=True)
    begin = np.searchsorted(who, np.arange(len(bidders) + 1)).tolist()
    number = {b: i for i, b in enumerate(bidders)}
    held = f["holder"].to_numpy(dtype=object)[first_row]
    price = f["price"].to_numpy()[first_row].tolist()
    holder = [number.get(h, -1) if isinstance(h, str) else -1 for h in held]
    value, where = f["value"].tolist(), where.tolist()
    seated = {h for h in holder if h >= 0}
    waiting, changed = deque(i for i in range(len(bidders)) if i not in seated), set()
    while waiting:
        i = waiting.popleft()
        best = second = at = None
        for k in range(begin[i], begin[i + 1]):
            gain = value[k] - price[where[k]]
            if best is None or gain > best:
                best, second, at = gain, best, where[k]
            elif second is None or gain > second:
                second = gain
        price[at] += best - second + step
        if holder[at] >= 0:
            waiting.append(holder[at])
        holder[at] = i
        changed.add(at)
    rows = sorted(changed)
    return pd.DataFrame({"place": places[rows], "price": [price[r] for r in rows], "holder": [bidders[holder[r]] for r in rows]})


def _bidder(step: int):
    return lambda f: _bidding(f, step)


def _hub_bids(arcs: DataFrame, step: int) -> DataFrame:
    """One bid of each bidder by its two best arcs; Spark keeps two rows a bidder before its shuffle."""
    rank = Window.partitionBy("bidder").orderBy(F.desc("gain"), "place")
    two = arcs.withColumn("gain", F.col("value") - F.col("price")).withColumn("r", F.row_number().over(rank)).where("r <= 2")
    top = lambda c: F.max(F.when(F.col("r") == 1, F.col(c)))
    bids = two.groupBy("bidder").agg(top("place").alias("place"), top("price").alias("price"), top("gain").alias("gain"), F.min("gain").alias("second"))
    return bids.select("place", (F.col("price") + F.col("gain") - F.col("second") + step).alias("price"), F.col("bidder").alias("holder"))


def _around(blocks: DataFrame, of_bidder: DataFrame, places: DataFrame, idle: DataFrame, most: int, hops: int = 8) -> DataFrame | None:
    """The idle bidders and those who hold what they may bid for, and so on while their arcs are no more than ``most``."""
    inside, size = idle.select("bidder", "n"), idle.agg(F.sum("n")).first()[0]
    if size is None or size > most // 4:
        return None
    for _ in range(hops):
        wanted = blocks.join(inside.select("bidder"), "bidder", "left_semi").select("place").distinct()
        holders = places.where("holder IS NOT NULL").join(wanted, "place", "left_semi").select(F.col("holder").alias("bidder"))
        grown = kept(inside.unionByName(of_bidder.where(F.col("n") <= most).join(holders, "bidder", "left_semi").select("bidder", "n")).distinct())
        now = grown.agg(F.sum("n")).first()[0]
        if now > most or now == size:
            break
        inside, size = grown, now
    return inside.select("bidder", F.lit(0).alias("around"))


def arcs_of(edges: DataFrame, scale: int) -> DataFrame:
    """(part, bidder, place, value, spot): both directions of each pair of a and b, and each node's own place."""
    pairs = edges.groupBy("part", "a", "b").agg(F.max("score").alias("score"), F.min("spot").alias("spot"))
    pairs = pairs.select("part", "a", "b", F.round(F.col("score") * scale).cast("long").alias("value"), "spot")
    both = pairs.unionByName(pairs.select("part", F.col("b").alias("a"), F.col("a").alias("b"), "value", "spot"))
    own = both.groupBy("part", "a").agg(F.min("spot").alias("spot")).select("part", "a", F.col("a").alias("b"), F.lit(0).cast("long").alias("value"), "spot")
    return both.unionByName(own).toDF("part", "bidder", "place", "value", "spot")


def auction(edges: DataFrame, scale: int = 1 << 20, most: int = 20_000, shrink: int = 8) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Pairs (part, a, b) of greatest total score, with the arcs and the places (place, price, holder) that prove it.

    edges: part, a, b (strings; no name on both sides or in two parts), score (0 or more), spot (any order in which
    neighbours are often near).  Scores count in units of 1 / scale: whole scores with scale 1 give the exact optimum;
    otherwise the total falls short of it by no more than the number of pairs divided by scale.

    A block of bidders has about ``most`` arcs.  A bidder with more bids once a round, without a task of its own.  Blocks
    are cut in two ways by turns, so that neighbours divided in one round can meet in the next, and blocks whose bidders
    all have a place rest; every third round a block is grown around the last bidders without one.  Every phase has an epsilon ``shrink`` times smaller and starts from the prices of the last.
    Values times nodes must fit a long, else Spark's arithmetic raises.
    """
    arcs = kept(arcs_of(edges, scale))
    if arcs.isEmpty():
        return edges.select("part", "a", "b").limit(0), arcs, arcs.sparkSession.createDataFrame([], BIDS)
    of_bidder = kept(arcs.groupBy("bidder").agg(F.first("part").alias("part"), F.min("spot").alias("spot"), F.count("*").alias("n"), F.max("value").alias("top")))
    nodes, total, top, widest = of_bidder.agg(F.count("*"), F.sum("n"), F.max("top"), F.max("n")).first()
    # one more than the nodes: an epsilon of one is then too little to hide a whole unit
    unit = nodes + 1
    arcs = arcs.withColumn("value", F.col("value") * F.lit(unit).cast("long"))
    small = of_bidder.where(F.col("n") <= most)
    cuts = {"one": -(-total // most), "other": max(1, total * 2 // (most * 3))}
    for name, n in cuts.items():
        small = kept(small.repartitionByRange(int(n), "part", "spot", "bidder").withColumn(name, F.spark_partition_id()))
    small = small.select("bidder", *cuts)
    blocks = kept(arcs.join(small, "bidder").select("bidder", "place", "value", *cuts))
    hubs = kept(arcs.join(of_bidder.where(F.col("n") > most).select("bidder"), "bidder", "left_semi").select("bidder", "place", "value")) if widest > most else None
    places = kept(of_bidder.select(F.col("bidder").alias("place"), F.lit(0).cast("long").alias("price"), F.lit(None).cast("string").alias("holder")))
    step = max(1, top * unit // 4)
    while True:
        places = places.withColumn("holder", F.lit(None).cast("string"))
        turn = 0
        while True:
            idle = of_bidder.select("bidder", "n").join(places.where("holder IS NOT NULL").select(F.col("holder").alias("bidder")), "bidder", "left_anti")
            idle = kept(idle.join(small, "bidder", "left"))
            if idle.isEmpty():
                break
            cut = [*cuts, "around"][turn % 3]
            near = _around(blocks, of_bidder, places, idle.where(F.col("one").isNotNull()), most) if cut == "around" else None
            if near is not None:
                waiting = blocks.join(near, "bidder").join(places, "place")
            else:
                cut = cut if cut in cuts else "one"
                waiting = blocks.join(idle.where(F.col(cut).isNotNull()).select(cut).distinct(), cut, "left_semi").join(places, "place")
            bids = waiting.select(cut, "bidder", "place", "value", "price", "holder").groupBy(cut).applyInPandas(_bidder(step), BIDS)
            if hubs is not None:
                bids = bids.unionByName(_hub_bids(hubs.join(idle.select("bidder"), "bidder", "left_semi").join(places, "place"), step))
            best = bids.groupBy("place").agg(F.max(F.struct("price", "holder")).alias("won"))
            # who bids elsewhere has lost the old place already: only its new holder is left there
            places = kept(places.join(best, "place", "left").select("place", F.coalesce("won.price", "price").alias("price"), F.coalesce("won.holder", "holder").alias("holder")))
            turn += 1
        if step == 1:
            break
        step = max(1, step // shrink)
    seats = arcs.join(places.select("place", F.col("holder").alias("bidder")), ["place", "bidder"]).where("bidder <> place")
    ways = edges.select(F.col("a").alias("bidder")).distinct().withColumn("way", F.lit(0))
    seats = kept(seats.join(ways, "bidder", "left").select("part", "value", F.coalesce("way", F.lit(1)).alias("way"), "bidder", "place"))
    # each direction is a matching by itself: the better one of each part
    sums = seats.groupBy("part", "way").agg(F.sum("value").alias("sum"))
    better = sums.groupBy("part").agg(F.max(F.struct("sum", -F.col("way"))).alias("m")).select("part", (-F.col("m.col2")).alias("way"))
    chosen = seats.join(better, ["part", "way"]).where("value > 0")
    a, b = F.when(F.col("way") == 0, F.col("bidder")).otherwise(F.col("place")), F.when(F.col("way") == 0, F.col("place")).otherwise(F.col("bidder"))
    return chosen.select("part", a.alias("a"), b.alias("b")), arcs.withColumn("value", F.col("value") / unit), places.withColumn("price", F.col("price") / unit)


def ceiling(arcs: DataFrame, places: DataFrame) -> float:
    """A total that no assignment exceeds, in units, from the prices: places' prices and bidders' best gains, halved."""
    gains = arcs.join(places, "place").groupBy("bidder").agg(F.max(F.col("value") - F.col("price")).alias("g"))
    return (gains.agg(F.sum("g")).first()[0] + places.agg(F.sum("price")).first()[0]) / 2
