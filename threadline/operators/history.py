"""Histories: validity intervals, values as of a time, calendar trends, change points, frequent sequences."""

from __future__ import annotations

from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from threadline.work import kept


def intervals(versions: DataFrame, key: str, at: str, value: str, tie: str) -> DataFrame:
    """key, valid_from, valid_to (null: still valid) and value of each stretch in which the value stays.

    Of versions at one time the one with the largest ``tie`` counts.
    """
    last = versions.groupBy(key, at).agg(F.max_by(F.struct(value), tie).alias("_v"))
    order = Window.partitionBy(key).orderBy(at)
    first = F.row_number().over(order) == 1
    changed = last.withColumn("_new", first | ~F.lag("_v").over(order).eqNullSafe(F.col("_v"))).where("_new")
    return changed.select(key, F.col(at).alias("valid_from"), F.lead(at).over(order).alias("valid_to"), F.col(f"_v.{value}").alias(value))


def as_of(facts: DataFrame, valid: DataFrame, key: str, at: str, value: str, span: int) -> DataFrame:
    """facts with the value that is valid at their time (null before the first).

    Both tables are united and the last value runs on, within slices of ``span`` of a key, so that no key is
    one task; what holds at a slice's start comes from the slices before it, one row each.
    """
    slice_ = lambda c: F.floor(F.col(c) / span).alias("_slice")
    payload = F.struct(*[c for c in facts.columns if c not in (key, at)])
    left = facts.select(key, F.col(at).alias("_at"), slice_(at), F.lit(1).alias("_fact"), payload.alias("_p"))
    right = valid.select(key, F.col("valid_from").alias("_at"), slice_("valid_from"), F.lit(0).alias("_fact"), F.struct(value).alias("_v"))
    rows = left.unionByName(right, allowMissingColumns=True)
    run = Window.partitionBy(key, "_slice").orderBy("_at", "_fact").rowsBetween(Window.unboundedPreceding, 0)
    inside = rows.withColumn("_in", F.last("_v", ignorenulls=True).over(run))
    ends = rows.groupBy(key, "_slice").agg(F.max_by("_v", F.when(F.col("_v").isNotNull(), F.col("_at"))).alias("_end"))
    before = Window.partitionBy(key).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(key, "_slice", F.last("_end", ignorenulls=True).over(before).alias("_carried"))
    done = inside.where("_fact = 1").join(carried, [key, "_slice"])
    return done.select(key, F.col("_at").alias(at), "_p.*", F.coalesce("_in", "_carried")[value].alias(value))


def daily(rows: DataFrame, series: str, day: str) -> DataFrame:
    """series, day, n for every day from the series' first to its last, 0 where nothing happened."""
    counted = rows.groupBy(series, day).agg(F.count("*").alias("n"))
    spine = counted.groupBy(series).agg(F.min(day).alias("_a"), F.max(day).alias("_z")).select(series, F.explode(F.sequence("_a", "_z")).alias(day))
    return spine.join(counted, [series, day], "left").withColumn("n", F.coalesce("n", F.lit(0)))


def trends(days: DataFrame, series: str, day: str, width: int = 7) -> DataFrame:
    """days with the slope (per day) of the line through the last ``width`` days; null for a single day."""
    w = Window.partitionBy(series).orderBy(day).rowsBetween(1 - width, 0)
    first = F.min(day).over(Window.partitionBy(series))
    rows = days.withColumn("_x", (F.col(day) - first).cast("double")).withColumn("_y", F.col("n").cast("double"))
    k, x, y = F.count("*").over(w), F.sum("_x").over(w), F.sum("_y").over(w)
    xy, xx = F.sum(F.col("_x") * F.col("_y")).over(w), F.sum(F.col("_x") * F.col("_x")).over(w)
    below = k * xx - x * x
    return rows.withColumn("slope", F.when(below > 0, (k * xy - x * y) / below)).drop("_x", "_y")


def change_points(days: DataFrame, series: str, day: str, threshold: float = 1.36, least: int = 8, rounds: int = 4) -> DataFrame:
    """series, day (the last one before the level changes) and its statistic, by cumulative sums of deviations from the mean.

    A stretch of at least ``least`` days is cut where the sum is farthest from 0, if that over the deviation
    times the root of the length passes ``threshold``; both parts are looked at again, ``rounds`` times in all.
    """
    now, found = kept(days.select(series, day, F.col("n").cast("double").alias("y"), F.lit("").alias("part"))), []
    for _ in range(rounds):
        stretch = Window.partitionBy(series, "part")
        run = stretch.orderBy(day).rowsBetween(Window.unboundedPreceding, 0)
        rows = now.withColumn("_m", F.avg("y").over(stretch)).withColumn("_s", F.round(F.abs(F.sum(F.col("y") - F.col("_m")).over(run)), 9))
        each = rows.groupBy(series, "part").agg(F.count("*").alias("k"), F.stddev_pop("y").alias("sd"), F.max("_s").alias("top"), F.min_by(day, F.struct(-F.col("_s"), F.col(day))).alias("_cut"))
        cuts = kept(each.where((F.col("k") >= least) & (F.col("sd") > 0)).withColumn("statistic", F.col("top") / (F.col("sd") * F.sqrt("k"))).where(F.col("statistic") > threshold).select(series, "part", "_cut", "statistic"))
        found.append(cuts.select(series, F.col("_cut").alias(day), "statistic"))
        split = now.join(cuts, [series, "part"])  # parts without a cut are done
        now = kept(split.select(series, day, "y", F.concat("part", F.when(F.col(day) <= F.col("_cut"), "a").otherwise("b")).alias("part")))
    return reduce(DataFrame.union, found)


def _following(places: DataFrame) -> DataFrame:
    """u, pos and the items that follow in the user's rows (u, i, pos), each with the place at which it comes next.

    Users are sorted runs of a partition, read from the end, so a user of any size needs a place for each kind of item only.
    """

    def run(batches):
        now, seen = None, {}
        for b in batches:
            kinds, places, starts = [], [], [0]
            for u, i, pos in zip(*(b.column(c).to_pylist() for c in ("u", "i", "pos")), strict=True):
                if u != now:
                    now, seen = u, {}
                kinds.extend(seen)
                places.extend(seen.values())
                starts.append(len(places))
                seen[i] = pos
            following = pa.MapArray.from_arrays(pa.array(starts, pa.int32()), pa.array(kinds, pa.string()), pa.array(places, pa.int32()))
            yield pa.RecordBatch.from_arrays([b.column("u"), b.column("pos"), following], ["u", "pos", "following"])

    runs = places.repartition("u").sortWithinPartitions("u", F.desc("pos"))
    return runs.mapInArrow(run, f"u {places.schema['u'].dataType.simpleString()}, pos int, following map<string, int>")


def frequent_sequences(rows: DataFrame, user: str, order: list[str], item: str, least: int, longest: int = 4) -> DataFrame:
    """path (items joined by >), length and users of the sequences that at least ``least`` users went through, other items between or not.

    Prefix projection: of a user and a path only the earliest place at which it can end is kept, as every
    continuation follows that one too; paths grow by one item per round, rare ones are dropped with all that would start with them.
    What follows a place is found once, so a round makes one row per user and path, whatever the number of the user's rows.
    """
    place = F.row_number().over(Window.partitionBy(user).orderBy(*order))
    numbered = kept(rows.select(F.col(user).alias("u"), F.col(item).cast("string").alias("i"), place.alias("pos")).where("i IS NOT NULL"))
    front, found, following = numbered.groupBy("u", F.col("i").alias("path")).agg(F.min("pos").alias("end")), [], None
    for length in range(1, longest + 1):
        front = kept(front) if length < longest else front  # the last ones are only counted
        support = kept(front.groupBy("path").agg(F.count("*").alias("users")).where(F.col("users") >= least))
        found.append(support.select("path", F.lit(length).alias("length"), "users"))
        if length < longest:
            if following is None:
                following = kept(_following(numbered.where("u IS NOT NULL").join(support.select(F.col("path").alias("i")), "i", "left_semi")))
            ends = front.join(support.select("path"), "path", "left_semi")
            # the tables are many times the files that their sizes are guessed from: never broadcast
            met = ends.join(following.withColumnRenamed("pos", "end").hint("merge"), ["u", "end"])
            longer = met.select("u", "path", F.explode("following").alias("i", "pos"))
            front = longer.select("u", F.concat("path", F.lit(">"), "i").alias("path"), F.col("pos").alias("end"))
    return reduce(DataFrame.union, found)
