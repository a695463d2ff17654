"""Data-quality graders: each gives grader, passed, total, failures."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Share of users that may fail a check per user.
TOLERATED = 0.05


def _result(rows: DataFrame, name: str, bad, share: float | None = None) -> DataFrame:
    """rows with one condition each: passed without failures, or with fewer than a share of them."""
    counted = rows.agg(F.count("*").alias("total"), F.count_if(F.coalesce(bad, F.lit(False))).alias("failures"))
    ok = F.col("failures") == 0
    if share is not None:
        ok = ok | (F.col("failures") < share * F.col("total"))
    return counted.select(F.lit(name).alias("grader"), ok.alias("passed"), "total", "failures")


def _per_user(bridge: DataFrame, source: DataFrame) -> DataFrame:
    """Gaps, extras and repeats of each user's messages."""
    used = bridge.groupBy("user_id", "msg_id").agg(F.count("*").alias("uses"))
    both = source.select("user_id", "msg_id", F.lit(1).alias("there")).join(used, ["user_id", "msg_id"], "full")
    return both.groupBy("user_id").agg(F.count_if(F.col("uses").isNull()).alias("gaps"), F.count_if(F.col("there").isNull()).alias("extras"), F.count_if(F.col("uses") > 1).alias("repeats"))


def coverage_and_uniqueness(bridge, source):
    return _result(_per_user(bridge, source), "G0.3", (F.col("gaps") > 0) | (F.col("extras") > 0) | (F.col("repeats") > 0), TOLERATED)


def coverage(bridge, source):
    return _result(_per_user(bridge, source), "G0.7", (F.col("gaps") > 0) | (F.col("extras") > 0), TOLERATED)


def one_slot_per_bot_message(bridge, source):
    slots = bridge.groupBy("user_id", "msg_id").agg(F.count("*").alias("n")).join(source.select("msg_id", "type"), "msg_id", "left")
    users = slots.groupBy("user_id").agg(F.bool_or((F.col("n") > 1) & ~F.coalesce(F.col("type") == "user", F.lit(False))).alias("bad"))
    return _result(users, "G0.8", F.col("bad"), TOLERATED)


def complete_reviews(segments):
    marks = F.col("true_topic").isNotNull().cast("int") + F.col("true_sub_topic").isNotNull().cast("int") + F.col("reviewed_by").isNotNull().cast("int")
    return _result(segments, "G0.9", (marks > 0) & (marks < 3))


def labelled(segments):
    return _result(segments, "G0.10", F.coalesce(F.col("topic"), F.lit("")).eqNullSafe("") | F.coalesce(F.col("sub_topic"), F.lit("")).eqNullSafe(""))


def confidence_range(segments):
    c = F.col("confidence")
    bad = F.when(F.coalesce("has_user", F.lit(True)), (c < 0) | (c >= 1)).otherwise(c != 1)
    return _result(segments.where(c.isNotNull()), "G0.11", bad)


def single_message_share(segments, share: float = 0.2):
    counted = segments.agg(F.count("*").alias("total"), F.count_if(F.col("n_messages") == 1).alias("failures"))
    return counted.select(F.lit("G1.2").alias("grader"), (F.col("failures") < share * F.col("total")).alias("passed"), "total", "failures")


def contiguity(bridge):
    """Each segment's positions are consecutive, and no position of a user is in two."""
    each = bridge.groupBy("user_id", "segment_id").agg((F.max("pos") - F.min("pos") + 1 != F.count_distinct("pos")).alias("holes"))
    twice = bridge.groupBy("user_id", "pos").agg((F.count("*") > 1).alias("twice")).groupBy("user_id").agg(F.bool_or("twice").alias("twice"))
    users = each.groupBy("user_id").agg(F.bool_or("holes").alias("holes")).join(twice, "user_id")
    return _result(users, "G1.4", F.col("holes") | F.col("twice"), TOLERATED)


def no_repeats_in_segment(bridge):
    each = bridge.groupBy("segment_id").agg((F.count("*") > F.count_distinct("msg_id")).alias("bad"))
    return _result(each, "G0.1", F.col("bad"))


def no_dangling(bridge, source):
    refs = bridge.join(source.select("msg_id", F.lit(1).alias("there")), "msg_id", "left")
    return _result(refs, "G0.2", F.col("there").isNull())


def ordered_bounds(segments):
    return _result(segments, "G1.4d", F.col("started_at") > F.col("ended_at"))


def top_topic_share(segments, share: float = 0.4):
    by = segments.groupBy("topic").agg(F.count("*").alias("n")).agg(F.sum("n").alias("total"), F.max("n").alias("failures"))
    return by.select(F.lit("G3.1").alias("grader"), (F.col("failures") <= share * F.col("total")).alias("passed"), "total", "failures")


def run_all(bridge: DataFrame, segments: DataFrame, source: DataFrame) -> DataFrame:
    """All graders in four aggregations: of users, of a user's slots, of segments' members and of segments."""
    c = F.col
    slots = bridge.groupBy("user_id", "msg_id").agg(F.count("*").alias("uses"))
    both = source.select("user_id", "msg_id", "type", F.lit(1).alias("there")).join(slots, ["user_id", "msg_id"], "full")
    users = both.groupBy("user_id").agg(
        F.count_if(c("uses").isNull()).alias("gaps"), F.count_if(c("there").isNull()).alias("extras"), F.count_if(c("uses") > 1).alias("repeats"),
        F.count_if((c("uses") > 1) & ~F.coalesce(c("type") == "user", F.lit(False))).alias("bots"), F.count("uses").alias("used"),
    )
    holes = bridge.groupBy("user_id", "segment_id").agg((F.max("pos") - F.min("pos") + 1 != F.count_distinct("pos")).alias("h"), (F.count("*") > F.count_distinct("msg_id")).alias("again"))
    of_user = holes.groupBy("user_id").agg(F.bool_or("h").alias("h"), F.count("*").alias("segments"), F.count_if("again").alias("again"))
    twice = bridge.groupBy("user_id", "pos").agg((F.count("*") > 1).alias("t")).groupBy("user_id").agg(F.bool_or("t").alias("t"))
    dangling = bridge.join(source.select("msg_id", F.lit(1).alias("there")), "msg_id", "left")
    marks = c("true_topic").isNotNull().cast("int") + c("true_sub_topic").isNotNull().cast("int") + c("reviewed_by").isNotNull().cast("int")
    confidence = F.when(F.coalesce("has_user", F.lit(True)), (c("confidence") < 0) | (c("confidence") >= 1)).otherwise(c("confidence") != 1)
    empty = lambda x: F.coalesce(c(x), F.lit("")) == ""
    any_of = lambda *names: sum((c(n) for n in names[1:]), c(names[0])) > 0
    return reduce(
        DataFrame.unionByName,
        [
            _results(users, [("G0.3", any_of("gaps", "extras", "repeats"), None, TOLERATED), ("G0.7", any_of("gaps", "extras"), None, TOLERATED), ("G0.8", c("bots") > 0, c("used") > 0, TOLERATED)]),
            _results(of_user.join(twice, "user_id"), [("G1.4", c("h") | c("t"), None, TOLERATED)]),
            _results(holes, [("G0.1", c("again"), None, None)]),
            _results(dangling, [("G0.2", c("there").isNull(), None, None)]),
            _results(
                segments,
                [
                    ("G0.9", (marks > 0) & (marks < 3), None, None), ("G0.10", empty("topic") | empty("sub_topic"), None, None), ("G0.11", confidence, c("confidence").isNotNull(), None),
                    ("G1.4d", c("started_at") > c("ended_at"), None, None), ("G1.2", c("n_messages") == 1, None, 0.2),
                ],
            ).withColumn("passed", F.when(c("grader") == "G1.2", c("failures") < 0.2 * c("total")).otherwise(c("passed"))),
            top_topic_share(segments),
        ],
    )


def _results(rows: DataFrame, checks: list) -> DataFrame:
    """A row per check (name, bad, which rows count, share that may fail), all from one aggregation."""
    counts = []
    for name, bad, which, _ in checks:
        which = F.lit(True) if which is None else which
        counts.append(F.struct(F.lit(name).alias("grader"), F.count_if(which).alias("total"), F.count_if(which & F.coalesce(bad, F.lit(False))).alias("failures")))
    shares = F.coalesce(*[F.when(F.col("r.grader") == name, F.lit(float(share or 0))) for name, _, _, share in checks])
    each = rows.agg(F.array(*counts).alias("all")).select(F.explode("all").alias("r"))
    return each.select("r.grader", ((F.col("r.failures") == 0) | (F.col("r.failures") < shares * F.col("r.total"))).alias("passed"), "r.total", "r.failures")


def _measured(rows: DataFrame, name: str, value, passed) -> DataFrame:
    return rows.select(F.lit(name).alias("grader"), passed.alias("passed"), value.cast("double").alias("value"))


def size_report(segments: DataFrame, source: DataFrame, users: DataFrame) -> DataFrame:
    """G1.1 mean and most segments of a user, G1.3 messages in segments over all, G1.5 share of users without a chat."""
    c = F.col
    per_user = segments.groupBy("user_id").agg(F.count("*").alias("n"), F.sum("n_messages").alias("m")).agg(F.avg("n").alias("mean"), F.max("n").alias("most"), F.sum("m").alias("messages"))
    total = source.agg(F.count("*").alias("total"))
    no_chat = users.join(source.select("user_id").distinct().withColumn("there", F.lit(1)), "user_id", "left").agg(F.avg(c("there").isNull().cast("double")).alias("share"))
    one = per_user.crossJoin(total)  # one row each
    return reduce(
        DataFrame.unionByName,
        [
            _measured(per_user, "G1.1 mean", c("mean"), c("mean") > 0), _measured(per_user, "G1.1 most", c("most"), c("most") >= c("mean")),
            _measured(one, "G1.3", c("messages") / c("total"), c("messages") == c("total")), _measured(no_chat, "G1.5", c("share"), c("share") < 0.5),
        ],
    )


def cluster_report(rows: DataFrame) -> DataFrame:
    """Of rows with ``cluster`` (null: noise): G2.1 share of noise, G2.2 number of clusters, G2.3 share of the largest."""
    c = F.col
    n = rows.groupBy("cluster").agg(F.count("*").alias("n"))
    one = n.agg(F.sum("n").alias("all"), F.sum(F.when(c("cluster").isNull(), c("n")).otherwise(0)).alias("noise"), F.count("cluster").alias("clusters"), F.max(F.when(c("cluster").isNotNull(), c("n"))).alias("largest"))
    return reduce(
        DataFrame.unionByName,
        [
            _measured(one, "G2.1", c("noise") / c("all"), c("noise") < 0.4 * c("all")), _measured(one, "G2.2", c("clusters"), c("clusters").between(10, 100)),
            _measured(one, "G2.3", c("largest") / c("all"), c("largest") <= 0.3 * c("all")),
        ],
    )


def label_report(segments: DataFrame, topics: DataFrame, subs: DataFrame, least: float = 0.6) -> DataFrame:
    """G3.2 topics, G3.3 low confidence, G3.4 and G3.5 unconfirmed labels, G3.7 unlabelled, G3.8 accuracy of reviewed labels.

    topics (slug, confirmed), subs (topic_slug, slug, confirmed).
    """
    c = F.col
    t = topics.groupBy(c("slug").alias("topic")).agg(F.bool_or("confirmed").alias("_t"))
    s = subs.groupBy(c("topic_slug").alias("topic"), c("slug").alias("sub_topic")).agg(F.bool_or("confirmed").alias("_s"))
    rows = segments.join(t, "topic", "left").join(s, ["topic", "sub_topic"], "left")
    reviewed = c("true_topic").isNotNull()
    one = rows.agg(
        F.count_distinct("topic").alias("topics"), F.count_if(c("topic").isNotNull() & (F.coalesce("confidence", F.lit(0.0)) < least)).alias("low"), F.count_if(c("topic").isNotNull() & ~F.coalesce("_t", F.lit(False))).alias("ut"),
        F.count_if(c("sub_topic").isNotNull() & ~F.coalesce("_s", F.lit(False))).alias("us"), F.count_if(c("topic").isNull()).alias("unlabelled"),
        F.avg(F.when(reviewed, c("topic").eqNullSafe(c("true_topic")).cast("double"))).alias("accuracy"),
    )
    checks = (("G3.2", "topics", c("topics") >= 10), ("G3.3", "low", c("low") == 0), ("G3.4", "ut", c("ut") == 0), ("G3.5", "us", c("us") == 0), ("G3.7", "unlabelled", c("unlabelled") == 0), ("G3.8", "accuracy", c("accuracy") >= 0.8))
    return reduce(DataFrame.unionByName, [_measured(one, name, c(column), ok) for name, column, ok in checks])


def signal_report(segments: DataFrame, signals: DataFrame) -> DataFrame:
    """G0.4 segmented users without a signal, G4.2 share of signal users with segments; signals: user_id."""
    c = F.col
    a = segments.select("user_id").distinct().withColumn("seg", F.lit(1))
    both = a.join(signals.select("user_id").distinct().withColumn("sig", F.lit(1)), "user_id", "full")
    one = both.agg(F.count_if(c("sig").isNull()).alias("alone"), F.count("sig").alias("users"), F.count_if(c("seg").isNotNull() & c("sig").isNotNull()).alias("both"))
    return _measured(one, "G0.4", c("alone"), c("alone") == 0).unionByName(_measured(one, "G4.2", c("both") / c("users"), c("both") >= 0.9 * c("users")))


def signal_counts(signals: DataFrame, source: DataFrame, before: int | None = None) -> DataFrame:
    """Per status the signals (matching_id, status) and their matchings: G0.6 wants no more than there are, G0.5 the count of before."""
    n = signals.groupBy("status").agg(F.count_distinct("matching_id").alias("signals"))
    m = source.groupBy("status").agg(F.count("*").alias("matchings"))
    rows = n.join(m, "status", "left").withColumn("within", F.col("signals") <= F.coalesce("matchings", F.lit(0)))
    return rows if before is None else rows.withColumn("stable", F.sum("signals").over(Window.partitionBy()) == before)


def signal_topics(segments: DataFrame, signals: DataFrame) -> DataFrame:
    """G4.3: shares of topics among segments of users with TP and with FP signals, and their ratio."""
    joined = segments.select("segment_id", "user_id", "topic").join(signals.select("user_id", "signal").distinct(), "user_id")
    n = joined.groupBy("signal", "topic").agg(F.count("*").alias("n"))
    n = n.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy("signal")))
    part = lambda x: n.where(F.col("signal") == x).select("topic", F.col("share").alias(x.lower()))
    both = part("TP").join(part("FP"), "topic", "full")
    return both.withColumn("ratio", F.when(F.col("fp") > 0, F.col("tp") / F.col("fp")))


def user_details(bridge: DataFrame, source: DataFrame, most: int = 20) -> DataFrame:
    """The worst users of the coverage checks (a capped report)."""
    order = Window.orderBy(F.desc(F.col("gaps") + F.col("extras") + F.col("repeats")), "user_id")
    bad = _per_user(bridge, source).where("gaps + extras + repeats > 0").orderBy(F.desc(F.col("gaps") + F.col("extras") + F.col("repeats")), "user_id").limit(most)
    return bad.withColumn("rank", F.row_number().over(order))
