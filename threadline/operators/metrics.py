"""Scores of match records (matching.records), per run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Bounds of the calibration bins.
BINS = (0.0, 0.3, 0.6, 0.8, 1.01)


def _ratio(a, b):
    return F.when(b > 0, a / b)


def _f1(p, r):
    return F.when(p + r > 0, 2 * p * r / (p + r)).when(p.isNotNull() & r.isNotNull(), F.lit(0.0))


def _same_sub():
    clean = lambda c: F.lower(F.trim(F.coalesce(c, F.lit(""))))
    return F.col("matched") & (clean(F.col("gt_sub")) == clean(F.col("model_sub")))


def topic_scores(records: DataFrame, model: DataFrame) -> DataFrame:
    """Precision over all model segments, recall over all true ones."""
    totals = model.groupBy("run_id").agg(F.count("*").alias("n_model"))
    ok = F.col("matched") & F.col("gt_topic").eqNullSafe(F.col("model_topic"))
    rows = records.groupBy("run_id").agg(F.count("*").alias("n_gt"), F.count_if("matched").alias("n_matched"), F.count_if(ok).alias("correct")).join(totals, "run_id", "left")
    rows = rows.withColumn("n_model", F.coalesce("n_model", "n_matched"))
    any_match = F.col("n_matched") > 0
    p, r = F.when(any_match, _ratio(F.col("correct"), F.col("n_model"))), F.when(any_match, _ratio(F.col("correct"), F.col("n_gt")))
    rows = rows.withColumn("precision", p).withColumn("recall", r).withColumn("matched_accuracy", _ratio(F.col("correct"), F.col("n_matched")))
    return rows.withColumn("f1", _f1(F.col("precision"), F.col("recall"))).select("run_id", "n_gt", "n_model", "n_matched", "correct", "precision", "recall", "f1", "matched_accuracy")


def per_topic(records: DataFrame) -> DataFrame:
    """Hits, false alarms and misses of each topic; an unmatched true segment is a miss."""
    ok = F.col("matched") & (F.col("gt_topic") == F.col("model_topic"))
    of_gt = records.groupBy("run_id", F.col("gt_topic").alias("topic")).agg(F.count_if(ok).alias("tp"), F.count_if(~ok).alias("fn"), F.count("*").alias("support"))
    of_model = records.where(F.col("matched") & (F.col("gt_topic") != F.col("model_topic"))).groupBy("run_id", F.col("model_topic").alias("topic")).agg(F.count("*").alias("fp"))
    rows = of_gt.join(of_model, ["run_id", "topic"], "full").na.fill(0)
    rows = rows.withColumn("precision", F.coalesce(_ratio(F.col("tp"), F.col("tp") + F.col("fp")), F.lit(0.0))).withColumn("recall", F.coalesce(_ratio(F.col("tp"), F.col("tp") + F.col("fn")), F.lit(0.0)))
    return rows.withColumn("f1", F.coalesce(_f1(F.col("precision"), F.col("recall")), F.lit(0.0))).select("run_id", "topic", "tp", "fp", "fn", "support", "precision", "recall", "f1")


def averaged_f1(by_topic: DataFrame) -> DataFrame:
    return by_topic.groupBy("run_id").agg(F.avg("f1").alias("macro_f1"), _ratio(F.sum(F.col("f1") * F.col("support")), F.sum("support")).alias("weighted_f1"))


def confusion(records: DataFrame) -> DataFrame:
    return records.where("matched").groupBy("run_id", "gt_topic", F.coalesce("model_topic", F.lit("")).alias("model_topic")).agg(F.count("*").alias("n"))


def sub_topic_scores(records: DataFrame) -> DataFrame:
    """Over true segments with a sub-topic and matches whose model segment has one."""
    has_model = F.col("matched") & F.col("model_sub").isNotNull()
    rows = records.groupBy("run_id").agg(F.count_if(F.col("gt_sub").isNotNull()).alias("n_gt"), F.count_if(has_model).alias("n_model"), F.count_if(_same_sub() & (F.col("gt_sub").isNotNull() | F.col("model_sub").isNotNull())).alias("correct"))
    rows = rows.withColumn("precision", _ratio(F.col("correct"), F.col("n_model"))).withColumn("recall", _ratio(F.col("correct"), F.col("n_gt")))
    return rows.withColumn("f1", _f1(F.col("precision"), F.col("recall")))


def unified(records: DataFrame, model: DataFrame) -> DataFrame:
    """Overlap, halved for a wrong sub-topic and nothing for a wrong topic, over the larger segment count."""
    totals = model.groupBy("run_id").agg(F.count("*").alias("n_model"))
    topic = F.col("matched") & (F.col("gt_topic") == F.col("model_topic"))
    gain = F.when(topic, F.col("iou") * (0.5 + 0.5 * _same_sub().cast("double"))).otherwise(0.0)
    rows = records.groupBy("run_id").agg(F.count("*").alias("n_gt"), F.sum(gain).alias("_gain"), F.sum(F.when(topic, F.col("iou")).otherwise(0.0)).alias("_topic"), F.avg(F.when(F.col("matched"), F.col("iou"))).alias("_jaccard"))
    rows = rows.join(totals, "run_id", "left")
    most = F.greatest("n_gt", F.coalesce("n_model", F.lit(0)))
    return rows.select("run_id", (F.col("_gain") / most).alias("unified_score"), (F.col("_topic") / most).alias("topic_score"), F.col("_jaccard").alias("avg_jaccard"))


def calibration(records: DataFrame) -> DataFrame:
    """Fixed confidence bins: count, accuracy, mean confidence, and the bin's share of the calibration error."""
    bins = records.sparkSession.createDataFrame([(i, lo, hi) for i, (lo, hi) in enumerate(zip(BINS, BINS[1:], strict=False))], "bin int, lo double, hi double")
    rows = records.where("matched AND confidence IS NOT NULL").withColumn("ok", (F.col("gt_topic") == F.col("model_topic")).cast("double"))
    number = F.coalesce(*[F.when((F.col("confidence") >= lo) & (F.col("confidence") < hi), F.lit(i)) for i, (lo, hi) in enumerate(zip(BINS, BINS[1:], strict=False))])
    counted = rows.groupBy("run_id", number.alias("bin")).agg(F.count("*").alias("n"), F.avg("ok").alias("a"), F.avg("confidence").alias("c"))
    total = rows.groupBy("run_id").agg(F.count("*").alias("total"))
    full = total.join(F.broadcast(bins)).join(counted, ["run_id", "bin"], "left")
    full = full.select("run_id", "bin", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("a", F.lit(0.0)).alias("accuracy"), F.coalesce("c", (F.col("lo") + F.least("hi", F.lit(1.0))) / 2).alias("confidence"), "total", (F.coalesce("n", F.lit(0)) / F.col("total") * F.abs(F.coalesce("a", F.lit(0.0)) - F.coalesce("c", F.lit(0.0)))).alias("_part"))
    return full.select("run_id", "bin", "n", "accuracy", "confidence", F.sum("_part").over(Window.partitionBy("run_id")).alias("ece"))


def coverage(records: DataFrame, model: DataFrame) -> DataFrame:
    """Match rate, mean overlap of matches and segment ratio: of all, and of segments with a user."""
    totals = model.groupBy("run_id").agg(F.count("*").alias("n_model"))
    scoped = records.withColumn("scope", F.explode(F.when(F.col("engaged"), F.array(F.lit("all"), F.lit("user_engaged"))).otherwise(F.array(F.lit("all")))))
    rows = scoped.groupBy("run_id", "scope").agg(F.count("*").alias("n_gt"), F.count_if("matched").alias("n_matched"), F.avg(F.when(F.col("matched"), F.col("iou"))).alias("_iou")).join(totals, "run_id", "left")
    # the engaged subset has no model total of its own: its matches stand in
    size = F.when(F.col("scope") == "all", F.col("n_model")).otherwise(F.col("n_matched"))
    return rows.select("run_id", "scope", "n_gt", "n_matched", (F.col("n_matched") / F.col("n_gt")).alias("match_rate"), F.col("_iou").alias("avg_iou"), (size / F.col("n_gt")).alias("segment_ratio"))


def leaderboard(scores: DataFrame, by=("unified_score", "sub_accuracy", "topic_accuracy", "match_rate")) -> DataFrame:
    """Rank within group: best first, a missing first score last, other missing scores first, run_id between equals."""
    first, *others = by
    order = Window.partitionBy("group_id").orderBy(F.desc(F.coalesce(first, F.lit(-1.0))), *[F.desc_nulls_first(c) for c in others], "run_id")
    return scores.withColumn("rank", F.row_number().over(order))


def report_order(scores: DataFrame) -> DataFrame:
    """Rank within scope as the printed report has it: topic before sub-topic accuracy, missing scores last."""
    order = Window.partitionBy("scope").orderBy(*[F.desc(F.coalesce(c, F.lit(-1.0))) for c in ("unified_score", "topic_accuracy", "sub_accuracy")], "run_id")
    return scores.withColumn("rank", F.row_number().over(order))
