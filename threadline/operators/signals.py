"""Signals of matchings: who was accepted."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

EXCHANGED, REFUSED = "ContactExchanged", "Failed - Refused"


def classify(matchings: DataFrame) -> DataFrame:
    """One row per matching that carries a signal: users and their TP or FP.

    Exactly two users; an exchange makes both TP; a refusal needs one rejection and makes
    TP only who accepted.
    """
    rows = matchings.where(F.col("status").isin(EXCHANGED, REFUSED) & (F.size("users") == 2))
    given = F.concat(F.coalesce("acceptance", F.array().cast("array<string>")), F.array(F.lit(None).cast("string"), F.lit(None).cast("string")))
    rows = rows.withColumn("_a", F.slice(given, 1, 2)).where((F.col("status") == EXCHANGED) | F.array_contains("_a", "rejected"))
    signal = F.transform("_a", lambda a: F.when((F.col("status") == EXCHANGED) | F.coalesce(a == "accepted", F.lit(False)), F.lit("TP")).otherwise(F.lit("FP")))
    return rows.select("matching_id", "users", signal.alias("signal"), "status")


def per_user(signals: DataFrame) -> DataFrame:
    pairs = F.transform(F.arrays_zip("users", "signal"), lambda x: x)
    return signals.select("matching_id", "status", F.explode(pairs).alias("p")).select("matching_id", "status", F.col("p.users").alias("user_id"), F.col("p.signal").alias("signal"))


def totals(signals: DataFrame) -> DataFrame:
    return per_user(signals).groupBy("status", "signal").agg(F.count("*").alias("n"), F.count_distinct("user_id").alias("users"))
