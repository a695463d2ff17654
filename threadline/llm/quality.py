"""Quality rules with risk-controlled thresholds (DataFrame functions only).

Base counts come from each whole text.  Five ratios (per mille, integers) may
reject a document when they reach a cutoff.  A cutoff is chosen per stratum
(language) from labelled documents: for every candidate the good documents that
it would reject are counted, and the candidate is valid when the exact binomial
test says that its true false-rejection rate is below ``risk``:

    P[Bin(n_good, risk) <= rejected] <= delta / number of tests

(Clopper-Pearson; Bonferroni over strata, ratios and candidates).  The lowest
valid cutoff of each ratio applies; without one, the ratio rejects nothing.
The risk holds for each ratio, so ``risk`` = ``total_risk`` / 5 bounds them all.

Defined results: null or empty text has no words and fails the base rule; a
document whose language is null or has too few labelled good documents uses the
cutoffs of the pooled stratum; null labels and labels of unknown documents are
ignored; repeated doc_ids are judged row by row, and count as so many trials (the
bound is exact where labelled rows are distinct); extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD_GAP, stored

RATIOS = ("symbols", "dup_lines", "repeats", "capitals", "bangs")
#: Candidate cutoffs, per mille.
GRID = (20, 30, 50, 80, 120, 170, 230, 300, 400, 500, 650, 800)
POOLED = "*"


def let(value: Column, body) -> Column:
    """body(value), with value computed once (a lambda variable is never inlined)."""
    return F.element_at(F.transform(F.array(value), body), 1)


def repeat_words(hashes: Column, size: int = 8) -> Column:
    """Words inside windows of ``size`` words that occur twice or more in the array."""

    def covered(starts: Column) -> Column:
        def gap(x, j):
            later = F.try_element_at(starts, j + F.lit(2))
            return F.when(later.isNull(), F.lit(size)).otherwise(F.least(F.lit(size), later - x))

        return F.aggregate(F.transform(starts, gap), F.lit(0), lambda a, b: a + b)

    def twice(ordered: Column) -> Column:
        return F.filter(
            ordered,
            lambda x, j: (F.try_element_at(ordered, j + F.lit(2))["h"] == x["h"])
            | (F.when(j > 0, F.try_element_at(ordered, F.greatest(j, F.lit(1))))["h"] == x["h"]),
        )

    def windows(h: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.size(h) - F.lit(size - 1)), lambda i: F.xxhash64(F.slice(h, i, F.lit(size))))

    def count(w: Column) -> Column:
        pairs = F.sort_array(F.transform(w, lambda x, j: F.struct(x.alias("h"), j.alias("i"))))
        some = let(pairs, lambda s: let(F.sort_array(F.transform(twice(s), lambda x: x["i"])), covered))
        return F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0)).otherwise(some)

    return F.when(F.size(hashes) <= size, F.lit(0)).otherwise(let(windows(hashes), count)).cast("long")


def base_counts(docs: DataFrame) -> DataFrame:
    """doc_id, h (hash of the text), lang and the counts of each whole text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    bare = F.regexp_replace("text", WORD_GAP, "")
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    rows = docs.select("doc_id", F.xxhash64(text).alias("h"), F.col("lang").cast("string").alias("lang"), text.alias("text"))
    rows = rows.select(
        "doc_id",
        "h",
        "lang",
        F.transform(F.filter(F.split("text", WORD_GAP), lambda w: w != ""), lambda w: F.xxhash64(w)).alias("hashes"),
        bare.alias("bare"),
        let(lines, lambda x: F.struct(F.size(x).alias("all"), F.size(F.array_distinct(x)).alias("different"))).alias("lines"),
    )
    return rows.select(
        "doc_id",
        "h",
        "lang",
        F.size("hashes").cast("long").alias("n_words"),
        F.length("bare").cast("long").alias("word_chars"),
        (F.length("bare") - F.length(F.regexp_replace("bare", "[#*$%&|<>]+", ""))).cast("long").alias("n_symbols"),
        (F.col("lines.all") - F.col("lines.different")).cast("long").alias("n_dup_lines"),
        repeat_words(F.col("hashes")).alias("n_repeat_words"),
        F.col("lines.all").cast("long").alias("n_lines"),
        (F.length("bare") - F.length(F.regexp_replace("bare", "[A-Z]+", ""))).cast("long").alias("n_capitals"),
        (F.length("bare") - F.length(F.regexp_replace("bare", "!+", ""))).cast("long").alias("n_bangs"),
    )


def ratios(counts: DataFrame) -> DataFrame:
    def per_mille(a, b):
        return F.when(F.col(b) > 0, F.expr(f"{a} * 1000 div {b}")).otherwise(F.lit(0)).cast("long")

    return counts.withColumns(
        {
            "symbols": per_mille("n_symbols", "word_chars"),
            "dup_lines": per_mille("n_dup_lines", "n_lines"),
            "repeats": per_mille("n_repeat_words", "n_words"),
            "capitals": per_mille("n_capitals", "word_chars"),
            "bangs": per_mille("n_bangs", "word_chars"),
            "base_failed": (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words")),
        }
    )


def log_binomial_cdf(k: Column, n: Column, p: float) -> Column:
    """log P[Bin(n, p) <= k], summed term by term in logarithms."""
    odds = F.log(F.lit(p / (1 - p)))

    def step(acc, i):
        term = acc["term"] + F.log((n - i + 1) / i) + odds
        high = F.greatest(acc["total"], term)
        return F.struct(term.alias("term"), (high + F.log(F.exp(acc["total"] - high) + F.exp(term - high))).alias("total"))

    first = (n * F.log(F.lit(1 - p))).cast("double")
    steps = F.when(k >= 1, F.sequence(F.lit(1).cast("long"), k.cast("long"))).otherwise(F.array().cast("array<long>"))
    return F.aggregate(steps, F.struct(first.alias("term"), first.alias("total")), step, lambda a: a["total"])


def cutoffs(measured: DataFrame, labels: DataFrame, total_risk: float = 0.05, delta: float = 0.05) -> DataFrame:
    """One row per stratum (language, and ``*`` pooled) with the chosen cutoff of each ratio, null for none.

    The table grows with the distinct languages of good labelled documents only.
    """
    risk = total_risk / len(RATIOS)
    good = measured.join(labels.where("quality = 1").select("doc_id").distinct(), "doc_id", "left_semi").where(~F.col("base_failed"))
    # counts per stratum, ratio and band of the grid; then a cumulative sum over the few bands
    band = {r: F.expr("+".join(f"int({r} >= {g})" for g in GRID)) for r in RATIOS}
    strata_of_row = F.array_distinct(F.array(F.coalesce("lang", F.lit(POOLED)), F.lit(POOLED)))
    counted = (
        good.select(F.explode(strata_of_row).alias("stratum"), *[b.alias(r) for r, b in band.items()])
        .unpivot(["stratum"], list(RATIOS), "ratio", "band")
        .groupBy("stratum", "ratio", "band")
        .agg(F.count("*").alias("n"))
        .groupBy("stratum", "ratio")
        .agg(F.map_from_entries(F.collect_list(F.struct("band", "n"))).alias("bands"), F.sum("n").alias("n"))
    )
    tested = counted.select("stratum", "ratio", "n", F.posexplode(F.array(*[F.lit(g) for g in GRID])).alias("pos", "cutoff"), "bands").select(
        "stratum",
        "ratio",
        "n",
        "cutoff",
        F.aggregate(
            F.sequence(F.col("pos") + 1, F.lit(len(GRID))),
            F.lit(0).cast("long"),
            lambda a, i: a + F.coalesce(F.try_element_at("bands", i), F.lit(0)),
        ).alias("rejected"),
    )
    strata = tested.groupBy("stratum").agg(F.max("n").alias("n"))
    tests = strata.agg((F.count("*") * len(RATIOS) * len(GRID)).alias("tests"))
    valid = (
        tested.crossJoin(F.broadcast(tests))  # one row
        # when no more than the mean is rejected the sum is short; beyond it the test can't succeed
        .where(F.col("rejected") <= F.col("n") * risk)
        .where(log_binomial_cdf(F.col("rejected"), F.col("n"), risk) <= F.log(F.lit(delta)) - F.log(F.col("tests")))
    )
    # strata so small that not even zero rejections would do use the pooled cutoffs
    large = strata.crossJoin(F.broadcast(tests)).where((F.col("stratum") == POOLED) | (F.col("n") * F.log(F.lit(1 - risk)) <= F.log(F.lit(delta)) - F.log(F.col("tests"))))
    return large.select("stratum").join(
        valid.groupBy("stratum").agg(*[F.min(F.when(F.col("ratio") == r, F.col("cutoff"))).alias(f"cut_{r}") for r in RATIOS]), "stratum", "left"
    )


def judge(docs: DataFrame, labels: DataFrame, pooled_too: bool = True, **options) -> DataFrame:
    """Counts, ratios, base_failed and kept for every row of docs.

    Without ``pooled_too`` the ratios reject nothing in strata that have no cutoffs of
    their own; with it (as in the SQL) the pooled ones apply there, whose risk is
    certified for the mix of all languages only.
    """
    measured = stored(ratios(base_counts(docs)), "quality")
    cuts = stored(cutoffs(measured, labels, **options), "cutoffs")
    own = measured.join(cuts.where(F.col("stratum") != POOLED), F.col("lang") == F.col("stratum"), "left")
    pooled = cuts.where(F.col("stratum") == POOLED).select(F.struct(*[f"cut_{r}" for r in RATIOS]).alias("pooled"))
    has = F.col("stratum").isNotNull()
    both = own.join(F.broadcast(pooled), how="left")  # at most one row
    beyond = F.lit(False)
    for r in RATIOS:
        cut = F.when(has, F.col(f"cut_{r}")).otherwise(F.col(f"pooled.cut_{r}") if pooled_too else F.lit(None))
        beyond = beyond | F.coalesce(F.col(r) >= cut, F.lit(False))
    return both.select(*measured.columns, (~F.col("base_failed") & ~beyond).alias("kept"))
