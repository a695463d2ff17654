"""Packing documents into sequences: cutting stock by column generation.

A document of n ids fills n // 2048 sequences alone; what remains (1 to 2047 ids)
has a length class of 16 ids.  The histogram of classes is the demand of a cutting
stock problem, whose linear program is solved by column generation: a knapsack
dynamic program prices new patterns until none improves.  Rounded-down patterns
are assigned to the documents by their rank within the class; the left-over counts
(at most some classes times patterns) are packed first-fit.

Rounding lengths up leaves small gaps.  A share of the documents, picked by a hash
of the row, is kept out of the program: their remainders form a stream that is cut
exactly into the gaps, and its tail into sequences of powers of two.  The share is
the smallest (in thousandths) whose ids fill all gaps, from the same histogram.

Defined results: null and empty texts are the end id alone; rows with equal doc_id
are packed each on its own (of equal rows either may stand for the other); an empty
table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import batch_rows, stored
from .tokens import Encoder, batches

SEQUENCE = 2048
UNIT = 16
CLASSES = SEQUENCE // UNIT
SHARES = 1000


# --- the linear program: bounded by CLASSES, so it is solved on the driver -------------


def price(duals: np.ndarray) -> tuple[float, np.ndarray]:
    """The pattern (count per class) of greatest dual value that fits, by dynamic programming."""
    best, take = np.zeros(CLASSES + 1), np.zeros(CLASSES + 1, dtype=np.int64)
    for room in range(1, CLASSES + 1):
        values = duals[:room] + best[room - 1 :: -1][:room]  # class c needs c + 1 units
        c = int(np.argmax(values))
        if values[c] > best[room - 1]:
            best[room], take[room] = values[c], c + 1
        else:
            best[room] = best[room - 1]
    pattern, room = np.zeros(CLASSES, dtype=np.int64), CLASSES
    while room:
        if take[room]:
            pattern[take[room] - 1] += 1
            room -= take[room]
        else:
            room -= 1
    return float(best[CLASSES]), pattern


def _inverse(matrix: np.ndarray) -> np.ndarray:
    """By Gauss and Jordan, without a matrix library: its threads may wait for each other for ever beside a JVM's."""
    n = len(matrix)
    both = np.hstack([matrix, np.eye(n)])
    for i in range(n):
        pivot = i + int(np.argmax(np.abs(both[i:, i])))
        both[[i, pivot]] = both[[pivot, i]]
        both[i] /= both[i, i]
        factor = both[:, i].copy()
        factor[i] = 0.0
        both -= factor[:, None] * both[i]
    return both[:, n:]


def solve(demand: np.ndarray, rounds: int = 5000) -> list[tuple[np.ndarray, int]]:
    """Patterns over all classes and how often each is used; together exactly the demand."""
    used = np.flatnonzero(demand)
    if not len(used):
        return []
    m = len(used)
    basis = np.zeros((m, m))
    for i, c in enumerate(used):
        basis[i, i] = CLASSES // (c + 1)
    inverse, need = _inverse(basis), demand[used].astype(float)
    amounts = (inverse * need).sum(axis=1)
    for i in range(rounds):
        duals = np.full(CLASSES, -1.0)
        duals[used] = inverse.sum(axis=0)
        value, pattern = price(duals)
        if value <= 1 + 1e-9:
            break
        column = pattern[used].astype(float)
        step = (inverse * column).sum(axis=1)  # small: no threads of a matrix library
        able = step > 1e-9
        ratio = np.where(able, amounts / np.where(able, step, 1), np.inf)
        leave = int(np.argmin(ratio))
        basis[:, leave] = column
        if i % 64 == 63:  # afresh now and then, against rounding
            inverse = _inverse(basis)
        else:
            row = inverse[leave] / step[leave]
            inverse = inverse - np.outer(step, row)
            inverse[leave] = row
        amounts = np.maximum((inverse * need).sum(axis=1), 0)
    left, plan = demand.astype(np.int64).copy(), []
    for j in np.argsort(-amounts, kind="stable"):
        pattern = np.zeros(CLASSES, dtype=np.int64)
        pattern[used] = np.rint(basis[:, j]).astype(np.int64)
        times = int(min(np.floor(amounts[j] + 1e-6), (left[pattern > 0] // pattern[pattern > 0]).min()))
        if times > 0:
            plan.append((pattern, times))
            left -= times * pattern
    while left.any():  # what rounding left: greedy patterns, each as often as it goes
        pattern, room = np.zeros(CLASSES, dtype=np.int64), CLASSES
        for c in range(CLASSES - 1, -1, -1):
            pattern[c] = min(left[c], room // (c + 1))
            room -= int(pattern[c]) * (c + 1)
        times = int((left[pattern > 0] // pattern[pattern > 0]).min())
        plan.append((pattern, times))
        left -= times * pattern
    return plan


def choose_share(count: np.ndarray, length: np.ndarray) -> tuple[int, list[tuple[np.ndarray, int]]]:
    """count, length [share, class]: the smallest share whose ids fill the gaps of the others' plan."""

    def plan_of(share):
        plan = solve(count[share:].sum(axis=0))
        return plan, SEQUENCE * sum(t for _, t in plan) - int(length[share:].sum())

    low, high, best = 0, SHARES, (SHARES, [])
    while low < high:
        middle = (low + high) // 2 if best[0] < SHARES or low > 64 else min(low + max(8, low), SHARES - 1)
        plan, gaps = plan_of(middle)
        if int(length[:middle].sum()) >= gaps:
            high, best = middle, (middle, plan)
        else:
            low = middle + 1
    return best


# --- the Spark jobs --------------------------------------------------------------------


def _numbered(rows: DataFrame, keys: list[str], size: str | None, groups: int) -> DataFrame:
    """rows with ``before``: how many rows (or how much of ``size``) of the same keys come earlier.

    Ranks are built from counts per (keys, hash group), so no key is ranked by one task.
    """
    rows = rows.withColumn("_g", F.pmod("k", F.lit(groups)))
    amount = F.col(size) if size else F.lit(1)
    sums = rows.groupBy(*keys, "_g").agg(F.sum(amount).cast("long").alias("_n"))
    over = Window.partitionBy(*keys).orderBy("_g")
    sums = sums.select(*keys, "_g", (F.sum("_n").over(over) - F.col("_n")).alias("_base"))
    within = Window.partitionBy(*keys, "_g").orderBy("k", "row")
    return (
        rows.withColumn("_in", F.sum(amount).over(within.rowsBetween(Window.unboundedPreceding, 0)) - amount)
        .join(sums, [*keys, "_g"])
        .withColumn("before", (F.col("_base") + F.col("_in")).cast("long"))
        .drop("_g", "_in", "_base")
    )


def tokenized(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """Per row: its key k (hash of row and text), row, doc_id, n ids, and the checksum of each fixed piece."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("k", F.xxhash64("doc_id", "text"))
    end = np.array([end_id], "<u4").tobytes()

    def run(frames):
        import pandas as pd

        encoder = Encoder.of(tokenizer)
        for f in frames:
            texts = f["text"].tolist()
            for a, b in batches(texts):
                part = f.iloc[a:b]
                data = [e + end for e in encoder.encode(texts[a:b])]
                step = 4 * SEQUENCE
                yield pd.DataFrame({"k": part["k"], "doc_id": part["doc_id"].astype("Int64"), "n": [len(d) // 4 for d in data], "crcs": [[zlib.crc32(d[i : i + step]) for i in range(0, len(d), step)] for d in data]})

    with batch_rows(docs.sparkSession, 1000):
        return stored(rows.mapInPandas(run, "k long, doc_id long, n long, crcs array<long>").withColumn("row", F.monotonically_increasing_id()), "packed")


def pack(docs: DataFrame, tokenizer: str, end_id: int = 1) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    spark = docs.sparkSession
    lens = tokenized(docs, tokenizer, end_id)
    lens = lens.withColumns({"full": F.expr(f"n div {SEQUENCE}"), "rest": (F.col("n") % SEQUENCE).cast("long"), "share": F.pmod(F.shiftright("k", 20), F.lit(SHARES))})
    lens = lens.withColumn("class", F.expr(f"(rest + {UNIT - 1}) div {UNIT}"))
    count, length = np.zeros((SHARES, CLASSES), np.int64), np.zeros((SHARES, CLASSES), np.int64)
    # at most SHARES x CLASSES rows, whatever the input
    for r in lens.where("rest > 0").groupBy("share", "class").agg(F.count("*").alias("c"), F.sum("rest").alias("l")).collect():
        count[r["share"], r["class"] - 1], length[r["share"], r["class"] - 1] = r["c"], r["l"]
    share, plan = choose_share(count, length)
    total = int(count.sum())
    groups = int(min(4096, max(16, total // 20_000)))

    packed = stored(_assign(lens.where(f"rest > 0 AND share >= {share}"), plan, groups), "assigned")
    n_packed = sum(t for _, t in plan)
    whole = _numbered(lens.where("full > 0"), [], "full", groups)
    n_whole = whole.agg(F.sum("full")).first()[0] or 0
    blocks = whole.select("doc_id", "n", "crcs", "before", F.explode(F.sequence(F.lit(0).cast("long"), F.col("full") - 1)).alias("i")).select(
        "doc_id",
        (F.col("i") * SEQUENCE).alias("start"),
        F.lit(SEQUENCE).cast("long").alias("length"),
        F.element_at("crcs", (F.col("i") + 1).cast("int")).alias("ids_crc32"),
        F.col("n").alias("doc_tokens"),
        (F.lit(n_packed) + F.col("before") + F.col("i")).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )
    rests = packed.select(
        "doc_id",
        (F.col("full") * SEQUENCE).alias("start"),
        F.col("rest").alias("length"),
        F.element_at("crcs", -1).alias("ids_crc32"),
        F.col("n").alias("doc_tokens"),
        "sequence_id",
        "offset",
    )
    stream_ids = int(length[:share].sum())
    filler = _fill(docs, lens.where(f"rest > 0 AND share < {share}"), packed, stream_ids, n_packed, n_packed + int(n_whole), share, groups, tokenizer, end_id)
    return blocks.unionByName(rests).unionByName(filler)


def _assign(rows: DataFrame, plan: list, groups: int) -> DataFrame:
    """sequence_id and offset of each remainder: its rank in its class names pattern, copy and place."""
    spark = rows.sparkSession
    first, used, base = [], np.zeros(CLASSES, np.int64), 0
    for pattern, times in plan:
        place = 0
        for c in range(CLASSES - 1, -1, -1):
            if pattern[c]:
                first.append((c + 1, int(used[c]), int(used[c] + times * pattern[c]), base, int(pattern[c]), place))
                used[c] += times * pattern[c]
                place += int(pattern[c])
        base += times
    # a row per class that occurs in a pattern: bounded by patterns x classes of the program
    table = spark.createDataFrame(first, "class long, lo long, hi long, base long, per long, place long")
    ranked = _numbered(rows, ["class"], None, groups).alias("r")
    at = ranked.join(F.broadcast(table.alias("t")), (F.col("r.class") == F.col("t.class")) & (F.col("before") >= F.col("lo")) & (F.col("before") < F.col("hi")))
    at = at.select("r.*", (F.col("base") + F.expr("(before - lo) div per")).alias("sequence_id"), (F.col("place") + (F.col("before") - F.col("lo")) % F.col("per")).alias("slot"))
    order = Window.partitionBy("sequence_id").orderBy("slot").rowsBetween(Window.unboundedPreceding, 0)
    return at.withColumn("offset", (F.sum("rest").over(order) - F.col("rest")).cast("long"))


def _fill(docs, fillers, packed, stream_ids, n_packed, next_id, share, groups, tokenizer, end_id) -> DataFrame:
    """Pieces of the stream of remainders kept out of the program, cut into the gaps and the tail."""
    spark = docs.sparkSession
    width = max(1024, n_packed // 4096)
    gaps = packed.groupBy("sequence_id").agg(F.sum("rest").alias("offset")).select("sequence_id", "offset", (SEQUENCE - F.col("offset")).alias("gap"), F.expr(f"sequence_id div {width}").alias("g"))
    sums = gaps.groupBy("g").agg(F.sum("gap").alias("n"))
    sums = sums.select("g", (F.sum("n").over(Window.orderBy("g")) - F.col("n")).alias("base"))
    inside = Window.partitionBy("g").orderBy("sequence_id").rowsBetween(Window.unboundedPreceding, 0)
    gaps = gaps.withColumn("run", F.sum("gap").over(inside) - F.col("gap")).join(sums, "g").select("sequence_id", "offset", (F.col("base") + F.col("run")).cast("long").alias("a"), "gap")
    gaps = stored(gaps.where("gap > 0").withColumn("b", F.col("a") + F.col("gap")).drop("gap"), "gaps")
    filled = gaps.agg(F.max("b")).first()[0] or 0
    tail = max(0, stream_ids - filled)
    full = tail // SEQUENCE
    more = spark.range(full).select((F.lit(next_id) + F.col("id")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"), (F.lit(filled) + F.col("id") * SEQUENCE).alias("a"), (F.lit(filled) + (F.col("id") + 1) * SEQUENCE).alias("b"))
    ends, at, seq = [], filled + full * SEQUENCE, next_id + full
    for bit in range(10, -1, -1):  # a sequence of a power of two needs no padding
        if (tail % SEQUENCE) >> bit & 1:
            ends.append((seq, 0, at, at + (1 << bit)))
            at, seq = at + (1 << bit), seq + 1
    rooms = gaps.unionByName(more).unionByName(spark.createDataFrame(ends, "sequence_id long, offset long, a long, b long"))

    def bins(rows, a, b):
        return rows.withColumn("bin", F.explode(F.sequence(F.expr(f"{a} div {SEQUENCE}"), F.expr(f"({b} - 1) div {SEQUENCE}"))))

    items = _numbered(fillers, [], "rest", groups).withColumn("end", F.col("before") + F.col("rest"))
    cut = bins(items, "before", "end").join(bins(rooms, "a", "b"), "bin")
    # an overlap may span two bins of both sides: it is taken in the bin where it starts
    lo, hi = F.greatest("before", "a"), F.least("end", "b")
    pieces = cut.where((lo < hi) & (F.expr(f"greatest(before, a) div {SEQUENCE}") == F.col("bin"))).select(
        "k", "row", "doc_id", F.col("n").alias("doc_tokens"), (F.col("full") * SEQUENCE + lo - F.col("before")).alias("start"), (hi - lo).alias("length"), "sequence_id", (F.col("offset") + lo - F.col("a")).alias("offset")
    )
    of_row = pieces.groupBy("k", "row", "doc_id", "doc_tokens").agg(F.collect_list(F.struct("start", "length", "sequence_id", "offset")).alias("pieces"))
    texts = docs.select(F.coalesce("text", F.lit("")).alias("text"), F.xxhash64(F.col("doc_id").cast("long"), F.coalesce("text", F.lit(""))).alias("k"))
    texts = texts.where(F.pmod(F.shiftright("k", 20), F.lit(SHARES)) < share).dropDuplicates(["k"])
    end = np.array([end_id], "<u4").tobytes()

    def crcs(frames):
        encoder = Encoder.of(tokenizer)
        for f in frames:
            data = [e + end for e in encoder.encode(f["text"].tolist())]
            f["crcs"] = [[zlib.crc32(d[4 * p["start"] : 4 * (p["start"] + p["length"])]) for p in ps] for d, ps in zip(data, f["pieces"], strict=True)]
            yield f.drop(columns=["text"])

    schema = "doc_id long, doc_tokens long, pieces array<struct<start:long,length:long,sequence_id:long,offset:long>>, crcs array<long>"
    with batch_rows(spark, 1000):
        summed = stored(of_row.join(texts, "k").select("doc_id", "doc_tokens", "pieces", "text").mapInPandas(crcs, schema), "pieces")
    return summed.select("doc_id", "doc_tokens", F.explode(F.arrays_zip("pieces", "crcs")).alias("p")).select(
        "doc_id", "p.pieces.start", "p.pieces.length", F.col("p.crcs").alias("ids_crc32"), "doc_tokens", "p.pieces.sequence_id", "p.pieces.offset"
    )
