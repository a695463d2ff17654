"""Histories, trends, sequences, exact samples and digest trees against plain Python."""

import hashlib
import math
import random

import duckdb
from pyspark.sql import functions as F

from threadline.operators import history as hs
from threadline.operators import tables as tb
from threadline.plans import history_queries as hq


def test_values_as_of_a_time(spark):
    """One key has most of the versions and facts; some versions change nothing, some share a time."""
    rng = random.Random(3)
    versions = [(rng.choice([1, 1, 1, 2, 3]), rng.randrange(300), rng.choice(["a", "b", None]), i) for i in range(200)]
    facts = [(rng.choice([1, 1, 1, 2, 3, 4]), rng.randrange(-10, 310), i) for i in range(300)]
    v = spark.createDataFrame(versions, "u long, at long, value string, i long")
    iv = hs.intervals(v, "u", "at", "value", "i")
    last = {}
    for u, at, value, i in sorted(versions, key=lambda r: (r[1], r[3])):
        last.setdefault(u, {})[at] = value
    want = []
    for u, times in last.items():
        kept = []
        for at, value in sorted(times.items()):
            if not kept or kept[-1][1] != value:
                kept.append((at, value))
        want += [(u, a, kept[j + 1][0] if j + 1 < len(kept) else None, value) for j, (a, value) in enumerate(kept)]
    key = lambda r: (r[0], r[1])
    assert sorted(map(tuple, iv.collect()), key=key) == sorted(want, key=key)
    f = spark.createDataFrame(facts, "u long, at long, n long")
    for span in (7, 50, 10_000):
        got = {r.n: r.value for r in hs.as_of(f, iv, "u", "at", "value", span).collect()}
        assert got == {n: next((x[1] for x in sorted(last.get(u, {}).items(), reverse=True) if x[0] <= at), None) for u, at, n in facts}


def test_change_points(spark):
    rng = random.Random(5)
    levels = [(30, 5), (25, 50), (40, 20), (6, 90)]
    y = [m + rng.randrange(-3, 4) for k, m in levels for _ in range(k)]
    rows = [("s", d, v) for d, v in enumerate(y)] + [("flat", d, 4) for d in range(40)] + [("short", 1, 9)]

    def cuts(a, z, rounds):
        part = y[a:z]
        k, mean = len(part), sum(part) / len(part)
        sd = math.sqrt(sum((v - mean) ** 2 for v in part) / k)
        if not rounds or k < 8 or sd == 0:
            return []
        sums, t = [], 0.0
        for v in part:
            t += v - mean
            sums.append(round(abs(t), 9))
        at = sums.index(max(sums))
        if sums[at] / (sd * math.sqrt(k)) <= 1.36:
            return []
        return [a + at, *cuts(a, a + at + 1, rounds - 1), *cuts(a + at + 1, z, rounds - 1)]

    got = hs.change_points(spark.createDataFrame(rows, "s string, day long, n long"), "s", "day").collect()
    assert {r.s for r in got} == {"s"}
    assert sorted(r.day for r in got) == sorted(cuts(0, len(y), 4)) and {29, 54}.issubset(r.day for r in got)


def test_trends_fill_gaps(spark):
    rows = spark.createDataFrame([("a", 1), ("a", 1), ("a", 4), ("b", 7)], "s string, day long")
    got = {(r.s, r.day): (r.n, r.slope) for r in hs.trends(hs.daily(rows, "s", "day"), "s", "day", 3).collect()}
    assert got == {("a", 1): (2, None), ("a", 2): (0, -2.0), ("a", 3): (0, -1.0), ("a", 4): (1, 0.5), ("b", 7): (1, None)}


def test_frequent_sequences(spark):
    rng = random.Random(9)
    rows = [(rng.choice([0, 0, 0, *range(1, 12)]), i, rng.choice("abcd") if i % 17 else None) for i in range(160)]
    by = {}
    for u, _, x in rows:
        by.setdefault(u, []).append(x)

    def holds(items, path):
        it = iter(items)
        return all(any(x == p for x in it) for p in path)

    want, front = {}, [()]
    for length in range(1, 5):
        front = [(*p, x) for p in front for x in "abcd" if sum(holds(s, (*p, x)) for s in by.values()) >= 5]
        want |= {">".join(p): (length, sum(holds(s, p) for s in by.values())) for p in front}
    got = hs.frequent_sequences(spark.createDataFrame(rows, "u long, t long, x string"), "u", ["t"], "x", 5).collect()
    assert {r.path: (r.length, r.users) for r in got} == want and len(got) == len(want) > 20


def test_sequences_broadcast_no_places(spark, monkeypatch):
    """A user's places and paths are joined by sorting, however small their files are; a round makes one row per user and path."""
    plans = []
    monkeypatch.setattr(hs, "kept", lambda df, was=hs.kept: plans.append(df._jdf.queryExecution().executedPlan().toString()) or was(df))
    rows = spark.range(6000).selectExpr("id % 3 AS u", "id AS t", "concat('k', pmod(hash(id), 4)) AS x").unionByName(spark.range(9).selectExpr("CAST(NULL AS BIGINT) AS u", "id AS t", "'k1' AS x"))
    got = hs.frequent_sequences(rows, "u", ["t"], "x", 3).collect()
    assert sorted({r.users for r in got if r.length > 1}) == [3] and len(got) == 4 + 16 + 64 + 256
    assert not [x for p in plans for x in p.splitlines() if "BroadcastHashJoin" in x and "LeftSemi" not in x]


def test_exact_sample(spark):
    users = spark.range(5000).withColumnRenamed("id", "user_id")
    ranked = sorted(range(5000), key=lambda i: (hashlib.md5(f"{i}:7".encode()).hexdigest(), i))
    for rate in (0, 0.1, 0.333, 1, 2):
        k = max(1, int(5000 * min(1, rate)))
        assert {r.user_id for r in tb.user_sample(users, rate, 7).collect()} == set(ranked[:k])
    assert tb.user_sample(users.where("false"), 0.5).count() == 0


def test_digest_trees_locate_changes(spark, tmp_path):
    rows = [(i, f"v{i}", None) for i in range(3000)]
    new = [r for r in rows if r[0] != 17] + [(5, "v5", None), (9000, None, "x"), (40, "other", None)]
    new.remove((40, "v40", None))
    ddl = "k long, v string, w string"
    for name, some in (("a", rows), ("b", new), ("c", rows[::-1])):
        tb.write_digested(spark.createDataFrame(some, ddl), f"{tmp_path}/{name}", ["k"], 2)
    changed = tb.changes(spark, f"{tmp_path}/a", f"{tmp_path}/b", ["k"], 2)
    assert {r.k: r.how for r in changed.collect()} == {5: "changed", 17: "removed", 40: "changed", 9000: "added"}
    assert len(tb.unequal_leaves(spark, f"{tmp_path}/a", f"{tmp_path}/b", 2)) <= 4
    assert tb.unequal_leaves(spark, f"{tmp_path}/a", f"{tmp_path}/c", 2) == []
    assert tb.changes(spark, f"{tmp_path}/a", f"{tmp_path}/c", ["k"], 2).select(F.count("*")).first()[0] == 0


def test_customer_changes_against_sql(spark, tmp_path):
    """1900 and 12450 are removed and would come back as second rows; a balance and a key are null."""
    rows = [(k, f"c{k}", k % 25, None if k % 74 == 0 else float(k), "X") for k in [*range(1, 2200), *range(12400, 12500)]] + [(None, "nobody", 1, 1.0, "X")]
    spark.createDataFrame(rows, "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string").write.parquet(f"{tmp_path}/customer.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW customer AS SELECT * FROM read_parquet('{tmp_path}/customer.parquet/*.parquet')")
    want = sorted(con.execute(hq.ORACLE_SQL["customer_changes"]).fetchall())
    assert sorted(map(tuple, hq.customer_changes(spark, str(tmp_path)).collect())) == want
    assert {(1900, "removed"), (12450, "removed")} <= set(want)
