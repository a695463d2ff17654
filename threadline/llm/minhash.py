"""Near-duplicates by b-bit MinHash.

A document's set holds its distinct 5-word shingles.  Documents with equal sets
are one class.  HASHES minima per class give band keys (candidates share one) and
a packed signature of their low BITS bits; candidates whose collision-corrected
similarity, from bit counts, is far below the threshold are dropped, the others
are confirmed on the full sets.

A band bucket never emits its pairs.  First each member meets the bucket's smallest
one, which joins groups of near copies into components.  Buckets that still hold
several components are then searched inside their tasks, large ones block by block:
pairs of different components (each in the first band that they share) whose
estimates pass are confirmed there on the full sets, the likeliest first, and only
links that join two components of the block are given out, fewer than it has members.
The first bands go before the others, so that what they join is not searched again.
No link between components is lost.

Defined results: null, empty or blank texts have an empty set and are linked with
nothing; rows with the same doc_id are judged each by its own text, and a null
doc_id never names a component unless all of it is null; an empty table gives no
rows; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import batch_rows, stored
from .components import components

SIZE = 5
BANDS, ROWS = 32, 4
HASHES = BANDS * ROWS
BITS = 4
NIBBLES = 0x1111111111111111
#: Estimates below this are dropped: at a similarity of 0.75 that is six deviations away.
LEAST_ESTIMATE = 0.5
#: A bucket's blocks hold about so many classes, and so many shingles, at most.
BLOCK, BLOCK_SHINGLES = 1000, 2_000_000
#: Bands searched before the others.
FIRST_BANDS = 4

_RNG = np.random.default_rng(20_240_601)
_A = (_RNG.integers(0, 1 << 63, HASHES, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)
_B = _RNG.integers(0, 1 << 63, HASHES, dtype=np.uint64)
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63], dtype=np.uint64)


def _finish(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return h ^ (h >> np.uint64(29))


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the 5-word shingles (of the whole sequence, if shorter)."""
    words = (text or "").encode().lower().split()  # bytes: ASCII letters and white space only
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    h = _finish(np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, n))
    k = min(n, SIZE)
    mixed = np.full(n - k + 1, k, np.uint64)
    for i in range(k):
        mixed = _finish(mixed ^ (h[i : n - k + 1 + i] * _MIX[i]))
    return np.unique(mixed)


def minima(found: np.ndarray) -> np.ndarray:
    out = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(found), 512):
        out = np.minimum(out, (found[i : i + 512, None] * _A + _B).min(axis=0))
    return out


def band_keys(low: np.ndarray) -> np.ndarray:
    keys = np.arange(1, BANDS + 1, dtype=np.uint64)
    for i in range(ROWS):
        keys = _finish(keys * _MIX[0] ^ low[i::ROWS])
    return keys


def packed(low: np.ndarray) -> np.ndarray:
    """The low bits of the minima (of their well mixed upper half), 16 to a word."""
    bits = (low >> np.uint64(37)) & np.uint64((1 << BITS) - 1)
    return (bits.reshape(-1, 64 // BITS) << (np.arange(64 // BITS, dtype=np.uint64) * np.uint64(BITS))).sum(axis=1, dtype=np.uint64)


def estimate(a: Column, b: Column) -> Column:
    """Similarity from two packed signatures: equal fields, less those equal by chance."""

    def differ(x, y):
        z = x.bitwiseXOR(y)
        z = z.bitwiseOR(F.shiftrightunsigned(z, 1))
        z = z.bitwiseOR(F.shiftrightunsigned(z, 2))
        return F.bit_count(z.bitwiseAND(F.lit(NIBBLES)))

    unequal = F.aggregate(F.zip_with(a, b, differ), F.lit(0), lambda t, x: t + x)
    chance = 2.0**-BITS
    return (1 - unequal / HASHES - chance) / (1 - chance)


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, h, n_shingles, digest of the set, signature and band keys of each row."""

    def run(frames):
        import pandas as pd

        for f in frames:
            rows = []
            for t in f["text"]:
                found = shingles(t)
                if len(found):
                    low = minima(found)
                    rows.append((len(found), xxhash.xxh3_128_digest(found.tobytes()), packed(low).view(np.int64), band_keys(low).view(np.int64)))
                else:
                    rows.append((0, None, None, None))
            out = pd.DataFrame(rows, columns=["n", "digest", "sig", "bands"])
            out.insert(0, "doc_id", f["doc_id"].astype("Int64").to_numpy())
            out.insert(1, "h", f["h"])
            yield out

    with batch_rows(docs.sparkSession, 1000):
        rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("h"), "text")
        return stored(rows.mapInPandas(run, "doc_id long, h long, n long, digest binary, sig array<long>, bands array<long>"), "signatures")


def linked(inter: Column, a: Column, b: Column, percent: int) -> Column:
    return 100 * inter >= percent * (a + b - inter)


def _sets(docs: DataFrame, classes: DataFrame, wanted: DataFrame) -> DataFrame:
    """(cid, set) of the wanted classes, from the texts of their representatives."""
    rep = classes.join(wanted, "cid").select("cid", F.col("rep").alias("_doc"), F.col("rep_h").alias("_h"), "digest")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("h"), "text")
    known = rep.join(texts, F.col("_doc").eqNullSafe(F.col("doc_id")) & (F.col("_h") == F.col("h")))

    def run(frames):
        import pandas as pd

        for f in frames:
            rows = []
            for cid, digest, t in zip(f["cid"], f["digest"], f["text"], strict=True):
                found = shingles(t)
                if xxhash.xxh3_128_digest(found.tobytes()) == bytes(digest):  # texts may share a hash
                    rows.append((cid, found.view(np.int64)))
            yield pd.DataFrame(rows, columns=["cid", "set"])

    with batch_rows(docs.sparkSession, 500):
        return stored(known.select("cid", "digest", "text").mapInPandas(run, "cid long, set array<long>").dropDuplicates(["cid"]), "sets")


def _confirmed(pairs: DataFrame, classes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of pairs (a, b) that pass the estimate and then the full sets."""
    sig = classes.select("cid", "sig", "n")
    near = (
        pairs.join(sig.toDF("a", "sig_a", "n_a"), "a")
        .join(sig.toDF("b", "sig_b", "n_b"), "b")
        .where(linked(F.least("n_a", "n_b"), F.col("n_a"), F.col("n_b"), percent))
        .where(estimate(F.col("sig_a"), F.col("sig_b")) >= LEAST_ESTIMATE)
        .select("a", "b")
    )
    near = stored(near, "candidates")
    both = near.join(sets.toDF("b", "set_b"), "b").join(sets.toDF("a", "set_a"), "a")
    inter = F.size(F.array_intersect("set_a", "set_b"))
    return stored(both.where(linked(inter, F.size("set_a"), F.size("set_b"), percent)).select("a", "b"), "links")


class _Block:
    """The members of two blocks i and j of a bucket (or of one, i = j), as arrays."""

    def __init__(self, f, i: int, j: int):
        self.cid, self.component, self.n, self.block = (f[c].to_numpy() for c in ("cid", "component", "n", "block"))
        self.sig, self.before = np.vstack(f["sig"].to_numpy()).view(np.uint64), np.vstack(f["before"].to_numpy())
        self.i, self.j = i, j

    def candidates(self, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pairs of members of different components, without an earlier band in common, whose estimates pass: (x, y, estimate)."""
        chance = 2.0**-BITS
        left, right = np.flatnonzero(self.block == self.i), np.flatnonzero(self.block == self.j)
        out = []
        for x in left:
            y = right[right > x] if self.i == self.j else right
            y = y[(self.component[y] != self.component[x]) & (100 * np.minimum(self.n[y], self.n[x]) >= percent * np.maximum(self.n[y], self.n[x]))]
            if not len(y):
                continue
            z = self.sig[y] ^ self.sig[x]
            z |= z >> np.uint64(1)
            z |= z >> np.uint64(2)
            same = 1 - np.bitwise_count(z & np.uint64(NIBBLES)).sum(axis=1, dtype=np.int64) / HASHES
            near = (same - chance) / (1 - chance)
            ok = near >= LEAST_ESTIMATE
            y, near = y[ok], near[ok]
            fresh = ~(self.before[y] == self.before[x]).any(axis=1)
            if fresh.any():
                out.append((np.full(int(fresh.sum()), x), y[fresh], near[fresh]))
        return tuple(np.concatenate(a) for a in zip(*out, strict=True)) if out else (np.zeros(0, np.int64),) * 3

    def links(self, sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
        """A spanning forest of the candidates that pass on their full sets, the likeliest tried first."""
        parent = {int(c): int(c) for c in self.component}

        def root(c):
            while parent[c] != c:
                parent[c] = parent[parent[c]]
                c = parent[c]
            return c

        x, y, near = self.candidates(percent)
        out = []
        for k in np.argsort(-near, kind="stable").tolist():
            a, b = int(x[k]), int(y[k])
            u, v = root(int(self.component[a])), root(int(self.component[b]))
            if u == v:
                continue
            inter = len(np.intersect1d(sets[a], sets[b], assume_unique=True))
            if linked(inter, len(sets[a]), len(sets[b]), percent):
                parent[u] = v
                out.append((int(self.cid[a]), int(self.cid[b])))
        return out


def _by_block(rows: DataFrame, solve, schema: str) -> DataFrame:
    """solve(frame of a (key, i, j), i, j) -> rows, for groups that follow one another in sorted partitions."""
    keys = ["key", "i", "j"]

    def run(frames):
        import pandas as pd

        names = [c.split()[0] for c in schema.split(", ")]
        held = []

        def done(parts):
            f = pd.concat(parts, ignore_index=True) if len(parts) > 1 else parts[0].reset_index(drop=True)
            k = f[keys].to_numpy()
            cuts = [0, *(np.flatnonzero((k[1:] != k[:-1]).any(axis=1)) + 1).tolist(), len(f)]
            return pd.DataFrame([r for a, b in zip(cuts, cuts[1:], strict=False) for r in solve(f.iloc[a:b], int(k[a, 1]), int(k[a, 2]))], columns=names)

        for f in frames:
            if not len(f):
                continue
            k = f[keys].to_numpy()
            start = np.flatnonzero((k != k[-1]).any(axis=1))
            cut = int(start[-1]) + 1 if len(start) else 0  # the last group may go on in the next frame
            if held and (cut or (held[-1][keys].to_numpy()[-1] != k[-1]).any()):
                yield done([*held, f.iloc[:cut]] if cut else held)
                held = []
            elif cut:
                yield done([f.iloc[:cut]])
            held.append(f.iloc[cut:])
        if held:
            yield done(held)

    return rows.repartition(*keys).sortWithinPartitions(*keys, "cid").mapInPandas(run, schema)


def _found_inside(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between components of the same bucket, fewer in each block than it has members."""
    spark = members.sparkSession
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    rows = members.withColumn("block", F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int")).select("*", other)
    rows = rows.select("key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "cid", "component", "n", "sig", "before")
    schema = "key long, i int, j int, block int, cid long, component long, n long, sig array<long>, before array<long>"

    def touched(f, i, j):
        if f["component"].nunique() > 1:
            x, y, _ = _Block(f, i, j).candidates(percent)
            some = f.iloc[np.union1d(x, y)]
            yield from some.itertuples(index=False, name=None)

    def solve(f, i, j):
        yield from _Block(f, i, j).links([np.asarray(s) for s in f["set"]], percent)

    with batch_rows(spark, 2000):
        open_rows = stored(_by_block(rows, touched, schema), "open")
    with batch_rows(spark, 500):
        return stored(_by_block(open_rows.join(sets, "cid"), solve, "a long, b long").distinct(), "links")


def _mixed(buckets: DataFrame, parts: DataFrame, classes: DataFrame, most_bands: int) -> DataFrame:
    """Members, with component and signature, of the buckets that hold several components."""
    owned = buckets.join(parts.withColumnRenamed("node", "cid"), "cid", "left").withColumn("component", F.coalesce("component", "cid"))
    blocks = F.greatest(F.lit(1), F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("n") / BLOCK_SHINGLES)).cast("int")
    mixed = owned.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), blocks.alias("blocks")).where("lo <> hi").select("key", "blocks")
    # bands before the bucket's own, filled up with what no two members share
    before = F.transform(F.slice("bands", 1, most_bands), lambda x, k: F.when(k < F.col("band"), x).otherwise(F.col("cid")))
    return owned.drop("n").join(mixed, "key").join(classes.select("cid", "n", "sig", "bands"), "cid").select("key", "blocks", "cid", "component", "n", "sig", before.alias("before"))


def _joined(parts: DataFrame, links: DataFrame) -> DataFrame:
    return stored(components(parts.where("node <> component").toDF("a", "b").union(links)), "parts")


def groups(docs: DataFrame, percent: int = 75) -> DataFrame:
    """doc_id, h (hash of the text), n_shingles, component_id and kept of every row of docs (doc_id, text)."""
    signed = signatures(docs)
    has = signed.where("n > 0")
    classes = has.groupBy("digest").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h")).alias("r"), F.first("n").alias("n"), F.first("sig").alias("sig"), F.first("bands").alias("bands"))
    classes = classes.select("digest", F.col("r.doc_id").alias("rep"), F.col("r.h").alias("rep_h"), "n", "sig", "bands")
    classes = stored(classes.withColumn("cid", F.monotonically_increasing_id()), "classes")
    buckets = classes.select("cid", "n", F.posexplode("bands").alias("band", "key"))
    shared = buckets.groupBy("key").agg(F.count("*").alias("size"), F.min("cid").alias("hub")).where("size > 1").drop("size")
    buckets = stored(buckets.join(shared, "key"), "buckets")

    sets = _sets(docs, classes, buckets.select("cid").distinct())
    seen = buckets.where("cid <> hub").select(F.col("hub").alias("a"), F.col("cid").alias("b")).distinct()
    parts = stored(components(_confirmed(seen, classes, sets, percent)), "parts")
    for some, most in ((F.col("band") < FIRST_BANDS, FIRST_BANDS), (F.col("band") >= FIRST_BANDS, BANDS)):
        links = _found_inside(_mixed(buckets.where(some), parts, classes, most), sets, percent)
        if not links.isEmpty():
            parts = _joined(parts, links)

    named = classes.select("digest", "rep", F.col("cid").alias("node")).join(parts, "node", "left").withColumn("component", F.coalesce("component", "node"))
    smallest = named.groupBy("component").agg(F.min("rep").alias("component_id"))
    of_class = named.join(smallest, "component").select("digest", "component_id")
    joined = has.join(of_class, "digest").select("doc_id", "h", "n", "component_id").unionByName(signed.where("n = 0").select("doc_id", "h", "n", F.col("doc_id").alias("component_id")))
    return joined.select("doc_id", "h", F.col("n").alias("n_shingles"), "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
