"""Passages of more than 50 words that stand in another row too, whatever their length in bytes.

The anchors of suffixes.py in words: of every ``window_of(words)`` words in a row, the
one at which 16 bytes hash lowest, so each run of ``words`` words has one canonical
anchor, at the same offset in each of its copies.  An anchor is keyed by the hash of the
words that all its runs share (head) and of all words that they cover (extent).  Extents
met in two rows are shared whole; only where a head has other extents are their runs
compared one by one, by hashes.  Heads and extents met more than HOT times are joined by
broadcast, so no task gets all of one.

Words are runs of anything but ASCII white space; which white space stands between them
does not count.  Null and empty texts have none; rows with equal doc_id are told apart by
their text, and equal rows are copies of each other.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batch_rows, discard, stored
from .suffixes import GRAM, _gram_hashes, _keyed, _unplaced, _window_min, merged

WORDS, HOT = 51, 4096


def window_of(words: int) -> int:
    """Words among which an anchor is chosen; the bytes hashed at each lie within the run."""
    window = words * 7 // 10
    if not GRAM // 2 <= words - window or window > 255:
        raise ValueError("passages have 26 to 365 words")
    return window


class Words:
    """The words of a text with one space between them, and where each starts and ends."""

    def __init__(self, text: str):
        self.data = b" ".join(text.encode().split())
        spaces = np.flatnonzero(np.frombuffer(self.data, np.uint8) == 32)
        self.starts, self.ends = np.concatenate([[0], spaces + 1]), np.concatenate([spaces, [len(self.data)]])

    def digests(self, first, last, seeds) -> list[int]:
        """Hashes of words first to last, both included."""
        data, digest = self.data, xxhash.xxh3_64_intdigest
        return [digest(data[a:b], s) for a, b, s in zip(self.starts[first].tolist(), self.ends[last].tolist(), seeds, strict=True)]

    def anchors(self, words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Word numbers, and the least and greatest offset of the runs whose canonical anchor each is."""
        n, window = len(self.starts), window_of(words)
        if n < words:
            empty = np.zeros(0, np.int64)
            return empty, empty, empty
        h = _gram_hashes(np.frombuffer(self.data, np.uint8))[self.starts]
        bits = int(n).bit_length()
        ranked = (h >> np.uint64(bits) << np.uint64(bits)) | np.arange(n, dtype=np.uint64)  # the leftmost of equals
        runs = n - words + 1
        canonical = (_window_min(ranked[: runs + window - 1], window) & np.uint64((1 << bits) - 1)).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], canonical[1:] != canonical[:-1]]))
        last = np.concatenate([first[1:] - 1, [runs - 1]])
        at = canonical[first]
        return at, at - last, at - first


def _signed(hashes) -> np.ndarray:
    return np.array(hashes, np.uint64).view(np.int64)


def _anchor_rows(rows: DataFrame, words: int) -> DataFrame:
    head = words - window_of(words) + 1

    def run(frames):
        import pandas as pd

        for f in frames:
            heads, extents, places, counts = [], [], [], []
            for text in f["text"]:
                t = Words(text)
                at, lo, hi = t.anchors(words)
                heads += t.digests(at, at + head - 1, [0] * len(at))
                extents += t.digests(at - hi, at - lo + words - 1, (lo * words + hi).tolist())
                places.append(at << 16 | lo << 8 | hi)
                counts.append(len(at))
            each = np.repeat(np.arange(len(f)), counts)
            yield pd.DataFrame({"head": _signed(heads), "extent": _signed(extents), "row": f["row"].to_numpy()[each], "doc_id": f["doc_id"].astype("Int64").array[each], "h": f["h"].to_numpy()[each], "place": np.concatenate([np.zeros(0, np.int64), *places])})

    return rows.mapInPandas(run, "head long, extent long, row long, doc_id long, h long, place long")


def _parted(rows: DataFrame, keys: DataFrame, on: list[str]) -> tuple[DataFrame, DataFrame]:
    """The rows with keys met more than HOT times (column n of keys), and all others."""
    hot = F.broadcast(keys.where(F.col("n") > HOT).select(*on))
    return rows.join(hot, on, "left_semi"), rows.join(hot, on, "left_anti")


def _run_rows(texts: DataFrame, words: int) -> DataFrame:
    """The hashes of all runs of the anchors asked for, from the greatest offset down."""

    def run(frames):
        import pandas as pd

        for f in frames:
            out = []
            for text, some in zip(f["text"], f["anchors"], strict=True):
                t = Words(text)
                for x in some:
                    at, lo, hi = _unplaced(x["place"])
                    first = np.arange(at - hi, at - lo + 1)
                    runs = _signed(t.digests(first, first + words - 1, [0] * len(first)))
                    out.append((x["head"], x["extent"], x["kinds"], x["least"], x["most"], lo, hi, runs))
            yield pd.DataFrame(out, columns=["head", "extent", "kinds", "least", "most", "lo", "hi", "runs"])

    return texts.mapInPandas(run, "head long, extent long, kinds long, least long, most long, lo int, hi int, runs array<long>")


def _compared(partial: DataFrame) -> DataFrame:
    """head, extent, o: offsets at which an extent of one row has a run that another row has too."""

    def solve(f):
        import pandas as pd

        size = f["runs"].map(len).to_numpy(np.int64)
        each = np.repeat(np.arange(len(f)), size)
        o = f["hi"].to_numpy(np.int64)[each] - (np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size))
        runs = np.concatenate(f["runs"].tolist())
        order = np.argsort(runs, kind="stable")
        new = np.flatnonzero(np.concatenate([[True], runs[order][1:] != runs[order][:-1]]))
        least, most = (x[each][order] for x in (f["least"].to_numpy(np.int64), f["most"].to_numpy(np.int64)))
        both = np.minimum.reduceat(least, new) != np.maximum.reduceat(most, new)
        shared = np.zeros(len(runs), bool)
        shared[order] = np.repeat(both, np.diff(np.append(new, len(runs))))
        shared &= (f["least"] == f["most"]).to_numpy()[each]
        return pd.DataFrame({"head": f["head"].to_numpy(np.int64)[each[shared]], "extent": f["extent"].to_numpy(np.int64)[each[shared]], "o": o[shared].astype(np.int32)})

    def run(frames):
        import pandas as pd

        rest = None  # the last head's rows: the next batch may hold more of it
        for f in frames:
            f = (f if rest is None else pd.concat([rest, f])).drop_duplicates(["head", "extent"], ignore_index=True)  # equal rows give the same
            ended = (f["head"] != f["head"].iloc[-1]).to_numpy() if len(f) else np.zeros(0, bool)
            if ended.any():
                yield solve(f[ended])
            rest = f[~ended]
        if rest is not None and len(rest):
            yield solve(rest)

    return partial.drop("kinds").repartition("head").sortWithinPartitions("head").mapInPandas(run, "head long, extent long, o int")


def _compared_by_run(partial: DataFrame) -> DataFrame:
    """The same for heads with very many extents: each run is a row, counted in a shuffle."""
    each = partial.dropDuplicates(["head", "extent"]).select("head", "extent", "least", "most", "hi", F.posexplode("runs").alias("i", "run"))
    both = each.groupBy("head", "run").agg(F.count("*").alias("n"), F.min("least").alias("a"), F.max("most").alias("z")).where("a <> z")
    both = stored(both.select("head", "run", "n"), "runs")
    hot, others = _parted(each.where("least = most"), both, ["head", "run"])
    return hot.unionByName(others.join(both, ["head", "run"], "left_semi")).selectExpr("head", "extent", "hi - i AS o")


def shared_words(docs: DataFrame, words: int = WORDS, most: int = 4096) -> DataFrame:
    """d, e (doc_id and hash of the text) and n_shared_words, for each text with passages of that many words that another row has."""
    spark, rows = docs.sparkSession, _keyed(docs)
    with batch_rows(spark, 1000):
        found = stored(_anchor_rows(rows.withColumn("row", F.monotonically_increasing_id()), words), "words")
    # most heads stand in one row: only the others go on
    again = found.groupBy("head").agg(F.count("*").alias("n"), F.min("row").alias("a"), F.max("row").alias("z")).where("a <> z")
    again = stored(again.select("head", "n"), "heads")
    hot, others = _parted(found, again, ["head"])
    shared = stored(hot.unionByName(others.join(again, "head", "left_semi")), "shared")
    discard(found, again)
    key = ["head", "extent"]
    extents = shared.groupBy(*key).agg(F.count("*").alias("n"), F.min("row").alias("least"), F.max("row").alias("most"), F.min(F.struct("doc_id", "h", "place")).alias("one"))
    extents = stored(extents, "extents")
    both = extents.where("least <> most").select(*key, "n")
    hot, others = _parted(shared.drop("row"), both, key)
    at, lo, hi = "shiftright(place, 16)", "(shiftright(place, 8) & 255)", "(place & 255)"
    full = hot.unionByName(others.join(both, key, "left_semi")).selectExpr("doc_id", "h", f"int({at} - {hi}) AS a", f"int({at} - {lo} + {words}) AS b")
    # one anchor stands for each extent; those of one row are compared with all others of their head
    heads = extents.groupBy("head").agg(F.count("*").alias("kinds"), F.count_if(F.col("least") == F.col("most")).alias("opens")).where("kinds > 1 AND opens > 0").drop("opens")
    wanted = extents.join(heads, "head").select("head", "extent", "kinds", "least", "most", "one.*")
    of_row = wanted.groupBy(F.col("doc_id").alias("d"), F.col("h").alias("e")).agg(F.collect_list(F.struct("head", "extent", "kinds", "least", "most", "place")).alias("anchors"))
    texts = of_row.join(rows, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("h") == F.col("e"))).select("text", "anchors")
    with batch_rows(spark, 500):
        partial = stored(_run_rows(texts, words), "partial")
    with batch_rows(spark, 5000):
        some = stored(_compared(partial.where(F.col("kinds") <= most)), "compared")
    many, offsets = partial.where(F.col("kinds") > most), some
    if not many.isEmpty():
        offsets = offsets.unionByName(_compared_by_run(many))
    parts = others.join(offsets, key).selectExpr("doc_id", "h", f"int({at} - o) AS a", f"int({at} - o + {words}) AS b")
    spans = stored(full.unionByName(parts), "spans")
    discard(shared, extents, partial, some)
    return merged(spans).select("d", "e", F.aggregate("spans", F.lit(0), lambda n, x: n + x["b"] - x["a"]).cast("long").alias("n_shared_words"))
