"""Repeated passages by sorted suffixes: every byte inside a SPAN-byte string that starts elsewhere too.

Suffixes are taken at anchors that content alone chooses: of every ``window`` starts in
a row, the one whose 16 bytes hash lowest (the leftmost of equals).  Each span-byte
string has one canonical anchor, the lowest of its first ``window`` starts, at the same
offset in each of its copies; so comparing anchors' suffixes and what stands before
them finds all repeats.

An anchor is keyed by the hash of the head bytes that all its strings share, and by the
hash of all bytes that its strings cover (its extent).  Extents met twice (both 64-bit
hashes equal) are repeated whole; they and anchors whose head is unique need no bytes.
Only where a head has different extents are their bytes compared: deep-shallow sorting
(multikey quicksort to a shallow depth, blind tries for what ties there) orders the
suffixes and the reversed prefixes, and the common lengths of neighbours tell which
strings repeat; of two extents those lengths are taken at once.  Heads with more than
``most`` different extents are compared string by string in a shuffle instead.

Defined results: null and empty texts have no bytes, nothing removed and the digest of
no bytes; rows with equal doc_id are told apart by their text, and equal rows are copies
of each other; an empty table gives no rows; columns named as carried are kept unchanged,
others are ignored.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pyspark.sql.window import Window

from .common import batch_rows, boxed, discard, stored

SPAN, GRAM = 400, 16


def window_of(span: int) -> int:
    """Starts among which an anchor is chosen; also the bytes after the head that a string at offset 0 covers."""
    if not 2 * GRAM <= span <= 532:
        raise ValueError("spans have 32 to 532 bytes")
    return span * 12 // 25


# --- anchors ---------------------------------------------------------------------------


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the GRAM bytes at each position (zeros beyond the end)."""
    n = len(data)
    padded = np.concatenate([data, np.zeros(GRAM + 16, np.uint8)])
    words = np.empty(n + 8, np.uint64)
    for s in range(8):
        part = padded[s : s + (n + 7 - s) // 8 * 8 + 8]
        part = part[: len(part) // 8 * 8].view("<u8")
        into = words[s::8]
        into[:] = part[: len(into)]
    a, b = words[:n] * np.uint64(0x9E3779B97F4A7C15), words[8 : n + 8] * np.uint64(0xC2B2AE3D27D4EB4F)
    h = a ^ (b >> np.uint64(31)) ^ (b << np.uint64(33))
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def _window_min(values: np.ndarray, window: int) -> np.ndarray:
    """Minimum of values[i : i + window] for each full window, by block prefixes and suffixes."""
    n = len(values)
    blocks = -(-n // window)
    full = np.full(blocks * window, np.iinfo(np.uint64).max, np.uint64)
    full[:n] = values
    grid = full.reshape(blocks, window)
    before = np.minimum.accumulate(grid, axis=1).ravel()
    after = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    last = n - window + 1
    return np.minimum(after[:last], before[window - 1 : window - 1 + last])


def anchors(data: bytes, span: int = SPAN) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions, and the least and greatest offset of the strings whose canonical anchor each is."""
    n, window = len(data), window_of(span)
    if n < span:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty
    h = _gram_hashes(np.frombuffer(data, np.uint8))
    bits = max(1, int(n).bit_length())
    ranked = (h >> np.uint64(bits) << np.uint64(bits)) | np.arange(n, dtype=np.uint64)  # the leftmost of equals
    starts = n - span + 1
    canonical = (_window_min(ranked[: starts + window - 1], window) & np.uint64((1 << bits) - 1)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], canonical[1:] != canonical[:-1]]))
    last = np.concatenate([first[1:] - 1, [starts - 1]])
    at = canonical[first]
    return at, at - last, at - first


# --- deep-shallow sorting --------------------------------------------------------------


def common(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    differ = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return n - (differ.bit_length() + 7) // 8


class BlindTrie:
    """Branching depths and bytes only: a search skips what lies between, one comparison corrects it."""

    def __init__(self, strings: list[bytes]):
        self.strings, self.root = strings, None

    @staticmethod
    def _leaf(node):
        while isinstance(node, tuple):
            node = next(iter(node[1].values()))
        return node

    def insert(self, i: int) -> None:
        s = self.strings[i]
        if self.root is None:
            self.root = [i]
            return
        node = self.root
        while isinstance(node, tuple):  # blind: bytes at branching depths only
            depth, children = node
            c = s[depth] if depth < len(s) else -1
            node = children.get(c) or next(iter(children.values()))
        other = self.strings[self._leaf(node)[0]]
        lcp = common(s, other)
        if lcp == len(s) == len(other):
            node.append(i)
            return
        parent, edge, node = None, None, self.root
        while isinstance(node, tuple) and node[0] < lcp:
            parent, edge = node, s[node[0]]
            node = node[1][edge]
        c = s[lcp] if lcp < len(s) else -1
        if isinstance(node, tuple) and node[0] == lcp:
            node[1][c] = [i]
            return
        split = (lcp, {other[lcp] if lcp < len(other) else -1: node, c: [i]})
        if parent is None:
            self.root = split
        else:
            parent[1][edge] = split

    def ordered(self) -> tuple[list[int], list[int]]:
        """Indexes in order, and the common length of each with the one before."""
        order, lcps, stack = [], [], [(self.root, 0)]
        while stack:
            node, lcp = stack.pop()
            if isinstance(node, tuple):
                depth, children = node
                keys = sorted(children)
                stack += [(children[c], depth) for c in keys[:0:-1]]
                stack.append((children[keys[0]], lcp))
            else:
                order += node
                lcps += [lcp] + [len(self.strings[node[0]])] * (len(node) - 1)
        return order, lcps


def deep_shallow(strings: list[bytes], shallow: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """Order of strings and common lengths of neighbours (0 for the first).

    Multikey quicksort splits three ways, one byte deeper on the equal side, down to
    the shallow depth; groups that tie there are ordered by a blind trie.
    """
    order, lcps = [], []
    stack = [(list(range(len(strings))), 0)]
    while stack:
        group, depth = stack.pop()
        if len(group) > 1 and depth < shallow:
            byte = [strings[i][depth] if depth < len(strings[i]) else -1 for i in group]
            pivot = sorted((byte[0], byte[len(byte) // 2], byte[-1]))[1]
            parts = ([], [], [])
            for i, c in zip(group, byte, strict=True):
                parts[(c > pivot) - (c < pivot) + 1].append(i)
            if parts[2]:
                stack.append((parts[2], depth))
            stack.append((parts[1], shallow if pivot == -1 else depth + 1))
            if parts[0]:
                stack.append((parts[0], depth))
            continue
        if len(group) > 1:
            trie = BlindTrie(strings)
            for i in group:
                trie.insert(i)
            group, inner = trie.ordered()
        else:
            inner = [0]
        if group:
            inner[0] = common(strings[order[-1]], strings[group[0]]) if order else 0
            order += group
            lcps += inner
    return np.array(order, np.int64), np.array(lcps, np.int64)


def _common_lengths(order: np.ndarray, lcp: np.ndarray) -> np.ndarray:
    """Common lengths of all pairs of sorted strings: the least between neighbours."""
    m = len(order)
    out = np.full((m, m), np.iinfo(np.int64).max)
    for i in range(m - 1):
        out[order[i], order[i + 1 :]] = out[order[i + 1 :], order[i]] = np.minimum.accumulate(lcp[i + 1 :])
    return out


def repeated_offsets(left: list[bytes], right: list[bytes], low: list[int], high: list[int], tail: int, small: int = 64) -> list[list[tuple[int, int]]]:
    """For each member of a head: the runs (least, greatest) of its offsets at which another member has the same string.

    left: the bytes before the anchor; right: those after the head; low, high: offsets;
    tail: bytes after the head that a string at offset 0 covers.
    """
    m = len(left)
    if m == 2:
        a = max(low[0], low[1], tail - common(right[0], right[1]))
        b = min(high[0], high[1], common(left[0][::-1], left[1][::-1]))
        span = [(a, b)] if a <= b else []
        return [span, span]
    r_order, r_lcp = deep_shallow(right)
    l_order, l_lcp = deep_shallow([x[::-1] for x in left])
    lows, highs = np.array(low), np.array(high)
    if m <= small:  # a pair has one run of offsets in common
        a = np.maximum(np.maximum.outer(lows, lows), tail - _common_lengths(r_order, r_lcp))
        b = np.minimum(np.minimum.outer(highs, highs), _common_lengths(l_order, l_lcp))
        same = a <= b
        np.fill_diagonal(same, False)
        return [_joined(set(zip(a[i, same[i]].tolist(), b[i, same[i]].tolist(), strict=True))) for i in range(m)]
    out: list[list[tuple[int, int]]] = [[] for _ in range(m)]
    r_class, l_class = np.empty(m, np.int64), np.empty(m, np.int64)
    for o in range(int(lows.min()), int(highs.max()) + 1):
        has = np.flatnonzero((lows <= o) & (o <= highs))
        if len(has) > 1:
            r_class[r_order] = np.cumsum(r_lcp < tail - o)
            l_class[l_order] = np.cumsum(l_lcp < o)
            _, which, count = np.unique(r_class[has] * (m + 1) + l_class[has], return_inverse=True, return_counts=True)
            for i in has[count[which] > 1].tolist():
                if out[i] and out[i][-1][1] == o - 1:
                    out[i][-1] = (out[i][-1][0], o)
                else:
                    out[i].append((o, o))
    return out


def _joined(some) -> list[tuple[int, int]]:
    """Runs of whole numbers, those that touch or overlap as one."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(some):
        if out and a <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


# --- the Spark jobs --------------------------------------------------------------------


def _unplaced(place: int) -> tuple[int, int, int]:
    """Position, least and greatest offset (below 256 both) of an anchor."""
    return place >> 16, place >> 8 & 255, place & 255


def _keyed(docs: DataFrame, *more: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("h"), text.alias("text"), *more)


def _anchor_rows(rows: DataFrame, span: int) -> DataFrame:
    head = span - window_of(span)

    def run(frames):
        import pandas as pd

        digest = xxhash.xxh3_64_intdigest
        for f in frames:
            heads, extents, places, counts = [], [], [], []
            for text in f["text"]:
                data = text.encode()
                at, lo, hi = anchors(data, span)
                heads += [digest(data[p : p + head]) for p in at.tolist()]
                extents += [digest(data[a:b], s) for a, b, s in zip((at - hi).tolist(), (at - lo + span).tolist(), (lo * span + hi).tolist(), strict=True)]
                places.append(at << 16 | lo << 8 | hi)
                counts.append(len(at))
            each = np.repeat(np.arange(len(f)), counts)
            whole = lambda x: np.array(x, np.uint64).view(np.int64)
            yield pd.DataFrame({"head": whole(heads), "extent": whole(extents), "doc_id": f["doc_id"].astype("Int64").array[each], "h": f["h"].to_numpy()[each], "place": np.concatenate([np.zeros(0, np.int64), *places])})

    return rows.mapInPandas(run, "head long, extent long, doc_id long, h long, place long")


def _compared(partial: DataFrame, span: int) -> DataFrame:
    """doc_id, h, a, b of the repeats among extents of equal heads (rows hold their bytes)."""
    tail = window_of(span)

    def solve(members):
        """members: (doc_id, h, place, open, left, right); equal rows of documents stand there once."""
        places = [_unplaced(x[2]) for x in members]
        found = repeated_offsets([x[4] for x in members], [x[5] for x in members], [p[1] for p in places], [p[2] for p in places], tail)
        for (doc_id, h, _, is_open, _, _), (at, _, _), offsets in zip(members, places, found, strict=True):
            if is_open:
                for lo, hi in offsets:
                    yield doc_id, h, at - hi, at - lo + span

    def run(frames):
        import pandas as pd

        frame = lambda rows: pd.DataFrame(rows, columns=["doc_id", "h", "a", "b"]).astype({"doc_id": "Int64"})
        now, members = None, {}
        for f in frames:
            out = []
            doc_ids = [None if x is None or x != x else int(x) for x in f["doc_id"].astype(object).where(f["doc_id"].notna(), None)]
            for head, doc_id, *rest in zip(f["head"].tolist(), doc_ids, f["h"].tolist(), f["place"].tolist(), f["open"].tolist(), f["left"], f["right"], strict=True):
                if head != now:
                    if len(members) > 1:
                        out += solve(list(members.values()))
                    now, members = head, {}
                members[doc_id, rest[0], rest[1]] = (doc_id, *rest)
            yield frame(out)
        if len(members) > 1:
            yield frame(list(solve(list(members.values()))))

    return partial.repartition("head").sortWithinPartitions("head").mapInPandas(run, "doc_id long, h long, a int, b int")


def _compared_by_string(partial: DataFrame, span: int) -> DataFrame:
    """The same for heads with very many extents: each string is a row, counted in a shuffle."""
    tail = window_of(span)

    def run(frames):
        import pandas as pd

        for f in frames:
            out = []
            for r in f.itertuples(index=False):
                at, lo, hi = _unplaced(r.place)
                for o in range(lo, hi + 1):
                    out.append((r.head, o, xxhash.xxh3_64_intdigest(r.left[len(r.left) - o :] + r.right[: tail - o]), r.doc_id, r.h, at - o))
            o = pd.DataFrame(out, columns=["head", "o", "string", "doc_id", "h", "a"])
            yield o.astype({"string": "uint64"}).astype({"string": "int64", "doc_id": "Int64"})

    with batch_rows(partial.sparkSession, 500):
        once = partial.dropDuplicates(["head", "doc_id", "h", "place"])
        each = stored(once.mapInPandas(run, "head long, o int, string long, doc_id long, h long, a int"), "strings")
    twice = each.groupBy("head", "o", "string").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    return each.join(twice, ["head", "o", "string"], "left_semi").select("doc_id", "h", "a", (F.col("a") + span).alias("b"))


def repeats(docs: DataFrame, most: int = 4096, span: int = SPAN) -> DataFrame:
    """doc_id, h (hash of the text) and the spans [a, b) to remove, not merged yet, as a stored table."""
    spark, rows, head = docs.sparkSession, _keyed(docs), span - window_of(span)
    with batch_rows(spark, 1000):
        found = stored(_anchor_rows(rows, span), "anchors")
    # most heads are unique: only the others go on
    again = found.groupBy("head").agg(F.count("*").alias("n")).where("n > 1").select("head")
    shared = stored(found.join(again, "head", "left_semi"), "shared")
    discard(found)
    extents = shared.groupBy("head", "extent").agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "h", "place")).alias("one"))
    extents = stored(extents, "extents")
    full = shared.join(extents.where("n > 1").select("head", "extent"), ["head", "extent"], "left_semi").selectExpr(
        "doc_id", "h", "int(shiftright(place, 16) - (place & 255)) AS a", f"int(shiftright(place, 16) - (shiftright(place, 8) & 255) + {span}) AS b"
    )
    # one anchor stands for each extent; what full extents repeat is known, they are partners here
    heads = extents.groupBy("head").agg(F.count("*").alias("kinds"), F.count_if(F.col("n") == 1).alias("opens")).where("kinds > 1 AND opens > 0").drop("opens")
    wanted = extents.join(heads, "head").select("head", "kinds", (F.col("n") == 1).alias("open"), "one.*")
    of_row = wanted.groupBy(F.col("doc_id").alias("d"), F.col("h").alias("e")).agg(F.collect_list(F.struct("head", "kinds", "open", "place")).alias("anchors"))

    def cut(frames):
        import pandas as pd

        for f in frames:
            out = []
            for doc_id, h, text, some in zip(f["doc_id"], f["h"], f["text"], f["anchors"], strict=True):
                data = text.encode()
                for x in some:
                    p, lo, hi = _unplaced(x["place"])
                    out.append((x["head"], x["kinds"], x["open"], doc_id, h, x["place"], data[p - hi : p], data[p + head : p - lo + span]))
            yield pd.DataFrame(out, columns=["head", "kinds", "open", "doc_id", "h", "place", "left", "right"]).astype({"doc_id": "Int64"})

    texts = of_row.join(rows, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("h") == F.col("e"))).select("doc_id", "h", "text", "anchors")
    with batch_rows(spark, 500):
        partial = stored(texts.mapInPandas(cut, "head long, kinds long, open boolean, doc_id long, h long, place long, left binary, right binary"), "partial")
    with batch_rows(spark, 5000):
        some = stored(_compared(partial.where(F.col("kinds") <= most), span), "compared")
    many = partial.where(F.col("kinds") > most)
    spans = full.unionByName(some)
    if not many.isEmpty():
        spans = spans.unionByName(_compared_by_string(many, span))
    spans = stored(spans, "spans")
    discard(shared, extents, partial, some)
    return spans


def merged(spans: DataFrame) -> DataFrame:
    """d, e and the maximal runs [a, b) of each text's spans, in order."""
    order = Window.partitionBy("doc_id", "h").orderBy("a", "b")
    before = F.max("b").over(order.rowsBetween(Window.unboundedPreceding, -1))
    runs = spans.groupBy("doc_id", "h", "a").agg(F.max("b").alias("b")).withColumn("_new", F.coalesce((F.col("a") > before).cast("int"), F.lit(0)))
    runs = runs.withColumn("_run", F.sum("_new").over(order)).groupBy("doc_id", "h", "_run").agg(F.min("a").alias("a"), F.max("b").alias("b"))
    return runs.groupBy(F.col("doc_id").alias("d"), F.col("h").alias("e")).agg(F.sort_array(F.collect_list(F.struct("a", "b"))).alias("spans"))


def remove(docs: DataFrame, most: int = 4096, more: tuple[str, ...] = (), span: int = SPAN, beside: DataFrame | None = None) -> DataFrame:
    """doc_id, kept (the remaining bytes), n_bytes, n_removed, n_spans and the columns ``more`` of every row of docs.

    beside: counts of texts by d and e (doc_id and hash), which follow; 0 for texts that it lacks.
    """
    carried, box = boxed(docs, [c for c in docs.columns if c not in ("doc_id", "text")])
    rows = _keyed(carried, box)
    joined = rows.join(merged(repeats(docs, most, span)), F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("h") == F.col("e")), "left")
    counts = [] if beside is None else [c for c in beside.columns if c not in ("d", "e")]
    if counts:
        beside = beside.withColumnsRenamed({"d": "_d", "e": "_e"})
        joined = joined.join(beside, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("h") == F.col("_e")), "left")
    data, n, spans = F.col("text").cast("binary"), F.octet_length("text"), F.col("spans")

    def gap(i):
        start = F.when(i > 0, F.try_element_at(spans, F.greatest(i, F.lit(1)))["b"]).otherwise(F.lit(0))
        end = F.when(i < F.size(spans), F.try_element_at(spans, i + 1)["a"]).otherwise(n)
        return F.substring(data, start + 1, end - start)

    gaps = F.transform(F.sequence(F.lit(0), F.size(spans)), gap)
    kept = F.when(spans.isNull(), data).otherwise(F.aggregate(gaps, F.lit(b""), lambda a, x: F.concat(a, x)))
    removed = F.aggregate(F.coalesce(spans, F.array().cast("array<struct<a:int,b:int>>")), F.lit(0), lambda t, x: t + x["b"] - x["a"])
    return joined.select(
        "doc_id", kept.alias("kept"), n.cast("long").alias("n_bytes"), removed.cast("long").alias("n_removed"), F.when(spans.isNull(), 0).otherwise(F.size(spans)).cast("long").alias("n_spans"),
        *[F.col(box)[c].alias(c) for c in more], *[F.coalesce(c, F.lit(0)).alias(c) for c in counts],
    )
