"""Fuzzy joins of texts with templates and labels."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType
from pyspark.sql.window import Window

from threadline.work import kept


def closest_by_edits(names: DataFrame, known: DataFrame, least: float = 0.5) -> DataFrame:
    """The closest known sub-topic of the same topic by edit distance over the longer length."""
    pairs = names.join(known.select("topic", F.col("sub_topic").alias("known")), "topic")
    longest = F.greatest(F.length("sub_topic"), F.length("known"))
    pairs = pairs.where(F.least(F.length("sub_topic"), F.length("known")) >= least * longest)
    pairs = pairs.withColumn("similarity", 1 - F.levenshtein("sub_topic", "known") / longest).where(F.col("similarity") >= least)
    best = Window.partitionBy("topic", "sub_topic").orderBy(F.desc("similarity"), "known")
    return pairs.withColumn("_n", F.row_number().over(best)).where("_n = 1").drop("_n")


@F.pandas_udf(DoubleType())
def similarity_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """2M/T of matching blocks, as difflib finds them (not symmetric)."""
    from difflib import SequenceMatcher

    matcher = SequenceMatcher(None)
    out = []
    for x, y in zip(a, b, strict=True):
        matcher.set_seqs(x, y)
        out.append(matcher.ratio())
    return pd.Series(out, dtype="float64")


def _shared_characters(a, b):
    """Characters that two texts have in common, counted as in multisets."""
    counts = lambda c: F.map_from_entries(F.transform(F.array_distinct(F.split(c, "")), lambda x: F.struct(x, F.length(c) - F.length(F.replace(c, x, F.lit(""))))))
    return F.aggregate(F.map_entries(counts(a)), F.lit(0), lambda t, e: t + F.least(e["value"], F.coalesce(F.try_element_at(counts(b), e["key"]), F.lit(0))))


def closest(names: DataFrame, known: DataFrame, least: float = 0.5) -> DataFrame:
    """names (topic, sub_topic) with the closest known sub-topic of their topic by similarity ratio; ties go to the smaller slug.

    Distinct slugs only; pairs are compared where their lengths and then their characters allow the ratio.
    """
    left, right = names.select("topic", "sub_topic").distinct(), known.select("topic", F.col("sub_topic").alias("known")).distinct()
    pairs = left.join(right, "topic").where(ratio_upper_bound(F.col("sub_topic"), F.col("known")) >= least)
    pairs = pairs.where(2 * _shared_characters(F.col("sub_topic"), F.col("known")) >= least * (F.length("sub_topic") + F.length("known")))
    rated = pairs.withColumn("similarity", similarity_ratio(F.col("sub_topic"), F.col("known"))).where(F.col("similarity") >= least)
    best = Window.partitionBy("topic", "sub_topic").orderBy(F.desc("similarity"), "known")
    return rated.withColumn("_n", F.row_number().over(best)).where("_n = 1").drop("_n")


def is_variant(a, b):
    """One slug is the other with a prefix or suffix of whole tokens, or they share most tokens."""
    ends = lambda x, y: x.startswith(F.concat(y, F.lit("_"))) | x.endswith(F.concat(F.lit("_"), y))
    return ends(a, b) | b.startswith(F.concat(a, F.lit("_"))) | (token_overlap(a, b) >= 0.7)


def validated(rows: DataFrame, known: DataFrame, truth: DataFrame) -> DataFrame:
    """rows (user_id, topic, sub_topic) with ``valid`` and ``how``: known, kept, or mapped to the closest sub-topic.

    It is mapped when it is a variant of the closest one, or shares two tokens with it and
    the user's true labels (user_id, sub_topic) hold that one.
    """
    has = known.select("topic", "sub_topic").distinct().withColumn("_known", F.lit(True))
    names = rows.select("topic", "sub_topic").distinct()
    near = closest(names.join(has, ["topic", "sub_topic"], "left_anti"), known).select("topic", "sub_topic", F.col("known").alias("_near"))
    true = truth.select("user_id", F.col("sub_topic").alias("_near")).distinct().withColumn("_true", F.lit(True))
    joined = rows.join(has, ["topic", "sub_topic"], "left").join(near, ["topic", "sub_topic"], "left").join(true, ["user_id", "_near"], "left")
    shared = F.size(F.array_intersect(F.array_distinct(F.split("sub_topic", "_")), F.array_distinct(F.split("_near", "_"))))
    how = (
        F.when(F.col("_known"), "known").when(F.col("_near").isNull(), "kept").when(is_variant(F.col("sub_topic"), F.col("_near")), "variant").when((shared >= 2) & F.col("_true"), "truth").otherwise("kept")
    )
    return joined.withColumn("how", how).withColumn("valid", F.when(F.col("how").isin("variant", "truth"), F.col("_near")).otherwise(F.col("sub_topic"))).select(*rows.columns, "valid", "how")


def token_overlap(a, b):
    """Shared slug tokens over the smaller token set."""
    x, y = F.array_distinct(F.split(a, "_")), F.array_distinct(F.split(b, "_"))
    return F.size(F.array_intersect(x, y)) / F.least(F.size(x), F.size(y))


def ratio_upper_bound(a, b):
    """No similarity ratio 2M/T can exceed twice the shorter length over both lengths."""
    return 2 * F.least(F.length(a), F.length(b)) / (F.length(a) + F.length(b))


#: Length of the grams, and bits of their buckets: few for products of whole tables, many for single pairs.
GRAM, COARSE, FINE = 4, 13, 20


def _features(text: str) -> np.ndarray:
    """Buckets of the character 4-grams of a text, each with its occurrence number, so that shared ones count as in multisets."""
    x = np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.uint64)
    n = max(0, len(x) - GRAM + 1)
    h = np.zeros(n, np.uint64)
    for i in range(GRAM):
        h = h * np.uint64(0x9E3779B97F4A7C15) + x[i : i + n] + np.uint64(1)
    h.sort()
    at = np.arange(n)
    first = np.maximum.accumulate(np.where(np.r_[True, h[1:] != h[:-1]], at, 0)) if n else at
    return (((h + (at - first).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)) * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - FINE)).astype(np.int32)


def _dense(features: list) -> np.ndarray:
    return np.stack([np.bincount(f >> (FINE - COARSE), minlength=1 << COARSE).astype(np.float32) for f in features])


def _most_blocks(template: str) -> float:
    """Matching blocks that difflib can find with this second text: from 200 characters on a block
    holds a character that is not popular there, except one at the start of both texts."""
    if len(template) < 200:
        return np.inf
    return 1 + sum(n for n in Counter(template).values() if n <= len(template) // 100 + 1)


def _common(texts: list[str]):
    """A function that gives the lengths of the longest common subsequences of a text with all of texts (bit-parallel, all at once)."""
    rooms = [len(t) // 8 + 1 for t in texts]  # bytes; at least one clear bit takes the carry
    starts = 8 * np.r_[0, np.cumsum(rooms)].astype(np.int64)
    chars = np.zeros(starts[-1], "<u4")
    for t, at in zip(texts, starts, strict=False):
        chars[at : at + len(t)] = np.frombuffer(t.encode("utf-32-le"), "<u4") + 1
    pack = lambda bits: int.from_bytes(np.packbits(bits, bitorder="little").tobytes(), "little")
    every, masks, lengths = pack(chars > 0), {}, np.array([len(t) for t in texts])

    def of(text: str) -> np.ndarray:
        v = every
        for c in text:
            if (m := masks.get(c)) is None:
                m = masks[c] = pack(chars == ord(c) + 1)
            u = v & m
            if u:
                v = ((v + u) | (v - u)) & every
        ones = np.unpackbits(np.frombuffer(v.to_bytes(int(starts[-1]) // 8, "little"), np.uint8), bitorder="little")
        return lengths - np.add.reduceat(ones, starts[:-1], dtype=np.int64)

    return of


def best_matches(messages: list[str], templates: list[tuple], least: float) -> dict:
    """{place of a message: (ratio, template_id)} of the best pairs that reach ``least``, by exact ratios 2M/T of whole texts.

    A pair is left out only where 2M/T can't reach ``least``: M needs ``need`` characters in at most
    ``blocks`` blocks, a block of m characters shares m - 3 of its 4-grams, and hashing only adds to the
    shared ones.  Templates below 200 characters, whose blocks aren't bounded, are held against the
    longest common subsequence.
    """
    from difflib import SequenceMatcher

    places = sorted((i for i, m in enumerate(messages)), key=lambda i: len(messages[i]))
    sizes = np.array([len(messages[i]) for i in places])
    features, seen = {}, np.zeros(1 << FINE, bool)
    best: dict = {}
    low, high = least / (2 - least) - 1e-9, (2 - least) / least + 1e-9
    for short in (True, False):
        some = sorted((t for t in templates if (len(t[1]) < 200) == short), key=lambda t: len(t[1]))
        for c in range(0, len(some), 1000):
            part = some[c : c + 1000]
            n = np.array([len(t) for _, t in part])
            blocks = np.array([_most_blocks(t) for _, t in part])
            common, own = (_common([t for _, t in part]), []) if short else (None, [_features(t) for _, t in part])
            right = None if short else _dense(own)
            a, z = np.searchsorted(sizes, low * n[0]), np.searchsorted(sizes, high * n[-1], "right")
            pairs = []
            for s in range(a, z, 500):
                rows = np.arange(s, min(z, s + 500))
                total = sizes[rows][:, None] + n[None, :]
                need = np.ceil(least * total / 2 - 1e-9)
                ok = np.minimum(sizes[rows][:, None], n[None, :]) >= need
                if short:
                    for k, row in enumerate(rows):
                        if ok[k].any():
                            ok[k] &= common(messages[places[row]]) >= need[k]
                else:
                    for row in rows:
                        if row not in features:
                            features[row] = _features(messages[places[row]])
                    shared = _dense([features[row] for row in rows]) @ right.T
                    enough = need - (GRAM - 1) * np.minimum(blocks[None, :], total - 2 * need + 1)
                    ok &= shared >= enough - 0.5
                    for k in np.nonzero(ok.any(axis=1))[0]:
                        seen[features[rows[k]]] = True
                        for j in np.nonzero(ok[k])[0]:
                            ok[k, j] = np.count_nonzero(seen[own[j]]) >= enough[k, j]
                        seen[features[rows[k]]] = False
                pairs += [(j, rows[k]) for k, j in zip(*np.nonzero(ok), strict=True)]
            matcher, now = SequenceMatcher(None), None
            for j, row in sorted(pairs):
                if j != now:  # the matcher keeps what it knows of its second text
                    matcher.set_seq2(part[j][1])
                    now = j
                matcher.set_seq1(messages[places[row]])
                enough = max(least, best[places[row]][0]) if places[row] in best else least
                if matcher.real_quick_ratio() >= enough and matcher.quick_ratio() >= enough and (r := matcher.ratio()) >= least:
                    new = (r, part[j][0])
                    old = best.get(places[row])
                    if old is None or (-new[0], new[1]) < (-old[0], old[1]):
                        best[places[row]] = new
    return best


#: Most characters of a block of texts, and least number of blocks of a band's messages, for tasks enough.
BLOCK_CHARS, BLOCKS = 8_000_000, 8


def _block_matches(texts: DataFrame, known: DataFrame, least: float, block: int) -> DataFrame:
    """message, template_id, ratio of the best pairs of each two blocks of texts within a length band.

    A text is shuffled once for each block of the other side in its band, so blocks are as large as a task holds easily.
    """
    # lengths that can reach the ratio differ by a factor of at most (2 - least) / least: neighbours on a log scale
    step = F.log(F.lit((2 - least) / least)) + 1e-9
    band = lambda c: F.floor(F.log(F.length(c).cast("double")) / step)
    left = texts.select("message", F.explode(F.array(*[band("message") + d for d in (-1, 0, 1)])).alias("band"))
    right = known.select("template_id", "template", band("template").alias("band"))

    def sized(rows, c, n, fewest):
        each = rows.groupBy("band").agg(F.count("*").alias("k"), F.sum(F.length(c).cast("long")).alias("chars"))
        blocks = F.greatest(F.ceil(F.col("k") / block), F.ceil(F.col("chars") / BLOCK_CHARS), F.least("k", F.lit(fewest)))
        return each.select("band", blocks.cast("int").alias(n))

    # a row per band, and the bands grow with the logarithm of the longest text
    sizes = F.broadcast(kept(sized(left, "message", "n_m", BLOCKS).join(sized(right, "template", "n_t", 1), "band")))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    own = lambda c, n: F.pmod(F.xxhash64(c), F.col(n)).cast("int")
    left = left.join(sizes, "band").select("message", "band", own("message", "n_m").alias("m"), every("n_t").alias("t"))
    right = right.join(sizes, "band").select("template_id", "template", "band", own("template", "n_t").alias("t"), every("n_m").alias("m"))

    def found(a, b):
        best = best_matches(a["message"].tolist(), list(zip(b["template_id"].tolist(), b["template"].tolist(), strict=True)), least) if len(a) and len(b) else {}
        rows = [(a["message"].iloc[i], t, r) for i, (r, t) in best.items()]
        return pd.DataFrame(rows, columns=["message", "template_id", "ratio"])

    keys = ["band", "m", "t"]
    kind = known.schema["template_id"].dataType.simpleString()
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(found, f"message string, template_id {kind}, ratio double")


#: The index: length of its grams, templates with at most so many blocks per character, and how many rare grams a pair must share.
INDEX_GRAM, INDEX_BLOCKS, INDEX_SHARED, INDEX_BUCKETS = 5, 0.08, 8, 1 << 16

#: Rows per posting up to which the postings are joined, and the share of the grams (one in so many) by which these are foretold.
JOINED_ROWS, FORETOLD_BY = 4, 64


def _grams(text: str) -> np.ndarray:
    x = np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.uint64)
    n = max(0, len(x) - INDEX_GRAM + 1)
    h = np.zeros(n, np.uint64)
    for i in range(INDEX_GRAM):
        h = h * np.uint64(0x9E3779B97F4A7C15) + x[i : i + n] + np.uint64(1)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def _gram_counts(texts: DataFrame) -> np.ndarray:
    """In how many texts (of all) a bucket of grams occurs: a table of fixed size."""

    def count(frames):
        total = np.zeros(INDEX_BUCKETS, np.int64)
        for f in frames:
            for text in f["text"]:
                total[np.unique(_grams(text) % np.uint64(INDEX_BUCKETS)).astype(np.int64)] += 1
        at = np.flatnonzero(total)
        yield pd.DataFrame({"bucket": at, "n": total[at]})

    out = np.zeros(INDEX_BUCKETS, np.int64)
    for r in texts.select("text").mapInPandas(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def _rarest(text: str, shared: float, counts: np.ndarray):
    """(gram with its occurrence number, position or -1 for grams that repeat) of the rarest grams,
    so many that of ``shared`` ones in common with another text the first INDEX_SHARED are among them, and that number."""
    h = _grams(text)
    need = int(np.ceil(shared - 1e-9))
    wanted = max(1, min(INDEX_SHARED, need))
    by_value = np.argsort(h, kind="stable")
    ordered = h[by_value]
    at = np.arange(len(h))
    start = np.r_[True, ordered[1:] != ordered[:-1]]
    first = np.maximum.accumulate(np.where(start, at, 0))
    single = start & np.r_[start[1:], True]
    occurrence = np.empty(len(h), np.uint64)
    occurrence[by_value] = (at - first).astype(np.uint64)
    unique = np.empty(len(h), bool)
    unique[by_value] = single
    keys = h + occurrence * np.uint64(0xC2B2AE3D27D4EB4F)
    rank = np.lexsort((keys, counts[(h % np.uint64(INDEX_BUCKETS)).astype(np.int64)]))[: len(h) - need + wanted]
    return keys[rank].astype(np.int64), np.where(unique[rank], rank, -1), wanted


def _indexed_matches(texts: DataFrame, known: DataFrame, least: float) -> DataFrame | None:
    """message, template_id, ratio of the pairs that reach the ratio, by an inverted index on rare grams.

    None where rare grams stand in so many texts that the join would make over JOINED_ROWS rows per posting: all of
    these would be shuffled to be counted by pair, and they grow with the square of the texts.

    In a pair that reaches it, need characters of 2M/T lie in at most so many blocks as its template allows,
    so at least need - (q - 1) * blocks grams are shared.  In one order of all grams by rarity the first
    INDEX_SHARED of these are among the rarest of both texts: only those have postings.  A gram that stands once in both texts
    counts only where its places differ by no more than what the ratio leaves unmatched.
    Rows are the postings and the pairs that share one.
    """
    low, high = least / (2 - least), (2 - least) / least
    # work per text is large for its bytes: as many partitions as a shuffle has, however small the table is
    spread = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = kept(texts.repartition(spread, "message").select(F.monotonically_increasing_id().alias("i"), F.col("message").alias("text")))
    asked = kept(known.repartition(spread, "template_id").select(F.monotonically_increasing_id().alias("j"), "template_id", F.col("template").alias("text")))
    counts = _gram_counts(rows.select("text").union(asked.select("text")))
    lost = (INDEX_GRAM - 1) * INDEX_BLOCKS

    def postings(shared, number):
        def run(frames):
            for f in frames:
                for at in range(0, len(f), 500):  # some hundred postings each
                    part = f.iloc[at : at + 500]
                    found = [_rarest(text, shared(text), counts) for text in part["text"]]
                    sizes = [len(keys) for keys, _, _ in found]
                    each = {number: part[number], f"n_{number}": part["text"].str.len(), f"k_{number}": [w for _, _, w in found]}
                    lists = {c: np.repeat(np.asarray(v), sizes) for c, v in each.items()}
                    yield pd.DataFrame({"gram": np.concatenate([k for k, _, _ in found]), f"at_{number}": np.concatenate([p for _, p, _ in found]), **lists})

        return run

    of_message = lambda t: min(least * (1 + f) * len(t) / 2 - lost * f * len(t) for f in (low, high))
    of_template = lambda t: low * len(t) - (INDEX_GRAM - 1) * _most_blocks(t)
    schema = "gram long, {0} long, at_{0} int, n_{0} int, k_{0} int"
    a = rows.mapInPandas(postings(of_message, "i"), schema.format("i"))
    b = asked.select("j", "text").mapInPandas(postings(of_template, "j"), schema.format("j"))
    some = lambda rows, n: rows.where(F.pmod(F.xxhash64("gram"), F.lit(FORETOLD_BY)) == 0).groupBy("gram").agg(F.count("*").alias(n))
    met = some(a, "n_a").join(some(b, "n_b").hint("merge"), "gram", "full").na.fill(0, ["n_a", "n_b"])
    joined, postings_ = met.agg(F.coalesce(F.sum(F.col("n_a") * F.col("n_b")), F.lit(0)), F.coalesce(F.sum(F.col("n_a") + F.col("n_b")), F.lit(0))).first()
    if joined > JOINED_ROWS * postings_:
        return None
    need = F.ceil(least * (F.col("n_i") + F.col("n_j")) / 2 - 1e-9)
    near = (F.col("at_i") < 0) | (F.col("at_j") < 0) | (F.col("at_i") - F.col("at_j")).between(need - F.col("n_j"), F.col("n_i") - need)
    sized = (F.least("n_i", "n_j") >= need)
    # postings are many times the texts that their size is guessed from: never broadcast
    pairs = a.join(b.hint("merge"), "gram").where(sized & near).groupBy("i", "j").agg(F.count("*").alias("n"), F.first(F.least("k_i", "k_j")).alias("k")).where("n >= k").select("i", "j")
    whole = pairs.join(rows.withColumnRenamed("text", "message"), "i").join(asked.withColumnRenamed("text", "template"), "j").select("message", "template_id", "template")

    def rate(frames):
        for f in frames:
            out = []
            for (t, template), some in f.groupby(["template_id", "template"], sort=False):
                messages = some["message"].tolist()
                out += [(messages[i], t, r) for i, (r, _) in best_matches(messages, [(t, template)], least).items()]
            yield pd.DataFrame(out, columns=["message", "template_id", "ratio"])

    kind = known.schema["template_id"].dataType.simpleString()
    return whole.repartition("template_id").sortWithinPartitions("template_id").mapInPandas(rate, f"message string, template_id {kind}, ratio double")


def template_matches(messages: DataFrame, templates: DataFrame, least: float = 0.75, block: int = 20_000) -> DataFrame:
    """For each distinct automated text its best template by similarity ratio of the whole texts, if it reaches ``least``.

    Templates of 200 characters and more whose matching blocks are bounded well enough are looked up in an index
    of rare grams, where these are rare indeed.  For the others nothing short bounds what a pair must share: they meet the
    texts in groups by length bands that can reach the ratio, split in blocks of at most about ``block`` texts and BLOCK_CHARS characters.
    """
    texts = kept(messages.where("type = 'automated' AND message <> ''").select("message").distinct())
    known = templates.where("template <> ''").groupBy("template").agg(F.min("template_id").alias("template_id"))
    indexed = kept(known.select("template_id", "template", _is_indexed(least)(F.col("template")).alias("_i")))
    by_index = _indexed_matches(texts, indexed.where("_i").drop("_i"), least)
    by_block = _block_matches(texts, (indexed if by_index is None else indexed.where("NOT _i")).drop("_i"), least, block)
    found = by_block.select("message", "template_id", "ratio")
    found = found if by_index is None else by_index.union(found)
    best = Window.partitionBy("message").orderBy(F.desc("ratio"), "template_id")
    return found.withColumn("_n", F.row_number().over(best)).where("_n = 1").select("message", "template_id", "ratio")


def _is_indexed(least: float):
    bound = least / (2 - least) - (INDEX_GRAM - 1) * INDEX_BLOCKS

    @F.pandas_udf("boolean")
    def of(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: bound > 0 and len(t) >= 200 and _most_blocks(t) <= INDEX_BLOCKS * len(t))

    return of
