"""The index of rare grams loses no pair that reaches the ratio."""

from difflib import SequenceMatcher

import numpy as np

from threadline.operators import fuzzy as fz

#: Common letters, and rare ones, at which difflib may start a block in long texts.
COMMON, RARE = list("etaoinshrdlu     "), [chr(c) for c in range(0x391, 0x3B9) if c != 0x3A2]


def prose(rng, n):
    return "".join(rng.choice(RARE) if rng.random() < 0.05 else rng.choice(COMMON) for _ in range(int(n)))


def edited(rng, text, p):
    out = []
    for piece in [text[i : i + 12] for i in range(0, len(text), 12)]:
        out.append("" if rng.random() < p else piece[::-1] if rng.random() < p else piece)
    return "".join(out)


def test_pairs_share_enough_rare_grams():
    rng = np.random.default_rng(8)
    texts = [prose(rng, n) for n in rng.integers(220, 900, 60)]
    counts = rng.integers(0, 1000, fz.INDEX_BUCKETS)
    low, high, least = 0.6, 1 / 0.6, 0.75
    lost = (fz.INDEX_GRAM - 1) * fz.INDEX_BLOCKS
    met = 0
    for t in texts:
        if fz._most_blocks(t) > fz.INDEX_BLOCKS * len(t):
            continue
        for p in (0.01, 0.02, 0.04, 0.06, 0.1):
            m = edited(rng, t, p)
            if SequenceMatcher(None, m, t).ratio() < least:
                continue
            met += 1
            a = fz._rarest(m, min(least * (1 + f) * len(m) / 2 - lost * f * len(m) for f in (low, high)), counts)
            b = fz._rarest(t, low * len(t) - (fz.INDEX_GRAM - 1) * fz._most_blocks(t), counts)
            at = dict(zip(b[0].tolist(), b[1].tolist(), strict=True))
            need = np.ceil(least * (len(m) + len(t)) / 2 - 1e-9)
            shared = [(i, at[k]) for k, i in zip(a[0].tolist(), a[1].tolist(), strict=True) if k in at]
            near = [1 for i, j in shared if i < 0 or j < 0 or need - len(t) <= i - j <= len(m) - need]
            assert len(near) >= min(a[2], b[2])
    assert met > 60


def test_index_and_blocks_agree(spark):
    rng = np.random.default_rng(9)
    texts = [prose(rng, n) for n in rng.integers(150, 500, 40)]
    messages = [edited(rng, t, p) for t in texts for p in (0.02, 0.06)]
    rows = spark.createDataFrame([("automated", m) for m in messages], "type string, message string")
    known = spark.createDataFrame(list(enumerate(texts)), "template_id long, template string")
    indexed = known.where(fz._is_indexed(0.75)("template"))
    assert 10 < indexed.count() < 40
    got = {r.message: (r.template_id, r.ratio) for r in fz.template_matches(rows, known).collect()}
    want = {}
    for m in set(messages):
        r, i = max((SequenceMatcher(None, m, t).ratio(), -i) for i, t in enumerate(texts))
        if r >= 0.75:
            want[m] = (-i, r)
    assert got == want and len(want) > 40


def test_common_grams_are_not_joined(spark):
    """Texts out of few syllables share grams with nearly all others: pairs by postings would be shuffled by the square of the texts, so blocks take them."""
    rng = np.random.default_rng(10)
    syllables = ["the ", "ation", "er", "en ", "ing", "ou", "of ", "is, "]
    texts = ["".join(rng.choice(RARE) if rng.random() < 0.15 else rng.choice(syllables) for _ in range(n)) for n in rng.integers(90, 250, 60)]
    messages = [edited(rng, t, p) for t in texts for p in (0.01, 0.3)]
    asked = spark.createDataFrame([(m,) for m in messages], "message string")
    known = spark.createDataFrame(list(enumerate(texts)), "template_id long, template string")
    assert known.where(fz._is_indexed(0.75)("template")).count() > 40
    assert fz._indexed_matches(asked, known, 0.75) is None
    rare = spark.createDataFrame([("".join(chr(c) for c in rng.integers(0x4E00, 0x9000, 300)),) for _ in range(30)], "message string")
    assert fz._indexed_matches(rare, rare.selectExpr("1L AS template_id", "message AS template"), 0.75) is not None
    want = {}
    for m in set(messages):
        r, i = max((SequenceMatcher(None, m, t).ratio(), -i) for i, t in enumerate(texts))
        if r >= 0.75:
            want[m] = (-i, r)
    got = fz.template_matches(asked.selectExpr("'automated' AS type", "message"), known)
    assert {r.message: (r.template_id, r.ratio) for r in got.collect()} == want and len(want) >= 40
