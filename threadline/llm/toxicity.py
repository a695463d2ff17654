"""Toxicity by a weighted lexicon, matched with Aho-Corasick over folded texts.

Folding: lower case, compatibility decomposition without marks, look-alike
letters to Latin, digits and signs inside words to letters.  The lexicon holds
whole words and word beginnings.  It is learned from labelled rows: counts of
every word and beginning per label give candidates, and a greedy cover keeps the
few that explain toxic documents not yet explained; a weight is the smoothed log
odds.  A document's weights are normalised by its length, exception phrases are
left out, and a logistic curve fitted on the same rows gives the score.

Learning uses at most ``fit_rows`` labelled rows (those with the smallest hashes).

Defined results: null and empty texts have no hits and get the score of a clean
text; without toxic labels to learn from the lexicon is empty and every score is
the share of toxic labels (0 without labels); repeated rows get equal scores, and of
several texts of a labelled doc_id one is learned from, the same in every run; other
columns are ignored.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import batch_rows

# Look-alikes of Latin letters, and letters that digits and signs stand for.
LOOK_ALIKES = dict(zip("аеорсухкмтвнібдгωαβγεηικμνορτυχζıłø", "aeopcyxkmtbhibdrwabyenikmvoptuxzilo", strict=True))
SUBSTITUTES = dict(zip("0134578@$!", "oieastbasi", strict=True))
MARKS = {i: None for i in range(0x300, 0x370)}
#: Harmless phrases around words that lexicons of abuse often hold.
EXCEPTIONS = ("trash can", "trash bin", "clown fish", "pond scum", "stupid simple", "loser pays")

_TABLE = {ord(a): b for a, b in LOOK_ALIKES.items()} | MARKS
_WORD = re.compile(r"[^\W\d_]+")
_DIGIT = re.compile(r"(?<=[^\W\d_])[0134578]+(?=\w)|(?<![\w])[0134578]+(?=[^\W\d_])|(?<=[^\W\d_])[@$!](?=[^\W_])|(?<=[^\W\d_])[0134578]+(?![\w@])")
_SUB = str.maketrans(SUBSTITUTES)


def fold(text: str | None) -> str:
    """Folded words between single blanks, one before and one after."""
    t = (text or "").lower()
    if not t.isascii():
        t = unicodedata.normalize("NFKD", t).translate(_TABLE)
    if any(c in t for c in "0134578@$!"):
        t = _DIGIT.sub(lambda m: m[0].translate(_SUB), t)
    return " " + " ".join(_WORD.findall(t)) + " "


def features(folded: str) -> set[str]:
    """Whole words (' word ') and their beginnings of 3 to 7 letters (' begin')."""
    words = set(folded.split())
    return {f" {w} " for w in words} | {f" {w[:n]}" for w in words for n in range(3, 8) if n <= len(w)}


class Matcher:
    """The weight of each word that an entry covers; the largest where several do."""

    def __init__(self, weights: dict[str, float], exceptions=EXCEPTIONS):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for entry, w in weights.items():
            self.automaton.add_word(entry, (len(entry), w, entry))
        for phrase in exceptions:
            if (entry := fold(phrase)) not in weights:
                self.automaton.add_word(entry, (len(entry), None, entry))
        self.automaton.make_automaton()

    def hits(self, folded: str) -> list[tuple[float, str]]:
        best: dict[int, tuple[float, str]] = {}
        left_out = []
        for end, (n, w, entry) in self.automaton.iter(folded):
            start = end - n + 1
            if w is None:
                left_out.append((start, end))
            elif start not in best or best[start][0] < w:
                best[start] = (w, entry)
        return [v for s, v in best.items() if not any(a <= s < b for a, b in left_out)]

    def all_entries(self, folded: str) -> set[str]:
        return {entry for _, (_, w, entry) in self.automaton.iter(folded) if w is not None}


@dataclass
class Model:
    weights: dict[str, float] = field(default_factory=dict)
    curve: tuple[float, float, float] = (-30.0, 0.0, 0.0)
    exceptions: tuple[str, ...] = EXCEPTIONS

    def inputs(self, texts) -> np.ndarray:
        """log of the summed weights, and the sum per root of the length."""
        matcher, rows = Matcher(self.weights, self.exceptions), []
        for t in texts:
            folded = fold(t)
            total = sum(w for w, _ in matcher.hits(folded)) if self.weights else 0.0
            rows.append((np.log1p(total), total / np.sqrt(folded.count(" "))))
        return np.array(rows, dtype=float).reshape(-1, 2)

    def score(self, texts) -> np.ndarray:
        a, b, c = self.curve
        x = self.inputs(texts)
        return 1 / (1 + np.exp(-np.clip(a + b * x[:, 0] + c * x[:, 1], -30, 30)))


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = 20_000, most_candidates: int = 1500, least_docs: int = 3) -> Model:
    """A model from labels (doc_id, toxic); the rows are at most fit_rows, so what the driver gathers is bounded."""
    spark = docs.sparkSession
    chosen = labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows)
    # of rows with the same doc_id the same text is learned from in every run
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    rows = texts.groupBy("doc_id", "toxic").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text")).select("doc_id", "text", "toxic")

    def count(frames):
        import pandas as pd

        for f in frames:
            by = {0: Counter(), 1: Counter()}
            for t, y in zip(f["text"], f["toxic"], strict=True):
                by[int(y > 0)].update(features(fold(t)))
            names = sorted(by[0].keys() | by[1].keys())
            yield pd.DataFrame({"feature": [*names, ""], "tox": [*(by[1][x] for x in names), int((f["toxic"] > 0).sum())], "clean": [*(by[0][x] for x in names), int((f["toxic"] <= 0).sum())]})

    counts = rows.mapInPandas(count, "feature string, tox long, clean long").groupBy("feature").agg(F.sum("tox").alias("tox"), F.sum("clean").alias("clean"))
    with batch_rows(spark, 1000):
        counts = counts.persist()
        total = counts.where("feature = ''").first()
        if total is None or not total["tox"] or not total["clean"]:
            share = total["tox"] / (total["tox"] + total["clean"]) if total else 0.0
            counts.unpersist()
            return Model(curve=(float(np.clip(np.log((share + 1e-13) / (1 - share + 1e-13)), -30, 30)), 0.0, 0.0))
        nt, n0 = total["tox"], total["clean"]
        z = (F.col("tox") / nt - F.col("clean") / n0) / F.sqrt((F.col("tox") + F.col("clean") + 1) / (nt + n0) * (1 / nt + 1 / n0))
        odds = F.log((F.col("tox") + 0.5) / (nt + 1)) - F.log((F.col("clean") + 0.5) / (n0 + 1))
        kept = counts.where((F.col("feature") != "") & (F.col("tox") >= least_docs)).select("feature", "tox", z.alias("z"), odds.alias("w")).where("z >= 3.5 AND w >= 1.5")
        weights = {r["feature"]: float(r["w"]) for r in kept.orderBy(F.desc("z"), F.length("feature"), "feature").limit(most_candidates).collect()}
        counts.unpersist()

        def match(frames):
            matcher = Matcher(weights, ())
            for f in frames:
                f["entries"] = [sorted(matcher.all_entries(fold(t))) for t in f["text"]]
                yield f[["doc_id", "toxic", "entries"]]

        found = rows.mapInPandas(match, "doc_id long, toxic int, entries array<string>").orderBy("doc_id").collect() if weights else []
        names = sorted(weights)
        place = {x: i for i, x in enumerate(names)}
        has, y = np.zeros((len(found), len(names)), dtype=np.int8), np.array([int(r["toxic"] > 0) for r in found])
        for i, r in enumerate(found):
            has[i, [place[x] for x in r["entries"]]] = 1
        model = Model({x: weights[x] for x in _cover(has, y, names, least_docs)})
        sample = rows.orderBy("doc_id").select("text", "toxic")

        def measure(frames):
            import pandas as pd

            for f in frames:
                x = model.inputs(f["text"])
                yield pd.DataFrame({"toxic": f["toxic"], "a": x[:, 0], "b": x[:, 1]})

        measured = sample.mapInPandas(measure, "toxic int, a double, b double").collect()
    data = np.array([(r["a"], r["b"], r["toxic"] > 0) for r in measured], dtype=float)
    return Model(model.weights, _logistic(data[:, :2], data[:, 2]))


def _cover(has: np.ndarray, y: np.ndarray, names: list[str], least: int) -> list[str]:
    """Entries that one after another explain most toxic documents left, a clean one counting against as one and a half."""
    open_rows, chosen = np.ones(len(y), dtype=bool), []
    length = np.array([len(x) for x in names]) * 1e-6
    while len(names):
        gain = has[open_rows & (y == 1)].sum(axis=0, dtype=np.int64) - 1.5 * has[y == 0].sum(axis=0, dtype=np.int64)
        best = int(np.argmax(gain - length))  # of equals the shortest
        if gain[best] < least:
            break
        chosen.append(names[best])
        open_rows &= has[:, best] == 0
    return chosen


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> tuple[float, float, float]:
    design, beta = np.column_stack([np.ones(len(x)), x]), np.zeros(3)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        grad = design.T @ (y - p) - ridge * beta
        hess = (design * (p * (1 - p))[:, None]).T @ design + ridge * np.eye(3)
        step = np.linalg.solve(hess, grad)
        beta = beta + step
        if np.abs(step).max() < 1e-8:
            break
    return float(beta[0]), float(beta[1]), float(beta[2])


def held_out(doc_id: Column) -> Column:
    """Rows that no label is learned from: one in five by checksum."""
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "utf-8")) % 5 == 0, F.lit(False))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score of every row."""

    def run(frames):
        import pandas as pd

        for f in frames:
            yield pd.DataFrame({"doc_id": f["doc_id"].astype("Int64"), "score": model.score(f["text"])})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInPandas(run, "doc_id long, score double")
