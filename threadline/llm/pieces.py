"""SentencePiece segmentations: sampled without replacement by Gumbel top-k, decoded again.

A text's lattice has an edge for every piece that matches; pieces never run past the
start of a word, so the lattice is a chain of word lattices.  A piece's log probability
falls with the logarithm of its rank in the vocabulary (its merge order).  Backward sums give
exact probabilities of all edges.

The search is best-first over perturbed log probabilities.  A node is a set of
segmentations with a common beginning; its key is the greatest Gumbel-perturbed log
probability inside it.  The key of the root is drawn first; the best child inherits its
parent's key and all its siblings together get a Gumbel of their mass, truncated there.
So the node on top of the queue always leads to the next of the k largest perturbed
segmentations, which are distinct and a sample without replacement (pieces are drawn on
a grid of 2^-24, log probabilities summed on one of 2^-32).  With the (k + 1)-th key as
threshold, each gets its inclusion probability.

The texts of a batch are searched side by side, each round adding one segmentation to
each of them.  Draws are hashes of the row key, the round, the word and the step, and
sums are of whole numbers: results do not depend on batches, partitions or retries.

Defined results: null and empty texts have one empty segmentation (probability and
inclusion 1, no ids); texts with fewer than k segmentations return all; equal keys give
equal draws; characters without a piece become byte pieces; the sign that
stands for a blank decodes to a blank; extra columns are ignored.
"""

from __future__ import annotations

import itertools
import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tokens import batches

_UNIT = re.compile("▁*[^▁]+|▁+")
_LATTICES: dict[str, Lattices] = {}


class Lattices:
    """A vocabulary as a trie of its pieces, one per worker process."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.model.get_piece_size()
        names = [self.model.id_to_piece(i) for i in range(n)]
        plain = [i for i in range(n) if not (self.model.is_control(i) or self.model.is_unknown(i) or self.model.is_byte(i) or self.model.is_unused(i))]
        if any("▁" in names[i].lstrip("▁") for i in plain):
            raise ValueError("the vocabulary has pieces that run past the start of a word")
        # most frequent first: the score of a merge falls with its order
        logs = {i: -np.log(r + 3.0) for r, i in enumerate(sorted(plain, key=lambda i: -self.model.get_score(i)))}
        total = np.log(sum(np.exp(x) for x in logs.values()))
        children: dict[tuple[int, str], int] = {}
        ends: dict[int, int] = {}
        for n_th, i in enumerate(logs):
            at = 0
            for c in names[i]:
                at = children.setdefault((at, c), len(children) + 1)
            ends[at] = n_th
        # a trie's edges as sorted numbers: the node, then the character
        edges = np.fromiter((at << 21 | ord(c) for at, c in children), np.int64, len(children))
        order = np.argsort(edges)
        self.trie, self.child = edges[order], np.fromiter(children.values(), np.int64, len(children))[order]
        first = self.trie[self.trie < 1 << 21]  # the root's
        self.root = np.full(int(first.max()) + 2, -1)
        self.root[first] = self.child[: len(first)]
        self.ends = np.full(len(children) + 1, -1)
        self.ends[list(ends)] = list(ends.values())
        self.ids = np.fromiter(logs, np.int64, len(logs))
        self.logs = np.fromiter(logs.values(), np.float64, len(logs)) - total
        self.byte = [self.model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.byte_log = float(-np.log(n + 3.0) - total)
        #: What each id stands for, in UTF-8; byte pieces are single bytes.
        self.raw = [x.encode() for x in names]
        for b, i in enumerate(self.byte):
            self.raw[i] = bytes([b])
        # the same one after another, and where each begins
        self.raw_bytes = np.frombuffer(b"".join(self.raw), np.uint8)
        self.raw_size = np.fromiter(map(len, self.raw), np.int64, n)
        self.raw_first = np.cumsum(self.raw_size) - self.raw_size
        self.chars = np.array([*map(len, names), 1])  # the last: what has no piece
        self.known_bytes: dict[str, list[int]] = {}

    @staticmethod
    def of(path: str) -> Lattices:
        if path not in _LATTICES:
            _LATTICES[path] = Lattices(path)
        return _LATTICES[path]

    def decode(self, ids) -> str:
        """The text of ids: pieces joined, byte pieces as UTF-8, the leading blank dropped."""
        return b"".join(map(self.raw.__getitem__, map(int, ids))).decode(errors="replace").replace("▁", " ")[1:]

    def spelled(self, tables: Tables, edges: np.ndarray, chars: str, raw: bytes) -> tuple[np.ndarray, bool]:
        """The ids of a path over chars, characters without a piece as bytes, and whether they decode to raw (chars in UTF-8)."""
        ids = tables.ids[edges]
        bare = np.flatnonzero(ids < 0)
        if len(bare):
            at = np.cumsum(self.chars[ids])[bare] - 1
            own = [self.byte_ids(chars[i]) for i in at.tolist()]
            size = np.ones(len(ids), np.int64)
            size[bare] = [len(x) for x in own]
            ids = np.repeat(ids, size)
            ids[ids < 0] = list(itertools.chain.from_iterable(own))
        return ids, self.raw_bytes[_spread(self.raw_first[ids], self.raw_size[ids])].tobytes() == raw

    def matches(self, code: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """All pieces in a text (as code points), by length from 1 on: where they begin, and their numbers."""
        out, at = [], np.arange(len(code))
        state = self.root[np.minimum(code, len(self.root) - 1)]
        while len(at):
            hit = np.flatnonzero(state >= 0)
            at, state = at[hit], state[hit]
            piece = self.ends[state]
            whole = np.flatnonzero(piece >= 0)
            out.append((at[whole], piece[whole]))
            inside = np.flatnonzero(at + len(out) < len(code))
            at, state = at[inside], state[inside]
            key = state << 21 | code[at + len(out)]
            place = np.minimum(np.searchsorted(self.trie, key), len(self.trie) - 1)
            state = np.where(self.trie[place] == key, self.child[place], -1)
        return out

    def byte_ids(self, char: str) -> list[int]:
        if char not in self.known_bytes:
            self.known_bytes[char] = [self.byte[b] for b in char.encode()]
        return self.known_bytes[char]


class Tables:
    """The lattices of words as one set of arrays; those of words seen lately stay."""

    GRID = 1 << 24  # probabilities are drawn on this grid
    LOG_GRID = 2.0**32  # log probabilities are summed on this one

    def __init__(self, lattices: Lattices, limit: int = 5_000_000):
        self.lattices, self.limit = lattices, limit
        self._room = {x: np.zeros(1, t) for x, t in (("owner", np.int32), ("target", np.int32), ("ids", np.int32), ("prob", float), ("log", np.int64), ("upto", np.int64), ("others", np.int16), ("last", bool), ("first", np.int64))}
        self._clear()

    def _clear(self):
        self.place: dict[str, int] = {}
        self.n_nodes = self.n_edges = 0
        self._room["first"][0] = 0
        for name, all_of in self._room.items():  # the room stays
            setattr(self, name, all_of[: int(name == "first")])

    def _extend(self, name: str, more: np.ndarray) -> None:
        """The array of that name grows in place, into room that doubles when it is full."""
        now, room = len(getattr(self, name)), self._room[name]
        if now + len(more) > len(room):
            larger = np.empty(max(2 * len(room), now + len(more)), room.dtype)
            larger[:now] = room[:now]
            room = self._room[name] = larger
        room[now : now + len(more)] = more
        setattr(self, name, room[: now + len(more)])

    def starts(self, units: list[str]) -> np.ndarray:
        """The first node of each word; new words are added (all go before, when edges are beyond the limit)."""
        at = np.fromiter(map(self.place.get, units, itertools.repeat(-1)), np.int64, len(units))
        new = np.flatnonzero(at < 0).tolist()
        if new and self.n_edges > self.limit:
            self._clear()
            new = range(len(units))
        if new:
            words = [units[i] for i in new]
            self._add(list(dict.fromkeys(words)))
            at[new] = np.fromiter(map(self.place.__getitem__, words), np.int64, len(words))
        return at

    def _add(self, units: list[str]) -> None:
        lattices = self.lattices
        # nodes are the characters of all words and an end after each
        joined = "\0".join(units) + "\0"
        size = np.fromiter(map(len, units), np.int64, len(units))
        ends = np.cumsum(size + 1) - 1
        self.place.update(zip(units, (ends - size + self.n_nodes).tolist(), strict=True))
        code = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
        found = lattices.matches(code)
        bare = np.ones(len(joined), dtype=bool)  # characters without a piece of their own
        bare[found[0][0]] = False
        bare[ends] = False
        odd = np.flatnonzero(bare)
        count = np.bincount(np.concatenate([odd, *(at for at, _ in found)]), minlength=len(joined))
        first = np.concatenate([[0], np.cumsum(count)])
        # edges in order of where they begin, then end: the bare ones are of length 1
        free, n_edges = first[:-1].copy(), int(first[-1])
        target, ids, logs = np.empty(n_edges, np.int64), np.empty(n_edges, np.int64), np.empty(n_edges)
        n_bytes = 1 + (code[odd] >= 0x80) + (code[odd] >= 0x800).astype(np.int64) + (code[odd] >= 0x10000)
        target[free[odd]], ids[free[odd]], logs[free[odd]] = odd + 1, -1, n_bytes * lattices.byte_log
        free[odd] += 1
        for size_of, (at, piece) in enumerate(found, 1):
            slot = free[at]
            target[slot], ids[slot], logs[slot] = at + size_of, lattices.ids[piece], lattices.logs[piece]
            free[at] += 1
        source = np.repeat(np.arange(len(joined)), count)
        # backward sums, all nodes at the same distance from their word's end at once
        left = np.repeat(ends, size + 1) - np.arange(len(joined))
        beta = np.zeros(len(joined))
        nodes = np.argsort(left.astype(np.uint16) if size.max() < 1 << 16 else left, kind="stable")
        bounds = np.searchsorted(left[nodes], np.arange(1, int(size.max()) + 2))
        for a, b in zip(bounds, bounds[1:], strict=False):
            here = nodes[a:b]
            here = here[count[here] > 0]
            if len(here):
                each = count[here]
                begin = np.cumsum(each) - each
                edges = np.arange(each.sum()) + np.repeat(first[here] - begin, each)
                x = logs[edges] + beta[target[edges]]
                top = np.maximum.reduceat(x, begin)
                beta[here] = top + np.log(np.add.reduceat(np.exp(x - np.repeat(top, each)), begin))
        log = logs + beta[target] - beta[source]
        prob = np.exp(log)
        run = np.cumsum((prob * self.GRID).astype(np.int64))
        before = np.concatenate([[0], run])[first[:-1]]
        owner = source + self.n_nodes
        # cumulative probability within each node, after the node's number: one sorted array
        upto = owner * self.GRID + run - before[source]
        some = np.flatnonzero(count)
        upto[first[some + 1] - 1] = (some + self.n_nodes + 1) * self.GRID
        last = np.zeros(len(joined), dtype=bool)
        last[ends] = True
        values = {"others": np.repeat(count - 1, count), "last": last[target], "owner": owner, "target": target + self.n_nodes, "ids": ids, "prob": prob, "log": np.rint(log * self.LOG_GRID), "upto": upto, "first": first[1:] + self.n_edges}
        for name, more in values.items():
            self._extend(name, more)
        self.n_nodes += len(joined)
        self.n_edges += len(source)

    def final(self, nodes: np.ndarray) -> np.ndarray:
        """Whether nodes are ends of words."""
        return self.first[nodes + 1] == self.first[nodes]

    def draw(self, nodes: np.ndarray, seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Paths from nodes to the ends of their words: how many edges each has, and all edges in order."""
        steps, counts, active = [], np.zeros(len(nodes), np.int64), np.flatnonzero(~self.final(nodes))
        nodes = nodes[active].astype(np.int64)
        while len(active):
            drawn = (_mixed(seeds[active], len(steps)) >> np.uint64(40)).astype(np.int64)
            e, drawn = self.first[nodes], drawn + nodes * self.GRID
            late = np.flatnonzero(self.upto[e] <= drawn)
            while len(late):  # a node has few edges
                e[late] += 1
                late = late[self.upto[e[late]] <= drawn[late]]
            steps.append((active, e))
            counts[active] += 1
            going = np.flatnonzero(~self.last[e])
            active, nodes = active[going], self.target[e[going]].astype(np.int64)
        first, edges = np.cumsum(counts) - counts, np.zeros(int(counts.sum()), np.int64)
        for i, (which, e) in enumerate(steps):
            edges[first[which] + i] = e
        return counts, edges


def _mixed(keys: np.ndarray, salt) -> np.ndarray:
    """Well mixed 64-bit numbers of keys and a salt."""
    with np.errstate(over="ignore"):
        h = keys + np.asarray(salt).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(0x632BE59BD9B4E019)
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return h ^ (h >> np.uint64(31))


def _exponential(keys: np.ndarray) -> np.ndarray:
    return -np.log(((keys >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53)


def _spread(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The numbers first .. first + count - 1 of each, one after another."""
    return np.arange(int(count.sum())) + np.repeat(first - (np.cumsum(count) - count), count)


class Search:
    """The perturbed search of all texts of a batch: each round finds the next segmentation of each.

    All segmentations found are kept one after another as ``edges``, with the word of each
    edge and the key (``value``) of the siblings of its step, which is the queue.
    """

    def __init__(self, tables: Tables, starts: np.ndarray, n_words: np.ndarray, keys: np.ndarray):
        self.tables, self.starts, self.keys = tables, starts, keys
        self.n_words, self.word_0 = n_words, np.cumsum(n_words) - n_words
        self.edges, self.words, self.value = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        self.entries: list[dict] = []  # per round: texts, first place and number of their edges, edges tried at the first free step
        texts = np.arange(len(keys))
        gumbel = -np.log(_exponential(_mixed(keys, 1)))
        none = np.zeros(len(keys), np.int64)
        self._expand(texts, gumbel, none, none, none - 1, np.zeros((len(keys), 0), np.int64))

    def _expand(self, texts, key, head_first, head_count, edge, tried) -> None:
        """A segmentation of each of texts: the given head, then an edge (-1: none yet), then what is drawn."""
        t, turn = self.tables, len(self.entries) + 2
        seeds = _mixed(self.keys[texts], turn)
        head = _spread(head_first, head_count)
        # the word where the drawing starts, and the words after it
        word = np.where(edge >= 0, self.words[head_first + head_count] if len(self.words) else 0, self.word_0[texts])
        rest = self.word_0[texts] + self.n_words[texts] - word
        of_text, words = np.repeat(np.arange(len(texts)), rest), _spread(word, rest)
        nodes = self.starts[words]
        nodes[(np.cumsum(rest) - rest)[edge >= 0]] = t.target[edge[edge >= 0]]
        counts, drawn = t.draw(nodes, _mixed(seeds[of_text], words - self.word_0[texts][of_text]))
        per_text = np.bincount(of_text, weights=counts, minlength=len(texts)).astype(np.int64)
        chosen = (edge >= 0).astype(np.int64)
        size = head_count + chosen + per_text
        first = np.cumsum(size) - size
        edges, of_word = np.empty(int(size.sum()), np.int64), np.empty(int(size.sum()), np.int64)
        at = _spread(first, head_count)
        edges[at], of_word[at] = self.edges[head], self.words[head]
        at = (first + head_count)[edge >= 0]
        edges[at], of_word[at] = edge[edge >= 0], word[edge >= 0]
        at = _spread(first + head_count + chosen, per_text)
        edges[at], of_word[at] = drawn, np.repeat(words, counts)
        # siblings of each step from the end of the head on
        log = t.log[edges]
        run = np.concatenate([[0], np.cumsum(log)])
        total = (run[first + size] - run[first]) / t.LOG_GRID
        left = size - head_count
        at = _spread(first + head_count, left)
        own, owner, step = edges[at], np.repeat(np.arange(len(texts)), left), at - np.repeat(first, left)
        before = (run[at] - np.repeat(run[first], left)) / t.LOG_GRID
        rest_mass, siblings = 1.0 - t.prob[own], t.others[own]
        free = np.flatnonzero(left)
        gone, begin = tried[free] >= 0, (np.cumsum(left) - left)[free]
        rest_mass[begin] -= np.where(gone, t.prob[np.where(gone, tried[free], 0)], 0.0).sum(axis=1)
        siblings[begin] -= gone.sum(axis=1, dtype=np.int16)
        noise = np.log(_exponential(_mixed(seeds[owner] ^ np.uint64(0xD1B54A32D192ED03), step)))
        with np.errstate(divide="ignore", invalid="ignore"):
            mass = before + np.log(np.maximum(rest_mass, 1e-300))
            inside = -np.logaddexp(-key[owner], noise - mass)
        inside[(siblings <= 0) | (rest_mass <= 0)] = -np.inf
        value = np.full(len(edges), -np.inf)
        value[at] = inside
        place = len(self.edges) + first
        self.edges, self.words, self.value = np.concatenate([self.edges, edges]), np.concatenate([self.words, of_word]), np.concatenate([self.value, value])
        self.entries.append({"texts": texts, "first": place, "size": size, "head": head_count, "tried": tried, "key": key, "log_prob": total})

    def best(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each text the greatest key in the queue (-inf: none), its round and its place."""
        n = len(self.keys)
        key, turn, place = np.full(n, -np.inf), np.zeros(n, np.int64), np.zeros(n, np.int64)
        for r, e in enumerate(self.entries):
            some = np.flatnonzero(e["size"] > 0)
            if not len(some):
                continue
            values = self.value[e["first"][0] : e["first"][-1] + e["size"][-1]]
            begin = e["first"][some] - e["first"][0]
            top = np.maximum.reduceat(values, begin)
            hit = np.flatnonzero(values == np.repeat(top, e["size"][some]))
            which, at = np.unique(np.repeat(np.arange(len(some)), e["size"][some])[hit], return_index=True)
            texts = e["texts"][some[which]]
            better = top[which] > key[texts]
            key[texts[better]], turn[texts[better]], place[texts[better]] = top[which][better], r, e["first"][0] + hit[at[better]]
        return key, turn, place

    def advance(self) -> None:
        """The next segmentation of each text that has one."""
        t = self.tables
        key, turn, place = self.best()
        texts = np.flatnonzero(key > -np.inf)
        if not len(texts):
            return
        key, turn, place = key[texts], turn[texts], place[texts]
        self.value[place] = -np.inf
        first, tried = np.zeros(len(texts), np.int64), np.full((len(texts), len(self.entries)), -1)
        tried[:, 0] = self.edges[place]
        for r, e in enumerate(self.entries):
            mine = np.flatnonzero(turn == r)
            at = np.searchsorted(e["texts"], texts[mine])
            first[mine] = e["first"][at]
            again = place[mine] == e["first"][at] + e["head"][at]  # siblings of siblings: those tried before stay out
            more = e["tried"][at[again]]
            tried[mine[again], 1 : 1 + more.shape[1]] = more
        # one of the other edges of the node, by probability
        node = t.owner[self.edges[place]].astype(np.int64)
        count = t.first[node + 1] - t.first[node]
        edges, of = _spread(t.first[node], count), np.repeat(np.arange(len(texts)), count)
        weight = (t.prob[edges] * 2.0**40).astype(np.int64) + 1
        weight[(edges[:, None] == tried[of]).any(axis=1)] = 0
        run = np.cumsum(weight)
        base = np.concatenate([[0], run])[np.cumsum(count) - count]
        total = np.concatenate([[0], run])[np.cumsum(count)] - base
        share = (_mixed(_mixed(self.keys[texts], len(self.entries) + 2), 3) >> np.uint64(11)).astype(np.float64) * 2.0**-53
        edge = edges[np.searchsorted(run, base + (share * total).astype(np.int64), side="right")]
        self._expand(texts, key, first, place - first, edge, tried)


def samples(tables: Tables, starts: np.ndarray, n_words: np.ndarray, keys: np.ndarray, k: int) -> tuple[list[list[tuple[np.ndarray, float, float]]], np.ndarray]:
    """For each text its k segmentations of largest perturbed log probability, (edges, log probability, key), and the key after them.

    starts: first nodes of the words of all texts; n_words: how many of them each text has (one at least).
    """
    search = Search(tables, starts, n_words, keys)
    for _ in range(k - 1):
        before = len(search.entries)
        search.advance()
        if len(search.entries) == before:
            break
    out: list[list] = [[] for _ in keys]
    for e in search.entries:
        for text, first, size, log_prob, key in zip(e["texts"].tolist(), e["first"].tolist(), e["size"].tolist(), e["log_prob"].tolist(), e["key"].tolist(), strict=True):
            out[text].append((search.edges[first : first + size], log_prob, key))
    return out, search.best()[0]


_TABLES: dict[str, Tables] = {}


def segmentations(docs: DataFrame, path: str, k: int = 2, seed: int = 0) -> DataFrame:
    """doc_id, rank, ids (little-endian 32-bit), log_prob, gumbel, inclusion, decodes for each of the k samples."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), F.xxhash64("doc_id", F.lit(seed)).alias("key"))

    def run(frames):
        import pandas as pd

        lattices = Lattices.of(path)
        tables = _TABLES.setdefault(path, Tables(lattices))
        # some texts at a time: their lattices and samples are larger than they are
        for f in (f.iloc[a:b] for f in frames for a, b in batches(f["text"].tolist(), 1_000_000)):
            marked = ["▁" + t.replace(" ", "▁") if t else "" for t in f["text"]]
            parted = list(map(_UNIT.findall, marked))
            n_words = np.fromiter(map(len, parted), np.int64, len(parted))
            some = np.flatnonzero(n_words)
            starts = tables.starts(list(itertools.chain.from_iterable(parted)))
            found, least = samples(tables, starts, n_words[some], f["key"].to_numpy().view(np.uint64)[some], k) if len(some) else ([], [])
            place, out = dict(zip(some.tolist(), range(len(some)), strict=True)), []
            for i, (doc_id, chars) in enumerate(zip(f["doc_id"], marked, strict=True)):
                if not chars:
                    out.append((doc_id, 1, b"", 0.0, 0.0, 1.0, True))
                    continue
                raw = chars.encode()
                for rank, (edges, log_prob, gumbel) in enumerate(found[place[i]], 1):
                    ids, same = lattices.spelled(tables, edges, chars, raw)
                    out.append((doc_id, rank, ids.astype("<u4").tobytes(), log_prob, gumbel, float(-np.expm1(-np.exp(min(700.0, log_prob - least[place[i]])))), same))
            yield pd.DataFrame(out, columns=["doc_id", "rank", "ids", "log_prob", "gumbel", "inclusion", "decodes"]).astype({"doc_id": "Int64"})

    return rows.mapInPandas(run, "doc_id long, rank int, ids binary, log_prob double, gumbel double, inclusion double, decodes boolean")
