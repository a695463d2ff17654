"""The operators without a session: round trips, distributions and brute force."""

import itertools
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from threadline.llm import ann, minhash, packing, pieces, rans, suffixes, toxicity, warc
from threadline.llm.tokens import Encoder

BPE, SP = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD_TEXTS = ["", " ", "  ", "a  b", " a \n b", "x\n\ny", "don't  stop\t now ", "é  x 　y", "foo<|endoftext|> bar <|endoftext|>", "1 2  3", "$$$ %%%  &&", "a_.b", "é.́x,", "a\0b \1c", "x\n y", "x \ny", "²³.,½!", "w" * 5000, None, "a \n\n  b\t\tc", "\n\n x  ", " \t", "a\u00a0 b \u3000c\u2028", "x\x1c y", "a\x85b  .c  ,", "end. \n", "  $ #\r\n% ", "tab\t.x \t y", "it's  '  s 's"]


def test_encoder_equals_the_library():
    e = Encoder(BPE, limit=5)
    for texts in (ODD_TEXTS, ODD_TEXTS[::-1], ["one text, again. One text"] * 3):
        for ids, t in zip(e.encode(texts), texts, strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == e.tokenizer.encode(t or "", add_special_tokens=False).ids


def test_encoder_on_random_white_space():
    e, rng = Encoder(BPE), random.Random(8)
    texts = ["".join(rng.choice(["a", "B1", " ", " ", "  ", "\n", "\t", "\r\n", ".", ",", "#", "'s", "é", "\u00a0", "\u3000", "\x0b", "_", "字"]) for _ in range(rng.randint(0, 14))) for _ in range(6000)]
    for ids, t in zip(e.encode(texts), texts, strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == e.tokenizer.encode(t, add_special_tokens=False).ids, repr(t)


@pytest.mark.parametrize("n", [0, 1, rans.LANES, rans.LANES * rans.CHECKPOINT_STEPS * 2 + 17])
def test_token_block_round_trip(n):
    rng = np.random.default_rng(n)
    ids = np.minimum(rng.geometric(0.01, n), 60_000).astype(np.uint16)
    counts = np.bincount(ids, minlength=65_536)
    freq = rans.scaled(counts)
    assert not n or (int(freq.sum()) == 1 << rans.SCALE_BITS and ((freq > 0) == (counts > 0)).all())
    start, symbol = rans.tables(freq)
    docs = rans.pack_docs([5, None], [n, 0])
    block = rans.encode_block(ids, freq, start, docs)
    back, meta = rans.decode_block(block, freq, start, symbol)
    assert (back == ids).all() and rans.unpack_docs(meta)[0] == [5, None]
    p = rans.parse_block(block)
    if len(p["marks"]) > 1:  # a part on its own
        assert (rans.decode_part(p, 1, freq, start, symbol) == ids[p["marks"][1][0] * rans.LANES :][: len(rans.decode_part(p, 1, freq, start, symbol))]).all()
    if n:
        at = len(block) // 2
        with pytest.raises((ValueError, zlib.error)):
            rans.decode_block(block[:at] + bytes([block[at] ^ 1]) + block[at + 1 :], freq, start, symbol)


def test_packing_plan_meets_the_demand():
    rng = np.random.default_rng(4)
    for n in (0, 1, 50, 3000):
        demand = np.bincount(rng.integers(0, packing.CLASSES, n), minlength=packing.CLASSES)
        plan = packing.solve(demand)
        assert (sum((t * p for p, t in plan), np.zeros(packing.CLASSES, int)) == demand).all()
        assert all((p * np.arange(1, packing.CLASSES + 1)).sum() <= packing.CLASSES for p, _ in plan)
        if n == 3000:
            assert sum(t for _, t in plan) <= (demand * np.arange(1, packing.CLASSES + 1)).sum() / packing.CLASSES * 1.3 + 2


def test_deep_shallow_sorting():
    rng = random.Random(5)
    for _ in range(150):
        strings = [bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 30))) for _ in range(rng.randint(1, 40))]
        order, lcp = suffixes.deep_shallow(strings)
        want = sorted(strings)
        assert [strings[i] for i in order] == want
        assert all(lcp[i] == (suffixes.common(want[i], want[i - 1]) if i else 0) for i in range(len(want)))


def test_warc_archives():
    pages = [(i, f"http://x/{i}\n", "response", __import__("hashlib").sha256(b"p%d" % i).hexdigest(), len(b"p%d" % i), None, b"p%d" % i) for i in range(60)]
    records = [warc.record(*p) for p in pages] + [warc.record(99, "", "revisit", "d" * 64, 500, 7, b"")]
    data = warc.write_archive(records)
    got = list(warc.read_archive(data))
    assert [r["page_id"] for r in got] == [*range(60), 99] and got[-1]["refers_to"] == 7 and got[3]["payload"] == b"p3"
    for broken in (data[:-5], b"\0" * 8 + data[8:], data[: len(data) // 2] + b"\xff" + data[len(data) // 2 + 1 :]):
        with pytest.raises(Exception):
            list(warc.read_archive(broken))


def test_warc_records_of_others():
    """Types, versions, header spellings and digests that other writers use."""
    import base64
    import hashlib

    sha1 = lambda b: "sha1:" + base64.b32encode(hashlib.sha1(b).digest()).decode()

    def make(version, kind, name, block, *more):
        head = [version, f"WARC-Type: {kind}", f"WARC-Record-ID:{name}", "WARC-Date:2020-01-01T00:00:00Z", f"content-length:  {len(block)}", *more]
        return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"

    page = b"HTTP/1.1 200 OK\r\nA: b\r\n\r\nbody"
    records = [
        make("WARC/1.0", "warcinfo", "<urn:uuid:1>", b"software: x\r\n", "Content-Type: application/warc-fields"),
        make("WARC/1.0", "request", "<urn:uuid:2>", b"GET / HTTP/1.1\r\n\r\n", "Content-Type: application/http;", " msgtype=request"),
        make("WARC/1.1", "response", "<urn:uuid:3>", page, "Content-Type: application/http; msgtype=response", f"WARC-Payload-Digest: {sha1(b'body')}", f"WARC-Block-Digest: {sha1(page)}"),
        make("WARC/1.0", "metadata", "<urn:uuid:4>", b"", "Content-Type: application/warc-fields"),
        make("WARC/1.0", "revisit", "<urn:uuid:5>", b"HTTP/1.1 304 Not Modified\r\n\r\n", "Content-Type: application/http", "WARC-Refers-To: <urn:uuid:3>"),
    ]
    import struct

    import zstandard

    streamed = b""
    for r in records:  # frames without a content size, with a skippable frame between them
        c = zstandard.ZstdCompressor(write_content_size=False).compressobj()
        streamed += c.compress(r) + c.flush() + struct.pack("<II", 0x184D2A50, 3) + b"abc"
    got = list(warc.read_archive(streamed))
    assert [r["record_type"] for r in got] == ["warcinfo", "request", "response", "metadata", "revisit"]
    assert got[2]["payload"] == b"body" and got[4]["refers_to_id"] == "<urn:uuid:3>" and got[4]["payload"] is None and got[0]["page_id"] is None
    assert list(warc.read_archive(warc.write_archive(records)))[2]["payload_bytes"] == 4 and list(warc.read_archive(b"")) == []
    wrong = make("WARC/1.1", "response", "<urn:uuid:3>", page, "Content-Type: application/http", "WARC-Payload-Digest: md5:00")
    assert warc.parse_record(wrong, strict=False)["payload_bytes"] == 4
    for bad in (wrong, wrong.replace(b"WARC/1.1", b"WARC/9"), wrong.replace(b"content-length:  ", b"content-length:  9"), make("WARC/1.0", "metadata", "<x>", b"a", "no colon")):
        with pytest.raises(ValueError):
            warc.parse_record(bad)


def _paths(t, node):
    if t.final(np.array([node]))[0]:
        yield (), 1.0
        return
    for e in range(t.first[node], t.first[node + 1]):
        for rest, p in _paths(t, int(t.target[e])):
            yield (e, *rest), p * t.prob[e]


def test_sampled_segmentations():
    t = pieces.Tables(pieces.Lattices(SP))
    starts = t.starts(pieces._UNIT.findall("▁the▁cat"))
    every = {a[0] + b[0]: a[1] * b[1] for a, b in itertools.product(*[list(_paths(t, int(w))) for w in starts])}
    assert abs(sum(every.values()) - 1) < 1e-9
    n = 20_000
    keys = np.random.default_rng(1).integers(0, 1 << 64, n, dtype=np.uint64)
    found, least = pieces.samples(t, np.tile(starts, n), np.full(n, 2), keys, 3)
    counts = [Counter(tuple(f[i][0].tolist()) for f in found) for i in range(3)]
    assert all(len({tuple(x[0].tolist()) for x in f}) == 3 for f in found)
    assert all(f[0][2] > f[1][2] > f[2][2] > m for f, m in zip(found, least, strict=True))
    for f in found[:50]:
        assert all(abs(np.exp(x[1]) - every[tuple(x[0].tolist())]) < 1e-8 for x in f)
    p = every
    for path in sorted(every, key=every.get)[-4:]:
        second = sum(p[a] * p[path] / (1 - p[a]) for a in p if a != path)
        third = sum(p[a] * p[b] / (1 - p[a]) * p[path] / (1 - p[a] - p[b]) for a in p for b in p if len({a, b, path}) == 3)
        for got, want in zip(counts, (p[path], second, third), strict=True):
            assert abs(got[path] / n - want) < 0.015
    # the same texts by themselves, and beside others: the same samples
    alone, _ = pieces.samples(t, starts, np.array([2]), keys[7:8], 3)
    assert [(x[0].tolist(), x[1], x[2]) for x in alone[0]] == [(x[0].tolist(), x[1], x[2]) for x in found[7]]


def test_all_segmentations_of_a_short_text():
    t = pieces.Tables(pieces.Lattices(SP))
    starts = t.starts(["▁ab"])
    every = list(_paths(t, int(starts[0])))
    found, least = pieces.samples(t, starts, np.array([1]), np.array([5], np.uint64), 40)
    assert {tuple(x[0].tolist()) for x in found[0]} == {x for x, _ in every} and len(found[0]) == len(every) and least[0] == -np.inf


def test_tables_cleared_and_filled_again():
    """Beyond the limit words go, their room stays; the lattices are those of fresh tables."""
    lattices = pieces.Lattices(SP)
    t = pieces.Tables(lattices, limit=5)
    t.starts(["▁theatre", "▁cat"])
    room = t._room["log"]
    units = ["▁the", "▁ca\u4e0bt", "▁the", "▁x"]
    starts, fresh = t.starts(units), pieces.Tables(lattices)
    assert t._room["log"] is room and set(t.place) == set(units) and starts.tolist() == fresh.starts(units).tolist()
    for name in ("owner", "target", "ids", "prob", "log", "upto", "others", "last", "first"):
        assert getattr(t, name).tolist() == getattr(fresh, name).tolist()
    assert (t.others + 1 == np.diff(t.first)[t.owner]).all() and (t.last == t.final(t.target)).all()
    chars = "▁ca\u4e0bt"
    for path, _ in _paths(t, int(starts[1])):
        ids, same = lattices.spelled(t, np.array(path), chars, chars.encode())
        assert same and lattices.decode(ids) == "ca\u4e0bt"
        assert not lattices.spelled(t, np.array(path), chars, b"other")[1]


def test_minhash_estimate():
    rng = np.random.default_rng(6)
    a = np.unique(rng.integers(0, 1 << 62, 3000, dtype=np.uint64))
    for share in (0.5, 0.8):
        b = np.concatenate([a[: int(len(a) * share)], rng.integers(0, 1 << 62, len(a) - int(len(a) * share), dtype=np.uint64)])
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        x, y = (minhash.packed(minhash.minima(s)) for s in (a, b))
        fields = [(int(w) >> s) & 15 for w in x ^ y for s in range(0, 64, 4)]
        estimate = (sum(f == 0 for f in fields) / minhash.HASHES - 1 / 16) / (1 - 1 / 16)
        assert abs(estimate - true) < 0.2


def test_probes_start_at_home():
    rng = np.random.default_rng(7)
    x = rng.normal(size=(50, 8))
    h = ann.Hashes(8, float(np.linalg.norm(x, axis=1).max()), 0.5, 10)
    sets = ann.border_sets(10, 20)
    for v, keys in zip(x, h.keys(x), strict=True):
        probes = h.probes(v, sets)
        assert len(set(probes.tolist())) == 20 * h.tables
        assert (probes[:: 20] == keys).all()


def test_border_sets_in_order():
    """All valid sets of small tables, by expected cost; each visits the cells that it names."""
    k = 3
    sets = ann.border_sets(k, 1000)
    assert len(sets) == 3**k and len({tuple(r) for r in sets.tolist()}) == 3**k
    assert not any(r[c] and r[2 * k - 1 - c] for r in sets.tolist() for c in range(k))
    h = ann.Hashes(4, 1.0, 0.5, k)
    v = np.array([0.1, 0.2, 0.3, 0.4])
    cells = np.floor(h.project(v[None])[0]).astype(int)
    for t in range(h.tables):
        want = {int(h.key(cells[t] + np.array(d), t)) for d in itertools.product((-1, 0, 1), repeat=k)}
        assert set(h.probes(v, sets)[t * 27 : (t + 1) * 27].tolist()) == want


def test_directions_at_right_angles():
    h = ann.Hashes(63, 1.0, 0.5, 12)
    assert np.allclose(h.directions.T @ h.directions, 64 * np.eye(48))
    assert ann.Hashes(3, 1.0, 0.5, 5).directions.shape == (4, 20)


@pytest.mark.parametrize("dense", [0, 1e9])
def test_best_of_buckets(monkeypatch, dense):
    """Pairs one by one and one matrix product: the same best candidates, those of the named buckets only."""
    monkeypatch.setattr(ann, "DENSE", dense)
    rng = np.random.default_rng(4)
    v, x = rng.normal(size=(300, 8)), rng.normal(size=(30, 8))
    v[100:140] = v[99]  # equal scores
    key, cid = rng.integers(-20, 20, 300), rng.permutation(300) + 7
    keys = [rng.choice(np.arange(-25, 25), m % 9, replace=False) for m in range(30)]
    of, found, score = ann.Buckets(key, cid, v).nearest(x, keys, 5)
    for q in range(30):
        at = np.flatnonzero(np.isin(key, keys[q]))
        s = (v[at] * x[q]).sum(axis=1)
        want = np.lexsort((cid[at], -s))[:5]
        assert found[of == q].tolist() == cid[at][want].tolist() and score[of == q].tolist() == s[want].tolist()
    of, found, _ = ann.Buckets(key, cid, v).nearest(x, None, 5)
    assert found[of == 3].tolist() == cid[np.lexsort((cid, -(v * x[3]).sum(axis=1)))[:5]].tolist()


def test_folding():
    assert toxicity.fold("1d10t IDIOT іdіоt tr@sh l0ser $$$ trash### 55") == " idiot idiot idiot trash loser trash "
    m = toxicity.Matcher({" trash ": 2.0, " mor": 1.0})
    assert [w for w, _ in m.hits(toxicity.fold("a trash can"))] == [] and len(m.hits(toxicity.fold("trash moron"))) == 2
    assert toxicity.Model().score([None, ""]).max() < 0.5
