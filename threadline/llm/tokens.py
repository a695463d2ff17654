"""Token ids of whole texts by a public tokenizer file."""

from __future__ import annotations

import re
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Byte-level pre-tokenizers always cut before a blank that a visible character follows,
# and between a letter or digit and a sign after it.  Of other white space before a
# visible character all but the last character is a part, and the last one is too
# unless it is a blank, which goes with what follows; at the end of a text it is one part.
_BLANK = 0x20
_WHITE = np.isin(np.arange(256), [0x09, 0x0A, 0x0B, 0x0C, 0x0D, _BLANK])
_SIGN = np.isin(np.arange(256), list(b".,!#$%&*|"))
_ALNUM = np.array([chr(b).isalnum() and b < 128 for b in range(256)])
# lead bytes of two whose characters are letters all (of C3 not the signs of multiplication and division)
_LETTER_LEAD = np.isin(np.arange(256), [*range(0xC4, 0xCA), 0xD0, 0xD1])
# white space beyond ASCII, in UTF-8: texts with it are encoded whole
_WIDE = re.compile(b"\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80")
_PLAIN = re.compile(r" ?[^\W_]+")
_ENCODERS: dict[str, Encoder] = {}


class Encoder:
    """Ids of texts as little-endian 32-bit bytes.

    A text's ids are those of its parts at sure cuts.  Parts seen lately are
    remembered in two generations of at most ``limit``: when the newer is full it
    becomes the older, whose parts come back as they occur.
    """

    def __init__(self, path: str, limit: int = 400_000):
        from tokenizers import Tokenizer

        self.tokenizer, self.limit = Tokenizer.from_file(path), limit
        self.special = [x.content for x in self.tokenizer.get_added_tokens_decoder().values()]
        self.line = self.tokenizer.encode("\n", add_special_tokens=False).ids
        self.byte_level = type(self.tokenizer.pre_tokenizer).__name__ == "ByteLevel" and self.tokenizer.normalizer is None
        if self.byte_level:  # the letter that stands for each byte inside the model
            plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
            others = [b for b in range(256) if b not in plain]
            self.letters = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    @staticmethod
    def of(path: str) -> Encoder:
        """One encoder per worker process and file."""
        if path not in _ENCODERS:
            _ENCODERS[path] = Encoder(path)
        return _ENCODERS[path]

    def _learn(self, new) -> None:
        """Words of letters go to the model itself; other parts without inner white space in one text, a line break after each; its id parts theirs."""
        if self.byte_level:
            tokenize, letters, known = self.tokenizer.model.tokenize, self.letters, self.known
            for p in new:
                if p.isalpha() or (p[:1] == " " and p[1:].isalpha()):
                    known[p] = array("I", [t.id for t in tokenize(p.encode().decode("latin-1").translate(letters))]).tobytes()
        plain = [p for p in new if len(self.line) == 1 and p not in self.known and _PLAIN.fullmatch(p)]
        for i in range(0, len(plain), 500):
            some = plain[i : i + 500]
            ids = np.array(self.tokenizer.encode("\n".join(some) + "\n", add_special_tokens=False).ids, dtype="<u4")
            ends, data = np.flatnonzero(ids == self.line[0]).tolist(), ids.tobytes()
            for p, a, b in zip(some, [-1, *ends], ends, strict=False):
                self.known[p] = data[4 * a + 4 : 4 * b]
        for p in new:
            if p not in self.known:
                self.known[p] = np.array(self.tokenizer.encode(p, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _ids(self, parts: list[str]) -> list[bytes]:
        if len(self.known) > self.limit:
            self.known, self.older = {}, self.known
        known, older = self.known, self.older
        new = []
        for p in parts:
            if p not in known:
                if p in older:
                    known[p] = older[p]
                else:
                    new.append(p)
        self._learn(new)
        return [known[p] for p in parts]

    def encode(self, texts) -> list[bytes]:
        """The ids of each text; None counts as empty."""
        texts = [t or "" for t in texts]
        raw = [t.encode() for t in texts]
        whole = {i for i, (t, x) in enumerate(zip(texts, raw, strict=True)) if any(s in t for s in self.special) or (not t.isascii() and _WIDE.search(x))}
        easy = iter(self._easy([x for i, x in enumerate(raw) if i not in whole]))
        return [np.array(self.tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() if i in whole else next(easy) for i, t in enumerate(texts)]

    def _easy(self, raw: list[bytes]) -> list[bytes]:
        """All texts (in UTF-8) at once: distinct parts are looked up, their ids laid out by numpy."""
        joined = b"".join(raw)
        if not joined:
            return [b""] * len(raw)
        cuts, bounds = _cuts(joined, np.cumsum([0, *map(len, raw)]))
        offsets = np.append(cuts, len(joined)).astype(np.int64)
        parts = pa.LargeStringArray.from_buffers(len(cuts), pa.py_buffer(offsets), pa.py_buffer(joined)).dictionary_encode()
        which = parts.indices.to_numpy()
        found = self._ids(parts.dictionary.to_pylist())
        # a batch's ids are far fewer than 2**31
        size = np.fromiter(map(len, found), np.int32, len(found)) // 4
        flat, first = np.frombuffer(b"".join(found), "<u4"), np.cumsum(size, dtype=np.int32) - size
        each = size[which]
        ends = np.cumsum(each, dtype=np.int32)
        data = flat[np.repeat(first[which] - (ends - each), each) + np.arange(ends[-1], dtype=np.int32)].tobytes()
        at = np.concatenate([[0], ends])[bounds].tolist()
        return [data[4 * a : 4 * b] for a, b in zip(at, at[1:], strict=False)]


def _cuts(joined: bytes, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where parts begin in texts that follow one another (starts: their places, and the end), and how many begin before each text."""
    x = np.frombuffer(joined, np.uint8)
    n = len(x)
    edge = np.zeros(n + 1, bool)  # places where a text begins or the last one ends
    edge[starts] = True
    white = _WHITE[x]
    after = np.zeros(n, bool)  # white space right before, in the same text
    after[1:] = white[:-1]
    after &= ~edge[:-1]
    last = white.copy()  # the last white space before a visible character of the same text
    last[:-1] &= ~white[1:]
    last &= ~edge[1:]
    cut = edge.copy()
    cut[:-1] |= white & ~after  # a run begins
    cut[:-1] |= last & after  # its last character
    cut[1:] |= last & (x != _BLANK)
    signs = np.flatnonzero(_SIGN[x])
    signs = signs[(signs > 0) & ~edge[signs]]
    before = x[signs - 1]
    lead = x[np.maximum(signs - 2, 0)]
    letter = _ALNUM[before] | ((before >= 0x80) & (before < 0xC0) & (signs > 1) & (_LETTER_LEAD[lead] | ((lead == 0xC3) & (before != 0x97) & (before != 0xB7))))
    cut[signs[letter]] = True
    cuts = np.flatnonzero(cut[:-1])
    return cuts, np.searchsorted(cuts, starts)


def batches(texts, most_chars: int = 8_000_000):
    """Index ranges of consecutive texts of about most_chars characters."""
    start = size = 0
    for i, t in enumerate(texts):
        size += len(t or "")
        if size >= most_chars:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)
