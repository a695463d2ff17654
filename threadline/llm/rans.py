"""Token-id files: static range asymmetric numeral system.

One table of frequencies, counted over all ids, is shared by all blocks.  A block
holds the ids of whole documents; its ids are dealt over LANES interleaved coders
(64-bit states, renormalised by 32-bit words) that numpy advances together.
Checkpoints (word offset and lane states) let parts of a block be decoded on
their own; checksums cover states and words, and the ids.

Block layout (little-endian): magic, counts, checksums | initial lane states |
checkpoints | words | zlib of (doc_ids int64, null flags, lengths uint32).

Defined results: null text counts as empty, so it has the end id alone; rows with
equal doc_id stand in the order of their texts' hashes; a null doc_id stands first;
an empty table gives no blocks and no rows; extra columns are ignored.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import batch_rows, partitions, stored
from .tokens import Encoder, batches

MAGIC = b"TLRANS01"
HEAD = struct.Struct("<8sIIIIIII")
SCALE_BITS = 20
LANES = 2048
CHECKPOINT_STEPS = 256
BLOCK_TOKENS = 1 << 20
LOW = np.uint64(1 << 31)


def scaled(counts: np.ndarray) -> np.ndarray:
    """Frequencies of sum 2**SCALE_BITS, at least 1 where a count is."""
    total, size = int(counts.sum()), 1 << SCALE_BITS
    if not total:
        return np.zeros(len(counts), dtype=np.uint64)
    freq = np.where(counts > 0, np.maximum(1, counts * (size / total)), 0).astype(np.int64)
    over = int(freq.sum()) - size
    if over > 0:  # take from the largest, which lose least
        order = np.argsort(-freq, kind="stable")
        for i in order:
            take = min(over, int(freq[i]) - max(1, int(freq[i]) // 2))
            freq[i] -= take
            over -= take
            if not over:
                break
    else:
        freq[np.argmax(freq)] -= over
    return freq.astype(np.uint64)


def tables(freq: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cumulative starts, and the symbol of each slot."""
    start = np.concatenate([[0], np.cumsum(freq)[:-1]]).astype(np.uint64)
    return start, np.repeat(np.arange(len(freq), dtype=np.uint32), freq.astype(np.int64))


def encode_block(ids: np.ndarray, freq: np.ndarray, start: np.ndarray, docs: bytes) -> bytes:
    n, bits, word = len(ids), np.uint64(SCALE_BITS), np.uint64(32)
    steps = -(-n // LANES)
    state = np.full(LANES, LOW, dtype=np.uint64)
    words, marks = [], []
    for t in range(steps - 1, -1, -1):
        s = ids[t * LANES : (t + 1) * LANES]
        f, x = freq[s], state[: len(s)]
        full = x >= (f << np.uint64(63 - SCALE_BITS))
        words.append((x[full] & np.uint64(0xFFFFFFFF)).astype("<u4"))
        x = np.where(full, x >> word, x)
        q, r = np.divmod(x, f)
        state[: len(s)] = (q << bits) + r + start[s]
        if t and t % CHECKPOINT_STEPS == 0:
            marks.append((t, sum(map(len, words)), state.copy()))
    stream = np.concatenate(words[::-1]) if words else np.zeros(0, "<u4")
    body = stream.tobytes()
    points = b"".join(struct.pack("<II", t, len(stream) - behind) + st.astype("<u8").tobytes() for t, behind, st in marks[::-1])
    meta = zlib.compress(docs)
    coded = state.astype("<u8").tobytes() + points + body
    head = HEAD.pack(MAGIC, n, LANES, len(stream), len(marks), len(meta), zlib.crc32(coded), zlib.crc32(ids.astype("<u4").tobytes()))
    return head + coded + meta


def parse_block(block: bytes) -> dict:
    magic, n, lanes, n_words, n_marks, n_meta, coded_crc, ids_crc = HEAD.unpack_from(block)
    if magic != MAGIC:
        raise ValueError("not a token block")
    at = HEAD.size
    if len(block) < n_meta + at or zlib.crc32(block[at : len(block) - n_meta]) != coded_crc:
        raise ValueError("token block is damaged")
    state = np.frombuffer(block, "<u8", lanes, at)
    at += 8 * lanes
    marks = [(0, 0, state)]
    for _ in range(n_marks):
        t, offset = struct.unpack_from("<II", block, at)
        marks.append((t, offset, np.frombuffer(block, "<u8", lanes, at + 8)))
        at += 8 + 8 * lanes
    body = block[at : at + 4 * n_words]
    return {"n": n, "lanes": lanes, "marks": marks, "words": np.frombuffer(body, "<u4"), "docs": zlib.decompress(block[at + 4 * n_words :]), "ids_crc": ids_crc}


def decode_part(p: dict, mark: int, freq: np.ndarray, start: np.ndarray, symbol: np.ndarray) -> np.ndarray:
    """The ids from one checkpoint to the next."""
    lanes, marks = p["lanes"], p["marks"]
    t, at, state = marks[mark]
    steps = -(-p["n"] // lanes)
    until = marks[mark + 1][0] if mark + 1 < len(marks) else steps
    state, out, mask = state.astype(np.uint64), [], np.uint64((1 << SCALE_BITS) - 1)
    words = p["words"].astype(np.uint64)
    for step in range(t, until):
        k = min(lanes, p["n"] - step * lanes)
        x = state[:k]
        slot = x & mask
        s = symbol[slot]
        x = freq[s] * (x >> np.uint64(SCALE_BITS)) + slot - start[s]
        low = np.flatnonzero(x < LOW)
        x[low] = (x[low] << np.uint64(32)) | words[at : at + len(low)]
        at += len(low)
        state[:k] = x
        out.append(s)
    return np.concatenate(out) if out else np.zeros(0, np.uint32)


def decode_block(block: bytes, freq, start, symbol) -> tuple[np.ndarray, bytes]:
    p = parse_block(block)
    ids = np.concatenate([decode_part(p, i, freq, start, symbol) for i in range(len(p["marks"]))]) if p["n"] else np.zeros(0, np.uint32)
    if zlib.crc32(ids.astype("<u4").tobytes()) != p["ids_crc"]:
        raise ValueError("token block has other ids than were written")
    return ids, p["docs"]


def pack_docs(doc_ids: list, lengths: list[int]) -> bytes:
    return np.array([d if d is not None else 0 for d in doc_ids], "<i8").tobytes() + bytes(d is None for d in doc_ids) + np.array(lengths, "<u4").tobytes()


def unpack_docs(data: bytes) -> tuple[list, np.ndarray]:
    n = len(data) // 13
    ids, null = np.frombuffer(data, "<i8", n).tolist(), data[8 * n : 9 * n]
    return [None if x else d for d, x in zip(ids, null, strict=True)], np.frombuffer(data, "<u4", n, 9 * n)


def write(docs: DataFrame, tokenizer: str, end_id: int = 0, n_ids: int = 65_536) -> tuple[DataFrame, DataFrame]:
    """Encode docs (doc_id, text) in ascending doc_id order; (blocks, frequencies), both written tables.

    Ids are below ``n_ids``.  Blocks: part, block (order within the part), payload.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    ordered = rows.repartitionByRange(2 * partitions(spark), "doc_id").sortWithinPartitions(F.asc_nulls_first("doc_id"), F.xxhash64("text"))
    end = np.array([end_id], "<u4").tobytes()

    def tokenize(frames):
        import pandas as pd
        from pyspark import TaskContext

        encoder, part = Encoder.of(tokenizer), TaskContext.get().partitionId()
        block = size = 0
        ids, lens, data = [], [], []

        def flush():
            nonlocal block, size, ids, lens, data
            packed = np.frombuffer(b"".join(data), "<u4").astype("<u2").tobytes()
            row = pd.DataFrame({"part": [part], "block": [block], "docs": [pack_docs(ids, lens)], "ids": [packed]})
            block, size, ids, lens, data = block + 1, 0, [], [], []
            return row

        for f in frames:
            texts, doc_ids = f["text"].tolist(), [None if pd.isna(d) else int(d) for d in f["doc_id"]]
            for a, b in batches(texts):
                for d, e in zip(doc_ids[a:b], encoder.encode(texts[a:b]), strict=True):
                    ids.append(d)
                    data.append(e + end)
                    lens.append(len(e) // 4 + 1)
                    size += lens[-1]
                    if size >= BLOCK_TOKENS:
                        yield flush()
        if ids:
            yield flush()

    def count(frames):
        import pandas as pd

        total = np.zeros(n_ids, np.int64)
        for f in frames:
            for x in f["ids"]:
                total += np.bincount(np.frombuffer(x, "<u2"), minlength=n_ids)
        seen = np.flatnonzero(total)
        yield pd.DataFrame({"id": seen, "n": total[seen]})

    with batch_rows(spark, 1000):
        raw = stored(ordered.mapInPandas(tokenize, "part int, block int, docs binary, ids binary"), "ids")
    with batch_rows(spark, 16):
        freq = stored(raw.select("ids").mapInPandas(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")), "frequencies")
        f = scaled_table(freq, n_ids)

        def encode(frames):
            start, _ = tables(f)
            for x in frames:
                x["payload"] = [encode_block(np.frombuffer(i, "<u2"), f, start, d) for i, d in zip(x["ids"], x["docs"], strict=True)]
                yield x[["part", "block", "payload"]]

        blocks = stored(raw.mapInPandas(encode, "part int, block int, payload binary"), "blocks")
    return blocks, freq


def scaled_table(freq: DataFrame, n_ids: int = 65_536) -> np.ndarray:
    """At most n_ids rows come to the driver: the vocabulary, whatever the input."""
    counts = np.zeros(n_ids, np.int64)
    for r in freq.collect():
        counts[r["id"]] = r["n"]
    return scaled(counts)


def read(blocks: DataFrame, freq: DataFrame) -> DataFrame:
    """Per document: doc_id, start, n_tokens, ids_crc32; every checksum is verified."""
    f = scaled_table(freq)

    def decode(frames):
        import pandas as pd

        start, symbol = tables(f)
        for x in frames:
            for part, block, payload in zip(x["part"], x["block"], x["payload"], strict=True):
                ids, docs = decode_block(payload, f, start, symbol)
                doc_ids, lens = unpack_docs(docs)
                ends = np.cumsum(lens, dtype=np.int64)
                data = ids.astype("<u4").tobytes()
                crcs = [zlib.crc32(data[4 * (e - n) : 4 * e]) for e, n in zip(ends.tolist(), lens.tolist(), strict=True)]
                yield pd.DataFrame({"part": part, "block": block, "doc_id": pd.array(doc_ids, "Int64"), "inside": ends - lens, "n_tokens": lens.astype(np.int64), "ids_crc32": crcs})

    with batch_rows(blocks.sparkSession, 16):
        each = stored(blocks.mapInPandas(decode, "part int, block int, doc_id long, inside long, n_tokens long, ids_crc32 long"), "decoded")
    sizes = each.groupBy("part", "block").agg(F.sum("n_tokens").alias("n"))
    # parts are as many as partitions were asked for; blocks of a part are summed within it
    of_part = sizes.groupBy("part").agg(F.sum("n").alias("n"))
    before_part = of_part.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before_part"))
    before = sizes.join(before_part, "part").select(
        "part", "block", (F.sum("n").over(Window.partitionBy("part").orderBy("block")) - F.col("n") + F.col("before_part")).alias("before")
    )
    return each.join(before, ["part", "block"]).select("doc_id", (F.col("before") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")


def round_trip(spark: SparkSession, docs: DataFrame, tokenizer: str) -> DataFrame:
    return read(*write(docs, tokenizer))
