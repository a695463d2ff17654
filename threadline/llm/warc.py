"""WARC archives in Zstandard: one frame per record, the dictionary in a leading skippable frame.

Of records with equal payloads of at least ``least`` bytes the one with the
smallest page_id is a response, the others revisit it.  Archives are built where
the join on the digest left the rows; one task writes archives of bounded size.
The reader finds each frame from its block headers, checks the version line, the
lengths, the digests and the dictionary, and raises on damage.  It takes records of
all types, of versions 1.0 and 1.1, with any record ids, with folded or unevenly
spaced header lines in any letter case, digests by md5, sha1 or sha256 in hex or
base 32, frames with or without a content size, and archives without a dictionary.

Defined results: null html is an empty payload; null url is an empty target; rows
repeated with the smallest page_id are responses all; a null page_id never is the
smallest unless all are null (then all are responses); an empty table gives no
archives and no rows; extra columns are ignored.  Of records that are no pages of
these archives page_id and refers_to are null (record_id and refers_to_id have the
names); a revisit whose record does not tell the payload's length or sha256 has
nulls there; a digest of another algorithm is not checked, nor that of a truncated
record.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import batch_rows, stored

# Fixed values of the formats.
DICTIONARY_MAGIC = 0x184D2A5D
FRAME_MAGIC = 0xFD2FB528
SKIPPABLE = range(0x184D2A50, 0x184D2A60)
VERSION, VERSIONS = b"WARC/1.1", (b"WARC/1.0", b"WARC/1.1")
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

ARCHIVE_BYTES = 8 << 20
DICTIONARY_BYTES = 64 << 10


def record(page_id, url: str, kind: str, digest: str, n_bytes: int, refers_to, payload: bytes) -> bytes:
    name = lambda x: f"<urn:page:{'null' if x is None else x}>"
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n" + payload
    head = {
        "WARC-Type": kind,
        "WARC-Record-ID": name(page_id),
        "WARC-Date": "1970-01-01T00:00:00Z",
        "WARC-Target-URI": url.replace("\r", "%0D").replace("\n", "%0A"),
        "Content-Type": "application/http; msgtype=response",
        "WARC-Payload-Digest": f"sha256:{digest}",
        "X-Payload-Length": str(n_bytes),
        "Content-Length": str(len(block)),
    }
    if kind == "revisit":
        head |= {"WARC-Refers-To": name(refers_to), "WARC-Profile": PROFILE}
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items())
    return VERSION + b"\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def _agrees(named: str, data: bytes) -> bool | None:
    """Whether data has a digest such as sha1:...; None for an algorithm not known here."""
    kind, _, value = named.partition(":")
    kind = kind.strip().lower().replace("-", "")
    if kind not in ("md5", "sha1", "sha256"):
        return None
    found, value = hashlib.new(kind, data), value.strip()
    return value.lower() == found.hexdigest() or value.upper().rstrip("=") == base64.b32encode(found.digest()).decode().rstrip("=")


def _fields(lines: list[bytes]) -> dict[str, str]:
    """Header fields by lower-case name; the first of repeated ones, folded lines joined."""
    out: dict[str, str] = {}
    name = None
    for line in lines:
        text = line.decode("utf-8", "replace")
        if text[:1] in (" ", "\t") and name:
            out[name] += " " + text.strip()
            continue
        name, colon, value = text.partition(":")
        name = name.strip().lower()
        if not colon or not name:
            raise ValueError("a header line has no name")
        out.setdefault(name, value.strip())
    return out


def _page(name: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)>", name or "")
    return int(found[1]) if found else None


def parse_record(data: bytes, strict: bool = True) -> dict:
    """One record as a row (RECORD); payload is what follows an HTTP header, else the whole block (None for a revisit)."""
    head, gap, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.split(b"\r\n")
    if version not in VERSIONS or not gap:
        raise ValueError("not a WARC record")
    fields = _fields(lines)
    missing = [x for x in ("warc-type", "warc-record-id", "content-length") if x not in fields]
    if missing:
        raise ValueError(f"a record has no {missing[0]}")
    if not fields["content-length"].isdecimal():
        raise ValueError("a record's Content-Length is no number")
    length = int(fields["content-length"])
    if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise ValueError("a record's length differs from its Content-Length")
    block, kind = rest[:length], fields["warc-type"].lower()
    payload = block
    if fields.get("content-type", "").lower().replace(" ", "").startswith("application/http") and block:
        http, gap, payload = block.partition(b"\r\n\r\n")
        first = http.split(b"\r\n", 1)[0]
        if not (first.startswith(b"HTTP/") or b" HTTP/" in first):
            raise ValueError("a record's block has no HTTP header")
    whole = "warc-truncated" not in fields
    if whole and _agrees(fields.get("warc-block-digest", ""), block) is False:
        raise ValueError("a block differs from its digest")
    named, told = fields.get("warc-payload-digest", ""), fields.get("x-payload-length", "")
    told = int(told) if told.isdecimal() else None
    if kind == "revisit":
        if payload and "x-payload-length" in fields:
            raise ValueError("a revisit has a payload")
        size, algorithm, digest = told, *named.partition(":")[::2]
        digest = digest.strip().lower() if algorithm.lower() == "sha256" and len(digest.strip()) == 64 else None
        payload = None
    else:
        if whole and strict and (_agrees(named, payload) is False or (told is not None and told != len(payload))):
            raise ValueError("a payload differs from its digest")
        size, digest = len(payload), hashlib.sha256(payload).hexdigest()
    return {
        "record_id": fields["warc-record-id"],
        "record_type": kind,
        "target_uri": fields.get("warc-target-uri"),
        "refers_to_id": fields.get("warc-refers-to"),
        "page_id": _page(fields["warc-record-id"]),
        "payload_bytes": size,
        "payload_digest": digest,
        "refers_to": _page(fields.get("warc-refers-to")) if kind == "revisit" else None,
        "payload": payload,
    }


def write_archive(records: list[bytes]) -> bytes:
    import zstandard

    samples = records[:: max(1, len(records) // 256)]
    try:
        trained = zstandard.train_dictionary(DICTIONARY_BYTES, samples) if len(samples) >= 16 else None
    except zstandard.ZstdError:  # too little or too uniform to train on
        trained = None
    dictionary = trained or zstandard.ZstdCompressionDict(samples[0][:DICTIONARY_BYTES], zstandard.DICT_TYPE_RAWCONTENT)
    content = dictionary.as_bytes()
    compressor = zstandard.ZstdCompressor(dict_data=dictionary, write_checksum=True)
    return struct.pack("<II", DICTIONARY_MAGIC, len(content)) + content + b"".join(map(compressor.compress, records))


def frame_end(data: bytes, at: int) -> int:
    """Where the frame that starts at ``at`` ends, by its block headers."""
    import zstandard

    if at + 6 > len(data):
        raise ValueError("the archive ends inside a frame")
    if struct.unpack_from("<I", data, at)[0] != FRAME_MAGIC:
        raise ValueError("no Zstandard frame where one must start")
    start, checksum = at, data[at + 4] >> 2 & 1
    at += zstandard.frame_header_size(data[start : start + 18])
    while True:
        if at + 3 > len(data):
            raise ValueError("the archive ends inside a frame")
        head = int.from_bytes(data[at : at + 3], "little")
        last, kind, size = head & 1, head >> 1 & 3, head >> 3
        at += 3 + (1 if kind == 1 else size)
        if last:
            break
    at += 4 * checksum
    if at > len(data):
        raise ValueError("the archive ends inside a frame")
    return at


def _decoded(reader, frame: bytes) -> bytes:
    """The bytes of one frame, whether or not its header tells their number."""
    stream = reader.decompressobj()
    out = stream.decompress(frame)
    if not stream.eof:
        raise ValueError("the archive ends inside a frame")
    return out


def read_archive(data: bytes, strict: bool = True):
    """The records of one archive."""
    import zstandard

    if not data:
        return
    if len(data) < 8:
        raise ValueError("the archive ends inside a frame")
    magic, size = struct.unpack_from("<II", data)
    at, reader = 0, zstandard.ZstdDecompressor()
    if magic == DICTIONARY_MAGIC:
        if 8 + size > len(data):
            raise ValueError("the archive ends inside its dictionary")
        content = data[8 : 8 + size]
        if content[:4] == struct.pack("<I", FRAME_MAGIC):  # the dictionary itself may be compressed
            content = _decoded(reader, content)
        at, reader = 8 + size, zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(content))
    elif magic != FRAME_MAGIC:
        raise ValueError("the archive has no leading dictionary frame")
    while at < len(data):
        if at + 8 <= len(data) and struct.unpack_from("<I", data, at)[0] in SKIPPABLE:
            at += 8 + struct.unpack_from("<I", data, at + 4)[0]
            continue
        end = frame_end(data, at)
        yield parse_record(_decoded(reader, data[at:end]), strict)
        at = end


def write(pages: DataFrame, least: int = 100) -> DataFrame:
    """Archives of pages (page_id, url, html): a stored table with one archive per row, ``content``."""
    body = F.encode(F.coalesce("html", F.lit("")), "utf-8")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce("url", F.lit("")).alias("url"), body.alias("payload"))
    rows = rows.withColumns({"digest": F.sha2("payload", 256), "n_bytes": F.octet_length("payload").cast("long")})
    first = rows.where(F.col("n_bytes") >= least).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    typed = rows.join(first, "digest", "left").withColumn("revisit", F.coalesce(~F.col("page_id").eqNullSafe(F.col("first")) & F.col("first").isNotNull(), F.lit(False)))
    typed = typed.select("page_id", "url", "digest", "n_bytes", "revisit", "first", F.when(~F.col("revisit"), F.col("payload")).alias("payload"))

    def build(frames):
        import pandas as pd

        held, size = [], 0
        number = lambda x: None if pd.isna(x) else int(x)
        for f in frames:
            for r in f.itertuples(index=False):
                held.append(record(number(r.page_id), r.url, "revisit" if r.revisit else "response", r.digest, r.n_bytes, number(r.first), bytes(r.payload or b"")))
                size += len(held[-1])
                if size >= ARCHIVE_BYTES:
                    yield pd.DataFrame({"content": [write_archive(held)]})
                    held, size = [], 0
        if held:
            yield pd.DataFrame({"content": [write_archive(held)]})

    with batch_rows(pages.sparkSession, 256):
        return stored(typed.mapInPandas(build, "content binary"), "archives")


RECORD = "record_id string, record_type string, target_uri string, refers_to_id string, page_id long, payload_bytes long, payload_digest string, refers_to long"


def read(archives: DataFrame, payloads: bool = False, strict: bool = True) -> DataFrame:
    """One row per record of a table with ``content`` (as the binaryFile source gives it).

    Not ``strict``, payloads may differ from their digests: crawlers also take them of decoded bodies.
    """
    schema = RECORD + ", payload binary" * payloads
    names = [c.split()[0] for c in schema.split(", ")]

    def parse(frames):
        import pandas as pd

        for f in frames:
            for content in f["content"]:
                rows = pd.DataFrame(list(read_archive(content, strict)), columns=[*names, *["payload"] * (not payloads)])[names]
                yield rows.astype({"page_id": "Int64", "payload_bytes": "Int64", "refers_to": "Int64"})

    with batch_rows(archives.sparkSession, 4):
        return stored(archives.select("content").mapInPandas(parse, schema), "records")


def read_files(spark: SparkSession, path: str, **options) -> DataFrame:
    """Records of the .warc.zst files under a path; a file goes to one task, so it must fit its memory."""
    return read(spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").option("recursiveFileLookup", "true").load(path), **options)
