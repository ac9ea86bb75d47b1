"""Zstandard WARC archives: writer and reader.

An archive (``.warc.zst``) begins with a skippable frame holding the
dictionary (itself compressed when that is smaller), followed by one frame per
record. The reader loads the dictionary, finds each frame's end from its block
headers, decodes the frames one by one, and validates the WARC version, the
mandatory headers, Content-Length, the trailing blank lines, and the digest and
length of every stored payload. Archives are read from a DataFrame
``(path, content)``, as ``spark.read.format("binaryFile")`` gives for files, so
they may lie in any store Spark reads.

Writing: records with equal payloads of at least ``min_revisit`` bytes share a
digest; the one with the smallest page_id is a response, the others are
revisits that refer to it. The digest group only keeps its smallest page_id
(a partial aggregate, stored, joined back), so a payload shared by a third of
all pages is no hot task. Each task writes its records to archives of about
``ARCHIVE_BYTES`` of payload; a record larger than that is an archive of its own. The
dictionary of an archive is trained on at most ``SAMPLES`` of its first
payloads (``SAMPLE_BYTES`` bytes of each); it changes sizes only, never contents.

Defined cases: null html is the empty payload, null url the empty target;
rows with a null page_id are never referred to and are responses if no row of
their group has an id; repeated rows holding the smallest page_id are all
responses; empty and very long payloads are kept whole; an empty table writes
no archive. Extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.llm.common import stored

ARCHIVE_BYTES, SAMPLES, SAMPLE_BYTES, DICTIONARY_BYTES = 8 << 20, 256, 4096, 32 << 10
DICTIONARY_FRAME = 0x184D2A5D  # fixed: magic of the dictionary's skippable frame
ZSTD_FRAME = 0xFD2FB528        # fixed: magic of a Zstandard frame
# Fixed: the profile URI of revisits by identical payload digest.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"
SCHEMA = ("page_id bigint, url string, record_type string, payload_bytes bigint, "
          "payload_digest string, refers_to bigint, payload binary")


class WarcError(ValueError):
    """An archive or record that is not well formed."""


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _urn(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def encode_record(page_id, url, payload: bytes, sha1: str, refers_to) -> bytes:
    """One WARC/1.1 record: a response, or a revisit if ``refers_to`` is set."""
    http = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            b"Content-Length: " + str(len(payload)).encode() + b"\r\n\r\n")
    block = http if refers_to is not None else http + payload
    target = "".join((url or "").splitlines())
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: {_urn(page_id)}", f"WARC-Date: {DATE}",
            f"WARC-Target-URI: {target}", "Content-Type: application/http;msgtype=response",
            f"WARC-Payload-Digest: sha1:{sha1}",
            f"WARC-Block-Digest: sha1:{digest(block)}", f"Content-Length: {len(block)}"]
    if refers_to is not None:
        head += [f"WARC-Refers-To: {_urn(refers_to)}", f"WARC-Profile: {PROFILE}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def encode_archive(records: list[bytes], samples: list[bytes]) -> bytes:
    """Dictionary frame, then one frame per record."""
    try:
        dictionary = zstandard.train_dictionary(DICTIONARY_BYTES, samples)
    except zstandard.ZstdError:  # too few samples to train on: use them as they are
        raw = b"".join(samples)[:DICTIONARY_BYTES]
        dictionary = zstandard.ZstdCompressionDict(raw, zstandard.DICT_TYPE_RAWCONTENT)
    body = dictionary.as_bytes()
    packed = zstandard.ZstdCompressor(level=9).compress(body)
    body = packed if len(packed) < len(body) else body
    c = zstandard.ZstdCompressor(level=3, dict_data=dictionary, write_checksum=True,
                                 write_content_size=True)
    return b"".join([struct.pack("<II", DICTIONARY_FRAME, len(body)), body,
                     *(c.compress(r) for r in records)])


def load_dictionary(data: bytes) -> tuple[zstandard.ZstdCompressionDict | None, int]:
    """The dictionary of the leading skippable frame, and where records begin."""
    if len(data) < 8 or struct.unpack_from("<I", data)[0] != DICTIONARY_FRAME:
        return None, 0
    size = struct.unpack_from("<I", data, 4)[0]
    body = data[8:8 + size]
    if len(body) != size:
        raise WarcError("the dictionary frame is cut short")
    if body[:4] == struct.pack("<I", ZSTD_FRAME):
        body = zstandard.ZstdDecompressor().decompress(body)
    return zstandard.ZstdCompressionDict(body), 8 + size


def frame_end(data: bytes, at: int) -> int:
    """End of the frame that starts at ``at``, from its headers alone."""
    try:
        head = zstandard.frame_header_size(data[at:at + 18])
        checksum = zstandard.get_frame_parameters(data[at:at + 18]).has_checksum
    except zstandard.ZstdError as e:
        raise WarcError(f"no frame at byte {at}") from e
    at += head
    last = False
    while not last:
        if at + 3 > len(data):
            raise WarcError("a frame is cut short")
        block = int.from_bytes(data[at:at + 3], "little")
        last, kind, size = block & 1, block >> 1 & 3, block >> 3
        at += 3 + (1 if kind == 1 else size)  # a run-length block holds one byte
    at += 4 * checksum
    if at > len(data):
        raise WarcError("a frame is cut short")
    return at


def decode_archive(data: bytes) -> Iterator[bytes]:
    """The records of an archive, one frame each."""
    dictionary, at = load_dictionary(data)
    d = zstandard.ZstdDecompressor(dict_data=dictionary)
    while at < len(data):
        if len(data) >= at + 8 and 0x184D2A50 <= struct.unpack_from("<I", data, at)[0] < 0x184D2A60:
            at += 8 + struct.unpack_from("<I", data, at + 4)[0]
            if at > len(data):
                raise WarcError("a skippable frame is cut short")
            continue
        end = frame_end(data, at)
        try:
            with d.stream_reader(data[at:end]) as r:
                yield r.readall()
        except zstandard.ZstdError as e:
            raise WarcError(f"the frame at byte {at} does not decode") from e
        at = end


def _page(urn: str) -> int | None:
    body = urn.removeprefix("<urn:page:").removesuffix(">")
    return int(body) if body else None


def decode_record(record: bytes) -> dict:
    """A validated record as a row of ``SCHEMA`` (the payload is null in revisits)."""
    head, sep, rest = record.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if not sep or not lines[0].startswith("WARC/1."):
        raise WarcError("not a WARC record")
    fields = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon:
            raise WarcError(f"a header line without a name: {line!r}")
        fields[name.strip().lower()] = value.strip()
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if name not in fields:
            raise WarcError(f"{name} is missing")
    size = int(fields["content-length"])
    block = rest[:size]
    if len(block) != size or rest[size:] != b"\r\n\r\n":
        raise WarcError("Content-Length does not match the block")
    if "warc-block-digest" in fields and fields["warc-block-digest"] != f"sha1:{digest(block)}":
        raise WarcError("the block does not match its digest")
    http, sep, payload = block.partition(b"\r\n\r\n")
    if not sep:
        raise WarcError("the block is not an HTTP message")
    length = next((int(x.split(b":", 1)[1]) for x in http.split(b"\r\n")[1:]
                   if x.lower().startswith(b"content-length:")), None)
    sha1 = fields.get("warc-payload-digest", "").removeprefix("sha1:")
    kind = fields["warc-type"]
    if kind == "response" and (length != len(payload) or sha1 != digest(payload)):
        raise WarcError("the payload does not match its length or digest")
    if kind == "revisit" and ("warc-refers-to" not in fields or payload):
        raise WarcError("a revisit needs a record to refer to, and no payload")
    return {"page_id": _page(fields["warc-record-id"]), "url": fields.get("warc-target-uri"),
            "record_type": kind, "payload_bytes": length, "payload_digest": sha1,
            "refers_to": _page(fields["warc-refers-to"]) if kind == "revisit" else None,
            "payload": payload if kind == "response" else None}


def _write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    records, samples, size = [], [], 0

    def archive() -> pa.RecordBatch:
        data = encode_archive(records, samples)
        name = f"{hashlib.sha1(data).hexdigest()}.warc.zst"
        return pa.RecordBatch.from_pydict({"path": [name], "content": [data]})

    for b in batches:
        for k in range(b.num_rows):
            page_id, url, html, sha1, refers_to = (b.column(c)[k].as_py() for c in range(5))
            payload = (html or "").encode()
            if records and size + len(payload) > ARCHIVE_BYTES:
                yield archive()
                records, samples, size = [], [], 0
            records.append(encode_record(page_id, url, payload, sha1, refers_to))
            if len(samples) < SAMPLES:
                samples.append(records[-1][:SAMPLE_BYTES])
            size += len(payload)
    if records:
        yield archive()


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([
        ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()),
        ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
        ("refers_to", pa.int64()), ("payload", pa.binary())])
    for b in batches:
        for data in b.column("content"):
            held, size = [], 0
            for record in decode_archive(data.as_py()):
                held.append(decode_record(record))
                size += len(record)
                if size > 4 << 20:
                    yield pa.RecordBatch.from_pylist(held, schema=schema)
                    held, size = [], 0
            if held:
                yield pa.RecordBatch.from_pylist(held, schema=schema)


def base32_sha1(payload) -> F.Column:
    """Bare upper-case base32 of a binary column's SHA-1 (160 bits: 32 digits)."""
    bits = F.sha1(payload)  # 40 hexadecimal digits: four words of 40 bits
    alphabet = F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")
    parts = []
    for k in range(4):
        word = F.conv(F.substring(bits, 10 * k + 1, 10), 16, 10).cast("bigint")
        parts += [F.substring(alphabet, F.shiftright(word, 35 - 5 * j).bitwiseAND(F.lit(31))
                              .cast("int") + 1, F.lit(1)) for j in range(8)]
    return F.concat(*parts)


def plan_records(pages: DataFrame, min_revisit: int = 0) -> DataFrame:
    """``page_id, url, html, sha1, refers_to``: what each row is written as."""
    body = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    keyed = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", "html",
                         base32_sha1(body).alias("sha1"), F.octet_length(body).alias("size"))
    slim = stored(keyed.select("page_id", "sha1", "size"), "warc-keys")
    first = (slim.where(F.col("size") >= min_revisit).groupBy("sha1")
             .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
             .where("n > 1").select("sha1", "first"))
    first = stored(first, "warc-first")
    other = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return keyed.join(first, "sha1", "left").select(
        "page_id", "url", "html", "sha1", F.when(other, F.col("first")).alias("refers_to"))


def write_archives(pages: DataFrame, min_revisit: int = 0) -> DataFrame:
    """``path, content``: the archives of all rows of ``pages(page_id, url, html)``."""
    return plan_records(pages, min_revisit).mapInArrow(_write, "path string, content binary")


def read_archives(archives: DataFrame) -> DataFrame:
    """Every record of ``archives(path, content)``, validated, as ``SCHEMA``."""
    return archives.select("content").mapInArrow(_read, SCHEMA)


def round_trip(pages: DataFrame, min_revisit: int = 0) -> DataFrame:
    """Writes ``pages`` to archives in the shared folder and reads them back."""
    return read_archives(stored(write_archives(pages, min_revisit), "warc-archives"))
