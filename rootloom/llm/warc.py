"""Zstandard WARC archives: one frame per record, the dictionary in a leading skippable frame.

Writing uses Spark's text writer (its commit protocol survives lost executors): a row is a frame, the
line separator is an empty skippable frame, so that a file is one valid Zstandard stream. Each
partition is an archive. Reading decodes an archive per `binaryFile` row, one record at a time.

Defined cases: a null payload is an empty one; a null id gives an empty record name; rows equal in id and
payload are both responses; a null id with a known copy revisits it; an empty table gives archives without records.
Other columns of the input are not looked at.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator
from urllib.parse import quote, unquote

from pyspark.sql import DataFrame, SparkSession, functions as F

DICTIONARY_MAGIC = 0x184D2A5D
SKIPPABLE = range(0x184D2A50, 0x184D2A60)
FRAME_MAGIC = 0xFD2FB528
#: An empty skippable frame, which is plain ASCII.
SEPARATOR = struct.pack("<II", 0x184D2A50, 0).decode("ascii")
VERSIONS = (b"WARC/1.0", b"WARC/1.1")
REQUIRED = ("warc-type", "warc-record-id", "warc-date", "content-length")
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORDS = ("archive string, frame long, record_type string, record_id string, refers_to string, target_uri string, "
           "payload_bytes long, payload_digest string, payload binary, error string")


# ------------------------------------------------------------------- writing
def train_dictionary(samples: list[bytes], size: int = 65_536) -> bytes:
    """A dictionary of at most `size` bytes; empty when the samples are too few to train one."""
    import zstandard
    try:
        return zstandard.train_dictionary(size, [s for s in samples if s]).as_bytes()
    except zstandard.ZstdError:
        return b""


def record(page_id, url: str | None, payload: bytes, digest: bytes, refers_to, date: str) -> bytes:
    """One WARC record: a response with its HTTP block, or a revisit with the HTTP head alone."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if refers_to is not None else head + payload
    name = "" if page_id is None else quote(str(page_id), safe="")
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{name}>",
             f"WARC-Date: {date}", f"WARC-Payload-Digest: sha1:{base64.b32encode(digest).decode()}",
             "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {quote(url, safe=':/?#[]@!$&()*+,;=%~')}")
    if refers_to is not None:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{quote(str(refers_to), safe='')}>"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def with_revisits(pages: DataFrame, least_bytes: int, salts: int) -> DataFrame:
    """Payload, digest and, for copies of a payload of at least `least_bytes`, the id they refer to.

    Copies are counted per digest before the shuffle; the join deals each digest out over `salts` keys.
    """
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", payload.alias("payload")).withColumn("digest", F.unhex(F.sha1("payload")))
    keepers = (rows.where(F.octet_length("payload") >= least_bytes).groupBy("digest")
               .agg(F.max("page_id").alias("keeper"), F.count("*").alias("n")).where("n > 1 and keeper is not null")
               .select("digest", "keeper", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt")))
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(salts)).cast("int"))
    other = F.col("page_id").isNull() | (F.col("page_id") < F.col("keeper"))
    return salted.join(keepers, ["digest", "salt"], "left").select(
        "page_id", "url", "payload", "digest", F.when(other, F.col("keeper")).alias("refers_to"))


def write_archives(pages: DataFrame, folder: str, least_bytes: int = 1000, salts: int = 8, samples: int = 500,
                   level: int = 3, date: str = "2000-01-01T00:00:00Z") -> None:
    """Write (page_id, url, html) as archives. The dictionary is fitted on `samples` payloads of at most 16 KB."""
    import zstandard
    start = F.substring(F.col("html").cast("string").cast("binary"), 1, 16_384)
    raw = train_dictionary([bytes(r[0]) for r in pages.select(start).limit(samples).collect() if r[0] is not None])
    packed = zstandard.ZstdCompressor().compress(raw)

    def frames(batches: Iterator) -> Iterator:
        import pyarrow as pa
        extra = {"dict_data": zstandard.ZstdCompressionDict(raw)} if raw else {}
        coder = zstandard.ZstdCompressor(level=level, write_checksum=True, **extra)
        first = [struct.pack("<II", DICTIONARY_MAGIC, len(packed)) + packed] if raw else []
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            made = first + [coder.compress(record(i, u, p, d, r, date)) for i, u, p, d, r in zip(*columns)]
            first = []
            yield pa.RecordBatch.from_arrays([pa.array(made, pa.binary())], ["frame"])

    rows = with_revisits(pages, least_bytes, salts).mapInArrow(frames, "frame binary")
    rows.select(F.col("frame").cast("string")).write.option("lineSep", SEPARATOR).option("maxRecordsPerFile", 0).text(folder)


# ------------------------------------------------------------------- reading
def frame_end(data, at: int) -> int:
    """Where the frame that begins at `at` ends; from its header and block sizes, without decoding."""
    import zstandard
    magic = int.from_bytes(data[at:at + 4], "little")
    if magic in SKIPPABLE:
        end = at + 8 + int.from_bytes(data[at + 4:at + 8], "little")
    elif magic == FRAME_MAGIC:
        checked, end, last = data[at + 4] & 4, at + zstandard.frame_header_size(data[at:at + 18]), 0
        while not last:
            head = int.from_bytes(data[end:end + 3], "little")
            last = head & 1 or end >= len(data)
            end += 3 + (1 if head >> 1 & 3 == 1 else head >> 3)
        end += 4 if checked else 0
    else:
        raise ValueError(f"no frame at byte {at}")
    if end > len(data):
        raise ValueError(f"the frame at byte {at} is cut off")
    return end


def parse_record(data: bytes) -> dict:
    """Check and take apart one record; raises ValueError with the reason."""
    head, found, rest = data.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not found or lines[0] not in VERSIONS:
        raise ValueError("no WARC version line or no end of the header")
    pairs = [line.partition(b":") for line in lines[1:]]
    if any(not sep for _, sep, _ in pairs):
        raise ValueError("a header line without a colon")
    fields = {k.decode().strip().lower(): v.decode().strip() for k, _, v in pairs}
    if missing := [k for k in REQUIRED if k not in fields]:
        raise ValueError("missing " + ", ".join(missing))
    if not fields["content-length"].isdigit():
        raise ValueError("Content-Length is no number")
    size = int(fields["content-length"])
    if len(rest) != size + 4 or rest[size:] != b"\r\n\r\n":
        raise ValueError(f"Content-Length {size}, but {len(rest) - 4} bytes")
    kind, block = fields["warc-type"], rest[:size]
    payload, stated = block, len(block)
    if kind in ("response", "revisit"):
        top, found, payload = block.partition(b"\r\n\r\n")
        length = [x.partition(b":")[2].strip() for x in top.split(b"\r\n")[1:] if x.lower().startswith(b"content-length:")]
        if not found or not length or not length[0].isdigit():
            raise ValueError("no HTTP head with a Content-Length")
        stated = int(length[0])
    method, _, code = fields.get("warc-payload-digest", "").partition(":")
    digest = base64.b32decode(code) if method == "sha1" else b""
    if kind == "response" and (len(payload) != stated or digest and hashlib.sha1(payload).digest() != digest):
        raise ValueError("the payload is not the one that length and digest state")
    if kind == "revisit" and (payload or not digest or "warc-refers-to" not in fields):
        raise ValueError("a revisit needs a digest, a record that it refers to, and no payload")
    return {"record_type": kind, "record_id": fields["warc-record-id"].strip("<>"),
            "refers_to": fields["warc-refers-to"].strip("<>") if "warc-refers-to" in fields else None,
            "target_uri": unquote(fields["warc-target-uri"]) if "warc-target-uri" in fields else None,
            "payload_bytes": stated, "payload_digest": (digest or hashlib.sha1(payload).digest()).hex(), "payload": payload}


def decode_archive(data) -> Iterator[dict]:
    """The records of one archive in order; a bad frame or record gives a row with `error`."""
    import zstandard
    at, number, extra = 0, 0, {}
    if len(data) >= 8 and int.from_bytes(data[:4], "little") == DICTIONARY_MAGIC:
        at = frame_end(data, 0)
        raw = bytes(data[8:at])
        if raw[:4] == FRAME_MAGIC.to_bytes(4, "little"):
            raw = zstandard.ZstdDecompressor().decompressobj().decompress(raw)
        extra = {"dict_data": zstandard.ZstdCompressionDict(raw)}
    decoder = zstandard.ZstdDecompressor(**extra)
    while at < len(data):
        try:
            end = frame_end(data, at)
        except (ValueError, zstandard.ZstdError) as reason:
            yield {"frame": number, "error": str(reason)}
            return
        if int.from_bytes(data[at:at + 4], "little") == FRAME_MAGIC:
            try:
                yield {"frame": number} | parse_record(decoder.decompressobj().decompress(bytes(data[at:end])))
            except (ValueError, zstandard.ZstdError) as reason:
                yield {"frame": number, "error": str(reason)}
            number += 1
        at = end


def read_archives(spark: SparkSession, folder: str, payloads: bool = True, strict: bool = True, batch_bytes: int = 8_388_608) -> DataFrame:
    """All records (columns RECORDS) of the archives in a folder. strict: a bad record fails the job."""
    names = [x.split()[0] for x in RECORDS.split(", ")]

    def records(batches: Iterator) -> Iterator:
        import pyarrow as pa
        kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary(), pa.string()]

        def batch_of(rows):
            return pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in rows], k) for n, k in zip(names, kinds)], names)
        for batch in batches:
            for path, content in zip(batch.column("path"), batch.column("content")):
                rows, size = [], 0
                for r in decode_archive(memoryview(content.as_buffer())):
                    if strict and r.get("error"):
                        raise ValueError(f"{path}, frame {r['frame']}: {r['error']}")
                    if not payloads:
                        r.pop("payload", None)
                    rows.append(r | {"archive": path.as_py()})
                    size += 200 + len(r.get("payload") or b"")
                    if size > batch_bytes:
                        yield batch_of(rows)
                        rows, size = [], 0
                yield batch_of(rows)

    files = spark.read.format("binaryFile").load(folder).select("path", "content")
    return files.mapInArrow(records, RECORDS)
