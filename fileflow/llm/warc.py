"""WARC archives in Zstandard: writer and reader.

Layout of an archive: a skippable frame (magic 0x184D2A5D) with the dictionary,
then one frame per record, compressed with that dictionary.  The writer puts an
empty skippable frame behind every record, which readers skip: it is what
Spark's text writer takes for its line separator, so archives are written by
Spark's own file commit, to any file system, and a lost task is simply run
again.

Writing: pages are digested natively (SHA-1).  Of the records with equal
payloads of at least ``min_bytes`` the one with the largest page_id is the
response and the others are revisits of it; the largest id of a digest comes
from a partial aggregate, so a payload that a third of all pages share costs one
row a task, and the join with it is split by Spark where it is skewed.

Reading: the archive's dictionary is loaded from the leading skippable frame
(which may be compressed itself), each frame is found by its block headers,
decoded alone, and checked: version line, the four required headers, the length
against Content-Length, the closing blank lines, both digests.  A record that
fails a check is a row with ``error`` and does not stop the archive; after a
broken frame, whose end can't be found, the archive ends with an error row.
Spark reads an archive as one row, so archives should stay well below 2 GB;
the writer's size follows from its partitions.

Defined results: a null html is an empty payload; a null url is an empty
target; rows that repeat the largest page_id of a payload are all responses;
null page_ids are smallest, and a payload of null ids only is all responses
(a revisit of no page can't be named); an empty table writes no archive.
"""

from __future__ import annotations

import base64
import hashlib
import struct

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fileflow.llm.common import chunks, table
from fileflow.session import scratch_path

DICTIONARY_MAGIC = 0x184D2A5D
FRAME_MAGIC = 0xFD2FB528
#: An empty skippable frame (magic 0x184D2A50, size 0), all ASCII.
SEPARATOR = "P*M\x18\x00\x00\x00\x00"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
REQUIRED = ("warc-type", "warc-record-id", "warc-date", "content-length")
#: The largest dictionary, and the most a record may decode to.
DICTIONARY_BYTES, RECORD_BYTES = 64 << 10, 1 << 31


def base32_sha1(payload):
    """Upper-case base32 SHA-1 of a binary column, natively (20 bytes are 32 letters without padding)."""
    digits = F.sha1(payload)
    five = lambda k: F.conv(F.substring(digits, 5 * k + 1, 5), 16, 10).cast("int")  # noqa: E731  20 bits, 4 letters
    letter = lambda v, s: F.substring(F.lit(BASE32), F.shiftright(v, s).bitwiseAND(31) + 1, F.lit(1))
    return F.concat(*[letter(five(k), s) for k in range(8) for s in (15, 10, 5, 0)])


# --- records ---------------------------------------------------------------------------------------

def _uri(page_id) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def record(page_id, url: str, payload: bytes, length: int, digest: str, refers_to) -> bytes:
    """One WARC/1.1 record; a revisit of ``refers_to`` has the headers of its response but no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode()
    revisit = refers_to is not None
    block = http if revisit else http + payload
    target = url.replace("\r", "%0D").replace("\n", "%0A")
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_uri(page_id)}",
             f"WARC-Date: {DATE}", f"WARC-Target-URI: {target}", "Content-Type: application/http; msgtype=response",
             f"WARC-Block-Digest: sha1:{base64.b32encode(hashlib.sha1(block).digest()).decode()}",
             f"WARC-Payload-Digest: sha1:{digest}", f"Content-Length: {len(block)}"]
    if revisit:
        lines += [f"WARC-Refers-To: {_uri(refers_to)}", f"WARC-Profile: {PROFILE}"]
    return "\r\n".join([*lines, "", ""]).encode("utf-8", "surrogatepass") + block + b"\r\n\r\n"


class BadRecord(ValueError):
    """What a check of a record found."""


def parse(data: bytes) -> dict:
    """Headers (lower case) and block of a decoded record, checked."""
    head, blank, rest = data.partition(b"\r\n\r\n")
    if not blank:
        raise BadRecord("no end of headers")
    first, *lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    if first not in ("WARC/1.0", "WARC/1.1"):
        raise BadRecord(f"not a WARC version: {first[:20]}")
    headers: dict[str, str] = {}
    for line in lines:
        name, colon, value = line.partition(":")
        if not colon or not name.strip():
            raise BadRecord(f"not a header: {line[:40]}")
        headers[name.strip().lower()] = value.strip()
    for name in REQUIRED:
        if not headers.get(name):
            raise BadRecord(f"no {name}")
    if not headers["content-length"].isascii() or not headers["content-length"].isdigit():
        raise BadRecord("content-length is no number")
    length = int(headers["content-length"])
    if rest[length:] != b"\r\n\r\n":
        raise BadRecord(f"content-length {length} does not fit a record of {len(rest)} bytes")
    block = rest[:length]
    told = headers.get("warc-block-digest", "")
    if told.startswith("sha1:") and told[5:] != base64.b32encode(hashlib.sha1(block).digest()).decode():
        raise BadRecord("block digest differs")
    return headers | {"": block}


def http_payload(block: bytes) -> tuple[int, bytes]:
    """Content-Length of an HTTP response and its payload."""
    head, blank, payload = block.partition(b"\r\n\r\n")
    if not blank or not head.startswith(b"HTTP/"):
        raise BadRecord("no HTTP response")
    for line in head.split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        if name.strip().lower() == b"content-length" and value.strip().isdigit():
            return int(value), payload
    return len(payload), payload


# --- frames ----------------------------------------------------------------------------------------

def skippable(data: bytes, magic: int = DICTIONARY_MAGIC) -> bytes:
    return struct.pack("<II", magic, len(data)) + data


def frame_end(data, at: int) -> int:
    """Where the Zstandard or skippable frame at ``at`` ends, by its headers."""
    if at + 8 > len(data):
        raise BadRecord("cut off inside a frame header")
    magic, size = struct.unpack_from("<II", data, at)
    if magic & 0xFFFFFFF0 == 0x184D2A50:
        end = at + 8 + size
    elif magic == FRAME_MAGIC:
        flags = data[at + 4]
        single, dictionary, content = flags >> 5 & 1, (0, 1, 2, 4)[flags & 3], (0, 2, 4, 8)[flags >> 6]
        end = at + 5 + (not single) + dictionary + (content or single)
        last = False
        while not last:
            if end + 3 > len(data):
                raise BadRecord("cut off inside a frame")
            block = int.from_bytes(data[end: end + 3], "little")
            last = bool(block & 1)
            end += 3 + (1 if block >> 1 & 3 == 1 else block >> 3)  # a run takes one byte
        end += 4 * (flags >> 2 & 1)  # checksum
    else:
        raise BadRecord("no Zstandard frame")
    if end > len(data):
        raise BadRecord("cut off inside a frame")
    return end


def frames(data):
    """(offset, decoded record or None, error or None) of each record frame of an archive."""
    at, decoder = 0, zstandard.ZstdDecompressor()
    if len(data) >= 8 and struct.unpack_from("<I", data)[0] == DICTIONARY_MAGIC:
        end = frame_end(data, 0)
        dictionary = bytes(data[8:end])
        if dictionary[:4] == struct.pack("<I", FRAME_MAGIC):  # a compressed dictionary
            dictionary = zstandard.ZstdDecompressor().decompressobj().decompress(dictionary)
        decoder = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary))
        at = end
    while at < len(data):
        try:
            end = frame_end(data, at)
        except BadRecord as e:
            yield at, None, str(e)
            return
        if struct.unpack_from("<I", data, at)[0] == FRAME_MAGIC:
            try:
                yield at, decoder.decompressobj().decompress(bytes(data[at:end])), None
            except zstandard.ZstdError as e:
                yield at, None, f"frame can't be decoded: {e}"
        at = end


# --- tables ----------------------------------------------------------------------------------------

def trained_dictionary(pages: DataFrame, rows: int = 200, most: int = 32 << 10) -> bytes:
    """A dictionary from a bounded sample: of the ``rows`` pages that come first by a hash of their id, those of at most ``most`` bytes.

    Empty where the sample is too small to train on; archives then have no dictionary.
    """
    chosen = pages.select("page_id").where("page_id is not null").orderBy(F.xxhash64("page_id"), "page_id").limit(rows)
    some = (pages.where((F.octet_length("html") <= most) & (F.octet_length("html") > 0)).select("page_id", "url", "html")
            .join(F.broadcast(chosen.distinct()), "page_id").limit(rows).collect())
    samples = [record(r["page_id"], r["url"] or "", p := r["html"].encode("utf-8", "surrogatepass"), len(p), BASE32, None) for r in some]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes() if len(samples) >= 8 else b""
    except zstandard.ZstdError:
        return b""


def write_archives(pages: DataFrame, path: str, min_bytes: int = 0, level: int = 3) -> None:
    """Write a record per row of ``pages`` (page_id, url, html) to archives in the folder ``path``."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html",
                        base32_sha1(payload).alias("digest"), F.octet_length(payload).cast("long").alias("n"))
    first = rows.where(F.col("n") >= min_bytes).groupBy(F.col("digest").alias("of")).agg(F.max("page_id").alias("response"))
    told = (rows.join(first, (rows.digest == first.of) & (rows.n >= min_bytes), "left")
            .select("page_id", "url", "n", "digest",
                    F.when(F.col("response").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("response")), F.col("response")).alias("refers_to"),
                    "html")
            .withColumn("html", F.when(F.col("refers_to").isNull(), F.col("html"))))
    dictionary = trained_dictionary(pages)

    def compress(batches):
        known = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        encoder = zstandard.ZstdCompressor(level=level, dict_data=known, write_content_size=True)
        begun = not dictionary
        for batch in batches:
            for part in chunks(batch):
                out = [] if begun else [skippable(dictionary)]
                begun = True
                for r in part.to_pylist():
                    out.append(encoder.compress(record(r["page_id"], r["url"] or "", (r["html"] or "").encode("utf-8", "surrogatepass"),
                                                       r["n"], r["digest"], r["refers_to"])))
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["frame"])

    # the writer puts down the bytes of a string as they are
    (told.mapInArrow(compress, "frame binary").select(F.col("frame").cast("string").alias("value"))
     .write.option("lineSep", SEPARATOR).option("compression", "none").text(path))


RECORD = ("archive string, position long, warc_type string, record_id string, target string, date string, refers_to string, "
          "payload_bytes long, payload_digest string, payload binary, error string")


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """A row per record of the archives in ``path``; ``error`` says which check failed.

    ``payload_bytes`` and ``payload_digest`` are of the full payload: of a
    revisit they come from its headers, of a response they are computed and
    held against them.
    """
    kinds = [pa.string(), pa.int64(), *[pa.string()] * 5, pa.int64(), pa.string(), pa.binary(), pa.string()]
    names = [c.split()[0] for c in RECORD.split(", ")]

    def rows_of(name, data):
        for at, decoded, error in frames(data):
            try:
                if error:
                    raise BadRecord(error)
                h = parse(decoded)
                n, payload = http_payload(h[""]) if "application/http" in h.get("content-type", "") else (len(h[""]), h[""])
                digest = h.get("warc-payload-digest", "")
                if h["warc-type"] != "revisit":
                    if n != len(payload):
                        raise BadRecord(f"HTTP Content-Length {n}, payload {len(payload)} bytes")
                    found = base64.b32encode(hashlib.sha1(payload).digest()).decode()
                    if digest.startswith("sha1:") and digest[5:] != found:
                        raise BadRecord("payload digest differs")
                    digest = "sha1:" + found
                elif "warc-refers-to" not in h:
                    raise BadRecord("a revisit of nothing")
                yield (name, at, h["warc-type"], h["warc-record-id"], h.get("warc-target-uri"), h["warc-date"], h.get("warc-refers-to"),
                       n, digest.removeprefix("sha1:"), payload if payloads else None, None)
            except (BadRecord, UnicodeDecodeError) as e:
                yield (name, at, *[None] * 8, str(e))

    def read(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                name, data = batch.column(0)[i].as_py(), memoryview(batch.column(1)[i].as_buffer())
                out, held = [], 0
                for row in rows_of(name, data):
                    out.append(row)
                    held += len(row[9] or b"") + 200
                    if held > 8 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)
                        out, held = [], 0
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(read, RECORD)


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all ``pages`` to archives, read them back: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    pages = table(spark, sf_dir, "pages")
    path = scratch_path(spark, "warc")
    write_archives(pages, path)
    if not spark.read.format("binaryFile").load(path).select("path").head(1):
        return spark.createDataFrame([], "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")
    page = lambda c: F.regexp_extract(c, r"^<urn:page:(-?\d*)>$", 1)
    number = lambda c: F.when(page(c) != "", page(c).cast("long"))
    return read_archives(spark, path, payloads=False).select(
        number("record_id").alias("page_id"), "payload_bytes", "payload_digest",
        F.coalesce("warc_type", F.raise_error(F.concat(F.lit("archive damaged: "), F.col("error")))).alias("record_type"),
        number("refers_to").alias("refers_to"))


ORACLE = f"""
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS hex FROM pages),
d AS (SELECT *, list_aggregate(flatten(list_transform(range(8), lambda k: list_transform([15, 10, 5, 0],
        lambda s: substr('{BASE32}', ((('0x' || substr(hex, (5 * k + 1)::INT, 5))::INT >> s) & 31) + 1, 1)))), 'string_agg', '') AS digest FROM p),
g AS (SELECT *, max(page_id) OVER (PARTITION BY hex, n) AS response FROM d)
SELECT page_id, n::BIGINT AS payload_bytes, digest AS payload_digest,
       CASE WHEN page_id IS DISTINCT FROM response AND response IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM response THEN response END AS refers_to
FROM g
"""
