"""WARC archives in Zstandard: a dictionary in the leading skippable frame, then one frame for each record.

Archives are written by Spark's text writer (its rows are bytes, and its line separator is an empty skippable frame),
so they lie in any store that Spark writes to; they are read through ``binaryFile``. A task writes one archive at a
time and bounds it by ``ARCHIVE_ROWS``.

The reader loads the dictionary, decodes frame after frame and checks of each record: the version line, the headers
that it needs, the content length, the two line ends after the block, that the frame holds this record alone, and for
responses the digest of the payload. What is wrong is an error that names the archive and the place.

Edge cases: a null payload is empty. A null page_id counts as smaller than any and comes back null. Rows repeated with
the largest page_id of a payload are all responses. A null url is left out of the record. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from minutelake.llm.common import new_folder, small_batches, table

# fixed values: the frames of the Zstandard format and of dictionaries in WARC archives
SKIPPABLE = 0x184D2A50
DICTIONARY = 0x184D2A5D
FRAME = 0xFD2FB528
#: an empty skippable frame, as text: what the text writer puts between records
SEPARATOR = struct.pack("<II", SKIPPABLE, 0).decode("ascii")

VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CAPTURED = "1970-01-01T00:00:00Z"
ID = "urn:page:"

#: payloads from this many bytes on are stored once
REVISIT_BYTES = 1000
#: bytes that the reader takes at once
CHUNK = 16_384
#: records of an archive
ARCHIVE_ROWS = 5000
#: payloads and bytes of each that the dictionary of an archive is trained on, and its own size
SAMPLES, SAMPLE_BYTES, DICTIONARY_BYTES = 256, 4096, 16_384


def record_id(page_id: int | None) -> str:
    return f"<{ID}{'' if page_id is None else page_id}>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """A response with its payload, or a revisit without; the HTTP header tells the payload's length in both."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", record_id(page_id)), ("WARC-Date", CAPTURED)]
    if url is not None:
        head.append(("WARC-Target-URI", "".join(c if c > " " else f"%{ord(c):02X}" for c in url)))
    head.append(("WARC-Payload-Digest", f"sha1:{digest}"))
    if revisit:
        head += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", record_id(refers_to))]
    head += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    lines = "".join(f"{k}: {v}\r\n" for k, v in head).encode()
    return VERSION + b"\r\n" + lines + b"\r\n" + block + b"\r\n\r\n"


def trained(payloads: list[bytes]):
    """A dictionary of the archive's first payloads; raw content where they are too few to train on."""
    import zstandard

    samples = [x[:SAMPLE_BYTES] for x in payloads[:SAMPLES] if x]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples)
    except zstandard.ZstdError:
        return zstandard.ZstdCompressionDict(b"".join(samples)[:DICTIONARY_BYTES] or VERSION * 2, dict_type=zstandard.DICT_TYPE_RAWCONTENT)


def frames(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A dictionary frame, then a frame for each row (page_id, url, payload, digest, refers_to, revisit)."""
    import zstandard

    press = None
    for batch in batches:
        rows = batch.to_pylist()
        out = []
        if press is None and rows:
            words = trained([r["payload"] for r in rows])
            out.append(struct.pack("<II", DICTIONARY, len(words.as_bytes())) + words.as_bytes())
            press = zstandard.ZstdCompressor(level=3, dict_data=words, write_checksum=True, write_content_size=True)
        out += [press.compress(record(**r)) for r in rows]
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["frame"])


def plan_records(pages: DataFrame, revisit_bytes: int = REVISIT_BYTES) -> DataFrame:
    """(page_id, url, payload, digest, refers_to, revisit) of each page."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce("html", F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    large = F.octet_length("payload") >= revisit_bytes
    # only payloads that come more than once; a summary of a row for each, so nothing of a hot payload is gathered
    first = rows.where(large).groupBy(F.col("digest").alias("__digest"), F.octet_length("payload").alias("__bytes")).agg(F.max("page_id").alias("first"), F.count("*").alias("n"))
    rows = rows.join(first.where("n > 1 AND first IS NOT NULL"), (F.col("digest") == F.col("__digest")) & (F.octet_length("payload") == F.col("__bytes")), "left")
    again = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return rows.select("page_id", "url", "payload", "digest", F.when(again, F.col("first")).alias("refers_to"), again.alias("revisit"))


def write_archives(pages: DataFrame, path: str, archive_rows: int = ARCHIVE_ROWS) -> None:
    """Writes the pages as archives into the folder ``path``."""
    small_batches(pages.sparkSession)
    made = plan_records(pages).mapInArrow(archives(archive_rows), "frame binary")
    made.select(F.col("frame").cast("string").alias("value")).write.option("lineSep", SEPARATOR).text(path)


def archives(rows: int):
    """``frames`` with a new dictionary after so many rows: a file may hold several archives one after the other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = 0, iter(batches)
        while (batch := next(held, None)) is not None:
            at = batch.num_rows

            def part(first: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
                nonlocal at
                yield first
                while at < rows and (more := next(held, None)) is not None:
                    at += more.num_rows
                    yield more

            yield from frames(part(batch))

    return run


class BadArchive(ValueError):
    """An archive that isn't as it should be."""


def check(good: bool, where: str, what: str) -> None:
    if not good:
        raise BadArchive(f"{where}: {what}")


def records(content: bytes, name: str) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of each record of an archive."""
    import zstandard

    at, unpress = 0, None
    while at < len(content):
        where = f"{name} at byte {at}"
        check(len(content) - at >= 8, where, "a frame is cut off")
        magic, size = struct.unpack_from("<II", content, at)
        if magic & 0xFFFFFFF0 == SKIPPABLE:
            check(at + 8 + size <= len(content), where, "a skippable frame is cut off")
            if magic == DICTIONARY:
                words = content[at + 8 : at + 8 + size]
                if words[:4] == struct.pack("<I", FRAME):  # the dictionary may be compressed itself
                    words = zstandard.ZstdDecompressor().decompress(words)
                unpress = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(words))
            at += 8 + size
            continue
        check(magic == FRAME, where, "no Zstandard frame")
        unpress = unpress or zstandard.ZstdDecompressor()
        one, data = unpress.decompressobj(), []
        try:
            while not one.eof and at < len(content):
                data.append(one.decompress(content[at : at + CHUNK]))
                at += CHUNK
        except zstandard.ZstdError as wrong:
            raise BadArchive(f"{where}: {wrong}") from wrong
        check(one.eof, where, "a record's frame is cut off")
        at = min(at, len(content)) - len(one.unused_data)
        yield parsed(b"".join(data), where)


def parsed(data: bytes, where: str) -> tuple[dict[str, str], bytes]:
    head, gap, rest = data.partition(b"\r\n\r\n")
    check(bool(gap), where, "the headers don't end")
    lines = head.split(b"\r\n")
    check(lines[0] in (b"WARC/1.0", b"WARC/1.1"), where, "no WARC version")
    headers = {}
    for line in lines[1:]:
        key, colon, value = line.partition(b":")
        check(bool(colon) and bool(key.strip()), where, "a header without a name")
        headers[key.strip().lower().decode()] = value.strip().decode()
    for key in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        check(key in headers, where, f"no {key}")
    check(headers["content-length"].isdigit(), where, "content-length is no number")
    size = int(headers["content-length"])
    check(len(rest) == size + 4 and rest[size:] == b"\r\n\r\n", where, "the block is not as long as content-length")
    return headers, rest[:size]


def page_of(identifier: str, where: str) -> int | None:
    check(identifier.startswith(f"<{ID}") and identifier.endswith(">"), where, f"not a page's record: {identifier}")
    number = identifier[len(ID) + 1 : -1]
    return int(number) if number else None


def read_row(headers: dict[str, str], block: bytes, where: str) -> dict:
    kind, digest = headers["warc-type"], headers.get("warc-payload-digest", "").removeprefix("sha1:")
    check(kind in ("response", "revisit"), where, f"a record of type {kind}")
    http, gap, payload = block.partition(b"\r\n\r\n")
    check(bool(gap) and http.startswith(b"HTTP/"), where, "no HTTP header")
    sizes = [x.partition(b":")[2] for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")]
    check(len(sizes) == 1 and sizes[0].strip().isdigit(), where, "no length of the payload")
    size = int(sizes[0])
    if kind == "response":
        check(len(payload) == size, where, "the payload is not as long as its header says")
        check(hashlib.sha1(payload).hexdigest() == digest, where, "the payload doesn't match its digest")
    else:
        check(not payload, where, "a revisit with a payload")
    refers = page_of(headers["warc-refers-to"], where) if kind == "revisit" else None
    return {"page_id": page_of(headers["warc-record-id"], where), "payload_bytes": size, "payload_digest": digest, "record_type": kind, "refers_to": refers, "url": headers.get("warc-target-uri"), "payload": payload if kind == "response" else None}


READ = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("url", pa.string()), ("payload", pa.binary())])


def read_archives(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """The records of all archives below ``path``; with their payloads (null for revisits) if asked for."""
    names = [n for n in READ.names if payloads or n != "payload"]
    kept = pa.schema([READ.field(n) for n in names])
    kinds = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string" + ", payload binary" * payloads

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                held = []
                for headers, block in records(content.as_py(), name):
                    row = read_row(headers, block, f"{name}, {headers['warc-record-id']}")
                    held.append({n: row[n] for n in names})
                    if len(held) == 1000:
                        yield pa.RecordBatch.from_pylist(held, schema=kept)
                        held = []
                yield pa.RecordBatch.from_pylist(held, schema=kept)

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, kinds)


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "archives")
    write_archives(table(spark, sf_dir, "pages"), path)
    return read_archives(spark, path).drop("url")


OP8_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS digest, octet_length(encode(coalesce(html, ''))) AS n FROM pages),
f AS (SELECT digest, n, max(page_id) AS first FROM p WHERE n >= 1000 GROUP BY 1, 2)
SELECT page_id, CAST(p.n AS BIGINT) AS payload_bytes, p.digest AS payload_digest,
  CASE WHEN first IS NOT NULL AND page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM p LEFT JOIN f ON f.digest = p.digest AND f.n = p.n
"""
