import hashlib
import os
import struct

import duckdb
import pytest
import zstandard

from minutelake.llm import warc

LARGE, OTHER = "<p>é" + "x" * 1200, "<p>" + "y" * 2000
PAGES = [
    (1, "http://a/", LARGE), (2, "http://b/ x\r\ny", LARGE), (3, None, LARGE), (4, "http://c/", "small"), (5, "http://d/", "small"), (6, "u", None), (7, "u", ""),
    (8, "u", "a\r\n\r\nWARC/1.1\r\n"), (9, "ü", OTHER), (9, "ü", OTHER), (3, "again", OTHER), (10, "u", "z" * 300_000), (11, "u", "b" * 999), (12, "u", "b" * 999), (13, "u", "b" * 1000), (14, "u", "b" * 1000),
]
KINDS = "page_id long, url string, html string"


def stored(spark, tmp_path, pages=PAGES):
    spark.createDataFrame([(*r, "x") for r in pages], KINDS + ", digest string").repartition(3).write.parquet(f"{tmp_path}/pages.parquet")
    return str(tmp_path)


def test_what_is_read_back_is_what_was_written(spark, tmp_path):
    found = warc.op8_warc(spark, stored(spark, tmp_path))
    assert found.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    with duckdb.connect() as c:
        c.sql(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
        wanted = c.sql(warc.OP8_SQL).fetchall()
    assert sorted(map(repr, map(tuple, found.collect()))) == sorted(map(repr, wanted))


def test_null_ids_and_no_pages(spark, tmp_path):
    found = warc.op8_warc(spark, stored(spark, tmp_path, [(None, None, LARGE), (5, "u", LARGE), (None, "u", OTHER), (None, "u", OTHER)])).collect()
    assert sorted((r["record_type"], str(r["page_id"]), str(r["refers_to"])) for r in found) == [("response", "5", "None"), ("response", "None", "None"), ("response", "None", "None"), ("revisit", "None", "5")]
    spark.createDataFrame([], KINDS).write.parquet(f"{tmp_path}/none/pages.parquet")
    assert warc.op8_warc(spark, f"{tmp_path}/none").count() == 0


def test_archives_are_plain_zstandard_files(spark, tmp_path):
    pages = spark.createDataFrame([(i, f"http://h/{i}", f"page {i} " * 50) for i in range(400)], KINDS).coalesce(1)
    path = f"file://{tmp_path}/archives"
    warc.write_archives(pages, path, archive_rows=150)
    names = [x for x in os.listdir(f"{tmp_path}/archives") if x.startswith("part")]
    content = open(f"{tmp_path}/archives/{names[0]}", "rb").read()
    magic, size = struct.unpack_from("<II", content)
    assert magic == warc.DICTIONARY
    words = zstandard.ZstdCompressionDict(content[8 : 8 + size])
    assert content[8 + size : 16 + size] == warc.SEPARATOR.encode()
    first = zstandard.ZstdDecompressor(dict_data=words).decompressobj().decompress(content[16 + size :])
    number = first.partition(b"<urn:page:")[2].partition(b">")[0]
    assert first.startswith(b"WARC/1.1\r\n") and first.endswith(b"page %s " % number * 50 + b"\r\n\r\n")
    back = warc.read_archives(spark, path, payloads=True).collect()
    assert {r["page_id"]: (r["url"], r["payload"].decode()) for r in back} == {i: (f"http://h/{i}", f"page {i} " * 50) for i in range(400)}


def archive(*datas, words=b"WARC/1.1 words for the dictionary"):
    held = zstandard.ZstdCompressionDict(words, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    press = zstandard.ZstdCompressor(dict_data=held, write_checksum=True)
    return struct.pack("<II", warc.DICTIONARY, len(words)) + words + b"".join(press.compress(x) for x in datas)


def whole(payload=b"hello", **other):
    made = {"page_id": 1, "url": "u", "payload": payload, "digest": hashlib.sha1(payload).hexdigest(), "refers_to": None, "revisit": False} | other
    return warc.record(**made)


def read(content):
    return [warc.read_row(h, b, "here") for h, b in warc.records(content, "file")]


def test_a_compressed_dictionary_and_other_skippable_frames():
    words = b"WARC/1.1 words for the dictionary"
    packed = zstandard.ZstdCompressor().compress(words)
    content = archive(whole(), whole(b""), words=words)
    content = struct.pack("<II", warc.DICTIONARY, len(packed)) + packed + content[8 + len(words) :] + struct.pack("<II", 0x184D2A53, 3) + b"abc"
    assert [r["payload"] for r in read(content)] == [b"hello", b""]


@pytest.mark.parametrize(("change", "what"), [
    (lambda x: x.replace(b"Content-Length: 5", b"Content-Length: 6"), "payload is not as long"),
    (lambda x: x.replace(b"hello", b"hullo"), "digest"),
    (lambda x: x + b"x", "not as long as content-length"),
    (lambda x: x[:-1], "not as long as content-length"),
    (lambda x: x.replace(b"WARC/1.1", b"WARC/9.9", 1), "no WARC version"),
    (lambda x: x.replace(b"WARC-Date: ", b"WARC-Dote: "), "no warc-date"),
    (lambda x: x.replace(b"WARC-Type: response", b"WARC-Type: metadata"), "type metadata"),
    (lambda x: x.replace(b"\r\n\r\n", b"\r\n"), "headers don't end|no HTTP|not as long"),
    (lambda x: x.replace(b"urn:page", b"urn:pages"), "not a page"),
])
def test_wrong_records_are_told(change, what):
    assert read(archive(whole()))[0]["payload"] == b"hello"
    with pytest.raises(warc.BadArchive, match=what):
        read(archive(change(whole())))


def test_cut_archives_are_told():
    content = archive(whole(), whole())
    for end in (4, 20, len(content) - 1, len(content) - 40):
        with pytest.raises(warc.BadArchive):
            read(content[:end])
    with pytest.raises(warc.BadArchive):
        read(content + b"junk-junk")
    assert read(b"") == []
