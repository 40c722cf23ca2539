import hashlib

import pytest
import zstandard

from rootloom.llm import warc
from rootloom.llm.common import scratch

BIG = "<p>" + "long passage é " * 100


def rows(spark, pages, **extra):
    folder = scratch(spark, "t")
    warc.write_archives(pages, folder, **extra)
    return warc.read_archives(spark, folder).collect()


def test_round_trip_with_odd_rows(spark):
    data = [(1, "http://a/ b\r\n", BIG, "x"), (2, None, BIG, "x"), (2, None, BIG, "x"), (3, "u", "small", None), (4, "u", "small", None),
            (None, None, BIG, None), (None, None, None, None), (5, "u", "", ""), (6, "é", "P*M\x18\0\0\0\0 " * 300, ""), (7, "u", "z" * 500_000, "")]
    got = rows(spark, spark.createDataFrame(data, "page_id long, url string, html string, payload string"), salts=3)
    assert len(got) == len(data) and not any(r.error for r in got)
    want = sorted((str(i or ""), "revisit" if h == BIG and i != 2 else "response", len((h or "").encode()),
                   hashlib.sha1((h or "").encode()).hexdigest()) for i, _, h, _ in data)
    assert sorted((r.record_id.removeprefix("urn:page:"), r.record_type, r.payload_bytes, r.payload_digest) for r in got) == want
    assert {r.refers_to for r in got if r.record_type == "revisit"} == {"urn:page:2"}
    assert {bytes(r.payload) for r in got if r.record_id == "urn:page:6"} == {b"P*M\x18\0\0\0\0 " * 300}


def test_empty_table(spark):
    assert rows(spark, spark.createDataFrame([], "page_id long, url string, html string")) == []


def test_dictionary_frame_and_validation():
    raw = b"dictionary " * 30
    digest = hashlib.sha1(b"abc").digest()
    good = warc.record(9, "http://x/", b"abc", digest, None, "2000-01-01T00:00:00Z")
    coder = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(raw))
    lead = warc.struct.pack("<II", warc.DICTIONARY_MAGIC, len(raw)) + raw
    assert [r["payload"] for r in warc.decode_archive(lead + coder.compress(good))] == [b"abc"]
    bad = {"Content-Length": good.replace(b"Content-Length: ", b"Content-Length: 9", 1), "version": good.replace(b"WARC/1.1", b"WARC/9"),
           "missing": good.replace(b"WARC-Date", b"X-Date"), "digest": good.replace(b"abc\r\n", b"abd\r\n")}
    for text in bad.values():
        out = list(warc.decode_archive(lead + coder.compress(text) + coder.compress(good)))
        assert out[0]["error"] and out[1]["payload"] == b"abc"
    assert "cut off" in list(warc.decode_archive((lead + coder.compress(good))[:-2]))[0]["error"]
    with pytest.raises(ValueError):
        warc.parse_record(b"")
