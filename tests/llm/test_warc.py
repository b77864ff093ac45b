import base64
import glob
import hashlib
import io

import pytest
import zstandard

from tests.llm.conftest import SF_DIR
from tidelane.llm import warc
from tidelane.llm.queries import QUERIES


def brute(rows, least=0):
    first = {}
    for i, html in rows:
        payload = (html or "").encode()
        if len(payload) >= least and i is not None:
            first[payload] = min(first.get(payload, i), i)
    for i, html in rows:
        payload = (html or "").encode()
        refers = first.get(payload)
        again = refers is not None and refers != i
        yield i, len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode(), "revisit" if again else "response", refers if again else None


def test_query(spark):
    for sf in (SF_DIR, "/root/testdata/sf0.01"):
        rows = [(r.page_id, r.html) for r in spark.read.parquet(f"{sf}/pages.parquet").collect()]
        have = QUERIES["op9_zstd_archives"](spark, sf).collect()
        assert sorted(tuple(r)[:5] for r in have) == sorted(brute(rows)) and all(r.error is None for r in have)


ODD = [(1, "http://a b\n.com", "<p>é</p>"), (2, None, "<p>é</p>"), (2, "u", "<p>é</p>"), (3, "u", None), (4, "u", ""), (None, "u", ""), (None, "u", "alone"), (None, "u", "alone"), (7, "u", "x\r\n\r\n" * 30000), (0, "u", "\x00\x01WARC/1.1")]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, payload string, size int")


@pytest.mark.parametrize("least", [0, 5])
def test_odd_rows(spark, tmp_path, least):
    warc.write_archives(frame(spark, ODD), str(tmp_path / "a"), least_payload=least, archive_bytes=50000)
    have = warc.read_archives(spark, str(tmp_path / "a")).collect()
    assert all(r.error is None for r in have) and len(glob.glob(str(tmp_path / "a/part-*"))) > 1
    number = lambda x: None if x is None or x.endswith("null") else int(x.rpartition(":")[2])
    key = lambda t: tuple(map(str, t))
    assert sorted(((number(r.record_id), r.payload_bytes, r.payload_digest, r.record_type, number(r.refers_to)) for r in have), key=key) == sorted(brute([(i, h) for i, _, h in ODD], least), key=key)
    assert {bytes(r.payload).decode() for r in have if r.record_type == "response"} == {h or "" for _, _, h in ODD}
    assert {r.url for r in have} == {"http://a%20b%0A.com", "urn:none", "u"}


def test_no_rows(spark, tmp_path):
    warc.write_archives(frame(spark, ODD).limit(0), str(tmp_path / "a"))
    assert warc.read_archives(spark, str(tmp_path / "a")).count() == 0


def test_other_readers_can_read_an_archive(spark, tmp_path):
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet")
    warc.write_archives(pages, str(tmp_path / "a"))
    (path,) = glob.glob(str(tmp_path / "a/part-*"))
    data = open(path, "rb").read()
    magic, start, end = next(warc.frames(memoryview(data)))
    assert magic == warc.DICTIONARY_MAGIC and start == 0
    reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(data[8:end]))
    whole = reader.stream_reader(io.BytesIO(data), read_across_frames=True).read()
    assert whole.count(b"WARC-Record-ID") == pages.count() and len(data) < len(whole) / 2


def archive(*records, dictionary=b"", compress=True):
    writer = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)
    inner = zstandard.ZstdCompressor().compress(dictionary) if compress else dictionary
    head = warc.struct.pack("<II", warc.DICTIONARY_MAGIC, len(inner)) + inner if dictionary else b""
    return head + b"".join(writer.compress(r) for r in records)


def sound(payload=b"hello"):
    return warc.build("urn:page:1", "u", payload, len(payload), hashlib.sha1(payload).digest(), None, "2024-01-01T00:00:00Z")


def test_dictionary_may_be_compressed():
    for compress in (True, False):
        (got,) = warc.records(archive(sound(), dictionary=sound() * 3, compress=compress))
        assert got["error"] is None and got["payload"] == b"hello"


def test_faults_are_told():
    good = sound()
    cases = {
        good.replace(b"WARC/1.1", b"WARC/9.9"): "no version", good.replace(b"WARC-Date: 2024-01-01T00:00:00Z\r\n", b""): "missing header: warc-date", good.replace(b"hello", b"hellooo"): "content length",
        good + b"x": "content length", good.replace(b"hello", b"jello"): "block digest", good.replace(b"WARC-Date:", b"WARC-Date :"): "malformed header", good + good: "content length",
    }
    for bad, why in cases.items():
        (got, after) = warc.records(archive(bad, good))
        assert why in got["error"] and after["error"] is None, why
    data = archive(good, good)
    assert [x["error"] is None for x in warc.records(data[:-3])] == [True, False]
    assert [x["error"] is None for x in warc.records(data + b"junk")] == [True, True, False]
    assert list(warc.records(b"")) == []
    broken = bytearray(archive(good, dictionary=good * 3, compress=False))
    assert [x["error"] is None for x in warc.records(bytes(broken[len(good) * 3 + 8 :]))] == [False]  # its dictionary is missing
