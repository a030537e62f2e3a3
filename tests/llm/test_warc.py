import base64
import hashlib
import os
import struct
import time

import pytest
import zstandard
from pyspark.sql import functions as F

from obslog.llm.warc import DICTIONARY_FRAME, BadArchive, WarcArchives, archive_pages, frame_end, parse_record, read_archive, read_archives, record, round_trip, write_archive

SCHEMA = "page_id long, url string, html string"


def expected(rows):
    largest = {}
    for page, _, html in rows:
        largest[html or ""] = max(largest.get(html or "", -99), page)
    out = []
    for page, _, html in rows:
        b = (html or "").encode()
        keep = largest[html or ""] == page
        out.append((page, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "response" if keep else "revisit", None if keep else largest[html or ""]))
    return sorted(out, key=str)


def test_round_trip(spark):
    rows = [(i, f"http://a.example/{i}?q=a b\r\nX: y", f"<html>{i % 50} é {'body ' * (i % 70)}</html>") for i in range(400)]
    rows += [(1000 + i, None, None if i % 2 else "") for i in range(40)] + [(2000, "u", "x" * 300_000), (2001, "u", "\r\n\r\nContent-Length: 5\r\n\r\n")]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("key", F.lit(1)).withColumn("payload", F.lit(2)).repartition(3)
    for p in (WarcArchives(), WarcArchives(archive_bytes=3000)):
        assert sorted(map(tuple, round_trip(df, p).collect()), key=str) == expected(rows)


def test_ties_nulls_and_no_pages(spark):
    rows = [(5, "u", "a"), (5, "u", "a"), (3, "u", "a"), (None, "u", "a")]
    got = sorted(map(tuple, round_trip(spark.createDataFrame(rows, SCHEMA)).collect()), key=str)
    d = base64.b32encode(hashlib.sha1(b"a").digest()).decode()
    assert got == sorted([(5, 1, d, "response", None), (5, 1, d, "response", None), (3, 1, d, "revisit", 5), (None, 1, d, "revisit", 5)], key=str)
    assert round_trip(spark.createDataFrame([], SCHEMA)).collect() == []


def test_negative_ids(spark):
    rows = [(-1, "u", "a"), (-2, "u", "a"), (-3, None, "a"), (None, None, "a"), (-9, "u", "b"), (0, "u", "b")]
    got = sorted(map(tuple, round_trip(spark.createDataFrame(rows, SCHEMA)).collect()), key=str)
    d = base64.b32encode(hashlib.sha1(b"a").digest()).decode()
    assert got == sorted([*expected([r for r in rows if r[0] is not None]), (None, 1, d, "revisit", -1)], key=str)


def test_reading_is_linear_in_the_records():
    def took(n):
        data = write_archive([record(i, f"http://d/{i}", f"<p>{i} some words</p>".encode() * 9, None) for i in range(n)])
        began = time.perf_counter()
        assert sum(1 for _ in read_archive(data)) == n
        return (time.perf_counter() - began) / n

    assert took(32_000) < 3 * min(took(4_000) for _ in range(3))


def test_frames_end_where_their_blocks_do():
    for level, text in ((1, b""), (3, b"a" * 500_000), (3, os.urandom(300_000)), (19, b"some words " * 40_000)):
        for checksum in (False, True):
            frame = zstandard.ZstdCompressor(level=level, write_checksum=checksum).compress(text)
            assert frame_end(b"xyz" + frame + b"tail", 3) == 3 + len(frame)
            with pytest.raises(BadArchive):
                frame_end(frame[:-5] if len(frame) > 12 else frame[:3], 0)


def test_archive_files_are_read_by_spark(spark, tmp_path):
    rows = [(i, f"http://b/{i}", f"page {i} " * 50) for i in range(60)]
    for i, r in enumerate(archive_pages(spark.createDataFrame(rows, SCHEMA)).collect()):
        (tmp_path / f"{i}.warc.zst").write_bytes(bytes(r.archive))
        assert struct.unpack_from("<I", r.archive)[0] in (DICTIONARY_FRAME, 0xFD2FB528)
    back = read_archives(spark.read.format("binaryFile").load(f"{tmp_path}/*.zst"), "content").collect()
    assert sorted(bytes(r.payload).decode() for r in back) == sorted(h for _, _, h in rows)


def test_dictionary_plain_or_compressed_and_other_skippable_frames():
    records = [record(i, f"http://c/{i}", f"<p>some shared words {i}</p>".encode() * 20, None) for i in range(200)]
    data = write_archive(records)
    assert struct.unpack_from("<I", data)[0] == DICTIONARY_FRAME
    assert list(read_archive(data)) == records
    n = struct.unpack_from("<I", data, 4)[0]
    packed = zstandard.compress(data[8 : 8 + n])
    other = struct.pack("<II", 0x184D2A50, 3) + b"abc"
    again = struct.pack("<II", DICTIONARY_FRAME, len(packed)) + packed + other + data[8 + n :] + other
    assert list(read_archive(again)) == records
    few = write_archive(records[:3])
    assert list(read_archive(few)) == records[:3] and list(read_archive(b"")) == []


@pytest.mark.parametrize("spoil", [lambda d: d[:-3], lambda d: d + b"junk", lambda d: d[:6], lambda d: d[:-20] + bytes(20)])
def test_bad_archives(spoil):
    data = write_archive([record(i, "u", b"payload " * 9 + str(i).encode(), None) for i in range(40)])
    with pytest.raises(BadArchive):
        list(read_archive(spoil(data)))


@pytest.mark.parametrize(
    "old, new",
    [
        (b"WARC/1.1", b"WARX/1.1"),
        (b"WARC-Date", b"WARC-Data"),
        (b"Content-Length: 8", b"Content-Length: x"),
        (b"WARC-Type: response", b"WARC-Type response"),
        (b"hello", b"hullo"),
        (b"hello", b"hello!"),
        (b"\r\n\r\nhello", b"\r\n\r\nhell"),
        (b"Content-Length: 5", b"Content-Length: 6"),
    ],
)
def test_bad_records(old, new):
    good = record(1, "u", b"hello", None)
    assert parse_record(good)["payload"] == b"hello"
    assert old in good
    with pytest.raises(BadArchive):
        parse_record(good.replace(old, new))
