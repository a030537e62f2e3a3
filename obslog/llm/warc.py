"""WARC archives of Zstandard frames: a dictionary in a leading skippable frame, one frame per record."""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obslog.llm.common import cut

# Fixed values of the archive format.
VERSION = b"WARC/1.1"
DICTIONARY_FRAME = 0x184D2A5D
SKIPPABLE_FRAMES = range(0x184D2A50, 0x184D2A60)
ZSTD_FRAME = 0xFD2FB528
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NEEDED = ("warc-type", "warc-record-id", "warc-date", "content-length")


@dataclass(frozen=True)
class WarcArchives:
    """Parameters. An archive is closed at `archive_bytes` of compressed records; its dictionary is
    trained on its own first `sample_bytes` of blocks."""

    archive_bytes: int = 8 << 20
    dictionary_bytes: int = 32 << 10
    sample_bytes: int = 1 << 20
    level: int = 3
    date: str = "2024-01-01T00:00:00Z"


class BadArchive(ValueError):
    """An archive that breaks the format."""


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, p: WarcArchives = WarcArchives()) -> bytes:
    """One WARC record: an HTTP response, or a revisit that keeps the HTTP headers only. A page without an id is named `none`."""
    name = "none" if page_id is None else page_id
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    uri = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or f"urn:page:{name}")
    fields = [
        ("WARC-Type", "revisit" if refers_to is not None else "response"),
        ("WARC-Record-ID", f"<urn:page:{name}>"),
        ("WARC-Date", p.date),
        ("WARC-Target-URI", uri),
        ("WARC-Payload-Digest", f"sha1:{digest_of(payload)}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if refers_to is not None:
        fields[2:2] = [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", f"<urn:page:{refers_to}>")]
    head = b"".join(f"{k}: {v}\r\n".encode() for k, v in fields)
    return VERSION + b"\r\n" + head + b"\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> dict:
    """The fields of one record (names in lower case), with its block under 'block'.

    BadArchive if the version, a header line, a needed field, the block's length or the end
    is wrong, or if a response's payload disagrees with its digest or HTTP length."""
    head, mark, rest = data.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not mark or not lines[0].startswith(b"WARC/1."):
        raise BadArchive("no WARC header")
    fields: dict = {}
    for line in lines[1:]:
        name, colon, value = line.partition(b":")
        if not colon or not name or name.strip() != name:
            raise BadArchive(f"bad header line {line[:80]!r}")
        fields[name.decode().lower()] = value.strip().decode()
    missing = [k for k in NEEDED if k not in fields]
    if missing or not fields["content-length"].isdigit():
        raise BadArchive(f"bad or missing fields: {missing or 'content-length'}")
    n = int(fields["content-length"])
    if len(rest) != n + 4 or rest[n:] != b"\r\n\r\n":
        raise BadArchive(f"{len(rest)} bytes follow the header of a block of {n}")
    fields["block"] = rest[:n]
    if fields["warc-type"] in ("response", "revisit"):
        http, mark, payload = rest[:n].partition(b"\r\n\r\n")
        found = re.search(rb"(?im)^content-length:[ \t]*(\d+)[ \t]*\r?$", http)
        if not mark or not found:
            raise BadArchive("no HTTP header with a length")
        fields["payload_bytes"] = int(found[1])
        fields["payload"] = payload
        said = fields.get("warc-payload-digest", "")
        if fields["warc-type"] == "response" and (len(payload) != fields["payload_bytes"] or said != f"sha1:{digest_of(payload)}"):
            raise BadArchive("the payload disagrees with its length or digest")
        if fields["warc-type"] == "revisit" and (payload or "warc-refers-to" not in fields):
            raise BadArchive("a revisit with a payload or without its original")
    return fields


def write_archive(records: list[bytes], p: WarcArchives = WarcArchives()) -> bytes:
    """An archive of these records; without a dictionary where they are too few to train one."""
    samples, size = [], 0
    for r in records:
        if size >= p.sample_bytes:
            break
        samples.append(r[: p.sample_bytes])
        size += len(samples[-1])
    try:
        if len(samples) < 16:
            raise zstandard.ZstdError("too few records")
        dictionary = zstandard.train_dictionary(p.dictionary_bytes, samples, k=200, d=8)
        raw = dictionary.as_bytes()
        out = [struct.pack("<II", DICTIONARY_FRAME, len(raw)), raw]
        packer = zstandard.ZstdCompressor(level=p.level, dict_data=dictionary)
    except zstandard.ZstdError:
        out, packer = [], zstandard.ZstdCompressor(level=p.level)
    out += [packer.compress(r) for r in records]
    return b"".join(out)


def frame_end(data: bytes, at: int) -> int:
    """Where the frame that begins at this byte ends, told by its block headers; BadArchive if the data end before."""
    head = data[at : at + 18]
    try:
        end = at + zstandard.frame_header_size(head)
        checked = zstandard.get_frame_parameters(head).has_checksum
    except zstandard.ZstdError as e:
        raise BadArchive(f"bad frame header at byte {at}: {e}") from e
    last = False
    while not last:
        block = int.from_bytes(data[end : end + 3], "little")  # a bit for the last one, two bits for the kind, the size
        end += 3 + (1 if (block >> 1) & 3 == 1 else block >> 3)
        if end > len(data):
            raise BadArchive("the last frame is cut short")
        last = bool(block & 1)
    return end + 4 * checked


def read_archive(data: bytes) -> Iterator[bytes]:
    """The records of an archive, one for each frame.

    The dictionary is loaded from a leading skippable frame, where it may itself be
    compressed; other skippable frames are passed over. BadArchive for anything else. Each
    byte is looked at once, however many frames there are."""
    at, dictionary = 0, None
    if len(data) >= 8 and struct.unpack_from("<I", data)[0] == DICTIONARY_FRAME:
        n = struct.unpack_from("<I", data, 4)[0]
        raw = data[8 : 8 + n]
        if len(raw) < n:
            raise BadArchive("the dictionary is cut short")
        if raw[:4] == struct.pack("<I", ZSTD_FRAME):
            raw = zstandard.ZstdDecompressor().decompress(raw)
        dictionary = zstandard.ZstdCompressionDict(raw)
        at = 8 + n
    opener = zstandard.ZstdDecompressor(dict_data=dictionary) if dictionary else zstandard.ZstdDecompressor()
    while at < len(data):
        magic = struct.unpack_from("<I", data, at)[0] if len(data) - at >= 8 else 0
        if magic in SKIPPABLE_FRAMES:
            at += 8 + struct.unpack_from("<I", data, at + 4)[0]
            continue
        if magic != ZSTD_FRAME:
            raise BadArchive(f"no frame at byte {at}")
        end = frame_end(data, at)
        frame = opener.decompressobj()
        try:
            out = frame.decompress(data[at:end])
        except zstandard.ZstdError as e:
            raise BadArchive(f"bad frame at byte {at}: {e}") from e
        if not frame.eof:
            raise BadArchive("the last frame is cut short")
        yield out
        at = end


def _pack(p: WarcArchives):
    def run(batches):
        held, size = [], 0

        def close():
            return pa.RecordBatch.from_arrays([pa.array([len(held)], pa.int32()), pa.array([write_archive(held, p)], pa.binary())], ["records", "archive"])

        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(4)]
            for page_id, url, html, refers_to in zip(*columns, strict=True):
                held.append(record(page_id, url, html or b"", refers_to, p))
                size += len(held[-1]) // 4  # HTML shrinks about that much
                if size >= p.archive_bytes:
                    yield close()
                    held, size = [], 0
        if held:
            yield close()

    return run


def _unpack(batches):
    names = ["record_id", "warc_type", "refers_to", "payload_digest", "payload_bytes", "payload"]
    for batch in batches:
        for archive in batch.column(0):
            rows = [parse_record(r) for r in read_archive(archive.as_py())]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([r["warc-record-id"] for r in rows], pa.string()),
                    pa.array([r["warc-type"] for r in rows], pa.string()),
                    pa.array([r.get("warc-refers-to") for r in rows], pa.string()),
                    pa.array([r.get("warc-payload-digest", "").removeprefix("sha1:") or None for r in rows], pa.string()),
                    pa.array([r.get("payload_bytes") for r in rows], pa.int64()),
                    pa.array([r.get("payload") if r["warc-type"] == "response" else None for r in rows], pa.binary()),
                ],
                names,
            )


def archive_pages(pages: DataFrame, p: WarcArchives = WarcArchives(), id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Archives (records, archive: bytes) of the pages, a record each: of equal payloads the largest id is a response and the others revisit it.

    Payloads are grouped by a hash of 256 bits; the largest id of each group goes to its rows
    by a join whose skewed partitions Spark splits, so that a payload that a third of the
    pages share meets no one task. Null pages are empty payloads. A page with a null id
    revisits the largest id of its payload, if there is one, and is a response otherwise. Rows that repeat the largest id are
    responses. No pages give no archives; other columns are not read."""
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.coalesce(F.col(html_col), F.lit("")).cast("binary").alias("html"))
    rows = rows.withColumn("key", F.sha2("html", 256))
    first = rows.groupBy("key").agg(F.max("page_id").alias("largest"), F.count("*").alias("n")).where("n > 1").select("key", "largest")
    marked = rows.join(first, "key", "left").select("page_id", "url", "html", F.when(~F.col("page_id").eqNullSafe(F.col("largest")), F.col("largest")).alias("refers_to"))
    return marked.mapInArrow(_pack(p), "records int, archive binary")


def read_archives(archives: DataFrame, column: str = "archive") -> DataFrame:
    """The records of a column of archives, such as the `content` that Spark's binaryFile source gives; a bad archive fails the job."""
    return archives.select(column).mapInArrow(_unpack, "record_id string, warc_type string, refers_to string, payload_digest string, payload_bytes long, payload binary")


def round_trip(pages: DataFrame, p: WarcArchives = WarcArchives()) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type and refers_to, as read back from archives in the shared folder.

    Nulls and ties are those of `archive_pages`; a null id comes back as one. No pages give no rows."""
    records = read_archives(cut(archive_pages(pages, p)))
    number = lambda c: F.regexp_extract(c, r"^<urn:page:(-?\d+)>$", 1).try_cast("long")
    return records.select(
        number("record_id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        F.col("warc_type").alias("record_type"),
        F.when(F.col("warc_type") == "revisit", number("refers_to")).alias("refers_to"),
    )
