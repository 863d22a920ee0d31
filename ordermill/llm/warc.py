"""WARC archives in Zstandard form, one frame per record, with a dictionary in the leading skippable frame.

Archives are rows (path, content), the shape of Spark's `binaryFile` source, so the reader takes archives from
files just as well. An archive starts with a skippable frame that holds a dictionary (itself Zstandard
compressed); then every record is one frame compressed with it. Of pages with equal payloads of at least
`REVISIT_BYTES`, the one with the smallest id is stored as a response and the others as revisits of it.

The reader checks the dictionary frame, that each frame holds exactly one record, that headers are well formed
and lengths and digests right; anything else raises an error that names the archive and the offset.

Defined results: a null html is an empty payload; a null URL is left out of the record; control characters and
blanks in a URL are percent-encoded; a null page id reads back as null; pages that repeat in id and payload share
one decision; an empty table gives no archive; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from urllib.parse import quote

import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordermill.llm.common import stored, travels

travels(__name__)

REVISIT_BYTES = 100
ARCHIVE_BYTES = 8 * 1024 * 1024  # payload bytes after which an archive is closed
DICTIONARY_BYTES = 32 * 1024
SAMPLE_BYTES = 512 * 1024  # leading payloads of an archive from which its dictionary is trained
DATE = "2000-01-01T00:00:00Z"  # records carry a fixed date, so that a repeated write gives the same bytes
# Frame magics of the Zstandard format.
SKIPPABLE_MAGIC = (0x184D2A5D).to_bytes(4, "little")
FRAME_MAGIC = (0xFD2FB528).to_bytes(4, "little")
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ARCHIVES = "path string, content binary"
RECORDS = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


class ArchiveError(ValueError):
    pass


# --- which record each page becomes


def plan_records(pages: DataFrame, least_bytes: int = REVISIT_BYTES) -> DataFrame:
    """Pages with `digest` and `refers_to` (the page that holds the same payload, null for responses)."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    pages = pages.select("page_id", "url", payload.alias("payload"), F.sha2(payload, 256).alias("digest"))
    narrow = stored(
        pages.filter(F.length("payload") >= least_bytes).select("page_id", "digest"), "warc-digests"
    )
    first = narrow.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).filter("n > 1")
    revisits = (
        narrow.join(first, "digest")
        .filter("page_id > first")
        .groupBy("page_id", "digest")
        .agg(F.min("first").alias("refers_to"))
    )
    return pages.join(revisits, ["page_id", "digest"], "left")


# --- writing


def _record_id(page_id) -> str:
    return f"<urn:x-page:{'' if pd.isna(page_id) else int(page_id)}>"


def build_record(page_id, url: str | None, payload: bytes, digest: str, refers_to) -> bytes:
    revisit = not pd.isna(refers_to)
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if revisit else head + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {_record_id(page_id)}",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}",
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        lines.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: quote(m[0]), url))
    if revisit:
        lines += [f"WARC-Refers-To: {_record_id(refers_to)}", f"WARC-Profile: {PROFILE}"]
    return "\r\n".join(lines).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def make_dictionary(samples: list[bytes]) -> bytes:
    """A trained dictionary, or the first record's headers where there is too little to train on."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, level=3).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:1024].ljust(8, b"\n")


def build_archive(records: list[bytes]) -> bytes:
    taken, size = [], 0
    for record in records:
        if size >= SAMPLE_BYTES:
            break
        taken.append(record[:16384])
        size += len(taken[-1])
    raw = make_dictionary(taken)
    packed = zstandard.ZstdCompressor(level=3).compress(raw)
    writer = zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(raw), write_content_size=True)
    frames = [writer.compress(record) for record in records]
    return b"".join([SKIPPABLE_MAGIC, len(packed).to_bytes(4, "little"), packed, *frames])


def write_archives(planned: DataFrame) -> DataFrame:
    """Rows (path, content): one or more archives per partition."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        records, size = [], 0

        def close():
            content = build_archive(records)
            return pd.DataFrame({"path": [f"{hashlib.sha256(content).hexdigest()[:24]}.warc.zst"], "content": [content]})

        for batch in batches:
            for row in batch.itertuples(index=False):
                records.append(build_record(row.page_id, row.url, row.payload, row.digest, row.refers_to))
                size += len(records[-1])
                if size >= ARCHIVE_BYTES:
                    yield close()
                    records, size = [], 0
        if records:
            yield close()

    return planned.select("page_id", "url", "payload", "digest", "refers_to").mapInPandas(run, ARCHIVES)


# --- reading


def _headers(block: bytes, first_line: str, where: str) -> tuple[dict[str, str], bytes]:
    head, mark, rest = block.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    if not mark or not lines[0].startswith(first_line):
        raise ArchiveError(f"{where}: no {first_line} header")
    fields = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon or not re.fullmatch(r"[A-Za-z0-9-]+", name):
            raise ArchiveError(f"{where}: malformed header line {line!r}")
        fields[name.lower()] = value.strip()
    return fields, rest


def _length(fields: dict[str, str], where: str) -> int:
    value = fields.get("content-length", "")
    if not value.isdigit():
        raise ArchiveError(f"{where}: Content-Length {value!r}")
    return int(value)


def _page(value: str, where: str) -> int | None:
    match = re.fullmatch(r"<urn:x-page:(-?\d*)>", value)
    if not match:
        raise ArchiveError(f"{where}: record id {value!r}")
    return int(match[1]) if match[1] else None


def parse_record(raw: bytes, where: str) -> tuple:
    fields, rest = _headers(raw, "WARC/1.1", where)
    kind, size = fields.get("warc-type"), _length(fields, where)
    if kind not in ("response", "revisit"):
        raise ArchiveError(f"{where}: record type {kind!r}")
    if len(rest) != size + 4 or rest[size:] != b"\r\n\r\n":
        raise ArchiveError(f"{where}: the block has {len(rest) - 4} bytes, Content-Length says {size}")
    block = rest[:size]
    if fields.get("warc-block-digest") != f"sha256:{hashlib.sha256(block).hexdigest()}":
        raise ArchiveError(f"{where}: block digest")
    http, payload = _headers(block, "HTTP/1.1", where)
    digest, n = fields.get("warc-payload-digest", "").removeprefix("sha256:"), _length(http, where)
    if kind == "response" and (len(payload) != n or hashlib.sha256(payload).hexdigest() != digest):
        raise ArchiveError(f"{where}: payload length or digest")
    if kind == "revisit" and (payload or not fields.get("warc-refers-to")):
        raise ArchiveError(f"{where}: a revisit refers to a record and has no payload")
    page = _page(fields.get("warc-record-id", ""), where)
    refers_to = _page(fields["warc-refers-to"], where) if kind == "revisit" else None
    return page, fields.get("warc-target-uri"), n, digest, kind, refers_to, payload if kind == "response" else None


def read_archive(path: str, content: bytes) -> Iterator[tuple]:
    """Records of one archive, in order."""
    content = bytes(content)
    if content[:4] != SKIPPABLE_MAGIC or len(content) < 8:
        raise ArchiveError(f"{path}: no leading dictionary frame")
    at = 8 + int.from_bytes(content[4:8], "little")
    raw = content[8:at]
    if len(content) < at:
        raise ArchiveError(f"{path}: the dictionary frame is cut off")
    if raw[:4] == FRAME_MAGIC:
        raw = zstandard.ZstdDecompressor().decompress(raw)
    reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw))
    view = memoryview(content)
    while at < len(content):
        where = f"{path} at byte {at}"
        frame = reader.decompressobj()
        parts = []
        try:
            end = at
            while not frame.eof and end < len(content):
                chunk = view[end : end + 65536]
                parts.append(frame.decompress(chunk))
                end += len(chunk)
        except zstandard.ZstdError as e:
            raise ArchiveError(f"{where}: {e}") from e
        if not frame.eof:
            raise ArchiveError(f"{where}: the frame is cut off")
        yield parse_record(b"".join(parts), where)
        at = end - len(frame.unused_data)


def read_archives(archives: DataFrame) -> DataFrame:
    """Records of archives given as rows (path, content)."""
    names = [part.split()[0] for part in RECORDS.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"], strict=True):
                rows = pd.DataFrame(list(read_archive(path, content)), columns=names)
                yield rows.astype({"page_id": "Int64", "refers_to": "Int64", "payload_bytes": "int64"})

    return archives.select("path", "content").mapInPandas(run, RECORDS)
