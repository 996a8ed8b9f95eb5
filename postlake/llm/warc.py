"""Web archives of raw rows, one Zstandard frame per record, with the dictionary in front."""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlake.llm.common import lowest_hashes
from postlake.session import staged

# Frame marks and the skippable mark that holds a dictionary.
FRAME = 0xFD2FB528
SKIPPABLE = range(0x184D2A50, 0x184D2A60)
DICTIONARY = 0x184D2A5D
# Payloads from this size on are stored once.
SHARED_FROM = 1000
# A dictionary is trained on so many payloads at most, of so many bytes each.
SAMPLES, SAMPLE_BYTES, DICTIONARY_BYTES = 256, 16 << 10, 32 << 10
ARCHIVE_BYTES = 8 << 20

# Fixed value: the profile of records that repeat a payload.
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_RECORD_TYPES = ("response", "revisit")
_PLAIN = "".join(map(chr, range(33, 127)))


def record_plan(data_points: DataFrame, shared_from: int = SHARED_FROM) -> DataFrame:
    """``data_points`` with ``payload_bytes``, ``sha1``, ``record_type`` and ``refers_to``.

    Of equal payloads of ``shared_from`` bytes or more the row with the largest id is the response, the others revisit
    it. Winners are found on digests alone, combined before the shuffle; only groups of two and more are joined
    back, and adaptive execution splits a digest that very many rows share.
    """
    body = F.coalesce("payload", F.lit("")).cast("binary")
    sized = data_points.select("id", "permalink", "payload", "fetched_at", F.octet_length(body).cast("long").alias("payload_bytes"), F.sha1(body).alias("sha1"))
    groups = sized.filter(F.col("payload_bytes") >= shared_from).groupBy("sha1", "payload_bytes")
    groups = groups.agg(F.max("id").alias("chosen"), F.count("*").alias("n")).filter("n > 1 and chosen is not null")
    groups = staged(groups.select(F.col("sha1").alias("s"), F.col("payload_bytes").alias("b"), "chosen"), "payload-groups")
    found = sized.join(groups, (F.col("sha1") == F.col("s")) & (F.col("payload_bytes") == F.col("b")), "left")
    again = F.col("chosen").isNotNull() & ~F.col("id").eqNullSafe(F.col("chosen"))
    return found.select(
        *sized.columns, F.when(again, "revisit").otherwise("response").alias("record_type"), F.when(again, F.col("chosen")).alias("refers_to")
    )


def train_dictionary(data_points: DataFrame) -> bytes:
    """A dictionary from a bounded sample: SAMPLES payloads by lowest hash, SAMPLE_BYTES of each. Empty if too little to learn from."""
    held = data_points.filter("payload is not null").select("id", F.sha1("payload").alias("sha1"), F.substring("payload", 1, SAMPLE_BYTES).alias("sample"))
    drawn = lowest_hashes(held, SAMPLES, data_points.count(), "id", "sha1")
    samples = [row[0].encode() for row in drawn.select("sample").collect()]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes() if len(samples) >= 8 else b""
    except zstandard.ZstdError:
        return b""


def _urn(value) -> str:
    return f"<urn:data-point:{'' if value is None else quote(str(value), safe='')}>"


def record_bytes(row: dict, content_type: str) -> bytes:
    """One record. A revisit keeps the response's HTTP header, with the length of the payload that it leaves out."""
    payload = (row["payload"] or "").encode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: {content_type}\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    revisit = row["record_type"] == "revisit"
    block = http if revisit else http + payload
    date = row["fetched_at"]
    fields = [
        ("WARC-Type", row["record_type"]), ("WARC-Record-ID", _urn(row["id"])),
        ("WARC-Date", date.strftime("%Y-%m-%dT%H:%M:%SZ") if date else "1970-01-01T00:00:00Z"),
        ("WARC-Target-URI", quote(row["permalink"] or "", safe=_PLAIN)),
        ("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(row["sha1"])).decode()),
        ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block))),
    ]
    if revisit:
        fields[4:4] = [("WARC-Refers-To", _urn(row["refers_to"])), ("WARC-Profile", _PROFILE)]
    head = "WARC/1.1\r\n" + "".join(f"{name}: {value}\r\n" for name, value in fields)
    return head.encode() + b"\r\n" + block + b"\r\n\r\n"


def _write(batches: Iterator[pa.RecordBatch], dictionary: bytes, content_type: str, archive_bytes: int) -> Iterator[pa.RecordBatch]:
    front = b""
    if dictionary:
        packed = zstandard.ZstdCompressor().compress(dictionary)
        front = DICTIONARY.to_bytes(4, "little") + len(packed).to_bytes(4, "little") + packed
    shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    compressor = zstandard.ZstdCompressor(level=3, dict_data=shared, write_checksum=True, write_content_size=True)
    task, made, parts, size = TaskContext.get().partitionId(), 0, [], 0

    def archive() -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"archive": [f"posts-{task:05d}-{made:05d}.warc.zst"], "content": [front + b"".join(parts)]})

    for batch in batches:
        for low in range(0, batch.num_rows, 100):
            for row in batch.slice(low, 100).to_pylist():
                parts.append(compressor.compress(record_bytes(row, content_type)))
                size += len(parts[-1])
                if size >= archive_bytes:
                    yield archive()
                    made, parts, size = made + 1, [], 0
    if parts:
        yield archive()


def write_archives(data_points: DataFrame, content_type: str = "application/json; charset=utf-8", archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Pack raw rows into WARC archives: ``archive`` (file name) and ``content`` (the file's bytes), one row per archive.

    ``data_points``: ``id``, ``permalink`` (target), ``payload`` and ``fetched_at``. Each record is a Zstandard frame of its
    own with checksum and size; the dictionary stands in front of every archive in a skippable frame. A task streams its rows
    into archives of about ``archive_bytes``. A null payload is an empty one; a null time is the epoch; a null id or
    target leaves the field's value empty. Repeated rows give repeated records. No rows give no archives.
    """
    planned = record_plan(data_points)
    dictionary = train_dictionary(data_points)
    return planned.mapInArrow(lambda b: _write(b, dictionary, content_type, archive_bytes), "archive string, content binary")


def frames(content: bytes) -> Iterator[tuple[int, int, int]]:
    """Mark, begin and end of each frame, from the frame headers and block sizes alone."""
    at = 0
    while at < len(content):
        begin, mark = at, int.from_bytes(content[at : at + 4], "little")
        if mark in SKIPPABLE:
            at += 8 + int.from_bytes(content[at + 4 : at + 8], "little")
        elif mark == FRAME:
            flags = content[at + 4 : at + 5]
            if not flags:
                raise ValueError(f"frame at {begin} is cut off")
            single = flags[0] >> 5 & 1
            at += 5 + (1 - single) + (0, 1, 2, 4)[flags[0] & 3] + (single, 2, 4, 8)[flags[0] >> 6]
            last = False
            while not last:
                head = int.from_bytes(content[at : at + 3], "little")
                last, kind = head & 1, head >> 1 & 3
                if at + 3 > len(content) or kind == 3:
                    raise ValueError(f"frame at {begin} is broken")
                at += 3 + (1 if kind == 1 else head >> 3)
            at += 4 * (flags[0] >> 2 & 1)
        else:
            raise ValueError(f"no frame at {begin}")
        if at > len(content):
            raise ValueError(f"frame at {begin} is cut off")
        yield mark, begin, at


def _dictionary(content: bytes) -> bytes:
    """The dictionary of the leading skippable frame, which may be compressed itself."""
    raw = content[8:]
    return zstandard.ZstdDecompressor().decompress(raw) if raw[:4] == FRAME.to_bytes(4, "little") else raw


def _id_of(urn: str) -> str | None:
    found = re.fullmatch("<urn:data-point:(.*)>", urn)
    if not found:
        raise ValueError(f"record id {urn}")
    return unquote(found[1]) or None


def parse_record(record: bytes) -> dict:
    """Fields of one record; a ValueError names what is wrong with it."""
    head, blank, rest = record.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not blank or lines[0] not in ("WARC/1.0", "WARC/1.1"):
        raise ValueError("no WARC header")
    fields = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon or name.lower() in fields:
            raise ValueError(f"header line {line!r}")
        fields[name.lower()] = value.strip()
    if lacking := [n for n in ("warc-type", "warc-record-id", "warc-date", "content-length", "warc-payload-digest") if n not in fields]:
        raise ValueError(f"no {lacking[0]}")
    if fields["warc-type"] not in _RECORD_TYPES:
        raise ValueError(f"type {fields['warc-type']}")
    if not fields["content-length"].isdecimal() or len(rest) != int(fields["content-length"]) + 4 or rest[-4:] != b"\r\n\r\n":
        raise ValueError("content length")
    http, blank, payload = rest[:-4].partition(b"\r\n\r\n")
    length = re.search(rb"(?im)^content-length:\s*(\d+)\s*$", http)
    if not blank or not http.startswith(b"HTTP/1.") or not length:
        raise ValueError("no HTTP header")
    digest = base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:")).hex()
    revisit = fields["warc-type"] == "revisit"
    if revisit and (payload or "warc-refers-to" not in fields):
        raise ValueError("revisit with a payload or without a reference")
    if not revisit and (len(payload) != int(length[1]) or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError("payload length or digest")
    return {
        "id": _id_of(fields["warc-record-id"]), "permalink": unquote(fields.get("warc-target-uri", "")) or None, "record_type": fields["warc-type"],
        "refers_to": _id_of(fields["warc-refers-to"]) if revisit else None, "payload_bytes": int(length[1]), "payload_digest": digest,
        "payload": None if revisit else payload.decode("utf-8", "replace"), "error": None,
    }


_FIELDS = ("id", "permalink", "record_type", "refers_to", "payload_bytes", "payload_digest", "payload", "error")


def _records(content: bytes) -> Iterator[dict]:
    """Rows of an archive. A record that is wrong is a row with ``error``; after a broken frame nothing can be found."""
    decoder, first = zstandard.ZstdDecompressor(), True
    try:
        for mark, begin, end in frames(content):
            if mark == DICTIONARY and first:
                decoder = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(_dictionary(content[begin:end])))
            elif mark == FRAME:
                try:
                    # A frame need not say how large its content is.
                    yield parse_record(decoder.decompressobj().decompress(content[begin:end]))
                except (ValueError, zstandard.ZstdError) as wrong:
                    yield dict.fromkeys(_FIELDS) | {"error": f"at {begin}: {wrong}"}
            first = False
    except (ValueError, zstandard.ZstdError) as wrong:
        yield dict.fromkeys(_FIELDS) | {"error": str(wrong)}


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.string()] * 5 + [pa.int64()] + [pa.string()] * 3
    names = ["archive", "id", "permalink", "record_type", "refers_to", "payload_bytes", "payload_digest", "payload", "error"]
    for batch in batches:
        for name, content in zip(batch["archive"], batch["content"]):
            rows, size = [], 0
            for record in _records(content.as_py() or b""):
                rows.append({"archive": name.as_py(), **record})
                size += len(record["payload"] or "")
                if size > 1 << 22 or len(rows) >= 5000:
                    yield pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], k) for n, k in zip(names, kinds)], names=names)
                    rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], k) for n, k in zip(names, kinds)], names=names)


def read_archives(archives: DataFrame, id_type: str = "string") -> DataFrame:
    """Read WARC archives record by record.

    ``archives``: ``archive`` and ``content``, as written here or as ``spark.read.format("binaryFile")`` gives for files of others
    (``path`` renamed to ``archive``). The dictionary is loaded from the leading skippable frame, compressed or not; without
    one, frames are decoded plainly. Each further frame must hold one record; its version line, required and unrepeated
    headers, block and HTTP lengths, closing blank lines and, for responses, payload digest are checked.

    Returns ``archive``, ``id`` (cast to ``id_type``), ``permalink``, ``record_type``, ``refers_to``, ``payload_bytes``, ``payload_digest`` (lower-case
    hex SHA-1; both of the full payload, also for revisits), ``payload`` (null for revisits) and ``error`` (null for sound
    records). A wrong record gives a row with ``error`` alone; after a broken frame the rest of its archive is one such row.
    A null or empty content has no records.
    """
    schema = "archive string, id string, permalink string, record_type string, refers_to string, payload_bytes long, payload_digest string, payload string, error string"
    rows = archives.select("archive", "content").mapInArrow(_read, schema)
    return rows.withColumns({"id": F.col("id").cast(id_type), "refers_to": F.col("refers_to").cast(id_type)})
