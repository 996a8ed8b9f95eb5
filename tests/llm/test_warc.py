import datetime as dt
import hashlib

import pytest
import zstandard

from postlake.llm import warc
from postlake.session import staged
from tests.llm.helpers import caption, empty, post_id, rows_of

SCHEMA = "id string, permalink string, payload string, fetched_at timestamp, record_type int, archive string, sha1 string"
WHEN = dt.datetime(2026, 2, 3, 4, 5, 6)
COLUMNS = ("id", "permalink", "record_type", "refers_to", "payload_bytes", "payload_digest", "payload", "error")


def raw(spark, rows):
    return spark.createDataFrame([(*r, WHEN, 1, "a", "s") for r in rows], SCHEMA)


def expected(rows):
    chosen = {}
    for i, _, payload in rows:
        body = (payload or "").encode()
        if len(body) >= 1000 and i is not None:
            chosen[body] = max(i, chosen.get(body, i))
    out = []
    for i, link, payload in rows:
        body = (payload or "").encode()
        first = chosen.get(body, i)
        again = first != i
        out.append((i, link or None, "revisit" if again else "response", first if again else None, len(body), hashlib.sha1(body).hexdigest(), None if again else body.decode(), None))
    return sorted(out, key=str)


def rows_with_copies():
    rows = [(post_id(k), f"https://posts.example.com/p/{k}/?ü=\r\n{k}", f'{{"id":"{k}","caption":"{caption(k, 30)}"}}') for k in range(60)]
    big, long = "é" * 600, caption(99, 40_000)
    return rows + [(post_id(70), "u", big), (post_id(71), "v", big), (post_id(72), None, "é" * 499), (post_id(73), "", "é" * 499), (post_id(74), "w", None), (post_id(75), "x", ""), (post_id(76), "y", long), (post_id(77), "z", long), (None, "n", big), (None, "m", None)]


def test_round_trip(spark):
    rows = rows_with_copies()
    archives = staged(warc.write_archives(raw(spark, rows).repartition(3), archive_bytes=2000), "archives")
    assert archives.count() > 3
    assert sorted(rows_of(warc.read_archives(archives), *COLUMNS), key=str) == expected(rows)


def test_files_on_disk_and_repeated_rows(spark, tmp_path):
    rows = [(post_id(1), "u", "x" * 2000)] * 2 + [(post_id(2), "u", "y")]
    for name, content in rows_of(warc.write_archives(raw(spark, rows).coalesce(1)), "archive", "content"):
        (tmp_path / name).write_bytes(content)
    files = spark.read.format("binaryFile").load(str(tmp_path)).withColumnRenamed("path", "archive")
    assert sorted(rows_of(warc.read_archives(files), *COLUMNS), key=str) == expected(rows)


def test_dictionary_stands_in_front_and_is_needed(spark):
    content = bytes(rows_of(warc.write_archives(raw(spark, rows_with_copies()).coalesce(1)), "content")[0][0])
    marks = list(warc.frames(content))
    assert marks[0][0] == warc.DICTIONARY and {m for m, _, _ in marks[1:]} == {warc.FRAME} and marks[-1][2] == len(content)
    with pytest.raises(zstandard.ZstdError):
        zstandard.ZstdDecompressor().decompress(content[marks[1][1] : marks[1][2]])


def one(record, **changes):
    return zstandard.ZstdCompressor().compress(record)


def test_wrong_records_are_named_and_the_rest_is_read(spark):
    row = {"id": "7", "permalink": "u", "payload": "body", "fetched_at": None, "record_type": "response", "refers_to": None, "sha1": hashlib.sha1(b"body").hexdigest()}
    good = warc.record_bytes(row, "text/plain")
    frame = zstandard.ZstdCompressor(write_checksum=True).compress
    bad = {
        "type": good.replace(b"WARC-Type: response", b"WARC-Type: metadata"), "version": good.replace(b"WARC/1.1", b"WARC/9.9"),
        "length": good.replace(b"Content-Length: 4\r\n", b"Content-Length: 5\r\n"), "block": good.replace(b"\r\nbody", b"\r\nbodyx"),
        "digest": good.replace(b"\r\nbody\r\n", b"\r\nbodz\r\n"), "lacks": good.replace(b"WARC-Date", b"WARC-Dat"), "twice": good.replace(b"WARC-Date", b"WARC-Type"),
    }
    content = b"".join([frame(good), *map(frame, bad.values()), frame(good)])
    rows = rows_of(warc.read_archives(spark.createDataFrame([("a", content)], "archive string, content binary")), "id", "error")
    assert [r[0] for r in rows] == ["7", *[None] * len(bad), "7"] and all(e for _, e in rows[1:-1])
    for broken in (content[:-3], content + b"junk", b"\x28\xb5\x2f\xfd", content[:40]):
        assert warc.read_archives(spark.createDataFrame([("a", broken)], "archive string, content binary")).filter("error is not null").count() >= 1


def test_other_dictionaries_and_empty_input(spark):
    shared = zstandard.train_dictionary(4096, [f"WARC/1.1 sample {caption(k, 60)}".encode() for k in range(200)])
    row = {"id": "é/7", "permalink": "u", "payload": "body", "fetched_at": WHEN, "record_type": "response", "refers_to": None, "sha1": hashlib.sha1(b"body").hexdigest()}
    frame = zstandard.ZstdCompressor(dict_data=shared).compress(warc.record_bytes(row, "text/plain"))
    plain = warc.DICTIONARY.to_bytes(4, "little") + len(shared.as_bytes()).to_bytes(4, "little") + shared.as_bytes() + frame
    table = spark.createDataFrame([("a", plain), ("b", None), ("c", b"")], "archive string, content binary")
    assert rows_of(warc.read_archives(table), "archive", "id", "error") == [("a", "é/7", None)]
    assert warc.write_archives(empty(raw(spark, rows_with_copies()))).count() == 0
