import gzip
import hashlib
import zlib
from pathlib import Path

import pytest

from emolens.llm import warc
from emolens.llm.common import shared_folder

SCHEMA = "page_id long, url string, html string, record string"
BIG, OTHER = "<p>big ü</p>" * 120, "x" * 1000


def rows():
    return [(1, "http://a.example/1", BIG, ""), (2, "http://a.example/2", BIG, ""), (9, "http://b.example/?q=50%\r\nX: y", BIG, ""),
            (3, None, None, ""), (4, "u", "", ""), (5, "u", "", ""), (6, "u", "short", ""), (7, "u", "short", ""),
            (8, "u", OTHER, ""), (8, "u", OTHER, ""), (10, "u", "x" * 999, ""), (11, "u", "x" * 999, ""),
            (None, "n", BIG, ""), (12, "u", "WARC/1.1\r\nContent-Length: 3\r\n\r\n\x00abc\r\n\r\n", ""), (13, "u", "é" * 400_000, "")]


def expected():
    out = []
    for i, _, h, _ in rows():
        raw = (h or "").encode()
        same = [j for j, _, g, _ in rows() if (g or "").encode() == raw and j is not None]
        keep = max(same) if same and len(raw) >= 1000 else i
        again = i is not None and keep != i
        out.append((i, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if again else "response", keep if again else None))
    return sorted(out, key=str)


def test_round_trip(spark):
    pages = spark.createDataFrame(rows(), SCHEMA).repartition(3)
    for per_file in (10_000, 2):
        got = warc.archive_round_trip(pages, records_per_file=per_file).drop("url").collect()
        assert sorted(map(tuple, got), key=str) == expected()


def test_files_on_disk(spark):
    pages = spark.createDataFrame(rows(), SCHEMA).repartition(2)
    mono = warc.write_monolithic(warc.records(pages), shared_folder(spark, "mono"), 4)
    archives, index = warc.normalise(spark, mono, shared_folder(spark, "norm"))
    local = lambda p: Path(p.removeprefix("file:"))
    inputs = [f.read_bytes() for f in local(mono).glob("part-*")]
    for data in inputs:
        z = zlib.decompressobj(31)
        z.decompress(data)
        assert z.eof and not z.unused_data
    normal = {f.name: f.read_bytes() for f in local(archives).glob("part-*")}
    assert sorted(b"".join(gzip.decompress(x) for x in inputs).split(b"WARC/1.1\r\nWARC-Type")) == \
        sorted(b"".join(gzip.decompress(x) for x in normal.values()).split(b"WARC/1.1\r\nWARC-Type"))
    entries = spark.read.json(index).collect()
    assert len(entries) == len(rows())
    for e in entries:
        one = gzip.decompress(normal[e.file][e.offset:e.offset + e.length])
        assert one.startswith(b"WARC/1.1\r\nWARC-Type: " + e.record_type.encode()) and one.endswith(b"\r\n\r\n")
    assert warc.index_faults(spark, archives, index).count() == 0
    read = {r.page_id: r for r in warc.read_members(spark, archives).collect()}
    assert read["9"].url == "http://b.example/?q=50%\n\nX: y".replace("\n\n", "\n\n") and read["13"].html == "é" * 400_000
    assert read["1"].html == "" and read["3"].url is None


def test_damage_is_an_error():
    data = gzip.compress(b"WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n")
    assert list(warc.split_records(warc.inflate(data))) == [b"WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"]
    assert len(list(warc.split_records(warc.inflate(data + b"\0\0" + data, step=7)))) == 2
    for bad in (data[:-9], gzip.compress(b"WARC/1.1\r\nContent-Length: 9\r\n\r\nabc\r\n\r\n"), gzip.compress(b"junk\r\n\r\n")):
        with pytest.raises((ValueError, zlib.error)):
            list(warc.split_records(warc.inflate(bad)))


def test_empty_table(spark):
    assert warc.archive_round_trip(spark.createDataFrame([], SCHEMA)).count() == 0
