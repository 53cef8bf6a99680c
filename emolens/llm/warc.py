"""WARC archives: writing, normalising monolithic gzip, reading back.

`write_monolithic` writes records through Spark's own text writer with gzip
compression: each output file is one gzip stream over many WARC records (the
record end, two CRLFs, is the writer's line separator).  `normalise` inflates
such a whole-file stream once, front to back, rewrites every record as a gzip
member of its own and writes a sidecar index of (file, offset, length).
`read_members` reads normalised archives back member by member.  All files go
through Spark's readers and writers, so any file system Spark knows will do,
and a task that is run again rewrites its files whole.

Memory: a task holds one compressed archive and its largest record; the
number of records a file may hold is a parameter (it bounds files, it drops
nothing: further records go to further files).

Cases: null text is an empty payload; a null url leaves the target line out;
rows whose id is null are archived without an id and come back with null;
several rows of one id are several records.  Payloads equal in length and
SHA-256 are equal; of those of at least `min_revisit` bytes, records with the
largest id are responses and the others revisit it (an id that repeats gives
several responses; equal payloads without any id are all responses).  A
normalised archive ends in one zero byte, which gzip readers skip.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emolens.llm.common import shared_folder, text_or_empty

CRLF = "\r\n"
#: WARC's date for records whose fetch time is unknown: the file is then the
#: same at every run.
DATE = "1970-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def revisits(pages: DataFrame, min_revisit: int = 1000) -> DataFrame:
    """(page_id, digest, refers_to) of the records that revisit another.

    Only ids and digests move: they are counted by digest with map-side
    combine, then the repeated digests meet their ids in a join."""
    rows = pages.select("page_id", F.encode(text_or_empty("html"), "utf-8").alias("p")).select(
        "page_id", F.length("p").alias("n"), F.sha2("p", 256).alias("digest"))
    rows = rows.where((F.col("n") >= min_revisit) & F.col("page_id").isNotNull())
    kept = (rows.groupBy("digest").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("c"))
            .where("c > 1").drop("c"))
    return (rows.join(kept, "digest").where(F.col("page_id") != F.col("refers_to"))
            .select("page_id", "digest", "refers_to").distinct())


def _uuid(kind: str, of: Column) -> Column:
    h = F.md5(F.concat(F.lit(kind), of))
    part = lambda a, n: F.substring(h, a, n)
    return F.concat_ws("-", part(1, 8), part(9, 4), part(13, 4), part(17, 4), part(21, 12))


def _line(name: str, value: Column) -> Column:
    return F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit(CRLF))).otherwise("")


def records(pages: DataFrame, min_revisit: int = 1000) -> DataFrame:
    """One string per page: a WARC response, or a revisit without payload."""
    body, again = F.col("body"), F.col("refers_to").isNotNull()
    # a null id never revisits; rows of one id may differ in payload, so the digest is part of the key
    page = pages.select("page_id", "url", text_or_empty("html").alias("body")).withColumn(
        "digest", F.sha2(F.encode("body", "utf-8"), 256))
    page = page.join(revisits(pages, min_revisit), ["page_id", "digest"], "left")
    raw = F.encode(body, "utf-8")
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
                    F.length(raw).cast("string"), F.lit(CRLF * 2))
    block = F.when(again, http).otherwise(F.concat(http, body))
    target = F.regexp_replace(F.regexp_replace("url", "%", "%25"), "[\\r\\n]", "%0A")
    head = F.concat(
        F.lit(f"WARC/1.1{CRLF}WARC-Type: "), F.when(again, "revisit").otherwise("response"), F.lit(CRLF),
        F.lit("WARC-Record-ID: <urn:uuid:"),
        _uuid("record", F.concat(F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(" "), "digest")),
        F.lit(f">{CRLF}WARC-Date: {DATE}{CRLF}"),
        _line("WARC-Target-URI", target), _line("X-Page-ID", F.col("page_id")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.sha1(raw))),
        _line("X-Payload-Length", F.length(raw)),
        F.when(again, F.concat(
            F.lit(f"WARC-Profile: {REVISIT_PROFILE}{CRLF}WARC-Refers-To: <urn:uuid:"),
            _uuid("record", F.concat(F.col("refers_to").cast("string"), F.lit(" "), "digest")),
            F.lit(f">{CRLF}"), _line("X-Refers-To-Page", F.col("refers_to")))).otherwise(""),
        F.lit("Content-Type: application/http; msgtype=response"), F.lit(CRLF),
        F.lit("Content-Length: "), F.length(F.encode("block", "utf-8")).cast("string"), F.lit(CRLF * 2))
    return page.withColumn("block", block).select(F.concat(head, "block").alias("record"))


def write_monolithic(recs: DataFrame, path: str, records_per_file: int = 10_000) -> str:
    """Gzip files, each a single stream over its records."""
    (recs.write.option("compression", "gzip").option("lineSep", CRLF * 2)
     .option("maxRecordsPerFile", records_per_file).text(path))
    return path


_LENGTH = re.compile(rb"\r\nContent-Length: *(\d+)", re.I)


def split_records(chunks: Iterator[bytes]) -> Iterator[bytes]:
    """WARC records, end marks included, from the pieces of a byte stream."""
    have = bytearray()
    need = None
    for piece in chunks:
        have += piece
        while True:
            if need is None:
                end = have.find(b"\r\n\r\n")
                if end < 0:
                    break
                found = _LENGTH.search(bytes(have[:end + 2]))
                if not have.startswith(b"WARC/") or not found:
                    raise ValueError("not a WARC record")
                need = end + 4 + int(found[1]) + 4
            if len(have) < need:
                break
            one = bytes(have[:need])
            if not one.endswith(b"\r\n\r\n"):
                raise ValueError("a WARC record without its end mark")
            del have[:need]
            need = None
            yield one
    if have:
        raise ValueError("a cut WARC record")


def inflate(data: bytes, step: int = 1 << 20) -> Iterator[bytes]:
    """A gzip file's bytes, piece by piece, over all its members."""
    z, rest = zlib.decompressobj(31), memoryview(data)
    while len(rest):
        out = z.decompress(rest[:step])
        rest = rest[step:]
        while True:
            if out:
                yield out
            if not z.eof:
                break
            left = z.unused_data.lstrip(b"\0")
            while not left and len(rest):
                left, rest = bytes(rest[:step]).lstrip(b"\0"), rest[step:]
            if not left:
                return
            z = zlib.decompressobj(31)
            out = z.decompress(left)
    if not z.eof:
        raise ValueError("a cut gzip stream")


def _member(record: bytes) -> bytes:
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(record) + z.flush()


def _header(record: bytes) -> dict[str, str]:
    head = record[:record.index(b"\r\n\r\n")].decode("utf-8").split(CRLF)[1:]
    return dict(x.split(": ", 1) for x in head)


def _normalised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for data in batch.column("content"):
            members = [_member(r) for r in split_records(inflate(data.as_py()))]
            if members:
                yield pa.RecordBatch.from_arrays([pa.array([b"".join(members)], pa.binary())], ["archive"])


def normalise(spark, path: str, out: str) -> tuple[str, str]:
    """Archives of one member per record below ``out``/archives, their index
    as JSON lines below ``out``/index; returns both folders.

    The index is taken from the archives as they lie there, so its offsets
    hold for the very files that a reader will open."""
    files = spark.read.format("binaryFile").load(path).where("length > 0").select("content")
    made = files.mapInArrow(_normalised, "archive binary")
    (made.select(F.col("archive").cast("string").alias("value"))
     .write.option("lineSep", "\0").option("maxRecordsPerFile", 1).text(f"{out}/archives"))
    (read_members(spark, f"{out}/archives", payload=False)
     .select("file", "offset", "length", "record_type", "page_id").write.json(f"{out}/index"))
    return f"{out}/archives", f"{out}/index"


_READ = ("file string, offset long, length long, page_id string, url string, record_type string, "
         "payload_bytes long, payload_digest string, refers_to string, html string")


def _members(data: bytes) -> Iterator[tuple[int, int, bytes]]:
    """Offset, length and inflated bytes of each gzip member."""
    view, at = memoryview(data), 0
    while at < len(view) and view[at] != 0:
        z, start, out = zlib.decompressobj(31), at, []
        while not z.eof:
            piece = view[at:at + 8192]
            if not len(piece):
                raise ValueError("a cut gzip member")
            out.append(z.decompress(piece))
            at += len(piece) - len(z.unused_data)
        yield start, at - start, b"".join(out)


def _parsed(batches: Iterator[pa.RecordBatch], payload: bool) -> Iterator[pa.RecordBatch]:
    names = [x.split()[0] for x in _READ.split(", ")]
    for batch in batches:
        for path, data in zip(batch.column("path"), batch.column("content"), strict=True):
            rows: list[list] = []
            name = path.as_py().rpartition("/")[2]
            for offset, length, record in _members(data.as_py()):
                head = _header(record)
                start = record.index(b"\r\n\r\n") + 4
                block = record[start:start + int(head["Content-Length"])]
                body = block[block.index(b"\r\n\r\n") + 4:]
                digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
                if head["WARC-Type"] == "response" and hashlib.sha1(body).hexdigest() != digest:
                    raise ValueError(f"{name} at {offset}: the payload does not match its digest")
                url = head.get("WARC-Target-URI")
                rows.append([name, offset, length, head.get("X-Page-ID"),
                             None if url is None else url.replace("%0A", "\n").replace("%25", "%"),
                             head["WARC-Type"], int(head["X-Payload-Length"]), digest,
                             head.get("X-Refers-To-Page"), body.decode("utf-8") if payload else None])
                if len(rows) == 500:
                    yield _rows(rows, names)
                    rows = []
            if rows:
                yield _rows(rows, names)


def _rows(rows: list[list], names: list[str]) -> pa.RecordBatch:
    kind = {"offset": pa.int64(), "length": pa.int64(), "payload_bytes": pa.int64()}
    return pa.RecordBatch.from_arrays(
        [pa.array(c, kind.get(n, pa.string())) for n, c in zip(names, zip(*rows, strict=True), strict=True)], names)


def read_members(spark, archives: str, payload: bool = True) -> DataFrame:
    """One row per record of normalised archives; responses are checked
    against their digest."""
    files = spark.read.format("binaryFile").load(archives).select("path", "content")
    return files.mapInArrow(lambda b: _parsed(b, payload), _READ)


def index_faults(spark, archives: str, index: str) -> DataFrame:
    """Index entries without their member, and members without an entry."""
    idx = spark.read.schema("file string, offset long, length long, page_id string").json(index)
    there = read_members(spark, archives, payload=False).select("file", "offset", "length", "page_id")
    same = (F.col("i.file") == F.col("m.file")) & (F.col("i.offset") == F.col("m.offset")) \
        & (F.col("i.length") == F.col("m.length")) & F.col("i.page_id").eqNullSafe(F.col("m.page_id"))
    return idx.alias("i").join(there.alias("m"), same, "full").where("i.file is null or m.file is null")


def archive_round_trip(pages: DataFrame, records_per_file: int = 10_000, min_revisit: int = 1000) -> DataFrame:
    """Pages -> monolithic gzip -> normalised archives and index -> one row
    per record as read back from the archives."""
    spark = pages.sparkSession
    mono = write_monolithic(records(pages, min_revisit), shared_folder(spark, "warc-mono"), records_per_file)
    archives, _ = normalise(spark, mono, shared_folder(spark, "warc"))
    kind = pages.schema["page_id"].dataType
    return read_members(spark, archives, payload=False).select(
        F.col("page_id").cast(kind).alias("page_id"), "url", "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast(kind).alias("refers_to"))
