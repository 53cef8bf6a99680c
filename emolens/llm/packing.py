"""Packing documents into sequences along a space-filling curve.

Every document is tokenised once; its ids are hashed into a vector of a few
random projections, the vector is quantised and its place on a Hilbert curve
taken.  Documents are range-sorted by that place, laid end to end along the
curve and cut every `length` ids: neighbours on the curve share sequences and
only the last sequence of the table is padded.

Scale: the ids are written once as 16- or 32-bit integers; only (place, row,
length) is range-sorted.  Equal places (copies of one document may be a third
of all) are ordered by a hash of the row, which is part of the sort key, so
they spread over many partitions.  Start offsets are sums: one total per
partition goes to the driver (as many numbers as partitions), running sums
within partitions stay on the executors.

Cases: a null or empty text is the end id alone; repeated rows and ids, null
ids: every row is packed as a document of its own; ties on the curve are
ordered by row hash; an empty table gives no pieces.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from emolens.llm import bpe
from emolens.llm.common import free_name, text_chunks, written

SEQUENCE = 4096
END = 2
DIMS, BITS, SEED = 4, 8, 20_240
#: Rows of ids handled at once inside a task, and bytes of ids gathered by its writer.
ROWS, ROW_GROUP = 1000, 16_000_000


@lru_cache(maxsize=4)
def _directions(size: int, dims: int, seed: int) -> np.ndarray:
    """A random sign per hashed token and dimension."""
    return np.random.default_rng(seed).choice(np.array([-1, 1], np.int8), size=(size, dims))


def project(ids: np.ndarray, starts: np.ndarray, dims: int = DIMS, seed: int = SEED, buckets: int = 1 << 16) -> np.ndarray:
    """Hashed document vectors (token counts) projected to ``dims`` numbers
    of about unit variance; ``starts`` marks the documents within ``ids``."""
    table = _directions(buckets, dims, seed)
    hashed = (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(48)).astype(np.int64) % buckets
    size = np.diff(np.append(starts, len(ids)))
    out = np.empty((len(starts), dims))
    for d in range(dims):
        out[:, d] = np.add.reduceat(table[hashed, d].astype(np.int32), starts) if len(ids) else 0
    return out / np.sqrt(np.maximum(size, 1))[:, None]


def quantise(vectors: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Cells of 2^bits per dimension; the squash keeps outliers apart."""
    cells = 1 << bits
    unit = 0.5 + np.arctan(vectors / 4) / np.pi
    return np.clip((unit * cells).astype(np.int64), 0, cells - 1)


def hilbert(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Places on the Hilbert curve through a grid of 2^bits cells a side
    (the transpose form: undo excess work bit by bit, then Gray-decode)."""
    x = cells.T.astype(np.int64).copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(n):
            up = (x[i] & q) != 0
            swap = np.where(up, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(up, x[0] ^ p, x[0] ^ swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        t = np.where((x[n - 1] & q) != 0, t ^ (q - 1), t)
        q >>= 1
    x ^= t
    place = np.zeros_like(t)
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            place = (place << 1) | ((x[i] >> b) & 1)
    return place


def tokenised(docs: DataFrame, path: str, keep: list[str], end: int | None = END, text: str = "text") -> DataFrame:
    """``keep`` with the row's ids (packed integers), their number and the
    document's place on the curve."""
    names = {n: free_name(keep, n) for n in ("ids", "n_ids", "place")}
    schema = StructType([docs.schema[c] for c in keep] + [
        StructField(names["ids"], BinaryType(), False), StructField(names["n_ids"], LongType(), False),
        StructField(names["place"], LongType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = bpe.load(path)
        kind = "<u2" if max(enc.tokens) < 1 << 16 else "<u4"
        tail = b"" if end is None else np.array([end], "<u4").tobytes()
        for rows, texts in text_chunks(batches, text, bpe.SLICE):
            packed = [x + tail for x in enc.encode_all(texts)]
            sizes = np.array([len(p) // 4 for p in packed], np.int64)
            flat = np.frombuffer(b"".join(packed), "<u4")
            starts = np.cumsum(sizes) - sizes
            vectors = np.zeros((len(sizes), DIMS))
            if (sizes > 0).any():
                vectors[sizes > 0] = project(flat, starts[sizes > 0])
            small = flat.astype(kind)
            yield pa.RecordBatch.from_arrays(
                [*(rows.column(c) for c in keep),
                 pa.array([small[a:a + n].tobytes() for a, n in zip(starts, sizes, strict=True)], pa.binary()),
                 pa.array(sizes, pa.int64()), pa.array(hilbert(quantise(vectors)), pa.int64())],
                [*keep, *names.values()])

    return docs.select(*dict.fromkeys([*keep, text])).mapInArrow(run, schema)


def starts_along(rows: DataFrame, size: str, order: list[str], start: str = "start_at") -> DataFrame:
    """Rows with the sum of ``size`` over all rows before them in ``order``.

    Range-sorted once and written, so that every later read sees the same
    partitions; then one total per partition and running sums within them."""
    sorted_ = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    part, at = free_name(rows.columns, "part"), free_name(rows.columns, "at")
    fixed = written(sorted_.withColumn(part, F.spark_partition_id()), "sorted")
    totals = {r[0]: r[1] for r in fixed.groupBy(part).agg(F.sum(size)).collect()}
    before, run = [], 0
    for p in sorted(totals):
        before.append((p, run))
        run += totals[p] or 0
    # one number per partition of the sort
    offsets = rows.sparkSession.createDataFrame(before, f"{part} int, {at} long")
    within = Window.partitionBy(part).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    running = F.coalesce(F.sum(size).over(within), F.lit(0))
    return fixed.join(F.broadcast(offsets), part).withColumn(start, running + F.col(at)).drop(part, at)


def checksum(ids: bytes, length: int) -> int:
    """The CRC-32 of packed ids as unsigned 32-bit little-endian integers."""
    return zlib.crc32(np.frombuffer(ids, f"<u{len(ids) // length}").astype("<u4").tobytes())


def pack(docs: DataFrame, path: str, length: int = SEQUENCE, end: int | None = END,
         key: str = "doc_id", text: str = "text", checksums: bool = False) -> DataFrame:
    """One row per piece: key, ``start``, ``length``, ``piece_ids`` (binary,
    packed), ``doc_tokens``, ``sequence_id``, ``offset``; with ``checksums``
    the task that cuts a piece gives ``ids_crc32`` in place of its ids."""
    row, tie = free_name([key], "row_key"), free_name([key], "tie")
    table = written(tokenised(docs, path, [key], end, text).withColumn(row, F.monotonically_increasing_id()), "ids", ROW_GROUP)
    narrow = table.select(row, "n_ids", "place").withColumn(tie, F.xxhash64(row))
    placed = starts_along(narrow, "n_ids", ["place", tie, row]).select(row, "start_at")
    schema = StructType([table.schema[key]] + [StructField(n, LongType(), False) for n in (
        "start", "length")] + [StructField("ids_crc32", LongType(), False) if checksums else StructField("piece_ids", BinaryType(), False)] + [
        StructField(n, LongType(), False) for n in ("doc_tokens", "sequence_id", "offset")])
    joined = table.select(key, row, "ids", "n_ids").join(placed, row).select(key, "ids", "n_ids", "start_at")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(a, ROWS) for b in batches for a in range(0, b.num_rows, ROWS)):
            which, cols = [], {n: [] for n in schema.names[1:]}
            ids = batch.column("ids").to_pylist()
            for i, (n, at) in enumerate(zip(batch.column("n_ids").to_pylist(), batch.column("start_at").to_pylist(), strict=True)):
                width, begin = len(ids[i]) // n if n else 0, 0
                while begin < n:
                    seq, off = divmod(at + begin, length)
                    size = min(n - begin, length - off)
                    which.append(i)
                    piece = ids[i][begin * width:(begin + size) * width]
                    if checksums:
                        piece = checksum(piece, size)
                    for name, v in zip(schema.names[1:], (begin, size, piece, n, seq, off), strict=True):
                        cols[name].append(v)
                    begin += size
            if which:
                yield pa.RecordBatch.from_arrays(
                    [batch.column(key).take(pa.array(which)),
                     *(pa.array(v, pa.binary() if n == "piece_ids" else pa.int64()) for n, v in cols.items())], schema.names)

    return joined.mapInArrow(run, schema)



def piece_checksums(pieces: DataFrame, key: str = "doc_id") -> DataFrame:
    """Pieces with the CRC-32 of their ids (unsigned 32-bit little-endian) in
    place of the ids."""
    keep = [key, "start", "length", "doc_tokens", "sequence_id", "offset"]
    schema = StructType([pieces.schema[c] for c in keep] + [StructField("ids_crc32", LongType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (x.slice(a, ROWS) for x in batches for a in range(0, x.num_rows, ROWS)):
            crc = [checksum(x, n) for n, x in zip(b.column("length").to_pylist(), b.column("piece_ids").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), pa.array(crc, pa.int64())], schema.names)

    return pieces.mapInArrow(run, schema)
