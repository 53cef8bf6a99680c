"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from emolens.session import ensure_checkpoint_dir

#: Separators of words: space and the ASCII controls tab to carriage return.
SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"

#: Bytes of text handled at once inside a task.
CHUNK_BYTES = 2_000_000


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new path below the cluster's shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, row_group: int | None = None) -> DataFrame:
    """``df`` written as a table in the shared folder and read back.

    A lost executor then costs a reread, never a replay of the plan; row
    keys made by ``monotonically_increasing_id`` are fixed by it.
    ``row_group``: bytes that a writing task gathers before it writes.
    """
    path = shared_folder(df.sparkSession, name)
    out = df.write if row_group is None else df.write.option("parquet.block.size", row_group)
    out.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(columns: list[str], wanted: str) -> str:
    """``wanted``, with underscores until no column has that name."""
    taken = {c.lower() for c in columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def map_in_arrow(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: StructType) -> DataFrame:
    """``df.mapInArrow`` for columns of any name.  Spark can't address a name
    with a dot there, so columns travel under numbers; ``run`` sees the names."""
    names, numbers = df.columns, lambda n: [f"c{i}" for i in range(n)]

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in run(b.rename_columns(names) for b in batches):
            yield b.rename_columns(numbers(len(schema)))

    out = StructType([StructField(f"c{i}", f.dataType, f.nullable) for i, f in enumerate(schema)])
    return df.toDF(*numbers(len(names))).mapInArrow(named, out).toDF(*schema.names)


def text_or_empty(column: str = "text"):
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def text_chunks(batches: Iterator[pa.RecordBatch], column: str = "text",
                limit: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Slices of Arrow batches holding about ``limit`` bytes of text
    (one row at least), with the texts; a null text is empty."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        start = size = 0
        for i, n in enumerate([*sizes, limit]):
            size += n
            if size >= limit:
                end = min(i + 1, len(sizes))
                if end > start:
                    rows = batch.slice(start, end - start)
                    yield rows, [t or "" for t in rows.column(column).to_pylist()]
                start, size = end, 0
