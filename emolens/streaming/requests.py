"""Recommendation requests as a stream (batch ``recommend_batch`` per
micro-batch).

The source answers one request at a time interactively; here requests
arrive as files, each micro-batch is joined with the (static, materialised)
scored catalogue by ``foreachBatch`` and written below the sink.  The request
key table per batch is tiny, the catalogue is read, not rebuilt.  Progress
is tracked in a checkpoint folder.  A batch that is run again after a failure
overwrites its own ``batch_id`` folder, so the sink holds every answer once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from emolens.operators.recommend import recommend_batch


def serve_requests(spark: SparkSession, source_dir: str, schema: StructType,
                   to_requests: Callable[[DataFrame], DataFrame], catalogue: DataFrame,
                   sink_dir: str, checkpoint_dir: str, glob: str | None = None,
                   available_now: bool = True):
    """Start the streaming query; returns the ``StreamingQuery``.

    ``to_requests`` maps source rows to request rows (request_id,
    predicted_label, preferred_genre, minimum_rating, n)."""
    reader = spark.readStream.schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    stream = reader.parquet(source_dir)

    def answer(batch: DataFrame, batch_id: int) -> None:
        recs = recommend_batch(to_requests(batch), catalogue, fallback=True)
        recs.write.mode("overwrite").parquet(f"{sink_dir.rstrip('/')}/batch_id={batch_id}")

    w = stream.writeStream.foreachBatch(answer).option("checkpointLocation", checkpoint_dir)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()
