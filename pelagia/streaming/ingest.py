"""Incremental ingest: a file stream through the batch transforms into an upserted table."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from pelagia.sources.store import upsert


def start_ingest(
    spark: SparkSession, source: str, schema: T.StructType, target: str, checkpoint: str, transform: Callable[[DataFrame], DataFrame], keys: Sequence[str],
    by: str = "filename", order: Sequence[str] = (), file_format: str = "parquet", files_per_batch: int = 1000, once: bool = True,
) -> StreamingQuery:
    """Reads new files as a stream and upserts each micro-batch by source file.

    The upsert replaces all rows of a batch's files, so a batch that is run again after a
    failure changes nothing; no watermark is needed.
    """
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).format(file_format).load(source)

    def write(batch: DataFrame, _: int) -> None:
        if not batch.isEmpty():
            upsert(batch.sparkSession, target, transform(batch), keys, by, order)

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
