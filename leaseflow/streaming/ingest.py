"""Raw ingest and dimension tables as streams."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame

from leaseflow.operators import dimensions as DIM
from leaseflow.sources import changes as C
from leaseflow.sources import tables as ST


def start_routing(log: DataFrame, send: ST.Send, checkpoint: str,
                  trigger: dict[str, Any] | None = None):
    """Captured change log -> one topic per source table."""
    def write(batch: DataFrame, batch_id: int) -> None:
        send(C.route_by_table(batch).withColumn("key", C.message_key()), batch_id)

    return (log.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "10 seconds"})).start())


def start_dimension(log: DataFrame, table: str, path: str, checkpoint: str,
                    trigger: dict[str, Any] | None = None):
    """Change log of one dimension -> its upsert table.

    Within a batch only the last image per id is stored.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        rows = DIM.upsert_latest(DIM.dimension_changes(batch, table), ["id"], ["arrival"],
                                 keep_order=True)
        ST.upsert_dimension(rows, path, ST.Batch(ST.stream_writer(checkpoint), batch_id))

    return (log.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "10 seconds"})).start())


def topic_log(spark, topic_root: str, topic: str,
              files_per_batch: int = C.FILES_PER_BATCH) -> DataFrame:
    """One topic folder as a stream of (arrival, value)."""
    reader = (spark.readStream.schema(C.LOG_SCHEMA).option("recursiveFileLookup", "true")
              .option("maxFilesPerTrigger", files_per_batch))
    return reader.json(f"{topic_root}/topic={topic}")
