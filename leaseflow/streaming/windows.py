"""Live window tables: watermark, tumbling window, look-up at output time."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from typing import Any

from pyspark.sql import DataFrame, functions as F

from leaseflow.functions import decode as D
from leaseflow.functions import fields as X
from leaseflow.operators import windows as W
from leaseflow.sources import tables as ST


def windowed(facts: DataFrame, spec: W.WindowSpec, epoch0: bool = False) -> DataFrame:
    """Fact stream -> closed windows. Rows behind the watermark are dropped (they show
    as ``numRowsDroppedByWatermark`` in the query progress)."""
    rows = W.measured_rows(facts, spec, epoch0)
    rows = rows.withColumn("ts", D.wall_as_instant("ts")).withWatermark("ts", W.DISORDER)
    return W.aggregate(rows, spec)


def output_rows(closed: DataFrame, spec: W.WindowSpec,
                dims: Mapping[str, DataFrame]) -> DataFrame:
    """Closed windows of one batch -> stored rows with current dimension columns."""
    wall = closed.withColumn("_w", F.struct(
        D.instant_as_wall("_w.start").alias("start"), D.instant_as_wall("_w.end").alias("end")))
    return W.enrich(W.with_bounds(wall), spec, dims)


def start(topic: DataFrame, name: str, dims: Callable[[], Mapping[str, DataFrame]], path: str,
          checkpoint: str, trigger: dict[str, Any] | None = None, epoch0: bool = False):
    """Fact topic (``value`` JSON) -> window table.

    ``dims`` is asked once per batch, so each batch sees the dimension rows that have
    arrived by then.
    """
    spec = W.SPECS[name]
    closed = windowed(X.read_fact_json(topic, spec.fact), spec, epoch0)

    def write(batch: DataFrame, batch_id: int) -> None:
        ST.replace_aggregate(output_rows(batch, spec, dims()), path,
                             ST.Batch(ST.stream_writer(checkpoint), batch_id))

    return (closed.writeStream.foreachBatch(write).outputMode("append")
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "10 seconds"})).start())
