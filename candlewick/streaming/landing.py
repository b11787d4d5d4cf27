"""Drain newly landed files into a stored table: the daily batch as an available-now stream.

The file source remembers which files it has read, so a repeated or restarted run neither misses
nor repeats a file; the keyed merge makes a replayed micro-batch harmless.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from candlewick.config import Config


def drain_landing(
    spark: SparkSession,
    folder: str,
    schema: str,
    checkpoint: str,
    store: Callable[[DataFrame, Config], object],
    cfg: Config,
) -> StreamingQuery:
    """Start the stream; every micro-batch of landed JSON goes through ``store(batch, cfg)`` with
    a run id of its own."""

    def handle(batch: DataFrame, number: int) -> None:
        store(batch, replace(cfg, run_id=f"{cfg.run_id}-{number}"))

    return (
        spark.readStream.schema(schema)
        .json(folder)
        .writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
