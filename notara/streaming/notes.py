"""Structured Streaming over notes: per-note stages need no state; repeated notes are dropped within a watermark."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

SCHEMA = "note_id string, text string, received timestamp"


def read_notes(spark: SparkSession, path: str, schema: str = SCHEMA, files_per_trigger: int = 100) -> DataFrame:
    """Notes of the JSON line files that arrive in a folder."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).json(path)


def drop_repeats(notes: DataFrame, key: str = "note_id", time: str = "received", late: str = "1 hour") -> DataFrame:
    return notes.withWatermark(time, late).dropDuplicatesWithinWatermark([key])


def run(notes: DataFrame, stage: Callable[[DataFrame], DataFrame], sink: Callable[[DataFrame, int], None], checkpoint: str, once: bool = True) -> StreamingQuery:
    """Each micro-batch goes through the batch stage and to the sink, which must be idempotent by batch number."""
    writer = notes.writeStream.option("checkpointLocation", checkpoint).foreachBatch(lambda df, n: sink(stage(df), n))
    return (writer.trigger(availableNow=True) if once else writer).start()
