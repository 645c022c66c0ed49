"""Subtitle files as they arrive: each new file is cut into units once; sessions of cues under a watermark."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources import srt


def file_stream(spark: SparkSession, folder: str, files_per_batch: int = 1000) -> DataFrame:
    """New files under a folder as rows: path, text, encoding, bom."""
    raw = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length bigint, content binary").option("maxFilesPerTrigger", files_per_batch).option("recursiveFileLookup", "true").load(folder)
    return raw.select("path", srt.decoded("content").alias("d")).select("path", "d.*")


def process_new(stream: DataFrame, plan: Callable[[DataFrame], DataFrame], output: str, checkpoint: str) -> StreamingQuery:
    """Runs a batch plan over each micro batch and writes it under the batch's own number.

    A batch that is run again overwrites what its first run left, so that nothing is there twice and nothing that was
    written before is read. Each batch is a folder ``batch=N``, a partition of the output table."""

    def add(batch: DataFrame, number: int) -> None:
        plan(batch).write.mode("overwrite").parquet(f"{output}/batch={number}")

    return stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def chapter_sessions(cues: DataFrame, time: str = "event_time", watermark: str = "10 minutes", gap: str = "30 seconds") -> DataFrame:
    """Sessions of cues per file and kind: one ends after a pause longer than the gap. Cues later than the watermark are dropped."""
    late = cues.withWatermark(time, watermark)
    return late.groupBy("file_id", "kind", F.session_window(time, gap)).agg(F.count("*").alias("cues"), F.min(time).alias("first"), F.max(time).alias("last"))
