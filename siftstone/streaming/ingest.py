"""Structured Streaming: files as sources, committed batch by batch; windows, late data, bounded keyed state."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from pathlib import PurePosixPath

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from siftstone.runtime import shared_dir


def file_stream(spark: SparkSession, path: str, files: int = 4) -> DataFrame:
    """Parquet files of a folder as a stream, at most `files` a batch, so a full queue slows the source and not the sink."""
    where = PurePosixPath(path)
    schema = spark.read.parquet(path).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).option("pathGlobFilter", where.name if where.suffix else "*").parquet(str(where.parent))


def drained(stream: DataFrame, commit: Callable[[DataFrame, int], None], base: str, mode: str = "append") -> None:
    """Runs until no file is left; the checkpoint holds what was read, so a run after a failure goes on behind the last committed batch."""
    query = stream.writeStream.outputMode(mode).foreachBatch(commit).option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start()
    try:
        query.awaitTermination()
    finally:
        query.stop()


def fresh(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"


def totals(spark: SparkSession, path: str, files: int = 4) -> DataFrame:
    """Per-user counts and sums of an event file stream. Each micro-batch writes its partial sums under its own number, so a repeated batch overwrites itself."""
    base = fresh(spark)

    def commit(batch: DataFrame, number: int) -> None:
        batch.groupBy("user_id").agg(F.count("*").alias("n"), F.sum("value").alias("total")).write.mode("overwrite").parquet(f"{base}/parts/batch={number}")

    drained(file_stream(spark, path, files), commit, base)
    return spark.read.parquet(f"{base}/parts").groupBy("user_id").agg(F.sum("n").alias("n"), F.round(F.sum("total"), 4).alias("total"))


def windows(spark: SparkSession, path: str, width: str = "1 day", late: str = "30 days") -> DataFrame:
    """Events by type and tumbling window; an event_id counts once, and what comes later than `late` behind the newest event is dropped. The last batch that touched a window holds its count."""
    base = fresh(spark)
    events = file_stream(spark, path).withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late).dropDuplicatesWithinWatermark(["event_id"])
    counted = events.groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count("*").alias("n"))

    def commit(batch: DataFrame, number: int) -> None:
        batch.select(F.col("w.start").alias("window_start"), "event_type", "n").write.mode("overwrite").parquet(f"{base}/parts/batch={number}")

    drained(counted, commit, base, "update")
    parts = spark.read.parquet(f"{base}/parts")
    return parts.groupBy("window_start", "event_type").agg(F.max_by("n", "batch").alias("n"))


def least_of_each(spark: SparkSession, path: str, key: str = "event_type", value: str = "event_id", k: int = 20) -> DataFrame:
    """The k least values of each key, kept as bounded state over the whole stream: in whatever order and batches they come, the result is the same."""
    base = fresh(spark)

    def keep(who: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = list(state.get[0]) if state.exists else []
        for frame in frames:
            held = sorted({*held, *frame[value].tolist()})[:k]
        state.update((held,))
        yield pd.DataFrame({key: [who[0]] * len(held), value: held})

    stream = file_stream(spark, path).select(key, value).groupBy(key).applyInPandasWithState(keep, f"{key} string, {value} bigint", "held array<bigint>", "update", GroupStateTimeout.NoTimeout)

    def commit(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{base}/parts/batch={number}")

    drained(stream, commit, base, "update")
    parts = spark.read.parquet(f"{base}/parts")
    last = parts.groupBy(F.col(key).alias("__k")).agg(F.max("batch").alias("__b"))
    return parts.join(last, (F.col(key) == F.col("__k")) & (F.col("batch") == F.col("__b"))).select(key, value)


def commit_sources(spark: SparkSession, matches: DataFrame, root: str, base: str, now: str, closed: DataFrame | None = None) -> None:
    """Matches of a stream committed source by source: a batch replaces what was committed of its sources, so a repeated batch changes nothing.

    matches: a streaming DataFrame of output records in which a source is complete within a batch (one file is one source). Late rows of sources in closed
    (source_file) are dropped; a retry takes its source out of closed first.
    """
    from siftstone.sources import output

    def commit(batch: DataFrame, number: int) -> None:
        rows = batch if closed is None else batch.join(closed.select("source_file").distinct(), "source_file", "left_anti")
        output.commit(spark, root, rows, rows.select("source_file").distinct(), now, run=f"batch-{number}")

    drained(matches, commit, base)
