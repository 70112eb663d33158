"""Streaming forms: 5-minute glucose, dedupe, anchors, sliding counts, static enrichment, online scoring.

Watermarks bound the state.  An event later than the watermark is dropped, and
an event older than its patient's current anchor is its own anchor: the one
place where a stream and a batch over the same late data may differ.

Anchors and sliding counts are stateful processors (``processors.py``).  Their state lies
in RocksDB, which Spark asks for; streams built here choose it for their session.
"""

from __future__ import annotations

from typing import Callable

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from caseflow.config import BF24H
from caseflow.functions import timegrid as tg
from caseflow.operators.records import localize, resolve_tz
from caseflow.streaming.processors import Anchors, SlidingInfo

_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def stream_glucose_record(
    raw: DataFrame, human: DataFrame, value: str = "BGValue", watermark: str = "30 minutes"
) -> DataFrame:
    """Raw glucose entries to 5-minute means in local time, as the batch record makes them.

    Rows that are equal in full are one reading if they come within the watermark.
    """
    d = raw.join(human.select("PatientID", "user_tz"), "PatientID", "left")
    d = localize(resolve_tz(d, "TimezoneOffset"), "ObservationDateTime", None)
    d = d.withColumn("_at", F.col("DT_s").cast("timestamp")).withWatermark("_at", watermark)
    d = d.dropDuplicatesWithinWatermark(raw.columns)
    return stream_glucose_5min(d, "PatientID", "_at", value, None)


def stream_glucose_5min(
    events: DataFrame, key: str, time: str, value: str, watermark: str | None = "30 minutes"
) -> DataFrame:
    """Mean reading per patient and 5-minute step; ``time`` is a timestamp.

    In append mode a step comes out once the watermark has passed it; in update mode at
    once and again when it changes (``run_updates`` keeps the last).
    """
    events = events.withWatermark(time, watermark) if watermark else events
    return (
        events.groupBy(key, F.window(time, "5 minutes").alias("w"))
        .agg(F.avg(value).alias(value))
        .select(key, F.col("w.start").alias("DT_s"), value)
    )


def stream_dedupe(events: DataFrame, keys: list[str], time: str, watermark: str = "30 minutes") -> DataFrame:
    """One of each set of equal rows seen within the watermark."""
    return events.withWatermark(time, watermark).dropDuplicatesWithinWatermark(keys)


def _processed(events: DataFrame, key: str, time: str, watermark: str, processor, columns: str) -> DataFrame:
    """Events (key, at_us and others) through a stateful processor, one state per key."""
    spark = events.sparkSession
    if "RocksDB" not in spark.conf.get(_STORE):
        spark.conf.set(_STORE, _ROCKSDB)
    kind = events.schema[key].dataType.simpleString()
    return (
        events.withWatermark(time, watermark)
        .groupBy(key)
        .transformWithStateInPandas(processor, f"`{key}` {kind}, {columns}", "Append", "EventTime")
    )


def stream_densify(
    events: DataFrame, key: str, time: str, gap_minutes: int = 31, watermark: str = "1 hour"
) -> DataFrame:
    """Events with their anchor time; the state of a patient is one number, the current anchor.

    A patient quiet for longer than the gap and the watermark loses its state,
    as its next event is an anchor anyway.
    """
    slim = events.select(key, time, F.unix_micros(time).alias("at_us"))
    walk = Anchors(key, gap_minutes * tg.MINUTE)
    return _processed(slim, key, time, watermark, walk, "event_us bigint, anchor_us bigint")


def stream_sliding_info(
    readings: DataFrame, key: str, time: str, value: str, watermark: str = "1 hour"
) -> DataFrame:
    """Every reading with what the 24 hours before it hold (the before-window information).

    Readings are on the 5-minute grid, so a patient's state is at most a day and the
    watermark of them: what the latest reading still accepted can look back to.  A
    patient quiet for that long loses it.
    """
    slim = readings.select(key, time, F.unix_micros(time).alias("at_us"), F.col(value).cast("double").alias("reading"))
    look = SlidingInfo(key, BF24H.lo, BF24H.hi, int(pd.Timedelta(watermark) // pd.Timedelta("1us")))
    columns = "obs_us bigint, ModePercent double, ZeroPercent double, Geq400Percent double, Leq20Percent double, RecNum bigint"
    return _processed(slim, key, time, watermark, look, columns)


def stream_static_enrich(events: DataFrame, patients: DataFrame, key: str) -> DataFrame:
    """Events with the patient's static attributes."""
    return events.join(patients, key, "left")


def stream_predictions(
    forms: DataFrame, answer: Callable[[DataFrame], DataFrame], path: str, checkpoint: str
):
    """Each micro-batch of forms through the same batch functions, answers appended to ``path``.

    A batch is written under its own id, so a replayed batch replaces itself.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        answer(batch).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return (
        forms.writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def run_to_table(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> None:
    """Run a stream over what its source holds now, into parquet at ``path``."""
    q = (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode(mode)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()


def run_updates(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Run an update-mode stream over what its source holds now; every batch of changes is
    written under its own id, so a replayed batch replaces itself."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    q = (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .outputMode("update")
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()


def latest(updates: DataFrame, keys: list[str]) -> DataFrame:
    """The last version of each row of ``run_updates``."""
    rest = [c for c in updates.columns if c not in (*keys, "batch")]
    last = F.max_by(F.struct(*rest), "batch").alias("_last")
    return updates.groupBy(*keys).agg(last).select(*keys, "_last.*")
