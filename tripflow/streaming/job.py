"""The streaming path: subscribe, parse, validate, and route each micro-batch to the lake zones."""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.parse import decode_envelope, normalise
from ..operators.quality import metric_columns
from ..operators.validate import validate
from ..operators.zones import clean_zone, rejected_zone
from ..sources.streams import RecordFiles, TopicSource, read_event_stream
from .lake import Lake

log = logging.getLogger("tripflow.streaming")

TRIGGER = "15 seconds"
QUERY_NAME = "ride_events_to_lake"
_COMPRESSED = "spark.sql.inMemoryColumnarStorage.compressed"


def validated_stream(spark: SparkSession, source: TopicSource | RecordFiles) -> DataFrame:
    """A map-only plan from the source to validated events."""
    return validate(normalise(decode_envelope(read_event_stream(spark, source))))


def _checkpoint_identity(batch: DataFrame) -> str:
    """Id of the running query. It is stored in the checkpoint: a restart keeps it, a new checkpoint
    (whose batch numbers start again at 0) gets another one."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "batch"


def route_batch(
    batch: DataFrame, batch_id: int, lake: Lake, run_id: str | None = None, show_samples: int = 0, expected: int | None = None
) -> dict[str, int]:
    """Writes one validated micro-batch to its three zones and returns its counts.

    The source is read and parsed once: writing the raw zone, which takes every record, fills the cache and observes the counts on the
    way, and the other zones are written from the cache. ``expected`` is about how many records will come, such as the
    last batch had; it decides how many tasks write the raw zone. Without it as many do as hold the batch, up to the cores.
    """
    run_id = run_id or _checkpoint_identity(batch)
    conf, before = batch.sparkSession.conf, batch.sparkSession.conf.get(_COMPRESSED)
    # Looking for an encoding of every column takes as long as the parse, and most texts of a batch are different ones.
    conf.set(_COMPRESSED, "false")
    batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        counts = Observation()
        lake.write_raw(batch.observe(counts, *metric_columns()), run_id, batch_id, expected)
        metrics = dict(counts.get)
        log.info("batch %s: %s", batch_id, metrics)
        if show_samples and metrics["total"]:
            clean_zone(batch).show(show_samples, truncate=False)
            rejected_zone(batch).show(show_samples, truncate=False)
        if metrics["valid"]:
            lake.write_clean(batch, run_id, batch_id, metrics["valid"])
        if metrics["rejected"]:
            lake.write_rejected(batch, run_id, batch_id, metrics["rejected"])
        return metrics
    finally:
        conf.set(_COMPRESSED, before)
        batch.unpersist()


def start_streaming(
    spark: SparkSession,
    source: TopicSource | RecordFiles,
    lake: Lake,
    checkpoint: str,
    trigger: str | None = TRIGGER,
    on_metrics: Callable[[int, dict[str, int]], None] | None = None,
    show_samples: int = 0,
) -> StreamingQuery:
    """Starts the job. ``trigger=None`` drains what is available and stops (backfills, tests)."""

    last: dict[str, int] = {}

    def sink(batch: DataFrame, batch_id: int) -> None:
        metrics = route_batch(batch, batch_id, lake, show_samples=show_samples, expected=last.get("total"))
        last.update(metrics)
        if on_metrics:
            on_metrics(batch_id, metrics)

    writer = (
        validated_stream(spark, source)
        .writeStream.queryName(QUERY_NAME)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(sink)
    )
    writer = writer.trigger(processingTime=trigger) if trigger else writer.trigger(availableNow=True)
    return writer.start()


def run_streaming(spark: SparkSession, source: TopicSource | RecordFiles, lake: Lake, checkpoint: str, **options) -> None:
    """Runs the job until it stops or fails."""
    start_streaming(spark, source, lake, checkpoint, **options).awaitTermination()
