"""Event subscriptions: a broker topic, or a folder of record files with the same schema."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..schemas import RECORD_SCHEMA


@dataclass(frozen=True)
class TopicSource:
    """A Kafka topic.

    ``max_records_per_batch`` bounds a micro-batch, which matters for the first batch when reading a
    long topic from its start. ``min_partitions`` lets Spark split the offset range of a topic
    partition that holds far more records than the others.
    """

    servers: str = "localhost:9092"
    topic: str = "ride_events"
    group_id: str | None = "trip-events-lake"
    starting_offsets: str = "earliest"
    fail_on_data_loss: bool = False
    max_records_per_batch: int | None = None
    min_partitions: int | None = None

    def options(self) -> dict[str, str]:
        found = {
            "kafka.bootstrap.servers": self.servers,
            "subscribe": self.topic,
            "kafka.group.id": self.group_id,
            "startingOffsets": self.starting_offsets,
            "failOnDataLoss": str(self.fail_on_data_loss).lower(),
            "maxOffsetsPerTrigger": self.max_records_per_batch,
            "minPartitions": self.min_partitions,
        }
        return {name: str(value) for name, value in found.items() if value is not None}

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.readStream.format("kafka").options(**self.options()).load()


@dataclass(frozen=True)
class RecordFiles:
    """Parquet files of broker records, for replay from an archive and for runs without a broker."""

    path: str
    max_files_per_batch: int | None = None

    def read(self, spark: SparkSession) -> DataFrame:
        reader = spark.readStream.schema(RECORD_SCHEMA)
        if self.max_files_per_batch:
            reader = reader.option("maxFilesPerTrigger", self.max_files_per_batch)
        return reader.parquet(self.path)


def read_event_stream(spark: SparkSession, source: TopicSource | RecordFiles) -> DataFrame:
    return source.read(spark)


def tap_view(records: DataFrame) -> DataFrame:
    """The envelope as text, for looking at a live topic."""
    return records.select(
        F.col("key").cast("string").alias("ride_id_key"),
        F.col("value").cast("string").alias("event_json"),
        "topic", "partition", "offset",
        F.col("timestamp").alias("kafka_timestamp"),
    )


def tap_stream(
    spark: SparkSession, source: TopicSource | RecordFiles | None = None, sink: str = "console", name: str | None = None
) -> StreamingQuery:
    """Prints new records, untruncated. Without a source it follows the default topic from its end."""
    source = source or TopicSource(group_id=None, starting_offsets="latest", fail_on_data_loss=True)
    writer = tap_view(read_event_stream(spark, source)).writeStream.format(sink).outputMode("append")
    if sink == "console":
        writer = writer.option("truncate", "false")
    return (writer.queryName(name) if name else writer).start()
