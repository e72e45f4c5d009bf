"""From delivered records to normalised events. Map-only: nothing here shuffles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fold_case, parse_event_time
from ..schemas import ENVELOPE_FIELDS, EVENT_FIELDS, EVENT_SCHEMA


def decode_envelope(records: DataFrame) -> DataFrame:
    """Broker record (binary key and value) to the text envelope, stamped with the ingestion time."""
    return records.select(
        F.col("key").cast("string").alias("kafka_key"),
        F.col("value").cast("string").alias("raw_json"),
        "topic",
        "partition",
        "offset",
        F.col("timestamp").alias("kafka_timestamp"),
        F.current_timestamp().alias("ingested_at"),
        F.to_date(F.current_timestamp()).alias("ingestion_date"),
    )


def _kept(df: DataFrame) -> list[str]:
    return [name for name in ENVELOPE_FIELDS if name in df.columns]


def parse_event(envelope: DataFrame) -> DataFrame:
    """Adds the fields of ``raw_json``; malformed text gives null fields and never fails.

    The parse sits in a generator rather than in a projection: filters on parsed fields are then
    not rewritten into repeated parses of the same text below it, so each record is parsed once.
    """
    event = F.from_json("raw_json", EVENT_SCHEMA, {"mode": "PERMISSIVE"})
    return envelope.select(*_kept(envelope), F.inline(F.array(event)))


def flatten_event(parsed: DataFrame) -> DataFrame:
    """Normalises the parsed fields: folded categories, typed event time, all else untouched."""
    typed = {
        "event_type": fold_case(F.col("event_type")),
        "payment_method": fold_case(F.col("payment_method")),
        "payment_status": fold_case(F.col("payment_status")),
        "event_timestamp": parse_event_time(F.col("event_timestamp")),
    }
    fields = [typed.get(name, F.col(name)).alias(name) for name in EVENT_FIELDS]
    return parsed.select(*fields, *_kept(parsed))


def normalise(envelope: DataFrame) -> DataFrame:
    return flatten_event(parse_event(envelope))
