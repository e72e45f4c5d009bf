"""Column layouts of the lake zones."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..schemas import CLEAN_ZONE_SCHEMA, RAW_ZONE_SCHEMA, REJECTED_ZONE_SCHEMA
from .validate import split_valid


def raw_zone(envelope: DataFrame) -> DataFrame:
    """Every record as delivered; parsed columns, where there are any, are left out."""
    return envelope.select(*RAW_ZONE_SCHEMA.fieldNames())


def clean_zone(validated: DataFrame) -> DataFrame:
    """Valid events, typed and normalised."""
    valid, _ = split_valid(validated)
    return valid.select(*CLEAN_ZONE_SCHEMA.fieldNames())


def rejected_zone(validated: DataFrame) -> DataFrame:
    """Rejected records with their reason and original text."""
    _, rejected = split_valid(validated)
    return rejected.select(*REJECTED_ZONE_SCHEMA.fieldNames())
