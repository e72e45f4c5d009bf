"""Trip-event ingestion, validation and star-schema loading on Spark."""
