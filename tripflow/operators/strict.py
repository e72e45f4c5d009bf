"""Whole-load constraints of the staging table: one bad row aborts the load."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import STAGING_MAX_LENGTH, STAGING_REQUIRED


class StrictLoadError(ValueError):
    """Names the broken constraints and, for a load of files, the first lines that are no whole event."""

    def __init__(self, violations: dict[str, int], lines: list[tuple[str, int, str]] = ()):
        self.violations, self.lines = violations, lines
        text = "load rejected: " + ", ".join(f"{k} ({n} rows)" for k, n in violations.items())
        super().__init__(text + "".join(f"\n  {file}, line {number}: {line}" for file, number, line in lines))


def constraints(columns: list[str]) -> dict[str, Column]:
    """Name to violation predicate, for a frame of staging rows.

    Rows read from files also carry ``whole_event`` and ``fare_text``, which show an absent JSON field
    and an amount that ``numeric(10,2)`` cannot hold.
    """
    found = {f"{name}_not_null": F.col(name).isNull() for name in STAGING_REQUIRED}
    found |= {f"{name}_max_length": F.length(name) > limit for name, limit in STAGING_MAX_LENGTH.items()}
    if "whole_event" in columns:
        found["one_whole_event_per_line"] = ~F.col("whole_event")
    if "fare_text" in columns:
        found["fare_usd_numeric"] = F.col("fare_text").isNotNull() & F.col("fare_usd").isNull()
    return found


def broken_constraints(rows: DataFrame) -> Column:
    """Names of the constraints that a row breaks, comma-separated; empty for a good row."""
    names = [F.when(broken, F.lit(name)) for name, broken in constraints(rows.columns).items()]
    return F.concat_ws(",", *names)


def violation_counts(rows: DataFrame) -> list[Column]:
    """Aggregates for one pass over the rows, alone or observed during a write."""
    return [F.count_if(broken).alias(name) for name, broken in constraints(rows.columns).items()]


def strict_violations(rows: DataFrame) -> DataFrame:
    """One row per constraint with the number of rows that break it."""
    counts = rows.agg(*violation_counts(rows))
    return counts.unpivot([], counts.columns, "constraint_name", "violations")


def raise_if_violated(counts: dict[str, int]) -> None:
    broken = {name: n for name, n in counts.items() if n}
    if broken:
        raise StrictLoadError(broken)


def check_strict(rows: DataFrame) -> DataFrame:
    """Returns the rows unchanged, or raises before anything is written."""
    raise_if_violated(rows.agg(*violation_counts(rows)).first().asDict())
    return rows
