"""The batch path, from event files to a keyed star schema."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

from ..operators.dims import DIMENSIONS
from ..operators.facts import FACTS
from ..operators.marts import MARTS
from ..sources.files import newest_file
from ..sources.landing import land_raw_files
from .warehouse import Warehouse


def _together(spark: SparkSession, load: Callable[[str], int], names: Iterable[str]) -> dict[str, int]:
    """Runs independent loads at the same time, so that the tail of one does not leave the cluster idle."""
    names = list(names)
    with ThreadPoolExecutor(len(names)) as pool:
        # Wrapped once per load: a wrapper carries one set of local properties, which jobs write to.
        running = {name: pool.submit(inheritable_thread_target(spark)(load), name) for name in names}
        return {name: load.result() for name, load in running.items()}


def load_star(warehouse: Warehouse, since: datetime | None = None) -> dict[str, int]:
    """Dimensions, then facts with their keys. Returns the row count of every table.

    New fact rows find their keys as they are added. Older rows that were added without keys are
    filled afterwards; where there are none, the check skips all files without null keys and rewrites nothing.
    """

    def load_fact(name: str) -> int:
        count = warehouse.load_fact(name, with_keys=True, since=since)
        warehouse.fill_fact_keys(name)
        return count

    counts = _together(warehouse.spark, lambda name: warehouse.load_dimension(name, since), DIMENSIONS)
    return counts | _together(warehouse.spark, load_fact, FACTS)


def refresh_marts(warehouse: Warehouse, fold: bool = True) -> dict[str, int]:
    """Adds new loads to every stored report; returns how many loads were new to each."""
    return _together(warehouse.spark, lambda name: warehouse.refresh_mart(name, fold), MARTS)


def run_batch(
    spark: SparkSession, warehouse: Warehouse, source: str, raw_folder: str | None = None, since: datetime | None = None
) -> dict[str, int]:
    """Lands the newest delivery of a folder (or the given ``.jsonl`` file or folder), stages it and loads the star.

    Any failing step raises and ends the run. Every step can be repeated, so a new run finishes it.
    """
    path = source if source.endswith(".jsonl") else newest_file(spark, source)
    if raw_folder:
        land_raw_files(spark, path, raw_folder)
    staged = warehouse.load_staging(path)
    return staged | {"ride_events": warehouse.count("ride_events")} | load_star(warehouse, since)
