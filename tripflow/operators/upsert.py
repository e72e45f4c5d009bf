"""Insert-if-absent: existing rows never change, the first of several new rows wins."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The earliest row of every ``key`` by ``order``; the order columns are dropped.

    Row values break ties in ``order``, which keeps the choice the same on every run. The rank is limited to 1 before the shuffle,
    so each input partition sends one row per key, and a key that repeats in a third of all rows costs one row per task.
    """
    carried = [name for name in rows.columns if name != key and name not in order]
    rank = F.row_number().over(Window.partitionBy(key).orderBy(*order, *carried))
    kept = [name for name in rows.columns if name not in order]
    return rows.withColumn("__rank", rank).filter("__rank = 1").select(*kept)


def absent_from(rows: DataFrame, target: DataFrame | None, key: str) -> DataFrame:
    """Rows whose key the target lacks. Only the key column of the target is read.

    Where the target is bucketed on the key, its side of this join is not shuffled. It is never broadcast: keys that take few bytes in
    files would still be collected as rows by the driver, and their number grows with the table.
    """
    if target is None:
        return rows
    return rows.join(target.select(key).hint("merge"), key, "left_anti")


def insert_if_absent(target: DataFrame | None, incoming: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Rows to append to ``target``. ``key`` must not be null and ``order`` must name the delivery order."""
    return absent_from(first_per_key(incoming, key, order), target, key)
