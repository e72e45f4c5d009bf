"""Warehouse tables in the session catalog and the loads that fill them."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterator
from contextlib import closing, contextmanager
from datetime import datetime

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.dims import DIMENSIONS
from ..operators.facts import FACTS, NUMBERED
from ..operators.keys import buckets_of, fill_keys, found_keys, unfilled
from ..operators.marts import MARTS, add_up
from ..operators.staging import FILE_ORDER, ZONE_ORDER, stage_events, staging_rows_from_clean, staging_rows_from_files
from ..operators.strict import StrictLoadError, broken_constraints, raise_if_violated, violation_counts
from ..schemas import MART_TABLES, PROMOTED_BATCHES, STAGING_FIELDS, TABLES, UNIQUE_COLUMN
from ..session import hadoop_path, shared_folder, write_aside
from ..sources.files import bad_lines, read_event_files
from ..streaming.lake import PARTITIONS, Lake

# Large tables are bucketed on their conflict column. Loads then find existing keys without moving
# the table, and the staging-to-fact load moves neither side.
BUCKETED = ["ride_events", "fct_ride_events", "fct_trips", "fct_payments"]
QUARANTINE = "quarantined_events"
PROMOTED = "promoted_batches"
#: Batches that are read folder by folder; of more, the whole zone is listed and joined with them.
LISTED_BATCHES = 10_000
_LOAD_TIME = {name: "loaded_at" if name == "fct_ride_events" else "created_at" for name in TABLES}


def bucket_of_file(name: Column) -> Column:
    """Files of a bucketed table end in the number of their bucket."""
    return F.regexp_extract(name, r"_(\d+)(?:\..*)?$", 1).try_cast("int")


class Warehouse:
    """Staging, facts and dimensions as Parquet tables of one catalog database.

    ``location`` must be shared storage. ``buckets`` is fixed when the tables are created and read back from the catalog ever
    after: choose it so that one bucket of the key column of the largest table fits one task (thousands at 100 TB; without it
    new tables get one bucket per core of the creating session). With ``spark.sql.shuffle.partitions`` at the same number a
    staging load shuffles its rows just once. Loads only append, and append only rows whose key is absent, so a load that was
    cut short is completed by running it again. A table has one writer at a time: see ``writing``.
    """

    def __init__(self, spark: SparkSession, database: str, location: str, buckets: int | None = None):
        self.spark = spark
        self.database = database
        self.location = location.rstrip("/")
        self._asked = buckets
        self._known: dict[str, int] = {}

    # -- tables ------------------------------------------------------------------------------------

    def create(self) -> Warehouse:
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.database}")
        for name in TABLES:
            number = self._asked or self.spark.sparkContext.defaultParallelism
            self._create_table(name, name, self._new_location(name), number)
        for name in BUCKETED:
            self.buckets(name)
        quarantine = "constraint_names string, " + ", ".join(f"{f} string" for f in STAGING_FIELDS)
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.database}.{QUARANTINE} ({quarantine}, topic string, partition int, offset bigint, "
            f"created_at timestamp_ntz) USING parquet LOCATION '{self._new_location(QUARANTINE)}'"
        )
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.database}.{PROMOTED} ({PROMOTED_BATCHES}) "
            f"USING parquet LOCATION '{self._new_location(PROMOTED)}'"
        )
        for name in MARTS:
            self._create_table(name, name, self._new_location(name), 1)
        return self

    def buckets(self, name: str) -> int:
        """The table's own bucket count. Files laid out for another one would be hidden from bucketed scans."""
        if name not in self._known:
            details = self.spark.sql(f"DESCRIBE FORMATTED {self.database}.{name}")
            found = int(details.filter("col_name = 'Num Buckets'").first()["data_type"])
            if self._asked and found != self._asked:
                raise ValueError(f"{self.database}.{name} has {found} buckets, not {self._asked}")
            self._known[name] = found
        return self._known[name]

    @contextmanager
    def writing(self, name: str) -> Iterator[None]:
        """Holds the table's lock: a file below ``location`` that exactly one session can create.

        Two loads at once would both find a key absent and both add it. A session that died leaves its lock; ``unlock`` removes it.
        """
        path, store = self._lock(name)
        try:
            store.create(path, False).close()
        except Exception as error:
            if not store.exists(path):
                raise
            raise RuntimeError(f"{self.database}.{name} is being written; if its writer died, unlock('{name}')") from error
        try:
            self._finish_switch(name)
            yield
        finally:
            store.delete(path, False)

    def unlock(self, name: str) -> None:
        path, store = self._lock(name)
        store.delete(path, False)

    def _lock(self, name: str) -> tuple:
        return hadoop_path(self.spark, f"{self.location}/_locks/{self.database}.{name}")

    def _new_location(self, name: str) -> str:
        return f"{self.location}/{name}/{uuid.uuid4().hex}"

    def _create_table(self, name: str, model: str, location: str, buckets: int) -> None:
        layout = f"CLUSTERED BY ({UNIQUE_COLUMN[model]}) INTO {buckets} BUCKETS" if model in BUCKETED else ""
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.database}.{name} ({(TABLES | MART_TABLES)[model]}) "
            f"USING parquet {layout} LOCATION '{location}'"
        )

    def table(self, name: str) -> DataFrame:
        return self.spark.table(f"{self.database}.{name}")

    def _existing(self, name: str) -> DataFrame | None:
        """The table, or None while it has no row: a first load then compares its rows with nothing."""
        table = self.table(name)
        return None if table.isEmpty() else table

    def count(self, name: str) -> int:
        return self.table(name).count()

    def _laid_out(self, name: str, rows: DataFrame) -> DataFrame:
        # One task per bucket, so a load adds one file to each bucket and not one per task and bucket.
        return rows.repartition(self.buckets(name), UNIQUE_COLUMN[name]) if name in BUCKETED else rows

    def append(self, name: str, rows: DataFrame, laid_out: bool = False) -> int:
        """Adds rows, stamped with the load time, and returns how many. They are counted in the writing
        tasks, after the last shuffle, so a repeated shuffle task does not count twice."""
        added = Observation()
        rows = rows.withColumn(_LOAD_TIME[name], F.localtimestamp()).select(*self.table(name).columns)
        rows = rows if laid_out else self._laid_out(name, rows)
        rows.observe(added, F.count(F.lit(1)).alias("rows")).write.insertInto(f"{self.database}.{name}")
        return added.get["rows"]

    def replace(self, name: str, rows: DataFrame) -> None:
        """Swaps the contents of a table, which ``rows`` may be computed from.

        The new contents are complete in their own folder before one catalog change points the table
        at them; readers see the old contents or the new ones.
        """
        location = self._write_apart(name, self._laid_out(name, rows.select(*self.table(name).columns)))
        self.spark.sql(f"ALTER TABLE {self.database}.{name} SET LOCATION '{location}'")
        self.spark.catalog.refreshTable(f"{self.database}.{name}")

    def _write_apart(self, name: str, rows: DataFrame) -> str:
        """Writes rows in the table's layout to a folder of their own."""
        location, pending = self._new_location(name), f"{name}_{uuid.uuid4().hex}"
        self._create_table(pending, name, location, self.buckets(name) if name in BUCKETED else 1)
        rows.write.insertInto(f"{self.database}.{pending}")
        self.spark.sql(f"DROP TABLE {self.database}.{pending}")  # external: the files stay
        return location

    def _folder(self, name: str) -> str:
        details = self.spark.sql(f"DESCRIBE FORMATTED {self.database}.{name}")
        return details.filter("col_name = 'Location'").first()["data_type"].rstrip("/")

    def files(self, name: str) -> DataFrame:
        """(file_name, bucket): the table's files, by their listing; the bucket is null where the table has none."""
        listed = self.spark.read.format("binaryFile").load(self._folder(name)).select(F.element_at(F.split("path", "/"), -1).alias("file_name"))
        return listed.select("file_name", bucket_of_file(F.col("file_name")).alias("bucket"))

    def replace_buckets(self, name: str, buckets: list[int], rows: DataFrame) -> None:
        """Swaps the files of these buckets for ``rows``, which may be computed from them and must be dealt out by bucket; no other file is touched.

        The new files are complete in a folder of their own, and a note of what comes and goes is written, before the first file is moved. A
        writer that dies then leaves the note, and the next one finishes what it says. Readers hold the lock only if they ask for it:
        one that lists the folder during the switch can miss a bucket, and one that began before it fails on a file that went.
        """
        apart, folder = self._write_apart(name, rows.select(*self.table(name).columns)), self._folder(name)
        path, store = hadoop_path(self.spark, apart)
        wanted = set(buckets)
        old = [row["file_name"] for row in self.files(name).collect() if row["bucket"] in wanted]
        new = [status.getPath().getName() for status in store.listStatus(path) if status.getPath().getName().startswith("part-")]
        note, store = self._switch_note(name)
        written, _ = hadoop_path(self.spark, f"{note.toString()}.{uuid.uuid4().hex}")
        with closing(store.create(written, False)) as out:
            out.write(json.dumps({"from": apart, "to": folder, "old": old, "new": new}).encode())
        store.rename(written, note)
        self._finish_switch(name)

    def _switch_note(self, name: str) -> tuple:
        return hadoop_path(self.spark, f"{self.location}/_switches/{self.database}.{name}")

    def _finish_switch(self, name: str) -> None:
        note, store = self._switch_note(name)
        if not store.exists(note):
            return
        with closing(store.open(note)) as stream:
            switch = json.loads(bytes(stream.readAllBytes()))
        for file in switch["old"]:
            store.delete(hadoop_path(self.spark, f"{switch['to']}/{file}")[0], False)
        for file in switch["new"]:
            source, _ = hadoop_path(self.spark, f"{switch['from']}/{file}")
            if store.exists(source):  # else moved already
                store.rename(source, hadoop_path(self.spark, f"{switch['to']}/{file}")[0])
        store.delete(note, False)
        self.spark.catalog.refreshTable(f"{self.database}.{name}")

    def clean(self, older_than_hours: float = 24.0) -> int:
        """Removes folders of replaced table contents that nothing points to. The age protects readers that still use them."""
        removed, now = 0, time.time()
        for name in TABLES | MART_TABLES:
            note, store = self._switch_note(name)
            if store.exists(note):  # the next writer still needs a folder
                continue
            current = self._folder(name).rsplit("/", 1)[1]
            path, store = hadoop_path(self.spark, f"{self.location}/{name}")
            for status in store.listStatus(path) if store.exists(path) else ():
                old = now - status.getModificationTime() / 1000 > older_than_hours * 3600
                if status.getPath().getName() != current and old:
                    store.delete(status.getPath(), True)
                    removed += 1
        return removed

    @contextmanager
    def _scratch_table(self) -> Iterator[str]:
        """A table in the shared checkpoint folder that is dropped with its files afterwards."""
        name = f"tripflow_scratch_{uuid.uuid4().hex}"
        self.spark.sql(f"CREATE DATABASE {name} LOCATION '{shared_folder(self.spark)}/{name}'")
        try:
            yield f"{name}.rows"
        finally:
            self.spark.sql(f"DROP DATABASE {name} CASCADE")

    # -- staging -----------------------------------------------------------------------------------

    def _load_staging(self, rows: DataFrame, order: list[str]) -> dict[str, int]:
        """Parses once: constraints and row count are observed while the typed rows are written aside,
        and nothing reaches the table unless every constraint holds."""
        checked = Observation()
        with self.writing("ride_events"), self._scratch_table() as scratch:
            observed = rows.observe(checked, F.count(F.lit(1)).alias("attempted"), *violation_counts(rows))
            observed.write.format("parquet").saveAsTable(scratch)
            counts = dict(checked.get)
            attempted = counts.pop("attempted")
            raise_if_violated(counts)
            new_rows = stage_events(self._existing("ride_events"), self.spark.table(scratch), order)
            inserted = self.append("ride_events", new_rows)
        return {"attempted": attempted, "inserted": inserted}

    def load_staging(self, path: str | list[str]) -> dict[str, int]:
        """Event files to staging: all of them or none. A refused load names the first lines that are no whole event."""
        try:
            return self._load_staging(staging_rows_from_files(read_event_files(self.spark, path)), FILE_ORDER)
        except StrictLoadError as error:
            raise StrictLoadError(error.violations, bad_lines(self.spark, path)) from error
        except (PySparkException, Py4JJavaError) as error:  # a malformed record is raised by a task
            if found := bad_lines(self.spark, path):
                raise StrictLoadError({"malformed_line": len(found)}, found) from error
            raise

    def stage_from_clean(self, clean: DataFrame) -> dict[str, int]:
        """Validated events of the clean zone to staging. Pass the ingestion dates that are new; events that were staged before
        are left as they are.

        The validation rules are wider than the table: an event may pass them and break a constraint. Such rows go to the
        quarantine table with the names of the constraints, once for each place in the topic, and the others are loaded.
        """
        rows = staging_rows_from_clean(clean)
        checked = Observation()
        with self.writing("ride_events"), self._scratch_table() as scratch:
            named = rows.withColumn("constraint_names", broken_constraints(rows))
            named = named.observe(checked, F.count(F.lit(1)).alias("attempted"), F.count_if(F.col("constraint_names") != "").alias("bad"))
            named.write.format("parquet").saveAsTable(scratch)
            counts = dict(checked.get)
            stored = self.spark.table(scratch)
            good = stored.filter("constraint_names = ''")
            inserted = self.append("ride_events", stage_events(self._existing("ride_events"), good, ZONE_ORDER))
            quarantined = self._quarantine(stored.filter("constraint_names <> ''")) if counts["bad"] else 0
        return {"attempted": counts["attempted"], "inserted": inserted, "quarantined": quarantined}

    def promote(self, lake: Lake) -> dict[str, int]:
        """Batches of the clean zone that were not promoted before, to staging. Only their folders are read.

        What was promoted is noted after staging has it, so a promotion that was cut short is repeated whole, and adds only what is absent. A
        batch that was written again by a replay holds the same records.
        """
        with self.writing(PROMOTED):
            known = self.table(PROMOTED).select(*PARTITIONS)
            fresh = write_aside(lake.clean_batches(self.spark).join(known, PARTITIONS, "left_anti"), "batches")
            seen = fresh.agg(F.count("*").alias("batches"), F.coalesce(F.sum("files"), F.lit(0)).alias("files")).first().asDict()
            if not seen["batches"]:
                return seen | {"attempted": 0, "inserted": 0, "quarantined": 0}
            few = seen["batches"] <= LISTED_BATCHES
            counts = self.stage_from_clean(lake.read_clean(self.spark, fresh.collect() if few else fresh))
            noted = fresh.withColumn("created_at", F.localtimestamp()).select(*self.table(PROMOTED).columns)
            noted.write.insertInto(f"{self.database}.{PROMOTED}")
        return seen | counts

    def _quarantine(self, rows: DataFrame) -> int:
        known = self.table(QUARANTINE).select(*ZONE_ORDER)
        fields = [F.col("fare_text" if f == "fare_usd" else f).cast("string").alias(f) for f in STAGING_FIELDS]
        fresh = rows.select("constraint_names", *fields, *ZONE_ORDER).dropDuplicates(ZONE_ORDER).join(known, ZONE_ORDER, "left_anti")
        fresh = fresh.withColumn("created_at", F.localtimestamp()).select(*self.table(QUARANTINE).columns)
        added = Observation()
        fresh.observe(added, F.count(F.lit(1)).alias("rows")).write.insertInto(f"{self.database}.{QUARANTINE}")
        return added.get["rows"]

    # -- dimensions and facts ----------------------------------------------------------------------

    def _staged(self, since: datetime | None) -> DataFrame:
        """Staging, or what was staged at or after ``since``; file statistics skip the loads before it."""
        staged = self.table("ride_events")
        return staged if since is None else staged.filter(F.col("created_at") >= F.lit(since).cast("timestamp_ntz"))

    def load_dimension(self, name: str, since: datetime | None = None) -> int:
        """Adds values that staging has and the dimension lacks; returns the dimension's row count.

        Loads read all of staging unless ``since`` is given. It is right when every load of earlier rows
        is known to be complete, and spares a daily load from reading years of history.
        """
        with self.writing(name):
            self.append(name, DIMENSIONS[name](self._staged(since), self._existing(name)))
        return self.count(name)

    def dimensions(self) -> dict[str, DataFrame]:
        return {name: self.table(name) for name in DIMENSIONS}

    def load_fact(self, name: str, with_keys: bool = False, since: datetime | None = None) -> int:
        """Adds staged rows the fact lacks; returns the fact's row count.

        ``with_keys`` looks the keys up on the way in. With the dimensions loaded first, this leaves the
        fact as a load followed by ``fill_fact_keys`` would, without rewriting what is already there.
        """
        build, lookups = FACTS[name]
        with self.writing(name):
            existing = self._existing(name)
            rows = build(self._staged(since), existing)
            if with_keys:
                # Dealt out by bucket first: the keys come to the rows, and the append needs no other shuffle of them. Where all of staging
                # is new and gets no key of its own, its buckets are the fact's, and nothing is gained by writing them aside.
                if existing is not None or name in NUMBERED or self.buckets("ride_events") != self.buckets(name):
                    rows = self._laid_out(name, write_aside(rows, "new-rows"))
                rows = fill_keys(rows, lookups(), self.dimensions(), UNIQUE_COLUMN[name])
            self.append(name, rows, laid_out=with_keys)
        return self.count(name)

    def fill_fact_keys(self, name: str) -> int:
        """Fills keys of rows that were loaded before their dimension value existed; returns how many buckets got new files.

        Open keys are found by the files' statistics, matched by row ids and names alone, and only buckets with a match are read and
        written whole. A name that no dimension has is no reason to write anything.
        """
        _, lookups = FACTS[name]
        row_id = UNIQUE_COLUMN[name]
        with self.writing(name):
            fact = self.table(name)
            found = found_keys(unfilled(fact, lookups()), lookups(), self.dimensions(), row_id)
            buckets = buckets_of(found, row_id, self.buckets(name))
            if buckets:
                some = fact.filter(bucket_of_file(F.col("_metadata.file_name")).isin(buckets))
                self.replace_buckets(name, buckets, fill_keys(some, lookups(), self.dimensions(), row_id))
        return len(buckets)

    # -- marts -------------------------------------------------------------------------------------

    def mart(self, name: str) -> DataFrame:
        """The report as stored, whatever parts it is stored in."""
        return add_up(MARTS[name], self.table(name).filter("included_load IS NULL").drop("included_load"))

    def refresh_mart(self, name: str, fold: bool = True) -> int:
        """Adds the fact's new loads to a stored report; returns how many loads were new. Rows of other loads are not read again.

        The loads that a report includes are stored with it, so both change in one step: a refresh that was cut short has changed nothing.
        ``fold`` stores the sums, one row for each key, in place of what was there; without it the new loads' sums are added
        as a part, for reports that are large beside a load.
        """
        mart = MARTS[name]
        load_time = _LOAD_TIME[mart.fact]
        with self.writing(name):
            stored, fact = self.table(name), self.table(mart.fact)
            included = stored.filter("included_load IS NOT NULL").select("included_load")
            loads = fact.select(F.col(load_time).alias("included_load")).distinct().join(included, "included_load", "left_anti")
            loads = [row["included_load"] for row in loads.collect()]  # as many as there were loads since
            if not loads:
                return 0
            # Each load's files have one load time, so their statistics tell which to read.
            times = [F.lit(str(time_)).cast("timestamp_ntz") for time_ in loads]
            sums = mart.report(fact.filter(F.col(load_time).isin(times)))
            marks = self.spark.createDataFrame([(str(time_),) for time_ in loads], "included_load string")
            marks = marks.select(F.col("included_load").cast("timestamp_ntz"))
            if fold:
                sums = add_up(mart, self.mart(name).unionByName(sums))
                marks = marks.union(included)
            rows = sums.unionByName(marks, allowMissingColumns=True).select(*stored.columns)
            if fold:
                self.replace(name, rows)
            else:
                rows.write.insertInto(f"{self.database}.{name}")
        return len(loads)
