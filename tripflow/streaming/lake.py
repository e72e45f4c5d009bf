"""Lake zones on storage: replay-safe writes and schema-checked reads."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from contextlib import closing
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.zones import clean_zone, raw_zone, rejected_zone
from ..schemas import CLEAN_ZONE_SCHEMA, RAW_ZONE_SCHEMA, REJECTED_ZONE_SCHEMA
from ..session import hadoop_path

# Each batch owns its own partitions, so a replayed batch replaces what its first attempt left.
PARTITIONS = ["ingestion_date", "run_id", "batch_id"]
_ZONES = {"raw": ("json", RAW_ZONE_SCHEMA), "clean": ("parquet", CLEAN_ZONE_SCHEMA), "rejected": ("json", REJECTED_ZONE_SCHEMA)}
_PACKED = "packed-"
_BATCH_DDL = "ingestion_date date, run_id string, batch_id bigint"

# The JSON writer keeps milliseconds by default; zones keep all that Spark has.
_JSON_OPTIONS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


@dataclass(frozen=True)
class Lake:
    """``raw``, ``clean`` and ``rejected`` folders below one root, on any file system Spark can reach.

    ``rows_per_task`` keeps short triggers from leaving one small file per source partition while a large batch is still written by
    all cores; ``rows_per_file`` bounds the files of a source partition that holds most of a batch.
    """

    root: str
    rows_per_file: int = 500_000
    rows_per_task: int = 50_000

    def path(self, zone: str) -> str:
        return f"{self.root.rstrip('/')}/{zone}/ride_events"

    def _write(self, rows: DataFrame, zone: str, run_id: str, batch_id: int, count: int | None) -> None:
        tasks = cores = rows.sparkSession.sparkContext.defaultParallelism
        if count is not None:
            tasks = max(1, -(-count // self.rows_per_file), min(cores, -(-count // self.rows_per_task)))
        writer = (
            rows.coalesce(tasks)
            .withColumns({"run_id": F.lit(run_id), "batch_id": F.lit(batch_id).cast("bigint")})
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .option("maxRecordsPerFile", self.rows_per_file)
            .partitionBy(*PARTITIONS)
        )
        fmt, _ = _ZONES[zone]
        if fmt == "json":
            writer = writer.options(**_JSON_OPTIONS)
        writer.format(fmt).save(self.path(zone))

    # ``count`` is the number of records the zone receives; where it is not known, all cores write.

    def write_raw(self, validated: DataFrame, run_id: str, batch_id: int, count: int | None = None) -> None:
        self._write(raw_zone(validated), "raw", run_id, batch_id, count)

    def write_clean(self, validated: DataFrame, run_id: str, batch_id: int, count: int) -> None:
        self._write(clean_zone(validated), "clean", run_id, batch_id, count)

    def write_rejected(self, validated: DataFrame, run_id: str, batch_id: int, count: int) -> None:
        self._write(rejected_zone(validated), "rejected", run_id, batch_id, count)

    def _stored(self, spark: SparkSession, zone: str, batches: Iterable[Row] | None = None) -> DataFrame:
        """The zone's rows with the columns of their batch. Of a packed batch, those of the packed files."""
        fmt, schema = _ZONES[zone]
        # JSON leaves nulls out, so the schema is given and never inferred from what happens to be there.
        stored = T.StructType(
            schema.fields + [T.StructField("run_id", T.StringType()), T.StructField("batch_id", T.LongType())]
        )
        reader = spark.read.schema(stored)
        if fmt == "json":
            reader = reader.options(**_JSON_OPTIONS)
        if batches is None:
            found = reader.format(fmt).load(self.path(zone))
        else:
            folders = ["/".join([self.path(zone), *(f"{name}={row[name]}" for name in PARTITIONS)]) for row in batches]
            found = reader.option("basePath", self.path(zone)).format(fmt).load(folders)
        return self._shown(found, self._packs(spark, zone))

    @staticmethod
    def _shown(found: DataFrame, packs: dict[str, list]) -> DataFrame:
        """Only partition columns decide, so that hidden folders are not read."""
        if packs["replaced"]:
            found = found.filter(~F.concat_ws("/", *PARTITIONS).isin(packs["replaced"]))
        if packs["version"]:  # files of a packing that has not come to its end belong to no listed run
            shown = F.col("run_id").isin(packs["runs"]) if packs["runs"] else F.lit(False)
            found = found.filter(~F.col("run_id").startswith(_PACKED) | shown)
        return found

    def _read(self, spark: SparkSession, zone: str, batches: Iterable[Row] | DataFrame | None = None) -> DataFrame:
        joined = isinstance(batches, DataFrame)
        found = self._stored(spark, zone, None if joined else batches)
        found = found.join(batches.select(*PARTITIONS), PARTITIONS, "left_semi") if joined else found
        return found.select(*_ZONES[zone][1].fieldNames())

    def batches(self, spark: SparkSession, zone: str) -> DataFrame:
        """(ingestion_date, run_id, batch_id, files, bytes) of a zone, from its listing alone."""
        folder, store = hadoop_path(spark, self.path(zone))
        if not store.exists(folder):  # no batch has had a record for it yet
            return spark.createDataFrame([], f"{_BATCH_DDL}, files bigint, bytes bigint")
        listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(self.path(zone))
        part = lambda name: F.regexp_extract("path", f"/{name}=([^/]*)/", 1)
        batch = [part("ingestion_date").cast("date"), part("run_id"), part("batch_id").cast("bigint")]
        named = [column.alias(name) for name, column in zip(PARTITIONS, batch, strict=True)]
        sizes = listed.groupBy(*named).agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))
        return self._shown(sizes, self._packs(spark, zone))

    # -- packing -----------------------------------------------------------------------------------

    def _packs(self, spark: SparkSession, zone: str) -> dict[str, list]:
        """What has been packed, by the newest version of the note: runs of packed files, and the batches they stand for that are still there."""
        folder, store = hadoop_path(spark, f"{self.root.rstrip('/')}/{zone}/_packs")
        names = [status.getPath() for status in store.listStatus(folder)] if store.exists(folder) else []
        names = [path for path in names if path.getName().endswith(".json")]
        if not names:
            return {"version": 0, "runs": [], "replaced": []}
        newest = max(names, key=lambda path: path.getName())
        with closing(store.open(newest)) as stream:
            return json.loads(bytes(stream.readAllBytes()))

    def _note_packs(self, spark: SparkSession, zone: str, packs: dict[str, list]) -> None:
        """Writes the next version. Of two packings at once, the second to end fails here, and its files are not shown."""
        packs = packs | {"version": packs["version"] + 1}
        name = f"{self.root.rstrip('/')}/{zone}/_packs/{packs['version']:09d}.json"
        written, store = hadoop_path(spark, f"{name}.{uuid.uuid4().hex}")
        with closing(store.create(written, False)) as out:
            out.write(json.dumps(packs).encode())
        final, _ = hadoop_path(spark, name)
        if store.exists(final) or not store.rename(written, final):
            raise RuntimeError(f"{zone} was packed by another session meanwhile")

    def pack(self, spark: SparkSession, zone: str, day: str, file_bytes: int = 256 << 20) -> int:
        """Packs a closed day's batches into files of about ``file_bytes``; returns how many batches were packed.

        Readers of the lake see the batches until one note, the last thing to be written, shows the packed files in their place. Batches that
        come later are shown beside them. ``remove_replaced`` deletes the old files when no reader uses them any more. The next
        promotion reads a packed day once more, and finds nothing absent.
        """
        of_day = F.col("ingestion_date") == F.lit(day).cast("date")
        old = self.batches(spark, zone).filter(of_day).collect()
        if sum(row["files"] for row in old) < 2:
            return 0
        run_id = f"{_PACKED}{uuid.uuid4().hex}"
        packs = self._packs(spark, zone)
        if not packs["version"]:  # from now on readers leave out packed files that no note lists
            self._note_packs(spark, zone, packs)
            packs = self._packs(spark, zone)
        fmt, _ = _ZONES[zone]
        rows = self._stored(spark, zone, old).drop(*PARTITIONS)
        # Dealt out by place and written to the one folder they belong to: a round robin would sort what a task reads, and
        # partitionBy what it writes, and a packed file holds as many rows as compress to its size.
        rows = rows.repartition(max(1, -(-sum(row["bytes"] for row in old) // file_bytes)), "topic", "partition", "offset")
        writer = rows.write.mode("overwrite")
        folder = "/".join([self.path(zone), f"ingestion_date={day}", f"run_id={run_id}", "batch_id=0"])
        (writer.options(**_JSON_OPTIONS) if fmt == "json" else writer).format(fmt).save(folder)
        replaced = ["/".join(str(row[name]) for name in PARTITIONS) for row in old]
        self._note_packs(spark, zone, packs | {
            "runs": [*packs["runs"], run_id], "replaced": [*packs["replaced"], *replaced],
        })
        return len(old)

    def remove_replaced(self, spark: SparkSession, zone: str) -> int:
        """Deletes the folders of packed batches; returns how many. Call it when readers that began before the packing have ended."""
        packs = self._packs(spark, zone)
        for batch in packs["replaced"]:
            parts = "/".join(f"{name}={value}" for name, value in zip(PARTITIONS, batch.split("/"), strict=True))
            folder, store = hadoop_path(spark, f"{self.path(zone)}/{parts}")
            store.delete(folder, True)
        if packs["replaced"]:
            self._note_packs(spark, zone, packs | {"replaced": []})
        return len(packs["replaced"])

    # -- readers -----------------------------------------------------------------------------------

    def clean_batches(self, spark: SparkSession) -> DataFrame:
        return self.batches(spark, "clean").drop("bytes")

    def read_raw(self, spark: SparkSession) -> DataFrame:
        return self._read(spark, "raw")

    def read_clean(self, spark: SparkSession, batches: Iterable[Row] | DataFrame | None = None) -> DataFrame:
        """The zone, or these batches of it: rows by which only their folders are listed and read, or a table that is joined."""
        return self._read(spark, "clean", batches)

    def read_rejected(self, spark: SparkSession) -> DataFrame:
        return self._read(spark, "rejected")
