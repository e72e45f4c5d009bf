"""Session construction, object-store settings and the shared checkpoint folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession

# Adaptive execution sizes shuffles from their real bytes and splits the partitions of hot keys.
ENGINE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # The JVM never compiles methods above 8000 bytes of bytecode. Generated code beyond that is slower
    # than no generated code, so Spark is told to stop there.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def object_store_conf(
    endpoint: str, access_key: str, secret_key: str, path_style: bool = True, ssl: bool = False
) -> dict[str, str]:
    """Settings for ``s3a://`` paths on an S3-compatible store."""
    return {
        "spark.hadoop.fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
        "spark.hadoop.fs.s3a.aws.credentials.provider": "org.apache.hadoop.fs.s3a.SimpleAWSCredentialsProvider",
        "spark.hadoop.fs.s3a.endpoint": endpoint,
        "spark.hadoop.fs.s3a.access.key": access_key,
        "spark.hadoop.fs.s3a.secret.key": secret_key,
        "spark.hadoop.fs.s3a.path.style.access": str(path_style).lower(),
        "spark.hadoop.fs.s3a.connection.ssl.enabled": str(ssl).lower(),
    }


def build_session(
    app_name: str = "tripflow",
    master: str | None = None,
    conf: dict[str, str] | None = None,
    persistent_catalog: bool = False,
) -> SparkSession:
    """``persistent_catalog`` uses the cluster's metastore, so that later sessions find the warehouse tables."""
    builder = SparkSession.builder.appName(app_name)
    if persistent_catalog:
        builder = builder.enableHiveSupport()
    if master:
        builder = builder.master(master)
    for name, value in {**ENGINE_CONF, **(conf or {})}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


@cache
def _local_folder(application: str) -> str:
    folder = tempfile.mkdtemp(prefix="tripflow-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)  # a local session's own folder goes with it
    return folder


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``. Only a local session may fall back to its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return _local_folder(spark.sparkContext.applicationId)


def hadoop_path(spark: SparkSession, path: str) -> tuple:
    """A path and the file system that it is on, for what concerns whole files."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark._jsc.hadoopConfiguration())


def use_shared_checkpoints(spark: SparkSession) -> None:
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))


def shared_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def write_aside(rows: DataFrame, label: str) -> DataFrame:
    """Writes rows once as Parquet in the shared folder, for plans that read them several times."""
    path = shared_path(rows.sparkSession, label)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)
