"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

#: Settings every load relies on (UTC) or profits from (the rest), all settable at run time.
SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A stored target is always read bucket by bucket, so that rewriting it needs no exchange.
    "spark.sql.sources.bucketing.autoBucketedScan.enabled": "false",
    # A task that writes one bucket needs no sort by bucket first.
    "spark.sql.maxConcurrentOutputFileWriters": "4",
    # The JVM never compiles a longer method, and the contract of a wide table makes long ones.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Lets a join with a stored bucket skip sorting it when the change side is small per bucket.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
}


def build_session(app_name: str = "changefold", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for name, value in {**SQL_SETTINGS, **extra}.items():
        builder = builder.config(name, value)
    return configure(builder.getOrCreate())


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings to a session somebody else built."""
    for name, value in SQL_SETTINGS.items():
        spark.conf.set(name, value)
    return spark


#: Temporary folder of each local application that names no shared one.
_local_folders: dict[str, str] = {}


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder below ``spark.checkpoint.dir``, the storage all executors share.

    Only a local session may go without that setting; it gets a temporary folder of its own, and the
    setting stays as it is.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        application = spark.sparkContext.applicationId
        if application not in _local_folders:
            _local_folders[application] = tempfile.mkdtemp(prefix="changefold-")
        shared = _local_folders[application]
    return f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def one_row(spark: SparkSession, schema: T.StructType, values: dict) -> DataFrame:
    """One row of literals, which Spark evaluates while planning."""
    literals = [F.lit(values[field.name]).cast(field.dataType).alias(field.name) for field in schema]
    return spark.sql("SELECT 1").select(*literals)
