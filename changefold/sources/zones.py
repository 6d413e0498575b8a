"""Zone map of a Parquet history: smallest and largest event time of every file, kept so that a load opens those it needs.

A history that is not partitioned by day is otherwise read from its first file on, each time. The map is a
small Parquet table beside the store. New files, and files written anew under their old name, are looked
at once; only their event times are read for that. Files with rows that have no event time are
always opened, as such a row is an error wherever it stands.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

ZONE_SCHEMA = T.StructType(
    [
        T.StructField("file", T.StringType()),
        T.StructField("bytes", T.LongType()),
        T.StructField("changed_at", T.TimestampType()),
        T.StructField("low", T.TimestampType()),
        T.StructField("high", T.TimestampType()),
        T.StructField("timeless", T.LongType()),
    ]
)
_IDENTITY = ["file", "bytes", "changed_at"]


def _plain_path(path: str | Column) -> Column:
    """A path written one way: readers differ in the number of slashes after the scheme."""
    return F.regexp_replace(path, "^([A-Za-z][A-Za-z0-9+.-]*):/+", "$1:/")


class ZonedHistory:
    """A Parquet history below ``path`` with its map in ``zones``; give it to a load as its history."""

    def __init__(self, spark: SparkSession, path: str, zones: str, event_time: str) -> None:
        self.spark, self.path, self.zones, self.event_time = spark, path, zones, event_time

    def files(self) -> DataFrame:
        """The history's files as they are now."""
        listed = self.spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(self.path)
        return listed.select(_plain_path("path").alias("file"), F.col("length").alias("bytes"), F.col("modificationTime").alias("changed_at"))

    def known(self) -> DataFrame:
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path(self.zones)
        if not hadoop.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(hadoop):
            return self.spark.createDataFrame([], ZONE_SCHEMA)
        return self.spark.read.schema(ZONE_SCHEMA).parquet(self.zones)

    def refresh(self) -> int:
        """Look at the files that the map does not know; gives their number."""
        new = [row["file"] for row in self.files().join(self.known(), _IDENTITY, "left_anti").select("file").collect()]
        if new:
            time = F.col(self.event_time)
            rows = self.spark.read.parquet(*new)
            about = [
                # Written like a URL; a plus sign is one.
                _plain_path(F.url_decode(F.replace("_metadata.file_path", F.lit("+"), F.lit("%2B")))).alias("file"),
                F.col("_metadata.file_size").alias("bytes"),
                F.col("_metadata.file_modification_time").alias("changed_at"),
            ]
            seen = rows.select(*about, time.cast("timestamp").alias("at")).groupBy(*_IDENTITY).agg(
                F.min("at").alias("low"), F.max("at").alias("high"), F.count_if(F.col("at").isNull()).alias("timeless")
            )
            seen.coalesce(1).write.mode("append").parquet(self.zones)
        return len(new)

    def since(self, start: datetime) -> DataFrame:
        """The rows of all files that may hold rows at or after ``start``. Other rows of those files come too."""
        self.refresh()
        # A file that the map does not tell about is opened: it has no rows, or was written just now.
        wanted = (F.col("high") >= F.lit(start)) | (F.col("timeless") > 0) | F.col("timeless").isNull()
        found = self.files().join(self.known(), _IDENTITY, "left").where(wanted)
        names = sorted({row["file"] for row in found.select("file").collect()})
        whole = self.spark.read.parquet(self.path)
        if not names:
            return whole.limit(0)
        return self.spark.read.schema(whole.schema).parquet(*names)

    def __call__(self) -> DataFrame:
        return self.spark.read.parquet(self.path)
