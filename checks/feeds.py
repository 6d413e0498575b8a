"""Change feeds made from the given tables, whole tables throughout."""

from __future__ import annotations

from datetime import UTC, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from changefold.operators.fold import newest_per_key
from changefold.spec import PRODUCTS, VersionedTable

#: Orders before this day have been loaded already.
SEEDED_UNTIL = datetime(2000, 1, 1, tzinfo=UTC)
BEGINNING = datetime(1990, 1, 1, tzinfo=UTC)
OVERLAP = timedelta(days=30)

EVENTS = VersionedTable(("user_id",), ("ts", "event_id"), ("event_type", "value", "props"))
ORDERS = VersionedTable(
    ("o_custkey",), ("o_orderdate", "o_orderkey"), ("o_orderstatus", "o_totalprice", "o_orderpriority")
)
PARTS = VersionedTable(("l_partkey",), ("l_shipdate", "l_orderkey"), ("l_quantity", "l_extendedprice"))
LINES = VersionedTable(("l_orderkey", "l_linenumber"), ("l_shipdate",), ("l_partkey", "l_quantity"))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A given table with its naive times read as UTC instants, so that bounds reach the scan."""
    path = f"{sf_dir}/{table}.parquet"
    found = spark.read.parquet(path).schema
    zoned = [T.StructField(f.name, _instant_for(f.dataType)) for f in found]
    return spark.read.schema(T.StructType(zoned)).parquet(path)


def _instant_for(data_type: T.DataType) -> T.DataType:
    return T.TimestampType() if isinstance(data_type, T.TimestampNTZType) else data_type


def plain(rows: DataFrame) -> DataFrame:
    """Result in types that compare the same everywhere: UTC times without a zone, amounts as text."""
    compared = {T.TimestampType: "timestamp_ntz", T.DecimalType: "string"}
    return rows.select(
        *(F.col(f.name).cast(compared.get(type(f.dataType), f.dataType)).alias(f.name) for f in rows.schema)
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "events").select(*EVENTS.columns)


def events_with_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every error event is delivered twice."""
    once = events(spark, sf_dir)
    return once.unionByName(once.filter("event_type = 'error'"))


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "orders").select(*ORDERS.columns)


def seeded(rows: DataFrame, event_time: str = "o_orderdate") -> DataFrame:
    return rows.filter(F.col(event_time) < F.lit(SEEDED_UNTIL))


def seeded_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target as of the seed: newest order per customer before that day."""
    return newest_per_key(seeded(orders(spark, sf_dir)), ORDERS)


def order_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a typed product history: a customer is a product, an order one of its versions."""
    return read(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias("product_id"),
        F.col("o_orderdate").alias("updated_at"),
        F.col("o_orderkey").alias("source_sequence"),
        F.col("o_orderstatus").alias("name"),
        F.col("o_orderpriority").alias("category"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("price"),
        (F.col("o_orderstatus") != "F").alias("is_active"),
    )


def event_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a typed product history; ``category`` holds JSON text with quotes."""
    return read(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("product_id"),
        F.col("ts").alias("updated_at"),
        F.col("event_id").alias("source_sequence"),
        F.col("event_type").alias("name"),
        F.col("props").alias("category"),
        F.abs("value").cast("decimal(18,2)").alias("price"),
        (F.col("event_type") != "error").alias("is_active"),
    )


def event_product_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return newest_per_key(event_products(spark, sf_dir), PRODUCTS)


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as text cells, some of them made to break a rule; key 0 breaks all of them."""
    key = F.col("o_orderkey")

    def broken(every: int, bad: str, good):
        return F.when(key % every == 0, F.lit(bad)).otherwise(good)

    time = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")
    price = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    return read(spark, sf_dir, "orders").select(
        "o_orderkey",
        broken(101, " \t", key.cast("string")).alias("product_id"),
        F.when(key % 103 == 0, time).otherwise(F.concat(time, F.lit("Z"))).alias("updated_at"),
        broken(107, "-1", F.col("o_custkey").cast("string")).alias("source_sequence"),
        F.concat(F.lit('say "'), F.col("o_orderstatus"), F.lit('",\nthen go')).alias("name"),
        F.concat(F.lit("  "), F.col("o_orderpriority"), F.lit(" ")).alias("category"),
        broken(109, "0.001", price).alias("price"),
        broken(113, "yes", F.when(F.col("o_orderstatus") == "F", "FALSE").otherwise("true")).alias("is_active"),
    )


def customer_state(spark: SparkSession, sf_dir: str, rows: DataFrame | None = None, run: str = "seed") -> DataFrame:
    """Progress state with one pipeline per customer."""
    rows = seeded(orders(spark, sf_dir)) if rows is None else rows
    return rows.groupBy(F.concat(F.lit("customer-"), F.col("o_custkey")).alias("pipeline_name")).agg(
        F.max("o_orderdate").alias("watermark"),
        F.lit(run).alias("last_successful_run_id"),
        F.max("o_orderdate").alias("updated_at"),
    )


def customer_pipelines(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.concat(F.lit("customer-"), F.col("c_custkey")).alias("pipeline_name")
    return read(spark, sf_dir, "customer").select(name)


def order_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as run records, good and bad ones."""
    size = F.floor("o_totalprice").cast("bigint")
    status = F.col("o_orderstatus")
    return read(spark, sf_dir, "orders").select(
        F.concat(F.lit("run-"), F.col("o_orderkey")).alias("run_id"),
        F.concat(F.lit("customer-"), F.col("o_custkey")).alias("pipeline_name"),
        F.col("o_orderdate").alias("started_at"),
        F.when(F.col("o_orderpriority") == "5-LOW", F.col("o_orderdate") - F.expr("INTERVAL 1 SECOND"))
        .otherwise(F.col("o_orderdate") + F.expr("INTERVAL 1 MINUTE"))
        .alias("finished_at"),
        F.when(status == "F", "FAILED").when(status == "O", "SUCCESS").otherwise("PENDING").alias("status"),
        F.lit(None).cast("timestamp").alias("previous_watermark"),
        F.when(F.col("o_orderpriority") != "3-MEDIUM", F.col("o_orderdate")).alias("resulting_watermark"),
        size.alias("rows_received"),
        (size - 1).alias("rows_after_deduplication"),
        (size - 1 - size % 7).alias("rows_inserted"),
        F.when(F.col("o_orderpriority") == "1-URGENT", -1).otherwise(size % 7).cast("bigint").alias("rows_updated"),
        F.lit(0).cast("bigint").alias("rows_ignored"),
        F.lit(None).cast("string").alias("error_type"),
        F.lit(None).cast("string").alias("error_message"),
    )
