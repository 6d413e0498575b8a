"""Canonical state lines and digests that are equal when the business state is, and by accident never else.

One SHA-256 over all lines in key order would have to run through a single task, so the digest
is a tree: each line is hashed, the hashes of a bucket are added up lane by lane, and the root
hashes the bounded list of bucket digests. Sums do not depend on row order and combine on the
map side, so neither a sort nor a collected group is needed at any size. They can also be carried
on: a load takes off the hashes of the lines it replaces and adds those it writes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from changefold.functions.canonical import json_line
from changefold.spec import VersionedTable

#: Hex digits of the key hash that name a bucket: 16 ** 3 buckets whatever the table's size.
BUCKET_DIGITS = 3
#: A line hash is cut into 8 lanes of 8 hex digits (32 bits) each.
LANES = 8
LANE_NAMES = tuple(f"lane{i}" for i in range(LANES))
_LANE_RANGE = 1 << 32


def canonical_lines(state: DataFrame, table: VersionedTable) -> DataFrame:
    """(key, line): one compact JSON line per row, operational columns left out."""
    fields = [state.schema[name] for name in table.columns]
    return state.select(*table.key, json_line(fields).alias("line"))


def line_hash(table: VersionedTable, schema: T.StructType, prefix: str = "") -> Column:
    """SHA-256 of a row's canonical line, in hex; ``prefix`` names columns other than the table's own."""
    renamed = [(schema[name], F.col(prefix + name)) for name in table.columns]
    return F.sha2(json_line([field for field, _ in renamed], [value for _, value in renamed]), 256)


def digest_bucket(table: VersionedTable) -> Column:
    """Which of the 16 ** 3 digest buckets a key falls in."""
    return F.left(F.sha2(F.concat_ws("\x1f", *table.key), 256), F.lit(BUCKET_DIGITS))


def lanes(line: Column) -> list[Column]:
    """A line hash as numbers of 32 bits; zeros for no line."""
    parts = (F.conv(F.substring(line, 1 + 8 * i, 8), 16, 10).cast("bigint") for i in range(LANES))
    return [F.coalesce(part, F.lit(0).cast("bigint")).alias(name) for part, name in zip(parts, LANE_NAMES, strict=True)]


def sums(lines: DataFrame, *by: str) -> DataFrame:
    """``n_rows`` and the lanes of (n_rows, lanes) rows added up per bucket; map-side, then one row per bucket."""
    added = [F.pmod(F.sum(name), F.lit(_LANE_RANGE)).alias(name) for name in LANE_NAMES]
    return lines.groupBy(*by).agg(F.sum("n_rows").alias("n_rows"), *added)


def bucket_sums(state: DataFrame, table: VersionedTable) -> DataFrame:
    """(bucket, n_rows, lanes) of a state, read in full."""
    hashed = state.select(digest_bucket(table).alias("bucket"), line_hash(table, state.schema).alias("hash"))
    return sums(hashed.select("bucket", F.lit(1).cast("bigint").alias("n_rows"), *lanes(F.col("hash"))), "bucket")


def digests(summed: DataFrame) -> DataFrame:
    """(bucket, n_rows, digest) of added-up buckets; a bucket without rows is none."""
    written = [F.col(name).cast("string") for name in LANE_NAMES]
    digest = F.sha2(F.concat_ws(":", "bucket", F.col("n_rows").cast("string"), *written), 256)
    return summed.where("n_rows <> 0").select("bucket", "n_rows", digest.alias("digest"))


def root(digested: DataFrame) -> DataFrame:
    """One row: n_rows and the root digest; the digest of an empty state is SHA-256 of nothing."""
    listed = F.array_join(F.array_sort(F.collect_list(F.concat_ws(":", "bucket", "digest"))), "\n")
    return digested.agg(F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"), F.sha2(listed, 256).alias("state_checksum"))


def bucket_digests(state: DataFrame, table: VersionedTable) -> DataFrame:
    """(bucket, n_rows, digest): tells in which part of the key space two states differ."""
    return digests(bucket_sums(state, table))


def state_digest(state: DataFrame, table: VersionedTable) -> DataFrame:
    """One row: n_rows and the root digest of a state, read in full."""
    return root(bucket_digests(state, table))
