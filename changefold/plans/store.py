"""Where the current state lives: bucketed Parquet, in layers, plus one small manifest per successful load.

    <root>/data/run=<run>/bucket=<n>/   rows of bucket n that run wrote: a whole bucket, or changes to it
    <root>/digests/run=<run>/           line hashes of the state added up, as of that run
    <root>/quarantine/run=<run>/        rows that run rejected, if it was asked to keep them
    <root>/manifests/<number>.json      layers of every bucket, state of every pipeline, that load's record
    <root>/failed_runs/                 records of failed loads
    <root>/run_ids/<run>                an empty file for every run id ever used
    <root>/staging/<run>/               intermediate tables of a load, dropped when it ends

Creating the next manifest is the one commit point: target rows, progress mark and success
record become visible together. Whatever a failed load wrote is named by no manifest.

A bucket is a base and the change files written since. A load adds the rows it inserts and updates, so that
its cost follows the change; a bucket is written anew when its changes have grown to a share of
its base, or have become many, the next time a load touches it or by ``compact``. Readers take the newest
row of every key.

All layers together are an ordinary bucketed Spark table whose partitions are the layers of its buckets,
each with its own location. So neither merging the layers nor a join on the key needs an exchange of
the target, and only named buckets are read.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Collection, Iterable
from dataclasses import asdict, dataclass, field, replace
from datetime import UTC, datetime, timedelta

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from changefold.errors import PublishConflictError
from changefold.operators import audit, checksum
from changefold.operators.compare import state_diff
from changefold.operators.fold import newest_per_key
from changefold.operators.window import upsert_state
from changefold.plans.commit import Commit, commit_for
from changefold.session import one_row
from changefold.spec import FAILED, LOAD_STAMP, RUN_SCHEMA, STATE_SCHEMA, TableSpec, VersionedTable

BUCKET, LAYER = "bucket", "layer"
#: Hash of the line that a row replaced when it was written; null for an inserted row.
REPLACED = "replaced"
#: Run ids name folders and stand in SQL text.
RUN_ID = re.compile(r"[A-Za-z0-9_-][A-Za-z0-9._-]{0,127}")
#: Size of a bucket to aim at, and the fewest buckets a store is given.
BUCKET_BYTES = 512 * 1024 * 1024
MIN_BUCKETS = 8
#: A bucket is due to be written anew at so many change files, or when they have that share of its base and that size.
MOST_CHANGES = 8
CHANGED_SHARE = 0.5
CHANGED_BYTES = 8 * 1024 * 1024
#: Runs whose lines may be left to be added to the digest by whoever asks for it.
MOST_PENDING = 8
#: Winners up to this size per bucket are held in memory while the target streams past them.
HASHED_BYTES = 64 * 1024 * 1024
#: Partitions declared by one catalog call.
_CATALOG_BATCH = 500

DIGEST_SCHEMA = T.StructType(
    [
        T.StructField("kind", T.StringType()),
        T.StructField("bucket", T.StringType()),
        T.StructField("n_rows", T.LongType()),
        *(T.StructField(name, T.LongType()) for name in checksum.LANE_NAMES),
    ]
)
#: Kinds of digest rows: by hash of the key, as the checksum takes them, and by bucket of the store.
BY_KEY, BY_BUCKET = "key", "bucket"

QUARANTINE_SCHEMA = T.StructType(
    [
        T.StructField("record", T.StringType()),
        T.StructField("rule", T.StringType()),
        T.StructField("run", T.StringType()),
    ]
)


@dataclass(frozen=True)
class PipelineState:
    """How far a pipeline got; one row of the state."""

    pipeline_name: str
    watermark: datetime
    last_successful_run_id: str
    updated_at: datetime


@dataclass(frozen=True)
class RunRecord:
    """What one load did; one row of the run audit."""

    run_id: str
    pipeline_name: str
    started_at: datetime
    finished_at: datetime | None = None
    status: str = FAILED
    previous_watermark: datetime | None = None
    resulting_watermark: datetime | None = None
    rows_received: int = 0
    rows_after_deduplication: int = 0
    rows_inserted: int = 0
    rows_updated: int = 0
    rows_ignored: int = 0
    error_type: str | None = None
    error_message: str | None = None

    def as_frame(self, spark: SparkSession) -> DataFrame:
        return one_row(spark, RUN_SCHEMA, asdict(self))


@dataclass(frozen=True)
class Snapshot:
    """One published state. Its size is bounded by the number of buckets and pipelines.

    ``buckets`` names the run that wrote each bucket's base, ``changes`` those that wrote changes to it
    since, oldest first, ``sizes`` the bytes of both. ``n_buckets`` is 0 as long as nothing decided it.
    ``digest`` names the run up to which lines were added up, ``pending`` the runs that wrote since; a
    store written before there were digests has neither.
    """

    number: int = 0
    n_buckets: int = 0
    buckets: dict[int, str] = field(default_factory=dict)
    changes: dict[int, list[str]] = field(default_factory=dict)
    sizes: dict[int, list[int]] = field(default_factory=dict)
    state: dict[str, dict] = field(default_factory=dict)
    digest: str | None = None
    pending: list[str] = field(default_factory=list)

    @property
    def digested(self) -> bool:
        """Whether the state's line hashes are known without reading it."""
        return bool(self.digest or self.pending or not self.buckets)

    @property
    def marks(self) -> dict[str, datetime]:
        """Mark of every pipeline."""
        return {name: datetime.fromisoformat(row["watermark"]) for name, row in self.state.items()}

    def layers(self, bucket: int) -> list[str]:
        """Runs whose files make up a bucket, oldest first."""
        return [self.buckets[bucket], *self.changes.get(bucket, [])]

    def due(self, bucket: int) -> bool:
        """Whether a bucket is better written anew than changed once more."""
        base, changed = self.sizes.get(bucket, (0, 0))
        many = len(self.changes.get(bucket, [])) >= MOST_CHANGES
        return bucket not in self.buckets or many or changed > max(CHANGED_BYTES, CHANGED_SHARE * base)


class TargetStore:
    def __init__(
        self, spark: SparkSession, root: str, spec: TableSpec, n_buckets: int | None = None, commit: Commit | None = None
    ) -> None:
        """``n_buckets`` counts for a new store only; left open, the first rows to load decide it.

        ``commit`` creates manifests and claims run ids; left open, the file system decides.
        """
        self.spark = spark
        self.root = root.rstrip("/")
        self.spec = spec
        self._new_buckets = n_buckets or 0
        self._commit = commit or commit_for(spark, self.root, self._fs)
        self._tables: dict[int, str] = {}
        self._staged: list[str] = []

    def reopened(self) -> TargetStore:
        """The same store with catalog entries of its own, to be forgotten without harm."""
        return TargetStore(self.spark, self.root, self.spec, self._new_buckets, self._commit)

    # -- reading ---------------------------------------------------------------------------

    def snapshot(self, number: int | None = None) -> Snapshot:
        """A published snapshot, the newest unless its number is given; the empty one before the first load."""
        fs, folder = self._fs(f"{self.root}/manifests")
        names = [entry.getPath().getName() for entry in fs.listStatus(folder)] if fs.exists(folder) else []
        numbers = {int(name[:-5]) for name in names if name.endswith(".json") and name[:-5].isdigit()}
        if number is not None and number not in numbers:
            raise ValueError(f"there is no snapshot {number}")
        if not numbers:
            return Snapshot(n_buckets=self._new_buckets)
        body = self._body(max(numbers) if number is None else number)
        return Snapshot(
            body["number"],
            body["n_buckets"] or self._new_buckets,
            {int(bucket): run for bucket, run in body["buckets"].items()},
            {int(bucket): runs for bucket, runs in body.get("changes", {}).items()},
            {int(bucket): sizes for bucket, sizes in body.get("sizes", {}).items()},
            {row["pipeline_name"]: row for row in body["state"]},
            body.get("digest"),
            body.get("pending", []),
        )

    def target(self, snapshot: Snapshot | None = None, buckets: Iterable[int] | None = None) -> DataFrame:
        """Target rows of a snapshot, all buckets or the named ones: the newest row of every key."""
        snapshot = snapshot or self.snapshot()
        columns = self.spec.target_schema.names
        wanted = set(snapshot.buckets) if buckets is None else set(buckets) & set(snapshot.buckets)
        if not wanted:
            return self.spark.createDataFrame([], self.spec.target_schema)
        rows = self.spark.table(self._declare(snapshot))
        if wanted != set(snapshot.buckets):
            rows = rows.filter(F.col(BUCKET).isin(sorted(wanted)))
        layers = max(len(snapshot.layers(bucket)) for bucket in wanted)
        if layers == 1:
            return rows.select(*columns)
        late = rows.filter(F.col(LAYER) > 0).select(*columns)
        if layers > 2:
            late = newest_per_key(late, VersionedTable(self.spec.key, self.spec.version, (*self.spec.payload, *LOAD_STAMP.names)))
        # Changes to a bucket are a share of it, so that their keys fit in memory; the base is not sorted.
        replaced = late.select(*self.spec.key).hint("shuffle_hash")
        base = rows.filter(F.col(LAYER) == 0).select(*columns).join(replaced, list(self.spec.key), "left_anti")
        return base.select(*columns).unionByName(late.select(*columns))

    def state(self, snapshot: Snapshot | None = None) -> DataFrame:
        """Progress of every pipeline."""
        snapshot = snapshot or self.snapshot()
        listed = F.from_json(F.lit(json.dumps(list(snapshot.state.values()))), T.ArrayType(STATE_SCHEMA))
        return self.spark.sql("SELECT 1").select(F.inline(listed))

    def runs(self) -> DataFrame:
        """Record of every load that succeeded or failed."""
        runs = self.spark.createDataFrame([], RUN_SCHEMA)
        fs, manifests = self._fs(f"{self.root}/manifests")
        if fs.exists(manifests):
            published = self.spark.read.schema(T.StructType([T.StructField("run", RUN_SCHEMA)]))
            runs = runs.unionByName(published.json(manifests.toString()).where("run IS NOT NULL").select("run.*"))
        failed = self._fs(f"{self.root}/failed_runs")[1]
        if fs.exists(failed):
            runs = runs.unionByName(self.spark.read.schema(RUN_SCHEMA).json(failed.toString()))
        return runs

    def quarantined(self) -> DataFrame:
        """(record, rule, run): rows that published loads rejected, as they stood in the source."""
        fs, folder = self._fs(f"{self.root}/quarantine")
        if not fs.exists(folder):
            return self.spark.createDataFrame([], QUARANTINE_SCHEMA)
        kept = self.spark.read.schema(QUARANTINE_SCHEMA).option("basePath", folder.toString()).parquet(folder.toString())
        published = self.runs().where(F.col("status") != FAILED).select(F.col("run_id").alias("run"))
        return kept.join(published, "run", "left_semi").select(*QUARANTINE_SCHEMA.names)

    def checksum(self, snapshot: Snapshot | None = None) -> DataFrame:
        """One row: n_rows and the checksum of the state, out of the lines that loads replaced and wrote; the target is not read."""
        snapshot = snapshot or self.snapshot()
        if not snapshot.digested:
            return checksum.state_digest(self.target(snapshot), self.spec)
        lines = self._lines(snapshot).where(F.col("kind") == BY_KEY)
        return checksum.root(checksum.digests(checksum.sums(lines, "bucket")))

    def differing_buckets(self, left: Snapshot, right: Snapshot) -> list[int]:
        """Buckets whose rows differ between two snapshots, by their digests; at most as many as the store has."""
        if left.n_buckets != right.n_buckets or not (left.digested and right.digested):
            return sorted({*left.buckets, *right.buckets})
        if (left.digest, left.pending) == (right.digest, right.pending):
            return []
        sides = [checksum.sums(self._lines(s).where(F.col("kind") == BY_BUCKET), "bucket") for s in (left, right)]
        both = sides[0].unionByName(sides[1]).groupBy(*sides[0].columns).count()
        return sorted({int(row["bucket"]) for row in both.where("count = 1").select("bucket").distinct().collect()})

    def differences(self, left: Snapshot, right: Snapshot) -> DataFrame:
        """Business rows that only one of two snapshots has (``only_in``: left or right), reading the buckets that differ."""
        buckets = self.differing_buckets(left, right)
        return state_diff(*(self.target(s, buckets).select(*self.spec.columns) for s in (left, right)))

    # -- maintenance -----------------------------------------------------------------------

    def rebucket(self, n_buckets: int) -> Snapshot:
        """Split every bucket into equal parts, so that the store has ``n_buckets``, a multiple of what it had.

        A key of bucket b goes to b, b + old, b + 2 old and so on, so that each task reads one old
        bucket and writes its parts, without an exchange.
        """
        base = self.snapshot()
        if not base.n_buckets or n_buckets % base.n_buckets or n_buckets == base.n_buckets:
            raise ValueError(f"{n_buckets} is no multiple of the store's {base.n_buckets} buckets")
        run_id = f"rebucket-{uuid.uuid4()}"
        wider = Snapshot(base.number, n_buckets, state=base.state)
        self._new_buckets = n_buckets
        if not base.buckets:
            return self.publish(wider, run_id, {}, None, None)
        written = self.write_buckets(self.target(base).withColumn(REPLACED, F.lit(None).cast("string")), run_id, n_buckets)
        digest = self._write_digest(self._lines_of(self.target(base), n_buckets), run_id)
        return self.publish(wider, run_id, written, None, None, digest=digest)

    def compact(self, buckets: Iterable[int] | None = None) -> Snapshot:
        """Write buckets that have changes anew, all or the named ones, without an exchange. Rows stay as they are."""
        base = self.snapshot()
        wanted = sorted(set(base.changes) if buckets is None else set(base.changes) & set(buckets))
        if not wanted:
            return base
        run_id = f"compact-{uuid.uuid4()}"
        rows = self.target(base, wanted).withColumn(REPLACED, F.lit(None).cast("string"))
        written = self.write_buckets(rows, run_id, base.n_buckets)
        digest = self._write_digest(self._lines(base), run_id) if base.pending else None
        return self.publish(base, run_id, written, None, None, digest=digest)

    def vacuum(self, keep: int = 1, older_than: timedelta = timedelta(days=1)) -> list[str]:
        """Delete data and digests of runs that none of the last ``keep`` snapshots names; give the run ids of the data.

        Folders changed within ``older_than`` stay, as a load may be writing them. Readers of older
        snapshots lose their data.
        """
        if keep < 1:
            raise ValueError("keep must be at least 1")
        newest = self.snapshot().number
        used: dict[str, set[str]] = {"data": set(), "digests": set()}
        for number in range(max(1, newest - keep + 1), newest + 1):
            snapshot = self.snapshot(number)
            used["data"] |= {run for bucket in snapshot.buckets for run in snapshot.layers(bucket)}
            used["data"] |= set(snapshot.pending)
            used["digests"] |= {snapshot.digest} - {None}
        limit = (datetime.now(UTC) - older_than).timestamp() * 1000
        gone = []
        for kind, named in used.items():
            fs, folder = self._fs(f"{self.root}/{kind}")
            for entry in fs.listStatus(folder) if fs.exists(folder) else []:
                run_id = entry.getPath().getName().removeprefix("run=")
                if run_id not in named and entry.getModificationTime() <= limit:
                    fs.delete(entry.getPath(), True)
                    gone += [run_id] if kind == "data" else []
        return sorted(gone)

    # -- writing ---------------------------------------------------------------------------

    def stage(
        self, rows: DataFrame, run_id: str, name: str, n_buckets: int = 0, metrics: Collection[Column] = ()
    ) -> tuple[DataFrame, dict]:
        """Write an intermediate table of a load and read it back; gives metrics observed on the way as well.

        This cuts the lineage and freezes the source. With ``n_buckets`` the table is laid out like a target
        of so many buckets, so that joins with it need no exchange.
        """
        path = f"{self.root}/staging/{run_id}/{name}"
        seen = Observation(f"{name}-{uuid.uuid4().hex}")
        if n_buckets:
            rows = self.spread(rows, n_buckets)
        # Observed in the last stage, whose tasks count once each, whatever has to be run again.
        observed = rows.observe(seen, *metrics) if metrics else rows
        if n_buckets:
            table = f"changefold_staged_{uuid.uuid4().hex}"
            self._staged.append(table)
            observed.write.bucketBy(n_buckets, *self.spec.key).format("parquet").option("path", path).saveAsTable(table)
            staged = self.spark.table(table)
        else:
            observed.write.mode("errorifexists").parquet(path)
            staged = self.spark.read.schema(rows.schema).parquet(path)
        return staged, seen.get if metrics else {}

    def staged_bytes(self, run_id: str, name: str) -> int:
        fs, folder = self._fs(f"{self.root}/staging/{run_id}/{name}")
        return fs.getContentSummary(folder).getLength()

    def choose_buckets(self, run_id: str, name: str) -> int:
        """Bucket count for a staged table's rows: a power of two, with room to grow."""
        return max(MIN_BUCKETS, 1 << (self.staged_bytes(run_id, name) // BUCKET_BYTES).bit_length())

    def spread(self, rows: DataFrame, n_buckets: int) -> DataFrame:
        """Rows in one partition per bucket, laid out as a stored target is."""
        return rows.repartition(n_buckets, *self.spec.key)

    def write_buckets(self, rows: DataFrame, run_id: str, n_buckets: int, metrics: Collection[Column] = ()) -> dict[int, int]:
        """Write rows of buckets, whole ones or changes; gives the bytes written to each.

        Rows read from a target, or staged or spread like one, need no exchange: each task writes one file of
        one bucket. A key that is written twice fails the write.
        """
        fs, folder = self._fs(self._data(run_id))
        if fs.exists(folder):
            raise ValueError(f"run {run_id} has written before")
        table = f"changefold_write_{uuid.uuid4().hex}"
        writer = rows.withColumn(BUCKET, self.bucket_of_key(n_buckets)).write.partitionBy(BUCKET)
        try:
            writer.bucketBy(n_buckets, *self.spec.key).format("parquet").option(
                "path", self._data(run_id)
            ).saveAsTable(table)
            repeated = audit.repeated_keys(self.spark.table(table), *self.spec.key).first()
        finally:
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")
        if repeated is not None:
            shown = ", ".join(f"{name}={repeated[name]!r}" for name in self.spec.key)
            raise ValueError(f"the target would hold {repeated['n']} rows of one key: {shown}")
        return self._written(run_id)

    def carry_digest(self, base: Snapshot, run_id: str) -> str | None:
        """Add up what ``base`` has pending and what a run wrote, where that has become many runs; gives the digest's name."""
        if not base.digested or len(base.pending) + 1 < MOST_PENDING:
            return None
        return self._write_digest(self._lines(replace(base, pending=[*base.pending, run_id])), run_id)

    def publish(
        self,
        base: Snapshot,
        run_id: str,
        rewritten: dict[int, int] | Iterable[int],
        state: dict[str, dict] | None,
        run: RunRecord | None,
        added: dict[int, int] | None = None,
        digest: str | None = None,
        pending: bool = False,
    ) -> Snapshot:
        """Create the manifest that follows ``base``; refuse if somebody else already did.

        ``rewritten`` and ``added`` are the buckets the run wrote anew and those it added changes to, with
        the bytes written. Without ``state`` and ``digest`` those of ``base`` hold on; ``pending`` says that the
        digest lacks what the run wrote.
        """
        sized = rewritten if isinstance(rewritten, dict) else dict.fromkeys(rewritten, 0)
        added = added or {}
        following = Snapshot(
            base.number + 1,
            base.n_buckets,
            {**base.buckets, **dict.fromkeys(sized, run_id)},
            {**{b: runs for b, runs in base.changes.items() if b not in sized}, **{b: [*base.changes.get(b, []), run_id] for b in added}},
            {**base.sizes, **{b: [n, 0] for b, n in sized.items()}, **{b: [base.sizes[b][0], base.sizes[b][1] + n] if b in base.sizes else [0, n] for b, n in added.items()}},
            state or base.state,
            digest or base.digest,
            [] if digest else [*base.pending, *([run_id] if pending and base.digested else [])],
        )
        body = {
            "number": following.number,
            "n_buckets": base.n_buckets if following.buckets else 0,
            "buckets": _by_bucket(following.buckets),
            "changes": _by_bucket(following.changes),
            "sizes": _by_bucket(following.sizes),
            "digest": following.digest,
            "pending": following.pending,
            "state": list(following.state.values()),
            "run": _plain(run) if run else None,
        }
        self._commit.create(self._manifest(following.number), json.dumps(body, ensure_ascii=False))
        return following

    def advanced(self, base: Snapshot, reached: PipelineState) -> dict[str, dict]:
        """State of every pipeline, with a new row for the one that got further."""
        moved = upsert_state(self.state(base), one_row(self.spark, STATE_SCHEMA, asdict(reached)))
        rows = (PipelineState(**row.asDict()) for row in moved.collect())
        return {row.pipeline_name: _plain(row) for row in rows}

    def claim(self, run_id: str) -> None:
        """Take a run id for good; refuse one that is blank, unfit for a file name, or taken."""
        if not RUN_ID.fullmatch(run_id):
            raise ValueError(f"run id {run_id!r} must be 1 to 128 of the characters A-Z a-z 0-9 . _ -, not a dot first")
        try:
            self._commit.create(f"{self.root}/run_ids/{run_id}", "")
        except PublishConflictError as used:
            raise ValueError(f"run id {run_id} has been used before") from used

    def quarantine(self, rejected: DataFrame, run_id: str) -> None:
        """Keep (record, rule) rows of a run. They show once the run is published."""
        rejected.select("record", "rule").write.mode("errorifexists").parquet(f"{self.root}/quarantine/run={run_id}")

    def drop_quarantine(self, run_id: str) -> None:
        fs, folder = self._fs(f"{self.root}/quarantine/run={run_id}")
        fs.delete(folder, True)

    def record_failure(self, run: RunRecord) -> None:
        """Add the record of a failed load, apart from anything a snapshot holds."""
        run.as_frame(self.spark).coalesce(1).write.mode("append").option("ignoreNullFields", False).json(f"{self.root}/failed_runs")

    def discard_staging(self, run_id: str) -> None:
        while self._staged:
            self.spark.sql(f"DROP TABLE IF EXISTS {self._staged.pop()}")
        fs, folder = self._fs(f"{self.root}/staging/{run_id}")
        fs.delete(folder, True)

    def forget_tables(self) -> None:
        """Drop the catalog entries of the tables read so far. Their data stays."""
        while self._tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {self._tables.popitem()[1]}")

    # -- details ---------------------------------------------------------------------------

    def bucket_of_key(self, n_buckets: int, *key: Column) -> Column:
        """Spark's own bucketing function, so that bucketed reads line up with it."""
        return F.pmod(F.hash(*(key or self.spec.key)), F.lit(n_buckets)).cast("int")

    def _lines(self, snapshot: Snapshot) -> DataFrame:
        """(kind, bucket, n_rows, lanes): line hashes of a state, by hash of the key and by bucket of the store, yet to be summed."""
        lines = self.spark.createDataFrame([], DIGEST_SCHEMA)
        if snapshot.digest:
            lines = self.spark.read.schema(DIGEST_SCHEMA).parquet(f"{self.root}/digests/run={snapshot.digest}")
        if not snapshot.pending:
            return lines
        columns = [*self.spec.target_schema.fields, T.StructField(REPLACED, T.StringType()), T.StructField("run", T.StringType())]
        reader = self.spark.read.schema(T.StructType(columns)).option("basePath", f"{self.root}/data")
        rows = reader.parquet(*(self._data(run) for run in snapshot.pending))
        # Buckets written whole also hold rows of earlier runs.
        return lines.unionByName(self._lines_of(rows.where(F.col("last_run_id") == F.col("run")), snapshot.n_buckets))

    def _lines_of(self, rows: DataFrame, n_buckets: int) -> DataFrame:
        """(kind, bucket, n_rows, lanes) of each row: what it adds to the digest, less what it replaced."""
        replaced = F.col(REPLACED) if REPLACED in rows.columns else F.lit(None).cast("string")
        hashed = rows.select(
            checksum.digest_bucket(self.spec).alias(BY_KEY),
            self.bucket_of_key(n_buckets).cast("string").alias(BY_BUCKET),
            checksum.line_hash(self.spec, rows.schema).alias("new"),
            replaced.alias("old"),
        )
        sides = zip(checksum.LANE_NAMES, checksum.lanes(F.col("new")), checksum.lanes(F.col("old")), strict=True)
        moved = [(new - old).alias(name) for name, new, old in sides]
        inserted = F.when(F.col("old").isNull(), 1).otherwise(0).cast("bigint").alias("n_rows")
        kinds = F.array(*(F.struct(F.lit(kind).alias("kind"), F.col(kind).alias("bucket")) for kind in (BY_KEY, BY_BUCKET)))
        return hashed.select(kinds.alias("kinds"), inserted, *moved).select(F.inline("kinds"), "n_rows", *checksum.LANE_NAMES)

    def _write_digest(self, lines: DataFrame, run_id: str) -> str:
        checksum.sums(lines, "kind", "bucket").coalesce(1).write.parquet(f"{self.root}/digests/run={run_id}")
        return run_id

    def _written(self, run_id: str) -> dict[int, int]:
        """Bytes a run has written to each bucket."""
        fs, folder = self._fs(self._data(run_id))
        sizes: dict[int, int] = {}
        files = fs.listFiles(folder, True)
        while files.hasNext():
            entry = files.next()
            parent = entry.getPath().getParent().getName()
            if parent.startswith(f"{BUCKET}="):
                bucket = int(parent.split("=")[1])
                sizes[bucket] = sizes.get(bucket, 0) + entry.getLen()
        return sizes

    def _declare(self, snapshot: Snapshot) -> str:
        """Name of the catalog table that stands for a snapshot's target, a partition for each layer of a bucket."""
        if snapshot.number in self._tables:
            return self._tables[snapshot.number]
        table = f"changefold_read_{uuid.uuid4().hex}"
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.spec.target_schema)
        keys = ", ".join(f"`{key}`" for key in self.spec.key)
        self.spark.sql(
            f"CREATE TABLE {table} ({columns}, {BUCKET} INT, {LAYER} INT) USING parquet PARTITIONED BY ({BUCKET}, {LAYER}) "
            f"CLUSTERED BY ({keys}) INTO {snapshot.n_buckets} BUCKETS LOCATION {_literal(f'{self.root}/tables/{table}')}"
        )
        self._tables[snapshot.number] = table
        places = [
            f"PARTITION ({BUCKET}={bucket}, {LAYER}={layer}) LOCATION {_literal(f'{self._data(run)}/{BUCKET}={bucket}')}"
            for bucket in sorted(snapshot.buckets)
            for layer, run in enumerate(snapshot.layers(bucket))
        ]
        for first in range(0, len(places), _CATALOG_BATCH):
            self.spark.sql(f"ALTER TABLE {table} ADD " + " ".join(places[first : first + _CATALOG_BATCH]))
        return table

    def _data(self, run_id: str) -> str:
        return f"{self.root}/data/run={run_id}"

    def _manifest(self, number: int) -> str:
        return f"{self.root}/manifests/{number:012d}.json"

    def _body(self, number: int) -> dict:
        return json.loads(self.spark.read.text(self._manifest(number), wholetext=True).first()[0])

    def _fs(self, path: str):
        jvm = self.spark._jvm
        hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
        return hadoop_path.getFileSystem(self.spark._jsc.hadoopConfiguration()), hadoop_path


def _by_bucket(values: dict[int, object]) -> dict[str, object]:
    return {str(bucket): values[bucket] for bucket in sorted(values)}


def _literal(text: str) -> str:
    """Text as a SQL string."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _plain(row: PipelineState | RunRecord) -> dict:
    """Fields as JSON holds them."""
    return {
        name: value.astimezone(UTC).isoformat(timespec="microseconds") if isinstance(value, datetime) else value
        for name, value in asdict(row).items()
    }
