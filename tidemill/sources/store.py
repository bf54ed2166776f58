"""Tables kept as Parquet folders: appended batch by batch, or rebuilt version by version.

Layout of a table: `<root>/<table>/data/batch_id=<n>/` or `.../data/version=<n>/`, never changed
once logged, and beside it small tables: `log/` says what was begun, written and published, `files/` lists the files of each
write with their rows, `digests/` holds checksums of buckets of rows for tables that ask for them.
One writer per table; readers go by the log, so a half-written batch or version is never seen.

Counts come from the writing job itself (`Observation`), so nothing that was written is read again to count it.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

BATCH = "batch_id"
VERSION = "version"
INVENTORY_SCHEMA = (
    "table_name string, kind string, snapshot_count bigint, current_snapshot bigint, last_change timestamp"
)
LOG_SCHEMA = (
    "kind string, id bigint, seq bigint, operation string, status string, at timestamp, rows bigint, files bigint, "
    "bytes bigint, buckets int, origin string, write_id string"
)
FILES_SCHEMA = "write_id string, file_path string, file_size_in_bytes bigint, record_count bigint"
DIGESTS_SCHEMA = "write_id string, bucket int, n bigint, sum_1 decimal(38,0), sum_2 decimal(38,0)"
# Files that one write can tell apart by their rows.
MOST_FILES = 1 << 20
# Files of a bucket: one row that fills most of a table is written by so many tasks.
BUCKET_FILES = 4


class SchemaMismatch(ValueError):
    """Columns of a batch are not those of its table."""


@dataclass(frozen=True)
class State:
    """What the log says of a table."""

    batch: int | None  # highest loaded
    begun: int | None  # highest ever begun
    version: int | None  # highest ever begun
    published: int | None  # shown to readers: the one published last, which may be an older one published again
    seq: int  # number of the next entry
    hidden: tuple[int, ...]  # batches begun and not finished


@dataclass(frozen=True)
class Written:
    """What a write has left."""

    write_id: str | None = None
    rows: int | None = None
    files: int | None = None
    bytes: int | None = None
    buckets: int | None = None


def bucket_of(columns: Sequence[str], buckets: int) -> Column:
    """Bucket of a row by all its values, so that equal rows share one."""
    return F.pmod(F.xxhash64(*columns), F.lit(buckets)).cast("int")


def digests(df: DataFrame, buckets: int) -> DataFrame:
    """Checksums per bucket that do not depend on the order of rows; sums, unlike XOR, see repeated rows."""
    h = [F.xxhash64(F.lit(i), *df.columns).cast("decimal(38,0)") for i in (1, 2)]
    return df.groupBy(bucket_of(df.columns, buckets).alias("bucket")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(h[0]).cast("decimal(38,0)").alias("sum_1"), F.sum(h[1]).cast("decimal(38,0)").alias("sum_2")
    )


@dataclass(frozen=True)
class Store:
    """A folder of tables."""

    spark: SparkSession
    root: str
    format: str = "parquet"

    def data_path(self, table: str) -> str:
        return f"{self.root}/{table}/data"

    def log_path(self, table: str) -> str:
        return f"{self.root}/{table}/log"

    def _beside(self, table: str, name: str) -> str:
        return f"{self.root}/{table}/{name}"

    # -- log ---------------------------------------------------------------------------------

    def log(self, table: str) -> DataFrame:
        """Last entry of each batch or version."""
        return last_entries(self._entries(table), ["kind", "id"], "seq")

    def _entries(self, table: str) -> DataFrame:
        """All entries; a few for each write, so they fit one task, which spares shuffles."""
        return read_or_empty(self.spark, self.log_path(table), LOG_SCHEMA).coalesce(1)

    def write_log(
        self, table: str, kind: str, number: int, operation: str, status: str, written: Written, origin: str | None = None,
        seq: int | None = None,
    ) -> None:
        entry = self.spark.range(1).select(
            F.lit(kind).alias("kind"),
            F.lit(number).cast("bigint").alias("id"),
            F.lit(self.state(table).seq if seq is None else seq).cast("bigint").alias("seq"),
            F.lit(operation).alias("operation"),
            F.lit(status).alias("status"),
            F.current_timestamp().alias("at"),
            *(F.lit(getattr(written, c)).cast("bigint").alias(c) for c in ("rows", "files", "bytes")),
            F.lit(written.buckets).cast("int").alias("buckets"),
            F.lit(origin).cast("string").alias("origin"),
            F.lit(written.write_id).cast("string").alias("write_id"),
        )
        entry.coalesce(1).write.mode("append").parquet(self.log_path(table))

    def state(self, table: str) -> State:
        """One pass over the log."""
        log = self._entries(table)
        shown = F.when(F.col("status") == "published", F.col("seq"))
        last = log.groupBy("kind", "id").agg(F.max_by("status", "seq").alias("status"), F.max("seq").alias("seq"), F.max(shown).alias("shown"))
        batch, version = F.col("kind") == BATCH, F.col("kind") == VERSION
        row = last.agg(
            F.max(F.when(batch & (F.col("status") == "loaded"), F.col("id"))).alias("batch"),
            F.max(F.when(batch, F.col("id"))).alias("begun"),
            F.max(F.when(version, F.col("id"))).alias("version"),
            F.max_by("id", F.when(version, F.col("shown"))).alias("published"),
            F.coalesce(F.max("seq") + 1, F.lit(1)).alias("seq"),
            F.sort_array(F.collect_list(F.when(batch & (F.col("status") == "begun"), F.col("id")))).alias("hidden"),
        ).first()
        return State(**{**row.asDict(), "hidden": tuple(row["hidden"])})

    def exists(self, table: str) -> bool:
        state = self.state(table)
        return state.batch is not None or state.published is not None

    def last_batch(self, table: str) -> int | None:
        return self.state(table).batch

    def current_version(self, table: str) -> int | None:
        return self.state(table).published

    def published(self, table: str, as_of: int) -> int:
        """The highest published version up to a number; staged and rejected ones are not readers' business."""
        shown = self.log(table).filter((F.col("kind") == VERSION) & (F.col("status") == "published") & (F.col("id") <= as_of))
        version = shown.agg(F.max("id")).first()[0]
        if version is None:
            raise LookupError(f"{table}: nothing published up to version {as_of}")
        return version

    # -- writing -----------------------------------------------------------------------------

    def _write(self, df: DataFrame, table: str, kind: str, number: int, buckets: int | None = None) -> Written:
        """Write the rows, then what is known of the files, counted while they were written."""
        path, columns, write_id = f"{self.data_path(table)}/{kind}={number}", df.columns, uuid.uuid4().hex
        if buckets:
            # A task writes one file, so the number of a file tells its bucket.
            part = F.col("_bucket") * BUCKET_FILES + F.pmod(F.spark_partition_id(), F.lit(BUCKET_FILES))
            bucketed = df.withColumn("_bucket", bucket_of(columns, buckets)).withColumn("_part", part)
            df = bucketed.repartitionById(buckets * BUCKET_FILES, F.col("_part"))
        metrics = Observation()
        counted = df.select(*columns, F.spark_partition_id().alias("_task")).observe(
            metrics,
            F.count(F.lit(1)).alias("rows"),
            # With as many bins as values this is their exact frequency.
            F.histogram_numeric("_task", F.lit(MOST_FILES)).alias("tasks"),
        )
        counted.select(*columns).write.mode("overwrite").option("maxRecordsPerFile", 0).format(self.format).save(path)
        found = metrics.get
        rows_of = F.from_json(F.lit(json.dumps({int(b["x"]): int(b["y"]) for b in found["tasks"] or []})), "map<string,bigint>")
        task = F.regexp_extract("path", r"/part-0*(\d+)[^/]*$", 1)
        listed = self.spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
        files = listed.select(
            F.lit(write_id).alias("write_id"),
            F.col("_metadata.file_path").alias("file_path"),
            F.col("length").alias("file_size_in_bytes"),
            F.coalesce(F.try_element_at(rows_of, task), F.lit(0)).alias("record_count"),
        )
        totals = Observation()
        files.coalesce(1).observe(totals, F.count(F.lit(1)).alias("files"), F.sum("file_size_in_bytes").alias("bytes")).write.mode(
            "append"
        ).parquet(self._beside(table, "files"))
        if buckets:
            whole = self.spark.read.format(self.format).load(path)
            digests(whole, buckets).select(F.lit(write_id).alias("write_id"), "*").coalesce(1).write.mode("append").parquet(
                self._beside(table, "digests")
            )
        return Written(write_id, found["rows"], totals.get["files"], totals.get["bytes"] or 0, buckets)

    def schema(self, table: str, before: int | None = None) -> DataFrame | None:
        """No rows, with the columns of the last loaded batch (before a number), None if there is none."""
        loaded = self.log(table).filter((F.col("kind") == BATCH) & (F.col("status") == "loaded"))
        if before is not None:
            loaded = loaded.filter(F.col("id") < before)
        last = loaded.agg(F.max("id")).first()[0]
        return None if last is None else self.spark.read.format(self.format).load(f"{self.data_path(table)}/{BATCH}={last}").limit(0)

    def aligned(self, df: DataFrame, table: str, batch_id: int) -> DataFrame:
        """Columns of a new batch by name, in the order and with the types of an earlier one."""
        target = self.spark.read.format(self.format).load(f"{self.data_path(table)}/{BATCH}={batch_id}").schema
        missing = sorted(set(target.names) - set(df.columns))
        extra = sorted(set(df.columns) - set(target.names))
        if missing or extra:
            raise SchemaMismatch(f"{table}: missing columns {missing}, extra columns {extra}")
        return df.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in target.fields))

    def batch_of(self, table: str, origin: str) -> int | None:
        """Number that the batch of an origin has got."""
        log = self._entries(table)
        return log.filter((F.col("kind") == BATCH) & (F.col("origin") == origin)).agg(F.max("id")).first()[0]

    def numbers(self) -> DataFrame:
        """Highest batch number ever begun of each table: `feed, last`."""
        log = self._logs()
        if log is None:
            return self.spark.createDataFrame([], "feed string, last bigint")
        return log.filter(F.col("kind") == BATCH).groupBy(F.col("table_name").alias("feed")).agg(F.max("id").alias("last"))

    def append_or_create(
        self, df: DataFrame, table: str, batch_id: int | None = None, origin: str | None = None, above: int | None = None
    ) -> int:
        """Write one batch; the first one creates the table. Writing a batch again replaces it.

        `origin` names where a batch comes from, such as one micro-batch of one stream. Its first write gives it a number
        of its own (beyond `above`), which the log keeps, so a replay replaces this batch and no other. While a batch with
        a given number or origin is written, readers do not see it.
        """
        state = self.state(table)
        if state.version is not None:
            raise ValueError(f"{table} is rebuilt as a whole: a batch would never be seen")
        if origin is not None and batch_id is None:
            batch_id = self.batch_of(table, origin)
        named = origin is not None or batch_id is not None
        if batch_id is None:
            batch_id = max(state.begun or 0, above or 0) + 1
        if state.batch is not None:
            other = state.batch
            if other == batch_id:
                other = self.log(table).filter((F.col("kind") == BATCH) & (F.col("status") == "loaded") & (F.col("id") != batch_id))
                other = other.agg(F.max("id")).first()[0]
            if other is not None:
                df = self.aligned(df, table, other)
        seq = state.seq
        if named:
            self.write_log(table, BATCH, batch_id, "append", "begun", Written(), origin, seq)
            seq += 1
        self.write_log(table, BATCH, batch_id, "append", "loaded", self._write(df, table, BATCH, batch_id), origin, seq)
        return batch_id

    def _write_version(self, df: DataFrame, table: str, status: str, buckets: int | None) -> int:
        """Write the next version, then log it. What a crash leaves unlogged is overwritten next time."""
        state = self.state(table)
        if state.begun is not None:
            raise ValueError(f"{table} grows by batches: a rebuild would hide them")
        number = (state.version or 0) + 1
        written = self._write(df, table, VERSION, number, buckets)
        self.write_log(table, VERSION, number, "overwrite", status, written, seq=state.seq)
        return number

    def stage_version(self, df: DataFrame, table: str, buckets: int | None = None) -> int:
        """Write the next version without showing it to readers."""
        return self._write_version(df, table, "staged", buckets)

    def _entry(self, table: str, version: int) -> Written:
        """What the log says of the write of a version."""
        row = self.log(table).filter((F.col("kind") == VERSION) & (F.col("id") == version)).first()
        if row is None:
            raise LookupError(f"{table} has no version {version}")
        return Written(row["write_id"], row["rows"], row["files"], row["bytes"], row["buckets"])

    def publish(self, table: str, version: int) -> None:
        self.write_log(table, VERSION, version, "overwrite", "published", self._entry(table, version))

    def reject(self, table: str, version: int) -> None:
        self.write_log(table, VERSION, version, "overwrite", "rejected", self._entry(table, version))

    def materialize(self, df: DataFrame, table: str, buckets: int | None = None) -> int:
        """Full rebuild: a new version takes the place of the old one.

        With `buckets`, rows are laid out by that many buckets of their hash, with a checksum of each, so that a later
        version can be compared by reading only the buckets that differ.
        """
        return self._write_version(df, table, "published", buckets)

    # -- reading -----------------------------------------------------------------------------

    def _scan(self, table: str) -> DataFrame:
        return self.spark.read.format(self.format).load(self.data_path(table))

    def read_version(self, table: str, version: int) -> DataFrame:
        """One version, published or not; only its folder is read."""
        path = f"{self.data_path(table)}/{VERSION}={version}"
        return self.spark.read.format(self.format).load(path)

    def read(self, table: str, as_of: int | None = None) -> DataFrame:
        """Table as readers see it, now or as of a batch or version.

        An appended table keeps its batch_id column, and older states are read by pruning batches.
        """
        df = self.read_if_exists(table, as_of)
        if df is None:
            raise LookupError(f"no table {table} under {self.root}")
        return df

    def read_if_exists(self, table: str, as_of: int | None = None) -> DataFrame | None:
        state = self.state(table)
        if state.published is not None:
            return self.read_version(table, state.published if as_of is None else self.published(table, as_of))
        if state.batch is None:
            return None
        upto = state.batch if as_of is None else min(as_of, state.batch)
        shown = self._scan(table).withColumn(BATCH, F.col(BATCH).cast("bigint")).filter(F.col(BATCH) <= upto)
        return shown.filter(~F.col(BATCH).isin(*state.hidden)) if state.hidden else shown

    def differing_buckets(self, table: str, older: int, newer: int) -> tuple[int, list[int]] | None:
        """Number of buckets of two versions, and those whose checksums differ; None if they were not written alike."""
        a, b = self._entry(table, older), self._entry(table, newer)
        if a.buckets is None or a.buckets != b.buckets:
            return None
        if self.read_version(table, older).schema != self.read_version(table, newer).schema:
            return None
        known = read_or_empty(self.spark, self._beside(table, "digests"), DIGESTS_SCHEMA)
        ours = known.filter(F.col("write_id").isin(a.write_id, b.write_id)).dropDuplicates(["write_id", "bucket"])
        same = F.count_distinct(F.struct("n", "sum_1", "sum_2")) == 1
        sides = F.lit(1 if a.write_id == b.write_id else 2)
        differing = ours.groupBy("bucket").agg((same & (F.count(F.lit(1)) == sides)).alias("same")).filter(~F.col("same"))
        return a.buckets, sorted(r["bucket"] for r in differing.collect())  # at most one row per bucket

    def read_buckets(self, table: str, version: int, wanted: Sequence[int]) -> DataFrame:
        """Rows of some buckets of a version; no other file is opened."""
        whole = self.read_version(table, version)
        task = F.regexp_extract("file_path", r"/part-(\d+)[^/]*$", 1).cast("int")
        files = read_or_empty(self.spark, self._beside(table, "files"), FILES_SCHEMA)
        mine = files.filter((F.col("write_id") == self._entry(table, version).write_id) & (F.col("record_count") > 0))
        paths = [r[0] for r in mine.filter(F.floor(task / BUCKET_FILES).isin(*wanted)).select("file_path").distinct().collect()]
        if not paths:
            return whole.limit(0)
        return self.spark.read.schema(whole.schema).format(self.format).load(paths)

    # -- inspection --------------------------------------------------------------------------

    def _shown(self, table: str) -> DataFrame:
        """Log entries of what readers can see, now or as of an earlier state."""
        state = self.state(table)
        kind, visible = (BATCH, "loaded") if state.published is None else (VERSION, "published")
        return self.log(table).filter((F.col("kind") == kind) & (F.col("status") == visible))

    def data_files(self, table: str) -> DataFrame:
        """Files of the table as it is now, with their size and number of rows; the data is not read."""
        shown, state = self._shown(table), self.state(table)
        if state.published is not None:
            shown = shown.filter(F.col("id") == state.published)
        files = read_or_empty(self.spark, self._beside(table, "files"), FILES_SCHEMA)
        return files.join(F.broadcast(shown.select("write_id")), "write_id", "left_semi").drop("write_id")

    def snapshots(self, table: str) -> DataFrame:
        """Batches or published versions: when, by which operation, with how many files and rows; the log alone is read."""
        return self._shown(table).select(
            F.col("id").alias("snapshot_id"),
            F.col("at").alias("committed_at"),
            "operation",
            F.col("files").alias("added_files"),
            F.col("rows").alias("added_records"),
        )

    def history(self, table: str) -> DataFrame:
        """Snapshots with the number of rows the table had after each.

        The window spans the log alone: one row per batch ever written.
        """
        upto = W.orderBy("snapshot_id").rowsBetween(W.unboundedPreceding, W.currentRow)
        rebuilt = F.col("operation") == "overwrite"
        return self.snapshots(table).withColumn(
            "total_records", F.when(rebuilt, F.col("added_records")).otherwise(F.sum("added_records").over(upto))
        )

    def _logs(self) -> DataFrame | None:
        """Logs of all tables, with the table's name."""
        if not _exists(self.spark, f"{self.root}/*/log"):
            return None
        log = self.spark.read.schema(LOG_SCHEMA).parquet(f"{self.root}/*/log")
        return log.select("*", F.regexp_extract(F.col("_metadata.file_path"), r"/([^/]+)/log/[^/]+$", 1).alias("table_name"))

    def inventory(self) -> DataFrame:
        """All tables with the number of their snapshots, the current one and its time; logs alone are read."""
        log = self._logs()
        if log is None:
            return self.spark.createDataFrame([], INVENTORY_SCHEMA)
        return log.filter(F.col("status").isin("loaded", "published")).groupBy("table_name", "kind").agg(
            F.count_distinct("id").alias("snapshot_count"),
            F.max("id").alias("current_snapshot"),
            F.max("at").alias("last_change"),
        )

    def properties(self, table: str) -> DataFrame:
        """Format, place, kind and current snapshot of a table, as key and value."""
        state = self.state(table)
        entries = {
            "format": self.format,
            "location": self.data_path(table),
            "kind": BATCH if state.published is None else VERSION,
            "current_snapshot": str(state.batch if state.published is None else state.published),
        }
        return self.spark.createDataFrame(list(entries.items()), "key string, value string")


def _exists(spark: SparkSession, pattern: str) -> bool:
    """Whether a path, or any that a pattern names, is there."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return found is not None and len(found) > 0


def read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A Parquet folder, or no rows if nothing was written there yet."""
    if _exists(spark, path):
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema)


def last_entries(log: DataFrame, keys: list[str], at: str | Column) -> DataFrame:
    """Newest row per key of a log."""
    names = [c for c in log.columns if c not in keys]
    newest = log.groupBy(*keys).agg(F.max_by(F.struct(*names), at).alias("_last"))
    return newest.select(*keys, "_last.*").select(*log.columns)


def file_list(df: DataFrame) -> DataFrame:
    """File path, size and row count behind a Parquet frame."""
    meta = df.select(
        F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_size").alias("file_size_in_bytes")
    )
    return meta.groupBy("file_path", "file_size_in_bytes").agg(F.count(F.lit(1)).alias("record_count"))
