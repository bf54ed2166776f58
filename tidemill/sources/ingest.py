"""Batch ingest of a landing zone: each file is loaded once, bad rows go to quarantine.

The ledger makes a run repeatable. A run lists the landing zone once and notes each new file as `started`
with the number of its batch: one batch per feed. The batch's partition is then written, and its files
turn `loaded`, or `rejected` with a reason if their header is not the expected one. A run that finds `started`
files takes up their batch again and overwrites its partition, so a crash at any point loads nothing twice.
A batch that can never be loaded turns `failed` with the reason; the other feeds go on.

Ledger entries are written by Spark from the listing. The driver holds the paths of one batch, as
Spark's own file index does, and one row per batch.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Mapping
from functools import reduce
from operator import and_

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.functions import archive_name, delivery_name
from tidemill.functions.columns import PART
from tidemill.operators.validate import REASONS, typed, type_rules, with_reasons
from tidemill.session import scratch_table
from tidemill.sources.feeds import CORRUPT, FEEDS, Feed, landing_files, read_feed, read_feed_text
from tidemill.sources.store import SchemaMismatch, Store, last_entries, read_or_empty

LEDGER_SCHEMA = (
    "path string, uri string, file_name string, feed string, modified_at timestamp, bytes bigint, batch_id bigint, "
    "status string, loaded_at timestamp, rows bigint, quarantined bigint, archived_as string, reason string"
)
LEDGER_COLUMNS = [part.split()[0] for part in LEDGER_SCHEMA.split(", ")]
DELIVERY = ["uri", "modified_at", "bytes"]
FILE = ["path", "uri", "file_name", "feed", "modified_at", "bytes"]

# What a failed read or write raises; errors inside tasks arrive unconverted.
ERRORS = (PySparkException, Py4JJavaError, SchemaMismatch)
# Whether a line is the header of its file.
HEADER = "_header"
NO_HEADER, OTHER_COLUMNS = "header is not the declared one", "columns are not those of the table"
# Inferred types of one column in several files, the widest last; any other mixture is text.
NUMBERS = ["int", "bigint", "double"]


def ledger_path(store: Store) -> str:
    """Beside the tables, under a name that no feed has."""
    return f"{store.root}/_ingest/ledger"


def ledger(store: Store) -> DataFrame:
    """Last entry per delivered file, `started` before all others. A file delivered again has another time or size."""
    order = F.struct((F.col("status") != "started").cast("int"), F.col("loaded_at"))
    return last_entries(read_or_empty(store.spark, ledger_path(store), LEDGER_SCHEMA), DELIVERY, order)


def quarantine_table(feed: str) -> str:
    """Beside the tables; the name of a feed has no slash."""
    return f"_quarantine/{feed}"


def _note(store: Store, entries: DataFrame) -> None:
    entries.select(*LEDGER_COLUMNS).coalesce(1).write.mode("append").parquet(ledger_path(store))


def note_outcome(store: Store, files: DataFrame, outcome: DataFrame, archived: Column | None) -> None:
    """Final entries of files from the outcome of each: `uri, rows, quarantined, reason`; a reason speaks against it.

    A file without a single line has no outcome and counts as loaded. `archived` is the name that loaded files get
    in the archive, if there is one.
    """
    at = F.current_timestamp()
    loaded = F.col("reason").isNull()
    name = F.lit(None).cast("string") if archived is None else archived
    done = files.select(*FILE, "batch_id").join(outcome, "uri", "left")
    entries = done.select(
        *FILE,
        "batch_id",
        F.when(loaded, "loaded").otherwise("rejected").alias("status"),
        at.alias("loaded_at"),
        *(F.when(loaded, F.coalesce(c, F.lit(0))).otherwise(0).cast("bigint").alias(c) for c in ("rows", "quarantined")),
        F.when(loaded, name).alias("archived_as"),
        "reason",
    )
    _note(store, entries)


def stamped_name() -> Column:
    """Name in the archive: with the time of loading; a part file keeps its own name below that."""
    return F.concat(archive_name(F.col("file_name"), F.current_timestamp()), F.regexp_extract("path", PART, 0))


def _begin(store: Store, listed: DataFrame, max_files: int | None) -> None:
    """Note the files that no batch has taken as `started`. Batches of streams and others count on the same line."""
    known = ledger(store)
    pending = listed.join(known.select(*DELIVERY), DELIVERY, "left_anti")
    taken = known.select("feed", F.col("batch_id").alias("last")).unionByName(store.numbers())
    last = taken.groupBy("feed").agg(F.max("last").alias("last"))
    step = F.lit(0)
    if max_files:
        place = F.row_number().over(W.partitionBy("feed").orderBy("file_name", "path"))
        step = F.floor((place - 1) / F.lit(max_files))
    started = pending.join(last, "feed", "left").select(
        *FILE,
        (F.coalesce("last", F.lit(0)) + 1 + step).cast("bigint").alias("batch_id"),
        F.lit("started").alias("status"),
        F.current_timestamp().alias("loaded_at"),
        *(F.lit(None).cast("bigint").alias(c) for c in ("rows", "quarantined")),
        *(F.lit(None).cast("string").alias(c) for c in ("archived_as", "reason")),
    )
    if not pending.isEmpty():
        _note(store, started)


# -- declared feeds ----------------------------------------------------------------------------


def checked_rows(df: DataFrame, feed: Feed) -> DataFrame:
    """Lines with the reasons that speak against them, and whether they are the declared header.

    A line that names the declared columns is a header wherever it stands.
    """
    rules = {"wrong number of fields": F.col(CORRUPT).isNotNull()}
    rules.update(type_rules(feed.schema, feed.required))
    names = (F.lower(c) == c.lower() for c in feed.schema.names)
    header = F.coalesce(reduce(and_, names) & F.col(CORRUPT).isNull(), F.lit(False))
    return with_reasons(df, rules).withColumn(HEADER, header)


def file_outcomes(checked: DataFrame) -> DataFrame:
    """`uri, rows, quarantined, reason` of each file; one without the declared header is set aside as a whole."""
    good, line = F.size(REASONS) == 0, ~F.col(HEADER)
    counts = checked.groupBy("uri").agg(
        F.count_if(line & good).alias("rows"),
        F.count_if(line & ~good).alias("quarantined"),
        F.max(HEADER).alias("headed"),
    )
    return counts.select("uri", "rows", "quarantined", F.when(~F.col("headed"), NO_HEADER).alias("reason"))


def write_checked(
    store: Store, checked: DataFrame, outcome: DataFrame, feed: Feed, batch_id: int | None = None, origin: str | None = None,
    above: int | None = None,
) -> int:
    """Good rows to the raw table with their types, bad rows as text to the quarantine table; the number of the batch.

    `outcome` has one row per file and is small beside the lines.
    """
    aside = outcome.filter(F.col("reason").isNotNull()).select("uri")
    lines = checked.filter(~F.col(HEADER))
    totals = outcome.filter(F.col("reason").isNull()).agg(F.sum("quarantined").alias("bad")).first()
    if not aside.isEmpty():
        lines = lines.join(aside, "uri", "left_anti")
    good = typed(lines.filter(F.size(REASONS) == 0), feed.schema)
    batch_id = store.append_or_create(good, feed.name, batch_id, origin, above)
    if totals["bad"]:
        name = delivery_name(F.col("uri")).alias("file_name")
        bad = lines.filter(F.size(REASONS) > 0).select(*feed.schema.names, CORRUPT, REASONS, name)
        store.append_or_create(bad, quarantine_table(feed.name), batch_id)
    return batch_id


def with_source(df: DataFrame) -> DataFrame:
    """Lines with their file. What its name says is asked once per file, not of each line."""
    return df.select("*", F.col("_metadata.file_path").alias("uri"))


def _load_declared(store: Store, feed: Feed, files: DataFrame, paths: list[str], batch_id: int, archived: Column | None) -> None:
    text = with_source(read_feed_text(store.spark, paths, feed))
    # parsed once, then read by each of the writes
    with scratch_table(checked_rows(text, feed), "checked") as checked, scratch_table(file_outcomes(checked), "outcome") as outcome:
        write_checked(store, checked, outcome, feed, batch_id)
        note_outcome(store, files, outcome, archived)


# -- undeclared feeds --------------------------------------------------------------------------


def _by_header(store: Store, paths: dict[str, str]) -> dict[str, list[str]]:
    """URIs of files by their first line that is not blank."""
    lines = store.spark.read.text(list(paths.values())).select(
        "value", F.col("_metadata.file_path").alias("uri"), F.col("_metadata.file_block_start").alias("start")
    )
    lines = lines.filter((F.col("start") == 0) & (F.trim("value") != "")).withColumn("place", F.monotonically_increasing_id())
    heads = lines.groupBy("uri").agg(F.min_by("value", "place").alias("head")).collect()  # one row per file
    first = {r["uri"]: r["head"] for r in heads}
    groups: dict[str, list[str]] = defaultdict(list)
    for uri in paths:
        if uri in first:
            groups[first[uri]].append(uri)
    return groups


def _common_type(types: set[str]) -> str:
    if len(types) == 1:
        return next(iter(types))
    return max(types, key=NUMBERS.index) if types <= set(NUMBERS) else "string"


def _load_inferred(
    store: Store, name: str, files: DataFrame, paths: dict[str, str], batch_id: int, archived: Column | None
) -> None:
    """A feed nobody declared: types are inferred for its first batch and kept from then on.

    Columns go by name, so files may order them differently; those with other columns than the table, or than
    the first file if there is no table, are set aside. Rows with a value that its column cannot take go to quarantine.
    """
    frames, aside = [], []
    table = store.schema(name, before=batch_id)
    types = None if table is None else dict(table.dtypes)
    for uris in _by_header(store, paths).values():
        mine = [paths[uri] for uri in uris]
        # Types once known, values are read as text, as they stand in the file.
        df = read_feed(store.spark, mine) if types is None else store.spark.read.option("header", True).csv(mine)
        known = list(types or (frames[0].columns[:-1] if frames else df.columns))
        if set(df.columns) == set(known):
            frames.append(df.select(*known, F.col("_metadata.file_path").alias("uri")))
        else:
            aside += [(uri, 0, 0, OTHER_COLUMNS) for uri in uris]
    outcome = store.spark.createDataFrame(aside, "uri string, rows bigint, quarantined bigint, reason string")
    if not frames:
        note_outcome(store, files, outcome, archived)
        return
    if types is None:
        types = {c: _common_type({dict(df.dtypes)[c] for df in frames}) for c in known}
        frames = [df.select(*(F.col(c).cast(t).alias(c) for c, t in types.items()), "uri") for df in frames]
    schema = T.StructType.fromDDL(", ".join(f"`{c}` {t}" for c, t in types.items()))
    marked = with_reasons(reduce(DataFrame.unionByName, frames), type_rules(schema))
    with scratch_table(marked, "inferred") as lines:
        good, bad = lines.filter(F.size(REASONS) == 0), lines.filter(F.size(REASONS) > 0)
        counts = lines.groupBy("uri").agg(
            F.count_if(F.size(REASONS) == 0).alias("rows"), F.count_if(F.size(REASONS) > 0).alias("quarantined")
        )
        store.append_or_create(typed(good, schema), name, batch_id)
        if not bad.isEmpty():
            texts = bad.select(*(F.col(c).cast("string").alias(c) for c in types), REASONS, delivery_name(F.col("uri")).alias("file_name"))
            store.append_or_create(texts, quarantine_table(name), batch_id)
        outcome = counts.withColumn("reason", F.lit(None).cast("string")).unionByName(outcome)
        note_outcome(store, files, outcome, archived)


# -- runs --------------------------------------------------------------------------------------


def _load(store: Store, feeds: Mapping[str, Feed], name: str, batch_id: int, archived: Column | None) -> None:
    mine = (F.col("feed") == name) & (F.col("batch_id") == batch_id) & (F.col("status") == "started")
    files = ledger(store).filter(mine)
    paths = {r["uri"]: r["path"] for r in files.select("uri", "path", "file_name").orderBy("file_name", "path").collect()}
    if name in feeds:
        _load_declared(store, feeds[name], files, list(paths.values()), batch_id, archived)
    else:
        _load_inferred(store, name, files, paths, batch_id, archived)


def _lasting(error: Exception) -> bool:
    """Whether the same files would fail again."""
    return isinstance(error, SchemaMismatch)


def _fail(store: Store, name: str, batch_id: int, reason: str) -> None:
    mine = (F.col("feed") == name) & (F.col("batch_id") == batch_id) & (F.col("status") == "started")
    failed = ledger(store).filter(mine).withColumns(
        {"status": F.lit("failed"), "loaded_at": F.current_timestamp(), "reason": F.lit(reason)}
    )
    _note(store, failed)


def _archive(store: Store, listed: DataFrame, folder: str) -> None:
    """Move loaded files to the archive folder, also those that an earlier run left behind."""
    named = ledger(store).filter("status = 'loaded' AND archived_as IS NOT NULL").select(*DELIVERY, "archived_as")
    hadoop = store.spark._jvm.org.apache.hadoop.fs
    for f in listed.join(named, DELIVERY).select("path", "archived_as").collect():
        source, target = hadoop.Path(f["path"]), hadoop.Path(f"{folder}/{f['archived_as']}")
        fs = source.getFileSystem(store.spark._jsc.hadoopConfiguration())
        fs.mkdirs(target.getParent())
        if fs.exists(source) and not fs.rename(source, target):
            raise OSError(f"cannot archive {f['path']}")


def _is_one_of(batches: list[tuple[str, int]]) -> Column:
    return reduce(lambda a, b: a | b, ((F.col("feed") == n) & (F.col("batch_id") == i) for n, i in batches))


def ingest(
    store: Store,
    landing: str,
    feeds: Mapping[str, Feed] = FEEDS,
    max_files: int | None = None,
    archive: str | None = None,
) -> list[dict]:
    """Load all new files of the landing zone, one batch per feed, or more of `max_files` files each.

    Returns what became of each batch: feed, batch_id, status, and the number of files, rows and quarantined rows. An error
    that another run may not meet leaves its batch `started`, and is raised after the other feeds are done.
    """
    listed = landing_files(store.spark, landing).persist()
    try:
        _begin(store, listed, max_files)
        open_ = ledger(store).filter("status = 'started'").select("feed", "batch_id").distinct()
        batches = [(r["feed"], r["batch_id"]) for r in open_.orderBy("feed", "batch_id").collect()]
        errors, stopped = [], set()
        for name, batch_id in batches:
            if name in stopped:
                continue
            try:
                _load(store, feeds, name, batch_id, stamped_name() if archive else None)
            except ERRORS as error:
                if _lasting(error):
                    _fail(store, name, batch_id, str(error)[:1000])
                else:
                    errors.append(error)
                    stopped.add(name)
        if archive:
            _archive(store, listed, archive)
    finally:
        listed.unpersist()
    if errors:
        raise errors[0]
    if not batches:
        return []
    done = ledger(store).filter(_is_one_of(batches)).groupBy("feed", "batch_id", "status").agg(
        F.count(F.lit(1)).alias("files"), F.sum("rows").alias("rows"), F.sum("quarantined").alias("quarantined")
    )
    return [r.asDict() for r in done.orderBy("feed", "batch_id", "status").collect()]
