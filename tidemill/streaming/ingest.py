"""Ingest of one feed as a stream of dropped files."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemill.functions import delivery_name, feed_name
from tidemill.session import scratch_table
from tidemill.sources.feeds import Feed, read_feed_text
from tidemill.sources.ingest import DELIVERY, checked_rows, file_outcomes, ledger, note_outcome, with_source, write_checked
from tidemill.sources.store import Store

POLL = "5 minutes"
# Columns of Spark's source of whole files.
FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"
# Characters by which a path would be taken for a pattern.
GLOB = re.compile(r"[{}\[\]*?\\]")


def feed_stream(
    store: Store, landing: str, feed: Feed, max_files: int | None = None, archive: str | None = None
) -> DataFrame:
    """The feed's files with their place, time and size; what is in them is left unread.

    The file source tracks the files it has passed on in the checkpoint. With `archive`, a folder outside
    the landing zone, it moves files there in the course of later batches.
    """
    reader = store.spark.readStream.format("binaryFile").schema(FILE_SCHEMA).options(**feed.options)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return with_source(reader.load(f"{landing}/{feed.glob}")).select(
        F.col("path").alias("place"),
        "uri",
        F.col("_metadata.file_modification_time").alias("modified_at"),
        F.col("_metadata.file_size").alias("bytes"),
    )


def checkpoint_id(store: Store, checkpoint: str) -> str:
    """The identity that Spark gave the stream when it began with this checkpoint."""
    return store.spark.read.text(f"{checkpoint}/metadata").select(F.get_json_object("value", "$.id")).first()[0]


def checked_files(listed: DataFrame) -> DataFrame:
    """One row per file, with what its name says."""
    uri = F.col("uri")
    return listed.select("uri", "modified_at", "bytes").distinct().select(
        uri.alias("path"), "uri", delivery_name(uri).alias("file_name"), feed_name(uri).alias("feed"), "modified_at", "bytes"
    )


def files_to_load(store: Store, files: DataFrame, batch_id: int | None) -> DataFrame:
    """Files that no other batch has taken."""
    known = ledger(store)
    if batch_id is not None:
        known = known.filter(F.col("batch_id") != batch_id)
    return files.join(known.select(*DELIVERY), DELIVERY, "left_anti")


def lines_of(store: Store, feed: Feed, listed: DataFrame, files: DataFrame) -> DataFrame:
    """Lines of the listed files that are among `files`; no other file is opened.

    The driver holds the paths of one micro-batch, which `max_files` bounds.
    """
    wanted = listed.join(files.select("uri"), "uri", "left_semi").select("place").distinct().orderBy("place")
    paths = [GLOB.sub(r"\\\g<0>", r["place"]) for r in wanted.collect()]
    if not paths:
        return store.spark.createDataFrame([], feed.text_schema).withColumn("uri", F.lit(None).cast("string"))
    return with_source(read_feed_text(store.spark, paths, feed))


def stream_ingest(
    store: Store,
    landing: str,
    feed: Feed,
    checkpoint: str,
    every: str | None = POLL,
    on_batch: Callable[[Store, int], None] | None = None,
    max_files: int | None = None,
    archive: str | None = None,
) -> StreamingQuery:
    """Append each micro-batch to the feed's raw table, then call `on_batch` (mart refresh, tests).

    `every` is the polling interval; None takes what is there and stops, for a scheduled job. A micro-batch is known by
    its checkpoint and epoch. It gets the next free number of the table once, which the table's log keeps, so other
    streams and the batch ingest can fill the same table, and a micro-batch that is run again after a failure
    replaces its own rows only. What became of each file is in the ledger; a file without the declared header, and
    one that another batch has taken, adds no rows and stops nothing.
    """

    def write(df: DataFrame, epoch: int) -> None:
        origin = f"{checkpoint_id(store, checkpoint)}/{epoch}"
        mine = store.batch_of(feed.name, origin)
        # Whose files these are is settled first; only lines that are to be loaded are parsed, once, then read by each of the writes.
        with (
            scratch_table(files_to_load(store, checked_files(df), mine), "files") as files,
            scratch_table(checked_rows(lines_of(store, feed, df, files), feed), "checked") as checked,
            scratch_table(file_outcomes(checked), "outcome") as outcome,
        ):
            last = ledger(store).filter(F.col("feed") == feed.name).agg(F.max("batch_id")).first()[0]
            batch_id = write_checked(store, checked, outcome, feed, mine, origin, last)
            lined = files.join(outcome.select("uri"), "uri", "left_semi")
            numbered = lined.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
            # The file source keeps the whole path below its archive folder.
            place = F.regexp_replace("uri", r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?/", "") if archive else None
            note_outcome(store, numbered, outcome, place)
        if on_batch:
            on_batch(store, epoch)

    writer = feed_stream(store, landing, feed, max_files, archive).writeStream.foreachBatch(write)
    writer = writer.option("checkpointLocation", checkpoint)
    trigger = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return trigger.start()
