"""Incremental ingest of landed API files.

The file source's checkpoint remembers which files were processed, so each
run picks up only new drops ("only files not done yet"); inside every
micro-batch the flights are appended new-rows-only (J3), so a file landed
twice adds nothing.  ``trigger(availableNow=True)`` processes the backlog and
stops, the shape of the reference's cron jobs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pyspark.sql import types as T

from delaykit import schemas
from delaykit.operators.documents import pages_of_documents
from delaykit.operators.incremental import content_hash, early_stop_across_files
from delaykit.operators.nested import flights_of, pages_of, repair_lone_flight
from delaykit.plans.ingest import FILE, flat_flights, flights_table, raw_pages
from delaykit.session import materialize
from delaykit.sources.files import document_schema, readable, unreadable, unreadable_pages, with_file
from delaykit.sources.sinks import append_new_rows, append_rows, quarantine, read_target, table_exists


def landed_stream(spark: SparkSession, folder: str, api_name: str = "flightstatus",
                  max_files_per_trigger: int | None = None) -> DataFrame:
    schema = schemas.landing_file(api_name, flight_as_text=True).add("_corrupt_record", T.StringType())
    reader = (spark.readStream.schema(schema).option("multiLine", True).option("mode", "PERMISSIVE")
                   .option("columnNameOfCorruptRecord", "_corrupt_record").option("pathGlobFilter", "*.json"))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return with_file(reader.json(folder))


def stream_flights(landing: DataFrame, api_name: str = "flightstatus") -> DataFrame:
    pages = pages_of(landing, api_name, keep=[*FILE, "metadata"])
    fl = flights_of(pages, keep=[*FILE, "metadata", "page_pos"], flights=repair_lone_flight(pages))
    return flights_table(flat_flights(fl))


def start_ingest(spark: SparkSession, folder: str, target: str, checkpoint: str,
                 api_name: str = "flightstatus", available_now: bool = True,
                 quarantine_target: str | None = None) -> StreamingQuery:
    """Start the ingest; ``checkpoint`` must be on shared storage.

    A file that can't be read (truncated, malformed) would never be seen again, since the checkpoint marks it
    done: its path and text go to ``quarantine_target`` (default: the target's name with ``_quarantine``)."""
    landing = landed_stream(spark, folder, api_name)

    def write_batch(batch: DataFrame, _epoch: int) -> None:
        quarantine(unreadable(batch), quarantine_target or f"{target}_quarantine")
        append_new_rows(spark, stream_flights(readable(batch), api_name), target)

    writer = landing.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def documents_stream(spark: SparkSession, folder: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Landed files as they arrive, pages and metadata as text (``sources.files.read_documents``), and when they arrived."""
    reader = (spark.readStream.schema(document_schema()).option("multiLine", True).option("mode", "PERMISSIVE")
                   .option("columnNameOfCorruptRecord", "_corrupt_record").option("pathGlobFilter", "*.json"))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    arrived = F.date_format("_metadata.file_modification_time", "yyyyMMddHHmmssSSS")
    return with_file(reader.json(folder)).withColumn("arrived", F.concat_ws(" ", arrived, "file_path"))


def start_page_store_ingest(spark: SparkSession, folder: str, store: str, checkpoint: str,
                            api_name: str = "flightstatus", max_hits: int = 5,
                            force_test_all: bool = False, quarantine_target: str | None = None,
                            max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Raw pages into the page store with the per-file early stop (D5, E1 stage 1).

    A micro-batch takes the whole backlog (or ``max_files_per_trigger`` files) at once, in arrival order: time, then path.
    A file sees every page that earlier files inserted, in the batch or before it — the sequential semantics of the
    find-then-insert loop — by ``operators.incremental.early_stop_across_files``, so the stored hashes are read once a
    batch, not once a file.  The store holds (content_hash, page, file_path, file_name, page_pos, batch_id), pages as
    VARIANT with all their leaves; files and pages that can't be read go to the quarantine table.  A batch that is
    repeated after a failure takes out nothing twice: rows it had already written count as not yet stored and are not
    written again.
    """
    landing = documents_stream(spark, folder, max_files_per_trigger)

    def write_batch(batch: DataFrame, epoch: int) -> None:
        good = readable(batch)
        lost = unreadable_pages(pages_of_documents(good, api_name, keep=FILE))
        quarantine(unreadable(batch).unionByName(lost), quarantine_target or f"{store}_quarantine")
        arrived = batch.select(F.col("file_path").alias("__path"), "arrived")
        pages = raw_pages(good, api_name)
        docs = materialize(pages.join(arrived, pages["file_path"] == arrived["__path"]).drop("__path"), "pages")
        if table_exists(spark, store):
            rows = read_target(spark, store)
            stored, mine = rows.filter(F.col("batch_id") != epoch), rows.filter(F.col("batch_id") == epoch)
        else:
            stored = mine = None
        known = spark.createDataFrame([], "content_hash string") if stored is None else stored.select("content_hash")
        flags = early_stop_across_files(docs.select("arrived", "page_pos", "page_json"), known, "arrived", "page_pos",
                                        ["page_json"], max_hits, force_test_all).filter("inserted").select("arrived", "page_pos")
        new = docs.join(flags, ["arrived", "page_pos"], "left_semi").select(
            content_hash(docs, ["page_json"]).alias("content_hash"), "page", *FILE, "page_pos", F.lit(epoch).cast("long").alias("batch_id"))
        if mine is not None:
            new = new.join(mine.select("file_path", "page_pos"), ["file_path", "page_pos"], "left_anti").select(*new.columns)
        append_rows(materialize(new, "new-pages"), store)

    return (landing.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
                .trigger(availableNow=True).start())
