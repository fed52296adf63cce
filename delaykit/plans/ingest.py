"""Day ingest: landed pages -> flights table -> CSV / tables.

``landing -> pages -> flights -> flat`` is one lazy plan; every output is a
projection of it, written by distributed tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from delaykit import schemas
from delaykit.operators.incremental import insert_if_absent
from delaykit.operators.documents import (KNOWN_FLIGHT_PATHS, document_flights, flatten_documents, materialized_flights,
                                          pages_of_documents, variant_path)
from delaykit.operators.nested import collect_nested, flatten, flights_of, infer_flight, pages_of, repair_lone_flight
from delaykit.plans.counts import RunCounts
from delaykit.session import materialize
from delaykit.sources.files import list_files, read_csv_by_name, read_documents, read_landing, readable, unreadable, unreadable_pages
from delaykit.sources.sinks import append_new_rows, append_rows, quarantine, read_target, table_exists, write_csv, write_json

FILE = ["file_path", "file_name"]


def landed_flights(spark: SparkSession, path: str, api_name: str = "flightstatus",
                   repair_lone_objects: bool = True, all_leaves: bool = False) -> DataFrame:
    """One row per flight of the landed files, with (file, page, position) kept.

    With ``repair_lone_objects`` the ``Flight`` and ``Link`` nodes are read as text and a lone
    object is wrapped into an array (reading it as an array would lose the file).  With
    ``all_leaves`` flights keep every leaf that occurs, not only the known ones.  Files that
    can't be read are listed by ``sources.files.unreadable``; the jobs store them.
    """
    landing = readable(read_landing(spark, path, api_name, flight_as_text=repair_lone_objects))
    return _flights(landing, api_name, repair_lone_objects, all_leaves)


def _flights(landing: DataFrame, api_name: str, repair_lone_objects: bool = True, all_leaves: bool = False) -> DataFrame:
    pages = pages_of(landing, api_name, keep=[*FILE, "metadata"])
    element = infer_flight(pages) if all_leaves and repair_lone_objects else None
    arr = repair_lone_flight(pages, element=element) if repair_lone_objects else None
    return flights_of(pages, keep=[*FILE, "metadata", "page_pos"], flights=arr)


def flat_flights(flights: DataFrame) -> DataFrame:
    """Flatten every flight leaf to ``Part_Sub_Leaf`` columns (N2), position keys kept."""
    leaf_cols = flatten(flights.select("flight"), "flight").columns
    flat = flatten(flights.select(*FILE, "page_pos", "flight_pos", "flight"))
    # ``flatten`` of the whole row names leaves ``flight_<path>``; drop the prefix.
    renamed = [F.col(f"flight_{c}").alias(c) for c in leaf_cols]
    return flat.select(*FILE, "page_pos", "flight_pos", *renamed)


def flights_table(flat: DataFrame) -> DataFrame:
    """The five columns the ``flights`` table keeps."""
    return flat.select(*schemas.FLIGHT_TABLE_COLUMNS)


def consolidated(flights: DataFrame, files: DataFrame | None = None) -> DataFrame:
    """Per landed file: ``{metadata, flights: [..]}`` in landed order.

    ``files`` (file_path, file_name, metadata) adds the files that hold no flight, with an empty array."""
    pos = F.struct("page_pos", "flight_pos")
    nested = collect_nested(flights.withColumn("__pos", pos), FILE, "__pos", ["flight"], "flights").select(
        F.col("file_path").alias("__path"), F.transform("flights", lambda x: x["flight"]).alias("flights"))
    if files is None:
        files = flights.select(*FILE, "metadata")
    meta = files.groupBy(*FILE).agg(F.first("metadata", ignorenulls=True).alias("metadata"))
    none = F.array().cast(nested.schema["flights"].dataType)
    return (meta.join(nested, F.col("file_path") == F.col("__path"), "left")
                .select(*FILE, "metadata", F.coalesce("flights", none).alias("flights")))


def flat_documents(flights: DataFrame) -> DataFrame:
    """``flat_flights`` of flights kept as VARIANT: the known leaves, then every other leaf that occurs."""
    return flatten_documents(flights, "flight", [*FILE, "page_pos", "flight_pos"], KNOWN_FLIGHT_PATHS)


def consolidated_documents(flights: DataFrame, files: DataFrame) -> DataFrame:
    """Per landed file ``{metadata, flights: [..]}`` in landed order (N3), metadata and flights with all their leaves.

    ``files``: (file_path, file_name, metadata); files without a flight have an empty array."""
    texts = flights.select(*FILE, F.struct("page_pos", "flight_pos").alias("__pos"), F.to_json("flight").alias("flight"))
    nested = collect_nested(texts, FILE, "__pos", ["flight"], "flights").select(
        F.col("file_path").alias("__path"), F.transform("flights", lambda x: F.parse_json(x["flight"])).alias("flights"))
    meta = files.select(*FILE, F.try_parse_json("metadata").alias("metadata"))
    return (meta.join(nested, F.col("file_path") == F.col("__path"), "left")
                .select(*FILE, "metadata", F.coalesce("flights", F.array().cast("array<variant>")).alias("flights")))


def day_download(spark: SparkSession, landing_path: str, out_base: str, api_name: str = "flightstatus") -> DataFrame:
    """Raw landed JSON -> consolidated JSON and flat CSV, both partitioned by day (S18), with every leaf that occurs.

    A run replaces the days it holds and leaves the others alone.  A file's day is the date its range starts on, or
    that of its earliest flight.  Files and pages that can't be read are appended to ``{out_base}/quarantine``."""
    landing = read_documents(spark, landing_path)
    good = readable(landing)
    pages = pages_of_documents(good, api_name, keep=FILE)
    quarantine(unreadable(landing).unionByName(unreadable_pages(pages)), f"{out_base}/quarantine")
    fl = materialized_flights(pages, [*FILE, "page_pos"])
    docs = consolidated_documents(fl, good.select(*FILE, "metadata"))
    first = F.array_min(F.transform("flights", lambda x: F.try_variant_get(x, "$.Departure.ScheduledTimeLocal.DateTime", "string")))
    start = F.try_variant_get("metadata", "$.start_range", "string")
    day = F.coalesce(F.substring(start, 1, 10), F.substring(first, 1, 10), F.lit("unknown"))
    write_json(docs.withColumn("day", day), f"{out_base}/consolidated", partition_by=["day"])
    flat = flat_documents(fl).withColumn("flight_date", F.substring("Departure_ScheduledTimeLocal_DateTime", 1, 10))
    # Rows of a day come together (a large day in several parts), so a day is a few files, not one a task.
    write_csv(flat.hint("rebalance", "flight_date"), f"{out_base}/flat", partition_by=["flight_date"])
    return flat


def raw_pages(landing: DataFrame, api_name: str = "flightstatus") -> DataFrame:
    """Pages of landed documents as the page store keeps them: ``page`` (VARIANT) and its canonical text ``page_json``
    (names in order), by which pages are compared."""
    pages = pages_of_documents(landing, api_name, keep=FILE).filter("page IS NOT NULL")
    return pages.select(*FILE, "page_pos", "page", F.to_json("page").alias("page_json"))


def store_raw_pages(spark: SparkSession, landing_path: str, target: str, api_name: str = "flightstatus",
                    quarantine_target: str | None = None, glob: str | None = "*.json", counts: RunCounts | None = None) -> DataFrame:
    """Raw pages into the page store when not already there (E1 stage 1, J6 + D4), as whole documents.

    Pages are compared by a content hash of their canonical JSON; the store keeps the hash and the page as VARIANT.  Files
    and pages that can't be read are appended to ``quarantine_target`` (default: the target's name with ``_quarantine``).
    ``counts`` collects files and pages read, unreadable and added, in the jobs that run anyway.
    """
    landing = read_documents(spark, landing_path, glob)
    good = readable(landing)
    pages = pages_of_documents(good, api_name, keep=FILE)
    files = unreadable(landing if counts is None else counts.watch(landing, "files", unreadable=F.col("data").isNull()))
    watched = pages if counts is None else counts.watch(pages, "pages", unreadable=F.col("page").isNull())
    quarantine(files.unionByName(unreadable_pages(watched)), quarantine_target or f"{target}_quarantine")
    if table_exists(spark, target):
        stored = read_target(spark, target).select("content_hash")
    else:
        stored = spark.createDataFrame([], "content_hash string")
    fresh = insert_if_absent(raw_pages(good, api_name), stored, ["file_path", "page_pos"], ["page_json"])
    fresh = fresh.select("content_hash", "page")
    # Written first: the store is read before it is written to.
    fresh = materialize(fresh if counts is None else counts.watch(fresh, "added"), "fresh-pages")
    append_rows(fresh, target)
    return fresh


def bulk_load_csv(spark: SparkSession, folder: str, target: str, schema=None) -> DataFrame:
    """All interim CSV files of a folder (``OLD`` files skipped), each read by its own header and united by column
    name, appended new-rows-only into ``target`` (S17)."""
    files = list_files(spark, folder, excludes="OLD", suffix=".csv").select("path")
    df = read_csv_by_name(spark, [r.path for r in files.collect()], schema)  # a directory listing
    return append_new_rows(spark, df, target)


def bulk_load_tables(spark: SparkSession, folders: dict[str, str], schemas_by_target: dict | None = None) -> dict[str, DataFrame]:
    """``bulk_load_csv`` for several (target, folder) pairs: the airports, flights and weather tables."""
    return {t: bulk_load_csv(spark, folder, t, (schemas_by_target or {}).get(t)) for t, folder in folders.items()}


def flights_from_page_store(spark: SparkSession, store: str, all_columns: bool = False,
                            page_leaves: dict[str, tuple] | None = None) -> DataFrame:
    """E1 stage 2: every stored page (a whole-collection scan, S4) unnested and
    flattened; the ``flights`` table columns (ready for ``append_new_rows``), or
    every leaf of the stored flights with ``all_columns``.  ``page_leaves`` adds
    leaves of the page itself, by name."""
    page_leaves = page_leaves or {}
    pages = read_target(spark, store).select("page", *[
        F.try_variant_get("page", variant_path(p), "string").alias(name) for name, p in page_leaves.items()])
    fl = document_flights(pages, keep=list(page_leaves))
    flat = flatten_documents(fl, "flight", list(page_leaves), KNOWN_FLIGHT_PATHS, paths=None if all_columns else [])
    return flat if all_columns else flat.select(*schemas.FLIGHT_TABLE_COLUMNS, *page_leaves)
