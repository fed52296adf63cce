"""File and table scans."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from delaykit import schemas
from delaykit.functions.text import name_filter

# Data stage -> folder name.
STAGES = {"raw": "1_raw", "interim": "2_interim", "processed": "3_processed", "external": "4_external"}


def stage_path(base_uri: str, stage: str, folder: str = "", file_name: str = "") -> str:
    """``{base}/{1_raw|2_interim|3_processed|4_external}/{folder}/{file}``.

    ``base_uri`` may be an object-store URI; an unknown stage is a ``ValueError``.
    """
    if stage not in STAGES:
        raise ValueError(f"unknown data stage {stage!r}; expected one of {list(STAGES)}")
    parts = [base_uri.rstrip("/"), STAGES[stage]] + [p.strip("/") for p in (folder, file_name) if p]
    return "/".join(parts)


def read_landing(spark: SparkSession, path: str, api_name: str = "flightstatus",
                 flight_as_text: bool = False, glob: str | None = "*.json") -> DataFrame:
    """Landed API files (S1): pretty-printed JSON, one document per file.

    An explicit schema (no inference pass).  A malformed file yields a row with
    ``_corrupt_record`` set instead of failing the job (``unreadable`` lists
    them).  ``file_path`` identifies a file, ``file_name`` is its last part.
    """
    schema = schemas.landing_file(api_name, flight_as_text).add("_corrupt_record", T.StringType())
    reader = (spark.read.schema(schema).option("multiLine", True)
                   .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record"))
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    df = reader.json(path)
    return with_file(df)


def document_schema() -> T.StructType:
    """A landed file with its pages and metadata as JSON text, so that no leaf is lost to a schema."""
    return T.StructType.fromDDL("metadata string, data array<string>, _corrupt_record string")


def read_documents(spark: SparkSession, path: str, glob: str | None = "*.json") -> DataFrame:
    """Landed API files (S1) with every page kept as text, whatever leaves it has; see ``operators.documents``.

    Like ``read_landing``, a file that can't be read has ``_corrupt_record``."""
    reader = (spark.read.schema(document_schema()).option("multiLine", True)
                   .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record"))
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return with_file(reader.json(path))


def unreadable_pages(pages: DataFrame) -> DataFrame:
    """(file_path, reason, record) of the pages of ``operators.documents.pages_of_documents`` that aren't JSON or lack the
    container (a NULL page in the file's list included): the record is the page's text."""
    return pages.filter("page IS NULL").select("file_path", F.concat(F.lit("page "), "page_pos").alias("reason"),
                                               F.col("page_text").alias("record"))


def with_file(df: DataFrame) -> DataFrame:
    return df.withColumn("file_path", F.col("_metadata.file_path")).withColumn("file_name", F.col("_metadata.file_name"))


def readable(landing: DataFrame) -> DataFrame:
    """Landed files whose pages could be read (in part, where a leaf didn't fit its type)."""
    return landing.filter(F.col("data").isNotNull())


def unreadable(landing: DataFrame) -> DataFrame:
    """(file_path, reason, record): every file that lost something — ``unreadable`` (nothing could be read),
    ``partly read`` (a node didn't fit the schema) or ``no data`` — for the quarantine table."""
    reason = (F.when(F.col("data").isNull() & F.col("_corrupt_record").isNotNull(), F.lit("unreadable"))
               .when(F.col("data").isNull(), F.lit("no data"))
               .when(F.col("_corrupt_record").isNotNull(), F.lit("partly read")))
    return landing.select("file_path", reason.alias("reason"), F.col("_corrupt_record").alias("record")).filter("reason IS NOT NULL")


def read_csv_by_name(spark: SparkSession, paths: Sequence[str], schema: T.StructType | str | None = None) -> DataFrame:
    """Header CSV files that may differ in columns and their order (S2, S17): every file is read with its own header
    and the files are united by column name; a column a file lacks is NULL there.

    Headers are found by one distributed pass; the driver holds the distinct headers and the file paths.  With a
    ``schema`` its columns are taken, cast to their types."""
    lines = spark.read.text(list(paths)).select(F.col("_metadata.file_path").alias("path"), "value",
                                                F.monotonically_increasing_id().alias("at"))
    heads = lines.groupBy("path").agg(F.min_by("value", "at").alias("head"))
    groups: dict[str, list[str]] = {}
    for r in heads.collect():
        groups.setdefault(r["head"].lstrip("\ufeff"), []).append(r.path)
    parts = [spark.read.option("header", True).option("nullValue", "").csv(sorted(files)) for _, files in sorted(groups.items())]
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    if not parts:
        return spark.createDataFrame([], schema or T.StructType())
    df = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    if schema is not None:
        df = df.select(*[(F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                         for f in schema.fields])
    return df


def parse_json_text(col, ddl: str) -> Column:
    """JSON held in a text column (S1 for JSON-in-string such as aircraft names)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.from_json(c, ddl, {"mode": "PERMISSIVE"})


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
             infer: bool = False) -> DataFrame:
    """Header CSV (S2).  ``NA`` stays text (it is an airport code); only the empty
    field is NULL."""
    reader = spark.read.option("header", True).option("nullValue", "")
    if schema is not None:
        reader = reader.schema(schema)
    elif infer:
        reader = reader.option("inferSchema", True)
    return reader.csv(path)


def read_table(spark: SparkSession, name_or_path: str) -> DataFrame:
    """Whole table (S3): a catalog table name, or a Parquet path."""
    return spark.read.parquet(name_or_path) if "/" in name_or_path else spark.table(name_or_path)


def list_files(spark: SparkSession, folder: str, contains: str | None = None,
               excludes: str | None = None, suffix: str | None = None) -> DataFrame:
    """Files (not folders) of a folder, filtered by name.

    ``binaryFile`` lists without reading content when only path columns are
    selected; non-recursive like a directory listing.
    """
    listing = (spark.read.format("binaryFile").option("recursiveFileLookup", False).load(folder)
                    .select("path", "length", "modificationTime"))
    name = F.element_at(F.split(F.col("path"), "/"), -1)
    return listing.withColumn("file_name", name).filter(name_filter(name, contains, excludes, suffix))
