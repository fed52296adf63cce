"""Small helpers shared by the corpus operators: table access, text columns, row keys and checked hints."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Non-ASCII characters that lower() would change.
_OTHER_UPPER = r"[\P{ASCII}&&[\p{IsUppercase}\p{Lt}]]"


BATCH_BYTES = 4 << 20


def prepare_workers(spark: SparkSession) -> None:
    """For Python workers: batches of texts of at most 4 MB (unless the session sets a size), as ten thousand long texts at a
    time would fill a worker's and the executor's memory; and workers on this machine find the package also when the
    session runs from another folder (a cluster gets it by ``--py-files`` or an installed wheel)."""
    limit = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(limit, None) is None:
        spark.conf.set(limit, str(BATCH_BYTES))
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])


def ascii_lower(text) -> Column:
    """Lower-case A-Z only; other letters and null stay as they are.

    ``lower`` does just that for texts without non-ASCII capitals and is many times faster than ``translate``."""
    text = F.col(text) if isinstance(text, str) else text
    return F.when(F.rlike(text, F.lit(_OTHER_UPPER)), F.translate(text, UPPER, LOWER)).otherwise(F.lower(text))


def crc_mod(id_col, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % n


def texts_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns an operator works on, as ``doc_id`` and ``text``; whatever else the
    input carries (clashing names included) is left behind."""
    return docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))


def row_key() -> Column:
    """Tells rows of one ``doc_id`` apart by their text (repeated rows share the key and all results)."""
    return F.xxhash64(F.col("text").isNull(), F.col("text"))


def broadcast_if_within(df: DataFrame, max_rows: int) -> DataFrame:
    """Broadcast hint behind a check of the size: a job counts at most ``max_rows + 1`` rows; a larger
    side gets no hint and is joined by a shuffle."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def broadcast_within(df: DataFrame, max_bytes: int) -> DataFrame | None:
    """``df`` with a broadcast hint if its values measured as text stay within ``max_bytes`` (rows count 16 bytes each),
    else nothing; one job adds up the lengths."""
    size = F.sum(F.lit(16) + sum((F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0)) for c in df.columns), F.lit(0)))
    return F.broadcast(df) if (df.agg(size).first()[0] or 0) <= max_bytes else None


def map_rows(df: DataFrame, fn: Callable[..., tuple], ddl: str) -> DataFrame:
    """``fn`` of the values of each row gives a row of ``ddl``; values stay exact (Arrow, long ids beside nulls too)."""
    schema = to_arrow_schema(StructType.fromDDL(ddl))

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            rows = [fn(*values) for values in zip(*(c.to_pylist() for c in part.columns))]
            columns = list(zip(*rows)) if rows else [()] * len(schema)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return df.mapInArrow(batches, ddl)
