"""Appending only new rows to a large target (J3, S10) by a ledger of row hashes.

``append_new_rows`` compares whole rows with the whole target at each append.  A ledger keeps one 128-bit hash of every row
of the target, in a table partitioned by day and bucketed by the hash: a batch is hashed, dealt to the same buckets and
anti-joined bucket by bucket, so the stored side is never shuffled, is read at 40 bytes a row whatever the target's width,
and only in the days that the batch has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from delaykit.session import materialize
from delaykit.sources.sinks import append_rows, read_target, table_exists

BUCKETS = 64  # of a ledger that is created
ROWS_A_BUCKET = 1 << 22  # of a batch or of the ledger; more rows double the buckets


def row_hash(df: DataFrame) -> Column:
    """128-bit hash of a row, equal for equal rows (NULL equals NULL, NaN equals NaN, 0.0 equals -0.0), as 32 hex digits.

    Collisions need about 2^64 rows."""
    values: list[Column] = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DoubleType | T.FloatType):
            c = c + F.lit(0.0).cast(f.dataType)
        elif isinstance(f.dataType, T.VariantType | T.MapType):
            c = F.to_json(c if isinstance(f.dataType, T.VariantType) else F.map_from_entries(F.array_sort(F.map_entries(c))))
        values += [c.isNull(), c]
    return F.concat(*[F.lpad(F.lower(F.hex(F.xxhash64(F.lit(salt), *values))), 16, "0") for salt in ("first", "second")])


def _day(day: str | Column | None) -> Column:
    return F.lit("all") if day is None else F.coalesce((F.col(day) if isinstance(day, str) else day).cast("string"), F.lit("none"))


def _hashed(df: DataFrame, day) -> DataFrame:
    return df.select(row_hash(df).alias("__hash"), _day(day).alias("__day"), *df.columns)


class Ledger:
    """The ledger of one target: a catalog table ``name``, stored at ``path`` if given.

    ``buckets`` is what it starts with: a task reads a bucket of the batch and of the ledger, so when either holds more than
    ``ROWS_A_BUCKET`` rows a bucket, ``append`` doubles the buckets and writes the ledger anew, which happens seldom enough
    to cost each stored row a bounded number of times.

    ``day``: a column of the target that rows are partitioned by in the ledger (a date, or text that starts with one);
    equal rows have equal days, so only a batch's days are read."""

    def __init__(self, spark: SparkSession, name: str, target: str, day: str | Column | None = None, buckets: int = BUCKETS,
                 path: str | None = None):
        self.spark, self.name, self.target, self.day, self.buckets, self.path = spark, name, target, day, buckets, path

    def _add(self, rows: DataFrame) -> None:
        """Hashes of rows and how many rows have each, one file a bucket and day of this append."""
        counted = rows.groupBy(F.col("__hash").alias("row_hash"), F.col("__day").alias("day")).agg(F.count(F.lit(1)).alias("n"))
        writer = (counted.repartition(self.buckets, "row_hash").write.partitionBy("day").bucketBy(self.buckets, "row_hash")
                         .sortBy("row_hash").mode("append").format("parquet"))
        if self.path:
            writer = writer.option("path", self.path)
        writer.saveAsTable(self.name)

    def rows(self) -> DataFrame:
        return self.spark.table(self.name)

    def n_rows(self) -> int:
        """Rows of the target that the ledger counts."""
        return self.rows().agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0] if self.spark.catalog.tableExists(self.name) else 0

    def matches_target(self) -> bool:
        """Whether the ledger counts as many rows as the target has (read from file footers), as it does unless a run died
        between its two writes."""
        return self.n_rows() == (read_target(self.spark, self.target).count() if table_exists(self.spark, self.target) else 0)

    def stored_buckets(self) -> int | None:
        """Buckets of the stored ledger."""
        if not self.spark.catalog.tableExists(self.name):
            return None
        about = self.spark.sql(f"DESCRIBE EXTENDED {self.name}").filter("col_name = 'Num Buckets'").first()
        return int(about.data_type)

    def make_room(self, batch: int) -> None:
        """Buckets enough for a batch of so many rows and for the rows stored."""
        stored = self.stored_buckets()
        self.buckets = stored or self.buckets
        rows = max(batch, self.n_rows())
        while rows > self.buckets * ROWS_A_BUCKET:
            self.buckets *= 2
        if stored not in (None, self.buckets):
            self.rebuild()

    def rebuild(self) -> None:
        """The ledger anew from the whole target."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        if self.path:
            location = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
            location.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(location, True)
        if table_exists(self.spark, self.target):
            self._add(_hashed(read_target(self.spark, self.target), self.day))

    def new_rows(self, df: DataFrame, days: list[str] | None = None) -> DataFrame:
        """Rows of ``df`` that the target doesn't hold, with ``__hash`` and ``__day``; equal rows inside ``df`` stay together
        (J3).  ``days``: the days that ``df`` has, to read only those of the ledger."""
        batch = _hashed(df, self.day).repartition(self.buckets, "__hash")
        if not self.spark.catalog.tableExists(self.name):
            return batch
        stored = self.rows().select("row_hash", "day")
        if days is not None:
            stored = stored.filter(F.col("day").isin(days)) if days else stored.limit(0)
        # The merge join keeps the stored buckets where they are; a broadcast of the ledger would grow with the target.
        return batch.join(stored.select("row_hash").hint("merge"), F.col("__hash") == F.col("row_hash"), "left_anti")

    def append(self, df: DataFrame) -> DataFrame:
        """Append the rows of ``df`` that the target doesn't hold, and their hashes; returns them.

        The ledger is rebuilt first if a run before died between the two writes (see ``matches_target``).  Columns must be
        the target's, in its order."""
        if table_exists(self.spark, self.target) and read_target(self.spark, self.target).columns != df.columns:
            raise ValueError(f"columns {df.columns} aren't those of the target")
        if not self.matches_target():
            self.rebuild()
        sizes = dict(df.groupBy(_day(self.day).alias("day")).count().collect())  # the batch's days
        days = list(sizes) if self.day is not None else None
        self.make_room(sum(sizes.values()))
        fresh = materialize(self.new_rows(df, days), "ledger-new")
        append_rows(fresh.drop("__hash", "__day"), self.target)
        self._add(fresh)
        return fresh.drop("__hash", "__day")
