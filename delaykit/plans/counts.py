"""Row counts of a run without another pass (A12, Q1-Q4): metrics that Spark collects while it writes (``observe``)."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from delaykit.sources.sinks import append_rows

SCHEMA = "run_id string, at timestamp, job string, step string, metric string, value long"


class RunCounts:
    """Counts of one run of a job.  ``watch`` attaches them to a step's rows; the first write or count that reads those
    rows whole fills them in, and ``store`` appends them to a table.

    A step must be read whole by one action: a limit, or a filter that Spark can push below the step, would count less."""

    def __init__(self, job: str, run_id: str | None = None):
        self.job, self.run_id = job, run_id or uuid.uuid4().hex
        self._watched: list[tuple[str, Observation]] = []

    def watch(self, df: DataFrame, step: str, **metrics: Column) -> DataFrame:
        """``df`` unchanged; counts its rows and, by name, the rows for which a condition holds."""
        seen = Observation(f"{self.job}-{step}-{uuid.uuid4().hex}")
        self._watched.append((step, seen))
        conditions = [F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in metrics.items()]
        return df.observe(seen, F.count(F.lit(1)).alias("rows"), *conditions)

    def values(self) -> dict[tuple[str, str], int]:
        """{(step, metric): count}; call it after the steps have been written."""
        return {(step, name): int(n) for step, seen in self._watched for name, n in seen.get.items()}

    def store(self, spark: SparkSession, target: str) -> DataFrame:
        now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        rows = [(self.run_id, now, self.job, step, metric, n) for (step, metric), n in self.values().items()]
        df = spark.createDataFrame(rows, SCHEMA)  # one row a metric
        append_rows(df, target)
        return df
