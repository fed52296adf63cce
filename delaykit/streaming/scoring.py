"""Continuous delay scoring of a request stream (T2): every micro-batch is joined
with the first-flight and weather tables of the moment, then scored."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from delaykit import schemas
from delaykit.plans.scoring import score_requests


def request_stream(spark: SparkSession, folder: str) -> DataFrame:
    return spark.readStream.schema(schemas.REQUESTS).json(folder)


def start_scoring(spark: SparkSession, folder: str, flights_first: DataFrame | Callable[[], DataFrame],
                  weather: DataFrame | Callable[[], DataFrame], model: PipelineModel, feature_cols: Sequence[str],
                  sink_path: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Score each request once and write (task_uuid, state, prediction, message) as Parquet, by micro-batch.

    ``flights_first`` and ``weather`` may be functions: they are called for every micro-batch, so a long-running query
    sees what was appended to the tables since.  A batch that is run again replaces its own ``batch_id`` folder."""
    def now(table):
        return table() if callable(table) else table

    def write_batch(batch: DataFrame, epoch: int) -> None:
        scored = score_requests(batch, now(flights_first), now(weather), model, feature_cols)
        scored.write.mode("overwrite").parquet(f"{sink_path}/batch_id={epoch}")

    writer = (request_stream(spark, folder).writeStream.foreachBatch(write_batch)
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()
