"""Prediction requests that wait (T2, J10): a request may come before its flight or the weather of its arrival.

Requests, flights and weather are three streams with event times (when each became known).  Two outer stream-stream joins
with time bounds keep a request in state until both have come; a request whose time is up leaves the state with nulls and
fails, once.  State is bounded by the watermark: a request is held for ``wait`` a join, a flight or a forecast for ``keep``
after it became known.  The joins run in the JVM and are keyed by (airport, minute).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from delaykit.plans.models import predict
from delaykit.plans.scoring import answers


def waiting_matches(requests: DataFrame, flights: DataFrame, weather: DataFrame, feature_cols: Sequence[str],
                    wait: str = "2 hours", keep: str = "7 days", late: str = "10 minutes",
                    req_time: str = "requested_at", known_at: str = "known_at") -> DataFrame:
    """Each request once, with ``has_flight``, ``has_weather`` and the features.

    ``requests`` (task_uuid, arrival_iata_code, scheduled_departure_local_time, ``req_time``), ``flights``
    (Arrival_AirportCode, Departure_ScheduledTimeLocal_DateTime, Arrival_ScheduledTimeUTC_DateTime, ``known_at``) and
    ``weather`` (Airport_Code, Flight_DateTime, features, ``known_at``) are streams.  A flight or a forecast counts if it
    became known at most ``keep`` before and ``wait`` after the request.  A request is matched in the micro-batch that completes
    it; without a flight it leaves once the watermark (the slowest stream's newest event less ``late``) is ``wait`` past it,
    with a flight but no weather once it is twice that.  A request with several matches takes the one joined first; rows
    behind the watermark are too late and left out.  After a restart the watermark moves on once all three streams have had new
    events."""
    def within(side: str):
        return ((F.col(side) >= F.col("__at") - F.expr(f"INTERVAL {keep}")) & (F.col(side) <= F.col("__at") + F.expr(f"INTERVAL {wait}")))

    r = requests.select("task_uuid", F.col("arrival_iata_code").alias("__code"), F.col("scheduled_departure_local_time").alias("__time"),
                        F.col(req_time).alias("__at")).withWatermark("__at", late)
    f = flights.select(F.col("Arrival_AirportCode").alias("__fc"), F.col("Departure_ScheduledTimeLocal_DateTime").alias("__ft"),
                       F.col("Arrival_ScheduledTimeUTC_DateTime").alias("__fa"), F.col(known_at).alias("__fk")).withWatermark("__fk", late)
    w = weather.select(F.col("Airport_Code").alias("__wc"), F.col("Flight_DateTime").alias("__wt"), *feature_cols,
                       F.col(known_at).alias("__wk")).withWatermark("__wk", late)
    found = (r.join(f, (F.col("__code") == F.col("__fc")) & (F.col("__time") == F.col("__ft")) & within("__fk"), "left")
             .select("task_uuid", "__at", "__fc", "__fa"))
    # A request without a flight has nothing to wait for here: the first condition lets it pass at once.
    both = (found.join(w, F.col("__fc").isNotNull() & (F.col("__fc") == F.col("__wc")) & (F.col("__fa") == F.col("__wt")) & within("__wk"), "left")
            .select("task_uuid", "__at", F.col("__fc").isNotNull().alias("has_flight"),
                    F.col("__wc").isNotNull().alias("has_weather"), *feature_cols))
    return both.dropDuplicatesWithinWatermark(["task_uuid"]).drop("__at")


def start_waiting_scoring(requests: DataFrame, flights: DataFrame, weather: DataFrame, model: PipelineModel,
                          feature_cols: Sequence[str], sink_path: str, checkpoint: str, available_now: bool = True,
                          **bounds: str) -> StreamingQuery:
    """Writes (task_uuid, state, prediction, message), one row for every request, as Parquet by micro-batch; see
    ``waiting_matches`` for the streams and ``bounds``.  A batch that is run again replaces its own ``batch_id`` folder."""
    def write_batch(batch: DataFrame, epoch: int) -> None:
        scored = predict(model, batch, feature_cols)
        answers(scored, F.col("has_flight"), F.col("has_weather")).write.mode("overwrite").parquet(f"{sink_path}/batch_id={epoch}")

    writer = (waiting_matches(requests, flights, weather, feature_cols, **bounds).writeStream.foreachBatch(write_batch)
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()
