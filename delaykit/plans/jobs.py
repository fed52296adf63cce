"""End-to-end jobs, one per stage of the application's lifecycle:
airports dimension, raw pages -> flights table, weather requests, training,
prediction.  Each composes the plans and operators; tables are catalog names
or storage paths (see ``sources.sinks``).  No HTTP: pages and weather rows are
read as landed data.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from delaykit import schemas
from delaykit.functions.timefmt import parse_minute_text
from delaykit.operators.ordering import contiguous_folds, hash_folds
from delaykit.plans import ingest, models
from delaykit.plans.airports import clean_airports
from delaykit.plans.counts import RunCounts
from delaykit.plans.scoring import first_flight_per_request, score_requests
from delaykit.plans.training import ACTUAL, SCHEDULED, features_from_flights, merge_flights_weather, prepare_flights_for_training
from delaykit.plans.training import training_table as build_training_table
from delaykit.plans.weather import request_batches
from delaykit.session import materialize, scratch_tables
from delaykit.sources.files import read_csv
from delaykit.sources.ledger import Ledger
from delaykit.sources.sinks import append_new_rows, read_target, replace_table


def prepare_airports(spark: SparkSession, csv_path: str, target: str) -> DataFrame:
    """Airport CSV -> cleaned ``airports`` table (replaced)."""
    raw = read_csv(spark, csv_path)
    typed = raw.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schemas.AIRPORTS.fields])
    clean = clean_airports(typed)
    replace_table(clean, target)
    return read_target(spark, target)


def prepare_flights(spark: SparkSession, landing_path: str, page_store: str, flights_target: str,
                    api_name: str = "flightstatus", ledger: str | None = None, counts_target: str | None = None) -> DataFrame:
    """Landed pages -> page store (insert if absent) -> ``flights`` table (new rows only).

    ``ledger``: catalog name of the table's ledger of row hashes (``sources.ledger``), by day of the scheduled departure, so
    that appends don't shuffle the stored rows."""
    ingest.store_raw_pages(spark, landing_path, page_store, api_name)
    flights = ingest.flights_from_page_store(spark, page_store)
    if ledger is None:
        return append_new_rows(spark, flights, flights_target)
    day = F.substring("Departure_ScheduledTimeUTC_DateTime", 1, 10)
    return Ledger(spark, ledger, flights_target, day=day).append(flights)


def weather_requests(spark: SparkSession, flights_target: str, airports_target: str) -> DataFrame:
    """Arrival-airport weather requests for the stored flights, in batches of 50 per day."""
    flights = read_target(spark, flights_target).withColumn(
        "__arr", parse_minute_text("Arrival_ScheduledTimeUTC_DateTime"))
    return request_batches(flights, read_target(spark, airports_target), "Arrival_AirportCode", "__arr")


def training_rows(spark: SparkSession, flights_target: str, weather_target: str,
                  feature_cols: Sequence[str] = schemas.WEATHER_VARIABLES, counts: RunCounts | None = None) -> DataFrame:
    """Flights cleaned, joined with their weather, label in minutes: one table.

    With ``counts`` the flights read, those that lack a time and the rows with a missing feature are counted, and the
    prepared flights are written once (in this job, which counts them)."""
    flights = read_target(spark, flights_target)
    if counts is not None:
        gap = F.col(ACTUAL).isNull() | F.col(SCHEDULED).isNull()
        flights = materialize(prepare_flights_for_training(counts.watch(flights, "flights", incomplete=gap)), "flights")
    flights = features_from_flights(prepare_flights_for_training(flights))
    merged = merge_flights_weather(flights, read_target(spark, weather_target), find_hot=True)
    if counts is not None:
        gap = reduce(lambda a, b: a | b, [models.is_missing(c) for c in feature_cols])
        merged = materialize(counts.watch(merged, "training", incomplete=gap), "training")
    keys = ["Arrival_AirportCode", "Arrival_ScheduledTimeUTC_DateTime", "Departure_ScheduledTimeUTC_DateTime"]
    return build_training_table(merged, keys, feature_cols)


def train(spark: SparkSession, flights_target: str, weather_target: str, model_path: str,
          names: Sequence[str] = models.MODEL_NAMES, feature_cols: Sequence[str] = schemas.WEATHER_VARIABLES,
          overrides: dict | None = None, k: int = 3, folds: str = "hash", missing: str = "error",
          counts_target: str | None = None) -> DataFrame:
    """Cross-validate the candidate models, refit the best on every row, store it at
    ``model_path``; returns the scores with ``is_best``.

    ``folds="hash"`` assigns folds by a hash of the row, no sort at all;
    ``folds="contiguous"`` reproduces unshuffled K-fold over a stable row order
    (one distributed sort).  ``missing`` as in ``models.pipeline``.  ``counts_target``: table of run counts.
    """
    with scratch_tables(spark):
        return _train(spark, flights_target, weather_target, model_path, names, feature_cols, overrides, k, folds, missing,
                      counts_target)


def _train(spark, flights_target, weather_target, model_path, names, feature_cols, overrides, k, folds, missing, counts_target):
    counts = RunCounts("train") if counts_target else None
    rows = training_rows(spark, flights_target, weather_target, feature_cols, counts)
    if counts:
        counts.store(spark, counts_target)
    order = [c for c in rows.columns if c != "delay_minutes"] + ["delay_minutes"]
    if folds == "contiguous":
        folded = contiguous_folds(rows, order, k)
    elif folds == "hash":
        folded = hash_folds(rows, order, k)
    else:
        raise ValueError("folds must be 'contiguous' or 'hash'")
    folded = folded.cache()
    try:
        overrides = {n: {"missing": missing, **(overrides or {}).get(n, {})} for n in names}
        found = models.select_best(models.score_models(spark, folded, feature_cols, names,
                                                       overrides=overrides, k=k)).collect()
        scores = spark.createDataFrame(found, "model_name string, position int, score double, is_best boolean")
        best = next(r.model_name for r in found if r.is_best)  # one row a model
        model = models.fit_best(folded, best, feature_cols, **overrides[best])
        models.save_model(model, model_path)
        return scores
    finally:
        folded.unpersist()


def predict(spark: SparkSession, requests: DataFrame, page_store: str, weather_target: str, model_path: str,
            feature_cols: Sequence[str] = schemas.WEATHER_VARIABLES, departure: str = "FRA") -> DataFrame:
    """(task_uuid, state, prediction, message) for a table (or stream) of requests.

    A request asks for flights from ``departure``.  Flights come from the page store with every column, since a request names
    the *local* scheduled departure time, which the ``flights`` table does not keep.
    """
    flights = ingest.flights_from_page_store(spark, page_store, all_columns=True)
    firsts = first_flight_per_request(
        features_from_flights(flights), "Arrival_AirportCode", "Departure_ScheduledTimeLocal_DateTime",
        ["Departure_ScheduledTimeUTC_DateTime", "Arrival_ScheduledTimeUTC_DateTime"],
        ["Arrival_ScheduledTimeUTC_DateTime"], departure)
    return score_requests(requests, firsts, read_target(spark, weather_target), models.load_model(model_path),
                          feature_cols)
