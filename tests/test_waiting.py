"""Requests that wait for their flight or weather (T2): answered when both have come, failed once when time is up."""

import datetime as dt

import pytest

from delaykit.plans import models as M
from delaykit.streaming.waiting import start_waiting_scoring

FEATURES = ["rain"]
T0 = dt.datetime(2024, 9, 6, 12, 0)


def _minute(n):
    return T0 + dt.timedelta(minutes=n)


@pytest.fixture()
def world(spark, tmp_path):
    model = M.fit_best(spark.createDataFrame([(float(i), 2.0 * i + 1) for i in range(20)], "rain double, delay_minutes double"),
                       "LinearRegression", FEATURES)
    ddl = {"requests": "task_uuid string, arrival_iata_code string, scheduled_departure_local_time string, requested_at timestamp",
           "flights": "Arrival_AirportCode string, Departure_ScheduledTimeLocal_DateTime string, "
                      "Arrival_ScheduledTimeUTC_DateTime string, known_at timestamp",
           "weather": "Airport_Code string, Flight_DateTime string, rain double, known_at timestamp"}

    def drop(**rows):
        for name in ddl:
            spark.createDataFrame(rows.get(name, []), ddl[name]).write.mode("append").parquet(str(tmp_path / name))

    def run():
        streams = [spark.readStream.schema(ddl[n]).parquet(str(tmp_path / n)) for n in ddl]
        query = start_waiting_scoring(*streams, model, FEATURES, str(tmp_path / "out"), str(tmp_path / "ck"),
                                      wait="60 minutes", keep="120 minutes", late="0 minutes")
        query.awaitTermination()
        got = spark.read.parquet(str(tmp_path / "out")).collect()
        state = sum(o["numRowsTotal"] for o in query.lastProgress["stateOperators"])
        return {r.task_uuid: (r.state, r.message, r.prediction) for r in got}, len(got), state

    return drop, run


def test_waits_for_late_weather_and_fails_once(world):
    drop, run = world
    drop(requests=[("ready", "JFK", "08:00", _minute(0)), ("late", "MUC", "09:00", _minute(0)), ("no flight", "XXX", "07:00", _minute(0)),
                   ("no weather", "CDG", "10:00", _minute(0)), ("late flight", "OSL", "11:00", _minute(0))],
         flights=[("JFK", "08:00", "a", _minute(-5)), ("MUC", "09:00", "b", _minute(-5)), ("CDG", "10:00", "c", _minute(1))],
         weather=[("JFK", "a", 3.0, _minute(-9)), ("JFK", "a", 3.0, _minute(-8))])
    got, n, _ = run()
    assert got.keys() == {"ready"} and got["ready"][0] == "success" and got["ready"][2] == pytest.approx(7, abs=1e-3)
    drop(flights=[("OSL", "11:00", "d", _minute(30))],
         weather=[("MUC", "b", 1.0, _minute(40)), ("OSL", "d", 2.0, _minute(41))])
    got, n, waiting = run()
    assert got.keys() == {"ready", "late", "late flight"} and n == 3 and waiting > 0
    assert got["late"][2] == pytest.approx(3, abs=1e-3) and got["late flight"][2] == pytest.approx(5, abs=1e-3)
    # The slowest stream holds the watermark: nothing fails before all of them have moved on.
    drop(requests=[("next", "JFK", "08:00", _minute(400))], flights=[("AAA", "x", "x", _minute(400))])
    assert run()[1] == 3
    drop(requests=[("other", "ZZZ", "z", _minute(400))], flights=[("AAA", "x", "x", _minute(400))],
         weather=[("AAA", "x", 0.0, _minute(400)), ("CDG", "c", 9.0, _minute(399))])
    got, n, waiting = run()
    assert n == 5 and got["no flight"] == ("failed", "no flight at that departure time", None)
    assert got["no weather"] == ("failed", "no weather forecast for the flight", None)
    drop(requests=[("end", "ZZZ", "z", _minute(900))], flights=[("AAA", "y", "y", _minute(900))], weather=[("AAA", "y", 0.0, _minute(900))])
    got, n, left = run()
    assert n == 7 and got["next"][0] == got["other"][0] == "failed"  # the flight it names became known too long before
    assert left <= 4  # the last request, flight and forecast: all that came before has left the state


def test_null_keys_and_features(world):
    drop, run = world
    drop(requests=[("null code", None, "08:00", _minute(0)), ("null rain", "JFK", "08:00", _minute(0))],
         flights=[(None, "08:00", "a", _minute(0)), ("JFK", "08:00", "a", _minute(0))], weather=[("JFK", "a", None, _minute(0))])
    got, _, _ = run()
    assert got == {"null rain": ("failed", "incomplete features", None)}
    drop(requests=[("end", "ZZZ", "z", _minute(500))], flights=[("ZZZ", "y", "y", _minute(500))], weather=[("AAA", "y", 0.0, _minute(500))])
    got, n, _ = run()
    assert n == 2 and got["null code"] == ("failed", "no flight at that departure time", None)
