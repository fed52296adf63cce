"""The lifecycle jobs end to end on invented landed pages, airports and weather."""

import json
import random

import pytest

from delaykit import schemas
from delaykit.plans import jobs


def _flight(i, arr_code, arr_hour, delay):
    dep = f"2024-09-06T{6 + i % 10:02d}:{i % 60:02d}"
    return {
        "Departure": {"AirportCode": "FRA", "ScheduledTimeLocal": {"DateTime": dep},
                      "ScheduledTimeUTC": {"DateTime": dep + "Z"}},
        "Arrival": {"AirportCode": arr_code,
                    "ScheduledTimeUTC": {"DateTime": f"2024-09-06T{arr_hour:02d}:00Z"},
                    "ActualTimeUTC": {"DateTime": f"2024-09-06T{arr_hour:02d}:{delay:02d}Z"}},
    }


def test_lifecycle(spark, tmp_path):
    rnd = random.Random(1)
    codes = ["JFK", "CDG", "NRT", "LAX"]
    flights = [_flight(i, codes[i % 4], 10 + i % 8, rnd.randint(0, 50)) for i in range(40)]
    page = {"FlightStatusResource": {"Flights": {"Flight": flights},
                                     "Meta": {"TotalCount": 40, "Link": [{"@Href": "u?x", "@Rel": "self"}]}}}
    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "FRA_flightstatus_dep_flights_2024-09-06.json").write_text(json.dumps(
        {"metadata": {"initial_flight_endpoint": "u"}, "data": [page]}))
    (tmp_path / "airports.csv").write_text(
        "id,iata_code,name,latitude_deg,longitude_deg\n1,JFK,Kennedy,40.6,-73.8\n2,CDG,Paris,49.0,2.5\n"
        "3,NRT,Narita,35.8,140.4\n4,LAX,,33.9,-118.4\n5,,none,0,0\n6,CDG,dup,1,1\n")
    base = str(tmp_path)
    airports = jobs.prepare_airports(spark, base + "/airports.csv", base + "/t_airports")
    assert sorted(r.iata_code for r in airports.collect()) == ["JFK", "LAX", "NRT"]

    added = jobs.prepare_flights(spark, str(landing), base + "/t_pages", base + "/t_flights")
    assert added.count() == 40
    assert jobs.prepare_flights(spark, str(landing), base + "/t_pages", base + "/t_flights").count() == 0

    req = jobs.weather_requests(spark, base + "/t_flights", base + "/t_airports")
    assert {r.airport_code for r in req.collect()} == {"JFK", "NRT", "LAX"} and req.filter("batch > 0").count() == 0

    # Landed weather rows for every requested (airport, minute), 42 variables each.
    wrows = [[r.flight_minute, r.airport_code, r.latitude, r.longitude] + [rnd.random() for _ in schemas.WEATHER_VARIABLES]
             for r in req.collect()]
    spark.createDataFrame(wrows, schemas.WEATHER).write.parquet(base + "/t_weather")

    scores = jobs.train(spark, base + "/t_flights", base + "/t_weather", base + "/model",
                        names=["LinearRegression", "DecisionTreeRegressor"],
                        overrides={"LinearRegression": {"regParam": 0.1}, "DecisionTreeRegressor": {"maxDepth": 3}})
    assert scores.filter("is_best").count() == 1
    hashed = jobs.train(spark, base + "/t_flights", base + "/t_weather", base + "/model_h",
                        names=["LinearRegression"], overrides={"LinearRegression": {"regParam": 0.1}}, folds="hash")
    assert hashed.first().is_best

    requests = spark.createDataFrame([("t1", "JFK", flights[0]["Departure"]["ScheduledTimeLocal"]["DateTime"]),
                                      ("t2", "CDG", flights[1]["Departure"]["ScheduledTimeLocal"]["DateTime"]),
                                      ("t3", "JFK", "2024-09-06T23:59")], schemas.REQUESTS)
    out = {r.task_uuid: (r.state, r.message) for r in
           jobs.predict(spark, requests, base + "/t_pages", base + "/t_weather", base + "/model").collect()}
    assert out["t1"][0] == "success"
    assert out["t2"] == ("failed", "no weather forecast for the flight")  # CDG was dropped as a duplicated code
    assert out["t3"] == ("failed", "no flight at that departure time")
