"""Sources, sinks, the day ingest and the streaming jobs on invented landing files."""

import json
import os

import pytest
from pyspark.sql import functions as F

from delaykit import schemas
from delaykit.plans import ingest
from delaykit.sources import files, sinks


def _flight(dep_time, arr_code="JFK", actual=True, extra=False):
    f = {
        "Departure": {"AirportCode": "FRA", "ScheduledTimeLocal": {"DateTime": dep_time},
                      "ScheduledTimeUTC": {"DateTime": dep_time + "Z"}},
        "Arrival": {"AirportCode": arr_code, "ScheduledTimeUTC": {"DateTime": "2024-09-06T18:00Z"}},
        "MarketingCarrier": {"AirlineID": "XX", "FlightNumber": "400"},
    }
    if actual:
        f["Arrival"]["ActualTimeUTC"] = {"DateTime": "2024-09-06T18:25Z"}
    if extra:
        f["Unexpected"] = {"x": 1}
    return f


def _page(flights, total, href, lone=False):
    flight_node = flights[0] if lone else flights
    return {"FlightStatusResource": {"Flights": {"Flight": flight_node},
                                     "Meta": {"TotalCount": total, "Link": [{"@Href": href, "@Rel": "self"}]}}}


def _landing(pages, start="2024-09-06T00:00"):
    return {"metadata": {"initial_flight_endpoint": "u", "time_at_execution": "t", "start_range": start,
                         "end_range": "2024-09-07T00:00"}, "data": pages}


@pytest.fixture()
def landing_dir(tmp_path):
    d = tmp_path / "landing"
    d.mkdir()
    p1 = [_flight(f"2024-09-06T08:{i:02d}") for i in range(50)]
    p2 = [_flight(f"2024-09-06T09:{i:02d}") for i in range(10)]
    p3 = [_flight("2024-09-06T13:00", actual=False, extra=True)]
    doc = _landing([_page(p1, 60, "http://api/x/08:00?limit=50&offset=0"),
                    _page(p2, 60, "http://api/x/08:00?limit=50&offset=50"),
                    _page(p3, 5, "http://api/x/12:00?limit=50&offset=0", lone=True)])
    (d / "FRA_flightstatus_dep_flights_2024-09-06.json").write_text(json.dumps(doc, indent=4))
    (d / "broken.json").write_text("{ not json")
    return str(d)


def test_landed_flights_repairs_lone_object_and_skips_corrupt(spark, landing_dir):
    fl = ingest.landed_flights(spark, landing_dir)
    assert fl.count() == 61
    flat = ingest.flat_flights(fl)
    assert "Arrival_ActualTimeUTC_DateTime" in flat.columns
    table = ingest.flights_table(flat)
    assert table.columns == schemas.FLIGHT_TABLE_COLUMNS
    assert table.filter(F.col("Arrival_ActualTimeUTC_DateTime").isNull()).count() == 1


def test_without_repair_lone_object_file_is_listed(spark, landing_dir):
    # Read with an array schema, the lone object doesn't fit: the file's other flights stay and the file is listed.
    landing = files.read_landing(spark, landing_dir)
    flagged = {r.file_name: r._corrupt_record is not None for r in landing.collect()}
    assert flagged == {"FRA_flightstatus_dep_flights_2024-09-06.json": True, "broken.json": True}
    assert ingest.landed_flights(spark, landing_dir, repair_lone_objects=False).count() == 60
    reasons = {r.file_path.rsplit("/", 1)[-1]: r.reason for r in files.unreadable(landing).collect()}
    assert reasons == {"FRA_flightstatus_dep_flights_2024-09-06.json": "partly read", "broken.json": "unreadable"}


def test_endpoint_checksum_checks_last_endpoint(spark, landing_dir):
    from delaykit.operators.nested import endpoint_checksums, pages_of, repair_lone_flight
    landing = files.read_landing(spark, landing_dir, flight_as_text=True).filter(F.col("_corrupt_record").isNull())
    pages = pages_of(landing)
    checks = {r.endpoint: (r.n_received, r.n_declared, r.matches)
              for r in endpoint_checksums(pages, repair_lone_flight(pages)).collect()}
    assert checks["http://api/x/08:00"] == (60, 60, True)
    # the last endpoint is checked too: 1 flight received, 5 declared
    assert checks["http://api/x/12:00"] == (1, 5, False)


def test_consolidated_roundtrip_and_day_download(spark, landing_dir, tmp_path):
    fl = ingest.landed_flights(spark, landing_dir)
    cons = ingest.consolidated(fl).first()
    assert len(cons.flights) == 61
    assert cons.flights[0].Departure.ScheduledTimeLocal.DateTime == "2024-09-06T08:00"
    out = str(tmp_path / "out")
    ingest.day_download(spark, landing_dir, out)
    back = spark.read.option("header", True).csv(out + "/flat")
    assert back.count() == 61 and "flight_date" in back.columns


def test_stage_path_and_container():
    assert files.stage_path("s3a://bucket/data", "interim", "flights", "a.csv") == "s3a://bucket/data/2_interim/flights/a.csv"
    with pytest.raises(ValueError):
        files.stage_path("/x", "bronze")
    assert schemas.container_for("customerflightinformation") == "FlightInformation"
    with pytest.raises(ValueError):
        schemas.container_for("other")


def test_list_files_filters_names(spark, tmp_path):
    d = tmp_path / "interim"
    d.mkdir()
    for name in ["FRA_dep_flights_2024-09-06.csv", "FRA_dep_flights_OLD_2024-09-05.csv", "notes.txt"]:
        (d / name).write_text("a\n1\n")
    got = sorted(r.file_name for r in files.list_files(spark, str(d), contains="dep_flights", excludes="OLD",
                                                        suffix=".csv").collect())
    assert got == ["FRA_dep_flights_2024-09-06.csv"]


def test_csv_and_table_sinks(spark, tmp_path):
    nation = spark.read.parquet("/root/testdata/sf0.001/nation.parquet")
    path = str(tmp_path / "nation_csv")
    sinks.write_csv(nation, path)
    back = files.read_csv(spark, path, schema="n_nationkey int, n_name string, n_regionkey int")
    assert back.count() == nation.count()
    target = str(tmp_path / "tbl")
    assert not sinks.table_exists(spark, target)
    sinks.append_new_rows(spark, nation, target)
    added = sinks.append_new_rows(spark, nation.unionByName(nation.limit(0)), target)
    assert added.count() == 0 and spark.read.parquet(target).count() == 25
    sinks.append_rows(spark.read.parquet(target).limit(3), target)
    assert spark.read.parquet(target).count() == 28
    sinks.replace_table(nation.select("n_nationkey"), target)
    assert spark.read.parquet(target).columns == ["n_nationkey"]
    with pytest.raises(Exception):
        sinks.create_table(nation, target)
    sinks.ensure_database(spark, "delaykit_test_db")
    sinks.ensure_database(spark, "delaykit_test_db")
    assert spark.catalog.databaseExists("delaykit_test_db")
    assert sinks.column_as_table(nation, "n_nationkey").columns == ["target"]


def test_store_raw_pages_inserts_once(spark, landing_dir, tmp_path):
    target = str(tmp_path / "pages")
    first = ingest.store_raw_pages(spark, landing_dir, target).count()
    again = ingest.store_raw_pages(spark, landing_dir, target).count()
    assert (first, again) == (3, 0)
    assert spark.read.parquet(target).count() == 3
    flights = ingest.flights_from_page_store(spark, target)
    assert flights.columns == schemas.FLIGHT_TABLE_COLUMNS and flights.count() == 61


def test_streaming_ingest_two_drops_no_repeats(spark, landing_dir, tmp_path):
    from delaykit.streaming.ingest import start_ingest
    drop = tmp_path / "drop"
    drop.mkdir()
    src = [f for f in os.listdir(landing_dir) if f.startswith("FRA")][0]
    text = open(os.path.join(landing_dir, src)).read()
    (drop / "a.json").write_text(text)
    target, ckpt = str(tmp_path / "flights"), str(tmp_path / "ckpt")
    start_ingest(spark, str(drop), target, ckpt).awaitTermination()
    n1 = spark.read.parquet(target).count()
    (drop / "b.json").write_text(text)  # the same content landed again
    start_ingest(spark, str(drop), target, ckpt).awaitTermination()
    n2 = spark.read.parquet(target).count()
    assert n1 == n2 == spark.read.parquet(target).distinct().count()


def test_streaming_scoring(spark, tmp_path):
    from delaykit.plans import models as M
    from delaykit.streaming.scoring import start_scoring
    train = spark.createDataFrame([(float(i), float(i % 7), 2.0 * i + 1) for i in range(40)],
                                  "temperature_2m double, rain double, delay_minutes double")
    model = M.fit_best(train, "LinearRegression", ["temperature_2m", "rain"])
    flights_first = spark.createDataFrame([("JFK", "2024-09-06T08:00", "2024-09-06T18:00")],
                                          "Arrival_AirportCode string, Departure_ScheduledTimeLocal_DateTime string,"
                                          " Arrival_ScheduledTimeUTC_DateTime string")
    weather = spark.createDataFrame([("JFK", "2024-09-06T18:00", 3.0, 1.0)],
                                    "Airport_Code string, Flight_DateTime string, temperature_2m double, rain double")
    req = tmp_path / "req"
    req.mkdir()
    (req / "r.json").write_text("\n".join(json.dumps(r) for r in [
        {"task_uuid": "t1", "arrival_iata_code": "JFK", "scheduled_departure_local_time": "2024-09-06T08:00"},
        {"task_uuid": "t2", "arrival_iata_code": "JFK", "scheduled_departure_local_time": "2024-09-06T09:00"}]))
    out = str(tmp_path / "scored")
    start_scoring(spark, str(req), flights_first, weather, model, ["temperature_2m", "rain"], out,
                  str(tmp_path / "ck")).awaitTermination()
    got = {r.task_uuid: (r.state, r.prediction) for r in spark.read.parquet(out).collect()}
    assert got["t1"][0] == "success" and got["t1"][1] == pytest.approx(7.0, abs=1e-3)
    assert got["t2"] == ("failed", None)


def test_model_save_and_load(spark, tmp_path):
    from delaykit.plans import models as M
    train = spark.createDataFrame([(float(i), 3.0 * i - 2.0) for i in range(30)], "temperature_2m double, delay_minutes double")
    model = M.fit_best(train, "LinearRegression", ["temperature_2m"])
    path = str(tmp_path / "best_model")
    M.save_model(model, path)
    again = M.load_model(path)
    got = M.predict(again, train.limit(3), ["temperature_2m"]).orderBy("temperature_2m").collect()
    assert [round(r.prediction, 6) for r in got] == [-2.0, 1.0, 4.0]


def test_bulk_load_csv_skips_old_and_repeats(spark, tmp_path):
    folder = tmp_path / "weather_hourly"
    folder.mkdir()
    header = "Flight_DateTime,Airport_Code,Latitude,Longitude\n"
    (folder / "AA_hourly_weather_2024-09-01.csv").write_text(header + "2024-09-01T10:00,JFK,40.6,-73.8\n")
    (folder / "AA_hourly_weather_2024-09-02.csv").write_text(header + "2024-09-02T10:00,JFK,40.6,-73.8\n"
                                                            "2024-09-01T10:00,JFK,40.6,-73.8\n")
    (folder / "AA_hourly_weather_OLD_2024-08-01.csv").write_text(header + "2024-08-01T10:00,CDG,49.0,2.5\n")
    schema = "Flight_DateTime string, Airport_Code string, Latitude double, Longitude double"
    target = str(tmp_path / "weather_table")
    ingest.bulk_load_csv(spark, str(folder), target, schema=schema)
    ingest.bulk_load_csv(spark, str(folder), target, schema=schema)
    got = sorted(r.Flight_DateTime for r in spark.read.parquet(target).collect())
    # the first load keeps the in-batch duplicate; the second load adds nothing; OLD is skipped
    assert got == ["2024-09-01T10:00", "2024-09-01T10:00", "2024-09-02T10:00"]


def test_write_json_roundtrip(spark, tmp_path):
    nation = spark.read.parquet("/root/testdata/sf0.001/nation.parquet")
    path = str(tmp_path / "nation_json")
    sinks.write_json(nation, path)
    sinks.write_json(nation, path)  # overwrite, not append
    assert spark.read.schema(nation.schema).json(path).count() == 25


def test_page_store_stream_early_stop_across_files(spark, tmp_path):
    from delaykit.streaming.ingest import start_page_store_ingest
    drop = tmp_path / "landed"
    drop.mkdir()
    pages = [_page([_flight(f"2024-09-06T0{i}:00")], 1, f"http://api/x/0{i}:00?limit=50&offset=0") for i in range(8)]
    # file a: pages 0-3; file b: pages 0-7 — its first 4 pages were inserted by file a.
    (drop / "a.json").write_text(json.dumps(_landing(pages[:4])))
    store, ckpt = str(tmp_path / "store"), str(tmp_path / "ck")
    start_page_store_ingest(spark, str(drop), store, ckpt, max_hits=2).awaitTermination()
    (drop / "b.json").write_text(json.dumps(_landing(pages)))
    start_page_store_ingest(spark, str(drop), store, ckpt, max_hits=2).awaitTermination()
    got = spark.read.parquet(store)
    # file b: hits at pages 0, 1 (counted), the 3rd hit (page 2) stops the file: pages 4-7 are not inserted
    assert got.count() == 4
    assert sorted(r.file_name for r in got.collect()) == ["a.json"] * 4


def test_page_store_stream_takes_a_backlog_in_one_batch(spark, tmp_path):
    from delaykit.streaming.ingest import start_page_store_ingest
    drop = tmp_path / "landed"
    drop.mkdir()
    pages = [_page([_flight(f"2024-09-06T0{i}:00", extra=i == 5)], 1, f"u{i}?a") for i in range(8)]
    pages[5]["FlightStatusResource"]["Meta"]["Version"] = "2"
    for k, name in enumerate(["c", "b", "a"]):  # arrival order, not the order of names
        held = [pages[:4], pages, pages[5:] + [{"Other": 1}]][k]
        (drop / f"{name}.json").write_text(json.dumps(_landing(held)))
        os.utime(drop / f"{name}.json", (1_700_000_000 + k, 1_700_000_000 + k))
    store = str(tmp_path / "store")
    query = start_page_store_ingest(spark, str(drop), store, str(tmp_path / "ck"), max_hits=2)
    query.awaitTermination()
    got = spark.read.parquet(store)
    assert {(r.file_name, r.page_pos) for r in got.collect()} == {("c.json", p) for p in range(4)} | {("a.json", p) for p in range(3)}
    assert {r.batch_id for r in got.collect()} == {0}
    leaves = got.select(F.try_variant_get("page", "$.Meta.Version", "string").alias("v"),
                        F.try_variant_get("page", "$.Flights.Flight[0].Unexpected.x", "int").alias("x")).filter("v IS NOT NULL OR x IS NOT NULL")
    assert [tuple(r) for r in leaves.collect()] == [("2", 1)]
    bad = spark.read.parquet(store + "_quarantine").collect()
    assert [(r.file_path.rsplit("/", 1)[-1], r.reason, r.record) for r in bad] == [("a.json", "page 3", '{"Other": 1}')]


def test_unknown_leaves_survive_store_and_download(spark, landing_dir, tmp_path):
    doc = _landing([_page([{**_flight("2024-09-07T08:00"), "Codeshare": {"Code": 7, "code": "low"}, "Stops": ["AA", {"q": 1}],
                            "Arrival": "JFK as text"}], 1, "u?a")])
    doc["metadata"]["operator"] = "night shift"
    doc["data"][0]["FlightStatusResource"]["Meta"]["Version"] = 3
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text(json.dumps(doc))
    store, out = str(tmp_path / "store"), str(tmp_path / "out")
    ingest.store_raw_pages(spark, str(tmp_path / "in"), store)
    flat = ingest.flights_from_page_store(spark, store, all_columns=True, page_leaves={"version": ("Meta", "Version")})
    row = flat.first().asDict()
    assert (row["Codeshare_Code"], row["Codeshare_code__2"], row["Arrival"], row["version"]) == ("7", "low", "JFK as text", "3")
    assert (row["Stops_0"], row["Stops_1"]) == ("AA", '{"q":1}')
    ingest.store_raw_pages(spark, landing_dir, store)  # other leaves meet the stored ones
    both = ingest.flights_from_page_store(spark, store, all_columns=True)
    assert both.count() == 62 and {"Unexpected_x", "Codeshare_Code"} <= set(both.columns)
    ingest.day_download(spark, str(tmp_path / "in"), out)
    back = json.loads(spark.read.text(out + "/consolidated").first().value)  # names that differ in case only
    assert back["metadata"]["operator"] == "night shift" and back["flights"][0]["Stops"][0] == "AA"
    assert back["flights"][0]["Codeshare"] == {"Code": 7, "code": "low"}
    assert spark.read.option("header", True).csv(out + "/flat").first()["Stops_1"] == '{"q":1}'


def test_quarantine_lists_a_file_once(spark, tmp_path):
    bad = spark.createDataFrame([("f1", "unreadable", "x"), ("f1", "unreadable", "x"), ("f2", "page 0", None)],
                                "file_path string, reason string, record string")
    target = str(tmp_path / "q")
    assert [sinks.quarantine(bad, target), sinks.quarantine(bad, target)] == [2, 0]
    assert spark.read.parquet(target).count() == 2


def test_dates_without_weather_keyed_by_kind(spark, tmp_path):
    from delaykit.plans.weather import dates_without_weather
    fl, wx = tmp_path / "flights", tmp_path / "weather_hourly"
    fl.mkdir()
    wx.mkdir()
    for name in ["FRA_flightstatus_dep_flights_2024-09-01_conso_flatten.csv",
                 "FRA_flightstatus_dep_flights_2024-09-02_conso_flatten.csv", "notes.csv"]:
        (fl / name).write_text("a\n")
    for name in ["AA_hourly_weather_2024-09-01.csv", "DA_hourly_weather_2024-09-01.csv",
                 "AA_hourly_weather_2024-09-02.csv"]:
        (wx / name).write_text("a\n")
    flights = files.list_files(spark, str(fl), contains=".csv")
    weather = files.list_files(spark, str(wx))
    got = [(r.date, r.kind) for r in dates_without_weather(flights, weather).collect()]
    assert got == [("2024-09-02", "DA")]


def test_day_download_keeps_other_days_and_lists_bad_files(spark, landing_dir, tmp_path):
    out = str(tmp_path / "out")
    ingest.day_download(spark, landing_dir, out)
    later = tmp_path / "later"
    later.mkdir()
    (later / "x.json").write_text(json.dumps(_landing([_page([_flight("2024-09-07T08:00")], 1, "u?a")], start="2024-09-07T00:00")))
    (later / "empty.json").write_text(json.dumps(_landing([], start="2024-09-08T00:00")))
    for _ in range(2):  # a day downloaded again is replaced, not doubled
        ingest.day_download(spark, str(later), out)
    flat = spark.read.option("header", True).csv(out + "/flat")
    assert {r.flight_date.isoformat(): r["count"] for r in flat.groupBy("flight_date").count().collect()} == {
        "2024-09-06": 61, "2024-09-07": 1}
    docs = spark.read.json(out + "/consolidated")
    assert {r.day.isoformat() if hasattr(r.day, "isoformat") else r.day: r.n for r in
            docs.groupBy("day").agg(F.sum(F.size("flights")).alias("n")).collect()} == {
        "2024-09-06": 61, "2024-09-07": 1, "2024-09-08": 0}
    bad = spark.read.parquet(out + "/quarantine").collect()
    assert [(r.file_path.rsplit("/", 1)[-1], r.reason) for r in bad] == [("broken.json", "unreadable")]


def test_lone_link_keeps_the_file(spark, tmp_path):
    page = _page([_flight("2024-09-06T08:00")], 1, "http://api/x?a")
    page["FlightStatusResource"]["Meta"]["Link"] = page["FlightStatusResource"]["Meta"]["Link"][0]
    none = _page([_flight("2024-09-06T09:00")], 1, "u")
    none["FlightStatusResource"]["Meta"]["Link"] = []
    (tmp_path / "a.json").write_text(json.dumps(_landing([page, none])))
    assert ingest.landed_flights(spark, str(tmp_path)).count() == 2
    from delaykit.operators.nested import endpoint_checksums, pages_of, repair_lone_flight
    pages = pages_of(files.read_landing(spark, str(tmp_path), flight_as_text=True))
    got = {r.endpoint: r.n_received for r in endpoint_checksums(pages, repair_lone_flight(pages)).collect()}
    assert got == {"http://api/x": 1, None: 1}


def test_equal_file_names_in_two_folders_stay_apart(spark, tmp_path):
    for name, hour in (("d1", "08"), ("d2", "09")):
        (tmp_path / name).mkdir()
        (tmp_path / name / "day.json").write_text(json.dumps(_landing([_page([_flight(f"2024-09-06T{hour}:00")], 1, "u?a")])))
    fl = ingest.landed_flights(spark, str(tmp_path) + "/*")
    docs = ingest.consolidated(fl).collect()
    assert [len(r.flights) for r in docs] == [1, 1] and len({r.file_path for r in docs}) == 2


def test_unknown_leaves_are_kept_on_request(spark, landing_dir):
    fl = ingest.landed_flights(spark, landing_dir, all_leaves=True)
    flat = ingest.flat_flights(fl)
    assert "Unexpected_x" in flat.columns and flat.filter("Unexpected_x = '1'").count() == 1
    assert set(schemas.FLIGHT_TABLE_COLUMNS) <= set(flat.columns)


def test_bulk_load_matches_columns_by_name(spark, tmp_path):
    folder = tmp_path / "csv"
    folder.mkdir()
    (folder / "one.csv").write_text("a,b\n1,2\n")
    (folder / "two.csv").write_text("b,a,c\n4,3,5\n")
    (folder / "three.csv").write_text("c,a\n7,6\n")
    target = str(tmp_path / "t")
    ingest.bulk_load_csv(spark, str(folder), target)
    got = sorted((r.a, r.b, r.c) for r in spark.read.parquet(target).collect())
    assert got == [("1", "2", None), ("3", "4", "5"), ("6", None, "7")]
    typed = ingest.bulk_load_tables(spark, {str(tmp_path / "u"): str(folder)}, {str(tmp_path / "u"): "b int, a int"})
    assert sorted((r.a, r.b) for df in typed.values() for r in df.collect()) == [(1, 2), (3, 4), (6, None)]


def test_truncated_streamed_file_is_quarantined(spark, tmp_path):
    from delaykit.streaming.ingest import start_ingest
    drop = tmp_path / "drop"
    drop.mkdir()
    text = json.dumps(_landing([_page([_flight("2024-09-06T08:00")], 1, "u?a")]))
    (drop / "good.json").write_text(text)
    (drop / "cut.json").write_text(text[:len(text) // 2])
    target = str(tmp_path / "flights")
    start_ingest(spark, str(drop), target, str(tmp_path / "ck")).awaitTermination()
    assert spark.read.parquet(target).count() == 1
    bad = spark.read.parquet(target + "_quarantine").collect()
    assert [r.file_path.rsplit("/", 1)[-1] for r in bad] == ["cut.json"]


def test_array_slots_past_the_end_are_null(spark):
    from delaykit.operators.nested import flatten
    df = spark.createDataFrame([([1],), ([1, 2, 3],), ([],)], "x array<int>")
    assert sorted([tuple(r) for r in flatten(df, array_slots=2).collect()], key=str) == [(1, 2), (1, None), (None, None)]


def test_zip_of_unequal_arrays_fails(spark):
    from delaykit.operators.joins import zip_checked
    df = spark.createDataFrame([(1, [1, 2], ["a", "b"]), (2, [], []), (3, None, None)], "k int, x array<int>, y array<string>")
    got = sorted(tuple(r) for r in zip_checked(df, ["k"], {"u": "x", "v": "y"}).collect())
    assert got == [(1, 0, 1, "a"), (1, 1, 2, "b")]
    bad = spark.createDataFrame([(1, [1, 2], ["a"])], "k int, x array<int>, y array<string>")
    with pytest.raises(Exception, match="differ in length: 2, 1"):
        zip_checked(bad, ["k"], {"u": "x", "v": "y"}).collect()


def test_checkpoint_folder_must_be_shared_on_a_cluster(spark, monkeypatch):
    from delaykit import session

    class Conf:
        def get(self, *_):
            return None

    class Cluster:
        conf = Conf()

        class sparkContext:
            master = "spark://host:7077"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Cluster())


def test_scratch_tables_are_deleted(spark):
    from delaykit.session import materialize, scratch_tables
    with scratch_tables(spark):
        df = materialize(spark.range(5).toDF("x"), "gone")
        assert df.count() == 5
        path = df.inputFiles()[0].removeprefix("file:").replace("//", "/")
        assert os.path.exists(path)
    assert not os.path.exists(path)


def test_missing_features_are_an_error_or_a_choice(spark):
    from delaykit.plans import models as M
    nan = float("nan")
    rows = [(float(i), float(i % 3), 2.0 * i) for i in range(20)] + [(None, 1.0, 3.0), (nan, 1.0, 3.0)]
    train = spark.createDataFrame(rows, "x double, z double, delay_minutes double")
    with pytest.raises(Exception):
        M.fit_best(train, "LinearRegression", ["x", "z"])
    counts = M.missing_counts(train, ["x", "z"]).first()
    assert (counts.n_rows, counts.n_incomplete, counts.x, counts.z) == (22, 2, 2, 0)
    skipping = M.fit_best(train, "LinearRegression", ["x", "z"], missing="skip")
    got = M.predict(skipping, train, ["x", "z"])
    assert got.count() == 22 and got.filter("prediction IS NULL").count() == 2
    imputing = M.fit_best(train, "LinearRegression", ["x", "z"], missing="impute")
    got = M.predict(imputing, train, ["x", "z"])
    assert got.filter("prediction IS NULL").count() == 0 and set(train.columns) < set(got.columns)


def test_time_texts(spark):
    from delaykit.functions.timefmt import parse_minute_text
    texts = {"2024-09-06T10:00": "2024-09-06 10:00:00", "2024-09-06T10:00Z": "2024-09-06 10:00:00",
             "2024-09-06 10:00:30": "2024-09-06 10:00:30", "2024-09-06T10:00:30.5Z": "2024-09-06 10:00:30.5",
             "2024-09-06T10:00+02:00": "2024-09-06 08:00:00", "2024-09-06T23:30:00-0130": "2024-09-07 01:00:00",
             "2024-02-30T10:00": None, "2024-09-06": None, "10:00": None, "2024-09-06T10:00X": None, "": None, None: None}
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = {r.t: r.p for r in df.select("t", parse_minute_text("t").cast("string").alias("p")).collect()}
    assert got == texts


def test_weather_responses_become_rows_by_key(spark):
    from delaykit.plans.weather import response_rows
    points = spark.createDataFrame([("2024-09-06", 0, "JFK", 40.6, -73.8, "2024-09-06T10:20"),
                                    ("2024-09-06", 0, "CDG", 49.0, 2.5, "2024-09-06T11:00")],
                                   "day string, batch int, airport_code string, latitude double, longitude double, flight_minute string")
    hourly = "struct<time:array<string>,temperature_2m:array<double>,rain:array<double>>"
    responses = spark.createDataFrame(
        [("2024-09-06", 0, 0, (["2024-09-06T11:00"], [20.0], [0.5])), ("2024-09-06", 0, 1, (["2024-09-06T10:00", "2024-09-06T11:00"], [1.0, 2.0], [None, 0.0]))],
        f"day string, batch int, position int, hourly {hourly}")
    rows = response_rows(points, responses)
    assert rows.schema == schemas.WEATHER or [f.name for f in rows.schema] == [f.name for f in schemas.WEATHER]
    got = {r.Airport_Code: (r.Flight_DateTime, r.temperature_2m, r.rain, r.snowfall) for r in rows.collect()}
    assert got == {"CDG": ("2024-09-06T11:00", 20.0, 0.5, None), "JFK": ("2024-09-06T10:20", 1.0, None, None)}


def test_written_stages_leave_no_shuffle_files(spark):
    from delaykit.session import materialize
    held = lambda: spark.sparkContext._jsc.sc().env().mapOutputTracker().shuffleStatuses().size()
    setting = spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled")
    counts = spark.range(5000).selectExpr("id % 97 AS k").groupBy("k").count()
    before = held()
    got = materialize(counts.join(counts.withColumnRenamed("count", "n"), "k").repartition(3), "cleaned")
    assert held() <= before
    assert sorted(r["n"] for r in got.collect())[0] == 51 and got.count() == 97
    assert counts.count() == 97  # a later query computes its shuffles anew
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == setting


def test_discarded_tables_are_gone(spark):
    from delaykit.session import discard, materialize
    kept, gone = materialize(spark.range(5), "kept"), materialize(spark.range(7), "gone", compression="zstd")
    path = os.path.dirname(gone.inputFiles()[0]).removeprefix("file:")
    assert gone.count() == 7 and os.path.exists(path)
    discard(gone)
    assert not os.path.exists(path) and kept.count() == 5


def test_landed_flight_files_hold_many_pages(spark, tmp_path, monkeypatch):
    from delaykit.registry import files

    spark.range(300).selectExpr("id AS o_orderkey", "'F' AS o_orderstatus", "make_timestamp(2024, 3 + CAST(id % 2 AS INT), 5, 10, 0, 0) AS o_orderdate").write.parquet(
        str(tmp_path / "orders.parquet"))
    landed, download = set(), files.day_download

    def counted(spark, landing, out):
        for folder, _, names in os.walk(landing.split("/part=")[0]):
            landed.update(os.path.join(folder, n) for n in names if n.endswith(".json"))
        return download(spark, landing, out)

    monkeypatch.setattr(files, "day_download", counted)
    monkeypatch.setattr(files, "PAGE", 10)  # 15 pages a month
    got = files.day_download_roundtrip(spark, str(tmp_path)).collect()
    assert sorted(int(r.flight_number) for r in got) == list(range(300)) and len(landed) == 2
