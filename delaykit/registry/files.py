"""Files written under the shared scratch folder and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import Window, functions as F

from delaykit.functions.timefmt import format_minute
from delaykit.operators.dedup import union_ragged
from delaykit.operators.nested import flatten
from delaykit.plans.ingest import bulk_load_csv, day_download, flights_from_page_store, store_raw_pages
from delaykit.registry.base import register, table
from delaykit.session import scratch_path
from delaykit.sources.files import read_csv
from delaykit.sources.ledger import Ledger
from delaykit.sources.sinks import append_rows, create_table, read_target, replace_table, write_csv, write_json
from delaykit.sources.split import split_documents, split_pages


PAGE, PAGES = 500, 64  # flights of a landed page, pages of a landed file


def _folder(spark, name: str) -> str:
    return scratch_path(spark, f"delaykit-{name}-{uuid.uuid4().hex}")


@register("json_sink_roundtrip", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def json_sink_roundtrip(spark, d):
    rows = table(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal")
    path = _folder(spark, "json")
    write_json(rows.limit(1), path)
    write_json(rows, path)  # overwrites
    return spark.read.schema(rows.schema).json(path)


@register("csv_sink_roundtrip", "SELECT c_custkey, c_name, CAST(nullif(c_nationkey, 3) AS DOUBLE) AS c_nationkey FROM customer")
def csv_sink_roundtrip(spark, d):
    rows = table(spark, d, "customer").select("c_custkey", "c_name", F.nullif("c_nationkey", F.lit(3)).cast("double").alias("c_nationkey"))
    path = _folder(spark, "csv")
    write_csv(rows, path)
    return read_csv(spark, path, schema=rows.schema)


# A day at a time: the second write replaces its own days only.
@register("partition_overwrite", """
    SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS month, CASE WHEN o_orderstatus = 'F' THEN 'again' ELSE 'first' END AS run
    FROM orders o WHERE o_orderstatus = 'F'
       OR strftime(o_orderdate, '%Y-%m') NOT IN (SELECT strftime(o_orderdate, '%Y-%m') FROM orders WHERE o_orderstatus = 'F')
""")
def partition_overwrite(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", F.date_format("o_orderdate", "yyyy-MM").alias("month"))
    path = _folder(spark, "days")
    write_csv(o.select("o_orderkey", F.lit("first").alias("run"), "month").repartition("month"), path, partition_by=["month"])
    again = o.filter("o_orderstatus = 'F'").select("o_orderkey", F.lit("again").alias("run"), "month")
    write_csv(again.repartition("month"), path, partition_by=["month"])
    return spark.read.option("header", True).schema("o_orderkey long, run string, month string").csv(path)


@register("table_sinks", """
    SELECT n_nationkey, n_name, 2 AS copies FROM nation WHERE n_nationkey >= 5
    UNION ALL SELECT n_nationkey, n_name, 1 AS copies FROM nation WHERE n_nationkey < 5
""")
def table_sinks(spark, d):
    """Created, replaced with another schema, then appended to in full."""
    n = table(spark, d, "nation").select("n_nationkey", "n_name")
    target = _folder(spark, "table")
    create_table(n.select("n_nationkey"), target)
    replace_table(n, target)
    append_rows(n.filter("n_nationkey >= 5"), target)
    return read_target(spark, target).groupBy("n_nationkey", "n_name").agg(F.count(F.lit(1)).cast("int").alias("copies"))


# Half of the suppliers in files with one header, the rest with another order of columns and one more.
@register("csv_bulk_load", """
    SELECT s_suppkey, s_name, CASE WHEN s_suppkey % 2 = 0 THEN round(s_acctbal, 2) END AS s_acctbal FROM supplier
""")
def csv_bulk_load(spark, d):
    s = table(spark, d, "supplier")
    folder, target = _folder(spark, "interim"), _folder(spark, "suppliers")
    write_csv(s.filter("s_suppkey % 2 = 1").select("s_suppkey", "s_name"), folder, mode="append")
    write_csv(s.filter("s_suppkey % 2 = 0").select("s_acctbal", "s_name", "s_suppkey"), folder, mode="append")
    for _ in range(2):  # the second load adds nothing
        bulk_load_csv(spark, folder, target, "s_suppkey long, s_name string, s_acctbal double")
    return read_target(spark, target).select("s_suppkey", "s_name", F.round("s_acctbal", 2).alias("s_acctbal"))


@register("day_download_roundtrip", """
    SELECT CAST(o_orderkey AS VARCHAR) AS flight_number, o_orderstatus AS departure,
           strftime(date_trunc('month', o_orderdate), '%Y-%m-%dT%H:%M') AS scheduled,
           strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS flight_date
    FROM orders
""")
def day_download_roundtrip(spark, d):
    """Orders as landed flight files for the first of every month, of pages of about ``PAGE`` flights, at most ``PAGES`` a
    file; odd and even months are downloaded apart."""
    o = table(spark, d, "orders").withColumn("at", format_minute(F.date_trunc("month", "o_orderdate")))
    flight = F.struct(
        F.struct(F.col("o_orderstatus").alias("AirportCode"), F.struct(F.col("at").alias("DateTime")).alias("ScheduledTimeLocal")).alias("Departure"),
        F.struct(F.col("o_orderkey").cast("string").alias("FlightNumber")).alias("MarketingCarrier"))
    month = F.substring("at", 1, 7)
    sizes = o.groupBy(month.alias("month")).agg(F.ceil(F.count(F.lit(1)) / PAGE).alias("pages"))
    dealt = o.withColumn("month", month).join(sizes, "month").withColumn("page", F.pmod(F.xxhash64("o_orderkey"), "pages"))
    months = dealt.groupBy("month", "page").agg(F.collect_list(flight).alias("flights"))
    page = F.struct(F.struct(F.struct(F.col("flights").alias("Flight")).alias("Flights"),
                             F.struct(F.size("flights").alias("TotalCount"), F.struct(F.lit("u?x").alias("@Href")).alias("Link")).alias("Meta")
                             ).alias("FlightStatusResource"))
    files = months.groupBy("month", F.floor(F.col("page") / PAGES).alias("file")).agg(F.collect_list(page).alias("data"))
    docs = files.select("month", "file", F.struct(F.concat("month", F.lit("-01T00:00")).alias("start_range")).alias("metadata"), "data")
    landing, out = _folder(spark, "landing"), _folder(spark, "download")
    parts = docs.withColumnRenamed("month", "part")
    write_json(parts.repartition("part", "file"), landing, partition_by=["part", "file"])  # one document a file
    day_download(spark, landing + "/part=*-{01,03,05,07,09,11}/*", out)
    day_download(spark, landing + "/part=*-{02,04,06,08,10,12}/*", out)
    flat = spark.read.option("header", True).option("inferSchema", False).csv(out + "/flat")
    return flat.select(F.col("MarketingCarrier_FlightNumber").alias("flight_number"), F.col("Departure_AirportCode").alias("departure"),
                       F.col("Departure_ScheduledTimeLocal_DateTime").alias("scheduled"), F.col("flight_date").cast("string").alias("flight_date"))


@register("flatten_ragged", """
    SELECT CAST(o_orderkey AS BIGINT) AS key, o_orderstatus AS a_code, CAST(NULL AS VARCHAR) AS a_gate_name, o_orderpriority AS b FROM orders WHERE o_orderkey % 2 = 0
    UNION ALL
    SELECT o_orderkey, o_orderstatus, o_orderpriority, CAST(NULL AS VARCHAR) FROM orders WHERE o_orderkey % 2 = 1
""")
def flatten_ragged(spark, d):
    """Records with different keys: each batch is flattened by its own schema, the union keeps every leaf."""
    o = table(spark, d, "orders").withColumn("key", F.col("o_orderkey").cast("long"))
    plain = o.filter("o_orderkey % 2 = 0").select("key", F.struct(F.col("o_orderstatus").alias("code")).alias("a"), F.col("o_orderpriority").alias("b"))
    gated = o.filter("o_orderkey % 2 = 1").select("key", F.struct(
        F.col("o_orderstatus").alias("code"), F.struct(F.col("o_orderpriority").alias("name")).alias("gate")).alias("a"))
    return union_ragged(flatten(plain), flatten(gated)).select("key", "a_code", "a_gate_name", "b")


# Conversations as landed pages, a turn a flight, with leaves that only some turns have and one of two types.
@register("ragged_documents", """
    SELECT CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR) AS flight_number, role AS departure,
           CASE WHEN turn % 2 = 1 THEN text END AS codeshare,
           CASE WHEN turn % 3 = 0 THEN CAST(turn AS VARCHAR) END AS stop_0, CASE WHEN turn % 3 = 0 THEN CAST(turn + 1 AS VARCHAR) END AS stop_1,
           CASE WHEN turn % 2 = 0 THEN CAST(length(text) AS VARCHAR) ELSE '{"of":"' || role || '"}' END AS note,
           'v' || CAST(conv_id % 3 AS VARCHAR) AS version
    FROM conversations
""")
def ragged_documents(spark, d):
    """Landed twice and stored once as whole documents; every leaf comes back, the unknown ones of flights and pages too."""
    c = table(spark, d, "conversations")
    number = F.concat_ws("-", "conv_id", "turn")
    odd, third = F.col("turn") % 2 == 1, F.col("turn") % 3 == 0
    note = F.when(odd, F.to_json(F.struct(F.struct(F.col("role").alias("of")).alias("Note")))).otherwise(
        F.to_json(F.struct(F.length("text").alias("Note"))))
    flight = F.to_json(F.struct(
        F.struct(F.col("role").alias("AirportCode")).alias("Departure"), F.struct(number.alias("FlightNumber")).alias("MarketingCarrier"),
        F.when(odd, F.struct(F.struct(F.col("text").alias("words")).alias("Partner"))).alias("Codeshare"),
        F.when(third, F.array("turn", F.col("turn") + 1)).alias("Stops")))
    joined = F.concat(F.expr("substring(flight, 1, length(flight) - 1)"), F.lit(","), F.expr("substring(note, 2)"))
    turns = c.select("conv_id", "turn", flight.alias("flight"), note.alias("note")).select("conv_id", "turn", joined.alias("flight"))
    pages = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "flight"))).alias("f")).select(
        "conv_id", F.format_string('{"FlightStatusResource":{"Flights":{"Flight":[%s]},"Meta":{"Version":"v%s"}}}',
                                   F.array_join(F.transform("f", lambda x: x["flight"]), ","), F.col("conv_id") % 3).alias("page"))
    files = pages.groupBy(F.floor(F.col("conv_id") / 50).alias("file")).agg(F.array_join(F.sort_array(F.collect_list("page")), ",").alias("p"))
    landing, store = _folder(spark, "landing"), _folder(spark, "pages")
    for copy in range(2):
        docs = files.select("file", F.format_string('{"metadata":{"copy":%s},"data":[%s]}', F.lit(copy), F.col("p")).alias("value"))
        docs.repartition("file").write.mode("append").partitionBy("file").option("compression", "none").text(f"{landing}/{copy}")
    for copy in range(2):
        store_raw_pages(spark, f"{landing}/{copy}/*", store, glob=None)
    flights = flights_from_page_store(spark, store, all_columns=True, page_leaves={"version": ("Meta", "Version")})
    return flights.select(F.col("MarketingCarrier_FlightNumber").alias("flight_number"), F.col("Departure_AirportCode").alias("departure"),
                          F.col("Codeshare_Partner_words").alias("codeshare"), F.col("Stops_0").alias("stop_0"),
                          F.col("Stops_1").alias("stop_1"), F.col("Note").alias("note"), "version")


@register("append_with_ledger", """
    SELECT l_orderkey, l_linenumber, l_returnflag, l_quantity, count(*) * CASE WHEN l_quantity >= 25 AND l_returnflag = 'R' THEN 2 ELSE 1 END AS copies
    FROM lineitem GROUP BY l_orderkey, l_linenumber, l_returnflag, l_quantity
""")
def append_with_ledger(spark, d):
    """The line items of small quantity, then all of them (those returned twice), then all again: the ledger lets in what isn't stored."""
    rows = table(spark, d, "lineitem").withColumn("month", F.date_format("l_shipdate", "yyyy-MM"))
    name = f"ledger_{uuid.uuid4().hex}"
    ledger = Ledger(spark, name, _folder(spark, "ledger-target"), day="month", buckets=8, path=_folder(spark, "ledger"))
    ledger.append(rows.filter("l_quantity < 25"))
    ledger.append(rows.unionByName(rows.filter("l_returnflag = 'R'")))
    ledger.append(rows)
    spark.sql(f"DROP TABLE {name}")
    keys = ["l_orderkey", "l_linenumber", "l_returnflag", "l_quantity"]
    return read_target(spark, ledger.target).groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))


# Every order is a page with its line items as flights; a landed file holds the orders of 5,000 consecutive keys.
@register("split_landed_file", """
    SELECT CAST(o_orderkey // 5000 AS BIGINT) AS file_no, count(DISTINCT o_orderkey) AS n_pages, count(DISTINCT o_orderkey) - 1 AS last_page,
           count(*) AS n_flights, round(CAST(sum(l_quantity) AS DOUBLE), 2) AS quantity
    FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1
""")
def q_split_landed_file(spark, d):
    li, o = table(spark, d, "lineitem"), table(spark, d, "orders")
    flight = F.struct(F.col("l_linenumber").alias("No"), F.col("l_quantity").cast("double").alias("Quantity"))
    orders = (li.join(o, li.l_orderkey == o.o_orderkey).groupBy("o_orderkey").agg(F.collect_list(flight).alias("Flight"))  # a few lines
              .withColumn("file_no", F.floor(F.col("o_orderkey") / 5000)))
    page = F.to_json(F.struct(F.struct(F.struct("Flight").alias("Flights")).alias("FlightStatusResource")), {"pretty": "true"})
    head = F.concat(F.lit('{\n  "metadata": {\n    "start_range": "'), F.col("file_no"), F.lit('"\n  },\n  "data": [\n'))
    # The window needs a file's pages in one task and in order, so a file is written by one.
    in_file = Window.partitionBy("file_no").orderBy("o_orderkey")
    pages = orders.withColumns({"first": F.lag("o_orderkey").over(in_file).isNull(), "last": F.lead("o_orderkey").over(in_file).isNull()}).select(
        "file_no", "o_orderkey", F.concat(F.when(F.col("first"), head).otherwise(""), page, F.when(F.col("last"), "\n]\n}").otherwise(",")).alias("value"))
    path = _folder(spark, "split")
    pages.sortWithinPartitions("file_no", "o_orderkey").select("file_no", "value").write.partitionBy("file_no").text(path)
    found, _ = split_documents(spark, path, glob="*.txt")
    flights_of_page = F.try_variant_get("page", "$.Flights.Flight", "array<struct<No:long,Quantity:double>>")
    read = split_pages(found).select(F.get_json_object("metadata", "$.start_range").cast("long").alias("file_no"), "page_pos",
                                     flights_of_page.alias("f"))
    return read.groupBy("file_no").agg(
        F.count(F.lit(1)).alias("n_pages"), F.max("page_pos").cast("long").alias("last_page"), F.sum(F.size("f")).cast("long").alias("n_flights"),
        F.round(F.sum(F.aggregate("f", F.lit(0.0), lambda a, x: a + x["Quantity"])), 2).alias("quantity"))
