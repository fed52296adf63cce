"""Training table, folds, model selection and request scoring (M1-M6, B1).

Stand-in: flights are line items (see ``base.flights``); the "weather" of an
(arrival airport, scheduled minute) is a set of aggregates over the flights
at that key; the label is the signed delay in minutes.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from delaykit.functions.timefmt import format_minute
from delaykit.operators.ordering import contiguous_folds
from delaykit.plans import linear, trees
from delaykit.plans import models as M
from delaykit.plans.scoring import first_flight_per_request, score_requests
from delaykit.plans.training import (
    features_from_flights, merge_flights_weather, prepare_flights_for_training, training_table,
)
from delaykit.registry.base import FLIGHTS_SQL, flights, register, rnd, table
from delaykit.session import materialize

FEATURES = ["f_avg_quantity", "f_avg_discount", "f_max_tax", "f_n_lines"]


def _text_flights(spark, d, fl=None):
    fl = flights(spark, d) if fl is None else fl
    return fl.select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax",
        F.col("departure_code").alias("Departure_AirportCode"),
        F.concat(format_minute("scheduled_arrival"), F.lit("Z")).alias("Departure_ScheduledTimeUTC_DateTime"),
        F.col("arrival_code").alias("Arrival_AirportCode"),
        F.concat(format_minute("scheduled_arrival"), F.lit("Z")).alias("Arrival_ScheduledTimeUTC_DateTime"),
        # The sixth line of an order never arrived.
        F.when(F.col("l_linenumber") != 6, F.concat(format_minute("actual_arrival"), F.lit("Z"))).alias("Arrival_ActualTimeUTC_DateTime"))


def _weather(prepared):
    return prepared.groupBy(F.col("Arrival_AirportCode").alias("Airport_Code"),
                            F.col("Arrival_ScheduledTimeUTC_DateTime").alias("Flight_DateTime")).agg(
        F.avg("l_quantity").alias("f_avg_quantity"), F.avg("l_discount").alias("f_avg_discount"),
        F.max("l_tax").alias("f_max_tax"), F.count(F.lit(1)).cast("double").alias("f_n_lines"))


_TEXT_FLIGHTS_SQL = f"""
    SELECT l_orderkey, l_linenumber, l_quantity, l_discount, l_tax, departure_code AS Departure_AirportCode,
           strftime(scheduled_arrival, '%Y-%m-%dT%H:%M') AS Departure_ScheduledTimeUTC_DateTime,
           arrival_code AS Arrival_AirportCode,
           strftime(scheduled_arrival, '%Y-%m-%dT%H:%M') AS Arrival_ScheduledTimeUTC_DateTime,
           strftime(actual_arrival, '%Y-%m-%dT%H:%MZ') AS Arrival_ActualTimeUTC_DateTime
    FROM ({FLIGHTS_SQL}) f
    WHERE l_linenumber <> 6 AND actual_arrival IS NOT NULL AND scheduled_arrival IS NOT NULL
"""


@register("prepare_flights", f"""
    SELECT l_orderkey, l_linenumber, Departure_ScheduledTimeUTC_DateTime, Arrival_ScheduledTimeUTC_DateTime,
           Arrival_ActualTimeUTC_DateTime FROM ({_TEXT_FLIGHTS_SQL}) t
""")
def prepare_flights(spark, d):
    return _prepared(spark, d).select("l_orderkey", "l_linenumber", "Departure_ScheduledTimeUTC_DateTime",
                           "Arrival_ScheduledTimeUTC_DateTime", "Arrival_ActualTimeUTC_DateTime")


def _prepared(spark, d, fl=None):
    return features_from_flights(prepare_flights_for_training(_text_flights(spark, d, fl)))


def _materialized_prepared(spark, d):
    # The join output with its times as text is written once: formatting costs more than the
    # rest of a row's work, and Catalyst would repeat it in every branch, in filter and projection.
    return materialize(_prepared(spark, d), "prepared")


def train_table(spark, d, prepared=None):
    # Both join sides (flights, and the weather aggregated from them) start from the prepared
    # flights: the lineitem x orders join runs once into a table in the shared checkpoint folder.
    prepared = _materialized_prepared(spark, d) if prepared is None else prepared
    merged = merge_flights_weather(prepared, _weather(prepared))
    return training_table(merged, ["l_orderkey", "l_linenumber"], FEATURES)


@register("training_table", f"""
    WITH f AS ({_TEXT_FLIGHTS_SQL}),
    w AS (SELECT Arrival_AirportCode AS Airport_Code, Arrival_ScheduledTimeUTC_DateTime AS Flight_DateTime,
                 avg(l_quantity) AS f_avg_quantity, avg(l_discount) AS f_avg_discount, max(l_tax) AS f_max_tax,
                 CAST(count(*) AS DOUBLE) AS f_n_lines FROM f GROUP BY 1, 2)
    SELECT f.l_orderkey, f.l_linenumber, round(w.f_avg_quantity, 6) AS f_avg_quantity,
           round(w.f_avg_discount, 6) AS f_avg_discount, round(w.f_max_tax, 6) AS f_max_tax, w.f_n_lines,
           round(date_diff('microsecond', strptime(f.Arrival_ScheduledTimeUTC_DateTime, '%Y-%m-%dT%H:%M'),
                 strptime(replace(f.Arrival_ActualTimeUTC_DateTime, 'Z', ''), '%Y-%m-%dT%H:%M')) / 60000000.0, 6)
               AS delay_minutes
    FROM f JOIN w ON f.Arrival_AirportCode = w.Airport_Code AND f.Arrival_ScheduledTimeUTC_DateTime = w.Flight_DateTime
""")
def q_training_table(spark, d):
    t = train_table(spark, d)
    return t.select("l_orderkey", "l_linenumber", *[rnd(F.col(c)).alias(c) for c in FEATURES],
                    rnd(F.col("delay_minutes")).alias("delay_minutes"))


_FOLD_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]


@register("kfold_assign", f"""
    SELECT l_orderkey, l_linenumber, l_partkey, CAST(ntile(3) OVER (ORDER BY {', '.join(_FOLD_ORDER)}) - 1 AS INTEGER) AS fold
    FROM lineitem
""")
def kfold_assign(spark, d):
    li = table(spark, d, "lineitem").select(*_FOLD_ORDER)
    return contiguous_folds(li, _FOLD_ORDER, 3).select("l_orderkey", "l_linenumber", "l_partkey", "fold")


@register("kfold_baseline_mse", f"""
    WITH f AS (SELECT l_quantity AS y, ntile(3) OVER (ORDER BY {', '.join(_FOLD_ORDER)}) - 1 AS fold FROM lineitem),
    s AS (SELECT fold, sum(y) AS sy, count(*) AS n FROM f GROUP BY fold),
    t AS (SELECT sum(sy) AS ty, sum(n) AS tn FROM s),
    m AS (SELECT s.fold, (t.ty - s.sy) / (t.tn - s.n) AS train_mean FROM s, t)
    SELECT CAST(f.fold AS INTEGER) AS fold, count(*) AS n_test, round(-avg(power(f.y - m.train_mean, 2)), 4) AS neg_mse
    FROM f JOIN m ON f.fold = m.fold GROUP BY f.fold
""")
def kfold_baseline_mse(spark, d):
    li = table(spark, d, "lineitem").select(*_FOLD_ORDER)
    folds = contiguous_folds(li, _FOLD_ORDER, 3).select(F.col("l_quantity").alias("y"), "fold")
    # One aggregate per fold (n, sum y, sum y^2) is enough: the baseline of a test fold is the mean
    # label of the other folds, and its squared error expands into these sums.  k rows are windowed.
    y = F.col("y").cast("double")
    per_fold = folds.groupBy("fold").agg(F.sum(y).alias("sy"), F.sum(y * y).alias("syy"), F.count(F.lit(1)).alias("n"))
    everything = Window.partitionBy()
    mean = (F.sum("sy").over(everything) - F.col("sy")) / (F.sum("n").over(everything) - F.col("n"))
    with_mean = per_fold.withColumn("m", mean)
    mse = (F.col("syy") - 2 * F.col("m") * F.col("sy") + F.col("n") * F.col("m") * F.col("m")) / F.col("n")
    return with_mean.select("fold", F.col("n").alias("n_test"), rnd(-mse, 4).alias("neg_mse"))


def _train_with_folds(spark, d):
    t = materialize(train_table(spark, d), "training")  # the sort reads its rows twice
    return contiguous_folds(t, ["l_orderkey", "l_linenumber", *FEATURES, "delay_minutes"], 3)


@register("cv_linear_scores", f"""
    WITH f AS (SELECT l_quantity AS x, l_extendedprice / 1000.0 AS y,
                      ntile(3) OVER (ORDER BY {', '.join(_FOLD_ORDER)}) - 1 AS fold FROM lineitem),
    k AS (SELECT DISTINCT fold FROM f),
    m AS (SELECT k.fold, regr_slope(f.y, f.x) AS b, regr_intercept(f.y, f.x) AS a FROM k JOIN f ON f.fold <> k.fold GROUP BY k.fold)
    SELECT CAST(f.fold AS INTEGER) AS fold, round(-avg(power(f.y - m.a - m.b * f.x, 2)), 3) AS neg_mse
    FROM f JOIN m ON f.fold = m.fold GROUP BY f.fold
""")
def cv_linear_scores(spark, d):
    """Cross-validation scores of a one-feature linear model, fold by fold: what SQL can check of M3."""
    li = table(spark, d, "lineitem").select(*_FOLD_ORDER)
    rows = contiguous_folds(li, _FOLD_ORDER, 3).select(
        F.col("l_quantity").cast("double").alias("x"), (F.col("l_extendedprice") / 1000.0).cast("double").alias("delay_minutes"), "fold")
    rows = materialize(rows, "folds")
    scores = [(i, M.fold_neg_mse(rows, "LinearRegression", ["x"], i)) for i in range(3)]
    return spark.createDataFrame(scores, "fold int, neg_mse double").withColumn("neg_mse", rnd(F.col("neg_mse"), 3))


# Three features: Cramer's rule on the covariances of the rows outside a fold.
def _normal_equations_sql() -> str:
    def det(a, b, c):
        return (f"({a[0]} * ({b[1]} * {c[2]} - {b[2]} * {c[1]}) - {b[0]} * ({a[1]} * {c[2]} - {a[2]} * {c[1]})"
                f" + {c[0]} * ({a[1]} * {b[2]} - {a[2]} * {b[1]}))")
    cols = [[f"v{min(i, j)}{max(i, j)}" for i in range(1, 4)] for j in range(1, 4)]
    y = ["c1", "c2", "c3"]
    base = det(*cols)
    covs = ", ".join(f"covar_pop(x{i}, x{j}) AS v{i}{j}" for i in range(1, 4) for j in range(i, 4))
    return f"""
    k AS (SELECT DISTINCT fold FROM f),
    s AS (SELECT k.fold, avg(x1) AS m1, avg(x2) AS m2, avg(x3) AS m3, avg(y) AS my, {covs},
                 covar_pop(x1, y) AS c1, covar_pop(x2, y) AS c2, covar_pop(x3, y) AS c3
          FROM k JOIN f ON f.fold <> k.fold GROUP BY k.fold),
    m AS (SELECT *, {det(y, cols[1], cols[2])} / {base} AS b1, {det(cols[0], y, cols[2])} / {base} AS b2,
                 {det(cols[0], cols[1], y)} / {base} AS b3 FROM s),
    lin AS (SELECT f.fold, -avg(power(f.y - my - b1 * (x1 - m1) - b2 * (x2 - m2) - b3 * (x3 - m3), 2)) AS neg_mse
            FROM f JOIN m ON f.fold = m.fold GROUP BY f.fold)"""


_FOLDED_SQL = f"""
    f AS (SELECT CAST(l_quantity AS DOUBLE) AS x1, l_discount * 100.0 AS x2, l_tax * 100.0 AS x3, l_extendedprice / 1000.0 AS y,
                 CAST(ntile(3) OVER (ORDER BY {', '.join(_FOLD_ORDER)}) - 1 AS INTEGER) AS fold FROM lineitem)"""


def _folded(spark, d):
    li = table(spark, d, "lineitem").select(*_FOLD_ORDER, "l_discount", "l_tax")
    return materialize(contiguous_folds(li, _FOLD_ORDER, 3).select(
        F.col("l_quantity").cast("double").alias("x1"), (F.col("l_discount") * 100.0).cast("double").alias("x2"),
        (F.col("l_tax") * 100.0).cast("double").alias("x3"), (F.col("l_extendedprice") / 1000.0).cast("double").alias("delay_minutes"),
        "fold"), "folds")


@register("cv_linear_one_pass", f"""
    WITH {_FOLDED_SQL}, {_normal_equations_sql()}
    SELECT fold, round(neg_mse, 3) AS neg_mse FROM lin
""")
def cv_linear_one_pass(spark, d):
    """Scores of a model of three features on every fold, by one aggregate of the training rows."""
    scores = linear.fold_scores(_folded(spark, d), ["x1", "x2", "x3"])
    return spark.createDataFrame(list(scores.items()), "fold int, neg_mse double").withColumn("neg_mse", rnd(F.col("neg_mse"), 3))


_CUTS = {"x1": [10.0, 20.0, 30.0, 40.0], "x2": [1.5, 4.5, 7.5]}
_CUT_ROWS = ", ".join(f"({i}, {c})" for i, cuts in enumerate(_CUTS.values()) for c in cuts)


def _tree_sql(rows: str) -> str:
    """A tree of depth two over the relation ``rows`` (tree, x1, x2, y): the best cut of the root, then of both halves."""
    def best(level, source):
        return f"""
    g{level} AS (SELECT tree, node, feature, cut, count(*) AS n, sum(y) AS s,
                 count(*) FILTER (WHERE x <= cut) AS nl, coalesce(sum(y) FILTER (WHERE x <= cut), 0) AS sl
          FROM (SELECT r.tree, r.node, r.y, c.feature, c.cut, CASE c.feature WHEN 0 THEN x1 ELSE x2 END AS x
                FROM {source} r, (VALUES {_CUT_ROWS}) c(feature, cut)) q GROUP BY tree, node, feature, cut),
    b{level} AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY tree, node ORDER BY
                 sl * sl / nl + (s - sl) * (s - sl) / (n - nl) DESC, feature, cut) AS rn FROM g{level} WHERE nl > 0 AND nl < n) q WHERE rn = 1)"""
    step = "2 * r.node + CASE WHEN CASE b.feature WHEN 0 THEN x1 ELSE x2 END <= b.cut THEN 0 ELSE 1 END"
    return f"""
    r0 AS (SELECT tree, 1 AS node, x1, x2, y FROM {rows}), {best(0, 'r0')},
    r1 AS (SELECT r.tree, {step} AS node, x1, x2, y FROM r0 r JOIN b0 b ON r.tree = b.tree AND r.node = b.node), {best(1, 'r1')},
    r2 AS (SELECT r.tree, {step} AS node, x1, x2, y FROM r1 r JOIN b1 b ON r.tree = b.tree AND r.node = b.node),
    leaf AS (SELECT tree, node, count(*) AS n, avg(y) AS value FROM r2 GROUP BY tree, node)"""


@register("histogram_tree", f"""
    WITH {_FOLDED_SQL}, a AS (SELECT 0 AS tree, * FROM f), {_tree_sql('a')}
    SELECT CAST(node AS INTEGER) AS node, CASE feature WHEN 0 THEN 'x1' ELSE 'x2' END AS feature, CAST(cut AS DOUBLE) AS cut,
           CAST(n AS BIGINT) AS n, round(s / n, 4) AS value FROM (SELECT node, feature, cut, n, s FROM b0 UNION ALL SELECT node, feature, cut, n, s FROM b1) q
    UNION ALL SELECT CAST(node AS INTEGER), NULL, NULL, CAST(n AS BIGINT), round(value, 4) FROM leaf
""")
def q_histogram_tree(spark, d):
    """A tree of depth two with given cuts: every node with its split, rows and mean label."""
    tree = trees.grow(_folded(spark, d), ["x1", "x2"], depth=2, cuts=_CUTS)[0]
    return spark.createDataFrame(tree.rows(), "node int, feature string, cut double, n long, value double").withColumn(
        "value", rnd(F.col("value"), 4))


@register("select_linear_or_tree", f"""
    WITH {_FOLDED_SQL}, {_normal_equations_sql()},
    k2 AS (SELECT DISTINCT fold FROM f), a AS (SELECT k2.fold AS tree, f.* FROM k2 JOIN f ON f.fold <> k2.fold), {_tree_sql('a')},
    t0 AS (SELECT f.*, 2 + CASE WHEN CASE b.feature WHEN 0 THEN x1 ELSE x2 END <= b.cut THEN 0 ELSE 1 END AS node
           FROM f JOIN b0 b ON f.fold = b.tree),
    t1 AS (SELECT t0.* EXCLUDE (node), 2 * t0.node + CASE WHEN CASE b.feature WHEN 0 THEN x1 ELSE x2 END <= b.cut THEN 0 ELSE 1 END AS node
           FROM t0 JOIN b1 b ON t0.fold = b.tree AND t0.node = b.node),
    tr AS (SELECT t1.fold, -avg(power(t1.y - leaf.value, 2)) AS neg_mse FROM t1 JOIN leaf ON t1.fold = leaf.tree AND t1.node = leaf.node GROUP BY t1.fold),
    scores AS (SELECT 'LinearRegression' AS model_name, 0 AS position, avg(neg_mse) AS score FROM lin
               UNION ALL SELECT 'HistogramTree', 1, avg(neg_mse) FROM tr)
    SELECT model_name, position, round(score, 3) AS score,
           model_name = (SELECT model_name FROM scores ORDER BY score DESC, position LIMIT 1) AS is_best FROM scores
""")
def select_linear_or_tree(spark, d):
    """Model selection that SQL can follow: least squares of three features against a tree of depth two, three folds."""
    options = {"HistogramTree": {"depth": 2, "cuts": _CUTS}}
    scores = M.score_models(spark, _folded(spark, d), ["x1", "x2", "x3"], ["LinearRegression", "HistogramTree"], overrides=options)
    return M.select_best(scores).withColumn("score", rnd(F.col("score"), 3))


@register("train_select_best")
def train_select_best(spark, d):
    """All three models with their defaults, three folds (``plans.models.DEFAULTS``)."""
    train = materialize(_train_with_folds(spark, d).select(*FEATURES, "delay_minutes", "fold"), "folds")
    return M.select_best(M.score_models(spark, train, FEATURES, parallelism=3))


# Requests ask for flights from departure code 'R'; the airports divisible by 5 have no weather.
@register("score_requests", f"""
    WITH f AS ({_TEXT_FLIGHTS_SQL}),
    w AS (SELECT Arrival_AirportCode AS c, Arrival_ScheduledTimeUTC_DateTime AS t, avg(l_quantity) AS q FROM f GROUP BY 1, 2),
    tr AS (SELECT w.q AS x, date_diff('microsecond', strptime(f.Arrival_ScheduledTimeUTC_DateTime, '%Y-%m-%dT%H:%M'),
                  strptime(replace(f.Arrival_ActualTimeUTC_DateTime, 'Z', ''), '%Y-%m-%dT%H:%M')) / 60000000.0 AS y
           FROM f JOIN w ON f.Arrival_AirportCode = w.c AND f.Arrival_ScheduledTimeUTC_DateTime = w.t),
    m AS (SELECT regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM tr),
    fl AS (SELECT DISTINCT Arrival_AirportCode AS c, Departure_ScheduledTimeUTC_DateTime AS t FROM f
           WHERE Departure_AirportCode = 'R'),
    r AS (SELECT 'req-' || o_orderkey AS task_uuid, CAST(o_custkey AS VARCHAR) AS c,
                 strftime(o_orderdate, '%Y-%m-%dT%H:%M') AS t FROM orders)
    SELECT r.task_uuid, CASE WHEN w.q IS NOT NULL THEN 'success' ELSE 'failed' END AS state,
           round(m.a + m.b * w.q, 0) AS prediction,
           CASE WHEN fl.c IS NULL THEN 'no flight at that departure time'
                WHEN w.c IS NULL THEN 'no weather forecast for the flight' ELSE 'delay predicted' END AS message
    FROM r CROSS JOIN m LEFT JOIN fl ON r.c = fl.c AND r.t = fl.t
    LEFT JOIN w ON fl.c = w.c AND fl.t = w.t AND CAST(w.c AS INTEGER) % 5 <> 0
""")
def q_score_requests(spark, d):
    # Training and scoring both start from the prepared flights: computed once, written to the
    # shared checkpoint folder, read by both.
    prepared = _materialized_prepared(spark, d)
    model = M.fit_best(train_table(spark, d, prepared), "LinearRegression", ["f_avg_quantity"])
    weather = _weather(prepared).filter(F.col("Airport_Code").cast("int") % 5 != 0)
    twice = weather.unionByName(weather.withColumn("f_avg_quantity", F.col("f_avg_quantity") - 1))  # fetched again: the larger stays
    # Departure local time of the stand-in flight = its scheduled minute.
    fl = prepared.withColumn("Departure_ScheduledTimeLocal_DateTime", F.col("Departure_ScheduledTimeUTC_DateTime"))
    firsts = first_flight_per_request(fl, "Arrival_AirportCode", "Departure_ScheduledTimeLocal_DateTime",
                                      ["l_orderkey", "l_linenumber"],
                                      ["Arrival_ScheduledTimeUTC_DateTime"], departure="R")
    o = table(spark, d, "orders")
    requests = o.select(F.concat(F.lit("req-"), F.col("o_orderkey").cast("string")).alias("task_uuid"),
                        F.col("o_custkey").cast("string").alias("arrival_iata_code"),
                        format_minute("o_orderdate").alias("scheduled_departure_local_time"))
    scored = score_requests(requests, firsts, twice, model, ["f_avg_quantity"])
    return scored.withColumn("prediction", rnd(F.col("prediction"), 0))
