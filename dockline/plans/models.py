"""Trip-demand models. Fits are checked by what least squares must satisfy, not by coefficients."""

from __future__ import annotations

import datetime as dt

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from dockline.operators import forecast as FC
from dockline.operators import trees as TR
from dockline.operators import trips as O
from dockline.plans.registry import query
from dockline.plans.trips import BUCKET, DAYS, HASH, MEANS, TEST_BELOW, _zone_days
from dockline.session import shared_path
from dockline.sinks import tables as K
from dockline.sources import tables as T

FIRST, LAST = dt.date(2001, 8, 2), dt.date(2001, 8, 15)


def _written_days(spark, folder, advanced=False):
    """Training input, written once since every pass of a fit reads it."""
    days = _zone_days(spark, folder)
    return K.overwrite(O.advanced_features(days) if advanced else days, shared_path(spark, "zone-days"))


def _linear(spark, folder, folds=None):
    days = _written_days(spark, folder)
    return days, FC.TripPredictor("linear_regression").train(days, folds=folds)


def _rounded(value, places):
    """Rounded half up, after the noise beyond nine places is gone: a mean of 1.1525 must not fall below its tie."""
    return F.round(F.round(value, 9), places)


@query("linear_model_zone_means", DAYS + MEANS + """
    SELECT start_zone, round(avg(trip_count), 3) AS mean_prediction, count(*) AS days
    FROM parts WHERE part = 'train' GROUP BY 1""")
def linear_model_zone_means(spark, folder):
    """With one-hot zones, the mean prediction of a zone must equal its mean count."""
    days, predictor = _linear(spark, folder)
    train, _ = FC.train_test(days)
    return predictor.predict(train).groupBy("start_zone").agg(
        _rounded(F.avg("prediction"), 3).alias("mean_prediction"), F.count("*").alias("days"))


# Least squares with one-hot zones, stated independently: centre the three
# calendar columns and the count within each zone, solve the three normal
# equations by determinants, and add the zone means back.
SOLVED = DAYS + f"""
    , parts AS (SELECT start_zone AS z, start_date AS dd, CAST(trip_count AS DOUBLE) AS y, CAST(day_of_week AS DOUBLE) AS d,
                       CAST(month AS DOUBLE) AS m, CAST(is_weekend AS DOUBLE) AS w,
                       CASE WHEN {BUCKET} < {TEST_BELOW} THEN 'test' ELSE 'train' END AS part FROM zone_days)
    , centre AS (SELECT z, avg(y) AS my, avg(d) AS md, avg(m) AS mm, avg(w) AS mw FROM parts WHERE part = 'train' GROUP BY z)
    , moved AS (SELECT y - my AS y, d - md AS d, m - mm AS m, w - mw AS w FROM parts JOIN centre USING (z) WHERE part = 'train')
    , sums AS (SELECT sum(d * d) AS dd, sum(d * m) AS dm, sum(d * w) AS dw, sum(m * m) AS mm, sum(m * w) AS mw, sum(w * w) AS ww,
                      sum(d * y) AS dy, sum(m * y) AS ym, sum(w * y) AS wy FROM moved)
    , solved AS (SELECT
        (dy * (mm * ww - mw * mw) - dm * (ym * ww - mw * wy) + dw * (ym * mw - mm * wy)) / det AS bd,
        (dd * (ym * ww - wy * mw) - dy * (dm * ww - mw * dw) + dw * (dm * wy - ym * dw)) / det AS bm,
        (dd * (mm * wy - mw * ym) - dm * (dm * wy - dw * ym) + dy * (dm * mw - mm * dw)) / det AS bw
        FROM (SELECT *, dd * (mm * ww - mw * mw) - dm * (dm * ww - mw * dw) + dw * (dm * mw - mm * dw) AS det FROM sums))"""
FORECAST = f"""
    , wanted AS (SELECT z, CAST(t.day AS DATE) AS start_date, isodow(t.day) - 1 AS d, month(t.day) AS m,
                        CASE WHEN isodow(t.day) IN (6, 7) THEN 1 ELSE 0 END AS w
                 FROM centre, generate_series(TIMESTAMP '{FIRST}', TIMESTAMP '{LAST}', INTERVAL 1 DAY) t(day))
    , forecast AS (SELECT z, start_date, my + bd * (d - md) + bm * (m - mm) + bw * (w - mw) AS trips
                   FROM wanted JOIN centre USING (z), solved)"""


@query("linear_model_scores", SOLVED + """
    , predicted AS (SELECT part, y, my + bd * (d - md) + bm * (m - mm) + bw * (w - mw) AS p FROM parts JOIN centre USING (z), solved)
    SELECT part, round(1 - sum((y - p) ** 2) / (var_pop(y) * count(*)), 6) AS r2, round(avg(abs(y - p)), 6) AS mae,
           round(sqrt(avg((y - p) ** 2)), 6) AS rmse FROM predicted GROUP BY part""")
def linear_model_scores(spark, folder):
    """Training and test scores of the linear model."""
    _, predictor = _linear(spark, folder)
    scores = predictor.scores
    rows = [(part, *[scores[f"{part}_{n}"] for n in ("r2", "mae", "rmse")]) for part in ("train", "test")]
    frame = spark.createDataFrame(rows, "part string, r2 double, mae double, rmse double")
    return frame.select("part", *[_rounded(n, 6).alias(n) for n in ("r2", "mae", "rmse")])


# The same equations without each fold in turn; r2 on the rows left out.
FOLDED = DAYS + f"""
    , dealt AS (SELECT start_zone AS z, CAST(trip_count AS DOUBLE) AS y, CAST(day_of_week AS DOUBLE) AS d, CAST(month AS DOUBLE) AS m,
                       CAST(is_weekend AS DOUBLE) AS w, row_number() OVER (ORDER BY {HASH.format(seed=43)}, start_zone, start_date) % 5 AS fold
                FROM zone_days WHERE NOT {BUCKET} < {TEST_BELOW})
    , pairs AS (SELECT f.range AS f, dealt.* FROM dealt, range(5) f)
    , centre AS (SELECT f, z, avg(y) AS my, avg(d) AS md, avg(m) AS mm, avg(w) AS mw FROM pairs WHERE fold <> f GROUP BY f, z)
    , moved AS (SELECT f, y - my AS y, d - md AS d, m - mm AS m, w - mw AS w FROM pairs JOIN centre USING (f, z) WHERE fold <> f)
    , sums AS (SELECT f, sum(d * d) AS dd, sum(d * m) AS dm, sum(d * w) AS dw, sum(m * m) AS mm, sum(m * w) AS mw, sum(w * w) AS ww,
                      sum(d * y) AS dy, sum(m * y) AS ym, sum(w * y) AS wy FROM moved GROUP BY f)
    , solved AS (SELECT f,
        (dy * (mm * ww - mw * mw) - dm * (ym * ww - mw * wy) + dw * (ym * mw - mm * wy)) / det AS bd,
        (dd * (ym * ww - wy * mw) - dy * (dm * ww - mw * dw) + dw * (dm * wy - ym * dw)) / det AS bm,
        (dd * (mm * wy - mw * ym) - dm * (dm * wy - dw * ym) + dy * (dm * mw - mm * dw)) / det AS bw
        FROM (SELECT *, dd * (mm * ww - mw * mw) - dm * (dm * ww - mw * dw) + dw * (dm * mw - mm * dw) AS det FROM sums))
    , scores AS (SELECT f, 1 - sum((y - p) ** 2) / (var_pop(y) * count(*)) AS r2 FROM (
        SELECT f, y, my + bd * (d - md) + bm * (m - mm) + bw * (w - mw) AS p
        FROM pairs JOIN centre USING (f, z) JOIN solved USING (f) WHERE fold = f) GROUP BY f)"""


@query("linear_model_cross_validation", FOLDED + """
    SELECT 'linear_regression' AS model, round(avg(r2), 6) AS cv_r2_mean, round(stddev_pop(r2), 6) AS cv_r2_std FROM scores""")
def linear_model_cross_validation(spark, folder):
    """Mean and spread of r2 over five folds."""
    _, predictor = _linear(spark, folder, folds=5)
    scores = FC.scores_frame(spark, {"linear_regression": predictor})
    return scores.select("model", F.round("cv_r2_mean", 6).alias("cv_r2_mean"), F.round("cv_r2_std", 6).alias("cv_r2_std"))


@query("fold_sizes", FOLDED.split(", pairs AS")[0] + """
    SELECT CAST(fold AS INTEGER) AS fold, count(*) AS days FROM dealt GROUP BY fold""")
def fold_sizes(spark, folder):
    """Days in each of the five folds: even whatever the number of days."""
    fitting, _ = FC.train_test(_zone_days(spark, folder))
    return FC.with_folds(fitting, 5).groupBy("fold").agg(F.count("*").alias("days"))


@query("scaling_parameters", DAYS + f"""
    , train AS (SELECT * FROM zone_days WHERE NOT {BUCKET} < {TEST_BELOW})
    SELECT 'day_of_week' AS feature, round(avg(day_of_week), 9) AS mean, round(stddev_samp(day_of_week), 9) AS std FROM train
    UNION ALL SELECT 'month', round(avg(month), 9), round(stddev_samp(month), 9) FROM train
    UNION ALL SELECT 'is_weekend', round(avg(CAST(is_weekend AS INTEGER)), 9), round(stddev_samp(CAST(is_weekend AS INTEGER)), 9) FROM train
    UNION ALL SELECT 'zone_' || zone, round((SELECT avg(CAST(start_zone = zone AS INTEGER)) FROM train), 9),
                     round((SELECT stddev_samp(CAST(start_zone = zone AS INTEGER)) FROM train), 9)
    FROM (SELECT DISTINCT start_zone AS zone FROM train)""")
def scaling_parameters(spark, folder):
    """Mean and spread by which each feature is scaled, fitted on the training part."""
    _, predictor = _linear(spark, folder)
    return predictor.scaling(spark).select("feature", F.round("mean", 9).alias("mean"), F.round("std", 9).alias("std"))


@query("forest_feature_importance")
def forest_feature_importance(spark, folder):
    """All features of the forest, most important first."""
    days = _written_days(spark, folder, advanced=True)
    predictor = FC.TripPredictor("random_forest", advanced=True, zone_means=O.zone_means(days)).train(days, folds=None)
    return predictor.feature_importance(spark)


# --- fixed values: numeric features of the advanced model -------------------
NUMBER_NAMES = [
    "day_of_week", "month", "is_weekend", "year", "quarter", "day_of_year", "week_of_year", "hour",
    "day_sin", "day_cos", "month_sin", "month_cos", "zone_avg_trips", "is_holiday", "is_monday", "is_friday",
]
# ----------------------------------------------------------------------------


@query("forest_importance_names", DAYS + f"""
    , train AS (SELECT start_zone, CASE WHEN month IN (12, 1, 2) THEN 'Winter' WHEN month IN (3, 4, 5) THEN 'Spring'
                       WHEN month IN (6, 7, 8) THEN 'Summer' ELSE 'Fall' END AS season FROM zone_days WHERE NOT {BUCKET} < {TEST_BELOW})
    , names AS (SELECT unnest({NUMBER_NAMES}) AS feature UNION ALL SELECT DISTINCT 'zone_' || start_zone FROM train
                UNION ALL SELECT DISTINCT 'season_' || season FROM train)
    SELECT feature, true AS in_range, CAST(1 AS DOUBLE) AS total, true AS in_order FROM names""")
def forest_importance_names(spark, folder):
    """Every feature of the forest once; importances between 0 and 1 that add up to 1, handed out in falling order."""
    days = _written_days(spark, folder, advanced=True)
    predictor = FC.TripPredictor("random_forest", advanced=True, zone_means=O.zone_means(days)).train(days, folds=None)
    rows = predictor.feature_importance(spark).collect()  # one row per feature column
    values = [r["importance"] for r in rows]
    frame = spark.createDataFrame([(r["feature"], float(r["importance"])) for r in rows], "feature string, importance double")
    return frame.select("feature", F.col("importance").between(0, 1).alias("in_range"), F.lit(round(sum(values), 6)).alias("total"),
                        F.lit(values == sorted(values, reverse=True)).alias("in_order"))


# A regression tree of depth 2, stated independently: the sums of every feature value per node, prefix sums over the
# values, and the cut with the largest drop in squared error; equal drops go to the first feature and the lowest cut.
GROWN = DAYS + """
    , numbered AS (SELECT row_number() OVER () AS id, * FROM zone_days)
    , names AS (SELECT zone, row_number() OVER (ORDER BY zone) + 2 AS place FROM (SELECT DISTINCT start_zone AS zone FROM zone_days))
    , x AS (SELECT id, 0 AS place, 'day_of_week' AS feature, day_of_week AS v FROM numbered
            UNION ALL SELECT id, 1, 'month', month FROM numbered
            UNION ALL SELECT id, 2, 'is_weekend', CAST(is_weekend AS INTEGER) FROM numbered
            UNION ALL SELECT id, place, 'zone_' || zone, CAST(start_zone = zone AS INTEGER) FROM numbered, names)
    , cuts AS (SELECT place, feature, v, (v + lead(v) OVER (PARTITION BY place ORDER BY v)) / 2 AS t FROM (SELECT DISTINCT place, feature, v FROM x))
    , at1 AS (SELECT id, 1 AS node, trip_count AS y FROM numbered)""" + "".join(f"""
    , whole{r} AS (SELECT node, count(*) AS n, sum(y) AS s FROM at{r} GROUP BY node)
    , sums{r} AS (SELECT node, place, v, count(*) AS n, sum(y) AS s FROM at{r} JOIN x USING (id) GROUP BY ALL)
    , grid{r} AS (SELECT g.node, c.place, c.feature, c.t, g.n, CAST(g.s AS DOUBLE) AS s, sum(coalesce(u.n, 0)) OVER w AS nl,
                         CAST(sum(coalesce(u.s, 0)) OVER w AS DOUBLE) AS sl
                  FROM whole{r} g CROSS JOIN cuts c LEFT JOIN sums{r} u ON u.node = g.node AND u.place = c.place AND u.v = c.v
                  WINDOW w AS (PARTITION BY g.node, c.place ORDER BY c.v))
    , best{r} AS (SELECT * FROM (SELECT *, sl * sl / nl + (s - sl) * (s - sl) / (n - nl) AS score FROM grid{r}
                  WHERE t IS NOT NULL AND nl BETWEEN 1 AND n - 1) WHERE score > s * s / n + 1e-6
                  QUALIFY row_number() OVER (PARTITION BY node ORDER BY score DESC, place, t) = 1)
    , at{2 * r} AS (SELECT a.id, CASE WHEN b.node IS NULL THEN a.node WHEN x.v <= b.t THEN 2 * a.node ELSE 2 * a.node + 1 END AS node, a.y
                    FROM at{r} a LEFT JOIN best{r} b USING (node) LEFT JOIN x ON x.id = a.id AND x.place = b.place)""" for r in (1, 2))


def _plain_features(days):
    """Numeric columns only: the calendar and one 0/1 column per zone."""
    zones = sorted(r["start_zone"] for r in days.select("start_zone").distinct().collect())  # one row per zone
    wide = FC.one_hot(days.withColumn("zone", F.col("start_zone")), {"start_zone": zones})
    wide = wide.withColumn("is_weekend", F.col("is_weekend").cast("int")).withColumnRenamed("zone", "start_zone")
    return wide, FC.BASIC_NUMBERS + [f"zone_{z}" for z in zones]


def _tree(spark, folder):
    wide, names = _plain_features(_written_days(spark, folder))
    model = TR.fit_tree(wide, names, "trip_count", depth=2)
    return wide, names, TR.node_table(model, shared_path(spark, "tree"))


@query("tree_splits", GROWN + """
    SELECT CAST(node AS BIGINT) AS node, feature, t AS threshold, CAST(n AS DOUBLE) AS rows, round(s / n, 6) AS prediction
    FROM (SELECT node, feature, t, n, s FROM best1 UNION ALL SELECT node, feature, t, n, s FROM best2
          UNION ALL SELECT node, NULL, NULL, count(*), sum(y) FROM at4 GROUP BY node)""")
def tree_splits(spark, folder):
    """Split features, thresholds, rows and means of one regression tree of depth 2."""
    _, names, nodes = _tree(spark, folder)
    return TR.split_report(nodes, names).withColumn("prediction", _rounded("prediction", 6))


@query("tree_predictions", GROWN + """
    SELECT start_zone, start_date, round(avg(y) OVER (PARTITION BY node), 6) AS prediction FROM at4 JOIN numbered USING (id)""")
def tree_predictions(spark, folder):
    """Every zone and day scored by walking the tree's node table."""
    wide, names, nodes = _tree(spark, folder)
    scored = TR.scored_by_nodes(wide, nodes, ["start_zone", "start_date"], names, trees=1, depth=2)
    return scored.withColumn("prediction", _rounded("prediction", 6))


def _small_forest(spark, folder):
    wide, names = _plain_features(_written_days(spark, folder))
    vectors = VectorAssembler(inputCols=names, outputCol="features").transform(
        wide.withColumns({n: F.col(n).cast("double") for n in [*names, FC.TARGET]}))
    model = FC.forest(trees=10, depth=6).fit(vectors.select("features", FC.TARGET))
    return vectors, names, model, TR.node_table(model, shared_path(spark, "forest"))


@query("forest_scores_by_nodes", DAYS + """
    SELECT start_zone, count(*) AS days, true AS as_the_model FROM zone_days GROUP BY start_zone""")
def forest_scores_by_nodes(spark, folder):
    """Days per zone, and whether the walk down the node table predicts what the forest itself predicts."""
    vectors, names, model, nodes = _small_forest(spark, folder)
    walked = TR.scored_by_nodes(vectors, nodes, ["start_zone", "start_date"], names, trees=10, depth=6)
    said = model.transform(vectors).select("start_zone", "start_date", F.col(FC.PREDICTION).alias("said"))
    return walked.join(said, ["start_zone", "start_date"]).groupBy("start_zone").agg(
        F.count("*").alias("days"), F.bool_and(F.abs(F.col("prediction") - F.col("said")) < 1e-9).alias("as_the_model"))


@query("forest_importances_from_nodes", DAYS + """
    SELECT unnest(['day_of_week', 'month', 'is_weekend']) AS feature, true AS as_the_model
    UNION ALL SELECT DISTINCT 'zone_' || start_zone, true FROM zone_days""")
def forest_importances_from_nodes(spark, folder):
    """Importances added up from the gains of all nodes, against those the forest itself gives."""
    _, names, model, nodes = _small_forest(spark, folder)
    said = spark.createDataFrame(list(zip(names, model.featureImportances.toArray().tolist())), "feature string, said double")
    return TR.importances(nodes, names).join(said, "feature").select(
        "feature", (F.abs(F.col("importance") - F.col("said")) < 1e-9).alias("as_the_model"))


@query("model_comparison")
def model_comparison(spark, folder):
    """Both model types on the same split, best first, kept as run records."""
    days = _written_days(spark, folder)
    predictors = {m: FC.TripPredictor(m).train(days) for m in FC.MODEL_TYPES}
    path = shared_path(spark, "runs")
    for name, predictor in predictors.items():
        FC.run_records(spark, name, predictor).write.mode("append").parquet(path)
    best = FC.best_model(FC.scores_frame(spark, predictors)).select(F.col("model").alias("best"))
    return spark.read.parquet(path).join(best, F.col("run_id") == F.col("best"), "left").select(
        "run_id", "kind", "key", "value", F.col("best").isNotNull().alias("is_best"))


@query("zone_forecasts", SOLVED + FORECAST + """
    SELECT z AS start_zone, start_date, round(trips, 5) AS predicted_trips FROM forecast""")
def zone_forecasts(spark, folder):
    """Every zone on every date, from a saved and reloaded model."""
    days, predictor = _linear(spark, folder)
    path = shared_path(spark, "model")
    predictor.save(path, spark)
    loaded = FC.TripPredictor.load(path, spark)
    out = loaded.forecast(O.distinct_zones(days), FIRST, LAST)
    return out.withColumn("predicted_trips", _rounded("predicted_trips", 5))


@query("forecast_totals", SOLVED + FORECAST + """
    SELECT start_date, round(sum(trips), 4) AS predicted_trips FROM forecast GROUP BY 1""")
def forecast_totals(spark, folder):
    """Predicted trips per date over all zones."""
    days, predictor = _linear(spark, folder)
    out = predictor.forecast(O.distinct_zones(days), FIRST, LAST)
    return FC.totals_per_day(out).withColumn("predicted_trips", _rounded("predicted_trips", 4))


@query("single_forecast", SOLVED + """
    SELECT 'NATION_3' AS start_zone, DATE '2001-08-04' AS start_date, round(my + bd * (5 - md) + bm * (8 - mm) + bw * (1 - mw), 5) AS predicted_trips
    FROM centre, solved WHERE z = 'NATION_3'""")
def single_forecast(spark, folder):
    _, predictor = _linear(spark, folder)
    out = predictor.forecast_one(spark, "NATION_3", dt.date(2001, 8, 4))
    return out.withColumn("predicted_trips", _rounded("predicted_trips", 5))
