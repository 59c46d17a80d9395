import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import rows
from dockline.functions import columns as C
from dockline.operators import forecast as FC
from dockline.operators import trips as O


@pytest.fixture(scope="module")
def days(spark):
    """Counts that depend on zone and weekday only: a tree or a line can learn them."""
    start = dt.date(2016, 5, 1)
    base = {"A": 10, "B": 30, "C": 55}
    data = [(z, start + dt.timedelta(days=d), b + (7 if (start + dt.timedelta(days=d)).weekday() in (5, 6) else 0))
            for z, b in base.items() for d in range(80)]
    df = spark.createDataFrame(data, "start_zone string, start_date date, trip_count long")
    return df.withColumns(C.calendar_basics(F.col("start_date"))).cache()


@pytest.fixture(scope="module")
def linear(days):
    return FC.TripPredictor("linear_regression").train(days)


@pytest.fixture(scope="module")
def forest(days):
    return FC.TripPredictor("random_forest", trees=10, depth=5).train(days, folds=None)


def test_unknown_model_type():
    with pytest.raises(ValueError, match="model_type is one of"):
        FC.TripPredictor("boosting")


def test_untrained_model_refuses(days, spark):
    fresh = FC.TripPredictor("linear_regression")
    for call in (lambda: fresh.predict(days), lambda: fresh.feature_importance(spark), lambda: fresh.save("/tmp/none", spark)):
        with pytest.raises(ValueError, match="trained"):
            call()


def test_split_is_stable_and_whole(days):
    train, test = FC.train_test(days)
    assert train.count() + test.count() == days.count() and 20 <= test.count() <= 80
    assert rows(test) == rows(FC.train_test(days.repartition(7))[1])


def test_linear_scores(linear):
    assert linear.scores["test_r2"] > 0.999 and linear.scores["train_rmse"] < 0.01 and linear.scores["cv_r2_mean"] > 0.999


def test_forest_scores_and_importance(forest, spark):
    assert forest.scores["test_r2"] > 0.95 and forest.scores["cv_r2_std"] == 0.0
    importance = forest.feature_importance(spark)
    names = [r.feature for r in importance.collect()]
    assert set(names) == {"day_of_week", "month", "is_weekend", "zone_A", "zone_B", "zone_C"}
    assert math.isclose(sum(r.importance for r in importance.collect()), 1.0, rel_tol=1e-6)
    assert forest.feature_importance(spark, 2).count() == 2 and names[0].startswith("zone_")


def test_linear_model_has_no_importance(linear, spark):
    assert linear.feature_importance(spark).count() == 0


def test_forecast(linear, spark):
    zones = spark.createDataFrame([("A",), ("B",), ("A",)], "start_zone string")
    got = {(r.start_zone, r.start_date): r.predicted_trips for r in linear.forecast(zones, dt.date(2016, 6, 17), dt.date(2016, 6, 18)).collect()}
    assert {k: round(v, 3) for k, v in got.items()} == {
        ("A", dt.date(2016, 6, 17)): 10.0, ("A", dt.date(2016, 6, 18)): 17.0,
        ("B", dt.date(2016, 6, 17)): 30.0, ("B", dt.date(2016, 6, 18)): 37.0}
    one = linear.forecast_one(spark, "C", dt.date(2016, 6, 18), extra={"weather": 3.0})
    assert round(one.first().predicted_trips, 3) == 62.0


def test_unknown_zone_is_forecast_without_zone(linear, forest, spark):
    for model in (linear, forest):
        assert np.isfinite(model.forecast_one(spark, "Nowhere", dt.date(2016, 6, 18)).first().predicted_trips)


def test_missing_columns_are_zero_and_extra_ones_ignored(linear, spark):
    bare = spark.createDataFrame([("A", "x")], "start_zone string, note string")
    full = spark.createDataFrame([("A", 0, 0, False)], "start_zone string, day_of_week int, month int, is_weekend boolean")
    got = linear.predict(bare)
    assert got.columns == ["start_zone", "note", "prediction"]
    assert math.isclose(got.first().prediction, linear.predict(full).first().prediction)


def test_save_and_load(linear, forest, spark, folder):
    for name, model in (("l", linear), ("f", forest)):
        model.save(f"{folder}/{name}", spark)
        loaded = FC.TripPredictor.load(f"{folder}/{name}", spark)
        zones = spark.createDataFrame([("A",), ("C",)], "start_zone string")
        assert rows(loaded.forecast(zones, dt.date(2016, 6, 17))) == rows(model.forecast(zones, dt.date(2016, 6, 17)))
        assert loaded.scores == model.scores and loaded.model_type == model.model_type


def test_advanced_model_uses_zone_when_forecasting(days, spark):
    means = O.zone_means(days)
    model = FC.TripPredictor("random_forest", advanced=True, trees=10, depth=5, zone_means=means).train(O.advanced_features(days), folds=None)
    zones = spark.createDataFrame([("A",), ("C",)], "start_zone string")
    got = {r.start_zone: r.predicted_trips for r in model.forecast(zones, dt.date(2016, 6, 15)).collect()}
    assert got["A"] < 20 < 45 < got["C"]


def test_tiny_training_set(spark):
    tiny = spark.createDataFrame([("A", dt.date(2016, 1, d), d) for d in (1, 2, 3, 4)], "start_zone string, start_date date, trip_count long")
    model = FC.TripPredictor("linear_regression").train(tiny.withColumns(C.calendar_basics(F.col("start_date"))), test_share=0.5)
    assert set(model.scores) >= {"train_r2", "train_mae", "train_rmse", "cv_r2_mean", "cv_r2_std"}


def test_metrics_formulas(spark):
    df = spark.createDataFrame([(3, 2.5), (5, 5.0), (2, 4.0)], "trip_count long, prediction double")
    got = FC.metrics(df).first()
    y, p = np.array([3, 5, 2]), np.array([2.5, 5.0, 4.0])
    assert np.isclose(got.r2, 1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum())
    assert np.isclose(got.mae, np.abs(y - p).mean()) and np.isclose(got.rmse, np.sqrt(((y - p) ** 2).mean()))


def test_one_hot(spark):
    df = spark.createDataFrame([("A", 1), ("B", 2), (None, 3)], "start_zone string, n int")
    assert rows(FC.one_hot(df, {"start_zone": ["A", "B"]}), "n", "zone_A", "zone_B") == [(1, 1, 0), (2, 0, 1), (3, 0, 0)]


def test_comparison_and_records(linear, forest, spark):
    scored = FC.scores_frame(spark, {"linear_regression": linear, "random_forest": forest})
    best = max((linear, forest), key=lambda p: p.scores["test_r2"]).model_type
    assert FC.best_model(scored).first().model == best
    records = FC.run_records(spark, "r1", forest)
    kinds = {r.kind: r["count"] for r in records.groupBy("kind").count().collect()}
    assert kinds["importance"] == 6 and kinds["param"] == 3 and kinds["metric"] == 8


def test_a_large_forest_grows_in_groves(days, spark, folder, monkeypatch):
    assert [(g.getNumTrees(), g.getMaxDepth()) for g in FC.groves(100, 30, 60_000)] == [(10, 30)] * 10
    assert len({g.getSeed() for g in FC.groves(100, 30, 60_000)}) == 10
    assert [(g.getNumTrees(), g.getSeed(), g.getPredictionCol()) for g in FC.groves(100, 30, 10_000)] == [(100, FC.SEED, "prediction")]
    monkeypatch.setattr(FC, "GROVE_ROWS", 100)
    model = FC.TripPredictor("random_forest", trees=25, depth=5).train(days, folds=3)
    grown = [s for s in model.model.stages if hasattr(s, "getNumTrees")]
    assert [m.getNumTrees for m in grown] == [10, 10, 5] and model.scores["test_r2"] > 0.95 and model.scores["cv_r2_mean"] > 0.9
    every = model.model.transform(model._aligned(days)).collect()
    for r in every:
        assert np.isclose(r.prediction, (10 * r.grove_0 + 10 * r.grove_1 + 5 * r.grove_2) / 25)
    importance = {r.feature: r.importance for r in model.feature_importance(spark).collect()}
    assert math.isclose(sum(importance.values()), 1.0, rel_tol=1e-9) and len(importance) == 6 and model.scaling(spark).count() == 6
    model.save(folder, spark)
    assert rows(FC.TripPredictor.load(folder, spark).predict(days)) == rows(model.predict(days))
