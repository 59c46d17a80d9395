"""Least squares from sums, trees as tables, fits side by side."""

import random
import threading

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from dockline.operators import forecast as FC
from dockline.operators import leastsquares as LS
from dockline.operators import trees as TR


@pytest.fixture(scope="module")
def made(spark):
    pick = random.Random(5)
    rows = []
    for i in range(300):
        a, b, zone = pick.random(), pick.randint(0, 6), pick.choice(["A", "B", "C", None])
        rows.append((a, b, float(b), 2001.0, zone, 3 * a - b + {"A": 5, "B": 1, "C": -2, None: 0}[zone] + pick.gauss(0, 0.1), i % 4))
    return spark.createDataFrame(rows, "a double, b int, twice double, fixed double, zone string, y double, fold int").repartition(3).cache()


NUMBERS = ["a", "b", "twice", "fixed"]


def design(rows):
    zones = sorted({r["zone"] for r in rows} - {None})
    return np.array([[1.0] + [float(r[n]) for n in NUMBERS] + [float(r["zone"] == z) for z in zones] for r in rows]), np.array([r["y"] for r in rows])


def test_line_equals_a_solver_over_all_rows(made):
    rows = made.collect()
    sums = LS.moments(made, NUMBERS, ["zone"], "y", "fold")
    fit = LS.LinearFit.of(sums)
    x, y = design(rows)
    best = x @ np.linalg.lstsq(x, y, rcond=None)[0]
    got = {(r["a"], r["zone"]): r["prediction"] for r in fit.transform(made).collect()}
    assert np.allclose([got[r["a"], r["zone"]] for r in rows], best, atol=1e-9)
    assert fit.numbers["fixed"] == 0.0 and np.isclose(fit.numbers["b"], fit.numbers["twice"])  # equal columns share the effect
    assert np.allclose(fit.means, x[:, 1:].mean(0)) and np.allclose(fit.deviations, x[:, 1:].std(0, ddof=1), atol=1e-9)


def test_left_out_folds_equal_fits_without_them(made):
    rows = made.collect()
    x, y = design(rows)
    fold, out = np.array([r["fold"] for r in rows]), []
    for f in range(4):
        beta = np.linalg.lstsq(x[fold != f], y[fold != f], rcond=None)[0]
        e, own = y[fold == f] - x[fold == f] @ beta, y[fold == f]
        out.append(1 - (e ** 2).sum() / ((own - own.mean()) ** 2).sum())
    assert np.allclose(LS.left_out_r2(LS.moments(made, NUMBERS, ["zone"], "y", "fold")), out, atol=1e-9)


def test_line_on_odd_rows(spark, made, folder):
    fit = LS.LinearFit.of(LS.moments(made, NUMBERS, ["zone"], "y", "fold"))
    odd = spark.createDataFrame([(0.5, 1, 1.0, 2001.0, "never seen", 9.0), (0.5, 1, 1.0, 2001.0, None, 9.0)],
                                "a double, b int, twice double, fixed double, zone string, prediction2 double")
    unknown, null = [r["prediction"] for r in fit.transform(odd).collect()]
    assert np.isfinite(unknown) and unknown == null
    fit.save(f"{folder}/line", spark)
    assert LS.LinearFit.load(f"{folder}/line", spark) == fit
    one = LS.moments(made.limit(1), NUMBERS, ["zone"], "y", "fold")
    assert np.isclose(LS.LinearFit.of(one).transform(made.limit(1)).first()["prediction"], made.limit(1).first()["y"])
    with pytest.raises(ValueError, match="no rows"):
        FC.TripPredictor("linear_regression").train(spark.createDataFrame([], "start_zone string, start_date date, trip_count long"))


def test_one_scan_gives_all_folds(made):
    plan = LS.cell_sums(made, NUMBERS, ["zone"], "y", "fold")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1 and "Join" not in plan


def test_node_tables_score_as_the_models(spark, made, folder):
    names = ["a", "b", "twice"]
    keyed = made.select(F.monotonically_increasing_id().alias("id"), *[F.col(n).cast("double").alias(n) for n in names], F.col("y").alias("trip_count")).cache()
    vectors = VectorAssembler(inputCols=names, outputCol="features").transform(keyed)
    for label, model, trees in (("tree", TR.fit_tree(keyed, names, "trip_count", 4), 1), ("forest", FC.forest(5, 4).fit(vectors), 5)):
        nodes = TR.node_table(model, f"{folder}/{label}")
        walked = {r["id"]: r["prediction"] for r in TR.scored_by_nodes(keyed, nodes, ["id"], names, trees, 4).collect()}
        said = {r["id"]: r["prediction"] for r in model.transform(vectors).collect()}
        assert walked.keys() == said.keys() and all(np.isclose(walked[i], said[i]) for i in said)
        again = {r["feature"]: r["importance"] for r in TR.importances(nodes, names).collect()}
        assert np.allclose([again[n] for n in names], model.featureImportances.toArray())
    assert TR.split_report(TR.saved_nodes(spark, f"{folder}/tree"), names).count() == TR.saved_nodes(spark, f"{folder}/tree").count()


def test_a_tree_without_splits(spark, folder):
    flat = spark.createDataFrame([(1.0, 4.0), (2.0, 4.0)], "a double, trip_count double")
    nodes = TR.node_table(TR.fit_tree(flat, ["a"], "trip_count"), f"{folder}/flat")
    assert [tuple(r) for r in TR.split_report(nodes, ["a"]).collect()] == [(1, None, None, 2.0, 4.0)]
    assert TR.importances(nodes, ["a"]).first()["importance"] == 0.0


def test_calls_run_at_the_same_time(spark):
    gate = threading.Barrier(3, timeout=30)
    calls = [lambda i=i: (gate.wait(), spark.range(i + 1).count())[1] for i in range(3)]
    assert FC.side_by_side(spark, calls, 3) == [1, 2, 3]
