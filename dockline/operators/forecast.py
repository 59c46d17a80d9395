"""Trip-demand models on Spark ML: features, training, metrics, forecasts."""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StandardScaler, StandardScalerModel, StringIndexer, VectorAssembler
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dockline.functions import columns as C
from dockline.operators import leastsquares as LS

# --- fixed values ---------------------------------------------------------
TREES, SEED, TEST_SHARE, FOLDS = 100, 42, 0.2, 5
MODEL_TYPES = ("linear_regression", "random_forest")
BASIC_NUMBERS = ["day_of_week", "month", "is_weekend"]
ADVANCED_NUMBERS = BASIC_NUMBERS + [
    "year", "quarter", "day_of_year", "week_of_year", "hour",
    "day_sin", "day_cos", "month_sin", "month_cos", "zone_avg_trips",
    "is_holiday", "is_monday", "is_friday",
]
# --------------------------------------------------------------------------

DEEPEST = 30  # the deepest trees that Spark ML grows
GROVE, GROVE_ROWS = 10, 20_000  # trees that grow together, and the rows up to which all do
PART_ROWS = 50_000  # rows of a partition of a large table: every partition sends sums for every node
AT_ONCE = 20  # fits side by side
SPLIT_BUCKETS = 2 ** 31
TARGET, PREDICTION = "trip_count", "prediction"
PREFIX = {"start_zone": "zone", "season": "season"}


def hash_bucket(*keys: Column, buckets: int = 100, seed: int = SEED) -> Column:
    """Bucket of a row by its keys: the same on every run and every engine."""
    text = F.concat_ws("|", *[k.cast("string") for k in keys], F.lit(str(seed)))
    return F.pmod(F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint"), F.lit(buckets))


def split_column(test_share: float = TEST_SHARE, seed: int = SEED) -> Column:
    bucket = hash_bucket(F.col("start_zone"), F.col("start_date"), buckets=SPLIT_BUCKETS, seed=seed)
    return F.when(bucket < round(SPLIT_BUCKETS * test_share), F.lit("test")).otherwise(F.lit("train"))


def with_folds(rows: DataFrame, folds: int, seed: int = SEED + 1) -> DataFrame:
    """Adds ``fold``, even for any number of rows: the place of a row in the order of its key hash, modulo folds.

    The place is the rank inside a slice of the hash range plus the rows of all slices before it; only the
    slice totals, a fixed number of rows, meet in one task.
    """
    keys = [F.col("start_zone"), F.col("start_date")]
    marked = rows.withColumn("_hash", hash_bucket(*keys, buckets=2 ** 31, seed=seed)) \
        .withColumn("_slice", F.shiftright("_hash", 19))
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    totals = marked.groupBy("_slice").count().select("_slice", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_before"))
    rank = F.row_number().over(Window.partitionBy("_slice").orderBy("_hash", *keys))
    return marked.withColumn("_rank", rank).join(totals, "_slice").select(
        *rows.columns, F.pmod(F.col("_before") + F.col("_rank"), F.lit(folds)).cast("int").alias("fold"))


def train_test(zone_days: DataFrame, test_share: float = TEST_SHARE, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    marked = zone_days.withColumn("part", split_column(test_share, seed))
    return (marked.filter(F.col("part") == "train").drop("part"),
            marked.filter(F.col("part") == "test").drop("part"))


def one_hot(zone_days: DataFrame, categories: dict[str, list[str]]) -> DataFrame:
    """Wide form: one 0/1 column per listed category, instead of the text column."""
    wide = zone_days
    for column, values in categories.items():
        wide = wide.select("*", *[
            F.coalesce(F.col(column) == F.lit(v), F.lit(False)).cast("int").alias(f"{PREFIX[column]}_{v}")
            for v in values]).drop(column)
    return wide


def metrics(predicted: DataFrame, target: str = TARGET, prediction: str = PREDICTION, by: str | None = None) -> DataFrame:
    """r2, mean absolute error, root mean squared error; per group if asked."""
    y, e = F.col(target).cast("double"), F.col(target) - F.col(prediction)
    grouped = predicted.groupBy(*([by] if by else []))
    return grouped.agg(
        (1 - F.sum(e * e) / F.nullif(F.var_pop(y) * F.count(y), F.lit(0.0))).alias("r2"),
        F.avg(F.abs(e)).alias("mae"),
        F.sqrt(F.avg(e * e)).alias("rmse"),
    )


def feature_stages(numbers: list[str], categories: list[str], scale: bool = True) -> list:
    """Alphabetical one-hot columns, numbers, standard scaling.

    An unknown category becomes a row of zeros, as ``keep`` gives it an index
    of its own whose column the encoder drops.
    """
    indexed = [f"{c}_index" for c in categories]
    encoded = [f"{c}_vector" for c in categories]
    stages = [
        StringIndexer(inputCols=categories, outputCols=indexed, stringOrderType="alphabetAsc", handleInvalid="keep"),
        OneHotEncoder(inputCols=indexed, outputCols=encoded, dropLast=True),
        VectorAssembler(inputCols=numbers + encoded, outputCol="raw_features"),
    ]
    if scale:
        stages.append(StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True))
    else:
        stages[-1].setOutputCol("features")
    return stages


def forest(trees: int = TREES, depth: int = DEEPEST, seed: int = SEED, prediction: str = PREDICTION) -> RandomForestRegressor:
    """The forest; each row's place in every tree stays on its executor, so tasks need not carry the grown trees.

    The places are checkpointed every tenth level where the context has a checkpoint folder. ``maxMemoryInMB``
    bounds the sums that one task holds at a time, and not the trees.
    """
    return RandomForestRegressor(
        featuresCol="features", labelCol=TARGET, predictionCol=prediction, numTrees=trees, maxDepth=depth,
        maxMemoryInMB=256, seed=seed, featureSubsetStrategy="all", cacheNodeIds=True, checkpointInterval=10)


def groves(trees: int, depth: int, rows: int) -> list[RandomForestRegressor]:
    """The trees of a forest in groups that can grow side by side, each with a seed of its own.

    A table of zones and days lies in one or few partitions, and a forest that grows alone has a task for each of
    them. Up to GROVE_ROWS rows the trees grow together; the cut depends on nothing else, so that neither does the model.
    """
    if rows <= GROVE_ROWS or trees <= GROVE:
        return [forest(trees, depth)]
    sizes = [min(GROVE, trees - at) for at in range(0, trees, GROVE)]
    return [forest(n, depth, SEED + 10_007 * i, f"grove_{i}") for i, n in enumerate(sizes)]


def mean_of_groves(grown: list[RandomForestRegressionModel]) -> list[SQLTransformer]:
    """The stage that makes the forest's prediction from those of its groves; none where there is one grove."""
    if len(grown) == 1:
        return []
    total = " + ".join(f"{m.getNumTrees} * {m.getPredictionCol()}" for m in grown)
    return [SQLTransformer(statement=f"SELECT *, ({total}) / {sum(m.getNumTrees for m in grown)} AS {PREDICTION} FROM __THIS__")]


def side_by_side(spark: SparkSession, calls: list[Callable], at_once: int) -> list:
    """Results of calls that each run Spark jobs, in their order; the jobs share the executors."""
    with ThreadPoolExecutor(at_once) as pool:
        return [f.result() for f in [pool.submit(inheritable_thread_target(spark)(call)) for call in calls]]


@dataclass
class TripPredictor:
    """A trained feature and model chain for zone-day trip counts."""

    model_type: str = "random_forest"
    advanced: bool = False
    trees: int = TREES
    depth: int = DEEPEST
    at_once: int = AT_ONCE
    model: PipelineModel | LS.LinearFit | None = None
    scores: dict[str, float] = field(default_factory=dict)
    zone_means: DataFrame | None = None

    def __post_init__(self):
        if self.model_type not in MODEL_TYPES:
            raise ValueError(f"model_type is one of {MODEL_TYPES}, not {self.model_type!r}")

    @property
    def numbers(self) -> list[str]:
        return ADVANCED_NUMBERS if self.advanced else BASIC_NUMBERS

    @property
    def categories(self) -> list[str]:
        return ["start_zone", "season"] if self.advanced else ["start_zone"]

    def _aligned(self, df: DataFrame) -> DataFrame:
        """Expected columns in numeric form; missing ones 0, others ignored."""
        have = set(df.columns)
        numeric = {n: F.coalesce(F.col(n).cast("double"), F.lit(0.0)) if n in have else F.lit(0.0) for n in self.numbers}
        texts = {c: F.col(c) if c in have else F.lit(None).cast("string") for c in self.categories}
        return df.withColumns({**numeric, **texts})

    def train(self, zone_days: DataFrame, test_share: float = TEST_SHARE, seed: int = SEED,
              folds: int | None = FOLDS) -> "TripPredictor":
        """Fits on the training part; scores both parts and, with folds, by cross-validation."""
        aligned = self._aligned(zone_days).withColumn(TARGET, F.col(TARGET).cast("double"))
        fitting, _ = train_test(aligned, test_share, seed)
        marked = with_folds(fitting, folds) if folds else fitting.withColumn("fold", F.lit(0))
        left_out = (self._fit_line if self.model_type == "linear_regression" else self._fit_forests)(marked, bool(folds))
        scored = self._spread(aligned).withColumn("part", split_column(test_share, seed))
        scored = self.model.transform(scored)
        for row in metrics(scored, by="part").collect():  # two rows
            for name in ("r2", "mae", "rmse"):
                self.scores[f"{row['part']}_{name}"] = row[name]
        known = [v for v in left_out if v is not None]  # one held-out value has no variance, hence no r2
        mean = sum(known) / len(known) if known else self.scores.get("test_r2")
        self.scores["cv_r2_mean"] = mean
        self.scores["cv_r2_std"] = (sum((v - mean) ** 2 for v in known) / len(known)) ** 0.5 if known else 0.0
        return self

    def _spread(self, rows: DataFrame) -> DataFrame:
        """Rows over all cores where a forest of several groves is to score them: small rows, but a walk down every tree."""
        spread = self.model_type == "random_forest" and any(isinstance(s, SQLTransformer) for s in self._fitted().stages)
        return rows.repartition(rows.sparkSession.sparkContext.defaultParallelism) if spread else rows

    def _fit_line(self, marked: DataFrame, validate: bool) -> list[float | None]:
        """The line over all folds, and r2 of those without each fold on the rows left out, all from one aggregate."""
        sums = LS.moments(marked, self.numbers, self.categories, TARGET, "fold")
        if not sums.folds:
            raise ValueError("there are no rows to train on")
        self.model = LS.LinearFit.of(sums)
        return LS.left_out_r2(sums) if validate and len(sums.folds) > 1 else []

    def _fit_forests(self, marked: DataFrame, validate: bool) -> list[float | None]:
        """The forest over all folds and those without each fold, grown side by side over one prepared table.

        Categories are indexed once; scaling and trees are fitted anew without each fold.
        """
        spark = marked.sparkSession
        prepare = Pipeline(stages=feature_stages(self.numbers, self.categories)[:-1]).fit(marked)
        ready = prepare.transform(marked).select("fold", "raw_features", TARGET).persist()

        def scaled(rows: DataFrame) -> StandardScalerModel:
            return feature_stages(self.numbers, self.categories)[-1].fit(rows)

        try:
            sizes = {r["fold"]: r["count"] for r in ready.groupBy("fold").count().collect()}  # at most the number of folds
            folds, total = sorted(sizes) if validate and len(sizes) > 1 else [], sum(sizes.values())
            laid = ready.coalesce(-(-total // PART_ROWS)) if total > GROVE_ROWS else ready
            parts = [(laid, total), *((laid.where(F.col("fold") != f), total - sizes[f]) for f in folds)]
            scales = side_by_side(spark, [lambda rows=rows: scaled(rows) for rows, _ in parts], self.at_once)
            wanted = [(i, g) for i, (_, n) in enumerate(parts) for g in groves(self.trees, self.depth, n)]
            grown = side_by_side(
                spark, [lambda i=i, g=g: g.fit(scales[i].transform(parts[i][0]).select("features", TARGET)) for i, g in wanted], self.at_once)
            models = []
            for i, scale in enumerate(scales):
                own = [m for (j, _), m in zip(wanted, grown) if j == i]
                models.append(PipelineModel([scale, *own, *mean_of_groves(own)]))
            left_out = side_by_side(spark, [
                lambda f=f, m=m: metrics(m.transform(ready.where(F.col("fold") == f))).first()["r2"] for f, m in zip(folds, models[1:])], self.at_once)
        finally:
            ready.unpersist()
        self.model = PipelineModel(prepare.stages + models[0].stages)
        return left_out

    def _fitted(self):
        if self.model is None:
            raise ValueError("Model must be trained before this call")
        return self.model

    def predict(self, df: DataFrame) -> DataFrame:
        model = self._fitted()
        out = model.transform(self._aligned(df))
        return out.select(*df.columns, PREDICTION)

    def forecast(self, zones: DataFrame, first: dt.date, last: dt.date | None = None,
                 extra: dict[str, float] | None = None) -> DataFrame:
        """Predicted trips of every zone on every date, in one transform.

        Dates are generated beside each zone, so zones x dates needs no join.
        An unknown zone is forecast from the calendar alone; a row that cannot
        be scored gives 0.
        """
        last = last or first
        days = F.explode(F.sequence(F.lit(first), F.lit(last), F.expr("interval 1 day")))
        date = F.col("start_date")
        rows = zones.select("start_zone").distinct().withColumn("start_date", days)
        wanted = {**C.calendar_basics(date)}
        if self.advanced:
            wanted.update(C.calendar_details(date))
            wanted.update(C.cyclical(F.weekday(date), 7, "day"))
            wanted.update(C.cyclical(F.month(date), 12, "month"))
        rows = rows.withColumns(wanted)
        if self.advanced and self.zone_means is not None:
            rows = rows.join(self.zone_means, "start_zone", "left")
        for name, value in (extra or {}).items():
            rows = rows.withColumn(name, F.lit(value))
        return self.predict(rows).select(
            "start_zone", "start_date", F.coalesce(PREDICTION, F.lit(0.0)).alias("predicted_trips"))

    def forecast_one(self, spark: SparkSession, zone: str, date: dt.date, extra: dict[str, float] | None = None) -> DataFrame:
        return self.forecast(spark.createDataFrame([(zone,)], "start_zone string"), date, extra=extra)

    def feature_importance(self, spark: SparkSession, k: int | None = None) -> DataFrame:
        """Features by importance, largest first; no rows for a linear model.

        The vector has one entry per feature column and lives in the model.
        """
        model = self._fitted()
        pairs: list[tuple[str, float]] = []
        if self.model_type == "random_forest":
            pairs = list(zip(self._feature_names(), self._importances()))
        frame = spark.createDataFrame(pairs, "feature string, importance double")
        ordered = frame.orderBy(F.col("importance").desc(), "feature")
        return ordered if k is None else ordered.limit(k)

    def _importances(self) -> list[float]:
        """Those of the groves, weighted by their trees: a forest's are the mean over its trees."""
        grown = [s for s in self._fitted().stages if isinstance(s, RandomForestRegressionModel)]
        if len(grown) == 1:
            return grown[0].featureImportances.toArray().tolist()
        whole = sum(m.getNumTrees * m.featureImportances.toArray() for m in grown)
        return (whole / (whole.sum() or 1.0)).tolist()

    def scaling(self, spark: SparkSession) -> DataFrame:
        """Mean and standard deviation of each feature of the training part."""
        model = self._fitted()
        if isinstance(model, LS.LinearFit):
            mean, std = model.means, model.deviations
        else:
            scale = next(s for s in model.stages if isinstance(s, StandardScalerModel))
            mean, std = scale.mean.toArray().tolist(), scale.std.toArray().tolist()
        pairs = zip(self._feature_names(), mean, std)
        return spark.createDataFrame(list(pairs), "feature string, mean double, std double")

    def _feature_names(self) -> list[str]:
        model = self._fitted()
        labels = list(model.levels.values()) if isinstance(model, LS.LinearFit) else model.stages[0].labelsArray
        names = list(self.numbers)
        for category, values in zip(self.categories, labels):
            names += [f"{PREFIX[category]}_{v}" for v in values]
        return names

    def save(self, path: str, spark: SparkSession) -> None:
        """Model folder with the coefficients or the Spark ML chain, and a one-row settings table."""
        model = self._fitted()
        if isinstance(model, LS.LinearFit):
            model.save(f"{path}/model", spark)
        else:
            model.write().overwrite().save(f"{path}/model")
        settings = json.dumps({"model_type": self.model_type, "advanced": self.advanced,
                               "trees": self.trees, "depth": self.depth, "scores": self.scores})
        spark.createDataFrame([(settings,)], "settings string").write.mode("overwrite").json(f"{path}/settings")
        if self.zone_means is not None:
            self.zone_means.write.mode("overwrite").parquet(f"{path}/zone_means")

    @classmethod
    def load(cls, path: str, spark: SparkSession) -> "TripPredictor":
        settings = json.loads(spark.read.schema("settings string").json(f"{path}/settings").first()["settings"])
        means = spark.read.parquet(f"{path}/zone_means") if settings["advanced"] else None
        return cls(**{k: v for k, v in settings.items() if k != "scores"}, scores=settings["scores"],
                   model=(LS.LinearFit.load(f"{path}/model", spark) if settings["model_type"] == "linear_regression"
                          else PipelineModel.load(f"{path}/model")), zone_means=means)


def totals_per_day(forecasts: DataFrame) -> DataFrame:
    return forecasts.groupBy("start_date").agg(F.sum("predicted_trips").alias("predicted_trips"))


def scores_frame(spark: SparkSession, predictors: dict[str, TripPredictor]) -> DataFrame:
    """One row per model, best test r2 first."""
    names = ["train_r2", "test_r2", "train_mae", "test_mae", "train_rmse", "test_rmse", "cv_r2_mean", "cv_r2_std"]
    rows = [(label, *[p.scores.get(n) for n in names]) for label, p in predictors.items()]
    return spark.createDataFrame(rows, "model string, " + ", ".join(f"{n} double" for n in names)).orderBy(
        F.col("test_r2").desc(), "model")


def best_model(scored: DataFrame) -> DataFrame:
    return scored.orderBy(F.col("test_r2").desc(), "model").limit(1)


def run_records(spark: SparkSession, run_id: str, predictor: TripPredictor) -> DataFrame:
    """Parameters, metrics and importances of a run as (run_id, kind, key, value) rows."""
    rows = [(run_id, "param", "model_type", predictor.model_type), (run_id, "param", "random_state", str(SEED))]
    if predictor.model_type == "random_forest":
        rows.append((run_id, "param", "n_estimators", str(predictor.trees)))
    rows += [(run_id, "metric", k, str(v)) for k, v in predictor.scores.items()]
    schema = "run_id string, kind string, key string, value string"
    importances = predictor.feature_importance(spark).select(
        F.lit(run_id).alias("run_id"), F.lit("importance").alias("kind"),
        F.col("feature").alias("key"), F.col("importance").cast("string").alias("value"))
    return spark.createDataFrame(rows, schema).unionByName(importances)
