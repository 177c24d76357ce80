"""Daily forecasters as pyspark.ml estimators, chronological search and rolling evaluation.

A fitted forecaster is a plain ``PipelineModel`` of JVM stages (the target transform and its
inverse are SQL stages), so it is written and read with ``PipelineModel.write``.
"""

from __future__ import annotations

import hashlib
import time
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, PipelineModel
from pyspark.ml.feature import SQLTransformer, StandardScaler, VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daymark import stages
from daymark.functions.numeric import TARGETS, count_sql, fitted_sql, ratio
from daymark.operators import history, joins, scoring
from daymark.operators.split import expanding_folds
from daymark.plans import linear
from daymark.session import materialize
from daymark.stages import StoredStage, param

FAMILIES = ("ridge", "elastic", "huber", "forest", "boosted")
SEED = 42

def _regressor(family: str, penalty: float, settings: dict):
    """``penalty`` turns a penalty on the plain sum of squares into Spark's ``regParam``."""
    s = dict(settings)
    common = {"featuresCol": "_features", "labelCol": "_target", "predictionCol": "_raw"}
    if family == "ridge":
        return LinearRegression(**common, weightCol="_weight", solver="normal", regParam=s.pop("alpha", 1.0) * penalty,
                                elasticNetParam=0.0, standardization=False, **s)
    if family == "forest":
        return RandomForestRegressor(**common, weightCol="_weight", seed=SEED, numTrees=s.pop("trees", 50),
                                     maxDepth=s.pop("depth", 6), **s)
    if family == "boosted":
        return GBTRegressor(**common, weightCol="_weight", seed=SEED, maxIter=s.pop("rounds", 20),
                            maxDepth=s.pop("depth", 3), stepSize=s.pop("rate", 0.1), **s)
    raise ValueError(f"unknown family {family!r}; choose from {FAMILIES}")


class ResidualForecaster(Estimator, StoredStage):
    """Fits a regressor to the count less a named baseline and adds the baseline back."""

    family = param("family", f"one of {', '.join(FAMILIES)}", stages.text)
    featureSet = param("featureSet", "name of a feature set", stages.text)
    target = param("target", "name of a fitted target", stages.text)
    halfLife = param("halfLife", "rows back at which a row's weight is halved; 0 for none", stages.number)
    valueCol = param("valueCol", "count column", stages.text)
    dayCol = param("dayCol", "date column", stages.text)
    seriesCols = param("seriesCols", "columns that tell series apart", stages.names)
    output = param("output", "forecast column", stages.text)
    settings = param("settings", "settings of the family")

    def __init__(self, family: str = "ridge", feature_set: str = "full", target: str = "direct",
                 half_life: float = 0.0, value: str = "trips", day: str = "date",
                 series: Sequence[str] = ("series",), output: str = "prediction", **settings):
        super().__init__()
        if target not in TARGETS:
            raise ValueError(f"unknown target {target!r}")
        self._set(family=family, featureSet=feature_set, target=target, halfLife=float(half_life), valueCol=value,
                  dayCol=day, seriesCols=list(series), output=output, settings=settings)

    def describe(self) -> dict:
        return {"family": self.value("family"), "feature_set": self.value("featureSet"), "target": self.value("target"),
                "half_life": self.value("halfLife"), **self.value("settings")}

    def _penalty(self, prepared: DataFrame) -> float:
        if self.value("family") != "ridge":
            return 1.0
        w, y = F.col("_weight"), F.col("_target")
        total, first, second = prepared.agg(F.sum(w), F.sum(w * y), F.sum(w * y * y)).first()
        # The least-squares solver scales the label to unit deviation before it applies regParam.
        return max(second / total - (first / total) ** 2, 1e-24) ** 0.5 / total

    def _fit(self, dataset: DataFrame) -> PipelineModel:
        features = history.FEATURE_SETS[self.value("featureSet")]
        family, target, output = (self.value(n) for n in ("family", "target", "output"))
        count, day, series, half_life = (self.value(n) for n in ("valueCol", "dayCol", "seriesCols", "halfLife"))
        if family in linear.SOLVED:
            line = linear.fit_line(dataset, self, series, day, count)
            raw = " + ".join([f"{line[0]!r}D", *[f"{w!r}D * {n}" for n, w in zip(features, line[1:]) if w]])
            return PipelineModel([SQLTransformer(statement=f"SELECT *, {count_sql(raw, target)} AS {output} FROM __THIS__")])
        rows = dataset
        if half_life:
            rows = history.recency_weights(rows, half_life, series, day).withColumnRenamed("weight", "_weight")
        else:
            rows = rows.withColumn("_weight", F.lit(1.0))
        rows = rows.withColumn("_target", F.expr(fitted_sql(count, target)))
        assemble = VectorAssembler(inputCols=features, outputCol="_plain", handleInvalid="error")
        scale = StandardScaler(inputCol="_plain", outputCol="_features", withMean=True, withStd=True).fit(
            assemble.transform(rows))
        prepared = scale.transform(assemble.transform(rows)).select("_features", "_target", "_weight")
        model = _regressor(family, self._penalty(prepared), self.value("settings")).fit(prepared)
        inverse = SQLTransformer(statement=f"SELECT *, {count_sql('_raw', target)} AS {output} FROM __THIS__")
        tidy = SQLTransformer(statement="SELECT * EXCEPT (_plain, _features, _raw) FROM __THIS__")
        return PipelineModel([assemble, scale, model, inverse, tidy])


class BaselineForecaster(Estimator, StoredStage):
    """Training mean, a named past value, or a seasonal average; nothing else is learned."""

    kind = param("kind", "training_mean, seasonal_average or the column of a past value", stages.text)
    blend = param("blend", "share of the seven-day mean", stages.number)
    trend = param("trend", "weight of the change of the means", stages.number)
    decay = param("decay", "weight of each further week", stages.number)
    adjustment = param("adjustment", "power of the recent level", stages.number)
    valueCol = param("valueCol", "count column", stages.text)
    output = param("output", "forecast column", stages.text)

    def __init__(self, kind: str = "lag_7", blend: float = 0.0, trend: float = 0.0, decay: float = 1.0,
                 adjustment: float = 0.0, value: str = "trips", output: str = "prediction"):
        super().__init__()
        self._set(kind=kind, blend=float(blend), trend=float(trend), decay=float(decay), adjustment=float(adjustment),
                  valueCol=value, output=output)

    def describe(self) -> dict:
        return {"family": "baseline", **{n: self.value(n) for n in ("kind", "blend", "trend", "decay", "adjustment")}}

    def _fit(self, dataset: DataFrame) -> PipelineModel:
        kind, blend, trend, decay, adjustment = (self.value(n) for n in ("kind", "blend", "trend", "decay", "adjustment"))
        if kind == "training_mean":
            mean = dataset.agg(F.avg(self.value("valueCol"))).first()[0]
            expression = f"cast({mean!r} as double)"
        elif kind == "seasonal_average":
            weights = [decay ** i for i in range(4)]
            total = " + ".join(f"{w!r}D * lag_{n}" for w, n in zip(weights, (7, 14, 21, 28)))
            expression = (f"({total}) / {sum(weights)!r}D * "
                          f"pow(least(2D, greatest(0.5D, mean_7 / greatest(1D, mean_28))), {adjustment!r}D)")
        else:
            expression = (f"greatest(0D, {1 - blend!r}D * {kind} + {blend!r}D * mean_7 "
                          f"+ {trend!r}D * (mean_7 - mean_14))")
        return PipelineModel([SQLTransformer(statement=f"SELECT *, {expression} AS {self.value('output')} FROM __THIS__")])


def blend(columns: dict[str, float]) -> Column:
    """max(0, weighted sum) of prediction columns of one frame; no join is needed."""
    total = F.lit(0.0)
    for name, weight in columns.items():
        total = total + F.lit(float(weight)) * F.col(name)
    return F.greatest(F.lit(0.0), total)


def blend_models(models: Sequence[tuple[PipelineModel, float]], frame: DataFrame, output: str = "prediction") -> DataFrame:
    """Score one frame with each fitted model in turn and blend the results."""
    weights = {}
    for i, (model, weight) in enumerate(models):
        frame = model.transform(frame).withColumnRenamed(output, f"_member_{i}")
        weights[f"_member_{i}"] = weight
    return frame.withColumn(output, blend(weights)).drop(*weights)


RESULT = "candidate int, setting string, fold int, mae double, train_mae double, days long"


def grid_search_chrono(frame: DataFrame, candidates: Sequence[ResidualForecaster | BaselineForecaster], splits: int = 3,
                       test_size: int = 21, series: Sequence[str] = ("series",), day: str = "date", value: str = "trips",
                       workers: int = 8) -> DataFrame:
    """Action: try every setting on every expanding fold. Returns one row per (setting, fold) with the
    mean absolute error on the check and the training rows; folds without training rows give none.

    All ridge, elastic and Huber settings share their passes over the rows (:mod:`daymark.plans.linear`).
    Other families are fitted by ``pyspark.ml`` jobs, submitted from a small pool of driver threads.
    """
    spark = frame.sparkSession
    folds = expanding_folds(frame, splits, test_size, 0, series, day)
    shared = ("ridge", *linear.SOLVED)
    solved = [(i, c) for i, c in enumerate(candidates) if c.describe()["family"] in shared]
    fitted = [(i, c) for i, c in enumerate(candidates) if c.describe()["family"] not in shared]
    out = linear.grid_errors(folds, solved, day, value, series) if solved else None
    if fitted:
        stored = materialize(folds, "folds")

        def run(job: tuple[int, ResidualForecaster, int]) -> tuple:
            index, candidate, fold = job
            part = stored.where(F.col("fold") == fold)
            model = candidate.fit(part.where("role = 'train'"))
            error, checked = F.abs(F.col(value) - F.col(candidate.value("output"))), F.col("role") == "check"
            m = model.transform(part).agg(F.avg(F.when(checked, error)), F.avg(F.when(~checked, error)), F.count_if(checked)).first()
            return (index, _setting(candidate), fold, *m)

        jobs = [(i, c, f) for i, c in fitted for f in range(splits)]
        with ThreadPoolExecutor(max_workers=workers) as pool:
            running = [pool.submit(inheritable_thread_target(spark)(run), job) for job in jobs]  # a wrapper each, see pooled
            rows = [job.result() for job in running]
        table = spark.createDataFrame(rows, RESULT)
        out = table if out is None else out.unionByName(table)
    return out


def _setting(candidate) -> str:
    return linear.setting_text(candidate)


def search_board(results: DataFrame) -> DataFrame:
    """Mean MAE per setting, best first."""
    return results.groupBy("candidate", "setting").agg(
        F.avg("mae").alias("mean_mae"), F.stddev_pop("mae").alias("std_mae"), F.avg("train_mae").alias("mean_train_mae"), F.count(F.lit(1)).alias("folds")
    ).orderBy("mean_mae", "candidate")


def refit_best(frame: DataFrame, candidates: Sequence[ResidualForecaster], results: DataFrame) -> PipelineModel:
    """Action: fit the winning setting on the whole frame."""
    return candidates[search_board(results).first()["candidate"]].fit(frame)


def feature_ablation(frame: DataFrame, make, feature_sets: Sequence[str], **search) -> DataFrame:
    """The same model and folds over different feature sets; one row per fold, one column per set."""
    results = grid_search_chrono(frame, [make(name) for name in feature_sets], **search)
    named = results.withColumn("feature_set", F.get_json_object("setting", "$.feature_set"))
    return named.groupBy("fold").pivot("feature_set", list(feature_sets)).agg(F.first("mae"))


def rolling_evaluation(daily: DataFrame, preferred: DataFrame, first_day: str, fallback: Column | None = None,
                       series: Sequence[str] = ("series",), day: str = "date", value: str = "trips") -> DataFrame:
    """One-day-ahead evaluation from ``first_day`` on, as one plan.

    Each day's 28 true totals are its history, so completed days become history of later ones.
    Days without a preferred prediction use the fallback on that history. Two rows of metrics,
    all days and weather-complete days, each beside the lag-7 baseline. Preferred predictions meet their
    own series where they name it; without series columns they hold for every series.
    """
    on = [c for c in (*series, day) if c in preferred.columns]
    past = history.history_arrays(daily, series=series, value=value, day=day).where(F.col(day) >= F.lit(first_day).cast("date"))
    counts = F.transform("prior_counts", lambda v: v.cast("double"))
    last_week = F.aggregate(F.slice(counts, -7, 7), F.lit(0.0), lambda a, v: a + v) / 7
    routed = joins.route_with_fallback(
        past.withColumns({"_fallback": fallback if fallback is not None else last_week,
                          "lag_7": F.element_at("prior_counts", -7)}),
        preferred, on, "prediction", "_fallback", "weather", "counts")
    rows = routed.select(
        F.col(value).cast("double").alias("actual"), F.col("prediction"), F.col("lag_7").cast("double").alias("lag_7"),
        F.explode(F.when(F.col("used_model") == "weather", F.array(F.lit("all"), F.lit("weather_complete")))
                  .otherwise(F.array(F.lit("all")))).alias("subset"))
    return rows.groupBy("subset").agg(
        *scoring.regression_aggregates("actual", "prediction"),
        F.avg(F.abs(F.col("actual") - F.col("lag_7"))).alias("lag_7_mae"),
    ).withColumn("improvement", 1 - ratio(F.col("mae"), F.col("lag_7_mae")))


BOARD_ROW = "key string, candidate int, setting string, fold int, mae double, train_mae double, days long, seconds double"


def search_on_board(frame: DataFrame, candidates: Sequence[ResidualForecaster | BaselineForecaster], path: str, splits: int = 3,
                    test_size: int = 21, series: Sequence[str] = ("series",), day: str = "date", value: str = "trips",
                    workers: int = 8) -> DataFrame:
    """Action: :func:`grid_search_chrono` with its progress on a written board below ``path``.

    Every finished fit writes its row, keyed by setting, fold and the rows it was fitted on, into a folder of
    its own. A later call with the same ``path`` takes finished rows away by an anti-join and runs the rest, so a
    killed search goes on where it stopped; another table, or other settings, find no row of theirs.
    """
    spark = frame.sparkSession
    stored = materialize(expanding_folds(frame, splits, test_size, 0, series, day), "folds")
    names = sorted(set(stored.columns) - {"fold", "role"})
    told = stored.agg(F.count(F.lit(1)), F.sum(F.xxhash64("fold", "role", *names).cast("decimal(38,0)"))).first()
    jobs = spark.createDataFrame([(hashlib.sha256(f"{_setting(c)}/{f}/{told}".encode()).hexdigest()[:32], i, f)
                                  for i, c in enumerate(candidates) for f in range(splits)], "key string, candidate int, fold int")
    done = spark.read.schema(BOARD_ROW).option("recursiveFileLookup", "true").parquet(_board_folder(spark, path))
    waiting = [(r["key"], r["candidate"], r["fold"]) for r in jobs.join(done, "key", "left_anti").orderBy("candidate", "fold").collect()]

    def run(job: tuple[str, int, int]) -> None:
        key, index, fold = job
        candidate, started = candidates[index], time.perf_counter()
        part = stored.where(F.col("fold") == fold)
        model = candidate.fit(part.where("role = 'train'"))
        error, checked = F.abs(F.col(value) - F.col(candidate.value("output"))), F.col("role") == "check"
        m = model.transform(part).agg(F.avg(F.when(checked, error)), F.avg(F.when(~checked, error)), F.count_if(checked)).first()
        row = (key, index, _setting(candidate), fold, *m, time.perf_counter() - started)
        spark.createDataFrame([row], BOARD_ROW).coalesce(1).write.mode("overwrite").parquet(f"{path}/rows/{key}")

    with ThreadPoolExecutor(max_workers=workers) as pool:
        for running in [pool.submit(inheritable_thread_target(spark)(run), job) for job in waiting]:
            running.result()
    done = spark.read.schema(BOARD_ROW).option("recursiveFileLookup", "true").parquet(f"{path}/rows")
    # The index follows the caller's list, which may have been put together in another order before.
    return done.drop("candidate", "fold").join(F.broadcast(jobs), "key").select("candidate", "setting", "fold", "mae", "train_mae", "days", "seconds")


def _board_folder(spark: SparkSession, path: str) -> str:
    """The board's folder, made with an empty table where it is new."""
    folder = f"{path}/rows"
    place = spark._jvm.org.apache.hadoop.fs.Path(folder)
    if not place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
        spark.createDataFrame([], BOARD_ROW).write.parquet(f"{folder}/begin")
    return folder


def forest_settings() -> list[ResidualForecaster]:
    """The plan's 36 forests of 200 trees: depth (30 is Spark's greatest) x rows in a leaf x share of features x residual."""
    return [ResidualForecaster("forest", "full", t, trees=200, depth=d, minInstancesPerNode=leaf, featureSubsetStrategy=share)
            for d in (3, 6, 30) for leaf in (2, 5, 10) for share in ("0.7", "1.0") for t in ("direct", "residual7")]


def boosted_settings() -> list[ResidualForecaster]:
    """Boosted trees on the axes of the plan's 192 that Spark's have: depth x rounds x rate x rows in a leaf x rows
    drawn x residual, 96 in all; Spark has no penalty on leaf values."""
    return [ResidualForecaster("boosted", "full", t, depth=d, rounds=n, rate=r, minInstancesPerNode=leaf, subsamplingRate=s)
            for d in (2, 3, 5) for n in (100, 300) for r in (0.03, 0.1) for leaf in (3, 10) for s in (0.8, 1.0) for t in ("direct", "residual7")]
