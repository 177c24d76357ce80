"""Risk classifiers with fold-fitted preparation, out-of-fold scoring and nested cutoffs."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from uuid import uuid4

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import Imputer, OneHotEncoder, SQLTransformer, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daymark import stages
from daymark.operators import joins, scoring, validate
from daymark.operators.split import stratified_folds
from daymark.plans.forests import forest_counts
from daymark.plans.logits import logistic_counts
from daymark.session import materialize, scratch_path
from daymark.stages import StoredStage, param

FAMILIES = ("majority", "logistic", "forest", "boosted")
SEED = 42


class FeatureDesign(Transformer, StoredStage):
    """``pyspark.ml`` stage around :func:`daymark.operators.validate.feature_design`."""

    numeric = param("numeric", "number columns", stages.names)
    categorical = param("categorical", "category columns", stages.names)
    options = param("options", "further arguments of feature_design")

    def __init__(self, numeric: Sequence[str] = (), categorical: Sequence[str] = (), **options):
        super().__init__()
        self._set(numeric=list(numeric), categorical=list(categorical), options=options)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return validate.feature_design(dataset, self.value("numeric"), self.value("categorical"), **self.value("options"))


class MajorityClassifier(Estimator, StoredStage):
    """Scores every row 1 or 0 by the commoner training label."""

    labelCol = param("labelCol", "label column", stages.text)

    def __init__(self, labelCol: str = "label"):
        super().__init__()
        self._set(labelCol=labelCol)

    def _fit(self, dataset: DataFrame) -> PipelineModel:
        share = dataset.agg(F.avg(self.value("labelCol"))).first()[0] or 0.0
        return PipelineModel([SQLTransformer(
            statement=f"SELECT *, cast({1.0 if share > 0.5 else 0.0} as double) AS score FROM __THIS__")])


def classifier(family: str, numeric: Sequence[str], categorical: Sequence[str], missing_flags: bool = False,
               **settings) -> Estimator:
    """Median numbers, a level for missing categories, one-hot codes (unseen is all zeros), then the model.

    Everything is fitted inside ``fit``, so on training rows only.
    """
    if family == "majority":
        return MajorityClassifier()
    filled = [f"{c}_known" for c in categorical]
    kept = ", ".join([f"coalesce(`{c}`, '{validate.MISSING_LEVEL}') AS `{c}_known`" for c in categorical]
                     + [f"cast(`{c}` is null as double) AS `{c}_gone`" for c in numeric if missing_flags]
                     + [f"cast(`{c}` as double) AS `{c}_raw`" for c in numeric])
    steps = [SQLTransformer(statement=f"SELECT *, {kept} FROM __THIS__"),
              Imputer(strategy="median", inputCols=[f"{c}_raw" for c in numeric], outputCols=[f"{c}_full" for c in numeric])]
    inputs = [f"{c}_full" for c in numeric] + ([f"{c}_gone" for c in numeric] if missing_flags else [])
    if categorical:
        steps += [StringIndexer(inputCols=filled, outputCols=[f"{c}_at" for c in categorical], handleInvalid="keep"),
                   OneHotEncoder(inputCols=[f"{c}_at" for c in categorical], outputCols=[f"{c}_hot" for c in categorical])]
        inputs += [f"{c}_hot" for c in categorical]
    steps.append(VectorAssembler(inputCols=inputs, outputCol="_plain"))
    features = "_plain"
    if family == "logistic":
        steps.append(StandardScaler(inputCol="_plain", outputCol="_features", withMean=False))
        features = "_features"
    common = {"featuresCol": features, "labelCol": "label", "probabilityCol": "_probability",
              "rawPredictionCol": "_rawscore", "predictionCol": "_class"}
    if family == "logistic":
        steps.append(LogisticRegression(**common, maxIter=settings.pop("rounds", 50), regParam=settings.pop("alpha", 0.01),
                                         tol=settings.pop("tol", 1e-4), **settings))
    elif family == "forest":
        steps.append(RandomForestClassifier(**common, seed=SEED, numTrees=settings.pop("trees", 40), maxDepth=settings.pop("depth", 6),
                                             minInstancesPerNode=settings.pop("leaf", 3), **settings))
    elif family == "boosted":
        boosted = GBTClassifier(featuresCol=features, labelCol="label", predictionCol="_class", seed=SEED,
                                maxIter=settings.pop("rounds", 15), maxDepth=settings.pop("depth", 3), **settings)
        steps.append(boosted.setProbabilityCol("_probability").setRawPredictionCol("_rawscore"))
    else:
        raise ValueError(f"unknown family {family!r}; choose from {FAMILIES}")
    return Pipeline(stages=steps)


def score_rows(model, rows: DataFrame, keep: Sequence[str]) -> DataFrame:
    """``keep`` and ``score``, the probability of the positive class."""
    out = model.transform(rows)
    if "_probability" in out.columns:
        out = out.withColumn("score", vector_to_array("_probability")[1])
    return out.select(*keep, "score")


def pooled(spark: SparkSession, run, jobs: Sequence, workers: int) -> list:
    """Independent fits as concurrent Spark jobs, submitted from a few driver threads.

    Every job gets a wrapper, and so a copy of the local properties, of its own: threads that share one
    clear the SQL execution ids that the others read.
    """
    with ThreadPoolExecutor(max_workers=workers) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(run), job) for job in jobs]
        return [job.result() for job in running]


def held_out_scores(df: DataFrame, make, k: int = 5, repeats: int = 2, predictors: Sequence[str] = (),
                    exclude_collisions: bool = False, keep: Sequence[str] = ("row_id", "label"), workers: int = 4,
                    seed: str = "42") -> DataFrame:
    """Action: every row scored once per repeat by a model that did not see it.

    ``exclude_collisions`` drops training rows whose predictors equal a held-out row's; the held-out
    rows stay. The folded rows are written once and each fold's scores once, so a lost executor
    repeats one fit's work at most.
    """
    rows = fold_rows(df, make, k, repeats, predictors, exclude_collisions, keep, workers, seed, False)
    return rows.drop("role")


def fold_rows(df: DataFrame, make, k: int = 5, repeats: int = 2, predictors: Sequence[str] = (), exclude_collisions: bool = False,
              keep: Sequence[str] = ("row_id", "label"), workers: int = 4, seed: str = "42", training_too: bool = True) -> DataFrame:
    """Action: the scores of every fold's held-out rows (role ``held``) and, where asked for, of the rows its model
    was fitted on (role ``train``)."""
    folds = materialize(stratified_folds(df, "row_id", "label", k, repeats, seed), "folds")

    def run(job: tuple[int, int]) -> DataFrame:
        repeat, fold = job
        part = folds.where(F.col("repeat") == repeat)
        held = part.where(F.col("fold") == fold)
        training = part.where(F.col("fold") != fold)
        if exclude_collisions:
            training = materialize(joins.without_collisions(training, held, predictors), "training")
        model = make().fit(training)
        scored = score_rows(model, held, keep).withColumn("role", F.lit("held"))
        if training_too:
            scored = scored.unionByName(score_rows(model, training, keep).withColumn("role", F.lit("train")))
        return materialize(scored.withColumns({"repeat": F.lit(repeat), "fold": F.lit(fold)}), "scores")

    parts = pooled(df.sparkSession, run, [(r, f) for r in range(repeats) for f in range(k)], workers)
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def fold_report(rows: DataFrame, cutoff: float = 0.5) -> DataFrame:
    """One row per fold of :func:`fold_rows`: rows on both sides, training rows that collisions took away,
    average precision on the training rows, and all metrics on the held-out rows."""
    keys = ["repeat", "fold"]
    sizes = rows.groupBy(*keys).agg(F.count_if(F.col("role") == "train").alias("training_rows"), F.count_if(F.col("role") == "held").alias("validation_rows"))
    whole = sizes.groupBy("repeat").agg(F.sum("validation_rows").alias("_all"))
    ranked = scoring.ranking_metrics(rows, keys=[*keys, "role"])
    train = ranked.where("role = 'train'").select(*keys, F.col("average_precision").alias("train_average_precision"))
    held = fold_metrics(rows.where("role = 'held'"), cutoff)
    return sizes.join(whole, "repeat").withColumn(
        "collision_training_exclusions", F.col("_all") - F.col("validation_rows") - F.col("training_rows")).drop("_all").join(
        train, keys, "left").join(held, keys)


def evaluation_summary(rows: DataFrame, cutoff: float = 0.5) -> DataFrame:
    """One row: mean and deviation over folds, all collision exclusions, and the metrics of each row's mean held-out score."""
    report = fold_report(rows, cutoff)
    folds = report.agg(
        F.count(F.lit(1)).alias("folds"), F.avg("average_precision").alias("cv_average_precision"),
        F.stddev_pop("average_precision").alias("cv_average_precision_std"), F.avg("roc_auc").alias("cv_roc_auc"),
        F.stddev_pop("roc_auc").alias("cv_roc_auc_std"), F.avg("train_average_precision").alias("train_average_precision"),
        F.sum("collision_training_exclusions").alias("collision_training_exclusions"))
    averaged = row_scores(rows.where("role = 'held'"))
    oof = scoring.ranking_metrics(averaged).withColumn("_one", F.lit(1)).join(
        scoring.classification_metrics(averaged, cutoff).withColumn("_one", F.lit(1)), "_one").drop("_one")
    named = oof.select(*[F.col(c).alias(f"oof_{c}") for c in oof.columns])
    return folds.withColumn("_one", F.lit(1)).join(F.broadcast(named.withColumn("_one", F.lit(1))), "_one").drop("_one")


def require_each_row(scores: DataFrame, repeats: int) -> DataFrame:
    """Action: raise unless every row was held out exactly ``repeats`` times."""
    wrong = scores.groupBy("row_id").count().where(F.col("count") != repeats).count()
    if wrong:
        raise ValueError(f"{wrong} rows were not held out exactly {repeats} times")
    return scores


def fold_metrics(scores: DataFrame, cutoff: float = 0.5) -> DataFrame:
    keys = ["repeat", "fold"]
    return scoring.ranking_metrics(scores, keys=keys).join(scoring.classification_metrics(scores, cutoff, keys), keys)


def row_scores(scores: DataFrame) -> DataFrame:
    """Mean held-out score per row."""
    return scores.groupBy("row_id", "label").agg(F.avg("score").alias("score"), F.count(F.lit(1)).alias("times"))


def nested_cutoff(df: DataFrame, make, target: float = 0.9, outer: int = 5, inner: int = 3, workers: int = 4,
                  seed: str = "42") -> DataFrame:
    """Action: per outer fold, a cutoff from inner scores only, then applied to the outer rows.

    Returns row_id, label, score, outer_fold, selected_threshold and policy_prediction.
    """
    folds = materialize(stratified_folds(df, "row_id", "label", outer, 1, seed), "outer").withColumnRenamed("fold", "outer_fold").drop("repeat")

    def run(fold: int) -> DataFrame:
        training = folds.where(F.col("outer_fold") != fold)
        calibration = held_out_scores(training, make, inner, 1, workers=inner, seed=f"{seed}-{fold}")
        chosen = scoring.select_cutoff(scoring.threshold_table(calibration), [target]).first()["threshold"]
        scored = score_rows(make().fit(training), folds.where(F.col("outer_fold") == fold), ["row_id", "label", "outer_fold"])
        flagged = scored.withColumn("selected_threshold", F.lit(float(chosen))).withColumn(
            "policy_prediction", (F.col("score") >= F.col("selected_threshold")).cast("int"))
        return materialize(flagged, "policy")

    parts = pooled(df.sparkSession, run, range(outer), workers)
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def preparation_ablation(df: DataFrame, versions: dict[str, tuple[Sequence[str], Sequence[str], bool]],
                         families: Sequence[str] = ("logistic", "forest"), k: int = 5, repeats: int = 2,
                         workers: int = 8, settings: dict[str, dict] | None = None, seed: str = "42") -> DataFrame:
    """Action: mean held-out ROC AUC per data version (rows) and model (columns), same folds throughout.

    ``settings`` holds the model's settings per family. The folds are written once; all logistic fits share passes
    over the rows, and all forests are grown in one job from counts of equal rows. Other fits, and those with too many
    columns or cells for that, share one pool of jobs, each writing its scores, and one scan reads them all.
    """
    folds = materialize(stratified_folds(df, "row_id", "label", k, repeats, seed), "folds")
    spark, base = df.sparkSession, scratch_path(df.sparkSession, "ablation")

    def run(job: tuple[str, str, int, int]) -> str:
        version, family, repeat, fold = job
        numeric, categorical, flags = versions[version]
        part = folds.where(F.col("repeat") == repeat)
        model = classifier(family, numeric, categorical, flags, **(settings or {}).get(family, {})).fit(part.where(F.col("fold") != fold))
        scored = score_rows(model, part.where(F.col("fold") == fold), ["label", "repeat", "fold"])
        path = f"{base}/{uuid4().hex}"
        scored.select(F.col("label").cast("int"), F.col("repeat").cast("int"), F.col("fold").cast("int"), F.col("score").cast("double"),
                      F.lit(version).alias("version"), F.lit(family).alias("model")).write.parquet(path)
        return path

    keys = ["version", "model", "repeat", "fold"]
    counts, done = [], set()
    for family, together in (("logistic", logistic_counts), ("forest", forest_counts)):
        if family in families:
            found, answered = together(folds, versions, k, (settings or {}).get(family))
            counts += [found.withColumn("model", F.lit(family))] if answered else []
            done |= {(v, family) for v in answered}
    jobs = [(v, f, r, fold) for f in families for v in versions for r in range(repeats) for fold in range(k) if (v, f) not in done]
    if jobs:
        scores = spark.read.schema("label int, repeat int, fold int, score double, version string, model string").parquet(*pooled(spark, run, jobs, workers))
        counts.append(scoring.score_counts(scores, keys=keys))
    per_fold = scoring.counted_ranking(reduce(DataFrame.unionByName, counts), keys)
    return per_fold.groupBy("version").pivot("model", list(families)).agg(F.avg("roc_auc"))


def batch_score(model, rows: DataFrame, numeric: Sequence[str], categorical: Sequence[str], cutoff: float,
                row_id: str = "row_id") -> DataFrame:
    """Validate, score and decide. A refused row keeps its errors and gets no score."""
    checked = validate.validate_records(rows.select(row_id, *numeric, *categorical), numeric, categorical, [row_id])
    # One pass: a refused row is scored as if its bad fields were missing, then the score is withheld.
    bad = lambda c: F.array_contains("errors", c)
    safe = checked.withColumns({c: F.when(~bad(c), F.col(c)) for c in [*numeric, *categorical]})
    scored = score_rows(model, safe, [row_id, "errors"])
    ok = F.size("errors") == 0
    return scored.withColumn("score", F.when(ok, F.col("score"))).withColumns({
        "cutoff": F.lit(float(cutoff)),
        "flag": F.when(ok, F.col("score") >= cutoff),
        "decision": F.when(~ok, "Refused").when(F.col("score") >= cutoff, "Flagged as potentially unsafe")
        .otherwise("Not flagged by this rule"),
    })
