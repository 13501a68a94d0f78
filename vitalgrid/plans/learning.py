"""Queries that fit and apply models."""

from __future__ import annotations

from multiprocessing.pool import ThreadPool

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitalgrid.functions import cleaning
from vitalgrid.functions.columns import rounded
from vitalgrid.functions.scoring import risk_tier
from vitalgrid.operators import additive, classifiers, forecasting, metrics, profile, sequences, stages
from vitalgrid.operators.registry import Registry
from vitalgrid.plans.clinical import MEASURED, SWITCHES, labelled
from vitalgrid.schemas import CATEGORY_CODES, CLINICAL_FEATURES, ENGINEERED_FEATURES, TEXT_CATEGORIES
from vitalgrid.session import materialize, new_folder, spread
from vitalgrid.sources import tables
from vitalgrid.streaming import logs

FEATURES = CLINICAL_FEATURES + ENGINEERED_FEATURES
STEPS = 60


def patients(spark: SparkSession, folder: str) -> DataFrame:
    """Raw rows with switches as numbers and the binary label (null where unlabelled)."""
    df = cleaning.map_categories(
        tables.patients(spark, folder), {c: CATEGORY_CODES[c] for c in SWITCHES}
    )
    return df.withColumn("label", F.when(F.col("num").isNotNull(), cleaning.binary_label(F.col("num"))))


def valid_scores() -> Column:
    """Whether a row of `as_scores` is a probability with its prediction and its tier."""
    p, q = F.col("probability_disease"), F.col("probability_no_disease")
    fits = p.between(0, 1) & (F.abs(p + q - 1) < 1e-9) & F.col("prediction").isin(0, 1)
    return F.coalesce(fits & (F.col("risk_level") == risk_tier(p)), F.lit(False))


def held_out_scores(spark, folder, name: str) -> DataFrame:
    """Scores of the test rows by one model, fitted on the training part."""
    rows = labelled(spark, folder).select("id", "label", *FEATURES)
    split = materialize(sequences.stratified_split(rows, "label", "id"), "split")
    train, test = split.filter("part = 'train'"), split.filter("part = 'test'")
    scales = classifiers.fit_scales(train, FEATURES) if name in classifiers.SCALED else None
    train = spread(materialize(classifiers.with_vectors(train, FEATURES, scales), "train"))
    test = classifiers.with_vectors(test, FEATURES, scales)
    made = classifiers.estimators(train.count(), len(FEATURES))[name]()
    return materialize(classifiers.as_scores(stages.fitted(made, train).transform(test), "id", "label"), "scores")


def nb_scores(spark, folder):
    """The scores themselves: Gaussian naive Bayes has a closed form."""
    scored = held_out_scores(spark, folder, "naive_bayes")
    return scored.select("id", "label", "prediction", rounded("probability_disease").alias("probability"), "risk_level")


def _scores(name: str):
    """Hold-out check of one model: a row for each test row with whether its scores are valid, and a
    row with whether the model beats the majority class."""
    def query(spark, folder):
        scored = held_out_scores(spark, folder, name)
        ones = F.avg("label")
        hits = F.avg((F.col("prediction") == F.col("label")).cast("double"))
        none = F.lit(None)
        return scored.select("id", "label", valid_scores().alias("valid"), none.cast("boolean").alias("beats_majority")).union(
            scored.agg((hits > F.greatest(ones, 1 - ones)).alias("better")).select(
                none.cast("bigint"), none.cast("int"), none.cast("boolean"), "better"
            )
        )

    return query


#: Area under the curve that a model must reach to count as one that learnt; a constant has 0.5.
LEARNT = 0.6


def majority(df: DataFrame) -> float:
    """Accuracy of always naming the larger class."""
    ones = df.agg(F.avg("label")).first()[0]
    return max(ones, 1 - ones)


def compare_models(spark, folder):
    """Every model of the leaderboard, with whether it learnt: on the hold-out and over the folds it
    beats the larger class and ranks the rows."""
    rows = materialize(labelled(spark, folder).select("id", "label", *FEATURES), "labelled")
    least = majority(rows)
    board = metrics.leaderboard(classifiers.compare_models(rows, FEATURES))
    learnt = [F.col(c).between(least, 1) for c in ("accuracy", "cv_accuracy_mean")]
    learnt += [F.col(c).between(LEARNT, 1) for c in ("auc", "cv_auc_mean")]
    return board.select("model", (learnt[0] & learnt[1] & learnt[2] & learnt[3]).alias("valid"))


def grid_search(spark, folder):
    """Every parameter set with its cross-validated accuracy in a table of its own rank, best first, and
    whether it beats the larger class."""
    df = materialize(labelled(spark, folder).select("id", "label", *FEATURES), "labelled")
    board = classifiers.grid_search(df, FEATURES)[0]
    return board.select(
        "parameters", (F.col("rank").isNotNull() & F.col("accuracy").between(majority(df), 1)).alias("valid")
    )


def _risk_model(df: DataFrame, preprocessor=None) -> classifiers.RiskModel:
    return classifiers.fit_risk_model(
        df.filter(F.col("label").isNotNull()), MEASURED + SWITCHES, TEXT_CATEGORIES,
        preprocessor=preprocessor,
    )


def learnt(scored: DataFrame) -> bool:
    """Whether scores of labelled rows beat the larger class and rank them."""
    hits = scored.agg(F.avg((F.col("prediction") == F.col("label")).cast("double"))).first()[0]
    curve = metrics.roc_auc(scored.select(F.col("label").alias("y"), F.col("probability_disease").alias("score")))
    return hits > majority(scored) and curve.first()[0] > LEARNT


def batch_score(spark, folder):
    """Unlabelled rows scored by a forest fitted on the labelled ones, which also beats the larger
    class on rows it was not fitted on."""
    df = materialize(patients(spark, folder), "patients")
    known = df.filter(F.col("label").isNotNull())
    split = materialize(sequences.stratified_split(known, "label", "id"), "split")
    model = _risk_model(split.filter("part = 'train'").drop("part"))
    held = materialize(model.score(split.filter("part = 'test'"), "id", "label"), "held")
    scored = model.score(cleaning.route_by_label(df)[0], "id")
    return scored.select("id", (valid_scores() & F.lit(learnt(held))).alias("valid"))


def model_roundtrip(spark, folder):
    """Rows whose prediction differs between a model and its stored copy: none expected."""
    df = patients(spark, folder)
    model = _risk_model(df)
    registry = Registry(spark, new_folder(spark, "registry"))
    registry.save(1, model.stages, model.preprocessor, trained_on="clinical")
    loaded_stages, preprocessor = registry.load(registry.latest())
    loaded = classifiers.RiskModel(preprocessor, loaded_stages)
    before, after = model.score(df, "id"), loaded.score(df, "id")
    joined = before.join(after.select("id", F.col("probability_disease").alias("p")), "id")
    same = F.abs(F.col("probability_disease") - F.col("p")) < 1e-12
    return joined.agg(F.count(F.lit(1)).alias("rows"), F.count_if(~same).alias("different"))


def retrain(spark, folder):
    """Versions of a model over three site datasets: first fit, new rows only, all rows so far."""
    df = patients(spark, folder).filter("num is not null")
    sites = {s: df.filter(F.col("dataset") == s) for s in ("site_a", "site_b", "site_c")}
    registry = Registry(spark, new_folder(spark, "registry"))
    first = _risk_model(sites["site_a"])
    registry.save(1, first.stages, first.preprocessor, mode="initial")
    newer, _ = tables.union_sources(spark, {s: sites[s] for s in ("site_b",)})
    second = _risk_model(newer, first.preprocessor)
    registry.save(2, second.stages, second.preprocessor, mode="retrain")
    everything, _ = tables.union_sources(spark, sites)
    third = _risk_model(everything, first.preprocessor)
    registry.save(3, third.stages, third.preprocessor, mode="incremental")
    boards = []
    for version in (1, 2, 3):
        loaded, preprocessor = registry.load(version)
        scored = materialize(classifiers.RiskModel(preprocessor, loaded).score(everything, "id", "label"), "scored")
        boards.append(scored.agg(
            F.lit(version).alias("version"), F.lit(registry.facts(version)["mode"]).alias("mode"),
            F.count(F.lit(1)).alias("rows"),
            # The first two know one site each, whose rows may all have one label.
            (F.avg((F.col("prediction") == F.col("label")).cast("double")).between(0.5, 1) & F.lit(version < 3 or learnt(scored))).alias("valid"),
        ))
    return boards[0].unionByName(boards[1]).unionByName(boards[2])


def full_analysis(spark, folder):
    """The whole run: profile, preparation, split, all models, their ranking, the evaluation of the
    best forest, its inputs by weight, and the stored version: `(section, name, valid)`."""
    rows = materialize(labelled(spark, folder).select("id", "label", *FEATURES), "prepared")
    missing = profile.missing_profile(rows.select(*FEATURES)).select(
        F.lit("missing").alias("section"), F.col("column").alias("name"), (F.col("missing") == 0).alias("valid")
    )
    split = materialize(sequences.stratified_split(rows, "label", "id"), "split")
    train, test = split.filter("part = 'train'"), split.filter("part = 'test'")
    scales = classifiers.fit_scales(train, FEATURES)
    train = spread(materialize(classifiers.with_vectors(train, FEATURES, scales), "train"))
    test = classifiers.with_vectors(test, FEATURES, scales)
    made = classifiers.estimators(train.count(), len(FEATURES))
    least, test = majority(rows), materialize(test, "test")

    def fit(name):
        model = stages.fitted(made[name](), train)
        accuracy, auc = classifiers.quality(model.transform(test))
        return model, ("ranking", name, least <= accuracy <= 1 and LEARNT <= auc <= 1)

    # Independent fits share the cluster.
    with ThreadPool(len(made)) as pool:
        found = dict(zip(made, pool.map(fit, made, chunksize=1)))
    ranked, forest = [rank for _, rank in found.values()], found["random_forest"][0]
    scored = forest.transform(test).select(
        F.col("label").alias("y"), F.col("prediction").cast("int").alias("pred"),
        classifiers.probability_of_one().alias("score"),
    )
    report = metrics.evaluate(scored).select(
        F.lit("metric").alias("section"), F.col("metric").alias("name"), F.col("value").isNotNull().alias("valid")
    )
    weights = classifiers.importance_table(forest, FEATURES, spark).select(
        F.lit("importance").alias("section"), F.col("feature").alias("name"), F.col("weight").between(0, 1).alias("valid")
    )
    registry = Registry(spark, new_folder(spark, "registry"))
    version = registry.save(1, PipelineModel(stages=[forest]), mode="analysis")
    summary = spark.createDataFrame(
        [*ranked, ("version", str(version), registry.latest() == version)], "section string, name string, valid boolean"
    )
    return missing.union(report).union(weights).union(summary)


# Forecasts ---------------------------------------------------------------------------------


#: Correlation that the residual of a fit may still have with an input: the penalty leaves less than
#: this, and a model that did not learn leaves the correlations of the data.
UNEXPLAINED = 2e-3


def is_fitted(model: forecasting.Forecaster, windows: DataFrame) -> bool:
    """Whether the regression solves the normal equations of its training windows: whatever the rows,
    no input may explain what the model leaves over."""
    features = forecasting.scaled_lags("sequence", model.scale, model.columns)
    rows = windows.filter(~F.col("held")).select(
        features.alias("features"), forecasting.scaled(F.col("target"), model.scale).alias("target")
    )
    fitted = model.stages.stages[-1]
    sums = additive.Moments.of(rows, len(fitted.coefficients))
    return sums.leftover(fitted.coefficients.toArray(), fitted.intercept) < UNEXPLAINED


def checked_forecasts(model: forecasting.Forecaster, windows: DataFrame) -> DataFrame:
    """Held-out forecasts: a row is valid if the model is fitted and its forecast and error are those of
    the model's own coefficients."""
    fitted = model.stages.stages[-1]
    weights = F.array(*[F.lit(float(w)) for w in fitted.coefficients])
    lags = forecasting.scaled_lags("sequence", model.scale, model.columns)
    scaled = F.aggregate(F.zip_with(lags, weights, lambda x, w: x * w), F.lit(float(fitted.intercept)), lambda a, x: a + x)
    held = windows.filter("held").drop("held").withColumn("own", scaled * model.scale[1] + model.scale[0])
    gap = F.abs(F.col("own") - F.col("actual"))
    close = (F.abs(F.col("predicted") - F.col("own")) < 1e-6) & (F.abs(F.col("error") - gap) < 1e-6)
    return forecasting.score_windows(model, held).select(
        "series_id", "event_id", "actual", (F.coalesce(close, F.lit(False)) & F.lit(is_fitted(model, windows))).alias("valid")
    )


def forecast(spark, folder):
    """Held-out forecasts of the regression on the last 60 readings."""
    df = tables.series(spark, folder)
    windows = materialize(forecasting.training_windows(df, "use_kw", STEPS), "windows")
    return checked_forecasts(forecasting.fit_forecaster(df, "use_kw", STEPS, stored=windows), windows)


def pipeline_roundtrip(spark, folder):
    """Rows whose score differs between a pipeline with its preparation and its stored copy: none."""
    df = materialize(patients(spark, folder), "patients")
    whole = stages.pipeline(MEASURED + SWITCHES, TEXT_CATEGORIES, classifiers.random_forest())
    model = stages.fitted(whole, spread(df.filter(F.col("label").isNotNull())))
    target = new_folder(spark, "pipeline")
    model.write().overwrite().save(target)
    p = classifiers.probability_of_one()
    before, after = (m.transform(df).select("id", p.alias(name)) for m, name in ((model, "p"), (PipelineModel.load(target), "q")))
    same = F.abs(F.col("p") - F.col("q")) < 1e-12
    return before.join(after, "id").agg(F.count(F.lit(1)).alias("rows"), F.count_if(~same).alias("different"))


def pipeline_folds(spark, folder):
    """Accuracy of a whole pipeline per fold: preparation and model are fitted without the fold."""
    known = patients(spark, folder).filter(F.col("label").isNotNull())
    rows = materialize(sequences.stratified_kfold(known, "label", "id", 5), "folds")
    whole = stages.pipeline(MEASURED + SWITCHES, TEXT_CATEGORIES, classifiers.decision_tree())
    least = majority(rows)
    return stages.fold_accuracy(whole, rows, "label").select(
        "fold", "rows", F.col("accuracy").between(least, 1).alias("valid")
    )


def _two_runs(spark, folder):
    """First model on the oldest 80 % of each series, second on the whole history."""
    df = tables.series(spark, folder)
    past = sequences.chrono_split(df, 0.2).filter("part = 'train'").drop("part")
    first = forecasting.fit_forecaster(past, "use_kw", STEPS)
    second = forecasting.fit_forecaster(df, "use_kw", STEPS)
    return df, first, second


def forecast_retrain(spark, folder):
    """Next reading of every series, by the model before and after the refit."""
    df, first, second = _two_runs(spark, folder)
    registry = Registry(spark, new_folder(spark, "registry"))
    versions = {v: m for v, m in ((1, first), (2, second)) if m is not None}
    for version, model in versions.items():
        registry.save(version, model.stages, steps=model.steps, scale=list(model.scale))
    newest = sequences.latest_sequence(df, "use_kw", STEPS)
    out = None
    for version in versions:
        loaded, _ = registry.load(version)
        facts = registry.facts(version)
        model = forecasting.Forecaster(facts["steps"], tuple(facts["scale"]), loaded, {})
        part = model.predict(newest).select(
            "series_id", "event_id", F.lit(version).alias("version"), F.col("predicted").isNotNull().alias("valid")
        )
        out = part if out is None else out.unionByName(part)
    return out


def training_history(spark, folder):
    _, first, second = _two_runs(spark, folder)
    target = new_folder(spark, "history")
    for run, model in ((1, first), (2, second)):
        if model is None:  # no window in so short a past
            continue
        logs.append_batch(forecasting.training_runs(spark, [model.run]), target, run)
    return logs.read_log(spark, target).select(
        F.col("batch_id").alias("run"), "samples", F.col("final_loss").between(0, 1e9).alias("valid")
    )


QUERIES = {
    "rf_scores": _scores("random_forest"),
    "gbt_scores": _scores("gradient_boosting"),
    "logreg_scores": _scores("logistic_regression"),
    "rbf_svc_scores": _scores("rbf_svc"),
    "dtree_scores": _scores("decision_tree"),
    "mlp_scores": _scores("mlp"),
    "knn_scores": _scores("knn"),
} | {
    f.__name__: f
    for f in (
        nb_scores, compare_models, grid_search, batch_score, model_roundtrip, pipeline_roundtrip, pipeline_folds,
        retrain, full_analysis,
        forecast, forecast_retrain, training_history,
    )
}
