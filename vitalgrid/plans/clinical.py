"""Queries over the clinical table: sources, cleaning, encoding, profiles, splits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitalgrid.functions import cleaning, features
from vitalgrid.functions.columns import rounded
from vitalgrid.operators import augment, bayes, encoding, metrics, profile, sequences, sketches
from vitalgrid.operators.quantiles import exact_medians
from vitalgrid.schemas import (
    CATEGORY_CODES,
    CLINICAL_CSV,
    CLINICAL_FEATURES,
    ENGINEERED_FEATURES,
    TEXT_CATEGORIES,
)
from vitalgrid.session import materialize, new_folder
from vitalgrid.sources import messages, tables
from vitalgrid.streaming import progress

MEASURED = ["age", "trestbps", "chol", "thalch", "oldpeak", "ca"]
SWITCHES = ["fbs", "exang"]


def validated(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.validate(tables.patients(spark, folder)).withColumn(
        "label", cleaning.binary_label(F.col("num"))
    )


def imputed(spark: SparkSession, folder: str) -> DataFrame:
    df = validated(spark, folder)
    return encoding.impute(df, exact_medians(df, CLINICAL_FEATURES))


def labelled(spark: SparkSession, folder: str) -> DataFrame:
    """Cleaned rows that carry a label, with the risk features."""
    return features.add_risk_features(imputed(spark, folder).filter(F.col("num").isNotNull()))


# Sources -----------------------------------------------------------------------------------


def scan_csv(spark, folder):
    path = tables.write_csv(
        tables.patients(spark, folder).select(*CLINICAL_CSV.names), new_folder(spark, "csv")
    )
    return tables.read_csv(spark, path, CLINICAL_CSV)


def head_n(spark, folder):
    df = tables.patients(spark, folder).select("id", "dataset", "age", "num")
    return sequences.first_rows(df, 100, "id")


def json_decode(spark, folder):
    raw = tables.read_table(spark, folder, "events").select("event_id", F.col("props").alias("value"))
    schema = messages.StructType([messages.StructField("k", messages.StringType())])
    good, _ = messages.split_corrupt(messages.decode_json(raw, schema, keep=["event_id"]))
    return good.select("event_id", F.col("k").try_cast("bigint").alias("k"))


def json_encode(spark, folder):
    df = tables.patients(spark, folder).withColumn("data_type", F.lit("clinical"))
    columns = ["id", *MEASURED, "sex", "cp", "thal", "num", "data_type"]
    sent = messages.encode_messages(df, F.col("id"), columns, defaults=True)
    schema = messages.StructType([f for f in df.select(*columns).schema])
    return messages.decode_json(sent, schema, keep=["key"]).drop(messages.CORRUPT)


def pair_emit(spark, folder):
    df = tables.patients(spark, folder).select("id", "dataset", "age", "num")
    return messages.emit_pairs(df, "id", batch_size=100)


def multi_source_union(spark, folder):
    patients = tables.patients(spark, folder).select("id", "age", F.col("num").alias("label"))
    docs = tables.labelled_docs(spark, folder).select(
        F.col("doc_id").alias("id"), "n_chars", F.col("quality").alias("label")
    )
    union, _ = tables.union_sources(
        spark,
        {"clinical": patients, "missing": new_folder(spark, "absent"), "documents": docs},
    )
    return union.select("source", "id", "age", "n_chars", "label")


def ingest_tally(spark, folder):
    events = tables.read_table(spark, folder, "events").select(
        F.lit("events").alias("batch"), F.col("props").alias("value")
    )
    docs = tables.read_table(spark, folder, "documents").select(
        F.lit("documents").alias("batch"), F.col("text").alias("value")
    )
    schema = messages.StructType([messages.StructField("k", messages.StringType())])
    parsed = messages.decode_json(events.unionByName(docs), schema, keep=["batch"])
    return profile.ingest_tally(parsed, F.col(messages.CORRUPT).isNull(), "batch")


def observed_tally(spark, folder):
    """The tally of all messages, taken while they are written: no job of its own."""
    parsed = messages.decode_json(
        tables.read_table(spark, folder, "events").select(F.col("props").alias("value")).union(
            tables.read_table(spark, folder, "documents").select("text")
        ), messages.StructType([messages.StructField("k", messages.StringType())]),
    )
    told = progress.write_observed(
        parsed, progress.tally(F.col(messages.CORRUPT).isNull()),
        lambda df: df.write.parquet(new_folder(spark, "messages")),
    )
    return spark.createDataFrame([(told["sent"], told["failed"])], "sent long, failed long")


def _sketched(spark, folder) -> str:
    """The patients in three appended batches, each sketched when it came."""
    target = new_folder(spark, "sketches")
    df = tables.patients(spark, folder)
    for batch in range(3):
        sketches.append_sketch(df.filter(F.col("id") % 3 == batch), target, batch)
    return target


def sketch_parts(spark, folder):
    """What merges exactly of the profile of all batches."""
    found = sketches.stored_profile(spark, _sketched(spark, folder))
    return found.select("column", "type", "n_rows", "n_values", *[rounded(c).alias(c) for c in ("mean", "std", "low", "high")])


def sketch_profile(spark, folder):
    """The whole profile of all batches, with distinct values and quartiles as estimates."""
    return sketches.stored_profile(spark, _sketched(spark, folder))


# Cleaning and features ---------------------------------------------------------------------


def select_features(spark, folder):
    df = tables.patients(spark, folder)
    return cleaning.select_features(df, ["age", "chol", "bmi", "trestbps", "oldpeak"], keep=["id"])


def route_by_label(spark, folder):
    def routed(df, key, label, name):
        score, train = cleaning.route_by_label(df, label)
        return score.select(F.lit(name).alias("source"), F.col(key).alias("id"), F.lit("score").alias("route")).unionByName(
            train.select(F.lit(name).alias("source"), F.col(key).alias("id"), F.lit("train").alias("route"))
        )

    return routed(tables.patients(spark, folder), "id", "num", "clinical").unionByName(
        routed(tables.labelled_docs(spark, folder), "doc_id", "quality", "documents")
    )


def fill_defaults(spark, folder):
    columns = ["trestbps", "chol", "ca"]
    return cleaning.fill_defaults(tables.patients(spark, folder), columns).select("id", *columns)


def binarize_label(spark, folder):
    return tables.patients(spark, folder).select("id", cleaning.binary_label(F.col("num")).alias("label"))


def coerce_numeric(spark, folder):
    columns = ["age", "cp", "fbs", "thal", "trestbps"]
    return cleaning.coerce_numeric(tables.patients(spark, folder), columns).select("id", *columns)


def map_categories(spark, folder):
    return cleaning.map_categories(tables.patients(spark, folder)).select("id", *CATEGORY_CODES)


def clamp_ranges(spark, folder):
    return validated(spark, folder).select("id", *CLINICAL_FEATURES)


def _features(spark, folder, names):
    df = validated(spark, folder)
    made = features.feature_columns(df.columns)
    return df.select("id", *[made[name].alias(name) for name in names])


def bucketize(spark, folder):
    return _features(spark, folder, ["age_group", "chol_risk", "bp_category"])


def risk_flags(spark, folder):
    return _features(spark, folder, [
        "elderly", "high_chol", "hypertension", "typical_angina", "asymptomatic",
        "significant_st_depression", "thal_normal", "thal_defect", "exercise_intolerance",
    ])


def hr_reserve(spark, folder):
    return _features(spark, folder, ["hr_reserve", "low_hr_reserve"]).withColumn(
        "hr_reserve", rounded("hr_reserve")
    )


def risk_score(spark, folder):
    return _features(spark, folder, ["total_risk_factors", "high_risk"])


def feature_engineering(spark, folder):
    df = features.add_risk_features(imputed(spark, folder))
    return df.select("id", *ENGINEERED_FEATURES).withColumn("hr_reserve", rounded("hr_reserve"))


def clean_and_engineer(spark, folder):
    df = features.add_risk_features(imputed(spark, folder))
    return df.select(
        "id", *[rounded(c).alias(c) for c in CLINICAL_FEATURES],
        "age_group", "total_risk_factors", "thal_defect", "label",
    )


# Encoding ----------------------------------------------------------------------------------


def label_encode(spark, folder):
    return encoding.fit_dictionary(tables.patients(spark, folder), TEXT_CATEGORIES)


def label_encode_transform(spark, folder):
    """Dictionary of the normalised texts, applied to the raw ones: some are unknown."""
    df = tables.patients(spark, folder)
    tidy = df.withColumns({c: F.lower(F.trim(F.col(c))) for c in TEXT_CATEGORIES})
    fitted = encoding.Dictionary.of(encoding.fit_dictionary(tidy, TEXT_CATEGORIES))
    return encoding.encode(df, TEXT_CATEGORIES, fitted, suffix="_code").select(
        "id", *[f"{c}_code" for c in TEXT_CATEGORIES]
    )


def median_impute(spark, folder):
    return imputed(spark, folder).select("id", *[rounded(c).alias(c) for c in CLINICAL_FEATURES])


def standard_scale_fit(spark, folder):
    return encoding.fit_scale(imputed(spark, folder), CLINICAL_FEATURES).select(
        "feature", rounded("mean").alias("mean"), rounded("std").alias("std")
    )


def standard_scale(spark, folder):
    df = imputed(spark, folder)
    scale = encoding.collect_scale(encoding.fit_scale(df, CLINICAL_FEATURES))
    return encoding.standard_scale(df, scale).select(
        "id", *[rounded(c).alias(c) for c in CLINICAL_FEATURES]
    )


def preprocess(spark, folder):
    df = cleaning.map_categories(
        tables.patients(spark, folder), {c: CATEGORY_CODES[c] for c in SWITCHES}
    )
    fitted = encoding.Preprocessor(MEASURED + SWITCHES).fit(df)
    return fitted.transform(df).select("id", *[rounded(c).alias(c) for c in fitted.features])


# Profiles ----------------------------------------------------------------------------------


def row_count(spark, folder):
    return profile.row_count(tables.patients(spark, folder))


def class_distribution(spark, folder):
    return profile.class_distribution(tables.patients(spark, folder), "num")


def source_distribution(spark, folder):
    return profile.class_distribution(tables.patients(spark, folder), "dataset")


def minority_class(spark, folder):
    return profile.minority_class(tables.patients(spark, folder).filter("num is not null"), "num")


def missing_profile(spark, folder):
    clinical = profile.missing_profile(tables.patients(spark, folder)).withColumn("source", F.lit("clinical"))
    docs = profile.missing_profile(tables.labelled_docs(spark, folder)).withColumn("source", F.lit("documents"))
    return clinical.unionByName(docs)


def describe(spark, folder):
    return profile.describe(tables.patients(spark, folder), MEASURED)


def schema_profile(spark, folder):
    return profile.schema_profile(tables.patients(spark, folder))


def distinct_preview(spark, folder):
    return profile.distinct_preview(tables.patients(spark, folder), [*TEXT_CATEGORIES, *SWITCHES])


def training_check(spark, folder):
    return profile.training_check(tables.patients(spark, folder), "num", CLINICAL_FEATURES)


# Splits and blocks -------------------------------------------------------------------------


def _with_label(spark, folder):
    return tables.patients(spark, folder).filter("num is not null").withColumn(
        "label", cleaning.binary_label(F.col("num"))
    )


def train_blocks(spark, folder):
    return sequences.blocks(_with_label(spark, folder).select("id", "label"), 5, "id")


def stratified_split(spark, folder):
    return sequences.stratified_split(_with_label(spark, folder).select("id", "label"), "label", "id")


def stratified_kfold(spark, folder):
    return sequences.stratified_kfold(_with_label(spark, folder).select("id", "label"), "label", "id")


def augment_minority(spark, folder):
    """Blocks of five rows, each balanced the way the first training block is."""
    df = sequences.blocks(_with_label(spark, folder).select("id", "label", *MEASURED), 5, "id")
    rows = augment.augment_minority(df, block="block")
    return rows.select(
        "id", "block", "label", "synthetic", *[rounded(c).alias(c) for c in MEASURED]
    )


# Models with a closed form -----------------------------------------------------------------


def gaussian_nb(spark, folder):
    df = imputed(spark, folder)
    model = bayes.fit_bayes(df.filter("num is not null"), CLINICAL_FEATURES, "label")
    return df.select("id", model.prediction().alias("predicted"))


def _folds(spark, folder):
    df = imputed(spark, folder).filter("num is not null").select("id", "label", *CLINICAL_FEATURES)
    return materialize(sequences.stratified_kfold(df, "label", "id", 5), "folds")


def cv_fold_accuracy(spark, folder):
    return bayes.fold_accuracy(_folds(spark, folder), CLINICAL_FEATURES, "label").withColumn(
        "accuracy", rounded("accuracy")
    )


def cv_summary(spark, folder):
    return metrics.cv_summary(bayes.fold_accuracy(_folds(spark, folder), CLINICAL_FEATURES, "label"))


QUERIES = {
    f.__name__: f
    for f in (
        scan_csv, head_n, json_decode, json_encode, pair_emit, multi_source_union, ingest_tally,
        observed_tally, sketch_parts, sketch_profile,
        select_features, route_by_label, fill_defaults, binarize_label, coerce_numeric,
        map_categories, clamp_ranges, bucketize, risk_flags, hr_reserve, risk_score,
        feature_engineering, clean_and_engineer, label_encode, label_encode_transform,
        median_impute, standard_scale_fit, standard_scale, preprocess, row_count,
        class_distribution, source_distribution, minority_class, missing_profile, describe,
        schema_profile, distinct_preview, training_check, train_blocks, stratified_split,
        stratified_kfold, augment_minority, gaussian_nb, cv_fold_accuracy, cv_summary,
    )
}
