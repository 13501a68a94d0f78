"""Evaluation tables of classifiers and forecasts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vitalgrid.functions.columns import ratio, rounded
from vitalgrid.operators.ordered import range_buckets, running_totals
from vitalgrid.operators.quantiles import exact_medians

# Classification ----------------------------------------------------------------------------


def accuracy(df: DataFrame, y: str = "y", pred: str = "pred") -> DataFrame:
    hit = (F.col(y) == F.col(pred)).cast("double")
    return df.agg(rounded(F.avg(hit)).alias("accuracy"))


def confusion_matrix(df: DataFrame, y: str = "y", pred: str = "pred") -> DataFrame:
    return df.groupBy(F.col(y).alias("actual")).agg(
        F.count_if(F.col(pred) == 0).alias("predicted_0"),
        F.count_if(F.col(pred) == 1).alias("predicted_1"),
    )


def outcome_counts(df: DataFrame, y: str = "y", pred: str = "pred") -> DataFrame:
    y, pred = F.col(y), F.col(pred)
    return df.agg(
        F.count_if((y == 0) & (pred == 0)).alias("tn"),
        F.count_if((y == 0) & (pred == 1)).alias("fp"),
        F.count_if((y == 1) & (pred == 0)).alias("fn"),
        F.count_if((y == 1) & (pred == 1)).alias("tp"),
    )


def diagnostic_rates(df: DataFrame, y: str = "y", pred: str = "pred") -> DataFrame:
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    return outcome_counts(df, y, pred).select(
        "tn", "fp", "fn", "tp",
        rounded(ratio(tp, tp + fn)).alias("sensitivity"),
        rounded(ratio(tn, tn + fp)).alias("specificity"),
        rounded(ratio(tp, tp + fp)).alias("ppv"),
        rounded(ratio(tn, tn + fn)).alias("npv"),
    )


def classification_report(
    df: DataFrame, y: str = "y", pred: str = "pred", classes: Sequence[int] = (0, 1)
) -> DataFrame:
    """Precision, recall, F1 and support per class, with accuracy and both averages.

    One pass over the rows; everything after it is arithmetic on one row.
    """
    counts = df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col(y) == F.col(pred)).alias("hits"),
        *[
            value.alias(f"{tag}{i}")
            for i, c in enumerate(classes)
            for tag, value in (
                ("hit", F.count_if((F.col(y) == c) & (F.col(pred) == c))),
                ("said", F.count_if(F.col(pred) == c)),
                ("support", F.count_if(F.col(y) == c)),
            )
        ],
    )

    def scores(i):
        hit, said, support = F.col(f"hit{i}"), F.col(f"said{i}"), F.col(f"support{i}")
        precision, recall = ratio(hit, said), ratio(hit, support)
        return precision, recall, ratio(2 * precision * recall, precision + recall), support

    def row(name, precision, recall, f1, support):
        return F.struct(
            F.lit(name).alias("class"),
            rounded(precision).alias("precision"),
            rounded(recall).alias("recall"),
            rounded(f1).alias("f1"),
            support.cast("bigint").alias("support"),
        )

    per_class = [scores(i) for i in range(len(classes))]
    total, size = F.col("rows"), len(classes)
    macro = [sum(s[k] for s in per_class) / size for k in range(3)]
    weighted = [ratio(sum(s[k] * s[3] for s in per_class), total) for k in range(3)]
    overall = ratio(F.col("hits"), total)
    entries = F.array(
        *[row(str(c), *s) for c, s in zip(classes, per_class)],
        row("accuracy", overall, overall, overall, total),
        row("macro avg", *macro, total),
        row("weighted avg", *weighted, total),
    )
    return counts.select(F.explode(entries).alias("e")).select("e.*")


def score_totals(
    df: DataFrame, y: str = "y", score: str = "score", rows_per_bucket: int | None = None
) -> DataFrame:
    """Per distinct score: positives and negatives at or above it, and of the whole table.

    Rows shrink to distinct scores first; the running sums go through range buckets.
    """
    per_score = df.groupBy(F.col(score).alias("threshold")).agg(
        F.count_if(F.col(y) == 1).alias("pos"), F.count_if(F.col(y) == 0).alias("neg")
    )
    falling = per_score.withColumn("_falling", -F.col("threshold"))
    return running_totals(
        range_buckets(falling, "_falling", rows_per_bucket=rows_per_bucket),
        ["_falling"],
        {"tp": F.col("pos"), "fp": F.col("neg")},
    ).drop("_falling")


def roc_auc(df: DataFrame, y: str = "y", score: str = "score", **how) -> DataFrame:
    """Area under the ROC curve, ties count half; null where one class is absent."""
    totals = score_totals(df, y, score, **how)
    # Negatives strictly below a score: all of them but those at or above it.
    wins = F.col("pos") * (F.col("fp_all") - F.col("fp") + F.col("neg") / 2)
    p, n = F.max("tp_all"), F.max("fp_all")
    return totals.agg(
        rounded(F.when((p > 0) & (n > 0), F.sum(wins) / p / n)).alias("auc")
    )


def roc_curve(df: DataFrame, y: str = "y", score: str = "score", **how) -> DataFrame:
    totals = score_totals(df, y, score, **how)
    points = totals.select(
        F.col("threshold").cast("double").alias("threshold"),
        rounded(ratio(F.col("fp"), F.col("fp_all"))).alias("fpr"),
        rounded(ratio(F.col("tp"), F.col("tp_all"))).alias("tpr"),
    )
    origin = df.sparkSession.range(1).select(
        F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")
    )
    return points.unionByName(origin)


def pr_curve(df: DataFrame, y: str = "y", score: str = "score", **how) -> DataFrame:
    totals = score_totals(df, y, score, **how)
    points = totals.select(
        F.col("threshold").cast("double").alias("threshold"),
        rounded(ratio(F.col("tp"), F.col("tp") + F.col("fp"))).alias("precision"),
        rounded(ratio(F.col("tp"), F.col("tp_all"))).alias("recall"),
    )
    end = df.sparkSession.range(1).select(
        F.lit(None).cast("double").alias("threshold"),
        F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"),
    )
    return points.unionByName(end)


def prob_histogram(df: DataFrame, y: str = "y", score: str = "score", bins: int = 20) -> DataFrame:
    """Rows per class and bin; each class has its own range in equal bins, the last one closed."""
    value = F.col(score)
    limits = {
        row[y]: (row["low"], row["high"])
        for row in df.filter(F.col(y).isin(0, 1)).groupBy(y)
        .agg(F.min(value).alias("low"), F.max(value).alias("high")).collect()
    }
    place = F.lit(None).cast("double")
    for label, (low, high) in limits.items():
        width = (high - low) or 1.0
        place = F.when(F.col(y) == label, (value - F.lit(low)) / F.lit(width) * bins).otherwise(place)
    return (
        df.filter(F.col(y).isin(0, 1))
        .groupBy(F.col(y), F.least(F.floor(place), F.lit(bins - 1)).cast("bigint").alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def evaluate(df: DataFrame, y: str = "y", pred: str = "pred", score: str = "score") -> DataFrame:
    """`(metric, value)`: accuracy, AUC, outcome counts and rates of a scored table.

    One pass: rows shrink to `(score, y, pred)` counts that every metric shares.
    """
    cells = df.groupBy(
        F.col(score).alias("score"), F.col(y).alias("y"), F.col(pred).alias("pred")
    ).agg(F.count(F.lit(1)).alias("n"))
    per_score = cells.groupBy("score").agg(*[
        F.sum(F.when((F.col("y") == a) & (F.col("pred") == b), F.col("n")).otherwise(0)).alias(tag)
        for tag, a, b in (("tn_", 0, 0), ("fp_", 0, 1), ("fn_", 1, 0), ("tp_", 1, 1))
    ])
    ranked = running_totals(
        range_buckets(per_score, "score"), ["score"], {"below": F.col("tn_") + F.col("fp_")}
    )
    neg = F.col("tn_") + F.col("fp_")
    wins = (F.col("fn_") + F.col("tp_")) * (F.col("below") - neg / 2)
    row = ranked.agg(
        *[F.sum(f"{c}_").alias(c) for c in ("tn", "fp", "fn", "tp")], F.sum(wins).alias("wins")
    )
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    p, n = tp + fn, tn + fp
    precision, recall = ratio(tp, tp + fp), ratio(tp, p)
    values = {
        "accuracy": ratio(tp + tn, p + n),
        "auc": F.when((p > 0) & (n > 0), F.col("wins") / p / n),
        "precision": precision,
        "recall": recall,
        "f1": ratio(2 * precision * recall, precision + recall),
        "specificity": ratio(tn, n),
        "tn": tn, "fp": fp, "fn": fn, "tp": tp,
    }
    entries = F.array(*[
        F.struct(F.lit(k).alias("metric"), rounded(v.cast("double")).alias("value"))
        for k, v in values.items()
    ])
    return row.select(F.explode(entries).alias("e")).select("e.*")


# Model comparison --------------------------------------------------------------------------


def cv_summary(folds: DataFrame, value: str = "accuracy") -> DataFrame:
    return folds.agg(
        F.count(F.lit(1)).alias("folds"),
        rounded(F.avg(value)).alias("mean"),
        rounded(F.stddev_pop(value)).alias("std"),
    )


def leaderboard(scores: DataFrame) -> DataFrame:
    """Models by the plain mean of accuracy and AUC, best first."""
    rank_score = F.col("accuracy") * 0.5 + F.col("auc") * 0.5
    return scores.withColumn("rank_score", rounded(rank_score)).orderBy(
        F.col("rank_score").desc(), "model"
    )


# Importance tables -------------------------------------------------------------------------


def importance_topk(df: DataFrame, k: int = 10) -> DataFrame:
    return df.orderBy(F.col("weight").desc(), "feature").limit(k)


def topk_others(df: DataFrame, k: int = 8) -> DataFrame:
    """The k heaviest entries, all others summed into one row."""
    top = importance_topk(df, k).select("feature", "weight")
    rest = df.join(F.broadcast(top.select("feature")), "feature", "left_anti").agg(
        F.lit("Others").alias("feature"), F.coalesce(F.sum("weight"), F.lit(0)).alias("weight")
    )
    return top.unionByName(rest)


def importance_by_group(df: DataFrame, kind: str = "kind") -> DataFrame:
    by_kind = df.groupBy(kind).agg(F.sum("weight").alias("weight"))
    # One row per kind.
    total = F.sum("weight").over(Window.partitionBy())
    return by_kind.select(
        kind, F.col("weight").cast("bigint").alias("weight"),
        rounded(F.col("weight") / total).alias("share"),
    )


# Forecasts ---------------------------------------------------------------------------------


def forecast_metrics(df: DataFrame) -> DataFrame:
    """Error summary of `(error, error_pct)` rows."""
    e = F.col("error")
    return df.agg(
        F.count(F.lit(1)).alias("n"),
        rounded(F.avg(e)).alias("mae"),
        rounded(F.sqrt(F.avg(e * e))).alias("rmse"),
        rounded(F.avg("error_pct")).alias("mape"),
        rounded(F.max(e)).alias("max_error"),
        rounded(F.min(e)).alias("min_error"),
    )


def series_stats(df: DataFrame, columns: Sequence[str] = ("actual", "predicted")) -> DataFrame:
    """Mean, exact median, sample deviation, minimum and maximum per column."""
    medians = exact_medians(df, columns)
    row = df.agg(*[
        stat(F.col(c)).alias(f"{name}_{c}")
        for c in columns
        for name, stat in (
            ("mean", F.avg), ("std", F.stddev_samp), ("low", F.min), ("high", F.max),
        )
    ])
    entries = F.array(*[
        F.struct(
            F.lit(c).alias("column"),
            rounded(F.col(f"mean_{c}")).alias("mean"),
            rounded(F.lit(medians[c])).alias("median"),
            rounded(F.col(f"std_{c}")).alias("std"),
            rounded(F.col(f"low_{c}")).alias("low"),
            rounded(F.col(f"high_{c}")).alias("high"),
        )
        for c in columns
    ])
    return row.select(F.explode(entries).alias("e")).select("e.*")


def recent(df: DataFrame, k: int, order: str, tie: str) -> DataFrame:
    """The last k rows, newest first."""
    return df.orderBy(F.col(order).desc(), F.col(tie).desc()).limit(k)
