"""Evaluation of binary scores and of price estimates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from homematch.functions.numbers import confidence, ratio
from homematch.operators.joins import with_row
from homematch.operators.ranking import running_sum, split_buckets


def _or_zero(top: Column, bottom: Column) -> Column:
    return F.coalesce(ratio(top.cast("double"), bottom.cast("double")), F.lit(0.0))


def confusion_counts(df: DataFrame, label: str = "y", predicted: str = "predicted") -> DataFrame:
    """True and false positives and negatives, one row."""
    y, p = F.col(label) == 1, F.col(predicted) == 1
    return df.agg(
        F.count_if(y & p).alias("tp"), F.count_if(~y & p).alias("fp"),
        F.count_if(y & ~p).alias("fn"), F.count_if(~y & ~p).alias("tn"),
    )


def scores(df: DataFrame, label: str = "y", predicted: str = "predicted") -> DataFrame:
    """Accuracy, precision, recall and F1; a division by zero gives 0."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return confusion_counts(df, label, predicted).select(
        _or_zero(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        _or_zero(tp, tp + fp).alias("precision"),
        _or_zero(tp, tp + fn).alias("recall"),
        _or_zero(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )


def confusion_matrix(df: DataFrame, label: str = "y", predicted: str = "predicted") -> DataFrame:
    """Rows per actual class, one column per predicted class."""
    wide = df.groupBy(F.col(label).alias("actual")).pivot(predicted, [0, 1]).agg(F.count(F.lit(1)))
    return wide.select("actual", F.coalesce("0", F.lit(0)).alias("predicted_0"), F.coalesce("1", F.lit(0)).alias("predicted_1"))


def classification_report(df: DataFrame, label: str = "y", predicted: str = "predicted") -> DataFrame:
    """Precision, recall, F1 and support per class, with macro and weighted averages."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))

    def line(name: str, hit: Column, false: Column, missed: Column) -> Column:
        return F.struct(
            F.lit(name).alias("class"),
            _or_zero(hit, hit + false).alias("precision"),
            _or_zero(hit, hit + missed).alias("recall"),
            _or_zero(2 * hit, 2 * hit + false + missed).alias("f1"),
            (hit + missed).alias("support"),
        )

    per_class = confusion_counts(df, label, predicted).select(F.inline(F.array(line("0", tn, fn, fp), line("1", tp, fp, fn))))
    names = ["precision", "recall", "f1"]
    macro = per_class.agg(F.lit("macro avg").alias("class"), *[F.avg(c).alias(c) for c in names], F.sum("support").alias("support"))
    weighted = per_class.agg(
        F.lit("weighted avg").alias("class"),
        *[_or_zero(F.sum(F.col(c) * F.col("support")), F.sum("support")).alias(c) for c in names],
        F.sum("support").alias("support"),
    )
    return per_class.unionByName(macro).unionByName(weighted)


def roc_auc(df: DataFrame, label: str = "y", probability: str = "probability") -> DataFrame:
    """Exact area under the ROC curve; ties count one half.

    Equal scores collapse into counts, then a bucketed running sum gives the
    negatives below each score. Buckets are split where the scores lie, so that
    crowds of scores near 0 or 1 are spread as well.
    """
    counts = df.groupBy(F.col(probability).cast("double").alias("p")).agg(
        F.count_if(F.col(label) == 1).alias("positives"), F.count_if(F.col(label) == 0).alias("negatives"),
    )
    ranked = running_sum(split_buckets(counts, [], "p"), [], "bucket", ["p"], "negatives", "below_or_equal")
    wins = F.sum(F.col("positives") * (F.col("below_or_equal") - F.col("negatives") / 2))
    return ranked.agg(ratio(wins, (F.sum("positives") * F.sum("negatives")).cast("double")).alias("auc"))


def misclassification_totals(df: DataFrame, label: str = "y", predicted: str = "predicted") -> DataFrame:
    """Rows, mistakes and their share."""
    wrong = F.count_if(F.col(label) != F.col(predicted))
    total = F.count(F.lit(1))
    return df.agg(total.alias("total"), wrong.alias("misclassified"), _or_zero(wrong, total).alias("rate"))


def confident_mistakes(df: DataFrame, key: str, label: str = "y", predicted: str = "predicted", probability: str = "probability", n: int = 3) -> DataFrame:
    """The ``n`` most confident mistakes, numbered from the least confident of them."""
    wrong = df.where(F.col(label) != F.col(predicted)).withColumn("confidence", confidence(F.col(probability)))
    top = wrong.orderBy(F.desc("confidence"), key).limit(n)
    return top.withColumn("sample", F.row_number().over(Window.orderBy("confidence", F.desc(key))))


def strongest_features(features: Sequence[str], n: int = 5) -> Column:
    """Per row, the ``n`` features with the largest absolute value."""
    entries = F.array(*[
        F.struct((-F.abs(F.col(c).cast("double"))).alias("order"), F.lit(i).alias("place"), F.lit(c).alias("feature"), F.col(c).cast("double").alias("value"))
        for i, c in enumerate(features)
    ])
    return F.transform(F.slice(F.array_sort(entries), 1, n), lambda e: F.struct(e["feature"].alias("feature"), e["value"].alias("value")))


def misclassification_report(df: DataFrame, key: str, features: Sequence[str], label: str = "y", predicted: str = "predicted", probability: str = "probability") -> DataFrame:
    """Totals, and the most confident mistakes with their strongest features."""
    chosen = confident_mistakes(df, key, label, predicted, probability)
    named = chosen.select(
        "sample", F.col(key).cast("string").alias("key"),
        F.when(F.col(label) == 1, "Suitable").otherwise("Not Suitable").alias("true_label"),
        F.col(probability).alias("probability"),
        F.posexplode(strongest_features(features)).alias("place", "_feature"),
    ).select("sample", "key", "true_label", "probability", (F.col("place") + 1).alias("place"), F.col("_feature.feature").alias("feature"), F.col("_feature.value").alias("value"))
    return with_row(named, misclassification_totals(df, label, predicted), "_totals").select(*named.columns, "_totals.*")


def top_importances(importances: DataFrame, n: int = 15) -> DataFrame:
    """Most important features first."""
    return importances.orderBy(F.desc("importance"), "feature").limit(n)


def regression_errors(df: DataFrame, actual: str, estimate: str) -> DataFrame:
    """Mean absolute error and root mean squared error."""
    gap = F.col(actual) - F.col(estimate)
    return df.agg(F.avg(F.abs(gap)).alias("mae"), F.sqrt(F.avg(gap * gap)).alias("rmse"))
