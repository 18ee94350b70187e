"""Classification quality from (actual, predicted) labels.

Everything is derived from the confusion counts, so rows are shuffled only as
partial counts of at most classes² groups.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from plyscope.functions.tiers import tier_code, tier_position
from plyscope.schema import TIERS


def confusion_counts(df: DataFrame, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    return df.groupBy(F.col(actual).alias("actual"), F.col(predicted).alias("predicted")).agg(
        F.count(F.lit(1)).alias("n")
    )


def confusion_matrix(counts: DataFrame, classes: list[str]) -> DataFrame:
    """One row per actual class, one column per predicted class, zeros filled."""
    return (
        counts.groupBy("actual")
        .pivot("predicted", classes)
        .agg(F.sum("n"))
        .na.fill(0, subset=classes)
        .orderBy("actual")
    )


def confusion_shares(counts: DataFrame) -> DataFrame:
    """Counts with their share of the actual class."""
    per_actual = Window.partitionBy("actual")
    return counts.withColumn("share", F.col("n") / F.sum("n").over(per_actual))


def accuracy(df: DataFrame, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    return df.agg(F.avg((F.col(actual) == F.col(predicted)).cast("double")).alias("accuracy"))


def adjacent_accuracy(
    df: DataFrame,
    actual: str = "actual",
    predicted: str = "predicted",
    order: str = "ordinal",
    tiers: dict = TIERS,
) -> DataFrame:
    """Share of predictions at most one tier away.

    ``ordinal`` counts tiers from weakest to strongest. ``alphabetical`` counts label
    codes in name order, which calls Advanced and Beginner neighbours; it is kept to
    compare with figures published that way.
    """
    code = {"ordinal": tier_position, "alphabetical": tier_code}[order]
    gap = F.abs(code(F.col(actual), tiers) - code(F.col(predicted), tiers))
    return df.agg(F.avg((gap <= 1).cast("double")).alias("adjacent_accuracy"))


def class_report(counts: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support per class; an undefined ratio is 0."""
    sides = counts.select(
        F.explode(
            F.array(
                F.struct(
                    F.col("actual").alias("label"),
                    F.col("n").alias("support"),
                    F.lit(0).cast("long").alias("guessed"),
                    F.when(F.col("actual") == F.col("predicted"), F.col("n"))
                    .otherwise(F.lit(0))
                    .alias("hits"),
                ),
                F.struct(
                    F.col("predicted").alias("label"),
                    F.lit(0).cast("long").alias("support"),
                    F.col("n").alias("guessed"),
                    F.lit(0).cast("long").alias("hits"),
                ),
            )
        ).alias("_s")
    ).select("_s.*")
    sums = sides.groupBy("label").agg(*[F.sum(c).alias(c) for c in ("support", "guessed", "hits")])

    def ratio(top, bottom):
        return F.when(bottom > 0, top / bottom).otherwise(F.lit(0.0))

    rates = sums.withColumns(
        {
            "precision": ratio(F.col("hits"), F.col("guessed")),
            "recall": ratio(F.col("hits"), F.col("support")),
        }
    )
    p, r = F.col("precision"), F.col("recall")
    return rates.select("label", "precision", "recall", ratio(2 * p * r, p + r).alias("f1"), "support")


def macro_scores(counts: DataFrame) -> DataFrame:
    return class_report(counts).agg(
        F.avg("precision").alias("macro_precision"),
        F.avg("recall").alias("macro_recall"),
        F.avg("f1").alias("macro_f1"),
    )


def full_report(counts: DataFrame) -> DataFrame:
    """The class report with rows for accuracy and the macro and weighted averages."""
    per_class = class_report(counts)
    scores, total = ("precision", "recall", "f1"), F.sum("support")
    macro = per_class.agg(*[F.avg(c).alias(c) for c in scores], total.alias("support"))
    weighted = per_class.agg(
        *[(F.sum(F.col(c) * F.col("support")) / total).alias(c) for c in scores],
        total.alias("support"),
    )
    hit = F.sum(F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(F.lit(0)))
    share = counts.agg((hit / F.sum("n")).alias("a"), F.sum("n").alias("support"))
    overall = share.select(*[F.col("a").alias(c) for c in scores], "support")

    def named(df, name):
        return df.select(F.lit(name).alias("label"), *scores, "support")

    return (
        per_class.unionByName(named(overall, "accuracy"))
        .unionByName(named(macro, "macro avg"))
        .unionByName(named(weighted, "weighted avg"))
    )


def majority_baseline(df: DataFrame, label: str = "actual") -> DataFrame:
    """Accuracy of always answering the largest class."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg((F.max("n") / F.sum("n")).alias("baseline_accuracy"))


def scores_of_counts(counts: DataFrame, tiers: dict = TIERS) -> DataFrame:
    """One row with every headline score, from confusion counts."""
    a, p = F.col("actual"), F.col("predicted")

    def within(code):
        return F.sum(F.when(F.abs(code(a, tiers) - code(p, tiers)) <= 1, F.col("n")).otherwise(0))

    total = F.sum("n")
    overall = counts.agg(
        (F.sum(F.when(a == p, F.col("n")).otherwise(0)) / total).alias("accuracy"),
        (within(tier_position) / total).alias("adjacent_accuracy"),
        (within(tier_code) / total).alias("adjacent_accuracy_alphabetical"),
        total.alias("samples"),
    )
    macro = macro_scores(counts)
    return overall.withColumns(
        {c: macro.select(c).scalar() for c in ("macro_precision", "macro_recall", "macro_f1")}
    )


def score_row(df: DataFrame, actual="actual", predicted="predicted", tiers: dict = TIERS) -> DataFrame:
    """The headline scores of a table of predictions."""
    return scores_of_counts(confusion_counts(df, actual, predicted), tiers)
