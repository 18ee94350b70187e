"""Stratified split, class weights, label codes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from plyscope.operators.ranking import md5_row_number
from plyscope.schema import SEED, TEST_SHARE, VAL_SHARE


def stratified_split(
    df: DataFrame,
    label: str = "skill_tier",
    key: str = "player",
    seed: int = SEED,
    test: float = TEST_SHARE,
    val: float = VAL_SHARE,
) -> DataFrame:
    """Append ``fold`` (train / val / test), equal shares in every class.

    The held-out rows are counted over the whole table and dealt to the classes by largest
    remainder, then the test rows among them likewise. Inside a class the md5 order of the key
    decides, so the same key lands in the same fold on any engine and any partitioning.
    """
    ranked = md5_row_number(df, [label], [seed, F.col(key)], "_rank", "_class_size", [F.col(key)])
    sizes = df.where(F.col(label).isNotNull()).groupBy(F.col(label).alias("class")).agg(F.count(F.lit(1)).alias("n"))
    everyone = F.sum("n").over(Window.partitionBy(F.lit(0)))
    held = dealt(sizes.withColumn("part", F.ceil(everyone * F.lit(test + val) - 1e-9)), "n", "part", "held")
    tested = F.ceil(F.col("part") * F.lit(test / (test + val)) - 1e-9)
    folds = dealt(held.withColumn("val_part", F.col("part") - tested), "held", "val_part", "val")
    # one entry per class
    entries = folds.agg(F.map_from_entries(F.collect_list(F.struct("class", F.struct("held", "val")))).alias("m"))
    sized = ranked.withColumn("_cut", F.try_element_at(entries.scalar(), F.col(label)))
    train = F.col("_class_size") - F.col("_cut.held")
    fold = (
        F.when(F.col("_rank") <= train, "train")
        .when(F.col("_rank") <= train + F.col("_cut.val"), "val")
        .otherwise("test")
    )
    return sized.withColumn("fold", fold).drop("_rank", "_class_size", "_cut")


def dealt(classes: DataFrame, size: str, total: str, name: str) -> DataFrame:
    """Append ``name``: each class's whole-number part of ``total``, by largest remainder.

    ``classes`` has one row per class, so it fits into one window.
    """
    one = Window.partitionBy(F.lit(0))
    quota = F.coalesce(F.col(size) * F.col(total) / F.nullif(F.sum(size).over(one), F.lit(0)), F.lit(0.0))
    given = classes.withColumns({"_quota": quota, "_whole": F.floor(quota)})
    turn = F.row_number().over(one.orderBy(F.desc(F.col("_quota") - F.col("_whole")), "class"))
    left = F.col(total) - F.sum("_whole").over(one)
    return given.withColumn(name, F.col("_whole") + (turn <= left).cast("long")).drop("_quota", "_whole")


def class_distribution(df: DataFrame, label: str = "skill_tier") -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("count"))


def class_weights(df: DataFrame, label: str = "skill_tier") -> DataFrame:
    """n / (k · n_c) per class."""
    counts = class_distribution(df, label)
    total = counts.select(F.sum("count")).scalar()
    classes = counts.select(F.count(F.lit(1))).scalar()
    return counts.withColumn("weight", total / (classes * F.col("count")))


def with_class_weight(df: DataFrame, label: str = "skill_tier", name: str = "weight") -> DataFrame:
    """Append the weight of each row's class.

    The weights, one per class, reach the rows as a single map value: joining on so few
    keys would move every row of a large class to one place.
    """
    entries = class_weights(df, label).agg(
        F.map_from_entries(F.collect_list(F.struct(label, "weight"))).alias("weights")
    )
    return df.withColumn(name, F.try_element_at(entries.scalar(), F.col(label)))


def label_codes(df: DataFrame, label: str = "skill_tier") -> DataFrame:
    """Distinct labels with their alphabetical code; one row per class."""
    labels = df.select(F.array_sort(F.collect_set(label)).alias("labels"))
    return labels.select(F.posexplode("labels").alias("code", label))


def with_label_code(df: DataFrame, labels: list[str], label: str = "skill_tier", name: str = "code") -> DataFrame:
    """Alphabetical code for a known label list."""
    ordered = F.array(*[F.lit(x) for x in sorted(labels)])
    return df.withColumn(name, (F.array_position(ordered, F.col(label)) - 1).cast("int"))
