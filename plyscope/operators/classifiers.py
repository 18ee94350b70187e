"""Tier classifiers: forest (Spark ML), softmax boosted trees, and their soft vote; grid search over tree prefixes."""

from __future__ import annotations

import itertools
import json
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from plyscope.functions.numbers import hash_fraction
from plyscope.operators import trees
from plyscope.operators.metrics import confusion_matrix, full_report, scores_of_counts
from plyscope.operators.oversample import oversample
from plyscope.operators.scaling import fit_scaler
from plyscope.operators.split import stratified_split, with_class_weight, with_label_code
from plyscope.schema import SEED
from plyscope.session import cut_lineage, drop_shuffles

FOREST, BOOSTED, ENSEMBLE = "random_forest", "boosted_trees", "ensemble_soft"
KINDS = (FOREST, BOOSTED, ENSEMBLE)

# Hyper-parameters of the two base models.
FOREST_PARAMS = {"numTrees": 200, "maxDepth": 18, "minInstancesPerNode": 2}
BOOSTED_PARAMS = {
    "maxIter": 250,
    "maxDepth": 8,
    "stepSize": 0.08,
    "subsamplingRate": 0.9,
    "featureSubsetStrategy": "0.9",
}
#: Rows up to which a forest is Spark ML's.
ML_ROWS = 1 << 12
# Tuning grids.
FOREST_GRID = {"numTrees": [100, 200, 300], "maxDepth": [10, 15, 20], "minInstancesPerNode": [1, 2, 5]}
BOOSTED_GRID = {"maxIter": [100, 200, 300], "maxDepth": [5, 8, 12], "stepSize": [0.05, 0.1, 0.2]}


def mean_of_arrays(arrays: list[Column]) -> Column:
    total = arrays[0]
    for other in arrays[1:]:
        total = F.zip_with(total, other, lambda x, y: x + y)
    return F.transform(total, lambda x: x / len(arrays))


def arg_max_label(probability: Column, labels: list[str]) -> Column:
    """Label of the largest probability, the first one on a tie."""
    position = F.array_position(probability, F.array_max(probability)).cast("int")
    return F.element_at(F.array(*[F.lit(x) for x in labels]), position)


def soft_vote(df: DataFrame, probabilities: list[str], labels: list[str]) -> DataFrame:
    """Mean of the members' class probabilities and its arg max, row by row."""
    return df.withColumn(
        "probability", mean_of_arrays([F.col(c) for c in probabilities])
    ).withColumn("predicted", arg_max_label(F.col("probability"), labels))


@dataclass
class TierModel:
    """Fitted members: a Spark ML forest as one pipeline, and an ensemble of histogram trees behind its scaler.

    The forest of a larger table is one of histogram trees in the shared folder, behind the same scaler.
    """

    kind: str
    labels: list[str]
    columns: list[str]
    forest: PipelineModel | trees.TaskForest | None = None
    boosted: trees.Ensemble | None = None
    scaler: PipelineModel | None = None

    def predict(self, df: DataFrame) -> DataFrame:
        """Append ``probability`` (in label order) and ``predicted``; a narrow pass."""
        keep, members = df.columns, []
        if self.forest:
            if isinstance(self.forest, trees.TaskForest):
                df = self.forest.transform(self.scaler.transform(df), self._scaled(), "_p_forest")
            else:
                df = self.forest.transform(df).withColumn("_p_forest", vector_to_array("_forest_probability"))
            members.append("_p_forest")
            df = df.select(*keep, *members)
        if self.boosted:
            df = self.scaler.transform(df) if self.scaler else df
            df = df.withColumn("_p_boosted", self.boosted.probability(self._scaled()))
            members.append("_p_boosted")
            df = df.select(*keep, *members)
        return soft_vote(df, members, self.labels).select(*keep, "probability", "predicted")

    def _scaled(self) -> Column:
        names = [f"z_{c}" if self.scaler else c for c in self.columns]
        return F.array(*[F.col(c).cast("double") for c in names])

    def restricted(self, kind: str) -> TierModel:
        """The same fitted members, as a model of one kind."""
        return TierModel(
            kind,
            self.labels,
            self.columns,
            self.forest if kind != BOOSTED else None,
            self.boosted if kind != FOREST else None,
            self.scaler if kind != FOREST or isinstance(self.forest, trees.TaskForest) else None,
        )

    def importances(self, spark: SparkSession) -> DataFrame:
        """Feature importance, averaged over members, largest first."""
        members = []
        if self.forest:
            held = isinstance(self.forest, trees.TaskForest)
            members.append(list(self.forest.importances() if held else self.forest.stages[-1].featureImportances.toArray()))
        if self.boosted:
            members.append(list(self.boosted.importances()))
        mean = [float(sum(v) / len(members)) for v in zip(*members)]
        rows = list(zip(self.columns, mean))
        return spark.createDataFrame(rows, "feature string, importance double").orderBy(
            F.desc("importance"), "feature"
        )

    def save(self, path: str) -> None:
        spark = SparkSession.getActiveSession()
        for name, part in (("forest", self.forest), ("scaler", self.scaler)):
            if isinstance(part, trees.TaskForest):
                part.save(f"{path}/{name}")
            elif part:
                part.write().overwrite().save(f"{path}/{name}")
        if self.boosted:
            self.boosted.save(spark, f"{path}/boosted")
        held = [name for name in ("forest", "boosted", "scaler") if getattr(self, name)]
        meta = {"kind": self.kind, "labels": self.labels, "columns": self.columns, "parts": held}
        meta["in_tasks"] = isinstance(self.forest, trees.TaskForest)
        spark.createDataFrame([(json.dumps(meta),)], "value string").coalesce(1).write.mode(
            "overwrite"
        ).text(f"{path}/meta")


def load_model(spark: SparkSession, path: str) -> TierModel:
    meta = json.loads(spark.read.text(f"{path}/meta").first()["value"])
    load = {"boosted": lambda p: trees.Ensemble.load(spark, p)}
    if meta.get("in_tasks"):
        load["forest"] = lambda p: trees.TaskForest.load(spark, p)
    parts = {name: load.get(name, PipelineModel.load)(f"{path}/{name}") for name in meta["parts"]}
    return TierModel(meta["kind"], meta["labels"], meta["columns"], **parts)


def boosting_options(params: dict) -> dict:
    """Parameters of the boosted trees as the tree engine names them."""
    return {
        "rounds": params["maxIter"],
        "depth": params["maxDepth"],
        "step": params["stepSize"],
        "rows_share": params.get("subsamplingRate", 1.0),
        "features_share": float(params.get("featureSubsetStrategy", 1.0)),
    }


def fit_model(
    train: DataFrame,
    columns: list[str],
    labels: list[str],
    kind: str = FOREST,
    label: str = "label",
    key: str = "player",
    balance: str | None = "oversample",
    forest_params: dict | None = None,
    boosted_params: dict | None = None,
    seed: int = SEED,
) -> TierModel:
    """Scale, balance and fit.

    ``balance="oversample"`` adds synthetic rows (quadratic in the class size);
    ``"weights"`` only weights the classes, which is linear and suits very large tables.

    The Spark ML forest sends a histogram for each node and partition and keeps its nodes at the driver, so it is grown
    for at most ``ML_ROWS`` rows (or where ``forest_params`` has more than the size of forest, trees and leaves); beyond,
    the same forest is one of histogram trees that stay in tasks and the shared folder, with other random draws.
    """
    if kind not in KINDS:
        raise ValueError(f"unknown model kind: {kind}")
    scaler = fit_scaler(train, columns)
    scaled = [f"z_{c}" for c in columns]
    rows = scaler.transform(train, "z_").select(F.col(key).cast("string").alias(key), label, *scaled)
    if balance == "oversample":
        rows = cut_lineage(oversample(rows, scaled, label, key, seed=seed))
    rows = with_label_code(with_class_weight(rows, label), labels, label, "_code")
    assembler = VectorAssembler(inputCols=scaled, outputCol="_features")
    rows = cut_lineage(rows.select(key, "_code", "weight", *scaled))
    drop_shuffles(train.sparkSession)  # of the oversampling
    scaling = SQLTransformer(statement=scaler.sql("z_"))

    def with_outputs(estimator, prefix):
        return (
            estimator.setFeaturesCol("_features")
            .setRawPredictionCol(f"{prefix}_raw")
            .setProbabilityCol(f"{prefix}_probability")
            .setPredictionCol(f"{prefix}_prediction")
        )

    model = TierModel(kind, list(labels), list(columns))

    sizes = {**FOREST_PARAMS, **(forest_params or {})}
    in_tasks = kind != BOOSTED and set(sizes) == set(FOREST_PARAMS) and rows.count() > ML_ROWS
    if in_tasks or kind != FOREST:
        edges = trees.bin_edges(rows, scaled)
        data = trees.blocks(rows, scaled, "_code", "weight", key, edges, len(labels))
        model.scaler = PipelineModel([scaling])

    def fit_forest() -> None:
        if in_tasks:
            model.forest = trees.TaskForest.fit(data, edges, len(labels), *[sizes[n] for n in FOREST_PARAMS], seed=seed)
            return
        prepared = assembler.transform(rows).select(F.col("_code").cast("double").alias("_code"), "weight", "_features")
        forest = RandomForestClassifier(
            labelCol="_code", weightCol="weight", seed=seed, cacheNodeIds=True, **sizes
        )
        forest = with_outputs(forest, "_forest")
        model.forest = PipelineModel([scaling, assembler, forest.fit(prepared)])

    def fit_boosted() -> None:
        options = boosting_options({**BOOSTED_PARAMS, **(boosted_params or {})})
        model.boosted = trees.fit_boosted(data, edges, len(labels), seed=seed, **options)

    members = {FOREST: [fit_forest], BOOSTED: [fit_boosted], ENSEMBLE: [fit_forest, fit_boosted]}[kind]
    side_by_side(train.sparkSession, members)
    return model


def side_by_side(spark: SparkSession, jobs: list, at_once: int = 4) -> list:
    """Results of jobs that do not depend on each other, run beside each other."""
    with ThreadPoolExecutor(at_once) as pool:
        return [f.result() for f in [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]]


@dataclass
class TrainingResult:
    model: TierModel
    scores: DataFrame
    confusion: DataFrame
    report: DataFrame
    classes: DataFrame
    sizes: DataFrame


def evaluate(model: TierModel, split: DataFrame, label: str = "skill_tier") -> TrainingResult:
    """Scores of a fitted model on the val and test folds.

    One scoring pass; what is kept of it has at most 2 x classes² rows.
    """
    scored = model.predict(split.where("fold <> 'train'"))
    tallies = cut_lineage(
        scored.groupBy("fold", F.col(label).alias("actual"), "predicted").agg(F.count(F.lit(1)).alias("n"))
    )
    counts = tallies.where("fold = 'test'").drop("fold")
    val = scores_of_counts(tallies.where("fold = 'val'").drop("fold"))
    scores = scores_of_counts(counts).select(
        F.lit(model.kind).alias("model_type"),
        val.select("accuracy").scalar().alias("val_accuracy"),
        F.col("accuracy").alias("test_accuracy"),
        "adjacent_accuracy",
        "adjacent_accuracy_alphabetical",
        "macro_precision",
        "macro_recall",
        "macro_f1",
    )
    folds = cut_lineage(split.groupBy("fold", label).agg(F.count(F.lit(1)).alias("rows")))
    return TrainingResult(
        model,
        scores,
        confusion_matrix(counts, model.labels),
        full_report(counts),
        folds.groupBy(label).agg(F.sum("rows").alias("count")),
        folds.groupBy("fold").agg(F.sum("rows").alias("rows")),
    )


def train_and_compare(
    table: DataFrame,
    columns: list[str],
    kinds=KINDS,
    label: str = "skill_tier",
    key: str = "player",
    **fit_options,
) -> dict[str, TrainingResult]:
    """Split once, fit each base model once, and score every kind asked for.

    The ensemble shares the fitted members of the single models.
    """
    unknown = [k for k in kinds if k not in KINDS]
    if unknown:
        raise ValueError(f"unknown model kind: {unknown}")
    split = cut_lineage(stratified_split(table.select(key, label, *columns), label, key))
    labels = sorted(r[0] for r in split.select(label).distinct().collect())  # one row per class
    fitted = kinds[0] if len(set(kinds)) == 1 else ENSEMBLE
    model = fit_model(split.where("fold = 'train'"), columns, labels, fitted, label, key, **fit_options)
    results = {k: evaluate(model.restricted(k), split, label) for k in kinds}
    return results


def train_classifier(table: DataFrame, columns: list[str], kind: str = FOREST, **options) -> TrainingResult:
    """Split, fit and score one kind of model."""
    return train_and_compare(table, columns, (kind,), **options)[kind]


def compare_models(table: DataFrame, columns: list[str], kinds=KINDS, **options) -> tuple[DataFrame, dict]:
    """Scores of every kind in one table, in the order given, and the results by kind."""
    results = train_and_compare(table, columns, tuple(kinds), **options)
    rows = None
    for i, result in enumerate(results.values()):
        one = result.scores.withColumns({"position": F.lit(i), "features": F.lit(len(columns))})
        rows = one if rows is None else rows.unionByName(one)
    return rows, results


def best_model(comparison: DataFrame) -> DataFrame:
    """Highest test accuracy; the first of equals."""
    return comparison.orderBy(F.desc("test_accuracy"), "position").limit(1)


def tune(
    table: DataFrame,
    columns: list[str],
    kind: str = FOREST,
    label: str = "skill_tier",
    grid: dict | None = None,
    folds: int = 5,
    parallelism: int = 4,
    seed: int = SEED,
    key: str = "player",
) -> tuple[TierModel, DataFrame]:
    """Grid search by cross-validated accuracy; returns the best model, fitted on all rows, and the scores.

    Trees do not depend on how many follow, nor on how deep they may become, so one forest for each fold and leaf
    size serves all its numbers of trees and depths, and one boosting for each fold, depth and step all its numbers of
    rounds. The bins of a fold come from its training rows. Bins follow the order of the values, so scaling, which
    trees do not see, is left out.
    """
    grids = {FOREST: FOREST_GRID, BOOSTED: BOOSTED_GRID}
    if kind not in grids:
        raise ValueError(f"unknown model kind: {kind}")
    grid = {**{n: [v] for n, v in {**FOREST_PARAMS, **BOOSTED_PARAMS}.items() if n in grids[kind]}, **(grid or grids[kind])}
    fold = F.floor(hash_fraction(seed, "fold", F.col(key)) * folds).cast("int")
    labels = sorted(r[0] for r in table.select(label).distinct().collect() if r[0] is not None)  # one row per class
    rows = with_label_code(table.select(key, label, *columns), labels, label, "_code")
    rows = cut_lineage(rows.withColumn("_fold", fold))
    sizes = grid["numTrees" if kind == FOREST else "maxIter"]
    depths = grid["maxDepth"] if kind == FOREST else [None]
    rest = grid["minInstancesPerNode"] if kind == FOREST else list(itertools.product(grid["maxDepth"], grid["stepSize"]))

    def binned(train: DataFrame) -> tuple[DataFrame, list]:
        edges = trees.bin_edges(train, columns)
        return trees.blocks(train, columns, "_code", None, key, edges, len(labels)), edges

    def boosted(data: DataFrame, edges: list, size: int, other) -> trees.Ensemble:
        return trees.fit_boosted(data, edges, len(labels), size, other[0], other[1], seed=seed)

    def fold_of(i: int) -> tuple[DataFrame, DataFrame, list]:
        data, edges = binned(rows.where(F.col("_fold") != i))
        return data, trees.blocks(rows.where(F.col("_fold") == i), columns, "_code", None, key, edges, len(labels)), edges

    def forests(i: int) -> list[tuple]:
        data, held, edges = fold_of(i)
        found = trees.forest_hits(data, held, edges, len(labels), rest, sizes, depths, seed)
        return [(*k, right / n) for k, (right, n) in found.items()]

    def boostings(job) -> list[tuple]:
        i, other = job
        data, held, edges = fold_of(i)
        found = trees.hits(held, boosted(data, edges, max(sizes), other), sizes, depths)
        return [(size, depth, other, right / n) for (size, depth), (right, n) in found.items()]

    # the forests of a fold share its blocks
    scores, jobs = (forests, range(folds)) if kind == FOREST else (boostings, itertools.product(range(folds), rest))
    with ThreadPoolExecutor(parallelism) as pool:
        one = inheritable_thread_target(table.sparkSession)(scores)
        done = [x for part in pool.map(one, jobs) for x in part]
    means: dict[tuple, list[float]] = {}
    for size, depth, other, accuracy in done:
        means.setdefault((size, depth, other), []).append(accuracy)

    def named(size, depth, other) -> str:
        if kind == FOREST:
            return json.dumps({"numTrees": size, "maxDepth": depth, "minInstancesPerNode": other}, sort_keys=True)
        return json.dumps({"maxIter": size, "maxDepth": other[0], "stepSize": other[1]}, sort_keys=True)

    results = sorted((-sum(v) / len(v), named(*k), k) for k, v in means.items())
    data, edges = binned(rows)
    size, depth, other = results[0][2]
    best = trees.stored_forest(data, edges, len(labels), size, depth, other, seed) if kind == FOREST else boosted(data, edges, size, other)
    table_of = [(name, -a) for a, name, _ in results]
    scored = table.sparkSession.createDataFrame(table_of, "params string, accuracy double")
    return TierModel(kind, labels, list(columns), boosted=best), scored.orderBy(F.desc("accuracy"), "params")
