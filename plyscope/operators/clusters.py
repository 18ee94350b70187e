"""Player clustering: two principal components, then one of five methods."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce
from operator import and_

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.clustering import GaussianMixture
from pyspark.ml.feature import PCA, SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from plyscope.operators.density import NOISE, density_clusters
from plyscope.operators.density_any import density_clusters_any
from plyscope.operators.indices import all_indices, inertia, silhouette, silhouette_squared
from plyscope.operators import microclusters
from plyscope.operators.multistart import Run, best_runs
from plyscope.operators.scaling import fit_scaler, without_outliers
from plyscope.schema import K_RANGE, SEED
from plyscope.session import cut_lineage

INDEX_NAMES = ("silhouette_score", "calinski_harabasz_index", "davies_bouldin_index")
# The names of the methods.
METHODS = ("kmeans", "hierarchical", "dbscan", "gmm", "birch")
RESTARTS = 10


@dataclass
class Reduction:
    """Scaler and principal components; the sign of a component is fixed by its largest loading."""

    columns: list[str]
    pipeline: PipelineModel
    signs: list[int]
    explained: list[float]
    loadings: list[list[float]] = field(default_factory=list)

    def transform(self, df: DataFrame, names=("x", "y")) -> DataFrame:
        keep = df.columns
        scores = vector_to_array("_scores")
        out = self.pipeline.transform(df).withColumn("_s", scores)
        return out.select(*keep, *[(F.col("_s")[i] * s).alias(n) for i, (n, s) in enumerate(zip(names, self.signs))])


def fit_reduction(df: DataFrame, columns: list[str], k: int = 2) -> Reduction:
    scaler = fit_scaler(df, columns)
    assembler = VectorAssembler(inputCols=[f"z_{c}" for c in columns], outputCol="_features")
    stages = [SQLTransformer(statement=scaler.sql("z_")), assembler]
    prepared = PipelineModel(stages).transform(df).select("_features")
    pca = PCA(k=k, inputCol="_features", outputCol="_scores").fit(prepared)
    matrix = pca.pc.toArray()
    signs = [1 if col[abs(col).argmax()] >= 0 else -1 for col in matrix.T]
    explained = [float(v) for v in pca.explainedVariance.toArray()]
    loadings = [[float(v) * s for v in col] for col, s in zip(matrix.T, signs)]
    return Reduction(list(columns), PipelineModel([*stages, pca]), signs, explained, loadings)


def nearest_center(coords: list[str], centers: list[list[float]]) -> Column:
    """Index of the nearest given centre, the first one on a tie."""
    options = []
    for i, center in enumerate(centers):
        squares = [(F.col(c) - F.lit(float(v))) * (F.col(c) - F.lit(float(v))) for c, v in zip(coords, center)]
        options.append(F.struct(sum(squares[1:], squares[0]).alias("d"), F.lit(i).alias("i")))
    return F.array_min(F.array(*options))["i"]


def micro_clusters(points: DataFrame, coords: list[str], width: float) -> DataFrame:
    """Clustering features per grid cell: count, linear sums, squared sum and the mean."""
    cells = [F.floor(F.col(c) / F.lit(width)).alias(f"cell_{c}") for c in coords]
    squares = [F.col(c) * F.col(c) for c in coords]
    return points.groupBy(*cells).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(c).alias(f"sum_{c}") for c in coords],
        F.sum(sum(squares[1:], squares[0])).alias("sum_squares"),
    ).withColumns({c: F.col(f"sum_{c}") / F.col("n") for c in coords})


@dataclass
class Clustering:
    """Labelled points and the fitted model, if the method has one."""

    method: str
    labelled: DataFrame
    model: object | None
    centers: list[list[float]] | None

    def n_clusters(self) -> DataFrame:
        return self.labelled.where(F.col("cluster") != NOISE).agg(
            F.countDistinct("cluster").alias("n_clusters")
        )


def center_model(coords: list[str], centers: list[list[float]]) -> PipelineModel:
    """A model that appends the nearest centre as ``cluster``, NULL for an unknown coordinate; it is saved like any other."""
    options = []
    for i, center in enumerate(centers):
        squares = " + ".join(f"(`{c}` - CAST({v!r} AS DOUBLE)) * (`{c}` - CAST({v!r} AS DOUBLE))" for c, v in zip(coords, center, strict=True))
        options.append(f"struct({squares} AS d, {i} AS i)")
    known = " AND ".join(f"`{c}` IS NOT NULL" for c in coords)
    text = f"CASE WHEN {known} THEN array_min(array({', '.join(options)})).i END" if options else "CAST(NULL AS INT)"
    return PipelineModel([SQLTransformer(statement=f"SELECT *, {text} AS cluster FROM __THIS__")])


def _by_centers(method: str, points: DataFrame, coords: list[str], run: Run) -> Clustering:
    centers = [[float(v) for v in c] for c in run.centers]
    model = center_model(coords, centers)
    return Clustering(method, model.transform(points.drop("cluster")), model, centers)


def cluster(
    points: DataFrame,
    method: str = "kmeans",
    k: int = 3,
    coords: list[str] | None = None,
    key: str = "player",
    seed: int = SEED,
    restarts: int = RESTARTS,
    eps: float = 0.5,
    min_points: int = 5,
    cell_width: float = 0.5,
    most_cells: int = microclusters.MOST_CELLS,
) -> Clustering:
    """Append ``cluster``.

    ``hierarchical`` merges bottom-up by Ward's rule and ``birch`` runs weighted k-means, both over clustering features
    in adaptive cells: as many as the data need for the radius ``cell_width`` (hierarchical: for single points), but at
    most ``most_cells``. Fewer distinct points than that are clustered exactly by the hierarchy.
    """
    coords = coords or ["x", "y"]
    if method == "dbscan":
        if len(coords) == 2:
            found = density_clusters(points, eps, min_points, key, *coords)
        else:
            found = density_clusters_any(points, coords, eps, min_points, key)
        found = found.drop("core")
        return Clustering(method, found, None, None)
    if method == "kmeans":
        return _by_centers(method, points, coords, best_runs(points, coords, [k], seed, restarts)[k])
    if method == "birch":
        cells = microclusters.adaptive_cells(points, coords, most_cells, cell_width)
        features = microclusters.features(cells, points.sparkSession, coords)
        return _by_centers(method, points, coords, best_runs(features, coords, [k], seed, restarts, "n")[k])
    if method == "hierarchical":
        return Clustering(method, hierarchical(points, coords, k, most_cells), None, None)
    if method != "gmm":
        raise ValueError(f"unknown clustering method: {method}")
    assembler = VectorAssembler(inputCols=coords, outputCol="_v")
    vectors = assembler.transform(points)
    model = GaussianMixture(k=k, seed=seed, featuresCol="_v", predictionCol="cluster", probabilityCol="_prob").fit(vectors)
    centers = [list(map(float, g.mean.toArray())) for g in model.gaussians]
    labelled = model.transform(vectors).select(*points.columns, F.col("cluster").cast("int").alias("cluster"))
    return Clustering(method, labelled, PipelineModel([assembler, model]), centers)


def hierarchical(points: DataFrame, coords: list[str], k: int, most_cells: int = microclusters.MOST_CELLS) -> DataFrame:
    """Append ``cluster``: Ward's hierarchy, cut at k clusters, over at most ``most_cells`` clustering features."""
    cells = microclusters.adaptive_cells(points, coords, most_cells)
    leaves = cells.leaves()
    held = [at for at, i in enumerate(leaves) if cells.n[i] > 0]
    if not held:
        return points.withColumn("cluster", F.lit(None).cast("int"))
    means = np.array([cells.sums[leaves[at]] / cells.n[leaves[at]] for at in held])
    labels = microclusters.cut_tree(len(held), microclusters.ward(means, np.array([cells.n[leaves[at]] for at in held])), k)
    by_leaf = [-1] * len(leaves)
    for at, label in zip(held, labels, strict=True):
        by_leaf[at] = label
    return points.drop("cluster").withColumn("cluster", cells.column(coords, by_leaf))


def sweep_k(
    points: DataFrame, coords: list[str], k_range=K_RANGE, seed: int = SEED, restarts: int = RESTARTS, squared: bool = True
) -> DataFrame:
    """Inertia and indices for each k, both ends of the range included; all runs of all k share their passes."""
    rows = None
    runs = best_runs(points, coords, range(k_range[0], k_range[1] + 1), seed, restarts)
    for k, run in runs.items():
        result = _by_centers("kmeans", points, coords, run)
        labelled = cut_lineage(result.labelled.select(*coords, "cluster"))
        one = all_indices(labelled, coords, squared=squared).select(
            F.lit(k).alias("k"), inertia(labelled, coords).scalar().alias("inertia"), "*"
        )
        rows = one if rows is None else rows.unionByName(one)
    return rows


def best_k(sweep: DataFrame) -> DataFrame:
    """Largest silhouette, the smallest k of equals."""
    return sweep.orderBy(F.desc("silhouette_score"), "k").limit(1)


def compare_methods(
    points: DataFrame,
    k: int = 3,
    methods=METHODS,
    coords: list[str] | None = None,
    explained: float | None = None,
    squared: bool = True,
    **options,
) -> DataFrame:
    """One row of indices per method.

    A method that the data or the options do not suit has NULL indices and says why in
    ``error``; any other failure, such as a lost executor, ends the comparison.
    """
    coords = coords or ["x", "y"]
    rows = None
    for position, method in enumerate(methods):
        named = [F.lit(position).alias("position"), F.lit(method).alias("method")]
        variance = F.lit(explained).cast("double").alias("pca_explained_variance")
        try:
            result = cluster(points, method, k, coords, **options)
        except (ValueError, IllegalArgumentException) as error:
            empty = [F.lit(None).cast("double").alias(c) for c in INDEX_NAMES]
            no_count = F.lit(None).cast("long").alias("n_clusters")
            one = points.sparkSession.range(1).select(*named, no_count, *empty, variance, F.lit(str(error)).alias("error"))
        else:
            result.labelled = cut_lineage(result.labelled.select(*coords, "cluster"))
            one = all_indices(result.labelled, coords, squared=squared).select(
                *named,
                result.n_clusters().scalar().alias("n_clusters"),
                *INDEX_NAMES,
                variance,
                F.lit(None).cast("string").alias("error"),
            )
        rows = one if rows is None else rows.unionByName(one)
    return rows


def best_method(comparison: DataFrame) -> DataFrame:
    """Largest silhouette, then smallest Davies–Bouldin."""
    return comparison.orderBy(F.desc("silhouette_score"), "davies_bouldin_index", "method").limit(1)


def silhouette_grid(
    df: DataFrame,
    columns: list[str],
    ks=(2, 3, 5),
    methods=("kmeans", "birch"),
    squared: bool = True,
    **options,
) -> DataFrame:
    """Silhouette per k and method, on the scaled features and on their two components."""
    scaled = [f"z_{c}" for c in columns]
    spaces = {
        "scaled": (fit_scaler(df, columns).transform(df, "z_"), scaled),
        "pca": (fit_reduction(df, columns).transform(df), ["x", "y"]),
    }
    rows = None
    for space, (points, coords) in spaces.items():
        points = cut_lineage(points.select(*coords))
        for method in methods:
            for k, result in _for_each_k(points, method, ks, coords, **options):
                labelled = cut_lineage(result.labelled.select(*coords, "cluster"))
                score = (silhouette_squared if squared else silhouette)(labelled, coords)
                one = score.select(
                    F.lit(space).alias("space"), F.lit(method).alias("method"), F.lit(k).alias("k"),
                    F.col(score.columns[0]).alias("silhouette_score"),
                )
                rows = one if rows is None else rows.unionByName(one)
    return rows


def _for_each_k(points: DataFrame, method: str, ks, coords: list[str], seed: int = SEED, restarts: int = RESTARTS, cell_width: float = 0.5, most_cells: int = microclusters.MOST_CELLS, **options):
    """(k, clustering); methods by centres fit all k in the same passes."""
    if method in ("kmeans", "birch"):
        fitted = points
        if method == "birch":
            fitted = microclusters.features(microclusters.adaptive_cells(points, coords, most_cells, cell_width), points.sparkSession, coords)
        runs = best_runs(fitted, coords, ks, seed, restarts, None if method == "kmeans" else "n")
        return [(k, _by_centers(method, points, coords, runs[k])) for k in runs]
    return [(k, cluster(points, method, k, coords, seed=seed, restarts=restarts, cell_width=cell_width, most_cells=most_cells, **options)) for k in ks]


def dominant_control(sides: DataFrame) -> DataFrame:
    """Most frequent time control of each player, ties to the first name."""
    return sides.where("player is not null").groupBy("player").agg(
        F.mode("time_control_category", True).alias("time_control_category")
    )


def cluster_by_stratum(
    profiles: DataFrame,
    strata: DataFrame,
    columns: list[str],
    k: int = 3,
    drop_outliers: bool = False,
    **options,
) -> DataFrame:
    """Separate clustering per time control; the controls are a fixed short list.

    Every player with a row in ``strata`` comes back. Outliers do not shape the clusters but get
    the nearest one and ``outlier``. ``cluster`` is NULL for players without a control or with a
    NULL feature, and in strata with fewer than k complete players to fit on.
    """
    table = profiles.drop("x", "y", "cluster", "outlier").join(strata, "player")
    names = sorted(
        r[0] for r in strata.select("time_control_category").distinct().collect() if r[0] is not None
    )
    complete = reduce(and_, (F.col(c).isNotNull() for c in columns))
    kept = table.columns

    def unplaced(df: DataFrame) -> DataFrame:
        nothing = [F.lit(None).cast(t).alias(c) for c, t in (("x", "double"), ("y", "double"), ("cluster", "int"))]
        return df.select(*kept, *nothing, F.lit(None).cast("boolean").alias("outlier"))

    rows = unplaced(table.where(F.col("time_control_category").isNull() | ~complete))
    for name in names:
        part = table.where((F.col("time_control_category") == name) & complete)
        inliers = without_outliers(part, columns) if drop_outliers else part
        if inliers.limit(k).count() < k:
            rows = rows.unionByName(unplaced(part))
            continue
        reduction = fit_reduction(inliers, columns)
        fitted = cluster(reduction.transform(inliers), "kmeans", k, **options)
        placed = fitted.model.transform(reduction.transform(part))
        inside = inliers.select("player", F.lit(False).alias("outlier")).distinct()
        placed = placed.select(*kept, "x", "y", F.col("cluster").cast("int").alias("cluster")).join(inside, "player", "left")
        rows = rows.unionByName(placed.withColumn("outlier", F.coalesce("outlier", F.lit(True))))
    return rows
