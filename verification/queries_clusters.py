"""Clustering, validity indices, archetypes and their reports."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from plyscope.operators import classifiers, clusters, indices, microclusters, profiles, reports, scaling
from plyscope.operators.density import core_flags, density_clusters
from plyscope.operators.density_any import density_clusters_any
from plyscope.operators.players import fold_sides, player_profiles
from plyscope.plans.analysis import summary_record
from plyscope.schema import STYLE_FEATURES
from plyscope.session import scratch_path
from verification import tables
from verification.queries_games import games
from verification.queries_models import compared_models
from verification.registry import query
from verification.tables import features, labelled, points, stored, stored_players

STYLE = list(STYLE_FEATURES)
XY = ["x", "y"]
EPS, MIN_POINTS = 0.03, 5


def style_map(spark, sf):
    """Style features of the players with their two components."""
    return tables.once(spark, sf, "style map", lambda: _style_map(spark, sf))


def _style_map(spark, sf):
    df, kept, _ = scaling.prepare_clustering(stored_players(spark, sf), STYLE)
    reduction = clusters.fit_reduction(df, kept)
    return stored(reduction.transform(df), "map"), kept, reduction


def clustered(spark, sf, method="kmeans"):
    return tables.once(spark, sf, f"clusters by {method}", lambda: clusters.cluster(style_map(spark, sf)[0], method))


# --- preparation ---------------------------------------------------------------------


@query("K01_style_selection", f"SELECT player, elo, game_count, skill_tier, {', '.join(STYLE)} FROM players", d=["elo", *STYLE], i="game_count")
def _(spark, sf):
    df = tables.players(spark, sf)
    kept, missing = scaling.clustering_columns(df)
    if missing:
        raise AssertionError(missing)
    return df.select("player", "elo", "game_count", "skill_tier", *kept)


_HOLES = "CASE WHEN vec_id % 7 = 0 THEN NULL ELSE x END"


@query("K02_mean_imputation", f"SELECT vec_id, coalesce({_HOLES}, (SELECT avg({_HOLES}) FROM points)) AS x, y FROM points", d=XY, i="vec_id")
def _(spark, sf):
    df = points(spark, sf).select("vec_id", F.when(F.col("vec_id") % 7 != 0, F.col("x")).alias("x"), "y")
    return scaling.impute_means(df, XY)


@query(
    "K03_constant_columns",
    "SELECT 'flat' AS dropped, count(*) AS points FROM points",
    i="points",
)
def _(spark, sf):
    df = points(spark, sf).withColumn("flat", F.lit(0.1))
    dropped = scaling.constant_columns(df, ["x", "flat", "y"])
    return df.agg(F.lit(",".join(dropped)).alias("dropped"), F.count(F.lit(1)).alias("points"))


@query(
    "K04_standardised",
    "SELECT vec_id, (x - avg(x) OVER ()) / stddev_pop(x) OVER () AS x, (y - avg(y) OVER ()) / stddev_pop(y) OVER () AS y FROM points",
    d=XY,
    i="vec_id",
)
def _(spark, sf):
    return scaling.standardise(points(spark, sf).select("vec_id", *XY), XY)


@query(
    "K05_two_column_components",
    """SELECT component, (1 + CASE component WHEN 1 THEN 1 ELSE -1 END * abs(corr(x, y))) / 2 AS explained, sqrt(CAST(0.5 AS DOUBLE)) AS loading
       FROM points, (VALUES (1), (2)) AS c(component) GROUP BY component""",
    d="explained loading",
    i="component",
)
def _(spark, sf):
    reduction = clusters.fit_reduction(points(spark, sf), XY)
    rows = [(i + 1, e, abs(w[0])) for i, (e, w) in enumerate(zip(reduction.explained, reduction.loadings))]
    return spark.createDataFrame(rows, "component int, explained double, loading double")


@query("K05_style_components")
def _(spark, sf):
    df, kept, reduction = style_map(spark, sf)
    return df.agg(F.var_samp("x").alias("var_x"), F.var_samp("y").alias("var_y"), F.corr("x", "y").alias("corr_xy")).withColumn(
        "explained", F.lit(sum(reduction.explained))
    )


# --- methods -------------------------------------------------------------------------

_CENTERS = [[-0.1, -0.1], [0.1, -0.05], [0.0, 0.12]]


def _d2(i):
    a, b = _CENTERS[i]
    return f"((x - CAST({a} AS DOUBLE)) * (x - CAST({a} AS DOUBLE)) + (y - CAST({b} AS DOUBLE)) * (y - CAST({b} AS DOUBLE)))"


@query(
    "K06_center_assignment",
    f"SELECT vec_id, CASE WHEN {_d2(0)} <= {_d2(1)} AND {_d2(0)} <= {_d2(2)} THEN 0 WHEN {_d2(1)} <= {_d2(2)} THEN 1 ELSE 2 END AS cluster FROM points",
    i="vec_id cluster",
)
def _(spark, sf):
    return points(spark, sf).select("vec_id", clusters.nearest_center(XY, _CENTERS).alias("cluster"))


def method_query(name, method):
    @query(name)
    def _(spark, sf):
        return clustered(spark, sf, method).labelled.select("player", "x", "y", "cluster")


for _name, _method in (
    ("K06_kmeans", "kmeans"),
    ("K07_hierarchical", "hierarchical"),
    ("K09_gaussian_mixture", "gmm"),
    ("K10_micro_cluster_kmeans", "birch"),
):
    method_query(_name, _method)


_EPS2 = repr(EPS * EPS)
_NEAR = f"(a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) <= CAST({_EPS2} AS DOUBLE)"
_CORE = f"SELECT a.vec_id FROM points a JOIN points b ON {_NEAR} GROUP BY a.vec_id HAVING count(*) >= {MIN_POINTS}"


@query(
    "K08_core_points",
    f"SELECT vec_id, vec_id IN ({_CORE}) AS core FROM points",
    i="vec_id",
)
def _(spark, sf):
    return core_flags(points(spark, sf), EPS, MIN_POINTS, "vec_id").select("vec_id", "core")


@query(
    "K08_density_clusters",
    f"""SELECT p.vec_id, coalesce(c.cluster, e.cluster, -1) AS cluster, c.cluster IS NOT NULL AS core FROM points p
        LEFT JOIN core_labels c USING (vec_id) LEFT JOIN edge_labels e USING (vec_id)""".join(
        (
            f"""WITH RECURSIVE core AS MATERIALIZED (SELECT * FROM points WHERE vec_id IN ({_CORE})),
            links AS MATERIALIZED (SELECT a.vec_id AS s, b.vec_id AS t FROM core a JOIN core b ON {_NEAR}),
            reach AS (SELECT vec_id AS s, vec_id AS t FROM core UNION SELECT r.s, l.t FROM reach r JOIN links l ON r.t = l.s),
            firsts AS (SELECT s AS vec_id, min(t) AS first FROM reach GROUP BY s),
            numbers AS (SELECT first, row_number() OVER (ORDER BY md5(CAST(first AS VARCHAR))) - 1 AS cluster FROM (SELECT DISTINCT first FROM firsts)),
            core_labels AS (SELECT vec_id, cluster FROM firsts JOIN numbers USING (first)),
            edge_labels AS (SELECT b.vec_id, min(n.cluster) AS cluster FROM core a JOIN core_labels n ON n.vec_id = a.vec_id JOIN points b ON {_NEAR}
              WHERE b.vec_id NOT IN (SELECT vec_id FROM core) GROUP BY b.vec_id)
            """,
            "",
        )
    ),
    i="vec_id cluster",
)
def _(spark, sf):
    return density_clusters(points(spark, sf), EPS, MIN_POINTS, "vec_id").select("vec_id", "cluster", "core")


_XYZT = ("x", "y", "z", "t")
_EPS4 = 0.12
_NEAR4 = " + ".join(f"(a.{c} - b.{c}) * (a.{c} - b.{c})" for c in _XYZT) + f" <= CAST({_EPS4 * _EPS4!r} AS DOUBLE)"


@query(
    "K08_density_clusters_4d",
    f"""WITH RECURSIVE near AS MATERIALIZED (SELECT a.vec_id AS s, b.vec_id AS t FROM points a JOIN points b ON {_NEAR4}),
        core AS MATERIALIZED (SELECT s AS vec_id FROM near GROUP BY s HAVING count(*) >= {MIN_POINTS}),
        links AS MATERIALIZED (SELECT s, t FROM near WHERE s IN (SELECT vec_id FROM core) AND t IN (SELECT vec_id FROM core)),
        reach AS (SELECT vec_id AS s, vec_id AS t FROM core UNION SELECT r.s, l.t FROM reach r JOIN links l ON r.t = l.s),
        firsts AS (SELECT s AS vec_id, min(t) AS first FROM reach GROUP BY s),
        numbers AS (SELECT first, row_number() OVER (ORDER BY md5(CAST(first AS VARCHAR))) - 1 AS cluster FROM (SELECT DISTINCT first FROM firsts)),
        core_labels AS (SELECT vec_id, cluster FROM firsts JOIN numbers USING (first)),
        edge_labels AS (SELECT n.s AS vec_id, min(c.cluster) AS cluster FROM near n JOIN core_labels c ON c.vec_id = n.t
          WHERE n.s NOT IN (SELECT vec_id FROM core) GROUP BY 1)
        SELECT p.vec_id, coalesce(c.cluster, e.cluster, -1) AS cluster, c.cluster IS NOT NULL AS core FROM points p
        LEFT JOIN core_labels c USING (vec_id) LEFT JOIN edge_labels e USING (vec_id)""",
    i="vec_id cluster",
)
def _(spark, sf):
    return density_clusters_any(points(spark, sf), list(_XYZT), _EPS4, MIN_POINTS, "vec_id").select("vec_id", "cluster", "core")


@query(
    "K10_adaptive_cells",
    "SELECT count(*) AS n, sum(x) AS sum_x, sum(y) AS sum_y, sum(x * x + y * y) AS sum_squares, true AS bounded FROM points",
    d="sum_x sum_y sum_squares",
    i="n",
)
def _(spark, sf):
    cells = microclusters.adaptive_cells(points(spark, sf), XY, 100)
    found = microclusters.features(cells, spark, XY)
    sums = [F.sum(c).alias(c) for c in ("n", "sum_x", "sum_y", "sum_squares")]
    return found.agg(*sums, (F.count(F.lit(1)) <= 100).alias("bounded"))


@query(
    "K10_micro_clusters",
    """SELECT CAST(floor(x / CAST(0.05 AS DOUBLE)) AS BIGINT) AS cell_x, CAST(floor(y / CAST(0.05 AS DOUBLE)) AS BIGINT) AS cell_y, count(*) AS n,
         sum(x) AS sum_x, sum(y) AS sum_y, sum(x * x + y * y) AS sum_squares, avg(x) AS x, avg(y) AS y FROM points GROUP BY 1, 2""",
    d="sum_x sum_y sum_squares x y",
    i="cell_x cell_y n",
)
def _(spark, sf):
    return clusters.micro_clusters(points(spark, sf), XY, 0.05)


# --- indices -------------------------------------------------------------------------


def index_sql(metric, name):
    gap = "(a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)"
    return f"""WITH sums AS (
          SELECT a.vec_id, a.cluster, b.cluster AS other, sum({metric.format(gap)}) AS total, count(*) AS n
          FROM points a, points b GROUP BY ALL),
        per_point AS (SELECT vec_id, max(total) FILTER (cluster = other) AS own, max(n) FILTER (cluster = other) AS size,
          min(total / n) FILTER (cluster <> other) AS b FROM sums GROUP BY vec_id)
        SELECT avg(CASE WHEN size > 1 THEN (b - own / (size - 1)) / greatest(b, own / (size - 1)) ELSE 0 END) AS {name} FROM per_point"""


@query("K11_silhouette", index_sql("sqrt({})", "silhouette"), d="silhouette")
def _(spark, sf):
    return indices.silhouette(points(spark, sf), XY)


@query("K11_silhouette_squared", index_sql("{}", "silhouette_squared"), d="silhouette_squared")
def _(spark, sf):
    return indices.silhouette_squared(points(spark, sf), XY)


_CENTROIDS = "c AS (SELECT cluster, avg(x) AS cx, avg(y) AS cy, count(*) AS n FROM points GROUP BY cluster)"
_WITHIN = "(SELECT sum((x - cx) * (x - cx) + (y - cy) * (y - cy)) FROM points JOIN c USING (cluster))"


@query(
    "K12_calinski_harabasz",
    f"""WITH {_CENTROIDS} SELECT (sum(n * ((cx - mx) * (cx - mx) + (cy - my) * (cy - my))) / (count(*) - 1)) / ({_WITHIN} / (sum(n) - count(*))) AS calinski_harabasz
        FROM c, (SELECT avg(x) AS mx, avg(y) AS my FROM points)""",
    d="calinski_harabasz",
)
def _(spark, sf):
    return indices.calinski_harabasz(points(spark, sf), XY)


@query(
    "K13_davies_bouldin",
    f"""WITH {_CENTROIDS}, s AS (SELECT cluster, cx, cy, avg(sqrt((x - cx) * (x - cx) + (y - cy) * (y - cy))) AS s FROM points JOIN c USING (cluster) GROUP BY ALL)
        SELECT avg(worst) AS davies_bouldin FROM (SELECT a.cluster, max((a.s + b.s) / sqrt((a.cx - b.cx) * (a.cx - b.cx) + (a.cy - b.cy) * (a.cy - b.cy))) AS worst
          FROM s a JOIN s b ON a.cluster <> b.cluster GROUP BY a.cluster)""",
    d="davies_bouldin",
)
def _(spark, sf):
    return indices.davies_bouldin(points(spark, sf), XY)


@query(
    "K14_single_label_indices",
    "SELECT 0 AS silhouette_score, 0 AS calinski_harabasz_index, 0 AS davies_bouldin_index, count(*) AS points FROM points",
    d="silhouette_score calinski_harabasz_index davies_bouldin_index",
    i="points",
)
def _(spark, sf):
    one = points(spark, sf).withColumn("cluster", F.col("cluster") * 0)
    return indices.all_indices(one, XY).withColumn("points", one.agg(F.count(F.lit(1))).scalar())


@query("K15_inertia", f"WITH {_CENTROIDS} SELECT {_WITHIN} AS inertia", d="inertia")
def _(spark, sf):
    return indices.inertia(points(spark, sf), XY)


@query("K16_k_sweep")
def _(spark, sf):
    df, _, _ = style_map(spark, sf)
    sweep = stored(clusters.sweep_k(df, XY), "sweep")
    best = clusters.best_k(sweep).select("k", F.lit(True).alias("best"))
    return sweep.join(best, "k", "left").na.fill(False, subset=["best"])


@query("K17_method_comparison")
def _(spark, sf):
    df, _, reduction = style_map(spark, sf)
    return clusters.compare_methods(df, explained=sum(reduction.explained))


@query(
    "K18_best_method",
    """SELECT 'm' || cluster AS method, avg(x) AS silhouette_score, avg(y) AS davies_bouldin_index FROM points GROUP BY cluster
       ORDER BY silhouette_score DESC, davies_bouldin_index, method LIMIT 1""",
    d="silhouette_score davies_bouldin_index",
)
def _(spark, sf):
    table = points(spark, sf).groupBy(F.concat(F.lit("m"), F.col("cluster").cast("string")).alias("method")).agg(
        F.avg("x").alias("silhouette_score"), F.avg("y").alias("davies_bouldin_index")
    )
    return clusters.best_method(table)


# --- profiles ------------------------------------------------------------------------

_TIERS = ("Beginner", "Intermediate", "Advanced")
_STATS = f"""SELECT cluster, count(*) AS size, count(*) * CAST(100 AS DOUBLE) / (SELECT count(*) FROM labelled) AS pct_of_total, avg(elo) AS elo, avg(game_count) AS avg_games,
  {', '.join(f"count(*) FILTER (skill_tier = '{t}') * CAST(100 AS DOUBLE) / count(*) AS pct_{t.lower()}" for t in _TIERS)},
  {', '.join(f'avg({c}) AS {c}_mean' for c in STYLE[:10])} FROM labelled WHERE cluster <> -1 GROUP BY cluster"""
_STAT_DOUBLES = ["pct_of_total", "elo", "avg_games", *[f"pct_{t.lower()}" for t in _TIERS], *[f"{c}_mean" for c in STYLE[:10]]]
_NAMES = f"""SELECT cluster, size, elo, CASE rk WHEN 1 THEN 'Time Scramblers' WHEN 2 THEN 'Positional Grinders' ELSE 'Tactical Battlers' END AS name
  FROM (SELECT *, row_number() OVER (ORDER BY elo DESC, cluster) AS rk FROM ({_STATS}))"""
_NAMED = f"""SELECT l.*, n.name AS archetype FROM labelled l LEFT JOIN ({_NAMES}) n USING (cluster)"""


def named(spark, sf):
    """Labelled players with their archetype, and the statistics and names behind it."""
    df = labelled(spark, sf)
    stats = profiles.cluster_statistics(df, STYLE)
    names = profiles.name_clusters(stats)
    return profiles.with_archetype(df, names), stats, names


@query("K19_cluster_statistics", _STATS, d=_STAT_DOUBLES, i="cluster size")
def _(spark, sf):
    return profiles.cluster_statistics(labelled(spark, sf), STYLE)


@query(
    "K20_tier_shares",
    f"SELECT cluster, pct_beginner, pct_intermediate, pct_advanced FROM ({_STATS})",
    d="pct_beginner pct_intermediate pct_advanced",
    i="cluster",
)
def _(spark, sf):
    stats = profiles.cluster_statistics(labelled(spark, sf), STYLE)
    return stats.select("cluster", "pct_beginner", "pct_intermediate", "pct_advanced")


@query("K21_cluster_names", _NAMES, d="elo", i="cluster size")
def _(spark, sf):
    _, _, names = named(spark, sf)
    return names.select("cluster", "size", "elo", "name")


@query("K22_player_map")
def _(spark, sf):
    placed = clustered(spark, sf).labelled.select("player", "x", "y", "cluster")
    return tables.stored_players(spark, sf).select("player", "elo", "skill_tier").join(placed, "player")


@query("K23_saved_cluster_model")
def _(spark, sf):
    df, _, _ = style_map(spark, sf)
    result = clustered(spark, sf)
    path = scratch_path(spark, "cluster-model")
    result.model.write().overwrite().save(path)
    again = PipelineModel.load(path).transform(df).select("player", F.col("cluster").alias("reloaded"))
    return result.labelled.select("player", "cluster").join(again, "player")


@query(
    "K24_archetype_centroids",
    f"SELECT archetype, {', '.join(f'avg({c}) AS {c}' for c in STYLE)} FROM ({_NAMED}) WHERE archetype IS NOT NULL GROUP BY archetype",
    d=STYLE,
)
def _(spark, sf):
    return profiles.archetype_centroids(named(spark, sf)[0])


@query(
    "K25_sigma_profile",
    f"""WITH m AS (SELECT {', '.join(f'avg({c}) AS m_{c}, nullif(stddev_pop({c}), 0) AS s_{c}' for c in STYLE)} FROM labelled)
        SELECT cluster, {', '.join(f'(avg({c}) - any_value(m_{c})) / any_value(s_{c}) AS {c}' for c in STYLE)} FROM labelled, m GROUP BY cluster""",
    d=STYLE,
    i="cluster",
)
def _(spark, sf):
    return profiles.archetype_sigma_profile(labelled(spark, sf), group="cluster")


@query(
    "K26_without_outliers",
    """SELECT vec_id FROM (SELECT vec_id, abs((x - avg(x) OVER ()) / stddev_pop(x) OVER ()) AS a, abs((y - avg(y) OVER ()) / stddev_pop(y) OVER ()) AS b FROM points)
       WHERE a < CAST(1.5 AS DOUBLE) AND b < CAST(1.5 AS DOUBLE)""",
    i="vec_id",
)
def _(spark, sf):
    return scaling.without_outliers(points(spark, sf), XY, 1.5).select("vec_id")


@query(
    "K27_clusters_per_time_control",
    f"""SELECT player, time_control_category, true AS placed FROM (
          SELECT player, time_control_category FROM (SELECT player, time_control_category, count(*) AS n FROM seats GROUP BY ALL)
          QUALIFY row_number() OVER (PARTITION BY player ORDER BY n DESC, time_control_category) = 1)
        JOIN (SELECT player FROM players) USING (player)""",
)
def _(spark, sf):
    # both the controls and the profiles come from the games
    made = stored(features(spark, sf), "features")
    strata = stored(clusters.dominant_control(fold_sides(made, extra=["time_control_category"])), "strata")
    found = clusters.cluster_by_stratum(stored(player_profiles(made), "players"), strata, STYLE, drop_outliers=True)
    # too small a stratum or a missing feature leaves the cluster open; all others have one of the three
    placed = F.coalesce(F.col("cluster").between(0, 2) & F.col("x").isNotNull() & F.col("outlier").isNotNull(), F.lit(True))
    return found.select("player", "time_control_category", placed.alias("placed"))


@query(
    "K27_dominant_control",
    """SELECT player, time_control_category FROM (SELECT player, time_control_category, count(*) AS n FROM seats GROUP BY ALL)
       QUALIFY row_number() OVER (PARTITION BY player ORDER BY n DESC, time_control_category) = 1""",
)
def _(spark, sf):
    sides = fold_sides(features(spark, sf), extra=["time_control_category"])
    return clusters.dominant_control(sides)


@query("K28_silhouette_grid")
def _(spark, sf):
    df, kept, _ = scaling.prepare_clustering(stored_players(spark, sf), STYLE)
    return clusters.silhouette_grid(stored(df, "style"), kept)


# --- reports -------------------------------------------------------------------------


@query("R09_archetype_shares", f"SELECT archetype, count(*) AS players, count(*) / (SELECT count(*) FROM labelled) AS share FROM ({_NAMED}) WHERE archetype IS NOT NULL GROUP BY 1", d="share", i="players")
def _(spark, sf):
    return reports.archetype_shares(named(spark, sf)[0])


@query(
    "R10_archetype_summary",
    f"""SELECT archetype, count(*) AS size, CAST(CAST(round_even(count(*) * CAST(100 AS DOUBLE) / sum(count(*)) OVER (), 0) AS INTEGER) AS VARCHAR) || '%' AS pct,
          CAST(round_even(avg(elo), 0) AS BIGINT) AS avg_elo FROM ({_NAMED}) WHERE archetype IS NOT NULL GROUP BY 1""",
    i="size avg_elo",
)
def _(spark, sf):
    return reports.archetype_summary(named(spark, sf)[0], rating="elo")


@query(
    "R11_player_filter",
    "SELECT player, skill_tier, elo FROM players WHERE skill_tier IN ('Beginner', 'Advanced') AND elo BETWEEN 1000 AND 2100",
    d="elo",
)
def _(spark, sf):
    return reports.filter_players(tables.players(spark, sf), ["Beginner", "Advanced"], 1000, 2100, "elo").select("player", "skill_tier", "elo")


@query(
    "R13_sample_players",
    f"SELECT archetype, arg_min(player, md5(player)) AS player FROM ({_NAMED}) WHERE archetype IS NOT NULL GROUP BY 1",
)
def _(spark, sf):
    return reports.sample_players(named(spark, sf)[0])


@query("R14_archetype_lookup", f"SELECT player, cluster, archetype FROM ({_NAMED})", i="cluster")
def _(spark, sf):
    return named(spark, sf)[0].select("player", "cluster", "archetype")


@query(
    "R19_tier_composition",
    f"SELECT cluster, tier, percentage FROM (SELECT cluster, pct_beginner AS Beginner, pct_intermediate AS Intermediate, pct_advanced AS Advanced FROM ({_STATS})) UNPIVOT (percentage FOR tier IN (Beginner, Intermediate, Advanced))",
    d="percentage",
    i="cluster",
)
def _(spark, sf):
    return reports.tier_composition(named(spark, sf)[1])


@query("R20_cluster_sizes", f"SELECT name AS archetype, size, CAST(round_even(elo, 0) AS BIGINT) AS avg_elo FROM ({_NAMES})", i="size avg_elo")
def _(spark, sf):
    return reports.cluster_sizes(named(spark, sf)[2])


@query("R23_summary_record")
def _(spark, sf):
    # the fitted classifiers and the fitted clustering, as the whole analysis reports them
    rows, _ = compared_models(spark, sf)
    best = rows.join(classifiers.best_model(rows).select("model_type"), "model_type")
    points_, kept, reduction = style_map(spark, sf)
    placed = clustered(spark, sf).labelled
    quality = clusters.compare_methods(points_, methods=("kmeans",), explained=sum(reduction.explained))
    names = profiles.name_clusters(profiles.cluster_statistics(placed, kept))
    summary = summary_record(games(spark, sf), features(spark, sf), stored_players(spark, sf), best, quality, names, "order lines")
    return summary.select(F.to_json(F.struct("*")).alias("summary"))
