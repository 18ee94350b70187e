"""Splits, balancing, metrics and the tier models."""

from __future__ import annotations

from pyspark.sql import functions as F

from plyscope.functions.numbers import hash_fraction
from plyscope.operators import approaches, classifiers, metrics, players as player_ops, reports, scaling, split
from plyscope.operators.oversample import oversample
from plyscope.schema import TIERS
from plyscope.session import scratch_path
from verification import tables
from verification.queries_games import tier_pairs
from verification.registry import query
from verification.tables import features, games, points
from verification.views import PROFILE_ALL, PROFILE_BASE

ALL, BASE = list(PROFILE_ALL), list(PROFILE_BASE)

PAIRS = """pairs AS (SELECT game_id, white_skill_tier AS actual, black_skill_tier AS predicted FROM games),
confusion AS (SELECT actual, predicted, count(*) AS n FROM pairs GROUP BY ALL),
sides AS (
  SELECT label, sum(support) AS support, sum(guessed) AS guessed, sum(hits) AS hits FROM (
    SELECT actual AS label, n AS support, 0 AS guessed, CASE WHEN actual = predicted THEN n ELSE 0 END AS hits FROM confusion
    UNION ALL SELECT predicted, 0, n, 0 FROM confusion) GROUP BY label),
rates AS (
  SELECT label, CASE WHEN guessed > 0 THEN hits / guessed ELSE 0 END AS precision,
    CASE WHEN support > 0 THEN hits / support ELSE 0 END AS recall, support FROM sides),
report AS (
  SELECT label, precision, recall, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END AS f1, support FROM rates)"""


@query(
    "C01_label_codes",
    "SELECT skill_tier, dense_rank() OVER (ORDER BY skill_tier) - 1 AS code FROM (SELECT DISTINCT skill_tier FROM players)",
    i="code",
)
def _(spark, sf):
    return split.label_codes(tables.players(spark, sf)).select("skill_tier", "code")


_DEALT = """SELECT *, floor(quota) + CASE WHEN row_number() OVER (ORDER BY quota - floor(quota) DESC, class) <= part - sum(floor(quota)) OVER () THEN 1 ELSE 0 END AS {name}
  FROM (SELECT *, CAST({size} * part AS DOUBLE) / sum({size}) OVER () AS quota FROM ({classes}))"""
_HELD = _DEALT.format(
    name="held",
    size="n",
    classes="""SELECT *, ceil(sum(n) OVER () * CAST(0.3 AS DOUBLE) - CAST(1e-9 AS DOUBLE)) AS part FROM (
      SELECT {label} AS class, count(*) AS n FROM {table} WHERE {label} IS NOT NULL GROUP BY 1)""",
)
_CUTS = _DEALT.format(
    name="in_val",
    size="held",
    classes="SELECT class, held, part - ceil(part * CAST(0.5 AS DOUBLE) - CAST(1e-9 AS DOUBLE)) AS part FROM (" + _HELD + ")",
)
_SPLIT = """SELECT *, CASE WHEN r <= n - held THEN 'train' WHEN r <= n - held + in_val THEN 'val' ELSE 'test' END AS fold
  FROM (SELECT t.*, c.held, c.in_val,
      row_number() OVER (PARTITION BY {label} ORDER BY md5('42|' || {key}), {key}) AS r, count(*) OVER (PARTITION BY {label}) AS n
    FROM {table} t JOIN (""" + _CUTS + """) c ON t.{label} = c.class)"""


@query(
    "C02_stratified_split",
    "SELECT player, skill_tier, fold FROM (" + _SPLIT.format(label="skill_tier", key="player", table="players") + ")",
)
def _(spark, sf):
    return split.stratified_split(tables.players(spark, sf)).select("player", "skill_tier", "fold")


@query(
    "C02_stratified_split_of_games",
    "SELECT game_id, fold FROM (" + _SPLIT.format(label="white_skill_tier", key="CAST(game_id AS VARCHAR)", table="games") + ")",
    i="game_id",
)
def _(spark, sf):
    return split.stratified_split(games(spark, sf), "white_skill_tier", "game_id").select("game_id", "fold")


@query(
    "C03_standardised_features",
    f"""WITH s AS ({_SPLIT.format(label='skill_tier', key='player', table='players')}),
        f AS (SELECT {', '.join(f'avg({c}) AS m_{c}, CASE WHEN stddev_pop({c}) > 0 THEN stddev_pop({c}) ELSE 1 END AS s_{c}' for c in BASE)} FROM s WHERE fold = 'train')
        SELECT player, {', '.join(f'({c} - m_{c}) / s_{c} AS {c}' for c in BASE)} FROM s, f""",
    d=BASE,
)
def _(spark, sf):
    folds = tables.stored(split.stratified_split(tables.players(spark, sf)), "folds")
    return scaling.standardise(folds, BASE, folds.where("fold = 'train'")).select("player", *BASE)


_XYZT = ("x", "y", "z", "t")
_D2 = " + ".join(f"(a.{c} - b.{c}) * (a.{c} - b.{c})" for c in _XYZT)


@query(
    "C04_oversampling",
    f"""WITH p AS (SELECT CAST(vec_id AS VARCHAR) AS key, cluster AS label, x, y, z, t, count(*) OVER (PARTITION BY cluster) AS n FROM points),
          short AS (SELECT *, (SELECT max(n) FROM p) - n AS need, row_number() OVER (PARTITION BY label ORDER BY md5('42|' || key), key) AS r FROM p
            WHERE n < (SELECT max(n) FROM p)),
          drawn AS (SELECT *, need // n + CASE WHEN r <= need % n THEN 1 ELSE 0 END AS draws FROM short),
          base AS (SELECT d.*, u.draw FROM drawn d, (SELECT unnest(range(1, 1000)) AS draw) u WHERE draw <= draws),
          near AS (SELECT a.key, b.key AS other, b.x AS ox, b.y AS oy, b.z AS oz, b.t AS ot,
              row_number() OVER (PARTITION BY a.key ORDER BY sqrt({_D2}), b.key) AS k
            FROM drawn a JOIN short b ON a.label = b.label AND a.key <> b.key WHERE a.draws > 0),
          picked AS (SELECT *, CAST(floor(('0x' || substr(md5('42|n|' || key || '|' || draw), 1, 8))::BIGINT / CAST(4294967296 AS DOUBLE) * 5) AS BIGINT) + 1 AS k,
              ('0x' || substr(md5('42|u|' || key || '|' || draw), 1, 8))::BIGINT / CAST(4294967296 AS DOUBLE) AS u FROM base)
        SELECT key, label, x, y, z, t, false AS synthetic FROM p
        UNION ALL
        SELECT b.key || '#' || b.draw, label, x + u * (ox - x), y + u * (oy - y), z + u * (oz - z), t + u * (ot - t), true
        FROM picked b JOIN near USING (key, k)""",
    d=_XYZT,
    i="label",
)
def _(spark, sf):
    rows = points(spark, sf).select(F.col("vec_id").cast("string").alias("key"), F.col("cluster").alias("label"), *_XYZT)
    return oversample(rows, list(_XYZT), "label", "key")


def table_and_columns(spark, sf):
    df = tables.stored_players(spark, sf)
    return df, [c for c in ALL if c in df.columns]


def compared_models(spark, sf):
    """The comparison of all kinds of models, and the results by kind."""
    return tables.once(spark, sf, "models", lambda: classifiers.compare_models(*table_and_columns(spark, sf)))


def _train(spark, sf, kind):
    if kind == classifiers.FOREST:  # alone it needs no boosted trees
        return tables.once(spark, sf, kind, lambda: classifiers.train_classifier(*table_and_columns(spark, sf), kind))
    return compared_models(spark, sf)[1][kind]


@query("C05_random_forest")
def _(spark, sf):
    return _train(spark, sf, classifiers.FOREST).scores


@query("C06_boosted_trees")
def _(spark, sf):
    return _train(spark, sf, classifiers.BOOSTED).scores


@query("C07_soft_ensemble")
def _(spark, sf):
    return _train(spark, sf, classifiers.ENSEMBLE).scores


@query(
    "C07_soft_vote",
    """WITH p AS (SELECT vec_id, abs(x) AS a1, abs(y) AS a2, abs(z) AS a3, abs(t) AS b1, abs(x + y) AS b2, abs(z + t) AS b3 FROM points),
         s AS (SELECT vec_id, (a1 / (a1 + a2 + a3) + b1 / (b1 + b2 + b3)) / 2 AS p1, (a2 / (a1 + a2 + a3) + b2 / (b1 + b2 + b3)) / 2 AS p2,
           (a3 / (a1 + a2 + a3) + b3 / (b1 + b2 + b3)) / 2 AS p3 FROM p)
       SELECT vec_id, p1, p2, p3, CASE WHEN p1 >= p2 AND p1 >= p3 THEN 'Advanced' WHEN p2 >= p3 THEN 'Beginner' ELSE 'Intermediate' END AS predicted FROM s""",
    d="p1 p2 p3",
    i="vec_id",
)
def _(spark, sf):
    def shares(*values):
        total = values[0] + values[1] + values[2]
        return F.array(*[v / total for v in values])

    x, y, z, t = (F.col(c) for c in _XYZT)
    df = points(spark, sf).select(
        "vec_id",
        shares(F.abs(x), F.abs(y), F.abs(z)).alias("first"),
        shares(F.abs(t), F.abs(x + y), F.abs(z + t)).alias("second"),
    )
    voted = classifiers.soft_vote(df, ["first", "second"], sorted(TIERS))
    return voted.select("vec_id", *[F.col("probability")[i].alias(f"p{i + 1}") for i in range(3)], "predicted")


@query(
    "C08_class_weights",
    "SELECT white_skill_tier, count(*) AS count, (SELECT count(*) FROM games) / ((SELECT count(DISTINCT white_skill_tier) FROM games) * count(*)) AS weight FROM games GROUP BY 1",
    d="weight",
    i="count",
)
def _(spark, sf):
    return split.class_weights(games(spark, sf), "white_skill_tier")


@query("C09_accuracy", f"WITH {PAIRS} SELECT avg(CASE WHEN actual = predicted THEN 1 ELSE 0 END) AS accuracy FROM pairs", d="accuracy")
def _(spark, sf):
    return metrics.accuracy(tier_pairs(spark, sf))


def _code(order, column):
    return "CASE " + column + " " + " ".join(f"WHEN '{t}' THEN {i}" for i, t in enumerate(order)) + " END"


def adjacent_query(name, order, labels):
    gap = f"abs({_code(labels, 'actual')} - {_code(labels, 'predicted')})"

    @query(name, f"WITH {PAIRS} SELECT avg(CASE WHEN {gap} <= 1 THEN 1 ELSE 0 END) AS adjacent_accuracy FROM pairs", d="adjacent_accuracy")
    def _(spark, sf):
        return metrics.adjacent_accuracy(tier_pairs(spark, sf), order=order)


adjacent_query("C10_adjacent_accuracy", "ordinal", list(TIERS))
adjacent_query("C10_adjacent_accuracy_alphabetical", "alphabetical", sorted(TIERS))


@query(
    "C11_macro_scores",
    f"WITH {PAIRS} SELECT avg(precision) AS macro_precision, avg(recall) AS macro_recall, avg(f1) AS macro_f1 FROM report",
    d="macro_precision macro_recall macro_f1",
)
def _(spark, sf):
    return metrics.macro_scores(metrics.confusion_counts(tier_pairs(spark, sf)))


@query(
    "C12_confusion_matrix",
    f"WITH {PAIRS} SELECT actual, " + ", ".join(f"count(*) FILTER (predicted = '{t}') AS \"{t}\"" for t in sorted(TIERS)) + " FROM pairs GROUP BY actual",
    i=sorted(TIERS),
)
def _(spark, sf):
    return metrics.confusion_matrix(metrics.confusion_counts(tier_pairs(spark, sf)), sorted(TIERS))


@query(
    "C13_confusion_shares",
    f"WITH {PAIRS} SELECT actual, predicted, n, n / sum(n) OVER (PARTITION BY actual) AS share FROM confusion",
    d="share",
    i="n",
)
def _(spark, sf):
    return metrics.confusion_shares(metrics.confusion_counts(tier_pairs(spark, sf)))


@query(
    "C14_class_report",
    f"""WITH {PAIRS} SELECT * FROM report
        UNION ALL SELECT 'accuracy', a, a, a, n FROM (SELECT sum(CASE WHEN actual = predicted THEN n ELSE 0 END) / sum(n) AS a, sum(n) AS n FROM confusion)
        UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM report
        UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support), sum(f1 * support) / sum(support), sum(support) FROM report""",
    d="precision recall f1",
    i="support",
)
def _(spark, sf):
    return metrics.full_report(metrics.confusion_counts(tier_pairs(spark, sf)))


@query("C15_feature_importance")
def _(spark, sf):
    return _train(spark, sf, classifiers.ENSEMBLE).model.importances(spark)


@query("C16_class_distribution", "SELECT skill_tier, count(*) AS count FROM players GROUP BY 1", i="count")
def _(spark, sf):
    return split.class_distribution(tables.players(spark, sf))


@query("C17_grid_search")
def _(spark, sf):
    df, columns = table_and_columns(spark, sf)
    _, results = classifiers.tune(df, columns, classifiers.FOREST)
    return results


@query("C18_saved_model", f"SELECT player, true AS same FROM players WHERE {' AND '.join(f'{c} IS NOT NULL' for c in BASE)}")
def _(spark, sf):
    df, columns = table_and_columns(spark, sf)
    model = _fit_all(spark, sf, df, columns)
    path = scratch_path(spark, "model")
    model.save(path)
    again = classifiers.load_model(spark, path)
    first = model.predict(df).select("player", "predicted")
    second = again.predict(df).select("player", F.col("predicted").alias("reloaded"))
    return first.join(second, "player").select("player", F.col("predicted").eqNullSafe(F.col("reloaded")).alias("same"))


def _fit_all(spark, sf, df, columns):
    make = lambda: classifiers.fit_model(df, columns, sorted(TIERS), classifiers.ENSEMBLE, "skill_tier")
    return tables.once(spark, sf, "model of all rows", make)


@query("C19_batch_scoring")
def _(spark, sf):
    df, columns = table_and_columns(spark, sf)
    scored = _fit_all(spark, sf, df, columns).predict(df)
    return scored.select("player", "skill_tier", "predicted", *[F.col("probability")[i].alias(f"p{i}") for i in range(3)])


@query("C20_model_comparison")
def _(spark, sf):
    rows, _ = compared_models(spark, sf)
    best = classifiers.best_model(rows).select("model_type", F.lit(True).alias("best"))
    return rows.join(best, "model_type", "left").na.fill(False, subset=["best"])


_known = " AND ".join(f"{c} IS NOT NULL" for c in BASE)


@query(
    "C21_white_game_rows",
    f"SELECT game_id, side, player, game_tier AS label, avg_time_endgame FROM seats WHERE side = 'white' AND {_known}",
    d="avg_time_endgame",
    i="game_id",
)
def _(spark, sf):
    rows, _ = player_ops.game_level_rows(features(spark, sf))
    return rows.select("game_id", "side", "player", "label", "avg_time_endgame")


_plain = [c for c in BASE if not c.startswith("time_per_complexity")]


@query(
    "C21_both_sides_game_rows",
    f"""SELECT game_id, side, player, game_tier AS label, time_variance_endgame,
          avg_time_opening / (avg_position_complexity + CAST(0.001 AS DOUBLE)) AS time_per_complexity_opening
        FROM seats WHERE {' AND '.join(f'{c} IS NOT NULL' for c in _plain)}""",
    d="time_variance_endgame time_per_complexity_opening",
    i="game_id",
)
def _(spark, sf):
    rows, _ = player_ops.game_level_rows(features(spark, sf, white_only_pace=False), both_sides=True)
    return rows.select("game_id", "side", "player", "label", "time_variance_endgame", "time_per_complexity_opening")


@query(
    "C23_majority_baseline",
    "SELECT max(n) / sum(n) AS baseline_accuracy FROM (SELECT count(*) AS n FROM players GROUP BY skill_tier)",
    d="baseline_accuracy",
)
def _(spark, sf):
    return metrics.majority_baseline(tables.players(spark, sf), "skill_tier")


@query(
    "R15_spread_ranking",
    f"""SELECT feature, CASE feature {' '.join(f"WHEN '{c}' THEN '{c.replace('_', ' ').title()}'" for c in BASE)} END AS label, importance FROM (
          {' UNION ALL '.join(f"SELECT '{c}' AS feature, coalesce(stddev_pop({c}) / nullif(avg({c}), 0), 0) AS importance FROM players" for c in BASE)})
        ORDER BY importance DESC, feature LIMIT 10""",
    d="importance",
)
def _(spark, sf):
    # the same ranking and labels over a figure that SQL can compute: the relative spread of each feature
    spread = tables.players(spark, sf).agg(
        *[F.coalesce(F.stddev_pop(c) / F.nullif(F.avg(c), F.lit(0.0)), F.lit(0.0)).alias(c) for c in BASE]
    )
    entries = [F.struct(F.lit(f"white_{c}").alias("feature"), F.col(c).alias("importance")) for c in BASE]
    top = reports.top_importances(spread.select(F.inline(F.array(*entries))), 10)
    return top.withColumn("feature", F.regexp_replace("feature", "^white_", ""))


@query("R15_top_importances")
def _(spark, sf):
    return reports.top_importances(_train(spark, sf, classifiers.ENSEMBLE).model.importances(spark))


@query(
    "C21_split_by_player",
    f"""WITH sized AS (SELECT player, label, total AS n FROM (
            SELECT player, label, n, sum(n) OVER (PARTITION BY player) AS total FROM (
              SELECT player, game_tier AS label, count(*) AS n FROM seats WHERE {' AND '.join(f'{c} IS NOT NULL' for c in _plain)} GROUP BY 1, 2))
            QUALIFY row_number() OVER (PARTITION BY player ORDER BY n DESC, label) = 1),
          dealt AS (SELECT *, sum(n) OVER (PARTITION BY label) AS rows,
              coalesce(sum(n) OVER (PARTITION BY label ORDER BY md5('42|' || player), player ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS begin FROM sized)
        SELECT player, n, CASE WHEN begin < rows * CAST(0.7 AS DOUBLE) THEN 'train' WHEN begin < rows * CAST(0.85 AS DOUBLE) THEN 'val' ELSE 'test' END AS fold FROM dealt""",
    i="n",
)
def _(spark, sf):
    rows, _ = player_ops.game_level_rows(features(spark, sf, white_only_pace=False), both_sides=True)
    # the split reads its rows twice
    split = approaches.grouped_split(tables.stored(rows.select("player", "label"), "game-rows"))
    return split.groupBy("player", "fold").agg(F.count(F.lit(1)).alias("n"))


@query("C21_approach_comparison")
def _(spark, sf):
    return approaches.compare_approaches(tables.stored(features(spark, sf, white_only_pace=False), "features"))


@query("A12_scored_sweep")
def _(spark, sf):
    return approaches.scored_sweep(tables.stored(features(spark, sf), "features"), (25, 30, 33))
