"""Registered queries of the trained models (seed-dependent: rows-only checks,
except the kNN leave-one-out evaluation, which is exact)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import clusters as K
from ..operators import ml as ML
from ..operators import profiles as P
from ..operators import recommend as R
from ..operators import scoring as SC
from ..operators import stats as ST
from ..operators.common import attach_scalars
from ..sources import fixtures as fx
from ..streaming.incremental import new_run_dir
from .queries_recommend import _A09_SQL
from .registry import finalize, register


def _scaled(spark, sf):
    e = P.game_features(fx.games(spark, sf))
    return e, K.scale(e, K.FEATURES, K.scaler_stats(e))


def _trained(e, features):
    """Rows, means and centre of each cluster, by quality rank, and the model's cost."""
    z = K.scale(e, features, K.scaler_stats(e, features))
    model = ML.train_kmeans(z, features=features)
    lv = K.relabel_by_quality(K.assign_clusters(z, model.centres.tolist(), features), "model")
    centre = F.element_at(F.array(*[F.array(*[F.lit(float(v)) for v in c]) for c in model.centres]), F.col("cluster_raw") + 1)
    found = lv.groupBy("rank", "cluster_raw").agg(F.count(F.lit(1)).alias("n"), F.avg("acl_w").alias("acl_mean"), F.avg("theory_depth").alias("theory_mean"))
    return found.withColumns({f"c_{f}": centre[i] for i, f in enumerate(features)}).withColumn("cost", F.lit(model.cost)).drop("cluster_raw")


@register("m09_kmeans_training")
def m09(spark, sf):
    return finalize(_trained(P.game_features(fx.games(spark, sf)), K.FEATURES))


@register("m09_kmeans_flags")
def m09_flags(spark, sf):
    # the variant with the game flags and the result
    return finalize(_trained(P.game_features(fx.games(spark, sf)), [*K.FEATURES, "is_theory_expert", "is_feeling_natural", "is_critical_point", "score"]))


@register("m10_k_sweep")
def m10(spark, sf):
    _e, z = _scaled(spark, sf)
    rows = ML.k_sweep(z, range(2, 9))
    return finalize(spark.createDataFrame(rows, "k int, cost double, silhouette double, davies_bouldin double"))


@register("m04_m06_rf_experiments")
def m04(spark, sf):
    e = P.enrich_games(fx.games(spark, sf))
    users = e.groupBy("player").agg(F.min_by("level3", "ingest_seq").alias("level3"), F.count(F.lit(1)).alias("n"))
    users = ST.group_split(users, method="modulus")
    # folds over the training users only (held-out users never enter CV)
    folds = ST.snake_folds(users.filter("is_train"), "level3", "n", 5).select("player", "fold")
    # user features of the training games only (A05), so nothing of the held-out users leaks
    user = ["win_rate_user", "avg_theory_user", "avg_acl_user", "std_acl_user", "n_games_user"]
    split = ST.group_split(e.select("player"), method="modulus")
    own = ST.leakage_free_user_features(e, split).drop("is_train")
    d = ST.group_split(e.drop(*user).join(own, "player").join(folds, "player", "left"), method="modulus").fillna(0.0).fillna(0, ["fold"])
    sets = {"game": ["theory_depth", "acl_w", "risk_index", "prep_score", "color_bin", "score"],
            "user": user}
    sets["all"] = sets["game"] + sets["user"]
    rows = ML.rf_experiments(d, "level3", sets, num_trees=50)
    return finalize(spark.createDataFrame(rows, "feature_set string, cv_f1 double, test_f1 double, gap double"))


@register("m14_tree_rules")
def m14(spark, sf):
    e = P.game_features(fx.games(spark, sf))
    lv = K.game_levels(e, K.scaler_stats(e)).withColumn("level", R.level_of_cluster())
    z = K.scale(ST.group_split(lv, method="modulus"), K.FEATURES, K.scaler_stats(e)).fillna(0.0)
    rules, train_acc, test_acc = ML.tree_rules(z, "level", [f"z_{c}" for c in K.FEATURES])
    return finalize(rules.withColumn("train_accuracy", F.lit(train_acc)).withColumn("test_accuracy", F.lit(test_acc)))


@register("s13_model_roundtrip")
def s13(spark, sf):
    _e, z = _scaled(spark, sf)
    path = new_run_dir(spark, "model")
    scored = ML.save_and_load(z, path)
    return scored.groupBy("prediction").agg(F.count(F.lit(1)).alias("n"))


@register("m15_player_groups")
def m15(spark, sf):
    g = fx.games(spark, sf)
    band = R.band_aggregate(g.select("rating"), g)
    return finalize(ML.player_groups(g, band))


@register("m05_knn_loo", f"""WITH {_A09_SQL},
lab AS (SELECT player, arg_min(level3, ingest_seq) AS level3 FROM gx GROUP BY player),
votes AS (SELECT nb.player, lab.level3 AS cls, sum(1.0 / greatest(nb.distance, 1e-9)) AS w FROM nb JOIN lab ON lab.player = nb.neighbour GROUP BY nb.player, lab.level3),
pred AS (SELECT player, cls AS y_pred FROM (SELECT *, row_number() OVER (PARTITION BY player ORDER BY w DESC, cls) AS rn FROM votes) WHERE rn = 1)
SELECT pred.player, y_pred, lab.level3 AS y_true, y_pred = lab.level3 AS correct FROM pred JOIN lab USING (player)""")
def m05(spark, sf):
    lv = K.game_levels(P.game_features(fx.games(spark, sf)), K.scaler_stats(P.game_features(fx.games(spark, sf))))
    nb = R.knn_neighbours(R.weighted_vectors(R.similarity_profiles(lv)), 5)
    lab = P.game_features(fx.games(spark, sf)).groupBy("player").agg(F.min_by("level3", "ingest_seq").alias("level3"))
    return R.knn_loo_predictions(nb, lab, "level3")


CLASSES = ["avanzado", "intermedio", "principiante"]
_GRID_SQL = _A09_SQL.replace("WHERE rank <= 5)", "WHERE rank <= 11)") + f""",
lab AS (SELECT player, arg_min(level3, ingest_seq) AS level3 FROM gx GROUP BY player),
ks AS (SELECT unnest({SC.GRID!r})::INT AS k), classes AS (SELECT unnest({CLASSES!r}) AS cls),
votes AS (SELECT k, nb.player, lab.level3 AS cls, sum(1.0 / greatest(nb.distance, 1e-9)) AS w FROM nb JOIN lab ON lab.player = nb.neighbour JOIN ks ON nb.rank <= ks.k GROUP BY k, nb.player, lab.level3),
total AS (SELECT k, player, sum(w) AS t FROM votes GROUP BY k, player),
sc AS (SELECT k, player, lab.level3 AS y_true, cls, round(coalesce(w, 0.0) / t, 9) AS p FROM total JOIN lab USING (player) CROSS JOIN classes LEFT JOIN votes USING (k, player, cls)),
pred AS (SELECT k, player, y_true, arg_min(cls, (-p, cls)) AS y_pred, max(p) AS confidence FROM sc GROUP BY k, player, y_true)"""


def _neighbour_scores(spark, sf, grid=None):
    e = P.game_features(fx.games(spark, sf))
    nb = R.knn_neighbours(R.weighted_vectors(R.similarity_profiles(K.game_levels(e, K.scaler_stats(e)))), max(grid or SC.GRID))
    lab = e.groupBy("player").agg(F.min_by("level3", "ingest_seq").alias("level3"))
    return SC.neighbour_scores(nb, lab, "level3", CLASSES, grid)


@register("m05_m06_neighbour_grid", f"""WITH {_GRID_SQL},
cell AS (SELECT k, cls, count_if(y_true = cls) AS s, count_if(y_pred = cls) AS q, count_if(y_true = cls AND y_pred = cls) AS tp FROM pred, classes GROUP BY k, cls),
f AS (SELECT k, sum(CASE WHEN s + q > 0 THEN 2.0 * tp / (s + q) * s ELSE 0.0 END) / sum(s) AS f1_weighted FROM cell GROUP BY k),
a AS (SELECT k, avg(CASE WHEN y_pred = y_true THEN 1.0 ELSE 0.0 END) AS accuracy, count(*) AS n FROM pred GROUP BY k)
SELECT k, n, round(accuracy, 8) AS accuracy, round(f1_weighted, 8) AS f1_weighted,
  row_number() OVER (ORDER BY round(f1_weighted, 8) DESC, k) = 1 AS best FROM a JOIN f USING (k)""")
def m05_grid(spark, sf):
    pred = SC.predicted(_neighbour_scores(spark, sf), ["k"]).checkpoint(eager=True)
    rows = []
    for k in SC.GRID:
        m = ST.classification_metrics(pred.filter(F.col("k") == k)).filter(F.col("metric").isin("accuracy", "f1_weighted"))
        rows.append(m.groupBy().agg(*[F.max(F.when(F.col("metric") == c, F.col("value"))).alias(c) for c in ("accuracy", "f1_weighted")]).withColumn("k", F.lit(k)))
    grid = rows[0]
    for r in rows[1:]:
        grid = grid.unionByName(r)
    grid = finalize(grid.join(pred.groupBy("k").agg(F.count(F.lit(1)).alias("n")), "k"))
    best = grid.agg(F.min_by("k", F.struct(-F.col("f1_weighted"), F.col("k"))).alias("b")).first()["b"]  # of five rows
    return grid.select("k", "n", "accuracy", "f1_weighted", (F.col("k") == F.lit(best)).alias("best"))


@register("m07_probabilistic_metrics", f"""WITH {_GRID_SQL},
c AS (SELECT k, cls, p, count_if(cls = y_true) AS pos, count_if(cls <> y_true) AS neg FROM sc GROUP BY k, cls, p),
b AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY k, cls ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM c),
auc AS (SELECT k, cls, sum(pos * (below + neg / 2)) / (sum(pos) * sum(neg)) AS value FROM b GROUP BY k, cls HAVING sum(pos) > 0 AND sum(neg) > 0)
SELECT k, 'log_loss' AS metric, 'all' AS cls, round(-avg(ln(greatest(p, 1e-15))), 8) AS value FROM sc WHERE cls = y_true GROUP BY k
UNION ALL SELECT k, 'roc_auc', cls, round(value, 8) FROM auc UNION ALL SELECT k, 'roc_auc_ovr', 'all', round(avg(value), 8) FROM auc GROUP BY k""")
def m07_probabilities(spark, sf):
    scores = _neighbour_scores(spark, sf).checkpoint(eager=True)
    return finalize(SC.probabilistic_metrics(scores, ["k"]))


@register("m07_m08_confusion", f"""WITH {_GRID_SQL},
p7 AS (SELECT * FROM pred WHERE k = 7), names AS (SELECT y_true AS cls FROM p7 UNION SELECT y_pred FROM p7), t AS (SELECT y_true, count(*) AS support FROM p7 GROUP BY y_true),
c AS (SELECT y_true, y_pred, count(*) AS n FROM p7 GROUP BY y_true, y_pred)
SELECT t.y_true, names.cls AS y_pred, coalesce(c.n, 0)::BIGINT AS n, round(coalesce(c.n, 0) / t.support, 8) AS share FROM t CROSS JOIN names LEFT JOIN c ON c.y_true = t.y_true AND c.y_pred = names.cls""")
def m07_confusion(spark, sf):
    return finalize(SC.confusion(SC.predicted(_neighbour_scores(spark, sf, [7]), ["k"]).checkpoint(eager=True)))


@register("m08_confident_errors", f"""WITH {_GRID_SQL},
u AS (SELECT player, avg(rating) AS rating, count(*) AS n_games FROM games GROUP BY player),
loo AS (SELECT avg(CASE WHEN y_pred = y_true THEN 1.0 ELSE 0.0 END) AS loo_accuracy FROM pred WHERE k = 7)
SELECT player, y_true, y_pred, confidence, round(rating, 8) AS rating, n_games, round(loo_accuracy, 8) AS loo_accuracy
FROM pred JOIN u USING (player), loo WHERE k = 7 AND y_pred <> y_true""")
def m08_confidence(spark, sf):
    pred = SC.predicted(_neighbour_scores(spark, sf, [7]), ["k"]).checkpoint(eager=True)
    u = fx.games(spark, sf).groupBy("player").agg(F.avg("rating").alias("rating"), F.count(F.lit(1)).alias("n_games"))
    out = attach_scalars(pred, pred.agg(F.avg(F.col("correct").cast("double")).alias("loo_accuracy")))
    out = out.filter(~F.col("correct")).join(u, "player")
    # shares of votes have 9 digits already
    return out.select("player", "y_true", "y_pred", "confidence", F.round("rating", 8).alias("rating"), "n_games", F.round("loo_accuracy", 8).alias("loo_accuracy"))
