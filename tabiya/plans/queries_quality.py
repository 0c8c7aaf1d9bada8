"""Registered queries: audits, quality checks, loads, appends, splits (games view)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalar as S
from ..operators import profiles as P
from ..operators import quality as QY
from ..operators import stats as ST
from ..sources import fixtures as fx
from ..sources import io
from .oracle_views import acc_sql
from .queries_core import _right_closed_sql
from .registry import finalize, register

_BAND = _right_closed_sql("rating", S.BINS_9, S.AUDIT_LABELS)


@register("a12_audit_by_band", f"""
WITH b AS (SELECT *, {_BAND} AS band FROM games),
d AS (SELECT band, count(DISTINCT player) AS users, count(game_id) AS games, round_even(avg(theory_depth), 1) AS theory_mean,
  avg(acl) AS avg_acl, avg(score) AS win_rate FROM b WHERE band IS NOT NULL GROUP BY band),
m AS (SELECT quantile_cont(acl, 0.5) AS global_median_acl FROM games)
SELECT band, users, games, theory_mean, round(avg_acl, 8) AS avg_acl, round(win_rate, 8) AS win_rate, {acc_sql('avg_acl', 1)} AS accuracy,
  round_even(win_rate * 100, 1) AS win_pct, users < 2 AS few_users, round(global_median_acl, 8) AS global_median_acl FROM d, m""")
def a12(spark, sf):
    return finalize(QY.audit_by_band(fx.games(spark, sf)))


@register("a13_l02_top_contributors", """
SELECT player, rating, count(game_id) AS n_games, round(avg(theory_depth), 8) AS theory_mean FROM games
GROUP BY player, rating ORDER BY n_games DESC, player, rating LIMIT 5""")
def a13(spark, sf):
    return finalize(QY.top_contributors(fx.games(spark, sf)))


_A14_CLASS = _right_closed_sql("rating", S.BINS_4, S.LABELS_4)


@register("a14_class_distribution", f"""
WITH e AS (SELECT *, {_A14_CLASS} AS level4 FROM gx),
d AS (SELECT level4, count(DISTINCT player) AS users, count(game_id) AS games, round_even(avg(acc_game), 1) AS acc_mean,
  round_even(avg(theory_depth), 1) AS theory_mean, round_even(avg(score) * 100, 1) AS win_pct FROM e WHERE level4 IS NOT NULL GROUP BY level4),
r AS (SELECT max(games) / greatest(min(games), 1) AS imbalance_ratio FROM d)
SELECT d.*, round(imbalance_ratio, 8) AS imbalance_ratio, imbalance_ratio > 3 AS imbalance_alert,
  CASE level4 WHEN 'beginner' THEN 0 WHEN 'intermediate' THEN 1 WHEN 'advanced' THEN 2 WHEN 'expert' THEN 3 END AS class_order FROM d, r""")
def a14(spark, sf):
    return finalize(QY.class_distribution(P.game_features(fx.games(spark, sf))))


@register("a27_feature_range_check", " UNION ALL ".join(
    f"SELECT '{c}' AS feature, round(avg({c}), 8) AS mean, round(CAST(max({c}) AS DOUBLE), 8) AS max, CAST({float(lo)} AS DOUBLE) AS lo, CAST({float(hi)} AS DOUBLE) AS hi, "
    f"avg({c}) >= {lo} AND avg({c}) <= {hi} AS in_range FROM gx" for c, lo, hi in QY.EXPECTED_MEAN_RANGES))
def a27(spark, sf):
    return finalize(QY.feature_range_check(P.game_features(fx.games(spark, sf))))


@register("a28_integrity_checks", """
SELECT 'dup_opening_title' AS check_name, CAST(count(*) AS BIGINT) AS n FROM (SELECT title FROM catalog GROUP BY title HAVING count(*) > 1)
UNION ALL SELECT 'train_test_overlap', count(*) FROM (
  SELECT player FROM games WHERE (player * 7919 + 42) % 100 < 80 INTERSECT SELECT player FROM games WHERE (player * 7919 + 42) % 100 >= 80)
UNION ALL SELECT 'dup_game_id', count(*) FROM (SELECT game_id FROM games GROUP BY game_id HAVING count(*) > 1)""")
def a28(spark, sf):
    g = ST.group_split(fx.games(spark, sf), method="modulus")
    cat = fx.catalog(spark, sf)
    d1 = QY.duplicate_keys(cat, "title").agg(F.count(F.lit(1)).alias("n")).select(F.lit("dup_opening_title").alias("check_name"), "n")
    ov = (g.filter("is_train").select("player").intersect(g.filter("NOT is_train").select("player"))
           .agg(F.count(F.lit(1)).alias("n")).select(F.lit("train_test_overlap").alias("check_name"), "n"))
    d2 = QY.duplicate_keys(fx.games(spark, sf), "game_id").agg(F.count(F.lit(1)).alias("n")).select(
        F.lit("dup_game_id").alias("check_name"), "n")
    return d1.unionByName(ov).unionByName(d2)


@register("a32_flag_overlap", """
SELECT is_theory_expert + is_feeling_natural + is_critical_point AS n_flags, count(*) AS n_games FROM gx GROUP BY 1""")
def a32(spark, sf):
    return QY.flag_overlap(P.game_features(fx.games(spark, sf)))


@register("p27_s02_modelled_games", """SELECT game_id, acl FROM games WHERE acl IS NOT NULL AND acl > 0""")
def p27(spark, sf):
    return fx.games(spark, sf).select("game_id", "acl").filter(F.col("acl").isNotNull() & (F.col("acl") > 0))


@register("s03_w13_validated_load", """
WITH d AS (SELECT * FROM games WHERE game_id IS NOT NULL AND rating IS NOT NULL AND acl IS NOT NULL),
f AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY game_id ORDER BY ingest_seq) AS rn FROM d) WHERE rn = 1)
SELECT game_id, player, CAST(rating AS INT) AS rating, opening, color, theory_depth, TRY_CAST(CAST(acl AS VARCHAR) AS DOUBLE) AS acl, score
FROM f WHERE TRY_CAST(CAST(acl AS VARCHAR) AS DOUBLE) IS NOT NULL""")
def s03(spark, sf):
    # the load is checked on the union of the table with a re-delivery of its
    # even ids, so the keep-first dedupe has duplicates to remove
    g = fx.games(spark, sf)
    redelivered = g.filter(F.col("game_id") % 2 == 0).withColumn("ingest_seq", F.col("ingest_seq") + 10 ** 9)
    d = io.validated_load(g.unionByName(redelivered))
    return d.select("game_id", "player", "rating", "opening", "color", "theory_depth", "acl", "score")


@register("s11_j05_incremental_append", """
SELECT game_id, player, opening FROM games""")
def s11(spark, sf):
    g = fx.games(spark, sf).select("game_id", "player", "opening", "ingest_seq")
    old = g.filter(F.col("game_id") % 3 != 0)
    batch = g.filter(F.col("game_id") % 3 != 1)  # overlaps the known ids
    once = io.incremental_append(batch, old)
    twice = io.incremental_append(batch, once)  # idempotent
    return twice.select("game_id", "player", "opening")


@register("s14_newest_per_player", """
SELECT game_id, player FROM (SELECT *, row_number() OVER (PARTITION BY player ORDER BY played_at DESC, game_id DESC) AS rn FROM games) WHERE rn <= 200""")
def s14(spark, sf):
    return io.newest_per_player(fx.games(spark, sf), 200).select("game_id", "player")


@register("m01_group_split", """
SELECT player, (player * 7919 + 42) % 100 < 80 AS is_train, count(*) AS n_games FROM games GROUP BY player, 2""")
def m01(spark, sf):
    g = ST.group_split(fx.games(spark, sf), method="modulus")
    return g.groupBy("player", "is_train").agg(F.count(F.lit(1)).alias("n_games"))


@register("m02_stratified_group_folds", """
WITH u AS (SELECT player, arg_min(level3, ingest_seq) AS level3, count(*) AS n_games FROM gx GROUP BY player),
r AS (SELECT *, row_number() OVER (PARTITION BY level3 ORDER BY n_games DESC, player) - 1 AS p FROM u)
SELECT player, level3, n_games, CAST(CASE WHEN p % 10 < 5 THEN p % 10 ELSE 9 - p % 10 END AS INT) AS fold FROM r""")
def m02(spark, sf):
    g = P.game_features(fx.games(spark, sf))
    u = g.groupBy("player").agg(F.min_by("level3", "ingest_seq").alias("level3"), F.count(F.lit(1)).alias("n_games"))
    return ST.snake_folds(u, "level3", "n_games", 5).select("player", "level3", "n_games", "fold")


@register("m03_balanced_class_weights", """
WITH u AS (SELECT player, arg_min(level3, ingest_seq) AS level3 FROM gx GROUP BY player),
c AS (SELECT level3, count(*) AS nc FROM u GROUP BY level3)
SELECT level3, round((SELECT count(*) FROM u) / ((SELECT count(*) FROM c) * nc), 8) AS class_weight FROM c""")
def m03(spark, sf):
    g = P.game_features(fx.games(spark, sf))
    u = g.groupBy("player").agg(F.min_by("level3", "ingest_seq").alias("level3"))
    return finalize(ST.balanced_weights(u, "level3").select("level3", "class_weight").distinct())


@register("a05_leakage_free_features", """
WITH g AS (SELECT *, (player * 7919 + 42) % 100 < 80 AS is_train FROM gx),
s AS (SELECT player, avg(score) AS win_rate_user, avg(theory_depth) AS avg_theory_user, avg(acl_w) AS avg_acl_user,
   coalesce(stddev_samp(acl_w), 0.0) AS std_acl_user, CAST(count(game_id) AS DOUBLE) AS n_games_user FROM g WHERE is_train GROUP BY player),
m AS (SELECT quantile_cont(win_rate_user, 0.5) AS m1, quantile_cont(avg_theory_user, 0.5) AS m2, quantile_cont(avg_acl_user, 0.5) AS m3,
   quantile_cont(std_acl_user, 0.5) AS m4, quantile_cont(n_games_user, 0.5) AS m5 FROM s),
u AS (SELECT DISTINCT player, is_train FROM g)
SELECT u.player, u.is_train, round(coalesce(win_rate_user, m1), 8) AS win_rate_user, round(coalesce(avg_theory_user, m2), 8) AS avg_theory_user,
  round(coalesce(avg_acl_user, m3), 8) AS avg_acl_user, round(coalesce(std_acl_user, m4), 8) AS std_acl_user,
  round(coalesce(n_games_user, m5), 8) AS n_games_user FROM u LEFT JOIN s USING (player), m""")
def a05(spark, sf):
    g = P.game_features(fx.games(spark, sf))
    split = ST.group_split(g.select("player"), method="modulus")
    return finalize(ST.leakage_free_user_features(g, split))


_A05_SQL = """
WITH g AS (SELECT *, (player * 7919 + 42) % 100 < 80 AS is_train FROM gx),
s AS (SELECT player, avg(score) AS win_rate_user, avg(theory_depth) AS avg_theory_user, avg(acl_w) AS avg_acl_user,
   coalesce(stddev_samp(acl_w), 0.0) AS std_acl_user, CAST(count(game_id) AS DOUBLE) AS n_games_user FROM g WHERE is_train GROUP BY player),
m AS (SELECT quantile_cont(win_rate_user, 0.5) AS m1, quantile_cont(avg_theory_user, 0.5) AS m2, quantile_cont(avg_acl_user, 0.5) AS m3,
   quantile_cont(std_acl_user, 0.5) AS m4, quantile_cont(n_games_user, 0.5) AS m5 FROM s),
u AS (SELECT DISTINCT player, is_train FROM g)
SELECT u.player, u.is_train, round(coalesce(win_rate_user, m1), 8) AS win_rate_user, round(coalesce(avg_theory_user, m2), 8) AS avg_theory_user,
  round(coalesce(avg_acl_user, m3), 8) AS avg_acl_user, round(coalesce(std_acl_user, m4), 8) AS std_acl_user,
  round(coalesce(n_games_user, m5), 8) AS n_games_user FROM u LEFT JOIN s USING (player), m"""


@register("j02_join_regenerated_columns", f"""
SELECT g.game_id, g.player, u.is_train, u.win_rate_user, u.avg_acl_user, round(g.acl_w - u.avg_acl_user, 8) AS acl_vs_user
FROM gx g JOIN ({_A05_SQL}) u USING (player)""")
def j02(spark, sf):
    # the enriched games hold user columns of all games: they go, and come back from the training games by an inner join
    e = P.enrich_games(fx.games(spark, sf))
    split = ST.group_split(e.select("player"), method="modulus")
    own = ST.leakage_free_user_features(P.game_features(fx.games(spark, sf)), split)
    d = e.drop(*[c for c in own.columns if c != "player"]).join(own, "player")
    d = d.withColumn("acl_vs_user", F.col("acl_w") - F.col("avg_acl_user"))
    return finalize(d.select("game_id", "player", "is_train", "win_rate_user", "avg_acl_user", "acl_vs_user"))
