"""Registered queries: scalar features, profiles and dashboards (games view)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalar as S
from ..operators import profiles as P
from ..sources import fixtures as fx
from .oracle_views import acc_sql, wins_sql
from .registry import finalize, register


# ---------------------------------------------------------------- P01-P13
@register("p01_accuracy", f"""
SELECT game_id, {acc_sql('acl', 2)} AS acc2, {acc_sql('acl', 1)} AS acc1 FROM games""")
def p01(spark, sf):
    g = fx.games(spark, sf)
    return finalize(g.select("game_id", S.accuracy("acl", 2).alias("acc2"), S.accuracy("acl", 1).alias("acc1")))


@register("p02_accuracy_steep", """
SELECT game_id, CASE WHEN acl IS NULL THEN NULL ELSE round_even(greatest(0.0, 103.1668 * exp(-0.04354 * acl) - 3.1669), 8) END AS acc_steep FROM games""")
def p02(spark, sf):
    g = fx.games(spark, sf)
    return finalize(g.select("game_id", S.accuracy("acl", 8, curve="steep").alias("acc_steep")))


@register("p03_winsorize", f"""
SELECT game_id, {wins_sql('acl')} AS acl_w FROM games""")
def p03(spark, sf):
    return finalize(fx.games(spark, sf).select("game_id", S.winsorize("acl").alias("acl_w")))


@register("p05_theory_norm", """
SELECT game_id, round(least(1.0, greatest(0.0, theory_depth / 15.0)), 8) AS tn_clip,
       round(theory_depth / 15.0, 8) AS tn_raw, round(ln(1 + theory_depth) / ln(16), 8) AS tn_log FROM games""")
def p05(spark, sf):
    t = F.col("theory_depth")
    return finalize(fx.games(spark, sf).select(
        "game_id", S.theory_norm(t).alias("tn_clip"), S.theory_norm(t, "raw").alias("tn_raw"),
        S.theory_norm(t, "log").alias("tn_log")))


@register("p06_p07_prep_risk", f"""
SELECT game_id, prep_score AS prep_app, risk_index AS risk_app,
       round(theory_norm * (acc_game / 100.0), 8) AS prep_aug,
       round(theory_norm * (100.0 - acc_game), 8) AS risk_aug FROM gx""")
def p06(spark, sf):
    g = P.game_features(fx.games(spark, sf))
    t = F.col("theory_depth")
    return finalize(g.select("game_id", F.col("prep_score").alias("prep_app"), F.col("risk_index").alias("risk_app"),
                             S.prep_score(t, F.col("acc_game"), "aug").alias("prep_aug"),
                             S.risk_index(t, F.col("acc_game"), "aug").alias("risk_aug")))


@register("p08_adjusted_accuracy", f"""
SELECT game_id, acc_adj AS acc_penalty,
       round_even(least(100.0, {acc_sql('acl', 1)} + ln(1 + theory_depth) / ln(16) * 15.0), 1) AS acc_bonus FROM gx""")
def p08(spark, sf):
    g = P.game_features(fx.games(spark, sf))
    return finalize(g.select("game_id", F.col("acc_adj").alias("acc_penalty"),
                             S.adjusted_accuracy("theory_depth", S.accuracy("acl", 1), "bonus").alias("acc_bonus")))


@register("p09_game_flags", """
SELECT game_id, is_theory_expert, is_feeling_natural, is_critical_point,
  coalesce(CAST(theory_depth >= 10 AND acc_game >= 65 AS INT), 0) AS aug_expert,
  coalesce(CAST(theory_depth < 7 AND acc_game >= 70 AS INT), 0) AS aug_feeling,
  coalesce(CAST(theory_depth >= 8 AND acc_game < 55 AS INT), 0) AS aug_critical FROM gx""")
def p09(spark, sf):
    g = P.game_features(fx.games(spark, sf))
    aug = S.flag_exprs_null_false(S.game_flags("theory_depth", F.col("acc_game"), "aug"))
    return g.select("game_id", "is_theory_expert", "is_feeling_natural", "is_critical_point",
                    aug["is_theory_expert"].alias("aug_expert"), aug["is_feeling_natural"].alias("aug_feeling"),
                    aug["is_critical_point"].alias("aug_critical"))


@register("p10_color_bin", """
SELECT game_id, CASE WHEN color = 'white' THEN 1 ELSE 0 END AS color_bin FROM games""")
def p10(spark, sf):
    return fx.games(spark, sf).select("game_id", S.color_bin("color").alias("color_bin"))


def _right_closed_sql(x, bins, labels):
    parts = [f"WHEN {x} > {lo} AND {x} <= {hi} THEN '{lab}'" for lo, hi, lab in zip(bins[:-1], bins[1:], labels)]
    return "CASE " + " ".join(parts) + " END"


@register("p11_rating_bins", f"""
SELECT game_id, {_right_closed_sql('rating', S.BINS_9, S.LABELS_9)} AS level9,
       {_right_closed_sql('rating', S.BINS_4, S.LABELS_4)} AS level4,
       {_right_closed_sql('rating', S.BINS_9, S.AUDIT_LABELS)} AS audit_band FROM games""")
def p11(spark, sf):
    g = fx.games(spark, sf)
    return g.select("game_id", S.bin_right_closed("rating", S.BINS_9, S.LABELS_9).alias("level9"),
                    S.bin_right_closed("rating", S.BINS_4, S.LABELS_4).alias("level4"),
                    S.bin_right_closed("rating", S.BINS_9, S.AUDIT_LABELS).alias("audit_band"))


@register("p12_p13_level", f"""
SELECT game_id, level3, round(level_num, 8) AS level_num,
  CASE {_right_closed_sql('rating', S.BINS_4, S.LABELS_4)} WHEN 'beginner' THEN 0 WHEN 'intermediate' THEN 1
       WHEN 'advanced' THEN 2 WHEN 'expert' THEN 3 END AS level4_ord FROM gx""")
def p12(spark, sf):
    g = P.game_features(fx.games(spark, sf))
    return finalize(g.select("game_id", "level3", "level_num",
                             S.level_ordinal(S.bin_right_closed("rating", S.BINS_4, S.LABELS_4)).alias("level4_ord")))


# ---------------------------------------------------------------- A01 / A02 / W08
_A01_SQL = f"""
d AS (SELECT player, opening, color, avg(theory_depth) AS avg_theory, avg({wins_sql('acl')}) AS avg_acl,
             count(game_id) AS n_games, avg(score) AS win_rate FROM games GROUP BY player, opening, color),
d2 AS (SELECT *, {acc_sql('avg_acl', 1)} AS accuracy FROM d),
dash AS (SELECT *, avg_theory / 15 * (accuracy / 100) AS score_prep, avg_theory / 15 * (100 - accuracy) AS risk_index,
         CASE WHEN avg_theory < 7 AND accuracy >= 65 AND n_games >= 2 THEN accuracy ELSE 0.0 END AS score_feeling FROM d2)"""


@register("s01_a01_opening_dashboard", f"""WITH {_A01_SQL}
SELECT player, opening, color, round(avg_theory, 8) AS avg_theory, round(avg_acl, 8) AS avg_acl, n_games,
       round(win_rate, 8) AS win_rate, accuracy, round(score_prep, 8) AS score_prep, round(risk_index, 8) AS risk_index,
       score_feeling FROM dash""")
def a01(spark, sf):
    return finalize(P.opening_dashboard(fx.games(spark, sf)))


_W08_SQL = f"""WITH {_A01_SQL},
risk AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY player, color ORDER BY risk_index DESC NULLS LAST, opening) AS rank FROM dash) WHERE rank <= 3),
mast AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY player, color ORDER BY score_prep DESC NULLS LAST, opening) AS rank
         FROM dash d WHERE n_games >= 3 AND NOT EXISTS (SELECT 1 FROM risk r WHERE r.player = d.player AND r.color = d.color AND r.opening = d.opening)) WHERE rank <= 3),
feel AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY player, color ORDER BY score_feeling DESC NULLS LAST, opening) AS rank FROM dash WHERE score_feeling > 0) WHERE rank <= 3),
allc AS (SELECT *, 'risk' AS category FROM risk UNION ALL SELECT *, 'mastery' FROM mast UNION ALL SELECT *, 'feeling' FROM feel)
SELECT player, color, opening, accuracy, round(avg_theory, 8) AS avg_theory, n_games, round(win_rate, 8) AS win_rate,
       rank, category FROM allc"""


@register("w08_dashboard_categories", _W08_SQL)
def w08(spark, sf):
    return finalize(P.dashboard_categories(P.opening_dashboard(fx.games(spark, sf))))


_A02_SQL = f"""
d AS (SELECT player, opening, color, avg(theory_depth) AS avg_theory, avg({wins_sql('acl')}) AS avg_acl,
             count(game_id) AS n_games, avg(score) AS win_rate FROM games GROUP BY player, opening, color),
d2 AS (SELECT *, {acc_sql('avg_acl', 2)} AS accuracy FROM d),
d3 AS (SELECT *, avg_theory / 15 * (accuracy / 100) AS score_prep, avg_theory / 15 * (100 - accuracy) AS risk_index FROM d2),
st AS (SELECT player, avg(accuracy) AS acc_mean, avg(avg_theory) AS theory_mean,
              quantile_cont(risk_index, 0.6) AS risk_p60, quantile_cont(score_prep, 0.5) AS prep_p50 FROM d3 GROUP BY player),
rel AS (SELECT d3.*,
  coalesce(risk_index > greatest(risk_p60, 8.0) AND accuracy < acc_mean - 10, false) AS is_risk,
  coalesce(score_prep >= prep_p50 AND accuracy >= acc_mean - 5 AND n_games >= 2, false) AS is_mastery,
  CASE WHEN coalesce(avg_theory <= greatest(theory_mean * 0.8, 5.0) AND accuracy >= acc_mean - 8 AND n_games >= 2, false)
       THEN accuracy ELSE 0.0 END AS score_feeling
  FROM d3 LEFT JOIN st USING (player))"""


@register("a02_relative_dashboard", f"""WITH {_A02_SQL}
SELECT player, opening, color, round(avg_theory, 8) AS avg_theory, round(avg_acl, 8) AS avg_acl, n_games,
       round(win_rate, 8) AS win_rate, accuracy, round(score_prep, 8) AS score_prep, round(risk_index, 8) AS risk_index,
       is_risk, is_mastery, score_feeling FROM rel""")
def a02(spark, sf):
    return finalize(P.relative_dashboard(fx.games(spark, sf)))


@register("w08_dashboard_categories_app", f"""WITH {_A02_SQL},
risk AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY player, color ORDER BY risk_index DESC NULLS LAST, opening) AS rank FROM rel WHERE is_risk) WHERE rank <= 4),
mast AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY player, color ORDER BY score_prep DESC NULLS LAST, opening) AS rank
         FROM rel d WHERE is_mastery AND NOT EXISTS (SELECT 1 FROM risk r WHERE r.player = d.player AND r.color = d.color AND r.opening = d.opening)) WHERE rank <= 4),
feel AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY player, color ORDER BY score_feeling DESC NULLS LAST, opening) AS rank FROM rel WHERE score_feeling > 0) WHERE rank <= 4),
allc AS (SELECT *, 'risk' AS category FROM risk UNION ALL SELECT *, 'mastery' FROM mast UNION ALL SELECT *, 'feeling' FROM feel)
SELECT player, color, opening, accuracy, round(avg_theory, 8) AS avg_theory, n_games, round(win_rate, 8) AS win_rate,
       rank, category FROM allc""")
def w08_app(spark, sf):
    return finalize(P.dashboard_categories(P.relative_dashboard(fx.games(spark, sf)), variant="app"))


@register("a34_dashboard_kpis", f"""WITH {_A02_SQL}
SELECT player, round(avg(accuracy), 8) AS acc_mean, round(avg(avg_theory), 8) AS theory_mean,
       round(avg(win_rate), 8) AS win_rate_mean, count(*) AS n_lines FROM rel GROUP BY player""")
def a34(spark, sf):
    return finalize(P.dashboard_kpis(P.relative_dashboard(fx.games(spark, sf))))


# ---------------------------------------------------------------- A03 / A04 / J01 / P26
@register("a03_user_context_raw", f"""
WITH u AS (SELECT player, avg(acl) AS avg_acl_user, coalesce(stddev_samp(acl), 0.0) AS std_acl_user,
  avg(theory_depth) AS avg_theory_user, avg(score) AS win_rate_user, count(game_id) AS n_games_user,
  arg_min(rating, CASE WHEN rating IS NOT NULL THEN ingest_seq END) AS rating_ref FROM games GROUP BY player)
SELECT player, round(avg_acl_user, 8) AS avg_acl_user, round(std_acl_user, 8) AS std_acl_user,
  round(avg_theory_user, 8) AS avg_theory_user, round(win_rate_user, 8) AS win_rate_user, n_games_user, rating_ref,
  {acc_sql('avg_acl_user', 2)} AS accuracy_user,
  round(CASE WHEN avg_acl_user > 0 THEN 1 - least(1.0, greatest(0.0, std_acl_user / (avg_acl_user + 1e-9))) ELSE 0.0 END, 8)
    AS consistency_score FROM u""")
def a03(spark, sf):
    return finalize(P.user_context(fx.games(spark, sf), "raw"))


_A04_SQL = """
u AS (SELECT player, avg(score) AS win_rate_user, avg(theory_depth) AS avg_theory_user, avg(acl_w) AS avg_acl_user,
  coalesce(stddev_samp(acl_w), 0.0) AS std_acl_user, count(game_id) AS n_games_user, avg(acc_game) AS accuracy_user
  FROM gx GROUP BY player),
uc AS (SELECT *, 1 - least(1.0, greatest(0.0, std_acl_user / (avg_acl_user + 1e-9))) AS consistency_score FROM u),
ex AS (SELECT gx.*, uc.* EXCLUDE (player), round_even(acl_w - avg_acl_user, 2) AS delta_acl_vs_user
       FROM gx LEFT JOIN uc USING (player))"""


@register("a04_user_context", f"""WITH {_A04_SQL}
SELECT player, round(win_rate_user, 8) AS win_rate_user, round(avg_theory_user, 8) AS avg_theory_user,
  round(avg_acl_user, 8) AS avg_acl_user, round(std_acl_user, 8) AS std_acl_user, n_games_user,
  round(accuracy_user, 8) AS accuracy_user, round(consistency_score, 8) AS consistency_score FROM uc""")
def a04(spark, sf):
    return finalize(P.user_context(fx.games(spark, sf)))


@register("j01_p26_enriched_games", f"""WITH {_A04_SQL}
SELECT game_id, player, acc, acl_w, acc_game, acc_adj, round(avg_acl_user, 8) AS avg_acl_user,
  round(consistency_score, 8) AS consistency_score, delta_acl_vs_user, level3 FROM ex""")
def j01(spark, sf):
    e = P.enrich_games(fx.games(spark, sf))
    return finalize(e.select("game_id", "player", "acc", "acl_w", "acc_game", "acc_adj", "avg_acl_user",
                             "consistency_score", "delta_acl_vs_user", "level3"))


@register("a06_user_dataset", f"""WITH {_A04_SQL}
SELECT player, arg_min(rating, ingest_seq) AS rating, arg_min(level3, ingest_seq) AS level3,
  round(avg(score), 8) AS win_rate, round(avg(theory_depth), 8) AS avg_theory, round(avg(acl_w), 8) AS avg_acl,
  round(coalesce(stddev_samp(acl_w), 0.0), 8) AS std_acl, count(game_id) AS n_games,
  round(avg(prep_score), 8) AS avg_prep, round(avg(risk_index), 8) AS avg_risk,
  round(avg(is_theory_expert), 8) AS pct_theory_exp, round(avg(is_feeling_natural), 8) AS pct_feeling_nat,
  round(avg(is_critical_point), 8) AS pct_critical, round(arg_min(consistency_score, ingest_seq), 8) AS consistency
FROM ex GROUP BY player""")
def a06(spark, sf):
    return finalize(P.user_dataset(fx.games(spark, sf)))


# ---------------------------------------------------------------- A10 / A11 / J03 / P14
def _rule_group_sql(x):
    return (f"CASE WHEN {x} >= 0 AND {x} <= 1399 THEN 'principiante' WHEN {x} >= 1400 AND {x} <= 1999 THEN 'intermedio' "
            f"WHEN {x} >= 2000 AND {x} <= 9999 THEN 'avanzado' ELSE 'avanzado' END")


_A10_SQL = f"""
ag AS (SELECT player, opening, color, count(game_id) AS n_games, avg(rating) AS rating, avg(theory_depth) AS theory_mean,
  stddev_samp(theory_depth) AS theory_std, avg(acl) AS acl_mean, stddev_samp(acl) AS acl_std,
  avg({acc_sql('acl', 1)}) AS accuracy_pct, avg(score) AS win_rate, quantile_cont(acl, 0.25) AS acl_p25,
  quantile_cont(acl, 0.75) AS acl_p75 FROM games GROUP BY player, opening, color),
tot AS (SELECT player, count(game_id) AS total_user_games FROM games GROUP BY player),
prof AS (SELECT ag.*, total_user_games, n_games / total_user_games AS vol_rel,
  1 - least(1.0, greatest(0.0, acl_std / (acl_mean + 1e-6))) AS consistency,
  theory_mean - accuracy_pct / 10 AS theory_acc_gap, {_rule_group_sql('rating')} AS "group",
  CASE WHEN color = 'white' THEN 1 ELSE 0 END AS color_enc FROM ag JOIN tot USING (player)),
dim AS (SELECT * FROM (VALUES ('principiante', 55.0, 65.0, 4.0, 9.0, 'beginner'), ('intermedio', 63.0, 74.0, 5.0, 11.0, 'intermediate'),
   ('avanzado', 72.0, 82.0, 7.0, 13.0, 'advanced')) t("group", acc_low, acc_high, teo_low, teo_high, label_tier)),
lab AS (SELECT prof.*, dim.label_tier, CASE WHEN n_games < 5 THEN 'VOLUMEN_BAJO'
   WHEN coalesce(theory_mean <= teo_low AND accuracy_pct >= acc_high, false) THEN 'EXITO_NATURAL'
   WHEN coalesce(theory_mean >= teo_high AND accuracy_pct >= acc_high, false) THEN 'DOMINIO'
   WHEN coalesce(theory_mean >= teo_high AND accuracy_pct < acc_low, false) THEN 'TEORIA_VACIA'
   WHEN coalesce(vol_rel >= 0.15 AND accuracy_pct < acc_low, false) THEN 'PUNTO_CRITICO' ELSE 'NEUTRO' END AS label
   FROM prof LEFT JOIN dim USING ("group")),
labp AS (SELECT *, CASE label WHEN 'PUNTO_CRITICO' THEN 1 WHEN 'TEORIA_VACIA' THEN 2 WHEN 'NEUTRO' THEN 3
   WHEN 'EXITO_NATURAL' THEN 4 WHEN 'DOMINIO' THEN 5 ELSE 99 END AS label_priority FROM lab)"""

_A10_COLS = ("player, opening, color, n_games, round(rating, 8) AS rating, round(theory_mean, 8) AS theory_mean, "
             "round(theory_std, 8) AS theory_std, round(acl_mean, 8) AS acl_mean, round(acl_std, 8) AS acl_std, "
             "round(accuracy_pct, 8) AS accuracy_pct, round(win_rate, 8) AS win_rate, round(acl_p25, 8) AS acl_p25, "
             "round(acl_p75, 8) AS acl_p75, total_user_games, round(vol_rel, 8) AS vol_rel, "
             "round(consistency, 8) AS consistency, round(theory_acc_gap, 8) AS theory_acc_gap, \"group\", color_enc")


@register("a10_j03_label_profile", f"WITH {_A10_SQL} SELECT {_A10_COLS} FROM prof")
def a10(spark, sf):
    return finalize(P.label_profile(fx.games(spark, sf)))


@register("a11_j11_p14_opening_labels", f"WITH {_A10_SQL} SELECT player, opening, color, \"group\", label_tier, label, "
                                     "label_priority FROM labp")
def a11(spark, sf):
    lab = P.label_openings(P.label_profile(fx.games(spark, sf)))
    return lab.select("player", "opening", "color", "group", "label_tier", "label", "label_priority")


@register("a31_j04_min_volume", """
WITH ok AS (SELECT player FROM games GROUP BY player HAVING count(game_id) >= 10),
op AS (SELECT player, opening, color FROM games GROUP BY player, opening, color HAVING count(game_id) >= 5)
SELECT g.player, g.opening, g.color, count(*) AS n_games FROM games g
WHERE g.player IN (SELECT player FROM ok) AND EXISTS (SELECT 1 FROM op WHERE op.player = g.player AND op.opening = g.opening AND op.color = g.color)
GROUP BY g.player, g.opening, g.color""")
def a31(spark, sf):
    g = fx.games(spark, sf)
    g = P.min_volume(g, ["player"], 10)
    g = P.min_volume(g, ["player", "opening", "color"], 5)
    return g.groupBy("player", "opening", "color").agg(F.count(F.lit(1)).alias("n_games"))


@register("a35_ordered_users", """
SELECT player, arg_min(rating, ingest_seq) AS rating FROM games GROUP BY player""")
def a35(spark, sf):
    return P.ordered_users(fx.games(spark, sf))
