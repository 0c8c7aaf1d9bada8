"""Registered queries of the fixed-centroid clustering operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import clusters as K
from ..operators import profiles as P
from ..sources import fixtures as fx
from .registry import finalize, register

_FEATS = K.FEATURES


def _z_sql(src_alias="o"):
    return ", ".join(f"(coalesce(CAST({src_alias}.{c} AS DOUBLE), 0.0) - m_{c}) / CASE WHEN s_{c} = 0 OR s_{c} IS NULL THEN 1.0 ELSE s_{c} END AS z_{c}"
                     for c in _FEATS)


_STATS_SQL = "st AS (SELECT " + ", ".join(
    [f"avg(coalesce(CAST({c} AS DOUBLE), 0.0)) AS m_{c}" for c in _FEATS]
    + [f"stddev_pop(coalesce(CAST({c} AS DOUBLE), 0.0)) AS s_{c}" for c in _FEATS]) + " FROM gx)"


def _d_sql():
    out = []
    for i, cen in enumerate(K.FIXED_CENTROIDS):
        out.append("(" + " + ".join(f"pow(z_{c} - ({float(v)}), 2)" for c, v in zip(_FEATS, cen)) + f") AS d{i}")
    return ", ".join(out)


_ASSIGN = ("CASE WHEN d0 = least(d0, d1, d2) THEN 0 WHEN d1 = least(d0, d1, d2) THEN 1 ELSE 2 END AS cluster_raw, "
           "sqrt(least(d0, d1, d2)) AS distance")

_OPEN_LEVELS_SQL = f"""{_STATS_SQL},
om AS (SELECT player, opening, color, count(game_id) AS n_games, avg(theory_depth) AS theory_mean, avg(acc_adj) AS acc_adj_mean,
   avg(score) AS win_rate, avg(theory_depth) AS theory_depth, avg(acl_w) AS acl_w, avg(prep_score) AS prep_score,
   avg(risk_index) AS risk_index FROM gx GROUP BY player, opening, color HAVING count(game_id) >= 2),
oz AS (SELECT o.*, {_z_sql('o')} FROM om o, st),
od AS (SELECT *, {_d_sql()} FROM oz),
oa AS (SELECT *, {_ASSIGN} FROM od),
cm AS (SELECT player, cluster_raw, row_number() OVER (PARTITION BY player ORDER BY avg(acl_w) ASC NULLS LAST, cluster_raw) - 1 AS rank
       FROM oa GROUP BY player, cluster_raw),
ol AS (SELECT oa.*, cm.rank, ['dominio', 'desarrollo', 'sin_base'][cm.rank + 1] AS level FROM oa LEFT JOIN cm USING (player, cluster_raw))"""


@register("m11_w10_opening_levels", f"""WITH {_OPEN_LEVELS_SQL}
SELECT player, opening, color, n_games, cluster_raw, round(distance, 8) AS distance, rank, level FROM ol""")
def m11(spark, sf):
    e = P.game_features(fx.games(spark, sf))
    ol = K.opening_levels(e, K.scaler_stats(e))
    return finalize(ol.select("player", "opening", "color", "n_games", "cluster_raw", "distance", "rank", "level"))


_GAME_LEVELS_SQL = f"""{_STATS_SQL},
gz AS (SELECT g.*, {_z_sql('g')} FROM gx g, st),
gd AS (SELECT *, {_d_sql()} FROM gz),
ga AS (SELECT *, {_ASSIGN} FROM gd),
gcm AS (SELECT cluster_raw, row_number() OVER (ORDER BY avg(acl_w) ASC NULLS LAST, cluster_raw) - 1 AS level_id FROM ga GROUP BY cluster_raw),
gl AS (SELECT ga.*, gcm.level_id FROM ga LEFT JOIN gcm USING (cluster_raw))"""


@register("m11_game_levels", f"""WITH {_GAME_LEVELS_SQL}
SELECT game_id, cluster_raw, round(distance, 8) AS distance, level_id FROM gl""")
def m11g(spark, sf):
    e = P.game_features(fx.games(spark, sf))
    return finalize(K.game_levels(e, K.scaler_stats(e)).select("game_id", "cluster_raw", "distance", "level_id"))


def _game_lv(spark, sf):
    e = P.game_features(fx.games(spark, sf))
    return K.game_levels(e, K.scaler_stats(e))


@register("a07_opening_level_profile", f"""WITH {_GAME_LEVELS_SQL},
p AS (SELECT player, avg(rating) AS rating, count(game_id) AS n_games, avg(CAST(level_id = 0 AS DOUBLE)) AS pct_solid,
  avg(CAST(level_id = 1 AS DOUBLE)) AS pct_medium, avg(CAST(level_id = 2 AS DOUBLE)) AS pct_weak, avg(theory_depth) AS avg_theory,
  avg(acl_w) AS avg_acl, avg(prep_score) AS avg_prep, avg(risk_index) AS avg_risk, avg(score) AS win_rate FROM gl GROUP BY player)
SELECT player, round(rating, 8) AS rating, n_games, round(pct_solid, 8) AS pct_solid, round(pct_medium, 8) AS pct_medium,
  round(pct_weak, 8) AS pct_weak, round(avg_theory, 8) AS avg_theory, round(avg_acl, 8) AS avg_acl, round(avg_prep, 8) AS avg_prep,
  round(avg_risk, 8) AS avg_risk, round(win_rate, 8) AS win_rate,
  CASE WHEN pct_solid >= pct_medium AND pct_solid >= pct_weak THEN 'apertura_solida' WHEN pct_medium >= pct_weak THEN 'apertura_media'
       ELSE 'apertura_debil' END AS dominant_cluster FROM p""")
def a07(spark, sf):
    return finalize(K.opening_level_profile(_game_lv(spark, sf)))


@register("a08_modal_cluster", f"""WITH {_GAME_LEVELS_SQL},
c AS (SELECT player, level_id, count(*) AS n FROM gl GROUP BY player, level_id),
r AS (SELECT *, row_number() OVER (PARTITION BY player ORDER BY n DESC, level_id) AS rn, sum(n) OVER (PARTITION BY player) AS t FROM c)
SELECT player, level_id AS mode, round(n / t, 8) AS mode_share FROM r WHERE rn = 1""")
def a08(spark, sf):
    return finalize(K.modal_cluster(_game_lv(spark, sf)))


@register("a33_cluster_profile", f"""WITH {_GAME_LEVELS_SQL}
SELECT level_id, count(*) AS n, """ + ", ".join(
    f"round(avg({c}), 8) AS mean_{c}, round(stddev_samp({c}), 8) AS std_{c}" for c in _FEATS + ["rating"])
    + ", round(avg(score), 8) AS win_rate FROM gl GROUP BY level_id")
def a33(spark, sf):
    return finalize(K.cluster_profile(_game_lv(spark, sf)))


@register("a36_opening_level_ranking", f"""WITH {_GAME_LEVELS_SQL}
SELECT opening, color, level_id, count(*) AS n, round(avg(acc), 8) AS acc_mean FROM gl GROUP BY opening, color, level_id""")
def a36(spark, sf):
    return finalize(K.opening_level_ranking(_game_lv(spark, sf)))


@register("a37_dominant_level", f"""WITH {_OPEN_LEVELS_SQL},
c AS (SELECT player, level, count(*) AS n FROM ol GROUP BY player, level),
m AS (SELECT player, level FROM (SELECT *, row_number() OVER (PARTITION BY player ORDER BY n DESC, level) AS rn FROM c) WHERE rn = 1),
pl AS (SELECT player, arg_min(rating, ingest_seq) AS rating FROM games GROUP BY player)
SELECT pl.player, pl.rating, coalesce(m.level, CASE WHEN rating >= 1800 THEN 'dominio' WHEN rating >= 1400 THEN 'desarrollo' ELSE 'sin_base' END)
  AS dominant_level FROM pl LEFT JOIN m USING (player)""")
def a37(spark, sf):
    e = P.game_features(fx.games(spark, sf))
    ol = K.opening_levels(e, K.scaler_stats(e))
    players = P.ordered_users(fx.games(spark, sf))
    return K.dominant_level(ol, players).select("player", "rating", "dominant_level")


@register("m10_davies_bouldin_fixed", f"""WITH {_GAME_LEVELS_SQL},
cen AS (SELECT level_id, {", ".join(f"avg(z_{c}) AS c_{c}" for c in _FEATS)} FROM gl GROUP BY level_id),
s AS (SELECT gl.level_id, avg(sqrt({" + ".join(f"pow(z_{c} - c_{c}, 2)" for c in _FEATS)})) AS s FROM gl JOIN cen USING (level_id) GROUP BY gl.level_id),
cs AS (SELECT * FROM cen JOIN s USING (level_id)),
r AS (SELECT a.level_id, max((a.s + b.s) / sqrt({" + ".join(f"pow(a.c_{c} - b.c_{c}, 2)" for c in _FEATS)})) AS rmax
      FROM cs a JOIN cs b ON a.level_id <> b.level_id GROUP BY a.level_id)
SELECT round(avg(rmax), 6) AS davies_bouldin FROM r""")
def m10db(spark, sf):
    lv = _game_lv(spark, sf)
    e = P.game_features(fx.games(spark, sf))
    z = K.scale(lv, K.FEATURES, K.scaler_stats(e))
    return K.davies_bouldin(z, "level_id").select(F.round("davies_bouldin", 6).alias("davies_bouldin"))


@register("m12_kruskal_wallis", f"""WITH {_GAME_LEVELS_SQL},
v AS (SELECT rating AS x, level_id AS g FROM gl),
per AS (SELECT x, count(*) AS t FROM v GROUP BY x),
pr AS (SELECT x, t, coalesce(sum(t) OVER (ORDER BY x ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + (t + 1) / 2.0 AS midrank FROM per),
rs AS (SELECT g, sum(midrank) AS rsum, count(*) AS ng FROM v JOIN pr USING (x) GROUP BY g),
tot AS (SELECT sum(t) AS ntot, sum(t * t * t - t) AS ties FROM per),
h AS (SELECT (12.0 / (ntot * (ntot + 1)) * sum(rsum * rsum / ng) - 3 * (ntot + 1)) / (1 - ties / (ntot * ntot * ntot - ntot)) AS hstat,
      count(*) AS k, ntot FROM rs, tot GROUP BY ntot, ties)
SELECT round(hstat, 6) AS H, k, CAST(ntot AS BIGINT) AS N, round(CASE WHEN k = 3 THEN exp(-hstat / 2) END, 8) AS p_value FROM h""")
def m12(spark, sf):
    r = K.kruskal_wallis(_game_lv(spark, sf), "rating", "level_id")
    return r.select(F.round("H", 6).alias("H"), "k", "N", F.round("p_value", 8).alias("p_value"))


@register("m16_feature_cluster_corr", f"""WITH {_GAME_LEVELS_SQL}
""" + " UNION ALL ".join(f"SELECT '{c}' AS feature, round(corr(CAST({c} AS DOUBLE), CAST(level_id AS DOUBLE)), 8) AS r FROM gl" for c in _FEATS))
def m16(spark, sf):
    return finalize(K.feature_cluster_corr(_game_lv(spark, sf)))
