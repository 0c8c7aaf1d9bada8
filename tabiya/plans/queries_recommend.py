"""Registered queries of the bridge and the recommenders."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import bridge as B
from ..operators import clusters as K
from ..operators import profiles as P
from ..operators import recommend as R
from ..sources import fixtures as fx
from . import sqltext as Q
from .queries_ml import _GAME_LEVELS_SQL
from .registry import finalize, register


def _syn_sql(variant="pipeline"):
    rows = ", ".join(f"({i}, {Q.q(k)}, {j}, {Q.q(t)})" for i, k, j, t in X.synonym_dim_rows(variant))
    return f"syn AS (SELECT * FROM (VALUES {rows}) v(key_order, syn_key, term_order, term))"


def _terms_sql(names_cte: str) -> str:
    return f"""
allt AS (SELECT opening, ap AS term, -1 AS key_order, 0 AS term_order FROM {names_cte}
         UNION ALL SELECT opening, syn.term, key_order, term_order FROM {names_cte} JOIN syn ON instr(ap, syn_key) > 0 OR instr(syn_key, ap) > 0),
tt AS (SELECT opening, term, key_order, term_order FROM (SELECT *, row_number() OVER (PARTITION BY opening, term ORDER BY key_order, term_order) AS rn FROM allt) WHERE rn = 1)"""


@register("t25_synonym_terms", f"""WITH {_syn_sql()},
names AS (SELECT DISTINCT opening, lower(trim(opening)) AS ap FROM games WHERE opening IS NOT NULL), {_terms_sql('names')}
SELECT * FROM tt""")
def t25(spark, sf):
    return B.synonym_terms(fx.games(spark, sf).select("opening"))


@register("t26_j08_opening_resource_bridge", f"""WITH {_syn_sql('app')},
names AS (SELECT DISTINCT opening, lower(trim(opening)) AS ap FROM games WHERE opening IS NOT NULL), {_terms_sql('names')},
tx AS (SELECT resource_id, lower(openings) AS t FROM catalog WHERE openings IS NOT NULL UNION ALL SELECT resource_id, lower(title) FROM catalog WHERE title IS NOT NULL)
SELECT DISTINCT tt.opening, tx.resource_id FROM tt JOIN tx ON instr(tx.t, tt.term) > 0
WHERE tt.term NOT IN ({', '.join(Q.q(w) for w in X.WORD_TERMS)}) OR regexp_matches(tx.t, '(^|[^a-z])' || tt.term || '([^a-z]|$)')""")
def t26(spark, sf):
    terms = B.synonym_terms(fx.games(spark, sf).select("opening"), "app")
    return B.match_bridge(terms, fx.catalog(spark, sf), ["openings", "title"], X.WORD_TERMS)


def _search_sql(keys_cte: str, n: int = 3) -> str:
    """R01 over a CTE ``keys_cte`` (opening, r_lo, r_hi); defines ``ans``."""
    return f"""{_syn_sql()},
names AS (SELECT DISTINCT opening, lower(trim(opening)) AS ap FROM {keys_cte}), {_terms_sql('names')},
br AS (SELECT DISTINCT tt.opening, c.resource_id FROM tt JOIN catalog c ON instr(lower(c.openings), tt.term) > 0),
cand AS (SELECT k.opening, k.r_lo, k.r_hi, c.* EXCLUDE (openings) FROM {keys_cte} k JOIN br USING (opening) JOIN catalog c USING (resource_id)
         WHERE coalesce(c.level_min, 0) <= k.r_lo AND coalesce(c.level_max, 9999) >= k.r_hi),
hits AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY opening, r_lo, r_hi ORDER BY rating_score DESC NULLS LAST,
         is_free ASC NULLS LAST, resource_id) AS rank FROM cand) WHERE rank <= {n}),
miss AS (SELECT *, CASE WHEN r_lo >= 2000 THEN 'expert' WHEN r_lo >= 1200 THEN 'intermediate' ELSE 'beginner' END AS tier
         FROM {keys_cte} k WHERE NOT EXISTS (SELECT 1 FROM hits h WHERE h.opening = k.opening AND h.r_lo = k.r_lo AND h.r_hi = k.r_hi)),
ttop AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY level_tier ORDER BY resource_id) AS rank FROM catalog WHERE course_type = 'opening') WHERE rank <= {n}),
ans AS (SELECT opening, r_lo, r_hi, rank, 'match' AS match_kind, resource_id, title, source, level_tier, is_free, course_type FROM hits
  UNION ALL SELECT m.opening, m.r_lo, m.r_hi, t.rank, 'tier_fallback', t.resource_id, t.title, t.source, t.level_tier, t.is_free, t.course_type
            FROM miss m JOIN ttop t ON t.level_tier = m.tier
  UNION ALL SELECT m.opening, m.r_lo, m.r_hi, 1, 'placeholder', NULL, 'Sin recurso específico en catálogo', '-', '-', NULL, '-'
            FROM miss m WHERE m.tier NOT IN (SELECT level_tier FROM ttop))"""


@register("r01_j07_resource_search", f"""WITH keys AS (SELECT DISTINCT opening, CAST(floor(rating) AS BIGINT) AS r_lo, CAST(ceil(rating) AS BIGINT) AS r_hi FROM games),
{_search_sql('keys')} SELECT * FROM ans""")
def r01(spark, sf):
    return R.search_resources(fx.games(spark, sf).select("opening", "rating"), fx.catalog(spark, sf))


def _game_lv(spark, sf):
    e = P.game_features(fx.games(spark, sf))
    return K.game_levels(e, K.scaler_stats(e))


_W09_SQL = f"""{_GAME_LEVELS_SQL},
glr AS (SELECT *, coalesce(CASE level_id WHEN 0 THEN 'dominio' WHEN 1 THEN 'desarrollo' WHEN 2 THEN 'sin_base' END, 'desarrollo') AS level_rec FROM gl),
sm AS (SELECT player, opening, color, level_rec, count(game_id) AS n_games, avg(acc) AS acc_mean, avg(score) AS win_rate FROM glr
       GROUP BY player, opening, color, level_rec HAVING count(game_id) >= 5),
po AS (SELECT * FROM (SELECT *, CASE level_rec WHEN 'sin_base' THEN 1 WHEN 'desarrollo' THEN 2 WHEN 'dominio' THEN 3 ELSE 2 END AS prio,
       row_number() OVER (PARTITION BY player ORDER BY CASE level_rec WHEN 'sin_base' THEN 1 WHEN 'desarrollo' THEN 2 WHEN 'dominio' THEN 3 ELSE 2 END,
       win_rate, opening, color) AS rank_opening FROM sm) WHERE rank_opening <= 5),
pr AS (SELECT player, avg(rating) AS rating FROM gl GROUP BY player),
req AS (SELECT po.*, pr.rating, CAST(floor(pr.rating) AS BIGINT) AS r_lo, CAST(ceil(pr.rating) AS BIGINT) AS r_hi FROM po JOIN pr USING (player)),
rkeys AS (SELECT DISTINCT opening, r_lo, r_hi FROM req)"""


@register("w09_study_priority", f"""WITH {_W09_SQL}
SELECT player, opening, color, level_rec, n_games, round(acc_mean, 8) AS acc_mean, round(win_rate, 8) AS win_rate, prio, rank_opening FROM po""")
def w09(spark, sf):
    return finalize(R.profile_openings(_game_lv(spark, sf)))


@register("r02_direct_profile_recommender", f"""WITH {_W09_SQL}, {_search_sql('rkeys')}
SELECT req.player, req.opening, req.color, req.level_rec, req.rank_opening, ans.rank, ans.match_kind, ans.resource_id, ans.title
FROM req JOIN ans USING (opening, r_lo, r_hi)""")
def r02(spark, sf):
    r = R.direct_profile_recommender(_game_lv(spark, sf), fx.catalog(spark, sf))
    return r.select("player", "opening", "color", "level_rec", "rank_opening", "rank", "match_kind", "resource_id", "title")


_FEAT = R.KNN_FEATURES
_A09_SQL = f"""{_GAME_LEVELS_SQL},
lv AS (SELECT *, coalesce(CASE level_id WHEN 0 THEN 'dominio' WHEN 1 THEN 'desarrollo' WHEN 2 THEN 'sin_base' END, 'desarrollo') AS lvl FROM gl),
pf AS (SELECT player, avg(rating) AS rating_mean, avg(acc_adj) AS acc_mean, avg(theory_depth) AS theory_mean,
   avg(CAST(lvl = 'dominio' AS DOUBLE)) AS pct_dominio, avg(CAST(lvl = 'desarrollo' AS DOUBLE)) AS pct_desarrollo,
   avg(CAST(lvl = 'sin_base' AS DOUBLE)) AS pct_sin_base, avg(score) AS win_rate, CAST(count(DISTINCT opening) AS DOUBLE) AS n_openings
   FROM lv GROUP BY player),
md AS (SELECT {', '.join(f'quantile_cont({c}, 0.5) AS m_{c}' for c in _FEAT)} FROM pf),
pfm AS (SELECT player, rating_mean, {', '.join(f'coalesce({c}, m_{c}, 50.0) AS {c}' for c in _FEAT)} FROM pf, md),
sd AS (SELECT {', '.join(f'avg({c}) AS mu_{c}, stddev_pop({c}) AS sd_{c}' for c in _FEAT)} FROM pfm),
vv AS (SELECT player, rating_mean, {', '.join(f'(coalesce({c}, 0.0) - mu_{c}) / CASE WHEN sd_{c} = 0 OR sd_{c} IS NULL THEN 1.0 ELSE sd_{c} END * {w} AS x{i}' for i, (c, w) in enumerate(zip(_FEAT, R.KNN_WEIGHTS)))} FROM pfm, sd),
nv AS (SELECT *, sqrt(0.0 + {' + '.join(f'x{i} * x{i}' for i in range(len(_FEAT)))}) AS nrm FROM vv),
uv AS (SELECT player, nrm, {', '.join(f'CASE WHEN nrm > 0 THEN x{i} / nrm ELSE x{i} * 0.0 END AS u{i}' for i in range(len(_FEAT)))} FROM nv),
pairs AS (SELECT a.player, b.player AS neighbour,
   round(CASE WHEN a.nrm > 0 AND b.nrm > 0 THEN 1.0 - (0.0 + {' + '.join(f'a.u{i} * b.u{i}' for i in range(len(_FEAT)))}) ELSE 1.0 END, 9) AS distance
   FROM uv a JOIN uv b ON a.player <> b.player),
nb AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY player ORDER BY distance, neighbour) AS rank FROM pairs) WHERE rank <= 5)"""


@register("a09_similarity_profiles", f"""WITH {_A09_SQL}
SELECT player, round(rating_mean, 8) AS rating_mean, {', '.join(f'round({c}, 8) AS {c}' for c in _FEAT)} FROM pfm""")
def a09(spark, sf):
    return finalize(R.similarity_profiles(_game_lv(spark, sf)))


@register("j09_knn_neighbours", f"""WITH {_A09_SQL} SELECT player, neighbour, distance, rank FROM nb""")
def j09(spark, sf):
    v = R.weighted_vectors(R.similarity_profiles(_game_lv(spark, sf)))
    return R.knn_neighbours(v, 5).select("player", "neighbour", "distance", "rank")


_R03_SQL = f"""{_A09_SQL},
ms AS (SELECT player, opening FROM gl WHERE level_id = 0 GROUP BY player, opening HAVING count(*) >= 5),
gaps AS (SELECT nb.player, ms.opening FROM nb JOIN ms ON ms.player = nb.neighbour
         WHERE NOT EXISTS (SELECT 1 FROM ms m2 WHERE m2.player = nb.player AND m2.opening = ms.opening)),
gf AS (SELECT * FROM (SELECT player, opening, count(*) AS freq, row_number() OVER (PARTITION BY player ORDER BY count(*) DESC, opening) AS rank_gap
       FROM gaps GROUP BY player, opening) WHERE rank_gap <= 5)"""


@register("r03_neighbour_gap_openings", f"WITH {_R03_SQL} SELECT player, opening, freq, rank_gap FROM gf")
def r03(spark, sf):
    lv = _game_lv(spark, sf)
    v = R.weighted_vectors(R.similarity_profiles(lv))
    nb = R.knn_neighbours(v, 5)
    return R.neighbour_gap_openings(nb, R.mastered_openings(lv)).select("player", "opening", "freq", "rank_gap")


@register("r04_plan_fusion", f"""WITH {_W09_SQL}, {_R03_SQL.replace(_GAME_LEVELS_SQL + ',', '', 1)},
kreq AS (SELECT gf.player, gf.opening, pr.rating, CAST(floor(pr.rating) AS BIGINT) AS r_lo, CAST(ceil(pr.rating) AS BIGINT) AS r_hi FROM gf JOIN pr USING (player)),
rkeys2 AS (SELECT opening, r_lo, r_hi FROM rkeys UNION SELECT opening, r_lo, r_hi FROM kreq),
{_search_sql('rkeys2')},
precs AS (SELECT req.player, req.opening, ans.title FROM req JOIN ans USING (opening, r_lo, r_hi)),
krecs AS (SELECT kreq.player, kreq.opening, ans.title FROM kreq JOIN ans USING (opening, r_lo, r_hi)),
u AS (SELECT player, coalesce(title, 'sin_id') AS res_key, 1 AS np, 0 AS nk, opening FROM precs
      UNION ALL SELECT player, coalesce(title, 'sin_id'), 0, 1, opening FROM krecs),
a AS (SELECT player, res_key, sum(np) AS n_profile, sum(nk) AS n_knn, array_to_string(list_sort(list_distinct(list(opening))), '|') AS openings FROM u GROUP BY player, res_key)
SELECT player, res_key, CAST(n_profile AS BIGINT) AS n_profile, CAST(n_knn AS BIGINT) AS n_knn, openings, round(CAST(CASE WHEN n_profile >= 1 AND n_knn >= 1 THEN least(1.0 + 0.5 * (n_profile - 1) + 0.4 * n_knn + 0.5, 2.0)
  WHEN n_profile >= 1 THEN 1.0 + 0.5 * (n_profile - 1) + 0.4 * n_knn ELSE 0.8 + 0.4 * (n_knn - 1) END AS DOUBLE), 8) AS score FROM a""")
def r04(spark, sf):
    lv = _game_lv(spark, sf)
    cat = fx.catalog(spark, sf)
    profiles = R.similarity_profiles(lv)
    rating = profiles.select("player", F.col("rating_mean").alias("rating"))
    prof = R.direct_profile_recommender(lv, cat, ratings=rating).withColumn("url", F.lit(None).cast("string"))
    v = R.weighted_vectors(profiles)
    gaps = R.neighbour_gap_openings(R.knn_neighbours(v, 5), R.mastered_openings(lv))
    # read by the search and by its answers: the neighbours are joined once
    kreq = gaps.join(rating, "player").checkpoint(eager=True)
    krec = R.attach_answers(kreq, R.search_resources(kreq, cat)).withColumn("url", F.lit(None).cast("string"))
    out = R.fuse_plans(prof, krec)
    return finalize(out.withColumn("n_profile", F.col("n_profile").cast("long")).withColumn("n_knn", F.col("n_knn").cast("long")))


def _r07_sql():
    from ..operators.recommend import GROUP_CFG, LABEL_COURSE_TYPE
    from .queries_core import _A10_SQL
    focus = " ".join(f"WHEN '{g}' THEN [{', '.join(Q.q(x) for x in f)}]" for g, (f, a, h) in GROUP_CFG.items())
    avoid = " ".join(f"WHEN '{g}' THEN {('[' + ', '.join(Q.q(x) for x in a) + ']') if a else '[]::VARCHAR[]'}" for g, (f, a, h) in GROUP_CFG.items())
    acch = " ".join(f"WHEN '{g}' THEN {h}" for g, (f, a, h) in GROUP_CFG.items())
    pref1 = " ".join(f"WHEN '{k}' THEN '{v[0]}'" for k, v in LABEL_COURSE_TYPE.items())
    prefs = " ".join(f"WHEN '{k}' THEN [{', '.join(Q.q(x) for x in v)}]" for k, v in LABEL_COURSE_TYPE.items())
    return f"""WITH {_A10_SQL},
pr AS (SELECT player, opening, color, label, label_priority, accuracy_pct, rating,
   lower(trim(split_part(split_part(coalesce(opening, 'Desconocida'), ':', 1), ',', 1))) AS apertura,
   CASE WHEN color = 'white' THEN 'white' ELSE 'black' END AS color_en,
   CASE "group" {focus} END AS focus, CASE "group" {avoid} END AS avoid,
   CASE WHEN accuracy_pct >= (CASE "group" {acch} END) AND label NOT IN ('PUNTO_CRITICO', 'TEORIA_VACIA') THEN 1 ELSE 0 END AS penalty,
   coalesce(CASE label {pref1} END, 'general') AS pref1, coalesce(CASE label {prefs} END, ['general']) AS prefs
   FROM labp WHERE label <> 'VOLUMEN_BAJO'),
rs AS (SELECT resource_id, openings, coalesce(course_type, '') AS ct, lower(coalesce(color, 'Both')) AS rcolor,
   coalesce(has_video, 0) + coalesce(has_pgn, 0) + coalesce(has_exercises, 0) + coalesce(has_spaced_rep, 0) AS richness,
   coalesce(level_min, 0) AS lo, coalesce(level_max, 9999) AS hi FROM catalog),
sc AS (SELECT pr.player, pr.opening, pr.color, pr.label, pr.label_priority, pr.accuracy_pct, rs.resource_id,
   CAST(CASE WHEN instr(lower(coalesce(rs.openings, '')), pr.apertura) > 0 THEN 40 ELSE 0 END
   + CASE WHEN rcolor = color_en THEN 10 WHEN rcolor = 'both' THEN 5 ELSE 0 END
   + CASE WHEN ct = pref1 THEN 20 WHEN list_contains(prefs, ct) THEN 10 ELSE 0 END
   + CASE WHEN list_contains(focus, ct) THEN 8 ELSE 0 END
   + CASE WHEN penalty = 1 AND ct = 'opening' THEN -15 ELSE 0 END AS DOUBLE) + richness * 5.0 AS score
   FROM pr JOIN rs ON rs.lo <= pr.rating AND rs.hi >= pr.rating AND NOT list_contains(pr.avoid, rs.ct))
SELECT player, opening, color, label, label_priority, round(accuracy_pct, 8) AS accuracy_pct, resource_id, score, rank FROM
  (SELECT *, row_number() OVER (PARTITION BY player, opening, color ORDER BY score DESC, resource_id) AS rank FROM sc) WHERE rank <= 3"""


@register("r07_r08_label_driven_plan", _r07_sql())
def r07(spark, sf):
    lab = P.label_openings(P.label_profile(fx.games(spark, sf)))
    out = R.label_driven_plan(lab, fx.catalog(spark, sf))
    return finalize(out.select("player", "opening", "color", "label", "label_priority", "accuracy_pct", "resource_id",
                               "score", "rank"))


def _lines_sql():
    from .queries_core import _A10_SQL
    return f"""WITH {_A10_SQL}
SELECT player, opening, color, label, coalesce(label_priority, 99) AS label_priority, round(accuracy_pct, 8) AS accuracy_pct,
  row_number() OVER (PARTITION BY player ORDER BY coalesce(label_priority, 99), round(accuracy_pct, 8), opening, color) AS line_rank
FROM labp WHERE label <> 'VOLUMEN_BAJO'"""


@register("w09_r08_line_ranking", _lines_sql())
def w09_lines(spark, sf):
    lab = R.rank_lines(P.label_openings(P.label_profile(fx.games(spark, sf))))
    return finalize(lab.select("player", "opening", "color", "label", "label_priority", "accuracy_pct", "line_rank"))


def _app_levels(spark, sf):
    e = P.game_features(fx.games(spark, sf))
    return K.opening_levels(e, K.scaler_stats(e))


def _r05_shared_sql(req_union: str) -> str:
    """CTEs shared by every R05 round: catalogue pool helpers, terms and matches.
    ``req_union`` is a SELECT giving (opening) of all requests."""
    from ..functions.text import WORD_TERMS
    words = ", ".join(Q.q(w) for w in WORD_TERMS)

    def match(col):
        return (f"SELECT DISTINCT tt.opening, c.resource_id FROM tt JOIN catalog c ON instr(lower(c.{col}), tt.term) > 0 "
                f"AND (tt.term NOT IN ({words}) OR regexp_matches(lower(c.{col}), '(^|[^a-z])' || tt.term || '([^a-z]|$)'))")
    return f"""{_syn_sql('app')},
cat2 AS (SELECT *, lower(trim(coalesce(color, 'Both'))) AS rcolor, coalesce(level_min, 0) AS lo, coalesce(level_max, 9999) AS hi FROM catalog),
cc AS (SELECT c.color_en, count(*) AS nc FROM (VALUES ('white'), ('black')) c(color_en) JOIN cat2 ON cat2.rcolor IN (c.color_en, 'both') GROUP BY 1),
names AS (SELECT DISTINCT opening, lower(trim(opening)) AS ap FROM ({req_union}) z), {_terms_sql('names')},
mo AS ({match('openings')}), mt AS ({match('title')})"""


def _r05_round_sql(p: str, rq: str, free: str | None, excl: str | None) -> str:
    """One R05 round over request CTE ``rq`` (req_id, opening, color_en, tier_obj, rating);
    defines ``{p}res`` (req_id, pick, resource_id, title, course_type, level_tier, fallback_tier)."""
    from ..operators.recommend import TYPE_BONUS
    bonus = Q.first_case([(f"instr(lower(coalesce(course_type, '')), {Q.q(k)}) > 0", f"{v}.0") for k, v in TYPE_BONUS], "0.0")
    free_f = f" AND cat2.is_free = {free}" if free is not None else ""
    ex = (f"WHERE NOT EXISTS (SELECT 1 FROM {excl} e WHERE e.req_id = {p}sc2.req_id AND e.resource_id = {p}sc2.resource_id)"
          if excl else "")
    return f"""
{p}pool0 AS (SELECT rq.req_id, rq.rating, cat2.* FROM {rq} rq LEFT JOIN cc USING (color_en) JOIN cat2
          ON (coalesce(cc.nc, 0) < 10 OR cat2.rcolor IN (rq.color_en, 'both')){free_f}),
{p}rc AS (SELECT req_id, count(*) FILTER (WHERE lo <= rating AND hi >= rating) AS nr FROM {p}pool0 GROUP BY req_id),
{p}pool AS (SELECT x.* FROM {p}pool0 x JOIN {p}rc USING (req_id) WHERE {p}rc.nr = 0 OR (x.lo <= x.rating AND x.hi >= x.rating)),
{p}sc AS (SELECT pl.*, rq.tier_obj, mo.resource_id IS NOT NULL AS m_open, mt.resource_id IS NOT NULL AS m_title,
   coalesce(pl.rating_score, 0.0) * 0.5 + {bonus} AS base FROM {p}pool pl JOIN {rq} rq USING (req_id)
   LEFT JOIN mo ON mo.opening = rq.opening AND mo.resource_id = pl.resource_id
   LEFT JOIN mt ON mt.opening = rq.opening AND mt.resource_id = pl.resource_id),
{p}sc2 AS (SELECT *, CASE WHEN m_open OR m_title THEN CAST(m_open AS INT) * 60.0 + CAST(m_title AS INT) * 20.0 + base ELSE base END AS score,
   CASE WHEN m_open OR m_title THEN CASE WHEN level_tier = tier_obj THEN 1 ELSE 2 END ELSE 3 END AS prio FROM {p}sc),
{p}sc3 AS (SELECT * FROM {p}sc2 {ex}),
{p}cnt AS (SELECT req_id, count(*) FILTER (WHERE prio = 1) AS n1, count(*) FILTER (WHERE prio = 2) AS n2 FROM {p}sc3 GROUP BY req_id),
{p}gated AS (SELECT x.* FROM {p}sc3 x JOIN {p}cnt USING (req_id) WHERE prio = 1 OR (prio = 2 AND n1 < 3) OR (prio = 3 AND n1 + n2 < 3)),
{p}ordered AS (SELECT *, row_number() OVER (PARTITION BY req_id ORDER BY prio, score DESC, resource_id) AS order_pos FROM {p}gated),
{p}f2 AS (SELECT *, count(*) OVER (PARTITION BY req_id) AS n_cand,
   row_number() OVER (PARTITION BY req_id, course_type ORDER BY order_pos) AS trank FROM {p}ordered WHERE order_pos <= 6),
{p}f3 AS (SELECT *, row_number() OVER (PARTITION BY req_id ORDER BY CASE WHEN n_cand <= 3 OR trank <= 1 THEN 0 ELSE 1 END, order_pos) AS pick FROM {p}f2),
{p}res AS (SELECT req_id, pick, resource_id, title, course_type, level_tier, CASE WHEN prio <> 1 THEN level_tier END AS fallback_tier
   FROM {p}f3 WHERE pick <= 3)"""


_RQ_COLS = ("coalesce(CASE ol.level WHEN 'sin_base' THEN 'beginner' WHEN 'desarrollo' THEN 'intermediate' WHEN 'dominio' THEN 'expert' END, "
            "'intermediate') AS tier_obj, CASE WHEN ol.color = 'white' THEN 'white' ELSE 'black' END AS color_en")


def _r05_sql():
    from .queries_ml import _OPEN_LEVELS_SQL
    return f"""WITH {_OPEN_LEVELS_SQL},
rq AS (SELECT CAST(ol.player AS VARCHAR) || '#' || ol.opening || '#' || ol.color AS req_id, ol.opening, {_RQ_COLS}, pr.rating
   FROM ol JOIN (SELECT player, avg(rating) AS rating FROM games GROUP BY player) pr USING (player)),
{_r05_shared_sql('SELECT opening FROM rq')},{_r05_round_sql('a_', 'rq', None, None)}
SELECT * FROM a_res"""


def _r06_sql():
    from .queries_ml import _OPEN_LEVELS_SQL
    parts = [f"""WITH {_OPEN_LEVELS_SQL},
pr AS (SELECT player, avg(rating) AS rating FROM games GROUP BY player),
lines AS (SELECT * FROM (SELECT ol.*, row_number() OVER (PARTITION BY player, color ORDER BY
   CASE level WHEN 'sin_base' THEN 0 WHEN 'desarrollo' THEN 1 WHEN 'dominio' THEN 2 END, win_rate, opening) AS line_rank
   FROM ol WHERE n_games >= 2) z WHERE line_rank <= 5),
lq AS (SELECT lines.player, lines.color, lines.opening, lines.line_rank, f.free, pr.rating,
   CAST(lines.player AS VARCHAR) || '#' || lines.color || '#' || CAST(f.free AS VARCHAR) || '#' || CAST(lines.line_rank AS VARCHAR) AS req_id,
   CAST(lines.player AS VARCHAR) || '#' || lines.color || '#' || CAST(f.free AS VARCHAR) AS chan_id,
   {_RQ_COLS.replace('ol.', 'lines.')} FROM lines JOIN pr USING (player) CROSS JOIN (VALUES (1), (0)) f(free)),
{_r05_shared_sql('SELECT opening FROM lq')}"""]
    done = {}
    for r in range(1, 6):
        for free in (1, 0):
            p = f"r{r}f{free}_"
            parts.append(f",\n{p}rq AS (SELECT * FROM lq WHERE line_rank = {r} AND free = {free})")
            excl = None
            if r > 1:
                parts.append(f",\n{p}ex AS (SELECT q.req_id, d.resource_id FROM {p}rq q JOIN {done[free]} d USING (chan_id))")
                excl = f"{p}ex"
            parts.append("," + _r05_round_sql(p, f"{p}rq", str(free), excl))
            parts.append(f",\n{p}out AS (SELECT x.*, q.chan_id, q.player, q.color, q.opening, q.free, q.line_rank FROM {p}res x JOIN {p}rq q USING (req_id))")
            cur = f"d{r}f{free}"
            if r == 1:
                parts.append(f",\n{cur} AS (SELECT * FROM {p}out)")
            else:
                parts.append(f",\n{cur} AS (SELECT * FROM {done[free]} UNION ALL SELECT * FROM {p}out)")
            done[free] = cur
    parts.append(f"\nSELECT player, color, CAST(free AS INT) AS free, line_rank, opening, pick, resource_id, title FROM {done[1]} "
                 f"UNION ALL SELECT player, color, CAST(free AS INT), line_rank, opening, pick, resource_id, title FROM {done[0]}")
    return "".join(parts)


@register("r05_three_priority_search", _r05_sql())
def r05(spark, sf):
    ol = _app_levels(spark, sf)
    rating = fx.games(spark, sf).groupBy("player").agg(F.avg("rating").alias("rating"))
    req = ol.join(rating, "player").select(
        F.concat_ws("#", F.col("player").cast("string"), "opening", "color").alias("req_id"),
        "color", "opening", "level", "rating", F.lit(None).cast("int").alias("free"))
    return R.three_priority_search(req, fx.catalog(spark, sf)).select(
        "req_id", "pick", "resource_id", "title", "course_type", "level_tier", "fallback_tier")


@register("r06_study_plan", _r06_sql())
def r06(spark, sf):
    ol = _app_levels(spark, sf)
    rating = fx.games(spark, sf).groupBy("player").agg(F.avg("rating").alias("rating"))
    plan = R.study_plan(ol.select("player", "opening", "color", "level", "n_games", "win_rate"), rating,
                        fx.catalog(spark, sf))
    return plan.select("player", "color", "free", "line_rank", "opening", "pick", "resource_id", "title")
