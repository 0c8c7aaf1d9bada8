"""Registered queries: remaining scalar, source, statistics and recommender operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalar as S
from ..operators import clusters as K
from ..operators import profiles as P
from ..operators import recommend as R
from ..operators import stats as ST
from ..sources import fixtures as fx
from ..sources.tables import read_table
from . import sqltext as Q
from .queries_core import _A02_SQL
from .queries_ml import _GAME_LEVELS_SQL
from .registry import finalize, register


@register("p16_result_score", """
WITH h AS (SELECT game_id, CAST(player AS VARCHAR) AS target,
   CASE WHEN color = 'white' THEN upper(CAST(player AS VARCHAR)) ELSE 'other' END AS white,
   CASE WHEN score = 1.0 THEN CASE WHEN color = 'white' THEN '1-0' ELSE '0-1' END WHEN score = 0.5 THEN '1/2-1/2'
        WHEN game_id % 7 = 0 THEN '*' ELSE CASE WHEN color = 'white' THEN '0-1' ELSE '1-0' END END AS result FROM games)
SELECT game_id, result, CAST(CASE WHEN (result = '1-0' AND lower(white) = lower(target)) OR (result = '0-1' AND NOT (lower(white) = lower(target)))
   THEN 1.0 WHEN result = '1/2-1/2' THEN 0.5 ELSE 0.0 END AS DOUBLE) AS player_score FROM h""")
def p16(spark, sf):
    g = fx.games(spark, sf)
    target = F.col("player").cast("string")
    white = F.when(F.col("color") == "white", F.upper(target)).otherwise(F.lit("other"))
    res = (F.when(F.col("score") == 1.0, F.when(F.col("color") == "white", "1-0").otherwise("0-1"))
           .when(F.col("score") == 0.5, "1/2-1/2").when(F.col("game_id") % 7 == 0, "*")
           .otherwise(F.when(F.col("color") == "white", "0-1").otherwise("1-0")))
    h = g.select("game_id", res.alias("result"), white.alias("white"), target.alias("target"))
    return h.select("game_id", "result", S.result_score("result", "white", "target").alias("player_score"))


@register("p17_p18_player_card", f"""WITH {_A02_SQL},
k AS (SELECT player, avg(accuracy) AS acc_mean, avg(avg_theory) AS theory_mean, count(*) FILTER (WHERE is_risk AND accuracy >= 75) AS n_risk_note FROM rel GROUP BY player),
r AS (SELECT player, arg_min(rating, ingest_seq) AS rating FROM games GROUP BY player)
SELECT player, rating, CASE WHEN rating >= 2200 THEN 'Gran Maestro Amateur' WHEN rating >= 2000 THEN 'Maestro FIDE'
  WHEN rating >= 1800 THEN 'Jugador Avanzado' WHEN rating >= 1600 THEN 'Competidor de Club' WHEN rating >= 1400 THEN 'Jugador Intermedio'
  WHEN rating >= 1200 THEN 'Principiante Avanzado' WHEN rating >= 0 THEN 'Principiante' ELSE 'Principiante' END AS title,
  CASE WHEN acc_mean >= 80 AND theory_mean >= 10 THEN 1 WHEN acc_mean >= 80 AND theory_mean < 7 THEN 2
       WHEN acc_mean < 65 AND theory_mean >= 10 THEN 3 WHEN acc_mean < 65 THEN 4 ELSE 5 END AS diagnosis,
  CASE WHEN acc_mean >= 80 THEN 'high' WHEN acc_mean >= 60 THEN 'mid' ELSE 'low' END AS acc_class, n_risk_note
FROM k JOIN r USING (player)""")
def p17(spark, sf):
    d = P.relative_dashboard(fx.games(spark, sf))
    k = d.groupBy("player").agg(F.avg("accuracy").alias("acc_mean"), F.avg("avg_theory").alias("theory_mean"),
                                F.count(F.when(F.col("is_risk") & (F.col("accuracy") >= 75), 1)).alias("n_risk_note"))
    r = P.ordered_users(fx.games(spark, sf))
    j = k.join(r, "player")
    return j.select("player", "rating", S.title_of("rating").alias("title"),
                    S.diagnosis_rule("acc_mean", "theory_mean").alias("diagnosis"),
                    S.accuracy_class("acc_mean").alias("acc_class"), "n_risk_note")


def _search_q_sql(x):
    s = f"lower(trim(string_split(string_split(coalesce({x}, ''), ':')[-1], ',')[-1]))"
    for w in S.GENERIC_WORDS:
        s = f"trim(replace({s}, '{w}', ''))"
    return f"regexp_replace(regexp_replace({s}, '\\s+', '+', 'g'), '^\\++|\\++$', '', 'g')"


@register("p20_search_query", f"""
SELECT DISTINCT title AS name, {_search_q_sql('title')} AS query, replace(url_encode(trim(title)), '%2F', '/') AS query_url FROM catalog
UNION SELECT DISTINCT opening, {_search_q_sql('opening')}, replace(url_encode(trim(opening)), '%2F', '/') FROM games""")
def p20(spark, sf):
    a = fx.catalog(spark, sf).select(F.col("title").alias("name"))
    b = fx.games(spark, sf).select(F.col("opening").alias("name"))
    return a.unionByName(b).distinct().select("name", S.search_query("name").alias("query"), S.search_query("name", url_encode=True).alias("query_url"))


@register("j10_band_aggregate", """
WITH t AS (SELECT DISTINCT CAST(rating AS BIGINT) AS target FROM games)
SELECT target, count(*) AS n_games, round(sum(acl) / count(acl), 8) AS acl_mean, round(sum(theory_depth) / count(*), 8) AS theory_mean
FROM t JOIN games g ON g.rating BETWEEN t.target - 200 AND t.target + 200 GROUP BY target""")
def j10(spark, sf):
    g = fx.games(spark, sf)
    return finalize(R.band_aggregate(g.select("rating"), g))


@register("w11_outperformance", f"""WITH {_GAME_LEVELS_SQL},
p AS (SELECT player, avg(rating) AS rating, avg(CAST(level_id = 0 AS DOUBLE)) AS pct_solid FROM gl GROUP BY player),
s AS (SELECT avg(pct_solid) AS m1, stddev_samp(pct_solid) AS s1, avg(rating) AS m2, stddev_samp(rating) AS s2 FROM p),
o AS (SELECT player, rating, pct_solid, (pct_solid - m1) / s1 - (rating - m2) / s2 AS outperformance FROM p, s)
(SELECT 'top' AS side, player, round(rating, 8) AS rating, round(pct_solid, 8) AS pct_solid, round(outperformance, 8) AS outperformance FROM o ORDER BY outperformance DESC, player LIMIT 5)
UNION ALL (SELECT 'bottom', player, round(rating, 8), round(pct_solid, 8), round(outperformance, 8) FROM o ORDER BY outperformance ASC, player LIMIT 5)""")
def w11(spark, sf):
    e = P.game_features(fx.games(spark, sf))
    prof = K.opening_level_profile(K.game_levels(e, K.scaler_stats(e)))
    return finalize(R.outperformance(prof))


@register("w12_diversified_topn", """
WITH e AS (SELECT c.*, trim(o.opening) AS opening FROM catalog c, unnest(string_split(c.openings, '|')) AS o(opening) WHERE c.openings IS NOT NULL),
r AS (SELECT *, row_number() OVER (PARTITION BY opening ORDER BY rating_score DESC NULLS LAST, resource_id) AS grank,
             count(*) OVER (PARTITION BY opening) AS n_cand FROM e),
t AS (SELECT *, row_number() OVER (PARTITION BY opening, course_type ORDER BY grank) AS trank FROM r),
f AS (SELECT *, row_number() OVER (PARTITION BY opening ORDER BY CASE WHEN n_cand <= 4 OR trank <= 2 THEN 0 ELSE 1 END, grank) AS pick FROM t)
SELECT opening, resource_id, course_type, pick FROM f WHERE pick <= 4""")
def w12(spark, sf):
    cat = fx.catalog(spark, sf)
    e = cat.withColumn("opening", F.explode(F.split("openings", r"\|"))).withColumn("opening", F.trim("opening"))
    return R.diversified_topn(e, ["opening"], [F.col("rating_score").desc_nulls_last(), F.col("resource_id")], 4).select(
        "opening", "resource_id", "course_type", "pick")


@register("r09_tier_boosted_topn", """
WITH m AS (SELECT * FROM (VALUES ('beginner', 'beginner', 2.5), ('beginner', 'intermediate', 0.6), ('beginner', 'advanced', 0.1),
   ('intermediate', 'beginner', 0.4), ('intermediate', 'intermediate', 1.5), ('intermediate', 'advanced', 0.8),
   ('advanced', 'beginner', 0.1), ('advanced', 'intermediate', 0.7), ('advanced', 'advanced', 2.0)) v(user_tier, level_tier, mult)),
u AS (SELECT * FROM (VALUES ('beginner'), ('intermediate'), ('advanced')) v(user_tier)),
s AS (SELECT u.user_tier, c.resource_id, c.level_tier, coalesce(c.rating_score, 0.0) * coalesce(m.mult, 1.0) AS score,
      coalesce(c.level_tier = u.user_tier, false) AS own FROM u CROSS JOIN catalog c LEFT JOIN m ON m.user_tier = u.user_tier AND m.level_tier = c.level_tier),
r AS (SELECT *, row_number() OVER (PARTITION BY user_tier, own ORDER BY score DESC, resource_id) AS rr FROM s),
ot AS (SELECT * FROM r WHERE own AND rr <= 4),
k AS (SELECT u.user_tier, count(ot.resource_id) AS k FROM u LEFT JOIN ot USING (user_tier) GROUP BY u.user_tier),
oth AS (SELECT r.* FROM r JOIN k USING (user_tier) WHERE NOT own AND rr <= 10 - k.k),
b AS (SELECT * FROM ot UNION ALL SELECT * FROM oth)
SELECT user_tier, resource_id, level_tier, round(score, 8) AS score, rank FROM
  (SELECT *, row_number() OVER (PARTITION BY user_tier ORDER BY score DESC, resource_id) AS rank FROM b) WHERE rank <= 10""")
def r09(spark, sf):
    cat = fx.catalog(spark, sf)
    return finalize(R.tier_boosted_by_tier(cat, F.coalesce(F.col("rating_score"), F.lit(0.0)), 10).select(
        "user_tier", "resource_id", "level_tier", "score", "rank"))


def _profile_json_sql():
    return ("'{\"perfs\": {\"blitz\": {\"rating\": ' || CAST(CASE WHEN player % 3 = 0 THEN 0 ELSE rating END AS VARCHAR) || "
            "'}, \"rapid\": {\"rating\": ' || CAST(CASE WHEN player % 5 = 0 THEN 0 ELSE rating + 50 END AS VARCHAR) || "
            "'}, \"classical\": {\"rating\": ' || CAST(CASE WHEN player % 4 = 0 THEN 0 ELSE rating + 100 END AS VARCHAR) || "
            "'}, \"bullet\": {\"rating\": ' || CAST(CASE WHEN player % 2 = 0 THEN 0 ELSE rating - 30 END AS VARCHAR) || '}}}'")


@register("s05_reference_rating", f"""
WITH p AS (SELECT player, arg_min(rating, ingest_seq) AS rating FROM games GROUP BY player),
j AS (SELECT player, {_profile_json_sql()} AS profile FROM p),
x AS (SELECT player, CAST(json_extract(profile, '$.perfs.blitz.rating') AS INT) AS b,
   CAST(json_extract(profile, '$.perfs.rapid.rating') AS INT) AS r, CAST(json_extract(profile, '$.perfs.classical.rating') AS INT) AS c,
   CAST(json_extract(profile, '$.perfs.bullet.rating') AS INT) AS u FROM j)
SELECT player, coalesce(nullif(b, 0), nullif(r, 0)) AS ref_rating, coalesce(nullif(b, 0), nullif(r, 0), nullif(c, 0)) AS ref_rating_classical,
  coalesce(nullif(b, 0), nullif(r, 0), nullif(u, 0)) AS ref_rating_bullet
FROM x WHERE coalesce(nullif(b, 0), nullif(r, 0), nullif(c, 0), nullif(u, 0)) IS NOT NULL""")
def s05(spark, sf):
    from ..sources.io import reference_rating
    p = P.ordered_users(fx.games(spark, sf))
    j = p.select(
        "player", F.concat(F.lit('{"perfs": {"blitz": {"rating": '),
                           F.when(F.col("player") % 3 == 0, 0).otherwise(F.col("rating")).cast("string"),
                           F.lit('}, "rapid": {"rating": '),
                           F.when(F.col("player") % 5 == 0, 0).otherwise(F.col("rating") + 50).cast("string"),
                           F.lit('}, "classical": {"rating": '),
                           F.when(F.col("player") % 4 == 0, 0).otherwise(F.col("rating") + 100).cast("string"),
                           F.lit('}, "bullet": {"rating": '),
                           F.when(F.col("player") % 2 == 0, 0).otherwise(F.col("rating") - 30).cast("string"),
                           F.lit("}}}")).alias("profile"))
    return reference_rating(j, "profile").select("player", "ref_rating", "ref_rating_classical", "ref_rating_bullet")


_H1 = "'<h1>(.*?)</h1>'"
_P = "'<p>(.*?)</p>'"


@register("s07_page_cards", f"""
SELECT page_id, regexp_extract(html, '<title>(.*?)</title>', 1) AS title, regexp_extract(html, {_H1}, 1) AS heading,
  substr({Q.strip_ws(f"regexp_replace(regexp_extract(html, {_P}, 1), '<[^>]+>', '', 'g')")}, 1, 300) AS first_paragraph,
  len(list_distinct(regexp_extract_all(html, '<a href="([^"]+)"', 1))) AS n_links,
  CASE WHEN instr(html, 'Video Content') > 0 THEN 1 ELSE 0 END AS has_video,
  {Q.first_case([(f"instr(lower(regexp_extract(html, {_H1}, 1)), 'for white') > 0", "'White'"),
                 (f"instr(lower(regexp_extract(html, {_H1}, 1)), 'for black') > 0", "'Black'")], "'Both'")} AS color
FROM pages""")
def s07(spark, sf):
    from ..sources.io import page_cards
    return page_cards(read_table(spark, sf, "pages", ["page_id", "html"]))


_CARD_TEXT = "regexp_replace(html, '<[^>]*>', ' ', 'g')"
_PLAIN = "trim(regexp_replace(regexp_replace({x}, '<[^>]*>', '', 'g'), '\\s+', ' ', 'g'))"
_DURATION = r"(\d+(?:\.\d+)?)\s*h(?:\s*and\s*(\d+)\s*min)?|(\d+)\s*min"


def _card_sql():
    from ..functions import text as X
    from .queries_text import _triple_sql
    title = _PLAIN.format(x="regexp_extract(html, '(?s)<h1[^>]*>(.*?)</h1>', 1)")
    types = " ".join(f"WHEN {Q.any_contains('lower(title)', w)} THEN {Q.q(n)}" for n, w in X.CARD_COURSE_TYPES[1:])
    return f"""
WITH c AS (SELECT page_id, html, {title} AS title, regexp_extract(html, '<a [^>]*href="([^"]*)"', 1) AS url, {_CARD_TEXT} AS text FROM pages),
d AS (SELECT *, {_triple_sql('text')} AS tr FROM c WHERE title <> '' AND url <> '')
SELECT page_id, title, url, CASE WHEN contains(text, 'Video Content') THEN 'video' ELSE 'interactive' END AS format,
  CASE WHEN {Q.any_contains('lower(title)', X.CARD_COURSE_TYPES[0][1])} THEN 'opening' {types} ELSE 'general' END AS course_type,
  CAST(split_part(tr, '#', 1) AS INT) AS level_min, CAST(split_part(tr, '#', 2) AS INT) AS level_max, split_part(tr, '#', 3) AS level_tier,
  CASE WHEN regexp_extract(text, '{_DURATION}', 3) <> '' THEN CAST(regexp_extract(text, '{_DURATION}', 3) AS DOUBLE)
       WHEN regexp_extract(text, '{_DURATION}', 1) <> '' THEN CAST(regexp_extract(text, '{_DURATION}', 1) AS DOUBLE) * 60
         + coalesce(CAST(nullif(regexp_extract(text, '{_DURATION}', 2), '') AS DOUBLE), 0.0) END AS duration_min,
  substr({_PLAIN.format(x="regexp_extract(html, '(?s)<p[^>]*>(.*?)</p>', 1)")}, 1, 300) AS description FROM d"""


@register("s07_course_cards", _card_sql())
def s07_cards(spark, sf):
    from ..sources.io import course_cards
    # the pages of the fixture have h1 headings and no course links: the first link stands for one
    d = course_cards(read_table(spark, sf, "pages", ["page_id", "html"]), "h1", "")
    return d.select("page_id", "title", "url", "format", "course_type", "level_min", "level_max", "level_tier", "duration_min", "description")


@register("s08_search_links", """
WITH l AS (SELECT page_id, regexp_extract_all(html, '<a href="/([^"]+)">', 1) AS ids,
                  regexp_extract_all(html, '<a href="/[^"]+">([^<]*)</a>', 1) AS titles FROM pages),
z AS (SELECT page_id, unnest(ids) AS link_id, generate_subscripts(ids, 1) AS pos, titles FROM l),
d AS (SELECT page_id, link_id, titles[pos] AS link_title, row_number() OVER (PARTITION BY page_id ORDER BY min_pos) AS rank FROM
      (SELECT page_id, link_id, min(pos) AS min_pos, any_value(titles) AS titles, min(pos) AS pos FROM z GROUP BY page_id, link_id)),
c AS (SELECT * FROM d WHERE rank <= 3),
n AS (SELECT page_id, count(*) AS k FROM c GROUP BY page_id)
SELECT page_id, rank, link_id, link_title FROM c
UNION ALL SELECT p.page_id, coalesce(n.k, 0) + 1, 'search', 'Search' FROM pages p LEFT JOIN n USING (page_id) WHERE coalesce(n.k, 0) < 3""")
def s08(spark, sf):
    from ..sources.io import search_links
    return search_links(read_table(spark, sf, "pages", ["page_id", "html"]), 3)


@register("j13_detail_enrichment", """
WITH hits AS (SELECT resource_id, title FROM catalog WHERE source = 'youtube'),
stats AS (SELECT resource_id, views_yt, duration_min FROM catalog WHERE views_yt IS NOT NULL AND CAST(substr(resource_id, 4) AS INT) % 2 = 1)
SELECT h.resource_id, coalesce(s.views_yt, 0) AS views, s.duration_min,
  coalesce(CASE WHEN instr(lower(h.title), 'beginner') > 0 THEN 0 END, 1000) AS level_min, 3000 AS level_max,
  CASE WHEN instr(lower(h.title), 'beginner') > 0 THEN 'beginner' ELSE 'intermediate' END AS level_tier
FROM hits h LEFT JOIN stats s USING (resource_id)""")
def j13(spark, sf):
    cat = fx.catalog(spark, sf)
    hits = cat.filter(F.col("source") == "youtube").select("resource_id", "title")
    stats = cat.filter(F.col("views_yt").isNotNull() & (F.substring("resource_id", 4, 20).cast("int") % 2 == 1)).select(
        "resource_id", "views_yt", "duration_min")
    j = hits.join(stats, "resource_id", "left")
    beg = F.instr(F.lower("title"), "beginner") > 0
    return j.select("resource_id", F.coalesce("views_yt", F.lit(0)).alias("views"), "duration_min",
                    F.when(beg, 0).otherwise(1000).alias("level_min"), F.lit(3000).alias("level_max"),
                    F.when(beg, "beginner").otherwise("intermediate").alias("level_tier"))


def _jb_sql(name, x):
    return (f"SELECT '{name}' AS feature, count(*) AS n, round(g1, 6) AS skew, round(g2, 6) AS kurt, round(count(*) / 6.0 * (g1 * g1 + g2 * g2 / 4.0), 4) AS jb "
            f"FROM (SELECT *, avg(power(v - mu, 3)) OVER () / power(avg(power(v - mu, 2)) OVER (), 1.5) AS g1, "
            f"avg(power(v - mu, 4)) OVER () / power(avg(power(v - mu, 2)) OVER (), 2) - 3 AS g2 FROM "
            f"(SELECT v, avg(v) OVER () AS mu FROM (SELECT {x} AS v FROM catalog) a WHERE v IS NOT NULL) b) c GROUP BY g1, g2")


@register("m13_normality_screen", _jb_sql("price", "price_eur") + " UNION ALL " + _jb_sql("log_price", "ln(1 + price_eur)")
          + " UNION ALL " + _jb_sql("duration", "CAST(duration_min AS DOUBLE)"))
def m13(spark, sf):
    c = fx.catalog(spark, sf)
    out = ST.jarque_bera(c, {"price": F.col("price_eur"), "log_price": F.log1p("price_eur"),
                             "duration": F.col("duration_min").cast("double")})
    return out.select("feature", "n", F.round("skew", 6).alias("skew"), F.round("kurt", 6).alias("kurt"),
                      F.round("jb", 4).alias("jb"))


_M07_SQL = f"""{_GAME_LEVELS_SQL},
pr AS (SELECT level3 AS y_true, CASE level_id WHEN 0 THEN 'avanzado' WHEN 1 THEN 'intermedio' ELSE 'principiante' END AS y_pred FROM gl),
conf AS (SELECT y_true AS t, y_pred AS p, count(*) AS c FROM pr GROUP BY 1, 2),
sup AS (SELECT t AS cls, sum(c) AS support FROM conf GROUP BY 1), pc AS (SELECT p AS cls, sum(c) AS pred_n FROM conf GROUP BY 1),
tp AS (SELECT t AS cls, c AS tp FROM conf WHERE t = p),
per AS (SELECT coalesce(sup.cls, pc.cls) AS cls, coalesce(support, 0) AS support, coalesce(pred_n, 0) AS pred_n, coalesce(tp, 0) AS tp
        FROM sup FULL JOIN pc ON sup.cls = pc.cls LEFT JOIN tp ON tp.cls = coalesce(sup.cls, pc.cls)),
per2 AS (SELECT *, CASE WHEN pred_n > 0 THEN tp / pred_n ELSE 0.0 END AS prec, CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS rec FROM per),
per3 AS (SELECT *, CASE WHEN prec + rec > 0 THEN 2 * prec * rec / (prec + rec) ELSE 0.0 END AS f1 FROM per2),
g AS (SELECT sum(tp) / sum(support) AS accuracy, avg(CASE WHEN support > 0 THEN rec END) AS balanced_accuracy, avg(f1) AS f1_macro,
   sum(f1 * support) / sum(support) AS f1_weighted, CAST(sum(support) AS DOUBLE) AS nn, CAST(sum(tp) AS DOUBLE) AS cc,
   CAST(sum(support * pred_n) AS DOUBLE) AS sp, CAST(sum(support * support) AS DOUBLE) AS ss, CAST(sum(pred_n * pred_n) AS DOUBLE) AS pp FROM per3)"""


@register("m07_classification_metrics", f"""WITH {_M07_SQL}
SELECT 'accuracy' AS metric, round(accuracy, 8) AS value, 'all' AS cls FROM g
UNION ALL SELECT 'balanced_accuracy', round(balanced_accuracy, 8), 'all' FROM g
UNION ALL SELECT 'f1_macro', round(f1_macro, 8), 'all' FROM g UNION ALL SELECT 'f1_weighted', round(f1_weighted, 8), 'all' FROM g
UNION ALL SELECT 'kappa', round((cc * nn - sp) / (nn * nn - sp), 8), 'all' FROM g
UNION ALL SELECT 'mcc', round((cc * nn - sp) / sqrt((nn * nn - pp) * (nn * nn - ss)), 8), 'all' FROM g
UNION ALL SELECT 'precision', round(prec, 8), cls FROM per3 UNION ALL SELECT 'recall', round(rec, 8), cls FROM per3
UNION ALL SELECT 'f1', round(f1, 8), cls FROM per3 UNION ALL SELECT 'support', CAST(support AS DOUBLE), cls FROM per3""")
def m07(spark, sf):
    e = P.game_features(fx.games(spark, sf))
    lv = K.game_levels(e, K.scaler_stats(e))
    pr = lv.select(F.col("level3").alias("y_true"), F.when(F.col("level_id") == 0, "avanzado").when(
        F.col("level_id") == 1, "intermedio").otherwise("principiante").alias("y_pred"))
    return finalize(ST.classification_metrics(pr))


@register("m08_error_analysis", f"""WITH {_GAME_LEVELS_SQL},
u AS (SELECT player, arg_min(level3, ingest_seq) AS y_true, avg(rating) AS rating,
   CASE mode(level_id ORDER BY level_id) WHEN 0 THEN 'avanzado' WHEN 1 THEN 'intermedio' ELSE 'principiante' END AS y_pred FROM gl GROUP BY player)
SELECT player, y_true, y_pred, round(rating, 8) AS rating FROM u WHERE y_true <> y_pred""")
def m08(spark, sf):
    e = P.game_features(fx.games(spark, sf))
    lv = K.game_levels(e, K.scaler_stats(e))
    mode = K.modal_cluster(lv)
    u = lv.groupBy("player").agg(F.min_by("level3", "ingest_seq").alias("y_true"), F.avg("rating").alias("rating"))
    j = u.join(mode, "player").withColumn("y_pred", F.when(F.col("mode") == 0, "avanzado").when(
        F.col("mode") == 1, "intermedio").otherwise("principiante"))
    return finalize(j.filter(F.col("y_true") != F.col("y_pred")).select("player", "y_true", "y_pred", "rating"))

