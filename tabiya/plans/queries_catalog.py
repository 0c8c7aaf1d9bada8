"""Registered queries of the catalogue preparation, profiling and merge operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalar as S
from ..functions import text as X
from ..operators import catalog as C
from ..operators.common import exact_quantiles, grouped_quantiles
from ..sources import fixtures as fx
from .queries_text import _RETIER_SQL
from .registry import finalize, register

TIERS4 = ["beginner", "intermediate", "advanced", "expert"]


@register("p21_catalog_base_features", """
SELECT resource_id, coalesce(has_video, 0) + coalesce(has_pgn, 0) + coalesce(has_exercises, 0) + coalesce(has_spaced_rep, 0) AS richness,
  level_max - level_min AS level_range, CAST(course_type = 'opening' AS INT) AS is_opening FROM catalog""")
def p21(spark, sf):
    return C.base_features(fx.catalog(spark, sf)).select("resource_id", "richness", "level_range", "is_opening")


@register("p22_skew_transforms", """
WITH m AS (SELECT quantile_cont(duration_min, 0.5) AS md, quantile_cont(rating_score, 0.5) AS mr FROM catalog)
SELECT resource_id, round(ln(1 + coalesce(CAST(duration_min AS DOUBLE), md)), 8) AS log_duration,
  round(log10(coalesce(CAST(views_yt AS DOUBLE), 1.0) + 1), 8) AS log_views, round(ln(1 + coalesce(price_eur, 0.0)), 8) AS log_price,
  round(coalesce(rating_score, mr), 8) AS rating_filled,
  CASE level_tier WHEN 'beginner' THEN 0 WHEN 'intermediate' THEN 1 WHEN 'advanced' THEN 2 WHEN 'expert' THEN 3 END AS tier_enc
FROM catalog, m""")
def p22(spark, sf):
    return finalize(C.skew_transforms(fx.catalog(spark, sf)).select(
        "resource_id", "log_duration", "log_views", "log_price", "rating_filled", "tier_enc"))


_COLORS = ["White", "Black", "Both"]
_CTYPES = ["opening", "tactics", "middlegame", "endgame", "general", "video"]


@register("p23_one_hot", "SELECT resource_id, " + ", ".join(
    [f"coalesce(CAST(color = '{v}' AS INT), 0) AS color_{v}" for v in _COLORS]
    + [f"coalesce(CAST(course_type = '{v}' AS INT), 0) AS course_type_{v}" for v in _CTYPES]) + " FROM catalog")
def p23(spark, sf):
    c = C.one_hot(C.one_hot(fx.catalog(spark, sf), "color"), "course_type")
    return c.select("resource_id", *[f"color_{v}" for v in _COLORS], *[f"course_type_{v}" for v in _CTYPES])


@register("p24_scaling", """
WITH s AS (SELECT min(price_eur) AS mnp, max(price_eur) AS mxp, min(duration_min) AS mnd, max(duration_min) AS mxd,
   avg(rating_score) AS mur, stddev_samp(rating_score) AS sdr, stddev_pop(rating_score) AS sdp FROM catalog)
SELECT resource_id, round(CASE WHEN mxp - mnp = 0 THEN 0.0 ELSE (price_eur - mnp) / (mxp - mnp) END, 8) AS price_eur_mm,
  round(CASE WHEN mxd - mnd = 0 THEN 0.0 ELSE (duration_min - mnd) / (mxd - mnd) END, 8) AS duration_min_mm,
  round((rating_score - mur) / CASE WHEN sdr = 0 OR sdr IS NULL THEN 1.0 ELSE sdr END, 8) AS rating_score_z,
  round((rating_score - mur) / CASE WHEN sdp = 0 OR sdp IS NULL THEN 1.0 ELSE sdp END, 8) AS rating_score_zpop
FROM catalog, s""")
def p24(spark, sf):
    c = C.minmax_scale(fx.catalog(spark, sf), ["price_eur", "duration_min"])
    c = C.zscore(c, ["rating_score"])
    pop = C.zscore(fx.catalog(spark, sf).select("resource_id", "rating_score"), ["rating_score"], ddof=0)
    c = c.join(pop.select("resource_id", F.col("rating_score_z").alias("rating_score_zpop")), "resource_id")
    return finalize(c.select("resource_id", "price_eur_mm", "duration_min_mm", "rating_score_z", "rating_score_zpop"))


@register("p25_default_tier", """
SELECT resource_id, CASE WHEN has_exercises IS NULL THEN
  CASE WHEN coalesce(level_min, 1200) >= 0 AND coalesce(level_min, 1200) < 1200 THEN 'beginner'
       WHEN coalesce(level_min, 1200) >= 1200 AND coalesce(level_min, 1200) < 1800 THEN 'intermediate'
       WHEN coalesce(level_min, 1200) >= 1800 AND coalesce(level_min, 1200) < 2300 THEN 'advanced'
       WHEN coalesce(level_min, 1200) >= 2300 AND coalesce(level_min, 1200) < 3000 THEN 'expert' ELSE 'intermediate' END
  ELSE level_tier END AS level_tier FROM catalog""")
def p25(spark, sf):
    c = fx.catalog(spark, sf).withColumn("tier_in", F.when(F.col("has_exercises").isNotNull(), F.col("level_tier")))
    return c.select("resource_id", S.default_tier("tier_in", "level_min").alias("level_tier"))


_NULL_COLS = ["openings", "color", "level_min", "level_max", "rating_score", "has_exercises", "views_yt"]


@register("a15_null_profile", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, round(avg(CAST({c} IS NULL AS DOUBLE)) * 100, 8) AS pct_null, "
    f"CASE WHEN avg(CAST({c} IS NULL AS DOUBLE)) * 100 > 90 THEN '>90' WHEN avg(CAST({c} IS NULL AS DOUBLE)) * 100 >= 10 "
    f"THEN '10-90' ELSE '<10' END AS bucket FROM catalog" for c in _NULL_COLS))
def a15(spark, sf):
    return finalize(C.null_profile(fx.catalog(spark, sf), _NULL_COLS))


_FREQ_COLS = ["source", "color", "course_type", "level_tier", "is_free", "has_video"]


@register("a16_category_frequencies", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value, count(*) AS n FROM catalog GROUP BY {c}" for c in _FREQ_COLS))
def a16(spark, sf):
    return C.category_frequencies(fx.catalog(spark, sf), _FREQ_COLS)


@register("a17_pivot_source_tier", "SELECT source, " + ", ".join(
    f"count(*) FILTER (WHERE level_tier = '{t}') AS {t}" for t in TIERS4) + " FROM catalog GROUP BY source")
def a17(spark, sf):
    return C.pivot_counts(fx.catalog(spark, sf), "source", "level_tier")


_CROSSTABS = [("source", "level_tier"), ("course_type", "level_tier"), ("format", "course_type"), ("color", "level_tier"),
              ("level_tier", "richness"), ("level_tier", "course_type")]


# the catalogue has no format column: a resource with a video is a video, as for messages
@register("a17_crosstabs", "WITH f AS (SELECT *, CASE WHEN has_video = 1 THEN 'video' ELSE 'interactive' END AS format, coalesce(has_video, 0) + coalesce(has_pgn, 0) + coalesce(has_exercises, 0) + coalesce(has_spaced_rep, 0) AS richness FROM catalog) "
          + " UNION ALL ".join(f"SELECT '{a} x {b}' AS crosstab, CAST({a} AS VARCHAR) AS row_value, CAST({b} AS VARCHAR) AS col_value, count(*) AS n FROM f GROUP BY {a}, {b}" for a, b in _CROSSTABS))
def a17_all(spark, sf):
    c = C.base_features(fx.catalog(spark, sf)).withColumn("format", F.when(F.col("has_video") == 1, "video").otherwise("interactive"))
    return C.crosstabs(c, _CROSSTABS)


@register("a18_row_percent", "WITH p AS (SELECT course_type, " + ", ".join(
    f"count(*) FILTER (WHERE level_tier = '{t}') AS {t}" for t in TIERS4) + " FROM catalog GROUP BY course_type) SELECT course_type, "
    + ", ".join(f"round(round({t} / ({' + '.join(TIERS4)}), 3) * 100, 8) AS {t}" for t in TIERS4) + " FROM p")
def a18(spark, sf):
    p = C.pivot_counts(fx.catalog(spark, sf), "course_type", "level_tier")
    return finalize(C.row_percent(p, "course_type"))


@register("a19_crosstab_margins", f"""WITH {_RETIER_SQL}
SELECT coalesce(level_tier_original, 'All') AS level_tier_original, coalesce(level_tier_new, 'All') AS level_tier_new, count(*) AS n
FROM rt GROUP BY CUBE (level_tier_original, level_tier_new)""")
def a19(spark, sf):
    rt = X.recategorize(fx.catalog(spark, sf))
    return C.crosstab_margins(rt, "level_tier_original", "level_tier_new")


@register("a19_tier_source_margins", """
SELECT CASE WHEN grouping(level_tier) = 1 THEN 'All' ELSE level_tier END AS level_tier, CASE WHEN grouping(source) = 1 THEN 'All' ELSE source END AS source, count(*) AS n
FROM catalog GROUP BY CUBE (level_tier, source)""")
def a19_source(spark, sf):
    return C.crosstab_margins(fx.catalog(spark, sf), "level_tier", "source")


@register("a20_opening_label_counts", """
WITH e AS (SELECT resource_id, trim(unnest(string_split_regex(openings, '\\|'))) AS opening FROM catalog WHERE openings IS NOT NULL)
SELECT opening, count(*) AS n FROM e WHERE opening <> '' GROUP BY opening""")
def a20(spark, sf):
    return C.opening_label_counts(fx.catalog(spark, sf))


@register("a21_level_color_top10", """
WITH e AS (SELECT resource_id, trim(unnest(string_split_regex(openings, '\\|'))) AS opening FROM catalog WHERE openings IS NOT NULL),
cnt AS (SELECT opening, count(*) AS n FROM e WHERE opening <> '' GROUP BY opening),
top AS (SELECT opening FROM cnt ORDER BY n DESC, opening LIMIT 10),
r AS (SELECT DISTINCT resource_id FROM e WHERE opening IN (SELECT opening FROM top)),
c AS (SELECT * FROM catalog WHERE resource_id IN (SELECT resource_id FROM r))
SELECT level_tier, count(*) FILTER (WHERE color = 'White') AS White, count(*) FILTER (WHERE color = 'Black') AS Black,
  count(*) FILTER (WHERE color = 'Both') AS Both FROM c GROUP BY level_tier""")
def a21(spark, sf):
    cat = fx.catalog(spark, sf)
    e = C.explode_openings(cat)
    top = e.groupBy("opening").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "opening").limit(10)
    ids = e.join(F.broadcast(top.select("opening")), "opening", "left_semi").select("resource_id").distinct()
    return C.pivot_counts(cat.join(ids, "resource_id", "left_semi"), "level_tier", "color", ["White", "Black", "Both"])


@register("a22_free_share_median_price", """
SELECT 'source' AS dim, source AS value, round(avg(is_free), 8) AS stat FROM catalog GROUP BY source
UNION ALL SELECT 'tier_median_paid_price', level_tier, round(quantile_cont(price_eur, 0.5), 8) FROM catalog WHERE is_free = 0 GROUP BY level_tier""")
def a22(spark, sf):
    c = fx.catalog(spark, sf)
    a = c.groupBy(F.col("source").alias("value")).agg(F.avg("is_free").alias("stat")).withColumn("dim", F.lit("source"))
    b = (grouped_quantiles(c.filter(F.col("is_free") == 0), "level_tier", "price_eur", [0.5], ["stat"])
          .withColumnRenamed("level_tier", "value").withColumn("dim", F.lit("tier_median_paid_price")))
    return finalize(a.unionByName(b))


_DESC_COLS = ["price_eur", "duration_min", "rating_score", "views_yt"]


def _desc_sql(c, x):
    # population skewness g1 from moments (DuckDB's skewness is the adjusted G1)
    return (f"SELECT '{c}' AS feature, round(avg({x}), 8) AS mean, round(stddev_samp({x}), 8) AS std, round(min({x}), 8) AS min, "
            f"round(quantile_cont({x}, 0.5), 8) AS median, round(max({x}), 8) AS max, "
            f"round(avg(power({x} - mu, 3)) / power(avg(power({x} - mu, 2)), 1.5), 8) AS skew "
            f"FROM (SELECT *, avg({x}) OVER () AS mu FROM catalog) z")


@register("a23_descriptive_stats", " UNION ALL ".join(
    [_desc_sql(c, f"CAST({c} AS DOUBLE)") for c in _DESC_COLS]
    + [_desc_sql(f"log10_{c}", f"log10(CAST({c} AS DOUBLE) + 1)") for c in ["views_yt", "price_eur"]]))
def a23(spark, sf):
    c = fx.catalog(spark, sf)
    exprs = [(k, F.col(k).cast("double")) for k in _DESC_COLS] + \
            [(f"log10_{k}", F.log10(F.col(k).cast("double") + 1)) for k in ["views_yt", "price_eur"]]
    c = c.select(*[e.alias(k) for k, e in exprs])
    med = exact_quantiles(c, [k for k, _ in exprs], [0.5])
    # one aggregate of all columns, turned into a row each
    stats = c.agg(*[F.struct(F.lit(k).alias("feature"), F.avg(k).alias("mean"), F.stddev_samp(k).alias("std"), F.min(k).alias("min"),
                             F.lit(med[k][0]).cast("double").alias("median"), F.max(k).alias("max"), F.skewness(k).alias("skew")).alias(k) for k, _ in exprs])
    return finalize(stats.select(F.inline(F.array(*[F.col(k) for k, _ in exprs]))))


@register("a24_histogram", """
WITH s AS (SELECT min(price_eur) AS lo, max(price_eur) AS hi FROM catalog)
SELECT CAST(least(30, floor((price_eur - lo) / (hi - lo) * 30) + 1) AS INT) AS bin, count(*) AS n FROM catalog, s
WHERE price_eur IS NOT NULL GROUP BY 1""")
def a24(spark, sf):
    from ..operators.stats import histogram
    return histogram(fx.catalog(spark, sf), "price_eur", 30)


@register("a25_five_number_by_tier", """
SELECT level_tier, round(min(price_eur), 8) AS q0, round(quantile_cont(price_eur, 0.25), 8) AS q1,
  round(quantile_cont(price_eur, 0.5), 8) AS q2, round(quantile_cont(price_eur, 0.75), 8) AS q3, round(max(price_eur), 8) AS q4
FROM catalog GROUP BY level_tier""")
def a25(spark, sf):
    c = fx.catalog(spark, sf)
    return finalize(grouped_quantiles(c, "level_tier", "price_eur", [0.0, 0.25, 0.5, 0.75, 1.0], [f"q{i}" for i in range(5)]))


_CORR_COLS = ["level_min", "level_max", "level_range", "duration_min", "price_eur", "is_free", "has_video", "has_pgn", "has_exercises",
              "has_spaced_rep", "richness", "rating_score", "views_yt", "is_opening"]


@register("a26_top_correlations", """WITH f AS (SELECT *, level_max - level_min AS level_range, CASE WHEN course_type = 'opening' THEN 1 ELSE 0 END AS is_opening,
  coalesce(has_video, 0) + coalesce(has_pgn, 0) + coalesce(has_exercises, 0) + coalesce(has_spaced_rep, 0) AS richness FROM catalog), c AS (""" + " UNION ALL ".join(
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)) AS r FROM f"
    for i, a in enumerate(_CORR_COLS) for b in _CORR_COLS[i + 1:])
    + ") SELECT col_a, col_b, round(r, 8) AS r FROM c WHERE r IS NOT NULL AND NOT isnan(r) ORDER BY abs(round(r, 8)) DESC, col_a, col_b LIMIT 10")
def a26(spark, sf):
    from ..operators.stats import top_correlations
    return finalize(top_correlations(C.base_features(fx.catalog(spark, sf)), _CORR_COLS, 10))


@register("a29_retier_report", f"""WITH {_RETIER_SQL},
b AS (SELECT level_tier_original AS level_tier, count(*) AS n_before FROM rt GROUP BY 1),
a AS (SELECT level_tier_new AS level_tier, count(*) AS n_after FROM rt GROUP BY 1)
SELECT coalesce(b.level_tier, a.level_tier) AS level_tier, coalesce(n_before, 0) AS n_before, coalesce(n_after, 0) AS n_after,
  coalesce(n_after, 0) - coalesce(n_before, 0) AS diff FROM b FULL JOIN a ON b.level_tier = a.level_tier""")
def a29(spark, sf):
    rt = X.recategorize(fx.catalog(spark, sf))
    return C.retier_report(rt.select(F.col("level_tier_original").alias("level_tier")),
                           rt.select(F.col("level_tier_new").alias("level_tier")))


@register("a30_distribution_vs_targets", f"""WITH {_RETIER_SQL},
t AS (SELECT * FROM (VALUES ('beginner', 20.0), ('intermediate', 50.0), ('advanced', 30.0)) v(level_tier, target)),
n AS (SELECT level_tier, count(*) AS n FROM rt GROUP BY 1), tot AS (SELECT count(*) AS total FROM rt)
SELECT t.level_tier, CAST(t.target AS DOUBLE) AS target, coalesce(n.n, 0) AS n, round(coalesce(n.n, 0) / total * 100, 8) AS pct,
  CASE WHEN coalesce(n.n, 0) / total * 100 >= t.target THEN 'OK' ELSE 'LOW' END AS status FROM t LEFT JOIN n USING (level_tier), tot""")
def a30(spark, sf):
    rt = X.recategorize(fx.catalog(spark, sf))
    return finalize(C.distribution_vs_targets(rt, {"beginner": 20.0, "intermediate": 50.0, "advanced": 30.0}))


@register("a30_distribution_vs_market_targets", """
WITH t AS (SELECT * FROM (VALUES ('beginner', 10.0), ('intermediate', 55.0), ('advanced', 35.0)) v(level_tier, target)),
n AS (SELECT level_tier, count(*) AS n FROM catalog GROUP BY 1), tot AS (SELECT count(*) AS total FROM catalog)
SELECT t.level_tier, CAST(t.target AS DOUBLE) AS target, coalesce(n.n, 0) AS n, round(coalesce(n.n, 0) / total * 100, 8) AS pct,
  CASE WHEN coalesce(n.n, 0) / total * 100 >= t.target THEN 'OK' ELSE 'LOW' END AS status FROM t LEFT JOIN n USING (level_tier), tot""")
def a30_market(spark, sf):
    return finalize(C.distribution_vs_targets(fx.catalog(spark, sf), {"beginner": 10.0, "intermediate": 55.0, "advanced": 35.0}))


_MERGE_COLS = ["resource_id", "source", "title", "openings", "level_tier", "is_free", "price_eur", "score_up"]


@register("u01_u02_u04_u06_catalogue_merge", """
WITH cur AS (SELECT * FROM catalog WHERE source IN ('modern_chess', 'youtube', 'manual')),
inc AS (SELECT * FROM catalog WHERE source IN ('manual', 'chessable', 'telegram_file')),
new AS (SELECT * FROM inc WHERE resource_id NOT IN (SELECT resource_id FROM cur))
SELECT resource_id, source, title, openings, level_tier, is_free, price_eur, CAST(NULL AS VARCHAR) AS score_up FROM cur
UNION ALL SELECT resource_id, source, title, openings, level_tier, is_free, price_eur, NULL FROM new""")
def u06(spark, sf):
    cat = fx.catalog(spark, sf)
    cur = cat.filter(F.col("source").isin("modern_chess", "youtube", "manual"))
    inc = cat.filter(F.col("source").isin("manual", "chessable", "telegram_file"))
    return finalize(C.merge_catalogues(cur, inc, _MERGE_COLS))


@register("u03_u05_key_sets", """
SELECT 'distinct_tier_type' AS kind, level_tier || '/' || course_type AS k FROM (SELECT DISTINCT level_tier, course_type FROM catalog)
UNION ALL SELECT 'free_and_video', resource_id FROM (SELECT resource_id FROM catalog WHERE is_free = 1 INTERSECT SELECT resource_id FROM catalog WHERE has_video = 1)
UNION ALL SELECT 'paid_not_opening', resource_id FROM (SELECT resource_id FROM catalog WHERE is_free = 0 EXCEPT SELECT resource_id FROM catalog WHERE course_type = 'opening')""")
def u03(spark, sf):
    c = fx.catalog(spark, sf)
    a = c.select("level_tier", "course_type").distinct().select(
        F.lit("distinct_tier_type").alias("kind"), F.concat_ws("/", "level_tier", "course_type").alias("k"))
    b = (c.filter("is_free = 1").select("resource_id").intersect(c.filter("has_video = 1").select("resource_id"))
          .select(F.lit("free_and_video").alias("kind"), F.col("resource_id").alias("k")))
    d = (c.filter("is_free = 0").select("resource_id").join(c.filter("course_type = 'opening'").select("resource_id"),
                                                            "resource_id", "left_anti")
          .select(F.lit("paid_not_opening").alias("kind"), F.col("resource_id").alias("k")))
    return a.unionByName(b).unionByName(d)


@register("l01_l02_top_rated", """
SELECT resource_id, rating_score, price_eur FROM catalog ORDER BY rating_score DESC NULLS LAST, price_eur ASC NULLS LAST, resource_id LIMIT 10""")
def l01(spark, sf):
    c = fx.catalog(spark, sf)
    return finalize(c.orderBy(F.desc_nulls_last("rating_score"), F.asc_nulls_last("price_eur"), "resource_id")
                     .limit(10).select("resource_id", "rating_score", "price_eur"))


@register("l03_largest_smallest_views", """
(SELECT 'largest' AS side, resource_id, views_yt FROM catalog WHERE views_yt IS NOT NULL ORDER BY views_yt DESC, resource_id LIMIT 5)
UNION ALL (SELECT 'smallest', resource_id, views_yt FROM catalog WHERE views_yt IS NOT NULL ORDER BY views_yt ASC, resource_id LIMIT 5)""")
def l03(spark, sf):
    c = fx.catalog(spark, sf).filter(F.col("views_yt").isNotNull())
    big = c.orderBy(F.desc("views_yt"), "resource_id").limit(5).select(F.lit("largest").alias("side"), "resource_id", "views_yt")
    small = c.orderBy("views_yt", "resource_id").limit(5).select(F.lit("smallest").alias("side"), "resource_id", "views_yt")
    return big.unionByName(small)


@register("l04_fixed_category_order", """
WITH d AS (SELECT * FROM (VALUES ('beginner', 0), ('intermediate', 1), ('advanced', 2), ('expert', 3)) v(level_tier, ord))
SELECT d.level_tier, d.ord, count(c.resource_id) AS n FROM d JOIN catalog c USING (level_tier) GROUP BY d.level_tier, d.ord""")
def l04(spark, sf):
    spark_dim = spark.createDataFrame([(t, i) for i, t in enumerate(TIERS4)], "level_tier string, ord int")
    c = fx.catalog(spark, sf)
    return (F.broadcast(spark_dim).join(c, "level_tier").groupBy("level_tier", "ord")
            .agg(F.count("resource_id").alias("n")).orderBy("ord"))
