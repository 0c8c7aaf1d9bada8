"""Registered queries of the text operators (catalog titles, channel messages)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import catalog as C
from ..sources import fixtures as fx
from . import sqltext as Q
from .registry import finalize, register

# ---------------------------------------------------------------- T01-T04
_lt = "lower(title || ' ')"
_tl = "lower(title)"
_UP = (f"{Q.count_contains(_lt, X.UPWARD_SIGNALS_STRICT)} + CASE WHEN {Q.any_contains(_lt, X.COMPLEX_OPENINGS)} AND "
       f"{Q.any_contains(_tl, X.DEPTH_QUALIFIERS)} THEN 1 ELSE 0 END + 2 * {Q.count_contains(_tl, X.UPWARD_SIGNALS_STRICT)}")
_RETIER_SQL = f"""
s AS (SELECT *, {_UP} AS score_up, {Q.count_contains(_lt, X.DOWNWARD_SIGNALS)} AS score_down,
   {Q.count_contains(_lt, X.INTERMEDIATE_ANCHOR_SIGNALS)} AS score_anchor,
   CASE source WHEN 'modern_chess' THEN 3 WHEN 'youtube' THEN 2 WHEN 'manual' THEN 1 ELSE 2 END AS thr,
   CASE WHEN level_tier = 'expert' THEN 'advanced' ELSE level_tier END AS level_tier_original FROM catalog),
s2 AS (SELECT *,
   CASE WHEN level_min IS NULL OR level_max IS NULL THEN NULL WHEN level_min = 1200 AND level_max >= 2800 THEN NULL
        ELSE coalesce(CASE WHEN rf >= 0 AND rf < 1200 THEN 'beginner' WHEN rf >= 1200 AND rf < 1800 THEN 'intermediate'
                           WHEN rf >= 1800 AND rf < 3000 THEN 'advanced' END, 'advanced') END AS tier_range,
   CASE WHEN score_down >= 2 THEN 'beginner' WHEN score_down = 1 AND score_up = 0 THEN 'beginner'
        WHEN score_up >= thr + 1 AND score_anchor = 0 THEN 'advanced' WHEN score_up >= thr AND score_anchor = 0 THEN 'advanced'
        WHEN score_up >= thr AND score_anchor >= 1 THEN 'intermediate' WHEN score_up > 0 AND score_up < thr AND score_anchor = 0
        THEN 'intermediate' END AS tier_text
   FROM (SELECT *, CAST(level_min AS DOUBLE) + (CAST(level_max AS DOUBLE) - level_min) *
         CASE WHEN level_max - level_min > 800 THEN 0.33 ELSE 0.5 END AS rf FROM s) z),
s3 AS (SELECT *, CASE
   WHEN tier_range IS NOT NULL AND tier_text IS NOT NULL THEN CASE WHEN tier_range = tier_text THEN tier_range || '#range+text_agree'
        WHEN score_up >= thr OR score_down >= 2 THEN tier_text || '#text_override' ELSE tier_range || '#range_wins' END
   WHEN tier_range IS NOT NULL THEN tier_range || '#range_only' WHEN tier_text IS NOT NULL THEN tier_text || '#text_only'
   ELSE coalesce(CASE WHEN coalesce(CAST(level_min AS DOUBLE), 1200.0) < 1200 THEN 'beginner'
        WHEN coalesce(CAST(level_min AS DOUBLE), 1200.0) < 1800 THEN 'intermediate'
        WHEN coalesce(CAST(level_min AS DOUBLE), 1200.0) < 3000 THEN 'advanced' END, 'intermediate') || '#fallback_lmin' END AS res FROM s2),
rt AS (SELECT * EXCLUDE (res, level_tier), split_part(res, '#', 1) AS level_tier_new, split_part(res, '#', 2) AS level_tier_source,
   split_part(res, '#', 1) AS level_tier FROM s3)"""


@register("t01_t02_t03_t04_retier_catalog", f"""WITH {_RETIER_SQL}
SELECT resource_id, score_up, score_down, score_anchor, tier_range, tier_text, level_tier_original,
       level_tier_new, level_tier_source FROM rt""")
def t01_t04(spark, sf):
    cat = fx.catalog(spark, sf)
    base = X.with_semantic_scores(cat, "title").withColumn("tier_range", X.tier_from_range("level_min", "level_max")).withColumn(
        "tier_text", X.tier_from_text("score_up", "score_down", "score_anchor", X.promotion_threshold("source")))
    rt = X.recategorize(cat, "title").select("resource_id", "level_tier_original", "level_tier_new", "level_tier_source")
    return base.select("resource_id", "score_up", "score_down", "score_anchor", "tier_range", "tier_text").join(
        rt, "resource_id")


# ---------------------------------------------------------------- T05 / T06
_URL_RE = X.URL_PATTERN.replace("'", "''")


@register("t05_t06_message_urls", f"""
WITH u AS (SELECT msg_id, unnest(regexp_extract_all(text, '{_URL_RE}', 0)) AS url,
                  generate_subscripts(regexp_extract_all(text, '{_URL_RE}', 0), 1) AS pos FROM messages)
SELECT msg_id, CAST(pos - 1 AS INT) AS pos, url,
  {Q.first_case([(f"instr(url, {Q.q(d)}) > 0", Q.q(s)) for d, s in X.COURSE_DOMAINS], "'telegram'")} AS source FROM u""")
def t05(spark, sf):
    m = fx.messages(spark, sf)
    e = m.select("msg_id", F.posexplode(X.extract_urls("text")).alias("pos", "url"))
    return e.withColumn("source", X.source_of_url("url"))


# ---------------------------------------------------------------- T07 / T09-T12
def _msg_level_sql(x):
    lx = f"lower({x})"
    num = f"CASE WHEN regexp_extract({x}, '\\b(\\d{{3,4}})\\s*[-+]?\\s*(\\d{{3,4}})?\\b', 1) <> '' THEN CAST(regexp_extract({x}, '\\b(\\d{{3,4}})\\s*[-+]?\\s*(\\d{{3,4}})?\\b', 1) AS INT) END"
    down, mid, up = (Q.count_contains(lx, X.MSG_BEGINNER_SIGNALS), Q.count_contains(lx, X.MSG_INTERMEDIATE_SIGNALS),
                     Q.count_contains(lx, X.MSG_ADVANCED_SIGNALS))
    return (f"CASE WHEN {num} < 1200 THEN 'beginner' WHEN {num} < 1800 THEN 'intermediate' WHEN {num} IS NOT NULL THEN 'advanced' "
            f"WHEN {down} >= 1 AND {up} = 0 THEN 'beginner' WHEN {up} >= 2 AND {down} = 0 THEN 'advanced' "
            f"WHEN {up} >= 1 AND {mid} >= 1 THEN 'intermediate' WHEN {mid} >= 1 THEN 'intermediate' "
            f"WHEN {up} >= 1 THEN 'advanced' ELSE 'intermediate' END")


def _ctype_sql(x):
    lx = f"lower({x})"
    return Q.first_case([(Q.any_contains(lx, w), Q.q(n)) for n, w in X.MSG_COURSE_TYPES], "'general'")


def _color_sql(x):
    lx = f"lower({x})"
    return Q.first_case([(Q.any_contains(lx, w), Q.q(n)) for n, w in X.COLOR_SIGNALS], "'Both'")


def _fmt_sql(x):
    lx = f"lower(coalesce({x}, ''))"
    return Q.first_case([(f"ends_with({lx}, {Q.q(e)})", Q.q(f)) for e, f in X.FILE_EXTENSIONS], "'unknown'")


def _title_sql(x, url=None):
    clean = f"regexp_replace({Q.strip_ws(f'regexp_replace(coalesce({x}, {Q.q("")}), {Q.q(r"https?://\S+")}, {Q.q("")}, {Q.q("g")})')}, '[#*_`]', '', 'g')"
    lines = f"list_filter(list_transform(string_split({clean}, chr(10)), lambda l: {Q.strip_ws('l')}), lambda l: l <> '')"
    first = f"CASE WHEN len({lines}) > 0 THEN substr({lines}[1], 1, 120) END"
    if url is None:
        return f"coalesce({first}, 'Unknown')"
    slug = f"string_split(regexp_replace(coalesce({url}, ''), '/+$', ''), '/')[-1]"
    words = f"string_split(regexp_replace({slug}, '[-_]', ' ', 'g'), ' ')"
    initcap = f"array_to_string(list_transform({words}, lambda w: upper(substr(w, 1, 1)) || lower(substr(w, 2))), ' ')"
    slug_title = f"CASE WHEN coalesce({url}, '') <> '' THEN substr({initcap}, 1, 120) END"
    return f"coalesce({first}, {slug_title}, 'Unknown')"


@register("t07_t09_t10_t11_t12_message_fields", f"""
SELECT msg_id, {_msg_level_sql('text')} AS level, {_ctype_sql('text')} AS course_type, {_color_sql('text')} AS color,
  {_fmt_sql('file_name')} AS file_format, {_title_sql('text')} AS title FROM messages""")
def t07(spark, sf):
    m = fx.messages(spark, sf)
    return m.select("msg_id", X.level_from_message("text").alias("level"),
                    X.course_type_of_message("text").alias("course_type"), X.color_of_text("text").alias("color"),
                    X.file_format("file_name").alias("file_format"), X.extract_title("text").alias("title"))


# ---------------------------------------------------------------- T08 / T09-card / T10-card / T14 / T17 / T13
def _triple_sql(x):
    lx = f"lower({x})"
    pat = "'(\\d{3,4})\\s*[-]\\s*(\\d{3,4})'"
    lo = f"CASE WHEN regexp_extract({x}, {pat}, 1) <> '' THEN CAST(regexp_extract({x}, {pat}, 1) AS INT) END"
    hi = f"CASE WHEN regexp_extract({x}, {pat}, 2) <> '' THEN CAST(regexp_extract({x}, {pat}, 2) AS INT) END"
    ok = f"({lo} IS NOT NULL AND {lo} >= 500 AND {lo} <= 2800 AND {lo} < {hi})"
    band = (f"CASE WHEN {lo} >= 0 AND {lo} < 1200 THEN 'beginner' WHEN {lo} >= 1200 AND {lo} < 1800 THEN 'intermediate' "
            f"WHEN {lo} >= 1800 AND {lo} < 2300 THEN 'advanced' WHEN {lo} >= 2300 AND {lo} < 3000 THEN 'expert' ELSE 'intermediate' END")
    parts = [(ok, f"{lo}::VARCHAR || '#' || {hi}::VARCHAR || '#' || {band}")]
    for words, a, b, c in X.LEVEL_KEYWORDS:
        parts.append((Q.any_contains(lx, words), Q.q(f"{a}#{b}#{c}")))
    return Q.first_case(parts, "'1200#3000#intermediate'")


@register("t08_t09_t10_t14_card_fields", f"""
WITH c AS (SELECT resource_id, title, openings, {_triple_sql('title')} AS tr FROM catalog)
SELECT resource_id, CAST(split_part(tr, '#', 1) AS INT) AS level_min, CAST(split_part(tr, '#', 2) AS INT) AS level_max,
  split_part(tr, '#', 3) AS level_tier,
  CASE WHEN coalesce(length(openings) > 0, false) OR {Q.any_contains('lower(title)', X.CARD_COURSE_TYPES[0][1])} THEN 'opening'
  {' '.join(f"WHEN {Q.any_contains('lower(title)', w)} THEN {Q.q(n)}" for n, w in X.CARD_COURSE_TYPES[1:])} ELSE 'general' END AS course_type,
  CASE WHEN instr(lower(title), 'for white') > 0 THEN 'White' WHEN instr(lower(title), 'for black') > 0 THEN 'Black' ELSE 'Both' END AS color,
  array_to_string(list_distinct_ordered, '|') AS opening_tags
FROM (SELECT *, list_filter([{', '.join(f"CASE WHEN instr(lower(title), {Q.q(k)}) > 0 THEN {Q.q(n)} END" for k, n in X.OPENING_TAGS)}], lambda x: x IS NOT NULL) AS tags_all FROM c) t,
LATERAL (SELECT list(x ORDER BY i) AS list_distinct_ordered FROM (SELECT x, min(i) AS i FROM
   (SELECT unnest(t.tags_all) AS x, generate_subscripts(t.tags_all, 1) AS i) GROUP BY x)) l""")
def t08(spark, sf):
    c = fx.catalog(spark, sf)
    tr = X.level_triple("title")
    return c.select("resource_id", tr["level_min"].alias("level_min"), tr["level_max"].alias("level_max"),
                    tr["level_tier"].alias("level_tier"), X.course_type_of_card("title", "openings").alias("course_type"),
                    X.color_of_card_title("title").alias("color"),
                    F.array_join(X.opening_tags("title"), "|").alias("opening_tags"))


_dur = r"(\d+(?:\.\d+)?)\s*h(?:\s*and\s*(\d+)\s*min)?|(\d+)\s*min"


@register("t13_t15_t16_t17_derived_fields", f"""
WITH c AS (SELECT resource_id, title, source, duration_min, views_yt,
   'PT' || CAST(duration_min // 60 AS VARCHAR) || 'H' || CAST(duration_min % 60 AS VARCHAR) || 'M' || CAST(coalesce(views_yt, 0) % 60 AS VARCHAR) || 'S' AS iso,
   CASE WHEN duration_min >= 60 THEN CAST(duration_min // 60 AS VARCHAR) || ' h and ' || CAST(duration_min % 60 AS VARCHAR) || ' min'
        ELSE CAST(duration_min AS VARCHAR) || ' min' END AS dur_text,
   CASE CAST(substr(resource_id, 4) AS INT) % 5 WHEN 0 THEN 'GM Alpha, IM Beta' WHEN 1 THEN 'IM Gamma' WHEN 2 THEN 'FM Delta'
        WHEN 3 THEN 'Coach Epsilon' ELSE 'NM Zeta, GM Eta' END AS authors FROM catalog)
SELECT resource_id,
  'mc__' || substr(regexp_replace(lower(title), '[^a-z0-9]', '_', 'g'), 1, 40) AS card_id,
  'tg_' || source || '__' || substr(regexp_replace(lower(title), '[^a-z0-9]', '_', 'g'), 1, 30) || '__' || substr(resource_id, 4) AS msg_id,
  CASE WHEN iso_total > 0 THEN round_even(iso_total, 1) END AS iso_minutes,
  CASE WHEN regexp_extract(dur_text, '{_dur}', 3) <> '' THEN CAST(regexp_extract(dur_text, '{_dur}', 3) AS DOUBLE)
       WHEN regexp_extract(dur_text, '{_dur}', 1) <> '' THEN CAST(regexp_extract(dur_text, '{_dur}', 1) AS DOUBLE) * 60
            + coalesce(CASE WHEN regexp_extract(dur_text, '{_dur}', 2) <> '' THEN CAST(regexp_extract(dur_text, '{_dur}', 2) AS DOUBLE) END, 0.0) END AS text_minutes,
  {Q.first_case([(f"instr(authors, {Q.q(t)}) > 0", Q.q(t)) for t in X.AUTHOR_TITLES], "''")} AS author_title
FROM (SELECT *, coalesce(CAST(nullif(regexp_extract(iso, '(\\d+)H', 1), '') AS DOUBLE), 0.0) * 60
   + coalesce(CAST(nullif(regexp_extract(iso, '(\\d+)M', 1), '') AS DOUBLE), 0.0)
   + coalesce(CAST(nullif(regexp_extract(iso, '(\\d+)S', 1), '') AS DOUBLE), 0.0) / 60 AS iso_total FROM c) z""")
def t13(spark, sf):
    c = fx.catalog(spark, sf)
    d = F.col("duration_min")
    c = (c.withColumn("iso", F.concat(F.lit("PT"), F.floor(d / 60).cast("string"), F.lit("H"), (d % 60).cast("string"),
                                      F.lit("M"), (F.coalesce(F.col("views_yt"), F.lit(0)) % 60).cast("string"), F.lit("S")))
          .withColumn("dur_text", F.when(d >= 60, F.concat(F.floor(d / 60).cast("string"), F.lit(" h and "),
                                                           (d % 60).cast("string"), F.lit(" min")))
                      .otherwise(F.concat(d.cast("string"), F.lit(" min"))))
          .withColumn("__k", F.substring("resource_id", 4, 20).cast("int"))
          .withColumn("authors", F.when(F.col("__k") % 5 == 0, "GM Alpha, IM Beta").when(F.col("__k") % 5 == 1, "IM Gamma")
                      .when(F.col("__k") % 5 == 2, "FM Delta").when(F.col("__k") % 5 == 3, "Coach Epsilon")
                      .otherwise("NM Zeta, GM Eta")))
    return finalize(c.select(
        "resource_id", X.slug_id(F.lit("mc"), "title", 40).alias("card_id"),
        F.concat(F.lit("tg_"), X.slug_id(F.col("source"), "title", 30, F.substring("resource_id", 4, 20))).alias("msg_id"),
        X.iso_duration_minutes("iso").alias("iso_minutes"), X.text_duration_minutes("dur_text").alias("text_minutes"),
        X.author_title("authors").alias("author_title")))


# ---------------------------------------------------------------- T18-T23 / T24
def _msg_resources_sql():
    lvl = _msg_level_sql("text")
    lvl_f = _msg_level_sql("(title || ' ' || text)")
    up, down, anc = (Q.count_contains("lower(text)", X.MSG_ADVANCED_SIGNALS), Q.count_contains("lower(text)", X.MSG_BEGINNER_SIGNALS),
                     Q.count_contains("lower(text)", X.MSG_INTERMEDIATE_SIGNALS))
    ttx = "lower(title || ' ' || text)"
    upf, downf, ancf = (Q.count_contains(ttx, X.MSG_ADVANCED_SIGNALS), Q.count_contains(ttx, X.MSG_BEGINNER_SIGNALS),
                        Q.count_contains(ttx, X.MSG_INTERMEDIATE_SIGNALS))
    src = Q.first_case([(f"instr(url, {Q.q(d)}) > 0", Q.q(s)) for d, s in X.COURSE_DOMAINS], "'telegram'")
    return f"""
mm AS (SELECT * FROM messages WHERE sent_on >= DATE '2022-01-01'),
ue AS (SELECT msg_id, sent_on, text, unnest(regexp_extract_all(text, '{_URL_RE}', 0)) AS url,
              generate_subscripts(regexp_extract_all(text, '{_URL_RE}', 0), 1) AS pos FROM mm),
ur AS (SELECT *, {src} AS source, {_title_sql('text', 'url')} AS title FROM ue),
urr AS (SELECT 'tg_' || source || '__' || substr(regexp_replace(lower(title), '[^a-z0-9]', '_', 'g'), 1, 30) || '__' || CAST(msg_id AS VARCHAR) AS resource_id,
   source, title, url, CASE WHEN source = 'youtube' THEN 'video' ELSE 'interactive' END AS format, {_ctype_sql('text')} AS course_type,
   {_color_sql('text')} AS color, {lvl} AS level_tier, 0 AS is_free, CASE WHEN source = 'youtube' THEN 1 ELSE 0 END AS has_video,
   0 AS has_pgn, sent_on AS pub_date, {up} AS score_up, {down} AS score_down, {anc} AS score_anchor, msg_id, 0 AS branch, pos
   FROM ur WHERE source <> 'telegram'),
fe AS (SELECT *, {_fmt_sql('file_name')} AS fmt FROM mm WHERE coalesce(file_name, '') <> ''),
fe2 AS (SELECT *, {_title_sql("CASE WHEN text <> '' THEN text ELSE replace(replace(file_name, '_', ' '), '-', ' ') END")} AS title FROM fe WHERE fmt <> 'unknown'),
frr AS (SELECT 'tg_tg_file__' || substr(regexp_replace(lower(file_name), '[^a-z0-9]', '_', 'g'), 1, 30) || '__' || CAST(msg_id AS VARCHAR) AS resource_id,
   'telegram_file' AS source, title, 'telegram://msg/' || CAST(msg_id AS VARCHAR) AS url, fmt AS format,
   {_ctype_sql("(title || ' ' || text)")} AS course_type, {_color_sql("(title || ' ' || text)")} AS color, {lvl_f} AS level_tier,
   1 AS is_free, 0 AS has_video, CASE WHEN fmt = 'pgn' THEN 1 ELSE 0 END AS has_pgn, sent_on AS pub_date,
   {upf} AS score_up, {downf} AS score_down, {ancf} AS score_anchor, msg_id, 1 AS branch, 0 AS pos FROM fe2),
allr AS (SELECT * FROM urr UNION ALL SELECT * FROM frr),
res AS (SELECT * EXCLUDE (rn, msg_id, branch, pos) FROM (SELECT *, row_number() OVER (PARTITION BY resource_id ORDER BY msg_id DESC, branch, pos) AS rn FROM allr) WHERE rn = 1)"""


_MSGRES_COLS = ("resource_id, source, title, url, format, course_type, color, level_tier, is_free, has_video, has_pgn, "
                "pub_date, score_up, score_down, score_anchor")


@register("t18_i05_message_resources", f"WITH {_msg_resources_sql()} SELECT {_MSGRES_COLS} FROM res")
def t18(spark, sf):
    return C.message_resources(fx.messages(spark, sf)).select(*[c.strip() for c in _MSGRES_COLS.split(",")])


def _noise_sql(x):
    t = f"lower({Q.strip_ws(x)})"
    return "(" + f"{x} IS NULL OR " + " OR ".join(f"regexp_matches({t}, {Q.q('(?i)' + p)})" for p in X.NOISE_PATTERNS) + ")"


@register("t19_t20_t21_t22_t23_clean_channel", f"""WITH {_msg_resources_sql()},
f1 AS (SELECT * FROM res WHERE NOT {_noise_sql('title')}),
f2 AS (SELECT * FROM f1 WHERE coalesce(starts_with(url, 'telegram://') OR regexp_matches(url, '^https?://'), false)),
f3 AS (SELECT *, regexp_replace(regexp_replace(lower({Q.strip_ws("coalesce(title, '')")}), '[^a-z0-9\\s]', '', 'g'), '\\s+', ' ', 'g') AS norm FROM f2),
f4 AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY norm ORDER BY resource_id) AS rn FROM f3) WHERE rn = 1),
f5 AS (SELECT * EXCLUDE (title, level_tier), {Q.strip_ws("regexp_replace(regexp_replace(regexp_replace(title, '(?i)\\.(pdf|pgn|zip|cbv|epub|cbz)$', ''), '^[\\x{10000}-\\x{10FFFF}\\x{2600}-\\x{26FF}\\x{2700}-\\x{27BF}\\s]+', ''), '\\s+', ' ', 'g')")} AS title,
   CASE WHEN level_tier = 'beginner' AND score_down = 0 THEN 'intermediate' ELSE level_tier END AS level_tier FROM f4)
SELECT resource_id, title, level_tier, norm FROM f5""")
def t19(spark, sf):
    res = C.message_resources(fx.messages(spark, sf))
    return C.clean_channel(res, order_col="resource_id").select("resource_id", "title", "level_tier", "norm")


@register("t24_beginner_feed", f"""
SELECT resource_id, title FROM catalog WHERE {Q.any_contains('lower(title)', X.FEED_BEGINNER_SIGNALS)}""")
def t24(spark, sf):
    c = fx.catalog(spark, sf)
    return c.filter(X.is_beginner_text("title")).select("resource_id", "title")


@register("t01_t05_t14_documents_volume", f"""
WITH d AS (SELECT doc_id, lower(text) AS lt FROM documents)
SELECT doc_id, len(regexp_extract_all(lt, '{_URL_RE}', 0)) AS n_urls,
  {Q.count_contains('lt', X.UPWARD_SIGNALS_STRICT)} AS up_signals, {Q.count_contains('lt', X.DOWNWARD_SIGNALS)} AS down_signals,
  {Q.count_contains('lt', X.INTERMEDIATE_ANCHOR_SIGNALS)} AS anchor_signals,
  {Q.count_contains('lt', [k for k, _ in X.OPENING_TAGS])} AS opening_keywords FROM d""")
def t01_docs(spark, sf):
    # whole texts of every document: keyword counts and URL extraction
    from ..sources.tables import read_table
    d = read_table(spark, sf, "documents", ["doc_id", "text"]).withColumn("lt", F.lower("text"))
    lt = F.col("lt")
    return d.select("doc_id", F.size(X.extract_urls(lt)).alias("n_urls"),
                    X.count_contains(lt, X.UPWARD_SIGNALS_STRICT).alias("up_signals"),
                    X.count_contains(lt, X.DOWNWARD_SIGNALS).alias("down_signals"),
                    X.count_contains(lt, X.INTERMEDIATE_ANCHOR_SIGNALS).alias("anchor_signals"),
                    X.count_contains(lt, [k for k, _ in X.OPENING_TAGS]).alias("opening_keywords"))
