"""Catalogue operators: channel ingestion, cleaning, profiling, feature
preparation, merge (T18-T23, P21-P25, A15-A30, U01-U06).

Profiling aggregates are single-pass grouped aggregations; wide reports are
unpivoted with ``stack`` so the number of output columns never depends on the
data. Pivots are given their value domain explicitly (no hidden extra job to
discover it).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalar as S
from ..functions import text as X
from .common import attach_scalars, attach_values, exact_quantiles, keep_first

CATALOG_SCHEMA_COLS = [
    "resource_id", "source", "title", "url", "resource_type", "format", "course_type", "openings", "color", "author",
    "author_title", "level_min", "level_max", "level_tier", "duration_min", "price_eur", "is_free", "has_video",
    "has_pgn", "has_exercises", "has_spaced_rep", "rating_score", "n_reviews", "views_yt", "pub_date", "description",
    "tags", "level_tier_original", "level_tier_new", "level_tier_source", "score_up", "score_down", "score_anchor",
]


def message_resources(messages: DataFrame, min_date: str = "2022-01-01") -> DataFrame:
    """The resource rows of messages deduplicated by resource id (first = newest
    message, URLs before the attachment, URLs in text order)."""
    return keep_first(message_rows(messages, min_date), ["resource_id"], message_order()).drop("msg_id", "branch", "pos")


def message_order() -> list[F.Column]:
    """Which of a resource's rows comes first."""
    return [-F.col("msg_id"), F.col("branch"), F.col("pos")]


def message_rows(messages: DataFrame, min_date: str = "2022-01-01") -> DataFrame:
    """One resource row per recognised URL plus one per recognised
    attachment. Stateless per message, so the same function runs on a stream."""
    # text materialised once (its fixture expression is not re-planned per keyword test)
    m = messages.filter(F.col("sent_on") >= F.lit(min_date).cast("date")).withColumn("__low", F.lower(F.col("text")))
    low = F.col("__low")
    u = m.select("msg_id", "sent_on", "text", "__low", F.posexplode(X.extract_urls("text")).alias("pos", "url"))
    u = u.withColumn("source", X.source_of_url("url")).filter(F.col("source") != "telegram")
    u = u.withColumn("title", X.extract_title("text", "url"))
    urls = u.select(
        F.concat(F.lit("tg_"), X.slug_id(F.col("source"), "title", 30, F.col("msg_id"))).alias("resource_id"),
        "source", "title", "url",
        F.when(F.col("source") == "youtube", "video").otherwise("interactive").alias("format"),
        X.course_type_of_message("text").alias("course_type"), X.color_of_text("text").alias("color"),
        X.level_from_message("text").alias("level_tier"), F.lit(0).alias("is_free"),
        F.when(F.col("source") == "youtube", 1).otherwise(0).alias("has_video"), F.lit(0).alias("has_pgn"),
        F.col("sent_on").alias("pub_date"),
        X.count_contains(low, X.MSG_ADVANCED_SIGNALS).alias("score_up"),
        X.count_contains(low, X.MSG_BEGINNER_SIGNALS).alias("score_down"),
        X.count_contains(low, X.MSG_INTERMEDIATE_SIGNALS).alias("score_anchor"),
        "msg_id", F.lit(0).alias("branch"), "pos")
    f = m.filter(F.coalesce(F.col("file_name"), F.lit("")) != "").withColumn("fmt", X.file_format("file_name"))
    f = f.filter(F.col("fmt") != "unknown")
    base_text = F.when(F.col("text") != "", F.col("text")).otherwise(
        F.replace(F.replace(F.col("file_name"), F.lit("_"), F.lit(" ")), F.lit("-"), F.lit(" ")))
    f = f.withColumn("title", X.extract_title(base_text))
    f = f.withColumn("__tt", F.concat(F.col("title"), F.lit(" "), F.col("text")))
    tt = F.col("__tt")
    files = f.select(
        F.concat(F.lit("tg_"), X.slug_id(F.lit("tg_file"), "file_name", 30, F.col("msg_id"))).alias("resource_id"),
        F.lit("telegram_file").alias("source"), "title",
        F.concat(F.lit("telegram://msg/"), F.col("msg_id").cast("string")).alias("url"), F.col("fmt").alias("format"),
        X.course_type_of_message(tt).alias("course_type"), X.color_of_text(tt).alias("color"),
        X.level_from_message(tt).alias("level_tier"), F.lit(1).alias("is_free"), F.lit(0).alias("has_video"),
        F.when(F.col("fmt") == "pgn", 1).otherwise(0).alias("has_pgn"), F.col("sent_on").alias("pub_date"),
        X.count_contains(F.lower(tt), X.MSG_ADVANCED_SIGNALS).alias("score_up"),
        X.count_contains(F.lower(tt), X.MSG_BEGINNER_SIGNALS).alias("score_down"),
        X.count_contains(F.lower(tt), X.MSG_INTERMEDIATE_SIGNALS).alias("score_anchor"),
        "msg_id", F.lit(1).alias("branch"), F.lit(0).alias("pos"))
    return urls.unionByName(files)


def clean_channel(res: DataFrame, order_col: str = "resource_id") -> DataFrame:
    """Drop noise titles and invalid URLs, dedupe on the normalised
    title (keep first by ``order_col``), clean titles, correct false beginners."""
    r = res.filter(~X.is_noise_title("title")).filter(X.is_valid_url("url"))
    r = r.withColumn("norm", X.normalized_title("title"))
    r = keep_first(r, ["norm"], [F.col(order_col)])
    r = r.withColumn("title", X.clean_title("title"))
    return r.withColumn("level_tier", F.when((F.col("level_tier") == "beginner") & (F.col("score_down") == 0),
                                             "intermediate").otherwise(F.col("level_tier")))


def base_features(cat: DataFrame) -> DataFrame:
    """Richness (sum of four has_* flags, NULL = 0), level range, is_opening."""
    return (cat.withColumn("richness", S.richness("has_video", "has_pgn", "has_exercises", "has_spaced_rep"))
               .withColumn("level_range", F.col("level_max") - F.col("level_min"))
               .withColumn("is_opening", (F.col("course_type") == "opening").cast("int")))


# Ordinal of the tiers.
TIER_ORDER = {"beginner": 0, "intermediate": 1, "advanced": 2, "expert": 3}


def skew_transforms(cat: DataFrame) -> DataFrame:
    """log1p(duration or median), log10(views or 1) + 1... as in the catalogue
    preparation: duration/rating NULL <- median (exact), views NULL <- 1 then log10(x+1),
    price NULL <- 0 then log1p; tier ordinal."""
    med = exact_quantiles(cat, ["duration_min", "rating_score"], [0.5])
    c = attach_values(cat, {"__md": med["duration_min"][0], "__mr": med["rating_score"][0]})
    tier = F.create_map(*[x for kv in TIER_ORDER.items() for x in (F.lit(kv[0]), F.lit(kv[1]))])
    return (c.withColumn("log_duration", F.log1p(F.coalesce(F.col("duration_min").cast("double"), F.col("__md"))))
             .withColumn("log_views", F.log10(F.coalesce(F.col("views_yt").cast("double"), F.lit(1.0)) + 1))
             .withColumn("log_price", F.log1p(F.coalesce(F.col("price_eur"), F.lit(0.0))))
             .withColumn("rating_filled", F.coalesce(F.col("rating_score"), F.col("__mr")))
             .withColumn("tier_enc", tier[F.col("level_tier")])
             .drop("__md", "__mr"))


#: A column with more values than this is not turned into columns.
MAX_DOMAIN = 1000


def domain_of(df: DataFrame, col: str) -> list[str]:
    """The distinct non-null values of a category column, sorted; an error above ``MAX_DOMAIN`` values, for
    which ``crosstabs`` has the long form."""
    found = df.select(F.col(col).cast("string")).filter(F.col(col).isNotNull()).distinct().limit(MAX_DOMAIN + 1).collect()
    if len(found) > MAX_DOMAIN:
        raise ValueError(f"{col} has more than {MAX_DOMAIN} values")
    return sorted(r[0] for r in found)


def one_hot(df: DataFrame, col: str, domain: list[str] | None = None, prefix: str | None = None) -> DataFrame:
    """Dummy columns over the values of the data, or an explicit domain (NULL -> all zeros)."""
    p = prefix or col
    domain = domain_of(df, col) if domain is None else domain
    return df.withColumns({f"{p}_{v}": (F.col(col) == v).cast("int") for v in domain}).fillna(
        0, subset=[f"{p}_{v}" for v in domain])


def minmax_scale(df: DataFrame, cols: list[str]) -> DataFrame:
    """(x - min) / (max - min) over non-null values; constant column -> 0."""
    st = df.agg(*[F.min(c).alias(f"__mn_{c}") for c in cols], *[F.max(c).alias(f"__mx_{c}") for c in cols])
    out = attach_scalars(df, st)
    for c in cols:
        rng = F.col(f"__mx_{c}") - F.col(f"__mn_{c}")
        out = out.withColumn(f"{c}_mm", F.when(rng == 0, F.lit(0.0)).otherwise((F.col(c) - F.col(f"__mn_{c}")) / rng))
    return out.drop(*[f"__mn_{c}" for c in cols], *[f"__mx_{c}" for c in cols])


def zscore(df: DataFrame, cols: list[str], ddof: int = 1) -> DataFrame:
    """P24 (z form): (x - mean) / std, std with ``ddof``; std 0 -> divide by 1."""
    sd = F.stddev_samp if ddof == 1 else F.stddev_pop
    st = df.agg(*[F.avg(c).alias(f"__mu_{c}") for c in cols], *[sd(c).alias(f"__sd_{c}") for c in cols])
    out = attach_scalars(df, st)
    for c in cols:
        s = F.when((F.col(f"__sd_{c}") == 0) | F.col(f"__sd_{c}").isNull(), F.lit(1.0)).otherwise(F.col(f"__sd_{c}"))
        out = out.withColumn(f"{c}_z", (F.col(c) - F.col(f"__mu_{c}")) / s)
    return out.drop(*[f"__mu_{c}" for c in cols], *[f"__sd_{c}" for c in cols])


def null_profile(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Percentage of NULL per column (one pass) unpivoted; bucket >90 / 10-90 / <10."""
    cols = cols or df.columns
    one = df.agg(*[(F.avg(F.col(c).isNull().cast("double")) * 100).alias(c) for c in cols])
    stack = "stack({n}, {args}) as (column_name, pct_null)".format(
        n=len(cols), args=", ".join(f"'{c}', `{c}`" for c in cols))
    out = one.selectExpr(stack)
    return out.withColumn("bucket", F.when(F.col("pct_null") > 90, ">90").when(F.col("pct_null") >= 10, "10-90")
                          .otherwise("<10"))


def category_frequencies(df: DataFrame, cols: list[str]) -> DataFrame:
    """Value counts of several columns in one pass (unpivot + count)."""
    stack = "stack({n}, {args}) as (column_name, value)".format(
        n=len(cols), args=", ".join(f"'{c}', CAST(`{c}` AS STRING)" for c in cols))
    return df.selectExpr(stack).groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))


def pivot_counts(df: DataFrame, row: str, col: str, domain: list[str] | None = None) -> DataFrame:
    """Crosstab counts over the values of the data, or an explicit domain, missing -> 0."""
    domain = domain_of(df, col) if domain is None else domain
    return df.groupBy(row).pivot(col, domain).count().fillna(0)


def crosstabs(df: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """The cells of several crosstabs that hold rows, in long form (no column a value), in one pass."""
    stack = "stack({n}, {args}) as (crosstab, row_value, col_value)".format(
        n=len(pairs), args=", ".join(f"'{a} x {b}', CAST(`{a}` AS STRING), CAST(`{b}` AS STRING)" for a, b in pairs))
    return df.selectExpr(stack).groupBy("crosstab", "row_value", "col_value").agg(F.count(F.lit(1)).alias("n"))


def row_percent(pivot: DataFrame, row: str, domain: list[str] | None = None) -> DataFrame:
    """Row-normalised crosstab: round(count/total, 3) * 100."""
    domain = [c for c in pivot.columns if c != row] if domain is None else domain
    total = sum((F.col(f"`{d}`") for d in domain), F.lit(0))
    return pivot.select(row, *[(F.round(F.col(f"`{d}`") / total, 3) * 100).alias(d) for d in domain])


def crosstab_margins(df: DataFrame, a: str, b: str) -> DataFrame:
    """Counts of (a, b) with 'All' margins via CUBE."""
    c = df.cube(a, b).agg(F.count(F.lit(1)).alias("n"), F.grouping(a).alias("ga"), F.grouping(b).alias("gb"))
    return c.select(F.when(F.col("ga") == 1, "All").otherwise(F.col(a)).alias(a),
                    F.when(F.col("gb") == 1, "All").otherwise(F.col(b)).alias(b), "n")


def explode_openings(cat: DataFrame, col: str = "openings") -> DataFrame:
    """A20 helper: one row per trimmed non-empty label of a pipe list."""
    e = cat.select("resource_id", F.explode(F.split(F.col(col), r"\|")).alias("opening"))
    return e.withColumn("opening", F.trim("opening")).filter(F.col("opening") != "")


def opening_label_counts(cat: DataFrame) -> DataFrame:
    """Count per opening label."""
    return explode_openings(cat).groupBy("opening").agg(F.count(F.lit(1)).alias("n"))


def retier_report(before: DataFrame, after: DataFrame, key: str = "level_tier") -> DataFrame:
    """Counts per tier before / after / diff (full outer join by tier)."""
    b = before.groupBy(key).agg(F.count(F.lit(1)).alias("n_before"))
    a = after.groupBy(key).agg(F.count(F.lit(1)).alias("n_after"))
    j = b.join(a, key, "full")
    return (j.fillna(0, ["n_before", "n_after"])
             .withColumn("diff", F.col("n_after") - F.col("n_before")))


def distribution_vs_targets(df: DataFrame, targets: dict[str, float], key: str = "level_tier") -> DataFrame:
    """Count, %, target and OK/LOW per tier of an explicit tier list.

    One conditional-count pass unpivoted with ``stack`` (no join back to a
    tier dimension, so no constraint is pushed into the tier expression).
    """
    names = list(targets)
    one = df.agg(F.count(F.lit(1)).alias("__total"),
                 *[F.count(F.when(F.col(key) == t, 1)).alias(f"__n{i}") for i, t in enumerate(names)])
    stack = "stack({n}, {a}) as ({k}, target, n)".format(
        n=len(names), k=key, a=", ".join(f"'{t}', CAST({targets[t]} AS DOUBLE), __n{i}" for i, t in enumerate(names)))
    r = one.selectExpr("__total", stack)
    pct = F.col("n") / F.col("__total") * 100
    return (r.withColumn("pct", pct).withColumn("status", F.when(pct >= F.col("target"), "OK").otherwise("LOW"))
             .drop("__total"))


def align_schema(df: DataFrame, cols: list[str], like: DataFrame | None = None) -> DataFrame:
    """Add missing columns as NULL, drop extra ones, fixed order.

    A missing column gets the type it has in ``like`` (string without one)."""
    present = set(df.columns)
    kind = {f.name: f.dataType for f in like.schema.fields} if like is not None else {}
    return df.select(*[F.col(c) if c in present else F.lit(None).cast(kind.get(c, "string")).alias(c) for c in cols])


def merge_catalogues(current: DataFrame, incoming: DataFrame, cols: list[str], key: str = "resource_id") -> DataFrame:
    """New ids (anti join) aligned to the current schema, appended, deduped
    by id (current rows win)."""
    cur = align_schema(current, cols, incoming).withColumn("__src", F.lit(0))
    new = align_schema(incoming, cols, current).join(current.select(key), key, "left_anti").withColumn("__src", F.lit(1))
    both = cur.unionByName(new)
    return keep_first(both, [key], [F.col("__src")]).drop("__src")
