"""Loads, incremental appends and sinks."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as X
from ..operators.common import keep_first

GAME_REQUIRED = ["game_id", "player", "rating", "opening", "color", "theory_depth", "acl", "score"]


def validated_load(df: DataFrame, required: list[str] = GAME_REQUIRED, order_col: str = "ingest_seq") -> DataFrame:
    """Fail on missing columns; drop rows with NULL id / rating / acl; keep
    the first row per id; rating to int; non-numeric acl -> NULL -> dropped."""
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"missing columns: {missing}")
    d = df.filter(F.col("game_id").isNotNull() & F.col("rating").isNotNull() & F.col("acl").isNotNull())
    d = keep_first(d, ["game_id"], [F.col(order_col)])
    d = d.withColumn("rating", F.col("rating").cast("int"))
    d = d.withColumn("acl", F.col("acl").cast("string").try_cast("double"))
    return d.filter(F.col("acl").isNotNull())


def incremental_append(new: DataFrame, old: DataFrame, key: str = "game_id", order_col: str = "ingest_seq") -> DataFrame:
    """``old`` plus the rows of ``new`` whose key is not known yet (first
    row per key inside the batch). Idempotent: appending the same batch twice
    equals appending it once."""
    fresh = keep_first(new, [key], [F.col(order_col)]).join(old.select(key), key, "left_anti")
    return old.unionByName(fresh.select(*old.columns))


def newest_per_player(games: DataFrame, n: int = 200, ts_col: str = "played_at") -> DataFrame:
    """Newest ``n`` games per player. ``row_number() <= n`` is planned with
    a map-side WindowGroupLimit, so a very active player ships at most ``n``
    rows per map task to the final ranking."""
    w = Window.partitionBy("player").orderBy(F.col(ts_col).desc(), F.col("game_id").desc())
    return games.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") <= n).drop("__rn")


def write_versioned(df: DataFrame, base: str, mode: str = "overwrite") -> str:
    """Write to a fresh version directory (the commit protocol makes it
    atomic); readers switch to the newest complete version."""
    version = _dt.datetime.now(_dt.timezone.utc).strftime("v%Y%m%dT%H%M%S%f")
    path = f"{base.rstrip('/')}/{version}"
    df.write.mode(mode).parquet(path)
    return path


def newest_version(spark: SparkSession, base: str) -> str | None:
    """The newest version of :func:`write_versioned` that has Spark's ``_SUCCESS`` mark."""
    p = spark._jvm.org.apache.hadoop.fs.Path(base)
    store = p.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [f.getPath().getName() for f in store.listStatus(p)] if store.exists(p) else []
    done = [n for n in sorted(names) if n.startswith("v") and store.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{base}/{n}/_SUCCESS"))]
    return f"{base.rstrip('/')}/{done[-1]}" if done else None


def read_newest(spark: SparkSession, base: str) -> DataFrame:
    """The newest complete version."""
    path = newest_version(spark, base)
    if path is None:
        raise FileNotFoundError(f"no complete version under {base}")
    return spark.read.parquet(path)


def write_snapshot(df: DataFrame, base: str, label: str) -> str:
    """Timestamped snapshot partition ``snapshot_ts=..`` under ``base``."""
    ts = _dt.datetime.now(_dt.timezone.utc).strftime("%Y%m%dT%H%M%S%f")
    df.withColumn("snapshot_ts", F.lit(f"{label}_{ts}")).write.mode("append").partitionBy("snapshot_ts").parquet(base)
    return base


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Long-table sink (Parquet)."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


_PERF_SCHEMA = "perfs struct<blitz: struct<rating: int>, rapid: struct<rating: int>, classical: struct<rating: int>, bullet: struct<rating: int>>"


def reference_rating(df: DataFrame, json_col: str = "profile") -> DataFrame:
    """Reference rating from a nested profile: blitz if > 0 else rapid
    (variants: else classical; else bullet); players without any positive rating are skipped."""
    p = df.withColumn("__p", F.from_json(F.col(json_col), _PERF_SCHEMA))

    def r(kind):
        return F.nullif(F.col(f"__p.perfs.{kind}.rating"), F.lit(0))
    d = (p.withColumn("ref_rating", F.coalesce(r("blitz"), r("rapid")))
          .withColumn("ref_rating_classical", F.coalesce(r("blitz"), r("rapid"), r("classical")))
          .withColumn("ref_rating_bullet", F.coalesce(r("blitz"), r("rapid"), r("bullet"))))
    return d.filter(F.coalesce("ref_rating_classical", "ref_rating_bullet").isNotNull()).drop("__p")


def page_cards(pages: DataFrame) -> DataFrame:
    """Course-card fields of raw pages: title, heading, first paragraph
    (tags stripped, <= 300 chars), number of distinct links, video flag, colour."""
    h = F.col("html")
    heading = F.regexp_extract(h, "<h1>(.*?)</h1>", 1)
    par = F.regexp_replace(F.regexp_extract(h, "<p>(.*?)</p>", 1), "<[^>]+>", "")
    par = F.substring(F.regexp_replace(par, r"^\s+|\s+$", ""), 1, 300)
    links = F.array_distinct(F.regexp_extract_all(h, F.lit('<a href="([^"]+)"'), 1))
    hl = F.lower(heading)
    color = F.when(F.instr(hl, "for white") > 0, "White").when(F.instr(hl, "for black") > 0, "Black").otherwise("Both")
    return pages.select("page_id", F.regexp_extract(h, "<title>(.*?)</title>", 1).alias("title"), heading.alias("heading"),
                        par.alias("first_paragraph"), F.size(links).alias("n_links"),
                        F.when(F.instr(h, "Video Content") > 0, 1).otherwise(0).alias("has_video"), color.alias("color"))


def course_cards(pages: DataFrame, heading_tag: str = "h2", link_part: str = "/course/", id_prefix: str = "mc", source: str = "modern_chess",
                 description_chars: int = 300) -> DataFrame:
    """S07 in full: one course card per page that has a heading and a course link.

    Heading, course link and slug, openings named by ``opening=`` links, colour and course type by the
    title, authors by ``/author/`` links and their title, duration, four feature flags, level triple and
    description from the text. ``link_part`` may be empty: then the first link of the page counts.
    """
    h = F.col("html")

    def plain(x):
        return F.trim(F.regexp_replace(F.regexp_replace(x, "<[^>]*>", ""), r"\s+", " "))
    heading = plain(F.regexp_extract(h, f"(?s)<{heading_tag}[^>]*>(.*?)</{heading_tag}>", 1))
    link = F.regexp_extract(h, f'<a [^>]*href="([^"]*{link_part}[^"]*)"', 1)
    named = F.regexp_extract_all(h, F.lit(r'<a [^>]*href="[^"]*opening=([^&"]+)'), 1)
    authors = F.transform(F.regexp_extract_all(h, F.lit(r'(?s)<a [^>]*href="[^"]*/author/[^"]*"[^>]*>(.*?)</a>'), 1), plain)
    d = pages.select("page_id", h.alias("html"), heading.alias("title"), link.alias("url"), F.regexp_replace(h, "<[^>]*>", " ").alias("text"),
                     F.array_join(F.array_distinct(F.transform(named, lambda x: F.replace(x, F.lit("+"), F.lit(" ")))), "|").alias("openings"),
                     F.array_join(authors, ", ").alias("author"))
    d = d.filter((F.col("title") != "") & (F.col("url") != ""))
    slug = F.regexp_extract("url", "/course/([^/]+)/", 1)
    flags = {"has_video": "Video Content", "has_pgn": "PGN Download", "has_exercises": "Interactive Tests", "has_spaced_rep": "Memory Booster"}
    d = d.withColumns({k: F.contains(F.col("text"), F.lit(v)).cast("int") for k, v in flags.items()}).withColumn("tr", X.level_triple("text"))
    return d.select("page_id", X.slug_id(F.lit(id_prefix), F.when(slug != "", slug).otherwise(F.substring("title", 1, 30)), 60).alias("resource_id"), F.lit(source).alias("source"),
                    "title", "url", F.when(F.col("has_video") == 1, "video").otherwise("interactive").alias("format"),
                    X.course_type_of_card("title", "openings").alias("course_type"), "openings", X.color_of_card_title("title").alias("color"),
                    "author", X.author_title("author").alias("author_title"), "tr.level_min", "tr.level_max", "tr.level_tier",
                    X.text_duration_minutes("text").alias("duration_min"), *flags,
                    F.substring(plain(F.regexp_extract("html", "(?s)<p[^>]*>(.*?)</p>", 1)), 1, description_chars).alias("description"))


def search_links(pages: DataFrame, n: int = 3) -> DataFrame:
    """Link ids and titles of a result page zipped (padded), ids deduplicated
    keeping the first position, capped at n, plus a generic search link when
    fewer than n were found."""
    ids = F.regexp_extract_all(F.col("html"), F.lit('<a href="/([^"]+)">'), 1)
    titles = F.regexp_extract_all(F.col("html"), F.lit('<a href="/[^"]+">([^<]*)</a>'), 1)
    z = pages.select("page_id", F.posexplode(F.arrays_zip(ids.alias("i"), titles.alias("t"))).alias("pos", "z"))
    z = z.select("page_id", "pos", F.col("z.i").alias("link_id"), F.col("z.t").alias("link_title"))
    first = z.groupBy("page_id", "link_id").agg(F.min_by("link_title", "pos").alias("link_title"), F.min("pos").alias("pos"))
    w = Window.partitionBy("page_id").orderBy("pos")
    top = first.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n).drop("pos")
    k = top.groupBy("page_id").agg(F.count(F.lit(1)).alias("k"))
    fill = (pages.select("page_id").join(k, "page_id", "left").withColumn("k", F.coalesce("k", F.lit(0)))
            .filter(F.col("k") < n)
            .select("page_id", (F.col("k") + 1).cast("int").alias("rank"), F.lit("search").alias("link_id"),
                    F.lit("Search").alias("link_title")))
    return top.select("page_id", "rank", "link_id", "link_title").unionByName(fill)


PGN_TAGS = ["Event", "Site", "White", "Black", "Result", "Opening"]


#: Tokens of a move text: brace comment, rest-of-line comment, escaped line, bracket of a variation, glyph number, word.
MOVE_TOKEN = r"\{[^}]*(?:\}|$)|;[^\n]*|(?m:^%[^\n]*)|[()]|\$\d*|[^\s(){};$]+"


def main_line(movetext: F.Column) -> F.Column:
    """The moves of a game's main line, in order, of a PGN move text over any number of lines.

    A fold over the tokens carries the depth of the open variations; words at depth 0 are moves once move
    numbers (``3.``, ``3...``, ``3.e4``), annotation marks (``!?``) and the result are taken off. Comments, glyphs and
    variations, however nested, give nothing; an unclosed comment runs to the end.
    """
    tokens = F.regexp_extract_all(movetext, F.lit(MOVE_TOKEN), F.lit(0))
    kind = F.transform(tokens, lambda t: F.regexp_replace(F.regexp_replace(t, r"^\d*\.+", ""), r"[!?]+$", ""))
    kind = F.filter(kind, lambda t: ~F.substring(t, 1, 1).isin("{", ";", "%", "$") & (t != "") & ~t.rlike(r"^\d+$")
                    & ~t.isin("1-0", "0-1", "1/2-1/2", "*", "e.p."))

    def step(state: F.Column, t: F.Column) -> F.Column:
        depth = F.when(t == "(", state["depth"] + 1).when(t == ")", F.greatest(state["depth"] - 1, F.lit(0))).otherwise(state["depth"])
        move = (state["depth"] == 0) & ~t.isin("(", ")")
        return F.struct(depth.alias("depth"), F.when(move, F.concat(state["moves"], F.array(t))).otherwise(state["moves"]).alias("moves"))
    start = F.struct(F.lit(0).alias("depth"), F.array().cast("array<string>").alias("moves"))
    return F.aggregate(kind, start, step, lambda s: s["moves"])


def pgn_tag(record: F.Column, tag: str) -> F.Column:
    """The value of a tag, with escaped quotes and backslashes read back; empty where the tag is absent."""
    raw = F.regexp_extract(record, rf'(?m)^\[{tag} "((?:[^"\\]|\\.)*)"\]', 1)
    return F.regexp_replace(raw, r"\\(.)", "$1")


def read_pgn(spark, path: str | list[str]) -> DataFrame:
    """Distributed PGN ingest, one row per game, from files with LF or CRLF line ends.

    A game begins at a line that starts with ``[Event "``; files are split there, so a large file is
    read by many tasks. The tag lines give the columns, everything behind them is the move text (see
    :func:`main_line`). Records without a Site tag are skipped; move legality is not evaluated (positions arrive as a table).
    """
    raw = spark.read.option("lineSep", '\n[Event "').text(path)
    v = F.regexp_replace("value", "\r", "")
    tags = {t.lower(): pgn_tag(v, t) for t in PGN_TAGS[1:]}
    # behind the rest of the first tag line come tag lines and blank lines, then the moves
    text = F.regexp_extract(v, r"(?s)^[^\n]*\n(?:\[[^\n]*\n|[ \t]*\n)*+(.*)$", 1)
    d = raw.select(*[e.alias(k) for k, e in tags.items()], main_line(text).alias("moves")).filter(F.col("site") != "")
    return d.select(F.element_at(F.split("site", "/"), -1).alias("game_id"), "white", "black", "result",
                    F.when(F.col("opening") == "", None).otherwise(F.col("opening")).alias("opening"), "moves")


STUDY_SCHEMA = "id string, name string, url string, likes int"


def read_study_feed(spark, path: str, known_ids: DataFrame) -> DataFrame:
    """NDJSON feed, malformed lines dropped, only unseen ids whose name
    carries a beginner signal (T24), deduplicated by id."""
    from ..functions.text import is_beginner_text
    d = spark.read.schema(STUDY_SCHEMA).option("mode", "DROPMALFORMED").json(path)
    d = d.filter(F.col("id").isNotNull() & is_beginner_text("name"))
    d = d.join(known_ids.select(F.col("resource_id").alias("id")), "id", "left_anti")
    return d.dropDuplicates(["id"])
