"""Text and keyword operators as column expressions.

Keyword scans are flat sums of ``contains`` tests (one Catalyst expression per
term) instead of per-row Python loops or higher-order lambdas, so they stay
inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .scalar import level_band

# ----------------------------------------------------------------------------
# Semantic level signals of the catalogue re-tiering.
DOWNWARD_SIGNALS = [
    "beginner", "starter", "novice", "intro", "introduction", "basics", "first steps", "learn chess",
    "how to play", "fundamentals", "new to chess", "complete beginner", "getting started", "chess 101",
    "for kids", "for children",
]
UPWARD_SIGNALS_STRICT = [
    "prophylaxis", "positional masterclass", "dynamic imbalances", "advanced calculation", "endgame technique",
    "pawn structure mastery", "for masters", "master level", "titled player", "titled players", "2000+", "2200+",
    "above 2000", "elo 2000", "elo 2200", "grandmaster secrets", "gm repertoire",
]
COMPLEX_OPENINGS = ["king's indian", "najdorf", "grünfeld", "grunfeld", "marshall attack", "berlin defense",
                    "nimzo-indian"]
DEPTH_QUALIFIERS = ["advanced", "deep", "mastery", "master", "top-level", "professional", "in-depth",
                    "according to", "expert"]
INTERMEDIATE_ANCHOR_SIGNALS = [
    "club player", "improving", "common mistakes", "typical mistakes", "practical", "easy", "simple", "quick",
    "repertoire for club", "1200", "1400", "1500", "1600", "part 1", "part 2",
]
# Per-source score_up threshold to leave intermediate.
SOURCE_PROMOTION_THRESHOLD = {"modern_chess": 3, "youtube": 2, "manual": 1}
DEFAULT_PROMOTION_THRESHOLD = 2
# Three-tier Elo boundaries [lo, hi) of the re-tiering.
LEVEL_BOUNDARIES_3 = [("beginner", 0, 1200), ("intermediate", 1200, 1800), ("advanced", 1800, 3000)]

# Message-channel vocabularies.
COURSE_DOMAINS = [
    ("chessable.com", "chessable"), ("modernchess.com", "modern_chess"), ("udemy.com", "udemy"),
    ("chess.com", "chess.com"), ("lichess.org", "lichess"), ("chessmood.com", "chessmood"),
    ("chessly.com", "chessly"), ("youtube.com", "youtube"), ("youtu.be", "youtube"),
]
FILE_EXTENSIONS = [(".pgn", "pgn"), (".zip", "zip"), (".pdf", "pdf"), (".cbv", "cbv"), (".cbz", "cbz"),
                   (".epub", "epub")]
MSG_BEGINNER_SIGNALS = [
    "beginner", "basics", "fundamental", "starter", "easy", "simple", "dummies", "101", "introduction", "intro",
    "learn chess", "first steps", "new to chess", "getting started", "kids", "children", "complete beginner",
    "quick start",
]
MSG_INTERMEDIATE_SIGNALS = ["intermediate", "club player", "improving", "1200", "1400", "1500", "1600",
                            "practical", "common mistakes"]
MSG_ADVANCED_SIGNALS = [
    "advanced", "master", "grandmaster", "gm ", "im ", "titled", "prophylaxis", "deep", "mastery", "2000", "2200",
    "2000+", "in-depth", "complete repertoire", "gm repertoire", "according to", "professional",
]
MSG_OPENING_KEYWORDS = [
    "sicilian", "french", "caro", "ruy lopez", "italian", "london", "queens gambit", "queen's gambit",
    "kings indian", "king's indian", "nimzo", "grunfeld", "grünfeld", "pirc", "dutch", "english", "catalan", "slav",
    "benoni", "budapest", "alekhine", "scandinavian", "opening", "repertoire", "defense", "defence", "gambit",
]
MSG_COURSE_TYPES = [
    ("opening", MSG_OPENING_KEYWORDS),
    ("endgame", ["endgame", "end game", "rook ending", "pawn ending", "endings"]),
    ("tactics", ["tactics", "combinations", "puzzles", "calculation"]),
    ("middlegame", ["middlegame", "middle game", "strategy", "positional"]),
    ("general", ["complete chess", "chess improvement", "fundamentals"]),
]
COLOR_SIGNALS = [
    ("White", ["for white", "with white", "playing white", "as white", "1.e4", "1.d4", "1.nf3", "1.c4"]),
    ("Black", ["for black", "with black", "playing black", "as black", "against 1.e4", "against 1.d4"]),
]
# Course-card type keywords (T09 card variant), checked on the title.
CARD_COURSE_TYPES = [
    ("opening", ["opening", "repertoire", "defense", "gambit", "attack", "system"]),
    ("middlegame", ["middlegame", "strategy", "structure", "pawn", "positional"]),
    ("endgame", ["endgame", "ending", "rook ending", "pawn ending"]),
    ("tactics", ["tactic", "puzzle", "combination", "calculation"]),
]
# Keyword -> canonical opening name (T14), in priority order.
OPENING_TAGS = [
    ("sicilian", "Sicilian Defense"), ("french", "French Defense"), ("caro-kann", "Caro-Kann Defense"),
    ("queen's gambit", "Queen's Gambit"), ("king's indian", "King's Indian Defense"),
    ("nimzo", "Nimzo-Indian Defense"), ("ruy lopez", "Ruy Lopez"), ("spanish", "Ruy Lopez"),
    ("italian", "Italian Game"), ("london", "London System"), ("english opening", "English Opening"),
    ("grunfeld", "Gruenfeld Defense"), ("grünfeld", "Gruenfeld Defense"), ("dutch", "Dutch Defense"),
    ("scandinavian", "Scandinavian Defense"), ("pirc", "Pirc Defense"), ("benoni", "Benoni Defense"),
    ("slav", "Slav Defense"), ("queen's indian", "Queen's Indian Defense"), ("catalan", "Catalan Opening"),
    ("benko", "Benko Gambit"), ("trompowsky", "Trompowsky Attack"), ("vienna", "Vienna Game"),
    ("scotch", "Scotch Game"), ("king's gambit", "King's Gambit"), ("petroff", "Petroff's Defense"),
    ("berlin", "Berlin Defense"), ("kings indian attack", "King's Indian Attack"),
]
# Level keywords of the course-text level triple.
LEVEL_KEYWORDS = [
    (["beginner", "starter", "novice"], 0, 1200, "beginner"),
    (["club player", "intermediate"], 1200, 1800, "intermediate"),
    (["advanced", "serious player"], 1800, 2300, "advanced"),
    (["master", "expert", "titled"], 2300, 3000, "expert"),
]
# Author titles in priority order.
AUTHOR_TITLES = ["GM", "IM", "FM", "NM"]
# Noise-title patterns (T19), applied case-insensitively to the stripped title.
NOISE_PATTERNS = [
    r"^(request|anybody|anyone|does anyone|can someone|please|pls|plz)",
    r"(has pgn|send pgn|pgn please|pgn\?|share pgn)",
    r"^(pgn|pdf|zip|video|link)\s",
    r"^(thanks|thank you|thx|ty\b)",
    r"^(hi|hello|hey|good morning)",
    r"^(re:|fwd:|forwarded)",
    r"^\d{4,}$",
    r"^.{1,8}$",
]
# Beginner signals of the study-feed filter.
FEED_BEGINNER_SIGNALS = [
    "beginner", "basics", "fundamental", "starter", "easy", "simple", "dummies", "101", "quick start",
    "introduction", "intro", "learn chess", "first steps", "new to chess", "getting started", "kids", "children",
    "complete beginner",
]
URL_PATTERN = r"""https?://[^\s\)\]>"']+"""


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def strip_ws(x) -> Column:
    """Python ``str.strip()``: leading/trailing whitespace of any kind."""
    return F.regexp_replace(_c(x), r"^\s+|\s+$", "")


def count_contains(text, terms: list[str]) -> Column:
    """Number of ``terms`` that occur as substrings of ``text`` (NULL text -> 0)."""
    t = F.coalesce(_c(text), F.lit(""))
    total = F.lit(0)
    for s in terms:
        total = total + F.when(F.instr(t, s) > 0, 1).otherwise(0)
    return total


def any_contains(text, terms: list[str]) -> Column:
    t = F.coalesce(_c(text), F.lit(""))
    cond = F.lit(False)
    for s in terms:
        cond = cond | (F.instr(t, s) > 0)
    return cond


def with_semantic_scores(df, title_col: str = "title", description_col: str | None = None):
    """T01 on a DataFrame: the lower-cased texts are materialised once as
    columns so the ~80 substring tests reference a column instead of
    re-deriving (and re-planning) the text expression in every test."""
    desc = F.coalesce(F.col(description_col), F.lit("")) if description_col else F.lit("")
    d = df.withColumn("__text", F.lower(F.concat(F.coalesce(F.col(title_col), F.lit("")), F.lit(" "), desc)))
    d = d.withColumn("__tl", F.lower(F.coalesce(F.col(title_col), F.lit(""))))
    t, tl = F.col("__text"), F.col("__tl")
    boost = F.when(any_contains(t, COMPLEX_OPENINGS) & any_contains(tl, DEPTH_QUALIFIERS), 1).otherwise(0)
    d = d.withColumns({
        "score_up": count_contains(t, UPWARD_SIGNALS_STRICT) + boost + 2 * count_contains(tl, UPWARD_SIGNALS_STRICT),
        "score_down": count_contains(t, DOWNWARD_SIGNALS),
        "score_anchor": count_contains(t, INTERMEDIATE_ANCHOR_SIGNALS)})
    return d.drop("__text", "__tl")


def band3(x) -> Column:
    v = _c(x)
    expr = None
    for name, lo, hi in LEVEL_BOUNDARIES_3:
        cond = (v >= lo) & (v < hi)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr


def tier_from_range(level_min, level_max) -> Column:
    """Tier of the reference point of a numeric range; NULL when unknown or
    the untrusted default (1200, >=2800)."""
    lo, hi = _c(level_min).cast("double"), _c(level_max).cast("double")
    span = hi - lo
    ref = lo + span * F.when(span > 800, 0.33).otherwise(0.5)
    return (F.when(lo.isNull() | hi.isNull(), F.lit(None).cast("string"))
            .when((lo == 1200) & (hi >= 2800), F.lit(None).cast("string"))
            .otherwise(F.coalesce(band3(ref), F.lit("advanced"))))


def promotion_threshold(source) -> Column:
    s = _c(source)
    expr = None
    for k, v in SOURCE_PROMOTION_THRESHOLD.items():
        expr = F.when(s == k, v) if expr is None else expr.when(s == k, v)
    return expr.otherwise(DEFAULT_PROMOTION_THRESHOLD)


def tier_from_text(up, down, anchor, threshold) -> Column:
    """Ordered rules on the semantic scores; NULL when no rule fires."""
    u, d, a, t = _c(up), _c(down), _c(anchor), _c(threshold)
    return (F.when(d >= 2, "beginner").when((d == 1) & (u == 0), "beginner")
            .when((u >= t + 1) & (a == 0), "advanced").when((u >= t) & (a == 0), "advanced")
            .when((u >= t) & (a >= 1), "intermediate").when((u > 0) & (u < t) & (a == 0), "intermediate"))


def recategorize(df, title_col: str = "title", description_col: str | None = None):
    """Three-tier re-categorisation with provenance (one pass, no shuffle)."""
    out = df.withColumn("level_tier_original",
                        F.when(F.col("level_tier") == "expert", "advanced").otherwise(F.col("level_tier")))
    out = with_semantic_scores(out, title_col, description_col).withColumn("__thr", promotion_threshold("source"))
    out = (out.withColumn("__tr", tier_from_range("level_min", "level_max"))
              .withColumn("__tt", tier_from_text("score_up", "score_down", "score_anchor", "__thr")))
    tr, tt = F.col("__tr"), F.col("__tt")
    override = (F.col("score_up") >= F.col("__thr")) | (F.col("score_down") >= 2)
    lmin = F.coalesce(F.col("level_min").cast("double"), F.lit(1200.0))
    fallback = F.coalesce(band3(lmin), F.lit("intermediate"))
    res = (F.when(tr.isNotNull() & tt.isNotNull(),
                  F.when(tr == tt, F.struct(tr.alias("t"), F.lit("range+text_agree").alias("s")))
                  .when(override, F.struct(tt.alias("t"), F.lit("text_override").alias("s")))
                  .otherwise(F.struct(tr.alias("t"), F.lit("range_wins").alias("s"))))
           .when(tr.isNotNull(), F.struct(tr.alias("t"), F.lit("range_only").alias("s")))
           .when(tt.isNotNull(), F.struct(tt.alias("t"), F.lit("text_only").alias("s")))
           .otherwise(F.struct(fallback.alias("t"), F.lit("fallback_lmin").alias("s"))))
    out = out.withColumn("__res", res)
    return (out.withColumn("level_tier_new", F.col("__res.t")).withColumn("level_tier_source", F.col("__res.s"))
               .withColumn("level_tier", F.col("__res.t")).drop("__res", "__tr", "__tt", "__thr"))


def extract_urls(text) -> Column:
    """All URL matches (array)."""
    return F.regexp_extract_all(F.coalesce(_c(text), F.lit("")), F.lit(URL_PATTERN), 0)


def source_of_url(url) -> Column:
    """First domain of the ordered list contained in the URL, else 'telegram'."""
    u = _c(url)
    expr = None
    for dom, src in COURSE_DOMAINS:
        cond = F.instr(u, dom) > 0
        expr = F.when(cond, src) if expr is None else expr.when(cond, src)
    return expr.otherwise("telegram")


RATING_RE = r"\b(\d{3,4})\s*[-+]?\s*(\d{3,4})?\b"


def level_from_message(text) -> Column:
    """First 3-4 digit number decides (<1200 / <1800 / else); else signal rules."""
    raw = F.coalesce(_c(text), F.lit(""))
    t = F.lower(raw)
    num = F.regexp_extract(raw, RATING_RE, 1)
    r = F.when(num != "", num.cast("int"))
    down = count_contains(t, MSG_BEGINNER_SIGNALS)
    mid = count_contains(t, MSG_INTERMEDIATE_SIGNALS)
    up = count_contains(t, MSG_ADVANCED_SIGNALS)
    return (F.when(r.isNotNull() & (r < 1200), "beginner").when(r.isNotNull() & (r < 1800), "intermediate")
            .when(r.isNotNull(), "advanced")
            .when((down >= 1) & (up == 0), "beginner").when((up >= 2) & (down == 0), "advanced")
            .when((up >= 1) & (mid >= 1), "intermediate").when(mid >= 1, "intermediate")
            .when(up >= 1, "advanced").otherwise("intermediate"))


def level_triple(text, default_min: int = 1200) -> Column:
    """(level_min, level_max, tier) from course text as a struct."""
    raw = F.coalesce(_c(text), F.lit(""))
    t = F.lower(raw)
    m_lo = F.regexp_extract(raw, r"(\d{3,4})\s*[-]\s*(\d{3,4})", 1)
    m_hi = F.regexp_extract(raw, r"(\d{3,4})\s*[-]\s*(\d{3,4})", 2)
    lo, hi = F.when(m_lo != "", m_lo.cast("int")), F.when(m_hi != "", m_hi.cast("int"))
    ok = lo.isNotNull() & (lo >= 500) & (lo <= 2800) & (lo < hi)

    def st(a, b, c):
        return F.struct(F.lit(a).cast("int").alias("level_min") if not isinstance(a, Column) else a.alias("level_min"),
                        F.lit(b).cast("int").alias("level_max") if not isinstance(b, Column) else b.alias("level_max"),
                        F.lit(c).alias("level_tier") if not isinstance(c, Column) else c.alias("level_tier"))
    expr = F.when(ok, st(lo, hi, level_band(lo)))
    for words, a, b, c in LEVEL_KEYWORDS:
        expr = expr.when(any_contains(t, words), st(a, b, c))
    default_tier = "intermediate"
    for name, a, b in [("beginner", 0, 1200), ("intermediate", 1200, 1800), ("advanced", 1800, 2300),
                       ("expert", 2300, 3000)]:
        if a <= default_min < b:
            default_tier = name
    return expr.otherwise(st(default_min, 3000, default_tier))


def course_type_of_message(text) -> Column:
    """T09 (message variant): first group with a keyword, else 'general'."""
    t = F.lower(F.coalesce(_c(text), F.lit("")))
    expr = None
    for name, words in MSG_COURSE_TYPES:
        cond = any_contains(t, words)
        expr = F.when(cond, name) if expr is None else expr.when(cond, name)
    return expr.otherwise("general")


def course_type_of_card(title, openings) -> Column:
    """T09 (card variant): openings present => opening; else title keyword groups."""
    tl = F.lower(F.coalesce(_c(title), F.lit("")))
    has_openings = F.coalesce(F.length(_c(openings)) > 0, F.lit(False))
    expr = F.when(has_openings | any_contains(tl, CARD_COURSE_TYPES[0][1]), "opening")
    for name, words in CARD_COURSE_TYPES[1:]:
        expr = expr.when(any_contains(tl, words), name)
    return expr.otherwise("general")


def color_of_text(text) -> Column:
    """White phrases first, then Black, else Both."""
    t = F.lower(F.coalesce(_c(text), F.lit("")))
    return (F.when(any_contains(t, COLOR_SIGNALS[0][1]), "White")
            .when(any_contains(t, COLOR_SIGNALS[1][1]), "Black").otherwise("Both"))


def color_of_card_title(title) -> Column:
    """T10 (card variant): 'for white' / 'for black' in the title."""
    tl = F.lower(F.coalesce(_c(title), F.lit("")))
    return F.when(F.instr(tl, "for white") > 0, "White").when(F.instr(tl, "for black") > 0, "Black").otherwise("Both")


def file_format(file_name) -> Column:
    """Format by file extension, else 'unknown'."""
    f = F.lower(F.coalesce(_c(file_name), F.lit("")))
    expr = None
    for ext, fmt in FILE_EXTENSIONS:
        cond = F.endswith(f, F.lit(ext))
        expr = F.when(cond, fmt) if expr is None else expr.when(cond, fmt)
    return expr.otherwise("unknown")


def extract_title(text, url=None) -> Column:
    """First non-empty line without URLs / markup (<=120 chars); else the
    URL slug title-cased; else 'Unknown'."""
    clean = strip_ws(F.regexp_replace(F.coalesce(_c(text), F.lit("")), r"https?://\S+", ""))
    clean = F.regexp_replace(clean, r"[#*_`]", "")
    lines = F.filter(F.transform(F.split(clean, "\n"), lambda l: strip_ws(l)), lambda l: l != "")
    first = F.substring(F.element_at(lines, 1), 1, 120)
    if url is None:
        slug_title = F.lit(None).cast("string")
    else:
        u = F.coalesce(_c(url), F.lit(""))
        slug = F.element_at(F.split(F.regexp_replace(u, r"/+$", ""), "/"), -1)
        slug_title = F.when(u != "", F.substring(F.initcap(F.regexp_replace(slug, r"[-_]", " ")), 1, 120))
    return F.coalesce(F.when(F.size(lines) > 0, first), slug_title, F.lit("Unknown"))


def slug_id(prefix, title, cut: int, suffix=None, sep: str = "__") -> Column:
    """``prefix + sep + lower(title) with non [a-z0-9] -> '_' cut to n`` (+ sep + suffix)."""
    clean = F.substring(F.regexp_replace(F.lower(F.coalesce(_c(title), F.lit(""))), "[^a-z0-9]", "_"), 1, cut)
    parts = [_c(prefix), F.lit(sep), clean]
    if suffix is not None:
        parts += [F.lit(sep), _c(suffix).cast("string")]
    return F.concat(*parts)


def opening_tags(text) -> Column:
    """Canonical opening names found in the text, distinct, in list order."""
    t = F.lower(F.coalesce(_c(text), F.lit("")))
    hits = F.array(*[F.when(F.instr(t, kw) > 0, F.lit(name)) for kw, name in OPENING_TAGS])
    return F.array_distinct(F.array_compact(hits))


def iso_duration_minutes(duration) -> Column:
    """ISO-8601 ``PT#H#M#S`` -> minutes rounded to 1; 0 -> NULL."""
    d = F.coalesce(_c(duration), F.lit(""))

    def part(unit):
        v = F.regexp_extract(d, rf"(\d+){unit}", 1)
        return F.when(v != "", v.cast("double")).otherwise(F.lit(0.0))
    total = part("H") * 60 + part("M") + part("S") / 60
    return F.when(total > 0, F.bround(total, 1))


def text_duration_minutes(text) -> Column:
    """``X h [and Y min]`` or ``Y min`` (first match) -> minutes."""
    t = F.coalesce(_c(text), F.lit(""))
    pat = r"(\d+(?:\.\d+)?)\s*h(?:\s*and\s*(\d+)\s*min)?|(\d+)\s*min"
    g1, g2, g3 = (F.regexp_extract(t, pat, i) for i in (1, 2, 3))
    return (F.when(g3 != "", g3.cast("double"))
            .when(g1 != "", g1.cast("double") * 60 + F.coalesce(F.when(g2 != "", g2.cast("double")), F.lit(0.0))))


def author_title(authors) -> Column:
    """First of GM, IM, FM, NM contained in the author string, else ''."""
    a = F.coalesce(_c(authors), F.lit(""))
    expr = None
    for t in AUTHOR_TITLES:
        cond = F.instr(a, t) > 0
        expr = F.when(cond, t) if expr is None else expr.when(cond, t)
    return expr.otherwise("")


def is_noise_title(title) -> Column:
    """NULL or any noise pattern on lower(strip(title))."""
    t = F.lower(strip_ws(_c(title)))
    cond = F.lit(False)
    for p in NOISE_PATTERNS:
        cond = cond | t.rlike("(?i)" + p)
    return _c(title).isNull() | cond


def is_valid_url(url) -> Column:
    """``telegram://`` or ``http(s)://`` prefix."""
    u = _c(url)
    return F.coalesce(F.startswith(u, F.lit("telegram://")) | u.rlike(r"^https?://"), F.lit(False))


def normalized_title(title) -> Column:
    """T21 key: lower, strip, keep [a-z0-9 whitespace], collapse whitespace."""
    t = F.regexp_replace(F.lower(strip_ws(F.coalesce(_c(title), F.lit("")))), r"[^a-z0-9\s]", "")
    return F.regexp_replace(t, r"\s+", " ")


def clean_title(title) -> Column:
    """Drop a file suffix, leading emoji / symbols / blanks, collapse spaces."""
    t = F.regexp_replace(_c(title), r"(?i)\.(pdf|pgn|zip|cbv|epub|cbz)$", "")
    t = F.regexp_replace(t, "^[\\x{10000}-\\x{10FFFF}\\x{2600}-\\x{26FF}\\x{2700}-\\x{27BF}\\s]+", "")
    return strip_ws(F.regexp_replace(t, r"\s+", " "))


def is_beginner_text(text) -> Column:
    """Any study-feed beginner signal in lower(text)."""
    return any_contains(F.lower(F.coalesce(_c(text), F.lit(""))), FEED_BEGINNER_SIGNALS)


# Opening synonyms (T25) — key -> extra search terms.
SYNONYMS = [
    ("rapport-jobava system", ["jobava", "london"]), ("jobava london", ["jobava", "london"]),
    ("london system", ["london"]), ("king's indian attack", ["king's indian attack"]),
    ("king's indian defense", ["king's indian"]), ("queen's indian defense", ["queen's indian"]),
    ("nimzo-indian defense", ["nimzo-indian"]), ("sicilian defense", ["sicilian"]),
    ("caro-kann defense", ["caro-kann"]), ("french defense", ["french defense"]),
    ("queen's gambit declined", ["queen's gambit declined", "qgd"]),
    ("queen's gambit accepted", ["queen's gambit accepted", "qga"]), ("queen's gambit", ["queen's gambit"]),
    ("slav defense", ["slav defense", "slav"]), ("semi-slav defense", ["semi-slav"]),
    ("queen's pawn game", ["queen's pawn", "1.d4", "colle", "torre"]), ("king's pawn game", ["king's pawn", "1.e4"]),
    ("zukertort opening", ["zukertort", "réti"]), ("english opening", ["english opening"]),
    ("dutch defense", ["dutch defense"]), ("pirc defense", ["pirc defense"]),
    ("ruy lopez", ["ruy lopez", "spanish game"]), ("italian game", ["italian game"]),
    ("scotch game", ["scotch game"]), ("vienna game", ["vienna game"]),
    ("petrov defense", ["petrov", "russian game"]), ("grunfeld defense", ["Grünfeld", "grunfeld"]),
    ("benoni defense", ["benoni"]),
]


# Opening synonyms of the application (T25 app variant).
SYNONYMS_APP = [
    ("rapport-jobava system", ["jobava london", "london system"]), ("london system", ["london system"]),
    ("king's indian attack", ["king's indian attack"]), ("nimzo-larsen attack", ["nimzo-larsen"]),
    ("trompowsky attack", ["trompowsky attack"]),
    ("hungarian opening", ["hungarian opening", "king's fianchetto", "1.e4 e5 2.bc4"]),
    ("polish opening", ["polish opening", "orangutan", "1.b4", "sokolsky"]), ("bird opening", ["bird opening"]),
    ("english opening", ["english opening"]), ("zukertort opening", ["zukertort opening", "colle system"]),
    ("yusupov-rubinstein system", ["nimzo-indian defense"]),
    ("east indian defense", ["king's indian defense", "benoni defense"]),
    ("queen's pawn game", ["queen's pawn game", "queen's gambit", "colle system"]),
    ("king's pawn game", ["king's pawn game"]), ("pseudo queen's indian defense", ["queen's indian defense"]),
    ("indian defense", ["indian defense"]), ("queen's indian defense", ["queen's indian defense"]),
    ("nimzo-indian defense", ["nimzo-indian defense"]), ("king's indian defense", ["king's indian defense"]),
    ("benoni defense", ["benoni defense"]), ("benko gambit accepted", ["benko gambit", "volga gambit"]),
    ("grünfeld defense", ["grünfeld defense", "grunfeld defense"]),
    ("grunfeld defense", ["grünfeld defense", "grunfeld defense"]), ("sicilian defense", ["sicilian defense"]),
    ("french defense", ["french defense"]), ("caro-kann defense", ["caro-kann defense"]),
    ("pirc defense", ["pirc defense"]), ("modern defense", ["modern defense"]),
    ("alekhine defense", ["alekhine defense"]), ("petrov's defense", ["petrov's defense", "russian game"]),
    ("ruy lopez", ["ruy lopez", "spanish game"]),
    ("english defense", ["english defense", "1.d4 b6", "queens fianchetto"]),
    ("owen defense", ["owen defense", "b6 defense", "1...b6"]),
    ("queen's gambit declined", ["queen's gambit declined"]), ("queen's gambit accepted", ["queen's gambit accepted"]),
    ("slav defense", ["slav defense"]), ("semi-slav defense", ["semi-slav defense"]),
    ("catalan opening", ["catalan opening"]), ("dutch defense", ["dutch defense"]),
    ("englund gambit", ["englund gambit", "1.d4 e5"]),
]
# Terms that must match as whole words in the app variant.
WORD_TERMS = ["slav", "pirc", "bird", "reti", "benoni", "benko", "catalan", "french", "sicilian", "alekhine",
              "grunfeld", "trompowsky", "petrov"]


def synonym_dim_rows(variant: str = "pipeline") -> list[tuple[int, str, int, str]]:
    src = SYNONYMS_APP if variant == "app" else SYNONYMS
    return [(i, k, j, t) for i, (k, terms) in enumerate(src) for j, t in enumerate(terms)]
