"""Recommenders.

Every recommender runs for all players at once. Requests are first reduced
to their distinct *answer keys* (opening, floor/ceil of the rating, ...):
the answer of a search depends only on that key, whose domain is bounded by
the opening vocabulary and the rating scale, not by the number of players.
Candidates are generated per key with equi joins on the opening bridge and
joined back to the requests by key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bridge import match_bridge, rating_key, synonym_terms
from ..session import ensure_checkpoint_dir
from .metric import knn_neighbours
from .common import attach_scalars, attach_values, exact_quantiles, nearest_bound, unbroadcast

RESOURCE_COLS = ["resource_id", "title", "source", "level_tier", "is_free", "course_type"]
# Level name maps of the recommenders.
LEVEL_FROM_CLUSTER = {0: "dominio", 1: "desarrollo", 2: "sin_base"}
NIVEL_PRIO = {"sin_base": 1, "desarrollo": 2, "dominio": 3}


def _map(d: dict, col: F.Column, default=None) -> F.Column:
    m = F.create_map(*[x for kv in d.items() for x in (F.lit(kv[0]), F.lit(kv[1]))])
    v = m[col]
    return F.coalesce(v, F.lit(default)) if default is not None else v


def search_resources(requests: DataFrame, catalog: DataFrame, top_n: int = 3, variant: str = "pipeline") -> DataFrame:
    """Per request (opening, rating): catalogue resources whose ``openings``
    contain a search term of the opening (T25/J08) and whose level range holds
    the rating (J07), ordered rating_score desc, is_free asc (paid first), id;
    top n. Without a match: the first n opening courses of the rating's tier
    (>=2000 expert, >=1200 intermediate, else beginner); else a placeholder.

    Returns (opening, r_lo, r_hi, rank, match_kind, resource columns).
    """
    lo, hi = rating_key(F.col("rating"))
    ensure_checkpoint_dir(catalog.sparkSession)
    keys = requests.select("opening", lo.alias("r_lo"), hi.alias("r_hi")).distinct().checkpoint(eager=True)
    terms = synonym_terms(keys.select("opening"), variant)
    bridge = match_bridge(terms, catalog, ["openings"])
    res = catalog.select(*RESOURCE_COLS, F.coalesce(F.col("level_min"), F.lit(0)).cast("long").alias("lo"),
                         F.coalesce(F.col("level_max"), F.lit(9999)).cast("long").alias("hi"), "rating_score")
    # resources of an opening with the same range cover the same keys, so the first top_n of each range hold every answer
    order = [F.col("rating_score").desc_nulls_last(), F.col("is_free").asc_nulls_last(), "resource_id"]
    br = bridge.join(unbroadcast(res), "resource_id").withColumn("__r", F.row_number().over(Window.partitionBy("opening", "lo", "hi").orderBy(*order)))
    # the bridge rows are reused by four branches below: materialise them once
    # (reliable checkpoint in the shared checkpoint folder)
    br = br.filter(F.col("__r") <= max(1, top_n)).drop("__r").checkpoint(eager=True)
    # Keys whose covering resources are the same share one answer: a resource
    # covers (r_lo, r_hi) iff lo <= a and hi >= b, where a is the largest lower
    # bound <= r_lo and b the smallest upper bound >= r_hi among the opening's
    # resources. (a, b) classes are bounded by the distinct bounds, so the
    # candidate set no longer grows with the number of distinct ratings.
    los = br.select("opening", F.col("lo").alias("a")).distinct()
    his = br.select("opening", F.col("hi").alias("b")).distinct()
    ka = (keys.select("opening", "r_lo").distinct().join(los, "opening").filter(F.col("a") <= F.col("r_lo"))
          .groupBy("opening", "r_lo").agg(F.max("a").alias("a")))
    kb = (keys.select("opening", "r_hi").distinct().join(his, "opening").filter(F.col("b") >= F.col("r_hi"))
          .groupBy("opening", "r_hi").agg(F.min("b").alias("b")))
    kc = keys.join(ka, ["opening", "r_lo"]).join(kb, ["opening", "r_hi"])
    classes = kc.select("opening", "a", "b").distinct()
    cand = classes.join(br, "opening").filter((F.col("lo") <= F.col("a")) & (F.col("hi") >= F.col("b")))
    w = Window.partitionBy("opening", "a", "b").orderBy(*order)
    top = cand.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= top_n)
    hits = kc.join(top, ["opening", "a", "b"])
    # read by the answer and by what is missing
    hits = hits.select("opening", "r_lo", "r_hi", "rank", F.lit("match").alias("match_kind"), *RESOURCE_COLS).checkpoint(eager=True)
    # fallback: keys without any hit, by tier of the rating
    missing = keys.join(hits.select("opening", "r_lo", "r_hi").distinct(), ["opening", "r_lo", "r_hi"], "left_anti")
    r = F.col("r_lo")  # floor: '>= 2000' on the rating equals '>= 2000' on its floor
    missing = missing.withColumn("tier", F.when(r >= 2000, "expert").when(r >= 1200, "intermediate").otherwise("beginner"))
    wt = Window.partitionBy("level_tier").orderBy("resource_id")
    tier_top = (catalog.filter(F.col("course_type") == "opening").select(*RESOURCE_COLS)
                .withColumn("rank", F.row_number().over(wt)).filter(F.col("rank") <= top_n))
    fb = missing.join(F.broadcast(tier_top.withColumnRenamed("level_tier", "tier")), "tier").withColumn(
        "level_tier", F.col("tier"))
    fb = fb.select("opening", "r_lo", "r_hi", "rank", F.lit("tier_fallback").alias("match_kind"), *RESOURCE_COLS)
    none = missing.join(tier_top.select(F.col("level_tier").alias("tier")).distinct(), "tier", "left_anti")
    ph = none.select("opening", "r_lo", "r_hi", F.lit(1).alias("rank"), F.lit("placeholder").alias("match_kind"),
                     F.lit(None).cast("string").alias("resource_id"),
                     F.lit("Sin recurso específico en catálogo").alias("title"), F.lit("-").alias("source"),
                     F.lit("-").alias("level_tier"), F.lit(None).cast("int").alias("is_free"),
                     F.lit("-").alias("course_type"))
    return hits.unionByName(fb).unionByName(ph)


def attach_answers(requests: DataFrame, answers: DataFrame) -> DataFrame:
    """Join answers back to the requests by their key (opening, floor, ceil)."""
    lo, hi = rating_key(F.col("rating"))
    return requests.withColumn("r_lo", lo).withColumn("r_hi", hi).join(answers, ["opening", "r_lo", "r_hi"]).drop("r_lo", "r_hi")


def level_of_cluster(col: str = "level_id") -> F.Column:
    return _map(LEVEL_FROM_CLUSTER, F.col(col), "desarrollo")


def profile_openings(game_lv: DataFrame, top: int = 5, min_games: int = 5) -> DataFrame:
    """W09 (pipeline): per player the openings to study: by (opening, colour,
    level) with >= 5 games, ordered level priority then win rate (ascending), top 5."""
    g = game_lv.withColumn("level_rec", level_of_cluster())
    s = g.groupBy("player", "opening", "color", "level_rec").agg(
        F.count("game_id").alias("n_games"), F.avg("acc").alias("acc_mean"), F.avg("score").alias("win_rate"))
    s = s.filter(F.col("n_games") >= min_games).withColumn("prio", _map(NIVEL_PRIO, F.col("level_rec"), 2))
    w = Window.partitionBy("player").orderBy("prio", "win_rate", "opening", "color")
    return s.withColumn("rank_opening", F.row_number().over(w)).filter(F.col("rank_opening") <= top)


def direct_profile_recommender(game_lv: DataFrame, catalog: DataFrame, top_openings: int = 5, top_n: int = 3, ratings: DataFrame | None = None) -> DataFrame:
    """W09 openings of every player -> R01 at the player's mean rating
    (``ratings``: player, rating, where the caller has it)."""
    ensure_checkpoint_dir(catalog.sparkSession)
    rating = game_lv.groupBy("player").agg(F.avg("rating").alias("rating")) if ratings is None else ratings
    # read by the search and by its answers: the games are gone through once
    req = profile_openings(game_lv, top_openings).join(rating, "player").checkpoint(eager=True)
    ans = search_resources(req, catalog, top_n)
    return attach_answers(req, ans)


# kNN feature weights (rating excluded).
KNN_FEATURES = ["acc_mean", "theory_mean", "pct_dominio", "pct_desarrollo", "pct_sin_base", "win_rate", "n_openings"]
KNN_WEIGHTS = [2.5, 2.5, 2.0, 2.0, 2.0, 1.0, 0.5]


def similarity_profiles(game_lv: DataFrame) -> DataFrame:
    """Per player: mean rating, mean adjusted accuracy, mean theory, shares
    of the three levels, win rate, distinct openings; NULL feature <- median."""
    lv = level_of_cluster()
    p = game_lv.groupBy("player").agg(
        F.avg("rating").alias("rating_mean"), F.avg("acc_adj").alias("acc_mean"),
        F.avg("theory_depth").alias("theory_mean"),
        F.avg((lv == "dominio").cast("double")).alias("pct_dominio"),
        F.avg((lv == "desarrollo").cast("double")).alias("pct_desarrollo"),
        F.avg((lv == "sin_base").cast("double")).alias("pct_sin_base"),
        F.avg("score").alias("win_rate"), F.count_distinct("opening").cast("double").alias("n_openings"))
    # a row a player, read by the medians, the scaler and the vectors
    ensure_checkpoint_dir(p.sparkSession)
    p = p.checkpoint(eager=True)
    out = attach_values(p, {f"__m_{c}": q[0] for c, q in exact_quantiles(p, KNN_FEATURES, [0.5]).items()})
    for c in KNN_FEATURES:
        out = out.withColumn(c, F.coalesce(F.col(c), F.col(f"__m_{c}"), F.lit(50.0)))
    return out.drop(*[f"__m_{c}" for c in KNN_FEATURES])


def weighted_vectors(profiles: DataFrame) -> DataFrame:
    """Standardise (population std, 0 -> 1) and weight the kNN features."""
    st = profiles.agg(*[F.avg(c).alias(f"__mu_{c}") for c in KNN_FEATURES],
                      *[F.stddev_pop(c).alias(f"__sd_{c}") for c in KNN_FEATURES])
    p = attach_scalars(profiles, st)
    comps = []
    for c, w in zip(KNN_FEATURES, KNN_WEIGHTS):
        sd = F.when((F.col(f"__sd_{c}") == 0) | F.col(f"__sd_{c}").isNull(), F.lit(1.0)).otherwise(F.col(f"__sd_{c}"))
        comps.append((F.coalesce(F.col(c), F.lit(0.0)) - F.col(f"__mu_{c}")) / sd * w)
    return p.select("player", "rating_mean", F.array(*comps).alias("vec"))


def mastered_openings(game_lv: DataFrame, min_games: int = 5) -> DataFrame:
    """R03 helper: openings with >= min_games solid-level games per player."""
    s = game_lv.filter(F.col("level_id") == 0).groupBy("player", "opening").agg(F.count(F.lit(1)).alias("n"))
    return s.filter(F.col("n") >= min_games).select("player", "opening")


def neighbour_gap_openings(neigh: DataFrame, mastered: DataFrame, top: int = 5) -> DataFrame:
    """Openings mastered by neighbours but not by the player, by neighbour
    frequency (desc, tie -> name), top 5."""
    ensure_checkpoint_dir(mastered.sparkSession)
    mastered = mastered.checkpoint(eager=True)  # both sides of the gap
    nm = neigh.join(mastered.withColumnRenamed("player", "neighbour"), "neighbour")
    gaps = nm.join(mastered, ["player", "opening"], "left_anti")
    f = gaps.groupBy("player", "opening").agg(F.count(F.lit(1)).alias("freq"))
    w = Window.partitionBy("player").orderBy(F.desc("freq"), "opening")
    return f.withColumn("rank_gap", F.row_number().over(w)).filter(F.col("rank_gap") <= top)


def fuse_plans(profile_recs: DataFrame, knn_recs: DataFrame) -> DataFrame:
    """Closed form of the sequential fusion per (player, resource key):
    n_p profile and n_k neighbour registrations; n_p >= 1 -> 1 + 0.5 (n_p - 1)
    + 0.4 n_k, else 0.8 + 0.4 (n_k - 1); both sources -> min(score + 0.5, 2.0)."""
    key = F.coalesce(F.nullif(F.col("url"), F.lit("")), F.col("title"), F.lit("sin_id"))
    p = profile_recs.select("player", key.alias("res_key"), F.lit(1).alias("np"), F.lit(0).alias("nk"), "opening")
    k = knn_recs.select("player", key.alias("res_key"), F.lit(0).alias("np"), F.lit(1).alias("nk"), "opening")
    a = p.unionByName(k).groupBy("player", "res_key").agg(
        F.sum("np").alias("n_profile"), F.sum("nk").alias("n_knn"),
        F.array_join(F.array_sort(F.collect_set("opening")), "|").alias("openings"))
    npf, nk = F.col("n_profile"), F.col("n_knn")
    base = F.when(npf >= 1, 1.0 + 0.5 * (npf - 1) + 0.4 * nk).otherwise(0.8 + 0.4 * (nk - 1))
    score = F.when((npf >= 1) & (nk >= 1), F.least(base + 0.5, F.lit(2.0))).otherwise(base)
    return a.withColumn("score", score)


# Tier boost matrix (user tier, resource tier) -> multiplier.
TIER_BOOST = [
    ("beginner", "beginner", 2.5), ("beginner", "intermediate", 0.6), ("beginner", "advanced", 0.1),
    ("intermediate", "beginner", 0.4), ("intermediate", "intermediate", 1.5), ("intermediate", "advanced", 0.8),
    ("advanced", "beginner", 0.1), ("advanced", "intermediate", 0.7), ("advanced", "advanced", 2.0),
]


def user_tier(rating: F.Column) -> F.Column:
    return F.when((rating >= 0) & (rating < 1200), "beginner").when((rating >= 1200) & (rating < 1800), "intermediate") \
        .otherwise("advanced")


def tier_boosted_topn(users: DataFrame, scored: DataFrame, top_n: int = 10, free_only: bool = False,
                      formats: list[str] | None = None) -> DataFrame:
    """Score x matrix[user tier, resource tier] (missing 1.0); optional
    filters; at least max(1, int(0.4 n)) from the user's tier, the rest from
    the other tiers, final order by boosted score.

    ``users``: (player, rating); ``scored``: (player, resource_id, level_tier,
    base_score, ...). The matrix is a 9-row constant (broadcast).
    """
    u = users.withColumn("user_tier", user_tier(F.col("rating")))
    s = scored
    if free_only:
        s = s.filter(F.col("is_free") == 1)
    if formats:
        s = s.filter(F.col("format").isin(*formats))
    return _boosted_topn(unbroadcast(s).join(u.select("player", "user_tier"), "player"), top_n)


def _boosted_topn(s: DataFrame, top_n: int) -> DataFrame:
    """The ranking of ``tier_boosted_topn`` for scored rows that carry their user's tier."""
    m = s.sparkSession.createDataFrame(TIER_BOOST, "user_tier string, level_tier string, mult double")
    s = s.join(F.broadcast(m), ["user_tier", "level_tier"], "left")
    s = s.withColumn("score", F.col("base_score") * F.coalesce(F.col("mult"), F.lit(1.0)))
    own = F.col("level_tier") == F.col("user_tier")
    min_tier = max(1, int(top_n * 0.4))
    s = s.withColumn("__own", F.coalesce(own, F.lit(False))).withColumn(
        "__r", F.row_number().over(Window.partitionBy("player", "__own").orderBy(F.desc("score"), "resource_id")))
    # neither side takes more than top_n; a constant bound limits the groups before the shuffle
    s = s.filter(F.col("__r") <= max(1, top_n))
    own_top = F.col("__own") & (F.col("__r") <= min_tier)
    n_own = F.sum(own_top.cast("int")).over(Window.partitionBy("player"))
    both = s.withColumn("__k", n_own).filter(own_top | (~F.col("__own") & (F.col("__r") <= top_n - F.col("__k")))).drop("__k")
    wf = Window.partitionBy("player").orderBy(F.desc("score"), "resource_id")
    return both.withColumn("rank", F.row_number().over(wf)).filter(F.col("rank") <= top_n).drop("__own", "__r", "mult")


def outperformance(user_profile: DataFrame, k: int = 5) -> DataFrame:
    """z(pct_solid) - z(rating) over all users (sample std); top and bottom k."""
    st = user_profile.agg(F.avg("pct_solid").alias("__m1"), F.stddev_samp("pct_solid").alias("__s1"),
                          F.avg("rating").alias("__m2"), F.stddev_samp("rating").alias("__s2"))
    p = attach_scalars(user_profile, st)
    p = p.withColumn("outperformance", (F.col("pct_solid") - F.col("__m1")) / F.col("__s1")
                     - (F.col("rating") - F.col("__m2")) / F.col("__s2"))
    top = p.orderBy(F.desc("outperformance"), "player").limit(k).withColumn("side", F.lit("top"))
    bottom = p.orderBy(F.asc("outperformance"), "player").limit(k).withColumn("side", F.lit("bottom"))
    return top.unionByName(bottom).select("side", "player", "rating", "pct_solid", "outperformance")


def band_aggregate(targets: DataFrame, games: DataFrame, half_width: int = 200) -> DataFrame:
    """For every target rating, aggregate of the games whose rating lies
    within +-half_width (inclusive). Games are pre-aggregated by distinct rating
    (a table bounded by the rating scale) and the band becomes an equi join on
    exploded whole ratings of that small table, with the exact bounds checked
    after it, so ratings with a fraction keep their place."""
    per = games.groupBy(F.col("rating").cast("double").alias("g_exact")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("acl").alias("acl_sum"), F.count("acl").alias("acl_n"),
        F.sum("theory_depth").alias("t_sum"))
    per = per.withColumn("g_rating", F.floor("g_exact"))
    kind = targets.schema["rating"].dataType.simpleString()
    t = targets.select(F.col("rating").cast("long" if kind in ("int", "bigint") else "double").alias("target")).distinct()
    te = t.withColumn("g_rating", F.explode(F.sequence(F.floor(F.col("target") - half_width), F.floor(F.col("target") + half_width))))
    j = te.join(per, "g_rating").filter(F.abs(F.col("g_exact") - F.col("target")) <= half_width)
    return j.groupBy("target").agg(F.sum("n").alias("n_games"), (F.sum("acl_sum") / F.sum("acl_n")).alias("acl_mean"),
                                   (F.sum("t_sum") / F.sum("n")).alias("theory_mean"))


def diversified_topn(df: DataFrame, keys: list[str], order: list, n: int, type_col: str = "course_type") -> DataFrame:
    """Per key, when there are more than n candidates pick greedily in
    ``order`` with at most max(1, n // 2) per ``type_col``, then fill in order.

    The greedy result equals ordering by (eligible first, order) where eligible
    = within the first ``cap`` of its type. Only two bounded candidate sets are
    ranked — the first ``cap`` of every (key, type) and the first n of every
    key (both planned with map-side WindowGroupLimit) — never a whole group.
    """
    cap = max(1, n // 2)
    cnt = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    wt = Window.partitionBy(*keys, type_col).orderBy(*order)
    wg = Window.partitionBy(*keys).orderBy(*order)
    el = df.withColumn("__r", F.row_number().over(wt)).filter(F.col("__r") <= cap).drop("__r").withColumn("__e", F.lit(1))
    fill = df.withColumn("__r", F.row_number().over(wg)).filter(F.col("__r") <= n).drop("__r").withColumn("__e", F.lit(0))
    both = el.unionByName(fill).join(cnt, keys)
    both = both.withColumn("__e", F.when(F.col("__n") <= n, 1).otherwise(F.col("__e")))
    cols = [c for c in df.columns]
    both = both.groupBy(*cols).agg(F.max("__e").alias("__e"))
    wp = Window.partitionBy(*keys).orderBy(F.desc("__e"), *order)
    return both.withColumn("pick", F.row_number().over(wp)).filter(F.col("pick") <= n).drop("__e")


def tier_boosted_by_tier(catalog: DataFrame, base_score: F.Column, top_n: int = 10) -> DataFrame:
    """R09 when the base score is a property of the resource: the boosted
    ranking depends on the user only through the user tier, so it is computed
    once per tier (3 x catalogue rows, an explode, no join) and attached to
    users by tier."""
    tiers = F.array(*[user_tier(F.lit(r)) for r in (0, 1500, 2000)])
    s = catalog.withColumn("user_tier", F.explode(tiers)).withColumn("base_score", base_score)
    out = _boosted_topn(s.withColumn("player", F.col("user_tier")), top_n)
    return out.drop("user_tier").withColumnRenamed("player", "user_tier")


def knn_loo_predictions(neigh: DataFrame, labels: DataFrame, label_col: str) -> DataFrame:
    """M05 (KNN, leave-one-out): distance-weighted vote (1/d) of the k
    neighbours (the player itself is never its own neighbour)."""
    lab = labels.select(F.col("player").alias("neighbour"), F.col(label_col).alias("cls"))
    votes = neigh.join(lab, "neighbour").groupBy("player", "cls").agg(
        F.sum(1.0 / F.greatest(F.col("distance"), F.lit(1e-9))).alias("w"))
    best = votes.groupBy("player").agg(F.min_by("cls", F.struct(-F.col("w"), F.col("cls"))).alias("y_pred"))
    out = best.join(labels.select("player", F.col(label_col).alias("y_true")), "player")
    return out.withColumn("correct", F.col("y_pred") == F.col("y_true"))


# Per-group study focus, avoided types and high-accuracy threshold;
# preferred course types per opening label.
GROUP_CFG = {
    "principiante": (["general", "tactics", "opening"], [], 65.0),
    "intermedio": (["opening", "middlegame", "tactics"], [], 74.0),
    "avanzado": (["opening", "endgame", "middlegame"], ["general"], 82.0),
}
LABEL_COURSE_TYPE = {
    "PUNTO_CRITICO": ["opening", "general"], "TEORIA_VACIA": ["opening", "middlegame"],
    "EXITO_NATURAL": ["middlegame", "general"], "DOMINIO": ["endgame", "tactics"], "NEUTRO": ["tactics", "general"],
}


def label_driven_plan(profiles: DataFrame, catalog: DataFrame, top_n: int = 3) -> DataFrame:
    """R07 + R08: label-driven resource scoring for every labelled line
    (low-volume lines excluded), top n per line.

    score = 40 [openings contain the base opening] + colour (10 same / 5 both)
    + 20 / 10 preferred course types of the label + 8 study focus of the group
    + 5 richness + 5 popularity_score (where the catalogue has one) - 15 for opening courses when accuracy >= the group's high mark
    and the label is neither critical nor empty theory; range filter and
    avoided types of the group.

    The non-opening part of the score depends on the line only through a
    *rest key* (colour, label, group, penalty, range class). Per rest key the
    best 2 n resources are enough for the non-matching side: if fewer than n of
    them miss the opening, more than n match it, and their +40 puts them before
    every resource outside the 2 n. Matching resources come from the opening bridge; of those that match an
    opening, the best n of every range class, course type and colour are enough. Candidates are thus
    bounded by rest keys, course types and colours, not by the number of lines or by the catalogue.
    """
    from ..functions import scalar as S
    spark = profiles.sparkSession
    ensure_checkpoint_dir(spark)
    pr = profiles.filter(F.col("label") != "VOLUMEN_BAJO")
    pr = (pr.withColumn("apertura", F.lower(S.base_opening("opening")))
            .withColumn("color_en", F.when(F.col("color") == "white", "white").otherwise("black")))
    cfg_rows = [(g, f, a, h) for g, (f, a, h) in GROUP_CFG.items()]
    cfg = spark.createDataFrame(cfg_rows, "group string, focus array<string>, avoid array<string>, acc_high double")
    lab_rows = [(k, v[0], v) for k, v in LABEL_COURSE_TYPE.items()]
    labd = spark.createDataFrame(lab_rows, "label string, pref1 string, prefs array<string>")
    pr = pr.join(F.broadcast(cfg), "group").join(F.broadcast(labd), "label", "left")
    pr = pr.withColumn("penalty", ((F.col("accuracy_pct") >= F.col("acc_high"))
                                   & ~F.col("label").isin("PUNTO_CRITICO", "TEORIA_VACIA")).cast("int"))
    lo, hi = rating_key(F.col("rating"))
    pr = pr.withColumn("r_lo", lo).withColumn("r_hi", hi)
    popularity = F.coalesce(F.col("popularity_score").cast("double"), F.lit(0.0)) if "popularity_score" in catalog.columns else F.lit(0.0)
    res = catalog.select("resource_id", "course_type", popularity.alias("popularity"),
                         F.lower(F.coalesce(F.col("color"), F.lit("Both"))).alias("rcolor"),
                         (F.coalesce("has_video", F.lit(0)) + F.coalesce("has_pgn", F.lit(0))
                          + F.coalesce("has_exercises", F.lit(0)) + F.coalesce("has_spaced_rep", F.lit(0))).alias("richness"),
                         F.coalesce(F.col("level_min"), F.lit(0)).cast("long").alias("lo"),
                         F.coalesce(F.col("level_max"), F.lit(9999)).cast("long").alias("hi")).withColumn("base", F.col("richness") * 5.0 + F.col("popularity") * 5.0)
    # range classes: a and b are the catalogue's bounds next to the rating; all ratings of a class are covered by the same resources
    pr = nearest_bound(pr, "r_lo", res.select("lo"), "floor", "a")
    pr = nearest_bound(pr, "r_hi", res.select("hi"), "ceil", "b")
    pr = pr.filter(F.col("a").isNotNull() & F.col("b").isNotNull()).checkpoint(eager=True)
    rest_cols = ["color_en", "label", "group", "penalty", "a", "b"]
    taste = ["pref1", "prefs", "focus", "avoid"]

    def rest_score(df):
        ct = F.coalesce(F.col("course_type"), F.lit(""))
        col_s = F.when(F.col("rcolor") == F.col("color_en"), 10).when(F.col("rcolor") == "both", 5).otherwise(0)
        pref = F.when(ct == F.coalesce(F.col("pref1"), F.lit("general")), 20).when(
            F.array_contains(F.coalesce(F.col("prefs"), F.array(F.lit("general"))), ct), 10).otherwise(0)
        foc = F.when(F.array_contains(F.col("focus"), ct), 8).otherwise(0)
        pen = F.when((F.col("penalty") == 1) & (ct == "opening"), -15).otherwise(0)
        return (col_s + pref + foc + pen).cast("double") + F.col("richness") * 5.0 + F.col("popularity") * 5.0

    def eligible(df):
        return df.filter((F.col("lo") <= F.col("a")) & (F.col("hi") >= F.col("b"))
                         & ~F.array_contains(F.col("avoid"), F.coalesce(F.col("course_type"), F.lit(""))))
    # rest-key pools: the score depends on the rest key only through course type and colour, so the best of every
    # (range class, course type, colour) are found first, for all rest keys at once
    place, kind = F.min(F.col("r_lo") + F.col("r_hi")).alias("place"), ["course_type", "rcolor"]
    best_of = _best_by_range(pr.groupBy("a", "b").agg(place), res, kind, 2 * top_n)
    rk = pr.select(*rest_cols, *taste).distinct()
    scored = eligible(rk.join(best_of, ["a", "b"])).withColumn("s", rest_score(None))
    w = Window.partitionBy(*rest_cols).orderBy(F.desc("s"), "resource_id")
    pools = scored.withColumn("__r", F.row_number().over(w)).filter(F.col("__r") <= 2 * top_n).drop("__r")
    # opening-matching resources per (apertura, rest key)
    ap = pr.select(F.col("apertura").alias("opening"), F.col("apertura").alias("term")).distinct()
    mt = match_bridge(ap, catalog, ["openings"]).withColumnRenamed("opening", "apertura")
    keys = pr.select("apertura", *rest_cols, *taste).distinct()
    # no rest key meets all matches: the best of every (opening, range class, course type, colour) come first here, too
    m_best = _best_by_range(pr.groupBy("apertura", "a", "b").agg(place), mt.join(unbroadcast(res), "resource_id"), kind, top_n, by=("apertura",))
    m_sc = eligible(keys.join(m_best, ["apertura", "a", "b"])).withColumn("s", rest_score(None) + 40.0)
    wm = Window.partitionBy("apertura", *rest_cols).orderBy(F.desc("s"), "resource_id")
    m_top = m_sc.withColumn("__r", F.row_number().over(wm)).filter(F.col("__r") <= top_n).select(
        "apertura", *rest_cols, "resource_id", "s")
    p_side = keys.drop(*taste).join(pools.select(*rest_cols, "resource_id", "s"), rest_cols)
    p_side = p_side.join(mt.withColumn("__m", F.lit(1)), ["apertura", "resource_id"], "left")
    p_side = p_side.withColumn("s", F.col("s") + F.when(F.col("__m") == 1, 40.0).otherwise(0.0)).drop("__m")
    cand = m_top.unionByName(p_side).groupBy("apertura", *rest_cols, "resource_id").agg(F.max("s").alias("score"))
    wf = Window.partitionBy("apertura", *rest_cols).orderBy(F.desc("score"), "resource_id")
    best = cand.withColumn("rank", F.row_number().over(wf)).filter(F.col("rank") <= top_n)
    lines = pr.select("player", "opening", "color", "label", "label_priority", "accuracy_pct", "apertura", *rest_cols)
    return lines.join(best, ["apertura", *rest_cols]).drop("apertura", "a", "b", "color_en", "penalty")


#: Levels of the dyadic ranges; twice a rating lies within 2 ** (RANGE_BITS - 1) of 0, ratings and bounds beyond are moved to the border.
RANGE_BITS = 33


def _best_by_range(classes: DataFrame, res: DataFrame, kind: list[str], n: int, by: tuple[str, ...] = ()) -> DataFrame:
    """Per range class (a, b, place) and kind: the ``n`` resources of largest ``base`` (then smallest id) whose range holds the place
    and that have the class's values of the columns ``by``.

    A place is twice a rating, odd between two whole ones. Of resources with the same range and kind the first ``n`` go on. A
    resource's range is cut into the dyadic ranges that make it up, two a level at most; each dyadic range keeps its best ``n``
    of every kind, and a class looks up the one range of every level that holds its place. No resource meets every class.
    """
    half, last = 2 ** (RANGE_BITS - 1), 2 ** RANGE_BITS - 1
    cut = lambda c: F.least(F.greatest(c.cast("long") + half, F.lit(0).cast("long")), F.lit(last).cast("long"))
    first, stop = "shiftright(__l + shiftleft(1L, i) - 1, i)", "shiftright(__r, i)"
    parts = (f"filter(flatten(transform(sequence(0, {RANGE_BITS}), i -> array("
             f"if({first} < {stop} AND {first} % 2 = 1, struct(i AS level, {first} AS cell), null), "
             f"if({first} < {stop} AND {stop} % 2 = 1, struct(i AS level, {stop} - 1 AS cell), null)))), x -> x IS NOT NULL)")
    order = [F.desc("base"), "resource_id"]

    def best(df: DataFrame, keys: list[str]) -> DataFrame:
        return df.withColumn("__k", F.row_number().over(Window.partitionBy(*keys, *by, *kind).orderBy(*order))).filter(F.col("__k") <= n).drop("__k")
    # a range that ends before it begins holds nothing; the last place stands for all beyond it
    cells = (best(res, ["lo", "hi"]).withColumn("__l", cut(F.col("lo") * 2)).withColumn("__r", F.when(F.col("lo") <= F.col("hi"), cut(F.col("hi") * 2) + 1).otherwise(0))
             .withColumn("part", F.explode(F.expr(parts))).select("*", "part.level", "part.cell").drop("part", "__l", "__r"))
    at = (classes.withColumn("__p", cut(F.col("place")))
          .withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(RANGE_BITS)))).withColumn("cell", F.expr("shiftright(__p, level)")).select("a", "b", *by, "level", "cell"))
    found = at.join(unbroadcast(best(cells, ["level", "cell"])), ["level", "cell", *by])
    return best(found, ["a", "b"]).drop("level", "cell")


def rank_lines(profiles: DataFrame) -> DataFrame:
    """Every player's lines in the order of study: label priority,
    then accuracy; low-volume lines are left out, unknown labels come last."""
    d = profiles.filter(F.col("label") != "VOLUMEN_BAJO").withColumn("label_priority", F.coalesce(F.col("label_priority"), F.lit(99)))
    w = Window.partitionBy("player").orderBy("label_priority", F.round("accuracy_pct", 8), "opening", "color")
    return d.withColumn("line_rank", F.row_number().over(w).cast("long"))


# Course-type bonus (first key contained wins) and level -> tier (app search).
TYPE_BONUS = [("video", 8), ("youtube", 8), ("book", 6), ("libro", 6), ("lichess_study", 4)]
LEVEL_TO_TIER = {"sin_base": "beginner", "desarrollo": "intermediate", "dominio": "expert"}
APP_LEVEL_PRIO = {"sin_base": 0, "desarrollo": 1, "dominio": 2}


def _type_bonus(ct: F.Column) -> F.Column:
    t = F.lower(F.coalesce(ct, F.lit("")))
    e = None
    for k, v in TYPE_BONUS:
        c = F.instr(t, k) > 0
        e = F.when(c, v) if e is None else e.when(c, v)
    return e.otherwise(0).cast("double")


def _item() -> F.Column:
    """What a candidate list holds of a resource; lists are sorted by falling score, then id."""
    return F.struct((-F.col("score")).alias("order"), "resource_id", "course_type", "level_tier")


def _search_classes(requests: DataFrame, res: DataFrame, small_pool: int) -> DataFrame:
    """``requests`` with what their answers depend on: wanted tier, pool settings, bounds of the range class and whether the range counts."""
    rq = (requests.withColumn("color_en", F.when(F.col("color") == "white", "white").otherwise("black"))
                  .withColumn("tier_obj", _map(LEVEL_TO_TIER, F.col("level"), "intermediate")))
    lo, hi = rating_key(F.col("rating"))
    rq = rq.withColumn("r_lo", lo).withColumn("r_hi", hi).withColumn("free_key", F.coalesce(F.col("free"), F.lit(-1)))
    # colour pools smaller than ``small_pool`` rows fall back to the whole catalogue (2 counts)
    cc = res.select(F.explode(F.array(F.lit("white"), F.lit("black"))).alias("color_en"), "rcolor") \
        .filter(F.col("rcolor").isin("both") | (F.col("rcolor") == F.col("color_en"))) \
        .groupBy("color_en").agg(F.count(F.lit(1)).alias("__nc"))
    rq = rq.join(F.broadcast(cc), "color_en", "left").withColumn("all_colors", F.coalesce(F.col("__nc"), F.lit(0)) < small_pool).drop("__nc")
    # a resource covers (r_lo, r_hi) iff lo <= a and hi >= b: a and b are the nearest bounds of the catalogue
    rq = nearest_bound(rq, "r_lo", res.select("lo"), "floor", "a")
    rq = nearest_bound(rq, "r_hi", res.select("hi"), "ceil", "b")
    return rq.withColumn("a", F.coalesce("a", F.lit(-(2 ** 62)))).withColumn("b", F.coalesce("b", F.lit(2 ** 62)))


POOL = ["color_en", "all_colors", "free_key", "a", "b"]


def _answer_lists(rq: DataFrame, res: DataFrame, top_n: int, most: int) -> DataFrame:
    """Per answer class (opening, pool, range use): the candidates of every priority, best first, as arrays.

    ``hits`` holds the first ``2 top_n + most`` matching resources of each tier, ``rest`` the first
    ``2 top_n`` and more of the pool that do not match. A request that excludes ``most`` resources at most
    finds all it needs there: the rest opens only when fewer than ``top_n`` matching ones remain, so at
    most ``top_n - 1 + most`` of the pool's first ``3 top_n - 1 + 2 most`` can fall away as matching or excluded.
    """
    from ..functions.text import WORD_TERMS
    # a resource stands under each pool setting that is asked for (colour x all-colours flag x free channel: 12 rows at most)
    setting = ["color_en", "all_colors", "free_key"]
    res_k = (res.withColumn("color_en", F.explode(F.array(F.lit("white"), F.lit("black"))))
                .withColumn("all_colors", F.explode(F.array(F.lit(True), F.lit(False))))
                .withColumn("free_key", F.explode(F.array(F.lit(1), F.lit(0), F.lit(-1)))))
    res_k = res_k.filter((F.col("all_colors") | F.col("rcolor").isin("both") | (F.col("rcolor") == F.col("color_en")))
                         & ((F.col("free_key") == -1) | (F.col("is_free") == F.col("free_key"))))
    asked = rq.select(*setting).filter(F.col("free_key").isin(1, 0, -1)).distinct().checkpoint(eager=True)
    res_k = res_k.join(F.broadcast(asked), setting, "left_semi")
    base = F.coalesce(F.col("rating_score"), F.lit(0.0)) * 0.5 + _type_bonus(F.col("course_type"))
    res_k = res_k.withColumn("base", base).select(*setting, "resource_id", "course_type", "level_tier", "lo", "hi", "base")
    # resources with the same range are in or out of a pool together, so the first of each range hold all that a pool's list can take
    length = 3 * top_n - 1 + 2 * most
    held = res_k.withColumn("score", F.col("base")).withColumn("__r", F.row_number().over(
        Window.partitionBy(*setting, "lo", "hi").orderBy(F.desc("score"), "resource_id")))
    held = unbroadcast(held.filter(F.col("__r") <= max(1, length)).drop("__r").checkpoint(eager=True))
    in_range = (F.col("lo") <= F.col("a")) & (F.col("hi") >= F.col("b"))
    # does the range leave anything in the pool? else it does not count
    pools = rq.select(*POOL).distinct()
    covered = pools.join(held, setting).groupBy(*POOL).agg(F.max(in_range.cast("int")).alias("use_range"))
    pools = pools.join(covered, POOL, "left").withColumn("use_range", F.coalesce(F.col("use_range") == 1, F.lit(False)))
    pools = pools.checkpoint(eager=True)
    ok = ~F.col("use_range") | in_range
    # the rest: one list per pool
    every = pools.join(held, setting).filter(ok)
    best = Window.partitionBy(*POOL).orderBy(F.desc("score"), "resource_id")
    every = every.withColumn("__r", F.row_number().over(best)).filter(F.col("__r") <= length)
    every = every.groupBy(*POOL).agg(F.sort_array(F.collect_list(_item())).alias("pool"))
    # matching resources (app synonyms, word-bounded terms, openings + title) per opening and pool
    terms = synonym_terms(rq.select("opening"), "app")
    # both texts of a resource go through the bridge together
    texts = res.select(F.explode(F.array(F.struct(F.lit(1).alias("open"), F.col("openings").alias("text")), F.struct(F.lit(0).alias("open"), F.col("title").alias("text")))).alias("x"), "resource_id")
    texts = texts.select(F.struct("x.open", F.col("resource_id").alias("id")).alias("resource_id"), "x.text")
    mb = match_bridge(terms, texts, ["text"], WORD_TERMS).groupBy("opening", F.col("resource_id.id").alias("resource_id")).agg(
        F.max(F.col("resource_id.open")).alias("m_open"), F.max(1 - F.col("resource_id.open")).alias("m_title"))
    keys = rq.select("opening", *POOL).distinct().join(pools, POOL)
    first = [F.desc("score"), "resource_id"]
    found = mb.join(unbroadcast(res_k), "resource_id").withColumn("score", F.col("m_open") * 60.0 + F.col("m_title") * 20.0 + F.col("base"))
    found = found.withColumn("__r", F.row_number().over(Window.partitionBy("opening", *setting, "level_tier", "lo", "hi").orderBy(*first)))
    found = found.filter(F.col("__r") <= 2 * top_n + most).drop("__r")
    hits = keys.join(unbroadcast(found), ["opening", *setting]).filter(ok)
    tier = Window.partitionBy("opening", *POOL, "level_tier").orderBy(*first)
    hits = hits.withColumn("__r", F.row_number().over(tier)).filter(F.col("__r") <= 2 * top_n + most)
    hits = hits.groupBy("opening", *POOL).agg(F.sort_array(F.collect_list(_item())).alias("hits"))
    out = keys.join(hits, ["opening", *POOL], "left").join(every, POOL, "left")
    none = F.array().cast(every.schema["pool"].dataType)
    out = out.withColumn("hits", F.coalesce("hits", none)).withColumn("pool", F.coalesce("pool", none))
    few = F.size("hits") < top_n + most  # else the rest never opens
    rest = F.filter("pool", lambda r: ~F.exists("hits", lambda h: h["resource_id"] == r["resource_id"]))
    return out.select("opening", *POOL, "hits", F.when(few, rest).otherwise(none).alias("rest"))


def _picked(hits: F.Column, rest: F.Column, tier: F.Column, gone: F.Column, n: int) -> F.Column:
    """The answer of one request as an array of (resource_id, prio) in the order picked.

    P1 = hits of the wanted tier, P2 = other hits (if P1 < n), P3 = the rest (if P1 + P2 < n), without
    ``gone``; of the first 2n, more than n are thinned to max(1, n // 2) a course type and filled up in order (W12).
    """
    left = lambda x: ~F.array_contains(gone, x["resource_id"])
    wanted = lambda x: F.coalesce(x["level_tier"] == tier, F.lit(False))
    named = lambda xs, prio: F.transform(xs, lambda x: F.struct(x["resource_id"].alias("resource_id"), F.lower(F.coalesce(x["course_type"], F.lit(""))).alias("type"), F.lit(prio).alias("prio")))  # noqa: E731,E501
    p1 = named(F.slice(F.filter(hits, lambda x: wanted(x) & left(x)), 1, 2 * n), 1)
    p2 = named(F.slice(F.filter(hits, lambda x: ~wanted(x) & left(x)), 1, 2 * n), 2)
    p3 = named(F.slice(F.filter(rest, left), 1, 2 * n), 3)
    none = F.slice(p1, 1, 0)
    rows = _let(p1, lambda one: F.concat(one, F.when(F.size(one) < n, p2).otherwise(none)))
    rows = _let(rows, lambda two: F.concat(two, F.when(F.size(two) < n, p3).otherwise(none)))

    def thinned(xs: F.Column) -> F.Column:
        cap = max(1, n // 2)
        early = F.filter(xs, lambda x, i: (F.size(xs) <= n) | (F.size(F.filter(F.slice(xs, F.lit(1), i), lambda y: y["type"] == x["type"])) < cap))
        return _let(F.slice(early, 1, n), lambda some: F.slice(F.concat(some, F.filter(xs, lambda x: ~F.exists(some, lambda y: y["resource_id"] == x["resource_id"]))), 1, n))
    return _let(F.slice(rows, 1, 2 * n), thinned)


def _let(value: F.Column, use) -> F.Column:
    """``use(value)`` with ``value`` evaluated once."""
    return F.transform(F.array(value), use)[0]


def three_priority_search(requests: DataFrame, catalog: DataFrame, top_n: int = 3,
                          excluded: DataFrame | None = None, small_pool: int = 10) -> DataFrame:
    """Application search for every request at once.

    requests: (req_id, color ['white'/'black'], opening, level, rating, free [1/0/NULL]).
    Pool: colour in {colour, both, NULL} (whole catalogue when that leaves
    fewer than ``small_pool`` rows, as the application does), free filter, level range (skipped when it empties the
    pool), minus ``excluded`` (req_id, resource_id). Score 60 opening match +
    20 title match + 0.5 rating + type bonus. P1 = match and tier, P2 = match
    any tier (if P1 < n), P3 = no match (if P1 + P2 < n); first 2n, then the
    diversified top n (W12); rows outside P1 carry ``fallback_tier``.

    Candidates are ranked once per answer class (opening, colour, channel, range class) and kept as
    arrays long enough for the largest number of exclusions; a request meets its class's arrays in one equi
    join and picks its answer inside its own row, so no table ever has a row per request and candidate.
    """
    spark = catalog.sparkSession
    ensure_checkpoint_dir(spark)
    res = _searched(catalog)
    rq = _search_classes(requests.checkpoint(eager=True), res, small_pool).checkpoint(eager=True)
    most = 0
    gone = F.array().cast("array<string>")
    if excluded is not None:
        ex = excluded.groupBy("req_id").agg(F.collect_set("resource_id").alias("gone")).checkpoint(eager=True)
        most = ex.agg(F.max(F.size("gone"))).first()[0] or 0
        rq = rq.join(ex, "req_id", "left")
        gone = F.coalesce(F.col("gone"), gone)
    lists = _answer_lists(rq, res, top_n, most)
    got = rq.join(lists, ["opening", *POOL])
    got = got.select("req_id", F.posexplode(_picked(F.col("hits"), F.col("rest"), F.col("tier_obj"), gone, top_n)).alias("pick", "x"))
    got = got.select("req_id", (F.col("pick") + 1).alias("pick"), "x.resource_id", "x.prio")
    return _described(got, res)


def _searched(catalog: DataFrame) -> DataFrame:
    """The catalogue's columns that a search reads, with open bounds filled in; written once, as several branches read them."""
    return catalog.select("resource_id", "title", "source", "course_type", "level_tier", "is_free", "openings",
                          "rating_score", F.lower(F.trim(F.coalesce(F.col("color"), F.lit("Both")))).alias("rcolor"),
                          F.coalesce(F.col("level_min"), F.lit(0)).cast("long").alias("lo"),
                          F.coalesce(F.col("level_max"), F.lit(9999)).cast("long").alias("hi")).checkpoint(eager=True)


def _described(got: DataFrame, res: DataFrame) -> DataFrame:
    """Picks with the resource's columns and the tier of a fallback."""
    out = got.join(unbroadcast(res.select("resource_id", "title", "source", "course_type", "level_tier", "is_free")), "resource_id")
    return out.withColumn("fallback_tier", F.when(F.col("prio") != 1, F.col("level_tier")))


def study_plan(opening_levels: DataFrame, ratings: DataFrame, catalog: DataFrame, top_openings: int = 5,
               top_n: int = 3, small_pool: int = 10) -> DataFrame:
    """Per player and colour the first lines (level priority, then win
    rate, n >= 2); for each line a free and a paid channel (R05), each channel
    excluding resources already used by earlier lines of that colour.

    One search for all lines: a channel's lines and their candidate arrays meet in one row, and a fold
    over the lines picks each answer without what the earlier ones took. The arrays are long enough
    for the ``(top_openings - 1) * top_n`` resources that can be taken before.
    """
    ensure_checkpoint_dir(catalog.sparkSession)
    ol = opening_levels.filter(F.col("n_games") >= 2).withColumn("prio", _map(APP_LEVEL_PRIO, F.col("level")))
    w = Window.partitionBy("player", "color").orderBy("prio", "win_rate", "opening")
    lines = ol.withColumn("line_rank", F.row_number().over(w)).filter(F.col("line_rank") <= top_openings)
    lines = lines.join(ratings, "player").select("player", "color", "opening", "level", "rating", "line_rank", F.explode(F.array(F.lit(1), F.lit(0))).alias("free"))
    res = _searched(catalog)
    rq = _search_classes(lines.checkpoint(eager=True), res, small_pool).checkpoint(eager=True)
    lists = _answer_lists(rq, res, top_n, (top_openings - 1) * top_n)
    steps = rq.join(lists, ["opening", *POOL]).groupBy("player", "color", "free").agg(
        F.sort_array(F.collect_list(F.struct("line_rank", "opening", "tier_obj", "hits", "rest"))).alias("steps"))
    start = F.struct(F.array().cast("array<string>").alias("gone"),
                     F.array().cast("array<struct<line_rank:int,opening:string,pick:int,resource_id:string,prio:int>>").alias("out"))

    def step(state: F.Column, line: F.Column) -> F.Column:
        def taken(xs: F.Column) -> F.Column:
            rows = F.transform(xs, lambda x, i: F.struct(line["line_rank"].alias("line_rank"), line["opening"].alias("opening"), (i + 1).alias("pick"),
                                                         x["resource_id"].alias("resource_id"), x["prio"].alias("prio")))
            return F.struct(F.concat(state["gone"], F.transform(xs, lambda x: x["resource_id"])).alias("gone"), F.concat(state["out"], rows).alias("out"))
        return _let(_picked(line["hits"], line["rest"], line["tier_obj"], state["gone"], top_n), taken)
    plan = steps.select("player", "color", "free", F.explode(F.aggregate("steps", start, step, lambda s: s["out"])).alias("x"))
    return _described(plan.select("player", "color", "free", "x.*"), res)
