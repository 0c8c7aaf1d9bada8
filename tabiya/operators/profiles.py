"""Game features and player / opening profiles (P03-P13, P26, A01-A11, A31,
A34-A35, J01-J03, W08-W09).

Shape rules used throughout: per-player statistics are grouped aggregates
(partial aggregation map-side, so a player holding a third of all games is
pre-reduced before the shuffle) joined back on the player key, never a window
over all games of a player. Windows only run over already aggregated rows
(one row per player x opening x colour), whose groups are bounded by the
opening domain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalar as S


def game_features(games: DataFrame, variant: str = "app") -> DataFrame:
    """Per-game features (P01, P03, P05-P10, P12, P13). No shuffle.

    ``app`` (default): prep/risk/flags from the raw-acl accuracy, rounded;
    ``aug``: from the winsorised accuracy, clipped theory.
    """
    t = F.col("theory_depth")
    g = (games
         .withColumn("acc", S.accuracy("acl", 2))
         .withColumn("acl_w", S.winsorize("acl"))
         .withColumn("acc_game", S.accuracy("acl_w", 2))
         .withColumn("acc_adj", S.adjusted_accuracy(t, F.col("acc")))
         .withColumn("theory_norm", S.theory_norm(t)))
    base = F.col("acc") if variant == "app" else F.col("acc_game")
    g = (g.withColumn("prep_score", S.prep_score(t, base, variant))
          .withColumn("risk_index", S.risk_index(t, base, variant)))
    flags = S.flag_exprs_null_false(S.game_flags(t, base, variant))
    g = g.withColumns(flags)
    return (g.withColumn("color_bin", S.color_bin("color"))
             .withColumn("level3", S.bin_left_closed("rating"))
             .withColumn("level_num", S.level_continuous("rating")))


def user_context(games: DataFrame, variant: str = "winsorized") -> DataFrame:
    """A03 (``raw``) / A04 (``winsorized``): one row per player."""
    if variant == "raw":
        agg = games.groupBy("player").agg(
            F.avg("acl").alias("avg_acl_user"),
            F.coalesce(F.stddev_samp("acl"), F.lit(0.0)).alias("std_acl_user"),
            F.avg("theory_depth").alias("avg_theory_user"),
            F.avg("score").alias("win_rate_user"),
            F.count("game_id").alias("n_games_user"),
            F.min_by("rating", F.when(F.col("rating").isNotNull(), F.col("ingest_seq"))).alias("rating_ref"))
        ratio = F.least(F.lit(1.0), F.greatest(F.lit(0.0),
                                               F.col("std_acl_user") / (F.col("avg_acl_user") + 1e-9)))
        return (agg.withColumn("accuracy_user", S.accuracy("avg_acl_user", 2))
                   .withColumn("consistency_score",
                               F.when(F.col("avg_acl_user") > 0, 1 - ratio).otherwise(F.lit(0.0))))
    g = games if "acc_game" in games.columns else game_features(games)
    agg = g.groupBy("player").agg(
        F.avg("score").alias("win_rate_user"),
        F.avg("theory_depth").alias("avg_theory_user"),
        F.avg("acl_w").alias("avg_acl_user"),
        F.coalesce(F.stddev_samp("acl_w"), F.lit(0.0)).alias("std_acl_user"),
        F.count("game_id").alias("n_games_user"),
        F.avg("acc_game").alias("accuracy_user"))
    ratio = F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.col("std_acl_user") / (F.col("avg_acl_user") + 1e-9)))
    return agg.withColumn("consistency_score", 1 - ratio)


USER_CONTEXT_COLS = ["win_rate_user", "avg_theory_user", "avg_acl_user", "std_acl_user", "n_games_user",
                     "accuracy_user", "consistency_score", "delta_acl_vs_user"]


def enrich_games(games: DataFrame, variant: str = "app") -> DataFrame:
    """App feature table: game features + user context (J01 left join, stale
    context columns dropped first) + P26 delta vs own mean."""
    g = game_features(games.drop(*[c for c in USER_CONTEXT_COLS if c in games.columns]), variant)
    ctx = user_context(g, "winsorized")
    out = g.join(ctx, "player", "left")
    return out.withColumn("delta_acl_vs_user", F.bround(F.col("acl_w") - F.col("avg_acl_user"), 2))


def opening_dashboard(games: DataFrame, digits: int = 1, by_player: bool = True,
                      feeling_theory: float = 7.0, feeling_acc: float = 65.0, feeling_n: int = 2) -> DataFrame:
    """Absolute dashboard by (player,) opening, colour."""
    keys = (["player"] if by_player else []) + ["opening", "color"]
    g = games.withColumn("acl_clean", S.winsorize("acl"))
    d = g.groupBy(*keys).agg(
        F.avg("theory_depth").alias("avg_theory"),
        F.avg("acl_clean").alias("avg_acl"),
        F.count("game_id").alias("n_games"),
        F.avg("score").alias("win_rate"))
    d = d.withColumn("accuracy", S.accuracy("avg_acl", digits))
    d = (d.withColumn("score_prep", F.col("avg_theory") / 15 * (F.col("accuracy") / 100))
          .withColumn("risk_index", F.col("avg_theory") / 15 * (100 - F.col("accuracy"))))
    feel = (F.col("avg_theory") < feeling_theory) & (F.col("accuracy") >= feeling_acc) & (F.col("n_games") >= feeling_n)
    return d.withColumn("score_feeling", F.when(F.coalesce(feel, F.lit(False)), F.col("accuracy")).otherwise(F.lit(0.0)))


def relative_dashboard(games: DataFrame) -> DataFrame:
    """Dashboard with thresholds relative to each player's own rows."""
    d = opening_dashboard(games, digits=2, feeling_n=10 ** 9).drop("score_feeling")
    stats = d.groupBy("player").agg(
        F.avg("accuracy").alias("acc_mean"),
        F.avg("avg_theory").alias("theory_mean"),
        F.percentile("risk_index", 0.6).alias("risk_p60"),
        F.percentile("score_prep", 0.5).alias("prep_p50"))
    d = d.join(stats, "player", "left")
    risk = (F.col("risk_index") > F.greatest(F.col("risk_p60"), F.lit(8.0))) & (F.col("accuracy") < F.col("acc_mean") - 10)
    mastery = ((F.col("score_prep") >= F.col("prep_p50")) & (F.col("accuracy") >= F.col("acc_mean") - 5)
               & (F.col("n_games") >= 2))
    feel = ((F.col("avg_theory") <= F.greatest(F.col("theory_mean") * 0.8, F.lit(5.0)))
            & (F.col("accuracy") >= F.col("acc_mean") - 8) & (F.col("n_games") >= 2))
    return (d.withColumn("is_risk", F.coalesce(risk, F.lit(False)))
             .withColumn("is_mastery", F.coalesce(mastery, F.lit(False)))
             .withColumn("score_feeling", F.when(F.coalesce(feel, F.lit(False)), F.col("accuracy")).otherwise(F.lit(0.0)))
             .drop("acc_mean", "theory_mean", "risk_p60", "prep_p50"))


def _topk(df: DataFrame, part: list[str], order: list, k: int) -> DataFrame:
    w = Window.partitionBy(*part).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def dashboard_categories(dash: DataFrame, variant: str = "pipeline", k: int | None = None) -> DataFrame:
    """Per (player, colour) risk / mastery / feeling lists, long format.

    ``pipeline`` (A01 input): risk = top 3 risk; mastery = n>=3, not in risk,
    top 3 prep; feeling > 0 top 3. ``app`` (A02 input): flagged rows, top 4,
    mastery excludes the risk list.
    """
    k = k or (3 if variant == "pipeline" else 4)
    part = ["player", "color"]
    cols = ["player", "color", "opening", "accuracy", "avg_theory", "n_games", "win_rate"]
    risk_src = dash if variant == "pipeline" else dash.filter("is_risk")
    risk = _topk(risk_src, part, [F.col("risk_index").desc_nulls_last(), "opening"], k).select(*cols, "rank")
    mast_src = dash.join(risk.select("player", "color", "opening"), ["player", "color", "opening"], "left_anti")
    mast_src = mast_src.filter(F.col("n_games") >= 3) if variant == "pipeline" else mast_src.filter("is_mastery")
    mastery = _topk(mast_src, part, [F.col("score_prep").desc_nulls_last(), "opening"], k).select(*cols, "rank")
    feel = _topk(dash.filter(F.col("score_feeling") > 0), part,
                 [F.col("score_feeling").desc_nulls_last(), "opening"], k).select(*cols, "rank")
    return (risk.withColumn("category", F.lit("risk"))
            .unionByName(mastery.withColumn("category", F.lit("mastery")))
            .unionByName(feel.withColumn("category", F.lit("feeling"))))


def dashboard_kpis(dash: DataFrame) -> DataFrame:
    """Unweighted mean over a player's opening rows; number of lines."""
    return dash.groupBy("player").agg(
        F.avg("accuracy").alias("acc_mean"), F.avg("avg_theory").alias("theory_mean"),
        F.avg("win_rate").alias("win_rate_mean"), F.count(F.lit(1)).alias("n_lines"))


def user_dataset(games: DataFrame) -> DataFrame:
    """13 user-level aggregates incl. the share of each game flag."""
    e = enrich_games(games)
    first = F.col("ingest_seq")
    return e.groupBy("player").agg(
        F.min_by("rating", first).alias("rating"),
        F.min_by("level3", first).alias("level3"),
        F.avg("score").alias("win_rate"),
        F.avg("theory_depth").alias("avg_theory"),
        F.avg("acl_w").alias("avg_acl"),
        F.coalesce(F.stddev_samp("acl_w"), F.lit(0.0)).alias("std_acl"),
        F.count("game_id").alias("n_games"),
        F.avg("prep_score").alias("avg_prep"),
        F.avg("risk_index").alias("avg_risk"),
        F.avg("is_theory_expert").alias("pct_theory_exp"),
        F.avg("is_feeling_natural").alias("pct_feeling_nat"),
        F.avg("is_critical_point").alias("pct_critical"),
        F.min_by("consistency_score", first).alias("consistency"))


def label_profile(games: DataFrame) -> DataFrame:
    """A10 + J03: label-ready profile by (player, opening, colour)."""
    g = games.withColumn("acc1", S.accuracy("acl", 1))
    agg = g.groupBy("player", "opening", "color").agg(
        F.count("game_id").alias("n_games"),
        F.avg("rating").alias("rating"),
        F.avg("theory_depth").alias("theory_mean"),
        F.stddev_samp("theory_depth").alias("theory_std"),
        F.avg("acl").alias("acl_mean"),
        F.stddev_samp("acl").alias("acl_std"),
        F.avg("acc1").alias("accuracy_pct"),
        F.avg("score").alias("win_rate"),
        F.percentile("acl", 0.25).alias("acl_p25"),
        F.percentile("acl", 0.75).alias("acl_p75"))
    totals = games.groupBy("player").agg(F.count("game_id").alias("total_user_games"))
    out = agg.join(totals, "player")
    return (out.withColumn("vol_rel", F.col("n_games") / F.col("total_user_games"))
               .withColumn("consistency", 1 - F.least(F.lit(1.0), F.greatest(F.lit(0.0),
                           F.col("acl_std") / (F.col("acl_mean") + 1e-6))))
               .withColumn("theory_acc_gap", F.col("theory_mean") - F.col("accuracy_pct") / 10)
               .withColumn("group", S.rule_group("rating"))
               .withColumn("color_enc", S.color_bin("color")))


# Per-group label thresholds (acc_low, acc_high, teo_low, teo_high) and label tier.
GROUP_THRESHOLDS = [
    ("principiante", 55.0, 65.0, 4.0, 9.0, "beginner"),
    ("intermedio", 63.0, 74.0, 5.0, 11.0, "intermediate"),
    ("avanzado", 72.0, 82.0, 7.0, 13.0, "advanced"),
]
# Label priority (lower = study first).
LABEL_PRIORITY = {"PUNTO_CRITICO": 1, "TEORIA_VACIA": 2, "NEUTRO": 3, "EXITO_NATURAL": 4, "DOMINIO": 5,
                  "VOLUMEN_BAJO": 99}


def label_openings(profile: DataFrame, min_games: int = 5, high_vol: float = 0.15) -> DataFrame:
    """A11 + J11: ordered rules on the group's thresholds (group dim broadcast)."""
    spark = profile.sparkSession
    dim = spark.createDataFrame(GROUP_THRESHOLDS, "group string, acc_low double, acc_high double, "
                                                  "teo_low double, teo_high double, label_tier string")
    p = profile.join(F.broadcast(dim), "group", "left")
    acc, teo = F.col("accuracy_pct"), F.col("theory_mean")
    acc_high, acc_low = acc >= F.col("acc_high"), acc < F.col("acc_low")
    teo_high, teo_low = teo >= F.col("teo_high"), teo <= F.col("teo_low")
    hv = F.col("vol_rel") >= high_vol

    def t(c):
        return F.coalesce(c, F.lit(False))
    label = (F.when(F.col("n_games") < min_games, "VOLUMEN_BAJO")
             .when(t(teo_low & acc_high), "EXITO_NATURAL")
             .when(t(teo_high & acc_high), "DOMINIO")
             .when(t(teo_high & acc_low), "TEORIA_VACIA")
             .when(t(hv & acc_low), "PUNTO_CRITICO")
             .otherwise("NEUTRO"))
    prio = F.create_map(*[x for kv in LABEL_PRIORITY.items() for x in (F.lit(kv[0]), F.lit(kv[1]))])
    out = p.withColumn("label", label)
    return out.withColumn("label_priority", prio[F.col("label")]).drop("acc_low", "acc_high", "teo_low", "teo_high")


def min_volume(df: DataFrame, key: list[str], min_n: int, count_col: str = "game_id") -> DataFrame:
    """A31 + J04: keep rows of keys with at least ``min_n`` rows (HAVING + semi join)."""
    ok = df.groupBy(*key).agg(F.count(count_col).alias("__n")).filter(F.col("__n") >= min_n).drop("__n")
    return df.join(ok, key, "left_semi")


def ordered_users(games: DataFrame) -> DataFrame:
    """First rating per user (file order), sorted by rating."""
    return (games.groupBy("player").agg(F.min_by("rating", "ingest_seq").alias("rating"))
                 .orderBy("rating", "player"))
