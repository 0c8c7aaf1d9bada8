"""Dataset audits and quality checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalar as S
from .common import attach_scalars, attach_values, exact_quantiles

CLASS_ORDER_4 = ["beginner", "intermediate", "advanced", "expert"]


def audit_by_band(games: DataFrame) -> DataFrame:
    """Per right-closed rating band: users, games, mean theory, accuracy of
    the mean acl, win %, a flag for bands with fewer than 2 users, and the
    global median acl (one-row aggregate attached)."""
    g = games.withColumn("band", S.bin_right_closed("rating", S.BINS_9, S.AUDIT_LABELS)).filter(F.col("band").isNotNull())
    d = g.groupBy("band").agg(
        F.count_distinct("player").alias("users"), F.count("game_id").alias("games"),
        F.bround(F.avg("theory_depth"), 1).alias("theory_mean"), F.avg("acl").alias("avg_acl"),
        F.avg("score").alias("win_rate"))
    d = (d.withColumn("accuracy", S.accuracy("avg_acl", 1))
          .withColumn("win_pct", F.bround(F.col("win_rate") * 100, 1))
          .withColumn("few_users", F.col("users") < 2))
    return attach_values(d, {"global_median_acl": exact_quantiles(games, ["acl"], [0.5])["acl"][0]})


def top_contributors(games: DataFrame, n: int = 5) -> DataFrame:
    """Top-n (player, rating) by number of games (ties by player)."""
    t = games.groupBy("player", "rating").agg(F.count("game_id").alias("n_games"),
                                               F.avg("theory_depth").alias("theory_mean"))
    return t.orderBy(F.desc("n_games"), "player", "rating").limit(n)


def class_distribution(enriched: DataFrame) -> DataFrame:
    """Users / games / means per 4-class level in fixed order plus the
    max/min games ratio and its imbalance alert (> 3)."""
    e = enriched.withColumn("level4", S.bin_right_closed("rating", S.BINS_4, S.LABELS_4)).filter(F.col("level4").isNotNull())
    d = e.groupBy("level4").agg(
        F.count_distinct("player").alias("users"), F.count("game_id").alias("games"),
        F.bround(F.avg("acc_game"), 1).alias("acc_mean"), F.bround(F.avg("theory_depth"), 1).alias("theory_mean"),
        F.bround(F.avg("score") * 100, 1).alias("win_pct"))
    ratio = d.agg((F.max("games") / F.greatest(F.min("games"), F.lit(1))).alias("imbalance_ratio"))
    out = attach_scalars(d, ratio).withColumn("imbalance_alert", F.col("imbalance_ratio") > 3)
    order = F.create_map(*[x for i, c in enumerate(CLASS_ORDER_4) for x in (F.lit(c), F.lit(i))])
    return out.withColumn("class_order", order[F.col("level4")])


# Expected range of feature means.
EXPECTED_MEAN_RANGES = [("theory_depth", 5.0, 12.0), ("acl_w", 50.0, 200.0), ("acc_game", 10.0, 80.0),
                        ("prep_score", 0.3, 0.7), ("risk_index", 3.0, 30.0)]


def feature_range_check(features: DataFrame) -> DataFrame:
    """Mean and max of each feature vs its expected mean range; in_range flag."""
    cols = [c for c, _, _ in EXPECTED_MEAN_RANGES]
    one = features.agg(*[F.avg(c).alias(f"mean_{c}") for c in cols], *[F.max(c).cast("double").alias(f"max_{c}") for c in cols])
    stack = "stack({n}, {a}) as (feature, mean, max, lo, hi)".format(
        n=len(cols), a=", ".join(f"'{c}', mean_{c}, max_{c}, CAST({lo} AS DOUBLE), CAST({hi} AS DOUBLE)"
                                 for c, lo, hi in EXPECTED_MEAN_RANGES))
    r = one.selectExpr(stack)
    return r.withColumn("in_range", (F.col("mean") >= F.col("lo")) & (F.col("mean") <= F.col("hi")))


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys occurring more than once (GROUP BY ... HAVING)."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def flag_overlap(features: DataFrame) -> DataFrame:
    """Number of games by number of active flags."""
    n = F.col("is_theory_expert") + F.col("is_feeling_natural") + F.col("is_critical_point")
    return features.groupBy(n.alias("n_flags")).agg(F.count(F.lit(1)).alias("n_games"))
