"""Opening-level clustering with a given model (M11, W10, A07-A09, A33, A36,
A37, M10-DB, M12, M16).

A model is a scaler (mean, population std per feature) plus k centroids in the
scaled space. Both are tiny and fixed-size (k x d numbers), so scoring inlines
them as literals: the nearest centroid is a projection (k distance expressions
and an arg-min CASE), with no join at all.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .common import attach_scalars, running_total

FEATURES = ["theory_depth", "acl_w", "prep_score", "risk_index"]
# Reference centroid table used by the SQL-checked queries (scaled space).
FIXED_CENTROIDS = [
    [0.8, -0.7, 0.8, -0.3],
    [0.0, 0.0, 0.0, 0.0],
    [-0.8, 1.0, -0.8, 0.6],
]
# Level names by quality rank and cluster-name map.
LEVEL_BY_RANK = ["dominio", "desarrollo", "sin_base"]
CLUSTER_NAMES = ["apertura_solida", "apertura_media", "apertura_debil"]
LEVEL_PRIORITY = {"sin_base": 1, "desarrollo": 2, "dominio": 3}


def scale(df: DataFrame, features: list[str], stats: DataFrame) -> DataFrame:
    """Standardise with a one-row stats frame (``m_<f>``, ``s_<f>``) attached."""
    d = attach_scalars(df, stats)
    for c in features:
        s = F.when((F.col(f"s_{c}") == 0) | F.col(f"s_{c}").isNull(), F.lit(1.0)).otherwise(F.col(f"s_{c}"))
        d = d.withColumn(f"z_{c}", (F.coalesce(F.col(c).cast("double"), F.lit(0.0)) - F.col(f"m_{c}")) / s)
    return d.drop(*[f"m_{c}" for c in features], *[f"s_{c}" for c in features])


def scaler_stats(df: DataFrame, features: list[str] = FEATURES) -> DataFrame:
    """One-row scaler frame: mean and population std of each feature (NULL -> 0)."""
    return df.agg(*[F.avg(F.coalesce(F.col(c).cast("double"), F.lit(0.0))).alias(f"m_{c}") for c in features],
                  *[F.stddev_pop(F.coalesce(F.col(c).cast("double"), F.lit(0.0))).alias(f"s_{c}") for c in features])


def assign_clusters(scaled: DataFrame, centroids: list[list[float]], features: list[str] = FEATURES) -> DataFrame:
    """Nearest centroid (first on ties) and its distance."""
    d2 = []
    for cen in centroids:
        e = F.lit(0.0)
        for c, v in zip(features, cen):
            e = e + F.pow(F.col(f"z_{c}") - F.lit(float(v)), 2)
        d2.append(e)
    out = scaled.withColumns({f"__d{i}": e for i, e in enumerate(d2)})
    best = F.least(*[F.col(f"__d{i}") for i in range(len(d2))])
    label = None
    for i in range(len(d2)):
        cond = F.col(f"__d{i}") == best
        label = F.when(cond, F.lit(i)) if label is None else label.when(cond, F.lit(i))
    out = out.withColumn("cluster_raw", label).withColumn("distance", F.sqrt(best))
    return out.drop(*[f"__d{i}" for i in range(len(d2))])


def relabel_by_quality(assigned: DataFrame, scope: str = "model", quality_col: str = "acl_w") -> DataFrame:
    """Rank clusters by mean ``quality_col`` ascending -> 0 (best) .. k-1.

    ``model``: one ranking over all rows (k-row aggregate broadcast back);
    ``player``: ranking over the clusters present in that player's rows (the
    application's behaviour), a window over at most k rows per player.
    """
    if scope == "player":
        cm = assigned.groupBy("player", "cluster_raw").agg(F.avg(quality_col).alias("__q"))
        w = Window.partitionBy("player").orderBy(F.col("__q").asc_nulls_last(), "cluster_raw")
        cm = cm.withColumn("rank", F.row_number().over(w) - 1).drop("__q")
        return assigned.join(cm, ["player", "cluster_raw"], "left")
    cm = assigned.groupBy("cluster_raw").agg(F.avg(quality_col).alias("__q"))
    w = Window.orderBy(F.col("__q").asc_nulls_last(), "cluster_raw")  # k rows
    # k rows, found once however often the relabelled rows are read
    ensure_checkpoint_dir(assigned.sparkSession)
    cm = cm.withColumn("rank", F.row_number().over(w) - 1).drop("__q").checkpoint(eager=True)
    return assigned.join(F.broadcast(cm), "cluster_raw", "left")


def level_name(rank_col: str = "rank") -> F.Column:
    arr = F.array(*[F.lit(x) for x in LEVEL_BY_RANK])
    return F.element_at(arr, F.col(rank_col) + 1)


def opening_means(enriched: DataFrame, min_games: int = 2) -> DataFrame:
    """App scoring input: per (player, opening, colour) means of the features, n >= 2."""
    r = enriched.groupBy("player", "opening", "color").agg(
        F.count("game_id").alias("n_games"), F.avg("theory_depth").alias("theory_mean"),
        F.avg("acc_adj").alias("acc_adj_mean"), F.avg("score").alias("win_rate"),
        F.avg("theory_depth").alias("theory_depth"), F.avg("acl_w").alias("acl_w"),
        F.avg("prep_score").alias("prep_score"), F.avg("risk_index").alias("risk_index"))
    return r.filter(F.col("n_games") >= min_games)


def opening_levels(enriched: DataFrame, stats: DataFrame, centroids=FIXED_CENTROIDS, scope: str = "player") -> DataFrame:
    """App M11 + W10: level of each (player, opening, colour) line."""
    om = opening_means(enriched)
    a = assign_clusters(scale(om, FEATURES, stats), centroids)
    r = relabel_by_quality(a, scope)
    return r.withColumn("level", level_name()).drop(*[f"z_{c}" for c in FEATURES])


def game_levels(enriched: DataFrame, stats: DataFrame, centroids=FIXED_CENTROIDS) -> DataFrame:
    """Game-level scoring: cluster per game, relabelled by the model-wide quality
    order (0 = solid, 1 = medium, 2 = weak)."""
    a = assign_clusters(scale(enriched, FEATURES, stats), centroids)
    return relabel_by_quality(a, "model").withColumnRenamed("rank", "level_id").drop(*[f"z_{c}" for c in FEATURES])


def opening_level_profile(game_lv: DataFrame) -> DataFrame:
    """Per player: shares of solid / medium / weak games, means, dominant
    level (argmax, ties -> solid, medium, weak)."""
    p = game_lv.groupBy("player").agg(
        F.avg("rating").alias("rating"), F.count("game_id").alias("n_games"),
        F.avg((F.col("level_id") == 0).cast("double")).alias("pct_solid"),
        F.avg((F.col("level_id") == 1).cast("double")).alias("pct_medium"),
        F.avg((F.col("level_id") == 2).cast("double")).alias("pct_weak"),
        F.avg("theory_depth").alias("avg_theory"), F.avg("acl_w").alias("avg_acl"),
        F.avg("prep_score").alias("avg_prep"), F.avg("risk_index").alias("avg_risk"), F.avg("score").alias("win_rate"))
    s, m, w = F.col("pct_solid"), F.col("pct_medium"), F.col("pct_weak")
    dom = (F.when((s >= m) & (s >= w), CLUSTER_NAMES[0]).when(m >= w, CLUSTER_NAMES[1]).otherwise(CLUSTER_NAMES[2]))
    return p.withColumn("dominant_cluster", dom)


def modal_cluster(game_lv: DataFrame, label_col: str = "level_id") -> DataFrame:
    """Most frequent label per player (smallest label on ties) and its share."""
    c = game_lv.groupBy("player", label_col).agg(F.count(F.lit(1)).alias("n"))
    t = c.groupBy("player").agg(F.sum("n").alias("__t"), F.min_by(F.col(label_col), F.struct(-F.col("n"), F.col(label_col))).alias("mode"),
                                F.max("n").alias("__nmax"))
    return t.select("player", "mode", (F.col("__nmax") / F.col("__t")).alias("mode_share"))


def cluster_profile(game_lv: DataFrame, label_col: str = "level_id") -> DataFrame:
    """Per cluster: count, mean / std of features and rating, win rate."""
    aggs = [F.count(F.lit(1)).alias("n")]
    for c in FEATURES + ["rating"]:
        aggs += [F.avg(c).alias(f"mean_{c}"), F.stddev_samp(c).alias(f"std_{c}")]
    aggs.append(F.avg("score").alias("win_rate"))
    return game_lv.groupBy(label_col).agg(*aggs)


def opening_level_ranking(game_lv: DataFrame) -> DataFrame:
    """By (opening, colour, level): n and mean accuracy."""
    return game_lv.groupBy("opening", "color", "level_id").agg(
        F.count(F.lit(1)).alias("n"), F.avg("acc").alias("acc_mean"))


def dominant_level(op_levels: DataFrame, players: DataFrame) -> DataFrame:
    """Most frequent opening level of a player (ties -> first in level-name
    order), else the rating rule (>=1800 dominio, >=1400 desarrollo, else sin_base)."""
    c = op_levels.groupBy("player", "level").agg(F.count(F.lit(1)).alias("n"))
    m = c.groupBy("player").agg(F.min_by("level", F.struct(-F.col("n"), F.col("level"))).alias("__lv"))
    rule = (F.when(F.col("rating") >= 1800, "dominio").when(F.col("rating") >= 1400, "desarrollo").otherwise("sin_base"))
    return players.join(m, "player", "left").withColumn("dominant_level", F.coalesce(F.col("__lv"), rule)).drop("__lv")


def davies_bouldin(scaled_lv: DataFrame, label_col: str, features: list[str] = FEATURES) -> DataFrame:
    """M10 (DB index): cluster means and mean distance to them from grouped
    aggregates, then the k x k centroid comparison on k rows."""
    z = [f"z_{c}" for c in features]
    cen = scaled_lv.groupBy(label_col).agg(*[F.avg(c).alias(f"c_{c}") for c in z])
    d = scaled_lv.join(F.broadcast(cen), label_col)
    dist = F.sqrt(sum((F.pow(F.col(c) - F.col(f"c_{c}"), 2) for c in z), F.lit(0.0)))
    s = d.groupBy(label_col).agg(F.avg(dist).alias("s"))
    cs = cen.join(s, label_col)
    # the k cluster rows (k = model size) folded into one row; the k x k
    # comparison runs inside that row with higher-order functions
    one = cs.agg(F.collect_list(F.struct(F.col(label_col).alias("id"), F.col("s").alias("s"),
                                         F.array(*[F.col(f"c_{c}") for c in z]).alias("c"))).alias("cl"))
    dist_ab = "sqrt(aggregate(zip_with(a.c, b.c, (x, y) -> (x - y) * (x - y)), 0D, (acc, v) -> acc + v))"
    ratio = f"array_max(transform(filter(cl, b -> b.id != a.id), b -> (a.s + b.s) / {dist_ab}))"
    return one.select(F.expr(f"aggregate(transform(cl, a -> {ratio}), 0D, (acc, v) -> acc + v) / size(cl)")
                      .alias("davies_bouldin"))


def kruskal_wallis(df: DataFrame, value_col: str, group_col: str) -> DataFrame:
    """H statistic with mid-ranks and tie correction; for 3 groups the
    chi-square(2) survival is exp(-H/2). Ranks come from counts per distinct
    value, and values below from a running total over range partitions, so no task sorts them all."""
    v = df.filter(F.col(value_col).isNotNull() & F.col(group_col).isNotNull())
    per = v.groupBy(value_col).agg(F.count(F.lit(1)).alias("t"))
    per = running_total(per, [], value_col, "t", "__below")
    per = per.withColumn("midrank", F.col("__below") + (F.col("t") + 1) / 2.0)
    g = v.groupBy(group_col, value_col).agg(F.count(F.lit(1)).alias("c")).join(per.select(value_col, "midrank"), value_col)
    rs = g.groupBy(group_col).agg(F.sum(F.col("c") * F.col("midrank")).alias("rank_sum"), F.sum("c").alias("n_group"))
    tot = per.agg(F.sum("t").alias("n_total"), F.sum(F.pow(F.col("t"), 3) - F.col("t")).alias("ties"))
    x = attach_scalars(rs, tot)
    n = F.first("n_total")
    h = x.agg((12.0 / (n * (n + 1)) * F.sum(F.pow(F.col("rank_sum"), 2) / F.col("n_group")) - 3 * (n + 1)).alias("h0"),
              n.alias("n_total"), F.first("ties").alias("ties"), F.count(F.lit(1)).alias("k"))
    h = h.withColumn("H", F.col("h0") / (1 - F.col("ties") / (F.pow(F.col("n_total"), 3) - F.col("n_total"))))
    return h.select("H", "k", F.col("n_total").alias("N"), F.when(F.col("k") == 3, F.exp(-F.col("H") / 2)).alias("p_value"))


def feature_cluster_corr(game_lv: DataFrame, label_col: str = "level_id") -> DataFrame:
    """Pearson correlation of each feature with the cluster id."""
    one = game_lv.agg(*[F.corr(F.col(c).cast("double"), F.col(label_col).cast("double")).alias(c) for c in FEATURES])
    stack = "stack({n}, {a}) as (feature, r)".format(n=len(FEATURES), a=", ".join(f"'{c}', `{c}`" for c in FEATURES))
    return one.selectExpr(stack)
