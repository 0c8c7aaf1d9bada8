"""Statistics operators (A24, A26, A33, M01-M03, M07, M10-DB, M12, M13, M16)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import attach_scalars, attach_values, exact_quantiles


def histogram(df: DataFrame, col: str, bins: int = 30) -> DataFrame:
    """Fixed-width histogram over [min, max] (last bin closed), one pass + one-row stats."""
    st = df.agg(F.min(col).alias("__lo"), F.max(col).alias("__hi"))
    d = attach_scalars(df.filter(F.col(col).isNotNull()).select(col), st)
    b = F.least(F.lit(bins), F.floor((F.col(col) - F.col("__lo")) / (F.col("__hi") - F.col("__lo")) * bins) + 1)
    return d.groupBy(b.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def top_correlations(df: DataFrame, cols: list[str], k: int = 10) -> DataFrame:
    """Pearson r of every pair below the diagonal (pairwise complete, one
    aggregation pass for all pairs), unpivoted, top-k by |r|; a pair with a
    column that is constant where both have values has no r."""
    def pearson(a: str, b: str) -> Column:
        both = F.col(a).isNotNull() & F.col(b).isNotNull()
        x, y = (F.when(both, F.col(c).cast("double")) for c in (a, b))
        return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    one = df.agg(*[pearson(a, b).alias(f"{a}__{b}") for a, b in pairs])
    stack = "stack({n}, {args}) as (col_a, col_b, r)".format(
        n=len(pairs), args=", ".join(f"'{a}', '{b}', `{a}__{b}`" for a, b in pairs))
    r = one.selectExpr(stack).filter(F.col("r").isNotNull())
    return r.orderBy(F.desc(F.abs(F.round("r", 8))), "col_a", "col_b").limit(k)


def group_split(df: DataFrame, group_col: str = "player", train_pct: int = 80, seed: int = 42,
                method: str = "hash") -> DataFrame:
    """Deterministic group-wise split (every row of a group on the same side).

    ``hash``: pmod(xxhash64(group, seed), 100) < pct; ``modulus`` (integer ids):
    (id * 7919 + seed) % 100 < pct, reproducible in any SQL engine.
    """
    if method == "modulus":
        bucket = F.pmod(F.col(group_col).cast("long") * 7919 + seed, F.lit(100))
    else:
        bucket = F.pmod(F.xxhash64(F.col(group_col), F.lit(seed)), F.lit(100))
    return df.withColumn("is_train", bucket < train_pct)


def snake_folds(users: DataFrame, class_col: str, size_col: str, k: int = 5, id_col: str = "player") -> DataFrame:
    """Stratified group k-fold: users ordered by (class, size desc, id) get
    folds 0..k-1, k-1..0, ... within their class. The position inside the class
    is a global rank minus the class start offset (no single-task window)."""
    from .common import global_rank
    r = global_rank(users, [F.col(class_col), F.col(size_col).desc(), F.col(id_col)], "__g")
    starts = r.groupBy(class_col).agg(F.min("__g").alias("__start"))
    r = r.join(F.broadcast(starts), class_col).withColumn("__p", F.col("__g") - F.col("__start"))
    m = F.col("__p") % (2 * k)
    fold = F.when(m < k, m).otherwise(2 * k - 1 - m)
    return r.withColumn("fold", fold.cast("int")).drop("__g", "__start", "__p")


def balanced_weights(df: DataFrame, label_col: str) -> DataFrame:
    """Class weight n / (k * n_c) attached to every row (class table broadcast;
    its size is the number of classes)."""
    per = df.groupBy(label_col).agg(F.count(F.lit(1)).alias("__nc"))
    tot = per.agg(F.sum("__nc").alias("__n"), F.count(F.lit(1)).alias("__k"))
    w = attach_scalars(per, tot).select(label_col, (F.col("__n") / (F.col("__k") * F.col("__nc"))).alias("class_weight"))
    return df.join(F.broadcast(w), label_col, "left")


def leakage_free_user_features(games: DataFrame, split: DataFrame) -> DataFrame:
    """User stats from training games only; users without training games
    (every test user under a group split) get the training medians of the
    user-level stats."""
    g = games.join(split.select("player", "is_train").distinct(), "player")
    tr = g.filter("is_train")
    stats = tr.groupBy("player").agg(
        F.avg("score").alias("win_rate_user"), F.avg("theory_depth").alias("avg_theory_user"),
        F.avg("acl_w").alias("avg_acl_user"), F.coalesce(F.stddev_samp("acl_w"), F.lit(0.0)).alias("std_acl_user"),
        F.count("game_id").alias("n_games_user"))
    cols = ["win_rate_user", "avg_theory_user", "avg_acl_user", "std_acl_user", "n_games_user"]
    med = {f"__m_{c}": q[0] for c, q in exact_quantiles(stats, cols, [0.5]).items()}
    users = g.select("player", "is_train").distinct().join(stats, "player", "left")
    out = attach_values(users, med)
    for c in cols:
        out = out.withColumn(c, F.coalesce(F.col(c).cast("double"), F.col(f"__m_{c}")))
    return out.drop(*[f"__m_{c}" for c in cols])


def jarque_bera(df: DataFrame, cols: dict) -> DataFrame:
    """M13 (re-aimed): normality screen on all rows: n, skewness g1, excess
    kurtosis g2 (population moments) and JB = n/6 (g1^2 + g2^2/4).
    ``cols``: name -> Column expression."""
    parts = []
    for name, e in cols.items():
        d = df.select(e.alias("x")).filter(F.col("x").isNotNull())
        parts.append(d.agg(F.lit(name).alias("feature"), F.count(F.lit(1)).alias("n"),
                           F.skewness("x").alias("skew"), F.kurtosis("x").alias("kurt")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("jb", F.col("n") / 6.0 * (F.pow("skew", 2) + F.pow("kurt", 2) / 4.0))


def classification_metrics(pairs: DataFrame, label_col: str = "y_true", pred_col: str = "y_pred") -> DataFrame:
    """From the confusion counts (one grouped pass): per-class precision,
    recall, F1, support; accuracy, balanced accuracy, macro / weighted F1,
    Cohen's kappa and multi-class MCC. Returns (metric, cls, value)."""
    conf = pairs.groupBy(F.col(label_col).alias("t"), F.col(pred_col).alias("p")).agg(F.count(F.lit(1)).alias("c"))
    tp = conf.filter(F.col("t") == F.col("p")).select(F.col("t").alias("cls"), F.col("c").alias("tp"))
    sup = conf.groupBy(F.col("t").alias("cls")).agg(F.sum("c").alias("support"))
    pc = conf.groupBy(F.col("p").alias("cls")).agg(F.sum("c").alias("pred_n"))
    per = sup.join(pc, "cls", "full").join(tp, "cls", "left").fillna(0, ["support", "pred_n", "tp"])
    prec = F.when(F.col("pred_n") > 0, F.col("tp") / F.col("pred_n")).otherwise(F.lit(0.0))
    rec = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(F.lit(0.0))
    per = per.withColumn("precision", prec).withColumn("recall", rec)
    per = per.withColumn("f1", F.when(F.col("precision") + F.col("recall") > 0, 2 * F.col("precision") * F.col("recall")
                                      / (F.col("precision") + F.col("recall"))).otherwise(F.lit(0.0)))
    n = F.sum("support")
    glob = per.agg(
        (F.sum("tp") / n).alias("accuracy"),
        F.avg(F.when(F.col("support") > 0, F.col("recall"))).alias("balanced_accuracy"),
        F.avg("f1").alias("f1_macro"),
        (F.sum(F.col("f1") * F.col("support")) / n).alias("f1_weighted"),
        n.alias("n"), F.sum("tp").alias("c"), F.sum(F.col("support") * F.col("pred_n")).alias("sp"),
        F.sum(F.col("support") * F.col("support")).alias("ss"), F.sum(F.col("pred_n") * F.col("pred_n")).alias("pp"))
    nn, c, sp, ss, pp = (F.col(x).cast("double") for x in ("n", "c", "sp", "ss", "pp"))
    glob = (glob.withColumn("kappa", (c * nn - sp) / (nn * nn - sp))
                .withColumn("mcc", (c * nn - sp) / F.sqrt((nn * nn - pp) * (nn * nn - ss))))
    g = glob.selectExpr("stack(6, 'accuracy', accuracy, 'balanced_accuracy', balanced_accuracy, 'f1_macro', f1_macro, "
                        "'f1_weighted', f1_weighted, 'kappa', kappa, 'mcc', mcc) as (metric, value)")
    g = g.withColumn("cls", F.lit("all"))
    pl = per.selectExpr("cls", "stack(4, 'precision', precision, 'recall', recall, 'f1', f1, "
                        "'support', CAST(support AS DOUBLE)) as (metric, value)")
    return g.unionByName(pl.select("metric", "value", "cls"))
