"""Evaluation of classifiers from their votes: neighbour grid, confusion, log-loss, ROC-AUC, confidence."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import running_total

#: The grid of neighbours.
GRID = [3, 5, 7, 9, 11]
#: A probability of the true class below this counts as this much in the log-loss.
LEAST = 1e-15


def neighbour_scores(neigh: DataFrame, labels: DataFrame, label_col: str, classes: list[str], grid: list[int] | None = None) -> DataFrame:
    """M05 / M06, kNN part: (k, player, y_true, cls, p) of every k of the grid out of one table of the most neighbours.

    ``neigh`` holds each player's ranked neighbours (without the player itself, so every row is a leave-one-out
    prediction). For each k only the first k vote, with weight 1 / distance; p is the class's share of the votes, to 9 digits.
    """
    grid = grid or GRID
    lab = labels.select(F.col("player").alias("neighbour"), F.col(label_col).alias("cls"))
    weight = 1.0 / F.greatest(F.col("distance"), F.lit(1e-9))
    # one pass over the neighbours: a sum for each k
    votes = neigh.join(lab, "neighbour").groupBy("player", "cls").agg(*[F.sum(F.when(F.col("rank") <= k, weight)).alias(f"w{k}") for k in grid])
    total = votes.groupBy("player").agg(*[F.sum(f"w{k}").alias(f"t{k}") for k in grid])
    every = labels.select("player", F.col(label_col).alias("y_true"), F.explode(F.array(*[F.lit(c) for c in classes])).alias("cls"))
    d = every.join(total, "player").join(votes, ["player", "cls"], "left")
    share = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.round(F.coalesce(F.col(f"w{k}"), F.lit(0.0)) / F.col(f"t{k}"), 9).alias("p")) for k in grid]))
    return d.select("player", "y_true", "cls", share.alias("x")).select("x.k", "player", "y_true", "cls", "x.p")


def predicted(scores: DataFrame, keys: list[str]) -> DataFrame:
    """The class of the largest probability (ties: first in order of names) and that probability as confidence."""
    best = F.max(F.col("p"))
    d = scores.groupBy(*keys, "player", "y_true").agg(F.min_by("cls", F.struct(-F.col("p"), F.col("cls"))).alias("y_pred"), best.alias("confidence"))
    return d.withColumn("correct", F.col("y_pred") == F.col("y_true"))


def confusion(pairs: DataFrame, label_col: str = "y_true", pred_col: str = "y_pred") -> DataFrame:
    """Counts of (true, predicted) and their share of the true class, with every cell of the classes that occur."""
    c = pairs.groupBy(F.col(label_col).alias("y_true"), F.col(pred_col).alias("y_pred")).agg(F.count(F.lit(1)).alias("n"))
    per = c.groupBy("y_true").agg(F.sum("n").alias("support"), F.collect_list(F.struct("y_pred", "n")).alias("cells"))
    names = c.agg(F.array_sort(F.array_union(F.collect_set("y_true"), F.collect_set("y_pred"))).alias("names")).first()["names"]  # the classes
    d = per.withColumn("y_pred", F.explode(F.array(*[F.lit(x) for x in names]))) if names else per.withColumn("y_pred", F.lit(None).cast("string"))
    n = F.coalesce(F.element_at(F.map_from_entries("cells"), F.col("y_pred")), F.lit(0))
    return d.select("y_true", "y_pred", n.alias("n"), (n / F.col("support")).alias("share"))


def probabilistic_metrics(scores: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, metric, cls, value): log-loss, one-vs-rest ROC-AUC of each class and their mean.

    A class's area is the share of (member, other) pairs that its scores put in order, ties counting half: scores
    are counted, and the others below a score are a running total over range partitions, so no task
    sorts all scores.
    """
    loss = scores.filter(F.col("cls") == F.col("y_true")).groupBy(*keys).agg((-F.avg(F.log(F.greatest("p", F.lit(LEAST))))).alias("value"))
    loss = loss.select(*keys, F.lit("log_loss").alias("metric"), F.lit("all").alias("cls"), "value")
    own = F.col("cls") == F.col("y_true")
    counts = scores.groupBy(*keys, "cls", "p").agg(F.sum(own.cast("long")).alias("pos"), F.sum((~own).cast("long")).alias("neg"))
    below = running_total(counts, [*keys, "cls"], "p", "neg", "below")
    area = below.groupBy(*keys, "cls").agg(F.sum(F.col("pos") * (F.col("below") + F.col("neg") / 2)).alias("a"), F.sum("pos").alias("np"), F.sum("neg").alias("nn"))
    # a class that all or none of the rows have has no area
    area = area.filter((F.col("np") > 0) & (F.col("nn") > 0)).select(*keys, "cls", (F.col("a") / (F.col("np") * F.col("nn"))).alias("value"))
    mean = area.groupBy(*keys).agg(F.avg("value").alias("value")).select(*keys, F.lit("roc_auc_ovr").alias("metric"), F.lit("all").alias("cls"), "value")
    return loss.unionByName(area.select(*keys, F.lit("roc_auc").alias("metric"), "cls", "value")).unionByName(mean)
