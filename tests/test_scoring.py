"""Votes, confusion, log-loss and areas against plain versions."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tabiya.operators import scoring as SC
from tabiya.operators.common import running_total


def scores(spark, rows):
    return spark.createDataFrame(rows, "k int, player int, y_true string, cls string, p double")


def test_areas_and_loss_are_the_plain_ones(spark):
    rng = random.Random(4)
    classes = ["a", "b", "c"]
    rows = []
    for player in range(300):
        y = rng.choice(classes)
        w = [rng.choice([0, 1, 1, 2]) + (c == y) for c in classes]
        rows += [(7, player, y, c, round(x / sum(w), 9) if sum(w) else 0.0) for c, x in zip(classes, w)]
    got = {(r.metric, r.cls): r.value for r in SC.probabilistic_metrics(scores(spark, rows), ["k"]).collect()}
    areas = []
    for c in classes:
        pos = [r[4] for r in rows if r[3] == c and r[2] == c]
        neg = [r[4] for r in rows if r[3] == c and r[2] != c]
        areas.append(sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / (len(pos) * len(neg)))
        assert got["roc_auc", c] == pytest.approx(areas[-1], abs=1e-12)
    assert got["roc_auc_ovr", "all"] == pytest.approx(sum(areas) / 3, abs=1e-12)
    assert got["log_loss", "all"] == pytest.approx(-sum(math.log(max(r[4], 1e-15)) for r in rows if r[2] == r[3]) / 300, abs=1e-12)


def test_one_class_has_no_area(spark):
    got = SC.probabilistic_metrics(scores(spark, [(3, 1, "a", "a", 1.0), (3, 2, "a", "a", 0.0)]), ["k"]).collect()
    assert [(r.metric, r.cls) for r in got] == [("log_loss", "all")]
    assert SC.probabilistic_metrics(scores(spark, []), ["k"]).count() == 0


def test_confusion_holds_every_cell(spark):
    pairs = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "b"), ("b", "c"), ("b", "c")], "y_true string, y_pred string")
    got = {(r.y_true, r.y_pred): (r.n, r.share) for r in SC.confusion(pairs).collect()}
    assert got == {("a", "a"): (1, 0.5), ("a", "b"): (1, 0.5), ("a", "c"): (0, 0.0), ("b", "a"): (0, 0.0), ("b", "b"): (1, 1 / 3), ("b", "c"): (2, 2 / 3)}
    assert SC.confusion(pairs.limit(0)).count() == 0


def test_neighbour_votes_by_prefix(spark):
    neigh = spark.createDataFrame([(1, 2, 0.5, 1), (1, 3, 1.0, 2), (1, 4, 1.0, 3), (1, 5, 2.0, 4)], "player int, neighbour int, distance double, rank int")
    labels = spark.createDataFrame([(1, "b"), (2, "a"), (3, "b"), (4, "b"), (5, "b")], "player int, level string")
    s = SC.neighbour_scores(neigh, labels, "level", ["a", "b", "z"], [1, 3, 4])
    assert sorted((r.k, r.cls, r.p) for r in s.collect()) == [(1, "a", 1.0), (1, "b", 0.0), (1, "z", 0.0), (3, "a", 0.5), (3, "b", 0.5), (3, "z", 0.0),
                                                            (4, "a", round(2 / 4.5, 9)), (4, "b", round(2.5 / 4.5, 9)), (4, "z", 0.0)]
    best = {r.k: (r.y_pred, r.confidence, r.correct) for r in SC.predicted(s, ["k"]).collect()}
    assert best == {1: ("a", 1.0, False), 3: ("a", 0.5, False), 4: ("b", round(2.5 / 4.5, 9), True)}


def test_running_totals_without_one_window_over_all(spark):
    rng = random.Random(5)
    rows = [(k, x, rng.randrange(9)) for k in ("p", "q") for x in rng.sample(range(10 ** 6), 800)]
    df = spark.createDataFrame(rows, "k string, x int, n int").repartition(7)
    got = {(r.k, r.x): r.below for r in running_total(df, ["k"], "x", "n", "below").collect()}
    for k, x, _ in rows[::37]:
        assert got[k, x] == sum(n for kk, y, n in rows if kk == k and y < x)
    assert running_total(df.filter("k = 'p'").drop("k"), [], "x", "n", "below").agg(F.max("below")).first()[0] <= sum(n for k, _, n in rows if k == "p")
