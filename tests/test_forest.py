"""Forests: trees against MLlib's, bootstrap, folds, and no pass per tree, fold and feature set."""

import math

import numpy as np
import pytest
from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tabiya.operators import forest as FO
from tabiya.operators import ml as ML

WEIGHT = np.array([1.0, 2.0, 4.0, 1.0])


def _table(n=3000, seed=4):
    rng = np.random.default_rng(seed)
    x = np.stack([rng.normal(size=n).round(2), rng.integers(0, 6, n), rng.random(n) ** 3, rng.integers(0, 2, n), np.zeros(n)], 1)
    y = (x[:, 0] + 0.4 * x[:, 1] + 2 * x[:, 2] * x[:, 3] + rng.normal(size=n) > 1).astype(int) + (x[:, 1] > 3) * (rng.random(n) < 0.6)
    return x, y


def _frame(spark, x, y, parts=3):
    rows = [(float(b), float(WEIGHT[b]), i % 5, i % 7 > 0, *map(float, a)) for i, (a, b) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "label double, class_weight double, fold int, is_train boolean, a double, b double, c double, d double, e double").repartition(parts)


def _nodes(node, at=0):
    """Heap place -> (feature, threshold) of MLlib's tree."""
    if node.getClass().getSimpleName() == "LeafNode":
        return {}
    s = node.split()
    return {at: (s.featureIndex(), s.threshold())} | _nodes(node.leftChild(), 2 * at + 1) | _nodes(node.rightChild(), 2 * at + 2)


def test_a_tree_without_draws_is_mllibs(spark):
    x, y = _table()
    df, cols = _frame(spark, x, y), list("abcde")
    sets = {"some": ["b", "a"], "all": cols}
    cuts, forests = FO.fit(df, len(x), sets, WEIGHT, 1, 6, 20, 42, bootstrap=False)
    for name, f in forests.items():
        d = VectorAssembler(inputCols=sets[name], outputCol="features").transform(df)
        theirs = DecisionTreeClassifier(maxDepth=6, minInstancesPerNode=20, weightCol="class_weight").fit(d)
        want = _nodes(theirs._java_obj.rootNode())
        got = {}

        def walk(at):
            if at < f.cut.shape[1] and f.cut[0, at] != 255:
                got[at] = (int(f.feature[0, at]), float(cuts[f.cols[f.feature[0, at]]][f.cut[0, at]]))
                walk(2 * at + 1)
                walk(2 * at + 2)
        walk(0)
        assert got.keys() == want.keys() and len(got) > 5
        assert all(got[k] == pytest.approx(want[k]) for k in got)
        said = theirs.transform(d)
        counts = FO.confusion(df, cuts, {name: f})[name]
        assert {(r.label, r.prediction): r["count"] for r in said.groupBy("label", "prediction").count().collect()} == {
            (i, j): counts[i, j] for i, j in zip(*np.nonzero(counts))}
        assert FO.weighted_f1(counts) == pytest.approx(MulticlassClassificationEvaluator(metricName="weightedFMeasure").evaluate(said))


def test_forest_is_as_good_as_mllibs(spark):
    x, y = _table(6000)
    df = _frame(spark, x, y)
    train, test = df.filter("is_train"), df.filter("not is_train")
    cuts, forests = FO.fit(train, train.count(), {"all": list("abcde")}, WEIGHT, 30, 6, 20, 42)
    asm = VectorAssembler(inputCols=list("abcde"), outputCol="features")
    theirs = RandomForestClassifier(numTrees=30, maxDepth=6, minInstancesPerNode=20, seed=42, weightCol="class_weight").fit(asm.transform(train))
    f1 = MulticlassClassificationEvaluator(metricName="weightedFMeasure").evaluate(theirs.transform(asm.transform(test)))
    assert FO.weighted_f1(FO.confusion(test, cuts, forests)["all"]) == pytest.approx(f1, abs=0.03)
    # trees differ by their draws, and the same seed gives the same trees
    assert len({r.tobytes() for r in forests["all"].cut}) == 30
    again = FO.fit(train, train.count(), {"all": list("abcde")}, WEIGHT, 30, 6, 20, 42)[1]["all"]
    assert (again.cut == forests["all"].cut).all() and (again.votes == forests["all"].votes).all()


def test_bootstrap_takes_a_row_poisson_times():
    drawn = FO._bootstrap([1, 0, 2, 3], np.array([1] * 400_000 + [7] * 100_000), 400_000)
    for part, rate in ((drawn[:400_000], 1), (drawn[400_000:], 7)):
        for k in range(12):
            share = math.exp(-rate) * rate ** k / math.factorial(k)
            assert abs((part == k).mean() - share) < 5 * math.sqrt(share / len(part)) + 1e-5


def test_nodes_look_at_every_feature_alike():
    got = FO._looked_at(np.random.default_rng(1), 50_000, 5, 3)
    assert all(len(set(r)) == 3 for r in got[:1000].tolist()) and abs(np.bincount(got.ravel()) / 50_000 - 0.6).max() < 0.02
    assert (FO._looked_at(np.random.default_rng(1), 4, 3, 3) == [0, 1, 2]).all()


def test_equal_rows_are_one_and_no_row_is_lost(spark):
    df = _frame(spark, np.tile([[1.0, 2.0, 3.0, 0.0, 0.0], [2.0, 2.0, 3.0, 1.0, 0.0]], (500, 1)), [0, 1] * 500, 1)
    cuts = {"a": np.array([1.5]), "b": np.array([]), "c": np.array([0.5, 9.0])}
    rows = FO.blocks(df, cuts, {"x": ["a", "c"], "y": ["b"]}, 4).orderBy("s").collect()
    assert [(r["s"], list(r["bins"]), np.frombuffer(r["label"], "<u2").tolist(), np.frombuffer(r["count"], "<u4").tolist()) for r in rows] == [
        (0, [0, 1, 1, 1], [0, 1], [500, 500]), (1, [0, 0], [0, 1], [500, 500])]
    assert FO._distinct([np.arange(2000) % 31] * 20, [32] * 20)[1].sum() == 2000


def test_experiments_take_few_passes(spark):
    x, y = _table(1500)
    df = _frame(spark, x, y, 2).withColumn("level", F.col("label").cast("string"))
    sc = spark.sparkContext
    sc.setJobGroup("forests", "")
    rows = ML.rf_experiments(df.drop("label", "class_weight"), "level", {"one": ["a", "b"], "all": list("abcde")}, num_trees=5, max_depth=3)
    jobs = len(sc.statusTracker().getJobIdsForGroup("forests"))
    sc.setJobGroup("others", "")
    assert [r[0] for r in rows] == ["one", "all"] and all(0.4 < r[1] < 1 and 0.4 < r[2] < 1 and r[3] == r[1] - r[2] for r in rows)
    # a pass a level and fold for all trees and sets; MLlib alone took a pass a level, fold and set, and more before
    assert jobs < 100


def test_folds_that_cannot_be_used_are_errors(spark):
    x, y = _table(100)
    df = _frame(spark, x, y, 1).withColumn("level", F.col("label").cast("string")).drop("label", "class_weight")
    for fold in (F.lit(0), F.col("fold") + 1, F.when(F.col("fold") > 0, F.col("fold"))):
        with pytest.raises(ValueError, match="fold"):
            ML.rf_experiments(df.withColumn("fold", fold), "level", {"one": ["a"]}, num_trees=2, max_depth=2)
