"""Model training and evaluation.

Training is distributed by MLlib, or by passes over the rows in ``kmeans.py`` and ``forest.py``; the driver only receives model parameters
whose size is fixed by the model (k centroids, a depth-4 tree, metrics).
"""

from __future__ import annotations

import math
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import clusters as K
from . import forest as FO
from . import kmeans as KM
from .stats import balanced_weights


def _zcols(features):
    return [f"z_{c}" for c in features]


def train_kmeans(scaled: DataFrame, k: int = 3, starts: int = 20, seed: int = 42, features=K.FEATURES) -> KM.Model | None:
    """K-means of the scaled features, the best of ``starts`` k-means++ starts."""
    return KM.fit(KM.points(scaled, features), [k], starts, seed).get(k)


def k_sweep(scaled: DataFrame, ks=range(2, 9), starts: int = 10, seed: int = 42, features=K.FEATURES, sample: int = 5000) -> list[tuple]:
    """Per k the least cost of ``starts`` starts, the Euclidean silhouette of a
    sample of ``sample`` rows, and the Davies-Bouldin index."""
    pts = KM.points(scaled, features)
    models = KM.fit(pts, ks, starts, seed)
    worth = KM.silhouettes(pts, models, sample, seed)
    return [(k, m.cost, worth[k], m.davies_bouldin()) for k, m in models.items()]


#: A forest's task takes this many training rows, as long as there are cores for the tasks.
ROWS_PER_TASK = 20_000


def _spread(rows: DataFrame) -> DataFrame:
    """``rows``, checkpointed, in as many partitions as the cores can use.

    Adaptive execution joins small shuffles to one partition, and a forest spends far more on a row
    than a scan does. Few rows stay together, however many cores there are.
    """
    own = rows.rdd.getNumPartitions()
    n = min(math.ceil(rows.count() / ROWS_PER_TASK), rows.sparkSession.sparkContext.defaultParallelism)
    return rows if n <= own else rows.repartition(n).checkpoint(eager=True)


def rf_experiments(df: DataFrame, label: str, feature_sets: dict, fold_col: str = "fold", split_col: str = "is_train",
                   num_trees: int = 200, max_depth: int = 8, min_leaf: int = 20, seed: int = 42,
                   n_folds: int = 5) -> list[tuple]:
    """M04 + M06: random forest per feature set, group k-fold CV on the
    training users (``foldCol``) and weighted F1 on the held-out users. Class
    weights are those of the training rows. The forests of all feature sets grow in the same
    passes over binned rows (``forest.py``), the folds side by side."""
    from ..session import ensure_checkpoint_dir
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    cols = list(dict.fromkeys(c for s in feature_sets.values() for c in s))
    # every step below re-reads these columns: materialise them once (reliable checkpoint)
    d = df.select(F.col(label).alias("__y"), F.col(fold_col).alias("__fold"), F.col(split_col).alias("__train"), *[F.col(c).cast("double").alias(c) for c in cols]).checkpoint(eager=True)
    idx = StringIndexer(inputCol="__y", outputCol="label", handleInvalid="keep").fit(d)
    d = idx.transform(d)
    fit_rows = _spread(balanced_weights(d.filter(F.col("__train")), "label").checkpoint(eager=True))
    held_out = _spread(d.filter(~F.col("__train")).checkpoint(eager=True))
    size = _fold_sizes(fit_rows, n_folds)
    weight = np.ones(len(idx.labels) + 1)
    for r in fit_rows.groupBy("label").agg(F.first("class_weight").alias("w")).collect():  # one row a class
        weight[int(r.label)] = r.w

    def scores(fold: int | None) -> dict[str, float]:
        """Weighted F1 of every set on the rows of a fold, or on the held-out users, grown on all other training rows."""
        train = fit_rows if fold is None else fit_rows.filter(F.col("__fold") != fold)
        cuts, forests = FO.fit(train, sum(size) - (0 if fold is None else size[fold]), feature_sets, weight, num_trees, max_depth, min_leaf, seed)
        found = FO.confusion(held_out if fold is None else fit_rows.filter(F.col("__fold") == fold), cuts, forests)
        return {s: FO.weighted_f1(m) for s, m in found.items()}
    with ThreadPool(n_folds + 1) as pool:
        # one wrapper a run: each carries the caller's properties to its own thread
        runs = [pool.apply_async(inheritable_thread_target(spark)(scores), (fold,)) for fold in [*range(n_folds), None]]
        *cv, test = [r.get() for r in runs]
    means = {s: sum(f[s] for f in cv) / n_folds for s in feature_sets}
    return [(s, means[s], test[s], means[s] - test[s]) for s in feature_sets]


def _fold_sizes(rows: DataFrame, n_folds: int) -> list[int]:
    """Training rows of every fold; a row outside the folds, and a fold without rows or with all of them, is an error."""
    fold = F.col("__fold")
    got = rows.agg(F.count(F.lit(1)).alias("n"), *[F.count(F.when(fold == i, 1)).alias(f"n{i}") for i in range(n_folds)]).first()
    size = [got[f"n{i}"] for i in range(n_folds)]
    if got.n != sum(size):
        raise ValueError(f"fold numbers must be in [0, {n_folds})")
    for i, n in enumerate(size):
        if n in (0, got.n):
            raise ValueError(f"fold {i} leaves no rows to train on or to validate")
    return size


def tree_rules(df: DataFrame, label: str, cols: list[str], split_col: str = "is_train", max_depth: int = 4, min_leaf: int = 30,
               seed: int = 42) -> tuple[DataFrame, float, float]:
    """Depth-4 decision tree (balanced weights of the training rows) and its
    leaves as rules: (predicted, n, confidence, conditions) with the real number
    of training rows in each leaf and the share of them that have the predicted
    class; and the accuracies on training and held-out rows."""
    idx = StringIndexer(inputCol=label, outputCol="label", stringOrderType="alphabetAsc").fit(df)
    d = VectorAssembler(inputCols=cols, outputCol="features", handleInvalid="keep").transform(idx.transform(df))
    train, test = d.filter(F.col(split_col)), d.filter(~F.col(split_col))
    model = DecisionTreeClassifier(maxDepth=max_depth, minInstancesPerNode=min_leaf, weightCol="class_weight",
                                   seed=seed).fit(balanced_weights(train, "label"))
    leaves = []

    def walk(node, conds):
        if node.getClass().getSimpleName() == "LeafNode":
            leaves.append((int(node.prediction()), conds))
            return
        split = node.split()
        f, thr = cols[split.featureIndex()], float(split.threshold())
        walk(node.leftChild(), conds + [(f, "<=", thr)])
        walk(node.rightChild(), conds + [(f, ">", thr)])
    walk(model._java_obj.rootNode(), [])

    def holds(conds):
        c = F.lit(True)
        for f, op, thr in conds:
            c = c & ((F.col(f) <= thr) if op == "<=" else (F.col(f) > thr))
        return c
    # one pass counts the rows of every leaf (at most 2 ** max_depth) by its conditions
    leaf = F.coalesce(*[F.when(holds(c), F.lit(i)) for i, (_, c) in enumerate(leaves)])
    pred = F.element_at(F.array(*[F.lit(float(p)) for p, _ in leaves]), leaf + 1)
    got = {r["leaf"]: r for r in train.select(leaf.alias("leaf"), (pred == F.col("label")).cast("double").alias("ok")).groupBy("leaf").agg(
        F.count(F.lit(1)).alias("n"), F.avg("ok").alias("ok")).collect()}
    rules = [(idx.labels[p], got[i]["n"] if i in got else 0, got[i]["ok"] if i in got else None, " AND ".join(f"{f} {op} {thr:.4f}" for f, op, thr in c) or "TRUE")
             for i, (p, c) in enumerate(leaves)]
    acc = [x.select(F.avg((pred == F.col("label")).cast("double"))).first()[0] for x in (train, test)]
    return df.sparkSession.createDataFrame(rules, "predicted string, n long, confidence double, conditions string"), acc[0], acc[1]


def save_and_load(df: DataFrame, path: str, features=K.FEATURES, k: int = 3, seed: int = 42) -> DataFrame:
    """Fit assembler + KMeans as a PipelineModel, write it, read it back
    and score with the loaded model."""
    pipe = Pipeline(stages=[VectorAssembler(inputCols=_zcols(features), outputCol="features"),
                            KMeans(k=k, seed=seed, maxIter=50)])
    model = pipe.fit(df)
    model.write().overwrite().save(path)
    return PipelineModel.load(path).transform(df)


def player_groups(games: DataFrame, band: DataFrame, min_rows: int | None = None, k: int = 3, seed: int = 42) -> DataFrame:
    """Group of every point of ``band`` (rating, accuracy of the +-200 band's
    mean acl, band's mean theory) by the nearest centroid of a KMeans fitted on
    the standardised (rating, accuracy, theory) of the games; clusters are named
    by rising mean rating. With ``min_rows`` given and fewer games, the P14 rule
    group is used instead (the reference's own switch, at 30 rows)."""
    from ..functions import scalar as S
    pts = band.select(F.col("target").cast("double").alias("rating"), S.accuracy("acl_mean", 1).alias("acc"), F.col("theory_mean").alias("theory"))
    if min_rows is not None and games.limit(min_rows).count() < min_rows:
        return pts.withColumn("group", S.rule_group("rating"))
    cols = ["rating", "acc", "theory"]
    g = games.select(F.col("rating").cast("double").alias("rating"), S.accuracy("acl", 1).alias("acc"), F.col("theory_depth").cast("double").alias("theory")).dropna()
    st = g.agg(*[F.avg(c).alias(f"m_{c}") for c in cols], *[F.stddev_pop(c).alias(f"s_{c}") for c in cols]).first()

    def scaled(df):
        return df.withColumns({f"z_{c}": (F.col(c) - st[f"m_{c}"]) / (st[f"s_{c}"] or 1.0) for c in cols})
    vec = VectorAssembler(inputCols=[f"z_{c}" for c in cols], outputCol="features", handleInvalid="skip")
    model = KMeans(k=k, seed=seed).fit(vec.transform(scaled(g)))
    order = sorted(range(len(model.clusterCenters())), key=lambda i: model.clusterCenters()[i][0])
    names = dict(zip(order, ("principiante", "intermedio", "avanzado")))
    group = F.element_at(F.array(*[F.lit(names.get(i)) for i in range(len(order))]), F.col("prediction") + 1)
    return model.transform(vec.transform(scaled(pts))).select(*cols, group.alias("group"))
