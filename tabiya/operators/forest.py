"""Random forests of several feature sets grown side by side, level by level.

The forests are MLlib's: a feature has at most ``BINS - 1`` thresholds, weighted quantiles of at most
``SAMPLE`` rows; a tree's bootstrap takes a row Poisson(1) times; a node looks at the root of the number of
features, drawn anew, and takes the split of the largest Gini gain under the class weights that leaves
``min_leaf`` drawn rows on either side; leaves of the same class under one node are one; a row's class is the one
of the largest sum of the leaves' shares.

Rows are binned once and kept as blocks of bytes, equal ones as one row with a count n, which a bootstrap
takes Poisson(n) times. A level of all trees of all sets is one pass over the blocks: a task sends one
histogram a tree, the histograms are added up by tree, and the best split of each node reaches the driver.
Draws are functions of (seed, set, tree, block), so that they are the same in every pass and none is kept.

Defined cases: a missing number lies above all thresholds; no rows are an error.
"""

from __future__ import annotations

import math
import sys
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

# workers need this module's functions and may not have the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Bins of a feature.
BINS = 32
#: Rows that thresholds are taken from.
SAMPLE = 10_000
#: Rows of a block, and rows that are looked at together.
BLOCK, CHUNK = 1 << 18, 1 << 15

_CDF = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(20)])
#: Poisson(1) by 16 random bits; 255 where more bits decide.
_DRAWN = np.searchsorted(_CDF, np.arange(1 << 16) / (1 << 16), "right").astype(np.uint8)
_DRAWN[np.searchsorted(_CDF, np.arange(1, (1 << 16) + 1) / (1 << 16), "left") != _DRAWN] = 255


@dataclass
class Forest:
    """Trees over columns: split feature and last bin to the left of every node in heap order, and the classes' shares at
    the places of the lowest level (a leaf above it sends its rows left)."""

    cols: list[str]
    feature: np.ndarray
    cut: np.ndarray
    votes: np.ndarray


def thresholds(values: np.ndarray, weight: np.ndarray, most: int) -> np.ndarray:
    """At most about ``most`` thresholds between the distinct values, at equal steps of the weight."""
    distinct, back = np.unique(values[~np.isnan(values)], return_inverse=True)
    if len(distinct) <= most + 1:
        return (distinct[:-1] + distinct[1:]) / 2
    mass = np.bincount(back, weight[~np.isnan(values)], len(distinct))
    upto, step, found = np.cumsum(mass), mass.sum() / (most + 1), []
    target = step
    for i in range(1, len(distinct)):
        if abs(upto[i - 1] - target) < abs(upto[i] - target):
            found.append((distinct[i - 1] + distinct[i]) / 2)
            target += step
    return np.array(found[:most])


def _distinct(columns: list[np.ndarray], sizes: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """A place of every distinct row, and how often the row stands there."""
    key, span = np.zeros(len(columns[0]), np.int64), 1
    for c, size in zip(columns, sizes):
        if span * size >= 1 << 62:
            u, key = np.unique(key, return_inverse=True)
            span = len(u)
        key, span = key * size + c, span * size
    _, first, n = np.unique(key, return_index=True, return_counts=True)
    return first, n


def _cut_blocks(batches, cuts: dict[str, np.ndarray], sets: dict[str, list[str]], classes: int):
    """(number of the set, binned distinct rows, their labels, their counts) of runs of rows; single rows come first."""
    cols, held, n = list(cuts), [], 0

    def out():
        x, y = np.concatenate([h[0] for h in held], 1), np.concatenate([h[1] for h in held])
        for s, names in enumerate(sets.values()):
            mine = x[[cols.index(c) for c in names]]
            first, count = _distinct([*mine, y], [BINS] * len(names) + [classes])
            order = np.argsort(count, kind="stable")
            yield s, np.ascontiguousarray(mine[:, first[order]].T), y[first[order]], count[order]

    for b in batches:
        x = [np.searchsorted(cuts[c], b.column(c).to_numpy(zero_copy_only=False)) for c in cols]
        held.append((np.array(x, np.uint8).reshape(len(cols), -1), b.column("label").to_numpy(zero_copy_only=False).astype(np.int64)))
        n += b.num_rows
        if n >= BLOCK:
            yield from out()
            held, n = [], 0
    if n:
        yield from out()


def _bootstrap(seed: list[int], count: np.ndarray, singles: int) -> np.ndarray:
    """How often each row is drawn: Poisson of its count."""
    rng = np.random.Generator(np.random.SFC64(seed))
    bits = rng.integers(0, 1 << 16, singles, np.uint16)
    one = _DRAWN[bits]
    open_ = np.flatnonzero(one == 255)
    one[open_] = np.searchsorted(_CDF, (bits[open_] + rng.random(len(open_))) / (1 << 16), "right")
    if singles == len(count):
        return one
    return np.concatenate((one, rng.poisson(count[singles:])))


def _descend(bins: np.ndarray, at: np.ndarray, feature: np.ndarray, cut: np.ndarray, levels: int) -> np.ndarray:
    """Places at the level below ``levels`` levels of one tree of the rows that begin at ``at``."""
    j = np.zeros(len(at), np.int64)
    for d in range(levels):
        level = slice((1 << d) - 1, (1 << d + 1) - 1)
        right = bins.take(feature[level].take(j) + at) > cut[level].take(j)
        j += j
        j += right
    return j


def _histograms(sent, level: int, classes: int, seed: int, bootstrap: bool):
    def run(batches):
        state, total = sent.value, {}
        for b in batches:
            for s, block, bins, label, count in zip(*(b.column(c).to_pylist() for c in ("s", "block", "bins", "label", "count"))):
                feature, cut, slots, looked = state[s]
                bins, label, count = np.frombuffer(bins, np.uint8), np.frombuffer(label, "<u2").astype(np.int64), np.frombuffer(count, "<u4")
                width, singles = len(bins) // len(label), int(np.searchsorted(count, 1, "right"))
                for tree, subset in enumerate(looked):
                    if not len(subset):
                        continue
                    held = total.get((s, tree))
                    if held is None:
                        held = total[s, tree] = np.zeros((subset.shape[1], len(subset) * BINS * classes))
                    drawn = _bootstrap([seed, s, tree, block], count, singles) if bootstrap else count
                    live = np.flatnonzero(drawn)
                    for i in range(0, len(live), CHUNK):
                        rows = live[i:i + CHUNK]
                        at = rows * width
                        node = slots[tree].take(_descend(bins, at, feature[tree], cut[tree], level))
                        inside = np.flatnonzero(node >= 0)
                        if len(inside) < len(rows):
                            rows, at, node = rows[inside], at[inside], node[inside]
                        times, cell = drawn.take(rows).astype(np.float64), node * (BINS * classes) + label.take(rows)
                        for k in range(subset.shape[1]):
                            here = bins.take(subset[:, k].take(node) + at).astype(np.int64)
                            here *= classes
                            here += cell
                            held[k] += np.bincount(here, times, held.shape[1])
        for (s, tree), held in total.items():
            yield pa.RecordBatch.from_arrays([pa.array([s], pa.int32()), pa.array([tree], pa.int32()), pa.array([held.astype("<i8").tobytes()], pa.binary())], names=["s", "tree", "held"])

    return run


def _gini(counts: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore", invalid="ignore"):
        return 1 - ((counts / counts.sum(-1, keepdims=True)) ** 2).sum(-1)


def best_splits(held: np.ndarray, subset: np.ndarray, n_cuts: np.ndarray, weight: np.ndarray, min_leaf: int):
    """Feature (-1: none), cut, and the rows to the left and in all by class of every node; ``held`` counts drawn rows by
    (feature of the node's subset, node, bin, class)."""
    left = held.cumsum(2)[:, :, :-1]
    total = held[0].sum(1)
    right = total[None, :, None] - left
    lw, rw, tw = left * weight, right * weight, total * weight
    whole = tw.sum(-1)[None, :, None]
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = _gini(tw)[None, :, None] - lw.sum(-1) / whole * _gini(lw) - rw.sum(-1) / whole * _gini(rw)
    few = (left.sum(-1) < max(min_leaf, 1)) | (right.sum(-1) < max(min_leaf, 1))
    none = np.arange(BINS - 1) >= n_cuts[subset.T][:, :, None]
    gain = np.where(few | none | np.isnan(gain), -np.inf, gain)
    cut = gain.argmax(2)
    gain = np.take_along_axis(gain, cut[:, :, None], 2)[:, :, 0]
    k, node = gain.argmax(0), np.arange(len(subset))
    return np.where(gain[k, node] > 0, subset[node, k], -1), cut[k, node], left[k, node, cut[k, node]], total


def _splits(sent, n_cuts: list[np.ndarray], weight: np.ndarray, min_leaf: int):
    def run(batches):
        looked, total = [s[3] for s in sent.value], {}
        for b in batches:
            for s, tree, held in zip(*(b.column(c).to_pylist() for c in ("s", "tree", "held"))):
                held = np.frombuffer(held, "<i8")
                total[s, tree] = total[s, tree] + held if (s, tree) in total else held
        for (s, tree), held in total.items():
            subset = looked[s][tree]
            found = best_splits(held.reshape(subset.shape[1], len(subset), BINS, -1), subset, n_cuts[s], weight, min_leaf)
            yield pa.RecordBatch.from_arrays([pa.array([s], pa.int32()), pa.array([tree], pa.int32())] + [pa.array([a.ravel()], pa.list_(pa.int64())) for a in found], names=["s", "tree", "feature", "cut", "left", "total"])

    return run


def blocks(rows: DataFrame, cuts: dict[str, np.ndarray], sets: dict[str, list[str]], classes: int) -> DataFrame:
    """The binned rows of every set, kept by a reliable checkpoint."""
    def run(batches):
        part = TaskContext.get().partitionId()
        for number, (s, bins, label, count) in enumerate(_cut_blocks(batches, cuts, sets, classes)):
            packed = (bins.tobytes(), label.astype("<u2").tobytes(), count.astype("<u4").tobytes())
            yield pa.RecordBatch.from_arrays([pa.array([s], pa.int32()), pa.array([part << 32 | number], pa.int64())] + [pa.array([p], pa.binary()) for p in packed], names=["s", "block", "bins", "label", "count"])

    ensure_checkpoint_dir(rows.sparkSession)
    return rows.select("label", *cuts).mapInArrow(run, "s int, block bigint, bins binary, label binary, count binary").checkpoint(eager=True)


def _looked_at(rng: np.random.Generator, nodes: int, width: int, size: int) -> np.ndarray:
    """Features that each node looks at, in the order of a reservoir, as MLlib's: of equal gains the first one counts."""
    out = np.tile(np.arange(size), (nodes, 1))
    for i in range(size, width):
        at = (rng.random(nodes) * (i + 1)).astype(np.int64)
        on = np.flatnonzero(at < size)
        out[on, at[on]] = i
    return out


def fit(rows: DataFrame, n: int, sets: dict[str, list[str]], weight: np.ndarray, num_trees: int, max_depth: int, min_leaf: int, seed: int,
        bootstrap: bool = True, all_features: bool = False) -> tuple[dict[str, np.ndarray], dict[str, Forest]]:
    """The thresholds of all columns and a forest of every set, grown on the ``n`` rows (label, class_weight, columns);
    ``weight`` has the weight of every class."""
    if not n:
        raise ValueError("no rows to grow a forest on")
    sc, classes, names = rows.sparkSession.sparkContext, len(weight), list(sets)
    cols = list(dict.fromkeys(c for s in sets.values() for c in s))
    # as in MLlib, thresholds come from a bounded sample, everything else from all rows
    sample = (rows if n <= SAMPLE else rows.sample(False, SAMPLE / n, seed)).select("class_weight", *cols).toArrow()
    own = sample.column("class_weight").to_numpy()
    cuts = {c: thresholds(sample.column(c).to_numpy(), own, min(BINS, n) - 1) for c in cols}
    kept = blocks(rows, cuts, sets, classes)
    n_cuts = [np.array([len(cuts[c]) for c in sets[s]]) for s in names]
    # a node that is not split sends all rows left
    feature = {s: np.zeros((num_trees, (1 << max_depth) - 1), np.int64) for s in names}
    cut = {s: np.full((num_trees, (1 << max_depth) - 1), 255, np.uint8) for s in names}
    counts = {s: np.zeros((num_trees, (2 << max_depth) - 1, classes), np.int64) for s in names}
    active = {s: [np.zeros(1, np.int64)] * num_trees for s in names}
    for level in range(max_depth):
        if not any(len(a) for trees in active.values() for a in trees):
            break
        state, first = [], (1 << level) - 1
        for i, s in enumerate(names):
            width = len(sets[s])
            size = width if all_features or num_trees == 1 else math.ceil(math.sqrt(width))
            rng = np.random.default_rng([seed, i, level])
            slots = np.full((num_trees, 1 << level), -1)
            for t, a in enumerate(active[s]):
                slots[t, a] = np.arange(len(a))
            state.append((feature[s], cut[s], slots, [_looked_at(rng, len(a), width, size) for a in active[s]]))
        sent = sc.broadcast(state)
        sums = kept.mapInArrow(_histograms(sent, level, classes, seed, bootstrap), "s int, tree int, held binary")
        # adaptive execution joins partitions that hold little
        found = (sums.repartition("s", "tree")
                 .mapInArrow(_splits(sent, n_cuts, weight, min_leaf), "s int, tree int, feature array<bigint>, cut array<bigint>, left array<bigint>, total array<bigint>").collect())
        # one row a tree
        for r in found:
            s, t = names[r.s], r.tree
            nodes, f, left, total = active[s][t], np.array(r.feature), np.reshape(r.left, (-1, classes)), np.reshape(r.total, (-1, classes))
            counts[s][t, first + nodes] = total
            on = np.flatnonzero(f >= 0)
            feature[s][t, first + nodes[on]], cut[s][t, first + nodes[on]] = f[on], np.array(r.cut)[on]
            below = np.stack((2 * nodes[on], 2 * nodes[on] + 1), 1).ravel()
            part = np.stack((left[on], total[on] - left[on]), 1).reshape(-1, classes)
            counts[s][t, 2 * first + 1 + below] = part
            active[s][t] = below[_gini(part * weight) > sys.float_info.epsilon]
        sent.unpersist()
    forests = {}
    for s in names:
        _prune(cut[s], (counts[s] * weight).argmax(-1))
        for node in range((1 << max_depth) - 1):
            whole = cut[s][:, node] == 255
            counts[s][whole, 2 * node + 1] = counts[s][whole, node]
        leaf = counts[s][:, (1 << max_depth) - 1:] * weight
        forests[s] = Forest(sets[s], feature[s], cut[s], leaf / np.maximum(leaf.sum(-1, keepdims=True), 1e-300))
    return cuts, forests


def _prune(cut: np.ndarray, said: np.ndarray) -> None:
    """Make two leaves below a node that predict the same class one leaf, from the lowest level up."""
    leaf = np.ones(said.shape, bool)
    for node in range(cut.shape[1] - 1, -1, -1):
        left, right = 2 * node + 1, 2 * node + 2
        cut[leaf[:, left] & leaf[:, right] & (said[:, left] == said[:, right]), node] = 255
        leaf[:, node] = cut[:, node] == 255


def confusion(rows: DataFrame, cuts: dict[str, np.ndarray], forests: dict[str, Forest]) -> dict[str, np.ndarray]:
    """Rows by (label, predicted class) for the forest of every set."""
    classes = next(iter(forests.values())).votes.shape[2]
    sent = rows.sparkSession.sparkContext.broadcast([(f.feature, f.cut, f.votes) for f in forests.values()])
    sets = {s: f.cols for s, f in forests.items()}

    def run(batches):
        total = np.zeros((len(sets), classes * classes))
        for s, bins, label, count in _cut_blocks(batches, cuts, sets, classes):
            flat = bins.ravel()
            for i in range(0, len(label), CHUNK):
                at = np.arange(i, min(i + CHUNK, len(label))) * bins.shape[1]
                votes = np.zeros((len(at), classes))
                for feature, cut, share in zip(*sent.value[s]):
                    votes += share.take(_descend(flat, at, feature, cut, int(math.log2(len(share)))), 0)
                total[s] += np.bincount(label[i:i + CHUNK] * classes + votes.argmax(1), count[i:i + CHUNK], classes * classes)
        s, cell = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(s, pa.int32()), pa.array(cell, pa.int32()), pa.array(total[s, cell].astype(np.int64))], names=["s", "cell", "n"])

    out = {s: np.zeros(classes * classes, np.int64) for s in sets}
    for r in rows.select("label", *cuts).mapInArrow(run, "s int, cell int, n bigint").groupBy("s", "cell").agg(F.sum("n").alias("n")).collect():
        out[list(sets)[r.s]][r.cell] = r.n
    sent.unpersist()
    return {s: m.reshape(classes, classes) for s, m in out.items()}


def weighted_f1(counts: np.ndarray) -> float:
    """F1 of every label, weighted by its rows."""
    hit, truth, said = np.diag(counts), counts.sum(1), counts.sum(0)
    return float((truth * 2 * hit / np.maximum(truth + said, 1)).sum() / truth.sum()) if truth.sum() else float("nan")
