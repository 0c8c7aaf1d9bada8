"""K-means with many starts and several k at once.

Equal vectors are one weighted point. All starts draw their k-means++ centres in
the same passes: in a pass every point gets an exponential arrival time with rate
weight x squared distance to the start's nearest centre, and the first to arrive
is the next centre, so it is drawn in proportion to that rate. Times are hashes of
(seed, start, step, vector) and do not depend on partitions. The starts of all k
then move together: one pass gives the sums of every centre of every model that
has not settled, one row per partition and centre. A model has settled when its
centres move by less than ``tol`` of the mean variance.

Defined cases: null features are 0 before scaling; a centre that loses all its
points stays where it is; with fewer distinct vectors than k a model has as many
centres as there are vectors; no points give no models.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


@dataclass
class Model:
    """Centres of one k, its cost, and for each centre the points it holds and their mean distance."""

    k: int
    start: int
    centres: np.ndarray
    cost: float
    n: np.ndarray
    spread: np.ndarray

    def davies_bouldin(self) -> float | None:
        """Mean over the centres of the largest (spread + spread) / distance."""
        on = np.flatnonzero(self.n > 0)
        if len(on) < 2:
            return None
        c, s = self.centres[on], self.spread[on]
        apart = np.sqrt(((c[:, None] - c[None]) ** 2).sum(2))
        np.fill_diagonal(apart, np.inf)
        return float(((s[:, None] + s[None]) / apart).max(1).mean())


def points(scaled: DataFrame, features: list[str]) -> DataFrame:
    """Distinct vectors of the scaled columns: (key, z_..., w), kept by a reliable checkpoint."""
    ensure_checkpoint_dir(scaled.sparkSession)
    z = [f"z_{c}" for c in features]
    p = scaled.groupBy(*[F.col(c).cast("double").alias(c) for c in z]).agg(F.count(F.lit(1)).cast("double").alias("w"))
    return p.select(F.xxhash64(*z).alias("key"), *z, "w").checkpoint(eager=True)


def seeds(pts: DataFrame, starts: int, k: int, seed: int) -> np.ndarray:
    """k-means++ centres of all starts: (starts, found, features), with found <= k."""
    dims = len(pts.columns) - 2
    chosen = np.zeros((starts, 0, dims))
    for step in range(k):

        def race(batches, chosen=chosen, step=step):
            best, where = np.full(starts, np.inf), np.zeros((starts, dims))
            for b in batches:
                if not b.num_rows:
                    continue
                key = b.column(0).to_numpy().astype(np.uint64)
                x = np.column_stack([b.column(1 + j).to_numpy() for j in range(dims)])
                w = b.column(1 + dims).to_numpy()
                for run in range(starts):
                    h = key + np.uint64((seed * 1_000_003 + run * 8191 + step + 1) * 0x9E3779B97F4A7C15 % 2 ** 64)
                    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
                        h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
                    u = ((h ^ (h >> np.uint64(31))) >> np.uint64(11)).astype(np.float64) * 2.0 ** -53 + 2.0 ** -54
                    rate = w.copy()
                    if step:
                        rate *= np.min([((x - c) ** 2).sum(1) for c in chosen[run]], 0)
                    time = np.where(rate > 0, -np.log(u) / np.where(rate > 0, rate, 1), np.inf)
                    i = int(time.argmin())
                    if time[i] < best[run]:
                        best[run], where[run] = time[i], x[i]
            on = np.flatnonzero(np.isfinite(best))
            yield pa.RecordBatch.from_arrays([pa.array(on, pa.int32()), pa.array(best[on]), pa.array(list(where[on]), pa.list_(pa.float64()))], names=["run", "time", "at"])

        found = pts.mapInArrow(race, "run int, time double, at array<double>").groupBy("run").agg(F.min(F.struct("time", "at")).alias("b")).collect()  # one row a start
        if len(found) < starts:
            break
        chosen = np.concatenate([chosen, np.array([r.b["at"] for r in sorted(found, key=lambda r: r.run)])[:, None]], 1)
    return chosen


def _sums(pts: DataFrame, models: list[np.ndarray]) -> np.ndarray:
    """For every centre of the models, stacked: weight, squared distances, distances and vector sum of the points nearest to it."""
    dims = len(pts.columns) - 2
    stacked = np.concatenate(models)
    ends = np.cumsum([len(m) for m in models])
    begins = ends - [len(m) for m in models]

    def run(batches):
        total = np.zeros((len(stacked), 3 + dims))
        size = (stacked ** 2).sum(1)
        for b in batches:
            all_x = np.column_stack([b.column(1 + j).to_numpy() for j in range(dims)])
            all_w = b.column(1 + dims).to_numpy()
            for i in range(0, len(all_x), 2048):
                x, w = all_x[i:i + 2048], all_w[i:i + 2048]
                far = size - 2 * (x @ stacked.T)
                at = np.stack([far[:, a:z].argmin(1) + a for a, z in zip(begins, ends)], 1)
                d2 = ((x[:, None] - stacked[at]) ** 2).sum(2)
                weight = np.repeat(w, len(begins))
                flat = at.ravel()
                parts = [weight, weight * d2.ravel(), weight * np.sqrt(d2).ravel()] + [np.repeat(w * x[:, j], len(begins)) for j in range(dims)]
                total += np.stack([np.bincount(flat, p, len(stacked)) for p in parts], 1)
        on = np.flatnonzero(total[:, 0])
        yield pa.RecordBatch.from_arrays([pa.array(on, pa.int32())] + [pa.array(total[on, j]) for j in range(3 + dims)], names=["centre"] + [f"s{j}" for j in range(3 + dims)])

    names = [f"s{j}" for j in range(3 + dims)]
    rows = pts.mapInArrow(run, "centre int, " + ", ".join(f"{c} double" for c in names)).groupBy("centre").agg(*[F.sum(c).alias(c) for c in names])
    out = np.zeros((len(stacked), 3 + dims))
    for r in rows.collect():  # one row a centre of a model, however many points
        out[r.centre] = [r[c] for c in names]
    return out


def fit(pts: DataFrame, ks, starts: int = 20, seed: int = 42, max_iter: int = 300, tol: float = 1e-4) -> dict[int, Model]:
    """The start of least cost for every k."""
    ks = list(ks)
    first = seeds(pts, starts, max(ks), seed)
    if not first.shape[1]:
        return {}
    z = pts.columns[1:-1]
    moments = pts.agg(F.sum("w").alias("n"), *[F.sum(F.col("w") * F.col(c)).alias(f"a{i}") for i, c in enumerate(z)], *[F.sum(F.col("w") * F.col(c) ** 2).alias(f"b{i}") for i, c in enumerate(z)]).first()
    variance = np.mean([moments[f"b{i}"] / moments["n"] - (moments[f"a{i}"] / moments["n"]) ** 2 for i in range(len(z))])
    owner = [(k, run) for k in ks for run in range(starts)]
    centres = [first[run, :k].copy() for k, run in owner]
    live = list(range(len(owner)))
    for _ in range(max_iter):
        if not live:
            break
        found, at, moving = _sums(pts, [centres[i] for i in live]), 0, []
        for i in live:
            part = found[at:at + len(centres[i])]
            at += len(part)
            new = np.where(part[:, :1] > 0, part[:, 3:] / np.maximum(part[:, :1], 1e-300), centres[i])
            if ((new - centres[i]) ** 2).sum() > tol * variance:
                moving.append(i)
            centres[i] = new
        live = moving
    found, at, best = _sums(pts, centres), 0, {}
    for (k, run), c in zip(owner, centres):
        n, d2, d, _ = np.split(found[at:at + len(c)], [1, 2, 3], 1)
        at += len(c)
        model = Model(k, run, c, float(d2.sum()), n[:, 0], (d / np.maximum(n, 1))[:, 0])
        if k not in best or model.cost < best[k].cost:
            best[k] = model
    return best


def silhouettes(pts: DataFrame, models: dict[int, Model], sample: int = 5000, seed: int = 42) -> dict[int, float | None]:
    """Mean Euclidean silhouette of every model over a sample of rows, as far as the reference takes it:
    the ``sample`` rows first in hash order, or all rows if there are no more."""
    dims = len(pts.columns) - 2
    rows = pts.withColumn("copy", F.explode(F.sequence(F.lit(1), F.least("w", F.lit(sample)).cast("int"))))
    rows = rows.withColumn("order", F.xxhash64("key", "copy", F.lit(seed))).orderBy("order", "key", "copy").limit(sample)
    local = rows.select(*pts.columns[1:-1]).toArrow()  # at most ``sample`` rows
    x = np.column_stack([local.column(j).to_numpy() for j in range(dims)])
    labels = {k: ((x[:, None] - m.centres[None]) ** 2).sum(2).argmin(1) for k, m in models.items()}
    held = pts.sparkSession.sparkContext.broadcast((x, labels))  # bounded by the sample

    def run(batches):
        x, labels = held.value
        for b in batches:
            begin = b.column(0).to_numpy()
            for i in begin:
                part = x[i:i + 128]
                d = np.sqrt(((part[:, None] - x[None]) ** 2).sum(2))
                for k, label in labels.items():
                    size = np.bincount(label)
                    on = np.flatnonzero(size)
                    if len(on) < 2:
                        continue
                    near = np.stack([d[:, label == c].sum(1) for c in on], 1)
                    own = label[i:i + 128][:, None] == on
                    inside = (near * own).sum(1) / np.maximum(size[label[i:i + 128]] - 1, 1)
                    other = np.where(own, np.inf, near / size[on]).min(1)
                    worth = np.where(size[label[i:i + 128]] > 1, (other - inside) / np.maximum(np.maximum(other, inside), 1e-300), 0.0)
                    yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([float(worth.sum())])], names=["k", "s"])

    spark = pts.sparkSession
    parts = spark.range(0, len(x), 128, min(64, max(1, -(-len(x) // 128)))).mapInArrow(run, "k int, s double")
    total = {r.k: r.s for r in parts.groupBy("k").agg(F.sum("s").alias("s")).collect()}
    return {k: total[k] / len(x) if k in total else None for k in models}
