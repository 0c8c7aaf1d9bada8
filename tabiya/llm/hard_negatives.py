"""Hard negatives by exact integer scores in a residue number system.

Components are whole numbers, and a score is an inner product of whole
numbers. For each of a few primes below 1024 a task multiplies the residues of
a block of rows and of all anchors of a chunk in float32: with residues between
-p/2 and p/2, 64 products add up to less than 2**24, where float32 is exact;
longer vectors are multiplied in stretches of 64 and reduced in between. The
balanced residues are put together by Chinese remaindering (mixed radix with
balanced digits) into the signed score. The number of primes follows from the
largest squared length in the table, which bounds every score.

The anchors are a stated query set. They go out in chunks of at most
``CHUNK_BYTES``, each broadcast, so neither the driver nor a task holds more than
one chunk. For a chunk, one pass over all rows keeps each task's best rows of
the same label, a window per anchor takes the first ``positives``; a second
pass keeps, per anchor and positive, each task's best rows of another label
with a score between ``low`` percent and 100 percent of the positive's, and a
window takes the first ``negatives``. A task's lists are all that is
shuffled; no pair of an anchor and a row ever becomes a row of a table.

Defined cases: rows with a null label, a null vector, or a null, NaN or infinite
component take no part; a null id is never an anchor and stands behind all other
ids; vectors of unequal length are filled up with zeros, an empty one is all
zeros; repeated rows are rows of their own, so copies of an anchor are among its
other rows, and each copy of an anchor gets the anchor's rows (it is scored
once); ties go to the smaller id; an anchor without positives, or whose
positives have scores below zero, has no rows; an empty table gives an empty
table; other columns are not read. Scores beyond 64 bits are an error.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ship, stored
from .vectors import dimension, integers, usable

#: Bytes of the anchors (their integers, residues and lists) that are broadcast together.
CHUNK_BYTES = 64 << 20
#: Rows of a block times the anchors it is multiplied with at once.
CELLS = 1 << 20
#: Products that float32 adds exactly.
STRETCH = 64
#: Primes below 1024, the largest first: 64 * (1021 // 2) ** 2 < 2 ** 24.
PRIMES = [p for p in range(1023, 2, -2) if all(p % q for q in range(3, 32, 2))]
_LAST = np.iinfo(np.int64).max


def primes_for(bound: int) -> list[int]:
    """As many primes as tell all numbers from -bound to bound apart."""
    out, product = [], 1
    for p in PRIMES:
        out.append(p)
        product *= p
        if product > 2 * bound + 1:
            return out
    raise ValueError("vectors too long for the residue number system")


def residues(x: np.ndarray, primes: list[int]) -> list[np.ndarray]:
    """Balanced residues of whole numbers, a float32 matrix for each prime."""
    return [(np.mod(x + p // 2, p) - p // 2).astype(np.float32) for p in primes]


def products(a: list[np.ndarray], b: list[np.ndarray], primes: list[int]) -> np.ndarray:
    """Exact inner products of the rows behind the residues ``a`` and those behind ``b``."""
    digits: list[np.ndarray] = []
    for k, p in enumerate(primes):
        r = np.zeros((len(a[k]), len(b[k])), np.int64)
        for i in range(0, a[k].shape[1], STRETCH):
            r += (a[k][:, i:i + STRETCH] @ b[k][:, i:i + STRETCH].T).astype(np.int64)
        # what is left of the number after the digits before, divided by their primes
        for d, q in zip(digits, primes):
            r = (r - d) * pow(q, -1, p) % p
        digits.append((r + p // 2) % p - p // 2)
    out = digits[-1]
    for d, p in zip(digits[-2::-1], primes[len(primes) - 2::-1]):
        out = out * p + d
    return out


class Best:
    """The ``n`` highest scores (ties: smaller id first) of each list, with the rows' ids."""

    def __init__(self, lists: int, n: int):
        self.n = n
        self.score, self.id = np.zeros((lists, n), np.int64), np.zeros((lists, n), np.int64)
        self.have = np.zeros(lists, np.int64)

    def may_enter(self, scores: np.ndarray, ids: np.ndarray, lists: np.ndarray) -> np.ndarray:
        """Which cells (list, row) come before the list's last one."""
        full = self.have[lists] == self.n
        s, i = self.score[lists, -1][:, None], self.id[lists, -1][:, None]
        return ~full[:, None] | (scores > s) | ((scores == s) & (ids < i))

    def add(self, lists: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """Merge candidates into their lists."""
        if not len(lists):
            return
        touched = np.unique(lists)
        old = np.arange(self.n) < self.have[touched][:, None]
        lists = np.concatenate((lists, np.repeat(touched, self.have[touched])))
        scores, ids = np.concatenate((scores, self.score[touched][old])), np.concatenate((ids, self.id[touched][old]))
        order = np.lexsort((ids, ~scores, lists))
        lists, scores, ids = lists[order], scores[order], ids[order]
        begin = np.searchsorted(lists, touched)
        rank = np.arange(len(lists)) - np.repeat(begin, np.diff(np.append(begin, len(lists))))
        keep = rank < self.n
        self.score[lists[keep], rank[keep]], self.id[lists[keep], rank[keep]] = scores[keep], ids[keep]
        self.have[touched] = np.minimum(np.diff(np.append(begin, len(lists))), self.n)

    def table(self) -> pa.RecordBatch:
        """(list, id, score) of what is held; a null id is the largest number."""
        at, rank = np.nonzero(np.arange(self.n) < self.have[:, None])
        ids = self.id[at, rank]
        return pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(ids, mask=ids == _LAST), pa.array(self.score[at, rank])], names=["list", "id", "score"])


def _blocks(batches, width: int, primes: list[int], rows: int):
    """(ids, labels, residues) of blocks of rows in ascending order of ids."""
    for batch in batches:
        ids = np.array(batch.column("id").fill_null(_LAST).to_numpy(zero_copy_only=False), np.int64)
        labels = batch.column("label").to_numpy(zero_copy_only=False).astype(np.int64)
        x = integers(batch.column("vector"), width)
        order = np.argsort(ids, kind="stable")
        for i in range(0, len(order), rows):
            at = order[i:i + rows]
            yield ids[at], labels[at], residues(x[at], primes)


def _alike(sent, width: int, primes: list[int], keep: int):
    """Each task's best rows of every anchor's label, the anchor's own among them."""

    def run(batches):
        label, x = sent.value["label"], sent.value["x"]
        # anchors of one label stand together
        groups = {v: np.flatnonzero(label == v) for v in np.unique(label).tolist()}
        own = {v: residues(x[at], primes) for v, at in groups.items()}
        best = Best(len(label), keep)
        for ids, labels, r in _blocks(batches, width, primes, 4096):
            for v in np.unique(labels).tolist():
                if v not in groups:
                    continue
                mine = np.flatnonzero(labels == v)
                step = max(1, CELLS // len(mine))
                for i in range(0, len(groups[v]), step):
                    lists = groups[v][i:i + step]
                    s = products([o[i:i + step] for o in own[v]], [m[mine] for m in r], primes)
                    a, b = np.nonzero(best.may_enter(s, ids[mine], lists))
                    best.add(lists[a], s[a, b], ids[mine][b])
        yield best.table()

    return run


def _unlike(sent, width: int, primes: list[int], keep: int, low: int):
    """Each task's best rows of another label within the score window of every (anchor, positive)."""

    def run(batches):
        label, x, floor, top, owner = (sent.value[c] for c in ("label", "x", "floor", "top", "owner"))
        own = residues(x, primes)
        best = Best(len(owner), keep)
        first = np.searchsorted(owner, np.arange(len(label) + 1))
        widest = int(np.diff(first).max(initial=0))
        for ids, labels, r in _blocks(batches, width, primes, 4096):
            step = max(1, CELLS // len(ids))
            for i in range(0, len(label), step):
                s = products([o[i:i + step] for o in own], r, primes)
                other = label[i:i + step, None] != labels
                for k in range(widest):  # the k-th positive of each anchor
                    a = np.flatnonzero(np.diff(first)[i:i + step] > k)
                    lists = first[i:i + step][a] + k
                    inside = other[a] & (s[a] >= floor[lists][:, None]) & (s[a] <= top[lists][:, None])
                    inside &= best.may_enter(s[a], ids, lists)
                    p, b = np.nonzero(inside)
                    best.add(lists[p], s[a[p], b], ids[b])
        yield best.table()

    return run


def _first(lists: DataFrame, n: int) -> DataFrame:
    """The ``n`` first rows of each list, with their rank."""
    by = Window.partitionBy("list").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return lists.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= n)


def mine(vectors: DataFrame, anchor: Column, label: Column, positives: int = 5, negatives: int = 5, low: int = 80,
         id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of the rows where ``anchor`` holds."""
    spark = ship(vectors.sparkSession)
    rows = vectors.select(F.col(id_col).cast("bigint").alias("id"), label.cast("bigint").alias("label"), F.col(vector_col).cast("array<double>").alias("vector"), F.coalesce(anchor, F.lit(False)).alias("anchor"))
    rows = rows.filter(F.col("label").isNotNull() & usable(F.col("vector")))
    width = dimension(rows, "vector")
    length = F.aggregate("vector", F.lit(0.0), lambda a, c: a + F.floor(c * 256).cast("double") * F.floor(c * 256).cast("double"))
    # the sum of squares is rounded; a little more is a bound
    bound = rows.agg(F.max(length)).first()[0] or 0.0
    if bound >= 2.0 ** 62:
        raise ValueError("scores do not fit 64 bits")
    primes = primes_for(int(bound * 1.000001) + 1)
    anchors = stored(rows.filter("anchor AND id IS NOT NULL").groupBy("id", "label", "vector").agg(F.count("*").alias("copies")), "anchors")
    size = anchors.count()
    chunks = max(1, -(-size * (width * (8 + 4 * len(primes)) + 300) // CHUNK_BYTES))
    parts = []
    every = rows.select("id", "label", "vector")
    for chunk in range(chunks):
        table = anchors.filter(F.pmod(F.xxhash64("id", "label", "vector"), F.lit(chunks)) == chunk).toArrow()
        if not len(table):
            continue
        anchor_id = table.column("id").to_numpy()
        order = np.argsort(anchor_id, kind="stable")
        given = {"label": table.column("label").to_numpy()[order], "x": integers(table.column("vector"), width)[order]}
        anchor_id, copies = anchor_id[order], table.column("copies").to_numpy()[order]
        # one place more, for the anchor itself
        near = every.mapInArrow(_alike(spark.sparkContext.broadcast(given), width, primes, positives + 1), "list bigint, id bigint, score bigint")
        near = _first(near, positives + 1).select("list", "id", "score", "rank").toArrow()
        found = _without_self(near, anchor_id, (given["x"] * given["x"]).sum(1), positives)
        owner, positive, score = found
        # low * positive <= 100 * negative, in whole numbers; scores below 2**62 are multiplied as Python integers where need be
        floor = np.array([-(-low * int(v) // 100) for v in score.tolist()], np.int64)
        sent = spark.sparkContext.broadcast(given | {"floor": floor, "top": score, "owner": owner})
        far = _first(every.mapInArrow(_unlike(sent, width, primes, negatives, low), "list bigint, id bigint, score bigint"), negatives)
        lists = spark.createDataFrame(pa.table({
            "list": np.arange(len(owner)), "anchor_id": anchor_id[owner], "positive_id": pa.array(positive, mask=positive == _LAST),
            "positive_score": score, "copies": copies[owner]})) if len(owner) else None
        if lists is not None:
            out = far.join(F.broadcast(lists), "list").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
            out = out.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
            parts.append(stored(out, "negatives") if chunks > 1 else out)
    if not parts:
        return spark.createDataFrame([], "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint")
    out = parts[0]
    for part in parts[1:]:
        out = out.unionAll(part)
    return out


def _without_self(near: pa.Table, anchor_id: np.ndarray, square: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(list, id, score) of the first ``n`` rows of each anchor but the anchor itself, in order.

    A row with the anchor's id and the score of the anchor with itself stands for the anchor: where a
    row of another vector has both, it takes the anchor's place, which gives the same rows.
    """
    lists, rank = near.column("list").to_numpy(), near.column("rank").to_numpy()
    ids, score = near.column("id").fill_null(_LAST).to_numpy(), near.column("score").to_numpy()
    order = np.lexsort((rank, lists))
    lists, ids, score = lists[order], ids[order], score[order]
    own = (ids == anchor_id[lists]) & (score == square[lists])
    at = np.flatnonzero(own)
    first = at[np.unique(lists[at], return_index=True)[1]]
    keep = np.ones(len(lists), bool)
    keep[first] = False
    lists, ids, score = lists[keep], ids[keep], score[keep]
    begin = np.searchsorted(lists, lists)
    top = np.arange(len(lists)) - begin < n
    return lists[top], ids[top], score[top]
