"""Near-duplicate groups by BagMinHash signatures, bands and exact verification.

A document is the multiset of its five-word shingles. BagMinHash gives every
(shingle, weight level) a Poisson process of points in time; the levels are
the dyadic intervals [0,1), [1,2), [2,4), ... of the integer weight, a point
keeps the part of its interval it fell into, and counts only below the
shingle's multiplicity. Processes of all shingles of a batch advance together
and stop as soon as they pass the largest of their document's minima. Each of
the ``m`` minima then agrees between two documents with probability equal to
their weighted Jaccard similarity.

Equal multisets collapse into classes first. Bands of the classes' signatures
put classes into buckets, and multiset overlap verifies pairs. A bucket's
members are first compared with one member (a linear number of pairs): the one
with the smallest row, then the one with the smallest share of shingles that
no other open class has, which in a group of edited copies is the least
edited. Members of one connected group need no further comparison. For what
is left between different groups, a prefix filter over the open classes'
shingles, rarest first, replaces the pairs of a bucket: two classes that reach
the threshold share a shingle of their prefixes, and copies with many edits of
their own have none to share. So nothing that a bucket proposes is lost, and
no bucket's pairs are listed.

Defined cases: a null or empty text, or one without a word, has no shingle and
equals only the same text (null = empty); a text of fewer than five words is
one shingle; repeated rows are copies of each other; a null id sorts last.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import bytetext as B
from .common import lean, ship, stored

WIDTH = 5
THRESHOLD = 0.8
#: 48 bands of 7 positions each, no position in two: a pair at 0.8 is missed once in 80,000, (1 - 0.8^7)^48.
POSITIONS, BAND_ROWS = 336, 7
#: Bytes of text whose shingles a worker holds at once (some 60 bytes of arrays each); a longer text is alone.
SLICE = 1 << 19
_U = np.uint64
_STEP, _LEVEL, _SPLIT = _U(0x9E3779B97F4A7C15), _U(0xA24BAED4963EE407), _U(0x9FB21C651E98DF25)


def _bands() -> np.ndarray:
    return np.random.Generator(np.random.Philox(7)).permutation(POSITIONS).reshape(-1, BAND_ROWS)


def shingles(tok: B.Tokens, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, shingle hash, multiplicity), ordered by text."""
    word = B.spans_hash(tok.buf, tok.starts, tok.ends)
    counts = np.diff(tok.first)
    at = B.doc_windows(tok.first, width)
    h = B.window_hash(word, width)[at]
    doc = np.repeat(np.arange(len(counts)), np.maximum(counts - width + 1, 0))
    for n in range(1, width):
        few = np.flatnonzero(counts == n)
        if len(few):
            h = np.concatenate((h, B.window_hash(word, n)[tok.first[few]] if len(word) >= n else h[:0]))
            doc = np.concatenate((doc, few))
    order = np.lexsort((h, doc))
    doc, h = doc[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])
    start = np.flatnonzero(new)
    return doc[start], h[start], np.diff(np.append(start, len(h)))


def bag_minhash(doc: np.ndarray, h: np.ndarray, weight: np.ndarray, n_docs: int, m: int = POSITIONS) -> np.ndarray:
    """(n_docs, m) times of the first accepted point; equal times mean the same point."""
    minima = np.full(n_docs * m, np.inf)
    process = [(doc, h, np.zeros(len(h), np.int64), np.ones(len(h), np.int64), weight)]
    low = 1
    while len(more := np.flatnonzero(weight > low)):
        process.append((doc[more], h[more], np.full(len(more), low), np.full(len(more), low), weight[more]))
        low *= 2
    doc = np.concatenate([p[0] for p in process])
    level = np.concatenate([p[2] for p in process])
    size = np.concatenate([p[3] for p in process])
    most = np.concatenate([p[4] for p in process])
    seed = B.mix(np.concatenate([p[1] for p in process]) + level.astype(_U) * _LEVEL)
    time = np.zeros(len(doc))
    step = 0
    while len(doc):
        step += 1
        a = B.mix(seed + _U(step * int(_STEP) & 0xFFFFFFFFFFFFFFFF))
        time = time - np.log(B.uniform(a)) / size
        b = B.mix(a ^ _SPLIT)
        position = ((b >> _U(32)) * _U(m) >> _U(32)).astype(np.int64)
        part = level + (((b & _U(0xFFFFFFFF)) * size.astype(_U)) >> _U(32)).astype(np.int64)
        live = time < minima.reshape(n_docs, m).max(1)[doc] if step > 1 else np.ones(len(doc), bool)
        ok = live & (part < most)
        np.minimum.at(minima, doc[ok] * m + position[ok], time[ok])
        if step > 1 or len(doc) > 4 * m:
            live = time < minima.reshape(n_docs, m).max(1)[doc]
        doc, level, size, most, seed, time = (x[live] for x in (doc, level, size, most, seed, time))
    return minima.reshape(n_docs, m)


def _sign(batches):
    """Class key, number of shingles and band keys of every text."""
    bands = _bands()
    for batch in batches:
        buf, offsets = B.buffers(batch.column("text"))
        keys, sizes, band_keys = [], [], []
        for i, j in B.slices(offsets, SLICE):
            tok = B.tokens(buf[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], B.WORD)
            n = j - i
            doc, h, weight = shingles(tok)
            total = np.bincount(doc, weight, n).astype(np.int64)
            key = np.zeros((n, 2), _U)
            mixed = B.mix(h) * weight.astype(_U)
            np.add.at(key[:, 0], doc, mixed)
            np.add.at(key[:, 1], doc, B.mix(h ^ _SPLIT) * weight.astype(_U))
            bare = np.flatnonzero(total == 0)
            if len(bare):  # no words: the raw text is the class
                cut = offsets[i:j + 1] - offsets[i]
                whole = B.spans_hash(buf[offsets[i]:offsets[j]], cut[bare], cut[bare + 1])
                key[bare, 0], key[bare, 1] = whole, B.mix(whole)
            sign = bag_minhash(doc, h, weight, n).view(_U)
            rows = np.zeros((n, len(bands)), _U)
            for k in range(BAND_ROWS):
                rows = B.mix(rows * _U(0xD6E8FEB86659FD93) + sign[:, bands[:, k]])
            rows += np.arange(len(bands), dtype=_U)[None, :] * _LEVEL
            keys.append(key)
            sizes.append(total)
            band_keys.append(B.mix(rows))
        if not keys:
            continue
        key, total, rows = np.concatenate(keys).view(np.int64), np.concatenate(sizes), np.concatenate(band_keys).view(np.int64)
        width = rows.shape[1]
        lists = pa.ListArray.from_arrays(pa.array(np.arange(0, (len(rows) + 1) * width, width), pa.int32()), pa.array(rows.ravel()))
        yield pa.RecordBatch.from_arrays(
            [batch.column("row_id"), batch.column("id"), pa.array(key[:, 0].copy()), pa.array(key[:, 1].copy()), pa.array(total), lists],
            names=["row_id", "id", "class_hi", "class_lo", "n_shingles", "bands"])


def weighted_jaccard(a: pa.Array, b: pa.Array) -> np.ndarray:
    """Multiset similarity of the shingles of two string columns, row by row."""
    out = []
    (buf_a, off_a), (buf_b, off_b) = B.buffers(a), B.buffers(b)
    for i, j in B.slices(off_a + off_b, SLICE):
        side = []
        for buf, off in ((buf_a, off_a), (buf_b, off_b)):
            tok = B.tokens(buf[off[i]:off[j]], off[i:j + 1] - off[i], B.WORD)
            side.append(shingles(tok))
        n = j - i
        total = sum(np.bincount(d, w, n) for d, _, w in side)
        doc = np.concatenate((side[0][0], side[1][0]))
        h = np.concatenate((side[0][1], side[1][1]))
        w = np.concatenate((side[0][2], side[1][2]))
        order = np.lexsort((h, doc))
        doc, h, w = doc[order], h[order], w[order]
        same = np.flatnonzero((doc[1:] == doc[:-1]) & (h[1:] == h[:-1]))
        common = np.bincount(doc[same], np.minimum(w[same], w[same + 1]), n)
        out.append(np.where(total > 0, common / np.maximum(total - common, 1), 0.0))
    return np.concatenate(out) if out else np.zeros(0)


def _verify(batches):
    for batch in batches:
        yield pa.RecordBatch.from_arrays(
            [batch.column("a"), batch.column("b"), pa.array(weighted_jaccard(batch.column("text_a"), batch.column("text_b")))],
            names=["a", "b", "similarity"])


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Similarity of every pair (a, b); the texts meet by two equi joins."""
    both = pairs.join(texts.select(F.col("row_id").alias("a"), F.col("text").alias("text_a")), "a") \
        .join(texts.select(F.col("row_id").alias("b"), F.col("text").alias("text_b")), "b")
    return both.select("a", "b", "text_a", "text_b").mapInArrow(lean(_verify), "a bigint, b bigint, similarity double")


def components(links: DataFrame) -> DataFrame:
    """(node, component) of an undirected graph: the smallest node of each component.

    Rounds of smallest-neighbour labels with pointer jumping; every round is written to the shared folder.
    """
    both = stored(links.select(F.col("a").alias("u"), F.col("b").alias("v")).union(links.select("b", "a")).distinct(), "graph")
    label = stored(both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("c")).select(F.col("u").alias("node"), "c"), "label")
    while True:
        near = both.join(label.select(F.col("node").alias("v"), F.col("c").alias("cv")), "v").groupBy("u").agg(F.min("cv").alias("cn"))
        step = label.join(near.withColumnRenamed("u", "node"), "node").select("node", "c", F.least("c", "cn").alias("n"))
        # a label is a node too: jump to that node's own label
        jump = label.select(F.col("node").alias("n"), F.col("c").alias("cj"))
        new = stored(step.join(jump, "n", "left").select("node", F.col("c").alias("old"), F.least("n", F.coalesce("cj", "n")).alias("c")), "label")
        if new.filter("c <> old").limit(1).count() == 0:
            return new.select("node", F.col("c").alias("component"))
        label = new.select("node", "c")


def _with_component(df: DataFrame, comp: DataFrame | None, key: str, name: str) -> DataFrame:
    if comp is None:
        return df.withColumn(name, F.col(key))
    named = comp.select(F.col("node").alias(key), F.col("component").alias("_c"))
    return df.join(named, key, "left").withColumn(name, F.coalesce("_c", key)).drop("_c")


def _size_filter(pairs: DataFrame, threshold: float) -> DataFrame:
    """Pairs (a, b) whose sizes allow the threshold: similarity is at most their ratio."""
    return pairs.filter(F.least("n_a", "n_b") >= F.greatest("n_a", "n_b") * (threshold - 1e-9)).select("a", "b")


def _flat_pairs(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("x.row_id").alias("a"), F.col("y.row_id").alias("b"), F.col("x.n_shingles").alias("n_a"), F.col("y.n_shingles").alias("n_b"))


def _open_entries(entries: DataFrame, comp: DataFrame) -> DataFrame:
    """Entries (bucket, row_id, n_shingles, c) of the buckets with members of different groups."""
    here = _with_component(entries.drop("lead"), comp, "row_id", "c")
    mixed = here.groupBy("bucket").agg(F.min("c").alias("c1"), F.max("c").alias("c2")).filter("c1 <> c2").select("bucket")
    return stored(here.join(mixed, "bucket", "left_semi"), "open")


def _token_rows(batches):
    """(row_id, token): one per shingle and repetition."""
    for batch in batches:
        buf, offsets = B.buffers(batch.column("text"))
        rows = batch.column("row_id").to_numpy()
        for i, j in B.slices(offsets, 1 << 18):
            tok = B.tokens(buf[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], B.WORD)
            doc, h, weight = shingles(tok)
            first = np.cumsum(weight) - weight
            again = np.arange(int(weight.sum())) - np.repeat(first, weight)
            token = B.mix(np.repeat(h, weight) + again.astype(_U) * _STEP).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(rows[i:j][np.repeat(doc, weight)]), pa.array(token)], names=["row_id", "token"])


def _shared_shingles(open_: DataFrame, texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Tokens of the open rows that several of them have: (row_id, token, df); and per row its size n and number u of tokens of its own."""
    rows = open_.select("row_id", F.col("n_shingles").alias("n")).distinct()
    tokens = stored(texts.join(rows.select("row_id"), "row_id", "left_semi").mapInArrow(lean(_token_rows), "row_id bigint, token bigint"), "tokens")
    common = tokens.groupBy("token").agg(F.count("*").alias("df")).filter("df > 1")
    shared = stored(tokens.join(common, "token"), "shared")
    own = rows.join(shared.groupBy("row_id").agg(F.count("*").alias("k")), "row_id", "left").select("row_id", "n", (F.col("n") - F.coalesce("k", F.lit(0))).alias("u"))
    return shared, stored(own, "own")


def _major_groups(entries: DataFrame) -> DataFrame:
    """(token, major): a token's largest group, of equal ones the last, so that every evaluation finds the same; only tokens of several groups."""
    groups = entries.groupBy("token", "c").agg(F.count("*").alias("k"), F.max("indexed").alias("i"))
    return groups.groupBy("token").agg(F.max_by("c", F.struct("k", "c")).alias("major"), F.min("c").alias("c1"), F.max("c").alias("c2"), F.max("i").alias("i")) \
        .filter("c1 <> c2 and i").select("token", "major")


def _prefix_pairs(shared: DataFrame, own: DataFrame, comp: DataFrame, threshold: float) -> DataFrame:
    """Pairs (a, b) of different groups that can reach the threshold by the prefix, length and positional filters.

    Tokens are ordered by frequency, so a row's own tokens come first and fill its prefix. Of a pair, the
    smaller row's index prefix and the larger row's probe prefix share a token.
    """
    t = threshold - 1e-9
    alive = own.withColumn("probe", F.col("n") - F.ceil(F.col("n") * t) + 1).filter("u < probe")
    alive = _with_component(alive.withColumn("index", F.col("n") - F.ceil(F.col("n") * (2 * t / (1 + t))) + 1), comp, "row_id", "c")
    by_rarity = Window.partitionBy("row_id").orderBy("df", "token")
    entries = shared.join(alive, "row_id").withColumn("r", F.col("u") + F.row_number().over(by_rarity)).filter("r <= probe")
    entries = stored(entries.select("token", "row_id", "n", "r", "c", (F.col("r") <= F.col("index")).alias("indexed")), "prefixes")
    # a token's largest group is compared with the others, not with itself
    entries = entries.join(_major_groups(entries), "token")
    minor = entries.filter("c <> major").drop("major")
    other = entries.select("token", *[F.col(x).alias(f"{x}_b") for x in ("row_id", "n", "r", "c", "indexed", "major")])
    smaller = (F.struct("n", "row_id") < F.struct(F.col("n_b").alias("n"), F.col("row_id_b").alias("row_id")))
    both = minor.join(other, "token").filter(
        (F.col("c") != F.col("c_b")) & ((F.col("c_b") == F.col("major_b")) | (F.col("row_id") < F.col("row_id_b")))
        & (F.least("n", "n_b") >= F.greatest("n", "n_b") * t) & F.when(smaller, F.col("indexed")).otherwise(F.col("indexed_b"))
        & (1 + F.least(F.col("n") - F.col("r"), F.col("n_b") - F.col("r_b")) >= F.ceil((F.col("n") + F.col("n_b")) * (t / (1 + t)))))
    x, y = F.struct("row_id", F.col("n").alias("n_shingles")), F.struct(F.col("row_id_b").alias("row_id"), F.col("n_b").alias("n_shingles"))
    return _flat_pairs(both.select(F.least(x, y).alias("x"), F.greatest(x, y).alias("y")).distinct()).select("a", "b")


def near_duplicates(base: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Groups of a table (row_id, id, text): row_id, id, class_row, group_row, n_shingles.

    ``base`` must be a stored table (row_id is stable). ``class_row`` is the
    first row of the rows with an equal shingle multiset, ``group_row`` the
    first of the connected classes with similarity of ``threshold`` or more.
    """
    ship(base.sparkSession)
    sign = stored(base.select("row_id", "id", "text").mapInArrow(
        lean(_sign), f"row_id bigint, id {base.schema['id'].dataType.simpleString()}, class_hi bigint, class_lo bigint, n_shingles bigint, bands array<bigint>"), "signatures")
    order = F.struct(F.col("id").isNull().alias("z"), F.col("id").alias("id"), F.col("row_id").alias("row_id"))
    classes = stored(sign.groupBy("class_hi", "class_lo").agg(F.min(order).alias("first"), F.max("n_shingles").alias("n_shingles"))
                     .select("class_hi", "class_lo", "first", F.col("first.row_id").alias("class_row"), "n_shingles"), "classes")
    alone = classes.filter("n_shingles > 0").select(F.col("class_row").alias("row_id"))
    entries = sign.join(alone, "row_id", "left_semi").select("row_id", "n_shingles", F.explode("bands").alias("bucket"))
    shared = entries.groupBy("bucket").agg(F.count("*").alias("n"), F.min("row_id").alias("lead")).filter("n > 1").drop("n")
    entries = stored(entries.join(shared, "bucket").select("bucket", "row_id", "n_shingles", "lead"), "buckets")
    wanted = entries.select("row_id").distinct()
    texts = stored(base.select("row_id", "text").join(wanted, "row_id", "left_semi"), "texts")

    # every bucket's members against its first row
    sizes = entries.select(F.col("row_id").alias("a"), F.col("n_shingles").alias("n_a")).distinct()
    pairs = entries.filter("row_id <> lead").select(F.col("lead").alias("a"), F.col("row_id").alias("b"), F.col("n_shingles").alias("n_b")).distinct().join(sizes, "a")
    done = stored(_verified(_size_filter(pairs, threshold), texts), "pairs")
    links, tested = done.filter(F.col("similarity") >= threshold).select("a", "b"), done.select("a", "b")
    comp = components(links)
    open_ = _open_entries(entries, comp)
    if open_.limit(1).count():
        shared, own = _shared_shingles(open_, texts)
        # against the least edited member
        rows = open_.join(own, "row_id")
        rank = F.struct((F.col("u") / F.col("n_shingles")).alias("share"), F.col("row_id"), F.col("c"), F.col("n_shingles"))
        lead = rows.groupBy("bucket").agg(F.min(rank).alias("lead"))
        x, y = F.struct("row_id", "n_shingles"), F.struct("lead.row_id", "lead.n_shingles")
        pairs = rows.join(lead, "bucket").filter("c <> lead.c").select(F.least(x, y).alias("x"), F.greatest(x, y).alias("y")).distinct()
        done = stored(_verified(_size_filter(_flat_pairs(pairs), threshold).join(tested, ["a", "b"], "left_anti"), texts), "pairs")
        links, tested = links.union(done.filter(F.col("similarity") >= threshold).select("a", "b")), tested.union(done.select("a", "b"))
        comp = components(links)
        # what is left: pairs of different groups that share a shingle of their prefixes
        pairs = _prefix_pairs(shared, own, comp, threshold).join(tested, ["a", "b"], "left_anti")
        done = stored(_verified(pairs, texts), "pairs")
        links = links.union(done.filter(F.col("similarity") >= threshold).select("a", "b"))
        comp = components(links)
    merged = _with_component(classes, comp, "class_row", "component")
    groups = merged.groupBy("component").agg(F.min("first").alias("lead"), F.count("*").alias("n_classes"))
    merged = merged.join(groups, "component").select("class_hi", "class_lo", "class_row", F.col("first.id").alias("class_id"), F.col("lead.row_id").alias("group_row"), F.col("lead.id").alias("group_id"), "n_classes")
    return sign.select("row_id", "id", "class_hi", "class_lo", "n_shingles").join(merged, ["class_hi", "class_lo"]).drop("class_hi", "class_lo")


def numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` stored with a stable row number, and that column's name (one that ``docs`` has not)."""
    name = "_row"
    while name in docs.columns:
        name += "_"
    return stored(docs.withColumn(name, F.monotonically_increasing_id()), "documents"), name


def duplicate_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per input row: id, class_id and group_id (ids of the first row of each), n_shingles, n_classes of the group, keep."""
    base, row = numbered(docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")))
    found = near_duplicates(base.withColumnRenamed(row, "row_id"), threshold)
    return found.select(F.col("id").alias(id_col), "class_id", "group_id", "n_shingles", "n_classes", (F.col("row_id") == F.col("group_row")).alias("keep"))


def drop_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The first row of each near-duplicate group, with all its columns."""
    whole, row = numbered(docs)
    base = whole.select(F.col(row).alias("row_id"), F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    keep = near_duplicates(base, threshold).filter("row_id = group_row").select(F.col("row_id").alias(row))
    return whole.join(keep, row, "left_semi").select(*docs.columns)
