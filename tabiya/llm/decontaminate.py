"""Benchmark decontamination by a broadcast hash set of test n-grams.

A window is ``width`` consecutive normalised words of a benchmark item (an
item of fewer words, but not none, is one window). The windows' hashes form a
sorted array that is broadcast in blocks of proven size; every task scans the
word windows of its texts, and each hash hit is verified word by word.

Defined cases: a null or empty text has no words; a null or wordless item has
no window; an empty benchmark leaves every text clean; equal items all count;
a null item_id counts as the string 'null'; repeated rows are judged each on
its own; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bytetext as B
from .common import lean, ship

WIDTH = 10
#: Bytes of benchmark text in one broadcast block; a larger benchmark is scanned block by block.
BLOCK_BYTES = 8 << 20
_FILTER_BITS = 22


class Index:
    """Windows of a block of items: per window length sorted hashes with item and place."""

    def __init__(self, items: list[tuple[str, str]], width: int):
        self.names = [i for i, _ in items]
        buf, offsets = B.buffers(pa.array([t for _, t in items], pa.string()))
        tok = B.tokens(buf, offsets, B.WORD)
        word = B.spans_hash(tok.buf, tok.starts, tok.ends)
        self.words = [[tok.bytes_of(k) for k in range(a, b)] for a, b in zip(tok.first[:-1], tok.first[1:])]
        found: dict[int, list[tuple[int, int, int]]] = {}
        for i, (a, b) in enumerate(zip(tok.first[:-1], tok.first[1:])):
            n = min(width, int(b - a))
            if n:
                for p, h in enumerate(B.window_hash(word[a:b], n).tolist()):
                    found.setdefault(n, []).append((h, i, p))
        self.by_length = {}
        for n, rows in found.items():
            rows.sort()
            h = np.array([r[0] for r in rows], np.uint64)
            seen = np.zeros(1 << _FILTER_BITS, bool)
            seen[h >> np.uint64(64 - _FILTER_BITS)] = True
            self.by_length[n] = (h, [r[1] for r in rows], [r[2] for r in rows], seen)

    def hits(self, tok: B.Tokens) -> Iterator[tuple[int, int, int]]:
        """(token number, window length, item) of every verified occurrence."""
        word = B.spans_hash(tok.buf, tok.starts, tok.ends)
        for n, (hashes, item, place, seen) in self.by_length.items():
            at = B.doc_windows(tok.first, n)
            if not len(at):
                continue
            h = B.window_hash(word, n)[at]
            near = np.flatnonzero(seen[h >> np.uint64(64 - _FILTER_BITS)])
            if not len(near):
                continue
            lo = np.searchsorted(hashes, h[near], side="left")
            hi = np.searchsorted(hashes, h[near], side="right")
            for k in np.flatnonzero(hi > lo):
                t = int(at[near[k]])
                words = [tok.bytes_of(j) for j in range(t, t + n)]
                for e in range(lo[k], hi[k]):
                    if self.words[item[e]][place[e]:place[e] + n] == words:
                        yield t, n, item[e]


def item_blocks(benchmark: DataFrame, item_col: str, text_col: str, block_bytes: int) -> Iterator[list[tuple[str, str]]]:
    """Items in blocks of at most ``block_bytes`` of text, read one block at a time."""
    block, size = [], 0
    rows = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("null")).alias("i"), F.col(text_col).alias("t"))
    for r in rows.filter(F.col("t").isNotNull() & (F.col("t") != "")).toLocalIterator():
        n = len(r.t.encode())
        if block and size + n > block_bytes:
            yield block
            block, size = [], 0
        block.append((r.i, r.t))
        size += n
    if block:
        yield block


def _scanner(index: Broadcast | None, last: bool):
    """One pass over the texts: adds this block's spans and items; the last pass counts."""

    def scan(batches):
        for batch in batches:
            cols = {n: batch.column(n) for n in batch.schema.names}
            buf, offsets = B.buffers(cols["text"])
            n_words, n_hit, spans_out, items_out = [], [], [], []
            old_spans = cols["spans"].to_pylist()
            old_items = cols["items"].to_pylist()
            for i, j in B.slices(offsets):
                tok = B.tokens(buf[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], B.WORD)
                spans: dict[int, list[int]] = {}
                items: dict[int, set[str]] = {}
                if index is not None:
                    doc_of = None
                    for t, n, item in index.value.hits(tok):
                        doc_of = tok.doc() if doc_of is None else doc_of
                        d = int(doc_of[t])
                        spans.setdefault(d, []).extend((t - int(tok.first[d]), t - int(tok.first[d]) + n))
                        items.setdefault(d, set()).add(index.value.names[item])
                for d in range(j - i):
                    count = int(tok.first[d + 1] - tok.first[d])
                    flat = (old_spans[i + d] or []) + spans.get(d, [])
                    names = set(old_items[i + d] or []) | items.get(d, set())
                    if last and flat:
                        mark = np.zeros(count + 1, np.int64)
                        np.add.at(mark, flat[0::2], 1)
                        np.add.at(mark, flat[1::2], -1)
                        covered = np.cumsum(mark[:-1]) > 0
                        edges = np.flatnonzero(np.diff(np.concatenate(([0], covered.view(np.int8), [0]))))
                        flat = edges.tolist()
                        n_hit.append(int(covered.sum()))
                    else:
                        n_hit.append(0)
                    n_words.append(count)
                    spans_out.append(flat)
                    items_out.append(sorted(names))
            out = {"id": cols["id"], "spans": pa.array(spans_out, pa.list_(pa.int64())),
                   "items": pa.array(items_out, pa.list_(pa.string())),
                   "n_words": pa.array(n_words, pa.int64()), "n_hit": pa.array(n_hit, pa.int64())}
            if last:
                out["items_sha256"] = pa.array([hashlib.sha256(",".join(x).encode()).hexdigest() for x in items_out])
            if not last:
                out["text"] = cols["text"]
            yield pa.RecordBatch.from_arrays(list(out.values()), names=list(out))

    return scan


def find_contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       item_col: str = "item_id", item_text_col: str = "text", width: int = WIDTH,
                       block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per document: n_words, n_hit, n_items, items_sha256, contaminated, ``items`` (ids, sorted as
    strings) and ``spans`` (flat list of word starts and ends, merged) of the benchmark passages in it."""
    spark = ship(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    df = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"),
                     F.lit(None).cast("array<bigint>").alias("spans"), F.lit(None).cast("array<string>").alias("items"))
    blocks = item_blocks(benchmark, item_col, item_text_col, block_bytes)
    index = None
    state = f"id {kind}, spans array<bigint>, items array<string>, n_words bigint, n_hit bigint"
    for block in blocks:
        if index is not None:
            df = df.mapInArrow(_scanner(index, last=False), state + ", text string")
            df = df.select("id", "text", "spans", "items")
        index = spark.sparkContext.broadcast(Index(block, width))
    df = df.mapInArrow(_scanner(index, last=True), state + ", items_sha256 string")
    return df.select(F.col("id").alias(id_col), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                     "items_sha256", (F.col("n_hit") > 0).alias("contaminated"), "items", "spans")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", width: int = WIDTH,
                      block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Rows of ``docs`` whose text has no benchmark window; all columns are kept, nothing is shuffled."""
    spark = ship(docs.sparkSession)

    def clean(index):
        def keep(batches):
            for batch in batches:
                buf, offsets = B.buffers(batch.column(text_col))
                mask = np.ones(batch.num_rows, bool)
                for i, j in B.slices(offsets):
                    tok = B.tokens(buf[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], B.WORD)
                    hit = np.array([t for t, _, _ in index.value.hits(tok)], np.int64)
                    mask[i + np.searchsorted(tok.first, hit, side="right") - 1] = False
                yield batch.filter(pa.array(mask))
        return keep

    for block in item_blocks(benchmark, "item_id", "text", block_bytes):
        docs = docs.mapInArrow(lean(clean(spark.sparkContext.broadcast(Index(block, width)))), docs.schema)
    return docs


def remove_spans(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 width: int = WIDTH) -> DataFrame:
    """(id, text) with the contaminated words cut out; clean texts stay as they are.

    A cut reaches from the first to the last byte of each merged span; the rest of the text is unchanged.
    """
    spark = ship(docs.sparkSession)
    indexes = [spark.sparkContext.broadcast(Index(b, width)) for b in item_blocks(benchmark, "item_id", "text", BLOCK_BYTES)]

    def cut(batches):
        for batch in batches:
            buf, offsets = B.buffers(batch.column("text"))
            out = []
            for i, j in B.slices(offsets):
                tok = B.tokens(buf[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], B.WORD)
                raw = buf[offsets[i]:offsets[j]]
                drop = np.zeros(len(raw) + 1, np.int64)
                for index in indexes:
                    for t, n, _ in index.value.hits(tok):
                        drop[tok.starts[t]] += 1
                        drop[tok.ends[t + n - 1]] -= 1
                keep = np.cumsum(drop[:-1]) == 0
                cuts = offsets[i:j + 1] - offsets[i]
                out += [raw[a:b][keep[a:b]].tobytes().decode() for a, b in zip(cuts[:-1], cuts[1:])]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(out, pa.string())], names=["id", "text"])

    kind = docs.schema[id_col].dataType.simpleString()
    df = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return df.mapInArrow(cut, f"id {kind}, text string").withColumnsRenamed({"id": id_col, "text": text_col})
