"""Token-id files: frequency-ranked ids in byte-aligned variable-length coding.

Tokenising: a word-level tokenizer's pieces do not depend on their
neighbours, so each batch cuts its texts into pieces with numpy, and the
tokenizers library encodes every distinct piece once. Texts with characters
outside the range whose cutting rule is known to the fast path, or with an
added token of the tokenizer file, go to the library as a whole.

Files: ids are replaced by their rank in the corpus (0: most frequent), so
that most take one byte. A block holds up to ``BLOCK`` values as control bytes
(four 2-bit lengths each) followed by the data bytes; a table lookup of the
control bytes gives all lengths, and one running sum all places. A file is

    magic, number of documents, per document its id and number of ids, blocks

and documents stand in ascending id order across the folder's files. Tasks
write files under new names into the shared folder and return manifest rows;
only files of the manifest count, so a repeated task leaves at most an orphan.

Defined cases: a null or empty text has only the end id; null document ids
come first; rows that repeat an id stand beside each other; other columns are
ignored.
"""

from __future__ import annotations

import functools
import itertools
import json
import re
import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import bytetext as B
from .common import drop_stored, ship, shared_path, stored
from .warc import open_folder

MAGIC = b"RANKVB01"
BLOCK = 1 << 18
FILE_TOKENS = 1 << 23
BATCH_BYTES = 1 << 21
#: Pieces kept encoded in a worker.
KEPT_PIECES = 1_500_000
#: Texts of these characters are lower-cased and cut alike by the fast path and by the library.
PLAIN = re.compile("[\t-\r -~À-ÖØ-öø-įı-ſ]*")
_CLASS = np.full(256, 2, np.uint8)
_CLASS[list(range(9, 14)) + [32]] = 0
_CLASS[97:123] = 1
_CLASS[128:] = 1
_CLASS[48:58] = 3


class WordTokenizer:
    """Ids of texts under a tokenizer that lower-cases and cuts into contractions, letter runs, digits and other runs."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        spec = json.loads(self.library.to_str())
        cut = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"] if spec["pre_tokenizer"]["type"] == "Sequence" else ""
        #: the fast path knows this one rule; any other tokenizer goes through the library text by text
        self.fast = cut == r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
        #: the library cuts added tokens out of the raw or of the normalised text, before the rule
        added = spec.get("added_tokens") or []
        self.added = re.compile("|".join(re.escape(t["content"]) for t in added), re.IGNORECASE) if added else None
        self.forget()

    def forget(self) -> None:
        """Pieces encoded so far: sorted hashes, and where their ids are."""
        self.kept, self.first, self.size, self.flat = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def learn(self, h: np.ndarray, pieces: list[str]) -> None:
        """Encode new pieces (of ascending hashes ``h``)."""
        coded = self.whole(pieces)
        size = np.array([len(c) for c in coded], np.int64)
        at = np.searchsorted(self.kept, h)
        self.kept, self.size = np.insert(self.kept, at, h), np.insert(self.size, at, size)
        self.first = np.insert(self.first, at, len(self.flat) + np.cumsum(size) - size)
        self.flat = np.concatenate((self.flat, np.fromiter(itertools.chain.from_iterable(coded), np.int64, int(size.sum()))))

    def whole(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def cut(self, buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the pieces of lower-cased plain texts."""
        cls = _CLASS[buf]
        edge = np.ones(len(buf) + 1, bool)
        edge[1:-1] = (cls[1:] != cls[:-1]) | (cls[1:] == 3)
        edge[offsets] = True
        at = np.flatnonzero(edge)
        inside = cls[at[:-1]] > 0
        starts, ends = at[:-1][inside], at[1:][inside]
        # a lone apostrophe right before letters takes s, t, m, d, re, ve or ll
        lone = np.flatnonzero((ends - starts == 1) & (buf[starts] == 39))
        lone = lone[lone + 1 < len(starts)]
        lone = lone[(starts[lone + 1] == ends[lone]) & (cls[np.minimum(ends[lone], len(buf) - 1)] == 1) & ~np.isin(ends[lone], offsets)]
        if len(lone):
            size = ends[lone + 1] - starts[lone + 1]
            one = buf[starts[lone + 1]]
            two = np.where(size > 1, buf[np.minimum(starts[lone + 1] + 1, len(buf) - 1)], 0)
            take = np.where(np.isin(one, np.frombuffer(b"stmd", np.uint8)), 1, 0)
            pair = ((one == 114) & (two == 101)) | ((one == 118) & (two == 101)) | ((one == 108) & (two == 108))
            take = np.where(pair, 2, take)
            ends[lone] += take
            starts[lone + 1] += take
            keep = starts < ends
            starts, ends = starts[keep], ends[keep]
        return starts, ends

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids and offsets per text."""
        plain = [self.fast and PLAIN.fullmatch(t) is not None and not (self.added and self.added.search(t)) for t in texts]
        low = [t.lower().encode() for t, ok in zip(texts, plain) if ok]
        offsets = np.concatenate(([0], np.cumsum([len(x) for x in low]))).astype(np.int64)
        buf = np.frombuffer(b"".join(low), np.uint8)
        if len(buf):
            starts, ends = self.cut(buf, offsets)
        else:
            starts = ends = np.zeros(0, np.int64)
        h = B.spans_hash(buf, starts, ends)
        unique, pick, back = np.unique(h, return_index=True, return_inverse=True)
        if len(self.kept) > KEPT_PIECES:
            self.forget()
        at = np.searchsorted(self.kept, unique)
        new = np.flatnonzero((at == len(self.kept)) | (self.kept[np.minimum(at, len(self.kept) - 1)] != unique)) if len(self.kept) else np.arange(len(unique))
        if len(new):
            raw = buf.tobytes()
            self.learn(unique[new], [raw[a:b].decode() for a, b in zip(starts[pick[new]].tolist(), ends[pick[new]].tolist())])
            at = np.searchsorted(self.kept, unique)
        per = self.size[at][back]
        begin = np.cumsum(per) - per
        ids = self.flat[np.repeat(self.first[at][back] - begin, per) + np.arange(int(per.sum()))]
        piece0 = np.searchsorted(starts, offsets)
        bounds = np.append(begin, per.sum())[piece0]
        rest = self.whole([t for t, ok in zip(texts, plain) if not ok])
        if not rest:
            return ids, bounds
        parts, k, r = [], 0, 0
        for ok in plain:
            if ok:
                parts.append(ids[bounds[k]:bounds[k + 1]])
                k += 1
            else:
                parts.append(np.array(rest[r], np.int64))
                r += 1
        return np.concatenate(parts), np.concatenate(([0], np.cumsum([len(p) for p in parts])))


@functools.lru_cache(2)
def _tokenizer(path: str) -> WordTokenizer:
    return WordTokenizer(path)


def tokenise(docs: DataFrame, tokenizer_path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row_id, id, ids): every text's ids and the end id, packed little-endian in ``id_type`` of the tokenizer."""
    ship(docs.sparkSession)
    kind_of_id = id_type(tokenizer_path, end_id)

    def encode(batches):
        tok = _tokenizer(tokenizer_path)
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            sizes = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
            for i, j in B.slices(sizes, BATCH_BYTES):
                ids, bounds = tok.encode(texts[i:j])
                ids = np.insert(ids, bounds[1:], end_id).astype(kind_of_id)
                bounds = (bounds + np.arange(len(bounds))) * ids.itemsize
                packed = pa.Array.from_buffers(pa.large_binary(), j - i, [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(ids)])
                yield pa.RecordBatch.from_arrays([batch.column("row_id").slice(i, j - i), batch.column("id").slice(i, j - i), packed.cast(pa.binary())], names=["row_id", "id", "ids"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.monotonically_increasing_id().alias("row_id"), F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(encode, f"row_id bigint, id {kind}, ids binary")


def id_type(tokenizer_path: str, end_id: int) -> str:
    """Two bytes where all ids fit."""
    return "<u2" if max(_tokenizer(tokenizer_path).library.get_vocab_size() - 1, end_id) < 1 << 16 else "<u4"


def _frequencies(kind: str):
    def count(batches):
        total = np.zeros(0, np.int64)
        for batch in batches:
            column = batch.column("ids").cast(pa.large_binary())
            at = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
            n = np.bincount(np.frombuffer(column.buffers()[2], np.uint8)[at[0]:at[-1]].view(kind)) if at[-1] > at[0] else total[:0]
            if len(n) > len(total):
                total = np.concatenate((total, np.zeros(len(n) - len(total), np.int64)))
            total[:len(n)] += n
        have = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(have, pa.int64()), pa.array(total[have], pa.int64())], names=["token", "n"])

    return count


def ranked_ids(tokens: DataFrame, kind: str = "<u4") -> np.ndarray:
    """Ids by falling corpus frequency (ties: smaller id first); as many as the tokenizer has ids at most."""
    counts = tokens.select("ids").mapInArrow(_frequencies(kind), "token bigint, n bigint").groupBy("token").agg(F.sum("n").alias("n"))
    rows = counts.orderBy(F.desc("n"), "token").select("token").toPandas()
    return rows["token"].to_numpy(np.int64)


def encode_block(values: np.ndarray) -> bytes:
    """Control bytes and data bytes of up to ``BLOCK`` values below 2**32, with their sizes in front."""
    v = values.astype("<u4")
    size = 1 + (v > 0xFF) + (v > 0xFFFF) + (v > 0xFFFFFF)
    code = np.zeros(-(-len(v) // 4) * 4, np.uint8)
    code[:len(v)] = size - 1
    code = code.reshape(-1, 4)
    control = code[:, 0] | code[:, 1] << 2 | code[:, 2] << 4 | code[:, 3] << 6
    data = v.view(np.uint8).reshape(-1, 4)[np.arange(4) < size[:, None]]
    return struct.pack("<II", len(v), len(data)) + control.astype(np.uint8).tobytes() + data.tobytes()


#: Control byte -> the lengths of its four values.
LENGTHS = (((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3) + 1).astype(np.int64)


def decode_block(data: bytes, n: int) -> np.ndarray:
    """The ``n`` values of a block's control and data bytes."""
    width = -(-n // 4)
    raw = np.frombuffer(data, np.uint8)
    size = LENGTHS[raw[:width]].reshape(-1)[:n]
    body = np.concatenate((raw[width:], np.zeros(3, np.uint8))).astype(np.uint32)
    at = np.cumsum(size) - size
    out = body[at]
    for k in (1, 2, 3):
        out |= np.where(size > k, body[at + k], 0).astype(np.uint32) << np.uint32(8 * k)
    return out


def _writer(folder: str, ranks: np.ndarray, file_tokens: int, kind: str):
    inverse = np.zeros(int(ranks.max()) + 1 if len(ranks) else 1, np.uint32)
    inverse[ranks] = np.arange(len(ranks))

    def write(batches):
        store, path = open_folder(folder)
        part = TaskContext.get().partitionId()
        seq, names, counts, parts, gathered = 0, [], [], [], 0

        def done():
            name = f"{part:06d}-{seq:06d}-{uuid.uuid4().hex}.rvb"
            total = sum(counts)
            with store.open_output_stream(f"{path}/{name}", compression=None) as out:
                out.write(MAGIC + struct.pack("<Q", len(names)))
                for name_, count in zip(names, counts):
                    raw = b"" if name_ is None else name_.encode()
                    out.write(struct.pack("<iQ", -1 if name_ is None else len(raw), count) + raw)
                held, size = [], 0
                for ids in parts:
                    for a in range(0, len(ids), BLOCK):
                        held.append(ids[a:a + BLOCK])
                        size += len(held[-1])
                        while size >= BLOCK:
                            values = np.concatenate(held)
                            out.write(encode_block(inverse[values[:BLOCK]]))
                            held, size = [values[BLOCK:]], size - BLOCK
                if size:
                    out.write(encode_block(inverse[np.concatenate(held)]))
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([seq], pa.int64()), pa.array([name]), pa.array([len(names)], pa.int64()), pa.array([total], pa.int64())], names=["part", "seq", "file", "n_docs", "n_tokens"])

        for batch in batches:
            for name, packed in zip(batch.column("id").to_pylist(), batch.column("ids").to_pylist()):
                names.append(name)
                parts.append(np.frombuffer(packed, kind))
                counts.append(len(parts[-1]))
                gathered += counts[-1]
                if gathered >= file_tokens:
                    yield done()
                    seq, names, counts, parts, gathered = seq + 1, [], [], [], 0
        if names:
            yield done()

    return write


def write_files(tokens: DataFrame, ranks: np.ndarray, folder: str, file_tokens: int = FILE_TOKENS, kind: str = "<u4") -> DataFrame:
    """Write a stored table (row_id, id, ids) in ascending id order; the stored manifest with every file's first place."""
    spark = ship(tokens.sparkSession)
    store, path = open_folder(folder)
    store.create_dir(path, recursive=True)
    with store.open_output_stream(f"{path}/ranks.bin", compression=None) as out:
        out.write(ranks.astype("<u4").tobytes())
    rows = tokens.repartitionByRange("id", "row_id").sortWithinPartitions("id", "row_id").select(F.col("id").cast("string").alias("id"), "ids")
    manifest = stored(rows.mapInArrow(_writer(folder, ranks, file_tokens, kind), "part bigint, seq bigint, file string, n_docs bigint, n_tokens bigint"), "manifest")
    # one row per range partition
    parts = manifest.groupBy("part").agg(F.sum("n_tokens").alias("n")).orderBy("part").collect()
    base, first = 0, []
    for p in parts:
        first.append((p.part, base))
        base += p.n
    bases = spark.createDataFrame(first, "part bigint, base bigint")
    before = F.sum("n_tokens").over(Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1))
    return manifest.withColumn("before", F.coalesce(before, F.lit(0))).join(F.broadcast(bases), "part").select("file", (F.col("base") + F.col("before")).alias("start"), "n_docs", "n_tokens")


def _blocks(stream, ranks: np.ndarray) -> Iterator[np.ndarray]:
    while head := stream.read(8):
        n, size = struct.unpack("<II", head)
        yield ranks[decode_block(stream.read(-(-n // 4) + size), n)]


def read_file(stream, ranks: np.ndarray) -> Iterator[tuple[str | None, np.ndarray]]:
    """(document id as text, ids) of a file, block by block."""
    if stream.read(8) != MAGIC:
        raise ValueError("not a token-id file")
    (n,) = struct.unpack("<Q", stream.read(8))
    index = []
    for _ in range(n):
        size, count = struct.unpack("<iQ", stream.read(12))
        index.append((None if size < 0 else stream.read(size).decode(), count))
    blocks, held = _blocks(stream, ranks), np.zeros(0, np.uint32)
    for name, count in index:
        parts, need = [], count
        while need > len(held):
            parts.append(held)
            need -= len(held)
            held = next(blocks)
        parts.append(held[:need])
        held = held[need:]
        yield name, np.concatenate(parts)


def read_files(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """(id as text, start, n_tokens, ids as packed little-endian uint32) of the manifest's files."""
    ship(spark)

    def read(batches):
        store, path = open_folder(folder)
        with store.open_input_file(f"{path}/ranks.bin") as f:
            ranks = np.frombuffer(f.read(), "<u4")
        for batch in batches:
            for file, start in zip(batch.column("file").to_pylist(), batch.column("start").to_pylist()):
                with store.open_input_stream(f"{path}/{file}", compression=None, buffer_size=1 << 20) as stream:
                    rows, size = [], 0
                    for name, ids in read_file(stream, ranks):
                        rows.append((name, start, len(ids), ids.astype("<u4").tobytes()))
                        start += len(ids)
                        size += len(ids)
                        if size > 1 << 20:
                            yield _batch(rows)
                            rows, size = [], 0
                    if rows:
                        yield _batch(rows)

    # a given number of partitions: Spark would put the small rows that name the files into one task
    files = manifest.select("file", "start").repartition(max(1, manifest.count()))
    return files.mapInArrow(read, "id string, start bigint, n_tokens bigint, ids binary")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["id", "start", "n_tokens", "ids"])


def file_round_trip(docs: DataFrame, tokenizer_path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Tokenise, write the files, and read them back: id, start, n_tokens, ids."""
    spark = docs.sparkSession
    folder = shared_path(spark, "tokens")
    tokens = stored(tokenise(docs, tokenizer_path, end_id, id_col, text_col), "tokenised")
    width = id_type(tokenizer_path, end_id)
    manifest = stored(write_files(tokens, ranked_ids(tokens, width), folder, kind=width), "files")
    drop_stored(tokens)
    kind = docs.schema[id_col].dataType.simpleString()
    return read_files(spark, folder, manifest).withColumn("id", F.expr(f"cast(id as {kind})")).withColumnRenamed("id", id_col)
