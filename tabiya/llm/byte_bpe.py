"""Byte-level BPE encoding and decoding by recursive queries inside each task.

Every task holds an in-process DuckDB connection (memory only, one thread, no
file, no port) with two tables made from a public rank file: ``merges`` (left
id, right id, id of both together) and ``vocab`` (id, bytes). A text is cut
into the matches of the tokenizer's pattern with a few numpy passes over its
code points. The distinct words not met before go into the connection as rows
(word, position, id of one byte); a recursive query joins each row and its
successor with ``merges``, contracts every word's leftmost pair of minimum
rank, and ends when no word has a pair left. Decoding joins ids with ``vocab``
and puts the pieces together with an aggregate ordered by position.

In a word of more than ``LONG`` bytes a turn contracts every pair that is the
minimum among the ``reach`` pairs on either side, where ``reach`` is twice the
bytes of the longest piece that the word holds. Before its turn comes, no
contraction elsewhere can touch the pieces near such a pair, as a piece that
did would be longer than any; so the result is that of one contraction a
turn, in a number of turns that does not grow with the word. Of equal minima
the leftmost goes first; where the merged piece is part of no piece of lower
rank in the word (``safe``) nothing comes between them, and every other pair of
an unbroken run of them goes at once. Long words are first cut between bytes
that stand together in no piece.

Words already encoded are kept by 64-bit hash, ``KEPT_WORDS`` at most, so a
worker's memory does not grow with its rows. A query's turns are cut into runs
whose rows are bounded, whatever a word's length.

Defined cases: a null or empty text has no ids and decodes to no bytes; null
ids decode to null; an id outside the vocabulary is an error; very long texts
are cut in front of white space, where every match ends, and encoded and
decoded block by block; repeated rows and ties give equal ids; an empty table
gives an empty table; other columns, whatever their names, are not read.
"""

from __future__ import annotations

import base64
import functools
import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bytetext as B
from .common import ship

#: Characters cut and looked up together; a longer run without white space is alone.
BLOCK_CHARS = 1 << 20
#: Encoded words kept by a worker.
KEPT_WORDS = 1_000_000
#: Bytes of a word from which on several pairs are contracted in a turn.
LONG = 64
#: Rows that the turns of one recursive query may make.
TURN_ROWS = 4_000_000
#: Ids decoded by one query.
DECODE_IDS = 1 << 17
_U = np.uint64
_BASE = 0xA24BAED4963EE407 | 1

#: The pattern that :func:`cut` knows.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: A pair's key orders pairs by rank, then position, and says how many bytes the left piece has.
_PAIRS = """SELECT turn, w, p, tok, m, safe, (m::BIGINT << 40) | (p << 8) | (q - p) AS k
            FROM (SELECT turn, w, p, tok, lead(tok) OVER (ORDER BY p) AS nxt, lead(w) OVER (ORDER BY p) AS nw, lead(p) OVER (ORDER BY p) AS q
                  FROM t WHERE NOT done AND turn < {turns})
            LEFT JOIN {merges} ON l = tok AND r = nxt AND nw = w"""

#: Each word's leftmost pair of minimum rank.
_SHORT = f"""
    WITH RECURSIVE t AS (
        SELECT 0 AS turn, w, p, tok, false AS done FROM start
        UNION ALL
        (WITH pairs AS MATERIALIZED ({_PAIRS}),
              least AS (SELECT w, min(k) AS k FROM pairs GROUP BY w)
         SELECT turn + 1, w, p, CASE WHEN p = (least.k >> 8) & 4294967295 THEN (least.k >> 40)::INT ELSE tok END, least.k IS NULL
         FROM pairs JOIN least USING (w) WHERE least.k IS NULL OR p <> ((least.k >> 8) & 4294967295) + (least.k & 255)))
    SELECT w, p, tok, done FROM t WHERE done OR turn = {{turns}} ORDER BY p"""

#: Pairs of minimum rank within ``reach`` pairs: every other one of a run of equal ones, or the leftmost where the merged piece is not safe.
_WIDE = f"""
    WITH RECURSIVE t AS (
        SELECT 0 AS turn, w, p, tok, false AS done FROM start
        UNION ALL
        SELECT turn + 1, w, p, CASE WHEN hit THEN m ELSE tok END, least IS NULL
        FROM (SELECT *, lag(hit) OVER (PARTITION BY w ORDER BY p) AS eaten
              FROM (SELECT *, CASE WHEN k IS NULL THEN false
                                   WHEN safe THEN bool_and(near >> 40 = m) OVER (PARTITION BY w, run) AND row_number() OVER (PARTITION BY w, run ORDER BY p) % 2 = 1
                                   ELSE k = near END AS hit
                    FROM (SELECT *, min(k) OVER (PARTITION BY w ORDER BY p ROWS BETWEEN {{reach}} PRECEDING AND {{reach}} FOLLOWING) AS near,
                                 min(k) OVER (PARTITION BY w) AS least, sum(fresh::INT) OVER (PARTITION BY w ORDER BY p) AS run
                          FROM (SELECT *, m IS DISTINCT FROM lag(m) OVER (PARTITION BY w ORDER BY p) AS fresh FROM ({_PAIRS})))))
        WHERE eaten IS NOT TRUE)
    SELECT w, p, tok, done FROM t WHERE done OR turn = {{turns}} ORDER BY p"""

#: The bytes of each text's ids, one character below U+0100 a byte.
_DECODE = "SELECT w, string_agg(piece, '' ORDER BY p) AS s FROM coded JOIN vocab USING (tok) GROUP BY w ORDER BY w"


@functools.lru_cache(1)
def _classes() -> np.ndarray:
    """Code point -> 0 white space, 1 letter, 2 number, 3 other."""
    import regex

    out = np.full(0x110000, 3, np.uint8)
    every = "".join(map(chr, itertools.chain(range(0xD800), range(0xE000, 0x110000))))
    for code, kind in ((0, r"\s+"), (1, r"\p{L}+"), (2, r"\p{N}+")):
        for m in regex.finditer(kind, every):
            a, b = ord(m[0][0]), ord(m[0][-1])
            out[a:b + 1] = code
    out[0xD800:0xE000] = 3
    return out


def cut(cps: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Starts of the pattern's matches in the texts ``offsets`` cuts ``cps`` into, with the end of all."""
    n = len(cps)
    cls = _classes()[cps]
    border = np.zeros(n + 1, bool)
    border[offsets] = True
    border[0] = border[n] = True
    edge = border.copy()
    edge[1:-1] |= cls[1:] != cls[:-1]
    # white space before something else: the last space goes with what follows, any other last character is alone
    end = np.flatnonzero((cls[:-1] == 0) & (cls[1:] != 0)) + 1 if n else np.zeros(0, np.int64)
    end = end[~border[end]]
    edge[end - 1] = True
    edge[end] = cps[end - 1] != 32
    # an apostrophe alone, not behind a space, takes s, t, m, d, re, ve or ll
    lone = np.flatnonzero(cps[:-1] == 39) if n else np.zeros(0, np.int64)
    lone = lone[(cls[lone + 1] == 1) & ~border[lone + 1]]
    before = np.maximum(lone - 1, 0)
    lone = lone[border[lone] | ((cls[before] != 3) & (cps[before] != 32))]
    if len(lone):
        one = cps[lone + 1]
        after = np.minimum(lone + 2, n - 1)
        two = np.where((lone + 2 < n) & ~border[np.minimum(lone + 2, n)], cps[after], 0)
        take = np.isin(one, [ord(c) for c in "stmd"]).astype(np.int64)
        pair = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
        take[pair] = 2
        lone, take = lone[take > 0], take[take > 0]
        edge[lone + 1] = False
        edge[lone + 1 + take] = True
    return np.flatnonzero(edge)


def blocks(text: str, limit: int = BLOCK_CHARS) -> list[str]:
    """``text`` in parts of about ``limit`` characters, cut in front of white space behind another character."""
    if len(text) <= limit:
        return [text]
    out, at = [], 0
    while len(text) - at > limit:
        to = at + limit
        while to < len(text) and not (text[to].isspace() and not text[to - 1].isspace()):
            to += 1
        out.append(text[at:to])
        at = to
    return [*out, text[at:]] if at < len(text) else out


class Coder:
    """The tables of a rank file in a connection of this process, and the words encoded so far."""

    def __init__(self, path: str):
        import duckdb

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.byte = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self.size = max(ranks.values()) + 1
        self.pieces, self.tokens = list(ranks), list(ranks.values())
        sizes = [len(s) for s in self.pieces]
        raw, piece = np.frombuffer(b"".join(self.pieces), np.uint8), np.repeat(np.arange(len(sizes)), sizes)
        #: which bytes a piece holds, and which bytes stand together in some piece
        self.holds = np.zeros((len(sizes), 256), bool)
        self.holds[piece, raw] = True
        self.joins = np.zeros((256, 256), bool)
        inner = np.flatnonzero(piece[1:] == piece[:-1])
        self.joins[raw[inner], raw[inner + 1]] = True
        self.con = duckdb.connect(":memory:", config={"threads": 1, "temp_directory": ""})
        rows = ((ranks[s[:i]], ranks[s[i:]], r) for s, r in ranks.items() for i in range(1, len(s)) if s[:i] in ranks and s[i:] in ranks)
        left, right, both = zip(*rows)
        self._put("given", l=pa.array(left, pa.int32()), r=pa.array(right, pa.int32()), m=pa.array(both, pa.int32()))
        self.con.execute("CREATE TABLE merges AS SELECT l, r, m, false AS safe FROM given")
        self._put("given", tok=pa.array(list(ranks.values()), pa.int32()), piece=pa.array([s.decode("latin-1") for s in ranks]))
        self.con.execute("CREATE TABLE vocab AS SELECT * FROM given")
        self.con.unregister("given")
        self.forget()

    def _put(self, name: str, **columns) -> None:
        self.con.register(name, pa.table(columns))

    def forget(self) -> None:
        """Drop the kept words: sorted hashes, and where their ids are."""
        self.kept, self.first, self.count, self.flat = np.zeros(0, _U), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)

    def contract(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words one after the other, and how many each has."""
        parts, owner = [], []
        for i, word in enumerate(words):
            some = self._parts(word) if len(word) > LONG else [word]
            parts += some
            owner += [i] * len(some)
        sizes = np.array([len(w) for w in parts], np.int64)
        short = np.flatnonzero(sizes <= LONG)
        found = [self._turns(_SHORT, "merges", 0, [parts[i] for i in short], short)]
        for i in np.flatnonzero(sizes > LONG):
            found.append(self._turns(_WIDE, "present", self._present(parts[i]), [parts[i]], np.array([i])))
        w, p, tok = (np.concatenate(c) for c in zip(*found))
        order = np.lexsort((p, w))
        return tok[order], np.bincount(np.array(owner, np.int64)[w], minlength=len(words))

    def _parts(self, word: bytes) -> list[bytes]:
        """The word cut between bytes that stand together in no piece."""
        raw = np.frombuffer(word, np.uint8)
        at = (np.flatnonzero(~self.joins[raw[:-1], raw[1:]]) + 1).tolist()
        return [word[a:b] for a, b in zip([0, *at], [*at, len(word)])]

    def _present(self, word: bytes) -> int:
        """Put the merges of pieces that the word holds into the table ``present``; twice the bytes of the longest."""
        used = np.zeros(256, bool)
        used[np.frombuffer(word, np.uint8)] = True
        held = [i for i in np.flatnonzero(~self.holds[:, ~used].any(1)).tolist() if self.pieces[i] in word]
        self._put("held", tok=np.array([self.tokens[i] for i in held], np.int32))
        self.con.execute("""CREATE OR REPLACE TABLE present AS
            WITH g AS (SELECT l, r, m FROM merges WHERE m IN (SELECT tok FROM held)),
                 early AS (SELECT l AS tok FROM g WHERE m < l UNION SELECT r FROM g WHERE m < r)
            SELECT l, r, m, m NOT IN (SELECT tok FROM early) AS safe FROM g""")
        return 2 * max(len(self.pieces[i]) for i in held)

    def _turns(self, query: str, merges: str, reach: int, words: list[bytes], number: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(number of the word, position, id) of the words' ids."""
        sizes = [len(w) for w in words]
        raw = np.frombuffer(b"".join(words), np.uint8)
        w, p, tok = np.repeat(number.astype(np.int32), sizes), np.arange(len(raw), dtype=np.int64), self.byte[raw]
        ended = [(w[:0], p[:0], tok[:0])]
        while len(w):
            self._put("start", w=w, p=p, tok=tok)
            out = self.con.sql(query.format(turns=max(1, TURN_ROWS // len(w)), reach=reach, merges=merges)).to_arrow_table()
            done = out["done"].to_numpy()
            w, p, tok = (out[c].to_numpy() for c in ("w", "p", "tok"))
            ended.append((w[done], p[done], tok[done]))
            w, p, tok = w[~done], p[~done], tok[~done]
        return tuple(np.concatenate(c) for c in zip(*ended))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts one after the other, and each text's bounds."""
        whole = "".join(texts)
        cps = np.frombuffer(whole.encode("utf-32-le"), np.uint32)
        offsets = np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)
        if not len(cps):
            return np.zeros(0, np.int32), offsets
        at = cut(cps, offsets)
        starts, ends = at[:-1], at[1:]
        up, down = B.powers(_BASE, len(cps) + 1)
        total = np.zeros(len(cps) + 1, _U)
        np.cumsum(B.mix(cps.astype(_U) + _U(77)) * up[:len(cps)], out=total[1:])
        unique, pick, back = np.unique(B.mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(_U)), return_index=True, return_inverse=True)
        if len(self.kept) > KEPT_WORDS:
            self.forget()
        at = np.searchsorted(self.kept, unique)
        new = np.flatnonzero(self.kept[np.minimum(at, len(self.kept) - 1)] != unique) if len(self.kept) else np.arange(len(unique))
        if len(new):
            flat, count = self.contract([whole[a:b].encode() for a, b in zip(starts[pick[new]].tolist(), ends[pick[new]].tolist())])
            place = at[new]
            self.kept, self.count = np.insert(self.kept, place, unique[new]), np.insert(self.count, place, count)
            self.first = np.insert(self.first, place, len(self.flat) + np.cumsum(count) - count)
            self.flat = np.concatenate((self.flat, flat))
            at = np.searchsorted(self.kept, unique)
        per = self.count[at][back]
        begin = np.concatenate(([0], np.cumsum(per)))
        ids = self.flat[np.repeat(self.first[at][back] - begin[:-1], per) + np.arange(begin[-1])]
        return ids, begin[np.searchsorted(starts, offsets)]

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> list[bytes]:
        """Bytes of the ids of each text."""
        if len(ids) and (int(ids.max()) >= self.size or int(ids.min()) < 0):
            raise ValueError(f"an id is outside the vocabulary of {self.size}")
        out = [b""] * (len(bounds) - 1)
        text = np.repeat(np.arange(len(out), dtype=np.int32), np.diff(bounds))
        for i in range(0, len(ids), DECODE_IDS):  # a text that is cut here goes on in the next query
            part = ids[i:i + DECODE_IDS]
            self._put("coded", w=text[i:i + DECODE_IDS], p=np.arange(len(part), dtype=np.int32), tok=part.astype(np.int32))
            found = self.con.sql(_DECODE).to_arrow_table()
            for w, s in zip(found["w"].to_pylist(), found["s"].to_pylist()):
                out[w] = out[w] + s.encode("latin-1") if out[w] else s.encode("latin-1")
        return out


@functools.lru_cache(1)
def coder(path: str) -> Coder:
    """One connection and its tables for each Python worker."""
    return Coder(path)


def encode(docs: DataFrame, rank_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids): every text's ids, packed as little-endian unsigned 32-bit integers."""
    ship(docs.sparkSession)

    def run(batches):
        c = coder(rank_path)
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            sizes = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
            for i, j in B.slices(sizes, BLOCK_CHARS):
                found = [c.encode([part]) for part in blocks(texts[i])] if j - i == 1 else [c.encode(texts[i:j])]
                ids = np.concatenate([f[0] for f in found]).astype("<u4")
                bounds = found[0][1] if len(found) == 1 else np.array([0, len(ids)])
                packed = pa.Array.from_buffers(pa.large_binary(), j - i, [None, pa.py_buffer(bounds.astype(np.int64) * 4), pa.py_buffer(ids)])
                yield pa.RecordBatch.from_arrays([batch.column("id").slice(i, j - i), packed.cast(pa.binary())], names=["id", "ids"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"id {kind}, ids binary").withColumnRenamed("id", id_col)


def decode(coded: DataFrame, rank_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, ids, decoded): the bytes that packed ids stand for."""
    ship(coded.sparkSession)

    def run(batches):
        c = coder(rank_path)
        for batch in batches:
            column = batch.column("ids")
            parts = [np.zeros(0, "<u4") if not v.is_valid else np.frombuffer(v.as_buffer(), "<u4") for v in column]
            for i, j in B.slices(np.concatenate(([0], np.cumsum([len(p) for p in parts]))), BLOCK_CHARS):
                bounds = np.concatenate(([0], np.cumsum([len(p) for p in parts[i:j]]))).astype(np.int64)
                found = c.decode(np.concatenate(parts[i:j]).astype(np.int64), bounds)
                found = [None if not v.is_valid else f for v, f in zip(column[i:j], found)]
                yield pa.RecordBatch.from_arrays([batch.column("id").slice(i, j - i), column.slice(i, j - i), pa.array(found, pa.binary())], names=["id", "ids", "decoded"])

    kind = coded.schema[id_col].dataType.simpleString()
    rows = coded.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids"))
    return rows.mapInArrow(run, f"id {kind}, ids binary, decoded binary").withColumnsRenamed({"id": id_col, "ids": ids_col})
