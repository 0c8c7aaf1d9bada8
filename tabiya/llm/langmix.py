"""Multilingual mixture inference for language identification.

Words are runs of letters; each learned language is a byte-trigram Markov
model, so every word has a likelihood under every language. For each document
expectation-maximisation finds the language proportions that maximise the
mixture likelihood of its words; the language set is the one with the best
penalised likelihood, and the prediction is the set's largest language.

Defined cases: a null text or one without a letter is ``und`` with score 0;
null languages and null ids are never learned from; without any labelled row
every document is ``und``; ties go to the first language in alphabetical
order; repeated rows count as often as they stand there; other columns are
ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bytetext as B
from .common import lean, ship

#: Strength of the back-off to the next lower order.
BACKOFF = 4.0
EM_ROUNDS = 8
#: Nats per language beyond the first, times the log of the number of words.
PENALTY = 3.0
#: Proportions below this are not tried as members of the language set.
LEAST_SHARE = 0.02
SPACE = 32


def _letters(tok: B.Tokens, pick: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Trigram keys (two bytes before, byte) of the picked words with an end sign, and each word's number of keys."""
    starts, sizes = tok.starts[pick], tok.ends[pick] - tok.starts[pick] + 1
    first = np.cumsum(sizes) - sizes
    inner = np.arange(int(sizes.sum()), dtype=np.int64) - np.repeat(first, sizes)
    at = np.repeat(starts, sizes) + inner
    last = inner == np.repeat(sizes - 1, sizes)
    size = len(tok.buf) - 1
    cur = np.where(last, SPACE, tok.buf[np.minimum(at, size)]).astype(np.int32)
    one = np.where(inner >= 1, tok.buf[np.maximum(at - 1, 0)], SPACE).astype(np.int32)
    two = np.where(inner >= 2, tok.buf[np.maximum(at - 2, 0)], SPACE).astype(np.int32)
    return (two << 16) | (one << 8) | cur, sizes


def _count(batches):
    """(lang, key, n) of this partition's labelled texts."""
    have: dict[str, tuple[np.ndarray, np.ndarray]] = {}
    for batch in batches:
        buf, offsets = B.buffers(batch.column("text"))
        names, code = np.unique(np.array(batch.column("lang").to_pylist(), dtype=object).astype(str), return_inverse=True)
        for i, j in B.slices(offsets):
            tok = B.tokens(buf[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], B.LETTER)
            if not len(tok.starts):
                continue
            group = code[i:j][tok.doc()].astype(np.uint64)
            h = B.mix(B.spans_hash(tok.buf, tok.starts, tok.ends) + group)
            _, pick, times = np.unique(h, return_index=True, return_counts=True)
            keys, sizes = _letters(tok, pick)
            wide = (np.repeat(group[pick].astype(np.int64), sizes) << 24) | keys
            found, back = np.unique(wide, return_inverse=True)
            n = np.bincount(back, np.repeat(times, sizes)).astype(np.int64)
            for g in np.unique(found >> 24):
                here = found >> 24 == g
                k, c = (found[here] & 0xFFFFFF), n[here]
                if (old := have.get(names[g])) is not None:
                    k, back = np.unique(np.concatenate((old[0], k)), return_inverse=True)
                    c = np.bincount(back, np.concatenate((old[1], c))).astype(np.int64)
                have[names[g]] = (k, c)
    for name, (k, c) in have.items():
        yield pa.RecordBatch.from_arrays([pa.array([name] * len(k)), pa.array(k, pa.int64()), pa.array(c, pa.int64())], names=["lang", "key", "n"])


class Model:
    """log p(byte | two bytes before) per language, with a back-off for the trigrams a language has not.

    Only the pairs that occur are held: a language has 155^3 trigrams at most, most have a small part of them.
    """

    def __init__(self, lang: np.ndarray, key: np.ndarray, n: np.ndarray):
        names, code = np.unique(lang.astype(str), return_inverse=True)
        self.langs = names.tolist()
        order = np.lexsort((code, key))
        code, key, n = code[order], key[order], n[order].astype(np.float64)
        self.keys, self.first = np.unique(key, return_index=True)
        self.first = np.append(self.first, len(key))
        self.contexts, of_context = np.unique(key >> 8, return_inverse=True)
        single, before = np.full((len(names), 256), 0.5), np.zeros((len(names), len(self.contexts)))
        np.add.at(single, (code, key & 255), n)
        np.add.at(before, (code, of_context), n)
        p1 = single / single.sum(1, keepdims=True)
        #: log p of a byte alone, times the back-off; log of a context's count and the back-off
        self.alone, self.before = np.log(BACKOFF * p1), np.log(before + BACKOFF)
        #: the trigrams no language has
        self.none = np.log(p1.min(1)).astype(np.float32)
        self.code = code.astype(np.int32)
        self.value = np.log((n + BACKOFF * p1[code, key & 255]) / (before[code, of_context] + BACKOFF)).astype(np.float32)

    def words(self, tok: B.Tokens) -> np.ndarray:
        """(tokens, languages) log likelihoods."""
        h = B.spans_hash(tok.buf, tok.starts, tok.ends)
        _, pick, back = np.unique(h, return_index=True, return_inverse=True)
        keys, sizes = _letters(tok, pick)
        keys, of_key = np.unique(keys, return_inverse=True)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        known = np.flatnonzero(self.keys[at] == keys)
        context, at = np.searchsorted(self.contexts, keys[known] >> 8), at[known]
        table = np.repeat(self.none[:, None], len(keys), 1)
        table[:, known] = self.alone[:, keys[known] & 255] - self.before[:, context]
        count = self.first[at + 1] - self.first[at]
        entry = np.repeat(self.first[at] - np.cumsum(count) + count, count) + np.arange(int(count.sum()))
        table[self.code[entry], np.repeat(known, count)] = self.value[entry]
        first = np.cumsum(sizes) - sizes
        return np.stack([np.add.reduceat(row[of_key], first) for row in table], 1)[back]


def _mixture(ll: np.ndarray, doc: np.ndarray, n_docs: int, allowed: np.ndarray, rounds: int = EM_ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Proportions (docs, languages) over the allowed languages, and the mixture log likelihood."""
    top = ll.max(1)
    like = np.exp(ll - top[:, None])
    starts = np.searchsorted(doc, np.arange(n_docs))
    count = np.maximum(np.diff(np.append(starts, len(doc))), 1)[:, None]
    share = allowed / np.maximum(allowed.sum(1, keepdims=True), 1)
    total = np.zeros(n_docs)
    for _ in range(rounds):
        w = like * share[doc]
        s = np.maximum(w.sum(1), 1e-300)
        w /= s[:, None]
        total = np.add.reduceat(top + np.log(s), starts)
        share = np.add.reduceat(w, starts, axis=0) / count
    return share, total


def infer(model: Model, tok: B.Tokens) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Language number (-1: none), its proportion, and proportions (texts, languages) of the chosen set."""
    n_all, n_lang = len(tok.first) - 1, len(model.langs)
    pred, score, shares = np.full(n_all, -1), np.zeros(n_all), np.zeros((n_all, n_lang))
    if not n_lang or not len(tok.starts):
        return pred, score, shares
    ll = model.words(tok).astype(np.float64)
    counts = np.diff(tok.first)
    have = np.flatnonzero(counts > 0)
    doc = np.repeat(np.arange(len(have)), counts[have])
    single = np.add.reduceat(ll, tok.first[have], axis=0)
    best = np.argmax(single, 1)
    value = single.max(1)
    share = np.zeros((len(have), n_lang))
    share[np.arange(len(have)), best] = 1.0
    if n_lang > 1:
        full, _ = _mixture(ll, doc, len(have), np.ones((len(have), n_lang)))
        order = np.argsort(-full, 1, kind="stable")
        for size in range(2, n_lang + 1):
            ranked = np.take_along_axis(full, order[:, size - 1:size], 1)[:, 0]
            rows = np.flatnonzero(ranked >= LEAST_SHARE)
            if not len(rows):
                break
            allowed = np.zeros((len(rows), n_lang))
            np.put_along_axis(allowed, order[rows, :size], 1.0, 1)
            inside = np.isin(doc, rows)
            part, total = _mixture(ll[inside], np.searchsorted(rows, doc[inside]), len(rows), allowed)
            total = total - PENALTY * (size - 1) * np.log(counts[have][rows] + 1.0)
            better = total > value[rows]
            value[rows[better]] = total[better]
            share[rows[better]] = part[better]
    pred[have], score[have], shares[have] = np.argmax(share, 1), share.max(1), share
    return pred, score, shares


def _has_letter(tok: B.Tokens, text: pa.Array, i: int) -> np.ndarray:
    """Whether each text has a letter: a-z, or else any alphabetic character."""
    n = len(tok.first) - 1
    ascii_letter = (tok.buf >= 97) & (tok.buf <= 122)
    at = np.concatenate(([0], np.cumsum(ascii_letter)))
    out = np.zeros(n, bool)
    for d in range(n):
        a, b = tok.first[d], tok.first[d + 1]
        if a < b:
            out[d] = at[tok.ends[b - 1]] > at[tok.starts[a]] or any(c.isalpha() for c in text[i + d].as_py())
    return out


def train(docs: DataFrame, lang_col: str = "lang", text_col: str = "text") -> Model:
    """A model from all labelled rows of ``docs``: counts are summed by Spark, one row per language and trigram comes to the driver."""
    ship(docs.sparkSession)
    rows = docs.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    counts = rows.select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang")) \
        .mapInArrow(lean(_count), "lang string, key bigint, n bigint") \
        .groupBy("lang", "key").agg(F.sum("n").alias("n"))
    found = counts.toArrow()
    return Model(found["lang"].to_numpy(), found["key"].to_numpy(), found["n"].to_numpy())


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: lang_pred, score (proportion of the predicted language), langs and shares of the chosen set."""
    spark = ship(docs.sparkSession)
    known = spark.sparkContext.broadcast(model)

    def predict(batches):
        for batch in batches:
            langs, scores, sets, shares = [], [], [], []
            for name, value, share in _predictions(known.value, batch.column("text")):
                langs.append(name)
                scores.append(value)
                members = [k for k in np.argsort(-share, kind="stable") if share[k] > 0] if name != "und" else []
                sets.append([known.value.langs[k] for k in members])
                shares.append([float(share[k]) for k in members])
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(sets, pa.list_(pa.string())), pa.array(shares, pa.list_(pa.float64()))], names=["id", "lang_pred", "score", "langs", "shares"])

    kind = docs.schema[id_col].dataType.simpleString()
    df = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return df.mapInArrow(lean(predict), f"id {kind}, lang_pred string, score double, langs array<string>, shares array<double>") \
        .withColumnRenamed("id", id_col)


def _predictions(model: Model, column: pa.Array):
    buf, offsets = B.buffers(column)
    for i, j in B.slices(offsets):
        tok = B.tokens(buf[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], B.LETTER)
        pred, score, shares = infer(model, tok)
        letters = _has_letter(tok, column, i)
        for d in range(j - i):
            known = letters[d] and pred[d] >= 0
            yield model.langs[pred[d]] if known else "und", float(min(score[d], 1.0)) if known else 0.0, shares[d]


def keep_identified(docs: DataFrame, model: Model, text_col: str = "text", least: float = 0.5) -> DataFrame:
    """Rows whose text has a language that makes up at least ``least`` of it; all columns are kept."""
    spark = ship(docs.sparkSession)
    known = spark.sparkContext.broadcast(model)

    def keep(batches):
        for batch in batches:
            mask = [name != "und" and score >= least for name, score, _ in _predictions(known.value, batch.column(text_col))]
            yield batch.filter(pa.array(mask, pa.bool_()))

    return docs.mapInArrow(lean(keep), docs.schema)
