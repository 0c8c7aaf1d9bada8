"""Sampled segmentations, attention scores, near-duplicate groups, and the pipeline."""

import collections
import itertools
import math
import random
import re
import time
import tracemalloc
import zlib

import corpus_pipeline
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tabiya.llm import attention_lm as A
from tabiya.llm import bagminhash, decontaminate, langmix
from tabiya.llm import bytetext as B
from tabiya.llm import spm_sampling as S
from tabiya.llm.common import lean
from tabiya.llm.queries import piece_model

from .helpers import LOW, ROWS, awkward, empty, prose, words

FIELD = re.compile(r"[^\x20\x09-\x0D]+")


# ------------------------------------------------------------ sampled segmentations

@pytest.fixture(scope="module")
def pieces():
    return S.Pieces(piece_model())


def all_paths(pieces, text):
    def cuts(s):
        if not s:
            yield []
        for n in range(1, min(len(s), pieces.longest) + 1):
            if s[:n] in pieces.id:
                for rest in cuts(s[n:]):
                    yield [s[:n], *rest]
    marked = S.SPACE + text.replace(" ", S.SPACE)
    out = {}
    for parts in itertools.product(*(list(cuts(c)) for c in S.CHUNK.findall(marked))):
        flat = sum(parts, [])
        out[tuple(pieces.id[p] for p in flat)] = sum(pieces.weight[p] for p in flat)
    z = np.logaddexp.reduce(list(out.values()))
    return {k: v - z for k, v in out.items()}


def test_samples_follow_the_lattice(pieces):
    paths, n = all_paths(pieces, "a cat"), 8000
    rows = S.sample_segmentations(pieces, ["a cat"] * n, B.mix(np.arange(n, dtype=np.uint64)), 3)
    pairs = collections.Counter((tuple(r[0][0]), tuple(r[1][0])) for r in rows)
    for (a, b), count in pairs.most_common(4):
        p, q = math.exp(paths[a]), math.exp(paths[b])
        want = p * q / (1 - p)
        assert abs(count / n - want) < 4 * math.sqrt(want / n)
    for r in rows[:500]:
        assert len({tuple(x[0]) for x in r}) == 3
        assert [x[2] for x in r] == sorted((x[2] for x in r), reverse=True)
        assert all(abs(x[1] - paths[tuple(x[0])]) < 1e-6 and x[3] <= 0 for x in r)
    # inclusion scores make sums unbiased: the total probability is estimated as 1
    assert abs(np.mean([sum(math.exp(x[1] - x[3]) for x in r) for r in rows]) - 1) < 0.02


def test_samples_run_dry_on_short_texts(pieces):
    paths = all_paths(pieces, "ab")
    rows = S.sample_segmentations(pieces, ["ab", ""], B.mix(np.arange(2, dtype=np.uint64)), 50)
    assert {tuple(x[0]) for x in rows[0]} == set(paths) and all(x[3] == 0 for x in rows[0])
    assert len(rows[1]) == 1 and len(rows[1][0][0]) == 0


def test_rows_sample_alike_in_any_batch(pieces):
    texts, keys = [prose(k, 60) for k in range(30)], B.mix(np.arange(30, dtype=np.uint64))
    whole = S.sample_segmentations(pieces, texts, keys, 3)
    for k in (0, 7, 29):
        for a, b in zip(whole[k], S.sample_segmentations(pieces, texts[k:k + 1], keys[k:k + 1], 3)[0]):
            assert a[0].tolist() == b[0].tolist() and a[1:] == b[1:]


def test_samples_do_not_depend_on_the_kept_chunks(pieces, monkeypatch):
    texts = [prose(seed, 60, 300) for seed in range(40)] + ["", "a  b", "Élan 日本"]
    keys = B.mix(np.arange(len(texts), dtype=np.uint64))
    want = S.sample_segmentations(pieces, texts, keys, 3)
    monkeypatch.setattr(S, "KEPT_EDGES", 2000)  # often full: what several batches share stays, or all goes
    for size in (4, 9):
        pieces.solved.forget()
        for i in range(0, len(texts), size):
            for got, old in zip(S.sample_segmentations(pieces, texts[i:i + size], keys[i:i + size], 3), want[i:i + size]):
                assert [(g[0].tolist(), round(g[1], 6)) for g in got] == [(o[0].tolist(), round(o[1], 6)) for o in old]
    pieces.solved.forget()


def test_encode_and_decode(spark):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=piece_model())
    got = S.encode_samples(awkward(spark), piece_model(), 2).collect()
    assert len(got) == sum(2 if (r[1] or "") else 1 for r in ROWS) and all(r.round_trip for r in got)
    for r in got:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        if r.doc_id is not None and r.doc_id != 5:
            assert library.decode(ids) == next(x[1] or "" for x in ROWS if x[0] == r.doc_id)
    back = S.decode_ids(S.encode_samples(awkward(spark), piece_model(), 1).filter("doc_id = 1"), piece_model()).first()
    assert back.decoded == ROWS[0][1]
    assert S.encode_samples(empty(spark), piece_model(), 2).count() == 0


# ------------------------------------------------------------ attention model

def test_gradient_of_the_attention_model():
    rng = np.random.default_rng(1)
    c = A.Classes(rng.integers(0, 1000, 5000), rng.random(5000) < 0.5)
    w = {k: v.astype(np.float64) for k, v in A.first_weights(c).items()}
    x, y, z = rng.integers(0, A.N_INPUTS, (2, A.WINDOW)), rng.integers(0, A.GROUPS, (2, A.WINDOW)), rng.integers(0, A.PLACES, (2, A.WINDOW))
    live = rng.random((2, A.WINDOW)) < 0.8
    live[0, 0] = True
    g = A.train_step(w, x, y, z, live)[1]
    for k in w:
        i = (x[0, 0], 3) if k == "e" else (0, 3) if k == "p" else (y[0, 0], *(s // 2 for s in w[k].shape[1:])) if k in ("cp", "bp") else tuple(s // 2 for s in w[k].shape)
        values = []
        for step in (1e-5, -1e-5):
            w[k][i] += step
            values.append(A.train_step(w, x, y, z, live)[0])
            w[k][i] -= step
        assert abs((values[0] - values[1]) / 2e-5 - g[k][i]) < 1e-6 + 1e-3 * abs(g[k][i])


def test_every_id_is_scored_once_with_its_context():
    rng = np.random.default_rng(2)
    c = A.Classes(rng.integers(0, 1000, 500), rng.random(500) < 0.5)
    w = A.first_weights(c)
    w = {k: v + rng.standard_normal(v.shape).astype(np.float32) * 0.05 for k, v in w.items()}
    sizes = [1, 5, 31, 32, 33, 48, 49, 200, 0]
    bounds = np.concatenate(([0], np.cumsum(sizes)))
    ids = rng.integers(0, 500, bounds[-1])
    got = A.score_texts(w, c, ids, bounds, chunk=3)
    for a, b, score in zip(bounds[:-1], bounds[1:], got):
        total = 0.0
        for t in range(a, b):  # one id at a time
            first = a if t < a + A.WINDOW else a + ((t - a - A.WINDOW) // A.STRIDE + 1) * A.STRIDE
            seen = np.array([[c.input[ids[k - 1]] if k > a else A.N_INPUTS - 1 for k in range(first, t + 1)]])
            y = np.full(seen.shape, c.group[ids[t]])
            z = np.full(seen.shape, c.place[ids[t]])
            total += float(A.target_log_probs(w, seen, y, z, seen.shape[1] - 1)[0, -1]) + float(c.share[ids[t]])
        assert abs(total - score) < 1e-2 + 1e-4 * abs(total)


def test_probabilities_sum_to_one():
    rng = np.random.default_rng(3)
    c = A.Classes(rng.integers(0, 50, 3000), rng.random(3000) < 0.5)
    w = A.first_weights(c)
    x = rng.integers(0, A.N_INPUTS, (1, 4))
    total = sum(math.exp(float(A.target_log_probs(w, x, np.full((1, 4), c.group[i]), np.full((1, 4), c.place[i]), 3)[0, 0]) + float(c.share[i])) for i in range(3000))
    assert abs(total - 1) < 1e-3


class CountingCoder:
    """A tokenizer that notes what it is asked to encode."""

    def __init__(self, coder):
        self.coder, self.asked = coder, []

    def encode_ordinary(self, text):
        self.asked.append(text)
        return self.coder.encode_ordinary(text)

    def encode_ordinary_batch(self, texts, num_threads=1):
        return [self.encode_ordinary(t) for t in texts]


def test_a_word_is_encoded_once_in_a_worker(monkeypatch):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    sub = A.Subwords(path)
    plain, sub.coder = sub.coder, CountingCoder(sub.coder)
    monkeypatch.setattr(A, "subwords", lambda _: sub)
    texts = [prose(1, 300), None, "", "Élan. élan. ÜBER 日本語 a\u00a0b \x00 ***", prose(2, 300)]
    heavy = type("Sent", (), {"value": (np.zeros(0, np.int64), np.zeros(0))})

    def batch(texts):
        n = range(len(texts))
        return pa.RecordBatch.from_arrays([pa.array(n), pa.array(n), pa.array([True] * len(texts)), pa.array(texts, pa.string())], names=["row_id", "id", "fold", "text"])

    def found(texts, times):
        return [np.frombuffer(v, "<u2").tolist() for b in A._read_words(path, heavy, 1.0)(iter([batch(texts)] * times)) for v in b.column("ids").to_pylist()]

    low = [FIELD.findall((t or "").translate(LOW)) for t in texts]
    want = [[i for w in t for i in plain.encode_ordinary(" " + w)] + [sub.end] for t in low]
    assert found(texts, 3) == want * 3
    assert sorted(sub.coder.asked) == sorted({" " + w for t in low for w in t})
    # what is kept is bounded, and the ids stay the same
    monkeypatch.setattr(A, "KEPT_WORDS", 5, raising=False)
    assert found(texts[:1], 1) + found(texts[4:], 1) + found(texts[3:4], 1) == [want[0], want[4], want[3]]
    assert len(sub.kept) == len(set(low[3]))


def test_training_takes_every_window_once_over_the_rounds(monkeypatch):
    rng = np.random.default_rng(4)
    c = A.Classes(rng.integers(0, 1000, 500), rng.random(500) < 0.5)
    w = A.first_weights(c)
    sizes = [1, 32, 33, 700, 5000, 2]
    texts = [rng.integers(0, 500, n).astype("<u2") for n in sizes]
    batch = pa.RecordBatch.from_arrays([pa.array(range(100, 108)), pa.array([b"", b""] + [t.tobytes() for t in texts], pa.binary())], names=["row_id", "ids"]).slice(2)
    flat, bounds = np.concatenate(texts).astype(np.int64), np.concatenate(([0], np.cumsum(sizes)))
    want = collections.Counter(tuple(r) for r in A._window_arrays(c, flat, bounds, *A.windows(bounds))[0].tolist())
    taken, steps = collections.Counter(), []
    real = A.train_step

    def step(w, *arrays, **out):
        taken.update(tuple(r) for r in arrays[0].tolist())
        steps.append(len(arrays[0]))
        return real(w, *arrays, **out)

    monkeypatch.setattr(A, "train_step", step)
    monkeypatch.setattr(A, "TaskContext", type("T", (), {"get": staticmethod(lambda: type("C", (), {"partitionId": lambda self: 0})())}))
    sent = lambda v: type("Sent", (), {"value": v})
    seen = [next(A._trainer(sent(w), sent(c), turn)(iter([batch]))).column("seen")[0].as_py() for turn in range(A.ROUNDS)]
    assert taken == want and sum(seen) == sum(want.values()) and max(steps) <= A.BATCH


def test_adam_is_the_plain_rule():
    rng = np.random.default_rng(5)
    c = A.Classes(rng.integers(0, 1000, 500), rng.random(500) < 0.5)
    adam = A.Adam(A.first_weights(c))
    w = {k: v.copy() for k, v in adam.w.items()}
    mean, square = {k: np.zeros_like(v) for k, v in w.items()}, {k: np.zeros_like(v) for k, v in w.items()}
    for n in range(1, 6):
        arrays = rng.integers(0, A.N_INPUTS, (8, A.WINDOW)), rng.integers(0, A.GROUPS, (8, A.WINDOW)), rng.integers(0, A.PLACES, (8, A.WINDOW)), rng.random((8, A.WINDOW)) < 0.9
        g = A.train_step(adam.w, *arrays)[1]
        adam.learn(arrays, 1e-2)
        for k in w:
            mean[k] += 0.1 * (g[k] - mean[k])
            square[k] += 0.01 * (g[k] * g[k] - square[k])
            w[k] -= 1e-2 * n / 20 / (1 - 0.9 ** n) * mean[k] / (np.sqrt(square[k] / (1 - 0.99 ** n)) + 1e-8)
            assert np.abs(w[k] - adam.w[k]).max() < 1e-4


def test_probabilities_of_very_low_and_very_high_logits():
    for shift in (-500, 0, 500):
        logits = np.linspace(-3, 3, 64, dtype=np.float32)[None].repeat(2, 0) + np.float32(shift)
        got = A._log_prob(logits, np.array([0, 63]))
        assert np.allclose(got, [logits[0, 0] - logits[0, 63] + got[1], got[1]], atol=1e-3)
        assert abs(float(got[1]) - float(3 - np.log(np.exp(np.linspace(-3, 3, 64)).sum()))) < 1e-3


def test_scores_of_awkward_and_empty_tables(spark):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    learn = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 != 0
    got = A.score(awkward(spark), learn, path).collect()
    train = [r for r in ROWS if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 10]
    counts = collections.Counter()
    for r in train:
        counts.update(FIELD.findall((r[1] or "").translate(LOW)) + [None])
    n, v = sum(counts.values()), len(counts)
    for r in got:
        text = next(x[1] for x in ROWS if x[0] == r.doc_id)
        w = FIELD.findall((text or "").translate(LOW)) + [None]
        assert r.n_tokens == len(w) and r.train_tokens == n and r.n_known == sum(counts[x] > 0 for x in w)
        assert abs(r.base_score - sum(math.log10((counts[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w)) < 1e-6
        assert r.score < 0
    assert A.score(empty(spark), learn, path).count() == 0
    none = A.score(awkward(spark), F.lit(False), path).collect()
    assert len(none) == len(ROWS) and all(r.train_tokens == 0 and r.n_known == 0 for r in none)


# ------------------------------------------------------------ near duplicates

def shingle_bag(text):
    w = words(text)
    return collections.Counter([tuple(w)] if 0 < len(w) < 5 else [tuple(w[i:i + 5]) for i in range(len(w) - 4)])


def jaccard(a, b):
    both = sum((a & b).values())
    return both / (sum((a | b).values()) or 1)


def plain_groups(rows):
    """Groups by comparing all pairs; a row without words equals only the same text."""
    bags = [shingle_bag(t) for _, t in rows]
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            same = jaccard(bags[i], bags[j]) >= 0.8 if bags[i] and bags[j] else not bags[i] and not bags[j] and (rows[i][1] or "") == (rows[j][1] or "")
            if same:
                up[max(root(i), root(j))] = min(root(i), root(j))
    out = collections.defaultdict(list)
    for i in range(len(rows)):
        out[root(i)].append(rows[i][0])
    return sorted(sorted(v, key=str) for v in out.values())


def edited(text, rng, share):
    return " ".join(f"x{rng.randrange(10**6)}" if rng.random() < share else w for w in text.split())


def test_groups_equal_all_pairs(spark):
    rng = random.Random(4)
    rows, n = [], 0
    for k in range(25):
        base = prose(k, rng.randrange(30, 200), 3000)
        for share in (0, 0, 0.005, 0.01, 0.02, 0.03, 0.05, 0.1)[:rng.randrange(1, 9)]:
            rows.append((n, edited(base, rng, share)))
            n += 1
    hub = prose(1000, 300, 3000)  # many edited copies of one text, most of them unlike each other
    for k in range(60):
        rows.append((n, edited(hub, rng, rng.choice((0.01, 0.02, 0.03, 0.05)))))
        n += 1
    rows += [(900 + k, t) for k, t in enumerate(["", None, "", "one two", "One, two!", "...", "...", "ab ab ab ab ab ab ab ab", "ab ab ab ab ab ab ab ab ab"])]
    got = bagminhash.duplicate_groups(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    groups = collections.defaultdict(list)
    for r in got:
        groups[r.group_id].append(r.doc_id)
        assert r.keep == (r.group_id == r.doc_id) and r.class_id <= r.doc_id
    assert sorted(sorted(v, key=str) for v in groups.values()) == plain_groups(rows)


def test_signatures_estimate_weighted_similarity():
    rng = random.Random(8)
    text = " ".join(rng.choice("abcdefgh") for _ in range(400))
    other = edited(text, rng, 0.02)
    got = []
    for k in range(40):  # other hashes by other letters
        a, b = (pa.array([t.translate({ord(c): f"{c}{k}" for c in "abcdefgh"})]) for t in (text, other))
        sign = []
        for column in (a, b):
            buf, off = B.buffers(column)
            doc, h, w = bagminhash.shingles(B.tokens(buf, off, B.WORD))
            sign.append(bagminhash.bag_minhash(doc, h, w, 1)[0])
        got.append((sign[0] == sign[1]).mean())
    want = jaccard(shingle_bag(text), shingle_bag(other))
    assert abs(np.mean(got) - want) < 4 * math.sqrt(want * (1 - want) / (40 * bagminhash.POSITIONS))
    assert abs(bagminhash.weighted_jaccard(pa.array([text]), pa.array([other]))[0] - want) < 1e-12


def test_heavy_weights_agree_like_their_ratio():
    h = np.array([123456789], np.uint64)
    hits = []
    for k in range(60):
        one = [bagminhash.bag_minhash(np.zeros(1, np.int64), B.mix(h + np.uint64(k)), np.array([w]), 1)[0] for w in (37, 50)]
        hits.append((one[0] == one[1]).mean())
    assert abs(np.mean(hits) - 37 / 50) < 0.03


def test_groups_of_awkward_and_empty_tables(spark):
    got = bagminhash.duplicate_groups(awkward(spark)).collect()
    assert len(got) == len(ROWS) and sum(r.keep for r in got) == len(ROWS) - 2  # the repeated row, and null beside empty
    kept = bagminhash.drop_duplicates(awkward(spark).withColumn("_row", F.lit(7)))
    assert kept.columns == [*awkward(spark).columns, "_row"] and kept.count() == len(ROWS) - 2 and kept.filter("_row = 7").count() == len(ROWS) - 2
    assert bagminhash.duplicate_groups(empty(spark)).count() == 0


def test_components_of_chains(spark):
    links = [(k, k + 1) for k in range(30)] + [(100, 105), (103, 105), (103, 110)]
    got = {r.node: r.component for r in bagminhash.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert {got[k] for k in range(31)} == {0} and {got[k] for k in (100, 103, 105, 110)} == {100}


# ------------------------------------------------------------ pipeline

def test_pipeline_equals_plain_stages(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(120)
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    item = bench.first().text
    extra = [(5001, f"{prose(3, 10)} {item}", "en", "s", 1), (5002, "1234 !!", "en", "s", 1), (5003, None, None, None, None), (5004, docs.first().text, "en", "s", 1)]
    docs = docs.union(spark.createDataFrame(extra, docs.schema))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    bench.write.parquet(f"{tmp_path}/benchmark.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    rows = {r.doc_id: r for r in docs.collect()}
    model = corpus_pipeline.learned_languages(docs)
    found = {r.doc_id: r for r in langmix.identify(docs, model).collect()}
    left = [i for i in rows if found[i].lang_pred != "und" and found[i].score >= 0.5]
    left = [g[0] for g in (sorted(x) for x in plain_groups([(i, rows[i].text) for i in sorted(left)]))]
    items = [set(tuple(words(b.text)[k:k + 10]) for k in range(max(1, len(words(b.text)) - 9))) for b in bench.collect()]
    windows = set().union(*items)
    left = [i for i in left if not any(tuple(words(rows[i].text)[k:k + 10]) in windows for k in range(len(words(rows[i].text))))]
    assert {r.doc_id for r in got} == set(left) and 5001 not in left and 5002 not in left and len(left) > 60
    assert all(r.round_trip for r in got) and len(got) == 2 * len(left)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, str(tmp_path)).columns == docs.columns, name


def test_pipeline_of_awkward_and_empty_tables(spark, tmp_path):
    rows = [(r[0], r[1], r[2], "s", 1) for r in ROWS]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    for name, data in (("a", rows), ("b", [])):
        spark.createDataFrame(data, schema).write.parquet(f"{tmp_path}/{name}/documents.parquet")
        spark.createDataFrame([], "item_id bigint, text string").write.parquet(f"{tmp_path}/{name}/benchmark.parquet")
        got = corpus_pipeline.run(spark, f"{tmp_path}/{name}").collect()
        assert bool(got) == bool(data)
    assert decontaminate.WIDTH == 10


def test_rounds_take_every_window_once():
    draw = B.mix(np.arange(5000, dtype=np.uint64))
    taken = np.concatenate([A._of_round(draw, turn) for turn in range(A.ROUNDS)])
    assert sorted(taken.tolist()) == list(range(5000))


def test_major_group_does_not_depend_on_the_order_of_rows(spark):
    rows = [(t, c, True) for t in range(20) for c in range(5)]
    found = []
    for order in (rows, rows[::-1]):
        entries = spark.createDataFrame(order, "token bigint, c bigint, indexed boolean").coalesce(1)
        found.append(sorted(map(tuple, bagminhash._major_groups(entries).collect())))
    assert found[0] == found[1] == [(t, 4) for t in range(20)]


def test_bands_are_independent():
    bands = bagminhash._bands()
    assert len(np.unique(bands)) == bands.size  # a position in two bands would make them miss together
    assert (1 - bagminhash.THRESHOLD ** bands.shape[1]) ** len(bands) < 1 / 80_000


PLAIN = ["river", "stone", "garden", "window", "letter", "mountain", "evening", "paper", "market", "silver"]


def _peak_mb(run) -> float:
    run()  # tables that stay
    tracemalloc.start()
    run()
    peak = tracemalloc.get_traced_memory()[1] / 1e6
    tracemalloc.stop()
    return peak


def test_workers_hold_the_arrays_of_a_bounded_slice_of_text():
    """Shingles and signatures: a batch of 4 MB of short texts is worked off in slices."""
    rng = random.Random(3)
    texts = pa.array([" ".join(rng.choice(PLAIN) + str(rng.randrange(3000)) for _ in range(450)) for _ in range(1000)])
    assert texts.nbytes > 3 << 20
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(range(len(texts))), texts], names=["row_id", "id", "text"])
    assert _peak_mb(lambda: bagminhash.weighted_jaccard(texts, texts)) < 15
    assert _peak_mb(lambda: list(bagminhash._sign([batch]))) < 25


def test_sampler_holds_the_arrays_of_a_bounded_number_of_characters():
    rng = random.Random(4)
    text = " ".join(rng.choice(PLAIN) for _ in range(200))
    texts = [text] * (S.BATCH_CHARS // len(text))
    pieces = S.load(piece_model())
    assert _peak_mb(lambda: S.sample_segmentations(pieces, texts, np.arange(len(texts), dtype=np.uint64), 2)) < 60


def _anonymous_mb() -> float:
    with open("/proc/self/smaps_rollup") as f:
        return int(re.search(r"\nAnonymous:\s+(\d+)", f.read())[1]) / 1024


def test_a_task_hands_its_free_memory_back():
    pins = []

    def run(batches):
        for batch in batches:
            held = [np.ones(4000) for _ in range(6000)]
            pins.append(np.ones(4000))  # stands behind the others: the heap can't shrink from its end
            yield len(held)

    before = _anonymous_mb()
    assert list(run([1])) == [6000]
    idle = _anonymous_mb() - before
    assert list(lean(run)([1])) == [6000]
    assert idle > 100 and _anonymous_mb() - before < 40


def test_workers_keep_a_bounded_part_of_solved_chunks(spark):
    """Between tasks a worker holds at most half of KEPT_EDGES edges of solved chunks."""
    rng = random.Random(6)
    words_ = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(12)) for _ in range(150_000)]
    docs = spark.createDataFrame([(i, " ".join(words_[i * 1000:(i + 1) * 1000])) for i in range(150)], "doc_id bigint, text string").coalesce(1)
    path = piece_model()
    assert S.encode_samples(docs, path).filter("round_trip").count() == 300

    def held(batches):
        for _ in batches:
            time.sleep(0.5)  # so that every worker gets one
        yield pa.RecordBatch.from_arrays([pa.array([len(S.load(path, 1.0, 2.7).solved.chunks.size)])], names=["edges"])

    assert max(r.edges for r in spark.range(4).repartition(4).mapInArrow(held, "edges bigint").collect()) <= S.KEPT_EDGES // 2
