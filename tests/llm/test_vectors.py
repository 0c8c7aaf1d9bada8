"""Byte-level BPE against the public library, hard negatives and whitening against plain versions."""

import base64
import hashlib
import math
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tabiya.llm import byte_bpe, hard_negatives, whitening

from .helpers import ROWS, awkward, empty

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


# ------------------------------------------------------------ byte-level BPE

@pytest.fixture(scope="module")
def library():
    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def same_ids(library, texts):
    c = byte_bpe.coder(RANKS)
    ids, bounds = c.encode(texts)
    for i, t in enumerate(texts):
        assert ids[bounds[i]:bounds[i + 1]].tolist() == library.encode_ordinary(t), t[:80]
    assert c.decode(ids.astype(np.int64), bounds) == [t.encode() for t in texts]


def test_the_pattern_is_the_public_one():
    assert byte_bpe.PATTERN == public_tokenizers.PATTERN


def test_ids_are_the_librarys(library):
    rng = random.Random(1)
    letters = list("abstvremld'  \n\t \x85\x1c\x0b\r09é中٣²½!?-_　퟿😀ßA")
    same_ids(library, ["".join(rng.choice(letters) for _ in range(rng.randrange(40))) for _ in range(4000)])
    same_ids(library, ["it's", "'s", "''s", " 's", "a 'll", "I'LL I'll x'vex y're z'd'd's", "", "   ", "a   b", "a \n b", "a\n\n", "\n's"])


def test_every_character_is_cut_like_the_library(library):
    some = [chr(x) for x in range(0x110000) if not 0xD800 <= x < 0xE000 and (x < 0x3200 or x % 37 == 0)]
    same_ids(library, ["".join(f"a{c}1{c} {c}" for c in some[i:i + 64]) for i in range(0, len(some), 64)])


def test_long_words_contract_like_short_ones(library):
    rng = random.Random(2)
    pick = lambda letters, n: "".join(rng.choice(letters) for _ in range(n))
    same_ids(library, ["a" * 3000, " " * 3000, "ab" * 1500, "-" * 2000 + "=", "=-" * 300 + "-" * 700, pick("etaoinshrdlu", 3000), pick("ab", 2000), pick("aab", 1000), pick("的一是不了在人有我他", 2000)])
    same_ids(library, [pick("ther", rng.randrange(60, 90)) for _ in range(40)])


def test_blocks_of_a_very_long_text_join_up(library):
    rng = random.Random(3)
    text = "".join(rng.choice([" a", "bc", "  ", "\n", "'s", "1"]) for _ in range(3000))
    parts = byte_bpe.blocks(text, 100)
    assert "".join(parts) == text and len(parts) > 10
    assert sum((library.encode_ordinary(p) for p in parts), []) == library.encode_ordinary(text)


def test_awkward_rows_are_encoded(spark, library):
    rows = byte_bpe.decode(byte_bpe.encode(awkward(spark), RANKS), RANKS).collect()
    want = sorted((str(r[0]), np.array(library.encode_ordinary(r[1] or ""), "<u4").tobytes(), (r[1] or "").encode()) for r in ROWS)
    assert sorted((str(r.doc_id), bytes(r.ids), bytes(r.decoded)) for r in rows) == want
    assert byte_bpe.decode(byte_bpe.encode(empty(spark), RANKS), RANKS).count() == 0
    nothing = spark.createDataFrame([(1, None)], "doc_id bigint, ids binary")
    assert byte_bpe.decode(nothing, RANKS).first().decoded is None


def test_unknown_ids_are_an_error():
    with pytest.raises(ValueError):
        byte_bpe.coder(RANKS).decode(np.array([60000]), np.array([0, 1]))


def test_query_digests(spark, library, tmp_path):
    from tabiya.llm.queries import op11_byte_bpe

    awkward(spark).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in op11_byte_bpe(spark, str(tmp_path)).collect())
    want = []
    for r in ROWS:
        ids = library.encode_ordinary(r[1] or "")
        want.append((str(r[0]), len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((r[1] or "").encode()).hexdigest()))
    assert got == sorted(want)


# ------------------------------------------------------------ vectors

SCHEMA = "vec_id bigint, embedding array<float>, label int, id string, x int, vector string, list int, place int"


def table(spark, rows):
    return spark.createDataFrame([(i, v, l, "q", 1, "w", 2, 3) for i, v, l in rows], SCHEMA)


def some_vectors(seed, n, d=8, labels=3, spread=6):
    """Few distinct values, so that scores tie; some rows cannot be used."""
    rng = random.Random(seed)
    rows = [(i, [rng.randrange(-spread, spread + 1) / 16 + rng.choice([0, 0.001]) for _ in range(d)], rng.randrange(labels)) for i in range(n)]
    bad = [(1000, None, 1), (1100, [1.0, None] * (d // 2), 1), (1200, [float("nan")] * d, 2), (1300, [float("inf")] + [0.0] * (d - 1), 0), (1400, [0.5] * d, None)]
    return rows + bad


def whole(rows, d):
    return [(i, [math.floor(256 * c) for c in v] + [0] * (d - len(v)), l) for i, v, l in rows
            if v is not None and all(c is not None and math.isfinite(c) for c in v)]


def test_residues_give_exact_products():
    rng = np.random.default_rng(0)
    for size, d in ((10, 5), (300, 64), (10 ** 6, 200), (2 ** 28, 70)):
        a, b = (rng.integers(-size, size, (7, d)) for _ in range(2))
        want = a.astype(object) @ b.T.astype(object)
        primes = hard_negatives.primes_for(size * size * d)
        got = hard_negatives.products(hard_negatives.residues(a, primes), hard_negatives.residues(b, primes), primes)
        assert (got == want.astype(np.int64)).all()
    assert hard_negatives.STRETCH * (max(hard_negatives.PRIMES) // 2) ** 2 < 2 ** 24


def plain_negatives(rows, d):
    x = [(i, v, l) for i, v, l in whole(rows, d) if l is not None]
    key = lambda r: (-r[0], r[1] is None, r[1] or 0)
    out = []
    for a, (i, v, l) in enumerate(x):
        if i is None or i % 100:
            continue
        score = lambda w: sum(p * q for p, q in zip(v, w))  # noqa: E731,B023
        same = sorted(((score(w), j) for b, (j, w, m) in enumerate(x) if b != a and m == l), key=key)[:5]
        other = sorted(((score(w), j) for j, w, m in x if m != l), key=key)
        for s, j in same:
            fit = [(t, k) for t, k in other if 80 * s <= 100 * t <= 100 * s][:5]
            out += [(i, j, n, k, s, t) for n, (t, k) in enumerate(fit, 1)]
    return sorted(out, key=str)


@pytest.mark.parametrize("chunk", [64 << 20, 3000])
def test_hard_negatives_are_the_plain_ones(spark, monkeypatch, chunk):
    monkeypatch.setattr(hard_negatives, "CHUNK_BYTES", chunk)
    monkeypatch.setattr(hard_negatives, "CELLS", 97)
    rows = some_vectors(4, 430)
    rows += [(200, rows[200][1], rows[200][2])] * 2 + [(300, rows[7][1], rows[300][2]), (None, rows[100][1], rows[100][2]), (None, rows[100][1], 1 + rows[100][2]), (900, [], 0), (910, [0.5], 1)]
    rows += [(2000 + k, rows[100][1], k % 2) for k in range(60)]  # one vector many times
    got = hard_negatives.mine(table(spark, rows).repartition(5), F.col("vec_id") % 100 == 0, F.col("label"))
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain_negatives(rows, 8)


def test_hard_negatives_of_nothing(spark):
    assert hard_negatives.mine(table(spark, []), F.col("vec_id") % 100 == 0, F.col("label")).count() == 0
    one = table(spark, [(100, [0.5, 0.5], 1), (3, [0.25, 0.5], 2), (None, None, None)])
    assert hard_negatives.mine(one, F.col("vec_id") % 100 == 0, F.col("label")).count() == 0


def test_characteristic_polynomial_is_exact(spark):
    rng = random.Random(5)
    for d, rank in ((1, 1), (2, 1), (5, 5), (7, 3)):
        m = [[rng.randrange(-10 ** 6, 10 ** 6) for _ in range(rank)] for _ in range(d)]
        g = [[sum(a * b for a, b in zip(u, v)) for v in m] for u in m]
        # Faddeev and Le Verrier, in whole numbers
        c, power = [1], [[0] * d for _ in range(d)]
        for k in range(1, d + 1):
            for i in range(d):
                power[i][i] += c[-1]
            power = [[sum(g[i][t] * power[t][j] for t in range(d)) for j in range(d)] for i in range(d)]
            c.append(-sum(power[i][i] for i in range(d)) // k)
        assert whitening.characteristic_polynomial(spark, g) == c[::-1]


def test_roots_are_counted_with_their_multiples():
    poly = [1]
    for root in (0, 0, 3, 7, 7, 10 ** 9):
        poly = [a - root * b for a, b in zip([0, *poly], [*poly, 0])]
    found = whitening.largest_roots(poly, 4)
    assert [(round(y / 2 ** bits, 9), m) for y, bits, m in found] == [(10 ** 9, 1), (7, 2), (3, 1)]


def plain_whitening(rows, d):
    x = whole(rows, d)
    unique = np.array(sorted({tuple(v) for _, v, _ in x}), float)
    n, s = len(unique), [sum(int(c) for c in col) for col in unique.T]
    values, vectors = np.linalg.eigh(np.cov(unique.T, bias=True))
    values, vectors = values[::-1], vectors[:, ::-1]
    out = {}
    for i, v, _ in x:
        deviation = sum((n * c - t) ** 2 for c, t in zip(v, s))
        w = np.abs((np.array(v) - unique.mean(0)) @ vectors[:, :4] / np.sqrt(values[:4]))
        out.setdefault(str(i), (n, deviation, w, values[:4] / values.sum()))
    return out


def test_whitening_is_the_plain_one(spark):
    rows = some_vectors(6, 300)
    rows += [(7, rows[7][1], 0), (None, rows[8][1], 1), (5000, rows[9][1], 2), (6000, [0.25], 1)]
    out = whitening.whiten(table(spark, rows).repartition(3)).collect()
    want = plain_whitening(rows, 8)
    assert len(out) == 4 * len(whole(rows, 8))
    for r in out:
        n, deviation, w, explained = want[str(r.vec_id)]
        assert (r.n, int(r.deviation)) == (n, deviation)
        assert abs(abs(r.whitened) - w[r.component - 1]) < 1e-9 and abs(r.explained / explained[r.component - 1] - 1) < 1e-9
        assert r.identity_error < 1e-9
    signs = {}
    for r in out:
        signs.setdefault((r.vec_id if r.vec_id != 7 else "twice", r.component), set()).add(round(r.whitened, 9))
    assert all(len(s) == 1 for s in signs.values())


def test_whitening_of_long_numbers_is_exact(spark):
    rng = random.Random(7)
    rows = [(i, [rng.randrange(-2 ** 44, 2 ** 44) / 256.0 for _ in range(3)], 0) for i in range(40)]
    given = spark.createDataFrame([(i, v) for i, v, _ in rows], "vec_id bigint, embedding array<double>")
    want = plain_whitening(rows, 3)
    for r in whitening.whiten(given).collect():
        n, deviation, w, _ = want[str(r.vec_id)]
        assert int(r.deviation) == deviation and abs(abs(r.whitened) - w[r.component - 1]) < 1e-7


def test_whitening_without_spread(spark):
    assert whitening.whiten(table(spark, [])).count() == 0
    assert whitening.whiten(table(spark, [(1, [0.5, 0.5], 0), (2, [0.5, 0.5], 1), (3, None, 1)])).count() == 0
    line = whitening.whiten(table(spark, [(1, [0.5, 0.5], 0), (2, [0.5, 1.5], 1), (3, [0.5, 1.0], 1)])).collect()
    assert sorted((r.vec_id, r.component, round(r.explained, 12)) for r in line) == [(1, 1, 1.0), (2, 1, 1.0), (3, 1, 1.0)]
    square = whitening.whiten(table(spark, [(1, [1.0, 0.0], 0), (2, [-1.0, 0.0], 0), (3, [0.0, 1.0], 0), (4, [0.0, -1.0], 0)])).collect()
    assert len(square) == 8 and all(abs(r.explained - 0.5) < 1e-12 and r.identity_error < 1e-12 for r in square)
