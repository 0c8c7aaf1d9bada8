"""Merkle fingerprints, token files, licences, WARC, decontamination, languages against plain versions."""

import hashlib
import html as html_lib
import io
import random
import re
import textwrap
import unicodedata
import zlib

import numpy as np
import pytest
from tabiya.llm import decontaminate, html_main, langmix, license_join, merkle, token_files, warc
from tabiya.llm import queries as Q

from .helpers import ROWS, awkward, empty, prose, words


# ------------------------------------------------------------ decontamination

def plain_hits(text, items):
    w, hit, found = words(text), set(), set()
    for name, item in items:
        b = words(item)
        n = min(10, len(b))
        for p in range(len(b) - n + 1 if n else 0):
            for i in range(len(w) - n + 1):
                if w[i:i + n] == b[p:p + n]:
                    hit.update(range(i, i + n))
                    found.add(str(name))
    return len(w), len(hit), sorted(found)


def test_contamination_equals_plain_scan(spark):
    items = [(1, prose(1, 25, 5000)), (2, "short item here"), (3, ""), (4, None), (12, "Short, ITEM -- here"), (5, prose(2, 10, 5000))]
    rows = [(k, " ".join([prose(10 + k, 30), (items[0][1] if k % 3 else "").upper(), prose(50 + k, 20), "short item here" if k % 2 else ""])) for k in range(12)]
    rows += [(r[0], r[1]) for r in ROWS[:-3]]
    docs, bench = spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    for block in (1 << 20, 60):  # one block, and several
        got = sorted(((r.doc_id is None, r.doc_id, r.n_words, r.n_hit, r["items"], r.items_sha256, r.contaminated) for r in decontaminate.find_contamination(docs, bench, block_bytes=block).collect()), key=str)
        want = []
        for i, t in rows:
            n, h, found = plain_hits(t, items)
            want.append((i is None, i, n, h, found, hashlib.sha256(",".join(found).encode()).hexdigest(), h > 0))
        assert got == sorted(want, key=str)
    kept = [r.doc_id for r in decontaminate.drop_contaminated(docs, bench).collect()]
    assert sorted(map(str, kept)) == sorted(str(i) for i, t in rows if not plain_hits(t, items)[1])
    cut = [r.text for r in decontaminate.remove_spans(docs, bench).collect() if r.doc_id == 1]
    assert not any(plain_hits(t, items)[1] for t in cut) and any(prose(11, 30) in t for t in cut)


def test_contamination_of_awkward_and_empty_tables(spark):
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert [r.contaminated for r in decontaminate.find_contamination(awkward(spark), none).collect()] == [False] * len(ROWS)
    assert decontaminate.find_contamination(empty(spark), none).count() == 0
    assert decontaminate.drop_contaminated(awkward(spark), none).columns == awkward(spark).columns


# ------------------------------------------------------------ languages

def test_language_mixture_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = {r.doc_id: r for r in Q.op10_language_mixture(spark, "/root/testdata/sf0.01").collect()}
    held = [r for r in docs.select("doc_id", "lang").collect() if found[r.doc_id].held_out]
    assert len(held) > 200
    assert sum(found[r.doc_id].lang_pred == r.lang for r in held) / len(held) > 0.98
    assert all(zlib.crc32(str(i).encode()) % 4 == 2 or not r.held_out for i, r in found.items())


def test_language_mixture_finds_both_parts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langmix.train(docs)
    text = {r.lang: r.text for r in docs.filter("n_chars between 2000 and 3000").collect()}
    mixed = spark.createDataFrame([(1, text["en"] + "\n" + text["de"][:1000]), (2, text["fr"])], "doc_id int, text string")
    got = {r.doc_id: r for r in langmix.identify(mixed, model).collect()}
    assert got[1].langs == ["en", "de"] and 0.5 < got[1].score < 0.9 and abs(sum(got[1].shares) - 1) < 1e-6
    assert got[2].langs == ["fr"] and got[2].score == 1.0


def test_languages_of_awkward_and_empty_tables(spark):
    model = langmix.train(awkward(spark))
    got = [(r.lang_pred, r.score) for r in langmix.identify(awkward(spark), model).collect()]
    assert [p for p, _ in got][1:3] == ["und", "und"] and got[6] == ("und", 0.0) and got[7] == ("und", 0.0)
    assert all(0 <= s <= 1 for _, s in got)
    nothing = langmix.train(empty(spark))
    assert {r.lang_pred for r in langmix.identify(awkward(spark), nothing).collect()} == {"und"}
    assert langmix.identify(empty(spark), model).count() == 0
    assert langmix.keep_identified(awkward(spark), model).columns == awkward(spark).columns


def test_hot_language_does_not_push_out_a_rare_one(spark):
    rng = np.random.default_rng(4)
    two, three = rng.integers(0xC0, 0x800, 700_000), rng.integers(0x3000, 0xD800, 700_000)
    noise = ["".join(map(chr, row)) for row in np.concatenate((two, three)).reshape(-1, 10).tolist()]
    hot = [(k % 70, " ".join(noise[k % 70::70]), "hot") for k in range(140)]  # every trigram twice at least
    rare = "sawubona mngane wami unjani namhlanje siyabonga kakhulu ngosizo lwakho"
    docs = spark.createDataFrame([*hot, (1000, rare, "rare")], "doc_id int, text string, lang string").repartition(4)
    model = langmix.train(docs)
    assert model.langs == ["hot", "rare"] and len(model.value) > 250_000
    asked = spark.createDataFrame([(1, "siyabonga mngane wami"), (2, noise[0] + " " + noise[-1])], "doc_id int, text string")
    assert {r.doc_id: r.lang_pred for r in langmix.identify(asked, model).collect()} == {1: "rare", 2: "hot"}


# ------------------------------------------------------------ Merkle trees

def test_edit_of_awkward_rows(spark):
    rows = [r for r in ROWS if r[0] is not None]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, row_id int, id string")
    got = merkle.edited_by_next(docs).select("doc_id", "n_chars", "text", "edited", "root", "edited_root", merkle.likeness("", "edited_").alias("a"), merkle.likeness("", "next_").alias("b")).collect()
    ids = sorted({r[0] for r in rows})
    text = {r[0]: r[1] or "" for r in rows}
    assert len(got) == len(rows)
    for r in got:
        after = text[ids[(ids.index(r.doc_id) + 1) % len(ids)]]
        half = r.n_chars // 2
        assert r.edited == text[r.doc_id][:r.n_chars - half] + after[:half]
        assert (r.root == r.edited_root) == (r.edited == text[r.doc_id])
        assert 0 <= r.a <= 1 and 0 <= r.b <= 1
    assert len({r.root for r in got}) == len({r.text for r in got})
    assert merkle.edited_by_next(empty(spark)).count() == 0
    one = merkle.edited_by_next(docs.limit(1)).select(merkle.likeness("", "next_").alias("b")).first()
    assert one.b == 1.0
    with_null = awkward(spark)
    assert merkle.edited_by_next(with_null).count() == len(ROWS)


def test_branches_locate_an_edit(spark):
    text = "\n".join(prose(k, 40) for k in range(60))
    other = text.replace(prose(31, 40), prose(31, 39) + " edited")
    df = spark.createDataFrame([(text, other)], "a string, b string")
    df = merkle.with_tree(merkle.with_tree(df, "a", "x_"), "b", "y_")
    r = df.select(merkle.edited_paragraphs("x_", "y_").alias("e"), merkle.first_edit("x_", "y_").alias("f"), merkle.likeness("x_", "y_").alias("l"), "x_sections", "y_sections").first()
    assert r.e == [31] and r.f == 31 and 0.95 < r.l < 1
    assert len(set(r.x_sections) ^ set(r.y_sections)) <= 4 < len(r.x_sections) * 2


# ------------------------------------------------------------ token files

def test_tokenizer_equals_library_on_odd_texts():
    import public_tokenizers

    tok = token_files.WordTokenizer(public_tokenizers.path("word_bpe_49k.json"))
    assert tok.fast
    rng = random.Random(3)
    letters = "'stmdrevl '!12 ab\n\tÉéœ×İʼ日́ſΣ_-"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(25))) for _ in range(1500)] + ["it's they'll 'sat ''s", "'", "", "'re'"]
    ids, bounds = tok.encode(texts)
    assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])] == tok.whole(texts)


def test_tokenizer_takes_added_tokens_as_the_library_does(spark):
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    tok = token_files.WordTokenizer(path)
    texts = ["one <|endoftext|> two", "<|startoftext|>", "a<|endoftext|>b<|endoftext|>", "One <|ENDOFTEXT|> two", "<| endoftext|>", "<|endoftext|", "plain", "one <|endoftext|> two 😀"]
    ids, bounds = tok.encode(texts)
    assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])] == tok.whole(texts)
    assert ids[bounds[0]:bounds[1]].tolist() == [637, 49407, 1237]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = sorted((r.doc_id, r.n_tokens, np.frombuffer(r.ids, "<u4").tolist()) for r in token_files.file_round_trip(docs, path, 2).collect())
    assert got == [(k, len(w) + 1, [*w, 2]) for k, w in enumerate(tok.whole(texts))]


@pytest.mark.parametrize("n", [0, 1, 3, 4, 5, 1000])
def test_block_round_trip(n):
    rng = np.random.default_rng(n)
    values = rng.integers(0, 2**32, n, dtype=np.uint64) >> rng.integers(0, 32, n, dtype=np.uint64)
    data = token_files.encode_block(values)
    assert (token_files.decode_block(data[8:], n) == values).all()
    assert len(data) == 8 + -(-n // 4) + sum(max(1, -(-int(v).bit_length() // 8)) for v in values)


def test_token_files_round_trip(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    got = token_files.file_round_trip(awkward(spark), path, 2).collect()
    want = sorted((r[0] is not None, r[0] or 0, library.encode(r[1] or "", add_special_tokens=False).ids + [2]) for r in ROWS)
    at, plain = 0, []
    for has, i, ids in want:
        plain.append((i if has else None, at, np.array(ids, "<u4").tobytes()))
        at += len(ids)
    assert sorted(((r.doc_id, r.start, bytes(r.ids)) for r in got), key=lambda r: r[1]) == plain
    assert token_files.file_round_trip(empty(spark), path, 2).count() == 0


# ------------------------------------------------------------ licences

def test_license_scan_equals_plain_scan(spark):
    rows = [(k, t) for k, t in enumerate([
        "Released under the MIT License. under the mit license", "Apache License, version 2", "cc by-nc", None, "", "x\nThis work is licensed under the GNU General Public License, version 3.\ny",
        "licensed under license version 2 apache 0 the", "licensed under the license", "word " * 5000 + "under the mit license", "Permission granted, free of charge, to any person obtaining copy of this software and associated documentation files hereby"])]
    docs = spark.createDataFrame(rows + rows[:1], "doc_id int, text string")
    for r in license_join.scan(docs).collect():
        text = rows[r.doc_id][1] or ""
        w = words(text)
        places = [(i, label) for p, label in license_join.PHRASES.items() for i in range(len(w)) if w[i:i + len(p.split())] == p.split()]
        assert (r.n_words, r.n_base, r.first_word, r.last_word) == (len(w), len(places), min((i for i, _ in places), default=None), max((i for i, _ in places), default=None))
        assert r.base_labels == ",".join(sorted({x for _, x in places}))
        best, labels = 0.0, {x for _, x in places}
        for block in re.split(r"\n[ \t-\r]*\n|[.!?;](?=[ \t-\r])", text):
            b = set(words(block))
            for label, t in license_join.TEMPLATES:
                t = set(words(t))
                if len(b & t) / len(t) >= license_join.THRESHOLD - 1e-9:
                    best, labels = max(best, len(b & t) / len(t)), labels | {label}
        assert r.labels == ",".join(sorted(labels)) and abs(r.score - best) < 1e-12
    assert license_join.scan(awkward(spark)).count() == len(ROWS)
    assert license_join.scan(empty(spark)).count() == 0
    assert license_join.scan(docs, templates=[], phrases={}).filter("score > 0 or n_base > 0").count() == 0


def test_license_notices_wrapped_over_lines(spark):
    mit = """MIT License

Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction"""
    bsd = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice"""
    gpl = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."""
    rows, want = [], []
    for label, notice in (("mit", mit), ("bsd", bsd), ("gpl", gpl)):
        for mark in ("", " * ", "# "):
            for end in ("\n", "\r\n"):
                lines = [mark + x for part in notice.split("\n") for x in (textwrap.wrap(part, 72) or [""])]
                rows.append((len(rows), f"Copyright 2020 A. Author{end}{end}" + end.join(lines)))
                want.append(label)
    # a blank line or a sentence's end between the halves: no notice
    half = textwrap.wrap(bsd.split("\n")[0], 72)
    rows += [(len(rows), "\n \n".join(half)), (len(rows) + 1, ".\n".join(half))]
    got = sorted((r.doc_id, r.labels, r.score) for r in license_join.scan(spark.createDataFrame(rows, "doc_id int, text string")).collect())
    assert [x for _, x, _ in got] == [*want, "", ""] and all(s == 1.0 for _, x, s in got if x)


def test_similarity_join_is_exact(spark):
    rng = random.Random(5)
    vocabulary = [f"t{k}" for k in range(25)]
    templates = [(f"l{k}", " ".join(rng.sample(vocabulary, rng.randrange(4, 10)))) for k in range(8)]
    blocks = [sorted(rng.sample(vocabulary, rng.randrange(1, 14))) for _ in range(300)]
    for threshold in (0.5, 0.8, 1.0):
        df = spark.createDataFrame(list(enumerate(blocks)), "block int, tokens array<string>")
        got = {(r.block, r.template): r.containment for r in license_join.similar_blocks(df, templates, threshold).collect()}
        want = {(i, j): len(set(b) & set(t.split())) / len(t.split()) for i, b in enumerate(blocks) for j, (_, t) in enumerate(templates)}
        assert got == {k: v for k, v in want.items() if v >= threshold - 1e-9}


# ------------------------------------------------------------ WARC

def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id bigint, url string, html string, digest string, file int")


def test_archives_round_trip(spark, tmp_path):
    big = "é" * 400_000 + prose(1, 50_000)
    rows = [(1, "http://a/\r\nx", "x" * 200, "d", 1), (2, "http://b/", "x" * 200, None, 2), (0, None, "x" * 200, None, 2), (0, None, "x" * 200, None, 2), (4, "u", "tiny", "d", 1), (5, "u", "tiny", "d", 1), (6, "u", None, "d", 1), (None, "u", "x" * 200, "d", 1), (8, "u", big, "d", 1)]
    rows += [(100 + k, "u", prose(k, 200), None, 0) for k in range(40)]
    df = pages(spark, rows).repartition(2)
    folder = f"file://{tmp_path}/w"
    manifest = warc.write_archives(df, folder, file_bytes=20_000)
    for step in (1_000, 7_777, 1 << 20):
        got = warc.read_archives(spark, folder, manifest, step).collect()
        assert len(got) == len(rows)
        by = {}
        for r in got:
            by.setdefault(r.page_id, []).append(r)
        for i, _, html, _, _ in rows:
            payload = (html or "").encode()
            for r in by[str(i) if i is not None else "null"]:
                assert r.payload_bytes == len(payload) and r.digest == hashlib.sha256(payload).hexdigest()
                same = html == "x" * 200
                assert (r.record_type, r.refers_to) == (("revisit", "0") if same and i != 0 else ("response", None))
                assert bytes(r.payload) == (b"" if r.record_type == "revisit" else payload)
    assert warc.archive_round_trip(pages(spark, [])).count() == 0


def test_ranges_own_members_once():
    data, starts = b"", []
    for k in range(30):
        starts.append(len(data))
        data += warc.record(str(k), "u", b"\x1f\x8b\x08" * k + prose(k, 30).encode(), "x", None)
    for step in (1, 13, 400, 10**6):
        seen = [at for a in range(0, len(data), step) for at, _ in warc.members(io.BytesIO(data), a, min(a + step, len(data)))]
        assert seen == starts


# ------------------------------------------------------------ main text

def test_main_text_of_given_pages(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: r.text for r in Q.op4_html_main(spark, "/root/testdata/sf0.01").collect()}
    good = 0
    for r in df.collect():
        inner = re.search(r"<article>(.*?)(?:</article>|$)", r.html, re.S)[1]
        lines = (" ".join(html_lib.unescape(re.sub("<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1|br)>", inner))
        good += got[r.page_id] == "\n".join(x for x in lines if x)
    assert good / len(got) > 0.98


def test_main_text_of_unseen_layouts(spark):
    texts = html_main.sample_paragraphs(spark.read.parquet("/root/testdata/sf0.01/pages.parquet"), "page_id", "html", 100)
    model, layouts = html_main.train(texts), html_main.Layouts(texts, seed=2024)
    good = 0
    for _ in range(100):
        page = html_main.parse(layouts.page())
        f, own, silent = html_main.features(page)
        state = html_main.decode(page, model.log_odds(f), own)
        for i in range(1, len(page.tag)):  # no contradiction between an element and its parent
            assert state[i] in html_main._MAY[int(state[page.parent[i]])]
        good += html_main.text_of(page, (state == html_main.KEPT) & ~silent) == html_main.text_of(page, (np.array(page.truth) == 1) & ~silent)
    assert good >= 90


def test_main_text_of_awkward_pages(spark):
    rows = [(1, "u", None), (2, "u", ""), (3, None, "<p>"), (4, "u", "plain text, no tags"), (5, "u", "<article><p>" + "long text. " * 20_000), (None, "u", "<b <p></nope>< <!-- x"), (7, "u", "<article><h1>T &amp;&#233;</h1><p>One  two\n three.<br>Four.<li>a<li>b<script>x<p></script><p>End, of the text here.")]
    got = {r.page_id: r for r in html_main.extract(spark.createDataFrame(rows + rows[:1], "page_id bigint, url string, html string"), training_pages=600).collect()}
    assert got[1].text == got[2].text == "" and got[1].n_chars == 0
    assert len(got[5].text) > 200_000 and got[5].n_chars == len(got[5].text)
    assert got[7].text == "T &é\nOne two three.\nFour.\na\nb\nEnd, of the text here."
    assert html_main.extract(spark.createDataFrame([], "page_id bigint, url string, html string"), training_pages=20).count() == 0
    assert unicodedata.normalize("NFC", got[7].text) == got[7].text


def test_hidden_elements_and_formulas_of_an_article_are_kept(spark):
    words = "The article goes on with a sentence of ordinary length, as articles do. "
    page = f"<html><body><nav class=menu><a href=/>Home</a><a href=/a>All</a></nav><article><h1>Title</h1><p>{words * 3}</p><p hidden>Hidden words. {words * 2}</p>" \
           f"<p style='display:none'>Undisplayed words. {words * 2}</p><p>It holds <math><mi>x</mi><mo>=</mo><mn>1</mn></math> and more. {words}</p></article></body></html>"
    source = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("page_id", "url", "html").limit(300)
    got = html_main.extract(source.unionByName(spark.createDataFrame([(-1, "u", page)], "page_id bigint, url string, html string")), training_pages=600).filter("page_id = -1").first().text
    assert "Hidden words." in got and "Undisplayed words." in got and "It holds x=1 and more." in got and "Home" not in got


def test_parsing_is_linear_in_the_depth_of_open_elements():
    import time

    for source in ("<div>" * 80_000, "<b>" * 40_000 + "<p>" * 40_000, "<ul>" + "<li><b>" * 40_000, "<p><td>" * 40_000):
        began = time.process_time()
        assert len(html_main.parse(source).tag) > 40_000
        assert time.process_time() - began < 4


def test_decoding_finds_the_best_of_all_consistent_choices():
    import itertools

    rng = np.random.default_rng(3)
    for _ in range(150):
        n = int(rng.integers(1, 8))
        parent = [-1] + [int(rng.integers(0, i)) for i in range(1, n)]
        page = html_main.Page(tag=["div"] * n, parent=parent)
        odds, own = rng.normal(0, 2, n), rng.integers(0, 60, n) * (rng.random(n) < 0.6)
        weight = 0.5 + np.minimum(np.log1p(own) / 3, 2)
        chance = 1 / (1 + np.exp(-odds))

        def worth(states):
            total = 0.0
            for i, s in enumerate(states):
                if i and s not in html_main._MAY[states[parent[i]]]:
                    return -np.inf
                total += weight[i] * np.log(chance[i] if s == html_main.KEPT else 1 - chance[i]) if s != html_main.OUTSIDE or own[i] else -0.05
                total -= html_main.CHANGE * (i > 0 and s != states[parent[i]])
            return total

        best = max(worth(c) for c in itertools.product((0, 1, 2), repeat=n) if c[0] != html_main.DROPPED)
        assert abs(worth([int(s) for s in html_main.decode(page, odds, own.astype(float))]) - best) < 1e-9


def test_no_character_of_a_text_cuts_its_blocks(spark):
    import duckdb
    import pyarrow as pa
    from tabiya.llm.queries import ORACLE

    grant = license_join.TEMPLATES[8][1]
    half = grant.index("software")
    rows = [(1, grant[:half] + "\ue000 " + grant[half:]), (2, grant[:half] + "\x01 " + grant[half:]), (3, grant[:half] + "\n" + grant[half:]),
            (4, grant[:half] + "\n \x0b\n" + grant[half:]), (5, grant[:half] + ".\n\n" + grant[half:]), (6, grant[:half] + ".\x01" + grant[half:]), (7, "\x01\x02"), (8, "\ue000")]
    got = {r.doc_id: (r.n_words, r.labels, r.score) for r in license_join.scan(spark.createDataFrame(rows, "doc_id int, text string")).collect()}
    size = len(words(grant))
    assert [got[i] for i in (2, 3, 6)] == [(size, "mit", 1.0)] * 3 and got[1] == (size + 1, "mit", 1.0)
    assert [got[i][1] for i in (4, 5, 7, 8)] == [""] * 4 and (got[7][0], got[8][0]) == (0, 1)
    con = duckdb.connect()
    con.register("documents", pa.table({"doc_id": [r[0] for r in rows], "text": [r[1] for r in rows]}))
    want = {r[0]: (r[1], r[6], r[7]) for r in con.sql(ORACLE["op6_license_scan"]).fetchall()}
    assert got == want
