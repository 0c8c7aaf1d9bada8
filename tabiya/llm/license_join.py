"""Licence scan: phrases, and an exact set-similarity join with licence templates.

Only DataFrame functions. A block is a sentence of a paragraph, which goes on over
single line feeds up to a blank line; its tokens are the distinct words of the
block that some template has. What a single line of a block shares with a
template the block shares too, so lines need no blocks of their own. Tokens are put in one
global order, rarest in the corpus first. A template of ``|T|`` tokens asks
for ``a = ceil(threshold * |T|)`` of them, so a matching block must share a
token of the template's first ``|T| - a + 1`` with its own first
``|B| - a + 1`` (prefix filter), have at least ``a`` tokens (length filter),
and at the first shared token have enough tokens left on both sides
(positional filter). What passes is verified; nothing that reaches the
threshold is lost.

Defined cases: null and empty texts have no word and no label; repeated rows
are scanned each on its own; without templates only the phrases count; other
columns are ignored; an empty table gives an empty table; ties between templates
give all their labels. A very long text is scanned whole; without a blank
line or the end of a sentence it is one block, however long, and a template's words
may then stand anywhere in it.
"""

from __future__ import annotations

import math
import re
import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

# Phrases of the base scan and their labels.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

# Sentences of public licence notices and their labels.
TEMPLATES = [
    ("apache-2", "Licensed under the Apache License, Version 2.0"),
    ("apache-2", "you may not use this file except in compliance with the License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software"),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
]
THRESHOLD = 0.8
_WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: A block's end: a blank line, or the end of a sentence.
BORDER = r"\n[ \t-\r]*\n|[.!?;](?=[ \t-\r])"
#: Stands for a block's end while the gaps are closed. It is no word character, so no text's words hold it; where a
#: text has it between words, its neighbour takes its place.
_END = "\x01"
_INNER_GAP = r"[\x00\x02-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.translate(str.maketrans(string.ascii_uppercase, string.ascii_lowercase)))


def lowered(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)


def closed(low: Column) -> Column:
    """The words, one space between them."""
    return F.trim(F.regexp_replace(low, _GAP, " "))


def _spaces(x: Column) -> Column:
    return F.length(x) - F.length(F.replace(x, F.lit(" "), F.lit("")))


def _places(line: Column, n_words: Column, phrase: str) -> Column:
    """Number of places of a phrase, its smallest and largest start; ``line`` are words between single spaces, with one at either end."""
    first, *rest = phrase.split(" ")
    parts = F.split(line, f"(?<= ){first}(?= {''.join(w + ' ' for w in rest)})")
    n = F.size(parts) - 1
    return F.struct(n.cast("long").alias("n"), F.when(n > 0, (_spaces(parts[0]) - 1).cast("long")).alias("first"),
                    F.when(n > 0, n_words - _spaces(F.element_at(parts, -1))).cast("long").alias("last"))


def _prepared(docs: DataFrame, id_col: str, text_col: str, phrases: dict[str, str], tokens: list[str], least: int) -> DataFrame:
    """Per row the base columns, and the blocks that have ``least`` template tokens or more."""
    df = docs.select(F.monotonically_increasing_id().alias("row_id"), F.col(id_col).alias("id"), lowered(F.col(text_col).cast("string")).alias("low"))
    df = df.withColumn("line", F.concat(F.lit(" "), closed(F.col("low")), F.lit(" ")))
    df = df.withColumn("n_words", F.when(F.length("line") > 2, _spaces(F.col("line")) - 1).otherwise(0).cast("long"))
    # a phrase's places are counted only where the line has it
    for k, phrase in enumerate(phrases):
        none = F.struct(F.lit(0).cast("long").alias("n"), F.lit(None).cast("long").alias("first"), F.lit(None).cast("long").alias("last"))
        df = df.withColumn(f"p{k}", F.when(F.contains(F.col("line"), F.lit(f" {phrase} ")), _places(F.col("line"), F.col("n_words"), phrase)).otherwise(none))
    found = [F.col(f"p{k}") for k in range(len(phrases))]
    df = df.withColumn("found", F.array(*found)) if found else df.withColumn("found", F.array().cast("array<struct<n:bigint,first:bigint,last:bigint>>"))
    labels = F.array_compact(F.array(*[F.when(F.col(f"p{k}.n") > 0, F.lit(label)) for k, label in enumerate(phrases.values())])) if phrases else F.array().cast("array<string>")
    marked = F.regexp_replace(F.translate(F.col("low"), _END, "\x02"), BORDER, _END)
    blocks = F.split(F.regexp_replace(marked, _INNER_GAP, " "), _END) if tokens else F.array().cast("array<string>")
    known = F.array(*[F.lit(t) for t in tokens]) if tokens else F.array().cast("array<string>")
    df = df.withColumn("shared", F.filter(F.transform(blocks, lambda b: F.array_intersect(F.split(b, " "), known)), lambda s: F.size(s) >= least))
    return df.select("row_id", "id", "n_words", F.aggregate("found", F.lit(0).cast("long"), lambda a, x: a + x["n"]).alias("n_base"),
                     F.array_min(F.transform("found", lambda x: x["first"])).alias("first_word"), F.array_max(F.transform("found", lambda x: x["last"])).alias("last_word"),
                     F.array_sort(F.array_distinct(labels)).alias("base"), "shared")


def needed(size: int, threshold: float) -> int:
    """Tokens a template of ``size`` distinct tokens must share with a block."""
    return max(1, math.ceil(threshold * size - 1e-9))


def similar_blocks(blocks: DataFrame, templates: list[tuple[str, str]], threshold: float) -> DataFrame:
    """(block, template number, containment) of every pair at the threshold; ``blocks`` is a stored (block, tokens)."""
    spark = blocks.sparkSession
    sets = [sorted(set(words_of(text))) for _, text in templates]
    # document frequencies of the templates' tokens: as many rows as they have tokens
    counts = {r.token: r.n for r in blocks.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count("*").alias("n")).collect()}
    order = sorted({t for s in sets for t in s}, key=lambda t: (counts.get(t, 0), t))
    rank = {t: i for i, t in enumerate(order)}
    index = []
    for number, tokens in enumerate(sets):
        a, ranked = needed(len(tokens), threshold), sorted(tokens, key=rank.get)
        index += [(rank[t], number, i, len(ranked), a) for i, t in enumerate(ranked[:len(ranked) - a + 1])]
    prefixes = spark.createDataFrame(index, "rank int, template int, t_place int, t_size int, needs int")
    whole = spark.createDataFrame([(n, [rank[t] for t in s]) for n, s in enumerate(sets)], "template int, t_ranks array<int>")
    ranks = F.create_map(*[F.lit(x) for t, i in rank.items() for x in (t, i)])
    ordered = blocks.select("block", F.array_sort(F.transform("tokens", lambda t: ranks[t])).alias("ranks"))
    probes = ordered.select("block", "ranks", F.size("ranks").alias("size"), F.posexplode("ranks").alias("place", "rank"))
    # both sides of the broadcasts are as small as the templates
    near = probes.join(F.broadcast(prefixes), "rank").filter(
        (F.col("size") >= F.col("needs")) & (F.col("place") <= F.col("size") - F.col("needs"))
        & (1 + F.least(F.col("t_size") - F.col("t_place") - 1, F.col("size") - F.col("place") - 1) >= F.col("needs")))
    near = near.dropDuplicates(["block", "template"]).join(F.broadcast(whole), "template")
    shared = F.size(F.array_intersect("ranks", "t_ranks"))
    return near.filter(shared >= F.col("needs")).select("block", "template", (shared / F.col("t_size")).alias("containment"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", phrases: dict[str, str] = PHRASES,
         templates: list[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """Per row: id, n_words, n_base, first_word, last_word, base_labels, labels, score (largest containment, 0 without a match)."""
    spark = docs.sparkSession
    templates = [t for t in templates if words_of(t[1])]
    tokens = sorted({w for _, text in templates for w in words_of(text)})
    least = min((needed(len(set(words_of(text))), threshold) for _, text in templates), default=1)
    rows = stored(_prepared(docs, id_col, text_col, phrases, tokens, least), "licences")
    base = rows.select("row_id", "id", "n_words", "n_base", "first_word", "last_word", "base")
    if templates:
        blocks = rows.select("row_id", F.posexplode("shared").alias("n", "tokens")).select(F.struct("row_id", "n").alias("block"), "tokens")
        names = spark.createDataFrame([(n, label) for n, (label, _) in enumerate(templates)], "template int, label string")
        found = similar_blocks(blocks, templates, threshold).join(F.broadcast(names), "template")
        found = found.groupBy(F.col("block.row_id").alias("row_id")).agg(F.collect_set("label").alias("extra"), F.max("containment").alias("score"))
        base = base.join(found, "row_id", "left")
    else:
        base = base.withColumn("extra", F.lit(None).cast("array<string>")).withColumn("score", F.lit(None).cast("double"))
    every = F.array_sort(F.array_union("base", F.coalesce("extra", F.array().cast("array<string>"))))
    return base.select(F.col("id").alias(id_col), "n_words", "n_base", "first_word", "last_word", F.array_join("base", ",").alias("base_labels"),
                       F.array_join(every, ",").alias("labels"), F.coalesce("score", F.lit(0.0)).alias("score"))
