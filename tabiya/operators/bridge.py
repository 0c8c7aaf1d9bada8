"""Opening-term expansion and the opening -> resource bridge.

The containment join ``term in lower(text)`` is turned into an equi join: a
term can only occur in a text that has all the term's trigrams, so both sides
are keyed by trigram (text side: those that some term has, term side: its
rarest one), joined on it, and the candidates verified with ``instr``. The
result is exact, needs no broadcast of the catalogue and no nested loop.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..session import ensure_checkpoint_dir
from .common import unbroadcast

GRAM = 3


def synonym_terms(openings: DataFrame, variant: str = "pipeline", col: str = "opening") -> DataFrame:
    """Search terms of every distinct opening name: the lower-cased name
    plus the synonyms of every key that contains it or is contained in it,
    ordered distinct (name first, then keys and synonyms in table order).

    The synonym table is a fixed constant, so it is compiled into the
    expression: one conditional term array per key, flattened and exploded
    with its position (no join).
    """
    rows = X.synonym_dim_rows(variant)
    keys: dict[int, tuple[str, list[tuple[int, str]]]] = {}
    for ko, k, to, t in rows:
        keys.setdefault(ko, (k, []))[1].append((to, t))
    names = openings.select(F.col(col).alias("opening")).distinct().filter(F.col("opening").isNotNull())
    ap = F.lower(F.trim(F.col("opening")))

    def entry(ko, to, term):
        return F.struct(F.lit(ko).alias("key_order"), F.lit(to).alias("term_order"), term.alias("term"))
    parts = [F.array(entry(-1, 0, ap))]
    for ko, (k, terms) in sorted(keys.items()):
        hit = (F.instr(ap, F.lit(k)) > 0) | (F.instr(F.lit(k), ap) > 0)
        arr = F.array(*[entry(ko, to, F.lit(t)) for to, t in terms])
        parts.append(F.when(hit, arr).otherwise(F.filter(arr, lambda x: F.lit(False))))
    allt = names.select("opening", F.explode(F.flatten(F.array(*parts))).alias("e"))
    allt = allt.select("opening", F.col("e.term").alias("term"), F.col("e.key_order").alias("key_order"),
                       F.col("e.term_order").alias("term_order"))
    # ordered distinct: keep the earliest position of each term
    first = allt.groupBy("opening", "term").agg(F.min(F.struct("key_order", "term_order")).alias("pos"))
    return first.select("opening", "term", F.col("pos.key_order").alias("key_order"),
                        F.col("pos.term_order").alias("term_order"))


def _grams(text: F.Column, n: int) -> F.Column:
    """All substrings of ``n`` characters (none where the text is shorter)."""
    return F.when(F.length(text) >= n, F.transform(F.sequence(F.lit(1), F.length(text) - n + 1), lambda i: F.substring(text, i, F.lit(n)))).otherwise(
        F.array().cast("array<string>"))


def match_bridge(terms: DataFrame, resources: DataFrame, text_cols: list[str], word_terms: list[str] | None = None,
                 id_col: str = "resource_id") -> DataFrame:
    """J08 + T26: (opening, resource_id) pairs where some term of the opening
    occurs in lower(one of ``text_cols``). Terms listed in ``word_terms`` must
    match with non-letter boundaries (start-or-non-letter, term, non-letter-or-end).

    Only distinct texts are searched, under a number; grams carry the number,
    not the text. A term of three characters or more is looked up under the one
    of its trigrams that the fewest texts have, a shorter one under itself.
    """
    ensure_checkpoint_dir(resources.sparkSession)
    parts = [resources.select(id_col, F.lower(F.col(c)).alias("__t")).filter(F.col("__t").isNotNull()) for c in text_cols]
    rows = functools.reduce(DataFrame.unionByName, parts)
    # the numbers must be the same in every branch below
    texts = rows.select("__t").distinct().withColumn("__id", F.monotonically_increasing_id()).checkpoint(eager=True)
    tt = terms.select("term").distinct().filter(F.length("term") > 0).checkpoint(eager=True)
    short = [r[0] for r in tt.filter(F.length("term") < GRAM).select(F.length("term")).distinct().collect()]  # 1 and 2 at most
    every = F.flatten(F.array(*[_grams(F.col("__t"), n) for n in sorted({GRAM, *short})]))
    grams = texts.select("__id", F.explode(F.array_distinct(every)).alias("gram"))
    mine = tt.select("term", F.explode(F.when(F.length("term") < GRAM, F.array("term")).otherwise(_grams(F.col("term"), GRAM))).alias("gram")).distinct()
    wanted = mine.select("gram").distinct()
    grams = grams.join(wanted, "gram", "left_semi").checkpoint(eager=True)
    df = grams.groupBy("gram").agg(F.count(F.lit(1)).alias("df"))
    # a term with a gram that no text has cannot occur
    rare = mine.join(df, "gram", "left").groupBy("term").agg(F.min(F.struct(F.coalesce("df", F.lit(0)).alias("df"), F.col("gram"))).alias("g"))
    rare = rare.filter(F.col("g.df") > 0).select("term", F.col("g.gram").alias("gram"))
    cand = grams.join(rare, "gram").select("term", "__id").join(unbroadcast(texts), "__id")
    ok = F.instr(F.col("__t"), F.col("term")) > 0
    if word_terms:
        # the word terms are plain lower-case words, so they embed in the pattern as is
        bounded = F.regexp(F.col("__t"), F.concat(F.lit("(^|[^a-z])"), F.col("term"), F.lit("([^a-z]|$)")))
        ok = ok & (~F.col("term").isin(*word_terms) | bounded)
    hits = cand.filter(ok).select("term", "__t")
    return hits.join(unbroadcast(rows), "__t").join(terms.select("opening", "term").distinct(), "term").select("opening", id_col).distinct()


def rating_key(rating: F.Column) -> tuple[F.Column, F.Column]:
    """J07 key: a resource range with integer bounds contains ``r`` iff
    lo <= floor(r) and ceil(r) <= hi, so (floor, ceil) is an exact, bounded
    key for the range test (integer domain) and lets requests be deduplicated."""
    return F.floor(rating).cast("long"), F.ceil(rating).cast("long")
