"""Merkle fingerprints of documents: phrases, paragraphs, sections, root.

Only DataFrame functions. A text is cut into paragraphs at line feeds; a
paragraph's node is the SHA-256 of its text, and below it are the 64-bit
hashes of its phrases (runs of ``PHRASE`` words). A section ends after a
paragraph whose hash ends in the digit 0, so that a paragraph put in or taken
out moves no other section's border; a section's node is the SHA-256 of its
paragraphs' nodes, and the root that of the sections'. Equal roots mean equal
texts; otherwise sections, then paragraphs that the other tree has not locate
the edit, and the shared share of phrases tells how alike two texts are.

Defined cases: null is the empty text (one empty paragraph); all rows of one
id have the next larger id as their next document (of its rows the one with
the smallest sent characters, then root), the last id the smallest one;
a null id sorts first; a single row is its own next document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ship, stored

PHRASE = 8


def paragraphs(text: Column) -> Column:
    return F.split(text, "\n")


def _phrases(paragraph: Column, words: int) -> Column:
    found = F.regexp_extract_all(paragraph, F.lit(r"\s*+(?:\S++\s*+){1,%d}" % words), F.lit(0))
    return F.transform(F.when(F.size(found) > 0, found).otherwise(F.array(paragraph)), lambda x: F.xxhash64(x))


def with_tree(df: DataFrame, text_col: str, prefix: str, words: int = PHRASE) -> DataFrame:
    """``df`` with the levels of a text column's tree: ``<prefix>phrases``, ``paragraphs``, ``sections`` and ``root``."""
    p = prefix
    df = df.withColumn(p + "paragraphs", F.transform(paragraphs(F.col(text_col)), lambda x: F.sha2(x, 256)))
    df = df.withColumn(p + "phrases", F.flatten(F.transform(paragraphs(F.col(text_col)), lambda x: _phrases(x, words))))
    df = df.withColumn(p + "sections", F.transform(F.split(F.array_join(p + "paragraphs", " "), "(?<=0) "), lambda x: F.sha2(x, 256)))
    return df.withColumn(p + "root", F.sha2(F.array_join(p + "sections", " "), 256))


def likeness(a: str, b: str) -> Column:
    """1 for equal roots, else the shared share of the distinct phrases of the trees with prefixes ``a`` and ``b``."""
    mine, other = F.col(a + "phrases"), F.col(b + "phrases")
    return F.when(F.col(a + "root") == F.col(b + "root"), F.lit(1.0)).otherwise(
        F.size(F.array_intersect(mine, other)) / F.size(F.array_union(mine, other)))


def edited_paragraphs(a: str, b: str) -> Column:
    """Numbers (from 0) of the paragraphs of tree ``a`` that tree ``b`` has not; empty for equal roots.

    Only if a section differs are paragraphs looked at.
    """
    mine = F.col(a + "paragraphs")
    missing = F.array_except(mine, F.col(b + "paragraphs"))
    same = (F.col(a + "root") == F.col(b + "root")) | (F.size(F.array_except(a + "sections", b + "sections")) == 0)
    spots = F.filter(F.transform(mine, lambda x, i: F.when(F.array_contains(missing, x), i)), lambda i: i.isNotNull())
    return F.when(same, F.array().cast("array<int>")).otherwise(spots)


def first_edit(a: str, b: str) -> Column:
    """Number of the first paragraph at which the two trees part; null for equal roots."""
    mine, other = F.col(a + "paragraphs"), F.col(b + "paragraphs")
    both = F.transform(F.arrays_zip(mine.alias("x"), other.alias("y")), lambda z: z["x"].eqNullSafe(z["y"]))
    return F.when(F.col(a + "root") != F.col(b + "root"), F.array_position(both, False) - 1)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = PHRASE) -> DataFrame:
    """(id, root, sections, paragraphs, phrases) of every row."""
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return with_tree(rows, "text", "", words).select(F.col("id").alias(id_col), "root", "sections", "paragraphs", "phrases")


def next_ids(docs: DataFrame, id_col: str) -> DataFrame:
    """(id, next_id) of the distinct ids in ascending order, the last one's next being the first.

    Ids are dealt out by ranges; each range looks ahead inside itself, and only the ranges' first ids
    (one per task) meet in one window. The ranges are stored, so both steps see the same ones.
    """
    ids = docs.select(F.col(id_col).alias("id")).distinct().repartitionByRange(F.col("id").asc_nulls_first())
    ids = stored(ids.withColumn("part", F.spark_partition_id()), "ids")
    inside = Window.partitionBy("part").orderBy(F.col("id").asc_nulls_first())
    ids = ids.withColumn("n", F.row_number().over(inside)).withColumn("ahead", F.lead(F.struct("id")).over(inside))
    heads = ids.filter("n = 1").select("part", F.struct("id").alias("head"))
    across = Window.partitionBy(F.lit(0)).orderBy("part")
    first = F.first("head").over(across.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    heads = heads.select("part", F.coalesce(F.lead("head").over(across), first).alias("follow"))
    return ids.join(F.broadcast(heads), "part").select("id", F.coalesce("ahead", "follow").alias("next")).select("id", F.col("next.id").alias("next_id"))


def edited_by_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = PHRASE) -> DataFrame:
    """Trees of every text (no prefix), of its edited text (``edited_``) and of the next document's (``next_``).

    The edited text has its last floor(n_chars / 2) characters replaced by as many first ones (or all) of the
    next document. A document sends the one before it only the characters that edit needs, its root and phrases.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    half = F.floor(F.length("text") / 2).cast("int")
    # the longest half among the rows of an id is what they need of their next document
    needs = rows.select("id", half.alias("half")).groupBy("id").agg(F.max("half").alias("half"))
    order = next_ids(docs, id_col)
    wanted = order.join(needs.select(F.col("id").alias("i"), "half"), F.col("id").eqNullSafe(F.col("i"))).select(F.col("id").alias("for_id"), "next_id", "half")
    wanted = stored(wanted, "next")
    ahead = rows.join(wanted, rows["id"].eqNullSafe(wanted["next_id"])).select("for_id", "half", "text")
    ahead = with_tree(ahead, "text", "next_", words)
    # rows that share an id: the smallest start, then the smallest root, is their document's
    sent = F.struct(F.substring(F.col("text"), F.lit(1), F.col("half")).alias("start"), "next_root", "next_phrases")
    sent = ahead.select("for_id", sent.alias("s")).groupBy("for_id").agg(F.min("s").alias("s"))
    both = rows.join(sent, rows["id"].eqNullSafe(sent["for_id"])).select("id", "text", "s.*")
    both = both.withColumn("n_chars", F.length("text").cast("long")).withColumn("half", half)
    edited = F.concat(F.substring(F.col("text"), F.lit(1), F.col("n_chars").cast("int") - F.col("half")), F.substring(F.col("start"), F.lit(1), F.col("half")))
    both = both.withColumn("edited", edited).drop("start", "half")
    both = with_tree(with_tree(both, "text", "", words), "edited", "edited_", words)
    return both.withColumnRenamed("id", id_col)
