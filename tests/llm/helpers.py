"""Awkward rows that every operator must take, and plain reference versions."""

import random
import re

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOW))


def prose(seed, n, vocabulary=400):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary)}" if rng.random() < 0.9 else "Élan." for _ in range(n))


LONG = prose(99, 30_000, 5000)

#: doc_id, text, then columns whose names operators use themselves
ROWS = [
    (1, "The quick brown fox jumps over the lazy dog and runs far away into the dark wood.", "en", 1, "a"),
    (2, "", "en", 1, "b"),
    (3, None, None, None, None),
    (None, "A text without an id, but with words enough to be cut into five-word shingles.", "en", 1, "c"),
    (5, "same row twice, one two three four five six", "en", 1, "d"),
    (5, "same row twice, one two three four five six", "en", 1, "d"),
    (6, "\n\n  \t ", None, 2, "e"),
    (7, "1234 5678 !!! --- ***", "de", 2, "f"),
    (8, LONG, "en", 3, "g"),
    (9, "one", "en", 3, "h"),
    (10, "Ünïcode 日本語 😀 zéro​width", "fr", 3, "i"),
]
SCHEMA = "doc_id bigint, text string, lang string, row_id int, id string"


def awkward(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
