"""Small document tables with the cases every operator must take."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession, functions as F

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Columns whose names operators use inside or return.
CLASHING = ["row_key", "kept", "score", "size", "words", "rep", "key", "content", "recipe", "start",
            "html", "v", "valid"]


def documents(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """Rows of (doc_id, text[, source[, lang]]) with further columns of clashing names."""
    full = [(r[0], r[1], r[3] if len(r) > 3 else "en", r[2] if len(r) > 2 else "s", 0) for r in rows]
    frame = spark.createDataFrame(full, SCHEMA)
    return frame.withColumns({c: F.lit("x") for c in CLASHING})


def sentence(rng: random.Random, n: int, words: int = 4000) -> str:
    return " ".join(f"w{rng.randrange(words)}" for _ in range(n))


def edge_rows(seed: int = 1) -> list[tuple]:
    """Nulls, empty and blank texts, one very long text, ties, repeated rows, null ids."""
    rng = random.Random(seed)
    base = sentence(rng, 120)
    long = sentence(rng, 60_000)
    return [
        (1, None, None), (2, "", "a"), (3, " \n\t ", "a"), (4, base, "b"), (5, base, "b"),
        (5, base, "b"), (6, base.replace(" ", "\n ", 3), None), (None, base, "a"), (None, None, None),
        (7, long, "a"), (8, long + " tail", "a"), (9, "one two", "c"), (10, "one two", "c"),
        (11, sentence(rng, 40) + " " + " ".join(base.split()[10:60]), "b"), (12, "é" * 30, "d"),
        (13, "x" * 200_000, "d"),
    ]
