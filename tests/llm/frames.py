"""Small tables with the awkward rows every operator has to take."""

from __future__ import annotations

import random

CLASHES = "n_tokens string, score string, labels string, kept string, component_id string, text_hash string, value string, n string"
SCHEMA = f"doc_id long, text string, source string, lang string, {CLASHES}"
_EXTRA = ("x",) * 8


def documents(spark, texts, first=0):
    """One document for each text, with further columns whose names clash with inner ones."""
    rows = [(first + i, t, f"src{i % 3}", "en", *_EXTRA) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


def rows_as_given(spark, pairs):
    """Documents of (doc_id, text) pairs: ids may repeat or be null."""
    return spark.createDataFrame([(i, t, "src0", "en", *_EXTRA) for i, t in pairs], SCHEMA)


def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def sentence(generator: random.Random, n: int, words: int = 400) -> list[str]:
    return [f"w{generator.randrange(words)}" for _ in range(n)]
