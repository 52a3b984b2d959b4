"""Benchmark decontamination: size-partitioned MinHash containment search, verified exactly.

A short item inside a long document has a tiny Jaccard similarity with it, so the document is
cut into overlapping windows, of a width for each size class of items. Class ``s`` has the
items of more than ``s / 2`` and at most ``s`` shingles; its windows are three blocks of ``s / 2``
shingles, one block apart, so any stretch as long as an item lies in one window; even when a quarter
of the item is missing, their Jaccard similarity is above a fifth. Windows and items are compared by
the minima of ``MINIMA`` hash functions; block minima of a class are made of those of the class
below, so the hash functions run once over a text. One equal minimum makes a candidate, and each
candidate is decided by the share of the item's shingles in the whole document. An item with a
contiguous three quarters in a text is missed with a probability below 1e-6.

Items are the query set. They are searched in groups of a bounded number of shingles; a group is
sent to the executors, and the documents are read once for each: no shuffle of texts.

Words are lower-cased and without ASCII punctuation, so neither changes what is found.

Defined results: null and empty texts, of either table, match nothing. An item of one to four
words is one shingle and matches a document of exactly these words. Rows that repeat, of either
table, are searched and found each for itself, so repeated items give repeated pairs. Only the
named columns are read.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskmart.llm.words import ROW, alphanumeric, map_texts, shingle_hashes, with_row_id
from riskmart.sources.scratch import keep

MINIMA = 64
PERCENT = 75
GROUP_SHINGLES = 1_000_000
_CHUNK = 4096
_HIGHEST = np.uint32(0xFFFFFFFF)

_random = np.random.default_rng(6)
_FACTOR = (_random.integers(0, 2**32, MINIMA, dtype=np.uint32) | np.uint32(1))[:, None]
_SHIFT = _random.integers(0, 2**32, MINIMA, dtype=np.uint32)[:, None]
_SALT = _random.integers(0, 2**32, MINIMA, dtype=np.uint32)[:, None]


def text_shingles(text: str) -> np.ndarray:
    """The shingles of a text in order."""
    return shingle_hashes(alphanumeric(text.lower().encode()))


def block_minima(shingles: np.ndarray, width: int) -> np.ndarray:
    """For each hash function and each block of ``width`` shingles the least value."""
    folded = (shingles ^ (shingles >> np.uint64(32))).astype(np.uint32)
    out = np.empty((MINIMA, -(-len(folded) // width)), np.uint32)
    step = max(_CHUNK // width, 1) * width
    for start in range(0, len(folded), step):
        values = _FACTOR * folded[None, start : start + step]
        values += _SHIFT
        starts = np.arange(0, values.shape[1], width)
        out[:, start // width : start // width + len(starts)] = (
            np.minimum.reduceat(values, starts, axis=1) if width > 1 else values
        )
    return out


def halved(blocks: np.ndarray) -> np.ndarray:
    """Minima of blocks twice as wide."""
    if blocks.shape[1] % 2:
        blocks = np.concatenate([blocks, np.full((MINIMA, 1), _HIGHEST)], axis=1)
    return np.minimum(blocks[:, ::2], blocks[:, 1::2])


def windows(blocks: np.ndarray) -> np.ndarray:
    """Minima of three neighbouring blocks; of all, if there are no more."""
    if blocks.shape[1] <= 3:
        return blocks.min(axis=1, keepdims=True)
    return np.minimum(np.minimum(blocks[:, :-2], blocks[:, 1:-1]), blocks[:, 2:])


class SizeClass:
    """The minima of one class of items: a bit table first, then a sorted list."""

    def __init__(self, sketches: list[np.ndarray], numbers: list[int]):
        signs = np.stack(sketches, axis=1)
        # About one slot in 32 is taken, so few others pass, and a small table stays in the cache.
        self.mask = np.uint32((1 << (signs.size.bit_length() + 5)) - 1)
        self.bits = np.zeros(int(self.mask) + 1, bool)
        self.bits[self._slot(signs)] = True
        marked = (np.arange(MINIMA, dtype=np.uint64)[:, None] << np.uint64(32)) | signs
        order = np.argsort(marked, axis=None)
        self.values = marked.reshape(-1)[order]
        self.items = np.tile(np.array(numbers), MINIMA)[order]

    def _slot(self, signs: np.ndarray) -> np.ndarray:
        return (signs ^ _SALT) & self.mask

    def candidates(self, signs: np.ndarray) -> set[int]:
        function, place = np.nonzero(self.bits[self._slot(signs)])
        if not len(function):
            return set()
        marked = np.unique((function.astype(np.uint64) << np.uint64(32)) | signs[function, place])
        low, high = np.searchsorted(self.values, marked), np.searchsorted(self.values, marked, side="right")
        return {int(i) for a, b in zip(low, high, strict=True) for i in self.items[a:b]}


class Items:
    """A group of items, ready to be searched for in texts."""

    def __init__(self, keys: list, sets: list[np.ndarray]):
        self.keys, self.sets = keys, sets
        by_size: dict[int, list[int]] = {}
        for number, shingles in enumerate(sets):
            by_size.setdefault(max(1, math.ceil(math.log2(len(shingles)))), []).append(number)
        self.classes = {
            power: SizeClass([block_minima(sets[i], len(sets[i]))[:, 0] for i in numbers], numbers)
            for power, numbers in sorted(by_size.items())
        }

    def search(self, text: str, percent: int) -> list[tuple]:
        """Item key, its number of shingles, how many are in the text, the first word of them."""
        shingles = text_shingles(text)
        if not len(shingles) or not self.classes:
            return []
        power = min(self.classes)
        blocks = block_minima(shingles, 1 << (power - 1))
        found: set[int] = set()
        for wanted, items in self.classes.items():
            while power < wanted:
                blocks, power = halved(blocks), power + 1
            found |= items.candidates(windows(blocks))
        hits = []
        for number in sorted(found):
            own = self.sets[number]
            there = np.isin(shingles, own)
            common = len(np.unique(shingles[there]))
            if 100 * common >= percent * len(own):
                hits.append((self.keys[number], len(own), common, int(np.argmax(there))))
        return hits


def item_groups(items: DataFrame, key: str, text: str) -> list[tuple[DataFrame, int]]:
    """The items' shingle sets, and the number of groups whose size stays within the bound."""
    sets = keep(
        map_texts(items, "shingles array<long>", lambda: lambda t: (np.unique(text_shingles(t)).astype(np.int64),), [key], text)
        .where(F.size("shingles") > 0)
        .withColumn("spread", F.monotonically_increasing_id()),
        "items",
    )
    groups = 1
    while True:
        number = F.pmod(F.xxhash64("spread"), F.lit(groups))
        sizes = sets.groupBy(number.alias("g")).agg(F.sum(F.size("shingles")).alias("n"), F.count("*").alias("items"))
        worst = sizes.where("items > 1").agg(F.max("n")).first()[0] or 0
        if worst <= GROUP_SHINGLES:
            return [(sets.where(number == g), g) for g in range(groups)]
        groups *= 2


def find_items(
    docs: DataFrame,
    items: DataFrame,
    keys: list[str],
    item_key: str = "item_id",
    text: str = "text",
    item_text: str = "text",
    percent: int = PERCENT,
) -> DataFrame:
    """``keys`` of ``docs`` with ``item_key``, ``n_shingles``, ``matched`` and ``first_word`` of each find.

    A pair is a find if at least ``percent`` of the item's distinct shingles are in the document;
    ``first_word`` is where the first of them starts.
    """
    schema = T.StructType(
        [
            T.StructField(item_key, items.schema[item_key].dataType),
            T.StructField("n_shingles", T.LongType()),
            T.StructField("matched", T.LongType()),
            T.StructField("first_word", T.LongType()),
        ]
    )
    results = []
    for group, _ in item_groups(items.select(item_key, item_text), item_key, item_text):
        rows = group.select(item_key, "shingles").collect()  # bounded by GROUP_SHINGLES
        sets = [np.array(r["shingles"], np.int64).astype(np.uint64) for r in rows]
        sent = docs.sparkSession.sparkContext.broadcast(Items([r[item_key] for r in rows], [np.sort(s) for s in sets]))

        def start(sent=sent):
            return lambda t: sent.value.search(t, percent)

        results.append(map_texts(docs, schema, start, keys, text, many=True))
    found = results[0]
    for more in results[1:]:
        found = found.union(more)
    return found


def drop_contaminated(docs: DataFrame, items: DataFrame, key: str = "doc_id", **options) -> DataFrame:
    """``docs`` without the rows in which an item is found; all columns as they are."""
    rows, _ = with_row_id(docs, key)
    found = find_items(rows, items, [ROW], **options).select(ROW).distinct()
    return rows.join(keep(found, "contaminated"), ROW, "left_anti").select(*docs.columns)
