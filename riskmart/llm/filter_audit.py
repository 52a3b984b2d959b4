"""Filter interaction audit: what every order of five filters removes, from wide packed counters.

A document's failures are a mask of five bits. Which documents each step of each order removes is
a function of that mask alone, so a mask stands for one big integer: a field of 64 bits for every
(measure, order, step) holds the outcome, 0 or 1. The integers of a part's documents are added up, and the
sum holds all counts of the part side by side. A field never overflows into the next: it counts
documents, and a part has fewer than 2**63.

Spark counts the documents of each (part, mask, good, toxic) first, combined before the shuffle, so what
is added for a part is at most 128 integers times their numbers, whatever its size.

Copies are found by the SHA-256 of whole texts: the least id of each repeated text is combined
before the shuffle, and documents learn it by a plain join, which adaptive execution can split where a
third of all rows share one text.

Defined results: a null text counts as empty; a null or empty part is the empty string. A row without an id
is never a copy of others and others are not copies of it; it has no labels. Rows that repeat an
id count each, and are no copies of each other. Repeated labels of an id count once, as 1 if any is 1. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskmart.sources.scratch import keep

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]
MEASURES = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"]
FIELD_BYTES = 8
_STEPS = len(ORDERS) * len(FILTERS)
_BLOCK_BITS = 8 * FIELD_BYTES * _STEPS

_WORDS = r"[\x20\x09-\x0D]+"
_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def failures(text: Column) -> Column:
    """The failures of the filters that look at one text only, as bits: A is 1, B 2, C 4, D 8."""
    words = F.array_remove(F.split(text, _WORDS), "")
    n_words = F.size(words).cast("long")
    n_different = F.size(F.array_distinct(words)).cast("long")
    n_points = F.length(text).cast("long")
    n_capitals = n_points - F.length(F.translate(text, _CAPITALS, ""))
    failing = [n_words < 100, 100 * n_different < 80 * n_words, 100 * n_capitals > 10 * n_points, text.rlike(r"[#$%&*|]")]
    return sum((F.when(f, 1 << i).otherwise(0) for i, f in enumerate(failing)), F.lit(0)).cast("int")


def packed(mask: int, good: bool = False, toxic: bool = False) -> int:
    """The outcomes of all steps for a document with these failures, one field each."""
    total = 0
    for o, order in enumerate(ORDERS):
        gone = False
        for s, name in enumerate(order):
            fails = bool(mask >> FILTERS.index(name) & 1)
            removed = fails and not gone
            outcomes = {
                "kept": not (gone or fails),
                "removed": removed,
                "redundant": fails and gone,
                "unique_fails": mask == 1 << FILTERS.index(name),
                "good_lost": removed and good,
                "toxic_lost": removed and toxic,
            }
            for m, measure in enumerate(MEASURES):
                total |= int(outcomes[measure]) << (m * _BLOCK_BITS + 8 * FIELD_BYTES * (o * len(FILTERS) + s))
            gone = gone or fails
    return total


def unpacked(total: int) -> dict[str, list[int]]:
    """The counts of each measure for all steps, order by order."""
    data = total.to_bytes(len(MEASURES) * _BLOCK_BITS // 8, "little")
    fields = [int.from_bytes(data[i : i + FIELD_BYTES], "little") for i in range(0, len(data), FIELD_BYTES)]
    return {m: fields[i * _STEPS : (i + 1) * _STEPS] for i, m in enumerate(MEASURES)}


def _add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each step of each part, from rows that list a part's groups and their numbers."""
    known: dict[tuple, int] = {}
    names = [order for order in ORDERS for _ in FILTERS]
    steps = list(range(1, len(FILTERS) + 1)) * len(ORDERS)
    for batch in batches:
        for part, groups in zip(batch.column("part").to_pylist(), batch.column("groups").to_pylist()):
            total = 0
            for g in groups:
                kind = (g["mask"], g["good"], g["toxic"])
                if kind not in known:
                    known[kind] = packed(*kind)
                total += g["n"] * known[kind]
            counts = unpacked(total)
            by_filter = dict.fromkeys(FILTERS, 0)
            for name, step, removed in zip(names, steps, counts["removed"]):
                by_filter[name[step - 1]] += removed
            shapley = [by_filter[name[step - 1]] for name, step in zip(names, steps)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([part] * _STEPS, pa.string()), pa.array(names, pa.string()), pa.array(steps, pa.int32())]
                + [pa.array(counts[m], pa.int64()) for m in MEASURES]
                + [pa.array(shapley, pa.int64())],
                names=["part", "filter_order", "step", *MEASURES, "shapley"],
            )


def mask_counts(docs: DataFrame, labels: DataFrame, key: str, text: str, part: str) -> DataFrame:
    """``part``, ``mask``, ``good``, ``toxic`` and ``n``, the number of documents of that kind."""
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(
        F.col(key).alias("id"),
        F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        failures(whole).alias("mask"),
        F.unhex(F.sha2(whole.cast("binary"), 256)).alias("digest"),
    )
    rows = keep(rows, "masks")
    marks = [F.max(F.coalesce(F.col(c) == 1, F.lit(False))).alias(n) for c, n in (("quality", "good"), ("toxic", "toxic"))]
    known = labels.select(F.col(key).alias("id"), "quality", "toxic").groupBy("id").agg(*marks).where("good OR toxic")
    least = rows.groupBy("digest").agg(F.count("*").alias("n"), F.min("id").alias("least")).where("n > 1").drop("n")

    rows = rows.join(known.hint("merge"), "id", "left").join(least.hint("merge"), "digest", "left")
    copy = F.when(F.col("id") > F.col("least"), 1 << FILTERS.index("E")).otherwise(0)
    marks = [F.coalesce(F.col(c), F.lit(False)).alias(c) for c in ("good", "toxic")]
    return rows.groupBy("part", (F.col("mask") + copy).alias("mask"), *marks).agg(F.count("*").alias("n"))


def audit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """For each part, order of the filters and step: what the step keeps, removes and misses.

    ``part``, ``filter_order``, ``step``, the counts ``kept``, ``removed``, ``redundant``, ``unique_fails``,
    ``good_lost`` and ``toxic_lost``, and ``shapley``, the removals of the step's filter over all orders.
    ``labels`` has ``key``, ``quality`` and ``toxic``.
    """
    parts = mask_counts(docs, labels, key, text, part)
    parts = parts.groupBy("part").agg(F.collect_list(F.struct("mask", "good", "toxic", "n")).alias("groups"))
    measures = ", ".join(f"{m} long" for m in [*MEASURES, "shapley"])
    return parts.mapInArrow(_add_up, f"part string, filter_order string, step int, {measures}")
