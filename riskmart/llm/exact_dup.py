"""Exact duplicates by distributed MSD radix partitioning: equality needs no digest.

All texts start in one group. At each level a group is split by the next bytes of its texts, as
one digit; groups of one are done, and so are groups whose digit is shorter than the level's:
those texts have ended and are equal. Digits get longer by level, so that the number of
levels grows with the logarithm of the longest repeated text. Only texts of open groups go on
to the next level, without the bytes already compared.

A group is a count and a maximum, combined before the shuffle, and its members learn of it by a
join whose hot keys adaptive execution can split: a group may hold a third of all rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmart.llm.words import ROW, with_row_id
from riskmart.sources.scratch import drop, keep

FIRST_DIGIT_BYTES = 64
DIGIT_GROWTH = 16
LONGEST_DIGIT_BYTES = 1 << 26


def equal_texts(rows: DataFrame, key: str, unique: bool, text: str) -> DataFrame:
    """``__row``, ``keep_id``, ``keep_row`` and ``group_size`` of the rows whose text occurs again.

    ``rows`` has a unique ``__row``. Of equal texts the largest key stays, of rows that repeat
    it the first.
    """
    live = rows.select(
        ROW, F.col(key).alias("__key"), F.lit(0).cast("long").alias("__group"),
        F.coalesce(text, F.lit("")).cast("binary").alias("__rest"),
    )
    done: list[DataFrame] = []
    width, kept_live = FIRST_DIGIT_BYTES, None
    by = ["__group", "__digit"]
    while True:
        members = live.withColumn("__digit", F.substring("__rest", 1, width))
        last = F.max("__key" if unique else F.struct("__key", (-F.col(ROW)).alias("back"))).alias("last")
        groups = members.groupBy(*by).agg(F.count("*").alias("n"), F.min(ROW).alias("__next"), last)
        groups = keep(groups.where("n > 1"), "groups")
        # Texts are shuffled at every size: groups are too many to be sent wherever it matters.
        found = members.join(groups.hint("merge"), by)
        ended = F.length("__digit") < width
        found = found.select(
            ROW, "__key", F.col("__next").alias("__group"), "n", "last", ended.alias("ended"),
            F.when(~ended, F.substring("__rest", width + 1, 2**31 - 1)).alias("__rest"),
        )
        found = keep(found, "live")
        drop(*([groups] if kept_live is None else [groups, kept_live]))
        done.append(keep(found.where("ended").select(ROW, "n", "last"), "equal"))
        live, kept_live = found.where("NOT ended").select(ROW, "__key", "__group", "__rest"), found
        if live.isEmpty():
            drop(found)
            break
        width = min(width * DIGIT_GROWTH, LONGEST_DIGIT_BYTES)
    equal = done[0]
    for more in done[1:]:
        equal = equal.union(more)
    keep_id = F.col("last") if unique else F.col("last.__key")
    keep_row = F.col("last") if unique else -F.col("last.back")
    return equal.select(ROW, keep_id.alias("keep_id"), keep_row.alias("keep_row"), F.col("n").alias("group_size"))


def exact_groups(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """For each row: ``key``, ``keep_id``, ``group_size``, ``kept`` and ``text_sha256``.

    Defined results: null counts as empty, and empty texts are equal to one another. Rows that
    repeat a key are rows of their own: of equal texts the row with the largest key stays, of
    several such rows just one. Null keys are smaller than all others. An empty table gives an
    empty result. Only ``key`` and ``text`` are read.
    """
    rows, unique = with_row_id(docs.select(key, text), key)
    equal = equal_texts(rows, key, unique, text)
    digest = F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)
    rows = rows.select(ROW, F.col(key).alias("__key"), digest.alias("text_sha256"))
    joined = rows.join(equal, ROW, "left")
    alone = F.col("group_size").isNull()
    return joined.select(
        F.col("__key").alias(key),
        F.when(alone, F.col("__key")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col(ROW) == F.col("keep_row"))).alias("kept"),
        "text_sha256",
    )


def drop_copies(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each text: the one with the largest key; all columns as they are."""
    rows, unique = with_row_id(docs, key)
    equal = equal_texts(rows, key, unique, text)
    gone = equal.where(F.col(ROW) != F.col("keep_row")).select(ROW)
    return rows.join(gone, ROW, "left_anti").select(*docs.columns)
