"""Near-duplicates by MinHash: many universal minima, banding, verification, components.

1. *Signatures.* Each text's set of five-word shingles is reduced to ``BANDS * ROWS`` minima of
   universal hash functions. Texts with equal sets become one class, stood for by one row.
2. *Banding.* Classes that agree in a whole band share a bucket. A bucket does not emit its
   pairs: every member is paired with the bucket's hub, the least in one of two orders that all
   buckets share, so a bucket of any size costs one pair a member and copies meet the same hubs.
3. *Verification.* Pairs whose signatures are too unlike are dropped (eight standard errors
   below the limit), the others are decided on the full shingle sets.
4. *Components* of the links, by alternating large-star and small-star.
5. *Completion.* Where a bucket still holds several components, members may be linked with one
   another without being linked with a hub. These classes, and only these, are joined once more
   by prefix filter: two sets of similarity t or more share one of the rarest shingles of each,
   ``n - ceil(t * n) + 1`` of them. Frequent passages are no rare shingles, so many texts
   that share one meet in no group here. In ``HUB_TURNS`` turns each text meets one hub of each of
   its rare shingles, and links found contract components; only shingles whose texts still are of several components give pairs
   of these. No bucket is cut off or sampled.

Two texts of similarity 0.75 miss each other in all bands with a probability of 1e-8.

Defined results: a text with one to four words has its whole sequence as its one shingle; null
texts and texts without words have no set, are linked with nothing and kept. Rows that repeat a
key are rows of their own. Shingles are compared by 64-bit hashes, sets as a whole by 128.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskmart.llm.components import components
from riskmart.llm.words import ROW, between_spaces, map_texts, shingle_hashes, with_row_id
from riskmart.sources.scratch import keep, temporary

BANDS = 48
ROWS = 4
PERCENT = 75
ORDERS = 2
HUB_TURNS = 3
_LIKE_ENOUGH = 0.5  # share of equal minima; 0.75 less eight standard errors of 192 minima
_BLOCK = 1024

_random = np.random.default_rng(20)
_FACTOR = (_random.integers(0, 2**32, BANDS * ROWS, dtype=np.uint32) | np.uint32(1))[:, None]
_SHIFT = _random.integers(0, 2**32, BANDS * ROWS, dtype=np.uint32)[:, None]
_ORDER_MASKS = [0, *(int(x) for x in _random.integers(0, 2**62, ORDERS - 1))]


def shingle_set(text: str) -> np.ndarray:
    """The distinct shingles of a text as sorted 64-bit hashes."""
    return np.unique(shingle_hashes(between_spaces(text.encode())))


def minima(shingles: np.ndarray) -> np.ndarray:
    """The least value of each hash function over a set."""
    folded = (shingles ^ (shingles >> np.uint64(32))).astype(np.uint32)
    least = np.full(BANDS * ROWS, 0xFFFFFFFF, np.uint32)
    for start in range(0, len(folded), _BLOCK):
        values = _FACTOR * folded[None, start : start + _BLOCK]
        values += _SHIFT
        np.minimum(least, values.min(axis=1), out=least)
    return least


def _signature(text: str) -> tuple:
    shingles = shingle_set(text)
    if not len(shingles):
        return 0, None, None
    return len(shingles), xxhash.xxh3_128_digest(shingles.tobytes()), minima(shingles).tobytes()


def _set(text: str) -> tuple:
    return (shingle_set(text).astype(np.int64),)


def alike(pairs: DataFrame, signatures: DataFrame) -> DataFrame:
    """The pairs (a, b) whose signatures agree in enough places."""
    sides = pairs.join(signatures.toDF("a", "sa"), "a").join(signatures.toDF("b", "sb"), "b")

    def compare(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            left, right = (
                np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint32).reshape(batch.num_rows, -1)
                for c in ("sa", "sb")
            )
            like = (left == right).mean(axis=1) >= _LIKE_ENOUGH
            yield pa.RecordBatch.from_arrays(
                [batch.column(c).filter(pa.array(like)) for c in ("a", "b")], names=["a", "b"]
            )

    return sides.select("a", "b", "sa", "sb").mapInArrow(compare, "a long, b long")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets have the wanted similarity."""
    sides = pairs.join(sets.toDF("a", "sa"), "a").join(sets.toDF("b", "sb"), "b")
    common = F.size(F.array_intersect("sa", "sb")).cast("long")
    either = F.size("sa") + F.size("sb") - common
    return sides.where(100 * common >= percent * either).select("a", "b")


def buckets(representatives: DataFrame) -> DataFrame:
    """``bucket``, ``a`` (the hub) and ``b`` (a member): the members of buckets of two and more."""
    keys = [
        F.xxhash64(F.lit(i), F.substring("signature", 4 * ROWS * i + 1, 4 * ROWS)).bitwiseAND(F.lit(~3))
        + F.lit(i % ORDERS)
        for i in range(BANDS)
    ]
    members = representatives.select(F.col(ROW).alias("b"), F.explode(F.array(*keys)).alias("bucket"))
    mask = F.array(*map(F.lit, _ORDER_MASKS))[F.col("bucket").bitwiseAND(F.lit(3)).cast("int")]
    hubs = members.groupBy("bucket").agg(F.count("*").alias("n"), F.min(F.col("b").bitwiseXOR(mask)).alias("least"))
    hubs = keep(hubs.where("n > 1").select("bucket", "n", F.col("least").bitwiseXOR(mask).alias("a")), "hubs")
    return members.join(hubs, "bucket")


def open_members(members: DataFrame, found: DataFrame) -> DataFrame:
    """``b`` and its component ``c`` where a bucket of three and more holds several components."""
    placed = members.where("n > 2").select("bucket", "b").join(found.toDF("b", "c"), "b", "left")
    placed = placed.select("bucket", "b", F.coalesce("c", "b").alias("c"))
    several = placed.groupBy("bucket").agg(F.min("c").alias("least"), F.max("c").alias("most"))
    several = keep(several.where("least <> most").select("bucket"), "open")
    return placed.join(several, "bucket", "left_semi").select("b", "c").distinct()


def rare_shingles(texts: DataFrame, percent: int) -> DataFrame:
    """``b``, ``c``, ``n``, ``shingle`` and ``rest``: the rarest shingles of each text, in groups that are open.

    ``texts`` has ``b``, ``c`` and ``shingles``. The order of shingles is by their number in these
    texts, then by hash. From the first shingle that two sets share, by that order, they can have no more in
    common than the shorter ``rest`` of them; with their sizes this decides most pairs at once.
    """
    n = F.size("shingles")
    each = texts.select("b", "c", n.alias("n"), F.explode("shingles").alias("shingle"))
    counts = keep(each.groupBy("shingle").agg(F.count("*").alias("texts")).where("texts > 1"), "counts")
    # A shingle of one text only comes first in the order, and meets nobody.
    shared = each.join(counts, "shingle").groupBy("b", "c", "n").agg(
        F.sort_array(F.collect_list(F.struct("texts", "shingle"))).alias("shared")
    )
    alone = F.col("n") - F.size("shared")
    prefix = F.col("n") - F.ceil(F.col("n") * percent / 100.0) + 1
    rare = shared.select(
        "b", "c", "n", alone.alias("alone"),
        F.posexplode(F.slice("shared", 1, F.greatest(prefix - alone, F.lit(0)).cast("int"))).alias("i", "s"),
    )
    rare = rare.select("b", "c", "n", F.col("s.shingle").alias("shingle"), (F.col("n") - F.col("alone") - F.col("i")).alias("rest"))
    return open_groups(keep(rare, "rare"), percent)


def open_groups(rare: DataFrame, percent: int) -> DataFrame:
    """The rows of shingles whose rows are of several components and small enough for their smallest text."""
    groups = rare.groupBy("shingle").agg(F.min("c").alias("c1"), F.max("c").alias("c2"), F.min("n").alias("least"))
    groups = keep(groups.where("c1 <> c2").select("shingle", "least"), "rare_groups")
    able = (100 + percent) * F.col("rest") >= percent * (F.col("n") + F.col("least"))
    return keep(rare.join(groups, "shingle").where(able).drop("least"), "able")


def _able(x: str, y: str, percent: int) -> Column:
    """Whether rows of one shingle can belong to linked texts of different components."""
    sizes = (100 * F.col(f"{x}.n") >= percent * F.col(f"{y}.n")) & (100 * F.col(f"{y}.n") >= percent * F.col(f"{x}.n"))
    most = F.least(F.col(f"{x}.rest"), F.col(f"{y}.rest"))
    enough = (100 + percent) * most >= percent * (F.col(f"{x}.n") + F.col(f"{y}.n"))
    return (F.col(f"{x}.c") != F.col(f"{y}.c")) & sizes & enough


def hub_pairs(rare: DataFrame, turn: int, percent: int) -> DataFrame:
    """Pairs (a, b) of each row with the hub of its shingle, another for every shingle and turn.

    A text has as many hubs as rare shingles, so a member of a family of near copies meets many
    of the family, and the number of pairs is that of the rows.
    """
    order = F.xxhash64("b", "shingle", F.lit(turn))
    hubs = rare.groupBy("shingle").agg(F.min(F.struct(order.alias("order"), "b", "c", "n", "rest")).alias("hub"))
    hubs = hubs.select("shingle", "hub.b", "hub.c", "hub.n", "hub.rest")
    x, y = rare.alias("x"), hubs.alias("y")
    pairs = x.join(y, (F.col("x.shingle") == F.col("y.shingle")) & _able("x", "y", percent))
    return pairs.select(F.least("x.b", "y.b").alias("a"), F.greatest("x.b", "y.b").alias("b")).distinct()


def prefix_pairs(rare: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of texts of different components that share one of the rarest shingles of both."""
    x, y = rare.alias("x"), rare.alias("y")
    near = (F.col("x.shingle") == F.col("y.shingle")) & (F.col("x.b") < F.col("y.b"))
    return x.join(y, near & _able("x", "y", percent)).select(F.col("x.b").alias("a"), F.col("y.b").alias("b")).distinct()


def near_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """For each row: ``key``, ``n_shingles``, ``component_id`` and ``kept``, and the unique ``__row``.

    Rows are linked if ``100 * common >= percent * either`` for their shingle sets (``percent``
    of 75 and more); ``component_id`` is the smallest key a row is linked with directly or through others, and the
    row of that key stays.
    """
    rows, unique = with_row_id(docs.select(key, text), key)
    with temporary():
        schema = "n_shingles int, digest binary, signature binary"
        signed = keep(map_texts(rows, schema, lambda: _signature, list(dict.fromkeys([ROW, key])), text), "signed")
        sized = signed.where("n_shingles > 0")

        classes = keep(sized.groupBy("digest").agg(F.min(ROW).alias("first"), F.count("*").alias("n")).where("n > 1"), "classes")
        copies = keep(sized.select(ROW, "digest").join(classes, "digest").where(f"{ROW} <> first").select(ROW, "first"), "copies")
        representatives = sized.select(ROW, "signature").join(copies.select(ROW), ROW, "left_anti")

        members = keep(buckets(representatives), "members")
        wanted = members.select(F.col("b").alias(ROW)).distinct()
        signatures = keep(representatives.join(wanted, ROW, "left_semi"), "signatures")
        texts = rows.join(signatures.select(ROW), ROW, "left_semi")
        sets = keep(map_texts(texts, "shingles array<long>", lambda: _set, [ROW], text), "sets")

        pairs = members.where("a <> b").select("a", "b").distinct()
        links = keep(confirmed(alike(pairs, signatures), sets, percent), "links")
        found = keep(components(links), "found")
        undecided = keep(open_members(members, found), "undecided")
        rare = rare_shingles(undecided.join(sets.toDF("b", "shingles"), "b"), percent)
        for turn in range(HUB_TURNS + 1):
            pairs = hub_pairs(rare, turn, percent) if turn < HUB_TURNS else prefix_pairs(rare, percent)
            more = keep(confirmed(alike(pairs, signatures), sets, percent), "more")
            if more.isEmpty():
                continue
            found = keep(components(found.toDF("a", "b").union(more)), "found")
            if turn < HUB_TURNS:
                joined = rare.drop("c").join(found.toDF("b", "c"), "b", "left").withColumn("c", F.coalesce("c", "b"))
                rare = open_groups(keep(joined.select("b", "c", "n", "shingle", "rest"), "contracted"), percent)

        # Copies belong to the component of their class; rows in no list are components of their own.
        placed = copies.join(found.toDF("first", "component"), "first", "left").select(
            ROW, F.coalesce("component", "first").alias("component")
        )
        firsts = copies.select(F.col("first").alias(ROW), F.col("first").alias("component")).distinct()
        firsts = firsts.join(found.select(F.col("node").alias(ROW)), ROW, "left_anti")
        placed = keep(placed.union(firsts).union(found.toDF(ROW, "component")), "placed", lasting=True)
        plain = keep(signed.select(ROW, F.col(key).alias("__key"), F.col("n_shingles").cast("long")), "plain", lasting=True)

    result = plain.join(placed, ROW, "left").withColumn("component", F.coalesce("component", F.col(ROW)))
    if unique:
        result = result.select("*", F.col("component").alias("component_id"), (F.col(ROW) == F.col("component")).alias("kept"))
    else:
        first = F.min(F.struct(F.col("__key").isNull().alias("none"), F.col("__key").alias("id"), F.col(ROW).alias("row")))
        names = keep(result.groupBy("component").agg(first.alias("first")), "names")
        result = result.join(names, "component").select(
            "*", F.col("first.id").alias("component_id"), (F.col(ROW) == F.col("first.row")).alias("kept")
        )
    return result.select(ROW, F.col("__key").alias(key), "n_shingles", "component_id", "kept")


def drop_near_copies(docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """``docs`` with one row of each component, the one with the smallest key; all columns as they are.

    Where keys repeat or are null, it is the first row of the component.
    """
    rows, _ = with_row_id(docs, key)
    gone = near_groups(rows.select(F.col(ROW).alias("__id"), text), "__id", text, percent).where("NOT kept").select(ROW)
    return rows.join(keep(gone, "gone"), ROW, "left_anti").select(*docs.columns)
