"""Near-duplicates by SimHash: fingerprints within a few bits of each other, found in BK-trees.

1. *Fingerprints.* A bit of a text's 64 is set if it is set in more than half of the hashes of its
   three-word shingles. Rows of one fingerprint become one node, combined before any shuffle.
2. *Shards.* Two fingerprints that differ in at most ``RADIUS`` bits agree on some ``BLOCKS - RADIUS`` of
   ``BLOCKS`` blocks of bits. For each such choice of blocks, fingerprints that agree on them form a
   shard: every link lies within a shard, and unrelated fingerprints hardly share one.
3. *Trees.* A shard becomes a BK-tree: the children of a node are keyed by their distance from it. Each
   member follows only edges whose key is within ``RADIUS`` of its own distance from the node. Of the
   links only a spanning forest leaves the task. A subtree that is known to be of the member's own
   component is not entered, so that a shard of very many near copies costs little more than its size.
4. *Large shards.* A tree holds at most ``TREE`` nodes. A larger shard is dealt to several trees by hash, and
   in each choice of blocks by another. Where such a shard still holds several components, its trees are
   sent to its other members: each tree meets blocks of at most ``TREE`` of those
   that are not in the shard's largest component.
5. *Components* of the links, by alternating large-star and small-star.

Trees are sent to tasks by shuffles, not by the driver: together they hold all fingerprints, so no
size bound could be given for a broadcast of them; each is at most ``TREE`` numbers.

Defined results: a null text counts as empty; texts without words have fingerprint zero and are linked like
any other; fewer than three words are one shingle, and repeated shingles count each. Null keys are never
the least unless a component has no other, then ``component_id`` is null. Rows that repeat a key are rows of their own.
An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskmart.llm.components import components
from riskmart.llm.words import map_texts
from riskmart.sources.scratch import keep, temporary

SHINGLE_WORDS = 3
SEED = 42
RADIUS = 3
BLOCKS = 6
TREE = 1 << 15
_FRONTIER = 1 << 20
_QUERIES = 1 << 12

_SMALL = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_SHINGLES_AT_ONCE = 1 << 13


def fingerprint(text: str) -> int:
    """The majority of each bit over the hashes of a text's shingles, as an unsigned number."""
    words = text.encode().translate(_SMALL).split()  # bytes split at exactly \x20 and \x09-\x0D
    if not words:
        return 0
    width = min(SHINGLE_WORDS, len(words))
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate([[0], ends[:-1]])[: len(words) - width + 1].tolist()
    ends = (ends[width - 1 :] - 1).tolist()
    view, digest = memoryview(line), xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for at in range(0, len(starts), _SHINGLES_AT_ONCE):
        places = zip(starts[at : at + _SHINGLES_AT_ONCE], ends[at : at + _SHINGLES_AT_ONCE])
        hashes = np.array([digest(view[a:b], SEED) for a, b in places], np.uint64)
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(starts), bitorder="little").view(np.uint64)[0])


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


# --- BK-trees -------------------------------------------------------------------------


class Forest:
    """BK-trees of several shards at once.

    ``values`` are the fingerprints, different within a shard, and ``shard`` the number of each one's shard, in
    order. The first of a shard is its root. Insertion goes level by level: of the fingerprints at a node, the first of each
    distance becomes the child keyed by that distance, and the others go on from there.
    """

    def __init__(self, values: np.ndarray, shard: np.ndarray):
        self.values = values
        first = np.concatenate([[True], shard[1:] != shard[:-1]]) if len(shard) else np.empty(0, bool)
        self.root = np.flatnonzero(first)[np.cumsum(first) - 1] if len(shard) else np.empty(0, np.int64)
        self.parent = np.full(len(values), -1, np.int64)
        self.key = np.zeros(len(values), np.int64)
        self.levels: list[np.ndarray] = [np.flatnonzero(first)]
        waiting = np.flatnonzero(~first)
        at = self.root[waiting]
        while len(waiting):
            distance = np.bitwise_count(values[waiting] ^ values[at]).astype(np.int64)
            _, chosen, which = np.unique(at * 65 + distance, return_index=True, return_inverse=True)
            child = waiting[chosen]
            self.parent[child], self.key[child] = at[chosen], distance[chosen]
            self.levels.append(child)
            further = np.ones(len(waiting), bool)
            further[chosen] = False
            at, waiting = child[which][further], waiting[further]
        grown = np.flatnonzero(self.parent >= 0)
        order = np.argsort(self.parent[grown] * 65 + self.key[grown])
        self.children = grown[order]
        self.edges = (self.parent * 65 + self.key)[self.children]

    def uniform(self, component: np.ndarray) -> np.ndarray:
        """The component of each node's whole subtree, or -1 where it holds several."""
        low, high = component.copy(), component.copy()
        for level in reversed(self.levels[1:]):
            np.minimum.at(low, self.parent[level], low[level])
            np.maximum.at(high, self.parent[level], high[level])
        return np.where(low == high, low, -1)

    def near(self, values: np.ndarray, roots: np.ndarray, own: np.ndarray, whole: np.ndarray) -> Iterator[tuple]:
        """Pairs (query, node) within ``RADIUS``, without subtrees that are wholly of the query's component.

        Queries are ``values`` that begin at ``roots``; ``own`` are their components and ``whole``
        those of subtrees. The pairs under way are bounded: what is too many waits on a stack.
        """
        stack = [(np.arange(len(values)), roots)]
        while stack:
            query, node = stack.pop()
            if len(query) > _FRONTIER:
                half = len(query) // 2
                stack += [(query[half:], node[half:]), (query[:half], node[:half])]
                continue
            open_ = whole[node] != own[query]
            query, node = query[open_], node[open_]
            if not len(query):
                continue
            distance = np.bitwise_count(values[query] ^ self.values[node]).astype(np.int64)
            hit = distance <= RADIUS
            if hit.any():
                yield query[hit], node[hit]
            low = np.searchsorted(self.edges, node * 65 + np.maximum(distance - RADIUS, 0))
            high = np.searchsorted(self.edges, node * 65 + np.minimum(distance + RADIUS, 64), side="right")
            n = high - low
            total = int(n.sum())
            if total:
                places = np.arange(total) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)
                stack.append((np.repeat(query, n), self.children[places]))


class Union:
    """Components of a growing set of links; ``forest`` are the links that joined two of them."""

    def __init__(self, n: int):
        self.component = np.arange(n)
        self.forest: list[tuple[int, int]] = []

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        ca, cb = self.component[a], self.component[b]
        apart = np.flatnonzero(ca != cb)
        if not len(apart):
            return
        pairs = np.stack([np.minimum(ca, cb), np.maximum(ca, cb)], 1)[apart]
        _, which = np.unique(pairs, axis=0, return_index=True)
        up: dict[int, int] = {}

        def find(x: int) -> int:
            top = x
            while top in up:
                top = up[top]
            while x != top:
                up[x], x = top, up[x]
            return top

        for i in which.tolist():
            x, y = find(int(pairs[i, 0])), find(int(pairs[i, 1]))
            if x != y:
                up[max(x, y)] = min(x, y)
                self.forest.append((int(a[apart[i]]), int(b[apart[i]])))
        old = np.array(list(up), np.int64)
        new = np.array([find(x) for x in old.tolist()], np.int64)
        names = np.arange(len(self.component))
        names[old] = new
        self.component = names[self.component]


def links_within(values: np.ndarray, shard: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of the links inside each shard, as places in ``values``."""
    forest, union = Forest(values, shard), Union(len(values))
    close = np.flatnonzero((forest.parent >= 0) & (forest.key <= RADIUS))
    union.add(close, forest.parent[close])
    for at in range(0, len(values), _QUERIES):
        block = slice(at, at + _QUERIES)
        whole = forest.uniform(union.component)
        found = list(forest.near(values[block], forest.root[block], union.component[block], whole))
        for query, node in found:
            union.add(query + at, node)
    return union.forest


def _bits(values: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(values, np.int64).view(np.uint64)


def _by_shard(batches: Iterator[pa.RecordBatch], wanted: int) -> Iterator[pa.RecordBatch]:
    """Batches of about ``wanted`` rows that end between shards; a shard has at most ``TREE`` rows or is a batch's own."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        rows += batch.num_rows
        if rows < wanted:
            continue
        whole = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        shard = whole.column("shard").to_numpy()
        tree = whole.column("tree").to_numpy()
        changes = np.flatnonzero((shard[1:] != shard[:-1]) | (tree[1:] != tree[:-1]))
        if not len(changes):
            held = [whole]
            continue
        cut = int(changes[-1]) + 1
        yield whole.slice(0, cut)
        held, rows = [whole.slice(cut)], whole.num_rows - cut
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _numbers(batch: pa.RecordBatch) -> np.ndarray:
    shard, tree = batch.column("shard").to_numpy(), batch.column("tree").to_numpy()
    return np.concatenate([[0], np.cumsum((shard[1:] != shard[:-1]) | (tree[1:] != tree[:-1]))])


def _pairs(a, b) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _inside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links within trees; rows come in the order of (shard, tree)."""
    for batch in _by_shard(batches, 2 * TREE):
        node = batch.column("node").to_numpy()
        found = np.array(links_within(_bits(node), _numbers(batch)), np.int64).reshape(-1, 2)
        yield _pairs(node[found[:, 0]], node[found[:, 1]])


def _across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links between a tree and a block of members of other trees; rows are ordered by ``asks`` within both."""
    for batch in _by_shard(batches, 1):
        asks, node, component = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("asks", "node", "component"))
        number = _numbers(batch)
        for n in np.unique(number).tolist():
            here = number == n
            tree, asking = np.flatnonzero(here & ~asks), np.flatnonzero(here & asks)
            if not len(tree) or not len(asking):
                continue
            forest = Forest(_bits(node[tree]), np.zeros(len(tree), np.int64))
            whole = forest.uniform(component[tree].copy())
            for at in range(0, len(asking), _QUERIES):
                some = asking[at : at + _QUERIES]
                roots = np.zeros(len(some), np.int64)
                for query, found in forest.near(_bits(node[some]), roots, component[some], whole):
                    a, b = node[some[query]], node[tree[found]]
                    # One link between two components is enough.
                    both = np.stack([component[some[query]], component[tree[found]]], 1)
                    _, one = np.unique(both, axis=0, return_index=True)
                    yield _pairs(a[one], b[one])


# --- shards ---------------------------------------------------------------------------


def shard_keys(node: Column) -> list[Column]:
    """A key for each choice of ``BLOCKS - RADIUS`` blocks: their bits and the choice's number."""
    edges = [round(64 * i / BLOCKS) for i in range(BLOCKS + 1)]
    masks = [sum(1 << b for b in range(low, high)) for low, high in zip(edges, edges[1:])]
    chosen = [sum(c) for c in combinations(masks, BLOCKS - RADIUS)]
    return [F.xxhash64(F.lit(i), node.bitwiseAND(F.lit(_signed(m)))) for i, m in enumerate(chosen)]


def links(nodes: DataFrame, tree: int = TREE) -> DataFrame:
    """Links (a, b) between the fingerprints in ``node`` that join all within ``RADIUS``; trees of at most about ``tree`` rows."""
    each = nodes.select("node", F.posexplode(F.array(*shard_keys(F.col("node")))).alias("choice", "shard"))
    sizes = keep(each.groupBy("shard").agg(F.count("*").alias("n")).where("n > 1"), "shards")
    members = each.join(sizes.hint("merge"), "shard")
    # Trees are filled by hash, so their sizes vary about the mean.
    n_trees = F.when(F.col("n") <= tree, 1).otherwise(F.ceil(1.25 * F.col("n") / tree))
    place = F.pmod(F.xxhash64("node", "choice", F.lit(1)), n_trees).cast("int")
    members = members.select("shard", "node", place.alias("tree"), n_trees.cast("int").alias("n_trees"))
    dealt = members.repartition("shard", "tree").sortWithinPartitions("shard", "tree", "node")
    found = keep(dealt.mapInArrow(_inside, "a long, b long"), "inside")

    several = sizes.where(F.col("n") > tree).select("shard")
    if several.isEmpty():
        return found
    # Shards of several trees: what is not of the largest component there asks all trees.
    placed = keep(components(found), "found_inside").toDF("node", "component")
    large = members.join(several, "shard", "left_semi").join(placed, "node", "left")
    large = keep(large.withColumn("component", F.coalesce("component", "node")), "large")
    parts = large.groupBy("shard", "component").agg(F.count("*").alias("n"))
    largest = parts.groupBy("shard").agg(F.max(F.struct("n", "component")).alias("m"), F.sum("n").alias("total"))
    largest = largest.where("m.n < total").select(
        "shard", F.col("m.component").alias("largest"), F.ceil((F.col("total") - F.col("m.n")) / tree).cast("int").alias("n_blocks")
    )
    large = large.join(largest, "shard")
    blocks = large.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1))).withColumn("asks", F.lit(False))
    asking = large.where("component <> largest").withColumn("of", F.explode(F.sequence(F.lit(0), F.col("n_trees") - 1)))
    asking = asking.where("of <> tree").withColumn("tree", F.col("of")).drop("of").withColumns(
        {"block": F.pmod(F.xxhash64("node", F.lit(2)), F.col("n_blocks")).cast("int"), "asks": F.lit(True)}
    )
    both = blocks.unionByName(asking).withColumn("tree", F.col("tree").cast("long") * F.lit(1 << 31) + F.col("block"))
    both = both.select("shard", "tree", "asks", "node", "component")
    dealt = both.repartition("shard", "tree").sortWithinPartitions("shard", "tree", "asks", "node")
    return found.union(keep(dealt.mapInArrow(_across, "a long, b long"), "across"))


def near_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", tree: int = TREE) -> DataFrame:
    """For each row: ``key``, ``fingerprint`` as 16 hexadecimal digits and ``component_id``, the smallest key of its component."""
    with temporary():
        signed = map_texts(docs.select(key, text), "node long", lambda: lambda t: (_signed(fingerprint(t)),), [key], text)
        signed = keep(signed.toDF("__key", "node"), "signed", lasting=True)
        nodes = keep(signed.groupBy("node").agg(F.min("__key").alias("least")), "nodes")
        found = components(links(nodes.select("node"), tree)).toDF("node", "component")
        placed = nodes.join(found.hint("merge"), "node", "left")
        placed = keep(placed.withColumn("component", F.coalesce("component", "node")), "placed")
        names = placed.groupBy("component").agg(F.min("least").alias("component_id"))
        names = keep(placed.join(names.hint("merge"), "component").select("node", "component_id"), "names", lasting=True)
    rows = signed.join(names.hint("merge"), "node")
    return rows.select(F.col("__key").alias(key), F.lower(F.lpad(F.hex("node"), 16, "0")).alias("fingerprint"), "component_id")
