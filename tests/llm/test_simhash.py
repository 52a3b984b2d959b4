"""Fingerprints and components, compared with brute force."""

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from riskmart.llm import simhash
from tests.llm.frames import documents, nothing, rows_as_given, sentence


def plain_fingerprint(text):
    small = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\v\f\r":
        small = small.replace(c, " ")
    words = [w for w in small.split(" ") if w]
    shingles = [" ".join(words[i : i + 3]) for i in range(max(len(words) - 2, 1))] if words else []
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(values):
    """The least place reachable, for each value."""
    least = list(range(len(values)))
    todo = set(least)
    while todo:
        start = min(todo)
        todo.remove(start)
        reached = [start]
        for a in reached:
            near = {b for b in todo if (values[a] ^ values[b]).bit_count() <= 3}
            todo -= near
            reached += near
        for a in reached:
            least[a] = start
    return least


def check(spark, docs, texts, tree=simhash.TREE):
    values = [plain_fingerprint(t) for t in texts]
    expected = {i: (f"{v:016x}", c) for i, (v, c) in enumerate(zip(values, plain_components(values)))}
    rows = simhash.near_groups(docs, tree=tree).collect()
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in rows} == expected
    return expected


def corpus(generator, n):
    texts = [None, "", " \t ", "one", "One two", "one\vtwo", "ONE TWO three", "a b c d", "a  b\nc d", "é x y z w", "İ KK"]
    for _ in range(n):
        words = sentence(generator, generator.choice([3, 30, 200, 600]))
        texts.append(" ".join(words))
        for _ in range(generator.choice([0, 0, 1, 4])):
            words = list(words)
            words[generator.randrange(len(words))] = f"x{generator.randrange(9)}"
            texts.append(" ".join(words))
    return texts + generator.choices(texts, k=n // 4)


def test_equals_brute_force(spark):
    generator = random.Random(1)
    texts = corpus(generator, 120)
    found = check(spark, documents(spark, texts), texts)
    assert len({c for _, c in found.values()}) < 0.9 * len(texts)


def test_hashes_are_those_of_spark(spark):
    text = "Alpha beta é"
    value = spark.range(1).select(F.xxhash64(F.lit("alpha beta é"))).first()[0]
    assert simhash.fingerprint(text) == value % 2**64


def test_very_long_texts(spark):
    generator = random.Random(2)
    words = sentence(generator, 120_000)
    texts = [" ".join(words), " ".join([*words[:-1], "other"]), "x" * 2_000_000, "x" * 2_000_000 + " y"]
    check(spark, documents(spark, texts), texts)


def test_repeated_and_null_keys(spark):
    rows = simhash.near_groups(rows_as_given(spark, [(7, "a b c"), (7, "u v w"), (None, "a b c"), (None, "p q r"), (9, "u v w")]))
    found = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["fingerprint"], r["component_id"]) for r in rows.collect() if r["component_id"])
    abc, uvw = (f"{plain_fingerprint(t):016x}" for t in ("a b c", "u v w"))
    assert found == sorted([(False, 7, abc, 7), (False, 7, uvw, 7), (True, 0, abc, 7), (False, 9, uvw, 7)])


def test_empty_table(spark):
    rows = simhash.near_groups(nothing(spark))
    assert rows.columns == ["doc_id", "fingerprint", "component_id"] and rows.count() == 0


def ball(generator, centre, n, most):
    out = set()
    while len(out) < n:
        value = centre
        for bit in generator.sample(range(64), generator.randrange(most + 1)):
            value ^= 1 << bit
        out.add(value)
    return out


@pytest.mark.parametrize("tree", [simhash.TREE, 16])
def test_links_join_what_brute_force_joins(spark, tree):
    """Clouds of different density, with shards of one tree and of many."""
    generator = random.Random(5)
    centres = [generator.getrandbits(64) for _ in range(4)]
    values = sorted(set().union(*(ball(generator, c, 150, m) for c, m in zip(centres, (2, 4, 6, 9)))))
    nodes = spark.createDataFrame([(simhash._signed(v),) for v in values], "node long")
    found = simhash.links(nodes, tree).collect()
    place = {simhash._signed(v): i for i, v in enumerate(values)}
    joined = simhash.Union(len(values))
    for r in found:
        a, b = place[r["a"]], place[r["b"]]
        assert (values[a] ^ values[b]).bit_count() <= 3
        joined.add(np.array([a]), np.array([b]))
    assert joined.component.tolist() == plain_components(values)
    assert len(found) < 40 * len(values)


def test_tree_edges_and_search():
    generator = random.Random(6)
    centre = generator.getrandbits(64)
    values = np.array(sorted(ball(generator, centre, 300, 8)), np.uint64)
    forest = simhash.Forest(values, np.zeros(300, np.int64))
    for i in range(300):
        if forest.parent[i] >= 0:
            assert int(values[i] ^ values[forest.parent[i]]).bit_count() == forest.key[i]
    seen = set(zip(forest.parent.tolist(), forest.key.tolist()))
    assert len(seen) == 300  # one child a distance
    nothing_known = np.full(300, -1)
    own = np.arange(300)
    hits = {(q, n) for a, b in forest.near(values, forest.root, own, nothing_known) for q, n in zip(a.tolist(), b.tolist())}
    assert hits == {(a, b) for a in range(300) for b in range(300) if int(values[a] ^ values[b]).bit_count() <= 3}


def test_a_dense_shard_is_cheap(monkeypatch):
    """Thousands of near copies: subtrees of the query's own component are not entered."""
    generator = random.Random(7)
    values = np.array(sorted(ball(generator, generator.getrandbits(64), 20_000, 5)), np.uint64)
    visits = 0
    near = simhash.Forest.near

    def counted(self, asked, roots, own, whole):
        nonlocal visits
        for q, n in near(self, asked, roots, own, whole):
            visits += len(q)
            yield q, n

    monkeypatch.setattr(simhash.Forest, "near", counted)
    assert len(simhash.links_within(values, np.zeros(len(values), np.int64))) == len(values) - 1
    assert visits < 50 * len(values)
