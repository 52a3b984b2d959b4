import random
from itertools import combinations

import pytest

from riskmart.llm import near_dup
from riskmart.llm.components import components
from tests.llm.frames import documents, nothing, rows_as_given, sentence


def shingles(text):
    words = (text or "").encode().lower().split()
    if not words:
        return set()
    return {tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1))}


def brute(texts):
    sets = [shingles(t) for t in texts]
    parent = list(range(len(texts)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in combinations(range(len(texts)), 2):
        common = len(sets[a] & sets[b])
        if common and 100 * common >= 75 * (len(sets[a]) + len(sets[b]) - common):
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    return [(i, len(sets[i]), root(i), root(i) == i) for i in range(len(texts))]


def result(df):
    return sorted((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in df.collect())


def changed(words, places, generator):
    words = list(words)
    for p in places:
        words[p] = f"x{generator.randrange(10**6)}"
    return words


def corpus():
    """Copies, chains of near copies, near copies on either side of the limit, a common passage."""
    g = random.Random(5)
    texts = [None, "", " \t\n", "one", "ONE", "two words", "two  WORDS", "a b c d", "a b c d e", "a b c d e f"]
    base = sentence(g, 120)
    texts += [" ".join(base)] * 5 + [" ".join(base).upper()]
    for _ in range(40):  # near copies of one another, few as like one another as they are like the base
        texts.append(" ".join(changed(base, g.sample(range(120), g.choice([1, 2, 3, 4, 5])), g)))
    chain = sentence(g, 100)
    for _ in range(12):  # each like the one before only
        texts.append(" ".join(chain))
        at = g.randrange(90)
        chain = changed(chain, range(at, at + 4), g)
    passage = sentence(g, 40)
    for _ in range(60):  # a passage that is half of each text, and links none
        own = sentence(g, g.randrange(25, 45))
        texts.append(" ".join([*passage, *own]))
    texts += [" ".join(sentence(g, 3000)), " ".join(sentence(g, 60))]
    long = sentence(g, 5000)
    texts += [" ".join(long), " ".join(changed(long, range(0, 5000, 100), g)), " ".join(long[:3000])]
    g.shuffle(texts)
    return texts


def test_equals_brute_force(spark):
    texts = corpus()
    assert result(near_dup.near_groups(documents(spark, texts))) == brute(texts)


def test_completion_finds_what_hubs_do_not(spark, monkeypatch):
    """With hub links withheld, the prefix join alone still decides all pairs of open buckets."""
    texts = corpus()
    real, calls = near_dup.confirmed, []

    def first_time_nothing(pairs, sets, percent):
        calls.append(1)
        found = real(pairs, sets, percent)
        return found.where("false") if len(calls) == 1 else found

    monkeypatch.setattr(near_dup, "confirmed", first_time_nothing)
    got = result(near_dup.near_groups(documents(spark, texts)))
    want = brute(texts)
    # Buckets of two were decided by their hub alone, so only larger groups must come out whole.
    sizes = {}
    for row in want:
        sizes[row[2]] = sizes.get(row[2], 0) + 1
    big = max(sizes, key=sizes.get)
    assert [r for r in got if r[2] == big] == [r for r in want if r[2] == big]


def test_repeated_and_null_keys(spark):
    text = " ".join(f"w{i}" for i in range(30))
    rows = near_dup.near_groups(rows_as_given(spark, [(5, text), (5, text), (None, text), (7, "other"), (None, None)])).collect()
    assert sorted((r["component_id"] is None, r["component_id"] or 0, r["kept"]) for r in rows) == [
        (False, 5, False), (False, 5, False), (False, 5, True), (False, 7, True), (True, 0, True),
    ]


def test_drop_near_copies(spark):
    texts = corpus()
    docs = documents(spark, texts)
    kept = near_dup.drop_near_copies(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [r[0] for r in brute(texts) if r[3]]
    assert near_dup.drop_near_copies(nothing(spark)).count() == 0
    assert near_dup.near_groups(nothing(spark)).count() == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_components_of_random_graphs(spark, seed):
    g = random.Random(seed)
    edges = [(g.randrange(200), g.randrange(200)) for _ in range(150)] + [(i, i + 1) for i in range(300, 340)]
    edges += [(500, i) for i in range(501, 560)] + [(3, 3)]
    parent = {n: n for e in edges for n in e if e[0] != e[1]}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in edges:
        if a != b:
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    got = components(spark.createDataFrame(edges, "a long, b long"))
    assert sorted((r["node"], r["component"]) for r in got.collect()) == sorted((n, root(n)) for n in parent)


def test_components_of_nothing(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
