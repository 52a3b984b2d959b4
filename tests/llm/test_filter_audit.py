"""Counts of every order and step, compared with applying the filters one after another."""

import random
from itertools import permutations

import pytest

from riskmart.llm import filter_audit

LABELS = "doc_id long, quality int, toxic int, mask string"


def audited(spark, rows, labels):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, mask string, n string, digest string, id string")
    return filter_audit.audit(docs, spark.createDataFrame(labels, LABELS))


def fails(name, text):
    words = [w for w in text.replace("\t", " ").replace("\n", " ").split(" ") if w]
    return {
        "A": len(words) < 100,
        "B": 100 * len(set(words)) < 80 * len(words),
        "C": 100 * sum("A" <= c <= "Z" for c in text) > 10 * len(text),
        "D": any(c in "#$%&*|" for c in text),
    }[name]


def brute(rows, labels):
    def failing(i, text):
        found = {f for f in "ABCD" if fails(f, text or "")}
        copy = i is not None and any(j is not None and j < i and (t or "") == (text or "") for j, t, *_ in rows)
        return found | ({"E"} if copy else set())

    masks = [(r[2] or "", failing(r[0], r[1]), r[0]) for r in rows]
    good = {i for i, q, _, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t, _ in labels if t == 1 and i is not None}
    out = {}
    for part in {m[0] for m in masks}:
        shapley = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            here = [m for m in masks if m[0] == part]
            left = list(here)
            for step, f in enumerate(order, 1):
                gone = [m for m in left if f in m[1]]
                left = [m for m in left if f not in m[1]]
                earlier = sum(f in m[1] and bool(m[1] & set(order[: step - 1])) for m in here)
                shapley[f] += len(gone)
                out[part, "".join(order), step] = [
                    len(left), len(gone), earlier, sum(m[1] == {f} for m in here),
                    sum(m[2] in good for m in gone), sum(m[2] in toxic for m in gone),
                ]
        for key in out:
            if key[0] == part:
                out[key].append(shapley[key[1][key[2] - 1]])
    return out


def as_dict(frame):
    names = [*filter_audit.MEASURES, "shapley"]
    rows = frame.collect()
    found = {(r["part"], r["filter_order"], r["step"]): [r[n] for n in names] for r in rows}
    assert len(found) == len(rows)
    return found


def test_equals_filters_applied_in_turn(spark):
    generator = random.Random(3)
    texts = [None, "", " \t\n", "A" * 50, "é" * 11 + "AB", "#"]
    for _ in range(50):
        words = [f"w{generator.randrange(generator.choice([60, 5000]))}" for _ in range(generator.choice([20, 99, 100, 101, 150]))]
        if generator.random() < 0.3:
            words = [w.upper() for w in words]
        if generator.random() < 0.3:
            words.append(generator.choice("#$%&*|"))
        texts.append(" ".join(words))
    texts += generator.choices(texts, k=40)
    generator.shuffle(texts)
    rows = [(i, t, generator.choice(["en", "de", "", None]), "m", "n", "d", "i") for i, t in enumerate(texts)]
    rows += [(None, texts[0], "en", "m", "n", "d", "i"), (None, texts[0], "en", "m", "n", "d", "i"), (5, texts[5], "en", "m", "n", "d", "i"), (5, texts[7], "xx", "m", "n", "d", "i")]
    labels = [(i, generator.choice([0, 1, None]), generator.choice([0, 1]), "m") for i in generator.choices(range(100), k=60)]
    labels += [(None, 1, 1, "m")]
    assert as_dict(audited(spark, rows, labels)) == brute(rows, labels)


def test_bounds_are_exact():
    for mask in range(32):
        counts = filter_audit.unpacked(3 * filter_audit.packed(mask, True, False))
        for measure, values in counts.items():
            assert len(values) == 600 and set(values) <= {0, 3}, measure
        assert sum(counts["toxic_lost"]) == 0 and counts["good_lost"] == counts["removed"]


def test_fields_do_not_overflow():
    many = (1 << 62) - 1
    counts = filter_audit.unpacked(many * filter_audit.packed(31, True, True) + filter_audit.packed(0))
    assert max(counts["removed"]) == many and set(counts["kept"]) == {1}


@pytest.mark.parametrize("labels", [[], [(0, 1, 1, "m")]])
def test_empty_tables(spark, labels):
    assert audited(spark, [], labels).count() == 0
    one = as_dict(audited(spark, [(0, None, None, "m", "n", "d", "i")], labels))
    assert len(one) == 600 and one["", "ABCDE", 1] == [0, 1, 0, 1, len(labels), len(labels), 120]


def test_very_long_text(spark):
    text = "word " * 400_000
    found = as_dict(audited(spark, [(1, text, "en", "m", "n", "d", "i"), (2, text, "en", "m", "n", "d", "i")], []))
    assert found["en", "BEACD", 1][:4] == [0, 2, 0, 1] and found["en", "EBACD", 1][:4] == [1, 1, 0, 0]
