import random
import re

from riskmart.llm import decontaminate
from tests.llm.frames import documents, nothing, sentence


def shingles(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in (text or "").lower())
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    return [tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1))] if words else []


def brute(docs, items):
    out = []
    for d, text in enumerate(docs):
        own = shingles(text)
        for i, item in enumerate(items):
            wanted = set(shingles(item))
            common = wanted & set(own)
            if wanted and 100 * len(common) >= 75 * len(wanted):
                out.append((d, i, len(wanted), len(common), min(own.index(s) for s in common)))
    return sorted(out)


def tables(spark):
    g = random.Random(9)
    items = [" ".join(sentence(g, n, 5000)) for n in (1, 3, 5, 6, 9, 14, 20, 33, 57, 120, 400) for _ in range(3)] + [None, "", "a b c"]
    items += [items[20]]
    docs = [None, "", "a b c", "A, b; C!"]
    for k, item in enumerate(items[:33]):
        words, around = item.split(), sentence(g, g.choice([10, 300, 6000]), 5000)
        at = g.randrange(len(around))
        docs.append(" ".join(around[:at] + words + around[at:]))
        docs.append(" ".join(around[:at] + words[: len(words) // 2] + around[at:]))
        cut = len(words) // 10  # an end is missing
        docs.append(", ".join(around[:at] + [w.upper() for w in words[cut:]] + around[at:]))
        docs.append(" ".join(around))
    frame = spark.createDataFrame([(i, t, "x") for i, t in enumerate(items)], "item_id long, text string, matched string")
    return docs, items, documents(spark, docs), frame


def result(df):
    return sorted(tuple(r[c] for c in ("doc_id", "item_id", "n_shingles", "matched", "first_word")) for r in df.collect())


def test_equals_brute_force(spark):
    docs, items, d, i = tables(spark)
    want = brute(docs, items)
    assert len(want) > 50
    assert result(decontaminate.find_items(d, i, ["doc_id"])) == want


def test_groups_of_items_give_the_same(spark, monkeypatch):
    docs, items, d, i = tables(spark)
    monkeypatch.setattr(decontaminate, "GROUP_SHINGLES", 500)
    assert len(decontaminate.item_groups(i.select("item_id", "text"), "item_id", "text")) > 2
    assert result(decontaminate.find_items(d, i, ["doc_id"])) == brute(docs, items)


def test_drop_contaminated(spark):
    docs, items, d, i = tables(spark)
    kept = decontaminate.drop_contaminated(d, i)
    gone = {r[0] for r in brute(docs, items)}
    assert kept.columns == d.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [n for n in range(len(docs)) if n not in gone]


def test_empty_tables(spark):
    _, _, d, i = tables(spark)
    assert decontaminate.find_items(nothing(spark), i, ["doc_id"]).count() == 0
    assert decontaminate.find_items(d, i.where("false"), ["doc_id"]).count() == 0
    assert decontaminate.drop_contaminated(d, i.where("false")).count() == d.count()


def test_repeated_documents(spark):
    _, _, d, i = tables(spark)
    twice = decontaminate.find_items(d.union(d), i, ["doc_id"])
    assert twice.count() == 2 * decontaminate.find_items(d, i, ["doc_id"]).count()
    assert decontaminate.drop_contaminated(d.union(d), i).count() == 2 * decontaminate.drop_contaminated(d, i).count()
