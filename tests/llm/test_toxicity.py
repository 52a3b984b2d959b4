import math
import random
import zlib

import numpy as np
import pytest

from riskmart.llm import toxicity
from tests.llm.frames import documents, nothing, sentence

BAD = ["idjot", "mohron", "wurthless"]


@pytest.fixture(scope="module")
def tables(spark):
    g = random.Random(8)
    texts, labels = [], []
    copied = sentence(g, 60)  # a text copied within one class says no more than one
    for i in range(900):
        words = sentence(g, g.choice([8, 40, 300]), 300)
        toxic = i % 6 == 0
        if toxic:
            for _ in range(g.choice([1, 2, 3])):
                words.insert(g.randrange(len(words)), g.choice(BAD))
        if i % 6 == 0 and i % 30 == 0:
            words = [*copied, g.choice(BAD)]
        texts.append(" ".join(words))
        labels.append((i, int(toxic), "x"))
    texts += [None, "", " ".join(copied)]
    labels += [(0, None, "x"), (None, 1, "x"), (1, 7, "x"), (901, 0, "x"), (5000, 1, "x")]
    return texts, documents(spark, texts), spark.createDataFrame(labels, "doc_id long, toxic int, text string")


def test_held_out_accuracy(spark, tables):
    texts, docs, labels = tables
    rows = {r["doc_id"]: r for r in toxicity.score(docs, labels).collect()}
    assert len(rows) == len(texts)
    for i, r in rows.items():
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7)
    unseen = [i for i in range(900) if rows[i]["held_out"]]
    toxic = [i for i in unseen if i % 6 == 0]
    assert np.mean([rows[i]["predicted"] for i in toxic]) > 0.9
    assert np.mean([rows[i]["predicted"] for i in unseen if i % 6]) < 0.02
    assert rows[900]["score"] == rows[901]["score"] < 0.5
    assert rows[902]["predicted"] == 0


def test_joined_model_gives_the_same(spark, tables):
    _, docs, labels = tables
    sent = toxicity.score(docs, labels).collect()
    joined = toxicity.score(docs, labels, most_entries=0).collect()
    assert sorted((r["doc_id"], round(r["score"], 9)) for r in sent) == sorted((r["doc_id"], round(r["score"], 9)) for r in joined)


def test_labels_of_held_out_rows_teach_nothing(spark, tables):
    _, docs, labels = tables
    without = labels.where(~toxicity.is_held_out("doc_id"))
    a = sorted((r["doc_id"], r["score"]) for r in toxicity.score(docs, labels).collect())
    assert a == sorted((r["doc_id"], r["score"]) for r in toxicity.score(docs, without).collect())


def test_rejected_rows_go(spark, tables):
    _, docs, labels = tables
    kept = toxicity.drop_toxic(docs, labels)
    assert kept.columns == docs.columns
    clean = {r["doc_id"] for r in toxicity.score(docs, labels).where("predicted = 0").collect()}
    assert {r["doc_id"] for r in kept.collect()} == clean


def test_no_labels_and_no_rows(spark, tables):
    _, docs, labels = tables
    scores = {r["score"] for r in toxicity.score(docs, labels.where("false")).collect()}
    assert len(scores) == 1 and scores.pop() < 1e-6
    assert toxicity.score(nothing(spark), labels).count() == 0


def test_counts_by_brute_force(spark):
    """Words and toxic pairs by the different words before them, ordinary pairs by texts."""
    texts = [("a b a b", 1), ("c b", 1), ("a b", 0), ("a b", 0), ("", 0)]
    frame = spark.createDataFrame(texts, "text string, toxic int")
    counts = toxicity.expression_counts(frame, "text")
    total = counts.where("level = 0").first()
    assert (total["nt"], total["no"], total["tt"], total["to"]) == (6, 4, 5, 2)
    words = {(r["nt"], r["no"]) for r in counts.where("level = 1").collect()}
    assert words == {(2, 1), (1, 0)}  # a and b after two words in label 1, c after one
    # "a b" follows two words in label 1 and is in two texts of label 0; no other pair is seen so often.
    assert [(r["nt"], r["no"]) for r in counts.where("level = 2").collect()] == [(2, 2)]


def test_the_formula(spark):
    counts = spark.createDataFrame([(1, 7, 30, 2, 0, 0)], "level int, gram long, nt long, no long, tt long, to long")
    total, types = {"nt": 1000, "no": 9000}, {"nt": 400, "no": 2500}
    got = toxicity._ratios(counts, 1, total, types).first()["ratio"]
    share = 32 / 10000
    toxic = (30 - 0.75 + 0.75 * 400 * share) / 1000
    ordinary = (2 - 0.75 + 0.75 * 2500 * share) / 9000
    assert math.isclose(got, math.log(toxic / ordinary))


def test_the_backoff_of_a_word_is_its_continuation(spark):
    """Two words with the same counts: the one that follows more different words has more of the backoff."""
    columns = "level int, gram long, nt long, no long, tt long, to long, dt long, do long"
    counts = spark.createDataFrame([(1, 7, 30, 40, 0, 0, 30, 2), (1, 8, 30, 1, 0, 0, 30, 2)], columns)
    total, types = {"nt": 1000, "no": 9000}, {"nt": 400, "no": 2500}
    rows = toxicity._ratios(toxicity._comparable(counts, total), 1, total, types, 5000).collect()
    got = {r["gram"]: r["ratio"] for r in rows}
    for gram, before in ((7, 70), (8, 31)):
        toxic = (30 - 0.75 + 0.75 * 400 * before / 5000) / 1000
        ordinary = (2 - 0.75 + 0.75 * 2500 * before / 5000) / 9000
        assert math.isclose(got[gram], math.log(toxic / ordinary))


def _hash(word):
    return int(toxicity._expressions(word)[0].astype(np.int64)[0])


def test_words_of_all_texts_carry_no_ratio(spark):
    """Different words before "the" run out in the larger class first; the texts that hold it do not."""
    g = random.Random(3)
    rows = []
    for i in range(880):
        words = [w for x in sentence(g, 20, 300) for w in ("the", x)]
        if i % 8 == 0:
            words.insert(g.randrange(len(words)), "idjot")
        rows.append((" ".join(words), int(i % 8 == 0)))
    ratios = dict(toxicity.learn(spark.createDataFrame(rows, "text string, toxic int")).collect())
    assert _hash("the") not in ratios and ratios[_hash("idjot")] > 2


def test_copies_of_a_toxic_text_teach_no_word(spark):
    g = random.Random(4)
    rows = [(" ".join(sentence(g, 20, 300)), int(i % 4 == 0)) for i in range(400)]
    rows += [("quite harmless " + rows[0][0], 1)] * 100
    ratios = dict(toxicity.learn(spark.createDataFrame(rows, "text string, toxic int")).collect())
    assert ratios.get(_hash("harmless"), 0.0) <= 0


def test_rows_the_curve_does_not_use_are_counted(spark, tables, monkeypatch):
    _, docs, labels = tables
    seen = []
    learn = toxicity.learn
    monkeypatch.setattr(toxicity, "learn", lambda train, text="text": seen.append(train.count()) or learn(train, text))
    teaching = sum(zlib.crc32(str(i).encode()) % 3 != 1 for i in [*range(900), 901])
    toxicity.learn_scorer(docs, labels, calibration_rows=30)
    assert teaching - 60 < seen[0] < teaching
