import random

import corpus_pipeline
from riskmart.llm import bpe, toxicity
from tests.llm.frames import SCHEMA, sentence
from tests.llm.test_decontaminate import brute as brute_leaks
from tests.llm.test_near_dup import brute as brute_near


def write(spark, folder):
    g = random.Random(2)
    texts = [" ".join(sentence(g, g.choice([6, 80, 400]), 3000)) for _ in range(300)]
    items = [" ".join(sentence(g, 40, 3000)) for _ in range(5)]
    for i in range(0, 300, 7):
        texts[i] = " ".join(["grobble", *texts[i].split(), "grobble"])
    texts[10] = texts[20] = texts[30]
    texts[41] = texts[40] + " more"
    texts[50] = texts[51] + " " + items[2] + " " + texts[52]
    texts += [None, "", None]
    rows = [(i, t, "src0", "en", *("x",) * 8) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{folder}/documents.parquet")
    labels = [(i, 1, int(i % 7 == 0)) for i in range(300)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return texts, items


def test_stages_decide_as_brute_force_does(spark, tmp_path):
    folder = str(tmp_path)
    texts, items = write(spark, folder)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    scored = toxicity.score(docs, spark.read.parquet(f"{folder}/labels.parquet")).collect()
    left = sorted(r["doc_id"] for r in scored if not r["predicted"])
    assert len(left) < 275
    last = {texts[i] or "": i for i in left}
    left = sorted(last.values())
    near = brute_near([texts[i] for i in left])
    left = [left[i] for i, _, _, kept in near if kept]
    leaks = {d for d, *_ in brute_leaks([texts[i] for i in left], items)}
    left = [i for n, i in enumerate(left) if n not in leaks]
    assert 50 not in left and 41 not in left and 10 not in left

    out = corpus_pipeline.run(spark, folder)
    rows = {r["doc_id"]: r for r in out.collect()}
    assert sorted(rows) == left
    assert out.columns[: len(docs.columns)] == [c for c in docs.columns if c not in bpe.RESULT][: len(docs.columns)] or set(docs.columns) <= set(out.columns)
    assert all(rows[i]["text"] == texts[i] for i in left)


def test_stages_keep_the_columns(spark, tmp_path):
    folder = str(tmp_path)
    write(spark, folder)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "decontamination", "byte_bpe"]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, folder).schema == docs.schema
        assert stage(spark, docs.where("false"), folder).count() == 0
