import random

import numpy as np
import public_tokenizers as tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from riskmart.llm import bpe, packing
from tests.llm.frames import documents, nothing, rows_as_given

FILE = tokenizers.path("byte_bpe_multi_50k.tiktoken")


def plain_best_fit(sizes, room):
    """The same rule with a scan of all open rows."""
    rows, left = [], []
    for piece in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        fitting = [r for r in range(len(rows)) if left[r] >= sizes[piece]]
        least = min((left[r] for r in fitting), default=None)
        if least is None:
            rows.append([])
            left.append(room)
            row = len(rows) - 1
        else:
            row = [r for r in fitting if left[r] == least][-1]
        rows[row].append(piece)
        left[row] -= sizes[piece]
    return rows, left


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 40).flatmap(lambda room: st.tuples(st.just(room), st.lists(st.integers(1, room), max_size=60))))
def test_tree_search_equals_a_scan(case):
    room, sizes = case
    rows = packing.best_fit_decreasing(sizes, room)
    want, left = plain_best_fit(sizes, room)
    assert sorted(i for row in rows for i in row) == list(range(len(sizes)))
    assert all(sum(sizes[i] for i in row) <= room for row in rows)
    # Rows of equal room are interchangeable: the rooms that remain are the same.
    assert sorted(room - sum(sizes[i] for i in row) for row in rows) == sorted(left)
    assert len(rows) == len(want)


def test_round_trip(spark):
    g = random.Random(4)
    texts = [None, "", "a", "Hello world"] + [" ".join(f"wörd{g.randrange(999)}" for _ in range(g.randrange(1, 400))) for _ in range(60)]
    texts += ["long " * 3000]
    docs = documents(spark, texts)
    rows = packing.pack(docs, FILE, tokenizers.PATTERN, row_tokens=256, block_tokens=5000)
    wanted = {r["doc_id"]: r["ids"] for r in bpe.encode(docs, FILE, tokenizers.PATTERN).collect() if r["ids"]}
    for r in rows.collect():
        ids, places = np.frombuffer(bytes(r["ids"]), "<u2"), np.frombuffer(bytes(r["position_ids"]), "<u2")
        assert len(ids) == len(places) == 256
        assert r["cu_seqlens"][0] == 0 and r["cu_seqlens"][-1] == r["n_tokens"] <= 256
        assert (ids[r["n_tokens"] :] == 50256).all() and not places[r["n_tokens"] :].any()
        for start, stop in zip(r["cu_seqlens"], r["cu_seqlens"][1:]):
            assert places[start:stop].tolist() == list(range(stop - start))
        assert len(r["doc_ids"]) == len(r["pieces"]) == len(r["cu_seqlens"]) - 1
    got = {r["doc_id"]: np.frombuffer(bytes(r["ids"]), "<u2").tolist() for r in packing.unpack(rows).collect()}
    assert got == wanted
    assert packing.pack(nothing(spark), FILE, tokenizers.PATTERN).count() == 0


def test_repeated_rows_are_packed_each(spark):
    docs = documents(spark, ["same text"] * 3).union(documents(spark, ["same text"] * 3))
    rows = packing.pack(docs, FILE, tokenizers.PATTERN, row_tokens=16)
    assert sum(len(r["doc_ids"]) for r in rows.collect()) == 6


def test_repeated_and_null_keys_come_back_each(spark):
    pairs = [(1, "hello world"), (1, "hello world"), (1, "other words"), (None, "no key"), (None, "no key"), (2, "long " * 90), (2, "long " * 90)]
    docs = rows_as_given(spark, pairs)
    rows = packing.pack(docs, FILE, tokenizers.PATTERN, row_tokens=16)
    got = sorted((r["doc_id"] or 0, bytes(r["ids"])) for r in packing.unpack(rows).collect())
    wanted = {r["text"]: np.array(r["ids"], "<u2").tobytes() for r in bpe.encode(docs.select("doc_id", "text"), FILE, tokenizers.PATTERN).collect()}
    assert got == sorted((k or 0, wanted[t]) for k, t in pairs)


def test_written_matrix(spark, tmp_path):
    rows = packing.pack(documents(spark, ["some text"]), FILE, tokenizers.PATTERN, row_tokens=8)
    packing.write_matrix(rows, str(tmp_path / "rows"))
    assert spark.read.parquet(str(tmp_path / "rows")).schema["ids"] == rows.schema["ids"]
