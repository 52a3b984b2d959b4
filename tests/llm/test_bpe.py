import hashlib
import random
import time

import numpy as np
import public_tokenizers as tokenizers
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from riskmart.llm import bpe
from tests.llm.frames import documents, nothing

FILE = tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def codec():
    with open(FILE, "rb") as file:
        return bpe.Codec(bpe.read_ranks(file.read()), tokenizers.PATTERN)


@pytest.fixture(scope="module")
def known(codec):
    return tiktoken.Encoding("own", pat_str=tokenizers.PATTERN, mergeable_ranks=codec.ranks, special_tokens={})


@settings(max_examples=300, deadline=None)
@given(text=st.text(max_size=60) | st.text(alphabet="aeithnörs 1.'\n", max_size=200))
def test_encoding_equals_the_library(codec, known, text):
    ids = codec.encode(text)
    assert ids == known.encode_ordinary(text)
    assert codec.decode(ids) == text.encode()


def test_long_pieces(codec, known):
    generator = random.Random(3)
    texts = ["a" * 5000, "ab" * 3001, "é" * 777, " " * 1000 + "x", "=" * 4097, "".join(generator.choices("abcdé", k=6000))]
    for text in texts:
        assert codec.encode(text) == known.encode_ordinary(text)


@settings(max_examples=200, deadline=None)
@given(st.binary(max_size=40), st.binary(max_size=40))
def test_joining_is_the_monoid_operation(codec, left, right):
    assert codec.join(codec.merge(left), codec.merge(right)) == codec.merge(left + right)
    assert codec.merge_long(left + right) == codec.merge(left + right)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.binary(max_size=16), max_size=30))
def test_many_words_at_once(codec, words):
    assert codec.merge_many(words) == [codec.merge(w) for w in words]


def test_every_codepoint_splits_alike(codec, known):
    for start in range(0, 0x11000, 64):
        text = " b".join(f"a{chr(c)}" for c in range(start, start + 64) if not 0xD800 <= c < 0xE000)
        assert codec.encode(text) == known.encode_ordinary(text)


def test_later_letters_and_numbers_are_none_to_the_library(codec, known):
    text = "\U0003edd8\ub000 a\u0558b 1\U00011de01 x\U0003d000"
    assert codec.encode(text) == known.encode_ordinary(text)
    assert codec.decode(codec.encode(text)) == text.encode()
    assert codec.words("\U0003edd8\ub000") == ["\U0003edd8", "\ub000"]


def test_classes_are_those_of_the_library():
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    for name in (r"\p{L}", r"\p{N}", r"\s"):
        library = tiktoken.Encoding("class", pat_str=f"{name}+", mergeable_ranks={bytes([i]): i for i in range(256)}, special_tokens={})
        known = bytes(library.encode_ordinary(every)).decode()
        assert "".join(bpe.Codec({}, f"{name}+").words(every)) == known


ODD = "aZé中1٣ \n\t 　''stmdrevl!?́\U0003edd8\U0001f600\x1c\x85\r\x00"


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(max_size=30) | st.text(alphabet=ODD, max_size=30), max_size=12), st.integers(0, 3))
def test_words_of_all_texts_at_once(codec, texts, skipped):
    column = pa.array(["left out"] * skipped + texts + [""], pa.large_string()).slice(skipped)
    words, spans = codec.words_of(column)
    each = [[w.encode() for w in codec.words(t)] for t in [*texts, ""]]
    assert words.to_pylist() == [w for ws in each for w in ws]
    assert np.diff(spans).tolist() == [len(ws) for ws in each]


def test_endings_after_a_quote(codec):
    for text in ("it's", "'s", " 's", "\n's", "''s", "x'", "x'r", "x're", "x'rev", "we'll'd've", "1'm 2'T", "'l", "a'sb'mé", "é'll中"):
        words, _ = codec.words_of(pa.array([text, "e l"], pa.large_string()))
        assert words.to_pylist() == [w.encode() for t in (text, "e l") for w in codec.words(t)]


def test_another_pattern_is_searched_for():
    ranks = {bytes([i]): i for i in range(256)} | {b"ab": 256}
    own = bpe.Codec(ranks, r"[a-z]+")
    batch = pa.record_batch({"t": ["ab 1 abc", None, "", "1", "é b"]})
    [(same, ids)] = bpe.ids_of_texts(iter([batch]), "t", own, bpe.IdMemo(own, "<u2", 10))
    assert [np.frombuffer(i, "<u2").tolist() for i in ids] == [[256, 256, 99], [], [], [], [98]] and same is batch


@settings(max_examples=60, deadline=None)
@given(
    st.lists(st.lists(st.none() | st.text(alphabet="abthe '\n1é", max_size=90), max_size=5), max_size=5),
    st.integers(1, 400),
    st.integers(1, 60),
)
def test_ids_of_batches(codec, known, lists, at_once, entries):
    batches = [pa.record_batch({"t": pa.array(texts, pa.string())}) for texts in lists]
    memo, usual = bpe.IdMemo(codec, "<u4", entries), bpe.BYTES_AT_ONCE
    bpe.BYTES_AT_ONCE = at_once
    try:
        got = [[np.frombuffer(i, "<u4").tolist() for i in ids] for _, ids in bpe.ids_of_texts(iter(batches), "t", codec, memo)]
    finally:
        bpe.BYTES_AT_ONCE = usual
    assert got == [[known.encode_ordinary(t or "") for t in texts] for texts in lists]


def test_pairs_that_share_a_place():
    tokens = [bytes([i]) for i in range(256)] + [bytes([i, j]) for i in range(200) for j in range(200)]
    own = bpe.Codec({t: i for i, t in enumerate(tokens)}, tokenizers.PATTERN)
    left, right = (x.ravel() for x in np.meshgrid(np.arange(256), np.arange(256), indexing="ij"))
    wanted = np.where((left < 200) & (right < 200), 256 + 200 * left + right, bpe._NO_RANK)
    assert (own._rank_of_pairs(left, right) == wanted).all()


def test_ids_cost_less_than_a_search_for_words(codec):
    g = random.Random(5)
    some = ["".join(g.choices("aeinrst", k=g.randrange(2, 9))) for _ in range(2000)]
    texts = [" ".join(g.choices(some, k=400)) for _ in range(1000)]
    batch = pa.record_batch({"t": texts})

    def best(work):
        took = []
        for _ in range(3):
            start = time.process_time()
            work()
            took.append(time.process_time() - start)
        return min(took)

    memo = bpe.IdMemo(codec, "<u2", bpe.MEMO_ENTRIES)
    ids = best(lambda: [list(ids) for _, ids in bpe.ids_of_texts(iter([batch]), "t", codec, memo)])
    assert ids < best(lambda: [codec.words(t) for t in texts])


def test_frame(spark, known):
    texts = [None, "", "Hello world", "Hello world", "é" * 3000, "It's 100 %\n\n  ok\t"]
    every = tuple(bpe.RESULT)
    rows = bpe.encode(documents(spark, texts), FILE, tokenizers.PATTERN, results=every).collect()
    for row, text in zip(sorted(rows, key=lambda r: r["doc_id"]), texts, strict=True):
        ids = known.encode_ordinary(text or "")
        assert row["ids"] == ids and row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert bytes(row["decoded"]) == (text or "").encode()
        assert row["decoded_sha256"] == hashlib.sha256((text or "").encode()).hexdigest()
        assert row["score"] == "x" and row["text"] == text
    assert bpe.encode(nothing(spark), FILE, tokenizers.PATTERN).count() == 0
