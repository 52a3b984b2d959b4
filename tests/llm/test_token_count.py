import base64

import public_tokenizers as tokenizers
import regex
from hypothesis import given, settings
from hypothesis import strategies as st

from riskmart.llm.bpe import read_ranks
from riskmart.llm.token_count import LongestMatch, count_tokens
from tests.llm.frames import documents, nothing

FILE = tokenizers.path("byte_bpe_multi_50k.tiktoken")


def pieces(word: bytes, vocabulary) -> int:
    """Greedy longest match by trying every length; 0 if a rest has no piece."""
    count = at = 0
    while at < len(word):
        length = next((n for n in range(len(word) - at, 0, -1) if word[at : at + n] in vocabulary), 0)
        if not length:
            return 0
        at, count = at + length, count + 1
    return count


@settings(max_examples=300, deadline=None)
@given(
    st.sets(st.text("abc", min_size=1, max_size=5).map(str.encode), max_size=12),
    st.text("abcd", max_size=24).map(str.encode),
)
def test_automaton_equals_greedy_match(vocabulary, word):
    assert LongestMatch(sorted(vocabulary)).count(word) == pieces(word, vocabulary)


def test_frame(spark, tmp_path):
    texts = [None, "", "Hello wonderful world", "Hello", "Hello", "x" * 20000, "é ß 日本 100%"]
    with open(FILE, "rb") as file:
        vocabulary = read_ranks(file.read())
    rows = {r["doc_id"]: r for r in count_tokens(documents(spark, texts), ["doc_id", "labels"], FILE, tokenizers.PATTERN).collect()}
    for i, text in enumerate(texts):
        words = regex.findall(tokenizers.PATTERN, text or "")
        counts = [pieces(w.encode(), vocabulary) for w in words]
        assert (rows[i]["n_words"], rows[i]["n_tokens"], rows[i]["n_unknown"]) == (len(words), sum(counts), 0)
        assert rows[i]["most_tokens_in_word"] == max(counts, default=0)
    assert count_tokens(nothing(spark), ["doc_id"], FILE, tokenizers.PATTERN).count() == 0

    small = tmp_path / "small"
    small.write_bytes(b"".join(base64.b64encode(t) + b" %d\n" % i for i, t in enumerate([b"a", b"ab", b"bc"])))
    row = count_tokens(documents(spark, ["abbc abq"]), ["doc_id"], str(small), r"\S+").first()
    assert (row["n_words"], row["n_tokens"], row["n_unknown"]) == (2, 3, 1)
