import random

from hypothesis import given, settings
from hypothesis import strategies as st

from riskmart.llm import words


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["a", "B", "ab", "Ab", "é", "x1", "-", " ", "\t", "\n ", "日"]), max_size=40))
def test_hashes_tell_words_apart_and_nothing_else(parts):
    text = "".join(parts).encode()
    split = text.lower().split()
    hashes = words.between_spaces(text).tolist()
    assert len(hashes) == len(split)
    for i, a in enumerate(split):
        for j, b in enumerate(split):
            assert (hashes[i] == hashes[j]) == (a == b)
        assert words.between_spaces(a).tolist() == [hashes[i]]


def test_chunks_change_nothing(monkeypatch):
    g = random.Random(1)
    text = " ".join("x" * g.choice([1, 5, 40_000, 70_000, 3]) + str(g.randrange(50)) for _ in range(40)).encode()
    whole = words.between_spaces(text).tolist()
    assert whole == [words.between_spaces(w).tolist()[0] for w in text.split()]
    assert len(set(whole)) == len(set(text.split()))
    assert words.between_spaces(b"").tolist() == words.between_spaces(b"  \n").tolist() == []


def test_no_collision_among_many_words():
    text = " ".join(f"{a}{b}{c}" for a in "abcdefghij" for b in range(100) for c in ("", "ing", "ed", "é")).encode()
    hashes = words.between_spaces(text)
    assert len(set(hashes.tolist())) == len(set(text.split()))
    assert len(set((hashes >> 32).tolist())) > 0.99 * len(set(text.split()))


def test_long_words_of_two_letters_do_not_collide():
    """A Thue-Morse word and its complement, which collide under any polynomial modulo a power of two."""
    for length in (512, 1024, 4096, 65_536):
        word = "".join("ab"[i.bit_count() & 1] for i in range(length))
        other = word.translate({97: 98, 98: 97})
        hashes = words.between_spaces(f"{word} x {other} {word.upper()}".encode()).tolist()
        assert hashes[0] != hashes[2] and hashes[0] == hashes[3]
        assert words.between_spaces(word.encode()).tolist() == hashes[:1]
