"""Token counts by greedy longest match, in time linear in the text, without building pieces.

The vocabulary is a trie with failure links. If a node's string cannot be followed by the next
byte, the pieces that greedy matching would have cut from its front are certain: their number
is stored with the node, and the link leads to the node of what remains. So each byte is read
once and each step back is paid for by an earlier step forward.

Defined results: null and empty texts count 0; a word that the vocabulary cannot spell is one
unknown token; rows are counted each for itself.
"""

from __future__ import annotations

import re
from collections import deque

import regex
from pyspark.sql import DataFrame

from riskmart.llm.bpe import in_ascii, read_ranks
from riskmart.llm.words import map_texts

MEMO_ENTRIES = 600_000
SCHEMA = "n_words long, n_tokens long, n_unknown long, most_tokens_in_word long"
NONE = -1


class LongestMatch:
    """The automaton: children by node and byte, failure links, popped-token counts."""

    def __init__(self, tokens):
        self.child: dict[int, int] = {}
        final = [False]
        for token in tokens:
            node = 0
            for byte in token:
                key = node << 8 | byte
                if key not in self.child:
                    self.child[key] = len(final)
                    final.append(False)
                node = self.child[key]
            final[node] = True
        self.link = [NONE] * len(final)
        self.popped = [0] * len(final)
        below: dict[int, list[tuple[int, int]]] = {}
        for key, node in self.child.items():
            below.setdefault(key >> 8, []).append((key & 255, node))
        queue = deque([0])
        while queue:
            parent = queue.popleft()
            for byte, node in below.get(parent, ()):
                queue.append(node)
                if final[node]:
                    self.link[node], self.popped[node] = 0, 1
                    continue
                at, count = self.link[parent], self.popped[parent]
                while at != NONE and (at << 8 | byte) not in self.child:
                    count += self.popped[at]
                    at = self.link[at]
                if at != NONE:
                    self.link[node], self.popped[node] = self.child[at << 8 | byte], count

    def count(self, word: bytes) -> int:
        """How many pieces greedy longest match cuts ``word`` into; 0 if it cannot be spelt."""
        child, link, popped = self.child, self.link, self.popped
        node = total = 0
        for byte in word:
            while (following := child.get(node << 8 | byte)) is None:
                total += popped[node]
                node = link[node]
                if node == NONE:
                    return 0
            node = following
        while node:
            total += popped[node]
            node = link[node]
            if node == NONE:
                return 0
        return total


class CountMemo(dict):
    def __init__(self, automaton: LongestMatch):
        self.automaton = automaton

    def __missing__(self, word: str) -> int:
        made = self.automaton.count(word.encode())
        if len(word) <= 64:
            if len(self) >= MEMO_ENTRIES:
                self.clear()
            self[word] = made
        return made


_memos: dict[bytes, CountMemo] = {}


def _counter(content: bytes, pattern: str):
    if content not in _memos:
        _memos[content] = CountMemo(LongestMatch(read_ranks(content)))
    memo = _memos[content]
    every, plain = regex.compile(pattern), re.compile(in_ascii(pattern))

    def work(text: str) -> tuple:
        counts = list(map(memo.__getitem__, (plain if text.isascii() else every).findall(text)))
        unknown = counts.count(0)
        return len(counts), sum(counts) + unknown, unknown, max(1 if unknown else 0, *counts, 0)

    return work


def count_tokens(docs: DataFrame, keys: list[str], vocabulary_file: str, pattern: str, text: str = "text") -> DataFrame:
    """``keys`` of ``docs`` and the token counts of every whole text.

    ``pattern`` cuts a text into words; the vocabulary file (about 1 MB) has a base64 token on
    each line and is sent to each executor once. Rows are independent: no shuffle.
    """
    with open(vocabulary_file, "rb") as file:
        vocabulary = docs.sparkSession.sparkContext.broadcast(file.read())
    return map_texts(docs, SCHEMA, lambda: _counter(vocabulary.value, pattern), keys, text)
