"""Byte-level BPE encoding and decoding as a monoid tree reduction.

The merge rule is the usual one: of all neighbouring pairs whose concatenation has a rank, the
pair of the lowest rank merges first, the leftmost of equals. Two facts make the result of
halves reusable, whatever the vocabulary:

* *Parts stay valid.* In a finished encoding no merge has crossed a token border, so the
  encoding of the bytes of any run of its tokens is that run.
* *Neighbours decide.* If every two neighbouring tokens encode to themselves, so does the whole
  sequence: the first merge across a border would be the next merge of that pair alone, too.

Pattern matches of up to ``LEAF_BYTES``, which are nearly all of prose, are leaves: looked up or merged
in bulk. Longer ones are encoded by halves. Two encodings are joined by re-encoding a window of ``k``
tokens on either side of the border; if the tokens next to the window are compatible with its
ends, all tokens outside provably stay as they are, else ``k`` doubles. Split points are powers
of two, so long runs of one byte meet aligned. Decoding concatenates up the same tree.

Defined results: a null text counts as empty; an empty text has no tokens; other columns, also
such as are called like a result, are not touched, results replace columns of their name.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import re
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

LEAF_BYTES = 32
SHORT_BYTES = 48
MEMO_ENTRIES = 150_000
MEMO_CHARACTERS = 64
WORDS_AT_ONCE = 4096  # their matrices stay in the cache
_NO_RANK = (1 << 31) - 1
_NO_PAIR = np.iinfo(np.int64).min
_MIX = 0x9E3779B97F4A7C15


def read_ranks(content: bytes) -> dict[bytes, int]:
    """Ranks of a file with a base64 token and its rank on each line."""
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in content.splitlines() if line)}


# Letters and numbers of Unicode 17 and 18, which ``regex`` knows as such; to the library, which has Unicode 16,
# they are neither.
LATER = """558 58B-58C 88F C5C CDC 208F 209D-209F A7CE-A7CF A7D2 A7D4 A7DD A7E2 A7F1 AB6C-AB6D 107BB-107BF 10940-10959
10EC5-10EC7 10ED9-10EEE 11B0A 11DB0-11DDB 11DE0-11DE9 11DF1 1246F 12475-1247F 12550-12686 16EA0-16EB8 16EBB-16ED3
16FF2-16FF6 187F8-187FF 18CD6-18CDA 18D09-18D20 18D80-18DF2 18E00-19191 191A0-191D2 1B123-1B128 1B168 1D6A6
1DF1F-1DF24 1DF2B-1DF81 1DF90-1DF96 1DFCD-1DFFF 1E6C0-1E6DE 1E6E0-1E6E2 1E6E4-1E6E5 1E6E7-1E6ED 1E6F0-1E6F4
1E6FE-1E6FF 2B73A-2B73F 2B81E 2CEA2-2CEAD 323B0-33479 3D000-3FC3F"""
_is_later = np.zeros(0x110000, bool)
for _first, _, _last in (r.partition("-") for r in LATER.split()):
    _is_later[int(_first, 16) : int(_last or _first, 16) + 1] = True

# What the classes of a pattern hold of ASCII.
ASCII_CLASSES = {r"\p{L}": "A-Za-z", r"\p{N}": "0-9", r"\s": r" \t\n\x0b\x0c\r"}


def in_ascii(pattern: str) -> str:
    """A pattern that matches ASCII texts as the given one does, in terms the standard module has."""
    out, inside, at = [], False, 0
    while at < len(pattern):
        name = next((c for c in (*ASCII_CLASSES, r"\S") if pattern.startswith(c, at)), None)
        if name == r"\S":
            out.append(f"[^{ASCII_CLASSES[chr(92) + 's']}]")
        elif name:
            out.append(ASCII_CLASSES[name] if inside else f"[{ASCII_CLASSES[name]}]")
        else:
            name = pattern[at : at + 2] if pattern[at] == chr(92) else pattern[at]
            inside = name == "[" or inside and name != "]"
            out.append(name)
        at += len(name)
    return "".join(out)


# The pattern whose matches ``word_starts`` finds without a search: they cover a text and follow from what its characters are.
USUAL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_SPACE, _LETTER, _NUMBER, _SYMBOL = range(4)


@functools.cache
def character_kinds() -> np.ndarray:
    """What each code point is to the usual pattern."""
    every = "".join(map(chr, range(0xD800))) + "\ufffd" * 0x800 + "".join(map(chr, range(0xE000, 0x110000)))
    kinds = np.full(0x110000, _SYMBOL, np.uint8)
    for kind, name in ((_SPACE, r"\s"), (_LETTER, r"\p{L}"), (_NUMBER, r"\p{N}")):
        for m in regex.finditer(f"{name}+", every):
            kinds[m.start() : m.end()] = kind
    kinds[_is_later] = _SYMBOL
    return kinds


def _kinds_of(data: np.ndarray) -> np.ndarray:
    """The kind of each byte's character in UTF-8."""
    known = character_kinds()
    kinds = known[:256][data]
    first = np.flatnonzero(data >= 0xC0)
    if len(first):
        size = 2 + (data[first] >= 0xE0) + (data[first] >= 0xF0)
        code = data[first].astype(np.int64) & (0x7F >> size)
        places = [np.minimum(first + i, len(data) - 1) for i in range(4)]
        for i in (1, 2, 3):
            code = np.where(size > i, code << 6 | data[places[i]] & 0x3F, code)
        kind = known[np.minimum(code, len(known) - 1)]
        for i, place in enumerate(places):
            kinds[place[size > i]] = kind[size > i]
    return kinds


def word_starts(data: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """Where the matches of the usual pattern start in the bytes of texts, of which none is empty and ``texts`` has the starts.

    A match is a run of one kind with the space before it. Of spaces before something else the last is a
    match of its own, or goes with what follows if it is a blank. A quote that starts a match takes an ending with it.
    """
    kinds = _kinds_of(data)
    first = np.zeros(len(data) + 3, bool)  # a text's first byte; what lies after the data belongs to no text
    first[texts] = first[len(data) :] = True
    starts = first.copy()
    starts[1 : len(data)] |= kinds[1:] != kinds[:-1]

    is_space = kinds == _SPACE
    after = np.flatnonzero(is_space[:-1] & ~is_space[1:]) + 1
    after = after[~first[after]]
    last = after - 1
    for _ in range(3):  # from its last byte to its first
        last = last - ((data[last] & 0xC0) == 0x80)
    starts[last] = True
    starts[after[data[last] == ord(" ")]] = False

    quotes = np.flatnonzero(data == ord("'"))
    quotes = quotes[starts[quotes] & ~first[quotes + 1]]
    one, two = data[quotes + 1], data[np.minimum(quotes + 2, len(data) - 1)]
    short = np.isin(one, list(b"stmd"))
    long = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
    long &= ~first[quotes + 2]
    starts[quotes[short | long] + 1] = False
    starts[quotes[short] + 2] = True
    starts[quotes[long] + 3] = True
    return np.flatnonzero(starts[: len(data)])


class Codec:
    """Encoder and decoder of one vocabulary; memos are bounded and hold no text beyond a word."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.pattern = regex.compile(pattern)
        self.ascii_pattern = re.compile(in_ascii(pattern))
        self.compatible_memo: dict[tuple[int, int], bool] = {}
        pairs = {
            ranks[token[:i]] << 32 | ranks[token[i:]]: rank
            for token, rank in ranks.items()
            for i in range(1, len(token))
            if token[:i] in ranks and token[i:] in ranks
        }
        # A hash table of pairs, at most a quarter full; a pair whose place is taken goes to the next that is free.
        self._shift = 64 - max(4, (4 * len(pairs)).bit_length())
        self._pairs = np.full(1 << 64 - self._shift, _NO_PAIR)
        self._pair_ranks = np.full(len(self._pairs), _NO_RANK)
        keys, made = np.array(list(pairs), np.int64), np.array(list(pairs.values()), np.int64)
        at = self._place(keys)
        while len(keys):
            free = self._pairs[at] == _NO_PAIR
            self._pairs[at[free]] = keys[free]
            put = self._pairs[at] == keys
            self._pair_ranks[at[put]] = made[put]
            keys, made, at = keys[~put], made[~put], at[~put] + 1 & len(self._pairs) - 1
        self._of_byte = np.array([ranks.get(bytes([i]), -1) for i in range(256)], np.int64)
        self._of_bytes = np.full(1 << 16, _NO_RANK, np.int64)
        for token, rank in ranks.items():
            if len(token) == 2:
                self._of_bytes[token[0] << 8 | token[1]] = rank

    def words(self, text: str) -> list[str]:
        """The matches of the pattern."""
        if text.isascii():
            return self.ascii_pattern.findall(text)
        codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        later = _is_later[codes]
        if not later.any():
            return self.pattern.findall(text)
        alike = np.where(later, np.uint32(0xFFFD), codes).tobytes().decode("utf-32-le")  # a symbol to both
        return [text[m.start() : m.end()] for m in self.pattern.finditer(alike)]

    def words_of(self, texts: pa.LargeStringArray) -> tuple[pa.BinaryArray, np.ndarray]:
        """The words of all texts, none null, one after another, and where each text's words start and the last's end."""
        if self.pattern.pattern != USUAL:
            each = [self.words(text) for text in texts.to_pylist()]
            words = pa.array([word.encode() for words in each for word in words], pa.binary())
            return words, np.cumsum([0, *map(len, each)])
        borders = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        content = texts.buffers()[2]
        if borders[0] == borders[-1]:
            return pa.array([], pa.binary()), np.zeros(len(borders), np.int64)
        content = content.slice(borders[0], borders[-1] - borders[0])
        borders = borders - borders[0]
        starts = word_starts(np.frombuffer(content, np.uint8), borders[:-1][np.diff(borders) > 0])
        places = pa.py_buffer(np.append(starts, borders[-1]).astype(np.int32))
        return pa.BinaryArray.from_buffers(pa.binary(), len(starts), [None, places, content]), np.searchsorted(starts, borders)

    # --- leaves ---------------------------------------------------------------------

    def merge(self, data: bytes) -> list[int]:
        """Plain merging of few bytes: scan for the lowest rank again and again."""
        ranks, none = self.ranks, len(self.ranks) + 1
        parts = [data[i : i + 1] for i in range(len(data))]
        costs = [ranks.get(data[i : i + 2], none) for i in range(len(data) - 1)]
        while costs:
            lowest = min(costs)
            if lowest == none:
                break
            i = costs.index(lowest)
            parts[i] += parts.pop(i + 1)
            costs.pop(i)
            if i < len(costs):
                costs[i] = ranks.get(parts[i] + parts[i + 1], none)
            if i:
                costs[i - 1] = ranks.get(parts[i - 1] + parts[i], none)
        return [ranks[p] for p in parts]

    def merge_long(self, data: bytes) -> list[int]:
        """The same result for many bytes, with a heap of the possible merges."""
        ranks, n = self.ranks, len(data)
        start, end, before, after = list(range(n)), list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [(ranks[data[i : i + 2]], i, i + 1, i + 2) for i in range(n - 1) if data[i : i + 2] in ranks]
        heapify(heap)
        while heap:
            _, i, j, stop = heappop(heap)
            if start[i] < 0 or after[i] != j or start[j] < 0 or end[j] != stop or end[i] != start[j]:
                continue  # one of the two has changed since
            end[i], after[i], start[j] = end[j], after[j], -1
            if after[i] < n:
                before[after[i]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < n and (rank := ranks.get(data[start[a] : end[b]])) is not None:
                    heappush(heap, (rank, a, b, end[b]))
        out, i = [], 0
        while i < n:
            out.append(ranks[data[start[i] : end[i]]])
            i = after[i]
        return out

    def _place(self, pairs: np.ndarray) -> np.ndarray:
        return (pairs.astype(np.uint64) * np.uint64(_MIX) >> np.uint64(self._shift)).astype(np.int64)

    def _rank_of_pairs(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        pairs = left << 32 | right
        at = self._place(pairs)
        found = self._pairs[at]
        out = np.where(found == pairs, self._pair_ranks[at], _NO_RANK)
        more = np.flatnonzero((found != pairs) & (found != _NO_PAIR))
        while len(more):
            at[more] = at[more] + 1 & len(self._pairs) - 1
            found = self._pairs[at[more]]
            hit = found == pairs[more]
            out[more[hit]] = self._pair_ranks[at[more[hit]]]
            more = more[~hit & (found != _NO_PAIR)]
        return out

    def _merge_block(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The tokens of words one after another, and how many each has; a round merges the next pair of every word.

        A column is a word and a row a place in it. Tokens stay at their first byte and know the places before and after;
        the last row stands for what is outside of a word.
        """
        n, width = len(words), max(map(len, words))
        sizes = np.array([len(w) for w in words])
        data = np.frombuffer(b"".join([w.ljust(width, b"\0") for w in words]), np.uint8).reshape(n, width).T
        places = np.arange(width + 1)[:, None]
        inside = places < sizes
        tokens = np.full((width + 1, n), _NO_RANK)
        tokens[:width] = self._of_byte[data]
        tokens[~inside] = _NO_RANK
        bits = width.bit_length()
        order = np.full((width + 1, n), _NO_RANK << bits)  # the rank of a place's pair, then the place
        order[: width - 1] = self._of_bytes[data[:-1].astype(np.uint16) << 8 | data[1:]] << bits
        order[np.maximum(sizes - 1, 0), np.arange(n)] = _NO_RANK << bits
        order[~inside] = _NO_RANK << bits
        order |= places
        after = np.where(places + 1 < sizes, places + 1, width)
        before = np.repeat(np.where(places > 0, places - 1, width), n, 1)
        tokens, order, after, before, inside = (x.ravel() for x in (tokens, order, after, before, inside))
        while True:
            least = order.reshape(width + 1, n)[:width].min(0)
            word = np.flatnonzero(least >> bits != _NO_RANK)
            if not len(word):
                break
            least = least[word]
            rank, place = least >> bits, least & (1 << bits) - 1
            here = place * n + word
            gone = after[here] * n + word
            right, left = after[gone], before[here]
            there, back = right * n + word, left * n + word
            inside[gone] = False
            order[gone] = _NO_RANK << bits
            tokens[here], after[here], before[there] = rank, right, place
            order[here] = self._rank_of_pairs(rank, tokens[there]) << bits | place
            order[back] = self._rank_of_pairs(tokens[back], rank) << bits | left
        inside = inside.reshape(width + 1, n).T
        return tokens.reshape(width + 1, n).T[inside], inside.sum(1)

    def merge_blocks(self, numbers, words: list[bytes]) -> Iterator[tuple[list, np.ndarray, np.ndarray]]:
        """The words that are not empty by length, in blocks: their numbers, tokens, and how many each has."""
        lengths = np.array(list(map(len, words)), np.int64)
        by_length = np.argsort(lengths, kind="stable")[np.count_nonzero(lengths == 0) :].tolist()
        for start in range(0, len(by_length), WORDS_AT_ONCE):
            block = by_length[start : start + WORDS_AT_ONCE]
            yield [numbers[i] for i in block], *self._merge_block([words[i] for i in block])

    def merge_many(self, words: list[bytes]) -> list[list[int]]:
        """``merge`` of many short words at once."""
        out: list[list[int]] = [[] for _ in words]
        for numbers, tokens, sizes in self.merge_blocks(range(len(words)), words):
            ids, ends = tokens.tolist(), np.cumsum(sizes).tolist()
            for i, first, stop in zip(numbers, [0, *ends], ends):
                out[i] = ids[first:stop]
        return out

    # --- the tree -------------------------------------------------------------------

    def compatible(self, left: int, right: int) -> bool:
        """Whether two tokens side by side encode to themselves."""
        known = self.compatible_memo.get((left, right))
        if known is None:
            if len(self.compatible_memo) >= MEMO_ENTRIES:
                self.compatible_memo.clear()
            data = self.bytes_of[left] + self.bytes_of[right]
            known = self._window(data) == [left, right]
            self.compatible_memo[left, right] = known
        return known

    def _window(self, data: bytes) -> list[int]:
        return self.merge(data) if len(data) <= SHORT_BYTES else self.merge_long(data)

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of two texts, from the encodings of each."""
        if not left or not right:
            return left or right
        if self.compatible(left[-1], right[0]):
            return left + right
        k = 1
        while True:
            keep, rest = left[:-k], right[k:]
            window = self._window(self.decode(left[-k:] + right[:k]))
            if (not keep or self.compatible(keep[-1], window[0])) and (
                not rest or self.compatible(window[-1], rest[0])
            ):
                return keep + window + rest
            k *= 2

    def encode_tree(self, data: bytes) -> list[int]:
        """Token ids of bytes, without regard to words."""
        if len(data) <= LEAF_BYTES:
            return self.merge(data)
        middle = 1 << ((len(data) - 1).bit_length() - 1)
        return self.join(self.encode_tree(data[:middle]), self.encode_tree(data[middle:]))

    def encode_piece(self, piece: bytes) -> list[int]:
        """A word of the pattern: a token as a whole, else by merging."""
        whole = self.ranks.get(piece)
        return self.encode_tree(piece) if whole is None else [whole]

    def encode(self, text: str | None) -> list[int]:
        return [i for piece in self.words(text or "") for i in self.encode_piece(piece.encode())]

    def decode(self, ids: list[int]) -> bytes:
        """The bytes of token ids, concatenated up a tree."""
        if len(ids) <= 1024:
            return b"".join([self.bytes_of[i] for i in ids])
        middle = len(ids) // 2
        return self.decode(ids[:middle]) + self.decode(ids[middle:])


class WordMemo(dict):
    """The ids of words in one form, made when first asked for; emptied when it holds too many.

    ``form`` has the bytes of each id and ``between`` stands between two. ``learn`` makes
    the forms of all new words of some texts at once, short ones in bulk.
    """

    def __init__(self, codec: Codec, form: list[bytes], between: bytes, entries: int):
        self.codec, self.form, self.between, self.entries = codec, form, between, entries

    def _made(self, word: str, ids: list[int]) -> bytes:
        form = self.form
        made = self.between.join([form[i] for i in ids])
        if len(word) <= MEMO_CHARACTERS:
            self[word] = made
        return made

    def __missing__(self, word: str) -> bytes:
        return self._made(word, self.codec.encode_piece(word.encode()))

    def learn(self, texts: list[list[str]]) -> None:
        if len(self) >= self.entries:
            self.clear()
        new = set().union(*texts).difference(self.keys())
        ranks, short, data = self.codec.ranks, [], []
        for word in new:
            piece = word.encode()
            if len(piece) <= LEAF_BYTES and piece not in ranks:
                short.append(word)
                data.append(piece)
            elif len(word) <= MEMO_CHARACTERS:
                self[word]
        for word, ids in zip(short, self.codec.merge_many(data), strict=True):
            self._made(word, ids)


CHARACTERS_AT_ONCE = 2_000_000
BYTES_AT_ONCE = 4_000_000


def by_words(values, find, memo: WordMemo) -> Iterator[list[str]]:
    """The words of each text (null: none), with the memo ready for them."""
    texts: list[list[str]] = []
    characters = 0
    for value in values:
        text = value.as_py() or ""
        texts.append(find(text))
        characters += len(text)
        if characters >= CHARACTERS_AT_ONCE:
            memo.learn(texts)
            yield from texts
            texts, characters = [], 0
    memo.learn(texts)
    yield from texts


class IdMemo(dict):
    """The ids of words, given as bytes, in a number type of numpy; emptied when it holds too many."""

    def __init__(self, codec: Codec, kind: str, entries: int):
        self.codec, self.kind, self.entries = codec, kind, entries

    def of(self, words: list[bytes]) -> list[bytes]:
        """The ids of each of some different words; short new ones are made in bulk."""
        if len(self) >= self.entries:
            self.clear()
        made = list(map(self.get, words))
        ranks, short = self.codec.ranks, []
        for i in [i for i, ids in enumerate(made) if ids is None]:
            word = words[i]
            if len(word) <= LEAF_BYTES and word not in ranks:
                short.append(i)
            else:
                made[i] = np.array(self.codec.encode_piece(word), self.kind).tobytes()
                if len(word) <= MEMO_CHARACTERS:
                    self[word] = made[i]
        width = np.dtype(self.kind).itemsize
        for numbers, tokens, sizes in self.codec.merge_blocks(short, [words[i] for i in short]):
            ids, ends = tokens.astype(self.kind).tobytes(), (np.cumsum(sizes) * width).tolist()
            for i, first, stop in zip(numbers, [0, *ends], ends):
                self[words[i]] = made[i] = ids[first:stop]
        return made


def ids_of_texts(batches: Iterator[pa.RecordBatch], text: str, codec: Codec, memo: IdMemo) -> Iterator[tuple[pa.RecordBatch, Iterator[bytes]]]:
    """Each batch with the ids of its texts (null: none); a word is looked up once for all its places in some batches."""
    waiting, size = [], 0
    for batch in batches:
        waiting.append((batch, batch.column(text).cast(pa.large_string()).fill_null("")))
        size += waiting[-1][1].nbytes
        if size >= BYTES_AT_ONCE:
            yield from _ids_of_batches(waiting, codec, memo)
            waiting, size = [], 0
    if waiting:
        yield from _ids_of_batches(waiting, codec, memo)


def _ids_of_batches(batches: list[tuple[pa.RecordBatch, pa.LargeStringArray]], codec: Codec, memo: IdMemo):
    every = [texts for _, texts in batches]
    ids = _ids_of(every[0] if len(every) == 1 else pa.concat_arrays(every), codec, memo)
    for batch, texts in batches:
        yield batch, islice(ids, len(texts))


def _ids_of(texts: pa.LargeStringArray, codec: Codec, memo: IdMemo) -> Iterator[bytes]:
    start = 0
    while start < len(texts):
        borders = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        stop = max(start + 1, int(np.searchsorted(borders, borders[start] + 2 * BYTES_AT_ONCE, "right")) - 1)
        words, spans = codec.words_of(texts.slice(start, stop - start))
        start = stop
        if not len(words):
            yield from [b""] * (len(spans) - 1)
            continue
        places = words.dictionary_encode()
        known = places.dictionary
        content, ends = known.buffers()[2].to_pybytes(), np.frombuffer(known.buffers()[1], np.int32)[: len(known) + 1].tolist()
        forms = memo.of([content[a:b] for a, b in zip(ends, ends[1:])])
        joined = pa.array(forms, pa.large_binary()).take(places.indices)
        ids, ends = joined.buffers()[2].to_pybytes(), np.frombuffer(joined.buffers()[1], np.int64)[spans].tolist()
        yield from (ids[a:b] for a, b in zip(ends, ends[1:]))


_codecs: dict[tuple[str, str], Codec] = {}
_memos: dict[tuple[str, str], WordMemo] = {}
_id_memos: dict[tuple[str, str, str], IdMemo] = {}


def worker_codec(content: bytes, pattern: str) -> Codec:
    """The codec of a vocabulary; one in a Python worker."""
    key = (hashlib.sha256(content).hexdigest(), pattern)
    if key not in _codecs:
        _codecs[key] = Codec(read_ranks(content), pattern)
    return _codecs[key]


def worker_memo(content: bytes, pattern: str) -> WordMemo:
    """A memo of decimal ids that the tasks of a Python worker share."""
    key = (hashlib.sha256(content).hexdigest(), pattern)
    if key not in _memos:
        codec = worker_codec(content, pattern)
        form = [b"%d" % i for i in range(max(codec.bytes_of, default=0) + 1)]
        _memos[key] = WordMemo(codec, form, b",", MEMO_ENTRIES)
    return _memos[key]


def worker_id_memo(content: bytes, pattern: str, kind: str, entries: int = MEMO_ENTRIES) -> IdMemo:
    """A memo of ids in a number type of numpy that the tasks of a Python worker share."""
    key = (hashlib.sha256(content).hexdigest(), pattern, kind)
    if key not in _id_memos:
        _id_memos[key] = IdMemo(worker_codec(content, pattern), kind, entries)
    return _id_memos[key]


def concatenate(parts: list[bytes]) -> bytes:
    """Join decoded parts up a tree."""
    if len(parts) <= 4096:
        return b"".join(parts)
    middle = len(parts) // 2
    return concatenate(parts[:middle]) + concatenate(parts[middle:])


RESULT = {
    "n_tokens": (T.LongType(), pa.int64()),
    "ids": (T.ArrayType(T.IntegerType()), pa.list_(pa.int32())),
    "ids_sha256": (T.StringType(), pa.string()),
    "decoded": (T.BinaryType(), pa.binary()),
    "decoded_sha256": (T.StringType(), pa.string()),
}


def encode(
    docs: DataFrame,
    rank_file: str,
    pattern: str,
    text: str = "text",
    results: tuple[str, ...] = ("n_tokens", "ids"),
) -> DataFrame:
    """``docs`` with the token ids of every whole text, and what decoding them gives.

    ``results`` chooses from ``RESULT``: the ids, their number, the SHA-256 of their decimal
    form joined by commas, the decoded bytes and their SHA-256. Rows are independent, so there
    is no shuffle; the vocabulary (the rank file, about 1 MB) is sent to each executor once.
    """
    for name in results:
        RESULT[name]
    others = [c for c in docs.columns if c not in results]
    with open(rank_file, "rb") as file:
        vocabulary = docs.sparkSession.sparkContext.broadcast(file.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, decimal = worker_codec(vocabulary.value, pattern), worker_memo(vocabulary.value, pattern)
        token = {b"%d" % i: t for i, t in codec.bytes_of.items()}
        find = codec.words
        for batch in batches:
            made: dict[str, list] = {name: [] for name in results}
            for words in by_words(batch.column("__text"), find, decimal):
                joined = b",".join(map(decimal.__getitem__, words))
                ids = joined.split(b",") if joined else []
                if "n_tokens" in made:
                    made["n_tokens"].append(len(ids))
                if "ids" in made:
                    made["ids"].append([int(i) for i in ids])
                if "ids_sha256" in made:
                    made["ids_sha256"].append(hashlib.sha256(joined).hexdigest())
                if "decoded" in made or "decoded_sha256" in made:
                    decoded = concatenate([token[i] for i in ids])
                    if "decoded" in made:
                        made["decoded"].append(decoded)
                    if "decoded_sha256" in made:
                        made["decoded_sha256"].append(hashlib.sha256(decoded).hexdigest())
            columns = [batch.column(c) for c in others] + [pa.array(made[n], RESULT[n][1]) for n in results]
            yield pa.RecordBatch.from_arrays(columns, names=[*others, *results])

    schema = T.StructType(
        [docs.schema[c] for c in others] + [T.StructField(n, RESULT[n][0]) for n in results]
    )
    return docs.select(*others, docs[text].alias("__text")).mapInArrow(run, schema)
