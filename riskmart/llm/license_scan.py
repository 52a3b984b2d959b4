"""Licence scan: notice phrases and identifier tags by Aho-Corasick, expressions by shunting-yard.

Texts are read as lower-cased words; a phrase is found where its words stand consecutively. The
tag ``SPDX-License-Identifier`` (words, whatever punctuation joins them) opens an expression
of identifiers joined by and, or, with and parentheses: the whole rest of its line or, where
prose follows, the longest well-formed beginning. Punctuation behind an identifier is no part of it.

Defined results: null and empty texts have no words, no labels and score 0; repeated rows are
scanned each for itself; a line that ends within an expression (``MIT OR``) or begins with none adds no
label but still scores as a tag; an expression ends before the next tag of its line. Each text is read a fixed number of
times, however many phrases and tags it holds. Columns of ``docs`` that are not asked for are not read, so names cannot clash.
"""

from __future__ import annotations

import re

import ahocorasick
from pyspark.sql import DataFrame

from riskmart.llm.words import map_texts

# The phrases of the contract and their labels.
BASE_PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Further notice phrases and their labels.
NOTICE_PHRASES = {
    "gnu affero general public license": "agpl",
    "gnu lesser general public license": "lgpl",
    "gnu library general public license": "lgpl",
    "gnu free documentation license": "gfdl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "boost software license": "bsl",
    "bsd license": "bsd",
    "isc license": "isc",
    "zlib license": "zlib",
    "open database license": "odbl",
    "redistribution and use in source and binary forms": "bsd",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "permission to use copy modify and or distribute this software": "isc",
    "licensed under the apache license": "apache",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "creative commons attribution": "cc-by",
    "creative commons zero": "cc0",
    "cc by nc": "cc-by-nc",
    "cc by nd": "cc-by-nd",
    "cc by sa": "cc-by-sa",
    "cc0 1 0": "cc0",
    "all rights reserved": "proprietary",
}
TAG = "spdx license identifier"

# Identifier beginnings, longest first where one begins another: label, restriction
# (0 permissive, 1 weak copyleft, 2 strong copyleft, 3 use is limited or unknown).
IDENTIFIERS = {
    "agpl": ("agpl", 2),
    "apache": ("apache", 0),
    "bsd": ("bsd", 0),
    "bsl": ("bsl", 0),
    "cc-by-nc": ("cc-by-nc", 3),
    "cc-by-nd": ("cc-by-nd", 3),
    "cc-by-sa": ("cc-by-sa", 2),
    "cc-by": ("cc-by", 0),
    "cc0": ("cc0", 0),
    "epl": ("epl", 1),
    "gfdl": ("gfdl", 2),
    "gpl": ("gpl", 2),
    "isc": ("isc", 0),
    "lgpl": ("lgpl", 1),
    "mit": ("mit", 0),
    "mpl": ("mpl", 1),
    "unlicense": ("unlicense", 0),
    "zlib": ("zlib", 0),
}
UNKNOWN = 3
_LABELS = {label for label, _ in IDENTIFIERS.values()}
PRECEDENCE = {"or": 1, "and": 2, "with": 3}

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_TOKEN = re.compile(r"[()]|[A-Za-z0-9.+_-]+")
_LINE_END = re.compile(r"[\r\n;\"'*#<>]")
# Byte by byte: capitals to small letters, all that is no part of a word to a space.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))

SCHEMA = (
    "n_words long, n_base long, first_word long, last_word long, base_labels string, "
    "labels string, score double, expressions array<string>, restriction int"
)


def fold(text: str) -> list[bytes]:
    """The lower-cased words of a text."""
    return text.encode().translate(_FOLD).split()


def postfix(expression: str) -> list[str] | None:
    """A licence expression in postfix order by the shunting-yard method; None if it is malformed."""
    out: list[str] = []
    waiting: list[str] = []
    operand_next = True
    for token in _TOKEN.findall(expression):
        name = token.lower()
        if token == "(":
            if not operand_next:
                return None
            waiting.append(token)
        elif token == ")":
            while waiting and waiting[-1] != "(":
                out.append(waiting.pop())
            if operand_next or not waiting:
                return None
            waiting.pop()
        elif name in PRECEDENCE:
            if operand_next:
                return None
            while waiting and waiting[-1] != "(" and PRECEDENCE[waiting[-1]] >= PRECEDENCE[name]:
                out.append(waiting.pop())
            waiting.append(name)
            operand_next = True
        else:
            if not operand_next:
                return None
            out.append(name)
            operand_next = False
    if operand_next or "(" in waiting:
        return None
    return out + waiting[::-1]


def stated(line: str) -> list[str] | None:
    """The expression a line begins with, in postfix order; None if it begins with none or ends within one."""
    tokens: list[str] = []
    ends = set()  # where a sentence ends
    for token in _TOKEN.findall(line):
        name = token.rstrip("._-")
        if token in "()" or any(c.isalnum() for c in name):
            tokens.append(name)
            if token.endswith("."):
                ends.add(len(tokens))
    whole = postfix(" ".join(tokens))
    if whole:
        return whole
    depth, complete, operand_next = 0, 0, True
    for i, token in enumerate(tokens):
        following = tokens[i + 1].lower() if i + 1 < len(tokens) else ""
        if token == "(" and operand_next:
            depth += 1
        elif token == ")" and depth and not operand_next:
            depth -= 1
        elif token.lower() in PRECEDENCE and not operand_next:
            # "MIT or any of ..." goes on in prose
            if not token.isupper() and following and following != "(" and not _is_identifier(following):
                break
            operand_next = True
        elif token not in "()" and token.lower() not in PRECEDENCE and operand_next:
            operand_next = False
        else:
            break
        if not depth and not operand_next:
            complete = i + 1
            if complete in ends:
                break
    else:
        return None
    return postfix(" ".join(tokens[:complete]))


def _is_identifier(name: str) -> bool:
    return any(c.isdigit() for c in name) or identify(name)[0] in _LABELS


def identify(name: str) -> tuple[str, int]:
    """Label and restriction of an identifier."""
    return next((v for k, v in IDENTIFIERS.items() if name == k or name.startswith((f"{k}-", f"{k}+"))), (name, UNKNOWN))


def evaluate(order: list[str]) -> tuple[set[str], int]:
    """All labels of an expression and its restriction: and takes the stricter side, or the freer.

    An exception given by ``with`` lifts one level of copyleft; it is no licence of its own.
    """
    stack: list[tuple[set[str], int]] = []
    for token in order:
        if token not in PRECEDENCE:
            label, restriction = identify(token)
            stack.append(({label}, restriction))
            continue
        (labels, restriction), (more, other) = stack[-2], stack[-1]
        del stack[-2:]
        if token == "with":
            stack.append((labels, restriction - 1 if restriction in (1, 2) else restriction))
        else:
            stack.append((labels | more, (max if token == "and" else min)(restriction, other)))
    return stack[0]


def _after_tags(text: str, starts: list[int]) -> list[str]:
    """The rest of the line behind each tag, up to the next tag; ``starts`` are the tags' first words, ascending.

    One pass over the words finds all places, and each rest is read once.
    """
    small = text.encode().lower().decode()  # as long as the text: only A-Z change
    places: list[tuple[int, int]] = []  # where a tag begins and ends
    begin = 0
    for number, match in enumerate(WORD.finditer(small)):
        if number == starts[len(places)]:
            begin = match.start()
        elif number == starts[len(places)] + 2:
            places.append((begin, match.end()))
            if len(places) == len(starts):
                break
    nexts = [begin for begin, _ in places[1:]] + [len(text)]
    rests = [text[end:following].lstrip(" :=\t") for (_, end), following in zip(places, nexts, strict=True)]
    return [_LINE_END.split(rest, maxsplit=1)[0] for rest in rests]


class Scanner:
    def __init__(self):
        self.automaton = ahocorasick.Automaton()
        phrases = dict.fromkeys(BASE_PHRASES) | dict.fromkeys(NOTICE_PHRASES) | {TAG: None}
        for phrase in phrases:
            self.automaton.add_word(f" {phrase} ", phrase)
        self.automaton.make_automaton()
        self.words = {phrase: phrase.count(" ") + 1 for phrase in phrases}

    def scan(self, text: str) -> tuple:
        words = fold(text)
        line = f" {b' '.join(words).decode()} "
        base: list[int] = []
        base_labels: set[str] = set()
        labels: set[str] = set()
        expressions: list[str] = []
        restrictions: list[int] = []
        score = 0.0
        tags: list[int] = []
        counted, behind = 0, 0  # words that end before ``counted``, counted once for all phrases
        for end, phrase in self.automaton.iter(line):
            behind += line.count(" ", counted, end)
            counted = end
            at = behind - self.words[phrase]
            if phrase in BASE_PHRASES:
                base.append(at)
                base_labels.add(BASE_PHRASES[phrase])
                score = max(score, 0.6)
            elif phrase in NOTICE_PHRASES:
                labels.add(NOTICE_PHRASES[phrase])
                score = max(score, 0.8)
            else:
                score = max(score, 0.7)
                tags.append(at)
        for rest in _after_tags(text, tags) if tags else []:
            order = stated(rest)
            if order:
                found, restriction = evaluate(order)
                labels |= found
                expressions.append(" ".join(order))
                restrictions.append(restriction)
                score = 1.0
        return (
            len(words),
            len(base),
            min(base, default=None),
            max(base, default=None),
            ",".join(sorted(base_labels)),
            ",".join(sorted(labels | base_labels)),
            score,
            expressions,
            max(restrictions, default=None),
        )


def scan(docs: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """``keys`` of ``docs`` and what the scan finds in every whole text.

    ``n_base`` counts all places of base phrases, ``first_word`` and ``last_word`` are the first
    and last word they start at. ``labels`` also holds those of further phrases and of
    expressions, ``expressions`` lists these in postfix order, ``restriction`` is that of the
    strictest. ``score`` says how surely a licence is stated: 1 by a parsed expression, 0.8 by a
    notice, 0.7 by a tag alone, 0.6 by a base phrase, 0 by nothing. Rows are independent: no shuffle.
    """
    return map_texts(docs, SCHEMA, lambda: Scanner().scan, keys, text)
