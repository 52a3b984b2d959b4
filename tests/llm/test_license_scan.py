import re
import time

from hypothesis import given, settings
from hypothesis import strategies as st

from riskmart.llm import license_scan as ls
from tests.llm.frames import documents, nothing

TEXTS = [
    None, "", "Released under the MIT License.", "mit license mit license", "Licensed under CC BY-NC 4.0, cc by",
    "GNU General Public License and the Apache License", "// SPDX-License-Identifier: (MIT OR GPL-2.0-only) AND CC-BY-4.0\nrest",
    "SPDX-License-Identifier: GPL-2.0 WITH Classpath-exception-2.0", "SPDX-License-Identifier: MIT OR", "É MIT, LICENSE\n", "x " * 50000 + "mit license",
]


def brute(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    places = []
    for phrase, label in ls.BASE_PHRASES.items():
        parts = phrase.split()
        places += [(i, label) for i in range(len(words)) if words[i : i + len(parts)] == parts]
    starts = [p for p, _ in places]
    return len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places}))


def test_base_places_equal_brute_force(spark):
    got = {r["doc_id"]: r for r in ls.scan(documents(spark, TEXTS), ["doc_id"]).collect()}
    for i, text in enumerate(TEXTS):
        r = got[i]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == brute(text)
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(","))
        assert 0 <= r["score"] <= 1
    assert got[6]["labels"] == "cc-by,gpl,mit" and got[6]["restriction"] == 0 and got[6]["score"] == 1
    assert got[7]["restriction"] == 1
    assert got[8]["expressions"] == [] and got[8]["score"] == 0.7
    assert got[0]["score"] == 0 and got[1]["labels"] == ""
    assert ls.scan(nothing(spark), ["doc_id"]).count() == 0


def test_scan_of_repeated_rows(spark):
    docs = documents(spark, ["mit license"]).union(documents(spark, ["mit license"]))
    assert [r["n_base"] for r in ls.scan(docs, ["doc_id"]).collect()] == [1, 1]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from(["mit", "license", "MIT", "-", "cc", "by", "apache", "é", "\n"]), max_size=20))
def test_scanner_on_mixtures(parts):
    text = " ".join(parts)
    assert ls.Scanner().scan(text)[:5] == brute(text)


# Expressions as nested tuples, written out with as many parentheses as there are operators.
expressions = st.recursive(
    st.sampled_from(["MIT", "GPL-3.0", "MPL-2.0", "CC-BY-NC-4.0", "Foo-1"]),
    lambda inner: st.tuples(st.sampled_from(["AND", "or"]), inner, inner),
    max_leaves=8,
)


def written(e):
    return e if isinstance(e, str) else f"({written(e[1])} {e[0]} {written(e[2])})"


def meant(e):
    if isinstance(e, str):
        label, restriction = ls.identify(e.lower())
        return {label}, restriction
    (a, x), (b, y) = meant(e[1]), meant(e[2])
    return a | b, (max if e[0] == "AND" else min)(x, y)


@settings(max_examples=100, deadline=None)
@given(expressions)
def test_parser_equals_the_tree(e):
    assert ls.evaluate(ls.postfix(written(e))) == meant(e)


def test_precedence_and_malformed():
    assert ls.postfix("MIT OR GPL-2.0 AND MPL-2.0") == ["mit", "gpl-2.0", "mpl-2.0", "and", "or"]
    for bad in ("", "MIT MIT", "(MIT", "MIT)", "AND MIT", "MIT OR", "()", "MIT (GPL)"):
        assert ls.postfix(bad) is None


def test_expression_before_prose_and_punctuation():
    def found(line):
        row = ls.Scanner().scan(f"SPDX-License-Identifier: {line}")
        return row[5], row[6], row[7], row[8]

    assert ls.Scanner().scan("<!-- SPDX-License-Identifier: MIT -->")[5:] == ("mit", 1.0, ["mit"], 0)
    assert found("MIT.") == ("mit", 1.0, ["mit"], 0)
    assert found("Apache-2.0 Copyright 2020 X") == ("apache", 1.0, ["apache-2.0"], 0)
    assert found("(MIT OR GPL-2.0+) AND BSD-3-Clause. See LICENSE") == ("bsd,gpl,mit", 1.0, ["mit gpl-2.0+ or bsd-3-clause and"], 0)
    for line in ("MIT)", "MIT (see LICENSE)", "MIT, see there", "MIT or any other you like", "MIT MIT", "MIT. Or not at all", "MIT --- x y"):
        assert found(line) == ("mit", 1.0, ["mit"], 0)
    assert found("foo or bar") == ("bar,foo", 1.0, ["foo bar or"], 3)
    for line in ("MIT OR", "(MIT", "AND MIT", "--", "()", "(MIT GPL-2.0)"):
        assert found(line) == ("", 0.7, [], None)


def test_many_hits_take_linear_time():
    tags = 10_000
    text = "\n".join(f"// SPDX-License-Identifier: MIT OR l{i}" for i in range(tags))
    start = time.monotonic()
    row = ls.Scanner().scan(text)
    assert len(row[7]) == tags and row[7][-1] == f"mit l{tags - 1} or"
    row = ls.Scanner().scan("SPDX-License-Identifier: MIT " * tags)  # on one line
    assert row[7] == ["mit"] * tags
    row = ls.Scanner().scan("cc by mit license, " * 50_000)
    assert row[:4] == (200_000, 100_000, 0, 199_998)
    assert time.monotonic() - start < 10


def test_expression_ends_before_the_next_tag():
    tag = "SPDX-License-Identifier:"
    assert ls.Scanner().scan(f"{tag} MIT {tag} (Apache-2.0 {tag} BSD-3-Clause")[7] == ["mit", "bsd-3-clause"]
    assert ls.Scanner().scan(f"{tag} {tag} MIT AND ISC")[7] == ["mit isc and"]
