"""Secret scan: candidates in every text, judged by how many repositories and owners share them.

A credential that works belongs to one owner. A value that many owners have is an example from
a manual, however secret it looks. So each candidate's hash is counted by distinct repositories
and distinct owners over the whole corpus; candidates of the looser kinds become spans only if
their values are owner-specific, and every span is marked as live-looking or widely copied.

Kinds, in the order in which ties are listed: ``assign``, ``access`` and ``hex`` (always spans),
then ``pem`` (private key blocks), ``jwt``, ``url`` (passwords in addresses) and ``mixed`` (long
random-looking words), which need the corpus.

Defined results: null and empty texts have no spans; a null repository or owner counts as one of
its own; repeated rows (same key, same text) get the same spans each; only the named columns
are read, so further columns cannot clash.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Callable, Iterator
from itertools import accumulate

import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmart.llm.words import map_texts
from riskmart.sources.scratch import keep

# The patterns of the contract.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # runs of 24 and more; shorter runs fail

# No pattern has an upper bound: each run is read once, and what it is worth is judged afterwards.
PEM = re.compile(
    r"-----BEGIN [A-Z ]*PRIVATE KEY-----"
    r"(?:[ \t]*[\r\n]+[A-Za-z0-9-]+:(?:(?!-----)[^\r\n])*)*+"  # header lines of an encrypted key
    r"[A-Za-z0-9+/=\s]{16,}-----END [A-Z ]*PRIVATE KEY-----"
)
# Three parts of 8 characters and more, the first behind ``eyJ``; see ``web_tokens`` for where they may begin.
_DOTTED = re.compile(r"[A-Za-z0-9_-]+(?:\.[A-Za-z0-9_-]+)*+")
_PART = 8
URL = re.compile(r"://[A-Za-z0-9._%-]+:([^\s/@:\"'<>]{4,})@")
MIXED = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}(?![A-Za-z0-9+/_-])")

KINDS = ["assign", "access", "hex", "pem", "jwt", "url", "mixed"]
BASE_KINDS = KINDS[:3]
_ASSIGN_WORDS = ("passw", "secret", "token", "api")
# Bytes to one mark for each class: digits, capitals, small letters, other characters of a value.
_HEX_RUN = b"h" * 24
_HEX_MAP = bytes(104 if 48 <= c <= 57 or 97 <= c <= 102 else 32 for c in range(256))
_VALUE_RUN = b"v" * 20
_VALUE_MAP = bytes(118 if chr(c) in "+/_-" or 48 <= c <= 57 or 65 <= c <= 90 or 97 <= c <= 122 else 32 for c in range(256))

CANDIDATES = (
    "n_assign long, n_access long, n_hex long, base_sha256 string, text_hash long, "
    "found array<struct<kind: int, start: long, end: long, value: string, strong: boolean>>"
)


def entropy(value: str) -> float:
    """Bits a character."""
    return -sum(n / len(value) * math.log2(n / len(value)) for n in Counter(value).values())


def looks_random(value: str) -> bool:
    """Whether a value is as varied as a generated one."""
    return entropy(value) >= 3.0 + 0.25 * (len(value) >= 20) and any(c.isdigit() for c in value)


def web_tokens(text: str) -> Iterator[tuple[int, int]]:
    """Start and end of each ``eyJ...``, dot, part, dot, part; leftmost, not overlapping.

    A run of parts is cut at its dots once. The first ``eyJ`` of a part leaves it the most characters, so
    no other needs to be tried.
    """
    for run in _DOTTED.finditer(text):
        parts = run[0].split(".")
        if len(parts) < 3:
            continue
        at, number = run.start(), 0
        while number + 2 < len(parts):
            first, second, third = parts[number : number + 3]
            begin = first.find("eyJ")
            if begin >= 0 and len(first) - begin - 3 >= _PART and len(second) >= _PART and len(third) >= _PART:
                end = at + len(first) + len(second) + len(third) + 2
                yield at + begin, end
                at, number = end + 1, number + 3
            else:
                at, number = at + len(first) + 1, number + 1


def outside(taken: list[tuple[int, int]]) -> Callable[[int, int], bool]:
    """Tells whether a span overlaps none of the spans taken, in the logarithm of their number."""
    taken = sorted(taken)
    starts = [start for start, _ in taken]
    reach = list(accumulate((end for _, end in taken), max))  # the furthest end so far

    def free(start: int, end: int) -> bool:
        before = bisect_left(starts, end)
        return not before or reach[before - 1] <= start

    return free


def candidates(text: str) -> list[tuple[int, int, int, str, bool]]:
    """All candidates of a text: kind, start, end, hash of the value, whether it looks random."""
    raw = text.encode()
    low = raw.lower()
    found: list[tuple[int, int, int, str]] = []
    if any(word.encode() in low for word in _ASSIGN_WORDS):
        found += [(0, m.start(), m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if b"AKIA" in raw:
        found += [(1, m.start(), m.end(), m[0]) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    if _HEX_RUN in raw.translate(_HEX_MAP):
        found += [(2, m.start(), m.end(), m[0]) for m in HEX.finditer(text)]
    if b"-----BEGIN " in raw:
        found += [(3, m.start(), m.end(), m[0]) for m in PEM.finditer(text)]
    if b"eyJ" in raw:
        found += [(4, start, end, text[start:end]) for start, end in web_tokens(text)]
    if b"://" in raw:
        found += [(5, m.start(1), m.end(1), m[1]) for m in URL.finditer(text)]
    if _VALUE_RUN in raw.translate(_VALUE_MAP):
        free = outside([(s, e) for _, s, e, _ in found])
        found += [
            (6, m.start(), m.end(), m[0]) for m in MIXED.finditer(text) if looks_random(m[0]) and free(m.start(), m.end())
        ]
    return [(k, s, e, hashlib.sha256(v.encode()).hexdigest(), looks_random(v)) for k, s, e, v in found]


def spell(spans: list[tuple[int, int, int]]) -> str:
    """Spans as kind:start:end by start, then kind, comma-joined."""
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in sorted((s, k, e) for k, s, e in spans))


def _row(text: str) -> tuple:
    found = candidates(text)
    counts = Counter(f[0] for f in found)
    base = spell([f[:3] for f in found if f[0] < len(BASE_KINDS)])
    digest = hashlib.sha256(base.encode()).hexdigest()
    return counts[0], counts[1], counts[2], digest, xxhash.xxh3_64_intdigest(text.encode()) - (1 << 63), found


def find_candidates(docs: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """``keys`` of ``docs`` with counts and candidates of every whole text; no shuffle."""
    return map_texts(docs, CANDIDATES, lambda: _row, keys, text)


def ownership(found: DataFrame, repository: str, owner: str) -> DataFrame:
    """``value``, number of distinct ``repositories`` and ``owners`` of each candidate value.

    The first grouping leaves one row for each value, repository and owner, combined before the
    shuffle, so a value that a third of all texts contain arrives as few rows.
    """
    each = found.select(F.col(repository).alias("r"), F.col(owner).alias("o"), F.explode("found.value").alias("value"))
    by_place = each.groupBy("value", "r", "o").agg(F.lit(1).alias("one"))
    named = by_place.select("value", F.struct("r").alias("r"), F.struct("o").alias("o"))  # a null is a name, too
    return named.groupBy("value").agg(
        F.count_distinct("r").alias("repositories"), F.count_distinct("o").alias("owners")
    )


def scan(
    docs: DataFrame,
    key: str = "doc_id",
    repository: str = "source",
    owner: str = "source",
    text: str = "text",
    most_owners: int = 2,
    most_repositories: int = 3,
) -> DataFrame:
    """For each row: counts of the base kinds, all spans, and how many of them look live.

    A span is live-looking if its value looks random and has at most ``most_owners`` owners and
    ``most_repositories`` repositories; else, with more of either, it is a copied example
    (``n_copied``). Spans of the looser kinds are reported only when live-looking.

    The candidates, few and small, are written once; counting and judging read only them.
    """
    names = list(dict.fromkeys([key, repository, owner]))
    found = keep(find_candidates(docs.select(*names, text), names, text), "secrets")
    copied = keep(
        ownership(found, repository, owner).where(
            (F.col("owners") > most_owners) | (F.col("repositories") > most_repositories)
        ),
        "copied",
    )
    spans = found.where(F.size("found") > 0).select(F.col(key).alias("k"), "text_hash", F.explode("found").alias("c"))
    # Equal rows give equal spans: one of them is enough.
    spans = spans.select("k", "text_hash", "c.*").distinct()
    judged = spans.join(copied.select("value", F.lit(True).alias("copied")), "value", "left").withColumn(
        "live", F.col("strong") & F.col("copied").isNull()
    )
    kinds = F.array(*map(F.lit, KINDS))
    shown = (F.col("kind") < len(BASE_KINDS)) | F.col("live")
    place = F.struct("start", "kind", "end")
    by_text = judged.groupBy("k", "text_hash").agg(
        F.sort_array(F.collect_list(F.when(shown, place))).alias("places"),
        F.count_if(shown & F.col("live")).alias("n_live"),
        F.count_if(F.col("copied").isNotNull()).alias("n_copied"),
    )
    spelt = F.transform("places", lambda p: F.concat_ws(":", kinds[p["kind"]], p["start"], p["end"]))
    by_text = by_text.select("k", "text_hash", F.array_join(spelt, ",").alias("spans"), "n_live", "n_copied")
    rows = found.select(key, "n_assign", "n_access", "n_hex", "base_sha256", "text_hash")
    joined = rows.join(
        by_text.withColumnRenamed("text_hash", "h"),
        rows[key].eqNullSafe(F.col("k")) & (F.col("text_hash") == F.col("h")),
        "left",
    )
    return joined.select(
        *[rows[c] for c in (key, "n_assign", "n_access", "n_hex", "base_sha256")],
        F.coalesce("spans", F.lit("")).alias("spans"),
        F.coalesce("n_live", F.lit(0)).alias("n_live"),
        F.coalesce("n_copied", F.lit(0)).alias("n_copied"),
    )
