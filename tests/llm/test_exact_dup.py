import hashlib
import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from riskmart.llm import exact_dup
from tests.llm.frames import documents, nothing, rows_as_given


def brute(pairs):
    groups = {}
    for i, t in pairs:
        groups.setdefault(t or "", []).append(i)
    out = []
    for i, t in pairs:
        ids = groups[t or ""]
        keep = max((x for x in ids if x is not None), default=None)
        out.append((i, keep, len(ids), hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(out, key=str)


def check(spark, pairs):
    rows = exact_dup.exact_groups(rows_as_given(spark, pairs)).collect()
    got = sorted([(r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in rows], key=str)
    assert got == brute(pairs)
    kept = [r for r in rows if r["kept"]]
    assert len(kept) == len({t or "" for _, t in pairs})
    assert all(r["doc_id"] == r["keep_id"] for r in kept)


def test_texts_that_part_late_or_end_at_a_digit(spark):
    generator = random.Random(1)
    long = "".join(generator.choices("abcé", k=40_000))
    texts = [long, long, long[:-1], long + "x", long[:64], long[:64], long[:1088], long[:1088], long[:1089], None, "", "a", "b", "a"]
    texts += ["z" * n for n in (63, 64, 65, 1087, 1088, 1089) for _ in range(2)]
    check(spark, list(enumerate(texts)))


def test_keys_that_repeat_or_are_null(spark):
    check(spark, [(1, "a"), (1, "a"), (2, "a"), (2, "a"), (None, "a"), (None, "b"), (None, "b"), (3, None), (3, ""), (4, "c")])


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text("ab", max_size=3) | st.none(), max_size=30))
def test_short_texts(spark, texts):
    check(spark, list(enumerate(texts)))


def test_drop_copies_keeps_rows_whole(spark):
    docs = documents(spark, ["a", "b", "a", None, "", "c" * 3000, "c" * 3000])
    kept = exact_dup.drop_copies(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 2, 4, 6]
    assert exact_dup.drop_copies(nothing(spark)).count() == 0
    assert exact_dup.exact_groups(nothing(spark)).count() == 0
