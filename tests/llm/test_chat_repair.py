"""Damage, faults and cheapest repairs, compared with a search over edits."""

import hashlib
import heapq
import random
import re
import zlib

import pytest

from riskmart.llm import chat_repair

SCHEMA = "conv_id long, turn long, role string, text string, n int, id string, codes string, number long, audit string"
PREFIX = re.compile("|".join(["", "s", "s?(ua)*u?"]))


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "i", "c", 0, "a") for r in rows], SCHEMA)


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        act = zlib.crc32(name.encode()) % 20
        text = "" if act == 1 else re.sub("[.!?]", "", text) if act == 2 else text
        role = "user" if act == 4 else role
        out += [(conv, turn, role, text)] * {0: 0, 3: 2}.get(act, 1)
    return out


def faults(rows):
    found, seen = [], set()
    for _, _, role, text in rows:
        end = text.rstrip(" \t\n\v\f\r")
        found.append("blank" if not end else "duplicate" if (role, text) in seen else "" if end[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return found


def cheapest(rows, fault):
    """The least (cost, audit) over all edits, and what it leaves."""
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, at, initials, left = heapq.heappop(heap)
        if at == len(rows) and re.fullmatch("(s?(ua)+)?", initials):
            return cost, audit, left
        if (at, initials[-1:]) in done:
            continue
        done.add((at, initials[-1:]))
        steps = [("I", 2, at, r, ((r, ""),)) for r in ("user", "assistant")]
        if at < len(rows):
            _, _, role, text = rows[at]
            steps.append(("D", 3, at + 1, None, ()))
            if fault[at] not in ("blank", "duplicate"):
                extra = int(fault[at] == "truncated")
                steps.append(("K", extra, at + 1, role, ((role, text),)))
                steps += [("R", 2 + extra, at + 1, r, ((r, text),)) for r in ("user", "assistant")]
        for letter, more, to, role, written in steps:
            now = initials if role is None else initials + (role[:1] or "-")
            if PREFIX.fullmatch(now):
                heapq.heappush(heap, (cost + more, audit + letter, to, now, left + written))


def brute(rows):
    out = {}
    after = damage(rows)
    for conv in {r[0] for r in rows}:
        mine = sorted((r for r in after if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
        fault = faults(mine)
        turns = [r[1] for r in mine if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(mine, mine[1:]))
        cost, audit, left = cheapest(mine, fault)
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in left).encode()).hexdigest()
        out[conv] = (gaps, *(fault.count(k) for k in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest)
    return out


def found(spark, rows, segment_rows=chat_repair.SEGMENT_ROWS):
    result = chat_repair.repair(frame(spark, rows), segment_rows=segment_rows)
    listed = result.collect()
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert result.columns == ["conv_id", *names]
    out = {r["conv_id"]: tuple(r[n] for n in names) for r in listed}
    assert len(out) == len(listed)
    return out


def conversations(generator, n, longest):
    rows = []
    for conv in range(n):
        for turn in range(generator.randrange(1, longest)):
            role = generator.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "User"])
            text = generator.choice(["Yes.", "no", "Why? ", " \t", "", None, "A.\nB", "é!", f"t{turn}.", f"t{turn}"])
            rows.append((conv, generator.choice([turn, turn, turn, turn + 5, None, 2]), role, text))
    return rows


def test_equals_a_search_over_edits(spark):
    generator = random.Random(1)
    rows = conversations(generator, 150, 14) + [(None, t, r, "x.") for t, r in [(None, "user"), (1, None), (None, "user"), (3, "assistant")]]
    generator.shuffle(rows)
    assert found(spark, rows) == brute(rows)


@pytest.mark.parametrize("size", [1, 2, 7])
def test_segments_of_any_size(spark, size):
    """A conversation over many segments has the repair it has in one."""
    generator = random.Random(2)
    rows = conversations(generator, 12, 40)
    codes = [bytes(generator.choice([0, 1, 2, 3, 5, 9, 10]) for _ in range(generator.randrange(1, 60))) for _ in range(30)]
    assert found(spark, rows, size) == brute(rows)
    whole = chat_repair.least_paths([(c, True, chat_repair._AT_END.tolist()) for c in codes])
    for c, (_, audits) in zip(codes, whole):
        parts = [c[i : i + size] for i in range(0, len(c), size)]
        costs, ends = chat_repair._AT_END, []
        for m in reversed(chat_repair.segment_matrices(parts)):
            ends.append(costs.tolist())
            costs = (m + costs[None]).min(axis=1)
        pieces = chat_repair.least_paths([(p, i == len(parts) - 1, e) for i, (p, e) in enumerate(zip(parts, reversed(ends)))])
        state, audit = 0, ""
        for exits, of_piece in pieces:
            audit, state = audit + of_piece[state], exits[state]
        assert audit == audits[0]


def test_one_conversation_with_very_many_rows(spark):
    """Over several tasks and segments; a third of its rows are equal."""
    generator = random.Random(3)
    rows = [(1, t, generator.choice(["user", "assistant"]), generator.choice(["a.", f"b{t}.", f"c{t}"])) for t in range(6_000)]
    rows += [(1, 7_000, "user", "same.")] * 3_000 + [(2, 0, "user", "hi."), (2, 1, "assistant", "ho.")]
    got = found(spark, rows)
    assert got == brute(rows)


def test_long_texts_and_roles(spark):
    rows = [(1, 0, "user" * 50, "x" * 300_000 + "."), (1, 0, "user" * 50 + "a", "y."), (1, 1, "assistant", "z" * 300_000), (1, 1, "assistant", "z" * 299_999 + ".")]
    assert found(spark, rows) == brute(rows)


def test_all_rows_dropped_and_empty_table(spark):
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    assert found(spark, [(gone, 0, "user", "x.")]) == {gone: (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())}
    assert found(spark, []) == {}
    assert found(spark, [(None, None, None, None)]) == brute([(None, None, None, None)])


def test_extreme_turns(spark):
    rows = [(1, -(2**63), "user", "a."), (1, 2**63 - 1, "assistant", "b.")]
    got = found(spark, rows)[1]
    assert got[0] <= 2**63 - 1
