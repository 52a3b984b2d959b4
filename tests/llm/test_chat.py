import duckdb

from riskmart.llm.chat import format_chats
from riskmart.llm.queries import ORACLE

SCHEMA = "conv_id long, turn long, role string, text string, id string, place string, h1 string, kept_id string, turns string"
EXTRA = ("x",) * 5


def frame(spark, rows):
    return spark.createDataFrame([(*r, *EXTRA) for r in rows], SCHEMA)


def order(row):
    return (row[0] is not None, row[0] if row[0] is not None else 0, row[3], row[2])


def brute(rows):
    chats = {}
    for i, (c, *turn) in enumerate(rows):  # a turn without an id is a conversation of its own
        chats.setdefault((c is None, c if c is not None else i), []).append(tuple(turn))
    for c in chats:
        chats[c].sort(key=lambda t: tuple((x is not None, x if x is not None else "") for x in t))
    said = {c: [t[1:] for t in turns] for c, turns in chats.items()}
    out = []
    for (no_id, c), turns in said.items():
        equal = [d for d in said if said[d] == turns]
        if min(equal) != (no_id, c):
            continue
        if any(len(o) > len(turns) and o[: len(turns)] == turns for o in said.values()):
            continue
        text = "".join(f"<|im_start|>{r or 'unknown'}\n{t or ''}<|im_end|>\n" for r, t in turns)
        out.append((None if no_id else c, len(turns), len(equal), text))
    return sorted(out, key=order)


def result(df):
    rows = [tuple(r[c] for c in ("conv_id", "n_turns", "n_copies", "rendered")) for r in df.collect()]
    return sorted(rows, key=order)


TALK = [("system", "be kind"), ("user", "hi"), ("assistant", "hello"), ("user", "bye"), ("assistant", "ciao")]


def snapshots():
    rows = []
    for c in range(1, 6):  # cumulative snapshots of one talk
        rows += [(c, i, *t) for i, t in enumerate(TALK[:c])]
    rows += [(6, i, *t) for i, t in enumerate(TALK)]  # a copy of the longest
    rows += [(7, i + 10, *t) for i, t in enumerate([*TALK[:2], ("assistant", "no")])]  # branches off
    rows += [(8, 0, "user", "hi"), (8, 1, "user", "hi")]  # repeated turn
    rows += [(9, 0, "user", "hi")]
    rows += [(10, 0, None, "hi"), (11, 0, "unknown", None), (12, 0, "unknown", "")]
    rows += [(13, None, "user", "first"), (13, 0, "user", "second"), (13, 0, "user", "second")]
    return rows


def test_snapshots_collapse(spark):
    rows = snapshots()
    got = result(format_chats(frame(spark, rows)))
    assert got == brute(rows)
    assert [r[0] for r in got] == [5, 7, 8, 10, 11, 12, 13]
    assert dict((r[0], r[2]) for r in got)[5] == 2


def test_turns_without_an_id_stand_alone(spark):
    rows = [(None, 0, "user", "a"), (None, 1, "user", "b"), (1, 0, "user", "a")]
    rows += [(None, None, "user", "b"), (None, 3, None, None), (None, 4, "unknown", ""), (2, 0, "user", "c"), (2, 1, "user", "d")]
    rows += [(None, 5, "user", "c"), (None, 6, "user", "d"), (None, 7, None, None)]
    got = result(format_chats(frame(spark, rows)))
    assert got == brute(rows)
    assert [r[:3] for r in got] == [(None, 1, 1), (None, 1, 2), (None, 1, 2), (None, 1, 1), (1, 1, 2), (2, 2, 1)]


def test_sql_takes_the_same_rows(spark):
    rows = snapshots() + [(None, i % 5, "user", f"loose {i % 3}") for i in range(40)] + [(None, 0, "user", "hi"), (None, 0, None, None)]
    conversations = frame(spark, rows).select("conv_id", "turn", "role", "text").toPandas()
    conversations = conversations.astype({"conv_id": "Int64", "turn": "Int64"})
    got = duckdb.sql(ORACLE["op4_chat_format"]).select("conv_id, n_turns, n_copies, rendered").fetchall()
    assert len(conversations) == len(rows) and sorted(got, key=order) == result(format_chats(frame(spark, rows)))


def test_a_third_of_the_log_without_ids(spark):
    rows = [(c, i, "user", f"{c} says {i}") for c in range(100) for i in range(20)]
    rows += [(None, i, "user", f"loose {i % 4}") for i in range(1000)]
    got = result(format_chats(frame(spark, rows)))
    assert got == brute(rows) and [r[2] for r in got[:4]] == [250] * 4


def test_hot_first_turn_and_long_talk(spark):
    rows = [(c, 0, "user", "same start") for c in range(300)]
    rows += [(c, 1, "user", f"own {c % 7}") for c in range(300)]
    rows += [(1000, i, "user", f"turn {i}") for i in range(2000)]
    got = result(format_chats(frame(spark, rows)))
    assert got == brute(rows) and len(got) == 8


def test_no_rows(spark):
    assert format_chats(frame(spark, [])).collect() == []


def test_plan_has_no_python(spark):
    plan = format_chats(frame(spark, snapshots()))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
