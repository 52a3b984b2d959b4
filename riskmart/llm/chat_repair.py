"""Conversations damaged in a known way, their faults, and the cheapest repair of each.

A repair keeps (cost 0), reroles (2) or deletes (3) each row and inserts empty turns (2), so that the initials of the roles
read ``(s?(ua)+)?``; blank and duplicate rows must go, and a truncated row that stays adds 1. The letters of its edits
in order are its audit; of the cheapest repairs that with the least audit is taken.

1. *Segments.* Equal rows are combined with their number, then all rows are dealt by ranges of (conversation, turn,
   role, text) and cut into segments of at most ``SEGMENT_ROWS`` rows of one conversation, so that a
   conversation of any length spreads over tasks. Duplicates are found by a join with the first turn of each repeated row.
2. *Cost DP.* Four states tell how far the pattern is read: nothing, after s, after u, after a. A segment is a
   4 x 4 matrix of least costs; the matrices of a conversation give the costs to go at each border.
3. *Path ranking* inside each segment, from the costs at its end: the arcs on cheapest paths are the
   nodes, an arc's successor is the least of those that leave where it ends. Ranks of audits of one letter are the
   letters; a pair of ranks, the arc's own and that at its pointer, gives the rank of audits twice as long, and pointers are doubled
   with it. The least-ranked arc of each state a segment can be entered in begins its path, which is read off through the doubled pointers.
4. *Paths* of a conversation's segments are put together by the state each leaves for the next.
5. *Digest.* SHA-256 has no parts that could be combined: one task reads the repaired rows of a conversation in
   order, segment by segment, and holds no more than one batch of segments and the audit.

Of rows of one turn the least by role, then text, comes first; equal rows are adjacent. Different arcs that leave a node carry
different letters, so an audit determines its repair, and equal costs with equal audits do not occur.

Defined results: nulls in ``turn``, ``role`` and ``text`` count as one space, where they are read as text; all rows with a null
``conv_id`` are one conversation. Rows that repeat (conv_id, turn) share their damage. A very long text is a segment of its
own. A conversation that has lost all rows has zeros and empty strings; an empty table gives no rows. ``gaps`` beyond a long is the
largest long. An audit is one string, so a conversation can have at most 2**31 rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskmart.sources.scratch import keep, temporary

SEGMENT_ROWS = 1024
SEGMENT_CHARACTERS = 1 << 16
ORDER_CHARACTERS = 64
_SEGMENTS_AT_ONCE = 512
_NODES_AT_ONCE = 1 << 18

# Roles by initial; states by the last initial of what is read so far.
SYSTEM, USER, ASSISTANT, OTHER = range(4)
NOTHING, AFTER_S, AFTER_U, AFTER_A = range(4)
_LEGAL = {(SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER)}
_DELETE, _TRUNCATED = 4, 8  # bits beside the initial in a row's code
_NEXT = np.array([AFTER_U, AFTER_U, AFTER_A, AFTER_U])  # after a user or assistant turn, whichever is due
_KEPT = {(NOTHING, SYSTEM): AFTER_S, (AFTER_U, ASSISTANT): AFTER_A} | {(s, USER): AFTER_U for s in (NOTHING, AFTER_S, AFTER_A)}
_AT_END = np.array([0, 4, 2, 0])  # what inserts after the last row cost
_NEVER = 1 << 60
LETTERS = "DIKR"
COSTS = {"D": 3, "I": 2, "K": 0, "R": 2, "truncated": 1}


def _row_arcs(code: int) -> dict[str, list[tuple[int, int, int]]]:
    """The arcs (state, next state, cost) of a row, by letter."""
    initial, extra = code & 3, COSTS["truncated"] if code & _TRUNCATED else 0
    arcs = {"D": [(s, s, COSTS["D"]) for s in range(4)], "K": [], "R": []}
    if not code & _DELETE:
        arcs["K"] = [(s, to, COSTS["K"] + extra) for (s, i), to in _KEPT.items() if i == initial]
        arcs["R"] = [(s, int(_NEXT[s]), COSTS["R"] + extra) for s in range(4)]
    return arcs


def _matrix(code: int) -> np.ndarray:
    """Least costs from state to state over inserts, then the row."""
    row = np.full((4, 4), _NEVER)
    for arcs in _row_arcs(code).values():
        for s, to, cost in arcs:
            row[s, to] = min(row[s, to], cost)
    inserts = np.full((4, 4), _NEVER)
    for s in range(4):
        at, cost = s, 0
        for _ in range(3):
            inserts[s, at] = min(inserts[s, at], cost)
            at, cost = _NEXT[at], cost + COSTS["I"]
    return np.minimum((inserts[:, :, None] + row[None]).min(axis=1), _NEVER)


_ARCS = [_row_arcs(code) for code in range(16)]
_MATRICES = np.stack([_matrix(code) for code in range(16)])
#: Target state and cost by letter (of a row), code and state; a cost of ``_NEVER`` where there is no such arc.
_TARGET = np.zeros((3, 16, 4), np.int64)
_COST = np.full((3, 16, 4), _NEVER)
for _code, _of_code in enumerate(_ARCS):
    for _l, _name in enumerate("DKR"):
        for _s, _to, _cost in _of_code[_name]:
            _TARGET[_l, _code, _s], _COST[_l, _code, _s] = _to, _cost


def segment_matrices(codes: list[bytes]) -> np.ndarray:
    """The least costs from state to state over each segment's rows."""
    lengths = np.array([len(c) for c in codes])
    out = np.empty((len(codes), 4, 4), np.int64)
    order = np.argsort(-lengths, kind="stable")
    rows = np.zeros((len(codes), int(lengths.max(initial=0))), np.uint8)
    for place, i in enumerate(order.tolist()):
        rows[place, : lengths[i]] = np.frombuffer(codes[i], np.uint8)
    total = np.where(np.eye(4, dtype=bool), 0, _NEVER)[None].repeat(len(codes), 0)
    active = len(codes)
    for at in range(rows.shape[1]):
        while lengths[order[active - 1]] <= at:
            active -= 1
        step = total[:active, :, :, None] + _MATRICES[rows[:active, at]][:, None]
        total[:active] = np.minimum(step.min(axis=2), _NEVER)
    out[order] = total
    return out


# --- path ranking ---------------------------------------------------------------------


def _costs(codes: np.ndarray, lengths: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Costs to go of the states before each row and at the end: segments, places, states."""
    n, longest = len(lengths), int(lengths.max())
    costs = np.full((n, longest + 1, 4), _NEVER)
    costs[np.arange(n), lengths] = ends
    for at in range(longest - 1, -1, -1):
        now = np.flatnonzero(lengths > at)
        costs[now, at] = (_MATRICES[codes[now, at]] + costs[now, at + 1][:, None, :]).min(axis=2)
    return costs


def _ranked_paths(segments: list[tuple[bytes, bool, list[int]]]) -> list[tuple[list[int], list[str]]]:
    """Exit state and audit for each entry state of segments (codes, whether the last, costs at the end)."""
    lengths = np.array([len(c) for c, _, _ in segments])
    n, longest = len(segments), int(lengths.max())
    codes = np.zeros((n, longest + 1), np.uint8)
    for i, (c, _, _) in enumerate(segments):
        codes[i, : len(c)] = np.frombuffer(c, np.uint8)
    last = np.array([l for _, l, _ in segments])
    costs = _costs(codes, lengths, np.array([e for _, _, e in segments]))

    # Arcs on cheapest paths: the place they leave, their letter and the place they reach.
    place = np.arange(n * (longest + 1) * 4).reshape(costs.shape)
    within = np.arange(longest + 1)[None, :] < lengths[:, None]
    leaves, letters, reaches = [], [], []

    def add(letter: str, where: np.ndarray, target: np.ndarray) -> None:
        leaves.append(place[where])
        letters.append(np.full(int(where.sum()), LETTERS.index(letter) + 1))
        reaches.append(target[where])

    further = np.concatenate([costs[:, 1:], np.full((n, 1, 4), _NEVER)], axis=1)
    states = np.arange(4)[None, None, :]
    for number, letter in enumerate("DKR"):
        to = _TARGET[number][codes]
        cost = _COST[number][codes] + np.take_along_axis(further, to, axis=2)
        add(letter, within[:, :, None] & (cost == costs), place + 4 + to - states)
    inserts = within | (last[:, None] & (np.arange(longest + 1)[None, :] == lengths[:, None]))
    cost = COSTS["I"] + costs[:, :, _NEXT]
    add("I", inserts[:, :, None] & (cost == costs), place + _NEXT[None, None, :] - states)

    leave, letter, reach = map(np.concatenate, (leaves, letters, reaches))
    order = np.lexsort((letter, leave))
    leave, letter, reach = leave[order], letter[order], reach[order]
    stop = len(leave)  # the arc after the last one
    first = np.searchsorted(leave, reach)
    going_on = (first < stop) & (leave[np.minimum(first, stop - 1)] == reach)
    pointer = np.append(np.where(going_on, first, stop), stop)
    rank = np.append(letter, 0)
    pointers = [pointer]
    while (pointer != stop).any():
        _, rank = np.unique(rank * (rank.max() + 1) + rank[pointer], return_inverse=True)
        pointer = pointer[pointer]
        pointers.append(pointer)

    by_rank = np.lexsort((rank[:stop], leave))
    entries = by_rank[np.searchsorted(leave[by_rank], place[:, 0, :].ravel())]
    path = entries[:, None]
    for pointer in reversed(pointers):
        path = np.stack([path, pointer[path]], axis=2).reshape(len(entries), -1)
    text = np.append(letter, 0).astype(np.uint8)[path]
    n_letters = (text > 0).sum(axis=1)
    exits = reach[path[np.arange(len(path)), n_letters - 1]] % 4
    audit = np.frombuffer(b"\0" + LETTERS.encode(), np.uint8)[text]
    audits = [row[:k].tobytes().decode() for row, k in zip(audit, n_letters.tolist())]
    return [(exits[4 * i : 4 * i + 4].tolist(), audits[4 * i : 4 * i + 4]) for i in range(n)]


def least_paths(segments: list[tuple[bytes, bool, list[int]]]) -> list[tuple[list[int], list[str]]]:
    """``_ranked_paths`` of segments of like length at a time, so that short ones are not padded to long ones."""
    out: list = [None] * len(segments)
    order = sorted(range(len(segments)), key=lambda i: len(segments[i][0]))
    at = 0
    while at < len(order):
        shortest, end = len(segments[order[at]][0]), at
        while end < len(order):
            longest = len(segments[order[end]][0])
            if end > at and (longest > 2 * shortest or (end - at + 1) * (longest + 1) * 4 > _NODES_AT_ONCE):
                break
            end += 1
        for i, result in zip(order[at:end], _ranked_paths([segments[i] for i in order[at:end]])):
            out[i] = result
        at = end
    return out


# --- tasks ----------------------------------------------------------------------------

_SEGMENT_FIELDS = (
    "id long, codes binary, roles array<string>, texts array<string>, matrix array<long>, blank long, duplicate long,"
    " truncated long, illegal long, first int, last int, low long, high long, n_turns long"
)


class _Segment:
    """Rows of a conversation that follow each other, and what is counted over them."""

    def __init__(self, conversation):
        self.conversation = conversation
        self.codes = bytearray()
        self.roles: list[str | None] = []
        self.texts: list[str | None] = []
        self.blank = self.duplicate = self.truncated = self.illegal = self.n_turns = 0
        self.low = self.high = None
        self.characters = 0

    def full(self, rows: int) -> bool:
        return len(self.codes) >= rows or self.characters >= SEGMENT_CHARACTERS

    def add(self, turn, role: str, text: str, initial: int, fault: str | None, n: int) -> None:
        """``n`` equal rows."""
        code = initial | (_DELETE if fault in ("blank", "duplicate") else 0) | (_TRUNCATED if fault == "truncated" else 0)
        stays = not code & _DELETE
        if self.codes:
            self.illegal += (self.codes[-1] & 3, initial) not in _LEGAL
        self.illegal += n - 1 if (initial, initial) not in _LEGAL else 0
        self.codes += bytes([code]) * n
        self.roles += [role if stays else None] * n
        self.texts += [text if stays else None] * n
        if fault:
            setattr(self, fault, getattr(self, fault) + n)
        if turn is not None and turn != self.high:
            self.n_turns += 1
            self.low = turn if self.low is None else self.low
            self.high = turn
        self.characters += len(text) if stays else 0


def _cut(conversation_type: pa.DataType, segment_rows: int):
    """Rows in order to segments of at most ``segment_rows``; ids tell their order in the whole table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        done: list[_Segment] = []
        segment: _Segment | None = None

        def flush() -> pa.RecordBatch:
            nonlocal done, number
            ids = list(range(number, number + len(done)))
            number += len(done)
            matrices = segment_matrices([bytes(s.codes) for s in done])
            columns = [
                pa.array([s.conversation for s in done], conversation_type),
                pa.array(ids, pa.int64()),
                pa.array([bytes(s.codes) for s in done], pa.binary()),
                pa.array([s.roles for s in done], pa.list_(pa.string())),
                pa.array([s.texts for s in done], pa.list_(pa.string())),
                pa.array(matrices.reshape(len(done), 16).tolist(), pa.list_(pa.int64())),
                *[pa.array([getattr(s, c) for s in done], pa.int64()) for c in ("blank", "duplicate", "truncated", "illegal")],
                pa.array([s.codes[0] & 3 for s in done], pa.int32()),
                pa.array([s.codes[-1] & 3 for s in done], pa.int32()),
                *[pa.array([getattr(s, c) for s in done], pa.int64()) for c in ("low", "high", "n_turns")],
            ]
            done = []
            names = ["conv", *(f.split()[0] for f in _SEGMENT_FIELDS.split(", "))]
            return pa.RecordBatch.from_arrays(columns, names=names)

        for batch in batches:
            for conv, turn, role, text, initial, n, is_new, is_blank, is_cut in zip(*(c.to_pylist() for c in batch.columns)):
                fault = "blank" if is_blank else "duplicate" if not is_new else "truncated" if is_cut else None
                # The first of equal rows has its own fault, the others repeat it.
                kinds = [(fault, n)] if is_blank or not is_new else [(fault, 1), ("duplicate", n - 1)]
                for kind, left in kinds:
                    while left:
                        if segment is None or segment.conversation != conv or segment.full(segment_rows):
                            if segment is not None:
                                done.append(segment)
                            segment = _Segment(conv)
                            if len(done) >= _SEGMENTS_AT_ONCE:
                                yield flush()
                        now = min(left, segment_rows - len(segment.codes))
                        segment.add(turn, role, text, initial, kind, now)
                        left -= now
        if segment is not None:
            done.append(segment)
            yield flush()

    return run


def _borders(conversation_type: pa.DataType):
    """Totals of a conversation, and its segments in order with the costs at their ends."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for conv, parts in zip(batch.column("conv").to_pylist(), batch.column("parts").to_pylist()):
                sums = {c: sum(p[c] for p in parts) for c in ("blank", "duplicate", "truncated", "illegal", "n_turns")}
                sums["illegal"] += sum((a["last"], b["first"]) not in _LEGAL for a, b in zip(parts, parts[1:]))
                turned = [p for p in parts if p["low"] is not None]
                gaps = 0
                if turned:
                    different = sums["n_turns"] - sum(a["high"] == b["low"] for a, b in zip(turned, turned[1:]))
                    gaps = min(turned[-1]["high"] - turned[0]["low"] + 1 - different, 2**63 - 1)
                costs, ends = _AT_END, []
                for p in reversed(parts):
                    ends.append(costs)
                    costs = (np.array(p["matrix"]).reshape(4, 4) + costs[None]).min(axis=1)
                segments = [
                    {"id": p["id"], "last": i == len(parts) - 1, "ends": e.tolist()}
                    for i, (p, e) in enumerate(zip(parts, reversed(ends)))
                ]
                rows.append((conv, parts[0]["id"], gaps, *(sums[c] for c in ("blank", "duplicate", "truncated", "illegal")), int(costs[0]), segments))
            if not rows:
                continue
            columns = list(zip(*rows))
            segment = pa.list_(pa.struct([("id", pa.int64()), ("last", pa.bool_()), ("ends", pa.list_(pa.int64()))]))
            kinds = [conversation_type, *[pa.int64()] * 7, segment]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)],
                names=["conv", "number", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "segments"],
            )

    return run


def _rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        segments = list(zip(*(batch.column(c).to_pylist() for c in ("codes", "last", "ends"))))
        exits, audits = zip(*least_paths(segments))
        yield pa.RecordBatch.from_arrays(
            [batch.column("number"), batch.column("id"), pa.array(exits, pa.list_(pa.int32())), pa.array(audits, pa.list_(pa.string()))],
            names=["number", "id", "exits", "audits"],
        )


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The state in which each segment is entered."""
    for batch in batches:
        ids, entries = [], []
        for parts in batch.column("parts").to_pylist():
            state = NOTHING
            for p in parts:
                ids.append(p["id"])
                entries.append(state)
                state = p["exits"][state]
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(entries, pa.int32())], names=["id", "entry"])


def repaired_rows(audit: str, state: int, codes: bytes, roles: list, texts: list) -> Iterator[tuple[str, str]]:
    """Role and text of the rows that the edits leave."""
    at = 0
    for letter in audit:
        due = "assistant" if state == AFTER_U else "user"
        if letter == "I":
            yield due, ""
            state = int(_NEXT[state])
            continue
        if letter == "K":
            yield roles[at], texts[at]
            state = _KEPT[state, codes[at] & 3]
        elif letter == "R":
            yield due, texts[at]
            state = int(_NEXT[state])
        at += 1


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Audit and digest of each conversation; its segments follow one another."""
    now, digest, parts, begun = None, None, [], False

    def row() -> pa.RecordBatch:
        columns = [pa.array([now], pa.int64()), pa.array(["".join(parts)]), pa.array([digest.hexdigest()])]
        return pa.RecordBatch.from_arrays(columns, names=["number", "audit", "repaired_sha256"])

    finished: list[pa.RecordBatch] = []
    for batch in batches:
        for i in range(batch.num_rows):
            number, entry, audits, codes, roles, texts = (
                batch.column(c)[i].as_py() for c in ("number", "entry", "audits", "codes", "roles", "texts")
            )
            if number != now:
                if now is not None:
                    finished.append(row())
                now, digest, parts, begun = number, hashlib.sha256(), [], False
            parts.append(audits[entry])
            for role, text in repaired_rows(audits[entry], entry, codes, roles, texts):
                digest.update(f"{chr(10) if begun else ''}{role}:{text}".encode())
                begun = True
        if finished:
            yield pa.Table.from_batches(finished).combine_chunks().to_batches()[0]
            finished = []
    if now is not None:
        yield row()


# --- plans ----------------------------------------------------------------------------

_SPACES = " \t\n\x0b\x0c\r"


def damaged(chats: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The rows after damage: ``conv``, ``turn``, ``role``, ``text`` and ``n``, the number of equal ones."""

    def whole(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    act = F.pmod(F.crc32(F.concat(whole(conv), F.lit(":"), whole(turn))), F.lit(20))
    rows = chats.select(
        F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"), whole(role).alias("role"), whole(text).alias("text"), act.alias("act")
    )
    left = F.when(F.col("act") == 1, "").when(F.col("act") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    rows = rows.where("act <> 0").select(
        "conv", "turn", F.when(F.col("act") == 4, "user").otherwise(F.col("role")).alias("role"), left.alias("text"),
        F.when(F.col("act") == 3, 2).otherwise(1).alias("n"),
    )
    return rows.groupBy("conv", "turn", "role", "text").agg(F.sum("n").alias("n"))


def with_faults(rows: DataFrame) -> DataFrame:
    """The rows with ``new`` (no equal role and text earlier), ``blank`` and ``cut`` (the text stops short)."""
    here = F.struct(F.col("turn").isNotNull(), "turn")
    first = rows.groupBy("conv", "role", "text").agg(F.count("*").alias("n"), F.min(here).alias("first"))
    first = first.where("n > 1").select(F.col("conv").alias("c"), F.col("role").alias("r"), F.col("text").alias("t"), "first")
    same = F.col("conv").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("text") == F.col("t"))
    begins = F.substring("role", 1, 1)
    end = F.rtrim("text", F.lit(_SPACES))
    return rows.join(first.hint("merge"), same, "left").select(
        "conv",
        "turn",
        "role",
        "text",
        F.when(begins == "s", SYSTEM).when(begins == "u", USER).when(begins == "a", ASSISTANT).otherwise(OTHER).alias("initial"),
        "n",
        (F.col("first").isNull() | here.eqNullSafe(F.col("first"))).alias("new"),
        (end == "").alias("blank"),
        (~F.right(end, F.lit(1)).isin(".", "!", "?")).alias("cut"),
    )


def in_ranges(rows: DataFrame) -> DataFrame:
    """Rows in the order of conversation, turn, role and text, dealt by ranges.

    The bounds of ranges are sampled values, so they take only the beginnings of long strings, in an
    order that agrees with that of the whole ones.
    """
    begins = [
        F.substring("role", 1, ORDER_CHARACTERS),
        F.length("role") > ORDER_CHARACTERS,
        F.when(F.length("role") <= ORDER_CHARACTERS, F.substring("text", 1, ORDER_CHARACTERS)),
    ]
    return rows.repartitionByRange("conv", "turn", *begins).sortWithinPartitions("conv", "turn", "role", "text")


def repair(
    chats: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", segment_rows: int = SEGMENT_ROWS
) -> DataFrame:
    """For each conversation its faults after damage and its cheapest repair.

    ``conv``, ``gaps``, ``blank``, ``duplicate``, ``truncated``, ``illegal``, ``cost``, ``audit`` and ``repaired_sha256``.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    kind = chats.schema[conv].dataType
    arrow = to_arrow_type(kind)
    conv_field = T.StructType([T.StructField("conv", kind)])
    with temporary():
        rows = keep(with_faults(keep(damaged(chats, conv, turn, role, text), "damaged")), "faults")
        segment_schema = T.StructType([*conv_field, *T.StructType.fromDDL(_SEGMENT_FIELDS)])
        segments = keep(in_ranges(rows).mapInArrow(_cut(arrow, segment_rows), segment_schema), "segments")

        small = ["id", "matrix", "blank", "duplicate", "truncated", "illegal", "first", "last", "low", "high", "n_turns"]
        gathered = segments.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct(*small))).alias("parts"))
        totals_schema = "number long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long"
        ends = "segments array<struct<id: long, last: boolean, ends: array<long>>>"
        schema = T.StructType([*conv_field, *T.StructType.fromDDL(f"{totals_schema}, {ends}")])
        totals = keep(gathered.mapInArrow(_borders(arrow), schema), "totals", lasting=True)

        borders = totals.select("number", F.explode("segments").alias("s")).select("number", "s.id", "s.last", "s.ends")
        ranked = borders.join(segments.select("id", "codes").hint("merge"), "id").select("number", "id", "codes", "last", "ends")
        paths = keep(ranked.mapInArrow(_rank, "number long, id long, exits array<int>, audits array<string>"), "paths")
        chains = paths.groupBy("number").agg(F.sort_array(F.collect_list(F.struct("id", "exits"))).alias("parts"))
        entries = keep(chains.mapInArrow(_chain, "id long, entry int"), "entries")

        whole = paths.select("number", "id", "audits").join(entries.hint("merge"), "id")
        whole = whole.join(segments.select("id", "codes", "roles", "texts").hint("merge"), "id")
        whole = whole.select("number", "id", "entry", "audits", "codes", "roles", "texts")
        whole = whole.repartition("number").sortWithinPartitions("number", "id")
        edited = keep(whole.mapInArrow(_digest, "number long, audit string, repaired_sha256 string"), "edited", lasting=True)

    named = totals.drop("segments").join(edited.hint("merge"), "number").withColumnRenamed("conv", "c")
    every = chats.select(F.col(conv).alias("conv")).distinct()
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return every.join(named.hint("merge"), F.col("conv").eqNullSafe(F.col("c")), "left").select(
        F.col("conv").alias(conv),
        *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"),
    )
