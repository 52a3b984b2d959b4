"""Packing token ids into rows of one length: best fit, decreasing, over a segment tree.

Texts are encoded and cut, without loss, into pieces of at most a row's length. Pieces are taken
from the longest to the shortest; each goes into the open row with the least room that still
holds it. Rows are counted by their room, and a segment tree over these counts finds the least
sufficient room in the logarithm of the row length, however many rows are open.

A task packs what it reads, in blocks of a bounded number of tokens: no shuffle, memory
within the bound, and a lost task repeats only its own rows. Each block leaves a few rows
partly filled, about one in a thousand at the default size.

Defined results: null and empty texts have no tokens and no piece. Repeated rows, null keys
too, are packed each for itself, and unpacking gives them back each for itself: every text that was read has a number
of its own (partition, place in it). Only the key and the text are read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from riskmart.llm.bpe import ids_of_texts, worker_codec, worker_id_memo

ROW_TOKENS = 2048
BLOCK_TOKENS = 4_000_000
MEMO_ENTRIES = 600_000  # about 100 MB in a worker


class RoomTree:
    """How many open rows have each amount of room; finds the least room of at least a size."""

    def __init__(self, most: int):
        self.leaves = 1 << most.bit_length()
        self.count = [0] * (2 * self.leaves)

    def add(self, room: int, change: int) -> None:
        node = room + self.leaves
        while node:
            self.count[node] += change
            node >>= 1

    def least_from(self, size: int) -> int | None:
        """The least room of at least ``size`` that an open row has."""
        node = size + self.leaves
        if self.count[node]:
            return size
        while node > 1:
            if not node & 1 and self.count[node + 1]:  # the sibling to the right has rows
                node += 1
                while node < self.leaves:
                    node = 2 * node if self.count[2 * node] else 2 * node + 1
                return node - self.leaves
            node >>= 1
        return None


def best_fit_decreasing(sizes: list[int], room: int) -> list[list[int]]:
    """The pieces of each row, by number; every size is from 1 to ``room``."""
    tree, rows, with_room = RoomTree(room), [], defaultdict(list)
    for piece in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        size = sizes[piece]
        left = tree.least_from(size)
        if left is None:
            row, left = len(rows), room
            rows.append([])
        else:
            row = with_room[left].pop()
            tree.add(left, -1)
        rows[row].append(piece)
        if left > size:
            with_room[left - size].append(row)
            tree.add(left - size, 1)
    return rows


def _type(key_type: T.DataType, key: str) -> T.StructType:
    return T.StructType(
        [
            T.StructField("n_tokens", T.IntegerType()),
            T.StructField("ids", T.BinaryType()),
            T.StructField("position_ids", T.BinaryType()),
            T.StructField("cu_seqlens", T.ArrayType(T.IntegerType())),
            T.StructField(f"{key}s", T.ArrayType(key_type)),
            T.StructField("pieces", T.ArrayType(T.IntegerType())),
            T.StructField("texts", T.ArrayType(T.LongType())),
        ]
    )


def pack(
    docs: DataFrame,
    rank_file: str,
    pattern: str,
    key: str = "doc_id",
    text: str = "text",
    row_tokens: int = ROW_TOKENS,
    pad_id: int | None = None,
    block_tokens: int = BLOCK_TOKENS,
) -> DataFrame:
    """Rows of ``row_tokens`` ids with what is needed to train on them and to take them apart.

    ``ids`` and ``position_ids`` are little-endian unsigned numbers of two bytes (four if an id or a
    position needs them), padded with ``pad_id`` (by default the first id without a token) and 0, so the rows are those of a matrix.
    Positions start at 0 with each piece; ``cu_seqlens`` holds the starts of the pieces and the
    end of the last, ``<key>s`` and ``pieces`` say whose piece it is and which, ``texts`` of which text that was read.
    """
    with open(rank_file, "rb") as file:
        content = file.read()
    codec = worker_codec(content, pattern)
    pad = max(codec.bytes_of) + 1 if pad_id is None else pad_id
    kind = "<u2" if max(pad, max(codec.bytes_of), row_tokens) < 1 << 16 else "<u4"
    vocabulary = docs.sparkSession.sparkContext.broadcast(content)
    schema = _type(docs.schema[key].dataType, key)
    key_type = to_arrow_type(schema[f"{key}s"].dataType)
    width = np.dtype(kind).itemsize
    places = np.arange(row_tokens, dtype=kind).tobytes()

    def packed(pieces: list[tuple[object, int, bytes, int]]) -> pa.RecordBatch:
        sizes = [len(p[2]) // width for p in pieces]
        rows = best_fit_decreasing(sizes, row_tokens)
        columns: list[list] = [[] for _ in schema]
        for row in rows:
            starts = [0]
            for i in row:
                starts.append(starts[-1] + sizes[i])
            blank = row_tokens - starts[-1]
            values = (
                starts[-1],
                b"".join([pieces[i][2] for i in row]) + np.full(blank, pad, kind).tobytes(),
                b"".join([places[: sizes[i] * width] for i in row]) + bytes(blank * width),
                starts,
                [pieces[i][0] for i in row],
                [pieces[i][1] for i in row],
                [pieces[i][3] for i in row],
            )
            for column, value in zip(columns, values, strict=True):
                column.append(value)
        types = [pa.int32(), pa.binary(), pa.binary(), pa.list_(pa.int32()), key_type, pa.list_(pa.int32()), pa.list_(pa.int64())]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, memo = worker_codec(vocabulary.value, pattern), worker_id_memo(vocabulary.value, pattern, kind, MEMO_ENTRIES)
        waiting, tokens = [], 0
        number = TaskContext.get().partitionId() << 40
        for batch, ids_of in ids_of_texts(batches, "__text", own, memo):
            for owner, ids in zip(batch.column("__key").to_pylist(), ids_of, strict=True):
                for piece, start in enumerate(range(0, len(ids), row_tokens * width)):
                    waiting.append((owner, piece, ids[start : start + row_tokens * width], number))
                    tokens += len(waiting[-1][2]) // width
                    if tokens >= block_tokens:
                        yield packed(waiting)
                        waiting, tokens = [], 0
                number += 1
        if waiting:
            yield packed(waiting)

    return docs.select(F.col(key).alias("__key"), F.col(text).alias("__text")).mapInArrow(run, schema)


def unpack(rows: DataFrame, key: str = "doc_id", width: int = 2) -> DataFrame:
    """``key`` and the ``ids`` (binary) of every text again, one row for each text that was packed."""
    part = F.posexplode(F.arrays_zip(F.col(f"{key}s").alias("k"), F.col("pieces").alias("p"), F.col("texts").alias("t")))
    each = rows.select("ids", "cu_seqlens", part.alias("i", "s"))
    start, stop = F.col("cu_seqlens")[F.col("i")], F.col("cu_seqlens")[F.col("i") + 1]
    each = each.select(
        F.col("s")["k"].alias(key), F.col("s")["t"].alias("own"), F.col("s")["p"].alias("piece"),
        F.substring("ids", start * width + 1, (stop - start) * width).alias("part"),
    )
    parts = each.groupBy(key, "own").agg(F.sort_array(F.collect_list(F.struct("piece", "part"))).alias("parts"))
    joined = F.unhex(F.array_join(F.transform("parts", lambda p: F.hex(p["part"])), ""))
    return parts.select(key, joined.alias("ids"))


def write_matrix(rows: DataFrame, path: str) -> None:
    """Write packed rows as Parquet files, replacing what is there."""
    rows.write.mode("overwrite").parquet(path)
