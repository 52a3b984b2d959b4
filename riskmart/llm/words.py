"""Words, shingles and row keys that several operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SHINGLE_WORDS = 5

# Odd multipliers of the positions of a shingle; any odd numbers with mixed bits would do.
_FACTORS = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F],
    dtype=np.uint64,
)
_MIX = np.uint64(0xFF51AFD7ED558CCD)


_BASE = 0x9FB21C651E98DF25
_CHUNK_BYTES = 1 << 15
LONG_WORD = 512
_SMALL = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_POWERS = np.array([_BASE], np.uint64).repeat(_CHUNK_BYTES)
_POWERS[0] = 1
_POWERS = np.cumprod(_POWERS, dtype=np.uint64)
_INVERSES = np.array([pow(_BASE, -1, 1 << 64)], np.uint64).repeat(_CHUNK_BYTES)
_INVERSES[0] = 1
_INVERSES = np.cumprod(_INVERSES, dtype=np.uint64)


class WordHasher:
    """64-bit hashes of the words of UTF-8 texts, computed for all words of a text at once.

    A word's hash is a polynomial in its bytes with a random value for each of the 256, so the sums
    over prefixes of a text give those of its words. Modulo a power of two, long words of two kinds of
    letters can be made to collide whatever the values (Thue-Morse words of 1,024 letters and
    more), so words of ``LONG_WORD`` bytes and more are hashed by XXH3. ``separators`` are the bytes between
    words; capitals A-Z count as small letters.
    """

    def __init__(self, separators: Iterable[int]):
        self.value = np.random.default_rng(5).integers(1, 1 << 63, 256, dtype=np.uint64)
        self.value[65:91] = self.value[97:123]
        self.apart = np.zeros(256, bool)
        self.apart[list(separators)] = True
        self.value[self.apart] = 0

    def __call__(self, data: bytes) -> np.ndarray:
        raw = np.frombuffer(data, np.uint8)
        parts, start = [], 0
        while start < len(raw):
            end = min(start + _CHUNK_BYTES, len(raw))
            if end < len(raw):  # a chunk ends between words
                gaps = np.flatnonzero(self.apart[raw[start:end]])
                if len(gaps):
                    end = start + int(gaps[-1]) + 1
                else:
                    gaps = np.flatnonzero(self.apart[raw[start:]])
                    end = start + int(gaps[0]) if len(gaps) else len(raw)
                    parts.append(np.array([self._long(data[start:end])], np.uint64))
                    start = end
                    continue
            parts.append(self._short(raw[start:end]))
            start = end
        return np.concatenate(parts) if parts else np.empty(0, np.uint64)

    def _short(self, raw: np.ndarray) -> np.ndarray:
        inside = np.zeros(len(raw) + 2, np.int8)
        np.logical_not(self.apart[raw], out=inside[1:-1].view(bool))
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        starts, ends = edges[::2], edges[1::2]
        sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(self.value[raw] * _POWERS[: len(raw)], out=sums[1:])
        hashes = self._mixed((sums[ends] - sums[starts]) * _INVERSES[starts])
        for i in np.flatnonzero(ends - starts >= LONG_WORD).tolist():
            hashes[i] = self._long(raw[starts[i] : ends[i]].tobytes())
        return hashes

    @staticmethod
    def _long(word: bytes) -> int:
        return xxhash.xxh3_64_intdigest(word.translate(_SMALL))

    @staticmethod
    def _mixed(value: np.ndarray) -> np.ndarray:
        value = value ^ (value >> np.uint64(32))
        value *= _MIX
        return value ^ (value >> np.uint64(31))


#: Words between white space, and words of letters and digits.
between_spaces = WordHasher([32, *range(9, 14)])
alphanumeric = WordHasher(c for c in range(128) if not (48 <= c <= 57 or 65 <= c <= 90 or 97 <= c <= 122))


def sequence_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit hash for each run of ``width`` words, at most five; order matters."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = np.full(n, width, np.uint64)
    for i in range(width):
        total += hashes[i : i + n] * _FACTORS[i]
    total ^= total >> np.uint64(32)
    total *= _MIX
    return total ^ (total >> np.uint64(29))


def shingle_hashes(hashes: np.ndarray) -> np.ndarray:
    """Hashes of the five-word shingles in order; of the whole sequence if it has fewer words."""
    return sequence_hashes(hashes, min(SHINGLE_WORDS, len(hashes))) if len(hashes) else np.empty(0, np.uint64)


def map_texts(
    df: DataFrame,
    schema: str | T.StructType,
    start: Callable[[], Callable[[str], tuple | Iterable[tuple]]],
    keep: list[str],
    text: str = "text",
    many: bool = False,
) -> DataFrame:
    """The columns ``keep`` of ``df`` and, for each row, what a function makes of its text.

    ``start`` runs once in a task and gives that function; a null text reaches it as an empty
    one. With ``many`` it gives any number of result rows for a row, otherwise exactly one.
    """
    added = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    out = T.StructType([df.schema[c] for c in keep] + list(added))
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(added)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = start()
        for batch in batches:
            made: list[tuple] = []
            sources: list[int] = []
            for i, value in enumerate(batch.column("__text")):
                result = work(value.as_py() or "")
                if many:
                    before = len(made)
                    made.extend(result)
                    sources.extend([i] * (len(made) - before))
                else:
                    made.append(result)
            kept = [batch.column(c) for c in keep]
            if many:
                kept = [c.take(pa.array(sources, pa.int64())) for c in kept]
            columns = list(zip(*made, strict=True)) or [()] * len(arrow)
            yield pa.RecordBatch.from_arrays(
                kept + [pa.array(v, f.type) for v, f in zip(columns, arrow, strict=True)], names=out.names
            )

    return df.select(*keep, F.col(text).alias("__text")).mapInArrow(run, out)


ROW = "__row"


def with_row_id(docs: DataFrame, key: str) -> tuple[DataFrame, bool]:
    """``docs`` with a unique long ``__row``, and whether that is the key itself.

    A key that repeats or is null cannot tell rows apart; then the table is numbered and written
    once, so that the numbers stay the same however often it is read.
    """
    from riskmart.sources.scratch import keep

    if dict(docs.dtypes)[key] in ("bigint", "int"):
        clash = docs.groupBy(key).count().where((F.col("count") > 1) | F.col(key).isNull())
        if clash.isEmpty():
            return docs.withColumn(ROW, F.col(key).cast("long")), True
    return keep(docs.withColumn(ROW, F.monotonically_increasing_id()), "rows"), False
