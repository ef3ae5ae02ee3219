"""What the operators on whole texts share: Arrow slices, byte words, word hashes."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Text bytes that one step of a task works on; a longer text is a step of its own.
STEP_BYTES = 4 << 20

# Entries of a task's word cache before it is started anew.
CACHE_WORDS = 200_000

_OTHER_ASCII = bytes(b for b in range(128) if not (48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122))

# bytes.translate table: A-Z to a-z, every other ASCII byte that is no digit or letter to a space.
# Bytes from 0x80 belong to characters beyond ASCII and stay, so a split gives the words
# [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ of the lower-cased text.
ALNUM_TABLE = bytes.maketrans(
    _OTHER_ASCII + b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b" " * len(_OTHER_ASCII) + b"abcdefghijklmnopqrstuvwxyz"
)
# A-Z to a-z only.
LOWER_TABLE = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")

MIX1, MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def two_columns(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Id and text under names of our own, whatever else the table holds."""
    return df.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))


def steps(batches: Iterable[pa.RecordBatch], column: str = "_text", limit: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches that hold about ``limit`` bytes of text each."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        step = (np.cumsum(sizes, dtype=np.int64) - sizes) // limit
        cuts = [0, *(np.flatnonzero(np.diff(step)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:], strict=False):
            yield batch.slice(a, b - a)


def raw_texts(batch: pa.RecordBatch, column: str = "_text") -> list[bytes]:
    """UTF-8 bytes per row, empty for null."""
    return [b or b"" for b in batch.column(column).cast(pa.binary()).to_pylist()]


class WordHashes(dict):
    """Word to 64-bit hash, computed once per word and kept while the task needs few words."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > CACHE_WORDS:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """Bits of every value spread over the whole word (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * MIX1
    x = (x ^ (x >> np.uint64(27))) * MIX2
    return x ^ (x >> np.uint64(31))


def window_hashes(h: np.ndarray, width: int) -> np.ndarray:
    """Polynomial hash of every ``width`` consecutive values; by doubling, so in about 2 log(width) passes."""
    base = 0x9E3779B97F4A7C15
    out, covered, power = None, 0, h
    size = 1
    while True:
        factor = np.uint64(pow(base, size, 1 << 64))
        if width & size:
            # Windows so far, followed by ``size`` more values.
            if out is None:
                out = power
            else:
                n = len(h) - covered - size + 1
                out = out[:n] * factor + power[covered : covered + n]
            covered += size
        if size * 2 > width:
            return out
        n = len(h) - 2 * size + 1
        power = power[:n] * factor + power[size : size + n]
        size *= 2


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenated integer ranges."""
    ends = np.cumsum(lengths)
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(int(ends[-1]) if len(ends) else 0)


def list_column(rows: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    """A list column from one numpy array per row."""
    offsets = np.zeros(len(rows) + 1, dtype=np.int32)
    np.cumsum([len(r) for r in rows], out=offsets[1:])
    flat = np.concatenate(rows) if rows else np.empty(0)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, type=kind))
