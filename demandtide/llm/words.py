"""Words of whole texts as 64-bit hashes in numpy, for tasks that stream Arrow batches."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser: spreads every input bit over the whole word."""
    h = (h ^ (h >> np.uint64(32))) * _A
    h = (h ^ (h >> np.uint64(29))) * _B
    return h ^ (h >> np.uint64(32))


def shingles(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` words, in order; with fewer words the whole sequence is one run."""
    n = min(n, len(words))
    if not n:
        return words
    with np.errstate(over="ignore"):
        out = mix(words[: len(words) - n + 1] + np.uint64(n))
        for k in range(1, n):
            out = mix(out * _A + words[k : len(words) - n + 1 + k])
    return out


def shingles_at(words: np.ndarray, n: int, starts: np.ndarray) -> np.ndarray:
    """The runs of ``shingles`` that begin at ``starts``; there are at least ``n`` words."""
    with np.errstate(over="ignore"):
        out = mix(words[starts] + np.uint64(n))
        for k in range(1, n):
            out = mix(out * _A + words[starts + k])
    return out


class WordHashes(dict):
    """word (bytes) -> 64-bit hash; filled as words turn up, emptied when it holds ``limit`` of them."""

    def __init__(self, limit: int = 150_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h

    def of(self, text: bytes | None) -> np.ndarray:
        """Hashes of the words ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z; both are what bytes methods do."""
        words = text.lower().split() if text else []
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def narrow(df: DataFrame, key: str, text: str) -> DataFrame:
    """Key and text only, as ``id`` (long) and ``body`` (UTF-8 bytes)."""
    return df.select(F.col(key).cast("long").alias("id"), F.col(text).cast("string").cast("binary").alias("body"))


def crc_mod(column: str, n: int) -> Column:
    return F.crc32(F.col(column).cast("string")) % n


def batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def lists(rows: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    """Array column of numpy rows without a Python object per element."""
    offsets = np.zeros(len(rows) + 1, np.int32)
    np.cumsum([len(r) for r in rows], out=offsets[1:])
    flat = np.concatenate(rows) if rows else np.empty(0, kind.to_pandas_dtype())
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, kind))
