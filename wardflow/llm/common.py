"""Helpers that the training-data operators share: word splitting, hashing, batched Arrow passes."""

from __future__ import annotations

import contextlib
import ctypes
import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed by the task: the six ASCII blanks that part words.
BLANKS = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"

_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
SLICE_BYTES = 4 << 20


def words_col(text: Column) -> Column:
    """Words of a text as an array; empty for a null or blank text."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")


def importable(spark: SparkSession) -> None:
    """Let Python workers on this machine import the library from where it lies; a cluster gets it with --py-files."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])


def packed(df: DataFrame) -> DataFrame:
    """The whole row as one column ``row``, so that no column of the input can clash with a name used here."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"))


def unpacked(df: DataFrame, columns: list[str], **new: Column) -> DataFrame:
    """The columns of the packed row, those in ``new`` replaced or added."""
    return df.select(*[new.get(c, F.col("row").getField(c)).alias(c) for c in columns], *[v.alias(c) for c, v in new.items() if c not in columns])


def let(value: Column, fn) -> Column:
    """``fn`` of a value that is computed once, however often ``fn`` uses it and wherever the optimizer moves it."""
    return F.transform(F.array(value), fn)[0]


def slices(batch: pa.RecordBatch, text: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Runs of rows with about ``limit`` bytes of text each (one row at least), so memory does not follow row counts."""
    if not batch.num_rows:
        return
    sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False), np.int64)
    part = (np.cumsum(sizes + 64) - 1) // limit
    starts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for a, b in zip(starts, starts[1:]):
        if b > a:
            yield batch.slice(a, b - a)


def rest() -> None:
    """Give free memory back to the system, for a worker that now waits beside the JVM for its next task."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # another C library keeps what it has
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def map_texts(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str, text: str = "text") -> DataFrame:
    """``fn`` over bounded slices of Arrow batches."""
    def run(batches):
        for batch in batches:
            for part in slices(batch, text):
                yield fn(part)
        rest()
    return df.mapInArrow(run, schema)


def split_words(texts: pa.Array, lower: bool = False) -> tuple[pa.DictionaryArray, np.ndarray]:
    """All words of the texts in order, dictionary encoded, and the offsets of each text's words."""
    texts = pc.fill_null(texts, "")
    if lower:
        texts = pc.ascii_lower(texts)
    lists = pc.ascii_split_whitespace(texts)
    flat, offsets = lists.flatten(), np.asarray(lists.offsets, np.int64)
    offsets = offsets - offsets[0]
    full = np.asarray(pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False), bool)
    if not full.all():  # a blank at either end leaves an empty word
        counts = np.concatenate([[0], np.cumsum(full)])
        flat, offsets = flat.filter(pa.array(full)), counts[offsets]
    return flat.dictionary_encode(), offsets


def hash_values(values: pa.Array) -> np.ndarray:
    """64-bit hashes of the strings of a dictionary."""
    return np.fromiter((xxhash.xxh3_64_intdigest(v) for v in values.to_pylist()), np.uint64, len(values))


def word_hashes(texts: pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of every word, and the offsets of each text's words."""
    coded, offsets = split_words(texts, lower)
    return hash_values(coded.dictionary)[np.asarray(coded.indices)] if len(coded) else np.zeros(0, np.uint64), offsets


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit words."""
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` word hashes (runs may cross texts; the caller leaves those out)."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for k in range(size):
        out += words[k : k + n] * np.uint64(_odd(k))
    return mix(out)


def _odd(k: int) -> int:
    """A fixed odd factor for each place of a run."""
    return pow(0x9E3779B97F4A7C15, 2 * k + 3, 1 << 64) | 1


def lists(values: np.ndarray, lengths: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


class Bloom:
    """Bloom filter over 64-bit hashes, built by Spark and broadcast.

    The bit count is fixed, so what is broadcast has a fixed size; a fuller filter lets more rows through and never
    loses one.  Two bits per key, taken from the low and the high half of the hash.
    """

    def __init__(self, bits: int, words: np.ndarray):
        self.bits, self.words = bits, words

    @staticmethod
    def columns(key: Column, bits: int) -> Column:
        """Array of (word, mask) pairs of a key."""
        places = (key, F.shiftrightunsigned(key, 32))
        at = [p.bitwiseAND(F.lit(bits - 1)) for p in places]
        return F.array(*[F.struct(F.shiftright(a, 6).cast("int").alias("word"),
                                  F.expr("shiftleft(1L, 0)").alias("one"), a.bitwiseAND(F.lit(63)).cast("int").alias("bit")) for a in at])

    @classmethod
    def build(cls, keys: DataFrame, key: str, bits: int, **where: Column) -> dict[str, Bloom]:
        """One filter for each named condition over the rows of ``keys``; the result has at most bits / 64 rows."""
        rows = keys.select(F.explode(cls.columns(F.col(key), bits)).alias("b"), *[c.alias(n) for n, c in where.items()])
        mask = F.call_function("shiftleft", F.col("b.one"), F.col("b.bit"))
        found = rows.groupBy("b.word").agg(*[F.bit_or(F.when(F.col(n), mask).otherwise(F.lit(0).cast("long"))).alias(n) for n in where]).toArrow()
        at, out = found.column("word").to_numpy(), {}
        for n in where:
            words = np.zeros(bits // 64, np.uint64)
            words[at] = found.column(n).to_numpy().view(np.uint64)
            out[n] = cls(bits, words)
        return out

    def has(self, keys: np.ndarray) -> np.ndarray:
        """Whether each hash may be in the set."""
        out = np.ones(len(keys), bool)
        for place in (keys, keys >> np.uint64(32)):
            place = place & np.uint64(self.bits - 1)
            out &= (self.words[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) == 1
        return out


def doc_numbers(batch: pa.RecordBatch, null: int) -> np.ndarray:
    """Document ids as integers, null as the given number."""
    return np.asarray(pc.fill_null(batch.column("doc_id"), null).to_numpy(zero_copy_only=False), np.int64)
