"""Shared helpers of the text operators: table access, Arrow batches, words
as code arrays, ragged gathers and 64-bit mixing.

Words are runs of anything but space, tab, line feed, vertical tab, form
feed and carriage return.  A batch of texts becomes one flat array of word
codes plus row offsets, so the per-word work is vectorised and Python only
touches the distinct words of a batch.
"""

from __future__ import annotations

import ctypes
import os
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Text bytes that one numpy step works on; only memory depends on it, no result.
CHUNK_BYTES = 6 << 20
#: Rows of an Arrow batch between the JVM and Python (long texts, so fewer than Spark's default).
BATCH_ROWS = 1000

GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the lake; also prepares the session."""
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def prepare(spark: SparkSession) -> None:
    """Session settings of the operators that run Python: smaller Arrow batches where the session still
    has Spark's default, and this package's folder on the workers' path (a cluster gets the package
    by --py-files or as an installed one; there the folder is merely absent)."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) >= 10000:
        spark.conf.set(key, str(BATCH_ROWS))
    here = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    if here not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, (env.get("PYTHONPATH"), here)))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_key(text="text"):
    """64-bit key of a text; with the id it names a row (equal rows share it)."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")), F.col(text).isNull())


def chunks(batches: Iterator[pa.RecordBatch], column: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that a piece holds about ``limit`` bytes of text (one row at least)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            base = size[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(size, base + limit, side="right")))
            yield batch.slice(start, end - start)
            start = end
    release_memory()


def release_memory() -> None:
    """Give memory that is free in this process back to the system: worker processes live on
    after a task, and what an earlier stage touched would count against a later one."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library: it decides itself
        pass


def plain(col: pa.Array) -> pa.Array:
    """The column as a contiguous string array without nulls (null: empty)."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    return pc.fill_null(col.cast(pa.string()), "")


@dataclass
class Words:
    """Words of a batch: ``codes`` index ``uniq``; row i has codes[offsets[i]:offsets[i+1]]."""

    codes: np.ndarray
    offsets: np.ndarray
    uniq: pa.Array

    @property
    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.offsets) - 1), np.diff(self.offsets))


def encode_parts(lists: pa.ListArray) -> Words:
    """Non-empty strings of each list as codes into their distinct values."""
    off = lists.offsets.to_numpy().astype(np.int64)
    values = lists.values
    keep = pc.greater(pc.binary_length(values), 0)
    kept = np.concatenate(([0], np.cumsum(keep.to_numpy(zero_copy_only=False).astype(np.int64))))
    enc = values.filter(keep).dictionary_encode()
    return Words(enc.indices.to_numpy().astype(np.int64), kept[off], enc.dictionary)


def split_words(col: pa.Array, lower_ascii: bool = False) -> Words:
    """The words of each text; ``lower_ascii`` maps A-Z (only) to a-z first."""
    col = plain(col)
    return encode_parts(pc.ascii_split_whitespace(pc.ascii_lower(col) if lower_ascii else col))


def word_hashes(uniq: pa.Array) -> np.ndarray:
    """A 64-bit hash of each string, the same in every process (keyed SipHash)."""
    if not len(uniq):
        return np.empty(0, np.uint64)
    return pd.util.hash_array(uniq.to_numpy(zero_copy_only=False).astype(object), categorize=False)


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def ragged(values: np.ndarray, offsets: np.ndarray, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Concatenate the pieces values[offsets[i]:offsets[i+1]] for i in ``index``; returns them and their offsets."""
    lens = offsets[index + 1] - offsets[index]
    out = np.concatenate(([0], np.cumsum(lens)))
    pos = np.arange(out[-1]) + np.repeat(offsets[index] - out[:-1], lens)
    return values[pos], out


def rolling(values: np.ndarray, width: int, base: int) -> np.ndarray:
    """Rabin-Karp hash (modulo 2**64) of every run of ``width`` values.

    Prefix sums of value * base**i give each window's sum by one
    subtraction; multiplying by the inverse power moves it to position 0.
    """
    n = len(values) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    inverse = pow(base, -1, 1 << 64)
    with np.errstate(over="ignore"):
        up = np.cumprod(np.full(len(values), base, np.uint64))
        down = np.cumprod(np.full(n, inverse, np.uint64))
        prefix = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values * up, dtype=np.uint64)))
        return (prefix[width:] - prefix[:-width]) * down


def shingles(words: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each run of ``width`` words inside a row, and the row of each.

    A row with fewer words, but not none, has one shingle: the whole
    sequence (its length is part of the hash).
    """
    h = word_hashes(words.uniq)[words.codes] if len(words.codes) else np.empty(0, np.uint64)
    rows = words.rows
    n_words = np.diff(words.offsets)
    roll = mix(rolling(h, width, 0xD1342543DE82EF95))
    inside = rows[: len(roll)] == rows[width - 1 :] if len(roll) else np.empty(0, bool)
    out, out_rows = [roll[inside]], [rows[: len(roll)][inside]]
    for k in range(1, width):  # short rows, by their length
        short = np.flatnonzero(n_words == k)
        if len(short):
            first = words.offsets[short]
            acc = np.full(len(short), k, np.uint64)
            for j in range(k):
                acc = mix(acc * GOLDEN + h[first + j])
            out.append(acc)
            out_rows.append(short)
    return np.concatenate(out), np.concatenate(out_rows)


def distinct_in_rows(h: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, hash), sorted by row, then hash."""
    order = np.lexsort((h, rows))
    h, rows = h[order], rows[order]
    first = np.ones(len(h), bool)
    first[1:] = (h[1:] != h[:-1]) | (rows[1:] != rows[:-1])
    return h[first], rows[first]


def batch_of(schema: pa.Schema, **columns) -> pa.RecordBatch:
    arrays = [c if isinstance(c := columns[f.name], pa.Array) else pa.array(c, f.type) for f in schema]
    return pa.RecordBatch.from_arrays([a if a.type == f.type else a.cast(f.type) for a, f in zip(arrays, schema)], schema=schema)
