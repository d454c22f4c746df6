"""Removal of lines that many documents share, by a sharded minimal perfect hash.

A line's key is the line without ASCII white space at its ends, A-Z in lower
case.  Each document counts once a key, equal keys of a batch first, then in
Spark.  Two independent 64-bit hashes stand for a key: the first selects a
shard and, through the shard's minimal perfect hash, a slot; the second is
the fingerprint in that slot, beside the key's document count in the
narrowest integer type that holds the shard's counts.  Only keys that
documents can lose (``min_docs`` documents or more) are indexed; any other
key meets a foreign fingerprint or no slot.  Two different keys are taken
for one only if both hashes agree (128 bits).

The minimal perfect hash is a cascade of bit arrays: a key that is alone in
its bit stays there, the others go to the next array; a key's slot is the
number of set bits before its own.  It takes some four bits a key.

Documents probe the arrays, lines are not joined.  While all shards together
have at most ``INDEX_BYTES`` they are sent to every task.  Beyond that each
shard stays with the task it is dealt to, and hashes (not lines) travel
there; keys that hold more than 1/``HOT_KEYS`` of all occurrences are in a
shard of their own, which is always sent (at most ``HOT_KEYS`` keys), so no
shard meets a hot key.  Both ways give the same result.

Null and empty texts are one empty line; lines whose key has fewer than
``min_chars`` characters (blank ones) always stay.  Repeated rows are
documents of their own.  An empty table gives an empty result.  Other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civiclake.llm.common import GOLDEN, chunks, distinct_in_rows, mix, plain, prepare, shuffle_partitions, text_key
from civiclake.session import Scratch, materialize

#: White space that a key loses at its ends.
BLANKS = " \t\n\x0b\x0c\r"
#: Keys of a shard.
SHARD_KEYS = 1_000_000
#: Size up to which the whole index is sent to every task.
INDEX_BYTES = 64 << 20
#: Most keys of the shard of hot keys.
HOT_KEYS = 100_000
HOT_SHARD = -1
#: Bits of a level for each key that reaches it.
SPREAD = 2
#: Keys of the two hashes of a line.
SLOT_KEY, PRINT_KEY = "line key to slot", "line fingerprint"
SHARD_SCHEMA = "shard int, keys long, widths binary, bits binary, prints binary, counts binary, count_type string, spare binary"


# -- lines of a batch ---------------------------------------------------------------------------


@dataclass
class Lines:
    """Lines of a batch of texts: line i has key codes[i] (-1: too short to count); ``h1`` and ``h2`` by key."""

    lists: pa.ListArray
    codes: np.ndarray
    h1: np.ndarray
    h2: np.ndarray

    @property
    def offsets(self) -> np.ndarray:
        return self.lists.offsets.to_numpy().astype(np.int64)

    def in_rows(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct keys of each row: codes and rows."""
        rows = np.repeat(np.arange(len(self.lists)), np.diff(self.offsets))
        real = self.codes >= 0
        return distinct_in_rows(self.codes[real], rows[real])


def lines_of(texts: pa.Array, min_chars: int) -> Lines:
    lists = pc.split_pattern(texts, "\n")
    raw = lists.values.dictionary_encode()
    keys = pc.ascii_lower(pc.ascii_trim(raw.dictionary, characters=BLANKS)).dictionary_encode()
    long_enough = pc.greater_equal(pc.utf8_length(keys.dictionary), min_chars).to_numpy(zero_copy_only=False)
    code = keys.indices.to_numpy()
    code = np.where(long_enough[code], code, -1) if len(code) else code
    strings = keys.dictionary.to_numpy(zero_copy_only=False).astype(object)
    h1, h2 = (pd.util.hash_array(strings, hash_key=k, categorize=False) if len(strings) else np.empty(0, np.uint64) for k in (SLOT_KEY, PRINT_KEY))
    return Lines(lists, code[raw.indices.to_numpy()].astype(np.int64), h1, h2)


def key_counts(docs: DataFrame, min_chars: int, text_col: str = "text") -> DataFrame:
    """h1, h2, n: the documents that have a key."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches, "text"):
            lines = lines_of(plain(b.column("text")), min_chars)
            n = np.bincount(lines.in_rows()[0], minlength=len(lines.h1))
            some = n > 0
            yield pa.RecordBatch.from_arrays([pa.array(lines.h1[some].view(np.int64)), pa.array(lines.h2[some].view(np.int64)), pa.array(n[some])], names=["h1", "h2", "n"])

    return docs.select(F.col(text_col).alias("text")).mapInArrow(work, "h1 long, h2 long, n long").groupBy("h1", "h2").agg(F.sum("n").alias("n"))


# -- minimal perfect hash -----------------------------------------------------------------------


class PerfectHash:
    """Minimal perfect hash of distinct 64-bit keys: ``slots`` maps them onto 0 .. n - 1."""

    def __init__(self, widths: np.ndarray, bits: np.ndarray):
        self.widths, self.bits = widths, bits
        self.rank = np.concatenate(([0], np.cumsum(np.bitwise_count(bits).astype(np.int64))))

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        widths, bits = [], []
        while len(keys):
            width = -(-SPREAD * len(keys) // 64) * 64
            at = cls._place(keys, len(widths), width)
            alone = np.bincount(at, minlength=width) == 1
            widths.append(width)
            bits.append(np.packbits(alone, bitorder="little").view("<u8"))
            keys = keys[~alone[at]]
        return cls(np.array(widths, np.int64), np.concatenate(bits) if bits else np.empty(0, np.uint64))

    @staticmethod
    def _place(keys: np.ndarray, level: int, width: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (mix(keys + GOLDEN * np.uint64(level + 1)) % np.uint64(width)).astype(np.int64)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each key; a key that was not in the set has any slot or none (-1)."""
        out = np.full(len(keys), -1, np.int64)
        left, word = np.arange(len(keys)), 0
        for level, width in enumerate(self.widths.tolist()):
            at = self._place(keys[left], level, width)
            cell, bit = word + (at >> 6), (at & 63).astype(np.uint64)
            hit = (self.bits[cell] >> bit) & np.uint64(1) == 1
            cell, bit = cell[hit], bit[hit]
            below = self.bits[cell] & ((np.uint64(1) << bit) - np.uint64(1))
            out[left[hit]] = self.rank[cell] + np.bitwise_count(below)
            left = left[~hit]
            word += width >> 6
        return out


class Shard:
    """Fingerprints and counts behind a perfect hash; ``spare`` has keys whose first hash is taken."""

    def __init__(self, row):
        self.hash = PerfectHash(np.frombuffer(row["widths"], "<i8"), np.frombuffer(row["bits"], "<u8"))
        self.prints = np.frombuffer(row["prints"], "<u8")
        self.counts = np.frombuffer(row["counts"], row["count_type"])
        self.spare = np.frombuffer(row["spare"], "<u8").reshape(-1, 3)

    @staticmethod
    def pack(shard: int, h1: np.ndarray, h2: np.ndarray, n: np.ndarray) -> dict:
        _, first = np.unique(h1, return_index=True)
        again = np.setdiff1d(np.arange(len(h1)), first)
        spare = np.column_stack((h1[again], h2[again], n[again].astype(np.uint64)))
        h1, h2, n = h1[first], h2[first], n[first]
        found = PerfectHash.build(h1)
        slot = found.slots(h1)
        kind = np.min_scalar_type(int(n.max(initial=0))).newbyteorder("<")
        prints, counts = np.empty(len(h1), "<u8"), np.empty(len(h1), kind)
        prints[slot], counts[slot] = h2, n
        return {
            "shard": shard, "keys": len(first) + len(again), "widths": found.widths.astype("<i8").tobytes(), "bits": found.bits.astype("<u8").tobytes(),
            "prints": prints.tobytes(), "counts": counts.tobytes(), "count_type": kind.str, "spare": spare.astype("<u8").tobytes(),
        }

    def lookup(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """Documents of each key; 0 where the key is not in the shard."""
        out = np.zeros(len(h1), np.int64)
        slot = self.hash.slots(h1)
        some = np.flatnonzero(slot >= 0)
        own = some[self.prints[slot[some]] == h2[some]]
        out[own] = self.counts[slot[own]]
        for a, b, n in self.spare.tolist():
            out[(h1 == np.uint64(a)) & (h2 == np.uint64(b))] = n
        return out


def shard_of(h1: np.ndarray, shards: int) -> np.ndarray:
    return ((h1 >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int32)


@dataclass
class Index:
    """Written shards (rows of SHARD_SCHEMA) and their number; ``size`` in bytes."""

    rows: DataFrame
    shards: int
    size: int
    scratch: Scratch


def build_index(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, text_col: str = "text", shard_keys: int = SHARD_KEYS, hot_keys: int = HOT_KEYS) -> Index:
    """Index of the keys that ``min_docs`` documents have, written shard by shard."""
    prepare(docs.sparkSession)
    scratch = Scratch(docs.sparkSession)
    often = materialize(key_counts(docs, min_chars, text_col).where(F.col("n") >= min_docs), "line-keys", scratch)
    keys, total = often.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    shards = max(1, -(-keys // shard_keys))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            hot = b.column("n").to_numpy() > total / hot_keys
            shard = np.where(hot, HOT_SHARD, shard_of(b.column("h1").to_numpy().view(np.uint64), shards))
            yield pa.RecordBatch.from_arrays([pa.array(shard.astype(np.int32)), *b.columns], names=["shard", "h1", "h2", "n"])

    def pack(t: pa.Table) -> pa.Table:
        shard = t["shard"][0].as_py()
        h1, h2, n = (t[c].to_numpy() for c in ("h1", "h2", "n"))
        return pa.Table.from_pylist([Shard.pack(shard, h1.view(np.uint64), h2.view(np.uint64), n)], schema=packed)

    packed = pa.schema([("shard", pa.int32()), ("keys", pa.int64()), *((c, pa.binary()) for c in ("widths", "bits", "prints", "counts")), ("count_type", pa.string()), ("spare", pa.binary())])
    # a group is one shard: shard_keys keys on average, hot_keys at most
    rows = materialize(often.mapInArrow(place, "shard int, h1 long, h2 long, n long").groupBy("shard").applyInArrow(pack, SHARD_SCHEMA), "line-index", scratch)
    size = sum((F.length(c) for c in ("widths", "bits", "prints", "counts", "spare")), F.lit(0))
    return Index(rows, shards, rows.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0], scratch)


class Probe:
    """Shards at hand in a task."""

    def __init__(self, rows: list[dict], shards: int):
        self.shards = shards
        self.at_hand = {r["shard"]: Shard(r) for r in rows}

    def counts(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """Documents of each key, 0 if it is in no shard at hand."""
        hot = self.at_hand.get(HOT_SHARD)
        out = hot.lookup(h1, h2) if hot else np.zeros(len(h1), np.int64)
        shard = shard_of(h1, self.shards)
        for s in np.unique(shard).tolist():
            if s in self.at_hand:
                own = np.flatnonzero((shard == s) & (out == 0))
                out[own] = self.at_hand[s].lookup(h1[own], h2[own])
        return out


# -- removal ------------------------------------------------------------------------------------

OUT_SCHEMA = "doc_id long, text_key long, n_lines long, n_dropped long, kept_text string"
PROBE_SCHEMA = "shard int, h1 long, h2 long, doc_id long, text_key long"


def without(b: pa.RecordBatch, lines: Lines, dropped: np.ndarray) -> pa.RecordBatch:
    """Output rows of a batch; ``dropped`` is per line."""
    off = lines.offsets
    before = np.concatenate(([0], np.cumsum(~dropped)))
    kept = pa.ListArray.from_arrays(pa.array(before[off].astype(np.int32)), lines.lists.values.filter(pa.array(~dropped)))
    n = np.diff(off)
    return pa.RecordBatch.from_arrays(
        [b.column("doc_id"), b.column("text_key"), pa.array(n), pa.array(n - np.diff(before[off])), pc.binary_join(kept, "\n")],
        names=["doc_id", "text_key", "n_lines", "n_dropped", "kept_text"],
    )


def drop_lines(docs: DataFrame, index: Index, min_docs: int = 10, min_chars: int = 1, id_col: str = "doc_id", text_col: str = "text", index_bytes: int = INDEX_BYTES) -> DataFrame:
    """Per row: ``id_col``, text_key, n_lines, n_dropped and kept_text, without the lines whose key
    ``min_docs`` documents of the index have (at least as many as it was built for)."""
    spark = docs.sparkSession
    prepare(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_key(text_col).alias("text_key"), F.col(text_col).alias("text"))
    everywhere = index.size <= index_bytes
    sent = index.rows if everywhere else index.rows.where(F.col("shard") == HOT_SHARD)
    # bounded by index_bytes, or by hot_keys keys
    shared, shards = spark.sparkContext.broadcast([r.asDict() for r in sent.collect()]), index.shards

    def drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        probe = Probe(shared.value, shards)
        for b in chunks(batches, "text"):
            lines = lines_of(plain(b.column("text")), min_chars)
            bad = np.append(probe.counts(lines.h1, lines.h2) >= min_docs, False)
            gone = bad[lines.codes]
            if not everywhere:
                gone |= marked(lines, b.column("marks"))
            yield without(b, lines, gone)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        probe = Probe(shared.value, shards)
        for b in chunks(batches, "text"):
            lines = lines_of(plain(b.column("text")), min_chars)
            code, row = lines.in_rows()
            open_ = probe.counts(lines.h1, lines.h2)[code] == 0
            code, row = code[open_], row[open_]
            at = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [pa.array(shard_of(lines.h1[code], shards)), pa.array(lines.h1[code].view(np.int64)), pa.array(lines.h2[code].view(np.int64)), b.column("doc_id").take(at), b.column("text_key").take(at)],
                names=[c.split()[0] for c in PROBE_SCHEMA.split(", ")],
            )

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        have = None  # the shard whose row came last: rows are sorted by shard, its arrays first
        for b in batches:
            for piece in by_shard(b):
                if piece.column("keys")[0].is_valid:
                    have = Probe([{c: piece.column(c)[0].as_py() for c in piece.schema.names}], shards)
                    continue
                h1, h2 = (piece.column(c).to_numpy().view(np.uint64) for c in ("h1", "h2"))
                if have is None or piece.column("shard")[0].as_py() not in have.at_hand:
                    continue  # no key of this shard is indexed
                yield piece.select(["doc_id", "text_key", "h1", "h2"]).filter(pa.array(have.counts(h1, h2) >= min_docs))

    if everywhere:
        return rows.mapInArrow(drop, OUT_SCHEMA).withColumnRenamed("doc_id", id_col)
    probes = rows.mapInArrow(ask, PROBE_SCHEMA)
    both = index.rows.where(F.col("shard") != HOT_SHARD).unionByName(probes, allowMissingColumns=True)
    dealt = both.repartition(shuffle_partitions(spark), "shard").sortWithinPartitions("shard", F.col("keys").isNull())
    marks = dealt.mapInArrow(answer, "doc_id long, text_key long, h1 long, h2 long")
    # bounded by the lines of a text
    marks = marks.groupBy(F.col("doc_id").alias("m_id"), F.col("text_key").alias("m_key")).agg(F.collect_set(F.struct("h1", "h2")).alias("marks"))
    met = (F.col("text_key") == F.col("m_key")) & F.col("doc_id").eqNullSafe(F.col("m_id"))
    return rows.join(marks, met, "left").select("doc_id", "text_key", "text", "marks").mapInArrow(drop, OUT_SCHEMA).withColumnRenamed("doc_id", id_col)


def by_shard(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Cut a batch of index rows and probes, sorted by shard, where the shard or the kind changes."""
    if not b.num_rows:
        return
    shard, index = b.column("shard").to_numpy(), b.column("keys").is_valid().to_numpy(zero_copy_only=False)
    cut = np.flatnonzero((shard[1:] != shard[:-1]) | (index[1:] != index[:-1])) + 1
    for a, z in zip([0, *cut.tolist()], [*cut.tolist(), b.num_rows]):
        yield b.slice(a, z - a)


def marked(lines: Lines, marks: pa.Array) -> np.ndarray:
    """Lines whose key is among the marks of their row."""
    out = np.zeros(len(lines.codes), bool)
    off = lines.offsets
    for row in np.flatnonzero(marks.is_valid().to_numpy(zero_copy_only=False)).tolist():
        bad = {(m["h1"], m["h2"]) for m in marks[row].as_py()}
        for i in range(off[row], off[row + 1]):
            c = lines.codes[i]
            out[i] = c >= 0 and (int(lines.h1[c].view(np.int64)), int(lines.h2[c].view(np.int64))) in bad
    return out


def remove_common_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``drop_lines`` with an index of the table's own lines."""
    index = build_index(docs, min_docs, min_chars, text_col)
    out = drop_lines(docs, index, min_docs, min_chars, id_col, text_col)
    if index.size <= INDEX_BYTES:  # sent already; else the result still reads it
        index.scratch.clear()
    return out
