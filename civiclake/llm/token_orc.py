"""Token ids as ORC files in document order.

Texts are range-partitioned and sorted by document id (the only shuffle,
and it moves texts, which are smaller than their ids), each task encodes
its range with the tokenizers library and writes one ORC file: ids as
run-length encoded integers, row indexes on every column, a Bloom filter
and min/max statistics on the document id.  A row carries its offset inside
its file, so global offsets need only the totals of the files.

Only the distinct space-separated pieces of a batch are encoded; a bounded
per-worker store keeps those seen before.  A space between two visible
characters always starts a new pre-token, so this equals encoding the whole
text; texts with other white space next to a space are cut only where that
holds.

Null text: no ids but the end id.  Null document ids come first.  Rows
with one document id stay separate, ordered by a hash of their text.  An
empty table gives files without rows.  Other columns are not read.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from civiclake.llm.common import chunks, encode_parts, plain, ragged, shuffle_partitions, prepare, text_key

#: Pieces a worker remembers (some 150 bytes each); with more it begins anew.
CACHE_PIECES = 800_000
FILE_SCHEMA = "doc_id long, part int, local_start long, n_tokens long, token_ids array<int>"
#: Options of the ORC writer.
ORC_OPTIONS = {
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
    "orc.create.index": "true",
    "orc.row.index.stride": "2000",
    "orc.stripe.size": str(64 << 20),
    "orc.encoding.strategy": "SPEED",
    "compression": "zstd",
}
#: A space between two visible characters.
CUT = re.compile(r"(?<=\S) (?=\S)")
#: Words that are encoded as one text; only time depends on it.
JOINED = 128
#: White space at an end of a piece (RE2's own class is ASCII only).
_WHITE = r"[\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
ODD = f"^{_WHITE}|{_WHITE}$"


def strings_of(values: pa.Array, index: np.ndarray) -> list[str]:
    return values.take(pa.array(index)).to_numpy(zero_copy_only=False).tolist()


class PieceEncoder:
    """The tokenizers library behind a store of pieces and their ids.

    Words that follow a space are encoded together, ``JOINED`` at a time; each
    begins with the only token that holds its space, which tells them apart
    (where the count of such tokens is another, they are encoded one by one).
    Other pieces (a text's first, odd white space) are encoded as they are.
    """

    def __init__(self, spec: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(spec)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.opens = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        self.opens[[i for t, i in vocabulary.items() if t.startswith("\u0120")]] = True
        self.forget()

    def forget(self) -> None:
        self.spaced: dict[str, int] = {}
        self.exact: dict[str, int] = {}
        self.ids = np.empty(1 << 16, np.int32)
        self.ends = np.zeros(1 << 14, np.int64)  # piece k has ids[ends[k]:ends[k + 1]]
        self.count = 0

    def _append(self, flat: np.ndarray, lengths: np.ndarray) -> None:
        at = self.ends[self.count]
        while at + len(flat) > len(self.ids):
            self.ids = np.concatenate((self.ids, np.empty_like(self.ids)))
        while self.count + len(lengths) + 1 > len(self.ends):
            self.ends = np.concatenate((self.ends, np.zeros_like(self.ends)))
        self.ids[at : at + len(flat)] = flat
        self.ends[self.count + 1 : self.count + 1 + len(lengths)] = at + np.cumsum(lengths)
        self.count += len(lengths)

    def _ids(self, strings: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(strings, add_special_tokens=False)]

    def _one_by_one(self, strings: list[str]) -> None:
        found = self._ids(strings)
        self._append(np.array([i for x in found for i in x], np.int32), np.array([len(x) for x in found], np.int64))

    def words(self, strings: list[str]) -> np.ndarray:
        """Numbers of words that follow a space."""
        known = self.spaced
        new = [s for s in strings if s not in known]
        groups = [new[i : i + JOINED] for i in range(0, len(new), JOINED)]
        for group, ids in zip(groups, self._ids([" " + " ".join(g) for g in groups]), strict=True):
            known.update(zip(group, range(self.count, self.count + len(group))))
            flat = np.array(ids, np.int32)
            first = np.flatnonzero(self.opens[flat])
            if len(first) == len(group) and first[0] == 0:
                self._append(flat, np.diff(np.append(first, len(flat))))
            else:
                self._one_by_one([" " + s for s in group])
        return np.fromiter(map(known.__getitem__, strings), np.int64, len(strings))

    def pieces(self, strings: list[str]) -> np.ndarray:
        """Numbers of pieces that are encoded as they are."""
        new = [s for s in dict.fromkeys(strings) if s not in self.exact]
        self.exact.update(zip(new, range(self.count, self.count + len(new))))
        if new:
            self._one_by_one(new)
        return np.fromiter(map(self.exact.__getitem__, strings), np.int64, len(strings))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one int32 array, and the offsets of each text."""
        if self.count >= CACHE_PIECES:
            self.forget()
        lists = pc.split_pattern(texts, " ")
        words = encode_parts(lists)
        codes, offsets = words.codes, words.offsets
        # a text is cut at every space only if each piece begins and ends with a visible character
        odd = pc.match_substring_regex(words.uniq, ODD).to_numpy(zero_copy_only=False).astype(bool)
        n_parts = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
        unsafe = (n_parts != np.diff(offsets)) & (n_parts > 1)
        if odd.any():
            unsafe[words.rows[odd[codes]]] = True
        lead = offsets[:-1][~unsafe & (np.diff(offsets) > 0)]  # no space before it
        follows = np.ones(len(codes), bool)
        follows[lead] = False
        bad = np.flatnonzero(unsafe)
        for row in bad.tolist():
            follows[offsets[row] : offsets[row + 1]] = False
        used = np.flatnonzero(np.bincount(codes[follows], minlength=len(words.uniq)))
        of_code = np.zeros(len(words.uniq), np.int64)
        of_code[used] = self.words(strings_of(words.uniq, used))
        number = of_code[codes]
        number[lead] = self.pieces(strings_of(words.uniq, codes[lead]))
        if len(bad):
            number, offsets = self._recut(texts, bad, number, offsets)
        ids, ends = ragged(self.ids, self.ends, number)
        return ids, ends[offsets]

    def _recut(self, texts: pa.Array, bad: np.ndarray, number: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Replace the pieces of some texts by pieces cut at safe spaces only."""
        own = {}
        for row in bad.tolist():
            parts = CUT.split(texts[row].as_py())
            parts = parts[:1] + [" " + p for p in parts[1:]]
            own[row] = self.pieces([p for p in parts if p])
        rows = [own[i] if i in own else number[a:z] for i, (a, z) in enumerate(zip(offsets[:-1], offsets[1:]))]
        return np.concatenate(rows), np.concatenate(([0], np.cumsum([len(r) for r in rows])))


_LOADED: dict[int, PieceEncoder] = {}


def _encoder(spec: str) -> PieceEncoder:
    key = hash(spec)
    if key not in _LOADED:
        _LOADED[key] = PieceEncoder(spec)
    return _LOADED[key]


def write_tokens(docs: DataFrame, spec: str, path: str, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text", files: int | None = None) -> None:
    """Write the ids of every text to ORC files under ``path``, one a range of document ids.

    ``files`` defaults to the session's shuffle partitions; each task holds
    one batch of texts at a time, whatever the size of its range.
    """
    spark = docs.sparkSession
    prepare(spark)
    shared = spark.sparkContext.broadcast(spec)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), text_key(text_col).alias("tie"))
    ordered = rows.repartitionByRange(files or shuffle_partitions(spark), "doc_id", "tie").sortWithinPartitions("doc_id", "tie")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared.value)
        part, start = TaskContext.get().partitionId(), 0
        for b in chunks(batches, "text"):
            ids, off = encoder.encode(plain(b.column("text")))
            n = b.num_rows
            closed = np.full(len(ids) + n, end_id, np.int32)
            keep = np.ones(len(closed), bool)
            keep[off[1:] + np.arange(n)] = False
            closed[keep] = ids
            off = off + np.arange(n + 1)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(np.full(n, part), pa.int32()), pa.array(start + off[:-1], pa.int64()), pa.array(np.diff(off), pa.int64()),
                 pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(closed))],
                names=["doc_id", "part", "local_start", "n_tokens", "token_ids"],
            )
            start += int(off[-1])

    ordered.select("doc_id", "text").mapInArrow(encode, FILE_SCHEMA).write.options(**ORC_OPTIONS).orc(path)


def read_tokens(spark: SparkSession, path: str, doc_ids: list[int] | None = None) -> DataFrame:
    """The files' rows; ``doc_ids`` are pushed to the scan, which skips stripes and
    row groups by statistics and Bloom filter.  Stripes are read in parallel."""
    df = spark.read.schema(FILE_SCHEMA).orc(path)
    return df if doc_ids is None else df.where(F.col("doc_id").isin(doc_ids))


def file_starts(tokens: DataFrame) -> DataFrame:
    """Ids before each file: part, base.  One row a file, so the total order is over few rows."""
    totals = tokens.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))


def token_digests(tokens: DataFrame) -> DataFrame:
    """Per document: global start, n_tokens and the CRC-32 of its ids (little-endian unsigned 32-bit)."""

    def crc(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column("token_ids")
            raw = lists.flatten().to_numpy(zero_copy_only=False).astype("<u4").tobytes()
            n = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
            off = np.concatenate(([0], np.cumsum(n))) * 4
            sums = [zlib.crc32(raw[a:z]) for a, z in zip(off[:-1].tolist(), off[1:].tolist())]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("part"), b.column("local_start"), pa.array(n), pa.array(sums, pa.int64())], names=["doc_id", "part", "local_start", "n_tokens", "ids_crc32"])

    rows = tokens.select("doc_id", "part", "local_start", "token_ids").mapInArrow(crc, "doc_id long, part int, local_start long, n_tokens long, ids_crc32 long")
    # one row a file: its size is bound by the number of files written
    starts = F.broadcast(file_starts(tokens.select("part", "n_tokens")))
    return rows.join(starts, "part").select("doc_id", (F.col("base") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32")
