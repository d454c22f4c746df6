"""Removal of word windows that occur more than once.

Every window of ``window`` consecutive words gets a Rabin-Karp hash.  To
count them with little shuffle, windows travel in runs: a window belongs to
the smallest hash among its ``ANCHOR``-word sub-windows (its anchor), so
equal windows have equal anchors, and the consecutive windows of one anchor
make one row (anchor, document, first position, 48-bit hashes).  Rows are
partitioned by anchor; a window repeats if its anchor and hash occur twice.
Two different windows are taken for one only if a 64-bit anchor and an
independent 48-bit hash agree (112 bits in all).

Windows that repeat inside one batch are known at once: they go on as
marks, and one of each remains to be counted, so a passage in a third of
all texts sends one row a batch.  A task sorts its rows by anchor on disk
and holds a bounded number at a time.  An anchor that alone fills a segment
is not held: its windows go on one by one, dealt and sorted by anchor and
hash, where neighbours decide.  Marks return to their documents as runs,
merge into maximal intervals, and the words in them go.

Null and empty texts have no words; a text shorter than the window keeps
all.  Repeated rows (equal id and text) are copies of each other, so their
windows repeat.  An empty table gives an empty result; other columns are
not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civiclake.llm.common import chunks, mix, plain, rolling, shuffle_partitions, prepare, split_words, text_key, word_hashes

#: Words of an anchor (at most the window).
ANCHOR = 8
#: Multipliers of the two rolling hashes (odd).
WINDOW_BASE, ANCHOR_BASE = 0x9FB21C651E98DF25, 0xD6E8FEB86659FD93
HASH_BYTES = 6
#: Windows a task looks at together; only memory depends on it.
SEGMENT = 2_000_000
RUN_SCHEMA = "anchor long, doc_id long, text_key long, start int, n int, hashes binary"
MARK_SCHEMA = "doc_id long, text_key long, start int, n int"
#: Marks, and windows of hot anchors that are still to be counted (marks have no anchor and hash).
OPEN_SCHEMA = MARK_SCHEMA + ", anchor long, hash long"


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every run of ``width`` values, by doubling."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[:-step], out[step:])
        have += step
    return out


def repeats(anchor: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which (anchor, hash) pairs occur twice or more, and which are the first of theirs."""
    key = mix(anchor) ^ h
    order = np.argsort(key, kind="stable")
    a, b = order[:-1], order[1:]
    same = (key[a] == key[b]) & (anchor[a] == anchor[b]) & (h[a] == h[b])
    again = np.zeros(len(key), bool)
    again[a[same]] = True
    again[b[same]] = True
    first = np.ones(len(key), bool)
    first[b[same]] = False
    return again, first


def runs_of(keep: np.ndarray, *breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the runs of kept neighbours with equal values in ``breaks``."""
    idx = np.flatnonzero(keep)
    if not len(idx):
        return idx, idx
    cut = np.diff(idx) != 1
    for x in breaks:
        cut |= x[idx[1:]] != x[idx[:-1]]
    start = np.concatenate(([0], np.flatnonzero(cut) + 1))
    return idx[start], np.diff(np.append(start, len(idx)))


def six_bytes(h: np.ndarray) -> np.ndarray:
    return h.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :HASH_BYTES]


def _batch(names: list[str], columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(columns, names=names)


def window_runs(docs: DataFrame, window: int) -> DataFrame:
    """Rows of RUN_SCHEMA: runs to be counted, and marks (no hashes) known to repeat."""
    anchor_words = min(ANCHOR, window)
    names = [x.split()[0] for x in RUN_SCHEMA.split(", ")]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches, "text"):
            words = split_words(plain(b.column("text")))
            if len(words.codes) < window:
                continue
            h = word_hashes(words.uniq)[words.codes]
            rows = words.rows
            whole = mix(rolling(h, window, WINDOW_BASE)) >> np.uint64(64 - 8 * HASH_BYTES)
            anchors = sliding_min(mix(rolling(h, anchor_words, ANCHOR_BASE)), window - anchor_words + 1)
            own = np.flatnonzero(rows[: len(whole)] == rows[window - 1 :])
            whole, anchors, rows = whole[own], anchors[own], rows[own]
            if not len(own):
                continue
            pos = own - words.offsets[rows]
            again, first = repeats(anchors, whole)
            doc_id, key = b.column("doc_id"), b.column("text_key").to_numpy()

            start, n = runs_of(first, rows, anchors)
            raw = six_bytes(whole[first]).tobytes()
            off = np.concatenate(([0], np.cumsum(n))) * HASH_BYTES
            yield _batch(names, [
                pa.array(anchors[start].view(np.int64)), doc_id.take(pa.array(rows[start])), pa.array(key[rows[start]]), pa.array(pos[start], pa.int32()), pa.array(n, pa.int32()),
                pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(off.astype(np.int32).tobytes()), pa.py_buffer(raw)]),
            ])
            start, n = runs_of(again, rows)
            if len(start):
                yield _batch(names, [
                    pa.array(key[rows[start]]), doc_id.take(pa.array(rows[start])), pa.array(key[rows[start]]), pa.array(pos[start], pa.int32()), pa.array(n, pa.int32()),
                    pa.nulls(len(start), pa.binary()),
                ])

    return docs.mapInArrow(work, RUN_SCHEMA)


def _open(columns: list, anchor: pa.Array | None = None, hashes: pa.Array | None = None) -> pa.RecordBatch:
    none = pa.nulls(len(columns[0]), pa.int64())
    return _batch([x.split()[0] for x in OPEN_SCHEMA.split(", ")], [*columns, none if anchor is None else anchor, none if hashes is None else hashes])


def _exploded(t: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, position and hash of each window of the runs."""
    n = t["n"].to_numpy().astype(np.int64)
    raw = np.frombuffer(b"".join(t["hashes"].to_pylist()), np.uint8).reshape(-1, HASH_BYTES)
    h = np.zeros((len(raw), 8), np.uint8)
    h[:, :HASH_BYTES] = raw
    row = np.repeat(np.arange(len(n)), n)
    return row, np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n) + t["start"].to_numpy()[row], h.view("<u8").ravel()


def repeated_runs(runs: DataFrame) -> DataFrame:
    """Rows of OPEN_SCHEMA: marks of the windows whose anchor and hash occur more than once, and the
    windows of anchors that alone fill a segment."""
    names = [x.split()[0] for x in MARK_SCHEMA.split(", ")]

    def judged(t: pa.Table) -> pa.RecordBatch:
        row, pos, h = _exploded(t)
        again, _ = repeats(t["anchor"].to_numpy().view(np.uint64)[row], h)
        start, count = runs_of(again, row)
        pick = pa.array(row[start])
        return _open([t["doc_id"].combine_chunks().take(pick), t["text_key"].combine_chunks().take(pick), pa.array(pos[start], pa.int32()), pa.array(count, pa.int32())])

    def passed_on(t: pa.Table) -> pa.RecordBatch:
        row, pos, h = _exploded(t)
        pick = pa.array(row)
        take = lambda c: t[c].combine_chunks().take(pick)
        return _open([take("doc_id"), take("text_key"), pa.array(pos, pa.int32()), pa.array(np.ones(len(row), np.int32))], take("anchor"), pa.array(h.view(np.int64)))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size, hot = 0, None
        for b in batches:
            known = b.column("hashes").is_null()
            if known.true_count:
                m = b.filter(known)
                yield _open([m.column(x) for x in names])
                b = b.filter(known.to_numpy(zero_copy_only=False) == False)  # noqa: E712
            if hot is not None and b.num_rows:
                more = int(np.searchsorted(b.column("anchor").to_numpy(), hot, side="right"))
                if more:
                    yield passed_on(pa.Table.from_batches([b.slice(0, more)]).combine_chunks())
                b = b.slice(more)
            if not b.num_rows:
                continue
            hot = None
            held.append(b)
            size += int(b.column("n").to_numpy().sum())
            if size >= SEGMENT:  # all rows of the last anchor wait for the next segment
                t = pa.Table.from_batches(held).combine_chunks()
                anchor = t["anchor"].to_numpy()
                last = int(np.searchsorted(anchor, anchor[-1], side="left"))
                if last:
                    yield judged(t.slice(0, last).combine_chunks())
                t = t.slice(last).combine_chunks()
                held, size = t.to_batches(), int(t["n"].to_numpy().sum())
                if size >= SEGMENT:  # unless they fill it alone
                    hot = anchor[-1]
                    yield passed_on(t)
                    held, size = [], 0
        if held:
            yield judged(pa.Table.from_batches(held).combine_chunks())

    return runs.mapInArrow(work, OPEN_SCHEMA)


def counted(rows: DataFrame) -> DataFrame:
    """Marks: those given, and the open windows whose anchor and hash occur more than once (rows sorted by both)."""
    names = [x.split()[0] for x in MARK_SCHEMA.split(", ")]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, last_again = None, False
        for b in batches:
            done = b.column("anchor").is_null()
            if done.true_count:
                m = b.filter(done)
                yield _batch(names, [m.column(x) for x in names])
                b = b.filter(done.to_numpy(zero_copy_only=False) == False)  # noqa: E712
            if not b.num_rows:
                continue
            t = pa.Table.from_batches([*([] if last is None else [last]), b]).combine_chunks()
            a, h = t["anchor"].to_numpy(), t["hash"].to_numpy()
            same = (a[1:] == a[:-1]) & (h[1:] == h[:-1])
            again = np.zeros(len(a), bool)
            again[0] = last_again
            again[1:] |= same
            again[:-1] |= same
            # the last row waits for its neighbour
            yield from t.select(names).slice(0, len(a) - 1).filter(pa.array(again[:-1])).to_batches()
            last, last_again = b.slice(b.num_rows - 1), bool(again[-1])
        if last_again:
            yield _batch(names, [last.column(x) for x in names])

    return rows.mapInArrow(work, MARK_SCHEMA)


def remove_repeated(docs: DataFrame, window: int = 35, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``id_col``, n_words, n_removed, intervals (word positions, end exclusive) and kept_text
    (the words outside the intervals, joined by one space)."""
    spark = docs.sparkSession
    prepare(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), text_key(text_col).alias("text_key"))
    runs = window_runs(rows, window)
    some = repeated_runs(runs.repartition(shuffle_partitions(spark), "anchor").sortWithinPartitions("anchor"))
    # windows meet by anchor and hash; marks have neither and are dealt by their place
    deal = F.coalesce("anchor", "text_key"), F.coalesce(F.col("hash"), F.xxhash64("doc_id", "start"))
    marks = counted(some.repartition(shuffle_partitions(spark), *deal).sortWithinPartitions("anchor", "hash"))
    # bounded by the length of the text: a set, as equal rows bring equal marks
    marks = marks.groupBy("doc_id", "text_key").agg(F.collect_set(F.struct("start", "n")).alias("marks"))
    m = marks.select(F.col("doc_id").alias("m_id"), F.col("text_key").alias("m_key"), "marks")
    joined = rows.join(m, (F.col("text_key") == F.col("m_key")) & F.col("doc_id").eqNullSafe(F.col("m_id")), "left").select("doc_id", "text", "marks")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches, "text"):
            out = [_without(t, m, window) for t, m in zip(plain(b.column("text")).to_pylist(), b.column("marks").to_pylist())]
            yield _batch(["doc_id", "n_words", "n_removed", "intervals", "kept_text"], [
                b.column("doc_id"), pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int64()),
                pa.array([x[2] for x in out], pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))), pa.array([x[3] for x in out], pa.string()),
            ])

    schema = "doc_id long, n_words long, n_removed long, intervals array<struct<start:int,end:int>>, kept_text string"
    return joined.mapInArrow(work, schema).withColumnRenamed("doc_id", id_col)


def _without(text: str, marks: list[dict] | None, window: int) -> tuple[int, int, list[dict], str]:
    words = text.encode().split()
    if not marks:
        return len(words), 0, [], b" ".join(words).decode()
    merged: list[list[int]] = []
    for start, end in sorted((m["start"], m["start"] + m["n"] - 1 + window) for m in marks):
        if merged and start <= merged[-1][1]:
            merged[-1][1] = max(end, merged[-1][1])
        else:
            merged.append([start, end])
    kept, at = [], 0
    for start, end in merged:
        kept += words[at:start]
        at = end
    kept += words[at:]
    return len(words), len(words) - len(kept), [{"start": a, "end": z} for a, z in merged], b" ".join(kept).decode()
