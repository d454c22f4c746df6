"""Importance resampling towards a target distribution, by hashed n-grams.

Texts are lower-cased (A-Z), every run of separators becomes one space, and
one regex with overlapped matches and boundary lookarounds emits, at each
word start, the spans of the runs of 1 to ``orders`` words.  The CRC-32 of a
span's UTF-8 bytes, modulo ``buckets``, is its feature; a text is scanned
once and kept as its bucket numbers (two bytes a feature).  A bucket's gain
is the log ratio of its smoothed shares in the target and in the corpus; a
text's weight is the mean gain of its features.  Gumbel noise of a hash of
the id makes the highest scores a draw without replacement with
probabilities that follow the weights.

The counts are one row a bucket, whatever the corpus.  The place of the last
row drawn comes from a histogram of the (whole-number) scores; only rows at
or above it are ordered, in ranges, equal rows counted first, so no task
holds more than its range.

Null and empty texts have no words: no features, weight 0.  A null id hashes
as the empty string and comes after other ids in ties; rows with one id and
one score are ordered by a hash of their text.  Repeated rows are drawn one
by one.  An empty table draws nothing; an empty target gives every bucket
its smoothed share.  Other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain
from operator import methodcaller

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from civiclake.llm.common import chunks, plain, prepare, shuffle_partitions, text_key
from civiclake.session import Scratch, materialize

#: A-Z to lower case, every ASCII byte that is no letter or digit to a space; other bytes stay.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
FEATURE_SCHEMA = "doc_id long, text_key long, n_words long, n_features long, buckets binary"
SCORE_SCHEMA = "doc_id long, text_key long, n_words long, n_features long, weight long, score long"


@dataclass(frozen=True)
class Draw:
    """Parameters of a draw; ``percent`` of the rows with at least ``min_words`` words are drawn."""

    orders: int = 2
    buckets: int = 10_000
    percent: int = 25
    min_words: int = 20
    seed: int = 7


def span_pattern(orders: int) -> regex.Pattern:
    """Matches at every word start; group k (0 for the longest) spans one word less than group k - 1
    where the text has enough words, and as much where it ends."""
    p = "[^ ]+"
    for _ in range(orders - 1):
        p = f"({p})(?: [^ ]+)?"
    return regex.compile(f"(?<![^ ]){p}(?![^ ])".encode())


def folded(text: bytes) -> bytes:
    """Lower case, words joined by single spaces."""
    return b" ".join(text.translate(FOLD).split())


def span_crcs(text: bytes, pattern: regex.Pattern, orders: int) -> tuple[np.ndarray, int]:
    """CRC-32 of all runs of 1 to ``orders`` words of a folded text, and its number of words."""
    pick = methodcaller("group", *range(orders)) if orders > 1 else None
    found = pattern.finditer(text, overlapped=True)
    spans = chain.from_iterable(map(pick, found)) if pick else (m[0] for m in found)
    crcs = np.fromiter(map(zlib.crc32, spans), np.uint32).reshape(-1, orders)
    n = len(crcs)
    # a run that the end of the text cuts short repeats a shorter one
    whole = np.arange(n)[:, None] + np.arange(orders, 0, -1) <= n
    return crcs[whole], n


def bucket_type(buckets: int) -> str:
    return "<u2" if buckets <= 1 << 16 else "<u4"


def features(docs: DataFrame, draw: Draw, id_col: str | None = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of FEATURE_SCHEMA: the bucket numbers of every text's features, in text order."""
    prepare(docs.sparkSession)
    doc_id = F.col(id_col).cast("long") if id_col else F.lit(None).cast("long")
    rows = docs.select(doc_id.alias("doc_id"), text_key(text_col).alias("text_key"), F.col(text_col).alias("text"))
    orders, buckets = draw.orders, draw.buckets

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pattern, kind = span_pattern(orders), bucket_type(buckets)
        for b in chunks(batches, "text"):
            found = [span_crcs(folded(t), pattern, orders) for t in plain(b.column("text")).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("text_key"), pa.array([n for _, n in found], pa.int64()), pa.array([len(c) for c, _ in found], pa.int64()),
                 pa.array([(c % np.uint32(buckets)).astype(kind).tobytes() for c, _ in found], pa.binary())],
                names=["doc_id", "text_key", "n_words", "n_features", "buckets"],
            )

    return rows.mapInArrow(work, FEATURE_SCHEMA)


def bucket_counts(found: DataFrame, draw: Draw) -> np.ndarray:
    """Features in each bucket; the driver receives one row a bucket."""
    buckets = draw.buckets

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for b in batches:
            total += np.bincount(flat_buckets(b.column("buckets"), buckets), minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["bucket", "n"])

    got = found.select("buckets").mapInArrow(work, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(buckets, np.int64)
    for r in got:
        out[r["bucket"]] = r["n"]
    return out


def flat_buckets(col: pa.Array, buckets: int) -> np.ndarray:
    return np.frombuffer(b"".join(col.to_pylist()), bucket_type(buckets)).astype(np.int64)


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln) of each bucket's smoothed share in the target over that in the corpus."""
    m = len(corpus)
    all_corpus, all_target = float(corpus.sum() + m), float(target.sum() + m)
    pairs = zip(corpus.tolist(), target.tolist(), strict=True)
    return np.array([math.floor(1000 * math.log((t + 1.0) * all_corpus / ((s + 1.0) * all_target))) for s, t in pairs], np.int64)


def noise(doc_id: int | None, seed: int) -> int:
    """Gumbel noise, in thousandths, of a hash of the id."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scores(found: DataFrame, gain: np.ndarray, draw: Draw) -> DataFrame:
    """Rows of SCORE_SCHEMA."""
    shared = found.sparkSession.sparkContext.broadcast(gain)  # one number a bucket
    seed = draw.seed

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = shared.value
        for b in batches:
            n = b.column("n_features").to_numpy()
            total = np.concatenate(([0], np.cumsum(gain[flat_buckets(b.column("buckets"), len(gain))])))
            end = np.cumsum(n)
            weight = (total[end] - total[end - n]) // np.maximum(n, 1)
            score = weight + np.array([noise(i, seed) for i in b.column("doc_id").to_pylist()], np.int64)
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("doc_id", "text_key", "n_words", "n_features")), pa.array(weight), pa.array(score)], names=[x.split()[0] for x in SCORE_SCHEMA.split(", ")])

    return found.mapInArrow(work, SCORE_SCHEMA)


def ranked(scored: DataFrame, draw: Draw) -> DataFrame:
    """The scored rows and their rank in the draw (null: not drawn)."""
    spark = scored.sparkSession
    able = scored.where(F.col("n_words") >= draw.min_words)
    places = able.count() * draw.percent // 100
    # one row a whole-number score
    counts = able.groupBy("score").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    last = counts.select("score", before.alias("before")).where(F.col("before") < places).agg(F.min("score")).first()[0]
    none = F.lit(None).cast("long").alias("rank")
    if last is None:
        return scored.select("*", none)
    high = (F.col("n_words") >= draw.min_words) & (F.col("score") >= last)
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("text_key")]
    groups = scored.where(high).groupBy(scored.columns).agg(F.count("*").alias("copies"))
    groups = materialize(groups.repartitionByRange(shuffle_partitions(spark), *order).withColumn("slice", F.spark_partition_id()), "resample-order")
    # one row a slice: their number is the number of shuffle partitions
    start = groups.groupBy("slice").agg(F.sum("copies").alias("n"))
    start = start.select("slice", F.coalesce(F.sum("n").over(Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    inside = F.sum("copies").over(Window.partitionBy("slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    rows = groups.withColumn("inside", inside).join(F.broadcast(start), "slice").withColumn("end", F.col("base") + F.col("inside"))
    rows = rows.select(*scored.columns, F.explode(F.sequence(F.col("end") - F.col("copies") + 1, "end")).alias("rank"))
    drawn = rows.withColumn("rank", F.when(F.col("rank") <= places, F.col("rank")))
    return drawn.unionByName(scored.where(~high).select("*", none))


def resample(docs: DataFrame, target: DataFrame, draw: Draw = Draw(), id_col: str = "doc_id", text_col: str = "text", target_col: str = "text") -> DataFrame:
    """Per row of ``docs``: ``id_col``, text_key (see common.text_key), n_words, n_features, weight, score, rank."""
    scratch = Scratch(docs.sparkSession)
    found = materialize(features(docs, draw, id_col, text_col), "resample-features", scratch)
    gain = gains(bucket_counts(found, draw), bucket_counts(features(target, draw, None, target_col), draw))
    scored = materialize(scores(found, gain, draw), "resample-scores")
    scratch.clear()
    return ranked(scored, draw).withColumnRenamed("doc_id", id_col)


def drawn_rows(docs: DataFrame, result: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``resample`` drew, all columns.  Where the draw ends inside a group of
    rows with equal id and text, the whole group is returned."""
    picked = result.where(F.col("rank").isNotNull()).select(F.col(id_col).alias("__drawn_id"), F.col("text_key").alias("__drawn_key")).distinct()
    names = [f"__given_{k}" for k in range(len(docs.columns))]
    given = docs.toDF(*names)
    place = docs.columns.index
    met = (text_key(names[place(text_col)]) == F.col("__drawn_key")) & F.col(names[place(id_col)]).eqNullSafe(F.col("__drawn_id"))
    return given.join(picked, met, "left_semi").toDF(*docs.columns)
