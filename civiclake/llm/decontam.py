"""Benchmark decontamination by a prefix-filtered set join, in SQL functions only.

Words are runs of ASCII letters and digits (A-Z in lower case) and of
non-ASCII characters.  An item's windows are its runs of ``window``
consecutive words (an item of fewer words is one window).  Exact containment
needs every word of a window, so one word is a sufficient prefix: the words
of a window are ordered by rarity in the documents (counted over all of
them), and only its rarest one, the anchor, is joined.  A document's words
meet the anchors in the map side of one scan; the anchor's place in the
window gives the only possible span (positional bound), which must fit into
the document (length bound) and equal the window word by word.

Nothing but confirmed hits and one row a document is shuffled.  The anchors
are broadcast in blocks of ``BLOCK_WINDOWS`` windows, each with its number
only; a larger benchmark takes more scans, not a larger broadcast.  The items
of a window are joined to the documents that have it.

Null and empty texts have no words.  Items with null or empty text, or no
words, have no window; items of equal text or repeated ids are each counted
once by id, and a null item id does not count as an item but its windows
hit.  Repeated documents are judged alike, each in its own row.  Empty
tables give an empty result, or no hits.  Other columns are not read.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from civiclake.llm.common import text_key
from civiclake.session import materialize

#: Windows in one broadcast: 13 words and a number each, some 20 MB.
BLOCK_WINDOWS = 50_000
#: Not a word; one stands after the words of each document and carries its count through the join.
END = "\x00"


def words_of(text: Column) -> Column:
    """Words of a text as an array (empty for null)."""
    lower = F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return F.array_remove(F.split(lower, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), "")


def benchmark_windows(items: DataFrame, window: int, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """words (array), item (id as string): the distinct windows of each item."""
    w = items.select(F.col(id_col).cast("string").alias("item"), words_of(F.col(text_col)).alias("w")).where(F.size("w") > 0)
    starts = F.explode(F.sequence(F.lit(0), F.greatest(F.size("w") - window, F.lit(0))))
    return w.select("item", "w", starts.alias("at")).select(F.expr(f"slice(w, at + 1, {window})").alias("words"), "item").distinct()


def anchors(windows: DataFrame, docs: DataFrame, text_col: str) -> DataFrame:
    """The windows (window_id, words) with anchor, their rarest word in the documents, and its place ``off``."""
    vocabulary = materialize(windows.select(F.explode("words").alias("word")).distinct(), "decontam-words")
    said = docs.select(F.explode(words_of(F.col(text_col))).alias("word"))
    # the vocabulary is a benchmark's: Catalyst broadcasts it by its measured size, or else shuffles
    freq = materialize(said.join(vocabulary, "word", "left_semi").groupBy("word").agg(F.count("*").alias("freq")), "decontam-freq")
    each = windows.select("window_id", "words", F.posexplode("words").alias("off", "word"))
    rated = each.join(freq, "word", "left").groupBy("window_id", "words").agg(F.min(F.struct(F.coalesce("freq", F.lit(0)).alias("freq"), "word", "off")).alias("rarest"))
    return rated.select("window_id", "words", F.col("rarest.word").alias("anchor"), F.col("rarest.off").alias("off"))


def hits(docs: DataFrame, block: DataFrame, first: bool) -> DataFrame:
    """doc_id, doc_key, n_words, start, len, window_id: confirmed windows; with ``first`` also a
    row without a span for each document."""
    by_anchor = block.groupBy("anchor").agg(F.collect_list(F.struct("words", "window_id", "off")).alias("windows"))
    if first:
        mark = docs.sparkSession.range(1).select(F.lit(END).alias("anchor"), F.lit(None).cast(by_anchor.schema["windows"].dataType).alias("windows"))
        by_anchor = by_anchor.unionByName(mark)
        docs = docs.withColumn("said", F.concat("w", F.array(F.lit(END))))
    else:
        docs = docs.withColumn("said", F.col("w"))
    met = docs.select("doc_id", "doc_key", "w", F.posexplode("said").alias("pos", "anchor")).join(F.broadcast(by_anchor), "anchor")
    met = met.select("doc_id", "doc_key", "w", "pos", "anchor", F.explode_outer("windows").alias("x"))
    start = F.col("pos") - F.col("x.off")
    fits = (start >= 0) & (start + F.size("x.words") <= F.size("w"))
    # slice() is evaluated only where the span fits
    equal = F.when(fits, F.slice("w", start + 1, F.size("x.words")) == F.col("x.words")).otherwise(False)
    return met.where((F.col("anchor") == END) | equal).select("doc_id", "doc_key", F.size("w").alias("n_words"), start.alias("start"), F.size("x.words").alias("len"), F.col("x.window_id").alias("window_id"))


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 13, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``id_col``, doc_key, n_words, n_hit (words inside a window's occurrence), items (sorted ids)."""
    pairs = materialize(benchmark_windows(benchmark, window), "decontam-pairs")
    # written, so that the numbers are the same wherever they are read
    numbered = materialize(pairs.select("words").distinct().withColumn("window_id", F.monotonically_increasing_id()), "decontam-numbered")
    windows = materialize(anchors(numbered, docs, text_col), "decontam-windows")
    n = windows.count()
    blocks = max(1, -(-n // BLOCK_WINDOWS))
    rows = docs.select(F.col(id_col).alias("doc_id"), text_key(text_col).alias("doc_key"), words_of(F.col(text_col)).alias("w"))
    found = None
    for k in range(blocks):
        # a window's block depends on its words only, so blocks are even and all windows of an anchor may spread
        block = windows if blocks == 1 else windows.where(F.pmod(F.xxhash64("words"), F.lit(blocks)) == k)
        part = hits(rows, block, first=k == 0)
        found = part if found is None else found.unionByName(part)

    # equal rows bring equal spans; a document's spans are bounded by its length
    spans = found.groupBy("doc_id", "doc_key").agg(
        F.max("n_words").alias("n_words"), F.sum(F.col("start").isNull().cast("int")).alias("copies"),
        F.sort_array(F.collect_set(F.when(F.col("start").isNotNull(), F.struct("start", "len")))).alias("spans"),
        F.collect_set("window_id").alias("windows"),
    )
    # spans in order: each adds what lies beyond the furthest end so far
    step = "named_struct('n', a.n + greatest(0, s.start + s.len - greatest(a.upto, s.start)), 'upto', greatest(a.upto, s.start + s.len))"
    n_hit = F.expr(f"aggregate(spans, named_struct('n', 0, 'upto', 0), (a, s) -> {step}, a -> cast(a.n as long))")
    spans = materialize(spans.select("doc_id", "doc_key", "n_words", "copies", n_hit.alias("n_hit"), "windows"), "decontam-spans")
    # items are met by the windows' numbers, so a window of many items costs no more in the broadcast;
    # only documents with hits take part
    said = spans.select("doc_id", "doc_key", F.explode("windows").alias("window_id"))
    of_window = pairs.where("item is not null").join(numbered, "words").select("window_id", "item")
    named = said.join(of_window, "window_id").groupBy("doc_id", "doc_key").agg(F.sort_array(F.collect_set("item")).alias("items"))
    named = materialize(named.select(F.col("doc_id").alias("__id"), F.col("doc_key").alias("__key"), "items"), "decontam-named")
    met = (F.col("doc_key") == F.col("__key")) & F.col("doc_id").eqNullSafe(F.col("__id"))
    out = spans.join(named, met, "left").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    items = F.coalesce("items", F.array().cast("array<string>"))
    return out.select(F.col("doc_id").alias(id_col), "doc_key", F.col("n_words").cast("long").alias("n_words"), "n_hit", items.alias("items"))


def is_contaminated(n_hit: Column, n_words: Column) -> Column:
    return (n_hit > 0) & (20 * n_hit >= n_words)
