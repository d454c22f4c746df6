"""Phrase collocations by set-oriented mining of occurrence relations.

Texts are cut into pieces and words.  The relation of length k holds the
occurrences of frequent phrases of k words, sorted by piece and position: a
place is the number of words before plus the number of pieces begun, so
places of neighbours in a piece differ by one and pieces never touch.  It is
written to shared storage as rows of some thousand occurrences (a block: the
texts of one language in one batch).  One step of the mining

1. merge-joins the relation of length k with that of length 1 on the next
   place (both lie in one row, so nothing is shuffled),
2. counts the groups, (frequent phrase, next word), in Spark,
3. numbers the groups with ``min_count`` occurrences, and
4. semi-joins the extended occurrences with them, which is the next relation.

Step 4 sends the numbered groups to every task while there are at most
``SENT_GROUPS``; beyond that the distinct groups of each block are joined
with them in Spark.  Both ways give the same relation.  A group is an exact
pair of numbers; only single words are met by a 64-bit hash of language and
word.  Candidates are scored by their weakest cut, in exact integers, with
DataFrame joins.

Null and empty texts have no words; a null language is ``und``.  Repeated
rows count each time.  An empty table gives an empty result; other columns
are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from civiclake.llm.common import GOLDEN, chunks, encode_parts, mix, plain, prepare, word_hashes
from civiclake.session import Scratch, materialize

#: Groups up to which the semi-join sends them to every task (16 bytes each).
SENT_GROUPS = 4_000_000
#: Occurrences a task counts together before they go to Spark; only memory depends on it.
COMBINED = 2_000_000
#: Bits of a word's number inside a group; the rest is the number of the phrase before it.
WORD_BITS = 28
#: A-Z to lower case, what ends a piece to a line feed, tab to space.
FOLD = bytes(c + 32 if 65 <= c <= 90 else 10 if c in b".,;:!?\n\x0b\x0c\r" else 32 if c == 9 else c for c in range(256))
BLOCK_SCHEMA = "lang string, words array<string>, n array<long>, place binary, codes binary"
RELATION_SCHEMA = "block long, place1 binary, id1 binary, place binary, id binary"
RELATION = [c.split()[0] for c in RELATION_SCHEMA.split(", ")]


@dataclass(frozen=True)
class Mining:
    min_count: int = 30
    max_words: int = 4
    #: A phrase goes if a longer one around it has this percentage of its occurrences.
    absorbed_percent: int = 80
    top: int = 2000
    scale: int = 2_000_000


# -- packed columns of the relation -------------------------------------------------------------


def pack(values: np.ndarray) -> bytes:
    """Numbers from 0 on in the narrowest type; the first byte is its width."""
    kind = np.min_scalar_type(int(values.max(initial=0)))
    return bytes([kind.itemsize]) + values.astype(kind.newbyteorder("<")).tobytes()


def unpack(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, f"<u{raw[0]}", offset=1).astype(np.int64)


def pack_places(place: np.ndarray) -> bytes:
    return pack(np.diff(place, prepend=0))


def unpack_places(raw: bytes) -> np.ndarray:
    return np.cumsum(unpack(raw))


# -- words, and the relation of length 1 --------------------------------------------------------


def words_and_places(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct words of some texts, the word and the place of each occurrence."""
    off = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = (texts.buffers()[2].to_pybytes()[off[0] : off[-1]] if off[-1] > off[0] else b"").translate(FOLD)
    off -= off[0]
    folded = pa.StringArray.from_buffers(len(texts), pa.py_buffer(off.astype(np.int32).tobytes()), pa.py_buffer(data))
    words = encode_parts(pc.ascii_split_whitespace(folded))
    raw = np.frombuffer(data, np.uint8)
    gap = (raw == 32) | (raw == 10)
    first = ~gap
    first[1:] &= gap[:-1]
    row_start = off[:-1][np.diff(off) > 0]
    first[row_start] = ~gap[row_start]
    # pieces begin after a line feed or with a row
    cut = raw == 10
    begun = np.cumsum(cut.astype(np.int64))
    begun += np.cumsum(np.bincount(row_start, minlength=len(raw)))
    place = np.arange(len(words.codes)) + begun[first]
    return words.uniq, words.codes, place


def blocks(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Rows of BLOCK_SCHEMA: distinct words with their counts, and all occurrences by place."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches, "text"):
            lang = b.column("lang").dictionary_encode()
            code, texts = lang.indices.to_numpy(), plain(b.column("text"))
            for k, name in enumerate(lang.dictionary.to_pylist()):
                uniq, codes, place = words_and_places(texts.filter(pa.array(code == k)))
                if len(codes):
                    n = np.bincount(codes, minlength=len(uniq))
                    yield pa.RecordBatch.from_pydict(
                        {"lang": pa.array([name]), "words": pa.ListArray.from_arrays([0, len(uniq)], uniq), "n": pa.ListArray.from_arrays([0, len(n)], n),
                         "place": pa.array([pack_places(place)], pa.binary()), "codes": pa.array([pack(codes)], pa.binary())}
                    )

    return docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).alias("text")).mapInArrow(work, BLOCK_SCHEMA)


def word_keys(lang: pa.Array, words: pa.Array) -> np.ndarray:
    """64-bit key of a word of a language (one language for all words, or one each)."""
    with np.errstate(over="ignore"):
        return mix(word_hashes(words) + word_hashes(lang) * GOLDEN)


def extended(row: dict, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Merge-join of a block's relation of ``length`` with its words: place, phrase and next word of each occurrence."""
    place1, id1 = unpack_places(row["place1"]), unpack(row["id1"])
    place, found = (place1, id1) if length == 1 else (unpack_places(row["place"]), unpack(row["id"]))
    at = np.searchsorted(place1, place + length)
    meets = at < len(place1)
    meets[meets] = place1[at[meets]] == place[meets] + length
    return place[meets], found[meets], id1[at[meets]]


def group_keys(phrase: np.ndarray, word: np.ndarray) -> np.ndarray:
    return (phrase.astype(np.uint64) << np.uint64(WORD_BITS)) | word.astype(np.uint64)


# -- one step -----------------------------------------------------------------------------------


def rows_in(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Rows of the relation, one at a time."""
    for b in batches:
        for i in range(b.num_rows):
            yield {c: b.column(c)[i].as_py() for c in b.schema.names}


def group_counts(relation: DataFrame, length: int, min_count: int) -> DataFrame:
    """key, n of the groups of ``length`` + 1 words that are frequent."""

    def combined(keys: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        key, n = np.unique(np.concatenate(keys), return_counts=True)
        for a in range(0, len(key), 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(key[a : a + 100_000].view(np.int64)), pa.array(n[a : a + 100_000])], names=["key", "n"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for row in rows_in(batches):
            held.append(group_keys(*extended(row, length)[1:]))
            size += len(held[-1])
            if size >= COMBINED:
                yield from combined(held)
                held, size = [], 0
        if held:
            yield from combined(held)

    return relation.mapInArrow(work, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


class Store:
    """Written tables of one mining run."""

    def __init__(self, spark):
        self.spark, self.scratch = spark, Scratch(spark)

    def write(self, df: DataFrame, label: str) -> DataFrame:
        path = self.scratch.folder(label)
        df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def numbered(self, df: DataFrame, label: str) -> tuple[DataFrame, int]:
        """The rows with numbers ``id`` from 0 on, and how many there are."""
        rows = self.write(df.withColumn("at", F.monotonically_increasing_id()), label)
        part = F.shiftright("at", 33)
        # one row a partition written
        sizes = rows.groupBy(part.alias("part")).agg(F.count("*").alias("size"))
        base = F.coalesce(F.sum("size").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        base = F.broadcast(sizes.select("part", base.alias("base")))
        out = rows.withColumn("part", part).join(base, "part").withColumn("id", F.col("base") + F.col("at").bitwiseAND((1 << 33) - 1))
        return out.drop("part", "base", "at"), rows.count()


Finder = Callable[[np.ndarray, dict], np.ndarray]


def finder(keys: np.ndarray, ids: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Number of each wanted key (``keys`` sorted), -1 where there is none."""
    if not len(keys):
        return np.full(len(wanted), -1, np.int64)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, ids[at], -1)


def semi_join(rows: DataFrame, groups: DataFrame, n_groups: int, sent_groups: int, keys_of: Callable[[dict], np.ndarray], result: Callable[[dict, Finder], dict]) -> DataFrame:
    """Rows of RELATION_SCHEMA from ``result(row, find)``, where find gives the numbers of the groups that
    a row asks for (all among ``keys_of(row)``)."""
    spark = rows.sparkSession

    def table_of(out: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[c] for r in out], pa.int64() if c == "block" else pa.binary()) for c in RELATION], names=RELATION)

    if n_groups <= sent_groups:
        t = groups.select("key", "id").toArrow()
        key, ids = t["key"].to_numpy().view(np.uint64), t["id"].to_numpy()
        order = np.argsort(key)
        shared = spark.sparkContext.broadcast((key[order], ids[order]))

        def by_broadcast(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            keys, ids = shared.value
            for row in rows_in(batches):
                yield table_of([result(row, lambda wanted: finder(keys, ids, wanted))])

        return rows.mapInArrow(by_broadcast, RELATION_SCHEMA)

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_in(batches):
            key = np.unique(keys_of(row))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(key), row["block"])), pa.array(key.view(np.int64))], names=["block", "key"])

    # bounded by the occurrences of a block
    found = rows.mapInArrow(asked, "block long, key long").join(groups.select("key", "id"), "key").groupBy("block")
    found = found.agg(F.sort_array(F.collect_list(F.struct("key", "id"))).alias("groups"))
    both = rows.join(found.select(F.col("block").alias("of"), F.col("groups.key").alias("keys"), F.col("groups.id").alias("ids")), F.col("block") == F.col("of"), "left").drop("of")

    def by_join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_in(batches):
            key = np.array(row["keys"] or [], np.int64).view(np.uint64)
            order = np.argsort(key)
            ids = np.array(row["ids"] or [], np.int64)[order]
            yield table_of([result(row, lambda wanted: finder(key[order], ids, wanted))])

    return both.mapInArrow(by_join, RELATION_SCHEMA)


def first_relation(row: dict, find: Finder) -> dict:
    ids = find(dictionary_keys(row))[unpack(row["codes"])]
    keep = ids >= 0
    return {"block": row["block"], "place1": pack_places(unpack_places(row["place"])[keep]), "id1": pack(ids[keep]), "place": None, "id": None}


def dictionary_keys(row: dict) -> np.ndarray:
    return word_keys(pa.array([row["lang"]]), pa.array(row["words"], pa.string()))


def next_relation(length: int) -> Callable[[dict, Finder], dict]:
    def result(row: dict, find: Finder) -> dict:
        place, phrase, word = extended(row, length)
        ids = find(group_keys(phrase, word))
        keep = ids >= 0
        return {**{c: row[c] for c in ("block", "place1", "id1")}, "place": pack_places(place[keep]), "id": pack(ids[keep])}

    return result


def frequent_phrases(docs: DataFrame, mining: Mining = Mining(), text_col: str = "text", lang_col: str = "lang", sent_groups: int = SENT_GROUPS, store: Store | None = None) -> tuple[DataFrame, DataFrame]:
    """lang, words (array), f of all phrases of 1 to ``max_words`` words with ``min_count`` occurrences; and
    lang, n, the words of each language.  Both read tables of the ``store``."""
    prepare(docs.sparkSession)
    store = store or Store(docs.sparkSession)
    texts = store.write(blocks(docs, text_col, lang_col).withColumn("block", F.monotonically_increasing_id()), "phrase-words")
    counts = store.write(texts.select("lang", F.explode(F.arrays_zip("words", "n")).alias("w")).groupBy("lang", F.col("w.words").alias("word")).agg(F.sum("w.n").alias("n")), "phrase-counts")
    totals = counts.groupBy("lang").agg(F.sum("n").alias("n"))

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.append_column("key", pa.array(word_keys(b.column("lang"), b.column("word")).view(np.int64)))

    words = counts.where(F.col("n") >= mining.min_count).mapInArrow(keyed, "lang string, word string, n long, key long")
    words, size = store.numbered(words, "phrase-1")
    if size >> WORD_BITS:
        raise ValueError(f"{size} frequent words, more than {WORD_BITS} bits number")
    relation = store.write(semi_join(texts, words, size, sent_groups, dictionary_keys, first_relation), "phrase-relation")
    word = words.select(F.col("id").alias("next"), F.col("word").alias("last"))
    level = words.select("id", "lang", F.array("word").alias("words"), F.col("n").alias("f"))
    out = level
    for length in range(1, mining.max_words):
        groups, size = store.numbered(group_counts(relation, length, mining.min_count), f"phrase-{length + 1}")
        if size >> (63 - WORD_BITS):
            raise ValueError(f"{size} frequent phrases, more than {63 - WORD_BITS} bits number")
        named = groups.select("id", F.shiftright("key", WORD_BITS).alias("before"), F.col("key").bitwiseAND((1 << WORD_BITS) - 1).alias("next"), F.col("n").alias("f"))
        longer = level.select(F.col("id").alias("before"), "lang", "words")
        level = store.write(named.join(longer, "before").join(word, "next").select("id", "lang", F.concat("words", F.array("last")).alias("words"), "f"), f"phrase-names-{length + 1}")
        out = out.unionByName(level)
        if length + 1 < mining.max_words:
            keys_of = lambda row, k=length: group_keys(*extended(row, k)[1:])
            relation = store.write(semi_join(relation, groups, size, sent_groups, keys_of, next_relation(length)), "phrase-relation")
    return out.drop("id"), totals


# -- candidates ---------------------------------------------------------------------------------


def spaced(words) -> Column:
    return F.concat_ws(" ", words)


def weakest_cuts(phrases: DataFrame, scale: int) -> DataFrame:
    """lang, phrase, a, l, r, score (of the lowest-scoring cut) of the phrases of two words or more."""
    f = phrases.select("lang", spaced("words").alias("part"), "f")
    cut = phrases.where(F.size("words") > 1).select("lang", "words", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k"))
    cut = cut.select("lang", "words", "a", "k", spaced(F.slice("words", F.lit(1), F.col("k"))).alias("first"), spaced(F.slice("words", F.col("k") + 1, F.size("words") - F.col("k"))).alias("rest"))
    cut = cut.join(f.select("lang", F.col("part").alias("first"), F.col("f").alias("l")), ["lang", "first"])
    cut = cut.join(f.select("lang", F.col("part").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
    # exact: a product of up to 38 digits, and the integral part of the quotient
    cut = cut.withColumn("product", F.lit(scale).cast("decimal(10,0)") * F.col("a").cast("decimal(20,0)")).withColumn("sum", F.col("l").cast("decimal(20,0)") + F.col("r"))
    least = F.min(F.struct(F.expr("product div sum").alias("score"), "k", "l", "r")).alias("cut")
    return cut.groupBy("lang", "words", "a").agg(least).select("lang", "words", spaced("words").alias("phrase"), "a", "cut.l", "cut.r", "cut.score")


def absorbed(phrases: DataFrame) -> DataFrame:
    """lang, phrase, around: occurrences of the most frequent longer phrase around each phrase of two words or more."""
    longer = phrases.where(F.size("words") > 2).select("lang", "words", "f")
    size = F.size("words")
    parts = F.flatten(F.transform(F.sequence(F.lit(2), size - 1), lambda k: F.transform(F.sequence(F.lit(1), size - k + 1), lambda i: spaced(F.slice("words", i, k)))))
    return longer.select("lang", F.explode(parts).alias("phrase"), "f").groupBy("lang", "phrase").agg(F.max("f").alias("around"))


def collocations(docs: DataFrame, mining: Mining = Mining(), text_col: str = "text", lang_col: str = "lang", sent_groups: int = SENT_GROUPS) -> DataFrame:
    """Per language its ``top`` phrases: lang, rank, phrase, a, l, r, n, score."""
    store = Store(docs.sparkSession)
    found, totals = frequent_phrases(docs, mining, text_col, lang_col, sent_groups, store)
    phrases = store.write(found, "phrases")
    rows = weakest_cuts(phrases, mining.scale).join(absorbed(phrases), ["lang", "phrase"], "left")
    rows = rows.where(F.col("around").isNull() | (100 * F.col("around") < mining.absorbed_percent * F.col("a")))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    best = rows.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= mining.top)
    kept = best.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    # ``top`` rows a language, written so that the relations can go
    out = materialize(kept, "phrases-top")
    store.scratch.clear()
    return out
