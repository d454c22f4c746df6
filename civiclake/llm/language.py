"""Language identification with string kernels.

The kernel of two texts counts the byte n-grams (1 to 3, blended spectrum)
that both contain, normalised by their sizes.  ``landmarks`` texts of each
language span a Nyström feature space; one ridge regression a language
(one versus rest) is fitted on a bounded sample in that space.  A batch of
texts is scored by matrix products: presence x landmarks, then x weights.

A label is learned if ``least_rows`` of its rows or more have a letter,
whatever the other labels hold.  The sample has ``per_language`` distinct
rows of each, by the smallest hashes of id and text, so a row or an id that
recurs cannot fill it; with more than
``max_languages`` labels each has fewer (see ``Config.shares``), so sample
and landmarks stay as large as with that many.  Tasks turn texts into
n-grams and kernel rows, so only those reach the driver.

Null texts and texts without a letter are ``und``; so are all if nothing
can be learned.  Repeated rows are predicted alike; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from civiclake.llm.common import chunks, plain, prepare, ragged, text_key

ORDERS = 3
UNKNOWN = "und"
#: Texts whose presence rows are multiplied together.
BLOCK_ROWS = 64
#: N-grams whose landmark columns are laid out together; only memory depends on it.
BLOCK_CODES = 4096
#: ASCII that is no letter counts as space.
LETTERS = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in range(256))


@dataclass(frozen=True)
class Config:
    per_language: int = 250
    landmarks: int = 32
    least_rows: int = 8
    max_languages: int = 64
    ridge: float = 0.05
    sharpness: float = 4.0

    def shares(self, n_languages: int) -> tuple[int, int]:
        """Sampled texts and landmarks of each label: 4 and 1 at least, whatever their number."""
        part = max(n_languages, self.max_languages)
        return max(min(4, self.per_language), self.per_language * self.max_languages // part), max(1, self.landmarks * self.max_languages // part)


def normal(text: str) -> bytes:
    """Lower-case bytes, a space on both ends, ASCII marks and digits as spaces."""
    return b" " + text.lower().encode("utf-8", "replace").translate(LETTERS) + b" "


def gram_codes(data: bytes) -> np.ndarray:
    """Codes of all 1-, 2- and 3-byte runs; each order has a range of its own."""
    x = np.frombuffer(data, np.uint8).astype(np.int32)
    two = (x[:-1] << 8) | x[1:]
    three = (two[:-1] << 8) | x[2:]
    return np.concatenate((x, two + 256, three + (256 + 65536)))


CODES = 256 + 65536 + (1 << 24)


@dataclass
class Model:
    """Landmark n-grams and regression weights; the lookup tables are built where they are used.

    A landmark is the places of its n-grams among the codes; a matrix (landmarks x codes) is taken too.
    """

    languages: list[str]
    codes: np.ndarray
    landmarks: list[np.ndarray]
    weights: np.ndarray | None = None

    def __post_init__(self) -> None:
        self.landmarks = [np.flatnonzero(x) for x in self.landmarks] if isinstance(self.landmarks, np.ndarray) else self.landmarks
        self._table = None

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k not in ("_holders", "_offsets", "_scale")} | {"_table": None}

    def _build(self) -> None:
        self._table = np.full(CODES, len(self.codes), np.uint16 if len(self.codes) < 65536 else np.int32)
        self._table[self.codes] = np.arange(len(self.codes))
        size = np.array([len(x) for x in self.landmarks])
        place = np.concatenate(self.landmarks).astype(np.int64)
        # the landmarks that hold each n-gram
        self._holders = np.repeat(np.arange(len(size)), size)[np.argsort(place, kind="stable")]
        self._offsets = np.concatenate(([0], np.cumsum(np.bincount(place, minlength=len(self.codes)))))
        self._scale = (1 / np.sqrt(np.maximum(size, 1))).astype(np.float32)

    def _products(self, seen: np.ndarray) -> np.ndarray:
        """Kernel of presence rows (bool, rows x codes) with each landmark."""
        used = np.flatnonzero(seen.any(axis=0))
        out = np.zeros((len(seen), len(self.landmarks)), np.float32)
        for at in range(0, len(used), BLOCK_CODES):
            some = used[at : at + BLOCK_CODES]
            holders, offsets = ragged(self._holders, self._offsets, some)
            held = np.zeros((len(some), len(self.landmarks)), np.float32)
            held[np.repeat(np.arange(len(some)), np.diff(offsets)), holders] = 1
            out += seen[:, some].astype(np.float32) @ held
        return out * self._scale / np.sqrt(np.maximum(seen.sum(axis=1, keepdims=True), 1)).astype(np.float32)

    def kernel(self, texts: list[bytes]) -> np.ndarray:
        """Normalised presence kernel of each text with each landmark."""
        if self._table is None:
            self._build()
        out = np.zeros((len(texts), len(self.landmarks)), np.float32)
        for at in range(0, len(texts), BLOCK_ROWS):
            block = texts[at : at + BLOCK_ROWS]
            seen = np.zeros((len(block), len(self.codes) + 1), bool)
            for i, t in enumerate(block):
                seen[i, self._table[gram_codes(t)]] = True
            out[at : at + len(block)] = self._products(seen[:, :-1])
        return out

    def landmark_kernel(self) -> np.ndarray:
        """Kernel of the landmarks with each other."""
        if self._table is None:
            self._build()
        out = []
        for at in range(0, len(self.landmarks), BLOCK_ROWS):
            block = self.landmarks[at : at + BLOCK_ROWS]
            seen = np.zeros((len(block), len(self.codes)), bool)
            for i, x in enumerate(block):
                seen[i, x] = True
            out.append(self._products(seen))
        return np.concatenate(out)

    def scores(self, texts: list[bytes]) -> np.ndarray:
        return self.kernel(texts) @ self.weights


def fit_weights(kernel: np.ndarray, base: np.ndarray, labels: np.ndarray, n_languages: int, ridge: float) -> np.ndarray:
    """Weights on kernel rows: Nyström map of the landmarks' own kernel, then one ridge regression a language."""
    values, vectors = np.linalg.eigh(base.astype(np.float64))
    good = values > 1e-6 * values.max()
    nystroem = vectors[:, good] / np.sqrt(values[good])
    z = kernel.astype(np.float64) @ nystroem
    targets = np.where(labels[:, None] == np.arange(n_languages), 1.0, -1.0)
    # each language weighs the same, whatever its share of the sample
    weight = 1 / np.bincount(labels, minlength=n_languages)[labels]
    weight *= len(labels) / weight.sum()
    gram = (z * weight[:, None]).T @ z + ridge * len(labels) / max(1, z.shape[1]) * np.eye(z.shape[1])
    return (nystroem @ np.linalg.solve(gram, (z * weight[:, None]).T @ targets)).astype(np.float32)


def has_letter(texts: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.match_substring_regex(texts, r"\p{L}"), False).to_numpy(zero_copy_only=False)


def train(labelled: DataFrame, config: Config = Config(), id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model | None:
    """Fit on rows with a label; null if there are none."""
    spark = labelled.sparkSession
    prepare(spark)
    # a row is known by its id and text: rows that recur, or share an id, cannot fill the sample
    key = F.xxhash64(F.coalesce(F.col(id_col).cast("string"), F.lit("")), text_key(text_col), F.lit("language"))
    rows = labelled.where(F.col(lang_col).isNotNull()).select(key.alias("key"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    lettered = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    usable_rows = rows.groupBy("lang").agg(F.count_if(lettered).alias("usable"))
    languages = sorted(r.lang for r in usable_rows.where(F.col("usable") >= config.least_rows).collect())
    if not languages:
        return None
    per_language, n_landmarks = config.shares(len(languages))
    # the rank keeps at most per_language rows of a language in each task before anything is shuffled
    order = Window.partitionBy("lang").orderBy("key")
    usable = rows.where(F.col("lang").isin(languages) & lettered)
    ranked = usable.select("key", "lang", F.dense_rank().over(order).alias("rank")).where(F.col("rank") <= per_language).distinct()
    picked = {(r.key, r.lang): r["rank"] for r in ranked.collect()}  # see Config.shares
    sample = rows.where(F.col("key").isin(sorted({i for i, _ in picked})) & lettered).dropDuplicates(["key", "lang"])

    marks = {k for k, rank in picked.items() if rank <= n_landmarks}

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches, "text"):
            found = [(i, g, normal(t)) for i, g, t in zip(b.column("key").to_pylist(), b.column("lang").to_pylist(), plain(b.column("text")).to_pylist()) if (i, g) in marks]
            yield pa.RecordBatch.from_arrays([pa.array([f"{g}\x00{i}" for i, g, _ in found], pa.string()), pa.array([np.unique(gram_codes(t)) for _, _, t in found], pa.list_(pa.int32()))], names=["key", "codes"])

    got = sample.select("key", "lang", "text").mapInArrow(grams, "key string, codes array<int>").orderBy("key").toArrow()
    got = got["codes"].combine_chunks()
    each = np.split(got.flatten().to_numpy(), np.cumsum(got.value_lengths().to_numpy())[:-1])
    codes = np.unique(np.concatenate(each))
    model = Model(languages, codes, [np.searchsorted(codes, c).astype(np.int32) for c in each])
    shared = spark.sparkContext.broadcast(model)

    def kernels(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches, "text"):
            mine = [k for k, key in enumerate(zip(b.column("key").to_pylist(), b.column("lang").to_pylist())) if key in picked]
            b = b.take(pa.array(mine, pa.int64()))
            rows_ = shared.value.kernel([normal(t) for t in plain(b.column("text")).to_pylist()])
            yield pa.RecordBatch.from_arrays([b.column("lang"), pa.array(list(rows_), pa.list_(pa.float32()))], names=["lang", "k"])

    got = sample.select("key", "lang", "text").mapInArrow(kernels, "lang string, k array<float>").toArrow()
    kernel = got["k"].combine_chunks().flatten().to_numpy().reshape(-1, len(each))
    labels = np.searchsorted(np.array(languages, object), np.array(got["lang"].to_pylist(), object))
    # a fixed order makes the sums, and so the weights, the same in every run
    order_ = np.lexsort(np.column_stack((kernel[:, : min(8, kernel.shape[1])], labels)).T)
    model.weights = fit_weights(kernel[order_], model.landmark_kernel(), labels[order_], len(languages), config.ridge)
    shared.unpersist()
    return model


def predict(docs: DataFrame, model: Model | None, config: Config = Config(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, lang_pred and score (softmax of the regressions, 0 for und) of every text."""
    spark = docs.sparkSession
    prepare(spark)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    if model is None:
        return rows.select(F.col("doc_id").alias(id_col), F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    shared = spark.sparkContext.broadcast(model)
    sharpness = config.sharpness

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches, "text"):
            model = shared.value
            known = has_letter(b.column("text"))
            s = model.scores([normal(t) for t in plain(b.column("text")).to_pylist()]).astype(np.float64) * sharpness
            p = np.exp(s - s.max(axis=1, keepdims=True))
            best = np.argmax(s, axis=1)
            score = np.where(known, p[np.arange(len(p)), best] / p.sum(axis=1), 0.0)
            lang = [model.languages[i] if k else UNKNOWN for i, k in zip(best.tolist(), known.tolist())]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(lang, pa.string()), pa.array(score)], names=["doc_id", "lang_pred", "score"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(work, f"doc_id {kind}, lang_pred string, score double").withColumnRenamed("doc_id", id_col)


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 4 (null for a null id)."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 4
