"""Quality rules: base counts, and divergence from language references.

A reference is the character-class histogram and the common-word histogram
of all texts of one language.  Common words are those with at least
``COMMON_SHARE`` of a language's words (so there are 1 / COMMON_SHARE at
most), and a language needs ``LANGUAGE_SHARE`` of all words for a reference,
which bounds what tasks receive.  A text is compared with every reference by
Jensen-Shannon distance (base 2, 0 to 1) and judged by its nearest one, so a
wrong or missing language label does not matter.  Texts below the minimum
lengths are not judged by that histogram: short texts vary too much.

Null and empty texts have no words and fail the base rule.  Rows with null
language count for no reference.  The label takes no part in the verdict: a
row of a language without a reference is judged like any other.  Repeated rows are judged alike; an empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civiclake.llm.common import Words, chunks, plain, rolling, prepare, split_words, word_hashes
from civiclake.session import Scratch, materialize

COMMON_SHARE = 1 / 500
LANGUAGE_SHARE = 1 / 200
#: Words a reference must rest on.
REFERENCE_WORDS = 1000
WINDOW = 8
SYMBOLS = b"#*$%&|<>"
CLASSES = ("lower", "upper", "digit", "space", "line", "stop", "mark", "symbol", "wide", "control")


def byte_classes() -> np.ndarray:
    """Class of each UTF-8 byte; continuation bytes have none (the lead byte counts the character)."""
    cls = np.full(256, CLASSES.index("mark"))
    cls[:32] = cls[127] = CLASSES.index("control")
    cls[128:192] = len(CLASSES)
    cls[192:] = CLASSES.index("wide")
    for name, members in (("lower", range(97, 123)), ("upper", range(65, 91)), ("digit", range(48, 58)), ("space", b" \t\v\f\r"), ("line", b"\n"), ("stop", b".,"), ("symbol", b"#*$%&|<>@^~=+/\\_{}[]")):
        cls[list(members)] = CLASSES.index(name)
    return cls


@dataclass(frozen=True)
class Rules:
    """Thresholds; a text is kept unless a base rule or a divergence rule rejects it."""

    min_words: int = 20
    max_repeat_percent: int = 30
    #: Largest distance from the nearest reference, and the least characters or words to judge it.
    max_class_distance: float = 0.33
    min_class_chars: int = 200
    max_word_distance: float = 0.38
    min_word_words: int = 100


@dataclass
class References:
    """Histograms of the languages: classes (languages x classes), words (languages x common words)."""

    languages: list[str]
    classes: np.ndarray
    words: np.ndarray
    index: dict[str, int] = field(default_factory=dict)


def class_histogram(texts: pa.Array) -> np.ndarray:
    """Characters of each class in each text."""
    n = len(CLASSES) + 1
    off = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[off[0] : off[-1]]
    row = np.repeat(np.arange(len(texts)) * n, np.diff(off))
    return np.bincount(row + byte_classes()[data], minlength=n * len(texts)).reshape(-1, n)[:, :-1]


def counts(docs: DataFrame) -> DataFrame:
    """lang, word, n over all texts: words by themselves, classes under '\\x00' + their number, the total under '\\x00'."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches, "text"):
            b = b.filter(pa.compute.is_valid(b.column("lang")))
            if not b.num_rows:
                continue
            texts = plain(b.column("text"))
            lang = b.column("lang").dictionary_encode()
            code, names = lang.indices.to_numpy(), lang.dictionary.to_pylist()
            words = split_words(pc.utf8_lower(texts))
            classes = class_histogram(texts)
            size = max(1, len(words.uniq))
            # (language, word) pairs that occur, by language
            pairs, n = np.unique(code[words.rows].astype(np.int64) * size + words.codes, return_counts=True)
            ends = np.searchsorted(pairs, np.arange(len(names) + 1) * size)
            for i, name in enumerate(names):
                mine = slice(ends[i], ends[i + 1])
                word = pa.concat_arrays([words.uniq.take(pa.array(pairs[mine] - i * size)), pa.array(["\x00", *(f"\x00{k}" for k in range(len(CLASSES)))])])
                total = np.concatenate((n[mine], [n[mine].sum()], classes[code == i].sum(axis=0)))
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(total), pa.string()), word, pa.array(total.astype(np.int64))], names=["lang", "word", "n"])

    got = docs.mapInArrow(work, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    # a word seen once is not common in a language of REFERENCE_WORDS words
    return got.where((F.col("n") > 1) | F.col("word").startswith("\x00"))


def fit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> References:
    """References of the languages of a corpus, from all its texts."""
    prepare(docs.sparkSession)
    scratch = Scratch(docs.sparkSession)
    found = materialize(counts(docs.select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))), "quality-counts", scratch)
    totals = found.where(F.col("word") == "\x00").select("lang", F.col("n").alias("total"))
    least = F.greatest(F.lit(REFERENCE_WORDS), F.lit(LANGUAGE_SHARE) * (totals.agg(F.sum("total")).collect()[0][0] or 0))
    totals = totals.where(F.col("total") >= least)
    common = found.join(F.broadcast(totals), "lang").where((F.col("n") >= COMMON_SHARE * F.col("total")) | F.col("word").startswith("\x00"))
    got = common.collect()  # at most (1 / COMMON_SHARE + classes + 1) / LANGUAGE_SHARE rows
    scratch.clear()
    languages = sorted({r.lang for r in got})
    index: dict[str, int] = {}
    for r in sorted(got, key=lambda r: (r.lang, r.word)):
        if not r.word.startswith("\x00"):
            index.setdefault(r.word, len(index))
    classes = np.zeros((len(languages), len(CLASSES)))
    words = np.zeros((len(languages), len(index) + 1))
    for r in got:
        row = languages.index(r.lang)
        if not r.word.startswith("\x00"):
            words[row, index[r.word]] = r.n
        elif r.word == "\x00":
            words[row, -1] += r.n
        else:
            classes[row, int(r.word[1:])] = r.n
    words[:, -1] -= words[:, :-1].sum(axis=1)  # the rest of the language's words
    norm = lambda m: m / np.maximum(m.sum(axis=1, keepdims=True), 1)
    return References(languages, norm(classes), norm(words), index)


def jensen_shannon(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Distance of each row of p from the distribution q (base 2)."""
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        kl = np.where(p > 0, p * np.log2(p / m), 0).sum(axis=1) + np.where(q > 0, q * np.log2(q / m), 0).sum(axis=1)
    return np.sqrt(np.clip(kl / 2, 0, 1))


def repeated_words(words: Words, window: int = WINDOW) -> np.ndarray:
    """Per text: words in windows that its text has twice or more (each word once)."""
    n_rows = len(words.offsets) - 1
    if len(words.codes) < window:
        return np.zeros(n_rows, np.int64)
    rows = words.rows
    h = rolling(word_hashes(words.uniq)[words.codes], window, 0x9FB21C651E98DF25)
    own = np.flatnonzero(rows[: len(h)] == rows[window - 1 :])
    order = own[np.lexsort((h[own], rows[own]))]
    a, b = order[:-1], order[1:]
    same = (h[a] == h[b]) & (rows[a] == rows[b])
    likely = np.unique(np.concatenate((a[same], b[same])))
    if not len(likely):
        return np.zeros(n_rows, np.int64)
    # equal hashes are candidates; their words decide
    exact = np.column_stack([rows[likely], *(words.codes[likely + k] for k in range(window))])
    _, which, times = np.unique(exact, axis=0, return_inverse=True, return_counts=True)
    start = likely[times[which.ravel()] > 1]
    covered = np.zeros(len(words.codes) + 1, np.int64)
    np.add.at(covered, start, 1)
    np.add.at(covered, start + window, -1)
    return np.bincount(rows[np.cumsum(covered)[:-1] > 0], minlength=n_rows)


def line_repeats(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    return len(lines) - len(set(lines))


VERDICT = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, class_distance double, word_distance double, nearest string, base_failed boolean, kept boolean"


def judge(docs: DataFrame, refs: References, rules: Rules = Rules(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``id_col``, counts, distances from the nearest reference (null if not judged), its language,
    base_failed and kept."""
    out = _judged(docs, refs, rules, (id_col,), text_col)
    return out.select(F.col("__keep_0").alias(id_col), *(x.split()[0] for x in VERDICT.split(", ")))


def good_rows(docs: DataFrame, refs: References, rules: Rules = Rules(), text_col: str = "text") -> DataFrame:
    """The rows that are kept, with their columns as they were."""
    out = _judged(docs, refs, rules, tuple(docs.columns), text_col).where("kept")
    return out.select(*[F.col(f"__keep_{k}").alias(c) for k, c in enumerate(docs.columns)])


def _judged(docs: DataFrame, refs: References, rules: Rules, keep: tuple[str, ...], text_col: str) -> DataFrame:
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(refs)
    names = [f"__keep_{k}" for k in range(len(keep))]
    rows = docs.select(F.col(text_col).alias("__text"), *[F.col(c).alias(n) for c, n in zip(keep, names)])
    schema = ", ".join([*(f"{n} {docs.schema[c].dataType.simpleString()}" for c, n in zip(keep, names)), VERDICT])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        refs = shared.value
        continuation, white = bytes(range(128, 192)), b" \t\n\v\f\r"
        for b in chunks(batches, "__text"):
            texts = plain(b.column("__text"))
            data = texts.cast(pa.binary()).to_pylist()
            words = split_words(texts)
            n_words = np.diff(words.offsets)
            word_chars = np.array([len(t.translate(None, continuation + white)) for t in data], np.int64)
            symbols = np.array([len(t) - len(t.translate(None, SYMBOLS)) for t in data], np.int64)
            repeat = repeated_words(words)
            failed = (n_words < rules.min_words) | (100 * repeat > rules.max_repeat_percent * n_words)
            class_d, word_d, nearest = distances(refs, rules, texts, n_words)
            far = (np.nan_to_num(class_d, nan=0) > rules.max_class_distance) | (np.nan_to_num(word_d, nan=0) > rules.max_word_distance)
            as_float = lambda x: pa.array(x, pa.float64(), mask=np.isnan(x))
            cols = [b.column(x) for x in names]
            cols += [pa.array(x.astype(np.int64)) for x in (n_words, word_chars, symbols, np.array([line_repeats(t) for t in data], np.int64), repeat)]
            cols += [as_float(class_d), as_float(word_d), pa.array(nearest, pa.string()), pa.array(failed), pa.array(~failed & ~far)]
            yield pa.RecordBatch.from_arrays(cols, names=[*names, *(x.split()[0] for x in VERDICT.split(", "))])

    return rows.mapInArrow(work, schema)


def distances(refs: References, rules: Rules, texts: pa.Array, n_words: np.ndarray) -> tuple[np.ndarray, np.ndarray, list]:
    """Class and word distance of each text from its nearest reference (NaN: too short, or no references)."""
    n = len(texts)
    if not refs.languages:
        return np.full(n, np.nan), np.full(n, np.nan), [None] * n
    classes = class_histogram(texts)
    lower = split_words(pc.utf8_lower(texts))
    at = np.fromiter((refs.index.get(w, len(refs.index)) for w in lower.uniq.to_pylist()), np.int64, len(lower.uniq))
    width = len(refs.index) + 1
    hist = np.bincount(lower.rows * width + at[lower.codes], minlength=n * width).reshape(n, width)
    share = lambda m: m / np.maximum(m.sum(axis=1, keepdims=True), 1)
    by_class = np.stack([jensen_shannon(share(classes), q) for q in refs.classes])
    by_word = []
    for q in refs.words:
        # words that are common only elsewhere count as other words of this language
        mine = np.flatnonzero(q[:-1] > 0)
        p = np.column_stack((hist[:, mine], hist.sum(axis=1) - hist[:, mine].sum(axis=1)))
        by_word.append(jensen_shannon(share(p), np.append(q[mine], q[-1])))
    by_word = np.stack(by_word)
    best = np.argmin(by_class + by_word, axis=0)
    class_d, word_d = by_class[best, np.arange(n)], by_word[best, np.arange(n)]
    class_d = np.where(classes.sum(axis=1) >= rules.min_class_chars, class_d, np.nan)
    word_d = np.where(n_words >= rules.min_word_words, word_d, np.nan)
    return class_d, word_d, [refs.languages[i] if m else None for i, m in zip(best.tolist(), (n_words > 0).tolist())]
