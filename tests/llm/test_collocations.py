"""Phrase mining against brute force: nulls, empty and long texts, ties, repeated rows, empty tables,
columns whose names clash with the operator's own, hot phrases, large counts."""

from __future__ import annotations

import collections
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from civiclake.llm import collocations
from civiclake.llm.collocations import Mining
from test_text_operators import LOWER, invented

SCHEMA = "id long, text string, lang string, words string, n string, place int, block int, key string"


@pytest.fixture(scope="module")
def texts() -> list[tuple[str | None, str | None]]:
    rng = random.Random(12)
    some = [invented(rng, 60) for _ in range(3)]
    fixed = ["as well as", "in spite of that", "é à la ü", "New York City", "a b", "x\x1cy z\x85w"]
    rows: list[tuple[str | None, str | None]] = []
    for i in range(150):
        k = i % 3
        parts = []
        for _ in range(rng.randint(0, 30)):
            parts.append(rng.choice(fixed) if rng.random() < 0.3 else rng.choice(some[k]))
            parts.append(rng.choice([" ", " ", " ", "  ", "\t", ", ", ".\n", " ; ", "\r", "!", "\x0b", "\x0c:"]))
        rows.append((("en", "fr", None)[k], "".join(parts)))
    rows += [("en", None), ("en", ""), ("de", " . , "), (None, None), ("und", "as well as " * 12), ("xx", "one two three " * 40), ("xx", "once")]
    rows += [rows[3]] * 5 + [("en", "is " * 400), ("en", " ".join(rng.choice(some[0]) for _ in range(20_000)))]
    return rows


def mined(texts, m: Mining):
    f, n = collections.Counter(), collections.Counter()
    for lang, text in texts:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, m.max_words + 1):
                f.update((lang, tuple(w[i : i + k])) for i in range(len(w) - k + 1))
    f = {x: c for x, c in f.items() if c >= m.min_count}
    around = collections.defaultdict(int)
    for (lang, x), c in f.items():
        for k in range(2, len(x)):
            for i in range(len(x) - k + 1):
                around[lang, x[i : i + k]] = max(around[lang, x[i : i + k]], c)
    rows = []
    for (lang, x), a in f.items():
        if len(x) > 1 and 100 * around[lang, x] < m.absorbed_percent * a:
            score, _, left, right = min((m.scale * a // (f[lang, x[:k]] + f[lang, x[k:]]), k, f[lang, x[:k]], f[lang, x[k:]]) for k in range(1, len(x)))
            rows.append((lang, -score, -a, " ".join(x).encode(), left, right))
    out, place = [], collections.Counter()
    for lang, score, a, phrase, left, right in sorted(rows):
        place[lang] += 1
        if place[lang] <= m.top:
            out.append((lang, place[lang], phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def found(df):
    assert df.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(r) for r in df.collect())


def table(spark, texts):
    return spark.createDataFrame([(k, t, lang, "w", "n", k, k, "k") for k, (lang, t) in enumerate(texts)], SCHEMA).repartition(5)


@pytest.mark.parametrize("mining", [Mining(), Mining(min_count=5), Mining(min_count=3, max_words=2, top=7), Mining(min_count=4, absorbed_percent=30, top=40), Mining(min_count=2, max_words=3, absorbed_percent=101)])
def test_phrases(spark, texts, mining):
    expected = mined(texts, mining)
    assert expected
    assert found(collocations.collocations(table(spark, texts), mining)) == expected


def test_semi_join_in_spark(spark, texts):
    """More groups than are sent: the same phrases."""
    mining = Mining(min_count=4)
    assert found(collocations.collocations(table(spark, texts), mining, sent_groups=0)) == mined(texts, mining)


def test_a_phrase_in_a_third_of_all_texts(spark):
    rng = random.Random(2)
    texts = [("en", f"{' '.join(invented(rng, 5))} read all of it {' '.join(invented(rng, 3))}") if i % 3 == 0 else ("en", " ".join(invented(rng, 9))) for i in range(900)]
    assert found(collocations.collocations(table(spark, texts))) == mined(texts, Mining())


def test_empty_table(spark, texts):
    assert collocations.collocations(table(spark, texts).limit(0)).count() == 0
    assert collocations.collocations(spark.createDataFrame([(None, None)] * 3, "text string, lang string")).count() == 0


def test_scores_of_counts_beyond_64_bits(spark):
    big = 9_000_000_000_000_000_000
    rows = [("en", ["a"], big), ("en", ["b"], big), ("en", ["a", "b"], big - 1), ("en", ["b", "a"], 7)]
    got = {r["phrase"]: r["score"] for r in collocations.weakest_cuts(spark.createDataFrame(rows, "lang string, words array<string>, f long"), 2_000_000).collect()}
    assert got == {"a b": 2_000_000 * (big - 1) // (2 * big), "b a": 2_000_000 * 7 // (2 * big)}


def test_words_and_places():
    texts = pa.array(["skipped", "A b, c", "", "d", None, " \t.e\n\nF g"])
    uniq, codes, place = collocations.words_and_places(collocations.plain(texts).slice(1))
    words = [uniq[int(c)].as_py() for c in codes]
    assert words == ["a", "b", "c", "d", "e", "f", "g"]
    assert (np.diff(place) == 1).tolist() == [True, False, False, False, False, True]
    assert all(np.diff(place) >= 1)


def test_packing():
    for values in ([], [0], [255, 0], [256], [1 << 16], [1 << 33, 3]):
        assert collocations.unpack(collocations.pack(np.array(values, np.int64))).tolist() == values
