"""Line removal and importance resampling against brute force: nulls, empty and long texts, ties, repeated
rows, empty tables, columns whose names clash with the operators' own."""

from __future__ import annotations

import collections
import hashlib
import itertools
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from civiclake.llm import line_dedup, resample
from civiclake.llm.common import mix
from test_text_operators import LOWER, invented, rows_of

SCHEMA = "doc_id long, text string, lang string, n_words int, text_key string, score string, rank int, h1 int, marks string, shard int"
BLANK = " \t\n\x0b\x0c\r"


@pytest.fixture(scope="module")
def texts() -> list[tuple[int | None, str | None]]:
    rng = random.Random(11)
    common = ["Terms apply.", "  SHARE this\t", "share THIS", "\x1cshare this", "é É", "", "   ", "a"]
    rows: list[tuple[int | None, str | None]] = []
    for i in range(60):
        lines = [" ".join(invented(rng, rng.randint(1, 9))) for _ in range(rng.randint(0, 6))] + rng.sample(common, rng.randint(0, len(common)))
        rng.shuffle(lines)
        rows.append((i, "\n".join(lines)))
    rows += [(i, f"only nine {j}\nnine lines of ten" if j < 9 else "more") for i, j in zip(range(100, 110), range(10))]
    rows += [(120 + j, f"{'X' if j % 2 else 'x'} ten\r\nrow {j}\n\n") for j in range(10)]
    rows += [(200, None), (201, ""), (202, "\n"), (203, "\n\n\n"), (204, "one line twice\none line twice\none line twice")]
    rows += [(None, "no id\nTerms apply."), (None, "no id\nTerms apply."), (None, None), (5, rows[5][1]), (5, rows[5][1])]
    rows += [(300, "\n".join(" ".join(invented(rng, 5)) for _ in range(5000)) + "\nTerms apply."), (301, "word " * 30000 + "\nshare this")]
    rows += [(310, "ÀÉ naïve Σας 🙂 é a_b-c 1,000 x\x00y z\x85w v　u")]
    return rows


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, "en", k, "t", "s", k, k, "m", k) for k, (i, t) in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def key(line: str) -> str:
    return line.strip(BLANK).translate(LOWER)


def without_common(texts, min_docs, min_chars=1):
    n = collections.Counter(k for _, t in texts for k in {key(x) for x in (t or "").split("\n")})
    out = []
    for i, t in texts:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not (len(key(x)) >= min_chars and n[key(x)] >= min_docs)]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return collections.Counter(out)


@pytest.mark.parametrize("min_docs, min_chars", [(10, 1), (2, 1), (10, 5), (1, 1), (10, 0)])
def test_common_lines(docs, texts, min_docs, min_chars):
    got = line_dedup.remove_common_lines(docs, min_docs, min_chars)
    assert rows_of(got, "doc_id", "n_lines", "n_dropped", "kept_text") == without_common(texts, min_docs, min_chars)


@pytest.mark.parametrize("shard_keys, hot_keys, limit", [(3, 30, 0), (10_000, 20, 0), (7, 100_000, 0), (3, 30, 1 << 30)])
def test_shards_that_stay_and_hot_keys(docs, texts, shard_keys, hot_keys, limit):
    index = line_dedup.build_index(docs, 2, 1, shard_keys=shard_keys, hot_keys=hot_keys)
    hot = index.rows.where("shard = -1").agg({"keys": "sum"}).first()[0] or 0
    assert hot < hot_keys and (hot or hot_keys > 1000)
    got = line_dedup.drop_lines(docs, index, 2, 1, index_bytes=limit)
    assert rows_of(got, "doc_id", "n_lines", "n_dropped", "kept_text") == without_common(texts, 2)
    # the counts are in the index, so a higher threshold needs no new one
    got = line_dedup.drop_lines(docs, index, 10, 1, index_bytes=limit)
    assert rows_of(got, "doc_id", "n_dropped", "kept_text") == collections.Counter({(i, d, t): n for (i, _, d, t), n in without_common(texts, 10).items()})


def test_index_of_other_documents(spark, docs, texts):
    """Lines that the index never saw meet foreign fingerprints and stay."""
    fresh = [(i, f"never seen {i}\nTerms apply.\nnot either {i * i}") for i in range(500)]
    got = line_dedup.drop_lines(spark.createDataFrame(fresh, "doc_id long, text string"), line_dedup.build_index(docs))
    assert rows_of(got, "doc_id", "n_lines", "n_dropped", "kept_text") == collections.Counter((i, 3, 1, f"never seen {i}\nnot either {i * i}") for i, _ in fresh)


def test_perfect_hash():
    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 63, 64, 65, 1000, 50_000):
        keys = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
        found = line_dedup.PerfectHash.build(keys)
        assert sorted(found.slots(keys).tolist()) == list(range(len(keys)))
        assert found.slots(mix(keys + np.uint64(1))).max(initial=-1) < max(1, len(keys))
        assert len(found.bits) * 64 <= 8 * len(keys) + 640


def test_shard_keeps_keys_with_one_slot_hash():
    h1, h2 = np.array([5, 5, 9, 5], np.uint64), np.array([1, 2, 3, 4], np.uint64)
    shard = line_dedup.Shard(line_dedup.Shard.pack(0, h1, h2, np.array([10, 70_000, 30, 40])))
    assert shard.lookup(h1, h2).tolist() == [10, 70_000, 30, 40]
    assert shard.lookup(np.array([5, 9, 7], np.uint64), np.array([3, 4, 3], np.uint64)).tolist() == [0, 0, 0]


def test_empty_tables(docs, empty):
    assert line_dedup.remove_common_lines(empty).count() == 0
    assert line_dedup.drop_lines(docs, line_dedup.build_index(empty)).where("n_dropped > 0").count() == 0
    assert resample.resample(empty, docs).count() == 0
    got = resample.resample(docs, empty).collect()
    assert len(got) == docs.count() and any(r["rank"] for r in got)


# -- resampling ---------------------------------------------------------------------------------


def words13(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def runs(text, orders):
    w = words13(text)
    return [" ".join(w[i : i + k]) for k in range(1, orders + 1) for i in range(len(w) - k + 1)]


def drawn(texts, target, draw):
    """Per row: (id, n_features, weight, score) and the scores and ids in the order of the draw."""
    of = lambda f: zlib.crc32(f.encode()) % draw.buckets
    s = collections.Counter(of(f) for _, t in texts for f in runs(t, draw.orders))
    t = collections.Counter(of(f) for x in target for f in runs(x, draw.orders))
    all_s, all_t = sum(s.values()) + draw.buckets, sum(t.values()) + draw.buckets
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * all_s / ((s[b] + 1) * all_t))) for b in s}
    out, order = [], []
    for i, x in texts:
        f = runs(x, draw.orders)
        weight = sum(gain[of(y)] for y in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"{draw.seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append((i, len(f), weight, score))
        if len(words13(x)) >= draw.min_words:
            order.append((-score, i is None, i or 0))
    return out, sorted(order)[: len(order) * draw.percent // 100]


@pytest.mark.parametrize("draw", [resample.Draw(), resample.Draw(orders=1, buckets=16, percent=60, min_words=0), resample.Draw(orders=3, buckets=70_000, percent=100, min_words=3, seed=9), resample.Draw(percent=0)])
def test_draw(spark, docs, texts, draw):
    rng = random.Random(4)
    target = [None, "", " ".join(invented(rng, 200)), "terms apply " * 5, "a"]
    got = resample.resample(docs, spark.createDataFrame([(x, "c") for x in target], "text string, buckets string"), draw).collect()
    rows, order = drawn(texts, target, draw)
    assert collections.Counter((r["doc_id"], r["n_features"], r["weight"], r["score"]) for r in got) == collections.Counter(rows)
    ranked = sorted((r["rank"], -r["score"], r["doc_id"] is None, r["doc_id"] or 0) for r in got if r["rank"] is not None)
    assert [r[1:] for r in ranked] == order and [r[0] for r in ranked] == list(range(1, len(order) + 1))


def test_rows_repeated_many_times_are_drawn_one_by_one(spark):
    rows = [(1, "same words again and again")] * 600 + [(i, f"row {i} of some other words") for i in range(2, 200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    draw = resample.Draw(percent=50, min_words=1)
    got = resample.resample(docs, docs.limit(5), draw).where("rank is not null")
    assert sorted(r["rank"] for r in got.collect()) == list(range(1, len(rows) // 2 + 1))
    kept = resample.drawn_rows(docs, got)
    assert kept.columns == docs.columns
    assert kept.distinct().count() == got.select("doc_id").distinct().count()


def test_spans_of_a_text():
    for orders, text in itertools.product((1, 2, 3, 4), ("", " ", "one", "Two words", "a  b--c\td", "é ñ_ü 5", "x" * 50_000 + " y")):
        crcs, n = resample.span_crcs(resample.folded(text.encode()), resample.span_pattern(orders), orders)
        assert n == len(words13(text))
        assert collections.Counter(crcs.tolist()) == collections.Counter(zlib.crc32(f.encode()) for f in runs(text, orders))


def test_lines_of_a_slice():
    texts = pa.array(["x\ny", "", "a\n A \nb", "\n"])
    lines = line_dedup.lines_of(texts.slice(1), 1)
    assert lines.offsets.tolist() == [0, 1, 4, 6] and (lines.codes < 0).tolist() == [True, False, False, False, True, True]
