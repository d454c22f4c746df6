"""The pipeline's stages on a small table, each against what it must keep; the registered queries."""

from __future__ import annotations

import os
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from civiclake.llm import queries
from test_text_operators import classes_of, invented, words

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    import random

    rng = random.Random(8)
    folder = str(tmp_path_factory.mktemp("sf"))
    passage = " ".join(invented(rng, 25))
    rows = [(i, " ".join(invented(rng, 120)) + ".", "en", "src", 1) for i in range(60)]
    rows += [(100 + i, rows[i][1] + " more", "en", "src", 1) for i in range(5)] + [(105, rows[5][1], "en", None, None)] + [rows[6]] * 2
    rows += [(200, "too short", "en", "src", 1), (201, None, None, None, None), (202, "a b c d e f g h " * 10, "en", "src", 1)]
    rows += [(300, " ".join(invented(rng, 40)) + " " + passage + " " + " ".join(invented(rng, 40)), "en", "src", 1)]
    rows += [(400, " ".join(invented(rng, 60)) + " token = \"0123456789abcdef0123456789abcdef01234567\" " + " ".join(invented(rng, 60)), "en", "src", 1)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([("i", passage), ("n", None)], "item_id string, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, rows


def test_stages(spark, table):
    folder, rows = table
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    state = {name: None for name, _ in corpus_pipeline.STAGES}
    df = docs
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        df = stage(spark, df, folder)
        if k < len(state) - 1:
            assert df.columns == docs.columns
        state[name] = df = spark.createDataFrame(df.collect(), df.schema)
    ids = {name: sorted(r.doc_id for r in got.collect()) for name, got in state.items()}
    assert ids["quality"] == sorted(r[0] for r in rows if r[0] not in (200, 201, 202))
    good = [(r[0], r[1]) for r in rows if r[0] not in (200, 201, 202)]
    _, group = classes_of(good)
    assert ids["near_duplicates"] == sorted(min(i for (i, _), h in zip(good, group) if h == g) for g in set(group))
    assert ids["decontamination"] == [i for i in ids["near_duplicates"] if i != 300]
    masked = {r.doc_id: r for r in state["secrets"].collect()}
    assert sorted(masked) == ids["decontamination"] == ids["bpe"]
    before = {r[0]: r[1] for r in rows}
    assert "0123456789abcdef" not in masked[400].text and "[secret]" in masked[400].text
    assert all(r.text == before[i] for i, r in masked.items() if i != 400)
    assert all(r.n_chars == len(r.text) for r in masked.values())
    run = corpus_pipeline.run(spark, folder)
    assert sorted(map(tuple, run.collect())) == sorted(map(tuple, state["bpe"].collect()))


def test_rows_keep_columns_of_any_name(spark, table):
    folder, _ = table
    names = ["__key", "__id", "__own", "__nth", "__once", "__mine", "k", "sig", "kept", "group_key", "__keep_0", "__text"]
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    wide = docs.select("*", *[F.concat(F.lit(f"{n} of "), F.coalesce("doc_id", F.lit(-1)).cast("string")).alias(n) for n in names])
    for _, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, wide, folder)
        assert got.columns == wide.columns
        rows = got.collect()
        assert rows and all(r[n] == f"{n} of {-1 if r['doc_id'] is None else r['doc_id']}" for r in rows for n in names)


def test_stages_on_an_empty_table(spark, table, tmp_path):
    folder = str(tmp_path)
    spark.read.parquet(f"{table[0]}/documents.parquet").limit(0).write.parquet(f"{folder}/documents.parquet")
    spark.read.parquet(f"{table[0]}/benchmark.parquet").limit(0).write.parquet(f"{folder}/benchmark.parquet")
    assert corpus_pipeline.run(spark, folder).count() == 0


def test_registered():
    names = set(__spark_entry__.queries())
    for n in range(1, 14):
        assert len([x for x in names if re.match(rf"op{n}_", x)]) == 1
    assert "pipeline" in names and set(queries.SQL) <= set(queries.QUERIES)


@pytest.mark.parametrize("name", [n for n in queries.QUERIES if n not in queries.SQL])
def test_query_runs(spark, name):
    if not os.path.isdir(SF):
        pytest.skip("driver tables not present")
    table = "conversations" if name.startswith("op9_") else "pages" if name.startswith("op10_") else "documents"
    given = spark.read.parquet(f"{SF}/{table}.parquet")
    rows = queries.QUERIES[name](spark, SF).count()
    assert rows == (given.select("conv_id").distinct().count() + 1 if table == "conversations" else given.count())


def test_queries_equal_their_oracles(spark):
    from oracle import compare

    if not queries.SQL or not os.path.isdir(SF):
        pytest.skip("no oracle, or driver tables not present")
    for name, r in compare(spark, SF, sorted(queries.SQL), verbose=False).items():
        assert r.get("match"), (name, r)


def test_words_helper():
    assert words("a\x0bb\x1cc d") == ["a", "b\x1cc", "d"]
