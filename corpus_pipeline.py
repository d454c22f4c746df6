"""The corpus pipeline: five stages over documents, each on what its predecessor kept.

Quality rules drop what they reject; of each group of near duplicates one
document stays; documents that benchmark passages contaminate go; secrets
are masked in the texts; the last stage encodes and decodes the texts and
returns their digests.  Rows that no stage rejects keep all their columns,
whatever their names (``n_chars`` follows a masked text).  SQL can express none but the benchmark
stage, so the pipeline has no oracle; tests hold it against brute force.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civiclake.llm import bpe, decontam, jaccard, quality, secrets
from civiclake.llm.common import table, text_key
from civiclake.llm.queries import WORD_BPE, tokenizer_file
from civiclake.session import Scratch, materialize

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules; references are taken from the documents given."""
    return quality.good_rows(docs, quality.fit(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    found = materialize(jaccard.near_duplicates(docs), "pipeline-groups")
    return jaccard.one_of_each(docs, found)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark contamination."""
    found = decontam.contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    bad = found.where(decontam.is_contaminated(F.col("n_hit"), F.col("n_words"))).select(F.col("doc_id").alias("__id"), F.col("doc_key").alias("__key")).distinct()
    # written, so Catalyst knows its size and need not shuffle the texts for a few rows
    bad = materialize(bad, "pipeline-contaminated")
    # the rows' own columns are renamed meanwhile, whatever their names
    names = [f"__keep_{k}" for k in range(len(docs.columns))]
    doc_id, text = (names[docs.columns.index(c)] for c in ("doc_id", "text"))
    met = (text_key(text) == F.col("__key")) & F.col(doc_id).eqNullSafe(F.col("__id"))
    return docs.toDF(*names).join(bad, met, "left_anti").select(*names).toDF(*docs.columns)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets masked."""
    masked = secrets.redact(docs, secrets.train(docs))
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else masked


def encode_decode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of the ids of each remaining text and of the text decoded from them."""
    return bpe.digests(docs, tokenizer_file(WORD_BPE))


STAGES: list[tuple[str, Stage]] = [
    ("quality", keep_good),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", mask_secrets),
    ("bpe", encode_decode),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages from the documents table on; every stage's output is written as Parquet and read again,
    and removed once the next stage's is written."""
    docs, before = table(spark, sf_dir, "documents"), Scratch(spark)
    for name, stage in STAGES:
        own = Scratch(spark)
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}", own)
        before.clear()
        before = own
    return docs
