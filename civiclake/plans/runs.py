"""The run registry: what each run wrote, and what changed since an earlier run.

``<lake>/audit/execucoes`` has one row a table and run: the run's id, layer,
table, state, rows and published version.  Layer totals are sums of these
written counts.  Tables that later runs compare with keep one partition a
run (``execucao=<id>``), so a repeated run replaces its own rows and
compares with the same earlier run as before.
"""

from __future__ import annotations

import os
import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from civiclake.operators.quality import new_occurrences
from civiclake.sinks.published import is_published, part_name, publish, read_published

REGISTRY = StructType([
    StructField("camada", StringType()), StructField("tabela", StringType()), StructField("status", StringType()),
    StructField("linhas", LongType()), StructField("erro", StringType()), StructField("execucao", StringType()),
])


def run_id(as_of: str) -> str:
    """Sortable id of a run from its processing time: its digits, to the second."""
    return (re.sub(r"\D", "", as_of) + "0" * 14)[:14]


def registry_path(lake: str) -> str:
    return os.path.join(lake, "audit", "execucoes")


def record_run(spark: SparkSession, lake: str, run: str, status: Sequence[tuple]) -> None:
    """Replace the registry's rows of one run (``status`` as the layer runner returns it)."""
    rows = spark.createDataFrame([(*r, run) for r in status], REGISTRY)
    publish(rows, registry_path(lake), ["execucao"], [part_name("execucao", run)], run)


def registry(spark: SparkSession, lake: str) -> DataFrame:
    return read_published(spark, registry_path(lake), REGISTRY)


def written_totals(spark: SparkSession, lake: str, run: str) -> DataFrame:
    """``camada, total_linhas`` of one run, from the counts observed while writing."""
    return registry(spark, lake).where(F.col("execucao") == run).groupBy("camada").agg(F.sum("linhas").alias("total_linhas"))


def store_run(df: DataFrame, path: str, run: str) -> DataFrame:
    """Keep ``df`` as the rows of one run of the table at ``path``; returns the rows of all runs."""
    rows = df.withColumn("execucao", F.lit(run))
    publish(rows, path, ["execucao"], [part_name("execucao", run)], run)
    return stored_runs(df.sparkSession, path, rows.schema)


def stored_runs(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return read_published(spark, path, schema) if is_published(spark, path) else spark.createDataFrame([], schema)


def alerts(runs: DataFrame, run: str, keys: Sequence[str], run_col: str = "execucao") -> DataFrame:
    """Rows of ``run`` that the last stored run before it did not have (all of them if there is none).

    Rows are told apart by ``keys`` and counted, so a second equal row is new
    too; ``novas`` says how many.  The run before is found by the partition
    column, and only these two runs' rows are read.
    """
    earlier = runs.where(F.col(run_col) < run).agg(F.max(run_col)).first()[0]
    current, previous = runs.where(F.col(run_col) == run), runs.where(F.col(run_col) == F.lit(earlier))
    return new_occurrences(current, previous, keys)
