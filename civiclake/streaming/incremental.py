"""Incremental bronze ingest with Structured Streaming.

A file stream picks up landed page files and explodes them into records
exactly as the batch path does.  Nothing is dropped by lateness: each
micro-batch writes its accepted records, and its rejects with their text
and reason, to folders named after the batch (``lote=<batch_id>``), so a
batch replayed after a failure rewrites the same files.

The bronze table then takes the batch by key: only the partitions that hold
one of its keys, or get one, are read, merged by the rule the batch path
uses (the latest record of each natural key) and published together; every
other partition keeps its files.  A back-filled page adds its records, a
corrected page replaces them (and moves an event to its new year), a page
landed twice changes nothing, and the result equals a full batch build of
the same files.  A publication is whole or not there (``sinks.published``),
so a crash leaves the table as it was and the replayed batch merges again.

The accepted records of the batches are a log beside the table, from which
``refresh`` can rebuild it; ``compact`` merges the log's older batches.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from civiclake.functions.clean import among
from civiclake.schemas import BRONZE, BronzeSpec
from civiclake.sinks.published import Folder, Version, is_published, latest_version, part_name, publish, read_published, recover
from civiclake.sources.envelope import RAW_PAGE, latest, pages_from, records, split_accepted, with_year

#: Batches of the log that are left as they are; more are merged into one.
KEEP_BATCHES = 20


def stream_records(spark: SparkSession, landing: str, spec: BronzeSpec, max_files: int | None = None) -> DataFrame:
    """Streaming frame of all records of one endpoint, with their text."""
    reader = (
        spark.readStream.schema(RAW_PAGE)
        .option("multiLine", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_corrupt_record")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.json")
    )
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    raw = reader.json(os.path.join(landing, spec.name))
    return records(pages_from(raw, spec.parent), spec.schema, spec.parent, raw=True)


def batch_folders(target: str) -> tuple[str, str]:
    """Folders of the accepted and rejected records of the batches, beside the table."""
    return f"{target}_lotes", f"{target}_rejeitados"


def refresh(spark: SparkSession, spec: BronzeSpec, target: str) -> int:
    """Rebuild the bronze table from the accepted records of all batches; returns its rows."""
    accepted = read_published(spark, batch_folders(target)[0]).drop("lote")
    return publish(with_year(latest(accepted, spec), spec), target, spec.partition_by).total


def upsert(spark: SparkSession, spec: BronzeSpec, target: str, new: DataFrame, run: str = "") -> Version:
    """Merge accepted records into the bronze table by key; only the partitions concerned are read and replaced.

    A bucket follows from the key.  An event's year does not, so the years
    that hold the batch's keys are looked up first: a semi-join that reads
    the key column alone.
    """
    from civiclake.plans.layers import bronze_schema

    recover(spark, target)
    new = latest(new, spec)
    old = read_published(spark, target, bronze_schema(spec)) if is_published(spark, target) else None
    if not spec.partition_by:
        both = new if old is None else old.select(new.columns).unionByName(new)
        return publish(latest(both, spec), target, run=run)
    column = spec.partition_by[0]
    placed = with_year(new, spec)
    concerned = placed.select(column)
    if old is not None and not spec.stable_partition:
        keys = list(spec.natural_key)
        concerned = concerned.union(old.select(column, *keys).join(new.select(*keys), keys, "left_semi").select(column))
    parts = [r[0] for r in concerned.distinct().collect()]  # at most one row a partition
    if old is not None:
        new = old.where(among(column, parts)).select(new.columns).unionByName(new)
    return publish(with_year(latest(new, spec), spec), target, spec.partition_by, [part_name(column, p) for p in parts], run)


def compact(spark: SparkSession, spec: BronzeSpec, target: str, keep: int = KEEP_BATCHES) -> int:
    """Merge all but the last ``keep`` batches of the accepted log into one, by key; returns the batches merged."""
    log = batch_folders(target)[0]
    lots = sorted(int(n.split("=", 1)[1]) for n in Folder(spark, log).visible() if n.startswith("lote="))
    old = lots[: max(0, len(lots) - keep)]
    if len(old) > 1:
        rows = read_published(spark, log).where(F.col("lote").isin(old)).drop("lote")
        merged = latest(rows, spec).withColumn("lote", F.lit(old[-1]))
        publish(merged, log, ["lote"], [part_name("lote", x) for x in old])
    return len(old) if len(old) > 1 else 0


def start_ingest(spark: SparkSession, landing: str, spec: BronzeSpec, target: str, checkpoint: str,
                 available_now: bool = True, max_files: int | None = None) -> StreamingQuery:
    """Start the incremental ingest of one endpoint into the bronze table at ``target``.

    ``checkpoint`` must be on shared storage (e.g. under the cluster's
    ``spark.checkpoint.dir``).  ``available_now`` processes what has landed
    and stops; otherwise the query keeps running.
    """
    accepted_path, rejected_path = batch_folders(target)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            accepted, rejected = split_accepted(batch, spec)
            accepted.write.mode("overwrite").parquet(os.path.join(accepted_path, f"lote={batch_id}"))
            rejected.write.mode("overwrite").parquet(os.path.join(rejected_path, f"lote={batch_id}"))
        finally:
            batch.unpersist()
        spark = batch.sparkSession
        upsert(spark, spec, target, spark.read.parquet(os.path.join(accepted_path, f"lote={batch_id}")), f"lote-{batch_id}")
        compact(spark, spec, target)

    w = stream_records(spark, landing, spec, max_files).writeStream.foreachBatch(write_batch)
    w = w.option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def ingest_new(spark: SparkSession, landing: str, lake: str) -> list[tuple]:
    """Bronze of a lake, incrementally: every endpoint with a landing folder takes what is new.
    Returns status rows like the batch ingest (rows: of the table after the run)."""
    rows = []
    for name, spec in BRONZE.items():
        target = os.path.join(lake, "bronze", name)
        try:
            start_ingest(spark, landing, spec, target, os.path.join(lake, "_checkpoints", name)).awaitTermination()
            rows.append(("bronze", name, "ok", latest_version(spark, target).total, None))
        except Exception as e:  # noqa: BLE001 - reported in the status rows
            state = "vazio" if "PATH_NOT_FOUND" in str(e) else "falha"
            rows.append(("bronze", name, state, None, f"{type(e).__name__}: {e}"))
    return rows
