"""Sinks and table maintenance.

Every write runs its plan once: the row count is an ``Observation`` filled
during the write (W5), not a second ``count()`` job.  Partitioned writes
use a ``rebalance`` hint on the partition columns, so AQE splits a hot
(year, month) into several files/tasks instead of one huge task.  An
overwrite replaces the whole table; ``replace="partitions"`` replaces only
the partitions that the frame has, for a reload of some of them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def arranged(df: DataFrame, partition_by: Sequence[str] = (), rebalance: bool = False) -> DataFrame:
    """``df`` dealt for a write: by its partition columns, or with ``rebalance`` into files of even size.

    A table has no order, so the sort of a report is not worth its sampling and
    range shuffle there; Catalyst drops a sort directly below the hint (one
    that a limit needs stays).  Rows are observed above it, so nothing stands between.
    """
    return df.hint("rebalance", *partition_by) if partition_by or rebalance else df


def _writer(df: DataFrame, partition_by: Sequence[str], mode: str, replace: str):
    if replace not in ("table", "partitions"):
        raise ValueError(f"replace must be 'table' or 'partitions', not {replace!r}")
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic" if replace == "partitions" else "static")
    return w


def write_path(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = (), mode: str = "overwrite",
               replace: str = "table", rebalance: bool = False) -> int:
    """Overwrite a path (schema replaced); returns rows written."""
    obs = Observation("rows")
    observed = arranged(df, partition_by, rebalance).observe(obs, F.count(F.lit(1)).alias("rows"))
    _writer(observed, partition_by, mode, replace).format(fmt).save(path)
    return _observed_rows(obs, df)


def save_table(df: DataFrame, name: str, fmt: str = "parquet", partition_by: Sequence[str] = (), mode: str = "overwrite",
               replace: str = "table", rebalance: bool = False) -> int:
    """Overwrite a catalog table; returns rows written."""
    obs = Observation("rows")
    observed = arranged(df, partition_by, rebalance).observe(obs, F.count(F.lit(1)).alias("rows"))
    _writer(observed, partition_by, mode, replace).format(fmt).saveAsTable(name)
    return _observed_rows(obs, df)


def _observed_rows(obs: Observation, df: DataFrame) -> int:
    """Rows counted during the write.  A frame with no partitions at all (an
    empty source) never runs the metrics node; then it has no rows, which
    ``isEmpty`` confirms cheaply."""
    try:
        return int(obs.get["rows"])
    except Exception:  # noqa: BLE001
        if df.isEmpty():
            return 0
        raise


def register_table(spark: SparkSession, name: str, path: str, fmt: str = "parquet") -> None:
    """Expose files at ``path`` as a catalog table (``CREATE TABLE ... LOCATION``)."""
    if not spark.catalog.tableExists(name):
        spark.catalog.createTable(name, path=path, source=fmt)
        if fmt == "parquet" and _is_partitioned(spark, name):
            spark.sql(f"MSCK REPAIR TABLE {name}")


def _is_partitioned(spark: SparkSession, name: str) -> bool:
    return any(c.isPartition for c in spark.catalog.listColumns(name))


def publish_version(spark: SparkSession, df: DataFrame, name: str, base_path: str, fmt: str = "parquet",
                    partition_by: Sequence[str] = ()) -> tuple[str, int]:
    """Write ``df`` as a new version of table ``name`` and point the table at it.

    For tables rewritten from themselves (an SCD2 merge reads the current
    history and produces the next one): overwriting the path being read
    would fail, so each version goes to its own folder under ``base_path``
    and the catalog entry is switched with ``ALTER TABLE ... SET LOCATION``.
    Earlier versions stay readable until the caller removes them.
    Returns (version path, rows written).
    """
    import uuid

    path = f"{base_path.rstrip('/')}/version={uuid.uuid4().hex}"
    n = write_path(df, path, fmt, partition_by, mode="errorifexists")
    if spark.catalog.tableExists(name):
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{_q(path)}'")
        spark.catalog.refreshTable(name)
    else:
        spark.catalog.createTable(name, path=path, source=fmt)
    if partition_by:
        spark.sql(f"MSCK REPAIR TABLE {name}")
    return path, n


def comment_table(spark: SparkSession, name: str, comment: str) -> None:
    """``COMMENT ON TABLE``."""
    spark.sql(f"COMMENT ON TABLE {name} IS '{_q(comment)}'")


def comment_columns(spark: SparkSession, name: str, df_or_schema) -> None:
    """Column comments from the declared schema's field metadata."""
    schema = getattr(df_or_schema, "schema", df_or_schema)
    cols = {c.name for c in spark.catalog.listColumns(name)}
    for fl in schema.fields:
        text = fl.metadata.get("comment")
        if text and fl.name in cols:
            spark.sql(f"ALTER TABLE {name} ALTER COLUMN `{fl.name}` COMMENT '{_q(text)}'")


def _q(s: str) -> str:
    return s.replace("\\", "\\\\").replace("'", "\\'")
