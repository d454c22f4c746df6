"""Reading stored tables and files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from civiclake.sources.envelope import conform


def read_path(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A table stored at a path (parquet by default; the format is a parameter)."""
    return spark.read.format(fmt).load(path)


def read_table(spark: SparkSession, layer: str, name: str, prefix: str = "") -> DataFrame:
    """A catalog table named ``<prefix><layer>_<name>``."""
    return spark.read.table(f"{prefix}{layer}_{name}")


def read_bulk(spark: SparkSession, path: str, schema: StructType, fmt: str = "csv", **options: str) -> DataFrame:
    """Annual bulk files (CSV / JSON) conformed to the same declared schema.

    CSV is read as text (every column a string) and conformed, so a new or
    missing column in next year's file does not break the load.
    """
    reader = spark.read.format(fmt).options(**options)
    if fmt == "csv":
        reader = reader.option("header", True)
    return conform(reader.load(path), schema)


def period(c: str | Column, year: int | None = None, start: str | None = None, end: str | None = None) -> Column:
    """Predicate on a date or timestamp column; ``year`` -> all of that year; either end optional.

    ``end`` is a day and counts whole: the upper bound is the next day,
    exclusive, so its hours are in.  Becomes a pushed parquet filter.
    """
    col = F.col(c) if isinstance(c, str) else c
    cond = F.lit(True)
    if year is not None:
        start, end = f"{year}-01-01", f"{year}-12-31"
    if start:
        cond = cond & (col >= F.lit(start).cast("date"))
    if end:
        cond = cond & (col < F.date_add(F.lit(end).cast("date"), 1))
    return cond


def years(c: str | Column, first: int, last: int | None = None) -> Column:
    """S10 on an integer year column (``ano``), which prunes partitions; ``last`` defaults to ``first``."""
    col = F.col(c) if isinstance(c, str) else c
    return col.between(first, first if last is None else last)


def of_type(c: str, code: str = "CPIPC") -> Column:
    """Source-side type predicate (e.g. inquiry committees)."""
    return F.col(c) == F.lit(code)
