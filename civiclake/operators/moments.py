"""Mergeable group statistics (G6, G7): count, exact sum, mean and M2 per group and part.

A part (a month of claims, say) is aggregated once and its state kept; the
statistics of a group are merged from the states of its parts, so a new
part reads only its own rows and nothing is scanned again.  Means merge as
weighted means; the sum of squared deviations of the whole is the parts' M2
plus each part's weight times the square of its mean's distance from the
whole mean (pairwise updating), which does not cancel like a difference of
sums of squares.  Money means come from an exact decimal sum.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from civiclake.functions.clean import among
from civiclake.sinks.published import part_name, publish, read_published


def part_moments(df: DataFrame, value: str, groups: Sequence[str], part: Sequence[str] = ()) -> DataFrame:
    """State per (groups, part): ``n, soma`` (decimal), ``media_parte, m2``."""
    money = F.col(value).try_cast("decimal(18,2)")
    v = F.col(value).cast("double")
    return df.groupBy(*groups, *part).agg(
        F.count(v).alias("n"), F.sum(money).alias("soma"), F.avg(v).alias("media_parte"), (F.var_pop(v) * F.count(v)).alias("m2"),
    )


def merged_stats(state: DataFrame, groups: Sequence[str], mean_col: str = "media", sd_col: str = "desvio") -> DataFrame:
    """(mean, sample standard deviation) per group from the states of its parts; a window holds one row a part."""
    known = state.where(F.col("n") > 0)
    w = Window.partitionBy(*groups)
    whole = F.sum(F.col("n") * F.col("media_parte")).over(w) / F.sum("n").over(w)
    spread = F.col("m2") + F.col("n") * F.pow(F.col("media_parte") - F.col("__media"), 2)
    got = known.withColumn("__media", whole).groupBy(*groups).agg(F.sum("n").alias("n"), F.sum("soma").alias("soma"), F.sum(spread).alias("m2"))
    mean = (F.col("soma").cast("decimal(28,2)") / F.col("n").cast("decimal(18,0)")).cast("decimal(28,6)").cast("double")
    return got.select(*groups, mean.alias(mean_col), F.when(F.col("n") > 1, F.sqrt(F.col("m2") / (F.col("n") - 1))).alias(sd_col))


def store_moments(df: DataFrame, value: str, groups: Sequence[str], part: str, path: str, parts: Sequence | None = None, run: str = "") -> DataFrame:
    """Publish the states of some ``parts`` (values of the column ``part``; all of them if None) and return
    the whole table.  Rows of other parts are not read."""
    rows = df if parts is None else df.where(among(part, parts))
    state = part_moments(rows, value, groups, [part])
    publish(state, path, [part], None if parts is None else [part_name(part, p) for p in parts], run)
    return stored_moments(df.sparkSession, path, state.schema)


def stored_moments(spark: SparkSession, path: str, schema=None) -> DataFrame:
    return read_published(spark, path, schema)
