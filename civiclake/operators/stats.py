"""Per-group statistics joined back to rows: z-score outliers.

Plan: one partial+final aggregation computes (mean, sample stddev) per
group; that small result is written once to the shared folder and joined
back to the rows.  Catalyst sees its real size, so the row side streams
through a broadcast hash join without being shuffled; a window over the
group key would instead move every row onto a few skewed group keys.
Rows whose group key is NULL find no statistics (an equi-join never
matches NULL), exactly as the reference's self-join behaved.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civiclake.session import materialize

# Fixed value: a row is an outlier when |z| exceeds 3 standard deviations.
Z_THRESHOLD = 3.0


def group_stats(df: DataFrame, value: str, groups: Sequence[str], mean_col: str = "media", sd_col: str = "desvio",
                money: bool = False) -> DataFrame:
    """(mean, sample stddev) per group, written once to the shared folder.

    ``money=True`` takes the mean of the value as decimal(18,2), which is
    exact (HALF_UP at 6 places) and so reproducible across engines.
    """
    v = F.col(value).cast("double")
    mean = F.avg(F.col(value).try_cast("decimal(18,2)")).cast("double") if money else F.avg(v)
    stats = df.groupBy(*groups).agg(mean.alias(mean_col), F.stddev_samp(v).alias(sd_col))
    return materialize(stats, "group_stats")


def zscore_flag(df: DataFrame, value: str, groups: Sequence[str], k: float = Z_THRESHOLD, money: bool = False, stats: DataFrame | None = None) -> DataFrame:
    """Flag form (Gen-A): every row kept, plus ``media, desvio, z_score, anomalia``.

    ``z = (v - media) / desvio``; NULL when the group has one row, its
    standard deviation is 0, or its key is NULL; ``anomalia = |z| > k``
    (NULL when z is NULL).  ``stats`` (groups, ``media, desvio``) may be given,
    as merged from stored moments.
    """
    groups = list(groups)
    stats = group_stats(df, value, groups, money=money) if stats is None else stats
    joined = _left_by_keys(df, stats, groups)
    z = F.try_divide(F.col(value) - F.col("media"), F.col("desvio"))
    return joined.withColumn("z_score", z).withColumn("anomalia", F.abs(F.col("z_score")) > F.lit(k))


def zscore_filter(df: DataFrame, value: str, groups: Sequence[str], k: float = Z_THRESHOLD, sd_col: str = "desvio_padrao",
                  money: bool = False, stats: DataFrame | None = None) -> DataFrame:
    """Filter form (Gen-B): keep rows with ``|z| > k and value > 0``.

    ``z = 0`` when the standard deviation is NULL or 0 (including rows
    with a NULL group key), so such rows never qualify.  ``stats`` (groups,
    ``media``, ``sd_col``) may be given.
    """
    groups = list(groups)
    stats = group_stats(df, value, groups, sd_col=sd_col, money=money) if stats is None else stats
    joined = _left_by_keys(df, stats, groups)
    sd = F.col(sd_col)
    z = F.when(sd.isNotNull() & (sd > 0), (F.col(value) - F.col("media")) / sd).otherwise(F.lit(0.0))
    return joined.withColumn("z_score", z).where((F.abs(F.col("z_score")) > F.lit(k)) & (F.col(value) > 0))


def _left_by_keys(df: DataFrame, stats: DataFrame, groups: list[str]) -> DataFrame:
    """Left join on group keys that keeps one copy of each key column."""
    s = stats.select(*[F.col(g).alias(f"__g_{g}") for g in groups], *[c for c in stats.columns if c not in groups])
    cond = [df[g] == s[f"__g_{g}"] for g in groups]
    return df.join(s, cond, "left").drop(*[f"__g_{g}" for g in groups])
