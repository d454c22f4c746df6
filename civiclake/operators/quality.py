"""Data-quality operators.

All are single aggregations or anti-joins: nothing is counted on the
driver per table, and the layer summary is one union of one-row
aggregates rather than a loop of ``count()`` actions.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civiclake.functions.clean import non_negative_or_null


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Q1: keys that occur more than once, with their row count ``qtde``."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("qtde")).where(F.col("qtde") > 1)


def orphans(fact: DataFrame, dim: DataFrame, fk: str, pk: str) -> DataFrame:
    """Foreign-key values of ``fact`` missing from ``dim``, with row counts.

    A left anti join; NULL foreign keys are not orphans (they never match
    and are reported by :func:`null_profile` instead).
    """
    d = dim.select(F.col(pk).alias("__pk")).distinct()
    f = fact.where(F.col(fk).isNotNull())
    return f.join(d, f[fk] == d["__pk"], "left_anti").groupBy(fk).agg(F.count(F.lit(1)).alias("qtde"))


def pending_parents(parents: DataFrame, landed: DataFrame, key: str) -> DataFrame:
    """Parent ids that still have no landed child pages (the work list), distributed."""
    return parents.select(key).distinct().join(landed.select(key).distinct(), key, "left_anti")


def split_non_negative(df: DataFrame, value: str) -> tuple[DataFrame, DataFrame]:
    """Q3: (accepted, rejected) by the NULL-or->=0 rule."""
    ok = non_negative_or_null(value)
    return df.where(ok), df.where(~ok)


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Q4: one row per column: ``coluna, nulos, total`` from a single pass."""
    cols = list(columns or df.columns)
    wide = df.agg(F.count(F.lit(1)).alias("__total"), *[F.count_if(F.col(c).isNull()).alias(f"__n{i}") for i, c in enumerate(cols)])
    pairs = ", ".join(f"'{c}', `__n{i}`" for i, c in enumerate(cols))
    return wide.selectExpr(f"stack({len(cols)}, {pairs}) AS (coluna, nulos)", "__total AS total")


def unparsed_profile(df: DataFrame, parsed: Mapping[str, str]) -> DataFrame:
    """Q4: one row per parsed column: ``coluna, nao_convertidos`` (raw non-NULL, parsed NULL).

    ``parsed`` maps raw column -> parsed column; one pass over the rows.
    """
    items = list(parsed.items())
    wide = df.agg(*[F.count_if(F.col(r).isNotNull() & F.col(p).isNull()).alias(f"__u{i}") for i, (r, p) in enumerate(items)])
    pairs = ", ".join(f"'{p}', `__u{i}`" for i, (_, p) in enumerate(items))
    return wide.selectExpr(f"stack({len(items)}, {pairs}) AS (coluna, nao_convertidos)")


def table_counts(layers: Mapping[str, Mapping[str, DataFrame]]) -> DataFrame:
    """``camada, tabela, linhas`` for every table, as one union of one-row aggregates."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("linhas")).select(F.lit(layer).alias("camada"), F.lit(name).alias("tabela"), "linhas")
        for layer, tables in layers.items()
        for name, df in tables.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def layer_totals(layers: Mapping[str, Mapping[str, DataFrame]]) -> DataFrame:
    """``camada, total_linhas`` (the reference's validation query)."""
    return table_counts(layers).groupBy("camada").agg(F.sum("linhas").alias("total_linhas"))


def new_rows(current: DataFrame, previous: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``current`` whose key was not in ``previous`` (an alert feed)."""
    return current.join(previous.select(*keys).distinct(), list(keys), "left_anti")


def new_occurrences(current: DataFrame, previous: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row a key that ``current`` has more often than ``previous``, with how many are new (``novas``);
    the other columns are those of one of its rows (the greatest).  NULL keys are equal.

    Both sides are counted before they meet, so equal rows are combined map-side.
    """
    keys = list(keys)
    rest = [c for c in current.columns if c not in keys]
    now = current.groupBy(*keys).agg(F.count("*").alias("__n"), F.max(F.struct(*rest)).alias("__row") if rest else F.lit(None).alias("__row"))
    before = previous.groupBy(*[F.col(k).alias(f"__b{i}") for i, k in enumerate(keys)]).agg(F.count("*").alias("__m"))
    met = F.lit(True)
    for i, k in enumerate(keys):
        met = met & F.col(k).eqNullSafe(F.col(f"__b{i}"))
    new = F.col("__n") - F.coalesce(F.col("__m"), F.lit(0))
    out = now.join(before, met, "left").withColumn("novas", new).where("novas > 0")
    return out.select(*[F.col(k) for k in keys], *[F.col(f"__row.{c}").alias(c) for c in rest], "novas")
