"""Deduplication.

Keep-latest is an aggregation, not a window: ``max`` over a struct whose
leading fields are the ordering columns and whose trailing fields are the
remaining columns.  That is a total order over whole rows, so the
survivor is the same on every run, and Spark combines it map-side
(partial aggregation) so a hot key never lands whole in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keep_latest(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] = (), descending: bool = True) -> DataFrame:
    """One row per key: the row with the greatest ``order_by`` (ties -> other columns).

    ``descending=False`` keeps the earliest row instead.  With no
    ``order_by`` the survivor is the greatest row by column order, which
    is still deterministic (the reference's ``dropDuplicates`` was not).
    NULLs in ordering columns rank lowest when keeping the latest.
    """
    keys = list(keys)
    order_by = [c for c in order_by if c not in keys]
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    payload = F.struct(*[F.col(c) for c in order_by + rest])
    agg = F.max(payload) if descending else F.min(payload)
    return df.groupBy(*keys).agg(agg.alias("__row")).select(*keys, *[F.col(f"__row.{c}").alias(c) for c in order_by + rest]).select(*df.columns)


def deduplicate(df: DataFrame, keys: Sequence[str], order_by: str | Sequence[str] | None = None) -> DataFrame:
    """Reference-compatible signature: ``deduplicate(df, keys, order_by)``."""
    ob = [] if order_by is None else ([order_by] if isinstance(order_by, str) else list(order_by))
    ob = [c for c in ob if c in df.columns]
    return keep_latest(df, [k for k in keys if k in df.columns], ob)


def drop_exact_duplicates(df: DataFrame, natural_key: Sequence[str]) -> DataFrame:
    """Idempotent load on a natural key (K8): the same record landed twice counts once."""
    return keep_latest(df, natural_key)
