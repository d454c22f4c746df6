"""Deterministic surrogate keys (K3).

A key is the MD5 of the natural key, so the same value is produced in the
dimension and in the fact without a lookup join, on every run and for any
partitioning.  A single string key hashes the string itself (equal to
``md5(name)`` in any SQL engine); a composite key hashes the JSON text of
the struct of its parts.  A NULL natural key gives a NULL surrogate key.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from civiclake.functions.clean import col_


def surrogate_key(*cols: str | Column) -> Column:
    if not cols:
        raise ValueError("surrogate_key needs at least one column")
    if len(cols) == 1:
        c = col_(cols[0])
        return F.when(c.isNotNull(), F.md5(c.cast("string")))
    parts = [col_(c) for c in cols]
    any_null = F.lit(False)
    for p in parts:
        any_null = any_null | p.isNull()
    return F.when(~any_null, F.md5(F.to_json(F.struct(*parts))))
