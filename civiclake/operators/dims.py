"""Dimension extraction (K4): select -> normalise -> distinct -> key.

Normalising *before* the distinct means " pt" and "PT" are one member.
The key is deterministic (K3), so facts carry the same key without a
lookup join.  ``distinct`` is a partial+final aggregation, so a hot value
is combined map-side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civiclake.functions.clean import clean_text
from civiclake.functions.keys import surrogate_key


def extract_dim(df: DataFrame, source: str | Column, name: str, key: str, normalise=clean_text) -> DataFrame:
    """Distinct non-NULL normalised values of ``source`` as (key, name)."""
    v = normalise(F.col(source) if isinstance(source, str) else source)
    return df.select(v.alias(name)).where(F.col(name).isNotNull()).distinct().select(surrogate_key(name).alias(key), name)
