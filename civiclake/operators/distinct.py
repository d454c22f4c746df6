"""Exact distinct counts that merge (A3): bitmaps over dense ids.

``count(DISTINCT x)`` expands or re-shuffles rows per value and cannot be
added up across parts.  Here each (group, block of 32,768 ids) holds one
bitmap, built map-side; bitmaps of parts (months, say) merge by OR, so a
longer period or a coarser group needs no facts.  Meant for groups with many
members: a bitmap takes 4 KB, however few of its ids occur.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from civiclake.session import Scratch, materialize

#: A block's number and the bitmap of the ids in it.
BLOCK, BITS = "bloco", "mapa"


def dense_ids(df: DataFrame, column: str, id_col: str = "id_denso", scratch: Scratch | None = None) -> DataFrame:
    """(column, id): the distinct non-NULL values numbered from 0 without gaps.

    Values are written once, numbered inside each written partition, and
    shifted by the sizes of the partitions before (one row a partition).
    """
    values = df.select(column).where(F.col(column).isNotNull()).distinct().withColumn("__at", F.monotonically_increasing_id())
    values = materialize(values, "dense-ids", scratch).withColumn("__part", F.shiftright("__at", 33))
    sizes = values.groupBy("__part").agg(F.count("*").alias("__n"))
    before = F.coalesce(F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    base = F.broadcast(sizes.select("__part", before.alias("__base")))
    return values.join(base, "__part").select(column, (F.col("__base") + F.col("__at").bitwiseAND((1 << 33) - 1)).alias(id_col))


def bitmap_state(df: DataFrame, groups: Sequence[str], id_col: str) -> DataFrame:
    """State per (groups, block): the bitmap of the ids seen.  NULL ids are not counted, as in ``count(DISTINCT)``."""
    known = df.where(F.col(id_col).isNotNull())
    return known.groupBy(*groups, F.bitmap_bucket_number(id_col).alias(BLOCK)).agg(F.bitmap_construct_agg(F.bitmap_bit_position(id_col)).alias(BITS))


def merge_bitmaps(state: DataFrame, groups: Sequence[str]) -> DataFrame:
    """State of coarser ``groups``, or of several states united."""
    return state.groupBy(*groups, BLOCK).agg(F.bitmap_or_agg(BITS).alias(BITS))


def distinct_counts(state: DataFrame, groups: Sequence[str], out: str) -> DataFrame:
    """Distinct ids per group from a state of these groups or of finer ones."""
    merged = merge_bitmaps(state, groups)
    return merged.groupBy(*groups).agg(F.sum(F.bitmap_count(BITS)).alias(out))
