"""Previous / next row within a key, without putting a hot key in one task.

``Window.partitionBy(key).orderBy(ts)`` sends every row of a key to one
task; if one key holds a third of the rows, one task does a third of the
work.  Here the rows are range-partitioned on ``(key, order...)`` instead
(Spark samples the bounds, so a hot key is cut into many consecutive
slices), the slice id is fixed by writing the partitioned rows once to
the shared folder, and windows run per ``(slice, key)`` — at most one
partition's worth of rows each.  The first row of a slice takes its
neighbour from a small boundary table.  Slices follow the sequence, so only
a slice's first and last key can go on in another slice: the table has two
rows a slice at most, whatever the number of keys, and is broadcast.

Two flavours:

* ``previous_row``: values of the previous row (``lag``), or of the
  previous row with a non-NULL value (``ignore_nulls``, an as-of carry).
* ``ascending=False`` walks the order backwards, which gives ``lead``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from civiclake.session import materialize

PID = "__slice"


def _range_slices(df: DataFrame, sort_exprs: list, slices: int | None) -> DataFrame:
    """Range-partition into consecutive slices of the (key, order) sequence.

    With ``slices=None`` the count is left to Spark: the exchange starts at
    ``spark.sql.shuffle.partitions`` ranges and AQE merges small neighbouring
    ranges up to the advisory partition size.  Merged ranges stay
    contiguous, so the slice ids still follow the sequence; a hot key's
    large ranges are not merged beyond that size.
    """
    return df.repartitionByRange(slices, *sort_exprs) if slices else df.repartitionByRange(*sort_exprs)


def _join_slices(rows: DataFrame, edges: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Join a per-(key, slice) boundary table (two rows a slice at most) to the rows.

    Null-safe on the key, so rows with a NULL key (one group for a window)
    also get their carried values across slices.
    """
    e = edges.select(*[F.col(k).alias(f"__e_{k}") for k in keys], F.col(PID).alias("__e_pid"),
                     *[c for c in edges.columns if c not in keys and c != PID])
    cond = rows[PID] == e["__e_pid"]
    for k in keys:
        cond = cond & rows[k].eqNullSafe(e[f"__e_{k}"])
    return rows.join(F.broadcast(e), cond, how).drop(*[f"__e_{k}" for k in keys], "__e_pid")


def _slice_ends(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, slice) of the first and the last key of each slice: the only groups that can span slices."""
    k = F.struct(*keys)
    ends = rows.groupBy(PID).agg(F.array_distinct(F.array(F.min(k), F.max(k))).alias("__k"))
    return ends.select(PID, F.explode("__k").alias("__k")).select(PID, *[F.col(f"__k.{c}").alias(c) for c in keys])


def previous_row(
    df: DataFrame,
    key: str | Sequence[str],
    order: Sequence[str],
    cols: Sequence[str],
    prefix: str = "prev_",
    ascending: bool = True,
    ignore_nulls: bool = False,
    slices: int | None = None,
) -> DataFrame:
    """Add ``prefix + c`` for each ``c`` in ``cols``: its value in the
    previous row of the same key (by ``order``; ``ascending=False`` gives
    the next row).  ``order`` must be a total order within a key.
    """
    keys = [key] if isinstance(key, str) else list(key)

    def o(c: str):
        return F.col(c).asc_nulls_first() if ascending else F.col(c).desc_nulls_last()

    order_exprs = [o(c) for c in order]
    ranged = _range_slices(df, [F.col(k).asc_nulls_first() for k in keys] + order_exprs, slices).withColumn(PID, F.spark_partition_id())
    rows = materialize(ranged, "sequence")

    # ordering value for max/min-by: the struct of the order columns
    ord_struct = F.struct(*[F.col(c) for c in order])
    pick = F.max_by if ascending else F.min_by
    if ignore_nulls:
        aggs = [pick(F.col(c), F.when(F.col(c).isNotNull(), ord_struct)).alias(f"__last_{c}") for c in cols]
    else:
        aggs = [pick(F.struct(*[F.col(c) for c in cols]), ord_struct).alias("__last")]
    bounds = _join_slices(rows, _slice_ends(rows, keys), keys, "left_semi").groupBy(*keys, PID).agg(*aggs)
    wb = Window.partitionBy(*keys).orderBy(PID)
    if ignore_nulls:
        carry = {f"__carry_{c}": F.last(f"__last_{c}", ignorenulls=True).over(wb.rowsBetween(Window.unboundedPreceding, -1)) for c in cols}
    else:
        carry = {"__carry": F.lag("__last").over(wb)}
    bounds = bounds.withColumns(carry).select(*keys, PID, *carry.keys())

    joined = _join_slices(rows, bounds, keys)
    w = Window.partitionBy(PID, *keys).orderBy(*order_exprs)
    if ignore_nulls:
        frame = w.rowsBetween(Window.unboundedPreceding, -1)
        new = {f"{prefix}{c}": F.coalesce(F.last(c, ignorenulls=True).over(frame), F.col(f"__carry_{c}")) for c in cols}
    else:
        first = F.row_number().over(w) == 1
        new = {f"{prefix}{c}": F.when(first, F.col(f"__carry.{c}")).otherwise(F.lag(c).over(w)) for c in cols}
    return joined.withColumns(new).drop(PID, *carry.keys())


def change_points(
    df: DataFrame,
    key: str | Sequence[str],
    order: Sequence[str],
    value_cols: Sequence[str],
    next_col: str = "next_from",
    slices: int | None = None,
) -> DataFrame:
    """Rows whose ``value_cols`` differ from the previous row of their key
    (and each key's first row), with ``next_col`` = the first ``order``
    column of the key's next such row (NULL for the last).

    One range-partitioned pass instead of "previous row, filter, next
    row": the slice edges are resolved from two boundary tables with two
    rows a slice at most — the previous slice's last value decides whether
    a slice's first row is a change, and the following slices' first
    change gives the successor of a slice's last change.
    """
    keys = [key] if isinstance(key, str) else list(key)
    ts = order[0]
    base = df.select(*keys, *order, *[c for c in value_cols if c not in keys and c not in order]).withColumn(
        "__v", F.to_json(F.struct(*[F.col(c) for c in value_cols]))
    )
    ranged = _range_slices(base, [F.col(k).asc_nulls_first() for k in keys] + [F.col(c).asc_nulls_first() for c in order], slices)
    rows = materialize(ranged.withColumn(PID, F.spark_partition_id()), "changes")

    ord_struct = F.struct(*[F.col(c) for c in order])
    wb = Window.partitionBy(*keys).orderBy(PID)
    ends = _slice_ends(rows, keys)
    edges = _join_slices(rows, ends, keys, "left_semi").groupBy(*keys, PID).agg(F.max_by("__v", ord_struct).alias("__last_v"))
    edges = edges.withColumn("__prev_last", F.lag("__last_v").over(wb)).select(*keys, PID, "__prev_last")

    w = Window.partitionBy(PID, *keys).orderBy(*[F.col(c).asc_nulls_first() for c in order])
    prev_v = F.when(F.row_number().over(w) == 1, F.col("__prev_last")).otherwise(F.lag("__v").over(w))
    flagged = _join_slices(rows, edges, keys).withColumn("__chg", prev_v.isNull() | (prev_v != F.col("__v")))
    flagged = flagged.withColumn(
        "__next_in", F.first(F.when(F.col("__chg"), F.col(ts)), ignorenulls=True).over(w.rowsBetween(1, Window.unboundedFollowing))
    )

    firsts = _join_slices(flagged, ends, keys, "left_semi").groupBy(*keys, PID).agg(F.min_by(F.col(ts), F.when(F.col("__chg"), ord_struct)).alias("__first_chg"))
    firsts = firsts.withColumn(
        "__next_out", F.first("__first_chg", ignorenulls=True).over(wb.rowsBetween(1, Window.unboundedFollowing))
    ).select(*keys, PID, "__next_out")
    out = _join_slices(flagged.where(F.col("__chg")), firsts, keys)
    return out.withColumn(next_col, F.coalesce(F.col("__next_in"), F.col("__next_out"))).drop(
        PID, "__v", "__prev_last", "__chg", "__next_in", "__next_out"
    )
