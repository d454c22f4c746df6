"""Status intervals from successive landings (X3): gaps and islands.

What lands is a snapshot a day: an entity with a status, or no row when it
is not there.  Consecutive landings with one status form an interval; it
ends on the first later landing that shows another status or no row, and
stays open when the last landing still shows it.  An entity that comes back
after a gap begins a new interval even with its old status.

Landing days are numbered over all entities (as many rows as there are
days); an entity has one row a day at most, so its window is bounded by the
number of days, not by the rows that landed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from civiclake.operators.dedup import keep_latest


def status_intervals(landed: DataFrame, key: str, status: Sequence[str], day: str, latest: Sequence[str] = ()) -> DataFrame:
    """Per interval: ``key, *status, inicio, fim, dias, aberto``.

    ``latest`` orders an entity's rows within a day (the last one counts).
    ``fim`` is the first landing day after the interval, NULL while it is
    open; ``dias`` runs to ``fim`` or, open, to the last landing.  Rows
    without key or day are left out; a NULL status is a status.
    """
    status = list(status)
    known = landed.where(F.col(key).isNotNull() & F.col(day).isNotNull())
    known = known.select(key, F.col(day).cast("date").alias("__day"), *status, *[c for c in latest if c not in status])
    seen = keep_latest(known, [key, "__day"], latest).select(key, "__day", *status)
    # as many rows as there are landing days
    order = Window.orderBy("__day")
    days = known.select("__day").distinct().select("__day", F.row_number().over(order).alias("__seq"), F.lead("__day").over(order).alias("__next"))
    last = known.select(F.max("__day")).scalar()
    w = Window.partitionBy(key).orderBy("__seq")
    now = F.struct(*status)
    follows = (F.lag("__seq").over(w) == F.col("__seq") - 1) & F.lag(now).over(w).eqNullSafe(now)
    rows = seen.join(days, "__day").withColumn("__new", F.when(F.coalesce(follows, F.lit(False)), 0).otherwise(1))
    rows = rows.withColumn("__island", F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    ends = F.max(F.struct("__seq", "__next"))["__next"]
    out = rows.groupBy(key, "__island", *status).agg(F.min("__day").alias("inicio"), ends.alias("fim"))
    return out.select(
        key, *status, "inicio", "fim", F.datediff(F.coalesce("fim", last), "inicio").cast("bigint").alias("dias"), F.col("fim").isNull().alias("aberto"),
    )
