"""Slowly changing dimensions, type 2 (K5, K6, K7).

* :func:`scd2_snapshot` stamps a snapshot as the current version (K5).
* :func:`scd2_from_log` builds the full history from a change log (K6a):
  rows whose tracked values equal the previous row's are dropped, and
  each surviving version is valid until the next one starts.
* :func:`scd2_merge` applies a new snapshot to a history (K6b) with one
  full outer join on the key between the *current* versions and the
  snapshot (one row per key on each side, so no fan-out).
* :func:`as_was_join` attaches to each fact the version valid at the
  fact's date (K7): ``valid_from <= d < valid_to``.  It is computed as an
  as-of carry over the union of versions and facts, so no key's facts are
  paired with all of that key's versions.

The per-key sequential steps use :mod:`civiclake.operators.sequence`, so
a key holding a large share of the rows is split across tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civiclake.operators.sequence import change_points, previous_row


def scd2_snapshot(df: DataFrame, as_of: Column | str) -> DataFrame:
    """K5: every row is the current version from ``as_of``."""
    ts = F.lit(as_of).cast("timestamp") if isinstance(as_of, str) else as_of
    return df.withColumns({"valid_from": ts, "valid_to": F.lit(None).cast("timestamp"), "is_current": F.lit(True)}).withColumn(
        "valid_to", F.col("valid_to").cast(df.select(ts.alias("x")).schema["x"].dataType))


def scd2_from_log(log: DataFrame, key: str, ts: str, tracked: Sequence[str], tiebreak: Sequence[str] = ()) -> DataFrame:
    """History from a change log.

    Output: ``key, *tracked, valid_from, valid_to, is_current``.  ``ts`` +
    ``tiebreak`` must order a key's rows totally.
    """
    order = [ts, *tiebreak]
    changes = change_points(log.select(key, *order, *tracked), key, order, tracked, next_col="__next")
    return changes.select(
        key, *tracked,
        F.col(ts).alias("valid_from"),
        F.col("__next").alias("valid_to"),
        F.col("__next").isNull().alias("is_current"),
    )


def scd2_merge(history: DataFrame, snapshot: DataFrame, key: str, tracked: Sequence[str], as_of: str,
               close_missing: bool = False) -> DataFrame:
    """Apply ``snapshot`` (one row per key) taken at ``as_of`` to ``history``.

    Unchanged keys keep their current version; changed keys get the
    current version closed at ``as_of`` plus a new current version; new
    keys are inserted; keys missing from the snapshot stay current unless
    ``close_missing``.  Past versions pass through untouched.
    """
    tstype = history.schema["valid_from"].dataType
    ts = F.lit(as_of).cast(tstype)
    no_ts = F.lit(None).cast(tstype)
    past = history.where(~F.col("is_current")).select(key, *tracked, "valid_from", "valid_to", "is_current")
    cur = history.where(F.col("is_current")).select(key, *tracked, "valid_from", F.lit(True).alias("__in_cur"))
    snap = snapshot.select(F.col(key).alias("__sk"), *[F.col(c).alias(f"__s_{c}") for c in tracked], F.lit(True).alias("__in_snap"))
    j = cur.join(snap, cur[key] == snap["__sk"], "full")
    # presence markers, not key nullness: a NULL key never matches but is still a row
    in_cur, in_snap = F.col("__in_cur").isNotNull(), F.col("__in_snap").isNotNull()
    same = F.lit(True)
    for c in tracked:
        same = same & F.col(c).eqNullSafe(F.col(f"__s_{c}"))
    changed = in_cur & in_snap & ~same
    closing = changed | (in_cur & ~in_snap & F.lit(close_missing))

    # each joined pair gives the current version (kept or closed) and a new version, or only one of them
    version = lambda cols, vfrom, vto, current: F.struct(
        *[c.alias(n) for n, c in zip([key, *tracked], cols)], vfrom.alias("valid_from"), vto.alias("valid_to"), F.lit(current).alias("is_current")
    )
    mine, new = [F.col(key), *map(F.col, tracked)], [F.col("__sk"), *[F.col(f"__s_{c}") for c in tracked]]
    rows = F.array(
        F.when(in_cur & ~closing, version(mine, F.col("valid_from"), no_ts, True)),
        F.when(closing, version(mine, F.col("valid_from"), ts, False)),
        F.when(changed | ~in_cur, version(new, ts, no_ts, True)),
    )
    present = j.select(F.explode(F.filter(rows, lambda r: r.isNotNull())).alias("v")).select("v.*")
    return past.unionByName(present)


def as_was_join(facts: DataFrame, versions: DataFrame, fact_key: str, fact_date: str, fact_id: Sequence[str],
                version_key: str, attrs: Sequence[str]) -> DataFrame:
    """Facts plus ``attrs`` and ``valid_from`` of the version valid at each fact's date.

    Versions and facts are unioned and ordered by (key, date, versions
    before facts, version end, fact id); each fact carries forward the
    latest version at or before its date.  Because a key's versions are
    contiguous, that is the version with ``valid_from <= d < valid_to``
    (a zero-length version sorts before its successor and is skipped).
    Facts dated before the first version get NULLs (left-join semantics).
    """
    fact_id = list(fact_id)
    tstype = versions.schema["valid_from"].dataType
    far = F.lit("9999-12-31 00:00:00").cast(tstype)
    vstruct = F.struct(*[F.col(a) for a in attrs], F.col("valid_from"))
    ver = versions.where(F.col(version_key).isNotNull()).select(  # a NULL key never matches, as in a join
        F.col(version_key).alias("__k"), F.col("valid_from").alias("__d"), F.lit(0).alias("__kind"),
        F.coalesce(F.col("valid_to"), far).alias("__vto"), vstruct.alias("__v"),
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in facts.schema.fields],
    )
    fac = facts.select(
        F.col(fact_key).alias("__k"), F.col(fact_date).cast(tstype).alias("__d"), F.lit(1).alias("__kind"),
        far.alias("__vto"), F.lit(None).cast(ver.schema["__v"].dataType).alias("__v"), *facts.columns,
    )
    u = ver.unionByName(fac)
    out = previous_row(u, "__k", ["__d", "__kind", "__vto", *fact_id], ["__v"], prefix="__c", ignore_nulls=True)
    return out.where(F.col("__kind") == 1).select(*facts.columns, *[F.col(f"__c__v.{a}").alias(a) for a in attrs],
                                                   F.col("__c__v.valid_from").alias("valid_from"))
