"""Join helpers.

No broadcast hints on anything whose size grows with the data: Catalyst
broadcasts a side only when its size statistics are under
``spark.sql.autoBroadcastJoinThreshold`` (a checked bound), and AQE
re-plans at runtime with measured sizes and splits skewed partitions of
sort-merge joins.  Small *derived* sides (group statistics) are first
written with :func:`civiclake.session.materialize`, which gives Catalyst
exact file sizes for that decision.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civiclake.session import Scratch, materialize


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    left_on: str | Sequence[str],
    right_on: str | Sequence[str] | None = None,
    columns: Sequence[str] | Mapping[str, str] = (),
    how: str = "left",
) -> DataFrame:
    """Attach ``columns`` of ``right`` to ``left`` by key.

    Projects the right side to its key plus the wanted columns before the
    join (column pruning reaches the scan) and never leaves a duplicate
    key column behind.  ``columns`` may map right names to output names.
    """
    lk = [left_on] if isinstance(left_on, str) else list(left_on)
    rk = lk if right_on is None else ([right_on] if isinstance(right_on, str) else list(right_on))
    if len(lk) != len(rk):
        raise ValueError("left_on and right_on differ in length")
    out = dict(columns) if isinstance(columns, Mapping) else {c: c for c in columns}
    tmp = [f"__k{i}" for i in range(len(rk))]
    r = right.select(*[F.col(k).alias(t) for k, t in zip(rk, tmp)], *[F.col(s).alias(d) for s, d in out.items()])
    cond = [left[lk_] == r[t] for lk_, t in zip(lk, tmp)]
    return left.join(r, cond, how).drop(*tmp)


def dimension_lookup(
    fact: DataFrame,
    dim: DataFrame,
    left_on: str | Sequence[str],
    right_on: str | Sequence[str] | None = None,
    columns: Sequence[str] | Mapping[str, str] = (),
    scratch: Scratch | None = None,
) -> DataFrame:
    """Labels of a dimension that has just been derived, by its key.

    Catalyst takes a ``distinct`` for as large as its input, so it would
    shuffle the fact on a key of a few, skewed values.  The dimension is
    therefore written once: a small one is broadcast by the size of its
    files, a large one is shuffle-joined.  Facts without a member keep NULL.
    ``scratch`` owns the written dimension.
    """
    return lookup_join(fact, materialize(dim, "dimension", scratch), left_on, right_on, columns)
