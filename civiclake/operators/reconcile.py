"""Differences of two tables by digests of buckets (S16): anti-entropy.

Keys are hashed into ``buckets``; each side is reduced to one digest a
bucket (rows and two sums of row hashes), combined map-side, so comparing
two equal tables shuffles a few numbers.  Only rows of buckets whose digests
differ are then joined by key; the list of such buckets is sent to every
task (at most ``buckets`` rows).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUCKET, HASH_A, HASH_B = "__bucket", "__hash_a", "__hash_b"


def _marked(df: DataFrame, keys: Sequence[str], values: Sequence[str], buckets: int) -> DataFrame:
    # NULL and its position must show in the hash: xxhash64 skips NULLs
    shown = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-")) for c in (*keys, *values)]
    key = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-")) for c in keys]
    return df.select(*keys, F.pmod(F.xxhash64(*key), F.lit(buckets)).alias(BUCKET), F.xxhash64(*shown).alias(HASH_A), F.xxhash64(F.lit("b"), *shown).alias(HASH_B))


def _sums():
    wide = lambda c: F.sum(F.col(c).cast("decimal(20,0)"))
    return F.count("*").alias("n"), wide(HASH_A).alias("a"), wide(HASH_B).alias("b")


def differing_buckets(left: DataFrame, right: DataFrame, keys: Sequence[str], values: Sequence[str], buckets: int) -> DataFrame:
    """Buckets whose digests differ."""
    sides = [_marked(df, keys, values, buckets).groupBy(BUCKET).agg(*_sums()).select(BUCKET, F.struct("n", "a", "b").alias(name)) for df, name in ((left, "l"), (right, "r"))]
    return sides[0].join(sides[1], BUCKET, "full").where(~F.col("l").eqNullSafe(F.col("r"))).select(BUCKET)


def differences(left: DataFrame, right: DataFrame, keys: Sequence[str], values: Sequence[str], buckets: int = 1024) -> DataFrame:
    """Keys whose rows differ: ``keys, linhas_esquerda, linhas_direita, situacao`` (``so_esquerda``,
    ``so_direita`` or ``diferente``).  Rows of one key are compared as a multiset; NULL keys are keys."""
    keys = list(keys)
    # at most ``buckets`` rows
    open_ = F.broadcast(differing_buckets(left, right, keys, values, buckets))
    sides = []
    for df, name in ((left, "l"), (right, "r")):
        rows = _marked(df, keys, values, buckets).join(open_, BUCKET, "left_semi")
        sides.append(rows.groupBy(*[F.col(k).alias(f"__{name}{i}") for i, k in enumerate(keys)]).agg(*_sums()).select("*", F.struct("n", "a", "b").alias(name)).drop("n", "a", "b"))
    met = F.lit(True)
    for i in range(len(keys)):
        met = met & F.col(f"__l{i}").eqNullSafe(F.col(f"__r{i}"))
    both = sides[0].join(sides[1], met, "full").where(~F.col("l").eqNullSafe(F.col("r")))
    state = F.when(F.col("r").isNull(), "so_esquerda").when(F.col("l").isNull(), "so_direita").otherwise("diferente")
    count = lambda side: F.coalesce(F.col(f"{side}.n"), F.lit(0))
    return both.select(
        *[F.when(F.col("l").isNotNull(), F.col(f"__l{i}")).otherwise(F.col(f"__r{i}")).alias(k) for i, k in enumerate(keys)],
        count("l").alias("linhas_esquerda"), count("r").alias("linhas_direita"), state.alias("situacao"),
    )
