"""Diversity (Herfindahl / Simpson) of categories inside groups.

``1 - sum_i (n_i / N)^2`` is computed in one aggregation over the
(group, category) counts as ``1 - sum(n_i^2) / sum(n_i)^2``: no
self-join with group totals, so one shuffle for the counts (map-side
combined) and one for the per-group result.  A NULL category is one
bucket in the sum but is not counted in ``qtde_partidos``; a NULL group
is dropped (the reference's self-join on the group key dropped it).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def diversity_index(
    members: DataFrame,
    group: str,
    category: str,
    counted: str | None = None,
    out: str = "indice_diversidade",
) -> DataFrame:
    """Per group: ``indice_diversidade``, ``qtde_partidos``, ``total_membros``.

    ``counted=None`` counts rows (Gen-B ``count(*)``); a column name counts
    its non-NULL values (Gen-A ``count(id_deputado)``).
    """
    n = F.count(F.lit(1)) if counted is None else F.count(counted)
    counts = members.groupBy(group, category).agg(n.alias("__n"))
    nn = F.col("__n").cast("double")
    return (
        counts.where(F.col(group).isNotNull())
        .groupBy(group)
        .agg(
            (F.lit(1.0) - F.try_divide(F.sum(nn * nn), F.pow(F.sum(nn), 2))).alias(out),
            F.count(category).alias("qtde_partidos"),
            F.sum("__n").alias("total_membros"),
        )
    )


def herfindahl_index(counts: DataFrame, group_col: str, part_col: str, count_col: str) -> DataFrame:
    """G1 helper with the reference signature: from (group, part, count)
    rows to ``(group, indice_diversidade)``.  ``part_col`` only names the
    bucket column; the index needs the counts alone."""
    n = F.col(count_col).cast("double")
    return (
        counts.where(F.col(group_col).isNotNull())
        .groupBy(group_col)
        .agg((F.lit(1.0) - F.try_divide(F.sum(n * n), F.pow(F.sum(n), 2))).alias("indice_diversidade"))
    )


def front_diversity(memberships: DataFrame, deputies: DataFrame, fronts: DataFrame) -> DataFrame:
    """Gen-B report (G3): ``idFrente, titulo, indice_diversidade, qtde_partidos, total_membros``.

    memberships(idFrente, id) x deputies(id, sigla_partido) -> per-front
    index -> front title.  Sorted by index (desc), then front id.
    """
    from civiclake.operators.joins import lookup_join

    with_party = lookup_join(memberships.select("idFrente", "id"), deputies, "id", "id", ["sigla_partido"])
    idx = diversity_index(with_party, "idFrente", "sigla_partido")
    return (
        lookup_join(idx, fronts, "idFrente", "id", ["titulo"])
        .select("idFrente", "titulo", "indice_diversidade", "qtde_partidos", "total_membros")
        .orderBy(F.desc("indice_diversidade"), "idFrente")
    )


def front_diversity_hhi(memberships: DataFrame, deputies: DataFrame) -> DataFrame:
    """Gen-A form (G2): ``id_frente, indice_diversidade`` counting non-NULL deputies."""
    from civiclake.operators.joins import lookup_join

    m = memberships.select(F.col("idFrente").alias("id_frente"), F.col("id").alias("id_deputado"))
    with_party = lookup_join(m, deputies, "id_deputado", "id", ["sigla_partido"])
    return diversity_index(with_party, "id_frente", "sigla_partido", counted="id_deputado").select("id_frente", "indice_diversidade")
