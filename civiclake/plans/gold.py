"""Gold builders over silver tables: the reference's nine Gen-B report
tables, seven Gen-A analytics and the documented extensions.

``tables_a`` and ``tables_b`` give one function a table: nothing runs until
a table is built, so a table's jobs (group statistics among them) belong to
its own status row.  ``gold_a`` and ``gold_b`` build all of them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civiclake.functions.clean import json_field
from civiclake.functions.regions import region_of
from civiclake.operators import alignment, diversity, engagement, events, lifecycle, reports, stats
from civiclake.operators.joins import lookup_join
from civiclake.operators.moments import merged_stats, part_moments, store_moments
from civiclake.sources.tables import of_type

Tables = dict[str, Callable[[], DataFrame]]

#: What tells one outlier from another between runs: its statistics move with every run.
ALERT_KEYS = ("deputado_id", "tipoDespesa", "valor_liquido", "data_documento")
PARTITIONS = {"b_alinhamento_celulas": ("balde",)}



def tables_b(s: dict[str, DataFrame], at: Callable[[str], str] | None = None) -> Tables:
    """Gen-B: diversity, engagement, spend breakdowns, suppliers, votes, months, anomalies.

    ``at`` names the folder of a stored table: the claims' statistics are kept
    there as one state a type and year, from which the outliers' means and
    deviations are merged, and the voting cells per bucket of ballots, from
    which the matrix is read.
    """
    dep, mem, vot, exp, ev = s["dim_deputados"], s["fact_frentes_membros"], s["fact_votacoes"], s["fact_despesas"], s["fact_eventos"]

    def outliers() -> DataFrame:
        groups = ["tipoDespesa"]
        state = store_moments(exp, "valor_liquido", groups, "ano", at("momentos_despesas")) if at else part_moments(exp, "valor_liquido", groups)
        merged = merged_stats(state, groups, sd_col="desvio_padrao")
        anom = stats.zscore_filter(exp, "valor_liquido", groups, money=True, stats=merged)  # label only the outliers
        return lookup_join(anom, dep, "idDeputado", "id", ["nome", "sigla_partido", "sigla_uf"]).select(
            F.col("idDeputado").alias("deputado_id"), "nome", "sigla_partido", "sigla_uf", "tipoDespesa",
            F.col("valor_liquido").cast("double").alias("valor_liquido"), "media", "z_score", "data_documento",
        )

    def matrix() -> DataFrame:
        cells = alignment.alignment_cells(vot, mem, dep)
        if at:  # the stored ones, in this schema
            cells = alignment.stored_cells(vot.sparkSession, at("alinhamento_celulas"), alignment.in_buckets(cells).schema)
        return alignment.matrix_of_cells(cells)

    present = lambda *kept: events.explode_presence(ev, "id", "presenca", kept)
    out: Tables = {
        "diversidade_partidaria_frentes": lambda: diversity.front_diversity(mem, dep, s["dim_frentes"]),
        "engajamento_deputados": lambda: engagement.weighted_engagement(dep, mem, vot),
        "despesas_por_tipo": lambda: reports.spend_by_type(exp),
        "despesas_por_deputado": lambda: reports.spend_by_deputy(exp, dep),
        "despesas_por_uf": lambda: reports.spend_by_state(exp, dep),
        "ranking_fornecedores": lambda: reports.supplier_ranking_by_name(exp, 50),
        "padroes_votacao": lambda: reports.vote_patterns(vot),
        "eventos_por_mes": lambda: reports.monthly_events(ev),
        "anomalias_despesas": outliers,
        # documented extensions
        "atlas_frentes": lambda: events.front_atlas(mem, s["dim_frentes"], dep.withColumn("regiao", region_of("sigla_uf"))),
        "engajamento_mensal": lambda: engagement.engagement_calendar(vot, "deputado_id", "data_votacao"),
        "eventos_semana_tipo": lambda: reports.week_counts(ev, "descricaoTipo", out="tipo"),
        "alinhamento_celulas": lambda: alignment.in_buckets(alignment.alignment_cells(vot, mem, dep)),
        "matriz_alinhamento": matrix,
    }
    if "presenca" in ev.columns:
        out["taxa_presenca_tipo"] = lambda: events.presence_rate(present("descricaoTipo"), "id_evento", "id_deputado", "descricaoTipo")
        out["taxa_presenca"] = lambda: events.presence_rate(present(), "id_evento", "id_deputado")
    if "orgaos" in ev.columns:
        organs = ev.select("data_inicio", F.explode("orgaos").alias("o")).select("data_inicio", F.col("o.sigla").alias("orgao"))
        out["eventos_semana_orgao"] = lambda: reports.week_counts(organs, "orgao", out="orgao")
    return out


def gold_b(s: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {k: build() for k, build in tables_b(s).items()}


def lifecycles(bronze: dict[str, DataFrame]) -> Tables:
    """How long each inquiry committee kept each status, over all landings of ``cpis`` (S11: of that type only)."""
    c = bronze["cpis"].where(of_type("siglaTipo"))
    c = c.select("id", json_field("statusProposicao", "descricaoSituacao", "string").alias("situacao"), "_chegada", "_arquivo", "pagina")
    return {"b_ciclo_cpis": lambda: lifecycle.status_intervals(c.withColumn("dia", F.to_date("_chegada")), "id", ["situacao"], "dia", ["_chegada", "_arquivo", "pagina"])}


def tables_a(s: dict[str, DataFrame], top_n: int = 10) -> Tables:
    """Gen-A: HHI diversity, most active members, alignment, flagged
    anomalies, supplier ranking by key, weekly density, min-max engagement."""
    mem = s["fato_frente_membro"].select(F.col("id_frente").alias("idFrente"), F.col("id_deputado").alias("id"))
    dep = s["dim_deputado"]
    dep = dep.where("is_current") if "is_current" in dep.columns else dep  # reports use the present attributes
    dep = dep.select(F.col("id_deputado").alias("id"), "sigla_partido", "sigla_uf")
    votes = s["fato_voto"]
    exp = lookup_join(s["fato_despesa"], dep, "id_deputado", "id", ["sigla_uf"])
    ev = lookup_join(s["fato_evento"], s["dim_data"], "id_data", "id_data", ["data"])
    return {
        "indice_diversidade_frentes": lambda: diversity.front_diversity_hhi(mem, dep),
        "deputados_mais_frentes": lambda: reports.most_active_members(mem, top_n),
        "correlacao_frentes_votacoes": lambda: alignment.relative_alignment(
            votes, mem, deputy="id_deputado", ballot="idVotacao", option="voto_texto"
        ),
        "anomalias_despesas": lambda: stats.zscore_flag(exp, "valor_liquido", ["id_categoria", "sigla_uf"], money=True),
        "ranking_fornecedores": lambda: reports.supplier_ranking_by_key(s["fato_despesa"], s["dim_fornecedor"], top_n),
        "frequencia_eventos_semana": lambda: reports.weekly_density(ev, ts="data", event_id="id_evento"),
        # as documented: weeks without events are rows too
        "eventos_semana_completa": lambda: reports.weekly_density_spine(ev, ts="data", event_id="id_evento"),
        "score_engajamento": lambda: engagement.vote_engagement_minmax(votes, deputy="id_deputado"),
    }


def gold_a(s: dict[str, DataFrame], top_n: int = 10) -> dict[str, DataFrame]:
    return {k: build() for k, build in tables_a(s, top_n).items()}
