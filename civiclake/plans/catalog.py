"""Catalog entries of a lake's tables (W7-W9): registration at their folders, with table and column comments.

One ``CREATE TABLE`` a table carries its location, partitions and all
comments.  A column's comment comes from the declared schema where there is
one, else from the glossary, which explains a column name once for all
tables that have it.
"""

from __future__ import annotations

import os

from pyspark.sql import SparkSession
from pyspark.sql.types import StructType

from civiclake.schemas import BRONZE
from civiclake.sinks.published import Folder, is_published, read_published
from civiclake.sinks.writers import _q

TABLES = {
    "bronze": {
        "deputados": "Deputies as landed, the latest record of each", "frentes": "Parliamentary fronts as landed",
        "frentes_membros": "Members of the fronts as landed", "eventos": "Events as landed, partitioned by year",
        "votacoes": "Ballots as landed", "votos_deputados": "Votes of the deputies as landed",
        "despesas_deputados": "Expense claims as landed, equal claims once", "cpis": "Committee proposals, one record a landing day",
    },
    "silver": {
        "dim_deputado": "Deputies with their history (type 2)", "dim_partido": "Parties with their history (type 2)",
        "dim_frente": "Fronts with their history (type 2)", "fato_frente_membro": "Front and member pairs",
        "dim_data": "Event dates", "dim_orgao": "Organs that hold events", "dim_tipo_evento": "Event types",
        "fato_evento": "Events with keys, duration and attendance", "fato_voto": "Votes by deputy and ballot",
        "dim_fornecedor": "Suppliers", "dim_categoria": "Expense categories", "fato_despesa": "Expenses with supplier and category keys",
        "dim_deputados": "Deputies, cleaned, present state", "dim_frentes": "Fronts, cleaned", "dim_partidos": "Distinct parties",
        "fact_votacoes": "Votes joined with their ballots", "fact_despesas": "Expenses with parsed values, none negative",
        "fact_despesas_rejeitadas": "Expenses that the non-negative rule rejects", "fact_eventos": "Events, cleaned, one row each",
        "fact_frentes_membros": "Members of the fronts, cleaned, one row a pair",
    },
    "gold": {
        "a_indice_diversidade_frentes": "Party concentration of each front", "a_deputados_mais_frentes": "Deputies in the most fronts",
        "a_correlacao_frentes_votacoes": "Voting alignment of each front with the house", "a_anomalias_despesas": "All expenses with their z-scores and flags",
        "a_ranking_fornecedores": "Suppliers with the largest totals, by key", "a_frequencia_eventos_semana": "Events a week",
        "a_eventos_semana_completa": "Events a week, weeks without events included", "a_score_engajamento": "Vote engagement from 0 to 1",
        "b_diversidade_partidaria_frentes": "Party diversity of each front", "b_engajamento_deputados": "Weighted engagement of each deputy",
        "b_despesas_por_tipo": "Expenses by type", "b_despesas_por_deputado": "Expenses by deputy", "b_despesas_por_uf": "Expenses by state",
        "b_ranking_fornecedores": "Suppliers with the largest totals, by name", "b_padroes_votacao": "Votes by option",
        "b_eventos_por_mes": "Events by month", "b_anomalias_despesas": "Expenses more than three deviations from their type's mean",
        "b_anomalias_execucoes": "Outliers of every run", "b_alertas_anomalias": "Outliers that the run before did not have",
        "b_atlas_frentes": "Every membership with party, state and region", "b_engajamento_mensal": "Votes of each deputy by calendar month",
        "b_eventos_semana_tipo": "Events by week and type", "b_eventos_semana_orgao": "Events by week and organ",
        "b_alinhamento_celulas": "Votes by front, party, ballot and option, for merging", "b_matriz_alinhamento": "Alignment of each front's parties with the house",
        "b_momentos_despesas": "Statistics of the claims by type and year, for merging", "b_ciclo_cpis": "Status intervals of the inquiry committees",
        "b_taxa_presenca": "Share of events attended by each deputy", "b_taxa_presenca_tipo": "Share of events attended, by event type",
    },
}

GLOSSARY = {
    "id": "identifier", "id_deputado": "deputy id", "deputado_id": "deputy id", "idDeputado": "deputy id", "id_frente": "front id", "idFrente": "front id",
    "idVotacao": "ballot id", "id_evento": "event id", "id_orgao": "organ id as landed", "id_orgao_dim": "organ key", "id_data": "date key",
    "id_tipo_evento": "event type key", "id_partido": "party key", "id_fornecedor": "supplier key", "id_categoria": "expense category key",
    "nome": "name", "nome_deputado": "parliamentary name", "nome_fornecedor": "supplier name", "nomeFornecedor": "supplier name", "titulo": "title",
    "titulo_frente": "front title", "sigla_partido": "party code", "sigla_uf": "state code", "regiao": "region of the state", "idLegislatura": "legislature",
    "id_legislatura": "legislature", "data": "date", "data_inicio": "start", "data_fim": "end", "data_documento": "document date", "data_criacao": "creation date",
    "data_votacao": "time of the ballot", "data_referencia": "reference date", "ano": "year", "mes": "month", "semana": "ISO week", "ano_mes": "year and month",
    "tipoDespesa": "expense type", "tipoVoto": "vote option", "voto_texto": "vote option", "descricaoTipo": "event type", "descricao_tipo": "event type", "tipo": "event type",
    "situacao": "status", "inicio": "first landing day of the status", "fim": "first landing day after the status; empty while it lasts", "dias": "days of the status",
    "aberto": "whether the status lasts", "valor_liquido": "net value", "valor_documento": "document value", "total_recebido": "sum received", "categoria": "expense category",
    "media": "mean of the group", "desvio": "standard deviation of the group", "z_score": "deviations from the mean", "anomalia": "whether the value is an outlier",
    "novas": "occurrences that the run before did not have", "execucao": "run id", "n": "values", "soma": "sum of the values", "media_parte": "mean of the part",
    "m2": "sum of squared deviations", "qtde": "count", "qtde_frentes": "distinct fronts", "qtde_votacoes": "votes", "qtde_votos": "votes", "qtde_deputados": "distinct deputies",
    "qtde_eventos": "events", "qtde_transacoes": "claims", "qtde_deputados_atendidos": "distinct deputies served", "qtde_atividades": "activities in the month",
    "qtde_anterior": "activities in the calendar month before", "variacao": "change from the calendar month before", "taxa_presenca": "share of events attended",
    "score_engajamento": "engagement score", "indice_alinhamento_medio": "mean of front share over house share", "indice_alinhamento": "mean of group share over house share",
    "cnpj_suspeito": "constant mark of the supplier ranking", "valid_from": "start of the version", "valid_to": "end of the version; empty for the current one",
    "is_current": "whether the version is the current one", "dt_processamento": "processing time of the run", "balde": "bucket of the key",
    "uri_partido": "address of the party", "data_nascimento": "date of birth", "sigla_orgao": "organ code", "nome_orgao": "organ name",
    "duracao_horas": "duration in hours", "qtde_presencas": "deputies present", "nome_padronizado": "name in upper case", "urlFoto": "address of the photo",
    "email": "e-mail address", "status_nome": "name in the last status", "status_sigla_partido": "party in the last status", "status_sigla_uf": "state in the last status",
    "status_id_legislatura": "legislature of the last status", "titulo_padronizado": "title in upper case", "sigla": "party code", "descricao": "description",
    "siglaOrgao": "organ code", "codDocumento": "document code", "tipoDocumento": "document type", "dataDocumento": "document date as landed",
    "numDocumento": "document number", "valorDocumento": "document value as landed", "cnpjCpfFornecedor": "supplier tax id", "valorLiquido": "net value as landed",
    "valorGlosa": "disallowed value as landed", "valor_glosa": "disallowed value", "dataHoraInicio": "start as landed", "dataHoraFim": "end as landed",
    "localCamara_nome": "venue", "orgao": "organ", "orgaos": "organs", "presenca": "attendance list", "dia": "day", "indice_diversidade": "diversity index",
    "qtde_partidos": "distinct parties", "total_membros": "members", "total_gasto": "sum of the expenses", "media_gasto": "mean expense", "qtde_despesas": "expenses",
    "qtde_tipos_eventos": "distinct event types", "semana_inicio": "Monday of the week", "coordenador": "coordinator",
    "_extra": "unknown fields and unreadable values as JSON", "_invalidos": "known fields whose value could not be read", "_arquivo": "landed file", "pagina": "page number",
    "_posicao": "place on the page", "_chegada": "landing time",
}


def commented(schema: StructType, declared: StructType | None = None) -> list[tuple[str, str, str]]:
    """(column, type, comment) of each column."""
    known = {f.name: f.metadata.get("comment") for f in declared.fields} if declared is not None else {}
    return [(f.name, f.dataType.simpleString(), known.get(f.name) or f.metadata.get("comment") or GLOSSARY.get(f.name, "")) for f in schema.fields]


def partition_columns(spark: SparkSession, path: str) -> list[str]:
    """Names of the partition folders' columns, outermost first."""
    folder, at, out = Folder(spark, path), "", []
    while True:
        inside = [n for n in folder.visible(at) if "=" in n]
        if not inside:
            return out
        out.append(inside[0].split("=", 1)[0])
        at = f"{at}/{inside[0]}".lstrip("/")


def register_lake(spark: SparkSession, lake: str, prefix: str = "") -> list[str]:
    """Enter every published table as ``<prefix><layer>_<table>``; entries of an earlier run are replaced.  Returns the names."""
    from civiclake.plans.layers import bronze_schema

    names = []
    for layer, tables in TABLES.items():
        for table, comment in tables.items():
            path = os.path.join(lake, layer, table)
            if not is_published(spark, path):
                continue
            spec = BRONZE.get(table) if layer == "bronze" else None
            schema = bronze_schema(spec) if spec else read_published(spark, path).schema
            parts = partition_columns(spark, path)
            columns = commented(schema, spec.schema if spec else None)
            ordered = [c for c in columns if c[0] not in parts] + [c for p in parts for c in columns if c[0] == p]
            name = f"{prefix}{layer}_{table}"
            spark.sql(f"DROP TABLE IF EXISTS {name}")  # external: its files stay
            spec_sql = ", ".join(f"`{c}` {t} COMMENT '{_q(text)}'" for c, t, text in ordered)
            by = f" PARTITIONED BY ({', '.join(f'`{p}`' for p in parts)})" if parts else ""
            spark.sql(f"CREATE TABLE {name} ({spec_sql}) USING parquet{by} COMMENT '{_q(comment)}' LOCATION '{_q(path)}'")
            if parts:
                spark.sql(f"MSCK REPAIR TABLE {name}")
            names.append(name)
    return names
