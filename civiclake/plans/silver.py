"""Silver builders (V1-V15): bronze frames -> cleaned dimensions and facts.

Each builder is a pure function of DataFrames plus an ``as_of`` timestamp
(one literal for the whole run, so re-runs are reproducible).  Keys are
deterministic (K3), so facts never join a dimension just to fetch its
surrogate key.  Gen-A (star schema with SCD2 columns) and Gen-B (cleaned,
deduplicated, partitioned by year/month) are both provided.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civiclake.functions.clean import (
    clean_columns,
    clean_text,
    clean_upper,
    json_field,
    money,
    non_negative_or_null,
    to_date_safe,
    to_timestamp_safe,
)
from civiclake.functions.dates import month_label
from civiclake.functions.keys import surrogate_key
from civiclake.operators.dedup import keep_latest
from civiclake.operators.events import date_dim, event_fact
from civiclake.operators.joins import lookup_join
from civiclake.operators.scd2 import scd2_snapshot


def _stamp(df: DataFrame, as_of: str, name: str = "dt_processamento") -> DataFrame:
    return df.withColumn(name, F.lit(as_of).cast("timestamp"))


# ------------------------------------------------------------------ Gen-A
def dim_deputado(deputados: DataFrame, as_of: str) -> DataFrame:
    """V1: renamed deputy attributes + SCD2 columns (current snapshot)."""
    d = deputados.select(
        F.col("id").alias("id_deputado"), F.col("nome").alias("nome_deputado"), clean_upper("siglaPartido").alias("sigla_partido"),
        F.col("uriPartido").alias("uri_partido"), clean_upper("siglaUf").alias("sigla_uf"), F.col("idLegislatura").alias("id_legislatura"),
        to_date_safe("dataNascimento").alias("data_nascimento"),
    )
    return scd2_snapshot(d, as_of)


def dim_partido(dim_dep: DataFrame, as_of: str) -> DataFrame:
    """V2: distinct parties of the deputy dimension, normalised before the distinct."""
    p = dim_dep.select(clean_upper("sigla_partido").alias("sigla_partido")).where(F.col("sigla_partido").isNotNull()).distinct()
    return scd2_snapshot(p.select(surrogate_key("sigla_partido").alias("id_partido"), "sigla_partido"), as_of)


def dim_frente(frentes: DataFrame, as_of: str) -> DataFrame:
    """V3: renamed front attributes, creation date, coordinator struct kept, SCD2 columns."""
    f = frentes.select(
        F.col("id").alias("id_frente"), clean_text("titulo").alias("titulo_frente"), to_date_safe("dataCriacao").alias("data_criacao"),
        F.col("idLegislatura").alias("id_legislatura"), "coordenador",
    )
    return scd2_snapshot(f, as_of)


def fact_frente_membro(membros: DataFrame, as_of: str) -> DataFrame:
    """V4: (front, deputy, reference date) bridge, deduplicated (§2.13 #9)."""
    m = membros.select(F.col("idFrente").alias("id_frente"), F.col("id").alias("id_deputado")).where(
        F.col("id_frente").isNotNull() & F.col("id_deputado").isNotNull()
    ).distinct()
    return m.withColumn("data_referencia", F.lit(as_of).cast("date"))


def event_dims(eventos: DataFrame) -> dict[str, DataFrame]:
    """V5: date, organ and event-type dimensions with deterministic keys.

    Organs come from the ``orgaos`` array or a single ``orgao`` struct;
    events without organs contribute none (P7, P8).
    """
    dim_data = date_dim(eventos.select(to_timestamp_safe("dataHoraInicio").alias("inicio")), "inicio")
    # an empty array must not hide a single organ
    organs = F.when(F.size("orgaos") > 0, F.col("orgaos")).when(F.col("orgao").isNotNull(), F.array(F.col("orgao")))
    org = eventos.select(F.explode(organs).alias("org")).select(
        F.col("org.id").alias("id_orgao"), clean_text("org.sigla").alias("sigla_orgao"), clean_text("org.nome").alias("nome_orgao")
    ).where(F.col("id_orgao").isNotNull())
    # one row an organ, however its name is spelt
    dim_orgao = keep_latest(org, ["id_orgao"]).select(surrogate_key("id_orgao").alias("id_orgao_dim"), "id_orgao", "sigla_orgao", "nome_orgao")
    tipo = eventos.select(clean_text("descricaoTipo").alias("descricao_tipo")).where(F.col("descricao_tipo").isNotNull()).distinct()
    dim_tipo = tipo.select(surrogate_key("descricao_tipo").alias("id_tipo_evento"), "descricao_tipo")
    return {"dim_data": dim_data, "dim_orgao": dim_orgao, "dim_tipo_evento": dim_tipo}


def fact_evento(eventos: DataFrame) -> DataFrame:
    """Event fact with date and type keys, duration and attendance."""
    ev = eventos.select(
        "id", to_timestamp_safe("dataHoraInicio").alias("inicio"), to_timestamp_safe("dataHoraFim").alias("fim"),
        clean_text("descricaoTipo").alias("tipo"), "presenca",
    )
    return event_fact(ev, "id", "inicio", "fim", "tipo", "presenca")


def fact_voto(votos: DataFrame) -> DataFrame:
    """V7: (deputy, ballot, option); the deputy id is read from the nested JSON (§2.13 #10)."""
    return votos.select(
        json_field("deputado_", "id", "bigint").alias("id_deputado"), clean_text("idVotacao").alias("idVotacao"),
        clean_text("tipoVoto").alias("voto_texto"),
    )


def expense_dims(despesas: DataFrame) -> dict[str, DataFrame]:
    """V8 dimensions: suppliers and categories with deterministic keys."""
    sup = despesas.select(clean_text(F.coalesce("nomeFornecedor", "cnpjCpfFornecedor")).alias("nome_fornecedor")).where(
        F.col("nome_fornecedor").isNotNull()
    ).distinct()
    cat = despesas.select(clean_text("tipoDespesa").alias("categoria")).where(F.col("categoria").isNotNull()).distinct()
    return {
        "dim_fornecedor": sup.select(surrogate_key("nome_fornecedor").alias("id_fornecedor"), "nome_fornecedor"),
        "dim_categoria": cat.select(surrogate_key("categoria").alias("id_categoria"), "categoria"),
    }


def fact_despesa(despesas: DataFrame) -> DataFrame:
    """V8: expense fact with month label, supplier/category keys and decimal value."""
    d = to_date_safe("dataDocumento")
    return despesas.select(
        F.col("idDeputado").alias("id_deputado"),
        surrogate_key(clean_text(F.coalesce("nomeFornecedor", "cnpjCpfFornecedor"))).alias("id_fornecedor"),
        surrogate_key(clean_text("tipoDespesa")).alias("id_categoria"),
        month_label(d).alias("ano_mes"),
        money("valorLiquido").alias("valor_liquido"),
    )


# ------------------------------------------------------------------ Gen-B
def dim_deputados(deputados: DataFrame, as_of: str) -> DataFrame:
    """V9: cleaned, upper-cased, status fields from JSON, one row per id."""
    d = clean_columns(deputados, ["nome", "siglaPartido", "siglaUf", "urlFoto", "email"])
    d = d.withColumns({
        "nome_padronizado": F.upper("nome"), "sigla_partido": F.upper("siglaPartido"), "sigla_uf": F.upper("siglaUf"),
        "status_nome": json_field("ultimoStatus", "nome"), "status_sigla_partido": json_field("ultimoStatus", "siglaPartido"),
        "status_sigla_uf": json_field("ultimoStatus", "siglaUf"), "status_id_legislatura": json_field("ultimoStatus", "idLegislatura", "bigint"),
    })
    d = keep_latest(d.select("id", "nome", "nome_padronizado", "sigla_partido", "sigla_uf", "urlFoto", "email", "status_nome",
                             "status_sigla_partido", "status_sigla_uf", "status_id_legislatura"), ["id"])
    return _stamp(d, as_of)


def dim_frentes(frentes: DataFrame, as_of: str) -> DataFrame:
    """Cleaned title/status, upper-cased title, one row per id."""
    f = clean_columns(frentes, ["titulo", "situacao"]).withColumn("titulo_padronizado", F.upper("titulo"))
    f = keep_latest(f.select("id", "titulo", "titulo_padronizado", "situacao", "idLegislatura"), ["id"])
    return _stamp(f, as_of)


def dim_partidos(deputados: DataFrame, as_of: str) -> DataFrame:
    """Distinct normalised non-NULL parties with a deterministic id."""
    if "siglaPartido" not in deputados.columns:
        return deputados.sparkSession.createDataFrame([], "id STRING, sigla STRING, dt_processamento TIMESTAMP")
    p = deputados.select(clean_upper("siglaPartido").alias("sigla")).where(F.col("sigla").isNotNull()).distinct()
    return _stamp(p.select(surrogate_key("sigla").alias("id"), "sigla"), as_of)


def fact_votacoes(votacoes: DataFrame, votos: DataFrame, as_of: str) -> DataFrame:
    """Votes with the ballot header; partitioned by the ballot's year/month."""
    header = clean_columns(votacoes, ["descricao", "siglaOrgao"]).withColumn("data_votacao", to_timestamp_safe("data"))
    header = keep_latest(header.select("id", "descricao", "data_votacao", "siglaOrgao"), ["id"])
    v = votos.select(
        clean_text("idVotacao").alias("idVotacao"), json_field("deputado_", "id", "bigint").alias("deputado_id"),
        clean_text("tipoVoto").alias("tipoVoto"),
    )
    f = lookup_join(v, header, "idVotacao", "id", ["descricao", "data_votacao", "siglaOrgao"])
    f = f.withColumns({"ano": F.year("data_votacao"), "mes": F.month("data_votacao")})
    return _stamp(f, as_of)


def fact_despesas(despesas: DataFrame, as_of: str) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) expenses.

    Text cleaned, values parsed as decimal(18,2) (unparsable -> NULL),
    dates parsed, the non-negativity rule splits rows, year/month added.
    The natural-key dedup (K8) already ran in bronze.
    """
    d = clean_columns(despesas, ["tipoDespesa", "tipoDocumento", "cnpjCpfFornecedor", "nomeFornecedor"])
    d = d.withColumns({
        "valor_documento": money("valorDocumento"), "valor_liquido": money("valorLiquido"), "valor_glosa": money("valorGlosa"),
        "data_documento": to_date_safe("dataDocumento"),
    })
    d = d.withColumns({"ano": F.year("data_documento"), "mes": F.month("data_documento")})
    d = _stamp(d, as_of)
    ok = non_negative_or_null("valor_liquido")
    return d.where(ok), d.where(~ok)


def fact_eventos(eventos: DataFrame, as_of: str) -> DataFrame:
    """Cleaned events, parsed timestamps, one row per id, year/month/day."""
    e = clean_columns(eventos, ["descricao", "situacao", "descricaoTipo", "localCamara_nome"])
    e = e.withColumns({"data_inicio": to_timestamp_safe("dataHoraInicio"), "data_fim": to_timestamp_safe("dataHoraFim")})
    e = keep_latest(e, ["id"], ["data_inicio"])
    e = e.withColumns({"ano": F.year("data_inicio"), "mes": F.month("data_inicio"), "dia": F.dayofmonth("data_inicio")})
    return _stamp(e, as_of)


def fact_frentes_membros(membros: DataFrame, as_of: str) -> DataFrame:
    """Cleaned role title, one row per (front, deputy)."""
    m = clean_columns(membros, ["titulo"])
    m = keep_latest(m.select("idFrente", "id", "nome", "titulo"), ["idFrente", "id"])
    return _stamp(m, as_of)


def build_all(bronze: dict[str, DataFrame], as_of: str) -> dict[str, DataFrame]:
    """Every silver table from the bronze frames (Gen-A and Gen-B names)."""
    out: dict[str, DataFrame] = {}
    dd = dim_deputado(bronze["deputados"], as_of)
    out["dim_deputado"] = dd
    out["dim_partido"] = dim_partido(dd, as_of)
    out["dim_frente"] = dim_frente(bronze["frentes"], as_of)
    out["fato_frente_membro"] = fact_frente_membro(bronze["frentes_membros"], as_of)
    out.update(event_dims(bronze["eventos"]))
    out["fato_evento"] = fact_evento(bronze["eventos"])
    out["fato_voto"] = fact_voto(bronze["votos_deputados"])
    out.update(expense_dims(bronze["despesas_deputados"]))
    out["fato_despesa"] = fact_despesa(bronze["despesas_deputados"])
    out["dim_deputados"] = dim_deputados(bronze["deputados"], as_of)
    out["dim_frentes"] = dim_frentes(bronze["frentes"], as_of)
    out["dim_partidos"] = dim_partidos(bronze["deputados"], as_of)
    out["fact_votacoes"] = fact_votacoes(bronze["votacoes"], bronze["votos_deputados"], as_of)
    ok, rejected = fact_despesas(bronze["despesas_deputados"], as_of)
    out["fact_despesas"], out["fact_despesas_rejeitadas"] = ok, rejected
    out["fact_eventos"] = fact_eventos(bronze["eventos"], as_of)
    out["fact_frentes_membros"] = fact_frentes_membros(bronze["frentes_membros"], as_of)
    return out


# every table build_all returns, in build order
TABLES = (
    "dim_deputado", "dim_partido", "dim_frente", "fato_frente_membro", "dim_data", "dim_orgao", "dim_tipo_evento", "fato_evento",
    "fato_voto", "dim_fornecedor", "dim_categoria", "fato_despesa", "dim_deputados", "dim_frentes", "dim_partidos", "fact_votacoes",
    "fact_despesas", "fact_despesas_rejeitadas", "fact_eventos", "fact_frentes_membros",
)

# star dimensions whose versions a run merges into the written history (K6)
HISTORY = ("dim_deputado", "dim_partido", "dim_frente")

# partition columns of the Gen-B facts
PARTITIONS = {"fact_votacoes": ("ano", "mes"), "fact_despesas": ("ano", "mes"), "fact_eventos": ("ano", "mes")}
