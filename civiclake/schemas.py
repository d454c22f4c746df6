"""Declared schemas of the landed API records and the table registry.

Bronze is read with these schemas (no inference): a drifted record keeps
its known fields, unknown fields go to an overflow JSON column and a
malformed page lands in ``_corrupt_record``.  Column comments live in the
field metadata and are applied to registered tables by the sinks (W8/W9).
Money fields are declared as text because the API mixes numbers and
strings; silver parses them with ``try_cast`` and counts failures.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType


def f(name: str, dtype, comment: str = "") -> StructField:
    return StructField(name, dtype, True, {"comment": comment} if comment else {})


S, L = StringType(), LongType()

# The field names below are those of the open-data API records
# as landed (they must match the records for the declared parse to work).

DEPUTADOS = StructType([
    f("id", L, "deputy id"), f("nome", S, "parliamentary name"), f("siglaPartido", S, "party code"), f("uriPartido", S),
    f("siglaUf", S, "state code"), f("idLegislatura", L, "legislature"), f("dataNascimento", S), f("urlFoto", S), f("email", S),
    f("ultimoStatus", S, "last status as JSON text"),
])
FRENTES = StructType([
    f("id", L, "front id"), f("uri", S), f("titulo", S, "front title"), f("dataCriacao", S), f("idLegislatura", L),
    f("telefone", S), f("situacao", S), f("urlDocumento", S),
    f("coordenador", StructType([f("id", L), f("nome", S)]), "coordinator"),
])
FRENTES_MEMBROS = StructType([
    f("idFrente", L, "front id (from the landing path)"), f("id", L, "deputy id"), f("nome", S), f("titulo", S, "role in the front"),
])
ORGAO = StructType([f("id", S), f("sigla", S), f("nome", S)])
EVENTOS = StructType([
    f("id", L, "event id"), f("dataHoraInicio", S), f("dataHoraFim", S), f("descricaoTipo", S, "event type"), f("descricao", S),
    f("situacao", S), f("localCamara_nome", S, "venue"), f("orgaos", ArrayType(ORGAO), "organs"), f("orgao", ORGAO),
    f("presenca", ArrayType(StructType([f("id", L)])), "attendance list"),
])
VOTACOES = StructType([f("id", S, "ballot id"), f("data", S), f("descricao", S), f("siglaOrgao", S)])
VOTOS_DEPUTADOS = StructType([
    f("idVotacao", S, "ballot id (from the landing path)"), f("deputado_", S, "deputy as JSON text"), f("tipoVoto", S, "vote option"),
])
DESPESAS = StructType([
    f("idDeputado", L, "deputy id (from the landing path)"), f("ano", L), f("mes", L), f("tipoDespesa", S, "expense type"),
    f("codDocumento", S), f("tipoDocumento", S), f("dataDocumento", S), f("numDocumento", S), f("valorDocumento", S),
    f("cnpjCpfFornecedor", S, "supplier tax id"), f("nomeFornecedor", S, "supplier name"), f("valorLiquido", S, "net value"),
    f("valorGlosa", S),
])
CPIS = StructType([
    f("id", L, "proposal id"), f("siglaTipo", S, "proposal type"), f("numero", L), f("ano", L), f("ementa", S, "summary"),
    f("dataApresentacao", S, "date of presentation"), f("statusProposicao", S, "status as JSON text"),
])

LINK = StructType([f("rel", S), f("href", S)])


def envelope(record: StructType) -> StructType:
    """One landed page: ``{dados: [record...], links: [{rel, href}]}``."""
    return StructType([f("dados", ArrayType(record)), f("links", ArrayType(LINK))])


@dataclass(frozen=True)
class BronzeSpec:
    """How one endpoint lands and is conformed."""

    name: str
    schema: StructType
    natural_key: tuple[str, ...]
    parent: str | None = None  # column stamped from the ``<parent>=<id>`` path segment
    partition_by: tuple[str, ...] = ()
    required: tuple[str, ...] = field(default_factory=tuple)
    # SQL expressions of the key where columns do not suffice; the record's place is (pagina, _posicao)
    key_exprs: tuple[str, ...] = ()
    # key columns whose hash gives the bucket of a table partitioned by ``balde``: what lands together stays together
    cluster: tuple[str, ...] = ()
    buckets: int = 16

    @property
    def stable_partition(self) -> bool:
        """Whether a record's partition follows from its key (a corrected record cannot move)."""
        return bool(self.cluster)


BRONZE = {
    "deputados": BronzeSpec("deputados", DEPUTADOS, ("id",), required=("id",)),
    "frentes": BronzeSpec("frentes", FRENTES, ("id",), required=("id",)),
    "frentes_membros": BronzeSpec("frentes_membros", FRENTES_MEMBROS, ("idFrente", "id"), parent="idFrente", partition_by=("balde",), required=("idFrente", "id"), cluster=("idFrente",)),
    # one events table partitioned by year (S13), not one table per year
    "eventos": BronzeSpec("eventos", EVENTOS, ("id",), partition_by=("ano",), required=("id",)),
    "votacoes": BronzeSpec("votacoes", VOTACOES, ("id",), required=("id",)),
    "votos_deputados": BronzeSpec(
        "votos_deputados", VOTOS_DEPUTADOS, ("idVotacao",), parent="idVotacao", partition_by=("balde",), required=("idVotacao",), cluster=("idVotacao",),
        # the deputy's id, not the deputy's text, which changes with a photo; a vote without one is kept by its place on its page
        key_exprs=("coalesce(get_json_object(deputado_, '$.id'), concat('#', coalesce(pagina, -1), ':', _posicao))",),
    ),
    "despesas_deputados": BronzeSpec(
        "despesas_deputados", DESPESAS,
        # claims share document numbers, so only a record equal in every field is the same claim landed again
        tuple(DESPESAS.names),
        parent="idDeputado", partition_by=("balde",), required=("idDeputado",), cluster=("ano", "mes"),
        # also in unknown fields and in the text of malformed ones
        key_exprs=("coalesce(_extra, '')",),
    ),
    # each day's landing stays, so that a committee's states can be followed
    "cpis": BronzeSpec("cpis", CPIS, ("id",), required=("id",), key_exprs=("to_date(_chegada)",)),
}
