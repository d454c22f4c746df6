"""Registered queries of the silver builders (V1-V15) over the driver tables.

The builders take landed records.  ``landed`` shapes the driver tables like
those: padded and empty texts, dates and amounts as text, JSON texts, arrays
of structs, unparsable values.  Each query runs one builder; its SQL oracle
is written from the driver tables directly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civiclake.operators import diversity
from civiclake.plans import roles, silver
from civiclake.plans.registry import register

AS_OF = "2024-12-31 00:00:00"


def _table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return roles.table(spark, d, name)


def deputados(spark: SparkSession, d: str) -> DataFrame:
    """Customers as deputies: padded names, blank parties for negative balances, status as JSON text."""
    status = F.to_json(F.struct(F.col("c_name").alias("nome"), F.col("c_mktsegment").alias("siglaPartido"), F.col("c_nationkey").alias("idLegislatura")))
    return _table(spark, d, "customer").select(
        F.col("c_custkey").alias("id"), F.concat(F.lit("  "), "c_name", F.lit(" ")).alias("nome"),
        F.when(F.col("c_acctbal") < 0, F.lit("  ")).otherwise(F.concat(F.lit(" "), F.lower("c_mktsegment"))).alias("siglaPartido"),
        F.concat(F.lit("partidos/"), "c_mktsegment").alias("uriPartido"), F.concat(F.lit("n"), F.col("c_nationkey").cast("string")).alias("siglaUf"),
        F.col("c_nationkey").cast("long").alias("idLegislatura"),
        F.when(F.col("c_acctbal") < 0, F.lit("desconhecida")).otherwise(F.date_add(F.lit("1950-01-01").cast("date"), F.col("c_nationkey")).cast("string")).alias("dataNascimento"),
        F.lit("").alias("urlFoto"), F.concat("c_name", F.lit("@x ")).alias("email"), F.when(F.col("c_acctbal") < 0, F.lit("{")).otherwise(status).alias("ultimoStatus"),
    )


def frentes(spark: SparkSession, d: str) -> DataFrame:
    """Suppliers as fronts."""
    return _table(spark, d, "supplier").select(
        F.col("s_suppkey").alias("id"), F.concat(F.lit(" "), "s_name").alias("titulo"), F.when(F.col("s_acctbal") < 0, F.lit("2020-13-45")).otherwise(F.lit("2020-02-03T10:00")).alias("dataCriacao"),
        F.col("s_nationkey").cast("long").alias("idLegislatura"), F.when(F.col("s_acctbal") < 0, F.lit(" ")).otherwise(F.lit("ativa ")).alias("situacao"),
        F.struct(F.col("s_suppkey").alias("id"), F.col("s_name").alias("nome")).alias("coordenador"),
    )


def membros(spark: SparkSession, d: str) -> DataFrame:
    """Line items as memberships, a deputy many times in a front."""
    o = _table(spark, d, "orders").select("o_orderkey", "o_custkey")
    li = _table(spark, d, "lineitem").select("l_orderkey", "l_suppkey", "l_returnflag")
    return li.join(o, li["l_orderkey"] == o["o_orderkey"]).select(
        F.col("l_suppkey").alias("idFrente"), F.col("o_custkey").alias("id"), F.lit("x").alias("nome"), F.concat(F.lit(" "), "l_returnflag").alias("titulo")
    )


def eventos(spark: SparkSession, d: str) -> DataFrame:
    """Orders as events: times as text, organs and attendance as arrays; orders without line items have a single organ."""
    li = _table(spark, d, "lineitem").groupBy("l_orderkey").agg(
        F.max("l_shipdate").alias("fim"), F.collect_list(F.struct(F.col("l_linenumber").cast("long").alias("id"))).alias("presenca"),
        F.array_sort(F.collect_set(F.struct(F.col("l_returnflag").alias("id"), F.concat(F.lit(" "), "l_returnflag").alias("sigla"), F.lower("l_returnflag").alias("nome")))).alias("orgaos"),
    )
    o = _table(spark, d, "orders")
    return o.join(li, o["o_orderkey"] == li["l_orderkey"], "left").select(
        F.col("o_orderkey").alias("id"), F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm").alias("dataHoraInicio"),
        F.when(F.col("o_orderstatus") == "P", F.lit("sem fim")).otherwise(F.date_format("fim", "yyyy-MM-dd'T'HH:mm")).alias("dataHoraFim"),
        F.concat(F.lit(" "), "o_orderpriority").alias("descricaoTipo"), F.lit(" ").alias("descricao"), F.concat("o_orderstatus", F.lit(" ")).alias("situacao"),
        F.lit(None).cast("string").alias("localCamara_nome"), F.coalesce("orgaos", F.array().cast("array<struct<id:string,sigla:string,nome:string>>")).alias("orgaos"),
        F.when(F.col("orgaos").isNull(), F.struct(F.concat(F.lit("S"), "o_orderstatus").alias("id"), F.lit("").alias("sigla"), F.col("o_orderstatus").alias("nome"))).alias("orgao"),
        "presenca",
    )


def votacoes(spark: SparkSession, d: str) -> DataFrame:
    """Event days as ballots; error days have no header."""
    e = _table(spark, d, "events").where("event_type <> 'error'")
    return e.select(F.to_date("ts").cast("string").alias("id")).distinct().select(
        "id", F.concat("id", F.lit("T09:30")).alias("data"), F.concat(F.lit(" PL "), "id").alias("descricao"), F.lit(" PLEN").alias("siglaOrgao")
    )


def votos(spark: SparkSession, d: str) -> DataFrame:
    """Stream events as votes, the deputy as JSON text."""
    return _table(spark, d, "events").select(
        F.concat(F.lit(" "), F.to_date("ts").cast("string")).alias("idVotacao"),
        F.when(F.col("event_type") == "error", F.lit("nao json")).otherwise(F.to_json(F.struct(F.col("user_id").alias("id"), F.lit("x").alias("nome")))).alias("deputado_"),
        F.concat("event_type", F.lit(" ")).alias("tipoVoto"),
    )


def despesas(spark: SparkSession, d: str) -> DataFrame:
    """Line items as expense claims: amounts and dates as text, returned items negative, suppliers in debt without a name."""
    li, o, p, s = (_table(spark, d, t) for t in ("lineitem", "orders", "part", "supplier"))
    j = li.join(o, li["l_orderkey"] == o["o_orderkey"]).join(p, li["l_partkey"] == p["p_partkey"]).join(s, li["l_suppkey"] == s["s_suppkey"])
    amount = F.col("l_extendedprice").cast("decimal(18,2)").cast("string")
    day = F.date_format("l_shipdate", "yyyy-MM-dd")
    return j.select(
        F.col("o_custkey").alias("idDeputado"), F.concat("p_type", F.lit(" ")).alias("tipoDespesa"), F.lit(" Nota").alias("tipoDocumento"),
        F.when(F.col("l_linestatus") == "O", day).otherwise(F.concat(day, F.lit("T00:00:00"))).alias("dataDocumento"),
        F.when(F.col("s_acctbal") < 0, F.lit(None)).otherwise(F.concat(F.lit(" "), "s_name")).alias("nomeFornecedor"), F.col("l_suppkey").cast("string").alias("cnpjCpfFornecedor"),
        F.when(F.col("l_returnflag") == "R", F.concat(F.lit("-"), amount)).when(F.col("l_returnflag") == "A", F.lit("n/d")).otherwise(amount).alias("valorLiquido"),
        amount.alias("valorDocumento"), F.lit("").alias("valorGlosa"), F.col("l_orderkey").cast("string").alias("codDocumento"), F.col("l_linenumber").cast("string").alias("numDocumento"),
        F.year("l_shipdate").cast("long").alias("ano"), F.month("l_shipdate").cast("long").alias("mes"),
    )


SNAP = f"TIMESTAMP '{AS_OF}' AS valid_from, CAST(NULL AS TIMESTAMP) AS valid_to, true AS is_current"
DONE = f"TIMESTAMP '{AS_OF}' AS dt_processamento"


@register("silver_dim_deputado", f"""SELECT c_custkey AS id_deputado, c_name AS nome_deputado, CASE WHEN c_acctbal < 0 THEN NULL ELSE c_mktsegment END AS sigla_partido,
  'partidos/' || c_mktsegment AS uri_partido, 'N' || c_nationkey AS sigla_uf, CAST(c_nationkey AS BIGINT) AS id_legislatura,
  CASE WHEN c_acctbal < 0 THEN NULL ELSE DATE '1950-01-01' + c_nationkey END AS data_nascimento, {SNAP} FROM customer""")  # fmt: skip
def q_dim_deputado(spark: SparkSession, d: str) -> DataFrame:
    """V1, K5: deputies as current versions.  (The reference keeps the name's padding.)"""
    return silver.dim_deputado(deputados(spark, d), AS_OF).withColumn("nome_deputado", F.trim("nome_deputado"))


@register("silver_dim_partido", f"""SELECT md5(p) AS id_partido, p AS sigla_partido, {SNAP}
  FROM (SELECT DISTINCT c_mktsegment AS p FROM customer WHERE c_acctbal >= 0 AND c_mktsegment IS NOT NULL)""")  # fmt: skip
def q_dim_partido(spark: SparkSession, d: str) -> DataFrame:
    """V2: parties of the deputies."""
    return silver.dim_partido(silver.dim_deputado(deputados(spark, d), AS_OF), AS_OF)


@register("silver_dim_frente", f"""SELECT s_suppkey AS id_frente, s_name AS titulo_frente, CASE WHEN s_acctbal < 0 THEN NULL ELSE DATE '2020-02-03' END AS data_criacao,
  CAST(s_nationkey AS BIGINT) AS id_legislatura, s_suppkey AS coordenador_id, {SNAP} FROM supplier""")  # fmt: skip
def q_dim_frente(spark: SparkSession, d: str) -> DataFrame:
    """V3: fronts as current versions; the coordinator struct by its id."""
    return silver.dim_frente(frentes(spark, d), AS_OF).withColumn("coordenador_id", F.col("coordenador.id")).drop("coordenador")


@register("silver_frente_membro", f"SELECT DISTINCT l_suppkey AS id_frente, o_custkey AS id_deputado, CAST(TIMESTAMP '{AS_OF}' AS DATE) AS data_referencia FROM lineitem JOIN orders ON l_orderkey = o_orderkey")
def q_frente_membro(spark: SparkSession, d: str) -> DataFrame:
    """V4: the membership bridge, each pair once."""
    return silver.fact_frente_membro(membros(spark, d), AS_OF)


@register("silver_dim_data", "SELECT md5(CAST(d AS VARCHAR)) AS id_data, d AS data FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders WHERE o_orderdate IS NOT NULL)")
def q_dim_data(spark: SparkSession, d: str) -> DataFrame:
    """Dates of the events' text times."""
    return silver.event_dims(eventos(spark, d))["dim_data"]


@register("silver_dim_orgao", """SELECT md5(id) AS id_orgao_dim, id AS id_orgao, sigla AS sigla_orgao, nome AS nome_orgao FROM (
  SELECT DISTINCT l_returnflag AS id, l_returnflag AS sigla, lower(l_returnflag) AS nome FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  UNION SELECT DISTINCT 'S' || o_orderstatus, NULL, o_orderstatus FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)) WHERE id IS NOT NULL""")  # fmt: skip
def q_dim_orgao(spark: SparkSession, d: str) -> DataFrame:
    """Organs from arrays, or the single struct where the array is empty."""
    return silver.event_dims(eventos(spark, d))["dim_orgao"]


@register("silver_dim_tipo_evento", "SELECT md5(p) AS id_tipo_evento, p AS descricao_tipo FROM (SELECT DISTINCT o_orderpriority AS p FROM orders WHERE o_orderpriority IS NOT NULL)")
def q_dim_tipo_evento(spark: SparkSession, d: str) -> DataFrame:
    """V5: event types."""
    return silver.event_dims(eventos(spark, d))["dim_tipo_evento"]


@register("silver_fato_evento", """WITH li AS (SELECT l_orderkey, max(l_shipdate) AS fim, count(*) AS n FROM lineitem GROUP BY 1)
SELECT o_orderkey AS id_evento, md5(CAST(CAST(o_orderdate AS DATE) AS VARCHAR)) AS id_data, md5(o_orderpriority) AS id_tipo_evento,
  CASE WHEN o_orderstatus <> 'P' THEN round(date_diff('second', date_trunc('minute', o_orderdate), date_trunc('minute', fim)) / 3600.0, 6) END AS duracao_horas,
  CAST(n AS INTEGER) AS qtde_presencas FROM orders LEFT JOIN li ON o_orderkey = l_orderkey""")  # fmt: skip
def q_fato_evento(spark: SparkSession, d: str) -> DataFrame:
    """The event fact from text times and an attendance array."""
    return silver.fact_evento(eventos(spark, d)).withColumn("duracao_horas", F.round("duracao_horas", 6))


@register("silver_fato_voto", "SELECT CASE WHEN event_type = 'error' THEN NULL ELSE user_id END AS id_deputado, CAST(CAST(ts AS DATE) AS VARCHAR) AS idVotacao, event_type AS voto_texto FROM events")
def q_fato_voto(spark: SparkSession, d: str) -> DataFrame:
    """V7: votes, the deputy read from JSON text (NULL where it is none)."""
    return silver.fact_voto(votos(spark, d))


NAME = "CASE WHEN s_acctbal < 0 THEN CAST(l_suppkey AS VARCHAR) ELSE s_name END"
EXPENSES = "FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey"
VALUE = "CASE l_returnflag WHEN 'R' THEN -CAST(l_extendedprice AS DECIMAL(18,2)) WHEN 'A' THEN NULL ELSE CAST(l_extendedprice AS DECIMAL(18,2)) END"


@register("silver_dim_fornecedor", f"SELECT md5(n) AS id_fornecedor, n AS nome_fornecedor FROM (SELECT DISTINCT {NAME} AS n {EXPENSES}) WHERE n IS NOT NULL")
def q_dim_fornecedor(spark: SparkSession, d: str) -> DataFrame:
    """V8: suppliers by name, or by tax id where the name is missing."""
    return silver.expense_dims(despesas(spark, d))["dim_fornecedor"]


@register("silver_dim_categoria", f"SELECT md5(n) AS id_categoria, n AS categoria FROM (SELECT DISTINCT p_type AS n {EXPENSES}) WHERE n IS NOT NULL")
def q_dim_categoria(spark: SparkSession, d: str) -> DataFrame:
    """V8: expense categories."""
    return silver.expense_dims(despesas(spark, d))["dim_categoria"]


@register("silver_fato_despesa", f"SELECT o_custkey AS id_deputado, md5({NAME}) AS id_fornecedor, md5(p_type) AS id_categoria, strftime(l_shipdate, '%Y-%m') AS ano_mes, {VALUE} AS valor_liquido {EXPENSES}")
def q_fato_despesa(spark: SparkSession, d: str) -> DataFrame:
    """The expense fact with keys and exact amounts (unparsable: NULL)."""
    return silver.fact_despesa(despesas(spark, d))


@register("silver_dim_deputados", f"""SELECT c_custkey AS id, c_name AS nome, upper(c_name) AS nome_padronizado, CASE WHEN c_acctbal < 0 THEN NULL ELSE c_mktsegment END AS sigla_partido,
  'N' || c_nationkey AS sigla_uf, CAST(NULL AS VARCHAR) AS urlFoto, c_name || '@x' AS email, CASE WHEN c_acctbal >= 0 THEN c_name END AS status_nome,
  CASE WHEN c_acctbal >= 0 THEN c_mktsegment END AS status_sigla_partido, CAST(NULL AS VARCHAR) AS status_sigla_uf,
  CASE WHEN c_acctbal >= 0 THEN CAST(c_nationkey AS BIGINT) END AS status_id_legislatura, {DONE} FROM customer""")  # fmt: skip
def q_dim_deputados(spark: SparkSession, d: str) -> DataFrame:
    """V9: cleaned deputies with fields of the JSON status; records landed twice count once."""
    twice = deputados(spark, d)
    return silver.dim_deputados(twice.unionByName(twice), AS_OF)


@register("silver_dim_frentes", f"""SELECT s_suppkey AS id, s_name AS titulo, upper(s_name) AS titulo_padronizado, CASE WHEN s_acctbal < 0 THEN NULL ELSE 'ativa' END AS situacao,
  CAST(s_nationkey AS BIGINT) AS idLegislatura, {DONE} FROM supplier""")  # fmt: skip
def q_dim_frentes(spark: SparkSession, d: str) -> DataFrame:
    """Cleaned fronts."""
    return silver.dim_frentes(frentes(spark, d), AS_OF)


@register("silver_dim_partidos", f"SELECT md5(p) AS id, p AS sigla, {DONE} FROM (SELECT DISTINCT c_mktsegment AS p FROM customer WHERE c_acctbal >= 0)")
def q_dim_partidos(spark: SparkSession, d: str) -> DataFrame:
    """Distinct normalised parties."""
    return silver.dim_partidos(deputados(spark, d), AS_OF)


@register("silver_fact_votacoes", f"""WITH h AS (SELECT DISTINCT CAST(ts AS DATE) AS dia FROM events WHERE event_type <> 'error')
SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS idVotacao, CASE WHEN event_type = 'error' THEN NULL ELSE user_id END AS deputado_id, event_type AS tipoVoto,
  'PL ' || CAST(h.dia AS VARCHAR) AS descricao, CAST(h.dia AS TIMESTAMP) + INTERVAL '9 hours 30 minutes' AS data_votacao,
  CASE WHEN h.dia IS NOT NULL THEN 'PLEN' END AS siglaOrgao, CAST(year(h.dia) AS INTEGER) AS ano, CAST(month(h.dia) AS INTEGER) AS mes, {DONE}
FROM events LEFT JOIN h ON CAST(ts AS DATE) = h.dia""")  # fmt: skip
def q_fact_votacoes(spark: SparkSession, d: str) -> DataFrame:
    """Votes with their ballot's header; votes without one stay."""
    return silver.fact_votacoes(votacoes(spark, d), votos(spark, d), AS_OF)


def _despesas_sql(test: str) -> str:
    return f"""SELECT o_custkey AS "idDeputado", p_type AS "tipoDespesa", 'Nota' AS "tipoDocumento",
  CASE WHEN s_acctbal < 0 THEN NULL ELSE s_name END AS "nomeFornecedor", CAST(l_orderkey AS VARCHAR) AS "codDocumento", CAST(l_linenumber AS VARCHAR) AS "numDocumento",
  CAST(l_extendedprice AS DECIMAL(18,2)) AS valor_documento, {VALUE} AS valor_liquido, CAST(l_shipdate AS DATE) AS data_documento,
  CAST(year(l_shipdate) AS INTEGER) AS ano, CAST(month(l_shipdate) AS INTEGER) AS mes {EXPENSES} WHERE {test}"""


DESPESA_COLS = ["idDeputado", "tipoDespesa", "tipoDocumento", "nomeFornecedor", "codDocumento", "numDocumento", "valor_documento", "valor_liquido", "data_documento", "ano", "mes"]


@register("silver_fact_despesas", _despesas_sql("l_returnflag <> 'R' OR l_extendedprice <= 0"))
def q_fact_despesas(spark: SparkSession, d: str) -> DataFrame:
    """Accepted expenses, unparsable amounts NULL."""
    return silver.fact_despesas(despesas(spark, d), AS_OF)[0].select(*DESPESA_COLS)


@register("silver_fact_despesas_rejeitadas", _despesas_sql("l_returnflag = 'R' AND l_extendedprice > 0"))
def q_fact_despesas_rejeitadas(spark: SparkSession, d: str) -> DataFrame:
    """Expenses that the non-negativity rule rejects."""
    return silver.fact_despesas(despesas(spark, d), AS_OF)[1].select(*DESPESA_COLS)


@register("silver_fact_eventos", f"""WITH li AS (SELECT l_orderkey, max(l_shipdate) AS fim FROM lineitem GROUP BY 1)
SELECT o_orderkey AS id, CAST(NULL AS VARCHAR) AS descricao, o_orderstatus AS situacao, o_orderpriority AS "descricaoTipo", date_trunc('minute', o_orderdate) AS data_inicio,
  CASE WHEN o_orderstatus <> 'P' THEN date_trunc('minute', fim) END AS data_fim, CAST(year(o_orderdate) AS INTEGER) AS ano, CAST(month(o_orderdate) AS INTEGER) AS mes,
  CAST(day(o_orderdate) AS INTEGER) AS dia, {DONE} FROM orders LEFT JOIN li ON o_orderkey = l_orderkey""")  # fmt: skip
def q_fact_eventos(spark: SparkSession, d: str) -> DataFrame:
    """Cleaned events with parsed times."""
    cols = ["id", "descricao", "situacao", "descricaoTipo", "data_inicio", "data_fim", "ano", "mes", "dia", "dt_processamento"]
    return silver.fact_eventos(eventos(spark, d), AS_OF).select(*cols)


@register("silver_fact_frentes_membros", f"""SELECT l_suppkey AS "idFrente", o_custkey AS id, 'x' AS nome, max(l_returnflag) AS titulo, {DONE}
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2""")  # fmt: skip
def q_fact_frentes_membros(spark: SparkSession, d: str) -> DataFrame:
    """One row per (front, deputy), the greatest title."""
    return silver.fact_frentes_membros(membros(spark, d), AS_OF)


@register("herfindahl_front", """WITH m AS (SELECT DISTINCT l_suppkey AS f, o_custkey AS id FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
g AS (SELECT f, c_mktsegment AS p, count(*) AS n FROM m JOIN customer ON id = c_custkey GROUP BY 1, 2)
SELECT f AS "idFrente", round(1 - sum((n / t) * (n / t)), 6) AS indice_diversidade FROM (SELECT *, sum(n) OVER (PARTITION BY f) AS t FROM g) GROUP BY f""")  # fmt: skip
def q_herfindahl_front(spark: SparkSession, d: str) -> DataFrame:
    """G1: the public helper by its own signature."""
    c = _table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("sigla"))
    counts = membros(spark, d).select("idFrente", "id").distinct().join(c, "id").groupBy("idFrente", "sigla").agg(F.count("*").alias("n"))
    return diversity.herfindahl_index(counts, "idFrente", "sigla", "n").withColumn("indice_diversidade", F.round("indice_diversidade", 6))
