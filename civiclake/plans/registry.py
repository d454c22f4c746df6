"""Registered queries: one Spark query per operator, each with an
independent SQL formulation (DuckDB dialect) used as the correctness
oracle on the same parquet tables.

Oracle hygiene (applied identically on both sides): doubles are rounded
to 6 places, money is summed as decimal(18,2) and cast to double, money
averages are exact decimal averages (HALF_UP at 6 places), integer results
are BIGINT, and every top-N has a total order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civiclake.operators import alignment, diversity, engagement, reports, stats
from civiclake.operators.dims import extract_dim
from civiclake.plans import roles

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return deco


def rnd(df: DataFrame, cols: dict[str, int]) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c).cast("double"), n) for c, n in cols.items()})


# ---------------------------------------------------------------- SQL roles
DEP = """dep AS (SELECT c.c_custkey AS id, c.c_name AS nome, c.c_mktsegment AS sigla_partido, n.n_name AS sigla_uf, r.r_name AS regiao
  FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey LEFT JOIN region r ON n.n_regionkey = r.r_regionkey)"""
FRN = "frn AS (SELECT s_suppkey AS id, s_name AS titulo FROM supplier)"
MEM = """mem AS (SELECT DISTINCT l.l_suppkey AS idFrente, o.o_custkey AS id FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)"""
VOT = """vot AS (SELECT CAST(ts AS DATE) AS idVotacao, user_id AS deputado_id, event_type AS tipoVoto, ts AS data_votacao FROM events)"""
EXP = """exp AS (SELECT o.o_custkey AS idDeputado, p.p_type AS tipoDespesa, s.s_name AS nomeFornecedor,
    md5(nullif(trim(s.s_name), '')) AS id_fornecedor, md5(nullif(trim(p.p_type), '')) AS id_categoria,
    l.l_extendedprice AS valor_liquido, CAST(l.l_shipdate AS DATE) AS data_documento
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN part p ON l.l_partkey = p.p_partkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey)"""
CLM = """clm AS (SELECT event_id AS id_despesa, user_id AS idDeputado, event_type AS tipoDespesa, value AS valor_liquido,
    CAST(ts AS DATE) AS data_documento FROM events)"""
LEV = """lev AS (SELECT o_orderkey AS id, o_orderdate AS data_inicio, o_orderpriority AS descricaoTipo, o_orderstatus AS situacao,
    o_custkey AS id_deputado FROM orders)"""
MONEY_SUM = "CAST(sum(CAST(valor_liquido AS DECIMAL(18,2))) AS DOUBLE)"


def exact_avg_sql(expr: str) -> str:
    """Average of a money column as Spark computes avg(decimal(18,2)):
    exact, HALF_UP at 6 places, via integer cents (no float ties)."""
    cents = f"CAST(CAST({expr} AS DECIMAL(18,2)) * 100 AS BIGINT)"
    return (f"(CAST(sign(sum({cents})) * ((abs(sum({cents})) * 20000 + count({cents})) // (2 * count({cents}))) AS DOUBLE)"
            " / 1000000.0)")


MONEY_AVG = exact_avg_sql("valor_liquido")


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


# ------------------------------------------------------------ gold metrics
@register(
    "expense_outliers",
    with_(DEP, CLM, f"""st AS (SELECT tipoDespesa, {MONEY_AVG} AS media, stddev_samp(valor_liquido) AS sd FROM clm GROUP BY tipoDespesa)""",
          """z AS (SELECT c.idDeputado, d.nome, d.sigla_partido, d.sigla_uf, c.tipoDespesa, c.valor_liquido, st.media,
        CASE WHEN st.sd IS NOT NULL AND st.sd > 0 THEN (c.valor_liquido - st.media) / st.sd ELSE 0 END AS z_score, c.data_documento
      FROM clm c LEFT JOIN dep d ON c.idDeputado = d.id LEFT JOIN st ON c.tipoDespesa = st.tipoDespesa)""")
    + """SELECT idDeputado AS deputado_id, nome, sigla_partido, sigla_uf, tipoDespesa, valor_liquido, round(media, 6) AS media,
  round(z_score, 6) AS z_score, data_documento FROM z WHERE abs(z_score) > 3 AND valor_liquido > 0""",
)
def q_expense_outliers(spark: SparkSession, d: str) -> DataFrame:
    """G7 (filter form): z-score by expense type on all claims."""
    return rnd(expense_outliers(spark, d), {"media": 6, "z_score": 6})


def expense_outliers(spark: SparkSession, d: str) -> DataFrame:
    from civiclake.operators.joins import lookup_join

    # statistics and the filter run on the claims alone (as the reference computed its
    # statistics); only the few outlier rows are then labelled with deputy attributes
    out = stats.zscore_filter(roles.claims(spark, d), "valor_liquido", ["tipoDespesa"], money=True)
    out = lookup_join(out, roles.deputies(spark, d), "idDeputado", "id", ["nome", "sigla_partido", "sigla_uf"])
    return out.select(
        F.col("idDeputado").alias("deputado_id"), "nome", "sigla_partido", "sigla_uf", "tipoDespesa", "valor_liquido", "media", "z_score",
        "data_documento",
    ).orderBy(F.abs("z_score").desc(), "deputado_id")


@register(
    "expense_outliers_flag",
    with_(DEP, CLM, """x AS (SELECT c.id_despesa, c.idDeputado AS id_deputado, md5(c.tipoDespesa) AS id_categoria, d.sigla_uf, c.valor_liquido
      FROM clm c LEFT JOIN dep d ON c.idDeputado = d.id)""",
          f"""st AS (SELECT id_categoria, sigla_uf, {MONEY_AVG} AS media, stddev_samp(valor_liquido) AS desvio FROM x GROUP BY ALL)""",
          """z AS (SELECT x.*, st.media, st.desvio, CASE WHEN st.desvio <> 0 THEN (x.valor_liquido - st.media) / st.desvio END AS z_score
      FROM x LEFT JOIN st ON x.id_categoria = st.id_categoria AND x.sigla_uf = st.sigla_uf)""")
    + """SELECT id_despesa, id_deputado, id_categoria, sigla_uf, valor_liquido, round(media, 6) AS media, round(desvio, 6) AS desvio,
  round(z_score, 6) AS z_score, abs(z_score) > 3 AS anomalia FROM z""",
)
def q_expense_outliers_flag(spark: SparkSession, d: str) -> DataFrame:
    """G6 (flag form): stats by (category, state); all rows kept."""
    from civiclake.functions.keys import surrogate_key
    from civiclake.operators.joins import lookup_join

    c = roles.claims(spark, d).select("id_despesa", F.col("idDeputado").alias("id_deputado"),
                                      surrogate_key("tipoDespesa").alias("id_categoria"), "valor_liquido")
    x = lookup_join(c, roles.deputies(spark, d), "id_deputado", "id", ["sigla_uf"])
    out = stats.zscore_flag(x, "valor_liquido", ["id_categoria", "sigla_uf"], money=True)
    out = out.select("id_despesa", "id_deputado", "id_categoria", "sigla_uf", "valor_liquido", "media", "desvio", "z_score", "anomalia")
    return rnd(out, {"media": 6, "desvio": 6, "z_score": 6})


@register(
    "diversity_front",
    with_(DEP, MEM, FRN, "mp AS (SELECT m.idFrente, d.sigla_partido FROM mem m LEFT JOIN dep d ON m.id = d.id)",
          "cnt AS (SELECT idFrente, sigla_partido, count(*) AS qtde_membros FROM mp GROUP BY ALL)",
          "tot AS (SELECT idFrente, sum(qtde_membros) AS total_membros FROM cnt GROUP BY idFrente)",
          """idx AS (SELECT c.idFrente, 1 - sum((c.qtde_membros / t.total_membros) ^ 2) AS indice_diversidade,
        max(t.total_membros) AS total_membros, count(c.sigla_partido) AS qtde_partidos FROM cnt c JOIN tot t ON c.idFrente = t.idFrente
        GROUP BY c.idFrente)""")
    + """SELECT i.idFrente, f.titulo, round(i.indice_diversidade, 6) AS indice_diversidade, i.qtde_partidos,
  CAST(i.total_membros AS BIGINT) AS total_membros FROM idx i LEFT JOIN frn f ON i.idFrente = f.id""",
)
def q_diversity_front(spark: SparkSession, d: str) -> DataFrame:
    """Simpson diversity of parties per front."""
    out = diversity.front_diversity(roles.memberships(spark, d), roles.deputies(spark, d), roles.fronts(spark, d))
    return rnd(out, {"indice_diversidade": 6})


@register(
    "diversity_front_hhi",
    with_(DEP, MEM, "mp AS (SELECT m.idFrente AS id_frente, m.id AS id_deputado, d.sigla_partido FROM mem m LEFT JOIN dep d ON m.id = d.id)",
          "cnt AS (SELECT id_frente, sigla_partido, count(id_deputado) AS qtde FROM mp GROUP BY ALL)",
          "tot AS (SELECT id_frente, sum(qtde) AS total FROM cnt GROUP BY id_frente)")
    + """SELECT c.id_frente, round(1 - sum((c.qtde / t.total) ^ 2), 6) AS indice_diversidade FROM cnt c JOIN tot t ON c.id_frente = t.id_frente
  GROUP BY c.id_frente""",
)
def q_diversity_front_hhi(spark: SparkSession, d: str) -> DataFrame:
    """Herfindahl helper through the Gen-A front diversity."""
    return rnd(diversity.front_diversity_hhi(roles.memberships(spark, d), roles.deputies(spark, d)), {"indice_diversidade": 6})


@register(
    "top_participants",
    with_(MEM) + """SELECT id AS id_deputado, count(DISTINCT idFrente) AS qtde_frentes FROM mem GROUP BY id
  ORDER BY qtde_frentes DESC, id_deputado LIMIT 10""",
)
def q_top_participants(spark: SparkSession, d: str) -> DataFrame:
    """Deputies in the most fronts."""
    return reports.most_active_members(roles.memberships(spark, d), 10)


@register(
    "alignment_front",
    with_(MEM, VOT,
          """fv AS (SELECT m.idFrente, v.idVotacao, v.tipoVoto, count(v.deputado_id) AS qtde FROM vot v JOIN mem m ON v.deputado_id = m.id
        GROUP BY ALL)""",
          "ft AS (SELECT idFrente, idVotacao, sum(qtde) AS total FROM fv GROUP BY ALL)",
          "fp AS (SELECT fv.idFrente, fv.idVotacao, fv.tipoVoto, fv.qtde / ft.total AS prop_frente FROM fv JOIN ft ON fv.idFrente = ft.idFrente AND fv.idVotacao = ft.idVotacao)",
          "hv AS (SELECT idVotacao, tipoVoto, count(deputado_id) AS qtde FROM vot GROUP BY ALL)",
          "ht AS (SELECT idVotacao, sum(qtde) AS total FROM hv GROUP BY ALL)",
          "hp AS (SELECT hv.idVotacao, hv.tipoVoto, hv.qtde / ht.total AS prop_geral FROM hv JOIN ht ON hv.idVotacao = ht.idVotacao)")
    + """SELECT fp.idFrente AS id_frente, round(avg(fp.prop_frente / hp.prop_geral), 6) AS indice_alinhamento_medio
  FROM fp LEFT JOIN hp ON fp.idVotacao = hp.idVotacao AND fp.tipoVoto = hp.tipoVoto GROUP BY fp.idFrente""",
)
def q_alignment_front(spark: SparkSession, d: str) -> DataFrame:
    """Mean front/house option-share ratio per front."""
    return rnd(alignment.relative_alignment(roles.votes(spark, d), roles.membership_rows(spark, d)), {"indice_alinhamento_medio": 6})


@register(
    "supplier_ranking_key",
    with_(EXP, f"per AS (SELECT id_fornecedor, {MONEY_SUM} AS total_recebido FROM exp GROUP BY id_fornecedor)",
          """dim AS (SELECT DISTINCT md5(nullif(trim(nomeFornecedor), '')) AS id_fornecedor, nullif(trim(nomeFornecedor), '') AS nome_fornecedor
        FROM exp WHERE nullif(trim(nomeFornecedor), '') IS NOT NULL)""",
          "top AS (SELECT * FROM per ORDER BY total_recebido DESC, id_fornecedor LIMIT 10)")
    + """SELECT t.id_fornecedor, d.nome_fornecedor, t.total_recebido, false AS cnpj_suspeito FROM top t LEFT JOIN dim d
  ON t.id_fornecedor = d.id_fornecedor""",
)
def q_supplier_ranking_key(spark: SparkSession, d: str) -> DataFrame:
    """Ranking by deterministic supplier key with a label lookup."""
    # every supplier's label, so the ranking alone reads the expenses
    dim = extract_dim(roles.fronts(spark, d), "titulo", "nome_fornecedor", "id_fornecedor")
    return reports.supplier_ranking_by_key(roles.expenses(spark, d), dim, 10)


@register(
    "supplier_ranking_name",
    with_(EXP) + f"""SELECT nomeFornecedor, {MONEY_SUM} AS total_recebido, count(*) AS qtde_transacoes,
  count(DISTINCT idDeputado) AS qtde_deputados_atendidos FROM exp WHERE nomeFornecedor IS NOT NULL GROUP BY nomeFornecedor
  ORDER BY total_recebido DESC, nomeFornecedor LIMIT 50""",
)
def q_supplier_ranking_name(spark: SparkSession, d: str) -> DataFrame:
    """Top-50 suppliers by name."""
    return reports.supplier_ranking_by_name(roles.expenses(spark, d), 50)


@register(
    "weekly_density",
    with_(LEV) + """SELECT CAST(isoyear(CAST(data_inicio AS DATE)) AS BIGINT) AS ano, CAST(week(CAST(data_inicio AS DATE)) AS BIGINT) AS semana,
  count(id) AS qtde_eventos FROM lev GROUP BY ALL""",
)
def q_weekly_density(spark: SparkSession, d: str) -> DataFrame:
    """Events per ISO week."""
    return reports.weekly_density(roles.legislative_events(spark, d))


@register(
    "weekly_density_spine",
    with_(LEV, """c AS (SELECT CAST(date_trunc('week', CAST(data_inicio AS DATE)) AS DATE) AS wk, count(id) AS n FROM lev
        WHERE data_inicio IS NOT NULL GROUP BY 1)""",
          """sp AS (SELECT CAST(unnest(generate_series(CAST(min(wk) AS TIMESTAMP), CAST(max(wk) AS TIMESTAMP), INTERVAL 7 DAY)) AS DATE)
        AS semana_inicio FROM c)""")
    + """SELECT CAST(isoyear(semana_inicio) AS BIGINT) AS ano, CAST(week(semana_inicio) AS BIGINT) AS semana, semana_inicio,
  CAST(coalesce(c.n, 0) AS BIGINT) AS qtde_eventos FROM sp LEFT JOIN c ON sp.semana_inicio = c.wk""",
)
def q_weekly_density_spine(spark: SparkSession, d: str) -> DataFrame:
    """G10 as documented: all weeks of the range, zero-filled."""
    return reports.weekly_density_spine(roles.legislative_events(spark, d))


@register(
    "monthly_frequency",
    with_(LEV) + """SELECT CAST(year(data_inicio) AS BIGINT) AS ano, CAST(month(data_inicio) AS BIGINT) AS mes, count(*) AS qtde_eventos,
  count(DISTINCT descricaoTipo) AS qtde_tipos_eventos FROM lev WHERE data_inicio IS NOT NULL GROUP BY ALL""",
)
def q_monthly_frequency(spark: SparkSession, d: str) -> DataFrame:
    """Events per month."""
    return reports.monthly_events(roles.legislative_events(spark, d))


@register(
    "engagement_minmax",
    with_(VOT, "p AS (SELECT deputado_id AS id_deputado, count(idVotacao) AS n FROM vot GROUP BY 1)",
          "mm AS (SELECT min(n) AS lo, max(n) AS hi FROM p)")
    + """SELECT id_deputado, round(CASE WHEN hi = lo THEN 1.0 ELSE (n - lo) / (hi - lo) END, 6) AS score_engajamento FROM p, mm""",
)
def q_engagement_minmax(spark: SparkSession, d: str) -> DataFrame:
    """Min-max normalised vote counts."""
    return rnd(engagement.vote_engagement_minmax(roles.votes(spark, d)), {"score_engajamento": 6})


@register(
    "engagement_weighted",
    with_(DEP, MEM, VOT, "f AS (SELECT id, count(DISTINCT idFrente) AS qf FROM mem GROUP BY id)",
          "v AS (SELECT deputado_id AS id, count(idVotacao) AS qv FROM vot GROUP BY 1)",
          """e AS (SELECT d.id, d.nome, d.sigla_partido, d.sigla_uf, coalesce(f.qf, 0) AS qtde_frentes, coalesce(v.qv, 0) AS qtde_votacoes
        FROM dep d LEFT JOIN f ON d.id = f.id LEFT JOIN v ON d.id = v.id)""",
          "m AS (SELECT max(qtde_frentes) AS mf, max(qtde_votacoes) AS mv FROM e)")
    + """SELECT id, nome, sigla_partido, sigla_uf, qtde_frentes, qtde_votacoes,
  round(CASE WHEN mf > 0 THEN qtde_frentes / mf * 40 ELSE 0 END + CASE WHEN mv > 0 THEN qtde_votacoes / mv * 60 ELSE 0 END, 6)
  AS score_engajamento FROM e, m""",
)
def q_engagement_weighted(spark: SparkSession, d: str) -> DataFrame:
    """40/60 weighted fronts + votes score for every deputy."""
    out = engagement.weighted_engagement(roles.deputies(spark, d), roles.memberships(spark, d), roles.votes(spark, d))
    return rnd(out, {"score_engajamento": 6})


@register(
    "spend_by_type",
    with_(EXP) + f"""SELECT tipoDespesa, {MONEY_SUM} AS total_gasto, {MONEY_AVG} AS media_gasto, count(*) AS qtde_transacoes,
  count(DISTINCT idDeputado) AS qtde_deputados FROM exp GROUP BY tipoDespesa""",
)
def q_spend_by_type(spark: SparkSession, d: str) -> DataFrame:
    """G14."""
    return reports.spend_by_type(roles.expenses(spark, d))


@register(
    "spend_by_deputy",
    with_(DEP, EXP, f"""per AS (SELECT idDeputado AS deputado_id, {MONEY_SUM} AS total_gasto, {MONEY_AVG} AS media_gasto,
        count(*) AS qtde_despesas FROM exp GROUP BY idDeputado)""")
    + """SELECT p.deputado_id, d.nome, d.sigla_partido, d.sigla_uf, p.total_gasto, p.media_gasto, p.qtde_despesas
  FROM per p LEFT JOIN dep d ON p.deputado_id = d.id""",
)
def q_spend_by_deputy(spark: SparkSession, d: str) -> DataFrame:
    """G15."""
    return reports.spend_by_deputy(roles.expenses(spark, d), roles.deputies(spark, d))


@register(
    "spend_by_state",
    with_(DEP, EXP) + f"""SELECT d.sigla_uf, {MONEY_SUM} AS total_gasto, {MONEY_AVG} AS media_gasto, count(*) AS qtde_despesas,
  count(DISTINCT e.idDeputado) AS qtde_deputados FROM exp e LEFT JOIN dep d ON e.idDeputado = d.id GROUP BY d.sigla_uf""",
)
def q_spend_by_state(spark: SparkSession, d: str) -> DataFrame:
    """G16."""
    return reports.spend_by_state(roles.expenses(spark, d), roles.deputies(spark, d))


@register(
    "share_by_type",
    with_(EXP, f"per AS (SELECT tipoDespesa, {MONEY_SUM} AS total_gasto FROM exp GROUP BY tipoDespesa)",
          f"g AS (SELECT {MONEY_SUM} AS grand FROM exp)")
    + """SELECT tipoDespesa, total_gasto, round(total_gasto / grand, 6) AS participacao FROM per, g
  ORDER BY total_gasto DESC, tipoDespesa LIMIT 10""",
)
def q_share_by_type(spark: SparkSession, d: str) -> DataFrame:
    """Share of the grand total, top 10 types."""
    return rnd(reports.share_by_type(roles.expenses(spark, d), 10), {"participacao": 6})


@register(
    "vote_patterns",
    with_(VOT) + """SELECT tipoVoto, count(*) AS qtde_votos, count(DISTINCT deputado_id) AS qtde_deputados,
  count(DISTINCT idVotacao) AS qtde_votacoes FROM vot GROUP BY tipoVoto""",
)
def q_vote_patterns(spark: SparkSession, d: str) -> DataFrame:
    """G17."""
    return reports.vote_patterns(roles.votes(spark, d))


@register(
    "top_event_types",
    with_(LEV) + """SELECT descricaoTipo, count(*) AS qtde_eventos FROM lev GROUP BY descricaoTipo
  ORDER BY qtde_eventos DESC, descricaoTipo LIMIT 10""",
)
def q_top_event_types(spark: SparkSession, d: str) -> DataFrame:
    """G20."""
    return reports.top_event_types(roles.legislative_events(spark, d), 10)


@register(
    "recent_events",
    with_(LEV) + """SELECT id, data_inicio, descricaoTipo, situacao FROM lev ORDER BY data_inicio DESC NULLS LAST, id LIMIT 20""",
)
def q_recent_events(spark: SparkSession, d: str) -> DataFrame:
    """G21."""
    return reports.recent_events(roles.legislative_events(spark, d), 20)


@register(
    "grand_totals",
    with_(LEV, EXP) + f"""SELECT (SELECT count(*) FROM lev) AS total_eventos, (SELECT {MONEY_SUM} FROM exp) AS total_despesas""",
)
def q_grand_totals(spark: SparkSession, d: str) -> DataFrame:
    """G18."""
    return reports.grand_totals(roles.legislative_events(spark, d), roles.expenses(spark, d))


# ------------------------------------------------------- keys, dedup, SCD2
from civiclake.functions import clean as clean_fn  # noqa: E402
from civiclake.functions import dates as date_fn  # noqa: E402
from civiclake.functions.keys import surrogate_key  # noqa: E402
from civiclake.operators import dedup, quality, scd2  # noqa: E402
from civiclake.operators.joins import dimension_lookup, lookup_join  # noqa: E402

LI_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
           "l_returnflag", "l_linestatus", "l_shipdate"]


@register(
    "dedup_keep_latest",
    """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC NULLS LAST,
  l_partkey DESC NULLS LAST, l_suppkey DESC NULLS LAST, l_quantity DESC NULLS LAST, l_extendedprice DESC NULLS LAST,
  l_discount DESC NULLS LAST, l_tax DESC NULLS LAST, l_returnflag DESC NULLS LAST, l_linestatus DESC NULLS LAST) AS rn FROM lineitem)
  WHERE rn = 1""",
)
def q_dedup_keep_latest(spark: SparkSession, d: str) -> DataFrame:
    """One row per (order, line number), latest ship date; full-row tiebreak."""
    return dedup.keep_latest(roles.table(spark, d, "lineitem").select(*LI_COLS), ["l_orderkey", "l_linenumber"], ["l_shipdate"])


@register(
    "dup_keys",
    """SELECT l_orderkey, l_linenumber, count(*) AS qtde FROM lineitem GROUP BY ALL HAVING count(*) > 1""",
)
def q_dup_keys(spark: SparkSession, d: str) -> DataFrame:
    """Q1: duplicated natural keys."""
    return quality.duplicate_keys(roles.table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@register(
    "surrogate_key",
    """SELECT DISTINCT p_brand, p_type, md5(to_json({'p_brand': p_brand, 'p_type': p_type})) AS chave_marca_tipo,
  md5(p_type) AS chave_tipo FROM part""",
)
def q_surrogate_key(spark: SparkSession, d: str) -> DataFrame:
    """K3: deterministic single and composite keys."""
    p = roles.table(spark, d, "part").select("p_brand", "p_type").distinct()
    return p.select("p_brand", "p_type", surrogate_key("p_brand", "p_type").alias("chave_marca_tipo"),
                    surrogate_key("p_type").alias("chave_tipo"))


@register(
    "extract_dim",
    with_(EXP) + """SELECT DISTINCT md5(nullif(trim(tipoDespesa), '')) AS id_categoria, nullif(trim(tipoDespesa), '') AS categoria FROM exp
  WHERE nullif(trim(tipoDespesa), '') IS NOT NULL""",
)
def q_extract_dim(spark: SparkSession, d: str) -> DataFrame:
    """K4: category dimension extracted from the expense fact."""
    return extract_dim(roles.expenses(spark, d), "tipoDespesa", "categoria", "id_categoria")


@register(
    "star_lookup",
    with_(EXP, """dc AS (SELECT DISTINCT md5(nullif(trim(tipoDespesa), '')) AS id_categoria, nullif(trim(tipoDespesa), '') AS categoria FROM exp
        WHERE nullif(trim(tipoDespesa), '') IS NOT NULL)""",
          """df AS (SELECT DISTINCT md5(nullif(trim(nomeFornecedor), '')) AS id_fornecedor, nullif(trim(nomeFornecedor), '') AS nome_fornecedor
        FROM exp WHERE nullif(trim(nomeFornecedor), '') IS NOT NULL)""")
    + """SELECT e.idDeputado, e.data_documento, e.valor_liquido, e.id_categoria, dc.categoria, e.id_fornecedor, df.nome_fornecedor
  FROM exp e LEFT JOIN dc ON e.id_categoria = dc.id_categoria LEFT JOIN df ON e.id_fornecedor = df.id_fornecedor""",
)
def q_star_lookup(spark: SparkSession, d: str) -> DataFrame:
    """Fact keys resolve in both dimensions (labels attached by key)."""
    # all types and suppliers, so the expenses are read once
    dc = extract_dim(roles.table(spark, d, "part"), "p_type", "categoria", "id_categoria")
    df_ = extract_dim(roles.fronts(spark, d), "titulo", "nome_fornecedor", "id_fornecedor")
    x = dimension_lookup(roles.expenses(spark, d), dc, "id_categoria", columns=["categoria"])
    x = dimension_lookup(x, df_, "id_fornecedor", columns=["nome_fornecedor"])
    return x.select("idDeputado", "data_documento", "valor_liquido", "id_categoria", "categoria", "id_fornecedor", "nome_fornecedor")


PRIO_LOG = "lg AS (SELECT o_custkey AS id, o_orderdate AS ts, o_orderkey AS tb, o_orderpriority AS prioridade FROM orders {where})"
SCD2_SQL = """p_{n} AS (SELECT *, lag(prioridade) OVER (PARTITION BY id ORDER BY ts, tb) AS prev,
      row_number() OVER (PARTITION BY id ORDER BY ts, tb) AS rn FROM {src}),
  c_{n} AS (SELECT * FROM p_{n} WHERE rn = 1 OR prev IS DISTINCT FROM prioridade),
  v_{n} AS (SELECT id, prioridade, ts AS valid_from, lead(ts) OVER (PARTITION BY id ORDER BY ts, tb) AS valid_to FROM c_{n})"""


def _prio_log(spark: SparkSession, d: str) -> DataFrame:
    return roles.table(spark, d, "orders").select(
        F.col("o_custkey").alias("id"), F.col("o_orderdate").alias("ts"), F.col("o_orderkey").alias("tb"),
        F.col("o_orderpriority").alias("prioridade"),
    )


@register(
    "scd2_from_log",
    with_(PRIO_LOG.format(where=""), SCD2_SQL.format(n=1, src="lg"))
    + "SELECT id, prioridade, valid_from, valid_to, valid_to IS NULL AS is_current FROM v_1",
)
def q_scd2_from_log(spark: SparkSession, d: str) -> DataFrame:
    """Priority history per customer from the order log."""
    return scd2.scd2_from_log(_prio_log(spark, d), "id", "ts", ["prioridade"], ["tb"])


MERGE_CUTOFF = "1998-01-01 00:00:00"
MERGE_AS_OF = "2002-01-01 00:00:00"


@register(
    "scd2_merge",
    with_(PRIO_LOG.format(where=f"WHERE o_orderdate < TIMESTAMP '{MERGE_CUTOFF}'"), SCD2_SQL.format(n=1, src="lg"),
          "h AS (SELECT id, prioridade, valid_from, valid_to, valid_to IS NULL AS is_current FROM v_1)",
          """s AS (SELECT o_custkey AS id, o_orderpriority AS prioridade FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey
        ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1)""",
          "cur AS (SELECT * FROM h WHERE is_current)")
    + f"""SELECT * FROM h WHERE NOT is_current
UNION ALL SELECT cur.id, cur.prioridade, cur.valid_from, NULL, true FROM cur LEFT JOIN s ON cur.id = s.id
  WHERE s.id IS NULL OR s.prioridade IS NOT DISTINCT FROM cur.prioridade
UNION ALL SELECT cur.id, cur.prioridade, cur.valid_from, TIMESTAMP '{MERGE_AS_OF}', false FROM cur JOIN s ON cur.id = s.id
  WHERE s.prioridade IS DISTINCT FROM cur.prioridade
UNION ALL SELECT s.id, s.prioridade, TIMESTAMP '{MERGE_AS_OF}', NULL, true FROM s LEFT JOIN cur ON cur.id = s.id
  WHERE cur.id IS NULL OR s.prioridade IS DISTINCT FROM cur.prioridade""",
)
def q_scd2_merge(spark: SparkSession, d: str) -> DataFrame:
    """History up to the cut-off merged with the latest snapshot."""
    log = _prio_log(spark, d)
    hist = scd2.scd2_from_log(log.where(F.col("ts") < F.lit(MERGE_CUTOFF).cast("timestamp_ntz")), "id", "ts", ["prioridade"], ["tb"])
    snap = dedup.keep_latest(log, ["id"], ["ts", "tb"]).select("id", "prioridade")
    return scd2.scd2_merge(hist, snap, "id", ["prioridade"], MERGE_AS_OF)


@register(
    "as_was_join",
    with_(PRIO_LOG.format(where=""), SCD2_SQL.format(n=1, src="lg"),
          """f AS (SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, o.o_custkey, l.l_shipdate FROM lineitem l
        JOIN orders o ON l.l_orderkey = o.o_orderkey)""")
    + """SELECT f.*, v.prioridade, v.valid_from FROM f LEFT JOIN v_1 v ON f.o_custkey = v.id AND v.valid_from <= f.l_shipdate
  AND (f.l_shipdate < v.valid_to OR v.valid_to IS NULL)""",
)
def q_as_was_join(spark: SparkSession, d: str) -> DataFrame:
    """K7: each line item with its customer's priority as it was at ship date."""
    versions = scd2.scd2_from_log(_prio_log(spark, d), "id", "ts", ["prioridade"], ["tb"])
    li = roles.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")
    facts = lookup_join(li, roles.table(spark, d, "orders"), "l_orderkey", "o_orderkey", ["o_custkey"], how="inner").select(
        "l_orderkey", "l_linenumber", "l_partkey", "o_custkey", "l_shipdate"
    )
    return scd2.as_was_join(facts, versions, "o_custkey", "l_shipdate", ["l_orderkey", "l_linenumber", "l_partkey"], "id", ["prioridade"])


@register(
    "status_durations",
    """SELECT o_custkey AS id, o_orderkey, o_orderpriority AS situacao, o_orderdate AS inicio,
  lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS fim,
  date_diff('day', o_orderdate, lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)) AS dias FROM orders""",
)
def q_status_durations(spark: SparkSession, d: str) -> DataFrame:
    """How long each status lasted until the entity's next status event."""
    from civiclake.operators.sequence import previous_row

    o = roles.table(spark, d, "orders").select(
        F.col("o_custkey").alias("id"), "o_orderkey", F.col("o_orderpriority").alias("situacao"), F.col("o_orderdate").alias("inicio")
    )
    nxt = previous_row(o, "id", ["inicio", "o_orderkey"], ["inicio"], prefix="fim_", ascending=False)
    return nxt.select("id", "o_orderkey", "situacao", "inicio", F.col("fim_inicio").alias("fim"),
                      F.datediff(F.col("fim_inicio"), F.col("inicio")).cast("bigint").alias("dias"))


# ------------------------------------------------------- cleaning and parsing
@register(
    "json_field",
    "SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events",
)
def q_json_field(spark: SparkSession, d: str) -> DataFrame:
    """Field of a JSON text column (spaced or compact)."""
    e = roles.table(spark, d, "events")
    return e.select("event_id", clean_fn.json_field("props", "k", "bigint").alias("k"))


@register(
    "clean_text",
    """SELECT p_partkey, nullif(trim(concat('  ', lower(p_type), ' ')), '') AS tipo_limpo,
  upper(nullif(trim(concat('  ', lower(p_type), ' ')), '')) AS tipo_padronizado, nullif(trim(p_name), '') AS nome_limpo,
  nullif(trim(replace(p_brand, 'Brand#', ' ')), '') AS marca FROM part""",
)
def q_clean_text(spark: SparkSession, d: str) -> DataFrame:
    """Trim, empty -> NULL, upper-case standardisation."""
    p = roles.table(spark, d, "part")
    padded = F.concat(F.lit("  "), F.lower("p_type"), F.lit(" "))
    return p.select(
        "p_partkey",
        clean_fn.clean_text(padded).alias("tipo_limpo"),
        clean_fn.clean_upper(padded).alias("tipo_padronizado"),
        clean_fn.clean_text("p_name").alias("nome_limpo"),
        clean_fn.clean_text(F.replace(F.col("p_brand"), F.lit("Brand#"), F.lit(" "))).alias("marca"),
    )


@register(
    "date_parts",
    """SELECT l.l_orderkey, l.l_linenumber, CAST(year(l.l_shipdate) AS BIGINT) AS ano, CAST(month(l.l_shipdate) AS BIGINT) AS mes,
  CAST(day(l.l_shipdate) AS BIGINT) AS dia, strftime(l.l_shipdate, '%Y-%m') AS ano_mes,
  CAST(isoyear(l.l_shipdate) AS BIGINT) AS iso_ano, CAST(week(l.l_shipdate) AS BIGINT) AS iso_semana,
  CAST(year(l.l_shipdate) AS BIGINT) AS ano_legado, CAST(l.l_shipdate AS DATE) AS data_envio,
  round(date_diff('second', o.o_orderdate, l.l_shipdate) / 3600.0, 6) AS duracao_horas
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""",
)
def q_date_parts(spark: SparkSession, d: str) -> DataFrame:
    """Date parsing, parts, month label, ISO week, durations."""
    li = roles.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    x = lookup_join(li, roles.table(spark, d, "orders"), "l_orderkey", "o_orderkey", ["o_orderdate"], how="inner")
    ship = F.col("l_shipdate")
    iso_y, iso_w = date_fn.iso_week(ship)
    leg_y, _ = date_fn.iso_week(ship, legacy_year=True)
    return x.select(
        "l_orderkey", "l_linenumber",
        F.year(ship).cast("bigint").alias("ano"), F.month(ship).cast("bigint").alias("mes"), F.dayofmonth(ship).cast("bigint").alias("dia"),
        date_fn.month_label(ship).alias("ano_mes"),
        iso_y.cast("bigint").alias("iso_ano"), iso_w.cast("bigint").alias("iso_semana"), leg_y.cast("bigint").alias("ano_legado"),
        clean_fn.to_date_safe(ship.cast("string")).alias("data_envio"),
        F.round(date_fn.duration_hours("o_orderdate", "l_shipdate"), 6).alias("duracao_horas"),
    )


# ------------------------------------------------------------ data quality
@register(
    "nonneg_split",
    "SELECT c_custkey, c_acctbal, (c_acctbal IS NULL OR c_acctbal >= 0) AS aceito FROM customer",
)
def q_nonneg_split(spark: SparkSession, d: str) -> DataFrame:
    """Q3: accepted and rejected rows of the non-negativity rule, labelled."""
    c = roles.table(spark, d, "customer").select("c_custkey", "c_acctbal")
    ok, bad = quality.split_non_negative(c, "c_acctbal")
    return ok.withColumn("aceito", F.lit(True)).unionByName(bad.withColumn("aceito", F.lit(False)))


@register(
    "fk_orphans",
    with_(EXP, DEP) + """SELECT idDeputado, count(*) AS qtde FROM exp WHERE idDeputado IS NOT NULL
  AND idDeputado NOT IN (SELECT id FROM dep WHERE id IS NOT NULL) GROUP BY idDeputado""",
)
def q_fk_orphans(spark: SparkSession, d: str) -> DataFrame:
    """Q2: expense deputies missing from the deputy dimension (none in consistent data)."""
    return quality.orphans(roles.expenses(spark, d), roles.deputies(spark, d), "idDeputado", "id")


@register(
    "pending_parents",
    with_(DEP, VOT) + "SELECT DISTINCT id FROM dep WHERE id NOT IN (SELECT deputado_id FROM vot WHERE deputado_id IS NOT NULL)",
)
def q_pending_parents(spark: SparkSession, d: str) -> DataFrame:
    """Deputies whose vote pages have not landed (distributed work list)."""
    v = roles.votes(spark, d).select(F.col("deputado_id").alias("id"))
    return quality.pending_parents(roles.deputies(spark, d), v, "id")


@register(
    "null_profile",
    "UNPIVOT (SELECT " + ", ".join(f"count(*) FILTER (WHERE {c} IS NULL) AS {c}" for c in LI_COLS)
    + ", count(*) AS total FROM lineitem) ON " + ", ".join(LI_COLS) + " INTO NAME coluna VALUE nulos",
)
def q_null_profile(spark: SparkSession, d: str) -> DataFrame:
    """Q4: NULL count per column in one pass."""
    return quality.null_profile(roles.table(spark, d, "lineitem"), LI_COLS)


@register(
    "fk_orphans_orders",
    """SELECT o_orderkey, count(*) AS qtde FROM orders WHERE o_orderkey IS NOT NULL
  AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_orderkey IS NOT NULL) GROUP BY o_orderkey""",
)
def q_fk_orphans_orders(spark: SparkSession, d: str) -> DataFrame:
    """Q2 where there are orphans: orders without a line item."""
    return quality.orphans(roles.table(spark, d, "orders"), roles.table(spark, d, "lineitem"), "o_orderkey", "l_orderkey")


# ------------------------------------------------------------ extensions
from civiclake.operators import events as events_op  # noqa: E402

PARTIES = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]  # fixed TPC-H market segments
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]  # fixed TPC-H order priorities


@register(
    "event_fact",
    """WITH li AS (SELECT l_orderkey, max(l_shipdate) AS fim, count(*) AS n FROM lineitem GROUP BY l_orderkey)
SELECT o.o_orderkey AS id_evento, md5(CAST(CAST(o.o_orderdate AS DATE) AS VARCHAR)) AS id_data,
  md5(nullif(trim(o.o_orderpriority), '')) AS id_tipo_evento, round(date_diff('second', o.o_orderdate, li.fim) / 3600.0, 6) AS duracao_horas,
  CAST(li.n AS INTEGER) AS qtde_presencas FROM orders o LEFT JOIN li ON o.o_orderkey = li.l_orderkey""",
)
def q_event_fact(spark: SparkSession, d: str) -> DataFrame:
    """Event fact with duration and attendance (line items per order)."""
    li = roles.table(spark, d, "lineitem").groupBy("l_orderkey").agg(
        F.max("l_shipdate").alias("data_fim"), F.count(F.lit(1)).alias("qtde")
    )
    ev = lookup_join(roles.legislative_events(spark, d), li, "id", "l_orderkey", ["data_fim", "qtde"])
    return rnd(events_op.event_fact(ev, presence="qtde"), {"duracao_horas": 6})


EVENT_FACT_COLS = ["id_evento", "id_data", "id_tipo_evento", "duracao_horas", "qtde_presencas"]


@register(
    "null_profile_event_fact",
    "UNPIVOT (SELECT " + ", ".join(f"count(*) FILTER (WHERE {c} IS NULL) AS {c}" for c in EVENT_FACT_COLS)
    + ", count(*) AS total FROM (" + SQL["event_fact"] + ")) ON " + ", ".join(EVENT_FACT_COLS) + " INTO NAME coluna VALUE nulos",
)
def q_null_profile_event_fact(spark: SparkSession, d: str) -> DataFrame:
    """Q4 where there are NULLs: events without an end or an attendance list."""
    return quality.null_profile(q_event_fact(spark, d), EVENT_FACT_COLS)


@register(
    "presence_rate",
    """SELECT role, count(DISTINCT conv_id) AS qtde_eventos,
  count(DISTINCT conv_id) / (SELECT count(DISTINCT conv_id) FROM conversations) AS taxa_presenca FROM conversations GROUP BY role""",
)
def q_presence_rate(spark: SparkSession, d: str) -> DataFrame:
    """Attendance share per attendee (conversation = event, role = attendee)."""
    c = roles.table(spark, d, "conversations").select("conv_id", "role")
    return rnd(events_op.presence_rate(c, "conv_id", "role"), {"taxa_presenca": 6})


@register(
    "presence_rate_by_type",
    """WITH a AS (SELECT DISTINCT CAST(ts AS DATE) AS dia, user_id, event_type FROM events), t AS (SELECT event_type, count(DISTINCT dia) AS n FROM a GROUP BY 1)
SELECT user_id, event_type, count(*) AS qtde_eventos, round(count(*) / any_value(n), 6) AS taxa_presenca FROM a JOIN t USING (event_type) GROUP BY 1, 2""",
)
def q_presence_rate_by_type(spark: SparkSession, d: str) -> DataFrame:
    """X2 as documented: attendance share per attendee and event type (day = event)."""
    e = roles.table(spark, d, "events").select(F.to_date("ts").alias("dia"), "user_id", "event_type")
    return rnd(events_op.presence_rate(e, "dia", "user_id", "event_type"), {"taxa_presenca": 6})


@register(
    "front_atlas_legislature",
    with_(DEP, MEM) + """SELECT m.idFrente, f.s_name AS titulo, m.id AS id_deputado, d.nome, d.sigla_partido, d.sigla_uf, d.regiao, f.s_nationkey AS idLegislatura
  FROM mem m LEFT JOIN supplier f ON m.idFrente = f.s_suppkey LEFT JOIN dep d ON m.id = d.id""",
)
def q_front_atlas_legislature(spark: SparkSession, d: str) -> DataFrame:
    """X1 as documented: the atlas with the front's legislature."""
    fronts = roles.table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("titulo"), F.col("s_nationkey").alias("idLegislatura"))
    return events_op.front_atlas(roles.memberships(spark, d), fronts, roles.deputies(spark, d, region=True))


@register(
    "front_atlas",
    with_(DEP, MEM, FRN) + """SELECT m.idFrente, f.titulo, m.id AS id_deputado, d.nome, d.sigla_partido, d.sigla_uf, d.regiao
  FROM mem m LEFT JOIN frn f ON m.idFrente = f.id LEFT JOIN dep d ON m.id = d.id""",
)
def q_front_atlas(spark: SparkSession, d: str) -> DataFrame:
    """Members of each front with party, state and region."""
    return events_op.front_atlas(roles.memberships(spark, d), roles.fronts(spark, d), roles.deputies(spark, d, region=True))


@register(
    "alignment_matrix",
    with_(DEP, MEM, VOT,
          "md AS (SELECT m.idFrente, m.id, d.sigla_partido FROM mem m LEFT JOIN dep d ON m.id = d.id)",
          """sv AS (SELECT md.idFrente, md.sigla_partido, v.idVotacao, v.tipoVoto, count(v.deputado_id) AS qtde FROM vot v
        JOIN md ON v.deputado_id = md.id GROUP BY ALL)""",
          """sp AS (SELECT *, qtde / sum(qtde) OVER (PARTITION BY idFrente, sigla_partido, idVotacao) AS prop_sub FROM sv)""",
          "hv AS (SELECT idVotacao, tipoVoto, count(deputado_id) AS qtde FROM vot GROUP BY ALL)",
          "hp AS (SELECT idVotacao, tipoVoto, qtde / sum(qtde) OVER (PARTITION BY idVotacao) AS prop_geral FROM hv)",
          """r AS (SELECT sp.idFrente, sp.sigla_partido, sp.prop_sub / hp.prop_geral AS r FROM sp LEFT JOIN hp
        ON sp.idVotacao = hp.idVotacao AND sp.tipoVoto = hp.tipoVoto)""")
    + "SELECT idFrente AS id_frente, "
    + ", ".join(f"round(avg(CASE WHEN sigla_partido = '{p}' THEN r END), 6) AS {p}" for p in PARTIES)
    + " FROM r GROUP BY idFrente",
)
def q_alignment_matrix(spark: SparkSession, d: str) -> DataFrame:
    """Front x party alignment with the house, pivoted by party."""
    out = alignment.alignment_matrix(roles.votes(spark, d), roles.membership_rows(spark, d), roles.deputies(spark, d), PARTIES)
    return rnd(out, {p: 6 for p in PARTIES})


@register(
    "week_heatmap",
    with_(LEV) + "SELECT CAST(isoyear(CAST(data_inicio AS DATE)) AS BIGINT) AS ano, CAST(week(CAST(data_inicio AS DATE)) AS BIGINT) AS semana, "
    + ", ".join(f"count(*) FILTER (WHERE descricaoTipo = '{p}') AS \"{p}\"" for p in PRIORITIES)
    + " FROM lev WHERE data_inicio IS NOT NULL GROUP BY ALL",
)
def q_week_heatmap(spark: SparkSession, d: str) -> DataFrame:
    """ISO week x event type counts."""
    return reports.week_heatmap(roles.legislative_events(spark, d), PRIORITIES)


@register(
    "week_counts",
    with_(LEV) + """SELECT CAST(isoyear(CAST(data_inicio AS DATE)) AS BIGINT) AS ano, CAST(week(CAST(data_inicio AS DATE)) AS BIGINT) AS semana,
  descricaoTipo AS tipo, count(*) AS qtde_eventos FROM lev WHERE data_inicio IS NOT NULL GROUP BY ALL""",
)
def q_week_counts(spark: SparkSession, d: str) -> DataFrame:
    """X5 in long form: ISO week x event type counts (no value list needed)."""
    return reports.week_counts(roles.legislative_events(spark, d), "descricaoTipo", out="tipo")


@register(
    "engagement_trend",
    with_(LEV, """m AS (SELECT id_deputado, CAST(year(data_inicio) AS BIGINT) AS ano, CAST(month(data_inicio) AS BIGINT) AS mes,
        count(*) AS qtde_atividades FROM lev GROUP BY ALL)""")
    + """SELECT *, lag(qtde_atividades) OVER (PARTITION BY id_deputado ORDER BY ano, mes) AS qtde_anterior,
  qtde_atividades - lag(qtde_atividades) OVER (PARTITION BY id_deputado ORDER BY ano, mes) AS variacao FROM m""",
)
def q_engagement_trend(spark: SparkSession, d: str) -> DataFrame:
    """Monthly activity per deputy with month-over-month change."""
    return engagement.engagement_trend(roles.legislative_events(spark, d), "id_deputado", "data_inicio")


FEED_CUTOFF = "2024-01-16"


def _zsql(name: str, where: str) -> str:
    return f"""{name}_c AS (SELECT * FROM clm {where}),
  {name}_s AS (SELECT tipoDespesa, {MONEY_AVG} AS media, stddev_samp(valor_liquido) AS sd FROM {name}_c GROUP BY tipoDespesa),
  {name} AS (SELECT c.*, CASE WHEN s.sd IS NOT NULL AND s.sd > 0 THEN (c.valor_liquido - s.media) / s.sd ELSE 0 END AS z_score
    FROM {name}_c c LEFT JOIN {name}_s s ON c.tipoDespesa = s.tipoDespesa)"""


@register(
    "anomaly_feed",
    with_(CLM, _zsql("cur", ""), _zsql("prev", f"WHERE data_documento < DATE '{FEED_CUTOFF}'"))
    + """SELECT id_despesa, idDeputado, tipoDespesa, valor_liquido, round(z_score, 6) AS z_score, data_documento FROM cur
  WHERE abs(z_score) > 3 AND valor_liquido > 0 AND id_despesa NOT IN
  (SELECT id_despesa FROM prev WHERE abs(z_score) > 3 AND valor_liquido > 0)""",
)
def q_anomaly_feed(spark: SparkSession, d: str) -> DataFrame:
    """Anomalies flagged now that were not flagged by the previous run."""
    c = roles.claims(spark, d)
    cur = stats.zscore_filter(c, "valor_liquido", ["tipoDespesa"], money=True)
    prev = stats.zscore_filter(c.where(F.col("data_documento") < F.lit(FEED_CUTOFF).cast("date")), "valor_liquido", ["tipoDespesa"],
                               money=True)
    out = quality.new_rows(cur, prev, ["id_despesa"])
    return rnd(out.select("id_despesa", "idDeputado", "tipoDespesa", "valor_liquido", "z_score", "data_documento"), {"z_score": 6})


# ---------------------------------------------------- layer totals, report SQL
def _layers(spark: SparkSession, d: str) -> dict[str, dict[str, DataFrame]]:
    return {
        "bronze": {t: roles.table(spark, d, t) for t in ["customer", "supplier", "orders", "lineitem", "events"]},
        "silver": {
            "dim_deputados": roles.deputies(spark, d), "dim_frentes": roles.fronts(spark, d),
            "fact_frentes_membros": roles.memberships(spark, d), "fact_votacoes": roles.votes(spark, d),
            "fact_despesas": roles.expenses(spark, d), "fact_eventos": roles.legislative_events(spark, d),
        },
        "gold": {
            "despesas_por_tipo": reports.spend_by_type(roles.expenses(spark, d)),
            "padroes_votacao": reports.vote_patterns(roles.votes(spark, d)),
            "eventos_por_mes": reports.monthly_events(roles.legislative_events(spark, d)),
            "ranking_fornecedores": reports.supplier_ranking_by_name(roles.expenses(spark, d), 50),
        },
    }


@register(
    "layer_totals",
    " UNION ALL ".join(
        f"SELECT '{layer}' AS camada, CAST(sum(c) AS BIGINT) AS total_linhas FROM (" + " UNION ALL ".join(qs) + ")"
        for layer, qs in {
            "bronze": [f"SELECT count(*) AS c FROM {t}" for t in ["customer", "supplier", "orders", "lineitem", "events"]],
            "silver": [f"SELECT count(*) AS c FROM ({with_(cte)} SELECT * FROM {n})" for cte, n in
                       [(DEP, "dep"), (FRN, "frn"), (MEM, "mem"), (VOT, "vot"), (EXP, "exp"), (LEV, "lev")]],
            "gold": [f"SELECT count(*) AS c FROM ({SQL[q]})" for q in ["spend_by_type", "vote_patterns", "monthly_frequency",
                                                                        "supplier_ranking_name"]],
        }.items()
    ),
)
def q_layer_totals(spark: SparkSession, d: str) -> DataFrame:
    """Row totals per layer from one union of one-row aggregates."""
    return quality.layer_totals(_layers(spark, d))


@register(
    "report_top_engaged",
    f"SELECT * FROM ({SQL['engagement_weighted']}) ORDER BY score_engajamento DESC, id LIMIT 10",
)
def q_report_top_engaged(spark: SparkSession, d: str) -> DataFrame:
    """Validation SQL over the gold engagement table."""
    eng = q_engagement_weighted(spark, d)
    return spark.sql("SELECT * FROM {eng} ORDER BY score_engajamento DESC, id LIMIT 10", eng=eng)


@register(
    "report_top_anomalies",
    f"""SELECT * FROM ({SQL['expense_outliers']}) WHERE abs(z_score) > 3
  ORDER BY z_score DESC, deputado_id, data_documento, tipoDespesa, valor_liquido LIMIT 10""",
)
def q_report_top_anomalies(spark: SparkSession, d: str) -> DataFrame:
    """Validation SQL over the gold anomaly table."""
    anom = q_expense_outliers(spark, d)
    return spark.sql(
        "SELECT * FROM {anom} WHERE abs(z_score) > 3 ORDER BY z_score DESC, deputado_id, data_documento, tipoDespesa, valor_liquido LIMIT 10",
        anom=anom,
    )


@register(
    "report_front_labels",
    f"""WITH {FRN} SELECT fr.id AS id_frente, fr.titulo, d.indice_diversidade FROM ({SQL['diversity_front_hhi']}) d
  JOIN frn fr ON fr.id = d.id_frente ORDER BY d.indice_diversidade DESC, id_frente LIMIT 20""",
)
def q_report_front_labels(spark: SparkSession, d: str) -> DataFrame:
    """Front label lookup in the dashboard SQL (inner join + sort + limit 20)."""
    div = q_diversity_front_hhi(spark, d)
    fr = roles.fronts(spark, d)
    return spark.sql(
        """SELECT fr.id AS id_frente, fr.titulo, d.indice_diversidade FROM {div} d JOIN {fr} fr ON fr.id = d.id_frente
           ORDER BY d.indice_diversidade DESC, id_frente LIMIT 20""",
        div=div, fr=fr,
    )
