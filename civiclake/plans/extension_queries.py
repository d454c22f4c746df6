"""Registered queries of the operators that keep state between runs or merge it: stored statistics,
cells and bitmaps, keyed upserts, runs compared with runs, life-cycles, bucket digests.

Each derives its landings, runs or parts from the driver tables; its SQL
oracle computes the same rows directly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civiclake.operators import alignment, distinct, engagement, lifecycle, moments, reconcile, stats
from civiclake.operators.joins import lookup_join
from civiclake.plans import roles, runs
from civiclake.plans.registry import CLM, DEP, LEV, MEM, SQL, VOT, _zsql, register, rnd, with_
from civiclake.schemas import BronzeSpec
from civiclake.session import Scratch, materialize, shared_dir
from civiclake.sinks.published import publish, read_published
from civiclake.sources.tables import of_type


@register("expense_outliers_merged", SQL["expense_outliers"])
def q_expense_outliers_merged(spark: SparkSession, d: str) -> DataFrame:
    """G7 from stored moments: one state a type and day, merged."""
    c = roles.claims(spark, d).withColumn("dia", F.date_format("data_documento", "yyyy-MM-dd"))
    path = shared_dir(spark, "moments")
    state = moments.store_moments(c, "valor_liquido", ["tipoDespesa"], "dia", path)
    merged = moments.merged_stats(state, ["tipoDespesa"], sd_col="desvio_padrao")
    out = stats.zscore_filter(c, "valor_liquido", ["tipoDespesa"], money=True, stats=merged)
    out = lookup_join(out, roles.deputies(spark, d), "idDeputado", "id", ["nome", "sigla_partido", "sigla_uf"])
    out = out.select(F.col("idDeputado").alias("deputado_id"), "nome", "sigla_partido", "sigla_uf", "tipoDespesa", "valor_liquido", "media", "z_score", "data_documento")
    return rnd(out, {"media": 6, "z_score": 6})


@register("alignment_front_cells", SQL["alignment_front"])
def q_alignment_front_cells(spark: SparkSession, d: str) -> DataFrame:
    """G5 from cells stored per bucket of ballots: the later half of the ballots is added to those of the first."""
    votes, mem, dep = roles.votes(spark, d), roles.membership_rows(spark, d), roles.deputies(spark, d)
    path, scratch = shared_dir(spark, "cells"), Scratch(spark)
    mem = materialize(alignment.voter_memberships(votes, mem), "members", scratch)
    middle = votes.agg(F.percentile_approx(F.unix_date("idVotacao"), 0.5)).first()[0] or 0
    early = F.unix_date("idVotacao") <= middle
    alignment.store_cells(votes.where(early), mem, dep, path)
    alignment.store_cells(votes, mem, dep, path, ballots=votes.where(~early))
    scratch.clear()  # the cells are written
    return rnd(alignment.alignment_of_cells(alignment.stored_cells(spark, path)), {"indice_alinhamento_medio": 6})


@register(
    "alignment_matrix_long",
    with_(DEP, MEM, VOT,
          "md AS (SELECT m.idFrente, m.id, d.sigla_partido FROM mem m LEFT JOIN dep d ON m.id = d.id)",
          """sv AS (SELECT md.idFrente, md.sigla_partido, v.idVotacao, v.tipoVoto, count(*) AS qtde FROM vot v
        JOIN md ON v.deputado_id = md.id GROUP BY ALL)""",
          """sp AS (SELECT *, qtde / sum(qtde) OVER (PARTITION BY idFrente, sigla_partido, idVotacao) AS prop_sub FROM sv)""",
          "hv AS (SELECT idVotacao, tipoVoto, count(deputado_id) AS qtde FROM vot GROUP BY ALL)",
          "hp AS (SELECT idVotacao, tipoVoto, qtde / sum(qtde) OVER (PARTITION BY idVotacao) AS prop_geral FROM hv)")
    + """SELECT sp.idFrente AS id_frente, sp.sigla_partido, round(avg(sp.prop_sub / hp.prop_geral), 6) AS indice_alinhamento FROM sp LEFT JOIN hp
  ON sp.idVotacao = hp.idVotacao AND sp.tipoVoto = hp.tipoVoto GROUP BY ALL""",
)
def q_alignment_matrix_long(spark: SparkSession, d: str) -> DataFrame:
    """X4 in long form from additive cells (parties are an open set)."""
    cells = alignment.alignment_cells(roles.votes(spark, d), roles.membership_rows(spark, d), roles.deputies(spark, d))
    return rnd(alignment.matrix_of_cells(cells), {"indice_alinhamento": 6})


@register(
    "engagement_calendar",
    with_(LEV, """m AS (SELECT id_deputado, date_trunc('month', data_inicio) AS m, count(*) AS n FROM lev WHERE data_inicio IS NOT NULL GROUP BY ALL)""",
          "s AS (SELECT id_deputado, unnest(generate_series(CAST(min(m) AS TIMESTAMP), CAST(max(m) AS TIMESTAMP), INTERVAL 1 MONTH)) AS m FROM m GROUP BY id_deputado)",
          "x AS (SELECT s.id_deputado, s.m, coalesce(n, 0) AS n FROM s LEFT JOIN m ON m.id_deputado = s.id_deputado AND m.m = s.m)")
    + """SELECT id_deputado, CAST(year(m) AS BIGINT) AS ano, CAST(month(m) AS BIGINT) AS mes, n AS qtde_atividades,
  lag(n) OVER (PARTITION BY id_deputado ORDER BY m) AS qtde_anterior, n - lag(n) OVER (PARTITION BY id_deputado ORDER BY m) AS variacao FROM x""",
)
def q_engagement_calendar(spark: SparkSession, d: str) -> DataFrame:
    """One row a deputy and calendar month from first to last activity, zero months included."""
    return engagement.engagement_calendar(roles.legislative_events(spark, d), "id_deputado", "data_inicio")


@register(
    "committee_lifecycle",
    """WITH r AS (SELECT o_custkey AS id, CAST(date_trunc('month', o_orderdate) AS DATE) AS dia, o_orderpriority AS situacao,
    row_number() OVER (PARTITION BY o_custkey, date_trunc('month', o_orderdate) ORDER BY o_orderdate DESC, o_orderkey DESC) AS k FROM orders WHERE o_orderstatus = 'F'),
s AS (SELECT id, dia, situacao FROM r WHERE k = 1),
days AS (SELECT dia, row_number() OVER (ORDER BY dia) AS seq, lead(dia) OVER (ORDER BY dia) AS prox FROM (SELECT DISTINCT dia FROM s)),
j AS (SELECT s.*, seq, prox, CASE WHEN lag(seq) OVER w = seq - 1 AND lag(situacao) OVER w = situacao THEN 0 ELSE 1 END AS nova
  FROM s JOIN days USING (dia) WINDOW w AS (PARTITION BY id ORDER BY seq)),
i AS (SELECT *, sum(nova) OVER (PARTITION BY id ORDER BY seq) AS ilha FROM j),
g AS (SELECT id, situacao, min(dia) AS inicio, max(seq) AS ultima FROM i GROUP BY id, ilha, situacao)
SELECT id, situacao, inicio, prox AS fim, date_diff('day', inicio, coalesce(prox, (SELECT max(dia) FROM s))) AS dias, prox IS NULL AS aberto
FROM g JOIN days ON days.seq = g.ultima""",
)
def q_committee_lifecycle(spark: SparkSession, d: str) -> DataFrame:
    """Status intervals of committees (customers) over monthly landings of one type (filled orders)."""
    o = roles.table(spark, d, "orders").where(of_type("o_orderstatus", "F"))
    landed = o.select(F.col("o_custkey").alias("id"), F.trunc(F.col("o_orderdate").cast("date"), "month").alias("dia"), F.col("o_orderpriority").alias("situacao"), "o_orderdate", "o_orderkey")
    return lifecycle.status_intervals(landed, "id", ["situacao"], "dia", ["o_orderdate", "o_orderkey"])


@register(
    "distinct_voters_rollup",
    with_(VOT, "v AS (SELECT tipoVoto, strftime(data_votacao, '%Y-%m-%d') AS dia, deputado_id FROM vot)")
    + """SELECT tipoVoto, dia, count(DISTINCT deputado_id) AS qtde_deputados FROM v GROUP BY tipoVoto, dia
UNION ALL SELECT tipoVoto, NULL, count(DISTINCT deputado_id) FROM v GROUP BY tipoVoto
UNION ALL SELECT NULL, NULL, count(DISTINCT deputado_id) FROM v""",
)
def q_distinct_voters_rollup(spark: SparkSession, d: str) -> DataFrame:
    """A3: distinct deputies per option and day, per option and in all, from one set of bitmaps."""
    votes = roles.votes(spark, d).select("tipoVoto", F.date_format("data_votacao", "yyyy-MM-dd").alias("dia"), "deputado_id")
    votes = votes.join(distinct.dense_ids(votes, "deputado_id"), "deputado_id")
    state_path = shared_dir(spark, "bitmaps")
    publish(distinct.bitmap_state(votes, ["tipoVoto", "dia"], "id_denso"), state_path)
    state, out = read_published(spark, state_path), "qtde_deputados"
    none = F.lit(None).cast("string")
    by_day = distinct.distinct_counts(state, ["tipoVoto", "dia"], out)
    by_option = distinct.distinct_counts(state, ["tipoVoto"], out).withColumn("dia", none)
    whole = distinct.distinct_counts(state, [], out).withColumns({"tipoVoto": none, "dia": none})
    return by_day.unionByName(by_option).unionByName(whole)


#: Orders that the second source lacks, has changed or has alone (by key).
_LACKS, _CHANGED, _ALONE = "o_orderkey % 1009 = 0", "o_orderkey % 997 = 1", "o_orderkey % 991 = 2"


@register(
    "bulk_differences",
    f"""WITH r AS (SELECT o_orderkey, o_custkey, CASE WHEN {_CHANGED} THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice FROM orders WHERE NOT ({_LACKS})
  UNION ALL SELECT -o_orderkey, o_custkey, o_totalprice FROM orders WHERE {_ALONE})
SELECT coalesce(l.o_orderkey, r.o_orderkey) AS o_orderkey, CASE WHEN l.o_orderkey IS NULL THEN 0 ELSE 1 END AS linhas_esquerda,
  CASE WHEN r.o_orderkey IS NULL THEN 0 ELSE 1 END AS linhas_direita,
  CASE WHEN r.o_orderkey IS NULL THEN 'so_esquerda' WHEN l.o_orderkey IS NULL THEN 'so_direita' ELSE 'diferente' END AS situacao
FROM orders l FULL JOIN r ON l.o_orderkey = r.o_orderkey
WHERE l.o_orderkey IS NULL OR r.o_orderkey IS NULL OR l.o_totalprice <> r.o_totalprice""",
)
def q_bulk_differences(spark: SparkSession, d: str) -> DataFrame:
    """Orders against a second source of them that lacks, changes and adds some."""
    left = roles.table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    right = left.where(~F.expr(_LACKS)).withColumn("o_totalprice", F.when(F.expr(_CHANGED), F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")))
    right = right.unionByName(left.where(_ALONE).withColumn("o_orderkey", -F.col("o_orderkey")))
    return reconcile.differences(left, right, ["o_orderkey"], ["o_custkey", "o_totalprice"])


@register(
    "anomaly_feed_runs",
    with_(CLM, "mid AS (SELECT quantile_disc(data_documento, 0.5) AS m FROM clm)", _zsql("cur", ""), _zsql("prev", "WHERE data_documento <= (SELECT m FROM mid)"),
          "c AS (SELECT idDeputado, tipoDespesa, valor_liquido, data_documento, count(*) AS n FROM cur WHERE abs(z_score) > 3 AND valor_liquido > 0 GROUP BY ALL)",
          "p AS (SELECT idDeputado, tipoDespesa, valor_liquido, data_documento, count(*) AS n FROM prev WHERE abs(z_score) > 3 AND valor_liquido > 0 GROUP BY ALL)")
    + """SELECT c.idDeputado, c.tipoDespesa, c.valor_liquido, c.data_documento, c.n - coalesce(p.n, 0) AS novas
  FROM c LEFT JOIN p USING (idDeputado, tipoDespesa, valor_liquido, data_documento) WHERE c.n > coalesce(p.n, 0)""",
)
def q_anomaly_feed_runs(spark: SparkSession, d: str) -> DataFrame:
    """A run over the earlier half of the claims is stored, then one over all; the feed of the second has what the first had not."""
    c, keys = roles.claims(spark, d), ["idDeputado", "tipoDespesa", "valor_liquido", "data_documento"]
    day = c.agg(F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY unix_date(data_documento))")).first()[0] or 0
    path, kept = shared_dir(spark, "runs"), None
    for run, rows in (("1", c.where(F.unix_date("data_documento") <= day)), ("2", c)):
        kept = runs.store_run(stats.zscore_filter(rows, "valor_liquido", ["tipoDespesa"], money=True).select(*keys, "z_score"), path, run)
    return runs.alerts(kept, "2", keys).select(*keys, "novas")


@register(
    "incremental_upsert",
    """SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 50 = 0 THEN 'corrected' ELSE o_orderstatus END AS o_orderstatus,
  CASE WHEN o_orderkey % 50 = 0 THEN 2 WHEN o_orderkey % 3 = 0 THEN 2 ELSE 1 END AS pagina FROM orders""",
)
def q_incremental_upsert(spark: SparkSession, d: str) -> DataFrame:
    """A first landing of orders, then a batch of late, repeated and corrected ones, merged by key into its buckets."""
    from civiclake.streaming.incremental import upsert

    o = roles.table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    spec = BronzeSpec("pedidos", o.schema, ("o_orderkey",), partition_by=("balde",), cluster=("o_orderkey",))
    page = lambda df, n: df.withColumns({"_chegada": F.timestamp_seconds(F.lit(n)), "_arquivo": F.lit(f"page={n}"), "pagina": F.lit(n).cast("long")})
    late = (F.col("o_orderkey") % 3 == 0)
    fixed = F.when(F.col("o_orderkey") % 50 == 0, F.lit("corrected")).otherwise(F.col("o_orderstatus"))
    target = shared_dir(spark, "upsert")
    upsert(spark, spec, target, page(o.where(~late), 1))
    upsert(spark, spec, target, page(o.where(late | (F.col("o_orderkey") % 50 == 0)).withColumn("o_orderstatus", fixed), 2))
    return read_published(spark, target).select("o_orderkey", "o_custkey", "o_orderstatus", "pagina")


@register(
    "written_totals",
    with_(DEP, MEM, VOT) + """SELECT 'silver' AS camada, CAST((SELECT count(*) FROM dep) + (SELECT count(*) FROM mem) AS BIGINT) AS total_linhas
UNION ALL SELECT 'gold', CAST(count(DISTINCT coalesce(tipoVoto, '')) AS BIGINT) FROM vot""",
)
def q_written_totals(spark: SparkSession, d: str) -> DataFrame:
    """Layer totals of a run from the counts observed while it wrote, kept by the run registry."""
    from civiclake.operators import reports
    from civiclake.plans.layers import run_layer

    lake, run = shared_dir(spark, "lake"), runs.run_id("2024-12-31")
    status = run_layer(spark, "silver", {"dim_deputados": lambda: roles.deputies(spark, d), "fact_frentes_membros": lambda: roles.memberships(spark, d)}, lake, run=run)
    status += run_layer(spark, "gold", {"padroes_votacao": lambda: reports.vote_patterns(roles.votes(spark, d))}, lake, run=run)
    runs.record_run(spark, lake, run, status)
    return runs.written_totals(spark, lake, run)
