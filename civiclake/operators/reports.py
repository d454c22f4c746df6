"""Report-shaped aggregations: rankings, spend breakdowns, event calendars.

Each is one partial+final hash aggregation (map-side combined, so hot
keys are pre-aggregated before the shuffle), an optional label join, and
an ordering.  Every top-N breaks ties on its key so results are
reproducible; ``orderBy(...).limit(n)`` plans as ``TakeOrderedAndProject``
(per-partition top-n, never a full sort).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civiclake.functions.clean import money, money_avg, money_avg_from_parts, money_sum
from civiclake.functions.dates import iso_week, week_start
from civiclake.operators.joins import lookup_join

# Report sizes of the reference's rankings and dashboard lists.
TOP_MEMBERS, TOP_SUPPLIERS_BY_KEY, TOP_SUPPLIERS_BY_NAME, TOP_TYPES, RECENT_EVENTS = 10, 10, 50, 10, 20


def distinct_count(c: str, approx: bool = False, rsd: float = 0.01) -> Column:
    """Exact ``count(DISTINCT c)`` by default (A3); ``approx=True`` uses a
    HyperLogLog++ sketch: no per-value dedup state, a fixed-size buffer per
    group, at relative error ``rsd``."""
    return F.approx_count_distinct(c, rsd) if approx else F.count_distinct(c)


def top_n(df: DataFrame, measure: str | Column, keys: Sequence[str], n: int) -> DataFrame:
    """Rows with the ``n`` largest ``measure``; ties broken by ``keys`` ascending."""
    m = F.col(measure) if isinstance(measure, str) else measure
    return df.orderBy(m.desc(), *[F.col(k).asc() for k in keys]).limit(n)


def most_active_members(memberships: DataFrame, n: int = TOP_MEMBERS, approx: bool = False) -> DataFrame:
    """Deputies in the most distinct fronts -> ``id_deputado, qtde_frentes``."""
    per = memberships.groupBy(F.col("id").alias("id_deputado")).agg(distinct_count("idFrente", approx).alias("qtde_frentes"))
    return top_n(per, "qtde_frentes", ["id_deputado"], n)


def supplier_ranking_by_key(expenses: DataFrame, suppliers: DataFrame, n: int = TOP_SUPPLIERS_BY_KEY) -> DataFrame:
    """Sum by supplier key, label, top-n, constant ``cnpj_suspeito``.

    Aggregates before the label join, so the join sees one row per supplier.
    """
    per = expenses.groupBy("id_fornecedor").agg(money_sum("valor_liquido").alias("total_recebido"))
    ranked = top_n(per, "total_recebido", ["id_fornecedor"], n)
    return lookup_join(ranked, suppliers, "id_fornecedor", "id_fornecedor", ["nome_fornecedor"]).withColumn(
        "cnpj_suspeito", F.lit(False)
    ).select("id_fornecedor", "nome_fornecedor", "total_recebido", "cnpj_suspeito")


def supplier_ranking_by_name(expenses: DataFrame, n: int = TOP_SUPPLIERS_BY_NAME, approx: bool = False) -> DataFrame:
    """``nomeFornecedor, total_recebido, qtde_transacoes, qtde_deputados_atendidos``."""
    per = (
        expenses.where(F.col("nomeFornecedor").isNotNull())
        .groupBy("nomeFornecedor")
        .agg(
            money_sum("valor_liquido").alias("total_recebido"),
            F.count(F.lit(1)).alias("qtde_transacoes"),
            distinct_count("idDeputado", approx).alias("qtde_deputados_atendidos"),
        )
    )
    return top_n(per, "total_recebido", ["nomeFornecedor"], n)


def spend_by_type(expenses: DataFrame, approx: bool = False) -> DataFrame:
    """``tipoDespesa, total_gasto, media_gasto, qtde_transacoes, qtde_deputados``."""
    return (
        expenses.groupBy("tipoDespesa")
        .agg(
            money_sum("valor_liquido").alias("total_gasto"),
            money_avg("valor_liquido").alias("media_gasto"),
            F.count(F.lit(1)).alias("qtde_transacoes"),
            distinct_count("idDeputado", approx).alias("qtde_deputados"),
        )
        .orderBy(F.desc("total_gasto"), "tipoDespesa")
    )


def spend_by_deputy(expenses: DataFrame, deputies: DataFrame) -> DataFrame:
    """Aggregate per deputy first, then attach labels (one row per deputy in the join)."""
    per = expenses.groupBy(F.col("idDeputado").alias("deputado_id")).agg(
        money_sum("valor_liquido").alias("total_gasto"),
        money_avg("valor_liquido").alias("media_gasto"),
        F.count(F.lit(1)).alias("qtde_despesas"),
    )
    out = lookup_join(per, deputies, "deputado_id", "id", ["nome", "sigla_partido", "sigla_uf"])
    return out.select("deputado_id", "nome", "sigla_partido", "sigla_uf", "total_gasto", "media_gasto", "qtde_despesas").orderBy(
        F.desc("total_gasto"), "deputado_id"
    )


def spend_by_state(expenses: DataFrame, deputies: DataFrame, approx: bool = False) -> DataFrame:
    """Spend per state of the deputy; a NULL state is its own group.

    Aggregates per deputy first (map-side combined), so the lookup join
    sees one row per deputy instead of every expense; the per-state
    figures are then combined from exact decimal parts.  After the first
    step each deputy is one row, so counting rows counts distinct deputies
    (``approx`` is accepted for signature parity; the count is exact).
    """
    per_dep = expenses.groupBy("idDeputado").agg(
        F.sum(money("valor_liquido")).alias("__sum"), F.count("valor_liquido").alias("__nval"), F.count(F.lit(1)).alias("__rows")
    )
    x = lookup_join(per_dep, deputies, "idDeputado", "id", ["sigla_uf"])
    agg = x.groupBy("sigla_uf").agg(
        F.sum("__sum").alias("__sum"), F.sum("__nval").alias("__nval"), F.sum("__rows").alias("qtde_despesas"),
        F.count("idDeputado").alias("qtde_deputados"),
    )
    return agg.select(
        "sigla_uf", F.col("__sum").cast("double").alias("total_gasto"), money_avg_from_parts("__sum", "__nval").alias("media_gasto"),
        "qtde_despesas", "qtde_deputados",
    ).orderBy(F.desc("total_gasto"), "sigla_uf")


def vote_patterns(votes: DataFrame, approx: bool = False) -> DataFrame:
    """Per option ``qtde_votos, qtde_deputados, qtde_votacoes``."""
    return (
        votes.groupBy("tipoVoto")
        .agg(
            F.count(F.lit(1)).alias("qtde_votos"),
            distinct_count("deputado_id", approx).alias("qtde_deputados"),
            distinct_count("idVotacao", approx).alias("qtde_votacoes"),
        )
        .orderBy(F.desc("qtde_votos"), "tipoVoto")
    )


def monthly_events(events: DataFrame, ts: str = "data_inicio", kind: str = "descricaoTipo", approx: bool = False) -> DataFrame:
    """``ano, mes, qtde_eventos, qtde_tipos_eventos`` for dated events."""
    return (
        events.where(F.col(ts).isNotNull())
        .groupBy(F.year(ts).cast("bigint").alias("ano"), F.month(ts).cast("bigint").alias("mes"))
        .agg(F.count(F.lit(1)).alias("qtde_eventos"), distinct_count(kind, approx).alias("qtde_tipos_eventos"))
        .orderBy("ano", "mes")
    )


def weekly_density(events: DataFrame, ts: str = "data_inicio", event_id: str = "id", legacy_year: bool = False) -> DataFrame:
    """``ano, semana, qtde_eventos`` (ISO year-of-week by default)."""
    y, w = iso_week(F.col(ts).cast("date"), legacy_year)
    return events.groupBy(y.cast("bigint").alias("ano"), w.cast("bigint").alias("semana")).agg(F.count(event_id).alias("qtde_eventos"))


def weekly_density_spine(events: DataFrame, ts: str = "data_inicio", event_id: str = "id") -> DataFrame:
    """G10 as documented: every ISO week between the first and last event,
    with 0 for weeks without events.

    The spine is generated from one scalar subquery (first and last week
    start): its size is the number of weeks in the range, independent of
    the row count.  Counts are aggregated per week start first, so the
    final join is between two week-sized frames.
    """
    d = F.col(ts).cast("date")
    counts = events.where(d.isNotNull()).groupBy(week_start(d).alias("semana_inicio")).agg(F.count(event_id).alias("qtde_eventos"))
    mm = counts.select(F.struct(F.min("semana_inicio").alias("lo"), F.max("semana_inicio").alias("hi"))).scalar()
    lo, hi = mm["lo"], mm["hi"]
    spine = counts.sparkSession.range(1).select(
        F.explode(F.sequence(lo, hi, F.expr("INTERVAL 7 DAYS"))).alias("semana_inicio")
    )
    y, w = iso_week(F.col("semana_inicio"))
    return (
        spine.join(counts, "semana_inicio", "left")
        .select(
            y.cast("bigint").alias("ano"),
            w.cast("bigint").alias("semana"),
            "semana_inicio",
            F.coalesce(F.col("qtde_eventos"), F.lit(0)).cast("bigint").alias("qtde_eventos"),
        )
        .orderBy("semana_inicio")
    )


def week_heatmap(events: DataFrame, kinds: list[str], ts: str = "data_inicio", kind: str = "descricaoTipo") -> DataFrame:
    """ISO week x event type counts, one column per type in ``kinds``."""
    y, w = iso_week(F.col(ts).cast("date"))
    return (
        events.where(F.col(ts).isNotNull())
        .groupBy(y.cast("bigint").alias("ano"), w.cast("bigint").alias("semana"))
        .pivot(kind, kinds)
        .agg(F.count(F.lit(1)))
        .fillna(0, kinds)
    )


def week_counts(events: DataFrame, category: str, ts: str = "data_inicio", out: str = "categoria") -> DataFrame:
    """X5 in long form: ``ano, semana, <out>, qtde_eventos`` per ISO week and
    category.  Needs no list of categories (a pivot would), so it suits open
    sets such as organs; one partial aggregation."""
    y, w = iso_week(F.col(ts).cast("date"))
    return (
        events.where(F.col(ts).isNotNull())
        .groupBy(y.cast("bigint").alias("ano"), w.cast("bigint").alias("semana"), F.col(category).alias(out))
        .agg(F.count(F.lit(1)).alias("qtde_eventos"))
    )


def grand_totals(events: DataFrame, expenses: DataFrame) -> DataFrame:
    """One row with the event count and the total spend (dashboard counters)."""
    n_events = events.select(F.count(F.lit(1))).scalar()
    total = expenses.select(money_sum("valor_liquido")).scalar()
    return events.sparkSession.range(1).select(n_events.alias("total_eventos"), total.alias("total_despesas"))


def top_event_types(events: DataFrame, n: int = TOP_TYPES, kind: str = "descricaoTipo") -> DataFrame:
    """``descricaoTipo, qtde_eventos`` top n."""
    per = events.groupBy(kind).agg(F.count(F.lit(1)).alias("qtde_eventos"))
    return top_n(per, "qtde_eventos", [kind], n)


def recent_events(events: DataFrame, n: int = RECENT_EVENTS, ts: str = "data_inicio", event_id: str = "id",
                  columns: Sequence[str] = ("descricaoTipo", "situacao")) -> DataFrame:
    """The ``n`` most recent events (ties broken by id)."""
    return events.select(event_id, ts, *columns).orderBy(F.col(ts).desc_nulls_last(), F.col(event_id).asc()).limit(n)


def share_by_type(expenses: DataFrame, n: int = TOP_TYPES) -> DataFrame:
    """``tipoDespesa, total_gasto, participacao`` of the grand total, top n."""
    per = expenses.groupBy("tipoDespesa").agg(F.sum(money("valor_liquido")).alias("__dec"))
    grand = per.select(F.sum("__dec")).scalar()  # from the per-type sums: no second pass over the rows
    out = per.select("tipoDespesa", F.col("__dec").cast("double").alias("total_gasto"),
                     F.try_divide(F.col("__dec").cast("double"), grand.cast("double")).alias("participacao"))
    return top_n(out, "total_gasto", ["tipoDespesa"], n)
