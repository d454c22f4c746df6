"""Engagement scores.

Global minima / maxima are one scalar subquery returning a struct
(``DataFrame.scalar()``): Spark evaluates the one-row aggregate once
(later references are ``ReusedSubquery``) and inlines the values, so
there is no driver ``collect()`` and no join against a one-row frame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from civiclake.operators.joins import lookup_join


def minmax_score(counts: DataFrame, value: str, out: str) -> DataFrame:
    """``(v - min) / (max - min)``; 1.0 for every row when max = min."""
    mm = counts.select(F.struct(F.min(value).alias("lo"), F.max(value).alias("hi"))).scalar()
    lo, hi = mm["lo"], mm["hi"]
    score = F.when(hi == lo, F.lit(1.0)).otherwise((F.col(value) - lo).cast("double") / (hi - lo).cast("double"))
    return counts.withColumn(out, score)


def vote_engagement_minmax(votes: DataFrame, deputy: str = "deputado_id", ballot: str = "idVotacao") -> DataFrame:
    """Gen-A (G12): ``id_deputado, score_engajamento`` for deputies that voted."""
    per_dep = votes.groupBy(F.col(deputy).alias("id_deputado")).agg(F.count(ballot).alias("qtde_votacoes"))
    return minmax_score(per_dep, "qtde_votacoes", "score_engajamento").select("id_deputado", "score_engajamento")


# Fixed values of the weighted engagement score: fronts weigh 40, votes 60 (out of 100).
FRONTS_WEIGHT, VOTES_WEIGHT = 40.0, 60.0


def weighted_engagement(deputies: DataFrame, memberships: DataFrame, votes: DataFrame,
                        w_fronts: float = FRONTS_WEIGHT, w_votes: float = VOTES_WEIGHT) -> DataFrame:
    """Gen-B (G13): every deputy gets ``40*fronts/max + 60*votes/max``.

    A component is 0 when its maximum is 0 or absent.  Output columns:
    ``id, nome, sigla_partido, sigla_uf, qtde_frentes, qtde_votacoes,
    score_engajamento``, sorted by score (desc) then id.
    """
    fronts = memberships.groupBy("id").agg(F.count_distinct("idFrente").alias("qtde_frentes"))
    nvotes = votes.groupBy(F.col("deputado_id").alias("id")).agg(F.count("idVotacao").alias("qtde_votacoes"))
    base = deputies.select("id", "nome", "sigla_partido", "sigla_uf")
    e = lookup_join(base, fronts, "id", "id", ["qtde_frentes"])
    e = lookup_join(e, nvotes, "id", "id", ["qtde_votacoes"]).fillna(0, ["qtde_frentes", "qtde_votacoes"])
    mx = e.select(F.struct(F.max("qtde_frentes").alias("f"), F.max("qtde_votacoes").alias("v"))).scalar()
    max_f, max_v = mx["f"], mx["v"]

    def part(c: str, mx, w: float):
        return F.when(mx > 0, F.col(c).cast("double") / mx * F.lit(w)).otherwise(F.lit(0.0))

    score = (part("qtde_frentes", max_f, w_fronts) + part("qtde_votacoes", max_v, w_votes)).cast("double")
    return (
        e.withColumn("score_engajamento", score)
        .select("id", "nome", "sigla_partido", "sigla_uf", "qtde_frentes", "qtde_votacoes", "score_engajamento")
        .orderBy(F.desc("score_engajamento"), "id")
    )


def engagement_trend(activity: DataFrame, deputy: str = "deputado_id", ts: str = "data_votacao") -> DataFrame:
    """Engagement over time (X6): activities per deputy and month, with the
    previous month's count and the change.  The window runs over one
    deputy's *monthly aggregates*, so its size is bounded by the number
    of months, not by the deputy's raw row count.
    """
    monthly = activity.groupBy(
        F.col(deputy).alias("id_deputado"), F.year(ts).cast("bigint").alias("ano"), F.month(ts).cast("bigint").alias("mes")
    ).agg(F.count(F.lit(1)).alias("qtde_atividades"))
    w = Window.partitionBy("id_deputado").orderBy("ano", "mes")
    return monthly.withColumn("qtde_anterior", F.lag("qtde_atividades").over(w)).withColumn(
        "variacao", F.col("qtde_atividades") - F.col("qtde_anterior")
    )


def engagement_calendar(activity: DataFrame, deputy: str = "deputado_id", ts: str = "data_votacao") -> DataFrame:
    """Engagement by calendar month (X6): one row a deputy and month from the first to the last activity,
    zero months included, with the calendar month before and the change.

    Each active month is followed by its idle months up to the next active
    one, so one window over a deputy's monthly counts suffices and the
    missing months are generated after the aggregation.
    """
    month = F.year(ts).cast("bigint") * 12 + F.month(ts) - 1
    monthly = activity.where(F.col(ts).isNotNull()).groupBy(F.col(deputy).alias("id_deputado"), month.alias("__m")).agg(F.count(F.lit(1)).alias("__n"))
    w = Window.partitionBy("id_deputado").orderBy("__m")
    before = F.when(F.lag("__m").over(w) == F.col("__m") - 1, F.lag("__n").over(w)).when(F.lag("__m").over(w).isNotNull(), F.lit(0))
    runs = monthly.select("id_deputado", "__m", "__n", before.alias("__before"), F.coalesce(F.lead("__m").over(w) - 1, F.col("__m")).alias("__until"))
    rows = runs.select("id_deputado", "__m", "__n", "__before", F.explode(F.sequence("__m", "__until")).alias("__at"))
    step = F.col("__at") - F.col("__m")
    now = F.when(step == 0, F.col("__n")).otherwise(F.lit(0))
    previous = F.when(step == 0, F.col("__before")).when(step == 1, F.col("__n")).otherwise(F.lit(0))
    return rows.select(
        "id_deputado", F.floor(F.col("__at") / 12).alias("ano"), (F.col("__at") % 12 + 1).alias("mes"), now.alias("qtde_atividades"),
        previous.alias("qtde_anterior"), (now - previous).alias("variacao"),
    )
