"""Event facts and attendance.

Dimension keys are deterministic (K3), so the event fact carries its date
and type keys without joining the date and type dimensions (the
reference's J1/J2 lookups), and the dimensions are separate distinct
projections of the same source.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from civiclake.functions.clean import clean_text
from civiclake.functions.dates import duration_hours
from civiclake.functions.keys import surrogate_key
from civiclake.operators.joins import lookup_join


def date_key(c) -> F.Column:
    return surrogate_key(F.to_date(c).cast("string"))


def event_fact(events: DataFrame, event_id: str = "id", start: str = "data_inicio", end: str = "data_fim",
               kind: str = "descricaoTipo", presence: str | None = "presenca") -> DataFrame:
    """``id_evento, id_data, id_tipo_evento, duracao_horas, qtde_presencas``.

    ``presence`` may be an array column (its size is the attendance; a NULL
    array gives NULL) or an already-counted numeric column.
    """
    if presence is None:
        pres = F.lit(None).cast("int")
    elif isinstance(events.schema[presence].dataType, ArrayType):
        pres = F.size(presence)
    else:
        pres = F.col(presence).cast("int")
    return events.select(
        F.col(event_id).alias("id_evento"),
        date_key(start).alias("id_data"),
        surrogate_key(clean_text(kind)).alias("id_tipo_evento"),
        duration_hours(start, end).alias("duracao_horas"),
        pres.alias("qtde_presencas"),
    )


def date_dim(events: DataFrame, start: str = "data_inicio") -> DataFrame:
    """``id_data, data`` for every distinct event date."""
    d = events.select(F.to_date(start).alias("data")).where(F.col("data").isNotNull()).distinct()
    return d.select(date_key("data").alias("id_data"), "data")


def presence_rate(attendance: DataFrame, event: str, attendee: str, kind: str | None = None) -> DataFrame:
    """Per attendee, events attended and the share of events; with ``kind``
    (a column of the event's type) per attendee and type, as a share of that type's events.

    ``attendance`` has one row per (event, attendee) appearance, i.e. the
    exploded presence list, so the denominator is the number of events
    with a recorded presence list (attendance at the others is unknown).
    It is a scalar subquery.
    """
    if kind is not None:
        total = attendance.groupBy(F.col(kind).alias("__kind")).agg(F.count_distinct(event).alias("__total"))
        per = attendance.groupBy(attendee, kind).agg(F.count_distinct(event).alias("qtde_eventos"))
        rate = F.try_divide(F.col("qtde_eventos").cast("double"), F.col("__total"))
        return per.join(total, F.col(kind).eqNullSafe(F.col("__kind"))).withColumn("taxa_presenca", rate).drop("__kind", "__total")
    total = attendance.select(F.count_distinct(event)).scalar()
    per = attendance.groupBy(attendee).agg(F.count_distinct(event).alias("qtde_eventos"))
    return per.withColumn("taxa_presenca", F.try_divide(F.col("qtde_eventos").cast("double"), total))


def explode_presence(events: DataFrame, event_id: str = "id", presence: str = "presenca", keep: tuple[str, ...] = ()) -> DataFrame:
    """(event, attendee id, ``keep``) rows from an array-of-struct presence list."""
    return events.select(F.col(event_id).alias("id_evento"), *keep, F.explode(presence).alias("p")).select("id_evento", F.col("p.id").alias("id_deputado"), *keep)


def front_atlas(memberships: DataFrame, fronts: DataFrame, deputies: DataFrame) -> DataFrame:
    """Every membership with front title (and legislature, where the fronts have
    ``idLegislatura``) and the member's party, state and region."""
    m = memberships.select("idFrente", F.col("id").alias("id_deputado"))
    legislature = ["idLegislatura"] if "idLegislatura" in fronts.columns else []
    m = lookup_join(m, fronts, "idFrente", "id", ["titulo", *legislature])
    m = lookup_join(m, deputies, "id_deputado", "id", ["nome", "sigla_partido", "sigla_uf", "regiao"])
    return m.select("idFrente", "titulo", "id_deputado", "nome", "sigla_partido", "sigla_uf", "regiao", *legislature)
