"""Domain-shaped views over the driver's TPC-H-like tables.

The metric functions take domain frames (deputies, fronts, memberships,
votes, expenses, legislative events).  This module derives them from the
driver tables so the same functions run on both:

* deputy = customer (party = market segment, state = nation, region)
* front = supplier; membership = distinct (supplier, customer) of
  lineitem x orders
* vote = events (ballot = event date, option = event type)
* expense = lineitem x orders x part x supplier (type = part type,
  supplier = supplier name, value = extended price, date = ship date)
* claim (for outliers) = events (type = event type, value = value)
* legislative event = orders (type = priority, start = order date)

Every frame is a lazy projection of parquet scans: Catalyst prunes
columns down to the scans and pushes filters into them.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from civiclake.functions.clean import clean_text
from civiclake.functions.keys import surrogate_key
from civiclake.operators.joins import lookup_join


_SCHEMAS: dict[tuple, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table.  Its footer schema is inferred once per file version
    (path, mtime, size) and passed on later reads, which skips the
    footer-reading step of every query's planning."""
    path = os.path.join(sf_dir, f"{name}.parquet")
    try:
        st = os.stat(path)
        key = (path, st.st_mtime_ns, st.st_size)
    except OSError:  # not a local path: always infer
        key = None
    if key is not None and key in _SCHEMAS:
        return spark.read.schema(_SCHEMAS[key]).parquet(path)
    df = spark.read.parquet(path)
    if key is not None:
        _SCHEMAS[key] = df.schema
    return df


def deputies(spark: SparkSession, d: str, region: bool = False) -> DataFrame:
    """Deputies with party and state; ``region=True`` adds ``regiao``.

    The region lookup is opt-in: Catalyst cannot drop an unused left join
    without knowing the right side is unique, so joining it by default
    would add a scan and a broadcast to every deputy lookup.
    """
    c = table(spark, d, "customer")
    n = table(spark, d, "nation")
    cols = {"n_name": "sigla_uf"}
    if region:
        n = lookup_join(n, table(spark, d, "region"), "n_regionkey", "r_regionkey", {"r_name": "regiao"})
        cols["regiao"] = "regiao"
    x = lookup_join(c, n, "c_nationkey", "n_nationkey", cols)
    return x.select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("nome"),
        F.upper(F.col("c_name")).alias("nome_padronizado"),
        F.col("c_mktsegment").alias("sigla_partido"),
        "sigla_uf",
        *(["regiao"] if region else []),
    )


def fronts(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "supplier")
    return s.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("titulo"), F.upper("s_name").alias("titulo_padronizado"))


def membership_rows(spark: SparkSession, d: str) -> DataFrame:
    """(idFrente, id) of each lineitem, repeats included, for operators that make memberships distinct
    themselves: without a ``distinct`` below it, Catalyst takes their filter on deputies to the orders."""
    li = table(spark, d, "lineitem").select("l_orderkey", "l_suppkey")
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    j = lookup_join(li, o, "l_orderkey", "o_orderkey", ["o_custkey"], how="inner")
    return j.select(F.col("l_suppkey").alias("idFrente"), F.col("o_custkey").alias("id"))


def memberships(spark: SparkSession, d: str) -> DataFrame:
    """Distinct (idFrente, id): the map-side partial distinct keeps the shuffle small."""
    return membership_rows(spark, d).distinct()


def votes(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    return e.select(
        F.col("ts").cast("date").alias("idVotacao"),
        F.col("user_id").alias("deputado_id"),
        F.col("event_type").alias("tipoVoto"),
        F.col("ts").alias("data_votacao"),
    )


def expenses(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate")
    o = table(spark, d, "orders")
    p = table(spark, d, "part")
    s = table(spark, d, "supplier")
    x = lookup_join(li, o, "l_orderkey", "o_orderkey", ["o_custkey"], how="inner")
    x = lookup_join(x, p, "l_partkey", "p_partkey", ["p_type"], how="inner")
    x = lookup_join(x, s, "l_suppkey", "s_suppkey", ["s_name"], how="inner")
    return x.select(
        F.col("o_custkey").alias("idDeputado"),
        F.col("p_type").alias("tipoDespesa"),
        F.col("s_name").alias("nomeFornecedor"),
        surrogate_key(clean_text("s_name")).alias("id_fornecedor"),
        surrogate_key(clean_text("p_type")).alias("id_categoria"),
        F.col("l_extendedprice").alias("valor_liquido"),
        F.col("l_shipdate").cast("date").alias("data_documento"),
    )


def claims(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    return e.select(
        F.col("event_id").alias("id_despesa"),
        F.col("user_id").alias("idDeputado"),
        F.col("event_type").alias("tipoDespesa"),
        F.col("value").alias("valor_liquido"),
        F.col("ts").cast("date").alias("data_documento"),
    )


def legislative_events(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    return o.select(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderdate").alias("data_inicio"),
        F.col("o_orderpriority").alias("descricaoTipo"),
        F.col("o_orderstatus").alias("situacao"),
        F.col("o_custkey").alias("id_deputado"),
    )


def silver_tables(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    """Both generations' silver tables derived from the driver tables, with
    the column names the gold builders read (``plans.gold``)."""
    from civiclake.operators.dims import extract_dim
    from civiclake.operators.events import date_dim, event_fact

    dep, mem, vot, exp, lev = deputies(spark, d), memberships(spark, d), votes(spark, d), expenses(spark, d), legislative_events(spark, d)
    return {
        # Gen-B
        "dim_deputados": dep, "dim_frentes": fronts(spark, d), "fact_frentes_membros": mem, "fact_votacoes": vot,
        "fact_despesas": exp, "fact_eventos": lev,
        # Gen-A
        "dim_deputado": dep.select(F.col("id").alias("id_deputado"), "sigla_partido", "sigla_uf"),
        "fato_frente_membro": mem.select(F.col("idFrente").alias("id_frente"), F.col("id").alias("id_deputado")),
        "fato_voto": vot.select(F.col("deputado_id").alias("id_deputado"), "idVotacao", F.col("tipoVoto").alias("voto_texto")),
        "fato_despesa": exp.select(F.col("idDeputado").alias("id_deputado"), "id_fornecedor", "id_categoria", "valor_liquido"),
        "dim_fornecedor": extract_dim(exp, "nomeFornecedor", "nome_fornecedor", "id_fornecedor"),
        "fato_evento": event_fact(lev.withColumn("data_fim", F.lit(None).cast("timestamp_ntz")), "id", "data_inicio", "data_fim",
                                  "descricaoTipo", None),
        "dim_data": date_dim(lev, "data_inicio"),
    }
