"""Layer runner (W10, W11): bronze -> silver -> gold in dependency order.

Each table's plan runs exactly once, inside its write; the row count is
observed during that write.  Tables are published with a commit record
(``sinks.published``): a run that dies leaves each table in its old or its new
version, and the next run finishes or clears what it left.  Bronze isolates
failures per table (the run continues and reports them); silver and gold
stop at the first failure, as the reference did.  The result of a run is a
status DataFrame ``(camada, tabela, status, linhas, erro)`` rather than
console prints, and the run registry (``plans.runs``) keeps it.

Landed JSON is parsed once a run: what landed is written as one table an
endpoint, and bronze, rejects, completeness and reconciliation read that.
"""

from __future__ import annotations

import functools
import os
from collections.abc import Callable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType, TimestampType

from civiclake.operators import quality
from civiclake.operators.reconcile import differences
from civiclake.operators.scd2 import scd2_merge
from civiclake.plans import gold, runs, silver
from civiclake.schemas import BRONZE
from civiclake.session import Scratch
from civiclake.sinks.published import is_published, publish, read_published
from civiclake.sources.envelope import landed_once, landed_pages, landed_records, latest, page_completeness, reconcile, split_accepted, with_year
from civiclake.sources.tables import read_bulk

STATUS = StructType([
    StructField("camada", StringType()), StructField("tabela", StringType()), StructField("status", StringType()),
    StructField("linhas", LongType()), StructField("erro", StringType()),
])


def run_layer(spark: SparkSession, layer: str, tables: Mapping[str, Callable[[], DataFrame]], out_dir: str,
              partitions: Mapping[str, tuple[str, ...]] | None = None, isolate_errors: bool = False, run: str = "", rebalance: bool = False) -> list[tuple]:
    """Publish every table of a layer; returns status rows."""
    rows = []
    for name, build in tables.items():
        try:
            n = publish(build(), os.path.join(out_dir, layer, name), (partitions or {}).get(name, ()), run=run, rebalance=rebalance).total
            rows.append((layer, name, "ok", n, None))
        except Exception as e:  # noqa: BLE001 - reported in the status frame
            rows.append((layer, name, "falha", None, f"{type(e).__name__}: {e}"))
            if not isolate_errors:
                raise RuntimeError(f"{layer}.{name} failed") from e
    return rows


def _landed(spark: SparkSession, landing: str, spec, scratch: Scratch, period: tuple[int, int] | None) -> DataFrame | None:
    """What landed for one endpoint, parsed once; None when there is no landing folder."""
    try:
        return landed_once(spark, landing, spec, scratch, period)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return None


def bronze_schema(spec, with_partitions: bool = True) -> StructType:
    """Schema of a written bronze table: record fields, overflow, lineage (+ partition columns)."""
    fields = list(spec.schema.fields) + [
        StructField("_extra", StringType()), StructField("_invalidos", StringType()), StructField("_arquivo", StringType()),
        StructField("pagina", LongType()), StructField("_posicao", IntegerType()), StructField("_chegada", TimestampType()),
    ]
    if with_partitions:
        fields += [StructField(c, IntegerType()) for c in spec.partition_by]
    return StructType(fields)


def ingest_all(spark: SparkSession, landing: str, out_dir: str, period: tuple[int, int] | None = None, run: str = "",
               landed: dict[str, DataFrame] | None = None, scratch: Scratch | None = None) -> list[tuple]:
    """Bronze: every endpoint, failures isolated per table; an endpoint with
    no landed pages is written as an empty typed table.

    With a ``period`` (S10: first and last year) only the landed files of
    these years are read, and their records replace or join those of the
    table by key; other partitions are not touched.  ``landed`` receives the
    parsed landing of each endpoint; its files belong to ``scratch``.
    """
    from civiclake.streaming.incremental import upsert

    own = Scratch(spark) if scratch is None else scratch
    rows = []
    for name, spec in BRONZE.items():
        target = os.path.join(out_dir, "bronze", name)
        try:
            found = _landed(spark, landing, spec, own, period)
            if found is not None and landed is not None:
                landed[name] = found
            if found is None:
                df = spark.createDataFrame([], bronze_schema(spec, with_partitions=False))
            else:
                df = split_accepted(landed_records(found), spec)[0]
            if period is None:
                n = publish(with_year(latest(df, spec), spec), target, spec.partition_by, run=run).total
            else:
                n = upsert(spark, spec, target, df, run).total
            rows.append(("bronze", name, "vazio" if found is None else "ok", n, None))
        except Exception as e:  # noqa: BLE001 - reported in the status frame
            rows.append(("bronze", name, "falha", None, f"{type(e).__name__}: {e}"))
    if scratch is None:
        own.clear()
    return rows


def _read_bronze(spark: SparkSession, out_dir: str) -> dict[str, DataFrame]:
    """Published bronze tables, read with their declared schemas, so an empty
    endpoint (which may have no data files when partitioned) reads as empty."""
    return {n: read_published(spark, os.path.join(out_dir, "bronze", n), bronze_schema(spec)).drop("balde") for n, spec in BRONZE.items()}


def _read_silver(spark: SparkSession, out_dir: str) -> dict[str, DataFrame]:
    """Written silver tables, read with the schemas of the silver builders
    (derived by analysis alone, no job), for the same reason."""
    schemas = {k: v.schema for k, v in silver.build_all(_read_bronze(spark, out_dir), "1970-01-01 00:00:00").items()}
    return {n: read_published(spark, os.path.join(out_dir, "silver", n), schemas[n]) for n in silver.TABLES}


def transform_all(spark: SparkSession, out_dir: str, as_of: str) -> list[tuple]:
    """Silver: all dimensions and facts from the written bronze tables (stops at the first failure).

    The star dimensions keep their history: a run merges its snapshot into
    the versions written before (K6), so a change closes a version and opens
    one.  The merge reads the version that it replaces, which stays the
    table until the new one is whole.
    """
    frames = silver.build_all(_read_bronze(spark, out_dir), as_of)

    def with_history(name: str, snapshot: DataFrame) -> DataFrame:
        path = os.path.join(out_dir, "silver", name)
        if not is_published(spark, path):
            return snapshot
        history = read_published(spark, path, snapshot.schema)
        key, *tracked = [c for c in snapshot.columns if c not in ("valid_from", "valid_to", "is_current")]
        return scd2_merge(history, snapshot, key, tracked, as_of)

    builds = {k: ((lambda k=k, v=v: with_history(k, v)) if k in silver.HISTORY else (lambda v=v: v)) for k, v in frames.items()}
    return run_layer(spark, "silver", builds, out_dir, silver.PARTITIONS, run=runs.run_id(as_of))


def analyze_all(spark: SparkSession, out_dir: str, as_of: str | None = None) -> list[tuple]:
    """Gold: both metric generations from the written silver tables (stops at the first failure).

    ``as_of`` names the run (by default the time that silver was processed
    at).  The outliers of every run are kept, and the alert feed has those
    that the last run before did not have (X9).
    """
    sv = _read_silver(spark, out_dir)
    run = runs.run_id(as_of or str(sv["dim_deputados"].agg(F.max("dt_processamento")).first()[0] or ""))
    at = lambda name: os.path.join(out_dir, "gold", name)
    tables = {f"b_{k}": v for k, v in gold.tables_b(sv, lambda name: at(f"b_{name}")).items()} | {f"a_{k}": v for k, v in gold.tables_a(sv).items()}
    tables |= {k: v for k, v in gold.lifecycles(_read_bronze(spark, out_dir)).items()}
    # reports come sorted, their tables need not be
    rows = run_layer(spark, "gold", tables, out_dir, gold.PARTITIONS, run=run, rebalance=True)

    def feed() -> DataFrame:
        found = read_published(spark, at("b_anomalias_despesas"))
        kept = runs.store_run(found, at("b_anomalias_execucoes"), run)
        return runs.alerts(kept, run, gold.ALERT_KEYS)

    return rows + run_layer(spark, "gold", {"b_alertas_anomalias": feed}, out_dir, run=run)


def run_all(spark: SparkSession, landing: str, out_dir: str, as_of: str, period: tuple[int, int] | None = None) -> DataFrame:
    """Full run from landed pages; returns the status frame of all layers (+ audit tables), which the run registry keeps."""
    landed: dict[str, DataFrame] = {}
    scratch, run = Scratch(spark), runs.run_id(as_of)
    status = ingest_all(spark, landing, out_dir, period, run, landed, scratch)
    status += transform_all(spark, out_dir, as_of)
    status += analyze_all(spark, out_dir, as_of)
    present = {r[1]: landed[r[1]] for r in status if r[0] == "bronze" and r[2] == "ok"}
    status += run_layer(spark, "audit", audit_tables(present, _read_silver(spark, out_dir)), out_dir, run=run)
    scratch.clear()
    runs.record_run(spark, out_dir, run, status)
    return spark.createDataFrame(status, STATUS)


#: The silver table and key that a fan-out endpoint's parents come from.
PARENTS = {"idFrente": ("dim_frentes", "id"), "idVotacao": ("fact_votacoes", "idVotacao"), "idDeputado": ("dim_deputados", "id")}


def expected_parents(parent: str | None, sv: Mapping[str, DataFrame]) -> DataFrame | None:
    """Parents (column ``parent``) whose pages should have landed; none for endpoints without a parent."""
    if parent is None:
        return None
    name, key = PARENTS[parent]
    return sv[name].select(sv[name][key].cast("string").alias("parent")).where("parent is not null")


def audit_tables(landed: Mapping[str, DataFrame], sv: Mapping[str, DataFrame]) -> dict[str, Callable[[], DataFrame]]:
    """Data-quality tables (Q1-Q5, S2) written with every run, from what landed (parsed once) and silver."""
    out: dict[str, Callable[[], DataFrame]] = {}
    for name, found in landed.items():
        spec = BRONZE[name]
        out[f"paginas_{name}"] = lambda found=found, spec=spec: page_completeness(landed_pages(found), expected_parents(spec.parent, sv))
        out[f"rejeitados_{name}"] = lambda found=found, spec=spec: split_accepted(landed_records(found), spec)[1]

    def reconciliation() -> DataFrame:
        rows = [reconcile(landed_records(found), BRONZE[name]) for name, found in landed.items()]
        return functools.reduce(DataFrame.unionByName, rows)

    if landed:
        out["reconciliacao"] = reconciliation
    # keys as they landed: the silver table has each once
    if "eventos" in landed:
        out["duplicados_eventos"] = lambda: quality.duplicate_keys(landed_records(landed["eventos"]), ["id"])
    out["duplicados_fact_eventos"] = lambda: quality.duplicate_keys(sv["fact_eventos"], ["id"])
    out["orfaos_votos"] = lambda: quality.orphans(sv["fact_votacoes"], sv["dim_deputados"], "deputado_id", "id")
    out["orfaos_despesas"] = lambda: quality.orphans(sv["fact_despesas"], sv["dim_deputados"], "idDeputado", "id")
    out["nulos_fact_despesas"] = lambda: quality.null_profile(sv["fact_despesas"])
    out["nao_convertidos_despesas"] = lambda: quality.unparsed_profile(
        sv["fact_despesas"].unionByName(sv["fact_despesas_rejeitadas"]),
        {"valorLiquido": "valor_liquido", "valorDocumento": "valor_documento", "dataDocumento": "data_documento"},
    )
    return out


def compare_bulk(spark: SparkSession, out_dir: str, name: str, path: str, keys: Sequence[str], fmt: str = "csv", **options: str) -> DataFrame:
    """An endpoint's bronze table (left) against an annual bulk file of it (right), by digests of buckets of ``keys``.

    The fields that the file has are compared; both sides have the declared types.
    """
    spec = BRONZE[name]
    landed = _read_bronze(spark, out_dir)[name]
    bulk = read_bulk(spark, path, spec.schema, fmt, **options)
    reader = spark.read.format(fmt).options(**({"header": "true"} if fmt == "csv" else {}) | options)
    given = set(reader.load(path).columns)
    values = [c for c in spec.schema.names if c in given and c not in keys]
    return differences(landed, bulk, keys, values)
