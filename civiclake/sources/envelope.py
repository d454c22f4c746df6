"""Landed API pages -> records.

Layout: one JSON file per page, ``<landing>/<endpoint>/[<parent>=<id>/]page=<n>.json``,
each ``{"dados": [...records...], "links": [{"rel": ..., "href": ...}]}``.
The HTTP fetching that produced these files is outside Spark; everything
from the landed files on is a distributed read:

* pages are read with a declared envelope schema, ``dados`` as an array of
  *raw JSON texts*, so each record is parsed once with the declared record
  schema (``from_json``) and its unknown fields are still visible for the
  drift overflow column;
* the parent id of fan-out endpoints (members of a front, votes of a
  ballot, expenses of a deputy) is stamped from the file path;
* page completeness (last page has no ``next`` link, no gaps) is an
  aggregation over the pages, not a driver loop.
"""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from civiclake.functions.clean import to_timestamp_safe
from civiclake.operators.dedup import keep_latest
from civiclake.schemas import LINK, BronzeSpec
from civiclake.session import Scratch, materialize

RAW_PAGE = StructType([
    StructField("dados", ArrayType(StringType())),
    StructField("links", ArrayType(LINK)),
    StructField("_corrupt_record", StringType()),
])


def read_pages(spark: SparkSession, path: str, parent: str | None = None, period: tuple[int, int] | None = None) -> DataFrame:
    """One row per landed page file; ``period`` (first and last year) reads only the files of those years
    (see :func:`of_years`).

    Columns: ``_arquivo`` (lineage), ``pagina``, ``parent`` (text from the
    path or NULL), ``dados`` (array of raw record texts), ``tem_proxima``
    (page has a ``next`` link), ``_corrupt_record``, ``_chegada`` (file
    modification time, the landing time used by streaming watermarks).
    """
    raw = (
        spark.read.schema(RAW_PAGE)
        .option("multiLine", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_corrupt_record")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.json")
        .json(path)
    )
    return pages_from(raw.where(of_years(*period)) if period else raw, parent)


def of_years(first: int, last: int):
    """S10 for landed files: those below a folder ``ano=<year>`` of the period, and those below no such
    folder (their year is unknown).  The predicate is on the file's path alone, so Spark drops the
    other files when it lists them, before any JSON is parsed."""
    path = F.col("_metadata.file_path")
    wanted = "|".join(str(y) for y in range(first, last + 1))
    return ~path.rlike(r"/ano=\d+/") | path.rlike(f"/ano=({wanted})/")


def pages_from(raw: DataFrame, parent: str | None = None) -> DataFrame:
    """Page columns from a raw envelope frame (batch or streaming)."""
    fp = F.col("_metadata.file_path")
    par = F.nullif(F.regexp_extract(fp, rf"/{parent}=([^/]+)/", 1), F.lit("")) if parent else F.lit(None).cast("string")
    return raw.select(
        fp.alias("_arquivo"),
        F.regexp_extract(fp, r"page=(\d+)\.json$", 1).try_cast("bigint").alias("pagina"),
        par.alias("parent"),
        "dados",
        F.coalesce(F.exists("links", lambda link: link["rel"] == F.lit("next")), F.lit(False)).alias("tem_proxima"),
        "_corrupt_record",
        F.col("_metadata.file_modification_time").alias("_chegada"),
    )


def page_completeness(pages: DataFrame, parents: DataFrame | None = None) -> DataFrame:
    """Per parent, were all pages landed and readable?

    ``completo`` when pages 1..max are all present, none is corrupt JSON,
    the last one has no ``next`` link, and no file lacks a page number (its
    records are read, but its place is unknown).  ``parents`` (a column
    ``parent``) names the parents expected; one without any page is
    reported with 0 pages.  Output: ``parent, paginas, ultima_pagina,
    sem_numero, corrompidas, ultima_tem_proxima, faltando, completo``.
    """
    per = pages.groupBy("parent").agg(
        F.count_distinct("pagina").alias("paginas"),
        F.max("pagina").alias("ultima_pagina"),
        F.count_if(F.col("pagina").isNull()).alias("sem_numero"),
        F.count_if(F.col("_corrupt_record").isNotNull()).alias("corrompidas"),
        F.max_by("tem_proxima", "pagina").alias("ultima_tem_proxima"),
    )
    if parents is not None:
        counts = ["paginas", "sem_numero", "corrompidas"]
        expected = parents.select(F.col("parent").cast("string").alias("parent")).distinct()
        per = per.join(expected, "parent", "full").fillna(0, counts)
    per = per.withColumn("faltando", F.coalesce(F.col("ultima_pagina"), F.lit(0)) - F.col("paginas"))
    whole = (F.col("paginas") > 0) & (F.col("faltando") == 0) & (F.col("sem_numero") == 0) & (F.col("corrompidas") == 0)
    return per.withColumn("completo", whole & ~F.coalesce(F.col("ultima_tem_proxima"), F.lit(True)))


def records(pages: DataFrame, schema: StructType, parent: str | None = None, overflow: str | None = "_extra", raw: bool = False,
            page_columns: Sequence[str] = ()) -> DataFrame:
    """Explode pages into conformed records.

    Known fields are parsed with the declared schema (missing -> typed
    NULL); unknown fields, and the text of known ones that could not be
    parsed, are kept as JSON text in ``overflow`` (pass
    ``None`` to skip that second parse of each record); the parent id from
    the path fills ``parent`` when the record lacks it.  ``_posicao`` is the
    record's place on its page, ``_invalidos`` names the known fields whose
    value was given but could not be parsed (comma-joined, NULL if none),
    and ``raw`` keeps the record's text in ``_raw``.  With ``page_columns``
    these columns of the page are kept, and a page without records is one
    row without ``_posicao``.
    """
    known = [fl.name for fl in schema.fields]
    carry = [c for c in ("_chegada",) if c in pages.columns] + list(page_columns)
    explode = F.posexplode_outer if page_columns else F.posexplode
    rec = pages.select("_arquivo", "pagina", "parent", *[c for c in carry if c != "parent"], explode("dados").alias("_posicao", "_raw"))
    as_map = F.from_json("_raw", "map<string,string>")
    known_arr = F.array(*[F.lit(k) for k in known])
    extra_col = [as_map.alias("m")] if overflow else []
    parsed = rec.select("_arquivo", "pagina", "_posicao", "parent", *[c for c in carry if c != "parent"], "_raw", F.from_json("_raw", schema).alias("r"), *extra_col)
    cols = []
    for fl in schema.fields:
        c = F.col(f"r.{fl.name}")
        if parent and fl.name == parent:
            c = F.coalesce(c, F.col("parent").try_cast(fl.dataType))
        cols.append(c.alias(fl.name))
    invalid, kept = [], []
    if overflow:
        bad = [F.when(F.col("m").getItem(k).isNotNull() & F.col(f"r.`{k}`").isNull(), F.lit(k)) for k in known]
        bad_arr = F.array_compact(F.array(*bad))
        extra = F.map_filter("m", lambda k, v: ~F.array_contains(known_arr, k) | F.array_contains(bad_arr, k))
        kept = [F.when(F.size(extra) > 0, F.to_json(extra)).alias(overflow)]
        # a text that is no record at all has no fields to name
        invalid = [F.when(F.col("m").isNull() | F.col("r").isNull(), F.lit("registro")).otherwise(F.nullif(F.concat_ws(",", *bad), F.lit(""))).alias("_invalidos")]
    return parsed.select(*cols, *kept, *invalid, "_arquivo", "pagina", "_posicao", *carry, *(["_raw"] if raw else []))


def conform(df: DataFrame, schema: StructType, overflow: str | None = "_extra") -> DataFrame:
    """Project any frame onto ``schema``.

    Missing columns become typed NULLs, present ones are cast (without
    raising for atomic types), unknown ones are packed into ``overflow``.
    """
    have = set(df.columns)
    out = []
    for fl in schema.fields:
        if fl.name in have:
            c = F.col(f"`{fl.name}`")
            c = c.try_cast(fl.dataType) if fl.dataType.typeName() not in ("struct", "array", "map") else c.cast(fl.dataType)
        else:
            c = F.lit(None).cast(fl.dataType)
        out.append(c.alias(fl.name))
    unknown = [c for c in df.columns if c not in {fl.name for fl in schema.fields} and not c.startswith("_")]
    if overflow:
        out.append((F.to_json(F.struct(*[F.col(f"`{u}`") for u in unknown])) if unknown else F.lit(None).cast("string")).alias(overflow))
    return df.select(*out)


def empty(spark: SparkSession, schema: StructType) -> DataFrame:
    """A typed empty frame (written as an empty typed table)."""
    return spark.createDataFrame([], schema)


def split_accepted(recs: DataFrame, spec: BronzeSpec) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) records of ``records(..., raw=True)``.

    A record that lacks a required key is rejected with its text (``_raw``)
    and the missing keys (``_motivo``), so it can be audited and landed again.
    """
    missing = missing_keys(spec)
    accepted = recs.where(missing == "").drop("_raw")
    return accepted, recs.where(missing != "").withColumn("_motivo", F.concat(F.lit("sem "), missing))


def latest(accepted: DataFrame, spec: BronzeSpec) -> DataFrame:
    """One row per natural key: the record of the most recently landed file (K8)."""
    keys = [f"__k{i}" for i in range(len(spec.key_exprs))]
    keyed = accepted.withColumns({k: F.expr(e) for k, e in zip(keys, spec.key_exprs)})
    return keep_latest(keyed, [*spec.natural_key, *keys], ["_chegada", "_arquivo", "pagina"]).drop(*keys)


def with_year(df: DataFrame, spec: BronzeSpec) -> DataFrame:
    """The partition column: the event year of the one events table, or the bucket of the key columns
    that land together (a ballot's votes, a front's members, a month's claims)."""
    if "ano" in spec.partition_by:
        return df.withColumn("ano", F.year(to_timestamp_safe("dataHoraInicio")))
    if "balde" in spec.partition_by:
        return df.withColumn("balde", F.pmod(F.xxhash64(*spec.cluster), F.lit(spec.buckets)).cast("int"))
    return df


def missing_keys(spec: BronzeSpec):
    """Names of the required keys that a record lacks, comma-joined."""
    return F.concat_ws(",", *[F.when(F.col(k).isNull(), F.lit(k)) for k in spec.required])


PAGE = ("parent", "tem_proxima", "corrompida")


def landed_once(spark: SparkSession, landing: str, spec: BronzeSpec, scratch: Scratch, period: tuple[int, int] | None = None) -> DataFrame:
    """All that landed for one endpoint, parsed once and written: records with their page's columns (a page
    without records is one row without ``_posicao``), the text only where the record is rejected.

    Accepted and rejected records, completeness and reconciliation are all taken from it.
    """
    pages = read_pages(spark, os.path.join(landing, spec.name), spec.parent, period).withColumn("corrompida", F.col("_corrupt_record").isNotNull())
    recs = records(pages, spec.schema, spec.parent, raw=True, page_columns=PAGE)
    return materialize(recs.withColumn("_raw", F.when(missing_keys(spec) != "", F.col("_raw"))), f"landed-{spec.name}", scratch)


def landed_records(landed: DataFrame) -> DataFrame:
    return landed.where(F.col("_posicao").isNotNull()).drop(*PAGE)


def landed_pages(landed: DataFrame) -> DataFrame:
    """The pages as :func:`page_completeness` takes them."""
    pages = landed.groupBy("_arquivo").agg(*[F.first(c).alias(c) for c in ("pagina", *PAGE)])
    return pages.withColumn("_corrupt_record", F.when(F.col("corrompida"), F.lit("")))


def reconcile(recs: DataFrame, spec: BronzeSpec) -> DataFrame:
    """Q5: one row: ``tabela, registros`` landed, ``rejeitados``, ``duplicados`` (records that another
    record of their key replaced), ``gravados``, ``com_invalidos``; landed = rejected + duplicate + written."""
    accepted, rejected = split_accepted(recs, spec)
    some = accepted.agg(F.count("*").alias("aceitos"), F.count("_invalidos").alias("com_invalidos"))
    none = rejected.agg(F.count("*").alias("rejeitados"))
    kept = latest(accepted, spec).agg(F.count("*").alias("gravados"))
    # three one-row frames
    row = some.join(none).join(kept)
    return row.select(F.lit(spec.name).alias("tabela"), (F.col("aceitos") + F.col("rejeitados")).alias("registros"), "rejeitados", (F.col("aceitos") - F.col("gravados")).alias("duplicados"), "gravados", "com_invalidos")


def bronze(spark: SparkSession, landing: str, spec: BronzeSpec) -> tuple[DataFrame, DataFrame]:
    """One table-driven bronze build: (accepted records, rejected records).

    Records missing a required key are rejected (kept for audit, not
    dropped silently).  A page landed twice yields each record once: the
    natural key keeps the record from the most recently landed file (K8).
    """
    path = os.path.join(landing, spec.name)
    accepted, rejected = split_accepted(records(read_pages(spark, path, spec.parent), spec.schema, spec.parent, raw=True), spec)
    return latest(accepted, spec), rejected
