"""What is kept between runs: published versions, keyed upserts, runs and their alerts, stored statistics,
cells and bitmaps; life-cycles, bucket digests, calendar months."""

from __future__ import annotations

import datetime as dt
import glob
import itertools
import json
import os
import random
import re
import time

import pytest
from conftest import land
from pyspark.sql import functions as F
from test_sources import AS_OF, _land_domain

from civiclake.functions.clean import among
from civiclake.functions.regions import REGIONS, region_of
from civiclake.operators import alignment, distinct, engagement, lifecycle, moments, reconcile, stats
from civiclake.plans import layers, runs
from civiclake.plans.catalog import TABLES, register_lake
from civiclake.schemas import BRONZE
from civiclake.sinks import published as pub
from civiclake.sources import envelope
from civiclake.sources.tables import read_bulk
from civiclake.streaming import compact, start_ingest, upsert
from civiclake.streaming.incremental import batch_folders


def D(day: int, month: int = 1) -> dt.date:
    return dt.date(2024, month, day)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


# ------------------------------------------------------------------ publish
def table(spark, pairs):
    return spark.createDataFrame(pairs, "ano int, v string")


@pytest.mark.parametrize("partition_by", [(), ("ano",)])
def test_a_version_is_whole_or_not_there(spark, tmpdir_run, monkeypatch, partition_by):
    """A crash before the record leaves the old version, one after it the new; at every step of the moves."""
    path = os.path.join(tmpdir_run, "t")
    old, new = [(2023, "a"), (2024, "b")], [(2024, "c"), (2025, "d"), (None, "e")]
    schema = "v string, ano int" if partition_by else "ano int, v string"
    read = lambda: sorted(((r["ano"], r["v"]) for r in pub.read_published(spark, path, table(spark, old).schema).collect()), key=str)
    steps = {"write": 0, "delete": 0, "rename": 0}
    state = {"left": None}

    class Crash(Exception):
        pass

    for name in steps:
        original = getattr(pub.Folder, name)

        def step(self, *args, _original=original, _name=name):
            if state["left"] is not None:
                if state["left"] == 0:
                    raise Crash(_name)
                state["left"] -= 1
            return _original(self, *args)

        monkeypatch.setattr(pub.Folder, name, step)
    seen = set()
    for crash_at in range(40):
        state["left"] = None
        pub.publish(table(spark, old).select(*schema.replace(" string", "").replace(" int", "").split(", ")), path, partition_by)
        state["left"] = crash_at
        try:
            pub.publish(table(spark, new), path, partition_by)
            finished = True
        except Crash:
            finished = False
        state["left"] = None
        got = read()
        assert got in (sorted(old, key=str), sorted(new, key=str)), crash_at
        seen.add(got == sorted(new, key=str))
        waiting = pub.recover(spark, path)
        assert read() == got and not pub.Folder(spark, path).names(pub.NEW)
        if waiting:
            assert got == sorted(new, key=str)
        if finished:
            break
    assert seen == {True, False} and finished
    assert sorted((r["ano"], r["v"]) for r in spark.read.parquet(path).where("ano is not null").collect()) == new[:2]
    last = pub.latest_version(spark, path)
    assert last.total == 3 and last.number == len(pub.versions(spark, path))


def test_publish_a_frame_that_reads_its_table(spark, tmpdir_run):
    path = os.path.join(tmpdir_run, "t")
    pub.publish(table(spark, [(2024, "a")]), path, run="1")
    for k in range(3):
        pub.publish(pub.read_published(spark, path).unionByName(table(spark, [(2024, str(k))])), path, run=str(k + 2))
    assert rows(spark.read.parquet(path).select("v")) == [("0",), ("1",), ("2",), ("a",)]
    assert [(v.number, v.run, v.total) for v in pub.versions(spark, path)] == [(1, "1", 1), (2, "2", 2), (3, "3", 3), (4, "4", 4)]


def test_partitions_outside_the_replaced_ones_are_refused(spark, tmpdir_run):
    path = os.path.join(tmpdir_run, "t")
    pub.publish(table(spark, [(2023, "a"), (2024, "b")]), path, ["ano"])
    with pytest.raises(ValueError):
        pub.publish(table(spark, [(2025, "x")]), path, ["ano"], ["ano=2024"])
    pub.publish(table(spark, []), path, ["ano"], ["ano=2024"])
    assert rows(spark.read.schema("v string, ano int").parquet(path)) == [("a", 2023)]
    assert pub.latest_version(spark, path).rows == {"ano=2023": 1}


# ------------------------------------------------------------------ X7
def event(i, year, text="x"):
    return {"id": i, "descricao": text, "dataHoraInicio": f"{year}-03-01T10:00"} if year else {"id": i, "descricao": text}


def files(target):
    return {os.path.relpath(p, target): os.stat(p).st_mtime_ns for p in glob.glob(f"{target}/*/*.parquet") + glob.glob(f"{target}/*.parquet")}


def test_a_batch_replaces_only_its_partitions(spark, tmpdir_run):
    landing, spec = os.path.join(tmpdir_run, "landing"), BRONZE["eventos"]
    target, ckpt = os.path.join(tmpdir_run, "bronze", "eventos"), os.path.join(tmpdir_run, "ckpt")
    run = lambda: start_ingest(spark, landing, spec, target, ckpt).awaitTermination(120)
    land(landing, "eventos", [[event(i, 2018 + i % 6) for i in range(60)] + [event(100, None)]])
    run()
    before = files(target)
    # a new event of 2023, one of 2019 corrected in place, one that moves from 2020 to 2024
    later = land(landing, "eventos", [[event(200, 2023), event(1, 2019, "corrected"), event(2, 2024, "moved")]], subdir="later")
    soon = os.path.getmtime(os.path.join(later, "page=1.json")) + 60
    os.utime(os.path.join(later, "page=1.json"), (soon, soon))
    run()
    after = files(target)
    part = lambda names: {n.split("/")[0] for n in names}
    assert part(set(before) - set(after)) == {"ano=2019", "ano=2020", "ano=2023"}
    assert part(set(after) - set(before)) == {"ano=2019", "ano=2020", "ano=2023", "ano=2024"}
    assert all(after[n] == t for n, t in before.items() if n in after) and len(set(before) & set(after)) >= 4
    batch = envelope.with_year(envelope.bronze(spark, landing, spec)[0], spec).select("id", "descricao", "ano")
    assert rows(spark.read.parquet(target).select("id", "descricao", "ano")) == rows(batch)
    version = pub.latest_version(spark, target)
    run()  # nothing new: no version
    assert pub.latest_version(spark, target).number == version.number
    # the batch again, as after a failure between the publication and the stream's own commit
    lot = max(glob.glob(f"{batch_folders(target)[0]}/lote=*"))
    upsert(spark, spec, target, spark.read.parquet(lot))
    assert rows(spark.read.parquet(target).select("id", "descricao", "ano")) == rows(batch)


def test_a_crash_midway_leaves_the_table_and_the_replayed_batch_mends_it(spark, tmpdir_run, monkeypatch):
    landing, spec = os.path.join(tmpdir_run, "landing"), BRONZE["votos_deputados"]
    target, ckpt = os.path.join(tmpdir_run, "bronze", "votos"), os.path.join(tmpdir_run, "ckpt")
    vote = lambda d, o: {"deputado_": json.dumps({"id": d}), "tipoVoto": o}
    for ballot in ("v1", "v2", "v3", "v4", "v5"):
        land(landing, spec.name, [[vote(d, "Sim") for d in range(5)]], parent=("idVotacao", ballot))
    start_ingest(spark, landing, spec, target, ckpt).awaitTermination(120)
    good = rows(spark.read.parquet(target).select("idVotacao", "deputado_", "tipoVoto"))
    folder = land(landing, spec.name, [[vote(d, "Não") for d in range(6)]], parent=("idVotacao", "v2"), subdir="later")
    soon = os.path.getmtime(os.path.join(folder, "page=1.json")) + 60
    os.utime(os.path.join(folder, "page=1.json"), (soon, soon))
    with monkeypatch.context() as m:
        m.setattr(pub.Folder, "write", lambda self, name, text: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(Exception, match="lost"):
            start_ingest(spark, landing, spec, target, ckpt).awaitTermination(120)
    assert rows(pub.read_published(spark, target).select("idVotacao", "deputado_", "tipoVoto")) == good
    untouched = {n: t for n, t in files(target).items()}
    start_ingest(spark, landing, spec, target, ckpt).awaitTermination(120)
    got = pub.read_published(spark, target)
    assert rows(got.groupBy("idVotacao", "tipoVoto").count()) == [("v1", "Sim", 5), ("v2", "Não", 6), *((f"v{k}", "Sim", 5) for k in (3, 4, 5))]
    assert set(untouched) & set(files(target))  # the buckets of other ballots


def test_the_log_of_batches_is_compacted(spark, tmpdir_run):
    landing, spec = os.path.join(tmpdir_run, "landing"), BRONZE["frentes"]
    target, ckpt = os.path.join(tmpdir_run, "frentes"), os.path.join(tmpdir_run, "ckpt")
    for k in range(4):
        land(landing, "frentes", [[{"id": k}, {"id": 0, "titulo": str(k)}]], subdir=f"day{k}")
        start_ingest(spark, landing, spec, target, ckpt).awaitTermination(120)
    log = batch_folders(target)[0]
    expected = rows(spark.read.parquet(target).select("id", "titulo"))
    assert compact(spark, spec, target, keep=1) == 3 and compact(spark, spec, target, keep=1) == 0
    assert sorted(os.path.basename(p) for p in glob.glob(f"{log}/lote=*")) == ["lote=2", "lote=3"]
    from civiclake.streaming import refresh

    assert refresh(spark, spec, target) == 4 and rows(spark.read.parquet(target).select("id", "titulo")) == expected


# ------------------------------------------------------------------ layers
def test_one_parse_of_the_landing_a_run(spark, tmpdir_run):
    """One JSON scan an endpoint, whatever bronze and the audit take from it; totals from written counts."""
    landing, lake = os.path.join(tmpdir_run, "landing"), os.path.join(tmpdir_run, "lake")
    _land_domain(landing)
    scans = []
    original = envelope.read_pages

    def counted(spark, path, *args):
        scans.append(path)
        return original(spark, path, *args)

    envelope.read_pages = counted
    try:
        status = layers.run_all(spark, landing, lake, AS_OF)
    finally:
        envelope.read_pages = original
    assert len(scans) == len(set(scans)) == len(BRONZE)
    assert not status.where("status not in ('ok', 'vazio')").count()
    run = runs.run_id(AS_OF)
    totals = {r["camada"]: r["total_linhas"] for r in runs.written_totals(spark, lake, run).collect()}
    for layer in ("bronze", "silver", "gold"):
        tables = [p for p in glob.glob(f"{lake}/{layer}/*") if glob.glob(f"{p}/**/*.parquet", recursive=True)]
        stored = sum(pub.read_published(spark, p).count() for p in tables)
        extra = sum(pub.read_published(spark, p).count() for p in tables if p.endswith(("b_anomalias_execucoes", "momentos_despesas")))
        assert totals[layer] == stored - extra


def test_second_run_alerts_only_what_is_new(spark, tmpdir_run):
    landing, lake = os.path.join(tmpdir_run, "landing"), os.path.join(tmpdir_run, "lake")
    claim = lambda n, v: {"tipoDespesa": "T", "ano": 2024, "mes": 1, "codDocumento": str(n), "dataDocumento": "2024-01-02", "valorLiquido": v}
    land(landing, "deputados", [[{"id": 1, "nome": "Ana", "siglaPartido": "PT", "siglaUf": "SP"}]])
    land(landing, "despesas_deputados", [[claim(i, 10 + i % 3) for i in range(60)] + [claim(900, 500)]], parent=("idDeputado", 1))
    feed = lambda: rows(spark.read.parquet(os.path.join(lake, "gold", "b_alertas_anomalias")).select("valor_liquido", "novas", "execucao"))
    layers.run_all(spark, landing, lake, "2024-02-01 00:00:00")
    assert feed() == [(500.0, 1, "20240201000000")]
    land(landing, "despesas_deputados", [[claim(901, 500), claim(902, 700)]], parent=("idDeputado", 1), subdir="later")
    layers.run_all(spark, landing, lake, "2024-03-01 00:00:00")
    assert feed() == [(500.0, 1, "20240301000000"), (700.0, 1, "20240301000000")]
    layers.analyze_all(spark, lake)  # the repeated run compares with the same earlier one
    assert feed() == [(500.0, 1, "20240301000000"), (700.0, 1, "20240301000000")]
    layers.analyze_all(spark, lake, "2024-04-01 00:00:00")
    assert feed() == []
    kept = spark.read.parquet(os.path.join(lake, "gold", "b_anomalias_execucoes")).groupBy("execucao").count()
    assert kept.count() == 3
    assert runs.registry(spark, lake).select("execucao").distinct().count() == 2


def test_a_period_reads_only_its_files_and_leaves_other_years(spark, tmpdir_run):
    landing, lake = os.path.join(tmpdir_run, "landing"), os.path.join(tmpdir_run, "lake")
    for year in (2022, 2023, 2024):
        land(landing, "eventos", [[event(10 * year + i, year) for i in range(3)]], subdir=f"ano={year}")
    land(landing, "eventos", [[event(1, 2022)]])
    layers.ingest_all(spark, landing, lake)
    before = files(os.path.join(lake, "bronze", "eventos"))
    pages = envelope.read_pages(spark, os.path.join(landing, "eventos"), None, (2024, 2024))
    assert pages.count() == 2
    pages.collect()
    plan = pages._jdf.queryExecution().executedPlan()
    read = [int(n) for n in re.findall(r"number of files read: (\d+)", plan.toString())]
    found = pages.select("_arquivo").distinct().collect()
    assert len(found) == 2 and not any("2022" in r[0] or "2023" in r[0] for r in found) and all(n <= 2 for n in read)
    # a corrected page of 2024; the other years' landed files are gone from the landing zone's period
    folder = land(landing, "eventos", [[event(10 * 2024, 2024, "new text")]], subdir="ano=2024/again")
    soon = os.path.getmtime(os.path.join(folder, "page=1.json")) + 60
    os.utime(os.path.join(folder, "page=1.json"), (soon, soon))
    status = layers.ingest_all(spark, landing, lake, period=(2024, 2024))
    assert {r[2] for r in status if r[1] == "eventos"} == {"ok"}
    got = spark.read.parquet(os.path.join(lake, "bronze", "eventos"))
    assert got.count() == 10 and got.where("descricao = 'new text'").count() == 1
    kept = set(before) & set(files(os.path.join(lake, "bronze", "eventos")))
    assert any(n.startswith("ano=2023") for n in kept) and not any(n.startswith("ano=2024") for n in kept)


def test_committee_states_over_landings(spark, tmpdir_run):
    """Gold follows the inquiry committees through all landings, of their type only."""
    landing, lake = os.path.join(tmpdir_run, "landing"), os.path.join(tmpdir_run, "lake")
    state = lambda i, s, kind="CPIPC": {"id": i, "siglaTipo": kind, "statusProposicao": json.dumps({"descricaoSituacao": s})}
    days = [("d1", 10, [state(1, "Criada"), state(2, "Criada"), state(3, "Criada", "PL")]), ("d2", 7, [state(1, "Criada"), state(2, "Instalada")]), ("d3", 3, [state(1, "Encerrada")])]
    for name, ago, recs in days:
        folder = land(landing, "cpis", [recs], subdir=name)
        at = time.time() - ago * 86400
        os.utime(os.path.join(folder, "page=1.json"), (at, at))
    layers.run_all(spark, landing, lake, AS_OF)
    got = spark.read.parquet(os.path.join(lake, "gold", "b_ciclo_cpis")).orderBy("id", "inicio").collect()
    assert [(r["id"], r["situacao"], r["dias"], r["aberto"]) for r in got] == [(1, "Criada", 7, False), (1, "Encerrada", 0, True), (2, "Criada", 3, False), (2, "Instalada", 4, False)]
    # All tables in the catalog, all columns of silver and gold explained
    names = register_lake(spark, lake, "civiclake_test_")
    try:
        assert {n.removeprefix("civiclake_test_") for n in names} >= {f"{layer}_{t}" for layer in ("bronze", "silver") for t in TABLES[layer]}
        assert spark.read.table("civiclake_test_bronze_cpis").count() == 6 and spark.read.table("civiclake_test_gold_b_ciclo_cpis").count() == 4
        for name in names:
            described = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()
            assert [r[1] for r in described if r[0] == "Comment"][0]
            columns = [r for r in itertools.takewhile(lambda r: r[0] and not r[0].startswith("#"), described)]
            if "_silver_" in name or "_gold_" in name:
                assert all(r[2] for r in columns), (name, [r[0] for r in columns if not r[2]])
    finally:
        for name in names:
            spark.sql(f"DROP TABLE {name}")


# ------------------------------------------------------------------ operators
def test_status_intervals_with_gaps(spark):
    seen = [(1, D(1), "A", 0), (1, D(2), "A", 0), (1, D(2), "B", 1), (1, D(4), "B", 0), (1, D(9), "B", 0), (2, D(1), None, 0), (2, D(2), None, 0), (2, D(9), "A", 0), (3, D(4), "A", 0), (None, D(5), "A", 0), (3, None, "A", 0)]
    got = lifecycle.status_intervals(spark.createDataFrame(seen, "id long, dia date, s string, n int"), "id", ["s"], "dia", ["n"])
    # landings: 1, 2, 4, 9 (the row without id is no landing)
    assert rows(got) == sorted([
        (1, "A", D(1), D(2), 1, False), (1, "B", D(2), None, 7, True), (2, None, D(1), D(4), 3, False), (2, "A", D(9), None, 0, True), (3, "A", D(4), D(9), 5, False),
    ], key=str)
    assert lifecycle.status_intervals(spark.createDataFrame([], "id long, dia date, s string"), "id", ["s"], "dia").count() == 0


def test_merged_moments_equal_direct_statistics(spark, tmpdir_run):
    rng = random.Random(3)
    data = [(rng.choice("abc") if rng.random() < 0.95 else None, m, None if rng.random() < 0.05 else round(rng.lognormvariate(8, 2) + 1e7, 2)) for m in (1, 2, 3) for _ in range(400)] + [("solo", 1, 5.0)]
    df = spark.createDataFrame(data, "g string, mes int, v double")
    path = os.path.join(tmpdir_run, "moments")
    moments.store_moments(df.where("mes < 3"), "v", ["g"], "mes", path)
    before = files(path)
    state = moments.store_moments(df, "v", ["g"], "mes", path, parts=[3])  # a month is added
    assert set(before) < set(files(path)) and all(files(path)[n] == t for n, t in before.items())
    got = {r["g"]: r for r in moments.merged_stats(state, ["g"]).collect()}
    direct = {r["g"]: r for r in stats.group_stats(df, "v", ["g"], money=True).collect()}
    assert set(got) == set(direct)
    for g, r in direct.items():
        assert got[g]["media"] == r["media"]
        assert got[g]["desvio"] == r["desvio"] is None or got[g]["desvio"] == pytest.approx(r["desvio"], rel=1e-9)
    filtered = stats.zscore_filter(df, "v", ["g"], money=True).select("g", "v")
    merged = stats.zscore_filter(df, "v", ["g"], money=True, stats=moments.merged_stats(state, ["g"], sd_col="desvio_padrao")).select("g", "v")
    assert rows(filtered) == rows(merged)
    df.write.partitionBy("mes").parquet(os.path.join(tmpdir_run, "facts"))
    facts = spark.read.parquet(os.path.join(tmpdir_run, "facts"))
    plan = moments.part_moments(facts.where(among("mes", [3])), "v", ["g"], ["mes"])._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*mes", plan)  # the new month's files alone


def test_cells_of_new_ballots_touch_their_buckets_only(spark, tmpdir_run):
    rng = random.Random(5)
    vote = [(b, d, rng.choice(["Sim", "Nao", None])) for b in range(40) for d in range(12)] + [(None, 1, "Sim"), (3, None, "Sim")]
    votes = spark.createDataFrame(vote, "idVotacao int, deputado_id long, tipoVoto string")
    mem = spark.createDataFrame([(f, d) for f in range(4) for d in range(12) if rng.random() < 0.5] + [(0, 1), (0, 1)], "idFrente long, id long")
    dep = spark.createDataFrame([(d, "PT" if d % 2 else None) for d in range(11)], "id long, sigla_partido string")
    path = os.path.join(tmpdir_run, "cells")
    old = F.col("idVotacao").isNull() | (F.col("idVotacao") < 39)
    alignment.store_cells(votes.where(old), mem, dep, path)
    before = files(path)
    alignment.store_cells(votes, mem, dep, path, ballots=votes.where(~old))
    assert len({n.split("/")[0] for n in set(files(path)) - set(before)}) == 1
    cells = alignment.stored_cells(spark, path)
    close = lambda df: {tuple(r)[:-1]: r[-1] for r in df.collect()}
    assert close(alignment.alignment_of_cells(cells)) == pytest.approx(close(alignment.relative_alignment(votes, mem)), nan_ok=True)
    wide = {r["id_frente"]: r["PT"] for r in alignment.alignment_matrix(votes, mem, dep, ["PT"]).collect()}
    long = {r["id_frente"]: r["indice_alinhamento"] for r in alignment.matrix_of_cells(cells).where("sigla_partido = 'PT'").collect()}
    assert {k: v for k, v in wide.items() if v is not None} == pytest.approx({k: v for k, v in long.items() if v is not None})


def test_bitmap_counts_merge(spark):
    rng = random.Random(6)
    data = [(rng.choice(["a", "b", None]), rng.choice([1, 2, 3]), f"u{rng.randrange(70_000)}" if rng.random() < 0.97 else None) for _ in range(90_000)]
    df = spark.createDataFrame(data, "g string, mes int, u string").repartition(4)
    ids = distinct.dense_ids(df, "u")
    assert ids.agg(F.min("id_denso"), F.max("id_denso"), F.count("*"), F.count_distinct("id_denso")).first()[:] == (0, ids.count() - 1, ids.count(), ids.count())
    state = distinct.bitmap_state(df.join(ids, "u", "left"), ["g", "mes"], "id_denso")
    for groups in (["g", "mes"], ["g"], ["mes"], []):
        direct = df.where("u is not null").groupBy(*groups).agg(F.count_distinct("u").alias("n"))
        assert rows(distinct.distinct_counts(state, groups, "n")) == rows(direct)
    parts = distinct.bitmap_state(df.where("mes < 3").join(ids, "u"), ["g"], "id_denso").unionByName(distinct.bitmap_state(df.where("mes = 3").join(ids, "u"), ["g"], "id_denso"))
    assert rows(distinct.distinct_counts(parts, ["g"], "n")) == rows(df.where("u is not null").groupBy("g").agg(F.count_distinct("u").alias("n")))


def test_bulk_files_against_landed_records(spark, tmpdir_run):
    claim = {"ano": 2024, "mes": 1, "tipoDespesa": "T", "codDocumento": "1", "valorLiquido": "10"}
    page = [claim | {"codDocumento": str(i)} for i in range(50)]
    landing, lake = os.path.join(tmpdir_run, "landing"), os.path.join(tmpdir_run, "lake")
    land(landing, "despesas_deputados", [page], parent=("idDeputado", 5))
    layers.ingest_all(spark, landing, lake)
    csv = os.path.join(tmpdir_run, "bulk.csv")
    with open(csv, "w") as fh:
        fh.write("idDeputado,ano,mes,tipoDespesa,codDocumento,valorLiquido,nova\n")
        fh.writelines(f"5,2024,1,T,{i},{11 if i == 7 else 10},x\n" for i in range(51) if i not in (3, 9))
    got = layers.compare_bulk(spark, lake, "despesas_deputados", csv, keys=["idDeputado", "codDocumento"])
    assert rows(got) == [(5, "3", 1, 0, "so_esquerda"), (5, "50", 0, 1, "so_direita"), (5, "7", 1, 1, "diferente"), (5, "9", 1, 0, "so_esquerda")]
    assert read_bulk(spark, csv, BRONZE["despesas_deputados"].schema).count() == 49


def test_equal_buckets_are_not_compared(spark):
    left = spark.range(20_000).selectExpr("id as k", "cast(id % 7 as string) as v")
    right = left.withColumn("v", F.when(F.col("k").isin(5, 77), "changed").otherwise(F.col("v")))
    assert reconcile.differing_buckets(left, right, ["k"], ["v"], 512).count() == 2
    assert rows(reconcile.differences(left, right, ["k"], ["v"], 512)) == [(5, 1, 1, "diferente"), (77, 1, 1, "diferente")]
    twice = left.unionByName(left.where("k = 9")).unionByName(spark.createDataFrame([(None, None), (None, "a")], "k long, v string"))
    assert rows(reconcile.differences(left, twice, ["k"], ["v"], 512)) == sorted([(9, 1, 2, "diferente"), (None, 0, 2, "so_direita")], key=str)
    assert reconcile.differences(twice, twice.repartition(3), ["k"], ["v"]).count() == 0
    assert reconcile.differences(left.limit(0), left.limit(0), ["k"], ["v"]).count() == 0


def test_calendar_months_include_idle_ones(spark):
    acts = [(1, "2023-11-05"), (1, "2023-11-06"), (1, "2024-02-01"), (1, "2024-03-01"), (2, "2024-01-01"), (2, None)]
    got = engagement.engagement_calendar(spark.createDataFrame(acts, "deputado_id long, d string").withColumn("data_votacao", F.col("d").cast("timestamp")))
    assert rows(got) == sorted([
        (1, 2023, 11, 2, None, None), (1, 2023, 12, 0, 2, -2), (1, 2024, 1, 0, 0, 0), (1, 2024, 2, 1, 0, 1), (1, 2024, 3, 1, 1, 0), (2, 2024, 1, 1, None, None),
    ], key=str)


def test_regions(spark):
    assert sum(len(u.split()) for u in REGIONS.values()) == 27
    df = spark.createDataFrame([("SP",), ("BA",), ("XX",), (None,)], "uf string").select("uf", region_of("uf").alias("r"))
    assert {r["uf"]: r["r"] for r in df.collect()} == {"SP": "Sudeste", "BA": "Nordeste", "XX": None, None: None}
