"""Landed pages -> bronze -> silver -> gold, sinks and streaming (S*, W*, V*, X7)."""

from __future__ import annotations

import os

from conftest import land
from pyspark.sql import functions as F

from civiclake.operators import quality
from civiclake.schemas import BRONZE, DESPESAS, FRENTES_MEMBROS
from civiclake.sinks import writers
from civiclake.sinks.published import publish, read_published
from civiclake.sources import envelope

AS_OF = "2024-12-31 00:00:00"


def test_pages_all_records_once_and_completeness(spark, tmpdir_run):
    land(tmpdir_run, "frentes", [[{"id": 1, "titulo": "a"}], [{"id": 2, "titulo": "b"}], [{"id": 3, "titulo": "c"}]])
    pages = envelope.read_pages(spark, os.path.join(tmpdir_run, "frentes"))
    recs, rej = envelope.bronze(spark, tmpdir_run, BRONZE["frentes"])
    assert sorted(r["id"] for r in recs.collect()) == [1, 2, 3] and rej.count() == 0
    c = envelope.page_completeness(pages).first()
    assert (c["paginas"], c["ultima_pagina"], c["completo"]) == (3, 3, True)


def test_missing_page_reported(spark, tmpdir_run):
    land(tmpdir_run, "frentes", [[{"id": 1}], [{"id": 2}], [{"id": 3}], [{"id": 4}]], skip=(3,))
    c = envelope.page_completeness(envelope.read_pages(spark, os.path.join(tmpdir_run, "frentes"))).first()
    assert c["faltando"] == 1 and c["completo"] is False
    land(tmpdir_run, "votacoes", [[{"id": "a"}], [{"id": "b"}]], next_on_last=True)  # last page still says next
    c2 = envelope.page_completeness(envelope.read_pages(spark, os.path.join(tmpdir_run, "votacoes"))).first()
    assert c2["ultima_tem_proxima"] is True and c2["completo"] is False


def test_double_landed_expense_page(spark, tmpdir_run):
    p1 = [{"tipoDespesa": "T", "numDocumento": "1", "cnpjCpfFornecedor": "9", "dataDocumento": "2024-01-02", "valorDocumento": 10,
           "valorLiquido": 10}]
    p2 = [{"tipoDespesa": "T", "numDocumento": "2", "cnpjCpfFornecedor": "9", "dataDocumento": "2024-01-03", "valorDocumento": "12.50",
           "valorLiquido": "12.50"}]
    land(tmpdir_run, "despesas_deputados", [p1, p2], parent=("idDeputado", 7))
    land(tmpdir_run, "despesas_deputados", [p1, p2], parent=("idDeputado", 7), subdir="retry")  # whole fetch landed twice
    recs, _ = envelope.bronze(spark, tmpdir_run, BRONZE["despesas_deputados"])
    rows = recs.collect()
    assert len(rows) == 2 and {r["idDeputado"] for r in rows} == {7}  # FK stamped from the path
    assert sorted(r["valorLiquido"] for r in rows) == ["10", "12.50"]


def test_drifted_members(spark, tmpdir_run):
    land(tmpdir_run, "frentes_membros", [[{"id": 1}, {"id": 2, "nome": "b", "novo": {"x": 1}}, {"nome": "sem id"}]],
         parent=("idFrente", 5))
    recs, rej = envelope.bronze(spark, tmpdir_run, BRONZE["frentes_membros"])
    got = {r["id"]: r for r in recs.collect()}
    assert got[1]["nome"] is None and got[1]["idFrente"] == 5
    assert got[2]["_extra"] == '{"novo":"{\\"x\\":1}"}'
    assert [r["nome"] for r in rej.collect()] == ["sem id"]


def test_empty_endpoint_typed(spark, tmpdir_run):
    land(tmpdir_run, "cpis", [[]])
    recs, _ = envelope.bronze(spark, tmpdir_run, BRONZE["cpis"])
    assert recs.count() == 0 and "siglaTipo" in recs.columns
    e = envelope.empty(spark, FRENTES_MEMBROS)
    assert e.schema == FRENTES_MEMBROS and e.count() == 0


def test_conform_missing_and_unknown(spark):
    df = spark.createDataFrame([("7", "x", "extra")], "idDeputado string, tipoDespesa string, outra string")
    c = envelope.conform(df, DESPESAS)
    r = c.first()
    assert r["idDeputado"] == 7 and r["valorLiquido"] is None and r["_extra"] == '{"outra":"extra"}'


def test_pending_parents_manifest(spark):
    parents = spark.createDataFrame([(1,), (2,), (3,)], "id long")
    landed = spark.createDataFrame([(2,)], "id long")
    assert sorted(r[0] for r in quality.pending_parents(parents, landed, "id").collect()) == [1, 3]


def _land_domain(root):
    land(root, "deputados", [[{"id": 1, "nome": " Ana ", "siglaPartido": " pt", "siglaUf": "sp", "ultimoStatus": '{"nome": "Ana"}'},
                              {"id": 2, "nome": "Bia", "siglaPartido": "PL", "siglaUf": "RJ"}],
                             [{"id": 3, "nome": "Caio", "siglaPartido": "", "siglaUf": None}]])
    land(root, "frentes", [[{"id": 10, "titulo": " Frente A ", "coordenador": {"id": 1, "nome": "Ana"}}, {"id": 11, "titulo": "B"}]])
    land(root, "frentes_membros", [[{"id": 1}, {"id": 2}]], parent=("idFrente", 10))
    land(root, "frentes_membros", [[{"id": 3}, {"id": 3}]], parent=("idFrente", 11))
    land(root, "eventos", [[{"id": 100, "dataHoraInicio": "2024-03-01T10:00", "dataHoraFim": "2024-03-01T12:00", "descricaoTipo": "Sessão",
                             "orgaos": [{"id": "1", "sigla": "PLEN", "nome": "Plenário"}, {"id": "2", "sigla": "CCJ", "nome": "CCJ"}],
                             "presenca": [{"id": 1}, {"id": 2}]},
                            {"id": 101, "dataHoraInicio": "bad", "descricaoTipo": "Audiência", "orgaos": []},
                            {"id": 100, "dataHoraInicio": "2024-03-01T10:00", "descricaoTipo": "Sessão"}]])
    land(root, "votacoes", [[{"id": "v1", "data": "2024-03-02T15:00", "descricao": " PL 1 ", "siglaOrgao": "PLEN"}]])
    land(root, "votos_deputados", [[{"deputado_": {"id": 1, "nome": "Ana"}, "tipoVoto": "Sim"},
                                    {"deputado_": {"id": 2}, "tipoVoto": "Não"}]], parent=("idVotacao", "v1"))
    land(root, "despesas_deputados", [[{"tipoDespesa": "Passagem", "numDocumento": "1", "dataDocumento": "2024-02-01",
                                        "valorLiquido": "100.10", "nomeFornecedor": " Cia "},
                                       {"tipoDespesa": "Passagem", "numDocumento": "2", "dataDocumento": "2024-02-03",
                                        "valorLiquido": "-5", "nomeFornecedor": "Cia"}]], parent=("idDeputado", 1))


def test_layers_end_to_end(spark, tmpdir_run):
    from civiclake.plans.layers import run_all

    landing = os.path.join(tmpdir_run, "landing")
    out = os.path.join(tmpdir_run, "lake")
    _land_domain(landing)
    status = {(r["camada"], r["tabela"]): r for r in run_all(spark, landing, out, AS_OF).collect()}
    assert all(r["status"] == "ok" for k, r in status.items() if k != ("bronze", "cpis")), [r for r in status.values() if r["status"] != "ok"]
    assert status[("bronze", "cpis")]["status"] == "vazio" and status[("bronze", "cpis")]["linhas"] == 0  # nothing landed: empty typed table
    assert status[("bronze", "eventos")]["linhas"] == 2  # duplicate event id landed twice on the page
    assert status[("silver", "fact_despesas")]["linhas"] == 1 and status[("silver", "fact_despesas_rejeitadas")]["linhas"] == 1
    assert status[("silver", "dim_partidos")]["linhas"] == 2
    assert status[("silver", "dim_orgao")]["linhas"] == 2
    ev = spark.read.parquet(os.path.join(out, "silver", "fato_evento")).orderBy("id_evento").collect()
    assert ev[0]["duracao_horas"] == 2.0 and ev[0]["qtde_presencas"] == 2 and ev[1]["qtde_presencas"] is None
    assert os.path.isdir(os.path.join(out, "silver", "fact_despesas", "ano=2024", "mes=2"))
    votes = spark.read.parquet(os.path.join(out, "silver", "fact_votacoes")).collect()
    assert sorted(r["deputado_id"] for r in votes) == [1, 2] and votes[0]["descricao"] == "PL 1"
    div = {r["idFrente"]: r["indice_diversidade"] for r in spark.read.parquet(os.path.join(out, "gold", "b_diversidade_partidaria_frentes")).collect()}
    assert div[10] == 0.5 and div[11] == 0.0
    assert os.path.isdir(os.path.join(out, "bronze", "eventos", "ano=2024"))  # S13
    pres = {r["id_deputado"]: r["taxa_presenca"] for r in spark.read.parquet(os.path.join(out, "gold", "b_taxa_presenca")).collect()}
    assert pres == {1: 1.0, 2: 1.0}  # both present at the only event that has a presence list
    org = {r["orgao"]: r["qtde_eventos"] for r in spark.read.parquet(os.path.join(out, "gold", "b_eventos_semana_orgao")).collect()}
    assert org == {"PLEN": 1, "CCJ": 1}  # X5 by organ (week 9 of 2024)
    atlas = spark.read.parquet(os.path.join(out, "gold", "b_atlas_frentes")).where("idFrente = 10").orderBy("id_deputado").collect()
    assert [(r["titulo"], r["sigla_partido"]) for r in atlas] == [("Frente A", "PT"), ("Frente A", "PL")]
    unparsed = {r["coluna"]: r["nao_convertidos"] for r in spark.read.parquet(os.path.join(out, "audit", "nao_convertidos_despesas")).collect()}
    assert unparsed == {"valor_liquido": 0, "valor_documento": 0, "data_documento": 0}
    pages = spark.read.parquet(os.path.join(out, "audit", "paginas_deputados")).first()
    assert pages["completo"] is True and pages["paginas"] == 2


def test_bronze_error_isolation(spark, tmpdir_run):
    from civiclake.plans.layers import run_layer

    def boom():
        raise ValueError("endpoint down")

    rows = run_layer(spark, "bronze", {"ok": lambda: spark.range(3), "bad": boom}, tmpdir_run, isolate_errors=True)
    assert [(r[1], r[2], r[3]) for r in rows] == [("ok", "ok", 3), ("bad", "falha", None)]


def test_tables_bulk_and_predicates(spark, tmpdir_run):
    from civiclake.sources import tables

    p = os.path.join(tmpdir_run, "despesas.csv")
    with open(p, "w") as fh:
        fh.write("idDeputado,tipoDespesa,valorLiquido,coluna_nova\n7,T,12.50,x\n8,U,bad,y\n")
    df = tables.read_bulk(spark, p, DESPESAS)
    rows = {r["idDeputado"]: r for r in df.collect()}
    assert rows[7]["valorLiquido"] == "12.50" and rows[8]["_extra"] == '{"coluna_nova":"y"}'
    d = spark.createDataFrame([("2023-12-31",), ("2024-06-01",), ("2025-01-01",)], "d string").select(F.col("d").cast("date").alias("d"))
    assert d.where(tables.period("d", year=2024)).count() == 1
    assert d.where(tables.period("d", start="2024-01-01")).count() == 2
    cp = spark.createDataFrame([(1, "CPIPC"), (2, "PL")], "id long, siglaTipo string")
    assert [r[0] for r in cp.where(tables.of_type("siglaTipo")).collect()] == [1]
    path = os.path.join(tmpdir_run, "tbl")
    writers.write_path(cp, path)
    assert tables.read_path(spark, path).count() == 2
    spark.sql("DROP TABLE IF EXISTS silver_cpis")
    writers.register_table(spark, "silver_cpis", path)
    assert tables.read_table(spark, "silver", "cpis").count() == 2
    spark.sql("DROP TABLE IF EXISTS silver_cpis")


def test_a_written_report_is_not_sorted_unless_it_is_cut(spark, tmpdir_run):
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    per = spark.range(100).groupBy((F.col("id") % 7).alias("k")).count()
    ranked = per.orderBy(F.desc("count"), "k")
    assert "Sort" in plan(ranked) and "Sort" not in plan(writers.arranged(ranked, rebalance=True))
    assert "Sort" not in plan(writers.arranged(ranked, ["k"]))
    assert "Sort" in plan(writers.arranged(ranked)), "asked for nothing"
    top = writers.arranged(ranked.limit(2), rebalance=True)
    assert "Sort" in plan(top)
    path = os.path.join(tmpdir_run, "top")
    assert writers.write_path(top, path, rebalance=True) == 2
    assert sorted(r["k"] for r in spark.read.parquet(path).collect()) == [0, 1]
    # empty frames are counted too, and a published report has all its rows
    assert writers.write_path(per.where("k > 7").orderBy("k"), os.path.join(tmpdir_run, "none"), rebalance=True) == 0
    version = publish(ranked, os.path.join(tmpdir_run, "all"), rebalance=True)
    assert version.total == 7 and read_published(spark, os.path.join(tmpdir_run, "all")).agg(F.sum("count")).first()[0] == 100


def test_sink_observes_rows_and_comments(spark, tmpdir_run):
    df = spark.range(5).withColumn("ano", F.lit(2024)).withColumn("mes", (F.col("id") % 2).cast("int"))
    n = writers.write_path(df, os.path.join(tmpdir_run, "t"), partition_by=("ano", "mes"))
    assert n == 5 and spark.read.parquet(os.path.join(tmpdir_run, "t")).count() == 5
    name = "civiclake_test_cmt"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    writers.save_table(spark.createDataFrame([(1, "a")], FRENTES_MEMBROS.fields[0].name + " long, nome string"), name)
    writers.comment_table(spark, name, "members of fronts")
    writers.comment_columns(spark, name, FRENTES_MEMBROS)
    desc = {r[0]: r[2] for r in spark.sql(f"DESCRIBE TABLE {name}").collect()}
    assert desc["idFrente"] == "front id (from the landing path)"
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_streaming_incremental_ingest(spark, tmpdir_run):
    from civiclake.streaming import start_ingest

    landing = os.path.join(tmpdir_run, "landing")
    land(landing, "votacoes", [[{"id": "a"}, {"id": "b"}]])
    land(landing, "votacoes", [[{"id": "b"}, {"id": "c"}]], subdir="again")
    target, ckpt = os.path.join(tmpdir_run, "bronze_votacoes"), os.path.join(tmpdir_run, "ckpt")
    q = start_ingest(spark, landing, BRONZE["votacoes"], target, ckpt)
    q.awaitTermination(120)
    got = sorted(r["id"] for r in spark.read.parquet(target).collect())
    assert got == ["a", "b", "c"]


def test_cli_runs_layers_step_by_step(spark, tmpdir_run, capsys):
    from civiclake.__main__ import main

    landing, lake = os.path.join(tmpdir_run, "landing"), os.path.join(tmpdir_run, "lake")
    _land_domain(landing)
    main(["ingest", "--landing", landing, "--lake", lake])
    main(["transform", "--lake", lake, "--as-of", AS_OF])
    main(["analyze", "--lake", lake])
    lines = [ln.split("\t") for ln in capsys.readouterr().out.strip().splitlines()]
    assert {ln[0] for ln in lines} == {"bronze", "silver", "gold"}
    assert all(ln[2] in ("ok", "vazio") for ln in lines)
    top = spark.read.parquet(os.path.join(lake, "gold", "b_engajamento_deputados")).orderBy("id").collect()
    assert [r["qtde_votacoes"] for r in top] == [1, 1, 0]


def test_partitioned_rerun_replaces_only_its_partitions(spark, tmpdir_run):
    path = os.path.join(tmpdir_run, "fact")
    first = spark.createDataFrame([(1, 2024, 1, 10.0), (2, 2024, 2, 20.0)], "id long, ano int, mes int, v double")
    writers.write_path(first, path, partition_by=("ano", "mes"))
    rerun = spark.createDataFrame([(3, 2024, 2, 30.0)], "id long, ano int, mes int, v double")  # February reloaded
    writers.write_path(rerun, path, partition_by=("ano", "mes"), replace="partitions")
    got = sorted((r["id"], r["mes"]) for r in spark.read.parquet(path).collect())
    assert got == [(1, 1), (3, 2)]  # January kept, February replaced


def test_corrupt_page_is_not_complete(spark, tmpdir_run):
    d = land(tmpdir_run, "frentes", [[{"id": 1}], [{"id": 2}]])
    with open(os.path.join(d, "page=2.json"), "w") as fh:
        fh.write('{"dados": [{"id": 2}, ')  # truncated landing
    pages = envelope.read_pages(spark, os.path.join(tmpdir_run, "frentes"))
    c = envelope.page_completeness(pages).first()
    assert (c["paginas"], c["corrompidas"], c["completo"]) == (2, 1, False)
    recs, _ = envelope.bronze(spark, tmpdir_run, BRONZE["frentes"])
    assert [r["id"] for r in recs.collect()] == [1]  # the readable page still loads


def test_layers_with_only_one_endpoint_landed(spark, tmpdir_run):
    from civiclake.plans.layers import run_all

    landing, out = os.path.join(tmpdir_run, "landing"), os.path.join(tmpdir_run, "lake")
    land(landing, "deputados", [[{"id": 1, "nome": "Ana", "siglaPartido": "PT", "siglaUf": "SP"}]])
    status = run_all(spark, landing, out, AS_OF).collect()
    bad = [r for r in status if r["status"] not in ("ok", "vazio")]
    assert not bad, bad
    eng = spark.read.parquet(os.path.join(out, "gold", "b_engajamento_deputados")).collect()
    assert [(r["id"], r["score_engajamento"]) for r in eng] == [(1, 0.0)]


def test_streaming_is_incremental_on_rerun(spark, tmpdir_run):
    from civiclake.streaming import start_ingest

    landing = os.path.join(tmpdir_run, "landing")
    target, ckpt = os.path.join(tmpdir_run, "bronze_frentes"), os.path.join(tmpdir_run, "ckpt")
    land(landing, "frentes", [[{"id": 1}, {"id": 2}]])
    start_ingest(spark, landing, BRONZE["frentes"], target, ckpt).awaitTermination(120)
    start_ingest(spark, landing, BRONZE["frentes"], target, ckpt).awaitTermination(120)  # nothing new landed
    assert sorted(r["id"] for r in spark.read.parquet(target).collect()) == [1, 2]
    land(landing, "frentes", [[{"id": 3}]], subdir="day2")
    start_ingest(spark, landing, BRONZE["frentes"], target, ckpt).awaitTermination(120)
    assert sorted(r["id"] for r in spark.read.parquet(target).collect()) == [1, 2, 3]


def test_full_rebuild_leaves_no_stale_partition(spark, tmpdir_run):
    path = os.path.join(tmpdir_run, "fact")
    writers.write_path(spark.createDataFrame([(1, 2023), (2, 2023)], "id long, ano int"), path, partition_by=("ano",))
    writers.write_path(spark.createDataFrame([(1, 2024)], "id long, ano int"), path, partition_by=("ano",))
    assert [(r["id"], r["ano"]) for r in spark.read.parquet(path).collect()] == [(1, 2024)]  # moved, not doubled
    schema = spark.read.parquet(path).schema
    writers.write_path(spark.createDataFrame([], schema), path, partition_by=("ano",))
    assert spark.read.schema(schema).parquet(path).count() == 0


def test_votes_without_deputy_are_kept_and_changed_texts_merge(spark, tmpdir_run):
    page = [{"tipoVoto": "Sim"}, {"tipoVoto": "Sim"}, {"tipoVoto": "Nao", "deputado_": None},
            {"tipoVoto": "Sim", "deputado_": '{"id": 7, "urlFoto": "a"}'}]
    land(tmpdir_run, "votos_deputados", [page], parent=("idVotacao", "v1"))
    land(tmpdir_run, "votos_deputados", [[*page[:3], {"tipoVoto": "Sim", "deputado_": '{"id": 7, "urlFoto": "b"}'}]], parent=("idVotacao", "v1"), subdir="again")
    recs, rej = envelope.bronze(spark, tmpdir_run, BRONZE["votos_deputados"])
    got = sorted((r["tipoVoto"], r["deputado_"] is None) for r in recs.collect())
    assert got == [("Nao", True), ("Sim", False), ("Sim", True), ("Sim", True)] and rej.count() == 0


def test_claims_that_differ_in_any_field_are_kept(spark, tmpdir_run):
    base = {"tipoDespesa": "T", "dataDocumento": "2024-01-02", "valorDocumento": 10, "valorLiquido": 10}
    page = [{**base, "codDocumento": "100"}, {**base, "codDocumento": "101"}, {**base, "codDocumento": "101"}]
    land(tmpdir_run, "despesas_deputados", [page], parent=("idDeputado", 5))
    recs, _ = envelope.bronze(spark, tmpdir_run, BRONZE["despesas_deputados"])
    assert sorted(r["codDocumento"] for r in recs.collect()) == ["100", "101"]


def test_rejects_keep_their_text_and_bad_values_are_named(spark, tmpdir_run):
    land(tmpdir_run, "deputados", [[{"id": "abc", "nome": "X"}, {"id": 1, "nome": "Ana", "idLegislatura": "oops"}, {"nome": "no id"}, {"id": 2, "nome": None}]])
    recs, rej = envelope.bronze(spark, tmpdir_run, BRONZE["deputados"])
    assert {r["id"]: r["_invalidos"] for r in recs.collect()} == {1: "idLegislatura", 2: None}
    got = sorted((r["_motivo"], r["_invalidos"], "abc" in r["_raw"]) for r in rej.select("_motivo", F.coalesce("_invalidos", F.lit("")).alias("_invalidos"), "_raw").collect())
    assert got == [("sem id", "", False), ("sem id", "id", True)]


def test_landed_rows_are_accepted_rejected_or_duplicates(spark, tmpdir_run):
    spec = BRONZE["despesas_deputados"]
    rows = [{"codDocumento": str(i % 7), "valorLiquido": i % 2} for i in range(60)]
    land(tmpdir_run, spec.name, [rows[:30], rows[30:]], parent=("idDeputado", 5))
    land(tmpdir_run, spec.name, [[{"valorLiquido": 1}, {"idDeputado": 9}]])  # no parent in the path
    recs = envelope.records(envelope.read_pages(spark, os.path.join(tmpdir_run, spec.name), spec.parent), spec.schema, spec.parent, raw=True)
    accepted, rejected = envelope.split_accepted(recs, spec)
    kept = envelope.latest(accepted, spec)
    doubles = accepted.groupBy(*spec.natural_key).count().selectExpr("sum(count - 1)").first()[0]
    assert (recs.count(), rejected.count(), kept.count(), doubles) == (62, 1, 15, 46)


def test_pages_without_number_and_parents_without_pages_are_reported(spark, tmpdir_run):
    d = land(tmpdir_run, "frentes_membros", [[{"id": 1}]], parent=("idFrente", 1))
    os.rename(os.path.join(d, "page=1.json"), os.path.join(d, "dump.json"))
    land(tmpdir_run, "frentes_membros", [[{"id": 1}]], parent=("idFrente", 2))
    pages = envelope.read_pages(spark, os.path.join(tmpdir_run, "frentes_membros"), "idFrente")
    parents = spark.createDataFrame([(1,), (2,), (3,)], "parent long")
    got = {r["parent"]: (r["paginas"], r["sem_numero"], r["completo"]) for r in envelope.page_completeness(pages, parents).collect()}
    assert got == {"1": (0, 1, False), "2": (1, 0, True), "3": (0, 0, False)}


def test_period_has_the_whole_last_day(spark):
    from civiclake.sources.tables import period, years

    df = spark.sql("select timestamp'2024-12-31 15:00:00' t, 2024 ano union all select timestamp'2025-01-01 00:00:00', 2025 union all select timestamp'2023-12-31 23:59:59', 2023")
    assert [str(r["t"]) for r in df.where(period("t", year=2024)).collect()] == ["2024-12-31 15:00:00"]
    assert df.where(period("t", end="2024-12-31")).count() == 2
    assert [r["ano"] for r in df.where(years("ano", 2024)).collect()] == [2024] and df.where(years("ano", 2023, 2024)).count() == 2


def test_organ_dimension_has_one_row_a_key(spark):
    from civiclake.plans.silver import event_dims

    organ = "struct<id:string,sigla:string,nome:string>"
    rows = [(1, "2024-01-01T10:00", "T", [("9", "CCJ", "Comissao")], None), (2, "2024-01-02T10:00", "T", [("9", "CCJ", "COMISSAO X")], None),
            (3, "2024-01-03T10:00", "T", [], ("8", "PLEN", "Plenario")), (4, None, None, None, None)]
    ev = spark.createDataFrame(rows, f"id long, dataHoraInicio string, descricaoTipo string, orgaos array<{organ}>, orgao {organ}")
    got = event_dims(ev)["dim_orgao"].collect()
    assert sorted(r["id_orgao"] for r in got) == ["8", "9"] and len({r["id_orgao_dim"] for r in got}) == 2


def test_stream_equals_batch_with_late_double_and_corrected_pages(spark, tmpdir_run):
    """Landed late, twice and corrected: the stream's table is the batch build's, row for row."""
    import time

    from civiclake.streaming import refresh, start_ingest
    from civiclake.streaming.incremental import batch_folders

    landing, spec = os.path.join(tmpdir_run, "landing"), BRONZE["eventos"]
    target, ckpt = os.path.join(tmpdir_run, "bronze", "eventos"), os.path.join(tmpdir_run, "ckpt")

    def run():
        start_ingest(spark, landing, spec, target, ckpt).awaitTermination(120)

    land(landing, "eventos", [[{"id": 1, "descricao": "first", "dataHoraInicio": "2024-01-01T10:00"}], [{"id": 2, "dataHoraInicio": "2023-05-01T10:00"}]])
    run()
    late = land(landing, "eventos", [[{"id": 3, "descricao": "late"}, {"descricao": "no id"}]], subdir="backfill")
    old = time.time() - 5 * 86400
    os.utime(os.path.join(late, "page=1.json"), (old, old))
    land(landing, "eventos", [[{"id": 1, "descricao": "corrected", "dataHoraInicio": "2025-01-01T10:00"}], [{"id": 2, "dataHoraInicio": "2023-05-01T10:00"}]], subdir="day2")
    run()
    cols = ["id", "descricao", "ano", "_arquivo", "_chegada"]
    batch = envelope.with_year(envelope.bronze(spark, landing, spec)[0], spec).select(cols)
    stream = spark.read.parquet(target).select(cols)
    key = lambda r: r["id"]
    assert sorted(map(tuple, stream.collect())) == sorted(map(tuple, batch.collect()), key=lambda r: r[0])
    assert {r["id"]: r["descricao"] for r in stream.collect()} == {1: "corrected", 2: None, 3: "late"}
    assert [r["ano"] for r in sorted(stream.collect(), key=key)] == [2025, 2023, None]  # the corrected event left 2024
    rejects = spark.read.parquet(batch_folders(target)[1]).collect()
    assert [(r["_motivo"], "no id" in r["_raw"]) for r in rejects] == [("sem id", True)]
    before = sorted(map(tuple, stream.collect()))
    run()  # nothing new
    assert refresh(spark, spec, target) == 3  # a replayed batch changes nothing
    assert sorted(map(tuple, spark.read.parquet(target).select(cols).collect())) == before


def test_cli_stream_step_feeds_the_layers(spark, tmpdir_run, capsys):
    from civiclake.__main__ import main

    landing, lake = os.path.join(tmpdir_run, "landing"), os.path.join(tmpdir_run, "lake")
    land(landing, "deputados", [[{"id": 1, "nome": "Ana"}]])
    main(["stream", "--landing", landing, "--lake", lake])
    lines = {ln.split("\t")[1]: ln.split("\t") for ln in capsys.readouterr().out.strip().splitlines()}
    assert lines["deputados"][2:4] == ["ok", "1"] and lines["cpis"][2] == "vazio"
    assert spark.read.schema(layers_schema("deputados")).parquet(os.path.join(lake, "bronze", "deputados")).first()["nome"] == "Ana"


def layers_schema(name):
    from civiclake.plans.layers import bronze_schema

    return bronze_schema(BRONZE[name])


def test_audit_reconciles_and_reports_pending_parents(spark, tmpdir_run):
    from civiclake.plans.layers import run_all

    landing, out = os.path.join(tmpdir_run, "landing"), os.path.join(tmpdir_run, "lake")
    _land_domain(landing)
    run_all(spark, landing, out, AS_OF)
    rec = {r["tabela"]: r for r in spark.read.parquet(os.path.join(out, "audit", "reconciliacao")).collect()}
    assert all(r["registros"] == r["rejeitados"] + r["duplicados"] + r["gravados"] for r in rec.values())
    assert (rec["eventos"]["registros"], rec["eventos"]["duplicados"]) == (3, 1) and rec["frentes_membros"]["duplicados"] == 1
    assert [tuple(r) for r in spark.read.parquet(os.path.join(out, "audit", "duplicados_eventos")).collect()] == [(100, 2)]
    pages = {r["parent"]: (r["paginas"], r["completo"]) for r in spark.read.parquet(os.path.join(out, "audit", "paginas_despesas_deputados")).collect()}
    assert pages == {"1": (1, True), "2": (0, False), "3": (0, False)}  # two deputies' expenses have not landed


def test_second_run_keeps_history(spark, tmpdir_run):
    """A party change gives two versions, one current; reports use the current one; a repeated run changes nothing."""
    from civiclake.plans.layers import analyze_all, ingest_all, transform_all

    landing, out = os.path.join(tmpdir_run, "landing"), os.path.join(tmpdir_run, "lake")
    _land_domain(landing)
    ingest_all(spark, landing, out)
    transform_all(spark, out, "2024-01-01 00:00:00")
    land(landing, "deputados", [[{"id": 1, "nome": " Ana ", "siglaPartido": "psd", "siglaUf": "sp"}]], subdir="later")
    later = os.path.join(landing, "deputados", "later", "page=1.json")
    os.utime(later, (os.path.getmtime(later) + 60,) * 2)
    ingest_all(spark, landing, out)
    for _ in range(2):
        transform_all(spark, out, "2024-06-01 00:00:00")
        dep = spark.read.parquet(os.path.join(out, "silver", "dim_deputado")).where("id_deputado = 1").orderBy("valid_from").collect()
        assert [(r["sigla_partido"], str(r["valid_from"])[:10], r["valid_to"] and str(r["valid_to"])[:10], r["is_current"]) for r in dep] == [
            ("PT", "2024-01-01", "2024-06-01", False), ("PSD", "2024-06-01", None, True),
        ]
        assert spark.read.parquet(os.path.join(out, "silver", "dim_partido")).where("is_current").count() == 3
    assert all(r[2] == "ok" for r in analyze_all(spark, out))
    assert spark.read.parquet(os.path.join(out, "gold", "a_deputados_mais_frentes")).count() == 3


def test_claims_that_differ_in_unknown_or_malformed_fields_stay(spark, tmpdir_run):
    claim = {"tipoDespesa": "A", "numDocumento": "1", "valorLiquido": "5"}
    page = [claim | {"parcela": 1}, claim | {"parcela": 2}, claim | {"mes": "x"}, claim | {"mes": "y"}, claim]
    land(tmpdir_run, "despesas_deputados", [page], parent=("idDeputado", 5))
    land(tmpdir_run, "despesas_deputados", [page], parent=("idDeputado", 5), subdir="retry")
    recs, _ = envelope.bronze(spark, tmpdir_run, BRONZE["despesas_deputados"])
    assert sorted(r["_extra"] or "" for r in recs.collect()) == ["", '{"mes":"x"}', '{"mes":"y"}', '{"parcela":"1"}', '{"parcela":"2"}']
