"""Gold metrics on hand-computed fixtures (FIXTURES §3) and properties."""

from __future__ import annotations

import datetime as dt

import pytest

from civiclake.functions.clean import clean_text
from civiclake.functions.keys import surrogate_key
from civiclake.operators import alignment, diversity, engagement, reports, stats
from civiclake.operators.dims import extract_dim
from civiclake.operators.joins import dimension_lookup
from civiclake.session import Scratch


def test_diversity_fixture(spark):
    members = spark.createDataFrame(
        [("A", 1), ("A", 2), ("A", 3), ("B", 4), ("B", 5), ("B", 6), ("B", 7), ("C", 8), ("C", 9), ("C", 10), ("C", 11)],
        "idFrente string, id long",
    )
    deps = spark.createDataFrame(
        [(1, "X"), (2, "X"), (3, "X"), (4, "P"), (5, "Q"), (6, "R"), (7, "S"), (8, "X"), (9, "X"), (10, None), (11, None)],
        "id long, sigla_partido string",
    )
    fronts = spark.createDataFrame([("A", "a"), ("B", "b"), ("C", "c")], "id string, titulo string")
    out = {r["idFrente"]: r for r in diversity.front_diversity(members, deps, fronts).collect()}
    assert out["A"]["indice_diversidade"] == pytest.approx(0.0)
    assert out["B"]["indice_diversidade"] == pytest.approx(0.75)
    assert out["C"]["indice_diversidade"] == pytest.approx(0.5)  # NULL party is one bucket
    assert out["C"]["qtde_partidos"] == 1 and out["C"]["total_membros"] == 4
    # uniform k-way split gives 1 - 1/k
    assert out["B"]["indice_diversidade"] == pytest.approx(1 - 1 / 4)


def test_diversity_drops_null_group(spark):
    m = spark.createDataFrame([(None, "X"), ("A", "X")], "g string, p string")
    rows = diversity.diversity_index(m, "g", "p").collect()
    assert [r["g"] for r in rows] == ["A"]


def _votes(spark, rows):
    return spark.createDataFrame(rows, "deputado_id long, idVotacao string, tipoVoto string")


def test_alignment_equal_to_house_is_one(spark):
    votes = _votes(spark, [(1, "v1", "Sim"), (2, "v1", "Nao"), (1, "v2", "Sim"), (2, "v2", "Sim")])
    mem = spark.createDataFrame([("F", 1), ("F", 2)], "idFrente string, id long")
    r = alignment.relative_alignment(votes, mem).first()
    assert r["indice_alinhamento_medio"] == pytest.approx(1.0)


def test_alignment_cohesive_front(spark):
    votes = _votes(spark, [(1, "v1", "Sim"), (2, "v1", "Sim"), (3, "v1", "Nao"), (4, "v1", "Nao")])
    mem = spark.createDataFrame([("F", 1), ("F", 2), ("F", 1)], "idFrente string, id long")  # duplicate membership
    r = alignment.relative_alignment(votes, mem).first()
    assert r["indice_alinhamento_medio"] == pytest.approx(2.0)


def test_alignment_shares_sum_to_one(spark):
    votes = _votes(spark, [(i, f"v{i % 3}", ["a", "b", "c"][i % 2]) for i in range(30)])
    mem = spark.createDataFrame([("F", i) for i in range(0, 30, 2)] + [("G", i) for i in range(1, 30, 3)], "idFrente string, id long")
    shares = alignment.front_option_shares(votes, mem)
    sums = shares.groupBy("idFrente", "idVotacao").sum("prop_frente").collect()
    assert all(r[2] == pytest.approx(1.0) for r in sums)


def _zframe(spark):
    rows = [(i, "one", 5.0) for i in range(1)]
    rows += [(10 + i, "eq", 7.0) for i in range(4)]
    rows += [(20 + i, "big", 10.0) for i in range(11)] + [(40, "big", 1000.0)]
    rows += [(50, None, 99.0)]
    return spark.createDataFrame(rows, "id long, cat string, v double")


def test_zscore_filter_form(spark):
    out = stats.zscore_filter(_zframe(spark), "v", ["cat"]).collect()
    assert [r["id"] for r in out] == [40]
    assert out[0]["z_score"] == pytest.approx(3.175, abs=1e-3)


def test_zscore_flag_form(spark):
    out = {r["id"]: r for r in stats.zscore_flag(_zframe(spark), "v", ["cat"]).collect()}
    assert out[0]["z_score"] is None and out[0]["anomalia"] is None  # group of one
    assert out[10]["z_score"] is None  # zero variance
    assert out[50]["z_score"] is None  # NULL group key
    assert out[40]["anomalia"] is True and out[20]["anomalia"] is False
    # |sum z| ~ 0 within a group
    assert sum(r["z_score"] for r in out.values() if r["cat"] == "big") == pytest.approx(0.0, abs=1e-9)


def test_minmax_engagement(spark):
    same = _votes(spark, [(d, f"v{i}", "a") for d in (1, 2, 3) for i in range(5)])
    assert {r[1] for r in engagement.vote_engagement_minmax(same).collect()} == {1.0}
    spread = _votes(spark, [(1, "v0", "a")] + [(2, f"v{i}", "a") for i in range(3)] + [(3, f"v{i}", "a") for i in range(5)])
    got = {r[0]: r[1] for r in engagement.vote_engagement_minmax(spread).collect()}
    assert got == {1: 0.0, 2: 0.5, 3: 1.0}


def test_weighted_engagement(spark):
    deps = spark.createDataFrame([(1, "a", "P", "UF"), (2, "b", "P", "UF"), (3, "c", "P", "UF")],
                                 "id long, nome string, sigla_partido string, sigla_uf string")
    mem = spark.createDataFrame([(f"F{i}", 1) for i in range(4)] + [("F0", 2), ("F1", 2)], "idFrente string, id long")
    votes = _votes(spark, [(1, f"v{i}", "a") for i in range(10)])
    got = {r["id"]: r["score_engajamento"] for r in engagement.weighted_engagement(deps, mem, votes).collect()}
    assert got == {1: pytest.approx(100.0), 2: pytest.approx(20.0), 3: pytest.approx(0.0)}


def test_weighted_engagement_all_zero(spark):
    deps = spark.createDataFrame([(1, "a", "P", "UF")], "id long, nome string, sigla_partido string, sigla_uf string")
    mem = spark.createDataFrame([], "idFrente string, id long")
    votes = _votes(spark, [])
    r = engagement.weighted_engagement(deps, mem, votes).first()
    assert r["score_engajamento"] == 0.0 and r["qtde_frentes"] == 0


def test_week_spine_fills_gaps(spark):
    ev = spark.createDataFrame([(1, dt.datetime(2024, 1, 2)), (2, dt.datetime(2024, 1, 17))], "id long, data_inicio timestamp")
    rows = reports.weekly_density_spine(ev).collect()
    assert [(r["semana"], r["qtde_eventos"]) for r in rows] == [(1, 1), (2, 0), (3, 1)]


def test_top_n_ties_break_on_key(spark):
    df = spark.createDataFrame([(k, 5.0) for k in ["d", "b", "a", "c"]], "k string, m double")
    assert [r["k"] for r in reports.top_n(df, "m", ["k"], 2).collect()] == ["a", "b"]


def test_dimension_lookup_reads_a_derived_dimension_once_by_its_size(spark):
    names = ["hot"] * 300 + ["rare", " hot ", None, "", "unlisted"]
    fact = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "id long, nome string").withColumn("chave", surrogate_key(clean_text("nome")))
    dim = extract_dim(fact.where("nome is distinct from 'unlisted'"), "nome", "rotulo", "chave")
    scratch = Scratch(spark)
    got = dimension_lookup(fact, dim, "chave", columns=["rotulo"], scratch=scratch)
    assert got.columns == ["id", "nome", "chave", "rotulo"]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "HashAggregate" not in plan
    labels = [r["rotulo"] for r in got.orderBy("id").collect()]
    assert labels == ["hot"] * 300 + ["rare", "hot", None, None, None]
    # beyond the limit the same rows come by a shuffle join
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert [r["rotulo"] for r in dimension_lookup(fact, dim, "chave", columns=["rotulo"], scratch=scratch).orderBy("id").collect()] == labels
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert dimension_lookup(fact, dim.limit(0), "chave", columns=["rotulo"], scratch=scratch).where("rotulo is not null").isEmpty()
    scratch.clear()


def test_spend_by_state_null_state_group(spark):
    exp = spark.createDataFrame([(1, 10.0), (2, 5.0), (3, 1.0)], "idDeputado long, valor_liquido double")
    deps = spark.createDataFrame([(1, "SP"), (2, None)], "id long, sigla_uf string")
    got = {r["sigla_uf"]: r["total_gasto"] for r in reports.spend_by_state(exp, deps).collect()}
    assert got == {"SP": 10.0, None: 6.0}


def test_herfindahl_helper_matches_index(spark):
    counts = spark.createDataFrame([("A", "x", 3), ("B", "p", 1), ("B", "q", 1), ("B", "r", 2), (None, "z", 5)],
                                   "g string, p string, n long")
    got = {r[0]: r[1] for r in diversity.herfindahl_index(counts, "g", "p", "n").collect()}
    assert got == {"A": pytest.approx(0.0), "B": pytest.approx(1 - (1 + 1 + 4) / 16)}


def test_approx_distinct_opt_in(spark):
    votes = _votes(spark, [(d, f"v{d % 7}", "a") for d in range(200)])
    exact = reports.vote_patterns(votes).first()
    approx = reports.vote_patterns(votes, approx=True).first()
    assert exact["qtde_deputados"] == 200
    assert abs(approx["qtde_deputados"] - 200) <= 10 and approx["qtde_votacoes"] == 7


def test_non_negative_split_keeps_nulls_and_reports_rejects(spark):
    from civiclake.operators import quality

    df = spark.createDataFrame([(1, 10.0), (2, -5.0), (3, None), (4, 0.0)], "id long, v double")
    ok, bad = quality.split_non_negative(df, "v")
    assert sorted(r["id"] for r in ok.collect()) == [1, 3, 4] and [r["id"] for r in bad.collect()] == [2]


def test_alignment_counts_votes_before_the_fan_out(spark):
    """A deputy with a third of all votes: same shares as counting every (vote, membership) pair."""
    import collections
    import random

    from civiclake.operators.alignment import front_option_shares

    rng = random.Random(1)
    votes = [(1 if k % 3 == 0 else rng.randint(2, 9), f"b{rng.randint(1, 4)}", rng.choice(["S", "N", None])) for k in range(600)] + [(None, "b1", "S")]
    members = [(f, d) for f in range(1, 6) for d in range(1, 10) if rng.random() < 0.5] + [(1, 1), (1, 1)]
    v = spark.createDataFrame(votes, "deputado_id long, idVotacao string, tipoVoto string")
    m = spark.createDataFrame(members, "idFrente long, id long")
    df = front_option_shares(v, m)
    expect = collections.Counter((f, b, o) for d, b, o in votes for f, e in set(members) if d == e)
    assert {(r["idFrente"], r["idVotacao"], r["tipoVoto"]): r["qtde"] for r in df.collect()} == expect
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    join = plan.index("Join Inner")
    assert "Aggregate [deputado_id" in plan[join:]  # counted below the fan-out join
