"""Every registered query against its SQL oracle (DuckDB) on the driver tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as E
from civiclake.plans import registry
from oracle import compare

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
NAMES = sorted(registry.QUERIES)


@pytest.fixture(scope="module")
def results(spark):
    if not os.path.isdir(SF):
        pytest.skip("driver tables not present")
    return compare(spark, SF, NAMES, verbose=False)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(results, name):
    r = results[name]
    assert "error" not in r, r.get("error")
    if r["has_oracle"]:
        assert r["match"], r


#: Sort of the reports whose order is part of the result: columns, "-" for descending.
ORDERS = {
    "spend_by_type": ["-total_gasto", "tipoDespesa"],
    "spend_by_deputy": ["-total_gasto", "deputado_id"],
    "spend_by_state": ["-total_gasto", "sigla_uf"],
    "vote_patterns": ["-qtde_votos", "tipoVoto"],
    "monthly_frequency": ["ano", "mes"],
    "weekly_density_spine": ["ano", "semana"],
    "top_participants": ["-qtde_frentes", "id_deputado"],
    "supplier_ranking_name": ["-total_recebido", "nomeFornecedor"],
}


@pytest.mark.parametrize("name", ORDERS)
def test_report_order(spark, name):
    rows = registry.QUERIES[name](spark, SF).collect()
    keys = [tuple(-r[c[1:]] if c[0] == "-" else r[c] for c in ORDERS[name]) for r in rows]
    assert len(rows) > 1 and keys == sorted(keys)


def test_outliers_by_size_of_their_score(spark):
    rows = registry.QUERIES["expense_outliers"](spark, SF).collect()
    keys = [(-abs(r["z_score"]), r["deputado_id"]) for r in rows]
    assert len(rows) > 1 and keys == sorted(keys)


def test_every_query_has_an_oracle():
    assert set(registry.QUERIES) == set(registry.SQL)
    assert set(E.queries()) >= set(registry.QUERIES)


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["deputado_id", "nome", "sigla_partido", "sigla_uf", "tipoDespesa", "valor_liquido", "media", "z_score",
                          "data_documento"]
    assert len(rows) == 18
