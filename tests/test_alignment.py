"""Alignment of fronts (G5, X4): cells against a count by hand, and the shape of the plans at size."""

from __future__ import annotations

import os
import random
from collections import Counter, defaultdict

import pytest

from civiclake.operators import alignment


@pytest.fixture()
def tables(spark):
    rng = random.Random(11)
    votes = [(rng.choice([1, 2, 3, None]), rng.choice([*range(9), None]), rng.choice(["Sim", "Nao", "Abs", None])) for _ in range(600)]
    members = [(rng.choice([0, 1, 2, None]), rng.choice([*range(14), None])) for _ in range(60)]
    parties = [(d, [None, "PT", "PL"][d % 3]) for d in range(8)]
    make = spark.createDataFrame
    frames = make(votes, "idVotacao int, deputado_id long, tipoVoto string"), make(members, "idFrente long, id long"), make(parties, "id long, sigla_partido string")
    return frames, (votes, members, dict(parties))


def by_hand(votes, members, parties, party=True):
    """(front, party): mean of own share over the house's, by pairs."""
    house = Counter((b, o) for b, d, o in votes if b is not None and d is not None)
    cells = Counter((f, parties.get(m) if party else None, b, o) for f, m in set(members) for b, d, o in votes if None not in (f, m, b) and m == d)
    of_house, of_group, ratios = Counter(), Counter(), defaultdict(list)
    for (b, _), n in house.items():
        of_house[b] += n
    for (f, p, b, _), n in cells.items():
        of_group[f, p, b] += n
    for (f, p, b, o), n in cells.items():
        ratios[f, p] += [] if o is None else [n / of_group[f, p, b] / (house[b, o] / of_house[b])]
    return {k: sum(r) / len(r) for k, r in ratios.items() if r}


def test_pairs_unfolded_late_count_as_pairs(spark, tables, tmpdir_run):
    (votes, mem, dep), data = tables
    fronts = {f: r for (f, _), r in by_hand(*data, party=False).items()}
    both = by_hand(*data)
    assert {tuple(r)[0]: r[1] for r in alignment.relative_alignment(votes, mem).collect()} == pytest.approx(fronts)
    cells = alignment.alignment_cells(votes, mem, dep)
    assert {tuple(r)[:2]: r[2] for r in alignment.matrix_of_cells(cells).collect() if r[2] is not None} == pytest.approx(both)
    wide = alignment.alignment_matrix(votes, mem, dep, ["PT", "PL", "X"]).collect()
    assert {(r["id_frente"], p): r[p] for r in wide for p in ("PT", "PL", "X") if r[p] is not None} == pytest.approx({k: v for k, v in both.items() if k[1]})
    path = os.path.join(tmpdir_run, "cells")
    alignment.store_cells(votes, mem, dep, path)
    assert {r[0]: r[1] for r in alignment.alignment_of_cells(alignment.stored_cells(spark, path)).collect()} == pytest.approx(fronts)


def test_a_front_of_one_option_and_one_party_twice(spark):
    """A deputy listed twice counts twice in the matrix and once in the cells, as before."""
    votes = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (1, 2, "b")], "idVotacao int, deputado_id long, tipoVoto string")
    mem = spark.createDataFrame([(7, 1), (7, 2)], "idFrente long, id long")
    dep = spark.createDataFrame([(1, "P"), (1, "P"), (2, "P")], "id long, sigla_partido string")
    assert alignment.alignment_matrix(votes, mem, dep, ["P"]).first()["P"] == pytest.approx(((2 / 4) / (1 / 3) + (2 / 4) / (2 / 3)) / 2)
    assert alignment.matrix_of_cells(alignment.alignment_cells(votes, mem, dep)).first()[2] == pytest.approx(1)


def plan(df, stage="executedPlan"):
    return getattr(df._jdf.queryExecution(), stage)().toString()


@pytest.mark.parametrize("name", ["relative_alignment", "alignment_matrix", "matrix_of_cells", "alignment_cells"])
def test_pairs_are_unfolded_behind_their_shuffle(tables, name):
    (votes, mem, dep), _ = tables
    df = {"relative_alignment": lambda: alignment.relative_alignment(votes, mem),
          "alignment_matrix": lambda: alignment.alignment_matrix(votes, mem, dep, ["PT"]),
          "matrix_of_cells": lambda: alignment.matrix_of_cells(alignment.alignment_cells(votes, mem, dep)),
          "alignment_cells": lambda: alignment.alignment_cells(votes, mem, dep)}[name]()
    lines = plan(df).splitlines()
    at = next(i for i, line in enumerate(lines) if "Generate explode" in line)
    below = next(line for line in lines[at:] if "Exchange" in line)
    assert "hashpartitioning(idFrente" in below and "REPARTITION_BY_NUM" in below
    above = [line for line in lines[:at] if "Exchange" in line]
    if name == "alignment_cells":  # whole cells leave the task
        assert not above
    assert not any("Window" in line and "idFrente" in line for line in lines)


def test_only_voters_memberships_are_made_distinct(tables):
    (votes, mem, _), _ = tables
    lines = plan(alignment.relative_alignment(votes, mem), "optimizedPlan").splitlines()
    semi = next(line for line in lines if "LeftSemi" in line)
    distinct = next(line for line in lines if "Aggregate [__dep" in line and "idFrente" in line)
    assert semi.index("Join") > distinct.index("Aggregate")


# ---------------------------------------------------- the queries: memberships of voters, made distinct once
@pytest.fixture()
def role_tables(spark, tmpdir_run):
    """Lineitems that repeat a membership, NULL keys, and deputies of whom few vote."""
    rng = random.Random(5)
    orders = [(o, None if o % 17 == 0 else o % 30) for o in range(90)]
    items = [(rng.randrange(100), rng.choice([0, 1, 2, None])) for _ in range(400)] * 2
    events = [(f"2024-01-0{rng.randint(1, 6)} 10:00:00", rng.choice([*range(6), None]), rng.choice(["view", "error", None])) for _ in range(300)]
    rows = {
        "orders": (orders, "o_orderkey long, o_custkey long"),
        "lineitem": (items, "l_orderkey long, l_suppkey long"),
        "customer": ([(c, f"c{c}", c % 3, ["BUILDING", "MACHINERY"][c % 2]) for c in range(30)], "c_custkey long, c_name string, c_nationkey int, c_mktsegment string"),
        "nation": ([(n, f"n{n}", 0) for n in range(3)], "n_nationkey int, n_name string, n_regionkey int"),
    }
    for name, (data, schema) in rows.items():
        spark.createDataFrame(data, schema).write.parquet(f"{tmpdir_run}/{name}.parquet")
    spark.createDataFrame(events, "ts string, user_id long, event_type string").selectExpr("cast(ts as timestamp_ntz) AS ts", "user_id", "event_type").write.parquet(f"{tmpdir_run}/events.parquet")
    of = dict(orders)
    votes = [(ts[:10], u, t) for ts, u, t in events]
    return tmpdir_run, (votes, [(s, of.get(o)) for o, s in items], {c: ["BUILDING", "MACHINERY"][c % 2] for c in range(30)})


def query_as(spark, name, d):
    import __spark_entry__ as entry

    return entry.queries()[name](spark, d)


def rounded(ratios):
    return {k: pytest.approx(v, abs=2e-6) for k, v in ratios.items()}


def voters_meet_the_orders(spark, name, d):
    """Without a broadcast, as at size: no distinct stands between the filter on voters and the orders."""
    with_limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lines = plan(query_as(spark, name, d), "optimizedPlan").splitlines()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", with_limit)
    semi = next(i for i, line in enumerate(lines) if "LeftSemi" in line)
    first = next(line for line in lines[semi:] if "Relation" in line)
    return "o_custkey" in first


def test_stored_cells_read_memberships_written_once(spark, role_tables, monkeypatch):
    d, data = role_tables
    seen, store = [], alignment.store_cells

    def watched(votes, memberships, *args, **kw):
        seen.append(memberships)
        assert not [f for f in memberships.inputFiles() if "lineitem" in f or "orders" in f]
        assert memberships.count() == len({(f, m) for f, m in data[1] if f is not None and m in {v[1] for v in data[0]} - {None}})
        return store(votes, memberships, *args, **kw)

    monkeypatch.setattr(alignment, "store_cells", watched)
    got = {r[0]: r[1] for r in query_as(spark, "alignment_front_cells", d).collect()}
    assert len(seen) == 2
    assert got == rounded({f: r for (f, _), r in by_hand(*data, party=False).items()})


def test_matrix_long_filters_orders_by_voters(spark, role_tables):
    d, data = role_tables
    assert voters_meet_the_orders(spark, "alignment_matrix_long", d)
    assert {tuple(r)[:2]: r[2] for r in query_as(spark, "alignment_matrix_long", d).collect() if r[2] is not None} == rounded(by_hand(*data))


def test_front_filters_orders_by_voters(spark, role_tables):
    d, data = role_tables
    assert voters_meet_the_orders(spark, "alignment_front", d)
    assert {r[0]: r[1] for r in query_as(spark, "alignment_front", d).collect()} == rounded({f: r for (f, _), r in by_hand(*data, party=False).items()})


def test_matrix_filters_orders_by_voters(spark, role_tables):
    d, data = role_tables
    assert voters_meet_the_orders(spark, "alignment_matrix", d)
    got = {(r["id_frente"], p): r[p] for r in query_as(spark, "alignment_matrix", d).collect() for p in ("BUILDING", "MACHINERY") if r[p] is not None}
    assert got == rounded(by_hand(*data))
