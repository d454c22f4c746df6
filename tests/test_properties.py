"""Randomised checks against brute force on small frames with hot keys."""

from __future__ import annotations

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from civiclake.operators import dedup, scd2, sequence

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))

# a key column where key 0 dominates (hot key), plus a strictly increasing order column
rows_strategy = st.lists(
    st.tuples(st.sampled_from([0, 0, 0, 0, 1, 2, 3, None, None]), st.one_of(st.none(), st.integers(0, 4))),
    min_size=1, max_size=120,
)


def _frame(spark, rows):
    data = [(k, i, v) for i, (k, v) in enumerate(rows)]
    return spark.createDataFrame(data, "k long, t long, v long"), pd.DataFrame(data, columns=["k", "t", "v"])


@SETTINGS
@given(rows=rows_strategy, slices=st.integers(1, 7), ignore=st.booleans(), asc=st.booleans())
def test_previous_row_brute_force(spark, rows, slices, ignore, asc):
    sdf, pdf = _frame(spark, rows)
    got = sequence.previous_row(sdf, "k", ["t"], ["v"], prefix="p_", ascending=asc, ignore_nulls=ignore, slices=slices)
    got = {(r["k"], r["t"]): r["p_v"] for r in got.collect()}
    exp = {}
    pdf = pdf.astype({"k": "object"}).where(pdf.notna(), None)
    for k, g in pdf.sort_values("t", ascending=asc).groupby("k", dropna=False):
        prev, last_nn = None, None
        for _, r in g.iterrows():
            kk = None if pd.isna(r["k"]) else int(r["k"])
            exp[(kk, int(r["t"]))] = last_nn if ignore else prev
            prev = None if pd.isna(r["v"]) else int(r["v"])
            if not pd.isna(r["v"]):
                last_nn = int(r["v"])
    assert got == exp


@SETTINGS
@given(rows=rows_strategy)
def test_keep_latest_brute_force(spark, rows):
    sdf, pdf = _frame(spark, rows)
    got = {r["k"]: (r["t"], r["v"]) for r in dedup.keep_latest(sdf, ["k"], ["v"]).collect()}
    exp = {}
    for k, g in pdf.groupby("k", dropna=False):
        k = None if pd.isna(k) else int(k)
        # greatest v (NULL lowest), ties -> greatest t
        g = g.assign(vv=g["v"].astype("float").fillna(-1.0)).sort_values(["vv", "t"])
        last = g.iloc[-1]
        exp[k] = (int(last["t"]), None if pd.isna(last["v"]) else int(last["v"]))
    assert got == exp


@SETTINGS
@given(rows=st.lists(st.tuples(st.sampled_from([0, 0, 0, 1, 2]), st.sampled_from("AB")), min_size=1, max_size=60),
       facts=st.lists(st.tuples(st.sampled_from([0, 0, 1, 2, 3]), st.integers(-2, 70)), max_size=60))
def test_scd2_and_as_was_brute_force(spark, rows, facts):
    import datetime as dt

    base = dt.datetime(2024, 1, 1)
    log = [(k, base + dt.timedelta(days=i), i, p) for i, (k, p) in enumerate(rows)]
    ldf = spark.createDataFrame(log, "id long, ts timestamp, tb long, p string")
    hist = scd2.scd2_from_log(ldf, "id", "ts", ["p"], ["tb"])
    # brute-force history
    exp_versions = []
    for k in sorted({r[0] for r in log}):
        seq = sorted([r for r in log if r[0] == k], key=lambda r: (r[1], r[2]))
        kept = [r for i, r in enumerate(seq) if i == 0 or seq[i - 1][3] != r[3]]
        for i, r in enumerate(kept):
            exp_versions.append((k, r[3], r[1], kept[i + 1][1] if i + 1 < len(kept) else None))
    got_versions = sorted((r["id"], r["p"], r["valid_from"], r["valid_to"]) for r in hist.collect())
    assert got_versions == sorted(exp_versions, key=lambda x: (x[0], x[1], x[2], x[3] or dt.datetime.max))
    # as-was against an interval brute force
    f = [(j, k, base + dt.timedelta(days=d)) for j, (k, d) in enumerate(facts)]
    if not f:
        return
    fdf = spark.createDataFrame(f, "fid long, cust long, d timestamp")
    got = {r["fid"]: r["p"] for r in scd2.as_was_join(fdf, hist, "cust", "d", ["fid"], "id", ["p"]).collect()}
    for j, k, d in f:
        match = [v for v in exp_versions if v[0] == k and v[2] <= d and (v[3] is None or d < v[3])]
        assert got[j] == (match[0][1] if match else None)


@SETTINGS
@given(members=st.lists(st.tuples(st.integers(0, 3), st.integers(0, 30)), min_size=1, max_size=80),
       parties=st.lists(st.one_of(st.none(), st.sampled_from("ABCD")), min_size=31, max_size=31),
       votes=st.lists(st.tuples(st.integers(0, 30), st.integers(0, 5)), max_size=80))
def test_metric_ranges(spark, members, parties, votes):
    from civiclake.operators import diversity, engagement

    mem = spark.createDataFrame([(f"F{f}", d) for f, d in members], "idFrente string, id long")
    deps = spark.createDataFrame([(d, f"n{d}", p, "UF") for d, p in enumerate(parties)],
                                 "id long, nome string, sigla_partido string, sigla_uf string")
    idx = diversity.diversity_index(mem.join(deps.select("id", "sigla_partido"), "id", "left"), "idFrente", "sigla_partido")
    assert all(0.0 <= r["indice_diversidade"] < 1.0 for r in idx.collect())
    v = spark.createDataFrame([(d, f"b{b}", "Sim") for d, b in votes], "deputado_id long, idVotacao string, tipoVoto string")
    if votes:
        assert all(0.0 <= r["score_engajamento"] <= 1.0 for r in engagement.vote_engagement_minmax(v).collect())
    w = engagement.weighted_engagement(deps, mem, v).collect()
    assert len(w) == len(parties) and all(0.0 <= r["score_engajamento"] <= 100.0 + 1e-9 for r in w)
