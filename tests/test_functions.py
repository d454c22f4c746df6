"""Column helpers (P3-P16, K3) on hand-made edge frames."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from civiclake.functions import clean, dates, keys


def test_clean_text_space_only_trim(spark):
    df = spark.createDataFrame([("  a ",), ("",), ("   ",), (None,), ("\ta",)], "s string")
    got = [r[0] for r in df.select(clean.clean_text("s")).collect()]
    assert got == ["a", None, None, None, "\ta"]


def test_party_casing_normalised_before_distinct(spark):
    df = spark.createDataFrame([(" pt",), ("PT",), ("",), (None,)], "siglaPartido string")
    from civiclake.plans.silver import dim_partidos

    got = dim_partidos(df, "2024-01-01 00:00:00").select("sigla").collect()
    assert [r[0] for r in got] == ["PT"]


def test_junk_dates_and_numbers(spark):
    df = spark.createDataFrame([("2024-05-01T10:00", "12.50"), ("bad", "x"), (None, None)], "d string, v string")
    out = df.select(
        clean.to_timestamp_safe("d").alias("ts"), clean.to_date_safe("d").alias("dt"), clean.to_number("v").alias("n"),
        clean.unparsed_flag("d", clean.to_date_safe("d")).alias("bad_d"), clean.unparsed_flag("v", clean.to_number("v")).alias("bad_v"),
    ).collect()
    assert out[0]["ts"] == dt.datetime(2024, 5, 1, 10, 0)
    assert out[0]["dt"] == dt.date(2024, 5, 1)
    assert float(out[0]["n"]) == 12.5
    assert out[1]["ts"] is None and out[1]["dt"] is None and out[1]["n"] is None
    assert out[2]["ts"] is None and out[2]["n"] is None
    assert sum(r["bad_d"] for r in out) == 1 and sum(r["bad_v"] for r in out) == 1


def test_json_deputy_spaced_and_compact(spark):
    df = spark.createDataFrame([('{"id": 7}',), ('{"id":7}',), ("bad",), (None,)], "j string")
    got = [r[0] for r in df.select(clean.json_field("j", "id", "bigint")).collect()]
    assert got == [7, 7, None, None]


def test_iso_week_edge(spark):
    df = spark.createDataFrame([(dt.date(2024, 12, 30),)], "d date")
    iso_y, iso_w = dates.iso_week("d")
    leg_y, _ = dates.iso_week("d", legacy_year=True)
    r = df.select(iso_y.alias("y"), iso_w.alias("w"), leg_y.alias("ly")).first()
    assert (r["y"], r["w"], r["ly"]) == (2025, 1, 2024)


def test_duration_hours(spark):
    df = spark.createDataFrame([("2024-01-01T10:00", "2024-01-01T12:30"), ("2024-01-01T10:00", None)], "a string, b string")
    got = [r[0] for r in df.select(dates.duration_hours(clean.to_timestamp_safe("a"), clean.to_timestamp_safe("b"))).collect()]
    assert got == [2.5, None]


def test_surrogate_key_stable_across_partitioning(spark):
    df = spark.createDataFrame([(f"n{i}", i % 3) for i in range(50)], "name string, g int")
    a = {r[0]: r[1] for r in df.repartition(1).select("name", keys.surrogate_key("name")).collect()}
    b = {r[0]: r[1] for r in df.repartition(7).select("name", keys.surrogate_key("name")).collect()}
    assert a == b
    import hashlib

    assert a["n1"] == hashlib.md5(b"n1").hexdigest()
    nul = spark.createDataFrame([(None, 1)], "name string, g int").select(keys.surrogate_key("name"), keys.surrogate_key("name", "g")).first()
    assert nul[0] is None and nul[1] is None


def test_nested_to_json(spark):
    df = spark.createDataFrame([(1, {"id": 2, "nome": "x"}, [1, 2])], "id long, s struct<id:long,nome:string>, a array<int>")
    r = clean.nested_to_json(df).first()
    assert r["s"] == '{"id":2,"nome":"x"}' and r["a"] == "[1,2]"


def test_abs_threshold_null_stays_null(spark):
    df = spark.createDataFrame([(4.0,), (-4.0,), (1.0,), (None,)], "z double")
    assert [r[0] for r in df.select(clean.abs_exceeds("z", 3)).collect()] == [True, True, False, None]


def test_money_sum_exact(spark):
    df = spark.createDataFrame([(0.1,), (0.2,), (0.3,)], "v double")
    assert df.select(clean.money_sum("v")).first()[0] == 0.6
    assert df.select(F.sum("v")).first()[0] != 0.6  # the float sum is not exact


def test_money_avg_from_parts_equals_direct(spark):
    rows = [(i % 7, round((i * 37 % 1000) / 8.0, 2)) for i in range(500)] + [(9, None)]
    df = spark.createDataFrame(rows, "g int, v double")
    direct = {r[0]: r[1] for r in df.groupBy("g").agg(clean.money_avg("v")).collect()}
    # split each group into parts, then combine
    parts = df.groupBy("g", (F.col("v") * 100 % 3).alias("part")).agg(F.sum(clean.money("v")).alias("s"), F.count("v").alias("n"))
    combined = parts.groupBy("g").agg(clean.money_avg_from_parts(F.sum("s"), F.sum("n")).alias("a"))
    assert {r[0]: r[1] for r in combined.collect()} == direct


def test_parse_json_column(spark):
    df = spark.createDataFrame([('{"nome": "Ana", "idLegislatura": 57}',), ('{"nome":"Bia"}',)], "s string")
    out = clean.parse_json_column(df, "s", ["nome", "idLegislatura"]).collect()
    assert [(r["s_nome"], r["s_idLegislatura"]) for r in out] == [("Ana", "57"), ("Bia", None)]
    assert clean.parse_json_column(df, "missing", ["x"]).columns == ["s"]
