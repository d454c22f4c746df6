"""Command line: ``python -m civiclake {ingest,stream,transform,analyze,all,register} ...``.

Runs the layers against landed pages (bronze) and a lake folder; prints
the status rows.  Spark settings come from the environment
(``spark-submit`` / ``PYSPARK_SUBMIT_ARGS``); ``--master`` is for local runs.
"""

from __future__ import annotations

import argparse
import datetime as dt

from civiclake.plans import layers


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="civiclake")
    p.add_argument("step", choices=["ingest", "stream", "transform", "analyze", "all", "register"])
    p.add_argument("--landing", help="folder of landed API pages (ingest, stream, all)")
    p.add_argument("--lake", required=True, help="output folder of the bronze/silver/gold tables")
    p.add_argument("--prefix", default="", help="prefix of the catalog names (register)")
    p.add_argument("--as-of", help="processing timestamp stamped on silver rows (one value per run; now by default)")
    p.add_argument("--years", help="first and last year to ingest, as 2023-2024 or 2024 (ingest, all): only landed files of these years are read")
    p.add_argument("--master", default=None, help="Spark master for local runs (e.g. local[8]); omit under spark-submit")
    a = p.parse_args(argv)
    a.as_of_given = a.as_of is not None
    a.as_of = a.as_of or dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
    first, _, last = (a.years or "").partition("-")
    period = (int(first), int(last or first)) if first else None
    if a.step in ("ingest", "stream", "all") and not a.landing:
        p.error(f"--landing is required for '{a.step}'")

    from pyspark.sql import SparkSession

    from civiclake.session import build_session, ensure_checkpoint_dir

    if a.master:
        spark = build_session(a.master)
    else:
        spark = SparkSession.builder.appName("civiclake").getOrCreate()
        ensure_checkpoint_dir(spark)
    if a.step == "register":
        from civiclake.plans.catalog import register_lake

        status = [("catalogo", name, "ok") for name in register_lake(spark, a.lake, a.prefix)]
    elif a.step == "all":
        status = layers.run_all(spark, a.landing, a.lake, a.as_of, period).collect()
    else:
        from civiclake.streaming import ingest_new

        rows = {"stream": lambda: ingest_new(spark, a.landing, a.lake),
                "ingest": lambda: layers.ingest_all(spark, a.landing, a.lake, period),
                "transform": lambda: layers.transform_all(spark, a.lake, a.as_of),
                "analyze": lambda: layers.analyze_all(spark, a.lake, a.as_of if a.as_of_given else None)}[a.step]()
        status = rows
    for r in status:
        print("\t".join("" if v is None else str(v) for v in r))


if __name__ == "__main__":
    main()
