"""Run registered survey queries from the command line.

    python -m wellspring --list
    python -m wellspring town_source_share /data/survey --show 30
    python -m wellspring work_orders suspect_list /data/survey --out /shared/results
    python -m wellspring --sql "select town_name, count(*) from location group by 1" /data/survey

With ``--out`` each result is written as Parquet to ``<out>/<key>``;
otherwise the first ``--show`` rows are printed.
"""

from __future__ import annotations

import argparse
import sys


def main(argv: list[str] | None = None) -> int:
    from wellspring.plans.registry import QUERIES

    ap = argparse.ArgumentParser(prog="wellspring")
    ap.add_argument("args", nargs="*", help="query keys followed by the input folder")
    ap.add_argument("--list", action="store_true", help="list the query keys")
    ap.add_argument("--all", action="store_true", help="run every query")
    ap.add_argument("--show", type=int, default=20)
    ap.add_argument("--out", help="write each result as Parquet under this folder")
    ap.add_argument("--sql", help="run this SQL over the survey tables and views instead of keys")
    ap.add_argument("--master", default=None, help="Spark master (default: from spark-submit)")
    ns = ap.parse_args(argv)

    if ns.list:
        print("\n".join(sorted(QUERIES)))
        return 0
    if not ns.args:
        ap.error("give query keys (or --all, or --sql) and the input folder")
    *keys, root = ns.args
    keys = sorted(QUERIES) if ns.all else keys
    unknown = [k for k in keys if k not in QUERIES]
    if unknown or not (keys or ns.sql):
        ap.error(f"unknown query keys: {unknown}" if unknown else "no query key given")

    from pyspark.sql import SparkSession

    from wellspring.session import DEFAULT_CONF
    existing = SparkSession.getActiveSession()
    builder = SparkSession.builder.appName("wellspring")
    if ns.master:
        builder = builder.master(ns.master)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    jobs = [(key, lambda key=key: QUERIES[key](spark, root)) for key in keys]
    if ns.sql:
        from wellspring.plans.views import register_survey_views, role_tables
        register_survey_views(spark, role_tables(spark, root))
        jobs = [("sql", lambda: spark.sql(ns.sql))]
    for key, build in jobs:
        df = build()
        if ns.out:
            df.write.mode("overwrite").parquet(f"{ns.out.rstrip('/')}/{key}")
            print(f"{key}: written to {ns.out.rstrip('/')}/{key}")
        else:
            print(f"== {key}")
            df.show(ns.show, truncate=False)
    if existing is None:
        spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
