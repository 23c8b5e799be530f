"""Command line: ``python -m valuora <process|multi|daily|apply|ingest> ...`` (also via spark-submit).

Inputs are either the driver's test tables (``--sf DIR``, through the adapters)
or files in the reference's layout (``--files paths.json`` mapping table names
to paths or ``{"path", "format"}``). Outputs go to ``--out`` (a shared folder on
a cluster). ``ingest`` writes the prices once as the date-partitioned table that
a later ``--files`` run reads with the format ``price_table``. ``apply`` takes a drop of
price files into the run that ``process`` stored at ``--out``, once for each ``--id``.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json

from valuora.session import drop_tables, get_spark


def _model(spark, args):
    from valuora.plans.model import FileModel, TestdataModel
    if args.files:
        with open(args.files) as f:
            return FileModel(spark, json.load(f))
    return TestdataModel(spark, args.sf)


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="valuora")
    ap.add_argument("command", choices=["process", "multi", "daily", "apply", "ingest"])
    ap.add_argument("--sf", help="folder of the driver's test tables")
    ap.add_argument("--files", help="JSON file: table name -> path")
    ap.add_argument("--out", required=True)
    ap.add_argument("--start", type=int, default=None)
    ap.add_argument("--end", type=int, default=None)
    ap.add_argument("--agg", choices=["mean", "median"], default="mean")
    ap.add_argument("--fp", type=int, default=10)
    ap.add_argument("--rr", type=float, default=0.15)
    ap.add_argument("--exclude", default="it,ca", help="markets left out (multi)")
    ap.add_argument("--market", default=None, help="run the single-market job for one market")
    ap.add_argument("--csv", action="store_true", help="also export the tables as CSV (process: with company data)")
    ap.add_argument("--date", default=None, help="snapshot date (multi), default today")
    ap.add_argument("--growth", help="stored growth table (daily)")
    ap.add_argument("--drop", help="folder of today's price files (daily, apply)")
    ap.add_argument("--id", help="name of the delivery (apply): one that was applied before changes nothing")
    ap.add_argument("--master", default=None)
    ap.add_argument("--input-bytes", type=float, default=None,
                    help="size of the price input; with --executors/--cores/--memory-gb sizes the job")
    ap.add_argument("--executors", type=int, default=None)
    ap.add_argument("--cores", type=int, default=4)
    ap.add_argument("--memory-gb", type=float, default=16.0)
    args = ap.parse_args(argv)
    from pyspark.sql import SparkSession
    owned = SparkSession.getActiveSession() is None   # stop only a session we started
    extra = None
    if args.input_bytes and args.executors:
        from valuora.session import cluster_conf
        size = int(args.input_bytes)
        extra = cluster_conf(size, args.executors, args.cores, args.memory_gb,
                             shuffle_bytes=size if args.command == "ingest" else 0)
    spark = get_spark(args.master, extra=extra)

    if args.command == "process":
        from valuora.plans.stored import run_and_store
        paths = run_and_store(_model(spark, args), args.out, (args.start, args.end),
                              args.fp, args.rr, agg_func=args.agg, market=args.market)
        if args.csv:
            from valuora import sinks
            from valuora.operators.company import enrich
            company = spark.read.parquet(paths["company_info"])
            company = company.drop("peer_list")   # the peers stay as their string
            for name in ("fundamental", "growth", "screener"):
                sinks.export_csv(enrich(spark.read.parquet(paths[name]), company), f"{args.out.rstrip('/')}/{name}_csv")
        print(json.dumps(paths))
    elif args.command == "ingest":
        from valuora import sinks
        from valuora.sources.files import ingest_audit, read_price_table
        table = f"{args.out.rstrip('/')}/price"
        sinks.write_price_table(_model(spark, args).price, table)
        sinks.write_table(ingest_audit(read_price_table(spark, table)), f"{args.out.rstrip('/')}/price_audit")
        print(json.dumps({"price": table}))
    elif args.command == "multi":
        from valuora import sinks
        from valuora.operators.multimarket import multi_market
        res = multi_market(_model(spark, args), tuple(m for m in args.exclude.split(",") if m),
                           args.fp, args.rr, args.agg)
        day = args.date or dt.date.today().isoformat()
        for name in ("fundamental", "growth"):
            sinks.write_snapshot(res[name], args.out, name, day)
            if args.csv:   # the spreadsheet export, as CSV with a header
                sinks.export_csv(res[name], f"{args.out.rstrip('/')}/{day}_{name}_csv")
        print(json.dumps({"snapshot_date": day, "out": args.out}))
    elif args.command == "apply":
        from valuora.plans.stored import apply_day
        from valuora.sources.files import read_prices_csv
        if not args.id:
            ap.error("apply needs --id")
        print(json.dumps(apply_day(spark, args.out, read_prices_csv(spark, args.drop), args.id)))
    else:
        from valuora.sources.files import read_prices_csv
        from valuora.plans.jobs import daily_refresh
        from valuora import sinks
        growth = spark.read.parquet(args.growth)
        batch = read_prices_csv(spark, args.drop)
        sinks.write_table(daily_refresh(batch, growth), f"{args.out.rstrip('/')}/screener")
        print(json.dumps({"screener": f"{args.out.rstrip('/')}/screener"}))
    if owned:
        drop_tables(spark)
        spark.stop()


if __name__ == "__main__":
    main()
