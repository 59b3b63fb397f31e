"""Command line: ``python -m keelson <command> ...``.

ingest    raw trip Parquet -> bronze, one month partition replaced per month given
          (default: every month present), idempotent on re-runs (G1, §3.1)
run       one gated bronze -> silver -> gold run over the driver tables (§3.2)
check     run the silver and gold checks on tables of an earlier run, rebuild nothing
sandbox   append one pickup day from bronze to the sandbox table (not idempotent, G20)
queries   list the registered queries (name, oracle-checked or rows-only)

The session is taken from the environment (spark-submit / defaults); only a local
master gets the settings of ``keelson.session``.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession


def _session(master: str | None) -> SparkSession:
    if master:
        from keelson.session import build_session
        return build_session(master)
    spark = SparkSession.builder.getOrCreate()
    from keelson.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(spark)
    return spark


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="keelson")
    ap.add_argument("--master", default=None, help="e.g. local[8]; default: from the environment")
    sub = ap.add_subparsers(dest="cmd", required=True)

    ing = sub.add_parser("ingest", help="raw Parquet -> bronze, month by month")
    ing.add_argument("--raw", required=True, help="raw trip Parquet file(s) or directory")
    ing.add_argument("--bronze", required=True, help="bronze table directory (partitioned by month)")
    ing.add_argument("months", nargs="*", help="yyyy-MM months (default: all present)")

    run = sub.add_parser("run", help="gated bronze -> silver -> gold run over the driver tables")
    run.add_argument("--sf-dir", default=None, help="driver tables (trip domain); or give --raw and --zones-csv")
    run.add_argument("--raw", default=None, help="raw trip Parquet file(s) or directory (taxi columns)")
    run.add_argument("--zones-csv", default=None, help="zone seed CSV: LocationID,Borough,Zone,service_zone")
    run.add_argument("--var", action="append", default=[], metavar="KEY=VALUE",
                     help="silver variable, e.g. start_date=2024-01-01 max_trip_hours=12")
    run.add_argument("--root", required=True, help="shared folder for the layer tables")
    run.add_argument("--run-id", required=True)
    run.add_argument("--previous-silver", default=None)
    run.add_argument("--months", nargs="*", default=None)
    run.add_argument("--silver-mode", choices=["snapshot", "merge"], default="snapshot",
                     help="merge: one silver table, each run rewrites only the months it touches")

    run.add_argument("--publish", default=None, metavar="PREFIX", help="save the tables in the catalog as PREFIX_silver_trips ...")

    chk = sub.add_parser("check", help="checks on existing layer tables (exit 1 on failure)")
    chk.add_argument("--root", required=True)
    chk.add_argument("--run-id", required=True)
    chk.add_argument("--duration-hours", type=int, default=None)
    chk.add_argument("--boroughs", default=None, help="accepted boroughs, comma-separated (default: the trip domain's)")

    sbx = sub.add_parser("sandbox", help="append one pickup day to the sandbox table")
    sbx.add_argument("--bronze", required=True)
    sbx.add_argument("--day", required=True)
    sbx.add_argument("--path", required=True)

    sub.add_parser("queries", help="list registered queries")
    args = ap.parse_args(argv)

    if args.cmd == "queries":
        from keelson.plans import registry
        for name in registry.QUERIES:
            print(name, "oracle" if name in registry.ORACLE else "rows-only")
        return 0

    spark = _session(args.master)
    if args.cmd == "ingest":
        from keelson.plans import runner
        raw = spark.read.parquet(args.raw)
        done = runner.ingest(raw, args.bronze, args.months or None)
        rows = spark.read.parquet(args.bronze).count()
        print(json.dumps({"months": done, "bronze_rows": rows}))
    elif args.cmd == "run":
        import dataclasses

        from keelson.plans import domain, runner
        from keelson.plans.medallion import DEFAULT_VARS, TAXI_BOROUGHS
        from keelson.sources.readers import load_seed
        fields = {f.name: f.type for f in dataclasses.fields(DEFAULT_VARS)}
        conv = {"int": int, "float": float, "str": str, "tuple[str, ...]": lambda x: tuple(x.split(",")),
                "tuple[int, ...]": lambda x: tuple(int(y) for y in x.split(","))}
        given = dict(kv.split("=", 1) for kv in args.var)
        if args.raw:
            given = {"boroughs": ",".join((*TAXI_BOROUGHS, *DEFAULT_VARS.boroughs))} | given
        vars_ = dataclasses.replace(DEFAULT_VARS, **{
            k: conv.get(str(fields[k]), str)(v) for k, v in given.items()})
        if args.raw:
            if not args.zones_csv:
                ap.error("--raw needs --zones-csv")
            raw = spark.read.parquet(args.raw)
            seed = load_seed(spark, args.zones_csv, "LocationID int, Borough string, Zone string, service_zone string")
            source = None
        elif args.sf_dir:
            raw, seed, source = domain.raw_trips(spark, args.sf_dir), domain.zone_seed(spark, args.sf_dir), "lineitem.parquet"
        else:
            ap.error("give --sf-dir, or --raw with --zones-csv")
        res = runner.run_layers(spark, raw, seed, args.root, args.run_id, v=vars_,
                                previous_silver=args.previous_silver, months=args.months, source_file=source,
                                silver_mode=args.silver_mode, publish=args.publish)
        print(json.dumps({"silver": res.silver, "gold_daily": res.gold_daily, "gold_hourly": res.gold_hourly,
                          "checks": res.checks}))
    elif args.cmd == "check":
        import dataclasses

        from keelson.operators.quality import GateFailed, run_checks
        from keelson.plans import runner
        from keelson.plans.medallion import DEFAULT_VARS
        from keelson.session import path_exists
        root = args.root.rstrip("/")
        sp = f"{root}/silver_trips/run={args.run_id}"
        silver = spark.read.parquet(sp if path_exists(spark, sp) else f"{root}/silver_trips/table")
        zones = spark.read.parquet(f"{root}/silver_zones/run={args.run_id}")
        gp = f"{root}/gold_daily/run={args.run_id}"
        daily = (spark.read.parquet(gp) if path_exists(spark, gp)
                 else spark.read.parquet(f"{root}/gold_daily/table").drop("pickup_month"))
        hourly = spark.read.parquet(f"{root}/gold_hourly/run={args.run_id}")
        hours = args.duration_hours if args.duration_hours is not None else DEFAULT_VARS.max_trip_hours
        v = dataclasses.replace(DEFAULT_VARS, boroughs=tuple(args.boroughs.split(","))) if args.boroughs else DEFAULT_VARS
        checks = runner.silver_checks(silver, zones, hours, v) + runner.gold_checks(silver, daily, hourly)
        rows = [(r["check"], r["failures"]) for r in run_checks(checks).collect()]
        print(json.dumps({"checks": rows}))
        if any(n for _, n in rows):
            print(str(GateFailed([c for c, n in rows if n])), file=sys.stderr)
            return 1
    elif args.cmd == "sandbox":
        from keelson.plans import runner
        from keelson.sources.readers import read_partitioned
        runner.append_day(read_partitioned(spark, args.bronze), args.day, args.path)
        print(json.dumps({"sandbox_rows": spark.read.parquet(args.path).count()}))
    return 0


if __name__ == "__main__":
    sys.exit(main())
