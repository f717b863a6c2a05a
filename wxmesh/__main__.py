"""Command line: ``python -m wxmesh <command> ...``.

``stations`` / ``areas``  landed documents -> the raw table, fully refreshed.
``observations`` / ``forecasts``  process every landed weather document not
              seen before (a file stream with ``availableNow``) into the table.
``pipeline``  raw tables (Parquet folders named like the raw tables, read with
              their declared schemas) -> gated staging, map, cleaned facts and
              the two hourly marts under ``--out``.
``refresh``   the two hourly marts by day under ``--out``, brought up to date with
              what the raw tables gained since the last refresh.
``run``       all of it: landed files to marts, then the ingest summary.

On a cluster, ``spark.checkpoint.dir`` must name a shared folder (it is read
from the session); submit with ``spark-submit -m wxmesh`` or run with
``python -m wxmesh`` where a session can be created.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F


def arguments(argv=None) -> argparse.Namespace:
    ap = argparse.ArgumentParser(prog="wxmesh")
    sub = ap.add_subparsers(dest="cmd", required=True)

    def command(name: str, *flags: str) -> argparse.ArgumentParser:
        p = sub.add_parser(name)
        for flag in flags:
            p.add_argument(f"--{flag}", required=True, help={
                "raw": "folder of the raw tables", "landing": "folder of landed documents", "now": "run time, ISO-8601",
                "checkpoint": "stream checkpoint folder", "out": "folder of the marts", "table": "folder of the table"}[flag])
        return p

    for name in ("stations", "areas"):
        command(name, "landing", "raw", "now")
    layout = {"choices": ("lines", "collection", "any"), "default": "any",
              "help": "areas as one feature per line, as whole collection documents, or each file by what it holds"}
    sub.choices["areas"].add_argument("--layout", **layout)
    for p in (command("observations", "landing", "table", "checkpoint", "raw", "now"),
              command("forecasts", "landing", "table", "checkpoint", "raw", "now"),
              command("run", "landing", "raw", "out", "checkpoint", "now")):
        p.add_argument("--max-files", type=int, help="files of a micro-batch at most")
        p.add_argument("--max-bytes", type=int, help="bytes of a micro-batch at most")
    for name in ("observations", "forecasts"):
        sub.choices[name].add_argument("--rejects", help="folder of bad records (default: rejects/ under the raw tables)")
    sub.choices["run"].add_argument("--layout", **layout)
    command("pipeline", "raw", "out")
    command("refresh", "raw", "out")
    for name in ("pipeline", "refresh", "run"):
        sub.choices[name].add_argument("--allow", action="append", default=[], metavar="MODEL:RULE",
                                       help="check that may fail without stopping the run")
    return ap.parse_args(argv)


def main(argv=None) -> int:
    args = arguments(argv)

    from . import schemas
    from .operators.ingest import active_stations
    from .plans import moving_marts, pipeline
    from .plans import products as P
    from .session import checkpoint_dir, release_scratch
    from .streaming import incremental as S

    spark = SparkSession.builder.appName(f"wxmesh-{args.cmd}").getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    checkpoint_dir(spark)
    raw = lambda name: schemas.read_raw(spark, args.raw, name)
    limits = {"max_files": getattr(args, "max_files", None), "max_bytes": getattr(args, "max_bytes", None)}
    rejects = getattr(args, "rejects", None) or f"{getattr(args, 'raw', '').rstrip('/')}/rejects/{args.cmd}"
    allow = [tuple(a.split(":", 1)) for a in getattr(args, "allow", [])]

    if args.cmd in ("stations", "areas"):
        rejects = (pipeline.load_stations(spark, args.landing, args.raw, args.now) if args.cmd == "stations"
                   else pipeline.load_areas(spark, args.landing, args.raw, args.now, layout=args.layout))
        rejects.show(truncate=False)
    elif args.cmd == "observations":
        S.run_available_now(spark, args.landing, args.table, args.checkpoint,
                            active_stations(raw("weather_stations"), P.ACTIVE_SINCE), args.now, rejects, **limits)
    elif args.cmd == "forecasts":
        S.run_forecasts_available_now(spark, args.landing, args.table, args.checkpoint,
                                      raw("weather_stations").filter(F.col("observation_type") == "forecast"), args.now,
                                      rejects_path=rejects, **limits)
    elif args.cmd == "refresh":
        done = moving_marts.catch_up(spark, args.raw, args.out, allow)
        for name in moving_marts.MARTS:
            print(f"{name}: {len(done.rebuilt.get(name, []))} days rebuilt")
    else:
        if args.cmd == "run":
            result, summary = pipeline.run_job(spark, args.landing, args.raw, args.out, args.checkpoint, args.now,
                                               allow=allow, layout=args.layout, **limits)
            summary.filter("station_id is null").show(truncate=False)
        else:
            result = pipeline.run_pipeline(spark, raw("weather_stations"), raw("postal_codes"), raw("weather_observations"),
                                           raw("weather_forecasts"), args.out, allow=allow)
        for name, path in result.tables.items():
            print(f"{result.names[name]}: {path}")
    release_scratch(spark)
    return 0


if __name__ == "__main__":
    sys.exit(main())
