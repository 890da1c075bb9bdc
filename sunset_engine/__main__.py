"""Command line for the file jobs: ``python -m sunset_engine <job> ...`` or ``spark-submit``.

    python -m sunset_engine strikes  STRIKES_CSV OUT_COUNTS [--header] [--timezones CSV]
    python -m sunset_engine flights  FLIGHTS AIRPORTS_CSV STRIKE_COUNTS OUT_DIR [--n 50] [--parquet]
                                       [--years FIRST LAST] [--timezones CSV] [--offset timezone|longitude]
    python -m sunset_engine ingest   FLIGHTS_CSV OUT_PARQUET
    python -m sunset_engine ratio    FLIGHT_FREQUENCIES STRIKE_COUNTS OUT
    python -m sunset_engine zonal    AIRPORTS_CSV CELLS OUT [--miles 5]
    python -m sunset_engine training ZONAL STRIKE_PER_FLIGHT OUT
    python -m sunset_engine stats    TRAINING_CSV
    python -m sunset_engine model    TRAINING_CSV OUT_PREFIX [--no-cv]
    python -m sunset_engine codes    CODE_LIST DATA_FILE [--timezones]

The master and every cluster setting come from ``spark-submit`` (or the
environment); the checkpoint folder from ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import argparse
import json
import sys

from sunset_engine.plans import jobs
from sunset_engine.session import get_spark


def build_parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="sunset_engine")
    sub = p.add_subparsers(dest="job", required=True)
    a = sub.add_parser("strikes", help="near-sunset strike counts per airport")
    a.add_argument("strikes"), a.add_argument("out")
    a.add_argument("--header", action="store_true", help="the strike export has a header line")
    a.add_argument("--timezones", help="CSV of airport codes and IANA zones")
    a = sub.add_parser("flights", help="near-sunset flights, frequencies, strikes per flight, top/bottom N")
    a.add_argument("flights"), a.add_argument("airports"), a.add_argument("strike_counts"), a.add_argument("out_dir")
    a.add_argument("--n", type=int, default=50)
    a.add_argument("--parquet", action="store_true", help="flights are the output of `ingest`")
    a.add_argument("--offset", choices=["timezone", "longitude"], default="timezone")
    a.add_argument("--years", type=int, nargs=2, metavar=("FIRST", "LAST"), help="all years by default")
    a.add_argument("--timezones", help="CSV of airport codes and IANA zones")
    a = sub.add_parser("ingest", help="flight CSVs to year/month-partitioned Parquet")
    a.add_argument("flights"), a.add_argument("out")
    a = sub.add_parser("ratio", help="strikes per flight for every airport, sorted")
    a.add_argument("frequencies"), a.add_argument("strike_counts"), a.add_argument("out")
    a = sub.add_parser("zonal", help="mean normalised raster value around each airport")
    a.add_argument("airports"), a.add_argument("cells"), a.add_argument("out")
    a.add_argument("--miles", type=float, default=5.0)
    a = sub.add_parser("training", help="zonal means joined to strikes per flight")
    a.add_argument("zonal"), a.add_argument("strike_per_flight"), a.add_argument("out")
    a = sub.add_parser("stats", help="Pearson r, p-value, least-squares line, R^2")
    a.add_argument("training")
    a = sub.add_parser("model", help="cross-validated random forest")
    a.add_argument("training"), a.add_argument("out_prefix")
    a.add_argument("--no-cv", action="store_true")
    a = sub.add_parser("codes", help="codes missing from a code list")
    a.add_argument("code_list"), a.add_argument("data")
    a.add_argument("--timezones", action="store_true", help="the data file is a timezone list")
    return p


def main(argv: list[str] | None = None, spark=None) -> int:
    args = build_parser().parse_args(argv)
    spark = spark or get_spark(app_name=f"sunset_engine.{args.job}")
    if args.job == "strikes":
        jobs.strike_job(spark, args.strikes, args.out, header=args.header, timezones_path=args.timezones)
    elif args.job == "flights":
        jobs.flight_job(spark, args.flights, args.airports, args.strike_counts, args.out_dir, n=args.n,
                        offset=args.offset, flights_format="parquet" if args.parquet else "csv",
                        years=tuple(args.years) if args.years else None, timezones_path=args.timezones)
    elif args.job == "ingest":
        jobs.ingest_flights(spark, args.flights, args.out)
    elif args.job == "ratio":
        jobs.ratio_report(spark, args.frequencies, args.strike_counts, args.out)
    elif args.job == "zonal":
        jobs.zonal_job(spark, args.airports, args.cells, args.out, zone_miles=args.miles)
    elif args.job == "training":
        jobs.training_job(spark, args.zonal, args.strike_per_flight, args.out)
    elif args.job == "stats":
        print(json.dumps(jobs.stats_job(spark, args.training).first().asDict()))
    elif args.job == "model":
        _, metrics = jobs.model_job(spark, args.training, args.out_prefix, cross_validate=not args.no_cv)
        print(json.dumps(metrics))
    elif args.job == "codes":
        kind = "timezones" if args.timezones else "flights"
        for row in jobs.code_check(spark, args.code_list, args.data, kind).toLocalIterator():
            print(row.code)
    return 0


if __name__ == "__main__":
    sys.exit(main())
