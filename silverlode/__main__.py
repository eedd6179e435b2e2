"""The jobs from a command line; ``lode.py`` is the same for spark-submit.

    spark-submit lode.py ingest   --csv PATH --to PATH [--table movies|credits] [--rows-per-file N] [--mode MODE]
    spark-submit lode.py silver   --bronze PATH --silver PATH [--format delta|parquet] [--rejects]
    spark-submit lode.py pipeline --movies PATH --credits PATH --bronze PATH --silver PATH [--format ...] [--rejects]

Each job takes settings of the stores that its paths are in, for this run alone: ``--store KEY=VALUE`` and, for
secrets, ``--store-env KEY=VARIABLE``, whose value is that of an environment variable. The shared folder
(``spark.checkpoint.dir``) is set with ``--conf`` on spark-submit.
"""

from __future__ import annotations

import argparse
import os

from silverlode.model import BRONZE
from silverlode.plans import build_silver, ingest, run_pipeline
from silverlode.session import build_session, delta_settings, own_session
from silverlode.sinks import ROWS_PER_FILE


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="silverlode")
    jobs = out.add_subparsers(dest="job", required=True)

    one = jobs.add_parser("ingest", help="load CSV files into a Bronze table")
    one.add_argument("--csv", required=True, help="file or directory of CSV files")
    one.add_argument("--to", required=True, help="directory of the Bronze table")
    one.add_argument("--table", choices=sorted(BRONZE), help="declared columns; by default types are found in the data")
    one.add_argument("--mode", choices=["overwrite", "errorifexists"], default="overwrite")

    silver = jobs.add_parser("silver", help="build all Silver tables from Bronze")
    both = jobs.add_parser("pipeline", help="load both CSV sources and build Silver")
    both.add_argument("--movies", required=True, help="CSV files of movies")
    both.add_argument("--credits", required=True, help="CSV files of credits")
    for job in (silver, both):
        job.add_argument("--bronze", required=True)
        job.add_argument("--silver", required=True)
        job.add_argument("--format", choices=["delta", "parquet"], default="delta")
        job.add_argument("--rejects", action="store_true", help="keep documents that cannot be read, as tables of their own")
    for job in (one, both):
        job.add_argument("--rows-per-file", type=int, default=ROWS_PER_FILE)
    one.add_argument("--most-lost", type=int, help="fail if more texts than this are not of their column's type")
    for job in (one, silver, both):
        job.add_argument("--store", action="append", default=[], metavar="KEY=VALUE", help="a Hadoop setting")
        job.add_argument("--store-env", action="append", default=[], metavar="KEY=VARIABLE", help="one from the environment")
    return out


def stores(args: argparse.Namespace) -> dict[str, str]:
    given = dict(pair.split("=", 1) for pair in args.store)
    return given | {key: os.environ[variable] for key, variable in (pair.split("=", 1) for pair in args.store_env)}


def main(arguments: list[str] | None = None) -> None:
    args = parser().parse_args(arguments)
    delta = delta_settings() if getattr(args, "format", "") == "delta" else {}
    spark = own_session(build_session(f"silverlode {args.job}", delta), stores(args))
    if args.job == "ingest":
        schema = BRONZE[args.table] if args.table else None
        print("loaded:", ingest(spark, args.csv, args.to, schema, args.rows_per_file, args.mode, args.most_lost))
    elif args.job == "silver":
        print("written:", *build_silver(spark, args.bronze, args.silver, args.format, args.rejects))
    else:
        tables = run_pipeline(
            spark, args.movies, args.credits, args.bronze, args.silver, args.format, args.rows_per_file, args.rejects
        )
        print("written:", *tables)


if __name__ == "__main__":
    main()
